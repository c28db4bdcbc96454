"""The registered queries of this subpackage and their DuckDB SQL."""

from __future__ import annotations

from functools import wraps

from . import (
    backoff_lm,
    cuckoo_dedup,
    divergence,
    hard_negatives,
    html_wrappers,
    jaccard_join,
    language_id,
    length_buckets,
    mixing,
    secret_ledger,
    token_rollup,
    token_shards,
    topk,
)
from .storage import ship


def _shipped(query):
    @wraps(query)
    def run(spark, sf_dir):
        ship(spark)
        return query(spark, sf_dir)

    return run


QUERIES = {q.__name__: _shipped(q) for q in (
    language_id.op1_language_id,
    secret_ledger.op2_secret_scan,
    token_rollup.op3_token_rollup,
    mixing.op4_mixing,
    jaccard_join.op5_jaccard_join,
    token_shards.op6_token_shards,
    topk.op7_topk,
    length_buckets.op8_packing,
    cuckoo_dedup.op9_exact_dedup,
    backoff_lm.op10_lm_score,
    hard_negatives.op11_hard_negatives,
    divergence.op12_source_audit,
    html_wrappers.op13_main_text,
)}

ORACLE_SQL = {
    "op4_mixing": mixing.oracle_sql(),
    "op8_packing": length_buckets.oracle_sql(),
    "op5_jaccard_join": jaccard_join.ORACLE_SQL,
    "op7_topk": topk.ORACLE_SQL,
    "op2_secret_scan": secret_ledger.ORACLE_SQL,
    "op9_exact_dedup": cuckoo_dedup.ORACLE_SQL,
    "op11_hard_negatives": hard_negatives.ORACLE_SQL,
    "op12_source_audit": divergence.ORACLE_SQL,
}
