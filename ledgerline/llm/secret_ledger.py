"""Secret scans over an incremental blob ledger, with DataFrame functions only.

Every version of every path is content-addressed: its blob is the SHA-256 of the text.  The
ledger has one row for each (blob, rule version) pair that was scanned, with the spans found.  A
run scans the pairs that the ledger lacks, each blob once however many paths hold it, adds them
as one batch, and joins the findings back to all paths.  Rule sets carry a version; a changed
set is a new version and scans again, the others do not.

Blobs are chosen on narrow rows (id and digest).  Texts move only to meet the list of pending
blobs: a small list (an ordinary increment) is broadcast by its measured size, so texts stay; in
a first load they are shuffled once by id.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .storage import new_folder


@dataclass(frozen=True)
class Rule:
    """``head`` then ``value``: matches run leftmost and do not overlap; those whose value has
    fewer than ``least`` characters are dropped afterwards.  ``hint`` is a cheaper pattern that
    every text with a match matches too."""

    kind: str
    head: str
    value: str
    least: int
    hint: str


# --- fixed values: the patterns of the scan ----------------------------------------------------
BASE = (
    Rule("assign", r"""(?i)((?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?)""",
         r"([A-Za-z0-9+/_.=-]+)", 6, r"(?i)(?:password|passwd|secret|token|api_?key)"),
    Rule("access", r"()", r"(AKIA[A-Z0-9]+)", 20, r"AKIA[A-Z0-9]"),
    Rule("hex", r"()", r"([0-9a-f]+)", 24, r"[0-9a-f]{24}"),
)
EXTENDED = (
    Rule("private_key", r"()", r"(-----BEGIN [A-Z ]*PRIVATE KEY-----)", 1, r"-----BEGIN "),
    Rule("github", r"()", r"(gh[pousr]_[A-Za-z0-9]+)", 40, r"gh[pousr]_"),
    Rule("jwt", r"()", r"(eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+)", 30, r"eyJ"),
)
# ------------------------------------------------------------------------------------------------

#: rule version -> rules; the order of all kinds breaks ties of spans that start together
RULE_SETS = {"base-1": BASE, "extended-1": EXTENDED}

# Three private-use characters mark a match; where a text has them, others stand in for them.
_OPEN, _MID, _CLOSE = (chr(c) for c in (0xE000, 0xE001, 0xE002))
SPANS = "array<struct<start:int,ord:int,kind:string,end:int>>"


def blob_of(text: Column) -> Column:
    return F.unhex(F.sha2(F.coalesce(text, F.lit("")).cast("binary"), 256))


def rule_spans(text: Column, rule: Rule, order: int) -> Column:
    """All spans of one rule, in code points, as an array ordered by start."""
    safe = F.translate(text, _OPEN + _MID + _CLOSE, 3 * chr(0xFFFD))
    pieces = F.split(F.regexp_replace(safe, F.lit(rule.head + rule.value),
                                      F.lit(f"{_OPEN}$1{_MID}$2{_CLOSE}")), _OPEN)

    def step(acc: Column, piece: Column) -> Column:
        head = F.instr(piece, _MID) - 1
        length = F.instr(piece, _CLOSE) - 2          # head and value, without the marks
        hit = F.struct(acc["at"].alias("start"), F.lit(order).alias("ord"),
                       F.lit(rule.kind).alias("kind"), (acc["at"] + length).alias("end"))
        return F.struct(
            (acc["at"] + F.char_length(piece) - 2).alias("at"),
            F.when(length - head >= rule.least, F.concat(acc["hits"], F.array(hit)))
            .otherwise(acc["hits"]).alias("hits"))

    zero = F.struct(F.char_length(F.element_at(pieces, 1)).alias("at"),
                    F.array().cast(SPANS).alias("hits"))
    rest = F.slice(pieces, F.lit(2), F.size(pieces))
    return F.when(text.rlike(rule.hint), F.aggregate(rest, zero, step, lambda a: a["hits"])) \
        .otherwise(F.array().cast(SPANS))


def set_spans(text: Column, version: str, rule_sets: dict) -> Column:
    orders = {r.kind: i for i, r in enumerate(r for rules in rule_sets.values() for r in rules)}
    return F.array_sort(F.concat(*[rule_spans(text, r, orders[r.kind])
                                   for r in rule_sets[version]]))


LEDGER = f"blob binary, rule_version string, spans {SPANS}, batch string"


def _committed(spark: SparkSession, folder: str) -> list[str]:
    """The batches under ``folder`` whose write ended."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    path = jvm.org.apache.hadoop.fs.Path(folder)
    fs = path.getFileSystem(conf)
    names = [s.getPath().getName() for s in fs.listStatus(path)] if fs.exists(path) else []
    return [n.removeprefix("batch=") for n in sorted(names) if n.startswith("batch=") and
            fs.exists(jvm.org.apache.hadoop.fs.Path(f"{folder}/{n}/_SUCCESS"))]


def _read(spark: SparkSession, folder: str, batches: list[str], schema=None) -> DataFrame | None:
    """The rows of these batches with their ``batch`` as text; None if there is none."""
    if not batches:
        return None
    at = [f"{folder}/batch={b}" for b in batches]
    schema = schema or spark.read.parquet(at[0]).schema.add("batch", "string")
    return spark.read.schema(schema).option("basePath", folder).parquet(*at)


def _ledger(spark: SparkSession, ledger: str) -> DataFrame | None:
    return _read(spark, ledger, _committed(spark, ledger), LEDGER)


def _pending(chosen: DataFrame, ledger: str, batch: str, rule_sets: dict) -> DataFrame:
    """``chosen`` (blob and more) with ``todo``: the rule versions that blobs were not scanned with."""
    every = F.array(*[F.lit(v) for v in rule_sets])
    known = _ledger(chosen.sparkSession, ledger)
    if known is None:
        return chosen.withColumn("todo", every)
    seen = known.where(F.col("batch") != batch).groupBy("blob") \
        .agg(F.collect_set("rule_version").alias("done"))
    return chosen.join(seen, "blob", "left").withColumn(
        "todo", F.array_except(every, F.coalesce("done", F.array().cast("array<string>")))) \
        .drop("done").where(F.size("todo") > 0)


def _add(work: DataFrame, ledger: str, batch: str, rule_sets: dict) -> DataFrame:
    """Scan ``work`` (blob, _text, todo) and commit it as ``batch``; the ledger of these rules."""
    found = F.array(*[F.struct(
        F.lit(v).alias("rule_version"),
        F.when(F.array_contains("todo", v), set_spans(F.col("_text"), v, rule_sets)).alias("spans"))
        for v in rule_sets])
    rows = work.select("blob", F.explode(found).alias("f")).select(
        "blob", "f.rule_version", "f.spans").where("spans is not null")
    # a path that repeats with the same text was scanned as often; one row of each pair stays
    rows.dropDuplicates(["blob", "rule_version"]).write.mode("overwrite") \
        .parquet(f"{ledger}/batch={batch}")
    return _ledger(work.sparkSession, ledger).where(F.col("rule_version").isin(*rule_sets)) \
        .select("blob", "rule_version", "spans")


def scan(docs: DataFrame, ledger: str, batch: str, *, id_col: str = "doc_id",
         text_col: str = "text", rule_sets: dict | None = None,
         keep_texts: bool = False) -> DataFrame:
    """Bring the ledger up to date with ``docs`` and return (blob, rule_version, spans) of it.

    ``ledger`` is a folder; this run writes ``batch=<batch>`` into it and replaces what an
    earlier attempt of the same batch left there, so it can be run again.  The paths (id, blob)
    of this run go to ``ledger-paths`` beside it.  With ``keep_texts`` (from the first batch on)
    the text of each new blob goes to ``ledger-blobs`` once, for ``rescan``.
    """
    spark = docs.sparkSession
    rule_sets = rule_sets or RULE_SETS
    paths_at = f"{ledger}-paths/batch={batch}"
    source = docs.select(F.col(id_col).alias("_id"),
                         F.coalesce(F.col(text_col), F.lit("")).alias("_text"))
    source.select("_id", blob_of(F.col("_text")).alias("blob")).write.mode("overwrite") \
        .parquet(paths_at)
    paths = spark.read.parquet(paths_at)
    # one path for each blob; a null id is a path like any other
    chosen = paths.groupBy("blob").agg(F.min(F.struct(F.col("_id").isNull().alias("z"), "_id"))
                                       .alias("m")).select("blob", F.col("m._id").alias("_at"))
    work = source.join(_pending(chosen, ledger, batch, rule_sets),
                       F.col("_id").eqNullSafe(F.col("_at"))
                       & (blob_of(F.col("_text")) == F.col("blob")))
    if keep_texts:
        texts_at = f"{ledger}-blobs"
        kept = _read(spark, texts_at, [b for b in _committed(spark, texts_at) if b != batch])
        new = work if kept is None else work.join(kept.select("blob"), "blob", "left_anti")
        new.select("blob", "_text").dropDuplicates(["blob"]).write.mode("overwrite") \
            .parquet(f"{texts_at}/batch={batch}")
    return _add(work, ledger, batch, rule_sets)


def rescan(spark: SparkSession, ledger: str, batch: str, rule_sets: dict | None = None) -> DataFrame:
    """Scan every kept blob with the rule versions it has not met, as one batch of the ledger.

    Reaches blobs that no current document holds any more.  Returns what ``scan`` returns; a
    ledger without kept texts is an error, as its old blobs could not be scanned.
    """
    rule_sets = rule_sets or RULE_SETS
    kept = _read(spark, f"{ledger}-blobs", _committed(spark, f"{ledger}-blobs"))
    if kept is None:
        raise ValueError("the ledger keeps no texts: scan with keep_texts=True")
    todo = _pending(kept.select("blob"), ledger, batch, rule_sets)
    return _add(kept.select("blob", "_text").join(todo, "blob"), ledger, batch, rule_sets)


def _on_paths(paths: DataFrame, known: DataFrame, id_col: str, *more: str) -> DataFrame:
    hits = known.where(F.size("spans") > 0).groupBy("blob") \
        .agg(F.array_sort(F.flatten(F.collect_list("spans"))).alias("spans"))
    return paths.join(hits, "blob", "left").select(
        F.col("_id").alias(id_col), *more, "blob",
        F.coalesce("spans", F.array().cast(SPANS)).alias("spans"))


def findings(docs: DataFrame, ledger: str, batch: str, *, id_col: str = "doc_id",
             text_col: str = "text", rule_sets: dict | None = None,
             keep_texts: bool = False) -> DataFrame:
    """Scan what is new and return id, blob and the spans (start, ord, kind, end) of every path
    of ``docs``; ``history`` gives those of all batches.

    A null text counts as empty: its blob is that of the empty text, it has no spans.  Rows that
    repeat come back as often as they came.  Spans count code points, their end is exclusive.
    Other columns of ``docs`` are not read.  An empty table gives an empty result and an empty
    batch.  Of paths that share a blob none is rescanned; the join splits a blob that a large
    part of all paths holds (no aggregate stands above it).
    """
    known = scan(docs, ledger, batch, id_col=id_col, text_col=text_col, rule_sets=rule_sets,
                 keep_texts=keep_texts)
    return _on_paths(docs.sparkSession.read.parquet(f"{ledger}-paths/batch={batch}"), known, id_col)


def history(spark: SparkSession, ledger: str, *, id_col: str = "doc_id",
            rule_sets: dict | None = None) -> DataFrame:
    """id, version, blob and spans of every path of every committed batch.

    ``version`` is the batch that brought this text of the path, so a path that changed has one
    row for each of its versions, and one whose text stayed has one for each batch it came in.
    Batches whose scan did not end are left out.  Findings of every rule version of
    ``rule_sets`` reach all of them, whichever batch scanned the blob.  A ledger without a
    committed batch is an error.
    """
    scanned = set(_committed(spark, ledger))
    paths = _read(spark, f"{ledger}-paths",
                  [b for b in _committed(spark, f"{ledger}-paths") if b in scanned])
    if paths is None:
        raise ValueError("the ledger has no committed batch")
    known = _ledger(spark, ledger).where(F.col("rule_version").isin(*(rule_sets or RULE_SETS)))
    return _on_paths(paths.withColumnRenamed("batch", "version"), known, id_col, "version")


def joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def op2_secret_scan(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    found = findings(docs, new_folder(spark, "secret-ledger"), "load")
    kinds = {r.kind: i for i, r in enumerate(BASE)}
    count = lambda k: F.size(F.filter("spans", lambda s: s["ord"] == kinds[k])).cast("bigint")
    return found.select(
        "doc_id", count("assign").alias("n_assign"), count("access").alias("n_access"),
        count("hex").alias("n_hex"),
        F.sha2(joined(F.filter("spans", lambda s: s["ord"] < len(BASE))).cast("binary"), 256)
        .alias("base_sha256"), joined(F.col("spans")).alias("spans"))


ORACLE_SQL = """
WITH pats(kind, ord, least, pat) AS (VALUES
  ('assign', 0, 6, '(?i)((?:password|passwd|secret|token|api_?key)["'']?\\x20*[:=]\\x20*["'']?)([A-Za-z0-9+/_.=-]+)'),
  ('access', 1, 20, '()(AKIA[A-Z0-9]+)'),
  ('hex', 2, 24, '()([0-9a-f]+)'),
  ('private_key', 3, 1, '()(-----BEGIN [A-Z ]*PRIVATE KEY-----)'),
  ('github', 4, 40, '()(gh[pousr]_[A-Za-z0-9]+)'),
  ('jwt', 5, 30, '()(eyJ[A-Za-z0-9_-]+\\.[A-Za-z0-9_-]+\\.[A-Za-z0-9_-]+)')),
cut AS (
  SELECT doc_id, kind, ord, least, string_split(CASE kind
    WHEN 'assign' THEN regexp_replace(t, '(?i)((?:password|passwd|secret|token|api_?key)["'']?\\x20*[:=]\\x20*["'']?)([A-Za-z0-9+/_.=-]+)', chr(57344)||'\\1'||chr(57345)||'\\2'||chr(57346), 'g')
    WHEN 'access' THEN regexp_replace(t, '()(AKIA[A-Z0-9]+)', chr(57344)||'\\1'||chr(57345)||'\\2'||chr(57346), 'g')
    WHEN 'hex' THEN regexp_replace(t, '()([0-9a-f]+)', chr(57344)||'\\1'||chr(57345)||'\\2'||chr(57346), 'g')
    WHEN 'private_key' THEN regexp_replace(t, '()(-----BEGIN [A-Z ]*PRIVATE KEY-----)', chr(57344)||'\\1'||chr(57345)||'\\2'||chr(57346), 'g')
    WHEN 'github' THEN regexp_replace(t, '()(gh[pousr]_[A-Za-z0-9]+)', chr(57344)||'\\1'||chr(57345)||'\\2'||chr(57346), 'g')
    ELSE regexp_replace(t, '()(eyJ[A-Za-z0-9_-]+\\.[A-Za-z0-9_-]+\\.[A-Za-z0-9_-]+)', chr(57344)||'\\1'||chr(57345)||'\\2'||chr(57346), 'g')
    END, chr(57344)) AS p
  FROM (SELECT doc_id, coalesce(text, '') AS t FROM documents) CROSS JOIN pats),
piece AS (
  SELECT doc_id, kind, ord, least, unnest(p) AS s, generate_subscripts(p, 1) AS i FROM cut),
placed AS (
  SELECT *, coalesce(sum(CASE WHEN i = 1 THEN length(s) ELSE length(s) - 2 END)
      OVER (PARTITION BY doc_id, ord ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS off
  FROM piece),
hit AS (
  SELECT doc_id, kind, ord, off AS b, off + instr(s, chr(57346)) - 2 AS e FROM placed
  WHERE i > 1 AND instr(s, chr(57346)) - instr(s, chr(57345)) - 1 >= least),
agg AS (
  SELECT doc_id, count(*) FILTER (ord = 0) AS n_assign, count(*) FILTER (ord = 1) AS n_access,
    count(*) FILTER (ord = 2) AS n_hex,
    coalesce(string_agg(kind||':'||b||':'||e, ',' ORDER BY b, ord) FILTER (ord < 3), '') AS base,
    string_agg(kind||':'||b||':'||e, ',' ORDER BY b, ord) AS spans
  FROM hit GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access,
  coalesce(n_hex, 0) AS n_hex, sha256(coalesce(base, '')) AS base_sha256,
  coalesce(spans, '') AS spans
FROM documents d LEFT JOIN agg USING (doc_id)
"""
