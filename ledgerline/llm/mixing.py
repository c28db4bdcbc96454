"""Mixing sources to target weights by iterative proportional fitting, with DataFrame functions.

Token counts of the cells (source, language, topic) are raked: in turn each dimension's marginal
is scaled to its target share, until all marginals hold.  A cell's weight over its share of the
tokens is the rate at which its documents are wanted; the rates are calibrated to a token budget
and every document is kept by its own draw against its probability.

Cells and marginals are aggregated before anything else moves (a hot source is one row of each
partition).  The cell table has one row for each combination that occurs; a sweep is a window sum
over it for each dimension, and a few sweeps run as one job before the weights are written.
"""

from __future__ import annotations

import warnings
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .length_buckets import draw, word_count
from .storage import as_named, by_place, written

DIMENSIONS = ("source", "lang", "topic")
#: largest relative error of a marginal at which raking ends
TOLERANCE = 1e-10
#: raking also ends where the error falls by less than STALL a sweep, over the second half of at
#: least STALL_FROM sweeps: the targets contradict each other, or only zero weights meet them
STALL = 1e-4
STALL_FROM = 64
#: sweeps of the SQL, which has no way to stop at TOLERANCE
SWEEPS = 300
#: sweeps that run as one job, before the weights are written
SWEEPS_A_JOB = 4
#: cells up to which the sweeps run in one task; more are dealt out by each dimension in turn
CELLS_A_TASK = 50_000

#: fixed values: shapes of text that stand for topics, first match first
TOPICS = (
    ("table", r"\|[^\n|]*\|"),
    ("notice", r"(?i)licen[sc]e|rights reserved|copyright"),
    ("listing", r"[#$%&*]{3}"),
    ("loud", r"[^a-z]{40}"),
)


def topic_of(text: Column) -> Column:
    """A topic by the text's shape; ``prose`` for all other texts, null ones too."""
    out = F.lit("prose")
    for name, pattern in reversed(TOPICS):
        out = F.when(text.rlike(pattern), name).otherwise(out)
    return out


def rake(cells: DataFrame, targets: dict[str, DataFrame | float],
         sweeps: int | None = None) -> DataFrame:
    """``cells`` (source, lang, topic, tokens) with ``share``, the raked ``weight`` and ``error``.

    ``targets``: for each dimension a table (dimension, target) with one row a value, or a
    number: target shares in proportion to the tokens to that power.  Targets of values without
    tokens are dropped and the others scaled to 1; values without a target get weight 0.  Null
    values are values like any other.  Sweeps go on until all marginals hold to TOLERANCE, or
    ``sweeps`` where the caller sets a number.  Where the error does not fall any more (the
    targets contradict each other) the last sweep's weights are returned: the last dimension's
    marginal holds, a warning tells, and ``error`` is the largest relative error of a marginal.
    """
    spark, dims = cells.sparkSession, list(targets)
    of = {d: Window.partitionBy(d) for d in dims}
    step = cells
    for d, t in targets.items():
        if isinstance(t, DataFrame):
            step = step.join(t.select(F.col(d).alias("_v"), F.col("target").alias("_g")),
                             F.col(d).eqNullSafe(F.col("_v")), "left")
            goal = F.coalesce(F.col("_g").cast("double"), F.lit(0.0))
        else:
            goal = F.pow(F.sum("tokens").over(of[d]).cast("double"), F.lit(float(t)))
        step = step.withColumn(f"_goal_{d}", goal).drop("_v", "_g") \
            .withColumn(f"_cells_{d}", F.count("*").over(of[d]))
    now = written(spark, step, "goals")
    # every value's goal counts once: its cells share it
    n_cells, total, *sums = now.agg(F.count("*"), F.sum("tokens"), *[
        F.sum(F.col(f"_goal_{d}") / F.col(f"_cells_{d}")) for d in dims]).first()
    now = now.withColumn("share", F.col("tokens") / F.lit(float(total or 1))) \
        .withColumn("weight", F.col("share")) \
        .withColumns({f"_goal_{d}": F.col(f"_goal_{d}") / F.lit(x or 1.0)
                      for d, x in zip(dims, sums)})
    done, errors = 0, []
    while sweeps is None or done < sweeps:
        n = SWEEPS_A_JOB if sweeps is None else min(SWEEPS_A_JOB, sweeps - done)
        # cells that one task holds easily need no exchange between the window sums
        step = (now.coalesce(1) if n_cells <= CELLS_A_TASK else now).drop("_off")
        for _ in range(n):
            off = []
            for d in dims:
                margin, goal = F.col(f"_margin_{d}"), F.col(f"_goal_{d}")
                step = step.withColumn(f"_margin_{d}", F.sum("weight").over(of[d])) \
                    .withColumn("weight", F.when(margin > 0, F.col("weight") * goal / margin)
                                .otherwise(0.0))
                off.append(F.when(goal > 0, F.abs(margin / goal - 1)).otherwise(0.0))
        # the last sweep's factors: the marginals are as near to their goals afterwards
        now = written(spark, step.withColumn("_off", F.greatest(*off))
                      .drop(*[f"_margin_{d}" for d in dims]), "raked")
        done += n
        errors.append((done, now.agg(F.max("_off")).first()[0] or 0.0))
        if errors[-1][1] < TOLERANCE or _stalled(errors):
            break
    error = errors[-1][1] if errors else None
    if error is not None and error >= TOLERANCE:
        warnings.warn(f"raking ended after {done} sweeps; a marginal is off by {error:.3g} of its "
                      "target", stacklevel=2)
    return now.select(*cells.columns, "share", "weight", F.lit(error).cast("double").alias("error"))


def _stalled(errors: list[tuple[int, float]]) -> bool:
    """Whether the least error (sweeps, error) hardly fell in the second half of the sweeps."""
    done = errors[-1][0]
    early = [e for at, e in errors if 2 * at <= done]
    late = [e for at, e in errors if 2 * at > done]
    if done < STALL_FROM or not early:
        return False
    return min(late) > min(early) * (1 - STALL) ** (done / 2)


def calibrated_rate(cells: DataFrame, budget: float) -> float:
    """The factor k with sum(tokens * min(1, k * rate)) = ``budget`` of all tokens.

    ``rate`` is weight / share.  Solved by bisection; each probe is one aggregate of the cells.
    Where the budget exceeds what cells with a positive weight hold, all of them are taken.
    """
    rated = cells.where("share > 0 and weight > 0").select(
        "share", (F.col("weight") / F.col("share")).alias("rate"))
    top, reach = rated.agg(F.max(1 / F.col("rate")), F.sum("share")).first()
    if top is None:
        return 0.0
    if budget >= reach:
        return float(top)
    low, high = 0.0, float(top)
    for _ in range(6):
        # 64 probes at once narrow the interval 65-fold
        probes = [low + (high - low) * (i + 1) / 65 for i in range(64)]
        row = rated.agg(*[F.sum(F.col("share") * F.least(F.lit(1.0), F.col("rate") * k))
                          .alias(f"p{i}") for i, k in enumerate(probes)]).first()
        i = next((i for i in range(64) if row[i] >= budget), 64)
        low, high = ([low, *probes][i], [*probes, high][i])
    return high


def _rated(docs: DataFrame, id_col: str, source_col: str, lang_col: str,
           topic: Column | None, tokens: Column | None, targets: dict[str, DataFrame] | None,
           exponents: dict[str, float] | None, budget: float) -> DataFrame:
    """``docs`` by position, with _id, _source, _lang, _topic, _tokens, _rate and _chance."""
    spark = docs.sparkSession
    named = by_place(
        docs, F.col(id_col).alias("_id"), F.col(source_col).cast("string").alias("_source"),
        F.col(lang_col).cast("string").alias("_lang"),
        (topic_of(F.col("text")) if topic is None else topic).cast("string").alias("_topic"),
        (word_count(F.col("text")) if tokens is None else tokens).cast("bigint").alias("_tokens"))
    own = [F.col(f"_{d}") for d in DIMENSIONS]
    cells = written(spark, named.groupBy(*[c.alias(d) for c, d in zip(own, DIMENSIONS)])
                    .agg(F.sum("_tokens").alias("tokens")), "cells").where("tokens > 0")
    power = {"source": 0.5, "lang": 0.5, "topic": 0.8} | (exponents or {})
    given = targets or {}
    raked = rake(cells, {d: given.get(d, power[d]) for d in DIMENSIONS})
    k = calibrated_rate(raked, budget)
    rates = raked.select(*[F.col(d).alias(f"_of_{d}") for d in DIMENSIONS],
                         (F.col("weight") / F.col("share")).alias("_r"))
    on = reduce(lambda a, b: a & b, [F.col(f"_{d}").eqNullSafe(F.col(f"_of_{d}"))
                                     for d in DIMENSIONS])
    rate = F.coalesce("_r", F.lit(0.0))
    return named.join(rates, on, "left").withColumn("_rate", rate) \
        .withColumn("_chance", F.least(F.lit(1.0), F.col("_rate") * F.lit(k)))


def _drawn(seed: str) -> Column:
    mark = F.concat(F.lit(seed + ":"), F.coalesce(F.col("_id").cast("string"), F.lit("null")))
    return draw(mark) / F.lit(float(1 << 32)) < F.col("_chance")


def mix(docs: DataFrame, *, id_col: str = "doc_id", source_col: str = "source",
        lang_col: str = "lang", topic: Column | None = None, tokens: Column | None = None,
        targets: dict[str, DataFrame] | None = None, exponents: dict[str, float] | None = None,
        budget: float = 0.5, seed: str = "mix") -> DataFrame:
    """id, source, lang, topic, n_tokens, rate, probability, sampled: one row for each row.

    Without explicit ``targets`` a dimension's target shares are its token shares tempered by
    ``exponents`` (default: 0.5 for source and language, 0.8 for topic).  ``probability`` is
    min(1, k * rate), k such that the expected tokens are ``budget`` of all; a document is
    sampled when its draw, a hash of id and seed, lies below.  Null source, language or topic
    are values of their own; a null or empty text has no tokens, takes its cell's probability,
    and probability 0 where its cell has no tokens at all.  Rows that repeat an id share its
    draw.  Columns that are not named, whatever they are called, are not read.  An empty table
    gives no rows.
    """
    used = list(dict.fromkeys([id_col, source_col, lang_col, "text"]))
    narrow = docs.select(*used) if topic is None and tokens is None else docs
    found = _rated(narrow, id_col, source_col, lang_col, topic, tokens, targets, exponents, budget)
    return found.select(
        F.col("_id").alias(id_col), F.col("_source").alias("source"), F.col("_lang").alias("lang"),
        F.col("_topic").alias("topic"), F.col("_tokens").alias("n_tokens"),
        F.col("_rate").alias("rate"), F.col("_chance").alias("probability"),
        _drawn(seed).alias("sampled"))


def sampled(docs: DataFrame, *, id_col: str = "doc_id", source_col: str = "source",
            lang_col: str = "lang", seed: str = "mix", budget: float = 0.5,
            **settings) -> DataFrame:
    """The rows of ``docs`` that ``mix`` samples, with all their columns, whatever their names."""
    found = _rated(docs, id_col, source_col, lang_col, settings.get("topic"),
                   settings.get("tokens"), settings.get("targets"), settings.get("exponents"), budget)
    return as_named(found.where(_drawn(seed)), docs)


def op4_mixing(spark, sf_dir: str) -> DataFrame:
    found = mix(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return found.withColumn("rate", F.round("rate", 6)) \
        .withColumn("probability", F.round("probability", 6))


def oracle_sql() -> str:
    """DuckDB SQL of ``op4_mixing``: SWEEPS sweeps as a recursion, the rate from the cells' order."""
    sweep = "w"
    for d, t in zip(DIMENSIONS, ("ts", "tl", "tt")):
        sweep = (f"(SELECT * REPLACE (weight * {t} / sum(weight) OVER (PARTITION BY {d}) AS weight) "
                 f"FROM {sweep})")
    topic = " ".join(f"WHEN regexp_matches(t, '{p}') THEN '{n}'" for n, p in TOPICS)
    target = lambda d, x: (f"SELECT {d}, pow(sum(tokens), {x}) / sum(pow(sum(tokens), {x})) OVER () AS target "  # noqa: E731
                           f"FROM cells GROUP BY {d}")
    return f"""
WITH RECURSIVE r AS (
  SELECT doc_id, source, lang, CASE {topic} ELSE 'prose' END AS topic,
    len(regexp_extract_all(t, '[^\\x20\\x09-\\x0D]+'))::BIGINT AS n_tokens
  FROM (SELECT *, coalesce(text, '') AS t FROM documents)),
cells AS MATERIALIZED (
  SELECT source, lang, topic, sum(n_tokens)::DOUBLE AS tokens FROM r GROUP BY ALL HAVING sum(n_tokens) > 0),
gs AS ({target("source", 0.5)}), gl AS ({target("lang", 0.5)}), gt AS ({target("topic", 0.8)}),
w AS (
  SELECT 0 AS i, c.source, c.lang, c.topic, gs.target AS ts, gl.target AS tl, gt.target AS tt,
    tokens / sum(tokens) OVER () AS share, tokens / sum(tokens) OVER () AS weight
  FROM cells c JOIN gs ON c.source IS NOT DISTINCT FROM gs.source
    JOIN gl ON c.lang IS NOT DISTINCT FROM gl.lang JOIN gt ON c.topic IS NOT DISTINCT FROM gt.topic
  UNION ALL
  SELECT * REPLACE (i + 1 AS i) FROM {sweep} WHERE i < {SWEEPS}),
g AS MATERIALIZED (
  SELECT source, lang, topic, share, weight, weight / share AS rate FROM w WHERE i = {SWEEPS}),
o AS (
  SELECT *, sum(share) OVER (ORDER BY rate DESC, source DESC, lang DESC, topic DESC ROWS UNBOUNDED PRECEDING) - share AS above,
    sum(weight) OVER (ORDER BY rate, source, lang, topic ROWS UNBOUNDED PRECEDING) AS below
  FROM g),
k AS (SELECT arg_max((0.5 - above) / below, rate) AS k FROM o WHERE (0.5 - above) / below * rate <= 1.0 + 1e-12)
SELECT r.doc_id, r.source, r.lang, r.topic, r.n_tokens, round(coalesce(rate, 0), 6) AS rate,
  round(least(1.0, coalesce(rate, 0) * k), 6) AS probability,
  ('0x' || substr(md5('mix:' || coalesce(doc_id::VARCHAR, 'null')), 1, 8))::BIGINT / 4294967296.0
    < least(1.0, coalesce(rate, 0) * k) AS sampled
FROM r CROSS JOIN k LEFT JOIN g ON r.source IS NOT DISTINCT FROM g.source
  AND r.lang IS NOT DISTINCT FROM g.lang AND r.topic IS NOT DISTINCT FROM g.topic
"""
