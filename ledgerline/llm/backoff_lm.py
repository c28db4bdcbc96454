"""Language-model scores by a weighted backoff automaton over words.

Tokens are lower-cased words and one end mark a document.  All words and all bigrams are counted
over all training documents.  Every token is a state of the automaton (the end mark stands for
the start of a text too); a state has an arc for each token that followed it in training,
weighted by the discounted bigram estimate; every other token takes the state's failure arc,
which multiplies its backoff weight, to the root, where the word's smoothed unigram probability
is.  A text is read once from left to right: the token before is the state that is carried, and
log-probabilities accumulate.

    P(w | h) = (c(h, w) - D) / c(h)                                  if the arc exists
             = b(h) P(w),  b(h) = (1 - sum of arcs) / (1 - sum of P over arcs)   otherwise
    P(w)     = (c(w) + 1) / (N + V + 1)

so the probabilities that follow a state sum to one, a single unseen word included.  A state
that training never saw has no arcs and b(h) = 1.

The automaton grows with the corpus, so no task holds it.  Documents are cut into chunks of a
bounded number of tokens, kept as codes of the chunk's own words.  A chunk asks for its slice of
the automaton, and only for distinct things: first its words, then its pairs of words.  Both are
dealt into ranges by hash; a range gets from each chunk one blob with training counts, adds them
up, and sends a blob of the totals back.  Pairs are dealt by their state, so a range also knows
the state's arcs and with them its failure weight.  A frequent state's pairs are split by the next
word, so no range holds more than a bounded share of one state; its arcs are added up afterwards
and joined to the chunks that have it.  With its slice a chunk reads its texts.  No row is made
for an occurrence of a word, and nothing is capped.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .language_id import remainder
from .storage import written
from .texts import mix64, word_hashes

#: states of the model: every token is one, there is no cap
CONTEXTS = sys.maxsize
#: training occurrences of a state up to which its pairs meet in one range; so many more make one
#: more share of them
HEAD = 200_000
DISCOUNT = 0.5
#: hash of the end mark; no word has it (but with the chance of any hash collision)
END = np.uint64(0x9D5C3A1E7F20B64D)
#: tokens of a chunk (at least one document), and of the text that a range of pairs stands for
CHUNK = 1 << 21
RANGE = 1 << 20
#: bits of a next word's hash that travel: they tell the at most HEAD words of one share apart
SHORT = np.int64((1 << 48) - 1)
_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


def tokens(text: bytes) -> np.ndarray:
    return np.append(word_hashes(text), END)


# -- blobs ----------------------------------------------------------------------------------

def pack(*columns: np.ndarray) -> bytes:
    """Columns of whole numbers as one compressed blob: bytes of equal rank lie together, so that
    small numbers take little more than their information."""
    out = [np.array([len(columns), *map(len, columns)], "<i8").tobytes()]
    for c in columns:
        out.append(np.ascontiguousarray(c.astype("<i8").view(np.uint8).reshape(-1, 8).T).tobytes())
    return zstandard.compress(b"".join(out), 1)


def unpack(blob: bytes) -> list[np.ndarray]:
    raw = zstandard.decompress(blob)
    n = int(np.frombuffer(raw, "<i8", 1)[0])
    at, out = 8 * (n + 1), []
    for size in np.frombuffer(raw, "<i8", n, 8).tolist():
        planes = np.frombuffer(raw, np.uint8, 8 * size, at).reshape(8, size)
        out.append(np.ascontiguousarray(planes.T).view("<i8").reshape(size))
        at += 8 * size
    return out


# -- chunks ---------------------------------------------------------------------------------

CHUNKS = ("chunk bigint, ids array<bigint>, held array<boolean>, lengths array<bigint>, "
          "words binary, codes binary")


def _chunk(number: int, ids: list, held: list, docs: list[np.ndarray]) -> pa.RecordBatch:
    lengths = np.array([len(t) for t in docs], dtype=np.int64)
    words, code, n = np.unique(np.concatenate(docs), return_inverse=True, return_counts=True)
    train = np.repeat(~np.array(held, dtype=bool), lengths)
    order = np.argsort(-n, kind="stable")                # small codes for frequent words
    place = np.empty_like(order)
    place[order] = np.arange(len(order))
    code = place[code]
    return pa.RecordBatch.from_arrays([
        pa.array([number], pa.int64()), pa.array([ids], pa.list_(pa.int64())),
        pa.array([held], pa.list_(pa.bool_())), pa.array([lengths], pa.list_(pa.int64())),
        pa.array([pack(words[order].view(np.int64), np.bincount(code[train], minlength=len(words)))],
                 pa.binary()),
        pa.array([pack(code)], pa.binary())],
        names=["chunk", "ids", "held", "lengths", "words", "codes"])


def _chunks(limit: int):
    """Rows (id, text, held out) to chunks of ``limit`` tokens."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        ids, held, docs, n = [], [], [], 0
        for batch in batches:
            texts = batch.column(1).cast(pa.binary())
            for i, t, h in zip(batch.column(0), texts, batch.column(2)):
                ids.append(i.as_py())
                held.append(h.as_py())
                docs.append(tokens(t.as_py()))
                n += len(docs[-1])
                if n >= limit:
                    yield _chunk(number, ids, held, docs)
                    number += 1
                    ids, held, docs, n = [], [], [], 0
        if ids:
            yield _chunk(number, ids, held, docs)
    return run


def _hashed(words: np.ndarray, ranges: int, share=np.uint64(0)) -> np.ndarray:
    with np.errstate(over="ignore"):
        return (mix64(words.view(np.uint64) * _MULTIPLIER + share)
                % np.uint64(ranges)).astype(np.int64)


def _dealt(at: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """(range, places) of things whose ranges are ``at``, ranges ascending, places too."""
    order = np.argsort(at, kind="stable")
    cut = np.flatnonzero(np.diff(at[order], prepend=-1))
    for a, b in zip(cut.tolist(), [*cut[1:].tolist(), len(at)]):
        yield int(at[order[a]]), order[a:b]


def _blobs(rows: list[dict] | None) -> dict[int, list[np.ndarray]]:
    return {r["range"]: unpack(r["blob"]) for r in rows or []}


class Slice:
    """A chunk with what it knows of the automaton: ``counts`` of its words (0: unseen)."""

    def __init__(self, row: dict, ranges: int, head: int):
        self.chunk, self.ranges, self.head = row["chunk"], ranges, head
        self.words, _ = unpack(row["words"])
        self.code, = unpack(row["codes"])
        self.lengths = np.array(row["lengths"], dtype=np.int64)
        self.held = np.array(row["held"], dtype=bool)
        self.first = np.cumsum(self.lengths) - self.lengths
        self.before = np.concatenate([self.code[:1], self.code[:-1]])
        self.before[self.first] = int(np.flatnonzero(self.words == END.view(np.int64))[0])
        self.counts = np.zeros(len(self.words), dtype=np.int64)
        totals = _blobs(row["known"])
        for at, places in _dealt(_hashed(self.words, ranges)):
            self.counts[places], = totals[at]

    def pairs(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(state, word, training count) of the distinct pairs, and each token's pair."""
        size = len(self.words)
        key, pair = np.unique(self.before * size + self.code, return_inverse=True)
        train = np.repeat(~self.held, self.lengths)
        return key // size, key % size, np.bincount(pair[train], minlength=len(key)), pair

    def split(self, h: np.ndarray) -> np.ndarray:
        """Whether a state's pairs are split over ranges."""
        return self.counts[h] >= self.head

    def dealt(self, h: np.ndarray, w: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        """(range, places) of the pairs whose state has arcs, sorted by state within a range."""
        some = np.flatnonzero(self.counts[h] > 0)
        h, w = h[some], w[some]
        shares = (1 + self.counts[h] // self.head).astype(np.uint64)
        with np.errstate(over="ignore"):
            share = mix64(self.words[w].view(np.uint64) * _MULTIPLIER) % shares
        for at, places in _dealt(_hashed(self.words[h], self.ranges, share)):
            yield at, some[places]


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for i in range(batch.num_rows):
            yield batch.slice(i, 1).to_pylist()[0]


# -- counting -------------------------------------------------------------------------------

SENT = "range int, chunk bigint, blob binary"
#: kind 0: a blob for a chunk; 1: sums of a range, or of a split state (key); 2: a chunk (key)
#: that has a split state (a)
COUNTED = "kind int, key bigint, range int, blob binary, a bigint, b bigint"


def _sent(chunk: int, parts: list[tuple[int, bytes]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([p[0] for p in parts], pa.int32()), pa.array([chunk] * len(parts), pa.int64()),
         pa.array([p[1] for p in parts], pa.binary())], names=["range", "chunk", "blob"])


def _counted(at: int, rows: list[tuple]) -> pa.Table:
    kind, key, blob, a, b = zip(*rows)
    return pa.table([pa.array(kind, pa.int32()), pa.array(key, pa.int64()),
                     pa.array([at] * len(rows), pa.int32()), pa.array(blob, pa.binary()),
                     pa.array(a, pa.int64()), pa.array(b, pa.int64())],
                    names=["kind", "key", "range", "blob", "a", "b"])


def _group(table: pa.Table) -> tuple[int, list[int], list[list[np.ndarray]]]:
    return (table.column("range")[0].as_py(), table.column("chunk").to_pylist(),
            [unpack(b.as_py()) for b in table.column("blob")])


def _send_words(ranges: int):
    """Chunks (chunk, words) to one blob (words, training counts) for each range."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            words, n = unpack(row["words"])
            yield _sent(row["chunk"], [(at, pack(words[p], n[p]))
                                       for at, p in _dealt(_hashed(words, ranges))])
    return run


def _count_words(table: pa.Table) -> pa.Table:
    at, chunks, sent = _group(table)
    words, back = np.unique(np.concatenate([s[0] for s in sent]), return_inverse=True)
    total = np.zeros(len(words), dtype=np.int64)
    np.add.at(total, back, np.concatenate([s[1] for s in sent]))
    blobs = np.split(total[back], np.cumsum([len(s[0]) for s in sent])[:-1])
    return _counted(at, [(0, c, pack(x), None, None) for c, x in zip(chunks, blobs)]
                    + [(1, None, None, int(total.sum()), int((total > 0).sum()))])


def _send_pairs(ranges: int, head: int):
    """Chunks with their words' counts to one blob of distinct pairs for each range."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            s = Slice(row, ranges, head)
            h, w, n, _ = s.pairs()
            parts = []
            for at, p in s.dealt(h, w):
                states, runs = np.unique(h[p], return_counts=True)
                nexts, place = np.unique(w[p], return_inverse=True)
                parts.append((at, pack(s.words[states], runs, s.split(states),
                                       s.words[nexts] & SHORT, s.counts[nexts], place, n[p])))
            yield _sent(s.chunk, parts)
    return run


def _count_pairs(table: pa.Table) -> pa.Table:
    """Totals of the pairs, arcs and mass of their states, to each chunk that sent them."""
    at, chunks, sent = _group(table)
    states, back = np.unique(np.concatenate([s[0] for s in sent]), return_inverse=True)
    h = np.repeat(back, np.concatenate([s[1] for s in sent]))
    split = np.zeros(len(states), dtype=bool)
    split[back] = np.concatenate([s[2] for s in sent]).astype(bool)
    w, count = (np.concatenate([s[i][s[5]] for s in sent]) for i in (3, 4))
    n = np.concatenate([s[6] for s in sent])
    order = np.lexsort((w, h))
    new = np.ones(len(h), dtype=bool)
    new[1:] = (np.diff(h[order]) != 0) | (np.diff(w[order]) != 0)
    starts = np.flatnonzero(new)
    total = np.add.reduceat(n[order], starts)
    of_pair = np.empty(len(h), dtype=np.int64)
    of_pair[order] = total[np.cumsum(new) - 1]
    seen = order[starts][total > 0]
    arcs = np.bincount(h[seen], minlength=len(states))
    mass = np.zeros(len(states), dtype=np.int64)
    np.add.at(mass, h[seen], count[seen] + 1)
    rows = []
    of_state = np.split(back, np.cumsum([len(s[0]) for s in sent])[:-1])
    for c, x, own in zip(chunks, np.split(of_pair, np.cumsum([len(s[6]) for s in sent])[:-1]), of_state):
        rows.append((0, c, pack(x, arcs[own], mass[own]), None, None))
        rows += [(2, c, None, int(states[j]), None) for j in own[split[own]]]
    rows += [(1, int(states[j]), None, int(arcs[j]), int(mass[j])) for j in np.flatnonzero(split)]
    return _counted(at, rows)


# -- reading texts --------------------------------------------------------------------------

SCORES = ("doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, base double, "
          "score double")


def _read(ranges: int, head: int, mass: int):
    """Chunks with their slices to SCORES: the texts are read from left to right."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            s = Slice(row, ranges, head)
            h, w, _, pair = s.pairs()
            n = np.zeros(len(h), dtype=np.int64)
            arcs, arc_mass = np.zeros((2, len(s.words)), dtype=np.int64)
            totals = _blobs(row["totals"])
            for at, p in s.dealt(h, w):
                n[p], of_state, mass_of_state = totals.pop(at)
                states = np.unique(h[p])
                arcs[states], arc_mass[states] = of_state, mass_of_state
            if row["split"]:
                word = np.array([x["word"] for x in row["split"]], dtype=np.int64)
                by = np.argsort(s.words)
                own = by[np.searchsorted(s.words, word, sorter=by)]
                arcs[own] = [x["arcs"] for x in row["split"]]
                arc_mass[own] = [x["mass"] for x in row["split"]]
            own = np.log10(s.counts + 1.0) - np.log10(float(mass))
            with np.errstate(divide="ignore", invalid="ignore"):
                fail = np.log10(DISCOUNT * arcs / s.counts) - np.log10(1.0 - arc_mass / mass)
                fail = np.where(arcs > 0, fail, 0.0)
                arc = np.log10(n - DISCOUNT) - np.log10(s.counts[h])
            step = np.where(n > 0, arc, fail[h] + own[w])[pair]
            yield pa.RecordBatch.from_arrays(
                [pa.array(row["ids"], pa.int64()), pa.array(s.held), pa.array(s.lengths),
                 pa.array(np.add.reduceat((s.counts > 0).astype(np.int64)[s.code], s.first)),
                 pa.array(np.add.reduceat(own[s.code], s.first)),
                 pa.array(np.add.reduceat(step, s.first))],
                names=["doc_id", "held_out", "n_tokens", "n_known", "base", "score"])
    return run


def score(docs: DataFrame, train: Column, *, id_col: str = "doc_id",
          text_col: str = "text") -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, row by row.

    Learns from the rows where ``train`` is true; ``held_out`` is its opposite (a null condition
    trains).  A null text is an empty one: its only token is the end mark.  Rows that repeat get
    equal scores each and count each in training.  Without training documents every token is
    unseen and has probability 1.  Other columns are not read.  An empty table gives no rows.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).cast("bigint").alias("i"),
                       F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("t"),
                       (~F.coalesce(train, F.lit(True))).alias("h"))
    chunks = written(spark, rows.mapInArrow(_chunks(CHUNK), CHUNKS), "lm-chunks")
    size = chunks.select(F.expr("aggregate(lengths, 0L, (a, x) -> a + x)").alias("n")) \
        .agg(F.sum("n")).first()[0] or 0
    ranges = max(1, -(-size // RANGE))

    def replies(counted: DataFrame, name: str) -> DataFrame:
        return counted.where("kind = 0").groupBy(F.col("key").alias("chunk")).agg(
            F.collect_list(F.struct("range", "blob")).alias(name))

    words = written(spark, chunks.select("chunk", "words").mapInArrow(_send_words(ranges), SENT)
                    .groupBy("range").applyInArrow(_count_words, COUNTED), "lm-words")
    total, types = words.where("kind = 1").agg(F.sum("a"), F.sum("b")).first()
    total, types = total or 0, types or 0
    known = chunks.join(replies(words, "known"), "chunk")
    pairs = written(spark, known.mapInArrow(_send_pairs(ranges, HEAD), SENT)
                    .groupBy("range").applyInArrow(_count_pairs, COUNTED), "lm-pairs")
    # states that are split: their sums, to the chunks that have them
    sums = pairs.where("kind = 1").groupBy(F.col("key").alias("word")).agg(
        F.sum("a").alias("arcs"), F.sum("b").alias("mass"))
    split = pairs.where("kind = 2").select(F.col("key").alias("chunk"), F.col("a").alias("word")) \
        .distinct().join(sums, "word").groupBy("chunk").agg(
            F.collect_list(F.struct("word", "arcs", "mass")).alias("split"))
    scored = known.join(replies(pairs, "totals"), "chunk", "left").join(split, "chunk", "left") \
        .mapInArrow(_read(ranges, HEAD, total + types + 1), SCORES)
    return scored.select(
        F.col("doc_id").alias(id_col), "held_out", "n_tokens", "n_known",
        F.lit(total).cast("bigint").alias("train_tokens"), F.col("base").alias("base_score"), "score")


def op10_lm_score(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return score(docs, remainder("doc_id", 7) != 2)
