"""Similarity join of documents on word shingles by T-occurrence search (DivideSkip).

Two shingle sets of sizes n and m with Jaccard similarity s or more share at least
``T = ceil(s (n + m) / (1 + s))`` shingles, never fewer than ``ceil(s n)``.  So of a set's
inverted lists all but ``ceil(s n) - 1`` (the longest) have to be merged: every partner occurs in
one of the short lists.  The order that tells short from long lists is global: shingles with few
frequent words come first (chance hardly repeats them), and shingles that are frequent
themselves, like those of shared passages, come last.

1. Every document becomes its sorted shingle keys; equal sets form one class, and the search is
   among classes.  Keys of the short lists are the class's ``short`` array (about a tenth).
2. The short lists are built by key.  A list's least class is its head; all lists with the same
   head form a block, which holds every pair of their members.  Blocks that are large in rows or
   bytes are cut into chunks.
3. In a block the short lists are merged.  Counts of shared short keys bound the overlap from
   above; pairs that can still reach T join a group.  Classes without such a partner, nearly
   all that merely share a passage, end here.
4. Groups get the whole sets: DivideSkip merges a set's short lists by heap, probes the long ones
   by binary search, and links pairs that reach T.  Pairs already connected are skipped, so a
   group of near copies gives a spanning tree, not all its pairs.
5. Chunks of one block have not met each other.  Where they hold more than one component, the
   classes outside the block's largest component meet all chunks of the block (steps 3 and 4).

Links are exact; frequent words and shingles are found on a sample, which only decides the order.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .components import connected_components
from .storage import written
from .texts import mix64, shingle_hashes, word_hashes

#: documents in the sample that finds frequent words and shingles, the share of them that makes
#: a shingle frequent, and the most of each that are held
SAMPLE_DOCS = 5000
FREQUENT_SHARE = 0.001
FREQUENT_WORDS = 20_000
FREQUENT_SHINGLES = 1 << 16
#: classes and shingles that one block holds
BLOCK_CLASSES = 1500
BLOCK_SHINGLES = 4 << 20
#: total length of short lists up to which they are merged by heap, beyond it by sorting
HEAP_MERGE = 256

_HASH_BITS = 58
_HEAVY = 1 << 62


# --- sets ---------------------------------------------------------------------------------------
class Order:
    """The global order of shingles: by the number of frequent words in them, then by hash;
    frequent shingles come last, by frequency.  Built from bounded samples, held by every task."""

    def __init__(self, words: np.ndarray, keys: np.ndarray, counts: np.ndarray):
        rank = np.empty(len(keys), dtype=np.int64)
        rank[np.lexsort((keys, counts))] = np.arange(len(keys))
        order = np.argsort(keys)
        self.words, self.keys, self.rank = np.sort(words), keys[order], rank[order]


def _member(values: np.ndarray, ascending: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which values are among ``ascending``, and where."""
    if not len(ascending):
        return np.zeros(len(values), dtype=bool), np.zeros(len(values), dtype=np.int64)
    at = np.minimum(np.searchsorted(ascending, values), len(ascending) - 1)
    return ascending[at] == values, at


def shingle_keys(text: bytes, k: int, order: Order) -> np.ndarray:
    """A text's distinct shingles as ascending int64 keys in the global order."""
    words = word_hashes(text)
    hashes = shingle_hashes(words, k)
    if not len(hashes):
        return np.empty(0, dtype=np.int64)
    known = np.concatenate([[0], np.cumsum(_member(words, order.words)[0])])
    n_known = known[len(words) - len(hashes) + 1:] - known[:len(hashes)]
    keys = np.unique((np.minimum(n_known, 15) << _HASH_BITS)
                     | (hashes >> np.uint64(64 - _HASH_BITS)).astype(np.int64))
    hit, at = _member(keys, order.keys)
    if hit.any():
        keys[hit] = _HEAVY + order.rank[at[hit]]
        keys.sort()
    return keys


def set_digest(keys: np.ndarray) -> bytes | None:
    """128-bit digest of a set of keys; None for the empty set."""
    if not len(keys):
        return None
    u = keys.astype(np.uint64) + np.uint64(1)
    with np.errstate(over="ignore"):
        return b"".join(np.sum(mix64(u * np.uint64(c))).tobytes()
                        for c in (0x9E3779B97F4A7C15, 0xD1B54A32D192ED03))


def least_overlap(n: int, m: int, percent: int) -> int:
    """The smallest intersection of sets of n and m elements with 100 |i| >= percent |u|."""
    return -(-percent * (n + m) // (100 + percent))


def n_short(n: int, percent: int) -> int:
    return n - -(-percent * n // 100) + 1


ROWS = "doc_id bigint, n int, cls binary, short array<bigint>"


def _texts(batch: pa.RecordBatch, column: int) -> Iterator[bytes]:
    return (t.as_py() for t in pc.fill_null(batch.column(column), "").cast(pa.binary()))


def sampled_order(docs: DataFrame, k: int) -> Order:
    """The order from a sample of documents: its most frequent words, then the shingles that many
    of its documents share (a bounded number of both)."""
    n = docs.count()
    share = min(1.0, SAMPLE_DOCS / n) if n else 1.0
    draw = F.pmod(F.xxhash64(F.lit("shingle sample"), "i"), F.lit(1 << 30)) / float(1 << 30)
    sample = docs.where(draw < share).select("t")

    def top(values, least: int, most: int) -> pa.Table:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for t in _texts(batch, 0):
                    yield pa.RecordBatch.from_arrays([pa.array(values(t))], names=["s"])

        return sample.mapInArrow(run, "s bigint").groupBy("s").agg(F.count("*").alias("c")) \
            .where(F.col("c") >= least).orderBy(F.desc("c"), "s").limit(most).toArrow()

    none = np.empty(0, dtype=np.int64)
    words = top(lambda t: np.unique(word_hashes(t)).view(np.int64), 2, FREQUENT_WORDS) \
        .column("s").to_numpy().view(np.uint64)
    bare = Order(words, none, none)
    found = top(lambda t: shingle_keys(t, k, bare),
                max(4, int(FREQUENT_SHARE * min(n, SAMPLE_DOCS))), FREQUENT_SHINGLES)
    return Order(words, found.column("s").to_numpy(), found.column("c").to_numpy())


def set_rows(docs: DataFrame, k: int, percent: int, order) -> DataFrame:
    """doc_id, n, cls (128-bit digest of the set), short; an empty set has a null class."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = order.value
        for batch in batches:
            n, cls, short = [], [], []
            for t in _texts(batch, 1):
                keys = shingle_keys(t, k, held)
                n.append(len(keys))
                cls.append(set_digest(keys))
                short.append(keys[:n_short(len(keys), percent)])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int32()), pa.array(cls, pa.binary()),
                 _lists(short)], names=["doc_id", "n", "cls", "short"])

    return docs.select("i", "t").mapInArrow(run, ROWS)


def _lists(arrays: list[np.ndarray]) -> pa.ListArray:
    ends = np.cumsum([len(a) for a in arrays])
    return pa.ListArray.from_arrays(
        np.concatenate([[0], ends]).astype(np.int32),
        pa.array(np.concatenate(arrays) if arrays else np.empty(0), pa.int64()))


# --- search within a task -----------------------------------------------------------------------
class Groups:
    """Union-find over 0 .. n-1, starting from given labels."""

    def __init__(self, labels: np.ndarray):
        _, first, inverse = np.unique(labels, return_index=True, return_inverse=True)
        self.up = first[inverse].tolist()
        self.parts = len(first)

    def find(self, x: int) -> int:
        while self.up[x] != x:
            self.up[x] = self.up[self.up[x]]
            x = self.up[x]
        return x

    def join(self, a: int, b: int) -> None:
        a, b = self.find(a), self.find(b)
        if a != b:
            self.up[max(a, b)] = min(a, b)
            self.parts -= 1


def inverted_lists(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(keys, begin, members): the sets that hold each key, ascending; keys in one set are left out."""
    keys = np.concatenate(sets)
    member = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    order = np.argsort(keys, kind="stable")
    keys, member = keys[order], member[order]
    new = np.flatnonzero(np.diff(keys, prepend=keys[:1] - 1))
    length = np.diff(np.append(new, len(keys)))
    more = length > 1
    begin = np.concatenate([[0], np.cumsum(length[more])])
    return keys[new[more]], begin, member[np.repeat(more, length)]


def _lists_of(s: np.ndarray, keys: np.ndarray) -> np.ndarray:
    if not len(keys):
        return np.empty(0, dtype=np.int64)
    at = np.minimum(np.searchsorted(keys, s), len(keys) - 1)
    return at[keys[at] == s]


def short_groups(n: np.ndarray, short: list[np.ndarray], labels: np.ndarray,
                 percent: int) -> Groups:
    """Groups of classes that the merged short lists leave as possible partners.

    ``short`` may hold 32-bit forms in which different keys are equal: then more count as shared
    and the keys equal to the end of what both sides list do not count as seen, so the bound
    never excludes a pair that reaches the overlap.
    """
    groups = Groups(labels)
    keys, begin, member = inverted_lists(short)
    last = np.array([int(s[-1]) if len(s) < m else np.iinfo(np.int64).max
                     for s, m in zip(short, n)])
    for x in range(len(short)):
        if groups.parts == 1:
            break
        lists = _lists_of(short[x], keys)
        if not len(lists):
            continue
        occurs = np.concatenate([member[begin[i]:begin[i + 1]] for i in lists])
        found, shared = np.unique(occurs[occurs < x], return_counts=True)
        need = -(-percent * (n[x] + n[found]) // (100 + percent))
        # of x's keys before the end of what both sides list, those not shared are missing
        seen = np.searchsorted(short[x], np.minimum(last[x], last[found]), side="left")
        ok = (need <= np.minimum(n[x], n[found])) & (seen - shared <= n[x] - need)
        for y, k, t in zip(found[ok].tolist(), shared[ok].tolist(), need[ok].tolist()):
            if groups.find(x) == groups.find(y):
                continue
            seen_y = int(np.searchsorted(short[y], min(last[x], last[y]), side="left"))
            if seen_y - k <= n[y] - t:
                groups.join(x, y)
    return groups


def _merged(lists: list[list[int]]) -> Iterator[int]:
    """Distinct members of sorted lists, by a heap of the lists' heads."""
    heap = [(x[0], i, 0) for i, x in enumerate(lists)]
    heapq.heapify(heap)
    before = -1
    while heap:
        y, i, at = heap[0]
        if y != before:
            yield y
            before = y
        if at + 1 < len(lists[i]):
            heapq.heapreplace(heap, (lists[i][at + 1], i, at + 1))
        else:
            heapq.heappop(heap)


def divide_skip(sets: list[np.ndarray], labels: np.ndarray, percent: int) -> list[tuple[int, int]]:
    """Links between sets of different labels that span all components of the link graph.

    For each set: its inverted lists, the ``ceil(s n) - 1`` longest aside, are merged; for what
    occurs in them the remaining keys are probed by binary search, and a pair that reaches the
    required overlap is linked.
    """
    groups, links = Groups(labels), []
    keys, begin, member = inverted_lists(sets)
    for x, s in enumerate(sets):
        if groups.parts == 1:
            break
        lists = _lists_of(s, keys)
        aside = -(-percent * len(s) // 100) - 1
        # keys in no other set count as lists of length zero: they are the shortest
        merge = max(0, len(lists) - aside)
        if not merge:
            continue
        size = begin[lists + 1] - begin[lists]
        some = lists[np.argsort(size, kind="stable")[:merge]]
        parts = [member[begin[i]:begin[i + 1]] for i in some]
        if sum(map(len, parts)) <= HEAP_MERGE:
            found = _merged([p.tolist() for p in parts])
        else:
            found = np.unique(np.concatenate(parts)).tolist()
        for y in found:
            if y >= x:
                break
            if groups.find(x) == groups.find(y):
                continue
            need = least_overlap(len(s), len(sets[y]), percent)
            if need > min(len(s), len(sets[y])):
                continue
            small, large = sorted((s, sets[y]), key=len)
            at = np.minimum(np.searchsorted(large, small), len(large) - 1)
            if int((large[at] == small).sum()) >= need:
                links.append((x, y))
                groups.join(x, y)
    return links


def _runs(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Rows with equal keys, which lie together, as one table each."""
    held: list[pa.RecordBatch] = []
    at = None
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch.column(k).to_pylist() for k in keys]
        marks = list(zip(*columns))
        begin = 0
        for i in range(1, len(marks) + 1):
            if i < len(marks) and marks[i] == marks[begin]:
                continue
            if held and marks[begin] != at:
                yield pa.Table.from_batches(held)
                held = []
            at = marks[begin]
            held.append(batch.slice(begin, i - begin))
            begin = i
    if held:
        yield pa.Table.from_batches(held)


def _arrays(column: pa.ChunkedArray) -> list[np.ndarray]:
    return [x.values.to_numpy() for c in column.chunks for x in c]


def brief(short: Column) -> Column:
    """Short keys in 32 bits for the blocks, in the same order (different keys may become equal,
    which only weakens the bound): frequent shingles' ranks, below them the others' first bits."""
    return F.transform(short, lambda x: F.when(x >= _HEAVY, x - _HEAVY).otherwise(
        F.shiftright(x, 31) - (1 << 31)).cast("int"))


def _block_groups(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in _runs(batches, ["head", "chunk"]):
            if block.num_rows < 2:
                continue
            cid = block.column("cid").to_numpy()
            label = block.column("label").to_numpy()
            groups = short_groups(block.column("n").to_numpy().astype(np.int64),
                                  _arrays(block.column("short")), label, percent)
            root = np.array([groups.find(i) for i in range(len(cid))])
            out_group, out_cid, out_label = [], [], []
            for r, n in zip(*np.unique(root, return_counts=True)):
                some = np.flatnonzero(root == r)
                if n < 2 or len(np.unique(label[some])) < 2:
                    continue
                out_group += [set_digest(cid[some])] * n
                out_cid += cid[some].tolist()
                out_label += label[some].tolist()
            if out_cid:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(out_group, pa.binary()), pa.array(out_cid, pa.int64()),
                     pa.array(out_label, pa.int64())], names=["grp", "cid", "label"])

    return run


def _group_links(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _runs(batches, ["grp"]):
            cid = group.column("cid").to_numpy()
            links = divide_skip(_arrays(group.column("keys")), group.column("label").to_numpy(),
                                percent)
            if links:
                a, b = zip(*links)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(cid[list(a)]), pa.array(cid[list(b)])], names=["a", "b"])

    return run


# --- the join -----------------------------------------------------------------------------------
class _Join:
    def __init__(self, spark: SparkSession, docs: DataFrame, k: int, percent: int):
        self.spark, self.docs, self.k, self.percent = spark, docs, k, percent
        self.partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.order = spark.sparkContext.broadcast(sampled_order(docs, k))

    def together(self, rows: DataFrame, *keys: str) -> DataFrame:
        return rows.repartition(self.partitions, *keys).sortWithinPartitions(*keys)

    def links(self, blocks: DataFrame, classes: DataFrame) -> DataFrame:
        """Links (a, b) within blocks: rows (head, chunk, cid, label, n, short)."""
        found = self.together(blocks, "head", "chunk").mapInArrow(
            _block_groups(self.percent), "grp binary, cid bigint, label bigint")
        # blocks with the same members give the same group
        groups = written(self.spark, found.dropDuplicates(["grp", "cid"]), "groups")
        wanted = groups.select("cid").distinct().join(classes.select("cid", "rep", "cls"), "cid")
        k, order = self.k, self.order

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held = order.value
            for batch in batches:
                keys = [shingle_keys(t, k, held) for t in _texts(batch, 2)]
                # an id that repeats with another text brings another set: the class tells
                own = [set_digest(s) == c for s, c in zip(keys, batch.column(1).to_pylist())]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).filter(pa.array(own, pa.bool_())),
                     _lists([s for s, o in zip(keys, own) if o])], names=["cid", "keys"])

        texts = self.docs.join(wanted, F.col("i") == F.col("rep")).select("cid", "cls", "t")
        sets = written(self.spark, texts.mapInArrow(run, "cid bigint, keys array<bigint>"),
                       "sets")
        if self.repeated:
            sets = sets.dropDuplicates(["cid"])
        return self.together(groups.join(sets, "cid"), "grp").mapInArrow(
            _group_links(self.percent), "a bigint, b bigint")

    def run(self) -> DataFrame:
        spark = self.spark
        rows = written(spark, set_rows(self.docs, self.k, self.percent, self.order), "rows")
        known = rows.where("cls is not null and doc_id is not null")
        self.repeated = not known.groupBy("doc_id").count().where("count > 1").isEmpty()
        classes = written(spark, known.groupBy("cls").agg(
            F.min("doc_id").alias("rep"), F.first("n").alias("n"), F.first("short").alias("short"))
            .withColumn("cid", F.monotonically_increasing_id()), "classes")
        lists = classes.select(F.explode("short").alias("key"), "cid")
        heads = lists.groupBy("key").agg(F.min("cid").alias("head"), F.count("*").alias("c")) \
            .where("c > 1").select("key", "head")
        stars = written(spark, lists.join(heads, "key").select("head", "cid").distinct()
                        .join(classes.select("cid", "n"), "cid"), "stars")
        sizes = stars.groupBy("head").agg(F.count("*").alias("c"), F.sum("n").alias("s"))
        chunks = F.greatest(F.ceil(F.col("c") / BLOCK_CLASSES),
                            F.ceil(F.col("s") / BLOCK_SHINGLES)).cast("int")
        large = written(spark, sizes.select("head", chunks.alias("chunks")).where("chunks > 1"),
                        "large-blocks")
        # in a block that stays whole, a class whose neighbours by size are too small or too
        # large for it has no partner
        by_size = Window.partitionBy("head").orderBy("n", "cid")
        near = (F.lag("n").over(by_size) * 100 >= F.col("n") * self.percent) | (
            F.col("n") * 100 >= F.lead("n").over(by_size) * self.percent)
        whole = stars.join(large, "head", "left_anti").withColumn("near", near).where("near") \
            .select("head", F.lit(0).alias("chunk"), "cid", F.lit(None).cast("int").alias("chunks"))
        member = stars.join(large, "head").select(
            "head", F.pmod(F.xxhash64("cid"), F.col("chunks")).cast("int").alias("chunk"), "cid",
            "chunks").unionByName(whole)
        with_short = member.join(classes.select("cid", "n", brief(F.col("short")).alias("short")),
                                 "cid")
        links = written(spark, self.links(
            with_short.select("head", "chunk", "cid", F.col("cid").alias("label"), "n", "short"),
            classes), "links")
        parts = written(spark, connected_components(links), "parts")
        if not large.isEmpty():
            more = self.across_chunks(member.where("chunks > 1"), classes, parts)
            if more is not None:
                links = links.unionByName(more)
                parts = written(spark, connected_components(links), "parts")
        placed = classes.select("cls", "cid", "rep").join(
            parts.withColumnRenamed("node", "cid"), "cid", "left").select(
            "cls", "rep", F.coalesce("root", "cid").alias("root"))
        least = placed.groupBy("root").agg(F.min("rep").alias("component_id"))
        of_class = placed.join(least, "root").select("cls", "component_id")
        size = F.col("n").cast("bigint").alias("n_shingles")
        alone = rows.where("cls is null").select("doc_id", size,
                                                 F.col("doc_id").alias("component_id"))
        return rows.where("cls is not null").select("doc_id", "n", "cls") \
            .join(of_class, "cls", "left").select(
            "doc_id", size, F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id"))
            .alias("component_id")).unionByName(alone)

    def across_chunks(self, member: DataFrame, classes: DataFrame,
                      parts: DataFrame) -> DataFrame | None:
        """Links between chunks of one block that the chunks' own searches could not see."""
        spark = self.spark
        labelled = written(spark, member.join(
            parts.withColumnRenamed("node", "cid"), "cid", "left").select(
            "head", "chunk", "cid", F.coalesce("root", "cid").alias("label")), "labelled")
        main = labelled.groupBy("head", "label").agg(F.count("*").alias("c")).groupBy("head").agg(
            F.max_by("label", F.struct("c", "label")).alias("main"))
        outside = labelled.join(main, "head").where("label <> main").drop("main")
        if outside.isEmpty():
            return None
        # each chunk of outsiders meets each chunk of the block; the pair of chunks is the key
        asking = outside.select("head", F.col("chunk").alias("from")).distinct()
        asked = labelled.select("head", F.col("chunk").alias("to")).distinct()
        pairs = asking.join(asked, "head").where(F.col("from") != F.col("to")).select(
            F.col("head").alias("h"), "from", "to",
            F.concat_ws("-", "from", "to").alias("name"))
        left, right = (some.join(pairs, (F.col("head") == F.col("h"))
                                 & (F.col("chunk") == F.col(side))).select(
            "head", F.col("name").alias("chunk"), "cid", "label")
            for some, side in ((outside, "from"), (labelled, "to")))
        rows = left.unionByName(right).join(
            classes.select("cid", "n", brief(F.col("short")).alias("short")), "cid")
        return written(spark, self.links(
            rows.select("head", "chunk", "cid", "label", "n", "short"), classes), "more-links")


def components(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", words: int = 5,
               percent: int = 80) -> DataFrame:
    """doc_id, n_shingles, component_id (the least id reachable by links), row by row.

    Documents link when ``100 * shared shingles >= percent * all shingles of both``.  A text with
    fewer than ``words`` words is one shingle; a null, empty or blank text has none and is linked
    with nothing.  A row with a null id takes part in no link and has a null component.  Rows
    that repeat an id count each, with their own set; their links meet in the shared id only as
    far as their sets link.  Other columns are not read.  An empty table gives no rows.
    """
    if not 0 < percent <= 100:
        raise ValueError("percent must be 1 to 100")
    source = docs.select(F.col(id_col).cast("bigint").alias("i"),
                         F.col(text_col).cast("string").alias("t"))
    return _Join(docs.sparkSession, source, words, percent).run().withColumnRenamed(
        "doc_id", id_col)


def op5_jaccard_join(spark, sf_dir: str) -> DataFrame:
    return components(spark.read.parquet(f"{sf_dir}/documents.parquet"), words=3, percent=90)


ORACLE_SQL = """
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) END AS s
  FROM words),
members AS (SELECT doc_id, len(s) AS n, unnest(s) AS shingle FROM sets),
links AS (
  SELECT a.doc_id AS x, b.doc_id AS y FROM members a JOIN members b USING (shingle)
  WHERE a.doc_id <> b.doc_id GROUP BY a.doc_id, b.doc_id, a.n, b.n
  HAVING 100 * count(*) >= 90 * (a.n + b.n - count(*))),
reach AS (
  SELECT doc_id AS x, doc_id AS y FROM sets
  UNION SELECT r.x, l.y FROM reach r JOIN links l ON l.x = r.y)
SELECT s.doc_id, len(s.s)::BIGINT AS n_shingles, min(r.y) AS component_id
FROM sets s JOIN reach r ON r.x = s.doc_id GROUP BY s.doc_id, s.s
"""
