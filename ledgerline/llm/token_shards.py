"""Token ids as raw binary shards with a minimal-perfect-hash index for keyed access.

A shard is two files: ``.ids`` has nothing but the ids of its documents one after the other
(little-endian, two bytes an id while the vocabulary allows, else four), ``.idx`` maps a
document key to its place.  The index is a minimal perfect hash function: level by level the
keys hash into a bit array, a key that is alone on its bit is settled there, the others go to
the next level; a settled key's number is the count of set bits before its own.  That number
leads to a stored fingerprint (so that a key that is not in the shard is found out), an offset
and a length.  A lookup reads a constant number of words, however large the shard is.

Documents lie in ascending id order over all shards: Spark deals them into ranges, each task
streams its range into files of at most ``SHARD_IDS`` ids and renames them when they are whole,
so a task that runs twice leaves the same files once.
"""

from __future__ import annotations

import json
import struct
import unicodedata
import uuid
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.dataset as ds
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .storage import new_folder
from .texts import mix64

MAGIC = b"LLTOKIX1"
#: a shard is closed when it has this many ids
SHARD_IDS = 8 << 20
#: UTF-8 bytes of text that one range of ids is planned for
RANGE_BYTES = 12 << 20
#: words whose ids a worker remembers; a dict of that many just fills its table
CACHE_WORDS = 690_000
#: ids of neighbouring documents that one read of a payload takes
RUN_IDS = 2 << 20
#: marks that may end a word, each a piece of its own
MARKS = frozenset(".,;:!?")
_GOLD = np.uint64(0x9E3779B97F4A7C15)


# --- minimal perfect hash -----------------------------------------------------------------------
def key_hash(ids: np.ndarray, ordinals: np.ndarray) -> np.ndarray:
    """64-bit hash of (document id, number of the row among those that repeat the id)."""
    with np.errstate(over="ignore"):
        return mix64(ids.astype(np.int64).view(np.uint64) * _GOLD
                     + mix64(ordinals.astype(np.uint64) + np.uint64(1)))


def _place(keys: np.ndarray, level: int, size: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return mix64(keys + np.uint64(level + 1) * _GOLD) % np.uint64(size)


class PerfectHash:
    """Maps n distinct 64-bit keys to 0 .. n-1; other keys to any of these or to -1."""

    def __init__(self, sizes: list[int], words: np.ndarray):
        self.sizes, self.words = sizes, words
        ones = np.bitwise_count(words).astype(np.int64)
        self.before = np.concatenate([[0], np.cumsum(ones)])

    @classmethod
    def build(cls, keys: np.ndarray) -> PerfectHash:
        sizes, parts, left = [], [], np.asarray(keys, dtype=np.uint64)
        while len(left):
            if len(sizes) == 64:
                raise ValueError("two keys share their 64-bit hash")
            size = -(-2 * len(left) // 64) * 64
            at = _place(left, len(sizes), size).astype(np.int64)
            alone = np.bincount(at, minlength=size) == 1
            bits = np.packbits(alone, bitorder="little").view("<u8")
            left = left[~alone[at]]
            sizes.append(size)
            parts.append(bits)
        return cls(sizes, np.concatenate(parts) if parts else np.empty(0, dtype="<u8"))

    def __call__(self, keys: np.ndarray) -> np.ndarray:
        out = np.full(len(keys), -1, dtype=np.int64)
        todo, base = np.arange(len(keys)), 0
        for level, size in enumerate(self.sizes):
            at = _place(keys[todo], level, size).astype(np.int64) + base
            word, bit = self.words[at >> 6], (at & 63).astype(np.uint64)
            hit = (word >> bit) & np.uint64(1) == 1
            under = word[hit] & ((np.uint64(1) << bit[hit]) - np.uint64(1))
            out[todo[hit]] = self.before[at[hit] >> 6] + np.bitwise_count(under)
            todo, base = todo[~hit], base + size
            if not len(todo):
                break
        return out


def _fingerprint(keys: np.ndarray) -> np.ndarray:
    return (mix64(keys ^ _GOLD) >> np.uint64(32)).astype("<u4")


def pack_index(ids: np.ndarray, ordinals: np.ndarray, lengths: np.ndarray, width: int) -> bytes:
    """The ``.idx`` file of documents whose ids lie one after the other."""
    keys = key_hash(ids, ordinals)
    phf = PerfectHash.build(keys)
    slot = phf(keys)
    offsets = np.concatenate([[0], np.cumsum(lengths)[:-1]]) if len(lengths) else lengths
    cells = [np.empty(len(keys), dtype=t) for t in ("<u4", "<u8", "<u4")]
    for cell, value in zip(cells, (_fingerprint(keys), offsets, lengths)):
        cell[slot] = value
    head = json.dumps({"n": len(keys), "n_ids": int(np.sum(lengths)), "width": width,
                       "levels": phf.sizes}).encode()
    return b"".join([MAGIC, struct.pack("<I", len(head)), head, phf.words.tobytes(),
                     *[c.tobytes() for c in cells]])


class Index:
    """A loaded ``.idx`` file."""

    def __init__(self, raw: bytes):
        if raw[:8] != MAGIC:
            raise ValueError("not a token index")
        size, = struct.unpack_from("<I", raw, 8)
        head = json.loads(raw[12:12 + size])
        self.n, self.n_ids, self.width = head["n"], head["n_ids"], head["width"]
        at = 12 + size
        words = np.frombuffer(raw, "<u8", sum(head["levels"]) // 64, at)
        at += words.nbytes
        self.phf = PerfectHash(head["levels"], words)
        self.fingerprints = np.frombuffer(raw, "<u4", self.n, at)
        self.offsets = np.frombuffer(raw, "<u8", self.n, at + 4 * self.n)
        self.lengths = np.frombuffer(raw, "<u4", self.n, at + 12 * self.n)

    def find(self, ids: np.ndarray, ordinals: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Offsets and lengths, in ids; offset -1 for a key that is not in the shard."""
        keys = key_hash(ids, ordinals)
        slot = self.phf(keys)
        known = slot >= 0
        known[known] = self.fingerprints[slot[known]] == _fingerprint(keys[known])
        slot = np.where(known, slot, 0)
        if not self.n:
            return np.full(len(keys), -1), np.zeros(len(keys), dtype=np.int64)
        return (np.where(known, self.offsets[slot].astype(np.int64), -1),
                np.where(known, self.lengths[slot].astype(np.int64), 0))


# --- encoding -----------------------------------------------------------------------------------
_ENCODERS: dict[tuple[str, int], WordEncoder] = {}


class WordEncoder:
    """Ids of whole texts as bytes, by the tokenizers library, remembering words.

    The tokenizer must drop white space and treat words apart (``word_bpe_49k.json`` does).  A
    text is cut at blanks, tabs and line ends only; what else counts as white space is left to
    the library.  A word of letters is one piece whose normal form is its lower case, so its
    merges run directly, remembered for all spellings; a mark at its end is a piece of its own.
    Every other word takes the library's whole way.
    """

    def __init__(self, path: str, width: int):
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.code = {2: "H", 4: "I"}[width]
        self.known = _Known(self.learn)
        self.pieces = _Known(self._merge)
        self.letters: dict[str, str] = {}
        self._tokenize = self.tokenizer.model.tokenize

    def _letter(self, c: str) -> str:
        """A letter as the library's byte alphabet writes it."""
        if c not in self.letters:
            self.letters[c] = self.tokenizer.pre_tokenizer.pre_tokenize_str(c)[0][0]
        return self.letters[c]

    def _merge(self, piece: str) -> bytes:
        """The ids of a piece in its normal form."""
        spelled = piece if piece.isascii() else "".join(map(self._letter, piece))
        ids = self.pieces[piece] = self._pack([t.id for t in self._tokenize(spelled)])
        return ids

    def _pack(self, ids: list[int]) -> bytes:
        return struct.pack(f"<{len(ids)}{self.code}", *ids)

    def learn(self, w: str) -> bytes:
        """The ids of a word that is not remembered yet."""
        if len(self.known) >= CACHE_WORDS:
            self.known.clear()
            self.pieces.clear()
        mark = w[-1:]
        if mark in MARKS:
            core = w[:-1]
        else:
            core, mark = w, ""
        low = None
        if core.isalpha():
            if core.isascii():
                low = core.lower()
            # composed letters only; sigma's lower case depends on its place
            elif "\u03a3" not in core and unicodedata.is_normalized("NFC", core):
                low = core.lower()
                if not low.isalpha():
                    low = None
        if low is None:
            ids = self._pack(self.tokenizer.encode(w, add_special_tokens=False).ids)
        else:
            ids = self.pieces[low]
            if mark:
                ids += self.pieces[mark]
        self.known[w] = ids
        return ids

    def encode(self, text: str) -> bytes:
        words = text.replace("\n", " ").replace("\t", " ").replace("\r", " ").split(" ")
        return b"".join(map(self.known.__getitem__, words))


class _Known(dict):
    """Words or pieces and their ids; one that is missing is learnt."""

    def __init__(self, learn: Callable[[str], bytes]):
        super().__init__()
        self.learn = learn

    def __missing__(self, w: str) -> bytes:
        return self.learn(w)


def _encoder(path: str, width: int) -> WordEncoder:
    import os
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    if (path, width) not in _ENCODERS:
        _ENCODERS[path, width] = WordEncoder(path, width)
    return _ENCODERS[path, width]


# --- writing ------------------------------------------------------------------------------------
def _uri(folder: str) -> str:
    """A folder as a URI: a bare path or Hadoop's ``file:/x`` is a local file's."""
    if "://" in folder:
        return folder
    return "file://" + folder.removeprefix("file:")


def _filesystem(folder: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(folder)


class _Writer:
    """Streams one task's documents into shards."""

    def __init__(self, folder: str, part: int, width: int):
        self.fs, self.folder = _filesystem(folder)
        self.part, self.seq, self.width = part, 0, width
        self.mark = uuid.uuid4().hex[:8]
        self.out = None

    def _name(self, kind: str, mark: str = "") -> str:
        return f"{self.folder}/shard-{self.part:06d}-{self.seq:04d}.{kind}{mark}"

    def add(self, doc_id: int, raw: bytes) -> tuple[int, int]:
        """(ordinal, seq) of the document."""
        if self.out is None:
            self.out = self.fs.open_output_stream(self._name("ids", "." + self.mark))
            self.ids, self.ordinals, self.lengths, self.repeats = [], [], [], {}
            self.n_ids = 0
        ordinal = 0
        if self.ids and self.ids[-1] == doc_id:      # ids arrive in order
            ordinal = self.ordinals[-1] + 1
        self.out.write(raw)
        self.ids.append(doc_id)
        self.ordinals.append(ordinal)
        self.lengths.append(len(raw) // self.width)
        self.n_ids += self.lengths[-1]
        seq = self.seq
        if self.n_ids >= SHARD_IDS:
            self.close()
        return ordinal, seq

    def close(self) -> None:
        if self.out is None:
            return
        self.out.close()
        with self.fs.open_output_stream(self._name("idx", "." + self.mark)) as f:
            f.write(pack_index(np.array(self.ids, dtype=np.int64), np.array(self.ordinals),
                               np.array(self.lengths, dtype=np.int64), self.width))
        for kind in ("ids", "idx"):
            self.fs.move(self._name(kind, "." + self.mark), self._name(kind))
        self.out, self.seq = None, self.seq + 1


#: stands for a null document id in the index; such rows come first
NULL_ID = -(1 << 63)
KEYS = "doc_id bigint, ordinal int, part int, seq int"


def write_shards(docs: DataFrame, folder: str, tokenizer: str, *, end_id: int = 1,
                 vocabulary: int = 49408, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """Write all documents; returns their keys (doc_id, ordinal, part, seq) from ``folder/keys``.

    ``ordinal`` numbers rows of a shard that repeat an id.  A null text is an empty one (its ids
    are the end id alone); a null id becomes ``NULL_ID`` and comes first.  An empty table writes
    no shard.  ``tokenizer`` is a path on every executor.
    """
    spark = docs.sparkSession
    width = 2 if max(vocabulary, end_id + 1) <= 1 << 16 else 4
    source = docs.select(F.coalesce(F.col(id_col).cast("bigint"), F.lit(NULL_ID)).alias("i"),
                         F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("t"))
    size = source.agg(F.sum(F.octet_length("t"))).first()[0] or 0
    ranges = max(1, -(-size // RANGE_BYTES))
    end = np.array([end_id], f"<u{width}").tobytes()
    scheme = _uri(folder)
    fs, path = _filesystem(scheme)
    fs.create_dir(f"{path}/shards", recursive=True)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(tokenizer, width)
        part = TaskContext.get().partitionId()
        writer = _Writer(f"{scheme}/shards", part, width)
        for batch in batches:
            ids = batch.column(0).to_pylist()
            at = [writer.add(i, encoder.encode(t.as_py()) + end)
                  for i, t in zip(ids, batch.column(1))]
            ordinal, seq = zip(*at) if at else ((), ())
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(ordinal, pa.int32()),
                 pa.array([part] * len(ids), pa.int32()), pa.array(seq, pa.int32())],
                names=["doc_id", "ordinal", "part", "seq"])
        writer.close()

    # rows that share an id may be cut apart between ranges by their text's hash
    dealt = source.repartitionByRange(ranges, "i", F.xxhash64("t")) \
        .sortWithinPartitions("i", F.xxhash64("t"))
    dealt.mapInArrow(run, KEYS).write.mode("overwrite").parquet(f"{folder}/keys")
    keys = spark.read.parquet(f"{folder}/keys")
    # a row each shard; sorted, so that the reader's statistics find an id's shard
    keys.groupBy("part", "seq").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last")) \
        .sort("first").write.mode("overwrite").parquet(f"{folder}/manifest")
    return keys


# --- reading ------------------------------------------------------------------------------------
def _shard(folder: str, part: int, seq: int) -> tuple[Index, pafs.FileSystem, str]:
    fs, path = _filesystem(folder)
    name = f"{path}/shard-{part:06d}-{seq:04d}"
    with fs.open_input_stream(f"{name}.idx") as f:
        return Index(f.read()), fs, f"{name}.ids"


def shard_starts(spark: SparkSession, folder: str, keys: DataFrame) -> DataFrame:
    """(part, seq, shard_start): ids in all shards before, from the shards' own index files."""
    scheme = _uri(folder) + "/shards"

    def sizes(batches):
        for batch in batches:
            part, seq = (c.to_pylist() for c in batch.columns)
            n = [_shard(scheme, p, s)[0].n_ids for p, s in zip(part, seq)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(n, pa.int64())],
                names=["part", "seq", "n"])

    # one row a shard; first the ranges are summed up, then the shards within a range
    shards = keys.select("part", "seq").distinct().mapInArrow(sizes, "part int, seq int, n bigint")
    within = Window.partitionBy("part").orderBy("seq")
    local = shards.select("part", "seq", (F.sum("n").over(within) - F.col("n")).alias("inside"), "n")
    parts = shards.groupBy("part").agg(F.sum("n").alias("n_part"))
    before = parts.select("part", (F.sum("n_part").over(Window.orderBy("part"))
                                   - F.col("n_part")).alias("before"))
    return local.join(before, "part").select(
        "part", "seq", (F.col("before") + F.col("inside")).alias("shard_start"))


def _checksums(data, width: int, at: np.ndarray, n: np.ndarray) -> list[int]:
    """CRC-32 of documents' ids in 32 bits; neighbours in the payload are read as one run."""
    crc = [0] * len(at)
    order = np.argsort(at, kind="stable")
    first = 0
    while first < len(order):
        start = end = int(at[order[first]])
        last = first
        while last < len(order) and int(at[order[last]]) == end and (
                last == first or end + int(n[order[last]]) - start <= RUN_IDS):
            end += int(n[order[last]])
            last += 1
        wide = memoryview(np.frombuffer(data.read_at((end - start) * width, start * width),
                                        f"<u{width}").astype("<u4")).cast("B")
        for j in order[first:last].tolist():
            x = 4 * (int(at[j]) - start)
            crc[j] = zlib.crc32(wide[x:x + 4 * int(n[j])])
        first = last
    return crc


def read_documents(spark: SparkSession, folder: str, keys: DataFrame) -> DataFrame:
    """Look every key up in its shard's index and read its ids from the payload.

    Returns doc_id, ordinal, start, n_tokens, ids_crc32 (unsigned, over the ids as little-endian
    32-bit integers).  A key that the index does not know raises.
    """
    scheme = _uri(folder) + "/shards"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, index, data = None, None, None
        for batch in batches:
            ids, ordinals, part, seq = (c.to_numpy(zero_copy_only=False) for c in batch.columns)
            turn = np.flatnonzero((np.diff(part) != 0) | (np.diff(seq) != 0)) + 1
            for a, b in zip([0, *turn], [*turn, len(ids)]):
                if a == b:
                    continue
                if held != (int(part[a]), int(seq[a])):
                    held = int(part[a]), int(seq[a])
                    index, fs, name = _shard(scheme, *held)
                    if data is not None:
                        data.close()
                    data = fs.open_input_file(name)
                at, n = index.find(ids[a:b], ordinals[a:b])
                if (at < 0).any():
                    raise KeyError(f"document {ids[a:b][at < 0][0]} is not in shard {held}")
                crc = _checksums(data, index.width, at, n)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids[a:b]), pa.array(ordinals[a:b], pa.int32()),
                     pa.array(part[a:b], pa.int32()), pa.array(seq[a:b], pa.int32()),
                     pa.array(at, pa.int64()), pa.array(n, pa.int64()),
                     pa.array(crc, pa.int64())],
                    names=["doc_id", "ordinal", "part", "seq", "at", "n_tokens", "ids_crc32"])

    found = keys.select("doc_id", "ordinal", "part", "seq").mapInArrow(
        run, KEYS + ", at bigint, n_tokens bigint, ids_crc32 bigint")
    return found.join(shard_starts(spark, folder, keys), ["part", "seq"], "left").select(
        F.when(F.col("doc_id") != NULL_ID, F.col("doc_id")).alias("doc_id"), "ordinal",
        (F.col("shard_start") + F.col("at")).alias("start"), "n_tokens", "ids_crc32")


def get_ids(folder: str, part: int, seq: int, doc_id: int, ordinal: int = 0) -> np.ndarray | None:
    """One document's ids by key, or None if the shard does not hold it."""
    scheme = _uri(folder) + "/shards"
    index, fs, name = _shard(scheme, part, seq)
    at, n = index.find(np.array([doc_id]), np.array([ordinal]))
    if at[0] < 0:
        return None
    with fs.open_input_file(name) as f:
        raw = f.read_at(int(n[0]) * index.width, int(at[0]) * index.width)
    return np.frombuffer(raw, f"<u{index.width}")


def lookup(folder: str, doc_id: int) -> list[np.ndarray]:
    """The ids of every row with this id, by id alone: the manifest names the shards whose range
    holds it (usually one), their indexes give the place.  An unknown id gives an empty list."""
    fs, path = _filesystem(_uri(folder) + "/manifest")
    shards = ds.dataset(path, filesystem=fs, format="parquet").to_table(
        filter=(ds.field("first") <= doc_id) & (ds.field("last") >= doc_id)).sort_by(
        [("part", "ascending"), ("seq", "ascending")])
    out = []
    for part, seq in zip(shards.column("part").to_pylist(), shards.column("seq").to_pylist()):
        ordinal = 0
        while (ids := get_ids(folder, part, seq, doc_id, ordinal)) is not None:
            out.append(ids)
            ordinal += 1
    return out


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def op6_token_shards(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = new_folder(spark, "token-shards")
    keys = write_shards(docs, folder, tokenizer_path())
    return read_documents(spark, folder, keys).select("doc_id", "start", "n_tokens", "ids_crc32")
