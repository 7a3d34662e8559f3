"""Shared pieces: scratch tables in the cluster's shared folder, split rules, word hashing."""

from __future__ import annotations

import ctypes
import re
import threading
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from spanloom.scratch import app_dir

#: A missing id is carried as this value through operators that pack ids, and given back as null.
NULL_ID = -(2**63)

#: Folders of scratch tables by application and owner, and each thread's present owner.
_made: dict[tuple[str, str], list[str]] = {}
_lock, _mine = threading.Lock(), threading.local()


class Scratch:
    """Tables written to the shared folder to cut lineage; they live as long as the application, or as ``owned`` tells."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        bounded_batches(spark)
        self.path = f"{app_dir(spark)}/{uuid.uuid4().hex}"
        with _lock:
            _made.setdefault((spark.sparkContext.applicationId, getattr(_mine, "owner", "")), []).append(self.path)

    def table(self, df: DataFrame, name: str, *partition_by: str) -> DataFrame:
        """Write once, read back: later jobs start from the files, whichever executors are left."""
        path = f"{self.path}/{name}"
        writer = df.write.mode("overwrite")
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        writer.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, name: str) -> None:
        _delete(self.spark, f"{self.path}/{name}")


def _delete(spark: SparkSession, path: str) -> None:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


@contextmanager
def owned(spark: SparkSession, owner: str, docs: DataFrame | None = None) -> Iterator[None]:
    """Scratch tables made inside belong to ``owner``; its earlier ones go first, but for those that ``docs`` reads."""
    with _lock:
        paths = list(_made.get((spark.sparkContext.applicationId, owner), []))
    files = docs.inputFiles() if docs is not None and paths else []
    for path in [p for p in paths if not any(p in f for f in files)]:
        _delete(spark, path)
        with _lock:
            _made[spark.sparkContext.applicationId, owner].remove(path)
    before, _mine.owner = getattr(_mine, "owner", ""), owner
    try:
        yield
    finally:
        _mine.owner = before


def crc_mod(doc_id: str | Column, n: int) -> Column:
    """crc32 of the id written as text, modulo n (null id: null)."""
    c = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.pmod(F.crc32(c.cast("string").cast("binary")), F.lit(n))


def id_or(col: str = "doc_id") -> Column:
    return F.coalesce(F.col(col).cast("long"), F.lit(NULL_ID)).alias(col)


def id_back(col: str = "doc_id") -> Column:
    return F.when(F.col(col) == F.lit(NULL_ID), None).otherwise(F.col(col)).alias(col)


def bounded_batches(spark: SparkSession, size: str = "4m") -> None:
    """Arrow batches by bytes, so that a task holds few texts at once however long they are; a setting of the user's own stays."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(key) in ("67108864b", "64MB"):
        spark.conf.set(key, size)


def give_back() -> None:
    """Gives memory that this process has freed back to the system, where the C library can."""
    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):
        trim(0)


def lean(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``run``, giving memory back when a task ends: Python workers outlive their tasks, and stand beside the JVM's joins."""

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        give_back()

    return whole


class WordHashes(dict):
    """64-bit hash of each word (bytes); forgets all words when it holds ``most``."""

    def __init__(self, most: int = 200_000):
        super().__init__()
        self.most = most

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.most:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h

    def array(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def mix(x: np.ndarray) -> np.ndarray:
    """The finaliser of a 64-bit hash (a bijection), element by element."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def rolling(hashes: np.ndarray, n: int, base: int = 0x9E3779B97F4A7C15) -> np.ndarray:
    """Hash of every n consecutive word hashes (none if there are fewer): a polynomial in ``base``, by doubling."""
    m = len(hashes) - n + 1
    if m <= 0:
        return np.empty(0, np.uint64)
    out, length = hashes, 1
    for bit in bin(n)[3:]:
        out = out[: len(out) - length] * np.uint64(pow(base, length, 1 << 64)) + out[length:]
        length *= 2
        if bit == "1":
            out = out[:-1] * np.uint64(base) + hashes[length:]
            length += 1
    return mix(out)


def pack(values: np.ndarray) -> bytes:
    """Sorted unsigned integers: the first, then differences byte plane by byte plane (the high ones compress to nothing)."""
    if not len(values):
        return b""
    d = np.diff(values.astype(np.uint64))
    width = max(1, (int(d.max()).bit_length() + 7) // 8) if len(d) else 1
    return bytes([width]) + int(values[0]).to_bytes(8, "little") + d.view(np.uint8).reshape(-1, 8).T[:width].tobytes()


def unpack(blob: bytes) -> np.ndarray:
    if not blob:
        return np.empty(0, np.uint64)
    width = blob[0]
    n = (len(blob) - 9) // width
    d = np.zeros((n + 1, 8), np.uint8)
    d[1:, :width] = np.frombuffer(blob, np.uint8, offset=9).reshape(width, n).T
    d[0] = np.frombuffer(blob, np.uint8, 8, 1)
    return np.cumsum(d.reshape(-1).view(np.uint64), dtype=np.uint64)


def planes(values: np.ndarray) -> bytes:
    """Integers in any order, byte plane by byte plane, as many as the largest needs (as unsigned ones); zeros need none."""
    v = values.astype(np.uint64)
    width = (int(v.max(initial=0)).bit_length() + 7) // 8
    return bytes([width]) + len(v).to_bytes(4, "little") + v.view(np.uint8).reshape(-1, 8).T[:width].tobytes()


def unplane(blob: bytes) -> np.ndarray:
    width, n = blob[0], int.from_bytes(blob[1:5], "little")
    v = np.zeros((n, 8), np.uint8)
    v[:, :width] = np.frombuffer(blob, np.uint8, offset=5).reshape(width, n).T
    return v.reshape(-1).view(np.int64)


def pack_ids(ids: np.ndarray) -> bytes:
    """Ascending signed ids."""
    return pack(ids.view(np.uint64) ^ np.uint64(1 << 63))


def unpack_ids(blob: bytes) -> np.ndarray:
    return (unpack(blob) ^ np.uint64(1 << 63)).view(np.int64)


#: Bytes of a text that are split into words at once.
PIECE = 1 << 20
_SPACE = re.compile(rb"[\x20\x09-\x0D]")
LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))


def pieces(text: bytes) -> Iterator[bytes]:
    """The text, cut at white space about every PIECE bytes, so that no long list of words is held."""
    at = 0
    while len(text) - at > 2 * PIECE:
        m = _SPACE.search(text, at + PIECE)
        if m is None:
            break
        yield text[at : m.end()]
        at = m.end()
    yield text[at:] if at else text


def word_hashes(text: bytes | None, table: WordHashes, lower: bool = False) -> np.ndarray:
    """Hashes of the words [^\\x20\\x09-\\x0D]+ of a text (bytes.split() cuts at just these six characters)."""
    if not text:
        return np.empty(0, np.uint64)
    parts = [table.array((p.translate(LOWER) if lower else p).split()) for p in pieces(text)]
    return parts[0] if len(parts) == 1 else np.concatenate(parts)


#: Bytes that are hashed at once, and the odd base of the words' hash.
BLOCK, BASE = 1 << 18, 0xB5026F5AA96619EB


@lru_cache(1)
def _powers() -> tuple[np.ndarray, np.ndarray]:
    """BASE and its inverse modulo 2**64, to the powers 0 to BLOCK - 1."""
    out = []
    for base in (BASE, pow(BASE, -1, 1 << 64)):
        x = np.full(BLOCK, base, np.uint64)
        x[0] = 1
        out.append(np.cumprod(x))
    return out[0], out[1]


class Words:
    """64-bit hashes of the words of texts, without a Python object for each word.

    ``fold`` says for each byte which one it counts as; a space (32) parts
    words. A word's hash is a polynomial in BASE over random letters, modulo
    2**64, taken as the difference of two running sums.
    """

    def __init__(self, fold: bytes):
        code = np.frombuffer(fold, np.uint8)
        self.inside = code != 32
        self.letter = mix(code.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15))

    def _block(self, b: np.ndarray, cuts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(first byte, last byte, raw hash) of the words of at most BLOCK bytes; ``cuts`` part texts."""
        power, inverse = _powers()
        w = self.inside[b]
        first, last = w.copy(), w.copy()
        first[1:] &= ~w[:-1]
        last[:-1] &= ~w[1:]
        first[cuts] = w[cuts]
        last[cuts - 1] = w[cuts - 1]
        start, end = np.flatnonzero(first), np.flatnonzero(last)
        terms = self.letter[b]
        terms *= power[: len(b)]
        sums = np.cumsum(terms)
        return start, end, (sums[end] - sums[start] + terms[start]) * inverse[start]

    def of(self, text: bytes | np.ndarray | None) -> np.ndarray:
        """Hashes of one text of any length, block by block; a word may lie in many."""
        if text is None or not len(text):
            return np.empty(0, np.uint64)
        b = text if isinstance(text, np.ndarray) else np.frombuffer(text, np.uint8)
        out, held, weight = [], None, 1
        for at in range(0, len(b), BLOCK):
            part = b[at : at + BLOCK]
            start, end, raw = self._block(part, np.empty(0, np.int64))
            joined = held is not None and len(start) > 0 and start[0] == 0
            if joined:
                raw[0] = np.uint64((held + weight * int(raw[0])) % (1 << 64))
            elif held is not None:
                out.append(np.array([held], np.uint64))
            if not (joined and len(start) == 1):
                weight = 1
            held = None
            if len(end) and end[-1] == len(part) - 1 and at + BLOCK < len(b):
                weight = weight * pow(BASE, int(end[-1] - start[-1]) + 1, 1 << 64) % (1 << 64)
                held, raw = int(raw[-1]), raw[:-1]
            out.append(raw)
        return mix(np.concatenate(out))

    def chunks(self, column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
        """(i, j, hashes, bounds) for runs of rows i to j of a binary column: row i + k has hashes[bounds[k]:bounds[k + 1]]."""
        column = column.fill_null(b"") if column.null_count else column
        n = len(column)
        _, offsets, data = column.buffers()
        offsets = np.frombuffer(offsets, np.int32)[column.offset : column.offset + n + 1].astype(np.int64) if n else np.zeros(1, np.int64)
        data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.empty(0, np.uint8)
        i = 0
        while i < n:
            j = int(np.searchsorted(offsets, offsets[i] + BLOCK, "right")) - 1
            b = data[offsets[i] : offsets[max(j, i + 1)]]
            if j <= i:
                h = self.of(b)
                yield i, i + 1, h, np.array([0, len(h)])
                i += 1
                continue
            cuts = offsets[i:j] - offsets[i]
            start, _, raw = self._block(b, cuts[(cuts > 0) & (cuts < len(b))])
            yield i, j, mix(raw), np.searchsorted(start, offsets[i : j + 1] - offsets[i])
            i = j


def parted(fold: bytes = bytes(range(256))) -> Words:
    """Words ``[^\\x20\\x09-\\x0D]+`` of texts whose bytes count as ``fold`` says."""
    return Words(bytes(32 if b == 32 or 9 <= b <= 13 else fold[b] for b in range(256)))


def spans(first: np.ndarray, count: np.ndarray) -> np.ndarray:
    """The numbers first[k], first[k] + 1, ... (count[k] of them), one run after the other."""
    ends = np.cumsum(count)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(first - ends + count, count)


#: Ids that are sent to every task at most (8 MB); more are joined by a shuffle.
FEW_IDS = 1_000_000


def without(docs: DataFrame, ids: DataFrame, name: str) -> DataFrame:
    """``docs`` without the rows whose doc_id is in the one column ``name`` of ``ids`` (null ids: NULL_ID)."""
    few = ids.limit(FEW_IDS + 1).count() <= FEW_IDS
    return docs.join(F.broadcast(ids) if few else ids, F.coalesce(docs["doc_id"].cast("long"), F.lit(NULL_ID)) == ids[name], "left_anti")


def small(df: DataFrame, most: int = 100_000) -> DataFrame:
    """``df``, a written table, to be sent to every task if it has at most ``most`` rows; else a join shuffles."""
    return F.broadcast(df) if df.limit(most + 1).count() <= most else df


def told_apart(docs: DataFrame, scratch: Scratch, **extra: Column) -> DataFrame:
    """(doc_id, th, text, and the columns ``extra``) of each row: id and ``th`` tell documents apart.

    ``th`` hashes the text of rows that have no id or share it with others, and
    is 0 for all others. A missing id is NULL_ID.
    """
    text = F.col("text").cast("binary")
    source = docs.select(id_or("doc_id"), F.xxhash64(text).alias("th"), text.alias("text"), *[c.alias(k) for k, c in extra.items()])
    again = scratch.table(source.groupBy("doc_id").count().filter("count > 1").select(F.col("doc_id").alias("again")), "again")
    n = again.limit(FEW_IDS + 1).count()
    if not n:
        return source.withColumn("th", F.lit(0).cast("long"))
    if n > FEW_IDS:  # too many to send: all rows are told apart by their texts
        return source
    marked = source.join(F.broadcast(again), source["doc_id"] == again["again"], "left")
    return marked.withColumn("th", F.when(F.col("again").isNotNull(), F.col("th")).otherwise(0)).drop("again")


def spare(df: DataFrame, name: str) -> str:
    """``name``, with as many underscores as make it no column of ``df``."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def join_unique(rows: DataFrame, groups: DataFrame, key: list[str], size: str, hot_rows: int = 1_000, hot_keys: int = 1_024) -> DataFrame:
    """``rows`` with the columns of ``groups``, which has one row for each key and the key's rows in ``size``.

    The few keys with very many rows meet their group by broadcast (at most
    ``hot_keys`` rows are sent), all others by a join on the key.
    """
    hot = F.broadcast(groups.filter(F.col(size) >= hot_rows).orderBy(F.desc(size), *key).limit(hot_keys))
    return rows.join(hot, key).unionByName(rows.join(hot, key, "left_anti").join(groups, key))


def connected(links: DataFrame, scratch: Scratch, name: str) -> DataFrame:
    """(id, comp): the least id that each id of ``links`` (a, b) reaches.

    Labels pass along links, then each takes its label's label; both steps
    aggregate before they shuffle. Each round is a table in the shared folder.
    """
    both = scratch.table(links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), f"{name}-both")
    comp = scratch.table(both.groupBy(F.col("a").alias("id")).agg(F.min("b").alias("m")).select("id", F.least("id", "m").alias("comp")), f"{name}-0")
    k = 0
    while True:
        k += 1
        heard = both.join(comp, both.b == comp.id).groupBy("a").agg(F.min("comp").alias("heard"))
        lower = comp.join(heard, comp.id == heard.a, "left").select("id", F.col("comp").alias("was"), F.least("comp", F.coalesce("heard", "comp")).alias("comp"))
        jump = comp.select(F.col("id").alias("at"), F.col("comp").alias("next"))
        after = lower.join(jump, lower.comp == jump["at"], "left").select("id", "was", F.least("comp", F.coalesce("next", "comp")).alias("comp"))
        after = scratch.table(after, f"{name}-{k}")
        changed = after.filter("was <> comp").limit(1).count()
        comp = after.select("id", "comp")
        scratch.drop(f"{name}-{k - 1}")
        if not changed:
            return comp
