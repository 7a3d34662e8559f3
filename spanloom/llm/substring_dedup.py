"""Substring dedup with fixed-block anchors.

Every document is cut into non-overlapping blocks of half a window; these are
the index, and every rolling run of block length is a probe. Any window of a
repeat holds a whole block of its earlier copy, so a window can only repeat
where a probe hits a block that occurs elsewhere. Hits are extended to the
windows around them, whose whole word sequences are then compared; runs of
such windows are the maximal exact repeats.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch, id_back, pack, pack_ids, parted, pieces, planes, rolling, spans, told_apart, unpack, unpack_ids, unplane

WORDS = parted()
#: Words of a unit, and log2 of the most bits of the hit filter (32 MB).
UNIT_WORDS, FILTER_BITS = 1 << 19, 28
#: Bits of a probe's hash that travel beyond those that number the words: chance hits only make more windows compared.
SPARE_BITS = 13
#: Keys that one bucket is meant to hold.
BUCKET_KEYS = 1 << 20
SECOND_BASE = 0xD6E8FEB86659FD93


def _units(arrays: Iterator[tuple], size: int = UNIT_WORDS) -> Iterator[list[tuple]]:
    """Groups of parallel arrays of ``size`` elements together; long ones are cut."""
    held, n = [], 0
    for columns in arrays:
        for i in range(0, len(columns[0]), size):
            part = tuple(c[i : i + size] for c in columns)
            held.append(part)
            n += len(part[0])
            if n >= size:
                yield held
                held, n = [], 0
    if held:
        yield held


def _probe(block: int, buckets: int, bits: int):
    """Rows (bucket, keys): each rolling hash of a unit once, with whether it is a block and whether it occurs again."""
    shift = np.uint64(bits + 2 - (buckets.bit_length() - 1))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def arrays():
            for batch in batches:
                for _, _, words, at in WORDS.chunks(batch.column(0)):
                    count = np.maximum(np.diff(at) - block + 1, 0)
                    h = (rolling(words, block) >> np.uint64(64 - bits))[spans(at[:-1], count)]
                    h <<= np.uint64(1)
                    h |= spans(np.zeros(len(count), np.int64), count) % block == 0
                    yield (h,)

        for held in _units(arrays()):
            x = np.sort(np.concatenate([h for (h,) in held]))
            key = x >> np.uint64(1)
            last = np.append(key[1:] != key[:-1], True)
            first = np.append(True, last[:-1])
            # Blocks sort after probes of the same hash, so the last of a run tells whether it holds a block.
            v = (x[last] << np.uint64(1)) | ~first[last]
            cuts = np.searchsorted(v >> shift, np.arange(buckets + 1, dtype=np.uint64))
            full = [b for b in range(buckets) if cuts[b] < cuts[b + 1]]
            yield pa.RecordBatch.from_arrays(
                [pa.array(full, pa.int32()), pa.array([pack(v[cuts[b] : cuts[b + 1]]) for b in full], pa.binary())], names=["bucket", "keys"]
            )

    return run


def _hits(buckets: int, filter_bits: int, probe_bits: int):
    """A bucket's slice of the hit filter: blocks that occur in two places at least."""
    slice_bits = filter_bits - (buckets.bit_length() - 1)

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        v = np.sort(np.concatenate([unpack(k) for k in pdf["keys"]]))
        key = v >> np.uint64(2)
        starts = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
        flags = np.bitwise_or.reduceat(v & np.uint64(3), starts)
        runs = np.diff(np.append(starts, len(v)))
        hit = key[starts][((flags & np.uint64(2)) != 0) & (((flags & np.uint64(1)) != 0) | (runs > 1))]
        bits = np.zeros(1 << slice_bits, np.uint8)
        bits[(hit >> np.uint64(probe_bits - filter_bits)).astype(np.int64) & ((1 << slice_bits) - 1)] = 1
        return pd.DataFrame({"bucket": [pdf["bucket"].iloc[0]], "bits": [np.packbits(bits, bitorder="little").tobytes()]})

    return run


def _places(ids: np.ndarray, th: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The documents (id, th) in order, and for each row which one it is."""
    if not th.any():
        own, doc = np.unique(ids, return_inverse=True)
        return own, np.zeros(len(own), np.int64), doc
    own, doc = np.unique(np.stack([ids, th], 1), axis=0, return_inverse=True)
    return own[:, 0], own[:, 1], doc.reshape(-1)


def _extend(window: int, block: int, buckets: int, filter_bits: int, bits):
    """Rows of windows that hold a hit.

    ``heads`` rows carry each word sequence of a unit once, at its first place
    (bucket, ids, ths = its documents, keys = first hash, check = second hash,
    docs = place in ids, starts); other places of the unit are lost already and
    travel as they are, in buckets of their own (keys null).
    """
    shift = np.uint64(64 - (buckets.bit_length() - 1))
    down = np.uint64(64 - filter_bits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        live = np.frombuffer(bits.value, np.uint8)

        def arrays():
            for batch in batches:
                ids, ths = batch.column(0).to_numpy(), batch.column(1).to_numpy()
                for i, j, words, at in WORDS.chunks(batch.column(2)):
                    size = np.diff(at)
                    room = np.maximum(size - window + 1, 0)
                    if not room.any():
                        continue
                    probe = (rolling(words, block) >> down).astype(np.int64)
                    count = np.concatenate([[0], np.cumsum((live[probe >> 3] >> (probe & 7).astype(np.uint8)) & 1, dtype=np.int64)])
                    place = spans(at[:-1], room)
                    hit = count[place + block] > count[place]
                    place, doc = place[hit], np.repeat(np.arange(j - i), room)[hit]
                    if len(place):
                        yield ids[i:j][doc], ths[i:j][doc], place - at[doc], rolling(words, window)[place], rolling(words, window, SECOND_BASE)[place] >> np.uint64(32)

        for held in _units(arrays()):
            ids, ths, start, h1, h2 = (np.concatenate([x[i] for x in held]) for i in range(5))
            del held
            ids, ths, doc = _places(ids, ths)
            order = np.lexsort((start, doc, h2, h1))
            doc, start, h1, h2 = doc[order], start[order], h1[order], h2[order].astype(np.uint32)
            again = np.append(False, (h1[1:] == h1[:-1]) & (h2[1:] == h2[:-1]))
            out = []

            def row(bucket: int, keys: bytes | None, at: np.ndarray) -> None:
                used, own = np.unique(doc[at], return_inverse=True)
                out.append((bucket, pack_ids(ids[used]), planes(ths[used]), keys, h2[at].tobytes() if keys else None, planes(own), planes(start[at])))

            first = np.flatnonzero(~again)
            cuts = np.searchsorted(h1[first] >> shift, np.arange(buckets + 1, dtype=np.uint64))
            for k in np.flatnonzero(cuts[1:] > cuts[:-1]).tolist():
                at = first[cuts[k] : cuts[k + 1]]
                row(k, pack(h1[at]), at)
            # A place that is the first one once more (a repeated row) is not lost.
            head = np.maximum.accumulate(np.where(again, 0, np.arange(len(again))))
            lost = np.flatnonzero(again & ((doc != doc[head]) | (start != start[head])))
            for i in range(0, len(lost), 1 << 16):
                row(buckets + int(abs(int(ids[doc[lost[i]]]) + i)) % buckets, None, lost[i : i + (1 << 16)])
            kinds = (pa.int32(), *[pa.binary()] * 6)
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], t) for i, t in enumerate(kinds)], names=["bucket", "ids", "ths", "keys", "checks", "docs", "starts"])

    return run


def _judge(buckets: int):
    """(doc_id, th, at) of a bucket's windows that start earlier elsewhere, one row for each."""

    def run(table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        doc = [unplane(r["docs"]) for r in rows]
        ids = np.concatenate([unpack_ids(r["ids"])[d] for r, d in zip(rows, doc)])
        ths = np.concatenate([unplane(r["ths"])[d] for r, d in zip(rows, doc)])
        start = np.concatenate([unplane(r["starts"]) for r in rows])
        if table.column("bucket")[0].as_py() < buckets:
            h = np.concatenate([unpack(r["keys"]) for r in rows])
            check = np.concatenate([np.frombuffer(r["checks"], np.uint32) for r in rows])
            del rows, doc
            order = np.argsort(h, kind="stable")
            same = h[order[1:]] == h[order[:-1]]
            order = order[np.append(False, same) | np.append(same, False)]
            order = order[np.lexsort((start[order], ths[order], ids[order], check[order], h[order]))]
            ids, ths, start, check, h = (x[order] for x in (ids, ths, start, check, h))
            again = np.append(False, (h[1:] == h[:-1]) & (check[1:] == check[:-1])) if len(h) else np.zeros(0, bool)
            head = np.maximum.accumulate(np.where(again, 0, np.arange(len(again)))) if len(h) else order
            lost = again & ((ids != ids[head]) | (ths != ths[head]) | (start != start[head]))
            ids, ths, start = ids[lost], ths[lost], start[lost]
        order = np.lexsort((start, ths, ids))
        return pa.table({"doc_id": ids[order], "th": ths[order], "at": start[order]})

    return run


def _cut(window: int, keep_text: bool):
    """Remove the words of lost windows; (doc_id, n_words, n_removed, kept_sha256, kept_text)."""

    def one(text: bytes | None, lost: list[int] | None) -> tuple:
        digest, n, removed, kept, first = hashlib.sha256(), 0, 0, [], True
        ends = np.unique(np.array(lost, np.int64)) + window if lost else None
        for piece in pieces(text or b""):
            words = piece.split()
            m = len(words)
            if lost:
                # Word w goes if the first window that ends after it starts at it or before.
                w = np.arange(n, n + m)
                after = np.minimum(np.searchsorted(ends, w, "right"), len(ends) - 1)
                stays = (ends[after] <= w) | (ends[after] - window > w)
                words = [x for x, s in zip(words, stays.tolist()) if s]
            n += m
            removed += m - len(words)
            if words:
                part = b" ".join(words)
                digest.update(part if first else b" " + part)
                first = False
                if keep_text:
                    kept.append(part)
        return n, removed, digest.hexdigest(), b" ".join(kept).decode("utf-8", "replace") if keep_text else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, 500):
                part = batch.slice(i, 500)
                rows = [one(text, lost) for text, lost in zip(part.column(1).to_pylist(), part.column(2).to_pylist())]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), *(pa.array([r[k] for r in rows], t) for k, t in enumerate((pa.int64(), pa.int64(), pa.string(), pa.string())))],
                    names=["doc_id", "n_words", "n_removed", "kept_sha256", "kept_text"],
                )

    return run


def remove_repeats(docs: DataFrame, window: int = 20, keep_text: bool = False) -> DataFrame:
    """One row per document: (doc_id, n_words, n_removed, kept_sha256, kept_text).

    Words are ``[^\\x20\\x09-\\x0D]+``. A word goes when a window of ``window``
    words of its document covers it whose sequence also starts earlier: in a
    smaller doc_id, or earlier in the same document. Windows are judged on the
    input. ``kept_text`` is null unless ``keep_text``.

    Null and empty texts have no words and the digest of the empty string. A
    null id sorts first. Rows without an id and rows that repeat one are told
    apart, and ordered among themselves, by a hash of their text: different
    texts are different documents, and rows that repeat both id and text are one
    place and get the same result. Other columns are not read; an empty table
    gives no rows.

    The hit filter has a size that is set by the input's bytes and at most
    32 MB; where it fills up, more windows are compared, none less.
    """
    spark = docs.sparkSession
    block = window // 2
    source = told_apart(docs, Scratch(spark))
    words = (source.agg(F.sum(F.octet_length("text"))).first()[0] or 0) // 6 + 1
    buckets = 1 << max(4, (words // BUCKET_KEYS).bit_length())
    filter_bits = min(FILTER_BITS, max(20, (2 * words).bit_length()))
    filter_bits = max(filter_bits, buckets.bit_length() - 1 + 3)
    probe_bits = min(56, max(filter_bits, words.bit_length() + SPARE_BITS))

    sent = source.select("text").mapInArrow(_probe(block, buckets, probe_bits), "bucket int, keys binary")
    slices = sent.groupBy("bucket").applyInPandas(_hits(buckets, filter_bits, probe_bits), "bucket int, bits binary").collect()
    size = (1 << filter_bits) // 8 // buckets
    bits = bytearray(size * buckets)
    for r in slices:  # the filter's slices: its fixed size in all, whatever the input
        bits[r["bucket"] * size : (r["bucket"] + 1) * size] = r["bits"]
    bits = spark.sparkContext.broadcast(bytes(bits))

    kinds = "bucket int, ids binary, ths binary, keys binary, checks binary, docs binary, starts binary"
    near = source.mapInArrow(_extend(window, block, buckets, filter_bits, bits), kinds)
    lost = near.groupBy("bucket").applyInArrow(_judge(buckets), "doc_id long, th long, at long")
    lost = lost.groupBy("doc_id", "th").agg(F.collect_list("at").alias("lost"))
    joined = source.join(lost, ["doc_id", "th"], "left").select("doc_id", "text", "lost")
    out = joined.mapInArrow(_cut(window, keep_text), "doc_id long, n_words long, n_removed long, kept_sha256 string, kept_text string")
    return out.select(id_back("doc_id"), "n_words", "n_removed", "kept_sha256", "kept_text")
