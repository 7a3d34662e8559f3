"""N-gram Jaccard self-join by PartEnum signatures, and the classes its links make.

Sets fall into size bands; two sets that are similar enough differ in at most
k shingles, k known from the band. Each band cuts the shingle domain into n1
partitions and each of these into n2 parts, with n1 * (k2 + 1) > k: on some
partition the two sets differ in k2 parts at most, so they are equal on some
n2 - k2 of its parts. Every such subset of parts is a signature, and sets that
share one are compared exactly.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import FEW_IDS, LOWER, Scratch, connected, give_back, join_unique, lean, mix, parted, rolling, small, spans, spare

WORDS = parted(LOWER)
#: log2 of the least and most cells of the sketch that finds frequent shingles (16 MB in a task), words for each cell, and slices it is summed by.
LEAST_CELLS, MOST_CELLS, CELL_WORDS, SLICES = 16, 22, 8, 16
#: A cell is frequent from this many times the mean on (and this count at least).
FREQUENT, FREQUENT_LEAST = 8, 64
#: log2 of the documents of a unit, signatures of a unit, keys that one bucket is meant to hold, and the most bits of a signature that travel.
UNIT_BITS, UNIT_SIGNATURES, BUCKET_KEYS, SIG_BITS = 12, 1 << 19, 1 << 20, 51
#: Bits by which signatures that travel are longer than their number needs (chance hits only make more sets compared), and names of sets
#: (about one set in 2**NAME_SPARE shares its name with another, and both get a longer one).
SPARE_BITS, NAME_SPARE = 13, 16
#: 64-bit words of the parity sketch that bounds from below how far two sets are apart.
PARITY = 16
#: Most cells of the sketch by which larger sets are held apart before they travel (128 KB).
MOST_WIDE = 1 << 20
#: Bits of the filter of documents whose sets are compared.
ID_BITS = 1 << 23
#: Rows of a signature that one task pairs with a row before the signature is salted.
PAIR_ROWS = 256
#: Pairs up to which the ids of the sets to compare are sent to all tasks.
FEW_PAIRS = 100_000


def shingle_sets(column: pa.Array, n: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(i, j, hashes, bounds) for runs of rows of a binary column: each row's distinct n-word shingles, sorted.

    A text of fewer words has its whole sequence as one, a text without words none.
    """
    base = np.uint64(0x9E3779B97F4A7C15)
    for i, j, h, at in WORDS.chunks(column):
        size = np.diff(at)
        count = np.where(size >= n, size - n + 1, size > 0)
        ends = np.concatenate([[0], np.cumsum(count)])
        out = np.empty(ends[-1], np.uint64)
        whole = size >= n
        if whole.any():
            out[spans(ends[:-1][whole], count[whole])] = rolling(h, n)[spans(at[:-1][whole], count[whole])]
        for m in range(1, n):
            if len(d := np.flatnonzero(size == m)):
                x = h[at[d]]
                for t in range(1, m):
                    x = x * base + h[at[d] + t]
                out[ends[d]] = mix(x)
        for a, b in zip(ends[:-1].tolist(), ends[1:].tolist()):
            out[a:b].sort()
        fresh = np.ones(len(out), bool)
        fresh[1:] = out[1:] != out[:-1]
        fresh[ends[:-1][count > 0]] = True
        yield i, j, out[fresh], np.concatenate([[0], np.cumsum(fresh)])[ends]


def set_hashes(hashes: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Two 64-bit hashes of each set, as rows."""
    b = bounds.tolist()
    return np.frombuffer(b"".join(xxhash.xxh3_128_digest(hashes[x:y]) for x, y in zip(b, b[1:])), np.int64).reshape(-1, 2)


def most_apart(total, percent: int):
    """The largest symmetric difference of two similar sets whose sizes add up to ``total`` at most (a number or an array)."""
    one = lambda s: s + 2 * (-percent * s // (100 + percent))
    return np.maximum(one(total), one(np.maximum(total - 1, 0)))


@lru_cache(None)
def bands(percent: int) -> tuple[np.ndarray, np.ndarray]:
    """First and last size of each band; a set's partners lie in its own band or the next ones to it."""
    first, last = [1], [100 // percent]
    while last[-1] < 1 << 32:
        first.append(last[-1] + 1)
        last.append(first[-1] * 100 // percent)
    return np.array(first), np.array(last)


def shape(k: int) -> tuple[int, int, int]:
    """(n1, n2, k2) for sets that differ in ``k`` elements at most: a few partitions more than needed, as some of a set's hold too little."""
    return (1, k + 3, k) if k <= 2 else (-(-58 * k // 100) + 1, 3, 1)


@lru_cache(None)
def shapes(percent: int) -> np.ndarray:
    """(n1, n2, k2) of each band."""
    return np.array([shape(int(most_apart(2 * int(u), percent))) for u in bands(percent)[1]])


def _subsets(x: np.ndarray, slot: np.ndarray, n1: np.ndarray, n2: int, k2: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Signatures of the subsets of parts that hold something, their documents, and each document's partitions with more than k2 parts that do.

    ``x`` are shingles in the order of their ``slot`` (a part of a partition of a document).
    """
    rows = int(n1.sum())
    sums, held = np.zeros(rows * n2, np.uint64), np.zeros(rows * n2, bool)
    if len(x):
        starts = np.flatnonzero(np.append(True, slot[1:] != slot[:-1]))
        sums[slot[starts]] = np.add.reduceat(x, starts)
        held[slot[starts]] = True
    sums, held = sums.reshape(-1, n2), held.reshape(-1, n2)
    doc = np.repeat(np.arange(len(n1)), n1)
    partition = spans(np.zeros(len(n1), np.int64), n1).astype(np.uint64)
    sig, of = [], []
    for c, parts in enumerate(combinations(range(n2), n2 - k2)):
        some = held[:, parts].any(1)
        tag = partition[some] * np.uint64(16) + np.uint64(c)
        sig.append(mix(sums[some][:, parts].sum(1, dtype=np.uint64) + tag * np.uint64(0x9E3779B97F4A7C15)))
        of.append(doc[some])
    return np.concatenate(sig), np.concatenate(of), np.bincount(doc, held.sum(1) > k2, len(n1)).astype(np.int64)


def signatures(hashes: np.ndarray, bounds: np.ndarray, frequent: np.ndarray, percent: int = 80) -> tuple[np.ndarray, np.ndarray]:
    """(signature, set) of sets given as sorted hashes; ``frequent`` has a bit for each cell of shingles.

    Rare and frequent shingles are cut into parts of their own. A set sends the
    subsets of its rare parts. If too few of its partitions hold enough to be
    sure of an equal subset, it also sends each rare shingle; if these are too
    few, the subsets of frequent parts; and at last each frequent shingle. Each
    step holds the ones before it. Of two similar sets, the one that ends first
    has a signature on which both are equal, and the other sends it too. So a
    passage that very many documents share makes no signature, but for documents
    that are little else. Sets that can only be similar if they are equal send
    none.
    """
    size = np.diff(bounds)
    first, last = bands(percent)
    shift = np.uint64(64 - (8 * len(frequent)).bit_length() + 1)
    cell = (hashes >> shift).astype(np.int64)
    hot = (frequent[cell >> 3] >> (cell & 7).astype(np.uint8)) & 1 > 0
    band, reach = np.searchsorted(last, size), size * 100 // percent
    kinds = shapes(percent)
    out_sig, out_set = [], []
    for step in (0, 1):
        instance = np.minimum(band + step, len(last) - 1)
        largest = last[instance]
        k = most_apart(size + np.minimum(largest, reach), percent)
        live = (size > 0) & (kinds[instance][:, 2] > 0) & ((step == 0) | (reach >= first[instance]))
        for n2, k2 in {(int(b), int(c)) for _, b, c in kinds[instance[live]]}:
            d = np.flatnonzero(live & (kinds[instance][:, 1] == n2) & (kinds[instance][:, 2] == k2))
            at = spans(bounds[d], size[d])
            own = np.repeat(np.arange(len(d)), size[d])
            x, is_hot, n1, apart = hashes[at], hot[at], kinds[instance[d]][:, 0], k[d]
            cut = (n1 * n2).astype(np.uint64)
            slot = (np.cumsum(n1 * n2) - n1 * n2)[own] + (((x >> np.uint64(32)) * cut[own]) >> np.uint64(32)).astype(np.int64)
            salt = mix(instance[d].astype(np.uint64) + np.uint64(1))
            found = []

            def add(sig: np.ndarray, of: np.ndarray, kind: int, wanted: np.ndarray | None = None) -> None:
                if wanted is not None:
                    sig, of = sig[wanted[of]], of[wanted[of]]
                found.append((mix(sig ^ (salt[of] + np.uint64(kind))), of))

            sig, of, useful = _subsets(x[~is_hot], slot[~is_hot], n1, n2, k2)
            add(sig, of, 0)
            short = useful * (k2 + 1) <= apart
            if short.any():
                rare = np.bincount(own[~is_hot], minlength=len(d))
                add(x[~is_hot], own[~is_hot], 1, short)
                short &= rare <= apart
                if short.any():
                    sig, of, useful = _subsets(x[is_hot], slot[is_hot], n1, n2, k2)
                    add(sig, of, 2, short)
                    short &= rare + useful * (k2 + 1) <= apart
                    add(x[is_hot], own[is_hot], 1, short)
            out_sig += [s for s, _ in found]
            out_set += [d[o] for _, o in found]
    if not out_sig:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    return np.concatenate(out_sig), np.concatenate(out_set)


def _first(h: np.ndarray, bits: int) -> np.ndarray:
    return (h[:, 0].view(np.uint64) >> np.uint64(64 - bits)).view(np.int64) if bits < 64 else h[:, 0]


def _names(h: np.ndarray, clash: np.ndarray, bits: int) -> np.ndarray:
    """The 64-bit name of each set: its first hash, or the second one where another set has the same first."""
    first = _first(h, bits)
    return np.where(np.isin(first, clash), h[:, 1], first) if len(clash) else first


def _survey(n: int, cell_bits: int, name_bits: int):
    """Sizes and set hashes of documents, and each task's counts of shingles by cell."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells = np.zeros(1 << cell_bits, np.uint32)
        for batch in batches:
            for i, j, x, at in shingle_sets(batch.column(2), n):
                np.add.at(cells, (x >> np.uint64(64 - cell_bits)).astype(np.int64), np.uint32(1))
                h, m = set_hashes(x, at), j - i
                kept = [batch.column(0).slice(i, m), batch.column(1).slice(i, m)]
                yield _batch(*kept, pa.array(np.diff(at)), pa.array(_first(h, name_bits)), pa.array(h[:, 1]), pa.nulls(m, pa.int32()), pa.nulls(m, pa.binary()))
        for k, x in enumerate(cells.reshape(SLICES, -1)):
            if x.any():
                low = zlib.compress(np.minimum(x, 65_535).astype("<u2").view(np.uint8).reshape(-1, 2).T.tobytes(), 1)
                none = pa.nulls(1, pa.int64())
                yield _batch(none, none, none, none, none, pa.array([k], pa.int32()), pa.array([low], pa.binary()))

    return run


def _batch(*columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(list(columns), names=["doc_id", "th", "n_shingles", "h1", "h2", "slice", "counts"])


def _add(bits: int):
    def run(rows: pa.Table) -> pa.Table:
        total = np.zeros((1 << bits) // SLICES, np.int64)
        for blob in rows.column("counts"):
            low, high = np.frombuffer(zlib.decompress(blob.as_buffer()), np.uint8).reshape(2, -1).astype(np.int64)
            total += low + (high << 8)
        counts = pa.array([total.astype(np.uint32).tobytes()], pa.binary())
        return pa.table({"slice": rows.column("slice")[:1], "total": pa.array([int(total.sum())]), "counts": counts})

    return run


def frequent_cells(survey: DataFrame, bits: int, scratch: Scratch) -> np.ndarray:
    """One bit for each cell; the sketch has a size that is bounded whatever the input."""
    rows = survey.filter("slice is not null").select("slice", "counts")
    summed = scratch.table(rows.groupBy("slice").applyInArrow(_add(bits), "slice int, total long, counts binary"), "cells")
    mean = (summed.agg(F.sum("total")).first()[0] or 0) >> bits
    least = max(FREQUENT_LEAST, FREQUENT * mean)

    def flags(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bits = [np.packbits(np.frombuffer(c.as_buffer(), np.uint32) >= least, bitorder="little").tobytes() for c in batch.column("counts")]
            yield pa.RecordBatch.from_arrays([batch.column("slice"), pa.array(bits, pa.binary())], names=["slice", "flags"])

    out = np.zeros((SLICES, (1 << bits) // SLICES // 8), np.uint8)
    for r in summed.mapInArrow(flags, "slice int, flags binary").collect():  # a bit for each cell: 512 KB at most
        out[r["slice"]] = np.frombuffer(bytes(r["flags"]), np.uint8)
    return out.reshape(-1)


def pack_tight(values: np.ndarray) -> bytes:
    """Sorted unsigned integers: the first, then differences.

    A difference's bits below the mean's highest one are written byte plane by
    byte plane and bit plane by bit plane, what is above them in unary. That is
    three bits a number at most beyond the planes, however uneven the
    differences are, where whole bytes for the largest one cost up to eight.
    """
    if not len(values):
        return b""
    values = values.astype(np.uint64)
    d = np.diff(values)
    low = max(0, ((int(values[-1]) - int(values[0])) // max(1, len(d))).bit_length() - 1)
    ends = np.cumsum((d >> np.uint64(low)).astype(np.int64) + 1)
    unary = np.zeros(ends[-1] if len(d) else 0, np.uint8)
    unary[ends - 1] = 1
    bits = [np.packbits((d >> np.uint64(i)).astype(np.uint8) & 1).tobytes() for i in range(low // 8 * 8, low)]
    head = bytes([low]) + len(d).to_bytes(4, "little") + int(values[0]).to_bytes(8, "little")
    return b"".join([head, d.view(np.uint8).reshape(-1, 8).T[: low // 8].tobytes(), *bits, np.packbits(unary).tobytes()])


def unpack_tight(blob: bytes) -> np.ndarray:
    if not blob:
        return np.empty(0, np.uint64)
    low, n, x = blob[0], int.from_bytes(blob[1:5], "little"), np.frombuffer(blob, np.uint8, offset=13)
    whole, plane = low // 8, (n + 7) // 8
    d = np.zeros((n + 1, 8), np.uint8)
    d[1:, :whole] = x[: whole * n].reshape(whole, n).T
    d[0] = np.frombuffer(blob, np.uint8, 8, 5)
    d, x = d.reshape(-1).view(np.uint64), x[whole * n :]
    for i in range(whole * 8, low):
        d[1:] |= np.unpackbits(x[:plane], count=n).astype(np.uint64) << np.uint64(i)
        x = x[plane:]
    d[1:] |= (np.diff(np.flatnonzero(np.unpackbits(x)), prepend=-1) - 1).astype(np.uint64) << np.uint64(low)
    return np.cumsum(d, dtype=np.uint64)


def _pack_names(names: np.ndarray) -> bytes:
    """Ascending signed names."""
    return pack_tight(names.view(np.uint64) ^ np.uint64(1 << 63))


def _unpack_names(blob: bytes) -> np.ndarray:
    return (unpack_tight(blob) ^ np.uint64(1 << 63)).view(np.int64)


def _send(sent, buckets: int, percent: int, n: int, name_bits: int, sig_bits: int):
    """Units of documents as rows (bucket, nodes, keys, heads): each signature once, from the unit's least set.

    A key holds the signature, whether the unit has it again, and the set's
    place in ``nodes``. Sets that repeat a signature within their unit are known
    to share it with the unit's first one (``heads``); their keys skip the
    meeting, in buckets of their own.
    """
    width = np.uint64(UNIT_BITS + 1)
    edges = np.array([(b << sig_bits) // buckets for b in range(buckets + 1)], np.uint64)

    def unit(nodes: np.ndarray, sig: np.ndarray, of: np.ndarray) -> pa.RecordBatch:
        order = np.argsort(nodes)
        rank = np.empty(len(nodes), np.uint64)
        rank[order] = np.arange(len(nodes), dtype=np.uint64)
        nodes = nodes[order]
        keys = np.unique(((sig >> np.uint64(64 - sig_bits)) << width) | rank[of])
        again = np.append(False, (keys[1:] >> width) == (keys[:-1] >> width))
        head = np.flatnonzero(~again)
        multi = np.diff(np.append(head, len(keys))) > 1
        out = []
        heads = keys[head] | (multi.astype(np.uint64) << np.uint64(UNIT_BITS))
        cuts = np.searchsorted(heads >> width, edges)
        place = np.uint64((1 << UNIT_BITS) - 1)
        for b in np.flatnonzero(cuts[1:] > cuts[:-1]).tolist():
            part = heads[cuts[b] : cuts[b + 1]]
            used, at = np.unique(part & place, return_inverse=True)
            out.append((b, _pack_names(nodes[used.astype(np.int64)]), pack_tight((part & ~place) | at.astype(np.uint64)), None))
        rest = np.flatnonzero(again)
        if len(rest):
            first = (keys & place)[head[np.searchsorted(head, rest, "right") - 1]].astype(np.uint16)
            for i in range(0, len(rest), 1 << 14):
                out.append((buckets + int(abs(int(nodes[0])) + i) % buckets, _pack_names(nodes), pack_tight(keys[rest[i : i + (1 << 14)]]), first[i : i + (1 << 14)].tobytes()))
        kinds = (pa.int32(), pa.binary(), pa.binary(), pa.binary())
        return pa.RecordBatch.from_arrays([pa.array([x[i] for x in out], t) for i, t in enumerate(kinds)], names=["bucket", "nodes", "keys", "heads"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frequent, clash = sent.value
        nodes, sigs, docs, seen, size = [], [], [], set(), 0

        def whole():
            return unit(_joined(nodes), _joined(sigs), _joined(docs))

        for batch in batches:
            for _, _, x, at in shingle_sets(batch.column(0), n):
                name, count = _names(set_hashes(x, at), clash, name_bits), np.diff(at)
                known = set() | seen
                fresh = np.array([k for k, (m, c) in enumerate(zip(name.tolist(), count.tolist())) if c and m not in known and not known.add(m)], np.int64)
                for i in range(0, len(fresh), 1 << UNIT_BITS):
                    d = fresh[i : i + (1 << UNIT_BITS)]
                    if nodes and (len(seen) + len(d) > 1 << UNIT_BITS or size >= UNIT_SIGNATURES):
                        yield whole()
                        nodes, sigs, docs, seen, size = [], [], [], set(), 0
                    sig, of = signatures(x[spans(at[d], count[d])], np.concatenate([[0], np.cumsum(count[d])]), frequent, percent)
                    docs.append(of + len(seen))
                    nodes.append(name[d])
                    sigs.append(sig)
                    seen.update(name[d].tolist())
                    size += len(sig)
        if size:
            yield whole()

    return run


def _meet(buckets: int):
    """Of a bucket's keys, (sig, node, centre) of the signatures that two or more sets share; the centre has it too."""
    width, place = np.uint64(UNIT_BITS + 1), np.uint64((1 << UNIT_BITS) - 1)

    def run(table: pa.Table) -> pa.Table:
        sig, node, last = [], [], []
        passed = table.column("bucket")[0].as_py() >= buckets
        for row_nodes, row_keys, row_heads in zip(*(table.column(c) for c in ("nodes", "keys", "heads"))):
            nodes, x = _unpack_names(row_nodes.as_py()), unpack_tight(row_keys.as_py())
            sig.append(x >> width)
            node.append(nodes[(x & place).astype(np.int64)])
            last.append(nodes[np.frombuffer(row_heads.as_py(), np.uint16)] if passed else (x >> np.uint64(UNIT_BITS)) & np.uint64(1) == 1)
        s, d, m = map(_joined, (sig, node, last))
        if not passed:
            # Most signatures have one row, which only counts if its unit has the signature again; the others go before the rest is done.
            order = np.argsort(s, kind="stable")
            s, met = s[order], m[order]
            same = s[1:] == s[:-1]
            met[1:] |= same
            met[:-1] |= same
            order, s = order[met], s[met]
            d, m = d[order], m[order]
        if not passed and not len(s):
            m = d
        elif not passed:
            order = np.lexsort((d, s))
            s, d, m = s[order], d[order], m[order]
            starts = np.flatnonzero(np.append(True, s[1:] != s[:-1]))
            runs = np.diff(np.append(starts, len(s)))
            wanted = np.logical_or.reduceat(m, starts) | (d[starts] != d[starts + runs - 1])
            fresh = np.append(True, (s[1:] != s[:-1]) | (d[1:] != d[:-1])) & np.repeat(wanted, runs)
            s, d, m = s[fresh], d[fresh], np.repeat(d[starts], runs)[fresh]
        give_back()
        return pa.table({"sig": s.astype(np.int64), "node": d, "centre": m})

    return run


def _joined(parts: list[np.ndarray]) -> np.ndarray:
    """One array of all ``parts``, which are let go."""
    out = np.concatenate(parts)
    parts.clear()
    return out


def parity(hashes: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """For each of 1,024 cells whether an odd number of a set's hashes falls into it, as a row of 16 words for each set.

    A shingle that only one of two sets has flips one cell, so the sketches
    differ in no more cells than the sets differ in shingles.
    """
    cells, m = PARITY * 64, len(bounds) - 1
    own = np.repeat(np.arange(m), np.diff(bounds))
    bits = np.bincount(own * cells + (hashes & np.uint64(cells - 1)).astype(np.int64), minlength=m * cells) & 1
    return np.packbits(bits.astype(np.uint8)).view(np.int64).reshape(m, PARITY)


def wide_parity(hashes: np.ndarray) -> bytes | None:
    """The parity sketch of a set in 2 to 4 cells a shingle (MOST_WIDE at most); none if ``parity`` has as many."""
    cells = min(MOST_WIDE, 1 << max(1, 2 * len(hashes) - 1).bit_length())
    if cells <= PARITY * 64:
        return None
    bits = np.bincount((hashes & np.uint64(cells - 1)).astype(np.int64), minlength=cells) & 1
    return np.packbits(bits.astype(np.uint8)).tobytes()


def _arrow(judge):
    """``judge``, which takes values row by row, as a function of Arrow columns."""

    def run(columns: Iterator[tuple[pa.Array, ...]]) -> Iterator[pa.Array]:
        for batch in columns:
            yield pa.array(judge(*((v.as_py() for v in c) for c in batch)), pa.bool_())
        give_back()

    return F.arrow_udf(run, "boolean")


def _may(a: Iterable[bytes | None], b: Iterable[bytes | None], total: Iterable[int], percent: Iterable[int]) -> list[bool]:
    """Whether the wide sketches let two sets be similar; the halves of the longer one are added up to the length of the other."""
    out = []
    for x, y, t, p in zip(a, b, total, percent):
        if x is None or y is None:
            out.append(True)
            continue
        u, v = sorted((np.frombuffer(x, np.uint8), np.frombuffer(y, np.uint8)), key=len)
        while len(v) > len(u):
            v = v[: len(v) // 2] ^ v[len(v) // 2 :]
        out.append(int(np.bitwise_count(u ^ v).sum()) <= t - 2 * -(-t * p // (100 + p)))
    return out


def _near(percent: int) -> Column:
    """Whether the sizes and sketches of a (na, a0, ..) and b (nb, b0, ..) let the two sets be similar."""
    total = F.col("na") + F.col("nb")
    apart = sum((F.bit_count(F.col(f"a{i}").bitwiseXOR(F.col(f"b{i}"))) for i in range(PARITY)), F.lit(0))
    sizes = (F.col("nb") * 100 >= F.col("na") * percent) & (F.col("na") * 100 >= F.col("nb") * percent)
    return sizes & (apart <= total - 2 * F.ceil(total * percent / (100 + percent)))


def _sketch(sets: DataFrame, side: str) -> DataFrame:
    return sets.select(F.col("id").alias(side), F.col("size").alias(f"n{side}"), *[F.col(f"p{i}").alias(f"{side}{i}") for i in range(PARITY)])


def _similar(a: Iterable[bytes], b: Iterable[bytes], percent: Iterable[int]) -> list[bool]:
    out = []
    for x, y, p in zip(a, b, percent):
        u, v = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
        both = len(np.intersect1d(u, v, assume_unique=True))
        out.append(100 * both >= p * (len(u) + len(v) - both))
    return out


def _sets(source: DataFrame, wanted: DataFrame, n: int, sent, name_bits: int, scratch: Scratch) -> DataFrame:
    """(id, size, members, wide sketch, sketch) of the sets of the rows in ``wanted`` (row).

    Up to FEW_IDS rows are looked for by their hashes; more by a filter of fixed
    size, which lets some others in too.
    """
    if wanted.limit(FEW_IDS + 1).count() <= FEW_IDS:
        near = source.select("text", _row("doc_id", "th").alias("row")).join(F.broadcast(wanted), "row", "left_semi")
    else:
        at = F.pmod("row", F.lit(ID_BITS))
        bits = wanted.select(at.alias("at")).groupBy(F.expr("cast(at div 32768 as int)").alias("word")).agg(F.expr("bitmap_construct_agg(at % 32768)").alias("bits"))
        near = source.select("text", F.pmod(_row("doc_id", "th"), F.lit(ID_BITS)).alias("at")).withColumn("word", F.expr("cast(at div 32768 as int)"))
        near = near.join(F.broadcast(bits), "word")  # 256 rows of 4 KB at most
        near = near.filter(F.expr("(cast(conv(hex(substr(bits, cast((at % 32768) div 8 as int) + 1, 1)), 16, 10) as int) >> cast(at % 8 as int)) & 1 = 1"))
    names = [f"p{i}" for i in range(PARITY)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        clash, seen = sent.value[1], set()
        for batch in batches:
            for _, _, x, at in shingle_sets(batch.column(0), n):
                name, count = _names(set_hashes(x, at), clash, name_bits), np.diff(at)
                fresh = np.array([k for k, (m, c) in enumerate(zip(name.tolist(), count.tolist())) if c and m not in seen and not seen.add(m)], np.int64)
                for i in range(0, len(fresh), 256):
                    d = fresh[i : i + 256]
                    own, ends = x[spans(at[d], count[d])], np.concatenate([[0], np.cumsum(count[d])])
                    members = pa.array([own[a:b].tobytes() for a, b in zip(ends.tolist(), ends[1:].tolist())], pa.binary())
                    wide = pa.array([wide_parity(own[a:b]) for a, b in zip(ends.tolist(), ends[1:].tolist())], pa.binary())
                    yield pa.RecordBatch.from_arrays([pa.array(name[d]), pa.array(count[d]), members, wide, *(pa.array(c) for c in parity(own, ends).T)], names=["id", "size", "members", "wide", *names])

    sets = scratch.table(near.select("text").mapInArrow(lean(run), "id long, size long, members binary, wide binary, " + ", ".join(f"{x} long" for x in names)), "sets")
    # A task gives a set once; rows that repeat an id and its text, or that a full filter lets in, can give it in two tasks.
    twice = sets.groupBy("id").count().filter("count > 1").limit(1).count()
    return scratch.table(sets.dropDuplicates(["id"]), "sets1") if twice else sets


def _row(doc_id: str, th: str) -> Column:
    return F.xxhash64(F.col(doc_id), F.col(th))


def _classes(docs: DataFrame, n: int, percent: int, buckets: int | None, name_bits: int | None, scratch: Scratch) -> DataFrame:
    """(doc_id, th, n_shingles, n_copies, best) of every row: ``th`` hashes its text, ``best`` is the first row (no_id, doc_id, th) of its class."""
    spark = docs.sparkSession
    text = F.col("text").cast("binary")
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("th"), text.alias("text"))
    words, rows = source.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)), F.count("*")).first()
    words //= 6
    name_bits = name_bits or min(64, rows.bit_length() + NAME_SPARE)
    sig_bits = min(SIG_BITS, words.bit_length() + SPARE_BITS)
    bits = min(MOST_CELLS, max(LEAST_CELLS, (words // CELL_WORDS).bit_length()))
    survey = source.mapInArrow(lean(_survey(n, bits, name_bits)), "doc_id long, th long, n_shingles long, h1 long, h2 long, slice int, counts binary")
    survey = scratch.table(survey, "survey")
    meta = survey.filter("slice is null").drop("slice", "counts")
    key = ["n_shingles", "h1", "h2"]
    first_row = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "th")
    groups = meta.filter("n_shingles > 0").groupBy(*key).agg(F.min(first_row).alias("rep"), F.count("*").alias("n_copies"))
    groups = scratch.table(groups, "groups")
    clash = [r[0] for r in groups.groupBy("h1").count().filter("count > 1").select("h1").limit(FEW_IDS).collect()]  # about one in 2**(NAME_SPARE + 1) rows
    again = spark.createDataFrame([(x,) for x in clash], "h1 long").withColumn("clash", F.lit(True))
    groups = groups.join(F.broadcast(again), "h1", "left").withColumn("node", F.when(F.col("clash"), F.col("h2")).otherwise(F.col("h1"))).drop("clash")
    sent = spark.sparkContext.broadcast((frequent_cells(survey, bits, scratch), np.array(sorted(clash), np.int64)))
    if buckets is None:
        buckets = bucket_count(words)

    units = source.select("text").mapInArrow(lean(_send(sent, buckets, percent, n, name_bits, sig_bits)), "bucket int, nodes binary, keys binary, heads binary")
    shared = scratch.table(units.groupBy("bucket").applyInArrow(_meet(buckets), "sig long, node long, centre long"), "shared")
    stars = scratch.table(shared.filter("node <> centre").select(F.col("centre").alias("a"), F.col("node").alias("b")).distinct(), "stars")
    wanted = stars.select(F.explode(F.array("a", "b")).alias("node")).distinct().join(groups, "node").select(_row("rep.doc_id", "rep.th").alias("row"))
    sets = _sets(source, scratch.table(wanted, "wanted"), n, sent, name_bits, scratch)

    similar, may = _arrow(_similar), _arrow(_may)
    links, comp, checked = None, None, None
    for k in range(3):
        if k == 0:
            pairs = stars.groupBy("b").agg(F.min("a").alias("a")).select("a", "b")
        elif k == 1:
            pairs = _apart(stars, comp)
        else:
            pairs = _open_pairs(shared, comp, sets, percent, scratch).join(checked, ["a", "b"], "left_anti")
        asked = scratch.table(pairs, f"pairs{k}")
        checked = asked if checked is None else checked.unionByName(asked)
        fit = asked
        if k < 2:
            near = asked.join(_sketch(sets, "a"), "a").join(_sketch(sets, "b"), "b").filter(_near(percent))
            fit = scratch.table(near.select("a", "b"), f"near{k}")
        few = fit.limit(FEW_PAIRS + 1).count() <= FEW_PAIRS
        # Only sets that are asked for travel: first their wide sketches, then those that these don't tell apart.
        both = _with(_with(fit, sets, "a", few, "size", "wide"), sets, "b", few, "size", "wide")
        fit = scratch.table(both.filter(may("widea", "wideb", F.col("sizea") + F.col("sizeb"), F.lit(percent))).select("a", "b"), f"fit{k}")
        both = _with(_with(fit, sets, "a", few, "members"), sets, "b", few, "members")
        true = both.filter(similar("membersa", "membersb", F.lit(percent))).select("a", "b")
        true = scratch.table(true.distinct(), f"links{k}")
        links = true if links is None else links.unionByName(true)
        comp = connected(links, scratch, f"comp{k}")
    sent.unpersist()
    linked = groups.join(comp.withColumnRenamed("id", "node"), "node")
    best = scratch.table(linked.groupBy("comp").agg(F.min("rep").alias("best"), F.count("*").alias("n")), "best")
    linked = join_unique(linked, best, ["comp"], "n").select("node", "best")
    classes = scratch.table(groups.join(linked, "node", "left").select(*key, "n_copies", F.coalesce("best", "rep").alias("best")), "classes")
    found = join_unique(meta.filter("n_shingles > 0"), classes, key, "n_copies")
    alone = meta.filter("n_shingles = 0").withColumn("best", first_row).withColumn("n_copies", F.lit(1).cast("long"))
    return found.unionByName(alone).select("doc_id", "th", "n_shingles", "n_copies", "best")


def bucket_count(words: int) -> int:
    """Buckets that signatures of a corpus of so many words fall into: in proportion, as a unit's rows in each cost a head and names."""
    return max(16, -(-words // BUCKET_KEYS))


def _with(pairs: DataFrame, sets: DataFrame, c: str, few: bool, *columns: str) -> DataFrame:
    """``pairs`` with columns of the sets that their column ``c`` names; of the others nothing is shuffled."""
    ids = pairs.select(F.col(c).alias("id")).distinct()
    held = sets.join(F.broadcast(ids) if few else ids, "id", "left_semi")
    return pairs.join(held.select(F.col("id").alias(c), *[F.col(x).alias(f"{x}{c}") for x in columns]), c)


def _apart(pairs: DataFrame, comp: DataFrame) -> DataFrame:
    """The pairs whose two ids are not in one class yet."""
    ca = small(comp.select(F.col("id").alias("a"), F.col("comp").alias("ca")))
    cb = small(comp.select(F.col("id").alias("b"), F.col("comp").alias("cb")))
    both = pairs.join(ca, "a", "left").join(cb, "b", "left")
    return both.filter(F.coalesce("ca", "a") != F.coalesce("cb", "b")).select("a", "b")


def _open_pairs(shared: DataFrame, comp: DataFrame, sets: DataFrame, percent: int, scratch: Scratch) -> DataFrame:
    """All pairs (a, b) that share a signature, are in different classes, and that sizes and sketches let be similar.

    A signature of many sets is salted: each row meets its partners in parts of
    PAIR_ROWS, which are dealt to tasks like keys of their own.
    """
    at = shared.join(small(comp.withColumnRenamed("id", "node")), "node", "left").select("sig", "node", F.coalesce("comp", "node").alias("comp"))
    per = at.groupBy("sig").agg(F.min("comp").alias("low"), F.max("comp").alias("high"), F.count("*").alias("m")).filter("low <> high")
    salts = F.ceil(F.col("m") / PAIR_ROWS).cast("int").alias("salts")
    per = scratch.table(per.select("sig", salts), "open-signatures")
    at = scratch.table(at.join(small(per), "sig").distinct(), "open")
    x = at.select("sig", F.col("node").alias("a"), F.col("comp").alias("ca"), F.pmod(F.xxhash64("node"), "salts").cast("int").alias("salt"))
    y = at.select("sig", F.col("node").alias("b"), F.col("comp").alias("cb"), F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"))
    # Rows take their sketches along; those of a set stand side by side after the join, where they compress.
    x, y = x.join(_sketch(sets, "a").hint("merge"), "a"), y.join(_sketch(sets, "b").hint("merge"), "b")
    differ = (F.col("ca") != F.col("cb")) & (F.col("a") < F.col("b"))
    return x.join(y, ["sig", "salt"]).filter(differ & _near(percent)).select("a", "b").distinct()


def similar_classes(docs: DataFrame, n: int = 5, percent: int = 80, buckets: int | None = None, name_bits: int | None = None) -> DataFrame:
    """One row per document: (doc_id, n_shingles, component_id, n_copies).

    Words are lower-cased (A-Z); a document's set is its distinct n-word
    shingles, the whole word sequence as one if it is shorter. Two documents
    link when 100 * intersection >= percent * union; ``component_id`` is the
    least doc_id that links reach. Null and empty texts have an empty set and
    stay alone. Rows are told apart by their sets, not by their ids: rows that
    repeat an id or have none are documents of their own. A null doc_id counts
    as the largest, so a class has a null component_id only if none of its rows
    has an id. Other columns are not read; an empty table gives no rows.

    Copies of a set are one member, named by ``name_bits`` of a hash (by default
    as many as the rows need; sets that share a name get another, longer one). Candidate pairs are checked in three
    rounds, each leaving out pairs that are in one class already: every set with
    the least one it shares a signature with; with one of each signature; then
    all pairs that share a signature. No candidate is capped.
    """
    out = _classes(docs, n, percent, buckets, name_bits, Scratch(docs.sparkSession))
    return out.select("doc_id", "n_shingles", F.col("best.doc_id").alias("component_id"), "n_copies")


def drop_similar(docs: DataFrame, n: int = 5, percent: int = 80, buckets: int | None = None) -> DataFrame:
    """``docs`` with one document of each class: the one with the least id (null ids last), then the least hash of the text.

    Documents without words all stay. Of rows that repeat both id and text one
    stays; they are found by the count of rows, so that a table without repeats
    is not shuffled for it. The columns of ``docs`` may have any names.
    """
    scratch = Scratch(docs.sparkSession)
    found = scratch.table(_classes(docs, n, percent, buckets, None, scratch), "similar").filter("n_shingles > 0")
    is_best = F.col("doc_id").eqNullSafe(F.col("best.doc_id")) & (F.col("th") == F.col("best.th"))
    gone = scratch.table(found.filter(~is_best).select("doc_id", "th").distinct(), "gone")
    out = _rows_in(docs, gone, "left_anti")
    again = found.filter(is_best).groupBy("doc_id", "th").count().filter("count > 1").select("doc_id", "th")
    if again.isEmpty():
        return out
    again, rest = scratch.table(again, "again"), Window.partitionBy("doc_id", "text").orderBy(F.lit(0))
    place = spare(docs, "place")
    once = _rows_in(out, again, "left_semi").withColumn(place, F.row_number().over(rest)).filter(F.col(place) == 1).drop(place)
    return _rows_in(out, again, "left_anti").unionByName(once)


def _rows_in(docs: DataFrame, rows: DataFrame, how: str) -> DataFrame:
    """Rows of ``docs`` whose id and text hash are (or are not) in ``rows`` (doc_id, th)."""
    few = rows.limit(FEW_IDS + 1).count() <= FEW_IDS
    on = docs["doc_id"].cast("long").eqNullSafe(rows["doc_id"]) & (F.xxhash64(docs["text"].cast("binary")) == rows["th"])
    return docs.join(F.broadcast(rows) if few else rows, on, how)
