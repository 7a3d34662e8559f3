"""Benchmark decontamination: rare word pairs as seeds find passages, Smith-Waterman alignment scores them."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch, Words, id_back, id_or, lean, mix, rolling, without

#: Bytes of benchmark text that one pass over the documents looks for.
BLOCK_BYTES = 4 << 20
MATCH, MISMATCH, GAP = 2, 1, 1
#: Lower-case letters; ASCII signs count as white space, all other bytes stay.
FOLD = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))


FOLDED = Words(FOLD)


def smith_waterman(item: np.ndarray, region: np.ndarray) -> tuple[int, int, int]:
    """Best local alignment of two word sequences: (score, start, end) with the span in ``region``.

    A row of the matrix depends on its left neighbour only through gaps, so a
    running maximum gives the whole row at once; each cell carries where its
    alignment began.
    """
    m = len(region)
    steps = GAP * np.arange(m + 1)
    h, begin = np.zeros(m + 1, np.int64), np.arange(m + 1)
    best = (0, 0, 0)
    for word in item:
        diagonal = h[:-1] + np.where(region == word, MATCH, -MISMATCH)
        up = h[1:] - GAP
        cell = np.zeros(m + 1, np.int64)
        cell[1:] = np.maximum(np.maximum(diagonal, up), 0)
        origin = np.arange(m + 1)
        origin[1:] = np.where(cell[1:] == 0, origin[1:], np.where(diagonal >= up, begin[:-1], begin[1:]))
        lifted = cell + steps
        top = np.maximum.accumulate(lifted)
        source = np.maximum.accumulate(np.where(lifted == top, np.arange(m + 1), 0))
        h, begin = top - steps, origin[source]
        if (k := int(h.argmax())) and h[k] > best[0]:
            best = (int(h[k]), int(begin[k]), k)
    return best


class Seeds:
    """Hashes of short word patterns of a list of items, and where each occurs in them."""

    items: list[tuple[int, np.ndarray]]
    sizes: list[int]
    hash: np.ndarray
    item: np.ndarray
    at: np.ndarray

    def _set(self, rows: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> np.ndarray:
        """Takes (hash, item, place) in any order; gives the order they are kept in."""
        hash_, item, at = (np.concatenate(c) for c in zip(*rows)) if rows else (np.empty(0, np.int64),) * 3
        order = np.argsort(hash_, kind="stable")
        self.hash, self.item, self.at = hash_[order].astype(np.uint64), item[order], at[order]
        self.keys = np.unique(self.hash)
        self._gate()
        return order

    def _gate(self) -> None:
        self.gate = np.zeros(1 << 20, bool)
        self.gate[self.keys >> np.uint64(44)] = True

    def grams(self, words: np.ndarray, size: int) -> np.ndarray:
        return word_pairs(words, size)

    def find(self, words: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(text, position in it, index in keys) of every seed in texts laid end to end, in the order of the texts."""
        where, which, after = [], [], []
        for n in self.sizes:
            h = self.grams(words, n)
            p = np.flatnonzero(self.gate[h >> np.uint64(44)])
            k = np.searchsorted(self.keys, h[p])
            good = k < len(self.keys)
            p, k = p[good], k[good]
            good = self.keys[k] == h[p]
            where.append(p[good])
            which.append(k[good])
            after.append(p[good] + n)
        if not where:
            return (np.empty(0, np.int64),) * 3
        where, which, after = (np.concatenate(x) for x in (where, which, after))
        text = np.searchsorted(bounds, where, "right") - 1
        inside = after < bounds[text + 1]  # a pattern must not reach into the next text
        order = np.flatnonzero(inside)[np.argsort(text[inside], kind="stable")]
        return text[order], where[order] - bounds[text[order]], which[order]


def by_text(text: np.ndarray, *columns: np.ndarray) -> Iterator[tuple]:
    """(text, columns) for each run of rows of one text."""
    if len(text):
        for part in np.split(np.arange(len(text)), np.flatnonzero(np.diff(text)) + 1):
            yield (int(text[part[0]]), *(c[part] for c in columns))


def sure_pairs(m: int, n: int, threshold: float) -> int:
    """Pairs of neighbouring matches, less than ``n`` words apart on both sides, that every alignment from ``threshold`` on has.

    An alignment of c matches and g mismatches and gaps has c - 1 steps from a
    match to the next. 2c - g is at least 2 * threshold * m, and a step that
    reaches n words or farther costs n - 1 of g at least.
    """
    least = 2 * threshold * m - 1e-9
    return min((c - 1 - int((2 * c - least) // max(n - 1, 1)) for c in range(max(1, -int(-least // 2)), m + 1)), default=0)


def word_pairs(words: np.ndarray, gap: int) -> np.ndarray:
    """Hash of every word with the one ``gap`` after it; gap 0: of the word alone."""
    if not gap:
        return rolling(words, 1)
    return mix(words[:-gap] * np.uint64(0x9E3779B97F4A7C15) + words[gap:])


class PairSeeds(Seeds):
    """Pairs of words less than ``n`` apart in a block of benchmark items, by the place of their first word.

    Every alignment from ``threshold`` on holds pairs at ``sure_pairs`` places
    of its item, so one at least is among any ``quota`` = places - sure + 1 of
    them. Items too short to be sure of a pair are found by their words.
    """

    def __init__(self, items: list[tuple[int, bytes]], n: int, threshold: float):
        self.items = [(i, w) for i, t in items if len(w := FOLDED.of(t))]
        rows, places, quota, used = [], [], [], set()
        for k, (_, words) in enumerate(self.items):
            m, sure = len(words), sure_pairs(len(words), n, threshold)
            gaps = range(1, min(n, m)) if sure > 0 else (0,)
            places.append(m - gaps[0])
            quota.append(places[-1] + 1 - (sure if sure > 0 else max(1, -int(-(threshold * m - 1e-9) // 1))))
            used.update(gaps)
            rows += [(h := word_pairs(words, g), np.full(len(h), k), np.arange(len(h))) for g in gaps]
        self.sizes = sorted(used)
        self.places, self.quota = np.array(places, np.int64), np.array(quota, np.int64)
        self._set(rows)

    def keep_rare(self, df: np.ndarray) -> None:
        """Keeps each item's ``quota`` places whose pairs the fewest documents hold, less pairs that none holds."""
        count = df[np.searchsorted(self.keys, self.hash)]
        first = np.cumsum(self.places) - self.places
        place = first[self.item] + self.at
        cost = np.bincount(place, count, int(self.places.sum()))
        item = np.repeat(np.arange(len(self.places)), self.places)
        order = np.lexsort((cost, item))
        kept = np.zeros(len(cost), bool)
        kept[order] = np.arange(len(cost)) - first[item] < self.quota[item]
        held = kept[place] & (count > 0)
        self.hash, self.item, self.at = self.hash[held], self.item[held], self.at[held]
        self.keys = np.unique(self.hash)
        self._gate()


def _frequencies(seeds):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = seeds.value
        df = np.zeros(len(own.keys), np.int64)
        for batch in batches:
            for _, _, words, at in FOLDED.chunks(batch.column(1)):
                text, _, which = own.find(words, at)
                np.add.at(df, np.unique(text * len(df) + which) % max(len(df), 1), 1)
        k = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(k, pa.int64()), pa.array(df[k], pa.int64())], names=["k", "n"])

    return run


def _align(seeds, threshold: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = seeds.value
        first = np.searchsorted(own.hash, own.keys, "left")
        last = np.searchsorted(own.hash, own.keys, "right")
        for batch in batches:
            ids, rows = batch.column(0).to_numpy(), []
            for i, _, words, at in FOLDED.chunks(batch.column(1)):
                for k, where, which in by_text(*own.find(words, at)):
                    rows += [(ids[i + k], *r) for r in _aligned(own, words[at[k] : at[k + 1]], where, which, first, last, threshold)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[i] for r in rows], t) for i, t in enumerate((pa.int64(), pa.int64(), pa.float64(), pa.int64(), pa.int64()))],
                names=["doc_id", "item_id", "score", "start_word", "end_word"],
            )

    return run


def _aligned(own: Seeds, words, where, which, first, last, threshold) -> list[tuple]:
    """(item_id, score, start, end) of the items that a document holds, each at its best place."""
    n = last[which] - first[which]
    row = np.repeat(first[which], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    item, begin = own.item[row], np.repeat(where, n) - own.at[row]
    order = np.lexsort((begin, item))
    item, begin = item[order], begin[order]
    out = []
    for part in np.split(np.arange(len(item)), np.flatnonzero(np.diff(item)) + 1):
        k = int(item[part[0]])
        item_id, wanted = own.items[k]
        # An alignment from the threshold on has no more gaps, so it lies this near to its seeds.
        slack = int(2 * len(wanted) * max(0.0, 1 - threshold) + 1e-9)
        starts = begin[part]
        best = (0.0, 0, 0)
        # Places that overlap are one region.
        for group in np.split(starts, np.flatnonzero(np.diff(starts) > len(wanted) + 2 * slack) + 1):
            a = max(0, int(group[0]) - slack)
            region = words[a : int(group[-1]) + len(wanted) + slack]
            # Words in common bound the score from above.
            if np.isin(wanted, region).sum() < threshold * len(wanted):
                continue
            score, i, j = smith_waterman(wanted, region)
            best = max(best, (score / (MATCH * len(wanted)), -(a + i), a + j))
        if best[0] >= threshold:
            out.append((item_id, best[0], -best[1], best[2]))
    return out


def find_leaks(docs: DataFrame, benchmark: DataFrame, n: int = 3, threshold: float = 0.5, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(doc_id, item_id, score, start_word, end_word) of every document that holds an item.

    Words are lower-cased (A-Z), ASCII signs part them. Item and passage are
    aligned by Smith-Waterman over words (match 2, mismatch and gap -1);
    ``score`` is the best alignment's share of a perfect one, and all pairs from
    ``threshold`` on are returned, each once, at the best (first) place. 1.0 is
    an exact copy.

    Seeds show where to align: an item's pairs of words less than ``n`` apart
    (its words, if it is too short for pairs). An alignment from ``threshold``
    on cannot do without a certain number of them, so only the places with the
    rarest pairs, by document frequency, are looked for, as many as cannot all
    be missing. No pair is lost by that, whichever copies the documents hold.

    Null and empty texts and items hold nothing. Rows that repeat a document or
    an item repeat its results. A null doc_id comes back null; empty tables give
    no rows; other columns are not read. The benchmark is looked for in blocks
    of ``block_bytes``, so what is sent to the tasks stays bounded.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark)
    source = docs.select(id_or("doc_id"), F.col("text").cast("binary").alias("text"))
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("binary").alias("text")).filter("text is not null")
    size = items.agg(F.sum(F.octet_length("text") + 64)).first()[0] or 0
    blocks = -(-size // block_bytes) or 1
    out = None
    for b in range(blocks):
        own = items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == b)
        seeds = PairSeeds([(r["item_id"], bytes(r["text"])) for r in own.collect()], n, threshold)
        df = np.zeros(len(seeds.keys), np.int64)
        sent = spark.sparkContext.broadcast(seeds)
        counts = source.mapInArrow(lean(_frequencies(sent)), "k long, n long").groupBy("k").agg(F.sum("n").alias("n"))
        counts = counts.toArrow()  # one row for each seed of the block
        df[counts["k"].to_numpy()] = counts["n"].to_numpy()
        seeds.keep_rare(df)
        sent = spark.sparkContext.broadcast(seeds)
        found = source.mapInArrow(lean(_align(sent, threshold)), "doc_id long, item_id long, score double, start_word long, end_word long")
        found = found if blocks == 1 else scratch.table(found, f"found{b}")
        out = found if out is None else out.unionByName(found)
    return out.select(id_back("doc_id"), "item_id", "score", "start_word", "end_word")


def drop_leaks(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """``docs`` without the documents that hold a benchmark item.

    Rows that share an id go together, those without an id too.
    """
    found = find_leaks(docs, benchmark, **options).select(id_or("doc_id").alias("leak")).distinct()
    return without(docs, Scratch(docs.sparkSession).table(found, "leaks"), "leak")
