"""Similarity of text pairs and retention of repeated terms."""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spanloom.functions.porter import stems
from spanloom.functions.text import RUN, collapse, protected_stripped

from .sampling import range_positions

#: Labels in brackets whose content stays, in English and Russian.
GREEK_LABEL = r"(?iu)\[(?:Greek|греч\.?|греческ[^:\]]*)\s*:\s*([^\]]*)\]"
PICTURE_LABEL = r"(?iu)\[(?:Illustration|Иллюстрация)\s*:\s*([^\]]*)\]"


def plain(text: Column) -> Column:
    """Text without underscores, bracketed labels and brackets, white space collapsed."""
    x = F.replace(text, F.lit("_"), F.lit(" "))
    for label in (GREEK_LABEL, PICTURE_LABEL):
        x = F.regexp_replace(x, label, " $1 ")
    return collapse(F.regexp_replace(x, r"[\[\](){}]", " "))


def _grams(value: Sequence | None, n: int) -> Counter:
    """Counts of the n-grams of a text (strings) or of a list of words (tuples)."""
    if value is None:
        return Counter()
    if not isinstance(value, str):
        value = tuple(value)
    return Counter(value[i : i + n] for i in range(len(value) - n + 1))


def _overlap(bag: Callable[[Sequence | None], Counter]):
    """A column function of two columns: struct(n_a, n_b, common) of their bags. Pairs stay rows: nothing is exploded or shuffled."""

    def run(a: pd.Series, b: pd.Series) -> pd.DataFrame:
        rows = [(x.total(), y.total(), (x & y).total()) for x, y in zip(map(bag, a), map(bag, b))]
        return pd.DataFrame(rows, columns=["n_a", "n_b", "common"])

    return F.pandas_udf(run, "n_a long, n_b long, common long")


def multiset_overlap(pairs: DataFrame, key: str, a: Column, b: Column) -> DataFrame:
    """(key, n_a, n_b, common): multiset sizes and intersection of two array columns, linear in their length."""
    return pairs.select(key, _overlap(lambda v: _grams(v, 1))(a, b).alias("o")).select(key, "o.*")


def _harmonic(o: Column) -> Column:
    """2 common / (n_a + n_b), the harmonic mean of precision and recall; two empty bags are equal."""
    return F.when(o["n_a"] + o["n_b"] == 0, 1.0).otherwise(2 * o["common"] / (o["n_a"] + o["n_b"]))


def _dice(source: Column, target: Column, n: int = 3) -> Column:
    bag = _overlap(lambda v: Counter([v]) if v and len(v) < n else _grams(v, n))
    return _harmonic(bag(F.lower(plain(source)), F.lower(plain(target))))


def _token_f1(source: Column, target: Column) -> Column:
    words = (F.regexp_extract_all(F.lower(plain(c)), F.lit(RUN), F.lit(0)) for c in (source, target))
    return _harmonic(_overlap(lambda v: _grams(v, 1))(*words))


def _chrf(source: Column, target: Column, chars: int = 6, words: int = 2, beta: float = 2.0) -> Column:
    def orders(letters: str, parts: Sequence[str]) -> list[Counter]:
        return [_grams(letters, n) for n in range(1, chars + 1)] + [_grams(parts, n) for n in range(1, words + 1)]

    def run(a: pd.Series, b: pd.Series, wa: pd.Series, wb: pd.Series) -> pd.Series:
        out = []
        for ref, hyp in zip(map(orders, a, wa), map(orders, b, wb)):
            both = [((x & y).total(), x.total(), y.total()) for x, y in zip(ref, hyp) if x and y]
            precision = sum(m / h for m, _, h in both) / len(both) if both else 0.0
            recall = sum(m / r for m, r, _ in both) / len(both) if both else 0.0
            bottom = beta * beta * precision + recall
            out.append(100 * (1 + beta * beta) * precision * recall / bottom if bottom else 0.0)
        return pd.Series(out, dtype=float)

    def split(c: Column) -> Column:
        spaced = F.regexp_replace(F.regexp_replace(collapse(c), r"(\S)([\p{Punct}])(?=\s|$)", "$1 $2"), r"(^|\s)([\p{Punct}])(\S)", "$1$2 $3")
        return F.filter(F.split(spaced, " "), lambda w: w != "")

    bare = (F.regexp_replace(c, r"\s+", "") for c in (source, target))
    return F.pandas_udf(run, "double")(*bare, split(source), split(target))


def dice(pairs: DataFrame, key: str, n: int = 3, source: str = "source", target: str = "target") -> DataFrame:
    """(key, char3_dice): Dice coefficient of the character n-gram multisets, a shorter text being its own only gram; two empty texts are equal."""
    return pairs.select(key, _dice(F.col(source), F.col(target), n).alias("char3_dice"))


def token_f1(pairs: DataFrame, key: str, source: str = "source", target: str = "target") -> DataFrame:
    """(key, token_f1): harmonic mean of precision and recall over word multisets."""
    return pairs.select(key, _token_f1(F.col(source), F.col(target)).alias("token_f1"))


def chrf(pairs: DataFrame, key: str, source: str = "source", target: str = "target", chars: int = 6, words: int = 2, beta: float = 2.0) -> DataFrame:
    """(key, chrf): chrF++ of a hypothesis (target) against a reference (source), 0 to 100.

    The F-beta of precision and recall, each averaged over the orders that both
    sides have: character n-grams up to ``chars`` without white space, word
    n-grams up to ``words`` with edge punctuation split off.
    """
    return pairs.select(key, _chrf(F.col(source), F.col(target), chars, words, beta).alias("chrf"))


def composite(pairs: DataFrame, key: str) -> DataFrame:
    """(key, chrf, token_f1, char3_dice, composite): half chrF++ and a quarter of each of the others, in one pass."""
    s, t = F.col("source"), F.col("target")
    out = pairs.select(key, _chrf(s, t).alias("chrf"), _token_f1(s, t).alias("token_f1"), _dice(s, t).alias("char3_dice"))
    return out.withColumn("composite", 0.5 * F.col("chrf") / 100 + 0.25 * F.col("token_f1") + 0.25 * F.col("char3_dice"))


def worst_first(rows: DataFrame, delta: str, key: str) -> DataFrame:
    """``rows`` with ``place`` from 1, the lowest delta first (ties by key); numbered by ranges, whatever their number."""
    placed = range_positions(rows.withColumn("_all", F.lit(0)), "_all", [delta, key])
    return placed.withColumn("place", F.col("i") + 1).drop("i", "n", "_all")


def delta_summary(rows: DataFrame, delta: str = "delta") -> DataFrame:
    """Mean, least and largest delta, and how many are better, worse and tied."""
    d = F.col(delta)
    return rows.agg(F.avg(d).alias("mean"), F.min(d).alias("least"), F.max(d).alias("largest"), F.count_if(d > 0).alias("better"), F.count_if(d < 0).alias("worse"), F.count_if(d == 0).alias("ties"))


def stem_counts(texts: DataFrame, key: str, text: str, least: int = 5, excluded: tuple[str, ...] = ()) -> DataFrame:
    """(key, stem, n, surfaces) of English words of at least ``least`` letters; distinct words are stemmed once."""
    words = texts.select(key, F.explode(F.regexp_extract_all(F.col(text), F.lit("[A-Za-z]+"), F.lit(0))).alias("surface"))
    words = words.withColumn("word", F.lower("surface")).filter((F.length("word") >= least) & ~F.col("word").isin(*excluded) if excluded else F.length("word") >= least)
    known = words.select("word").distinct().withColumn("stem", stems(F.col("word")))
    return words.join(known, "word").groupBy(key, "stem").agg(F.count("*").alias("n"), F.array_sort(F.collect_list("surface")).alias("surfaces"))


def retention(units: DataFrame, key: str, least: int = 2, keep: float = 0.75, collapse_at: float = 0.25, loss: int = 2) -> DataFrame:
    """Repeated stems of a source and how many a baseline and a candidate keep; ``collapsed`` marks heavy losses.

    ``units`` is (key, source, baseline, candidate).
    """
    s = stem_counts(units, key, "source").filter(F.col("n") >= least).select(key, "stem", F.col("n").alias("source_n"), "surfaces")
    b = stem_counts(units, key, "baseline").select(key, "stem", F.col("n").alias("b"))
    c = stem_counts(units, key, "candidate").select(key, "stem", F.col("n").alias("c"))
    out = s.join(b, [key, "stem"], "left").join(c, [key, "stem"], "left").fillna(0, ["b", "c"])
    out = out.withColumn("baseline_kept", F.least("source_n", "b")).withColumn("candidate_kept", F.least("source_n", "c")).drop("b", "c")
    gone = F.col("baseline_kept") - F.col("candidate_kept")
    collapsed = (F.col("baseline_kept") / F.col("source_n") >= keep) & (F.col("candidate_kept") / F.col("source_n") <= collapse_at) & (gone >= loss)
    return out.withColumn("collapsed", collapsed)


def mixed_case_stems(texts: DataFrame, key: str, text: str = "text", least: int = 5) -> DataFrame:
    """(key, stem, n): stems that occur at least twice, both capitalised and in lower case, outside protected spans."""
    bare = texts.select(key, protected_stripped(F.col(text)).alias("_t"))
    return mixed_case(stem_counts(bare, key, "_t", least))


def mixed_case(counts: DataFrame) -> DataFrame:
    title = F.exists("surfaces", lambda s: s.rlike("^[A-Z][a-z]+$"))
    lower = F.exists("surfaces", lambda s: s.rlike("^[a-z]+$"))
    return counts.filter((F.col("n") >= 2) & title & lower).drop("surfaces")
