"""Segments with exact offsets: sentences, lines, word runs, chunks, blocks, islands, planning units."""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spanloom.functions import text as T
from spanloom.functions.arrays import held, let

HARD_LIMIT = 96


def sentence_units(docs: DataFrame, least: int = 4, most: int = 220, key: str = "doc_id") -> DataFrame:
    """(key, occurrence, source, words): sentences of ``least`` to ``most`` words; occurrence counts all raw parts."""
    parts = docs.select(key, F.posexplode(T.sentences(F.col("text"))).alias("occurrence", "raw"))
    units = held(parts, source=T.strip(F.col("raw")))
    return held(units, words=T.word_count(F.col("source"))).filter(F.col("words").between(least, most)).select(key, "occurrence", "source", "words")


def concatenated(segments: DataFrame, key: str = "doc_id", seq: str = "seq", text: str = "text") -> DataFrame:
    """``segments`` with start_char and end_char in their concatenation with one line feed between."""
    before = Window.partitionBy(key).orderBy(seq).rowsBetween(Window.unboundedPreceding, -1)
    start = F.coalesce(F.sum(F.length(text) + 1).over(before), F.lit(0)).cast("long")
    return segments.withColumn("start_char", start).withColumn("end_char", start + F.length(text))


def lines(docs: DataFrame, key: str = "doc_id") -> DataFrame:
    """(key, seq, text) of all lines."""
    return docs.select(key, F.posexplode(F.split(T.newlines(F.col("text")), "\n")).alias("seq", "text"))


#: Texts that are taken from an Arrow batch at once.
TEXTS = 200


def _by_text(docs: DataFrame, key: str, spans: Callable[[str], dict[str, np.ndarray | list]], columns: str) -> DataFrame:
    """(key, columns): the rows that ``spans`` gives for each text. A document's rows are made where its text is, without a shuffle."""
    names = [c.split()[0] for c in columns.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, TEXTS):
                part = batch.slice(i, TEXTS)
                for k, text in enumerate(part.column(1).to_pylist()):
                    if text is not None and len((found := spans(text))[names[0]]):
                        n = len(found[names[0]])
                        keys = pa.repeat(part.column(0)[k], n)
                        yield pa.RecordBatch.from_arrays([keys, *(pa.array(found[c]) for c in names)], names=[key, *names])

    kind = dict(docs.dtypes)[key]
    return docs.select(F.col(key), F.col("text")).mapInArrow(run, f"`{key}` {kind}, {columns}")


@lru_cache(1)
def _wordlike() -> np.ndarray:
    """Whether each code point is a letter, a number or an underscore."""
    return np.array([chr(i).isalnum() or i == 95 for i in range(sys.maxunicode + 1)])


def _runs(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the word runs of a text, in code points."""
    inside = _wordlike()[np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)]
    edges = np.flatnonzero(np.diff(inside, prepend=False, append=False))
    return edges[::2], edges[1::2]


def word_runs(docs: DataFrame, key: str = "doc_id") -> DataFrame:
    """(key, pos, word, start, end): word runs with code point offsets."""

    def spans(text: str) -> dict:
        starts, ends = _runs(text)
        return {"pos": np.arange(len(starts), dtype=np.int32), "word": [text[a:b] for a, b in zip(starts.tolist(), ends.tolist())], "start": starts, "end": ends}

    return _by_text(docs, key, spans, "pos int, word string, start long, end long")


def word_chunks(docs: DataFrame, size: int, key: str = "doc_id") -> DataFrame:
    """(key, chunk, start, end, n_tokens): chunks of ``size`` word runs; a chunk ends as the next begins, the last with its last run."""

    def spans(text: str) -> dict:
        starts, ends = _runs(text)
        first = starts[::size]
        n = len(first)
        return {
            "chunk": np.arange(n, dtype=np.int64), "start": first, "end": np.append(first[1:], ends[-1:]),
            "n_tokens": np.minimum(len(starts) - size * np.arange(n), size),
        }

    return _by_text(docs, key, spans, "chunk long, start long, end long, n_tokens long")


def line_spans(docs: DataFrame, key: str = "doc_id") -> DataFrame:
    """(key, seq, text, start_char, end_char) of all lines, with offsets in the text whose line ends are line feeds."""

    def spans(text: str) -> dict:
        rows = text.replace("\r\n", "\n").replace("\r", "\n").split("\n")
        ends = np.cumsum([len(r) + 1 for r in rows], dtype=np.int64) - 1
        return {"seq": np.arange(len(rows), dtype=np.int32), "text": rows, "start_char": np.append(0, ends[:-1] + 1), "end_char": ends}

    return _by_text(docs, key, spans, "seq int, text string, start_char long, end_char long")


def token_chunks(tokens: DataFrame, size: int, key: str = "doc_id") -> DataFrame:
    """Chunks of ``size`` tokens (key, pos, start, end): (key, chunk, start, end, n_tokens), where a chunk ends as the next begins."""
    chunk = F.expr(f"pos div {size}").alias("chunk")
    groups = tokens.groupBy(key, chunk).agg(F.min("start").alias("start"), F.max("end").alias("last"), F.count("*").alias("n_tokens"))
    following = F.lead("start").over(Window.partitionBy(key).orderBy("chunk"))
    return groups.select(key, "chunk", "start", F.coalesce(following, F.col("last")).alias("end"), "n_tokens")


def closed_by_next(rows: DataFrame, key: str, seq: str, start: str, last: Column) -> DataFrame:
    """``rows`` with ``end``: the start of the next one, at the end ``last``."""
    return rows.withColumn("end", F.coalesce(F.lead(start).over(Window.partitionBy(key).orderBy(seq)), last))


def islands(rows: DataFrame, key: str, seq: str, breaks: Column) -> DataFrame:
    """``rows`` with ``island``: a number that goes up at each row where ``breaks`` holds."""
    return rows.withColumn("island", F.sum(F.when(breaks, 1).otherwise(0)).over(Window.partitionBy(key).orderBy(seq)))


def merged_after(sentences: DataFrame, key: str, seq: str, open_end: Column, text: str = "text") -> DataFrame:
    """Sentences joined to the one before where that one does not end: ``open_end`` is judged on the row before."""
    w = Window.partitionBy(key).orderBy(seq)
    starts = F.coalesce(~F.lag(open_end).over(w), F.lit(True))
    marked = sentences.withColumn("_first", starts)
    parts = islands(marked, key, seq, F.col("_first"))
    joined = parts.groupBy(key, "island").agg(F.array_sort(F.collect_list(F.struct(seq, text))).alias("parts"))
    return joined.select(key, (F.col("island") - 1).alias("seq"), F.array_join(F.transform("parts", lambda p: p[text]), " ").alias("text"))


def blocks(docs: DataFrame, key: str = "doc_id") -> DataFrame:
    """(key, block, lines, n_lines): runs of lines that are not blank, with the blank lines before and after."""
    all_lines = lines(docs, key).withColumn("blank", T.strip(F.col("text")) == "")
    w = Window.partitionBy(key).orderBy("seq")
    first = ~F.col("blank") & F.coalesce(F.lag("blank").over(w), F.lit(True))
    numbered = islands(all_lines.withColumn("_first", first), key, "seq", F.col("_first"))
    full = numbered.filter(~F.col("blank"))
    found = full.groupBy(key, "island").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("seq", "text"))), lambda x: x["text"]).alias("lines"), F.min("seq").alias("first"), F.max("seq").alias("last")
    )
    size = all_lines.groupBy(key).agg((F.max("seq") + 1).alias("n"))
    w = Window.partitionBy(key).orderBy("island")
    return found.join(size, key).select(
        key,
        (F.col("island") - 1).cast("int").alias("block"),
        "lines",
        F.size("lines").alias("n_lines"),
        (F.col("first") - F.coalesce(F.lag("last").over(w) + 1, F.lit(0))).alias("blank_before"),
        (F.coalesce(F.lead("first").over(w), F.col("n")) - F.col("last") - 1).alias("blank_after"),
    )


#: Signs of lists, tables and headings, and abbreviations that do not end a sentence.
LIST_MARK = r"^\s*(?:[-+*•▪◦]|(?:\(?\d{1,3}\)?[.)])|(?:[A-Za-z][.)]))\s+"
TABLEISH = r"(?:\|.*\||[-=+]{8,})"
HEADING_WORD = (
    r"^\s*_?(?:BOOK|Book|PART|Part|CHAPTER|Chapter|SECTION|Section|Appendix|PROPOSITION|Proposition|DEFINITION|Definition"
    r"|AXIOM|Axiom|QUERY|Query|OBSERVATION|Observation|EXPERIMENT|Experiment)\b"
)
HEADING_NUMBER = r"^\s*_?[IVXLCDM]{1,8}[._]?\s*$|^\s*_?\d+(?:\.\d+)*[.)]?_?\s*$"
ABBREVIATIONS = (
    "mr.", "mrs.", "ms.", "dr.", "st.", "fig.", "obs.", "exper.", "prop.", "sect.", "defin.", "qu.", "schol.", "pag.", "min.",
    "degr.", "inch.", "inches.", "chap.", "ch.", "vol.", "no.",
)
CONTEXTUAL = ("etc.", "&c.", "p.m.", "a.m.", "viz.", "ibid.")


def ends_open(text: Column) -> Column:
    """Whether a sentence part ends in an abbreviation or a single initial."""
    low = F.lower(F.rtrim(text))
    hit = text.rlike(r"(?:^|\s)[A-Za-z]\.\s*$")
    for a in ABBREVIATIONS:
        hit = hit | low.endswith(a)
    return hit


def contextual_end(text: Column) -> Column:
    """Whether a part ends in an abbreviation that ends a sentence only before a capital."""
    low = F.lower(F.rtrim(text))
    hit = F.lit(False)
    for a in CONTEXTUAL:
        hit = hit | low.endswith(a)
    return hit


def _mean(xs: Column) -> Column:
    return F.when(F.size(xs) > 0, F.aggregate(xs, F.lit(0.0), lambda a, x: a + x) / F.size(xs)).otherwise(F.lit(0.0))


def _share(xs: Column, test) -> Column:
    return F.when(F.size(xs) > 0, F.size(F.filter(xs, test)) / F.size(xs)).otherwise(F.lit(0.0))


def _stdev(xs: Column) -> Column:
    return let(lambda xs, mean: F.sqrt(_mean(F.transform(xs, lambda x: (x - mean) * (x - mean)))), xs, _mean(xs))


def _median(xs: Column) -> Column:
    def middle(s: Column) -> Column:
        n = F.size(s)
        return F.when(n > 0, (F.get(s, F.floor((n - 1) / 2).cast("int")) + F.get(s, F.floor(n / 2).cast("int"))) / 2.0).otherwise(F.lit(0.0))

    return let(middle, F.array_sort(xs))


def block_features(found: DataFrame) -> DataFrame:
    """``blocks`` with the physical layout's features as a struct ``f``."""
    x = F.col("_x")
    rows = held(found, _x=F.transform("lines", T.strip), _indents=F.transform("lines", lambda s: (F.length(s) - F.length(F.regexp_replace(s, r"^[ \t]+", ""))).cast("double")))
    rows = held(
        rows,
        _lengths=F.transform(x, lambda s: F.length(s).cast("double")),
        _head=F.slice(x, F.lit(1), F.greatest(F.size(x) - 1, F.lit(0))),
        _tail=F.slice(x, F.lit(2), F.greatest(F.size(x) - 1, F.lit(0))),
        _marks=F.aggregate(x, F.lit(0), lambda a, s: a + F.regexp_count(s, F.lit(r"[^\p{L}\p{N}\s]"))),
        _words=F.regexp_extract_all(F.array_join(x, " "), F.lit(T.RUN), F.lit(0)),
    )
    lengths = F.col("_lengths")
    rows = held(rows, _mean=_mean(lengths), _stdev=_stdev(lengths), _total=F.aggregate(lengths, F.lit(0.0), lambda a, v: a + v))
    f = F.struct(
        F.size(x).alias("line_count"),
        _median(lengths).alias("median_len"),
        F.col("_mean").alias("mean_len"),
        F.col("_stdev").alias("stdev_len"),
        F.when(F.col("_mean") > 0, F.col("_stdev") / F.col("_mean")).otherwise(0.0).alias("cv_len"),
        _share(F.col("_head"), lambda s: s.rlike(T.TERMINAL)).alias("terminal_share"),
        _share(F.col("_tail"), lambda s: s.rlike(r"^[\"'_(\[]*[a-z]")).alias("lower_share"),
        (1.0 / (1.0 + _stdev(F.col("_indents")))).alias("indent_stability"),
        _share(x, lambda s: s.rlike(LIST_MARK)).alias("marker_share"),
        F.when(F.col("_total") > 0, F.col("_marks") / F.col("_total")).otherwise(0.0).alias("punctuation_density"),
        _share(x, lambda s: s.rlike(TABLEISH)).alias("tableish_share"),
        F.size(F.filter("_words", lambda w: w.rlike(r"\p{L}"))).alias("alpha_words"),
        F.col("_total").cast("long").alias("chars"),
    )
    return held(rows, f=f).select(*found.columns, "f")


def _unit(c: Column) -> Column:
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), c))


#: Weights of hard-wrap families over (width, regularity, open ends, lower-case starts, indent, few marks).
HARDWRAP = {
    "balanced": (0.27, 0.14, 0.20, 0.20, 0.09, 0.10),
    "continuation": (0.20, 0.10, 0.18, 0.32, 0.08, 0.12),
    "width": (0.36, 0.18, 0.18, 0.12, 0.08, 0.08),
    "punctuation": (0.22, 0.10, 0.30, 0.18, 0.08, 0.12),
}


def block_scores(featured: DataFrame, family: str = "balanced") -> DataFrame:
    """list, stanza, heading and hard-wrap scores of blocks with features."""
    f = F.col("f")
    several = f["line_count"] >= 2
    as_list = _unit(0.70 * f["marker_share"] + 0.10 * F.least(F.lit(1.0), f["line_count"] / 4.0) + F.when(f["median_len"] <= 90, 0.10).otherwise(0.0) + 0.10 * (1.0 - F.least(F.lit(1.0), f["tableish_share"] * 2.0)))
    stanza = _unit(
        0.38 * _unit((78.0 - f["median_len"]) / 45.0)
        + 0.22 * _unit(1.0 - F.least(F.lit(1.0), f["cv_len"] / 0.55))
        + 0.20 * F.least(F.lit(1.0), f["line_count"] / 5.0)
        + 0.12 * f["terminal_share"]
        + 0.08 * (1.0 - f["lower_share"])
    )
    signals = (
        _unit((f["median_len"] - 28.0) / 48.0),
        _unit(1.0 - F.least(F.lit(1.0), f["cv_len"] / 0.65)),
        1.0 - f["terminal_share"],
        f["lower_share"],
        f["indent_stability"],
        _unit(1.0 - F.least(F.lit(1.0), f["punctuation_density"] / 0.18)),
    )
    wrap = sum((w * v for w, v in zip(HARDWRAP[family], signals)), F.lit(0.0))
    columns = featured.columns
    joined = T.strip(F.array_join(F.transform("lines", T.strip), " "))
    # Only single lines can be headings, so no long text is looked at again.
    featured = held(featured, _txt=F.when(f["line_count"] == 1, joined).otherwise(""))
    txt, words = F.col("_txt"), F.col("_heads")
    featured = held(featured, _heads=F.filter(F.regexp_extract_all(txt, F.lit(T.RUN), F.lit(0)), lambda w: w.rlike(r"\p{L}")))
    letters = T.letter_count(txt)
    heading = _unit(
        F.when(txt.rlike(HEADING_WORD), 0.42).otherwise(0.0)
        + F.when(txt.rlike(HEADING_NUMBER), 0.28).otherwise(0.0)
        + F.when((F.length(txt) <= 120) & (F.size(words) <= 12), 0.10).otherwise(0.0)
        + F.when(F.col("blank_before") > 0, 0.06).otherwise(0.0)
        + F.when(F.col("blank_after") > 0, 0.06).otherwise(0.0)
        + 0.12 * F.when(letters > 0, F.length(F.regexp_replace(txt, r"\P{Lu}", "")) / letters).otherwise(0.0)
        + 0.08 * _share(words, lambda w: w.rlike(r"^\p{Lu}"))
        + F.when(txt.rlike(T.TERMINAL), -0.12).otherwise(0.08)
        - F.when((F.size(words) > 16) | (F.length(txt) > 180), 0.35).otherwise(0.0)
    )
    return featured.select(
        *columns,
        F.when(several, as_list).otherwise(0.0).alias("list_score"),
        F.when(several & (f["marker_share"] < 0.4) & (f["tableish_share"] < 0.25), stanza).otherwise(0.0).alias("stanza_score"),
        F.when((f["line_count"] == 1) & (txt != ""), heading).otherwise(0.0).alias("heading_score"),
        F.when(several & (f["marker_share"] < 0.4) & (f["tableish_share"] < 0.35), wrap).otherwise(0.0).alias("hardwrap_score"),
    )


def prepared_units(scored: DataFrame, heading: float = 0.5, listing: float = 0.6, stanza: float = 0.6, wrap: float = 0.55) -> DataFrame:
    """Blocks with ``kind`` (heading, list, stanza, hardwrap, ambiguous) and their text as that kind reads."""
    kind = (
        F.when(F.col("heading_score") >= heading, "heading")
        .when(F.col("list_score") >= listing, "list")
        .when(F.col("stanza_score") >= stanza, "stanza")
        .when(F.col("hardwrap_score") >= wrap, "hardwrap")
        .otherwise("ambiguous")
    )
    plain = F.array_join(F.transform("lines", T.strip), "\n")
    return scored.withColumn("kind", kind).withColumn("text", F.when(F.col("kind").isin("hardwrap", "heading"), T.wrap_join(F.col("lines"))).otherwise(plain))


def dividers(docs: DataFrame, key: str = "doc_id") -> DataFrame:
    """(key, seq, kind, text): lines of stars or rules as dividers, all between them as prose."""
    divider = F.col("text").rlike(r"^\s*(?:\*(?:\s+\*)+|[-=_*]{3,})\s*$")
    marked = lines(docs, key).withColumn("divider", divider)
    w = Window.partitionBy(key).orderBy("seq")
    change = F.coalesce((F.lag("divider").over(w) != F.col("divider")) | F.col("divider"), F.lit(True))
    parts = islands(marked.withColumn("_c", change), key, "seq", F.col("_c"))
    out = parts.groupBy(key, "island", "divider").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("seq", "text"))), lambda x: x["text"]), "\n").alias("text"))
    return out.filter("divider or trim(text) <> ''").select(key, (F.col("island") - 1).alias("seq"), F.when(F.col("divider"), "divider").otherwise("prose").alias("kind"), "text")


def packed_units(parts: Column, preferred: int, ratio: float = 0.6, mode: str = "ratio_next", hard: int = HARD_LIMIT) -> Column:
    """Greedy packing of array<struct<text, tokens, paragraph>> into units of at most ``preferred`` tokens.

    A unit also closes at a paragraph's end: always (``strict``), once it is
    filled to ``ratio`` (``ratio``), or also if the next part would overfill it
    (``ratio_next``). Returns array<struct<text, tokens, first, last>>. Where
    units begin is one pass over two arrays of numbers; the texts stay where
    they are.
    """
    limit = min(preferred, hard)

    def begins(tokens: pd.Series, paragraphs: pd.Series) -> pd.Series:
        out = []
        for counts, places in zip(tokens, paragraphs):
            cuts, held, last = [], 0, None
            for i, (n, at) in enumerate(zip(counts, places)):
                full = held >= preferred * ratio
                closes = at != last and {"strict": True, "ratio": full, "ratio_next": full or held + n > preferred}[mode]
                if i == 0 or held + n > limit or closes:
                    cuts.append(i)
                    held = 0
                held, last = held + int(n), at
            out.append(cuts)
        return pd.Series(out)

    starts = F.pandas_udf(begins, "array<int>")(F.transform(parts, lambda p: p["tokens"].cast("long")), F.transform(parts, lambda p: p["paragraph"].cast("long")))

    def unit(own: Column) -> Column:
        return F.struct(
            F.array_join(F.transform(own, lambda p: p["text"]), " ").alias("text"),
            F.aggregate(own, F.lit(0).cast("long"), lambda n, p: n + p["tokens"]).alias("tokens"),
            F.element_at(own, 1)["paragraph"].cast("long").alias("first"),
            F.element_at(own, -1)["paragraph"].cast("long").alias("last"),
        )

    def units(parts: Column, at: Column) -> Column:
        return F.transform(at, lambda a, i: let(unit, F.slice(parts, a + 1, F.coalesce(F.get(at, i + 1), F.size(parts)) - a)))

    return let(units, parts, starts)


def numeric_islands(docs: DataFrame, key: str = "doc_id") -> DataFrame:
    """(key, island, first, last, n): integer runs whose gaps hold no letters but "and", "or", "to"."""
    runs = word_runs(docs, key).withColumn("number", F.col("word").rlike("^[0-9]+$"))
    kept = runs.filter(~F.lower("word").isin("and", "or", "to"))
    w = Window.partitionBy(key).orderBy("pos")
    first = F.col("number") & ~F.coalesce(F.lag("number").over(w), F.lit(False))
    numbered = islands(kept.withColumn("_f", first), key, "pos", F.col("_f")).filter("number")
    return numbered.groupBy(key, "island").agg(F.min("start").alias("first"), F.max("end").alias("last"), F.count("*").alias("n"))
