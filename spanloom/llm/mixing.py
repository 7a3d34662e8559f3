"""Mixing sources to target weights by iterative proportional fitting. DataFrame and SQL functions only."""

from __future__ import annotations

import warnings
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import Scratch

WORD = r"[^\x20\x09-\x0D]+"
NONE = "(none)"
#: Cells (combinations of the margins' values) up to which they are raked in one task and sent to all tasks.
FEW_CELLS = 20_000
DIMS = ("source", "lang", "topic")


def topic_of(text: Column) -> Column:
    """A topic from the form of the text: licence notes, tables, lists, figures or prose; ``none`` without text."""
    return (
        F.when(F.coalesce(F.length(text), F.lit(0)) == 0, "none")
        .when(F.contains(text, F.lit("icense")) | F.contains(text, F.lit("ights reserved")), "licence")
        .when(F.contains(text, F.lit(" | ")), "table")
        .when(F.contains(text, F.lit("\n- ")) | F.contains(text, F.lit("\n* ")), "list")
        .when(F.contains(text, F.lit("%%%")) | F.contains(text, F.lit("###")), "noisy")
        .otherwise("prose")
    )


def _off() -> Column:
    """The largest relative error of a cell's margins; a margin with target 0 counts as met."""
    return F.greatest(*[F.when(F.col(f"target_{d}") > 0, F.abs(F.sum("weight").over(Window.partitionBy(d)) / F.col(f"target_{d}") - 1)).otherwise(0.0) for d in DIMS])


def rake(cells: DataFrame, scratch: Scratch, few: bool, tolerance: float = 1e-6, sweeps: int = 4, progress: float = 0.99) -> tuple[DataFrame, float]:
    """Iterative proportional fitting of ``weight`` to the shares ``target_<dim>``; the cells and the largest relative error left.

    A sweep scales the weights to each margin in turn; rounds of ``sweeps`` go
    on until no margin is off by more than ``tolerance``. Margins that no
    weights over these cells can meet make the error stand still: a round that
    leaves more than ``progress`` of it is the last. Cells without weight stay
    without.
    """
    k, last = 0, None
    while True:
        if few:
            cells = cells.coalesce(1)
        for _ in range(sweeps):
            for d in DIMS:
                held = F.sum("weight").over(Window.partitionBy(d))
                cells = cells.withColumn("weight", F.when(held > 0, F.col("weight") * F.col(f"target_{d}") / held).otherwise(0.0))
        cells = scratch.table(cells.withColumn("off", _off()), f"raked{k}")
        off = cells.filter("tokens > 0").agg(F.max("off")).first()[0] or 0.0
        cells = cells.drop("off")
        if off <= tolerance or (last is not None and off > progress * last):
            return cells, float(off)
        k, last = k + 1, off


def saturated_scale(cells: DataFrame, budget: float) -> float:
    """The s for which sum(tokens * min(1, s * ratio)) is ``budget`` of all tokens.

    The sum is concave in s and made of straight parts, so Newton's steps from
    below end at the solution; each is one aggregate over the cells. A budget
    that all cells together cannot fill takes every cell whole.
    """
    live = cells.filter("ratio > 0")
    total, mass, most = (x or 0.0 for x in (*cells.agg(F.sum("tokens")).first(), *live.agg(F.sum(F.col("tokens") * F.col("ratio")), F.sum("tokens")).first()))
    if not mass:
        return 0.0
    wanted = budget * total
    if wanted >= most:
        return 1 / live.agg(F.min("ratio")).first()[0]
    s = wanted / mass
    while True:
        full = F.col("ratio") * F.lit(s) >= 1
        kept, rest = live.agg(F.sum(F.when(full, F.col("tokens")).otherwise(0)), F.sum(F.when(full, 0.0).otherwise(F.col("tokens") * F.col("ratio")))).first()
        after = (wanted - kept) / rest if rest else s
        if after <= s * (1 + 1e-12):
            return float(s)
        s = after


def _target(margin: DataFrame, d: str, given: Mapping[str, float] | None, total: float, smoothing: float) -> DataFrame:
    """(d, target_<d>): the shares that the values of a margin shall have."""
    if given is None:
        margin = margin.withColumn("t", F.pow(F.col("m") / F.lit(total or 1), F.lit(smoothing)))
    else:
        if any(v < 0 for v in given.values()):
            raise ValueError(f"a target share of {d} is negative")
        cases = [F.when(F.col(d) == k, F.lit(float(v))) for k, v in given.items()]
        margin = margin.withColumn("t", F.coalesce(*cases, F.lit(0.0)) if cases else F.lit(0.0))
    sums = margin.agg(F.sum("t").alias("all"))  # one row
    return margin.join(F.broadcast(sums)).select(d, F.when(F.col("all") > 0, F.col("t") / F.col("all")).otherwise(0.0).alias(f"target_{d}"))


def mix(
    docs: DataFrame,
    targets: Mapping[str, Mapping[str, float]] | None = None,
    smoothing: float = 0.5,
    budget: float = 0.7,
    seed: int = 7,
    name: str = "mix",
    topic: Column | None = None,
) -> DataFrame:
    """``docs`` with a struct column ``name``: (topic, tokens, weight, probability, kept, off).

    Token weights by (source, lang, topic) are raked to target shares of each
    margin: those given in ``targets`` (categories left out get share 0), else
    the observed shares to the power ``smoothing``, which lifts the rare ones.
    ``topic`` is any column expression, such as a classifier's label; by default
    ``topic_of`` tells it from the text's form. A document of a cell is kept
    with probability min(1, s * raked / observed share); s makes the expected
    tokens ``budget`` of all, or takes every cell with weight whole if these hold
    less. The draw is a hash of id and text, so it repeats exactly and copies of
    a row share one fate.

    Shares of categories that the corpus lacks go to the others in proportion;
    if it has none of a margin's target categories, nothing is kept. Margins can
    contradict each other over the cells that exist: then the weights are the
    last ones of the fitting, a warning is given, and ``off``, the largest
    relative error of a margin (the same in all rows), says by how much.

    Null source, lang or topic is a category of its own; documents without
    words have no token weight, weight 0, and are not kept. An empty table
    gives no rows. An input column called ``name`` is replaced; others may have
    any names.
    """
    scratch = Scratch(docs.sparkSession)
    docs = docs.drop(name)
    text = F.col("text").cast("string")
    cell = F.struct(
        F.coalesce(F.col("source").cast("string"), F.lit(NONE)).alias("source"),
        F.coalesce(F.col("lang").cast("string"), F.lit(NONE)).alias("lang"),
        F.coalesce((topic_of(text) if topic is None else topic).cast("string"), F.lit(NONE)).alias("topic"),
        F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long").alias("tokens"),
    )
    cells = docs.select(cell.alias("c")).select("c.*").filter("tokens > 0").groupBy(*DIMS).agg(F.sum("tokens").alias("tokens"))
    cells = scratch.table(cells, "cells")
    n_cells = cells.count()
    few = n_cells <= FEW_CELLS
    total = float(cells.agg(F.sum("tokens")).first()[0] or 0)
    # Margins of the bare cells: of cells that are joined with margins, each would hold the plans of those before it twice.
    margins = [_target(cells.groupBy(d).agg(F.sum("tokens").alias("m")), d, (targets or {}).get(d), total, smoothing) for d in DIMS]
    for d, margin in zip(DIMS, margins):
        cells = cells.join(F.broadcast(margin) if few else margin, d)
    cells = cells.withColumn("weight", F.col("tokens") / F.lit(total or 1.0))
    raked, off = rake(scratch.table(cells, "start"), scratch, few)
    if off > 1e-6:
        warnings.warn(f"the margins cannot all be met over these cells: one is off by {off:.2g} of its share", stacklevel=2)
    rated = scratch.table(raked.withColumn("ratio", F.col("weight") * F.lit(total or 1.0) / F.col("tokens")), "rated")
    s = saturated_scale(rated, budget)
    odds = rated.select(*[F.col(d).alias(f"_odds_{d}") for d in DIMS], F.col("ratio").alias("_odds_ratio"))
    marked = docs.withColumn(name, cell)
    key = [marked[name][d] == odds[f"_odds_{d}"] for d in DIMS]
    joined = marked.join(F.broadcast(odds) if few else odds, key[0] & key[1] & key[2], "left")
    own, ratio = marked[name], odds["_odds_ratio"]
    weight = F.when(own["tokens"] > 0, F.coalesce(ratio, F.lit(0.0))).otherwise(0.0)
    draw = F.shiftrightunsigned(F.xxhash64(marked["doc_id"], F.crc32(F.coalesce(marked["text"].cast("string"), F.lit("")).cast("binary")), F.lit(seed)), 11) / F.lit(float(2**53))
    p = F.least(F.lit(1.0), weight * F.lit(s))
    out = F.struct(
        own["topic"].alias("topic"),
        own["tokens"].alias("tokens"),
        weight.alias("weight"),
        p.alias("probability"),
        (draw < p).alias("kept"),
        F.lit(off).alias("off"),
    )
    return joined.select(*[marked[c] for c in docs.columns], out.alias(name))


def mix_digest(docs: DataFrame) -> DataFrame:
    """One row per document: its cell, weight, probability and whether it is kept."""
    out = mix(docs)
    return out.select("doc_id", "source", "lang", "mix.*")
