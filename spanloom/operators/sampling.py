"""Deterministic sampling: hash order, word budgets, quotas, spreads, position buckets, shards."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spanloom.scratch import kept


def stable_rank(salt: Column | str, occurrence: Column, text: Column) -> Column:
    """sha256 of salt, occurrence and text with NUL between: an order that no row's neighbours change."""
    salt = F.lit(salt) if isinstance(salt, str) else salt
    return F.sha2(F.concat(salt, F.char(F.lit(0)), occurrence.cast("string"), F.char(F.lit(0)), text).cast("binary"), 256)


def budget_take(rows: DataFrame, group: str, order: list[str], weight: str, budget: Column) -> DataFrame:
    """Of each group the first rows whose weights before them are below the budget.

    Ranks are exact running sums. A hot group is cut in advance: rows are
    pre-summed by hash prefix, and only prefixes that the budget can reach stay.
    """
    prefix = F.substring(order[0], 1, 3)
    sums = rows.groupBy(group, prefix.alias("_p")).agg(F.sum(weight).alias("_w"))
    before = F.coalesce(F.sum("_w").over(Window.partitionBy(group).orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    sums = sums.withColumn("_before", before).select(group, "_p", "_before")  # at most 4,096 rows a group
    near = rows.withColumn("_p", prefix).join(sums, [group, "_p"]).filter(F.col("_before") < budget)
    inside = F.coalesce(F.sum(weight).over(Window.partitionBy(group, "_p").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return near.withColumn("_inside", inside).filter(F.col("_before") + F.col("_inside") < budget).drop("_p", "_before", "_inside")


def quota_column(quotas: Mapping[str, int], group: str = "category") -> Column:
    return F.coalesce(*[F.when(F.col(group) == k, F.lit(v)) for k, v in quotas.items()], F.lit(0))


def quota_selection(units: DataFrame, quotas: Mapping[str, int], target: int, salt: str = "selection") -> DataFrame:
    """Units (key columns, category, source, words) by category quota in hash order, then filled up to ``target`` words.

    ``units`` has ``uid``, a unique text for the hash. Returns (uid, category,
    words, reason), the reason quota or fill. Units are read once: the texts end
    in two hashes, and budgets are taken from the narrow table of these.
    """
    by_category = stable_rank(F.concat(F.lit(f"{salt}-"), F.col("category")), F.col("uid"), F.col("source"))
    ranks = kept(units.select("uid", "category", "words", by_category.alias("_rank"), stable_rank(f"{salt}-fill", F.col("uid"), F.col("source")).alias("_fill")), "ranks")
    chosen = kept(budget_take(ranks, "category", ["_rank"], "words", quota_column(quotas)).select("uid", "category", "words"), "chosen")
    held = chosen.agg(F.coalesce(F.sum("words"), F.lit(0))).first()[0]
    # Each chosen unit has a word at least, so there are no more than the quotas' words.
    rest = ranks.join(F.broadcast(chosen.select("uid")), "uid", "left_anti").withColumn("_all", F.lit(0))
    fill = budget_take(rest, "_all", ["_fill"], "words", F.lit(target - held)).select("uid", "category", "words")
    return chosen.withColumn("reason", F.lit("quota")).unionByName(fill.withColumn("reason", F.lit("fill")))


def positions(rows: DataFrame, group: str, order: list[str]) -> DataFrame:
    """``rows`` with ``i`` (from 0) and ``n`` in their group; a task sorts a group, so groups are such as fit in one."""
    w = Window.partitionBy(group).orderBy(*order)
    return rows.withColumn("i", F.row_number().over(w) - 1).withColumn("n", F.count("*").over(Window.partitionBy(group)))


def range_positions(rows: DataFrame, group: str, order: list[str]) -> DataFrame:
    """``positions`` for groups of any size: rows are dealt and numbered by ranges of (group, order), and written once.

    The counts by range, a row for each range and group in it, give every range its first number.
    """
    ranged = kept(rows.repartitionByRange(group, *order).withColumn("_part", F.spark_partition_id()), "ranged")
    counts = ranged.groupBy(group, "_part").agg(F.count("*").alias("_n"))
    w = Window.partitionBy(group)
    before = F.coalesce(F.sum("_n").over(w.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = counts.select(group, "_part", before.alias("_start"), F.sum("_n").over(w).alias("n"))
    place = F.row_number().over(Window.partitionBy(group, "_part").orderBy(*order)) - 1
    out = ranged.withColumn("i", place).join(starts, [group, "_part"])
    return out.select(*rows.columns, (F.col("i") + F.col("_start")).alias("i"), "n")


def bucket_centres(placed: DataFrame, buckets: int = 8) -> DataFrame:
    """Rows in the middle of each of min(buckets, n) equal stretches, with ``bucket``."""
    k = F.least(F.lit(buckets), F.col("n"))
    out = placed.withColumn("bucket", F.explode(F.sequence(F.lit(0), k - 1)))
    start, end = F.expr(f"bucket * n div least({buckets}, n)"), F.expr(f"(bucket + 1) * n div least({buckets}, n)")
    return out.filter((end > start) & (F.col("i") == start + F.floor((end - start - 1) / 2)))


def spread(placed: DataFrame, count: int) -> DataFrame:
    """``count`` rows of each group, evenly spread (all, if there are no more)."""
    k = F.least(F.lit(count), F.col("n"))
    hit = F.exists(F.sequence(F.lit(0), F.lit(count - 1)), lambda j: (j < k) & (F.floor((j + 0.5) * F.col("n") / k) == F.col("i")))
    return placed.filter(hit)


def midpoint_order(n: int) -> list[int]:
    """Positions 0..n-1, breadth first by halves: the order of a fill that stays spread at every length."""
    out, todo = [], [(0, n)]
    while todo:
        after = []
        for a, b in todo:
            if b > a:
                m = a + (b - a - 1) // 2
                out.append(m)
                after += [(a, m), (m + 1, b)]
        todo = after
    return out


def midpoint_rank(placed: DataFrame) -> DataFrame:
    """``placed`` with ``depth``: the level at which halving reaches the row; (depth, i) is the breadth-first order.

    Each row walks down the halves of its group on its own, about log2(n)
    steps, so no order is collected anywhere.
    """
    start = F.struct(F.lit(0).cast("long").alias("a"), F.col("n").cast("long").alias("b"), F.lit(-1).alias("depth"))

    def step(s: Column, level: Column) -> Column:
        m = s["a"] + F.floor((s["b"] - s["a"] - 1) / 2)
        i = F.col("i")
        return F.when(s["depth"] >= 0, s).otherwise(
            F.struct(
                F.when(i > m, m + 1).otherwise(s["a"]).alias("a"),
                F.when(i < m, m).otherwise(s["b"]).alias("b"),
                F.when(i == m, level).otherwise(F.lit(-1)).alias("depth"),
            )
        )

    return placed.withColumn("depth", F.aggregate(F.sequence(F.lit(0), F.lit(62)), start, step)["depth"])


def window_sample(placed: DataFrame, fractions: tuple[float, ...] = (0.1, 0.3, 0.5, 0.7, 0.9), radius: int = 12, limit: int = 120) -> DataFrame:
    """Rows near fixed fractions of the sequence; windows that overlap keep their rows twice, the first ``limit`` stay."""
    out = placed.withColumn("window", F.explode(F.array(*[F.lit(f) for f in fractions])))
    centre = F.floor(F.col("n") * F.col("window"))
    out = out.filter((F.col("i") >= F.greatest(F.lit(0), centre - radius)) & (F.col("i") < F.least(F.col("n"), centre + radius + 1)))
    return out.orderBy("window", "i").limit(limit)


def shards(rows: DataFrame, order: list[str], n: int, group: str | None = None) -> DataFrame:
    """``rows`` with ``shard``: position modulo n, in their group (without one: over all)."""
    placed = range_positions(rows if group else rows.withColumn("_all", F.lit(0)), group or "_all", order)
    return placed.withColumn("shard", F.pmod("i", F.lit(n))).drop("i", "n", "_all")


def top_disjoint(scores: DataFrame, n: int, blocked: DataFrame, key: str = "i", score: str = "score") -> DataFrame:
    """The ``n`` rows of highest score (ties: least key) among those whose key is not in ``blocked``."""
    return scores.join(blocked.select(key).distinct(), key, "left_anti").orderBy(F.desc(score), key).limit(n)


def combined_shards(parts: list[DataFrame], expected: DataFrame, key: str) -> DataFrame:
    """One row: rows, distinct keys, missing and unexpected keys of a union of shards, and whether it is disjoint and complete."""
    both = parts[0]
    for p in parts[1:]:
        both = both.unionByName(p)
    seen = both.groupBy(key).agg(F.count("*").alias("times"))
    want = expected.select(key).distinct().withColumn("wanted", F.lit(True))
    joined = seen.join(want, key, "full_outer")
    out = joined.agg(
        F.coalesce(F.sum("times"), F.lit(0)).alias("rows"),
        F.count("times").alias("distinct_keys"),
        F.count_if(F.col("times").isNull()).alias("missing"),
        F.count_if(F.col("wanted").isNull()).alias("unexpected"),
    )
    return out.withColumn("complete", F.expr("rows = distinct_keys and missing = 0 and unexpected = 0"))
