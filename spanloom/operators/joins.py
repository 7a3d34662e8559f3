"""Joins: interval containment, parity, manifests, semi and anti lookups, latest rows, glob rules, conflicts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Characters of a document that one bucket of an interval join covers.
BUCKET = 2_048


def contained(inner: DataFrame, outer: DataFrame, key: str = "doc_id", bucket: int = BUCKET, how: str = "inner") -> DataFrame:
    """Rows of ``inner`` (key, start, end) with each row of ``outer`` (key, seg, seg_start, seg_end) that holds them.

    Spans are half-open. An outer span is listed in every bucket it meets and
    an inner one in the bucket of its start, so the join is an equi-join on
    (key, bucket) and stays so for very long documents.
    """
    cover = F.sequence(F.expr(f"seg_start div {bucket}"), F.expr(f"greatest(seg_end - 1, seg_start) div {bucket}"))
    spread = outer.withColumn("_b", F.explode(cover)).withColumnRenamed(key, "_key")
    placed = inner.withColumn("_at", F.expr(f"start div {bucket}"))
    on = (F.col(key) == F.col("_key")) & (F.col("_at") == F.col("_b")) & (F.col("seg_start") <= F.col("start")) & (F.col("seg_end") >= F.col("end"))
    return placed.join(spread, on, how).drop("_b", "_at", "_key")


def exactly_one(inner: DataFrame, outer: DataFrame, key: str, ids: list[str], **options) -> tuple[DataFrame, DataFrame]:
    """(covered, uncovered): rows held by exactly one span, and the others with ``matches``."""
    held = contained(inner, outer, key, **options)
    counts = held.groupBy(*ids).agg(F.count("*").alias("matches"))
    covered = held.join(counts.filter("matches = 1").drop("matches"), ids, "left_semi")
    rest = inner.join(counts, ids, "left").withColumn("matches", F.coalesce("matches", F.lit(0))).filter("matches <> 1")
    return covered, rest


def parity(left: DataFrame, right: DataFrame, key: str = "path", value: str = "sha256") -> DataFrame:
    """(key, state): left_only, right_only, mismatch or equal, over both sides' keys."""
    a, b = left.select(key, F.col(value).alias("_a"), F.lit(True).alias("_l")), right.select(key, F.col(value).alias("_b"), F.lit(True).alias("_r"))
    state = F.when(F.col("_r").isNull(), "left_only").when(F.col("_l").isNull(), "right_only").when(F.col("_a").eqNullSafe(F.col("_b")), "equal").otherwise("mismatch")
    return a.join(b, key, "full_outer").select(key, state.alias("state"))


def manifest_check(manifest: DataFrame, members: DataFrame, key: str = "path") -> DataFrame:
    """(key, problem): missing, unrecorded, duplicate, size or hash that differs, of members (key, bytes, sha256)."""
    seen = members.groupBy(key).agg(F.count("*").alias("n"), F.min("bytes").alias("bytes"), F.min("sha256").alias("sha256"))
    want = manifest.select(key, F.col("bytes").alias("_bytes"), F.col("sha256").alias("_sha"), F.lit(True).alias("_m"))
    problem = (
        F.when(F.col("n").isNull(), "missing")
        .when(F.col("_m").isNull(), "unrecorded")
        .when(F.col("n") > 1, "duplicate")
        .when(F.col("bytes") != F.col("_bytes"), "size_mismatch")
        .when(F.col("sha256") != F.col("_sha"), "hash_mismatch")
    )
    return seen.join(want, key, "full_outer").select(key, problem.alias("problem")).filter("problem is not null")


def overlay_plan(expected: DataFrame, candidate: DataFrame, target: DataFrame, key: str = "path", value: str = "sha256") -> DataFrame:
    """(key, action): unavailable, add, same or replace for every expected member."""
    c, t = candidate.select(key, F.col(value).alias("_c")), target.select(key, F.col(value).alias("_t"))
    action = F.when(F.col("_c").isNull(), "unavailable").when(F.col("_t").isNull(), "add").when(F.col("_c") == F.col("_t"), "same").otherwise("replace")
    return expected.select(key).join(c, key, "left").join(t, key, "left").select(key, action.alias("action"))


def glob_regex(pattern: Column) -> Column:
    """A glob (``*`` and ``?``) as an anchored regular expression."""
    escaped = F.regexp_replace(pattern, r"([\\.+^$|(){}\[\]])", r"\\$1")
    return F.concat(F.lit("^"), F.replace(F.replace(escaped, F.lit("*"), F.lit(".*")), F.lit("?"), F.lit(".")), F.lit("$"))


def glob_join(names: DataFrame, catalogue: DataFrame, name: str = "name", pattern: str = "pattern") -> DataFrame:
    """Names with every catalogue pattern that fits. The catalogue is a small table of rules: at most 10,000 are sent to the tasks."""
    rules = catalogue.limit(10_001).collect()
    if len(rules) > 10_000:
        raise ValueError("a glob catalogue holds at most 10,000 patterns")
    small = F.broadcast(catalogue.withColumn("_re", glob_regex(F.col(pattern))))
    return names.join(small, F.rlike(F.col(name), F.col("_re"))).drop("_re")


def catalogue_verdicts(files: DataFrame, catalogue: DataFrame) -> DataFrame:
    """Files (name, bytes, sha256) with each catalogue row (pattern, bytes, sha256) whose glob fits, and ``verdict``: exact, size, hash or name_only.

    A catalogue value that is null is not compared; without any the name alone fits.
    """
    rules = catalogue.select("pattern", F.col("bytes").alias("_bytes"), F.col("sha256").alias("_sha"))
    found = glob_join(files, rules)
    verdict = (
        F.when(F.col("_bytes") != F.col("bytes"), "size").when(F.col("_sha") != F.col("sha256"), "hash").when(F.col("_bytes").isNull() & F.col("_sha").isNull(), "name_only").otherwise("exact")
    )
    return found.withColumn("verdict", verdict).drop("_bytes", "_sha")


def ordered_coverage(actual: DataFrame, expected: DataFrame, position: str, value: str) -> DataFrame:
    """Positions at which two sequences differ; empty: exact ordered coverage."""
    a, b = actual.select(position, F.col(value).alias("actual")), expected.select(position, F.col(value).alias("expected"))
    return a.join(b, position, "full_outer").filter(~F.col("actual").eqNullSafe(F.col("expected")))


def resolved(values: DataFrame, name: str = "name", value: str = "value") -> DataFrame:
    """(name, value) of names on whose value all sources agree."""
    return values.groupBy(name).agg(F.min(value).alias(value), F.max(value).alias("_max")).filter(F.col(value) == F.col("_max")).drop("_max")


def latest(rows: DataFrame, key: str, order: str) -> DataFrame:
    """The row of each key that is last by ``order``, without a window over the key."""
    rest = [c for c in rows.columns if c != key]
    best = rows.groupBy(key).agg(F.max(F.struct(order, *[c for c in rest if c != order])).alias("_r"))
    return best.select(key, *[F.col(f"_r.{c}").alias(c) for c in rest])


def get_or_create(rows: DataFrame, existing: DataFrame, keys: list[str], surface: str, order: str, id_name: str = "id") -> DataFrame:
    """``existing`` (id, keys, display) with new keys added: ids follow the key order after the largest one.

    New ids come from counts by key range, so no window runs over all keys.
    """
    new = rows.groupBy(*keys).agg(F.min_by(surface, order).alias("display")).join(existing.select(*keys), keys, "left_anti")
    top = existing.agg(F.coalesce(F.max(id_name), F.lit(0))).first()[0]
    part = F.pmod(F.xxhash64(*keys), F.lit(256)).alias("_part")
    parted = new.withColumn("_part", part)
    counts = parted.groupBy("_part").agg(F.count("*").alias("_n"))  # 256 rows
    offset = F.coalesce(F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = counts.select("_part", offset.alias("_offset"))
    numbered = parted.join(F.broadcast(offsets), "_part").withColumn(id_name, F.lit(top) + F.col("_offset") + F.row_number().over(Window.partitionBy("_part").orderBy(*keys)))
    return existing.select(id_name, *keys, "display").unionByName(numbered.select(id_name, *keys, "display"))


def lineage(runs: DataFrame, start: int, run: str = "run_id", parent: str = "parent_id", most: int = 90) -> list[int]:
    """Run ids from ``start`` up to its first ancestor, by one recursive query; a lost parent, a cycle or more than ``most`` steps raise an error."""
    query = f"""
        WITH RECURSIVE edges AS (SELECT `{run}` AS run, `{parent}` AS parent FROM {{runs}}), up AS (
          SELECT run, parent, 0 AS step FROM edges WHERE run = {int(start)}
          UNION ALL
          SELECT e.run, e.parent, up.step + 1 FROM edges e JOIN up ON e.run = up.parent WHERE up.step < {int(most)}
        ) SELECT run, parent, step FROM up ORDER BY step"""
    rows = runs.sparkSession.sql(query, runs=runs).collect()
    ids = [r["run"] for r in rows]
    if not rows or rows[-1]["parent"] is not None or len(set(ids)) < len(ids):
        raise ValueError(f"broken lineage at {rows[-1]['parent'] if rows else start}")
    return ids


def version_key(version: Column) -> Column:
    """Major, minor and patch of a version as a struct that sorts; anything else sorts before all versions."""
    found = F.regexp_extract_all(version, F.lit(r"^\s*v?(\d+)\.(\d+)\.(\d+)"), F.lit(0))
    parts = F.split(F.regexp_replace(F.element_at(found, 1), r"^\s*v?", ""), r"\.")
    known = F.size(found) > 0
    return F.struct(*[F.when(known, F.get(parts, F.lit(i)).cast("int")).otherwise(-1).alias(n) for i, n in enumerate(("major", "minor", "patch"))])


#: How far a candidate's report got, the best last.
REPORT_STATES = ("incomplete_candidate", "base_candidate_requires_compatibility_proof", "exact_version_structural_candidate")


def by_priority(candidates: DataFrame) -> DataFrame:
    """Archive candidates with ``place`` from 1: identity, report state, catalogue name, structure, runtime, targets, version, path, each falling.

    Candidates have identity_match, catalog_match, structural_complete,
    runtime_ok (booleans), status, targets (int), version and path. A selection
    list: it is ranked in one task.
    """
    state = F.coalesce(F.array_position(F.array(*[F.lit(s) for s in REPORT_STATES]), F.col("status")), F.lit(0))
    flag = lambda c: F.coalesce(F.col(c), F.lit(False)).cast("int")
    order = [flag("identity_match"), state, flag("catalog_match"), flag("structural_complete"), flag("runtime_ok"), F.coalesce("targets", F.lit(0)), version_key(F.col("version")), F.lower("path")]
    return candidates.withColumn("place", F.row_number().over(Window.orderBy(*[c.desc() for c in order])))


def fragment_occurrences(occurrences: DataFrame, fragments: DataFrame, kinds: tuple[str, ...], results: tuple[str, ...] = ("completed",)) -> DataFrame:
    """Occurrences (fragment_id, occurrence_id, ..) with their fragment's text, of the kinds and stage results asked for, in order."""
    own = fragments.filter(F.col("kind").isin(*kinds) & F.col("result").isin(*results))
    return occurrences.join(own, "fragment_id").orderBy("occurrence_id")
