"""Segments, sampling and joins against plain versions."""

import random

import pytest
from pyspark.sql import functions as F

from spanloom import catalogue
from spanloom.operators import joins, sampling, segments


def test_word_runs_tile_the_text(spark):
    texts = [(1, "Hello, wörld! 42"), (2, "  lead"), (3, ""), (4, "😀 x_1")]
    df = spark.createDataFrame(texts, "doc_id long, text string")
    for r in segments.word_runs(df).collect():
        assert dict(texts)[r.doc_id][r.start : r.end] == r.word
    assert segments.word_runs(df).filter("doc_id = 4").first().start == 2


def test_chunks_and_containment(spark):
    r = random.Random(1)
    tokens, spans = [], []
    for d in range(4):
        at = 0
        for k in range(300):
            n = r.randint(1, 9)
            tokens.append((d, k, at, at + n))
            at += n + 1
        cuts = sorted(r.sample(range(at), 12))
        spans += [(d, i, a, b) for i, (a, b) in enumerate(zip([0, *cuts], [*cuts, at]))]
    t = spark.createDataFrame(tokens, "doc_id long, pos int, start long, end long")
    s = spark.createDataFrame(spans, "doc_id long, seg int, seg_start long, seg_end long")
    want = {(d, k, i) for d, k, a, b in tokens for e, i, x, y in spans if d == e and x <= a and y >= b}
    for bucket in (7, 64, 100_000):
        assert {(x.doc_id, x.pos, x.seg) for x in joins.contained(t, s, bucket=bucket).collect()} == want
    held, rest = joins.exactly_one(t, s, "doc_id", ["doc_id", "pos"])
    one = {(d, k) for d, k, _ in want}
    assert {(x.doc_id, x.pos) for x in held.collect()} == one
    assert {(x.doc_id, x.pos) for x in rest.collect()} == {(d, k) for d, k, _, _ in tokens} - one
    chunks = segments.token_chunks(t, 64).filter("doc_id = 0").orderBy("chunk").collect()
    assert [c.n_tokens for c in chunks] == [64] * 4 + [44] and all(a.end == b.start for a, b in zip(chunks, chunks[1:]))


@pytest.mark.parametrize("mode", ["strict", "ratio", "ratio_next"])
def test_packing(spark, mode):
    r = random.Random(2)
    parts = [(f"s{i}", r.randint(1, 50), i // 4) for i in range(60)]
    preferred, ratio, hard = 64, 0.6, 96
    units = []
    for t, n, p in parts:
        if units:
            cur = units[-1]
            edge, full = cur[3] != p, cur[1] >= preferred * ratio
            close = {"strict": edge, "ratio": edge and full, "ratio_next": edge and (full or cur[1] + n > preferred)}[mode]
            if not (cur[1] + n > preferred or cur[1] + n > hard or close):
                cur[0], cur[1], cur[3] = f"{cur[0]} {t}", cur[1] + n, p
                continue
        units.append([t, n, p, p])
    df = spark.createDataFrame([(parts,)], "p array<struct<text:string,tokens:bigint,paragraph:bigint>>")
    got = df.select(segments.packed_units(F.col("p"), preferred, ratio, mode, hard).alias("u")).first().u
    assert [list(u) for u in got] == units


def test_blocks_and_kinds(spark):
    text = "\nCHAPTER I\n\n- one\n- two\n- three\n- four\n\nThis is a line of wrapped prose that goes\non to the next line without any stop and\nthen goes on again until it ends\nhere.\n\n"
    df = spark.createDataFrame([(1, text)], "doc_id long, text string")
    b = segments.blocks(df).orderBy("block").collect()
    assert [(x.n_lines, x.blank_before, x.blank_after) for x in b] == [(1, 1, 1), (4, 1, 1), (4, 1, 2)]
    kinds = [x.kind for x in segments.prepared_units(segments.block_scores(segments.block_features(segments.blocks(df)))).orderBy("block").collect()]
    assert kinds == ["heading", "list", "hardwrap"]


def test_merging_and_dividers(spark):
    df = spark.createDataFrame([(1, 0, "See Fig."), (1, 1, "Two shows it."), (1, 2, "Then more.")], "doc_id long, seq int, text string")
    out = segments.merged_after(df, "doc_id", "seq", segments.ends_open(F.col("text"))).orderBy("seq").collect()
    assert [r.text for r in out] == ["See Fig. Two shows it.", "Then more."]
    d = segments.dividers(spark.createDataFrame([(1, "prose a\nprose b\n* * *\nprose c")], "doc_id long, text string")).orderBy("seq").collect()
    assert [(r.kind, r.text) for r in d] == [("prose", "prose a\nprose b"), ("divider", "* * *"), ("prose", "prose c")]


def test_spread_and_midpoints(spark):
    for n in (1, 3, 20, 57):
        df = sampling.positions(spark.range(n).withColumn("g", F.lit(1)), "g", ["id"])
        got = [r.i for r in sampling.spread(df, 10).orderBy("i").collect()]
        assert got == (list(range(n)) if n <= 10 else [int((k + 0.5) * n / 10) for k in range(10)])
        order = [r.i for r in sampling.midpoint_rank(df).orderBy("depth", "i").collect()]
        assert order == sampling.midpoint_order(n)


def test_budget(spark):
    r = random.Random(3)
    rows = [(k % 3, f"{r.randrange(16**8):08x}", r.randint(1, 20)) for k in range(500)]
    df = spark.createDataFrame(rows, "g int, h string, w int")
    got = {tuple(x) for x in sampling.budget_take(df, "g", ["h"], "w", F.lit(300)).collect()}
    want = set()
    for g in range(3):
        used = 0
        for row in sorted((x for x in rows if x[0] == g), key=lambda x: x[1]):
            if used < 300:
                want.add(row)
            used += row[2]
    assert got == want


def test_shard_union(spark):
    all_rows = spark.range(10)
    parts = [all_rows.filter(f"id % 3 = {k}") for k in range(3)]
    assert sampling.combined_shards(parts, all_rows, "id").first().complete
    assert not sampling.combined_shards(parts[:2], all_rows, "id").first().complete


def test_parity_manifest_overlay(spark):
    a = spark.createDataFrame([("x", "1"), ("y", "2"), ("z", "3")], "path string, sha256 string")
    b = spark.createDataFrame([("x", "1"), ("y", "9"), ("w", "4")], "path string, sha256 string")
    assert {(r.path, r.state) for r in joins.parity(a, b).collect()} == {("x", "equal"), ("y", "mismatch"), ("z", "left_only"), ("w", "right_only")}
    m = a.withColumn("bytes", F.lit(1))
    have = spark.createDataFrame([("x", 1, "1"), ("x", 1, "1"), ("y", 2, "2"), ("q", 1, "5")], "path string, bytes int, sha256 string")
    assert {(r.path, r.problem) for r in joins.manifest_check(m, have).collect()} == {("x", "duplicate"), ("y", "size_mismatch"), ("z", "missing"), ("q", "unrecorded")}
    plan = {(r.path, r.action) for r in joins.overlay_plan(a, b, spark.createDataFrame([("x", "1"), ("y", "2")], "path string, sha256 string")).collect()}
    assert plan == {("x", "same"), ("y", "replace"), ("z", "unavailable")}


def test_small_joins(spark):
    v = spark.createDataFrame([("a", 1), ("a", 1), ("b", 1), ("b", 2)], "name string, value int")
    assert [tuple(r) for r in joins.resolved(v).collect()] == [("a", 1)]
    x = spark.createDataFrame([(0, "p"), (1, "q")], "i int, v string")
    assert joins.ordered_coverage(x, x, "i", "v").count() == 0
    assert joins.ordered_coverage(x, x.filter("i = 0"), "i", "v").count() == 1
    runs = spark.createDataFrame([(3, 2), (2, 1), (1, None)], "run_id int, parent_id int")
    assert joins.lineage(runs, 3) == [3, 2, 1]
    with pytest.raises(ValueError):
        joins.lineage(runs, 9)
    rows = spark.createDataFrame([("b", 1, "B"), ("a", 2, "A"), ("a", 3, "aa")], "k string, o int, s string")
    old = spark.createDataFrame([(7, "b", "old")], "id long, k string, display string")
    assert {tuple(r) for r in joins.get_or_create(rows, old, ["k"], "s", "o").collect()} == {(7, "b", "old"), (8, "a", "A")}


def test_packed_units_keep_very_long_sentences(spark, tmp_path):
    docs = [(1, "word " * 12_000), (2, "A short one. Then " + "word " * 10_001 + "end. And the last.")]
    spark.createDataFrame(docs, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = catalogue.packed_units(spark, str(tmp_path)).groupBy("doc_id").agg(F.sum("tokens").alias("n")).collect()
    assert {r.doc_id: r.n for r in got} == {1: 12_000, 2: 10_009}
