"""The pipeline's stages, one after the other, and the entry's queries with their SQL."""

import corpus_pipeline
from spanloom.llm import queries

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_stages(spark, sf, tmp_path):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    kept = [{r.doc_id for r in docs.collect()}]
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, sf)
        if k < 4:
            assert out.columns == COLUMNS
        out.write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        kept.append({r.doc_id for r in docs.collect()})
    assert all(b <= a for a, b in zip(kept, kept[1:])) and kept[4] == kept[5]
    items = [r.text for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    leaked = {i for i in kept[2] if any(t in texts[i] for t in items)}
    assert leaked and kept[3] == kept[2] - leaked
    assert sum(map(bool, kept)) == 6


def test_stages_on_odd_and_empty_tables(spark, sf, odd, nothing, tmp_path):
    """Extra columns, named like those that the stages use, pass through unchanged."""
    clash = ("lang_pred", "language", "mix", "leak", "gone", "again", "th", "place", "tokens")
    odd, nothing = (df.selectExpr("*", *(f"concat('{c}', doc_id) as {c}" for c in clash)) for df in (odd, nothing))
    before = {(r.doc_id, r.text): r for r in odd.collect()}
    for n, start in enumerate((odd, nothing)):
        docs = start
        for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
            path = str(tmp_path / f"{n}{name}")
            stage(spark, docs, sf).write.parquet(path)
            docs = spark.read.parquet(path)
            if k < 4:
                assert docs.columns == start.columns
                assert all(before[r.doc_id, r.text] == r for r in docs.collect())
        assert (docs.count() > 0) == (n == 0)


def test_sql(spark, sf):
    import duckdb

    db = duckdb.connect()
    for t in ("documents", "pages"):
        db.execute(f"create view {t} as select * from '{sf}/{t}.parquet'")
    for name, sql in queries.SQL.items():
        got = queries.QUERIES[name](spark, sf)
        want = db.execute(f"select {', '.join(got.columns)} from ({sql})").fetchall()
        assert sorted(map(repr, map(tuple, got.collect()))) == sorted(map(repr, want)), name
