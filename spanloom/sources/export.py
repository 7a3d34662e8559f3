"""Sinks: verified artifacts, exports and small reports."""

from __future__ import annotations

import hashlib
import html
import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

FORMATS = ("json", "jsonl", "csv", "parquet", "markdown")
#: Rows that a rendered document holds at most.
RENDERED_ROWS = 10_000


def export(df: DataFrame, path: str, kind: str = "json", mode: str = "error") -> None:
    """Write a result; ``markdown`` renders up to RENDERED_ROWS rows and raises an error beyond them."""
    if kind not in FORMATS:
        raise ValueError(f"unknown format {kind!r}; one of {FORMATS}")
    if kind == "markdown":
        df.sparkSession.createDataFrame([(markdown(df),)], "value string").coalesce(1).write.mode(mode).option("lineSep", "\n").text(path)
    elif kind == "csv":
        df.write.mode(mode).option("header", "true").csv(path)
    elif kind == "parquet":
        df.write.mode(mode).parquet(path)
    else:
        df.write.mode(mode).json(path)


def _small(df: DataFrame) -> list:
    rows = df.limit(RENDERED_ROWS + 1).collect()
    if len(rows) > RENDERED_ROWS:
        raise ValueError(f"more than {RENDERED_ROWS} rows to render")
    return rows


def markdown(df: DataFrame) -> str:
    def cell(v) -> str:
        return "" if v is None else str(v).replace("|", "\\|").replace("\n", " ")

    out = ["| " + " | ".join(df.columns) + " |", "|" + "---|" * len(df.columns)]
    return "\n".join(out + ["| " + " | ".join(cell(v) for v in r) + " |" for r in _small(df)])


def report(title: str, tables: dict[str, DataFrame]) -> str:
    """A self-contained HTML page of small tables, with the same data as JSON inside."""
    data = {k: [r.asDict(recursive=True) for r in _small(df)] for k, df in tables.items()}
    body = [f"<!doctype html><meta charset='utf-8'><title>{html.escape(title)}</title><h1>{html.escape(title)}</h1>"]
    for k, rows in data.items():
        heads = tables[k].columns
        body.append(f"<h2>{html.escape(k)}</h2><table border='1'><tr>" + "".join(f"<th>{html.escape(h)}</th>" for h in heads) + "</tr>")
        body += ["<tr>" + "".join(f"<td>{html.escape('' if r[h] is None else str(r[h]))}</td>" for h in heads) + "</tr>" for r in rows]
        body.append("</table>")
    embedded = json.dumps(data, ensure_ascii=False, sort_keys=True, default=str).replace("</", "<\\/")
    return "\n".join(body) + f"\n<script type='application/json' id='data'>{embedded}</script>\n"


def content_hash(df: DataFrame) -> str:
    """An order-free hash of all rows: the sums of two 64-bit row hashes and the count."""
    row = F.to_json(F.struct(*sorted(df.columns)), {"ignoreNullFields": "false"})
    sums = df.select(F.xxhash64(row).alias("a"), F.xxhash64(row, F.lit(1)).alias("b")).agg(
        F.sum(F.col("a").cast("decimal(38,0)")), F.sum(F.col("b").cast("decimal(38,0)")), F.count("*")
    ).first()
    return hashlib.sha256(repr(tuple(str(x) for x in sums)).encode()).hexdigest()


def _replace(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file in one step: readers see the old one or the new one, never a part."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    target, staged = jvm.org.apache.hadoop.fs.Path(path), jvm.org.apache.hadoop.fs.Path(f"{path}.{uuid.uuid4().hex}")
    out = target.getFileSystem(conf).create(staged, False)
    out.write(bytearray(text.encode()))
    out.hsync()
    out.close()
    overwrite = spark.sparkContext._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 1)
    overwrite[0] = getattr(jvm.org.apache.hadoop.fs, "Options$Rename").OVERWRITE
    qualified = target.getFileSystem(conf).makeQualified(target)
    jvm.org.apache.hadoop.fs.FileContext.getFileContext(qualified.toUri(), conf).rename(staged, target, overwrite)


def write_artifact(df: DataFrame, path: str, **about: str) -> dict:
    """Write Parquet into a folder of its own, then replace the manifest, which names it with row count, schema and content hash.

    Until the manifest is replaced readers get the artifact that was there
    before. ``about`` is kept in the manifest, such as the revision.
    """
    name = f"data-{uuid.uuid4().hex}"
    df.write.parquet(f"{path}/{name}")
    back = df.sparkSession.read.parquet(f"{path}/{name}")
    manifest = {"data": name, "rows": back.count(), "schema": back.schema.json(), "sha256": content_hash(back), **about}
    _replace(df.sparkSession, f"{path}/manifest.json", json.dumps(manifest, sort_keys=True))
    return manifest


def manifest_of(spark: SparkSession, path: str) -> dict:
    return json.loads(spark.read.text(f"{path}/manifest.json", wholetext=True).first()[0])


def read_artifact(spark: SparkSession, path: str) -> DataFrame:
    """Read an artifact back; content that differs from its manifest raises an error."""
    manifest = manifest_of(spark, path)
    df = spark.read.parquet(f"{path}/{manifest['data']}")
    if df.count() != manifest["rows"] or content_hash(df) != manifest["sha256"]:
        raise ValueError(f"artifact {path} differs from its manifest")
    return df


def export_revision(cards: DataFrame, path: str, revision: str, kind: str = "jsonl", column: str = "set_revision") -> dict:
    """Export the rows of one revision and write its record beside them: revision, format, rows and content hash."""
    own = cards.filter(F.col(column) == revision)
    record = {"revision": revision, "format": kind, "rows": own.count(), "sha256": content_hash(own)}
    if not record["rows"]:
        raise ValueError(f"no rows of revision {revision!r}")
    export(own, f"{path}/{kind}", kind)
    _replace(cards.sparkSession, f"{path}/record.json", json.dumps(record, sort_keys=True))
    return record
