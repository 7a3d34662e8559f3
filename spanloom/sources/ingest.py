"""Content-addressed import: files as rows, identities, decoding, reference tables."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_files(spark: SparkSession, path: str, pattern: str | None = None) -> DataFrame:
    """(path, content, byte_size, sha256, object_path) of all files below a folder; a file must fit in a task's memory."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    return identified(reader.load(path).select("path", "content"))


def identified(files: DataFrame) -> DataFrame:
    """``files`` (path, content) with byte_size, sha256 and the object's place in a content-addressed store."""
    sha = F.sha2("content", 256)
    out = files.withColumn("byte_size", F.octet_length("content").cast("long")).withColumn("sha256", sha)
    return out.withColumn("object_path", F.concat(F.lit("objects/"), F.substring("sha256", 1, 2), F.lit("/"), F.col("sha256")))


def new_imports(files: DataFrame, ledger: DataFrame) -> DataFrame:
    """One row for each content (sha256, byte_size), the first path as its name, with ``cache_hit`` if the ledger has it."""
    key = ["sha256", "byte_size"]
    first = files.groupBy(*key).agg(F.min("path").alias("source_name"), F.count("*").alias("copies"))
    known = ledger.select(*key).distinct().withColumn("cache_hit", F.lit(True))
    return first.join(known, key, "left").withColumn("cache_hit", F.coalesce("cache_hit", F.lit(False)))


def tree_identity(files: DataFrame, root: str = "root") -> DataFrame:
    """(root, files, bytes, tree_sha256): a hash over the sorted (path, size, hash) lines of each root.

    The hash runs over the lines in order, so a root is one task's stream; the
    lines are sorted by Spark, which spills, and pass through one by one.
    """
    kind = dict(files.dtypes)[root]
    line = F.concat_ws("\t", "path", F.col("byte_size").cast("string"), "sha256")
    ordered = files.select(root, "path", "byte_size", line.alias("line")).repartition(root).sortWithinPartitions(root, "path", "line")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, digest, n, size = None, None, 0, 0

        def row():
            columns = (pa.repeat(own, 1), pa.array([n], pa.int64()), pa.array([size], pa.int64()), pa.array([digest.hexdigest()]))
            return pa.RecordBatch.from_arrays(list(columns), names=[root, "files", "bytes", "tree_sha256"])

        for batch in batches:
            for owner, count, text in zip(batch.column(0), batch.column(1), batch.column(2)):
                if digest is None or owner.as_py() != own.as_py():
                    if digest is not None:
                        yield row()
                    own, digest, n, size = owner, hashlib.sha256(), 0, 0
                digest.update((b"\n" if n else b"") + text.as_py().encode())
                n, size = n + 1, size + count.as_py()
        if digest is not None:
            yield row()

    return ordered.select(root, "byte_size", "line").mapInArrow(run, f"`{root}` {kind}, files long, bytes long, tree_sha256 string")


def decoded(content: Column, declared: Column | None = None) -> Column:
    """struct(text, encoding): declared charset, byte order marks, else strict UTF-8; anything else raises an error."""
    head2, head3 = F.hex(F.substring(content, 1, 2)), F.hex(F.substring(content, 1, 3))
    declared = declared if declared is not None else F.lit(None).cast("string")
    known = ("utf-8", "utf-16", "utf-16le", "utf-16be", "iso-8859-1", "us-ascii", "utf-32")
    name = F.lower(declared)
    by_name = F.lit(None).cast("string")
    for k in known:
        by_name = F.when(name == k, F.decode(content, k)).otherwise(by_name)
    encoding = (
        F.when(declared.isNotNull(), F.when(name.isin(*known), name).otherwise(F.raise_error(F.concat(F.lit("unsupported encoding "), declared))))
        .when(head3 == "EFBBBF", "utf-8-sig")
        .when(head2.isin("FFFE", "FEFF"), "utf-16")
        .when(F.is_valid_utf8(content.cast("string")), "utf-8")
        .otherwise(F.raise_error(F.lit("neither a byte order mark nor valid UTF-8: declare the encoding")))
    )
    text = (
        F.when(declared.isNotNull(), by_name)
        .when(head3 == "EFBBBF", F.decode(F.substring(content, F.lit(4), F.octet_length(content)), "utf-8"))
        .when(head2.isin("FFFE", "FEFF"), F.decode(content, "utf-16"))
        .otherwise(F.decode(content, "utf-8"))
    )
    return F.struct(text.alias("text"), encoding.alias("encoding"))


def pinned_csv(spark: SparkSession, path: str, columns: list[str], rows: int, sha256: str | None = None) -> DataFrame:
    """A reference CSV whose header, row count and (if given) hash must be exact."""
    schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    header = spark.read.text(path).limit(1).first()
    if header is None or [h.strip() for h in header[0].split(",")] != columns:
        raise ValueError(f"unexpected header in {path}")
    if sha256 and read_files(spark, path).select("sha256").first()[0] != sha256:
        raise ValueError(f"{path} is not the pinned file")
    df = spark.read.csv(path, header=True, schema=schema, enforceSchema=False)
    if (n := df.count()) != rows:
        raise ValueError(f"{path} has {n} rows, not {rows}")
    return df
