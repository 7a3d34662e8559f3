"""Interpretations of imported sources as versions: identity, cache hits, drift, ordered readers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: What a version's identity is made of, in the order of its canonical JSON.
IDENTITY = ("force_text", "import_event_id", "segments_sha256", "selected_encoding", "selected_format", "source_sha256", "text_sha256")
SEGMENT = ("end_char", "end_ms", "sequence_number", "start_char", "start_ms", "text")


def _json_sha(value: Column) -> Column:
    return F.sha2(F.to_json(value, {"ignoreNullFields": "false"}).cast("binary"), 256)


def interpreted(imports: DataFrame, segments: DataFrame, key: str = "import_event_id") -> DataFrame:
    """One row for each import with its ``interpretation_key``, text and counts.

    ``imports`` has (key, source_sha256, selected_format, selected_encoding,
    force_text), ``segments`` (key and SEGMENT). The key hashes both, the
    segments by the JSON of their list in order.
    """
    rows = F.array_sort(F.collect_list(F.struct("sequence_number", F.struct(*SEGMENT).alias("s"))))
    per = segments.groupBy(key).agg(rows.alias("rows"))
    own = F.transform("rows", lambda r: r["s"])
    content = F.array_join(F.transform("rows", lambda r: r["s"]["text"]), "\n")
    found = per.select(key, _json_sha(own).alias("segments_sha256"), F.size("rows").alias("segment_count"), content.alias("content_text"))
    out = imports.join(found, key).withColumn("text_sha256", F.sha2(F.col("content_text").cast("binary"), 256)).withColumn("char_count", F.length("content_text"))
    return out.withColumn("interpretation_key", _json_sha(F.struct(*IDENTITY)))


def versions(candidates: DataFrame, known: DataFrame) -> DataFrame:
    """``candidates`` with ``cache_hit``: whether ``known`` has their key already.

    A known version whose segment count or text hash differs has drifted: an error.
    """
    old = known.select("interpretation_key", F.col("segment_count").alias("_n"), F.col("text_sha256").alias("_t"))
    out = candidates.join(old, "interpretation_key", "left")
    drift = F.col("_n").isNotNull() & ((F.col("_n") != F.col("segment_count")) | (F.col("_t") != F.col("text_sha256")))
    hit = F.when(drift, F.raise_error(F.concat(F.lit("drift of the cached interpretation "), F.col("interpretation_key"))).cast("boolean")).otherwise(F.col("_n").isNotNull())
    return out.withColumn("cache_hit", hit).drop("_n", "_t")


def one(rows: DataFrame, key: str, value: int) -> dict:
    """The row of a key, as a dict; an unknown key raises an error."""
    found = rows.filter(F.col(key) == value).limit(1).collect()
    if not found:
        raise KeyError(f"unknown {key} {value}")
    return found[0].asDict(recursive=True)


def segments_of(segments: DataFrame, version: int, key: str = "document_version_id") -> DataFrame:
    """A version's segments in order, with their metadata as a map."""
    own = segments.filter(F.col(key) == version).orderBy("sequence_number")
    return own.withColumn("metadata", F.from_json("metadata_json", "map<string,string>")).drop("metadata_json")


def items_of(items: DataFrame, run_id: int, kind: str | None = None, payload: str = "map<string,string>") -> DataFrame:
    """A run's items in the order of (sequence_number, id), of one kind if given, with their payload parsed."""
    own = items.filter(F.col("run_id") == run_id)
    own = own if kind is None else own.filter(F.col("kind") == kind)
    return own.orderBy("sequence_number", "id").withColumn("payload", F.from_json("payload_json", payload)).drop("payload_json")
