"""The chain from tagged documents to sense groups, as relational programs over providers."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from spanloom.operators import gates, joins, lexical, segments

from . import providers


class StageError(RuntimeError):
    """A stage whose output does not cover its input."""


@dataclass
class Result:
    """DataFrames of one run, each lazy."""

    tokens: DataFrame
    contexts: DataFrame
    units: DataFrame
    segments: DataFrame
    gate_summary: DataFrame
    approved: DataFrame
    alignment: DataFrame
    occurrences: DataFrame
    entries: DataFrame
    senses: DataFrame


def planned_units(tokens: DataFrame, contexts: DataFrame, preferred: int) -> DataFrame:
    """(doc_id, seq, start, end): sentences, cut after each ``preferred`` tokens that are not space."""
    real = tokens.filter("pos <> 'SPACE'").select("doc_id", "sentence_index", "start", "end")
    spans = contexts.select("doc_id", F.col("sentence_index").alias("seg"), F.col("start").alias("seg_start"), F.col("end").alias("seg_end"))
    held = joins.contained(real, spans)
    chunk = held.withColumn("chunk", F.expr(f"(row_number() over (partition by doc_id, seg order by start) - 1) div {preferred}"))
    cuts = chunk.groupBy("doc_id", "seg", "chunk", "seg_start", "seg_end").agg(F.min("start").alias("first"))
    w = Window.partitionBy("doc_id", "seg").orderBy("chunk")
    start = F.when(F.col("chunk") == 0, F.col("seg_start")).otherwise(F.col("first"))
    cut = cuts.withColumn("start", start).withColumn("end", F.coalesce(F.lead("first").over(w), F.col("seg_end")))
    order = Window.partitionBy("doc_id").orderBy("start")
    return cut.withColumn("seq", F.row_number().over(order) - 1).select("doc_id", "seq", "start", "end")


def empty(problems: DataFrame, what: str) -> None:
    """Raise unless there are no problems; a few are named."""
    if found := problems.limit(20).collect():
        raise StageError(f"{what}: {[r.asDict() for r in found]}")


def run(
    docs: DataFrame,
    tagger: Callable[[], providers.Tagger],
    translator: Callable[[], providers.Translator],
    preferred: int = 96,
    quality: dict[str, gates.Gate] = gates.GATES,
) -> Result:
    """All stages over documents (doc_id, text). Each fails closed: a gate that finds issues, or a token without
    exactly one segment, raises an error."""
    tokens = providers.tag(docs, tagger)
    contexts = lexical.contexts(tokens, docs.select("doc_id", F.length("text").alias("char_count")))
    units = planned_units(tokens, contexts, preferred).join(docs, "doc_id")
    units = units.withColumn("source", F.expr("substring(text, start + 1, end - start)")).drop("text")
    units = units.withColumn("key", F.concat_ws(":", "doc_id", "seq"))
    best = providers.translate(units.select("key", F.col("source").alias("text")), translator).filter("rank = 0")
    pairs = units.join(best.select("key", F.col("text").alias("target")), "key").withColumn("segment_id", F.col("key"))
    summary = gates.summary(pairs, quality)
    empty(summary.filter("not passed"), "quality gates failed")
    approved = gates.approved(pairs, quality)
    alignment = approved.select(
        "doc_id", F.col("seq").alias("seg"), F.col("start").alias("seg_start"), F.col("end").alias("seg_end"), "source", "target",
        F.lit("structural_identity").alias("method"), F.lit(1.0).alias("confidence"),
    )
    found = tokens.withColumn("pos_index", F.col("token_index"))
    held, rest = lexical.occurrences(found, alignment.select("doc_id", "seg", "seg_start", "seg_end", "target"))
    empty(rest.select("doc_id", "text", "matches"), "content tokens without exactly one segment")
    entries = lexical.entries(held)
    keyed = held.join(entries.drop("display"), ["normalized_lemma", "pos", "entry_type"])
    senses = lexical.senses(keyed, ["entry_id"], "target", ["doc_id", "pos_index"], ["start", "end", "text"])
    return Result(tokens, contexts, units, pairs, summary, approved, alignment, keyed, entries, senses)
