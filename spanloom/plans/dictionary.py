"""From senses to cards: translation of lemmas by probes, full coverage, cards in a hash-chained journal, one revision of a set."""

from __future__ import annotations

import json
import os
from collections.abc import Callable
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spanloom.operators import lexical

from . import ledger, providers
from .stages import StageError, empty


def senses_of(senses: DataFrame, entries: DataFrame, ids: list[int] | None = None) -> DataFrame:
    """Senses with their entry's columns, all or those of ``ids``, in the order of sense_id."""
    own = senses if ids is None else senses.filter(F.col("sense_id").isin(ids))
    return own.join(entries, "entry_id").orderBy("sense_id")


def evidence(senses: DataFrame, translator: Callable[[], providers.Translator], n: int = 4) -> DataFrame:
    """One row for each hypothesis of each probe of each sense: the target, whether it may stay, and how sure it is.

    ``senses`` is (sense_id, entry_id, lemma, pos, entry_type, dependency).
    """
    probes = senses.withColumn("p", F.explode(lexical.probes(F.col("lemma"), F.col("pos"), F.col("entry_type"), F.col("dependency"))))
    probes = probes.withColumn("at", lexical.effective_pos(F.col("pos"), F.col("dependency"), F.col("entry_type")))
    probes = probes.withColumn("key", F.concat_ws(":", F.col("sense_id").cast("string"), "p.kind"))
    found = providers.translate(probes.select("key", F.col("p.text").alias("text")), translator, n)
    rows = probes.join(found.select("key", "rank", F.col("text").alias("target")), "key")
    rows = rows.withColumn("cleaned", lexical.clean_target(F.col("target"), F.col("p.kind")))
    rows = rows.withColumn("lemma_key", lexical.lexical_key(F.col("lemma"))).withColumn("target_key", lexical.lexical_key(F.col("cleaned")))
    rows = rows.withColumn("reason", lexical.admissibility(F.col("lemma"), F.col("cleaned"), F.col("entry_type"), F.col("lemma_key"), F.col("target_key")))
    sure = lexical.confidence(F.col("rank"), F.col("p.base"), F.col("at.pos"), F.col("target_key"), F.col("entry_type"))
    return rows.select(
        "sense_id", "entry_id", "lemma", F.col("p.kind").alias("probe_kind"), F.col("p.text").alias("probe_text"), F.col("at.reason").alias("pos_reason"), "rank", "target",
        F.col("cleaned").alias("translation"), "target_key", F.col("reason").isNull().alias("accepted"), "reason", F.when(F.col("reason").isNull(), sure).alias("confidence"),
    )


def candidates(found: DataFrame, most: int = 8) -> DataFrame:
    """(lemma, target_key, translation, confidence, compatibility, place): the best accepted ones of each lemma."""
    own = found.filter("accepted").select("lemma", "target_key", "translation", "confidence", F.col("confidence").alias("compatibility"))
    return lexical.best_candidates(own, "lemma", most)


def provider_summary(found: DataFrame, best: DataFrame) -> DataFrame:
    """One row: senses, entries, candidates, rejected hypotheses, senses whose part of speech was repaired."""
    counts = found.agg(
        F.countDistinct("sense_id").alias("senses"),
        F.countDistinct("entry_id").alias("entries"),
        F.count_if(~F.col("accepted")).alias("rejected"),
        F.countDistinct(F.when(F.col("pos_reason") == "dependency_pos_repair", F.col("sense_id"))).alias("repaired"),
    )
    return counts.join(F.broadcast(best.agg(F.count("*").alias("candidates"))))  # one row each


def uncovered(senses: DataFrame, results: DataFrame) -> DataFrame:
    """(sense_id, problem): senses without a result, results of no sense or given twice, and results without a translation."""
    per = results.groupBy("sense_id").agg(F.count("*").alias("n"), F.max(F.length(F.trim(F.coalesce("translation", F.lit(""))))).alias("length"))
    both = senses.select("sense_id", F.lit(True).alias("own")).join(per, "sense_id", "full_outer")
    problem = F.when(F.col("own").isNull(), "unknown_sense").when(F.col("n").isNull(), "no_result").when(F.col("n") > 1, "duplicate").when(F.col("length") < 1, "blank")
    return both.select("sense_id", problem.alias("problem")).filter("problem is not null")


def translated(senses: DataFrame, translator: Callable[[], providers.Translator], n: int = 4, most: int = 8) -> DataFrame:
    """(sense_id, lemma, translation, confidence): each sense with its lemma's first candidate; an uncovered sense raises an error."""
    best = candidates(evidence(senses, translator, n), most).filter("place = 1")
    out = senses.select("sense_id", "lemma").join(best.select("lemma", "translation", "confidence"), "lemma", "left").select("sense_id", "lemma", "translation", "confidence")
    empty(uncovered(senses, out), "senses without a translation")
    return out


def chain(senses: DataFrame, selections: DataFrame, runs: DataFrame, candidate_rows: tuple[DataFrame, DataFrame, DataFrame], levels: DataFrame, sounds: DataFrame) -> DataFrame:
    """Senses (sense_id, lemma) with all that a card holds: translation, example selection, level and pronunciation.

    Translations come from accepted candidates and must cover every sense;
    nothing else is required, and nothing is inferred where a source is silent.
    """
    chosen = lexical.accepted_best(*candidate_rows)
    empty(uncovered(senses, chosen.join(candidate_rows[1].select("candidate_id", "translation"), "candidate_id").select("sense_id", "translation")), "senses without an accepted translation")
    words = chosen.join(candidate_rows[1].select("candidate_id", "translation"), "candidate_id").select("sense_id", "translation", "final_score")
    examples = lexical.current_examples(selections, runs).select("sense_id", "selection_id")
    forms = senses.select(F.col("lemma").alias("form")).distinct()
    level = lexical.looked_up(forms, levels).select(F.col("form").alias("lemma"), "level")
    sound = lexical.pronounced(forms, sounds).select(F.col("form").alias("lemma"), "pronunciation")
    return senses.join(words, "sense_id").join(examples, "sense_id", "left").join(level, "lemma", "left").join(sound, "lemma", "left")


class Cards:
    """Cards of senses in a journal: each sense once, in the order of the senses, each record chained to the one before.

    ``make`` turns a sense id into a card (a dict with card_revision_id). A call
    makes at most ``most`` cards and goes on where the last one stopped; cards
    are meant to be made by a service, one request each, so this is a loop on
    the driver over senses that were approved one by one.
    """

    def __init__(self, journal: str, sense_ids: list[int]):
        self.journal, self.sense_ids = journal, list(sense_ids)

    def records(self) -> list[dict]:
        """The records of the journal; a torn last line is cut off, a broken chain or another order raises an error."""
        try:
            with open(self.journal, encoding="utf-8") as f:
                lines = f.read().split("\n")
        except FileNotFoundError:
            return []
        out, before = [], ""
        for line in lines[:-1]:
            r = json.loads(line)
            if r["previous"] != before or r["sha"] != ledger.record_sha(before, r["body"]):
                raise StageError(f"record {len(out)} of {self.journal} does not fit the chain")
            body = json.loads(r["body"])
            if len(out) >= len(self.sense_ids) or body["sense_id"] != self.sense_ids[len(out)]:
                raise StageError(f"record {len(out)} of {self.journal} is of another sense")
            out.append(body | {"sha": r["sha"]})
            before = r["sha"]
        if lines[-1]:
            whole = "\n".join(lines[:-1]) + "\n" if out else ""
            with open(self.journal, "w", encoding="utf-8") as f:
                f.write(whole)
        return out

    def advance(self, make: Callable[[int], dict[str, Any]], most: int | None = None) -> dict[str, Any]:
        """Make the next cards; the manifest tells how many there are, whether that is all, and a hash over it."""
        if most is not None and most <= 0:
            raise ValueError("most must be positive")
        done = self.records()
        before = done[-1]["sha"] if done else ""
        todo = self.sense_ids[len(done) :][:most]
        for sense_id in todo:
            result = make(sense_id)
            revision = result.get("card_revision_id")
            if isinstance(revision, bool) or not isinstance(revision, int) or revision <= 0:
                raise StageError(f"sense {sense_id} gave no card_revision_id")
            body = {"sense_id": sense_id, "result": result, "result_sha": ledger.sha(result), "card_revision_id": revision}
            (line,) = ledger.chained([body], before)
            with open(self.journal, "a", encoding="utf-8") as f:
                f.write(line + "\n")
                f.flush()
                os.fsync(f.fileno())
            before = json.loads(line)["sha"]
        return self.manifest() | {"completed_now": len(todo)}

    def manifest(self) -> dict[str, Any]:
        done = self.records()
        out = {
            "expected": len(self.sense_ids),
            "completed": len(done),
            "senses_sha256": ledger.sha(self.sense_ids),
            "last_sha": done[-1]["sha"] if done else "",
            "card_revision_ids": [r["card_revision_id"] for r in done],
            "complete": len(done) == len(self.sense_ids),
        }
        return out | {"fingerprint": ledger.sha(out)}

    def assembled(self, spark: SparkSession, cards: DataFrame) -> DataFrame:
        """One revision of the set: the rows of ``cards`` (card_revision_id, ..) that the complete journal names, in its order, with the set's hash."""
        m = self.manifest()
        if not m["complete"]:
            raise StageError(f"{m['completed']} of {m['expected']} cards are made")
        named = spark.createDataFrame(list(enumerate(m["card_revision_ids"])), "position long, card_revision_id long")
        out = named.join(cards, "card_revision_id", "left")
        lost = out.join(cards.select("card_revision_id"), "card_revision_id", "left_anti")
        empty(lost.select("card_revision_id"), "cards that the set names are missing")
        return out.withColumn("set_revision", F.lit(m["fingerprint"])).orderBy("position")
