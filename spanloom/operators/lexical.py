"""Lexical extraction, sense grouping and dictionary enrichment."""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spanloom.functions.arrays import reasons
from spanloom.functions.text import fold, strip

from .joins import exactly_one, get_or_create

#: Parts of speech, dependencies and entry types.
CONTENT_POS = ("NOUN", "PROPN", "VERB", "ADJ", "ADV")
FUNCTION_POS = ("DET", "AUX", "ADP", "PRON", "PART", "CCONJ", "SCONJ", "PUNCT", "SPACE", "SYM", "NUM")
OBJECT_DEPENDENCIES = ("dobj", "obj", "pobj")
PROBE_DEPENDENCIES = ("dobj", "obj", "pobj", "nsubj", "nsubjpass")
VERB_ENTRY_TYPES = ("phrasal_verb", "prepositional_verb")
MWE_TYPES_V4 = (
    "phrasal_verb", "prepositional_verb", "idiom", "collocation", "compound_term", "technical_term", "grammar_expression", "discontinuous_expression",
)
MWE_TYPES_V2 = ("phrasal_verb", "prepositional_verb", "grammar_expression", "compound_term", "collocation")


def repaired(tokens: DataFrame) -> DataFrame:
    """Tokens (text, pos, dependency, entity_type, is_oov) repaired in order, with the list ``repairs``.

    A verb in an object role is a noun; an alphabetic content word is not out
    of vocabulary; only proper nouns keep an entity. Later rules see the
    repaired part of speech.
    """
    pos = F.upper(F.coalesce("pos", F.lit("X")))
    noun = (pos == "VERB") & F.lower(F.coalesce("dependency", F.lit(""))).isin(*OBJECT_DEPENDENCIES)
    t = tokens.withColumn("_noun", noun).withColumn("pos", F.when(noun, "NOUN").otherwise(pos))
    known = F.col("pos").isin(*CONTENT_POS) & F.col("text").rlike(r"^\p{L}+$") & F.coalesce("is_oov", F.lit(False))
    plain = F.col("entity_type").isNotNull() & (F.col("entity_type") != "") & (F.col("pos") != "PROPN")
    t = t.withColumn("repairs", reasons(("verb_object_to_noun", F.col("_noun")), ("oov_content_word_is_known", known), ("entity_only_on_proper_noun", plain)))
    return t.withColumn("is_oov", F.when(known, False).otherwise(F.col("is_oov"))).withColumn("entity_type", F.when(~plain, F.col("entity_type"))).drop("_noun")


def eligible(tokens: DataFrame) -> DataFrame:
    return tokens.filter(F.col("pos").isin(*CONTENT_POS) & (strip(F.col("text")) != "") & F.col("text").rlike(r"\p{L}"))


def entry_type(pos: Column) -> Column:
    return F.when(pos == "PROPN", "proper_noun").otherwise("word")


def dictionary_eligibility(kind: Column, tokens: Column, version: int = 4) -> Column:
    """struct(ok, reason) of a candidate: its type and array<struct<text, pos>>."""
    one = F.element_at(tokens, 1)
    pos, text = F.coalesce(one["pos"], F.lit("X")), F.coalesce(one["text"], F.lit(""))
    kind = F.coalesce(kind, F.lit(""))
    content = F.exists(tokens, lambda t: F.coalesce(t["pos"], F.lit("X")).isin(*CONTENT_POS))
    abbreviation = (kind == "abbreviation") & text.rlike(r"^\p{L}{2,8}$") & (F.upper(text) == text)
    mwe, bad, none = (MWE_TYPES_V4, "non_dictionary_mwe:", "mwe_without_content_pos") if version == 4 else (MWE_TYPES_V2, "non_dictionary_mwe_type:", "multiword_without_content_pos")
    named = kind if version == 4 else F.when(kind == "", "unknown").otherwise(kind)
    reason = (
        F.when(F.coalesce(F.size(tokens), F.lit(0)) < 1, "no_token_evidence")
        .when((F.size(tokens) > 1) & ~kind.isin(*mwe), F.concat(F.lit(bad), named))
        .when((F.size(tokens) > 1) & content, "dictionary_mwe_with_content_head")
        .when(F.size(tokens) > 1, none)
        .when(pos.isin(*CONTENT_POS), "content_pos")
        .when(abbreviation, "alphabetic_abbreviation")
        .when(pos.isin(*FUNCTION_POS), F.concat(F.lit("non_dictionary_pos:"), pos))
        .when(text.rlike(r"\p{Nd}"), "numeric_or_designation")
        .otherwise(F.concat(F.lit("unsupported_pos:"), pos))
    )
    return F.struct(reason.isin("content_pos", "alphabetic_abbreviation", "dictionary_mwe_with_content_head").alias("ok"), reason.alias("reason"))


def occurrences(tokens: DataFrame, segments: DataFrame, key: str = "doc_id") -> tuple[DataFrame, DataFrame]:
    """(covered, uncovered) content tokens: each must lie in exactly one segment and have a lemma.

    tokens: (key, pos_index, start, end, text, lemma, pos, dependency,
    entity_type, is_oov); segments: (key, seg, seg_start, seg_end, target).
    """
    found = eligible(repaired(tokens)).withColumn("normalized_lemma", fold(F.coalesce("lemma", "text"))).withColumn("entry_type", entry_type(F.col("pos")))
    held, rest = exactly_one(found.filter("normalized_lemma <> ''"), segments, key, [key, "pos_index"])
    blank = found.filter("normalized_lemma = ''").withColumn("matches", F.lit(0).cast("long"))
    return held, rest.unionByName(blank)


def entries(held: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    """(entry_id, normalized_lemma, pos, entry_type, display): one row for each lemma, part of speech and type."""
    keys = ["normalized_lemma", "pos", "entry_type"]
    rows = held.withColumn("_order", F.struct(*[c for c in ("doc_id", "pos_index") if c in held.columns]))
    if existing is None:
        existing = held.sparkSession.createDataFrame([], "entry_id long, normalized_lemma string, pos string, entry_type string, display string")
    return get_or_create(rows, existing, keys, "text", "_order", "entry_id")


def senses(held: DataFrame, entry: list[str], target: str = "target", order: list[str] | None = None, evidence: list[str] | None = None) -> DataFrame:
    """Occurrences grouped by entry and folded target: count, ordered evidence and a hash as key.

    Blank target evidence is a class of its own. The hash is over the entry,
    the folded target and the ordered places, so it does not depend on ids
    that a run hands out. A column ``target_key`` that is there already is taken
    as the folded target, so that a target is folded once and not for each word.
    """
    order = order or ["doc_id", "pos_index"]
    rows = held if "target_key" in held.columns else held.withColumn("target_key", fold(F.coalesce(target, F.lit(""))))
    groups = rows.groupBy(*entry, "target_key").agg(
        F.count("*").alias("occurrence_count"), F.array_sort(F.collect_list(F.struct(*order, *(evidence or [])))).alias("evidence")
    )
    places = F.array_join(F.transform("evidence", lambda e: F.concat_ws(":", *[e[o].cast("string") for o in order])), ",")
    return groups.withColumn("sense_key", F.sha2(F.concat_ws("\n", *[F.col(e).cast("string") for e in entry], "target_key", places).cast("binary"), 256))


def sense_summary(found: DataFrame, entry: list[str]) -> DataFrame:
    """(entries, senses, occurrences, most_senses) over all sense groups."""
    per = found.groupBy(*entry).agg(F.count("*").alias("n"), F.sum("occurrence_count").alias("o"))
    return per.agg(F.count("*").alias("entries"), F.sum("n").alias("senses"), F.sum("o").alias("occurrences"), F.max("n").alias("most_senses"))


def effective_pos(pos: Column, dependency: Column, kind: Column) -> Column:
    """struct(pos, reason) that probes go by."""
    p = F.upper(F.coalesce(pos, F.lit("X")))
    role = (p == "VERB") & F.lower(F.coalesce(dependency, F.lit(""))).isin(*PROBE_DEPENDENCIES)
    verb = F.lower(F.coalesce(kind, F.lit(""))).isin(*VERB_ENTRY_TYPES)
    return F.struct(
        F.when(verb, "VERB").when(role, "NOUN").otherwise(p).alias("pos"),
        F.when(verb, "verb_mwe_entry_type").when(role, "dependency_pos_repair").otherwise("declared_pos").alias("reason"),
    )


def probes(lemma: Column, pos: Column, kind: Column, dependency: Column) -> Column:
    """array<struct<kind, text, base>> of the forms under which a lemma is looked up; each text once, the first kind stays."""
    lemma = strip(F.regexp_replace(lemma, r"\s+", " "))
    title = F.concat(F.upper(F.substring(lemma, 1, 1)), F.substring(lemma, F.lit(2), F.length(lemma)))
    form = {
        "verb_argument": F.concat(F.lit("to "), lemma, F.lit(" something")),
        "verb_infinitive": F.concat(F.lit("to "), lemma),
        "adjective_copula": F.concat(F.lit("is "), lemma),
        "lemma": lemma,
        "titlecase": title,
    }

    def rows(**bases: float) -> Column:
        return F.array(*[F.struct(F.lit(k).alias("kind"), form[k].alias("text"), F.lit(b).alias("base")) for k, b in bases.items()])

    at = effective_pos(pos, dependency, kind)["pos"]
    verb = F.lower(F.coalesce(kind, F.lit(""))).isin(*VERB_ENTRY_TYPES)
    found = (
        F.when(lemma == "", rows(lemma=0.0))
        .when(verb, rows(verb_argument=0.98, verb_infinitive=0.84, lemma=0.78, titlecase=0.70))
        .when(at == "VERB", rows(verb_argument=0.98, verb_infinitive=0.84, lemma=0.80, titlecase=0.68))
        .when(at == "ADJ", rows(adjective_copula=0.98, lemma=0.90, titlecase=0.72))
        .when(at.isin("NOUN", "PROPN"), rows(titlecase=0.96, lemma=0.90))
        .otherwise(rows(titlecase=0.92, lemma=0.88))
    )
    texts = F.transform(found, lambda x: x["text"])
    return F.filter(found, lambda x, i: (x["text"] != "") & (F.array_position(texts, x["text"]) == i + 1))


def normalize_lexical(values: pd.Series) -> pd.Series:
    """NFKC, edge punctuation off, white space collapsed, case folded (Spark has no NFKC)."""
    edges = " \t\n\r\x0b\x0c.,;:!?…\"'«»()[]{}"

    def one(v: str | None) -> str:
        v = unicodedata.normalize("NFKC", v or "").strip().strip(edges)
        return " ".join(v.split()).casefold().strip()

    return values.map(one)


def lexical_key(text: Column) -> Column:
    return F.pandas_udf(normalize_lexical, "string")(text)


def clean_target(target: Column, kind: Column) -> Column:
    """Edge marks off; an argument probe also loses its generic object."""
    bare = F.regexp_replace(strip(target), r"^[ .,!;:…]+|[ .,!;:…]+$", "")
    return F.when(kind == "verb_argument", strip(F.regexp_replace(bare, r"(?iu)\s+(?:что(?:-|\s)?то|что(?:-|\s)?нибудь|это)\s*$", ""))).otherwise(bare)


def admissibility(lemma: Column, target: Column, kind: Column, lemma_key: Column, target_key: Column) -> Column:
    """The first reason against a target candidate, null if it may stay. Keys are ``lexical_key`` of lemma and target."""
    t = strip(target)
    words = F.regexp_count(t, F.lit("[А-Яа-яЁё]+"))
    return (
        F.when(target_key == "", "empty")
        .when(target_key == lemma_key, "identity")
        .when(~t.rlike("[А-Яа-яЁё]"), "no_cyrillic")
        .when(t.rlike("[A-Za-z]"), "latin_leakage")
        .when(t.rlike(r"(?U)^[\W\d_]+$"), "numeric_or_punctuation_only")
        .when(t.rlike(r"\p{Nd}") & ~lemma.rlike(r"\p{Nd}"), "unlicensed_numeric_addition")
        .when(~t.rlike(r"^[\p{L}\p{N}«\"]"), "leading_symbol_noise")
        .when(target_key.rlike("^(?:чтобы |для того чтобы )"), "synthetic_probe_wrapper")
        .when(F.lower(F.coalesce(kind, F.lit(""))).isin(*VERB_ENTRY_TYPES) & (words < 2), "incomplete_multiword_translation")
    )


def confidence(rank: Column, base: Column, pos: Column, target_key: Column, kind: Column) -> Column:
    """Base less 0.045 a rank; infinitives of verbs gain, other forms lose; within 0.52 and 0.99."""
    infinitive = (pos == "VERB") & F.substring_index(target_key, " ", 1).rlike("(?:ть|ться|ти|тись|чь|чься)$")
    score = base - rank * 0.045
    score = F.when(infinitive, F.greatest(score, F.lit(0.84)) + 0.08).when(pos == "VERB", score - 0.20).otherwise(score)
    score = score + F.when(F.lower(F.coalesce(kind, F.lit(""))).isin(*VERB_ENTRY_TYPES) & infinitive, 0.05).otherwise(0.0)
    return F.round(F.least(F.lit(0.99), F.greatest(F.lit(0.52), score)), 4)


def best_candidates(candidates: DataFrame, key: str = "lemma", most: int = 8) -> DataFrame:
    """Of each key's candidates (target_key, translation, confidence, compatibility) the best of each target, then the best ``most``.

    Adds ``place`` from 1, by confidence, compatibility (both falling), then target.
    """
    best = candidates.groupBy(key, "target_key").agg(F.max_by(F.struct("translation", "confidence", "compatibility"), F.struct("confidence", "compatibility")).alias("b"))
    w = Window.partitionBy(key).orderBy(F.desc("b.confidence"), F.desc("b.compatibility"), "target_key")
    return best.withColumn("place", F.row_number().over(w)).filter(F.col("place") <= most).select(key, "target_key", "b.*", "place")


def arbitrated(senses: DataFrame, snapshot: DataFrame, key: str = "lemma") -> DataFrame:
    """Senses with the first candidate of their lemma in a provider snapshot (key, candidates); a miss raises an error."""
    out = senses.join(snapshot, key, "left")
    first = F.when(F.col("candidates").isNull() | (F.size("candidates") < 1), F.raise_error(F.concat(F.lit("no candidate for "), F.col(key)))).otherwise(F.element_at("candidates", 1))
    return out.withColumn("primary", first).drop("candidates")


def accepted_best(run_candidates: DataFrame, candidates: DataFrame, accepted: DataFrame) -> DataFrame:
    """For each sense the candidate with the highest final_score among those with accepted evidence (ties: least id)."""
    rows = run_candidates.join(candidates, "candidate_id").join(accepted.select("candidate_id"), "candidate_id", "left_semi")
    return rows.groupBy("sense_id").agg(F.max_by("candidate_id", F.struct("final_score", -F.col("candidate_id"))).alias("candidate_id"), F.max("final_score").alias("final_score"))


def current_examples(selections: DataFrame, runs: DataFrame) -> DataFrame:
    """For each sense the approved selection that is current, else the newest."""
    rows = selections.join(runs.select("run_id"), "run_id", "left_semi").filter("status = 'approved'")
    return rows.groupBy("sense_id").agg(F.max_by(F.struct("selection_id", "is_current"), F.struct("is_current", "selection_id")).alias("s")).select("sense_id", "s.selection_id", "s.is_current")


def looked_up(forms: DataFrame, reference: DataFrame, key: str = "headword", value: str = "level") -> DataFrame:
    """Forms with the reference's value, null where it has none: nothing is inferred."""
    ref = reference.groupBy(F.lower(key).alias("_k")).agg(F.min(value).alias(value))
    return forms.join(ref, F.lower("form") == F.col("_k"), "left").drop("_k")


def pronounced(forms: DataFrame, dictionary: DataFrame) -> DataFrame:
    """(form, pronunciation, found): exact entries; a form of several words only if every word has one."""
    words = forms.select("form", F.posexplode(F.split(F.lower(strip(F.col("form"))), r"\s+")).alias("i", "word"))
    hit = words.join(dictionary.groupBy(F.lower("word").alias("word")).agg(F.min("pronunciation").alias("p")), "word", "left")
    out = hit.groupBy("form").agg(F.bool_and(F.col("p").isNotNull()).alias("found"), F.array_sort(F.collect_list(F.struct("i", "p"))).alias("ps"))
    return out.select("form", F.when(F.col("found"), F.array_join(F.transform("ps", lambda x: x["p"]), " ")).alias("pronunciation"), "found")


def contexts(tokens: DataFrame, char_count: DataFrame, key: str = "doc_id") -> DataFrame:
    """One row for each sentence of a tagged document: span to the next one's start, counts, entities, pronouns."""
    g = tokens.groupBy(key, "sentence_index").agg(
        F.min("start").alias("start"),
        F.count("*").alias("token_count"),
        F.min("token_index").alias("first_token_index"),
        F.max("token_index").alias("last_token_index"),
        F.array_sort(F.collect_list(F.when(F.col("entity_type").isNotNull(), F.struct("token_index", "text", "entity_type")))).alias("entities"),
        F.array_sort(F.collect_list(F.when(F.col("pos") == "PRON", F.struct("token_index", "text", "lemma")))).alias("pronouns"),
    )
    following = F.lead("start").over(Window.partitionBy(key).orderBy("sentence_index"))
    return g.join(char_count, key).withColumn("end", F.coalesce(following, F.col("char_count"))).drop("char_count")
