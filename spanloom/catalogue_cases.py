"""Queries for operators on tokens, candidates, hypotheses and records, over tables derived from the driver's, with the same in SQL.

The driver has no tags, candidates or hypotheses; rules on lengths, places and
keys stand in for them, so that each operator meets all of its cases.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from spanloom.catalogue import LENGTH, PAIRS, SENTENCES, TURNS, count_sql, literals_sql, pairs, query, turns
from spanloom.functions import numbers, text
from spanloom.operators import gates, joins, lexical, planning, sampling, segments, similarity
from spanloom.plans import dictionary, versions
from spanloom.session import table

# Tokens: words of turns, with a part of speech by length, a role and flags by place.

POS, ROLES = ("NOUN", "VERB", "ADJ", "DET", "PROPN", "X"), ("dobj", "nsubj", "amod")
TOKENS = rf"""{TURNS}, w AS (SELECT key, regexp_extract_all(text, '[\p{{L}}\p{{N}}_]+') AS ws FROM turns),
    o AS (SELECT key, unnest(ws) AS text, unnest(range(len(ws))) AS token_index FROM w),
    tok AS (SELECT *, {list(POS)}[1 + length(text) % 6] AS pos, {list(ROLES)}[1 + token_index % 3] AS dependency, CASE WHEN token_index % 4 = 0 THEN 'ORG' END AS entity_type, token_index % 5 = 0 AS is_oov FROM o)"""
CONTENT = str(lexical.CONTENT_POS)
REPAIRED = rf"""{TOKENS}, n AS (SELECT *, pos = 'VERB' AND dependency IN {lexical.OBJECT_DEPENDENCIES} AS noun FROM tok), p AS (SELECT * EXCLUDE pos, CASE WHEN noun THEN 'NOUN' ELSE pos END AS pos FROM n),
    r AS (SELECT *, pos IN {CONTENT} AND regexp_full_match(text, '\p{{L}}+') AND is_oov AS known, entity_type IS NOT NULL AND pos <> 'PROPN' AS plain FROM p)"""


def _one_of(values: tuple[str, ...], at: Column) -> Column:
    return F.get(F.array(*[F.lit(v) for v in values]), at.cast("int"))


def tokens(spark: SparkSession, sf: str) -> DataFrame:
    words = turns(spark, sf).select("key", F.posexplode(F.regexp_extract_all("text", F.lit(text.RUN), F.lit(0))).alias("token_index", "text"))
    i = F.col("token_index")
    return words.select(
        "*", _one_of(POS, F.length("text") % 6).alias("pos"), _one_of(ROLES, i % 3).alias("dependency"), F.when(i % 4 == 0, "ORG").alias("entity_type"), (i % 5 == 0).alias("is_oov"),
    )


@query(
    f"""WITH {REPAIRED} SELECT pos, array_to_string(list_filter([CASE WHEN noun THEN 'verb_object_to_noun' END, CASE WHEN known THEN 'oov_content_word_is_known' END,
      CASE WHEN plain THEN 'entity_only_on_proper_noun' END], lambda x: x IS NOT NULL), ',') AS repairs, count(*) AS n, count_if(is_oov AND NOT known)::BIGINT AS unknown, count(CASE WHEN NOT plain THEN entity_type END) AS entities
    FROM r GROUP BY 1, 2"""
)
def token_repairs(spark, sf):
    r = lexical.repaired(tokens(spark, sf)).withColumn("repairs", F.array_join("repairs", ","))
    return r.groupBy("pos", "repairs").agg(F.count("*").alias("n"), F.count_if("is_oov").alias("unknown"), F.count("entity_type").alias("entities"))


@query(rf"""WITH {REPAIRED} SELECT CASE WHEN pos = 'PROPN' THEN 'proper_noun' ELSE 'word' END AS entry_type, count(*) AS n FROM r WHERE pos IN {CONTENT} AND regexp_matches(text, '\p{{L}}') GROUP BY 1""")
def eligible_words(spark, sf):
    found = lexical.eligible(lexical.repaired(tokens(spark, sf)))
    return found.groupBy(lexical.entry_type(F.col("pos")).alias("entry_type")).agg(F.count("*").alias("n"))


KINDS = ("", "phrasal_verb", "idiom", "abbreviation", "noun_chunk", "collocation", "grammar_expression")


def _eligibility_sql(version: int) -> str:
    mwe, bad, none = (lexical.MWE_TYPES_V4, "non_dictionary_mwe:", "mwe_without_content_pos") if version == 4 else (lexical.MWE_TYPES_V2, "non_dictionary_mwe_type:", "multiword_without_content_pos")
    named = "kind" if version == 4 else "CASE WHEN kind = '' THEN 'unknown' ELSE kind END"
    return rf"""WITH {TOKENS}, g AS (SELECT key, list(text ORDER BY token_index) AS ts, list(pos ORDER BY token_index) AS ps FROM tok GROUP BY 1),
      c AS (SELECT {list(KINDS)}[1 + length(array_to_string(ts, ' ')) % 7] AS kind, ts[1:length(key) % 3] AS ts, ps[1:length(key) % 3] AS ps FROM g),
      j AS (SELECT CASE WHEN len(ts) < 1 THEN 'no_token_evidence' WHEN len(ts) > 1 AND kind NOT IN {mwe} THEN '{bad}' || {named}
        WHEN len(ts) > 1 AND len(list_filter(ps, lambda p: p IN {CONTENT})) > 0 THEN 'dictionary_mwe_with_content_head' WHEN len(ts) > 1 THEN '{none}' WHEN ps[1] IN {CONTENT} THEN 'content_pos'
        WHEN kind = 'abbreviation' AND regexp_full_match(ts[1], '\p{{L}}{{2,8}}') AND upper(ts[1]) = ts[1] THEN 'alphabetic_abbreviation' WHEN ps[1] IN {lexical.FUNCTION_POS} THEN 'non_dictionary_pos:' || ps[1]
        WHEN regexp_matches(ts[1], '\p{{Nd}}') THEN 'numeric_or_designation' ELSE 'unsupported_pos:' || ps[1] END AS reason FROM c)
      SELECT reason, reason IN ('content_pos', 'alphabetic_abbreviation', 'dictionary_mwe_with_content_head') AS ok, count(*) AS n FROM j GROUP BY 1, 2"""


def _eligibility(spark: SparkSession, sf: str, version: int) -> DataFrame:
    own = F.transform(F.array_sort(F.collect_list(F.struct("token_index", "text", "pos"))), lambda t: F.struct(t["text"].alias("text"), t["pos"].alias("pos")))
    g = tokens(spark, sf).groupBy("key").agg(own.alias("all"))
    kind = _one_of(KINDS, F.length(F.array_join(F.transform("all", lambda t: t["text"]), " ")) % 7)
    judged = g.select(lexical.dictionary_eligibility(kind, F.slice("all", F.lit(1), F.length("key") % 3), version).alias("e"))
    return judged.groupBy("e.reason", "e.ok").agg(F.count("*").alias("n"))


@query(_eligibility_sql(4))
def dictionary_eligibility_v4(spark, sf):
    return _eligibility(spark, sf, 4)


@query(_eligibility_sql(2))
def dictionary_eligibility_v2(spark, sf):
    return _eligibility(spark, sf, 2)


@query(
    f"""WITH {TOKENS}, l AS (SELECT DISTINCT lower(text) AS lemma, pos, dependency FROM tok),
    e AS (SELECT *, CASE WHEN pos = 'VERB' AND dependency IN {lexical.PROBE_DEPENDENCIES} THEN 'NOUN' ELSE pos END AS cls FROM l),
    f(cls, i, kind, base) AS (VALUES ('VERB', 1, 'verb_argument', 0.98), ('VERB', 2, 'verb_infinitive', 0.84), ('VERB', 3, 'lemma', 0.80), ('VERB', 4, 'titlecase', 0.68), ('ADJ', 1, 'adjective_copula', 0.98),
      ('ADJ', 2, 'lemma', 0.90), ('ADJ', 3, 'titlecase', 0.72), ('NOUN', 1, 'titlecase', 0.96), ('NOUN', 2, 'lemma', 0.90), ('X', 1, 'titlecase', 0.92), ('X', 2, 'lemma', 0.88)),
    p AS (SELECT lemma, pos, dependency, f.i, f.kind, f.base, CASE f.kind WHEN 'verb_argument' THEN 'to ' || lemma || ' something' WHEN 'verb_infinitive' THEN 'to ' || lemma WHEN 'adjective_copula' THEN 'is ' || lemma
      WHEN 'lemma' THEN lemma ELSE replace(upper(substr(lemma, 1, 1)), 'ẞ', 'SS') || substr(lemma, 2) END AS text FROM e JOIN f ON f.cls = CASE e.cls WHEN 'PROPN' THEN 'NOUN' WHEN 'DET' THEN 'X' ELSE e.cls END)
    SELECT lemma, pos, dependency, kind, text, base::DOUBLE AS base FROM p QUALIFY row_number() OVER (PARTITION BY lemma, pos, dependency, text ORDER BY i) = 1"""
)
def probe_forms(spark, sf):
    words = tokens(spark, sf).select(F.lower("text").alias("lemma"), "pos", "dependency").distinct()
    found = words.withColumn("p", F.explode(lexical.probes(F.col("lemma"), F.col("pos"), F.lit(None).cast("string"), F.col("dependency"))))
    return found.select("lemma", "pos", "dependency", "p.kind", "p.text", F.col("p.base").cast("double").alias("base"))


@query(
    rf"""WITH {TURNS}, t AS (SELECT key, text FROM turns), x AS (SELECT key, length(text) AS char_count, regexp_extract_all(text, '[\p{{L}}\p{{N}}_]+|[^\p{{L}}\p{{N}}_]+') AS p FROM t),
    y AS (SELECT key, char_count, unnest(p) AS piece, unnest(range(len(p))) AS k FROM x),
    z AS (SELECT *, coalesce(sum(length(piece)) OVER (PARTITION BY key ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS start FROM y),
    tok AS (SELECT *, row_number() OVER (PARTITION BY key ORDER BY k) - 1 AS i FROM z WHERE regexp_matches(piece, '^[\p{{L}}\p{{N}}_]')),
    g AS (SELECT key, i // 7 AS sentence_index, min(start) AS start, count(*) AS token_count, min(i) AS first_token_index, max(i) AS last_token_index, count_if(i % 4 = 0) AS entities, count_if(length(piece) = 2) AS pronouns,
      any_value(char_count) AS char_count FROM tok GROUP BY 1, 2)
    SELECT key, sentence_index::INT AS sentence_index, start, coalesce(lead(start) OVER (PARTITION BY key ORDER BY sentence_index), char_count) AS "end", token_count, first_token_index::INT AS first_token_index,
      last_token_index::INT AS last_token_index, entities::INT AS entities, pronouns::INT AS pronouns FROM g"""
)
def sentence_contexts(spark, sf):
    t = turns(spark, sf).select("key", "text")
    words = segments.word_runs(t, "key").withColumnRenamed("word", "text").withColumnRenamed("pos", "token_index")
    i = F.col("token_index")
    tagged = words.withColumn("sentence_index", F.floor(i / 7).cast("int")).withColumn("entity_type", F.when(i % 4 == 0, "ORG")).withColumn("pos", F.when(F.length("text") == 2, "PRON").otherwise("NOUN"))
    found = lexical.contexts(tagged.withColumn("lemma", F.col("text")), t.select("key", F.length("text").cast("long").alias("char_count")), "key")
    return found.select("key", "sentence_index", "start", "end", "token_count", "first_token_index", "last_token_index", F.size("entities").alias("entities"), F.size("pronouns").alias("pronouns"))


# Candidates and hypotheses: line items of a supplier, and events by fives.


@query(
    """WITH c AS (SELECT l_suppkey::VARCHAR AS lemma, (l_partkey % 20)::VARCHAR AS target_key, l_discount AS confidence, l_tax AS compatibility FROM lineitem),
    b AS (SELECT * FROM c QUALIFY row_number() OVER (PARTITION BY lemma, target_key ORDER BY confidence DESC, compatibility DESC) = 1)
    SELECT *, row_number() OVER (PARTITION BY lemma ORDER BY confidence DESC, compatibility DESC, target_key)::INT AS place FROM b QUALIFY place <= 8"""
)
def best_candidates(spark, sf):
    item = table(spark, sf, "lineitem")
    c = item.select(F.col("l_suppkey").cast("string").alias("lemma"), (F.col("l_partkey") % 20).cast("string").alias("target_key"), F.lit("t").alias("translation"), F.col("l_discount").alias("confidence"), F.col("l_tax").alias("compatibility"))
    return lexical.best_candidates(c).drop("translation")


HYPOTHESES = "h AS (SELECT event_id // 5 AS key, event_id % 5 AS rank, event_type AS text, floor(value)::BIGINT % 5 AS residue, 1 - event_id % 11 / 100 AS share, event_id % 7 * 0.45 AS ratio, user_id % 3 = 0 AS passed FROM events)"


def hypotheses(spark: SparkSession, sf: str) -> DataFrame:
    n = F.col("event_id")
    return table(spark, sf, "events").select(
        F.expr("event_id div 5").alias("key"), (n % 5).alias("rank"), F.col("event_type").alias("text"), (F.floor("value") % 5).alias("residue"), (1 - n % 11 / 100).alias("share"), (n % 7 * 0.45).alias("ratio"),
        (F.col("user_id") % 3 == 0).alias("passed"),
    )


@query(f"WITH {HYPOTHESES} SELECT key, min(rank) AS rank, arg_min(text, rank) AS text FROM h WHERE passed GROUP BY 1")
def first_passing_hypothesis(spark, sf):
    return gates.first_passing(hypotheses(spark, sf), "key", F.col("passed"))


@query(f"WITH {HYPOTHESES} SELECT key, residue, rank, text FROM h WHERE passed QUALIFY row_number() OVER (PARTITION BY key ORDER BY residue, rank) = 1")
def least_residue_hypothesis(spark, sf):
    return planning.best_by_residue(hypotheses(spark, sf), "key")


@query(
    f"""WITH {HYPOTHESES}, z AS (SELECT key, residue AS r, share AS s FROM h WHERE rank = 0), f AS (SELECT h.*, rank > 0 AS later FROM h JOIN z USING (key)
      WHERE rank = 0 OR (residue < r AND share >= s - 0.02 AND ratio BETWEEN 0.20 AND 2.5 AND trim(text) <> ''))
    SELECT key, rank, text FROM f QUALIFY row_number() OVER (PARTITION BY key ORDER BY later DESC, rank) = 1"""
)
def improving_hypothesis(spark, sf):
    return planning.improving(hypotheses(spark, sf), "key")


@query(
    """WITH b AS (SELECT event_id AS key, event_type AS text FROM events WHERE event_id % 2 = 0), c AS (SELECT event_id // 5 AS key, event_id % 5 AS priority, 'm' || event_id % 5 AS mechanism, 't' || event_id AS text FROM events WHERE user_id % 3 = 0),
    m AS (SELECT * FROM c QUALIFY row_number() OVER (PARTITION BY key ORDER BY priority) = 1) SELECT b.key, coalesce(m.text, b.text) AS text, coalesce(mechanism, 'baseline') AS mechanism FROM b LEFT JOIN m USING (key)"""
)
def mechanism_cascade(spark, sf):
    e, n = table(spark, sf, "events"), F.col("event_id")
    base = e.filter(n % 2 == 0).select(n.alias("key"), F.col("event_type").alias("text"))
    found = e.select(
        F.expr("event_id div 5").alias("key"), (n % 5).alias("priority"), F.concat(F.lit("m"), (n % 5).cast("string")).alias("mechanism"), F.concat(F.lit("t"), n.cast("string")).alias("text"), (F.col("user_id") % 3 == 0).alias("passed"),
    )
    return gates.cascade(base, found, "key")


# Senses and their sources.


@query("WITH s AS (SELECT (c_custkey % 100)::VARCHAR AS lemma, min(c_name) AS primary FROM customer GROUP BY 1) SELECT o_orderkey, lemma, primary FROM orders JOIN s ON lemma = (o_custkey % 100)::VARCHAR".replace("primary", '"primary"'))
def sense_arbitration(spark, sf):
    senses = table(spark, sf, "orders").select("o_orderkey", (F.col("o_custkey") % 100).cast("string").alias("lemma"))
    snapshot = table(spark, sf, "customer").groupBy((F.col("c_custkey") % 100).cast("string").alias("lemma")).agg(F.array_sort(F.collect_list("c_name")).alias("candidates"))
    return lexical.arbitrated(senses, snapshot).select("o_orderkey", "lemma", "primary")


@query(
    """WITH r AS (SELECT user_id AS sense_id, event_id AS candidate_id, floor(value)::BIGINT AS final_score FROM events WHERE event_id % 3 = 0)
    SELECT sense_id, candidate_id, final_score FROM r QUALIFY row_number() OVER (PARTITION BY sense_id ORDER BY final_score DESC, candidate_id) = 1"""
)
def accepted_candidates(spark, sf):
    e = table(spark, sf, "events").withColumnRenamed("event_id", "candidate_id")
    return lexical.accepted_best(e.select(F.col("user_id").alias("sense_id"), "candidate_id"), e.select("candidate_id", F.floor("value").alias("final_score")), e.filter("candidate_id % 3 = 0"))


@query(
    """SELECT o_custkey AS sense_id, o_orderkey AS selection_id, starts_with(o_orderpriority, '1') AS is_current FROM orders WHERE o_orderstatus = 'F' AND o_orderkey % 50 % 2 = 0
    QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY is_current DESC, o_orderkey DESC) = 1"""
)
def current_examples(spark, sf):
    o = table(spark, sf, "orders")
    selections = o.select(
        F.col("o_custkey").alias("sense_id"), F.col("o_orderkey").alias("selection_id"), (F.col("o_orderkey") % 50).alias("run_id"), F.startswith("o_orderpriority", F.lit("1")).alias("is_current"),
        F.when(F.col("o_orderstatus") == "F", "approved").otherwise("draft").alias("status"),
    )
    return lexical.current_examples(selections, spark.range(0, 50, 2).withColumnRenamed("id", "run_id"))


@query(
    """WITH f AS (SELECT DISTINCT p_name AS form FROM part), w AS (SELECT form, unnest(p) AS word, unnest(range(len(p))) AS i FROM (SELECT form, string_split(lower(form), ' ') AS p FROM f)),
    d AS (SELECT DISTINCT word, upper(word) AS p FROM w WHERE length(word) % 4 <> 0), h AS (SELECT form, i, p FROM w LEFT JOIN d USING (word))
    SELECT form, CASE WHEN bool_and(p IS NOT NULL) THEN string_agg(p, ' ' ORDER BY i) END AS pronunciation, bool_and(p IS NOT NULL) AS found FROM h GROUP BY 1"""
)
def pronunciations(spark, sf):
    forms = table(spark, sf, "part").select(F.col("p_name").alias("form")).distinct()
    words = forms.select(F.explode(F.split(F.lower("form"), " ")).alias("word")).distinct().filter(F.length("word") % 4 != 0)
    return lexical.pronounced(forms, words.withColumn("pronunciation", F.upper("word")))


@query(
    """WITH f AS (SELECT DISTINCT p_type AS form FROM part), r AS (SELECT lower(p_type) AS k, min(p_brand) AS level FROM part WHERE p_size > 25 GROUP BY 1) SELECT form, level FROM f LEFT JOIN r ON lower(form) = k"""
)
def reference_levels(spark, sf):
    part = table(spark, sf, "part")
    known = part.filter("p_size > 25").select(F.upper("p_type").alias("headword"), F.col("p_brand").alias("level"))
    return lexical.looked_up(part.select(F.col("p_type").alias("form")).distinct(), known)


EVIDENCE = "e AS (SELECT l_partkey AS sense_id, l_suppkey AS entry_id, l_returnflag <> 'R' AS accepted, CASE WHEN l_linestatus = 'F' THEN 'dependency_pos_repair' ELSE 'declared_pos' END AS pos_reason FROM lineitem)"


@query(
    f"""WITH {EVIDENCE} SELECT count(DISTINCT sense_id) AS senses, count(DISTINCT entry_id) AS entries, count_if(NOT accepted)::BIGINT AS rejected,
    count(DISTINCT CASE WHEN pos_reason = 'dependency_pos_repair' THEN sense_id END) AS repaired, (SELECT count(*) FROM part) AS candidates FROM e"""
)
def provider_summary(spark, sf):
    item = table(spark, sf, "lineitem")
    found = item.select(
        F.col("l_partkey").alias("sense_id"), F.col("l_suppkey").alias("entry_id"), (F.col("l_returnflag") != "R").alias("accepted"),
        F.when(F.col("l_linestatus") == "F", "dependency_pos_repair").otherwise("declared_pos").alias("pos_reason"),
    )
    return dictionary.provider_summary(found, table(spark, sf, "part"))


@query(
    """WITH s AS (SELECT p_partkey AS sense_id FROM part WHERE p_partkey % 7 <> 0), r AS (SELECT o_custkey AS sense_id, CASE WHEN o_orderstatus = 'F' THEN 'x' ELSE ' ' END AS translation FROM orders),
    p AS (SELECT sense_id, count(*) AS n, max(length(trim(translation))) AS length FROM r GROUP BY 1),
    j AS (SELECT coalesce(s.sense_id, p.sense_id) AS sense_id, CASE WHEN s.sense_id IS NULL THEN 'unknown_sense' WHEN n IS NULL THEN 'no_result' WHEN n > 1 THEN 'duplicate' WHEN length < 1 THEN 'blank' END AS problem FROM s FULL JOIN p ON s.sense_id = p.sense_id)
    SELECT * FROM j WHERE problem IS NOT NULL"""
)
def uncovered_senses(spark, sf):
    senses = table(spark, sf, "part").filter("p_partkey % 7 <> 0").select(F.col("p_partkey").alias("sense_id"))
    results = table(spark, sf, "orders").select(F.col("o_custkey").alias("sense_id"), F.when(F.col("o_orderstatus") == "F", "x").otherwise(" ").alias("translation"))
    return dictionary.uncovered(senses, results)


@query(
    "SELECT l_orderkey AS fragment_id, l_orderkey * 10 + l_linenumber AS occurrence_id, o_orderpriority AS kind FROM lineitem JOIN orders ON o_orderkey = l_orderkey WHERE o_orderpriority IN ('1-URGENT', '2-HIGH') AND o_orderstatus = 'F'"
)
def fragment_occurrences(spark, sf):
    item, o = table(spark, sf, "lineitem"), table(spark, sf, "orders")
    occurrences = item.select(F.col("l_orderkey").alias("fragment_id"), (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("occurrence_id"))
    fragments = o.select(F.col("o_orderkey").alias("fragment_id"), F.col("o_orderpriority").alias("kind"), F.col("o_orderstatus").alias("result"))
    return joins.fragment_occurrences(occurrences, fragments, ("1-URGENT", "2-HIGH"), ("F",)).select("fragment_id", "occurrence_id", "kind")


# Guards over pairs of documents and of turns.

INTS = r"list_sort(list_filter(regexp_extract_all({0}, '[\p{{L}}\p{{N}}_]+'), lambda x: regexp_full_match(x, '[0-9]+')))"


@query(f"WITH {PAIRS} SELECT segment_id, {INTS.format('source')} = {INTS.format('target')} AS equal FROM pairs")
def integer_multisets(spark, sf):
    return pairs(spark, sf).select("segment_id", gates.integer_multiset_equal(F.col("source"), F.col("target")).alias("equal"))


BARE = r"regexp_replace({0}, '\[[^\[\]]*\]|_[^_]*_', ' ', 'g')"


@query(
    f"""WITH {TURNS}, p AS (SELECT key, regexp_extract_all({BARE.format("target")}, '[A-Za-z]{{4,}}') AS t, list_transform(regexp_extract_all(text, '[A-Za-z]{{4,}}'), lambda w: lower(w)) AS s FROM turns WHERE target IS NOT NULL)
    SELECT key, array_to_string(list_filter(t, lambda w: list_contains(s, lower(w))), ' ') AS residue FROM p"""
)
def latin_residue(spark, sf):
    p = turns(spark, sf).filter("target is not null")
    return p.select("key", F.array_join(gates.latin_residue(F.col("text"), F.col("target")), " ").alias("residue"))


def _faults_sql() -> str:
    """RE2 cannot look around, so letters are doubled for the mark between letters."""
    spaced, between, doubled = gates.PUNCTUATION_FAULTS
    between = between.replace("(?<=[A-Za-z])", "[A-Za-z]").replace("(?=[A-Za-z])", "[A-Za-z]")
    counts = [f"len(regexp_extract_all({c}, '{p}'))" for c, p in (("text", spaced), (r"regexp_replace(text, '([A-Za-z])', '\1\1', 'g')", between), ("text", doubled))]
    return " + ".join(counts)


@query(
    rf"""WITH n AS (SELECT doc_id, text, len(regexp_extract_all(text, '[\p{{L}}\p{{N}}_]+')) AS words FROM documents)
    SELECT doc_id, ({_faults_sql()} + CASE WHEN words >= 80 AND len(regexp_extract_all(text, '{gates.STOPS}')) <= 1 THEN 1 ELSE 0 END
      + CASE WHEN trim(text) <> '' AND NOT regexp_matches(text, '{text.TERMINAL.replace("'", "''")}') AND words > 3 THEN 1 ELSE 0 END)::BIGINT AS faults FROM n"""
)
def punctuation_faults(spark, sf):
    return table(spark, sf, "documents").select("doc_id", gates.punctuation_proxy(F.col("text")).alias("faults"))


@query(
    rf"""WITH {SENTENCES} SELECT CASE WHEN regexp_matches(source, '(?i)\[in\s+_Fig\._\s+(\d+)\.\]') THEN 'H-figure'
      WHEN regexp_matches(source, '(?:^|[^\p{{L}}\p{{N}}\p{{M}}_])(?:\d+-\d+/\d+|\d+/\d+|\d{{1,3}}(?:\s\d{{3}})+|\d+)(?:[^\p{{L}}\p{{N}}\p{{M}}_]|$)') THEN 'G-numeric' ELSE 'general' END AS category, count(*) AS n FROM sentences GROUP BY 1"""
)
def unit_categories(spark, sf):
    u = segments.sentence_units(table(spark, sf, "documents"))
    return u.groupBy(planning.unit_category(F.col("source")).alias("category")).agg(F.count("*").alias("n"))


@query(
    f"""{LENGTH}, f AS (SELECT segment_id, lang FROM pairs WHERE segment_id IN (SELECT segment_id FROM length_fail)),
    s AS (SELECT p.segment_id, f.segment_id IS NOT NULL AS failed, len(regexp_extract_all(source, '[A-Za-z]')) / nullif(length(source), 0) AS a, len(regexp_extract_all(target, '[A-Za-z]')) / nullif(length(target), 0) AS b FROM pairs p LEFT JOIN f ON f.segment_id = p.segment_id)
    SELECT count(*) AS units, count_if(failed)::BIGINT AS failed_units, round(avg(a), 9) AS baseline_mean, round(avg(b), 9) AS candidate_mean, count_if(failed) = 0 AND avg(b) >= avg(a) - 0.01 AS passed FROM s"""
)
def global_pass(spark, sf):
    judged = gates.verdicts(pairs(spark, sf), {"length": gates.length()}, "failures")
    share = lambda c: F.regexp_count(F.col(c), F.lit("[A-Za-z]")) / F.nullif(F.length(c), F.lit(0))
    out = gates.global_pass(judged.withColumn("baseline_share", share("source")).withColumn("share", share("target")))
    return out.withColumn("baseline_mean", F.round("baseline_mean", 9)).withColumn("candidate_mean", F.round("candidate_mean", 9))


# Ranks, versions, records.


@query("SELECT doc_id, n_chars FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels) ORDER BY n_chars DESC, doc_id LIMIT 25")
def top_disjoint(spark, sf):
    return sampling.top_disjoint(table(spark, sf, "documents").select("doc_id", "n_chars"), 25, table(spark, sf, "labels"), "doc_id", "n_chars")


@query(f"WITH {PAIRS}, d AS (SELECT segment_id, length(target) - length(source) AS delta FROM pairs) SELECT segment_id, delta::INT AS delta, row_number() OVER (ORDER BY delta, segment_id) AS place FROM d")
def worst_first(spark, sf):
    d = pairs(spark, sf).select("segment_id", (F.length("target") - F.length("source")).alias("delta"))
    return similarity.worst_first(d, "delta", "segment_id")


VERSION = "CASE WHEN p_partkey % 9 = 0 THEN 'none' ELSE p_size || '.' || p_partkey % 7 || '.' || p_partkey % 11 || CASE WHEN p_partkey % 2 = 0 THEN '-rc1' ELSE '' END END"


def version_strings(spark: SparkSession, sf: str) -> DataFrame:
    n = F.col("p_partkey")
    made = F.concat_ws(".", F.col("p_size").cast("string"), (n % 7).cast("string"), F.concat((n % 11).cast("string"), F.when(n % 2 == 0, "-rc1").otherwise("")))
    return table(spark, sf, "part").withColumn("version", F.when(n % 9 == 0, "none").otherwise(made))


@query(f"WITH v AS (SELECT {VERSION} AS v FROM part) SELECT v AS version, CASE WHEN v = 'none' THEN -1 ELSE split_part(v, '.', 1)::INT END AS major, CASE WHEN v = 'none' THEN -1 ELSE split_part(v, '.', 2)::INT END AS minor, CASE WHEN v = 'none' THEN -1 ELSE regexp_extract(split_part(v, '.', 3), '^\\d+')::INT END AS patch, count(*) AS n FROM v GROUP BY ALL")
def version_keys(spark, sf):
    found = version_strings(spark, sf).withColumn("k", joins.version_key(F.col("version")))
    return found.groupBy("version", "k.major", "k.minor", "k.patch").agg(F.count("*").alias("n"))


@query(
    f"""WITH c AS (SELECT p_partkey, p_partkey % 4 = 0 AS identity_match, p_partkey % 3 = 0 AS catalog_match, p_partkey % 2 = 0 AS structural_complete, p_size % 2 = 0 AS runtime_ok,
      list_position({list(joins.REPORT_STATES)}, {[*joins.REPORT_STATES, "other"]}[1 + p_partkey % 4]) AS state, p_partkey % 5 AS targets, {VERSION} AS v, p_name || p_partkey AS path FROM part)
    SELECT p_partkey, row_number() OVER (ORDER BY identity_match DESC, coalesce(state, 0) DESC, catalog_match DESC, structural_complete DESC, runtime_ok DESC, targets DESC,
      CASE WHEN v = 'none' THEN -1 ELSE split_part(v, '.', 1)::INT END DESC, CASE WHEN v = 'none' THEN -1 ELSE split_part(v, '.', 2)::INT END DESC, CASE WHEN v = 'none' THEN -1 ELSE regexp_extract(split_part(v, '.', 3), '^\\d+')::INT END DESC,
      lower(path) DESC)::INT AS place FROM c"""
)
def archive_priority(spark, sf):
    n = F.col("p_partkey")
    c = version_strings(spark, sf).select(
        "p_partkey", "version", (n % 4 == 0).alias("identity_match"), (n % 3 == 0).alias("catalog_match"), (n % 2 == 0).alias("structural_complete"), (F.col("p_size") % 2 == 0).alias("runtime_ok"),
        _one_of((*joins.REPORT_STATES, "other"), n % 4).alias("status"), (n % 5).alias("targets"), F.concat("p_name", n.cast("string")).alias("path"),
    )
    return joins.by_priority(c).select("p_partkey", "place")


SEGMENTS_JSON = """'{"end_char":' || e || ',"end_ms":null,"sequence_number":' || seq || ',"start_char":' || s || ',"start_ms":null,"text":' || to_json(text)::VARCHAR || '}'"""


@query(
    rf"""WITH p AS (SELECT conv_id * 1000 + turn AS id, text, string_split(text, '. ') AS p FROM conversations), x AS (SELECT id, unnest(p) AS text, unnest(range(len(p))) AS seq FROM p),
    y AS (SELECT *, coalesce(sum(length(text) + 1) OVER (PARTITION BY id ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS s FROM x), z AS (SELECT *, s + length(text) AS e FROM y),
    g AS (SELECT id, sha256('[' || string_agg({SEGMENTS_JSON}, ',' ORDER BY seq) || ']') AS segments_sha256, count(*) AS segment_count, string_agg(text, chr(10) ORDER BY seq) AS content FROM z GROUP BY 1)
    SELECT id AS import_event_id, segment_count::INT AS segment_count, length(content)::INT AS char_count, sha256('{{"force_text":false,"import_event_id":' || id || ',"segments_sha256":"' || segments_sha256 || '","selected_encoding":"utf-8","selected_format":"txt","source_sha256":"'
      || sha256(p.text) || '","text_sha256":"' || sha256(content) || '"}}') AS interpretation_key FROM g JOIN p USING (id)"""
)
def interpretation_keys(spark, sf):
    c = table(spark, sf, "conversations").select((F.col("conv_id") * 1000 + F.col("turn")).alias("import_event_id"), "text")
    imports = c.select("import_event_id", F.sha2(F.col("text").cast("binary"), 256).alias("source_sha256"), F.lit("txt").alias("selected_format"), F.lit("utf-8").alias("selected_encoding"), F.lit(False).alias("force_text"))
    parts = c.select("import_event_id", F.posexplode(F.split("text", r"\. ")).alias("sequence_number", "text"))
    placed = segments.concatenated(parts, "import_event_id", "sequence_number")
    none = F.lit(None).cast("long")
    found = versions.interpreted(imports, placed.withColumn("start_ms", none).withColumn("end_ms", none))
    return found.select("import_event_id", "segment_count", "char_count", "interpretation_key")


@query("SELECT event_id AS id, ts AS sequence_number FROM events WHERE user_id = 3 AND event_type = 'click' ORDER BY ts, event_id")
def run_items(spark, sf):
    e = table(spark, sf, "events").select(F.col("user_id").alias("run_id"), F.col("event_type").alias("kind"), F.col("ts").alias("sequence_number"), F.col("event_id").alias("id"), F.col("props").alias("payload_json"))
    return versions.items_of(e, 3, "click").select("id", "sequence_number")


STRIP = r"regexp_replace({0}, '^\s+|\s+$', '', 'g')"
DIVIDER = r"^\s*(?:\*(?:\s+\*)+|[-=_*]{{3,}})\s*$"


@query(
    rf"""WITH s AS (SELECT doc_id, string_split(regexp_replace(text, '\r\n?', chr(10), 'g'), chr(10)) AS p FROM documents), l AS (SELECT doc_id, unnest(p) AS text, unnest(range(len(p))) AS seq FROM s),
    d AS (SELECT *, regexp_matches(text, '{DIVIDER}') AS divider FROM l), c AS (SELECT *, CASE WHEN divider OR coalesce(lag(divider) OVER w <> divider, true) THEN 1 ELSE 0 END AS c FROM d WINDOW w AS (PARTITION BY doc_id ORDER BY seq)),
    i AS (SELECT *, sum(c) OVER (PARTITION BY doc_id ORDER BY seq) AS island FROM c), g AS (SELECT doc_id, island, divider, string_agg(text, chr(10) ORDER BY seq) AS text FROM i GROUP BY 1, 2, 3)
    SELECT doc_id, (island - 1)::BIGINT AS seq, CASE WHEN divider THEN 'divider' ELSE 'prose' END AS kind, length(text)::INT AS chars FROM g WHERE divider OR trim(text) <> ''"""
)
def divided_parts(spark, sf):
    return segments.dividers(table(spark, sf, "documents")).select("doc_id", "seq", "kind", F.length("text").alias("chars"))


@query(
    """WITH t AS (SELECT user_id, string_agg(event_type, chr(10) ORDER BY event_id) AS v FROM events GROUP BY 1) SELECT user_id, sha256(v) AS fingerprint FROM t"""
)
def sequence_fingerprints(spark, sf):
    return planning.fingerprint(table(spark, sf, "events"), "user_id", ["event_id"], "event_type")


@query(f"WITH {SENTENCES}, w AS (SELECT words::BIGINT AS tokens FROM sentences) SELECT count(*) AS units, sum(tokens)::BIGINT AS tokens, sum(ceil(tokens / 96))::BIGINT AS chunks FROM w")
def chunk_accounting(spark, sf):
    u = segments.sentence_units(table(spark, sf, "documents"))
    return planning.chunk_accounting(u, "words")


@query(
    r"""SELECT doc_id, sha256(regexp_extract(text, '^\s*(?:\S+\s+){11}\S+')) AS prefix FROM documents WHERE regexp_matches(text, '^\s*(?:\S+\s+){11}\S+')"""
)
def first_twelve_words(spark, sf):
    d = table(spark, sf, "documents").select("doc_id", planning.first_words(F.col("text"), 12).alias("p"))
    return d.filter("p is not null").select("doc_id", F.sha2(F.col("p").cast("binary"), 256).alias("prefix"))


@query(f"WITH {PAIRS} SELECT segment_id, {count_sql('source', repr('%'))}::BIGINT AS n FROM pairs WHERE {count_sql('source', repr('%'))} > 0")
def critical_signs(spark, sf):
    p = pairs(spark, sf).select("segment_id", text.count_of(F.col("source"), "%").alias("n"))
    return p.filter("n > 0")


@query(r"SELECT doc_id, len(list_distinct(list_filter(list_transform(regexp_extract_all(lower(text), '[a-z]+'), lambda w: CASE WHEN w IN ('one', 'two', 'three', 'four', 'five', 'six', 'seven', 'eight', 'nine', 'ten') THEN w END), lambda w: w IS NOT NULL))) AS n FROM documents")
def number_words(spark, sf):
    own = F.filter(numbers.spelled(F.col("text"), most=10), lambda v: v != "0")
    return table(spark, sf, "documents").select("doc_id", F.size(F.array_distinct(own)).cast("long").alias("n"))

def _spread_sql(rows: str, reason: str) -> str:
    return f"""SELECT doc_id, i, '{reason}' AS reason FROM (SELECT doc_id, i, row_number() OVER (PARTITION BY doc_id ORDER BY i) - 1 AS j, count(*) OVER (PARTITION BY doc_id) AS m FROM {rows})
      WHERE len(list_filter(range(least(8, m)), lambda k: floor((k + 0.5) * m / least(8, m)) = j)) > 0"""


CRITICAL = " OR ".join(f"contains(source, '{c}')" for c in planning.CRITICAL)


@query(
    f"""WITH RECURSIVE {SENTENCES}, p AS (SELECT doc_id, occurrence, source, words, row_number() OVER (PARTITION BY doc_id ORDER BY occurrence) - 1 AS i, count(*) OVER (PARTITION BY doc_id) AS n FROM sentences),
    b AS (SELECT *, unnest(range(least(8, n))) AS bucket FROM p), numeric AS (SELECT * FROM p WHERE len({literals_sql("source")}) > 0), critical AS (SELECT * FROM p WHERE {CRITICAL}),
    picks AS (SELECT doc_id, i, 'position_bucket:' || bucket AS reason FROM b WHERE (bucket + 1) * n // least(8, n) > bucket * n // least(8, n)
        AND i = bucket * n // least(8, n) + ((bucket + 1) * n // least(8, n) - bucket * n // least(8, n) - 1) // 2
      UNION ALL {_spread_sql("numeric", "numeric")} UNION ALL {_spread_sql("critical", "critical_symbol")}
      UNION ALL SELECT doc_id, i, 'long_unit' FROM p WHERE words >= 24 QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY words DESC, occurrence) <= 8),
    chosen AS (SELECT doc_id, i, array_to_string(list_sort(list_distinct(list(reason))), ',') AS reasons FROM picks GROUP BY 1, 2),
    h AS (SELECT DISTINCT n, 0::BIGINT AS a, n AS b, 0 AS depth FROM p
      UNION ALL SELECT n, c.a, c.b, depth + 1 FROM (SELECT n, depth, unnest([{{'a': a, 'b': a + (b - a - 1) // 2}}, {{'a': a + (b - a - 1) // 2 + 1, 'b': b}}]) AS c FROM h) WHERE c.b > c.a),
    r AS (SELECT p.*, reasons, depth FROM p LEFT JOIN chosen USING (doc_id, i) JOIN h ON h.n = p.n AND p.i = h.a + (h.b - h.a - 1) // 2),
    f AS (SELECT *, sum(CASE WHEN reasons IS NOT NULL THEN words ELSE 0 END) OVER (PARTITION BY doc_id) AS held,
      coalesce(sum(CASE WHEN reasons IS NULL THEN words ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY depth, i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM r)
    SELECT doc_id, occurrence::INT AS occurrence, coalesce(reasons, 'budget_fill') AS reasons FROM f WHERE reasons IS NOT NULL OR held + before < 400"""
)
def coverage_stratified(spark, sf):
    u = segments.sentence_units(table(spark, sf, "documents")).select("doc_id", "occurrence", F.col("source").alias("text"))
    return planning.coverage_sample(u, 400, "doc_id", ("occurrence",)).select("doc_id", "occurrence", F.array_join("reasons", ",").alias("reasons"))
