"""All queries of the library outside ``llm``: operators bound to the driver's tables, with the same in SQL.

Pairs are documents with neighbouring ids. They exercise the gates as
relational operators; they are not translations.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from spanloom.functions import numbers, text
from spanloom.functions.arrays import held, multiset_minus, reasons
from spanloom.operators import gates, joins, lexical, planning, sampling, segments, similarity
from spanloom.plans import ledger
from spanloom.session import table
from spanloom.sources import archives, ingest
from spanloom.streaming.imports import windowed_events

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


# Pieces of SQL that several oracles share.
WORD = text.WORD.replace("'", "''")
PAIRS = "pairs AS (SELECT a.doc_id AS segment_id, a.lang, a.text AS source, b.text AS target FROM documents a JOIN documents b ON b.doc_id = a.doc_id + 1)"
SENTENCES = rf"""parts AS (
  SELECT doc_id, string_split(regexp_replace(regexp_replace(text, '\r\n?', chr(10), 'g'), '([.!?])\s+([A-Z_\["''])', '\1' || chr(1) || '\2', 'g'), chr(1)) AS p FROM documents
), raw AS (
  SELECT doc_id, unnest(p) AS raw, unnest(range(len(p))) AS occurrence FROM parts
), units AS (
  SELECT doc_id, occurrence, regexp_replace(raw, '^\s+|\s+$', '', 'g') AS source, len(regexp_extract_all(regexp_replace(raw, '^\s+|\s+$', '', 'g'), '{WORD}')) AS words FROM raw
), sentences AS (SELECT * FROM units WHERE words BETWEEN 4 AND 220)"""
RUNS = r"""pieces AS (
  SELECT doc_id, regexp_extract_all(text, '[\p{L}\p{N}_]+|[^\p{L}\p{N}_]+') AS p FROM documents
), piece AS (
  SELECT doc_id, unnest(p) AS piece, unnest(range(len(p))) AS k FROM pieces
), placed AS (
  SELECT *, coalesce(sum(length(piece)) OVER (PARTITION BY doc_id ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS start FROM piece
), runs AS (
  SELECT doc_id, (k // 2)::INT AS pos, piece AS word, start, start + length(piece) AS end FROM placed WHERE regexp_matches(piece, '^[\p{L}\p{N}_]')
)"""
LINES = r"""split AS (
  SELECT doc_id, string_split(regexp_replace(text, '\r\n?', chr(10), 'g'), chr(10)) AS p FROM documents
), line AS (
  SELECT doc_id, unnest(p) AS text, unnest(range(len(p))) AS seq FROM split
), lines AS (
  SELECT *, coalesce(sum(length(text) + 1) OVER (PARTITION BY doc_id ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS start_char FROM line
)"""
LIST_MARK, TERMINAL = (x.replace("'", "''") for x in (segments.LIST_MARK, text.TERMINAL))
INTS = r"list_filter(regexp_extract_all({0}, '[\p{{L}}\p{{N}}_]+'), lambda x: regexp_full_match(x, '[0-9]+'))"


def count_sql(column: str, mark: str) -> str:
    return f"(length({column}) - length(replace({column}, {mark}, '')))"


def pairs(spark: SparkSession, sf: str) -> DataFrame:
    d = table(spark, sf, "documents")
    a = d.select(F.col("doc_id").alias("segment_id"), "lang", F.col("text").alias("source"))
    return a.join(d.select((F.col("doc_id") - 1).alias("segment_id"), F.col("text").alias("target")), "segment_id")


def turns(spark: SparkSession, sf: str) -> DataFrame:
    """Turns of a conversation with the next turn's text."""
    c = table(spark, sf, "conversations")
    w = Window.partitionBy("conv_id").orderBy("turn")
    return c.withColumn("target", F.lead("text").over(w)).withColumn("key", F.concat_ws(":", "conv_id", "turn"))


TURNS = "turns AS (SELECT *, lead(text) OVER (PARTITION BY conv_id ORDER BY turn) AS target, conv_id || ':' || turn AS key FROM conversations)"


# Scans, counts and words.


@query("SELECT count(*) AS documents, count(DISTINCT source) AS sources, count_if(lang = 'en')::BIGINT AS english, sum(length(text))::BIGINT AS chars FROM documents")
def project_summary(spark, sf):
    return table(spark, sf, "documents").agg(
        F.count("*").alias("documents"), F.countDistinct("source").alias("sources"), F.count_if(F.col("lang") == "en").alias("english"), F.sum(F.length("text")).alias("chars")
    )


@query(f"SELECT lang, count(*) AS documents, sum(len(regexp_extract_all(text, '{WORD}')))::BIGINT AS words FROM documents GROUP BY lang")
def doc_word_counts(spark, sf):
    return table(spark, sf, "documents").groupBy("lang").agg(F.count("*").alias("documents"), F.sum(text.word_count(F.col("text"))).alias("words"))


@query("SELECT doc_id, sha256(text) AS sha256, strlen(text) AS byte_size, 'objects/' || substr(sha256(text), 1, 2) || '/' || sha256(text) AS object_path FROM documents")
def content_identity(spark, sf):
    files = table(spark, sf, "documents").select(F.col("doc_id").alias("path"), F.col("text").cast("binary").alias("content"))
    return ingest.identified(files).select(F.col("path").alias("doc_id"), "sha256", "byte_size", "object_path")


@query(
    """WITH f AS (SELECT doc_id, sha256(text) AS sha256, strlen(text) AS byte_size FROM documents),
    known AS (SELECT DISTINCT sha256, byte_size, true AS hit FROM f JOIN labels USING (doc_id))
    SELECT sha256, byte_size, min(lpad(doc_id::VARCHAR, 12, '0')) AS source_name, count(*) AS copies, coalesce(any_value(hit), false) AS cache_hit
    FROM f LEFT JOIN known USING (sha256, byte_size) GROUP BY 1, 2"""
)
def dedup_import(spark, sf):
    d = table(spark, sf, "documents")
    files = ingest.identified(d.select("doc_id", F.lpad(F.col("doc_id").cast("string"), 12, "0").alias("path"), F.col("text").cast("binary").alias("content")))
    known = files.join(table(spark, sf, "labels").select("doc_id"), "doc_id", "left_semi")
    return ingest.new_imports(files, known)


@query(
    """WITH f AS (SELECT source AS root, lpad(doc_id::VARCHAR, 12, '0') AS path, strlen(text) AS byte_size, sha256(text) AS sha256 FROM documents)
    SELECT root, count(*) AS files, sum(byte_size)::BIGINT AS bytes, sha256(string_agg(path || chr(9) || byte_size || chr(9) || sha256, chr(10) ORDER BY path)) AS tree_sha256 FROM f GROUP BY root"""
)
def tree_identity(spark, sf):
    d = table(spark, sf, "documents")
    files = d.select(F.col("source").alias("root"), F.lpad(F.col("doc_id").cast("string"), 12, "0").alias("path"), F.col("text").cast("binary").alias("content"))
    return ingest.tree_identity(ingest.identified(files))


# Segments.


@query(f"WITH {SENTENCES} SELECT doc_id, occurrence::INT AS occurrence, source, words FROM sentences")
def sentence_units(spark, sf):
    return segments.sentence_units(table(spark, sf, "documents"))


@query(f"WITH {LINES} SELECT doc_id, seq::INT AS seq, start_char, start_char + length(text) AS end_char FROM lines")
def line_offsets(spark, sf):
    return segments.line_spans(table(spark, sf, "documents")).select("doc_id", "seq", "start_char", "end_char")


@query(f"WITH {LINES} SELECT doc_id, seq::INT AS seq, start_char, coalesce(lead(start_char) OVER (PARTITION BY doc_id ORDER BY seq), start_char + length(text)) AS \"end\" FROM lines")
def line_bounds(spark, sf):
    placed = segments.line_spans(table(spark, sf, "documents")).drop("text")
    return segments.closed_by_next(placed, "doc_id", "seq", "start_char", F.col("end_char")).select("doc_id", "seq", "start_char", "end")


@query(
    f"""WITH {RUNS}, g AS (SELECT doc_id, pos // 64 AS chunk, min(start) AS start, max("end") AS last, count(*) AS n_tokens FROM runs GROUP BY 1, 2)
    SELECT doc_id, chunk, start, coalesce(lead(start) OVER (PARTITION BY doc_id ORDER BY chunk), last) AS "end", n_tokens FROM g"""
)
def word_chunks_64(spark, sf):
    return segments.word_chunks(table(spark, sf, "documents"), 64)


BLOCKS = rf"""{LINES}, b AS (SELECT *, regexp_replace(text, '^\s+|\s+$', '', 'g') = '' AS blank FROM line),
    s AS (SELECT *, CASE WHEN NOT blank AND coalesce(lag(blank) OVER (PARTITION BY doc_id ORDER BY seq), true) THEN 1 ELSE 0 END AS f FROM b),
    i AS (SELECT *, sum(f) OVER (PARTITION BY doc_id ORDER BY seq) AS island FROM s),
    t AS (SELECT *, regexp_replace(text, '^\s+|\s+$', '', 'g') AS s FROM i WHERE NOT blank),
    g AS (SELECT doc_id, island, min(seq) AS first, max(seq) AS last, list(s ORDER BY seq) AS ls, median(length(s)) AS median_len, avg(length(s)) AS mean_len, stddev_pop(length(s)) AS stdev_len,
      sum(length(s)) AS total, stddev_pop(length(regexp_extract(text, '^[ \t]*'))) AS indent, avg(regexp_matches(s, '{LIST_MARK}')::INT) AS marker, avg(regexp_matches(s, '{segments.TABLEISH}')::INT) AS tableish,
      sum(len(regexp_extract_all(s, '[^\p{{L}}\p{{N}}\s]'))) AS marks FROM t GROUP BY 1, 2),
    n AS (SELECT doc_id, count(*) AS n FROM line GROUP BY 1),
    feat AS (SELECT doc_id, (island - 1)::INT AS block, ls, len(ls)::INT AS n_lines, (first - coalesce(lag(last) OVER w + 1, 0))::INT AS blank_before, (coalesce(lead(first) OVER w, n) - last - 1)::INT AS blank_after,
      median_len, mean_len, stdev_len, CASE WHEN mean_len > 0 THEN stdev_len / mean_len ELSE 0.0 END AS cv_len,
      coalesce(list_avg(list_transform(ls[1:len(ls) - 1], lambda x: regexp_matches(x, '{TERMINAL}')::INT)), 0.0) AS terminal_share,
      coalesce(list_avg(list_transform(ls[2:], lambda x: regexp_matches(x, '^["''_(\[]*[a-z]')::INT)), 0.0) AS lower_share,
      1 / (1 + indent) AS indent_stability, marker AS marker_share, CASE WHEN total > 0 THEN marks / total ELSE 0.0 END AS punctuation_density, tableish AS tableish_share,
      len(list_filter(regexp_extract_all(array_to_string(ls, ' '), '[\p{{L}}\p{{N}}_]+'), lambda x: regexp_matches(x, '\p{{L}}')))::INT AS alpha_words, total::BIGINT AS chars
    FROM g JOIN n USING (doc_id) WINDOW w AS (PARTITION BY doc_id ORDER BY island))"""
SHARES = ("mean_len", "stdev_len", "cv_len", "terminal_share", "lower_share", "indent_stability", "marker_share", "punctuation_density", "tableish_share")


@query(f"WITH {BLOCKS} SELECT doc_id, block, n_lines, blank_before, blank_after, median_len, {', '.join(f'round({c}, 6) AS {c}' for c in SHARES)}, alpha_words, chars FROM feat")
def text_blocks(spark, sf):
    found = segments.block_features(segments.blocks(table(spark, sf, "documents")))
    return found.select("doc_id", "block", "n_lines", "blank_before", "blank_after", "f.median_len", *[F.round(f"f.{c}", 6).alias(c) for c in SHARES], "f.alpha_words", "f.chars")


def _unit_sql(x: str) -> str:
    return f"greatest(0.0, least(1.0, {x}))"


def _scores_sql() -> str:
    signals = (
        _unit_sql("(median_len - 28.0) / 48.0"), _unit_sql("1.0 - least(1.0, cv_len / 0.65)"), "1.0 - terminal_share", "lower_share", "indent_stability", _unit_sql("1.0 - least(1.0, punctuation_density / 0.18)"),
    )
    wrap = " + ".join(f"{w} * ({x})" for w, x in zip(segments.HARDWRAP["balanced"], signals))
    listing = _unit_sql("0.70 * marker_share + 0.10 * least(1.0, n_lines / 4.0) + CASE WHEN median_len <= 90 THEN 0.10 ELSE 0.0 END + 0.10 * (1.0 - least(1.0, tableish_share * 2.0))")
    stanza = _unit_sql(
        f"0.38 * {_unit_sql('(78.0 - median_len) / 45.0')} + 0.22 * {_unit_sql('1.0 - least(1.0, cv_len / 0.55)')} + 0.20 * least(1.0, n_lines / 5.0) + 0.12 * terminal_share + 0.08 * (1.0 - lower_share)"
    )
    heading = _unit_sql(
        rf"""CASE WHEN regexp_matches(txt, '{segments.HEADING_WORD}') THEN 0.42 ELSE 0.0 END + CASE WHEN regexp_matches(txt, '{segments.HEADING_NUMBER}') THEN 0.28 ELSE 0.0 END
        + CASE WHEN length(txt) <= 120 AND len(ws) <= 12 THEN 0.10 ELSE 0.0 END + CASE WHEN blank_before > 0 THEN 0.06 ELSE 0.0 END + CASE WHEN blank_after > 0 THEN 0.06 ELSE 0.0 END
        + 0.12 * CASE WHEN len(regexp_extract_all(txt, '\p{{L}}')) > 0 THEN len(regexp_extract_all(txt, '\p{{Lu}}')) / len(regexp_extract_all(txt, '\p{{L}}')) ELSE 0.0 END
        + 0.08 * coalesce(list_avg(list_transform(ws, lambda w: regexp_matches(w, '^\p{{Lu}}')::INT)), 0.0)
        + CASE WHEN regexp_matches(txt, '{TERMINAL}') THEN -0.12 ELSE 0.08 END - CASE WHEN len(ws) > 16 OR length(txt) > 180 THEN 0.35 ELSE 0.0 END"""
    )
    joined = "list_reduce(list_filter(ls, lambda x: x <> ''), lambda out, x: CASE WHEN ends_with(out, chr(173)) THEN substr(out, 1, length(out) - 1) || x WHEN ends_with(out, '-') AND regexp_matches(x, '^[a-z]') THEN out || x ELSE out || ' ' || x END)"
    return rf"""txts AS (SELECT *, CASE WHEN n_lines = 1 THEN regexp_replace(ls[1], '^\s+|\s+$', '', 'g') ELSE '' END AS txt FROM feat),
    heads AS (SELECT *, list_filter(regexp_extract_all(txt, '[\p{{L}}\p{{N}}_]+'), lambda w: regexp_matches(w, '\p{{L}}')) AS ws FROM txts),
    scored AS (SELECT *, CASE WHEN n_lines >= 2 THEN {listing} ELSE 0.0 END AS list_score, CASE WHEN n_lines >= 2 AND marker_share < 0.4 AND tableish_share < 0.25 THEN {stanza} ELSE 0.0 END AS stanza_score,
      CASE WHEN n_lines = 1 AND txt <> '' THEN {heading} ELSE 0.0 END AS heading_score, CASE WHEN n_lines >= 2 AND marker_share < 0.4 AND tableish_share < 0.35 THEN {wrap} ELSE 0.0 END AS hardwrap_score FROM heads),
    kinds AS (SELECT *, CASE WHEN heading_score >= 0.5 THEN 'heading' WHEN list_score >= 0.6 THEN 'list' WHEN stanza_score >= 0.6 THEN 'stanza' WHEN hardwrap_score >= 0.55 THEN 'hardwrap' ELSE 'ambiguous' END AS kind FROM scored),
    prepared AS (SELECT *, CASE WHEN kind IN ('hardwrap', 'heading') THEN {joined} ELSE array_to_string(ls, chr(10)) END AS text FROM kinds)"""


@query(f"WITH {BLOCKS}, {_scores_sql()} SELECT doc_id, block, kind, length(text)::INT AS chars, {', '.join(f'round({k}_score, 6) AS {k}_score' for k in ('heading', 'list', 'stanza', 'hardwrap'))} FROM prepared")
def prepared_units(spark, sf):
    scored = segments.block_scores(segments.block_features(segments.blocks(table(spark, sf, "documents"))))
    return segments.prepared_units(scored).select("doc_id", "block", "kind", F.length("text").alias("chars"), *[F.round(f"{k}_score", 6).alias(f"{k}_score") for k in ("heading", "list", "stanza", "hardwrap")])


BREAKS = "a.held + x.n > 64 OR (a.at <> x.at AND (a.held >= 64 * 0.6 OR a.held + x.n > 64))"


@query(
    f"""WITH {SENTENCES}, s AS (SELECT doc_id, list(source ORDER BY occurrence) AS ts, list(words ORDER BY occurrence) AS ns, list(occurrence // 5 ORDER BY occurrence) AS ps FROM units WHERE words >= 1 GROUP BY 1),
    e AS (SELECT *, list_transform(range(1, len(ns) + 1), lambda i: {{'i': i, 'n': ns[i], 'at': ps[i], 'held': CASE WHEN i = 1 THEN ns[1] ELSE 0 END, 'cuts': CASE WHEN i = 1 THEN [1::BIGINT] ELSE []::BIGINT[] END}}) AS es FROM s),
    c AS (SELECT *, list_reduce(es, lambda a, x: {{'i': x.i, 'n': x.n, 'at': x.at, 'held': CASE WHEN {BREAKS} THEN x.n ELSE a.held + x.n END, 'cuts': CASE WHEN {BREAKS} THEN list_append(a.cuts, x.i) ELSE a.cuts END}}).cuts AS cuts FROM e),
    u AS (SELECT *, unnest(cuts) AS a, unnest(range(len(cuts))) AS seq FROM c), z AS (SELECT *, coalesce(cuts[seq + 2], len(ns) + 1) - 1 AS b FROM u)
    SELECT doc_id, seq::INT AS seq, list_sum(ns[a:b])::BIGINT AS tokens, length(array_to_string(ts[a:b], ' '))::INT AS chars, ps[a]::BIGINT AS first, ps[b]::BIGINT AS last FROM z"""
)
def packed_units(spark, sf):
    s = segments.sentence_units(table(spark, sf, "documents"), least=1, most=1 << 30)
    per = s.groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct("occurrence", F.col("source").alias("text"), F.col("words").alias("tokens")))).alias("p"))
    parts = F.transform("p", lambda x: F.struct(x["text"].alias("text"), x["tokens"].alias("tokens"), F.floor(x["occurrence"] / 5).alias("paragraph")))
    units = per.select("doc_id", F.posexplode(segments.packed_units(parts, 64)).alias("seq", "u"))
    return units.select("doc_id", "seq", F.col("u.tokens").alias("tokens"), F.length("u.text").alias("chars"), F.col("u.first").alias("first"), F.col("u.last").alias("last"))


@query(
    f"""WITH {RUNS}, k AS (SELECT *, regexp_full_match(word, '[0-9]+') AS number FROM runs WHERE lower(word) NOT IN ('and', 'or', 'to')),
    f AS (SELECT *, CASE WHEN number AND NOT coalesce(lag(number) OVER (PARTITION BY doc_id ORDER BY pos), false) THEN 1 ELSE 0 END AS s FROM k),
    i AS (SELECT *, sum(s) OVER (PARTITION BY doc_id ORDER BY pos)::BIGINT AS island FROM f)
    SELECT doc_id, island, min(start) AS first, max("end") AS last, count(*) AS n FROM i WHERE number GROUP BY 1, 2"""
)
def numeric_islands(spark, sf):
    return segments.numeric_islands(table(spark, sf, "documents"))


# Literals, gates and guards.


@query(f"SELECT doc_id, literal, count(*) AS n FROM (SELECT doc_id, unnest({INTS.format('text')}) AS literal FROM documents) GROUP BY 1, 2")
def integer_literals(spark, sf):
    return table(spark, sf, "documents").select("doc_id", F.explode(numbers.integers(F.col("text"))).alias("literal")).groupBy("doc_id", "literal").agg(F.count("*").alias("n"))


LITERAL_DIFF = f"""WITH {PAIRS}, a AS (SELECT segment_id, unnest({INTS.format("source")}) AS literal FROM pairs), b AS (SELECT segment_id, unnest({INTS.format("target")}) AS literal FROM pairs),
    d AS (SELECT * FROM a EXCEPT ALL SELECT * FROM b)"""


def literal_diff(p: DataFrame) -> DataFrame:
    """(segment_id, literal) of integers that the source has more often than the target, once for each time."""
    missing = multiset_minus(numbers.integers(F.col("source")), numbers.integers(F.col("target")))
    return p.select(*[c for c in p.columns if c not in ("source", "target")], F.explode(missing).alias("literal"))


@query(f"{LITERAL_DIFF} SELECT segment_id, literal, count(*) AS n FROM d GROUP BY 1, 2")
def literal_multiset_diff(spark, sf):
    return literal_diff(pairs(spark, sf)).groupBy("segment_id", "literal").agg(F.count("*").alias("n"))


@query(f"{LITERAL_DIFF} SELECT lang, count(*) AS missing_literals, count(DISTINCT segment_id) AS failing_pairs FROM d JOIN pairs USING (segment_id) GROUP BY lang")
def numeric_preservation_by_lang(spark, sf):
    return literal_diff(pairs(spark, sf)).groupBy("lang").agg(F.count("*").alias("missing_literals"), F.countDistinct("segment_id").alias("failing_pairs"))


def marks_sql(marks: tuple[str, ...]) -> str:
    rows = ", ".join(f"('{m}')" for m in marks)
    return f"""WITH {PAIRS}, m(mark) AS (VALUES {rows}), c AS (SELECT segment_id, mark, {count_sql("source", "mark")}::BIGINT AS n_source, {count_sql("target", "mark")}::BIGINT AS n_target FROM pairs, m)
    SELECT * FROM c WHERE n_source <> n_target"""


def marks_of(failed: DataFrame, column: str) -> DataFrame:
    rows = failed.select("segment_id", F.explode(column).alias("mark", "v"))
    return rows.select("segment_id", "mark", F.col("v.source").alias("n_source"), F.col("v.target").alias("n_target"))


@query(marks_sql(gates.SYMBOLS))
def symbol_gate(spark, sf):
    return marks_of(pairs(spark, sf).withColumn("m", gates.mismatches(gates.SYMBOLS)), "m")


@query(marks_sql(("(", ")", "[", "]", "{", "}", "?", "!")))
def punctuation_gate(spark, sf):
    return marks_of(gates.punctuation_gate(pairs(spark, sf)), "marks")


LENGTH = rf"""WITH {PAIRS}, n AS (SELECT segment_id, target, length(regexp_replace(source, '\P{{L}}', '', 'g')) AS a, length(regexp_replace(target, '\P{{L}}', '', 'g')) AS b FROM pairs),
    r AS (SELECT *, CASE WHEN a > 0 THEN b / a WHEN b = 0 THEN 1.0 ELSE 'inf'::DOUBLE END AS ratio FROM n),
    length_fail AS (SELECT segment_id, a AS source_letters, b AS target_letters, ratio FROM r WHERE trim(target) = '' OR ratio < 0.15 OR ratio > 6.0)"""


@query(f"{LENGTH} SELECT segment_id, source_letters, target_letters, round(ratio, 9) AS ratio FROM length_fail")
def length_ratio_gate(spark, sf):
    return gates.length_gate(pairs(spark, sf)).select("segment_id", "source_letters", "target_letters", F.round("ratio", 9).alias("ratio"))


MARK_FAIL = "mark_fail AS (SELECT DISTINCT segment_id FROM pairs, (VALUES ('('), (')'), ('['), (']'), ('{'), ('}'), ('?'), ('!')) m(mark) WHERE " + f"{count_sql('source', 'mark')} <> {count_sql('target', 'mark')})"


def literals_sql(column: str) -> str:
    """Normalised literals of a text. RE2 cannot look around, so each sign is doubled first and literals do not share one."""
    w = r"\p{L}\p{N}\p{M}_"
    doubled = rf"regexp_replace({column}, '([^{w}])', '\1\1', 'g')"
    raw = rf"regexp_extract_all({doubled}, '(?:^|[^{w}])((?:\+\+|--)?\p{{Nd}}+(?:(?:\.\.|,,|''''|’’)\p{{Nd}}+)?(?://\p{{Nd}}+)?)(?:[^{w}]|$)', 1)"
    single = "x"
    for c in ("+", "-", ".", ",", "''", "’", "/"):
        single = f"replace({single}, '{c}{c}', '{c}')"
    dots = f"translate({single}, '’'',', '...')"

    def plain(part: str) -> str:
        body = f"regexp_replace({part}, '^[+-]', '')"
        whole, rest = f"ltrim(split_part({body}, '.', 1), '0')", rf"rtrim(regexp_replace({body}, '^[^.]*\.?', ''), '0')"
        return f"(regexp_extract({part}, '^[+-]') || CASE WHEN {whole} = '' THEN '0' ELSE {whole} END || CASE WHEN {rest} <> '' THEN '.' || {rest} ELSE '' END)"

    fraction = f"{plain(f"split_part({dots}, '/', 1)")} || '/' || {plain(f"split_part({dots}, '/', 2)")}"
    return f"list_transform({raw}, lambda x: CASE WHEN contains({dots}, '/') THEN {fraction} ELSE {plain(dots)} END)"


def _numeric_sql() -> str:
    names, values = "[" + ", ".join(f"'{w}'" for w in numbers.NUMBER_WORDS) + "]", str(list(numbers.NUMBER_WORDS.values()))
    differ = {m: f"{count_sql('source', repr(m))} <> {count_sql('target', repr(m))}" for m in gates.SYMBOLS}
    symbols = ", ".join(f"CASE WHEN {test} THEN '{m}' END" for m, test in differ.items())
    return rf"""lits AS (SELECT segment_id, {literals_sql("source")} AS a, {literals_sql("target")} AS b,
      list_transform(regexp_extract_all(lower(source), '[a-z]+'), lambda w: list_extract({values}, list_position({names}, w))) AS v,
      array_to_string(list_filter([{symbols}], lambda m: m IS NOT NULL), ',') AS symbols FROM pairs),
    ok AS (SELECT segment_id, list_transform(range(1, len(v) + 1), lambda i: CASE WHEN v[i] >= 20 AND v[i + 1] < 10 THEN v[i] + v[i + 1] ELSE v[i] END) AS ok FROM lits),
    lit_a AS (SELECT segment_id, unnest(a) AS x FROM lits), lit_b AS (SELECT segment_id, unnest(b) AS x FROM lits),
    lit_missing AS (SELECT segment_id, string_agg(x, ',' ORDER BY x) AS missing FROM (SELECT * FROM lit_a EXCEPT ALL SELECT * FROM lit_b) GROUP BY 1),
    lit_extra AS (SELECT segment_id, string_agg(x, ',' ORDER BY x) AS unlicensed FROM (SELECT * FROM lit_b EXCEPT ALL SELECT * FROM lit_a) JOIN ok USING (segment_id)
      WHERE NOT coalesce(list_contains(list_transform(ok, lambda n: n::VARCHAR), x), false) GROUP BY 1),
    numeric_fail AS (SELECT segment_id, coalesce(missing, '') AS missing, coalesce(unlicensed, '') AS unlicensed, symbols
      FROM lits LEFT JOIN lit_missing USING (segment_id) LEFT JOIN lit_extra USING (segment_id) WHERE missing IS NOT NULL OR unlicensed IS NOT NULL OR symbols <> '')"""


NUMERIC = _numeric_sql()
THREE = f"{LENGTH}, {MARK_FAIL}, {NUMERIC}"


@query(
    f"""{THREE}, f AS (SELECT 'numeric' AS gate, segment_id FROM numeric_fail UNION ALL SELECT 'punctuation', segment_id FROM mark_fail UNION ALL SELECT 'length', segment_id FROM length_fail)
    SELECT gate, count(segment_id) AS failure_count, count(segment_id) = 0 AS passed, sha256(coalesce(string_agg(segment_id::VARCHAR, chr(10) ORDER BY segment_id::VARCHAR), '')) AS issues_sha256
    FROM (VALUES ('numeric'), ('punctuation'), ('length')) g(gate) LEFT JOIN f USING (gate) GROUP BY gate"""
)
def gate_summary(spark, sf):
    return gates.summary(pairs(spark, sf), digest=True)


@query(f"{THREE} SELECT segment_id FROM pairs WHERE segment_id NOT IN (SELECT segment_id FROM numeric_fail UNION ALL SELECT segment_id FROM mark_fail UNION ALL SELECT segment_id FROM length_fail)")
def approved_pairs(spark, sf):
    return gates.approved(pairs(spark, sf)).select("segment_id")


@query(f"WITH {PAIRS}, {NUMERIC} SELECT * FROM numeric_fail")
def numeric_gate_full(spark, sf):
    out = gates.numeric_gate(pairs(spark, sf))
    return out.select("segment_id", F.array_join("missing", ",").alias("missing"), F.array_join("unlicensed", ",").alias("unlicensed"), F.array_join(F.map_keys("symbols"), ",").alias("symbols"))


def explicit_sql(column: str) -> str:
    """Values of the explicit grammar. Each match takes the character after it along, which no other needs; so RE2 need not look ahead."""
    body = numbers.EXPLICIT.replace("(?iU)", "(?i)").replace(r"(?<!\d)", "").replace(r"(?!\d)", r"(?:\D|$)")
    return rf"list_transform(regexp_extract_all({column}, '{body}', 1), lambda x: regexp_replace(regexp_replace(lower(x), '(?:st|nd|rd|th)$', ''), '[\s,  ]', '', 'g'))"


SPELLED = "list_filter(list_transform(regexp_extract_all(lower(source), '[\\p{{L}}\\p{{N}}_]+'), lambda w: list_extract({values}, list_position({names}, w))::VARCHAR), lambda v: v IS NOT NULL)".format(
    values=str(list(numbers.NUMBER_WORDS.values())), names=str(list(numbers.NUMBER_WORDS))
)
EXPLICIT = f"""x AS (SELECT segment_id, {explicit_sql("source")} AS req, {explicit_sql("target")} AS obs, {SPELLED} AS spelled FROM pairs),
    x_req AS (SELECT segment_id, unnest(req) AS v FROM x), x_obs AS (SELECT segment_id, unnest(obs) AS v FROM x), x_all AS (SELECT segment_id, unnest(list_concat(req, spelled)) AS v FROM x),
    x_missing AS (SELECT segment_id, string_agg(v, ',' ORDER BY v) AS missing FROM (SELECT * FROM x_req EXCEPT ALL SELECT * FROM x_obs) GROUP BY 1),
    x_over AS (SELECT o.segment_id, string_agg(v, ',' ORDER BY v) FILTER (list_contains(req, v)) AS twice, string_agg(v, ',' ORDER BY v) FILTER (NOT list_contains(req, v)) AS extra
      FROM (SELECT * FROM x_obs EXCEPT ALL SELECT * FROM x_all) o JOIN x ON x.segment_id = o.segment_id GROUP BY 1),
    guard AS (SELECT segment_id, coalesce(missing, '') AS missing, coalesce(twice, '') AS duplicate_required, coalesce(extra, '') AS unlicensed, missing IS NULL AND twice IS NULL AS numeric_passed,
      list_reduce(list_prepend('0', obs), lambda j, v: CASE WHEN v = req[j::INT + 1] THEN (j::INT + 1)::VARCHAR ELSE j END)::INT = len(req) AS in_order
      FROM x LEFT JOIN x_missing USING (segment_id) LEFT JOIN x_over USING (segment_id))"""


@query(f"WITH {PAIRS}, {EXPLICIT} SELECT segment_id, missing, duplicate_required, unlicensed, numeric_passed AND unlicensed = '' AS passed, in_order FROM guard")
def explicit_numeric_guard(spark, sf):
    s, t = F.col("source"), F.col("target")
    g = held(pairs(spark, sf), g=gates.strict_numeric_guard(s, t), in_order=gates.numeric_order(s, t))
    return g.select("segment_id", *[F.array_join(f"g.{c}", ",").alias(c) for c in ("missing", "duplicate_required", "unlicensed")], "g.passed", "in_order")


def _delimiter_sql() -> str:
    out = []
    for left, right in (("[", "]"), ("(", ")")):
        a, b, c, d = (count_sql(col, f"'{m}'") for col, m in (("source", left), ("source", right), ("target", left), ("target", right)))
        out.append(f"(CASE WHEN {a} = {b} THEN {a} = {c} AND {b} = {d} ELSE {c} = {d} END)")
    return " AND ".join(out)


@query(f"WITH {PAIRS} SELECT segment_id, {_delimiter_sql()} AS passed FROM pairs")
def delimiter_guard(spark, sf):
    return pairs(spark, sf).select("segment_id", gates.delimiters(F.col("source"), F.col("target")).alias("passed"))


@query(
    rf"""WITH d AS (SELECT doc_id, regexp_replace(text, '\[[^\[\]]*\]|_[^_]*_', ' ', 'g') AS t FROM documents),
    n AS (SELECT doc_id, len(regexp_extract_all(t, '[A-Za-z]')) AS latin, len(regexp_extract_all(t, '\p{{L}}')) AS letters FROM d)
    SELECT doc_id, round(CASE WHEN letters > 0 THEN latin / letters ELSE 0.0 END, 9) AS share FROM n"""
)
def protected_share(spark, sf):
    return table(spark, sf, "documents").select("doc_id", F.round(gates.protected_share(F.col("text"), "[A-Za-z]", r"\p{L}"), 9).alias("share"))


@query(
    rf"""WITH {PAIRS}, q AS (SELECT *, len(regexp_extract_all(target, '{WORD}')) / greatest(len(regexp_extract_all(source, '{WORD}')), 1) AS ratio,
      len(regexp_extract_all(target, '[A-Za-z]')) AS latin, len(regexp_extract_all(target, '\p{{L}}')) AS letters FROM pairs),
    r AS (SELECT segment_id, list_filter([CASE WHEN trim(target) = '' THEN 'empty' END, CASE WHEN ratio < 0.15 OR ratio > 3 THEN 'length_anomaly' END,
      CASE WHEN lower(trim(source)) = lower(trim(target)) THEN 'identity' END, CASE WHEN letters > 0 AND latin / letters < 0.9 THEN 'low_script_share' END,
      CASE WHEN NOT ({_delimiter_sql()}) THEN 'delimiters' END], lambda x: x IS NOT NULL) AS reasons FROM q)
    SELECT segment_id, array_to_string(reasons, ',') AS reasons FROM r WHERE len(reasons) > 0"""
)
def reason_arrays(spark, sf):
    s, t = F.col("source"), F.col("target")
    judged = held(pairs(spark, sf), _q=gates.quality(s, t, "[A-Za-z]", r"\p{L}"))
    q = F.col("_q")
    named = judged.select(
        "segment_id",
        reasons(
            ("empty", q["empty"]), ("length_anomaly", q["length_anomaly"]), ("identity", q["identity"]),
            ("low_script_share", (text.letter_count(t) > 0) & (q["script_share"] < 0.9)), ("delimiters", ~gates.delimiters(s, t)),
        ).alias("r"),
    )
    return named.filter(F.size("r") > 0).select("segment_id", F.array_join("r", ",").alias("reasons"))


def payload_sql(column: str, pattern: str, group: int = 1) -> str:
    return rf"list_transform(regexp_extract_all({column}, '{pattern.replace('(?iu)', '(?i)')}', {group}), lambda x: trim(x))"


def _tokens_sql() -> str:
    atom = r"(?:\d+[A-Za-z]|[A-Za-z]\d+)"
    emphasis = rf"list_filter({payload_sql('{0}', gates.EMPHASIS).replace('{1,80}', '{{1,80}}')}, lambda x: regexp_matches(x, '^[A-Za-z]{{{{1,3}}}}$') OR regexp_matches(x, '^{atom}(?:\s+{atom})*$'))"
    pairs_of = [(gates.GREEK, gates.GREEK_TARGET, 1), (gates.COMBINED, gates.COMBINED_TARGET, 1), (gates.COMBINED, gates.COMBINED_TARGET, 2), (gates.FOOTNOTE, gates.FOOTNOTE, 1), (gates.ILLUSTRATION, gates.ILLUSTRATION_TARGET, 1)]
    tests = [f"{payload_sql('source', a, n)} <> {payload_sql('target', b, n)}" for a, b, n in pairs_of]
    return " OR ".join([*tests, f"{emphasis.format('source')} <> {emphasis.format('target')}"])


BARE = r"regexp_replace({0}, '\[[^\[\]]*\]|_[^_]*_', ' ', 'g')"


def _quality_sql() -> str:
    def of(c: str, p: str) -> str:
        return f"""trim({c}) = '' AS {p}empty, len(regexp_extract_all({c}, '{WORD}')) / greatest(len(regexp_extract_all(source, '{WORD}')), 1) AS {p}ratio, lower(trim(source)) = lower(trim({c})) AS {p}identity,
      CASE WHEN len(regexp_extract_all({c}, '\\p{{L}}')) > 0 THEN len(regexp_extract_all({c}, '[A-Za-z]')) / len(regexp_extract_all({c}, '\\p{{L}}')) ELSE 0.0 END AS {p}share,
      len(list_filter(regexp_extract_all(source, '{gates.FIGURE}', 1), lambda n: NOT list_contains(regexp_extract_all({c}, '\\d+'), n))) = 0 AS {p}figures"""

    def residue(c: str) -> str:
        own = "list_transform(regexp_extract_all(source, '[A-Za-z]{4,}'), lambda w: lower(w))"
        return f"len(list_filter(regexp_extract_all({BARE.format(c)}, '[A-Za-z]{{4,}}'), lambda w: list_contains({own}, lower(w))))"

    return f"""q AS (SELECT p.segment_id, {of("target", "c_")}, {of("source", "b_")}, numeric_passed, in_order, NOT ({_delimiter_sql()}) AS delimiters, {_tokens_sql()} AS tokens, {residue("target")} > {residue("source")} AS residue
      FROM pairs p JOIN guard g ON g.segment_id = p.segment_id)"""


def odd(ratio: str) -> str:
    return f"({ratio} < 0.15 OR {ratio} > 3)"


REASONS = {
    "empty": "c_empty", "new_length_anomaly": f"{odd('c_ratio')} AND NOT {odd('b_ratio')}", "new_identity": "c_identity AND NOT b_identity", "numeric_integrity": "NOT numeric_passed", "figure_integrity": "NOT c_figures",
    "script_share_regression": "c_share < b_share - 0.08", "low_script_share": "c_share < 0.6 AND b_share >= 0.6", "explicit_numeric_order": "NOT in_order", "balanced_delimiter_integrity": "delimiters",
    "critical_technical_tokens": "tokens", "new_latin_residue": "residue",
}
QUALITY = f"WITH {PAIRS}, {EXPLICIT}, {_quality_sql()}"


@query(
    f"""{QUALITY}, r AS (SELECT segment_id, array_to_string(list_filter([{", ".join(f"CASE WHEN {test} THEN '{name}' END" for name, test in REASONS.items())}], lambda x: x IS NOT NULL), ',') AS reasons FROM q)
    SELECT * FROM r WHERE reasons <> ''"""
)
def intervention_gate(spark, sf):
    s, t = F.col("source"), F.col("target")
    p = held(pairs(spark, sf), reasons=gates.strong_reasons(s, s, t, script="[A-Za-z]", alphabet=r"\p{L}"))
    return p.filter(F.size("reasons") > 0).select("segment_id", F.array_join("reasons", ",").alias("reasons"))


@query(
    f"""{QUALITY} SELECT count(*) AS units, count_if(c_empty)::BIGINT AS empty, count_if({odd("c_ratio")})::BIGINT AS length_anomalies, count_if(c_identity)::BIGINT AS identities, count_if(NOT numeric_passed)::BIGINT AS numeric_failures,
      count_if(NOT c_figures)::BIGINT AS figure_failures, round(avg(CASE WHEN NOT c_empty THEN c_share END), 9) AS mean_script_share FROM q"""
)
def quality_totals(spark, sf):
    rows = held(pairs(spark, sf), quality=gates.quality(F.col("source"), F.col("target"), "[A-Za-z]", r"\p{L}"))
    return gates.quality_totals(rows).withColumn("mean_script_share", F.round("mean_script_share", 9))


# Sampling.

CATEGORY = f"CASE WHEN len({INTS.format('source')}) >= 4 THEN 'numeric_dense' WHEN len({INTS.format('source')}) > 0 THEN 'numeric' ELSE 'general' END"
QUOTAS = {"numeric_dense": 600, "numeric": 2_400, "general": 1_200}


def categorised(spark: SparkSession, sf: str) -> DataFrame:
    u = held(segments.sentence_units(table(spark, sf, "documents")), n=F.size(numbers.integers(F.col("source"))))
    n = F.col("n")
    return u.withColumn("category", F.when(n >= 4, "numeric_dense").when(n > 0, "numeric").otherwise("general")).withColumn("uid", F.concat_ws(":", "doc_id", "occurrence")).drop("n")


@query(f"WITH {SENTENCES} SELECT {CATEGORY} AS category, count(*) AS units, sum(words)::BIGINT AS words FROM sentences GROUP BY 1")
def category_totals(spark, sf):
    return categorised(spark, sf).groupBy("category").agg(F.count("*").alias("units"), F.sum("words").alias("words"))


@query(
    f"""WITH {SENTENCES}, u AS (SELECT doc_id || ':' || occurrence AS uid, {CATEGORY} AS category, source, words FROM sentences),
    k AS (SELECT *, sha256('selection-' || category || chr(0) || uid || chr(0) || source) AS r FROM u),
    w AS (SELECT *, coalesce(sum(words) OVER (PARTITION BY category ORDER BY r ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM k),
    q AS (SELECT uid, category, words FROM w WHERE before < CASE category WHEN 'numeric_dense' THEN 600 WHEN 'numeric' THEN 2400 ELSE 1200 END),
    f AS (SELECT *, sha256('selection-fill' || chr(0) || uid || chr(0) || source) AS r2 FROM u WHERE uid NOT IN (SELECT uid FROM q)),
    g AS (SELECT *, coalesce(sum(words) OVER (ORDER BY r2 ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM f)
    SELECT uid, category, words, 'quota' AS reason FROM q UNION ALL
    SELECT uid, category, words, 'fill' FROM g WHERE before < 5000 - (SELECT coalesce(sum(words), 0) FROM q)"""
)
def challenge_selection(spark, sf):
    return sampling.quota_selection(categorised(spark, sf), QUOTAS, 5_000)


PLACED = "placed AS (SELECT doc_id, lang, row_number() OVER (PARTITION BY lang ORDER BY doc_id) - 1 AS i, count(*) OVER (PARTITION BY lang) AS n FROM documents)"


def placed(spark: SparkSession, sf: str) -> DataFrame:
    return sampling.range_positions(table(spark, sf, "documents").select("doc_id", "lang"), "lang", ["doc_id"])


@query(
    f"""WITH {PLACED}, b AS (SELECT *, unnest(range(least(8, n))) AS bucket FROM placed), c AS (SELECT *, bucket * n // least(8, n) AS s, (bucket + 1) * n // least(8, n) AS e FROM b)
    SELECT doc_id, lang, bucket::INT AS bucket FROM c WHERE e > s AND i = s + (e - s - 1) // 2"""
)
def bucket_centres(spark, sf):
    return sampling.bucket_centres(placed(spark, sf)).select("doc_id", "lang", F.col("bucket").cast("int").alias("bucket"))


@query(f"WITH {PLACED}, p AS (SELECT DISTINCT lang, floor((j + 0.5) * n / least(20, n))::BIGINT AS at FROM placed, range(20) t(j) WHERE j < least(20, n)) SELECT doc_id, placed.lang FROM placed JOIN p ON p.lang = placed.lang AND p.at = i")
def even_spread(spark, sf):
    return sampling.spread(placed(spark, sf), 20).select("doc_id", "lang")


@query(
    f"""WITH RECURSIVE {PLACED}, h AS (
      SELECT lang, 0::BIGINT AS a, count(*) AS b, 0 AS depth FROM documents GROUP BY lang
      UNION ALL
      SELECT lang, c.a, c.b, depth + 1 FROM (SELECT lang, depth, unnest([{{'a': a, 'b': a + (b - a - 1) // 2}}, {{'a': a + (b - a - 1) // 2 + 1, 'b': b}}]) AS c FROM h) WHERE c.b > c.a
    ) SELECT doc_id, placed.lang, depth FROM placed JOIN h ON h.lang = placed.lang AND i = a + (b - a - 1) // 2"""
)
def midpoint_order(spark, sf):
    return sampling.midpoint_rank(placed(spark, sf)).select("doc_id", "lang", "depth")


@query(f"WITH {PLACED} SELECT doc_id, lang, (i % 8)::INT AS shard FROM placed")
def position_shards(spark, sf):
    return sampling.shards(table(spark, sf, "documents").select("doc_id", "lang"), ["doc_id"], 8, "lang").select("doc_id", "lang", F.col("shard").cast("int").alias("shard"))


@query(
    """WITH placed AS (SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS i, count(*) OVER () AS n FROM documents), w AS (SELECT *, unnest([0.1, 0.3, 0.5, 0.7, 0.9]) AS f FROM placed)
    SELECT doc_id, f::DOUBLE AS "window" FROM w WHERE i >= greatest(0, floor(n * f) - 12) AND i < least(n, floor(n * f) + 13) ORDER BY f, i LIMIT 120"""
)
def window_sample(spark, sf):
    d = table(spark, sf, "documents").select("doc_id", F.lit(0).alias("all"))
    return sampling.window_sample(sampling.range_positions(d, "all", ["doc_id"])).select("doc_id", "window")


@query(f"WITH {SENTENCES} SELECT doc_id, occurrence::INT AS occurrence, words FROM sentences WHERE words >= 24 ORDER BY words DESC, doc_id, occurrence LIMIT 8")
def top_long_units(spark, sf):
    u = segments.sentence_units(table(spark, sf, "documents"))
    return u.filter("words >= 24").orderBy(F.desc("words"), "doc_id", "occurrence").limit(8).select("doc_id", "occurrence", "words")


@query("SELECT doc_id, source FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def anti_selected(spark, sf):
    return table(spark, sf, "documents").join(table(spark, sf, "labels"), "doc_id", "left_anti").select("doc_id", "source")


# Joins.


@query(f"""WITH {RUNS}, {LINES} SELECT l.doc_id, l.seq::INT AS seg, count(*) AS tokens FROM runs r JOIN lines l ON l.doc_id = r.doc_id AND l.start_char <= r.start AND l.start_char + length(l.text) >= r."end" GROUP BY 1, 2""")
def token_in_line(spark, sf):
    d = table(spark, sf, "documents")
    outer = segments.line_spans(d).select("doc_id", F.col("seq").alias("seg"), F.col("start_char").alias("seg_start"), F.col("end_char").alias("seg_end"))
    inside = joins.contained(segments.word_runs(d).drop("word"), outer)
    return inside.groupBy("doc_id", "seg").agg(F.count("*").alias("tokens"))


@query(
    """SELECT CASE WHEN l.doc_id IS NULL THEN 'left_only' WHEN d.doc_id IS NULL THEN 'right_only' WHEN d.v = l.quality THEN 'equal' ELSE 'mismatch' END AS state, count(*) AS n
    FROM (SELECT doc_id, (n_chars % 2)::INT AS v FROM documents) d FULL JOIN labels l ON l.doc_id = d.doc_id GROUP BY 1"""
)
def parity_full_outer(spark, sf):
    a = table(spark, sf, "documents").select("doc_id", (F.col("n_chars") % 2).cast("int").alias("v"))
    b = table(spark, sf, "labels").select("doc_id", F.col("quality").alias("v"))
    return joins.parity(a, b, "doc_id", "v").groupBy("state").agg(F.count("*").alias("n"))


@query(
    """WITH m AS (SELECT l_partkey AS k, count(*) AS n, min(l_linenumber) AS b, min(l_returnflag) AS h FROM lineitem GROUP BY 1),
    j AS (SELECT coalesce(k, p_partkey) AS k, CASE WHEN n IS NULL THEN 'missing' WHEN p_partkey IS NULL THEN 'unrecorded' WHEN n > 1 THEN 'duplicate' WHEN b <> p_size THEN 'size_mismatch' WHEN h <> 'N' THEN 'hash_mismatch' END AS problem
      FROM m FULL JOIN part ON p_partkey = k)
    SELECT problem, count(*) AS n FROM j WHERE problem IS NOT NULL GROUP BY 1"""
)
def manifest_check(spark, sf):
    want = table(spark, sf, "part").select(F.col("p_partkey").alias("path"), F.col("p_size").alias("bytes"), F.lit("N").alias("sha256"))
    have = table(spark, sf, "lineitem").select(F.col("l_partkey").alias("path"), F.col("l_linenumber").alias("bytes"), F.col("l_returnflag").alias("sha256"))
    return joins.manifest_check(want, have).groupBy("problem").agg(F.count("*").alias("n"))


@query(
    """WITH c AS (SELECT doc_id, sha256(lang) AS v FROM documents JOIN labels USING (doc_id)), t AS (SELECT doc_id, sha256(CASE WHEN toxic = 1 THEN 'x' ELSE 'en' END) AS w FROM labels WHERE quality = 1)
    SELECT CASE WHEN v IS NULL THEN 'unavailable' WHEN w IS NULL THEN 'add' WHEN v = w THEN 'same' ELSE 'replace' END AS action, count(*) AS n FROM documents LEFT JOIN c USING (doc_id) LEFT JOIN t USING (doc_id) GROUP BY 1"""
)
def overlay_plan(spark, sf):
    d, lab = table(spark, sf, "documents"), table(spark, sf, "labels")
    c = d.join(lab.select("doc_id"), "doc_id").select("doc_id", F.sha2("lang", 256).alias("sha256"))
    t = lab.filter("quality = 1").select("doc_id", F.sha2(F.when(F.col("toxic") == 1, "x").otherwise("en"), 256).alias("sha256"))
    return joins.overlay_plan(d, c, t, "doc_id").groupBy("action").agg(F.count("*").alias("n"))


@query("SELECT user_id, max(event_id) AS event_id, arg_max(event_type, event_id) AS event_type FROM events GROUP BY 1")
def latest_per_key(spark, sf):
    return joins.latest(table(spark, sf, "events").select("user_id", "event_id", "event_type"), "user_id", "event_id")


@query("SELECT o_custkey, min(o_orderstatus) AS o_orderstatus FROM orders GROUP BY 1 HAVING min(o_orderstatus) = max(o_orderstatus)")
def resolved_values(spark, sf):
    return joins.resolved(table(spark, sf, "orders"), "o_custkey", "o_orderstatus")


@query("WITH g(pattern) AS (VALUES ('https://blog.*'), ('http://*/fr/*'), ('*example.or?/*')) SELECT pattern, count(*) AS n FROM pages JOIN g ON url GLOB pattern GROUP BY 1")
def glob_match(spark, sf):
    rules = spark.createDataFrame([("https://blog.*",), ("http://*/fr/*",), ("*example.or?/*",)], "pattern string")
    return joins.glob_join(table(spark, sf, "pages").select("url"), rules, "url").groupBy("pattern").agg(F.count("*").alias("n"))


# Lexical grouping.

WORDS = rf"""{TURNS}, w AS (SELECT conv_id, turn, target, regexp_extract_all(text, '[\p{{L}}\p{{N}}_]+') AS ws FROM turns WHERE target IS NOT NULL),
    o AS (SELECT conv_id, turn, target, unnest(ws) AS surface, unnest(range(len(ws))) AS pos_index FROM w),
    e AS (SELECT *, lower(surface) AS lemma, lower(regexp_replace(regexp_replace(target, '\s+', ' ', 'g'), '^\s+|\s+$', '', 'g')) AS target_key FROM o WHERE regexp_matches(surface, '\p{{L}}'))"""


def words_of_turns(spark: SparkSession, sf: str) -> DataFrame:
    t = held(turns(spark, sf).filter("target is not null"), target_key=text.fold(F.col("target")))
    o = t.select("conv_id", "turn", "target_key", F.posexplode(F.regexp_extract_all("text", F.lit(text.RUN), F.lit(0))).alias("pos_index", "surface"))
    return o.filter(F.col("surface").rlike(r"\p{L}")).withColumn("lemma", F.lower("surface"))


@query(
    f"""WITH {WORDS} SELECT lemma, target_key, count(*) AS occurrence_count,
    sha256(lemma || chr(10) || target_key || chr(10) || string_agg(conv_id || ':' || turn || ':' || pos_index, ',' ORDER BY conv_id, turn, pos_index)) AS sense_key FROM e GROUP BY 1, 2"""
)
def sense_groups(spark, sf):
    found = lexical.senses(words_of_turns(spark, sf), ["lemma"], "target", ["conv_id", "turn", "pos_index"])
    return found.select("lemma", "target_key", "occurrence_count", "sense_key")


@query(f"WITH {WORDS}, g AS (SELECT lemma, count(DISTINCT target_key) AS n, count(*) AS o FROM e GROUP BY 1) SELECT count(*) AS entries, sum(n)::BIGINT AS senses, sum(o)::BIGINT AS occurrences, max(n) AS most_senses FROM g")
def sense_summary(spark, sf):
    return lexical.sense_summary(lexical.senses(words_of_turns(spark, sf), ["lemma"], "target", ["conv_id", "turn", "pos_index"]), ["lemma"])


@query(f"WITH {WORDS} SELECT lemma, arg_min(surface, (conv_id, turn, pos_index)) AS display FROM e GROUP BY 1")
def lexical_entries(spark, sf):
    rows = words_of_turns(spark, sf).withColumn("_o", F.struct("conv_id", "turn", "pos_index"))
    none = spark.createDataFrame([], "id long, lemma string, display string")
    return joins.get_or_create(rows, none, ["lemma"], "surface", "_o").select("lemma", "display")


# Similarity.


def turn_pairs(spark: SparkSession, sf: str) -> DataFrame:
    return turns(spark, sf).filter("target is not null").select("key", F.col("text").alias("source"), "target")


PLAIN = r"trim(regexp_replace(regexp_replace(replace({0}, '_', ' '), '[\[\](){{}}]', ' ', 'g'), '\s+', ' ', 'g'))"
BAG = "SELECT key, n_a, n_b, common FROM s"


def overlap_sql(a: str, b: str, name: str) -> str:
    return f"""WITH {TURNS}, p AS (SELECT key, lower({PLAIN.format("text")}) AS a, lower({PLAIN.format("target")}) AS b FROM turns WHERE target IS NOT NULL),
    x AS (SELECT key, {a} AS va, {b} AS vb FROM p),
    c AS (SELECT key, v, sum(ca) AS ca, sum(cb) AS cb FROM (SELECT key, unnest(va) AS v, 1 AS ca, 0 AS cb FROM x UNION ALL SELECT key, unnest(vb), 0, 1 FROM x) GROUP BY 1, 2),
    s AS (SELECT key, sum(ca) AS na, sum(cb) AS nb, sum(least(ca, cb)) AS m FROM c GROUP BY 1)
    SELECT key, round(CASE WHEN coalesce(na + nb, 0) = 0 THEN 1.0 ELSE 2 * m / (na + nb) END, 9) AS {name} FROM x LEFT JOIN s USING (key)"""


TRIGRAMS = "(CASE WHEN length({0}) >= 3 THEN list_transform(range(1, length({0}) - 1), lambda i: substr({0}, i, 3)) WHEN length({0}) > 0 THEN [{0}] ELSE [] END)"


@query(overlap_sql(TRIGRAMS.format("a"), TRIGRAMS.format("b"), "char3_dice"))
def trigram_dice(spark, sf):
    return similarity.dice(turn_pairs(spark, sf), "key").select("key", F.round("char3_dice", 9).alias("char3_dice"))


@query(overlap_sql(r"regexp_extract_all(a, '[\p{L}\p{N}_]+')", r"regexp_extract_all(b, '[\p{L}\p{N}_]+')", "token_f1"))
def token_f1(spark, sf):
    return similarity.token_f1(turn_pairs(spark, sf), "key").select("key", F.round("token_f1", 9).alias("token_f1"))


def _chrf_sql() -> str:
    def split(c: str) -> str:
        flat = rf"trim(regexp_replace({c}, '\s+', ' ', 'g'))"
        spaced = rf"regexp_replace(regexp_replace({flat}, '(\S)([[:punct:]])(\s|$)', '\1 \2\3', 'g'), '(^|\s)([[:punct:]])(\S)', '\1\2 \3', 'g')"
        return f"list_filter(string_split({spaced}, ' '), lambda w: w <> '')"

    rows = []
    for kind, most in (("c", 6), ("w", 2)):
        for n in range(1, most + 1):
            for side in "ab":
                c = kind + side
                cut = f"substr({c}, i, {n})" if kind == "c" else f"array_to_string({c}[i:i + {n - 1}], ' ')"
                size = f"length({c})" if kind == "c" else f"len({c})"
                grams = f"list_transform(range(1, greatest({size} - {n - 1}, 0) + 1), lambda i: {cut})"
                rows.append(f"SELECT key, '{kind}{n}' AS o, unnest({grams}) AS v, {int(side == 'a')} AS na, {int(side == 'b')} AS nb FROM x")
    return rf"""x AS (SELECT key, regexp_replace(text, '\s+', '', 'g') AS ca, regexp_replace(target, '\s+', '', 'g') AS cb, {split("text")} AS wa, {split("target")} AS wb FROM turns WHERE target IS NOT NULL),
    bag AS (SELECT key, o, v, sum(na) AS na, sum(nb) AS nb FROM ({" UNION ALL ".join(rows)}) GROUP BY 1, 2, 3),
    per AS (SELECT key, o, sum(least(na, nb)) AS m, sum(na) AS na, sum(nb) AS nb FROM bag GROUP BY 1, 2),
    pr AS (SELECT key, avg(m / nb) AS p, avg(m / na) AS r FROM per WHERE na > 0 AND nb > 0 GROUP BY 1),
    chrf AS (SELECT key, CASE WHEN 4 * p + r > 0 THEN 100 * 5 * p * r / (4 * p + r) ELSE 0.0 END AS chrf FROM pr)"""


@query(f"WITH {TURNS}, {_chrf_sql()} SELECT key, round(coalesce(chrf, 0.0), 6) AS chrf FROM x LEFT JOIN chrf USING (key)")
def similarity_composite(spark, sf):
    return similarity.composite(turn_pairs(spark, sf), "key").select("key", F.round("chrf", 6).alias("chrf"))


@query()
def mixed_case_stems(spark, sf):
    return similarity.mixed_case_stems(table(spark, sf, "documents"), "doc_id")


@query(
    f"""WITH {PAIRS}, d AS (SELECT len(regexp_extract_all(target, '{WORD}')) - len(regexp_extract_all(source, '{WORD}')) AS d FROM pairs)
    SELECT round(avg(d), 9) AS mean, min(d) AS least, max(d) AS largest, count_if(d > 0)::BIGINT AS better, count_if(d < 0)::BIGINT AS worse, count_if(d = 0)::BIGINT AS ties FROM d"""
)
def delta_summary(spark, sf):
    d = pairs(spark, sf).select((text.word_count(F.col("target")) - text.word_count(F.col("source"))).alias("delta"))
    return similarity.delta_summary(d).withColumn("mean", F.round("mean", 9))


# Ledger, events, search.


JOURNAL = """raw AS (SELECT event_id AS pos, event_type || ' ' || user_id AS body FROM events),
    first AS (SELECT pos, body, sha256(chr(10) || body) AS own FROM raw),
    j AS (SELECT a.pos, CASE WHEN a.pos % 10 = 3 THEN 'changed' ELSE a.body END AS body, CASE WHEN a.pos % 2 = 0 THEN '' ELSE coalesce(b.own, '') END AS previous,
      sha256(CASE WHEN a.pos % 2 = 0 THEN '' ELSE coalesce(b.own, '') END || chr(10) || a.body) AS sha FROM first a LEFT JOIN first b ON b.pos = a.pos - 1)"""


@query(
    f"""WITH {JOURNAL}, c AS (SELECT x.pos, CASE WHEN sha256(x.previous || chr(10) || x.body) <> x.sha THEN 'hash' WHEN coalesce(y.sha, '') <> x.previous THEN 'chain' END AS problem FROM j x LEFT JOIN j y ON y.pos = x.pos - 1)
    SELECT pos, problem FROM c WHERE problem IS NOT NULL"""
)
def ledger_chain(spark, sf):
    """A journal of the events: pairs of records are chained, every tenth body is changed afterwards."""
    body = F.concat_ws(" ", "event_type", F.col("user_id").cast("string"))
    first = table(spark, sf, "events").select(F.col("event_id").alias("pos"), body.alias("body"))
    before = first.select((F.col("pos") + 1).alias("pos"), F.sha2(F.concat(F.lit("\n"), "body").cast("binary"), 256).alias("own"))
    previous = F.when(F.col("pos") % 2 == 0, "").otherwise(F.coalesce("own", F.lit("")))
    j = first.join(before, "pos", "left").withColumn("previous", previous)
    j = j.withColumn("sha", F.sha2(F.concat("previous", F.lit("\n"), "body").cast("binary"), 256)).withColumn("body", F.when(F.col("pos") % 10 == 3, "changed").otherwise(F.col("body")))
    return ledger.chain_breaks(j.select("pos", "body", "previous", "sha"))


@query(
    """WITH r AS (SELECT o_custkey AS stage, o_orderpriority AS impl FROM orders), d AS (SELECT DISTINCT o_custkey AS stage, o_orderpriority AS impl FROM orders WHERE o_orderstatus = 'F')
    SELECT count(*) AS requests, count(d.stage) AS hits FROM r LEFT JOIN d USING (stage, impl)"""
)
def cache_probe(spark, sf):
    o = table(spark, sf, "orders").select(F.col("o_custkey").alias("stage"), F.col("o_orderpriority").alias("impl"), F.lit("").alias("input_sha"), F.lit("").alias("params_sha"), F.when(F.col("o_orderstatus") == "F", "completed").otherwise("failed").alias("status"))
    return ledger.cache_probe(o.drop("status"), o).agg(F.count("*").alias("requests"), F.count_if("cache_hit").alias("hits"))


@query(
    """WITH t AS (SELECT CASE o_orderstatus WHEN 'F' THEN 'completed' WHEN 'O' THEN 'running' ELSE 'failed' END AS status, o_orderkey % 3 AS pareto_rank, o_totalprice AS price, CASE WHEN o_orderkey % 2 = 0 THEN o_custkey::DOUBLE END AS customer FROM orders),
    c AS (SELECT count(*) AS trials, count_if(status = 'completed')::BIGINT AS completed, count_if(status = 'failed')::BIGINT AS failed, count_if(status = 'completed' AND pareto_rank = 1)::BIGINT AS rank1 FROM t),
    m AS (SELECT 'price' AS metric, avg(price) AS mean FROM t WHERE status = 'completed' UNION ALL SELECT 'customer', avg(customer) FROM t WHERE status = 'completed' UNION ALL SELECT 'never', NULL)
    SELECT trials, completed, failed, rank1, metric, round(mean, 4) AS mean FROM c, m"""
)
def metric_means(spark, sf):
    o = table(spark, sf, "orders")
    status = F.when(F.col("o_orderstatus") == "F", "completed").when(F.col("o_orderstatus") == "O", "running").otherwise("failed")
    values = F.map_filter(F.create_map(F.lit("price"), "o_totalprice", F.lit("customer"), F.when(F.col("o_orderkey") % 2 == 0, F.col("o_custkey").cast("double"))), lambda _, v: v.isNotNull())
    trials = o.select(status.alias("status"), (F.col("o_orderkey") % 3).alias("pareto_rank"), values.alias("objectives"))
    found = planning.trial_summary(trials, declared=("price", "never"))
    return found.select("trials", "completed", "failed", "rank1", F.explode("means").alias("metric", "mean")).withColumn("mean", F.round("mean", 4))


@query("SELECT date_trunc('hour', ts) AS start, event_type, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY 1, 2")
def event_windows(spark, sf):
    out = windowed_events(table(spark, sf, "events"))
    return out.select(F.col("start").cast("timestamp_ntz").alias("start"), "event_type", "n", F.round("total", 4).alias("total"))


@query(
    """WITH t(term) AS (VALUES ('License'), ('rights')), p AS (SELECT doc_id, term, string_split(text, term) AS p FROM documents, t WHERE contains(text, term)),
    s AS (SELECT doc_id, term, unnest(p) AS part, unnest(range(len(p))) AS i, len(p) AS n FROM p),
    o AS (SELECT doc_id, term, i, n, (sum(length(part)) OVER (PARTITION BY doc_id, term ORDER BY i) + i * length(term))::BIGINT AS "offset" FROM s)
    SELECT doc_id, term, "offset" FROM o WHERE i < n - 1"""
)
def keyword_hits(spark, sf):
    return archives.keyword_hits(table(spark, sf, "documents"), ["License", "rights"], "doc_id", most=None).select("doc_id", "term", "offset")


@query(
    f"""WITH n AS (SELECT len(regexp_extract_all(text, '{WORD}')) AS w FROM documents), c(size) AS (VALUES (32), (64), (96), (128)),
    m AS (SELECT size, sum(ceil(w / size))::BIGINT AS chunks FROM n, c GROUP BY 1) SELECT size, chunks, row_number() OVER (ORDER BY abs(chunks - 10000), size)::INT AS place FROM m"""
)
def configuration_grid(spark, sf):
    n = table(spark, sf, "documents").select(text.word_count(F.col("text")).alias("w"))
    sizes = F.explode(F.array(*[F.lit(s) for s in (32, 64, 96, 128)])).alias("size")
    m = n.select("w", sizes).groupBy("size").agg(F.sum(F.ceil(F.col("w") / F.col("size"))).cast("long").alias("chunks"))
    return m.withColumn("place", F.row_number().over(Window.orderBy(F.abs(F.col("chunks") - 10_000), "size")))


@query(
    rf"""WITH {SENTENCES}, n AS (SELECT doc_id, len(regexp_extract_all(source, '[.!?…]')) AS stops, len(regexp_extract_all(source, '[\p{{L}}\p{{N}}_]+')) AS words FROM units)
    SELECT doc_id, count_if(words >= 80 AND stops <= 1)::BIGINT AS suspicious, count(*) AS parts FROM n GROUP BY 1"""
)
def suspicious_long(spark, sf):
    u = segments.sentence_units(table(spark, sf, "documents"), least=0, most=1 << 30)
    return u.groupBy("doc_id").agg(F.count_if(gates.suspicious_long(F.col("source"))).alias("suspicious"), F.count("*").alias("parts"))
