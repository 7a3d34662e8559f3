"""Gates and guards against literal cases and a plain version of the rules."""

import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from spanloom.functions import numbers, text
from spanloom.functions.arrays import in_order, multiset_minus
from spanloom.operators import gates

CASES = [
    ("Value 42%.", "Значение."),
    ("Value 42% and 007, 1.50 or 3/04", "42 % 7 1,5 3/4"),
    ("twenty one days", "21 дней"),
    ("one, two", "1 2 3"),
    ("x3 3x 3", "3"),
    ("-5 +5 5", "5 -5 +5"),
    ("a (b) [c] {d}?", "a (b [c] {d}!"),
    ("", ""),
    ("...", "буквы"),
    ("letters", "  "),
    ("12’5 and 12'5", "12.5 12.5"),
]


def plain_literals(s):
    out = []
    for m in re.finditer(r"(?<!\w)([+-]?\d+(?:[.,'’]\d+)?(?:/\d+)?)(?!\w)", s):
        sides = []
        for side in re.sub("[’',]", ".", m[1]).split("/"):
            sign = side[0] if side[0] in "+-" else ""
            whole, _, rest = side.lstrip("+-").partition(".")
            whole, rest = whole.lstrip("0") or "0", rest.rstrip("0")
            sides.append(sign + whole + (f".{rest}" if rest else ""))
        out.append("/".join(sides))
    return out


@pytest.fixture(scope="module")
def pairs(spark):
    return spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(CASES)], "segment_id long, source string, target string").cache()


def test_literals(pairs):
    for r in pairs.select("source", "target", numbers.literals(F.col("source")).alias("a"), numbers.literals(F.col("target")).alias("b")).collect():
        assert (r.a, r.b) == (plain_literals(r.source), plain_literals(r.target))


def test_licences(spark):
    rows = [("Twenty one of thirty", ["21", "1", "30"]), ("twenty ten", ["20", "10"]), ("none here", []), ("ninety nine nine", ["99", "9"])]
    df = spark.createDataFrame(rows, "t string, want array<string>")
    assert all(sorted(r.got) == sorted(r.want) for r in df.select("want", numbers.licensed(F.col("t")).alias("got")).collect())


def test_numeric_gate(pairs):
    got = {r.segment_id: (sorted(r.missing), sorted(r.unlicensed), {k: (v["source"], v["target"]) for k, v in r.symbols.items()}) for r in gates.numeric_gate(pairs).collect()}
    licences = {2: {"21", "1"}, 3: {"1", "2"}}
    for i, (a, b) in enumerate(CASES):
        x, y = Counter(plain_literals(a)), Counter(plain_literals(b))
        extra = [v for v in (y - x).elements() if v not in licences.get(i, ())]
        marks = {m: (a.count(m), b.count(m)) for m in gates.SYMBOLS if a.count(m) != b.count(m)}
        want = (sorted((x - y).elements()), sorted(extra), marks)
        assert got.get(i, ([], [], {})) == want


def test_punctuation_and_length(pairs):
    marks = {r.segment_id: set(r.marks) for r in gates.punctuation_gate(pairs).collect()}
    assert marks == {6: {")", "?", "!"}}
    failed = {r.segment_id: r.ratio for r in gates.length_gate(pairs).collect()}
    assert 8 in failed and failed[8] == float("inf") and 9 in failed and 7 in failed
    with pytest.raises(ValueError):
        gates.length_gate(pairs, 2.0, 1.0)


def test_summary_and_approval(pairs):
    rows = {r.gate: (r.failure_count, r.passed) for r in gates.summary(pairs).collect()}
    assert rows["punctuation"] == (1, False) and set(rows) == {"numeric", "punctuation", "length"}
    clean = pairs.filter("segment_id in (4)").withColumn("target", F.col("source"))
    assert {r.passed for r in gates.summary(clean).collect()} == {True} and gates.approved(clean).count() == 1


def test_guards(spark):
    rows = [
        ("1,234 men and 2nd prize 3-1/2", "1234 2 3-1/2", True, True, True),
        ("1 then 2", "2 then 1", True, False, True),
        ("5 and five", "5 5", True, True, True),
        ("5", "5 5", False, True, True),
        ("5", "5 7", True, True, True),
        ("(a)", "(a", True, True, False),
        ("(a", "(a)", True, True, True),
        ("[A] _ab_ x", "[A] _ab_", True, True, True),
    ]
    df = spark.createDataFrame(rows, "source string, target string, numeric boolean, ordered boolean, delimited boolean")
    s, t = F.col("source"), F.col("target")
    out = df.select("*", gates.explicit_numeric_guard(s, t)["passed"].alias("a"), gates.numeric_order(s, t).alias("b"), gates.delimiters(s, t).alias("c"), gates.strict_numeric_guard(s, t)["passed"].alias("d")).collect()
    for r in out:
        assert (r.a, r.b, r.c) == (r.numeric, r.ordered, r.delimited), r
    assert [r.d for r in out] == [True, True, True, False, False, True, True, True]
    marks = spark.createDataFrame([("[Greek: a] _x_ [A]", "[греч.: a] _x_ [A]", []), ("_3p 3t_", "", ["symbolic_emphasis"]), ("[Illustration: f]", "[Иллюстрация: f]", []), ("[B]", "", ["footnote_markers"])], "s string, t string, want array<string>")
    assert all(r.got == r.want for r in marks.select("want", gates.critical_tokens(F.col("s"), F.col("t")).alias("got")).collect())


def test_intervention(spark):
    rows = [
        ("one two three four", "раз два три четыре", "", ["empty", "new_length_anomaly", "script_share_regression", "low_script_share"]),
        ("word 5", "слово 5", "слово", ["numeric_integrity"]),
        ("word", "слово", "word", ["new_identity", "script_share_regression", "low_script_share"]),
        ("[in _Fig._ 7.] it", "[на рис. 7.] это", "это тут", ["numeric_integrity", "figure_integrity"]),
    ]
    df = spark.createDataFrame(rows, "s string, b string, c string, want array<string>")
    out = df.select("want", gates.intervention_reasons(gates.quality(F.col("s"), F.col("b")), gates.quality(F.col("s"), F.col("c"))).alias("got")).collect()
    assert all(r.got == r.want for r in out), out


def test_cascade_and_hypotheses(spark):
    base = spark.createDataFrame([(1, "b1"), (2, "b2")], "k int, text string")
    cand = spark.createDataFrame([(1, 2, "m2", "x", True), (1, 1, "m1", "y", False), (1, 3, "m3", "z", True)], "k int, priority int, mechanism string, text string, passed boolean")
    assert {(r.k, r.text, r.mechanism) for r in gates.cascade(base, cand, "k").collect()} == {(1, "x", "m2"), (2, "b2", "baseline")}
    hyp = spark.createDataFrame([("a", 0, "no"), ("a", 1, "yes"), ("a", 2, "yes too")], "key string, rank int, text string")
    assert gates.first_passing(hyp, "key", F.col("text").startswith("yes")).collect()[0].text == "yes"
    need = spark.createDataFrame([("numeric",), ("length",)], "impl string")
    runs = spark.createDataFrame([("numeric", 1, True), ("numeric", 2, False), ("length", 1, True)], "impl string, run_id int, passed boolean")
    assert [r.impl for r in gates.latest_gate_states(need, runs).collect()] == ["numeric"]


def test_multisets(spark):
    df = spark.createDataFrame([(["a", "b", "a", "c"], ["a", "c", "c"])], "x array<string>, y array<string>")
    r = df.select(multiset_minus(F.col("x"), F.col("y")).alias("m"), in_order(F.col("y"), F.col("x")).alias("o"), in_order(F.array(F.lit("b"), F.lit("c")), F.col("x")).alias("p")).first()
    assert r.m == ["a", "b"] and not r.o and r.p


def test_text_functions(spark):
    df = spark.createDataFrame([("  a  b\n",)], "t string")
    assert df.select(text.collapse(F.col("t"))).first()[0] == "a b"
    joins = spark.createDataFrame([(["hy-", "phen", "soft­", "ware", "", "End"],)], "l array<string>")
    assert joins.select(text.wrap_join(F.col("l"))).first()[0] == "hy-phen software End"
    parts = spark.createDataFrame([(["word", ", then", "(", "in", ")"],)], "p array<string>")
    assert parts.select(text.smart_join(F.col("p"))).first()[0] == "word, then (in)"


def test_strong_gate_binds_each_text_once(spark):
    """Long texts: explicit values once for each text, Latin words without a look-up of every word in a list."""
    df = spark.createDataFrame([("", "", "")], "s string, b string, c string")
    plan = df.select(gates.strong_reasons(*map(F.col, "sbc")).alias("r"))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count(r"\d+\s*/\s*\d+(?:st|nd|rd|th)?|\d{1,3}") == 2
    residue = gates._residue_size(gates._latin(F.col("s")), F.col("b")).alias("n")
    assert "array_contains" not in df.select(residue)._jdf.queryExecution().optimizedPlan().toString()


def test_counts_of_the_strong_gate(spark):
    r = random.Random(5)
    words = ["alpha", "Beta", "BETA", "gamma", "gam", "слово", "[alpha", "beta]", "_delta_", "_", "alphabeta", "1\n", "𝒜bcde", "éalpha"]
    rows = [tuple(" ".join(r.choices(words, k=r.randint(0, 30))) for _ in range(2)) for _ in range(60)] + [("", ""), ("alpha", ""), ("alpha", None)]
    s, t = F.col("s"), F.col("t")
    df = spark.createDataFrame(rows, "s string, t string").select(
        *[gates._residue_size(gates._latin(s), t).alias("n"), F.size(gates.latin_residue(s, t)).alias("want"), text.script_share(t, text.LATIN, r"\p{L}").alias("share"), "t"]
    )
    letters = F.regexp_count("t", F.lit(r"\p{L}"))
    plain = F.when(letters > 0, F.regexp_count("t", F.lit(text.LATIN)) / letters).otherwise(F.lit(0.0))
    got = df.select("n", "want", "share", plain.alias("plain")).collect()
    assert all(x.n == x.want and x.share == x.plain for x in got) and max(x.n or 0 for x in got) > 5
    spelled = spark.createDataFrame([("sixteen and 3", "16 3", True), ("seven 7", "7 7", True), ("7", "7 7", False), ("seven", "7 7", True), ("7", "", False), (None, "7", None), ("7", None, None)], "s string, t string, ok boolean")
    whole = gates.explicit_numeric_guard(s, t)["passed"]
    assert all(x.a == x.b == x.ok for x in spelled.select("ok", gates.quality(s, t)["numeric_passed"].alias("a"), whole.alias("b")).collect())
