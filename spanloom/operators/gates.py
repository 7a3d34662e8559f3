"""Quality gates and integrity guards over pairs (segment_id, source, target).

A gate takes such a DataFrame and returns one row for each pair that fails,
with the evidence; ``summary`` tells whether it passed. Guards are columns.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spanloom.functions import numbers
from spanloom.functions.arrays import held, in_order, let, multiset_minus, reasons
from spanloom.functions.text import CYRILLIC, TERMINAL, count_of, letter_count, protected_stripped, run_count, script_share, strip, word_count

SYMBOLS = ("%", "°", "±", "=", "<", ">")
BRACKETS = (("(", ")"), ("[", "]"), ("{", "}"))
TERMINALS = ("?", "!")


@dataclass(frozen=True)
class Gate:
    """A test of pairs: ``evidence`` adds columns to each pair, ``fails`` says by them whether it fails.

    Called with pairs, a gate gives those that fail, with the evidence.
    """

    evidence: Callable[[DataFrame], DataFrame]
    fails: Callable[[], Column]

    def __call__(self, pairs: DataFrame) -> DataFrame:
        return self.evidence(pairs).filter(self.fails())


def mismatches(marks: tuple[str, ...], source: str = "source", target: str = "target") -> Column:
    """Map from each mark whose counts differ to its two counts."""
    counts = F.map_from_entries(
        F.array(*[F.struct(F.lit(m), F.struct(count_of(F.col(source), m).alias("source"), count_of(F.col(target), m).alias("target"))) for m in marks])
    )
    return F.map_filter(counts, lambda _, v: v["source"] != v["target"])


def _any(*maps_and_arrays: str) -> Column:
    out = F.lit(False)
    for c in maps_and_arrays:
        out = out | (F.size(c) > 0)
    return out


def _numerals(pairs: DataFrame) -> DataFrame:
    values = held(pairs, _a=numbers.literals(F.col("source")), _b=numbers.literals(F.col("target")), _ok=numbers.licensed(F.col("source")))
    judged = held(
        values,
        missing=multiset_minus(F.col("_a"), F.col("_b")),
        unlicensed=F.filter(multiset_minus(F.col("_b"), F.col("_a")), lambda v: ~F.array_contains(F.col("_ok"), v)),
        symbols=mismatches(SYMBOLS),
    )
    return judged.drop("_a", "_b", "_ok")


#: Literals missing from the target, additions that no number word licenses, symbols whose counts differ.
numeric_gate = Gate(_numerals, lambda: _any("missing", "unlicensed", "symbols"))
#: Brackets and question or exclamation marks whose counts differ.
punctuation_gate = Gate(lambda pairs: held(pairs, marks=mismatches(tuple(m for pair in BRACKETS for m in pair) + TERMINALS)), lambda: _any("marks"))


def length(low: float = 0.15, high: float = 6.0) -> Gate:
    """Blank targets, and letter ratios outside [low, high]; no source letters: 1, or infinite if the target has some."""
    if low <= 0 or high <= low:
        raise ValueError("length ratios must satisfy 0 < low < high")

    def evidence(pairs: DataFrame) -> DataFrame:
        rated = held(pairs, source_letters=letter_count(F.col("source")), target_letters=letter_count(F.col("target")), blank=strip(F.col("target")) == "")
        a, b = F.col("source_letters"), F.col("target_letters")
        return held(rated, ratio=F.when(a > 0, b / a).when(b == 0, 1.0).otherwise(F.lit(float("inf"))))

    return Gate(evidence, lambda: F.col("blank") | (F.col("ratio") < low) | (F.col("ratio") > high))


def length_gate(pairs: DataFrame, low: float = 0.15, high: float = 6.0) -> DataFrame:
    return length(low, high)(pairs).drop("blank")


GATES: dict[str, Gate] = {"numeric": numeric_gate, "punctuation": punctuation_gate, "length": length()}


def verdicts(pairs: DataFrame, gates: dict[str, Gate] = GATES, name: str = "failed") -> DataFrame:
    """``pairs`` with an array column ``name``: the gates that fail, all judged in one pass over the pairs."""
    out, columns = pairs, pairs.columns
    for gate in gates.values():
        out = gate.evidence(out)
    return held(out, **{name: reasons(*[(n, g.fails()) for n, g in gates.items()])}).select(*columns, name)


def summary(pairs: DataFrame, gates: dict[str, Gate] = GATES, key: str = "segment_id", digest: bool = False) -> DataFrame:
    """(gate, failure_count, passed): one row for each gate, those without failures too.

    With ``digest`` also ``issues_sha256``, a hash of the sorted keys of the
    failing pairs (of nothing: of the empty string). A gate's failures are meant
    to be few; their keys are brought together for it.
    """
    failed = verdicts(pairs, gates).select(F.col(key).cast("string").alias("k"), F.explode("failed").alias("gate"))
    aggregates = [F.count("*").alias("n")]
    if digest:
        aggregates.append(F.sha2(F.array_join(F.array_sort(F.collect_list("k")), "\n").cast("binary"), 256).alias("issues"))
    all_gates = pairs.sparkSession.createDataFrame([(n,) for n in gates], "gate string")
    out = all_gates.join(F.broadcast(failed.groupBy("gate").agg(*aggregates)), "gate", "left")  # a row for each gate
    columns = ["gate", F.coalesce("n", F.lit(0)).alias("failure_count"), F.col("n").isNull().alias("passed")]
    return out.select(*columns, *([F.coalesce("issues", F.sha2(F.lit("").cast("binary"), 256)).alias("issues_sha256")] if digest else []))


def approved(pairs: DataFrame, gates: dict[str, Gate] = GATES, key: str = "segment_id") -> DataFrame:
    """Pairs that pass every gate."""
    return verdicts(pairs, gates, "_failed").filter(F.size("_failed") == 0).drop("_failed")


def latest_gate_states(required: DataFrame, runs: DataFrame) -> DataFrame:
    """Required gates (impl) without a passed latest run in ``runs`` (impl, run_id, passed)."""
    latest = runs.groupBy("impl").agg(F.max_by("passed", "run_id").alias("passed"))
    return required.join(latest.filter("passed"), "impl", "left_anti")


# Guards: structs of evidence with a ``passed`` field.


def explicit_numeric_guard(source: Column, target: Column) -> Column:
    """Every explicit value as often as required, and required ones no more often than number words license."""

    def judge(required: Column, observed: Column, spelled: Column) -> Column:
        return let(
            lambda missing, over: F.struct(
                missing.alias("missing"),
                F.filter(over, lambda v: F.array_contains(required, v)).alias("duplicate_required"),
                F.filter(over, lambda v: ~F.array_contains(required, v)).alias("unlicensed"),
                ((F.size(missing) == 0) & ~F.exists(over, lambda v: F.array_contains(required, v))).alias("passed"),
            ),
            multiset_minus(required, observed),
            multiset_minus(observed, F.concat(required, spelled)),
        )

    return let(judge, numbers.explicit(source), numbers.explicit(target), numbers.spelled(source))


def _explicit_passed(source: Column, required: Column, observed: Column) -> Column:
    """``passed`` of ``explicit_numeric_guard`` by the explicit values; number words are looked for only where they decide."""
    over = multiset_minus(observed, F.concat(required, numbers.spelled(source)))
    licensed = (F.size(required) == 0) | ~F.exists(over, lambda v: F.array_contains(required, v))
    return (F.size(multiset_minus(required, observed)) == 0) & licensed


def strict_numeric_guard(source: Column, target: Column) -> Column:
    """As ``explicit_numeric_guard``, but additions fail too."""

    def judge(g: Column) -> Column:
        return F.struct(*[g[k].alias(k) for k in ("missing", "duplicate_required", "unlicensed")], (g["passed"] & (F.size(g["unlicensed"]) == 0)).alias("passed"))

    return let(judge, explicit_numeric_guard(source, target))


def numeric_order(source: Column, target: Column) -> Column:
    """Whether the explicit values of the source occur in the target in their order."""
    return in_order(numbers.explicit(source), numbers.explicit(target))


def local_numeric_guard(source: Column, target: Column) -> Column:
    """struct(missing, over, passed) over whole-word integers, fractions and spaced groups.

    Number words of the source up to sixteen license as many more of their value.
    """

    def judge(required: Column, observed: Column, allowed: Column) -> Column:
        return let(
            lambda missing, over: F.struct(missing.alias("missing"), over.alias("over"), ((F.size(missing) == 0) & (F.size(over) == 0)).alias("passed")),
            multiset_minus(required, observed),
            multiset_minus(observed, F.concat(required, allowed)),
        )

    return let(judge, numbers.whole(source), numbers.whole(target), numbers.spelled(source, most=16))


def integer_multiset_equal(source: Column, target: Column) -> Column:
    return F.array_sort(numbers.integers(source)) == F.array_sort(numbers.integers(target))


def delimiters(source: Column, target: Column) -> Column:
    """Square and round brackets: the same counts if the source is balanced, else a balanced target."""

    def judge(source: Column, target: Column) -> Column:
        passed = F.lit(True)
        for left, right in BRACKETS[1::-1]:
            a, b, c, d = count_of(source, left), count_of(source, right), count_of(target, left), count_of(target, right)
            passed = passed & F.when(a == b, (a == c) & (b == d)).otherwise(c == d)
        return passed

    # Counted in what a single pass leaves of a text.
    return let(judge, *[F.regexp_replace(t, r"[^\[\]()]+", "") for t in (source, target)])


#: Marks of figures, footnotes, illustrations, Greek words and emphasis, in sources and in targets.
FIGURE = r"(?i)\[in\s+_Fig\._\s+(\d+)\.\]"
FOOTNOTE = r"\[([A-Z])\]"
ILLUSTRATION, ILLUSTRATION_TARGET = r"(?i)\[Illustration:\s*([^\]]*)\]", r"(?iu)\[(?:Illustration|Иллюстрация)\s*:\s*([^\]]*)\]"
GREEK, GREEK_TARGET = r"(?i)\[Greek:\s*([^\]]*)\]", r"(?iu)\[(?:Greek|греч\.?|греческ[^:\]]*)\s*:\s*([^\]]*)\]"
COMBINED = r"(?i)_([A-Za-z]{1,3})\[Greek:\s*([^\]]+)\]_"
COMBINED_TARGET = r"(?iu)_([A-Za-z]{1,3})\[(?:Greek|греч\.?|греческ[^:\]]*)\s*:\s*([^\]]+)\]_"
EMPHASIS = r"_([^_\n]{1,80})_"


def emphasis(text: Column) -> Column:
    """Symbols set in emphasis: one to three letters, or letter-digit atoms."""
    inner = _payload(text, EMPHASIS, mark="_")
    atom = r"(?:\d+[A-Za-z]|[A-Za-z]\d+)"
    return F.filter(inner, lambda x: x.rlike("^[A-Za-z]{1,3}$") | x.rlike(rf"^{atom}(?:\s+{atom})*$"))


def _payload(text: Column, pattern: str, group: int = 1, mark: str = "[") -> Column:
    """What a group of each match holds; every match holds ``mark``, so that texts without it are not searched."""
    found = F.transform(F.regexp_extract_all(text, F.lit(pattern), F.lit(group)), strip)
    return F.when(~F.contains(text, F.lit(mark)), F.array().cast("array<string>")).otherwise(found)


def critical_tokens(source: Column, target: Column) -> Column:
    """Names of the classes of technical marks whose ordered payloads differ."""
    return reasons(
        ("greek_payloads", _payload(source, GREEK) != _payload(target, GREEK_TARGET)),
        ("combined_greek_variables", (_payload(source, COMBINED) != _payload(target, COMBINED_TARGET)) | (_payload(source, COMBINED, 2) != _payload(target, COMBINED_TARGET, 2))),
        ("symbolic_emphasis", emphasis(source) != emphasis(target)),
        ("footnote_markers", _payload(source, FOOTNOTE) != _payload(target, FOOTNOTE)),
        ("illustration_payloads", _payload(source, ILLUSTRATION) != _payload(target, ILLUSTRATION_TARGET)),
    )


def missing_figures(source: Column, target: Column) -> Column:
    """Figure numbers of the source that the target does not hold as whole numbers."""
    found = F.regexp_extract_all(target, F.lit(r"\d+"), F.lit(0))
    return F.filter(F.regexp_extract_all(source, F.lit(FIGURE), F.lit(1)), lambda n: ~F.array_contains(found, n))


def quality(source: Column, target: Column, script: str = CYRILLIC, alphabet: str = "[A-Za-zА-Яа-яЁё]") -> Column:
    """Struct: empty, word_ratio, length_anomaly (outside 0.15 to 3), identity, script_share, numeric_passed, figures_passed."""

    def judge(words: Column, folded: Column, required: Column, observed: Column) -> Column:
        return _quality(source, target, words, folded, required, observed, script, alphabet)

    return let(judge, word_count(source), _folded(source), numbers.explicit(source), numbers.explicit(target))


def _folded(text: Column) -> Column:
    return F.lower(strip(text))


def _form(target: Column, words: Column, folded: Column, script: str, alphabet: str) -> Column:
    """The fields of ``quality`` that need no numbers, by the words and the folded text of the source."""

    def fields(ratio: Column, own: Column) -> Column:
        return F.struct(
            (own == "").alias("empty"),
            ratio.alias("word_ratio"),
            ((ratio < 0.15) | (ratio > 3.0)).alias("length_anomaly"),
            (folded == own).alias("identity"),
            script_share(target, script, alphabet).alias("script_share"),
        )

    return let(fields, word_count(target) / F.greatest(words, F.lit(1)), _folded(target))


def _quality(source: Column, target: Column, words: Column, folded: Column, required: Column, observed: Column, script: str, alphabet: str) -> Column:
    """``quality`` by what is bound already: words, folded text and explicit values of the source, explicit values of the target."""

    def fields(form: Column) -> Column:
        return F.struct(
            *[form[c].alias(c) for c in ("empty", "word_ratio", "length_anomaly", "identity", "script_share")],
            _explicit_passed(source, required, observed).alias("numeric_passed"),
            (F.size(missing_figures(source, target)) == 0).alias("figures_passed"),
        )

    return let(fields, _form(target, words, folded, script, alphabet))


def intervention_reasons(baseline: Column, candidate: Column) -> Column:
    """Why a candidate (a ``quality`` struct) may not replace its baseline."""
    return reasons(
        ("empty", candidate["empty"]),
        ("new_length_anomaly", candidate["length_anomaly"] & ~baseline["length_anomaly"]),
        ("new_identity", candidate["identity"] & ~baseline["identity"]),
        ("numeric_integrity", ~candidate["numeric_passed"]),
        ("figure_integrity", ~candidate["figures_passed"]),
        ("script_share_regression", candidate["script_share"] < baseline["script_share"] - 0.08),
        ("low_script_share", (candidate["script_share"] < 0.60) & (baseline["script_share"] >= 0.60)),
    )


def strong_reasons(source: Column, baseline_text: Column, candidate_text: Column, script: str = CYRILLIC, alphabet: str = "[A-Za-zА-Яа-яЁё]") -> Column:
    """Intervention reasons, then order, delimiters, technical marks and new Latin residue.

    What several tests need of a text is bound once; of the baseline only the
    fields of ``quality`` that a candidate is held against are computed.
    """

    def judge(words: Column, folded: Column, required: Column, observed: Column, own: Column) -> Column:
        baseline = _form(baseline_text, words, folded, script, alphabet)
        candidate = _quality(source, candidate_text, words, folded, required, observed, script, alphabet)
        more = let(lambda n: (n > 0) & (n > _residue_size(own, baseline_text)), _residue_size(own, candidate_text))
        return F.concat(
            let(intervention_reasons, baseline, candidate),
            reasons(
                ("explicit_numeric_order", ~in_order(required, observed)),
                ("balanced_delimiter_integrity", ~delimiters(source, candidate_text)),
                ("critical_technical_tokens", F.size(critical_tokens(source, candidate_text)) > 0),
                ("new_latin_residue", more),
            ),
        )

    return let(judge, word_count(source), _folded(source), numbers.explicit(source), numbers.explicit(candidate_text), _latin(source))


#: Fixed value: what counts as a word left in Latin letters.
LATIN_WORD = r"[A-Za-z]{4,}"


def latin_residue(source: Column, target: Column) -> Column:
    """Latin words of four or more letters outside protected spans that the target took over from the source."""
    words = F.regexp_extract_all(protected_stripped(target), F.lit(LATIN_WORD), F.lit(0))
    common = let(lambda own, seen: F.array_intersect(own, seen), _latin(source), F.array_distinct(F.transform(words, F.lower)))
    return let(lambda words, common: F.filter(words, lambda w: F.array_contains(common, F.lower(w))), words, common)


def _latin(text: Column) -> Column:
    """Distinct lower-cased Latin words of four or more letters."""
    return F.array_distinct(F.transform(F.regexp_extract_all(text, F.lit(LATIN_WORD), F.lit(0)), F.lower))


def _residue_size(own: Column, target: Column) -> Column:
    """Size of ``latin_residue`` for a source with the words ``own`` (null if one of them is).

    All words are sorted together, those of the target with a mark that puts
    them right after their equal in ``own``, so that no word is looked for.
    """
    mark = F.lit("\0")
    words = F.regexp_extract_all(protected_stripped(target), F.lit(LATIN_WORD), F.lit(0))

    def count(z: Column) -> Column:
        starts = F.array_compact(F.transform(z, lambda v, i: F.when((i > 0) & (v != F.get(z, i - 1)), i)))
        run = lambda s: F.transform(s, lambda p, k: F.when(F.concat(F.get(z, p - 1), mark) == F.get(z, p), F.coalesce(F.get(s, k + 1), F.size(z)) - p).otherwise(0))
        return F.aggregate(let(run, starts), F.lit(0), lambda n, m: n + m)

    return let(count, F.sort_array(F.concat(own, F.transform(words, lambda w: F.concat(F.lower(w), mark)))))


def protected_share(text: Column, script: str = CYRILLIC, alphabet: str = "[A-Za-zА-Яа-яЁё]") -> Column:
    """Script share outside ``[...]`` and ``_..._``."""
    return script_share(protected_stripped(text), script, alphabet)


def absolute_reasons(source: Column, target: Column, least_share: float = 0.60, **scripts: str) -> Column:
    """Why a target fails on its own, without a baseline."""
    names = {"empty": "empty", "length_anomaly": "length_anomaly", "identity": "identity"}
    first = let(
        lambda q: reasons(*[(n, q[c]) for n, c in names.items()], ("numeric_integrity", ~q["numeric_passed"]), ("figure_integrity", ~q["figures_passed"])),
        quality(source, target, **scripts),
    )
    rest = reasons(
        ("explicit_numeric_order", ~numeric_order(source, target)),
        ("balanced_delimiter_integrity", ~delimiters(source, target)),
        ("critical_technical_tokens", F.size(critical_tokens(source, target)) > 0),
        ("low_script_share", protected_share(target, **scripts) < least_share),
    )
    return F.concat(first, rest)


def row_objective(source: Column, baseline: Column, candidate: Column, changed: Column, least_share: float = 0.60, **scripts: str) -> Column:
    """Why a row fails: its candidate's own faults, and for changed rows the strong gate and new unprotected Latin words."""
    own = let(
        lambda q: reasons(
            ("empty", q["empty"]), ("numeric", ~q["numeric_passed"]), ("numeric_order", ~numeric_order(source, candidate)), ("delimiters", ~delimiters(source, candidate)),
            ("critical_tokens", F.size(critical_tokens(source, candidate)) > 0), ("figure", ~q["figures_passed"]), ("length", q["length_anomaly"]), ("identity", q["identity"]),
        ),
        quality(source, candidate, **scripts),
    )
    rest = reasons(
        ("strong_intervention_gate", changed & (F.size(strong_reasons(source, baseline, candidate, **scripts)) > 0)),
        ("new_unprotected_latin", changed & (latin_words(candidate) > latin_words(baseline))),
    )
    return F.concat(own, rest)


def latin_words(text: Column) -> Column:
    """Latin words of four letters or more outside protected spans."""
    return F.regexp_count(protected_stripped(text), F.lit(LATIN_WORD))


def global_pass(rows: DataFrame, failures: str = "failures", baseline_share: str = "baseline_share", share: str = "share", loss: float = 0.01) -> DataFrame:
    """One row: units, failed units, the mean script shares of baseline and candidate, and whether all passed.

    ``rows`` has the array of ``row_objective`` and two shares (null for empty
    texts); the mean share may not fall by more than ``loss``.
    """
    out = rows.agg(
        F.count("*").alias("units"),
        F.count_if(F.size(failures) > 0).alias("failed_units"),
        F.avg(baseline_share).alias("baseline_mean"),
        F.avg(share).alias("candidate_mean"),
    )
    kept = F.coalesce(F.col("candidate_mean") >= F.col("baseline_mean") - loss, F.lit(True))
    return out.withColumn("passed", (F.col("failed_units") == 0) & kept)


#: Faults of punctuation (a space before a mark, a mark between letters, doubled marks), and stops.
PUNCTUATION_FAULTS = (r"\s+[,.;:!?]", r"(?<=[A-Za-z])[,;:!?](?=[A-Za-z])", r",{2,}|;{2,}")
STOPS = "[.!?…]"


def punctuation_proxy(text: Column) -> Column:
    """Count of suspicious punctuation: space before a mark, a mark between letters, doubled marks, long or open ends."""
    words = run_count(text)
    return (
        sum((F.regexp_count(text, F.lit(p)) for p in PUNCTUATION_FAULTS), F.lit(0))
        + F.when(suspicious_long(text), 1).otherwise(0)
        + F.when((strip(text) != "") & ~text.rlike(TERMINAL) & (words > 3), 1).otherwise(0)
    ).cast("long")


def suspicious_long(text: Column) -> Column:
    """Eighty bare word runs or more with one stop at most."""
    return (run_count(text) >= 80) & (F.regexp_count(text, F.lit(STOPS)) <= 1)


def quality_totals(rows: DataFrame, q: str = "quality") -> DataFrame:
    """One row of conditional counts over ``quality`` structs; the mean share is over targets that are not empty."""
    c = F.col(q)
    return rows.agg(
        F.count("*").alias("units"),
        F.count_if(c["empty"]).alias("empty"),
        F.count_if(c["length_anomaly"]).alias("length_anomalies"),
        F.count_if(c["identity"]).alias("identities"),
        F.count_if(~c["numeric_passed"]).alias("numeric_failures"),
        F.count_if(~c["figures_passed"]).alias("figure_failures"),
        F.avg(F.when(~c["empty"], c["script_share"])).alias("mean_script_share"),
    )


def first_passing(hypotheses: DataFrame, key: str, passed: Column) -> DataFrame:
    """Of each key's hypotheses (key, rank, text) the first by rank that passes."""
    return hypotheses.filter(passed).groupBy(key).agg(F.min("rank").alias("rank"), F.min_by("text", "rank").alias("text"))


def cascade(baseline: DataFrame, candidates: DataFrame, key: str) -> DataFrame:
    """The first mechanism (by priority) whose candidate passed its gate, else the baseline text.

    ``baseline`` is (key, text); ``candidates`` is (key, priority, mechanism, text, passed).
    """
    best = candidates.filter("passed").groupBy(key).agg(F.min_by(F.struct("text", "mechanism"), "priority").alias("best"))
    return baseline.join(best, key, "left").select(
        key, F.coalesce("best.text", "text").alias("text"), F.coalesce("best.mechanism", F.lit("baseline")).alias("mechanism")
    )


