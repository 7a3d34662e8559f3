"""Rules, plans and records against plain versions and literal cases."""

import base64
import hashlib
import io
import json
import random
import zipfile
from collections import Counter

import pytest
from pyspark.sql import functions as F

from spanloom.functions import porter
from spanloom.functions.arrays import multiset_minus
from spanloom.operators import gates, joins, sampling, segments, similarity
from spanloom.plans import control, dictionary, ledger, providers, registry, stages, versions
from spanloom.scratch import clear, kept, shared_dir
from spanloom.sources import archives

#: Word pairs from the paper of Porter (1980).
PORTER = (
    "caresses caress ponies poni ties ti caress caress cats cat feed feed agreed agre plastered plaster bled bled motoring motor sing sing conflated conflat troubled troubl sized size hopping hop "
    "tanned tan falling fall hissing hiss fizzed fizz failing fail filing file happy happi sky sky relational relat conditional condit rational ration valenci valenc digitizer digit conformabli conform "
    "radicalli radic differentli differ vileli vile analogousli analog vietnamization vietnam predication predic operator oper feudalism feudal decisiveness decis hopefulness hope callousness callous "
    "formaliti formal sensitiviti sensit sensibiliti sensibl triplicate triplic formative form formalize formal electriciti electr electrical electr hopeful hope goodness good revival reviv allowance allow "
    "inference infer airliner airlin gyroscopic gyroscop adjustable adjust defensible defens irritant irrit replacement replac adjustment adjust dependent depend adoption adopt homologou homolog "
    "communism commun activate activ angulariti angular homologous homolog effective effect bowdlerize bowdler probate probat rate rate cease ceas controll control roll roll"
).split()


def test_porter():
    pairs = dict(zip(PORTER[::2], PORTER[1::2]))
    assert {w: porter.stem(w) for w in pairs} == pairs


def test_retention_and_mixed_case(spark):
    rows = [(1, "The Lenses and lenses refract; lenses! Prism", "lenses lenses lens", "rays"), (2, "colours colours Colours", "colours", "colours colours colours")]
    df = spark.createDataFrame(rows, "k long, source string, baseline string, candidate string")
    got = {(r.k, r.stem): (r.source_n, r.baseline_kept, r.candidate_kept, r.collapsed) for r in similarity.retention(df, "k").collect()}
    assert got == {(1, "lens"): (3, 2, 0, False), (2, "colour"): (3, 1, 3, False)}
    hard = df.withColumn("baseline", F.col("source"))
    assert {r.k: r.collapsed for r in similarity.retention(hard, "k").collect()} == {1: True, 2: False}
    mixed = similarity.mixed_case_stems(df.withColumnRenamed("source", "text"), "k").collect()
    assert {(r.k, r.stem, r.n) for r in mixed} == {(1, "lens", 3), (2, "colour", 3)}


def plain_chrf(ref, hyp):
    def orders(t):
        bare, words = "".join(t.split()), t.split()
        return [Counter(bare[i : i + n] for i in range(len(bare) - n + 1)) for n in range(1, 7)] + [Counter(tuple(words[i : i + n]) for i in range(len(words) - n + 1)) for n in (1, 2)]

    p, r = [], []
    for x, y in zip(orders(ref), orders(hyp)):
        if x and y:
            m = sum((x & y).values())
            p.append(m / sum(y.values()))
            r.append(m / sum(x.values()))
    if not p or not sum(p) + sum(r):
        return 0.0
    p, r = sum(p) / len(p), sum(r) / len(r)
    return 100 * 5 * p * r / (4 * p + r)


def test_similarity(spark):
    r = random.Random(3)
    pairs = [(i, *(" ".join(r.choices(["aa", "abc", "b", "cab"], k=r.randint(0, 6))) for _ in range(2))) for i in range(40)]
    df = spark.createDataFrame(pairs, "k long, source string, target string")
    got = {x.k: x for x in similarity.composite(df, "k").collect()}
    for k, a, b in pairs:
        assert got[k].chrf == pytest.approx(plain_chrf(a, b))
        x, y = Counter(a.split()), Counter(b.split())
        total = sum(x.values()) + sum(y.values())
        assert got[k].token_f1 == pytest.approx(2 * sum((x & y).values()) / total if total else 1.0)
    labels = spark.createDataFrame([("[ГРЕЧЕСКОЕ слово: альфа] _x_ (y) [Illustration: a]",)], "t string").select(similarity.plain(F.col("t"))).first()[0]
    assert labels == "альфа x y a"


def test_multiset_minus(spark):
    r = random.Random(4)
    rows = [([str(r.randint(0, 5)) for _ in range(r.randint(0, 12))], [str(r.randint(0, 5)) for _ in range(r.randint(0, 12))]) for _ in range(50)]
    df = spark.createDataFrame(rows, "a array<string>, b array<string>")
    assert [x[0] for x in df.select(multiset_minus(F.col("a"), F.col("b"))).collect()] == [sorted((Counter(a) - Counter(b)).elements()) for a, b in rows]


def test_guards(spark):
    cases = [
        ("4 men, 1 234 and 22-1/2", "4 1234 22-1/2", True), ("sixteen and 3", "16 3", True), ("seventeen", "17", False), ("24th of 1,234", "1 234", False), ("7", "7 7", False), ("7", "", False),
    ]
    df = spark.createDataFrame(cases, "s string, t string, ok boolean")
    assert all(r.g == r.ok for r in df.select("ok", gates.local_numeric_guard(F.col("s"), F.col("t"))["passed"].alias("g")).collect())
    rows = [
        ("a (b) 5", "б", "б (в) 5", False, []), ("a (b) 5", "б", "б (в 5", False, ["delimiters"]), ("a 5", "б", "", False, ["empty", "numeric", "numeric_order", "length"]),
        ("one word 5", "слово", "слово word 5", True, ["strong_intervention_gate", "new_unprotected_latin"]), ("5", "5", "5", False, ["identity"]),
    ]
    df = spark.createDataFrame(rows, "s string, b string, c string, changed boolean, want array<string>")
    got = df.select("want", gates.row_objective(F.col("s"), F.col("b"), F.col("c"), F.col("changed")).alias("got")).collect()
    assert [r.got for r in got] == [r.want for r in got]
    absolute = spark.createDataFrame([("see 5", "вижу 5", []), ("see 5", "see", ["numeric_integrity", "explicit_numeric_order", "low_script_share"])], "s string, t string, want array<string>")
    assert all(r.got == r.want for r in absolute.select("want", gates.absolute_reasons(F.col("s"), F.col("t")).alias("got")).collect())
    total = spark.createDataFrame([([], 0.9, 0.9), (["x"], 0.9, None)], "failures array<string>, baseline_share double, share double")
    assert [tuple(gates.global_pass(x).first())[:2] + (gates.global_pass(x).first().passed,) for x in (total, total.filter("size(failures) = 0"))] == [(2, 1, False), (1, 0, True)]


def test_long_units_count_bare_runs(spark):
    df = spark.createDataFrame([(" ".join(["well-known"] * 40) + ".",), (" ".join(["known"] * 79) + ".",)], "t string")
    assert [r[0] for r in df.select(gates.suspicious_long(F.col("t"))).collect()] == [True, False]


def test_word_and_line_spans(spark):
    text = "Ab, c_d\r\n\n x😀y 12\rend"
    df = spark.createDataFrame([(1, text), (2, None), (3, ""), (4, "..")], "doc_id long, text string")
    runs = segments.word_runs(df).collect()
    assert [(r.doc_id, r.pos, r.word) for r in runs] == [(1, i, w) for i, w in enumerate(["Ab", "c_d", "x", "y", "12", "end"])] and all(text[r.start : r.end] == r.word for r in runs)
    lines = segments.line_spans(df.filter("doc_id = 1")).collect()
    flat = text.replace("\r\n", "\n").replace("\r", "\n")
    assert [r.text for r in lines] == flat.split("\n") and all(flat[r.start_char : r.end_char] == r.text for r in lines)
    chunks = segments.word_chunks(df, 4).collect()
    assert [(r.chunk, r.n_tokens) for r in chunks] == [(0, 4), (1, 2)] and chunks[0].end == chunks[1].start and chunks[1].end == len(text)


def test_positions_by_range(spark):
    rows = spark.range(500).selectExpr("id", "id % 3 as g").repartition(7)
    whole = {(r.id, r.i, r.n) for r in sampling.positions(rows, "g", ["id"]).collect()}
    assert {(r.id, r.i, r.n) for r in sampling.range_positions(rows, "g", ["id"]).collect()} == whole
    top = sampling.top_disjoint(rows.selectExpr("id as i", "g as score"), 3, spark.createDataFrame([(2,)], "i long")).collect()
    assert [(r.i, r.score) for r in top] == [(5, 2), (8, 2), (11, 2)]


def test_priority_and_versions(spark):
    rows = [("a", False, False, True, True, "incomplete_candidate", 1, "1.2.10"), ("b", False, False, True, True, "incomplete_candidate", 1, "1.10.2"), ("c", True, False, False, False, "x", None, None), ("d", False, False, True, True, "exact_version_structural_candidate", 0, "v0.0.1")]
    df = spark.createDataFrame(rows, "path string, identity_match boolean, catalog_match boolean, structural_complete boolean, runtime_ok boolean, status string, targets int, version string")
    assert [r.path for r in joins.by_priority(df).orderBy("place").collect()] == ["c", "d", "b", "a"]
    keys = spark.createDataFrame([("1.2.3-rc1",), ("x",), (None,)], "v string").select(joins.version_key(F.col("v")).alias("k")).collect()
    assert [tuple(r.k) for r in keys] == [(1, 2, 3), (-1, -1, -1), (-1, -1, -1)]


def test_records(spark):
    body = b"import x"
    digest = base64.urlsafe_b64encode(hashlib.sha256(body).digest()).rstrip(b"=").decode()
    box = io.BytesIO()
    with zipfile.ZipFile(box, "w") as z:
        z.writestr("p/a.py", body)
        z.writestr("p.dist-info/RECORD", f"p/a.py,sha256={digest},{len(body)}\np.dist-info/RECORD,,\n")
    found = archives.members(spark.createDataFrame([("w", bytearray(box.getvalue()))], "path string, content binary"))
    rows = archives.record_rows(found).collect()
    assert [(r.path, r.bytes, r.sha256) for r in rows] == [("p/a.py", 8, hashlib.sha256(body).hexdigest())]
    assert joins.manifest_check(archives.record_rows(found), found.filter("path not like '%RECORD'")).count() == 0


def test_versions(spark):
    imports = spark.createDataFrame([(1, "s", "txt", "utf-8", False)], "import_event_id long, source_sha256 string, selected_format string, selected_encoding string, force_text boolean")
    parts = spark.createDataFrame([(1, 1, 4, 5, None, None, "b"), (1, 0, 0, 3, 10, 20, "aéa")], "import_event_id long, sequence_number int, start_char int, end_char int, start_ms int, end_ms int, text string")
    found = versions.interpreted(imports, parts)
    row = found.first()
    names = sorted(versions.SEGMENT)
    own = [{"sequence_number": 0, "start_char": 0, "end_char": 3, "start_ms": 10, "end_ms": 20, "text": "aéa"}, {"sequence_number": 1, "start_char": 4, "end_char": 5, "start_ms": None, "end_ms": None, "text": "b"}]
    assert row.segments_sha256 == ledger.sha(own) and sorted(own[0]) == names and (row.content_text, row.char_count, row.segment_count) == ("aéa\nb", 5, 2)
    identity = {k: row[k] for k in versions.IDENTITY}
    assert row.interpretation_key == ledger.sha(identity)
    assert [r.cache_hit for r in versions.versions(found, found).collect()] == [True] and not versions.versions(found, found.filter("false")).first().cache_hit
    with pytest.raises(Exception, match="drift"):
        versions.versions(found, found.withColumn("segment_count", F.lit(9))).collect()
    assert versions.one(found, "import_event_id", 1)["char_count"] == 5
    with pytest.raises(KeyError):
        versions.one(found, "import_event_id", 2)
    items = spark.createDataFrame([(1, "a", 2, 9, '{"k":"v"}'), (1, "a", 1, 8, "{}"), (1, "b", 0, 7, "{}"), (2, "a", 0, 6, "{}")], "run_id long, kind string, sequence_number int, id long, payload_json string")
    assert [(r.id, r.payload) for r in versions.items_of(items, 1, "a").collect()] == [(8, {}), (9, {"k": "v"})] and versions.items_of(items, 1).count() == 3
    segs = spark.createDataFrame([(1, 1, '{"a":"1"}'), (1, 0, "{}")], "document_version_id long, sequence_number int, metadata_json string")
    assert [r.metadata for r in versions.segments_of(segs, 1).collect()] == [{}, {"a": "1"}]


class Echo:
    """Two hypotheses for each probe: the first repeats it, the second is a word by its length."""

    name = "echo"

    def translate(self, texts, n):
        return [[(t, 0.0), ("слово" + "а" * (len(t) % 3), -1.0)][:n] for t in texts]


def test_dictionary(spark):
    senses = spark.createDataFrame([(1, 10, "ray", "VERB", "word", "dobj"), (2, 11, "red", "ADJ", "word", "amod")], "sense_id long, entry_id long, lemma string, pos string, entry_type string, dependency string")
    found = dictionary.evidence(senses, Echo, 2)
    rows = {(r.sense_id, r.probe_kind, r["rank"]): (r.accepted, r.reason) for r in found.collect()}
    assert rows[1, "titlecase", 0] == (False, "identity") and rows[1, "titlecase", 1] == (True, None) and all(ok == (rank == 1) for (_, _, rank), (ok, _) in rows.items())
    best = dictionary.candidates(found)
    s = dictionary.provider_summary(found, best).first()
    assert (s.senses, s.entries, s.repaired, s.rejected) == (2, 2, 1, sum(not ok for ok, _ in rows.values())) and s.candidates == best.count()
    assert {r.sense_id: r.translation[:5] for r in dictionary.translated(senses, Echo, 2).collect()} == {1: "слово", 2: "слово"}
    with pytest.raises(stages.StageError):
        dictionary.translated(senses, Echo, 1)
    assert [r.sense_id for r in dictionary.senses_of(senses.select("sense_id", "entry_id"), senses.drop("sense_id"), [2]).collect()] == [2]
    run = spark.createDataFrame([(1, 5), (1, 6), (2, 7)], "sense_id long, candidate_id long")
    words = spark.createDataFrame([(5, "а", 0.5), (6, "б", 0.9), (7, "в", 0.1)], "candidate_id long, translation string, final_score double")
    picks = spark.createDataFrame([(1, 3, 1, True, "approved")], "sense_id long, selection_id long, run_id long, is_current boolean, status string")
    runs = spark.createDataFrame([(1,)], "run_id long")
    levels = spark.createDataFrame([("Ray", "B1")], "headword string, level string")
    sounds = spark.createDataFrame([("ray", "r ei")], "word string, pronunciation string")
    chain = dictionary.chain(senses.select("sense_id", "lemma"), picks, runs, (run, words, words), levels, sounds).collect()
    assert {(r.sense_id, r.translation, r.selection_id, r.level, r.pronunciation) for r in chain} == {(1, "б", 3, "B1", "r ei"), (2, "в", None, None, None)}
    with pytest.raises(stages.StageError):
        dictionary.chain(senses.select("sense_id", "lemma"), picks, runs, (run, words, words.filter("candidate_id < 7")), levels, sounds)


def test_cards(spark, tmp_path):
    path, made = str(tmp_path / "cards.jsonl"), []

    def make(sense_id):
        made.append(sense_id)
        return {"card_revision_id": 100 + sense_id}

    cards = dictionary.Cards(path, [3, 1, 2])
    m = cards.advance(make, most=2)
    assert (m["completed"], m["complete"], m["completed_now"]) == (2, False, 2)
    table = spark.createDataFrame([(101, "a"), (102, "b"), (103, "c")], "card_revision_id long, front string")
    with pytest.raises(stages.StageError):
        cards.assembled(spark, table)
    with open(path, "a") as f:
        f.write('{"body": "torn')
    m = cards.advance(make)
    assert m["complete"] and made == [3, 1, 2] and m["card_revision_ids"] == [103, 101, 102] and cards.advance(make)["completed_now"] == 0
    rows = cards.assembled(spark, table).collect()
    assert [r.front for r in rows] == ["c", "a", "b"] and {r.set_revision for r in rows} == {cards.manifest()["fingerprint"]}
    with pytest.raises(stages.StageError):
        cards.assembled(spark, table.filter("front <> 'a'"))
    with pytest.raises(stages.StageError):
        dictionary.Cards(path, [1, 3, 2]).records()
    lines = open(path).read().split("\n")
    record = json.loads(lines[1])
    lines[1] = json.dumps(record | {"body": record["body"].replace("101", "999")})
    open(path, "w").write("\n".join(lines))
    with pytest.raises(stages.StageError):
        cards.records()
    with pytest.raises(stages.StageError):
        dictionary.Cards(str(tmp_path / "other"), [1]).advance(lambda s: {"card_revision_id": True})


def test_ledger_lock_and_requirements(spark, tmp_path):
    book = ledger.Ledger(spark, str(tmp_path / "led"), patience=0.2)
    run = book.step(10, "impl", {}, {}, lambda r: {"real": True})
    assert book.required(run.run_id, 10, real=True) == {"real": True}
    for stage, flags in ((12, {}), (10, {"real": False}), (10, {"approved": True})):
        with pytest.raises(RuntimeError):
            book.required(run.run_id, stage, **flags)
    (tmp_path / "led.lock").touch()
    with pytest.raises(RuntimeError, match="another writer"):
        book.begin(11, "impl", {}, {})


def test_kept_tables(spark):
    df = kept(spark.range(5).withColumn("r", F.rand()), "x")
    assert df.collect() == df.collect()
    clear(spark)
    assert shared_dir(spark)
    with pytest.raises(Exception):
        df.collect()


def test_control(spark, tmp_path):
    (tmp_path / "a.txt").write_text("some text")
    book = registry.Registry()
    book.add("plan", registry.Contract(12, "plan", "plan/1", parameters={"size": 96}, result=("id",)), lambda spark, size: spark.range(size))
    profile = control.Profile({"units": "plan"}, {"plan": {"size": 5}}, {"short": lambda c: c["units"]["size"] < 10})
    assert profile.configuration(book) == {"units": {"size": 5}} and profile.warnings(book) == []
    assert control.Profile({}, {"plan": {"size": 96}}).warnings(book) == ["override of unused operation plan", "plan.size is the default"]
    for bad in (control.Profile({"x": "no"}), control.Profile({"units": "plan"}, {}, {"short": lambda c: c["units"]["size"] < 10})):
        with pytest.raises(control.ControlError):
            bad.configuration(book)
    frozen = control.preflight(spark, str(tmp_path / "a.txt"), profile, book)
    state = control.RunState(str(tmp_path / "state.json"), frozen)
    calls = []
    assert [state.step("one", lambda: calls.append(1) or {"n": 3}) for _ in range(2)] == [{"n": 3}] * 2 and calls == [1]
    with pytest.raises(ZeroDivisionError):
        state.step("two", lambda: 1 / 0)
    with pytest.raises(control.ControlError, match="blocked by two"):
        state.step("three", lambda: {})
    state.release("looked at it")
    pairs = spark.createDataFrame([(1, "a (b) 5", "a b 5"), (2, "a", "b")], "segment_id long, source string, target string")
    found = control.gate_set(state, pairs, ("punctuation", "length", "numeric"), terminal=("punctuation",))
    assert not found["passed"] and [v["verdict"] for v in found["gates"].values()] == ["failed", "not counted", "not counted"]
    assert found["gates"]["punctuation"]["issues_sha256"] == hashlib.sha256(b"1").hexdigest() and control.gate_set(state, pairs.limit(0), ("length",)) == found
    with pytest.raises(control.ControlError):
        control.gate_set(state, pairs, ("nothing",))
    (tmp_path / "a.txt").write_text("other text")
    with pytest.raises(control.ControlError, match="other inputs"):
        control.RunState(str(tmp_path / "state.json"), control.preflight(spark, str(tmp_path / "a.txt"), profile, book))
    changed = json.loads((tmp_path / "state.json").read_text())
    changed["steps"]["one"]["result"] = {"n": 4}
    (tmp_path / "state.json").write_text(json.dumps(changed))
    with pytest.raises(control.ControlError, match="was changed"):
        state.read()
    engine = control.Engine(spark, book, spark.createDataFrame([("completed",)], "status string"))
    assert engine.call("plan", size=2).count() == 2 and engine.project()["runs"] == {"completed": 1} and engine.project()["operations"]["available"] == 1
    assert control.sources_of({"a": "one.n"}, {"one": {"n": 3}}) == {"a": 3}
    with pytest.raises(control.ControlError):
        control.sources_of({"a": "one.m"}, {"one": {"n": 3}})
    ok = {"schema": "s/1", "id": 4, "rows": []}
    assert control.checked(ok, ("id",), "s/1", {"id": 4}) == ok
    for bad in ({"required": ("x",)}, {"required": (), "schema": "s/2"}, {"required": (), "same": {"id": 5}}, {"required": (), "most_bytes": 5}):
        with pytest.raises(control.ControlError):
            control.checked(ok, **bad)
    names = spark.createDataFrame([("a", 1), ("a", 1), ("b", 2)], "name string, value int")
    assert control.agreed(names) == {"a": 1, "b": 2}
    with pytest.raises(control.ControlError):
        control.agreed(names.union(spark.createDataFrame([("b", 3)], "name string, value int")))


def test_capabilities_and_catalogue(spark):
    have = providers.Capabilities("en", "3.8.16", frozenset({"parser"}))
    assert have.lacks("en", frozenset({"parser"}), "3.8.2") == [] and have.lacks("ru", frozenset({"ner"}), "3.10") == ["language ru", "version 3.10", "feature ner"]
    files = spark.createDataFrame([("core-1.zip", 5, "x"), ("core-2.zip", 6, "y"), ("other", 1, "z")], "name string, bytes long, sha256 string")
    rules = spark.createDataFrame([("core-?.zip", 5, "x"), ("core-2*", None, None), ("core-2.zip", 6, "n")], "pattern string, bytes long, sha256 string")
    got = {(r.name, r.pattern, r.verdict) for r in joins.catalogue_verdicts(files, rules).collect()}
    assert got == {("core-1.zip", "core-?.zip", "exact"), ("core-2.zip", "core-?.zip", "size"), ("core-2.zip", "core-2*", "name_only"), ("core-2.zip", "core-2.zip", "hash")}
