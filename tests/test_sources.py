"""Files, subtitles, archives, exports, the ledger, providers and streams."""

import io
import json
import zipfile

import pytest
from pyspark.sql import functions as F

from spanloom import catalogue
from spanloom.operators import gates, lexical
from spanloom.plans import ledger, providers, registry, stages
from spanloom.sources import archives, export, ingest, subtitles
from spanloom.streaming import imports

SRT = "1\n00:00:01,000 --> 00:00:02,500\n<i>Hello</i>   world.\n\n2\n00:00:03,000 --> 00:00:05,000\nNumber 42.\n"
VTT = "WEBVTT\n\nNOTE a comment\nmore\n\nintro\n00:01.000 --> 00:03.500 align:start\nHello\n\n00:04.000 --> 00:05.000\n&lt;b&gt;\n"
ASS = "[Script Info]\nTitle: x\n[Events]\nFormat: Layer, Start, End, Style, Text\nDialogue: 0,0:00:01.00,0:00:03.50,Default,{\\i1}Hello\\Nworld, again\n"


def test_cues(spark):
    df = spark.createDataFrame([(1, "srt", SRT), (2, "vtt", VTT), (3, "ass", ASS), (4, "txt", "a\r\nb")], "doc_id long, format string, text string")
    rows = subtitles.interpret(df).orderBy("doc_id", "seq").collect()
    got = [(r.doc_id, r.start_ms, r.end_ms, r.text) for r in rows]
    assert got == [
        (1, 1000, 2500, "Hello world."), (1, 3000, 5000, "Number 42."), (2, 1000, 3500, "Hello"), (2, 4000, 5000, "<b>"), (3, 1000, 3500, "Hello\nworld, again"), (4, None, None, "a\nb"),
    ]
    content = {r.doc_id: r.content for r in subtitles.content(subtitles.interpret(df)).collect()}
    assert all(content[r.doc_id][r.start_char : r.end_char] == r.text for r in rows)
    assert rows[2].metadata["cue_id"] == "intro" and rows[4].metadata["style"] == "Default"


@pytest.mark.parametrize(
    "kind,text",
    [("srt", "only prose"), ("srt", "1\n00:00:05,000 --> 00:00:01,000\nx"), ("vtt", "WEBVTT\n\nid\nno time"), ("ass", "[Events]\nDialogue: 0,x"), ("txt", " \n"), ("doc", "x"), ("srt", "1\n0:0 --> 1\nx")],
)
def test_broken_files_are_refused(spark, kind, text):
    with pytest.raises(subtitles.SubtitleError):
        subtitles.segments(kind, text)
    df = spark.createDataFrame([(1, kind, text)], "doc_id long, format string, text string")
    assert subtitles.broken(df).count() == 1 and subtitles.interpret(df, "drop").count() == 0


def test_import_and_decoding(spark, tmp_path):
    (tmp_path / "a.txt").write_bytes(b"\xef\xbb\xbfna\xc3\xafve")
    (tmp_path / "b.txt").write_bytes("zwei".encode("utf-16"))
    (tmp_path / "c.txt").write_bytes(b"plain")
    (tmp_path / "d.txt").write_bytes(b"plain")
    files = ingest.read_files(spark, str(tmp_path))
    text = {r.path.rsplit("/")[-1]: (r.d.text, r.d.encoding) for r in files.select("path", ingest.decoded(F.col("content")).alias("d")).collect()}
    assert text == {"a.txt": ("naïve", "utf-8-sig"), "b.txt": ("zwei", "utf-16"), "c.txt": ("plain", "utf-8"), "d.txt": ("plain", "utf-8")}
    first = ingest.new_imports(files, files.filter("false"))
    assert first.count() == 3 and first.filter("cache_hit").count() == 0
    assert ingest.new_imports(files, first).filter("not cache_hit").count() == 0
    bad = spark.createDataFrame([(bytearray(b"\xff\xff\x00"),)], "content binary")
    with pytest.raises(Exception, match="encoding|CHARACTER_CODING"):
        bad.select(ingest.decoded(F.col("content"))).collect()
    (tmp_path / "t").mkdir()
    (tmp_path / "t" / "r.csv").write_text("headword,pos\nrun,verb\n")
    assert ingest.pinned_csv(spark, str(tmp_path / "t/r.csv"), ["headword", "pos"], 1).count() == 1
    with pytest.raises(ValueError):
        ingest.pinned_csv(spark, str(tmp_path / "t/r.csv"), ["headword", "pos"], 2)


def archive(**files: bytes) -> bytes:
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        for name, data in files.items():
            z.writestr(name.replace("__", "/"), data)
    return out.getvalue()


def test_archives(spark):
    inner = archive(**{"deep.txt": b"needle"})
    box = archive(**{"a__b.txt": b"x needle y needle", "n.zip": inner})
    df = spark.createDataFrame([("one.zip", bytearray(box))], "path string, content binary")
    found = archives.members(df, depth=2)
    assert {r.path for r in found.collect()} == {"a/b.txt", "n.zip", "n.zip!deep.txt"}
    hits = archives.keyword_hits(found.filter("path like '%txt'").withColumn("text", F.col("content").cast("string")), ["needle"]).collect()
    assert {(h.path, h.offset) for h in hits} == {("a/b.txt", 2), ("a/b.txt", 11), ("n.zip!deep.txt", 0)}
    for bad in (archive(**{"..__up": b""}), archive(big=b"0" * 100)):
        with pytest.raises(Exception, match="unsafe|larger"):
            archives.members(spark.createDataFrame([("x", bytearray(bad))], "path string, content binary"), most_bytes=50).collect()


def test_exports(spark, tmp_path):
    df = spark.createDataFrame([(1, "a|b"), (2, None)], "i int, s string")
    for kind in export.FORMATS:
        export.export(df, str(tmp_path / kind), kind)
    assert spark.read.json(str(tmp_path / "jsonl")).count() == 2
    assert "a\\|b" in export.markdown(df) and "<td>a|b</td>" in export.report("t", {"x": df})
    export.write_artifact(df, str(tmp_path / "art"))
    assert export.read_artifact(spark, str(tmp_path / "art")).count() == 2
    first = export.manifest_of(spark, str(tmp_path / "art"))
    again = export.write_artifact(df.limit(1), str(tmp_path / "art"), revision="r2")
    assert again["data"] != first["data"] and export.read_artifact(spark, str(tmp_path / "art")).count() == 1
    cards = df.withColumn("set_revision", F.concat(F.lit("r"), "i"))
    assert export.export_revision(cards, str(tmp_path / "out"), "r1")["rows"] == 1 and spark.read.json(str(tmp_path / "out/jsonl")).first().i == 1
    with pytest.raises(ValueError):
        export.export_revision(cards, str(tmp_path / "out2"), "r9")
    df.write.mode("overwrite").parquet(str(tmp_path / "art" / again["data"]))
    with pytest.raises(ValueError):
        export.read_artifact(spark, str(tmp_path / "art"))


def test_ledger(spark, tmp_path):
    book = ledger.Ledger(spark, str(tmp_path / "ledger"))
    calls = []
    work = lambda run: calls.append(run) or {"rows": 3}
    first = book.step(8, "impl", {"x": 1}, {"b": 2, "a": float("inf")}, work)
    again = book.step(8, "impl", {"x": 1}, {"a": float("inf"), "b": 2}, work)
    assert not first.cache_hit and again.cache_hit and again.output == {"rows": 3} and len(calls) == 1
    with pytest.raises(ZeroDivisionError):
        book.step(9, "impl", {}, {}, lambda run: 1 / 0)
    assert {r.run_id: r.status for r in book.runs().collect()} == {1: "completed", 2: "failed"}
    assert not book.begin(9, "impl", {}, {}).cache_hit
    with pytest.raises(RuntimeError):
        book.begin(9, "impl", {}, {})
    with pytest.raises(ValueError):
        ledger.canonical(float("nan"))


def test_journal(spark, tmp_path):
    rows = ledger.chained([{"card": i} for i in range(5)])
    path = tmp_path / "j.jsonl"
    path.write_text("\n".join(rows) + '\n{"body": "torn')
    journal = ledger.read_journal(spark, str(path))
    assert journal.count() == 5 and ledger.chain_breaks(journal).count() == 0
    rows[2] = rows[2].replace('\\"card\\":2', '\\"card\\":7')
    path.write_text("\n".join(rows) + "\n")
    assert [(r.pos, r.problem) for r in ledger.chain_breaks(ledger.read_journal(spark, str(path))).collect()] == [(2, "hash")]
    del rows[1]
    path.write_text("\n".join(rows) + "\n")
    assert (1, "hash") in [(r.pos, r.problem) for r in ledger.chain_breaks(ledger.read_journal(spark, str(path))).collect()]


class WordTagger:
    """For tests: words as nouns, stops as punctuation; it stands for no real tagger."""

    name = "test"

    def tag(self, text):
        import re

        out, sentence = [], 0
        for i, m in enumerate(re.finditer(r"\w+|[^\w\s]", text)):
            word = m[0]
            out.append({
                "token_index": i, "start": m.start(), "end": m.end(), "text": word, "lemma": word.lower(), "lower": word.lower(), "pos": "NOUN" if word[0].isalpha() else "NUM" if word.isdigit() else "PUNCT",
                "tag": "", "dependency": "", "head_token_index": i, "sentence_index": sentence, "entity_type": None, "is_oov": False,
            })
            sentence += word == "."
        return out


class Echo:
    """For tests: n equal hypotheses that keep figures and marks."""

    name = "echo"

    def translate(self, texts, n):
        return [[(f"перевод {t}", -0.1 * k) for k in range(n)] for t in texts]


class Broken(Echo):
    def translate(self, texts, n):
        return super().translate(texts, n)[:-1]


def test_stage_chain(spark):
    docs = spark.createDataFrame([(1, "The ray bends. The ray bends 42 times."), (2, "A ray.")], "doc_id long, text string")
    out = stages.run(docs, WordTagger, Echo, preferred=4)
    assert out.units.filter("doc_id = 1").orderBy("seq").first().source == "The ray bends. "
    assert "".join(r.source for r in out.units.filter("doc_id = 1").orderBy("seq").collect()) == "The ray bends. The ray bends 42 times."
    assert out.entries.count() == 5 and out.occurrences.count() == 9
    assert sum(r.occurrence_count for r in out.senses.collect()) == 9
    with pytest.raises(Exception, match="not all answered"):
        providers.translate(docs.select(F.col("doc_id").cast("string").alias("key"), "text"), Broken).collect()
    with pytest.raises(stages.StageError):
        stages.run(docs, WordTagger, Echo, quality={"bad": gates.Gate(lambda p: p, lambda: F.lit(True))})
    assert providers.Capabilities(features=frozenset({"pos"})).lacks("en", frozenset({"pos", "ner"})) == ["feature ner"]


def test_registry(spark):
    r = registry.Registry()
    r.add("ids", registry.Contract(1, "ids", "v1", parameters={"n": 3}, result=("id",)), lambda s, n: s.range(n))
    r.add("later", registry.Contract(2, "later", "none", available=False), lambda s: s.range(1))
    assert r.call("ids", spark, n=5).count() == 5 and r.counts() == {"available": 1, "declared_only": 1}
    with pytest.raises(TypeError):
        r.call("ids", spark, m=1)
    with pytest.raises(RuntimeError):
        r.call("later", spark)
    assert r.matching(stage=1) == "ids" and registry.default_configuration(r, {"ids": {"n": 4}}) == {"ids": {"n": 4}}
    with pytest.raises(LookupError):
        r.matching(stage=9)
    assert registry.source_overrides("srt") == {"preferred": 12} and registry.preferred(["a", "b"], {"b"}) == "b"


def test_streaming_import(spark, tmp_path):
    src, book, mark = tmp_path / "in", str(tmp_path / "book"), str(tmp_path / "mark")
    src.mkdir()
    (src / "a").write_bytes(b"one")
    (src / "b").write_bytes(b"one")
    imports.import_stream(spark, str(src), book, mark).awaitTermination()
    assert imports.imported(spark, book).count() == 1
    (src / "c").write_bytes(b"one")
    (src / "d").write_bytes(b"two")
    imports.import_stream(spark, str(src), book, mark).awaitTermination()
    assert imports.imported(spark, book).count() == 2


def test_lexical_rules(spark):
    rows = [
        (1, "rays", "ray", "VERB", "obj", "ORG", True), (2, "Ada", "Ada", "PROPN", "nsubj", "PERSON", False), (3, "42", "42", "NUM", "", None, False), (4, "runs", "run", "VERB", "ROOT", None, False),
    ]
    t = spark.createDataFrame(rows, "i int, text string, lemma string, pos string, dependency string, entity_type string, is_oov boolean")
    out = {r.i: r for r in lexical.repaired(t).collect()}
    assert out[1].pos == "NOUN" and out[1].entity_type is None and out[1].is_oov is False and len(out[1].repairs) == 3
    assert out[2].entity_type == "PERSON" and out[2].repairs == [] and out[4].pos == "VERB"
    assert {r.i for r in lexical.eligible(lexical.repaired(t)).collect()} == {1, 2, 4}
    cases = [
        ("word", [("ray", "NOUN")], True, "content_pos"), ("abbreviation", [("DNA", "X")], True, "alphabetic_abbreviation"), ("word", [("the", "DET")], False, "non_dictionary_pos:DET"),
        ("word", [("B2", "X")], False, "numeric_or_designation"), ("idiom", [("of", "ADP"), ("course", "NOUN")], True, "dictionary_mwe_with_content_head"),
        ("sentence", [("a", "DET"), ("b", "NOUN")], False, "non_dictionary_mwe:sentence"), ("idiom", [("of", "ADP"), ("the", "DET")], False, "mwe_without_content_pos"), ("word", [], False, "no_token_evidence"),
        ("word", [("x", "INTJ")], False, "unsupported_pos:INTJ"),
    ]
    df = spark.createDataFrame(cases, "kind string, tokens array<struct<text:string,pos:string>>, ok boolean, reason string")
    for r in df.select("ok", "reason", lexical.dictionary_eligibility(F.col("kind"), F.col("tokens")).alias("g")).collect():
        assert (r.g.ok, r.g.reason) == (r.ok, r.reason)


def test_enrichment(spark):
    q = spark.createDataFrame([("run", "VERB", "word", ""), ("ray", "NOUN", "word", ""), ("bend", "VERB", "word", "obj"), ("give up", "VERB", "phrasal_verb", ""), ("Blue", "ADJ", "word", "")], "lemma string, pos string, kind string, dep string")
    got = {r.lemma: [(p.kind, p.text, p.base) for p in r.p] for r in q.select("lemma", lexical.probes(F.col("lemma"), F.col("pos"), F.col("kind"), F.col("dep")).alias("p")).collect()}
    assert got["run"][0] == ("verb_argument", "to run something", 0.98) and [k for k, _, _ in got["bend"]] == ["titlecase", "lemma"]
    assert got["Blue"] == [("adjective_copula", "is Blue", 0.98), ("lemma", "Blue", 0.9)] and got["give up"][2][2] == 0.78
    cases = [
        ("ray", "луч", "word", None), ("ray", "", "word", "empty"), ("ray", "Ray!", "word", "identity"), ("ray", "beam", "word", "no_cyrillic"), ("ray", "луч x", "word", "latin_leakage"),
        ("ray", "луч 5", "word", "unlicensed_numeric_addition"), ("ray", "-луч", "word", "leading_symbol_noise"), ("go", "чтобы идти", "word", "synthetic_probe_wrapper"), ("give up", "сдаться", "phrasal_verb", "incomplete_multiword_translation"),
    ]
    df = spark.createDataFrame(cases, "lemma string, target string, kind string, want string")
    keyed = df.withColumn("a", lexical.lexical_key(F.col("lemma"))).withColumn("b", lexical.lexical_key(F.col("target")))
    for r in keyed.select("*", lexical.admissibility(F.col("lemma"), F.col("target"), F.col("kind"), F.col("a"), F.col("b")).alias("got")).collect():
        assert r.got == r.want, r
    score = spark.createDataFrame([(0, 0.98, "VERB", "идти", "word", 0.99), (2, 0.84, "VERB", "идти", "word", 0.92), (1, 0.9, "NOUN", "луч", "word", 0.855), (0, 0.68, "VERB", "ход", "word", 0.52)], "rank int, base double, pos string, key string, kind string, want double")
    for r in score.select("want", lexical.confidence(*[F.col(c) for c in ("rank", "base", "pos", "key", "kind")]).alias("got")).collect():
        assert r.got == pytest.approx(r.want)
    c = spark.createDataFrame([("l", f"t{i % 10}", f"T{i}", i / 100, 0.5) for i in range(30)], "lemma string, target_key string, translation string, confidence double, compatibility double")
    best = lexical.best_candidates(c).orderBy("place").collect()
    assert [b.translation for b in best] == [f"T{i}" for i in range(29, 21, -1)]
    words = spark.createDataFrame([("give up",), ("ray",), ("no way",)], "form string")
    d = spark.createDataFrame([("give", "gIv"), ("up", "Vp"), ("ray", "reI"), ("way", "weI")], "word string, pronunciation string")
    assert {r.form: r.pronunciation for r in lexical.pronounced(words, d).collect()} == {"give up": "gIv Vp", "ray": "reI", "no way": None}
    levels = spark.createDataFrame([("Ray", "B2")], "headword string, level string")
    assert {r.form: r.level for r in lexical.looked_up(words, levels).collect()} == {"give up": None, "ray": "B2", "no way": None}
    sel = spark.createDataFrame([(1, 10, 5, "approved", False), (1, 11, 5, "approved", True), (1, 12, 5, "approved", False), (2, 13, 6, "draft", True)], "sense_id int, selection_id int, run_id int, status string, is_current boolean")
    assert [(r.sense_id, r.selection_id) for r in lexical.current_examples(sel, spark.createDataFrame([(5,), (6,)], "run_id int")).collect()] == [(1, 11)]
    snap = spark.createDataFrame([("ray", [("луч", 0.9)])], "lemma string, candidates array<struct<translation:string,confidence:double>>")
    s = spark.createDataFrame([(1, "ray")], "sense_id int, lemma string")
    assert lexical.arbitrated(s, snap).first().primary.translation == "луч"
    with pytest.raises(Exception, match="no candidate"):
        lexical.arbitrated(spark.createDataFrame([(1, "none")], "sense_id int, lemma string"), snap).collect()


def test_artifacts_are_plain_json():
    assert json.loads(ledger.canonical({"b": [1, 2.5], "a": None})) == {"a": None, "b": [1, 2.5]}
    assert set(gates.GATES) == {"numeric", "punctuation", "length"}


def test_keyword_hits_without_a_cap(spark, monkeypatch):
    df = spark.createDataFrame([(1, "License rights " * 300)], "doc_id long, text string")
    assert archives.keyword_hits(df, ["License", "rights"], "doc_id").count() == 200
    assert archives.keyword_hits(df, ["License", "rights"], "doc_id", most=None).count() == 600
    caps, plain = [], archives.keyword_hits
    monkeypatch.setattr(catalogue, "table", lambda *_: df)
    monkeypatch.setattr(archives, "keyword_hits", lambda *a, **k: caps.append(k.get("most", 200)) or plain(*a, **k))
    assert catalogue.keyword_hits(spark, "").count() == 600 and caps == [None]
