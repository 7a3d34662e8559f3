"""Each operator against a plain version, on tables with nulls, empty and long texts, repeated rows and clashing columns."""

import hashlib
import math
import os
import random
import subprocess
import sys
import tracemalloc
import zlib
from collections import Counter, defaultdict
from pathlib import Path

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest

from spanloom.llm import decontaminate, exact_dedup, language_id, license_scan, lm_score, mixing, ngram_join, sharding, substring_dedup, url_filter
from spanloom.llm.common import pack, pack_ids, pieces, unpack, unpack_ids

from .conftest import words

LOW = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))


def tally(df, *columns):
    return Counter(tuple(r[c] for c in columns) for r in df.collect())


# Packing.


def test_packing_round_trip():
    r = np.random.default_rng(1)
    for n in (0, 1, 2, 1000):
        x = np.sort(r.integers(0, 2**63, n, dtype=np.uint64))
        assert (unpack(pack(x)) == x).all()
        ids = np.sort(r.integers(-(2**63), 2**63 - 1, n))
        assert (unpack_ids(pack_ids(ids)) == ids).all()


def test_pieces_keep_words(monkeypatch):
    from spanloom.llm import common

    monkeypatch.setattr(common, "PIECE", 10)
    text = b"alpha beta  gamma\ndelta epsilon zeta eta theta iota kappa"
    assert [w for p in pieces(text) for w in p.split()] == text.split()


# 1 Language ID.


def test_language_held_out_accuracy(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    out = language_id.language_digest(docs).join(docs.select("doc_id", "lang"), "doc_id").filter("held_out").collect()
    assert len(out) > 30
    assert sum(r.lang == r.lang_pred for r in out) / len(out) >= 0.97
    assert all(0 <= r.score <= 1 for r in out)


def test_language_odd_rows(odd, nothing, plain_rows):
    out = language_id.language_digest(odd).collect()
    assert len(out) == len(plain_rows)
    for r in out:
        if r.doc_id in (4, 5, 6, 10):
            assert (r.lang_pred, r.score) == ("und", 0.0)
        assert r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
    assert language_id.language_digest(nothing).count() == 0
    wide = language_id.identify(odd, name="label")  # replaces that column, keeps the others
    assert sorted(wide.columns) == sorted(odd.columns)
    assert wide.agg({"score": "max"}).first()[0] == 0.5 and tally(wide.select("doc_id", "label.score"), "doc_id", "score") == tally(language_id.language_digest(odd), "doc_id", "score")


def brute_features(text):
    """Counts of the 1- to 3-grams of the folded text, by bucket."""
    t = "".join(c.lower()[0] if c.isalpha() else " " for c in text)
    t = " " + " ".join(t.split()) + " "
    out = Counter()
    for n in (1, 2, 3):
        for i in range(len(t) - n + 1):
            h = 0
            for c in t[i : i + n]:
                h = (h * 0x01000193 + ord(c)) & 0xFFFFFFFF
            x = ((h ^ (n * 0x9E3779B1 & 0xFFFFFFFF)) * 0x85EBCA6B) & 0xFFFFFFFF
            x = ((x ^ (x >> 13)) * 0xC2B2AE35) & 0xFFFFFFFF
            out[x >> (32 - language_id.BITS)] += 1
    return out


@pytest.mark.parametrize("piece", [1, 2, 3, 7, 1 << 20])
def test_language_features_against_plain_counts(monkeypatch, piece):
    monkeypatch.setattr(language_id, "PIECE", piece)
    for text in ("a", " a ", "Hello,  World! 12 ñandú 漢字", "  x--y  ", "𝒳yz 😀 ß", words(40, 3), "ab1", "1 2 c"):
        assert dict(zip(*(x.tolist() for x in language_id.features(text.encode())))) == brute_features(text), text
    assert language_id.features(b"12 34 !!") is None and language_id.features(b"") is None and language_id.features(None) is None


def test_language_training_against_plain_ftrl():
    """The sparse updates are those of the published per-coordinate rule, one coordinate after the other."""
    r = np.random.default_rng(2)
    d, k, n = 6, 3, 12
    samples = [(np.sort(r.choice(d, 3, replace=False)), r.integers(1, 5, 3), int(r.integers(0, k))) for _ in range(n)]
    alpha, beta, l1, l2 = 2.0, 1.0, 0.02, 0.002
    model = language_id.train_ftrl(samples, list("abc"), np.ones(d), alpha, beta, l1, l2, epochs=2)
    z, sq, zb, sb = [[0.0] * k for _ in range(d)], [[0.0] * k for _ in range(d)], [0.0] * k, [0.0] * k

    def w(z, n):
        return 0.0 if abs(z) <= l1 else -(z - math.copysign(l1, z)) / ((beta + math.sqrt(n)) / alpha + l2)

    for epoch in range(2):
        for i in np.random.default_rng(5 + epoch).permutation(np.random.default_rng(5).permutation(n)):
            at, counts, y = samples[i]
            x = [1 + math.log(c) for c in counts]
            norm = math.sqrt(sum(v * v for v in x))
            x = [v / norm for v in x]
            s = [sum(v * w(z[a][c], sq[a][c]) for a, v in zip(at, x)) - zb[c] / ((beta + math.sqrt(sb[c])) / alpha + l2) for c in range(k)]
            e = [math.exp(v - max(s)) for v in s]
            for c in range(k):
                g = e[c] / sum(e) - (c == y)
                for a, v in zip(at, x):
                    new = sq[a][c] + (g * v) ** 2
                    z[a][c] += g * v - (math.sqrt(new) - math.sqrt(sq[a][c])) / alpha * w(z[a][c], sq[a][c])
                    sq[a][c] = new
                wb = -zb[c] / ((beta + math.sqrt(sb[c])) / alpha + l2)
                zb[c] += g - (math.sqrt(sb[c] + g * g) - math.sqrt(sb[c])) / alpha * wb
                sb[c] += g * g
    want = [[w(z[a][c], sq[a][c]) for c in range(k)] for a in range(d)]
    assert np.allclose(model.weights, want, atol=1e-6)


def test_every_language_is_learned(spark):
    rows = [(i, " ".join([f"{chr(97 + i % 26)}{chr(97 + i // 26 % 26)}x"] * 8), f"l{i % 676}") for i in range(676 * 2)]
    model = language_id.train(spark.createDataFrame(rows, "doc_id long, text string, lang string"), max_train=100)
    assert len(model.langs) > 100


def test_language_nothing_to_learn(odd):
    from pyspark.sql import functions as F

    out = language_id.identify(odd.withColumn("lang", F.lit(None).cast("string")))
    assert {(r.language.lang_pred, r.language.score) for r in out.collect()} == {("und", 0.0)}


def test_temperature_makes_labels_likeliest():
    r = np.random.default_rng(0)
    y = r.integers(0, 3, 400)
    logits = np.eye(3)[y] * 2 + r.normal(0, 1, (400, 3))
    t = language_id.temperature(logits * 5, y)
    assert t == pytest.approx(5 * language_id.temperature(logits, y), rel=0.02)


# 2 Substring dedup.


def brute_removed(docs, window):
    """(n_words, n_removed, kept_sha256) of each row; ``docs`` are (id, th, text), of which equal ones are one place."""
    seen, out = set(), {}
    for d in sorted(set(docs), key=lambda d: (d[0] is not None, d[0] or 0, d[1])):
        w = (d[2] or "").encode().split()
        gone = [False] * len(w)
        for i in range(len(w) - window + 1):
            k = tuple(w[i : i + window])
            if k in seen:
                gone[i : i + window] = [True] * window
            seen.add(k)
        kept = [x for x, g in zip(w, gone) if not g]
        out[d] = len(w), len(w) - len(kept), hashlib.sha256(b" ".join(kept)).hexdigest()
    return Counter((d[0], *out[d]) for d in docs)


def with_hash(df):
    from pyspark.sql import functions as F

    return [tuple(r) for r in df.select("doc_id", F.xxhash64(F.col("text").cast("binary")), "text").collect()]


@pytest.mark.parametrize("window", [20, 7])
def test_repeats_against_brute_force(odd, window):
    got = tally(substring_dedup.remove_repeats(odd, window), "doc_id", "n_words", "n_removed", "kept_sha256")
    want = brute_removed(with_hash(odd), window)
    assert got == want and sum(n for (i, _, removed, _), n in got.items() if i is None and removed) == 1


def test_repeats_told_apart_by_text(odd, monkeypatch):
    from spanloom.llm import common

    monkeypatch.setattr(common, "FEW_IDS", 0)  # every row is told apart by its text
    got = tally(substring_dedup.remove_repeats(odd), "doc_id", "n_words", "n_removed", "kept_sha256")
    assert got == brute_removed(with_hash(odd), 20)


def test_repeats_on_tables(spark, sf, nothing):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    got = tally(substring_dedup.remove_repeats(docs), "doc_id", "n_words", "n_removed", "kept_sha256")
    assert got == brute_removed(with_hash(docs), 20)
    kept = substring_dedup.remove_repeats(docs, keep_text=True).collect()
    assert all(hashlib.sha256(r.kept_text.encode()).hexdigest() == r.kept_sha256 for r in kept)
    assert substring_dedup.remove_repeats(nothing).count() == 0


def test_full_filter_changes_nothing(odd, monkeypatch):
    from pyspark.sql import functions as F

    a = substring_dedup.remove_repeats(odd).select("doc_id", "n_removed", "kept_sha256")
    monkeypatch.setattr(substring_dedup, "FILTER_BITS", 8)
    b = substring_dedup.remove_repeats(odd).select("doc_id", "n_removed", "kept_sha256")
    assert a.exceptAll(b).agg(F.count("*")).first()[0] == 0


# 3 Sharding.


@pytest.mark.parametrize("n", [1, 2, 3, 17, 256, 1000, 4097])
def test_feistel_is_a_permutation(n):
    out = sharding.feistel(np.arange(n), n)
    assert sorted(out) == list(range(n))
    assert (sharding.feistel(np.arange(n)[::-1].copy(), n)[::-1] == out).all()
    if n > 200:
        assert (out != np.arange(n)).mean() > 0.9 and (sharding.feistel(np.arange(n), n, seed=7) != out).mean() > 0.9


def test_shards(odd, nothing, plain_rows):
    out = sharding.shard_digest(odd, 5).collect()
    assert len(out) == len(plain_rows)
    by = {}
    for r in out:
        by.setdefault(r.shard, []).append(r.slot)
        assert r.law == "rows" and r.grown_shard is None
    assert all(sorted(s) == list(range(len(s))) for s in by.values())
    assert max(map(len, by.values())) - min(map(len, by.values())) <= 1
    want = Counter((i, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for i, t, _ in plain_rows)
    assert Counter((r.doc_id, r["size"], r.text_crc32) for r in out) == want
    again = tally(sharding.shard_digest(odd.repartition(7), 5), "doc_id", "shard", "slot")
    repeated = {3, 7}
    assert {k for k in again if k[0] not in repeated} == {(r.doc_id, r.shard, r.slot) for r in out if r.doc_id not in repeated}
    assert sharding.shard_digest(nothing, 5).count() == 0


# 4 Decontamination.


def test_leaks(spark):
    items = [(1, "the quick brown fox jumps over the lazy dog while seven wizards quietly juggle bright copper coins"), (2, "pack my box"), (3, None), (4, ""), (5, "only two")]
    exact = items[0][1]
    edited = exact.replace("lazy", "sleepy").replace("copper", "silver")
    docs = [
        (1, f"intro words here. {exact.upper()}! and more"),
        (2, f"something else, {edited} the end"),
        (3, "the quick brown bird walks under a tree and nothing else of that text occurs in here at all, so there"),
        (4, "please, pack my box."),
        (5, None),
        (6, ""),
        (7, "these only two"),
        (None, exact),
        (8, "word " * 5000 + exact),
    ]
    d = spark.createDataFrame(docs, "doc_id long, text string")
    b = spark.createDataFrame(items, "item_id long, text string")
    got = {(r.doc_id, r.item_id): (r.score, r.start_word, r.end_word) for r in decontaminate.find_leaks(d, b).collect()}
    assert set(got) == {(1, 1), (2, 1), (4, 2), (7, 5), (None, 1), (8, 1)}
    assert got[1, 1] == (1.0, 3, 20) and 0.5 <= got[2, 1][0] < 1 and got[8, 1][1] == 5000
    kept = {r.doc_id for r in decontaminate.drop_leaks(d, b).collect()}
    assert kept == {3, 5, 6}
    blocks = {(r.doc_id, r.item_id) for r in decontaminate.find_leaks(d, b, block_bytes=100).collect()}
    assert blocks == set(got)
    assert decontaminate.find_leaks(d, b.filter("false")).count() == 0 and decontaminate.find_leaks(d.filter("false"), b).count() == 0


def test_leaks_against_alignment_of_all_pairs(spark):
    r = random.Random(11)
    vocabulary = [f"w{i}" for i in range(60)]
    items = [(0, " ".join(f"a{i}" for i in range(23)))] + [(k, " ".join(r.choices(vocabulary, k=k))) for k in range(1, 25)]
    edits = {
        "exact": lambda w: w,
        "every 5th replaced": lambda w: ["zz" if i % 5 == 2 else x for i, x in enumerate(w)],
        "every 3rd replaced": lambda w: ["zz" if i % 3 == 2 else x for i, x in enumerate(w)],
        "a word after each": lambda w: [y for x in w for y in (x, "zz")],
        "a word after each second": lambda w: [y for i, x in enumerate(w) for y in ((x, "zz") if i % 2 else (x,))],
        "every 4th dropped": lambda w: [x for i, x in enumerate(w) if i % 4],
        "second half": lambda w: w[len(w) // 2 :],
    }
    texts = [" ".join(["before", *r.choices(vocabulary, k=5), *edit(t.split()), *r.choices(vocabulary, k=5)]) for _, t in items for edit in edits.values()]
    texts += [" ".join(edits["every 5th replaced"](items[0][1].split()))] * 20 + [" ".join(r.choices(vocabulary, k=80)) for _ in range(20)]
    folded = {t: decontaminate.FOLDED.of(t.encode()) for t in [*texts, *(t for _, t in items)]}
    for threshold in (0.5, 0.7):
        want = {}
        for d, text in enumerate(texts):
            for k, item in items:
                score = decontaminate.smith_waterman(folded[item], folded[text])[0] / (2 * len(folded[item]))
                if score >= threshold:
                    want[d, k] = score
        found = decontaminate.find_leaks(
            spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"), threshold=threshold
        ).collect()
        assert {(f.doc_id, f.item_id): f.score for f in found} == want and len(found) == len(want)


def test_leaks_odd_rows(spark, odd, nothing):
    """Repeated rows and items, ties between places, clashing columns, very long texts."""
    item = words(50, 2)  # the passage of some rows
    items = spark.createDataFrame([(1, item, 5, "t"), (1, item, 5, "t"), (None, words(60, 9), 1, "u"), (2, None, 0, "v")], "item_id long, text string, doc_id long, leak string")
    got = tally(decontaminate.find_leaks(odd, items), "doc_id", "item_id", "score", "start_word")
    assert got == Counter({(11, 1, 1.0, 40): 2, (11, 1, 1.0, 25): 2, (12, 1, 1.0, 30): 2, (None, 1, 1.0, 30): 2, (None, 1, 1.0, 0): 2, (None, None, 1.0, 0): 1})
    kept = decontaminate.drop_leaks(odd.withColumnRenamed("label", "leak"), items)
    assert "leak" in kept.columns and {r.doc_id for r in kept.collect()} == {r.doc_id for r in odd.collect()} - {11, 12, None}
    twice = spark.createDataFrame([(1, f"{item} and {item}"), (2, "z" * 600_000 + " " + item)], "doc_id long, text string")
    assert tally(decontaminate.find_leaks(twice, items.limit(1)), "doc_id", "start_word", "end_word") == Counter([(1, 0, 50), (2, 1, 51)])
    assert decontaminate.find_leaks(nothing, items).count() == 0 and decontaminate.find_leaks(odd, items.filter("false")).count() == 0


def test_smith_waterman_against_plain_recursion():
    r = np.random.default_rng(3)
    for _ in range(60):
        a, b = r.integers(0, 4, r.integers(1, 12)).astype(np.uint64), r.integers(0, 4, r.integers(0, 15)).astype(np.uint64)
        h = np.zeros((len(a) + 1, len(b) + 1), int)
        for i in range(1, len(a) + 1):
            for j in range(1, len(b) + 1):
                h[i, j] = max(0, h[i - 1, j - 1] + (2 if a[i - 1] == b[j - 1] else -1), h[i - 1, j] - 1, h[i, j - 1] - 1)
        score, start, end = decontaminate.smith_waterman(a, b)
        assert score == h.max() and 0 <= start <= end <= len(b)


# 5 Mixing.


def test_mixing_meets_targets(spark):
    r = np.random.default_rng(4)
    rows = [(i, "w " * int(r.integers(1, 40)), ["en", "fr", "de"][int(r.integers(0, 3)) if i % 4 else 0], f"s{i % 5 if i % 3 else 0}", "x") for i in range(2000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, mix string")
    targets = {"lang": {"en": 0.5, "fr": 0.3, "de": 0.2}}
    out = mixing.mix(docs, targets=targets, budget=0.5).select("doc_id", "lang", "source", "mix.*").collect()
    assert len(out) == 2000
    total = sum(x.tokens for x in out)
    for lang, share in targets["lang"].items():
        assert sum(x.tokens * x.weight for x in out if x.lang == lang) / total == pytest.approx(share, rel=1e-4)
    assert sum(x.tokens * x.probability for x in out) / total == pytest.approx(0.5, rel=1e-6)
    assert sum(x.tokens for x in out if x.kept) / total == pytest.approx(0.5, abs=0.06)
    assert all(0 <= x.probability <= 1 for x in out)
    # The plain fitting loop gives the same weights.
    cells = Counter()
    for x in out:
        cells[x.source, x.lang] += x.tokens
    w = {k: v / total for k, v in cells.items()}
    margin = Counter()
    for (s, _), v in cells.items():
        margin[s] += v / total
    norm = sum(math.sqrt(v) for v in margin.values())
    for _ in range(300):
        for dim, goal in ((0, {s: math.sqrt(v) / norm for s, v in margin.items()}), (1, targets["lang"])):
            held = Counter()
            for k, v in w.items():
                held[k[dim]] += v
            w = {k: v * goal[k[dim]] / held[k[dim]] for k, v in w.items()}
    for x in out:
        assert x.weight == pytest.approx(w[x.source, x.lang] * total / cells[x.source, x.lang], rel=1e-4)


def test_mixing_targets_left_out_or_out_of_reach(spark):
    rows = [(i, "w " * (1 + i % 7), ["en", "fr"][i % 2], ["a", "b"][i % 4 // 2], 1.5, True, "x") for i in range(80)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, _odds_ratio double, kept boolean, topic string")
    out = mixing.mix(docs, targets={"lang": {"en": 1.0}})
    assert out.columns == [*docs.columns, "mix"]
    out = out.collect()
    assert all((r.mix.weight > 0) == (r.lang == "en") and (r.lang == "en" or not r.mix.kept) and r.mix.off <= 1e-6 for r in out)
    none = mixing.mix(docs, targets={"lang": {"xx": 1.0}}).collect()
    assert not any(r.mix.kept for r in none)
    with pytest.raises(ValueError):
        mixing.mix(docs, targets={"lang": {"en": -1.0}})
    # English only in source a, French only in b: these margins contradict each other.
    tied = docs.filter("(lang = 'en') = (source = 'a')")
    with pytest.warns(UserWarning):
        out = mixing.mix(tied, targets={"lang": {"en": 0.9, "fr": 0.1}, "source": {"a": 0.2, "b": 0.8}}).collect()
    assert all(r.mix.off > 0.1 for r in out)
    by_topic = mixing.mix(docs, targets={"topic": {"0": 0.75, "1": 0.25}}, topic=(docs.doc_id % 8 < 4).cast("int")).collect()
    total = sum(r.mix.tokens for r in by_topic)
    assert sum(r.mix.tokens * r.mix.weight for r in by_topic if r.mix.topic == "0") / total == pytest.approx(0.75, rel=1e-4)


def test_saturated_scale_against_bisection(spark):
    r = np.random.default_rng(7)
    cells = [(int(t), float(x)) for t, x in zip(r.integers(1, 1000, 40), np.round(r.exponential(1, 40), 1))]
    df = spark.createDataFrame(cells, "tokens long, ratio double")
    total = sum(t for t, _ in cells)
    for budget in (0.01, 0.4, 0.8, 0.9):
        s = mixing.saturated_scale(df, budget)
        assert sum(t * min(1, s * x) for t, x in cells) == pytest.approx(budget * total)
    assert all(min(1, mixing.saturated_scale(df, 1.0) * x) == 1 for _, x in cells if x)


def test_mixing_plans_each_margin_once(spark, monkeypatch):
    """The driver plans three aggregates for a margin, whatever margins were joined before it."""
    plans, table = {}, mixing.Scratch.table

    def told(self, df, name, *partition_by):
        plans[name] = df._jdf.queryExecution().optimizedPlan().toString()
        return table(self, df, name, *partition_by)

    monkeypatch.setattr(mixing.Scratch, "table", told)
    docs = spark.createDataFrame([(i, "a b c", "xyz"[i % 3], "pq"[i % 2]) for i in range(12)], "doc_id long, text string, lang string, source string")
    assert mixing.mix(docs).count() == 12
    assert plans["start"].count("Aggregate") <= 3 * len(mixing.DIMS)


def test_mixing_odd_rows(odd, nothing, plain_rows):
    out = mixing.mix_digest(odd).collect()
    assert len(out) == len(plain_rows)
    assert all(not r.kept and r.weight == 0 for r in out if r.doc_id in (4, 5, 6))
    fates = {}
    for r in out:
        if r.doc_id in (3, 7):
            fates.setdefault(r.doc_id, set()).add(r.kept)
    assert all(len(f) == 1 for f in fates.values())
    assert mixing.mix_digest(nothing).count() == 0


# 6 URL filters.


def test_url_rules(spark):
    from spanloom.llm.queries import URL_GLOBS, URL_RULES

    urls = [
        ("http://A.Example.NET/en/x?q", "allow", "example.net/en/"),
        ("https://example.net/EN/x", "block", "net/"),
        ("https://x.net", "allow", None),
        ("https://x.net/", "block", "net/"),
        ("https://notexample.com/de/1", "allow", None),
        ("https://example.com/de/1#a", "block", "example.com/de/"),
        ("https://a.org/fr/cheap-pills.", "allow", "org/fr/"),
        ("https://cheap-pills.example.com/en", "block", None),
        ("https://x.com/y.net/en/", "allow", None),
        ("ftp://h?://x.net/", "allow", None),
        ("no scheme", "allow", None),
        ("", "allow", None),
        (None, "allow", None),
        ("http://" + "a" * 3000 + ".net/" + "b" * 3000, "block", "net/"),
    ]
    df = spark.createDataFrame([(i, u, "h", "p", "r") for i, (u, _, _) in enumerate(urls)], "page_id long, url string, host string, path string, rule string")
    got = {r.page_id: r for r in url_filter.filter_urls(df, URL_RULES, URL_GLOBS).collect()}
    for i, (url, verdict, rule) in enumerate(urls):
        assert (got[i].verdict, got[i].rule) == (verdict, rule), url
    assert (got[0].host, got[0].path) == ("a.example.net", "/en/x") and (got[12].host, got[12].path) == ("", "")
    assert url_filter.filter_urls(df.filter("false"), URL_RULES).count() == 0


def test_automaton_against_regular_expressions():
    import random
    import re

    r = random.Random(5)
    patterns = ["".join(r.choices("ab/*^", k=r.randint(1, 9))) for _ in range(60)]
    urls = ["".join(r.choices("ab/", k=r.randint(0, 10))) for _ in range(300)]
    hit = url_filter.Automaton(patterns).match([u.encode() for u in urls])
    for j, p in enumerate(patterns):
        rx = re.compile("".join({"*": ".*", "^": "[^/]*"}.get(c, re.escape(c)) for c in p))
        for i, u in enumerate(urls):
            assert hit[i, j] == bool(rx.fullmatch(u)), (p, u)


# 7 LM scoring.


def brute_word(lattice, s):
    """Sum over all segmentations, one by one."""
    if not s:
        return 1.0
    total = 0.0
    for i in range(1, len(s) + 1):
        lp = lattice.prefixes.get(s[:i])
        if lp is not None:
            total += math.exp(lp) * brute_word(lattice, s[i:])
    if lattice.prefixes.get(s[0]) is None:
        total += math.exp(len(s[0].encode()) * lattice.byte) * brute_word(lattice, s[1:])
    return total


@pytest.mark.parametrize("word", ["a", "hello", "ñandú", "x😀y", "wwwwww"])
def test_lattice_sums_all_segmentations(word):
    lattice = lm_score.Lattice.load()
    assert lattice.word(word.encode()) == pytest.approx(math.log10(brute_word(lattice, lm_score.WORD_START + word)))


def test_lattice_pieces_are_a_distribution():
    lattice = lm_score.Lattice.load()
    total = sum(math.exp(v) for v in lattice.prefixes.values() if v is not None) + 256 * math.exp(lattice.byte) + math.exp(lattice.end)
    assert total == pytest.approx(1.0)


@pytest.mark.parametrize("head", [1 << 17, 700, 0])
def test_lm_scores(odd, plain_rows, head):
    out = lm_score.score_texts(odd, head_words=head).collect()
    assert len(out) == len(plain_rows)
    tokens = [(i, (t or "").encode().translate(LOW).split()) for i, t, _ in plain_rows]
    held = lambda i: i is not None and zlib.crc32(str(i).encode()) % 7 == 2
    c = Counter(w for i, ws in tokens if not held(i) for w in [*ws, None])
    n, v, lattice = sum(c.values()), len(c), lm_score.Lattice.load()
    word = {w: lattice.word(w) for _, ws in tokens for w in ws}
    want = []
    for i, ws in tokens:
        base = sum(math.log10((c[w] + 1) / (n + v + 1)) for w in [*ws, None])
        want.append((held(i), len(ws) + 1, sum(c[w] > 0 for w in [*ws, None]), n, round(base, 6), round(sum(word[w] for w in ws) + lattice.end / math.log(10), 6), -1 if i is None else i))
    got = [(r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6), round(r.score, 6), -1 if r.doc_id is None else r.doc_id) for r in out]
    assert sorted(got) == sorted(want)


def test_head_threshold(spark):
    counts = spark.createDataFrame([(f"w{i}", c) for i, c in enumerate([1] * 50 + [2] * 20 + [9] * 5 + [1000, 10**6])], "word string, c long")
    for most, least in ((0, None), (1, 10**6), (6, 1000), (7, 9), (26, 9), (27, 2), (76, 2), (77, 1)):
        assert lm_score.head_threshold(counts, most) == least


def test_lm_empty(nothing):
    assert lm_score.score_texts(nothing).count() == 0


# 8 License scans.


def test_licenses(spark):
    t = license_scan.TEMPLATES
    mit = t["MIT"].split()
    changed = " ".join(w for i, w in enumerate(mit) if i % 12)
    docs = [
        (1, "prose before\n" + t["MIT"] + "\nprose after"),
        (2, "x y z " + changed),
        (3, "This is not a license at all, but it says software and copyright."),
        (4, "Released under the MIT License."),
        (5, None),
        (6, ""),
        (None, t["ISC"].lower()),
        (7, ("some words " * 4000) + t["Apache-2.0-notice"]),
        (8, "All rights reserved. foo. All rights reserved."),
    ]
    got = {r.doc_id: r for r in license_scan.scan_licenses(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert {k: r.license for k, r in got.items()} == {
        1: "MIT", 2: "MIT", 3: None, 4: "MIT-notice", 5: None, 6: None, None: "ISC", 7: "Apache-2.0-notice", 8: "All-rights-reserved",
    }
    assert got[1].coverage == 1.0 and got[1].start_word == 2 and 0.85 < got[2].coverage < 1 and got[7].start_word == 8000 and got[8].n_found == 2
    assert license_scan.scan_licenses(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_repeated_license_lines(spark):
    t = license_scan.TEMPLATES
    line, mit = t["All-rights-reserved"], t["MIT-notice"]
    docs = [(n, "some prose\n" + f"{line}\n" * n + "other prose") for n in (1, 2, 3, 4, 50)]
    docs += [(100 + n, f"some prose {f'{mit} ' * n}other prose") for n in (1, 2, 5)] + [(200, f"x {t['ISC']} {t['ISC']} y")]
    got = {r.doc_id: (r.license, r.coverage, r.n_found) for r in license_scan.scan_licenses(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert got == {n: ("All-rights-reserved", 1.0, n) for n in (1, 2, 3, 4, 50)} | {100 + n: ("MIT-notice", 1.0, n) for n in (1, 2, 5)} | {200: ("ISC", 1.0, 2)}


def test_licenses_that_differ_by_a_word(spark):
    t = license_scan.TEMPLATES
    gnu = "This work is licensed under the GNU General Public License"
    want = {f"before {text} after": name for name, text in t.items()} | {
        "Licensed under the MIT License.": "MIT-notice",
        "Released under the XYZ License.": None,
        "Released under the MIT-0 License.": None,
        "Licensed under CC BY-XX 4.0.": None,
        "Licensed under CC BY-NC 3.0.": None,
        "Licensed under the Apache License, Version 1.1.": None,
        "Licensed under the Apache License 2.0.": "Apache-2.0-notice",
        f"{gnu} v3.": "GPL-3.0-notice",
        f"{gnu} v2.": "GPL-2.0-notice",
        f"{gnu}, version 1.": None,
        t["GPL-3.0-header"].replace("version 3", "version 1"): None,
    }
    docs = list(enumerate(want))
    got = {r.doc_id: r.license for r in license_scan.scan_licenses(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert {text: got[i] for i, text in docs} == want


def test_licenses_against_alignment_everywhere(spark):
    """Templates aligned at every place of whole texts find no copy that the seeds miss."""
    r = random.Random(14)
    names = sorted(license_scan.TEMPLATES)
    wanted = {n: license_scan.FOLDED.of(license_scan.TEMPLATES[n].encode()) for n in names}
    noise = "the of and license software this under version public general copy any rights may permission".split()
    texts = ["Released under this MIT License.", "All the rights are reserved", "x Licensed under CC BY 4 0"]
    for n in names:
        own = license_scan.TEMPLATES[n].split()
        for _ in range(3 if len(own) > 40 else 8):
            t = [w for w in own if r.random() > 0.12]
            for _ in range(r.randint(0, max(1, len(own) // 8))):
                t.insert(r.randint(0, len(t)), r.choice(noise))
            texts.append(" ".join(r.choices(noise, k=6) + t + r.choices(noise, k=6)))
    phrases = {n: [license_scan._choices(p) for p in license_scan.DISTINCT.get(n, ())] for n in names}
    fillers = frozenset(license_scan.FOLDED.of(" ".join(license_scan.FILLERS).encode()).tolist())
    want = {}
    for d, text in enumerate(texts):
        words = license_scan.FOLDED.of(text.encode())
        found = []
        for n in names:
            length = len(wanted[n])
            for start in range(-license_scan._slack(length), len(words)):
                for m, a, z in license_scan._copies(words, wanted[n].tolist(), np.array([start]), 0.8):
                    if z - a <= length + license_scan._slack(length) and license_scan._holds(words[a : z + 2].tolist(), phrases[n], fillers):
                        found.append((m, n))
        want[d] = max(found, default=(0, None))[0]
    out = license_scan.scan_licenses(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    got = {x.doc_id: x.matched_words for x in out}
    assert got[0] == 4 and sum(map(bool, want.values())) > 80
    assert {d: w for d, w in want.items() if got[d] < w} == {}


def test_license_odd_rows(spark, odd, nothing, plain_rows):
    out = license_scan.scan_licenses(odd).collect()
    assert Counter(x.doc_id for x in out) == Counter(r[0] for r in plain_rows) and all(x.license is None and x.n_found == 0 for x in out)
    assert license_scan.scan_licenses(nothing).count() == 0
    tied = [(1, "MIT License. Released under the MIT License. Released under the ISC License."), (1, "y" * 300_000 + " All rights reserved."), (None, None)] * 2
    got = license_scan.scan_licenses(spark.createDataFrame([(*t, "l", 1.0) for t in tied], "doc_id long, text string, license string, coverage double")).collect()
    assert Counter((x.doc_id, x.license, x.n_found) for x in got) == Counter([(1, "MIT-notice", 2), (1, "All-rights-reserved", 1), (None, None, 0)] * 2)


def test_patience_against_plain_recursion():
    """The recursion as it is published, with slices."""

    def plain(a, b):
        head = 0
        while head < min(len(a), len(b)) and a[head] == b[head]:
            head += 1
        tail = 0
        while tail < min(len(a), len(b)) - head and a[-1 - tail] == b[-1 - tail]:
            tail += 1
        edges = [(i, i) for i in range(head)] + [(len(a) - 1 - i, len(b) - 1 - i) for i in range(tail)]
        x, y = a[head : len(a) - tail], b[head : len(b) - tail]
        unique = [(i, y.index(v)) for i, v in enumerate(x) if x.count(v) == 1 and y.count(v) == 1]
        best = [unique[i] for i in license_scan.longest_increasing([j for _, j in unique])]
        if best:
            at = (0, 0)
            for i, j in [*best, (len(x), len(y))]:
                edges += [(head + at[0] + p, head + at[1] + q) for p, q in plain(x[at[0] : i], y[at[1] : j])]
                if i < len(x) or j < len(y):
                    edges.append((head + i, head + j))
                at = (i + 1, j + 1)
        return sorted(set(edges))

    def longest(values):
        best = [1] * len(values)
        for i, v in enumerate(values):
            best[i] = 1 + max((best[j] for j in range(i) if values[j] < v), default=0)
        return max(best, default=0)

    r = random.Random(16)
    for _ in range(300):
        a, b = ([r.randint(0, 12) for _ in range(r.randint(0, 14))] for _ in range(2))
        assert license_scan.patience(a, b) == plain(a, b)
        kept = license_scan.longest_increasing(a)
        assert len(kept) == longest(a) and all(a[i] < a[j] for i, j in zip(kept, kept[1:]))


def test_patience_is_a_common_subsequence():
    import random

    r = random.Random(6)
    for _ in range(200):
        a, b = ([r.randint(0, 8) for _ in range(r.randint(0, 14))] for _ in range(2))
        pairs = license_scan.patience(a, b)
        assert all(a[i] == b[j] for i, j in pairs)
        assert all(x[0] < y[0] and x[1] < y[1] for x, y in zip(pairs, pairs[1:]))
    same = [r.randint(0, 5) for _ in range(30)]
    assert len(license_scan.patience(same, same)) == 30


# 9 N-gram Jaccard join.


def brute_classes(docs, percent=80):
    """(n_shingles, component_id, class) of each row (id, text); a missing id counts as the largest."""
    sets = []
    for _, t in docs:
        w = (t or "").encode().translate(LOW).split()
        sets.append(frozenset([tuple(w)]) if 0 < len(w) < 5 else frozenset(tuple(w[k : k + 5]) for k in range(len(w) - 4)))
    least = list(range(len(docs)))

    def find(x):
        while least[x] != x:
            x = least[x]
        return x

    for x, a in enumerate(sets):
        for y in range(x + 1, len(sets)):
            both = len(a & sets[y])
            if both and 100 * both >= percent * len(a | sets[y]):
                least[max(find(x), find(y))] = min(find(x), find(y))
    ids = {}
    for x, (i, _) in enumerate(docs):
        ids.setdefault(find(x), []).append(i)
    known = {k: min((i for i in v if i is not None), default=None) for k, v in ids.items()}
    return [(len(sets[x]), known[find(x)], find(x)) for x in range(len(docs))]


def assert_classes(spark, docs, **options):
    got = ngram_join.similar_classes(spark.createDataFrame(docs, "doc_id long, text string").repartition(3), **options)
    want = brute_classes(docs)
    assert tally(got, "doc_id", "n_shingles", "component_id") == Counter((i, n, c) for (i, _), (n, c, _) in zip(docs, want))
    return want


def test_classes_odd_rows(spark, odd, nothing, plain_rows):
    docs = [r[:2] for r in plain_rows]
    want = brute_classes(docs)
    assert tally(ngram_join.similar_classes(odd), "doc_id", "n_shingles", "component_id") == Counter((i, n, c) for (i, _), (n, c, _) in zip(docs, want))
    assert ngram_join.similar_classes(nothing).count() == 0 and ngram_join.drop_similar(nothing).count() == 0
    kept = ngram_join.drop_similar(odd)
    assert kept.columns == odd.columns
    # One row of each class, and all rows without words.
    best = {}
    for (i, _), (n, _, k) in zip(docs, want):
        best.setdefault(k if n else (k, "alone"), []).append(i)
    least = [min(v, key=lambda i: (i is None, i or 0)) for v in best.values()]
    assert Counter(r.doc_id for r in kept.collect()) == Counter(least)


def test_classes_of_shared_and_missing_ids(spark):
    a, b, c = words(60, 31), words(60, 32), words(60, 33)
    near = lambda t: t + " tail"
    docs = [(1, a), (None, near(a)), (2, b), (None, near(b)), (None, c), (None, near(c)), (7, words(50, 34)), (7, words(50, 35)), (7, near(words(50, 34))), (8, near(words(50, 35)))]
    assert_classes(spark, docs * 2, name_bits=2)  # names of sets that clash
    kept = ngram_join.drop_similar(spark.createDataFrame(docs * 2, "doc_id long, text string"))
    assert Counter(r.doc_id for r in kept.collect()) == Counter([1, 2, None, 7, 7])


def test_classes_near_the_threshold(spark, monkeypatch):
    import random

    r = random.Random(8)
    docs, i = [], 0
    for size in (1, 4, 5, 6, 7, 9, 11, 14, 18, 30, 60, 200):
        base = [f"w{r.randint(0, 10**6)}" for _ in range(size)]
        for edits in (0, 0, 1, 1, 2, 3, 4, 6):
            t = base.copy()
            for _ in range(edits):
                k = r.randrange(len(t))
                t[k : k + r.randint(0, 1)] = [f"e{r.randint(0, 10**6)}"]
            docs.append((i, " ".join(t)))
            i += 1
    # Documents that share a very frequent passage, some little else, and near copies of these.
    common = " ".join(f"c{k}" for k in range(40))
    for k in range(150):
        own = [f"o{k}x{j}" for j in range(r.choice([1, 3, 8, 20]))]
        docs.append((i + 2 * k, common + " " + " ".join(own)))
        docs.append((i + 2 * k + 1, common + " " + " ".join(own[:-1] + ["z"] * r.randint(0, 2))))
    monkeypatch.setattr(ngram_join, "PAIR_ROWS", 5)  # salted signatures
    assert_classes(spark, docs, buckets=2)


def test_large_sets_travel_only_if_they_may_be_similar(spark, monkeypatch):
    """Large texts that share passages meet by their sketches; a near copy is found."""
    held, table = {}, ngram_join.Scratch.table

    def told(self, df, name, *partition_by):
        held[name] = table(self, df, name, *partition_by)
        return held[name]

    monkeypatch.setattr(ngram_join.Scratch, "table", told)
    shared = " ".join(f"s{j}" for j in range(2_000))
    docs = [(i, shared + " " + " ".join(f"o{i}x{j}" for j in range(1_500))) for i in range(6)]
    docs.append((9, docs[0][1].replace("o0x700", "changed")))
    got = ngram_join.similar_classes(spark.createDataFrame(docs, "doc_id long, text string"))
    assert {r.doc_id: r.component_id for r in got.collect()} == {**{i: i for i in range(6)}, 9: 0}
    asked, fit = (sum(held[f"{name}{k}"].count() for k in range(3)) for name in ("pairs", "fit"))
    assert asked >= 5 and fit <= 2


def test_wide_sketches_are_exact():
    r = np.random.default_rng(10)
    for n, m in ((600, 600), (700, 800), (5_000, 6_000), (100, 700)):
        for both in (n, n - n // 12, n - n // 9, n - n // 8, 0):
            x = r.integers(0, 2**64 - 1, n, dtype=np.uint64)
            y = np.append(x[:both], r.integers(0, 2**64 - 1, m - both, dtype=np.uint64))
            may = ngram_join._may(*(pd.Series([v]) for v in (ngram_join.wide_parity(x), ngram_join.wide_parity(y), n + m, 80)))[0]
            assert may or 100 * both < 80 * (n + m - both)
            assert not may or both or min(n, m) <= 512
    assert ngram_join.wide_parity(x[:512]) is None


def test_buckets_grow_in_proportion():
    size = ngram_join.BUCKET_KEYS
    assert [ngram_join.bucket_count(k * size) for k in (0, 17, 27, 135)] == [16, 17, 27, 135]


def test_similar_sets_share_a_signature():
    r = np.random.default_rng(9)
    none = np.zeros(1 << 13, np.uint8)
    some = np.packbits(r.random(1 << 16) < 0.6, bitorder="little")
    found = 0
    for frequent in (none, some, ~none):
        for percent in (80, 60):
            for _ in range(400):
                n = int(r.integers(1, 300 if r.random() < 0.5 else 25))
                s = np.unique(r.integers(0, 2**64, n, dtype=np.uint64))
                gone, new = int(r.integers(0, len(s) // 6 + 1)), int(r.integers(0, len(s) // 6 + 1))
                other = np.unique(np.concatenate([r.choice(s, len(s) - gone, replace=False), r.integers(0, 2**64, new, dtype=np.uint64)]))
                both = len(np.intersect1d(s, other))
                if 100 * both >= percent * (len(s) + len(other) - both) and len(s) + len(other) > 2 * both:
                    sig, of = ngram_join.signatures(np.concatenate([s, other]), np.array([0, len(s), len(s) + len(other)]), frequent, percent)
                    assert len(np.intersect1d(sig[of == 0], sig[of == 1]))
                    found += 1
    assert found > 500


def test_shapes_leave_an_equal_subset():
    for k in range(1, 400):
        n1, n2, k2 = ngram_join.shape(k)
        assert n1 * (k2 + 1) > k and 0 < k2 < n2


def test_shingle_sets_against_plain_words():
    import pyarrow as pa

    r = random.Random(12)
    texts = ["".join(r.choices("aAbB \n\t", k=r.choice([0, 2, 9, 200]))) for _ in range(200)] + [None, "x" * 600_000 + " y", words(90_000, 13)]
    found = {}
    for i, j, x, at in ngram_join.shingle_sets(pa.array([None if t is None else t.encode() for t in texts], pa.binary()), 5):
        for k in range(j - i):
            found[i + k] = x[at[k] : at[k + 1]].tolist()
    names = {}
    for i, t in enumerate(texts):
        w = (t or "").lower().split()
        want = {tuple(w)} if 0 < len(w) < 5 else {tuple(w[k : k + 5]) for k in range(len(w) - 4)}
        assert len(found[i]) == len(want) and sorted(found[i]) == found[i]
        if len(want) == 1:
            assert names.setdefault(next(iter(want)), found[i][0]) == found[i][0]
    assert len(set(names.values())) == len(names)


# 10 Exact dedup.


def brute_groups(docs):
    groups = {}
    for i, t in docs:
        t = t or ""
        norm = "".join(c for c in t if c not in " \t\n\x0b\x0c\r")
        groups.setdefault(norm, []).append((-len(t), i is None, i or 0, i))
    out = Counter()
    for norm, g in groups.items():
        keep = min(g)[3]
        for x in g:
            out[x[3], keep, len(g), hashlib.sha256(norm.encode()).hexdigest()] += 1
    return out


def test_exact_groups(spark, odd, nothing, plain_rows):
    from pyspark.sql import functions as F

    want = brute_groups([r[:2] for r in plain_rows])
    out = exact_dedup.exact_dedup(odd)
    assert tally(out, "doc_id", "keep_id", "group_size", "text_sha256") == want
    assert all(r.kept == (r.doc_id == r.keep_id) for r in out.collect())
    # A weak hash makes collisions, which the chains must part by bytes; a small capacity splits buckets.
    weak = exact_dedup.exact_dedup(odd, capacity=1, key_of=lambda t: F.unhex(F.concat(F.lit("0"), F.substring(F.sha2(t.cast("binary"), 256), 1, 1), F.lit("AAAA"))))
    assert tally(weak, "doc_id", "keep_id", "group_size", "text_sha256") == want
    assert exact_dedup.exact_dedup(nothing).count() == 0


def test_directory_splits_overfull_buckets(spark):
    keys = spark.range(4096).selectExpr("cast(id * 16 as int) as slot", "1 as n")
    d = exact_dedup.directory(keys, 64).collect()
    counts = Counter(r.bucket for r in d)
    assert len(d) == 4096 and max(counts.values()) <= 64 and len(counts) == 64


def test_directory_against_doubling(spark):
    """One bucket that doubles and splits, step by step, gives the same buckets."""
    r = random.Random(17)
    slots = {s: r.choice([1, 1, 2, 50]) for s in r.sample(range(1 << 16), 300)} | {7 << 8 | i: 30 for i in range(6)}
    buckets = [(0, list(slots))]
    while any(d < 16 and sum(slots[s] for s in held) > 40 for d, held in buckets):
        d, held = next((d, h) for d, h in buckets if d < 16 and sum(slots[s] for s in h) > 40)
        buckets.remove((d, held))
        buckets += [(d + 1, [s for s in held if (s >> (15 - d)) & 1 == bit]) for bit in (0, 1)]
    got = {}
    for x in exact_dedup.directory(spark.createDataFrame(list(slots.items()), "slot int, n long"), 40).collect():
        got.setdefault(x.bucket, set()).add(x.slot)
    assert sorted(map(sorted, got.values())) == sorted(sorted(h) for _, h in buckets if h)


def test_results_come_through_the_directory(odd, monkeypatch):
    """Slots that the directory lacks have no bucket, so their rows are not found."""
    whole = exact_dedup.directory
    monkeypatch.setattr(exact_dedup, "directory", lambda slots, capacity: whole(slots, capacity).filter("slot % 2 = 0"))
    out = exact_dedup.exact_dedup(odd).collect()
    assert 0 < len(out) < odd.count() and all(int(x.text_sha256[:4], 16) % 2 == 0 for x in out)


def test_join_keys_cost_little_beyond_their_spacing():
    """Keys and names of the join travel in two bits a number at most (on average) beyond the log of their mean difference."""
    r = np.random.default_rng(2)
    top = np.uint64((1 << 64) - 1)
    for values in (np.empty(0, np.uint64), np.array([7], np.uint64), np.array([0, top], np.uint64), np.full(5, top), np.arange(17, dtype=np.uint64), np.append(np.arange(300, dtype=np.uint64), top)):
        assert ngram_join.unpack_tight(ngram_join.pack_tight(values)).tolist() == values.tolist()
    for bits, n in ((46, 4096), (46, 1500), (64, 700), (30, 5000)):
        values = np.sort(r.integers(0, (1 << bits) - 1, n, dtype=np.uint64))
        blob = ngram_join.pack_tight(values)
        assert (ngram_join.unpack_tight(blob) == values).all()
        assert len(blob) - 13 <= n * (bits - math.log2(n) + 2) / 8 + 8
    names = np.sort(r.integers(-(1 << 63), (1 << 63) - 1, 50))
    assert (ngram_join._unpack_names(ngram_join._pack_names(names)) == names).all()


def test_workers_of_the_pipeline_load_no_pandas():
    """Each Python worker holds its modules for itself, two and more an executor."""
    stages = "language_id, ngram_join, decontaminate, mixing, sharding"
    code = f"import sys; from spanloom.llm import {stages}; assert 'pandas' not in sys.modules"
    root = Path(ngram_join.__file__).parents[2]
    assert subprocess.run([sys.executable, "-c", code], cwd=root, env=os.environ | {"PYTHONPATH": str(root)}).returncode == 0


def test_a_bucket_meets_in_bounded_memory():
    """Signatures of one row go before the others are sorted and paired; those that their unit has again stay."""
    r, width = np.random.default_rng(3), np.uint64(ngram_join.UNIT_BITS + 1)
    rows, meets = [], defaultdict(set)
    for _ in range(32):
        nodes = np.sort(r.integers(-(2**62), 2**62, 1 << ngram_join.UNIT_BITS))
        sig = np.unique(r.integers(0, 1 << 24, 1 << 14, dtype=np.uint64))
        at, again = r.integers(0, len(nodes), len(sig)), r.random(len(sig)) < 0.01
        rows.append((0, ngram_join._pack_names(nodes), ngram_join.pack_tight((sig << width) | (again.astype(np.uint64) << (width - np.uint64(1))) | at.astype(np.uint64)), None))
        for s, d, m in zip(sig.tolist(), nodes[at].tolist(), again.tolist()):
            meets[s] |= {d, None} if m else {d}
    kinds = (pa.int32(), pa.binary(), pa.binary(), pa.binary())
    table = pa.table([pa.array([x[i] for x in rows], t) for i, t in enumerate(kinds)], names=["bucket", "nodes", "keys", "heads"])
    tracemalloc.start()
    got = ngram_join._meet(1)(table)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    wanted = [(s, d, min(own - {None})) for s, own in sorted(meets.items()) if len(own) > 1 for d in sorted(own - {None})]
    assert list(zip(*(got.column(c).to_pylist() for c in ("sig", "node", "centre")))) == wanted
    assert peak < 52 * 32 * (1 << 14)
    none = ngram_join._meet(1)(table.slice(0, 1).set_column(2, "keys", pa.array([ngram_join.pack_tight(np.array([1 << 20], np.uint64))])))
    assert none.num_rows == 0 and none.schema == got.schema
