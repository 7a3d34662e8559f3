"""Language identification: sparse multinomial logistic regression on TF-IDF character n-grams.

Trained with follow-the-regularised-leader under elastic-net penalties, then
calibrated with one temperature.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import FEW_IDS, Scratch, crc_mod, give_back, join_unique, lean

#: log2 of the hashed feature space, lengths of the n-grams, and slices by which counts are summed.
BITS, LENGTHS, SLICES = 15, (1, 2, 3), 16
UNKNOWN = "und"
#: Characters of a text that are hashed at once.
PIECE = 1 << 20


@lru_cache(1)
def _letters() -> np.ndarray:
    """For each code point of the basic plane its lower-case letter, or a space."""
    out = np.full(1 << 16, 32, np.uint32)
    for i in range(1 << 16):
        c = chr(i)
        if c.isalpha():
            out[i] = ord(c.lower()[0])
    return out


def _fold(text: str) -> np.ndarray:
    """Lower-case letters with one space between runs of them."""
    code = np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32)
    if len(code) and code.max() >= 1 << 16:
        table = {int(c): (ord(chr(c).lower()[0]) if chr(c).isalpha() else 32) for c in np.unique(code[code >= 1 << 16])}
        high = code >= 1 << 16
        out = _letters()[np.where(high, 32, code)]
        out[high] = [table[int(c)] for c in code[high]]
    else:
        out = _letters()[code]
    space = out == 32
    return out[np.append(True, ~(space[1:] & space[:-1]))] if len(out) else out


def _ending_in(t: np.ndarray, before: int) -> np.ndarray:
    """Counts by bucket of the n-grams of ``t`` that end after its first ``before`` letters."""
    found, h = [], np.zeros(len(t), np.uint32)
    for n in range(1, max(LENGTHS) + 1):
        h = h[: max(len(t) - n + 1, 0)]
        h = h * np.uint32(0x01000193) + t[n - 1 :]
        if n in LENGTHS:
            x = (h[max(before - n + 1, 0) :] ^ np.uint32(n * 0x9E3779B1 & 0xFFFFFFFF)) * np.uint32(0x85EBCA6B)
            x ^= x >> np.uint32(13)
            x *= np.uint32(0xC2B2AE35)
            found.append(x >> np.uint32(32 - BITS))
    return np.bincount(np.concatenate(found), minlength=1 << BITS)


def features(text: bytes | None) -> tuple[np.ndarray, np.ndarray] | None:
    """(buckets, counts) of the hashed character n-grams of a whole text, with a space at both ends; None without a letter.

    Long texts are taken piece by piece; the last letters of a piece go before
    the next one, so that the pieces make no difference.
    """
    if not text:
        return None
    whole, space = text.decode("utf-8", "replace"), np.array([32], np.uint32)
    total, any_letter, tail = None, False, space[:0]
    for at in range(0, len(whole) + 1, PIECE):
        t = _fold(whole[at : at + PIECE])
        any_letter = any_letter or bool((t != 32).any())
        if at == 0 and not (len(t) and t[0] == 32):
            t = np.concatenate([space, t])
        if at + PIECE > len(whole):
            t = np.concatenate([t, space])
        t = np.concatenate([tail, t])
        t = t[np.append(True, (t[1:] != 32) | (t[:-1] != 32))] if len(t) else t
        if len(t) > len(tail):
            counts = _ending_in(t, len(tail))
            total = counts if total is None else total + counts
        tail = t[-(max(LENGTHS) - 1) :]
    if not any_letter:
        return None
    at = np.flatnonzero(total)
    return at, total[at]


@dataclass
class Model:
    langs: list[str]
    idf: np.ndarray
    weights: np.ndarray
    bias: np.ndarray
    temperature: float = 1.0

    def vector(self, at: np.ndarray, counts: np.ndarray) -> np.ndarray:
        x = (1 + np.log(counts)) * self.idf[at]
        norm = np.sqrt(x @ x)
        return x / norm if norm else x

    def logits(self, at: np.ndarray, counts: np.ndarray) -> np.ndarray:
        return self.vector(at, counts) @ self.weights[at] + self.bias

    def predict(self, text: bytes | None) -> tuple[str, float]:
        if not self.langs or (f := features(text)) is None:
            return UNKNOWN, 0.0
        z = self.logits(*f) / self.temperature
        p = np.exp(z - z.max())
        k = int(p.argmax())
        return self.langs[k], float(p[k] / p.sum())


def train_ftrl(
    samples: list[tuple[np.ndarray, np.ndarray, int]],
    langs: list[str],
    idf: np.ndarray,
    alpha: float = 2.0,
    beta: float = 1.0,
    l1: float = 0.02,
    l2: float = 0.002,
    epochs: int = 3,
    seed: int = 5,
) -> Model:
    """FTRL-proximal over (buckets, counts, class); every fifth sample is kept for the temperature."""
    k, d = len(langs), len(idf)
    model = Model(langs, idf, np.zeros((d, k)), np.zeros(k))
    z, n = np.zeros((d, k)), np.zeros((d, k))
    zb, nb = np.zeros(k), np.zeros(k)
    order = np.random.default_rng(seed).permutation(len(samples))
    held, fit = (order[::5], np.setdiff1d(order, order[::5])) if len(order) >= 20 else (order, order)
    vectors = [model.vector(at, c) for at, c, _ in samples]

    def weights(z, n):
        return np.where(np.abs(z) <= l1, 0.0, -(z - np.sign(z) * l1) / ((beta + np.sqrt(n)) / alpha + l2))

    for epoch in range(epochs):
        for i in np.random.default_rng(seed + epoch).permutation(fit):
            at, _, y = samples[i]
            x = vectors[i][:, None]
            w = weights(z[at], n[at])
            wb = -zb / ((beta + np.sqrt(nb)) / alpha + l2)
            s = (x * w).sum(0) + wb
            p = np.exp(s - s.max())
            p /= p.sum()
            p[y] -= 1
            g = x * p
            new = n[at] + g * g
            z[at] += g - (np.sqrt(new) - np.sqrt(n[at])) / alpha * w
            n[at] = new
            new = nb + p * p
            zb += p - (np.sqrt(new) - np.sqrt(nb)) / alpha * wb
            nb = new
    model.weights = weights(z, n)
    model.bias = -zb / ((beta + np.sqrt(nb)) / alpha + l2)
    logits = np.array([vectors[i] @ model.weights[samples[i][0]] + model.bias for i in held])
    model.temperature = temperature(logits, np.array([samples[i][2] for i in held]))
    model.weights = model.weights.astype(np.float32)
    return model


def temperature(logits: np.ndarray, y: np.ndarray) -> float:
    """The T between 0.05 and 20 that makes softmax(logits / T) likeliest, by golden section on its logarithm."""
    if not len(y):
        return 1.0

    def loss(log_t: float) -> float:
        s = logits / np.exp(log_t)
        s = s - s.max(1, keepdims=True)
        return float((np.log(np.exp(s).sum(1)) - s[np.arange(len(y)), y]).mean())

    low, high, g = np.log(0.05), np.log(20.0), (5**0.5 - 1) / 2
    for _ in range(60):
        a, b = high - g * (high - low), low + g * (high - low)
        low, high = (low, b) if loss(a) < loss(b) else (a, high)
    return float(np.exp((low + high) / 2))


def _gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Document counts of the buckets of each task, and the features of sampled documents."""
    df, docs = np.zeros(1 << BITS, np.int64), 0

    def out(slices, blobs, lang, at, counts):
        return pa.RecordBatch.from_arrays(
            [pa.array(slices, pa.int32()), pa.array(blobs, pa.binary()), pa.array(lang, pa.string()), pa.array(at, pa.binary()), pa.array(counts, pa.binary())],
            names=["slice", "df", "lang", "buckets", "counts"],
        )

    for batch in batches:
        rows = []
        for text, lang, sampled in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist()):
            if (f := features(text)) is None:
                continue
            df[f[0]] += 1
            docs += 1
            if sampled:
                rows.append((lang, f[0].astype(np.uint16).tobytes(), f[1].astype(np.uint32).tobytes()))
        if rows:
            m = len(rows)
            yield out([None] * m, [None] * m, *([r[i] for r in rows] for i in range(3)))
    if docs:
        blobs = [x.tobytes() for x in df.reshape(SLICES, -1)] + [np.array([docs], np.int64).tobytes()]
        m = len(blobs)
        yield out(range(m), blobs, [None] * m, [None] * m, [None] * m)


def _sum(rows: pa.Table) -> pa.Table:
    total = 0
    for blob in rows.column("df"):
        total = total + np.frombuffer(blob.as_buffer(), np.int64)
    return pa.table({"slice": rows.column("slice")[:1], "df": pa.array([total.tobytes()], pa.binary())})


def train(docs: DataFrame, label: str = "lang", max_train: int = 4_000, max_bytes: int = 64 << 20) -> Model:
    """Document frequencies over all of ``docs``; weights from a sample of about ``max_train`` labelled rows.

    The sample takes about as many of each language, by a hash of the text, at
    most 2 * ``max_train`` rows and ``max_bytes`` of features; every language is
    sampled. Rows without a label or a letter teach nothing. The weights take 16
    bytes for each of 2**BITS features and each language.
    """
    scratch = Scratch(docs.sparkSession)
    source = docs.filter(F.col(label).isNotNull()).select(F.col("text").cast("binary").alias("text"), F.col(label).cast("string").alias("lang"))
    sizes = scratch.table(source.groupBy("lang").agg(F.count("*").alias("n")), "sizes")
    n_langs = sizes.count()
    if not n_langs:
        return Model([], np.ones(1 << BITS), np.zeros((1 << BITS, 0)), np.zeros(0))
    each = max(1, max_train // n_langs)
    # Labels of a million kinds are no languages, but even they are joined by their hot keys.
    rows = source.join(F.broadcast(sizes), "lang") if n_langs <= FEW_IDS else join_unique(source, sizes, ["lang"], "n")
    draw = F.shiftrightunsigned(F.xxhash64("text", "lang"), 11) / F.lit(float(2**53))
    rows = rows.select("text", "lang", (draw * F.col("n") < each).alias("sampled"))
    found = scratch.table(rows.mapInArrow(lean(_gather), "slice int, df binary, lang string, buckets binary, counts binary"), "features")
    counted = found.filter("slice is not null").select("slice", "df").groupBy("slice").applyInArrow(_sum, "slice int, df binary").collect()
    by_slice = {r["slice"]: np.frombuffer(bytes(r["df"]), np.int64) for r in counted}
    if not by_slice:
        return Model([], np.ones(1 << BITS), np.zeros((1 << BITS, 0)), np.zeros(0))
    df, n = np.concatenate([by_slice[i] for i in range(SLICES)]), int(by_slice[SLICES][0])
    idf = np.log((1 + n) / (1 + df)) + 1
    # Copies of one text share their draw; the least features by content keep the bounds whatever their number.
    order = (F.xxhash64("buckets", "counts"), F.col("lang"))
    least = found.filter("slice is null").select("lang", "buckets", "counts").distinct().orderBy(*order).limit(2 * max_train)
    size = F.sum(F.octet_length("buckets") + F.octet_length("counts")).over(Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, -1))
    sample = least.withColumn("held", F.coalesce(size, F.lit(0))).filter(F.col("held") < max_bytes).drop("held").collect()
    langs = sorted({r["lang"] for r in sample})
    place = {c: i for i, c in enumerate(langs)}
    samples = [(np.frombuffer(bytes(r["buckets"]), np.uint16).astype(np.int64), np.frombuffer(bytes(r["counts"]), np.uint32), place[r["lang"]]) for r in sample]
    return train_ftrl(samples, langs, idf)


def identify(docs: DataFrame, train_rule: str | None = None, label: str = "lang", id_col: str = "doc_id", name: str = "language", **bounds: int) -> DataFrame:
    """``docs`` with a struct column ``name``: (lang_pred, score from 0 to 1), predicted from the whole text alone.

    Learns from the rows that ``train_rule`` selects (by default those with
    crc32(id) mod 4 other than 2; a null id learns) and that have a label. A
    null text or one without letters gets ``und`` and score 0, as does every
    text where there is nothing to learn from. Repeated rows get the same
    result; an empty table gives no rows. An input column called ``name`` is
    replaced; others may have any names.
    """
    rule = F.expr(train_rule) if train_rule else F.coalesce(crc_mod(id_col, 4) != 2, F.lit(True))
    model = docs.sparkSession.sparkContext.broadcast(train(docs.filter(rule), label, **bounds))
    give_back()  # the samples

    def predict(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        own = model.value
        for batch in texts:
            found = [own.predict(t.as_py()) for t in batch]
            yield pa.StructArray.from_arrays([pa.array([r[i] for r in found], t) for i, t in enumerate((pa.string(), pa.float64()))], names=["lang_pred", "score"])
        give_back()

    udf = F.arrow_udf(predict, "lang_pred string, score double")
    return docs.drop(name).withColumn(name, udf(F.col("text").cast("binary")))


def language_digest(docs: DataFrame) -> DataFrame:
    """(doc_id, held_out, lang_pred, score) of every document; held out: crc32(doc_id) mod 4 = 2."""
    out = identify(docs.select("doc_id", "text", "lang"))
    return out.select("doc_id", F.coalesce(crc_mod("doc_id", 4) == 2, F.lit(False)).alias("held_out"), "language.lang_pred", "language.score")
