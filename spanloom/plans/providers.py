"""Interfaces for model-backed steps. No tagger or translator comes with the library, and none is imitated."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass, field
from typing import Protocol

import pandas as pd
from pyspark.sql import DataFrame

TOKENS = (
    "doc_id long, token_index int, start int, end int, text string, lemma string, lower string, pos string, tag string, dependency string, "
    "head_token_index int, sentence_index int, entity_type string, is_oov boolean"
)
HYPOTHESES = "key string, rank int, text string, score double"


class Tagger(Protocol):
    """Tags one text: dicts with the fields of TOKENS but doc_id."""

    name: str

    def tag(self, text: str) -> list[dict]: ...


class Translator(Protocol):
    """Translates a batch: for each text n hypotheses (text, score), best first."""

    name: str

    def translate(self, texts: Sequence[str], n: int) -> list[list[tuple[str, float | None]]]: ...


def _numbers(version: str) -> tuple[int, ...]:
    return tuple(int(n) for n in re.findall(r"\d+", version))


@dataclass(frozen=True)
class Capabilities:
    """What a provider states about itself, compared with what a stage needs."""

    language: str = "en"
    version: str = ""
    features: frozenset[str] = field(default_factory=frozenset)

    def lacks(self, language: str, features: frozenset[str], least: str = "") -> list[str]:
        """What is missing for a language, features and a version from ``least`` on (numbers between points)."""
        out = [] if language == self.language else [f"language {language}"]
        if least and _numbers(self.version) < _numbers(least):
            out.append(f"version {least}")
        return out + sorted(f"feature {f}" for f in features - self.features)


class ProviderError(RuntimeError):
    """A provider that is absent or breaks its contract."""


def tag(docs: DataFrame, make: Callable[[], Tagger]) -> DataFrame:
    """Tokens of documents (doc_id, text). Token texts must equal the source at their spans."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tagger = make()
        names = [c.split()[0] for c in TOKENS.split(", ")]
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch["doc_id"], batch["text"]):
                for t in tagger.tag(text):
                    if text[t["start"] : t["end"]] != t["text"]:
                        raise ProviderError(f"{tagger.name}: token {t['token_index']} of {doc_id} differs from the source")
                    rows.append({"doc_id": doc_id, **t})
            frame = pd.DataFrame(rows, columns=names)
            yield frame.astype({"head_token_index": "Int32", "sentence_index": "Int32", "token_index": "Int32", "start": "Int32", "end": "Int32", "is_oov": "boolean"})

    return docs.select("doc_id", "text").mapInPandas(run, TOKENS)


def translate(units: DataFrame, make: Callable[[], Translator], n: int = 1, batch_size: int = 16) -> DataFrame:
    """Hypotheses of units (key, text). Each distinct text is translated once; n hypotheses must come back, the first not blank."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = make()
        for batch in batches:
            for i in range(0, len(batch), batch_size):
                texts = batch["text"].iloc[i : i + batch_size].tolist()
                out = model.translate(texts, n)
                if len(out) != len(texts) or any(len(h) != n for h in out):
                    raise ProviderError(f"{model.name}: {len(texts)} texts, {n} hypotheses each, were not all answered")
                if any(not h[0][0].strip() for h in out):
                    raise ProviderError(f"{model.name}: a blank translation")
                yield pd.DataFrame([(t, r, x, s) for t, h in zip(texts, out) for r, (x, s) in enumerate(h)], columns=["source", "rank", "text", "score"])

    distinct = units.select("text").distinct()
    found = distinct.mapInPandas(run, "source string, rank int, text string, score double")
    return units.select("key", units["text"].alias("source")).join(found, "source").select("key", "rank", "text", "score")
