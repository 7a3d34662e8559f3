"""URL filters: a bit-parallel wildcard automaton over canonical URLs.

All glob rules are packed into Shift-And masks of as many 64-bit words as
they need; every URL of a batch steps through all rules at once.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Runs of any characters, and of any but a slash (a run of host labels).
ANY, LABELS = "*", "^"

_LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))


#: Words of automaton state that are held at once (16 MB): the more rules, the fewer URLs step together.
STATE_WORDS = 1 << 21


def _slices(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i in range(0, batch.num_rows, rows):
            yield batch.slice(i, rows)


@dataclass(frozen=True)
class Rule:
    """``host`` and its subdomains, with paths that begin with ``path``."""

    host: str
    path: str
    verdict: str

    @property
    def name(self) -> str:
        return self.host + self.path

    def globs(self) -> tuple[str, str]:
        return f"{self.name}{ANY}", f"{LABELS}.{self.name}{ANY}"


class Automaton:
    """Anchored Shift-And with wildcards for many patterns.

    Each pattern has one start bit and one bit for each literal byte; a run
    after a literal (or at the start) lets that bit stay set on the bytes that
    the run admits. ``^`` runs over anything but ``/``.
    """

    def __init__(self, patterns: Sequence[str]):
        step: list[set[int]] = [set() for _ in range(256)]
        stay: list[set[int]] = [set() for _ in range(256)]
        start, final, bit = [], [], 0
        for pattern in patterns:
            start.append(bit)
            for byte in pattern.encode():
                if byte == ord(ANY) or byte == ord(LABELS):
                    for c in range(256):
                        if byte == ord(ANY) or c != ord("/"):
                            stay[c].add(bit)
                else:
                    bit += 1
                    step[byte].add(bit)
            final.append(bit)
            bit += 1
        self.words = (bit + 63) // 64 or 1
        self.start = self._mask(start)
        self.step = np.stack([self._mask(x) for x in step])
        self.stay = np.stack([self._mask(x) for x in stay])
        self.final = [(b // 64, np.uint64(1 << (b % 64))) for b in final]

    def _mask(self, bits) -> np.ndarray:
        out = [0] * self.words
        for b in bits:
            out[b // 64] |= 1 << (b % 64)
        return np.array(out, np.uint64)

    def match(self, urls: Sequence[bytes]) -> np.ndarray:
        """One row for each URL, one boolean column for each pattern."""
        order = sorted(range(len(urls)), key=lambda i: -len(urls[i]))
        lengths = np.array([len(urls[i]) for i in order], np.int64)
        starts = np.concatenate([[0], np.cumsum(lengths)[:-1]]).astype(np.int64) if len(order) else lengths
        data = np.frombuffer(b"".join(urls[i] for i in order), np.uint8)
        state = np.tile(self.start, (len(order), 1))
        n = len(order)
        for t in range(int(lengths[0]) if n else 0):
            while lengths[n - 1] <= t:  # the shortest have ended
                n -= 1
            c = data[starts[:n] + t]
            s = state[:n]
            moved = s << np.uint64(1)
            if self.words > 1:
                moved[:, 1:] |= s[:, :-1] >> np.uint64(63)
            state[:n] = (moved & self.step[c]) | (s & self.stay[c])
        out = np.zeros((len(order), len(self.final)), bool)
        for k, (word, mask) in enumerate(self.final):
            out[order, k] = (state[:, word] & mask) != 0
        return out


def canonical(url: bytes | None) -> tuple[bytes, bytes]:
    """Host (A-Z lower-cased) and path of a URL; both empty without a scheme."""
    if url is None or (at := url.find(b"://")) < 0:
        return b"", b""
    rest = url[at + 3 :]
    ends = [i for i in (rest.find(b"?"), rest.find(b"#")) if i >= 0]
    rest = rest[: min(ends)] if ends else rest
    slash = rest.find(b"/")
    host, path = (rest, b"") if slash < 0 else (rest[:slash], rest[slash:])
    return host.translate(_LOWER), path


def filter_urls(
    pages: DataFrame,
    rules: Sequence[Rule],
    block_globs: Sequence[str] = (),
    default: str = "allow",
    id_col: str = "page_id",
    url_col: str = "url",
) -> DataFrame:
    """Judge every URL: (id, host, path, rule, verdict), one row for each input row.

    The longest rule that fits decides (of equal ones the first given); without
    one, ``block`` if a glob of ``block_globs`` matches host and path, else
    ``default``. A null URL or one without ``://`` has empty host and path and
    fits no rule. Repeated rows are judged each; other columns are not read; an
    empty table gives no rows. A null id stays null.
    """
    ranked = sorted(rules, key=lambda r: -len(r.name))
    patterns = [g for r in ranked for g in r.globs()] + list(block_globs)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = Automaton(patterns)
        for part in _slices(batches, max(1, STATE_WORDS // max(automaton.words, len(patterns) // 8))):
            parts = [canonical(u) for u in part.column(1).to_pylist()]
            hit = automaton.match([h + p for h, p in parts])
            names: list[str | None] = []
            verdicts: list[str] = []
            for row in hit:
                k = next((i for i in range(len(ranked)) if row[2 * i] or row[2 * i + 1]), None)
                names.append(None if k is None else ranked[k].name)
                blocked = bool(row[2 * len(ranked) :].any())
                verdicts.append(ranked[k].verdict if k is not None else "block" if blocked else default)
            yield pa.RecordBatch.from_arrays(
                [
                    part.column(0),
                    pa.array([h.decode("utf-8", "replace") for h, _ in parts], pa.string()),
                    pa.array([p.decode("utf-8", "replace") for _, p in parts], pa.string()),
                    pa.array(names, pa.string()),
                    pa.array(verdicts, pa.string()),
                ],
                names=[id_col, "host", "path", "rule", "verdict"],
            )

    narrow = pages.select(F.col(id_col).cast("long").alias(id_col), F.col(url_col).cast("binary").alias("url"))
    return narrow.mapInArrow(judge, f"{id_col} long, host string, path string, rule string, verdict string")
