"""Members of ZIP archives as rows, RECORD checks and text hits."""

from __future__ import annotations

import base64
import csv
import hashlib
import io
import posixpath
import re
import tarfile
import zipfile
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MEMBERS = "archive string, path string, bytes long, sha256 string, content binary"


def unsafe(path: str) -> bool:
    """Absolute, drive or parent paths."""
    norm = posixpath.normpath(path.replace("\\", "/"))
    return not path or norm.startswith(("/", "../")) or norm == ".." or ":" in path.split("/")[0]


def members(archives: DataFrame, most_bytes: int = 64 << 20, most_total: int = 512 << 20, depth: int = 1) -> DataFrame:
    """(archive, path, bytes, sha256, content) of archives (path, content): ZIP and TAR, nested up to ``depth``.

    An unsafe path, a member over ``most_bytes`` or an archive over
    ``most_total`` raises an error before anything is unpacked.
    """

    def entries(data: bytes) -> Iterator[tuple[str, int, object]]:
        if zipfile.is_zipfile(io.BytesIO(data)):
            box = zipfile.ZipFile(io.BytesIO(data))
            yield from ((i.filename, i.file_size, lambda i=i: box.read(i)) for i in box.infolist() if not i.is_dir())
        else:
            box = tarfile.open(fileobj=io.BytesIO(data))
            yield from ((i.name, i.size, lambda i=i: box.extractfile(i).read()) for i in box.getmembers() if i.isfile())

    def nested(data: bytes) -> bool:
        return data[:4] == b"PK\x03\x04" or data[:2] == b"\x1f\x8b" or data[257:262] == b"ustar"

    def unpack(name: str, prefix: str, data: bytes, left: int) -> Iterator[tuple]:
        found = list(entries(data))
        for path, size, _ in found:
            if unsafe(path):
                raise ValueError(f"unsafe path {path!r} in {name}")
            if size > most_bytes:
                raise ValueError(f"{path!r} in {name} is larger than {most_bytes} bytes")
        if sum(size for _, size, _ in found) > most_total:
            raise ValueError(f"{name} unpacks to more than {most_total} bytes")
        for path, _, read in found:
            body = read()
            yield name, prefix + path, len(body), hashlib.sha256(body).hexdigest(), body
            if left > 1 and nested(body):
                yield from unpack(name, f"{prefix}{path}!", body, left - 1)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for name, data in zip(batch["path"], batch["content"]):
                yield pd.DataFrame(list(unpack(name, "", bytes(data), depth)), columns=["archive", "path", "bytes", "sha256", "content"])

    return archives.select("path", "content").mapInPandas(run, MEMBERS)


def record_rows(found: DataFrame) -> DataFrame:
    """(archive, path, bytes, sha256) that the archives' RECORD files state; hashes as hex."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for archive, own, data in zip(batch["archive"], batch["path"], batch["content"]):
                for path, digest, size in csv.reader(io.StringIO(bytes(data).decode())):
                    if path != own:
                        raw = digest.partition("=")[2]
                        rows.append((archive, path, int(size), base64.urlsafe_b64decode(raw + "=" * (-len(raw) % 4)).hex()))
            yield pd.DataFrame(rows, columns=["archive", "path", "bytes", "sha256"])

    return found.filter(F.col("path").rlike(r"(^|/)RECORD$")).select("archive", "path", "content").mapInPandas(run, "archive string, path string, bytes long, sha256 string")


def keyword_hits(texts: DataFrame, terms: list[str], key: str = "path", text: str = "text", before: int = 240, after: int = 480, most: int | None = 200) -> DataFrame:
    """(key, term, offset, context, truncated) of every occurrence of the terms, the first ``most`` of each key (None: all).

    Occurrences of a term do not overlap. ``truncated`` says that the key has
    more hits than are given. Hits are found where the text is: no text is
    shuffled.
    """
    if not all(terms):
        raise ValueError("an empty term has no occurrences")
    kind = dict(texts.dtypes)[key]

    def hits(body: str) -> list[tuple[int, str]]:
        return sorted((m.start(), t) for t in terms for m in re.finditer(re.escape(t), body))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for owner, body in zip(batch.column(0), batch.column(1)):
                found = hits(body.as_py() or "")
                kept = found if most is None else found[:most]
                for i in range(0, len(kept), 1_000):
                    part, whole = kept[i : i + 1_000], body.as_py()
                    columns = [pa.array([t for _, t in part]), pa.array([at for at, _ in part], pa.int64())]
                    columns.append(pa.array([whole[max(0, at - before) : at + after] for at, _ in part]))
                    yield pa.RecordBatch.from_arrays(
                        [pa.repeat(owner, len(part)), *columns, pa.array([len(kept) < len(found)] * len(part))], names=[key, "term", "offset", "context", "truncated"]
                    )

    return texts.select(key, F.col(text).cast("string").alias(text)).mapInArrow(run, f"`{key}` {kind}, term string, offset long, context string, truncated boolean")
