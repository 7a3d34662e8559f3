"""The run ledger: identities, cache hits, states, hash chains. Append-only tables."""

from __future__ import annotations

import hashlib
import json
import math
import time
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass
from datetime import UTC, datetime
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spanloom.operators.sampling import range_positions

SCHEMA = "run_id long, stage int, impl string, input_sha string, params_sha string, status string, output_sha string, output string, error string, at timestamp, event long"


def canonical(value: Any) -> str:
    """JSON with sorted keys and no spaces; NaN raises an error, infinity is written as a word."""

    def clean(v: Any) -> Any:
        if isinstance(v, float):
            if math.isnan(v):
                raise ValueError("NaN has no canonical form")
            return "infinite" if v == math.inf else "-infinite" if v == -math.inf else v
        if isinstance(v, dict):
            return {str(k): clean(x) for k, x in v.items()}
        return [clean(x) for x in v] if isinstance(v, list | tuple) else v

    return json.dumps(clean(value), ensure_ascii=False, sort_keys=True, separators=(",", ":"))


def sha(value: Any) -> str:
    return hashlib.sha256(canonical(value).encode()).hexdigest()


@dataclass(frozen=True)
class Run:
    run_id: int
    cache_hit: bool
    output: dict | None = None


class Ledger:
    """Runs keyed by (stage, implementation, input hash, parameter hash).

    A completed run is a cache hit, a running one an error that someone must
    reconcile, a failed one may run again under a new id. Ids and events are
    handed out under a lock file beside the table, so of several writers one
    writes at a time; a lock that stays longer than ``patience`` seconds is an
    error, and its owner must be looked for.
    """

    def __init__(self, spark: SparkSession, path: str, patience: float = 60):
        self.spark, self.path, self.patience = spark, path, patience

    @contextmanager
    def _locked(self) -> Iterator[None]:
        lock = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.path}.lock")
        files, until = lock.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), time.monotonic() + self.patience
        files.mkdirs(lock.getParent())
        while not files.createNewFile(lock):
            if time.monotonic() > until:
                raise RuntimeError(f"{lock} is held by another writer")
            time.sleep(0.1)
        try:
            yield
        finally:
            files.delete(lock, False)

    def events(self) -> DataFrame:
        try:
            return self.spark.read.schema(SCHEMA).parquet(self.path)
        except Exception as e:
            if "PATH_NOT_FOUND" in str(e):
                return self.spark.createDataFrame([], SCHEMA)
            raise

    def runs(self) -> DataFrame:
        """The last state of every run."""
        return latest_states(self.events())

    def _append(self, **row: Any) -> None:
        names = [f.name for f in self.spark.createDataFrame([], SCHEMA).schema]
        at = datetime.now(UTC).replace(tzinfo=None)
        n = self.events().agg(F.coalesce(F.max("event"), F.lit(0))).first()[0] + 1
        self.spark.createDataFrame([tuple({**row, "at": at, "event": n}.get(k) for k in names)], SCHEMA).coalesce(1).write.mode("append").parquet(self.path)

    def begin(self, stage: int, impl: str, inputs: Any, params: Any) -> Run:
        key = {"stage": stage, "impl": impl, "input_sha": sha(inputs), "params_sha": sha(params)}
        with self._locked():
            same = self.runs().filter(" and ".join(f"{k} = {v!r}" for k, v in key.items()))
            for r in same.collect():
                if r["status"] == "completed":
                    return Run(r["run_id"], True, json.loads(r["output"]))
                if r["status"] == "running":
                    raise RuntimeError(f"run {r['run_id']} is still marked as running: reconcile it first")
            run_id = self.events().agg(F.coalesce(F.max("run_id"), F.lit(0))).first()[0] + 1
            self._append(run_id=run_id, status="running", **key)
        return Run(run_id, False)

    def _end(self, run_id: int, **change: Any) -> None:
        with self._locked():
            row = self.runs().filter(F.col("run_id") == run_id).first()
            if row is None or row["status"] != "running":
                raise RuntimeError(f"run {run_id} is not running")
            self._append(**{k: row[k] for k in ("run_id", "stage", "impl", "input_sha", "params_sha")}, **change)

    def required(self, run_id: int, stage: int, **flags: Any) -> dict:
        """The output of a completed run of ``stage`` that has these values; anything else raises an error."""
        row = self.runs().filter(F.col("run_id") == run_id).first()
        if row is None or row["stage"] != stage or row["status"] != "completed":
            raise RuntimeError(f"run {run_id} is not a completed run of stage {stage}")
        output = json.loads(row["output"])
        if wrong := {k: output.get(k) for k, v in flags.items() if output.get(k) != v}:
            raise RuntimeError(f"run {run_id} of stage {stage} has {wrong}")
        return output

    def finish(self, run_id: int, output: dict) -> None:
        self._end(run_id, status="completed", output=canonical(output), output_sha=sha(output))

    def fail(self, run_id: int, error: str) -> None:
        self._end(run_id, status="failed", error=error)

    def step(self, stage: int, impl: str, inputs: Any, params: Any, work) -> Run:
        """One attempt of ``work(run_id)``, which returns the output; its error is kept and raised."""
        run = self.begin(stage, impl, inputs, params)
        if run.cache_hit:
            return run
        try:
            output = work(run.run_id)
        except Exception as e:
            self.fail(run.run_id, repr(e))
            raise
        self.finish(run.run_id, output)
        return Run(run.run_id, False, output)


def latest_states(events: DataFrame) -> DataFrame:
    names = [c for c in events.columns if c != "run_id"]
    last = events.groupBy("run_id").agg(F.max_by(F.struct(*names), "event").alias("s"))
    return last.select("run_id", "s.*")


def cache_probe(requests: DataFrame, runs: DataFrame) -> DataFrame:
    """Requests (stage, impl, input_sha, params_sha) with ``cache_hit``: a completed run has the same four."""
    key = ["stage", "impl", "input_sha", "params_sha"]
    done = runs.filter("status = 'completed'").select(*key).distinct().withColumn("cache_hit", F.lit(True))
    return requests.join(done, key, "left").withColumn("cache_hit", F.coalesce("cache_hit", F.lit(False)))


def summary(documents: DataFrame, runs: DataFrame) -> DataFrame:
    """One row: documents, runs, completed runs."""
    return documents.agg(F.count("*").alias("documents")).join(F.broadcast(runs.agg(F.count("*").alias("runs"), F.count_if(F.col("status") == "completed").alias("completed"))))


def record_sha(previous: str, body: str) -> str:
    return hashlib.sha256(f"{previous}\n{body}".encode()).hexdigest()


def chained(bodies: list[dict], previous: str = "") -> list[str]:
    """JSONL rows of a journal: each holds its body, the hash before it and its own."""
    out = []
    for body in bodies:
        text = canonical(body)
        own = record_sha(previous, text)
        out.append(canonical({"body": text, "previous": previous, "sha": own}))
        previous = own
    return out


def chain_breaks(journal: DataFrame, pos: str = "pos") -> DataFrame:
    """(pos, problem) of a journal (pos, body, previous, sha): a hash that does not fit its body, or a wrong predecessor.

    Each record meets the one before it by an equi-join on its position, so no
    window runs over the whole journal. Positions are dense from 0.
    """
    own = F.sha2(F.concat("previous", F.lit("\n"), F.col("body")).cast("binary"), 256)
    before = journal.select((F.col(pos) + 1).alias(pos), F.col("sha").alias("_before"))
    joined = journal.join(before, pos, "left")
    problem = F.when(own != F.col("sha"), "hash").when(F.coalesce("_before", F.lit("")) != F.col("previous"), "chain")
    return joined.select(pos, problem.alias("problem")).filter("problem is not null")


def read_journal(spark: SparkSession, path: str) -> DataFrame:
    """(pos, body, previous, sha) of a JSONL journal; a torn last line is left out, any other broken line raises an error.

    Lines are read in splits and numbered by the split's place in the file.
    """
    raw = spark.read.text(path, lineSep="\n").select(F.col("value").alias("line"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("id"))
    rows = range_positions(raw.withColumn("_all", F.lit(0)), "_all", ["block", "id"]).withColumnRenamed("i", "pos")
    record = F.from_json("line", "body string, previous string, sha string")
    parsed = rows.withColumn("r", record).filter((F.col("line") != "") & ~((F.col("pos") == F.col("n") - 1) & F.col("r.sha").isNull()))
    bad = F.when(F.col("r.sha").isNull(), F.raise_error(F.concat(F.lit("broken journal line "), F.col("pos").cast("string")))).otherwise(F.col("r.sha"))
    return parsed.select("pos", F.col("r.body").alias("body"), F.col("r.previous").alias("previous"), bad.alias("sha"))
