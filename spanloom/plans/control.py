"""Runs under control: a profile of choices, a preflight whose identity is frozen, a run state bound to it, gate sets that stop."""

from __future__ import annotations

import json
import os
from collections.abc import Callable, Mapping
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spanloom.operators import gates as G
from spanloom.sources import ingest

from .ledger import sha
from .registry import Registry, default_configuration

#: A result that is handed between processes may be this long.
RESULT_BYTES = 8 << 20


class ControlError(RuntimeError):
    """A run that does not fit its frozen inputs, or a step that may not go on."""


@dataclass(frozen=True)
class Profile:
    """Which operation serves each step, with changed parameters, and conditions that the whole must meet."""

    choices: Mapping[str, str]
    overrides: Mapping[str, Mapping[str, Any]] = field(default_factory=dict)
    invariants: Mapping[str, Callable[[Mapping[str, Mapping[str, Any]]], bool]] = field(default_factory=dict)

    def configuration(self, registry: Registry) -> dict[str, dict[str, Any]]:
        """Parameters by step; a choice without an operation or a broken invariant raises an error."""
        known = default_configuration(registry, self.overrides)
        if lost := sorted(c for c in self.choices.values() if c not in known):
            raise ControlError(f"no available operation {lost}")
        out = {step: known[operation] for step, operation in self.choices.items()}
        if broken := sorted(name for name, holds in self.invariants.items() if not holds(out)):
            raise ControlError(f"the profile breaks {broken}")
        return out

    def warnings(self, registry: Registry) -> list[str]:
        """What is allowed, but worth saying: overrides that no step uses, and those that change nothing."""
        unused = [f"override of unused operation {o}" for o in self.overrides if o not in self.choices.values()]
        same = [f"{o}.{k} is the default" for o, p in self.overrides.items() for k, v in p.items() if o in registry.names() and registry.contract(o).parameters.get(k, ...) == v]
        return sorted(unused + same)

    def identity(self) -> str:
        return sha({"choices": dict(self.choices), "overrides": {k: dict(v) for k, v in self.overrides.items()}, "invariants": sorted(self.invariants)})


def preflight(spark: SparkSession, source: str, profile: Profile, registry: Registry) -> dict[str, Any]:
    """The frozen identity of a run: the source's bytes, the profile and the registry, with a fingerprint over them."""
    rows = ingest.read_files(spark, source).select("sha256", "byte_size").limit(2).collect()
    if len(rows) != 1:
        raise ControlError(f"{source} is not one file")
    out = {
        "source": {"path": source, "sha256": rows[0]["sha256"], "bytes": rows[0]["byte_size"]},
        "profile": profile.identity(),
        "configuration": profile.configuration(registry),
        "registry": registry.identity(),
    }
    return out | {"fingerprint": sha(out)}


class RunState:
    """The steps of one run in a file beside its results, bound to a preflight: other inputs may not use it.

    Every reading proves the preflight and each step's result against their
    hashes again. A file is replaced as a whole.
    """

    def __init__(self, path: str, frozen: Mapping[str, Any]):
        self.path, self.frozen = path, dict(frozen)
        body = {k: v for k, v in self.frozen.items() if k != "fingerprint"}
        if sha(body) != self.frozen.get("fingerprint"):
            raise ControlError("the preflight does not fit its fingerprint")
        if not os.path.exists(path):
            self._write({"root": self.frozen["fingerprint"], "steps": {}, "blocked": None})
        self.read()

    def _write(self, state: dict) -> None:
        with open(f"{self.path}.new", "w", encoding="utf-8") as f:
            json.dump(state, f, ensure_ascii=False, sort_keys=True)
            f.flush()
            os.fsync(f.fileno())
        os.replace(f"{self.path}.new", self.path)

    def read(self) -> dict:
        with open(self.path, encoding="utf-8") as f:
            state = json.load(f)
        if state["root"] != self.frozen["fingerprint"]:
            raise ControlError(f"{self.path} belongs to other inputs")
        for name, step in state["steps"].items():
            if sha(step["result"]) != step["sha"]:
                raise ControlError(f"the result of {name} in {self.path} was changed")
        return state

    def step(self, name: str, work: Callable[[], Any]) -> Any:
        """The result of a step: the kept one, else that of one attempt. A blocked run makes no more attempts."""
        state = self.read()
        if name in state["steps"]:
            return state["steps"][name]["result"]
        if state["blocked"]:
            raise ControlError(f"blocked by {state['blocked']['step']}: {state['blocked']['reason']}")
        try:
            result = work()
        except Exception as e:
            self._write(state | {"blocked": {"step": name, "reason": repr(e)}})
            raise
        state["steps"][name] = {"result": result, "sha": sha(result)}
        self._write(state)
        return result

    def release(self, reason: str) -> None:
        """Let a blocked run go on, after someone has looked at it; the reason is kept."""
        state = self.read()
        if not state["blocked"]:
            raise ControlError("the run is not blocked")
        self._write(state | {"blocked": None, "released": [*state.get("released", []), state["blocked"] | {"because": reason}]})


def checked(result: Mapping[str, Any], required: tuple[str, ...], schema: str | None = None, same: Mapping[str, Any] | None = None, most_bytes: int = RESULT_BYTES) -> dict[str, Any]:
    """A result that keeps its contract: fields that must be there, the schema's name, values that must be equal, and its length."""
    size = len(json.dumps(result, ensure_ascii=False, default=str).encode())
    problems = [f"no {k}" for k in required if k not in result]
    problems += [f"schema {result.get('schema')!r}"] if schema is not None and result.get("schema") != schema else []
    problems += [f"{k} is {result.get(k)!r}, not {v!r}" for k, v in (same or {}).items() if result.get(k) != v]
    problems += [f"{size} bytes"] if size > most_bytes else []
    if problems:
        raise ControlError("; ".join(problems))
    return dict(result)


def gate_set(state: RunState, pairs: DataFrame, required: tuple[str, ...], known: Mapping[str, G.Gate] = G.GATES, terminal: tuple[str, ...] = (), key: str = "segment_id") -> dict[str, Any]:
    """The verdicts of a set of gates, kept in the run's state: {gate: (failures, issues hash, state)} and whether all passed.

    That every gate exists is proved before any is judged. All are judged in one
    pass; a terminal gate that fails marks those after it as not counted.
    """
    if lost := [g for g in required if g not in known]:
        raise ControlError(f"no gate {lost}")

    def judge() -> dict[str, Any]:
        rows = {r["gate"]: r for r in G.summary(pairs, {g: known[g] for g in required}, key, digest=True).collect()}
        out, stopped = {}, False
        for g in required:
            r = rows[g]
            verdict = "not counted" if stopped else "passed" if r["passed"] else "failed"
            stopped = stopped or (g in terminal and verdict == "failed")
            out[g] = {"failures": r["failure_count"], "issues_sha256": r["issues_sha256"], "verdict": verdict}
        return {"gates": out, "passed": all(v["verdict"] == "passed" for v in out.values())}

    return state.step("gates", judge)


class Engine:
    """One place to look at a run and to call operations by name."""

    def __init__(self, spark: SparkSession, registry: Registry, runs: DataFrame | None = None):
        self.spark, self.registry, self.runs = spark, registry, runs

    def project(self) -> dict[str, Any]:
        """Operations and, if there is a ledger, runs by status."""
        states = {} if self.runs is None else {r["status"]: r["count"] for r in self.runs.groupBy("status").count().collect()}
        return {"operations": self.registry.counts(), "registry": self.registry.identity(), "runs": states}

    def call(self, name: str, **params: Any) -> DataFrame:
        return self.registry.call(name, self.spark, **params)


def sources_of(requests: Mapping[str, str], outputs: Mapping[str, Mapping[str, Any]]) -> dict[str, Any]:
    """Parameters named as ``step.field``, taken from what steps gave; a value that is not there raises an error."""
    out = {}
    for name, place in requests.items():
        step, _, at = place.partition(".")
        if step not in outputs or at not in outputs[step]:
            raise ControlError(f"{name} needs {place}")
        out[name] = outputs[step][at]
    return out


def agreed(rows: DataFrame, name: str = "name", value: str = "value") -> dict[str, Any]:
    """Values of names on which all sources agree, as a dict; conflicting names raise an error."""
    found = rows.groupBy(name).agg(F.collect_set(value).alias("v")).collect()
    if bad := sorted(r[name] for r in found if len(r["v"]) > 1):
        raise ControlError(f"sources disagree on {bad}")
    return {r[name]: r["v"][0] for r in found}
