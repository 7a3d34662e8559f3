"""Named operations with their contracts; a hash tells whether the registry changed."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable, Mapping
from dataclasses import asdict, dataclass, field
from typing import Any

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class Contract:
    """What a caller may rely on: whether a replay is safe, parameters, result columns, whether a failure is terminal."""

    stage: int
    key: str
    implementation: str
    replay_safe: bool = True
    parameters: Mapping[str, Any] = field(default_factory=dict)
    result: tuple[str, ...] = ()
    hard_gate: bool = False
    available: bool = True

    def identity(self) -> str:
        body = {k: v for k, v in asdict(self).items() if k != "available"}
        return hashlib.sha256(json.dumps(body, sort_keys=True, default=list).encode()).hexdigest()


class Registry:
    def __init__(self):
        self._operations: dict[str, tuple[Contract, Callable[..., DataFrame]]] = {}

    def add(self, name: str, contract: Contract, call: Callable[..., DataFrame]) -> None:
        if name in self._operations:
            raise ValueError(f"operation {name!r} exists already")
        self._operations[name] = (contract, call)

    def names(self) -> list[str]:
        return sorted(self._operations)

    def contract(self, name: str) -> Contract:
        return self._operations[name][0]

    def call(self, name: str, spark: SparkSession, **params: Any) -> DataFrame:
        """Run an available operation; unknown parameters and results without the stated columns raise an error."""
        contract, run = self._operations[name]
        if not contract.available:
            raise RuntimeError(f"operation {name!r} has no implementation here")
        if unknown := set(params) - set(contract.parameters):
            raise TypeError(f"unknown parameters {sorted(unknown)}")
        out = run(spark, **{**contract.parameters, **params})
        if lost := set(contract.result) - set(out.columns):
            raise RuntimeError(f"operation {name!r} did not return {sorted(lost)}")
        return out

    def identity(self) -> str:
        """A hash of all contracts; availability does not count."""
        lines = [f"{n} {c.identity()}" for n, (c, _) in sorted(self._operations.items())]
        return hashlib.sha256("\n".join(lines).encode()).hexdigest()

    def counts(self) -> dict[str, int]:
        have = sum(c.available for c, _ in self._operations.values())
        return {"available": have, "declared_only": len(self._operations) - have}

    def matching(self, **attributes: Any) -> str:
        """The one operation whose contract has these attributes; none or several raise an error with the reasons."""
        fits, reasons = [], {}
        for n, (c, _) in self._operations.items():
            off = [k for k, v in attributes.items() if getattr(c, k) != v]
            (reasons.__setitem__(n, off) if off else fits.append(n))
        if len(fits) != 1:
            raise LookupError(f"{len(fits)} operations fit: {fits or reasons}")
        return fits[0]


def default_configuration(registry: Registry, overrides: Mapping[str, Mapping[str, Any]] | None = None) -> dict[str, dict[str, Any]]:
    """Parameters of all available operations; overrides must name known operations and parameters."""
    out = {n: dict(registry.contract(n).parameters) for n in registry.names() if registry.contract(n).available}
    for n, params in (overrides or {}).items():
        if n not in out or (bad := set(params) - set(out[n])):
            raise ValueError(f"unknown override {n}: {sorted(bad) if n in out else ''}")
        out[n].update(params)
    return out



def preferred(choices: list[str], available: set[str]) -> str:
    """The first of the choices that is available."""
    found = next((c for c in choices if c in available), None)
    if found is None:
        raise LookupError(f"none of {choices} is available")
    return found


def source_overrides(kind: str) -> dict[str, Any]:
    """Parameters that follow from the kind of source: subtitles are planned in short units."""
    return {"preferred": 12} if kind in ("srt", "vtt", "ass", "ssa") else {}
