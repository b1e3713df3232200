"""Declarative specs: column roles, per-source harmonisation, search grids, stacking.

Roles are data, not constants: the same engine serves any tabular risk table.
"""

from __future__ import annotations

import json
from dataclasses import dataclass, field
from typing import Any


@dataclass(frozen=True)
class FeatureSpec:
    """Column roles of the harmonised table.

    ``numeric`` are imputed and standardised, ``categorical`` one-hot encoded, ``binary`` passed
    through as 0/1 doubles, ``target`` is the 0/1 label, ``lineage`` tags the source row and is
    never a feature, ``key`` identifies a row (splits and folds hash it, so it must be stable).
    """

    numeric: tuple[str, ...] = ()
    categorical: tuple[str, ...] = ()
    binary: tuple[str, ...] = ()
    target: str = "label"
    lineage: str | None = "source"
    key: tuple[str, ...] = ()

    def __post_init__(self):
        for name in ("numeric", "categorical", "binary", "key"):
            object.__setattr__(self, name, tuple(getattr(self, name)))
        cols = list(self.numeric) + list(self.categorical) + list(self.binary)
        dup = {c for c in cols if cols.count(c) > 1}
        if dup:
            raise ValueError(f"column in more than one role: {sorted(dup)}")
        if self.target in cols:
            raise ValueError(f"target {self.target!r} is also a feature")
        if self.lineage and self.lineage in cols:
            raise ValueError(f"lineage column {self.lineage!r} can never be a feature")

    @property
    def features(self) -> tuple[str, ...]:
        return self.numeric + self.categorical + self.binary

    @property
    def columns(self) -> tuple[str, ...]:
        """All columns of the harmonised table, in spec order (a stable order, unlike a set)."""
        out = list(self.key)
        for c in self.features + (self.target,):
            if c not in out:
                out.append(c)
        if self.lineage and self.lineage not in out:
            out.append(self.lineage)
        return tuple(out)


@dataclass(frozen=True)
class SourceSpec:
    """How one source becomes the harmonised schema.

    ``rename`` old→new names (absent names are ignored); ``recode`` column → {raw: canonical}
    where unmapped or unparsable values become null; ``tag`` the lineage value, written over an
    existing tag only when ``overwrite_tag``; ``add`` constants for columns the source lacks.
    """

    name: str
    rename: dict[str, str] = field(default_factory=dict)
    recode: dict[str, dict[Any, Any]] = field(default_factory=dict)
    add: dict[str, Any] = field(default_factory=dict)
    overwrite_tag: bool = True


@dataclass(frozen=True)
class GridSpec:
    """A model family and its parameter grid, e.g. ``GridSpec('lr', {'C': [0.1, 1.0]})``."""

    model: str
    grid: dict[str, list] = field(default_factory=dict)
    n_iter: int | None = None
    seed: int = 42


@dataclass(frozen=True)
class StackSpec:
    """Stacking of fitted base models through out-of-fold scores and a meta logistic model."""

    base: tuple[str, ...] = ("lr", "rf", "gbt")
    folds: int = 5
    meta_C: float = 1.0
    seed: int = 42
    mode: str = "full"  # "full": base models refitted on all of train; "last_fold" on request


def load_specs(path: str) -> tuple[FeatureSpec, dict[str, SourceSpec]]:
    """Column roles and source layouts from a JSON file: the fields of ``FeatureSpec`` at the top,
    and under ``sources`` a name → fields of ``SourceSpec`` for each source that needs any."""
    with open(path, encoding="utf-8") as f:
        doc = json.load(f)
    sources = {name: SourceSpec(name=name, **fields) for name, fields in doc.pop("sources", {}).items()}
    return FeatureSpec(**doc), sources
