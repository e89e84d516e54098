"""Feature specification: which columns are features and of which kind."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import types as T

DISCRETE = "discrete"
CONTINUOUS = "continuous"


@dataclass(frozen=True)
class FeatureSpec:
    """One feature: discrete features split n-ary on their values, continuous
    ones split in two at a threshold."""

    name: str
    kind: str = CONTINUOUS

    def __post_init__(self):
        if self.kind not in (DISCRETE, CONTINUOUS):
            raise ValueError(f"kind must be {DISCRETE!r} or {CONTINUOUS!r}, got {self.kind!r}")

    @property
    def discrete(self) -> bool:
        return self.kind == DISCRETE


def _kind_of(dtype: T.DataType) -> str:
    if isinstance(dtype, (T.StringType, T.BooleanType)):
        return DISCRETE
    if isinstance(dtype, T.NumericType):
        return CONTINUOUS
    raise TypeError(f"no default feature kind for {dtype.simpleString()}; take a number from it first")


def infer_spec(df: DataFrame, label: str, overrides: dict | None = None,
               features: list[str] | None = None) -> list[FeatureSpec]:
    """Spec for every non-label column (or ``features``) in column order:
    string/boolean -> discrete, numeric -> continuous; ``overrides`` maps
    name -> kind."""
    overrides = overrides or {}
    types = {f.name: f.dataType for f in df.schema.fields}
    names = features if features is not None else [c for c in df.columns if c != label]
    out = []
    for name in names:
        if name == label:
            continue
        kind = overrides.get(name) or _kind_of(types[name])
        out.append(FeatureSpec(name, kind))
    return out


def check_spec(df: DataFrame, label: str, spec: list[FeatureSpec]) -> None:
    """The type vector has one entry per feature and names exist (driver-side, no job)."""
    cols = set(df.columns)
    if label not in cols:
        raise ValueError(f"label column {label!r} not in {df.columns}")
    names = [s.name for s in spec]
    if len(set(names)) != len(names):
        raise ValueError("duplicate feature names in spec")
    missing = [n for n in names if n not in cols]
    if missing:
        raise ValueError(f"features not in table: {missing}")
    if label in names:
        raise ValueError("the label cannot be a feature")
