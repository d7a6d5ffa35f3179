"""Selection job: two rounds of feature selection, then one versioned train and test set."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame

from chronoload.functions.textfns import matching, quoted
from chronoload.operators.clean import train_rows
from chronoload.plans.features import CYCLES, HOLIDAYS, SOURCE_SUBSTRINGS
from chronoload.sources.stages import feature_version, write_versioned
from chronoload.training.fit import safe_names, with_safe_names
from chronoload.training.selection import select_features


@dataclass(frozen=True)
class SelectionRules:
    target: str = "energy"
    weather: bool = False
    traffic: bool = False
    method_1: str = "f"
    k_1: int = 20
    method_2: str = "rfe"
    k_2: int = 10
    holidays: Sequence[str] = HOLIDAYS
    seed: int = 42
    trees: int = 100
    depth: int = 8

    def version(self) -> str:
        return feature_version(self.weather, self.traffic, self.method_1, self.k_1, self.method_2, self.k_2)


def candidate_features(features: Sequence[str], rules: SelectionRules) -> list[str]:
    """Features of the sources that are switched on. Temperature goes with weather."""
    out = list(features)
    for wanted, sources in ((rules.weather, ("weather", "temperature")), (rules.traffic, ("traffic",))):
        if not wanted:
            off = {c for s in sources for c in matching(out, list(SOURCE_SUBSTRINGS[s]))}
            out = [c for c in out if c not in off]
    return out


def complete_set(features: Sequence[str], chosen: Sequence[str], holidays: Sequence[str]) -> list[str]:
    """Chosen features, the partners of chosen cyclic ones and all holidays, in source order."""
    final = set(chosen) | set(holidays)
    for name in CYCLES:
        if any(f"{name}_" in c for c in chosen):
            final |= {f"{name}_sin", f"{name}_cos"}
    return [c for c in features if c in final]


def select_feature_set(
    frame: DataFrame, features: Sequence[str], split_date: str, rules: SelectionRules = SelectionRules(),
    store: str | None = None, ts_col: str = "timestamp", series_cols: Sequence[str] = (),
) -> tuple[DataFrame, list[str]]:
    """The reduced frame (train and test alike) and its features; written under its version when asked.

    Both rounds see train rows only.
    """
    candidates = candidate_features(features, rules)
    train = with_safe_names(train_rows(frame, split_date, ts_col))
    safe = safe_names(frame.columns)
    back = {v: k for k, v in safe.items()}
    more = dict(seed=rules.seed, trees=rules.trees, depth=rules.depth, ts_col=ts_col)
    first = select_features(train, [safe[c] for c in candidates], safe[rules.target], rules.method_1, rules.k_1, **more)
    second = select_features(train, first, safe[rules.target], rules.method_2, rules.k_2, **more)
    final = complete_set(candidates, [back[c] for c in second], rules.holidays)
    out = frame.select(*series_cols, ts_col, *[quoted(c) for c in final], quoted(rules.target))
    if store is not None:
        write_versioned(out, store, rules.version(), split_date, ts_col)
    return out, final
