"""Schema checks and name-driven column choices (A1, Q16). These read ``df.columns`` only,
so they never start a Spark job."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame


def require_columns(df: DataFrame | None, name: str, cols: Iterable[str]) -> DataFrame:
    """A1: raise before any job if the table is absent or misses required columns."""
    if df is None:
        raise ValueError(f"the table of {name} is needed and was not given")
    missing = [c for c in cols if c not in df.columns]
    if missing:
        raise ValueError(f"the table of {name} lacks " + ", ".join(missing))
    return df


def shared_classifiers(left: DataFrame | Sequence[str], right: DataFrame | Sequence[str],
                       exclude: Iterable[str] = ()) -> list[str]:
    """Columns both tables have, in the left table's order (R ``intersect``)."""
    lcols = left.columns if isinstance(left, DataFrame) else list(left)
    rcols = set(right.columns if isinstance(right, DataFrame) else right)
    skip = set(exclude)
    return [c for c in lcols if c in rcols and c not in skip]


# Columns of the key and group tables that are identifiers, never attributes.
ID_COLUMNS = ("cohortID", "pixelIndex", "area", "row_idx", "row_idx_prev", "year")


@dataclass(frozen=True)
class CarbonTables:
    """The five per-year tables of a run. ``key`` maps cohorts to groups (large);
    the others hold one row per live group."""

    key: DataFrame
    parameters: DataFrame
    state: DataFrame
    pools: DataFrame
    flux: DataFrame | None = None

    def with_(self, **kw) -> "CarbonTables":
        return replace(self, **kw)

    def group_tables(self) -> dict[str, DataFrame]:
        out = {"parameters": self.parameters, "state": self.state, "pools": self.pools}
        if self.flux is not None:
            out["flux"] = self.flux
        return out

    def pool_names(self) -> list[str]:
        return [c for c in self.pools.columns if c not in ("row_idx", "year")]
