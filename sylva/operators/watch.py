"""Q18: what a run should warn about, counted while its tables are computed anyway.

Each watched table carries an ``Observation``: the counts ride along with the job that writes or collects the table, no job of
their own. They are there after the first action on the table that reads all of its rows; a stage that runs twice after a
lost executor may count its rows twice, so they are warnings, not results."""

from __future__ import annotations

import warnings
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from sylva.operators.growth import INCREMENT_COLUMNS, last_increment

#: What a count above zero means (for ``no_events``: a count of zero).
MESSAGES = {
    "ages_beyond_curve": "{n} rows are older than their growth curve; its last increment holds for them",
    "rows_without_curve": "{n} rows have no growth curve",
    "ages_without_increment": "{n} rows have an age for which their curve has no increment",
    "no_events": "no event: no cohort is disturbed",
    "unknown_events": "{n} events have no known kind; where one wins its stand counts as undisturbed",
    "unknown_area": "{n} cohorts have no known area; the totals of their groups are unknown",
}


class Watch:
    """The counts of one run, by name."""

    def __init__(self) -> None:
        self._seen: list[Observation] = []

    def count(self, df: DataFrame, checks: dict[str, Column]) -> DataFrame:
        """``df``, whose rows that meet each condition are counted when it is computed."""
        seen = Observation()
        self._seen.append(seen)
        return df.observe(seen, *[F.count_if(F.coalesce(c, F.lit(False))).alias(name) for name, c in checks.items()])

    def increments(self, rows: DataFrame, increments: DataFrame, age_col: str = "age") -> DataFrame:
        """The result of C10 (gcID, age, increments), watched."""
        ends = last_increment(increments).select("gcID", F.col("max_age").alias("__end"))
        # a gap has no row; a row with NULL increments is one too
        none = F.lit(True)
        for c in INCREMENT_COLUMNS:
            none = none & F.col(c).isNull()
        joined = rows.join(ends, "gcID", "left")
        return self.count(joined, {"ages_beyond_curve": F.col(age_col) > F.col("__end"), "rows_without_curve": F.col("__end").isNull(),
                                   "ages_without_increment": F.col("__end").isNotNull() & none}).drop("__end")

    def events(self, typed: DataFrame) -> DataFrame:
        """The result of C5, watched."""
        return self.count(typed, {"events": F.lit(True), "unknown_events": F.col("disturbance_type_id").isNull()})

    def areas(self, rows: DataFrame) -> DataFrame:
        """The result of C11, watched."""
        return self.count(rows, {"unknown_area": F.col("area").isNull()})

    def counts(self) -> dict[str, int]:
        """All counts, after the watched tables were computed; this waits for those that were not."""
        out: dict[str, int] = {}
        for seen in self._seen:
            for name, n in seen.get.items():
                out[name] = out.get(name, 0) + n
        if "events" in out:
            out["no_events"] = int(out["events"] == 0)
        return out

    def messages(self) -> list[str]:
        counts = self.counts()
        return [text.format(n=counts[name]) for name, text in MESSAGES.items() if counts.get(name)]

    def warn(self) -> Iterable[str]:
        """Raise a Python warning per message."""
        found = self.messages()
        for text in found:
            warnings.warn(text, stacklevel=2)
        return found
