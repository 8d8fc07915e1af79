"""Table work around a year's step: the group table before the first year and the preparation of
the cohort groups of a year. The step itself, and the equilibrium spinup, are simulators and not
part of this library."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sylva.functions.columns import choose_column
from sylva.operators import attributes as at
from sylva.operators import groups as gr
from sylva.operators import growth as gw
from sylva.session import materialize
from sylva.sources.schema import ID_COLUMNS, CarbonTables, require_columns, shared_classifiers


@dataclass(frozen=True)
class Inputs:
    stands: DataFrame
    cohorts: DataFrame
    gcmeta: DataFrame
    increments: DataFrame
    units: DataFrame | None = None  # spatial units (A2 output)


@dataclass(frozen=True)
class Options:
    default_delay_spinup: int = 0
    default_historical_disturbance_type: int = 1
    default_last_pass_disturbance_type: int = 1


def classifiers(inputs: Inputs) -> list[str]:
    """Q16: classifiers shared by the raw cohort table and the curve metadata."""
    return shared_classifiers(inputs.cohorts, inputs.gcmeta, exclude=(*ID_COLUMNS, "age", "sw"))


def spinup_inputs(inputs: Inputs, opts: Options = Options()):
    """C1 -> D1 -> C2 -> C3 -> B8 -> B2/B1 -> C4: (key, groups, increments per group)."""
    require_columns(inputs.cohorts, "cohorts", ("cohortID", "pixelIndex", "age"))
    cs = at.cohorts_with_stands(inputs.cohorts, inputs.stands)
    key, groups = gr.cohort_groups(cs)
    groups = at.attach_curves(groups, inputs.gcmeta)
    if inputs.units is not None:
        groups = at.attach_spatial_unit(groups, inputs.units)
    groups = at.per_hectare(groups)
    groups = at.spinup_defaults(
        groups, age_col=choose_column(inputs.cohorts, "ageSpinup", "age"),
        delay_col=choose_column(inputs.cohorts, "delaySpinup", "delay"),
        default_delay=opts.default_delay_spinup,
        default_historical=opts.default_historical_disturbance_type,
        default_last_pass=opts.default_last_pass_disturbance_type)
    if "sw" in groups.columns:
        groups = groups.withColumn("sw_hw", (~F.col("sw")).cast("int")).drop("sw")
    return key, groups, gw.expand_increments(groups, inputs.increments)


class PreparedGroups:
    """The tables of ``prepare_groups``. Each is made when it is first asked for, so that a job that wants one
    of them does not pay for the others; all hold the same row_idx."""

    def __init__(self, t: CarbonTables, inputs: Inputs, cls: Sequence[str], by: Sequence[str] = ()):
        self._given, self._inputs, self._classifiers, self._by = t, inputs, cls, list(by)

    @cached_property
    def marked(self) -> DataFrame:
        """The marked key, stored: the new key reads it twice."""
        return materialize(self._given.key, "marked-key")

    @cached_property
    def counts(self) -> DataFrame:
        """One row per group and event type, all that the group tables need of the marked key."""
        marked = self.marked if "marked" in self.__dict__ else self._given.key
        return materialize(gr.group_counts(marked, self._by), "group-counts")

    @cached_property
    def split(self) -> gr.Split:
        t = self._given
        return gr.split_disturbed(t.key, t.state, t.pools, self._classifiers, self._by, counts=self.counts)

    @cached_property
    def live(self) -> DataFrame:
        return materialize(gr.live_groups(self._given.key, self.split, self._by, self.counts), "live-groups")

    def _still_live(self, table: DataFrame) -> DataFrame:
        """The rows of groups that go on (C9). A table without the panel's columns holds for every year in
        which its group lives."""
        if set(self._by) <= set(table.columns):
            return gr.drop_inactive(table, self.live, self._by)
        return self.live.join(table, [c for c in self.live.columns if c in table.columns], "inner")

    def _clones(self, table: DataFrame) -> DataFrame:
        return gr.clone_group_rows(self.split.new_groups, table, self._by)

    @cached_property
    def key(self) -> DataFrame:
        marked = self.marked
        return materialize(gr.apply_split_to_key(marked, self.split, self._by), "new-key")

    @cached_property
    def state(self) -> DataFrame:
        old = self._given.state
        return materialize(gr.union_fill(self._still_live(old), gr.reset_disturbed_state(self._clones(old))), "new-state")

    @cached_property
    def pools(self) -> DataFrame:
        old = self._given.pools
        return gr.union_fill(self._still_live(old), gr.reset_disturbed_pools(self._clones(old)))

    @cached_property
    def flux(self) -> DataFrame | None:
        old = self._given.flux
        return None if old is None else gr.union_fill(self._still_live(old), self._clones(old))

    @cached_property
    def parameters(self) -> DataFrame:
        ids = [*self._by, "row_idx"]
        old = self._given.parameters
        old = self._still_live(old.select(*[c for c in ids if c in old.columns]))
        params = gr.parameters_from_state(old, self.state, self.split.new_groups, self._by)
        incs = gw.annual_increments(self.state, self._inputs.gcmeta, self._inputs.increments, self._classifiers, units=self._inputs.units)
        return params.join(incs.select(*ids, *gw.INCREMENT_COLUMNS), ids, "left")

    def tables(self) -> CarbonTables:
        """All of them; the key first, so that the marked key is stored before it is counted."""
        return CarbonTables(key=self.key, parameters=self.parameters, state=self.state, pools=self.pools, flux=self.flux)


def prepare_groups(t: CarbonTables, inputs: Inputs, cls: Sequence[str], by: Sequence[str] = ()) -> PreparedGroups:
    """The cohort groups of a year (or, with ``by``, of a panel of years) after its disturbances:
    C7 -> D2 -> D3 -> C8 + B5 -> F2 -> B6 -> C9 -> C10. ``t.key`` is the marked key (C6).

    The group tables need only the ``group_counts`` of the key. Rows of groups that end are dropped before
    the new groups' rows are added."""
    return PreparedGroups(t, inputs, cls, by)
