"""Pool transfers given as proportion tables (H6, H7), growth (H8), overmature decline (H9),
slow mixing (H10), decay rates (H1-H3) and the root split (H4, H5), over panels of groups.

Pools are handled long: (by..., row_idx, pool, value). A transfer is an equi-join of the
long pools with a matrix (selector, source, sink, proportion) and a grouped sum by sink --
a job over all groups at once, no per-group code. The ``_wide`` operators do the same within the row:
all pools of a group stand in one row, so a transfer needs one join with the matrix and no shuffle
behind it, and matrices can be multiplied first (``compose``). A model matrix and other dimensions are counted and
broadcast (the planner does not know the size of a table made from rows, and would shuffle the pools to its few keys); a
matrix keyed per group is joined as the planner likes. Pools dealt by their group are summed where they lie.

Nothing disappears: a NULL value stays NULL in every pool it would have reached, carbon without
a mapped destination or name is reported as ``UNMAPPED``, and a group without a spatial unit
keeps its rows with NULL rates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sylva.functions import formulas as fm
from sylva.functions.columns import broadcast_if_small, strict_sum

#: Name of the flux, sink or class of carbon that a table has no name for.
UNMAPPED = "unmapped"
BIOMASS_INCREMENTS = (("Merch", "merch_inc"), ("Foliage", "foliage_inc"), ("Other", "other_inc"))


def _by(df: DataFrame, by: Sequence[str]) -> list[str]:
    return [c for c in by if c in df.columns]


def _matrix(matrix: DataFrame, keys: Sequence[str], zero_self: bool = False) -> DataFrame:
    """Matrix rows keyed by ``keys`` + pool. ``zero_self`` adds a 0-proportion self row for every
    source, so a pool that is emptied still appears in the output without reading the pools
    a second time."""
    m = matrix.select(*[F.col(k) for k in keys], F.col("source").alias("pool"), "sink",
                      F.col("proportion").cast("double"))
    if zero_self:
        zero = matrix.select(*[F.col(k) for k in keys], F.col("source").alias("pool")).distinct()
        m = m.unionByName(zero.select(*keys, "pool", F.col("pool").alias("sink"), F.lit(0.0).alias("proportion")))
    return m


def apply_transfers(long_pools: DataFrame, matrix: DataFrame, selector: str = "disturbance_type_id",
                    by: Sequence[str] = ("year",), carry: Sequence[str] = ()) -> DataFrame:
    """H6: new[sink] = sum over sources of pool[source] x proportion, with the matrix chosen
    per row by ``selector`` (a type column, or ``row_idx`` for per-group matrices). A
    source absent from the row's matrix keeps its carbon; every input pool stays present
    (0 when emptied). Output (by..., row_idx, [carry...,] pool, value); ``carry`` columns
    are per-group values kept through the step (they ride along as grouping keys)."""
    by = _by(long_pools, by)
    carry = [c for c in carry if c != selector] + ([selector] if selector in carry else [])
    keys = [selector, *[c for c in by if c in matrix.columns and c != selector]]
    m = _matrix(matrix, keys, zero_self=True)
    j = long_pools.join(broadcast_if_small(m), [*keys, "pool"], "left")
    moved = j.select(*by, "row_idx", *carry, F.coalesce(F.col("sink"), F.col("pool")).alias("pool"),
                     (F.col("value") * F.coalesce(F.col("proportion"), F.lit(1.0))).alias("value"))
    return moved.groupBy(*by, "row_idx", *carry, "pool").agg(strict_sum("value").alias("value"))


def transfer_flux(long_pools: DataFrame, matrix: DataFrame, flux_map: DataFrame,
                  selector: str = "disturbance_type_id", by: Sequence[str] = ("year",)) -> DataFrame:
    """H7: carbon that moved (source != sink), rolled up to named flux columns by a
    (source, sink, flux) mapping. A move without a name is reported as ``UNMAPPED``; two
    names for one move raise while the job runs. Output (by..., row_idx, flux, value)."""
    by = _by(long_pools, by)
    keys = [selector, *[c for c in by if c in matrix.columns and c != selector]]
    m = _matrix(matrix.where(F.col("source") != F.col("sink")), keys)
    fmap = flux_map.groupBy(F.col("source").alias("pool"), "sink").agg(
        F.min("flux").alias("flux"), F.count_distinct("flux").alias("__names"))
    fmap = fmap.select("pool", "sink", F.when(F.col("__names") > 1, F.raise_error(
        F.concat(F.lit("more than one flux name for "), "pool", F.lit(" to "), "sink"))).otherwise(F.col("flux")).alias("flux"))
    moved = long_pools.join(broadcast_if_small(m), [*keys, "pool"], "inner").join(broadcast_if_small(fmap), ["pool", "sink"], "left")
    return (moved.groupBy(*by, "row_idx", F.coalesce("flux", F.lit(UNMAPPED)).alias("flux"))
            .agg(strict_sum(F.col("value") * F.col("proportion")).alias("value")))


def _growth(inc: F.Column) -> F.Column:
    return F.when(inc > 0, inc / F.lit(2.0)).otherwise(F.lit(0.0))


def half_growth(pools: DataFrame, increments: DataFrame, by: Sequence[str] = ("year",)) -> DataFrame:
    """H8: add half of each positive increment to Merch, Foliage, Other (a NULL or negative
    increment adds nothing; negatives are H9's). ``pools`` wide, ``increments`` (by...,
    row_idx, three increments). An absent biomass pool counts as 0. Returns wide pools."""
    by_p = _by(pools, by)
    inc = increments.select(*_by(increments, by_p), "row_idx", *[c for _, c in BIOMASS_INCREMENTS])
    j = pools.join(inc, [*_by(increments, by_p), "row_idx"], "left")
    for pool, c in BIOMASS_INCREMENTS:
        base = F.col(pool) if pool in pools.columns else F.lit(0.0)
        j = j.withColumn(pool, base + _growth(F.col(c)))
    return j.drop(*[c for _, c in BIOMASS_INCREMENTS])


def overmature_decline(pools: DataFrame, increments: DataFrame, turnover: DataFrame,
                       by: Sequence[str] = ("year",)) -> DataFrame:
    """H9: a negative increment moves that much carbon out of its biomass pool into snags
    and soil in the turnover proportions (turnover: source, sink, proportion). A biomass
    pool without turnover rows sends its loss to the pool ``UNMAPPED``. Returns long pools."""
    by_p = _by(pools, by)
    inc_by = _by(increments, by_p)
    # a group's losses, added up if it has several rows of increments, stand beside its pools: no second pass over the pools
    amounts = increments.groupBy(*inc_by, "row_idx").agg(F.lit(True).alias("__grown"), *[
        F.sum(F.when(F.col(c) < 0, -F.col(c)).otherwise(F.lit(0.0))).alias(f"__{c}") for _, c in BIOMASS_INCREMENTS])
    names = [c for c in pools.columns if c not in (*by_p, "row_idx")]
    base = pools.withColumns({p: F.lit(0.0) for p, _ in BIOMASS_INCREMENTS if p not in names})
    j = base.join(amounts, [*inc_by, "row_idx"], "left")

    def part(pool, value, source=None, amount=None) -> F.Column:
        return F.struct(F.lit(pool).cast("string").alias("pool"), value.cast("double").alias("value"),
                        F.lit(source).cast("string").alias("source"), (F.lit(None) if amount is None else amount).cast("double").alias("amount"))

    kept = [part(c, F.col(c)) for c in base.columns if c not in (*by_p, "row_idx")]
    lost = [part(p, -F.col(f"__{c}")) for p, c in BIOMASS_INCREMENTS]
    leaving = [part(None, F.lit(None), p, F.col(f"__{c}")) for p, c in BIOMASS_INCREMENTS]
    rows = j.select(*by_p, "row_idx", F.inline(F.when(F.col("__grown"), F.array(*kept, *lost, *leaving)).otherwise(F.array(*kept))))
    t = turnover.select("source", "sink", F.col("proportion").cast("double"))
    rows = rows.join(broadcast_if_small(t), "source", "left").where(F.col("source").isNull() | F.col("sink").isNotNull() | (F.col("amount") != 0))
    stays = F.col("source").isNull()
    rows = rows.select(*by_p, "row_idx", F.when(stays, F.col("pool")).otherwise(F.coalesce("sink", F.lit(UNMAPPED))).alias("pool"),
                       F.when(stays, F.col("value")).otherwise(F.col("amount") * F.coalesce("proportion", F.lit(1.0))).alias("value"))
    return rows.groupBy(*by_p, "row_idx", "pool").agg(strict_sum("value").alias("value"))


def slow_mixing(long_pools: DataFrame, rate: float = fm.SLOW_MIXING_RATE, source: str = "AboveGroundSlowSoil",
                sink: str = "BelowGroundSlowSoil", by: Sequence[str] = ("year",)) -> DataFrame:
    """``rate`` of the above-ground slow pool moves below ground each year."""
    spark: SparkSession = long_pools.sparkSession
    matrix = spark.createDataFrame(
        [(0, source, sink, float(rate)), (0, source, source, 1.0 - float(rate))],
        "__sel int, source string, sink string, proportion double")
    lp = long_pools.withColumn("__sel", F.lit(0))
    return apply_transfers(lp, matrix, "__sel", by)


def temp_modifiers(long_pools: DataFrame, group_units: DataFrame, units: DataFrame,
                   decay_params: DataFrame, by: Sequence[str] = ("year",)) -> DataFrame:
    """H1 per (group, DOM pool): exp((MAT - RefTemp) x ln(Q10) x 0.1). decay_params:
    (pool, base_rate, ref_temp, q10); group_units: (row_idx, spatial_unit_id). A group without
    a spatial unit, or with an unknown one, keeps its rows with a NULL modifier (as C3 does;
    C14 counts such groups)."""
    by = _by(long_pools, by)
    dp = decay_params.select("pool", "base_rate", "ref_temp", "q10")
    mat = units.select("spatial_unit_id", "mean_annual_temperature")
    j = (long_pools.join(broadcast_if_small(dp), "pool", "inner")
         .join(group_units.select("row_idx", "spatial_unit_id"), "row_idx", "left")
         .join(broadcast_if_small(mat), "spatial_unit_id", "left"))
    return j.withColumn("temp_mod", fm.temp_modifier("mean_annual_temperature", "ref_temp", "q10"))


def _pool(pools: DataFrame, name: str) -> F.Column:
    """A biomass pool; an absent one counts 0."""
    return F.col(name) if name in pools.columns else F.lit(0.0)


def stand_modifiers(pools: DataFrame, group_units: DataFrame, coefficients: DataFrame,
                    by: Sequence[str] = ("year",)) -> DataFrame:
    """H2 per group: TotBio = Merch + Foliage + Other. ``coefficients``: (spatial_unit_id, max_bio,
    max_r), joined through the group's spatial unit; NULL where a group has none."""
    total = _pool(pools, "Merch") + _pool(pools, "Foliage") + _pool(pools, "Other")
    p = pools.select(*_by(pools, by), "row_idx", total.alias("__bio"))
    j = p.join(group_units.select("row_idx", "spatial_unit_id"), "row_idx", "left").join(
        coefficients.select("spatial_unit_id", "max_bio", "max_r"), "spatial_unit_id", "left")
    return j.select(*_by(pools, by), "row_idx", fm.stand_modifier("__bio", "max_bio", "max_r").alias("stand_mod"))


def decay_rates(long_pools: DataFrame, pools: DataFrame, group_units: DataFrame, units: DataFrame,
                decay_params: DataFrame, coefficients: DataFrame, by: Sequence[str] = ("year",)) -> DataFrame:
    """H3: a_k = D_k x TempMod x StandMod for each DOM pool of each group."""
    by = _by(long_pools, by)
    tm = temp_modifiers(long_pools, group_units, units, decay_params, by)
    sm = stand_modifiers(pools, group_units, coefficients, by)
    j = tm.join(sm, [*by, "row_idx"], "left")
    return j.withColumn("decay_rate", fm.decay_rate("base_rate", "temp_mod", "stand_mod"))


ROOT_COEFFICIENTS = ("hw_a", "hw_b", "sw_a", "frp_a", "frp_b", "frp_c")


def root_split(pools: DataFrame, sw_hw: str, coefficients: DataFrame) -> DataFrame:
    """H4 + H5: total root biomass by wood type, its fine share, fine and coarse roots.
    ``coefficients``: one row per wood type (sw_hw and ``ROOT_COEFFICIENTS``); a group of
    unknown wood type has NULL roots."""
    c = coefficients.select(F.col("sw_hw").alias("__wood"), *[F.col(x).alias(f"__{x}") for x in ROOT_COEFFICIENTS])
    j = pools.join(c, F.col(sw_hw) == F.col("__wood"), "left")
    t_hw, t_sw = fm.root_biomass(_pool(pools, "Merch"), _pool(pools, "Foliage"), _pool(pools, "Other"), F.col(sw_hw),
                                 "__hw_a", "__hw_b", "__sw_a")
    known = F.col("__wood").isNotNull()
    j = j.withColumn("total_root", F.when(known, t_hw + t_sw))
    j = j.withColumn("fine_share", fm.fine_root_share("total_root", F.lit(0.0), "__frp_a", "__frp_b", "__frp_c"))
    return (j.withColumn("fine_roots", F.col("total_root") * F.col("fine_share"))
            .withColumn("coarse_roots", F.col("total_root") * (F.lit(1.0) - F.col("fine_share")))
            .drop("__wood", *[f"__{x}" for x in ROOT_COEFFICIENTS]))


def decay_matrix(rates: DataFrame, sinks: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Per-group decay transfers from H3 rates: (by..., row_idx, pool, decay_rate) and the
    destinations of decayed carbon (pool, sink, share) give rows (row_idx, source, sink,
    proportion): rate x share to each sink and 1 - rate staying in the pool. Without a
    destination, decayed carbon goes to ``UNMAPPED``."""
    by = _by(rates, by)
    r = rates.select(*by, "row_idx", F.col("pool").alias("source"), "decay_rate")
    to = sinks.select(F.col("pool").alias("source"), "sink", "share")
    out = r.join(to, "source", "left").select(
        *by, "row_idx", "source", F.coalesce("sink", F.lit(UNMAPPED)).alias("sink"),
        (F.col("decay_rate") * F.coalesce("share", F.lit(1.0))).alias("proportion"))
    stay = r.select(*by, "row_idx", "source", F.col("source").alias("sink"),
                    (F.lit(1.0) - F.col("decay_rate")).alias("proportion"))
    return out.unionByName(stay)


# ---- the same inside the row: wide pools in, wide pools out, no shuffle above the join with the matrix

#: A matrix has at most so many (source, sink) pairs; one with more is no matrix of pools.
MAX_PAIRS = 2_500


def matrix_pairs(matrix: DataFrame) -> list[tuple[str, str]]:
    """The (source, sink) pairs of a matrix, whatever the selector: names of columns, which the plan
    needs. Bounded by the square of the number of pools."""
    found = matrix.select("source", "sink").distinct().limit(MAX_PAIRS + 1).collect()
    if len(found) > MAX_PAIRS:
        raise ValueError(f"the matrix has more than {MAX_PAIRS} pairs of pools")
    if any(r["source"] is None or r["sink"] is None for r in found):
        raise ValueError("the matrix names no source or no sink in some row")
    return sorted((r["source"], r["sink"]) for r in found)


def _matrix_wide(pools: DataFrame, matrix: DataFrame, pairs: Sequence[tuple[str, str]], selector: str,
                 by: Sequence[str]) -> tuple[DataFrame, dict[tuple[str, str], F.Column], list[str]]:
    """``pools`` joined with one row of proportions per selector (a column per pair, NULL where the selector's
    matrix lacks it), those columns, and their names."""
    keys = [selector, *[c for c in by if c in matrix.columns and c != selector]]
    names = {pair: f"__m{i}" for i, pair in enumerate(pairs)}
    of = [F.sum(F.when((F.col("source") == a) & (F.col("sink") == b), F.col("proportion").cast("double"))).alias(names[a, b]) for a, b in pairs]
    wide = matrix.groupBy(*keys).agg(*of) if of else matrix.select(*keys).distinct()
    joined = pools.join(wide, keys, "left")
    return joined, {pair: F.col(n) for pair, n in names.items()}, list(names.values())


def apply_transfers_wide(pools: DataFrame, matrix: DataFrame, selector: str = "disturbance_type_id",
                         by: Sequence[str] = ("year",), pool_names: Sequence[str] | None = None) -> DataFrame:
    """H6 on wide pools: one row per group in, one row out. The matrix becomes one row of proportions per
    selector; after the join every pool is a sum over its sources within the row. A pool that only
    the matrix names is added (0 where nothing reaches it). Otherwise as ``apply_transfers``: a source
    absent from the row's matrix keeps its carbon, a NULL stays NULL in every pool that it would have
    reached. Columns that are no pool pass through."""
    by = _by(pools, by)
    names = [c for c in pools.columns if c not in (*by, "row_idx", selector)] if pool_names is None else list(pool_names)
    pairs = [p for p in matrix_pairs(matrix) if p[0] in names]
    joined, share, helpers = _matrix_wide(pools, matrix, pairs, selector, by)
    made = {}
    for pool in [*names, *dict.fromkeys(b for _, b in pairs if b not in names)]:
        value = F.col(pool) if pool in names else F.lit(0.0)
        leaves = [share[a, b].isNotNull() for a, b in pairs if a == pool]
        if leaves:
            moved = leaves[0]
            for x in leaves[1:]:
                moved = moved | x
            value = F.when(moved, F.col(pool) * F.lit(0.0)).otherwise(F.col(pool))
        for a, b in pairs:
            if b == pool:
                value = value + F.when(share[a, b].isNull(), F.lit(0.0)).otherwise(F.col(a) * share[a, b])
        made[pool] = value
    kept = [F.col(c) if c not in made else made[c].alias(c) for c in pools.columns]
    return joined.select(*kept, *[v.alias(p) for p, v in made.items() if p not in pools.columns])


def transfer_flux_wide(pools: DataFrame, matrix: DataFrame, flux_map: DataFrame, selector: str = "disturbance_type_id",
                       by: Sequence[str] = ("year",), pool_names: Sequence[str] | None = None) -> DataFrame:
    """H7 on wide pools: (by..., row_idx, one column per flux), 0 where nothing moved. Moves without a
    name add up in the column ``UNMAPPED``, which is there only if such a pair is in the matrix; two
    names for one move raise."""
    by = _by(pools, by)
    names = [c for c in pools.columns if c not in (*by, "row_idx", selector)] if pool_names is None else list(pool_names)
    pairs = [(a, b) for a, b in matrix_pairs(matrix) if a != b and a in names]
    called: dict[tuple[str, str], str] = {}
    for r in flux_map.select("source", "sink", "flux").distinct().limit(MAX_PAIRS + 1).collect():  # names of columns
        if called.setdefault((r["source"], r["sink"]), r["flux"]) != r["flux"]:
            raise ValueError(f"more than one flux name for {r['source']} to {r['sink']}")
    joined, share, _ = _matrix_wide(pools, matrix, pairs, selector, by)
    flux: dict[str, F.Column] = {}
    for pair in pairs:
        name = called.get(pair, UNMAPPED)
        flux[name] = flux.get(name, F.lit(0.0)) + F.when(share[pair].isNull(), F.lit(0.0)).otherwise(F.col(pair[0]) * share[pair])
    return joined.select(*by, "row_idx", *[v.alias(n) for n, v in sorted(flux.items())])


def slow_mixing_wide(pools: DataFrame, rate: float = fm.SLOW_MIXING_RATE, source: str = "AboveGroundSlowSoil",
                     sink: str = "BelowGroundSlowSoil") -> DataFrame:
    """H10 on wide pools: arithmetic within the row, no join."""
    moved = F.col(source) * F.lit(float(rate))
    before = F.col(sink) if sink in pools.columns else F.lit(0.0)
    return pools.withColumns({sink: before + moved, source: F.col(source) * F.lit(1.0 - float(rate))})


def overmature_decline_wide(pools: DataFrame, increments: DataFrame, turnover: DataFrame,
                            by: Sequence[str] = ("year",)) -> DataFrame:
    """H9 on wide pools: one join with the increments, the rest within the row. As ``overmature_decline``:
    a biomass pool without turnover rows sends its loss to the pool ``UNMAPPED``."""
    by = _by(pools, by)
    inc_by = _by(increments, by)
    shares: dict[tuple[str, str], float] = {}
    for r in turnover.select("source", "sink", "proportion").limit(MAX_PAIRS + 1).collect():  # a dimension of a few rows
        if r["source"] in dict(BIOMASS_INCREMENTS):
            shares[r["source"], r["sink"]] = shares.get((r["source"], r["sink"]), 0.0) + float(r["proportion"])
    inc = increments.select(*inc_by, "row_idx", *[F.col(c).alias(f"__{c}") for _, c in BIOMASS_INCREMENTS])
    out = pools.join(inc, [*inc_by, "row_idx"], "left")
    loss = {p: F.when(F.col(f"__{c}") < 0, -F.col(f"__{c}")).otherwise(F.lit(0.0)) for p, c in BIOMASS_INCREMENTS}
    homeless = [p for p in loss if not any(a == p for a, _ in shares)]
    named = [c for c in pools.columns if c not in (*by, "row_idx")]
    new = [p for p in [*loss, *dict.fromkeys(b for _, b in shares), *([UNMAPPED] if homeless else [])] if p not in named]
    made = {}
    for pool in [*named, *new]:
        value = F.col(pool) if pool in named else F.lit(0.0)
        if pool in loss:
            value = value - loss[pool]
        for (a, b), share in shares.items():
            if b == pool:
                value = value + loss[a] * F.lit(share)
        if pool == UNMAPPED:
            for p in homeless:
                value = value + loss[p]
        made[pool] = value
    return out.select(*by, "row_idx", *[v.alias(p) for p, v in made.items()])


# ---- matrices as tables: completed, checked and multiplied

def conserving(matrix: DataFrame, keys: Sequence[str], tolerance: float = 1e-9) -> DataFrame:
    """``matrix`` (keys..., source, sink, proportion); a source whose proportions do not add up to 1
    raises while the job runs. Checked before and after a product, carbon cannot leak in between."""
    total = F.sum("proportion").over(Window.partitionBy(*keys, "source"))
    where = F.concat_ws(", ", *[F.coalesce(F.col(c).cast("string"), F.lit("NULL")) for c in (*keys, "source")])
    leak = F.raise_error(F.concat(F.lit("proportions do not add up to 1: "), where)).cast("double")
    right = F.abs(total - 1) <= F.lit(tolerance)
    return matrix.withColumn("proportion", F.when(right, F.col("proportion")).otherwise(leak))


def complete(matrix: DataFrame, pool_names: Sequence[str], selectors: DataFrame | None = None) -> DataFrame:
    """``matrix`` with a row for every pool that keeps its carbon: (selector..., pool, pool, 1) where a selector's
    matrix has no row for the pool. ``selectors`` (one row per selector) names selectors without a
    matrix of their own too; without it the matrix holds for all rows (no selector)."""
    keys = [c for c in (selectors.columns if selectors is not None else [])]
    if selectors is None:
        there = {r["source"] for r in matrix.select("source").distinct().limit(MAX_PAIRS).collect()}
        rest = [(p, p, 1.0) for p in pool_names if p not in there]
        m = matrix.select("source", "sink", F.col("proportion").cast("double").alias("proportion"))
        return m.unionByName(matrix.sparkSession.createDataFrame(rest, "source string, sink string, proportion double")) if rest else m
    m = matrix.select(*keys, "source", "sink", F.col("proportion").cast("double").alias("proportion"))
    every = selectors.distinct().withColumn("source", F.explode(F.array(*[F.lit(p) for p in pool_names])))
    stays = every.join(m.select(*keys, "source").distinct(), [*keys, "source"], "left_anti") \
        .select(*keys, "source", F.col("source").alias("sink"), F.lit(1.0).alias("proportion"))
    return m.unionByName(stays)


def compose(first: DataFrame, second: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """The matrix that does what ``first`` and then ``second`` do: a sparse product, a join on the pool in
    between and a grouped sum, for all selectors at once. ``keys`` are the selector columns of the
    two; a matrix without one of them holds for all its values. Both must be complete (every pool has
    a row) and conserve carbon, which is checked on both."""
    mine, yours = [[k for k in keys if k in m.columns] for m in (first, second)]
    a = conserving(first, mine).select(*mine, "source", F.col("sink").alias("__via"), F.col("proportion").alias("__p"))
    b = conserving(second, yours).select(*yours, F.col("source").alias("__via"), "sink", F.col("proportion").alias("__q"))
    on = ["__via", *[k for k in mine if k in yours]]
    lost = F.raise_error(F.concat(F.lit("the second matrix has no row for the pool "), F.col("__via")))
    met = a.join(b, on, "left").withColumn("sink", F.when(F.col("sink").isNull(), lost).otherwise(F.col("sink")))
    every = [k for k in keys if k in mine or k in yours]
    return met.groupBy(*every, "source", "sink").agg(F.sum(F.col("__p") * F.col("__q")).alias("proportion"))
