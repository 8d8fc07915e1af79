"""Area weighting and yearly reports: cohort areas (C11), group areas (D4), cohort flux
(C12), flux totals (D5), emission gases (D6), product stock (D7), yearly products (E2),
NPP (D8, P3), emissions and products (P1), pool shares (P2) and stand carbon (P4).

Group tables hold densities (tC/ha). Carbon totals are sums of density x stand area in m2,
divided by 10 000 once at the end: sums of dyadic densities times integer areas are exact
in doubles, so every engine gets the same totals."""

from __future__ import annotations

import warnings
from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sylva.functions.columns import dealt, result_columns, strict_sum
from sylva.operators.heavy import split_join
from sylva.session import materialize

M2_PER_HA = 10000.0
CO2_FLUX = ("DisturbanceBioCO2Emission", "DecayDOMCO2Emission", "DisturbanceDOMCO2Emission")
CH4_FLUX = ("DisturbanceBioCH4Emission", "DisturbanceDOMCH4Emission")
CO_FLUX = ("DisturbanceBioCOEmission", "DisturbanceDOMCOEmission")
NPP_FLUX = ("DeltaBiomass_AG", "DeltaBiomass_BG", "TurnoverMerchLitterInput", "TurnoverFolLitterInput",
            "TurnoverOthLitterInput", "TurnoverCoarseLitterInput", "TurnoverFineLitterInput")
# Pools that are not forest carbon: the input placeholder, products and the atmosphere.
NON_STOCK_POOLS = ("Input", "Products", "CO2", "CH4", "CO", "NO2")


def _by(df: DataFrame, by: Sequence[str]) -> list[str]:
    return [c for c in by if c in df.columns]


def stand_areas(stands: DataFrame) -> DataFrame:
    """(pixelIndex, area in m2). A missing area column means 1 ha = 10 000 m2 (Q4: the
    reference warns "1 ha" but uses 1 m2; we use the stated hectare)."""
    if "area" not in stands.columns:
        warnings.warn("the stand table has no area: each stand counts as one hectare", stacklevel=2)
        return stands.select("pixelIndex", F.lit(M2_PER_HA).alias("area"))
    return stands.select("pixelIndex", F.col("area").cast("double").alias("area"))


def cohorts_with_area(key: DataFrame, stands: DataFrame) -> DataFrame:
    """C11: key INNER JOIN stand on pixelIndex (both large: shuffled on pixelIndex)."""
    return key.join(stand_areas(stands), "pixelIndex", "inner")


def shared_areas(key: DataFrame, stands: DataFrame, by: Sequence[str] = ("year",), tasks: int | None = None) -> DataFrame:
    """Q5's other reading: the key with the ``area`` of its stand dealt evenly to the stand's cohorts (of the same
    year), so that the areas of a stand's cohorts add up to the stand. The key is shuffled once, by stand (to ``tasks`` if they
    are given): the cohorts are counted and the area is joined where they lie. Rows without a year (``by``) have no area."""
    by = _by(key, by)
    columns = [*by, "pixelIndex", *[c for c in key.columns if c not in (*by, "pixelIndex", "area")]]
    k = key.select(*columns)
    for c in by:
        k = k.where(F.col(c).isNotNull())
    k = dealt(k.where(F.col("pixelIndex").isNotNull()), tasks, "pixelIndex")
    k = k.withColumn("__n", F.count(F.lit(1)).over(Window.partitionBy("pixelIndex", *by)))
    k = k.join(dealt(stand_areas(stands), tasks, "pixelIndex"), "pixelIndex", "inner")
    return k.select(*columns, (F.col("area") / F.col("__n")).alias("area"))


def group_area(key: DataFrame, stands: DataFrame | None, by: Sequence[str] = ("year",), equal_split: bool = False,
               tasks: int | None = None) -> DataFrame:
    """Per group, sum of its cohorts' stand areas (each cohort counts its whole stand,
    Q5). Output (by..., row_idx, area_m2, area_ha); NULL if any area is NULL (Q1). A key
    that already carries the stand ``area`` (the yearly loop attaches it once) needs no
    join with the stands: the area is one partial aggregation of the key. With ``equal_split`` a
    stand's area is dealt to its cohorts instead (``shared_areas``, by ``tasks``)."""
    by = _by(key, by)
    if equal_split:
        if stands is None:
            raise ValueError("an equal split needs the stands")
        key = shared_areas(key, stands, by, tasks)
    src = key if "area" in key.columns else cohorts_with_area(key, stands)
    return (src.groupBy(*by, "row_idx")
            .agg(strict_sum("area").alias("area_m2"))
            .withColumn("area_ha", F.col("area_m2") / F.lit(M2_PER_HA)))


def _with_groups(rows: DataFrame, table: DataFrame, keys: Sequence[str], heavy: bool) -> DataFrame:
    """``rows`` INNER JOIN a group table; ``heavy`` keeps rows of groups that hold a large share where they lie."""
    if heavy:
        return split_join(materialize(rows, "spread-rows"), table, keys)
    return rows.join(table, list(keys), "inner")


def cohort_flux(key: DataFrame, flux: DataFrame, by: Sequence[str] = ("year",), heavy: bool = False) -> DataFrame:
    """Group densities spread back to cohorts (key INNER JOIN flux on row_idx). Flux
    has one row per group, so AQE broadcasts it while it is small. ``heavy`` is for a large flux
    table with groups that hold a large share of the cohorts (``heavy.split_join``); P3 and P4 have it too."""
    by = _by(key, by)
    return _with_groups(key, flux, [*by, "row_idx"], heavy)


def flux_totals(flux: DataFrame, areas: DataFrame, by: Sequence[str] = ("year",),
                columns: Iterable[str] | None = None) -> DataFrame:
    """For each flux column, sum(density x group area) over groups, one aggregation."""
    by = _by(flux, by)
    cols = list(columns) if columns is not None else [c for c in flux.columns if c not in (*by, "row_idx")]
    j = flux.join(areas.select(*by, "row_idx", "area_m2"), [*by, "row_idx"], "inner")
    return j.groupBy(*by).agg(*[(strict_sum(F.col(c) * F.col("area_m2")) / F.lit(M2_PER_HA)).alias(c)
                                for c in cols])


def emission_gases(totals: DataFrame) -> DataFrame:
    """CO2, CH4, CO and Emissions from flux totals (NULL if a part is NULL)."""
    def add(names):
        expr = None
        for n in names:
            expr = F.col(n) if expr is None else expr + F.col(n)
        return expr
    out = totals.withColumn("CO2", add(CO2_FLUX)).withColumn("CH4", add(CH4_FLUX)).withColumn("CO", add(CO_FLUX))
    return out.withColumn("Emissions", F.col("CO2") + F.col("CH4") + F.col("CO"))


def products_stock(pools: DataFrame, areas: DataFrame, by: Sequence[str] = ("year",)) -> DataFrame:
    """sum(Products x area) per year: the stock of harvested products."""
    by = _by(pools, by)
    j = pools.select(*by, "row_idx", "Products").join(areas.select(*by, "row_idx", "area_m2"), [*by, "row_idx"])
    return j.groupBy(*by).agg((strict_sum(F.col("Products") * F.col("area_m2")) / F.lit(M2_PER_HA))
                              .alias("products_stock"))


def products_by_year(stock: DataFrame, year_col: str = "year", stock_col: str = "products_stock",
                     initial_year: int | None = None) -> DataFrame:
    """Yearly products = stock minus all earlier yearly products = stock(t) - stock(t-1);
    the first year is the whole stock (Q11). An earlier NULL makes every later year NULL,
    as the running sum in the reference does. The input has one row per year, so this
    un-partitioned window is bounded by the number of years. ``initial_year`` (0 for the spinup) names a year whose
    stock was there before: it is taken off the next year's products, and that year and those before it are not reported."""
    w = Window.orderBy(year_col)
    before = Window.orderBy(year_col).rowsBetween(Window.unboundedPreceding, -1)
    prev = F.lag(stock_col).over(w)
    broken = F.max(F.col(stock_col).isNull().cast("int")).over(before)
    val = F.when(F.coalesce(broken, F.lit(0)) == 1, F.lit(None).cast("double")).otherwise(
        F.col(stock_col) - F.coalesce(prev, F.lit(0.0)))
    out = stock if initial_year is None else stock.where(F.col(year_col) >= F.lit(initial_year))
    out = out.withColumn("Products", val)
    return out if initial_year is None else out.where(F.col(year_col) > F.lit(initial_year))


def emissions_products(key: DataFrame, stands: DataFrame, flux: DataFrame, pools: DataFrame,
                       extra_columns: Iterable[str] = (), by: Sequence[str] = ("year",)) -> DataFrame:
    """P1 (flagship): per year Products, Emissions, CO2, CH4, CO (+ requested flux columns),
    over all years in one plan. Group areas are computed once (Spark reuses the exchange
    for both branches); both yearly aggregations are partial, the two per-year results
    are joined on year. Asking for a column that is no flux raises before any job."""
    cols = result_columns(extra_columns)
    unknown = [c for c in cols if c not in (*result_columns(), *flux.columns)]
    if unknown:
        raise ValueError(f"no flux column of the name(s) {', '.join(unknown)} to report")
    areas = group_area(key, stands, by)
    gases = emission_gases(flux_totals(flux, areas, by))
    prod = products_by_year(products_stock(pools, areas, by), by[0])
    out = gases.join(prod.select(*by, "Products"), list(by), "full")
    return out.select(*by, *cols)


def _npp(flux: DataFrame) -> F.Column:
    expr = None
    for n in NPP_FLUX:
        expr = F.col(n) if expr is None else expr + F.col(n)
    return expr


def npp_by_year(key: DataFrame, flux: DataFrame, by: Sequence[str] = ("year",),
                areas: DataFrame | None = None) -> DataFrame:
    """Per year, sum over cohorts of the seven NPP flux densities (no area, as the
    reference test). The key is first counted per group (partial aggregation), so the big
    table never joins flux row by row: NPP = sum(n_cohorts x group NPP).

    With ``areas`` (D4 output) the area-weighted variant: tC = sum over groups of NPP
    density x group area (m2) / 10 000, a join of two per-group tables."""
    by = _by(key, by)
    f = flux.select(*by, "row_idx", _npp(flux).alias("__npp"))
    if areas is not None:
        j = f.join(areas.select(*by, "row_idx", "area_m2"), [*by, "row_idx"], "inner")
        return j.groupBy(*by).agg((strict_sum(F.col("__npp") * F.col("area_m2")) / F.lit(M2_PER_HA)).alias("NPP"))
    n = key.groupBy(*by, "row_idx").agg(F.count(F.lit(1)).alias("__n"))
    return n.join(f, [*by, "row_idx"], "inner").groupBy(*by).agg(strict_sum(F.col("__n") * F.col("__npp")).alias("NPP"))


def npp_by_stand(key: DataFrame, flux: DataFrame, by: Sequence[str] = ("year",), heavy: bool = False,
                 tasks: int | None = None) -> DataFrame:
    """Per stand and year, the summed NPP densities of its cohorts. The cohorts are counted per stand and group first; those
    counts are dealt by stand to ``tasks``, if they are given."""
    by = _by(key, by)
    n = key.groupBy(*by, "pixelIndex", "row_idx").agg(F.count(F.lit(1)).alias("__n"))
    f = flux.select(*by, "row_idx", _npp(flux).alias("__npp"))
    found = _with_groups(n, f, [*by, "row_idx"], heavy).select(*by, "pixelIndex", (F.col("__n") * F.col("__npp")).alias("__npp"))
    return dealt(found, tasks, *by, "pixelIndex").groupBy(*by, "pixelIndex").agg(strict_sum("__npp").alias("NPP"))


def stock_pools(pools: DataFrame, by: Sequence[str] = ("year",)) -> list[str]:
    return [c for c in pools.columns if c not in (*by, "row_idx", *NON_STOCK_POOLS)]


def total_carbon_by_stand(key: DataFrame, pools: DataFrame, by: Sequence[str] = ("year",), heavy: bool = False,
                          tasks: int | None = None) -> DataFrame:
    """Per stand and year the summed carbon densities (all pools except Input, Products
    and atmosphere) of its cohorts. Our definition; the reference draws it elsewhere. ``tasks`` as in ``npp_by_stand``."""
    by = _by(key, by)
    names = stock_pools(pools, by)
    total = None
    for c in names:
        total = F.col(c) if total is None else total + F.col(c)
    n = key.groupBy(*by, "pixelIndex", "row_idx").agg(F.count(F.lit(1)).alias("__n"))
    p = pools.select(*by, "row_idx", total.alias("__c"))
    found = _with_groups(n, p, [*by, "row_idx"], heavy).select(*by, "pixelIndex", (F.col("__n") * F.col("__c")).alias("__c"))
    return dealt(found, tasks, *by, "pixelIndex").groupBy(*by, "pixelIndex").agg(strict_sum("__c").alias("total_carbon"))


def pools_long(pools: DataFrame, names: Sequence[str] | None = None, by: Sequence[str] = ("year",)) -> DataFrame:
    """Wide pools -> (by..., row_idx, pool, value) within the row (no per-pool job). An ``unpivot`` would give the same rows,
    but behind it Spark no longer knows how they are dealt, and every sum by group would shuffle them again."""
    by = _by(pools, by)
    names = list(names) if names is not None else [c for c in pools.columns if c not in (*by, "row_idx")]
    each = [F.struct(F.lit(c).alias("pool"), F.col(c).cast("double").alias("value")) for c in names]
    return pools.select(*by, "row_idx", F.inline(F.array(*each)))


def pool_proportions(pools: DataFrame, areas: DataFrame, pool_class: DataFrame,
                     by: Sequence[str] = ("year",), digits: int = 9) -> DataFrame:
    """Per year, area-weighted carbon of each pool class and its share of the year's
    total over all stock pools. ``pool_class`` maps pool -> pool_class; the pools it leaves out
    form the class "unmapped", so that shares add up to 1. A NULL class total makes the
    year's shares NULL."""
    by = _by(pools, by)
    lp = pools_long(pools, stock_pools(pools, by), by)
    lp = lp.join(pool_class.groupBy("pool").agg(F.min("pool_class").alias("pool_class")), "pool", "left")
    lp = lp.withColumn("pool_class", F.coalesce("pool_class", F.lit("unmapped")))
    lp = lp.join(areas.select(*by, "row_idx", "area_m2"), [*by, "row_idx"], "inner")
    agg = lp.groupBy(*by, "pool_class").agg(
        (strict_sum(F.col("value") * F.col("area_m2")) / F.lit(M2_PER_HA)).alias("carbon"))
    w = Window.partitionBy(*by)
    tot = F.when(F.count("*").over(w) == F.count("carbon").over(w), F.sum("carbon").over(w))
    return agg.withColumn("share", F.round(F.col("carbon") / F.nullif(tot, F.lit(0.0)), digits))
