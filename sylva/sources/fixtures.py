"""Driver tables -> forest-carbon schemas.

The test tables are TPC-H-like; this module maps them onto stands, cohorts, curves,
events and per-year group tables (DataFrame API), and gives the same mapping as SQL CTEs
for the DuckDB oracle. Numbers that get summed are dyadic fractions, so double sums are
exact in both engines.

Groups grow with the orders (``GROUP_ORDERS`` of them each). State and pools repeat every
``GROUP_KINDS`` groups, so that disturbed groups of one kind merge into one new group. Some
customers are no stands and some stands have no cohort, some curves are missing, and the
last year holds NULL fluxes and pools.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


GROUP_ORDERS = 3
GROUP_KINDS = 30
#: The year (of 1 to 7) with NULL fluxes and pools.
NULL_YEAR = 7
#: Rows of the largest table that one task takes. The tables of cohorts and groups are dealt to as many tasks as that makes, so
#: that a task's memory does not grow with the input; run-time coalescing would give all of them to one task per core.
ROWS_PER_TASK = 250_000


def group_of(order_key: str) -> F.Column:
    return (F.floor(F.col(order_key) / GROUP_ORDERS) + 1).cast("long")


class Fixtures:
    """Lazily built fixture views over the parquet files in ``sf_dir``."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")

    def raw(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    @cached_property
    def tasks(self) -> int | None:
        """Tasks of the tables of cohorts and groups, from the row counts in the files' footers; None (as the planner likes) for
        what a single task can take."""
        n = -(-max(self.raw("lineitem").count(), self.raw("orders").count()) // ROWS_PER_TASK)
        return max(n, self.spark.sparkContext.defaultParallelism) if n > 1 else None

    def dealt(self, table: DataFrame, *columns: str) -> DataFrame:
        """``table`` dealt by ``columns`` to ``tasks``. Two tables dealt by the columns they are joined on need no other shuffle."""
        return table if self.tasks is None else table.repartition(self.tasks, *columns)

    def _values(self, rows, schema: str) -> DataFrame:
        return self.spark.createDataFrame(rows, schema)

    @cached_property
    def stand(self) -> DataFrame:
        c = self.raw("customer").select("c_custkey", "c_nationkey").where("c_custkey % 29 <> 0")
        # stands without a cohort: keys that no order has
        c = c.select("c_custkey", "c_nationkey", F.explode(F.when(F.col("c_custkey") % 31 == 0, F.array(F.lit(1), F.lit(-1)))
                                                           .otherwise(F.array(F.lit(1)))).alias("sign"))
        c = c.withColumn("c_custkey", F.when(F.col("sign") == 1, F.col("c_custkey")).otherwise(-1 - F.col("c_custkey")))
        n = self.raw("nation").select("n_nationkey", "n_name", "n_regionkey")
        k = F.col("c_custkey")
        return c.join(n, c.c_nationkey == n.n_nationkey).select(
            k.alias("pixelIndex"),
            F.col("n_name").alias("admin_name"),
            F.col("n_regionkey").cast("int").alias("eco_id"),
            (F.lit(900) * (F.lit(1) + F.abs(k) % 4)).cast("double").alias("area"),
            F.when(k % 3 == 0, F.lit(None).cast("int")).otherwise((F.lit(1) + F.abs(k) % 4).cast("int"))
            .alias("historical_disturbance_type"),
        )

    @cached_property
    def cohort(self) -> DataFrame:
        o = self.raw("orders")
        return o.select(
            F.col("o_orderkey").alias("cohortID"),
            F.col("o_custkey").alias("pixelIndex"),
            F.col("o_orderpriority").alias("species"),
            (F.year("o_orderdate") - 1994).cast("int").alias("age"),
            F.when(F.col("o_orderstatus") == "F", F.lit(None).cast("int"))
            .when(F.col("o_orderstatus") == "O", F.lit(0)).otherwise(F.lit(2)).cast("int").alias("delayRegen"),
        )

    @cached_property
    def gcmeta(self) -> DataFrame:
        # the window runs over the distinct species, a dimension of a few rows
        species = self.raw("orders").select(F.col("o_orderpriority").alias("species")).distinct()
        species = species.withColumn("k", F.dense_rank().over(Window.orderBy("species")) - 1)
        n_species = species.count()
        n = self.raw("nation").select("n_nationkey", "n_name", "n_regionkey")
        n = n.withColumn("k", F.explode(F.sequence(F.lit(0), F.lit(n_species - 1)))).where("(n_nationkey + k) % 11 <> 0")
        return n.join(species, "k").select(
            (F.col("n_nationkey") * n_species + F.col("k")).cast("int").alias("gcID"),
            F.col("n_name").alias("admin_name"),
            F.col("n_regionkey").cast("int").alias("eco_id"),
            F.col("species"),
            (F.col("k") % 2 == 0).alias("sw"),
        )

    @cached_property
    def increments(self) -> DataFrame:
        ages = self.raw("part").select((F.col("p_size") - 1).cast("int").alias("age")).distinct()
        # each curve's ages 0..3+gcID%5, kept only where the part table has that age
        g = self.gcmeta.select("gcID").withColumn(
            "age", F.explode(F.sequence(F.lit(0), F.lit(3) + F.col("gcID") % 5)))
        g = g.join(ages, "age", "left_semi")
        g = g.where(~((F.col("gcID") % 7 == 0) & (F.col("age") == 2)))
        a = F.col("age").cast("double")
        return g.select(
            "gcID", "age",
            ((F.col("age") * (F.lit(1) + F.col("gcID") % 3)).cast("double") / F.lit(64)).alias("merch_inc"),
            (a / F.lit(128)).alias("foliage_inc"),
            ((F.col("age") - 3).cast("double") / F.lit(256)).alias("other_inc"),
        )

    @cached_property
    def events(self) -> DataFrame:
        return self.events_from_raw(self.raw("events"))

    @cached_property
    def sparse_events(self) -> DataFrame:
        """One event kind on a third of the stands: years pass between the events of a stand."""
        return self.events.where("eventID = 1 AND pixelIndex % 3 = 0")

    @staticmethod
    def events_from_raw(e: DataFrame) -> DataFrame:
        """Raw event rows -> (pixelIndex, year, eventID); works on batch and stream frames."""
        et = F.col("event_type")
        return e.select(
            F.col("user_id").alias("pixelIndex"),
            F.dayofmonth("ts").cast("int").alias("year"),
            F.when(et == "click", 1).when(et == "error", 2).when(et == "purchase", 3)
            .when(et == "signup", 4).otherwise(5).cast("int").alias("eventID"),
        )

    @cached_property
    def distmeta(self) -> DataFrame:
        return self._values([(1, 1, 3), (2, 2, 1), (3, 3, 2), (4, 4, None)],
                            "eventID int, disturbance_type_id int, priority int")

    @cached_property
    def spatial_unit(self) -> DataFrame:
        n = self.raw("nation")
        return n.select(
            (F.col("n_nationkey") + 1).cast("int").alias("id"),
            F.col("n_nationkey").cast("int").alias("admin_boundary_id"),
            F.col("n_regionkey").cast("int").alias("eco_boundary_id"),
            F.col("n_regionkey").cast("int").alias("spinup_parameter_id"),
            ((F.col("n_nationkey") - 10).cast("double") / F.lit(2)).alias("mean_annual_temperature"),
        )

    @cached_property
    def spinup_parameter(self) -> DataFrame:
        r = self.raw("region")
        return r.select(
            F.col("r_regionkey").cast("int").alias("id"),
            (F.lit(50) + F.lit(25) * F.col("r_regionkey")).cast("int").alias("return_interval"),
            F.lit(10).alias("min_rotations"),
            F.lit(30).alias("max_rotations"),
        )

    @cached_property
    def admin_tr(self) -> DataFrame:
        n = self.raw("nation").withColumn("locale_id", F.explode(F.array(F.lit(1), F.lit(2))))
        return n.select(
            F.col("n_nationkey").cast("int").alias("admin_boundary_id"),
            F.col("locale_id").cast("int"),
            F.when(F.col("locale_id") == 1, F.col("n_name")).otherwise(F.lower("n_name")).alias("name"),
        )

    @cached_property
    def _key_rows(self) -> DataFrame:
        """The key with a row per line."""
        li = self.raw("lineitem").select((F.year("l_shipdate") - 1994).cast("int").alias("year"), F.col("l_orderkey").alias("cohortID"))
        o = self.raw("orders").select(F.col("o_orderkey").alias("cohortID"), F.col("o_custkey").alias("pixelIndex"))
        return self.dealt(li, "cohortID").join(self.dealt(o, "cohortID"), "cohortID").select(
            "year", "cohortID", "pixelIndex", group_of("cohortID").alias("row_idx"))

    @cached_property
    def key(self) -> DataFrame:
        return self._key_rows.distinct()

    @cached_property
    def group_key(self) -> DataFrame:
        """The key dealt by year and group, as flux is: what is counted by group or joined with the flux lies in one task."""
        return self.dealt(self.key, "year", "row_idx")

    EMISSION_FLUX = ("DisturbanceBioCO2Emission", "DecayDOMCO2Emission", "DisturbanceDOMCO2Emission",
                     "DisturbanceBioCH4Emission", "DisturbanceDOMCH4Emission", "DisturbanceBioCOEmission",
                     "DisturbanceDOMCOEmission")
    NPP_FLUX = ("DeltaBiomass_AG", "DeltaBiomass_BG", "TurnoverMerchLitterInput", "TurnoverFolLitterInput",
                "TurnoverOthLitterInput", "TurnoverCoarseLitterInput", "TurnoverFineLitterInput")

    @cached_property
    def flux(self) -> DataFrame:
        li = self.raw("lineitem").select((F.year("l_shipdate") - 1994).cast("int").alias("year"), group_of("l_orderkey").alias("row_idx"),
                                         "l_linenumber", "l_suppkey", "l_quantity")
        li = self.dealt(li, "year", "row_idx")
        q = F.col("l_quantity")
        aggs = []
        for i, name in enumerate(self.EMISSION_FLUX):
            aggs.append((F.sum(F.when(F.col("l_linenumber") % 7 == i, q).otherwise(F.lit(0.0))).cast("double")
                         / F.lit(64)).alias(name))
        for i, name in enumerate(self.NPP_FLUX):
            aggs.append((F.sum(F.when(F.col("l_suppkey") % 7 == i, q).otherwise(F.lit(0.0))).cast("double")
                         / F.lit(64)).alias(name))
        out = li.groupBy("year", "row_idx").agg(*aggs)
        unknown = (F.col("year") == NULL_YEAR) & (F.col("row_idx") % GROUP_KINDS == 11)
        first = self.EMISSION_FLUX[0]
        return out.withColumn(first, F.when(~unknown, F.col(first)))

    @cached_property
    def pools(self) -> DataFrame:
        return self._pools("row_idx")

    @cached_property
    def group_pools(self) -> DataFrame:
        """The pools dealt by year and group, as ``group_key`` is."""
        return self._pools("year", "row_idx")

    def _pools(self, *columns: str) -> DataFrame:
        x = self.dealt(self._key_rows.select("year", "row_idx"), *columns).distinct()
        r, y = F.col("row_idx") % GROUP_KINDS, F.col("year")
        return x.select(
            "year", "row_idx",
            F.lit(1.0).alias("Input"),
            (((r * 3 + y) % 16).cast("double") / F.lit(4)).alias("Merch"),
            (((r + y) % 8).cast("double") / F.lit(8)).alias("Foliage"),
            ((r % 4).cast("double") / F.lit(8)).alias("StemSnags"),
            F.when(~((y == NULL_YEAR) & (r == 7)), ((r % 5) * y).cast("double") / F.lit(16)).alias("Products"),
        )

    # One group (number 0) that holds the cohorts of every third order, beside the groups of the others.
    @cached_property
    def hot_key(self) -> DataFrame:
        return self.key.withColumn("row_idx", F.when(F.col("cohortID") % 3 == 0, F.lit(0)).otherwise(F.col("row_idx")).cast("long"))

    @staticmethod
    def _with_hot(table: DataFrame) -> DataFrame:
        """``table`` with a row per year for group 0: the greatest value of each column."""
        names = [c for c in table.columns if c not in ("year", "row_idx")]
        hot = table.groupBy("year").agg(*[F.max(c).alias(c) for c in names]).withColumn("row_idx", F.lit(0).cast("long"))
        return table.unionByName(hot)

    @cached_property
    def hot_flux(self) -> DataFrame:
        return self._with_hot(self.flux)

    @cached_property
    def hot_pools(self) -> DataFrame:
        return self._with_hot(self.pools)

    @cached_property
    def hot_cohort_stands(self) -> DataFrame:
        """Cohorts with stand attributes, alike for every third order."""
        hot = F.col("cohortID") % 3 == 0
        c = self.cohort.join(self.stand, "pixelIndex", "left")
        alike = {"species": F.lit("mixed"), "admin_name": F.lit(None).cast("string"), "age": F.lit(1), "delayRegen": F.lit(0),
                 "eco_id": F.lit(0), "historical_disturbance_type": F.lit(None).cast("int")}
        return c.select(*[F.when(hot, alike[x]).otherwise(F.col(x)).alias(x) if x in alike else x for x in c.columns])

    @cached_property
    def state(self) -> DataFrame:
        x = self.dealt(self._key_rows.select("row_idx"), "row_idx").distinct()
        r = F.col("row_idx") % GROUP_KINDS
        return x.select(
            "row_idx",
            ((r % 8).cast("int") * 10).alias("age"),
            (r % 3).cast("int").alias("delay"),
            (r % 5).cast("int").alias("gcID"),
        )

    @cached_property
    def matrix(self) -> DataFrame:
        return self._values(
            [(1, "Merch", "Products", 0.75), (1, "Merch", "CO2", 0.25), (2, "Merch", "StemSnags", 0.5),
             (2, "Merch", "CO2", 0.5), (2, "Foliage", "CO2", 1.0), (3, "Foliage", "StemSnags", 1.0)],
            "disturbance_type_id int, source string, sink string, proportion double")


    # Matrices that follow a disturbance: turnover and mixing, for every group alike (dyadic rates).
    YEARLY_TURNOVER = [("Merch", "StemSnags", 0.0625), ("Merch", "Merch", 0.9375), ("Foliage", "Litter", 0.25), ("Foliage", "Foliage", 0.75)]
    YEARLY_MIXING = [("StemSnags", "MediumSoil", 0.125), ("StemSnags", "StemSnags", 0.875), ("Litter", "MediumSoil", 0.5), ("Litter", "Litter", 0.5)]
    POOL_NAMES = ("Input", "Merch", "Foliage", "StemSnags", "Products", "CO2", "Litter", "MediumSoil")

    @cached_property
    def yearly_turnover(self) -> DataFrame:
        return self._values(self.YEARLY_TURNOVER, "source string, sink string, proportion double")

    @cached_property
    def yearly_mixing(self) -> DataFrame:
        return self._values(self.YEARLY_MIXING, "source string, sink string, proportion double")

    # Small model dimension tables used by single operators (test coefficients, dyadic).
    SPECIES = [(1, "Black spruce"), (2, "Unspecified softwood species"), (3, "White birch"),
               (4, "Unspecified hardwood species")]
    POOL_CLASS = [("Merch", "Biomass"), ("Foliage", "Biomass"), ("Other", "Biomass")]
    DECAY = [("StemSnags", 0.0625, 5.0, 2.0), ("MediumSoil", 0.015625, 10.0, 2.0)]
    TURNOVER = [("Merch", "StemSnags", 1.0), ("Foliage", "AboveGroundVeryFastSoil", 1.0),
                ("Other", "BranchSnags", 0.5), ("Other", "AboveGroundFastSoil", 0.5)]
    FLUX_MAP = [("Merch", "CO2", "DisturbanceBioCO2Emission"), ("Foliage", "CO2", "DisturbanceBioCO2Emission"),
                ("Merch", "Products", "DisturbanceSoftProduction"), ("Merch", "StemSnags", "DisturbanceMerchToSnags"),
                ("Foliage", "StemSnags", "DisturbanceFoliageToSnags")]

    # Coefficients by spatial unit (H2; the unit number is scaled) and by wood type (H4, H5).
    ROOTS = [(0, 1.5, 0.75, 0.25, 0.125, 0.5, 4.0), (1, 1.25, 0.5, 0.5, 0.25, 0.5, 8.0)]

    @cached_property
    def stand_coefficients(self) -> DataFrame:
        u = F.col("id")
        return self.spatial_unit.select(u.alias("spatial_unit_id"), (F.lit(4) * (1 + u % 3)).cast("double").alias("max_bio"),
                                        (1 + u % 2).cast("double").alias("max_r"))

    @cached_property
    def roots(self) -> DataFrame:
        return self._values(self.ROOTS, "sw_hw int, hw_a double, hw_b double, sw_a double, frp_a double, frp_b double, frp_c double")

    @cached_property
    def species(self) -> DataFrame:
        return self._values(self.SPECIES, "species_id int, species_name string")

    @cached_property
    def pool_class(self) -> DataFrame:
        return self._values(self.POOL_CLASS, "pool string, pool_class string")

    @cached_property
    def decay(self) -> DataFrame:
        return self._values(self.DECAY, "pool string, base_rate double, ref_temp double, q10 double")

    @cached_property
    def turnover(self) -> DataFrame:
        return self._values(self.TURNOVER, "source string, sink string, proportion double")

    @cached_property
    def flux_map(self) -> DataFrame:
        return self._values(self.FLUX_MAP, "source string, sink string, flux string")


def _values_sql(rows, cols: str, types: dict[int, str] | None = None) -> str:
    def lit(i, v):
        if isinstance(v, str):
            return "'" + v.replace("'", "''") + "'"
        if isinstance(v, float):
            return f"cast({v!r} as double)"
        return f"cast({v} as int)" if (types or {}).get(i, "int") == "int" else repr(v)
    body = ",".join("(" + ",".join(lit(i, v) for i, v in enumerate(r)) + ")" for r in rows)
    return f"select * from (values {body}) t({cols})"


# The same mapping as SQL, for the DuckDB oracle (each CTE runs in Spark SQL too).
FIXTURE_SQL: dict[str, str] = {
    "f_stand": """
select c_custkey as pixelIndex, n_name as admin_name, cast(n_regionkey as int) as eco_id,
       cast(900*(1+abs(c_custkey)%4) as double) as area,
       case when c_custkey%3=0 then null else cast(1+abs(c_custkey)%4 as int) end as historical_disturbance_type
from (select c_custkey, c_nationkey from customer where c_custkey%29<>0
      union all select -1-c_custkey, c_nationkey from customer where c_custkey%29<>0 and c_custkey%31=0) c
join nation on c_nationkey=n_nationkey""",
    "f_cohort": """
select o_orderkey as cohortID, o_custkey as pixelIndex, o_orderpriority as species,
       cast(year(o_orderdate)-1994 as int) as age,
       cast(case when o_orderstatus='F' then null when o_orderstatus='O' then 0 else 2 end as int) as delayRegen
from orders""",
    "f_gcmeta": """
select cast(n_nationkey*n_species+k as int) as gcID, n_name as admin_name, cast(n_regionkey as int) as eco_id, species,
       k%2=0 as sw
from nation cross join (select species, row_number() over (order by species)-1 as k, count(*) over () as n_species
                        from (select distinct o_orderpriority as species from orders) a) b
where (n_nationkey+k)%11<>0""",
    "f_increments": """
select gcID, age, cast(age*(1+gcID%3) as double)/64 as merch_inc, cast(age as double)/128 as foliage_inc,
       cast(age-3 as double)/256 as other_inc
from f_gcmeta cross join (select distinct cast(p_size-1 as int) as age from part) a
where age<=3+gcID%5 and not (gcID%7=0 and age=2)""",
    "f_events": """
select user_id as pixelIndex, cast(day(ts) as int) as year,
       cast(case event_type when 'click' then 1 when 'error' then 2 when 'purchase' then 3
            when 'signup' then 4 else 5 end as int) as eventID
from events""",
    "f_sparse_events": """select * from f_events where eventID=1 and pixelIndex%3=0""",
    "f_distmeta": """
select * from (values (1,1,3),(2,2,1),(3,3,2),(4,4,cast(null as int))) t(eventID,disturbance_type_id,priority)""",
    "f_spatial_unit": """
select cast(n_nationkey+1 as int) as id, cast(n_nationkey as int) as admin_boundary_id,
       cast(n_regionkey as int) as eco_boundary_id, cast(n_regionkey as int) as spinup_parameter_id,
       cast(n_nationkey-10 as double)/2 as mean_annual_temperature from nation""",
    "f_spinup_parameter": """
select cast(r_regionkey as int) as id, cast(50+25*r_regionkey as int) as return_interval,
       10 as min_rotations, 30 as max_rotations from region""",
    "f_admin_tr": """
select cast(n_nationkey as int) as admin_boundary_id, cast(l as int) as locale_id,
       case when l=1 then n_name else lower(n_name) end as name
from nation cross join (select * from (values (1),(2)) t(l)) x""",
    "f_key": """
select distinct cast(year(l_shipdate)-1994 as int) as year, l_orderkey as cohortID, o_custkey as pixelIndex,
       cast(floor(l_orderkey/3.0) as bigint)+1 as row_idx
from lineitem join orders on l_orderkey=o_orderkey""",
    "f_flux": """
select cast(year(l_shipdate)-1994 as int) as year, cast(floor(l_orderkey/3.0) as bigint)+1 as row_idx,
""" + ",\n".join(
        [("       case when not (any_value(year(l_shipdate))=2001 and any_value(cast(floor(l_orderkey/3.0) as bigint)+1)%30=11) then "
          if i == 0 else "       ")
         + f"cast(sum(case when l_linenumber%7={i} then l_quantity else 0 end) as double)/64 {'end ' if i == 0 else ''}as {n}"
         for i, n in enumerate(Fixtures.EMISSION_FLUX)]
        + [f"       cast(sum(case when l_suppkey%7={i} then l_quantity else 0 end) as double)/64 as {n}"
           for i, n in enumerate(Fixtures.NPP_FLUX)]) + """
from lineitem group by cast(year(l_shipdate)-1994 as int), cast(floor(l_orderkey/3.0) as bigint)+1""",
    "f_pools": """
select year, row_idx, cast(1 as double) as Input, cast((z*3+year)%16 as double)/4 as Merch,
       cast((z+year)%8 as double)/8 as Foliage, cast(z%4 as double)/8 as StemSnags,
       case when not (year=7 and z=7) then cast((z%5)*year as double)/16 end as Products
from (select distinct year, row_idx, row_idx%30 as z from f_key) x""",
    "f_hot_key": """
select year, cohortID, pixelIndex, case when cohortID%3=0 then 0 else row_idx end as row_idx from f_key""",
    "f_hot_flux": "select * from f_flux union all select year, 0, "
                  + ", ".join(f"max({c})" for c in Fixtures.EMISSION_FLUX + Fixtures.NPP_FLUX) + " from f_flux group by year",
    "f_hot_pools": "select * from f_pools union all select year, 0, max(Input), max(Merch), max(Foliage), max(StemSnags), max(Products) "
                   "from f_pools group by year",
    "f_hot_cohort_stands": """
select c.cohortID, c.pixelIndex, case when c.cohortID%3=0 then 'mixed' else c.species end as species,
       cast(case when c.cohortID%3=0 then 1 else c.age end as int) as age,
       cast(case when c.cohortID%3=0 then 0 else c.delayRegen end as int) as delayRegen,
       case when c.cohortID%3<>0 then s.admin_name end as admin_name,
       cast(case when c.cohortID%3=0 then 0 else s.eco_id end as int) as eco_id,
       case when c.cohortID%3<>0 then s.historical_disturbance_type end as historical_disturbance_type
from f_cohort c left join f_stand s on c.pixelIndex = s.pixelIndex""",
    "f_state": """
select row_idx, cast(z%8 as int)*10 as age, cast(z%3 as int) as delay, cast(z%5 as int) as gcID
from (select distinct row_idx, row_idx%30 as z from f_key) x""",
    "f_stand_coefficients": """
select id as spatial_unit_id, cast(4*(1+id%3) as double) as max_bio, cast(1+id%2 as double) as max_r from f_spatial_unit""",
    "f_roots": _values_sql(Fixtures.ROOTS, "sw_hw,hw_a,hw_b,sw_a,frp_a,frp_b,frp_c"),
    "f_species": _values_sql(Fixtures.SPECIES, "species_id,species_name"),
    "f_pool_class": _values_sql(Fixtures.POOL_CLASS, "pool,pool_class"),
    "f_decay": _values_sql(Fixtures.DECAY, "pool,base_rate,ref_temp,q10"),
    "f_turnover": _values_sql(Fixtures.TURNOVER, "source,sink,proportion"),
    "f_yearly_turnover": _values_sql(Fixtures.YEARLY_TURNOVER, "source,sink,proportion"),
    "f_yearly_mixing": _values_sql(Fixtures.YEARLY_MIXING, "source,sink,proportion"),
    "f_flux_map": _values_sql(Fixtures.FLUX_MAP, "source,sink,flux"),
    "f_matrix": """
select disturbance_type_id, source, sink, cast(proportion as double) as proportion
from (values (1,'Merch','Products',0.75),(1,'Merch','CO2',0.25),(2,'Merch','StemSnags',0.5),(2,'Merch','CO2',0.5),
  (2,'Foliage','CO2',1.0),(3,'Foliage','StemSnags',1.0)) t(disturbance_type_id,source,sink,proportion)""",
}

_DEPS = {
    "f_increments": ["f_gcmeta"],
    "f_sparse_events": ["f_events"],
    "f_stand_coefficients": ["f_spatial_unit"],
    "f_pools": ["f_key"],
    "f_hot_key": ["f_key"],
    "f_hot_flux": ["f_flux"],
    "f_hot_pools": ["f_pools"],
    "f_hot_cohort_stands": ["f_cohort", "f_stand"],
    "f_state": ["f_key"],
}


def with_fixtures(body: str, *extra_ctes: tuple[str, str]) -> str:
    """``WITH`` clause holding every fixture CTE that ``body`` (or an extra CTE) names,
    dependencies first, then the extra CTEs in the given order."""
    text = body + " ".join(sql for _, sql in extra_ctes)
    needed: list[str] = []

    def add(name: str):
        for dep in _DEPS.get(name, []):
            add(dep)
        if name not in needed:
            needed.append(name)

    for name in FIXTURE_SQL:
        if name in text:
            add(name)
    parts = [f"{n} as ({FIXTURE_SQL[n]})" for n in needed]
    parts += [f"{n} as ({sql})" for n, sql in extra_ctes]
    if not parts:
        return body
    return "with " + ",\n".join(parts) + "\n" + body
