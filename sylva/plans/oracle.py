"""DuckDB oracle SQL for every registered query. Each query is written the direct way (a
global ``row_number()`` for ids, cohort-level grouping for splits, plain joins), not the
way the Spark operators run, so the check is independent of the distributed design."""

from __future__ import annotations

from sylva.plans.catalog import DIGITS, HORIZON
from sylva.sources.fixtures import Fixtures, with_fixtures

EMI = Fixtures.EMISSION_FLUX
NPP = Fixtures.NPP_FLUX
POOLS = ("Input", "Merch", "Foliage", "StemSnags", "Products")


def strict(expr: str) -> str:
    return f"(case when count(*) = count({expr}) then sum({expr}) end)"


def nse(a: str, b: str, cols) -> str:
    return " and ".join(f"{a}.{c} is not distinct from {b}.{c}" for c in cols)


def long_pools(src: str = "f_pools", names=POOLS) -> str:
    return " union all ".join(f"select year, row_idx, '{p}' as pool, cast({p} as double) as value from {src}"
                              for p in names)


C1 = ("c1", """select c.cohortID, c.pixelIndex, c.species, c.age, c.delayRegen, s.admin_name, s.eco_id, s.area,
       s.historical_disturbance_type from f_cohort c left join f_stand s on c.pixelIndex = s.pixelIndex""")
D1_COLS = ("species", "age", "delayRegen", "admin_name", "eco_id", "historical_disturbance_type")
D1G = ("d1g", f"""select *, row_number() over (order by first_cohort) as row_idx from
      (select {', '.join(D1_COLS)}, min(cohortID) as first_cohort from c1 group by {', '.join(D1_COLS)}) g""")
D1K = ("d1k", f"select c.cohortID, c.pixelIndex, g.row_idx from c1 c join d1g g on {nse('c', 'g', D1_COLS)}")
SPU = ("spu", """select su.id as spatial_unit_id, su.admin_boundary_id, su.eco_boundary_id as eco_id,
       su.spinup_parameter_id, su.mean_annual_temperature, sp.return_interval, sp.min_rotations, sp.max_rotations,
       a.name as admin_name
from f_spatial_unit su join f_spinup_parameter sp on su.spinup_parameter_id = sp.id
join f_admin_tr a on a.admin_boundary_id = su.admin_boundary_id and a.locale_id = 1""")
TYPED = ("typed", """select e.pixelIndex, e.year, e.eventID, m.disturbance_type_id, m.priority from f_events e
left join (select distinct eventID, disturbance_type_id, priority from f_distmeta) m on e.eventID = m.eventID""")
WIN = ("winners", """select pixelIndex, year, eventID, disturbance_type_id from (
  select *, row_number() over (partition by pixelIndex, year order by priority asc nulls first,
         eventID asc nulls first, disturbance_type_id asc nulls first) as rn from typed) t where rn = 1""")
STYPED = ("styped", TYPED[1].replace("f_events", "f_sparse_events"))
SWIN = ("swinners", WIN[1].replace("from typed", "from styped"))
MARKED = ("marked", """select k.year, k.cohortID, k.pixelIndex, k.row_idx, w.disturbance_type_id from f_key k
left join winners w on k.pixelIndex = w.pixelIndex and k.year = w.year""")
SPLIT_COLS = ("disturbance_type_id", "age", "delay", *POOLS)
DIST = ("dist", f"""select m.year, m.cohortID, m.row_idx as row_idx_prev, m.disturbance_type_id, s.age, s.delay,
       {', '.join('p.' + c for c in POOLS)}
from marked m join f_state s on s.row_idx = m.row_idx join f_pools p on p.year = m.year and p.row_idx = m.row_idx
where m.disturbance_type_id is not null""")
NEWG = ("newg", f"""select *, (select max(row_idx) from f_state)
         + row_number() over (partition by year order by first_cohort) as row_idx from (
  select year, {', '.join(SPLIT_COLS)}, min(cohortID) as first_cohort, arg_min(row_idx_prev, cohortID) as rep
  from dist group by year, {', '.join(SPLIT_COLS)}) g""")
SPLIT = ("split", f"""select d.year, d.cohortID, d.row_idx_prev, n.row_idx from dist d join newg n
  on d.year = n.year and {nse('d', 'n', SPLIT_COLS)}""")
NEWPOOLS = ("newpools", f"""select n.year, n.row_idx, cast(1 as double) as Input,
  {', '.join('p.' + c for c in POOLS if c != 'Input')}
from newg n left join f_pools p on p.year = n.year and p.row_idx = n.rep""")
ALLPOOLS = ("allpools", "select * from f_pools union all select * from newpools")
AREAS = ("ga", f"""select k.year, k.row_idx, {strict('s.area')} as area_m2, {strict('s.area')} / 10000 as area_ha
from f_key k join f_stand s on k.pixelIndex = s.pixelIndex group by k.year, k.row_idx""")
TOTALS = ("totals", "select f.year, " + ", ".join(f"{strict(f'f.{c} * ga.area_m2')} / 10000 as {c}" for c in EMI + NPP)
          + " from f_flux f join ga on f.year = ga.year and f.row_idx = ga.row_idx group by f.year")
GASES = ("gases", f"""select year, {'+'.join(EMI[:3])} as CO2, {'+'.join(EMI[3:5])} as CH4, {'+'.join(EMI[5:7])} as CO,
  ({'+'.join(EMI[:3])}) + ({'+'.join(EMI[3:5])}) + ({'+'.join(EMI[5:7])}) as Emissions from totals""")
STOCK = ("stock", f"""select p.year, {strict('p.Products * ga.area_m2')} / 10000 as products_stock
from f_pools p join ga on p.year = ga.year and p.row_idx = ga.row_idx group by p.year""")
PBY = ("pby", """select year, case when coalesce(max(case when products_stock is null then 1 else 0 end)
   over (order by year rows between unbounded preceding and 1 preceding), 0) = 1 then null
   else products_stock - coalesce(lag(products_stock) over (order by year), 0) end as Products from stock""")
MX = ("mx", """select gcID, max(age) as max_age, arg_max(merch_inc, age) as merch_inc,
  arg_max(foliage_inc, age) as foliage_inc, arg_max(other_inc, age) as other_inc from f_increments group by gcID""")
SINC = ("sinc", """select s.row_idx, i.merch_inc, i.foliage_inc, i.other_inc from f_state s
left join mx on mx.gcID = s.gcID
left join f_increments i on i.gcID = s.gcID and i.age = case when s.age > mx.max_age then mx.max_age else s.age end""")
LP = ("lp", long_pools())
LPT = ("lpt", "select *, cast(row_idx % 5 as int) as disturbance_type_id from lp")
NPP_SUM = "+".join(f"f.{c}" for c in NPP)
GU = ("gu", """select row_idx, case when row_idx % 13 <> 0
   then cast(row_idx % (select count(*) from f_spatial_unit) + 1 as int) end as spatial_unit_id from f_state""")
TM = ("tm", """select lp.year, lp.row_idx, lp.pool, d.base_rate,
  exp((u.mean_annual_temperature - d.ref_temp) * ln(d.q10) * 0.1) as temp_mod
from lp join f_decay d on d.pool = lp.pool left join gu on gu.row_idx = lp.row_idx
left join f_spatial_unit u on u.id = gu.spatial_unit_id""")
SM = ("sm", """select p.year, p.row_idx, cast(1.0 as double) + (c.max_r - cast(1.0 as double))
   * exp(cast(-6.93 as double) * ((p.Merch + p.Foliage + cast(0.0 as double)) / c.max_bio)) as stand_mod
from f_pools p left join gu on gu.row_idx = p.row_idx left join f_stand_coefficients c on c.spatial_unit_id = gu.spatial_unit_id""")
WOOD = ("wood", "select row_idx, case when row_idx % 3 < 2 then cast(row_idx % 3 as int) end as sw_hw from f_state")
SITES = ("sites", """select s.row_idx, g.admin_name, g.eco_id, g.species from f_state s
left join (select *, row_number() over (order by gcID) - 1 as k from f_gcmeta) g
  on g.k = s.row_idx % 30 % (select count(*) from f_gcmeta)""")
# the same split with the site of a group among the columns that must agree
PCOLS = ("disturbance_type_id", "species", "age", "delay", *POOLS)
PDIST = ("pdist", f"""select m.year, m.cohortID, m.row_idx as row_idx_prev, m.disturbance_type_id, si.species, s.age, s.delay,
       {', '.join('p.' + c for c in POOLS)}
from marked m join f_state s on s.row_idx = m.row_idx join sites si on si.row_idx = m.row_idx
join f_pools p on p.year = m.year and p.row_idx = m.row_idx where m.disturbance_type_id is not null""")
PNEW = ("pnew", f"""select *, (select max(row_idx) from f_state)
         + row_number() over (partition by year order by first_cohort) as row_idx from (
  select year, {', '.join(PCOLS)}, min(cohortID) as first_cohort, arg_min(row_idx_prev, cohortID) as rep
  from pdist group by year, {', '.join(PCOLS)}) g""")
PKEY = ("pkey", f"""select m.year, m.cohortID, m.row_idx as row_idx_prev, coalesce(x.row_idx, m.row_idx) as row_idx from marked m
left join (select d.year, d.cohortID, n.row_idx from pdist d join pnew n on d.year = n.year and {nse('d', 'n', PCOLS)}) x
  on x.year = m.year and x.cohortID = m.cohortID""")
PSTATE = ("pstate", """select year, row_idx, age, delay, admin_name, eco_id, species from (
  select y.year, s.row_idx, s.age, s.delay, si.admin_name, si.eco_id, si.species
  from (select distinct year, row_idx from f_key) y join f_state s on s.row_idx = y.row_idx join sites si on si.row_idx = s.row_idx
  union all select n.year, n.row_idx, 1, s.delay, si.admin_name, si.eco_id, si.species
  from pnew n join f_state s on s.row_idx = n.rep join sites si on si.row_idx = n.rep) a
where exists (select 1 from pkey k where k.year = a.year and k.row_idx = a.row_idx)""")

def _prepared(table: str, columns: str) -> str:
    """Old rows and those of the new groups' representatives, kept where a cohort holds the group."""
    return f"""select * from (select * from {table} union all select n.year, n.row_idx, {columns}
  from pnew n left join {table} p on p.year = n.year and p.row_idx = n.rep) a
where exists (select 1 from pkey k where k.year = a.year and k.row_idx = a.row_idx)"""


def q(body: str, *ctes) -> str:
    return with_fixtures(body, *ctes)


def _gate() -> str:
    g = "(s.tsld is null or s.tsld <= s.delay)"
    return q(f"""select s.row_idx, s.delay, s.tsld as time_since_last_disturbance,
  case when {g} then 0 else s.age end as age,
  case when {g} then 0 else p.age end as param_age,
  case when {g} then cast(0 as double) else p.merch_inc end as merch_inc,
  case when {g} then cast(0 as double) else p.foliage_inc end as foliage_inc,
  case when {g} then cast(0 as double) else p.other_inc end as other_inc
from s join p on s.row_idx = p.row_idx""",
             ("s", """select row_idx, age, delay, gcID,
                case when row_idx % 4 = 0 then null else cast(row_idx % 5 as double) end as tsld from f_state"""),
             ("p", """select s.row_idx, s.age, i.merch_inc, i.foliage_inc, i.other_inc from s
                left join f_increments i on i.gcID = s.gcID and i.age = s.delay + 1"""))


def _b6() -> str:
    return q("""select p.row_idx, p.disturbance_type, st.age, st.mean_annual_temperature from
  (select row_idx, 0 as disturbance_type from f_state
   union all select row_idx + 100, cast(row_idx % 4 + 1 as int) from f_state) p
left join (select a.row_idx, a.age, u.mean_annual_temperature from
   (select row_idx, age, gcID from f_state union all select row_idx + 100, 1, gcID from f_state) a
   left join f_spatial_unit u on u.id - 1 = a.gcID) st on st.row_idx = p.row_idx""")


def _decline() -> str:
    inc = ("oinc", "select p.year, p.row_idx, sinc.merch_inc, sinc.foliage_inc, sinc.other_inc "
                   "from f_pools p join sinc on sinc.row_idx = p.row_idx")
    losses = ("losses", " union all ".join(
        f"select year, row_idx, '{p}' as source, case when {c} < 0 then -{c} else cast(0 as double) end as amount "
        f"from oinc" for p, c in (("Merch", "merch_inc"), ("Foliage", "foliage_inc"), ("Other", "other_inc"))))
    rows = ("rows_", long_pools() + " union all select year, row_idx, 'Other', cast(0 as double) from f_pools"
            " union all select l.year, l.row_idx, t.sink, l.amount * t.proportion from losses l"
            " join f_turnover t on t.source = l.source"
            " union all select year, row_idx, source, -amount from losses")
    return q(f"select year, row_idx, pool, {strict('value')} as value from rows_ group by year, row_idx, pool",
             MX, SINC, inc, losses, rows)


def _half_growth() -> str:
    hg = ("hg", """select p.year, p.row_idx,
  p.Merch + case when sinc.merch_inc > 0 then sinc.merch_inc / 2 else cast(0 as double) end as Merch,
  p.Foliage + case when sinc.foliage_inc > 0 then sinc.foliage_inc / 2 else cast(0 as double) end as Foliage,
  cast(0 as double) + case when sinc.other_inc > 0 then sinc.other_inc / 2 else cast(0 as double) end as Other
from f_pools p left join sinc on sinc.row_idx = p.row_idx""")
    body = " union all ".join(f"select year, row_idx, '{c}' as pool, {c} as value from hg"
                              for c in ("Merch", "Foliage", "Other"))
    return q(body, MX, SINC, hg)


def _transfers() -> str:
    moved = ("moved", """select lpt.year, lpt.row_idx, coalesce(m.sink, lpt.pool) as pool,
  lpt.value * coalesce(m.proportion, cast(1 as double)) as value
from lpt left join f_matrix m on m.disturbance_type_id = lpt.disturbance_type_id and m.source = lpt.pool
union all select year, row_idx, pool, cast(0 as double) from lp""")
    return q(f"select year, row_idx, pool, {strict('value')} as value from moved group by year, row_idx, pool",
             LP, LPT, moved)


def _wide_transfers() -> str:
    """Each pool of a group on a line of its own, moved, summed, and put beside each other again."""
    return _in_turn(["f_matrix"], (*POOLS, "CO2"))


def _in_turn(matrices: list[str], names) -> str:
    """The matrices applied one after the other to long pools, wide at the end."""
    ctes = [("s0", " union all ".join(f"select year, row_idx, cast(row_idx % 5 as int) as disturbance_type_id, '{p}' as pool, "
                                      f"cast({p if p in POOLS else 0} as double) as value from f_pools" for p in names))]
    for i, m in enumerate(matrices):
        of = "m.disturbance_type_id = s.disturbance_type_id and " if m == "f_matrix" else ""
        ctes.append((f"t{i}", f"""select s.year, s.row_idx, s.disturbance_type_id, coalesce(m.sink, s.pool) as pool,
            s.value * coalesce(m.proportion, cast(1 as double)) as value from s{i} s left join {m} m on {of}m.source = s.pool
            union all select year, row_idx, disturbance_type_id, pool, value * 0 from s{i}"""))
        ctes.append((f"s{i + 1}", f"""select year, row_idx, disturbance_type_id, pool, {strict('value')} as value from t{i}
            group by year, row_idx, disturbance_type_id, pool"""))
    pools = ", ".join(f"max(case when pool = '{p}' then value end) as {p}" for p in names)
    return q(f"select year, row_idx, {pools} from s{len(matrices)} group by year, row_idx", *ctes)


def _wide_flux() -> str:
    """Per group the sum over the moves of each name; 0 where the group's matrix has none of them."""
    named = ("named", """select m.disturbance_type_id, m.source, m.proportion, coalesce(f.flux, 'unmapped') as flux from f_matrix m
        left join f_flux_map f on f.source = m.source and f.sink = m.sink where m.source <> m.sink""")
    names = sorted({n for _, _, n in Fixtures.FLUX_MAP})
    cols = ", ".join(f"case when count(*) filter (n.flux = '{n}') = count(l.value) filter (n.flux = '{n}') "
                     f"then coalesce(sum(l.value * n.proportion) filter (n.flux = '{n}'), 0) end as {n}" for n in names)
    return q(f"""select l.year, l.row_idx, {cols} from lpt l left join named n
        on n.disturbance_type_id = l.disturbance_type_id and n.source = l.pool group by l.year, l.row_idx""", LP, LPT, named)


def _product() -> str:
    """Types 0 to 4: unit carbon in every pool, moved by the three matrices one after the other."""
    names = ", ".join(f"('{p}')" for p in Fixtures.POOL_NAMES)
    unit = ("u0", f"""select t.type as disturbance_type_id, p.pool as source, p.pool, cast(1 as double) as value
        from (select distinct cast(row_idx % 5 as int) as type from f_pools) t, (values {names}) p(pool)""")
    steps = []
    for i, m in enumerate(("f_matrix", "f_yearly_turnover", "f_yearly_mixing")):
        of = "m.disturbance_type_id = u.disturbance_type_id and " if m == "f_matrix" else ""
        steps.append((f"u{i + 1}", f"""select u.disturbance_type_id, u.source, coalesce(m.sink, u.pool) as pool,
            sum(u.value * coalesce(m.proportion, cast(1 as double))) as value from u{i} u left join {m} m on {of}m.source = u.pool group by all"""))
    return q("select disturbance_type_id, source, pool as sink, value as proportion from u3 where value <> 0", unit, *steps)


def _decline_wide() -> str:
    inc = ("oinc", "select p.*, sinc.merch_inc, sinc.foliage_inc, sinc.other_inc from f_pools p left join sinc on sinc.row_idx = p.row_idx")
    lost = lambda c: f"(case when {c} < 0 then -{c} else cast(0 as double) end)"
    gain = lambda sink: "".join(f" + {lost(dict(Merch='merch_inc', Foliage='foliage_inc', Other='other_inc')[a])} * cast({x} as double)"
                                for a, b, x in Fixtures.TURNOVER if b == sink)
    sinks = [b for _, b, _ in Fixtures.TURNOVER if b not in POOLS]
    return q(f"""select year, row_idx, Input, Merch - {lost('merch_inc')} as Merch, Foliage - {lost('foliage_inc')} as Foliage,
        StemSnags{gain('StemSnags')} as StemSnags, Products, cast(0 as double) - {lost('other_inc')} as Other,
        {', '.join(f"cast(0 as double){gain(b)} as {b}" for b in dict.fromkeys(sinks))} from oinc""", MX, SINC, inc)


def _slow() -> str:
    rate = "cast(0.006 as double)"
    moved = ("moved", f"""select year, row_idx, case when pool = 'StemSnags' then 'MediumSoil' else pool end as pool,
   case when pool = 'StemSnags' then value * {rate} else value end as value from lp
union all select year, row_idx, pool, value * (cast(1 as double) - {rate}) from lp where pool = 'StemSnags'
union all select year, row_idx, pool, cast(0 as double) from lp""")
    return q(f"select year, row_idx, pool, {strict('value')} as value from moved group by year, row_idx, pool",
             LP, moved)


def _age_panel(winners: str = "swinners") -> str:
    e = ("ev", f"select distinct pixelIndex, year as event_year from {winners} where disturbance_type_id is not null")
    first = ("fy", "select pixelIndex, min(event_year) as first_year from ev group by pixelIndex")
    panel = ("panel", f"""select pixelIndex, cast(unnest(generate_series(first_year, {HORIZON})) as int) as year from fy""")
    p2 = ("p2", """select p.pixelIndex, p.year, max(e.event_year) over (partition by p.pixelIndex order by p.year
              rows between unbounded preceding and current row) as last_event_year
          from panel p left join ev e on e.pixelIndex = p.pixelIndex and e.event_year = p.year""")
    c = ("coh", "select cohortID, pixelIndex, cast(coalesce(delayRegen, 0) as int) as delay from f_cohort")
    t = "(p2.year - p2.last_event_year + 1)"
    resolved = (STYPED, SWIN) if winners == "swinners" else (TYPED, WIN)
    ctes = (*resolved, e, first, panel, p2, c)
    body = f"""select coh.cohortID, p2.pixelIndex, p2.year, p2.last_event_year, coh.delay,
  cast(case when {t} = 1 then 1 when {t} - 1 - coh.delay > 0 then {t} - 1 - coh.delay else 0 end as int) as lookup_age,
  cast(case when {t} - coh.delay > 0 then {t} - coh.delay else 0 end as int) as age
from p2 join coh on coh.pixelIndex = p2.pixelIndex"""
    return body, ctes


def _interval_growth() -> str:
    """A row per cohort and year, looked up one by one, summed per event."""
    body, ctes = _age_panel("winners")
    sums = ", ".join(f"{strict('i.' + c)} as {c}" for c in ("merch_inc", "foliage_inc", "other_inc"))
    return q(f"""select a.cohortID, g.gcID, a.last_event_year as event_year, cast(count(*) as int) as years,
        max(a.age) as age_at_end, {sums} from ages a
        join c1 on c1.cohortID = a.cohortID left join f_gcmeta g on {nse('c1', 'g', ('admin_name', 'eco_id', 'species'))}
        left join mx on mx.gcID = g.gcID left join f_increments i on i.gcID = g.gcID
          and i.age = case when a.lookup_age > mx.max_age then mx.max_age else a.lookup_age end
        group by a.cohortID, g.gcID, a.last_event_year""", C1, MX, *ctes, ("ages", body))


def _orphans() -> str:
    keys = ("admin_name", "eco_id", "species")
    stands = ("st", "select * from f_stand union all select * from f_stand where pixelIndex % 37 = 0")
    meta = ("me", "select * from f_distmeta union all select 2, 2, 9")
    curves = ("cu", "select * from f_gcmeta union all select * replace (gcID + 1000 as gcID) from f_gcmeta where gcID % 10 = 3")
    units = ("un", "select id from f_spatial_unit union all select 4")
    cs = ("cs", """select c.cohortID, c.species, s.admin_name, s.eco_id from f_cohort c left join st s on c.pixelIndex = s.pixelIndex""")

    def repeated(name: str, table: str, by: str) -> str:
        return f"""union all select '{name}', cast(coalesce(sum(n - 1), 0) as bigint) from
  (select count(*) as n from {table} group by {by} having count(*) > 1) t"""
    return q(f"""
select 'cohorts_without_stand' as "check", count(*) as n from f_cohort c
  where not exists (select 1 from st s where s.pixelIndex = c.pixelIndex)
union all select 'stands_without_cohort', count(*) from st s
  where not exists (select 1 from f_cohort c where s.pixelIndex = c.pixelIndex)
union all select 'events_without_stand', count(*) from f_events e
  where not exists (select 1 from st s where s.pixelIndex = e.pixelIndex)
union all select 'events_without_meta', count(*) from f_events e
  where not exists (select 1 from me m where m.eventID = e.eventID)
union all select 'cohorts_without_curve', count(*) from cs
  where not exists (select 1 from cu g where {nse('cs', 'g', keys)})
union all select 'groups_without_unit', count(*) from gu
  where not exists (select 1 from un u where u.id = gu.spatial_unit_id)
{repeated('repeated_stands', 'st', 'pixelIndex')}
{repeated('repeated_event_meta', 'me', 'eventID')}
{repeated('repeated_curves', 'cu', 'admin_name, eco_id, species')}
{repeated('repeated_units', 'un', 'id')}""", stands, meta, curves, units, cs, GU)


def _save_options() -> str:
    parts = []
    for option, names in (("default", ("key", "pools", "flux")), ("save_all", ("key", "parameters", "state", "pools", "flux"))):
        for name in names:
            if name == "state":
                continue
            table = "(select distinct year, row_idx from f_key)" if name == "parameters" else f"f_{name}"
            parts.append(f"select '{option}' as option, '{name}' as name, year, count(*) as n from {table} t where year in (2, 5) group by year")
    return q(" union all ".join(parts))


def _warnings() -> str:
    inc = ("inc", """select c1.cohortID, c1.age, mx.max_age, i.gcID as hit from c1 left join f_gcmeta g on """
           + nse("c1", "g", ("admin_name", "eco_id", "species")) + """ left join mx on mx.gcID = g.gcID
      left join f_increments i on i.gcID = g.gcID and i.age = case when c1.age > mx.max_age then mx.max_age else c1.age end""")
    return q("""select 'events' as "check", count(*) as n from typed
      union all select 'unknown_events', count(*) from typed where disturbance_type_id is null
      union all select 'no_events', cast(count(*) = 0 as bigint) from typed
      union all select 'ages_beyond_curve', count(*) from inc where age > max_age
      union all select 'rows_without_curve', count(*) from inc where max_age is null
      union all select 'ages_without_increment', count(*) from inc where max_age is not null and hit is null
      union all select 'unknown_area', count(*) from f_key k join f_stand s on k.pixelIndex = s.pixelIndex where s.pixelIndex % 50 = 0
      """, TYPED, C1, MX, inc)


def oracle_sql() -> dict[str, str]:
    return {
        "spatial_units": q("select spatial_unit_id, admin_name, eco_id, mean_annual_temperature, return_interval "
                           "from spu", SPU),
        "read_snapshots": q("""select year, row_idx, Merch, Products from f_pools where year in (1, 3, 5, 7)
            union all select 0, row_idx, Merch, null from f_pools where year = 1"""),
        "write_snapshot": _save_options(),
        "append_year": q("select year, products_stock from stock", AREAS, STOCK),
        "year_filter": q("select * from f_events where year = 12"),
        "spinup_parameters": q("""select row_idx, cast(1 as int) as area, cast(age + 100 as int) as age, age as age_in,
            cast(3 as int) as delay, coalesce(historical_disturbance_type, 1) as historical_disturbance_type,
            cast(1 as int) as last_pass_disturbance_type from d1g""", C1, D1G),
        "default_sw_hw": q("select row_idx, cast(coalesce(sw_hw, 0) as int) as sw_hw from wood", WOOD),
        "softwood_flags_step": q("""select row_idx, sw_hw, cast(case when sw_hw is null then 0 else
            (select species_id from f_species where species_name =
             case when sw_hw = 0 then 'Unspecified softwood species' else 'Unspecified hardwood species' end) end as int) as species_id
            from wood""", WOOD),
        "fill_spatial_unit_parameters": q("""select s.row_idx, s.age, u.mean_annual_temperature, gu.spatial_unit_id from f_state s
            join gu on gu.row_idx = s.row_idx left join f_spatial_unit u on u.id = gu.spatial_unit_id""", GU),
        "clone_flux": q(f"""select n.year, n.row_idx, {', '.join('f.' + c for c in EMI + NPP)} from newg n
            left join f_flux f on f.year = n.year and f.row_idx = n.rep""", TYPED, WIN, MARKED, DIST, NEWG),
        "emissions_products_extra": q(f"""select year, pby.Products, gases.Emissions, gases.CO2, gases.CH4, gases.CO,
            totals.{EMI[3]}, totals.{NPP[0]} from gases join totals using (year) full outer join pby using (year)""",
                                      AREAS, TOTALS, GASES, STOCK, PBY),
        "prepare_groups_key": q("select * from pkey", TYPED, WIN, MARKED, SITES, PDIST, PNEW, PKEY),
        "prepare_groups_state": q("select * from pstate", TYPED, WIN, MARKED, SITES, PDIST, PNEW, PKEY, PSTATE),
        "prepare_groups_pools": q(_prepared("f_pools", "cast(1 as double), " + ", ".join("p." + c for c in POOLS if c != "Input")),
                                  TYPED, WIN, MARKED, SITES, PDIST, PNEW, PKEY),
        "prepare_groups_flux": q(_prepared("f_flux", ", ".join("p." + c for c in EMI + NPP)),
                                 TYPED, WIN, MARKED, SITES, PDIST, PNEW, PKEY),
        "prepare_groups_parameters": q("""select st.year, st.row_idx, coalesce(n.disturbance_type_id, 0) as disturbance_type, st.age,
            i.merch_inc, i.foliage_inc, i.other_inc from pstate st left join pnew n on n.year = st.year and n.row_idx = st.row_idx
            left join f_gcmeta g on """ + nse("st", "g", ("admin_name", "eco_id", "species")) + """
            left join mx on mx.gcID = g.gcID left join f_increments i on i.gcID = g.gcID
              and i.age = case when st.age > mx.max_age then mx.max_age else st.age end""",
                                       TYPED, WIN, MARKED, SITES, PDIST, PNEW, PKEY, PSTATE, MX),
        "fill_or_add": q("""select pixelIndex, admin_name, eco_id, area,
            coalesce(historical_disturbance_type, 1) as historical_disturbance_type,
            cast(1 as int) as last_pass_disturbance_type from f_stand"""),
        "softwood_flags": q("""select gcID, cast(case when sw then 0 when not sw then 1 end as int) as sw_hw,
            cast(case when sw then (select species_id from f_species where species_name = 'Unspecified softwood species')
                      when not sw then (select species_id from f_species
                                        where species_name = 'Unspecified hardwood species') end as int) as species_id
            from f_gcmeta"""),
        "regen_delay_gate": _gate(),
        "parameters_from_state": _b6(),
        "expand_increments": q("""select g.row_idx, i.age, i.merch_inc, i.foliage_inc, i.other_inc
            from d1g g left join f_gcmeta m on """ + nse("g", "m", ("admin_name", "eco_id", "species")) + """
            join f_increments i on i.gcID = m.gcID where i.age > 0""", C1, D1G),
        "cohorts_with_stands": q("select * from c1", C1),
        "attach_curves": q("select c1.cohortID, m.gcID, m.sw from c1 left join f_gcmeta m on "
                           + nse("c1", "m", ("admin_name", "eco_id", "species")), C1),
        "attach_spatial_unit": q("""select c1.cohortID, spu.spatial_unit_id, spu.mean_annual_temperature,
            spu.return_interval from c1 left join spu on """ + nse("c1", "spu", ("admin_name", "eco_id")), C1, SPU),
        "fill_spatial_unit": q("""select g.row_idx, spu.spatial_unit_id, spu.mean_annual_temperature
            from d1g g left join spu on """ + nse("g", "spu", ("admin_name", "eco_id")), C1, D1G, SPU),
        "type_events": q("select * from typed", TYPED),
        "contested_stands": q("select pixelIndex, year, count(*) as n_events from typed group by pixelIndex, year "
                              "having count(*) > 1", TYPED),
        "resolve_events": q("select * from winners", TYPED, WIN),
        "mark_cohorts": q("select year, cohortID, disturbance_type_id from marked", TYPED, WIN, MARKED),
        "cohort_groups": q("select cohortID, row_idx from d1k", C1, D1G, D1K),
        "group_census": q("""select year, count(*) as n_groups, max(row_idx) as max_row_idx, cast(sum(n) as bigint) as n_cohorts,
            max(n) as max_group_cohorts from (select year, row_idx, count(*) as n from f_key group by year, row_idx) t
            group by year"""),
        "disturbed_with_state": q("select year, cohortID, row_idx_prev, disturbance_type_id, age, delay, Merch "
                                  "from dist", TYPED, WIN, MARKED, DIST),
        "split_disturbed": q("select * from split", TYPED, WIN, MARKED, DIST, NEWG, SPLIT),
        "group_representative": q("select year, row_idx, rep as row_idx_prev, disturbance_type_id as disturbance_type "
                                  "from newg", TYPED, WIN, MARKED, DIST, NEWG),
        "clone_group_rows": q("""select n.year, n.row_idx, cast(1 as int) as age, s.delay, s.gcID,
            cast(null as double) as time_since_last_disturbance, cast(null as double) as time_since_land_use_change,
            cast(null as double) as last_disturbance_type from newg n left join f_state s on s.row_idx = n.rep""",
                              TYPED, WIN, MARKED, DIST, NEWG),
        "union_fill": q("select * from allpools", TYPED, WIN, MARKED, DIST, NEWG, NEWPOOLS, ALLPOOLS),
        "drop_inactive": q("""select * from allpools a where exists (select 1 from
            (select m.year, coalesce(s.row_idx, m.row_idx) as row_idx from marked m
             left join split s on s.year = m.year and s.cohortID = m.cohortID) k
            where k.year = a.year and k.row_idx = a.row_idx)""",
                           TYPED, WIN, MARKED, DIST, NEWG, SPLIT, NEWPOOLS, ALLPOOLS),
        "last_increment": q("select * from mx", MX),
        "annual_increments": q("""select c1.cohortID, m.gcID, c1.age, i.merch_inc, i.foliage_inc, i.other_inc
            from c1 join f_gcmeta m on """ + nse("c1", "m", ("admin_name", "eco_id", "species")) + """
            left join mx on mx.gcID = m.gcID
            left join f_increments i on i.gcID = m.gcID
              and i.age = case when c1.age > mx.max_age then mx.max_age else c1.age end""", C1, MX),
        "annual_increments_unit": q("""select c1.cohortID, spu.spatial_unit_id, m.gcID, c1.age, i.merch_inc, i.foliage_inc, i.other_inc
            from c1 join spu on """ + nse("c1", "spu", ("admin_name", "eco_id")) + " join f_gcmeta m on "
                                    + nse("spu", "m", ("admin_name", "eco_id")) + """ and c1.species is not distinct from m.species
            left join mx on mx.gcID = m.gcID
            left join f_increments i on i.gcID = m.gcID
              and i.age = case when c1.age > mx.max_age then mx.max_age else c1.age end""", C1, SPU, MX),
        "extend_curves": q("""select gcID, age, merch_inc, foliage_inc, other_inc from f_increments
            union all select gcID, cast(unnest(generate_series(max_age + 1, (select max(age) from f_cohort) + 250))
              as int) as age, merch_inc, foliage_inc, other_inc
            from mx where max_age < (select max(age) from f_cohort)""", MX),
        "cohorts_with_area": q("""select k.year, k.cohortID, k.pixelIndex, k.row_idx, s.area
            from f_key k join f_stand s on k.pixelIndex = s.pixelIndex"""),
        "group_area": q(f"""select k.year, k.row_idx, {strict('s.area')} as area_m2, {strict('s.area')} / 10000 as area_ha
            from f_key k join (select pixelIndex, case when pixelIndex % 50 <> 0 then area end as area from f_stand) s
              on k.pixelIndex = s.pixelIndex group by k.year, k.row_idx"""),
        "flux_totals": q("select * from totals", AREAS, TOTALS),
        "emission_gases": q("select * from gases", AREAS, TOTALS, GASES),
        "products_stock": q("select * from stock", AREAS, STOCK),
        "products_by_year": q("select * from pby", AREAS, STOCK, PBY),
        "emissions_products": q("""select year, pby.Products, gases.Emissions, gases.CO2, gases.CH4, gases.CO
            from gases full outer join pby using (year)""", AREAS, TOTALS, GASES, STOCK, PBY),
        "cohort_flux": q("""select k.year, k.cohortID, k.row_idx, """ + ", ".join(f"f.{c}" for c in EMI + NPP) + """
            from f_key k join f_flux f on f.year = k.year and f.row_idx = k.row_idx"""),
        "npp_by_year": q(f"""select k.year, {strict(NPP_SUM)} as NPP from f_key k
            join f_flux f on f.year = k.year and f.row_idx = k.row_idx group by k.year"""),
        "npp_by_year_area": q(f"""select f.year, {strict('(' + NPP_SUM + ') * ga.area_m2')} / 10000 as NPP
            from f_flux f join ga on f.year = ga.year and f.row_idx = ga.row_idx group by f.year""", AREAS),
        "npp_by_stand": q(f"""select k.year, k.pixelIndex, {strict(NPP_SUM)} as NPP from f_key k
            join f_flux f on f.year = k.year and f.row_idx = k.row_idx group by k.year, k.pixelIndex"""),
        "pool_proportions": q(f"""select year, pool_class, carbon,
            round(carbon / nullif(sum(carbon) over (partition by year), 0), {DIGITS}) as share from (
              select lp.year, coalesce(c.pool_class, 'unmapped') as pool_class, {strict('lp.value * ga.area_m2')} / 10000 as carbon
              from lp left join f_pool_class c on c.pool = lp.pool
              join ga on ga.year = lp.year and ga.row_idx = lp.row_idx
              where lp.pool not in ('Input', 'Products')
              group by lp.year, coalesce(c.pool_class, 'unmapped')) t""", AREAS, LP),
        "total_carbon_by_stand": q(f"""select k.year, k.pixelIndex, {strict('p.Merch + p.Foliage + p.StemSnags')}
            as total_carbon from f_key k join f_pools p on p.year = k.year and p.row_idx = k.row_idx
            group by k.year, k.pixelIndex"""),
        "age_panel": q(_age_panel()[0], *_age_panel()[1]),
        "age_panel_all": q(_age_panel("winners")[0], *_age_panel("winners")[1]),
        "interval_growth": _interval_growth(),
        "winners_by_batch": q("select * from winners", TYPED, WIN),
        "orphans": _orphans(),
        "ingest_events": q("select pixelIndex, year, eventID from f_events"),
        "temp_modifier": q(f"select year, row_idx, pool, round(temp_mod, {DIGITS}) as temp_mod from tm", LP, GU, TM),
        "stand_modifier": q(f"select year, row_idx, round(stand_mod, {DIGITS}) as stand_mod from sm", GU, SM),
        "decay_rates": q(f"""select tm.year, tm.row_idx, tm.pool, round(tm.base_rate * tm.temp_mod * sm.stand_mod,
            {DIGITS}) as decay_rate from tm join sm on sm.year = tm.year and sm.row_idx = tm.row_idx""", LP, GU, TM, SM),
        "root_split": _root_split(),
        "apply_transfers": _transfers(),
        "transfer_flux": q(f"""select lpt.year, lpt.row_idx, coalesce(fm.flux, 'unmapped') as flux, {strict('lpt.value * m.proportion')} as value
            from lpt join f_matrix m on m.disturbance_type_id = lpt.disturbance_type_id and m.source = lpt.pool
            left join f_flux_map fm on fm.source = m.source and fm.sink = m.sink
            where m.source <> m.sink group by lpt.year, lpt.row_idx, coalesce(fm.flux, 'unmapped')""", LP, LPT),
        "half_growth": _half_growth(),
        "overmature_decline": _decline(),
        "slow_mixing": _slow(),
        "apply_transfers_wide": _wide_transfers(),
        "transfer_flux_wide": _wide_flux(),
        "composed_matrix": _product(),
        "composed_transfers": _in_turn(["f_matrix", "f_yearly_turnover", "f_yearly_mixing"], Fixtures.POOL_NAMES),
        "overmature_decline_wide": _decline_wide(),
        "slow_mixing_wide": q("""select year, row_idx, Input, Merch, Foliage, StemSnags * (cast(1 as double) - cast(0.006 as double)) as StemSnags,
            Products, cast(0 as double) + StemSnags * cast(0.006 as double) as MediumSoil from f_pools"""),
        "group_area_shared": q("""select year, row_idx, round(sum(part), 3) as area_m2, round(sum(part) / 10000, 7) as area_ha from (
            select k.year, k.row_idx, s.area / count(*) over (partition by k.year, k.pixelIndex) as part
            from f_key k join f_stand s on k.pixelIndex = s.pixelIndex) t group by year, row_idx"""),
        "products_by_year_initial": q("select year, Products from pby where year > 1", AREAS, STOCK, PBY),
        "clustered_cohorts_with_stands": q("select * from c1", C1),
        "clustered_mark_cohorts": q("select year, cohortID, disturbance_type_id from marked", TYPED, WIN, MARKED),
        "clustered_cohorts_with_area": q("""select k.year, k.cohortID, k.pixelIndex, k.row_idx, s.area
            from f_key k join f_stand s on k.pixelIndex = s.pixelIndex"""),
        "cohort_groups_hot": q("select cohortID, row_idx from d1k", ("c1", "select * from f_hot_cohort_stands"), D1G, D1K),
        "cohort_flux_hot": q("""select k.year, k.cohortID, k.row_idx, """ + ", ".join(f"f.{c}" for c in EMI + NPP) + """
            from f_hot_key k join f_hot_flux f on f.year = k.year and f.row_idx = k.row_idx"""),
        "npp_by_stand_hot": q(f"""select k.year, k.pixelIndex, {strict(NPP_SUM)} as NPP from f_hot_key k
            join f_hot_flux f on f.year = k.year and f.row_idx = k.row_idx group by k.year, k.pixelIndex"""),
        "total_carbon_by_stand_hot": q(f"""select k.year, k.pixelIndex, {strict('p.Merch + p.Foliage + p.StemSnags')}
            as total_carbon from f_hot_key k join f_hot_pools p on p.year = k.year and p.row_idx = k.row_idx
            group by k.year, k.pixelIndex"""),
        "run_warnings": _warnings(),
        "read_delimited": q("""select cohortID, pixelIndex, case when cohortID % 89 <> 0 then species end as species,
            case when cohortID % 97 <> 0 then age end as age,
            nullif(concat_ws('; ', case when cohortID % 97 = 0 then 'age is no int: old' end,
              case when cohortID % 89 = 0 then 'species is empty' end), '') as rejected from f_cohort"""),
    }


def _root_split() -> str:
    agb = "((p.Merch + p.Foliage + cast(0.0 as double)) * cast(2.0 as double))"
    t = ("rt", f"""select p.year, p.row_idx, r.frp_a, r.frp_b, r.frp_c,
      case when w.sw_hw = 1 then r.hw_a * pow({agb}, r.hw_b) when w.sw_hw = 0 then r.sw_a * {agb} end as total
      from f_pools p left join wood w on w.row_idx = p.row_idx left join f_roots r on r.sw_hw = w.sw_hw""")
    pf = "(frp_a + frp_b * exp((cast(-1.0 as double) / frp_c) * total))"
    return q(f"""select year, row_idx, round(total, {DIGITS}) as total_root, round(total * {pf}, {DIGITS}) as fine_roots,
        round(total * (cast(1.0 as double) - {pf}), {DIGITS}) as coarse_roots from rt""", WOOD, t)
