"""DuckDB SQL oracle for every entry of the query catalogue.

The adapters of ``epistand.sources.testdata`` are repeated here as CTEs over the driver's
tables, and each query is written from the method's description in plain SQL (GROUP BY,
GROUPING SETS, FULL JOIN ... IS NOT DISTINCT FROM, LAG() OVER, UNION ALL BY NAME), so that it
checks the Spark plan independently. Doubles are rounded to 4 decimals as on the Spark side.
"""

from __future__ import annotations

from epistand.params import (ALLERGY_FLAGS, ALLERGY_LABELS, ALLERGY_SELECTION, ALLERGY_TOTAL_FLAGS,
                             ASTHMA_DEATH_CODES, ASTHMA_STAY_CODES, COPD_BANDS, COPD_DEATH_CODES,
                             COPD_DEPRIVATION_BANDS, COPD_STAY_CODES, DIABETES_BANDS, DIABETES_CODES,
                             DIABETES_KETO_CODES, EPILEPSY_BANDS, EPILEPSY_CODES, EPOP_WEIGHTS, MS_CODES,
                             SCOTLAND_CODE, CodeSet)
from epistand.plans import diabetes, epilepsy, ms, topic_masks
from epistand.plans.catalogue import FIRST_BATCH_YEAR, T_ALLERGY, T_ASTHMA, T_COPD, T_DIABETES, T_EPILEPSY, T_MS
from epistand.sources.testdata import (CODE_STEMS, DASH_CODES, FOURTH_CHARS, HISTORIC_BEFORE,
                                       POPULATION_CODES)

OTHER = [f"other_condition_{i}" for i in range(1, 6)]
DEATH_CODE_COLS = [f"cause_of_death_code_{i}" for i in range(10)]


# --- expression helpers ---------------------------------------------------------------------

def q(s) -> str:
    return "'" + str(s).replace("'", "''") + "'"


def lst(items) -> str:
    return "[" + ", ".join(q(s) for s in items) + "]"


def lit(v) -> str:
    return q(v) if isinstance(v, str) else str(v)


def dt(d) -> str:
    return f"DATE '{d.isoformat()}'"


def fy(d: str) -> str:
    return f"cast(year({d}) - case when month({d}) > 3 then 0 else 1 end as integer)"


def band(a: str) -> str:
    return f"cast(case when {a} between 0 and 200 then least(floor({a} / 5) + 1, 19) end as integer)"


def epop(g: str) -> str:
    return "(case " + " ".join(f"when {g} = {i + 1} then cast({w} as double)" for i, w in enumerate(EPOP_WEIGHTS)) + " end)"


def cband_age(a: str, bands) -> str:
    parts = []
    for b in bands:
        conds = []
        if b.min_age is not None:
            conds.append(f"{a} >= {b.min_age}")
        if b.max_age is not None:
            conds.append(f"{a} <= {b.max_age}")
        parts.append(f"when {' and '.join(conds)} then {lit(b.label)}")
    return "(case " + " ".join(parts) + " end)"


def cband_grp(g: str, bands) -> str:
    return "(case " + " ".join(f"when {g} between {b.first_grp} and {b.last_grp} then {lit(b.label)}" for b in bands) + " end)"


def band_total(c: str, bands) -> str:
    return "(case " + " ".join(f"when {c} = {lit(b.label)} then cast({b.epop_total} as double)" for b in bands) + " end)"


def match(c: str, cs: CodeSet) -> str:
    parts = []
    if cs.prefix3:
        parts.append(f"substr({c}, 1, 3) in ({', '.join(q(x) for x in cs.prefix3)})")
    if cs.prefix4:
        parts.append(f"substr({c}, 1, 4) in ({', '.join(q(x) for x in cs.prefix4)})")
    if cs.regex:
        parts.append(f"regexp_matches({c}, {q(cs.regex)})")
    return "(" + " or ".join(parts) + ")"


def flag(c: str, cs: CodeSet) -> str:
    return f"(case when {match(c, cs)} then 1 else 0 end)"


def anypos(cols) -> str:
    return f"concat_ws('', {', '.join(cols)})"


def sex_label(c: str, keep: bool = True) -> str:
    return f"(case when {c} = '1' then 'Male' when {c} = '2' then 'Female' {'else ' + c if keep else ''} end)"


def year_label(y: str, kind: str = "financial") -> str:
    if kind == "calendar":
        return f"cast({y} as varchar)"
    return f"(cast({y} as varchar) || '/' || substr(cast({y} + 1 as varchar), 3, 2))"


def labels(mapping: dict, cols) -> str:
    parts = []
    for key, label in mapping.items():
        key = key if isinstance(key, tuple) else (key,)
        cond = " and ".join(f"cast({c} as varchar) = {q(v)}" for c, v in zip(cols, key))
        parts.append(f"when {cond} then {q(label)}")
    return "(case " + " ".join(parts) + " end)"


def r4(c: str) -> str:
    return f"round({c}, 4)"


def ident(name: str) -> str:
    """A quoted SQL identifier (for column names such as ``<4_weeks`` or ``1-4``)."""
    return '"' + name.replace('"', '""') + '"'


# --- adapters -------------------------------------------------------------------------------

def _pick(items, idx):
    return f"{lst(items)}[({idx}) % {len(items)} + 1]"


def _char(idx):
    return f"substr({q(FOURTH_CHARS)}, cast(({idx}) % {len(FOURTH_CHARS)} as integer) + 1, 1)"


AGE_COLS = [f"age{a}" for a in range(65, 90)] + ["age90plus"]

ADAPTERS = {
    "episodes_all": f"""
select cast(o_custkey as varchar) link_no, cast(o_orderkey as varchar) cis_marker,
  cast((o_custkey * 7 + year(o_orderdate)) % 100 as integer) age_in_years,
  case when o_orderkey % 97 = 0 then '0' else cast(o_custkey % 2 + 1 as varchar) end sex,
  case when o_orderkey % 89 = 0 then null else cast(o_custkey as varchar) end dr_postcode,
  cast(o_orderdate as date) + l_linenumber admission_date,
  cast(o_orderdate as date) + l_linenumber + cast(trunc(l_quantity) as integer) discharge_date,
  case when o_orderkey % 10 = 0 then null when o_orderkey % 10 = 1 then 'S08200001' else 'S08000015' end hbtreat_currentdate,
  case when l_partkey % 17 = 0 then {_pick(DASH_CODES, 'l_suppkey')}
       else {_pick(CODE_STEMS, 'l_partkey + 3 * l_suppkey')} || {_char('l_suppkey')} end main_condition,
  case when l_partkey % 3 = 0 then 'E1' || cast(l_suppkey % 6 as varchar) || cast(l_partkey % 10 as varchar) end other_condition_1,
  case when l_suppkey % 4 = 0 then {_pick(CODE_STEMS, 'l_suppkey * 5 + l_linenumber')} || '9' end other_condition_2,
  case when l_partkey % 7 = 1 then 'E1' || cast(l_orderkey % 5 as varchar) || '9' end other_condition_3,
  cast(null as varchar) other_condition_4, cast(null as varchar) other_condition_5,
  o_orderdate _orderdate
from lineitem join orders on l_orderkey = o_orderkey""",
    "episodes": f"select * exclude (_orderdate) from episodes_all where _orderdate >= TIMESTAMP '{HISTORIC_BEFORE} 00:00:00'",
    "episodes_historic": f"select * exclude (_orderdate) from episodes_all where _orderdate < TIMESTAMP '{HISTORIC_BEFORE} 00:00:00'",
    "episodes_any": "select * exclude (_orderdate) from episodes_all",
    "deaths": f"""
select cast(o_custkey as varchar) link_no,
  cast(year(cast(o_orderdate as date) + 30) as integer) year_of_registration,
  cast(o_orderdate as date) + 30 date_of_registration,
  cast((o_custkey * 7 + year(o_orderdate)) % 100 as integer) age,
  case when o_orderkey % 50 = 0 then '9' else cast(o_custkey % 2 + 1 as varchar) end sex,
  case when o_orderkey % 11 = 0 then 'ZZ' else 'XS' end country_of_residence,
  case when o_orderkey % 19 = 0 then {_pick(DASH_CODES, 'o_orderkey')}
       else {_pick(CODE_STEMS, 'o_orderkey * 5 + o_custkey')} || {_char('o_orderkey')} end underlying_cause_of_death,
  case when o_orderkey % 3 = 0 then 'E1' || cast(o_custkey % 6 as varchar) || '9' end cause_of_death_code_0,
  case when o_orderkey % 4 = 1 then 'I219' end cause_of_death_code_1,
  {', '.join(f'cast(null as varchar) cause_of_death_code_{i}' for i in range(2, 10))}
from orders where o_orderstatus = 'F'""",
    "people": "select distinct o_custkey ck, cast(year(o_orderdate) as integer) AS year from orders",
    "population": """
select year, cast((ck * 7 + year) % 100 as integer) age, cast(ck % 2 + 1 as varchar) sex, count(*) pop
from people group by 1, 2, 3""",
    "postcode_lookup": """
select cast(c_custkey as varchar) pc7, case when c_nationkey % 6 <> 0 then n_name end datazone2011
from customer join nation on c_nationkey = n_nationkey""",
    "area_people": """
select c_nationkey, year, case when ck % 2 = 0 then 'M' else 'F' end sex, count(*) base
from people join customer on ck = c_custkey group by 1, 2, 3""",
    "deprivation_lookup": """
select distinct n_name datazone, year, cast(n_regionkey + 1 as integer) sc_quin
from nation join area_people on n_nationkey = c_nationkey""",
    "population_dz": f"""
select b.year, n_name datazone2011, b.sex,
  {', '.join(f'cast(b.base * 3 + (b.year + {a} * 7 + n_nationkey) % 40 as bigint) age{a}' for a in range(65, 90))},
  cast(b.base + 11 + b.year % 7 as bigint) age90plus
from area_people b join nation on c_nationkey = n_nationkey""",
    "population_ca": f"""
select code, year, sex sex_grp, age_grp,
  cast(sum(case when code = {q(POPULATION_CODES[0])} then pop else floor(pop / 3) end) as bigint) denominator
from (select p.*, c.code, {band('p.age')} age_grp from population p
      cross join (select unnest({lst(POPULATION_CODES)}) code) c)
group by code, year, sex, age_grp""",
}
DEPS = {"episodes": ["episodes_all"], "episodes_historic": ["episodes_all"], "episodes_any": ["episodes_all"],
        "population": ["people"], "population_ca": ["people", "population"],
        "deprivation_lookup": ["people", "area_people"], "population_dz": ["people", "area_people"]}


def build(needs, ctes, body: str) -> str:
    order = []
    for n in needs:
        for dep in DEPS.get(n, []) + [n]:
            if dep not in order:
                order.append(dep)
    parts = [f"{n} AS ({ADAPTERS[n]})" for n in order] + [f"{n} AS ({sql})" for n, sql in ctes]
    return "WITH " + ",\n".join(parts) + "\n" + body


# --- shared fragments -----------------------------------------------------------------------

def between(c, w) -> str:
    return f"{c} between {dt(w[0])} and {dt(w[1])}"


def pop_cells(first=None, last=None) -> str:
    conds = []
    if first is not None:
        conds.append(f"year >= {first}")
    if last is not None:
        conds.append(f"year <= {last}")
    where = ("where " + " and ".join(conds)) if conds else ""
    return (f"select {band('age')} age_grp, cast(sex as varchar) sex, year, cast(sum(pop) as bigint) pop "
            f"from population {where} group by 1, 2, 3")


def with_den(counts: str, pop: str, keys, left_cols, how: str = "full") -> str:
    kx = ", ".join(f"coalesce(c.{k}, p.{k}) AS {k}" if how == "full" else f"c.{k}" for k in keys)
    on = " and ".join(f"c.{k} is not distinct from p.{k}" for k in keys)
    grp = "coalesce(c.age_grp, p.age_grp)" if how == "full" else "c.age_grp"
    extra = "".join(f", c.{x}" for x in left_cols)
    return (f"select {kx}{extra}, coalesce(c.n, 0) numerator, p.pop denominator, {epop(grp)} epop "
            f"from {counts} c {'full' if how == 'full' else 'left'} join {pop} p on {on}")


def rates(cells: str, total, by_sex: bool = True, cats=(), where: str | None = None) -> str:
    keys = list(dict.fromkeys(list(cats) + ["year"] + (["sex"] if by_sex else [])))
    tot = total if isinstance(total, str) else f"cast({total} as double)"
    w = f"where {where}" if where else ""
    return (f"select {', '.join(keys)}, cast(coalesce(sum(numerator), 0) as bigint) numerator, "
            f"coalesce(sum(cast(numerator as double) * epop / nullif(cast(denominator as double), 0)), 0) / {tot} * 100000 rate "
            f"from {cells} {w} group by {', '.join(keys)}")


def collapse(cells: str) -> str:
    return ("select year, age_grp2 age_grp, sex, cast(coalesce(sum(numerator), 0) as bigint) numerator, "
            "cast(coalesce(sum(denominator), 0) as bigint) denominator, coalesce(sum(epop), 0) epop "
            f"from {cells} group by year, age_grp2, sex")


def chart(rates_sql: str, by_sex: bool = True, kind: str = "financial") -> str:
    if by_sex:
        return f"select {year_label('year', kind)} AS year, {sex_label('sex')} sex, rate from ({rates_sql})"
    return f"select {year_label('year', kind)} AS year, rate, 'All' sex from ({rates_sql})"


def rollup_sql(table: str, where: str, rank=None) -> str:
    sr = f", {rank} source_rank" if rank is not None else ""
    return (f"select link_no linkno, cis_marker cis, max(age_in_years) age, min(admission_date) doadm, "
            f"max(discharge_date) dodis, max(sex) sex, min(dr_postcode) pc7, max({fy('admission_date')}) AS year{sr} "
            f"from {table} where {where} group by link_no, cis_marker")


def stay_filter(window, codes, board: bool = False) -> str:
    parts = [between("admission_date", window)]
    if board:
        parts.append("hbtreat_currentdate is not null and substr(hbtreat_currentdate, 1, 4) <> 'S082'")
    parts += ["sex in ('1', '2')", match("main_condition", codes)]
    return " and ".join(parts)


def stacked(name: str, window, codes, board: bool = False):
    w = stay_filter(window, codes, board)
    return (name, f"{rollup_sql('episodes', w, 1)} union all {rollup_sql('episodes_historic', w, 2)}")


RESIDENT = "(select pc7 from postcode_lookup where datazone2011 is not null)"


def death_events_sql(deaths: str) -> str:
    return (f"select link_no linkno, year_of_registration cal_year, underlying_cause_of_death cod, age, sex, "
            f"date_of_registration doadm, date_of_registration dodis, country_of_residence, "
            f"{fy('date_of_registration')} AS year, 0 source_rank from {deaths}")


def events_ctes(prefix: str, deaths_where: str, window, codes, board: bool):
    return [
        stacked(f"{prefix}_stays", window, codes, board),
        (f"{prefix}_deaths", f"select * from deaths where {deaths_where}"),
        (f"{prefix}_events", f"{death_events_sql(prefix + '_deaths')} union all by name "
                             f"select linkno, cis, age, doadm, dodis, sex, year, source_rank from {prefix}_stays "
                             f"where pc7 in {RESIDENT}"),
    ]


def lookback(events: str, gap_from: str, years: float) -> str:
    gap = (f"cast(datediff('day', lag({gap_from}) over (partition by linkno order by doadm asc nulls last, "
           f"source_rank asc, cis asc nulls first), doadm) as double) / cast(365 as double)")
    return f"select * from (select *, {gap} _gap from {events}) where _gap is null or _gap >= {float(years)}"


def incidence_ctes(prefix, deaths_where, window, codes, board, bands, lb, after, pop_sql, how):
    return events_ctes(prefix, deaths_where, window, codes, board) + [
        (f"{prefix}_banded", f"select *, {band('age')} age_grp, {cband_age('age', bands)} age_grp2 from {prefix}_events"),
        (f"{prefix}_incident", lookback(f"{prefix}_banded", lb.gap_from, lb.min_gap_years)),
        (f"{prefix}_counts", f"select age_grp, age_grp2, sex, year, count(*) n from {prefix}_incident "
                             f"where year > {after} group by age_grp, age_grp2, sex, year"),
        (f"{prefix}_pop", pop_sql),
        (f"{prefix}_cells", with_den(f"{prefix}_counts", f"{prefix}_pop", ["year", "age_grp", "sex"], ["age_grp2"], how)),
    ]


def band_charts(cells: str, bands, name_of=None) -> list:
    """Per coarse band: collapse, keep the band, standardise with its total, label."""
    out = []
    for b in bands:
        r = rates(f"({collapse(cells)})", b.epop_total, where=f"age_grp = {lit(b.label)}")
        out.append((b, chart(r)))
    return out


# --- topic fragments ------------------------------------------------------------------------

P = T_ASTHMA
ASTHMA_CTES = [
    ("a_first", f"select link_no linkno, {fy('admission_date')} AS year, min(age_in_years) age, min(sex) sex, "
                f"min(dr_postcode) pc7 from episodes where {between('admission_date', P.stay_window)} "
                f"and sex in ('1', '2') and {match('main_condition', ASTHMA_STAY_CODES)} "
                f"group by link_no, {fy('admission_date')}"),
    ("a_res", f"select linkno, year, age, sex, {band('age')} age_grp, {cband_age('age', P.bands)} age_grp2 "
              f"from a_first where pc7 in {RESIDENT}"),
    ("a_counts", "select age_grp, age_grp2, sex, year, count(*) n from a_res group by age_grp, age_grp2, sex, year"),
    ("a_pop", pop_cells(*P.population_years)),
    ("a_cells", with_den("a_counts", "a_pop", ["year", "age_grp", "sex"], ["age_grp2"])),
]
ASTHMA_NEEDS = ["episodes", "postcode_lookup", "population"]

D = T_DIABETES
_DIAB_ANY = match(anypos(["main_condition", *OTHER]), DIABETES_CODES)
DIAB_POP = ("d_pop", f"""select year, sex, age_grp, age_grp2, cast(coalesce(sum(denominator), 0) as bigint) denominator,
  coalesce(sum(epop), 0) epop from (select year, cast(sex_grp as varchar) sex, age_grp,
  {cband_grp('age_grp', D.bands)} age_grp2, denominator, {epop('age_grp')} epop
  from population_ca where code = {q(D.population_code)}) group by year, sex, age_grp, age_grp2""")
DIAB_ADM_CTES = [
    ("d_stays", f"""select link_no, cis_marker, max(age_in_years) age, max(sex) sex, max({fy('discharge_date')}) AS year,
  max({flag('main_condition', DIABETES_CODES)}) diab_main, max({flag('main_condition', DIABETES_KETO_CODES)}) diab_keto,
  max(case when {_DIAB_ANY} then 1 else 0 end) diabetes
  from episodes where {between('discharge_date', D.discharge_window)} and hbtreat_currentdate is not null
  and sex in ('1', '2') and {_DIAB_ANY} group by link_no, cis_marker"""),
    ("d_by_age", "select year, age, sex, cast(sum(diab_main) as bigint) diab_main, cast(sum(diab_keto) as bigint) diab_keto, "
                 "cast(sum(diabetes) as bigint) diabetes from d_stays group by year, age, sex"),
    ("d_cells", f"""select year, sex, age_grp, age_grp2, {', '.join(f'cast(coalesce(sum({t}), 0) as bigint) {t}' for t in diabetes.ADMISSION_TYPES)}
  from (select *, {band('age')} age_grp, {cband_grp(band('age'), D.bands)} age_grp2 from d_by_age)
  group by year, sex, age_grp, age_grp2"""),
    ("d_long", " union all ".join(f"select year, sex, age_grp, age_grp2, '{t}' type, {t} numerator from d_cells"
                                  for t in diabetes.ADMISSION_TYPES)),
    DIAB_POP,
    ("d_adm", "select l.year, l.sex, l.age_grp, l.age_grp2, l.type, l.numerator, p.denominator, "
              f"{epop('l.age_grp')} epop from d_long l left join d_pop p on "
              + " and ".join(f"l.{k} is not distinct from p.{k}" for k in ("year", "sex", "age_grp", "age_grp2"))),
    ("d_pooled", "select year, age_grp, age_grp2, type, cast(coalesce(sum(numerator), 0) as bigint) numerator, "
                 "cast(coalesce(sum(denominator), 0) as bigint) denominator, coalesce(sum(epop), 0) epop, 'All' sex "
                 "from d_adm group by year, age_grp, age_grp2, type"),
]
DIAB_NEEDS = ["episodes", "population", "population_ca"]
_DIAB_DEATH_ANY = match(anypos(["underlying_cause_of_death", *DEATH_CODE_COLS]), DIABETES_CODES)
DIAB_DEATH_CTES = [
    ("dd_by_age", f"""select year_of_registration AS year, sex, age, count(*) all_diag,
  count(*) filter (where {match('underlying_cause_of_death', DIABETES_CODES)}) main_diag
  from deaths where year_of_registration between {D.death_years[0]} and {D.death_years[1]}
  and country_of_residence = 'XS' and sex <> '9' and {_DIAB_DEATH_ANY} group by 1, 2, 3"""),
    ("dd_cells", f"""select year, sex, age_grp, cast(coalesce(sum(all_diag), 0) as bigint) all_diag,
  cast(coalesce(sum(main_diag), 0) as bigint) main_diag from (select *, {band('age')} age_grp from dd_by_age)
  group by year, sex, age_grp"""),
    ("dd_long", " union all ".join(f"select year, sex, age_grp, '{t}' type, {t} numerator from dd_cells"
                                   for t in ("all_diag", "main_diag"))),
    DIAB_POP,
    ("dd_joined", "select l.year, l.sex, l.age_grp, l.type, l.numerator, p.age_grp2, p.denominator, p.epop "
                  "from dd_long l left join d_pop p on "
                  + " and ".join(f"l.{k} is not distinct from p.{k}" for k in ("year", "sex", "age_grp"))),
    ("dd_pooled", "select year, age_grp, age_grp2, type, cast(coalesce(sum(numerator), 0) as bigint) numerator, "
                  "cast(coalesce(sum(denominator), 0) as bigint) denominator, coalesce(sum(epop), 0) epop, 'All' sex "
                  "from dd_joined group by year, age_grp, age_grp2, type"),
]
DIAB_DEATH_NEEDS = ["deaths", "population", "population_ca"]

C = T_COPD
COPD_DEATHS_WHERE = (f"{between('date_of_registration', C.death_window)} and sex <> '9' and "
                     f"{match('underlying_cause_of_death', COPD_DEATH_CODES)} and country_of_residence = 'XS'")
COPD_CTES = incidence_ctes("c", COPD_DEATHS_WHERE, C.stay_window, COPD_STAY_CODES, False, C.bands, C.lookback,
                           C.output_after_year, pop_cells(C.population_after_year + 1), "left")
COPD_NEEDS = ["episodes", "episodes_historic", "deaths", "postcode_lookup", "population"]

E = T_EPILEPSY
EPI_DEATHS_WHERE = (f"{between('date_of_registration', E.death_window)} and sex <> '9' and "
                    f"{match('underlying_cause_of_death', EPILEPSY_CODES)}")
EPI_CTES = incidence_ctes("e", EPI_DEATHS_WHERE + " and country_of_residence = 'XS'", E.stay_window, EPILEPSY_CODES,
                          True, E.bands, E.lookback, E.output_after_year, pop_cells(*E.population_years), "full")

M = T_MS
MS_DEATHS_WHERE = (f"{between('date_of_registration', M.death_window)} and sex <> '9' and "
                   f"{match('underlying_cause_of_death', MS_CODES)}")
MS_CTES = incidence_ctes("m", MS_DEATHS_WHERE + " and country_of_residence = 'XS'", M.stay_window, MS_CODES, False,
                         M.bands, M.lookback, M.output_after_year, pop_cells(*M.population_years), "full")

_PY = C.population_year
DEP_CTES = [
    stacked("c_stays", C.stay_window, COPD_STAY_CODES),
    ("dp_adm", f"select {_PY} AS year, {band('age')} age_grp, sex, pc7 from c_stays where age > 64 and year = {C.event_year}"),
    ("dp_counts", "select a.year, a.sex, a.age_grp, l.datazone2011, count(*) n from dp_adm a join "
                  "(select pc7, datazone2011 from postcode_lookup where datazone2011 is not null) l on a.pc7 = l.pc7 "
                  "group by a.year, a.sex, a.age_grp, l.datazone2011"),
    ("dp_long", f"unpivot (select year, datazone2011, sex, {', '.join(AGE_COLS)} from population_dz where year = {_PY}) "
                f"on {', '.join(AGE_COLS)} into name age value pop"),
    ("dp_pop", f"""select year, datazone2011, {band('age_n')} age_grp,
  case when sex = 'M' then '1' when sex = 'F' then '2' end sex, cast(coalesce(sum(pop), 0) as bigint) pop
  from (select *, cast(regexp_extract(age, '(\\d+)', 1) as integer) age_n from dp_long) group by 1, 2, 3, 4"""),
    ("dp_pq", f"""select p.year, d.sc_quin, p.datazone2011, p.sex, p.age_grp, cast(coalesce(sum(p.pop), 0) as bigint) pop
  from dp_pop p left join (select datazone datazone2011, year, sc_quin from deprivation_lookup where year = {_PY}) d
  on p.datazone2011 = d.datazone2011 and p.year = d.year group by 1, 2, 3, 4, 5"""),
    ("dp_cells", f"""select p.year, p.sex, p.age_grp, p.sc_quin, cast(coalesce(sum(c.n), 0) as bigint) numerator,
  cast(coalesce(sum(p.pop), 0) as bigint) denominator, {epop('p.age_grp')} epop,
  {cband_grp('p.age_grp', COPD_DEPRIVATION_BANDS)} age_grp2
  from dp_pq p left join dp_counts c on p.year = c.year and p.datazone2011 = c.datazone2011
  and p.sex = c.sex and p.age_grp = c.age_grp group by p.year, p.sex, p.age_grp, p.sc_quin"""),
    ("dp_rates", rates("dp_cells", band_total("age_grp2", COPD_DEPRIVATION_BANDS), cats=["age_grp2", "sc_quin"],
                       where=f"age_grp2 in ({', '.join(q(b.label) for b in COPD_DEPRIVATION_BANDS)})")),
    ("dp_chart", f"select *, concat_ws(' ', {sex_label('sex')}, age_grp2) age_sex, {year_label('year')} year_label from dp_rates"),
]
DEP_NEEDS = ["episodes", "episodes_historic", "postcode_lookup", "deprivation_lookup", "population_dz"]

A = T_ALLERGY
_FLAGS = [n for n, _ in ALLERGY_FLAGS]
ALLERGY_STAYS = ("al_stays", f"""select link_no linkno, cis_marker cis, max(age_in_years) age, max(sex) sex,
  max({fy('discharge_date')}) AS year, {', '.join(f'max({flag("main_condition", cs)}) {n}' for n, cs in ALLERGY_FLAGS)}
  from episodes where {between('discharge_date', A.discharge_window)} and hbtreat_currentdate is not null
  and substr(hbtreat_currentdate, 1, 4) <> 'S082' and sex in ('1', '2') and {match('main_condition', ALLERGY_SELECTION)}
  group by link_no, cis_marker""")
ALLERGY_CTES = [
    ALLERGY_STAYS,
    ("al_counts", f"""select *, {' + '.join(ALLERGY_TOTAL_FLAGS)} total from (select age_grp, sex, year,
  {', '.join(f'cast(coalesce(sum({n}), 0) as bigint) {n}' for n in _FLAGS)}
  from (select *, {band('age')} age_grp from al_stays) group by age_grp, sex, year)"""),
    ("al_pop", pop_cells(*A.population_years)),
    ("al_join", f"""select coalesce(c.year, p.year) AS year, coalesce(c.age_grp, p.age_grp) age_grp,
  coalesce(c.sex, p.sex) sex, {', '.join(f'c.{n}' for n in _FLAGS + ['total'])}, p.pop denominator
  from al_counts c full join al_pop p on c.year is not distinct from p.year
  and c.age_grp is not distinct from p.age_grp and c.sex is not distinct from p.sex"""),
    ("al_cells", " union all ".join(f"select age_grp, sex, year, denominator, '{n}' type, {n} numerator, "
                                    f"{epop('age_grp')} epop from al_join" for n in _FLAGS + ["total"])),
]


# --- queries --------------------------------------------------------------------------------

def _copd_rollup_where():
    return stay_filter(C.stay_window, COPD_STAY_CODES)


SQL = {}

SQL["fiscal_year_counts"] = build(["episodes_any"], [],
                                  f"select {fy('admission_date')} AS year, count(*) n from episodes_any group by 1")
SQL["age_bands"] = build(["deaths"], [], f"select {band('age')} age_grp, count(*) n from deaths group by 1")
SQL["epop_weights"] = build(["population"], [], f"""select age_grp, {r4(epop('age_grp'))} epop, cast(sum(pop) as bigint) pop
  from (select {band('age')} age_grp, pop from population) group by age_grp""")
SQL["coarse_bands"] = build(["deaths"], [], f"""select {cband_age('age', COPD_BANDS)} copd_band,
  {cband_grp(band('age'), DIABETES_BANDS)} diabetes_band, {cband_age('age', EPILEPSY_BANDS)} epilepsy_band,
  count(*) n from deaths group by 1, 2, 3""")
SQL["year_labels"] = build(["episodes_any"], [], f"""select year, {year_label('year')} financial,
  {year_label('year', 'calendar')} calendar from (select distinct {fy('admission_date')} AS year from episodes_any)""")
SQL["code_prefix_match"] = build(["episodes_any"], [], f"""select substr(main_condition, 1, 4) code4, count(*) n
  from episodes_any where {match('main_condition', COPD_STAY_CODES)} group by 1""")
SQL["code_regex_match"] = build(["deaths"], [], f"""select {flag('underlying_cause_of_death', COPD_DEATH_CODES)} copd,
  {flag('underlying_cause_of_death', ASTHMA_STAY_CODES)} asthma, count(*) n from deaths group by 1, 2""")
SQL["code_any_position"] = build(["episodes_any"], [], f"""select {flag('main_condition', DIABETES_CODES)} diab_main,
  case when {_DIAB_ANY} then 1 else 0 end diabetes, count(*) n from episodes_any group by 1, 2""")
SQL["stay_rollup"] = build(["episodes_any"], [], rollup_sql("episodes_any", _copd_rollup_where()))
SQL["stay_condition_flags"] = build(["episodes"], [ALLERGY_STAYS],
                                    f"select *, {' + '.join(ALLERGY_TOTAL_FLAGS)} total from al_stays")
SQL["first_per_patient_year"] = build(["episodes"], ASTHMA_CTES[:1], "select * from a_first")
SQL["residency_semi"] = build(["episodes", "episodes_historic", "postcode_lookup"],
                              [stacked("c_stays", C.stay_window, COPD_STAY_CODES)],
                              f"select * exclude (pc7) from c_stays where pc7 in {RESIDENT}")
SQL["residency_inner"] = build(["episodes", "episodes_historic", "postcode_lookup"],
                               [stacked("c_stays", C.stay_window, COPD_STAY_CODES)],
                               "select s.* exclude (pc7), l.datazone2011 from c_stays s join "
                               "(select pc7, datazone2011 from postcode_lookup where datazone2011 is not null) l on s.pc7 = l.pc7")
SQL["residency_columns"] = build(["episodes_any"], [], """select hbtreat_currentdate, count(*) n from episodes_any
  where hbtreat_currentdate is not null and substr(hbtreat_currentdate, 1, 4) <> 'S082' group by 1""")
SQL["population_cells"] = build(["population"], [], pop_cells(1996, 2000))
SQL["cells_full_join"] = build(ASTHMA_NEEDS, ASTHMA_CTES,
                               "select year, age_grp, sex, age_grp2, numerator, denominator, round(epop, 4) epop from a_cells")
SQL["cells_left_join"] = build(COPD_NEEDS, COPD_CTES,
                               "select year, age_grp, sex, age_grp2, numerator, denominator, round(epop, 4) epop from c_cells")
SQL["rates_by_sex"] = build(ASTHMA_NEEDS, ASTHMA_CTES,
                            f"select year, sex, numerator, {r4('rate')} rate from ({rates('a_cells', 100000)})")
SQL["rates_with_cats"] = build(DIAB_NEEDS, DIAB_ADM_CTES,
                               f"select type, year, sex, numerator, {r4('rate')} rate from ({rates('d_adm', 100000, cats=['type', 'sex'])})")
SQL["rates_both_sex_standardised"] = build(ASTHMA_NEEDS, ASTHMA_CTES,
                                           f"select year, numerator, {r4('rate')} rate from ({rates('a_cells', 200000, by_sex=False)})")
SQL["rates_both_sex_pooled"] = build(DIAB_NEEDS, DIAB_ADM_CTES,
                                     f"select type, year, sex, numerator, {r4('rate')} rate from ({rates('d_pooled', 200000, cats=['type'])})")
_AB = ", ".join(lit(b.label) for b in T_ASTHMA.bands)
SQL["rates_coarse_collapsed"] = build(ASTHMA_NEEDS, ASTHMA_CTES + [("a_bands", collapse("a_cells"))],
                                      f"select age_grp, year, sex, numerator, {r4('rate')} rate from "
                                      f"({rates('a_bands', band_total('age_grp', T_ASTHMA.bands), cats=['age_grp'], where=f'age_grp in ({_AB})')})")
_ALLCELLS = (f"select year, {cband_grp('age_grp', T_ASTHMA.bands)} AS age_grp, sex, "
             "cast(coalesce(sum(numerator), 0) as bigint) numerator, "
             "cast(coalesce(sum(denominator), 0) as bigint) denominator, coalesce(sum(epop), 0) epop "
             f"from a_cells group by year, {cband_grp('age_grp', T_ASTHMA.bands)}, sex")
SQL["rates_coarse_all_cells"] = build(ASTHMA_NEEDS, ASTHMA_CTES + [("a_allbands", _ALLCELLS)],
                                      f"select age_grp, year, sex, numerator, {r4('rate')} rate from "
                                      f"({rates('a_allbands', band_total('age_grp', T_ASTHMA.bands), cats=['age_grp'], where=f'age_grp in ({_AB})')})")
_DB = ", ".join(lit(b.label) for b in D.bands)
SQL["rates_coarse_standardised"] = build(DIAB_NEEDS, DIAB_ADM_CTES,
                                         f"select age_grp2, year, sex, numerator, {r4('rate')} rate from "
                                         f"({rates('d_adm', band_total('age_grp2', D.bands), cats=['age_grp2'], where=f"type = 'diab_keto' and age_grp2 in ({_DB})")})")


def _counts_gs(where: str, keep: bool) -> str:
    return (f"select cal_year, case when grouping(sex) = 1 then 'All' else {sex_label('sex', keep)} end sex, count(*) n "
            f"from (select year_of_registration cal_year, sex from deaths where {where}) "
            f"group by grouping sets ((cal_year), (sex, cal_year))")


SQL["counts_grouping_sets"] = build(["deaths"], [], _counts_gs(
    f"year_of_registration between {T_ASTHMA.death_years[0]} and {T_ASTHMA.death_years[1]} and "
    f"{match('underlying_cause_of_death', ASTHMA_DEATH_CODES)}", True))
SQL["death_counts_conditional"] = build(DIAB_DEATH_NEEDS, DIAB_DEATH_CTES[:1], " union all ".join(
    f"select year, sex, age, '{t}' type, {t} numerator from dd_by_age" for t in ("all_diag", "main_diag")))
_LB_COLS = "linkno, cis, source_rank, doadm, dodis, year"
SQL["lookback_from_discharge"] = build(COPD_NEEDS, COPD_CTES[:3],
                                       f"select {_LB_COLS} from ({lookback('c_events', 'dodis', 1.0)})")
SQL["lookback_from_admission"] = build(COPD_NEEDS, EPI_CTES[:3],
                                       f"select {_LB_COLS} from ({lookback('e_events', 'doadm', 1.0)})")
SQL["union_by_name"] = build(COPD_NEEDS, COPD_CTES[:3], "select * from c_events")
SQL["deprivation_rates"] = build(DEP_NEEDS, DEP_CTES,
                                 "select age_grp2, sc_quin, year, sex, numerator, round(rate, 4) rate, age_sex, year_label from dp_chart")
SQL["wide_age_unpivot"] = build(["population_dz"], DEP_CTES[3:5], "select * from dp_pop")


def _diab_chart1():
    total = rates("d_pooled", 200000, cats=["type"])
    by_sex = rates("d_adm", 100000, cats=["type"])
    return (f"select {year_label('year')} class2, {labels(diabetes.CHART1_LABELS, ['type', 'sex'])} class1, numerator, "
            f"{r4('rate')} rate from (select * from ({total}) union all by name select * from ({by_sex})) "
            f"where type <> 'diab_keto'")


SQL["chart_projection"] = build(DIAB_NEEDS, DIAB_ADM_CTES, _diab_chart1())
SQL["two_level_aggregation"] = build(DIAB_NEEDS, DIAB_ADM_CTES[:2], "select * from d_by_age")

# --- charts ---------------------------------------------------------------------------------

SQL["asthma_sex_chart"] = build(ASTHMA_NEEDS, ASTHMA_CTES,
                                f"select year, sex, {r4('rate')} rate from ({chart(rates('a_cells', 100000))})")
SQL["asthma_all_chart"] = build(ASTHMA_NEEDS, ASTHMA_CTES,
                                f"select year, {r4('rate')} rate, sex from ({chart(rates('a_cells', 200000, by_sex=False), by_sex=False)})")


def _tag(parts) -> str:
    return " union all ".join(f"select year, sex, {r4('rate')} rate, '{name}' chart from ({sql})" for name, sql in parts)


SQL["asthma_band_charts"] = build(ASTHMA_NEEDS, ASTHMA_CTES, _tag(
    (name, sql) for name, (b, sql) in zip(("underten_chart", "tenplus_chart"), band_charts("a_cells", T_ASTHMA.bands))))


def _diab_chart2():
    keto = "type = 'diab_keto'"
    bands = rates("d_adm", band_total("age_grp2", D.bands), cats=["age_grp2"], where=f"{keto} and age_grp2 in ({_DB})")
    all_ages = f"select * exclude (type), 'All' age_grp2 from ({rates('d_adm', 100000, cats=['type'], where=keto)})"
    return (f"select {year_label('year')} class2, {labels(diabetes.CHART2_LABELS, ['age_grp2', 'sex'])} class1, "
            f"numerator, {r4('rate')} rate from (select * from ({bands}) union all by name select * from ({all_ages}))")


SQL["diabetes_secondarycare_chart2"] = build(DIAB_NEEDS, DIAB_ADM_CTES, _diab_chart2())


def _diab_mortality():
    totals = rates("dd_pooled", 200000, cats=["type", "sex"])
    by_sex = rates("dd_joined", 100000, cats=["type", "sex"])
    return (f"select year class2, {labels(diabetes.MORTALITY_LABELS, ['type', 'sex'])} class1, numerator, "
            f"{r4('rate')} rate from (select * from ({by_sex}) union all by name select * from ({totals}))")


SQL["diabetes_mortality_chart"] = build(DIAB_DEATH_NEEDS, DIAB_DEATH_CTES, _diab_mortality())
_RECODE = "(case " + " ".join(f"when type = {q(k)} then {q(v)}" for k, v in ALLERGY_LABELS.items()) + " else type end)"
SQL["allergy_chart"] = build(["episodes", "population"], ALLERGY_CTES,
                             f"select {year_label('year')} AS year, {_RECODE} type, numerator, {r4('rate')} rate "
                             f"from ({rates('al_cells', 200000, by_sex=False, cats=['type'])})")
_CM = [
    ("cm_counts", f"select sex, {band('age')} age_grp, year_of_registration AS year, count(*) n "
                  f"from deaths where {COPD_DEATHS_WHERE} group by 1, 2, 3"),
    ("cm_pop", pop_cells(C.population_after_year + 1)),
    ("cm_cells", with_den("cm_counts", "cm_pop", ["year", "age_grp", "sex"], [])),
]
SQL["copd_deaths_chart"] = build(["deaths", "population"], _CM,
                                 f"select year, sex, {r4('rate')} rate from ({chart(rates('cm_cells', 100000), kind='calendar')})")
_COPD_BAND_NAMES = ("copd_undersixtyfive_chart", "copd_sixtyfive_eightyfour_chart", "copd_eightyfiveplus_chart")
SQL["copd_incidence_charts"] = build(COPD_NEEDS, COPD_CTES, _tag(
    [("all_copd_scotland_chart", chart(rates("c_cells", 100000)))]
    + [(name, sql) for name, (b, sql) in zip(_COPD_BAND_NAMES, band_charts("c_cells", C.bands))]))
SQL["copd_deprivation_charts"] = build(DEP_NEEDS, DEP_CTES, " union all ".join(
    f"select sc_quin class1, round(rate, 4) measure, age_sex class2, '{name}' chart from dp_chart "
    f"where age_sex in ('{sx} 65-84', '{sx} +85')" for name, sx in (("copd_deprivation_chart1", "Male"),
                                                                     ("copd_deprivation_chart2", "Female"))))
SQL["epilepsy_deaths_chart"] = build(["deaths"], [], f"""select cal_year class2, n measure, sex class1 from
  ({_counts_gs(EPI_DEATHS_WHERE, False)}) where cal_year >= {E.deaths_from_year}""")


def _epi_chart():
    parts = [f"select year, sex, 'All ages' agegrp, concat_ws(' - ', sex, 'All ages') sex_agegrp, rate "
             f"from ({chart(rates('e_cells', 100000))})"]
    for b, sql in band_charts("e_cells", E.bands):
        name = epilepsy.BAND_NAMES[b.label]
        parts.append(f"select year, sex, '{name}' agegrp, concat_ws(' ', sex, '{name}') sex_agegrp, rate from ({sql})")
    return (f"select year, sex_agegrp, sex, agegrp, round(round(rate, 1), 4) rate from ({' union all '.join(parts)}) "
            f"where year >= '{E.chart_from_label}'")


SQL["epilepsy_incidence_chart"] = build(COPD_NEEDS, EPI_CTES, _epi_chart())
SQL["ms_deaths_chart"] = build(["deaths"], [], f"""select cal_year class1, n measure, sex class2 from
  ({_counts_gs(MS_DEATHS_WHERE, False)})""")


def _ms_charts():
    c1 = (f"select year class2, {r4('rate')} measure, sex class1, 'seccare_chart1_pra' chart "
          f"from ({chart(rates('m_cells', 100000))}) where year <> '{M.dropped_label}'")
    parts = []
    for b, sql in band_charts("m_cells", M.bands):
        name = ms.BAND_NAMES[b.label]
        parts.append(f"select year, rate, case when sex in ('Male', 'Female') then concat_ws(' ', sex, '{name}') end class1 "
                     f"from ({sql})")
    c2 = (f"select year class2, {r4('rate')} measure, class1, 'seccare_chart2_pra' chart from "
          f"({' union all '.join(parts)}) where year <> '{M.dropped_label}'")
    return f"{c1} union all {c2}"


SQL["ms_incidence_charts"] = build(COPD_NEEDS, MS_CTES, _ms_charts())

# --- patient-bucketed base tables -------------------------------------------------------------

SQL["bucketed_stay_rollup"] = build(["episodes", "episodes_historic"], [stacked("c_stays", C.stay_window, COPD_STAY_CODES)],
                                    "select * from c_stays")
SQL["bucketed_first_admissions"] = build(ASTHMA_NEEDS, ASTHMA_CTES[:1],
                                         f"select linkno, year, age, sex from a_first where pc7 in {RESIDENT}")
SQL["bucketed_lookback"] = SQL["lookback_from_discharge"]
SQL["bucketed_records"] = build(["episodes", "episodes_historic", "deaths"], [], " union all ".join(
    f"select cast({rank} as integer) source_rank, cast(count(*) as bigint) records, count(distinct link_no) patients from {t}"
    for t, rank in (("episodes", 1), ("episodes_historic", 2), ("deaths", 0))))

# --- incremental look-back ----------------------------------------------------------------------

SQL["lookback_yearly"] = SQL["lookback_from_discharge"]
_LAG = "datediff('day', lag(dodis) over (partition by b.batch, linkno order by doadm asc nulls last, source_rank asc, cis asc nulls first, no), doadm)"
SQL["lookback_yearly_steps"] = build(COPD_NEEDS, COPD_CTES[:3] + [
    ("y_events", f"select *, row_number() over () no, greatest({FIRST_BATCH_YEAR}, year(dodis) + case when day(dodis) % 5 = 0 then 1 else 0 end) batch "
                 "from c_events"),
    ("y_flags", f"""select b.batch step, e.batch, no, coalesce({_LAG} / 365.0 >= 1.0, true) incident
  from y_events e join (select distinct batch from y_events) b on e.batch <= b.batch"""),
    ("y_both", """select step, batch, no, incident, lag(incident) over (partition by no order by step) was from y_flags"""),
], """select cast(step as integer) batch, count(*) filter (where batch = step) records,
  count(*) filter (where batch = step and incident) incident,
  count(*) filter (where batch < step and was and not incident) withdrawn,
  count(*) filter (where batch < step and not was and incident) added
  from y_both group by step""")

# --- code dictionary --------------------------------------------------------------------------

_CODE_COLS = ["main_condition", *OTHER]
_SINGLE = topic_masks.TOPICS.single
SQL["codebook_codes"] = build(["episodes_any"], [], f"""select code, cast(count(*) as bigint) n,
  {', '.join(f'{flag("code", cs)} {name}' for name, cs in _SINGLE.items())}
  from (select unnest([{', '.join(_CODE_COLS)}]) code from episodes_any) where code is not null group by code""")
SQL["codebook_stay_flags"] = build(["episodes_any"], [], f"""select * from (select link_no linkno, cis_marker cis,
  {', '.join(f'max({flag("main_condition", cs)}) {name}' for name, cs in _SINGLE.items())},
  max({flag(anypos(_CODE_COLS), DIABETES_CODES)}) diabetes, max({flag(anypos(_CODE_COLS), DIABETES_KETO_CODES)}) keto_any
  from episodes_any where sex in ('1', '2') group by 1, 2)
  where {' + '.join([*_SINGLE, 'diabetes', 'keto_any'])} > 0""")
SQL["codebook_any_position"] = build(["episodes_any"], [], f"""select {flag('main_condition', DIABETES_CODES)} diab_main,
  {flag(anypos(_CODE_COLS), DIABETES_CODES)} diabetes, {flag(anypos(_CODE_COLS), DIABETES_KETO_CODES)} keto_any,
  count(*) n from episodes_any group by 1, 2, 3""")


# --- causes of death --------------------------------------------------------------------------

from epistand.params import CAUSE_RELABEL, CAUSE_SUBTRACTION, EXCLUDED_CAUSES, TOTAL_CAUSE, UNDER75_EXCLUDED_AGES  # noqa: E402
from epistand.sources.testdata import (AGE_COLUMNS, CAUSE_GROUPS, HEADER_LINES, SECTION1_GROUPS,  # noqa: E402
                                       SECTION2)

_AGE_NAMES = [a for a, _, _ in AGE_COLUMNS]
_AGECOL = "(case " + " ".join(f"when age between {lo} and {hi} then {q(n)}" for n, lo, hi in AGE_COLUMNS
                              if lo is not None) + " end)"
_GROUPS = " union all ".join(f"select {i} g, {q(c)} icd, {q(n)} cause, {lst(st)} stems"
                             for i, (c, n, st) in enumerate(CAUSE_GROUPS, start=1))
_K, _FIRST, _S2 = SECTION1_GROUPS, HEADER_LINES + 1, SECTION2[0] + 1


def _line(g: str, sx: str) -> str:
    return (f"(case when {g} <= {_K} then {_FIRST} + ({g} - 1) * 4 + {sx} when {g} = {_K + 1} and {sx} = 0 "
            f"then {_FIRST + _K * 4} when {g} = {_K + 1} then {_S2} + {sx} - 1 "
            f"else {_S2} + 2 + ({g} - {_K} - 2) * 3 + {sx} end)")


CAUSE_CTES = [
    ("vt_groups", _GROUPS),
    ("vt_members", "select g, unnest(stems) stem from vt_groups"),
    ("vt_deaths", f"select year_of_registration release, substr(underlying_cause_of_death, 1, 3) stem, "
                  f"case when sex = '1' then 'M' when sex = '2' then 'F' end sexrow, {_AGECOL} agecol from deaths"),
    ("vt_events", "select d.release, m.g, x.sex_row, d.agecol from vt_deaths d join vt_members m on d.stem = m.stem "
                  "cross join lateral (select 'All' sex_row union all select d.sexrow where d.sexrow is not null) x"),
    ("vt_counts", f"select release, g, sex_row, count(*) all_ages, "
                  f"{', '.join(f'count(*) filter (where agecol = {q(a)}) {ident(a)}' for a in _AGE_NAMES)} "
                  f"from vt_events group by release, g, sex_row"),
    ("vt_blocks", "select r.release, g.g, g.icd, g.cause, s.s, ['All', 'M', 'F'][s.s + 1] sex_row "
                  "from (select distinct year_of_registration release from deaths) r cross join vt_groups g "
                  "cross join (select range s from range(0, 3)) s"),
    ("vt_rows", f"select b.release, cast({_line('b.g', 'b.s')} as integer) line_no, "
                f"b.icd, b.cause, b.sex_row, coalesce(c.all_ages, 0) all_ages, "
                f"{', '.join(f'coalesce(c.{ident(a)}, 0) {ident(a)}' for a in _AGE_NAMES)} "
                f"from vt_blocks b left join vt_counts c on b.release = c.release and b.g = c.g and b.sex_row = c.sex_row"),
]


def _fmt(c: str) -> str:
    return f"(case when {c} = 0 then '-' else format('{{:,}}', {c}) end)"


SQL["locf_fill_down"] = build(["deaths"], CAUSE_CTES, f"""select release, line_no, icd {ident('ICD_10_code')},
  cause cause_of_death, sex_row sex, {_fmt('all_ages')} all_ages from vt_rows""")
SQL["drop_empty_and_parse"] = build(["deaths"], CAUSE_CTES, " union all ".join(
    f"select release, line_no, icd {ident('ICD_10_code')}, cause cause_of_death, sex_row sex, {q(a)} age, "
    f"cast({ident(a)} as double) num_deaths from vt_rows" for a in ["all_ages"] + _AGE_NAMES))


def _top(ages) -> str:
    """Top causes over the given age columns (sum over both sexes), as the Spark operator."""
    total_expr = " + ".join(ident(a) for a in ages)
    (target, minus), (old, new) = CAUSE_SUBTRACTION, next(iter(CAUSE_RELABEL.items()))
    return f"""select release, class1, measure, cast(row_number() over (partition by release
  order by measure asc, icd asc, class1 asc) as integer) position from (
  select *, row_number() over (partition by release order by measure desc, icd asc, class1 asc) rk from (
    select release, icd, class1, round(n2 / total * 100, 1) measure from (
      select *, case when class1 = {q(target)} then n - coalesce(max(case when class1 = {q(minus)} then n end)
        over (partition by release), 0) else n end n2 from (
        select release, icd, case when cause = {q(old)} then {q(new)} else cause end class1, n, total from (
          select release, icd, cause, n, max(n) over (partition by release) total from (
            select release, icd, cause, cast(sum({total_expr}) as double) n from vt_rows
            where sex_row <> 'All' group by release, icd, cause))
        where cause <> {q(TOTAL_CAUSE)} and cause not like '%.%'
          and cause not in ({', '.join(q(c) for c in EXCLUDED_CAUSES)})))))
  where rk <= 10"""


SQL["top_causes_under75"] = build(["deaths"], CAUSE_CTES,
                                  _top([a for a in ["all_ages"] + _AGE_NAMES if a not in UNDER75_EXCLUDED_AGES]))
SQL["top_causes_all_ages"] = build(["deaths"], CAUSE_CTES, _top(["all_ages"]))



# --- populations by year ------------------------------------------------------------------------

SQL["cells_of_event_years"] = build(["deaths", "population"], [
    ("cy_counts", f"select year_of_registration AS year, {band('age')} age_grp, sex, count(*) n "
                  f"from deaths where {COPD_DEATHS_WHERE} and year_of_registration > 1998 group by 1, 2, 3"),
    ("cy_pop", pop_cells()),
    ("cy_cells", with_den("cy_counts", "cy_pop", ["year", "age_grp", "sex"], [], "left")),
], "select year, age_grp, sex, numerator, denominator, round(epop, 4) epop from cy_cells")

# --- files, typed CSV, publication, audit --------------------------------------------------------

SQL["locf_fill_down_ranges"] = SQL["locf_fill_down"]
SQL["published_table_from_files"] = SQL["drop_empty_and_parse"]
SQL["published_charts"] = build(ASTHMA_NEEDS, ASTHMA_CTES, " union all ".join(
    f"select year, sex, {r4('rate')} rate, '{name}' chart from ({sql})"
    for name, sql in (("sex_chart", chart(rates("a_cells", 100000))), ("all_chart", chart(rates("a_cells", 200000, by_sex=False), by_sex=False)))))
_SUMMARY = [("sm", f"""select 'band ' || cast(g as varchar) class1, {year_label('y')} class2, n from (
  select {band('age_in_years')} g, {fy('admission_date')} y, count(*) n from episodes group by 1, 2)""")]
SQL["summary_typed_csv"] = build(["episodes"], _SUMMARY, """select class1, class2,
  case when n % 7 not in (0, 1) then round(cast(cast(n as varchar) || '.25' as double), 1) end measure from sm where n % 7 <> 2""")
SQL["summary_rejects"] = build(["episodes"], _SUMMARY, """select 'measure' AS column, cast(n as varchar) || 'x' AS value, count(*) n
  from sm where n % 7 = 2 group by 2""")


def _audit_row(topic: str, cells: str, rate_rows: str) -> str:
    missing = "denominator is null or denominator = 0"
    return (f"select '{topic}' topic, cast(count(*) as bigint) cells, cast(count(*) filter (where {missing}) as bigint) cells_without, "
            f"cast(coalesce(sum(numerator) filter (where {missing}), 0) as bigint) events_without, "
            f"(select cast(count(*) as bigint) from ({rate_rows})) rates from {cells}")


def _once(*groups) -> list:
    return list({name: (name, sql) for group in groups for name, sql in group}.values())


SQL["rates_audit"] = build(
    list(dict.fromkeys([*COPD_NEEDS, *DIAB_NEEDS, *ASTHMA_NEEDS])),
    _once(ASTHMA_CTES, DIAB_ADM_CTES, ALLERGY_CTES, _CM, COPD_CTES, EPI_CTES, MS_CTES), " union all ".join([
        _audit_row("asthma", "a_cells", rates("a_cells", 100000)),
        _audit_row("diabetes", "d_adm", rates("d_adm", 100000, cats=["type", "sex"])),
        _audit_row("allergy", "al_cells", rates("al_cells", 200000, by_sex=False, cats=["type"])),
        _audit_row("copd_deaths", "cm_cells", rates("cm_cells", 100000)),
        _audit_row("copd_incidence", "c_cells", rates("c_cells", 100000)),
        _audit_row("epilepsy_incidence", "e_cells", rates("e_cells", 100000)),
        _audit_row("ms_incidence", "m_cells", rates("m_cells", 100000)),
    ]))


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
