"""Adapters that give the driver's TPC-H-like tables the shapes the method reads.

lineitem x orders -> hospital episodes (order = stay, customer = patient); orders with status F
-> death registrations; customer x nation -> postcode lookup and area populations; the customers
with orders in a year -> single-year-of-age populations. Every adapter is a deterministic function of the
given tables, so its size grows with them. The DuckDB mirror of each adapter is in
``epistand.plans.oracle``.
"""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed test values: 3-character code stems spread over the episode and death adapters, so that
# each topic's code set selects some records; a fourth character; and 4-character ICD-9 codes.
CODE_STEMS = ["J45", "J46", "J44", "J43", "J41", "J40", "G40", "G41",
              "G35", "E10", "E11", "E13", "E14", "H10", "J30", "J31",
              "L20", "L23", "L50", "Z88", "K52", "L27", "T78", "T63",
              "T80", "T88", "I21", "C34", "493", "345", "340", "490"]
FOURTH_CHARS = "0123456789X"
DASH_CODES = ["-493", "-490", "-345", "-340"]
# Orders from this date are the current episode table, earlier ones the historic table.
HISTORIC_BEFORE = "1997-01-01"
# Columns the adapters read, with their types: no job reads a footer while a plan is built.
TABLE_COLUMNS = {
    "lineitem": "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double",
    "orders": "o_orderkey long, o_custkey long, o_orderstatus string, o_orderdate timestamp_ntz",
    "customer": "c_custkey long, c_nationkey int",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
}
# Fixed test values: health-board codes of the pre-banded population table.
POPULATION_CODES = ["S00000001", "S08000015"]


def _t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(TABLE_COLUMNS[name]).parquet(os.path.join(sf_dir, f"{name}.parquet"))


def _pick(items, idx: Column) -> Column:
    arr = F.array(*[F.lit(s) for s in items])
    return F.element_at(arr, (idx % F.lit(len(items))).cast("int") + 1)


def _char(idx: Column) -> Column:
    return F.substr(F.lit(FOURTH_CHARS), (idx % F.lit(len(FOURTH_CHARS))).cast("int") + 1, F.lit(1))


def _s(c: Column) -> Column:
    return c.cast("string")


def episodes_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = _t(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity")
    o = _t(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    j = li.join(o, li.l_orderkey == o.o_orderkey)
    pk, sk, ok, ck = F.col("l_partkey"), F.col("l_suppkey"), F.col("o_orderkey"), F.col("o_custkey")
    adm = F.date_add(F.col("o_orderdate").cast("date"), F.col("l_linenumber"))
    return j.select(
        _s(ck).alias("link_no"),
        _s(ok).alias("cis_marker"),
        ((ck * 7 + F.year("o_orderdate")) % 100).cast("int").alias("age_in_years"),
        F.when(ok % 97 == 0, F.lit("0")).otherwise(_s(ck % 2 + 1)).alias("sex"),
        F.when(ok % 89 == 0, F.lit(None).cast("string")).otherwise(_s(ck)).alias("dr_postcode"),
        adm.alias("admission_date"),
        F.date_add(adm, F.col("l_quantity").cast("int")).alias("discharge_date"),
        F.when(ok % 10 == 0, F.lit(None).cast("string")).when(ok % 10 == 1, F.lit("S08200001"))
        .otherwise(F.lit("S08000015")).alias("hbtreat_currentdate"),
        F.when(pk % 17 == 0, _pick(DASH_CODES, sk))
        .otherwise(F.concat(_pick(CODE_STEMS, pk + 3 * sk), _char(sk))).alias("main_condition"),
        F.when(pk % 3 == 0, F.concat(F.lit("E1"), _s(sk % 6), _s(pk % 10))).alias("other_condition_1"),
        F.when(sk % 4 == 0, F.concat(_pick(CODE_STEMS, sk * 5 + F.col("l_linenumber")), F.lit("9")))
        .alias("other_condition_2"),
        F.when(pk % 7 == 1, F.concat(F.lit("E1"), _s(F.col("l_orderkey") % 5), F.lit("9"))).alias("other_condition_3"),
        F.lit(None).cast("string").alias("other_condition_4"),
        F.lit(None).cast("string").alias("other_condition_5"),
        F.col("o_orderdate").alias("_orderdate"),
    )


def _split(df: DataFrame, historic: bool) -> DataFrame:
    cut = F.lit(HISTORIC_BEFORE + " 00:00:00").cast("timestamp_ntz")
    cond = F.col("_orderdate") < cut if historic else F.col("_orderdate") >= cut
    return df.where(cond).drop("_orderdate")


def episodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Current episode table (stays from HISTORIC_BEFORE)."""
    return _split(episodes_all(spark, sf_dir), historic=False)


def episodes_historic(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _split(episodes_all(spark, sf_dir), historic=True)


def deaths(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = _t(spark, sf_dir, "orders").where(F.col("o_orderstatus") == "F")
    ok, ck = F.col("o_orderkey"), F.col("o_custkey")
    reg = F.date_add(F.col("o_orderdate").cast("date"), 30)
    return o.select(
        _s(ck).alias("link_no"),
        F.year(reg).cast("int").alias("year_of_registration"),
        reg.alias("date_of_registration"),
        ((ck * 7 + F.year("o_orderdate")) % 100).cast("int").alias("age"),
        F.when(ok % 50 == 0, F.lit("9")).otherwise(_s(ck % 2 + 1)).alias("sex"),
        F.when(ok % 11 == 0, F.lit("ZZ")).otherwise(F.lit("XS")).alias("country_of_residence"),
        F.when(ok % 19 == 0, _pick(DASH_CODES, ok))
        .otherwise(F.concat(_pick(CODE_STEMS, ok * 5 + ck), _char(ok))).alias("underlying_cause_of_death"),
        F.when(ok % 3 == 0, F.concat(F.lit("E1"), _s(ck % 6), F.lit("9"))).alias("cause_of_death_code_0"),
        F.when(ok % 4 == 1, F.lit("I219")).alias("cause_of_death_code_1"),
        *[F.lit(None).cast("string").alias(f"cause_of_death_code_{i}") for i in range(2, 10)],
    )


def people(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(ck, year): the customers with an order in each calendar year, the population under study."""
    o = _t(spark, sf_dir, "orders")
    return o.select(F.col("o_custkey").alias("ck"), F.year("o_orderdate").cast("int").alias("year")).distinct()


def population(spark: SparkSession, sf_dir: str) -> DataFrame:
    """People per calendar year, single year of age (0-99) and sex."""
    p = people(spark, sf_dir)
    return (p.groupBy("year", ((F.col("ck") * 7 + F.col("year")) % 100).cast("int").alias("age"), _s(F.col("ck") % 2 + 1).alias("sex"))
            .agg(F.count(F.lit(1)).alias("pop")))


def postcode_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customer key as postcode; customers of every sixth nation are not resident (NULL zone)."""
    c = _t(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    n = _t(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    return c.join(n, c.c_nationkey == n.n_nationkey).select(
        _s(F.col("c_custkey")).alias("pc7"),
        F.when(F.col("c_nationkey") % 6 != 0, F.col("n_name")).alias("datazone2011"))


def _area_people(spark: SparkSession, sf_dir: str) -> DataFrame:
    """People per nation, year and sex (customers of the nation with an order in the year)."""
    p = people(spark, sf_dir)
    c = _t(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    return (p.join(c, p.ck == c.c_custkey)
            .groupBy("c_nationkey", "year", F.when(F.col("ck") % 2 == 0, F.lit("M")).otherwise(F.lit("F")).alias("sex"))
            .agg(F.count(F.lit(1)).alias("base")))


def deprivation_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nation name as area, region key + 1 as deprivation quintile, for each year with people (customers
    with an order): the years of a nation need no count of its people."""
    n = _t(spark, sf_dir, "nation")
    o = _t(spark, sf_dir, "orders").select("o_custkey", F.year("o_orderdate").cast("int").alias("year"))
    c = _t(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    years = o.join(c, o.o_custkey == c.c_custkey).select("c_nationkey", "year").distinct()
    return years.join(n, years.c_nationkey == n.n_nationkey).select(
        F.col("n_name").alias("datazone"), "year", (F.col("n_regionkey") + 1).cast("int").alias("sc_quin"))


def population_dz(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Wide area populations (ages 65..89 and 90plus) built from the people per nation, year and sex."""
    n = _t(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    base = _area_people(spark, sf_dir)
    yb = base.join(n, base.c_nationkey == n.n_nationkey)
    ages = [((F.col("base") * 3 + (F.col("year") + a * 7 + F.col("n_nationkey")) % 40).cast("long")).alias(f"age{a}")
            for a in range(65, 90)]
    top = (F.col("base") + 11 + F.col("year") % 7).cast("long").alias("age90plus")
    return yb.select("year", F.col("n_name").alias("datazone2011"), "sex", *ages, top)


def population_ca(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pre-banded population by area code: the whole country and one board (a third of it)."""
    from epistand.functions.ages import age_band
    p = population(spark, sf_dir).withColumn("code", F.explode(F.array(*[F.lit(c) for c in POPULATION_CODES])))
    den = F.when(F.col("code") == POPULATION_CODES[0], F.col("pop")).otherwise(F.floor(F.col("pop") / 3))
    return (p.groupBy("code", "year", F.col("sex").alias("sex_grp"), age_band("age").alias("age_grp"))
            .agg(F.sum(den).cast("long").alias("denominator")))


ADAPTERS = {
    "episodes": episodes, "episodes_historic": episodes_historic, "deaths": deaths,
    "population": population, "postcode_lookup": postcode_lookup,
    "deprivation_lookup": deprivation_lookup, "population_dz": population_dz,
    "population_ca": population_ca,
}


class Sources:
    """The method's input tables, built lazily from one scale-factor folder."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def __getattr__(self, name):
        if name in ADAPTERS:
            frame = ADAPTERS[name](self.spark, self.sf_dir)
            setattr(self, name, frame)  # built once
            return frame
        raise AttributeError(name)


# ---------------------------------------------------------------------------------------------
# Published causes-of-death table, one per registration year, as CSV text lines.
# Fixed test values: cause groups (code range, name, member code stems) in table order. A death
# counts in every group that lists its code stem, so summary groups double-count.
CAUSE_GROUPS = [
    ("A00-Y89", "All causes", CODE_STEMS + ["-49", "-34"]),
    ("C00-D48", "II. Neoplasms", ["C34"]),
    ("C00-C97", "Malignant neoplasms", ["C34"]),
    ("C34", "Lung cancer", ["C34"]),
    ("E10-E14", "Diabetes", ["E10", "E11", "E13", "E14"]),
    ("G35", "Multiple sclerosis", ["G35", "340"]),
    ("G40-G41", "Epilepsy", ["G40", "G41", "345"]),
    ("H10", "Conjunctivitis", ["H10"]),
    ("I21", "Heart attack", ["I21"]),
    ("J00-J99", "X. Respiratory diseases", ["J45", "J46", "J44", "J43", "J41", "J40", "J30", "J31", "493", "490", "-49"]),
    ("J30-J31", "Rhinitis", ["J30", "J31"]),
    ("J40-J44", "Chronic lower respiratory disease", ["J44", "J43", "J41", "J40", "490", "-49"]),
    ("J45-J46", "Asthma", ["J45", "J46", "493"]),
    ("K52", "Gastroenteritis", ["K52"]),
    ("L20-L50", "Skin conditions", ["L20", "L23", "L27", "L50"]),
    ("T63-T88", "Accidents", ["T63", "T78", "T80", "T88"]),
    ("T63", "Poisonings", ["T63"]),
    ("U00-Z99", "Codes for special purposes", ["Z88"]),
    ("-340", "Old neurological codes", ["-34"]),
]
# Fixed test values: age columns of the table and the ages (in years) each covers.
AGE_COLUMNS = [("<4_weeks", 0, 0), ("4-52_weeks", None, None), ("1-4", 1, 4), ("5-9", 5, 9), ("10-14", 10, 14),
               ("15-24", 15, 24), ("25-34", 25, 34), ("35-44", 35, 44), ("45-54", 45, 54), ("55-64", 55, 64),
               ("65-74", 65, 74), ("75-84", 75, 84), ("85-89", 85, 89), ("90+", 90, 200)]
SEX_ROWS = [("All", None), ("M", "1"), ("F", "2")]
# Layout: 7 header lines; section 1 holds the first SECTION1_GROUPS blocks (3 rows + 1 blank
# each) and the first row of the next block; 3 footnote lines; section 2 holds the rest of that
# block and every later block (3 rows each); 2 footer lines.
HEADER_LINES = 7
SECTION1_GROUPS = 8
FOOTNOTE_LINES = 3
SECTION1 = (HEADER_LINES, SECTION1_GROUPS * 4 + 1)
SECTION2 = (HEADER_LINES + SECTION1_GROUPS * 4 + 1 + FOOTNOTE_LINES,
            2 + 3 * (len(CAUSE_GROUPS) - SECTION1_GROUPS - 1))


def age_column(age: Column) -> Column:
    expr = None
    for name, lo, hi in AGE_COLUMNS:
        if lo is None:
            continue
        cond = age.between(lo, hi)
        expr = F.when(cond, F.lit(name)) if expr is None else expr.when(cond, F.lit(name))
    return expr


def block_line(g: Column, s: Column) -> Column:
    """Line number of row s (0 All, 1 M, 2 F) of cause block g (1-based)."""
    k, first = SECTION1_GROUPS, HEADER_LINES + 1
    s2 = SECTION2[0] + 1
    return (F.when(g <= k, first + (g - 1) * 4 + s)
            .when((g == k + 1) & (s == 0), first + k * 4)
            .when(g == k + 1, s2 + s - 1)
            .otherwise(s2 + 2 + (g - k - 2) * 3 + s)).cast("int")


def _csv_field(c: Column) -> Column:
    return F.when(c.isNull(), F.lit("")).otherwise(F.concat(F.lit('"'), c, F.lit('"')))


def vital_events_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(release, line_no, value): the causes table of each registration year as text lines."""
    # The stem -> group list is a fixed ~50-row table: joined as a broadcast of known size.
    members = spark.createDataFrame([(st, gi) for gi, (_, _, stems) in enumerate(CAUSE_GROUPS, start=1)
                                     for st in stems], "stem string, g int")
    d = deaths(spark, sf_dir)
    sex_rows = F.array(F.lit("All"), F.when(F.col("sex") == "1", "M").when(F.col("sex") == "2", "F"))
    events = (d.select(F.col("year_of_registration").alias("release"),
                       F.substring("underlying_cause_of_death", 1, 3).alias("stem"),
                       F.explode(sex_rows).alias("sex_row"),
                       age_column(F.col("age")).alias("agecol"))
              .where(F.col("sex_row").isNotNull())
              .join(F.broadcast(members), "stem"))
    age_names = [a for a, _, _ in AGE_COLUMNS]
    counts = (events.groupBy("release", "g", "sex_row")
              .agg(F.count(F.lit(1)).alias("all_ages"),
                   *[F.count_if(F.col("agecol") == a).alias(a) for a in age_names]))
    # Every block exists in every release, also when nobody died of that cause.
    blocks = (d.select(F.col("year_of_registration").alias("release")).distinct()
              .withColumn("g", F.explode(F.sequence(F.lit(1), F.lit(len(CAUSE_GROUPS)))))
              .withColumn("s", F.explode(F.sequence(F.lit(0), F.lit(2)))))
    sex_name = F.element_at(F.array(*[F.lit(n) for n, _ in SEX_ROWS]), F.col("s") + 1)
    codes = F.array(*[F.lit(c) for c, _, _ in CAUSE_GROUPS])
    names = F.array(*[F.lit(n) for _, n, _ in CAUSE_GROUPS])
    rows = blocks.withColumn("sex_row", sex_name).join(counts, ["release", "g", "sex_row"], "left")

    def fmt(c):
        n = F.coalesce(F.col(c), F.lit(0))
        return F.when(n == 0, F.lit("-")).otherwise(F.format_number(n, 0))

    first = F.col("s") == 0
    fields = [F.when(first, F.element_at(codes, F.col("g"))), F.when(first, F.element_at(names, F.col("g"))),
              F.when(first, F.lit("All")).otherwise(F.col("sex_row")),
              fmt("all_ages"), *[fmt(a) for a in age_names]]
    data = rows.select("release", block_line(F.col("g"), F.col("s")).alias("line_no"),
                       F.concat_ws(",", *[_csv_field(f) for f in fields]).alias("value"))
    # Header, blank separators after each section-1 block, footnotes and footer.
    k = SECTION1_GROUPS
    blank_lines = [HEADER_LINES + 1 + (g - 1) * 4 + 3 for g in range(1, k + 1)]
    notes = ([(i, f"Deaths by cause, sex and age: header line {i}") for i in range(1, HEADER_LINES + 1)]
             + [(ln, ",,,,,,,,,,,,,,,,,") for ln in blank_lines]
             + [(SECTION1[0] + SECTION1[1] + i, f"Footnote {i}: codes, ranges") for i in range(1, FOOTNOTE_LINES + 1)]
             + [(SECTION2[0] + SECTION2[1] + i, f"Footer {i}") for i in range(1, 3)])
    extra = (d.select(F.col("year_of_registration").alias("release")).distinct()
             .withColumn("t", F.explode(F.array(*[F.struct(F.lit(ln).alias("line_no"), F.lit(v).alias("value"))
                                                  for ln, v in notes])))
             .select("release", "t.line_no", "t.value"))
    # Lines of one release stay together, as when each published file is read by one task.
    return data.unionByName(extra).repartition("release")


ADAPTERS["vital_events_lines"] = vital_events_lines
