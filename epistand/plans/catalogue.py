"""Query catalogue: one Spark query per operator group and per published chart.

Each entry takes (spark, sf_dir) and reads the driver's tables through the adapters in
``epistand.sources.testdata``; parameters are the published ones moved onto the years the test
tables cover (orders 1995-2001) with a one-year look-back gap. The DuckDB oracle of every entry
is in ``epistand.plans.oracle``. Double columns are rounded to 4 decimals so that the order of
floating-point sums cannot change the comparison.
"""

from __future__ import annotations

import uuid
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from epistand.functions.ages import age_band, coarse_band, coarse_band_from_grp, epop_weight
from epistand.functions.codes import any_position_match, match_flag
from epistand.functions.dates import fiscal_year, year_label
from epistand.operators.cells import count_cells
from epistand.operators.charts import chart_data
from epistand.operators.extract import (OTHER_CONDITIONS, death_events, first_per_patient_year, select_codes,
                                        select_window, stay_rollup, valid_sex)
from epistand.operators.incidence import incident_events
from epistand.operators.population import area_population_long, population_cells
from epistand.operators.residency import resident_by_lookup, treated_in_board
from epistand.operators.standardise import band_rates, pooled_both_sexes, rates_within_bands, standardised_rates
from epistand.params import (ASTHMA_BANDS, ASTHMA_STAY_CODES, COPD_BANDS, COPD_DEATH_CODES, COPD_STAY_CODES,
                             DIABETES_BANDS, DIABETES_CODES, EPILEPSY_BANDS, EPILEPSY_CODES, LookbackParams)
from epistand.plans import allergy, asthma, causes, copd, diabetes, epilepsy, ms, patient_plans, topic_masks
from epistand.plans.audit import audit_table
from epistand.plans.incidence_topics import stacked_stays
from epistand.plans.publication import publish_version, read_published
from epistand.session import ensure_checkpoint_dir
from epistand.sources import testdata
from epistand.sources.line_ranges import fill_down_ranges, numbered_lines
from epistand.sources.population_table import left_cells, population_by_year
from epistand.sources.readers import lineage_cut
from epistand.sources.schemas import CHART_CSV
from epistand.sources.testdata import Sources
from epistand.sources.typed_csv import accepted, read_checked, rejects

# Test parameters: the published windows moved onto 1995-2001.
ONE_YEAR_DODIS = LookbackParams(gap_from="dodis", min_gap_years=1.0)
ONE_YEAR_DOADM = LookbackParams(gap_from="doadm", min_gap_years=1.0)
T_ASTHMA = asthma.AsthmaParams(death_years=(1995, 2001), stay_window=(date(1995, 4, 1), date(2001, 3, 31)),
                               population_years=(1995, 2000))
T_DIABETES = diabetes.DiabetesParams(discharge_window=(date(1995, 4, 1), date(2001, 3, 31)),
                                     death_years=(1995, 2001))
T_ALLERGY = allergy.AllergyParams(discharge_window=(date(1995, 4, 1), date(2001, 3, 31)),
                                  population_years=(1995, 2001))
T_COPD = copd.CopdParams(death_window=(date(1995, 1, 1), date(2001, 12, 31)),
                         stay_window=(date(1995, 1, 1), date(2001, 12, 31)), population_after_year=1994,
                         output_after_year=1995, lookback=ONE_YEAR_DODIS, event_year=2000, population_year=1999)
T_EPILEPSY = epilepsy.EpilepsyParams(death_window=(date(1995, 1, 1), date(2001, 12, 31)),
                                     stay_window=(date(1995, 4, 1), date(2001, 3, 31)), population_years=(1996, 2001),
                                     output_after_year=1995, deaths_from_year=1996, chart_from_label="1996/97",
                                     lookback=ONE_YEAR_DOADM)
T_MS = ms.MsParams(death_window=(date(1995, 1, 1), date(2001, 12, 31)),
                   stay_window=(date(1995, 1, 1), date(2001, 12, 31)), population_years=(1997, 2001),
                   output_after_year=1995, dropped_label="1996/97", lookback=ONE_YEAR_DODIS)


def rounded(df: DataFrame, digits: int = 4) -> DataFrame:
    return df.select(*[F.round(f.name, digits).alias(f.name) if isinstance(f.dataType, T.DoubleType) else F.col(f.name)
                       for f in df.schema.fields])


def _src(spark, d) -> Sources:
    return Sources(spark, d)


def _all_episodes(s: Sources) -> DataFrame:
    return testdata.episodes_all(s.spark, s.sf_dir).drop("_orderdate")


# --- operator groups ------------------------------------------------------------------------

def q_fiscal_year_counts(spark, d):
    e = _all_episodes(_src(spark, d))
    return e.groupBy(fiscal_year("admission_date").alias("year")).agg(F.count(F.lit(1)).alias("n"))


def q_age_bands(spark, d):
    return _src(spark, d).deaths.groupBy(age_band("age").alias("age_grp")).agg(F.count(F.lit(1)).alias("n"))


def q_epop_weights(spark, d):
    p = _src(spark, d).population.groupBy(age_band("age").alias("age_grp")).agg(F.sum("pop").alias("pop"))
    return rounded(p.select("age_grp", epop_weight("age_grp").alias("epop"), "pop"))


def q_coarse_bands(spark, d):
    dd = _src(spark, d).deaths.withColumn("age_grp", age_band("age"))
    return dd.groupBy(coarse_band("age", COPD_BANDS).alias("copd_band"),
                      coarse_band_from_grp("age_grp", DIABETES_BANDS).alias("diabetes_band"),
                      coarse_band("age", EPILEPSY_BANDS).alias("epilepsy_band")).agg(F.count(F.lit(1)).alias("n"))


def q_year_labels(spark, d):
    years = _all_episodes(_src(spark, d)).select(fiscal_year("admission_date").alias("year")).distinct()
    return years.select("year", year_label("year").alias("financial"), year_label("year", "calendar").alias("calendar"))


def q_code_prefix_match(spark, d):
    e = select_codes(_all_episodes(_src(spark, d)), "main_condition", COPD_STAY_CODES)
    return e.groupBy(F.substring("main_condition", 1, 4).alias("code4")).agg(F.count(F.lit(1)).alias("n"))


def q_code_regex_match(spark, d):
    dd = _src(spark, d).deaths
    return dd.groupBy(match_flag("underlying_cause_of_death", COPD_DEATH_CODES).alias("copd"),
                      match_flag("underlying_cause_of_death", ASTHMA_STAY_CODES).alias("asthma")
                      ).agg(F.count(F.lit(1)).alias("n"))


def q_code_any_position(spark, d):
    e = _all_episodes(_src(spark, d))
    anyp = F.when(any_position_match(["main_condition", *OTHER_CONDITIONS], DIABETES_CODES), 1).otherwise(0)
    return e.groupBy(match_flag("main_condition", DIABETES_CODES).alias("diab_main"),
                     anyp.alias("diabetes")).agg(F.count(F.lit(1)).alias("n"))


def _copd_episodes(s: Sources) -> DataFrame:
    e = select_window(_all_episodes(s), "admission_date", *T_COPD.stay_window)
    return select_codes(valid_sex(e), "main_condition", COPD_STAY_CODES)


def q_stay_rollup(spark, d):
    return stay_rollup(_copd_episodes(_src(spark, d)))


def q_stay_condition_flags(spark, d):
    return allergy.with_total(allergy.stays(_src(spark, d), T_ALLERGY))


def q_first_per_patient_year(spark, d):
    s = _src(spark, d)
    e = select_window(s.episodes, "admission_date", *T_ASTHMA.stay_window)
    return first_per_patient_year(select_codes(valid_sex(e), "main_condition", ASTHMA_STAY_CODES))


def _copd_stacked(s: Sources) -> DataFrame:
    return stacked_stays(s, COPD_STAY_CODES, T_COPD.stay_window)


def q_residency_semi(spark, d):
    s = _src(spark, d)
    return resident_by_lookup(_copd_stacked(s), s.postcode_lookup)


def q_residency_inner(spark, d):
    s = _src(spark, d)
    return resident_by_lookup(_copd_stacked(s), s.postcode_lookup, keep_zone=True)


def q_residency_columns(spark, d):
    e = treated_in_board(_all_episodes(_src(spark, d)))
    return e.groupBy("hbtreat_currentdate").agg(F.count(F.lit(1)).alias("n"))


def q_population_cells(spark, d):
    return population_cells(_src(spark, d).population, 1996, 2000)


def q_cells_full_join(spark, d):
    return rounded(asthma.cells(_src(spark, d), T_ASTHMA))


def q_cells_left_join(spark, d):
    return rounded(copd.incidence(_src(spark, d), T_COPD))


def q_rates_by_sex(spark, d):
    return rounded(standardised_rates(asthma.cells(_src(spark, d), T_ASTHMA), 100000))


def q_rates_with_cats(spark, d):
    adm = diabetes.admission_cells(_src(spark, d), T_DIABETES)
    return rounded(standardised_rates(adm, 100000, cats=["type", "sex"]))


def q_rates_both_sex_standardised(spark, d):
    return rounded(standardised_rates(asthma.cells(_src(spark, d), T_ASTHMA), 200000, by_sex=False))


def q_rates_both_sex_pooled(spark, d):
    adm = diabetes.admission_cells(_src(spark, d), T_DIABETES)
    return rounded(standardised_rates(pooled_both_sexes(adm), 200000, cats=["type"]))


def q_rates_coarse_collapsed(spark, d):
    return rounded(band_rates(asthma.cells(_src(spark, d), T_ASTHMA), ASTHMA_BANDS))


def q_rates_coarse_all_cells(spark, d):
    """Collapsed bands where every cell takes its band from its five-year band (also the cells
    with no events), instead of the band of the event side only."""
    from epistand.functions.ages import band_epop_total
    from epistand.operators.standardise import collapse_bands
    c = collapse_bands(asthma.cells(_src(spark, d), T_ASTHMA), bands=ASTHMA_BANDS)
    c = c.where(F.col("age_grp").isin([b.label for b in ASTHMA_BANDS]))
    return rounded(standardised_rates(c, band_epop_total("age_grp", ASTHMA_BANDS), cats=["age_grp"]))


def q_rates_coarse_standardised(spark, d):
    adm = diabetes.admission_cells(_src(spark, d), T_DIABETES)
    return rounded(rates_within_bands(adm.where(F.col("type") == "diab_keto"), DIABETES_BANDS))


def q_counts_grouping_sets(spark, d):
    return asthma.death_counts(_src(spark, d), T_ASTHMA)


def q_death_counts_conditional(spark, d):
    return diabetes.death_counts_long(_src(spark, d), T_DIABETES)


def _copd_events(s: Sources) -> DataFrame:
    resident = resident_by_lookup(_copd_stacked(s), s.postcode_lookup)
    return death_events(copd.deaths(s, T_COPD)).unionByName(resident, allowMissingColumns=True)


def _epilepsy_events(s: Sources) -> DataFrame:
    stays = stacked_stays(s, EPILEPSY_CODES, T_EPILEPSY.stay_window, board_filter=True)
    resident = resident_by_lookup(stays, s.postcode_lookup)
    deaths = epilepsy.deaths(s, T_EPILEPSY).where(F.col("country_of_residence") == "XS")
    return death_events(deaths).unionByName(resident, allowMissingColumns=True)


LOOKBACK_COLUMNS = ["linkno", "cis", "source_rank", "doadm", "dodis", "year"]


def q_lookback_from_discharge(spark, d):
    ev = _copd_events(_src(spark, d))
    return incident_events(ev, gap_from="dodis", min_gap_years=1.0).select(*LOOKBACK_COLUMNS)


def q_lookback_from_admission(spark, d):
    ev = _epilepsy_events(_src(spark, d))
    return incident_events(ev, gap_from="doadm", min_gap_years=1.0).select(*LOOKBACK_COLUMNS)


def q_union_by_name(spark, d):
    return _copd_events(_src(spark, d))


def q_deprivation_rates(spark, d):
    return rounded(copd.deprivation_chart(copd.deprivation_cells(_src(spark, d), T_COPD)))


def q_wide_age_unpivot(spark, d):
    return area_population_long(_src(spark, d).population_dz, T_COPD.population_year, 65)


def q_chart_projection(spark, d):
    return rounded(diabetes.chart1(diabetes.admission_cells(_src(spark, d), T_DIABETES)))


def q_two_level_aggregation(spark, d):
    return diabetes.admissions_by_age(_src(spark, d), T_DIABETES)


# --- patient-bucketed base tables ------------------------------------------------------------

def q_bucketed_stay_rollup(spark, d):
    return patient_plans.stays(patient_plans.layout(_src(spark, d)), COPD_STAY_CODES, T_COPD.stay_window).drop("zone")


def q_bucketed_first_admissions(spark, d):
    return patient_plans.first_admissions(patient_plans.layout(_src(spark, d)), ASTHMA_STAY_CODES, T_ASTHMA.stay_window)


def q_bucketed_lookback(spark, d):
    found = patient_plans.incident(patient_plans.layout(_src(spark, d)), COPD_STAY_CODES, T_COPD.stay_window,
                                   COPD_DEATH_CODES, T_COPD.death_window, T_COPD.lookback)
    return found.select(*LOOKBACK_COLUMNS)


def q_bucketed_records(spark, d):
    return patient_plans.records_per_source(patient_plans.layout(_src(spark, d)))


# --- incremental look-back ---------------------------------------------------------------------

FIRST_BATCH_YEAR = 1998


def _scratch(spark, name: str) -> str:
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def _yearly_copd(spark, d):
    folder = _scratch(spark, "lookback-state")
    return patient_plans.yearly_lookback(_copd_events(_src(spark, d)), folder, T_COPD.lookback, FIRST_BATCH_YEAR, ["dodis", "year"])


def q_lookback_yearly(spark, d):
    """Incident records after all yearly batches: the whole-history answer."""
    return _yearly_copd(spark, d)[0].incident().select(*LOOKBACK_COLUMNS)


def q_lookback_yearly_steps(spark, d):
    """Per batch: new records, incident ones among them, and earlier answers withdrawn or added by late records."""
    steps = _yearly_copd(spark, d)[1]
    rows = [(int(s.label), s.counts["records"], s.counts["incident"], s.counts["withdrawn"], s.counts["added"]) for s in steps]
    return spark.createDataFrame(rows, "batch int, records long, incident long, withdrawn long, added long")


# --- code dictionary ---------------------------------------------------------------------------

def q_codebook_codes(spark, d):
    return topic_masks.code_flags(_all_episodes(_src(spark, d)))


def q_codebook_stay_flags(spark, d):
    return topic_masks.stay_flags(_all_episodes(_src(spark, d)))


def q_codebook_any_position(spark, d):
    return topic_masks.any_position_counts(_all_episodes(_src(spark, d)))


# --- causes of death (published table) ---------------------------------------------------

T_CAUSES = causes.CausesParams(section1=testdata.SECTION1, section2=testdata.SECTION2)


def _lines(spark, d):
    return testdata.vital_events_lines(spark, d)


def q_locf_fill_down(spark, d):
    from epistand.operators.reshape import fill_down
    t = causes.table(_lines(spark, d), T_CAUSES)
    filled = fill_down(t, [c for c in t.columns if c not in ("release", "line_no")], "release", "line_no")
    return filled.select("release", "line_no", "ICD_10_code", "cause_of_death", "sex", "all_ages")


def q_drop_empty_and_parse(spark, d):
    return causes.clean(_lines(spark, d), T_CAUSES)


def q_top_causes_under75(spark, d):
    return rounded(causes.run(_lines(spark, d), T_CAUSES)["top10causes_chart2"])


def q_top_causes_all_ages(spark, d):
    return rounded(causes.run(_lines(spark, d), T_CAUSES)["top10causes_chart1"])


# --- populations by year -----------------------------------------------------------------------

def q_cells_of_event_years(spark, d):
    """COPD deaths of some years joined to the population folders of exactly these years."""
    s = _src(spark, d)
    deaths = copd.deaths(s, T_COPD).where(F.col("year_of_registration") > 1998).withColumn("age_grp", age_band("age"))
    counts = count_cells(deaths, [F.col("year_of_registration").alias("year"), "age_grp", "sex"])
    return rounded(left_cells(counts, population_by_year(s)))


# --- files: ranges of lines, typed CSV, atomic publication ------------------------------------

RANGE_BYTES = 2000  # of the published text tables, which have some 10 kB: several ranges a file
SEGMENT_LINES = 9


def _lines_of_files(spark, d):
    """The published tables written as one text file per release and read back in byte ranges."""
    path = _scratch(spark, "tables")
    lines = _lines(spark, d).repartition("release").sortWithinPartitions("release", "line_no")
    lines.select("release", "value").write.partitionBy("release").text(path)
    numbered = numbered_lines(spark, path, release="release", range_bytes=RANGE_BYTES)
    return numbered.withColumn("release", F.col("release").cast("int"))


def _range_fill(table, cols, release, line):
    return fill_down_ranges(table, cols, release, line, SEGMENT_LINES)


def q_locf_fill_down_ranges(spark, d):
    t = causes.table(_lines_of_files(spark, d), T_CAUSES)
    filled = _range_fill(t, [c for c in t.columns if c not in ("release", "line_no")], "release", "line_no")
    return filled.select("release", "line_no", "ICD_10_code", "cause_of_death", "sex", "all_ages")


def q_published_table_from_files(spark, d):
    return causes.clean(_lines_of_files(spark, d), T_CAUSES, fill=_range_fill)


def _summary_csv(spark, d):
    """An earlier chart file (class1 age band, class2 year, measure): missing and bad measures among its values."""
    n = (_src(spark, d).episodes.groupBy(age_band("age_in_years").alias("g"), fiscal_year("admission_date").alias("y"))
         .agg(F.count(F.lit(1)).alias("n")))
    measure = (F.when(F.col("n") % 7 == 0, "NA").when(F.col("n") % 7 == 1, " ").when(F.col("n") % 7 == 2, F.concat("n", F.lit("x")))
               .otherwise(F.concat("n", F.lit(".25"))))
    rows = n.select(F.concat(F.lit("band "), F.col("g").cast("string")).alias("class1"), year_label("y").alias("class2"), measure.alias("measure"))
    path = _scratch(spark, "summary")
    rows.repartition(2).write.option("header", True).option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)
    return read_checked(spark, path, CHART_CSV)


def q_summary_typed_csv(spark, d):
    chart = accepted(_summary_csv(spark, d))
    return chart.select("class1", "class2", F.round("measure", 1).alias("measure"))


def q_summary_rejects(spark, d):
    return rejects(_summary_csv(spark, d))


def q_published_charts(spark, d):
    """Asthma charts published with a manifest, then read back from the version in force."""
    cells = lineage_cut(asthma.cells(_src(spark, d), T_ASTHMA))
    folder = _scratch(spark, "charts")
    publish_version({"sex_chart": chart_data(cells, 100000), "all_chart": chart_data(cells, 200000, by_sex=False)}, folder)
    back = _tagged({n: read_published(spark, folder, n).select("year", "sex", F.col("rate").cast("double").alias("rate"))
                    for n in ("sex_chart", "all_chart")})
    return rounded(back)


def q_rates_audit(spark, d):
    """Cells, cells and events without a denominator, and rates of the rate plans, each from one pass."""
    s = _src(spark, d)
    return audit_table(spark, {
        "asthma": (asthma.cells(s, T_ASTHMA), lambda c: standardised_rates(c, 100000)),
        "diabetes": (diabetes.admission_cells(s, T_DIABETES), lambda c: standardised_rates(c, 100000, cats=["type", "sex"])),
        "allergy": (allergy.cells(s, T_ALLERGY), allergy.rates),
        "copd_deaths": (copd.mortality_cells(s, T_COPD), lambda c: standardised_rates(c, 100000)),
        "copd_incidence": (copd.incidence(s, T_COPD), lambda c: standardised_rates(c, 100000)),
        "epilepsy_incidence": (epilepsy.incidence(s, T_EPILEPSY), lambda c: standardised_rates(c, 100000)),
        "ms_incidence": (ms.incidence(s, T_MS), lambda c: standardised_rates(c, 100000)),
    })


# --- published charts -----------------------------------------------------------------------

def _tagged(parts: dict) -> DataFrame:
    out = None
    for name, df in parts.items():
        df = df.withColumn("chart", F.lit(name))
        out = df if out is None else out.unionByName(df)
    return out


def q_asthma_sex_chart(spark, d):
    return rounded(chart_data(asthma.cells(_src(spark, d), T_ASTHMA), 100000))


def q_asthma_all_chart(spark, d):
    return rounded(chart_data(asthma.cells(_src(spark, d), T_ASTHMA), 200000, by_sex=False))


def q_asthma_band_charts(spark, d):
    return rounded(asthma.band_charts(asthma.cells(_src(spark, d), T_ASTHMA), T_ASTHMA.bands))


def q_diabetes_secondarycare_chart2(spark, d):
    s = _src(spark, d)
    return rounded(diabetes.chart2(diabetes.admission_cells(s, T_DIABETES), T_DIABETES))


def q_diabetes_mortality_chart(spark, d):
    return rounded(diabetes.mortality_chart(diabetes.death_cells(_src(spark, d), T_DIABETES)))


def q_allergy_chart(spark, d):
    return rounded(allergy.chart(allergy.rates(allergy.cells(_src(spark, d), T_ALLERGY))))


def q_copd_deaths_chart(spark, d):
    return rounded(chart_data(copd.mortality_cells(_src(spark, d), T_COPD), 100000, year_type="calendar"))


def q_copd_incidence_charts(spark, d):
    return rounded(copd.incidence_charts(copd.incidence(_src(spark, d), T_COPD), T_COPD))


def q_copd_deprivation_charts(spark, d):
    return rounded(_tagged(copd.deprivation_charts(copd.deprivation_cells(_src(spark, d), T_COPD))))


def q_epilepsy_deaths_chart(spark, d):
    return epilepsy.death_chart(_src(spark, d), T_EPILEPSY)


def q_epilepsy_incidence_chart(spark, d):
    return rounded(epilepsy.incidence_chart(epilepsy.incidence(_src(spark, d), T_EPILEPSY), T_EPILEPSY))


def q_ms_deaths_chart(spark, d):
    return ms.death_chart(_src(spark, d), T_MS)


def q_ms_incidence_charts(spark, d):
    s = _src(spark, d)
    inc = ms.incidence(s, T_MS)
    return rounded(_tagged({"seccare_chart1_pra": ms.chart1(inc, T_MS), "seccare_chart2_pra": ms.chart2(inc, T_MS)}))


QUERIES = {name[2:]: fn for name, fn in sorted(globals().items()) if name.startswith("q_") and callable(fn)}


def queries() -> dict:
    return dict(QUERIES)
