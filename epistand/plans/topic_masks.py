"""All topics of all plans in one code dictionary."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from epistand.operators.codebook import Topics, build_codebook, stay_topics, with_topics
from epistand.operators.extract import OTHER_CONDITIONS, valid_sex
from epistand.params import (ALLERGY_FLAGS, ASTHMA_DEATH_CODES, ASTHMA_STAY_CODES, COPD_DEATH_CODES, COPD_STAY_CODES, DIABETES_CODES,
                             DIABETES_KETO_CODES, EPILEPSY_CODES, MS_CODES)

CODE_COLUMNS = ["main_condition", *OTHER_CONDITIONS]
TOPICS = Topics(
    single={"asthma_stay": ASTHMA_STAY_CODES, "asthma_death": ASTHMA_DEATH_CODES, "copd_stay": COPD_STAY_CODES, "copd_death": COPD_DEATH_CODES,
            "epilepsy": EPILEPSY_CODES, "ms": MS_CODES, "diab_main": DIABETES_CODES, "diab_keto": DIABETES_KETO_CODES, **dict(ALLERGY_FLAGS)},
    joined={"diabetes": DIABETES_CODES, "keto_any": DIABETES_KETO_CODES})


def book(episodes: DataFrame) -> DataFrame:
    return build_codebook(episodes, CODE_COLUMNS, TOPICS)


def masked(episodes: DataFrame, the_book: DataFrame) -> DataFrame:
    return with_topics(episodes, the_book, TOPICS, "main_condition", CODE_COLUMNS)


def stay_flags(episodes: DataFrame) -> DataFrame:
    """Flags of every topic for each stay of valid sex that has one."""
    e = valid_sex(episodes).select("link_no", "cis_marker", *CODE_COLUMNS)
    return stay_topics(masked(e, book(e)), TOPICS)


def code_flags(episodes: DataFrame) -> DataFrame:
    """The dictionary itself: each code, how often it stands in any position, and its topics."""
    from epistand.operators.codebook import flag
    return book(episodes).select("code", "n", *[flag("mask", TOPICS.single, t).alias(t) for t in TOPICS.single])


def any_position_counts(episodes: DataFrame) -> DataFrame:
    """Episodes by main-condition and any-position match of diabetes and ketoacidosis."""
    from epistand.operators.codebook import flag
    e = episodes.select(*CODE_COLUMNS)
    m = masked(e, book(e))
    keys = [flag("topic_mask", TOPICS.single, "diab_main").alias("diab_main"), flag("joined_mask", TOPICS.joined, "diabetes").alias("diabetes"),
            flag("joined_mask", TOPICS.joined, "keto_any").alias("keto_any")]
    return m.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
