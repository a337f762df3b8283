"""Correlation study over published state rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.functions.numbers import log_column, rate
from tallyloom.operators.relational import any_not_null, at_level, join_state_year, not_null
from tallyloom.operators.statistics import STUDY, correlation_states, correlation_summary, merge_pearson, pearson_of

# Studies, labels and columns of the published summary.
EDUCATION = {
    "edu_bachelors_share": ("dis_edu_bachelors_plus", "Bachelor's degree or higher"),
    "edu_some_college_share": ("dis_edu_some_college", "Some college / associate degree"),
    "edu_hs_grad_share": ("dis_edu_hs_grad", "High school graduate, no college"),
    "edu_less_than_hs_share": ("dis_edu_less_than_hs", "Less than high school"),
}
TYPES = {
    "dis_type_hearing_18_64": "Hearing difficulty prevalence",
    "dis_type_vision_18_64": "Vision difficulty prevalence",
    "dis_type_cognitive_18_64": "Cognitive difficulty prevalence",
    "dis_type_ambulatory_18_64": "Ambulatory difficulty prevalence",
    "dis_type_self_care_18_64": "Self-care difficulty prevalence",
    "dis_type_indep_living_18_64": "Independent living difficulty prevalence",
}
POOL = {
    "talent_pool_size": "Talent pool size (raw count)",
    "talent_pool_log": "Talent pool size (log)",
    "talent_pool_share": "Talent pool share of total population",
}
RATE_16 = "Disability employment rate (16+)"
RATE_18 = "Overall disability employment rate (18-64)"


def education(s1811: DataFrame) -> DataFrame:
    base = not_null(at_level(s1811, "state"), "dis_edu_pop_25_plus")
    return base.select(
        "state", "state_fips", "year",
        rate(F.col("dis_employed_total"), F.col("dis_pop_16_plus")).alias("employment_rate"),
        *[rate(F.col(c), F.col("dis_edu_pop_25_plus")).alias(out) for out, (c, _) in EDUCATION.items()],
    )


def disability_type(b18120: DataFrame, s1810: DataFrame) -> DataFrame:
    kinds = list(TYPES)
    shares = any_not_null(at_level(s1810, "state"), kinds).select("state_fips", "year", *kinds)
    return join_state_year(at_level(b18120, "state"), shares).select(
        "state", "state_fips", "year",
        rate(F.col("dis_employed"), F.col("pop_total")).alias("employment_rate"),
        *[rate(F.col(c), F.col("pop_total")).alias(f"{c}_prevalence") for c in kinds],
    )


def talent_pool(s1810: DataFrame, s1811: DataFrame) -> DataFrame:
    people = at_level(s1810, "state").select("state", "state_fips", "year", "dis_pop_total", "pop_total")
    work = at_level(s1811, "state").select("state_fips", "year", "dis_employed_total", "dis_pop_16_plus")
    return join_state_year(people, work).select(
        "state", "state_fips", "year",
        rate(F.col("dis_employed_total"), F.col("dis_pop_16_plus")).alias("employment_rate"),
        F.col("dis_pop_total").alias("talent_pool_size"),
        log_column(F.col("dis_pop_total")).alias("talent_pool_log"),
        rate(F.col("dis_pop_total"), F.col("pop_total")).alias("talent_pool_share"),
    )


def studies(s1810: DataFrame, s1811: DataFrame, b18120: DataFrame) -> list[tuple]:
    return [
        ("Education vs Employment Rate", education(s1811),
         {out: label for out, (_, label) in EDUCATION.items()}, "employment_rate", RATE_16),
        ("Disability Type vs Employment Rate", disability_type(b18120, s1810),
         {f"{c}_prevalence": label for c, label in TYPES.items()}, "employment_rate", RATE_18),
        ("Talent Pool Size vs Employment Rate", talent_pool(s1810, s1811), POOL, "employment_rate", RATE_16),
    ]


def summary(s1810: DataFrame, s1811: DataFrame, b18120: DataFrame) -> DataFrame:
    """The thirteen correlations of the three studies."""
    return correlation_summary(studies(s1810, s1811, b18120))


def refresh_states(store: str, years: list[int], s1810: DataFrame, s1811: DataFrame, b18120: DataFrame) -> DataFrame:
    """Replace the states of the given years at `store` and return those of all years; only these years' rows are read."""
    tables = [df.where(F.col("year").isin(years)) for df in (s1810, s1811, b18120)]
    spark = s1810.sparkSession
    states = correlation_states(studies(*tables))
    states.coalesce(1).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("year").parquet(store)
    return spark.read.schema(states.schema).parquet(store)


def summary_of(states: DataFrame) -> DataFrame:
    """The correlations over all years, from the states of each."""
    return pearson_of(merge_pearson(states, STUDY), STUDY)
