"""Long-format time series: catalogue join, decoding and percent distributions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom import fixed
from tallyloom.functions import series as S
from tallyloom.functions.numbers import round_even, to_number, to_year
from tallyloom.operators.relational import is_percent_series, lookup, monthly_only

CATALOGUE_COLUMNS = [
    "series_id", "title", "periodicity", "seasonal", "disa_code", "sexs_code", "ages_code",
    "race_code", "orig_code", "lfst_code", "occupation_code", "indy_code", "class_code",
]


def typed(df: DataFrame) -> DataFrame:
    """Value as double and year as int; text that is no number becomes NULL."""
    return df.withColumns({"value": to_number(F.col("value")), "year": to_year(F.col("year"))})


def with_catalogue(facts: DataFrame, catalogue: DataFrame) -> DataFrame:
    columns = [c for c in CATALOGUE_COLUMNS if c in catalogue.columns]
    return lookup(facts, catalogue.select(*columns), ["series_id"], measure=True)


def title_fallback(df: DataFrame) -> DataFrame:
    return df.withColumn("series_title", F.coalesce("title", "series_description"))


def decode_dimensions(df: DataFrame) -> DataFrame:
    """Labels of the coded dimensions, and the breakdowns told by the title."""
    title = F.col("series_title")
    return df.withColumns({
        "seasonal_adjustment": S.decode(F.col("seasonal"), fixed.SEASONAL),
        "disability_status": S.decode(F.col("disa_code"), fixed.DISABILITY),
        "sex": S.decode(F.col("sexs_code"), fixed.SEX),
        "age_group": S.decode(F.col("ages_code"), fixed.AGE),
        "race_ethnicity": S.race_ethnicity(F.col("race_code"), F.col("orig_code")),
        "labor_force_status": S.decode(F.col("lfst_code"), fixed.LABOR_FORCE),
        "occupation": S.title_breakdown(title, F.col("occupation_code"), "in"),
        "industry": S.title_breakdown(title, F.col("indy_code"), "in"),
        "class_of_worker": S.title_breakdown(title, F.col("class_code"), "as"),
        "nilf_subcategory": S.nilf_subcategory(title),
    })


def blank_dimensions(df: DataFrame) -> DataFrame:
    """What is left to say without a catalogue."""
    blanks = {c: F.lit("") for c in fixed.BLANK_DIMENSIONS}
    return df.withColumns({"series_title": F.col("series_description"), **blanks})


def annual_mean(df: DataFrame, keys: tuple[str, ...] = ("series_id", "year")) -> DataFrame:
    """Mean of the monthly values per series and year, NULLs skipped."""
    return monthly_only(df).groupBy(*keys).agg(F.avg("value").alias("annual_value"))


def denominators(df: DataFrame, codes=None) -> DataFrame:
    """Total employed per disability code, sex code and year, from its monthly series."""
    known = df.sparkSession.createDataFrame(
        codes or fixed.DENOMINATORS, "disa_code int, sexs_code int, series_id string"
    )
    # The ids go into the scan as a literal filter before anything is grouped.
    wanted = df.filter(F.col("series_id").isin(*[c[2] for c in codes or fixed.DENOMINATORS]))
    means = annual_mean(wanted.select("series_id", "year", "period", "value"))
    return means.join(known, "series_id").select(
        "disa_code", "sexs_code", "year", F.col("annual_value").alias("denominator")
    )


def with_denominator(df: DataFrame, denominator: DataFrame, keys: list[str]) -> DataFrame:
    return lookup(df, denominator, keys, measure=True)


def percent_to_thousands(df: DataFrame, denominator: DataFrame) -> DataFrame:
    """Percent distributions as counts; unchanged where value or denominator is missing."""
    joined = with_denominator(df, denominator, ["disa_code", "sexs_code", "year"])
    count = round_even(F.col("value") / F.lit(100.0) * F.col("denominator"), 1)
    converted = F.coalesce(F.when(is_percent_series(F.col("series_title")), count), F.col("value"))
    return joined.withColumn("value", converted).drop("denominator")
