"""Geographic keys of survey rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def zero_pad(text: Column, width: int) -> Column:
    """Left zeros up to `width`; longer text stays whole."""
    return F.lpad(text, F.greatest(F.lit(width), F.length(text)), F.lit("0"))


def pad_fips(df: DataFrame) -> DataFrame:
    """Add state_fips and county_fips from the raw codes; no county code on state rows."""
    county = F.coalesce("county", F.lit(""))
    has_county = (county != "") & (county != "nan") & (F.col("level") != "state")
    return df.withColumns({
        "state_fips": zero_pad(F.coalesce("state", F.lit("")), 2),
        "county_fips": F.when(has_county, zero_pad(county, 3)).otherwise(""),
    })


def split_name(df: DataFrame) -> DataFrame:
    """Add state_name and county_name: a county row is cut at the last comma."""
    name, pattern = F.coalesce("name", F.lit("")), r"(?s)^(.*), (.*)$"
    is_state, cut = F.col("level") == "state", name.rlike(pattern)
    return df.withColumns({
        "county_name": F.when(is_state, "").when(cut, F.regexp_extract(name, pattern, 1)).otherwise(name),
        "state_name": F.when(~is_state & cut, F.regexp_extract(name, pattern, 2)).otherwise(name),
    })


def geo_keys(df: DataFrame) -> DataFrame:
    """Replace name, state and county by the published geographic columns."""
    named = split_name(pad_fips(df))
    is_state = F.col("level") == "state"
    return named.withColumns({
        "survey_type": F.lit("1-Year"),
        "geo_id": F.when(is_state, F.concat(F.lit("0400000US"), "state_fips"))
        .otherwise(F.concat(F.lit("0500000US"), "state_fips", "county_fips")),
        "fips": F.concat("state_fips", "county_fips"),
        "state": F.col("state_name"),
        "county": F.col("county_name"),
    }).drop("name", "state_name", "county_name", "ucgid")


def fill_geo(df: DataFrame) -> DataFrame:
    """Empty text instead of NULL in the geographic names."""
    return df.fillna("", ["state", "county", "county_fips"])
