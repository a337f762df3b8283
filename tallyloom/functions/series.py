"""Column expressions for coded time series: decodes, title parsing and period dates."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallyloom.fixed import ALL_RACES, HISPANIC, RACES


def decode(code: Column, labels: dict) -> Column:
    """Label of a code; NULL for a code that has none."""
    table = F.create_map(*[F.lit(v) for v in chain.from_iterable(labels.items())])
    return F.try_element_at(table, code)


def race_ethnicity(race: Column, origin: Column) -> Column:
    """Hispanic origin goes before race; anything unknown counts as all races."""
    return F.when(origin == 1, F.lit(HISPANIC)).otherwise(
        F.coalesce(decode(F.coalesce(race, F.lit(0)), RACES), F.lit(ALL_RACES))
    )


def title_breakdown(title: Column, code: Column, word: str) -> Column:
    """Group named in a title after `percent employed <word>`, where the series has a code."""
    # Fixed value: pattern of the published titles.
    pattern = rf"[Pp]ercent employed {word} (.+?)(?:,\s*(?:Men|Women))?$"
    named = F.trim(F.regexp_extract(title, pattern, 1))
    return F.when(F.coalesce(code, F.lit(0)) != 0, F.coalesce(named, F.lit(""))).otherwise("")


def nilf_subcategory(title: Column) -> Column:
    """Not-in-labour-force detail or education level told by words of the title."""
    low = F.lower(title)

    def has(text: str) -> Column:
        return low.contains(text)

    gate = low.rlike("want a job|marginally attached|discouraged|high school|some college|bachelor")
    # `reasons other` is tested twice: alone it is not enough to enter the second branch.
    return (
        F.when(title.isNull() | ~gate, F.lit(""))
        .when(has("discouraged workers"), F.lit("Discouraged workers"))
        .when(has("reasons other than discouragement"), F.lit("Other marginally attached"))
        .when(
            has("marginally attached") & ~has("discouraged"),
            F.when(has("reasons other"), F.lit("Other marginally attached")).otherwise("Marginally attached"),
        )
        .when(has("want a job"), F.lit("Wants a job"))
        .when(has("less than a high school"), F.lit("Less than high school diploma"))
        .when(has("high school graduates, no college"), F.lit("High school graduate, no college"))
        .when(has("some college or associate"), F.lit("Some college or associate degree"))
        .when(has("bachelor"), F.lit("Bachelor's degree or higher"))
        .otherwise("")
    )


def period_to_date(year: Column, period: Column) -> Column:
    """ISO text of the first day of a month, quarter or year; unknown periods mean the year."""
    number = F.substring(period, 2, 2).try_cast("int")
    month = (
        F.when(period.rlike(r"^M(0[1-9]|1[0-2])$"), number)
        .when(period.rlike(r"^Q0[1-4]$"), number * 3 - 2)
        .otherwise(1)
    )
    return F.format_string("%d-%02d-01", F.coalesce(year, F.lit(0)), month)


def join_texts(items: Column, separator: str = "; ", field: str | None = "text") -> Column:
    """Non-empty texts of an array in order; `field` names the text inside structs."""
    texts = F.transform(items, lambda i: i[field]) if field else items
    return F.coalesce(F.array_join(F.filter(texts, lambda t: t != ""), separator), F.lit(""))


def sa_series_id(series_id: Column) -> Column:
    """Id of the seasonally adjusted counterpart."""
    return F.concat(F.lit("LNS1"), F.substring(series_id, 5, 2**31 - 1))


def sa_title(title: Column) -> Column:
    """Title of the seasonally adjusted counterpart."""
    return F.replace(title, F.lit("(unadj)"), F.lit("(sadj)"))


def seasonal_by_prefix(series_id: Column, seasonal: Column) -> Column:
    """Seasonal marker, told by the id where it is not set."""
    return F.coalesce(seasonal, F.when(series_id.startswith("LNS"), F.lit("S")).otherwise("U"))
