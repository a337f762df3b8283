"""Edits of a series catalogue, each a set operation on the whole table."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.functions.series import sa_series_id, sa_title, seasonal_by_prefix
from tallyloom.operators.relational import lookup, missing_in


def delete_where(df: DataFrame, predicate: Column) -> DataFrame:
    """Rows for which the predicate does not hold; an unknown outcome keeps the row."""
    return df.filter(~F.coalesce(predicate, F.lit(False)))


def select_series(df: DataFrame, prefix: str, **attributes) -> DataFrame:
    """Series whose id starts with `prefix` and whose attributes have the given values."""
    return reduce(
        lambda kept, item: kept.filter(F.col(item[0]) == item[1]),
        attributes.items(),
        df.filter(F.col("series_id").startswith(prefix)),
    )


def correct_attribute(df: DataFrame, predicate: Column, col: str, value) -> DataFrame:
    return df.withColumn(col, F.when(predicate, F.lit(value)).otherwise(F.col(col)))


def mark_seasonal(df: DataFrame) -> DataFrame:
    return df.withColumn("seasonal", seasonal_by_prefix(F.col("series_id"), F.col("seasonal")))


def sa_counterpart(df: DataFrame) -> DataFrame:
    """Seasonally adjusted twins of the given series."""
    return df.withColumns({
        "series_id": sa_series_id(F.col("series_id")),
        "title": sa_title(F.col("title")),
        "seasonal": F.lit("S"),
    })


def insert_missing(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """Add the rows of `new` whose key `old` lacks."""
    return old.unionByName(missing_in(new, old, [key]), allowMissingColumns=True)


def add_adjusted(df: DataFrame) -> DataFrame:
    """Add the adjusted twin of every monthly unadjusted series that lacks one."""
    marked = mark_seasonal(df)
    return insert_missing(marked, sa_counterpart(select_series(marked, "LNU0", periodicity="M")), "series_id")


def repair_adjusted(df: DataFrame) -> DataFrame:
    """Remove adjusted series of disability groups, which are not published; total-population
    series are monthly, and get their adjusted twins."""
    code = F.coalesce("disa_code", F.lit(0))
    kept = delete_where(df, F.col("series_id").startswith("LNS1") & code.isin(1, 2))
    general = F.col("series_id").startswith("LNU0") & (F.col("disa_code") == 0)
    monthly = correct_attribute(kept, general & (F.col("periodicity") == "A"), "periodicity", "M")
    twins = sa_counterpart(select_series(monthly, "LNU0", disa_code=0))
    return insert_missing(monthly, twins.withColumn("periodicity", F.lit("M")), "series_id")


def last_per_key(df: DataFrame, key: str, order: str | None = None) -> DataFrame:
    """Of the rows of a key only the last, by `order` or else in the order of the input."""
    at = F.col(order) if order else F.monotonically_increasing_id()
    columns = [c for c in df.columns if c != key]
    rows = df.select(key, at.alias("_at"), F.struct(*columns).alias("_row"))
    return rows.groupBy(key).agg(F.max_by("_row", "_at").alias("_row")).select(key, "_row.*")


def enrich_defaults(old: DataFrame, sheet: DataFrame, key: str, cols: list[str], default, order: str | None = None) -> DataFrame:
    """Codes of the sheet for the keys that it has, the last row of a key counting.

    Other rows get the default for all codes if the first of `cols` is unset, else they keep theirs.
    """
    fresh = last_per_key(sheet.select(key, *cols, *([order] if order else [])), key, order)
    joined = lookup(old, fresh.select(key, *[F.col(c).alias(f"_{c}") for c in cols], F.lit(True).alias("_met")), [key])
    unset = F.col(cols[0]).isNull()
    picked = {c: F.when(F.col("_met"), F.col(f"_{c}")).when(unset, F.lit(default)).otherwise(F.col(c)) for c in cols}
    return joined.withColumns(picked).drop("_met", *[f"_{c}" for c in cols])


def both_states(old: DataFrame, new: DataFrame, key: list[str], order: str | None = None) -> DataFrame:
    """One row per key with _old and _new, the last row that either side has of it, or NULL.

    Both sides are one union, shuffled once by the key; NULL is a key like any other. The last row is that of the
    largest `order`, or else the last of the input.
    """
    def side(df: DataFrame, name: str, other: str) -> DataFrame:
        at = F.col(order) if order else F.monotonically_increasing_id()
        columns = [c for c in df.columns if c not in key]
        return df.select(*key, at.alias("_at"), F.struct(F.lit(True).alias("_is"), *columns).alias(name))

    left, right = side(old, "_old", "_new"), side(new, "_new", "_old")
    rows = left.unionByName(right, allowMissingColumns=True)
    last = [F.max_by(c, F.when(F.col(c).isNotNull(), F.col("_at"))).alias(c) for c in ("_old", "_new")]
    return rows.groupBy(*key).agg(*last)


def upsert(old: DataFrame, new: DataFrame, key: str | list[str], order: str | None = None) -> DataFrame:
    """Union by key in which attributes of `new` that are not NULL win.

    Of a key met twice on a side the last row counts, as `both_states` finds it, so the result has one row per key.
    """
    keys = [key] if isinstance(key, str) else key
    columns = [c for c in dict.fromkeys([*old.columns, *new.columns]) if c not in keys]

    def pick(c: str) -> Column:
        sides = [F.col(f"{s}.`{c}`") for s, df in (("_new", new), ("_old", old)) if c in df.columns]
        return F.coalesce(*sides).alias(c)

    return both_states(old, new, keys, order).select(*keys, *[pick(c) for c in columns])


def change_report(old: DataFrame, new: DataFrame, key: str | list[str], order: str | None = None) -> DataFrame:
    """Numbers of added, removed, changed and equal keys between two states of a table.

    Every key is counted once, NULL too: of a key met twice in a state the last row counts.
    """
    keys = [key] if isinstance(key, str) else key
    columns = [c for c in old.columns if c in new.columns and c not in keys]
    same = reduce(Column.__and__, [F.col(f"_old.`{c}`").eqNullSafe(F.col(f"_new.`{c}`")) for c in columns], F.lit(True))
    change = (
        F.when(F.col("_old").isNull(), "added")
        .when(F.col("_new").isNull(), "removed")
        .when(same, "equal")
        .otherwise("changed")
    )
    return both_states(old, new, keys, order).groupBy(change.alias("change")).agg(F.count(F.lit(1)).alias("n"))
