"""Profiles of tables and files, flags and coverage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.functions.numbers import round_even, to_number
from tallyloom.operators.relational import lookup
from tallyloom.session import materialise

_NUMERIC = ("tinyint", "smallint", "int", "bigint", "float", "double", "decimal")


def cells(df: DataFrame, by: list[str], blank_as_null: bool = True) -> DataFrame:
    """One row per cell: by, position, text, number. One pass, no job per column; the position
    stands for name and type, so that neither is shuffled with every cell."""
    def entry(position: int, name: str, kind: str) -> Column:
        col = F.col(f"`{name}`")
        if kind.startswith(_NUMERIC):
            # `+ 0` makes -0.0 and 0.0 one value.
            number = col.cast("double") + F.lit(0.0)
            text = (col + F.lit(0.0) if kind in ("float", "double") else col).cast("string")
        else:
            text = col.cast("string")
            number = to_number(text)
            text = F.when(text != "", text) if blank_as_null else text
        return F.struct(F.lit(position).alias("position"), text.alias("text"), number.alias("number"))

    entries = [entry(i, c, kind) for i, (c, kind) in enumerate(df.dtypes) if c not in by]
    return df.select(*by, F.inline(F.array(*entries)))


def profile_columns(
    df: DataFrame, by: list[str] | None = None, blank_as_null: bool = True, exact: bool = True
) -> DataFrame:
    """Per column: type, nulls, distinct values, and numeric range where any value is a number.

    With `exact` off, distinct values are estimated, which avoids the shuffle of all values.
    """
    by = by or []
    distinct = F.countDistinct("text") if exact else F.approx_count_distinct("text")
    grouped = cells(df, by, blank_as_null).groupBy(*by, "position").agg(
        F.count(F.lit(1)).alias("row_count"),
        F.count_if(F.col("text").isNull()).alias("null_count"),
        distinct.alias("unique_count"),
        F.min("number").alias("min"),
        F.max("number").alias("max"),
        F.count_if(F.col("number") < 0).alias("_negative"),
        F.avg("number").alias("_mean"),
    )
    names, kinds = (F.array(*[F.lit(v) for v in values]) for values in zip(*df.dtypes))
    share = F.col("null_count") / F.greatest(F.col("row_count"), F.lit(1)) * 100
    return grouped.select(
        *by, "position", F.get(names, "position").alias("column"), F.get(kinds, "position").alias("dtype"), "null_count",
        round_even(share, 2).alias("null_pct"), "unique_count", "min", "max",
        F.when(F.col("min").isNotNull(), F.col("_negative")).alias("negative_count"),
        round_even(F.col("_mean"), 4).alias("mean"),
    )


# Accuracy of the sketches of distinct values (a relative error of about 0.7 percent), and the estimate up to
# which values are counted exactly instead.
SKETCH_BITS = 14
FEW = 1000


def column_states(df: DataFrame, by: list[str], blank_as_null: bool = True, few: int = FEW) -> DataFrame:
    """What profiles of columns are made of, per group and column, in a form that merges.

    Counts, sums and extremes add up; distinct values are a sketch, so no value is shuffled. Only of
    columns with at most `few` of them in every group they are counted exactly too, in a second pass over those columns.
    """
    found = cells(df, by, blank_as_null).groupBy(*by, "position").agg(
        F.count(F.lit(1)).alias("row_count"), F.count_if(F.col("text").isNull()).alias("null_count"),
        F.count("number").alias("number_count"), F.count_if(F.col("number") < 0).alias("negative_count"),
        F.sum("number").alias("sum"), F.min("number").alias("min"), F.max("number").alias("max"),
        F.hll_sketch_agg("text", SKETCH_BITS).alias("sketch"),
    )
    names, kinds = (F.array(*[F.lit(v) for v in values]) for values in zip(*df.dtypes))
    place = F.col("position")
    found = materialise(found.withColumns({"column": F.get(names, place), "dtype": F.get(kinds, place)}), "states")
    widest = found.groupBy("column").agg(F.max(F.hll_sketch_estimate("sketch")).alias("n")).where(F.col("n") <= few)
    small = [r["column"] for r in widest.collect()]  # names of columns
    if not small:
        return found.withColumn("distinct_count", F.lit(None).cast("bigint"))
    some = df.select(*by, *[F.col(f"`{c}`") for c in small])
    labels = F.array(*[F.lit(c) for c in some.columns])
    exact = cells(some, by, blank_as_null).groupBy(*by, "position").agg(F.countDistinct("text").alias("distinct_count"))
    keys = [f"_k{i}" for i in range(len(by) + 1)]
    exact = exact.select(*[F.col(c).alias(k) for c, k in zip(by, keys)], F.get(labels, "position").alias(keys[-1]), "distinct_count")
    same = [F.col(c).eqNullSafe(F.col(k)) for c, k in zip([*by, "column"], keys)]
    return found.join(exact, same, "left").drop(*keys)


def merge_states(states: DataFrame, by: list[str]) -> DataFrame:
    """States of parts as states of the groups of `by`; of distinct values the sketch is left."""
    return states.groupBy(*by, "column").agg(
        F.min("position").alias("position"), F.max("dtype").alias("dtype"),
        *[F.sum(c).alias(c) for c in ("row_count", "null_count", "number_count", "negative_count", "sum")],
        F.min("min").alias("min"), F.max("max").alias("max"), F.hll_union_agg("sketch", True).alias("sketch"),
        F.lit(None).cast("bigint").alias("distinct_count"),
    )


def profile_states(states: DataFrame, by: list[str]) -> DataFrame:
    """Profiles from states, as `profile_columns` gives them; `unique_exact` tells whether distinct values were counted."""
    share = F.col("null_count") / F.greatest(F.col("row_count"), F.lit(1)) * 100
    return states.select(
        *by, "position", "column", "dtype", "null_count", round_even(share, 2).alias("null_pct"),
        F.coalesce("distinct_count", F.hll_sketch_estimate("sketch")).alias("unique_count"), F.col("distinct_count").isNotNull().alias("unique_exact"),
        "min", "max", F.when(F.col("number_count") > 0, F.col("negative_count")).alias("negative_count"),
        round_even(F.try_divide("sum", F.col("number_count")), 4).alias("mean"),
    )


def duplicate_rows(df: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Rows that repeat an earlier row; NULL equals NULL. Copies are counted before any shuffle."""
    counted = df.groupBy(*[F.col(f"`{c}`") for c in df.columns]).agg(F.count(F.lit(1)).alias("_copies"))
    return counted.groupBy(*(by or [])).agg(
        F.coalesce(F.sum(F.col("_copies") - 1), F.lit(0)).alias("duplicate_rows")
    )


def profile_file(df: DataFrame, by: list[str] | None = None, blank_as_null: bool = True) -> DataFrame:
    """Per file: rows, columns, duplicates, missing fips, year range and NULL cells.

    Equal rows are folded first, so one shuffle serves all counts.
    """
    by = by or []
    columns = [c for c in df.columns if c not in by]
    kinds = dict(df.dtypes)

    def missing(c: str) -> Column:
        col = F.col(f"`{c}`")
        empty = col.isNull()
        if blank_as_null and kinds[c] == "string":
            empty = empty | (col == "")
        return F.when(empty, 1).otherwise(0)

    counted = df.groupBy(*[F.col(f"`{c}`") for c in df.columns]).agg(F.count(F.lit(1)).alias("_copies"))
    nulls = sum((missing(c) for c in columns), F.lit(0))
    year = F.col("year").try_cast("int") if "year" in columns else F.lit(None).cast("int")
    fips = F.sum(F.col("_copies") * missing("fips")) if "fips" in columns else F.lit(None).cast("bigint")
    return counted.groupBy(*by).agg(
        F.sum("_copies").alias("row_count"),
        F.lit(len(columns)).alias("column_count"),
        F.sum(F.col("_copies") - 1).alias("duplicate_rows"),
        fips.alias("missing_fips"),
        F.min(year).alias("year_min"),
        F.max(year).alias("year_max"),
        F.sum(F.col("_copies") * nulls).alias("total_nulls"),
    )


def quality_flags(profile: DataFrame, by: list[str], files: DataFrame | None = None) -> DataFrame:
    """Columns more than half NULL and columns with negative values, in column order; with the
    file profiles also the status. The lists are as long as a table is wide."""
    def listed(condition: Column) -> Column:
        hits = F.collect_list(F.when(condition, F.struct("position", "column")))
        return F.array_join(F.transform(F.sort_array(hits), lambda h: h["column"]), "; ")

    flags = profile.groupBy(*by).agg(
        listed(F.col("null_pct") > 50).alias("high_null_cols"),
        listed(F.col("negative_count") > 0).alias("negative_cols"),
    )
    if files is None:
        return flags
    warn = (F.col("duplicate_rows") > 0) | (F.col("high_null_cols") != "") | (F.col("negative_cols") != "")
    return lookup(files, flags, by).withColumn("status", F.when(warn, "WARN").otherwise("OK"))


def null_counts(df: DataFrame) -> DataFrame:
    """NULLs per column, one row per column."""
    counts = df.agg(
        F.count(F.lit(1)).alias("_rows"), *[F.count_if(F.col(f"`{c}`").isNull()).alias(c) for c in df.columns]
    )
    pairs = [F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").alias("null_count")) for c in df.columns]
    return counts.select(F.col("_rows").alias("row_count"), F.inline(F.array(*pairs)))


def distinct_where(df: DataFrame, col: str, predicate: Column, out: str = "distinct_count") -> DataFrame:
    return df.agg(F.countDistinct(F.when(predicate, F.col(col))).alias(out))


def availability(long: DataFrame) -> DataFrame:
    """First and last year in which a column has values."""
    return long.filter(F.col("value").isNotNull()).groupBy("column").agg(
        F.min("year").alias("first_year"), F.max("year").alias("last_year"),
        F.count(F.lit(1)).alias("value_count"),
    )


def coverage(df: DataFrame, by: list[str]) -> DataFrame:
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias("row_count"))
