"""Column sets: whitelist, empty columns and warehouse names."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.fixed import GEO_COLUMNS, PUBLISHED_COLUMNS
from tallyloom.functions.labels import sanitize_name
from tallyloom.operators.relational import ordinal

TABLE_YEAR = ["table_id", "year"]


def apply_schema(df: DataFrame, table: str) -> DataFrame:
    """Keep geography and published columns of a named table; other tables stay as they are."""
    published = PUBLISHED_COLUMNS.get(table.upper())
    if published is None:
        return df
    geo = [F.col(c) for c in df.columns if c in GEO_COLUMNS]
    return df.select(*geo, *[F.col(f"`{c}`").alias(published[c]) for c in df.columns if c in published])


def pack_names(names: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Variable of each wanted name per table and year, as one map."""
    wanted = names.filter(F.col("name").isin(*columns))
    return wanted.groupBy(*TABLE_YEAR).agg(
        F.map_from_entries(F.collect_list(F.struct("name", "var_id"))).alias("ids")
    )


def publish_columns(rows: DataFrame, columns: dict[str, str], keep: list[str]) -> DataFrame:
    """One column per entry of `columns` (name → output name), picked from the map `values`.

    The map `ids` tells under which variable a row's table and year carry a name, so the pick
    is row-local and needs no pivot.
    """
    picks = [
        F.try_element_at("values", F.try_element_at("ids", F.lit(name))).alias(out)
        for name, out in columns.items()
    ]
    return rows.select(*keep, *picks)


def drop_all_null(df: DataFrame) -> DataFrame:
    """Without the columns that are NULL in every row; one pass, one row of counts."""
    counts = df.agg(*[F.count(F.col(f"`{c}`")).alias(c) for c in df.columns]).first()
    return df.select(*[F.col(f"`{c}`") for c in df.columns if counts[c] > 0])


def sanitize_names(names: DataFrame, owner: list[str]) -> DataFrame:
    """Add `column_name` to a table of names: warehouse-safe, repeats numbered by `position`."""
    safe = names.withColumn("_safe", sanitize_name(F.col("name")))
    ranked = ordinal(safe, [*owner, "_safe"], "position", "_nth")
    return ranked.withColumn(
        "column_name",
        F.when(F.col("_nth") == 1, F.col("_safe")).otherwise(
            F.concat("_safe", F.lit("_"), (F.col("_nth") - 1).cast("string"))
        ),
    ).drop("_safe", "_nth")


def sanitize_columns(df: DataFrame) -> DataFrame:
    """Rename the columns of `df` to warehouse-safe names, numbered further where one is taken."""
    spark = df.sparkSession
    listed = spark.createDataFrame(list(enumerate(df.columns)), "position int, name string")
    safe = [r["s"] for r in listed.orderBy("position").select(sanitize_name(F.col("name")).alias("s")).collect()]
    taken, final, seen = set(safe), [], {}
    for name in safe:
        count = seen.get(name, -1) + 1
        while count and f"{name}_{count}" in taken:
            count += 1
        seen[name] = count
        final.append(f"{name}_{count}" if count else name)
        taken.add(final[-1])
    return df.toDF(*final)
