"""Variables of a survey table: classes, parents, redundant columns and unique names."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.functions import labels as L
from tallyloom.operators.relational import lookup

TABLE_YEAR = ["table_id", "year"]


def pe_parent(meta: DataFrame) -> DataFrame:
    """Percentages with their denominator variable, NULL where it does not exist."""
    parents = meta.select(*TABLE_YEAR, F.col("var_id").alias("pe_parent"), F.lit(True).alias("_found"))
    wanted = (
        meta.filter(L.classify(F.col("var_id")) == "PE")
        .withColumn("pe_parent", L.pe_parent_candidate(F.col("var_id")))
    )
    found = lookup(wanted, parents, [*TABLE_YEAR, "pe_parent"], spread_by=["var_id"])
    return found.withColumn("pe_parent", F.when(F.col("_found"), F.col("pe_parent"))).drop("_found")


def _without_counted(meta: DataFrame, suffix: str, condition) -> DataFrame:
    estimates = (
        meta.filter(L.classify(F.col("var_id")) == "E")
        .select(*TABLE_YEAR, F.col("var_id").alias("_count_id"))
        .distinct()
    )
    candidate = L.count_column_candidate(F.col("var_id"), suffix)
    marked = meta.withColumn("_count_id", F.when(condition, candidate) if condition is not None else candidate)
    kept = lookup(marked, estimates, [*TABLE_YEAR, "_count_id"], "left_anti", spread_by=["var_id"])
    return kept.drop("_count_id")


def drop_redundant_pe(meta: DataFrame) -> DataFrame:
    """Without percentages of subject tables whose count column exists."""
    return _without_counted(meta, "PE", None)


def drop_redundant_pct(meta: DataFrame) -> DataFrame:
    """Without estimates labelled as percentages whose count column exists."""
    return _without_counted(meta, "E", F.lower("label").contains("percent"))


def assign_names(meta: DataFrame) -> DataFrame:
    """Readable unique names: a later variable of the same name carries its id in brackets.

    Estimates go before percentages: estimates by `position`, their place in the header, percentages by `meta_position`,
    their place in the metadata, where that is known.
    """
    rank = F.coalesce("meta_position", "position") if "meta_position" in meta.columns else F.col("position")
    is_pe = L.classify(F.col("var_id")) == "PE"
    base = L.label_to_name(F.col("label"))
    named = meta.withColumn("name", F.when(is_pe, L.derived_name(base)).otherwise(base))
    pe = F.coalesce(is_pe, F.lit(False))
    # Two plain minima, which a hash aggregate can hold, instead of one over pairs.
    first = named.groupBy(*TABLE_YEAR, "name").agg(
        F.min(F.when(~pe, F.col("position"))).alias("_first"),
        F.min(F.when(pe, rank)).alias("_first_pe"),
    )
    joined = lookup(named, first, [*TABLE_YEAR, "name"], spread_by=["var_id"])
    is_first = F.when(pe, F.col("_first").isNull() & (rank == F.col("_first_pe"))).otherwise(
        F.col("position") == F.col("_first"))
    unique = F.when(is_first, F.col("name")).otherwise(F.concat("name", F.lit(" ("), "var_id", F.lit(")")))
    return joined.withColumn("name", unique).drop("_first", "_first_pe")


def canonical_names(names: DataFrame) -> DataFrame:
    """Bring old names of the S1810 and S1811 tables to the present hierarchy.

    A rename is left out where its table and year already have the new name; of several renames
    to one name the first by `position` is made.
    """
    table = F.upper("table_id")
    renamed = names.withColumn(
        "_new",
        F.when(table.startswith("S1811"), L.canon_s1811(F.col("name")))
        .when(table.startswith("S1810"), L.canon_s1810(F.col("name")))
        .otherwise(F.col("name")),
    )
    changes = renamed.filter(F.col("_new") != F.col("name"))
    taken = names.select(*TABLE_YEAR, F.col("name").alias("_new")).distinct()
    free = lookup(changes, taken, [*TABLE_YEAR, "_new"], "left_anti", spread_by=["var_id"])
    first = free.groupBy(*TABLE_YEAR, "_new").agg(F.min("position").alias("_first"))
    joined = lookup(renamed, first, [*TABLE_YEAR, "_new"], spread_by=["var_id"])
    return joined.withColumn(
        "name", F.when(F.col("position") == F.col("_first"), F.col("_new")).otherwise(F.col("name"))
    ).drop("_new", "_first")
