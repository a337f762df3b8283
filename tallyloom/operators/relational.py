"""Filters, joins, unions and orders, with the joins laid out for skewed keys."""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.functions.labels import classify
from tallyloom.session import input_bytes, materialise, plan_bytes, weighed

HOT_SHARE = 0.001
BROADCAST_BYTES = 64 << 20
TRUSTED = 256 << 10  # bytes of a table's files up to which Spark's guess of its size may decide the join
SMALL_FACTS = 16 << 20


# ---- filters ---------------------------------------------------------------------------

def at_level(df: DataFrame, level: str) -> DataFrame:
    return df.filter(F.col("level") == level)


def not_null(df: DataFrame, col: str) -> DataFrame:
    return df.filter(F.col(col).isNotNull())


def any_not_null(df: DataFrame, cols: list[str]) -> DataFrame:
    """Rows with a value in at least one of `cols`."""
    return df.filter(reduce(Column.__or__, [F.col(c).isNotNull() for c in cols]))


def complete_pairs(df: DataFrame, x: str, y: str) -> DataFrame:
    return df.filter(F.col(x).isNotNull() & F.col(y).isNotNull())


def monthly_only(df: DataFrame, col: str = "period") -> DataFrame:
    """Periods of the form M and two digits; the yearly average M13 is one of them."""
    return df.filter(F.col(col).rlike(r"^M\d\d$"))


def is_percent_series(title: Column) -> Column:
    """Titles of percent distributions; case matters."""
    return F.coalesce(title.rlike("Percent employed in|Percent employed as"), F.lit(False))


def percent_series(df: DataFrame, col: str = "series_title") -> DataFrame:
    return df.filter(is_percent_series(F.col(col)))


def non_blank(df: DataFrame, col: str) -> DataFrame:
    return df.filter(F.col(col) != "")


def usable_variables(meta: DataFrame) -> DataFrame:
    """Estimates and percentages; margins of error, annotations and keys are dropped."""
    return meta.filter(classify(F.col("var_id")).isin("E", "PE"))


# ---- joins -----------------------------------------------------------------------------

def hot_keys(facts: DataFrame, on: list[str]) -> tuple[list[int], int]:
    """Hashes of the keys that hold more than a thousandth of the rows, and into how many parts
    to cut them so that a part is no larger than an even shuffle partition.

    One pass over the key columns fills a mergeable sketch; fewer than a thousand keys can be hot.
    """
    sketch = F.call_function("approx_top_k", F.xxhash64(*on), F.lit(1000), F.lit(100_000))
    rows, found = facts.agg(F.count(F.lit(1)), sketch).first()
    hot = {key: count for key, count in found or [] if count > rows * HOT_SHARE}
    partitions = int(facts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    largest = max(hot.values(), default=0) / max(rows, 1)
    parts = math.ceil(largest * partitions)
    return (list(hot), parts) if parts > 1 else ([], 1)


def _spread_columns(df: DataFrame, on: list[str]) -> list[str]:
    kinds = ("map", "array<map", "variant")
    return [c for c, kind in df.dtypes if c not in on and not kind.startswith(kinds)]


def lookup(
    facts: DataFrame,
    table: DataFrame,
    on: list[str],
    how: str = "left",
    spread_by: list[str] | None = None,
    measure: bool = False,
) -> DataFrame:
    """Join facts to a table that holds one row per key, whatever the key's share of the facts.

    `how` may be left, inner, left_semi or left_anti. With `measure` the table is first written
    to the shared folder and weighed, its rows counted too: below the bound it is broadcast, so that
    the facts are not shuffled at all.

    Otherwise both sides are shuffled and merged: what Spark guesses from files that repeat much is
    a hundredth of the rows, which it would hand whole to every task. The facts' rows of a hot key are cut into parts by a hash
    of their other columns, and only the table's rows of hot keys are repeated, once per part.
    Adaptive execution splits what is still skewed then (equal copies of one row).
    """
    if measure:
        table, size = weighed(table, "lookup")
        if size <= BROADCAST_BYTES and table.count() * (24 + 16 * len(table.columns)) <= BROADCAST_BYTES:
            return facts.join(F.broadcast(table), on, how)
    if input_bytes(table) > TRUSTED:
        table = table.hint("merge")
    # No key of facts this small is too heavy for one task, and Spark may broadcast them as they are.
    if plan_bytes(facts) <= SMALL_FACTS:
        return facts.join(table, on, how)
    others = spread_by or _spread_columns(facts, on)
    hot, parts = hot_keys(facts, on) if others else ([], 1)
    if not hot:
        return facts.join(table, on, how)

    def is_hot() -> Column:
        # Both sides hash their keys in the types of the facts.
        return F.xxhash64(*[F.col(c).try_cast(facts.schema[c].dataType) for c in on]).isin(hot)

    part = F.pmod(F.xxhash64(*others), F.lit(parts)).cast("int")
    every = F.sequence(F.lit(0), F.lit(parts - 1))
    cut = facts.withColumn("_part", F.when(is_hot(), part).otherwise(0))
    repeated = table.withColumn("_part", F.explode(F.when(is_hot(), every).otherwise(F.array(F.lit(0)))))
    return cut.join(repeated, [*on, "_part"], how).drop("_part")


def row_blocks(df: DataFrame, keys: list[str], position: str, width: int) -> DataFrame:
    """`df` with columns _block and _tie, written out so that both are fixed.

    Blocks are ranges of about `width` rows, ordered by keys, position and a number that tells rows
    of equal position apart; so their number follows the number of rows, however positions lie.
    """
    tied = df.withColumn("_tie", F.monotonically_increasing_id())
    parts = max(1, -(-df.count() // width))
    ranged = tied.repartitionByRange(parts, *keys, position, "_tie")
    return materialise(ranged.withColumn("_block", F.spark_partition_id()), "ranges")


def ordinal(df: DataFrame, keys: list[str], position: str, out: str, width: int = 1 << 20) -> DataFrame:
    """1-based rank by `position` within `keys`, without holding a whole group in one task.

    Rows are numbered inside blocks of about `width` rows and the counts of the blocks before are
    added; only block counts are gathered per group. Rows of equal position are numbered in some order.
    """
    tagged = row_blocks(df, keys, position, width)
    group = [*keys, "_block"]
    sizes = tagged.groupBy(*group).agg(F.count(F.lit(1)).alias("_size"))
    earlier = Window.partitionBy(*keys).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    before = sizes.select(*group, F.coalesce(F.sum("_size").over(earlier), F.lit(0)).alias("_before"))
    inside = tagged.withColumn("_inside", F.row_number().over(Window.partitionBy(*group).orderBy(position, "_tie")))
    return (
        inside.join(before, group)
        .withColumn(out, F.col("_before") + F.col("_inside"))
        .drop("_block", "_tie", "_before", "_inside")
    )


def merge_batches(batches: list[DataFrame], keys: list[str], once: str = "NAME") -> DataFrame:
    """Full outer merge of column batches; the column `once` comes from the first batch only.

    All batches are one union with a struct per batch, shuffled once by the keys, however many there
    are. A key may be NULL, and NULLs meet. A batch holds one row per key, as a request for columns of
    the same places does; one that repeats a key stops the job, and columns that two batches have are refused.
    """
    parts, names = [], []
    for i, batch in enumerate(batches):
        own = [c for c in batch.columns if c not in keys and (i == 0 or c != once)]
        if taken := set(own) & set(names):
            raise ValueError(f"columns of several batches: {sorted(taken)}")
        names += own
        parts.append(batch.select(*keys, F.struct(F.lit(i).alias("_batch"), *[F.col(f"`{c}`") for c in own]).alias(f"_{i}")))
    rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    met = [F.count(f"_{i}").alias(f"_n{i}") for i in range(len(batches))]
    merged = rows.groupBy(*keys).agg(*met, *[F.first(f"_{i}", ignorenulls=True).alias(f"_{i}") for i in range(len(batches))])
    single = F.greatest(F.lit(1), *[F.col(f"_n{i}") for i in range(len(batches))]) == 1
    told = merged.where(F.when(single, True).otherwise(F.raise_error(F.lit("a batch repeats a key")).cast("boolean")))
    cells = [F.col(f"_{i}.`{c}`").alias(c) for i, part in enumerate(parts) for c in part.schema[f"_{i}"].dataType.names[1:]]
    return told.select(*keys, *cells)


def join_state_year(a: DataFrame, b: DataFrame) -> DataFrame:
    """Inner join of state rows; both sides hold one row per state and year."""
    keys = ["state_fips", "year"]
    return a.join(b.drop(*[c for c in b.columns if c in a.columns and c not in keys]), keys, "inner")


def exists_in(df: DataFrame, other: DataFrame, key: list[str]) -> DataFrame:
    return lookup(df, other.select(*key).distinct(), key, "left_semi")


def missing_in(df: DataFrame, other: DataFrame, key: list[str]) -> DataFrame:
    return lookup(df, other.select(*key).distinct(), key, "left_anti")


# ---- unions ----------------------------------------------------------------------------

def combine_years(frames: list[DataFrame]) -> DataFrame:
    """By-name union; a column some year lacks is NULL there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def union_levels(state: DataFrame, county: DataFrame) -> DataFrame:
    return combine_years([
        state.withColumn("level", F.lit("state")),
        county.withColumn("level", F.lit("county")),
    ])


# ---- orders ----------------------------------------------------------------------------

def state_first(df: DataFrame) -> DataFrame:
    return df.orderBy((F.col("level") == "county").cast("int"), "state_fips", "county_fips")


def series_order(df: DataFrame) -> DataFrame:
    return df.orderBy("series_id", "year", "period")


def value_counts(df: DataFrame, col: str) -> DataFrame:
    """Non-null values by falling count."""
    return df.filter(F.col(col).isNotNull()).groupBy(col).count().orderBy(F.desc("count"), col)


def top_counts(df: DataFrame, col: str, k: int) -> DataFrame:
    return value_counts(df, col).limit(k)


def column_order(meta: DataFrame) -> DataFrame:
    """Position of a variable: its rank by id within table and year."""
    return ordinal(meta, ["table_id", "year"], "var_id", "position")
