"""Percent-to-count conversion along label hierarchies.

Rows hold one geography with its variables as a map. What to convert, and along which path of
variables, is worked out on the metadata from maxima that one aggregation over the rows
delivers; the rows themselves are converted by a projection, so they are never shuffled.

A path runs from a variable whose value is used as it is down to the converted one. Converting
in column order, one column after the other, gives the same numbers: a parent that is converted
earlier enters with its converted value, and one that comes later enters raw and starts the path.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.functions.labels import label_chain, let
from tallyloom.functions.numbers import PERCENT_LIMIT, census_number, percent_of
from tallyloom.operators.relational import lookup
from tallyloom.session import materialise

TABLE_YEAR = ["table_id", "year"]
_LEVEL_STEP = 1 << 20


def variable_stats(rows: DataFrame) -> DataFrame:
    """Maximum, and place in the header with the state file before the county file, per variable."""
    place = F.when(F.col("level") == "state", F.lit(0)).otherwise(F.lit(_LEVEL_STEP))
    cells = rows.select(*TABLE_YEAR, place.alias("_place"), F.posexplode("vars").alias("_pos", "var_id", "_text"))
    return cells.groupBy(*TABLE_YEAR, "var_id").agg(
        F.max(census_number(F.col("_text"))).alias("top"),
        F.min(F.col("_place") + F.col("_pos")).alias("position"),
    )


def percent_columns(cells: DataFrame, limit: float = PERCENT_LIMIT) -> DataFrame:
    """Columns that may hold percentages: no value above the limit. An empty column passes."""
    tops = cells.groupBy(*TABLE_YEAR, "var_id").agg(F.max("value").alias("top"))
    return tops.withColumn("is_percent", F.coalesce(F.col("top") <= limit, F.lit(True)))


def _ancestors(chains: DataFrame) -> DataFrame:
    """One row per variable and each proper prefix of its chain that is a variable's chain.

    `chains`: table_id, year, var_id, position, chain. The last variable of equal chains counts.
    """
    owners = chains.groupBy(*TABLE_YEAR, F.col("chain").alias("prefix")).agg(
        F.max_by("var_id", "position").alias("owner"), F.max("position").alias("owner_position")
    )
    deep = chains.filter(F.size("chain") > 1).select(
        *TABLE_YEAR, "var_id", "position", "chain",
        F.explode(F.sequence(F.lit(1), F.size("chain") - 1)).alias("depth"),
    )
    prefixes = deep.withColumn("prefix", F.slice("chain", F.lit(1), F.col("depth"))).drop("chain")
    found = lookup(prefixes, owners, [*TABLE_YEAR, "prefix"], "inner", spread_by=["var_id"])
    return found.drop("prefix")


def _chains(meta: DataFrame) -> DataFrame:
    return meta.select(*TABLE_YEAR, "var_id", "position", label_chain(F.col("label")).alias("chain"))


def nearest_parent(meta: DataFrame) -> DataFrame:
    """Variable whose chain is the longest proper prefix of a variable's chain."""
    return _ancestors(_chains(meta)).groupBy(*TABLE_YEAR, "var_id").agg(
        F.max_by("owner", "depth").alias("parent")
    )


def percent_paths(meta: DataFrame, tops: DataFrame) -> DataFrame:
    """Paths of the estimates that hold percentages, all decided from their values before any
    conversion. `tops`: table_id, year, var_id, top."""
    links = _ancestors(_chains(meta))
    low = tops.filter(F.col("top").isNull() | (F.col("top") <= PERCENT_LIMIT))
    converted = links.select(*TABLE_YEAR, "var_id").distinct().join(
        low.select(*TABLE_YEAR, "var_id"), [*TABLE_YEAR, "var_id"], "left_semi"
    )
    owners = converted.select(*TABLE_YEAR, F.col("var_id").alias("owner"), F.lit(True).alias("owner_converted"))
    marked = lookup(
        links.join(converted, [*TABLE_YEAR, "var_id"], "left_semi"),
        owners, [*TABLE_YEAR, "owner"], spread_by=["var_id"],
    )
    node = F.struct(
        (-F.col("depth")).alias("order"), "owner", "owner_position",
        F.coalesce("owner_converted", F.lit(False)).alias("open"),
    )
    # A chain has a handful of levels, so the list of a variable's ancestors is short.
    grouped = marked.groupBy(*TABLE_YEAR, "var_id", "position").agg(F.sort_array(F.collect_list(node)).alias("nodes"))

    def climb(state: Column, n: Column) -> Column:
        further = n["open"] & (n["owner_position"] < state["place"])
        return F.when(
            state["open"],
            F.struct(
                F.concat(F.array(n["owner"]), state["path"]).alias("path"),
                n["owner_position"].alias("place"),
                further.alias("open"),
            ),
        ).otherwise(state)

    start = F.struct(
        F.array("var_id").alias("path"), F.col("position").alias("place"), F.lit(True).alias("open")
    )
    return grouped.select(*TABLE_YEAR, "var_id", F.aggregate("nodes", start, climb, lambda s: s["path"]).alias("path"))


def _product(line: Column) -> Column:
    """Count behind a line of values: a count first, then percentages of what comes before."""
    rest = F.slice(line, F.lit(2), F.greatest(F.size(line) - 1, F.lit(0)))
    return F.aggregate(rest, F.element_at(line, 1), lambda acc, percent: percent_of(percent, acc))


def _along(values: Column, path: Column) -> Column:
    return F.transform(path, lambda var: F.try_element_at(values, var))


def pack(paths: DataFrame) -> DataFrame:
    """Paths of a table and year as one map; a table has some hundred variables."""
    return paths.groupBy(*TABLE_YEAR).agg(
        F.map_from_entries(F.collect_list(F.struct("var_id", "path"))).alias("paths")
    )


def converted(values: Column, paths: Column) -> Column:
    """The map `values` with every variable that has a path folded along it."""
    def cell(var: Column, value: Column) -> Column:
        return let(
            F.try_element_at(paths, var),
            lambda path: F.when(path.isNull(), value).otherwise(let(_along(values, path), _product)),
        )

    return F.transform_values(values, cell)


def convert(rows: DataFrame, paths: DataFrame) -> DataFrame:
    """Rows with the map `values` converted along the paths."""
    ready = lookup(rows, pack(paths), TABLE_YEAR, measure=True)
    return ready.withColumn("values", converted(F.col("values"), F.col("paths"))).drop("paths")


def numbers(rows: DataFrame) -> DataFrame:
    """Rows with `vars` parsed into the map `values`."""
    return rows.withColumn("values", F.transform_values("vars", lambda _, text: census_number(text)))


def parent_paths(parents: DataFrame) -> DataFrame:
    """Paths of percentages below their denominators: table_id, year, var_id, pe_parent.

    A missing denominator leads nowhere, and so to NULL.
    """
    parent = F.coalesce("pe_parent", F.lit(""))
    return parents.select(*TABLE_YEAR, "var_id", F.array(parent, F.col("var_id")).alias("path"))


def pe_to_count(rows: DataFrame, parents: DataFrame) -> DataFrame:
    """Percentages times their denominators; NULL without one."""
    return convert(rows, parent_paths(parents))


def percent_to_count(rows: DataFrame, meta: DataFrame, tops: DataFrame | None = None) -> DataFrame:
    """First pass, on variable labels."""
    if tops is None:
        tops = value_tops(rows)
    return convert(rows, percent_paths(meta, tops))


def value_tops(rows: DataFrame) -> DataFrame:
    cells = rows.select(*TABLE_YEAR, F.explode("values").alias("var_id", "value"))
    return cells.groupBy(*TABLE_YEAR, "var_id").agg(F.max("value").alias("top"))


def labelled_paths(rows: DataFrame, names: DataFrame) -> DataFrame:
    """Paths of the second pass, whose decisions depend on columns converted before.

    `names`: table_id, year, var_id, position, name. Whatever is decided, a column's value is a
    product along its ancestors from some first one on. One aggregation finds the maximum for
    every possible first one; walking each chain from its root then tells which is in force.
    A column without children matters only by its own values, so for it one maximum is enough.
    """
    chains = names.select(
        *TABLE_YEAR, "var_id", "position", F.split(F.col("name"), r" \| ").alias("chain")
    )
    node = F.struct("depth", F.col("owner").alias("var_id"), F.col("owner_position").alias("position"))
    links = materialise(_ancestors(chains), "links")
    above = links.groupBy(*TABLE_YEAR, "var_id").agg(F.sort_array(F.collect_list(node)).alias("above"))
    parents = links.select(*TABLE_YEAR, F.col("owner").alias("var_id"), F.lit(True).alias("is_parent")).distinct()
    known = chains.join(above, [*TABLE_YEAR, "var_id"], "left").join(parents, [*TABLE_YEAR, "var_id"], "left")
    lines = known.select(
        *TABLE_YEAR, "var_id", F.coalesce("is_parent", F.lit(False)).alias("is_parent"),
        F.concat(
            F.coalesce(F.transform("above", lambda n: F.struct(n["var_id"], n["position"])),
                       F.array().cast("array<struct<var_id:string,position:bigint>>")),
            F.array(F.struct("var_id", F.col("position").cast("bigint").alias("position"))),
        ).alias("line"),
    )

    path = F.transform("line", lambda n: n["var_id"])
    paths = lines.select(
        *TABLE_YEAR, "var_id",
        F.when(F.col("is_parent"), path).otherwise(F.array("var_id")).alias("path"),
        F.when(F.col("is_parent"), 0).otherwise(F.size("line") - 1).alias("offset"),
    )
    packed = paths.groupBy(*TABLE_YEAR).agg(F.collect_list(F.struct("var_id", "path", "offset")).alias("all"))
    ready = lookup(rows.select(*TABLE_YEAR, "values"), packed, TABLE_YEAR, "inner", measure=True)

    def from_every_first(line: Column) -> Column:
        return let(
            _along(F.col("values"), line["path"]),
            lambda held: F.transform(
                held,
                lambda _, first: F.struct(
                    line["var_id"].alias("var_id"), (first + line["offset"]).alias("first"),
                    _product(F.slice(held, first + 1, F.size(held))).alias("value"),
                ),
            ),
        )

    # Folded inside the row, so that the map is not copied for every variable.
    cells = ready.select(*TABLE_YEAR, F.inline(F.flatten(F.transform("all", from_every_first))))
    tops = cells.groupBy(*TABLE_YEAR, "var_id", "first").agg(F.max("value").alias("top"))
    by_variable = tops.groupBy(*TABLE_YEAR, F.col("var_id").alias("node")).agg(
        F.map_from_entries(F.collect_list(F.struct("first", "top"))).alias("tops")
    )

    nodes = lines.select(*TABLE_YEAR, "var_id", F.posexplode("line").alias("place", "n")).select(
        *TABLE_YEAR, "var_id", "place", F.col("n.var_id").alias("node"), F.col("n.position").alias("position")
    )
    weighted = lookup(nodes, by_variable, [*TABLE_YEAR, "node"], spread_by=["var_id"])
    gathered = weighted.groupBy(*TABLE_YEAR, "var_id").agg(
        F.sort_array(F.collect_list(F.struct("place", "node", "position"))).alias("line"),
        F.map_from_entries(F.collect_list(F.struct("place", "tops"))).alias("tops"),
    )

    def top_of(place: Column, first: Column) -> Column:
        return F.try_element_at(F.try_element_at("tops", place), first)

    def walk(state: Column, n: Column) -> Column:
        place = n["place"]
        first = F.when(state["position"] > n["position"], place - 1).otherwise(state["first"])
        own, parent = top_of(place, place), top_of(place - 1, first)
        convert_it = F.coalesce((place > 0) & (own <= PERCENT_LIMIT) & (parent > PERCENT_LIMIT), F.lit(False))
        return F.struct(
            F.when(convert_it, first).otherwise(place).cast("int").alias("first"),
            n["position"].alias("position"),
        )

    start = F.struct(F.lit(0).alias("first"), F.lit(-1).cast("bigint").alias("position"))
    decided = gathered.withColumn("first", F.aggregate("line", start, walk, lambda s: s["first"]))
    return decided.filter(F.col("first") < F.size("line") - 1).select(
        *TABLE_YEAR, "var_id",
        F.transform(
            F.slice("line", F.col("first") + 1, F.size("line")), lambda n: n["node"]
        ).alias("path"),
    )


def labelled_percent_to_count(rows: DataFrame, names: DataFrame) -> DataFrame:
    """Second pass, on canonical names."""
    return convert(rows, labelled_paths(rows, names))
