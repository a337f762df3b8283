"""Cleaning of raw survey tables, end to end."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.fixed import GEO_COLUMNS, PUBLISHED_COLUMNS
from tallyloom.functions.labels import classify
from tallyloom.operators import hierarchy as H
from tallyloom.operators import naming as N
from tallyloom.operators.geography import fill_geo, geo_keys
from tallyloom.operators.relational import lookup
from tallyloom.operators.shape import TABLE_YEAR, drop_all_null, pack_names, publish_columns
from tallyloom.session import materialise, workspace
from tallyloom.sources.tables import write_cleaned


def variables_in_use(rows: DataFrame, meta: DataFrame) -> DataFrame:
    """Metadata of the variables the rows hold, with maximum and column position; estimates that
    only repeat a count as a percentage are gone.

    The one pass over the rows behind it is written out at once: what follows reads the result
    several times.
    """
    place = ["meta_position"] if "meta_position" in meta.columns else []
    known = meta.select(*TABLE_YEAR, "var_id", "label", "pe_parent", "has_parent_entry", *place)
    stats = H.variable_stats(rows).join(known, [*TABLE_YEAR, "var_id"], "inner")
    found = materialise(stats, "found")
    kind = classify(F.col("var_id"))
    held = found.filter((kind == "E") | ((kind == "PE") & F.col("has_parent_entry")))
    return materialise(N.drop_redundant_pct(held), "variables")


def _prefixes(names) -> list[str]:
    """The names and every name above them in the hierarchy."""
    cut = [name.split(" | ") for name in names]
    return sorted({" | ".join(parts[:k]) for parts in cut for k in range(1, len(parts) + 1)})


def first_pass(rows: DataFrame, variables: DataFrame, wanted: DataFrame) -> DataFrame:
    """Rows with the map `values` of the wanted variables, percentages turned into counts.

    Both kinds of percentages are decided and computed from the landed values, so one map of
    paths serves them. Variables that neither are wanted nor lie above a wanted one are dropped
    before anything is parsed.
    """
    kind = classify(F.col("var_id"))
    estimates, percentages = variables.filter(kind == "E"), variables.filter(kind == "PE")
    paths = H.parent_paths(percentages).unionByName(H.percent_paths(estimates, estimates))
    needed = paths.join(wanted, [*TABLE_YEAR, "var_id"], "left_semi")
    used = needed.select(*TABLE_YEAR, F.explode("path").alias("var_id")).unionByName(
        wanted.select(*TABLE_YEAR, "var_id")
    )
    keep = used.groupBy(*TABLE_YEAR).agg(F.collect_set("var_id").alias("keep"))
    packed = keep.join(H.pack(needed), TABLE_YEAR, "left")
    ready = lookup(rows, packed, TABLE_YEAR, measure=True)
    keep = F.coalesce("keep", F.array().cast("array<string>"))
    kept = F.map_filter("vars", lambda var, _: F.array_contains(keep, var))
    parsed = H.numbers(ready.withColumn("vars", kept))
    paths = F.coalesce("paths", F.create_map().cast("map<string,array<string>>"))
    return parsed.withColumn("values", H.converted(F.col("values"), paths)).drop("vars", "keep", "paths")


def clean_table(rows: DataFrame, meta: DataFrame, table: str) -> DataFrame:
    """Published columns of one survey table over all its years and both levels.

    `rows`: table_id, year, level, name, state, county, vars. `meta`: table_id, year, var_id,
    label, pe_parent, has_parent_entry. A column of a year that holds no value is NULL there.
    The rows are read two times, for S1811 three times: keep them in the landing table of `land_raw`,
    of which the plain filter on `table_id` reads one folder. Table ids are in upper case.
    """
    one = rows.filter(F.col("table_id") == table)
    variables = variables_in_use(one, meta.filter(F.col("table_id") == table))
    names = materialise(N.assign_names(variables), "names")
    if table.startswith("S"):
        names = N.canonical_names(names)
    published = PUBLISHED_COLUMNS[table]
    wanted = materialise(names.filter(F.col("name").isin(*_prefixes(published))), "wanted")
    values = first_pass(one, variables, wanted)
    ids = pack_names(wanted, published)
    if table.startswith("S1811"):
        late = H.pack(H.labelled_paths(values, wanted))
        ready = lookup(values, ids.join(late, TABLE_YEAR, "left"), TABLE_YEAR, measure=True)
        paths = F.coalesce("paths", F.create_map().cast("map<string,array<string>>"))
        ready = ready.withColumn("values", H.converted(F.col("values"), paths))
    else:
        ready = lookup(values, ids, TABLE_YEAR, measure=True)
    return fill_geo(publish_columns(geo_keys(ready), published, ["table_id", *GEO_COLUMNS]))


def clean_year(rows: DataFrame, meta: DataFrame, table: str, year: int) -> DataFrame:
    """One table and year without its empty columns, as a file of its own would hold it."""
    chosen = rows.filter(F.col("year") == year)
    cleaned = clean_table(chosen, meta.filter(F.col("year") == year), table)
    return drop_all_null(materialise(cleaned, "year"))


def write_table(rows: DataFrame, meta: DataFrame, table: str, path: str, **options) -> None:
    """`clean_table` written by `write_cleaned`, which takes the options; no work folder is left."""
    with workspace(rows.sparkSession):
        write_cleaned(clean_table(rows, meta, table), path, **options)


def write_year(rows: DataFrame, meta: DataFrame, table: str, year: int, path: str, **options) -> None:
    """`clean_year` written likewise."""
    with workspace(rows.sparkSession):
        write_cleaned(clean_year(rows, meta, table, year), path, **options)
