"""Summary statistics, correlation and least squares."""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.functions.significance import p_value
from tallyloom.session import materialise, workspace

QUARTILES = (0.25, 0.5, 0.75)

# Rows sorted in one task at the end of a search, and the sketch's size; its rank error is at
# most 1 / accuracy, a third of the slack left around a rank.
FINISH_ROWS = 200_000
SKETCH_ACCURACY = 100_000
SKETCH_SLACK = 3e-5
RANGES = 64  # ranges of about equal row counts that a written column is cut into


def pearson(df: DataFrame, by: list[str], x: str, y: str) -> DataFrame:
    """Pearson's r, two-sided p and number of complete pairs; r and p are NULL below three."""
    sums = df.groupBy(*by).agg(
        F.regr_count(y, x).alias("n"),
        F.regr_sxy(y, x).alias("_sxy"), F.regr_sxx(y, x).alias("_sxx"), F.regr_syy(y, x).alias("_syy"),
    )
    r = F.try_divide("_sxy", F.sqrt("_sxx") * F.sqrt("_syy"))
    bounded = F.when((F.col("n") >= 3) & r.isNotNull(), F.greatest(F.least(r, F.lit(1.0)), F.lit(-1.0)))
    return sums.withColumn("pearson_r", bounded).select(
        *by, "pearson_r", p_value(F.col("pearson_r"), F.col("n")).alias("p_value"), "n"
    )


def pearson_states(df: DataFrame, by: list[str], x: str, y: str) -> DataFrame:
    """Number, means and centred sums of the complete pairs of each group, which merge without the rows."""
    return df.groupBy(*by).agg(
        F.regr_count(y, x).alias("n"), F.regr_avgx(y, x).alias("mean_x"), F.regr_avgy(y, x).alias("mean_y"),
        F.regr_sxx(y, x).alias("sxx"), F.regr_syy(y, x).alias("syy"), F.regr_sxy(y, x).alias("sxy"),
    )


def merge_pearson(states: DataFrame, by: list[str]) -> DataFrame:
    """States of parts as states of the groups of `by`.

    Centred sums of the parts are added to what their means lie apart from the common one; raw sums of
    squares, which cancel, are never taken. One shuffle.
    """
    all_parts = Window.partitionBy(*by)
    n = F.sum("n").over(all_parts)

    def mean(c: str) -> Column:
        return F.try_divide(F.sum(F.col("n") * F.col(c)).over(all_parts), n)

    near = states.withColumns({"_x": mean("mean_x"), "_y": mean("mean_y")})
    dx, dy = F.col("mean_x") - F.col("_x"), F.col("mean_y") - F.col("_y")
    return near.groupBy(*by).agg(
        F.sum("n").alias("n"), F.any_value("_x").alias("mean_x"), F.any_value("_y").alias("mean_y"),
        F.sum(F.col("sxx") + F.col("n") * dx * dx).alias("sxx"), F.sum(F.col("syy") + F.col("n") * dy * dy).alias("syy"),
        F.sum(F.col("sxy") + F.col("n") * dx * dy).alias("sxy"),
    )


def pearson_of(states: DataFrame, by: list[str]) -> DataFrame:
    """As `pearson`, from states."""
    r = F.try_divide("sxy", F.sqrt("sxx") * F.sqrt("syy"))
    bounded = F.when((F.col("n") >= 3) & r.isNotNull(), F.greatest(F.least(r, F.lit(1.0)), F.lit(-1.0)))
    found = states.withColumn("pearson_r", bounded)
    return found.select(*by, "pearson_r", p_value(F.col("pearson_r"), F.col("n")).alias("p_value"), "n")


def fit_line(df: DataFrame, x: str, y: str, points: int = 100) -> DataFrame:
    """Least-squares line at evenly spaced places of the range of x."""
    pairs = df.filter(F.col(x).isNotNull() & F.col(y).isNotNull())
    fit = pairs.agg(
        F.regr_slope(y, x).alias("slope"), F.regr_intercept(y, x).alias("intercept"),
        F.min(x).alias("lo"), F.max(x).alias("hi"), F.count(F.lit(1)).alias("n"),
    ).filter("n >= 2")
    spots = fit.select("*", F.explode(F.sequence(F.lit(0), F.lit(points - 1))).alias("point"))
    step = (F.col("hi") - F.col("lo")) / F.lit(float(points - 1))
    place = F.when(F.col("point") == points - 1, F.col("hi")).otherwise(F.col("lo") + step * F.col("point"))
    return spots.withColumn("x", place).select("point", "x", (F.col("slope") * F.col("x") + F.col("intercept")).alias("y"))


def correlation_summary(studies: list[tuple[str, DataFrame, dict[str, str], str, str]]) -> DataFrame:
    """Stacked correlations of several studies.

    A study is (name, data, {column: label of x}, column of y, label of y). Its columns are
    unpivoted in the scan's own pass and correlated by one aggregation for all studies.
    """
    return pearson(stacked_pairs(studies), STUDY, "x", "y")


STUDY = ["analysis", "x_variable", "y_variable"]


def stacked_pairs(studies: list[tuple[str, DataFrame, dict[str, str], str, str]], keep: list[str] | None = None) -> DataFrame:
    """All pairs of all studies as rows: analysis, x_variable, y_variable, x, y and the columns to keep."""
    def long(name: str, data: DataFrame, xs: dict[str, str], y: str, y_label: str) -> DataFrame:
        pairs = [F.struct(F.lit(label).alias("x_variable"), F.col(c).cast("double").alias("x")) for c, label in xs.items()]
        return data.select(
            *(keep or []), F.lit(name).alias("analysis"), F.lit(y_label).alias("y_variable"),
            F.col(y).alias("y"), F.inline(F.array(*pairs)),
        )

    return reduce(DataFrame.unionByName, [long(*study) for study in studies])


def correlation_states(studies: list[tuple[str, DataFrame, dict[str, str], str, str]], part: str = "year") -> DataFrame:
    """States of every correlation of the studies in each part."""
    return pearson_states(stacked_pairs(studies, [part]), [*STUDY, part], "x", "y")


def _around(share: float, rows: int) -> list[float]:
    slack = max(SKETCH_SLACK, 2 / max(rows, 1))
    return [max(share - slack, 0.0), min(share + slack, 1.0)]


def order_statistics(values: DataFrame, ranks: list[int], bounds: dict[int, tuple]) -> dict[int, float]:
    """Values of column `v` at 0-based ranks, exact at any size. `bounds` holds an interval for
    every rank, of which the widest ends must be the least and the greatest value.

    One pass counts the rows around all intervals. A rank that falls on an interval's end is
    found, whatever that value's frequency; one strictly inside is looked up among the rows there
    if they are few, and otherwise gets a narrower interval from a mergeable sketch over them.
    """
    v, found, known = F.col("v"), {}, dict(bounds)
    outer = {rank: (min(b[0] for b in bounds.values()), max(b[1] for b in bounds.values())) for rank in ranks}
    while len(found) < len(ranks):
        waiting = [rank for rank in ranks if rank not in found]
        counted = values.agg(*[
            F.struct(
                F.count_if(v < low), F.count_if(v == low), F.count_if((v > low) & (v < high)),
                F.count_if((v == high) & F.lit(low != high)),
            )
            for low, high in (known[rank] for rank in waiting)
        ]).first()
        few, many = {}, {}
        for rank, (below, at_low, inside, at_high) in zip(waiting, counted):
            low, high = known[rank]
            place = rank - below - at_low
            if rank < below:
                known[rank] = outer[rank] = (outer[rank][0], low)
            elif place >= inside + at_high:
                known[rank] = outer[rank] = (high, outer[rank][1])
            elif place < 0 or place >= inside:
                found[rank] = low if place < 0 else high
            else:
                (few if inside <= FINISH_ROWS else many)[rank] = (place, inside)
                outer[rank] = (low, high)
        within = {rank: F.when((v > known[rank][0]) & (v < known[rank][1]), v) for rank in waiting}
        if few:
            lists = [F.sort_array(F.collect_list(within[rank]))[place] for rank, (place, _) in few.items()]
            found.update(zip(few, values.agg(*lists).first()))
        if many:
            sketches = [
                F.percentile_approx(within[rank], _around(place / inside, inside), SKETCH_ACCURACY)
                for rank, (place, inside) in many.items()
            ]
            known.update({rank: tuple(b) for rank, b in zip(many, values.agg(*sketches).first())})
    return found


def _range(v: Column, cuts: list[float], first: int = 0) -> Column:
    """Number of the range of a value: odd for a cut point itself, even for what lies between two."""
    if not cuts:
        return F.lit(2 * first)
    mid = len(cuts) // 2
    below, above = _range(v, cuts[:mid], first), _range(v, cuts[mid + 1:], first + mid + 1)
    return F.when(v < cuts[mid], below).when(v > cuts[mid], above).otherwise(F.lit(2 * (first + mid) + 1))


def ranked_values(values: DataFrame, ranks: list[int], cuts: list[float]) -> dict[int, float]:
    """Values of column `v` at 0-based ranks, exact at any size; `values` is read once.

    The column is written alone, a folder per range between sorted cut points and one per cut point.
    Counts of the ranges tell in which a rank lies: a frequent value fills a range of its own and is
    found at once, and no other range is read again than one that holds a rank.
    """
    by_range = materialise(values.withColumn("range", _range(F.col("v"), cuts)).hint("rebalance", "range"), "ranges", by=("range",))
    sizes = by_range.groupBy("range").agg(F.count("v").alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi"))
    found, few, many, before = {}, {}, {}, 0
    for r in sizes.sort("range").collect():  # twice the cut points at most
        places = {rank - before: rank for rank in ranks if before <= rank < before + r["n"]}
        before += r["n"]
        if r["lo"] == r["hi"]:
            found.update(dict.fromkeys(places.values(), r["lo"]))
        elif places:
            (few if r["n"] <= FINISH_ROWS else many)[r["range"]] = (places, (r["lo"], r["hi"]))
    if few:
        listed = by_range.where(F.col("range").isin(list(few))).groupBy("range").agg(F.sort_array(F.collect_list("v")).alias("v"))
        wanted = [F.when(F.col("range") == k, F.array(*[F.col("v")[p] for p in places])) for k, (places, _) in few.items()]
        for r in listed.select("range", F.coalesce(*wanted).alias("at")).collect():
            found.update(zip(few[r["range"]][0].values(), r["at"]))
    for k, (places, ends) in many.items():
        at = order_statistics(by_range.where(F.col("range") == k).select("v"), list(places), dict.fromkeys(places, ends))
        found.update({rank: at[place] for place, rank in places.items()})
    return found


def describe(df: DataFrame, col: str) -> DataFrame:
    """Count, mean, sample deviation, minimum, linear quartiles and maximum, one row.

    The rows are read twice whatever their values: for the moments and cut points, and to write the column by ranges.
    """
    values = df.select(F.col(col).cast("double").alias("v")).filter("v is not null")
    basics = {
        "count": F.count("v"), "mean": F.avg("v"), "std": F.stddev_samp("v"), "min": F.min("v"), "max": F.max("v"),
    }
    head = values.agg(
        *[expression.alias(name) for name, expression in basics.items()],
        F.percentile_approx("v", [k / RANGES for k in range(1, RANGES)], SKETCH_ACCURACY).alias("cuts"),
    ).first()
    n, quartiles = head["count"], dict.fromkeys(["q25", "q50", "q75"])
    if n:
        places = {name: (n - 1) * q for name, q in zip(quartiles, QUARTILES)}
        ranks = sorted({f(place) for place in places.values() for f in (math.floor, math.ceil)})
        with workspace(df.sparkSession):
            at = ranked_values(values, ranks, sorted(set(head["cuts"])))
        for name, place in places.items():
            low, high = at[math.floor(place)], at[math.ceil(place)]
            quartiles[name] = low + (high - low) * (place - math.floor(place))
    kinds = ", ".join(["count bigint", *[f"{c} double" for c in ("mean", "std", "min", "max", *quartiles)]])
    row = [head[name] for name in basics] + list(quartiles.values())
    return df.sparkSession.createDataFrame([tuple(row)], kinds)
