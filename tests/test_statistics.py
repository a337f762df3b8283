import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyloom.functions.significance import p_value
from tallyloom.operators import quality as Q
from tallyloom.operators import relational as R
from tallyloom.operators import statistics as S
from tallyloom.plans import folders, study
from tallyloom.session import configured
from tallyloom.sources import tables as T

# Published values: pairs, r and two-sided p.
PUBLISHED = [
    (570, 0.5249573377591007, 1.0957661399645443e-41),
    (570, 0.580941120713405, 9.487036154955216e-53),
    (570, -0.11627834828824805, 0.005445152187951544),
    (570, -0.7946361357627031, 3.2365821927566986e-125),
    (468, 0.5896320572103066, 3.68746635135952e-45),
    (468, 0.307288595709894, 1.0832522563148228e-11),
    (468, 0.6103116805910076, 4.242101529271465e-49),
    (468, 0.11584666971736848, 0.012145323649418853),
    (468, 0.07375667959253396, 0.11104695614016985),
    (468, 0.36373335148207464, 4.372526328915118e-16),
    (721, -0.26814114269134715, 2.443326367954639e-13),
    (721, -0.4103490542106535, 1.1726399124365063e-30),
    (721, -0.39662547767926387, 1.4097292986395537e-28),
]


def test_p_values_match_published(spark):
    df = spark.createDataFrame(PUBLISHED, "n bigint, r double, p double")
    for row in df.select("p", p_value(F.col("r"), F.col("n")).alias("got")).collect():
        assert row["got"] == pytest.approx(row["p"], rel=1e-11)


def test_p_value_closed_forms(spark):
    # n = 3: p = 1 - 2/pi * asin(|r|); n = 4: p = 1 - |r|.
    rs = [0.0, 1e-6, 0.1, 0.5, 0.9, 0.999999, 1.0]
    df = spark.createDataFrame([(r,) for r in rs], "r double")
    got = df.select("r", p_value(F.col("r"), F.lit(3)).alias("p3"), p_value(F.col("r"), F.lit(4)).alias("p4"),
                    p_value(F.col("r"), F.lit(2)).alias("p2")).collect()
    for row in got:
        assert row["p3"] == pytest.approx(1 - 2 / math.pi * math.asin(row["r"]), abs=1e-12)
        assert row["p4"] == pytest.approx(1 - row["r"], abs=1e-12)
        assert row["p2"] is None


def test_p_value_large_samples(spark):
    # For many pairs t is close to normal: p = erfc(|t| / sqrt 2).
    cases = [(n, t) for n in (10**6, 10**9, 10**12) for t in (0.01, 0.5, 1.0, 1.2, 1.3, 2.0, 5.0)]
    df = spark.createDataFrame([(n, t / math.sqrt(n - 2 + t * t), t) for n, t in cases], "n bigint, r double, t double")
    for row in df.select("t", p_value(F.col("r"), F.col("n")).alias("p")).collect():
        assert row["p"] == pytest.approx(math.erfc(row["t"] / math.sqrt(2)), rel=1e-4 if row["t"] < 4 else 1e-3)


def test_pearson_nulls_and_constants(spark):
    rows = [("a", float(i), 2.0 * i + (i % 3)) for i in range(20)]
    rows += [("a", None, 1.0), ("b", 1.0, 1.0), ("b", 2.0, 2.0), ("c", 1.0, 1.0), ("c", 1.0, 2.0), ("c", 1.0, 3.0)]
    got = {r["g"]: r for r in S.pearson(spark.createDataFrame(rows, "g string, x double, y double"), ["g"], "x", "y").collect()}
    assert got["a"]["n"] == 20 and got["a"]["pearson_r"] > 0.99
    assert got["b"]["n"] == 2 and got["b"]["pearson_r"] is None and got["b"]["p_value"] is None
    assert got["c"]["n"] == 3 and got["c"]["pearson_r"] is None


def test_fit_line(spark):
    df = spark.createDataFrame([(float(i), 3.0 * i + 1) for i in range(11)] + [(99.0, None)], "x double, y double")
    line = S.fit_line(df, "x", "y").orderBy("point").collect()
    assert len(line) == 100 and line[0]["x"] == 0.0 and line[-1]["x"] == 10.0
    assert line[50]["y"] == pytest.approx(3 * line[50]["x"] + 1)


@pytest.mark.parametrize("kind", ["spread", "hot", "two hot ends", "few"])
def test_describe_by_narrowing_is_exact(spark, monkeypatch, kind):
    rnd = random.Random(5)
    n = 4001
    values = {
        "spread": lambda: rnd.random() * 1e6,
        "hot": lambda: 7.0 if rnd.random() < 0.4 else rnd.gauss(0, 10),
        "two hot ends": lambda: rnd.choice([0.0, 1.0]) if rnd.random() < 0.9 else rnd.random(),
        "few": lambda: float(rnd.randrange(3)),
    }[kind]
    df = spark.createDataFrame([(values(),) for _ in range(n)] + [(None,)], "x double")
    whole = df.agg(
        F.count("x").alias("count"), F.avg("x").alias("mean"), F.stddev_samp("x").alias("std"),
        F.min("x").alias("min"), F.max("x").alias("max"), F.percentile("x", 0.25).alias("q25"),
        F.percentile("x", 0.5).alias("q50"), F.percentile("x", 0.75).alias("q75"),
    ).first().asDict()
    for finish, accuracy in ((200_000, 100_000), (60, 20)):
        monkeypatch.setattr(S, "FINISH_ROWS", finish)
        monkeypatch.setattr(S, "SKETCH_ACCURACY", accuracy)
        narrowed = S.describe(df, "x").first().asDict()
        assert narrowed.keys() == whole.keys()
        for name, value in whole.items():
            assert narrowed[name] == pytest.approx(value, rel=1e-12, abs=1e-12), (name, finish)


@pytest.mark.parametrize("finish", [200_000, 50])
def test_describe_reads_the_rows_twice(spark, monkeypatch, finish):
    monkeypatch.setattr(S, "FINISH_ROWS", finish)
    monkeypatch.setattr(S, "SKETCH_ACCURACY", 20)
    read = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            read.add(len(batch))
            yield batch

    df = spark.range(6000).select(F.when(F.col("id") % 3 == 0, 5.0).otherwise(F.sqrt("id")).alias("x"))
    found = S.describe(df.mapInPandas(counted, "x double"), "x").first()
    assert read.value == 2 * 6000
    want = df.agg(F.percentile("x", F.array(*map(F.lit, S.QUARTILES)))).first()[0]
    assert [found["q25"], found["q50"], found["q75"]] == pytest.approx(list(want), rel=1e-12)


def test_describe_leaves_no_folder(spark):
    from tallyloom import session

    before = list(session._MADE)
    S.describe(spark.range(100).select(F.col("id").alias("x")), "x").collect()
    assert session._MADE == before


def test_describe_empty(spark):
    row = S.describe(spark.createDataFrame([(None,)], "x double"), "x").first()
    assert row["count"] == 0 and row["q50"] is None and row["min"] is None


def test_states_merge_to_the_same_profile(spark):
    df = spark.range(5000).select(
        (F.col("id") % 7).alias("part"), F.when(F.col("id") % 3 == 0, "g").alias("g"), F.when(F.col("id") % 5 != 0, (F.col("id") % 40) - 3).alias("few"),
        F.concat(F.lit("t"), F.col("id").cast("string")).alias("many"), F.lit(None).cast("string").alias("none"))
    states = Q.column_states(df, ["g", "part"], few=50)
    assert {r["column"]: r["exact"] for r in states.groupBy("column").agg(F.every(F.col("distinct_count").isNotNull()).alias("exact")).collect()} == {
        "few": True, "many": False, "none": True}
    for by, merged in ((["g", "part"], states), (["g"], Q.merge_states(states, ["g"]))):
        rest = df.drop(*{"part"} - set(by))
        exact = {tuple(r[c] for c in (*by, "column")): r for r in Q.profile_columns(rest, by).collect()}
        got = Q.profile_states(merged, by).collect()
        assert len(got) == len(exact)
        for r in got:
            e = exact[tuple(r[c] for c in (*by, "column"))]
            assert all(r[c] == e[c] for c in ("dtype", "null_count", "null_pct", "min", "max", "negative_count", "mean"))
            assert abs(r["unique_count"] - e["unique_count"]) <= (0 if r["unique_exact"] else 0.03 * e["unique_count"])


def test_a_new_file_is_the_only_one_read(spark, tmp_path, monkeypatch):
    read, plain = [], folders.read_by_header
    monkeypatch.setattr(folders, "read_by_header", lambda s, files, headers: read.append(sorted(f.rsplit("/")[-1] for f in files)) or plain(s, files, headers=headers))
    source, store = tmp_path / "in", str(tmp_path / "states")
    source.mkdir()
    for i in range(3):
        (source / f"acs_S1811_201{i} x_cleaned.csv").write_text(f"year,fips\n201{i},01\n201{i},0{i}\n")
    assert folders.refresh_profiles(spark, str(source), store).count() == 6
    (source / "bls_cps_cleaned.csv").write_text("year,value\n2010,-1\n")
    states = folders.refresh_profiles(spark, str(source), store)
    assert states.count() == 8 and folders.refresh_profiles(spark, str(source), store).count() == 8
    assert read[1:] == [["bls_cps_cleaned.csv"]] and len(read[0]) == 3
    (source / "acs_S1811_2010 x_cleaned.csv").write_text("year\n2015\n")
    (source / "acs_S1811_2011 x_cleaned.csv").unlink()
    states = folders.refresh_profiles(spark, str(source), store)
    years = Q.profile_states(Q.merge_states(states.where("column = 'year'"), []), []).first()
    assert states.count() == 5 and read[2:] == [["acs_S1811_2010 x_cleaned.csv"]]
    assert (years["min"], years["max"], years["unique_count"], years["null_count"]) == (2010, 2015, 3, 0)


def test_correlations_from_states(spark):
    df = spark.range(4000).select(
        (F.col("id") % 9).alias("year"), F.when(F.col("id") % 11 != 0, F.sin(F.col("id")) * 1e-3 + 1e6).alias("x"),
        (F.cos(F.col("id") * 0.7) * 1e-3 + F.sin(F.col("id")) * 1e-3 - 1e6 + F.when(F.col("id") % 9 == 8, None).otherwise(0)).alias("y"), F.lit("s").alias("study"))
    exact = S.pearson(df, ["study"], "x", "y").first()
    states = S.pearson_states(df, ["study", "year"], "x", "y")
    got = S.pearson_of(S.merge_pearson(states, ["study"]), ["study"]).first()
    rows = [(r["x"], r["y"]) for r in df.collect() if r["x"] is not None and r["y"] is not None]
    x, y = np.array(rows, np.longdouble).T
    x, y = x - x.mean(), y - y.mean()
    want = float((x * y).sum() / np.sqrt((x * x).sum() * (y * y).sum()))
    assert got["n"] == exact["n"] == len(rows) and abs(got["pearson_r"] - want) < 1e-6 and abs(got["pearson_r"] - exact["pearson_r"]) < 1e-6
    flat = df.withColumns({"x": F.col("x") - 1e6, "y": F.col("y") + 1e6})
    a = S.pearson(flat, ["study"], "x", "y").first()
    b = S.pearson_of(S.merge_pearson(S.pearson_states(flat, ["study", "year"], "x", "y"), ["study"]), ["study"]).first()
    assert abs(a["pearson_r"] - b["pearson_r"]) < 1e-12 and abs(a["p_value"] - b["p_value"]) < 1e-9
    assert S.merge_pearson(states.where("year = 8"), ["study"]).first()["n"] == 0


def test_a_new_year_reads_one_year(spark, tmp_path):
    columns = ["dis_edu_pop_25_plus", *[c for c, _ in study.EDUCATION.values()], "dis_employed_total", "dis_pop_16_plus", *study.TYPES, "dis_pop_total", "pop_total", "dis_employed"]
    rows = spark.range(300).select(
        F.lit("state").alias("level"), F.concat(F.lit("N"), F.col("id") % 50).alias("state"), (F.col("id") % 50).cast("string").alias("state_fips"),
        (2010 + F.col("id") % 6).cast("int").alias("year"), *[(1000 + F.pmod(F.xxhash64("id", F.lit(c)), F.lit(500))).cast("double").alias(c) for c in columns])
    rows.write.partitionBy("year").parquet(str(tmp_path / "rows"))
    df = spark.read.parquet(str(tmp_path / "rows"))
    store = str(tmp_path / "states")
    study.refresh_states(store, list(range(2010, 2015)), df, df, df)
    states = study.refresh_states(store, [2015], df, df, df)
    a, b = ({(r["analysis"], r["x_variable"]): r for r in s.collect()} for s in (study.summary(df, df, df), study.summary_of(states)))
    assert len(a) == 13 and all(abs(a[k]["pearson_r"] - b[k]["pearson_r"]) < 1e-12 and a[k]["n"] == b[k]["n"] for k in a)
    plan = S.correlation_states(study.studies(*[df.where(F.col("year").isin([2015]))] * 3))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("PartitionFilters: [isnotnull(year") >= 1 and "(year#" in plan


def test_counts_come_from_footers(spark, tmp_path):
    path = str(tmp_path / "table")
    spark.range(1000).select(F.col("id"), F.when(F.col("id") % 4 == 0, F.col("id")).alias("v"), (2000 + F.col("id") % 3).alias("year")).write.partitionBy("year").parquet(path)
    with configured(spark, T._from_footers(spark)):
        counted = spark.read.parquet(path).groupBy("year").agg(F.count(F.lit(1)), F.count("v"))
        plan = counted._jdf.queryExecution().executedPlan().toString()
    assert "PushedAggregation: [COUNT(*), COUNT(v)]" in plan
    got = {r["year"]: (r["row_count"], r["v"]) for r in T.footer_counts(spark, path, ["year"], ["v"]).collect()}
    assert got == {2000: (334, 84), 2001: (333, 83), 2002: (333, 83)}
    assert T.footer_counts(spark, path).first()["row_count"] == 1000
    found = {r["column"]: (r["first_year"], r["last_year"], r["value_count"]) for r in T.availability_of(spark, path, ["v"]).collect()}
    assert found == {"v": (2000, 2002, 250)}


def test_colocated_tables_are_joined_without_a_shuffle(spark, tmp_path):
    T.ensure_database(spark, "bucket_test")
    for name, add in (("a", 0), ("b", 500)):
        df = spark.range(1000).select((F.col("id") % 100).cast("string").alias("state_fips"), (2000 + F.floor(F.col("id") / 100)).alias("year"), (F.col("id") + add).alias(name))
        T.write_colocated(df, f"bucket_test.{name}", str(tmp_path / name), buckets=4)
    with configured(spark, {"spark.sql.autoBroadcastJoinThreshold": "-1"}):
        joined = R.join_state_year(spark.table("bucket_test.a"), spark.table("bucket_test.b"))
        assert "Exchange" not in joined._jdf.queryExecution().executedPlan().toString()
        assert joined.where("b = a + 500").count() == 1000
