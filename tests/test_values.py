import random

from pyspark.sql import functions as F

from tallyloom.functions import numbers as N
from tallyloom.functions import series as S
from tallyloom.operators import geography as G


def test_census_number(spark):
    cases = {
        "12": 12.0, " 12 ": 12.0, "1d": None, "1f": None, "abc": None, "": None, "inf": None, "nan": None,
        "-666666666": None, "-222222222.0": None, "-100000000": -1e8, "1.5e3": 1500.0, ".5": 0.5, "5.": 5.0, "1_000": None,
    }
    df = spark.createDataFrame([(k,) for k in cases], "v string")
    got = {r["v"]: r["n"] for r in df.select("v", N.census_number(F.col("v")).alias("n")).collect()}
    assert got == cases


def test_round_even_equals_python(spark):
    rnd = random.Random(3)
    values = [rnd.choice([rnd.random() * 1e6, rnd.randrange(10**6) / 20, rnd.gauss(0, 1)]) for _ in range(3000)]
    values += [0.25, 0.35, 0.45, 2.5, -0.25, 1e12 + 0.05]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    for row in df.select("v", N.round_even(F.col("v"), 1).alias("r")).collect():
        assert row["r"] == round(row["v"], 1), row


def test_percent_of(spark):
    df = spark.createDataFrame([(50.0, 10.0), (50.0, 0.0), (None, 1.0), (1.0, None)], "p double, q double")
    assert [r[0] for r in df.select(N.percent_of(F.col("p"), F.col("q"))).collect()] == [5.0, None, None, None]


def test_period_to_date(spark):
    cases = [(2022, "M03", "2022-03-01"), (2022, "M13", "2022-01-01"), (2022, "Q01", "2022-01-01"),
             (2022, "Q04", "2022-10-01"), (2022, "Q05", "2022-01-01"), (2022, "A01", "2022-01-01"),
             (2022, None, "2022-01-01"), (None, "M02", "0-02-01"), (2022, "m02", "2022-01-01")]
    df = spark.createDataFrame(cases, "y int, p string, want string")
    for row in df.select("want", S.period_to_date(F.col("y"), F.col("p")).alias("got")).collect():
        assert row["got"] == row["want"]


def test_title_breakdown(spark):
    cases = [
        ("Percent employed in Service occupations, Men", 1, "Service occupations"),
        ("(x) percent employed in X,Women", 1, "X"), ("Percent employed in Y", 0, ""), ("Percent employed in Y", None, ""),
        ("Percent employed as Z", 1, ""), (None, 1, ""),
    ]
    df = spark.createDataFrame(cases, "t string, c int, want string")
    for row in df.select("want", S.title_breakdown(F.col("t"), F.col("c"), "in").alias("got")).collect():
        assert row["got"] == row["want"]


def test_nilf_subcategory(spark):
    cases = {
        "Discouraged workers": "Discouraged workers",
        "Marginally attached, reasons other than discouragement": "Other marginally attached",
        "Reasons other than discouragement": "",
        "Marginally attached": "Marginally attached",
        "Marginally attached, discouraged": "",
        "Want a job now": "Wants a job",
        "Less than a high school diploma": "Less than high school diploma",
        "High school graduates, no college": "High school graduate, no college",
        "Some college or associate degree": "Some college or associate degree",
        "Some college": "",
        "Bachelor's": "Bachelor's degree or higher",
        "Employed": "",
    }
    df = spark.createDataFrame([(k,) for k in cases], "t string")
    got = {r["t"]: r["n"] for r in df.select("t", S.nilf_subcategory(F.col("t")).alias("n")).collect()}
    assert got == cases


def test_race_and_decode(spark):
    df = spark.createDataFrame([(1, 1), (1, 0), (9, None), (None, None), (3, 2)], "r int, o int")
    got = [r[0] for r in df.select(S.race_ethnicity(F.col("r"), F.col("o"))).collect()]
    assert got == ["Hispanic or Latino", "White", "All races/ethnicities", "All races/ethnicities", "Black or African American"]
    assert [r[0] for r in df.select(S.decode(F.col("o"), {0: "zero", 1: "one"})).collect()] == ["one", "zero", None, None, None]


def test_geography(spark):
    rows = [
        ("county", "Alpha County, North", "1", "7", "1-Year", "0500000US01007", "North", "01", "Alpha County", "007", "01007"),
        ("county", "A, B, North", "12", "1234", "1-Year", "0500000US121234", "North", "12", "A, B", "1234", "121234"),
        ("county", "Solo", None, None, "1-Year", "0500000US00", "Solo", "00", "Solo", "", "00"),
        ("state", "North, but a state", "1", "9", "1-Year", "0400000US01", "North, but a state", "01", "", "", "01"),
        ("state", None, "02", None, "1-Year", "0400000US02", "", "02", "", "", "02"),
    ]
    df = spark.createDataFrame([r[:4] for r in rows], "level string, name string, state string, county string")
    got = G.geo_keys(df).select("survey_type", "geo_id", "state", "state_fips", "county", "county_fips", "fips").collect()
    assert [tuple(r) for r in got] == [r[4:] for r in rows]
