import pytest
from pyspark.sql import functions as F

from tallyloom.functions import labels as L
from tallyloom.operators import naming as N
from tallyloom.operators.shape import sanitize_columns


def column(spark, values, expression):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [r[0] for r in df.orderBy("i").select(expression(F.col("v"))).collect()]


NAMES = {
    "Estimate!!Total:": "Total",
    "Estimate!!Total:!!SEX!!Male": "SEX | Male",
    "Estimate!!Total:!!With a hearing difficulty:!!In the labor force:!!Employed":
        "With a hearing difficulty | In the labor force | Employed",
    "Estimate!!Number with a disability!!Number with a disability": "Number with a disability",
    "Estimate!!Total :!!A": "Total  | A",
    "Estimate!! Total:!!a!!A!!b": "a | b",
    "ESTIMATE": "Total",
    "": "Total",
    "Estimate!!Total:!!Total:": "Total",
    "A!!Total!!estimate!!total!!B": "A | Total | B",
}


def test_label_to_name(spark):
    assert column(spark, NAMES, L.label_to_name) == list(NAMES.values())


def test_label_chain_keeps_total(spark):
    got = column(spark, ["Estimate!!Total:!!SEX!!sex:!!Male", "Estimate", None], L.label_chain)
    assert got == [["Total", "SEX", "Male"], [], None]


def test_derived_name(spark):
    names = ["Percent with", "With percent | PERCENT", "Percentage", "Count"]
    assert column(spark, names, L.derived_name) == [
        "Number [derived] with", "With Number [derived] | Number [derived]",
        "Percentage [derived count]", "Count [derived count]",
    ]


def test_classify(spark):
    ids = ["NAME", "for", "ucgid", "B1_001EA", "B1_001MA", "B1_001PE", "B1_001PM", "B1_001M", "B1_001E", "B1_001X"]
    assert column(spark, ids, L.classify) == [None, None, None, None, None, "PE", "M", "M", "E", None]


def test_pe_parent_candidate(spark):
    ids = ["S1810_C03_059PE", "B18120_002PE", "S1810_C03_059E", "X_1PE"]
    assert column(spark, ids, L.pe_parent_candidate) == ["S1810_C01_059E", "B18120_002E", None, None]


def test_is_variable(spark):
    ids = ["S1810_C01_001E", "B18120_001PM", "NAME.1", "state", "b1_001E"]
    assert column(spark, ids, L.is_variable) == [True, True, False, False, False]


def test_canonical_s1811(spark):
    worker = "With a Disability | CLASS OF WORKER | Federal"
    done = "With a Disability | Employed Population Age 16 and Over | CLASS OF WORKER | Federal"
    names = [worker, done, "No Disability | EMPLOYMENT STATUS | Employed", "Other | INDUSTRY | X", "With a Disability | INDUSTRY"]
    assert column(spark, names, L.canon_s1811) == [
        done, done, "No Disability | Population Age 16 and Over | EMPLOYMENT STATUS | Employed",
        "Other | INDUSTRY | X", "With a Disability | INDUSTRY",
    ]


def test_canonical_s1810(spark):
    base = "Total civilian noninstitutionalized population"
    cases = {
        "Subject | SEX | Male": f"{base} | SEX | Male",
        f"Subject | {base} | SEX": f"{base} | SEX",
        "With a disability | Subject | AGE": f"With a disability | {base} | AGE",
        f"With a disability | Subject | {base} | AGE": f"With a disability | {base} | AGE",
        "RACE AND HISPANIC OR LATINO ORIGIN | One Race | White alone":
            f"{base} | RACE AND HISPANIC OR LATINO ORIGIN | White alone",
        "With a disability | SEX | Male": f"With a disability | {base} | SEX | Male",
        "With a disability | Hispanic or Latino (of any race)":
            f"With a disability | {base} | RACE AND HISPANIC OR LATINO ORIGIN | Hispanic or Latino (of any race)",
        f"With a disability | {base}": f"With a disability | {base}",
        "SEX": f"{base} | SEX",
        "Population 18 to 64 years": "Population 18 to 64 years",
    }
    assert column(spark, cases, L.canon_s1810) == list(cases.values())


def meta(spark, rows):
    return spark.createDataFrame(
        [("S1810", 2012, v, i, label) for i, (v, label) in enumerate(rows)],
        "table_id string, year int, var_id string, position int, label string",
    )


def test_assign_names(spark):
    rows = [("S1810_C01_001E", "Estimate!!Total"), ("S1810_C02_001PE", "Percent!!Total"),
            ("S1810_C02_001E", "Estimate!!Total:"), ("S1810_C03_001PE", "Percent!!Total")]
    got = {r["var_id"]: r["name"] for r in N.assign_names(meta(spark, rows)).collect()}
    assert got == {
        "S1810_C01_001E": "Total", "S1810_C02_001E": "Total (S1810_C02_001E)",
        "S1810_C02_001PE": "Number [derived] | Total", "S1810_C03_001PE": "Number [derived] | Total (S1810_C03_001PE)",
    }


def test_redundant_percentages(spark):
    rows = [("S1810_C02_001E", "percent a"), ("S1810_C03_001E", "Percent b"), ("S1810_C03_002E", "Percent c"),
            ("S1810_C03_001PE", "d"), ("S1810_C03_002PE", "e"), ("B1_001E", "percent f")]
    df = meta(spark, rows)
    assert {r["var_id"] for r in N.drop_redundant_pct(df).collect()} == {
        "S1810_C03_002E", "S1810_C03_001PE", "S1810_C03_002PE", "B1_001E"}
    assert {r["var_id"] for r in N.drop_redundant_pe(df).collect()} == {v for v, _ in rows} - {"S1810_C03_001PE"}


def test_canonical_names_leave_taken_targets(spark):
    names = spark.createDataFrame([
        ("S1811", 2012, "a", 1, "With a Disability | INDUSTRY | X"),
        ("S1811", 2012, "b", 2, "With a Disability | Employed Population Age 16 and Over | INDUSTRY | X"),
        ("S1811", 2013, "a", 1, "With a Disability | INDUSTRY | X"),
        ("B18120", 2013, "a", 1, "With a Disability | INDUSTRY | X"),
        ("S1810", 2013, "c", 3, "Subject | SEX"), ("S1810", 2013, "d", 4, "SEX"),
    ], "table_id string, year int, var_id string, position int, name string")
    base = "Total civilian noninstitutionalized population | SEX"
    got = {(r["table_id"], r["year"], r["var_id"]): r["name"] for r in N.canonical_names(names).collect()}
    assert got[("S1811", 2012, "a")] == "With a Disability | INDUSTRY | X"
    assert got[("S1811", 2013, "a")] == "With a Disability | Employed Population Age 16 and Over | INDUSTRY | X"
    assert got[("B18120", 2013, "a")] == "With a Disability | INDUSTRY | X"
    assert got[("S1810", 2013, "c")] == base and got[("S1810", 2013, "d")] == "SEX"


@pytest.mark.parametrize("name, safe", [
    ("With a hearing difficulty | Employed", "with_a_hearing_difficulty_employed"),
    ("18 to 64", "n_18_to_64"), ("%%", "unknown"), ("__A >> b(1)__", "a_b_1"), ("x" * 400, "x" * 300),
])
def test_sanitize_name(spark, name, safe):
    assert column(spark, [name], L.sanitize_name) == [safe]


def test_sanitize_columns_numbers_repeats(spark):
    df = spark.createDataFrame([(1, 2, 3, 4)], ["a b", "a|b", "a_b_1", "A b"])
    assert sanitize_columns(df).columns == ["a_b", "a_b_2", "a_b_1", "a_b_3"]
