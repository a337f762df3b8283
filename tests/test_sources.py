import json
import os
import time

import pytest
from pyspark.sql import functions as F

from tallyloom.fixed import PUBLISHED_COLUMNS, SERIES_COLUMNS
from tallyloom.plans.folders import profile_folder, validate_folder, write_validation
from tallyloom.plans.series import clean_series
from tallyloom import session
from tallyloom.plans.survey import clean_table, clean_year, write_table, write_year
from tallyloom.sources import headers as H
from tallyloom.sources import raw as W
from tallyloom.sources import tables as T
from tallyloom.streaming.landing import take_new_files

COUNTY = """NAME,S1811_C02_001E,S1811_C02_002E,S1811_C02_003E,S1811_C02_004E,NAME.1,state,county
"Alpha County, North",40000,25.0,-666666666,,x,1,1
"Beta ""B"" County, Old, North",20000,50.0,10.0,,x,01,003
Gamma,0,50.0,1d,,x,01,1234
"""
STATE = """NAME,S1811_C02_001E,S1811_C02_002E,S1811_C02_003E,state
North,60000,33.3,10.0,01
"""
LABELS = {
    "S1811_C02_001E": "Estimate!!With a Disability!!Employed Population Age 16 and Over",
    "S1811_C02_002E": "Estimate!!With a Disability!!Employed Population Age 16 and Over!!INDUSTRY!!Construction",
    "S1811_C02_003E": "Estimate!!With a Disability!!INDUSTRY!!Manufacturing",
    "S1811_C02_004E": "Estimate!!With a Disability!!INDUSTRY!!Retail trade",
}


def meta_doc(year):
    return {"table_id": "S1811", "year": year, "table_type": "subject",
            "variables": {v: {"label": t, "concept": "c"} for v, t in LABELS.items()}, "pe_parents": {"X": None}}


@pytest.fixture()
def landed(tmp_path):
    for year in (2012, 2013):
        (tmp_path / f"acs_S1811_{year}_raw.csv").write_text(COUNTY)
        (tmp_path / f"acs_S1811_{year}_state_raw.csv").write_text(STATE)
        (tmp_path / f"acs_S1811_{year}_variables.json").write_text(json.dumps(meta_doc(year), indent=2))
    return tmp_path


def test_survey_end_to_end(spark, landed):
    rows = W.read_raw_acs(spark, str(landed / "acs_*_raw.csv"))
    meta = W.read_acs_meta(spark, str(landed / "*_variables.json"))
    assert rows.count() == 8 and meta.count() == 8
    cleaned = clean_table(rows, meta, "S1811")
    assert cleaned.columns[:2] == ["table_id", "year"] and len(cleaned.columns) == 10 + 44
    got = {(r["year"], r["fips"]): r for r in cleaned.collect()}
    alpha, beta, gamma, north = (got[(2012, f)] for f in ("01001", "01003", "011234", "01"))
    assert (alpha["dis_employed_total"], alpha["dis_ind_construction"], alpha["dis_ind_manufacturing"]) == (40000, 10000, None)
    assert (beta["dis_ind_construction"], beta["dis_ind_manufacturing"]) == (10000, 2000)
    assert beta["county"] == 'Beta "B" County, Old' and beta["state"] == "North"
    assert (gamma["dis_employed_total"], gamma["dis_ind_construction"]) == (0, None)
    assert north["dis_ind_construction"] == 33.3 / 100 * 60000 and north["county_fips"] == "" and north["geo_id"] == "0400000US01"
    year = clean_year(rows, meta, "S1811", 2013)
    assert [c for c in year.columns if c in PUBLISHED_COLUMNS["S1811"].values()] == [
        "dis_employed_total", "dis_ind_construction", "dis_ind_manufacturing"]


def test_written_tables_leave_no_work_folder(spark, landed):
    rows = W.read_raw_acs(spark, str(landed / "acs_*_raw.csv"))
    meta = W.read_acs_meta(spark, str(landed / "*_variables.json"))
    before = list(session._MADE)
    write_table(rows, meta, "S1811", str(landed / "all"), order=("fips",))
    write_year(rows, meta, "S1811", 2013, str(landed / "one"))
    assert session._MADE == before
    assert spark.read.parquet(str(landed / "all")).count() == 8 and spark.read.parquet(str(landed / "one")).count() == 4


def test_a_table_without_published_columns_keeps_its_rows(spark, landed):
    rows = W.read_raw_acs(spark, str(landed / "acs_S1811_2012_raw.csv")).withColumn("table_id", F.lit("B18121"))
    meta = W.read_acs_meta(spark, str(landed / "*_2012_variables.json")).withColumn("table_id", F.lit("B18121"))
    assert clean_table(rows, meta, "B18121").count() == 3


def test_stream_takes_a_file_once(spark, landed, tmp_path_factory):
    folder = tmp_path_factory.mktemp("stream")
    inbox, out = folder / "inbox", str(folder / "out")
    inbox.mkdir()

    def handle(batch):
        files = [r["file_path"] for r in batch.select("file_path").distinct().collect()]
        if files:
            W.land_raw(spark, files, out)

    for year, total in ((2012, 3), (2013, 6), (None, 6), (2013, 6)):
        if year:
            (inbox / f"acs_S1811_{year}_raw.csv").write_text(COUNTY)
        take_new_files(spark, str(inbox), str(folder / "state"), handle)
        assert spark.read.parquet(out).count() == total


def test_matrix(spark):
    df = spark.createDataFrame([('[["NAME","B18120_001E","state"],["North","60000","01"],[null,"1","02"]]',), ('[["NAME"]]',)], "p string")
    got = [r["record"] for r in W.explode_matrix(df, "p").orderBy("row_number").collect()]
    assert got == [{"NAME": "North", "B18120_001E": "60000", "state": "01"}, {"NAME": None, "B18120_001E": "1", "state": "02"}]


def test_series_response(spark):
    ok = {"status": "REQUEST_SUCCEEDED", "Results": {"series": [{"seriesID": "LNU0X", "data": [
        {"year": "2022", "period": "M01", "value": "10.5", "footnotes": [{"text": "a"}, {}, {"text": "b"}]},
        {"year": "2022", "period": "M02", "footnotes": []}]}]}}
    docs = [(json.dumps(ok),), (json.dumps({**ok, "status": "REQUEST_NOT_PROCESSED"}),), ("oops",)]
    catalogue = spark.createDataFrame([("LNU0X", "title")], "series_id string, title string")
    got = W.flatten_series(spark.createDataFrame(docs, "p string"), "p", catalogue).orderBy("period").collect()
    assert [tuple(r[c] for c in ("series_id", "series_description", "year", "period", "value", "footnotes")) for r in got] == [
        ("LNU0X", "title", "2022", "M01", "10.5", "a; b"), ("LNU0X", "title", "2022", "M02", "", "")]


def test_catalogue_layouts(spark, tmp_path):
    flat = {"series": {"A": {"title": "a", "periodicity": "M", "disa_code": 1, "orig_code": 0}}}
    old = {"_note": {"series": {"Z": "z"}}, "one": {"series": {"B": "no", "C": "no"}}, "two": {"series": {"C": "c", "B": "b"}}}
    titles = {"series": {"D": "d {x}"}}
    for name, doc in (("flat", flat), ("old", old), ("titles", titles)):
        (tmp_path / name).write_text(json.dumps(doc, indent=1))
    got = {r["series_id"]: (r["title"], r["disa_code"]) for r in W.read_catalogue(spark, str(tmp_path)).collect()}
    assert got == {"A": ("a", 1), "B": ("b", None), "C": ("c", None), "D": ("d {x}", None)}


def test_series_end_to_end(spark):
    raw = spark.createDataFrame([
        ("LNU02075630", "d", "2022", "M01", "100", ""), ("LNU02075630", "d", "2022", "M02", "101", ""),
        ("LNU02075630", "d", "2022", "A01", "999", ""), ("P1", "d", "2022", "A01", "0.2", ""),
        ("P1", "d", "2021", "A01", "50", ""), ("P2", "d", "2022", "A01", "-", ""), ("Q", "described", "2022", "Q02", "7", "n"),
    ], "series_id string, series_description string, year string, period string, value string, footnotes string")
    fields = "series_id string, title string, periodicity string, seasonal string, disa_code int, sexs_code int, " \
             "ages_code int, race_code int, orig_code int, lfst_code int, occupation_code int, indy_code int, class_code int"
    catalogue = spark.createDataFrame([
        ("LNU02075630", "Employed", "M", "U", 2, 1, 0, 0, 0, 20, 0, 0, 0),
        ("P1", "Percent employed in Service occupations, Men", "A", "U", 2, 1, 0, 0, 0, 20, 3, 0, 0),
        ("P2", "Percent employed as Self-employed workers, Men", "A", "S", 2, 1, 0, 1, 1, 77, 0, 0, 2),
    ], fields)
    df = clean_series(raw, catalogue)
    assert df.columns == SERIES_COLUMNS
    got = {(r["series_id"], r["year"], r["period"]): r for r in df.collect()}
    assert got[("P1", 2022, "A01")]["value"] == round(0.2 / 100 * 100.5, 1)
    assert got[("P1", 2021, "A01")]["value"] == 50.0
    assert got[("P1", 2022, "A01")]["occupation"] == "Service occupations" and got[("P1", 2022, "A01")]["industry"] == ""
    p2 = got[("P2", 2022, "A01")]
    assert p2["value"] is None and p2["class_of_worker"] == "Self-employed workers" and p2["labor_force_status"] is None
    assert p2["race_ethnicity"] == "Hispanic or Latino" and p2["seasonal_adjustment"] == "Seasonally adjusted"
    q = got[("Q", 2022, "Q02")]
    assert q["series_title"] == "described" and q["date"] == "2022-04-01" and q["sex"] is None
    assert q["race_ethnicity"] == "All races/ethnicities" and q["value"] == 7.0
    bare = clean_series(raw, None)
    assert bare.columns == SERIES_COLUMNS and bare.filter("sex = ''").count() == 7


def test_backlog_and_grid(spark):
    wanted = T.work_grid(spark, [2012, 2013], {"S1810": "subject"})
    landed = spark.createDataFrame([("S1810", 2012, "county"), ("S1810", 2013, "county"), ("S1810", 2013, "state")],
                                   "table_id string, year int, level string")
    assert [tuple(r) for r in T.backlog(wanted, landed).collect()] == [("S1810", 2012, "state", "state only")]
    assert T.work_grid(spark).count() == 4 * 14 * 2
    empty = landed.limit(0)
    assert {r["work"] for r in T.backlog(wanted, empty).collect()} == {"full"}


def test_sinks(spark, tmp_path):
    frames = [spark.createDataFrame([(1, "01")], ["Total | a", "fips"]), spark.createDataFrame([(2.5,)], ["new"])]
    T.ensure_database(spark, "sink_test")
    report = T.publish(frames, "sink_test.wide", str(tmp_path / "wide")).first()
    assert report["row_count"] == 2 and report["byte_count"] > 0
    again = T.publish(frames[:1], "sink_test.wide", str(tmp_path / "again")).first()
    assert again["row_count"] == 1 and spark.table("sink_test.wide").columns == ["total_a", "fips"]
    inventory = T.table_inventory(spark, "sink_test").first()
    assert (inventory["table_name"], inventory["row_count"]) == ("wide", 1) and inventory["last_loaded"] is not None


def test_dictionary_and_comments(spark):
    df = spark.createDataFrame([(2010, "01", 1.0, None), (2012, "01", None, None)], "year int, fips string, dis_employed double, other string")
    got = {r["column_name"]: (r["type"], r["first_year"], r["last_year"], r["n_years"]) for r in T.data_dictionary(df, "S1811").collect()}
    assert got == {"year": ("int", 2010, 2012, 2), "fips": ("string", 2010, 2012, 2), "dis_employed": ("double", 2010, 2010, 1), "other": ("string", None, None, 0)}
    commented = T.apply_comments(df, "S1811")
    assert commented.schema["fips"].metadata["comment"].startswith("Code of") and not commented.schema["other"].metadata


def test_files_are_read_by_their_own_header(spark, tmp_path):
    folder = tmp_path / "table_id=S1811"
    folder.mkdir()
    (folder / "2010_cleaned.csv").write_text("year,fips,dis_pop_16_plus,dis_employed\n2010,01,500,20\n")
    (folder / "2019_cleaned.csv").write_text('fips,year,pop_16_plus,dis_pop_16_plus,remark\n01,2019,900,600,"a ""b"", c"\n')
    df = T.read_cleaned(spark, str(tmp_path))
    got = {r["year"]: (r["fips"], r["table_id"], r["pop_16_plus"], r["dis_pop_16_plus"], r["dis_employed"], r["remark"]) for r in df.collect()}
    assert got == {2010: ("01", "S1811", None, 500.0, 20.0, None), 2019: ("01", "S1811", 900.0, 600.0, None, 'a "b", c')}


def test_raw_files_of_any_shape(spark, tmp_path):
    (tmp_path / "acs_S1811_2012_raw.csv").write_text(
        'state,NAME,S1811_C01_001E,NAME,county\n\n01,"Alpha ""A""\nCounty, North",5,again,001\n\n')
    (tmp_path / "acs_b18120_2013_state_raw.csv").write_text('"B18120_001E","NAME","state"\n7,North,01\n')
    rows = {r["name"]: (r["table_id"], r["year"], r["level"], r["state"], r["county"], r["vars"]) for r in W.read_raw_acs(spark, str(tmp_path)).collect()}
    assert rows == {'Alpha "A"\nCounty, North': ("S1811", 2012, "county", "01", "001", {"S1811_C01_001E": "5"}),
                    "North": ("B18120", 2013, "state", "01", None, {"B18120_001E": "7"})}
    target = str(tmp_path / "landing")
    assert W.land_raw(spark, str(tmp_path / "*.csv"), target).count() == 2
    again = W.land_raw(spark, str(tmp_path / "acs_S1811*.csv"), target)
    assert again.count() == 2
    plan = again.filter("table_id = 'S1811' and year = 2012")._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(table_id" in plan


def test_read_cleaned_tokens(spark, tmp_path):
    (tmp_path / "acs_x_cleaned.csv").write_text("fips,year,pop_total,state\n01,2012,5,NA\n02,2013,null,North\n")
    got = [tuple(r) for r in T.read_cleaned(spark, str(tmp_path)).orderBy("fips").collect()]
    assert got == [("01", 2012, 5.0, None), ("02", 2013, None, "North")]


def test_variable_columns(spark):
    df = spark.createDataFrame([(1,) * 5], ["NAME", "B18120_001E", "S1810_C01_001PE", "NAME.1", "state"])
    assert W.variable_columns(df) == ["B18120_001E", "S1810_C01_001PE"]


def test_routing(spark):
    names = ["acs_S1810_2022_cleaned.csv", "bls_cps_disability_cleaned.csv", "acs_B-1_2022.csv"]
    df = W.route_files(spark.createDataFrame([(n,) for n in names], "file_name string"))
    assert [tuple(r)[1:] for r in df.collect()] == [
        ("S1810", 2022, "acs_s1810"), (None, None, "bls_cps_disability"), (None, None, "acs_b_1")]


# headers and rejects

def test_headers_with_breaks_cases_and_blank_lines(spark, tmp_path):
    (tmp_path / "a%20b [1]{x}.csv").write_text('\n\n"two\nlines",Year,year,YEAR,,,"a ""q"", b"\n1,2,3,4,5,6,7\n')
    (tmp_path / "bom.csv").write_bytes("\ufeffx,y\r\n1,2\r\n".encode())
    (tmp_path / "open.csv").write_text('"never closed,b\n1,2\n')
    (tmp_path / "empty.csv").write_text("")
    (tmp_path / "blank.csv").write_text("\n\n\n")
    got = {k: [os.path.basename(f) for f in v] for k, v in H.file_headers(spark, str(tmp_path)).items()}
    assert got == {
        ("two\nlines", "Year", "year.1", "YEAR.2", "_c4", "_c5", 'a "q", b'): ["a%20b [1]{x}.csv"], ("x", "y"): ["bom.csv"],
        ("never closed,b",): ["open.csv"], (): ["blank.csv", "empty.csv"]}
    frame = next(f for f in H.read_by_header(spark, str(tmp_path)) if "two\nlines" in f.columns)
    assert tuple(frame.drop("_path").first()) == ("1", "2", "3", "4", "5", "6", "7", None)


def test_only_the_start_of_a_large_file_is_read(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(H, "SMALL", 1000)
    for name in ("large.csv", "larger.csv"):
        (tmp_path / name).write_text("a,b\n" + "1,2\n" * 200_000)
    (tmp_path / "small.csv").write_text("a,c\n1,2\n")
    got = {k: len(v) for k, v in H.file_headers(spark, str(tmp_path)).items()}
    assert got == {("a", "b"): 2, ("a", "c"): 1}
    taken = []

    class Batch(dict):
        def __getitem__(self, name):
            taken.append(name)
            return self

        def to_pylist(self):
            return ["a,b", "1,2"] if taken[-1] == "value" else ["f", "f"]

    def endless():
        while True:
            yield Batch()

    assert [b.to_pylist() for b in H._first_records(True)(endless())] == [[{"path": "f", "header": "a,b"}]]


def test_many_small_files(spark, tmp_path):
    for i in range(10_000):
        (tmp_path / f"acs_S1811_{i}_cleaned.csv").write_text(f"year,fips{i % 3}\n2010,01\n")
    begin = time.time()
    got = H.file_headers(spark, str(tmp_path))
    assert {k: len(v) for k, v in got.items()} == {("year", "fips0"): 3334, ("year", "fips1"): 3333, ("year", "fips2"): 3333}
    assert time.time() - begin < 120


def test_surplus_fields_are_rejected_not_lost(spark, tmp_path):
    (tmp_path / "acs_S1811_2012_raw.csv").write_text(
        'NAME,S1811_C01_001E,state,county\n"A, ""x""",5,01,001\nB,6,01,003,EXTRA\nC,7,01\n"D\nd",8,01,007,"more, yet",\nE,9,01,009,\n')
    (tmp_path / "acs_S1810_2012_raw.csv").write_text("")
    path = str(tmp_path / "*.csv")
    rows = W.read_raw_acs(spark, path)
    assert sorted(r["name"] for r in rows.collect()) == ['A, "x"', "C"]
    assert rows.count() == 2 and rows.select("state").where("county is null").collect()[0]["state"] == "01"
    lost = sorted((os.path.basename(r["file"]), r["reason"], r["record"]) for r in H.rejected_rows(spark, path).collect())
    assert lost == [("acs_S1810_2012_raw.csv", H.BROKEN, None), ("acs_S1811_2012_raw.csv", H.SURPLUS, '"D\nd",8,01,007,"more, yet",'),
                    ("acs_S1811_2012_raw.csv", H.SURPLUS, "B,6,01,003,EXTRA"), ("acs_S1811_2012_raw.csv", H.SURPLUS, "E,9,01,009,")]
    assert H.rejected_rows(spark, str(tmp_path / "acs_S1811*"), multi_line=False).count() >= 2


def test_landing_keeps_rejects_beside_it(spark, tmp_path):
    file, target = tmp_path / "acs_S1811_2012_raw.csv", str(tmp_path / "landing")
    other = tmp_path / "acs_S1811_2013_raw.csv"
    file.write_text("NAME,S1811_C01_001E\nA,5\nB,6,EXTRA\n")
    other.write_text("NAME,S1811_C01_001E\nA,5,MORE\n")
    W.land_raw(spark, str(tmp_path / "*.csv"), target)
    beside = f"{target}_rejects"
    assert sorted((r["year"], r["record"]) for r in W.read_rejects(spark, beside).collect()) == [(2012, "B,6,EXTRA"), (2013, "A,5,MORE")]
    file.write_text("NAME,S1811_C01_001E\nA,5\nB,6\n")
    assert W.land_raw(spark, str(file), target).count() == 2
    assert [(r["year"], r["record"]) for r in W.read_rejects(spark, beside).collect()] == [(2013, "A,5,MORE")]
    assert W.read_rejects(spark, str(tmp_path / "none")).collect() == []


def test_matrix_with_repeated_names_and_rejects(spark):
    texts = ['[["A","A","A.1",null],["1","2","3","4"],["5"]]', '[["A"],["1","2"]]', "oops", "[]", None, '[["A"],null]']
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, p string")
    got = [r["record"] for r in W.explode_matrix(df, "p", ["i"]).orderBy("i", "row_number").collect()]
    assert got == [{"A": "1", "A.1": "2", "A.1.1": "3", "": "4"}, {"A": "5", "A.1": None, "A.1.1": None, "": None}]
    lost = {r["i"]: r["reason"] for r in W.rejected_matrices(df, "p", ["i"]).collect()}
    assert lost == {1: H.SURPLUS, 2: "no array of rows", 3: "no header", 4: "no array of rows", 5: H.SURPLUS}


def test_responses_without_rows_are_told(spark):
    texts = ['{"status":"REQUEST_SUCCEEDED","Results":{"series":[{"seriesID":"A","data":[{"year":"2020"}]}]}}', '{"status":"REQUEST_FAILED"}',
             '{"status":"REQUEST_SUCC', "oops", None, '{"status":"REQUEST_SUCCEEDED"}', '{"status":"REQUEST_SUCCEEDED","Results":{"series":[{"seriesID":"A","data":[]}]}}', "{}"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, p string")
    got = {r["i"]: r["reason"] for r in W.rejected_responses(df, "p", ["i"]).collect()}
    assert got == {1: "failed: REQUEST_FAILED", 2: "broken", 3: "broken", 4: "broken", 5: "empty", 6: "empty", 7: "no status"}


def test_names_that_differ_in_case_only(spark, tmp_path):
    (tmp_path / "a_cleaned.csv").write_text("Year,fips,FIPS,remark,remark\n2010,01,x,NA,b\n2011,02,y,c,d,SURPLUS\n")
    (tmp_path / "b_cleaned.csv").write_text("fips,year\n03,2012\n")
    df = T.read_cleaned(spark, str(tmp_path))
    got = sorted((r["year"], r["fips"], r["FIPS.1"], r["remark"], r["remark.1"]) for r in df.collect())
    assert got == [(2010, "01", "x", None, "b"), (2012, "03", None, None, None)]


# publishing and merging

def test_a_failing_publication_leaves_the_table(spark, tmp_path):
    T.ensure_database(spark, "atomic_test")
    good = spark.createDataFrame([(1, 2010), (2, 2011)], "x int, year int")
    T.publish([good], "atomic_test.kept", str(tmp_path / "kept"), by=("year",))
    broken = good.withColumn("x", F.when(F.col("x") == 2, F.raise_error(F.lit("lost")).cast("int")).otherwise(F.col("x")))
    with pytest.raises(Exception, match="lost"):
        T.publish([broken], "atomic_test.kept", str(tmp_path / "kept"), by=("year",))
    assert sorted(tuple(r) for r in spark.table("atomic_test.kept").collect()) == [(1, 2010), (2, 2011)]
    assert len(list((tmp_path / "kept").iterdir())) == 1
    assert [t.name for t in spark.catalog.listTables("atomic_test")] == ["kept"]
    reader = spark.table("atomic_test.kept")
    report = T.publish([good.withColumn("more", F.lit("m"))], "atomic_test.kept", str(tmp_path / "kept"), by=("year",)).first()
    assert report["row_count"] == 2 and report["table_name"] == "atomic_test.kept"
    assert reader.count() == 2 and set(spark.table("atomic_test.kept").columns) == {"x", "more", "year"}
    for _ in range(2):
        T.publish([good], "atomic_test.kept", str(tmp_path / "kept"))
    assert len(list((tmp_path / "kept").iterdir())) == 2  # the version before stays


def test_a_publication_given_up_between_renames_is_mended(spark, tmp_path, monkeypatch):
    T.ensure_database(spark, "atomic_test")
    good = spark.createDataFrame([(1,)], "x int")
    T.publish([good], "atomic_test.named", str(tmp_path))
    plain = spark.sql

    def failing(text, *rest):
        if "__next RENAME TO" in text:
            raise RuntimeError("gone")
        return plain(text, *rest)

    monkeypatch.setattr(type(spark), "sql", lambda self, text, *rest, **named: failing(text, *rest))
    with pytest.raises(RuntimeError, match="gone"):
        T.publish([good.union(good)], "atomic_test.named", str(tmp_path))
    monkeypatch.undo()
    assert spark.table("atomic_test.named").count() == 1
    spark.sql("ALTER TABLE atomic_test.named RENAME TO atomic_test.named__old")
    T.publish([good.union(good)], "atomic_test.named", str(tmp_path))
    assert spark.table("atomic_test.named").count() == 2


def test_merge_rewrites_touched_folders_only(spark, tmp_path):
    path = tmp_path / "table"
    schema = "id string, x int, y int, place string"
    old = [("a", 1, 1, "01"), ("b", 2, 2, "01"), ("c", 3, 3, "02"), ("d", 4, 4, "0:3"), (None, 5, 5, "02"), ("e", 6, 6, "04")]
    assert len(T.merge_table(spark, str(path), spark.createDataFrame(old, schema), ["id"], ["place"])) == 4

    def files():
        return {f: f.stat().st_mtime_ns for f in path.rglob("*.parquet")}

    before = files()
    new = [("c", 30, None, "01"), ("d", -1, -1, "0:3"), ("d", 40, None, "01"), (None, None, 50, "02"), ("f", 7, 7, "05")]
    touched = T.merge_table(spark, str(path), spark.createDataFrame(new, schema).coalesce(1), ["id"], ["place"])
    assert {t[0] for t in touched} == {"01", "02", "0:3", "05"}
    read = spark.read.schema(schema).parquet(str(path))
    assert sorted(map(str, (tuple(r) for r in read.collect()))) == sorted(map(str, [
        ("a", 1, 1, "01"), ("b", 2, 2, "01"), ("c", 30, 3, "01"), ("d", 40, 4, "01"), (None, 5, 50, "02"), ("e", 6, 6, "04"), ("f", 7, 7, "05")]))
    after = files()
    assert {f for f in before if "place=04" in str(f)} <= {f for f in after if after[f] == before.get(f)}
    assert not [f for f in after if "0%3A3" in str(f)]  # its only row moved
    assert T.merge_table(spark, str(path), spark.createDataFrame([], schema), ["id"], ["place"]) == []


def test_validation_reports(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "acs_S1811_2010_cleaned.csv").write_text("year,fips,dis_employed\n2010,01,-5\n2010,01,-5\n2010,,7\n")
    (tmp_path / "in" / "bls_cps_cleaned.csv").write_text("year,value\n2010,1\n")
    (tmp_path / "in" / "empty_cleaned.csv").write_text("")
    write_validation(spark, str(tmp_path / "in"), str(tmp_path / "out"))
    rows = spark.read.csv(str(tmp_path / "out" / "validation_summary"), header=True).collect()
    got = {r["file"]: (r["status"], r["duplicate_rows"], r["missing_fips"], r["negative_cols"], r["error"]) for r in rows}
    assert got == {"acs_S1811_2010_cleaned.csv": ("WARN", "1", "1", "dis_employed", None), "bls_cps_cleaned.csv": ("OK", "0", None, None, None),
                   "empty_cleaned.csv": ("ERROR", None, None, None, "no header could be read")}
    detail = spark.read.csv(str(tmp_path / "out" / "validation_column_detail"), header=True)
    assert [(r["file"], r["column"], r["null_pct"]) for r in detail.orderBy("file", "position").collect()] == [
        ("acs_S1811_2010_cleaned.csv", "year", "0.0"), ("acs_S1811_2010_cleaned.csv", "fips", "33.33"), ("acs_S1811_2010_cleaned.csv", "dis_employed", "0.0"),
        ("bls_cps_cleaned.csv", "year", "0.0"), ("bls_cps_cleaned.csv", "value", "0.0")]


def test_a_small_file_is_not_cut_for_its_header(spark, tmp_path):
    for name in ("bls_a_cleaned.csv", "bls_b_cleaned.csv"):
        (tmp_path / name).write_text("series_id,value\n" + "LNU02,2503.74\n" * 40_000)
    assert {k: len(v) for k, v in H.file_headers(spark, str(tmp_path)).items()} == {("series_id", "value"): 2}
    assert {(r["file"], r["row_count"], r["status"]) for r in profile_folder(spark, str(tmp_path)).collect()} == {
        ("bls_a_cleaned.csv", 40_000, "WARN"), ("bls_b_cleaned.csv", 40_000, "WARN")}


def test_files_with_a_repeated_name_are_profiled(spark, tmp_path):
    (tmp_path / "acs_x_cleaned.csv").write_text("year,NAME,NAME\n2010,a,b\n2010,a,b\n2011,c,\n")
    detail, summary = validate_folder(spark, str(tmp_path))
    assert [tuple(r) for r in summary.select("row_count", "duplicate_rows", "total_nulls", "status").collect()] == [(3, 1, 1, "WARN")]
    assert {r["column"]: r["null_count"] for r in detail.collect()} == {"year": 0, "NAME": 0, "NAME.1": 1}
