import pytest
from pyspark.sql import functions as F

from tallyloom.operators import catalogue as C
from tallyloom.operators import quality as Q
from tallyloom.operators import relational as R
from tallyloom.operators.naming import pe_parent


@pytest.fixture()
def skewed(spark):
    """A third of the rows hold one key, a few hold none."""
    key = F.when(F.col("id") % 3 == 0, 0).when(F.col("id") % 50 == 1, None).otherwise(F.col("id") % 40)
    facts = spark.range(3000).withColumn("k", key)
    table = spark.range(0, 60, 2).select(F.col("id").alias("k"), (F.col("id") * 10).alias("v"))
    return facts, table


@pytest.mark.parametrize("bound, one", [(1 << 20, True), (0, False)])
def test_small_tables_are_written_by_one_job(spark, monkeypatch, bound, one):
    from tallyloom import session

    monkeypatch.setattr(session, "SMALL_INPUT", bound)
    few, group = session.materialise(spark.range(100), "few"), f"written-{bound}"
    counted = few.groupBy((F.col("id") % 7).alias("k")).count().join(few, F.col("k") == F.col("id")).groupBy("count").agg(F.sum("id").alias("n"))
    spark.sparkContext.setJobGroup(group, "")
    try:
        written = session.materialise(counted, "written")
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert (len(spark.sparkContext.statusTracker().getJobIdsForGroup(group)) == 1) == one
    assert {(r["count"], r["n"]) for r in written.collect()} == {(15, 1), (14, 20)}
    assert spark.conf.get("spark.sql.adaptive.enabled") == "true"



@pytest.mark.parametrize("how", ["left", "inner", "left_semi", "left_anti"])
@pytest.mark.parametrize("way", ["hot keys", "nothing hot", "broadcast", "too heavy", "narrower key"])
def test_lookup(spark, skewed, monkeypatch, how, way):
    facts, table = skewed
    monkeypatch.setattr(R, "SMALL_FACTS", -1)  # the few rows here stand for many
    if way == "narrower key":
        table = table.withColumn("k", F.col("k").cast("int"))
    if way == "nothing hot":
        monkeypatch.setattr(R, "HOT_SHARE", 0.9)
    want = sorted(map(str, facts.join(table, ["k"], how).collect()))
    if way == "too heavy":
        monkeypatch.setattr(R, "BROADCAST_BYTES", 0)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = R.lookup(facts, table, ["k"], how, measure=way in ("broadcast", "too heavy"))
        plan = joined._jdf.queryExecution().sparkPlan().toString()
        got = sorted(map(str, joined.collect()))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert got == want
    assert ("BroadcastHashJoin" in plan) == (way == "broadcast")
    assert ("_part" in plan) == (way in ("hot keys", "too heavy", "narrower key"))


def test_hot_keys(spark, skewed):
    facts, _ = skewed
    hot, parts = R.hot_keys(facts, ["k"])
    assert spark.range(1).select(F.xxhash64(F.lit(0).cast("bigint"))).first()[0] in hot
    assert parts == 2  # a third of four partitions
    assert R.hot_keys(spark.range(5000).withColumnRenamed("id", "k"), ["k"]) == ([], 1)


@pytest.mark.parametrize("kind", ["bigint", "string"])
def test_ordinal(spark, kind):
    position = F.col("id") * 7 % 2003 if kind == "bigint" else F.sha2(F.col("id").cast("string"), 256)
    df = spark.range(2003).select(F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("g"), F.col("id") % 5)).alias("g"),
                                  position.alias("p"))
    rows = df.collect()
    want, seen = {}, {}
    for r in sorted(rows, key=lambda r: (r["g"], r["p"])):
        seen[r["g"]] = seen.get(r["g"], 0) + 1
        want[(r["g"], r["p"])] = seen[r["g"]]
    got = {(r["g"], r["p"]): r["n"] for r in R.ordinal(df, ["g"], "p", "n", width=100).collect()}
    assert got == want


@pytest.mark.parametrize("position", ["id", "id * (1L << 40)", "7L", "cast(id % 3 as string)"])
def test_blocks_follow_the_rows(spark, position):
    """Dense, sparse and equal positions take as many blocks."""
    df = spark.range(2000).selectExpr("'g' as g", f"{position} as p")
    blocks = R.row_blocks(df, ["g"], "p", 200).groupBy("_block").count().collect()
    assert 5 <= len(blocks) <= 10 and max(r["count"] for r in blocks) <= 800
    ranks = [r["n"] for r in R.ordinal(df, ["g"], "p", "n", width=200).orderBy("p", "n").collect()]
    assert ranks == list(range(1, 2001))


def test_orders(spark):
    """Rows come in the promised order, not only in some order."""
    states = spark.createDataFrame([("county", "01", "003"), ("state", "02", ""), ("state", "01", ""), ("county", "01", "001")], "level string, state_fips string, county_fips string")
    got = [tuple(r) for r in R.state_first(states).collect()]
    assert got == [("state", "01", ""), ("state", "02", ""), ("county", "01", "001"), ("county", "01", "003")]
    series = spark.createDataFrame([("B", 2012, "M01"), ("A", 2013, "M02"), ("A", 2012, "M02"), ("A", 2013, "M01")], "series_id string, year int, period string")
    got = [tuple(r) for r in R.series_order(series).collect()]
    assert got == sorted(got)
    counted = [r["count"] for r in R.value_counts(spark.createDataFrame([(x,) for x in "abacab"], "v string"), "v").collect()]
    assert counted == [3, 2, 1]


def test_merge_batches_keeps_name_of_first(spark):
    a = spark.createDataFrame([("A", "01", "1")], "NAME string, state string, x string")
    b = spark.createDataFrame([("ignored", "01", "2"), ("ignored", "02", "3")], "NAME string, state string, y string")
    got = {r["state"]: (r["NAME"], r["x"], r["y"]) for r in R.merge_batches([a, b], ["state"]).collect()}
    assert got == {"01": ("A", "1", "2"), "02": (None, None, "3")}


def test_catalogue_edits(spark):
    rows = [
        ("LNU01", "(unadj) a", "M", None, 0), ("LNU02", "(unadj) b", "A", None, 0), ("LNU03", "(unadj) c", "M", "U", 1),
        ("LNS11", "(sadj) a", "M", "S", 0), ("LNS19", "(sadj) x", "M", "S", 2), ("LNS18", "(sadj) y", "M", "S", None),
    ]
    old = spark.createDataFrame(rows, "series_id string, title string, periodicity string, seasonal string, disa_code int")
    added = {r["series_id"]: r for r in C.add_adjusted(old).collect()}
    assert set(added) == {r[0] for r in rows} | {"LNS13"}
    assert added["LNS13"]["title"] == "(sadj) c" and added["LNS13"]["seasonal"] == "S"
    assert added["LNU01"]["seasonal"] == "U"
    repaired = {r["series_id"]: r for r in C.repair_adjusted(old).collect()}
    assert set(repaired) == {"LNU01", "LNU02", "LNU03", "LNS11", "LNS18", "LNS12"}
    assert repaired["LNU02"]["periodicity"] == "M" and repaired["LNS12"]["periodicity"] == "M"
    report = {r["change"]: r["n"] for r in C.change_report(old, C.repair_adjusted(old), "series_id").collect()}
    assert report == {"added": 1, "removed": 1, "changed": 1, "equal": 4}


def test_profile(spark):
    df = spark.createDataFrame(
        [("f", "01", 2012, 1.0, "x"), ("f", "01", 2012, 1.0, "x"), ("f", "", 2013, None, "-5"), ("f", None, 2014, -2.0, "")],
        "file string, fips string, year int, v double, t string")
    columns = {r["column"]: r for r in Q.profile_columns(df, ["file"]).collect()}
    assert columns["fips"]["null_count"] == 2 and columns["fips"]["min"] == 1.0 and columns["fips"]["unique_count"] == 1
    assert columns["v"]["negative_count"] == 1 and columns["v"]["mean"] == 0.0 and columns["v"]["null_pct"] == 25.0
    assert columns["t"]["min"] == -5.0 and columns["t"]["unique_count"] == 2
    whole = Q.profile_file(df, ["file"]).first()
    assert (whole["row_count"], whole["duplicate_rows"], whole["missing_fips"], whole["total_nulls"]) == (4, 1, 2, 4)
    assert (whole["year_min"], whole["year_max"], whole["column_count"]) == (2012, 2014, 4)
    flags = Q.quality_flags(Q.profile_columns(df, ["file"]), ["file"], Q.profile_file(df, ["file"])).first()
    assert flags["negative_cols"] == "v; t" and flags["high_null_cols"] == "" and flags["status"] == "WARN"
    assert Q.duplicate_rows(df).first()["duplicate_rows"] == 1


def test_work_folders_go_with_their_workspace(spark):
    from tallyloom.session import materialise, weighed, work_folder, workspace

    kept = materialise(spark.range(10), "kept")
    with workspace(spark):
        rows, size = weighed(spark.range(100000), "gone")
        assert rows.count() == 100000 and size >= 100000
        path = rows.inputFiles()[0]
        work_folder(spark, "never written")
    assert kept.count() == 10
    import os
    assert not os.path.exists(path.removeprefix("file://"))


def test_a_workspace_hands_what_it_keeps_to_the_one_around(spark):
    from tallyloom import session

    with session.workspace(spark):
        with session.workspace(spark) as kept:
            rows = session.materialise(spark.range(5), "kept")
            lost = session.materialise(spark.range(5), "lost")
            folder, gone = (df.inputFiles()[0].rsplit("/", 1)[0] for df in (rows, lost))
            kept.add(session._MADE[-2])
        assert rows.count() == 5 and not session.exists(spark, gone)
    assert not session.exists(spark, folder)


def test_ten_batches_are_one_shuffle(spark):
    batches = [spark.range(6).filter(F.col("id") != i).select(F.col("id").alias("state"), F.lit(f"n{i}").alias("NAME"), F.col("id").alias(f"v{i}")) for i in range(10)]
    merged = R.merge_batches(batches, ["state"])
    assert merged._jdf.queryExecution().executedPlan().toString().count("Exchange") == 1
    got = {r["state"]: tuple(r)[1:] for r in merged.collect()}
    assert got == {k: (None if k == 0 else "n0", *[None if k == i else k for i in range(10)]) for k in range(6)}


def test_merged_batches_refuse_what_they_cannot_place(spark):
    a = spark.createDataFrame([(None, 1), ("x", 2)], "state string, v int")
    b = spark.createDataFrame([(None, 3), (None, 4)], "state string, w int")
    with pytest.raises(Exception, match="repeats a key"):
        R.merge_batches([a, b], ["state"]).collect()
    with pytest.raises(ValueError, match="several batches"):
        R.merge_batches([a, a], ["state"])
    got = {r["state"]: (r["v"], r["w"]) for r in R.merge_batches([a, b.limit(1)], ["state"]).collect()}
    assert got == {None: (1, 3), "x": (2, None)}


def test_upsert_folds_repeated_and_null_keys(spark):
    schema = "k string, x int, y int"
    old = spark.createDataFrame([("a", 1, 2), ("a", 3, 4), (None, 5, 6), ("z", 7, 8)], schema).coalesce(1)
    new = spark.createDataFrame([("a", None, 9), ("a", None, 10), (None, 1, None), ("q", 0, 0)], schema).coalesce(1)
    got = {r["k"]: (r["x"], r["y"]) for r in C.upsert(old, new, "k").collect()}
    assert got == {"a": (3, 10), None: (1, 6), "z": (7, 8), "q": (0, 0)}
    report = {r["change"]: r["n"] for r in C.change_report(old, new, "k").collect()}
    assert report == {"changed": 2, "added": 1, "removed": 1}
    same = {r["change"]: r["n"] for r in C.change_report(old, old, "k").collect()}
    assert same == {"equal": 3}


def test_a_table_of_repeating_files_is_not_broadcast_by_a_guess(spark, tmp_path):
    spark.range(300_000).write.parquet(str(tmp_path / "ids"))
    ids = spark.read.parquet(str(tmp_path / "ids"))
    name = F.format_string("B%09d_001", "id")
    meta = ids.select(F.lit("B18120").alias("table_id"), F.lit(2012).alias("year"),
                      F.explode(F.array(F.concat(name, F.lit("E")), F.concat(name, F.lit("PE")))).alias("var_id"))
    found = pe_parent(meta)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan
    assert found.where("pe_parent = replace(var_id, 'PE', 'E')").count() == 300_000
