"""The stages one after the other, and the whole on the smallest tables."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tallyloom import session
from tallyloom.llm import quality
from tallyloom.llm.common import stored
from tests.llm.conftest import prose


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """Clean prose, shouted junk, near copies, a passage that many share, and odd rows."""
    target = tmp_path_factory.mktemp("corpus")
    clean = [(i, prose(i, 120), "xx") for i in range(60)]
    junk = [(100 + i, " ".join(w.upper() + "!!" for w in prose(100 + i, 80).split()), "xx") for i in range(30)]
    near = [(200, clean[0][1] + " more", "xx"), (201, clean[0][1], "xx")]
    passage = prose(999, 60)
    shared = [(300 + i, prose(300 + i, 50) + " " + passage + " " + prose(400 + i, 50), "xx") for i in range(6)]
    odd = [(500, None, None), (501, "", "xx"), (502, "12 34 !!", None), (None, prose(77, 90), None)]
    docs = spark.createDataFrame(clean + junk + near + shared + odd, "doc_id long, text string, lang string")
    docs = docs.withColumn("source", F.lit("s")).withColumn("n_chars", F.length("text").cast("long")).withColumn("key", F.lit(7)).withColumn("score", F.lit("a"))
    docs.write.parquet(f"{target}/documents.parquet")
    labels = [(i, int(i < 100), 0) for i in [*range(60), *range(100, 130)]]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{target}/labels.parquet")
    return str(target), passage


def test_stages(spark, folder):
    path, passage = folder
    docs = spark.read.parquet(f"{path}/documents.parquet")
    left = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stored(stage(spark, docs, path), "stage")
        assert after.columns == docs.columns and after.dtypes == docs.dtypes
        docs, left[name] = after, {r.doc_id for r in after.select("doc_id").collect()}
    assert not any(i is not None and 100 <= i < 130 for i in left["quality"]) and set(range(60)) <= left["quality"]
    assert not {500, 501, 502} & left["language"] and set(range(60)) <= left["language"] and None in left["language"]
    assert not {200, 201} & left["near_duplicates"] and set(range(60)) <= left["near_duplicates"]
    texts = {r.doc_id: r for r in docs.collect()}
    assert all(passage not in r.text and r.n_chars == len(r.text) for r in texts.values())
    assert texts[300].text == prose(300, 50) + " " + prose(400, 50) and texts[5].text == prose(5, 120)
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, path).collect()
    assert {r.doc_id for r in pieces} == left["repeats"] and sum(r.length for r in pieces if r.doc_id == 5) > 100


def test_run_equals_the_stages(spark, folder):
    path, _ = folder
    rows = corpus_pipeline.run(spark, path).select("doc_id", "start", "length", "ids_crc32")
    docs = spark.read.parquet(f"{path}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES:
        docs = stored(stage(spark, docs, path), "stage")
    assert [s for s in ("quality", "language", "near_duplicates", "repeats") if any(f"pipeline-{s}-" in p and session.exists(spark, p) for p in session._MADE)] == ["repeats"]
    key = F.concat_ws(",", "doc_id", "start")
    assert rows.groupBy("doc_id").agg(F.sum("length")).exceptAll(docs.groupBy("doc_id").agg(F.sum("length"))).isEmpty()
    assert rows.select(key).distinct().count() == rows.count()


def test_stages_of_nothing(spark, folder):
    path, _ = folder
    nothing = spark.read.parquet(f"{path}/documents.parquet").where("false")
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, nothing, path).collect() == []


def test_nobody_is_rejected_without_labels(spark, folder, tmp_path):
    path, _ = folder
    docs = spark.read.parquet(f"{path}/documents.parquet")
    spark.read.parquet(f"{path}/labels.parquet").where("false").write.parquet(f"{tmp_path}/labels.parquet")
    assert corpus_pipeline.good_quality(spark, docs, str(tmp_path)).count() == docs.count()
    assert quality.THRESHOLD < 0.5
