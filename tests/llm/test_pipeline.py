"""The pipeline's stages on the smallest tables, each against what its operator decided on the same input."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

import corpus_pipeline as P
from tamiz.llm import linededup, minhash, mixing, toxicity

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def staged(spark, tmp_path_factory):
    out, docs = [], P.documents(spark, SF)
    for name, stage in P.STAGES:
        path = str(tmp_path_factory.mktemp("stage") / name)
        stage(spark, docs, SF).write.parquet(path)
        after = spark.read.parquet(path)
        out.append((name, docs, after))
        docs = after
    return {name: (before, after) for name, before, after in out}


def ids(df):
    return Counter(r[0] for r in df.select("doc_id").collect())


def test_stages(staged):
    assert list(staged) == ["toxicity", "line_dedup", "near_dedup", "source_mix", "packing"]
    assert all(after.columns == P.COLUMNS for name, (_, after) in staged.items() if name != "packing")


def test_only_toxic_documents_go(spark, staged):
    before, after = staged["toxicity"]
    scores = toxicity.scored(before, spark.read.parquet(f"{SF}/labels.parquet"))
    assert ids(after) == ids(scores.where("predicted = 0")) and sum(ids(after).values()) > 0.8 * before.count()


def test_lines(staged):
    before, after = staged["line_dedup"]
    want = {r.doc_id: r.text for r in linededup.deduplicated(before).collect()}
    assert {r.doc_id: r.text for r in after.collect()} == want
    assert after.where(F.col("n_chars") > F.char_length("text")).count() <= before.where(F.col("n_chars") > F.char_length("text")).count()


def test_one_document_of_a_group_stays(staged):
    before, after = staged["near_dedup"]
    assert ids(after) == ids(minhash.near_duplicates(before).where("kept"))
    assert after.count() < before.count() and minhash.near_duplicates(after).where("not kept").isEmpty()


def test_mix(staged):
    before, after = staged["source_mix"]
    copies = {r.doc_id: r.copies for r in mixing.mixed(before, [1, 2, 3]).collect()}
    assert ids(after) == Counter({d: c for d, c in copies.items() if c})


def test_packing(staged):
    before, after = staged["packing"]
    assert Counter(after.where("piece = 0").select("doc_id").toPandas()["doc_id"]) == ids(before)
    assert after.groupBy("sequence_id").agg(F.sum("length").alias("n")).where("n > 1024").isEmpty()


def test_stages_take_empty_tables_and_nulls(spark):
    kind = "doc_id long, text string, lang string, source string, n_chars long"
    rows = [(None, None, None, None, None), (1, None, "en", "a", None), (2, "", "en", None, 0), (3, "some words here", None, "a", 15), (3, "some words here", None, "a", 15), (4, "x " * 3000, "en", "b", 6000)]
    for docs in (spark.createDataFrame([], kind), spark.createDataFrame(rows, kind).withColumn("copies", F.lit(1))):
        for name, stage in P.STAGES[:-1]:
            out = stage(spark, docs, SF)
            assert out.columns == P.COLUMNS
            assert name == "source_mix" or {r[0] for r in out.select("doc_id").collect()} == {r[0] for r in docs.select("doc_id").collect()}
        assert P.packing(spark, docs, SF).where("piece = 0").count() == docs.count()


def test_run(spark):
    assert P.run(spark, SF).count() > 0
