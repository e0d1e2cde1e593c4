"""Columns of any name and type, empty tables and long runs of letters, through the pipeline."""

import datetime
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from ratebook.llm import quality_rules, toxicity
from ratebook.llm.queries import fold

FOLDER = "/root/testdata/sf0.001"
DAY = datetime.datetime(2024, 1, 2, 3, 4, 5)


@pytest.fixture(scope="module")
def wide(spark):
    """Documents, some odd ones, with columns that operators use themselves or have types of their own."""
    given = spark.read.parquet(f"{FOLDER}/documents.parquet")
    odd = [(None, None), (7, ""), (None, "x " * 70), (-1, "ha" * 30_000)]
    rows = [(i, t, "en", "s", len(t or "")) for i, t in odd]
    both = given.union(spark.createDataFrame(rows, given.schema))
    return both.withColumns(
        {
            "score": F.lit("mine"),
            "key": F.lit(1),
            "kept": F.lit(True),
            "predicted": F.lit(2.5),
            "place": F.lit(None).cast("int"),
            "at": F.lit(DAY),
            "tags": F.array(F.lit("a"), F.lit(None)),
            "more": F.struct(F.lit(1).alias("n"), F.lit("b").alias("m")),
        }
    )


@pytest.mark.parametrize("name,stage", corpus_pipeline.STAGES[:-1])
def test_stages_keep_all_columns(spark, wide, name, stage):
    out = stage(spark, wide, FOLDER)
    assert out.dtypes == wide.dtypes
    rows = out.collect()
    assert 100 < len(rows) <= wide.count()
    assert {(r["score"], r["key"], r["kept"], r["at"]) for r in rows} == {("mine", 1, True, DAY)}
    assert {(tuple(r["tags"]), tuple(r["more"])) for r in rows} == {(("a", None), (1, "b"))}
    assert any(r["doc_id"] is None for r in rows)


@pytest.mark.parametrize("name,stage", corpus_pipeline.STAGES)
def test_stages_of_an_empty_table(spark, wide, name, stage):
    assert stage(spark, wide.limit(0), FOLDER).count() == 0


def test_packing_stage_with_other_columns(spark, wide):
    packed = corpus_pipeline.pack_sequences(spark, wide, FOLDER)
    assert packed.select("doc_id").distinct().count() == wide.select("doc_id").distinct().count()


def test_long_runs_of_letters_are_read_in_time():
    channel = toxicity.Channel(np.ones(28**3))
    run = "abcde" * 20_000 + "fff" + "ghi" * 10_000
    began = time.process_time()
    assert len(channel.restore(run)) in (len(run) - 1, len(run) - 2)
    assert len(channel.restore("z" * 200_000 + " 1" * 50_000)) > 0
    assert time.process_time() - began < 30


def test_many_rows_of_one_labelled_id(spark):
    """The fits bring one row of an id to the driver."""
    texts = spark.range(30_000).selectExpr(
        "cast(id % 2 AS bigint) AS doc_id", "concat('some words ', id % 50, ' that idiot') AS text"
    )
    labels = spark.createDataFrame([(0, 0, 0), (1, 1, 1)], "doc_id long, quality int, toxic int")
    assert toxicity.toxicity(texts, labels, fold(5) == 9).count() == 30_000
    assert quality_rules.quality(texts, labels).count() == 30_000
