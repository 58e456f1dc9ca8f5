"""What executors and their Python workers hold at once: rows of a batch, remembered words, worker processes."""

from collections.abc import Iterator

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline as pipeline
from tenderlens.llm import language_model, packing
from tenderlens.llm.common import small_batches

LIMIT = "spark.sql.execution.arrow.maxRecordsPerBatch"


@pytest.fixture
def default_limit(spark):
    before = spark.conf.get(LIMIT)
    spark.conf.unset(LIMIT)
    yield
    spark.conf.set(LIMIT, before)


def _largest_batch(spark):
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield pa.array([len(batch)] * len(batch), pa.int64())

    rows = spark.range(0, 5000, 1, 1).select(F.arrow_udf(run, "bigint")("id").alias("n"))
    return rows.agg(F.max("n")).first()[0]


@pytest.mark.parametrize("stage", [stage for _, stage in pipeline.STAGES], ids=[name for name, _ in pipeline.STAGES])
def test_stages_bound_the_rows_of_a_batch(spark, default_limit, stage):
    assert _largest_batch(spark) == 5000
    docs = spark.createDataFrame([(1, "one text of a few words", "en", "web", 23)],
                                 "doc_id bigint, text string, lang string, source string, n_chars bigint")
    assert stage(spark, docs, "").count() == 1
    assert _largest_batch(spark) == 1000


@pytest.mark.parametrize(("given", "stays"), [("100", "100"), ("1000", "1000"), ("20000", "1000"), ("0", "1000")])
def test_a_lower_limit_stays(spark, default_limit, given, stays):
    spark.conf.set(LIMIT, given)
    small_batches(spark)
    assert spark.conf.get(LIMIT) == stays


def test_remembered_pieces_are_few_and_change_nothing():
    counts = [("a", " ab", 9), ("a", "ab ", 9), ("b", " xy", 9), ("b", "xy ", 9)]
    model, forgetful = language_model.fit_counts(counts), language_model.fit_counts(counts)
    forgetful.remember = 10
    for at in range(0, 100_000, 5_000):
        text = " ".join(f"ab{i}xy" for i in range(at, at + 5_000))
        ours, theirs = (m.path(m.look_up([text])[0]) for m in (model, forgetful))
        assert (ours[0] == theirs[0]).all() and (ours[1] == theirs[1]).all()
        assert len(model._index) <= 35_000


def test_the_plan_of_packing_starts_no_other_workers(spark, tmp_path):
    pieces = spark.range(40).select("id", (F.col("id") % 7 + 1).alias("length"))
    pieces.write.parquet(str(tmp_path / "pieces"))
    placed = packing.assign(spark.read.parquet(str(tmp_path / "pieces")), 8)
    plan = placed._jdf.queryExecution().executedPlan().toString()
    assert "LocalTableScan" in plan and "ExistingRDD" not in plan
    assert placed.count() == 40
