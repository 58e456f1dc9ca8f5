"""What the first stage leaves on disk: compressed records, no shuffle files of finished writes, no shuffled headers."""

import gzip

import pytest
from pyspark.sql import functions as F

from tenderlens import schema as S
from tenderlens import sources
from tenderlens.catalog import stage_one
from tenderlens.catalog.views import raw_contracts
from tenderlens.plans import run_stage1

from conftest import rows
from test_cleaning import write_orders
from test_csv_records import rows_shuffled, written

CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shuffle_files(spark):
    manager = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    files = manager.getAllFiles()
    names = [files.apply(i).getName() for i in range(files.size())]
    return {name for name in names if name.startswith("shuffle_")}


@pytest.fixture
def tables(spark, tmp_path):
    write_orders(spark, tmp_path)
    return str(tmp_path)


def test_records_land_compressed_and_whole(spark, tables, monkeypatch):
    monkeypatch.setattr(sources, "shared_folder", lambda _: f"{tables}/shared")
    got = stage_one.stage1_pipeline(spark, tables)
    found = spark.read.format("binaryFile").load(f"{tables}/shared/raw").select("path")
    assert found.count() > 0 and found.where(~F.col("path").endswith(".csv.gz")).count() == 0
    sources.write_raw_csv(raw_contracts(spark, tables).select(*S.RAW_COLUMNS), f"{tables}/plain")
    expected = run_stage1(spark, f"{tables}/plain", f"{tables}/clean").clean
    assert got.dtypes == expected.dtypes and got.count() == 5
    assert sorted(map(str, rows(got))) == sorted(map(str, rows(expected)))


def test_landed_files_are_small_enough_for_a_task(spark, tables, monkeypatch):
    monkeypatch.setattr(sources, "shared_folder", lambda _: f"{tables}/shared")
    monkeypatch.setitem(stage_one.LANDED, "maxRecordsPerFile", 2)
    assert stage_one.stage1_pipeline(spark, tables).count() == 5
    records = spark.read.option("header", True).csv(f"{tables}/shared/raw").groupBy(F.input_file_name()).count()
    assert records.agg(F.max("count")).first()[0] == 2
    assert records.agg(F.sum("count")).first()[0] == raw_contracts(spark, tables).count()


@pytest.mark.parametrize("before", [None, "false", "true"])
def test_writes_leave_no_shuffle_files(spark, tables, before):
    if before is not None:
        spark.conf.set(CLEANUP, before)
    kept = spark.conf.get(CLEANUP, None)
    try:
        earlier = shuffle_files(spark)
        result = stage_one.stage1_pipeline(spark, tables)
        assert shuffle_files(spark) <= earlier
        assert spark.conf.get(CLEANUP, None) == kept
        assert result.count() == 5
    finally:
        spark.conf.unset(CLEANUP)


def test_setting_comes_back_after_a_failure(spark, tmp_path):
    kept = spark.conf.get(CLEANUP, None)
    with pytest.raises(ZeroDivisionError), sources.shuffles_removed(spark):
        assert spark.conf.get(CLEANUP) == "true"
        1 / 0
    assert spark.conf.get(CLEANUP, None) == kept


def test_headers_of_many_files_shuffle_no_lines(spark, tmp_path):
    for i in range(5):
        (tmp_path / f"{i}.csv").write_text("a,b\n" + "".join(f"{i},{n}\n" for n in range(20)))
    got = sources.read_raw_csv(spark, str(tmp_path))
    assert sorted(map(tuple, got.collect())) == sorted((str(i), str(n)) for i in range(5) for n in range(20))
    assert sum(rows_shuffled(got._jdf.queryExecution().executedPlan())) == 0


def test_quotes_are_counted_once(spark, tmp_path):
    (tmp_path / "a.csv").write_text('a,b\n1,"x\ny"\n2,z\n')
    got = sources.read_raw_csv(spark, str(tmp_path / "a.csv"))
    assert sorted(map(tuple, got.collect())) == [("1", "x\ny"), ("2", "z")]
    plan = got._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    # The count, the lines that are records, and those of the other chunks with and without their texts.
    assert plan.count("FileScan text") <= 4


@pytest.mark.parametrize("seed, end", [(7, "\n"), (8, "\r\n")])
def test_compressed_files_give_the_same_rows(spark, tmp_path, seed, end):
    for name in ("plain", "packed"):
        (tmp_path / name).mkdir()
    for i in range(3):
        written(tmp_path / "plain" / f"{i}.csv", seed + i, end)
        (tmp_path / "packed" / f"{i}.csv.gz").write_bytes(gzip.compress((tmp_path / "plain" / f"{i}.csv").read_bytes()))
    plain, packed = (sources.read_raw_csv(spark, str(tmp_path / name)) for name in ("plain", "packed"))
    assert packed.count() == 3 * 151
    assert sorted(map(repr, packed.collect())) == sorted(map(repr, plain.collect()))
