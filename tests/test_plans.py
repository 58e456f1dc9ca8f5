"""Physical plans that large tables depend on."""

import re

import pytest
from pyspark.sql import functions as F

from tenderlens import schema as S
from tenderlens import sources
from tenderlens.catalog import views
from tenderlens.operators import charts, cleaning, describe, grouped, outliers, quality, quantiles

from conftest import rows


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("plans") / "t")
    n = 60_000
    i = F.col("id")
    # A third of the rows share one id, one modality and one amount.
    hot = i % 3 == 0
    spark.range(n).select(
        F.when(hot, "same").otherwise(i.cast("string")).alias(S.ID),
        F.when(hot, "hot").otherwise(F.concat(F.lit("m"), i % 20)).alias(S.MODALITY),
        F.when(hot, 1e6).otherwise(F.exp(10 + 8 * F.rand(5))).alias(S.AWARD),
        F.exp(10 + 8 * F.rand(6)).alias(S.PRICE),
        (i % 14).cast("double").alias(S.BIDDERS),
        (i % 400).cast("double").alias(S.DURATION_DAYS),
        (i % 2).cast("int").alias(S.OVERCOST_FLAG),
        F.lit("Cundinamarca").alias(S.REGION), F.lit("Obra").alias(S.CONTRACT_TYPE),
        F.timestamp_seconds(1.6e9 + i).cast("timestamp_ntz").alias(S.PUBLISHED),
    ).write.parquet(path)
    return spark.read.parquet(path)


def final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def scans(df):
    """File scans of the executed plan; the plan text repeats the initial plan."""
    return final_plan(df).split("== Initial Plan ==")[0].count("FileScan")


def pushed(df):
    return re.findall(r"PushedFilters: \[(.*?)\], ReadSchema: struct<(.*?)>", df._jdf.queryExecution().executedPlan().toString())


@pytest.mark.parametrize("method", ["direct", "cutoff"])
def test_extract_reads_its_columns_and_pushes_its_filters(stored, method):
    found = pushed(sources.extract_contracts(stored, columns=[S.ID, S.AWARD], method=method))
    assert len(found) == 1 or method == "cutoff"  # which prints its subquery several times
    for filters, schema in found:
        for part in (f"EqualTo({S.REGION},Cundinamarca)", f"EqualTo({S.CONTRACT_TYPE},Obra)",
                     f"GreaterThan({S.AWARD},0.0)"):
            assert part in filters
        assert S.MODALITY not in schema and S.PRICE not in schema


def test_cleaning_pushes_its_filter(stored):
    (filters, _), = pushed(cleaning.clean_contracts(stored).select(S.ID))
    assert f"GreaterThan({S.PRICE},0.0)" in filters and f"GreaterThan({S.AWARD},0.0)" in filters


def test_hot_id_is_pruned_before_the_shuffle(stored):
    kept = cleaning.dedup_keep_first(stored, S.ID, [F.col(S.PUBLISHED).desc()])
    assert kept.count() == 40_001
    assert final_plan(kept).count("WindowGroupLimit") >= 2


def test_statistics_scan_a_bounded_number_of_times(stored):
    assert scans(describe.dispersion(stored, [S.AWARD, S.PRICE], "narrow")) == 3
    assert scans(describe.central_tendency(stored, [S.AWARD, S.PRICE], "narrow")) == 2
    assert scans(quality.describe_numeric(stored, [S.AWARD, S.PRICE], "narrow")) == 3


def test_no_product_joins(stored):
    bounds = outliers.tukey_bounds(stored, S.AWARD, method="narrow")
    tables = [
        outliers.tukey_flags(stored, S.AWARD, bounds=bounds),
        outliers.tukey_summary(stored, S.AWARD, bounds=bounds),
        grouped.dispersion_by_group(stored, method="narrow"),
        grouped.competition_contrast(stored, method="narrow"),
        charts.boxplot_by_group(stored, method="narrow"),
        charts.log_histogram(stored, method="narrow"),
        charts.density_curve(stored),
    ]
    for table in tables:
        plan = final_plan(table)
        assert "NestedLoop" not in plan and "CartesianProduct" not in plan
        assert "percentile" not in plan and "Python" not in plan


def test_hot_group_statistics_are_exact(stored):
    got = {r[0]: r for r in grouped.dispersion_by_group(stored, method="narrow").collect()}
    hot = got["hot"]
    assert (hot["conteo"], hot["q1"], hot["mediana"], hot["iqr"]) == (20_000, 1e6, 1e6, 0.0)
    pdf = stored.select(S.MODALITY, S.AWARD).toPandas()
    for key, part in pdf.groupby(S.MODALITY):
        assert got[key]["q3"] == pytest.approx(part[S.AWARD].quantile(0.75), rel=1e-15)


def test_upper_fence_reaches_the_scan(stored):
    top = outliers.top_outliers(stored, S.AWARD, method="narrow")
    plan = top._jdf.queryExecution().executedPlan().toString()
    # a plain column against a plain value, which the Parquet reader can compare
    assert re.search(rf"{S.AWARD}#\d+ > Subquery", plan), plan
    assert len(rows(top)) == 10


def test_unbounded_group_keys_are_not_broadcast(stored, monkeypatch):
    monkeypatch.setattr(quantiles, "MAX_BROADCAST_GROUPS", 5)
    plan = charts.boxplot_by_group(stored, method="narrow")._jdf.queryExecution().optimizedPlan().toString()
    assert "broadcast" not in plan.lower()


def test_clean_view_is_dealt_out_by_the_number_of_lines(spark, tmp_path, monkeypatch):
    n = 4_000
    i = F.col("id")
    spark.range(n).select(
        (i % 900).alias("l_orderkey"), (i % 50).alias("l_partkey"), (i % 7).alias("l_suppkey"),
        (i % 4).cast("int").alias("l_linenumber"), (i % 9 + 1).cast("double").alias("l_quantity"),
        (100.0 + i).alias("l_extendedprice"), F.lit(0.05).alias("l_discount"), F.lit(0.02).alias("l_tax"),
        F.lit("R").alias("l_returnflag"), F.lit("F").alias("l_linestatus"),
        F.timestamp_seconds(1.6e9 + i).cast("timestamp_ntz").alias("l_shipdate"),
    ).unionByName(spark.createDataFrame([(None, 1, None, 1, 9.0, 5.0, 0.0, 0.0, "R", "F", None)] * 2, (
        "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double,"
        "l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz"))
    ).write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.range(800).selectExpr("id as o_orderkey", "case when id % 3 = 0 then '2-HIGH' end as o_orderpriority").write.parquet(
        f"{tmp_path}/orders.parquet")
    spark.range(7).selectExpr("id as s_suppkey", "concat('s', id) as s_name", "cast(id % 2 as int) as s_nationkey").write.parquet(
        f"{tmp_path}/supplier.parquet")
    spark.range(2).selectExpr("cast(id as int) as n_nationkey", "concat(' n', id) as n_name", "1 as n_regionkey").write.parquet(
        f"{tmp_path}/nation.parquet")
    expected = sorted(rows(views.clean_view(spark, str(tmp_path))), key=str)
    monkeypatch.setattr(views, "LINES_PER_TASK", 100, raising=False)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        clean = views.clean_view(spark, str(tmp_path))
        found = sorted(rows(clean), key=str)
        plan = clean._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert found == expected and len(found) == 601
    # Lines, orders and competition are dealt out in 41 parts, each once, and so joined where they are.
    dealt = re.findall(r"Exchange hashpartitioning\((\w+)#\w+, (\d+)\)", plan)
    assert {parts for key, parts in dealt if "order" in key or key == "key"} == {"41"}
