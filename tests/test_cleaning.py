"""Cleaning, features and quality reports on small tables with known results."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tenderlens import schema as S
from tenderlens.catalog import views
from tenderlens.operators import cleaning, features, quality

from conftest import rows


@pytest.fixture
def duplicated(spark):
    data = [
        ("A1", 1e6, 1.2e6, "2023-01-01"), ("A2", 2e6, 1.9e6, "2023-01-02"),
        ("A2", 2e6, 1.9e6, "2023-01-02"), ("A3", 0.0, 5e5, "2023-01-03"),
        ("A4", -500.0, 1e5, "2023-01-04"),
    ]
    return spark.createDataFrame(data, f"{S.ID} string, {S.PRICE} double, {S.AWARD} double, {S.PUBLISHED} string")


def test_clean_and_report(duplicated):
    clean = cleaning.clean_contracts(duplicated)
    assert sorted(r[S.ID] for r in clean.collect()) == ["A1", "A2"]
    assert dict(clean.dtypes)[S.PUBLISHED] == "timestamp_ntz"
    assert rows(quality.quality_report(duplicated)) == [(5, 2, 2, 1, 40.0)]
    assert rows(quality.quality_balance(duplicated, clean)) == [(5, 2, 2, 1, 40.0)]


def test_invalid_first_copy_does_not_hide_a_valid_one(spark):
    table = spark.createDataFrame(
        [("A", None, "5", "2024-01-02"), ("A", "$ 7", "8", "2024-01-01"), (None, "1", "1", "x"),
         (None, "2", "2", "2024-01-01")],
        f"{S.ID} string, {S.PRICE} string, {S.AWARD} string, {S.PUBLISHED} string",
    )
    kept = cleaning.clean_contracts(table).orderBy(F.col(S.ID).asc_nulls_first()).collect()
    assert [(r[S.ID], r[S.PRICE]) for r in kept] == [(None, 2.0), ("A", 7.0)]
    for counted_table in (table, cleaning.cast_money(table)):
        assert tuple(quality.quality_report(counted_table).first())[:4] == (4, 2, 1, 1)


def test_nan_is_no_valid_amount(spark):
    table = spark.createDataFrame(
        [("a", float("nan"), 1.0), ("b", 1.0, float("nan")), ("c", 1.0, 1.0)],
        f"{S.ID} string, {S.PRICE} double, {S.AWARD} double",
    )
    assert [r[0] for r in cleaning.valid_money_filter(table).collect()] == ["c"]
    assert rows(quality.quality_report(table)) == [(3, 1, 2, 0, 33.33)]


def test_first_follows_the_given_order(spark):
    table = spark.createDataFrame([(1, "b", 5), (1, "a", 9), (2, "c", 1)], "id int, x string, n int")
    kept = cleaning.dedup_keep_first(table, "id", [F.col("n").desc()])
    assert sorted(rows(kept)) == [(1, "a", 9), (2, "c", 1)]
    assert cleaning.dedup_keep_first(table, "none", []) is table


def test_dedup_prunes_before_the_shuffle(spark):
    table = spark.range(1000).select((F.col("id") % 10).alias("k"), "id")
    plan = cleaning.dedup_keep_first(table, "k", [F.col("id")])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def test_missing_money_column(spark):
    with pytest.raises(ValueError, match=S.AWARD):
        cleaning.clean_contracts(spark.createDataFrame([(1.0,)], f"{S.PRICE} double"))


def test_empty_report(duplicated):
    assert rows(quality.quality_report(duplicated.limit(0))) == [(0, 0, 0, 0, 0.0)]
    assert quality.retention(duplicated.limit(0), duplicated.limit(0)).first()["tasa_retencion_pct"] is None


def test_retention_rounds_the_binary_value(spark):
    # 66.665 as a double lies above the tie, so it rounds up.
    assert spark.range(1).select(quality.two_decimals(F.lit(66.665).cast("double"))).first()[0] == round(66.665, 2)


def test_trim_keeps_null(spark):
    table = spark.createDataFrame([("  Obra\t", None)], f"{S.CONTRACT_TYPE} string, {S.STATUS} string")
    assert rows(cleaning.trim_categories(table)) == [("Obra", None)]


def test_features(spark):
    table = spark.createDataFrame(
        [(100.0, 120.0, 2, "Mes(es)"), (200.0, 180.0, 30, "día(s)"), (150.0, 150.0, 1, "Año(s)"),
         (0.0, 10.0, None, "x"), (None, 10.0, 4, None), (10.0, None, 4, None)],
        f"{S.PRICE} double, {S.AWARD} double, {S.DURATION} int, {S.DURATION_UNIT} string",
    )
    got = features.add_features(table).select(
        S.OVERCOST, S.OVERCOST_RATIO, S.OVERCOST_FLAG, S.DURATION_DAYS
    )
    assert rows(got) == [
        (20.0, 0.2, 1, 60.0), (-20.0, -0.1, 0, 30.0), (0.0, 0.0, 0, 365.0),
        (10.0, 0.0, 1, None), (None, 0.0, 0, 4.0), (None, None, 0, 4.0),
    ]


def test_duration_without_unit_or_at_all(spark):
    table = spark.createDataFrame([("7",), ("x",)], f"{S.DURATION} string")
    assert [r[S.DURATION_DAYS] for r in features.add_duration_days(table).collect()] == [7.0, None]
    bare = spark.range(1)
    assert features.add_duration_days(bare) is bare


def test_profiles(spark):
    table = spark.createDataFrame([(1.0, "a"), (None, "b"), (None, None)], "x double, y string")
    assert rows(quality.null_counts(table)) == [("x", 2), ("y", 1)]
    assert rows(quality.column_profile(table)) == [
        ("x", "double", 1, 2, 66.67), ("y", "string", 2, 1, 33.33)
    ]


def test_overcost_rate(spark):
    table = spark.createDataFrame([(1,), (0,), (0,), (0,)], f"{S.OVERCOST_FLAG} int")
    assert rows(quality.overcost_rate(table)) == [(4, 1, 25.0)]


def test_dates_already_typed_are_kept(spark):
    table = spark.createDataFrame([(dt.datetime(2024, 1, 1),)], f"{S.PUBLISHED} timestamp_ntz")
    assert rows(cleaning.parse_dates(table)) == [(dt.datetime(2024, 1, 1),)]


def test_dedup_within_columns_that_follow_from_the_id(spark):
    lines = [(k, line, n) for k in (1, 2, 3, None) for line in (1, 2, None) for n in (5, 7, 6 + (k or 0))]
    table = spark.createDataFrame(lines, "k long, line int, n int").withColumn("id", F.concat("k", F.lit("-"), "line"))
    order = [F.col("n").desc()]
    plain = cleaning.dedup_keep_first(table, "id", order)
    within = cleaning.dedup_keep_first(table.repartition(4, "k"), "id", order, within=["k"])
    assert sorted(map(str, rows(within.select("id", "n")))) == sorted(map(str, rows(plain.select("id", "n"))))
    assert within.count() == 7  # six ids and one row without
    known = table.where("id is not null")
    assert cleaning.dedup_keep_first(known, "id", order, within=["k"]).count() == 6


def write_orders(spark, path):
    """Order tables with repeated ids, missing keys, and orders, suppliers and nations that come twice."""
    one = dt.datetime(2024, 1, 1)
    keys = [(1, 1), (1, 1), (1, 2), (2, 1), (2, None), (1, None), (3, None), (None, 1), (4, 1), (4, 1)]
    lines = [(o, 5 + i, 1 + i % 3, n, 5.0 + i % 2, 100.0 + i, 0.0, 0.01, "RAN"[i % 3], "FO"[i % 2], one + dt.timedelta(days=i % 4))
             for i, (o, n) in enumerate(keys)]
    spark.createDataFrame(lines, "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, "
                          "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, "
                          "l_linestatus string, l_shipdate timestamp_ntz").write.parquet(f"{path}/lineitem.parquet")
    for name, found, kind in (
        ("orders", [(1, "1-URGENT"), (1, "1-URGENT"), (2, None), (4, "2-HIGH")], "o_orderkey long, o_orderpriority string"),
        ("supplier", [(1, "a ", 1), (1, "a ", 1), (2, "b", 7)], "s_suppkey long, s_name string, s_nationkey int"),
        ("nation", [(1, "x", 1), (1, "x", 1)], "n_nationkey int, n_name string, n_regionkey int"),
    ):
        spark.createDataFrame(found, kind).write.parquet(f"{path}/{name}.parquet")


def test_clean_view_looks_up_after_the_choice_of_the_first_copy(spark, tmp_path):
    write_orders(spark, tmp_path)
    raw = views.raw_contracts(spark, str(tmp_path))
    expected = cleaning.clean_contracts(raw, order=views.dedup_order()).select(*S.RAW_COLUMNS)
    got = views.clean_view(spark, str(tmp_path))
    assert sorted(map(str, rows(got.select(*S.RAW_COLUMNS)))) == sorted(map(str, rows(expected)))
    assert got.count() == 5
    plan = got._jdf.queryExecution().executedPlan().toString()
    # No shuffle by id, and none of the wide rows.
    assert S.ID not in "".join(line for line in plan.splitlines() if "Exchange" in line)
    assert raw.count() > 10  # raw contracts still come once for each row that they look up
