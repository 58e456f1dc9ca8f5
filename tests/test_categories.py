"""Too many categories are refused, and no more of them go to the driver than it takes to tell."""

import pytest
from pyspark.sql import functions as F

from tenderlens import schema as S
from tenderlens.operators import regression as R


def categories(spark, n):
    return spark.range(2 * n).select((F.col("id") % n).cast("string").alias(S.MODALITY))


@pytest.mark.parametrize("run", [R.one_hot_drop_first, lambda df: R.build_preprocessor(df, [], [S.MODALITY])])
@pytest.mark.parametrize("n, missing", [(4098, 0), (4098, 1), (20_000, 1)])
def test_too_many(spark, monkeypatch, run, n, missing):
    df = categories(spark, n).unionByName(
        spark.createDataFrame([(None,)] * missing, f"{S.MODALITY} string")).withColumn("x", F.lit(1.0))
    monkeypatch.setattr(
        R.StringIndexerModel, "from_labels", lambda *_, **__: pytest.fail("the categories were taken"))
    with pytest.raises(ValueError, match="409[78] features"):
        run(df)


def test_as_many_as_fit(spark):
    encoded = R.one_hot_drop_first(categories(spark, 4097).unionByName(
        spark.createDataFrame([("0",)], f"{S.MODALITY} string")))
    assert encoded.first()[f"{S.MODALITY}_vec"].size == 4096
