"""Moments, feature model, persistence and the feature-frame properties."""

from __future__ import annotations

import math

import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.stat import Summarizer
from pyspark.sql import functions as F

from percepta.operators.features import (
    FeatureEstimator,
    FeatureModel,
    keyed_features,
    labeled_features,
    prepare_scoring,
    prepare_training,
    vector_columns,
)
from percepta.operators.stats import fit_moments, moments_frame
from percepta.spec import FIXTURE, PASSENGERS, FeatureSpec

TINY = "entity_id bigint, tenure double, amount double, tier int, grp string, n_side int, n_up int, site string, label int"


def test_moments_zero_fill_matches_summarizer(spark, fixture_small):
    m = fit_moments(fixture_small, ["amount", "tenure"])
    vec = VectorAssembler(inputCols=["a", "t"], outputCol="v").transform(
        fixture_small.select(
            F.coalesce("amount", F.lit(0.0)).alias("a"), F.coalesce("tenure", F.lit(0.0)).alias("t")
        )
    )
    s = vec.select(Summarizer.metrics("mean", "variance").summary(F.col("v")).alias("s")).first()["s"]
    assert m.mean["amount"] == pytest.approx(s["mean"][0], rel=1e-12)
    assert m.mean["tenure"] == pytest.approx(s["mean"][1], rel=1e-12)
    assert m.variance["amount"] == pytest.approx(s["variance"][0], rel=1e-12)
    assert m.variance["tenure"] == pytest.approx(s["variance"][1], rel=1e-12)
    assert m.count == 1500


def test_moments_null_modes(spark):
    df = spark.createDataFrame([(None,), (2.0,), (4.0,)], "x double")
    zero = fit_moments(df, ["x"], "zero")
    skip = fit_moments(df, ["x"], "skip")
    assert zero.mean["x"] == pytest.approx(2.0)  # (0 + 2 + 4) / 3
    assert skip.mean["x"] == pytest.approx(3.0)
    assert zero.variance["x"] == pytest.approx(4.0)
    assert skip.variance["x"] == pytest.approx(2.0)


def test_moments_one_row_and_empty(spark):
    one = spark.createDataFrame([(5.0,)], "x double")
    m = fit_moments(one, ["x"])
    assert m.variance["x"] == 0.0  # SQL gives NULL; fitted as 0 so scaling gives 0
    assert moments_frame(one, ["x"]).first()["x_var"] is None
    empty = spark.createDataFrame([], "x double")
    with pytest.raises(ValueError, match="empty"):
        fit_moments(empty, ["x"])


def test_feature_vector_hand_computed(spark):
    rows = [
        (1, None, 10.0, 1, "male", 0, 0, "S", 1),
        (2, 20.0, None, 2, "female", 1, 1, "C", 0),
        (3, 40.0, 30.0, 3, "female", 2, 2, None, 1),
        (4, 60.0, 20.0, 9, "male", 3, 3, "X", 0),
    ]
    df = spark.createDataFrame(rows, TINY)
    fm = FeatureEstimator.of(FIXTURE, outputCol="").fit(df)
    # zero-filled moments: amount (10, 0, 30, 20), tenure (0, 20, 40, 60)
    assert fm.moments.mean == {"amount": 15.0, "tenure": 30.0}
    sa = math.sqrt(((10 - 15) ** 2 + 15**2 + 15**2 + 5**2) / 3)
    st = math.sqrt((30**2 + 10**2 + 10**2 + 30**2) / 3)
    got = {r["entity_id"]: [r[f"f{i}"] for i in range(10)] for r in fm.transform(df).collect()}
    assert got[1] == pytest.approx([(10 - 15) / sa, 0.0, 1, 0, 1, 0, 0, 1, 0, 0])  # NULL tenure -> mean -> 0
    assert got[2] == pytest.approx([0.0, (20 - 30) / st, 0, 1, 0, 1, 0, 0, 1, 0])
    assert got[3] == pytest.approx([(30 - 15) / sa, (40 - 30) / st, 0, 1, 0, 0, 1, 1, 0, 0])  # NULL port -> 0
    assert got[4] == pytest.approx([(20 - 15) / sa, (60 - 30) / st, 1, 0, 0, 0, 1, 0, 0, 1])


def test_null_sex_fails_the_query(spark):
    df = spark.createDataFrame([(1, 1.0, 1.0, 1, None, 0, 0, "S", 1), (2, 2.0, 2.0, 1, "male", 0, 0, "S", 1)], TINY)
    fm = FeatureEstimator.of(FIXTURE).fit(df)
    with pytest.raises(Exception, match="NULL in categorical column grp"):
        fm.transform(df).collect()


def test_properties_on_fixture(spark, fixture_small):
    fm = FeatureEstimator.of(FIXTURE, outputCol="").fit(fixture_small)
    out = fm.transform(fixture_small)
    # each one-hot group sums to 1 on every row
    bad = out.where(
        (F.col("f2") + F.col("f3") != 1)
        | (F.col("f4") + F.col("f5") + F.col("f6") != 1)
        | (F.col("f7") + F.col("f8") + F.col("f9") != 1)
    ).count()
    assert bad == 0
    # standardizing the zero-filled column of the fitting data gives mean 0, std 1
    zf = fixture_small.select(F.coalesce("tenure", F.lit(0.0)).alias("tenure"))
    z = FeatureModel.of(
        FeatureSpec(None, None, ("tenure",), ()), fm.moments, outputCol=""
    ).transform(zf)
    # imputing zero-filled data is a no-op, so f0 is exactly the z-score
    s = z.agg(F.avg("f0").alias("m"), F.stddev_samp("f0").alias("s")).first()
    assert s["m"] == pytest.approx(0.0, abs=1e-12)
    assert s["s"] == pytest.approx(1.0, rel=1e-12)


def test_labeled_and_keyed_frames(spark, fixture_small):
    fm = FeatureEstimator.of(FIXTURE).fit(fixture_small)
    lab = labeled_features(fm.transform(fixture_small), FIXTURE)
    assert lab.columns == ["label", "features"]
    assert dict(lab.dtypes)["label"] == "double"
    key = keyed_features(fm.transform(fixture_small), FIXTURE)
    assert key.columns == ["entity_id", "features"]
    flat = vector_columns(key, FIXTURE.width)
    assert flat.columns == ["entity_id"] + [f"f{i}" for i in range(10)]


def test_prepare_frames(spark, fixture_small):
    frame, m = prepare_training(fixture_small, FIXTURE)
    assert frame.where(F.col("tenure").isNull() | F.col("amount").isNull()).count() == 0
    assert frame.where(F.col("site").isNull()).count() == 4  # NULL port code kept here
    scoring = prepare_scoring(fixture_small, FIXTURE)
    assert scoring.where(F.col("tenure").isNull()).count() == 300  # not imputed
    assert scoring.columns[0] == "entity_id"


def test_pipeline_save_load_roundtrip(spark, fixture_small, tmp_out):
    fm = FeatureEstimator.of(FIXTURE).fit(fixture_small)
    PipelineModel(stages=[fm]).write().overwrite().save(f"{tmp_out}/features")
    loaded = PipelineModel.load(f"{tmp_out}/features")
    a = vector_columns(fm.transform(fixture_small).select("entity_id", "features"), 10)
    b = vector_columns(loaded.transform(fixture_small).select("entity_id", "features"), 10)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_spec_json_roundtrip():
    for spec in (FIXTURE, PASSENGERS):
        assert FeatureSpec.from_json(spec.to_json()) == spec
    assert FIXTURE.width == 10 and FIXTURE.feature_names()[-1] == "f9"


def test_prepare_fit_on_train_uses_training_rows_only(spark, fixture_small):
    from percepta.plans import jobs

    leak = jobs.prepare(fixture_small, FIXTURE)  # original order: moments before the split
    clean = jobs.prepare(fixture_small, FIXTURE, fit_on="train")
    assert leak.features.moments.count == 1500
    assert clean.features.moments.count == clean.train.count() < 1500
    assert clean.train.count() + clean.validation.count() == 1500
