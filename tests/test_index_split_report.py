"""String indexing, splits and the classification report."""

from __future__ import annotations

import pytest
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.sql import functions as F

from percepta.operators import evaluate, index, split


def test_index_order_ties_and_skip(spark):
    df = spark.createDataFrame(
        [("b", "S"), ("a", "S"), ("b", "C"), ("a", None), ("c", "Q"), ("c", "S")], "sex string, port string"
    )
    fitted = index.fit_index(df, ["sex", "port"], output_cols=["sexIndex", "portIndex"])
    labels = {(r["column"], r["value"]): r["idx"] for r in index.index_labels(spark, fitted).collect()}
    # sex counts a=2, b=2, c=2 -> alphabetical; port S=3, C=1, Q=1 -> S, then C before Q
    assert labels == {
        ("sex", "a"): 0.0, ("sex", "b"): 1.0, ("sex", "c"): 2.0,
        ("port", "S"): 0.0, ("port", "C"): 1.0, ("port", "Q"): 2.0,
    }
    out = fitted.transform(df)
    assert out.count() == 5  # the NULL port row is skipped
    assert dict(out.dtypes)["sexIndex"] == "double"


def test_index_matches_sql_on_fixture(spark, fixture_small):
    fitted = index.fit_index(fixture_small, ["site"], output_cols=["site_index"])
    counts = fixture_small.where(F.col("site").isNotNull()).groupBy("site").count().collect()
    expected = [r["site"] for r in sorted(counts, key=lambda r: (-r["count"], r["site"]))]
    assert index.labels_of(fitted) == {"site": expected}


@pytest.mark.parametrize("order", index.ORDERS)
def test_fit_index_orders(spark, fixture_small, order):
    counts = [(r["site"], r["count"]) for r in fixture_small.where("site IS NOT NULL").groupBy("site").count().collect()]
    key = {
        "frequencyDesc": lambda v: (-v[1], v[0]), "frequencyAsc": lambda v: (v[1], v[0]),
        "alphabetAsc": lambda v: v[0], "alphabetDesc": lambda v: [-ord(c) for c in v[0]],
    }[order]
    fitted = index.fit_index(fixture_small, ["site"], order=order)
    assert index.labels_of(fitted) == {"site": [v for v, _ in sorted(counts, key=key)]}


def test_index_has_no_cap_on_values(spark):
    df = spark.range(100_001).select(F.format_string("v%06d", "id").alias("k"))
    labels = index.labels_of(index.fit_index(df, ["k"]))["k"]
    assert len(labels) == 100_001 and labels[0] == "v000000" and labels[-1] == "v100000"


def test_label_table_equals_the_indexer(spark, fixture_small):
    df = fixture_small.withColumn("k", F.concat(F.lit("k"), (F.col("entity_id") % 97).cast("string")))
    df = df.withColumn("k", F.when(F.col("entity_id") % 11 != 0, F.col("k")))
    fitted = index.fit_index(df, ["k"], output_cols=["i"])
    table = {r["value"]: r["idx"] for r in index.label_table(df, "k").collect()}
    assert table == {v: float(i) for i, v in enumerate(index.labels_of(fitted)["k"])}
    a = fitted.transform(df).select("entity_id", "i")
    b = index.index_by_join(df, "k", "i").select("entity_id", "i")
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_null_keys_stay_in_a_split(spark):
    df = spark.createDataFrame([(1,), (None,), (3,), (None,)], "k int")
    a, b = split.hash_split(df, "k")
    assert a.count() + b.count() == 4 and a.where("k IS NULL").count() == 2
    assert split.assign_folds(df, "k", 3).where("fold IS NULL").count() == 0


def test_random_split_disjoint_and_complete(spark, fixture_small):
    parts = split.random_split(fixture_small.select("entity_id"), [0.8, 0.2], 12345)
    a, b = (set(r[0] for r in p.collect()) for p in parts)
    assert not a & b
    assert len(a | b) == 1500
    assert 0.7 < len(a) / 1500 < 0.9


def shuffled(df, n):
    """The rows behind a shuffle whose order differs from one evaluation to the next."""
    return df.withColumn("_r", F.rand()).repartition(n, "_r").sortWithinPartitions("_r").drop("_r")


@pytest.mark.parametrize("key", ["entity_id", None])
def test_random_split_holds_behind_a_changing_shuffle(spark, fixture_small, key):
    rows = fixture_small.select("entity_id", "site", "amount")
    ids = [sorted(r[0] for r in p.collect()) for p in split.random_split(shuffled(rows, 5), [0.8, 0.2], 7, key)]
    again = [sorted(r[0] for r in p.collect()) for p in split.random_split(shuffled(rows, 3), [0.8, 0.2], 7, key)]
    assert ids == again
    assert sorted(ids[0] + ids[1]) == sorted(r[0] for r in rows.select("entity_id").collect())
    assert 0.75 < len(ids[0]) / 1500 < 0.85
    other = split.random_split(rows, [0.8, 0.2], 8, key)[0]
    assert sorted(r[0] for r in other.collect()) != ids[0]


def test_random_split_of_null_keys_and_empty_parts(spark):
    rows = spark.createDataFrame([(None if k % 3 == 0 else k, k) for k in range(900)], "k int, v int")
    a, b, c = (p.collect() for p in split.random_split(shuffled(rows, 4), [0.5, 0.5, 0.0], 3, "k"))
    assert sorted(r.v for r in a + b) == list(range(900)) and not c
    nulls = sum(r.k is None for r in a)
    assert 100 < nulls < 200  # rows with a NULL key are drawn by their content


@pytest.mark.parametrize("copies", [100_000, 7])
def test_split_copies_deals_equal_rows_in_proportion(spark, copies):
    rows = spark.createDataFrame([("hot", None)] * 5000 + [(f"v{k % 50}", k % 50) for k in range(700)], "a string, b int")
    rows = rows.unionByName(spark.createDataFrame([(f"one{k}", k) for k in range(1000)], "a string, b int"))
    parts = [p.collect() for p in split.split_copies(shuffled(rows, 5), [0.6, 0.3, 0.1], 11, copies)]
    assert sorted(map(str, sum(parts, []))) == sorted(map(str, rows.collect()))
    counts = [{} for _ in parts]
    for count, part in zip(counts, parts, strict=True):
        for r in part:
            count[r.a] = count.get(r.a, 0) + 1
    assert [c["hot"] for c in counts] in ([3000, 1500, 500], [3001, 1500, 499], [3000, 1501, 499], [3001, 1499, 500])
    for k in range(50):
        assert all(abs(c.get(f"v{k}", 0) - 14 * w) < 2 for c, w in zip(counts, (0.6, 0.3, 0.1), strict=True))
    singles = [sum(n == 1 for a, n in c.items() if a.startswith("one")) for c in counts]
    assert sum(singles) == 1000 and abs(singles[0] - 600) < 60 and abs(singles[2] - 100) < 40
    again = [sorted(map(str, p.collect())) for p in split.split_copies(shuffled(rows, 3), [0.6, 0.3, 0.1], 11, copies)]
    assert again == [sorted(map(str, p)) for p in parts]
    assert [p.count() for p in split.split_copies(rows.where("false"), [0.5, 0.5], 1)] == [0, 0]


def test_index_by_join_keeps_common_values_out_of_the_shuffle(spark):
    rows = spark.range(30_000).select(
        "id", F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 7 == 0, None).otherwise(F.concat(F.lit("v"), F.col("id") % 5000)).alias("k")
    )
    labels = index.label_table(rows, "k")
    out = index.index_by_join(rows, "k", "i", labels)
    assert out.columns == ["id", "k", "i"]
    counts = [(r["k"], r["count"]) for r in rows.where("k IS NOT NULL").groupBy("k").count().collect()]
    expected = {v: float(i) for i, (v, _) in enumerate(sorted(counts, key=lambda c: (-c[1], c[0])))}
    got = out.collect()
    assert len(got) == rows.where("k IS NOT NULL").count()
    assert all(r["i"] == expected[r["k"]] for r in got) and expected["hot"] == 0.0
    # What is left for the shuffle join has no value with more than one in COMMON of the rows.
    rare = labels.where(F.col("n") * index.COMMON <= 30_000).agg(F.max("n")).first()[0]
    assert rare <= 30 and labels.where(F.col("n") * index.COMMON > 30_000).count() < index.COMMON


def test_index_by_join_on_an_empty_table(spark):
    rows = spark.createDataFrame([(1, None)], "id int, k string")
    assert index.index_by_join(rows, "k", "i").count() == 0


def test_folds_are_those_of_sql(spark, fixture_small):
    import duckdb

    folds = split.assign_folds(fixture_small.select("entity_id"), "entity_id", 10).collect()
    con = duckdb.connect()
    for r in folds[::50]:
        sql = f"SELECT CAST('0x' || substr(md5('fold|{r.entity_id}'), 1, 7) AS BIGINT) % 10"
        assert con.execute(sql).fetchone()[0] == r.fold


def test_null_keys_fill_all_folds(spark):
    rows = spark.range(600).select(F.lit(None).cast("long").alias("k"), "id")
    sizes = [r["count"] for r in split.assign_folds(rows, "k", 5).groupBy("fold").count().collect()]
    assert len(sizes) == 5 and min(sizes) > 60


def test_hash_split_is_partitioning_independent(spark, fixture_small):
    t1, v1 = split.hash_split(fixture_small, "entity_id")
    t2, _ = split.hash_split(fixture_small.repartition(7), "entity_id")
    ids1 = sorted(r[0] for r in t1.select("entity_id").collect())
    ids2 = sorted(r[0] for r in t2.select("entity_id").collect())
    assert ids1 == ids2
    assert len(ids1) + v1.count() == 1500


def test_split_column_and_folds(spark, fixture_small):
    labelled = split.with_split_column(fixture_small, [0.7, 0.3], 7, ["train", "test"])
    counts = {r["split"]: r["count"] for r in labelled.groupBy("split").count().collect()}
    assert set(counts) == {"train", "test"} and sum(counts.values()) == 1500
    train, _ = split.hash_split(fixture_small, "entity_id")
    folds = split.assign_folds(train, "entity_id", 10)
    sizes = [r["count"] for r in folds.groupBy("fold").count().collect()]
    assert len(sizes) == 10 and min(sizes) > 0  # independent of the split hash


def test_report_equals_spark_evaluator(spark, fixture_small):
    pred = fixture_small.select(
        F.col("label").cast("double").alias("label"),
        F.when(F.col("grp") == "female", 1.0).otherwise(0.0).alias("prediction"),
    )
    rep = evaluate.classification_report(pred).first()
    for metric, col in [
        ("accuracy", "accuracy"),
        ("weightedPrecision", "weighted_precision"),
        ("weightedRecall", "weighted_recall"),
        ("f1", "f1"),
    ]:
        ev = MulticlassClassificationEvaluator(metricName=metric).evaluate(pred)
        assert rep[col] == pytest.approx(ev, abs=1e-12), metric
    assert rep["test_error"] == pytest.approx(1 - rep["accuracy"])


def test_report_golden_sf001(spark):
    from percepta.sources.fixture import passengers

    p = passengers(spark, "/root/testdata/sf0.01")
    pred = p.select(
        F.col("label").alias("label"), F.when(F.col("grp") == "female", 1).otherwise(0).alias("prediction")
    )
    rep = evaluate.classification_report(pred).first()
    assert rep["accuracy"] == pytest.approx(0.778133, abs=1e-6)
    assert rep["weighted_precision"] == pytest.approx(0.777485, abs=1e-6)
    assert rep["weighted_recall"] == pytest.approx(0.778133, abs=1e-6)
    assert rep["f1"] == pytest.approx(0.777752, abs=1e-6)


def test_report_multiclass_and_unseen_prediction(spark):
    rows = [(0.0, 0.0), (0.0, 1.0), (1.0, 1.0), (2.0, 1.0), (2.0, 2.0), (1.0, 3.0)]
    pred = spark.createDataFrame(rows, "label double, prediction double")
    rep = evaluate.classification_report(pred).first()
    for metric, col in [("weightedPrecision", "weighted_precision"), ("f1", "f1"), ("accuracy", "accuracy")]:
        ev = MulticlassClassificationEvaluator(metricName=metric).evaluate(pred)
        assert rep[col] == pytest.approx(ev, abs=1e-12), metric
