"""The query catalogue: one callable per operator, each ``(spark, sf_dir) -> DataFrame``.

Every query reads the whole ``orders`` table of ``sf_dir`` through the
fixture view (``sources.fixture``), so its work grows with the data. The
SQL twins are in ``plans.oracle``; column names match them one for one.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from percepta import defaults as D
from percepta.functions.encode import encode, guard_null, one_hot
from percepta.functions.scale import impute, min_max_scale, scale_value_literal, standardize
from percepta.functions.sqlfuncs import register_functions
from percepta.operators import clean, evaluate, index, model, split, stats
from percepta.operators.features import (
    FeatureEstimator,
    impute_with,
    keyed_features,
    labeled_features,
    prepare_scoring,
    prepare_training,
    vector_columns,
)
from percepta.plans import jobs
from percepta.session import shared_dir
from percepta.sources.csv import preview, read_csv, write_csv
from percepta.sources.fixture import passengers, read_table
from percepta.spec import FIXTURE, PASSENGER_SCHEMA, PORT, PORT_NULL_DEFAULT, SEX

Query = Callable[[SparkSession, str], DataFrame]

# Renames of the fixture columns to the passenger-table names.
TO_PASSENGER_NAMES = {
    "entity_id": "PassengerId",
    "tenure": "Age",
    "amount": "Fare",
    "tier": "Pclass",
    "grp": "Sex",
    "n_side": "SibSp",
    "n_up": "Parch",
    "site": "Embarked",
    "label": "Survived",
}

# Fixture stand-ins of the export job's settings.
EXPORT_FILL = {"tenure": D.FILL_CONSTANTS["Age"], "amount": D.FILL_CONSTANTS["Fare"]}
EXPORT_DROP = ("entity_id", "Name", "Ticket", "Cabin")
EXPORT_COLUMNS = ("tier", "tenure", "n_side", "n_up", "amount", "grp_index", "site_index", "label")
EXPORT_OPTIONS = {
    "index_cols": ("grp", "site"),
    "index_outputs": ("grp_index", "site_index"),
    "casts": {"tenure": "double", "amount": "double"},
}
EXPORT_SCHEMA = T.StructType(
    [
        T.StructField("tier", T.IntegerType()),
        T.StructField("tenure", T.DoubleType()),
        T.StructField("n_side", T.IntegerType()),
        T.StructField("n_up", T.IntegerType()),
        T.StructField("amount", T.DoubleType()),
        T.StructField("grp_index", T.DoubleType()),
        T.StructField("site_index", T.DoubleType()),
        T.StructField("label", T.IntegerType()),
    ]
)


def _r(col: str, digits: int = 6):
    return F.round(F.col(col), digits).alias(col)


def _fixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    return passengers(spark, sf_dir)


# --- sources / sinks ----------------------------------------------------------


def q_csv_scan_infer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write the table as headed CSV, read it back with type inference."""
    path = write_csv(_fixture(spark, sf_dir), shared_dir(spark, "csv-scan"), header=True)
    back = read_csv(spark, path, header=True)
    return back.withColumn("entity_id", F.col("entity_id").cast("bigint"))


def q_csv_sink_headerless(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Headerless export of the indexed frame, read back with its schema."""
    frame = jobs.export_frame(_fixture(spark, sf_dir), EXPORT_FILL, EXPORT_DROP, EXPORT_COLUMNS, **EXPORT_OPTIONS)
    path = write_csv(frame, shared_dir(spark, "csv-headerless"), header=False)
    return read_csv(spark, path, schema=EXPORT_SCHEMA, header=False)


def q_csv_sink_header(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Headed export of the prepared scoring frame, read back with its schema."""
    frame = prepare_scoring(_fixture(spark, sf_dir), FIXTURE)
    path = write_csv(frame, shared_dir(spark, "csv-header"), header=True)
    return read_csv(spark, path, schema=frame.schema, header=True)


def q_preview_head(spark: SparkSession, sf_dir: str) -> DataFrame:
    return preview(_fixture(spark, sf_dir), "entity_id", 20)


# --- projection / cleaning ----------------------------------------------------


def q_project_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = _fixture(spark, sf_dir)
    return clean.project(
        p,
        "entity_id",
        "label",
        "amount",
        encode("grp", SEX).alias("grp"),
        "tenure",
        "tier",
        "n_up",
        "n_side",
        encode("site", PORT).alias("site"),
    )


def q_cast_project(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = _fixture(spark, sf_dir)
    return clean.cast_columns(
        p,
        {
            "entity_id": "bigint",
            "label": "int",
            "tenure": "int",
            "amount": "double",
            "tier": "double",
            "grp": "string",
            "site": "string",
        },
    )


def q_drop_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean.drop_columns(_fixture(spark, sf_dir), *EXPORT_DROP)


def q_rename_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = _fixture(spark, sf_dir)
    return clean.rename_columns(p, [TO_PASSENGER_NAMES[c] for c in p.columns])


def q_null_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean.null_rows(_fixture(spark, sf_dir), "site")


# --- encoders -----------------------------------------------------------------


def q_encode_binary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _fixture(spark, sf_dir).select("entity_id", "grp", encode("grp", SEX).alias("grp_code"))


def q_encode_ternary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _fixture(spark, sf_dir).select("entity_id", "site", encode("site", PORT).alias("site_code"))


def q_encode_ternary_default(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = _fixture(spark, sf_dir)
    return p.select("entity_id", "site", encode("site", PORT_NULL_DEFAULT).alias("site_code"))


def q_sql_functions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Encoders and mean-fillers registered as named SQL functions, called by name."""
    p = _fixture(spark, sf_dir)
    m = stats.fit_moments(p, FIXTURE.continuous)
    names = register_functions(spark, FIXTURE, m.mean)
    encode_by, fill_by = names["encode"], names["fill"]
    return p.select(
        "entity_id",
        F.call_function(encode_by["grp"], F.col("grp")).alias("grp_code"),
        F.call_function(encode_by["site"], F.col("site")).alias("site_code"),
        F.round(F.call_function(fill_by["amount"], F.col("amount")), 4).alias("amount_filled"),
        F.round(F.call_function(fill_by["tenure"], F.col("tenure")), 6).alias("tenure_filled"),
    )


def _one_hot_query(p: DataFrame, code, levels, names) -> DataFrame:
    return p.select("entity_id", *[c.alias(n) for c, n in zip(one_hot(code, levels), names, strict=True)])


def q_one_hot_binary(spark: SparkSession, sf_dir: str) -> DataFrame:
    code = guard_null(encode("grp", SEX), "error", "grp")
    return _one_hot_query(_fixture(spark, sf_dir), code, D.SEX_LEVELS, ["grp_0", "grp_other"])


def q_one_hot_ternary(spark: SparkSession, sf_dir: str) -> DataFrame:
    code = guard_null(encode("site", PORT), D.PORT_NULL_CODE, "site")
    return _one_hot_query(
        _fixture(spark, sf_dir), code, D.PORT_LEVELS, ["site_0", "site_1", "site_other"]
    )


def q_one_hot_tier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _one_hot_query(
        _fixture(spark, sf_dir), F.col("tier"), D.CLASS_LEVELS, ["tier_1", "tier_2", "tier_other"]
    )


# --- statistics, imputation, scaling --------------------------------------------


def q_column_moments(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = stats.moments_frame(_fixture(spark, sf_dir), ["amount", "tenure"])
    return m.select(
        "n",
        *[_r(f"amount_{k}", 4) for k in ("mean", "var", "std")],
        *[_r(f"tenure_{k}", 6) for k in ("mean", "var", "std")],
    )


def q_impute_constant(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean.fill_constants(_fixture(spark, sf_dir), EXPORT_FILL)


def q_impute_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = _fixture(spark, sf_dir)
    m = stats.fit_moments(p, FIXTURE.continuous)
    return p.select(
        "entity_id",
        "label",
        F.round(impute("amount", m.mean["amount"]), 4).alias("amount"),
        F.round(impute("tenure", m.mean["tenure"]), 6).alias("tenure"),
    )


def q_impute_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Training-part means filled into the held-out part (``na.fill``)."""
    train, held_out = split.hash_split(_fixture(spark, sf_dir), "entity_id")
    m = stats.fit_moments(train, FIXTURE.continuous)
    scored = impute_with(prepare_scoring(held_out, FIXTURE), m.mean)
    return scored.withColumns(
        {"amount": F.round("amount", 4), "tenure": F.round("tenure", 6)}
    )


def q_standardize(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = _fixture(spark, sf_dir).withColumn("const", F.lit(1.0))
    m = stats.fit_moments(p, ["amount", "tenure", "const"])
    std = m.std
    z = {
        c: standardize(impute(c, m.mean[c]), m.mean[c], std[c]) for c in ("amount", "tenure", "const")
    }
    return p.select(
        "entity_id",
        F.round(z["amount"], 6).alias("amount_z"),
        F.round(z["tenure"], 6).alias("tenure_z"),
        z["const"].alias("const_z"),
    )


def _amount_range(p: DataFrame) -> tuple[float, float]:
    row = p.agg(F.min("amount").alias("lo"), F.max("amount").alias("hi")).first()
    return float(row["lo"]), float(row["hi"])


def q_min_max_scale(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = _fixture(spark, sf_dir)
    lo, hi = _amount_range(p)
    return p.select("entity_id", F.round(min_max_scale("amount", lo, hi), 6).alias("amount_scaled"))


def q_scale_value_literal(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = _fixture(spark, sf_dir)
    lo, hi = _amount_range(p)
    return p.select(
        "entity_id", F.round(scale_value_literal("amount", lo, hi), 6).alias("amount_scaled")
    )


# --- feature frames -----------------------------------------------------------

ROUNDED = ("f0", "f1")


def _round_features(df: DataFrame) -> DataFrame:
    return df.withColumns({c: F.round(c, 6) for c in ROUNDED})


def q_feature_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = _fixture(spark, sf_dir)
    fm = FeatureEstimator.of(FIXTURE, outputCol="").fit(p)
    out = fm.transform(p).select("entity_id", "label", *fm.feature_names())
    return _round_features(out)


def q_labeled_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = _fixture(spark, sf_dir)
    fm = FeatureEstimator.of(FIXTURE).fit(p)
    return _round_features(vector_columns(labeled_features(fm.transform(p), FIXTURE), FIXTURE.width))


def q_keyed_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    train, held_out = split.hash_split(_fixture(spark, sf_dir), "entity_id")
    fm = FeatureEstimator.of(FIXTURE).fit(train)
    return _round_features(vector_columns(keyed_features(fm.transform(held_out), FIXTURE), FIXTURE.width))


def _share_ok(first: DataFrame, second: DataFrame, weights=D.SPLIT_WEIGHTS) -> bool:
    """Whether the first part has its share of the rows, within 0.05."""
    n, m = first.count(), second.count()
    return n + m == 0 or abs(n / (n + m) - weights[0] / sum(weights)) < 0.05


def q_prepare_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The prepare job: moments -> features -> seeded 80/20 split; both parts, and whether the shares hold."""
    prepared = jobs.prepare(_fixture(spark, sf_dir), FIXTURE)
    parts = prepared.train.unionByName(prepared.validation)
    share_ok = _share_ok(prepared.train, prepared.validation)
    return _round_features(vector_columns(parts, FIXTURE.width)).withColumn("share_ok", F.lit(share_ok))


def q_prepare_training(spark: SparkSession, sf_dir: str) -> DataFrame:
    frame, _ = prepare_training(_fixture(spark, sf_dir), FIXTURE)
    return frame.withColumns({"amount": F.round("amount", 4), "tenure": F.round("tenure", 6)})


def q_prepare_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prepare_scoring(_fixture(spark, sf_dir), FIXTURE)


# --- indexing, splits -----------------------------------------------------------


def q_string_index_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    filled = clean.fill_constants(_fixture(spark, sf_dir), EXPORT_FILL)
    fitted = index.fit_index(filled, ["grp", "site"])
    return index.index_labels(spark, fitted).withColumnRenamed("column", "input_col")


def q_string_index_transform(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = _fixture(spark, sf_dir)
    fitted = index.fit_index(p, ["grp", "site"], output_cols=["grp_index", "site_index"])
    return fitted.transform(p).select("entity_id", "grp_index", "site_index")


def q_index_pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jobs.export_frame(_fixture(spark, sf_dir), EXPORT_FILL, EXPORT_DROP, EXPORT_COLUMNS, **EXPORT_OPTIONS)


def q_hash_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    train, _ = split.hash_split(_fixture(spark, sf_dir), "entity_id")
    return train.select("entity_id", "label")


#: A column of very many values, one of which has a third of all rows, and some no value.
WIDE = """CASE WHEN o_orderkey % 3 = 0 THEN 'house' WHEN o_orderkey % 50 = 1 THEN NULL
 ELSE concat('account-', CAST(o_custkey AS STRING)) END AS account"""


def q_string_index_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Frequency index of a column of very many values by a table of labels and a join."""
    orders = read_table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("entity_id"), F.expr(WIDE))
    return index.index_by_join(orders, "account", "account_index")


def q_random_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A seeded 80/20 split by key, each part read behind a shuffle of its own."""
    keys = _fixture(spark, sf_dir).select("entity_id", "label")
    keys = keys.repartition(7)  # rows come in another order each time
    parts = split.random_split(keys, D.SPLIT_WEIGHTS, D.SPLIT_SEED, "entity_id")
    return parts[0].withColumn("part", F.lit(0)).unionByName(parts[1].withColumn("part", F.lit(1)))


def q_split_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A seeded split of rows with many copies: the copies of each kind, and whether each part has its share."""
    rows = _fixture(spark, sf_dir).select("tier", "grp", "site").repartition(7)
    parts = split.split_copies(rows, D.SPLIT_WEIGHTS, D.SPLIT_SEED)
    seen = parts[0].withColumn("part", F.lit(0)).unionByName(parts[1].withColumn("part", F.lit(1)))
    first = F.sum((F.col("part") == 0).cast("int"))
    share = F.abs(first - F.count(F.lit(1)) * D.SPLIT_WEIGHTS[0] / sum(D.SPLIT_WEIGHTS)) < 1
    return seen.groupBy("tier", "grp", "site").agg(F.count(F.lit(1)).alias("n"), share.alias("share_ok"))


def q_constant_fill_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The export job end to end: fill, index, 70/30 split, headerless CSV, both parts read back."""
    train_dir, test_dir = jobs.constant_fill_export(
        _fixture(spark, sf_dir),
        shared_dir(spark, "export"),
        fill=EXPORT_FILL,
        drop=EXPORT_DROP,
        columns=EXPORT_COLUMNS,
        seed=D.SPLIT_SEED,
        **EXPORT_OPTIONS,
    )
    a = read_csv(spark, train_dir, schema=EXPORT_SCHEMA, header=False)
    b = read_csv(spark, test_dir, schema=EXPORT_SCHEMA, header=False)
    return a.unionByName(b).withColumn("share_ok", F.lit(_share_ok(a, b, D.EXPORT_WEIGHTS)))


# --- evaluation, models ---------------------------------------------------------


def q_classification_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metrics of the rule ``prediction = (grp == 'female')`` against the label."""
    p = _fixture(spark, sf_dir).select(
        F.col("label").cast("double").alias("label"),
        F.when(F.col("grp") == "female", 1.0).otherwise(0.0).alias("prediction"),
    )
    rep = evaluate.classification_report(p)
    return rep.select(*[F.round(c, 9).alias(c) for c in evaluate.REPORT_COLUMNS])


# The registered model queries train with the original settings (network
# 10-16-32-2, block 128, seed 1234, tol 1e-8, up to 1000 iterations; CV over
# the 18-point grid with 10 folds), each for itself, on as many partitions as
# the rows' bytes ask for. Weights come from iterative training, so the results
# show what is determined: the rows, whether the library's predictions are those of
# the network's own formula, the folds, and whether the quality passes its threshold.
CV_PARALLELISM = 8
LEAST_QUALITY = 0.95
#: Most by which a probability may differ from the network's formula.
SAME = 1e-9


def _train_validation(spark: SparkSession, sf_dir: str):
    return split.hash_split(_fixture(spark, sf_dir), "entity_id")


def fitted_classifier(train: DataFrame, max_iter: int | None = None):
    """Features + MLP fitted on ``train``."""
    classifier = model.mlp(max_iter=max_iter or D.MLP_MAX_ITER)
    return model.fit_classifier(train, FIXTURE, classifier, partitions=model.BY_SIZE)


def _valid() -> Column:
    return F.coalesce(F.col("prediction").isin(0.0, 1.0), F.lit(False)).alias("valid")


def _network(fitted, rows: DataFrame) -> DataFrame:
    """``rows`` with the network's own class (``own``) and probabilities (``own_p``), beside the library's."""
    scored = fitted.transform(rows)
    own = model.probabilities(fitted.stages[-1], vector_to_array("features"))
    return scored.withColumn("own_p", own).withColumn("own", model.predicted_class(F.col("own_p")))


def _dealt(rows: DataFrame) -> DataFrame:
    """``rows`` dealt by the hash of the whole row: a small file is one or two tasks, and the formula is slow."""
    return rows.repartition(F.xxhash64(*[F.col(f"`{c}`") for c in rows.columns]))


def _kept(spark: SparkSession, rows: DataFrame, name: str) -> DataFrame:
    """``rows`` written to the shared folder and read back, so that what is read twice is computed once."""
    path = shared_dir(spark, name)
    rows.write.parquet(path)
    return spark.read.schema(rows.schema).parquet(path)


def q_mlp_train_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fit features + MLP on the training part; the held-out part's predictions against formula and labels."""
    train, held_out = _train_validation(spark, sf_dir)
    scored = _network(fitted_classifier(train), _dealt(held_out))
    off = F.array_max(F.zip_with(vector_to_array("probability"), "own_p", lambda a, b: F.abs(a - b)))
    scored = _kept(spark, scored.select("entity_id", "label", "prediction", "own", off.alias("off")), "scored")
    right = F.avg((F.col("prediction") == F.col("label")).cast("double"))
    checks = scored.agg(F.coalesce(F.max("off"), F.lit(0.0)).alias("off"), F.coalesce(right, F.lit(0.0)).alias("right"))
    checks = checks.first()
    return scored.select(
        "entity_id",
        "label",
        _valid(),
        (F.col("prediction") == F.col("own")).alias("network_ok"),
        F.lit(checks["off"] < SAME).alias("difference_ok"),
        F.lit(checks["right"] >= LEAST_QUALITY).alias("correct_ok"),
    )


def _report_checks(report: DataFrame) -> dict[str, Column]:
    row = report.first()
    return {
        "accuracy_ok": F.lit(row["accuracy"] >= LEAST_QUALITY),
        "f1_ok": F.lit(LEAST_QUALITY <= row["f1"] <= 1),
        "error_ok": F.lit(abs(row["accuracy"] + row["test_error"] - 1) < 1e-9),
    }


def q_mlp_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The report of the fitted network on the held-out part, against its thresholds."""
    train, held_out = _train_validation(spark, sf_dir)
    scored = fitted_classifier(train).transform(held_out)
    checks = _report_checks(evaluate.classification_report(scored))
    return held_out.agg(F.count(F.lit(1)).alias("n_scored")).withColumns(checks)


def q_mlp_cv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Grid search with K-fold CV on the training part; one row per parameter map and fold."""
    train, _ = _train_validation(spark, sf_dir)
    fm = FeatureEstimator.of(FIXTURE).fit(train)
    frame = fm.transform(train).select(
        F.col("label").cast("double").alias("label"), "features", "entity_id"
    )
    frame = model.keyed_partitions(frame, "entity_id", model.BY_SIZE, FIXTURE.width)
    frame = split.assign_folds(frame, "entity_id", D.CV_FOLDS).drop("entity_id")
    cv = model.cross_validate(
        frame, folds=D.CV_FOLDS, fold_col="fold", parallelism=CV_PARALLELISM
    )
    maps = ["block_size", "max_iter", "tol"]
    table, summary = model.fold_table(spark, cv), model.cv_summary(spark, cv)
    # 18 maps of 10 folds: each map's mean again from its folds, and the best of these means.
    again = table.groupBy(*maps).agg(F.avg("metric").alias("again"))
    summary = summary.join(again, maps)
    good = summary.agg(F.max("again")).first()[0] >= LEAST_QUALITY
    return table.join(summary, maps).select(
        *maps,
        "fold",
        "n_train",
        "n_validation",
        F.col("metric").between(0, 1).alias("metric_ok"),
        (F.abs(F.col("again") - F.col("metric_mean")) < 1e-12).alias("mean_ok"),
        F.lit(model.best_is_first_maximum(cv)).alias("best_ok"),
        F.lit(good).alias("quality_ok"),
    )


def q_batch_score_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Score the held-out rows, export ``key,prediction`` with a header, read back, against formula and labels."""
    train, held_out = _train_validation(spark, sf_dir)
    fitted = fitted_classifier(train)
    out = shared_dir(spark, "scores")
    scores = jobs.score_frame(fitted, held_out.drop("label"), "entity_id", key_as_double=True)
    write_csv(scores, out, header=True)
    back = read_csv(spark, out, schema="entity_id double, prediction double", header=True)
    own = _network(fitted, _dealt(held_out))
    own = own.select(F.col("entity_id").cast("double").alias("entity_id"), "label", "own")
    both = back.join(_kept(spark, own, "own"), "entity_id", "left")
    right = both.agg(F.avg((F.col("prediction") == F.col("label")).cast("double"))).first()[0] or 0.0
    return both.select(
        "entity_id",
        _valid(),
        F.coalesce(F.col("prediction") == F.col("own"), F.lit(False)).alias("network_ok"),
        F.lit(right >= LEAST_QUALITY).alias("correct_ok"),
    )


def passenger_files(spark: SparkSession, sf_dir: str) -> tuple[str, str]:
    """The fixture as two passenger-style CSV files (training with label, scoring without).

    Written to the shared folder with the original column names, so the
    passenger jobs run unchanged on data that grows with ``orders``.
    """
    train, held_out = _train_validation(spark, sf_dir)

    def as_passengers(df: DataFrame) -> DataFrame:
        renamed = df.select(*[F.col(c).alias(TO_PASSENGER_NAMES[c]) for c in df.columns])
        return renamed.withColumns(
            {
                "PassengerId": F.col("PassengerId").cast("bigint"),
                "Name": F.concat(F.lit("Rider, No. "), F.col("PassengerId").cast("string")),
                "Ticket": F.concat(F.lit("T"), F.col("PassengerId").cast("string")),
                "Cabin": F.when(F.col("PassengerId") % 3 == 0, F.lit("C1")),
            }
        ).select(*[f.name for f in PASSENGER_SCHEMA.fields])

    train_path = write_csv(as_passengers(train), shared_dir(spark, "passengers-train"))
    score_path = write_csv(
        as_passengers(held_out).drop("Survived"), shared_dir(spark, "passengers-score")
    )
    return train_path, score_path


def _job_result(spark: SparkSession, out: str, result: jobs.JobResult) -> DataFrame:
    """The exported scores, with the checks of the job's report on each row."""
    scores = read_csv(spark, out, schema="PassengerId bigint, prediction double", header=True)
    return scores.select("PassengerId", _valid()).withColumns(_report_checks(result.report))


def q_train_score_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The train -> evaluate -> score job on passenger files."""
    train_path, score_path = passenger_files(spark, sf_dir)
    out = shared_dir(spark, "train-score-result")
    result = jobs.fit_evaluate_score(
        spark,
        train_path,
        score_path,
        out,
        classifier=model.mlp(max_iter=D.MLP_MAX_ITER),
    )
    return _job_result(spark, out, result)


def q_cv_score_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cross-validated job on passenger files, with moments of the training part alone."""
    train_path, score_path = passenger_files(spark, sf_dir)
    out = shared_dir(spark, "cv-score-result")
    result = jobs.cv_evaluate_score(
        spark, train_path, score_path, out,
        folds=D.CV_FOLDS, parallelism=CV_PARALLELISM, fit_on="train",
    )
    return _job_result(spark, out, result).withColumns(
        {"n_maps": F.lit(result.summary.count()).cast("bigint"), "best_ok": F.lit(result.best_first)}
    )


QUERIES: dict[str, Query] = {
    "csv_scan_infer": q_csv_scan_infer,
    "project_columns": q_project_columns,
    "cast_project": q_cast_project,
    "drop_columns": q_drop_columns,
    "rename_columns": q_rename_columns,
    "null_rows": q_null_rows,
    "encode_binary": q_encode_binary,
    "encode_ternary": q_encode_ternary,
    "encode_ternary_default": q_encode_ternary_default,
    "sql_functions": q_sql_functions,
    "one_hot_binary": q_one_hot_binary,
    "one_hot_ternary": q_one_hot_ternary,
    "one_hot_tier": q_one_hot_tier,
    "column_moments": q_column_moments,
    "impute_constant": q_impute_constant,
    "impute_mean": q_impute_mean,
    "impute_scoring": q_impute_scoring,
    "standardize": q_standardize,
    "min_max_scale": q_min_max_scale,
    "scale_value_literal": q_scale_value_literal,
    "feature_columns": q_feature_columns,
    "labeled_features": q_labeled_features,
    "keyed_features": q_keyed_features,
    "prepare_split": q_prepare_split,
    "prepare_training": q_prepare_training,
    "prepare_scoring": q_prepare_scoring,
    "string_index_labels": q_string_index_labels,
    "string_index_transform": q_string_index_transform,
    "string_index_wide": q_string_index_wide,
    "index_pipeline": q_index_pipeline,
    "hash_split": q_hash_split,
    "random_split": q_random_split,
    "split_copies": q_split_copies,
    "csv_sink_headerless": q_csv_sink_headerless,
    "csv_sink_header": q_csv_sink_header,
    "preview_head": q_preview_head,
    "classification_report": q_classification_report,
    "constant_fill_export": q_constant_fill_export,
    "mlp_train_score": q_mlp_train_score,
    "mlp_report": q_mlp_report,
    "mlp_cv": q_mlp_cv,
    "batch_score_export": q_batch_score_export,
    "train_score_job": q_train_score_job,
    "cv_score_job": q_cv_score_job,
}
