"""Every catalogue query against its DuckDB twin (sf0.001), and the driver contract."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry_mod
from percepta import defaults as D
from percepta.plans import catalog
from percepta.plans.catalog import QUERIES
from percepta.plans.check import compare, duckdb_connection
from percepta.plans.oracle import ORACLE_SQL

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duckdb_connection(SF)


#: Queries that are tested with smaller training budgets; the others train as registered.
SMALL_BUDGETS = {"mlp_cv", "cv_score_job", "batch_score_export", "train_score_job"}


@pytest.mark.parametrize("name", sorted(set(ORACLE_SQL)))
def test_query_matches_oracle(spark, con, name, monkeypatch):
    if name in SMALL_BUDGETS:
        monkeypatch.setattr(D, "CV_FOLDS", 2)
        monkeypatch.setattr(D, "MLP_MAX_ITER", 150)
    sql = ORACLE_SQL[name]
    if name == "mlp_cv":
        assert "% 10 AS INTEGER)" in sql
        sql = sql.replace("% 10 AS INTEGER)", "% 2 AS INTEGER)")
    res = compare(spark, con, name, QUERIES[name], sql, SF)
    assert res["columns_match"], res
    assert res["types_match"], res
    assert res["rows"] == res["oracle_rows"], res
    assert res["match"], res


def test_every_query_has_an_oracle():
    assert set(ORACLE_SQL) == set(QUERIES)


def test_one_sided_split_turns_the_row_red(spark, con, monkeypatch):
    from percepta.operators import split

    monkeypatch.setattr(split, "random_split", lambda df, w, s=None, key=None: [df, df.where("false")])
    for name in ("random_split", "prepare_split"):
        assert not compare(spark, con, name, QUERIES[name], ORACLE_SQL[name], SF)["match"]


def test_copies_that_stay_together_turn_the_row_red(spark, con, monkeypatch):
    from percepta.operators import split

    monkeypatch.setattr(split, "split_copies", split.random_split)
    assert not compare(spark, con, "split_copies", QUERIES["split_copies"], ORACLE_SQL["split_copies"], SF)["match"]


def test_untrained_networks_turn_the_rows_red(spark, con, monkeypatch):
    """A network of no use is found out, though each of its predictions is a class."""
    monkeypatch.setattr(D, "MLP_MAX_ITER", 1)
    monkeypatch.setattr(D, "CV_FOLDS", 2)
    full = catalog.model.param_grid
    monkeypatch.setattr(catalog.model, "param_grid", lambda c: full(c, max_iters=(1,), tols=(1e-2,)))
    for name in ("mlp_train_score", "batch_score_export"):
        rows = QUERIES[name](spark, SF).collect()
        assert rows and not any(r.correct_ok for r in rows) and all(r.valid and r.network_ok for r in rows)
    assert not any(r.quality_ok for r in QUERIES["mlp_cv"](spark, SF).collect())


def test_predictions_of_another_network_turn_the_rows_red(spark, monkeypatch):
    """The formula is compared with the library's result, not with itself."""
    monkeypatch.setattr(D, "MLP_MAX_ITER", 20)
    true = catalog.model.probabilities
    monkeypatch.setattr(
        catalog.model, "probabilities", lambda m, x: catalog.F.transform(true(m, x), lambda p: 1 - p)
    )
    for name in ("mlp_train_score", "batch_score_export"):
        assert not all(r.network_ok for r in QUERIES[name](spark, SF).collect())


def test_the_formula_is_computed_once_for_each_held_out_row(spark, monkeypatch):
    monkeypatch.setattr(D, "MLP_MAX_ITER", 2)
    seen, true = spark.sparkContext.accumulator(0), catalog._network

    def passed(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    monkeypatch.setattr(catalog, "_network", lambda m, rows: true(m, rows.mapInArrow(passed, rows.schema)))
    for name in ("mlp_train_score", "batch_score_export"):
        before = seen.value
        rows = QUERIES[name](spark, SF).collect()
        assert rows and seen.value - before == len(rows)


def test_driver_contract(spark):
    q = entry_mod.queries()
    o = entry_mod.oracle_sql()
    assert set(o) <= set(q)
    df = entry_mod.entry(spark)
    assert df.columns == ["entity_id", "label"] + [f"f{i}" for i in range(10)]
    assert df.count() == 1500


def test_batch_score_export_fits_with_the_registered_budget(spark, monkeypatch):
    asked, mlp = [], catalog.model.mlp
    monkeypatch.setattr(catalog.model, "mlp", lambda max_iter: asked.append(max_iter) or mlp(max_iter=2))
    assert QUERIES["batch_score_export"](spark, SF).count() > 0
    assert asked == [D.MLP_MAX_ITER]
