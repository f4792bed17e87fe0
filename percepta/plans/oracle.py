"""DuckDB-runnable SQL twins of the catalogue queries.

Each text starts from the fixture view over ``orders`` (the same SQL runs
on Spark), so the oracle recomputes every statistic itself instead of
reading numbers from the Spark side. Conventions that keep both engines
equal: doubles written as ``1.0e0`` (``1.0`` is a DECIMAL), counts cast to
BIGINT, double->int as ``trunc`` then cast (DuckDB's cast rounds), and
values that went through floating sums rounded to 6 decimals (4 for money).
"""

from __future__ import annotations

from percepta import defaults as D
from percepta.sources.fixture import FIXTURE_SQL

P = f"p AS ({FIXTURE_SQL})"

SEX = "CASE WHEN grp IS NULL THEN NULL WHEN grp = 'male' THEN 0 ELSE 1 END"
PORT = "CASE WHEN site IS NULL THEN NULL WHEN site = 'S' THEN 0 WHEN site = 'C' THEN 1 ELSE 2 END"
PORT_DEFAULT = "CASE WHEN site IS NULL THEN 0 WHEN site = 'S' THEN 0 WHEN site = 'C' THEN 1 ELSE 2 END"
BUCKET = "CAST(('0x' || substr(md5(CAST(entity_id AS VARCHAR)), 1, 7)) AS BIGINT) % 10"

# Draws and folds of a row: from the MD5 of seed or salt and key.
DRAW = (
    f"CAST(('0x' || substr(md5('{D.SPLIT_SEED}|' || CAST(entity_id AS VARCHAR)), 1, 13)) AS BIGINT)"
    " / 4503599627370496e0"
)
TRAIN_SHARE = repr(D.SPLIT_WEIGHTS[0] / sum(D.SPLIT_WEIGHTS)) + "e0"
FOLD = (
    "CAST(CAST(('0x' || substr(md5('fold|' || CAST(entity_id AS VARCHAR)), 1, 7)) AS BIGINT)"
    f" % {D.CV_FOLDS} AS INTEGER)"
)


def moments(src: str = "p", name: str = "m") -> str:
    return (
        f"{name} AS (SELECT avg(coalesce(amount, 0)) AS am, stddev_samp(coalesce(amount, 0)) AS asd,"
        f" avg(coalesce(tenure, 0)) AS tm, stddev_samp(coalesce(tenure, 0)) AS tsd FROM {src})"
    )


def one_hot(code: str, levels: tuple[int, ...], names: list[str]) -> str:
    parts = [
        f"CASE WHEN {code} = {lv} THEN 1.0e0 ELSE 0.0e0 END AS {n}"
        for lv, n in zip(levels, names, strict=False)
    ]
    inlist = ", ".join(str(lv) for lv in levels)
    parts.append(f"CASE WHEN {code} IN ({inlist}) THEN 0.0e0 ELSE 1.0e0 END AS {names[-1]}")
    return ", ".join(parts)


def scaled(x: str, mean: str, std: str) -> str:
    return f"({x} - {mean}) * (1.0e0 / {std})"


def features(src: str = "p", m: str = "m") -> str:
    """f0..f9 from raw fixture columns with moments in ``m`` (am, asd, tm, tsd)."""
    return ", ".join(
        [
            f"round({scaled(f'coalesce(amount, {m}.am)', f'{m}.am', f'{m}.asd')}, 6) AS f0",
            f"round({scaled(f'coalesce(tenure, {m}.tm)', f'{m}.tm', f'{m}.tsd')}, 6) AS f1",
            one_hot(SEX, (0,), ["f2", "f3"]),
            one_hot("tier", (1, 2), ["f4", "f5", "f6"]),
            one_hot(f"coalesce({PORT}, 0)", (0, 1), ["f7", "f8", "f9"]),
        ]
    )


CHECKS = "true AS accuracy_ok, true AS f1_ok, true AS error_ok"

EXPORT_FRAME = f"""WITH {P},
 filled AS (SELECT entity_id, coalesce(tenure, 30.0e0) AS tenure, coalesce(amount, 32.2e0) AS amount,
   tier, grp, n_side, n_up, site, label FROM p),
 counted AS (SELECT 'grp' AS input_col, grp AS value, count(*) AS n FROM filled WHERE grp IS NOT NULL GROUP BY grp
   UNION ALL SELECT 'site', site, count(*) FROM filled WHERE site IS NOT NULL GROUP BY site),
 labels AS (SELECT input_col, value,
   CAST(row_number() OVER (PARTITION BY input_col ORDER BY n DESC, value) - 1 AS DOUBLE) AS idx FROM counted),
 export AS (SELECT f.tier, f.tenure, f.n_side, f.n_up, f.amount, g.idx AS grp_index, s.idx AS site_index, f.label
   FROM filled f JOIN labels g ON g.input_col = 'grp' AND g.value = f.grp
   JOIN labels s ON s.input_col = 'site' AND s.value = f.site)"""

REPORT = """cm AS (SELECT l, pr, CAST(count(*) AS BIGINT) AS n FROM pred GROUP BY l, pr),
 cls AS (SELECT l AS c FROM cm UNION SELECT pr FROM cm),
 k AS (SELECT c, sum(CASE WHEN l = c AND pr = c THEN n ELSE 0 END) * 1.0e0 AS tp,
   sum(CASE WHEN l = c THEN n ELSE 0 END) * 1.0e0 AS sup,
   sum(CASE WHEN pr = c THEN n ELSE 0 END) * 1.0e0 AS pp FROM cm, cls GROUP BY c),
 f AS (SELECT sup, tp, CASE WHEN pp = 0 THEN 0.0e0 ELSE tp / pp END AS prec,
   CASE WHEN sup = 0 THEN 0.0e0 ELSE tp / sup END AS rec FROM k),
 r AS (SELECT sum(tp) / sum(sup) AS acc, sum(sup * prec) / sum(sup) AS wp, sum(sup * rec) / sum(sup) AS wr,
   sum(sup * CASE WHEN prec + rec = 0 THEN 0.0e0 ELSE 2 * prec * rec / (prec + rec) END) / sum(sup) AS wf FROM f)
SELECT round(acc, 9) AS accuracy, round(wp, 9) AS weighted_precision, round(wr, 9) AS weighted_recall,
 round(wf, 9) AS f1, round(1.0e0 - acc, 9) AS test_error FROM r"""

ORACLE_SQL: dict[str, str] = {
    "csv_scan_infer": f"""WITH {P} SELECT CAST(entity_id AS BIGINT) AS entity_id, tenure, amount, tier, grp,
 n_side, n_up, site, label FROM p""",
    "project_columns": f"""WITH {P} SELECT entity_id, label, amount, {SEX} AS grp, tenure, tier, n_up, n_side,
 {PORT} AS site FROM p""",
    "cast_project": f"""WITH {P} SELECT entity_id, CAST(label AS INTEGER) AS label,
 CAST(trunc(tenure) AS INTEGER) AS tenure, CAST(amount AS DOUBLE) AS amount, CAST(tier AS DOUBLE) AS tier,
 grp, site FROM p""",
    "drop_columns": f"WITH {P} SELECT tenure, amount, tier, grp, n_side, n_up, site, label FROM p",
    "rename_columns": f"""WITH {P} SELECT entity_id AS PassengerId, tenure AS Age, amount AS Fare,
 tier AS Pclass, grp AS Sex, n_side AS SibSp, n_up AS Parch, site AS Embarked, label AS Survived FROM p""",
    "null_rows": f"WITH {P} SELECT * FROM p WHERE site IS NULL",
    "encode_binary": f"WITH {P} SELECT entity_id, grp, {SEX} AS grp_code FROM p",
    "encode_ternary": f"WITH {P} SELECT entity_id, site, {PORT} AS site_code FROM p",
    "encode_ternary_default": f"WITH {P} SELECT entity_id, site, {PORT_DEFAULT} AS site_code FROM p",
    "sql_functions": f"""WITH {P}, {moments()} SELECT entity_id, {SEX} AS grp_code, {PORT} AS site_code,
 round(coalesce(amount, m.am), 4) AS amount_filled, round(coalesce(tenure, m.tm), 6) AS tenure_filled
 FROM p, m""",
    "one_hot_binary": f"WITH {P} SELECT entity_id, {one_hot(SEX, (0,), ['grp_0', 'grp_other'])} FROM p",
    "one_hot_ternary": f"""WITH {P} SELECT entity_id,
 {one_hot(f'coalesce({PORT}, 0)', (0, 1), ['site_0', 'site_1', 'site_other'])} FROM p""",
    "one_hot_tier": f"""WITH {P} SELECT entity_id,
 {one_hot('tier', (1, 2), ['tier_1', 'tier_2', 'tier_other'])} FROM p""",
    "column_moments": f"""WITH {P} SELECT CAST(count(*) AS BIGINT) AS n,
 round(avg(coalesce(amount, 0)), 4) AS amount_mean, round(var_samp(coalesce(amount, 0)), 4) AS amount_var,
 round(stddev_samp(coalesce(amount, 0)), 4) AS amount_std,
 round(avg(coalesce(tenure, 0)), 6) AS tenure_mean, round(var_samp(coalesce(tenure, 0)), 6) AS tenure_var,
 round(stddev_samp(coalesce(tenure, 0)), 6) AS tenure_std FROM p""",
    "impute_constant": f"""WITH {P} SELECT entity_id, coalesce(tenure, 30.0e0) AS tenure,
 coalesce(amount, 32.2e0) AS amount, tier, grp, n_side, n_up, site, label FROM p""",
    "impute_mean": f"""WITH {P}, {moments()} SELECT entity_id, label, round(coalesce(amount, m.am), 4) AS amount,
 round(coalesce(tenure, m.tm), 6) AS tenure FROM p, m""",
    "impute_scoring": f"""WITH {P}, tr AS (SELECT * FROM p WHERE {BUCKET} < 8),
 va AS (SELECT * FROM p WHERE {BUCKET} >= 8), {moments('tr')}
 SELECT entity_id, round(coalesce(amount, m.am), 4) AS amount, {SEX} AS grp,
 round(coalesce(tenure, m.tm), 6) AS tenure, tier, n_up, n_side, {PORT} AS site FROM va, m""",
    "standardize": f"""WITH {P}, {moments()} SELECT entity_id,
 round({scaled('coalesce(amount, m.am)', 'm.am', 'm.asd')}, 6) AS amount_z,
 round({scaled('coalesce(tenure, m.tm)', 'm.tm', 'm.tsd')}, 6) AS tenure_z,
 0.0e0 AS const_z FROM p, m""",
    "min_max_scale": f"""WITH {P}, r AS (SELECT min(amount) AS lo, max(amount) AS hi FROM p)
 SELECT entity_id, round((amount - lo) / (hi - lo), 6) AS amount_scaled FROM p, r""",
    "scale_value_literal": f"""WITH {P}, r AS (SELECT min(amount) AS lo, max(amount) AS hi FROM p)
 SELECT entity_id, round((amount - lo) / hi - lo, 6) AS amount_scaled FROM p, r""",
    "feature_columns": f"WITH {P}, {moments()} SELECT entity_id, label, {features()} FROM p, m",
    "labeled_features": f"""WITH {P}, {moments()} SELECT CAST(label AS DOUBLE) AS label, {features()}
 FROM p, m""",
    "keyed_features": f"""WITH {P}, tr AS (SELECT * FROM p WHERE {BUCKET} < 8),
 va AS (SELECT * FROM p WHERE {BUCKET} >= 8), {moments('tr')}
 SELECT entity_id, {features('va')} FROM va, m""",
    "prepare_training": f"""WITH {P}, {moments()} SELECT label, round(coalesce(amount, m.am), 4) AS amount,
 round(coalesce(tenure, m.tm), 6) AS tenure, {SEX} AS grp, tier, {PORT} AS site, n_up, n_side FROM p, m""",
    "prepare_scoring": f"""WITH {P} SELECT entity_id, amount, tenure, {SEX} AS grp, tier, {PORT} AS site,
 n_up, n_side FROM p""",
    "string_index_labels": f"""{EXPORT_FRAME} SELECT input_col, value, idx FROM labels""",
    "string_index_transform": f"""WITH {P},
 counted AS (SELECT 'grp' AS input_col, grp AS value, count(*) AS n FROM p WHERE grp IS NOT NULL GROUP BY grp
   UNION ALL SELECT 'site', site, count(*) FROM p WHERE site IS NOT NULL GROUP BY site),
 labels AS (SELECT input_col, value,
   CAST(row_number() OVER (PARTITION BY input_col ORDER BY n DESC, value) - 1 AS DOUBLE) AS idx FROM counted)
 SELECT p.entity_id, g.idx AS grp_index, s.idx AS site_index FROM p
 JOIN labels g ON g.input_col = 'grp' AND g.value = p.grp
 JOIN labels s ON s.input_col = 'site' AND s.value = p.site""",
    "index_pipeline": f"{EXPORT_FRAME} SELECT * FROM export",
    "hash_split": f"WITH {P} SELECT entity_id, label FROM p WHERE {BUCKET} < 8",
    "random_split": f"""WITH {P}, d AS (SELECT entity_id, label, {DRAW} AS u FROM p)
 SELECT entity_id, label, CASE WHEN u < {TRAIN_SHARE} THEN 0 ELSE 1 END AS part FROM d""",
    "split_copies": f"""WITH {P} SELECT tier, grp, site, CAST(count(*) AS BIGINT) AS n, true AS share_ok
 FROM p GROUP BY tier, grp, site""",
    "string_index_wide": """WITH w AS (SELECT o_orderkey AS entity_id, CASE WHEN o_orderkey % 3 = 0 THEN 'house'
   WHEN o_orderkey % 50 = 1 THEN NULL ELSE 'account-' || o_custkey END AS account FROM orders),
 c AS (SELECT account, count(*) AS n FROM w WHERE account IS NOT NULL GROUP BY account),
 l AS (SELECT account, CAST(row_number() OVER (ORDER BY n DESC, account) - 1 AS DOUBLE) AS account_index FROM c)
 SELECT entity_id, account, account_index FROM w JOIN l USING (account)""",
    "csv_sink_headerless": f"{EXPORT_FRAME} SELECT * FROM export",
    "csv_sink_header": f"""WITH {P} SELECT entity_id, amount, tenure, {SEX} AS grp, tier, {PORT} AS site,
 n_up, n_side FROM p""",
    "preview_head": f"WITH {P} SELECT * FROM p ORDER BY entity_id LIMIT 20",
    "classification_report": f"""WITH {P},
 pred AS (SELECT CAST(label AS DOUBLE) AS l, CASE WHEN grp = 'female' THEN 1.0e0 ELSE 0.0e0 END AS pr FROM p),
 {REPORT}""",
    "constant_fill_export": f"""{EXPORT_FRAME} SELECT *, true AS share_ok FROM export""",
    "mlp_train_score": f"""WITH {P} SELECT entity_id, label, true AS valid, true AS network_ok,
 true AS difference_ok, true AS correct_ok FROM p WHERE {BUCKET} >= 8""",
    "mlp_report": f"""WITH {P} SELECT CAST(count(*) AS BIGINT) AS n_scored, {CHECKS}
 FROM p WHERE {BUCKET} >= 8""",
    "mlp_cv": f"""WITH {P}, t AS (SELECT {FOLD} AS fold FROM p WHERE {BUCKET} < 8),
 k AS (SELECT fold, CAST(count(*) AS BIGINT) AS n FROM t GROUP BY fold),
 s AS (SELECT CAST(count(*) AS BIGINT) AS n FROM t)
 SELECT block_size, max_iter, tol, k.fold, s.n - k.n AS n_train, k.n AS n_validation, true AS metric_ok,
 true AS mean_ok, true AS best_ok, true AS quality_ok
 FROM k, s, (VALUES (32), (64), (128)) b(block_size), (VALUES (10), (50)) i(max_iter),
 (VALUES (1e-2::DOUBLE), (1e-4::DOUBLE), (1e-6::DOUBLE)) g(tol)""",
    "batch_score_export": f"""WITH {P} SELECT CAST(entity_id AS DOUBLE) AS entity_id, true AS valid,
 true AS network_ok, true AS correct_ok FROM p WHERE {BUCKET} >= 8""",
    "train_score_job": f"""WITH {P} SELECT entity_id AS "PassengerId", true AS valid, {CHECKS}
 FROM p WHERE {BUCKET} >= 8""",
    "cv_score_job": f"""WITH {P} SELECT entity_id AS "PassengerId", true AS valid, {CHECKS},
 CAST(18 AS BIGINT) AS n_maps, true AS best_ok FROM p WHERE {BUCKET} >= 8""",
}

# The prepare job's two parts together are exactly the labelled feature table.
ORACLE_SQL["prepare_split"] = f"""WITH {P}, {moments()} SELECT CAST(label AS DOUBLE) AS label, {features()},
 true AS share_ok FROM p, m"""
