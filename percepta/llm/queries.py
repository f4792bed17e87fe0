"""The registered queries of the training-data operators and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from percepta.llm import (
    chat,
    dartminhash,
    decontam,
    host_rules,
    langid,
    mixing,
    ranking,
    repeats,
    resampling,
    secretscan,
    tokencount,
    urlfilter,
    whitening,
)
from percepta.llm.common import importable


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    importable(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{table}.parquet")


def op1_wu_manber(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.contamination_report(
        _read(spark, sf_dir, "documents"), _read(spark, sf_dir, "benchmark")
    )


def op2_host_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return host_rules.host_quality(_read(spark, sf_dir, "documents"))


def op3_hyperdimensional(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.language_report(_read(spark, sf_dir, "documents"))


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokencount.token_report(_read(spark, sf_dir, "documents"))


def op5_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urlfilter.url_report(_read(spark, sf_dir, "pages"))


def op6_dart_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dartminhash.near_report(_read(spark, sf_dir, "documents"))


def op7_suffix_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.repeat_report(_read(spark, sf_dir, "documents"))


def op8_prefix_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.chat_report(spark, _read(spark, sf_dir, "conversations"))


def op9_water_filling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_report(_read(spark, sf_dir, "documents"))


def op10_bradley_terry(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranking.quality_report(
        _read(spark, sf_dir, "documents"), _read(spark, sf_dir, "labels")
    )


def op11_block_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whitening_report(_read(spark, sf_dir, "embeddings"))


def op12_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resampling.resample_report(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "benchmark"))


def op13_randomness_battery(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secretscan.secret_report(_read(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_wu_manber,
        op2_host_rules,
        op3_hyperdimensional,
        op4_token_counts,
        op5_url_rules,
        op6_dart_minhash,
        op7_suffix_repeats,
        op8_prefix_tree,
        op9_water_filling,
        op10_bradley_terry,
        op11_block_whitening,
        op12_importance_resampling,
        op13_randomness_battery,
    )
}

OP1_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents),
b AS (
  SELECT coalesce(CAST(item_id AS VARCHAR), 'null') AS item,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark),
bp AS (
  SELECT item, w, least(10, len(w)) AS n, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS p
  FROM b WHERE len(w) > 0),
bw AS (SELECT DISTINCT item, n, array_to_string(list_slice(w, p, p + n - 1), ' ') AS s FROM bp),
ln AS (SELECT DISTINCT n FROM bw),
dp AS (
  SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS p FROM d, ln WHERE len(w) >= n),
hit AS (
  SELECT dp.r, dp.p, dp.n, bw.item FROM dp
  JOIN bw ON bw.n = dp.n AND bw.s = array_to_string(list_slice(dp.w, dp.p, dp.p + dp.n - 1), ' ')),
pos AS (SELECT r, count(DISTINCT q) AS n_hit FROM (SELECT DISTINCT r, unnest(range(p, p + n)) AS q FROM hit) GROUP BY r),
it AS (SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids FROM (SELECT DISTINCT r, item FROM hit) GROUP BY r)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, coalesce(pos.n_hit, 0) AS n_hit,
  coalesce(it.n_items, 0) AS n_items, sha256(coalesce(it.ids, '')) AS items_sha256,
  coalesce(pos.n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN pos USING (r) LEFT JOIN it USING (r)
"""

OP2_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, source AS host, coalesce(text, '') AS text,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
p AS (SELECT r, w, unnest(range(1, len(w) - 6)) AS i FROM d WHERE len(w) >= 8),
g AS (SELECT r, i, array_to_string(list_slice(w, i, i + 7), ' ') AS s FROM p),
t AS (SELECT r, i, count(*) OVER (PARTITION BY r, s) AS c FROM g),
rep AS (SELECT r, count(DISTINCT q) AS n FROM (SELECT r, unnest(range(i, i + 8)) AS q FROM t WHERE c > 1) GROUP BY r),
l AS (
  SELECT r, count(*) AS n_lines, count(DISTINCT x) AS kinds
  FROM (SELECT r, unnest(string_split(text, chr(10))) AS x FROM d)
  WHERE regexp_matches(x, '[^\x20\x09-\x0D]') GROUP BY r),
m AS (
  SELECT d.doc_id, d.host, CAST(len(d.w) AS BIGINT) AS n_words,
    CAST(length(array_to_string(d.w, '')) AS BIGINT) AS word_chars,
    CAST(len(regexp_extract_all(d.text, '[#*$%&|<>]')) AS BIGINT) AS n_symbols,
    coalesce(l.n_lines, 0) AS n_lines, coalesce(l.n_lines - l.kinds, 0) AS n_dup_lines,
    coalesce(rep.n, 0) AS n_repeat_words
  FROM d LEFT JOIN rep USING (r) LEFT JOIN l USING (r)),
f AS (
  SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
    n_words < 20 OR 100 * n_repeat_words > 30 * n_words OR 10 * n_symbols > n_words
      OR 2 * n_dup_lines > n_lines OR word_chars < 2 * n_words OR word_chars > 15 * n_words AS failed
  FROM m),
h AS (SELECT host, count(*) AS n, sum(CAST(failed AS INTEGER)) AS bad FROM f GROUP BY host),
s AS (
  SELECT count(*) AS k, CAST(sum(n) AS DOUBLE) AS n, CAST(sum(bad) AS DOUBLE) AS bad,
    sum(CAST(bad AS DOUBLE) * bad / n) AS ff, sum(CAST(n AS DOUBLE) * n) AS nn FROM h),
a AS (
  SELECT *, bad / n AS mean, bad / n * (1 - bad / n) AS noise,
    bad / n * (1 - bad / n) * (n - nn / n - (k - 1)) AS room FROM s),
c AS (
  SELECT mean, CASE WHEN k > 1 AND room > 0 THEN
    least(greatest((ff - n * mean * mean - noise * (k - 1)) / room, 1 / (1 + n)), 0.999) END AS spread FROM a),
e AS (SELECT mean, CASE WHEN spread IS NULL THEN 1.0 ELSE (1 - spread) / spread END AS strength FROM c),
v AS (SELECT host, (bad + mean * strength) / (n + strength) > 0.5 AS host_rejected FROM h, e)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT failed AND NOT host_rejected AS kept, host_rejected
FROM f JOIN v ON f.host IS NOT DISTINCT FROM v.host
"""

OP5_SQL = r"""
WITH u AS (
  SELECT page_id, coalesce(url, '') AS url, instr(coalesce(url, ''), '://') AS mark FROM pages),
r AS (SELECT page_id, CASE WHEN mark > 0 THEN substr(url, mark + 3) ELSE '' END AS rest FROM u),
x AS (
  SELECT page_id,
    translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM r),
rules(rule, verdict, h, p) AS (VALUES
  ('net/', 'block', 'net', '/'), ('example.net/en/', 'allow', 'example.net', '/en/'),
  ('example.com/de/', 'block', 'example.com', '/de/'), ('org/fr/', 'allow', 'org', '/fr/')),
words(word, i) AS (VALUES
  ('adult', 0), ('ads', 1), ('bets', 2), ('casino', 3), ('pills', 4), ('poker', 5), ('porn', 6), ('spam', 7), ('viagra', 8),
  ('xxx', 9)),
helps(near, j) AS (VALUES
  ('addiction', 0), ('awareness', 1), ('filter', 2), ('help', 3), ('prevention', 4), ('support', 5)),
lures(lure, i) AS (VALUES ('cheap', 0), ('earn', 1), ('fast', 2), ('free', 3), ('hot', 4), ('online', 5), ('win', 6)),
goods(good, j) AS (VALUES ('cash', 0), ('gift', 1), ('loans', 2), ('meds', 3), ('money', 4), ('prize', 5), ('singles', 6)),
shapes(says, place, pattern, inside) AS (
  SELECT 'block', i, '^' || word || '^', word FROM words
  UNION ALL SELECT 'allow', 100 + 10 * i + j, '^' || word || '^' || near || '^', word || '[^A-Za-z0-9]' || near
  FROM words, helps
  UNION ALL SELECT 'block', 1000 + 20 * i + 2 * j, '^' || lure || '^' || good || '^', lure || '[^A-Za-z0-9]' || good
  FROM lures, goods
  UNION ALL SELECT 'block', 1001 + 20 * i + 2 * j, '^' || lure || '^*^' || good || '^',
    lure || '[^A-Za-z0-9].*[^A-Za-z0-9]' || good FROM lures, goods),
fit AS (
  SELECT page_id, max_by(rule, length(rule)) AS rule, max_by(verdict, length(rule)) AS verdict
  FROM x, rules WHERE (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p) GROUP BY page_id),
pat AS (
  SELECT page_id, max_by(pattern, length(pattern) * 10000 - place) AS pattern, max_by(says, length(pattern) * 10000 - place) AS says
  FROM x, shapes
  WHERE regexp_matches(host || path, '(?s)(^|[^A-Za-z0-9])' || inside || '([^A-Za-z0-9]|$)') GROUP BY page_id)
SELECT x.page_id, host, path, fit.rule AS rule, coalesce(fit.verdict, pat.says, 'allow') AS verdict,
  CASE WHEN fit.rule IS NULL THEN pat.pattern END AS pattern
FROM x LEFT JOIN fit USING (page_id) LEFT JOIN pat USING (page_id)
"""

OP9_SQL = r"""
WITH d AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
    md5(concat_ws('|', 'mix-1', coalesce(CAST(doc_id AS VARCHAR), ''), md5(coalesce(text, '')))) AS hash
  FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
w AS (
  SELECT *, [5, 2, 1][CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS INTEGER) + 1] AS weight FROM s),
o AS (
  SELECT *, row_number() OVER q AS k,
    coalesce(sum(2 * source_size) OVER (q ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS used,
    coalesce(sum(weight) OVER (q ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS gone
  FROM w WINDOW q AS (ORDER BY CAST(2 * source_size AS DOUBLE) / weight, source NULLS LAST)),
t AS (SELECT CAST(sum(source_size) AS DOUBLE) AS total, CAST(sum(weight) AS DOUBLE) AS weight FROM w),
lv AS (
  SELECT min_by(level, k) AS level FROM (
    SELECT k, o.weight, source_size, (1.5 * total - CAST(used AS DOUBLE)) / (t.weight - CAST(gone AS DOUBLE)) AS level
    FROM o, t) WHERE weight * level <= 2 * source_size),
g AS (SELECT source, source_size, least(weight * coalesce(level, 0.0), CAST(2 * source_size AS DOUBLE)) AS target FROM w, lv),
h AS (
  SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target / source_size) AS BIGINT) ELSE 0 END AS whole FROM g),
r AS (SELECT *, CAST(floor(target - whole * source_size + 0.5) AS BIGINT) AS room FROM h),
c AS (
  SELECT d.doc_id, d.source, d.size, d.hash, coalesce(CAST(sum(d.size) OVER (
    PARTITION BY d.source ORDER BY d.hash, d.doc_id, d.size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS BIGINT), 0) AS before
  FROM d)
SELECT c.doc_id, c.size, r.source_size, r.target,
  whole * c.size + greatest(0, least(c.size, room - before)) AS taken
FROM c JOIN r ON c.source IS NOT DISTINCT FROM r.source
"""

OP12_SQL = r"""
WITH rem AS (
  SELECT list(list_reduce([k, 0, 0, 0, 0, 0, 0, 0, 0],
    lambda c, x: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY k) AS t
  FROM (SELECT CAST(unnest(range(256)) AS BIGINT) AS k)),
d AS (
  SELECT row_number() OVER () AS r, doc_id,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents),
b AS (
  SELECT regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark),
raw AS (
  SELECT r, unnest(list_concat(w, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))) AS f FROM d
  UNION ALL
  SELECT 0, unnest(list_concat(w, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))) FROM b),
many AS (SELECT r, f, count(*) AS n FROM raw GROUP BY r, f),
hexed AS (SELECT f, hex(f) AS h FROM (SELECT DISTINCT f FROM many)),
bytes AS (
  SELECT f, list_transform(range(0, len(h) // 2),
    lambda i: CAST('0x' || substr(h, CAST(2 * i + 1 AS INT), 2) AS BIGINT)) AS v FROM hexed),
crc AS (
  SELECT f, xor(4294967295, list_reduce(list_prepend(CAST(4294967295 AS BIGINT), v),
    lambda c, x: xor(t[(xor(c, x) & 255) + 1], c >> 8))) % 10000 AS k FROM bytes, rem),
bn AS (SELECT r, k, CAST(sum(n) AS BIGINT) AS n FROM many JOIN crc USING (f) GROUP BY r, k),
st AS (
  SELECT k, CAST(coalesce(sum(n) FILTER (r > 0), 0) AS DOUBLE) AS s, CAST(coalesce(sum(n) FILTER (r = 0), 0) AS DOUBLE) AS t
  FROM bn GROUP BY k),
tot AS (SELECT sum(s) AS ss, sum(t) AS tt FROM st),
g AS (SELECT k, CAST(floor(1000 * ln((t + 1) * (ss + 10000) / ((s + 1) * (tt + 10000)))) AS BIGINT) AS gain FROM st, tot),
dw AS (SELECT r, sum(n) AS n, sum(n * gain) AS total FROM bn JOIN g USING (k) WHERE r > 0 GROUP BY r),
sc AS (
  SELECT d.doc_id, len(d.w) AS words, CAST(coalesce(n, 0) AS BIGINT) AS n_features,
    coalesce(CAST(floor(CAST(total AS DOUBLE) / n) AS BIGINT), 0) AS weight,
    CAST('0x' || substr(sha256('7:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 8) AS BIGINT) AS h
  FROM d LEFT JOIN dw USING (r)),
sd AS (
  SELECT *, weight + CAST(floor(-1000 * ln(-ln((h + 0.5e0) / 4294967296))) AS BIGINT) AS score FROM sc),
rk AS (
  SELECT *, row_number() OVER (PARTITION BY words >= 20 ORDER BY score DESC, doc_id NULLS LAST) AS place,
    count(*) OVER (PARTITION BY words >= 20) AS n FROM sd)
SELECT doc_id, n_features, weight, score, CASE WHEN words >= 20 AND place <= 25 * n // 100 THEN place END AS rank FROM rk
"""

ORACLE_SQL: dict[str, str] = {
    "op1_wu_manber": OP1_SQL,
    "op2_host_rules": OP2_SQL,
    "op5_url_rules": OP5_SQL,
    "op9_water_filling": OP9_SQL,
    "op12_importance_resampling": OP12_SQL,
}
