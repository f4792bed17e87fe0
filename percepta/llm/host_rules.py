"""Quality rules on the level of hosts.

Each document is measured over its whole text and tried by a few rules. The
failures are summed by host; each host's failure rate is shrunk towards a
beta prior whose two parameters are estimated from all hosts (moments of the
beta-binomial). A host whose shrunk rate is above ``max_rate`` is rejected
with all its documents, and its verdict is joined back to them; at the other
hosts a document is judged by its own rules.

Scale: measuring is narrow (one pass over the text, which goes no further);
the sums by host are combined per task before the shuffle; the prior is one
aggregate row; the join carries a few numbers per document, and a host with a
third of all rows is split by the adaptive skew join.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from percepta.llm.common import ROW, add_columns, decoded, field, materialize, texts_of, with_row

SYMBOLS = b"#*$%&|<>"
SPACES = b" \t\n\r\x0b\x0c"
MIN_WORDS = 20
REPEAT_WINDOW = 8
MAX_RATE = 0.5
_NOT_SYMBOL = bytes(c for c in range(256) if c not in SYMBOLS)
_HAS_WORD = re.compile(rb"[^\x20\x09-\x0D]")

MEASURES = (
    "n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words",
)


def repeat_words(words: list[bytes], window: int = REPEAT_WINDOW) -> int:
    """Words inside windows of ``window`` words that occur twice or more in the list."""
    n = len(words) - window + 1
    if n < 2:
        return 0
    number: dict[bytes, int] = {}
    ids = np.array([number.setdefault(w, len(number)) for w in words], dtype=np.int32)
    key = np.zeros(n, dtype=np.uint64)
    for j in range(window):
        key = key * np.uint64(0x9E3779B97F4A7C15) + ids[j : j + n].astype(np.uint64)
    ranked = np.sort(key)
    if not (ranked[1:] == ranked[:-1]).any():
        return 0
    rows = np.ascontiguousarray(np.lib.stride_tricks.sliding_window_view(ids, window))
    _, which, count = np.unique(
        rows.view(f"V{4 * window}").ravel(), return_inverse=True, return_counts=True
    )
    edge = np.zeros(len(words) + 1, dtype=np.int64)
    at = np.flatnonzero(count[which.ravel()] > 1)
    np.add.at(edge, at, 1)
    np.add.at(edge, at + window, -1)
    return int((np.cumsum(edge) > 0).sum())


def measure(text: bytes | None) -> tuple[int, ...]:
    """The ``MEASURES`` of one text; a null text has no words and no lines.

    Malformed UTF-8 counts as the characters U+FFFD that it decodes to.
    """
    if not text:
        return (0,) * len(MEASURES)
    words = text.split()
    solid = len(text.translate(None, SPACES))
    chars = solid if text.isascii() else len(decoded(text)) - (len(text) - solid)
    lines = [x for x in text.split(b"\n") if _HAS_WORD.search(x)]
    return (
        len(words),
        chars,
        len(text.translate(None, _NOT_SYMBOL)),
        len(lines),
        len(lines) - len(set(lines)),
        repeat_words(words),
    )


def document_measures(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``__row`` and the six ``MEASURES`` of every document."""

    def compute(batch: pa.RecordBatch) -> dict[str, pa.Array]:
        columns = zip(*map(measure, texts_of(batch)), strict=True) if batch.num_rows else [[]] * 6
        return {k: pa.array(list(v), pa.int64()) for k, v in zip(MEASURES, columns, strict=True)}

    return add_columns(
        with_row(docs, text_col), compute, [field(k, T.LongType()) for k in MEASURES]
    )


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))


def rule_failed() -> Column:
    """Fails the base rule, has a symbol for ten words, half its lines again, or odd word lengths."""
    return (
        base_failed()
        | (10 * F.col("n_symbols") > F.col("n_words"))
        | (2 * F.col("n_dup_lines") > F.col("n_lines"))
        | (F.col("word_chars") < 2 * F.col("n_words"))
        | (F.col("word_chars") > 15 * F.col("n_words"))
    )


def host_rates(failures: DataFrame, max_rate: float = MAX_RATE) -> DataFrame:
    """host, n_docs, n_failed, rate (shrunk), host_rejected from rows of (host, failed).

    The prior's mean is the overall rate; its strength comes from how much
    more the hosts' rates spread than binomial draws would. Hosts that spread
    no more are pooled as strongly as all rows together; with one host, or
    all rows alike, the prior counts as one document. A null host is a host.
    """
    hosts = materialize(
        failures.groupBy("host").agg(
            F.count(F.lit(1)).alias("n_docs"),
            F.sum(F.col("failed").cast("long")).alias("n_failed"),
        ),
        "hosts",
    )
    s = hosts.agg(
        F.count(F.lit(1)).alias("k"),
        F.sum("n_docs").alias("n"),
        F.sum("n_failed").alias("f"),
        F.sum(F.col("n_failed").cast("double") * F.col("n_failed") / F.col("n_docs")).alias("ff"),
        F.sum(F.col("n_docs").cast("double") * F.col("n_docs")).alias("nn"),
    ).first()
    mean, strength = 0.0, 1.0
    if s.n:
        mean = s.f / s.n
        noise = mean * (1 - mean)
        room = noise * (s.n - s.nn / s.n - (s.k - 1))
        if s.k > 1 and room > 0:
            spread = (s.ff - s.n * mean * mean - noise * (s.k - 1)) / room
            spread = min(max(spread, 1 / (1 + s.n)), 0.999)
            strength = (1 - spread) / spread
    rate = (F.col("n_failed") + F.lit(mean * strength)) / (F.col("n_docs") + F.lit(strength))
    return hosts.withColumn("rate", rate).withColumn("host_rejected", F.col("rate") > max_rate)


def judge_hosts(
    docs: DataFrame,
    id_col: str = "doc_id",
    host_col: str = "source",
    text_col: str = "text",
    max_rate: float = MAX_RATE,
) -> DataFrame:
    """id, host, MEASURES, base_failed, failed, host_rejected, rate, kept of each document.

    ``kept``: passes every rule, at a host that is not rejected. A null text
    has no words and so fails; repeated rows are judged and counted each;
    documents with a null host share one; an empty table gives no rows. Very long
    texts are measured whole; malformed UTF-8 counts as U+FFFD. Other columns are
    ignored, whatever their names.
    """
    measured = materialize(
        document_measures(docs, text_col).select(
            F.col(f"{ROW}.`{id_col}`").alias("id"),
            F.col(f"{ROW}.`{host_col}`").alias("host"),
            *MEASURES,
            base_failed().alias("base_failed"),
            rule_failed().alias("failed"),
        ),
        "measures",
    )
    hosts = host_rates(measured, max_rate).withColumnRenamed("host", "of_host")
    return (
        measured.join(hosts, F.col("host").eqNullSafe(F.col("of_host")), "left")
        .withColumn("kept", ~F.col("failed") & ~F.col("host_rejected"))
        .drop("of_host")
    )


def host_quality(docs: DataFrame) -> DataFrame:
    """The digest of the query: the measures, base_failed and kept by doc_id."""
    return judge_hosts(docs).select(
        F.col("id").alias("doc_id"),
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        "kept",
        "host_rejected",
    )
