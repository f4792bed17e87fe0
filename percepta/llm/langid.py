"""Language identification with hyperdimensional profiles.

Every letter has a random +-1 vector, drawn from its code point alone. An
n-gram's vector binds its letters' vectors (product), each permuted by its
place in the n-gram (rotation). A text's profile bundles (sums) the vectors
of all its n-grams, a language's prototype those of all its training texts.
The language predicted is that of the prototype with the largest cosine.

Scale: training sums profiles per task and language, so the shuffle moves a
few vectors per task, whatever a language's share of the rows. Predicting is
one narrow stage over whole texts for each block of ``MAX_LANGUAGES`` languages;
the driver and the tasks hold the prototypes of one block at a time.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from percepta.llm.common import (
    ROW,
    TEXT,
    add_columns,
    decoded,
    field,
    id_crc,
    materialize,
    small,
    texts_of,
    with_row,
)

DIMENSIONS = 1024
GRAM = 3
SEED = 11
#: Prototypes are shipped to every task, so many languages at a time (16 MB; 32 MB on the driver).
MAX_LANGUAGES = 4096
SLICE_BYTES = 256 << 10
UNKNOWN = "und"

_LETTERS: dict[int, np.ndarray] = {}
_ALPHA: list[np.ndarray] = []


def letter_vector(code: int) -> np.ndarray:
    """The +-1 vector of a code point, the same in every process."""
    if code not in _LETTERS:
        if len(_LETTERS) > 20_000:
            _LETTERS.clear()
        rng = np.random.Generator(np.random.Philox(key=[SEED, code]))
        _LETTERS[code] = (rng.integers(0, 2, DIMENSIONS, dtype=np.int8) * 2 - 1).astype(np.int8)
    return _LETTERS[code]


def _alpha() -> np.ndarray:
    if not _ALPHA:
        _ALPHA.append(np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000))
    return _ALPHA[0]


def grams(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of a few texts: the text and gram number of each n-gram, the grams' letters, has a letter.

    Letters are lower-cased; every run of other characters is one space, and
    a text begins and ends with one.
    """
    low = [f" {t.lower()} " for t in texts]
    code = np.frombuffer("".join(low).encode("utf-32-le", "surrogatepass"), dtype=np.uint32).copy()
    text = np.repeat(np.arange(len(low)), [len(t) for t in low])
    letter = _alpha()[code]
    code[~letter] = 32
    has = np.zeros(len(texts), dtype=bool)
    has[text[letter]] = True
    again = np.zeros(len(code), dtype=bool)
    again[1:] = ~letter[1:] & ~letter[:-1] & (text[1:] == text[:-1])
    code, text = code[~again], text[~again]
    seen = np.zeros(0x110000, dtype=bool)
    seen[code] = True
    letters = np.flatnonzero(seen)
    place = np.zeros(0x110000, dtype=np.int64)
    place[letters] = np.arange(len(letters))
    at = place[code]
    n = max(len(code) - GRAM + 1, 0)
    key = np.zeros(n, dtype=np.int64)
    for j in range(GRAM):
        key = key * len(letters) + at[j : j + n]
    whole = text[:n] == text[GRAM - 1 :] if n else np.zeros(0, dtype=bool)
    key, text = key[whole], text[:n][whole]
    kinds, number = np.unique(key, return_inverse=True)
    parts = []
    for _ in range(GRAM):
        parts.append(letters[kinds % max(len(letters), 1)])
        kinds = kinds // max(len(letters), 1)
    return text, number.ravel(), np.array(parts[::-1]).reshape(GRAM, -1), has


def bundle(counts: np.ndarray, parts: np.ndarray, step: int = 1 << 14) -> np.ndarray:
    """Rows of gram counts to rows of profiles."""
    out = np.zeros((counts.shape[0], DIMENSIONS), dtype=np.float32)
    letters = np.unique(parts)
    table = np.array([letter_vector(int(c)) for c in letters]).reshape(-1, DIMENSIONS)
    turned = [np.roll(table, j, axis=1) for j in range(GRAM)]
    for k in range(0, parts.shape[1], step):
        bound = np.ones((1, DIMENSIONS), dtype=np.int8)
        for j in range(GRAM):
            bound = bound * turned[j][np.searchsorted(letters, parts[j, k : k + step])]
        out += counts[:, k : k + step].astype(np.float32) @ bound.astype(np.float32)
    return out


def _counts(rows: np.ndarray, number: np.ndarray, n_rows: int, n_kinds: int) -> np.ndarray:
    flat = np.bincount(rows * n_kinds + number, minlength=n_rows * n_kinds)
    return flat.reshape(n_rows, n_kinds)


def learn(texts: DataFrame) -> DataFrame:
    """(lang, at, value): the prototypes of rows (``__text``, lang), a row per dimension."""

    def sums_of(total: dict[str, np.ndarray]) -> Iterator[pa.RecordBatch]:
        for name, profile in total.items():
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([name] * DIMENSIONS, pa.string()),
                    pa.array(np.arange(DIMENSIONS), pa.int32()),
                    pa.array(profile, pa.float64()),
                ],
                names=["lang", "at", "value"],
            )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[str, np.ndarray] = {}
        for batch in batches:
            for part in small(batch, SLICE_BYTES):
                langs = part.column(part.schema.get_field_index("lang")).to_pylist()
                names = sorted(set(langs))
                row_of = {x: k for k, x in enumerate(names)}
                found = [decoded(t) for t in texts_of(part)]
                text, number, parts, _ = grams(found)
                of = np.array([row_of[x] for x in langs], dtype=np.int64)
                sums = _counts(of[text], number, len(names), parts.shape[1]) if len(text) else None
                if sums is None:
                    continue
                for name, profile in zip(names, bundle(sums, parts), strict=True):
                    total[name] = total.get(name, 0.0) + profile.astype(np.float64)
                if len(total) > MAX_LANGUAGES:
                    yield from sums_of(total)
                    total = {}
        yield from sums_of(total)

    sums = texts.select(TEXT, "lang").mapInArrow(run, "lang string, at int, value double")
    return sums.groupBy("lang", "at").agg(F.sum("value").alias("value"))


def prototypes(learned: DataFrame, most: int = MAX_LANGUAGES) -> Iterator[tuple[list[str], np.ndarray]]:
    """Languages in order and their unit prototypes, ``most`` at a time; one empty block if none."""
    profiles = learned.groupBy("lang").agg(
        F.sort_array(F.collect_list(F.struct("at", "value"))).alias("profile")
    )
    profiles = materialize(profiles, "prototypes")
    last = None
    while True:
        after = profiles if last is None else profiles.where(F.col("lang") > last)
        rows = after.orderBy("lang").limit(most).collect()
        if rows or last is None:
            matrix = np.array([[x.value for x in r.profile] for r in rows], dtype=np.float64)
            matrix = matrix.reshape(len(rows), DIMENSIONS)
            length = np.linalg.norm(matrix, axis=1, keepdims=True)
            yield [r.lang for r in rows], matrix / np.maximum(length, 1e-12)
        if len(rows) < most:
            return
        last = rows[-1].lang


def nearest(rows: DataFrame, langs: list[str], units: np.ndarray) -> DataFrame:
    """Rows of ``__row``, ``__text``, lang_pred and cosine, with nearer languages of this block put in."""
    shipped = rows.sparkSession.sparkContext.broadcast(units.T.astype(np.float32))

    def compute(batch: pa.RecordBatch) -> dict[str, pa.Array]:
        names, cosines = texts_of(batch, "lang_pred"), texts_of(batch, "cosine")
        at = 0
        for part in small(batch, SLICE_BYTES):
            texts = [decoded(t) for t in texts_of(part)]
            text, number, parts, has = grams(texts)
            counts = _counts(text, number, len(texts), parts.shape[1])
            profile = bundle(counts, parts)
            length = np.maximum(np.linalg.norm(profile, axis=1, keepdims=True), 1e-12)
            cosine = (profile / length) @ shipped.value
            for k in range(len(texts)):
                if has[k] and langs:
                    best = int(cosine[k].argmax())
                    if cosines[at + k] is None or cosine[k, best] > cosines[at + k]:
                        names[at + k], cosines[at + k] = langs[best], float(cosine[k, best])
            at += len(texts)
        return {"lang_pred": pa.array(names, pa.string()), "cosine": pa.array(cosines, pa.float64())}

    fields = [field("lang_pred", T.StringType()), field("cosine", T.DoubleType())]
    return add_columns(rows, compute, fields)


def identify(
    docs: DataFrame,
    train: DataFrame,
    text_col: str = "text",
    lang_col: str = "lang",
    most: int = MAX_LANGUAGES,
) -> DataFrame:
    """``__row``, lang_pred and score of ``docs``, learned from the rows of ``train``.

    Training rows with a null language or text teach nothing. A null text, or
    one without a letter, is ``und`` with score 0, and so is every text if
    nothing was learned. Equal cosines go to the language first in order.
    Repeated rows count each; very long texts are used whole; malformed UTF-8 is
    read as U+FFFD, in languages too; an empty table gives no rows; other columns
    stay inside ``__row``, whatever their names. ``most`` languages are compared
    in one pass over the documents, others in further passes.
    """
    taught = train.select(
        F.col(f"`{text_col}`").cast("binary").alias(TEXT), F.make_valid_utf8(f"`{lang_col}`").alias("lang")
    ).where(F.col("lang").isNotNull() & F.col(TEXT).isNotNull())
    found = None
    for langs, units in prototypes(learn(taught), most):
        if found is None:
            best = F.lit(None).cast("string"), F.lit(None).cast("double")
            rows = with_row(docs, text_col, best[0].alias("lang_pred"), best[1].alias("cosine"))
        else:
            text = F.col(f"{ROW}.`{text_col}`").cast("binary").alias(TEXT)
            rows = materialize(found, "nearest").select(ROW, text, "lang_pred", "cosine")
        found = nearest(rows, langs, units)
    score = F.least(F.greatest(F.coalesce("cosine", F.lit(0.0)), F.lit(0.0)), F.lit(1.0))
    return found.select(ROW, F.coalesce("lang_pred", F.lit(UNKNOWN)).alias("lang_pred"), score.alias("score"))


def language_report(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score; learned where crc32(doc_id) mod 4 is not 2."""
    held_out = id_crc("doc_id") % 4 == 2
    found = identify(docs.select("doc_id", "text"), docs.where(~held_out))
    return found.select(
        F.col(f"{ROW}.doc_id").alias("doc_id"),
        (id_crc(F.col(f"{ROW}.doc_id")) % 4 == 2).alias("held_out"),
        "lang_pred",
        "score",
    )
