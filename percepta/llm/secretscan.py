"""Secrets in texts: fixed patterns, and runs of characters that pass tests of randomness.

Patterns find assignments to a secret's name, access keys and long runs of hex digits.
Beside them, each run of ``LEAST`` or more characters of the common encodings is a
candidate. Its encoding is the smallest alphabet that holds it, and the battery asks
whether it could be uniform over that alphabet:

* chi-squared of its symbols, and of its digits, capitals, small letters and signs;
* runs of the lower and the upper half of the alphabet;
* serial correlation of neighbours, on the four quarters of the alphabet.

Fisher's method makes one p value of the four. A candidate below ``LEAST_P`` is not random.
Of the rest, false discoveries are runs of ordinary text, so each candidate has a
decoy: as many letters and digits from the text around it, through the same tests. In a
stratum of length, a threshold is passed by so many candidates and so many decoys, and
the share of decoys estimates that of false discoveries; the lowest threshold
with a share of ``FALSE_SHARE`` at most holds. So a short run, which ordinary text
can imitate, must look more random than a long one.

DataFrame functions alone. Scale: the texts are read once, in a narrow stage that
writes the matches; sums that give their places, and the tests, work on matches. The
thresholds come from at most 1,000 counts. All that is grouped belongs to one document.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from percepta.llm.common import ROW, materialize

KINDS = ("assign", "access", "hex", "random")
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]{24,}"  # what [0-9a-f]+ finds, of 24 characters or more
CANDIDATE = r"(?<![A-Za-z0-9+/_-])([A-Za-z0-9+/_-]{20,})={0,2}"
LEAST_VALUE, LEAST_ACCESS, LEAST = 6, 20, 20
LEAST_P = 0.01
FALSE_SHARE = 0.05
#: Lengths at which a stratum begins.
STRATA = (20, 24, 32, 48, 96)
BINS = 100

#: Name, pattern of the strings, whether they are put in small letters, alphabet: the smallest first.
ENCODINGS = (
    ("hex", r"^([0-9a-f]+|[0-9A-F]+)$", True, string.hexdigits[:16]),
    ("base32", r"^[A-Z2-7]+$", False, string.ascii_uppercase + "234567"),
    ("base36", r"^([0-9a-z]+|[0-9A-Z]+)$", True, string.digits + string.ascii_lowercase),
    ("base62", r"^[0-9A-Za-z]+$", False, string.digits + string.ascii_uppercase + string.ascii_lowercase),
    ("base64", r"^[0-9A-Za-z+/]+$", False, string.digits + string.ascii_uppercase + string.ascii_lowercase + "+/"),
    ("base64url", r"^[0-9A-Za-z_-]+$", False, string.digits + string.ascii_uppercase + string.ascii_lowercase + "-_"),
)
CLASSES = ("0-9", "A-Z", "a-z", "+/_-")
#: Normal tail, Abramowitz and Stegun 26.2.17.
TAIL = (0.319381530, -0.356563782, 1.781477937, -1.821255978, 1.330274429)
TAIL_T, ROOT_2PI = 0.2316419, 2.5066282746310002


def _pieces(text: Column, pattern: str, value: Column, ok) -> Column:
    """For each match: the characters before it since the last one, its size, whether it counts, value and context."""
    gaps = F.split(text, pattern, -1)
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    zipped = F.arrays_zip(
        gaps.alias("gap"), found.alias("match"), value.alias("value"), F.slice(gaps, 2, F.size(found)).alias("next")
    )
    return F.transform(F.slice(zipped, 1, F.size(found)), ok)


def _match(kind: int, ok, around: bool = False):
    def make(m: Column) -> Column:
        size = F.length(m["match"])
        none = F.lit(None).cast("string")
        reach = 4 * F.length(m["value"]) + 64
        context = F.concat(F.right(m["gap"], reach), F.left(m["next"], reach))
        plain = F.regexp_replace(context, "[^A-Za-z0-9]", "")
        return F.struct(
            F.lit(kind).alias("kind"),
            F.length(m["gap"]).cast("long").alias("gap"),
            size.cast("long").alias("size"),
            ok(m, size).alias("ok"),
            (m["value"] if around else none).alias("value"),
            (F.left(plain, F.length(m["value"])) if around else none).alias("decoy"),
        )

    return make


def matches(text: Column) -> Column:
    """All matches of all kinds in a text, each kind in its order."""
    groups = (
        (ASSIGN, 2, lambda m, size: F.length(m["value"]) >= LEAST_VALUE),
        (ACCESS, 0, lambda m, size: size >= LEAST_ACCESS),
        (HEX, 0, lambda m, size: F.lit(True)),
        (CANDIDATE, 1, lambda m, size: F.lit(True)),
    )
    none = F.lit(None).cast("array<struct<kind:int,gap:bigint,size:bigint,ok:boolean,value:string,decoy:string>>")
    lists = []
    for kind, (pattern, group, ok) in enumerate(groups):
        value = F.regexp_extract_all(text, F.lit(pattern), F.lit(group))
        found = _pieces(text, pattern, value, _match(kind, ok, around=KINDS[kind] == "random"))
        # Most texts have no match: one look at the text, and nothing else.
        lists.append(F.when(text.rlike(pattern), found).otherwise(none))
    return F.flatten(F.filter(F.array(*lists), lambda x: x.isNotNull()))


def _replaced(text: Column, part: Column | str) -> Column:
    """How often ``part`` (one that cannot overlap itself) is in ``text``."""
    part = F.lit(part) if isinstance(part, str) else part
    return (F.length(text) - F.length(F.replace(text, part, F.lit("")))) / F.length(part)


def _tail(z: Column) -> Column:
    """P(normal > z)."""
    t = 1 / (1 + TAIL_T * F.abs(z))
    poly = F.lit(0.0)
    for b in reversed(TAIL):
        poly = (poly + b) * t
    upper = F.exp(-z * z / 2) / ROOT_2PI * poly
    return F.when(z >= 0, upper).otherwise(1 - upper)


def _chi_tail(x: Column, df: Column) -> Column:
    """P(chi-squared > x), by Wilson and Hilferty's cube root."""
    spread = 2 / (9 * df)
    return _tail((F.pow(x / df, F.lit(1.0 / 3)) - (1 - spread)) / F.sqrt(spread))


def _by_encoding(encoding: Column, values: list) -> Column:
    out = F.lit(values[-1])
    for (name, *_), value in reversed(list(zip(ENCODINGS, values, strict=True))[:-1]):
        out = F.when(encoding == name, F.lit(value)).otherwise(out)
    return out


def battery(rows: DataFrame, column: str, out: str) -> DataFrame:
    """``rows`` with ``out``: the p value of the string being uniform over its encoding; 0 if it has none.

    Null for null and for a single character, which no test can judge.
    """
    names = [f"{out}_{k}" for k in ("encoding", "s", "n", "abc", "half", "quarter", "sums", "chi", "class", "runs", "serial")]
    encoding, s, n, abc, half, quarter, sums, chi, kinds, runs, serial = names
    inferred = F.lit(None).cast("string")
    for name, pattern, _, _ in reversed(ENCODINGS):
        inferred = F.when(F.col(column).rlike(pattern), F.lit(name)).otherwise(inferred)
    alphabets = [e[3] for e in ENCODINGS]
    sizes = [len(a) for a in alphabets]
    rows = rows.withColumn(encoding, inferred)
    small = _by_encoding(F.col(encoding), [e[2] for e in ENCODINGS])
    told = F.col(encoding).isNotNull() & (F.length(column) > 1)
    rows = rows.withColumn(s, F.when(told, F.when(small, F.lower(column)).otherwise(F.col(column))))
    rows = rows.withColumn(n, F.length(s).cast("double"))
    rows = rows.withColumn(abc, _by_encoding(F.col(encoding), alphabets))
    k = _by_encoding(F.col(encoding), [float(x) for x in sizes])
    halves = ["".join(str(2 * j // len(a)) for j in range(len(a))) for a in alphabets]
    quarters = ["".join(str(4 * j // len(a)) for j in range(len(a))) for a in alphabets]
    rows = rows.withColumn(half, F.call_function("translate", F.col(s), F.col(abc), _by_encoding(F.col(encoding), halves)))
    rows = rows.withColumn(
        quarter, F.call_function("translate", F.col(s), F.col(abc), _by_encoding(F.col(encoding), quarters))
    )
    count = F.aggregate(
        F.split(abc, ""), F.lit(0.0), lambda total, c: total + F.pow(_replaced(F.col(s), c), F.lit(2.0))
    )
    rows = rows.withColumn(chi, _chi_tail(k / F.col(n) * count - F.col(n), k - 1))
    # Classes of symbols: digits, capitals, small letters, signs.
    x, used = F.lit(0.0), F.lit(-1.0)
    for chars in CLASSES:
        inside = {c for a in alphabets for c in a if _in_class(c, chars)}
        share = _by_encoding(F.col(encoding), [sum(c in inside for c in a) / len(a) for a in alphabets])
        seen = F.length(F.regexp_replace(s, f"[^{chars}]", ""))
        expected = F.col(n) * share
        x = x + F.when(share > 0, F.pow(seen - expected, F.lit(2.0)) / expected).otherwise(0.0)
        used = used + F.when(share > 0, 1.0).otherwise(0.0)
    rows = rows.withColumn(kinds, _chi_tail(x, used))
    changes = _replaced(F.col(half), "01") + _replaced(F.col(half), "10")
    z = (changes - (F.col(n) - 1) / 2) / (F.sqrt(F.col(n) - 1) / 2)
    rows = rows.withColumn(runs, 2 * _tail(F.abs(z)))
    # Pairs of different quarters are counted; pairs of equal ones are what is left of a quarter's places.
    q, last = F.col(quarter), F.right(quarter, F.lit(1))
    first = F.left(quarter, F.lit(1))
    products, whole = F.lit(0.0), F.lit(0.0)
    for a in "123":
        same = _replaced(q, a) - F.when(last == a, 1.0).otherwise(0.0)
        whole = whole + int(a) * _replaced(q, a)
        for b in "0123":
            if a != b:
                pair = _replaced(q, a + b)
                same = same - pair
                products = products + int(a) * int(b) * pair
        products = products + int(a) * int(a) * same
    moments = [_moments([4 * j // size for j in range(size)]) for size in sizes]
    mean = _by_encoding(F.col(encoding), [m for m, _ in moments])
    variance = _by_encoding(F.col(encoding), [v for _, v in moments])
    ends = 2 * whole - first.cast("double") - last.cast("double")
    rows = rows.withColumn(sums, products - mean * ends + (F.col(n) - 1) * mean * mean)
    rows = rows.withColumn(serial, 2 * _tail(F.abs(F.col(sums) / (variance * F.sqrt(F.col(n) - 1)))))
    fisher = F.lit(0.0)
    for p in (chi, kinds, runs, serial):
        fisher = fisher - F.log(F.greatest(F.least(F.col(p), F.lit(1.0)), F.lit(1e-300)))
    rows = rows.withColumn(sums, fisher)
    f = F.col(sums)
    p = F.exp(-f) * (1 + f + f * f / 2 + f * f * f / 6)
    value = F.when(F.col(column).isNotNull(), F.when(F.col(encoding).isNotNull(), p).otherwise(0.0))
    return rows.withColumn(out, value).drop(*names)


def _in_class(c: str, chars: str) -> bool:
    return c in chars if chars[1] != "-" else chars[0] <= c <= chars[2]


def _moments(values: list[int]) -> tuple[float, float]:
    mean = sum(values) / len(values)
    return mean, sum((v - mean) ** 2 for v in values) / len(values)


def thresholds(tested: DataFrame) -> DataFrame:
    """(stratum, least): the lowest bin of p from which decoys are ``FALSE_SHARE`` of the candidates, or less.

    A stratum without decoys, or without such a bin, has no row.
    """
    places = F.explode(
        F.array(
            F.struct(F.lit(1).alias("target"), F.lit(0).alias("decoy"), F.col("bin")),
            F.struct(F.lit(0).alias("target"), F.lit(1).alias("decoy"), F.col("decoy_bin").alias("bin")),
        )
    )
    counts = tested.where("bin IS NOT NULL").select("stratum", places.alias("c")).where("c.bin IS NOT NULL")
    counts = counts.groupBy("stratum", F.col("c.bin").alias("bin")).agg(
        F.sum("c.target").alias("targets"), F.sum("c.decoy").alias("decoys")
    )
    # At most 5 strata of 100 bins.
    above = Window.partitionBy("stratum").orderBy(F.desc("bin"))
    every = Window.partitionBy("stratum")
    share = F.sum("decoys").over(above) * F.sum("targets").over(every)
    least = F.sum("targets").over(above) * F.sum("decoys").over(every) * F.lit(FALSE_SHARE)
    counts = counts.withColumn("holds", (share <= least) & (F.sum("decoys").over(every) > 0))
    return counts.where(F.col("holds") & (F.col("bin") >= int(LEAST_P * BINS)) & (F.col("targets") > 0)).groupBy(
        "stratum"
    ).agg(F.min("bin").alias("least"))


def find_secrets(docs: DataFrame, text_col: str = "text", keep: tuple[str, ...] | None = None) -> DataFrame:
    """``__row`` (the ``keep`` columns; default all) and ``spans`` of every document.

    ``spans``: (start, rank, kind, end) by start, then kind as listed in ``KINDS``; code points, end exclusive;
    empty if there are none. One place can have spans of several kinds. Null and empty texts have none; bytes
    that are no UTF-8 count as replacement characters; texts are scanned whole, whatever their length;
    rows that repeat are judged each for itself; an empty table gives no rows.
    """
    kept = F.struct(*[F.col(f"`{c}`") for c in (keep or docs.columns)]).alias(ROW)
    text = F.make_valid_utf8(F.coalesce(F.col(f"`{text_col}`"), F.lit("")))
    found = docs.select(kept, text.alias("text")).select(ROW, matches(F.col("text")).alias("found"))
    found = materialize(found.withColumn("rid", F.monotonically_increasing_id()), "found")
    marks = found.select("rid", F.posexplode("found").alias("at", "m")).select("rid", "at", "m.*")
    marks = battery(battery(marks, "value", "p"), "decoy", "decoy_p")

    def binned(p: str) -> Column:
        return F.least(F.floor(F.col(p) * BINS), F.lit(BINS - 1)).cast("int")

    size = F.length("value")
    stratum = F.lit(len(STRATA) - 1)
    for k in range(len(STRATA) - 2, -1, -1):
        stratum = F.when(size < STRATA[k + 1], F.lit(k)).otherwise(stratum)
    full = F.length("decoy") == size
    marks = marks.select(
        "rid", "at", "kind", "gap", "size", "ok",
        F.when(size.isNotNull(), stratum).alias("stratum"),
        binned("p").alias("bin"),
        F.when(full, binned("decoy_p")).alias("decoy_bin"),
    )
    marks = materialize(marks, "marks")
    least = materialize(thresholds(marks), "thresholds")
    upto = Window.partitionBy("rid", "kind").orderBy("at")
    end = F.sum(F.col("gap") + F.col("size")).over(upto)
    placed = marks.withColumn("end", end).join(F.broadcast(least), "stratum", "left")  # one row a stratum
    placed = placed.where(F.when(F.col("stratum").isNull(), F.col("ok")).otherwise(F.col("bin") >= F.col("least")))
    name = F.element_at(F.array(*[F.lit(k) for k in KINDS]), F.col("kind") + 1)
    span = F.struct(
        (F.col("end") - F.col("size")).alias("start"), F.col("kind").alias("rank"), name.alias("kind"), F.col("end")
    )
    spans = placed.groupBy("rid").agg(F.sort_array(F.collect_list(span)).alias("spans"))
    none = F.array().cast(spans.schema["spans"].dataType)
    return found.select(ROW, "rid").join(spans, "rid", "left").select(
        ROW, F.coalesce("spans", none).alias("spans")
    )


def _listed(spans: Column) -> Column:
    parts = F.transform(
        spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))
    )
    return F.array_join(parts, ",")


def secret_report(docs: DataFrame) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans of every document."""
    found = find_secrets(docs, keep=("doc_id",))

    def number(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    base = F.filter("spans", lambda s: s["kind"] != "random")
    return found.select(
        F.col(f"{ROW}.doc_id").alias("doc_id"),
        *[number(k) for k in KINDS[:3]],
        F.sha2(_listed(base).cast("binary"), 256).alias("base_sha256"),
        _listed(F.col("spans")).alias("spans"),
    )
