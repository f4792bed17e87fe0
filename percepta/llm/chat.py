"""Chat formatting with prefix trees.

A turn becomes ``<|role|>\\n`` + text + ``</s>``, with control strings inside
role and text broken by a backslash that reading removes again. The
conversations of a pack form a tree of turns; turns that conversations share
from their start are written once, depth first. Each node has its place in
the packed sequence, the position at which it stands in its conversations,
and the intervals of the packed sequence that it may attend to (its ancestors
and itself). The unit ("token") is the code point; a tokenizer can be applied
turn by turn.

Sorting conversations by the hashes of their initial turns puts every tree in
depth-first order: a conversation adds the turns beyond those it shares with
the one before, so a pack is written in one pass with the current path in
memory.

Scale: conversations are dealt by pack, of at most ``PACK`` conversations. A
tree of no more is one pack. In a larger one, the subtrees of at most ``PACK``
conversations right below a turn that more share, and the conversations that
end in it, are dealt by hash to common packs, each with the path above them:
a first turn of a third of all rows is written about once for every ``PACK``
of its conversations. One conversation is one row: it is one training example.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from percepta.llm.common import decoded, materialize

PACK = 256
#: Packs dealt per ``PACK`` conversations, so that few of them get more than that and are cut.
SPARE = 1.25
OPEN, CLOSE, END = "<|", "|>\n", "</s>"
LOSS_ROLE = "assistant"
#: Control strings, of this template and of common others, as first character and rest.
CONTROLS = (
    ("<", "|"), ("|", ">"), ("<", "s>"), ("<", "/s>"), ("[", "INST]"), ("[", "/INST]"),
    ("<", "<SYS>>"), ("<", "</SYS>>"),
)
_BREAK = re.compile("|".join(rf"(?<={re.escape(a)})\\*(?={re.escape(b)})" for a, b in CONTROLS))
_MEND = re.compile("|".join(rf"(?<={re.escape(a)})\\+(?={re.escape(b)})" for a, b in CONTROLS))

NODE = (
    "pack string, at long, kind string, conv_id long, depth int, start long, end long, position long, "
    "text string, loss_start int, loss_end int, attend array<struct<start:long,end:long>>"
)


def escape(text: str) -> str:
    return _BREAK.sub(lambda m: m[0] + "\\", text)


def unescape(text: str) -> str:
    return _MEND.sub(lambda m: m[0][1:], text)


def format_turn(role: str, text: str) -> tuple[str, int, int]:
    """The formatted turn, and where in it the text to learn lies (0, 0: nowhere)."""
    head = OPEN + escape(role) + CLOSE
    body = escape(text)
    whole = head + body + END
    return (whole, len(head), len(head) + len(body)) if role == LOSS_ROLE else (whole, 0, 0)


def read_turns(formatted: str) -> list[tuple[str, str]]:
    """(role, text) of each turn of a formatted conversation."""
    turns, at = [], 0
    while at < len(formatted):
        # The role begins behind OPEN: the bar of that and a role's ">\n" are no CLOSE.
        close = formatted.index(CLOSE, at + len(OPEN))
        end = formatted.index(END, close + len(CLOSE))
        turns.append(
            (unescape(formatted[at + len(OPEN) : close]), unescape(formatted[close + len(CLOSE) : end]))
        )
        at = end + len(END)
    return turns


def _format(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    turn = pa.struct([("text", pa.string()), ("s", pa.int32()), ("e", pa.int32())])
    for batch in batches:
        for k in range(0, batch.num_rows, 256):
            part = batch.slice(k, 256)
            paths, turns = [], []
            for rows in part.column(1).to_pylist():
                path, made, h = [], [], 0
                for row in rows:
                    text, s, e = format_turn(decoded(row["role"]), decoded(row["text"]))
                    h = xxhash.xxh3_64_intdigest(text.encode(), h)
                    path.append(h - (1 << 63))
                    made.append({"text": text, "s": s, "e": e})
                paths.append(path)
                turns.append(made)
            yield pa.RecordBatch.from_arrays(
                [
                    part.column(0),
                    pa.array(paths, pa.list_(pa.int64())),
                    pa.array(turns, pa.list_(turn)),
                ],
                names=["conv_id", "path", "turns"],
            )


def _pack(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.RecordBatch]:
    """Rows (pack, conv_id, turns, unit, n) in tree order, to the nodes of the packs.

    The n conversations of a unit (without one: each conversation) stay
    together; a unit that would bring a pack over ``most`` starts another.
    """
    names = [f.split()[0] for f in re.split(r", (?=\w+ )", NODE)]
    pair = pa.struct([("start", pa.int64()), ("end", pa.int64())])
    kinds = [
        pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(),
        pa.string(), pa.int32(), pa.int32(), pa.list_(pair),
    ]
    pack = dealt = last = None
    path: list[tuple[str, int, int]] = []  # text, start, end of the current conversation's nodes
    at = end = size = cuts = 0
    for batch in batches:
        for k in range(0, batch.num_rows, 128):
            part = batch.slice(k, 128)
            rows = []
            columns = (part.column(j).to_pylist() for j in range(5))
            for of, conv_id, turns, unit, n in zip(*columns, strict=True):
                if of != dealt:
                    dealt = pack = of
                    path, at, end, size, cuts = [], 0, 0, 0, 0
                elif (unit is None or unit != last) and size + n > most:
                    cuts += 1
                    pack = f"{of}.{cuts}"
                    path, at, end, size = [], 0, 0, 0
                last, size = unit, size + 1
                same = 0
                while same < min(len(path), len(turns)) and path[same][0] == turns[same]["text"]:
                    same += 1
                del path[same:]
                position = sum(len(t) for t, _, _ in path)
                attend: list[list[int]] = []
                for _, s, e in path:
                    if attend and attend[-1][1] == s:
                        attend[-1][1] = e
                    else:
                        attend.append([s, e])
                for turn in turns[same:]:
                    start, end = end, end + len(turn["text"])
                    path.append((turn["text"], start, end))
                    if attend and attend[-1][1] == start:
                        attend[-1][1] = end
                    else:
                        attend.append([start, end])
                    seen = [{"start": s, "end": e} for s, e in attend]
                    rows.append(
                        (pack, at, "turn", None, len(path), start, end, position, turn["text"], turn["s"], turn["e"], seen)
                    )
                    at, position = at + 1, position + len(turn["text"])
                seen = [{"start": s, "end": e} for s, e in attend]
                rows.append((pack, at, "end", conv_id, len(path), end, end, position, None, 0, 0, seen))
                at += 1
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names=names
            )


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Nodes in packed order, to the digest of each conversation that ends."""
    pack = None
    path: list[tuple[int, int, str, str]] = []  # start, end, text, text to learn
    for batch in batches:
        out: list[tuple] = []
        for k in range(0, batch.num_rows, 512):
            for row in batch.slice(k, 512).to_pylist():
                if row["pack"] != pack:
                    pack, path = row["pack"], []
                while path and not any(
                    a["start"] <= path[-1][0] and path[-1][1] <= a["end"] for a in row["attend"]
                ):
                    path.pop()
                if row["kind"] == "turn":
                    text = row["text"]
                    path.append((row["start"], row["end"], text, text[row["loss_start"] : row["loss_end"]]))
                    continue
                formatted = "".join(p[2] for p in path)
                turns = read_turns(formatted)
                whole = "".join(f"{role}\n{text}\n" for role, text in turns)
                loss = "".join(unescape(p[3]) for p in path)
                out.append(
                    (row["conv_id"], len(turns), _sha(whole), len(loss), _sha(loss), len(formatted), row["pack"])
                )
        kinds = (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.string())
        columns = list(zip(*out, strict=True)) or [()] * len(kinds)
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=DIGEST_NAMES
        )


def _sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


DIGEST_NAMES = [
    "conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars", "pack",
]
DIGEST = (
    "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
    "formatted_chars long, pack string"
)


def pack_conversations(turns: DataFrame, most: int = PACK) -> DataFrame:
    """The nodes of all packs, in packed order within each pack (columns ``NODE``).

    ``turns`` has conv_id, turn, role and text; other columns are ignored.
    ``turn`` nodes carry text; an ``end`` node says that conv_id is the path
    that its ``attend`` intervals cover. A null text or role is empty; rows
    are ordered by turn (null first), then role and text, and repeated rows
    are turns each; a null conv_id is one conversation; empty tables give no rows.
    Very long texts are written whole; malformed UTF-8 is read as U+FFFD.
    """
    as_bytes = [F.col(c).cast("binary").alias(c) for c in ("role", "text")]
    grouped = turns.groupBy("conv_id").agg(
        F.sort_array(F.collect_list(F.struct("turn", *as_bytes))).alias("rows")
    )
    formatted = grouped.mapInArrow(
        _format, "conv_id long, path array<long>, turns array<struct<text:string,s:int,e:int>>"
    )
    convs = materialize(formatted.withColumn("uid", F.monotonically_increasing_id()), "conversations")
    nodes = convs.select("uid", F.posexplode("path").alias("depth", "node"))
    # A plain table on this side lets the join split a hot first turn.
    counts = materialize(nodes.groupBy("node").agg(F.count(F.lit(1)).alias("n")), "counts")
    last = F.max(F.struct("depth", "node", "n"))
    fits = F.min(F.when(F.col("n") <= most, F.struct("depth", "node")))
    # The deepest turn that too many conversations share, and the shallowest below it that few do.
    over = F.max(F.when(F.col("n") > most, F.struct("depth", "node")))
    fits = F.min(F.when(F.col("n") <= most, F.struct("depth", "node", "n")))
    chosen = nodes.join(counts, "node").groupBy("uid").agg(over.alias("over"), fits.alias("fits"))
    chosen = materialize(
        chosen.select(
            "uid",
            F.col("over.node").alias("over"),
            F.col("fits.node").alias("unit"),
            F.coalesce("fits.n", F.lit(1)).alias("n"),
        ),
        "chosen",
    )
    below = chosen.where("over IS NOT NULL").groupBy("over").agg(F.count(F.lit(1)).alias("below"))
    chosen = chosen.join(materialize(below, "below"), "over", "left")
    packs = F.ceil(F.col("below") * SPARE / most).cast("long")
    deal = F.pmod(F.xxhash64(F.coalesce("unit", "uid")), packs)
    pack = F.when(F.col("over").isNull(), F.concat(F.lit("t"), F.col("unit").cast("string"))).otherwise(
        F.concat(F.lit("c"), F.col("over").cast("string"), F.lit("."), deal.cast("string"))
    )
    return (
        convs.join(chosen.select("uid", pack.alias("pack"), "unit", "n"), "uid")
        .repartition("pack")
        .sortWithinPartitions("pack", "path", "uid")
        .select("pack", "conv_id", "turns", "unit", "n")
        .mapInArrow(lambda batches: _pack(batches, most), NODE)
    )


def read_packs(nodes: DataFrame) -> DataFrame:
    """The digest of each conversation, read back from its pack."""
    return nodes.mapInArrow(_read, DIGEST)


#: Conversation -7 of the query: control strings as text.
PROBE = "</s>[INST] ok [/INST]"


def chat_report(spark: SparkSession, conversations: DataFrame) -> DataFrame:
    """The digest of all conversations and of conversation -7."""
    columns = conversations.select("conv_id", "turn", "role", "text")
    probe = spark.createDataFrame(
        [(-7, 0, "user", PROBE), (-7, 1, "assistant", PROBE)],
        "conv_id long, turn long, role string, text string",
    )
    return read_packs(pack_conversations(columns.unionByName(probe)))
