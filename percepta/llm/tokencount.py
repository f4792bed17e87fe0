"""Token counts by rank-synchronous merging of ragged arrays.

The model is a byte-fallback BPE in the piece format: a space is the mark
U+2581, one stands before the text, and two neighbouring symbols merge into
the piece that they spell, best score first, leftmost first among equals.

The distinct pre-tokens of a batch of texts (marks and what follows them;
further cut between characters that are neighbours in no piece, so that no
merge can cross) lie in one flat array of symbols with the number of their
sequence. In every round each sequence finds the best rank among its pairs and
merges at it, all sequences at once; sequences without a pair drop out, and
what is left of them is counted. Within a sequence all places of the best rank
merge in the same round, of overlapping ones every other one from the left. A
merge that makes a pair of no worse rank than its own ends the round for the
places behind it, unless they lie so far away that no later merge can reach
them. Where all pairs of a sequence have the worst rank of the model (in runs of
spaces), they merge from left to right in one pass. So the order is that of one
merge at a time, and a run of one character, of any length, takes a few rounds.

Scale: one narrow stage; a batch's distinct pre-tokens and a bounded cache
of counts are all it holds.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from percepta.llm.common import ROW, add_columns, decoded, field, texts_of, with_row

MARK = "▁"
MODEL = "piece_bpe_32k.model"
MAX_TOKENS = 4096
CACHE = 400_000
CACHED_CHARS = 48
_UNIT = re.compile(f"{MARK}+[^{MARK}]*")
_NONE = np.int64(1 << 40)


class PieceTable:
    """Pieces and merge ranks of a model file, as arrays."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        size = model.get_piece_size()
        piece = {
            model.id_to_piece(i): i
            for i in range(size)
            if not (model.is_unknown(i) or model.is_control(i) or model.is_unused(i) or model.is_byte(i))
        }
        scores = sorted({model.get_score(i) for i in piece.values()}, reverse=True)
        rank_of = {s: k for k, s in enumerate(scores)}
        self.size = size
        self.longest = max(map(len, piece))
        self.single = np.full(0x110000, -1, dtype=np.int64)
        pairs: dict[int, tuple[int, int]] = {}
        glue = set()
        for text, i in piece.items():
            if len(text) == 1:
                self.single[ord(text)] = i
            for k in range(1, len(text)):
                left, right = piece.get(text[:k]), piece.get(text[k:])
                if left is not None and right is not None:
                    pairs[left * size + right] = (rank_of[model.get_score(i)], i)
                glue.add(ord(text[k - 1]) << 21 | ord(text[k]))
        self.keys = np.array(sorted(pairs), dtype=np.int64)
        self.ranks = np.array([pairs[k][0] for k in self.keys.tolist()], dtype=np.int64)
        self.merged = np.array([pairs[k][1] for k in self.keys.tolist()], dtype=np.int64)
        self.pairs, self.worst = pairs, int(self.ranks.max())
        self.glue = np.array(sorted(glue), dtype=np.int64)
        # Two-choice lookup: a table by hashed key, and the sorted keys where two keys share a slot.
        self.bits = max(16, int(np.ceil(np.log2(max(len(self.keys), 1) * 16))))
        self.slot = np.full(1 << self.bits, -1, dtype=np.int32)
        self.slot[self._hash(self.keys)] = np.arange(len(self.keys))
        self.lost = np.sort(self.keys[self.slot[self._hash(self.keys)] != np.arange(len(self.keys))])

    def _hash(self, keys: np.ndarray) -> np.ndarray:
        mixed = keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return (mixed >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The index of each pair key, or -1."""
        at = self.slot[self._hash(keys)].astype(np.int64)
        out = np.where((at >= 0) & (self.keys[at] == keys), at, -1)
        if len(self.lost):
            odd = np.flatnonzero((at >= 0) & (out < 0))
            if len(odd):
                k = np.minimum(np.searchsorted(self.keys, keys[odd]), len(self.keys) - 1)
                out[odd] = np.where(self.keys[k] == keys[odd], k, -1)
        return out

    def _together(self, at, symbol, run, best, made) -> np.ndarray:
        """Which of the best places ``at`` (sorted, to become ``made``) merge in one round."""
        step = np.diff(at)
        far = np.ones(len(at), dtype=bool)
        far[1:] = (run[at[1:]] != run[at[:-1]]) | (step > 2 * self.longest)
        if far.all():
            return np.arange(len(at))
        # Of pairs that overlap, every other one from the left.
        place = np.arange(len(at))
        begins = np.concatenate([[True], step > 1])
        taken = np.flatnonzero((place - np.maximum.accumulate(np.where(begins, place, 0))) % 2 == 0)
        at, made, far = at[taken], made[taken], far[taken]
        # The neighbours at the time of the merge: what is left of the place has merged by then.
        left, right = np.maximum(at - 1, 0), np.minimum(at + 2, len(symbol) - 1)
        before = symbol[left]
        follows = np.flatnonzero(np.diff(at) == 2) + 1
        before[follows] = made[follows - 1]
        goes_first = (run[left] == run[at]) & (at > 0) & (self._rank(before, made) <= best[at])
        goes_first |= (run[right] == run[at]) & (right == at + 2) & (self._rank(made, symbol[right]) <= best[at])
        # A new pair that goes before the other places ends the round for those near to it.
        earlier = np.cumsum(goes_first) - goes_first
        return taken[earlier == earlier[far][np.cumsum(far) - 1]]

    def _rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        index = self.find(left * self.size + right)
        return np.where(index >= 0, self.ranks[index], _NONE)

    def _left_to_right(self, symbols: list[int]) -> int:
        """The number of symbols left of a sequence whose pairs all have the worst rank."""
        pairs, size = self.pairs.get, self.size
        out: list[int] = []
        k = 0
        while k < len(symbols):
            now, k, merged = symbols[k], k + 1, False
            while True:
                back = pairs(out[-1] * size + now) if out else None
                ahead = pairs(now * size + symbols[k]) if merged and k < len(symbols) else None
                if back and not (ahead and ahead[0] < back[0]):
                    now = back[1]
                    out.pop()
                elif ahead:
                    now, k = ahead[1], k + 1
                else:
                    break
                merged = True
            out.append(now)
        return len(out)

    def count(self, units: list[str]) -> np.ndarray:
        """The number of tokens of each pre-token."""
        code = np.frombuffer("".join(units).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        code = code.astype(np.int64)
        unit = np.repeat(np.arange(len(units)), [len(u) for u in units])
        symbol = self.single[code]
        unknown = symbol < 0
        wide = 1 + (code > 0x7F).astype(np.int64) + (code > 0x7FF) + (code > 0xFFFF)
        cost = np.where(unknown, wide, 1)  # an unknown character is as many byte tokens
        total = np.bincount(unit[unknown], weights=cost[unknown], minlength=len(units))
        total = total.astype(np.int64)
        apart = np.ones(len(code), dtype=bool)
        pair = code[:-1] << 21 | code[1:]
        near = np.minimum(np.searchsorted(self.glue, pair), len(self.glue) - 1)
        apart[1:] = (self.glue[near] != pair) | (unit[1:] != unit[:-1])
        run = np.cumsum(apart)
        known = ~unknown
        symbol, run, owner = symbol[known], run[known], unit[known]
        while len(symbol):
            index = self.find(symbol[:-1] * self.size + symbol[1:])
            rank = np.full(len(symbol), _NONE)
            good = (index >= 0) & (run[:-1] == run[1:])
            rank[:-1][good] = self.ranks[index[good]]
            first = np.flatnonzero(np.concatenate([[True], run[1:] != run[:-1]]))
            length = np.diff(np.append(first, len(run)))
            least = np.minimum.reduceat(rank, first)
            for k in np.flatnonzero(least == self.worst).tolist():
                total[owner[first[k]]] += self._left_to_right(symbol[first[k] : first[k] + length[k]].tolist())
            best = np.repeat(least, length)
            total += np.bincount(owner[best == _NONE], minlength=len(units))
            done = best >= self.worst
            at = np.flatnonzero((rank == best) & ~done)
            if not len(at):
                break
            at = at[self._together(at, symbol, run, best, self.merged[index[at]])]
            symbol[at] = self.merged[index[at]]
            stay = ~done
            stay[at + 1] = False
            symbol, run, owner = symbol[stay], run[stay], owner[stay]
        return total


class Counter:
    """Counts texts, keeping the counts of common pre-tokens."""

    def __init__(self, table: PieceTable):
        self.table = table
        self.known: dict[str, int] = {}

    def count(self, texts: list[bytes | None]) -> list[int]:
        units = [
            _UNIT.findall(MARK + decoded(t).replace(" ", MARK)) if t else [] for t in texts
        ]
        new = list(set().union(*units) - self.known.keys())
        if len(self.known) + len(new) > CACHE:
            self.known.clear()
            new = list(set().union(*units))
        if new:
            self.known.update(zip(new, self.table.count(new).tolist(), strict=True))
        get = self.known.__getitem__
        counts = [sum(map(get, u)) for u in units]
        for u in new:
            if len(u) > CACHED_CHARS:
                del self.known[u]
        return counts


_COUNTERS: dict[str, Counter] = {}


def count_tokens(docs: DataFrame, model_path: str | None = None, text_col: str = "text") -> DataFrame:
    """``__row``, n_bytes (UTF-8) and n_tokens of every document's whole text.

    ``model_path`` is a piece model file that every executor can read; unset,
    the model ``piece_bpe_32k.model`` of the installed ``public_tokenizers``.
    A null or empty text has no bytes and no tokens. No beginning, end or
    other special tokens are added, and their strings in a text are text.
    Malformed UTF-8 is read as U+FFFD, as by Python's ``replace``; n_bytes counts the
    bytes given. Very long texts are counted whole, repeated rows each; an empty
    table gives no rows; other columns stay inside ``__row``, whatever their names.
    """

    def counter() -> Counter:
        path = model_path
        if path is None:
            import public_tokenizers

            path = public_tokenizers.path(MODEL)
        if path not in _COUNTERS:
            _COUNTERS[path] = Counter(PieceTable(path))
        return _COUNTERS[path]

    def compute(batch: pa.RecordBatch) -> dict[str, pa.Array]:
        texts = texts_of(batch)
        return {
            "n_bytes": pa.array([len(t or b"") for t in texts], pa.int64()),
            "n_tokens": pa.array(counter().count(texts), pa.int64()),
        }

    fields = [field("n_bytes", T.LongType()), field("n_tokens", T.LongType())]
    return add_columns(with_row(docs, text_col), compute, fields)


def token_report(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit (more than 4096 tokens)."""
    return count_tokens(docs.select("doc_id", "text")).select(
        F.col(f"{ROW}.doc_id").alias("doc_id"),
        "n_bytes",
        "n_tokens",
        (F.col("n_tokens") > MAX_TOKENS).alias("over_limit"),
    )
