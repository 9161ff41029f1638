"""Token counts of a byte-pair vocabulary by merging ragged arrays in step.

All pre-tokens of a batch lie one behind the other in one array of symbols. In every round each
pre-token merges its pair of best rank, all pre-tokens at the same time, until none has a pair
left; the symbols that survive are the tokens.
"""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame

TOKEN_LIMIT = 4096
SPACE = "▁"
_NO_RANK = np.int32(np.iinfo(np.int32).max)
_MEMO_WORDS = 600_000
_MEMO_CHARS = 64
_LONG_CHARS = 1024
_CHARS_PER_ROUND = 1 << 21


class Vocabulary:
    """Pieces, ranks and merges of a sentencepiece BPE model, as arrays."""

    def __init__(self, model: bytes):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_proto=model)
        for probe in ("a", "  a  b ", "ﬁ　X", "a\nb\t"):
            shown = [
                chr(int(p[3:5], 16)) if re.fullmatch("<0x[0-7][0-9A-F]>", p) else p for p in sp.encode(probe, out_type=str)
            ]
            if "".join(shown) != SPACE + probe.replace(" ", SPACE):
                raise ValueError("the model must keep texts as they are, with a space before them")
        ids = [
            i for i in range(sp.get_piece_size())
            if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i))
        ]
        by_piece = {sp.id_to_piece(i): n for n, i in enumerate(ids)}
        self.has_bytes = any(sp.is_byte(i) for i in range(sp.get_piece_size()))
        _, rank = np.unique([-sp.get_score(i) for i in ids], return_inverse=True)
        self.rank = rank.astype(np.int32)
        self.width = np.int64(len(ids))
        self.char = np.full(0x110000, -1, dtype=np.int32)
        for piece, n in by_piece.items():
            if len(piece) == 1:
                self.char[ord(piece)] = n
        merges = {}
        for piece, n in by_piece.items():
            for k in range(1, len(piece)):
                a, b = by_piece.get(piece[:k]), by_piece.get(piece[k:])
                if a is not None and b is not None:
                    merges[a * len(ids) + b] = n
        self.merges = merges
        self.pairs = np.array(sorted(merges), dtype=np.int64)
        self.made = np.array([merges[k] for k in sorted(merges)], dtype=np.int32)
        # a piece may be merged in several places at once if nothing it forms with a neighbour comes before it
        self.safe = np.ones(len(ids), dtype=bool)
        for side in (self.pairs // self.width, self.pairs % self.width):
            self.safe[side[self.rank[self.made] <= self.rank[side]]] = False
        long = [p for p in by_piece if len(p) > 1]
        if any(SPACE in p.lstrip(SPACE) for p in long):
            raise ValueError("a piece holds a space behind other characters, so words are no pre-tokens")
        line = "\n" if not any("\n" in p for p in long) else ""
        self.pre_token = re.compile(rf" *[^ {line}]+| +" + (f"|{line}" if line else ""))
        self.memo: dict[str, int] = {}

    def count_pre_tokens(self, pre_tokens: list[str]) -> np.ndarray:
        """Tokens of each pre-token (spaces stand for the space piece)."""
        lengths = np.fromiter(map(len, pre_tokens), dtype=np.int64, count=len(pre_tokens))
        code = np.frombuffer("".join(pre_tokens).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        code = np.where(code == 0x20, np.uint32(ord(SPACE)), code)
        symbol = self.char[code]
        # what no piece covers becomes one token per byte of UTF-8
        octets = 1 + (code >= 0x80).astype(np.int32) + (code >= 0x800) + (code >= 0x10000)
        extra = np.where((symbol < 0) & self.has_bytes, octets - 1, 0)
        owner = np.repeat(np.arange(len(pre_tokens)), lengths)
        counts = np.bincount(owner, weights=extra, minlength=len(pre_tokens)).astype(np.int64)
        piece = self._merged(symbol, owner, np.arange(len(symbol)))
        while len(symbol):
            rank = np.where(piece >= 0, self.rank[piece], _NO_RANK)
            start = np.flatnonzero(np.diff(owner, prepend=-1))
            size = np.diff(start, append=len(symbol))
            best = np.minimum.reduceat(rank, start)
            done = best == _NO_RANK
            counts[owner[start[done]]] += size[done]
            chosen = np.flatnonzero((rank == np.repeat(best, size)) & (rank != _NO_RANK))
            if not len(chosen):
                break
            # of overlapping places every second one, counted from the left; an unsafe piece at its first place only
            first = np.diff(owner[chosen], prepend=-1) != 0
            apart = first | (np.diff(chosen, prepend=-2) > 1)
            begin = np.maximum.accumulate(np.where(apart, np.arange(len(chosen)), 0))
            even = (np.arange(len(chosen)) - begin) % 2 == 0
            chosen = chosen[np.where(self.safe[piece[chosen]], even, first)]
            symbol[chosen] = piece[chosen]
            stay = np.repeat(~done, size)
            stay[chosen + 1] = False
            moved = (np.cumsum(stay) - 1)[chosen]
            symbol, owner, piece = symbol[stay], owner[stay], piece[stay]
            changed = np.concatenate([moved, moved[moved > 0] - 1])
            piece[changed] = self._merged(symbol, owner, changed)
        return counts

    def _merged(self, symbol: np.ndarray, owner: np.ndarray, at: np.ndarray) -> np.ndarray:
        """The piece that each symbol at ``at`` forms with the next one of its pre-token, or -1."""
        after = np.minimum(at + 1, len(symbol) - 1)
        left, right = symbol[at].astype(np.int64), symbol[after]
        fits = (after > at) & (owner[at] == owner[after]) & (left >= 0) & (right >= 0)
        out = np.full(len(at), -1, dtype=np.int32)
        pair = left[fits] * self.width + right[fits]
        place = np.minimum(np.searchsorted(self.pairs, pair), len(self.pairs) - 1)
        out[fits] = np.where(self.pairs[place] == pair, self.made[place], -1)
        return out

    def count_long(self, pre_token: str) -> int:
        """Tokens of one very long pre-token, merged from a heap: n log n where rounds could take n squared."""
        symbol = [int(self.char[ord(SPACE if c == " " else c)]) for c in pre_token]
        extra = sum(len(c.encode("utf-8", "surrogatepass")) - 1 for c, s in zip(pre_token, symbol) if s < 0 and self.has_bytes)
        after, before = list(range(1, len(symbol) + 1)), list(range(-1, len(symbol) - 1))
        heap: list[tuple[int, int, int, int]] = []

        def offer(a: int, b: int) -> None:
            if a >= 0 and b < len(symbol) and symbol[a] >= 0 and symbol[b] >= 0:
                made = self.merges.get(symbol[a] * int(self.width) + symbol[b])
                if made is not None:
                    heapq.heappush(heap, (int(self.rank[made]), a, symbol[a], symbol[b]))

        for a in range(len(symbol) - 1):
            offer(a, a + 1)
        n = len(symbol)
        gone = [False] * n
        while heap:
            _, a, left, right = heapq.heappop(heap)
            b = after[a] if not gone[a] else len(symbol)
            if gone[a] or b >= len(symbol) or symbol[a] != left or symbol[b] != right:
                continue
            symbol[a] = self.merges[left * int(self.width) + right]
            gone[b], after[a], n = True, after[b], n - 1
            if after[b] < len(symbol):
                before[after[b]] = a
            offer(before[a], a)
            offer(a, after[a])
        return n + extra

    def count(self, texts: list[str | None]) -> list[int]:
        """Tokens of whole texts; 0 for NULL and the empty text."""
        split = [self.pre_token.findall(" " + t.replace(SPACE, " ")) if t else [] for t in texts]
        if len(self.memo) > _MEMO_WORDS:
            self.memo.clear()
        new = list({w for ws in split for w in ws} - self.memo.keys())
        short = [w for w in new if len(w) <= _LONG_CHARS]
        self.memo.update(zip(short, self.count_pre_tokens(short).tolist()) if short else ())
        self.memo.update((w, self.count_long(w)) for w in new if len(w) > _LONG_CHARS)
        out = [sum(map(self.memo.__getitem__, ws)) for ws in split]
        for w in new:
            if len(w) > _MEMO_CHARS:
                del self.memo[w]
        return out


def _counter(model: Broadcast):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = Vocabulary(model.value)
        for batch in batches:
            texts = batch.column("text").to_pylist()
            n_bytes = [len(t.encode("utf-8", "surrogatepass")) if t else 0 for t in texts]
            counts, part, chars = [], [], 0
            for t in texts:
                part.append(t)
                chars += len(t or "")
                if chars >= _CHARS_PER_ROUND:
                    counts += vocabulary.count(part)
                    part, chars = [], 0
            counts += vocabulary.count(part)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(n_bytes, pa.int64()), pa.array(counts, pa.int64()),
                 pa.array([c > TOKEN_LIMIT for c in counts], pa.bool_())],
                names=["doc_id", "n_bytes", "n_tokens", "over_limit"],
            )

    return count


def count_tokens(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``n_bytes``, ``n_tokens``, ``over_limit`` (above 4096 tokens).

    ``model_path`` is a sentencepiece BPE model; the driver reads it (half a megabyte) and sends it to the
    executors. Rows stay where they are: there is no shuffle. Memory is bounded by a batch of 2 million
    characters or one text, and a memo of word counts that is emptied when it grows beyond 600,000.

    NULL and empty texts have 0 bytes and 0 tokens. Repeated rows and NULL ids are counted like others.
    Special strings inside texts are ordinary text. Other columns are ignored.
    """
    with open(model_path, "rb") as file:
        model = docs.sparkSession.sparkContext.broadcast(file.read())
    rows = docs.select(docs[id_col].cast("bigint").alias("doc_id"), docs[text_col].alias("text"))
    return rows.mapInArrow(_counter(model), "doc_id bigint, n_bytes bigint, n_tokens bigint, over_limit boolean")
