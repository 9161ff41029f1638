"""Periodic runs of words: stretches that repeat a short block four times or more.

Per document, every period q is tried on a grid of places 3q apart: a run of exponent 4 agrees with
itself, shifted by q, over 3q words and so holds a place of the grid. Most places fail on their first
words; the others ask how far the two suffixes agree, forwards and backwards, of a structure that sorts
only the suffixes at places of a difference cover.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPACES = r"[\x20\x09-\x0D]+"
MIN_WORDS = 6
MIN_REPEATS = 4

# A perfect difference set; every difference modulo 31 is that of two of these.
_CYCLE = 31
_COVER = [1, 5, 11, 24, 25, 27]

_WORDS_PER_ROUND = 300_000
_PLACES_PER_ROUND = 2_000_000
_NEAR = 4


def _ragged(counts: np.ndarray) -> np.ndarray:
    """0 to count - 1 for each count, one after the other."""
    return np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)


def _names(rows: np.ndarray) -> np.ndarray:
    """A number per row of words, the same for equal rows only."""
    whole = np.ascontiguousarray(rows).view(np.dtype((np.void, rows.shape[1] * rows.itemsize))).ravel()
    return np.unique(whole, return_inverse=True)[1].ravel().astype(np.int64)


def _shifts() -> np.ndarray:
    """For two residues: the least step that brings both onto the cover."""
    inside = np.zeros(_CYCLE, dtype=bool)
    inside[_COVER] = True
    residue, step = np.arange(_CYCLE), np.arange(_CYCLE)
    on = inside[(residue[:, None] + step) % _CYCLE]
    return (on[:, None, :] & on[None, :, :]).argmax(axis=2)


_SHIFT = _shifts()


class CommonPrefixes:
    """How many words two suffixes of a sequence have in common, for many pairs at a time.

    Only the suffixes at places whose residue modulo 31 lies in the cover are sorted, 6 of 31, by whole
    blocks of 31 words: the blocks get exact numbers, and rounds of doubling sort what follows them. Two
    places are compared word by word for fewer than 31 words until both stand on the cover, then jump
    over all their common blocks by a minimum in the sparse table, and finish within one block.
    """

    def __init__(self, symbols: np.ndarray):
        pad = np.arange(3 * _CYCLE, dtype=np.int64) + (symbols.max(initial=0) + 1)
        self.words = np.concatenate([symbols, pad])
        size = len(symbols) + _CYCLE
        place = np.concatenate([np.arange(c, size, _CYCLE) for c in _COVER])
        self.sample = np.full(size, -1, dtype=np.int64)
        self.sample[place] = np.arange(len(place))
        blocks = np.lib.stride_tricks.sliding_window_view(self.words, _CYCLE)[place]
        self._sort(_names(blocks), np.cumsum([len(range(c, size, _CYCLE)) for c in _COVER]))

    def _sort(self, name: np.ndarray, ends: np.ndarray) -> None:
        """Suffixes of the block sequences, one per residue; a sequence ends in a number of its own."""
        n = len(name)
        self.stop = np.repeat(ends, np.diff(ends, prepend=0))
        levels, step = [name], 1
        while True:
            rank = levels[-1]
            order = np.argsort(rank, kind="stable")
            tied = rank[order][1:] == rank[order][:-1]
            if not tied.any():
                break
            after = np.arange(n) + step
            inside = after < self.stop
            follower = np.where(inside, rank[np.minimum(after, n - 1)], -1 - np.arange(n))
            pair = np.lexsort((follower, rank))
            new = (np.diff(rank[pair], prepend=-1) != 0) | (np.diff(follower[pair], prepend=0) != 0)
            new[0] = False
            levels.append(np.empty(n, dtype=np.int64))
            levels[-1][pair] = np.cumsum(new)
            step *= 2
        self.rank = np.empty(n, dtype=np.int64)
        self.rank[order] = np.arange(n)
        self.table = [self._neighbours(order, levels)]
        while 2 << (len(self.table) - 1) <= n:
            low, reach = self.table[-1], 1 << (len(self.table) - 1)
            self.table.append(np.minimum(low[: len(low) - reach], low[reach:]))

    def _neighbours(self, order: np.ndarray, levels: list[np.ndarray]) -> np.ndarray:
        """Common blocks of each suffix with the one before it in the order."""
        n = len(order)
        a, b = order[:-1].copy(), order[1:].copy()
        common = np.zeros(n, dtype=np.int64)
        for k in range(len(levels) - 1, -1, -1):
            here = (a < n) & (b < n)
            same = np.zeros(n - 1, dtype=bool)
            same[here] = levels[k][a[here]] == levels[k][b[here]]
            # Equal numbers mean equal blocks up to the ends, where no two sequences agree.
            common[1:][same] += 1 << k
            a[same] += 1 << k
            b[same] += 1 << k
        return common

    def _blocks(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        low, high = np.minimum(self.rank[a], self.rank[b]) + 1, np.maximum(self.rank[a], self.rank[b])
        level = np.frexp((high - low + 1).astype(np.float64))[1] - 1
        out = np.empty(len(a), dtype=np.int64)
        for k in np.unique(level):
            at = np.flatnonzero(level == k)
            row = self.table[k]
            out[at] = np.minimum(row[low[at]], row[high[at] - (1 << k) + 1])
        return out

    def _step(self, i: np.ndarray, j: np.ndarray, most: np.ndarray) -> np.ndarray:
        """Common words up to ``most``, compared one by one."""
        common = np.zeros(len(i), dtype=np.int64)
        active = np.arange(len(i))
        for k in range(_CYCLE):
            active = active[most[active] > k]
            active = active[self.words[i[active] + k] == self.words[j[active] + k]]
            if not len(active):
                break
            common[active] += 1
        return common

    def common(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Common words of the suffixes at ``i`` and ``j``, which differ pairwise."""
        shift = _SHIFT[i % _CYCLE, j % _CYCLE]
        total = self._step(i, j, shift)
        on = np.flatnonzero(total == shift)
        a, b = i[on] + shift[on], j[on] + shift[on]
        jump = _CYCLE * self._blocks(self.sample[a], self.sample[b])
        total[on] += jump + self._step(a + jump, b + jump, np.full(len(on), _CYCLE))
        return total


def _grid(start: np.ndarray, size: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places and periods to try, at most about two million at a time."""
    longest = np.where(size >= MIN_WORDS, size // MIN_REPEATS, 0)
    # A document's periods are taken in pieces, so that one very long text is cut as well.
    piece = 1 << 18
    pieces = -(-longest // piece)
    owner = np.repeat(np.arange(len(size)), pieces)
    first = _ragged(pieces) * piece
    spans = np.minimum(longest[owner] - first, piece)
    bounds = np.cumsum(spans)
    lo = 0
    while lo < len(owner):
        hi = max(lo + 1, int(np.searchsorted(bounds, (bounds[lo - 1] if lo else 0) + piece, "right")))
        doc = np.repeat(owner[lo:hi], spans[lo:hi])
        period = _ragged(spans[lo:hi]) + np.repeat(first[lo:hi], spans[lo:hi]) + 1
        step = np.maximum(MIN_WORDS - period, (MIN_REPEATS - 1) * period)
        places = -(-(size[doc] - period) // step)
        total = np.cumsum(places)
        a = 0
        while a < len(doc):
            b = max(a + 1, int(np.searchsorted(total, (total[a - 1] if a else 0) + _PLACES_PER_ROUND, "right")))
            n = places[a:b]
            at = np.repeat(start[doc[a:b]], n) + _ragged(n) * np.repeat(step[a:b], n)
            yield at, np.repeat(period[a:b], n)
            a = b
        lo = hi


def _promising(words: np.ndarray, at: np.ndarray, period: np.ndarray) -> np.ndarray:
    """Which places lie in a stretch of at least five words that recur a period later."""
    found = np.flatnonzero(words[at] == words[at + period])
    i, q = at[found], period[found]
    near = np.ones(len(found), dtype=np.int64)
    for way in (1, -1):
        on = np.arange(len(found))
        for k in range(1, _NEAR + 1):
            place = i[on] + way * k
            inside = (place >= 0) & (place + q[on] < len(words))
            on, place = on[inside], place[inside]
            on = on[words[place] == words[place + q[on]]]
            near[on] += 1
    return found[near >= MIN_WORDS - 1]


def find_runs(symbols: np.ndarray, start: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and smallest period of every run, in order of start and period.

    Documents stand one after the other in ``symbols``, each followed by a symbol that occurs nowhere else.
    """
    tried = [(at[keep], period[keep]) for at, period in _grid(start, size) for keep in [_promising(symbols, at, period)]]
    at = np.concatenate([a for a, _ in tried]) if tried else np.empty(0, dtype=np.int64)
    period = np.concatenate([q for _, q in tried]) if tried else at
    if not len(at):
        return at, at, at
    # Documents without a promising place need no sorting.
    doc = np.searchsorted(start, at, "right") - 1
    used = np.unique(doc)
    shift = np.zeros(len(start), dtype=np.int64)
    shift[used] = start[used] - (np.cumsum(size[used] + 1) - size[used] - 1)
    taken = np.repeat(start[used], size[used] + 1) + _ragged(size[used] + 1)
    part = symbols[taken]
    i = at - shift[doc]
    ahead = CommonPrefixes(part).common(i, i + period)
    last = len(part) - 1
    behind = CommonPrefixes(part[::-1]).common(last - (i - 1), last - (i + period - 1))
    length = ahead + behind + period
    whole = length >= np.maximum(MIN_WORDS, MIN_REPEATS * period)
    begin, end, period = (at - behind)[whole], (at + ahead + period)[whole], period[whole]
    # A multiple of a run's period finds the same borders: the smallest counts.
    order = np.lexsort((period, end, begin))
    begin, end, period = begin[order], end[order], period[order]
    first = (np.diff(begin, prepend=-1) != 0) | (np.diff(end, prepend=-1) != 0)
    begin, end, period = begin[first], end[first], period[first]
    order = np.lexsort((period, begin))
    return begin[order], end[order], period[order]


def _collapse(split: list[list[bytes]]) -> tuple[list[int], np.ndarray, list[bytes]]:
    """For documents as words: the runs per document, (start, length, period) of each, the kept text."""
    vocabulary = {w: k for k, w in enumerate(dict.fromkeys(w for ws in split for w in ws))}
    size = np.array([len(ws) for ws in split], dtype=np.int64)
    start = np.cumsum(size + 1) - size - 1
    symbols = np.empty(int((size + 1).sum()), dtype=np.int64)
    for k, ws in enumerate(split):
        symbols[start[k] : start[k] + size[k]] = np.fromiter(map(vocabulary.__getitem__, ws), np.int64, len(ws))
    symbols[start + size] = len(vocabulary) + np.arange(len(split))

    begin, end, period = find_runs(symbols, start, size)
    doc = np.searchsorted(start, begin, "right") - 1
    counts = np.bincount(doc, minlength=len(split))
    cover = np.zeros(len(symbols) + 1, dtype=np.int64)
    np.add.at(cover, begin + period, 1)
    np.add.at(cover, end, -1)
    stays = np.cumsum(cover)[:-1] == 0
    texts = []
    for k, ws in enumerate(split):
        if counts[k]:
            ws = [ws[x] for x in np.flatnonzero(stays[start[k] : start[k] + size[k]])]
        texts.append(b" ".join(ws))
    return counts.tolist(), np.stack([begin - start[doc], end - begin, period], axis=1), texts


def _rounds(texts: list[bytes | None]) -> Iterator[list[list[bytes]]]:
    part, words = [], 0
    for text in texts:
        part.append(text.split() if text else [])
        words += len(part[-1])
        if words >= _WORDS_PER_ROUND:
            yield part
            part, words = [], 0
    if part:
        yield part


_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def _search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        done = 0
        for split in _rounds(batch.column("text").cast(pa.binary()).to_pylist()):
            counts, runs, texts = _collapse(split)
            listed = pa.StructArray.from_arrays([pa.array(np.ascontiguousarray(c)) for c in runs.T], fields=list(_RUN))
            offsets = pa.array(np.concatenate([[0], np.cumsum(counts)]).astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").slice(done, len(split)),
                    pa.array([len(ws) for ws in split], pa.int64()),
                    pa.ListArray.from_arrays(offsets, listed),
                    pa.array(texts, pa.binary()).cast(pa.string()),
                ],
                names=["doc_id", "n_words", "runs", "collapsed"],
            )
            done += len(split)


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``n_words``, ``runs`` and the text without repeats, ``collapsed``.

    ``runs`` lists (start, length, period), words counted from 0, by start and period: all stretches with
    a smallest period q, at least 6 words and 4q long, that no neighbouring word extends. Words are
    divided by space and \\t to \\r and compared as they stand. ``collapsed`` joins by one space the words
    that no run holds after its first q words.

    Rows stay where they are: there is no shuffle. A round takes some 300,000 words or one text, however
    long, and time grows with n log n words even where all words are equal. NULL, empty and blank texts
    have no words, no runs and an empty ``collapsed``. Repeated rows, equal texts and NULL ids are rows
    like others; the result depends on the text alone. An empty table gives no rows. Other columns are
    ignored, whatever their names.
    """
    rows = docs.select(docs[id_col].cast("bigint").alias("doc_id"), docs[text_col].cast("string").alias("text"))
    return rows.mapInArrow(
        _search,
        "doc_id bigint, n_words bigint, runs array<struct<start: bigint, length: bigint, period: bigint>>, collapsed string",
    )


def repeat_tails(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id`` and ``text``, where a tenth of the documents have their tail replaced by repeats.

    With h the crc32 of the id in decimal, g = floor(h / 10) and n words: if h is a multiple of 10, word i
    from a = g % n on becomes word a + (i - a) % p, with p = 1 + floor((n - a) / (3 + g % 8)). Other texts,
    texts without words and rows without an id stay as they are.
    """
    crc = F.crc32(docs[id_col].cast("string").cast("binary"))
    rows = docs.select(docs[id_col].cast("bigint").alias("doc_id"), docs[text_col].alias("text"), crc.alias("h"))
    words = F.filter(F.split("text", SPACES), lambda w: w != "")
    rows = rows.withColumn("words", F.when(F.pmod("h", F.lit(10)) == 0, words))
    n = F.size("words").cast("bigint")
    rows = rows.withColumn("g", F.expr("h div 10")).withColumn("a", F.when(n > 0, F.col("g") % n))
    rows = rows.withColumn("p", F.when(n > 0, 1 + F.expr("(size(words) - a) div (3 + g % 8)")))

    def word(w: Column, i: Column) -> Column:
        source = F.col("a") + (i - F.col("a")) % F.col("p")
        return F.when(i < F.col("a"), w).otherwise(F.get("words", source.cast("int")))

    repeated = F.concat_ws(" ", F.transform("words", word))
    return rows.select("doc_id", F.when(F.col("a").isNotNull(), repeated).otherwise(F.col("text")).alias("text"))


def run_digest(found: DataFrame) -> DataFrame:
    """Counts, the run of greatest length / period, and digests of what ``periodic_runs`` returns."""

    def better(best: Column, run: Column) -> Column:
        more = run["length"] * best["period"] > best["length"] * run["period"]
        return F.when(more, run).otherwise(best)

    best = F.aggregate("runs", F.get("runs", F.lit(0)), better)
    line = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return found.withColumn("best", best).select(
        "doc_id",
        F.size("runs").cast("bigint").alias("n_runs"),
        F.col("best.start").alias("start"),
        F.col("best.length").alias("length"),
        F.col("best.period").alias("period"),
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(F.concat_ws("", line).cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )
