"""Benchmark passages in documents: SimHash of item-sized windows, then exact similarity.

A window of a document has as many words as the item it is compared with. Fingerprints of 128 bits are
looked up by blocks of 8 bits: two fingerprints within 47 bits agree in some block up to 2 bits, so
looking up every value within 2 bits of a block finds all fingerprints in the radius.

Equal windows have equal fingerprints, so whole copies are never lost; near copies can lie outside the radius.
Those are found by the item's rarest shingles, of which every similar window holds one.
"""

from __future__ import annotations

import hashlib
import math
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType

from paytrail.llm.text import SHINGLE_WORDS, mix, shingle_hashes, word_hashes
from paytrail.session import materialized

SIMILARITY = 0.75
RADIUS = 47  # a cosine of 0.75 is 29.4 of 128 bits, give or take 4.8; windows that hold more of other items are further off
BLOCKS = 16
#: Items are compared in blocks of about so many bytes of text, each in one pass over the documents.
BLOCK_BYTES = 4 << 20
_ROUNDING = 1e-6  # sums of weights within it are compared again by their exact similarity
_BLOCK_RADIUS = RADIUS // BLOCKS
_NEAR = [
    [v for v in range(256) if (u ^ v).bit_count() <= _BLOCK_RADIUS] for u in range(256)
]


def _bits(hashes: np.ndarray) -> np.ndarray:
    """128 values of -1 and 1 for each hash."""
    both = np.stack([mix(hashes), mix(hashes + np.uint64(0x1234567))], axis=1)
    return np.unpackbits(both.view(np.uint8), axis=1).astype(np.float32) * 2 - 1


def _fingerprint(sums: np.ndarray) -> np.ndarray:
    return np.packbits(sums > 0, axis=-1)


class Index:
    """Items of a block of the benchmark: weighted shingles, and fingerprints by size and block value."""

    def __init__(self, items: list[tuple[int, str | None]], shared: tuple[np.ndarray, np.ndarray] | None = None):
        """``shared``: shingles that several different items of the whole benchmark hold, and how many; else counted here."""
        self.items = []
        distinct = {}
        for item_id, text in items:
            words = word_hashes(text)
            if len(words):
                shingles = shingle_hashes(words)
                distinct[shingles.tobytes()] = shingles
                self.items.append((item_id, len(words), shingles))
        held = Counter(s for shingles in distinct.values() for s in set(shingles.tolist()))
        if shared is not None:
            of_all = dict(zip(shared[0].view(np.uint64).tolist(), shared[1].tolist()))
            held = {s: of_all.get(s, 1) for s in held}
        #: A shingle of several different items says less about each.
        self.weight = {s: 1 / (1 + math.log(n)) for s, n in held.items()}
        self.known = np.array(sorted(held), dtype=np.uint64)
        self.known_weight = np.array([self.weight[s] for s in self.known.tolist()])
        self.parts, self.total, self.by_size = [], [], defaultdict(list)
        for n, (_, size, shingles) in enumerate(self.items):
            part = Counter(shingles.tolist())
            self.parts.append(part)
            self.total.append(sum(self.weight[s] * k for s, k in part.items()))
            self.by_size[size].append(n)
        self.sizes_of = defaultdict(set)  # a shingle's item sizes
        for size, members in self.by_size.items():
            for n in members:
                for s in self.parts[n]:
                    self.sizes_of[s].add(size)
        self.keys = defaultdict(list)  # a shingle's items that cannot lack it and all their rarer ones
        for n, part in enumerate(self.parts):
            weight = 0.0
            for s in sorted(part, key=lambda s: (-self.weight[s], s)):
                self.keys[s].append(n)
                weight += self.weight[s] * part[s]
                if weight > (1 - SIMILARITY) * self.total[n] + _ROUNDING:
                    break
        self.prints = np.stack([_fingerprint(self._sum(x[2])) for x in self.items]) if self.items else None
        self.blocks = {}
        for size, members in self.by_size.items():
            table = [defaultdict(list) for _ in range(BLOCKS)]
            for n in members:
                for b, value in enumerate(self.prints[n].tolist()):
                    for near in _NEAR[value]:
                        table[b][near].append(n)
            self.blocks[size] = table

    def weights(self, shingles: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """What each shingle adds to a fingerprint, and whether an item holds it: others add nothing.

        The root of the weight, so that the product of two windows is the weight they share; whole numbers,
        so that sums do not depend on their order and equal windows have equal fingerprints.
        """
        at = np.minimum(np.searchsorted(self.known, shingles), len(self.known) - 1)
        held = self.known[at] == shingles
        return np.where(held, np.rint(np.sqrt(self.known_weight[at]) * (1 << 20)), 0.0), held

    def _sum(self, shingles: np.ndarray) -> np.ndarray:
        return (_bits(shingles) * self.weights(shingles)[0][:, None]).sum(axis=0)

    def _similarity(self, item: int, window: np.ndarray) -> float:
        """The share of an item's shingle weight that a window holds, counting repeats."""
        part = self.parts[item]
        seen = Counter(window.tolist())
        return sum(self.weight[s] * min(k, seen[s]) for s, k in part.items() if s in seen) / self.total[item]

    def find(self, text: str | None) -> list[tuple[int, float, int, int]]:
        """(item_id, similarity, first word, words) of every item with a window similar to it, at its best window."""
        words = word_hashes(text)
        best: dict[int, tuple[float, int]] = {}
        for width in sorted({min(SHINGLE_WORDS, size) for size in self.by_size}):
            if len(words) < width:
                continue
            shingles = _runs(words, width)
            weight, held = self.weights(shingles)
            hits = np.flatnonzero(held)
            starts: dict[int, set[int]] = defaultdict(set)
            for at in hits.tolist():
                for size in self.sizes_of[int(shingles[at])]:
                    if min(SHINGLE_WORDS, size) == width:
                        low, high = max(0, at - (size - width)), min(at, len(words) - size)
                        starts[size].update(range(low, high + 1))
                        if high < low:  # the whole text is shorter than the item
                            starts[size].add(0)
            for size, places in starts.items():
                self._windows(size, size - width + 1, np.array(sorted(places)), shingles, weight, best)
            self._by_keys(hits, shingles, width, len(words), best)
        return [(self.items[n][0], round(s, 6), at, self.items[n][1]) for n, (s, at) in sorted(best.items())]

    def _windows(self, size, n_shingles, places, shingles, weight, best) -> None:
        """Fingerprints of windows at ``places``, from running sums over each stretch of neighbouring windows."""
        for stretch in np.split(places, np.flatnonzero(np.diff(places) > n_shingles) + 1):
            for at in range(0, len(stretch), 4096):
                some = stretch[at : at + 4096]
                low, high = int(some[0]), min(len(shingles), int(some[-1]) + n_shingles)
                run = np.zeros((high - low + 1, 128))
                np.cumsum(_bits(shingles[low:high]) * weight[low:high, None], axis=0, out=run[1:])
                end = np.minimum(some - low + n_shingles, high - low)
                prints = _fingerprint(run[end] - run[some - low])
                for place, print_ in zip(some.tolist(), prints):
                    near = {n for b, v in enumerate(print_.tolist()) for n in self.blocks[size][b].get(v, ())}
                    for n in near:
                        if int(np.bitwise_count(self.prints[n] ^ print_).sum()) <= RADIUS:
                            s = self._similarity(n, shingles[place : place + n_shingles])
                            if s >= SIMILARITY and s > best.get(n, (0.0, 0))[0]:
                                best[n] = s, place

    def _by_keys(self, hits, shingles, width, n_words, best) -> None:
        """The best windows of all items of which a key stands in the text; whole copies are known already."""
        where = defaultdict(list)
        for at in hits.tolist():
            where[int(shingles[at])].append(at)
        for n in {n for s in where for n in self.keys.get(s, ())}:
            size = self.items[n][1]
            if min(SHINGLE_WORDS, size) == width and best.get(n, (0.0, 0))[0] < 1:
                found = self._best_window(n, size - width + 1, max(0, n_words - size), where, shingles)
                if found and found[0] >= SIMILARITY:
                    best[n] = found

    def _best_window(self, n, n_shingles, last, where, shingles) -> tuple[float, int] | None:
        """Similarity and place of the first most similar window of an item, from sums that change where shingles come and go."""
        part, weight = self.parts[n], self.weight
        present = [s for s in part if s in where]
        least = SIMILARITY * self.total[n] - _ROUNDING
        if sum(weight[s] * min(part[s], len(where[s])) for s in present) < least:
            return None
        moves = sorted(
            move for s in present for at in where[s] for move in ((max(0, at - n_shingles + 1), 1, s), (at + 1, -1, s))
        )
        seen, share, shares = Counter(), 0.0, {}
        for place, step, s in moves:
            if place > last:
                break
            if step < 0:
                seen[s] -= 1
            if seen[s] < part[s]:
                share += step * weight[s]
            if step > 0:
                seen[s] += 1
            shares[place] = share
        least = max(least, max(shares.values(), default=0.0) - _ROUNDING)
        places = sorted(place for place, share in shares.items() if share >= least)
        found = [(self._similarity(n, shingles[at : at + n_shingles]), -at) for at in places]
        return (max(found)[0], -max(found)[1]) if found else None


def _runs(words: np.ndarray, width: int) -> np.ndarray:
    """Shingles of ``width`` words; those of short items are hashed as the whole short item is."""
    if width == SHINGLE_WORDS or len(words) == width:
        return shingle_hashes(words)
    return np.concatenate([shingle_hashes(words[i : i + width]) for i in range(len(words) - width + 1)])


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row per document and item it holds: ``doc_id``, ``item_id``, ``similarity``, ``start_word``, ``n_words``.

    A document holds an item if in some window with as many words as the item the item's 5-word shingles have at
    least 0.75 of their weight. Words and case are those of the other operators. Fingerprints are made
    of windows with a shingle of an item of their size; other windows cannot be similar to any. Near copies that
    fingerprints miss are found by the item's rarest shingles, so none is lost. Of several windows
    the most similar counts, then the first.

    A shingle held by n different items of the benchmark weighs 1 / (1 + ln n); items of the same words are one.

    The benchmark is split by a hash into blocks of about 4 MB. Each block is sent to the executors once and
    meets all documents, which stay where they are, so neither side is ever moved as a whole. Weights are counted
    over the whole benchmark, so the blocks change no result.

    NULL and wordless texts hold nothing, and items without words are held by none. An item of fewer than five
    words is one shingle, held where all its words stand. Repeated documents and items give a row for each pair.
    Rows without an id keep it as NULL. Other columns are ignored. Empty tables give no rows.
    """
    out = None
    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").alias("text"))
    for block in _item_blocks(benchmark):
        found = _with_block(docs, block)
        out = found if out is None else out.union(found)
    return out


#: Items, then the shingles among theirs that several items of the benchmark hold, and how many do.
Block = tuple[list[tuple[int, str | None]], tuple[np.ndarray, np.ndarray]]


def _item_shingles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each item's block, the digest of its words and its distinct shingles."""
    for batch in batches:
        shingles = [shingle_hashes(word_hashes(t)) for t in batch.column("text").to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("block"),
                pa.array([hashlib.md5(x.tobytes()).digest() for x in shingles], pa.binary()),
                pa.array([np.unique(x).view(np.int64) for x in shingles], pa.list_(pa.int64())),
            ],
            names=["block", "words", "shingles"],
        )


def _item_blocks(benchmark: DataFrame) -> Iterator[Block]:
    """The benchmark in blocks of about ``BLOCK_BYTES``, one at a time; one block if it is empty."""
    items = benchmark.select(F.col("item_id").cast("bigint").alias("item_id"), F.col("text").alias("text"))
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = 1 + total // BLOCK_BYTES
    items = items.withColumn("block", F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)))
    rows = items.select("block", "text").mapInArrow(_item_shingles, "block bigint, words binary, shingles array<bigint>")
    rows = rows.select("block", "words", F.explode("shingles").alias("shingle"))
    counts = rows.select("words", "shingle").distinct().groupBy("shingle").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    shared = materialized(rows.select("block", "shingle").distinct().join(counts, "shingle"), "shared-shingles")
    for block in range(blocks):
        mine = items.where(F.col("block") == block).select("item_id", "text").collect()
        held = shared.where(F.col("block") == block).toPandas()
        yield [tuple(r) for r in mine], (held["shingle"].to_numpy(np.int64), held["n"].to_numpy(np.int64))


def _with_block(docs: DataFrame, block: Block) -> DataFrame:
    sent = docs.sparkSession.sparkContext.broadcast(block)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = Index(*sent.value)
        for batch in batches:
            rows = []
            if index.items:
                for i, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                    rows += [(i, *x) for x in index.find(text)]
            columns = list(zip(*rows)) or [()] * 5
            kinds = (pa.int64(), pa.int64(), pa.float64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds)],
                names=["doc_id", "item_id", "similarity", "start_word", "n_words"],
            )

    fields = "doc_id bigint, item_id bigint, similarity double, start_word bigint, n_words bigint"
    return docs.mapInArrow(search, fields)


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` that hold no item, with all their columns; texts are not moved."""
    for block in _item_blocks(benchmark):
        docs = docs.where(~_holds(docs, block)("text"))
    return docs


def _holds(docs: DataFrame, block: Block):
    sent = docs.sparkSession.sparkContext.broadcast(block)

    @F.pandas_udf(BooleanType())
    def holds(series: Iterator[pd.Series]) -> Iterator[pd.Series]:
        index = Index(*sent.value)
        for texts in series:
            yield pd.Series([bool(index.items and index.find(t)) for t in texts], dtype="bool")

    return holds
