"""A word bigram model with modified Kneser-Ney smoothing: counted by Spark, kept as sorted hash arrays.

A word is numbered by the place of its hash among the sorted hashes of all training words. A pair of
words is the key ``context << 32 | word``, so pairs need no hash of their own and all words after one
context stand together. Both tables lie in the shared folder as plain arrays, cut into pieces whose
size does not depend on the corpus; workers map the pieces a batch of texts asks for.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from urllib.parse import unquote, urlparse

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paytrail.llm.text import _BYTE, _SPACE, _powers_to, mix
from paytrail.session import scratch_path

#: Bytes of training text for one piece of the vocabulary, and pairs for one piece of the pair table.
VOCABULARY_BYTES = 64 << 20
PAIRS_PER_PIECE = 2_000_000

#: The hash of the end of a text, which is also what stands before its first word.
END = np.uint64(0x5DEECE66D1CE4E5B)

_TOKENS_PER_ROUND = 1_000_000
_ROUND_BYTES = 1 << 19
_TOKENS_PER_SEND = 4_000_000
_LEVELS = 4


# --- texts as arrays of hashes -----------------------------------------------------------------


def _hash_words(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    """The 64-bit hash of each word of lower-cased UTF-8, and the place where it begins."""
    codes = np.frombuffer(raw, dtype=np.uint8)
    inside = ~_SPACE[codes]
    edge = np.flatnonzero(np.diff(inside, prepend=False, append=False))
    start, end = edge[0::2], edge[1::2]
    up, down = _powers_to(len(codes) + 1)
    total = np.zeros(len(codes) + 1, dtype=np.uint64)
    np.cumsum(_BYTE[codes] * up[: len(codes)], out=total[1:])
    return mix((total[end] - total[start]) * down[start] + (end - start).astype(np.uint64)), start


def _tokens(texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of each text, an end after each, and the place of each end."""
    texts = [(t or b"").lower() for t in texts]
    hashes, sizes, first = [], np.zeros(len(texts), dtype=np.int64), 0
    while first < len(texts):
        last, length = first, 0
        while last < len(texts) and (last == first or length + len(texts[last]) < _ROUND_BYTES):
            length += len(texts[last]) + 1
            last += 1
        found, start = _hash_words(b"\n".join(texts[first:last]))
        ends = np.cumsum([len(t) + 1 for t in texts[first:last]])
        sizes[first:last] = np.diff(np.searchsorted(start, ends), prepend=0)
        hashes.append(found)
        first = last
    end = np.cumsum(sizes + 1) - 1
    out = np.empty(int(sizes.sum()) + len(texts), dtype=np.uint64)
    word = np.ones(len(out), dtype=bool)
    word[end] = False
    out[word] = np.concatenate(hashes) if hashes else out[:0]
    out[end] = END
    return out, end


def _rounds(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Slices of the batches of about a million tokens, or of one longer text, with their tokens."""
    for batch in batches:
        texts = batch.column("text").cast(pa.binary()).to_pylist()
        first = 0
        while first < len(texts):
            last, size = first, 0
            while last < len(texts) and (last == first or size < 4 * _TOKENS_PER_ROUND):
                size += len(texts[last] or b"")
                last += 1
            yield batch.slice(first, last - first), *_tokens(texts[first:last])
            first = last


# --- arrays in the shared folder ---------------------------------------------------------------


def _shared(spark: SparkSession, label: str) -> str:
    """A new folder in the shared folder, with the scheme that tells workers where it lies."""
    path = spark._jvm.org.apache.hadoop.fs.Path(scratch_path(spark, label))
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(path).toString()


def _local(uri: str) -> str | None:
    parsed = urlparse(uri)
    return unquote(parsed.path) if parsed.scheme in ("", "file") else None


def _store(folder: str, arrays: dict[str, np.ndarray]) -> str:
    """Write arrays under a name of their own, so that a task that runs twice disturbs nothing."""
    base = f"{folder}/{uuid.uuid4().hex}"
    for name, values in arrays.items():
        local = _local(f"{base}.{name}")
        system, path = (fs.LocalFileSystem(), local) if local else fs.FileSystem.from_uri(f"{base}.{name}")
        system.create_dir(path.rpartition("/")[0])
        with system.open_output_stream(path) as out:
            out.write(np.ascontiguousarray(values).tobytes())
    return base


def _map(base: str, name: str, kind) -> np.ndarray:
    """A stored array: mapped where the shared folder is mounted, read piece by piece elsewhere."""
    local = _local(f"{base}.{name}")
    if local:
        return np.memmap(local, dtype=kind, mode="r")
    system, path = fs.FileSystem.from_uri(f"{base}.{name}")
    with system.open_input_file(path) as file:
        return np.frombuffer(file.read(), dtype=kind)


def _runs(bounds: np.ndarray, sorted_values: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """Piece and slice of sorted values, for each piece that begins at its bound and is asked for."""
    cuts = np.concatenate([[0], np.searchsorted(sorted_values, bounds[1:]), [len(sorted_values)]])
    for piece in np.flatnonzero(np.diff(cuts)):
        yield int(piece), int(cuts[piece]), int(cuts[piece + 1])


def _sums(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order with the sum of their counts."""
    if not len(keys):
        return keys, counts
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return keys[first], np.add.reduceat(counts[order], first)


# --- the model ---------------------------------------------------------------------------------


@dataclass
class Model:
    """Where the arrays lie, and the few numbers that hold for the whole model.

    ``words`` are the pieces of the vocabulary by hash, with ``offsets`` as the number of their first
    word; ``pairs`` the pieces of the pair table by key. ``pair_discounts`` and ``word_discounts`` are taken
    off counts of 1, 2 and more.
    """

    words: list[str] = field(default_factory=list)
    word_bounds: np.ndarray = field(default_factory=lambda: np.zeros(1, np.uint64))
    offsets: np.ndarray = field(default_factory=lambda: np.zeros(1, np.int64))
    stats: list[str] = field(default_factory=list)
    pairs: list[str | None] = field(default_factory=list)
    pair_bounds: np.ndarray = field(default_factory=lambda: np.zeros(1, np.uint64))
    tokens: int = 0
    distinct_words: int = 0
    distinct_pairs: int = 0
    word_levels: np.ndarray = field(default_factory=lambda: np.zeros(3, np.int64))
    pair_discounts: np.ndarray = field(default_factory=lambda: np.zeros(4))
    word_discounts: np.ndarray = field(default_factory=lambda: np.zeros(4))

    def numbers(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The number of each word in sorted ``hashes`` and its count; -1 and 0 for an unknown one."""
        number, count = np.full(len(hashes), -1, dtype=np.int64), np.zeros(len(hashes), dtype=np.int64)
        if not self.words:
            return number, count
        for piece, lo, hi in _runs(self.word_bounds, hashes):
            known = _map(self.words[piece], "hash", np.uint64)
            at = np.minimum(np.searchsorted(known, hashes[lo:hi]), len(known) - 1)
            hit = known[at] == hashes[lo:hi]
            number[lo:hi][hit] = at[hit] + self.offsets[piece]
            count[lo:hi][hit] = _map(self.words[piece], "count", np.int64)[at[hit]]
        return number, count

    def stat(self, names: list[str], numbers: np.ndarray) -> list[np.ndarray]:
        """Stored figures of the words with the given sorted numbers."""
        out = [np.empty(len(numbers), dtype=np.int64) for _ in names]
        for piece, lo, hi in _runs(self.offsets, numbers):
            for name, values in zip(names, out):
                values[lo:hi] = _map(self.stats[piece], name, np.int64)[numbers[lo:hi] - self.offsets[piece]]
        return out

    def pair_counts(self, keys: np.ndarray) -> np.ndarray:
        """How often each pair of sorted ``keys`` occurs in training."""
        count = np.zeros(len(keys), dtype=np.int64)
        for piece, lo, hi in _runs(self.pair_bounds, keys):
            if self.pairs[piece] is not None:
                known = _map(self.pairs[piece], "key", np.uint64)
                at = np.minimum(np.searchsorted(known, keys[lo:hi]), len(known) - 1)
                hit = known[at] == keys[lo:hi]
                count[lo:hi][hit] = _map(self.pairs[piece], "count", np.uint32)[at[hit]]
        return count

    def word_probability(self, numbers: np.ndarray) -> np.ndarray:
        """By how many different words precede a word; a share goes evenly to all words and an unknown one."""
        if not self.distinct_pairs:
            return np.full(len(numbers), 1 / (self.distinct_words + 1))
        spread = float(self.word_levels @ self.word_discounts[1:]) / self.distinct_pairs
        even = spread / (self.distinct_words + 1)
        known = numbers >= 0
        out = np.full(len(numbers), even)
        (before,) = self.stat(["before"], numbers[known])
        out[known] += np.maximum(before - self.word_discounts[np.minimum(before, 3)], 0) / self.distinct_pairs
        return out

    def probability(self, context: np.ndarray, seen: np.ndarray, word: np.ndarray, lower: np.ndarray) -> np.ndarray:
        """Of words after contexts, both as numbers: pairs sorted by context, then word; ``seen`` counts the contexts."""
        out = lower.copy()
        known = context >= 0
        context, word, seen = context[known], word[known], seen[known]
        count = np.zeros(len(word), dtype=np.int64)
        both = word >= 0
        count[both] = self.pair_counts(_keys(context[both], word[both]))
        changed = np.concatenate([[True], context[1:] != context[:-1]]) if len(context) else np.zeros(0, bool)
        group = np.cumsum(changed) - 1
        levels = np.stack(self.stat(["once", "twice", "more"], context[changed]))
        left = self.pair_discounts[1:] @ levels
        out[known] = (np.maximum(count - self.pair_discounts[np.minimum(count, 3)], 0) + left[group] * lower[known]) / seen
        return out


def _keys(context: np.ndarray, word: np.ndarray) -> np.ndarray:
    return (context.astype(np.uint64) << np.uint64(32)) | word.astype(np.uint64)


def _discounts(levels: list[int]) -> np.ndarray:
    """What counts of 0, 1, 2 and 3 or more lose, by how many occur one to four times.

    Where a level is empty the estimate does not exist: half of one, one, and one and a half stand in.
    """
    n1, n2, n3, n4 = levels
    if not all(levels):
        return np.array([0, 0.5, 1, 1.5])
    y = n1 / (n1 + 2 * n2)
    found = [1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3]
    return np.array([0, *[min(max(d, 0.05), k) for k, d in zip((1, 2, 3), found)]])


def _at_levels(counts: np.ndarray) -> list[int]:
    return np.bincount(np.minimum(counts, _LEVELS + 1), minlength=_LEVELS + 2)[1 : _LEVELS + 1].tolist()


# --- counting ----------------------------------------------------------------------------------

_PART = "piece int, keys binary, counts binary"


def _send(bounds: np.ndarray, keys: np.ndarray, counts: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Sorted keys with counts, cut into one row per piece."""
    rows = [(p, keys[a:b].tobytes(), counts[a:b].astype(np.uint32).tobytes()) for p, a, b in _runs(bounds, keys)]
    if rows:
        piece, packed, times = zip(*rows)
        yield pa.RecordBatch.from_arrays(
            [pa.array(piece, pa.int32()), pa.array(packed, pa.binary()), pa.array(times, pa.binary())], names=["piece", "keys", "counts"]
        )


def _gather(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """The rows of one piece, merged."""
    keys = np.concatenate([np.frombuffer(x, np.uint64) for x in table.column("keys").to_pylist()])
    counts = np.concatenate([np.frombuffer(x, np.uint32) for x in table.column("counts").to_pylist()])
    return _sums(keys, counts.astype(np.int64))


def _counter(bounds: np.ndarray, keys_of: Callable[[np.ndarray, np.ndarray], np.ndarray]):
    """Distinct keys of a task's texts, counted before they move; sent on whenever they are many."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for _, tokens, end in _rounds(batches):
            keys, counts = np.unique(keys_of(tokens, end), return_counts=True)
            held.append((keys, counts))
            size += len(keys)
            if size >= _TOKENS_PER_SEND:
                merged = _sums(*map(np.concatenate, zip(*held)))
                held, size = [merged], len(merged[0])
                if size >= _TOKENS_PER_SEND // 2:
                    yield from _send(bounds, *merged)
                    held, size = [], 0
        if held:
            yield from _send(bounds, *_sums(*map(np.concatenate, zip(*held))))

    return count


def _word_writer(folder: str, per_piece: int):
    """Stores a piece of the vocabulary and says where the pair table can be cut.

    A cut is the place of a word and, for words that alone fill several pieces of pairs, how many.
    """

    def write(table: pa.Table) -> pa.Table:
        keys, counts = _gather(table)
        base = _store(folder, {"hash": keys, "count": counts})
        group = np.cumsum(counts) // per_piece
        first = np.flatnonzero(np.diff(group, prepend=0) != 0)
        parts = -(-counts[first] // per_piece)
        return pa.table(
            {
                "piece": pa.array([table.column("piece")[0].as_py()], pa.int32()), "base": [base], "n": pa.array([len(keys)], pa.int64()),
                "tokens": pa.array([int(counts.sum())], pa.int64()), "cuts": pa.array([first.tolist()], pa.list_(pa.int64())),
                "parts": pa.array([parts.tolist()], pa.list_(pa.int64())),
            }
        )

    return write


_ONCE, _TWICE, _MORE, _BEFORE = range(4)


def _pair_writer(folder: str, model: Model):
    """Stores a piece of the pair table; sends what it knows of contexts and of preceding words to the words' pieces."""

    def write(table: pa.Table) -> pa.Table:
        keys, counts = _gather(table)
        piece = table.column("piece")[0].as_py()
        base = _store(folder, {"key": keys, "count": np.minimum(counts, (1 << 32) - 1).astype(np.uint32)})
        context, word = (keys >> np.uint64(32)).astype(np.int64), (keys & np.uint64((1 << 32) - 1)).astype(np.int64)
        kinds = [context[counts == 1], context[counts == 2], context[counts > 2], word]
        rows = []
        for kind, numbers in enumerate(kinds):
            number, n = np.unique(numbers, return_counts=True)
            for p, a, b in _runs(model.offsets, number):
                rows.append((p, kind, (number[a:b] - model.offsets[p]).astype(np.uint32).tobytes(), n[a:b].astype(np.uint32).tobytes(), None, None))
        # One row describes the piece itself: -1 marks it.
        levels = np.array([len(keys), *_at_levels(counts)], dtype=np.int64)
        rows.append((-1, piece, levels.tobytes(), None, base, piece))
        to, kind, numbers, n, where, own = zip(*rows)
        return pa.table(
            {
                "to": pa.array(to, pa.int32()), "kind": pa.array(kind, pa.int32()), "numbers": pa.array(numbers, pa.binary()),
                "counts": pa.array(n, pa.binary()), "base": pa.array(where, pa.string()), "piece": pa.array(own, pa.int32()),
            }
        )

    return write


def _stat_writer(folder: str, sizes: list[int]):
    """Stores, for each word of a piece, its pairs that occur once, twice and more, and the words before it."""

    def write(table: pa.Table) -> pa.Table:
        piece = table.column("to")[0].as_py()
        found = np.zeros((4, sizes[piece]), dtype=np.int64)
        for kind, numbers, counts in zip(*(table.column(c).to_pylist() for c in ("kind", "numbers", "counts"))):
            found[kind][np.frombuffer(numbers, np.uint32)] += np.frombuffer(counts, np.uint32)
        base = _store(folder, dict(zip(("once", "twice", "more", "before"), found)))
        before = found[_BEFORE]
        levels = [*_at_levels(before), int((before >= 3).sum())]
        return pa.table({"piece": pa.array([piece], pa.int32()), "base": [base], "levels": pa.array([levels], pa.list_(pa.int64()))})

    return write


def fit(docs: DataFrame, text_col: str = "text", vocabulary_bytes: int = VOCABULARY_BYTES, pairs_per_piece: int = PAIRS_PER_PIECE) -> Model:
    """Count all texts of ``docs`` into a model whose arrays lie in the shared folder.

    Three shuffles, each of distinct keys that tasks have counted before: word hashes by range, pairs by
    key range, figures per word by number. The ranges of pairs are cut by the counts of their contexts, a
    frequent context into several, so a piece holds about ``pairs_per_piece`` pairs whatever the corpus.
    The driver sees one row per piece. A task that is lost or repeated writes under new names; only
    names that its result states are used.

    NULL and empty texts are one end of text. No training rows give a model that holds every word for
    unknown. More than 2^32 distinct words are an error.
    """
    spark = docs.sparkSession
    texts = docs.select(docs[text_col].cast("string").alias("text"))
    size, rows = texts.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)), F.count(F.lit(1))).first()
    model = Model()
    if not rows:
        return model
    folder = _shared(spark, "ngrams")

    pieces = int(size) // vocabulary_bytes + 1
    bounds = np.array([(i << 64) // pieces for i in range(pieces)], dtype=np.uint64)
    words = (
        texts.mapInArrow(_counter(bounds, lambda tokens, end: tokens), _PART)
        .groupBy("piece")
        .applyInArrow(_word_writer(folder, pairs_per_piece), "piece int, base string, n bigint, tokens bigint, cuts array<bigint>, parts array<bigint>")
        .orderBy("piece")
        .collect()
    )
    model.words = [r.base for r in words]
    model.word_bounds = bounds[[r.piece for r in words]]
    model.word_bounds[0] = 0
    ends = np.cumsum([r.n for r in words])
    model.offsets = ends - [r.n for r in words]
    model.distinct_words, model.tokens = int(ends[-1]), sum(r.tokens for r in words)
    if model.distinct_words >= 1 << 32:
        raise ValueError("a corpus of 2^32 distinct words or more has no word numbers")

    cuts = {0}
    for r, offset in zip(words, model.offsets.tolist()):
        for at, parts in zip(r.cuts, r.parts):
            context = (offset + at) << 32
            cuts.update(context + model.distinct_words * k // parts for k in range(parts))
            if parts > 1:
                cuts.add(context + (1 << 32))
    model.pair_bounds = np.array(sorted(c for c in cuts if c < model.distinct_words << 32), dtype=np.uint64)

    told = (
        texts.mapInArrow(_counter(model.pair_bounds, _pair_keys(model)), _PART)
        .groupBy("piece")
        .applyInArrow(_pair_writer(folder, model), "to int, kind int, numbers binary, counts binary, base string, piece int")
    )
    path = scratch_path(spark, "figures")
    told.write.parquet(path)
    told = spark.read.schema(told.schema).parquet(path)
    model.pairs = [None] * len(model.pair_bounds)
    levels = np.zeros(_LEVELS + 1, dtype=np.int64)
    for r in told.where("to = -1").select("piece", "base", "numbers").collect():
        model.pairs[r.piece] = r.base
        levels += np.frombuffer(bytes(r.numbers), np.int64)
    model.distinct_pairs, model.pair_discounts = int(levels[0]), _discounts(levels[1:].tolist())

    stats = (
        told.where("to >= 0")
        .groupBy("to")
        .applyInArrow(_stat_writer(folder, [r.n for r in words]), "piece int, base string, levels array<bigint>")
        .orderBy("piece")
        .collect()
    )
    model.stats = [r.base for r in stats]
    levels = np.sum([r.levels for r in stats], axis=0)
    model.word_levels = np.array([levels[0], levels[1], levels[-1]], dtype=np.int64)
    model.word_discounts = _discounts(levels[:-1].tolist())
    return model


def _pair_keys(model: Model) -> Callable[[np.ndarray, np.ndarray], np.ndarray]:
    def keys(tokens: np.ndarray, end: np.ndarray) -> np.ndarray:
        distinct, place = np.unique(tokens, return_inverse=True)
        word = model.numbers(distinct)[0][place]
        return _keys(_before(word), word)

    return keys


def _before(values: np.ndarray) -> np.ndarray:
    """Of each token, the value of the one before it; a text begins after an end, as the last one has."""
    return np.concatenate([values[-1:], values[:-1]])


# --- scoring -----------------------------------------------------------------------------------


def _scorer(model: Model):
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, tokens, end in _rounds(batches):
            distinct, place = np.unique(tokens, return_inverse=True)
            number, count = model.numbers(distinct)
            lower = model.word_probability(number)
            base = np.log10((count + 0.5) / (model.tokens + 0.5 * (model.distinct_words + 1)))

            pair, where = np.unique(_before(place).astype(np.int64) * len(distinct) + place, return_inverse=True)
            # Numbers rise with the hashes, so pairs of places are in the order of pairs of numbers.
            context, word = pair // len(distinct), pair % len(distinct)
            likely = np.log10(model.probability(number[context], count[context], number[word], lower[word]))

            first = np.concatenate([[0], end[:-1] + 1]).astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    batch.column("held_out"),
                    pa.array(end - first + 1, pa.int64()),
                    pa.array(np.add.reduceat((count > 0)[place].astype(np.int64), first), pa.int64()),
                    pa.array(np.full(len(end), model.tokens), pa.int64()),
                    pa.array(np.add.reduceat(base[place], first)),
                    pa.array(np.add.reduceat(likely[where], first)),
                ],
                names=["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"],
            )

    return score


def score_texts(docs: DataFrame, model: Model) -> DataFrame:
    """Score rows of ``doc_id``, ``held_out`` and ``text`` in place, without a shuffle."""
    return docs.mapInArrow(
        _scorer(model),
        "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double",
    )


def score_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", folds: int = 5, held: int = 1) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``held_out``, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score``, ``score``, ``perplexity``.

    Rows whose crc32 of the id in decimal is ``held`` modulo ``folds`` are held out; the model learns from all
    others. Tokens are the words, A-Z lower-cased, and one end per text. ``score`` is the log10 probability
    that the model gives the text, ``base_score`` that of single words with half a count added. An unknown
    word shares what smoothing sets aside, so no score is infinite and the probabilities of all words and
    one unknown word after a context sum to one.

    NULL and empty texts are one end. Rows without an id count as training rows. Repeated rows count and are
    scored each. Very long texts are whole: memory grows with the longest. Without training rows every
    token is unknown and both scores are 0. An empty table gives no rows. Other columns are ignored.
    """
    crc = F.crc32(docs[id_col].cast("string").cast("binary"))
    out = F.coalesce(F.pmod(crc, F.lit(folds)) == held, F.lit(False))
    rows = docs.select(docs[id_col].cast("bigint").alias("doc_id"), out.alias("held_out"), docs[text_col].cast("string").alias("text"))
    model = fit(rows.where(~out))
    found = score_texts(rows, model)
    return found.withColumn("perplexity", F.pow(F.lit(10.0), -F.col("score") / F.col("n_tokens")))
