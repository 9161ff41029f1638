"""MinHash near-duplicates of documents with HyperMinHash registers.

A document's sketch holds one 16-bit register per hash function: the number of leading zeros of
the smallest hash value and the mantissa bits behind them. Every register has a hash function of
its own (instead of a share of one function's range), since short texts would leave shared
ranges empty. Bands of registers propose pairs, a collision-corrected estimate sieves them, and
the full shingle sets confirm them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DoubleType

from paytrail.llm.components import components
from paytrail.llm.text import SHINGLE_WORDS, mix, shingle_hashes, shingle_set, word_hashes
from paytrail.session import materialized

#: Registers form a grid; its 40 rows and its 40 diagonals are bands of 7 registers. A link at 0.75 shares no
#: band with a probability of about (1 - 0.75^7)^80 = 1e-5, texts that share a passage at 0.2 do with 0.1%.
LINES, ROWS = 40, 7
REGISTERS = LINES * ROWS
MANTISSA_BITS = 10
SIMILARITY = (75, 100)
#: An estimate this far below the threshold is 5 standard errors of 280 registers away.
SLACK = 0.13

_ODD = np.random.default_rng(8).integers(0, 1 << 31, REGISTERS, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
_BLOCK = 4096
#: Members of a group whose full sets are compared in one task.
BLOCK = 256
_chances: dict[tuple[int, int], float] = {}


def smallest(hashes: np.ndarray) -> np.ndarray:
    """The smallest value of each hash function over a set of shingle hashes."""
    h = (hashes >> np.uint64(32)).astype(np.uint32)
    out = np.full(REGISTERS, 0xFFFFFFFF, dtype=np.uint32)
    for at in range(0, len(h), _BLOCK):
        part = h[at : at + _BLOCK]
        scratch = np.empty((max(1, 65536 // len(part)), len(part)), dtype=np.uint32)
        for k in range(0, REGISTERS, len(scratch)):
            odd = _ODD[k : k + len(scratch)]
            values = np.multiply(odd[:, None], part[None, :], out=scratch[: len(odd)])
            np.minimum(out[k : k + len(odd)], values.min(axis=1), out=out[k : k + len(odd)])
    return out


def registers(low: np.ndarray) -> np.ndarray:
    """Leading zeros (high bits) and mantissa (low bits) of 32-bit minima."""
    fraction, exponent = np.frexp(low.astype(np.float64))
    zeros = np.minimum(32 - exponent, 33).astype(np.uint16)
    mantissa = ((fraction * 2 - 1).clip(0) * (1 << MANTISSA_BITS)).astype(np.uint16)
    return (zeros << np.uint16(MANTISSA_BITS)) | mantissa


def _chance(log_a: int, log_b: int) -> float:
    """How often registers of unrelated sets of 2^(log/4) shingles agree: the sum over all register values."""
    if (log_a, log_b) in _chances:
        return _chances[log_a, log_b]
    zeros = np.arange(33)[:, None]
    steps = np.arange((1 << MANTISSA_BITS) + 1)[None, :] / (1 << MANTISSA_BITS)
    edges = (1 + steps) * 2.0 ** -(zeros + 1)

    def share(log_n: int) -> np.ndarray:
        above = np.exp(2 ** (log_n / 4) * np.log1p(-np.minimum(edges, 1 - 1e-12)))
        return above[:, :-1] - above[:, 1:]

    _chances[log_a, log_b] = float((share(log_a) * share(log_b)).sum())
    return _chances[log_a, log_b]


def estimate(regs_a: bytes, regs_b: bytes, n_a: int, n_b: int) -> float:
    """Jaccard similarity from the share of equal registers, less the agreements that chance gives."""
    equal = float(np.mean(np.frombuffer(regs_a, np.uint16) == np.frombuffer(regs_b, np.uint16)))
    chance = _chance(round(4 * np.log2(max(n_a, 1))), round(4 * np.log2(max(n_b, 1))))
    return max(0.0, (equal - chance) / (1 - chance))


def _sketches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        n, sets, regs = [], [], []
        for text in batch.column("text").to_pylist():
            found = np.unique(shingle_hashes(word_hashes(text)))
            n.append(len(found))
            if not len(found):
                sets.append(None)
                regs.append(None)
                continue
            totals = np.array([found.sum(dtype=np.uint64), mix(found).sum(dtype=np.uint64)])
            sets.append(totals.tobytes())
            regs.append(registers(smallest(found)).tobytes())
        yield pa.RecordBatch.from_arrays(
            [batch.column("id"), pa.array(n, pa.int64()), pa.array(sets, pa.binary()), pa.array(regs, pa.binary())],
            names=["id", "n", "set_key", "regs"],
        )


def sketches(docs: DataFrame) -> DataFrame:
    """Per row of docs (id, text): number of shingles, a 128-bit key of the set, and the registers."""
    return docs.mapInArrow(_sketches, "id bigint, n bigint, set_key binary, regs binary")


@F.pandas_udf(DoubleType())
def _estimate(ra: pd.Series, rb: pd.Series, na: pd.Series, nb: pd.Series) -> pd.Series:
    return pd.Series([estimate(*x) for x in zip(ra, rb, na, nb)], dtype="float64")


@F.pandas_udf(BooleanType())
def _confirmed(ta: pd.Series, tb: pd.Series) -> pd.Series:
    over, of = SIMILARITY
    out, last, seen = [], object(), frozenset()
    for a, b in zip(ta, tb):
        if a is not last:
            last, seen = a, shingle_set(a)
        other = shingle_set(b)
        common = len(seen & other)
        out.append(of * common >= over * (len(seen) + len(other) - common))
    return pd.Series(out, dtype="bool")


def _links(pairs: DataFrame, reps: DataFrame, texts: DataFrame) -> DataFrame:
    """Of pairs (a, b), those whose estimate comes near the threshold and whose full sets reach it."""
    over, of = SIMILARITY

    def sketch(s: str) -> DataFrame:
        return reps.select(F.col("id").alias(s), F.col("n").alias(f"n_{s}"), F.col("regs").alias(f"regs_{s}"))

    def full(s: str) -> DataFrame:
        return texts.select(F.col("id").alias(s), F.col("text").alias(f"text_{s}"))

    sized = pairs.join(sketch("a"), "a").join(sketch("b"), "b").where(
        (F.col("n_a") * of >= F.col("n_b") * over) & (F.col("n_b") * of >= F.col("n_a") * over)
    )
    near = sized.where(_estimate("regs_a", "regs_b", "n_a", "n_b") >= over / of - SLACK).select("a", "b")
    both = near.join(full("b"), "b").join(full("a"), "a")
    return materialized(both.where(_confirmed("text_a", "text_b")).select("a", "b"), "confirmed")


def _bands(reps: DataFrame) -> DataFrame:
    """Id and hash of each band of a sketch."""

    def register(line, column):
        return F.substring("regs", 2 * (F.pmod(line, F.lit(LINES)) * ROWS + column) + 1, F.lit(2))

    lines = F.sequence(F.lit(0), F.lit(LINES - 1))
    rows = F.transform(lines, lambda k: F.xxhash64(k, *[register(k, c) for c in range(ROWS)]))
    diagonals = F.transform(lines, lambda k: F.xxhash64(k + LINES, *[register(k + c, c) for c in range(ROWS)]))
    return reps.select("id", F.explode(F.concat(rows, diagonals)).alias("band"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``n_shingles``, ``component_id``, ``kept``.

    Links are pairs with Jaccard similarity of at least 0.75 on distinct 5-word shingles.

    1. Rows with equal shingle sets form a class, represented by its smallest id; only
       representatives are compared further, so exact copies cost one grouped count.
    2. Every band with several members proposes each of them with one leader: linear in the members, never
       all pairs. The leader is the member that shares its bands with the most others, the hub of its copies.
    3. Members of a band that are still in different components, and neither of which led that band, are
       compared in full, so that no link between components is lost.
       These compare their full sets at once, block against block.
    4. Pairs with a leader are estimated from their registers, then confirmed on their full sets of words.

    NULL or wordless texts have no shingles and link with nothing. Rows without an id link with
    nothing, have a NULL component and are kept. Rows that repeat an id are one document: they
    share its component. Other columns are ignored. An empty table gives no rows.
    """
    docs = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).alias("text"))
    drawn = materialized(sketches(docs), "sketches")
    named = drawn.where("id IS NOT NULL AND n > 0")
    reps = materialized(
        named.groupBy("set_key").agg(F.min("id").alias("id"), F.max("n").alias("n"), F.first("regs").alias("regs")),
        "representatives",
    )
    member = materialized(
        named.select("id", "n", "set_key").join(reps.select("set_key", F.col("id").alias("rep")), "set_key").drop("set_key"),
        "members",
    )

    bands = _bands(reps)
    shared = bands.groupBy("band").agg(F.count(F.lit(1)).alias("members")).where("members > 1")
    met = materialized(bands.join(shared, "band"), "shared-bands")
    fame = met.groupBy("id").agg(F.sum("members").alias("fame"))
    lead = met.select("band", "id").join(fame, "id").groupBy("band").agg(F.max(F.struct("fame", "id")).alias("top"))
    led = materialized(met.select("band", "id").join(lead.select("band", F.col("top.id").alias("lead")), "band"), "led-bands")
    pairs = led.where("id <> lead").select(F.least("id", "lead").alias("a"), F.greatest("id", "lead").alias("b")).distinct()
    pairs = materialized(pairs, "star-pairs")
    active = materialized(fame.select("id"), "active")
    texts = materialized(docs.where("id IS NOT NULL").join(active, "id", "left_semi"), "active-texts")
    first = _links(pairs, reps, texts)

    stars = materialized(components(first), "first-components")
    labels = active.join(stars, "id", "left").select("id", F.coalesce("component", "id").alias("comp"))
    second = _rest_links(led.where("id <> lead").join(labels, "id"), texts)

    # classes whose copies share an id are one document
    same_id = member.groupBy("id").agg(F.min("rep").alias("a"), F.max("rep").alias("b")).where("a < b").select("a", "b")
    known = stars.select(F.col("id").alias("a"), F.col("component").alias("b"))
    final = components(known.union(second).union(same_id)).withColumnRenamed("id", "rep")
    placed = member.join(final, "rep", "left").select("id", "n", F.coalesce("component", "rep").alias("component_id"))
    lonely = drawn.where("id IS NULL OR n = 0").select("id", "n", F.col("id").alias("component_id"))
    return placed.union(lonely).select(
        F.col("id").alias("doc_id"),
        F.col("n").alias("n_shingles"),
        "component_id",
        F.coalesce(F.col("id") == F.col("component_id"), F.lit(True)).alias("kept"),
    )


def _rest_links(led: DataFrame, texts: DataFrame) -> DataFrame:
    """Links (a, b) between different components that meet in a band, beyond those with the band's leader.

    ``led`` holds band, lead, id and comp, without the leaders. Members of bands with one leader are dealt
    into blocks of about 256, and every two blocks meet in a task of their own: a group of any size is
    compared in full without a row per pair.
    """
    mixed = led.groupBy("band").agg(F.min("comp").alias("one"), F.max("comp").alias("other")).where("one < other")
    open_ = materialized(led.join(mixed.select("band"), "band").select("lead", "id", "comp").distinct(), "open-groups")
    sizes = open_.groupBy("lead").agg(F.ceil(F.count(F.lit(1)) / F.lit(BLOCK)).alias("blocks"))
    dealt = open_.join(sizes, "lead").withColumn("own", F.pmod(F.xxhash64("id"), F.col("blocks")))
    met = dealt.withColumn("other", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1)))
    met = met.select("lead", F.least("own", "other").alias("p"), F.greatest("own", "other").alias("q"), "id", "comp")
    found = met.join(texts, "id").groupBy("lead", "p", "q").applyInPandas(_block_links, "a bigint, b bigint")
    return materialized(found, "rest-links")


def _block_links(rows: pd.DataFrame) -> pd.DataFrame:
    """Links that join different components of a block, enough of them to connect what any link connects."""
    ids, root = rows["id"].to_numpy(), {}
    sets = [np.unique(shingle_hashes(word_hashes(t))) for t in rows["text"]]
    sizes = np.array([len(x) for x in sets])
    owner = np.repeat(np.arange(len(sets)), sizes)
    _, column, held = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    owner, column = owner[held[column] > 1], column[held[column] > 1]
    _, column = np.unique(column, return_inverse=True)
    common = np.zeros((len(sets), len(sets)), dtype=np.float32)  # exact: far below 2^24
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    width = 8192
    for at in range(0, int(column[-1]) + 1 if len(column) else 0, width):
        part = slice(*np.searchsorted(column, [at, at + width]))
        has = np.zeros((len(sets), width), dtype=np.float32)
        has[owner[part], column[part] - at] = 1
        common += has @ has.T
    over, of = SIMILARITY
    near = of * common >= over * (sizes[:, None] + sizes[None, :] - common)
    comp = rows["comp"].to_numpy()

    def find(x: int) -> int:
        while root.get(x, x) != x:
            x = root[x]
        return x

    links = []
    for i, j in zip(*np.nonzero(np.triu(near & (comp[:, None] != comp[None, :]), 1))):
        x, y = find(comp[i]), find(comp[j])
        if x != y:
            root[max(x, y)] = min(x, y)
            links.append((min(ids[i], ids[j]), max(ids[i], ids[j])))
    return pd.DataFrame(links, columns=["a", "b"])


def keep_representatives(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that ``near_duplicates`` keeps, with all their columns.

    Of rows that repeat a kept id one stays, by a hash of its text. Rows without an id stay.
    """
    judged = near_duplicates(docs, id_col, text_col).where("doc_id IS NOT NULL")
    ids = judged.groupBy("doc_id").agg(F.max("kept").alias("kept"), F.count(F.lit(1)).alias("rows"))
    ids = materialized(ids.where("NOT kept OR rows > 1"), "not-kept")
    names = ids.withColumnRenamed("doc_id", "__id")
    out = docs.join(names, F.col(id_col).cast("bigint") == F.col("__id"), "left_anti")
    again = names.where("kept")
    if again.isEmpty():
        return out
    rows = docs.join(again, F.col(id_col).cast("bigint") == F.col("__id"), "left_semi")
    one = rows.groupBy(F.col(id_col).alias("__id")).agg(
        F.min_by(F.struct(*docs.columns), F.xxhash64(text_col)).alias("__row")
    )
    return out.unionByName(one.select("__row.*"))


ORACLE_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') AS words FROM documents),
starts AS (
  SELECT doc_id, words, unnest(range(1, greatest(2, len(words) - 3))) AS i FROM w WHERE len(words) > 0),
shingles AS (
  SELECT DISTINCT doc_id, array_to_string(words[i : i + 4], ' ') AS s FROM starts),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
common AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS both
  FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY ALL),
links AS (
  SELECT c.a, c.b FROM common c JOIN sizes x ON x.doc_id = c.a JOIN sizes y ON y.doc_id = c.b
  WHERE 100 * c.both >= 75 * (x.n + y.n - c.both)),
reach(a, b) AS (
  SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
near AS (SELECT a, min(b) AS low FROM reach GROUP BY a)
SELECT d.doc_id, coalesce(z.n, 0)::BIGINT AS n_shingles, least(d.doc_id, coalesce(n.low, d.doc_id)) AS component_id,
       d.doc_id <= coalesce(n.low, d.doc_id) AS kept
FROM documents d LEFT JOIN sizes z ON z.doc_id = d.doc_id LEFT JOIN near n ON n.a = d.doc_id
"""
