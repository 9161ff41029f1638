"""Near-duplicate embeddings by spherical-cap filters.

Filter directions are the words of a structured random product code: one random unit vector from each
of two blocks of a randomly rotated space. Every vector is list-decoded to all directions whose cap it
lies in; vectors that share a direction are compared.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from paytrail.llm.components import components
from paytrail.session import materialized

SIMILARITY = 0.98
CODES = 48  # each with words of its own and a random half of a rotation's components for each block
ROTATIONS = 12
WORDS = 256  # code words in a block, so 65,536 directions in a code
#: Filters of one code come and go together, so a pair shares none in a code far more often than single filters would
#: say; caps are as high as lets all codes, which are independent, miss a pair at the threshold with this probability.
MISS = 1e-9
#: Shorter vectors are padded with zeros, which changes no angle: blocks of a few components have too few directions.
MIN_DIMENSION = 16
TOGETHER = 128  # vectors decoded at once
#: Vectors of filters with more members than this (and than 16 times an even spread) are compared in blocks.
CROWD = 256
BLOCK = 1024
_SEED = 20240202


def _code(dimension: int, number: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The components of both blocks, one after the other, and the blocks' words as unit vectors."""
    rng = np.random.default_rng([_SEED, dimension, 1, number])
    half = dimension // 2
    order = rng.permutation(dimension)
    blocks = [rng.standard_normal((WORDS, size)) for size in (half, dimension - half)]
    return order, *[b / np.maximum(np.linalg.norm(b, axis=1, keepdims=True), 1e-300) for b in blocks]


def _sums(turned: np.ndarray, code: tuple) -> tuple[np.ndarray, np.ndarray]:
    """The products of a rotated vector (or of many, in columns) with the words of both blocks."""
    order, first, second = code
    return first @ turned[order[: first.shape[1]]], second @ turned[order[first.shape[1] :]]


def _setup(dimension: int) -> tuple[list[np.ndarray], list[tuple], float]:
    """The rotations and codes of a dimension and the height of their caps, measured on pairs at the threshold."""
    if dimension not in _setups:
        rng = np.random.default_rng([_SEED, dimension, 0])
        rotations = [np.linalg.qr(rng.standard_normal((dimension, dimension)))[0] for _ in range(ROTATIONS)]
        codes = [_code(dimension, k) for k in range(CODES)]
        x, y = rng.standard_normal((2, dimension, 256))
        x /= np.linalg.norm(x, axis=0)
        y -= x * (x * y).sum(axis=0)
        y = SIMILARITY * x + np.sqrt(1 - SIMILARITY**2) * y / np.linalg.norm(y, axis=0)
        highest = []  # caps up to which a pair shares a filter of a code
        for number in range(0, CODES, 5):
            rotation = rotations[number % ROTATIONS]
            sums = [*_sums(rotation @ x, codes[number]), *_sums(rotation @ y, codes[number])]
            for a, b, c, d in zip(*(s.T for s in sums)):
                highest.append(np.minimum(a[:, None] + b, c[:, None] + d).max())
        _setups[dimension] = rotations, codes, float(np.quantile(highest, MISS ** (1 / CODES)))
    return _setups[dimension]


def decode_all(units: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Columns and filters of unit vectors in columns: for each code all pairs of words whose direction one exceeds."""
    units = np.pad(units, ((0, max(0, MIN_DIMENSION - len(units))), (0, 0)))
    rotations, codes, threshold = _setup(len(units))
    owners, filters = [], []
    for first, rotation in enumerate(rotations):
        turned = rotation @ units
        for number in range(first, CODES, ROTATIONS):
            a, b = _sums(turned, codes[number])
            i, column = np.nonzero(a + b.max(axis=0) >= threshold)
            at, j = np.nonzero(b.T[column] >= (threshold - a[i, column])[:, None])
            owners.append(column[at])
            filters.append((number * WORDS + i[at]) * WORDS + j)
    return np.concatenate(owners), np.concatenate(filters)


def decode(unit: np.ndarray) -> np.ndarray:
    """The filters of one unit vector."""
    return decode_all(unit[:, None])[1]


_setups: dict[int, tuple[list[np.ndarray], list[tuple], float]] = {}


def _unit(vector) -> np.ndarray | None:
    if vector is None or len(vector) == 0 or not np.isfinite(vector).all():
        return None
    v = vector / np.abs(vector).max() if np.abs(vector).max() > 0 else vector
    norm = np.sqrt(v @ v)
    return v / norm if norm > 0 else None


def _vectors(column: pa.ListArray) -> list[np.ndarray | None]:
    values = column.values.to_numpy(zero_copy_only=False)  # NULL components become NaN
    at = column.offsets.to_numpy()
    nulls = column.is_null().to_numpy(zero_copy_only=False)
    return [None if null else values[i:j] for null, i, j in zip(nulls, at, at[1:])]


def _filters(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, TOGETHER):
            part = batch.slice(at, TOGETHER)
            units = [_unit(v) for v in _vectors(part.column("vector"))]
            lengths = np.array([0 if u is None else len(u) for u in units])
            for length in np.unique(lengths[lengths > 0]):
                rows = np.flatnonzero(lengths == length)
                owner, filters = decode_all(np.stack([units[r] for r in rows], axis=1))
                owner = pa.array(rows[owner])
                yield pa.RecordBatch.from_arrays(
                    [part.column("id").take(owner), part.column("label").take(owner), pa.array(filters, pa.int64())],
                    names=["id", "label", "filter"],
                )


def _valid(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        good = [_unit(v) is not None for v in _vectors(batch.column("vector"))]
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(good, pa.bool_())], names=[*batch.schema.names, "good"])


def _cosine_of(x, y) -> float:
    if len(x) != len(y):
        return -2.0
    x, y = np.asarray(x, dtype=np.float64), np.asarray(y, dtype=np.float64)
    x, y = x / np.abs(x).max(), y / np.abs(y).max()
    return float(x @ y) / (float(np.sqrt(x @ x)) * float(np.sqrt(y @ y)))


@F.pandas_udf(DoubleType())
def _cosine(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([_cosine_of(x, y) for x, y in zip(a, b)], dtype="float64")


def _linked(vectors: list[np.ndarray], similarity: float) -> np.ndarray:
    """Which of the vectors link, as a matrix; products near the threshold are taken again one by one."""
    out = np.zeros((len(vectors), len(vectors)), dtype=bool)
    lengths = np.array([len(v) for v in vectors])
    for length in np.unique(lengths):
        rows = np.flatnonzero(lengths == length)
        units = np.stack([_unit(vectors[r]) for r in rows])
        cosines = units @ units.T
        near = cosines >= similarity
        for i, j in zip(*np.nonzero(np.abs(cosines - similarity) < 1e-9)):
            near[i, j] = _cosine_of(vectors[rows[min(i, j)]], vectors[rows[max(i, j)]]) >= similarity
        out[np.ix_(rows, rows)] = near
    np.fill_diagonal(out, False)
    return out


def _compare_blocks(similarity: float):
    def compare(rows: pd.DataFrame) -> pd.DataFrame:
        reps, copies = rows["rep"].to_numpy(), rows["copies"].to_numpy()
        near = _linked([np.asarray(v, dtype=np.float64) for v in rows["vector"]], similarity)
        if rows["p"].iloc[0] != rows["q"].iloc[0]:  # links within a block are found where it meets itself
            block = rows["block"].to_numpy()
            near &= block[:, None] != block[None, :]
        root, reached = reps.copy(), np.zeros(len(reps), dtype=bool)
        for start in np.argsort(reps, kind="stable"):
            front = np.full(0 if reached[start] else 1, start)
            while len(front):
                root[front], reached[front] = reps[start], True
                front = np.flatnonzero(near[front].any(axis=0) & ~reached)
        others = near @ copies
        some = others > 0
        return pd.DataFrame({"id": rows["id"].to_numpy()[some], "n": others[some], "rep": reps[some], "root": root[some]})

    return compare


def _crowded(caught: DataFrame) -> DataFrame:
    """Label, filter and number of members of filters that hold far more vectors than evenly spread ones would."""
    sizes = materialized(caught.groupBy("label", "filter").agg(F.count(F.lit(1)).alias("members")).where("members > 1"), "filter-sizes")
    spread = caught.groupBy("label").agg((F.count(F.lit(1)) / F.lit(CODES * WORDS**2)).alias("mean"))
    many = sizes.where(F.col("members") > CROWD).join(spread, "label")
    return many.where(F.col("members") > CROWD + 16 * F.col("mean")).select("label", "filter", "members")


def near_embeddings(vectors: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """One row per row of ``vectors``: ``vec_id``, ``n_links``, ``component_id``, ``kept``.

    Vectors of equal, non-null label link at a cosine of at least ``similarity`` in double precision.

    Rows with equal label and vector form a class. Only class representatives (smallest ids) are decoded and
    compared; classes give their sizes to ``n_links``, so copies are never paired. Two vectors at a cosine
    of 0.98 share no filter of a code in about 65% of cases, by which the caps are set, so all 48 codes miss a
    link with a probability of about 1e-9 (the measured share to the power of 48, right to a factor of a few);
    lower similarities need a lower cap. Candidates are pairs of a label and filter; each is verified once.

    Representatives in a crowded filter (a group of near copies) are dealt into blocks by their most crowded
    one. Two blocks that share a crowded filter meet in one task, which gives each vector's number of links
    and the smallest id it reaches there: work grows with the square of a group, rows with its blocks.

    Vectors that are NULL, empty, zero or hold NULL or non-finite components, rows with a NULL label and
    rows without an id link with nothing (``n_links`` 0, a component of their own id). Vectors of different
    lengths never link. Rows that repeat an id are taken as different vectors that share their id's
    component. Other columns are ignored. An empty table gives no rows.
    """
    rows = vectors.select(
        F.col("vec_id").cast("bigint").alias("id"), F.col("label"), F.col("embedding").cast("array<double>").alias("vector")
    )
    fields = f"id bigint, label {dict(rows.dtypes)['label']}, vector array<double>"
    checked = materialized(rows.mapInArrow(_valid, f"{fields}, good boolean"), "vectors")
    able = checked.where("good AND label IS NOT NULL AND id IS NOT NULL")
    classes = able.groupBy("label", "vector").agg(F.min("id").alias("rep"), F.count(F.lit(1)).alias("copies"))
    classes = materialized(classes.withColumn("id", F.monotonically_increasing_id()), "classes")
    numbers = classes.withColumnRenamed("id", "class")
    member = able.select("id", "label", "vector").join(numbers, ["label", "vector"]).select("id", "class", "rep", "copies")
    member = materialized(member, "members")

    fields = f"id bigint, label {dict(rows.dtypes)['label']}, filter bigint"
    caught = materialized(classes.select("id", "label", "vector").mapInArrow(_filters, fields), "filters")
    crowded = materialized(_crowded(caught), "crowded-filters")
    inside = materialized(caught.join(crowded, ["label", "filter"]), "crowded-members")
    home = inside.groupBy("id", "label").agg(F.min(F.struct(-F.col("members"), "filter")).alias("home"))
    home = materialized(home.select("id", "label", F.col("home.filter").alias("home")), "homes")
    sizes = home.groupBy("label", "home").agg(F.ceil(F.count(F.lit(1)) / F.lit(BLOCK)).alias("blocks"))
    dealt = home.join(sizes, ["label", "home"]).select(
        "id", F.xxhash64("label", "home", F.pmod(F.xxhash64("id"), F.col("blocks"))).alias("block")
    )
    dealt = materialized(dealt, "blocks")
    reach = materialized(inside.join(dealt, "id").select("label", "filter", "block").distinct(), "block-filters")
    one, two = reach.withColumnRenamed("block", "p"), reach.withColumnRenamed("block", "q")
    meet = materialized(one.join(two, ["label", "filter"]).where("p <= q").select("p", "q").distinct(), "block-pairs")
    ends = F.explode(F.array_distinct(F.array("p", "q"))).alias("block")
    filled = dealt.join(classes.select("id", "rep", "vector", "copies"), "id")
    met = meet.select("p", "q", ends).join(filled, "block")
    in_blocks = materialized(
        met.groupBy("p", "q").applyInPandas(_compare_blocks(similarity), "id bigint, n bigint, rep bigint, root bigint"), "block-links"
    )

    spread = caught.join(crowded, ["label", "filter"], "left_anti")
    left, right = spread.withColumnRenamed("id", "a"), spread.withColumnRenamed("id", "b")
    pairs = left.join(right, ["label", "filter"]).where("a < b").select("a", "b").distinct()
    for end in "ab":
        pairs = pairs.join(dealt.select(F.col("id").alias(end), F.col("block").alias(f"block_{end}")), end, "left")
    pairs = materialized(pairs, "pairs")
    apart = pairs.where("block_a IS NULL OR block_b IS NULL").select("a", "b")
    both = pairs.where("block_a IS NOT NULL AND block_b IS NOT NULL").select(
        "a", "b", F.least("block_a", "block_b").alias("p"), F.greatest("block_a", "block_b").alias("q")
    )
    pairs = apart.union(both.join(meet, ["p", "q"], "left_anti").select("a", "b"))

    def side(s: str) -> DataFrame:
        return classes.select(*[F.col(c).alias(d) for c, d in (("id", s), ("rep", f"rep_{s}"), ("vector", f"v_{s}"), ("copies", f"n_{s}"))])

    met = pairs.join(side("a"), "a").join(side("b"), "b")
    links = materialized(met.where(_cosine("v_a", "v_b") >= similarity).select("a", "b", "rep_a", "rep_b", "n_a", "n_b"), "links")

    ends = F.explode(F.array(
        F.struct(F.col("a").alias("class"), F.col("n_b").alias("n")), F.struct(F.col("b").alias("class"), F.col("n_a").alias("n"))
    )).alias("e")
    counted = links.select(ends).select("e.*").union(in_blocks.select("id", "n"))
    degree = counted.groupBy("class").agg(F.sum("n").alias("others"))
    same_id = member.groupBy("id").agg(F.min("rep").alias("a"), F.max("rep").alias("b")).where("a < b").select("a", "b")
    joined = links.select("rep_a", "rep_b").union(in_blocks.select("rep", "root").where("rep <> root")).union(same_id)
    labels = components(joined.toDF("a", "b")).withColumnRenamed("id", "rep")
    placed = member.join(degree, "class", "left").join(labels, "rep", "left").select(
        "id",
        (F.coalesce("others", F.lit(0)) + F.col("copies") - 1).cast("bigint").alias("n_links"),
        F.coalesce("component", "rep").alias("component_id"),
    )
    alone = checked.where("NOT (good AND label IS NOT NULL AND id IS NOT NULL)").select(
        "id", F.lit(0).cast("bigint").alias("n_links"), F.col("id").alias("component_id")
    )
    return placed.union(alone).select(
        F.col("id").alias("vec_id"), "n_links", "component_id",
        F.coalesce(F.col("id") == F.col("component_id"), F.lit(True)).alias("kept"),
    )


ORACLE_SQL = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings),
able AS (
  SELECT * FROM v WHERE label IS NOT NULL AND len(e) > 0 AND list_count(e) = len(e)
    AND len(list_filter(e, lambda x: NOT isfinite(x))) = 0 AND list_dot_product(e, e) > 0),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM able a JOIN able b ON a.label = b.label AND a.vec_id <> b.vec_id
  WHERE list_dot_product(a.e, b.e) / (sqrt(list_dot_product(a.e, a.e)) * sqrt(list_dot_product(b.e, b.e))) >= 0.98),
reach(a, b) AS (
  SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
near AS (SELECT a, min(b) AS low FROM reach GROUP BY a),
degree AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT v.vec_id, coalesce(d.n, 0)::BIGINT AS n_links, least(v.vec_id, coalesce(n.low, v.vec_id)) AS component_id,
       v.vec_id <= coalesce(n.low, v.vec_id) AS kept
FROM v LEFT JOIN near n ON v.vec_id = n.a LEFT JOIN degree d ON v.vec_id = d.a
"""
