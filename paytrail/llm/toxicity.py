"""Toxicity by maximum-scoring segments of token log-odds.

Tokens get a log-odds ratio of toxic against other text under Dirichlet priors. Within a text,
all maximal scoring segments are found in one linear scan; their scores are calibrated by the
extreme-value law that the best segments of other texts follow.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from paytrail.session import materialized

#: The model is fitted on about so many labelled rows, drawn by a hash of their ids.
SAMPLE_ROWS = 24_000
_CALIBRATION_SHARE = 3  # one in so many sampled rows calibrates, the others count
PRIOR = 8.0
#: Tokens not seen often enough score as the longest of their beginnings that was seen with several endings.
STEMS = (3, 5, 7)
STEM_PRIOR = 20.0
MIN_ENDINGS = 3
MIN_LINES = 3
PENALTY = 2.0
SIGNIFICANT = 0.01
#: A token is a run of letters and of numbers that are no decimal digits, here and in Java's notation.
_TOKEN = re.compile(r"[^\W\d_]+")
_TOKEN_JAVA = r"([\p{L}\p{Nl}\p{No}]+)"
_MEMO_TOKENS = 500_000


@dataclass
class Segment:
    """Tokens ``start`` to ``end`` (exclusive) and their summed score."""

    start: int
    end: int
    score: float


def maximal_segments(scores: np.ndarray) -> list[Segment]:
    """All maximal scoring segments, in order, by the linear algorithm of Ruzzo and Tompa."""
    total = np.concatenate([[0.0], np.cumsum(scores)])
    stack: list[tuple[int, int, float, float, int]] = []  # start, end, left sum, right sum, last with a smaller left
    for i in np.flatnonzero(scores > 0):
        start, end, left, right = int(i), int(i) + 1, float(total[i]), float(total[i + 1])
        while True:
            j = len(stack) - 1
            while j >= 0 and stack[j][2] >= left:
                j = stack[j][4]
            if j < 0 or stack[j][3] >= right:
                stack.append((start, end, left, right, j))
                break
            start, left = stack[j][0], stack[j][2]
            del stack[j:]
    return [Segment(s, e, r - l) for s, e, l, r, _ in stack]


@dataclass
class Model:
    """Token and stem scores, the extreme-value law of best segments, and the final logistic curve."""

    tokens: dict[str, float]
    stems: dict[str, float]
    rate: float = 1.0
    scale: float = 1.0
    curve: tuple[float, float, float] = (-5.0, 0.0, 0.0)

    def token_scores(self, text: str | None, memo: dict[str, float]) -> np.ndarray:
        found = _TOKEN.findall(text.lower()) if text else []
        out = np.empty(len(found))
        get = memo.get
        for i, t in enumerate(found):
            s = get(t)
            if s is None:
                s = self.tokens.get(t)
                if s is None:
                    s = next((self.stems[t[:k]] for k in reversed(STEMS) if len(t) >= k and t[:k] in self.stems), 0.0)
                if len(memo) > _MEMO_TOKENS:
                    memo.clear()
                if len(t) <= 64:
                    memo[t] = s
            out[i] = s
        return out - PENALTY

    def excess(self, score: float, n: int) -> float:
        """The negative logarithm of how many segments of this score chance puts into n tokens."""
        return self.rate * score - math.log(self.scale * max(n, 1))

    def passages(self, text: str | None, memo: dict[str, float] | None = None) -> tuple[list[Segment], int]:
        """The significant passages of a text, and its number of tokens."""
        scores = self.token_scores(text, {} if memo is None else memo)
        floor = -math.log(SIGNIFICANT)
        return [s for s in maximal_segments(scores) if self.excess(s.score, len(scores)) > floor], len(scores)

    def measures(self, text: str | None, memo: dict[str, float] | None = None) -> tuple[int, float, float, float]:
        """Tokens, best segment score, the best segment's excess, and the summed excess of all significant ones, both damped."""
        scores = self.token_scores(text, {} if memo is None else memo)
        found = [s.score for s in maximal_segments(scores)]
        excess = [self.excess(x, len(scores)) for x in found]
        best = max(excess, default=-math.log(self.scale * max(len(scores), 1)))
        sure = sum(x for x in excess if x > -math.log(SIGNIFICANT))
        return len(scores), max(found, default=0.0), math.asinh(best), math.asinh(sure)

    def score(self, text: str | None, memo: dict[str, float] | None = None) -> float:
        _, _, best, sure = self.measures(text, memo)
        a, b, c = self.curve
        return 1 / (1 + math.exp(-max(-500.0, min(500.0, a + b * best + c * sure))))


def held_out(id_col: Column, of: int, value: int) -> Column:
    """Whether crc32 of the id's text leaves ``value``; NULL counts as the empty text."""
    return F.crc32(F.coalesce(id_col.cast("string"), F.lit("")).cast("binary")) % of == value


def _token_rows(rows: DataFrame) -> DataFrame:
    """Each token of each distinct line; copies of a document count once, as their lines do."""
    lines = rows.select("toxic", F.explode(F.split("text", "\n")).alias("line")).groupBy("line")
    lines = lines.agg((F.avg("toxic") >= 0.5).cast("int").alias("toxic")).select("toxic", F.xxhash64("line").alias("id"), "line")
    words = F.regexp_extract_all(F.lower("line"), F.lit(_TOKEN_JAVA), F.lit(1))
    return lines.select("id", "toxic", F.explode(F.array_distinct(words)).alias("token"))


def _shares(token_rows: DataFrame, base: float) -> tuple[dict[str, float], dict[str, float]]:
    """The share of toxic lines among those with a token, and the like for beginnings of tokens.

    Every share has a Dirichlet prior centred on the next shorter beginning's share, the shortest on ``base``.
    A beginning counts each token once, with its own share, so that one frequent word does not speak for it.
    """
    tally = token_rows.groupBy("token").agg(F.count(F.lit(1)).alias("lines"), F.sum("toxic").alias("toxic"))
    tally = materialized(tally, "token-tally")
    stems: dict[str, float] = {}

    def mean(beginning: str) -> float:
        return next((stems[beginning[:k]] for k in reversed(STEMS) if beginning[:k] in stems and len(beginning) > k), base)

    for k in STEMS:
        per = tally.where(F.length("token") >= k).groupBy(F.substring("token", 1, k).alias("stem")).agg(
            F.count(F.lit(1)).alias("n"), F.sum(F.col("toxic") / F.col("lines")).alias("toxic")
        )
        for stem, n, toxic in per.where(F.col("n") >= MIN_ENDINGS).collect():
            stems[stem] = (toxic + STEM_PRIOR * mean(stem)) / (n + STEM_PRIOR)
    often = tally.where(F.col("lines") >= MIN_LINES).collect()
    return {t: (toxic + PRIOR * mean(t)) / (n + PRIOR) for t, n, toxic in often}, stems


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> Model:
    """A model from rows of ``docs`` with a label in ``labels`` (``toxic`` 0 or 1).

    About ``SAMPLE_ROWS`` labelled ids are drawn by a hash; of rows that repeat an id the first text in byte
    order counts. On two thirds of them a token's
    share of toxic lines is estimated under a Dirichlet prior centred on the shares of its beginnings. The
    other third gives the extreme-value law and the curve, or all of them if the third lacks a kind.
    Without labelled rows of both kinds every text scores the same, below 0.5.
    """
    known = labels.where("toxic IN (0, 1)").groupBy(F.col(id_col).alias("id")).agg(F.max("toxic").alias("toxic"))
    known = known.where("id IS NOT NULL")
    total = known.count()
    draw = F.xxhash64("id", F.lit(5))
    if total > SAMPLE_ROWS:
        known = known.where(F.pmod(draw, F.lit(total)) < SAMPLE_ROWS)
    texts = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    drawn = texts.join(F.broadcast(known), "id").groupBy("id", "toxic").agg(F.min("text").alias("text"))  # bounded by SAMPLE_ROWS
    calibrates = F.pmod(F.xxhash64("id", F.lit(55)), F.lit(_CALIBRATION_SHARE)) == 0
    drawn = materialized(drawn.withColumn("calibrates", calibrates), "drawn-rows")
    counting = drawn.where("NOT calibrates")
    token_rows = materialized(_token_rows(counting), "token-lines")
    n, n_toxic = token_rows.agg(F.count_distinct("id"), F.count_distinct(F.when(F.col("toxic") == 1, F.col("id")))).first()
    if not n_toxic or n == n_toxic:
        return Model({}, {})
    base = n_toxic / n
    tally = (F.count(F.lit(1)).alias("lines"), F.sum("toxic").alias("toxic"))
    tokens, stems = _shares(token_rows, base)

    def gain(share: float) -> float:
        return round(math.log(share / (1 - share)) - math.log(base / (1 - base)), 4)

    model = Model({t: gain(p) for t, p in tokens.items()}, {t: gain(p) for t, p in stems.items()})
    rows = drawn.where("calibrates")
    if rows.agg(F.count_distinct("toxic")).first()[0] < 2:  # few labels of a kind, all among the counting rows
        rows = drawn
    for step in (_fit_law, _fit_curve):
        step(model, _measured(rows, model))
    return model


def _measured(rows: DataFrame, model: Model) -> pd.DataFrame:
    """Four numbers and the label of each calibrating row, of which there is a bounded number."""
    sent = rows.sparkSession.sparkContext.broadcast(vars(model))

    def measure(batches):
        model, memo = Model(**sent.value), {}
        for batch in batches:
            out = [(*model.measures(text, memo), toxic) for text, toxic in zip(batch["text"], batch["toxic"])]
            yield pd.DataFrame(out, columns=["n", "top", "best", "sure", "toxic"])

    fields = "n bigint, top double, best double, sure double, toxic int"
    return rows.select("text", "toxic").mapInPandas(measure, fields).toPandas()


def _fit_law(model: Model, rows: pd.DataFrame) -> None:
    """The extreme-value law of the best segments of rows that are not toxic."""
    clean = rows[rows["toxic"] == 0]
    n, best = np.log(clean["n"].clip(lower=1).to_numpy(dtype=float)), clean["top"].to_numpy()
    rate = 1.0
    for _ in range(20):
        spread = float(np.std(best - n / rate))
        rate = min(20.0, max(0.05, math.pi / math.sqrt(6) / max(spread, 1e-6)))
    model.rate = rate
    model.scale = float(np.exp(np.mean(rate * best - n) - np.euler_gamma))


def _fit_curve(model: Model, rows: pd.DataFrame) -> None:
    """The logistic curve over both features, by Newton steps with a ridge."""
    rows = rows.sort_values(["best", "sure", "toxic"])  # sums do not depend on the order of tasks
    x = np.column_stack([np.ones(len(rows)), rows["best"], rows["sure"]])
    y = rows["toxic"].to_numpy(dtype=float)
    w = np.zeros(3)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        ridge = np.array([1e-6, 0.02, 0.02])
        w += np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + np.diag(ridge), x.T @ (y - p) - ridge * w)
    model.curve = tuple(w.tolist())


def scorer(docs: DataFrame, model: Model):
    """A column function from text to the toxicity score between 0 and 1."""
    sent = docs.sparkSession.sparkContext.broadcast(vars(model))

    @F.pandas_udf(DoubleType())
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model, memo = Model(**sent.value), {}
        for texts in batches:
            yield pd.Series([model.score(t, memo) for t in texts], dtype="float64")

    return score


def passages(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per significant toxic passage: ``doc_id``, ``start``, ``end`` (in tokens), ``segment_score``, ``e_value``."""
    sent = docs.sparkSession.sparkContext.broadcast(vars(model))

    def find(batches):
        model = Model(**sent.value)
        memo: dict[str, float] = {}
        for batch in batches:
            out = []
            for i, text in zip(batch["doc_id"], batch["text"]):
                found, n = model.passages(text, memo)
                out += [(i, s.start, s.end, s.score, math.exp(-model.excess(s.score, n))) for s in found]
            yield pd.DataFrame(out, columns=["doc_id", "start", "end", "segment_score", "e_value"])

    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    rows = rows.where("doc_id IS NOT NULL")
    return rows.mapInPandas(find, "doc_id bigint, start bigint, end bigint, segment_score double, e_value double")


def score_toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``held_out``, ``score``, ``predicted``.

    The model is fitted on labelled rows whose crc32 of the id's text modulo 5 is not 0, and sees texts
    only. NULL and empty texts have no tokens and score as a text without any toxic passage. Rows
    that repeat an id are scored one by one; their label is the largest given. Rows without an id are held out.
    Other columns are ignored. An empty table gives no rows; without labels all scores are the same.
    """
    out = held_out(F.col("doc_id"), 5, 0)
    model = fit(docs.where(~out).select("doc_id", "text"), labels)
    score = scorer(docs, model)
    scored = docs.select("doc_id", out.alias("held_out"), score("text").alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def reject_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that score below 0.5, with all their columns.

    NULL, empty and very long texts are scored like others, repeated rows one by one; an empty table stays empty.
    """
    model = fit(docs.where(~held_out(F.col("doc_id"), 5, 0)).select("doc_id", "text"), labels)
    return docs.where(scorer(docs, model)("text") < 0.5)
