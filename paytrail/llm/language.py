"""Language identification by error-correcting output codes over character n-grams.

Every language has a codeword. One binary n-gram classifier per bit tells the languages whose bit is 1
from the others; the language whose codeword costs the least loss, bits weighted by how well their
classifiers do, is the prediction.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DoubleType, StringType, StructField, StructType

from paytrail.llm.toxicity import held_out

#: The model is fitted on about so many rows, drawn by a hash of their ids.
SAMPLE_ROWS = 24_000
_CHECK_SHARE = 6  # one in so many sampled rows weighs the bits, the others train them
BUCKETS = 1 << 15
ORDERS = 3
UNDETERMINED = "und"
AMBIGUOUS_BELOW = 0.6
_SMOOTHING = 0.5
_EXHAUSTIVE = 7  # up to so many languages every split into two groups is a bit
_CHARS = 1 << 19
_OTHER = re.compile(r"[\W\d_]+")
_FACTORS = np.random.default_rng(6).integers(1, 1 << 62, ORDERS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def _letters(text: str) -> str:
    """The runs of letters of a text, one space between them.

    Letters are what Unicode calls so; numbers such as a half, a superscript two or Roman numerals pass for word
    characters in patterns, but are none.
    """
    runs = _OTHER.sub(" ", text)
    if not runs.replace(" ", "").isalpha():
        runs = "".join(c if c.isalpha() else " " for c in runs)
        runs = " ".join(runs.split())
    return runs.strip()


def grams(text: str | None) -> np.ndarray:
    """Hash buckets of all 1- to 3-grams of the letters of a text, words parted by one space."""
    letters = _letters(text.lower()) if text else ""
    if not letters:
        return np.empty(0, dtype=np.int64)
    code = np.frombuffer(f" {letters} ".encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.uint64)
    out = []
    h = np.zeros(len(code) + 1, dtype=np.uint64)
    for order in range(min(ORDERS, len(code))):
        h = h[:-1][: len(code) - order] * _FACTORS[0] + code[order:] + np.uint64(order + 1)
        out.append(((h * _FACTORS[1]) >> np.uint64(64 - 15)).astype(np.int64))
    return np.concatenate(out)


def codewords(n: int) -> np.ndarray:
    """A row of -1 and 1 for each of n languages: all splits for few, else random ones far apart."""
    if n < 2:
        return np.zeros((n, 0))
    if n <= _EXHAUSTIVE:
        bits = [[1 if (k >> i) & 1 else -1 for i in range(n)] for k in range(1, 1 << (n - 1))]
        return np.array(bits, dtype=float).T
    rng = np.random.default_rng(n)
    length = int(np.ceil(10 * np.log2(n)))
    tries = [rng.choice([-1.0, 1.0], (n, length)) for _ in range(200)]

    def distance(code: np.ndarray) -> float:
        apart = (length - code @ code.T) / 2
        return float(apart[~np.eye(n, dtype=bool)].min()) if (abs(code.sum(axis=0)) < n).all() else -1.0

    return max(tries, key=distance)


@dataclass
class Model:
    languages: list[str]
    code: np.ndarray  # languages x bits
    weights: np.ndarray  # buckets x bits
    bias: np.ndarray
    trust: np.ndarray  # of each bit
    sharpness: float = 1.0

    def margins(self, text: str | None) -> np.ndarray | None:
        """The mean weight of a text's n-grams for each bit; None without letters."""
        found = grams(text)
        if not len(found):
            return None
        total = np.zeros(self.weights.shape[1])
        for at in range(0, len(found), _CHARS):
            total += self.weights[found[at : at + _CHARS]].sum(axis=0)
        return total / len(found) + self.bias

    def losses(self, margins: np.ndarray) -> np.ndarray:
        """The weighted logistic loss of every language's codeword."""
        return np.logaddexp(0, -self.code * (self.sharpness * margins)) @ self.trust

    def predict(self, text: str | None) -> tuple[str, float, bool]:
        """The nearest language, its share of the likelihood, and whether the choice is ambiguous."""
        margins = self.margins(text) if self.languages else None
        if margins is None:
            return UNDETERMINED, 0.0, True
        loss = self.losses(margins)
        share = np.exp(loss.min() - loss)
        share /= share.sum()
        best = int(np.argmax(share))
        return self.languages[best], float(share[best]), bool(share[best] < AMBIGUOUS_BELOW)


def _counts(batches):
    totals: dict[str, np.ndarray] = {}
    for batch in batches:
        for text, lang in zip(batch["text"], batch["lang"]):
            if lang not in totals:
                totals[lang] = np.zeros(BUCKETS, dtype=np.int64)
            totals[lang] += np.bincount(grams(text), minlength=BUCKETS)
    for lang, total in totals.items():
        at = np.flatnonzero(total)
        yield pd.DataFrame({"lang": lang, "bucket": at, "n": total[at]})


def fit(docs: DataFrame) -> Model:
    """A model from rows of (``doc_id``, ``text``, ``lang``) with a language, about ``SAMPLE_ROWS`` of them.

    N-grams are counted where the rows are and summed per language and bucket; the driver gets at most
    32,768 counts for each language. A bit's classifier weighs an n-gram by the log ratio of its
    frequencies in the two groups of languages, each language counting the same.
    """
    known = docs.where("lang IS NOT NULL AND text IS NOT NULL AND doc_id IS NOT NULL")
    total = known.count()
    if total > SAMPLE_ROWS:
        known = known.where(F.pmod(F.xxhash64("doc_id", F.lit(6)), F.lit(total)) < SAMPLE_ROWS)
    drawn = F.pmod(F.xxhash64("doc_id", F.lit(66)), F.lit(_CHECK_SHARE)) == 0
    # A language of which only checks were drawn is counted from them; there are no more languages than sampled rows.
    only = known.groupBy("lang").agg(F.bool_and(drawn).alias("only_checks"))
    known = known.join(F.broadcast(only), "lang").select("doc_id", "text", "lang", "only_checks")
    checks = drawn & ~F.col("only_checks")
    counted = known.where(~checks).select("text", "lang").mapInPandas(_counts, "lang string, bucket int, n bigint")
    counted = counted.groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toPandas()
    languages = sorted(counted["lang"].unique())
    code = codewords(len(languages))
    share = np.empty((len(languages), BUCKETS))
    for i, lang in enumerate(languages):
        own = counted[counted["lang"] == lang]
        row = np.full(BUCKETS, _SMOOTHING)
        row[own["bucket"].to_numpy()] += own["n"].to_numpy()
        share[i] = row / row.sum()
    bits = code.shape[1]
    weights, bias = np.zeros((BUCKETS, bits)), np.zeros(bits)
    for b in range(bits):
        one, other = code[:, b] > 0, code[:, b] < 0
        weights[:, b] = np.log(share[one].mean(axis=0)) - np.log(share[other].mean(axis=0))
        # the threshold lies midway between the groups' nearest languages
        middle = share @ weights[:, b]
        bias[b] = -(middle[one].min() + middle[other].max()) / 2
    model = Model(languages, code, weights.astype(np.float32), bias, np.ones(bits))
    if bits:
        _weigh(model, known.where(checks).select("text", "lang"))
    return model


def _weigh(model: Model, rows: DataFrame) -> None:
    """Trust each bit by its classifier's odds of being right on rows apart, and scale the margins."""
    sent = rows.sparkSession.sparkContext.broadcast(vars(model))

    def measure(batches):
        model = Model(**sent.value)
        for batch in batches:
            out = []
            for text, lang in zip(batch["text"], batch["lang"]):
                m = model.margins(text)
                if m is not None and lang in model.languages:
                    signed = model.code[model.languages.index(lang)] * m
                    out.append((1, (signed > 0).astype(float).tolist(), abs(signed).tolist()))
            yield pd.DataFrame(out, columns=["n", "right", "size"])

    measured = rows.mapInPandas(measure, "n int, right array<double>, size array<double>")
    bits = range(len(model.trust))
    sums = measured.agg(
        F.count(F.lit(1)), *[F.sum(F.col("right")[b]) for b in bits], *[F.sum(F.col("size")[b]) for b in bits]
    ).first()
    if not sums[0]:
        return
    right = (np.array(sums[1 : 1 + len(bits)], dtype=float) + 1) / (sums[0] + 2)
    model.trust = np.clip(np.log(right / (1 - right)), 0.05, None)
    model.trust /= model.trust.mean()
    model.sharpness = 4.0 / max(1e-9, float(np.mean(sums[1 + len(bits) :])) / sums[0])


RESULT = StructType(
    [StructField("lang_pred", StringType()), StructField("score", DoubleType()), StructField("ambiguous", BooleanType())]
)


def identify(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``held_out``, ``lang_pred``, ``score``, ``ambiguous``.

    Languages are learned from rows with a ``lang`` whose crc32 of the id's text modulo 4 is not 2; up to
    ``SAMPLE_ROWS`` rows, each language is, even from one row. NULL texts
    and texts without letters are ``und`` with score 0; so is every text if no language was given. Rows without an
    id are predicted but not learned from. Repeated rows count like others. Texts are read whole, however long; of
    languages with equal loss the first by code point is taken. An empty table gives no rows. Other columns are ignored.
    """
    out = held_out(F.col("doc_id"), 4, 2)
    model = fit(docs.where(~out).select("doc_id", "text", "lang"))
    sent = docs.sparkSession.sparkContext.broadcast(vars(model))

    @F.pandas_udf(RESULT)
    def predict(texts: pd.Series) -> pd.DataFrame:
        model = Model(**sent.value)
        return pd.DataFrame([model.predict(t) for t in texts], columns=["lang_pred", "score", "ambiguous"])

    return docs.select("doc_id", out.alias("held_out"), predict("text").alias("p")).select("doc_id", "held_out", "p.*")
