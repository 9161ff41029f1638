"""The n-gram model against a slow one in plain Python, its normalisation, and odd rows."""

import collections
import math
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from paytrail.llm import ngrams
from paytrail.llm.queries import op13_ngrams

DOCS = "doc_id bigint, text string, tokens string, score double, held_out string"
END = object()


def split(text):
    return [*(text or "").encode().lower().split(), END]


class Slow:
    """Counts in dictionaries, by the textbook."""

    def __init__(self, texts):
        self.words, self.pairs = collections.Counter(), collections.Counter()
        for text in texts:
            tokens = split(text)
            self.words.update(tokens)
            self.pairs.update(zip([END, *tokens], tokens))
        self.before = collections.Counter(w for _, w in self.pairs)
        self.after = collections.defaultdict(list)
        for (u, _), n in self.pairs.items():
            self.after[u].append(n)
        self.d2, self.d1 = self.discounts(self.pairs), self.discounts(self.before)

    @staticmethod
    def discounts(counts):
        n1, n2, n3, n4 = (sum(c == k for c in counts.values()) for k in (1, 2, 3, 4))
        if not (n1 and n2 and n3 and n4):
            return [0, 0.5, 1, 1.5]
        y = n1 / (n1 + 2 * n2)
        found = [1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3]
        return [0, *[min(max(d, 0.05), k) for k, d in zip((1, 2, 3), found)]]

    def word(self, w):
        if not self.pairs:
            return 1.0
        spread = sum(self.d1[min(n, 3)] for n in self.before.values()) / len(self.pairs)
        n = self.before[w]
        return max(n - self.d1[min(n, 3)], 0) / len(self.pairs) + spread / (len(self.words) + 1)

    def after_context(self, u, w):
        if not self.words[u]:
            return self.word(w)
        n, left = self.pairs[u, w], sum(self.d2[min(c, 3)] for c in self.after[u])
        return (max(n - self.d2[min(n, 3)], 0) + left * self.word(w)) / self.words[u]

    def score(self, text):
        tokens = split(text)
        total = sum(self.words.values())
        base = sum(math.log10((self.words[t] + 0.5) / (total + 0.5 * (len(self.words) + 1))) for t in tokens)
        score = sum(math.log10(self.after_context(u, w)) for u, w in zip([END, *tokens], tokens))
        return len(tokens), sum(self.words[t] > 0 for t in tokens), total, base, score


def held(doc_id):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 5 == 1


def sample(rng, n):
    vocabulary = [f"w{int(rng.paretovariate(0.6))}" for _ in range(400)]
    return [" ".join(rng.choice([w, w.upper()]) for w in rng.choices(vocabulary, k=rng.randrange(60))) for _ in range(n)]


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(11)
    found = list(enumerate(sample(rng, 250)))
    found += [(1000 + i, t) for i, t in enumerate([None, "", " \n\t ", "É é漢字 \x00 x", "never-seen words here", "THE the The"])]
    return [*found, (3, found[3][1]), (None, "no id " * 4), (2000, "long word " * 30000), (2001, None)]


@pytest.fixture(scope="module")
def table(spark, rows, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("ngrams"))
    spark.createDataFrame([(i, t, "x", 0.5, "y") for i, t in rows], DOCS).repartition(7).write.parquet(f"{path}/documents.parquet")
    return path


def check(found, rows):
    slow = Slow([t for i, t in rows if not held(i)])
    want = sorted(((i, held(i), *slow.score(t)) for i, t in rows), key=lambda r: (str(r[0]), r[2]))
    got = sorted(found, key=lambda r: (str(r[0]), r[2]))
    assert [g[:5] for g in got] == [w[:5] for w in want]
    assert np.allclose([g[5:7] for g in got], [w[5:] for w in want], rtol=1e-9, atol=1e-9)


def test_query_matches_the_slow_model(spark, table, rows):
    check([tuple(r) for r in op13_ngrams(spark, table).collect()], rows)


def test_pieces_do_not_change_the_model(spark, table, rows, monkeypatch):
    """Hundreds of small pieces, frequent contexts cut into several, and sends in between."""
    for name, value in {"_TOKENS_PER_SEND": 200, "_ROUND_BYTES": 64, "_TOKENS_PER_ROUND": 100}.items():
        monkeypatch.setattr(ngrams, name, value)
    docs = spark.read.parquet(f"{table}/documents.parquet")
    out = F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(5)) == 1, F.lit(False))
    marked = docs.select("doc_id", out.alias("held_out"), "text")
    model = ngrams.fit(marked.where(~out), vocabulary_bytes=4000, pairs_per_piece=50)
    assert len(model.words) > 20 and len(model.pairs) > 100
    assert any(int(b) & 0xFFFFFFFF for b in model.pair_bounds)
    check([tuple(r) for r in ngrams.score_texts(marked, model).collect()], rows)


def test_probabilities_after_a_context_sum_to_one(spark, table):
    model = ngrams.fit(spark.read.parquet(f"{table}/documents.parquet"))
    hashes = np.concatenate([np.asarray(ngrams._map(base, "hash", np.uint64)) for base in model.words])
    number, count = model.numbers(hashes)
    assert number.tolist() == list(range(model.distinct_words)) and count.sum() == model.tokens
    lower = model.word_probability(np.append(-1, number))
    assert lower.sum() == pytest.approx(1) and lower.min() > 0
    for context in (0, 7, int(count.argmax()), model.distinct_words - 1):
        word, of = np.append(number, -1), np.full(len(number) + 1, context)
        p = model.probability(of, count[of], word, np.append(lower[1:], lower[0]))
        assert p.sum() == pytest.approx(1) and p.min() > 0


def test_training_text_is_likelier_than_its_words(spark, sf):
    found = op13_ngrams(spark, sf)
    total = found.groupBy("held_out").agg(F.sum("score"), F.sum("base_score"), F.count(F.lit(1))).collect()
    assert len(total) == 2 and all(score > base for _, score, base, _ in total)


def test_no_training_rows_and_empty_tables(spark, tmp_path):
    only = next(i for i in range(100) if held(i))
    spark.createDataFrame([(only, "a b", "x", 1.0, "y")], DOCS).write.parquet(f"{tmp_path}/one/documents.parquet")
    assert [tuple(r) for r in op13_ngrams(spark, f"{tmp_path}/one").collect()] == [(only, True, 3, 0, 0, 0.0, 0.0, 1.0)]
    spark.createDataFrame([], DOCS).write.parquet(f"{tmp_path}/none/documents.parquet")
    assert op13_ngrams(spark, f"{tmp_path}/none").count() == 0
    other = next(i for i in range(100) if not held(i))
    spark.createDataFrame([(other, None, "x", 1.0, "y")], DOCS).write.parquet(f"{tmp_path}/end/documents.parquet")
    (row,) = op13_ngrams(spark, f"{tmp_path}/end").collect()
    assert (row.n_tokens, row.n_known, row.train_tokens) == (1, 1, 1) and -1 < row.score <= 0
