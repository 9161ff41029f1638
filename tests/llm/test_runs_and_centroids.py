"""Periodic runs and exact clustering against plain Python on small tables, and on odd rows."""

import hashlib
import random
import zlib
from fractions import Fraction

import duckdb
import numpy as np
import pytest

from paytrail.llm import centroids, runs
from paytrail.llm.queries import op11_runs

DOCS = "doc_id bigint, text string, h string, words string, runs int"


def slow_runs(words):
    """Every period, every stretch; the smallest period of equal borders counts."""
    n, found = len(words), {}
    for q in range(1, n // 4 + 1):
        i = 0
        while i < n - q:
            if words[i] != words[i + q]:
                i += 1
                continue
            begin = i
            while i < n - q and words[i] == words[i + q]:
                i += 1
            if i + q - begin >= max(6, 4 * q):
                found.setdefault((begin, i + q), q)
    return sorted((b, e - b, q) for (b, e), q in found.items())


def slow_collapse(words, found):
    gone = {i for b, size, q in found for i in range(b + q, b + size)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def periodic_text(rng):
    words = []
    while len(words) < rng.choice([5, 30, 200, 600]):
        block = [rng.choice("ab") if rng.random() < 0.5 else str(rng.randrange(50)) for _ in range(rng.choice([1, 2, 3, 7, 20, 45]))]
        words += (block * rng.choice([1, 1, 2, 4, 5, 9, 30]))[: rng.randrange(1, 400)]
    return words


def test_cover_reaches_every_difference():
    assert {(a - b) % runs._CYCLE for a in runs._COVER for b in runs._COVER} == set(range(runs._CYCLE))


def test_common_prefixes_match_comparison():
    rng = np.random.default_rng(3)
    for alphabet, n in ((1, 300), (2, 500), (30, 400)):
        symbols = rng.integers(0, alphabet, n)
        symbols[n // 2 :] = symbols[: n - n // 2]
        found = runs.CommonPrefixes(symbols)
        i, j = rng.integers(0, n, 3000), rng.integers(0, n, 3000)
        i, j = i[i != j], j[i != j]

        def slow(a, b):
            k = 0
            while max(a, b) + k < n and symbols[a + k] == symbols[b + k]:
                k += 1
            return k

        assert found.common(i, j).tolist() == [slow(a, b) for a, b in zip(i.tolist(), j.tolist())]


def test_runs_match_brute_force(spark):
    rng = random.Random(7)
    texts = {k: periodic_text(rng) for k in range(120)} | {500: ["x"] * 3000, 501: ["x", "y"] * 40 + ["x"], 502: ["X"] * 5, 503: ["a"] * 6, 504: list("Aaaaaa")}
    rows = [(k, rng.choice(["", " ", "\n"]) + rng.choice([" ", "  ", "\t\n"]).join(ws), "h", "w", 1) for k, ws in texts.items()]
    got = {r.doc_id: r for r in runs.periodic_runs(spark.createDataFrame(rows, DOCS)).collect()}
    for k, ws in texts.items():
        want = slow_runs(ws)
        assert [tuple(r) for r in got[k].runs] == want, k
        assert got[k].collapsed == slow_collapse(ws, want) and got[k].n_words == len(ws)


def test_one_round_holds_many_documents():
    rng = random.Random(9)
    split = [[w.encode() for w in periodic_text(rng)] for _ in range(60)] + [[]]
    counts, found, texts = runs._collapse(split)
    at = 0
    for n, ws, text in zip(counts, split, texts):
        want = slow_runs(ws)
        assert [tuple(r) for r in found[at : at + n].tolist()] == want
        assert text.decode() == slow_collapse([w.decode() for w in ws], want)
        at += n


def slow_query(doc_id, text):
    words = (text or "").encode().split()
    words, n = [w.decode() for w in words], len(words)
    if doc_id is not None:
        h = zlib.crc32(str(doc_id).encode())
        g = h // 10
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    found = slow_runs(words)
    best = min(found, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)
    digest = hashlib.sha256("".join(f"{b},{s},{q}\n" for b, s, q in found).encode()).hexdigest()
    kept = hashlib.sha256(slow_collapse(words, found).encode()).hexdigest()
    longest = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
    return (doc_id, len(found), *longest, digest, kept)


RESULT = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]


def test_run_query_matches_brute_force(spark, tmp_path):
    rng = random.Random(5)
    rows = [(k, " ".join(periodic_text(rng) if k % 3 else [str(rng.randrange(9999)) for _ in range(k % 90)]), "h", "w", 1) for k in range(300)]
    rows += [(1000, None, "h", "w", 1), (1001, "", None, None, None), (1002, " \n\t ", "h", "w", 1), (None, "a b " * 20, "h", "w", 1)]
    rows += [(7, rows[7][1], "h", "w", 1), (1003, "word " * 40000, "h", "w", 1), (1004, "é  漢字 x é  漢字 x " * 9, "h", "w", 1)]
    spark.createDataFrame(rows, DOCS).write.parquet(f"{tmp_path}/documents.parquet")
    got = sorted((tuple(r) for r in op11_runs(spark, str(tmp_path)).select(*RESULT).collect()), key=str)
    want = sorted((slow_query(r[0], r[1]) if r[0] != 1003 else None for r in rows), key=str)
    assert [g for g in got if g[0] != 1003] == [w for w in want if w]
    long = next(g for g in got if g[0] == 1003)
    assert long[1:6] == (1, 0, 40000, 1, 40000000)


def test_run_query_of_an_empty_table(spark, tmp_path):
    spark.createDataFrame([], DOCS).write.parquet(f"{tmp_path}/documents.parquet")
    assert op11_runs(spark, str(tmp_path)).count() == 0


VECTORS = "vec_id bigint, embedding array<float>, label int, vector string, cluster string, apex int"


def slow_clusters(rows, k=8, rounds=10):
    kept = [
        (i, [int(np.floor(1024 * float(np.float32(x)))) for x in v])
        for i, v in rows
        if v is not None and len(v) == 64 and all(x is not None and np.isfinite(np.float32(x)) for x in v)
    ]
    starts = sorted((x for x in kept if x[0] is not None), key=lambda x: (hashlib.sha256(f"3:{x[0]}".encode()).hexdigest(), x[1]))[:k]
    centres = [v for _, v in starts]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), n) for n, c in enumerate(centres))

    for _ in range(rounds):
        members = {}
        for _, v in kept:
            members.setdefault(nearest(v)[1], []).append(v)
        centres = [[sum(x) // len(members[n]) for x in zip(*members[n])] if n in members else c for n, c in enumerate(centres)]
    found = [(i, *nearest(v)[::-1]) for i, v in kept]
    total = sum(d for _, _, d in found)
    own = {n: sum(d for _, m, d in found if m == n) for n in range(len(centres))}
    sha = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centres]
    return sorted(((i, n, d, own[n], total, sha[n]) for i, n, d in found), key=str)


def vector_table(spark, rows):
    return spark.createDataFrame([(i, v, 1, "v", "c", 2) for i, v in rows], VECTORS)


def clustered(table):
    return sorted((tuple(r) for r in centroids.cluster_vectors(table).collect()), key=str)


def test_clusters_match_plain_python(spark):
    rng = np.random.default_rng(4)
    middle = rng.normal(size=(12, 64))
    rows = [(i, [float(np.float32(x)) for x in middle[i % 12] + rng.normal(scale=0.2, size=64)]) for i in range(400)]
    rows += [(1000 + i, rows[0][1]) for i in range(60)] + [(3, rows[3][1]), (None, rows[5][1])]
    odd = [(2000, None), (2001, []), (2002, rows[0][1][:63]), (2003, [*rows[0][1], 1.0]), (2004, [None, *rows[0][1][1:]]),
           (2005, [float("nan"), *rows[0][1][1:]]), (2006, [float("inf"), *rows[0][1][1:]]), (2007, [0.0] * 64), (2008, [-0.0001] * 64)]
    assert clustered(vector_table(spark, rows + odd)) == slow_clusters(rows + odd)


@pytest.mark.parametrize("rows", [[(i, [1.0] * 64) for i in range(20)], [(i, [float(i)] * 64) for i in range(5)], [(1, [0.5] * 64)]])
def test_clusters_of_few_or_equal_vectors(spark, rows):
    assert clustered(vector_table(spark, rows)) == slow_clusters(rows)


def test_clusters_on_a_line_need_few_pivots(spark):
    rows = [(i, [float(i % 37)] + [0.0] * 63) for i in range(300)]
    assert clustered(vector_table(spark, rows)) == slow_clusters(rows)


def test_vectors_beyond_the_range_of_a_long(spark):
    rows = [(i, [float(i)] * 64) for i in range(30)]
    got = clustered(vector_table(spark, [*rows, (99, [3e30] * 64)]))
    assert [g for g in got if g[0] != 99] == slow_clusters(rows)
    assert [g[:4] for g in got if g[0] == 99] == [(99, None, None, None)]
    assert clustered(vector_table(spark, [(99, [3e30] * 64)])) == [(99, None, None, None, None, None)]
    assert clustered(vector_table(spark, [])) == []


def test_bounds_hold_around_every_distance():
    rng = np.random.default_rng(8)
    points = rng.integers(-2000, 2000, size=(300, 64))
    simplex = centroids.Simplex.over(points[:70])
    apex = simplex.apex(centroids.squared_distances(points, simplex.pivots))
    assert len(simplex.pivots) == centroids.PIVOTS
    low, high = centroids._bounds(apex, apex[:20])
    true = centroids.squared_distances(points, points[:20])
    assert (low <= true + 1).all() and (high >= true - 1).all()


def test_clusters_match_sql(spark, sf):
    got = clustered(spark.read.parquet(f"{sf}/embeddings.parquet"))
    duckdb.sql(f"CREATE OR REPLACE VIEW embeddings AS SELECT * FROM '{sf}/embeddings.parquet'")
    names = "vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256"
    assert got == sorted(duckdb.sql(f"SELECT {names} FROM ({centroids.oracle_sql()})").fetchall(), key=str)
