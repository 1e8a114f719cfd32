import numpy as np
import pytest

from conftest import SMALL
from tickloom.llm import embedding_dedup, topk_search

SCHEMA = "vec_id bigint, embedding array<float>, label int"


def brute_links(ids, rows, threshold=0.9):
    """n_links and component of each row, by the definition."""
    usable = [r is not None and len(r) > 0 and all(x is not None and np.isfinite(x) for x in r) and any(r) for r in rows]
    n, links, root = len(ids), [0] * len(ids), list(range(len(ids)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(n):
        for j in range(i):
            if usable[i] and usable[j] and len(rows[i]) == len(rows[j]):
                a, b = np.array(rows[i], np.float32).astype(float), np.array(rows[j], np.float32).astype(float)
                if a @ b / np.sqrt((a @ a) * (b @ b)) >= threshold:
                    links[i] += 1
                    links[j] += 1
                    root[find(i)] = find(j)
    named = {}
    for i in range(n):
        if ids[i] is not None:
            named[find(i)] = min(named.get(find(i), ids[i]), ids[i])
    return sorted((ids[i] or -1, links[i], named.get(find(i)) or 0) for i in range(n))


def clusters(seed, n=150, d=16, noise=(0.0, 0.02, 0.1, 0.12)):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(8, d))
    return [(centres[rng.integers(8)] + rng.normal(size=d) * noise[rng.integers(len(noise))]).tolist() for _ in range(n)]


def found_links(df):
    rows = embedding_dedup.near_vectors(df).collect()
    assert all(r.kept == (r.vec_id is not None and r.vec_id == r.component_id) for r in rows)
    return sorted((r.vec_id or -1, r.n_links, r.component_id or 0) for r in rows)


@pytest.mark.parametrize("seed", [1, 2])
def test_links_equal_brute_force(spark, monkeypatch, seed):
    monkeypatch.setattr(embedding_dedup, "BLOCK_ROWS", 7)
    rows = clusters(seed)
    df = spark.createDataFrame([(i + 1, r, 0) for i, r in enumerate(rows)], SCHEMA)
    assert found_links(df) == brute_links(list(range(1, len(rows) + 1)), rows)


def test_odd_vectors(spark):
    inf, nan = float("inf"), float("nan")
    rows = [None, [], [0.0, 0.0], [1.0, None], [1.0, nan], [1.0, inf], [1.0, 2.0], [2.0, 4.0], [1.0, 2.0], [1.0, 2.0, 0.0],
            [1e30, 2e30], [1e-30, 2e-30], [3.0], [-3.0]]
    ids = [*range(1, len(rows)), None]
    df = spark.createDataFrame([(i, r, 0) for i, r in zip(ids, rows)], SCHEMA)
    assert found_links(df) == brute_links(ids, rows)
    assert embedding_dedup.near_vectors(df.limit(0)).count() == 0


def test_recall_at_the_threshold():
    """Pairs at a cosine of exactly 0.9 share a bucket, whatever is compared afterwards."""
    rng = np.random.default_rng(5)
    a, b = rng.normal(size=(2, 2000, 64))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    b -= (a * b).sum(1, keepdims=True) * a
    b /= np.linalg.norm(b, axis=1, keepdims=True)
    near = 0.9 * a + np.sqrt(1 - 0.81) * b
    shared = (embedding_dedup.buckets(a)[:, :, None] == embedding_dedup.buckets(near)[:, None, :]).any((1, 2))
    assert shared.mean() > 0.995


def test_whole_table_against_brute_force(spark):
    df = spark.read.parquet(f"{SMALL}/embeddings.parquet")
    rows = df.collect()
    assert found_links(df) == brute_links([r.vec_id for r in rows], [r.embedding for r in rows])


def brute_top(rows, k):
    ints = {i: [int(np.floor(64 * float(np.float32(x)))) for x in v] for i, v in rows if v is not None and i is not None}
    out = []
    for q in sorted(i for i in ints if i % 20 == 0):
        scored = sorted((-sum(a * b for a, b in zip(ints[q], v)), i) for i, v in ints.items()
                        if i != q and len(v) == len(ints[q]))
        out += [(q, rank, i, -s) for rank, (s, i) in enumerate(scored[:k], 1)]
    return out


@pytest.mark.parametrize("seed, d", [(1, 4), (2, 16)])
def test_top_k_equals_brute_force(spark, monkeypatch, seed, d):
    monkeypatch.setattr(topk_search, "BLOCK_ROWS", 40)
    rng = np.random.default_rng(seed)
    # Few values, so ties abound; long and short vectors, so bounds matter.
    rows = [(i, (rng.integers(-2, 3, d) / 8 * (1 + 9 * (i % 7 == 0))).tolist()) for i in range(400)]
    df = spark.createDataFrame([(*r, 0) for r in rows], SCHEMA)
    found = topk_search.top_k(df, topk_search.F.col("id") % 20 == 0, k=5).collect()
    assert sorted(map(tuple, found)) == brute_top(rows, 5)


def test_top_k_odd_rows(spark):
    rows = [(0, [1.0, 2.0], 0), (20, [1.0], 0), (1, [1.0, 2.0], 0), (1, [1.0, 2.0], 0), (40, None, 0),
            (60, [1.0, float("nan")], 0), (None, [1.0, 1.0], 0), (2, [0.0, 0.0], 0), (3, [1e6, -1e6], 0)]
    found = topk_search.top_k(spark.createDataFrame(rows, SCHEMA), topk_search.F.col("id") % 20 == 0).collect()
    assert sorted((r.query_id, r.rank, r.vec_id, r.score) for r in found) == [
        (0, 1, 1, 64 * 64 * 5), (0, 2, 1, 64 * 64 * 5), (0, 3, 2, 0), (0, 4, 3, -(64 * 64 * 10**6))]
    assert topk_search.top_k(spark.createDataFrame([], SCHEMA), topk_search.F.col("id") % 20 == 0).count() == 0


def test_top_k_whole_cluster_in_one_block(spark, monkeypatch):
    monkeypatch.setattr(topk_search, "PIVOTS", 4)
    monkeypatch.setattr(topk_search, "ANNULI", 1)
    rng = np.random.default_rng(3)
    # Tight clusters of more than k + 1 vectors, without ties: all of a query's best lie beside its own row.
    centres = rng.normal(size=(12, 16)) * 4
    rows = [(i, (centres[i % 12] + rng.normal(size=16) * 0.05).tolist()) for i in range(12 * 40)]
    df = spark.createDataFrame([(*r, 0) for r in rows], SCHEMA)
    found = topk_search.top_k(df, topk_search.F.col("id") % 20 == 0).collect()
    assert sorted(map(tuple, found)) == brute_top(rows, 20)


def test_block_keeps_k_besides_the_own_row():
    v = [[i, 1] for i in range(1, 32)]
    table = topk_search.pa.table({
        "asks": [True] + [False] * 31, "query": [7] + [0] * 31, "id": [31, *range(1, 32)], "v": [v[-1], *v]})
    found = topk_search._search(20)(table)
    assert found.column("vec_id").to_pylist() == list(range(30, 10, -1))


def test_sketches_of_pairs_at_the_threshold():
    rng = np.random.default_rng(6)
    a, b = rng.normal(size=(2, 20000, 64))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    b -= (a * b).sum(1, keepdims=True) * a
    b /= np.linalg.norm(b, axis=1, keepdims=True)
    near = 0.9 * a + np.sqrt(1 - 0.81) * b
    limit = embedding_dedup.sketch_limit(0.9)
    words = [embedding_dedup.sketches(x).view(np.uint64) for x in (a, near, b)]
    assert (embedding_dedup._differing(words[0], words[1]) <= limit).all()
    assert (embedding_dedup._differing(words[0], words[2]) <= limit).mean() < 1e-3


@pytest.mark.parametrize("small", [2, 48])
def test_near_rows_equal_brute_force(monkeypatch, small):
    monkeypatch.setattr(embedding_dedup, "_SMALL", small)
    rng = np.random.default_rng(7)
    groups = [(b, lo, hi) for b in range(3) for lo, hi in ((0, 0), (0, 1), (1, 1))]
    rows = [(*g, part, i, *rng.integers(0, 4, 2)) for g in groups for part in sorted({g[1], g[2]})
            for i in range(rng.integers(1, 9))]
    table = embedding_dedup.pa.table({n: [int(r[k]) for r in rows] for k, n in enumerate(
        ("bucket", "lo", "hi", "part", "id", "s0", "s1"))})
    found = embedding_dedup._near_rows(table, 1)

    def near(i, j):
        a, b = rows[i], rows[j]
        bits = (int(a[5]) ^ int(b[5])).bit_count() + (int(a[6]) ^ int(b[6])).bit_count()
        other = small > 2 or a[1] == a[2] or a[3] != b[3]
        return i != j and a[:3] == b[:3] and bits <= 1 and other

    assert found.tolist() == [any(near(i, j) for j in range(len(rows))) for i in range(len(rows))]
