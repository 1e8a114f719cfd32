import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from conftest import SMALL
from llm_fixtures import documents  # noqa: F401
from tickloom.llm import jaccard_join
from tickloom.llm.components import components


def brute(rows):
    """(doc_id, n_shingles, component_id) by the definition."""
    sets = []
    for _, text in rows:
        w = (text or "").encode().lower().split()
        sets.append(frozenset(tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset())
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= 80 * (len(sets[i]) + len(sets[j]) - both):
                root[find(i)] = find(j)
    least = {}
    for i, (name, _) in enumerate(rows):
        if name is not None:
            least[find(i)] = min(least.get(find(i), name), name)
    return sorted((str(rows[i][0]), len(sets[i]), str(least.get(find(i)))) for i in range(len(rows)))


def found(documents, rows):
    result = jaccard_join.near_duplicates(documents(*rows)).collect()
    return sorted((str(r.doc_id), r.n_shingles, str(r.component_id)) for r in result)


def edited(rng, words, edits):
    words = list(words)
    for _ in range(edits):
        at = rng.randrange(len(words))
        words[at:at + rng.randint(0, 1)] = [f"e{rng.randrange(10**6)}"] * rng.randint(0, 2)
    return words


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_join_equals_brute_force(documents, seed):
    """Families of edited copies around the threshold, short texts, a passage shared by many."""
    rng = random.Random(seed)
    passage = [f"p{i}" for i in range(60)]
    rows = []
    for family in range(25):
        base = [f"v{rng.randrange(500)}" for _ in range(rng.choice([1, 3, 5, 6, 8, 12, 20, 40, 80, 200]))]
        if family % 3 == 0:
            base = base + passage
        for _ in range(rng.randint(1, 12)):
            rows.append((len(rows), " ".join(edited(rng, base, rng.choice([0, 0, 1, 1, 2, 3])) or ["z"])))
    assert found(documents, rows) == brute(rows)


def test_large_group_of_near_copies(documents):
    """Many lists that one star does not connect: a chain of copies, each edited from the one before."""
    rng = random.Random(9)
    words = [f"w{i}" for i in range(120)]
    rows = []
    for i in range(150):
        words = edited(rng, words, 1)
        rows.append((i, " ".join(words)))
    assert found(documents, rows) == brute(rows)


def test_odd_rows(documents):
    text = "a b c d e f g h"
    rows = [(5, text), (5, text), (3, text.upper()), (None, text), (None, None), (7, None), (8, ""), (9, " \t\n"), (10, "one"),
            (11, "ONE"), (12, "one\u00a0two"), (13, "É"), (14, "é"), (15, "x " * 100), (16, "x " * 300), (5, "other words here")]
    result = found(documents, rows)
    expected = brute(rows)
    assert result == expected
    assert jaccard_join.near_duplicates(documents()).count() == 0
    long = " ".join(f"w{i}" for i in range(60_000))
    assert found(documents, [(1, long), (2, long + " end")]) == [("1", 59_996, "1"), ("2", 59_997, "1")]


def test_query_on_whole_table(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    result = jaccard_join.near_duplicates(docs).collect()
    assert sorted((str(r.doc_id), r.n_shingles, str(r.component_id)) for r in result) == brute(rows)


def test_units_cover_every_difference():
    """A linked pair meets: r's units answer in the band of the smaller set, for the most edits allowed."""
    rng = np.random.default_rng(0)
    hot = np.zeros(jaccard_join._HOT_SLOTS, bool)
    for n in [*range(1, 40), 77, 150, 400]:
        for _ in range(6):
            pool = rng.choice(1 << 50, 2 * n + 2, replace=False).astype(np.uint64)
            extra = int(rng.integers(0, n // 4 + 1))
            most = (2 * n + extra) // 9
            cut = max(0, min((most - extra) // 2, n - 1))
            pairs = [pool[:n], np.concatenate([pool[cut:n], pool[n:n + cut + extra]])]
            both = n - cut
            if 100 * both < 80 * (2 * n + extra - both):
                continue
            size = np.array([len(p) for p in pairs])
            doc = np.repeat([0, 1], size)
            found = jaccard_join.signatures(doc, np.concatenate(pairs), size, hot)
            keys = found.signature >> np.uint64(jaccard_join.ROLE_BITS)
            assert set(keys[found.doc == 0]) & set(keys[found.doc == 1])


def test_components_of_a_path_and_a_star(spark):
    links = [(i, i + 1) for i in range(200)] + [(1000, i) for i in range(1001, 1100)] + [(5, 5), (3, 2)]
    result = components(spark.createDataFrame(links, "u bigint, v bigint")).collect()
    assert {(r.node, r.root) for r in result} == {(i, 0) for i in range(1, 201)} | {(i, 1000) for i in range(1001, 1100)}
    assert components(spark.createDataFrame([], "u bigint, v bigint")).count() == 0


def test_rows_without_ids_make_no_pairs(spark, documents):
    """Many different texts without an id, or with the same one: each class is read from its own row."""
    texts = [" ".join(f"{x}{i}" for i in range(30)) for x in range(60)]
    rows = [(i, t) for t in texts for i in (None, 7)] + [(None, t + " end") for t in texts] + [(100, texts[0] + " and end")]
    found = jaccard_join.near_duplicates(documents(*rows)).collect()
    assert {r.component_id for r in found if r.n_shingles} == {7}
    joined = jaccard_join.jaccard_links(documents(*rows))
    assert joined.links.count() >= 61
    docs = documents(*rows).selectExpr("doc_id", "text", "xxhash64(text) AS digest")
    assert docs.join(docs.selectExpr("doc_id AS d", "digest AS e"), F.expr("doc_id <=> d AND digest = e")).count() == len(rows)


def listed(units, buckets, block_rows):
    """Candidate pairs and list members that packing and meeting find, by a plain model of both shuffles."""
    dealt = {}
    for at in range(0, len(units), block_rows):
        signature, set_id = (np.array(x) for x in zip(*units[at:at + block_rows]))
        for batch in jaccard_join._pack(signature.astype(np.uint64), set_id.astype(np.int64), buckets):
            dealt.setdefault(batch.column(0)[0].as_py(), []).append(batch)
    pairs, lists, hot = set(), {}, {}
    for bucket, batches in dealt.items():
        for row in jaccard_join._meet(pa.Table.from_batches(batches), buckets).to_pylist():
            if row["kind"] == 0:
                pairs.add((row["a"], row["b"]))
            elif row["kind"] == 1:
                lists.setdefault(row["a"], set()).add(row["b"])
            else:
                members = hot.setdefault(row["a"], {})
                members[row["b"]] = members.get(row["b"], 0) | row["role"]
    return dealt, pairs, lists, hot


def test_hot_signatures_leave_their_bucket(spark):
    """Signatures of some, hundreds and thousands of sets in blocks of many sizes: the same groups as without blocks."""
    rng = np.random.default_rng(4)
    probe, index = jaccard_join.PROBE, jaccard_join.INDEXED
    keys = rng.choice(1 << 58, 40, replace=False).astype(np.uint64) << np.uint64(jaccard_join.ROLE_BITS)
    units, groups, roles = [], {}, {}
    for n, key in enumerate(keys.tolist()):
        for member in rng.choice(1 << 40, int(rng.choice([2, 3, 9, 70, 200, 3000])), replace=False).tolist():
            role = index if n % 4 == 3 else index | probe
            groups.setdefault(key, set()).add(member)
            roles[key] = roles.get(key, 0) | role
            units += [(key | role, member)] * int(rng.integers(1, 3))
    order = rng.permutation(len(units))
    units = [units[i] for i in order]
    useful = {k: v for k, v in groups.items() if roles[k] & probe}
    dealt, pairs, lists, hot = listed(units, 8, 4000)
    assert hot and max(dealt) >= 8
    assert {k % (1 << 64) for k in hot} >= {k for k, v in groups.items() if len(v) == 3000}
    for key, members in groups.items():
        signed = int(np.uint64(key).view(np.int64))
        if signed in hot:
            assert set(hot[signed]) == members
            assert bool(np.bitwise_or.reduce(list(hot[signed].values())) & probe) == (key in useful)
        elif key in useful and len(members) > jaccard_join.SMALL:
            assert members in lists.values()
        elif key in useful:
            assert {(a, b) for a in members for b in members if a < b} <= pairs
    rows = [(2, key, member, role) for key, members in hot.items() for member, role in members.items()]
    met = spark.createDataFrame(rows, "kind tinyint, a bigint, b bigint, role tinyint")
    found = jaccard_join._hot_lists(met.unionByName(met.withColumn("a", F.col("a") + 32))).collect()
    kept = {}
    for r in found:
        kept.setdefault(r.list, set()).add(r.set_id)
    assert sorted(map(sorted, kept.values())) == sorted(sorted(m) for k, m in hot.items() if k % (1 << 64) in useful)
    # Far from its bucket: what reaches it of a hot signature are marks and the sets of blocks that hold few.
    at_home = sum(len(b.column(2)[0].as_py()) // 8 for k, v in dealt.items() if k < 8 for b in v)
    assert at_home < sum(len(m) for m in groups.values()) / 3


def test_hot_group_of_different_near_copies(spark, documents):
    """A third of the rows are different near copies that share a passage, in one large and many small partitions; some lack an id."""
    rng = random.Random(21)
    passage = [f"p{i}" for i in range(90)]
    rows = []
    for i in range(330):
        rows.append((None if i % 10 == 0 else i, " ".join(edited(rng, passage, rng.choice([1, 2, 4, 9])))))
    rows += [(1000 + i, " ".join(passage[:40] + [f"u{rng.randrange(10**6)}" for _ in range(50)])) for i in range(170)]
    rows += [(2000 + i, " ".join(f"x{rng.randrange(10**6)}" for _ in range(30))) for i in range(400)]
    rng.shuffle(rows)
    table = documents(*rows[:600]).coalesce(1).unionByName(documents(*rows[600:]).repartition(5))
    result = jaccard_join.near_duplicates(table).collect()
    assert sorted((str(r.doc_id), r.n_shingles, str(r.component_id)) for r in result) == brute(rows)
