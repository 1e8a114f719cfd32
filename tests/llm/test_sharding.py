from collections import Counter
from hashlib import md5

import pytest

from conftest import SMALL
from tickloom.llm import queries, sharding

SHARDS = [f"s{i}" for i in range(7)]


def test_table_is_filled_evenly_and_by_preference():
    table = sharding.lookup_table(SHARDS, 211)
    shares = Counter(table)
    assert set(shares) == set(SHARDS) and max(shares.values()) - min(shares.values()) <= 1
    first = sorted(SHARDS)[0]
    assert table[sharding._hash(f"{first}/start") % 211] == first


def test_weights_are_turns():
    shares = Counter(sharding.lookup_table({"a": 3, "b": 1}, 4099))
    assert abs(shares["a"] - 3 * shares["b"]) <= 4


def test_few_slots_move_when_a_shard_leaves():
    before, after = sharding.lookup_table(SHARDS, 4099), sharding.lookup_table(SHARDS[:-1], 4099)
    moved = sum(a != b for a, b in zip(before, after) if a != SHARDS[-1])
    assert moved < 0.25 * 4099


@pytest.mark.parametrize("shards, slots", [([], 7), (["a", "a"], 7), ({"a": 0}, 7), (["a"], 8), (list("abc"), 2)])
def test_wrong_settings(shards, slots):
    with pytest.raises(ValueError):
        sharding.lookup_table(shards, slots)


def test_rows_keep_columns_and_equal_keys_meet(spark):
    rows = spark.createDataFrame(
        [(1, "a", "x"), (1, "a", "y"), (None, "a", "z"), (2, None, "z"), (None, None, "")],
        "k bigint, slot_name string, shard_in string")
    found = sharding.place(rows, ["k", "slot_name"], SHARDS, slots=211, keep=["shard_in"]).collect()
    assert len(found) == 5 and found[0].asDict().keys() == {"k", "slot_name", "shard_in", "slot", "shard"}
    table = sharding.lookup_table(SHARDS, 211)
    assert all(table[r.slot] == r.shard for r in found)
    assert len({r.slot for r in found if r.k == 1}) == 1
    assert sharding.place(rows.limit(0), ["k"], SHARDS).count() == 0


def test_null_and_the_text_null_differ(spark):
    rows = spark.createDataFrame([("",), (None,), ("-",)], "k string")
    assert len({r.slot for r in sharding.place(rows, ["k"], SHARDS).collect()}) == 3


def test_whole_query_against_plain_python(spark):
    """Slots from the digest's definition, and a table filled by whole lists of preferences."""
    shards = dict.fromkeys(queries.SHARDS, 1) if not isinstance(queries.SHARDS, dict) else queries.SHARDS
    slots = sharding.SLOTS

    def number(text):
        return int(md5(text.encode()).hexdigest()[:15], 16)

    prefers = {}
    for name in sorted(shards):
        start, step = number(f"{name}/start") % slots, number(f"{name}/step") % (slots - 1) + 1
        prefers[name] = iter([(start + i * step) % slots for i in range(slots)])
    owner = {}
    while len(owner) < slots:
        for name in sorted(shards):
            for _ in range(shards[name]):
                claimed = next((s for s in prefers[name] if s not in owner), None)
                if claimed is not None:
                    owner[claimed] = name

    rows = queries.build_queries()["op1_sharding"](spark, SMALL).collect()
    assert len(rows) == spark.read.parquet(f"{SMALL}/documents.parquet").count()
    for r in rows:
        key = "-" if r.doc_id is None else f"={r.doc_id}"
        assert r.slot == number(f"{len(key)}{key}") % slots and r.shard == owner[r.slot]
