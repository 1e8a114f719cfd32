"""Placement of keys on shards through a permutation-filled lookup table.

The table has a prime number of slots. Each shard has its own order of preference over all
slots: it starts at one hash of its name and goes on by a step from another, which visits
every slot once as the size is prime. Shards take turns, in order of name, and claim the first free slot
they prefer; a shard of weight w takes w turns a round. So shares differ by a slot or so, and
when a shard leaves, few keys of the others move.

The table has a fixed size, a parameter, and is broadcast: a key is hashed to a slot, and the
slot gives the shard by one lookup. Nothing is shuffled, so no key can be hot.

Cases: a null key has a slot of its own kind, that of the empty string with a mark; repeated keys go to one
shard; keys of several columns are told apart from their joined text; an empty table gives an empty
result; no shard, repeated names, or weights below 1 raise ``ValueError``, as does a table that is not prime or has fewer
slots than turns in a round; other columns pass through ``keep``.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from hashlib import md5

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

SLOTS = 65537
#: The largest table: some 16 MB when broadcast.
MOST_SLOTS = 1 << 20


def _is_prime(n: int) -> bool:
    return n > 1 and all(n % d for d in range(2, int(n**0.5) + 1))


def _hash(text: str) -> int:
    return int(md5(text.encode()).hexdigest()[:15], 16)


def lookup_table(shards: Sequence[str] | Mapping[str, int], slots: int = SLOTS) -> list[str]:
    """The shard of each slot; ``shards`` may map names to weights."""
    weights = dict(shards) if isinstance(shards, Mapping) else {name: 1 for name in shards}
    if not weights or len(weights) != len(shards) or min(weights.values()) < 1:
        raise ValueError("shards need different names and weights of 1 or more")
    if not _is_prime(slots) or slots > MOST_SLOTS or slots < sum(weights.values()):
        raise ValueError("the table needs a prime number of slots, no fewer than turns in a round")
    names = sorted(weights)
    at = {n: _hash(f"{n}/start") % slots for n in names}
    step = {n: _hash(f"{n}/step") % (slots - 1) + 1 for n in names}
    table: list[str | None] = [None] * slots
    left = slots
    while left:
        for name in names:
            for _ in range(weights[name]):
                if not left:
                    break
                while table[at[name]] is not None:
                    at[name] = (at[name] + step[name]) % slots
                table[at[name]] = name
                left -= 1
    return table


def slot_of(keys: Sequence[str], slots: int) -> Column:
    """Slot of the key columns: the first 60 bits of an MD5 digest, modulo the number of slots."""
    parts = [F.coalesce(F.concat(F.lit("="), F.col(k).cast("string")), F.lit("-")) for k in keys]
    marked = [F.concat(F.length(p).cast("string"), p) for p in parts]
    return F.pmod(F.conv(F.substring(F.md5(F.concat(*marked)), 1, 15), 16, 10).cast("bigint"), F.lit(slots))


def table_frame(spark: SparkSession, table: Sequence[str]) -> DataFrame:
    """(slot, shard) of a lookup table."""
    return spark.createDataFrame(list(enumerate(table)), "slot bigint, shard string")


def place(
    rows: DataFrame, keys: Sequence[str], shards: Sequence[str] | Mapping[str, int], *, slots: int = SLOTS,
    keep: Sequence[str] = (),
) -> DataFrame:
    """Key columns, ``keep``, slot and shard of every row."""
    table = table_frame(rows.sparkSession, lookup_table(shards, slots))
    slotted = rows.select(*keys, *keep, slot_of(keys, slots).alias("slot"))
    return slotted.join(F.broadcast(table), "slot").select(*keys, *keep, "slot", "shard")
