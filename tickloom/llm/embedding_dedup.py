"""Near-duplicate vectors by cross-polytope hashing after fast Hadamard rotations.

Equal vectors are one class. For each of ``TABLES`` tables a class is hashed by
``FUNCTIONS`` rotations, each three rounds of random signs and a fast Hadamard transform;
a hash is the nearest vertex of the cross-polytope: the largest component and its sign. Of the two nearest
vertices in each rotation, the ``PROBES`` combinations that give up least are the class's
buckets, so both sides of a pair probe.

Buckets hold ids and sketches, the signs of ``SKETCH`` random projections, and no vectors. A member stays in a bucket if
its sketch is close to another's there, so most vectors without near ones leave before any vector is moved.
What stays is verified with the vectors. A bucket's smallest id is its hub, and each pair of a member and
a hub is compared once, however many buckets it shares. Members that reach the threshold are linked to their hub;
only what the hub does not reach is compared with the whole bucket, in blocks.
That connects what all pairs of the bucket would. Within the components the numbers of
links are exact: members so close to the component's root that they must reach the threshold with each other
are counted, all others are compared with the whole component, in blocks.

All cosines are taken in double precision from the components as given, and a link means
``cosine >= threshold``. Pairs that share no bucket are missed; at a cosine of 0.9 of 64 components that was under 1 in 1,000
(measured). Sketches add a pair in ``1 / SKETCH_MISS`` at the threshold itself (their distance is binomial), fewer above it.

Cases: null, empty, zero vectors and those with null or non-finite components link with nothing;
so do vectors of different lengths with each other; repeated rows count as other vectors; a null id
links but never names a component; other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from itertools import product
from math import acos, comb, cos, pi

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tickloom.llm.components import components
from tickloom.llm.vectors import in_blocks, matrices, unit_rows, usable
from tickloom.sources.shared import written_once

THRESHOLD = 0.9
TABLES, FUNCTIONS, PROBES = 8, 2, 3
#: Bits of a sketch, two 64-bit words, and the odds that the sketches of a pair at the threshold lie too far apart.
SKETCH, SKETCH_MISS = 128, 1e-6
#: Buckets of up to this size are compared by shifts of the whole batch.
_SMALL = 48
#: Rows of one side of a comparison in a task.
BLOCK_ROWS = 1024
_PART = 4096
#: Rounding that the sure bounds leave room for.
_ROOM = 1e-9


def _hadamard(x: np.ndarray) -> np.ndarray:
    """Transform of each row, whose length is a power of two, in log2 steps."""
    n, d = x.shape
    step = 1
    while step < d:
        pairs = x.reshape(n, d // (2 * step), 2, step)
        x = np.stack([pairs[:, :, 0] + pairs[:, :, 1], pairs[:, :, 0] - pairs[:, :, 1]], 2).reshape(n, d)
        step *= 2
    return x / np.sqrt(d)


def _rotate(x: np.ndarray, seed: int) -> np.ndarray:
    signs = np.random.default_rng(seed).choice([-1.0, 1.0], (3, x.shape[1]))
    for row in signs:
        x = _hadamard(x * row)
    return x


def buckets(x: np.ndarray) -> np.ndarray:
    """Bucket keys of unit vectors: one row each, ``TABLES * PROBES`` columns."""
    n, d = x.shape
    wide = max(2, 1 << (d - 1).bit_length())
    padded = np.zeros((n, wide))
    padded[:, :d] = x
    choices = np.array(list(product((0, 1), repeat=FUNCTIONS)))
    keys = []
    for table in range(TABLES):
        lost = np.zeros((n, len(choices)))
        key = np.full((n, len(choices)), d * TABLES + table, np.int64)
        for f in range(FUNCTIONS):
            turned = _rotate(padded, table * FUNCTIONS + f)
            size = np.abs(turned)
            best = np.argpartition(-size, 1, axis=1)[:, :2]
            first = np.take_along_axis(size, best, 1)
            best = np.take_along_axis(best, np.argsort(-first, axis=1, kind="stable"), 1)
            height = np.take_along_axis(size, best, 1)
            vertex = 2 * best + (np.take_along_axis(turned, best, 1) < 0)
            lost += (height[:, :1] - height)[:, choices[:, f]]
            key = key * (2 * wide) + vertex[:, choices[:, f]]
        order = np.argsort(lost, axis=1, kind="stable")[:, :PROBES]
        keys.append(np.take_along_axis(key, order, 1))
    return np.concatenate(keys, 1)


def sketches(x: np.ndarray) -> np.ndarray:
    """Signs of random projections of each row, as two words."""
    planes = np.random.default_rng(TABLES * FUNCTIONS).normal(size=(x.shape[1], SKETCH))
    return np.packbits(x @ planes > 0, axis=1).view(np.int64)


def sketch_limit(threshold: float) -> int:
    """Most differing bits that count as near: a pair at the threshold exceeds it with odds under ``SKETCH_MISS``."""
    p = acos(max(-1.0, min(threshold, 1.0))) / pi
    left, bits = 1.0, -1
    while left > SKETCH_MISS and bits < SKETCH:
        bits += 1
        left -= comb(SKETCH, bits) * p**bits * (1 - p) ** (SKETCH - bits)
    return bits


def _hashed(batches):
    for batch in batches:
        for start in range(0, batch.num_rows, _PART):
            part = batch.slice(start, _PART)
            for rows, found in matrices(part.column(1)):
                found = found / np.abs(found).max(1, keepdims=True)
                found = found / np.linalg.norm(found, axis=1, keepdims=True)
                keys, signs = buckets(found), sketches(found)
                flat = pa.array(keys.ravel())
                offsets = pa.array(np.arange(len(rows) + 1, dtype=np.int32) * keys.shape[1])
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(pa.array(rows)), pa.array(signs[:, 0]), pa.array(signs[:, 1]),
                     pa.ListArray.from_arrays(offsets, flat)],
                    ["id", "s0", "s1", "buckets"])


def _in_pairs_of_parts(members: DataFrame, block_rows: int) -> DataFrame:
    """Members beside all others of their bucket: parts of about ``block_rows``, and each two parts (``lo``, ``hi``) meet once."""
    sizes = members.groupBy("bucket").agg(F.count("*").alias("n")).filter("n > 1").select(
        "bucket", F.ceil(F.col("n") / F.lit(block_rows)).cast("int").alias("_parts"))
    part = F.pmod(F.xxhash64("id"), F.col("_parts")).cast("int")
    spread = members.join(sizes, "bucket").withColumn("part", part).withColumn(
        "_other", F.explode(F.sequence(F.lit(0), F.col("_parts") - 1)))
    return spread.select(
        "bucket", F.least("part", "_other").alias("lo"), F.greatest("part", "_other").alias("hi"), "part", "id", "s0", "s1")


def _differing(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Differing bits of sketches, whose two words are the last axis."""
    return np.bitwise_count(a ^ b).sum(-1, dtype=np.int16)


def _near_rows(rows: pa.Table, limit: int) -> np.ndarray:
    """Which rows have a near sketch in their group; groups are runs of equal (bucket, lo, hi)."""
    bucket, lo, hi, part, _, s0, s1 = (c.to_numpy() for c in rows.columns)
    sketch = np.stack([s0, s1], 1).view(np.uint64)
    near = np.zeros(len(bucket), bool)
    first = np.flatnonzero(_starts(bucket, lo, hi))
    size = np.diff(np.append(first, len(bucket)))
    small = np.repeat(size <= _SMALL, size)
    group = np.repeat(np.arange(len(first)), size)
    for shift in range(1, int(size[size <= _SMALL].max(initial=1))):
        at = np.flatnonzero(small[shift:] & (group[shift:] == group[:-shift]))
        met = at[_differing(sketch[at], sketch[at + shift]) <= limit]
        near[met] = near[met + shift] = True
    for start, n in zip(first[size > _SMALL], size[size > _SMALL]):
        # Two parts meet each other; one part meets itself, where each row is near at least to itself.
        own = slice(start, start + n)
        left = start + np.flatnonzero(part[own] == lo[start])
        right = start + np.flatnonzero(part[own] == hi[start])
        met = _differing(sketch[left][:, None], sketch[right]) <= limit
        least = 2 if lo[start] == hi[start] else 1
        near[left] |= met.sum(1) >= least
        near[right] |= met.sum(0) >= least
    return near


def _starts(*keys: np.ndarray) -> np.ndarray:
    new = np.ones(len(keys[0]), bool)
    if len(new):
        new[1:] = np.any([k[1:] != k[:-1] for k in keys], 0)
    return new


def _near_members(limit: int):
    def found(rows):
        near = pa.array(_near_rows(rows, limit))
        return rows.select(["bucket", "id"]).filter(near).combine_chunks().to_batches()

    def members(batches):
        """(bucket, id) of near members. Rows come in order of their group; the last group waits for its end."""
        held = None
        for batch in batches:
            rows = pa.Table.from_batches([batch])
            rows = rows if held is None else pa.concat_tables([held, rows])
            start = np.flatnonzero(_starts(*(rows.column(n).to_numpy() for n in ("bucket", "lo", "hi"))))
            cut = int(start[-1]) if len(start) else 0
            yield from found(rows.slice(0, cut))
            held = rows.slice(cut)
        if held is not None:
            yield from found(held)

    return members


def _cosines(batches):
    """The columns before the last, a vector to compare ``vec`` with, and the cosine of the two."""
    for batch in batches:
        found = np.zeros(batch.num_rows)
        other = dict((tuple(r), m) for r, m in ((rows.tolist(), m) for rows, m in matrices(batch.columns[-1])))
        for rows, x in matrices(batch.column("vec")):
            y = other[tuple(rows.tolist())]
            x, y = (m / np.abs(m).max(1, keepdims=True) for m in (x, y))
            norms = np.linalg.norm(x, axis=1) * np.linalg.norm(y, axis=1)
            found[rows] = np.einsum("ij,ij->i", x, y) / norms
        yield pa.RecordBatch.from_arrays(
            [*batch.columns[:-1], pa.array(found)], [*batch.schema.names[:-1], "cosine"])


def _with_cosine(rows: DataFrame, vector: str) -> DataFrame:
    kept = rows.select(*(n for n in rows.columns if n != vector), vector)
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in kept.drop(vector).schema)
    return kept.mapInArrow(_cosines, f"{schema}, cosine double")


def _sides(table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Rows that ask, rows that answer, and both sides' unit vectors."""
    asks = table.column("_asks").to_numpy()
    x = unit_rows(table.column("vec"))
    return np.flatnonzero(asks), np.flatnonzero(~asks), x[asks], x[~asks]


def _block_links(threshold: float):
    def links(table: pa.Table) -> pa.Table:
        """Edges that connect what the links between a block's and a slice's rows connect."""
        ids = table.column("id").to_numpy()
        asks, answers, x, y = _sides(table)
        near = x @ y.T >= threshold
        met = np.flatnonzero(near.any(0))
        first = near.argmax(0)
        row, column = np.nonzero(near)
        tied = np.unique(row * len(asks) + first[column])
        u = np.concatenate([ids[asks[first[met]]], ids[asks[tied // len(asks)]]])
        v = np.concatenate([ids[answers[met]], ids[asks[tied % len(asks)]]])
        real = u != v
        return pa.table([pa.array(u[real]), pa.array(v[real])], ["u", "v"])

    return links


def _block_counts(threshold: float):
    def counts(table: pa.Table) -> pa.Table:
        """Copies that link: for a row that asks, all of the slice; for a core row that answers, the block's."""
        ids, copies = table.column("id").to_numpy(), table.column("copies").to_numpy()
        core = table.column("core").to_numpy()
        asks, answers, x, y = _sides(table)
        near = (x @ y.T >= threshold) | (ids[asks][:, None] == ids[answers])
        mine = core[answers]
        total = np.concatenate([near @ copies[answers], (copies[asks] @ near)[mine]])
        return pa.table([pa.array(np.concatenate([ids[asks], ids[answers[mine]]])), pa.array(total)], ["id", "links"])

    return counts


def near_vectors(
    vectors: DataFrame, *, id_col: str = "vec_id", vector_col: str = "embedding", threshold: float = THRESHOLD
) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for every row."""
    given = vectors.select(F.col(id_col).cast("bigint").alias("id"), F.col(vector_col).alias("vec"))
    zero = F.forall("vec", lambda x: x == 0)
    good = given.filter(usable("vec") & ~zero)
    # A class is named by a hash of its vector; its members share the vector itself.
    classes = good.groupBy("vec").agg(F.min("id").alias("first_id"), F.count("*").alias("copies"))
    classes = written_once(classes.withColumn("id", F.xxhash64("vec")), "classes")
    hashed = written_once(classes.select("id", "vec").mapInArrow(
        _hashed, "id bigint, s0 bigint, s1 bigint, buckets array<bigint>"), "hashed")
    members = hashed.select("id", "s0", "s1", F.explode("buckets").alias("bucket"))
    met = _in_pairs_of_parts(members, BLOCK_ROWS)
    met = met.repartition("bucket", "lo", "hi").sortWithinPartitions("bucket", "lo", "hi")
    near = met.mapInArrow(_near_members(sketch_limit(threshold)), "bucket bigint, id bigint")
    near = written_once(near.distinct(), "near")
    hubs = near.groupBy("bucket").agg(F.min("id").alias("hub"))
    pairs = written_once(near.join(hubs, "bucket").filter("id <> hub"), "pairs")
    vectors_of = classes.select("id", "vec")
    compared = pairs.select("id", "hub").distinct().join(vectors_of, "id").join(
        vectors_of.select(F.col("id").alias("hub"), F.col("vec").alias("hub_vec")), "hub")
    reached = _with_cosine(compared, "hub_vec").filter(F.col("cosine") >= threshold).select("id", "hub")
    reached = written_once(reached, "reached")
    star = reached.select(F.col("id").alias("u"), F.col("hub").alias("v"))
    asking = pairs.join(reached, ["id", "hub"], "left_anti").select("bucket", "id", F.lit(True).alias("_rest"))
    asked = near.join(asking, ["bucket", "id"], "left").withColumn("_rest", F.coalesce("_rest", F.lit(False)))
    asked = in_blocks(written_once(asked, "asked"), "bucket", "_rest", BLOCK_ROWS).join(vectors_of, "id")
    rest = asked.select("bucket", "_block", "_slice", "_asks", "id", "vec").groupBy(
        "bucket", "_block", "_slice").applyInArrow(
        _block_links(threshold), "u bigint, v bigint")
    roots = written_once(components(star.unionByName(rest)), "roots")

    inside = roots.select(F.col("node").alias("id"), "root").unionByName(
        roots.select(F.col("root").alias("id"), "root").distinct())
    placed = classes.join(inside, "id").select("root", "id", "vec", "copies", "first_id")
    root_vec = classes.select(F.col("id").alias("root"), F.col("vec").alias("root_vec"))
    near = F.col("cosine") >= cos(acos(min(threshold, 1.0)) / 2) + _ROOM
    placed = written_once(
        _with_cosine(placed.join(root_vec, "root"), "root_vec").withColumn("core", near), "placed")
    named = placed.groupBy("root").agg(
        F.min("first_id").alias("component_id"),
        F.sum(F.when(F.col("core"), F.col("copies")).otherwise(0)).alias("core_copies"))
    asked = in_blocks(placed.withColumn("_rest", ~F.col("core")), "root", "_rest", BLOCK_ROWS)
    counted = asked.select("root", "_block", "_slice", "_asks", "id", "core", "copies", "vec").groupBy(
        "root", "_block", "_slice").applyInArrow(_block_counts(threshold), "id bigint, links bigint")
    counted = counted.groupBy("id").agg(F.sum("links").alias("links"))
    inside_core = F.when(F.col("core"), F.col("core_copies")).otherwise(0)
    linked = placed.join(named, "root").join(counted, "id", "left").select(
        "id", "component_id", (inside_core + F.coalesce("links", F.lit(0)) - 1).alias("n_links"))
    of_class = classes.select("id", "copies", "first_id").join(linked, "id", "left").select(
        "id", F.coalesce("component_id", "first_id").alias("component_id"),
        F.coalesce("n_links", F.col("copies") - 1).alias("n_links"))
    of_class = written_once(of_class, "of-class")
    found = given.withColumn("_class", F.when(usable("vec") & ~zero, F.xxhash64("vec"))).join(
        of_class.withColumnRenamed("id", "_class"), "_class", "left")
    component = F.coalesce("component_id", "id")
    return found.select(
        F.col("id").alias("vec_id"), F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"),
        component.alias("component_id"), F.coalesce(F.col("id") == component, F.lit(False)).alias("kept"))
