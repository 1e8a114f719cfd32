"""Exact Jaccard self-join of texts on word shingles, by partitioning the universe.

A document's set is its distinct five-word shingles (``shingles``). Two sets
link when ``100 * intersection >= 80 * union``, decided on whole sets.

Candidates. Sets are put into size bands whose bounds grow by the factor 1 / 0.8, so a
set meets smaller partners in its own band or the one or two below. In a band,
hashing deals all tokens into the same number of segments. Sets r and s that
link differ in at most ``(|r| + |s|) / 9`` tokens. Give r's segments units that sum to
one more than that: one unit asks for an equal segment, two units for a segment
that differs in at most one token. If no segment answers, r and s differ too much.
A segment's signature is a hash of its tokens; two units also use the segment's
one-deletion neighbours, which sets index for a fixed share of segments. r spends its units
where they cost least: segments made of frequent tokens, and empty ones, come
last. Token frequencies come from all documents, and only guide the cost.

Signatures are dealt by hash in packed blocks, each class of equal sets once a task. Sets that share
a signature are candidates; a group of more than ``SMALL`` sets becomes a list, and its pairs are those with its hub, the
member of most lists. Verified pairs give components. Only lists whose sets are still in several
components have their remaining pairs compared, in blocks of bounded size.

A signature that ``HOT`` sets of one block share is not gathered in its bucket: those sets go to other buckets, dealt by
block, and become rows of the signature's list there. A mark in its own bucket has the sets of other blocks added to
that list, so the list is whole, and no task holds more than ``HOT`` sets a block of one signature.

Before sets are fetched, two cheap bounds drop pairs that cannot link: their sizes, and their parity
bitmaps. A bitmap holds the parity of the number of tokens in each of ``CELLS`` cells, so two sets differ in at
least as many tokens as their bitmaps in bits.

Cases: null and empty texts have no shingles and link with nothing; repeated rows
are one class; a null id is a row like any other and never names a component; rows that share an id are told apart by their
text, so neither a null nor a repeated id makes pairs; other columns
are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tickloom.llm.components import components
from tickloom.llm.shingles import make_room, mix, release, token_sets
from tickloom.llm.vectors import dealt, parts
from tickloom.sources.shared import written_once

_U = np.uint64
#: Similarity 0.8 as used in whole numbers: sizes of linked sets, and 1 / 9 of their sum may differ.
PERCENT = 80
SLACK = 1.1
INDEXED, PROBE, PROBE_TWO, PROBE_CUT, INDEXED_CUT = 1, 2, 4, 8, 16
ROLE_BITS = 5
SMALL = 4
#: Signatures a bucket holds on average, and a packed block before it is sent.
BUCKET_ROWS = 1 << 20
BLOCK_ROWS = 1 << 19
#: Classes a task remembers as sent; beyond it starts anew and sends some twice.
REMEMBERED = 1 << 18
#: Sets of a block that share a signature before it is kept out of its bucket, and parts of its list in a join.
HOT = 64
PARTS = 64
#: Frequent tokens: in at least so many different sets of a window of so many tokens; the most frequent guide the cost.
FREQUENT_IN_WINDOW = 3
WINDOW_TOKENS = 1 << 22
FREQUENT = 1 << 16
CELLS = 1024
#: Members of a list in one side of a comparison.
LIST_BLOCK = 2048
#: Up to so many segments, one-deletion neighbours are indexed for all of them.
ALL_CUT = 8
_HOT_SLOTS = 1 << 22


def _band_edges() -> np.ndarray:
    edges = [1]
    while edges[-1] < 1 << 40:
        edges.append(max(edges[-1] + 1, edges[-1] * 100 // PERCENT))
    return np.array(edges, np.int64)


_EDGES = _band_edges()
_TOP = _EDGES[1:] - 1
#: Largest difference in a band, from a partner of the top size and the largest set that meets it.
_MOST = (_TOP + _TOP * 100 // PERCENT) // 9 + 1
_SEGMENTS = np.ceil(_MOST * SLACK).astype(np.int64) + 1
_CUT_SEGMENTS = np.where(_SEGMENTS <= ALL_CUT, _SEGMENTS, 1 + _SEGMENTS // 32)


class Units(NamedTuple):
    signature: np.ndarray
    doc: np.ndarray


def _cheapest(level_one: np.ndarray, level_two: np.ndarray, doc: np.ndarray, need: np.ndarray) -> np.ndarray:
    """Units per segment: for each document the ``need`` cheapest of its first and second units."""
    cost = np.concatenate([level_one, level_two])
    flat = np.concatenate([np.arange(len(doc))] * 2)
    owner = np.concatenate([doc, doc])
    order = np.lexsort((cost, owner))
    owner = owner[order]
    first = np.searchsorted(owner, owner, "left")
    taken = (np.arange(len(owner)) - first < need[owner]) & np.isfinite(cost[order])
    units = np.zeros(len(doc), np.int64)
    np.add.at(units, flat[order][taken], 1)
    return units


def _band_units(doc, token, size, below: int, hot: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Signatures with their roles, and their documents, in the band ``below`` under the own one."""
    own = np.searchsorted(_EDGES, size, "right") - 1
    band = own - below
    in_reach = (size > 0) & (band >= 0) & (_TOP[np.maximum(band, 0)] * 100 >= size * PERCENT)
    kept = in_reach[doc]
    doc, token = doc[kept], token[kept]
    members = np.flatnonzero(in_reach)
    if not len(members):
        return np.zeros(0, _U), np.zeros(0, np.int64)
    band_of = band[members]
    width = _SEGMENTS[band_of]
    start = np.concatenate([[0], np.cumsum(width)])
    local = np.full(len(size), -1)
    local[members] = np.arange(len(members))
    owner = local[doc]
    with np.errstate(over="ignore"):
        seed = mix(band_of.astype(_U) + _U(77))
        dealt = mix(token ^ seed[owner]) >> _U(32)
        flat = start[owner] + ((dealt * width[owner].astype(_U)) >> _U(32)).astype(np.int64)
        value = mix(token + _U(0x51ED))
        total = np.zeros(start[-1], _U)
        np.add.at(total, flat, value)
        filled = np.bincount(flat, minlength=start[-1])
        frequent = np.bincount(flat, weights=hot[(token & _U(_HOT_SLOTS - 1)).astype(np.int64)], minlength=start[-1])
        seg_doc = np.repeat(np.arange(len(members)), width)
        seg_no = np.arange(start[-1]) - start[seg_doc]
        place = mix((band_of[seg_doc].astype(_U) << _U(40)) ^ seg_no.astype(_U) ^ seed[seg_doc])
        need = (size[members] + np.minimum(_TOP[band_of], size[members])) // 9 + 1
        rare = frequent < filled
        rank = np.cumsum(rare) - 1
        rank -= np.concatenate([[0], np.cumsum(rare)])[start[:-1]][seg_doc]
        units = (rare & (rank < need[seg_doc])).astype(np.int64)
        cut_here = seg_no < _CUT_SEGMENTS[band_of[seg_doc]]
        lacking = np.add.reduceat(units, start[:-1]) < need
        scarce = lacking[seg_doc]
        if scarce.any():
            n, common = filled[scarce], ~rare[scarce]
            one = np.where(n == 0, 3e3, np.where(common, 1e3 / np.maximum(n, 1), 0.0))
            two = np.where(cut_here[scarce], one + np.where(n < 2, 2e3, np.where(common, 1e3, n + 1.0)), np.inf)
            again = np.cumsum(lacking) - 1
            units[scarce] = _cheapest(one, two, again[seg_doc[scarce]], need[lacking])
        whole = mix(total ^ place)
        role = np.where(units > 0, PROBE, 0) | np.where(units > 1, PROBE_TWO, 0)
        if not below:
            role |= INDEXED
        sent = role > 0
        signature, role, at = [whole[sent]], [role[sent]], [seg_doc[sent]]
        cut_role = np.where(units > 1, PROBE_CUT, 0) | np.where(cut_here & (not below), INDEXED_CUT, 0)
        cut = cut_role[flat] > 0
        signature.append(mix((total[flat[cut]] - value[cut]) ^ place[flat[cut]]))
        role.append(cut_role[flat[cut]])
        at.append(owner[cut])
        found = (np.concatenate(signature) & ~_U((1 << ROLE_BITS) - 1)) | np.concatenate(role).astype(_U)
    return found, members[np.concatenate(at)]


def signatures(doc, token, size, hot) -> Units:
    """Signatures of all sets of a chunk, the role in the lowest bits, and their documents."""
    parts = [_band_units(doc, token, size, below, hot) for below in range(3)]
    return Units(np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts]))


class _Fresh:
    """Which set ids a task meets for the first time."""

    def __init__(self):
        self.seen: set[int] = set()

    def __call__(self, set_ids: np.ndarray) -> np.ndarray:
        if len(self.seen) + len(set_ids) > REMEMBERED:
            self.seen = set()
        fresh = np.zeros(len(set_ids), bool)
        for i, x in enumerate(set_ids.tolist()):
            if x not in self.seen:
                self.seen.add(x)
                fresh[i] = True
        return fresh


def _often(held: list[np.ndarray]) -> pa.RecordBatch:
    token, count = np.unique(np.concatenate(held), return_counts=True)
    often = count >= FREQUENT_IN_WINDOW
    token, count = token[often].astype(np.int64), count[often].astype(np.int64)
    none = pa.array(np.zeros(len(token), np.int64))
    return pa.RecordBatch.from_arrays([
        pa.array(np.ones(len(token), np.int8)), pa.array(token), none, pa.array(count), none,
        pa.nulls(len(token), pa.list_(pa.int64()))], _DESCRIBED)


_DESCRIBED = ["kind", "doc_id", "digest", "n_shingles", "set_id", "bits"]


def _parities(sets) -> pa.Array:
    """Parity bitmap of each set of a chunk, as longs."""
    n = sets.last - sets.first
    with np.errstate(over="ignore"):
        cell = (mix(sets.token + _U(0xB175)) & _U(CELLS - 1)).astype(np.int64)
    odd = (np.bincount(sets.doc * CELLS + cell, minlength=n * CELLS) & 1).astype(np.uint8)
    words = np.packbits(odd.reshape(n, CELLS), axis=1).view(np.int64)
    offsets = pa.array(np.arange(n + 1, dtype=np.int32) * words.shape[1])
    return pa.ListArray.from_arrays(offsets, pa.array(words.ravel()))


def _describe(batches):
    """Per document its size and set id; per window of different sets its frequent tokens, as kind 1."""
    make_room()
    fresh, held, n_held = _Fresh(), [], 0
    for batch in batches:
        ids, digests = batch.column(0), batch.column(2)
        for sets in token_sets(batch.column(1)):
            n = sets.last - sets.first
            empty = pa.array(sets.size == 0)
            yield pa.RecordBatch.from_arrays([
                pa.array(np.zeros(n, np.int8)), ids.slice(sets.first, n), digests.slice(sets.first, n), pa.array(sets.size),
                pa.compute.if_else(empty, pa.scalar(None, pa.int64()), pa.array(sets.set_id)), _parities(sets),
            ], _DESCRIBED)
            held.append(sets.token[fresh(sets.set_id)[sets.doc]])
            n_held += len(held[-1])
            if n_held >= WINDOW_TOKENS:
                yield _often(held)
                held, n_held = [], 0
    if n_held:
        yield _often(held)


def _packed(bucket: int, signature: np.ndarray, set_id: np.ndarray) -> pa.RecordBatch:
    """One block: byte planes of the sorted signatures, and places in a list of ids."""
    known, place = np.unique(set_id, return_inverse=True)
    planes = np.ascontiguousarray(signature.view(np.uint8).reshape(-1, 8).T)
    return pa.RecordBatch.from_arrays([
        pa.array([bucket], pa.int32()), pa.array([planes.tobytes()], pa.binary()),
        pa.array([known.tobytes()], pa.binary()),
        pa.array([place.astype(np.uint32).view(np.uint8).reshape(-1, 4).T.tobytes()], pa.binary()),
    ], ["bucket", "signatures", "ids", "places"])


def _pack(signature: np.ndarray, set_id: np.ndarray, buckets: int) -> Iterator[pa.RecordBatch]:
    """Blocks of one bucket each. Those of hot signatures have numbers from ``buckets`` on; a signature without a role marks them."""
    order = np.lexsort((set_id, signature))
    signature, set_id = signature[order], set_id[order]
    group = signature >> _U(ROLE_BITS)
    starts = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]]))
    count = np.diff(np.concatenate([starts, [len(group)]]))
    hot = np.repeat(count >= HOT, count)
    if hot.any():
        with np.errstate(over="ignore"):
            dealt = mix(np.array([set_id.sum()]).view(_U))[0]
        yield _packed(buckets + int(dealt % _U(buckets)), signature[hot], set_id[hot])
        marks = starts[count >= HOT]
        signature[marks] = group[marks] << _U(ROLE_BITS)
        hot[marks] = False
        signature, set_id = signature[~hot], set_id[~hot]
    key = ((signature >> _U(32)) * _U(buckets)) >> _U(32)
    cuts = np.searchsorted(key, np.arange(buckets + 1, dtype=_U))
    for bucket in np.flatnonzero(np.diff(cuts)):
        low, high = cuts[bucket], cuts[bucket + 1]
        yield _packed(bucket, signature[low:high], set_id[low:high])


def _unpack(signatures: bytes, ids: bytes, places: bytes) -> tuple[np.ndarray, np.ndarray]:
    signature = np.ascontiguousarray(np.frombuffer(signatures, np.uint8).reshape(8, -1).T).view(_U).ravel()
    place = np.ascontiguousarray(np.frombuffer(places, np.uint8).reshape(4, -1).T).view(np.uint32).ravel()
    return signature, np.frombuffer(ids, np.int64)[place]


def _sender(buckets: int, frequent: np.ndarray):
    def send(batches):
        make_room()
        hot = np.zeros(_HOT_SLOTS, bool)
        hot[frequent & (_HOT_SLOTS - 1)] = True
        fresh, held, rows = _Fresh(), [], 0
        for batch in batches:
            for sets in token_sets(batch.column(0)):
                new = fresh(sets.set_id) & (sets.size > 0)
                if not new.any():
                    continue
                kept = new[sets.doc]
                units = signatures(sets.doc[kept], sets.token[kept], np.where(new, sets.size, 0), hot)
                held.append((units.signature, sets.set_id[units.doc]))
                rows += len(units.signature)
                if rows >= BLOCK_ROWS:
                    yield from _pack(*map(np.concatenate, zip(*held)), buckets)
                    held, rows = [], 0
        if rows:
            yield from _pack(*map(np.concatenate, zip(*held)), buckets)
        held = []
        release()

    return send


_FOUND = ["kind", "a", "b", "role"]


def _batch(kind: int, a: np.ndarray, b: np.ndarray, role: np.ndarray | None = None) -> pa.Table:
    role = np.zeros(len(a), np.int8) if role is None else role.astype(np.int8)
    return pa.table([pa.array(np.full(len(a), kind, np.int8)), pa.array(a), pa.array(b), pa.array(role)], _FOUND)


def _hot_members(key: np.ndarray, set_id: np.ndarray, role: np.ndarray) -> pa.Table:
    return _batch(2, (key << _U(ROLE_BITS)).view(np.int64), set_id, role)


def _useful(roles):
    """Whether sets with these roles together, of one signature, are candidates; for arrays and for columns."""
    def has(role):
        return (roles.bitwiseAND(role) if isinstance(roles, Column) else roles & role) > 0

    return (has(INDEXED) & has(PROBE | PROBE_CUT)) | (has(INDEXED_CUT) & has(PROBE_TWO))


def _meet(block: pa.Table, buckets: int) -> pa.Table:
    """Candidate pairs (kind 0) of a bucket, the lists of its large groups (kind 1: list id, set id), members of hot
    signatures (kind 2: list id, set id, role)."""
    hot_block = block.column("bucket")[0].as_py() >= buckets
    columns = (block.column(n) for n in ("signatures", "ids", "places"))
    parts = [_unpack(*(x.as_py() for x in row)) for row in zip(*columns)]
    signature, set_id = (np.concatenate(x) for x in zip(*parts))
    del parts
    order = np.argsort(signature, kind="stable")
    signature, set_id = signature[order], set_id[order]
    key = signature >> _U(ROLE_BITS)
    shared = np.zeros(len(key), bool)
    equal = key[1:] == key[:-1]
    shared[1:] |= equal
    shared[:-1] |= equal
    signature, set_id, key = signature[shared], set_id[shared], key[shared]
    if not len(key):
        return _batch(0, np.zeros(0, np.int64), np.zeros(0, np.int64))
    order = np.lexsort((set_id, key))
    key, set_id = key[order], set_id[order]
    role = (signature[order] & _U((1 << ROLE_BITS) - 1)).astype(np.int64)
    marked = np.unique(key[role == 0])
    new = np.concatenate([[True], (key[1:] != key[:-1]) | (set_id[1:] != set_id[:-1])])
    role = np.bitwise_or.reduceat(role, np.flatnonzero(new))
    key, set_id = key[new], set_id[new]
    if hot_block:
        return _hot_members(key, set_id, role)
    starts = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    roles = np.bitwise_or.reduceat(role, starts)
    size = np.diff(np.concatenate([starts, [len(key)]]))
    group = np.repeat(np.arange(len(starts)), size)
    hot = np.isin(key[starts], marked)
    added = hot[group] & (role > 0)
    hot_members = _hot_members(key[added], set_id[added], role[added])
    useful = _useful(roles) & ~hot
    kept = (useful & (size > 1))[group]
    group, set_id, role = group[kept], set_id[kept], role[kept]
    pairs = []
    few = size[group] <= SMALL
    for step in range(1, SMALL):
        at = np.flatnonzero(few[:-step] & (group[step:] == group[:-step]))
        pairs.append((set_id[at], set_id[at + step]))
    a, b = (np.concatenate(x) for x in zip(*pairs))
    a, b = np.minimum(a, b), np.maximum(a, b)
    order = np.lexsort((b, a))
    a, b = a[order], b[order]
    new = np.ones(len(a), bool)
    new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
    with np.errstate(over="ignore"):
        lists = np.zeros(len(starts), _U)
        np.add.at(lists, group, mix(set_id.view(_U)))
    many = ~few
    listed, first = np.unique(lists[group[many]], return_index=True)
    chosen = np.isin(group, group[many][first])
    return pa.concat_tables([
        _batch(0, a[new], b[new]),
        _batch(1, lists[group[chosen]].view(np.int64), set_id[chosen]),
        hot_members,
    ])


def _meeter(buckets: int):
    def meet(block: pa.Table) -> pa.Table:
        make_room()
        found = _meet(block, buckets)
        release()
        return found

    return meet


def _sets(batches):
    make_room()
    for batch in batches:
        wanted = batch.column(0).to_numpy(zero_copy_only=False)
        for sets in token_sets(batch.column(1)):
            ok = np.flatnonzero(sets.set_id == wanted[sets.first:sets.last])
            if not len(ok):
                continue
            kept = np.isin(sets.doc, ok)
            ends = np.cumsum(sets.size[ok])
            offsets = np.concatenate([[0], ends]).astype(np.int32)
            tokens = pa.array(sets.token[kept].astype(np.int64))
            yield pa.RecordBatch.from_arrays(
                [pa.array(sets.set_id[ok]), pa.ListArray.from_arrays(pa.array(offsets), tokens)],
                ["set_id", "tokens"])


def _sets_of(docs: DataFrame, classes: DataFrame, pairs: DataFrame) -> DataFrame:
    """(set_id, tokens) of every class in a pair, read again from one document of each."""
    wanted = pairs.select(F.explode(F.array("a", "b")).alias("set_id")).distinct()
    wanted = written_once(
        wanted.join(classes, "set_id").select(
            "set_id", F.col("first.doc_id").alias("_first"), F.col("first.digest").alias("_digest")), "wanted")
    # Three longs a row: broadcast up to 32 MB, else shuffled. The id keeps most copies of a text out, the digest tells rows
    # of one id, or of none, apart.
    side = F.broadcast(wanted) if wanted.count() <= 1 << 20 else wanted
    found = docs.select("doc_id", "text", "digest").join(
        side, F.col("doc_id").eqNullSafe(F.col("_first")) & (F.col("digest") == F.col("_digest")))
    read = found.select("set_id", "text").mapInArrow(_sets, "set_id bigint, tokens array<bigint>")
    return written_once(read.dropDuplicates(["set_id"]), "sets")


def _linked(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs whose sets link, as (u, v)."""
    left = sets.select(F.col("set_id").alias("a"), F.col("tokens").alias("ta"))
    right = sets.select(F.col("set_id").alias("b"), F.col("tokens").alias("tb"))
    na, nb = F.size("ta").cast("bigint"), F.size("tb").cast("bigint")
    common = F.size(F.array_intersect("ta", "tb")).cast("bigint")
    near = common * 100 >= (na + nb - common) * PERCENT
    return pairs.join(right, "b").join(left, "a").filter(near).select(
        F.col("a").alias("u"), F.col("b").alias("v"))


def _bounded(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """The pairs that sizes and bitmaps do not rule out."""
    described = classes.select("set_id", "size", "bits")
    both = pairs.join(described.toDF("a", "na", "bits_a"), "a").join(described.toDF("b", "nb", "bits_b"), "b")
    unlike = F.aggregate(
        F.zip_with("bits_a", "bits_b", lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda s, x: s + x)
    size = F.least("na", "nb") * 100 >= F.greatest("na", "nb") * PERCENT
    return both.filter(size).filter(unlike * 9 <= F.col("na") + F.col("nb")).select("a", "b")


def _beside(members: DataFrame, of_list: DataFrame) -> DataFrame:
    """The row of ``of_list`` beside each of its list's members; a hot list meets it in parts."""
    part = F.when(F.col("hot"), F.pmod(F.xxhash64("set_id"), F.lit(PARTS))).otherwise(0).cast("int")
    every = F.when(F.col("hot"), F.sequence(F.lit(0), F.lit(PARTS - 1))).otherwise(F.array(F.lit(0)))
    copies = of_list.withColumn("_part", F.explode(every))
    return members.withColumn("_part", part).join(copies, ["list", "hot", "_part"]).drop("_part")


def _hot_lists(met: DataFrame) -> DataFrame:
    """Lists of hot signatures that hold candidates; of lists with the same members, one."""
    members = met.filter("kind = 2").groupBy(F.col("a").alias("list"), F.col("b").alias("set_id")).agg(
        F.bit_or("role").alias("role"))
    members = written_once(members.withColumn("hot", F.lit(True)), "hot")
    contents = members.groupBy("list", "hot").agg(
        F.bit_or("role").cast("int").alias("roles"), F.count("*").alias("n"),
        F.bit_xor(F.xxhash64("set_id")).alias("one"), F.bit_xor(F.xxhash64("set_id", F.lit(1))).alias("two"))
    first = contents.filter(_useful(F.col("roles"))).groupBy("hot", "n", "one", "two").agg(F.min("list").alias("list"))
    return _beside(members, first.select("list", "hot")).select("list", "set_id", "hot")


def _star_pairs(lists: DataFrame) -> DataFrame:
    """Each list's members with its hub, the member of most lists."""
    central = lists.groupBy("set_id").agg(F.count("*").alias("lists"))
    hubs = lists.join(central, "set_id").groupBy("list", "hot").agg(F.max(F.struct("lists", "set_id")).alias("hub"))
    star = _beside(lists, hubs.select("list", "hot", F.col("hub.set_id").alias("hub"))).filter("set_id <> hub")
    return star.select(F.least("set_id", "hub").alias("a"), F.greatest("set_id", "hub").alias("b"))


def _cross(table: pa.Table) -> pa.Table:
    """Pairs of a block and a slice in different components that sizes and bitmaps do not rule out."""
    make_room()
    asks = table.column("_asks").to_numpy()
    ids, root, size = (table.column(n).to_numpy() for n in ("id", "root", "size"))
    bits = np.concatenate([c.flatten().to_numpy() for c in table.column("bits").chunks]).reshape(len(ids), -1)
    a, b = [], []
    answers = np.flatnonzero(~asks)
    for i in np.flatnonzero(asks):
        j = answers[root[answers] != root[i]]
        j = j[np.minimum(size[j], size[i]) * 100 >= np.maximum(size[j], size[i]) * PERCENT]
        unlike = np.bitwise_count((bits[j] ^ bits[i]).view(_U)).sum(1, dtype=np.int64)
        j = j[unlike * 9 <= size[j] + size[i]]
        a.append(np.minimum(ids[j], ids[i]))
        b.append(np.maximum(ids[j], ids[i]))
    a, b = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (a, b))
    return pa.table([pa.array(a), pa.array(b)], ["a", "b"])


def _open_pairs(lists: DataFrame, roots: DataFrame, classes: DataFrame) -> DataFrame:
    """Pairs of a list whose members are in different components and may link."""
    placed = lists.join(roots.withColumnRenamed("node", "set_id"), "set_id", "left").select(
        "list", "hot", "set_id", F.coalesce("root", "set_id").alias("root"))
    # The component with most members of a list; only its pairs with the others are left, and those of the others.
    shares = placed.groupBy("list", "hot", "root").agg(F.count("*").alias("n"))
    leading = shares.groupBy("list", "hot").agg(F.max(F.struct("n", "root")).alias("most"), F.sum("n").alias("n")).filter("n > most.n")
    placed = _beside(placed, leading.select(
        "list", "hot", F.col("most.root").alias("leading"),
        parts(F.col("n") - F.col("most.n"), LIST_BLOCK).alias("_blocks"), parts(F.col("n"), LIST_BLOCK).alias("_slices")))
    placed = placed.join(classes.select("set_id", "size", "bits"), "set_id").withColumnRenamed("set_id", "id")
    spread = dealt(placed, "root <> leading")
    return spread.select("list", "_block", "_slice", "_asks", "id", "root", "size", "bits").groupBy(
        "list", "_block", "_slice").applyInArrow(_cross, "a bigint, b bigint").distinct()


class Joined(NamedTuple):
    documents: DataFrame  # doc_id, n_shingles, set_id
    links: DataFrame  # u, v: set ids; enough verified links to connect all that link


def jaccard_links(documents: DataFrame) -> Joined:
    """Describe each (doc_id, text) and verify links between its classes of equal sets.

    ``links`` connects exactly what the full set of links connects; links inside a large
    group that is already connected are left out.
    """
    spark = documents.sparkSession
    text = F.col("text").cast("string")
    docs = documents.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("digest"))
    described = written_once(docs.mapInArrow(
        _describe, "kind tinyint, doc_id bigint, digest bigint, n_shingles bigint, set_id bigint, bits array<bigint>"), "described")
    info = described.filter("kind = 0").drop("kind")
    # One row's id and text stand for a class.
    classes = written_once(
        info.filter("set_id IS NOT NULL").groupBy("set_id").agg(
            F.min(F.struct(F.isnull("doc_id").alias("unnamed"), "doc_id", "digest")).alias("first"),
            F.max("n_shingles").alias("size"), F.max("bits").alias("bits")), "classes")
    tokens = described.filter("kind = 1").groupBy("doc_id").agg(F.sum("n_shingles").alias("n"))
    tokens = tokens.orderBy(F.desc("n"), "doc_id").limit(FREQUENT)
    frequent = np.array([row[0] for row in tokens.select("doc_id").collect()], np.int64)
    n_tokens = info.agg(F.sum("n_shingles")).first()[0] or 0
    at_least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    buckets = max(4 * at_least, n_tokens // 2 // BUCKET_ROWS + 1)
    packed = docs.select("text").mapInArrow(
        _sender(buckets, frequent), "bucket int, signatures binary, ids binary, places binary")
    met = written_once(
        packed.groupBy("bucket").applyInArrow(_meeter(buckets), "kind tinyint, a bigint, b bigint, role tinyint"), "met")
    lists = met.filter("kind = 1").select(F.col("a").alias("list"), F.col("b").alias("set_id"), F.lit(False).alias("hot"))
    lists = written_once(lists.distinct().unionByName(_hot_lists(met)), "lists")
    pairs = met.filter("kind = 0").select("a", "b").unionByName(_star_pairs(lists)).distinct()
    pairs = written_once(_bounded(pairs, classes), "pairs")
    sets = _sets_of(docs, classes, pairs)
    links = written_once(_linked(pairs, sets), "linked")
    more = _open_pairs(lists, components(links), classes).join(pairs, ["a", "b"], "left_anti")
    more = written_once(more, "open")
    if not more.isEmpty():
        links = links.unionByName(_linked(more, _sets_of(docs, classes, more)))
    return Joined(info, links)


def near_duplicates(documents: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, component_id) for each row of (doc_id, text).

    ``component_id`` is the smallest doc_id reachable by links. A text without shingles
    is its own component.
    """
    joined = jaccard_links(documents)
    info = joined.documents
    classes = info.filter("set_id IS NOT NULL").groupBy("set_id").agg(F.min("doc_id").alias("first_id"))
    roots = components(joined.links).withColumnRenamed("node", "set_id")
    placed = classes.join(roots, "set_id", "left").select(
        "set_id", "first_id", F.coalesce("root", "set_id").alias("root"))
    named = placed.groupBy("root").agg(F.min("first_id").alias("component_id"))
    of_set = written_once(placed.join(named, "root").select("set_id", "component_id"), "of-set")
    return info.join(of_set, "set_id", "left").select(
        "doc_id", "n_shingles",
        F.when(F.col("set_id").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
    )
