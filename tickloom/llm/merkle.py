"""Merkle manifest of a dataset: a tree over each group of rows, a tree over the groups' roots, a proof for each row.

A row's leaf is the digest of its fields, each written as its byte count, a colon and its value, or ``-`` if it is null.
A group's leaves are in order of the given columns; every two consecutive nodes of a level become the digest of both, a
last one without a partner the digest of itself, until one node remains. The groups' roots, in
order of the group (null first, then by UTF-8 bytes), become the dataset's root in the same way.

Method: nodes are numbered within their group and fall into aligned blocks of 256. A block keeps each level as one string of
hex digits, 64 to a node (as binary, so that a substring costs what it copies). Substrings of 128 digits are hashed to the
next level; the 64 digits beside a node are its sibling there, and those of all levels make its segment of the proof. The
blocks' roots are the nodes of the next round, whose blocks are 256 times fewer, and their segments come back
down by a join on the block. All of it is SQL expressions.

At scale: rows are digested once, in the scan, and only digests and kept columns move on. Numbering is a range
partitioning (a tail column splits rows that are equal in all else) and a sum over partitions, so no task holds a group; blocks
have 256 nodes, whatever their group's size. The driver sees the size of the largest group and the root.

Cases: null fields, also null groups and null order columns (first), take part; rows of one place in the order follow
their digests, so the result does not depend on row order; repeated rows are leaves of their own; a group of one row is its own
root, with no sibling; empty texts count 0 bytes; long texts are digested whole; an empty table gives an empty result; kept
columns may have any names.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tickloom.sources.shared import written_once

BITS = 8
BLOCK = 1 << BITS
#: Row number within a partition, as ``monotonically_increasing_id`` lays it out.
_ROW_BITS = 33

#: Numbers of a block's levels.
_STEPS = f"array({', '.join(map(str, range(BITS)))})"
_PARENTS = """cast(array_join(transform(sequence(0, cast((length(element_at(ls, -1)) - 1) div 128 as int)),
  i -> sha2(substring(element_at(ls, -1), 128 * i + 1, 128), 256)), '') as binary)"""
#: From the leaves' string and the depth: the strings of all levels.
_LEVELS = f"aggregate(slice({_STEPS}, 1, depth), array(leaves), (ls, s) -> concat(ls, array({_PARENTS})))"
#: From the levels and a member's place: its sibling on each level, empty where it has none.
_SEGMENT = f"""transform(slice({_STEPS}, 1, size(levels) - 1), s ->
  cast(substring(levels[s], 64 * (shiftright(cast(m.pos % {BLOCK} as int), s) ^ 1) + 1, 64) as string))"""


def leaf_digest(*fields: Column) -> Column:
    """Digest of a row's fields."""
    def part(field: Column) -> Column:
        text = field.cast("string")
        return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))

    return F.sha2(F.concat(*map(part, fields)), 256)


def fold(node: Column, pos: Column, proof: Column) -> Column:
    """The root that a node at a place of its tree gives with its siblings, from the lowest level up."""
    def step(below: Column, level: Column) -> Column:
        sibling = F.get(proof, level)
        right = F.call_function("shiftright", pos, level).bitwiseAND(F.lit(1)) == 1
        return F.sha2(F.when(right, F.concat(sibling, below)).otherwise(F.concat(below, sibling)), 256)

    levels = F.filter(F.sequence(F.lit(0), F.size(proof)), lambda i: i < F.size(proof))
    return F.aggregate(levels, node, step)


def _numbered(nodes: DataFrame, order: Sequence[str]) -> DataFrame:
    """Adds ``pos``, a node's place in its tree from 0, and ``n``, the tree's nodes. Places follow ``order``."""
    dealt = nodes.withColumn("tail", F.monotonically_increasing_id())
    dealt = dealt.repartitionByRange("tree", *order, "node", "tail").sortWithinPartitions("tree", *order, "node")
    dealt = dealt.select("*", F.monotonically_increasing_id().alias("at")).drop("tail")
    part = F.shiftright("at", _ROW_BITS)
    dealt = written_once(dealt.withColumn("part", part), "ordered")
    runs = dealt.groupBy("tree", "part").agg(F.min("at").alias("first"), F.count("*").alias("rows"))
    # A row for each partition of a tree.
    before = "coalesce(sum(rows) over (partition by tree order by part rows between unbounded preceding and 1 preceding), 0)"
    runs = written_once(runs.select(
        "tree", "part", F.expr(f"{before} - first").alias("shift"),
        F.expr("sum(rows) over (partition by tree)").alias("n")), "runs")
    return dealt.join(runs, ["tree", "part"]).withColumn("pos", F.col("at") + F.col("shift")).drop(
        "at", "part", "shift", *order)


def _blocks(nodes: DataFrame, kept: Sequence[str]) -> DataFrame:
    """Nodes gathered in aligned blocks, with the strings of all levels of each block."""
    member = F.struct("pos", "node", *kept)
    found = nodes.groupBy("tree", F.floor(F.col("pos") / BLOCK).alias("block")).agg(
        F.first("n").alias("n"), F.sort_array(F.collect_list(member)).alias("members"))
    # A block below others has all levels; the only block of a tree ends at the root.
    depth = F.when(F.col("n") > BLOCK, BITS).otherwise(F.expr(f"size(filter({_STEPS}, s -> shiftleft(1, s) < n))"))
    found = found.withColumn("depth", depth).withColumn(
        "leaves", F.expr("cast(array_join(transform(members, m -> m.node), '') as binary)"))
    return found.withColumn("levels", F.expr(_LEVELS)).drop("leaves", "depth")


def _forest(nodes: DataFrame, kept: Sequence[str] = ()) -> tuple[DataFrame, DataFrame]:
    """Roots (tree, root) and members (tree, pos, node, kept, proof) of the trees of numbered nodes (tree, pos, n, node)."""
    most = nodes.agg(F.max("n")).first()[0] or 0
    rounds, roots = [], None
    top = F.element_at("levels", -1).cast("string")
    while True:
        blocks = written_once(_blocks(nodes, () if rounds else kept), "blocks")
        rounds.append(blocks)
        ended = blocks.filter(F.col("n") <= BLOCK).select("tree", top.alias("root"))
        roots = ended if roots is None else roots.unionByName(ended)
        if most <= BLOCK:
            break
        most = -(-most // BLOCK)
        nodes = blocks.filter(F.col("n") > BLOCK).select(
            "tree", F.col("block").alias("pos"), F.ceil(F.col("n") / BLOCK).alias("n"), top.alias("node"))
    rest = None
    for blocks in reversed(rounds):
        lowest = blocks is rounds[0]
        fields = "".join(f", '{name}', m.{name}" for name in (kept if lowest else ()))
        placed = f"transform(members, m -> named_struct('pos', m.pos, 'node', m.node{fields}, 'segment', {_SEGMENT}))"
        if rest is None:
            blocks = blocks.withColumn("rest", F.array().cast("array<string>"))
        else:
            blocks = blocks.join(rest, ["tree", "block"], "left")
        members = blocks.select("tree", "rest", F.expr(placed).alias("placed")).select("tree", "rest", F.inline("placed"))
        # The only block of a smaller tree has nothing above.
        proof = F.when(F.col("rest").isNull(), F.col("segment")).otherwise(F.concat("segment", "rest"))
        members = members.withColumn("proof", proof).drop("rest", "segment")
        rest = members.select("tree", F.col("pos").alias("block"), F.col("proof").alias("rest"))
    return roots, members


def manifest(
    rows: DataFrame, fields: Sequence[Column], *, group: Column, order: Sequence[Column], keep: Sequence[Column]
) -> DataFrame:
    """``keep``, leaf, subroot, root, and each row's place and siblings: pos, proof in its group, group_pos, group_proof in the dataset."""
    kept = F.struct(*keep)
    ordered = [f"by{i}" for i in range(len(order))]
    # A prefix puts null before each group, the empty one included.
    tree = F.coalesce(F.concat(F.lit("="), group.cast("string")), F.lit("-"))
    leaves = written_once(rows.select(
        tree.alias("tree"), *(c.alias(n) for c, n in zip(order, ordered)), leaf_digest(*fields).alias("node"),
        kept.alias("row")), "leaves")
    subroots, members = _forest(_numbered(leaves, ordered), ("row",))
    groups = written_once(subroots, "subroots").select(
        F.lit("").alias("tree"), F.col("tree").alias("by"), F.col("root").alias("node"), F.struct("tree").alias("row"))
    roots, groups = _forest(_numbered(groups, ["by"]), ("row",))
    groups = written_once(groups.select(
        F.col("row.tree").alias("tree"), F.col("node").alias("subroot"), F.col("pos").alias("group_pos"),
        F.col("proof").alias("group_proof")), "groups")
    root = roots.first()
    return members.join(groups, "tree").select(
        "row.*", F.col("node").alias("leaf"), "subroot", F.lit(root.root if root else None).cast("string").alias("root"),
        "pos", "proof", "group_pos", "group_proof")
