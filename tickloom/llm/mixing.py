"""Mixing sources to target weights along a time-varying curriculum.

Sources in code point order, null last, weigh 1, 2, 3, repeating. Together they get as many
words as all documents have, by weight; a target stops at ``MOST`` times its source's
words, and what is cut off is shared again by weight until no target is above.

Each source's weight changes linearly over training time 0 to 1: it starts at ``ramp``
times its mean and ends at ``2 - ramp`` times. The integral up to t, scaled to the target, is the
source's cumulative demand; documents queue in an order fixed by a hash of id and size, again and again
until the target is reached, and each pass of a document gets the time at which demand
reaches its place in the queue. Sorting by that time gives the training order.

Whole passes go to every document of a source, and one more to the head of its
queue; the document at the cut gives only its first words. So a source's taken words are
its target to the nearest word. ``with_whole_cuts`` takes or leaves that document as a whole instead.

The queue is summed in ``SLICES`` hash slices of each source, then within each slice, so a
source with most of the rows is spread over as many tasks. Nothing but a few totals
reaches the driver.

Cases: a null text has no words, a document without words takes none and has no place in the order;
null ids queue like others; rows of one id and size queue by a digest of their text, then of their kept columns, so the rows
returned do not depend on the order of the input; sources without words have target 0; an empty table gives an empty result; columns named like
the result's are kept apart in a struct.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tickloom.sources.shared import written_once

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (1, 2, 3)
MOST = 3
#: Starting factor of a source's weight, by the place of its weight in WEIGHTS.
RAMPS = (1.5, 1.0, 0.5)
SLICES = 4096
_SHIFT = 32 - 12


def words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def ranked(values: DataFrame, name: str) -> DataFrame:
    """Add ``rank`` from 0 to a table of distinct values, nulls last, without gathering it in one task."""
    dealt = values.repartitionByRange(F.col(name).asc_nulls_last()).withColumn("_part", F.spark_partition_id())
    dealt = written_once(dealt, "ranked")
    # One row for each partition, so the window over them is as small as the plan.
    counts = dealt.groupBy("_part").agg(F.count("*").alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    own = Window.partitionBy("_part").orderBy(F.col(name).asc_nulls_last())
    return dealt.join(F.broadcast(offsets), "_part").withColumn(
        "rank", F.col("_before") + F.row_number().over(own) - 1).drop("_part", "_before")


def _by_place(values: tuple, place: Column) -> Column:
    return F.element_at(F.array(*map(F.lit, values)), (place % len(values) + 1).cast("int"))


def targets(sizes: DataFrame) -> DataFrame:
    """(source, source_size) to those plus weight, ramp and target.

    Each round caps the sources above ``MOST`` times their size and shares the rest again; it ends
    when no further source is above.
    """
    sources = written_once(
        ranked(sizes, "source").select(
            "source", "source_size", _by_place(WEIGHTS, F.col("rank")).alias("weight"),
            _by_place(RAMPS, F.col("rank")).alias("ramp")), "sources")
    exact = "decimal(38)"
    total = sources.agg(F.sum("source_size").cast(exact)).first()[0] or 0
    # Rest of the words and of the weights once capped sources are taken out.
    rest, weights, capped = total, sources.agg(F.sum("weight")).first()[0] or 1, F.lit(False)
    while True:
        above = F.col("source_size").cast("decimal(20)") * MOST * F.lit(int(weights)).cast("decimal(12)") < (
            F.lit(str(rest)).cast("decimal(24)") * F.col("weight"))
        found = sources.agg(
            F.sum(F.when(above, F.col("source_size") * MOST).otherwise(0)).cast(exact),
            F.sum(F.when(above, 0).otherwise(F.col("weight")))).first()
        capped = above
        now = (total - (found[0] or 0), found[1] or 1)
        if now == (rest, weights):
            break
        rest, weights = now
    # A literal under 2^31 would be an int, and its product with the weight too.
    left = F.lit(int(rest)).cast("bigint") if rest * max(WEIGHTS) < 2**63 else F.lit(float(rest))
    shared = left * F.col("weight") / F.lit(int(weights))
    return sources.withColumn(
        "target", F.when(capped, F.col("source_size") * MOST).otherwise(shared).cast("double"))


def time_of(place: Column, goal: Column, ramp: Column) -> Column:
    """Training time at which a source's cumulative demand reaches ``place`` of its ``goal`` words."""
    x = place / goal
    return 2 * x / (ramp + F.sqrt(ramp * ramp + 4 * (1 - ramp) * x))


def mix(documents: DataFrame, *, keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per document of (doc_id, source, text): what the mix takes of it.

    doc_id, source, size, source_size, target, taken (words, repeats counted), whole (passes over all of
    it), part (words of one more pass), times (of each pass), and ``kept``, a struct of the columns in ``keep``.
    """
    size = words(F.col("text"))
    # A struct has a field at least.
    kept = F.struct(*[F.col(n) for n in keep] or [F.lit(0).alias("none")])
    sized = documents.select(
        "doc_id", "source", size.alias("size"), F.md5(F.coalesce("text", F.lit(""))).alias("_digest"), kept.alias("kept"))
    text = F.concat_ws(":", F.col("doc_id").cast("string"), F.col("size").cast("string"))
    order = F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint")
    queued = sized.withColumn("_order", order).withColumn("_slice", F.shiftright("_order", _SHIFT).cast("int"))
    slices = written_once(
        queued.groupBy("source", "_slice").agg(F.sum("size").alias("_words")), "slices")
    found = targets(slices.groupBy("source").agg(F.sum("_words").alias("source_size")))
    # At most SLICES rows of a source.
    before = Window.partitionBy("source").orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    placed = slices.select(
        "source", "_slice", F.coalesce(F.sum("_words").over(before), F.lit(0)).alias("_before"))
    plan = placed.alias("p").join(found.alias("t"), F.col("p.source").eqNullSafe(F.col("t.source"))).select(
        F.col("p.source").alias("_source"), F.col("_slice").alias("_of"), "_before", "source_size", "target", "ramp")
    plan = written_once(plan, "plan")
    within = Window.partitionBy("source", "_slice").orderBy(
        "_order", "doc_id", "size", "_digest", F.xxhash64("kept")).rowsBetween(
        Window.unboundedPreceding, -1)
    ran = queued.withColumn("_within", F.coalesce(F.sum("size").over(within), F.lit(0)))
    rows = ran.join(plan, F.col("source").eqNullSafe(F.col("_source")) & (F.col("_slice") == F.col("_of")))
    goal = F.floor(F.col("target") + 0.5)
    rows = rows.withColumn("_goal", goal).withColumn("_place", F.col("_before") + F.col("_within"))
    whole = F.when(F.col("source_size") > 0, F.expr("_goal div source_size")).otherwise(F.lit(0))
    rows = rows.withColumn("whole", whole)
    extra = F.col("_goal") - F.col("whole") * F.col("source_size")
    rows = rows.withColumn("part", F.least(F.greatest(extra - F.col("_place"), F.lit(0)), F.col("size")))
    passes = F.when(F.col("size") > 0, F.col("whole") + (F.col("part") > 0).cast("bigint")).otherwise(F.lit(0))
    times = F.transform(
        F.when(passes > 0, F.sequence(F.lit(0), (passes - 1).cast("int"))).otherwise(F.array().cast("array<int>")),
        lambda n: time_of(n * F.col("source_size") + F.col("_place"), F.col("_goal"), F.col("ramp").cast("double")))
    return rows.select(
        "doc_id", "source", "size", "source_size", "target",
        (F.col("whole") * F.col("size") + F.col("part")).alias("taken"), "whole", "part",
        times.alias("times"), "kept")


def with_whole_cuts(mixed: DataFrame) -> DataFrame:
    """The document at a source's cut is taken whole if that is nearer to the target, else left.

    Only a document that is longer than its source's whole target still gives its first words.
    """
    goal = F.floor(F.col("target") + 0.5)
    cut = (F.col("part") > 0) & (F.col("part") < F.col("size")) & (F.col("size") <= goal)
    part = F.when(cut, F.when(F.col("part") * 2 >= F.col("size"), F.col("size")).otherwise(0)).otherwise(F.col("part"))
    passes = (F.size("times") - (cut & (part == 0)).cast("int"))
    return mixed.withColumns({
        "taken": F.col("whole") * F.col("size") + part, "part": part,
        "times": F.slice("times", F.lit(1), passes)})


def in_training_order(mixed: DataFrame) -> DataFrame:
    """One row per pass over a document, sorted by time: its words and, in ``kept``, its columns."""
    passes = mixed.select("*", F.posexplode("times").alias("number", "time"))
    taken = F.when(F.col("number") < F.col("whole"), F.col("size")).otherwise(F.col("part"))
    return passes.select(
        "doc_id", "size", "number", "time", taken.alias("words"), "kept").orderBy("time", "doc_id", "number")


def first_words(text: Column, n: Column) -> Column:
    """The text up to the end of its n-th word."""
    pieces = F.regexp_extract_all(text, F.lit(r"[\x20\x09-\x0D]*" + WORD), F.lit(0))
    return F.array_join(F.slice(pieces, F.lit(1), n.cast("int")), "")
