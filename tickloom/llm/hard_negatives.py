"""Hard negatives: for an anchor and each of its nearest rows of the same label, the nearest rows of other labels whose
scores lie in a band below.

Vectors become integers ``floor(scale * x)``; a score is the integer inner product with the anchor. Both searches, for
positives and for negatives, fill windows [floor, high] of scores with their k best rows by threshold joins.

Method: an anchor's threshold starts where a tail of the normal distribution, as wide as its norm and the rows' mean square say,
leaves a few times k rows. Windows that do not fill lower theirs, to sixteen times the rows in each round, down to their floor.
The estimate moves the cost only: a window is done when it is full or its threshold has reached its floor.

A join takes blocks of anchors and slices of rows. In a block the dimensions fall into small bands, those first that hold most
of the anchors' mass. A slice's rows are indexed by band, but a row is left out of all bands from the one on where the norm of
the rest of it, times that of any anchor, stays below the lowest threshold: those cannot carry a pair by themselves. Partial scores
are accumulated band by band; a pair goes when its score so far and the product of the remaining norms stay below its
threshold. When few pairs are left, they alone are accumulated, with what the index left out. Bounds are loosened by more
than their rounding, so results are exact, ties included.

At scale: anchors are a set share of all rows and meet all of them, in (block, slice) groups of bounded size. A slice sends at most k
rows of a window on. Rows fall into slices by number, not by id, label or vector, so no hot one matters.

Cases: rows with a null id, a null label, or a vector that is null, empty or holds null or non-finite components take no part; labels
are integers; rows that repeat an anchor's id count as itself; repeated rows are positives and negatives each; repeated anchors
count once; an anchor meets only vectors of its own length; an anchor without positives, or a positive with a negative score, gives
no rows; equal scores go to the smaller id; scores are exact while scaled components stay below 2^28 in size; an empty
table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from tickloom.llm.vectors import matrices, usable
from tickloom.sources.shared import written_once

SCALE = 256
POSITIVES, NEGATIVES = 5, 10
#: A negative's score, in percent of the positive's.
LOW, HIGH = 30, 90
BAND = 8
BLOCK_ANCHORS, SLICE_ROWS = 4096, 4096
#: Anchors of a block whose scores are accumulated together.
TOGETHER = 256
#: Pairs are accumulated one by one when this share is left.
SPARSE = 1 / 16
#: Rows a first threshold leaves, in windows' sizes, and the factor of a round.
FIRST, MORE = 4, 16
_ROOM = 1e-6
_LEAST, _MOST = np.iinfo(np.int64).min, np.iinfo(np.int64).max


def _rest_norms(v: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """Norm of each row from each band's start on; 0 after the last."""
    squares = np.add.reduceat(v * v, edges, axis=1)
    rest = np.cumsum(squares[:, ::-1], axis=1)[:, ::-1]
    return np.sqrt(np.concatenate([rest, np.zeros((len(v), 1))], 1))


def pairs_above(q: np.ndarray, x: np.ndarray, least: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row of q, row of x, score) of the pairs whose inner product reaches the threshold of q's row."""
    given_q, given_x = q, x
    by_mass = np.argsort(-(q * q).sum(0), kind="stable")
    q, x = q[:, by_mass], x[:, by_mass]
    edges = np.arange(0, q.shape[1], BAND)
    q_rest, x_rest = _rest_norms(q, edges), _rest_norms(x, edges)
    room = _ROOM * (1 + q_rest[:, 0].max() * x_rest[:, 0].max())
    wanted = least.astype(np.float64) - room
    # Bands that hold a row: its first ones, up to where no anchor's bound of the rest reaches the lowest threshold.
    held = (x_rest[:, :-1] * q_rest[:, :-1].max(0) >= wanted.min()).sum(1)
    order = np.argsort(-held, kind="stable")
    x, x_rest, held = x[order], x_rest[order], held[order]
    bands = [slice(a, a + BAND) for a in edges]
    score = np.zeros((len(q), len(x)))
    done = np.zeros(len(x), np.int64)
    each = np.arange(len(x))
    alive = q_rest[:, done] * x_rest[each, done] >= wanted[:, None]
    for g, band in enumerate(bands):
        n = int((held > g).sum())
        if not n or np.count_nonzero(alive) <= SPARSE * alive.size:
            break
        score[:, :n] += q[:, band] @ x[:n, band].T
        done[:n] = g + 1
        alive = score + q_rest[:, done] * x_rest[each, done] >= wanted[:, None]
    a, b = np.nonzero(alive)
    score, at = score[a, b], done[b]
    for g, band in enumerate(bands):
        due = np.flatnonzero(at <= g)
        if len(due):
            score[due] += np.einsum("ij,ij->i", q[a[due], band], x[b[due], band])
            at[due] = g + 1
            kept = score + q_rest[a, at] * x_rest[b, at] >= wanted[a]
            a, b, score, at = a[kept], b[kept], score[kept], at[kept]
    b = order[b]
    if q_rest[:, 0].max() * x_rest[:, 0].max() >= 2.0**52:
        score = (given_q[a].astype(np.int64) * given_x[b].astype(np.int64)).sum(1)
    score = score.astype(np.int64)
    kept = score >= least[a]
    return a[kept], b[kept], score[kept]


def _searcher(same: bool, k: int):
    """The k best rows of a slice for each window of a block's anchors."""

    def search(table: pa.Table) -> pa.Table:
        asks = table.column("asks").to_numpy()
        [(_, v)] = matrices(table.column("v"))
        ids, labels = table.column("id").to_numpy(), table.column("label").to_numpy()
        own, rows = np.flatnonzero(asks), np.flatnonzero(~asks)
        rows = rows[np.argsort(ids[rows], kind="stable")]
        anchors = table.column("anchor").to_numpy()[own]
        windows = table.column("windows").combine_chunks().take(pa.array(own))
        first = np.append(0, np.cumsum(pa.compute.list_value_length(windows).to_numpy(zero_copy_only=False))).astype(np.int64)
        w, low, high = (x.to_numpy(zero_copy_only=False) for x in windows.flatten().flatten())
        out = []
        least = np.minimum.reduceat(low, first[:-1]) if len(own) else low
        # Anchors of like thresholds together.
        norms = np.sqrt((v[own] * v[own]).sum(1))
        turn = np.argsort(least / np.maximum(norms, 1), kind="stable")
        for start in range(0, len(own) if len(rows) else 0, TOGETHER):
            some = turn[start:start + TOGETHER]
            a, b, score = pairs_above(v[own[some]], v[rows], least[some])
            a = some[a]
            fits = (ids[own[a]] != ids[rows[b]]) & ((labels[own[a]] == labels[rows[b]]) == same)
            a, b, score = a[fits], b[fits], score[fits]
            for j in range(int(np.diff(first)[some].max())):
                has = first[a] + j < first[a + 1]
                at = first[a[has]] + j
                inside = (score[has] >= low[at]) & (score[has] <= high[at])
                at, c, s = at[inside], b[has][inside], score[has][inside]
                # Rows are in order of id, so their places settle ties.
                order = np.lexsort((c, -s, at))
                at, c, s = at[order], c[order], s[order]
                kept = np.arange(len(at)) - np.searchsorted(at, at, "left") < k
                out.append((anchors[a[has][inside][order][kept]], w[at[kept]], ids[rows[c[kept]]], s[kept]))
        parts = [np.concatenate(x) for x in zip(*out)] if out else [np.zeros(0, np.int64)] * 4
        return pa.table([pa.array(x.astype(t)) for x, t in zip(parts, (np.int64, np.int32, np.int64, np.int64))],
                        ["anchor", "w", "id", "score"])

    return search


def _search(rows: DataFrame, anchors: DataFrame, asked: DataFrame, same: bool, k: int) -> DataFrame:
    """(anchor, w, id, score): the k best rows of each window, from ``low`` up, in each slice."""
    windows = asked.groupBy("anchor").agg(F.collect_list(F.struct("w", "low", "high")).alias("windows"))
    asking = anchors.join(windows, "anchor").withColumn("d", F.size("v"))

    def parts(frame: DataFrame, size: int, name: str) -> DataFrame:
        return frame.groupBy("d").agg(F.ceil(F.count("*") / F.lit(size)).cast("int").alias(name))

    answering = rows.withColumn("d", F.size("v"))
    both = parts(asking, BLOCK_ANCHORS, "blocks").join(parts(answering, SLICE_ROWS, "slices"), "d")
    both = written_once(both, "parts")

    def number(by: str, of: str) -> Column:
        return F.pmod(F.xxhash64(by), F.col(of)).cast("int")

    def every(of: str) -> Column:
        return F.explode(F.sequence(F.lit(0), F.col(of) - 1))

    columns = ("d", "block", "slice", "asks", "anchor", "id", "label", "v", "windows")
    asking = asking.join(both, "d").withColumn("block", number("anchor", "blocks")).withColumn("slice", every("slices"))
    answering = answering.join(both, "d").withColumn("slice", number("number", "slices")).withColumn("block", every("blocks"))
    answering = answering.withColumn("anchor", F.lit(0).cast("bigint")).withColumn(
        "windows", F.lit(None).cast(asking.schema["windows"].dataType))
    return asking.withColumn("asks", F.lit(True)).select(*columns).unionByName(
        answering.withColumn("asks", F.lit(False)).select(*columns)
    ).groupBy("d", "block", "slice").applyInArrow(_searcher(same, k), "anchor bigint, w int, id bigint, score bigint")


def _threshold(share: float) -> Column:
    """Above it lie about ``share`` of the window's ``n`` rows below its upper end, if scores are normal."""
    # Logistic form of the normal tail, rational form of its inverse.
    z = F.least(F.col("high") / F.col("spread"), F.lit(40.0))
    above = F.when(z > -8, 1 / (1 + F.exp(1.5976 * z + 0.07056 * z * z * z))).otherwise(1.0)
    tail = above + F.lit(float(share)) / F.col("n")
    t = F.sqrt(-2 * F.log(F.least(tail, F.lit(0.5))))
    inverse = t - (2.515517 + 0.802853 * t + 0.010328 * t * t) / (
        1 + 1.432788 * t + 0.189269 * t * t + 0.001308 * t * t * t)
    low = F.greatest(F.col("floor"), F.least(F.ceil(F.col("spread") * inverse), F.col("high")))
    return F.when((F.col("spread") > 0) & (tail < 0.5), low).otherwise(F.col("floor")).cast("bigint")


def _filled(rows: DataFrame, anchors: DataFrame, windows: DataFrame, same: bool, k: int) -> DataFrame:
    """(anchor, w, rank, id, score): the k best rows of each window (anchor, w, floor, high, spread, n)."""
    found, share = None, FIRST * k
    while True:
        asked = written_once(windows.withColumn("low", _threshold(share)), "asked")
        hits = written_once(_search(rows, anchors, asked, same, k), "hits")
        counts = hits.groupBy("anchor", "w").agg(F.count("*").alias("hits"))
        is_full = (F.coalesce("hits", F.lit(0)) >= k) | (F.col("low") <= F.col("floor"))
        asked = written_once(asked.join(counts, ["anchor", "w"], "left").withColumn("full", is_full), "asked")
        full = hits.join(asked.filter("full").select("anchor", "w"), ["anchor", "w"], "left_semi")
        found = full if found is None else found.unionByName(full)
        windows = asked.filter("NOT full").drop("low", "hits", "full")
        if windows.isEmpty():
            break
        share *= MORE
    order = Window.partitionBy("anchor", "w").orderBy(F.desc("score"), "id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def mine(
    vectors: DataFrame, is_anchor: Column, *, id_col: str = "vec_id", vector_col: str = "embedding",
    label_col: str = "label", scale: int = SCALE, positives: int = POSITIVES, negatives: int = NEGATIVES,
    low: int = LOW, high: int = HIGH
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) for the rows where ``is_anchor`` holds, a
    condition on the column ``id``: the best rows of other labels that score ``low`` to ``high`` percent of the positive."""
    scaled = F.transform("_vec", lambda x: F.floor(F.lit(float(scale)) * x.cast("double")))
    rows = vectors.select(
        F.col(id_col).cast("bigint").alias("id"), F.col(label_col).cast("bigint").alias("label"),
        F.col(vector_col).alias("_vec"))
    rows = rows.filter(F.col("id").isNotNull() & F.col("label").isNotNull() & usable("_vec"))
    rows = written_once(rows.select("id", "label", scaled.alias("v"), F.monotonically_increasing_id().alias("number")), "rows")
    square = F.aggregate("v", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))
    d = F.size("v").alias("d")
    counts = rows.groupBy(d, "label").agg(F.count("*").alias("alike"), F.sum(square).alias("squares"))
    counts = written_once(counts, "counts")
    lengths = counts.groupBy("d").agg(F.sum("alike").alias("rows"), (F.sum("squares") / F.sum("alike")).alias("mean"))
    anchors = rows.filter(is_anchor).select(F.xxhash64("id", "label", "v").alias("anchor"), "id", "label", "v")
    anchors = written_once(anchors.dropDuplicates(["anchor"]), "anchors")
    known = anchors.select("anchor", "label", d, square.alias("square")).join(
        counts.select("d", "label", "alike"), ["d", "label"]).join(lengths, "d")
    spread = F.sqrt(F.col("square") * F.col("mean") / F.col("d"))
    known = written_once(known.select("anchor", "alike", "rows", spread.alias("spread")), "known")
    first = known.select(
        "anchor", F.lit(0).alias("w"), F.lit(_LEAST).alias("floor"), F.lit(_MOST).alias("high"), "spread",
        F.col("alike").alias("n"))
    best = written_once(_filled(rows, anchors, first, True, positives).select(
        "anchor", F.col("rank").cast("int").alias("w"), F.col("id").alias("positive_id"),
        F.col("score").alias("positive_score")), "positives")
    bands = best.filter("positive_score >= 0").join(known, "anchor").select(
        "anchor", "w", F.expr(f"({low} * positive_score + 99) div 100").alias("floor"),
        F.expr(f"({high} * positive_score) div 100").alias("high"), "spread", F.col("rows").alias("n"))
    found = _filled(rows, anchors, bands.filter("floor <= high"), False, negatives)
    names = anchors.select("anchor", F.col("id").alias("anchor_id"))
    return found.join(best, ["anchor", "w"]).join(names, "anchor").select(
        "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("id").alias("negative_id"),
        "positive_score", F.col("score").alias("negative_score"))
