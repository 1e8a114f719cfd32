"""Exact top-k inner-product search over a pivot-distance index.

Vectors become integers ``floor(scale * x)``. One more coordinate makes the largest inner product the
smallest distance: a candidate v gets ``sqrt(M - |v|^2)``, M the largest squared length of all, a query
gets 0; then ``distance^2 = |q|^2 + M - 2 * score``. Pivots are candidates of a bounded sample,
far from each other. Every candidate is keyed by its nearest pivot and its distance to it, and each pivot's
distances are cut into annuli at quantiles of the sample; the exact least and greatest distance of every annulus come from
all candidates.

For a query at distance d from a pivot, no candidate of the annulus [low, high] is nearer than
``max(low - d, d - high)``. First the nearest annuli that hold enough candidates are searched; their
k-th best score then rules out every annulus whose bound is worse, and only the others are searched.
Bounds are loosened by more than their rounding, so results are exact, ties included.

Annuli are searched in blocks of bounded size, whatever their number of candidates or
queries; each block keeps its best k for each query. The sample, pivots and annuli have fixed sizes and are
all that reaches the driver.

Cases: vectors that are null, empty or hold null or non-finite components take no part, nor do null ids; a
query meets only candidates of its own length, and those that repeat its id count as itself; repeated
candidates are ranked each; equal scores go to the smaller id; repeated queries are answered once;
scores are longs, exact while components scaled stay below 2^28 in size; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from tickloom.llm.vectors import matrices, usable
from tickloom.sources.shared import written_once

SCALE = 64
K = 20
SAMPLE = 2048
PIVOTS, ANNULI = 8, 8
BLOCK_ROWS = 2048
#: Annuli searched first hold this many times k candidates.
FIRST = 8
_ROOM = 1e-6
#: Score of a query with itself: below all others, and its negation is still a long.
_OWN = np.iinfo(np.int64).min + 1


def _lengthened(v: np.ndarray, most: float) -> np.ndarray:
    rest = np.sqrt(np.maximum(most - (v * v).sum(1), 0))
    return np.concatenate([v, rest[:, None]], 1)


def _distances(x: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum((x * x).sum(1)[:, None] + (pivots * pivots).sum(1) - 2 * (x @ pivots.T), 0))


def choose_pivots(sample: np.ndarray, most: float) -> tuple[np.ndarray, np.ndarray]:
    """Pivots of a sample, each the farthest from those before, and inner edges of each one's annuli."""
    x = _lengthened(sample, most)
    chosen = [0]
    nearest = _distances(x, x[:1])[:, 0]
    while len(chosen) < min(PIVOTS, len(x)):
        chosen.append(int(nearest.argmax()))
        nearest = np.minimum(nearest, _distances(x, x[chosen[-1:]])[:, 0])
    pivots = x[chosen]
    d = _distances(x, pivots)
    own = d.argmin(1)
    edges = np.zeros((len(pivots), ANNULI - 1))
    for p in range(len(pivots)):
        edges[p] = np.quantile(d[own == p, p] if (own == p).any() else d[:, p], np.arange(1, ANNULI) / ANNULI)
    return pivots, edges


def _keyed(most: float, pivots: np.ndarray, edges: np.ndarray):
    def key(batches):
        for batch in batches:
            annulus, distance = np.zeros(batch.num_rows, np.int32), np.zeros(batch.num_rows)
            for rows, v in matrices(batch.column("v")):
                d = _distances(_lengthened(v, most), pivots)
                own = d.argmin(1)
                distance[rows] = d[np.arange(len(rows)), own]
                annulus[rows] = own * ANNULI + (distance[rows][:, None] > edges[own]).sum(1)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(annulus), pa.array(distance)],
                [*batch.schema.names, "annulus", "distance"])

    return key


def _bounds(most: float, pivots: np.ndarray, rings: np.ndarray, first: int):
    """For each query its annuli and the best score each can hold; ``seed`` marks those searched first."""
    ids, low, high, count = rings.T

    def bound(batches):
        for batch in batches:
            for rows, v in matrices(batch.column("v")):
                d = _distances(np.concatenate([v, np.zeros((len(v), 1))], 1), pivots)[:, (ids // ANNULI).astype(int)]
                least = np.maximum(np.maximum(low - d, d - high), 0)
                best = ((v * v).sum(1)[:, None] + most - least * least) / 2
                best += _ROOM * (1 + np.abs(best) + most)
                order = np.argsort(-best, axis=1, kind="stable")
                before = np.cumsum(count[order], axis=1) - count[order]
                seed = np.zeros(best.shape, bool)
                np.put_along_axis(seed, order, before < first, 1)
                n, m = best.shape
                which = pa.array(np.repeat(rows, m))
                yield pa.RecordBatch.from_arrays([
                    batch.column("query").take(which), pa.array(np.tile(ids.astype(np.int32), n)),
                    pa.array(best.ravel()), pa.array(seed.ravel()),
                ], ["query", "annulus", "best", "seed"])

    return bound


def _dots(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    largest = max(np.abs(a).max(initial=0), np.abs(b).max(initial=0))
    if largest * largest * a.shape[1] < 2.0**53:
        return (a @ b.T).astype(np.int64)
    return a.astype(np.int64) @ b.astype(np.int64).T


def _search(k: int):
    def best(table: pa.Table) -> pa.Table:
        """The k best candidates of a block for each of its queries."""
        asks = table.column("asks").to_numpy()
        [(_, v)] = matrices(table.column("v"))
        ids = table.column("id").to_numpy()
        names = table.column("query").to_numpy()[asks]
        answer = np.flatnonzero(~asks)
        answer = answer[np.argsort(ids[answer], kind="stable")]
        out = []
        step = max(1, (1 << 21) // max(1, len(answer)))
        for start in range(0, len(names) if len(answer) else 0, step):
            own = np.flatnonzero(asks)[start:start + step]
            score = _dots(v[own], v[answer])
            score[ids[own][:, None] == ids[answer]] = _OWN
            n = min(k, len(answer))
            # Columns are in order of id, so a stable order settles ties.
            edge = -np.partition(-score, n - 1, axis=1)[:, n - 1]
            row, column = np.nonzero((score >= edge[:, None]) & (score > _OWN))
            found = score[row, column]
            order = np.lexsort((column, -found, row))
            row, column, found = row[order], column[order], found[order]
            rank = np.arange(len(row)) - np.searchsorted(row, row, "left")
            kept = rank < n
            out.append((names[start + row[kept]], ids[own[row[kept]]], ids[answer[column[kept]]], found[kept]))
        parts = [np.concatenate(x) for x in zip(*out)] if out else [np.zeros(0, np.int64)] * 4
        return pa.table([pa.array(x.astype(np.int64)) for x in parts], ["query", "query_id", "vec_id", "score"])

    return best


def _top(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def _visit(queries: DataFrame, candidates: DataFrame, visits: DataFrame, k: int) -> DataFrame:
    """Best k of each query among the annuli it visits, block by block."""
    def parts(n: Column) -> Column:
        return F.ceil(n / F.lit(BLOCK_ROWS)).cast("int")

    asked = visits.groupBy("annulus").agg(parts(F.count("*")).alias("blocks"))
    slices = candidates.groupBy("annulus").agg(parts(F.count("*")).alias("slices"))
    # A row for each annulus: as many as the index has.
    both = F.broadcast(asked.join(slices, "annulus"))
    columns = ("annulus", "block", "slice", "asks", "query", "id", "v")

    def dealt(rows: DataFrame, by: str, own: str, of: str, other: str, n: str, asks: bool) -> DataFrame:
        return rows.join(both, "annulus").withColumn(own, F.pmod(F.xxhash64(by), F.col(of)).cast("int")).withColumn(
            other, F.explode(F.sequence(F.lit(0), F.col(n) - 1))).withColumn("asks", F.lit(asks)).select(*columns)

    asking = dealt(visits.join(queries, "query"), "query", "block", "blocks", "slice", "slices", True)
    answering = candidates.withColumn("query", F.lit(0).cast("bigint"))
    answering = dealt(answering, "id", "slice", "slices", "block", "blocks", False)
    found = asking.unionByName(answering).groupBy("annulus", "block", "slice").applyInArrow(
        _search(k), "query bigint, query_id bigint, vec_id bigint, score bigint")
    return _top(found, k).drop("rank")


def _search_length(given: DataFrame, length: int, is_query: Column, k: int) -> DataFrame:
    candidates = given.filter(F.size("v") == length)
    squares = F.aggregate("v", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))
    most = float(candidates.agg(F.max(squares)).first()[0] or 0)
    sample = candidates.orderBy(F.xxhash64("id"), "id").limit(SAMPLE).select("v").toArrow()
    pivots, edges = choose_pivots(matrices(sample.column("v"))[0][1], most)
    keyed = written_once(candidates.mapInArrow(
        _keyed(most, pivots, edges), "id bigint, v array<bigint>, annulus int, distance double"), "keyed")
    rings = keyed.groupBy("annulus").agg(F.min("distance"), F.max("distance"), F.count("*")).collect()
    rings = np.array([tuple(r) for r in rings], np.float64)
    queries = candidates.filter(is_query).withColumn("query", F.xxhash64("id", "v")).dropDuplicates(["query"])
    queries = written_once(queries, "queries")
    bounds = queries.select("query", "v").mapInArrow(
        _bounds(most, pivots, rings, FIRST * k + 1), "query bigint, annulus int, best double, seed boolean")
    bounds = written_once(bounds, "bounds")
    index = keyed.drop("distance")
    visits = bounds.select("query", "annulus", "best", "seed")
    first = written_once(_visit(queries, index, visits.filter("seed").select("query", "annulus"), k), "first")
    enough = first.groupBy("query").agg(F.count("*").alias("n"), F.min("score").alias("least"))
    enough = enough.withColumn("least", F.when(F.col("n") >= k, F.col("least"))).drop("n")
    rest = visits.filter("NOT seed").join(enough, "query", "left").filter(
        F.col("least").isNull() | (F.col("best") >= F.col("least"))).select("query", "annulus")
    return first.unionByName(_visit(queries, index, rest, k))


def top_k(
    vectors: DataFrame, is_query: Column, *, id_col: str = "vec_id", vector_col: str = "embedding",
    scale: int = SCALE, k: int = K
) -> DataFrame:
    """(query_id, rank, vec_id, score) for the rows where ``is_query`` holds, a condition on the column ``id``."""
    scaled = F.transform("_vec", lambda x: F.floor(F.lit(float(scale)) * x.cast("double")))
    given = vectors.select(F.col(id_col).cast("bigint").alias("id"), F.col(vector_col).alias("_vec"))
    given = given.filter(F.col("id").isNotNull() & usable("_vec")).select("id", scaled.alias("v"))
    given = written_once(given, "scaled")
    lengths = [r[0] for r in given.groupBy(F.size("v").alias("n")).count().select("n").collect()]
    empty = given.sparkSession.createDataFrame([], "query bigint, query_id bigint, vec_id bigint, score bigint")
    found = empty
    for length in sorted(lengths):
        found = found.unionByName(_search_length(given, length, is_query, k))
    return _top(found, k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
