"""Connected components of a graph of links, as a loop of joins."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tickloom.sources.shared import written_once


def _least(links: DataFrame) -> DataFrame:
    return links.groupBy("u").agg(F.min("v").alias("m"))


def _state(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38)"))).first())


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node that has a link; root is the smallest node it can reach.

    ``links`` is (u, v) in any order, with repeats and self-links allowed. Alternates
    the large-star and small-star steps until nothing changes, so the number of rounds grows with
    the logarithm of the nodes. A hub's links are never gathered: minima are
    partially aggregated and joined back by key. Every round is a written table.
    """
    u, v = F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")
    links = written_once(links.filter("u <> v").select(u, v).distinct(), "links")
    state = _state(links)
    while True:
        both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = (
            both.join(_least(both), "u").filter(F.col("v") > F.col("u"))
            .select(F.col("v").alias("u"), F.least("u", "m").alias("v"))
            .distinct()
        )
        large = written_once(large, "links")
        small = (
            large.join(_least(large), "u").filter(F.col("v") > F.col("m"))
            .select(F.col("v").alias("u"), F.col("m").alias("v"))
            .unionByName(_least(large).select("u", F.col("m").alias("v")))
            .distinct()
        )
        links = written_once(small, "links")
        state, before = _state(links), state
        if state == before:
            return links.select(F.col("u").alias("node"), F.col("v").alias("root"))
