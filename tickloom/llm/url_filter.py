"""URL rules by host suffix and path prefix, found through hash prefixes.

A URL is expanded into expressions: every suffix of its host, at label boundaries, with
every prefix of its path, for the numbers of labels and the path lengths that rules have. A rule and an expression
meet by the first ``PREFIX`` hex digits of their SHA-256, an equality join; the full
digest then confirms. Of the rules that fit, the one whose host and path are longest together decides, then the longer
host.

Hits are aggregated per host and path before any shuffle, so a host with most of the pages is no
burden, and joined back by both.

Cases: a null URL and one without ``://`` have empty host and path, which only a rule for the empty
host would fit; ports and user names are part of the host; rules given twice must agree, else "block" wins;
a null field of a rule drops the rule; repeated pages are judged alike; no rule at all or an empty table
gives the default or an empty result; other columns of the pages pass through ``keep``.
"""

from __future__ import annotations

from string import ascii_lowercase, ascii_uppercase

from pyspark.sql import Column, DataFrame, functions as F

PREFIX = 8
DEFAULT = "allow"
#: Rules are broadcast up to so many, some 50 MB; beyond that the join is shuffled.
BROADCAST_RULES = 200_000


def host_and_path(url: Column) -> tuple[Column, Column]:
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + 3))
    host = F.regexp_extract(rest, "^[^/?#]*", 0)
    path = F.regexp_extract(F.substr(rest, F.length(host) + 1), "^[^?#]*", 0)
    lower = F.translate(host, ascii_uppercase, ascii_lowercase)
    return F.coalesce(lower, F.lit("")), F.coalesce(path, F.lit(""))


def _digest(host: Column, path: Column) -> Column:
    return F.sha2(F.concat(host, F.lit("\n"), path), 256)


def _labels(host: Column) -> Column:
    return F.size(F.split(host, r"\."))


def judge(
    pages: DataFrame, rules: DataFrame, *, url: str = "url", keep: tuple[str, ...] = ("page_id",),
    default: str = DEFAULT,
) -> DataFrame:
    """``keep``, host, path, rule (host and path, null if none fits) and verdict of each page.

    ``rules`` is (host, path, verdict).
    """
    known = rules.select(
        F.translate("host", ascii_uppercase, ascii_lowercase).alias("rule_host"),
        F.col("path").alias("rule_path"), "verdict").dropna()
    known = known.withColumn("rule_digest", _digest(F.col("rule_host"), F.col("rule_path")))
    known = known.groupBy("rule_digest", "rule_host", "rule_path").agg(F.max("verdict").alias("verdict"))
    known = known.withColumn("_key", F.substring("rule_digest", 1, PREFIX))
    # A host has at most 127 labels, and few lengths of path occur: two short lists.
    shape = known.agg(
        F.count("*"), F.collect_set(_labels(F.col("rule_host"))), F.collect_set(F.length("rule_path"))).first()
    n_rules, labels, lengths = shape[0], sorted(shape[1]), sorted(shape[2])
    if n_rules <= BROADCAST_RULES:
        known = F.broadcast(known)

    host, path = host_and_path(F.col(url).cast("string"))
    given = pages.select(*keep, host.alias("host"), path.alias("path"))
    parts = F.split("host", r"\.")
    cut = given.select("host", "path", parts.alias("_parts"), F.size(parts).alias("_n"))
    for values, name in ((labels, "_labels"), (lengths, "_length")):
        cut = cut.withColumn(name, F.explode(F.array(*map(F.lit, values)).cast("array<int>")))
    cut = cut.filter("_labels <= _n AND _length <= length(path)")
    suffix = F.array_join(F.slice("_parts", F.col("_n") - F.col("_labels") + 1, F.col("_labels")), ".")
    prefix = F.substr("path", F.lit(1), F.col("_length"))
    asked = cut.select("host", "path", _digest(suffix, prefix).alias("_digest"))
    asked = asked.withColumn("_key", F.substring("_digest", 1, PREFIX))
    fits = asked.join(known, "_key").filter("_digest = rule_digest")
    best = fits.groupBy("host", "path").agg(F.max(F.struct(
        (F.length("rule_host") + F.length("rule_path")).alias("size"), F.length("rule_host").alias("of_host"),
        F.concat("rule_host", "rule_path").alias("rule"), "verdict")).alias("_best"))
    return given.join(best, ["host", "path"], "left").select(
        *keep, "host", "path", F.col("_best.rule").alias("rule"),
        F.coalesce("_best.verdict", F.lit(default)).alias("verdict"))
