"""Rules of hosts by suffix: the longest rule that a host is, or is a subdomain of, by equal joins over label suffixes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def suffixes(host: Column) -> Column:
    """All suffixes of whole labels, the host itself first: a.b.c, b.c, c."""
    labels = F.split(F.lower(host), r"\.")
    return F.transform(F.sequence(F.lit(1), F.size(labels)), lambda k: F.array_join(F.slice(labels, k, F.size(labels)), "."))


def with_rule(rows: DataFrame, rules: DataFrame, host: str = "host", name: str = "rule") -> DataFrame:
    """rows with the columns of rules (`name`, and others) of the longest rule that is a suffix of the row's host, in whole labels; null where none is, or
    the host is null. Of rules with one name the least is taken, by its other columns.

    Each different host is looked up once: its suffixes meet the rules in an equal join, whatever the number of rules, and the longest one is an aggregate that is
    summed in each task before the shuffle. Columns of rules must be no columns of rows.
    """
    rest = [c for c in rules.columns if c != name]
    once = rules.filter(F.col(name).isNotNull()).groupBy(F.lower(name).alias("suffix_")).agg(F.min(F.struct(name, *rest)).alias("told_"))
    hosts = rows.select(F.col(host).alias("host_")).filter("host_ is not null").distinct()
    met = hosts.select("host_", F.explode(suffixes(F.col("host_"))).alias("suffix_")).join(once, "suffix_")
    best = met.groupBy("host_").agg(F.max_by("told_", F.length("suffix_")).alias("told_"))
    return rows.join(best, F.col(host) == F.col("host_"), "left").select(*[rows[c] for c in rows.columns], *[F.col(f"told_.{c}").alias(c) for c in rules.columns])
