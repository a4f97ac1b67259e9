"""Checks on tables: foreign keys, key containment, cardinality, rule rejections."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lotline.functions.classify import kind_predicate


def fk_report(tables: dict[str, DataFrame], specs: list[tuple[str, str, str, str]]) -> DataFrame:
    """child, fk, parent, total, non_null, dangling, sample for each (child, fk, parent, key); sample: the least dangling key as text.

    Every table is read once for all its keys: a row becomes one line per reference it makes and per key by
    which it is referred to. Lines are counted per value before they travel, so a value in very many rows
    is one line per task, and each value's references meet its parent in one grouping. An empty child reports zeros.
    """
    keys = sorted({(parent, key) for _, _, parent, key in specs})
    lines = []
    for name, df in tables.items():
        own = [(-1, keys.index(pk), pk[1]) for pk in keys if pk[0] == name]
        own += [(n, keys.index((parent, key)), fk) for n, (child, fk, parent, key) in enumerate(specs) if child == name]
        if own:
            stacked = F.explode(F.array(*[F.struct(F.lit(n).alias("spec"), F.lit(k).alias("parent"), F.col(c).cast("string").alias("value")) for n, k, c in own]))
            lines.append(df.select(stacked.alias("x")).select("x.*"))
    counted = reduce(DataFrame.unionByName, lines).groupBy("parent", "value", "spec").agg(F.count(F.lit(1)).alias("n"))
    # At most one entry per reference to a parent.
    met = counted.groupBy("parent", "value").agg(F.bool_or(F.col("spec") < 0).alias("hit"), F.collect_list(F.when(F.col("spec") >= 0, F.struct("spec", "n"))).alias("refs"))
    met = met.select("value", (F.col("value").isNotNull() & ~F.col("hit")).alias("lost"), F.explode("refs").alias("r")).select("value", "lost", "r.*")
    found = met.groupBy("spec").agg(F.sum("n").alias("total"), F.sum(F.when(F.col("value").isNotNull(), F.col("n"))).alias("non_null"), F.sum(F.when(F.col("lost"), F.col("n"))).alias("dangling"), F.min(F.when(F.col("lost"), F.col("value"))).alias("sample"))
    asked = counted.sparkSession.createDataFrame([(n, *spec[:3]) for n, spec in enumerate(specs)], "spec int, child string, fk string, parent string")
    zero = lambda c: F.coalesce(c, F.lit(0).cast("long")).alias(c)
    return asked.join(found, "spec", "left").select("child", "fk", "parent", zero("total"), zero("non_null"), zero("dangling"), "sample")


def missing_keys(a: DataFrame, b: DataFrame, keys: list[str]) -> DataFrame:
    """Distinct keys of a that b lacks."""
    return a.select(*keys).distinct().join(b.select(*keys), keys, "left_anti")


def cardinality_report(pairs: dict[str, tuple[DataFrame, DataFrame]]) -> DataFrame:
    """name, n_a, n_b, ok: whether store B has at least as many rows as store A."""

    def one(name: str, a: DataFrame, b: DataFrame) -> DataFrame:
        both = a.select(F.lit(1).alias("x"), F.lit(0).alias("y")).unionByName(b.select(F.lit(0).alias("x"), F.lit(1).alias("y")))
        return both.agg(F.coalesce(F.sum("x"), F.lit(0)).alias("n_a"), F.coalesce(F.sum("y"), F.lit(0)).alias("n_b")).select(F.lit(name).alias("name"), "n_a", "n_b", (F.col("n_b") >= F.col("n_a")).alias("ok"))

    return reduce(DataFrame.unionByName, [one(n, *p) for n, p in pairs.items()])


def resolution_counts(rows: DataFrame, reason: str) -> DataFrame:
    return rows.groupBy(reason).agg(F.count(F.lit(1)).alias("n"))


def gate_report(a: DataFrame, b: DataFrame) -> DataFrame:
    """gate, n_a, n_b, ok: duplex applications with a usable sale before lodgement in two stores; the second must have some, and as many."""
    duplex = lambda df: df.where(kind_predicate("duplex", F.col("description"), F.col("approved_units")))
    both = duplex(a).select(F.lit(1).alias("x"), F.lit(0).alias("y")).unionByName(duplex(b).select(F.lit(0).alias("x"), F.lit(1).alias("y")))
    out = both.agg(F.coalesce(F.sum("x"), F.lit(0)).alias("n_a"), F.coalesce(F.sum("y"), F.lit(0)).alias("n_b"))
    return out.select(F.lit("duplex").alias("gate"), "n_a", "n_b", ((F.col("n_b") > 0) & (F.col("n_b") >= F.col("n_a"))).alias("ok"))
