"""Row rules, key rules and the pass/reject split."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# A rule maps its name to the condition a sound row meets. Null counts as a violation.
Rules = Mapping[str, Column]


def finite(name: str) -> Column:
    """Neither null nor NaN nor infinite. NaN compares as larger than any number, so
    a rule about a number says this first."""
    value = F.col(name)
    return value.isNotNull() & ~F.isnan(value) & (F.abs(value) != float("inf"))


def _broken(condition: Column) -> Column:
    return ~F.coalesce(condition, F.lit(False))


def count_violations(df: DataFrame, rules: Rules) -> DataFrame:
    """One row per rule. All rules of a table are counted in one scan of it."""
    counts = df.agg(
        F.count(F.lit(1)).alias("n_checked"),
        *[F.count_if(_broken(cond)).alias(f"v{i}") for i, cond in enumerate(rules.values())],
    )
    pairs = F.array(
        *[
            F.struct(F.lit(name).alias("rule"), F.col(f"v{i}").alias("n_violations"))
            for i, name in enumerate(rules)
        ]
    )
    return counts.select("n_checked", F.inline(pairs)).select("rule", "n_checked", "n_violations")


def check_reference(
    child: DataFrame,
    key: str,
    parent: DataFrame,
    parent_key: str,
    has_parent: str,
    has_child: str | None = None,
    unique: str | None = None,
    child_number: str | None = None,
    number_unique: str | None = None,
    child_rules: Rules | None = None,
) -> DataFrame:
    """Violations of up to four rules about one reference from child to parent, and
    of ``child_rules`` about single child rows, which need no scan of their own.

    ``has_parent``: child rows whose key no parent has (a null key included);
    ``has_child``: parent rows no child refers to; ``unique``: parent rows
    beyond the first under a key; ``number_unique``: child rows beyond the first
    under a key and ``child_number``.

    Both sides are counted per key before they meet, so a key held by much of
    either table is one row in the join, and the join reuses the partitioning
    of the counts. One scan of each side serves all rules. Children are counted by
    number first, so that a key held by much of the table is folded by each task.
    """
    single = child_rules or {}
    broken_rows = [F.count_if(_broken(c)).alias(f"_r{i}") for i, c in enumerate(single.values())]
    if number_unique:
        numbered = child.groupBy(key, child_number).agg(
            F.count(F.lit(1)).alias("_n"),
            *broken_rows,
        )
        children = numbered.groupBy(F.col(key).alias("_key")).agg(
            F.sum("_n").alias("_n"),
            F.sum(F.col("_n") - 1).alias("_again"),
            *[F.sum(f"_r{i}").alias(f"_r{i}") for i in range(len(single))],
        )
    else:
        children = child.groupBy(F.col(key).alias("_key")).agg(
            F.count(F.lit(1)).alias("_n"),
            F.lit(0).alias("_again"),
            *broken_rows,
        )
    parents = parent.groupBy(F.col(parent_key).alias("_key")).agg(F.count(F.lit(1)).alias("_m"))

    def total(rows: Column) -> Column:
        return F.coalesce(F.sum(rows), F.lit(0))

    rules = [
        (has_parent, "_n", F.when(F.col("_m").isNull(), F.col("_n"))),
        (has_child, "_m", F.when(F.col("_n").isNull(), F.col("_m"))),
        (unique, "_m", F.col("_m") - 1),
        (number_unique, "_n", F.col("_again")),
        *[(rule, "_n", F.col(f"_r{i}")) for i, rule in enumerate(single)],
    ]
    rows = F.array(
        *[
            F.struct(
                F.lit(rule).alias("rule"),
                F.col(f"all{checked}").alias("n_checked"),
                F.col(f"v{i}").alias("n_violations"),
            )
            for i, (rule, checked, _) in enumerate(rules)
            if rule
        ]
    )
    return (
        children.join(parents, "_key", "full")
        .agg(
            total(F.col("_n")).alias("all_n"),
            total(F.col("_m")).alias("all_m"),
            *[total(broken).alias(f"v{i}") for i, (_, _, broken) in enumerate(rules)],
        )
        .select(F.inline(rows))
    )


def count_repeats(df: DataFrame, keys: list[str], rule: str) -> DataFrame:
    """Rows beyond the first under the same key."""
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    return per_key.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("n_checked"),
        F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("n_violations"),
    ).select(F.lit(rule).alias("rule"), "n_checked", "n_violations")


def rule_report(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def with_reject_reason(df: DataFrame, rules: Rules, name: str = "reject_reason") -> DataFrame:
    """Add the first rule each row breaks, in the order given; null if it breaks none."""
    reason = F.lit(None).cast("string")
    for rule, condition in reversed(list(rules.items())):
        reason = F.when(_broken(condition), F.lit(rule)).otherwise(reason)
    return df.withColumn(name, reason)
