"""Joins over the catalogue.

No join here carries a broadcast hint: Spark broadcasts a side only below
`spark.sql.autoBroadcastJoinThreshold`, and AQE splits skewed partitions of the
shuffled form. Rule tables given as Python values become expressions and are
checked against MAX_RULES.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MAX_RULES = 2000


def check_rules(rules: Sequence | Mapping) -> None:
    if len(rules) > MAX_RULES:
        raise ValueError(f"{len(rules)} rules; more than {MAX_RULES} belong in a table")


def enrich_left(facts: DataFrame, dims: Sequence[tuple[DataFrame, str, str]]) -> DataFrame:
    """Left-join each (dimension, fact key, dimension key) in turn."""
    out = facts
    for dim, fk, pk in dims:
        out = out.join(dim, out[fk] == dim[pk], "left")
    return out


def lookup_name(facts: DataFrame, fk: str, dim: DataFrame, pk: str, name: str,
                alias: str, fallback: str) -> DataFrame:
    """Name of a foreign key, or `fallback` followed by the id."""
    names = dim.select(F.col(pk).alias("__pk"), F.col(name).alias("__name"))
    return (facts.join(names, F.col(fk) == F.col("__pk"), "left")
            .withColumn(alias, F.coalesce("__name", F.concat(F.lit(fallback), F.col(fk).cast("string"))))
            .drop("__pk", "__name"))


def link_test_sets(datasets: DataFrame, tests: DataFrame, key: str, source: str,
                   ready: Column) -> DataFrame:
    """Each dataset with its ready test sets; columns of the test side get `test_`."""
    right = tests.filter(ready).select(*[F.col(c).alias(f"test_{c}") for c in tests.columns])
    return datasets.join(right, F.col(key) == F.col(f"test_{source}"))


def children_count(parents: DataFrame, pk: str, children: DataFrame, fk: str, alias: str) -> DataFrame:
    """Children per parent, zero kept; children are counted before the join."""
    counts = children.groupBy(F.col(fk).alias("__fk")).agg(F.count(F.lit(1)).alias("__n"))
    return (parents.join(counts, F.col(pk) == F.col("__fk"), "left")
            .withColumn(alias, F.coalesce("__n", F.lit(0))).drop("__fk", "__n"))


def semi_filter(facts: DataFrame, fk: str, dim: DataFrame, pk: str, matches: Column) -> DataFrame:
    return facts.join(dim.filter(matches).select(F.col(pk).alias("__pk")),
                      F.col(fk) == F.col("__pk"), "left_semi")


def orphans(df: DataFrame, key: str, registries: Sequence[tuple[DataFrame, str]]) -> DataFrame:
    """Rows of `df` known to none of the registries."""
    out = df
    for registry, column in registries:
        known = registry.select(F.col(column).alias("__known"))
        out = out.join(known, F.col(key) == F.col("__known"), "left_anti")
    return out


def nullify_dangling(df: DataFrame, fk: str, removed: DataFrame, pk: str) -> DataFrame:
    """Blank the foreign keys that point to removed rows."""
    gone = removed.select(F.col(pk).alias("__gone")).distinct()
    return (df.join(gone, F.col(fk) == F.col("__gone"), "left")
            .withColumn(fk, F.when(F.col("__gone").isNull(), F.col(fk))).drop("__gone"))


def thread_self_join(messages: DataFrame, thread: str, turn: str, parent_visible: Column,
                     keep: Sequence[str]) -> DataFrame:
    """Reply with its parent (previous turn of the same thread), parent visible."""
    parent = messages.filter(parent_visible).select(
        F.col(thread).alias("__t"), (F.col(turn) + 1).alias("__turn"),
        *[F.col(c).alias(f"parent_{c}") for c in keep])
    return (messages.join(parent, (F.col(thread) == F.col("__t")) & (F.col(turn) == F.col("__turn")))
            .drop("__t", "__turn"))


def first_rule(text: Column, rules: Sequence[tuple[Sequence[str], str]]) -> Column:
    """Value of the first rule with a keyword contained in `text`, in rule order."""
    check_rules(rules)
    out = F.lit(None).cast("string")
    for keywords, value in reversed(rules):
        hit = F.lit(False)
        for k in keywords:
            hit = hit | text.contains(k)
        out = F.when(hit, F.lit(value)).otherwise(out)
    return out


def registry_match(name: Column, tiers: Sequence[tuple[int, Mapping[str, str]]],
                   partial_tier: int) -> tuple[Column, Column]:
    """(tier, value): exact key in tier order, else containment either way in
    `partial_tier`, first key winning."""
    base = F.regexp_replace(name, r"\.csv$", "")
    tier, value = F.lit(None).cast("int"), F.lit(None).cast("string")
    partial = dict(tiers)[partial_tier]
    for key, val in reversed(list(partial.items())):
        hit = base.contains(key) | (F.instr(F.lit(key), base) > 0)
        tier, value = F.when(hit, partial_tier).otherwise(tier), F.when(hit, val).otherwise(value)
    for number, entries in reversed(list(tiers)):
        check_rules(entries)
        for key, val in entries.items():
            hit = base == key
            tier, value = F.when(hit, number).otherwise(tier), F.when(hit, val).otherwise(value)
    return tier, value


def training_plan(datasets: DataFrame, key: str, manifest: DataFrame, manifest_key: str,
                  algorithms: str, dataset_filter: Sequence[str] | None = None,
                  algorithm_filter: str | None = None) -> DataFrame:
    """One row per available dataset and listed algorithm; unknown datasets go."""
    left = datasets.filter(F.col(key).isin(*dataset_filter)) if dataset_filter else datasets
    out = (left.join(manifest.withColumnRenamed(manifest_key, "__k"), F.col(key) == F.col("__k"))
           .withColumn("algorithm", F.explode(algorithms)).drop("__k", algorithms))
    return out.filter(F.col("algorithm") == algorithm_filter) if algorithm_filter else out
