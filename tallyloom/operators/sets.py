"""Deduplication, unions, differences, upserts and dataset checks."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.functions.patterns import passage_windows, window_hits
from tallyloom.operators.filters import length_band
from tallyloom.operators.ordered import on_keys
from tallyloom.operators.profile import missing
from tallyloom.operators.sampling import downsample
from tallyloom.session import cut_lineage
from tallyloom.sources.readers import union_all


def drop_duplicate_rows(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Distinct rows, and one row with the counts before and after."""
    copies = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("__n"))
    counts = copies.agg(F.sum("__n").alias("before"), F.count(F.lit(1)).alias("after"))
    return copies.drop("__n"), counts


def dedup_by_hash(df: DataFrame, text: str, key: str) -> DataFrame:
    """First row (smallest key) per content hash.

    Only hash and key are shuffled, combined first; the texts are then picked by
    their unique key, so a group of copies of any size stays spread out.
    """
    first = df.groupBy(F.md5(text).alias("h")).agg(F.min(key).alias("__first"))
    return df.join(first.select("__first"), F.col(key) == F.col("__first"), "left_semi")


def merge_sources(sources: Mapping[str, DataFrame], key: str, text: str, label: str, balance: bool = False,
                  low: int = 5, high: int = 500) -> tuple[DataFrame, DataFrame]:
    """Union, dedup, length filter, optional balancing; and rows per source."""
    tagged = union_all([df.withColumn("origin", F.lit(name)) for name, df in sources.items()])
    counts = tagged.groupBy("origin").agg(F.count(F.lit(1)).alias("n"))
    out = dedup_by_hash(tagged, text, key).filter(length_band(text, low, high))
    return (downsample(out, key, label) if balance else out), counts


def schema_diff(left: DataFrame, right: DataFrame, ignore: Sequence[str] = ()) -> dict[str, list[str]]:
    """Columns of `left` that `right` lacks, and the other way round."""
    a, b = set(left.columns) - set(ignore), set(right.columns) - set(ignore)
    return {"missing": sorted(a - b), "extra": sorted(b - a)}


def unseen_values(train: DataFrame, test: DataFrame, column: str) -> DataFrame:
    """Values of the test side that never occur in training."""
    known = train.select(F.col(column).alias("__k")).filter(F.col("__k").isNotNull()).distinct()
    return (test.select(column).filter(F.col(column).isNotNull()).distinct()
            .join(known, F.col(column) == F.col("__k"), "left_anti"))


def validate_test_set(train: DataFrame, test: DataFrame, target: str, min_rows: int = 20) -> DataFrame:
    """One row: valid, issues, warnings."""
    diff = schema_diff(train, test, [target])
    has_target = target in test.columns
    gaps = F.lit(0).cast("long")
    for c in test.columns:
        gaps = gaps + F.sum(F.when(missing(test, c), 1).otherwise(0))
    row = test.agg(F.count(F.lit(1)).alias("n"), F.coalesce(gaps, F.lit(0)).alias("gaps"))
    unseen = unseen_values(train, test, target).agg(F.count(F.lit(1))).scalar() \
        if has_target and target in train.columns else F.lit(0)
    row = row.withColumn("unseen", unseen)
    issues = F.array_compact(F.array(
        F.when(F.col("n") < min_rows, F.concat(F.lit("too_few_rows:"), F.col("n"))),
        F.lit(None if has_target else f"target_missing:{target}"),
        F.lit("missing_columns:" + ",".join(diff["missing"]) if diff["missing"] else None)))
    warnings = F.array_compact(F.array(
        F.lit("extra_columns:" + ",".join(diff["extra"]) if diff["extra"] else None),
        F.when(F.col("gaps") > 0, F.concat(F.lit("nulls:"), F.col("gaps"))),
        F.when(F.col("unseen") > 0, F.concat(F.lit("unseen_targets:"), F.col("unseen")))))
    return row.select((F.size(issues) == 0).alias("valid"), issues.alias("issues"), warnings.alias("warnings"))


def leakage_exact(left: DataFrame, right: DataFrame, text: str) -> DataFrame:
    """Content hashes present on both sides."""
    h = F.sha2(F.col(text), 256).alias("digest")
    return left.select(h).distinct().join(right.select(h).distinct(), "digest", "left_semi")


def leakage_contained(passages: DataFrame, pkey: str, ptext: str, docs: DataFrame, dkey: str, dtext: str,
                      width: int = 24) -> DataFrame:
    """(passage key, document key) where the passage text occurs in the document.

    Passages meet documents on one window of `width` bytes: the passage's rarest at the
    corpus (fewest documents), which any containing document must have. One pass over the
    documents finds the windows of all passages; the full text is compared afterwards.
    Passages with fewer bytes than the window use their own length.
    """
    texts = passages.select(F.col(pkey).alias("pk"), F.col(ptext).alias("pt")).filter(F.length("pt") > 0)
    windows = cut_lineage(passage_windows(texts, "pk", "pt", width), "windows")
    known = docs.select(F.col(dkey).alias("dk"), F.col(dtext).alias("dt"))
    hits = cut_lineage(window_hits(known, "dk", "dt", windows.select("w", "h").distinct()), "hits")
    rarity = hits.groupBy("h").agg(F.count(F.lit(1)).alias("df"))
    best = (windows.join(rarity, "h", "left").groupBy("pk")
            .agg(F.min(F.struct(F.coalesce("df", F.lit(0)).alias("df"), F.col("h"))).alias("b"))
            .filter(F.col("b.df") > 0).select("pk", F.col("b.h").alias("h")))
    pairs = best.join(hits, "h").select("pk", "dk").distinct()
    return (pairs.join(texts, "pk").join(known, "dk").filter(F.col("dt").contains(F.col("pt")))
            .select(F.col("pk").alias(pkey), F.col("dk").alias(dkey)))


def upsert(base: DataFrame, delta: DataFrame, on: Sequence[str], update: Sequence[str], version: str) -> DataFrame:
    """Rows of `base` with `update` columns taken from a matching delta row whose
    `version` differs, plus the delta rows that match nothing."""
    fresh = delta.select(*[F.col(c).alias(f"__d_{c}") for c in delta.columns])
    cond = F.lit(True)
    for k in on:
        cond = cond & F.col(k).eqNullSafe(F.col(f"__d_{k}"))
    both = base.withColumn("__old", F.lit(True)).join(fresh.withColumn("__new", F.lit(True)), cond, "full_outer")
    changed = F.col("__new").isNotNull() & ~F.col(version).eqNullSafe(F.col(f"__d_{version}"))
    out = []
    for c in base.columns:
        new = F.col(f"__d_{c}") if c in delta.columns else F.lit(None)
        old_side = F.when(changed, new).otherwise(F.col(c)) if c in update else F.col(c)
        out.append(F.when(F.col("__old").isNull(), new).otherwise(old_side).alias(c))
    return both.select(*out)


def apply_patch(df: DataFrame, patch: DataFrame, key: str, allowed: Sequence[str], stamp: Column,
                stamped: str = "updated_at") -> DataFrame:
    """Overwrite allowed columns with the values a patch row supplies."""
    usable = [c for c in patch.columns if c in allowed and c in df.columns]
    fresh = patch.select(F.col(key).alias("__pk"), *[F.col(c).alias(f"__p_{c}") for c in usable])
    return (df.join(fresh, F.col(key) == F.col("__pk"), "left")
            .select(*[F.coalesce(F.col(f"__p_{c}"), F.col(c)).alias(c) if c in usable else F.col(c) for c in df.columns],
                    F.when(F.col("__pk").isNotNull(), stamp).alias(stamped)))


def copy_if_absent(catalog: DataFrame, requests: DataFrame, key: str, name: str, owner: str, public: str) -> DataFrame:
    """New private rows for the requested (key, new owner) copies of public rows,
    unless that owner has a row of the same name."""
    want = requests.select(F.col(key).alias("__k"), F.col(owner).alias("__o"))
    copies = (catalog.filter(F.col(public)).join(want, F.col(key) == F.col("__k"))
              .withColumn(owner, F.col("__o")).withColumn(public, F.lit(False)).drop("__k", "__o"))
    have = catalog.select(F.col(name).alias("__n"), F.col(owner).alias("__o")).distinct()
    new = copies.join(have, (F.col(name) == F.col("__n")) & (F.col(owner) == F.col("__o")), "left_anti")
    # two requests of one owner for the same name give one copy, the smallest key
    first = new.groupBy(name, owner).agg(F.min(key).alias(key))
    return on_keys(new, first, [name, owner, key], "left_semi")
