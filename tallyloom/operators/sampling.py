"""Splits, samples, balancing and synthetic rows.

All randomness is a seeded hash of the row key, so results do not depend on
partitioning or retries. `first_by_hash` takes exactly m rows per group in hash
order without moving the table: slice counts find the one hash slice where each
group's quota runs out, and only the rows of that slice are ranked.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from tallyloom.functions.digests import unit_hashes
from tallyloom.operators import knn, vector_index
from tallyloom.operators.ordered import hash_order, hash_slice, on_keys, ranked, slice_count
from tallyloom.operators.sparse_topk import ROW_BLOCK, nearest_rows
from tallyloom.session import cut_lineage

SLICES = 65536


def uniform(*parts: Column | str, seed: int = 42) -> Column:
    """Hash of the parts as a number in [0, 1)."""
    text = F.concat_ws("|", *[(F.col(p) if isinstance(p, str) else p).cast("string") for p in parts], F.lit(str(seed)))
    return F.conv(F.substring(F.md5(text), 1, 12), 16, 10).cast("double") / F.lit(float(16 ** 12))


def uniforms(df: DataFrame, parts: Sequence[str], endings: Mapping[str, Sequence[str | int]]) -> DataFrame:
    """`df` with a column for each ending: uniform(*parts, *ending[:-1], seed=ending[-1]), hashed a batch at a time."""
    # the joint after the last part goes where all parts are null
    text = F.concat_ws("|", *[F.col(p).cast("string") for p in parts], F.lit(""))
    tails = ["|".join(map(str, e)) for e in endings.values()]
    schema = StructType([*df.schema.fields, *[StructField(name, DoubleType(), False) for name in endings]])

    def run(batches):
        for batch in batches:
            made = [pa.array(v) for v in unit_hashes(batch.column(batch.num_columns - 1), tails)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *made], names=[*batch.schema.names[:-1], *endings])

    return df.withColumn("__text", text).mapInArrow(run, schema)


def normal(*parts: Column | str, seed: int = 42) -> Column:
    """Standard normal number from two hashes (Box-Muller)."""
    return box_muller(uniform(*parts, F.lit("a"), seed=seed), uniform(*parts, F.lit("b"), seed=seed))


def box_muller(a: Column, b: Column) -> Column:
    return F.sqrt(-2.0 * F.log(F.greatest(a, F.lit(1e-12)))) * F.cos(2.0 * np.pi * b)


def first_by_hash(df: DataFrame, keys: Sequence[str], key: str, limits: DataFrame, seed: int = 42,
                  alias: str = "chosen") -> DataFrame:
    """Mark the first `__limit` rows of each group in hash order."""
    keys = list(keys)
    rows = df.withColumn("__h", hash_order(key, seed=seed)).withColumn("__s", hash_slice("__h", SLICES))
    cells = rows.groupBy(*keys, "__s").agg(F.count(F.lit(1)).alias("__n"))
    w = (W.partitionBy(*keys) if keys else W.partitionBy(F.lit(0))).orderBy("__s")
    upto = cells.withColumn("__cum", F.sum("__n").over(w.rowsBetween(W.unboundedPreceding, 0)))
    quota = on_keys(upto, limits, keys) if keys else upto.withColumn("__limit", limits.select("__limit").scalar())
    edge = quota.filter(F.col("__cum") > F.col("__limit")).groupBy(*keys).agg(
        F.min("__s").alias("__edge"),
        F.min_by(F.col("__limit") - F.col("__cum") + F.col("__n"), "__s").alias("__rest"))
    if keys:
        cut = on_keys(rows, edge, keys, "left")
    else:
        packed = edge.select(F.struct("__edge", "__rest").alias("r")).scalar()
        cut = rows.withColumn("__r", packed).select("*", "__r.*").drop("__r")
    sure = cut.filter(F.col("__edge").isNull() | (F.col("__s") != F.col("__edge"))) \
        .withColumn(alias, F.col("__edge").isNull() | (F.col("__s") < F.col("__edge")))
    local = F.row_number().over(W.partitionBy(*keys, "__s").orderBy("__h", key))
    tight = cut.filter(F.col("__s") == F.col("__edge")).withColumn(alias, local <= F.col("__rest"))
    return sure.unionByName(tight).drop("__h", "__s", "__edge", "__rest")


def class_counts(df: DataFrame, label: str) -> DataFrame:
    return df.groupBy(label).agg(F.count(F.lit(1)).alias("__n"))


def random_split(df: DataFrame, key: str, test_ratio: float, seed: int = 42) -> DataFrame:
    """`split` test for exactly ceil(n · ratio) rows, train for the rest."""
    quota = df.agg(F.ceil(F.count(F.lit(1)) * F.lit(test_ratio)).alias("__limit"))
    return first_by_hash(df, [], key, quota, seed, "__t") \
        .withColumn("split", F.when(F.col("__t"), "test").otherwise("train")).drop("__t")


def stratified_quota(counts: DataFrame, label: str, ratio: float) -> DataFrame:
    """Rows per class adding up to ceil(n · ratio): proportional shares, the
    largest remainders rounded up (ties by label)."""
    w = W.partitionBy(F.lit(0))  # over the class table only
    total = F.sum("__n").over(w)
    share = F.ceil(total * F.lit(ratio)) * F.col("__n") / total
    parts = counts.withColumn("__all", F.ceil(total * F.lit(ratio))).withColumn("__share", share) \
        .withColumn("__base", F.floor("__share"))
    order = W.partitionBy(F.lit(0)).orderBy(F.desc(F.round(F.col("__share") - F.col("__base"), 9)), label)
    left = F.col("__all") - F.sum("__base").over(w)
    return parts.withColumn("__extra", (F.row_number().over(order) <= left).cast("int")) \
        .select(label, (F.col("__base") + F.col("__extra")).alias("__limit"))


def stratified_split(df: DataFrame, key: str, label: str, test_ratio: float, seed: int = 42,
                     names: tuple[str, str] = ("test", "train"), alias: str = "split") -> DataFrame:
    """Exact class shares; plain random when a class has fewer than two rows."""
    counts = class_counts(df, label)
    smallest = counts.agg(F.min("__n")).first()[0]
    if smallest is None or smallest < 2:
        return random_split(df, key, test_ratio, seed).withColumnRenamed("split", alias)
    quota = stratified_quota(counts, label, test_ratio)
    return first_by_hash(df, [label], key, quota, seed, "__t") \
        .withColumn(alias, F.when(F.col("__t"), names[0]).otherwise(names[1])).drop("__t")


def three_way_split(df: DataFrame, key: str, label: str, test: float = 0.15, val: float = 0.15,
                    seed: int = 42) -> DataFrame:
    """Test first, then validation as val / (1 - test) of the rest."""
    first = stratified_split(df, key, label, test, seed)
    rest = first.filter(F.col("split") == "train").drop("split")
    second = stratified_split(rest, key, label, val / (1.0 - test), seed + 1, ("val", "train"))
    return first.filter(F.col("split") == "test").unionByName(second)


def ratio_split_per_label(df: DataFrame, key: str, label: str, train_ratio: float = 0.8, seed: int = 42) -> DataFrame:
    quota = class_counts(df, label).select(label, F.floor(F.col("__n") * F.lit(train_ratio)).alias("__limit"))
    return first_by_hash(df, [label], key, quota, seed, "__t") \
        .withColumn("split", F.when(F.col("__t"), "train").otherwise("test")).drop("__t")


def stratified_kfold(df: DataFrame, key: str, label: str, folds: int = 5, seed: int = 42) -> DataFrame:
    """Fold id per row, classes dealt out evenly in hash order. Every class needs
    a row per fold, and a fold three rows."""
    facts = class_counts(df, label).agg(F.sum("__n").alias("n"), F.min("__n").alias("lo")).first()
    k = folds
    if k < 2 or (facts["n"] or 0) < 3 * k or (facts["lo"] or 0) < k:
        raise ValueError(f"{k} folds need more rows: n={facts['n']}, smallest class={facts['lo']}")
    rows = df.withColumn("__h", hash_order(key, seed=seed))
    return ranked(rows, [label], "__h", [key], hashed=True) \
        .withColumn("fold", ((F.col("rn") - 1) % k).cast("int")).drop("__h", "rn")


def row_cap_sample(df: DataFrame, key: str, n: int, seed: int = 42) -> DataFrame:
    """Exactly min(n, rows) rows in hash order."""
    quota = df.sparkSession.range(1).select(F.lit(n).alias("__limit"))
    return first_by_hash(df, [], key, quota, seed, "__t").filter("__t").drop("__t")


def downsample(df: DataFrame, key: str, label: str, seed: int = 42) -> DataFrame:
    """Every class cut to the smallest."""
    counts = class_counts(df, label)
    quota = counts.select(label, F.min("__n").over(W.partitionBy(F.lit(0))).alias("__limit"))
    return first_by_hash(df, [label], key, quota, seed, "__t").filter("__t").drop("__t")


DRAW_CHUNK = 100_000


def draws(counts: DataFrame, label: str, need: Column) -> DataFrame:
    """(label, __size, draw): one row per extra row a class needs. `counts` is the
    class table (label, __n); the draws of a class are made in chunks by many tasks.

    Spark takes the draws for as small as the class table. So the number of tasks is stated, or
    one would make them all, and a join is to sort, or they would be sent whole to every task."""
    at = F.col("__chunk") * DRAW_CHUNK
    return (counts.select(label, F.col("__n").alias("__size"), need.cast("long").alias("__need")).filter("__need > 0")
            .withColumn("__chunk", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("__need") - 1) / DRAW_CHUNK))))
            .repartition(slice_count(counts), label, "__chunk")
            .select(label, "__size", F.explode(F.sequence(at + 1, F.least(at + DRAW_CHUNK, F.col("__need")))).alias("draw"))
            .hint("merge"))


def largest(counts: DataFrame) -> DataFrame:
    """The class table with the size of the largest class."""
    return counts.withColumn("__top", F.max("__n").over(W.partitionBy(F.lit(0))))


def pick_rank(seed: int, *parts: str) -> Column:
    """Rank of the row a draw copies: hash of the draw modulo the class size."""
    return (F.floor(uniform(*parts, seed=seed) * F.col("__size")) + 1).cast("long")


def upsample(df: DataFrame, key: str, label: str, seed: int = 42) -> DataFrame:
    """Every class raised to the largest: all originals, and copies drawn with
    replacement (`copy` > 0). Draws meet rows on (class, rank), an even join."""
    pool = ranked(df.withColumn("__h", hash_order(key, seed=seed)), [label], "__h", [key], hashed=True,
                  rank="__rank").drop("__h")
    wanted = draws(largest(class_counts(df, label)), label, F.col("__top") - F.col("__n"))
    drawn = wanted.withColumn("__rank", pick_rank(seed, label, "draw")).drop("__size")
    extra = on_keys(drawn, pool, [label, "__rank"]).withColumn("copy", F.col("draw")).drop("draw", "__rank")
    return df.withColumn("copy", F.lit(0).cast("long")).unionByName(extra.select(*df.columns, "copy"))


def smote(df: DataFrame, key: str, vec: str, label: str, k: int = 5, seed: int = 42, share: float | None = None) -> DataFrame:
    """(label, vector, synthetic): originals and rows between a row and one of its k nearest of the same
    class, until all classes are equal.

    Only drawn rows of classes that are short ask for neighbours, and only rows of their class answer. With
    `share`, they read that share of the cells of a neighbour index; without, the search is exact: classes
    are kept apart by a coordinate that is far larger than any distance inside a class."""
    double = F.transform(vec, lambda x: x.cast("double"))
    originals = df.select(label, double.alias(vec), F.lit(False).alias("synthetic"))
    counts = largest(class_counts(df, label))
    pool = ranked(df.withColumn("__h", hash_order(key, seed=seed)), [label], "__h", [key], hashed=True, rank="__rank")
    wanted = draws(counts, label, F.col("__top") - F.col("__n")).withColumn("__rank", pick_rank(seed, label, "draw")).drop("__size")
    base = cut_lineage(on_keys(wanted, pool, [label, "__rank"]).select(label, "draw", key, double.alias(vec)), "drawn")
    if base.isEmpty():
        return originals
    short = counts.where("__n < __top").select(F.col(label).alias("__short"))
    members = cut_lineage(df.join(short, F.col(label).eqNullSafe(F.col("__short")), "left_semi").select(
        key, label, double.alias(vec)), "members")
    asked = base.select(key, label, vec).dropDuplicates([key])
    if share is not None:
        index = vector_index.build(members, key, vec, group=label)
        near = vector_index.search(index, asked, key, vec, k, max(1, math.ceil(share * index.cells)), group=label, exclude_self=True)
    else:
        span = members.agg(F.max(F.aggregate(vec, F.lit(0.0), lambda a, x: a + x * x))).first()[0] or 1.0
        coded = counts.select(label, ((F.row_number().over(W.partitionBy(F.lit(0)).orderBy(label)) - 1)
                                      * F.lit(10.0 * span ** 0.5 + 1.0)).alias("__code"))
        wide = lambda rows: on_keys(rows, coded, [label]).select(F.col(key).alias("id"), F.concat(vec, F.array("__code")).alias("v"))
        near = knn.nearest(wide(asked), wide(members), "id", "v", k=k, exclude_self=True)
    names = members.select(F.col(key).alias("candidate_id"), F.col(label).alias("__cl"), F.col(vec).alias("__cv"))
    own = asked.select(F.col(key).alias("query_id"), F.col(label).alias("__ql"))
    same = near.join(own, "query_id").join(names, "candidate_id").filter(F.col("__ql").eqNullSafe(F.col("__cl")))
    order = W.partitionBy("query_id").orderBy("place")
    same = same.withColumn("__pos", F.row_number().over(order)).select("query_id", "__pos", "__cv")  # <= k rows each
    same = cut_lineage(same, "neighbours")
    reach = same.groupBy(F.col("query_id").alias("__asked")).agg(F.max("__pos").alias("__reach"))
    drawn = base.join(reach, F.col(key) == F.col("__asked"), "left")
    step = uniform(label, "draw", F.lit("gap"), seed=seed)
    pos = (F.floor(uniform(label, "draw", F.lit("pos"), seed=seed) * F.col("__reach")) + 1).cast("int")
    # a class of one row has no neighbour: its copies stay on the row
    made = (drawn.withColumn("__p", pos).withColumn("__step", step)
            .join(same, (F.col(key) == F.col("query_id")) & (F.col("__p") == F.col("__pos")), "left")
            .select(F.col(label), F.when(F.col("__cv").isNull(), F.col(vec))
                    .otherwise(F.zip_with(vec, "__cv", lambda a, b: a + F.col("__step") * (b - a)))
                    .alias(vec), F.lit(True).alias("synthetic")))
    return originals.unionByName(made)


def smote_sparse(docs: DataFrame, weights: DataFrame, key: str, label: str, term: str = "term", weight: str = "weight",
                 k: int = 5, seed: int = 42, postings: int = ROW_BLOCK) -> DataFrame:
    """(label, draw, base, other, step, term, weight): synthetic sparse rows that raise every class to the largest.

    `docs` holds (key, label), `weights` the rows' positive weights (key, term, weight). A synthetic row lies
    the share `step` of the way from a drawn row to one of its k nearest of its class; a drawn row that shares
    no term with another of its class, or is alone, is copied (`other` null). A drawn row without any
    weight gives one line without a term."""
    counts = largest(class_counts(docs, label))
    pool = ranked(docs.select(key, label).withColumn("__h", hash_order(key, seed=seed)), [label], "__h", [key], hashed=True, rank="__rank")
    wanted = draws(counts, label, F.col("__top") - F.col("__n")).withColumn("__rank", pick_rank(seed, label, "draw")).drop("__size")
    base = cut_lineage(on_keys(wanted, pool, [label, "__rank"]).select(label, "draw", F.col(key).alias("base")), "drawn")
    short = counts.where("__n < __top").select(F.col(label).alias("__short"))
    members = docs.select(key, label).join(short, F.col(label).eqNullSafe(F.col("__short")), "left_semi")
    rows = weights.select(F.col(key).alias("__k"), F.col(term).alias("term"), F.col(weight).cast("double").alias("weight"))
    # a null class is a class of its own, apart from one that is called so
    named = F.to_json(F.struct(F.col(label).alias("c")))
    held = cut_lineage(members.withColumn("__g", named).join(rows, F.col(key) == F.col("__k")).select("__k", "__g", "term", "weight"), "members")
    asked = held.join(base.select(F.col("base").alias("__k")).distinct(), "__k", "left_semi")
    near = cut_lineage(nearest_rows(asked, held, "__k", k=k, group="__g", postings=postings), "neighbours")
    reach = near.groupBy(F.col("query_id").alias("base")).agg(F.max("place").alias("__reach"))
    pos = (F.floor(uniform(label, "draw", F.lit("pos"), seed=seed) * F.col("__reach")) + 1).cast("int")
    made = base.join(reach, "base", "left").withColumn("place", pos).join(
        near.select(F.col("query_id").alias("base"), "place", F.col("candidate_id").alias("other")), ["base", "place"], "left")
    step = F.when(F.col("other").isNotNull(), uniform(label, "draw", F.lit("gap"), seed=seed)).otherwise(F.lit(0.0))
    made = cut_lineage(made.select(label, "draw", "base", "other", step.alias("step")), "made")
    # the weights of a row travel as one array, and the lines of a synthetic row are made and added up where it lies
    names = [label, "draw", "base", "other", "step"]
    used = made.select(F.col("base").alias("__k")).unionByName(made.select(F.col("other").alias("__k"))).distinct()
    packed = cut_lineage(rows.join(used, "__k", "left_semi").groupBy("__k").agg(F.collect_list(F.struct("term", "weight")).alias("__terms")), "packed")
    scaled = lambda share: F.transform("__terms", lambda e: F.struct(e["term"].alias("term"), (share * e["weight"]).alias("weight")))
    own = made.join(packed, F.col("base") == F.col("__k"), "left").select(*names, scaled(1 - F.col("step")).alias("__terms"))
    far = made.join(packed, F.col("other") == F.col("__k")).select(*names, scaled(F.col("step")).alias("__terms"))
    lines = own.unionByName(far).repartition(label, "draw").select(*names, F.explode_outer("__terms").alias("__e"))
    return lines.select(*names, "__e.term", "__e.weight").groupBy(*names, "term").agg(F.sum("weight").alias("weight"))


def bootstrap(df: DataFrame, key: str, n: int, seed: int = 42) -> DataFrame:
    """n rows drawn with replacement."""
    total = df.count()
    pool = ranked(df.withColumn("__h", hash_order(key, seed=seed)), [], "__h", [key], hashed=True, rank="__rank").drop("__h")
    drawn = df.sparkSession.range(1, n + 1).select(F.col("id").alias("draw"), F.lit(total).alias("__size")) \
        .withColumn("__rank", pick_rank(seed, "draw")).drop("__size")
    return drawn.join(pool, "__rank").drop("__rank")


def synth_classification(df: DataFrame, key: str, label: str, numeric: Sequence[str], categorical: Sequence[str],
                         per_class: int, noise: float = 0.05, seed: int = 42) -> DataFrame:
    """Per class: interpolate two of its rows (step in [-0.2, 1.2]), add normal
    noise of `noise` deviations; categories come from a random row."""
    pool = ranked(df.select(label, key, *numeric, *categorical).withColumn("__h", hash_order(key, seed=seed)),
                  [label], "__h", [key], hashed=True, rank="__rank").drop("__h", key)
    # three draws meet the ranked rows: they are ranked once
    pool = cut_lineage(pool, "pool")
    sd = df.groupBy(label).agg(*[(F.stddev_pop(c) + 1e-8).alias(f"__sd_{c}") for c in numeric])
    d = uniforms(draws(class_counts(df, label), label, F.lit(per_class)), [label, "draw"],
                 {"__first": [seed], "__hop": ["j", seed], "__other": [seed + 1]})
    spot = lambda u: (F.floor(F.col(u) * F.col("__size")) + 1).cast("long")  # noqa: E731  as pick_rank
    # the second row differs from the first wherever the class has two rows
    hop = F.floor(F.col("__hop") * (F.col("__size") - 1)) + 1
    d = d.withColumn("__i", spot("__first")).withColumn(
        "__j", F.when(F.col("__size") > 1, (F.col("__i") - 1 + hop) % F.col("__size") + 1).otherwise(F.col("__i")).cast("long")) \
        .withColumn("__c", spot("__other")).select(label, "draw", "__i", "__j", "__c")
    a = on_keys(d.withColumn("__rank", F.col("__i")).drop("__i"), pool.drop(*categorical), ["__rank", label]).drop("__rank")
    b = pool.select(label, F.col("__rank"), *[F.col(c).alias(f"__b_{c}") for c in numeric])
    ab = on_keys(a.withColumn("__rank", F.col("__j")).drop("__j"), b, ["__rank", label]).drop("__rank")
    if categorical:
        ab = on_keys(ab.withColumn("__rank", F.col("__c")), pool.select(label, "__rank", *categorical), ["__rank", label]).drop("__rank")
    out = uniforms(ab.drop("__c"), [label, "draw"], {"__alpha": ["alpha", seed]} | {
        f"__{name}_{c}": [c, part, seed] for c in numeric for name, part in (("n", "a"), ("m", "b"))})
    out = on_keys(out, sd, [label])
    step = F.col("__alpha") * 1.4 - 0.2
    made = {c: F.col(c) + step * (F.col(f"__b_{c}") - F.col(c)) + box_muller(F.col(f"__n_{c}"), F.col(f"__m_{c}")) * noise * F.col(f"__sd_{c}")
            for c in numeric}
    return out.select(label, "draw", *[e.alias(c) for c, e in made.items()], *categorical)


def synth_regression(df: DataFrame, columns: Sequence[str], n: int, noise: float = 0.05, seed: int = 42) -> DataFrame:
    """n rows from the normal law with the table's mean and covariance, plus noise.

    Only the d·d moments come to the driver.
    """
    columns = list(columns)
    pairs = [(i, j) for i in range(len(columns)) for j in range(i + 1)]
    row = df.agg(*[F.avg(c).alias(f"m{i}") for i, c in enumerate(columns)],
                 *[F.covar_samp(columns[i], columns[j]).alias(f"c{i}_{j}") for i, j in pairs]).first()
    cov = np.zeros((len(columns), len(columns)))
    for i, j in pairs:
        cov[i, j] = cov[j, i] = row[f"c{i}_{j}"]
    root = np.linalg.cholesky(cov + np.eye(len(columns)) * 1e-9 * max(1e-12, np.trace(cov)))
    base = df.sparkSession.range(n).withColumnsRenamed({"id": "draw"})
    z = base.withColumns({f"__z{i}": normal("draw", F.lit(i), seed=seed) for i in range(len(columns))})
    out = []
    for i, c in enumerate(columns):
        value = F.lit(float(row[f"m{i}"])) + normal("draw", F.lit(f"noise{i}"), seed=seed) * float(noise * cov[i, i] ** 0.5)
        for j in range(i + 1):
            value = value + F.col(f"__z{j}") * float(root[i, j])
        out.append(value.alias(c))
    return z.select("draw", *out)


def synth_mixture(df: DataFrame, vec: str, n: int, parts: int, seed: int = 42, max_iter: int = 10) -> DataFrame:
    """n rows from a fitted mixture of `parts` normals, labelled by k-means."""
    from pyspark.ml.clustering import GaussianMixture, KMeans

    data = df.select(array_to_vector(F.transform(vec, lambda x: x.cast("double"))).alias("features"))
    model = GaussianMixture(k=parts, maxIter=max_iter, seed=seed).fit(data)
    weights = np.cumsum(model.weights)
    gauss = model.gaussiansDF.collect()  # one row per part
    mean = np.array([g["mean"].toArray() for g in gauss])
    roots = np.array([_root(g["cov"].toArray()) for g in gauss])
    shared = df.sparkSession.sparkContext.broadcast((weights, mean, roots))
    dims = mean.shape[1]

    def sample(batches):
        import pandas as pd

        weights, mean, roots = shared.value
        for pdf in batches:
            at = np.minimum(np.searchsorted(weights, pdf["u"].to_numpy()), len(mean) - 1)
            z = np.stack([np.random.default_rng([seed, int(i)]).standard_normal(dims) for i in pdf["draw"]])
            x = mean[at] + np.einsum("nij,nj->ni", roots[at], z)
            yield pd.DataFrame({"draw": pdf["draw"], "component": at.astype("int32"), "v": list(x)})

    made = df.sparkSession.range(n).select(F.col("id").alias("draw"), uniform("id", seed=seed).alias("u")) \
        .mapInPandas(sample, "draw bigint, component int, v array<double>")
    featured = made.withColumn("features", array_to_vector("v"))
    km = KMeans(k=parts, seed=seed, predictionCol="label").fit(featured)
    return km.transform(featured).select("draw", "component", F.col("v").alias(vec), "label")


def _root(cov: np.ndarray) -> np.ndarray:
    values, vectors = np.linalg.eigh(cov)
    return vectors * np.sqrt(np.maximum(values, 0.0))
