"""Counts, shares and determinism of splits, balancing and synthesis."""

import hashlib
import math
import statistics

import pytest
from pyspark.sql import functions as F

from tallyloom.operators import augment, sampling
from tallyloom.operators.ordered import on_keys


@pytest.fixture(scope="module")
def df(spark):
    return spark.range(300).select(
        F.col("id"), F.when(F.col("id") % 10 == 0, "rare").when(F.col("id") % 3 == 0, "mid").otherwise("common").alias("y"),
        F.array((F.col("id") % 7).cast("double"), (F.col("id") % 5).cast("double")).alias("v"), (F.col("id") / 10).alias("x"))


def counts(d, col="y"):
    return {r[0]: r[1] for r in d.groupBy(col).count().collect()}


def test_stratified_split_is_exact(df):
    out = sampling.stratified_split(df, "id", "y", 0.2)
    test, full = counts(out.filter("split = 'test'")), counts(df)
    assert sum(test.values()) == 60
    assert all(abs(test[k] - full[k] * 0.2) < 1 for k in full)
    again = sampling.stratified_split(df.repartition(11), "id", "y", 0.2)
    assert sorted(out.collect()) == sorted(again.collect())


def test_single_row_class_falls_back_to_random(spark):
    d = spark.createDataFrame([(i, "a" if i else "b") for i in range(20)], "id long, y string")
    assert counts(sampling.stratified_split(d, "id", "y", 0.25), "split") == {"test": 5, "train": 15}


def test_three_parts_cover_everything(df):
    out = sampling.three_way_split(df, "id", "y")
    assert out.count() == 300 and out.select("id").distinct().count() == 300
    assert set(counts(out, "split")) == {"train", "val", "test"}


@pytest.mark.parametrize("n,lo,folds,fits", [(30, 10, 5, True), (30, 4, 5, False), (8, 4, 3, False), (30, 10, 1, False)])
def test_folds_are_those_asked_for(spark, n, lo, folds, fits):
    rows = spark.createDataFrame([(i, int(i < lo)) for i in range(n)], "id long, y int")
    if fits:
        assert sampling.stratified_kfold(rows, "id", "y", folds).select("fold").distinct().count() == folds
    else:
        with pytest.raises(ValueError, match="folds need"):
            sampling.stratified_kfold(rows, "id", "y", folds)


def test_draws_are_made_in_chunks(spark, monkeypatch):
    monkeypatch.setattr(sampling, "DRAW_CHUNK", 7)
    rows = spark.createDataFrame([(i, "a" if i < 40 else "b" if i < 43 else None) for i in range(45)], "id long, y string")
    up = sampling.upsample(rows, "id", "y")
    assert {r["y"]: r["count"] for r in up.groupBy("y").count().collect()} == {"a": 40, "b": 40, None: 40}
    many = spark.range(6000).withColumn("y", F.col("id").cast("string")).union(spark.range(6000, 6001).withColumn("y", F.lit("0")))
    assert sampling.upsample(many, "id", "y").count() == 12000


def test_draws_are_made_by_many_tasks_and_sent_to_none_whole(spark, monkeypatch):
    monkeypatch.setattr(sampling, "DRAW_CHUNK", 10)
    rows = spark.createDataFrame([(i, "a" if i < 4 else None) for i in range(6)], "id long, y string")
    made = sampling.draws(sampling.class_counts(rows, "y"), "y", F.lit(300))
    assert made.select(F.spark_partition_id().alias("p")).distinct().count() > 1
    pool = spark.range(1, 40_001, 1, 4).select(F.lit("a").alias("y"), F.col("id").alias("__rank"), F.repeat(F.lit("x"), 400).alias("t"))
    met = on_keys(made.withColumn("__rank", F.col("draw")), pool, ["y", "__rank"])
    assert len(met.collect()) == 300
    assert "BroadcastHashJoin" not in met._jdf.queryExecution().executedPlan().toString()


def test_numbers_hashed_in_batches_are_those_of_the_column(spark):
    labels = ["a", None, "", "é" * 9, "b" * 50, "c" * 400]
    df = spark.range(120).select("id", F.get(F.array(*[F.lit(x) for x in labels]), (F.col("id") % 6).cast("int")).alias("y"))
    got = sampling.uniforms(df, ["y", "id"], {"u": [42], "v": ["alpha", 7]}).withColumns(
        {"eu": sampling.uniform("y", "id"), "ev": sampling.uniform("y", "id", F.lit("alpha"), seed=7)}).collect()
    assert len(got) == 120 and all(r["u"] == r["eu"] and r["v"] == r["ev"] for r in got)
    alone = sampling.uniforms(df, ["y"], {"u": [1]}).withColumn("eu", sampling.uniform("y", seed=1)).collect()
    assert all(r["u"] == r["eu"] for r in alone)


def test_synthetic_rows_lie_between_two_rows_of_their_class(spark):
    rows = spark.createDataFrame([(i, "a" if i < 9 else None if i < 11 else "one", float(i * i), f"c{i}") for i in range(12)],
                                 "id long, y string, x double, c string")
    at = {y: [r for _, r in sorted((hashlib.md5(f"{r.id}|42".encode()).hexdigest(), r) for r in rows.collect() if r.y == y)]
          for y in ("a", None, "one")}
    unit = lambda *p: int(hashlib.md5("|".join(str(x) for x in p if x is not None).encode()).hexdigest()[:12], 16) / 16 ** 12
    got = sampling.synth_classification(rows, "id", "y", ["x"], ["c"], 40).collect()
    assert {(r.y, r.draw) for r in got} == {(y, d) for y in at for d in range(1, 41)} and len(got) == 120
    for r in got:
        own = at[r.y]
        n = len(own)
        i = int(unit(r.y, r.draw, 42) * n)
        j = (i + int(unit(r.y, r.draw, "j", 42) * (n - 1)) + 1) % n if n > 1 else i
        sd = statistics.pstdev(o.x for o in own) + 1e-8
        step = unit(r.y, r.draw, "alpha", 42) * 1.4 - 0.2
        bell = math.sqrt(-2 * math.log(unit(r.y, r.draw, "x", "a", 42))) * math.cos(2 * math.pi * unit(r.y, r.draw, "x", "b", 42))
        assert r.x == pytest.approx(own[i].x + step * (own[j].x - own[i].x) + bell * 0.05 * sd)
        assert r.c == own[int(unit(r.y, r.draw, 43) * n)].c


def test_balancing(df):
    full = counts(df)
    assert set(counts(sampling.downsample(df, "id", "y")).values()) == {min(full.values())}
    up = sampling.upsample(df, "id", "y")
    assert set(counts(up).values()) == {max(full.values())}
    assert up.filter("copy = 0").count() == 300
    # every copy is one of the originals of its class
    assert up.join(df, ["id", "y"], "left_anti").count() == 0


def test_smote_equalises_and_interpolates(df):
    out = sampling.smote(df, "id", "v", "y")
    assert set(counts(out).values()) == {max(counts(df).values())}
    made = [r.v for r in out.filter("synthetic").collect()]
    assert all(0 <= a <= 6 and 0 <= b <= 4 for a, b in made)


def test_caps_and_bootstrap(df):
    assert sampling.row_cap_sample(df, "id", 17).count() == 17
    assert sampling.row_cap_sample(df, "id", 5000).count() == 300
    boot = sampling.bootstrap(df, "id", 500)
    assert boot.count() == 500 and boot.join(df, "id", "left_anti").count() == 0


def test_synthetic_tables_keep_their_law(spark, sf_dir):
    li = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    made = sampling.synth_regression(li, ["l_quantity", "l_extendedprice"], 4000)
    a, b = li.agg(F.avg("l_quantity"), F.corr("l_quantity", "l_extendedprice")).first(), \
        made.agg(F.avg("l_quantity"), F.corr("l_quantity", "l_extendedprice")).first()
    assert abs(a[0] - b[0]) < 1 and abs(a[1] - b[1]) < 0.06


def test_augmentation(spark):
    base = spark.createDataFrame([(i, f"good word number {i} good", i % 3) for i in range(5)], "id long, text string, y int")
    words = {"good": ["fine", "nice"]}
    out = augment.augment_text(base, "id", "text", ["y"], words, factor=3)
    assert out.count() == 15 and out.filter("variant = 0").join(base, ["id", "text", "y"], "left_anti").count() == 0
    swapped = [r.text for r in out.filter("method = 'synonym'").collect()]
    assert all("good" not in t for t in swapped)
    assert sorted(out.collect()) == sorted(augment.augment_text(base.repartition(3), "id", "text", ["y"], words, factor=3).collect())
    assert augment.augment_text(base, "id", "text", ["y"], words, factor=1).count() == 5


def test_dropout_never_empties_a_text():
    assert augment.drop_chars("", 0.5, [1]) == ""
    assert len(augment.drop_chars("abcdefghij", 1.0, [1])) == 3
    assert len(augment.drop_chars("a", 1.0, [1])) == 1
    kept = augment.drop_chars("abcdefghij" * 50, 0.15, [1])
    assert 380 < len(kept) < 470
