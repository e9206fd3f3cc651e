"""Steps that were made more than once for one result."""

from tallyloom.operators import features, folds, sampling, vector_index


def watch(monkeypatch, module):
    labels, keep = [], module.cut_lineage
    monkeypatch.setattr(module, "cut_lineage", lambda df, label="stage": (labels.append(label), keep(df, label))[1])
    return labels


def test_an_index_block_holds_a_share_of_every_cell(spark):
    rows = spark.createDataFrame([(i, [float(i % 40), float(i // 40)]) for i in range(1000)], "id long, v array<double>")
    index = vector_index.build(rows, "id", "v", block_rows=400)
    assert [tuple(r) for r in index.sizes.collect()] == [("", 3)]
    assert index.codes.groupBy("block").agg({"cell": "count"}).count() == 3
    found = vector_index.search(index, rows.where("id % 100 = 0"), "id", "v", k=1, probes=index.cells, exclude_self=True).collect()
    assert len(found) == 10 and all(r["distance"] == 1.0 for r in found)


def test_ranked_rows_of_synthesis_are_written_once(spark, monkeypatch):
    labels = watch(monkeypatch, sampling)
    rows = spark.createDataFrame([(i, "ab"[i % 2], float(i), "x") for i in range(20)], "id long, y string, n double, c string")
    assert sampling.synth_classification(rows, "id", "y", ["n"], ["c"], 7).count() == 14 and labels.count("pool") == 1


def test_bands_are_folded_once(spark, monkeypatch):
    labels = watch(monkeypatch, folds)
    rows = spark.createDataFrame([(1, i, 1.0 - 0.0004 * (i // 2), 0.0) for i in range(8)], "g long, id long, a double, f double")
    out = folds.tolerance_bands(rows, ["g"], "a", "f", "id").orderBy("id").collect()
    assert [r["action"] for r in out] == ["definite_delete"] * 6 + ["keep", "duplicate"] and labels.count("bands") == 1


def test_texts_are_cut_into_terms_once(spark, sf_dir, monkeypatch):
    from tallyloom.plans import QUERIES, load_all

    load_all()
    calls, keep = [], features.term_counts
    monkeypatch.setattr(features, "term_counts", lambda *a: (calls.append(1), keep(*a))[1])
    QUERIES["X10_tfidf"](spark, sf_dir)
    assert len(calls) == 1
