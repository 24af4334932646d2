"""Classifiers on held-out rows and odd input; rules against SQL and brute force."""

import re
import zlib

import duckdb
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from haltgate.llm import quality_classifier, quality_rules, queries, toxicity

from .conftest import ODD

# -- rules ------------------------------------------------------------------------


def slow_rules(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    again = {i + k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(8)}
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    failed = len(words) < 20 or 100 * len(again) > 30 * len(words)
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(again), failed)


def made():
    rng = np.random.default_rng(2)
    rows = []
    for k in range(60):
        words = [str(w) for w in rng.choice(["a", "the", "é#", "of\n", "b|", "x\ty", "!"], int(rng.integers(0, 60)))]
        rows.append(" ".join(words * int(rng.integers(1, 3))))
    return [*rows, "a " * 30, "a b c d e f g h " * 2, "w " * 7, *[t for _, t in ODD]]


def test_counts(spark):
    rows = list(enumerate(made()))
    got = quality_rules.judge(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    for r in got:
        expected = slow_rules(rows[r.doc.doc_id][1])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == expected
        assert not (r.kept and r.base_failed)


def test_rules_match_sql(spark, sf):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{sf}/documents.parquet')")
    df = queries.QUERIES["op7_quality_rules"](spark, sf)
    res = con.execute(queries.ORACLE_SQL["op7_quality_rules"])
    cols = [d[0] for d in res.description]
    assert sorted(cols) == sorted(df.columns)
    assert sorted(map(tuple, df.select(*cols).collect())) == sorted(res.fetchall())


def test_rules_are_native(spark, sf):
    plan = queries.QUERIES["op7_quality_rules"](spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Exchange", plan)


def test_rules_odd_rows(odd, nothing):
    assert quality_rules.judge(odd).count() == len(ODD)
    kept = quality_rules.kept_documents(odd, thresholds=())
    assert kept.columns == odd.columns and [r.doc_id for r in kept.collect()] == []
    assert quality_rules.judge(nothing).collect() == []


def test_table_is_compiled(spark):
    df = spark.createDataFrame([(1, " ".join(f"w{i}" for i in range(30))), (2, "the " + " ".join(f"w{i}" for i in range(30)))], "doc_id long, text string")
    kept = [r.doc_id for r in quality_rules.kept_documents(df, (("stop_word_ratio", 0.01, 0.5),)).collect()]
    assert kept == [2]


# -- classifiers ----------------------------------------------------------------------


@pytest.mark.parametrize("name,label,fold", [("op2_quality_classifier", "quality", (4, 2)), ("op10_toxicity", "toxic", (5, 0))])
def test_held_out_accuracy(spark, name, label, fold):
    sf = "/root/testdata/sf0.1"
    import zlib

    labels = {r.doc_id: r[label] for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    got = queries.QUERIES[name](spark, sf).collect()
    assert len(got) == spark.read.parquet(f"{sf}/documents.parquet").count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % fold[0] == fold[1]) and 0 <= r.score <= 1 for r in got)
    held = [(r.predicted, labels[r.doc_id]) for r in got if r.held_out and r.doc_id in labels]
    assert np.mean([p == y for p, y in held]) > 0.97
    negatives = [p for p, y in held if y == (1 if label == "quality" else 0)]
    assert np.mean([p == (label == "quality") for p in negatives]) > 0.99


def odd_labels(spark, label):
    rows = [(d, k % 2) for k, (d, _) in enumerate(ODD)]
    return spark.createDataFrame(rows + [(99, None)], f"doc_id long, {label} int")


@pytest.mark.parametrize("module,label", [(quality_classifier, "quality"), (toxicity, "toxic")])
def test_classifiers_on_odd_rows(spark, odd, nothing, module, label):
    labels = odd_labels(spark, label)
    got = module.classify(odd, labels).collect()
    assert len(got) == len(ODD) and all(0 <= r.score <= 1 for r in got)
    by_text = {}
    for r in got:
        assert by_text.setdefault(r.doc.text or "", r.score) == r.score
    assert module.classify(nothing, labels).collect() == []
    assert all(r.score == 0.5 for r in module.classify(odd, labels.limit(0)).collect())
    only = spark.createDataFrame([(1, 1)], f"doc_id long, {label} int")
    assert len(module.classify(odd, only).collect()) == len(ODD)


def test_held_out_labels_are_not_read(spark, docs, sf):
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    for module, label, folds, fold in ((quality_classifier, "quality", 4, 2), (toxicity, "toxic", 5, 0)):
        held = quality_classifier.held_out(labels.doc_id, folds, fold)
        turned = labels.withColumn(label, __import__("pyspark").sql.functions.when(held, 1 - labels[label]).otherwise(labels[label]))
        a, b = ([(r.doc.doc_id, r.score) for r in module.classify(docs, x).collect()] for x in (labels, turned))
        assert sorted(a) == sorted(b)


def test_trees_split_where_labels_do():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(2000, 3))
    y = ((x[:, 0] > 0.3) & (x[:, 1] < 0.5)).astype(float)
    model = quality_classifier.grow(x, y)
    assert ((model.score(x) > 0.5) == y).mean() > 0.98
    one = model.raw(x[:5])
    for k in range(5):  # the walk of one row, node by node
        total = model.bias
        for t in range(len(model.feature)):
            node = 0
            while model.feature[t, node] >= 0:
                node = 2 * node + 1 + (x[k, model.feature[t, node]] > model.threshold[t, node])
            total += model.value[t, node]
        assert abs(total - one[k]) < 1e-9


@settings(max_examples=200, deadline=None)
@given(st.text(max_size=80))
def test_statistics_are_finite(text):
    got = quality_classifier.statistics(text.encode("utf-8", "ignore").decode())
    assert len(got) == len(quality_classifier.STATISTICS) and np.isfinite(got).all()


def test_pairs_keep_group_names_neutral():
    """Group names that go with the label in the data lose their weight under the pairs."""
    rows = [[0, 1], [0], [0, 1], [1]] * 20 + [[2], [2], [0, 2], []] * 20
    y = np.array([1.0] * 80 + [0.0] * 80)
    pairs = [([0], []), ([0], [3])] * 40
    free, _ = toxicity.fit(rows, y, pairs, 4, pair_weight=0.0)
    tied, _ = toxicity.fit(rows, y, pairs, 4, pair_weight=50.0)
    assert free[0] > 0.5 and abs(tied[0]) < 0.2 * free[0] and tied[1] > 1


def test_counterfactual_swaps_or_plants():
    a, b = toxicity.counterfactual("We met. The women came. Fine.")
    assert a == "We met. The women came. Fine." and "women" not in b.split(". ")[1:2]
    a, b = toxicity.counterfactual("Nobody is named here.")
    known = set(toxicity.IDENTITY_TERMS)
    assert len(known & toxicity.words_of(a)) == len(known & toxicity.words_of(b)) == 1 and a != b
    assert toxicity.counterfactual(None) == toxicity.counterfactual("")


def test_planted_names_do_not_raise_scores(spark):
    from haltgate.sources.tables import read_table

    sf = "/root/testdata/sf0.01"
    docs = read_table(spark, sf, "documents")
    model = toxicity.train(docs, read_table(spark, sf, "labels"))
    texts = [r.text for r in docs.select("text").limit(50).collect()]
    plain = model.score(texts)
    for term in ("women", "muslims", "gay", "immigrants"):
        assert np.abs(model.score([f"{t} The {term} were there." for t in texts]) - plain).max() < 0.02


def test_repeats_of_a_labelled_id_count_once(spark, docs, sf):
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    rows = lambda d, n: quality_classifier.training_rows(d, labels, "quality", 4, 2, n).collect()
    plain = rows(docs, 20_000)
    hot = docs.where(docs.doc_id == plain[0].doc_id).select("doc_id", "text")
    times = spark.range(300).withColumnRenamed("id", "k")
    repeated = docs.select("doc_id", "text").unionByName(hot.crossJoin(times).drop("k"))
    assert sorted(rows(repeated, 20_000)) == sorted(plain)
    a, b = (quality_classifier.train(d, labels) for d in (docs, repeated))
    assert a.bias == b.bias and (a.value == b.value).all() and (a.threshold == b.threshold).all()
    many = hot.crossJoin(times).selectExpr("doc_id", "concat(text, ' ', k) as text")
    one = labels.where(labels.doc_id == plain[0].doc_id)
    assert len(quality_classifier.training_rows(many, one, "quality", 4, 2, 40).collect()) == 40


def test_toxicity_rows_are_bounded(spark, docs, sf, monkeypatch):
    """A labelled id with many texts gives the driver no more rows than the bound."""
    from haltgate.sources.tables import read_table

    seen = []
    fit = toxicity.fit
    monkeypatch.setattr(toxicity, "fit", lambda rows, *a, **k: seen.append(len(rows)) or fit(rows, *a, **k))
    labels = read_table(spark, sf, "labels")
    marked = labels.where("toxic = 1").select("doc_id").collect()
    one = next(r.doc_id for r in marked if zlib.crc32(str(r.doc_id).encode()) % 5)
    many = spark.range(900).selectExpr(f"{one}L AS doc_id", "concat('text number ', id) AS text")
    toxicity.train(docs.select("doc_id", "text").unionByName(many), labels, rows=100)
    assert seen == [100]
