"""The pipeline against its operators applied by hand, on their own inputs."""

import random

import corpus_pipeline
from haltgate.llm import quality_classifier

from .test_dedup import expected_cuts, expected_groups
from .test_quality import slow_rules


def test_stages(spark, sf, docs):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality classifier", "quality rules", "simhash near-dedup", "suffix-array dedup", "packing"]
    tables = [docs]
    for _, stage in corpus_pipeline.STAGES:
        out = stage(spark, tables[-1], sf)
        tables.append(spark.createDataFrame(out.collect(), out.schema))
    for t in tables[:-1]:
        assert t.schema.simpleString() == docs.schema.simpleString()
    rows = [t.collect() for t in tables]
    texts = [{r.doc_id: r.text for r in t} for t in rows[:-1]]

    scored = quality_classifier.classify(docs, spark.read.parquet(f"{sf}/labels.parquet")).collect()
    assert set(texts[1]) == {r.doc.doc_id for r in scored if r.score >= 0.7}
    assert set(texts[2]) <= set(texts[1]) and not any(slow_rules(t)[-1] for t in texts[2].values())
    groups = expected_groups(sorted(texts[2].items()))
    assert set(texts[3]) == {c for _, _, c in groups}
    for d, n, gone, _, _ in expected_cuts(sorted(texts[3].items()), corpus_pipeline.PASSAGE_BYTES):
        assert n - 3 * 20 <= len(texts[4][d].encode()) + gone <= n  # cut code points go whole
    assert {r.doc_id for r in rows[5]} == set(texts[4]) == set(texts[3])


def test_run(spark, sf):
    """The result stays readable; of what the stages wrote, nothing else is left."""
    import os

    from haltgate.session import checkpoint_dir

    held = lambda: {x for x in os.listdir(checkpoint_dir(spark).removeprefix("file:")) if x.startswith("llm-")}
    before, tables = held(), {t.name for t in spark.catalog.listTables()}
    got = corpus_pipeline.run(spark, sf)
    assert got.count() > 0 and {"doc_id", "sequence_id", "offset"} <= set(got.columns)
    assert [x.split("-")[1] for x in held() - before] == ["stage"]
    assert {t.name for t in spark.catalog.listTables()} == tables


def test_shared_passages_of_over_fifty_words_go(spark, sf):
    """Passages of 51 to 70 words in two or more documents are gone, what is theirs alone stays."""
    r = random.Random(4)
    word = lambda: "".join(r.choice("abcdefghijklmnop") for _ in range(r.randint(3, 9)))
    passages = [" ".join(word() for _ in range(n)) for n in range(51, 71)]
    own = [" ".join(word() for _ in range(80)) for _ in range(60)]
    rows = [(k, f"{text} {passages[k % 20]} {text[::-1]}") for k, text in enumerate(own)]
    left = corpus_pipeline.unrepeated(spark, spark.createDataFrame(rows, "doc_id long, text string"), sf).collect()
    for k, text in left:
        assert passages[k % 20] not in text and len(text) < len(rows[k][1]) - 0.95 * len(passages[k % 20])
        assert own[k][:-30] in text and own[k][::-1][30:] in text


def test_odd_rows_through_all_stages(spark, docs, sf):
    """Null ids and texts, repeated ids, a very long text and columns named like those inside."""
    names = ["doc", "row_key", "score", "predicted", "held_out", "fp", "text_id", "kept_text", "range", "words", "root", "copies"]
    base = docs.limit(40).selectExpr("*", *[f"doc_id AS `{n}`" for n in names])
    long_ = docs.selectExpr("max_by(text, n_chars) AS t").first().t
    odd = base.limit(5).collect()
    extra = [odd[0].asDict() | {"doc_id": None}, odd[1].asDict() | {"text": None}, odd[2].asDict(), odd[3].asDict() | {"text": ""},
             odd[4].asDict() | {"text": " ".join(f"{long_} {k}" for k in range(300))}, odd[2].asDict() | {"doc_id": 10**9}]
    table = base.unionByName(spark.createDataFrame([tuple(e[c] for c in base.columns) for e in extra], base.schema))
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, table, sf)
        rows = out.collect()
        if name != "packing":
            assert out.columns == table.columns and len(rows) <= table.count()
        table = spark.createDataFrame(rows, out.schema)
    assert rows


def test_empty_table(spark, docs, sf):
    table = docs.limit(0)
    for _, stage in corpus_pipeline.STAGES:
        table = stage(spark, table, sf)
        assert table.count() == 0
