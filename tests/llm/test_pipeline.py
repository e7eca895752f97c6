"""The pipeline's stages on one small corpus: what goes, what stays, and odd tables."""

import corpus_pipeline
from tests.llm import cases


def corpus(spark, folder):
    clean = [cases.doc(i, cases.words(i, 90, 3000), source=f"s{i % 3}") for i in range(30)]
    item = cases.words(500, 40)
    rows = [
        *clean,
        cases.doc(100, clean[3][1]), cases.doc(101, clean[4][1] + " one more word"),
        cases.doc(102, cases.words(600, 60, 3000) + " " + item),
        cases.doc(103, cases.words(601, 80, 3000) + ' token = "deadbeefdeadbeefdeadbeefdeadbeef"'),
        cases.doc(104, "too few words"),
        *cases.odd(200),
    ]
    cases.frame(spark, rows).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(1, item), (2, None)], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    labels = [(i, i % 2, int(i % 5 == 0)) for i in range(25)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    return rows


def test_stages(spark, tmp_path):
    corpus(spark, tmp_path)
    assert [name for name, _ in corpus_pipeline.STAGES] == ["line_rules", "jaccard_join", "decontaminate", "secrets", "mixing"]
    got = corpus_pipeline.run(spark, str(tmp_path))
    assert got.columns == ["doc_id", "text", "lang", "source", "n_chars", "mix_rate"]
    out = {r["doc_id"]: r for r in got.collect()}
    assert set(range(30)) <= set(out)  # clean documents stay
    assert not {100, 101, 102, 104, 201, 202, 203} & set(out)
    assert "deadbeef" not in out[103]["text"] and out[103]["n_chars"] == len(out[103]["text"])
    assert all(r["mix_rate"] >= 0 for r in out.values())


def test_empty_tables(spark, tmp_path):
    cases.frame(spark, []).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []


def test_stages_take_extra_columns(spark, tmp_path):
    corpus(spark, tmp_path)
    docs = cases.with_extra(spark.read.parquet(f"{tmp_path}/documents.parquet"))
    for _, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, docs, str(tmp_path))
        assert after.columns == docs.columns and after.count() > 0
