"""The pipeline against brute force after its first stage, and its contract."""

import zlib

import pytest

corpus_pipeline = pytest.importorskip("corpus_pipeline")

from . import brute  # noqa: E402

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = corpus_pipeline.table(spark, SF, "documents")
    items = {r.item_id: r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()}
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["toxicity", "line_dedup", "jaccard_join", "decontaminate", "byte_bpe"]
    kept = None
    for name, stage in corpus_pipeline.STAGES:
        before, docs = kept, corpus_pipeline.stored(stage(spark, docs, SF), name)
        if name == "byte_bpe":
            assert {r.doc_id for r in docs.collect()} == set(before)
            continue
        assert docs.columns == corpus_pipeline.COLUMNS
        kept = {r.doc_id: r.text for r in docs.collect()}
        if name == "line_dedup":
            assert kept == brute.line_dedup(before)
            assert all(r.n_chars == len(r.text) for r in docs.collect() if r.text != before[r.doc_id])
        if name == "jaccard_join":
            assert set(kept) == {i for i, (_, c) in brute.components(before).items() if i == c}
        if name == "decontaminate":
            assert set(kept) == {i for i, x in brute.contamination(before, items).items() if not x[-1]}


def test_run_and_edges(spark, tmp_path):
    rows = [(1, "a b c", "en", "s", 5), (2, None, "en", "s", None), (3, "", None, None, 0), (None, "x y z", "en", "s", 5), (3, "", None, None, 0)]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    d = str(tmp_path)
    spark.createDataFrame(rows, schema).write.parquet(f"{d}/documents.parquet")
    spark.createDataFrame([(1, 0)], "doc_id long, toxic int").write.parquet(f"{d}/labels.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{d}/benchmark.parquet")
    assert corpus_pipeline.run(spark, d).count() == len(rows)


def test_empty_tables_and_clashing_columns(spark, tmp_path):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    d = str(tmp_path / "e")
    spark.createDataFrame([], schema).write.parquet(f"{d}/documents.parquet")
    spark.createDataFrame([], "doc_id long, toxic int").write.parquet(f"{d}/labels.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{d}/benchmark.parquet")
    out = corpus_pipeline.run(spark, d)
    assert out.count() == 0 and out.columns == ["doc_id", "lang", "source", "n_chars", "n_tokens", "ids"]
    d = str(tmp_path / "c")
    clash = ["node", "a", "b", "gram", "_hash", "_text_hash", "start", "ids", "score"]
    rows = [(i, f"words of text {i} " * 9, "en", "s", 1, *([7] * len(clash))) for i in (1, 1, 2)]
    spark.createDataFrame(rows, schema + "".join(f", {c} int" for c in clash)).write.parquet(f"{d}/documents.parquet")
    spark.createDataFrame([(1, 0), (None, 1)], "doc_id long, toxic int").write.parquet(f"{d}/labels.parquet")
    spark.createDataFrame([(1, None)], "item_id long, text string").write.parquet(f"{d}/benchmark.parquet")
    assert sorted(r.doc_id for r in corpus_pipeline.run(spark, d).collect()) == [1, 1, 2]


def test_folds_are_crc32_of_the_id(spark):
    from tickframe.llm.toxicity import fold_of

    assert [r[1] for r in spark.range(50).select("id", fold_of("id")).orderBy("id").collect()] == [zlib.crc32(str(i).encode()) % 4 for i in range(50)]
