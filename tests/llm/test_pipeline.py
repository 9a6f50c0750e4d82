from collections import Counter

import corpus_pipeline

from placeweave.llm import QUERIES, SQL

from .conftest import words


def test_registered_queries():
    numbers = sorted(int(name.split("_")[0][2:]) for name in QUERIES)
    assert numbers == list(range(1, 14)) and set(SQL) <= set(QUERIES)


def test_stages_take_effect(spark, docs_of, on_disk, tmp_path):
    """Against what each stage must do to a small corpus, by hand."""
    english = "the house was near the river and they walked home through the wood after the rain had gone"
    rows = [(i, f"{english} {words(i, 30)} {english}\nRead more here\n{words(i, 40)} {english}", "en", f"src{i % 16}") for i in range(64)]
    rows += [(100 + i, f"{english} {words(900, 200)} tail{i}", "en", f"src{i}") for i in range(5)]       # near copies
    item = f"What is {words(77, 20)} of the river?"
    rows += [(200, f"{english}. {item} {english}", "en", "src1"), (201, "12 34 !!", "en", "src1"), (202, None, None, None), (64, rows[3][1] + " x", "en", "src3")]
    path = on_disk(docs_of(rows))
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = spark.read.parquet(path)
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        before = docs
        docs = corpus_pipeline.stored(stage(spark, docs, str(tmp_path)), name)
        kept[name] = {r.doc_id for r in docs.select("doc_id").collect()}
        if name != "source_mixing":
            assert docs.columns == before.columns
        if name == "line_dedup":
            assert docs.where("text LIKE '%Read more here%'").count() == 0
            assert docs.where("n_chars <> length(text)").count() == 0
    everyone = {r[0] for r in rows}
    assert kept["language_id"] == everyone - {201, 202}
    assert kept["line_dedup"] == kept["language_id"]
    assert kept["near_dedup"] == kept["line_dedup"] - {101, 102, 103, 104, 64}
    assert kept["benchmark_decontamination"] == kept["near_dedup"] - {200}
    assert kept["source_mixing"] and kept["source_mixing"] <= kept["benchmark_decontamination"]


def test_awkward_rows_and_empty_tables(spark, awkward, nothing, on_disk, tmp_path):
    spark.createDataFrame([(None, None), (1, "")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    for docs in (awkward, nothing):
        rows = docs
        for name, stage in corpus_pipeline.STAGES:
            rows = corpus_pipeline.stored(stage(spark, rows, str(tmp_path)), name)
        assert rows.count() <= docs.count()


def test_stages_send_small_batches_to_python(spark, docs_of):
    setting = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(setting)
    try:
        for given, want in ((10_000, 1_000), (0, 1_000), (300, 300)):
            spark.conf.set(setting, given)
            docs = docs_of([(i, words(i, 20), "en", "src1") for i in range(3)])
            corpus_pipeline.STAGES[0][1](spark, docs, "")
            assert int(spark.conf.get(setting)) == want
    finally:
        spark.conf.set(setting, before)


def test_languages_are_judged_once_a_text(spark, docs_of):
    """A filter on the verdict that is pushed below it makes every text pass through two judges, in twice as many workers."""
    docs = docs_of([(i, f"the house was near the river {words(i, 20)}", "en", "src1") for i in range(8)])
    judged = corpus_pipeline.language_id(spark, docs, "")
    assert judged._jdf.queryExecution().executedPlan().toString().count("ArrowEvalPython") == 1


def test_near_copies_go_without_a_shuffle_of_all_texts(spark, docs_of):
    setting = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(setting)
    rows = [(i, words(i, 60)) for i in range(6)] + [(7, words(1, 60)), (8, f"{words(2, 60)} tail"), (3, words(3, 60)), (None, words(4, 60)), (None, None), (9, None), (9, None)]
    try:
        spark.conf.set(setting, -1)
        left = corpus_pipeline.near_dedup(spark, docs_of(rows), "")
        assert "SortMergeJoin" not in left._jdf.queryExecution().executedPlan().toString()
        got = Counter((r.doc_id, r.text) for r in left.select("doc_id", "text").collect())
    finally:
        spark.conf.set(setting, before)
    assert got == Counter([*((i, words(i, 60)) for i in range(6)), (None, words(4, 60)), (None, None), (9, None)])
