import corpus_pipeline
from claimlens.llm import op3_quality_gam
from llm_helpers import SF_DIR


def test_stages_take_effect(spark, tmp_path):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    columns = docs.columns
    counts = [docs.count()]
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, SF_DIR).write.parquet(str(tmp_path / name))
        before, docs = docs, spark.read.parquet(str(tmp_path / name))
        counts.append(docs.count())
        if name != "packing":
            assert docs.columns == columns
        if name == "quality":
            labels = spark.read.parquet(f"{SF_DIR}/labels.parquet")
            kept = {r.doc_id for r in docs.collect()}
            scored = op3_quality_gam.quality(before, labels).collect()
            assert kept == {r.doc_id for r in scored if r.predicted}
        if name == "near_duplicates":
            assert docs.select("text").distinct().count() == docs.count()
        if name == "personal_data":
            assert not [r for r in docs.collect() if "@mail" in r.text]
            assert docs.filter("text like '%[EMAIL]%'").count() > 0
    assert counts[0] > counts[1] > counts[2] >= counts[3] == counts[4] <= counts[5]


def test_names_and_order():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "near_duplicates", "repeats", "personal_data", "packing"]


def test_awkward_rows(spark, awkward, tmp_path):
    docs = awkward
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, SF_DIR).write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
    assert "sequence_id" in docs.columns


def test_near_duplicates_lose_no_text(spark):
    """Null and shared ids are kept apart; only copies go."""
    rows = [(None, "a text of nobody"), (1, "one text of an id"), (1, "another text of it"), (2, "one text of an id"), (1, "one text of an id")]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    got = corpus_pipeline.near_duplicates(spark, docs, SF_DIR).select("doc_id", "text").collect()
    assert sorted(map(tuple, got), key=repr) == sorted(rows[:3], key=repr)


def test_empty_table(spark, awkward, tmp_path):
    docs = awkward.limit(0)
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, SF_DIR).write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
    assert docs.count() == 0
