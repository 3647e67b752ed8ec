import corpus_pipeline
from tablewright.llm import langid, near_dedup, quality

from .test_near_dedup import brute


def test_stages(spark, data):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "language_id", "near_duplicates", "packing"]
    docs = spark.read.parquet(f"{data}/documents.parquet")
    columns, at = docs.columns, docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = at.select("doc_id", "text").collect()
        at = corpus_pipeline.stored(stage(spark, at, data))
        assert at.columns == columns
        after = {r.doc_id for r in at.collect()}
        assert after <= {r.doc_id for r in before} and after
        if name == "quality_rules":
            assert after == {r.doc_id for r in quality.measure(docs).where("kept").collect()}
        if name == "near_duplicates":
            assert after == {k for k, _, _, kept in brute([tuple(r) for r in before]) if kept}
    packed = corpus_pipeline.run(spark, data).collect()
    assert {r.doc_id for r in packed} == after


def test_clean_documents_stay(spark, data):
    good = {r.doc_id for r in spark.read.parquet(f"{data}/labels.parquet").where("quality = 1").collect()}
    docs = spark.read.parquet(f"{data}/documents.parquet")
    kept = corpus_pipeline.quality_rules(spark, docs, data)
    failed = {r.doc_id for r in quality.measure(docs).where("base_failed").collect()}
    known = {r.doc_id for r in corpus_pipeline.language_id(spark, corpus_pipeline.stored(kept), data).collect()}
    assert good - failed <= known


def test_extra_columns(spark):
    text = " ".join(f"the word{i} of" for i in range(40))
    rows = [(1, text, "en", 1), (2, text, None, 2), (3, None, "en", 3), (None, text + " more of it", "en", 4)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, kept int")
    assert near_dedup.drop_duplicates(df).columns == df.columns
    assert {r.kept for r in near_dedup.drop_duplicates(df).collect()} == {1, 3}
    assert {r.kept for r in quality.keep_good(df).collect()} == {1, 2, 4}
    assert {r.kept for r in langid.keep_known(df, langid.fit(df)).collect()} == {1, 2, 4}


def test_empty_and_repeated_rows(spark):
    """Every stage on no rows, and on rows that occur twice."""
    text = " ".join(f"the word{i} of" for i in range(40))
    df = spark.createDataFrame([(1, text, "en", "s", 9), (1, text, "en", "s", 9), (2, "x" * 50, "en", "s", 9)], "doc_id long, text string, lang string, source string, n_chars long")
    for rows, left in ((df.limit(0), 0), (df, 1)):
        at = rows
        for _, stage in corpus_pipeline.STAGES[:-1]:
            at = corpus_pipeline.stored(stage(spark, at, ""))
            assert at.columns == df.columns
        assert at.count() == left
        packed = corpus_pipeline.STAGES[-1][1](spark, at, "").collect()
        assert {r.doc_id for r in packed} == ({1} if left else set())
