import corpus_pipeline
from tests.llm.test_ngram_join import brute as components
from tests.llm.test_packing import verify
from tests.llm.test_quality import brute as base_rules


def test_stages_against_brute_force(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    schema, rows = docs.schema, docs.collect()
    kept = corpus_pipeline.quality_rules(spark, docs, sf)
    assert kept.columns == docs.columns
    ids = {r.doc_id for r in kept.collect()}
    assert ids <= {r.doc_id for r in rows if not base_rules(r.text)[5]} and len(ids) > 0.7 * len(rows)
    spoken = corpus_pipeline.language(spark, kept, sf)
    assert spoken.columns == docs.columns and {r.doc_id for r in spoken.collect()} == ids
    single = corpus_pipeline.near_duplicates(spark, spoken, sf)
    left = [(r.doc_id, r.text) for r in spoken.collect()]
    assert {r.doc_id for r in single.collect()} == {d for d, *_, c in components(left, 5, 8, 10) if d == c}
    assert [f.name for f in single.schema] == [f.name for f in schema]
    verify(corpus_pipeline.packed(spark, single, sf).collect(), [(r.doc_id, r.text) for r in single.collect()])
    assert sorted(corpus_pipeline.run(spark, sf).collect()) == sorted(corpus_pipeline.packed(spark, single, sf).collect())


def test_odd_rows_pass(spark):
    text = " ".join(f"word{i} the of and" for i in range(30))
    rows = [(1, text, "en", "s", 1), (1, text, None, None, None), (None, None, None, None, None), (2, "", "en", "s", 0), (3, "!!", None, "s", 2)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, "")
        assert stage(spark, docs.limit(0), "").count() == 0
    assert {r.doc_id for r in docs.collect()} == {1}


def test_extra_columns_come_through(spark):
    """Columns of the user's with names that stages could want stay as they are."""
    text = " ".join(f"word{i} the of and" for i in range(30))
    extra = ["__t", "__w", "__m", "t", "a.b", "language", "quality_rules", "quality", "spoken", "drop", "k", "sig", "row", "__k"]
    schema = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"`{c}` string" for c in extra)
    row = (1, text, "en", "s", 1, *extra)
    docs = spark.createDataFrame([row, (2, *row[1:])], schema)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, "")
        assert docs.columns[5:] == extra
    assert [tuple(r) for r in docs.collect()] == [row]
    assert {r.doc_id for r in corpus_pipeline.packed(spark, docs, "").collect()} == {1}
