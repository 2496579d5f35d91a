import pytest

import corpus_pipeline


@pytest.fixture
def folder(tmp_path, spark):
    text = " ".join(f"w{k % 97}" for k in range(80))
    docs = [(k, f"{text} tail {k}" if k < 4 else f"text number {k} " * 3, "en", f"s{k % 3}", 1) for k in range(12)] + [(99, None, None, None, None)]
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(1, 1, 0), (5, 0, 1)], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    return str(tmp_path)


def test_stages_keep_the_columns_of_documents(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["toxicity", "near_dedup", "substring_dedup", "mixing", "packing"]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, folder)
        assert out.schema.simpleString() == docs.schema.simpleString()
        out.write.format("noop").mode("overwrite").save()
        for k in out.limit(1).collect():
            assert len(k) == len(docs.columns)


def test_run(spark, folder):
    rows = corpus_pipeline.run(spark, folder).collect()
    assert rows and {"doc_id", "piece", "sequence_id", "offset"} <= set(rows[0].asDict())
    again = corpus_pipeline.run(spark, folder).collect()
    key = lambda r: (r.doc_id or -1, r.piece, r.ids_crc32)
    assert sorted(map(key, rows)) == sorted(map(key, again))


def test_repeated_rows_and_rows_without_id_keep_one_text(spark, folder):
    """Copies under one id, and copies without any: one of each stays, with all its words."""
    from tidemark.llm import neardup, substrings

    text, other = " ".join(f"a{k}" for k in range(60)), " ".join(f"b{k}" for k in range(60))
    rows = [(1, text), (1, text), (2, text), (None, text), (None, other), (None, other), (7, "one two"), (7, "three four"), (8, None), (9, ""), (8, None)]
    docs = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    kept = neardup.without_near_duplicates(docs)
    assert kept.schema == docs.schema
    want = [(1, text), (None, other), (7, "one two"), (7, "three four"), (8, None), (8, None), (9, "")]
    assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=repr) == sorted(want, key=repr)
    assert sorted(((r.doc_id, r.text) for r in substrings.without_repeats(kept).collect()), key=repr) == sorted(want, key=repr)
    assert neardup.without_near_duplicates(docs.limit(0)).count() == 0


def test_texts_stay_where_they_are_when_near_duplicates_go(spark, no_broadcast):
    """Many rows: the kept ones are found by a bit for each, and no text is shuffled for them."""
    from tidemark.llm import neardup

    text = lambda k: " ".join(f"t{k}w{i}" for i in range(12))
    rows = [(k, text(k // 2 if k % 5 == 0 else k)) for k in range(700)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    kept = neardup.without_near_duplicates(docs)
    assert "SortMergeJoin" not in kept._jdf.queryExecution().executedPlan().toString()
    first = {}
    for k, t in rows:
        first.setdefault(t, k)
    assert sorted(r.doc_id for r in kept.collect()) == sorted(first.values())
