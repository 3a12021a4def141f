"""What stages of the pipeline return of documents whose lines are all shared."""

from stratalake.llm import stages


def test_documents_of_shared_lines_stay(spark):
    rows = [(i, "shared\nlines", "a", 12) for i in range(11)]
    rows += [(None, "shared", "a", 6), (None, "lines", "a", 5), (20, "shared\nown words", "b", 16)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, n_chars int")
    done = stages.drop_shared_lines(spark, docs, "")
    assert done.columns == docs.columns and done.count() == len(rows)
    assert {r.doc_id: (r.text, r.n_chars) for r in done.collect()} == {
        **{i: ("", 0) for i in (*range(11), None)}, 20: ("own words", 9),
    }
    kept = stages.keep_one_of_each_group(spark, done, "")
    assert kept.columns == docs.columns and kept.count() == len(rows)
