"""Steps that must keep their shape on large tables: folders of files, bounded partitions, work done once."""

import pytest
from pyspark.sql import functions as F

from catalog import QUERIES, ingest
from rostrum.operators import counts as C, ids

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def folder(spark, tmp_path):
    """A table of documents in three files."""
    rows = [(i, f'line "{i}",\nnext, some words of speech', ["en", "es", "fr"][i % 3], f"src{i % 4}", 600 * (i % 2)) for i in range(60)]
    spark.createDataFrame(rows, DOCS).repartition(3, "doc_id").write.parquet(str(tmp_path / "documents.parquet"))
    return str(tmp_path), rows


def test_streamed_split_of_a_table_of_several_files(spark, folder):
    sf, rows = folder
    got = {(r.doc_id, r.chamber) for r in QUERIES["split_stream"](spark, sf).collect()}
    assert got == {(i, "house" if lang == "en" else "senate") for i, _, lang, *_ in rows if lang != "es"}


def test_csv_files_are_written_by_many_tasks(spark, folder, monkeypatch):
    sf, rows = folder
    tasks, write = [], ingest.sinks.write_csv
    monkeypatch.setattr(ingest.sinks, "write_csv", lambda df, path: (tasks.append(df.rdd.getNumPartitions()), write(df, path)))
    got = {r.doc_id: r.text for r in QUERIES["csv_chunks"](spark, sf).collect()}
    assert got == {i: f'"{text}", x\r\ny' for i, text, *_ in rows}
    assert tasks[0] > 1


def test_ids_work_their_keys_out_once(spark):
    seen = spark.sparkContext.accumulator(0)

    @F.udf("long")
    def key(x):
        seen.add(1)
        return 7 * x

    got = sorted((r.doc_id, r.row_id) for r in ids.export_ids(spark.range(200).select(key("id").alias("doc_id"))).collect())
    assert got == [(7 * i, i) for i in range(200)] and seen.value == 200


def test_counts_are_placed_by_the_length_of_the_texts(spark, monkeypatch):
    monkeypatch.setattr(C, "PART_CHARS", 1000)
    d = spark.createDataFrame([(i, "some words said again " * 10) for i in range(100)], "doc_id long, text string")
    vocab = spark.createDataFrame([(0, "said again", 2), (1, "words", 1)], "term_id long, term string, n int")
    counts = C.document_term_counts(d, vocab)
    assert counts.rdd.getNumPartitions() == 22 and {r.cnt for r in counts.collect()} == {10}
    assert counts.count() == 200
