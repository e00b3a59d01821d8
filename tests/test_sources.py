"""Transcript, CSV, list and model inputs on small files."""

import json

import pytest
from pyspark.sql import functions as F

from rostrum.plans import sinks, stage
from rostrum.sources import tables, transcripts


def item(**kw):
    return {"kind": "speech", "speaker": "Ms. A", "speaker_bioguide": "A1", "text": "hello  there", **kw}


def raw(spark, docs):
    rows = [(f"f{i}", d if isinstance(d, str) else json.dumps(d)) for i, d in enumerate(docs)]
    return spark.createDataFrame(rows, "file_path string, raw string")


def test_bad_records(spark):
    bad = transcripts.bad_records(raw(spark, [{"a": 1}, "[1]", '{"a":', "", "3", "null", {}])).collect()
    assert sorted((r.file_path, r.reason) for r in bad) == [
        ("f1", "top level is not an object"), ("f2", "not valid JSON"), ("f3", "not valid JSON"),
        ("f4", "top level is not an object"), ("f5", "top level is not an object")]


def test_speech_rows_tolerate_wrong_types(spark):
    head = {"year": "2024", "month": "March", "day": 5, "chamber": " House "}
    docs = [
        {"header": head, "content": [item(), "stray", 5, item(kind=" speech "), item(kind="Speech"), item(text=12), item(text="None"),
                                     item(text=" "), item(speaker="none", speaker_bioguide=None), {"kind": "speech"}]},
        {"header": 5, "content": [item()]},
        {"header": head, "content": {}},
        {"content": [item()]},
        {"header": {"year": "x", "month": 3, "day": 1}, "content": [item()]},
        {"header": {"year": 2024, "month": 3.0, "day": 1}, "content": [item()]},
        {"header": {"year": 2024, "month": True, "day": 45}, "content": [item()]},
    ]
    rows = transcripts.speech_rows(raw(spark, docs)).orderBy("file_path", "pos").collect()
    by = {}
    for r in rows:
        by.setdefault(r.file_path, []).append(r)
    assert [(r.pos, r.Text) for r in by["f0"]] == [(0, "hello there"), (3, "hello there"), (5, "12"), (8, "hello there")]
    assert by["f0"][0].Date == "2024-03-05" and by["f0"][0]["Legislative Body"] == "House"
    assert by["f0"][3].Speaker_Name is None and by["f0"][3].Speaker_Bioguide_ID is None
    assert "f2" not in by and by["f1"][0].Date is None and by["f3"][0].Date is None
    assert [by[f][0].Date for f in ("f4", "f5", "f6")] == [None, None, "2024-01-45"]


def test_scan_files_in_path_order(spark, tmp_path):
    for p in ("b/2.json", "a/1.json", "a.b/0.json", "a/skip.txt"):
        f = tmp_path / p
        f.parent.mkdir(exist_ok=True)
        f.write_text(json.dumps({"content": [item(text=p)]}, indent=1))
    all_rows = transcripts.speech_rows(transcripts.scan_json(spark, str(tmp_path))).collect()
    assert sorted(r.Text for r in all_rows) == ["a.b/0.json", "a/1.json", "b/2.json"]
    two = transcripts.speech_rows(transcripts.scan_json(spark, str(tmp_path), limit=2)).collect()
    assert sorted(r.Text for r in two) == ["a.b/0.json", "a/1.json"]
    with pytest.raises(FileNotFoundError):
        transcripts.scan_json(spark, str(tmp_path), "*.none", limit=1)


def test_csv_round_trip_and_na(spark, tmp_path):
    rows = [(1, 'say "hi", he\nsaid', "NA"), (2, "plain", "null"), (3, "", "ok"), (4, None, "None"), (5, "na", "N/A")]
    df = spark.createDataFrame(rows, "id int, text string, who string")
    sinks.write_csv(df, str(tmp_path / "c"))
    got = {r.id: (r.text, r.who) for r in tables.read_csv(spark, str(tmp_path / "c"), "id int, text string, who string").collect()}
    assert got == {1: ('say "hi", he\nsaid', None), 2: ("plain", None), 3: (None, "ok"), 4: (None, None), 5: ("na", None)}


def test_column_and_path_checks(spark, tmp_path):
    df = spark.createDataFrame([(1, "x")], "Date int, Text string")
    with pytest.raises(ValueError, match="Legislative Body, Speaker_Bioguide_ID, Speaker_Name"):
        tables.require_columns(df)
    with pytest.raises(FileNotFoundError, match="nothing"):
        tables.require_paths(spark, str(tmp_path), str(tmp_path / "nothing"))


def test_word_lists(spark, tmp_path):
    (tmp_path / "a.txt").write_text("the\n\n of \nand\n")
    (tmp_path / "b.txt").write_text("and\nla\nthe\n")
    a, b = (tables.read_words(spark, str(tmp_path / n)) for n in ("a.txt", "b.txt"))
    assert [r.word for r in a.orderBy("line_no").collect()] == ["the", "of", "and"]
    both = tables.union_words(a, b).orderBy("src_no", "line_no").collect()
    assert [r.word for r in both] == ["the", "of", "and", "la"]
    assert tables.read_words(spark, str(tmp_path / "a.txt"), drop_blank=False).count() == 4


def test_model(spark, tmp_path):
    (tmp_path / "m.tsv").write_text("feature\tweight\n\nbias\t-0.5\nmr_speaker\t1.25\nonly\nyield\t 0.5\textra\n")
    weights = tables.read_weights(spark, str(tmp_path / "m.tsv"))
    terms, bias = tables.split_model(weights)
    assert sorted((r.term, r.weight) for r in terms.collect()) == [("mr_speaker", 1.25), ("yield", 0.5)]
    assert bias.first().bias == -0.5
    tables.check_model(weights)
    (tmp_path / "d.tsv").write_text("h\tw\nbias\t1\na\t1\na\t2\n")
    with pytest.raises(ValueError, match="twice"):
        tables.check_model(tables.read_weights(spark, str(tmp_path / "d.tsv")))
    (tmp_path / "e.tsv").write_text("h\tw\nbias\t1\n")
    with pytest.raises(ValueError, match="no terms"):
        tables.check_model(tables.read_weights(spark, str(tmp_path / "e.tsv")))


def test_doc_topics_and_runs(spark):
    lines = spark.createDataFrame([("0\tdoc0\t0.25\t0.75\n",), ("1\tdoc1\t1.0E-3\t0.5",)], "value string")
    got = {r.name: r.theta for r in tables.parse_doc_topics(lines).collect()}
    assert got == {"doc0": [0.25, 0.75], "doc1": [0.001, 0.5]}
    f = spark.createDataFrame([(50, 1, "theta"), (50, 1, "beta"), (50, 2, "theta"), (20, 3, "theta")], "num_topics int, seed int, table_name string")
    runs = tables.discover_runs(f, 50, [1, 2, 3])
    assert [(r.seed, r.complete) for r in runs.collect()] == [(1, True), (2, False)]
    tables.check_runs(runs, [1])
    with pytest.raises(FileNotFoundError, match="2, 3"):
        tables.check_runs(runs, [1, 2, 3])


def test_failure_list(spark, tmp_path):
    assert not sinks.write_failures(transcripts.bad_records(raw(spark, [{}])), str(tmp_path / "none"))
    assert not (tmp_path / "none").exists()
    assert sinks.write_failures(transcripts.bad_records(raw(spark, ["["])), str(tmp_path / "f"))
    assert [r.value for r in spark.read.text(str(tmp_path / "f")).collect()] == ["f0: not valid JSON"]


def test_records_of_json_lines_are_told_apart(spark, tmp_path):
    doc = lambda i: json.dumps({"header": {}, "content": [{"kind": "speech", "text": f"text {i} {j}"} for j in range(3)]})
    for name, docs in (("a.json", range(5)), ("b.json", range(5, 40)), ("c.json", range(40, 41))):
        (tmp_path / name).write_text("\n".join(map(doc, docs)) + "\n[1]\n")
    raw = transcripts.scan_json(spark, str(tmp_path), lines=True)
    assert raw.select("file_path", "record").distinct().count() == 44
    bad = transcripts.bad_records(raw).collect()
    assert len(bad) == 3 and all(r.record for r in bad)
    rows = transcripts.with_doc_id(transcripts.speech_rows(raw))
    got = rows.orderBy("file_path", "record", "pos").select("Text", "doc_id", "file_path").collect()
    assert [r.Text for r in got] == [f"text {i} {j}" for i in range(41) for j in range(3)]
    assert sorted(r.doc_id for r in got) == list(range(123))
    for name in "abc":  # in file order within each file
        ids = [r.doc_id for r in got if r.file_path.endswith(f"{name}.json")]
        assert ids == sorted(ids)
    with pytest.raises(FileNotFoundError):
        transcripts.scan_json(spark, str(tmp_path), "*.none", lines=True)


def test_second_reading_of_odd_objects(spark):
    item = '{"kind": "speech", "speaker": "S", "text": "words here", "score": NaN}'
    raws = ['{"header": {"year": 1, "year": 1999, "month": "May", "day": 4}, "x": 1, "x": 2, "content": ["stray", 5, %s]}' % item,
            '{"content": [%s], "y": Infinity}' % item, '{"content": [%s]' % item, "[NaN]",
            '{"content": [{"kind": "speech", "text": "%s"}]}' % ("long " * 4_100_000)]
    raw = spark.createDataFrame([(f"f{i}", t) for i, t in enumerate(raws)], "file_path string, raw string")
    rows = {r.file_path: r for r in transcripts.speech_rows(raw).collect()}
    assert set(rows) == {"f0", "f1", "f4"} and rows["f0"].Date == "1999-05-04" and rows["f0"].pos == 2
    assert len(rows["f4"].Text) == 5 * 4_100_000 - 1
    assert {r.file_path for r in transcripts.bad_records(raw).collect()} == {"f2", "f3"}


def test_line_order_over_several_files(spark, tmp_path):
    (tmp_path / "w").mkdir()
    (tmp_path / "w" / "part-0").write_text("a\nb\n")
    (tmp_path / "w" / "part-1").write_text("\n".join(f"word{i:04d}" for i in range(500)) + "\n")
    (tmp_path / "w" / "part-2").write_text("z\n")
    words = [r.word for r in tables.read_words(spark, str(tmp_path / "w")).orderBy("line_no").collect()]
    assert words == ["a", "b", *(f"word{i:04d}" for i in range(500)), "z"]
    (tmp_path / "m").mkdir()
    (tmp_path / "m" / "part-0").write_text("h\tw\nbias\t-0.5\n")
    (tmp_path / "m" / "part-1").write_text("".join(f"t{i}\t1.0\n" for i in range(300)))
    terms, bias = tables.split_model(tables.read_weights(spark, str(tmp_path / "m")))
    assert bias.first().bias == -0.5 and terms.count() == 300


def test_run_store_keeps_earlier_runs(spark, tmp_path):
    path = str(tmp_path / "runs")
    make = lambda seed: spark.createDataFrame([(seed, i, [0.5]) for i in range(3)], "seed int, id int, shape array<double>")
    for seed in (1, 2):
        sinks.write_factors(make(seed), make(seed).drop("shape"), 7, path)
    runs = tables.discover_runs(tables.read_runs(spark, path), 7, [1, 2, 3])
    assert [(r.seed, r.complete) for r in runs.collect()] == [(1, True), (2, True)]
    theta, beta = tables.read_factors(spark, path, 7, [1, 2])
    assert theta.count() == 6 and beta.count() == 6 and "shape" in theta.columns
    with pytest.raises(FileNotFoundError, match="3"):
        tables.read_factors(spark, path, 7, [1, 3])


def test_work_folder_must_be_shared_off_local(spark):
    from types import SimpleNamespace as N
    away = N(conf=N(get=lambda *a: None), sparkContext=N(getCheckpointDir=lambda: None, master="spark://host"))
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        stage.work_dir(away)
