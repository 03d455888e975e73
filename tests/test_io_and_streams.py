"""Readers, writers and streams."""

from __future__ import annotations

import json
from datetime import datetime, timezone

import pandas as pd
import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from dialoom.operators import links
from dialoom.sources import readers, writers
from dialoom.streaming import events


def test_blank_lines_do_not_count(spark, tmp_path):
    cases = tmp_path / "cases"
    cases.mkdir()
    (cases / "a.jsonl").write_text('{"id":"x"}\n\n{"benchmark_id":"b","slice":"s"}\n')
    (cases / "b.jsonl").write_text('\n{"prompt":"p"}\n')
    (tmp_path / "own.jsonl").write_text('{"id":"not a case"}\n')
    assert readers.count_lines(spark, str(tmp_path)) == 3
    got = [(r.id, r.slice) for r in readers.suite_cases(spark, str(tmp_path)).collect()]
    assert got == [("x", "a"), ("b", "s"), ("case-0003", "b")]
    # a file alone has no slices of its own
    assert [(r.id, r.slice) for r in readers.suite_cases(spark, str(cases / "b.jsonl")).collect()] == [("case-0001", None)]


def test_suites_without_cases(spark, tmp_path):
    (tmp_path / "flat").mkdir()
    (tmp_path / "flat/a.jsonl").write_text('{"id":"x"}\n\n')
    (tmp_path / "flat/notes.txt").write_text("one\ntwo\n")
    assert readers.count_lines(spark, str(tmp_path / "flat")) == 1
    assert readers.count_lines(spark, str(tmp_path / "flat/a.jsonl")) == 1
    assert readers.count_lines(spark, str(tmp_path / "none")) == 0
    with pytest.raises(AnalysisException):
        readers.suite_cases(spark, str(tmp_path / "flat"))
    assert readers.suite_meta(spark, str(tmp_path / "flat"), "title string").count() == 0
    (tmp_path / "flat/suite.json").write_text('{\n"title": "t"\n}')
    assert readers.suite_meta(spark, str(tmp_path / "flat"), "title string").first().title == "t"


def test_records_of_lines_lists_and_objects(spark, tmp_path):
    (tmp_path / "a.jsonl").write_text('{"id":"1"}\n\nbroken\n')
    (tmp_path / "b.json").write_text('[{"id":"2"},\n {"id":"3"}]')
    (tmp_path / "c.json").write_text('\n{"id":"4"}')
    (tmp_path / "d.json").write_text("7")
    got = [(r.file[-7:], r.line, r.record and r.record.id) for r in readers.records(spark, str(tmp_path), "id string").orderBy("file", "line").collect()]
    assert got == [("a.jsonl", 1, "1"), ("a.jsonl", 3, None), ("/b.json", 1, "2"), ("/b.json", 2, "3"), ("/c.json", 1, "4")]


def test_exclusion_by_globs(spark, tmp_path):
    for name in ("keep/a.json", "keep/a_meta.json", "drop/b.json", "dropped/c.json"):
        (tmp_path / name).parent.mkdir(exist_ok=True)
        (tmp_path / name).write_text("{}")
    got = [r.path.rsplit("/", 2)[-2:] for r in readers.files(spark, str(tmp_path), "*.json", ["*_meta.json", "drop/*"]).collect()]
    assert got == [["dropped", "c.json"], ["keep", "a.json"]]


def test_part_lists_and_durations(spark, tmp_path):
    (tmp_path / "p1.json").write_text('["a", "b"]')
    (tmp_path / "p2.json").write_text('{"items": [{"path": "c"}, {"path": ""}]}')
    assert sorted(r.path for r in readers.part_list(spark, str(tmp_path)).collect()) == ["a", "b", "c"]
    (tmp_path / "t1.txt").write_text("# head\n# 时长: 75 秒\n")
    (tmp_path / "t2.txt").write_text("x\n" * 10 + "# 时长: 75 秒\n")
    assert [r.seconds for r in readers.legacy_duration(spark, str(tmp_path / "t*.txt")).orderBy("file").collect()] == [75, 0]


def test_lenient_records(spark, tmp_path):
    (tmp_path / "r.jsonl").write_text('{"id":"1","n":2}\nnot json\n{"n":3}\n{"id":"","n":4}\n')
    assert [tuple(r) for r in readers.lenient_records(spark, str(tmp_path), "id string, n int").collect()] == [("1", 2)]


def test_transcript_defaults(spark, tmp_path):
    doc = {"segments": [{"start": -1.0, "end": 2.0, "speaker": None, "text": " a "}, {"start": 1.0, "end": 2.0, "speaker": "S", "text": None}]}
    (tmp_path / "t.json").write_text(json.dumps(doc, indent=1))
    got = [(r.seg_idx, r.start_s, r.speaker, r.text) for r in readers.transcripts(spark, str(tmp_path)).orderBy("seg_idx").collect()]
    assert got == [(0, 0.0, "UNKNOWN", "a"), (1, 1.0, "S", "")]


def test_raw_and_legacy_text(spark, tmp_path):
    (tmp_path / "raw").mkdir()
    (tmp_path / "raw/x.txt").write_text("[3] 00:00:01.50 - 00:00:02.00 SPEAKER_01 | hello\nnoise\n")
    r = readers.raw_sections(spark, str(tmp_path / "raw")).first()
    assert (r.idx, r.start_s, r.end_s, r.speaker, r.text) == (3, 1.5, 2.0, "SPEAKER_01", "hello")
    (tmp_path / "old").mkdir()
    (tmp_path / "old/y.txt").write_text("# head\n[speaker1] 0:01 - 0:02\nfirst\n[0:03 - 0:04]\nsecond\n")
    got = [(r.speaker, r.start_s, r.text) for r in readers.legacy_transcript(spark, str(tmp_path / "old")).orderBy("line").collect()]
    assert got == [("speaker1", 1.0, "first"), ("speaker1", 3.0, "second")]


def test_manifest_both_shapes_and_first_object(spark, tmp_path):
    (tmp_path / "m1.json").write_text('[{"id":"a"}]')
    (tmp_path / "m2.json").write_text('{"items":[{"id":"b","lastPosition":2.5}]}')
    assert sorted(r.id for r in readers.manifest(spark, str(tmp_path)).collect()) == ["a", "b"]
    df = spark.createDataFrame([(' {"a":1} trailing',), ("none",), (None,)], "t string")
    assert [r.first_json for r in readers.first_object(df, "t").collect()] == ['{"a": 1}', None, None]


def test_sse_blocks():
    got, rest = readers.sse_payloads(iter(["data: a\r\n", "\r\ndata: b\ndata: c\n\nda"]))
    assert (got, rest) == (["a", "b\nc"], "da")
    assert readers.sse_payloads(iter(["ta: d\n\n"]), rest) == (["d"], "")


def test_writers(spark, tmp_path):
    df = spark.createDataFrame([(1, 'say "x"', "train"), (2, "y", "dev")], "id int, t string, split string")
    assert writers.training_set(df, str(tmp_path / "set")) == {"train": 1, "dev": 1}
    assert spark.read.json(str(tmp_path / "set/data/split=train")).count() == 1
    writers.quoted_csv(df, str(tmp_path / "csv"))
    assert spark.read.csv(str(tmp_path / "csv"), header=True, escape='"').filter("id = 1").first().t == 'say "x"'
    assert writers.export_bundle(df.withColumn("source_type", F.lit("live")), str(tmp_path / "out")) == {"source_types": ["live"], "record_count": 2}
    assert writers.split_outputs(df, str(tmp_path / "parts"), {"a": F.col("id") == 1, "b": F.col("id") > 5}) == {"a": 1, "b": 0}


def test_writers_by_day_entity_and_year(spark, tmp_path):
    df = spark.createDataFrame([("2024-01-02", "01", "02", "x", "live", "2"), ("2024-01-03", "03", "04", "y", "", "1")], "date string, start string, end string, tag string, source_type string, at string")
    writers.entity_records(df, str(tmp_path / "e"))
    assert spark.read.json(str(tmp_path / "e/date=2024-01-02")).first().entity == "2024-01-02_01_02_x"
    got = writers.export_bundle(df, str(tmp_path / "b"), export_id="id1", at=datetime(2024, 1, 2, 17, tzinfo=timezone.utc))
    assert got == {"source_types": ["live"], "record_count": 2}
    assert "- record_count: 2" in [r.value for r in spark.read.text(str(tmp_path / "b/2024-01-03/id1/readme")).collect()]
    writers.split_outputs(df.withColumn("year", F.substring("date", 1, 4)), str(tmp_path / "s"), {"all": F.lit(True)}, by="year")
    assert spark.read.json(str(tmp_path / "s/all/year=2024")).count() == 2
    writers.quoted_csv(df.select("tag", "at"), str(tmp_path / "c"), newest="at", bom=True)
    assert [r.value for r in spark.read.text(str(tmp_path / "c"), wholetext=True).collect()] == ['\ufeff"tag","at"\n"x","2"\n"y","1"\n']
    writers.training_set(df.withColumn("split", F.lit("train")), str(tmp_path / "t"), name="turns")
    assert json.loads(spark.read.text(str(tmp_path / "t/dataset_info")).first().value)["turns_train"]["formatting"] == "sharegpt"


def test_report_texts(spark):
    df = spark.createDataFrame([(0.5, 0.625), (0.5, 0.25), (None, 0.1)], "b double, a double")
    assert [tuple(r) for r in df.select(writers.percent(F.col("b")), writers.change(F.col("b"), F.col("a"))).collect()] == [("50.0%", "+12.50 pp"), ("50.0%", "-25.00 pp"), ("N/A", "N/A")]


def test_json_subtitles(spark):
    df = spark.createDataFrame([(1, 1, 2.0, 3.456, "B", " y "), (1, 0, 0.0, 1.0, "A", "x")], "file_id int, seg_idx int, start_s double, end_s double, speaker string, text string")
    got = json.loads(writers.subtitle_text(df, kind="json").first().content)
    assert got == {"segments": [{"start": 0.0, "end": 1.0, "speaker": "A", "text": "x"}, {"start": 2.0, "end": 3.46, "speaker": "B", "text": "y"}], "speakers": ["A", "B"]}


def test_links_in_order(spark):
    audio = spark.createDataFrame([("r/2023/a.mp3", "d1"), ("r/2024/a.mp3", "d1"), ("r/2024/b.mp3", "d2"), ("c.mp3", None)], "path string, day string")
    parts = spark.createDataFrame([
        (1, "2024", "x", "a.json", None), (2, "2022", "x", "a.JSON", None), (3, "2024", "p/b_processed", None, None), (4, "2022", "p/b", "", None),
        (5, "2024", "x", None, "d1"), (6, "2022", "x", None, "d1"), (7, "2022", "x", None, "d2"), (8, None, None, None, None), (9, "2024", "x", None, "d9"),
    ], "part_id int, year string, folder string, source_file string, day string")
    got = {r.part_id: (r.path, r.via) for r in links.source_audio(parts, audio).collect()}
    assert got == {
        1: ("r/2024/a.mp3", "year and file"), 2: ("r/2023/a.mp3", "file"), 3: ("r/2024/b.mp3", "year and folder"), 4: ("r/2024/b.mp3", "folder"),
        5: ("r/2024/a.mp3", "day and year"), 6: ("r/2023/a.mp3", "day"), 7: ("r/2024/b.mp3", "day"), 8: (None, None), 9: (None, None),
    }
    wanted = spark.createDataFrame([("a.mp3",), ("mp3",), ("",), ("zz",)], "name string")
    got = {r.name: (r.path, r.via) for r in links.by_name_or_suffix(wanted, audio).collect()}
    assert got == {"a.mp3": ("r/2023/a.mp3", "name"), "mp3": ("c.mp3", "suffix"), "": (None, None), "zz": (None, None)}


def test_lookups_and_positions(spark, tmp_path):
    df = spark.createDataFrame([("a", 1), ("a", 3), ("b", 2)], "k string, n int")
    assert [r.n for r in links.one_by_key(df, "k", "a", F.desc("n")).collect()] == [3]
    (tmp_path / "p.json").write_text('{"a": 2.5, "b": null}')
    got = links.with_positions(df, readers.playback_positions(spark, str(tmp_path / "p.json")), "k").orderBy("n").collect()
    assert [r.position for r in got] == [2.5, 0.0, 2.5]


def test_upsert_prefers_new_on_ties(spark):
    old = spark.createDataFrame([(1, "a", 1), (2, "b", 1)], "k int, v string, n int")
    new = spark.createDataFrame([(1, "c", 1), (3, "d", 0)], "k int, v string, n int")
    assert sorted(tuple(r) for r in writers.upsert(old, new, ["k"], "n").collect()) == [(1, "c", 1), (2, "b", 1), (3, "d", 0)]


def _stream(spark, data, tmp_path, name):
    source = tmp_path / name
    events_ = spark.read.parquet(f"{data}/events.parquet")
    events_.write.parquet(str(source))
    return spark.readStream.schema(events_.schema).parquet(str(source))


def test_streams_run(spark, data, tmp_path):
    stream = _stream(spark, data, tmp_path, "in")
    for k, df, mode in ((0, events.tumbling_counts(stream), "complete"), (1, events.deduplicated(stream).select("event_id"), "append"), (2, events.memory_stream(stream), "update")):
        q = df.writeStream.format("memory").queryName(f"q{k}").outputMode(mode).option("checkpointLocation", str(tmp_path / f"c{k}")).start()
        q.processAllAvailable()
        q.stop()
    table = spark.read.parquet(f"{data}/events.parquet")
    assert spark.table("q0").agg(F.sum("n")).first()[0] == table.count()
    assert spark.table("q1").count() == table.count()
    assert spark.table("q2").select("user_id").distinct().count() == table.select("user_id").distinct().count()


def test_memory_fold_caps():
    rows = pd.DataFrame({"event_type": list("abcdea"), "event_id": range(6)})
    assert events.fold_memory({}, rows, cap=3) == {"a": (5, 2), "e": (4, 1), "d": (3, 1)}


def test_ingest_is_idempotent(spark, tmp_path):
    df = spark.createDataFrame([(1,), (2,), (2,)], "k int")
    target = str(tmp_path / "t")
    assert [events.ingest_new(df, target, "k"), events.ingest_new(df, target, "k")] == [2, 0]


def test_deltas_fold_until_done():
    rows = ['{"delta":"a"}', "broken", '{"delta":"b","usage":{"completion_tokens":2}}', "[DONE]", '{"delta":"late"}']
    assert events.fold_deltas(("", 0, False), rows) == ("ab", 2, True)
    assert events.fold_deltas(events.fold_deltas(("", 0, False), rows[:1]), rows[1:]) == ("ab", 2, True)


def test_profiles_move_and_grow():
    profiles, weights = [[1.0, 0.0]], [10.0]
    got = events.match_profiles(profiles, weights, [("x", [0.9, 0.1], 5.0), ("y", [0.0, 1.0], 3.0), ("z", [0.95, 0.0], 1.0)])
    assert got == {"z": 0, "x": 1, "y": 2} and weights == [11.0, 5.0, 3.0]


def _run(spark, df, path, mode, batches, name):
    """Rows of a stream that takes the given files one by one."""
    q = df.writeStream.format("memory").queryName(name).outputMode(mode).option("checkpointLocation", str(path / f"c_{name}")).start()
    for write in batches:
        write()
        q.processAllAvailable()
    q.stop()
    return [tuple(r) for r in spark.table(name).collect()]


def test_blocks_and_deltas_over_batches(spark, tmp_path):
    parts = [[(1, 0, 'data: {"delta":"a"}\n'), (2, 0, "data: x\n\n")], [(1, 1, '\ndata: {"delta":"b"}\r\n\r\nda'), (1, 2, "ta: [DONE]\n\n")], [(1, 3, 'data: {"delta":"late"}\n\n')]]
    schema = "request_id long, seq long, chunk string"
    (tmp_path / "in").mkdir()
    put = [lambda p=p: spark.createDataFrame(p, schema).coalesce(1).write.mode("append").json(str(tmp_path / "in")) for p in parts]
    got = _run(spark, events.payload_stream(spark.readStream.schema(schema).json(str(tmp_path / "in"))), tmp_path, "append", put, "blocks")
    assert sorted(got) == [(1, 1, 0, '{"delta":"a"}'), (1, 1, 1, '{"delta":"b"}'), (1, 2, 0, "[DONE]"), (1, 3, 0, '{"delta":"late"}'), (2, 0, 0, "x")]

    schema = "request_id long, seq long, payload string"
    (tmp_path / "in2").mkdir()
    put = [lambda p=p: spark.createDataFrame(p, schema).coalesce(1).write.mode("append").json(str(tmp_path / "in2")) for p in ([(1, 0, '{"delta":"a"}')], [(1, 2, "[DONE]"), (1, 1, '{"delta":"b"}')], [(1, 3, '{"delta":"late"}')])]
    got = _run(spark, events.delta_stream(spark.readStream.schema(schema).json(str(tmp_path / "in2"))), tmp_path, "update", put, "deltas")
    assert got == [(1, "a", 0, False), (1, "ab", 0, True)]


def test_profiles_over_batches(spark, tmp_path):
    schema = "file_id long, chunk long, speaker string, vector array<double>, seconds double"
    (tmp_path / "in").mkdir()
    parts = [[(1, 0, "S0", [1.0, 0.0], 5.0), (1, 0, "S1", [0.0, 1.0], 5.0)], [(1, 1, "S0", [0.1, 1.0], 5.0), (1, 2, "S0", [0.9, 0.1], 5.0), (2, 0, "S0", [0.0, 1.0], 1.0)]]
    put = [lambda p=p: spark.createDataFrame(p, schema).coalesce(1).write.mode("append").json(str(tmp_path / "in")) for p in parts]
    got = _run(spark, events.profile_stream(spark.readStream.schema(schema).json(str(tmp_path / "in"))), tmp_path, "append", put, "profiles")
    assert sorted(got) == [(1, 0, "S0", 0), (1, 0, "S1", 1), (1, 1, "S0", 1), (1, 2, "S0", 0), (2, 0, "S0", 0)]
