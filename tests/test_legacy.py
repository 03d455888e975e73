"""Records of older shapes on planted cases."""

from __future__ import annotations

import json

from dialoom.operators import legacy


def formal(spark, *records, kind="call"):
    df = spark.createDataFrame([(k, r if isinstance(r, str) or r is None else json.dumps(r), kind) for k, r in enumerate(records)], "k int, raw string, kind string")
    return [r.formal for r in legacy.formal(df, "raw", "kind").orderBy("k").collect()]


def said(r):
    return [(s.speaker_id, s.start, s.end, s.text) for s in r.sentences]


def test_lists_times_and_bounds(spark):
    a, b, c, d, e = formal(
        spark,
        {"sentences": [{"speaker": "host", "start": 1.239, "end": "0:02", "text": "b"}, 7, {"speaker": "g1", "start": "00:00:01.5", "text": None}], "turns": []},
        {"meta": {"turns": [{"role": "嘉宾", "start": 1, "end": 0.5, "text": "x"}], "original_start": "0:10", "sentence_count": "3"}, "time_range": {"start": "1:00", "end": "2:00"}},
        {"sentences": "none", "metadata": {"start": 5, "end_time": "0:09"}},
        {"segments": [{"speaker": 3, "start": "1:2:3", "end": "x", "text": "t"}], "original_start": 100, "section_info": {"segment_count": 9}},
        {"segments": [{"speaker": "SPEAKER_1", "start": 3, "end": 4, "original_start": 0, "text": "t"}], "original_start": 2},
    )
    assert said(a) == [("host", 1.24, 2.0, "b"), ("guest", 1.5, 1.5, "")] and (a.start, a.end, a.raw_segment_count, a.notes) == (1.24, 2.0, 2, "repair: from sentences of an older shape")
    assert said(b) == [("guest", 11.0, 11.0, "x")] and (b.start, b.end) == (10.0, 120.0) and b.raw_segment_count == 1 and b.end_ts == "00:02:00.00"
    assert said(c) == [] and (c.start, c.end, c.raw_segment_count, c.notes) == (5.0, 9.0, 0, "repair: from none of an older shape")
    assert said(d) == [("guest", 100.0, 100.0, "t")] and d.raw_segment_count == 9
    # from the section's start on, only a sentence that names its own start is moved
    assert said(e) == [("guest", 5.0, 6.0, "t")]


def test_who_speaks(spark):
    cases = [
        ({}, {"is_host": True, "speaker": "guest"}, "host"), ({}, {"is_host": False, "speaker": "host"}, "guest"), ({"host": "Ann"}, {"speaker_name": "Ann"}, "host"), ({"metadata": {"guest_speaker": "Bo"}}, {"name": "Bo"}, "guest"),
        ({"hosts": ["S1"]}, {"speaker": "S1"}, "host"), ({"speakers": {"host": "S2", "guests": ["S3"]}}, {"speaker": "S2"}, "host"), ({"speakers": {"guests": ["S3"]}}, {"speaker_role": "S3"}, "guest"),
        ({"speaker_mapping": {"A": "the HOST", "B": "用户 1"}}, {"speaker": "A"}, "host"), ({"speaker_roles": {"B": "用户 1"}}, {"speaker": "B"}, "guest"), ({}, {"speaker": "Guest_4"}, "guest"), ({}, {"speaker": "h2"}, "host"),
        ({}, {"speaker": "unknown"}, None), ({}, {"speaker": None, "role": "host"}, "host"), ({}, {}, None), ({"host": ""}, {"speaker": ""}, None),
    ]
    records = [{**more, "turns": [{"start": 1, "end": 2, "text": "t", **one}]} for more, one, _ in cases]
    for kind, other in (("call", "guest"), ("comment", "host")):
        got = formal(spark, *records, kind=kind)
        assert [r.sentences[0].speaker_id for r in got] == [want or other for _, _, want in cases]
        assert {tuple(r.speaker_ids) for r in got} == {("host", "guest") if kind == "call" else ("host",)}


def test_what_is_no_record(spark):
    assert formal(spark, None, "", "{", "[1]", "7") == [None] * 5
    df = spark.createDataFrame([], "raw string, kind string")
    assert legacy.formal(df, "raw", "kind").count() == 0
