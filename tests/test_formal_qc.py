"""Formal files and rejected sections on planted cases."""

from __future__ import annotations

import json

from dialoom.operators import formal_qc as ops


def checked(spark, *files, schema=None):
    df = spark.createDataFrame([(k, f if isinstance(f, str) or f is None else json.dumps(f)) for k, f in enumerate(files)], "k int, raw string")
    return [(r.status, [f"{i.code} {i.path}" for i in r.issues]) for r in ops.checked(df, "raw", schema).orderBy("k").collect()]


def test_files(spark):
    s = lambda a, b, t="x": {"start": a, "end": b, "text": t}
    got = checked(
        spark,
        {"meta": {"start": 0, "end": 9.5, "sentence_count": 2}, "sentences": [s(0, 1), s(1, 9.5)]},
        {"meta": {"start": 5, "end": 4, "sentence_count": 1}, "sentences": [s(4.5, 4.4, " \n")]},
        {"meta": {"start": "5", "end": None}, "sentences": [7, s(3, "x"), s(2, 1, None), None]},
        {"meta": {"start": 1, "end": 2}, "sentences": [s(1 - 1e-7, 2), s(0.9, 2), {"text": ""}]},
        {"meta": [], "sentences": [7]}, {"meta": {}, "sentences": {}}, {"meta": {}}, "[]", "{", None,
    )
    assert got == [
        ("pass", []), ("fail", ["section_time_reversed $.meta", "sentence_time_reversed $.sentences[0]", "sentence_outside_section $.sentences[0]", "empty_sentence_text $.sentences[0].text"]),
        ("fail", ["sentence_not_object $.sentences[0]", "sentence_time_reversed $.sentences[2]", "sentence_not_object $.sentences[3]"]),
        ("warn", ["sentence_outside_section $.sentences[1]", "empty_sentence_text $.sentences[2].text"]), ("pass", []), ("pass", []), ("skip", []), ("skip", []), ("fail", ["json_load_error $"]), ("fail", ["json_load_error $"]),
    ]
    strict = {"properties": {"meta": {"required": ["title"]}}}
    assert checked(spark, {"meta": {}, "sentences": []}, {"sentences": 1}, schema=strict) == [("fail", ["schema_validation_error $.meta"]), ("skip", [])]


def test_reasons(spark):
    turns = {
        "good": "guest host guest host", "none": "", "host": "host host", "guest": "guest guest", "late": "host guest", "odd": "guest host other guest host", "blank": "guest host guest host", "null": "guest - host guest host",
    }
    rows = [(k, p, None if w == "-" else w, float(p), p + 1.0, "" if k == "blank" and p == 2 else " a  b ") for k, ws in turns.items() for p, w in enumerate(ws.split())]
    sentences = spark.createDataFrame(rows, "k string, pos long, speaker_id string, start double, end double, text string")
    sections = spark.createDataFrame([(k,) for k in turns], "k string")
    got = {r.k: r for r in ops.rejected(sections, sentences, ["k"]).collect()}
    assert {k: r.reason_codes for k, r in got.items()} == {
        "none": ["empty_sentences", "no_host_sentences", "no_guest_sentences", "turn_count_lt_4", "no_targetable_persona_turn"], "host": ["no_guest_sentences", "turn_count_lt_4", "no_targetable_persona_turn"],
        "guest": ["no_host_sentences", "turn_count_lt_4", "no_targetable_persona_turn"], "late": ["turn_count_lt_4", "no_targetable_persona_turn"], "odd": ["unexpected_speaker_id"], "blank": ["empty_turn_text"],
    }
    assert got["odd"].merged_role_sequence == ["user", "persona", "user", "persona"] and got["odd"].preview_sentences[0].text == "a b" and got["none"].sentence_count == 0
    assert [r.reason_codes for r in ops.rejected(sections.filter("k = 'good'"), sentences, ["k"], least_turns=5).collect()] == [["turn_count_lt_5"]]
