"""Rebuilt sections on small planted transcripts."""

from __future__ import annotations

from dialoom.operators import sections as ops

LOST = "file_id long, idx long, kind string, persona string, title string, file_name string, source_file string, notes string"
RAW = "file_id long, idx long, pos long, start_s double, end_s double, speaker string, text string"
SOURCE = "file_id long, seg_idx long, start_s double, end_s double, speaker string, text string"
PLAN = "file_id long, title string, file_name string, start double, end double"
SAID = [(0, 0.0, 2.0, "H", "hello "), (1, 2.6, 4.0, "H", " there"), (2, 4.61, 6.0, "H", "pause"), (3, 6.0, 9.004, "G", "guest"), (4, 9.2, 9.1, "G", None), (5, 9.3, 9.5, "G", " "), (6, 20.0, 21.0, "H", "late")]


def rebuild(spark, lost, raw=(), siblings=(), source=(), plan=(), hosts=()):
    frames = [spark.createDataFrame(list(rows), schema) for rows, schema in ((lost, LOST), (raw, RAW), (siblings, "file_id long, idx long, start double, end double"), (source, SOURCE), (plan, PLAN), (hosts, "file_id long, speaker string"))]
    return {(r.file_id, r.idx): r for r in ops.rebuilt(*frames).collect()}


def section(f, i, kind="call", notes=None):
    return (f, i, kind, "p", f"{i}_t", f"{i}_t.json", f"{f}.json", notes)


def test_three_sources_and_refusal(spark):
    raw = [(1, 1, p, s, e, w, t) for p, s, e, w, t in SAID[:4]]
    source = [(f, p, s, e, w, t) for f in (2, 3, 4) for p, s, e, w, t in SAID] + [(5, 0, 1.0, 2.0, "H", "  ")]
    siblings = [(2, 0, 0.0, 4.5, ), (2, 2, 9.1, 30.0), (3, 0, 0.0, 50.0), (3, 2, 10.0, 60.0), (4, 0, 0.0, 50.0), (4, 2, 10.0, 60.0)]
    plan = [(3, None, "1_t.json", 0.0, 3.0), (4, "other", None, 0.0, 3.0)]
    lost = [section(1, 1, notes=f"old; {ops.NOTES[ops.RAW]}"), section(2, 1, notes="old"), section(3, 1, "opening"), section(4, 1), section(5, 1), section(6, 1)]
    got = rebuild(spark, lost, raw, siblings, source, plan, [(1, "H"), (2, "X")])
    say = lambda r: [(s.speaker_id, s.start, s.end, s.text) for s in r.sentences]
    # 0.6 s apart is one sentence, 0.61 s is two
    assert got[1, 1].route == "raw" and say(got[1, 1]) == [("host", 0.0, 4.0, "hellothere"), ("host", 4.61, 6.0, "pause"), ("guest", 6.0, 9.0, "guest")]
    assert got[1, 1].meta.notes == f"old; {ops.NOTES[ops.RAW]}" and got[1, 1].meta.raw_segment_count == 4 and got[1, 1].meta.sentence_count == 3
    # between 4.5 and 9.1; none of the known hosts speaks, so all are guests
    assert got[2, 1].route == "neighbours" and say(got[2, 1]) == [("guest", 4.61, 9.0, "pauseguest")] and got[2, 1].meta.notes == f"old; {ops.NOTES[ops.NEIGHBOURS]}"
    # neighbours the wrong way round: by the plan, under the file's name; openings are the host's
    assert got[3, 1].route == "plan" and say(got[3, 1]) == [("host", 0.0, 4.0, "hellothere")] and got[3, 1].meta.speaker_ids == ["host"] and got[3, 1].meta.end_ts == "00:00:04.00"
    for k in (4, 5, 6):
        assert got[k, 1].error == "no source text" and got[k, 1].meta is None and got[k, 1].sentences is None
    assert rebuild(spark, []) == {}


def test_sections_without_siblings_and_hosts(spark):
    source = [(1, p, s, e, w, t) for p, s, e, w, t in SAID]
    got = rebuild(spark, [section(1, 5)], source=source)
    # who speaks first is the host; the whole source lies between no neighbours
    assert [(s.speaker_id, s.speaker_name) for s in got[1, 5].sentences] == [("host", "Host"), ("host", "Host"), ("guest", "Guest"), ("host", "Host")]
    assert dict(got[1, 5].meta.speaker_names) == ops.NAMES


def sets(spark, sentences, source, hosts=()):
    sec = spark.createDataFrame([(1, 0, 0.0, 100.0)], "file_id long, idx long, start double, end double")
    now = spark.createDataFrame([(1, 0, *s) for s in sentences], "file_id long, idx long, speaker_id string, start double, end double")
    src = spark.createDataFrame([(1, k, *s, "x") for k, s in enumerate(source)], "file_id long, seg_idx long, start_s double, end_s double, speaker string, text string")
    r = ops.speaker_sets(sec, now, src, spark.createDataFrame([(1, 0, h) for h in hosts], "file_id long, idx long, speaker string")).first()
    return r.hosts, r.guests


def test_speaker_sets(spark):
    source = [(0.0, 40.0, "A"), (40.0, 70.0, "B"), (70.0, 75.0, "C"), (75.0, 75.5, "D"), (75.5, 99.0, "UNKNOWN")]
    assert sets(spark, [], source, ["B", "Z"]) == (["B"], ["A"])
    assert sets(spark, [("host", 0.0, 40.0), ("host", 40.0, 60.0), ("guest", 70.0, 75.0), ("guest", 75.5, 99.0)], source) == (["A", "B"], ["C"])
    # no hosts: all that speak a quarter of the longest but the guest
    assert sets(spark, [], source) == (["B", "UNKNOWN"], ["A"])
    assert sets(spark, [], [(0.0, 9.0, "A")]) == (["A"], [])
    # one who is the host and the guest is the guest if there is another host
    assert sets(spark, [("host", 0.0, 40.0), ("host", 40.0, 70.0), ("guest", 75.0, 75.4)], source, []) == (["A", "B"], ["UNKNOWN"])
    assert sets(spark, [], []) == ([], [])


def test_from_source_leaves_minor_speakers_out(spark):
    source = [(1, 0, 0.0, 10.0, "A", "q"), (1, 1, 10.0, 30.0, "B", "a" * 100), (1, 2, 30.5, 50.0, "B", "b" * 41), (1, 3, 50.0, 51.9, "C", "minor"), (1, 4, 51.9, 60.0, "D", "major"), (1, 5, 60.0, 61.0, "A", None)]
    sec = spark.createDataFrame([(1, 0, "call", 61.0, 0.0), (1, 1, "opening", 5.0, 5.1)], "file_id long, idx long, kind string, start double, end double")
    who = spark.createDataFrame([(1, 0, ["A"], ["B"]), (1, 1, ["A"], ["B"])], "file_id long, idx long, hosts array<string>, guests array<string>")
    got = {r.idx: [(s.speaker_id, s.start, s.end, s.text[:5]) for s in r.sentences] for r in ops.from_source(sec, who, spark.createDataFrame(source, SOURCE)).collect()}
    # C has under 12 % of the time of B and is left out, D is not; texts of over 140 characters are not joined
    assert got == {0: [("host", 0.0, 10.0, "q"), ("guest", 10.0, 30.0, "aaaaa"), ("guest", 30.5, 50.0, "bbbbb"), ("guest", 51.9, 60.0, "major")], 1: [("host", 0.0, 10.0, "q")]}
