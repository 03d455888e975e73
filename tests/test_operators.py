"""Thresholds and odd cases on small literal tables."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from dialoom.functions import scalars
from dialoom.operators import chat, islands, machines, qc, speakers, validation
from dialoom.operators.intervals import overlap_join


def seg(spark, rows):
    return spark.createDataFrame([(1, i, float(s), float(e), w, t) for i, (s, e, w, t) in enumerate(rows)], "file_id long, seg_idx long, start_s double, end_s double, speaker string, text string")


def frame(rows):
    return pd.DataFrame([(1, i, float(s), float(e), w, t) for i, (s, e, w, t) in enumerate(rows)], columns=["file_id", "seg_idx", "start_s", "end_s", "speaker", "text"])


def test_gap_is_strict(spark):
    rows = [(0, 1, "A", "a"), (5.99, 7, "A", "b"), (12, 13, "A", "c"), (13, 14, "B", "d")]
    gap = F.col("start_s") - F.col("prev_end_s") < 5
    got = islands.merge_speaker_runs(seg(spark, rows), gap).orderBy("island").collect()
    assert [(r.n, r.text) for r in got] == [(2, "a b"), (1, "c"), (1, "d")]


def test_islands_keep_rows_and_text(spark):
    rows = [(i, i + 1, "AB"[i // 3 % 2], str(i)) for i in range(20)]
    got = islands.merge_speaker_runs(seg(spark, rows)).collect()
    assert sum(r.n for r in got) == 20
    assert " ".join(r.text for r in sorted(got, key=lambda r: r.island)).split() == [str(i) for i in range(20)]


def test_empty_table(spark):
    assert islands.merge_speaker_runs(seg(spark, [(0, 1, "A", "a")]).limit(0)).count() == 0


def test_boundaries_close_and_filter():
    host, a, b = "SPEAKER_00", "SPEAKER_01", "SPEAKER_02"
    rows = [(0, 10, a, ""), (150, 160, a, ""), (200, 201, host, ""), (300, 301, host, ""), (400, 410, b, ""), (450, 460, a, ""), (600, 640, b, "")]
    got = list(machines.conversation_boundaries(frame(rows)))
    # the host's row at 300 comes 140 s after the guest's end at 160: closed at 190; 190 s are over 180
    assert got[0] == (a, 0, 2, 0.0, 190.0)
    assert got[1] == (b, 4, 6, 400.0, 640.0)
    exact = [(10, 20, a, ""), (150, 160, a, ""), (300, 301, host, "")]
    assert not list(machines.conversation_boundaries(frame(exact)))  # 180 exactly is not over 180


def test_short_pairs_consume_two():
    spans = [("a", 0, 1, 0.0, 10.0), ("b", 2, 3, 100.0, 110.0), ("c", 4, 5, 150.0, 160.0)]
    assert machines.merge_short_pairs(spans) == [("a/b", 0, 3, 0.0, 110.0), ("c", 4, 5, 150.0, 160.0)]


def test_capped_merge_length():
    rows = [(0, 1, "SPEAKER_00", "x" * 100), (1.8, 2, "SPEAKER_00", "y" * 40), (2, 3, "SPEAKER_00", "z")]
    assert [s[1:3] for s in machines.capped_merge(frame(rows))] == [(0, 1), (2, 2)]


def test_looked_ahead_guest_returns():
    who = ["SPEAKER_01", "SPEAKER_03", "SPEAKER_01", "SPEAKER_03"] + ["SPEAKER_03"] * 12
    got = list(machines.looked_ahead_guests(frame([(i, i + 1, w, "") for i, w in enumerate(who)])))
    assert [(s[0], s[1], s[2]) for s in got] == [("SPEAKER_01", 0, 2), ("SPEAKER_03", 3, 15)]


def test_smoothing_in_place_and_runs():
    assert machines.smoothed_in_place(list("ABABB"), np.ones(5, bool)) == list("AAABB")
    assert machines.merged_short_runs(list("AAABAAA")) == list("AAAAAAA")
    assert machines.merged_short_runs(list("AB")) == list("BB")
    assert machines.merged_short_runs([]) == []


def test_largest_remainders_ties_go_late():
    assert machines.largest_remainders(5, [1, 1]) == [2, 3]
    assert machines.largest_remainders(3, [0, 0]) == [0, 0]
    assert sum(machines.largest_remainders(101, [0.3, 0.3, 0.4])) == 101


def test_greedy_pairs():
    assert machines.greedy_pairs([(2.0, "a", "x"), (2.0, "b", "x"), (1.0, "b", "y")]) == {"a": "x", "b": "y"}


def test_overlap_join_counts_each_pair_once(spark):
    left = spark.createDataFrame([(1, 0.0, 500.0), (1, 60.0, 60.0)], "k int, a double, b double")
    right = spark.createDataFrame([(1, 30.0, 400.0), (1, 500.0, 501.0), (2, 0.0, 9.0)], "k int, c double, d double")
    assert overlap_join(left, right, "k", ("a", "b"), ("c", "d")).count() == 3


def test_scalars(spark):
    one = spark.range(1)
    pick = lambda c: one.select(c.alias("x")).first().x
    text = F.lit
    assert pick(scalars.parse_clock(text("01:02:03.5"))) == 3723.5
    assert pick(scalars.parse_clock(text("02:03"))) == 123
    assert pick(scalars.occurrences(text("谢谢谢谢谢你好"), ["谢谢", "你好"])) == 3
    assert pick(scalars.occurrences(F.lit(None).cast("string"), ["谢谢", "你好"])) == 0
    assert pick(scalars.fnv32(text(""))) == 2166136261
    assert pick(scalars.fnv32(text("a😀"))) == (((2166136261 ^ 97) * 16777619 % 2**32) ^ 0xD83D) * 16777619 % 2**32
    assert pick(scalars.parse_clock(text("x"))) == 0
    assert pick(scalars.hhmmss(F.lit(3661.9))) == "010101"
    assert pick(scalars.clock(F.lit(-5.0))) == "00:00:00"
    assert pick(scalars.srt_time(F.lit(1.5))) == "00:00:01,500"
    assert pick(scalars.chinese_date(text("2024年3月5日"))) == "2024-03-05"
    assert pick(scalars.chinese_date(text("x20240305_y"))) == "2024-03-05"
    assert pick(scalars.chinese_date(text("none"))) is None
    assert pick(scalars.preview(text("x" * 160))) == "x" * 160
    assert pick(scalars.preview(text("x" * 161))) == "x" * 157 + "..."
    assert [pick(scalars.clamped_score(text(s))) for s in ("0", "1", "5", "6", "", "x")] == [None, 1, 5, None, None, None]
    assert pick(scalars.is_filler(text("嗯啊")))
    assert pick(scalars.tokens(text("Ab c 你好你 12"))) == ["ab", "12", "你", "好"]
    assert pick(scalars.without_control(text("<think>a</think>b<|x|>"))) == "b"


def test_turn_sequence_and_section(spark):
    rows = [
        (1, 0, 0, "user", "guest", 0.0, 5.0), (1, 1, 1, "lead", "host", 5.0, 9.0),
        (2, 0, 1, "user", "host", -1.0, 5.0), (2, 1, 1, "user", "guest", 4.0, None), (2, 2, 2, "lead", None, 4.5, 4.0), (2, 3, None, "user", "guest", None, 30.0),
    ]
    turns = spark.createDataFrame([(*r, 0.0, 20.0) for r in rows], "record_id long, pos long, turn_index long, role string, speaker_id string, start double, end double, section_start double, section_end double")
    got = {(r.record_id, r.pos): [i.code for i in r.issues] for r in qc.turn_issues(turns).collect()}
    assert got == {
        (1, 0): [], (1, 1): [],
        (2, 0): ["turn_index_not_sequential", "role_speaker_mismatch", "turn_outside_section"],
        (2, 1): ["adjacent_same_role_turns", "turn_time_overlap"],
        (2, 2): ["role_speaker_mismatch", "turn_time_reversed", "turn_time_overlap"],
        (2, 3): ["turn_index_not_sequential", "turn_outside_section"],
    }


def test_recall_of_chinese_text(spark):
    at = "timestamp '2024-03-15 00:00:00'"
    queries = spark.createDataFrame([(1, 1, "我\u3000在北京 2024 ab"), (2, 1, "没有")], "session long, query_id long, text string")
    memories = [(1, 1, "住在北京", 7), (1, 2, "2024 年 ab", 0), (1, 3, "上海 7", 1), (1, 4, "上海 8", 20), (1, 5, "x" * 400 + " 北京", 28), (3, 6, "北京", 0)]
    rows = spark.createDataFrame(memories, "session long, memory_id long, text string, age int")
    rows = rows.withColumn("updated_at", F.expr(f"{at} - make_dt_interval(age)"))
    got = chat.recall(queries, rows, F.expr(at), 5).orderBy("rank").collect()
    assert [(r.memory_id, round(r.score, 6)) for r in got] == [(2, 8.0), (1, 6.5), (3, round(13 / 14, 6)), (4, 0.0), (5, 0.0)]
    assert chat.recall(queries, rows, F.expr(at), 2).count() == 2


def test_chinese_queries_find_memories(spark, tmp_path):
    from dialoom import plans

    spark.createDataFrame([(1, "北京 a"), (2, "a b")], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    spark.createDataFrame([(1, "在北京 a b"), (3, "东京 a")], "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(1, 0, "你好 ab"), (1, 20, "好")], "conv_id long, turn long, text string").write.parquet(str(tmp_path / "conversations.parquet"))
    got = plans.load()[0]["tokenise_overlap_topk"](spark, str(tmp_path)).collect()
    assert sorted((r.item_id, r.doc_id, r.score) for r in got) == [(1, 1, 4), (1, 3, 2)]
    assert sorted((r.turn, r.score) for r in plans.load()[0]["memory_recall"](spark, str(tmp_path)).collect()) == [(0, 6.0), (20, 2.0)]


def test_turn_edges(spark):
    rows = [(1, 0, "assistant", "x"), (1, 1, "user", "a"), (1, 2, "user", "b"), (1, 3, "assistant", "c"), (1, 4, "user", "d"), (2, 0, "assistant", "only")]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = [tuple(r) for r in chat.merge_turns(turns).orderBy("conv_id", "pos").collect()]
    assert got == [(1, 0, "user", "a\n\nb"), (1, 1, "assistant", "c")]
    stable = {(r.conv_id, r.turn): r.stable for r in chat.stable_turns(turns).collect()}
    assert stable == {(1, 0): True, (1, 1): False, (1, 2): True, (1, 3): True, (1, 4): False, (2, 0): True}


def test_statuses(spark):
    df = spark.createDataFrame([(1, 5), (2, -1), (3, 50)], "id int, v int")
    rules = [qc.Rule("negative", F.col("v") < 0), qc.Rule("large", F.col("v") > 10, "warning")]
    got = {r.id: r.s for r in qc.evaluated(df, rules).select("id", qc.status_of(F.col("issues")).alias("s")).collect()}
    assert got == {1: "pass", 2: "fail", 3: "warn"}


def test_two_clusters_and_means():
    x = np.array([[1, 0], [1, 0.1], [0, 1], [0.1, 1]], float)
    labels = speakers.two_clusters(x)
    assert labels.tolist() == [0, 0, 1, 1]
    assert speakers.silhouette(x, labels) > 0.8
    assert speakers.silhouette(x, np.zeros(4, int)) is None
    assert speakers.two_clusters(np.zeros((3, 2))).tolist()[0] == 0
    assert speakers.two_means(np.array([0.1, 0.9, 0.12, 0.88])).tolist() == [0, 1, 0, 1]
    assert speakers.two_means(np.array([0.1, 0.11])) is None


@pytest.mark.parametrize("seed", range(3))
def test_boundaries_against_a_plain_fold(seed):
    rng = np.random.default_rng(seed)
    t, rows = 0.0, []
    for _ in range(300):
        t += float(rng.integers(0, 90))
        rows.append((t, t + float(rng.integers(0, 20)), ["SPEAKER_00", "SPEAKER_01", "SPEAKER_02", "UNKNOWN"][rng.integers(0, 4)], ""))
    want, guest, start, last, held = [], None, None, None, []
    for i, (s, e, w, _) in enumerate(rows):
        if w in ("SPEAKER_00", "UNKNOWN"):
            if guest is not None and last and s - last > 120:
                want.append((guest, start, last + 30))
                guest, held = None, []
            elif guest is not None and last:
                held.append(i)
        elif guest is None or (w != guest and s - last > 60):
            if guest is not None:
                want.append((guest, start, last + 30))
            guest, start, last, held = w, s, e, [i]
        else:
            last = e if w == guest else last
            held.append(i)
    if guest is not None:
        want.append((guest, start, rows[held[-1]][1]))
    got = [(s[0], s[3], s[4]) for s in machines.conversation_boundaries(frame(rows))]
    assert got == [x for x in want if x[2] - x[1] > 180]


def test_blocks_and_priors():
    w = lambda k, i: (k, i * 120.0, i * 120.0 + 120, [i])
    got = machines.fold_blocks([w("host", 0), w("host", 1), w("call", 2), w("host", 3), w("call", 4)], machines.same_or_short)
    assert [(b[0], b[3]) for b in got] == [("host", [0, 1]), ("call", [2, 3, 4])]
    assert [b[3] for b in machines.fold_blocks([w("a", i) for i in range(9)], machines.same_type, 5)] == [[0, 1, 2, 3, 4]]
    assert machines.opening_prior(["guest", "guest", "guest"], [0, 5, 30], [1, 2, 2], [True, True, True]) == ["host", "host", "guest"]
    assert machines.voted(["host", "host"], [("guest", 0.6), ("guest", 0.59)]) == ["guest", "host"]
    assert machines.proportional_slices("abcdefg", [1, 1, 1]) == ["ab", "cde", "fg"] and machines.proportional_slices("", [1]) == [""]


def test_schema_rules(spark):
    schema = {
        "required": ["id", "meta"], "properties": {
            "id": {"type": "string"}, "version": {"const": "v1"}, "grade": {"enum": ["A", "B"]}, "n": {"type": "integer", "minimum": 1},
            "turns": {"type": "array", "minItems": 2, "uniqueItems": True}, "meta": {"type": "object", "required": ["topic"], "properties": {}},
        },
    }
    good = '{"id":"x","version":"v1","grade":"A","n":2,"turns":[1,2],"meta":{"topic":"t"}}'
    bad = '{"version":"v2","grade":"C","n":0,"turns":[1],"meta":{}}'
    df = spark.createDataFrame([(1, good), (2, bad), (3, '{"id":"x","meta":{"topic":1},"turns":[1,1],"n":"z"}')], "k int, raw string")
    shown = lambda i: f"{i.path}{'.' + i.detail if i.keyword == 'required' else ''}: {i.keyword}"
    got = {r.k: sorted(map(shown, r.i)) for r in df.select("k", validation.issues(schema, F.parse_json("raw"), F.lit("$")).alias("i")).collect()}
    assert got[1] == []
    assert got[2] == ["$.grade: enum", "$.id: required", "$.meta.topic: required", "$.n: minimum", "$.turns: minItems", "$.version: const"]
    assert got[3] == ["$.n: type", "$.turns: uniqueItems"]
