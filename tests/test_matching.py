"""Texts split over overlaps, nearest bounds and greedy names against plain Python."""

from __future__ import annotations

import random

from dialoom.operators import intervals, links

SPAN = "file_id long, i long, start_s double, end_s double, speaker string, text string"


def rows(seed, n):
    rng = random.Random(seed)
    out = []
    for f in range(4):
        for i in range(n):
            s = rng.randint(0, 400) / 2
            out.append((f, i, s, s + rng.choice([0, 0.5, 1, 7, 90]), f"SPEAKER_0{rng.randint(0, 3)}", rng.choice(["", " ", None, "one two  three", "abcdefghijkl", "été " * 9])))
    return out


def overlap(a, b):
    return max(0.0, min(a[3], b[3]) - max(a[2], b[2]))


def plain_split(left, right):
    for a in left:
        text = (a[5] or "").strip(" ")
        met = sorted(((b, overlap(a, b)) for b in right if b[0] == a[0] and overlap(a, b) > 0), key=lambda x: (x[0][2], x[0][1]))
        if not met:
            yield a[0], a[1], 0, "UNKNOWN", text, a[2], a[3]
            continue
        total = sum(o for _, o in met)
        exact = [o / total * len(text) for _, o in met]
        counts = [int(x) for x in exact]
        for _, k in sorted(((exact[k] - counts[k], k) for k in range(len(met))), reverse=True)[: len(text) - sum(counts)]:
            counts[k] += 1
        at = 0
        for k, (b, _) in enumerate(met):
            piece = text if len(met) == 1 else text[at : at + counts[k]].strip(" ")
            at += counts[k]
            yield a[0], a[1], k, b[4], piece, max(a[2], b[2]), min(a[3], b[3])


def test_split_by_overlap(spark):
    left, right = rows(1, 25), rows(2, 12)
    left.append((9, 0, 0.0, 5.0, "x", "nobody here"))
    got = intervals.split_by_overlap(spark.createDataFrame(left, SPAN), spark.createDataFrame(right, SPAN).withColumnRenamed("i", "j"), "file_id", "i", "j")
    assert sorted(map(tuple, got.select("file_id", "i", "part", "speaker", "piece", "start_s", "end_s").collect())) == sorted(plain_split(left, right))
    none = spark.createDataFrame([], SPAN)
    assert {r.speaker for r in intervals.split_by_overlap(spark.createDataFrame(left, SPAN), none.withColumnRenamed("i", "j"), "file_id", "i", "j").collect()} == {"UNKNOWN"}
    assert intervals.split_by_overlap(none, none.withColumnRenamed("i", "j"), "file_id", "i", "j").count() == 0


def test_nearest_bound_and_dominant(spark):
    left, right = rows(3, 30), rows(4, 6)
    left.append((9, 0, 0.0, 5.0, "x", ""))
    a, b = spark.createDataFrame(left, SPAN).drop("speaker"), spark.createDataFrame(right, SPAN).withColumnRenamed("i", "j")
    near = {(r.file_id, r.i): (r.j, r.distance, r.speaker) for r in intervals.nearest_bound(a, b, "file_id", "i", "j", "speaker").collect()}
    both = {(r.file_id, r.i): (r.speaker, r.seconds, r.distance) for r in intervals.dominant_or_nearest(a, b, "file_id", "i", "j").collect()}
    assert len(near) == len(both) == len(left)
    for x in left:
        key, own = x[:2], [y for y in right if y[0] == x[0]]
        if not own:
            assert near[key] == both[key] == (None, None, None)
            continue
        best = min((min(abs(y[2] - x[2]), abs(y[3] - x[3])), y[1], y[4]) for y in own)
        assert near[key] == (best[1], best[0], best[2])
        totals = {}
        for y in own:
            if overlap(x, y) > 0:
                totals.setdefault(y[4], [0.0, y[1]])[0] += overlap(x, y)
        if totals:
            who = min(totals, key=lambda w: (-totals[w][0], totals[w][1]))
            assert both[key] == (who, totals[who][0], None)
        else:
            assert both[key] == (best[2], None, best[0])


def test_tiles_are_never_broadcast(spark, tmp_path):
    """A few segments far apart make many tiles, from a table that is small enough to be sent to the driver."""
    import datetime

    import duckdb

    from dialoom import plans

    queries, sql = plans.load()
    first, step = datetime.datetime(2024, 1, 1), datetime.timedelta(seconds=600 * 97)
    kind = ("view", "click", "purchase", "error")
    events = [(7 * i, first + i * step, 1, kind[i % 4], 1.0, "{}") for i in range(200)]
    path = str(tmp_path / "events.parquet")
    spark.createDataFrame(events, "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string").coalesce(1).write.parquet(path)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1k")
    try:
        df = queries["dominant_or_nearest_speaker"](spark, str(tmp_path))
        got = [tuple(r) for r in df.collect()]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW events AS SELECT * FROM read_parquet('{path}/*.parquet')")
    assert len(got) > 3800
    assert sorted(got) == sorted(con.sql(sql["dominant_or_nearest_speaker"]).fetchall())
    assert "BroadcastExchange" not in df._jdf.queryExecution().executedPlan().toString()


def test_votes_that_meet_the_bound(spark, tmp_path):
    """Speakers with just a fifth of the most, one file for each number of equal overlaps and distance: rounding decides as in the SQL."""
    import datetime

    import duckdb

    from dialoom import plans

    queries, sql = plans.load()
    events, first = [], datetime.datetime(2024, 1, 1)

    def add(file, start, seconds, kind):
        events.append((20 * len(events) + seconds, first + datetime.timedelta(seconds=600 * start), file, kind, 1.0, "{}"))

    for file in range(600):
        for j in range(2 + file // 120):
            add(file, 20 * j, 15, "view")
            add(file, 20 * j + 2, 3, "click")
        add(file, 240 + file % 120, 1, "error")
    path = str(tmp_path / "events.parquet")
    spark.createDataFrame(events, "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string").coalesce(1).write.parquet(path)
    got = sorted(tuple(r) for r in queries["weighted_reference_vote"](spark, str(tmp_path)).collect())
    con = duckdb.connect()
    con.execute(f"CREATE VIEW events AS SELECT * FROM read_parquet('{path}/*.parquet')")
    assert len(got) == 1200
    assert got == sorted(con.sql(sql["weighted_reference_vote"]).fetchall())


def test_greedy_names(spark):
    local = [(1, 0, 10.0, 20.0, "A", ""), (1, 1, 20.0, 24.0, "B", ""), (1, 2, 24.0, 30.0, "C", ""), (1, 3, 99.0, 100.0, "D", ""), (2, 0, 12.0, 13.0, "A", "")]
    known = [(1, 0, 10.0, 19.0, "SPEAKER_01", ""), (1, 1, 18.0, 24.0, "SPEAKER_00", ""), (1, 2, 26.0, 30.0, "SPEAKER_00", "")]
    got = links.greedy_names(spark.createDataFrame(local, SPAN), spark.createDataFrame(known, SPAN), "file_id", (5.0, 40.0)).collect()
    # B and C overlap SPEAKER_00 by 4 s each; of equals the later name goes first
    assert {(r.file_id, r["local"]): (r["global"], r.matched) for r in got} == {
        (1, "A"): ("SPEAKER_01", True), (1, "C"): ("SPEAKER_00", True), (1, "B"): ("SPEAKER_02", False), (1, "D"): ("SPEAKER_03", False), (2, "A"): ("SPEAKER_00", False),
    }
