"""SQL of the boundary machines: one recursive step for each row of a file.

``stepped`` reads the rows ``z`` of each file in order with the state after the
row before; a step names what it does (``act``), the new state follows from it,
and what it emits is a row of ``m`` whose ``o_first`` is not null.
"""

from __future__ import annotations

from dialoom.sources.tables import SEGMENTS_SQL

RECURSIVE = SEGMENTS_SQL.replace("WITH ", "WITH RECURSIVE ", 1)
GUEST = "speaker NOT IN ('SPEAKER_00', 'UNKNOWN')"


def stepped(z: str, state: dict[str, tuple[str, str]], act: str, emits: dict[str, str], tail: str) -> str:
    """``z``: the rows; ``state``: name to (start, next); ``emits``: name to value of the row that goes out; ``tail``: what is selected at the end."""
    names = [*state, *emits]
    start = ", ".join([f"{v} AS {n}" for n, (v, _) in state.items()] + [f"CAST(NULL AS {'VARCHAR' if n == 'o_kind' else 'BIGINT' if n in ('o_first', 'o_last') else 'DOUBLE'}) AS {n}" for n in emits])
    step = ", ".join([f"{v} AS {n}" for n, (_, v) in state.items()] + [f"{v} AS {n}" for n, v in emits.items()])
    return f"""{RECURSIVE}, z AS (SELECT *, count(*) OVER (PARTITION BY file_id) AS n FROM ({z})),
m AS (SELECT file_id, CAST(-1 AS BIGINT) AS i, {start} FROM (SELECT DISTINCT file_id FROM z)
UNION ALL SELECT file_id, seg_idx AS i, {step}
FROM (SELECT *, {act} AS act FROM (SELECT z.*, {", ".join(f"m.{n}" for n in names if n in state)} FROM m JOIN z ON z.file_id = m.file_id AND z.seg_idx = m.i + 1)))
{tail}"""


SPANS = "file_id, o_kind AS kind, o_first AS first_idx, o_last AS last_idx, o_start AS start_s, o_end AS end_s"
BOUNDARIES = stepped(
    f"SELECT *, {GUEST} AS guest FROM seg",
    {
        "who": ("CAST(NULL AS VARCHAR)", "CASE act WHEN 'open' THEN speaker WHEN 'close' THEN NULL ELSE who END"),
        "began": ("CAST(NULL AS DOUBLE)", "CASE act WHEN 'open' THEN start_s WHEN 'close' THEN NULL ELSE began END"),
        "heard": ("CAST(NULL AS DOUBLE)", "CASE WHEN act = 'open' OR (act = 'go' AND speaker = who) THEN end_s WHEN act = 'close' THEN NULL ELSE heard END"),
        "a": ("CAST(NULL AS BIGINT)", "CASE act WHEN 'open' THEN seg_idx WHEN 'close' THEN NULL ELSE a END"),
        "b": ("CAST(NULL AS BIGINT)", "CASE act WHEN 'none' THEN b WHEN 'close' THEN NULL ELSE seg_idx END"),
    },
    """CASE WHEN NOT guest AND (who IS NULL OR heard = 0) THEN 'none' WHEN NOT guest AND start_s - heard > 120 THEN 'close' WHEN NOT guest THEN 'go'
      WHEN who IS NULL OR (speaker <> who AND start_s - heard > 60) THEN 'open' ELSE 'go' END""",
    {"o_kind": "CASE WHEN act IN ('open', 'close') THEN who END", "o_first": "CASE WHEN act IN ('open', 'close') THEN a END", "o_last": "b", "o_start": "began", "o_end": "heard + 30"},
    f""", found AS (SELECT {SPANS} FROM m WHERE o_first IS NOT NULL
UNION ALL SELECT m.file_id, m.who, m.a, m.b, m.began, e.end_s FROM m JOIN z l ON l.file_id = m.file_id AND l.seg_idx = m.i AND m.i = l.n - 1 JOIN z e ON e.file_id = m.file_id AND e.seg_idx = m.b WHERE m.who IS NOT NULL)""",
)
CONVERSATION_BOUNDARIES = BOUNDARIES + " SELECT * FROM found WHERE end_s - start_s > 180"
SHORT_PAIR_MERGE = BOUNDARIES + """, s AS (SELECT *, row_number() OVER w - 1 AS k, coalesce(end_s - start_s < 180 AND lead(start_s) OVER w - end_s < 120, false) AS joins FROM found WHERE end_s > start_s WINDOW w AS (PARTITION BY file_id ORDER BY first_idx)),
h AS (SELECT file_id, CAST(0 AS BIGINT) AS k, true AS head FROM (SELECT DISTINCT file_id FROM s) UNION ALL SELECT s.file_id, s.k + 1, NOT (h.head AND s.joins) FROM h JOIN s ON s.file_id = h.file_id AND s.k = h.k)
SELECT s.file_id, CASE WHEN s.joins THEN s.kind || '/' || t.kind ELSE s.kind END AS kind, s.first_idx, CASE WHEN s.joins THEN t.last_idx ELSE s.last_idx END AS last_idx, s.start_s, CASE WHEN s.joins THEN t.end_s ELSE s.end_s END AS end_s
FROM s JOIN h ON h.file_id = s.file_id AND h.k = s.k AND h.head LEFT JOIN s t ON t.file_id = s.file_id AND t.k = s.k + 1"""

OPENING_CALL_COMMENT = stepped(
    f"""SELECT *, speaker = 'SPEAKER_00' AND contains(text, '1') AS hi, {GUEST} AND contains(text, '7') AS bye,
  NOT coalesce(bool_or({GUEST}) OVER ahead, false) AS alone, count(*) FILTER (WHERE speaker = 'SPEAKER_00') OVER ahead > 5 AS talks
  FROM seg WINDOW ahead AS (PARTITION BY file_id ORDER BY seg_idx ROWS BETWEEN 1 FOLLOWING AND 29 FOLLOWING)""",
    {
        "state": ("'opening'", "CASE act WHEN 'close' THEN 'comment' WHEN 'stay' THEN state ELSE 'call' END"),
        "a": ("CAST(0 AS BIGINT)", "CASE act WHEN 'close' THEN seg_idx + 1 WHEN 'stay' THEN a ELSE seg_idx END"),
        "t": ("CAST(NULL AS DOUBLE)", "CASE WHEN act IN ('open', 'call') THEN start_s WHEN seg_idx = a THEN start_s ELSE t END"),
        "t0": ("CAST(NULL AS DOUBLE)", "coalesce(t0, start_s)"),
    },
    "CASE WHEN state = 'opening' AND hi THEN 'open' WHEN state = 'call' AND bye AND seg_idx > a AND alone AND talks THEN 'close' WHEN state = 'comment' AND hi AND NOT alone THEN 'call' ELSE 'stay' END",
    {
        "o_kind": "CASE act WHEN 'close' THEN 'call' WHEN 'open' THEN 'opening' END", "o_first": "CASE WHEN act = 'close' THEN a WHEN act = 'open' AND seg_idx > 0 THEN 0 END",
        "o_last": "CASE act WHEN 'close' THEN seg_idx ELSE seg_idx - 1 END", "o_start": "CASE act WHEN 'close' THEN t ELSE t0 END", "o_end": "CASE act WHEN 'close' THEN end_s ELSE start_s END",
    },
    f"SELECT {SPANS} FROM m WHERE o_first IS NOT NULL",
)

GREETED_CALLS = stepped(
    f"""SELECT g.*, coalesce(stop, final) AS upto FROM (SELECT *, first_value(CASE WHEN speaker = 'SPEAKER_00' AND contains(text, '99') THEN seg_idx END IGNORE NULLS) OVER (PARTITION BY file_id ORDER BY seg_idx ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS opens,
  speaker = 'SPEAKER_00' AND contains(text, '1') AND bool_or({GUEST}) OVER (PARTITION BY file_id ORDER BY seg_idx ROWS BETWEEN 1 FOLLOWING AND 49 FOLLOWING) AS hi,
  min(CASE WHEN {GUEST} THEN seg_idx END) OVER (PARTITION BY file_id ORDER BY seg_idx ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS begins FROM seg) g
LEFT JOIN LATERAL (SELECT min(CASE WHEN bye THEN x.seg_idx END) AS stop, max(x.seg_idx) AS final FROM (SELECT *, contains(text, '7') AND length(text) < 20 AND NOT coalesce(bool_or({GUEST}) OVER (PARTITION BY file_id ORDER BY seg_idx ROWS BETWEEN 1 FOLLOWING AND 49 FOLLOWING), false) AS bye FROM seg) x
  WHERE x.file_id = g.file_id AND x.{GUEST} AND x.seg_idx >= g.begins AND x.seg_idx < g.begins + 2000) ON true""",
    {"done": ("CAST(-1 AS BIGINT)", "CASE act WHEN 'call' THEN upto ELSE done END")},
    "CASE WHEN seg_idx > coalesce(opens, 0) AND seg_idx > done AND hi THEN 'call' ELSE 'stay' END",
    {"o_kind": "'call'", "o_first": "CASE act WHEN 'call' THEN seg_idx END", "o_last": "upto", "o_start": "start_s", "o_end": "CAST(NULL AS DOUBLE)"},
    "SELECT m.file_id, o_kind AS kind, o_first AS first_idx, o_last AS last_idx, o_start AS start_s, z.end_s FROM m JOIN z ON z.file_id = m.file_id AND z.seg_idx = o_last WHERE o_first IS NOT NULL",
)

GUEST_RUN_CALLS = RECURSIVE + f""", c AS (SELECT *, CASE WHEN speaker = lag(speaker) OVER (PARTITION BY file_id ORDER BY seg_idx) THEN 0 ELSE 1 END AS edge FROM seg),
r AS (SELECT *, sum(edge) OVER (PARTITION BY file_id ORDER BY seg_idx) AS run FROM c),
u AS (SELECT file_id, run, speaker, min(seg_idx) AS a, max(seg_idx) AS b, sum(end_s - start_s) AS t, arg_min(start_s, seg_idx) AS start_s, arg_max(end_s, seg_idx) AS end_s, max(run) OVER (PARTITION BY file_id) AS runs FROM r GROUP BY file_id, run, speaker),
m AS (SELECT file_id, CAST(0 AS HUGEINT) AS run, CAST(NULL AS VARCHAR) AS who, CAST(NULL AS BIGINT) AS a, CAST(NULL AS BIGINT) AS b, CAST(NULL AS DOUBLE) AS t, CAST(NULL AS DOUBLE) AS s, CAST(NULL AS DOUBLE) AS e, CAST(NULL AS STRUCT(kind VARCHAR, a BIGINT, b BIGINT, t DOUBLE, s DOUBLE, e DOUBLE)) AS o FROM (SELECT DISTINCT file_id FROM u)
UNION ALL SELECT file_id, run, CASE act WHEN 'open' THEN speaker WHEN 'none' THEN NULL ELSE who END, CASE act WHEN 'open' THEN ua WHEN 'none' THEN NULL ELSE a END, CASE WHEN act = 'open' OR speaker = who THEN ub WHEN act = 'none' THEN NULL ELSE b END,
  CASE WHEN act = 'open' THEN ut WHEN act = 'none' THEN NULL WHEN speaker = who THEN t + ut ELSE t END, CASE act WHEN 'open' THEN us WHEN 'none' THEN NULL ELSE s END, CASE WHEN act = 'open' OR speaker = who THEN ue WHEN act = 'none' THEN NULL ELSE e END,
  CASE WHEN act <> 'go' AND who IS NOT NULL THEN struct_pack(kind := who, a := a, b := b, t := t, s := s, e := e) END
FROM (SELECT *, CASE WHEN who IS NOT NULL AND (speaker = who OR (speaker = 'SPEAKER_00' AND ut <= 30)) THEN 'go' WHEN {GUEST} THEN 'open' ELSE 'none' END AS act
  FROM (SELECT m.file_id, m.who, m.a, m.b, m.t, m.s, m.e, u.run, u.speaker, u.a AS ua, u.b AS ub, u.t AS ut, u.start_s AS us, u.end_s AS ue FROM m JOIN u ON u.file_id = m.file_id AND u.run = m.run + 1)))
SELECT file_id, o.kind AS kind, o.a AS first_idx, o.b AS last_idx, o.s AS start_s, o.e AS end_s FROM m WHERE o.t >= 60
UNION ALL SELECT m.file_id, m.who, m.a, m.b, m.s, m.e FROM m JOIN (SELECT DISTINCT file_id, runs FROM u) x ON x.file_id = m.file_id AND m.run = x.runs WHERE m.t >= 60"""

LOOKED_AHEAD = stepped(
    """SELECT *, speaker IN ('SPEAKER_01', 'SPEAKER_03') AS guest, min(CASE WHEN speaker = 'SPEAKER_01' THEN seg_idx END) OVER later AS next1, min(CASE WHEN speaker = 'SPEAKER_03' THEN seg_idx END) OVER later AS next3
  FROM seg WINDOW later AS (PARTITION BY file_id ORDER BY seg_idx ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING)""",
    {
        "who": ("CAST(NULL AS VARCHAR)", "CASE act WHEN 'open' THEN speaker WHEN 'close' THEN NULL ELSE who END"),
        "a": ("CAST(NULL AS BIGINT)", "CASE act WHEN 'open' THEN seg_idx WHEN 'close' THEN NULL ELSE a END"),
        "t": ("CAST(NULL AS DOUBLE)", "CASE act WHEN 'open' THEN start_s WHEN 'close' THEN NULL ELSE t END"),
        "before": ("CAST(NULL AS DOUBLE)", "end_s"),
    },
    """CASE WHEN guest AND (who IS NULL OR (speaker <> who AND coalesce(CASE who WHEN 'SPEAKER_01' THEN next1 ELSE next3 END, n) > seg_idx + 9)) THEN 'open'
      WHEN NOT guest AND who IS NOT NULL AND NOT (coalesce(CASE who WHEN 'SPEAKER_01' THEN next1 ELSE next3 END, n) <= seg_idx + 19
        AND coalesce(least(next1, next3), n) = coalesce(CASE who WHEN 'SPEAKER_01' THEN next1 ELSE next3 END, n)) THEN 'close' ELSE 'stay' END""",
    {
        "o_kind": "who", "o_first": "CASE WHEN act IN ('open', 'close') THEN a END", "o_last": "CASE act WHEN 'close' THEN seg_idx ELSE seg_idx - 1 END",
        "o_start": "t", "o_end": "CASE act WHEN 'close' THEN end_s ELSE before END",
    },
    f"""SELECT {SPANS} FROM m WHERE o_first IS NOT NULL
UNION ALL SELECT m.file_id, m.who, m.a, m.i, m.t, m.before FROM m JOIN (SELECT DISTINCT file_id, n FROM z) x ON x.file_id = m.file_id AND m.i = x.n - 1 WHERE m.who IS NOT NULL""",
)

SWITCHES = stepped(
    r"SELECT *, length(regexp_replace(text, '[\s\W_]', '', 'g')) >= 8 AS said FROM seg",
    {
        "who": ("CAST(NULL AS VARCHAR)", "CASE act WHEN 'open' THEN speaker ELSE who END"),
        "a": ("CAST(NULL AS BIGINT)", "CASE act WHEN 'open' THEN seg_idx ELSE a END"),
        "hosts": ("CAST(0 AS BIGINT)", "CASE act WHEN 'host' THEN hosts + 1 WHEN 'stay' THEN hosts ELSE 0 END"),
        "seen": ("CAST(-1 AS BIGINT)", "CASE WHEN act IN ('open', 'go') THEN seg_idx ELSE seen END"),
        "calls": ("CAST(0 AS BIGINT)", "CASE act WHEN 'open' THEN calls + 1 ELSE calls END"),
    },
    """CASE WHEN speaker = 'SPEAKER_00' THEN 'host' WHEN NOT said THEN 'stay' WHEN who IS NULL OR (speaker <> who AND (hosts >= 2 OR seg_idx - seen >= 10)) THEN 'open' WHEN speaker = who THEN 'go' ELSE 'stay' END""",
    {"o_kind": "who", "o_first": "CASE act WHEN 'open' THEN a END", "o_last": "seen"},
    """, found AS (SELECT file_id, o_kind AS kind, o_first AS first_idx, o_last AS last_idx FROM m WHERE o_first IS NOT NULL
UNION ALL SELECT m.file_id, m.who, m.a, m.i FROM m JOIN (SELECT DISTINCT file_id, n FROM z) x ON x.file_id = m.file_id AND m.i = x.n - 1 WHERE m.who IS NOT NULL AND NOT (m.calls >= 2 AND m.i + 1 - m.a <= 2))
SELECT f.file_id, f.kind, f.first_idx, f.last_idx, s.start_s, e.end_s FROM found f JOIN z s ON s.file_id = f.file_id AND s.seg_idx = f.first_idx JOIN z e ON e.file_id = f.file_id AND e.seg_idx = f.last_idx""",
)

CAPPED_MERGE = stepped(
    "SELECT *, CASE speaker WHEN 'SPEAKER_00' THEN 'host' ELSE 'guest' END AS role FROM seg",
    {
        "who": ("CAST(NULL AS VARCHAR)", "role"), "a": ("CAST(NULL AS BIGINT)", "CASE act WHEN 'go' THEN a ELSE seg_idx END"), "t": ("CAST(NULL AS DOUBLE)", "CASE act WHEN 'go' THEN t ELSE start_s END"),
        "e": ("CAST(NULL AS DOUBLE)", "CASE act WHEN 'go' THEN greatest(e, end_s) ELSE end_s END"), "chars": ("CAST(NULL AS BIGINT)", "CASE act WHEN 'go' THEN chars + length(text) ELSE length(text) END"),
    },
    "CASE WHEN role = who AND start_s - e <= 0.8 AND chars + length(text) <= 140 THEN 'go' ELSE 'new' END",
    {"o_kind": "who", "o_first": "CASE act WHEN 'new' THEN a END", "o_last": "seg_idx - 1", "o_start": "t", "o_end": "e"},
    f"SELECT {SPANS} FROM m WHERE o_first IS NOT NULL UNION ALL SELECT m.file_id, m.who, m.a, m.i, m.t, m.e FROM m JOIN (SELECT DISTINCT file_id, n FROM z) x ON x.file_id = m.file_id AND m.i = x.n - 1",
)

SMOOTH_IN_PLACE = stepped(
    "SELECT *, lead(speaker) OVER (PARTITION BY file_id ORDER BY seg_idx) AS following FROM seg",
    {"label": ("CAST(NULL AS VARCHAR)", "CASE WHEN act THEN label ELSE speaker END")},
    "coalesce(end_s - start_s <= 1.0 AND label = following AND label <> speaker, false)", {}, "SELECT file_id, i AS seg_idx, label FROM m WHERE i >= 0",
)

SHORT_RUNS_MERGED = RECURSIVE + """, m AS (SELECT file_id, 0 AS k, list(speaker ORDER BY seg_idx) AS l FROM seg GROUP BY file_id
UNION ALL SELECT file_id, k + 1, list_transform(l, lambda x, i: CASE WHEN i >= e[small] AND i < e[small] + s[small] THEN l[e[near]] ELSE x END)
FROM (SELECT *, CASE WHEN small = len(s) OR (small > 1 AND s[small - 1] >= s[small + 1]) THEN small - 1 ELSE small + 1 END AS near FROM (SELECT *, list_position(list_transform(s, lambda x: x < 3), true) AS small
  FROM (SELECT *, list_transform(e, lambda x, i: coalesce(e[i + 1], len(l) + 1) - x) AS s FROM (SELECT *, list_filter(range(1, len(l) + 1), lambda i: i = 1 OR l[i] <> l[i - 1]) AS e FROM m))) WHERE small > 0 AND len(s) > 1))
SELECT file_id, CAST(unnest(range(0, len(l))) AS BIGINT) AS seg_idx, unnest(l) AS label FROM (SELECT * FROM m QUALIFY row_number() OVER (PARTITION BY file_id ORDER BY k DESC) = 1)"""

TYPED_GROUPS = RECURSIVE + """, b AS (SELECT file_id, row_number() OVER (PARTITION BY file_id ORDER BY win) AS k, win, CASE WHEN speakers >= 2 THEN 'call' ELSE 'host' END AS type
  FROM (SELECT file_id, CAST(floor((start_s - t0) / 120) AS BIGINT) AS win, count(DISTINCT CASE WHEN speaker <> 'UNKNOWN' THEN speaker END) AS speakers FROM (SELECT *, min(start_s) OVER (PARTITION BY file_id) AS t0 FROM seg) GROUP BY file_id, win)),
m AS (SELECT file_id, k, win, CAST(0 AS BIGINT) AS block, type AS kind FROM b WHERE k = 1
UNION ALL SELECT b.file_id, b.k, b.win, CASE WHEN b.type = 'call' AND m.kind = 'host' THEN m.block + 1 ELSE m.block END, CASE WHEN b.type = 'call' THEN 'call' ELSE m.kind END FROM m JOIN b ON b.file_id = m.file_id AND b.k = m.k + 1)
SELECT file_id, block, any_value(kind) AS kind, min(win) * 120.0::DOUBLE AS start_s, max(win) * 120.0::DOUBLE + 120 AS end_s, count(*) AS windows FROM m GROUP BY file_id, block"""
