"""Independent SQL for the named queries, written for DuckDB over the same tables."""

from __future__ import annotations

# The mapped view every reading query starts from.
_READINGS = """
r AS (
  SELECT event_id AS seq, 'sensor_' || CAST(user_id % 10 AS VARCHAR) AS id, ts,
         epoch_us(ts) // 1000 AS "timestamp", value AS temperature
  FROM events
)"""

# Arrival numbers displaced by up to 512 positions.
_ARRIVALS = _READINGS + """,
a AS (
  SELECT (seq + (seq * 37) % 512) * 512 + seq % 512 AS seq, id, ts, "timestamp", temperature
  FROM r
)"""


def _r(body: str) -> str:
    return f"WITH {_READINGS}\n{body}"


def _more(ctes: str, body: str, base: str = _READINGS) -> str:
    return f"WITH RECURSIVE {base},\n{ctes}\n{body}"


_LINES = """
WITH lines AS (
  SELECT unnest(string_split(regexp_replace(text, '\\n$', ''), chr(10))) AS value
  FROM documents WHERE text <> ''
)"""


def _split(value: str, sep: str) -> str:
    return (
        f"CASE WHEN {value} = '' THEN [''] WHEN rtrim({value}, '{sep}') = '' THEN [] "
        f"ELSE string_split(rtrim({value}, '{sep}'), '{sep}') END"
    )


def _sliding(size_ms: int, slide_ms: int, extra: str = "") -> str:
    """Every reading once per window that holds it (starts on multiples of the slide)."""
    n = -(-size_ms // slide_ms)
    return f"""
w AS (
  SELECT id, "timestamp", temperature, seq,
         "timestamp" - "timestamp" % {slide_ms} - k * {slide_ms} AS ws
  FROM r, range(0, {n}) AS steps(k)
  WHERE "timestamp" - "timestamp" % {slide_ms} - k * {slide_ms} + {size_ms} > "timestamp"
)"""


H = 3_600_000
_SLIDE = _sliding(12 * H, 4 * H)

_LATE_BASE = """
m AS (
  SELECT *, max("timestamp") OVER (ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
            - 600000 AS wm_ms
  FROM a
)"""

_HASH = (
    "(list_reduce(list_concat([0::BIGINT], list_transform(string_split(id, ''), "
    "lambda c: unicode(c)::BIGINT)), lambda h, c: (h * 31 + c) & 4294967295) * 10 "
    "+ 2147483648) & 4294967295"
)


_JUMP_LAST = 'lag(temperature) OVER (PARTITION BY id ORDER BY seq)'
_JUMP_ZERO = 'lag(temperature, 1, 0.0) OVER (PARTITION BY id ORDER BY seq)'


def oracles() -> dict[str, str]:
    high = "(temperature > 30.0 AND NOT isnan(temperature))"
    out = {
        "parse_readings": _r('SELECT seq, id, "timestamp", temperature FROM r'),
        "src_csv_table": _r('SELECT id, "timestamp", temperature FROM r'),
        "sink_text_roundtrip": _r(
            "SELECT '(' || id || ',' || count(*) || ')' AS value FROM r GROUP BY id"
        ),
        "sink_csv_roundtrip": _r("SELECT id, temperature AS temp FROM r"),
        "sink_payload": _r(
            """SELECT 'SensorReading(' || id || ',' || "timestamp" || ',' || temperature || ')' AS value FROM r"""
        ),
        "sink_csv_payload": _r("SELECT id || ',' || temperature AS value FROM r"),
        "upsert_latest": _r(
            "SELECT id AS sensor, arg_max(temperature, seq) AS temperature FROM r GROUP BY id"
        ),
        "kv_latest": _r(
            "SELECT 'sensor_temp' AS hash, id AS field, "
            "CAST(arg_max(temperature, seq) AS VARCHAR) AS value FROM r GROUP BY id"
        ),
        "doc_payload": _r(
            """
SELECT 'sensor_temp' AS index, 'readingdata' AS type,
  '{"sensor_id":"' || id || '","sensor_temp":"' || temperature || '","sensor_timestamp":"'
  || "timestamp" || '"}' AS source
FROM r"""
        ),
        "select_filter": _r("SELECT id, temperature FROM r WHERE id = 'sensor_1'"),
        "rename_project": _r('SELECT id, temperature AS temp, "timestamp" AS ts FROM r'),
        "wrap_int": _r(
            'SELECT seq, id, CAST((("timestamp" + 2147483648) & 4294967295) - 2147483648 AS INTEGER) '
            "AS ts_int FROM r"
        ),
        "split_high": _r(f'SELECT seq, id, "timestamp", temperature FROM r WHERE {high}'),
        "split_low": _r(f'SELECT seq, id, "timestamp", temperature FROM r WHERE NOT {high}'),
        "split_tags": _r(
            f"SELECT seq, id, temperature, CASE WHEN {high} THEN 'high' ELSE 'low' END AS tag FROM r"
        ),
        "connect_map": _r(
            f"""
SELECT id, temperature, 'high temp warning' AS message FROM r WHERE {high}
UNION ALL SELECT id, NULL, 'normal' FROM r WHERE NOT {high}"""
        ),
        "union_all": _r(
            "SELECT seq, id, temperature FROM r UNION ALL SELECT seq, id, temperature FROM r"
        ),
        "side_main": _r(f'SELECT id, "timestamp", temperature FROM r WHERE {high}'),
        "side_low": _r(f'SELECT id, temperature, "timestamp" FROM r WHERE NOT {high}'),
        "lateral_split": _r(
            f"""
SELECT seq, id, ts, word, CAST(length(word) + length(regexp_replace(word, '[^\\x{{10000}}-\\x{{10FFFF}}]', '', 'g')) AS INTEGER) AS length
FROM (SELECT seq, id, ts, unnest({_split('id', '_')}) AS word FROM r)"""
        ),
        "udf_hash": _r(
            f"SELECT seq, id, ts, CAST(({_HASH}) - 2147483648 AS INTEGER) AS hash FROM r"
        ),
        "wc_space": f"""{_LINES}
SELECT word, count(*) AS n FROM (SELECT unnest({_split('value', ' ')}) AS word FROM lines) GROUP BY word""",
        "wc_comma": f"""{_LINES}
SELECT word, count(*) AS n
FROM (SELECT unnest(string_split(lower(value), ',')) AS word FROM lines)
WHERE word <> '' GROUP BY word""",
        "wc_running": r"""
WITH parts AS (
  SELECT doc_id, list_filter(string_split(replace(text, chr(10), ' '), ' '), lambda w: w <> '') AS ws
  FROM documents
), placed AS (
  SELECT doc_id, unnest(range(0, len(ws))) AS p, unnest(ws) AS word FROM parts
)
SELECT doc_id, CAST(p AS INTEGER) AS pos, word,
       row_number() OVER (PARTITION BY word ORDER BY doc_id, p) AS n
FROM placed""",
        "group_count": _r("SELECT id, count(id) AS cnt FROM r GROUP BY id"),
        "rolling_sum": _r(
            "SELECT seq, id, round(sum(temperature) OVER "
            "(PARTITION BY id ORDER BY seq ROWS UNBOUNDED PRECEDING), 6) AS total FROM r"
        ),
        "rolling_reduce": _r(
            'SELECT seq, id, max("timestamp") OVER w AS max_timestamp, min(temperature) OVER w '
            "AS min_temperature FROM r WINDOW w AS (PARTITION BY id ORDER BY seq ROWS UNBOUNDED PRECEDING)"
        ),
        "rolling_min_by": _more(
            """
b AS (
  SELECT seq, id, min({'t': temperature, 's': seq, 'x': "timestamp"}) OVER
    (PARTITION BY id ORDER BY seq ROWS UNBOUNDED PRECEDING) AS best
  FROM r
)""",
            "SELECT seq, id, best.s AS min_seq, best.x AS min_timestamp, best.t AS min_temperature FROM b",
        ),
        "min_by_final": _more(
            "b AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY temperature, seq) AS k FROM r)",
            'SELECT id, seq, "timestamp", temperature FROM b WHERE k = 1',
        ),
        "changelog_count": _more(
            "c AS (SELECT seq, id, row_number() OVER (PARTITION BY id ORDER BY seq) AS n FROM r)",
            """
SELECT seq, true AS added, id, n AS cnt FROM c
UNION ALL SELECT seq, false, id, n - 1 FROM c WHERE n > 1""",
        ),
        "udaf_avg_temp": _r("SELECT id, round(avg(temperature), 6) AS avg_temp FROM r GROUP BY id"),
        "udaf_user_mean": _r("SELECT id, round(avg(temperature), 6) AS avg_temp FROM r GROUP BY id"),
        "udaf_user_top2": _r(
            """
SELECT id, rank, temperature FROM (
  SELECT id, temperature, row_number() OVER (PARTITION BY id ORDER BY temperature DESC) AS rank FROM r)
WHERE rank <= 2"""
        ),
        "tumble_count": _r(
            """
SELECT id, count(*) AS cnt, time_bucket(INTERVAL 6 HOURS, ts, TIMESTAMP '1970-01-01')
  + INTERVAL 6 HOURS AS window_end
FROM r GROUP BY ALL"""
        ),
        "slide_count": _more(_SLIDE, "SELECT ws AS window_start_ms, count(*) AS cnt FROM w GROUP BY id, ws"),
        "slide_apply": _more(_SLIDE, "SELECT ws AS window_start_ms, count(*) AS cnt FROM w GROUP BY id, ws"),
        "slide_count_1h": _more(
            _sliding(H, 60_000), "SELECT ws AS window_start_ms, count(*) AS cnt FROM w GROUP BY id, ws"
        ),
        "slide_reduce": _more(
            _SLIDE,
            'SELECT id, ws AS window_start_ms, max("timestamp") AS max_timestamp, '
            "min(temperature) AS min_temperature FROM w GROUP BY id, ws",
        ),
        "tumble_offset": _more(
            """b AS (SELECT id, time_bucket(INTERVAL 1 DAY, ts, TIMESTAMP '1969-12-31 16:00:00') AS s FROM r)""",
            "SELECT id, s AS window_start, s + INTERVAL 1 DAY AS window_end, count(*) AS cnt FROM b GROUP BY id, s",
        ),
        "session_count": _more(
            """
f AS (
  SELECT id, ts, CASE WHEN ts <= lag(ts) OVER (PARTITION BY id ORDER BY ts) + INTERVAL 30 MINUTES
                      THEN 0 ELSE 1 END AS opens
  FROM r
), g AS (
  SELECT id, ts, sum(opens) OVER (PARTITION BY id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS s FROM f
)""",
            """
SELECT id, min(ts) AS session_start, max(ts) + INTERVAL 30 MINUTES AS session_end, count(*) AS cnt
FROM g GROUP BY id, s""",
        ),
        "count_window": _more(
            """
c AS (
  SELECT seq, id, row_number() OVER (PARTITION BY id ORDER BY seq) AS nth,
         count(*) OVER w AS elements, max("timestamp") OVER w AS max_timestamp,
         min(temperature) OVER w AS min_temperature
  FROM r WINDOW w AS (PARTITION BY id ORDER BY seq ROWS BETWEEN 9 PRECEDING AND CURRENT ROW)
)""",
            "SELECT seq, id, elements, max_timestamp, min_temperature FROM c WHERE nth % 2 = 0",
        ),
        "over_rows": _r(
            """
SELECT seq, id, ts, count(id) OVER w AS cnt, round(avg(temperature) OVER w, 6) AS avg_temp
FROM r WINDOW w AS (PARTITION BY id ORDER BY ts, seq ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)"""
        ),
        "watermark_trace": _r(
            'SELECT seq, id, "timestamp", max("timestamp") OVER '
            "(ORDER BY seq ROWS UNBOUNDED PRECEDING) - 600000 AS watermark_ms FROM r"
        ),
        "watermark_punctuated_trace": _r(
            """SELECT seq, id, "timestamp", max(CASE WHEN id = 'sensor_1' THEN "timestamp" END) OVER """
            "(ORDER BY seq ROWS UNBOUNDED PRECEDING) - 600000 AS watermark_ms FROM r"
        ),
        "late_split": _more(
            _LATE_BASE,
            f"""
SELECT seq, id, "timestamp", wm_ms,
       coalesce("timestamp" - "timestamp" % {H} + {2 * H} - 1 + {3 * H} <= wm_ms, false) AS late
FROM m""",
            _ARRIVALS,
        ),
        "lateness_firings": _more(
            _LATE_BASE
            + f""",
e AS (
  SELECT seq, id, ws, ws + {2 * H} - 1 AS last_ms, coalesce(wm_ms, -4611686018427387904) AS wm
  FROM m, (SELECT unnest([0, 1]) AS k), LATERAL (SELECT "timestamp" - "timestamp" % {H} - k * {H} AS ws)
), k AS (
  SELECT *, last_ms <= wm AS again FROM e WHERE last_ms + {3 * H} > wm
)""",
            """
SELECT id, ws AS window_start_ms, 0::BIGINT AS firing, count(*) AS cnt
FROM k WHERE NOT again GROUP BY id, ws
UNION ALL
SELECT id, ws, CAST(sum(CAST(again AS BIGINT)) OVER w AS BIGINT), count(*) OVER w
FROM k WHERE true
WINDOW w AS (PARTITION BY id, ws ORDER BY again, seq ROWS UNBOUNDED PRECEDING)
QUALIFY again""",
            _ARRIVALS,
        ),
        "jump_alert": _more(
            f"j AS (SELECT seq, id, {_JUMP_LAST} AS last_temp, temperature AS cur_temp FROM r)",
            "SELECT * FROM j WHERE abs(cur_temp - last_temp) > 10.0",
        ),
        "jump_alert_zero_init": _more(
            f"j AS (SELECT seq, id, {_JUMP_ZERO} AS last_temp, temperature AS cur_temp FROM r)",
            "SELECT * FROM j WHERE abs(cur_temp - last_temp) > 10.0",
        ),
        "jump_map": _more(
            f"j AS (SELECT seq, id, {_JUMP_ZERO} AS l, temperature AS c FROM r)",
            "SELECT seq, id, CASE WHEN abs(c - l) > 10.0 THEN l ELSE 0.0 END::DOUBLE AS last_temp, "
            "CASE WHEN abs(c - l) > 10.0 THEN c ELSE 0.0 END::DOUBLE AS cur_temp FROM j",
        ),
        "sensor_profile": _more(
            """
n AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY seq DESC) AS k FROM r)""",
            """
SELECT id, arg_max(temperature, seq) AS last_temp,
       count(*) FILTER (temperature <= 10.0) AS n_low,
       count(*) FILTER (temperature > 10.0 AND temperature <= 30.0) AS n_mid,
       count(*) FILTER (temperature > 30.0) AS n_high,
       max("timestamp") AS max_timestamp, min(temperature) AS min_temperature,
       string_agg(CAST(temperature AS VARCHAR), ';' ORDER BY seq) FILTER (k <= 3) AS latest_temps
FROM n GROUP BY id""",
        ),
        "running_count": _r("SELECT seq, id, row_number() OVER (ORDER BY seq) AS n FROM r"),
        # The state machine itself, one reading per id and step; a last step flushes timers.
        "rise_alert": _more(
            """
n AS (SELECT id, ts, temperature AS t, row_number() OVER (PARTITION BY id ORDER BY ts, seq) AS k FROM r),
walk AS (
  SELECT id, 0::BIGINT AS k, 0.0::DOUBLE AS last, NULL::TIMESTAMP AS due, NULL::TIMESTAMP AS fired
  FROM (SELECT DISTINCT id FROM n)
  UNION ALL
  SELECT n.id, n.k, n.t,
    CASE WHEN n.t > w.last AND (w.due IS NULL OR w.due <= n.ts) THEN n.ts + INTERVAL 30 MINUTES
         WHEN n.t < w.last THEN NULL
         WHEN w.due <= n.ts THEN NULL
         ELSE w.due END,
    CASE WHEN w.due <= n.ts THEN w.due END
  FROM walk w JOIN n ON n.id = w.id AND n.k = w.k + 1
), ends AS (
  SELECT id, arg_max(coalesce(due, TIMESTAMP '1900-01-01'), k) AS due FROM walk GROUP BY id
)""",
            """
SELECT id, fired AS alert_ts, '温度值连续1800秒上升' AS message FROM walk WHERE fired IS NOT NULL
UNION ALL
SELECT id, due, '温度值连续1800秒上升' FROM ends WHERE due > TIMESTAMP '1900-01-01'""",
        ),
    }
    for name in ("select_filter", "lateral_split", "udf_hash", "group_count", "tumble_count", "over_rows"):
        out[f"{name}_sql"] = out[name]
    return out
