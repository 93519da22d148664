"""DuckDB SQL each query must agree with, over the same tables.

Written the plain way (calendar joins, outer joins, window fills), independently of how the
Spark side does it.
"""

from __future__ import annotations

AS_OF = "DATE '2024-02-05'"


def iso(day: str) -> str:
    return f"CAST(DATE '1970-01-01' + CAST({day} AS INTEGER) AS VARCHAR)"


def exact(x: str, digits: int) -> str:
    """Correctly rounded decimal text of the binary value, read back."""
    return f"CAST(printf('%.{digits}f', {x}) AS DOUBLE)"


def added(x: str) -> str:
    """Sum of doubles as one whole number of 2^-60ths; of what is not finite, whatever the engine makes of it."""
    finite = f"SUM(CAST(CASE WHEN isfinite({x}) THEN trunc({x} * pow(2::DOUBLE, 60)) END AS HUGEINT))"
    other = f"SUM({x}) FILTER (NOT isfinite({x}))"
    return f"(CASE WHEN {other} IS NULL THEN CAST({finite} AS DOUBLE) / pow(2::DOUBLE, 60) ELSE {other} END)"


RAW = """
ev AS (
  SELECT event_id, user_id, event_type,
         CAST(CAST(ts AS DATE) - DATE '1970-01-01' AS BIGINT) AS local_date,
         CAST(floor(value * 100 + CAST(0.5 AS DOUBLE)) AS BIGINT) AS cv,
         CASE WHEN event_id % 5 = 0 THEN 2 ELSE 4 END AS app_info_id
  FROM events),
sleep_session AS (
  SELECT event_id AS row_id, user_id, local_date, app_info_id,
         local_date * 86400000 AS start_time, local_date * 86400000 + cv * 6000 AS end_time
  FROM ev WHERE event_type = 'signup'),
sleep_stages AS (
  SELECT s.row_id AS parent_key, s.user_id, v.stage_type, s.start_time AS stage_start_time,
         s.start_time + ((s.end_time - s.start_time) * v.pct) // 100 AS stage_end_time
  FROM sleep_session s
  CROSS JOIN (VALUES (1, 5), (2, 5), (4, 50), (5, 20), (6, 20)) v(stage_type, pct)
  WHERE s.end_time - s.start_time >= 3600000),
steps AS (
  SELECT user_id, local_date, app_info_id, CASE WHEN cv % 11 = 0 THEN 0 ELSE cv END AS count
  FROM ev WHERE event_type = 'view'),
active_calories AS (
  SELECT user_id, local_date, app_info_id, CAST(cv * 97 AS DOUBLE) AS energy
  FROM ev WHERE event_type = 'click'),
exercise AS (
  SELECT user_id, local_date,
         CASE event_id % 5 WHEN 0 THEN 45 WHEN 1 THEN 53 WHEN 2 THEN 58 WHEN 3 THEN 5 ELSE 99 END
           AS exercise_type,
         local_date * 86400000 AS start_time, local_date * 86400000 + cv * 600 AS end_time
  FROM ev WHERE event_type = 'purchase'),
resting_hr AS (
  SELECT user_id, local_date, 40 + cv % 90 AS beats_per_minute FROM ev WHERE event_type = 'error'),
spo2 AS (
  SELECT user_id, local_date, CAST(80 + cv % 21 AS DOUBLE) AS percentage
  FROM ev WHERE event_type IN ('error', 'view')),
weight AS (
  SELECT event_id AS row_id, user_id, local_date, CAST(60000 + cv % 30000 AS DOUBLE) AS weight
  FROM ev WHERE event_type = 'click')
"""

#: The tables with edge cases: <name>_all as they are, <name> without records that lack a user or date.
EDGES = (
    RAW[: RAW.index("sleep_session AS (")].replace("ev AS (", "ev0 AS (")
    + """
ev AS (
  SELECT event_id, CASE WHEN event_id % 13 <> 0 THEN user_id % 40 END AS user_id, event_type,
         CASE WHEN event_id % 17 = 0 THEN NULL WHEN event_id % 19 = 0 THEN local_date + 40 ELSE local_date END AS local_date,
         cv, app_info_id FROM ev0),
sleep_session_all AS (
  SELECT event_id AS row_id, user_id, local_date, app_info_id, local_date * 86400000 AS start_time,
         local_date * 86400000 + CASE event_id % 4 WHEN 0 THEN 1800000 WHEN 1 THEN 1799999 ELSE cv * 6000 END AS end_time
  FROM ev WHERE event_type = 'signup' AND coalesce(user_id % 7 <> 3, true)),
sleep_stages_all AS (
  SELECT s.row_id AS parent_key, s.user_id, v.stage_type, s.start_time AS stage_start_time,
         s.start_time + ((s.end_time - s.start_time) * v.pct) // 100 AS stage_end_time
  FROM sleep_session_all s
  CROSS JOIN (VALUES (1, 5), (2, 5), (4, 50), (5, 20), (6, 20)) v(stage_type, pct)
  WHERE s.end_time - s.start_time >= 3600000),
steps_all AS (
  SELECT user_id, local_date, app_info_id, CASE WHEN event_id % 11 <> 0 THEN cv END AS count
  FROM ev WHERE event_type = 'view'),
active_calories_all AS (
  SELECT user_id, local_date, app_info_id, CASE WHEN event_id % 23 <> 0 THEN cv * 97 / CAST(10 AS DOUBLE) END AS energy
  FROM ev WHERE event_type = 'click'),
exercise_all AS (
  SELECT user_id, local_date, CASE event_id % 3 WHEN 0 THEN 45 WHEN 1 THEN 53 ELSE 58 END AS exercise_type,
         local_date * 86400000 AS start_time, local_date * 86400000 + 600000 AS end_time
  FROM ev WHERE event_type = 'purchase'),
resting_hr_all AS (
  SELECT user_id, local_date, CASE WHEN event_id % 9 <> 0 THEN 96 + cv % 10 END AS beats_per_minute
  FROM ev WHERE event_type = 'error'),
spo2_all AS (
  SELECT user_id, local_date, CASE WHEN event_id % 9 <> 0 THEN 84 + cv % 20 / CAST(7 AS DOUBLE) END AS percentage
  FROM ev WHERE event_type IN ('error', 'view')),
weight_all AS (
  SELECT event_id AS row_id, user_id, local_date,
         CASE WHEN event_id % 3 <> 0 THEN CAST(60000 + cv % 30000 AS DOUBLE) END AS weight
  FROM ev WHERE event_type = 'click')"""
    + "".join(
        f",\n{t} AS (SELECT * FROM {t}_all WHERE user_id IS NOT NULL AND local_date IS NOT NULL)"
        for t in "sleep_session steps active_calories exercise resting_hr spo2 weight".split()
    )
    + ",\nsleep_stages AS (SELECT * FROM sleep_stages_all WHERE user_id IS NOT NULL)\n"
)

#: Added measures that are not finite at times, or have twelve decimals.
_ODD = "CASE WHEN event_id % 101 = 0 THEN CAST('NaN' AS DOUBLE) WHEN event_id % 103 = 0 THEN CAST('Infinity' AS DOUBLE)"
_TINY = "+ event_id / CAST(1000000000000 AS DOUBLE) END"
EXTREMES = EDGES.replace(
    "CASE WHEN event_id % 23 <> 0 THEN cv * 97 / CAST(10 AS DOUBLE) END AS energy",
    f"{_ODD} WHEN event_id % 107 = 0 THEN CAST('-Infinity' AS DOUBLE) ELSE"
    f" CASE WHEN event_id % 23 <> 0 THEN cv * 97 / CAST(10 AS DOUBLE) END {_TINY} AS energy",
).replace(
    "CASE WHEN event_id % 9 <> 0 THEN 84 + cv % 20 / CAST(7 AS DOUBLE) END AS percentage",
    f"{_ODD} ELSE CASE WHEN event_id % 9 <> 0 THEN 84 + cv % 20 / CAST(7 AS DOUBLE) END {_TINY} AS percentage",
)

LABEL = (
    "CASE {0} WHEN 45 THEN 'Fuerza' WHEN 53 THEN 'Running' WHEN 58 THEN 'Senderismo' ELSE 'Otro' END"
)
WEEKDAY = (
    "['Lunes','Martes','Miércoles','Jueves','Viernes','Sábado','Domingo'][isodow({0})]"
)


def silver(k: str) -> str:
    """The Silver tables; k is 'user_id, ' or ''."""
    on = lambda a, b: f"{a}.user_id = {b}.user_id AND " if k else ""
    part = "PARTITION BY user_id" if k else ""
    s_k = "s.user_id, " if k else ""
    hours = "(sleep_ms / CAST(1000 AS DOUBLE) / CAST(3600 AS DOUBLE))"

    def minutes(c: str) -> str:
        return f"({c}_ms / CAST(1000 AS DOUBLE) / CAST(60 AS DOUBLE))"

    def stage(name: str, code: int) -> str:
        return (
            f"CAST(SUM(CASE WHEN st.stage_type = {code} THEN st.stage_end_time - st.stage_start_time"
            f" ELSE 0 END) AS BIGINT) AS {name}_ms"
        )

    return f"""
session_day AS (
  SELECT {k}local_date, CAST(SUM(end_time - start_time) AS BIGINT) AS sleep_ms
  FROM sleep_session WHERE app_info_id = 4 GROUP BY {k}local_date),
stage_day AS (
  SELECT {s_k}s.local_date, {stage('light', 4)}, {stage('deep', 5)}, {stage('rem', 6)},
         {stage('awake', 1)}
  FROM sleep_stages st JOIN sleep_session s ON {on('st', 's')}st.parent_key = s.row_id
  GROUP BY {s_k}s.local_date),
silver_sleep AS (
  SELECT {k.replace('user_id', 'd.user_id')}{iso('d.local_date')} AS local_date,
         round({hours}, 2) AS sleep_hours,
         round({minutes('light')}, 1) AS light_minutes, round({minutes('deep')}, 1) AS deep_minutes,
         round({minutes('rem')}, 1) AS rem_minutes, round({minutes('awake')}, 1) AS awake_minutes,
         CASE WHEN {minutes('awake')} IS NULL THEN NULL ELSE round_even(greatest(0, least(1,
           ({hours} * 60 - {minutes('awake')}) / ({hours} * 60))), 3) END AS sleep_efficiency
  FROM session_day d LEFT JOIN stage_day g ON {on('d', 'g')}d.local_date = g.local_date
  WHERE {hours} >= 0.5),
silver_steps AS (
  SELECT {k}{iso('local_date')} AS local_date, CAST(SUM(count) AS INTEGER) AS steps
  FROM steps WHERE app_info_id = 4 GROUP BY {k}steps.local_date HAVING SUM(count) > 0),
silver_calories AS (
  SELECT {k}{iso('local_date')} AS local_date, round({added('energy')} / CAST(1000 AS DOUBLE), 1) AS active_kcal
  FROM active_calories WHERE app_info_id = 4 GROUP BY {k}active_calories.local_date),
by_type AS (
  SELECT {k}{iso('local_date')} AS local_date, exercise_type, COUNT(*) AS workouts,
         CAST(SUM(end_time - start_time) AS BIGINT) AS ms
  FROM exercise GROUP BY {k}exercise.local_date, exercise_type),
dominant AS (
  SELECT {k}local_date, exercise_type AS top_type FROM by_type
  QUALIFY row_number() OVER (PARTITION BY {k}local_date ORDER BY ms DESC, exercise_type) = 1),
silver_exercise AS (
  SELECT {k}local_date, CAST(SUM(workouts) AS INTEGER) AS workouts,
         round(CAST(SUM(ms) AS BIGINT) / CAST(1000 AS DOUBLE) / CAST(60 AS DOUBLE), 1) AS workout_minutes,
         any_value({LABEL.format('top_type')}) AS workout_type
  FROM by_type JOIN dominant USING ({k}local_date) GROUP BY {k}local_date),
silver_heart_rate AS (
  SELECT {k}{iso('local_date')} AS local_date, CAST(MIN(beats_per_minute) AS INTEGER) AS resting_hr
  FROM resting_hr WHERE beats_per_minute <= 100 GROUP BY {k}resting_hr.local_date),
silver_spo2 AS (
  SELECT {k}{iso('local_date')} AS local_date, round({added('percentage')} / COUNT(percentage), 2) AS spo2_avg,
         MIN(percentage) AS spo2_min
  FROM spo2 WHERE percentage >= 85 GROUP BY {k}spo2.local_date),
reading AS (
  SELECT {k}row_id, DATE '1970-01-01' + CAST(local_date AS INTEGER) AS day,
         weight / CAST(1000 AS DOUBLE) AS kg FROM weight
  WHERE DATE '1970-01-01' + CAST(local_date AS INTEGER) <= {AS_OF}),
first_day AS (SELECT {k}MIN(day) AS first FROM reading GROUP BY {k or 'ALL'}{"" if not k else "ALL"}),
calendar AS (
  SELECT {k}CAST(unnest(generate_series(first, {AS_OF}, INTERVAL 1 DAY)) AS DATE) AS day
  FROM first_day),
weight_rows AS (
  SELECT {k.replace('user_id', 'c.user_id')}c.day, r.row_id, r.kg,
         round_even(last_value(r.kg IGNORE NULLS) OVER ({part.replace('user_id', 'c.user_id')}
           ORDER BY c.day, r.kg IS NULL, r.row_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 2) AS weight_kg
  FROM calendar c LEFT JOIN reading r ON {on('c', 'r')}c.day = r.day),
silver_weight AS (SELECT {k}CAST(day AS VARCHAR) AS local_date, weight_kg FROM weight_rows)
""".replace("GROUP BY ALL\n", "GROUP BY ALL\n").replace("GROUP BY user_id, ALL", "GROUP BY user_id")


def gold(k: str) -> str:
    using = f"({k}local_date)"
    return f"""
spine AS (SELECT * FROM silver_steps FULL OUTER JOIN silver_sleep USING {using}),
gold AS (
  SELECT {k}local_date, COALESCE(steps, 0) AS steps, sleep_hours, light_minutes, deep_minutes,
         rem_minutes, awake_minutes, sleep_efficiency, active_kcal,
         COALESCE(workouts, 0) AS workouts, COALESCE(workout_minutes, 0.0) AS workout_minutes,
         COALESCE(workout_type, 'Descanso') AS workout_type, resting_hr, spo2_avg, spo2_min,
         weight_kg, CASE WHEN workouts > 0 THEN 1 ELSE 0 END AS is_workout_day
  FROM spine
  LEFT JOIN silver_calories USING {using} LEFT JOIN silver_exercise USING {using}
  LEFT JOIN silver_heart_rate USING {using} LEFT JOIN silver_spo2 USING {using}
  LEFT JOIN silver_weight USING {using})
"""


def week(k: str) -> str:
    g_k = "a.user_id, " if k else ""
    on = "g.user_id = a.user_id AND " if k else ""
    by = f"GROUP BY {k.rstrip(', ')}" if k else ""
    return f"""
anchors AS (
  SELECT {k}MAX(CAST(local_date AS DATE)) AS anchor FROM gold WHERE sleep_hours > 0 {by}),
one_day AS (
  SELECT * FROM gold
  QUALIFY row_number() OVER (PARTITION BY {k}local_date ORDER BY weight_kg) = 1),
week_spine AS (
  SELECT {k}anchor, CAST(unnest(generate_series(anchor - 6, anchor, INTERVAL 1 DAY)) AS DATE) AS day
  FROM anchors),
week AS (
  SELECT {g_k}CAST(a.day AS VARCHAR) AS fecha, {WEEKDAY.format('a.day')} AS dia,
         {exact('sleep_hours', 1)} AS sleep_h, {exact('deep_minutes', 0)} AS deep_min,
         {exact('rem_minutes', 0)} AS rem_min, COALESCE(steps, 0) AS steps,
         {exact('active_kcal', 0)} AS kcal,
         CASE WHEN g.local_date IS NULL THEN '-' ELSE workout_type END AS workout,
         COALESCE({exact('workout_minutes', 0)}, 0.0) AS w_min,
         {exact('CAST(resting_hr AS DOUBLE)', 1)} AS hr, {exact('spo2_avg', 1)} AS spo2
  FROM week_spine a LEFT JOIN one_day g ON {on}g.local_date = CAST(a.day AS VARCHAR)),
stats AS (
  SELECT {k}CAST(COALESCE(SUM(steps) FILTER (steps > 0), 0) AS BIGINT) AS total_steps,
         COUNT(*) FILTER (workout NOT IN ('-', 'Descanso')) AS training_days,
         COALESCE(SUM(w_min), 0.0) AS training_minutes,
         {exact("COALESCE(CAST(SUM(CAST(sleep_h AS DECIMAL(17,1))) AS DOUBLE), 0.0) / greatest(COUNT(sleep_h), 1)", 2)} AS avg_sleep,
         {exact("COALESCE(SUM(deep_min) FILTER (sleep_h IS NOT NULL), 0.0) / greatest(COUNT(sleep_h), 1)", 1)} AS avg_deep,
         {exact("COALESCE(CAST(SUM(CAST(hr AS DECIMAL(17,1))) AS DOUBLE), 0.0) / greatest(COUNT(hr), 1)", 1)} AS avg_hr
  FROM week {by}),
prior AS (
  SELECT {g_k}round_even(AVG(g.steps), 0) AS prior_avg_steps,
         round_even(CAST(SUM(CAST(g.sleep_hours AS DECIMAL(18,6))) AS DOUBLE) / COUNT(g.sleep_hours), 2)
           AS prior_avg_sleep
  FROM anchors a LEFT JOIN gold g
    ON {on}CAST(g.local_date AS DATE) BETWEEN a.anchor - 13 AND a.anchor - 7
  GROUP BY {g_k or 'ALL'}{'' if k else ''})
""".replace("GROUP BY a.user_id, )", "GROUP BY a.user_id)").replace("  GROUP BY ALL)", "  )")


REPORT = """
blocks AS (
  SELECT user_id, fecha,
    CASE WHEN dia IN ('Sábado', 'Domingo') THEN '🟡' ELSE '🔵' END || ' ' || dia || ' (' || fecha || E')\\n'
    || '   💤 Sueño: ' || COALESCE(CAST(sleep_h AS VARCHAR), '-') || 'h  |  🧠 Profundo: '
    || COALESCE(CAST(deep_min AS VARCHAR), '-') || 'min  |  🌀 REM: '
    || COALESCE(CAST(rem_min AS VARCHAR), '-') || E'min\\n'
    || '   🚶 Pasos: ' || CAST(steps AS VARCHAR) || '  |  🔥 Kcal: '
    || COALESCE(CAST(kcal AS VARCHAR), '-') || E'\\n'
    || '   ' || CASE workout WHEN 'Fuerza' THEN '💪' WHEN 'Running' THEN '🏃' WHEN 'Senderismo' THEN '🥾'
                             WHEN 'Otro' THEN '🏋️' ELSE '😴' END
    || ' Entreno: ' || workout || ' — '
    || CASE WHEN workout = '-' THEN '0' ELSE CAST(w_min AS VARCHAR) END || E'min\\n'
    || '   ❤️ FC reposo: ' || COALESCE(CAST(hr AS VARCHAR) || ' bpm', 'sin datos')
    || '  |  🩸 SpO2: ' || COALESCE(CAST(spo2 AS VARCHAR) || '%', 'sin datos') || E'\\n' AS text
  FROM week),
week_texts AS (
  SELECT user_id, MIN(fecha) AS fecha_inicio, MAX(fecha) AS fecha_fin,
         E'📅 RESUMEN DÍA A DÍA\\n\\n' || string_agg(text, E'\\n' ORDER BY fecha) AS tabla
  FROM blocks GROUP BY user_id),
summaries AS (
  SELECT user_id, fecha_inicio, fecha_fin, tabla,
    'DATOS DE LA SEMANA (' || fecha_inicio || ' → ' || fecha_fin || E')\\n\\n' || tabla
    || E'\\n\\nESTADÍSTICAS:\\n- Total pasos: ' || CAST(total_steps AS VARCHAR)
    || E'\\n- Días de entrenamiento: ' || CAST(training_days AS VARCHAR) || '/7'
    || E'\\n- Total minutos entrenados: '
    || CASE WHEN training_minutes = 0 THEN '0' ELSE CAST(training_minutes AS VARCHAR) END
    || E'\\n- Media sueño/noche: ' || CAST(avg_sleep AS VARCHAR) || 'h'
    || E'\\n- Media sueño profundo/noche: ' || CAST(avg_deep AS VARCHAR) || 'min'
    || E'\\n- Media FC reposo: ' || CAST(avg_hr AS VARCHAR) || ' bpm'
    || E'\\n\\nSEMANA ANTERIOR:\\n- Media pasos: ' || COALESCE(CAST(prior_avg_steps AS VARCHAR), 'N/A')
    || E'\\n- Media sueño: ' || COALESCE(CAST(prior_avg_sleep AS VARCHAR), 'N/A') || E'h\\n' AS summary
  FROM week_texts JOIN stats USING (user_id) JOIN prior USING (user_id))
"""

K = "user_id, "
SILVER, GOLD, WEEK = silver(K), gold(K), week(K)
BLANK = r"[\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"


def stripped(col: str) -> str:
    steps = [("<[^>]+>", "''"), ("```[a-z]*", "''"), (r"\*+", "''")]
    for pattern, by in steps:
        col = f"regexp_replace({col}, '{pattern}', {by}, 'g')"
    col = rf"regexp_replace({col}, '\n{BLANK}*\n{BLANK}*\n', E'\n\n', 'g')"
    return rf"regexp_replace(regexp_replace({col}, '\A{BLANK}+', ''), '{BLANK}+\z', '')"


def chunked(keys: str, source: str, size: int) -> str:
    return f"""SELECT {keys}CAST(i AS INTEGER) AS chunk_no, substring(body, CAST(i * {size} + 1 AS BIGINT), {size}) AS chunk
FROM (SELECT {keys}body, unnest(range((length(body) + {size - 1}) // {size})) AS i FROM ({source}))"""


def over(*ctes: str, select: str) -> str:
    return "WITH " + ",".join(ctes) + "\n" + select


def silver_table(name: str) -> str:
    return over(RAW, SILVER, select=f"SELECT * FROM silver_{name}")


def of_gold(select: str) -> str:
    return over(RAW, SILVER, GOLD, select=select)


def of_week(select: str) -> str:
    return over(RAW, SILVER, GOLD, WEEK, select=select)


def of_report(select: str) -> str:
    return over(RAW, SILVER, GOLD, WEEK, REPORT, select=select)


RAW_TABLES = {
    "sleep_session_record_table": "sleep_session",
    "sleep_stages_table": "sleep_stages",
    "steps_record_table": "steps",
    "active_calories_burned_record_table": "active_calories",
    "exercise_session_record_table": "exercise",
    "resting_heart_rate_record_table": "resting_hr",
    "oxygen_saturation_record_table": "spo2",
    "weight_record_table": "weight",
}
RAW_COUNTS = " UNION ALL ".join(
    f"SELECT '{name}' AS source_table, COUNT(*) AS rows FROM {cte}"
    for name, cte in RAW_TABLES.items()
)
UNDATED = " UNION ALL ".join(
    f"SELECT '{name}' AS source_table, COUNT(*) FILTER (local_date IS NULL) AS undated_rows FROM {cte}_all"
    for name, cte in RAW_TABLES.items()
    if name != "sleep_stages_table"
)
KEYLESS = " UNION ALL ".join(
    f"SELECT '{name}' AS source_table, COUNT(*) FILTER (user_id IS NULL) AS keyless_rows FROM {cte}_all"
    for name, cte in RAW_TABLES.items()
)
LAYER_COUNTS = " UNION ALL ".join(
    f"SELECT '{layer}', '{name}', COUNT(*) FROM {cte}"
    for layer, name, cte in [
        *[("silver", t, f"silver_{t}") for t in
          ["sleep", "steps", "calories", "exercise", "heart_rate", "spo2", "weight"]],
        ("gold", "daily_metrics", "gold"),
        ("report", "weekly", "summaries"),
    ]
)

SESSION_MS = "(end_time - start_time)"
HOURS = f"({SESSION_MS} / CAST(1000 AS DOUBLE) / CAST(3600 AS DOUBLE))"
MINUTES = f"({SESSION_MS} / CAST(1000 AS DOUBLE) / CAST(60 AS DOUBLE))"
KG = "(weight / CAST(1000 AS DOUBLE))"

ORACLES: dict[str, str] = {
    "epoch_day_to_iso": over(
        RAW, select=f"SELECT user_id, local_date, {iso('local_date')} AS day, count FROM steps"
    ),
    "unit_and_rounding": over(
        RAW,
        select=f"""SELECT row_id, {KG} AS kg, round({KG}, 2) AS half_away, round_even({KG}, 2) AS half_even,
  {exact(f'round_even({KG}, 2)', 1)} AS exact, CAST({KG} * 2 AS INTEGER) AS whole FROM weight""",
    ),
    "duration_units": over(
        RAW,
        select=f"""SELECT row_id, {HOURS} AS hours, {MINUTES} AS minutes, {exact(HOURS, 1)} AS hours_1,
  round({MINUTES}, 1) AS minutes_1 FROM sleep_session""",
    ),
    "code_label": over(
        RAW,
        select=f"""SELECT user_id, local_date, start_time, end_time, exercise_type,
  {LABEL.format('exercise_type')} AS label FROM exercise""",
    ),
    "weekday_name": over(
        RAW,
        select=f"""SELECT user_id, {iso('local_date')} AS day,
  {WEEKDAY.format("(DATE '1970-01-01' + CAST(local_date AS INTEGER))")} AS dia, count FROM steps""",
    ),
    "source_filter": over(
        RAW, select="SELECT user_id, local_date, count FROM steps WHERE app_info_id = 4"
    ),
    "sensor_filter_bpm": over(RAW, select="SELECT * FROM resting_hr WHERE beats_per_minute <= 100"),
    "sensor_filter_spo2": over(RAW, select="SELECT * FROM spo2 WHERE percentage >= 85"),
    "stage_session_join": over(
        RAW,
        select=f"""SELECT st.user_id, parent_key, {iso('local_date')} AS local_date, app_info_id, stage_type, stage_start_time,
  stage_end_time FROM sleep_stages st
  JOIN sleep_session s ON st.user_id = s.user_id AND st.parent_key = s.row_id""",
    ),
    "stage_minutes_pivot": over(
        RAW,
        SILVER,
        select=f"SELECT user_id, {iso('local_date')} AS local_date, "
        + ", ".join(
            f"{n}_ms / CAST(1000 AS DOUBLE) / CAST(60 AS DOUBLE) AS {n}_minutes"
            for n in ["light", "deep", "rem", "awake"]
        )
        + " FROM stage_day",
    ),
    "sleep_session_hours": over(
        RAW,
        select=f"""SELECT user_id, {iso('local_date')} AS local_date, app_info_id, CAST(SUM({SESSION_MS}) AS BIGINT)
  / CAST(1000 AS DOUBLE) / CAST(3600 AS DOUBLE) AS sleep_hours
  FROM sleep_session GROUP BY user_id, sleep_session.local_date, app_info_id""",
    ),
    "sleep_efficiency": over(
        RAW, SILVER, select="SELECT user_id, local_date, sleep_efficiency FROM silver_sleep"
    ),
    "silver_sleep_watch_stages": over(
        RAW,
        SILVER.replace("GROUP BY s.user_id, s.local_date", "WHERE s.app_info_id = 4 GROUP BY s.user_id, s.local_date"),
        select="SELECT * FROM silver_sleep",
    ),
    **{
        f"silver_{t}": silver_table(t)
        for t in ["sleep", "steps", "calories", "exercise", "heart_rate", "spo2", "weight"]
    },
    "silver_weight_last": over(
        RAW,
        SILVER,
        select="""SELECT user_id, CAST(day AS VARCHAR) AS local_date, weight_kg FROM weight_rows
  QUALIFY row_number() OVER (PARTITION BY user_id, day ORDER BY row_id DESC) = 1""",
    ),
    "exercise_by_type": over(
        RAW,
        SILVER,
        select="""SELECT user_id, local_date, exercise_type, workouts,
  ms / CAST(1000 AS DOUBLE) / CAST(60 AS DOUBLE) AS workout_minutes FROM by_type""",
    ),
    "dominant_workout": over(
        RAW,
        SILVER,
        select=f"""SELECT user_id, local_date, top_type, {LABEL.format('top_type')} AS workout_type
  FROM dominant""",
    ),
    "weight_calendar": over(
        RAW,
        SILVER,
        select="""SELECT DISTINCT user_id, CAST(day AS VARCHAR) AS local_date, kg IS NOT NULL AS has_reading
  FROM weight_rows""",
    ),
    "weight_ffill": over(
        RAW,
        SILVER,
        select=f"""SELECT user_id, CAST(day AS VARCHAR) AS local_date, weight_kg,
  CAST(COALESCE(lead(day) OVER (PARTITION BY user_id ORDER BY day), {AS_OF} + 1) AS VARCHAR) AS next_day
  FROM (SELECT * FROM weight_rows WHERE kg IS NOT NULL
        QUALIFY row_number() OVER (PARTITION BY user_id, day ORDER BY row_id DESC) = 1)""",
    ),
    "gold_spine": of_gold("SELECT user_id, local_date, COALESCE(steps, 0) AS steps, sleep_hours FROM spine"),
    "gold_daily_metrics": of_gold("SELECT * FROM gold"),
    "gold_single_series": over(RAW, silver(""), gold(""), select="SELECT * FROM gold"),
    "gold_duplicate_days": of_gold(
        "SELECT user_id, local_date, COUNT(*) AS cnt FROM gold GROUP BY user_id, local_date HAVING cnt > 1"
    ),
    "gold_duplicate_count": of_gold(
        """SELECT COUNT(*) AS duplicate_days FROM (
  SELECT user_id, local_date, COUNT(*) AS cnt FROM gold GROUP BY user_id, local_date HAVING cnt > 1)"""
    ),
    "undated_rows": over(EDGES, select=UNDATED),
    "keyless_rows": over(EDGES, select=KEYLESS),
    **{
        f"silver_{t}_edges": over(EDGES, SILVER, select=f"SELECT * FROM silver_{t}")
        for t in ["sleep", "steps", "calories", "exercise", "heart_rate", "spo2", "weight"]
    },
    **{f"silver_{t}_extremes": over(EXTREMES, SILVER, select=f"SELECT * FROM silver_{t}") for t in ["calories", "spo2"]},
    "dominant_workout_ties": over(
        EDGES,
        SILVER,
        select=f"""SELECT user_id, local_date, top_type, {LABEL.format('top_type')} AS workout_type
  FROM dominant""",
    ),
    "gold_edges": over(EDGES, SILVER, GOLD, select="SELECT * FROM gold"),
    "week_rows_edges": over(EDGES, SILVER, GOLD, WEEK, select="SELECT * FROM week"),
    "week_over_week_edges": over(EDGES, SILVER, GOLD, WEEK, select="SELECT * FROM stats JOIN prior USING (user_id)"),
    "report_summary_edges": over(EDGES, SILVER, GOLD, WEEK, REPORT, select="SELECT user_id, summary FROM summaries"),
    "stored_gold_order": of_gold("SELECT COUNT(*) AS rows, CAST(0 AS BIGINT) AS overlapping_files FROM gold"),
    "gold_sql_view": of_gold(
        """SELECT local_date, COUNT(*) AS rows, CAST(SUM(steps) AS BIGINT) AS steps, CAST(SUM(is_workout_day) AS BIGINT) AS workouts
  FROM gold GROUP BY local_date"""
    ),
    "bronze_text_formats": over(
        RAW,
        SILVER,
        select="""SELECT user_id, local_date, steps, active_kcal
  FROM silver_steps FULL OUTER JOIN silver_calories USING (user_id, local_date)""",
    ),
    "bronze_malformed_rows": over(
        RAW,
        select="""SELECT source_table, count(*) FILTER (NOT damaged) OVER (PARTITION BY source_table) AS rows,
  count(*) FILTER (damaged) OVER (PARTITION BY source_table) AS malformed, record FROM (
  SELECT 'steps_record_table' AS source_table, (user_id + local_date) % 10 = 0 AS damaged,
         user_id || ',' || local_date || ',' || app_info_id || ',x' || count AS record FROM steps
  UNION ALL SELECT 'active_calories_burned_record_table', (user_id + local_date) % 10 = 0,
         '{"user_id":' || user_id || ',"local_date":' || local_date || ',"app_info_id":' || app_info_id
         || ',"energy":' || CAST(energy AS BIGINT) FROM active_calories)
QUALIFY damaged""",
    ),
    "bronze_status_broken": over(
        RAW,
        select=f"""SELECT source_table, CASE WHEN failed THEN NULL ELSE rows END AS rows, failed FROM (
  SELECT *, source_table IN ('steps_record_table', 'sleep_stages_table', 'weight_record_table') AS failed FROM ({RAW_COUNTS}))""",
    ),
    "run_lenient_status": of_report(
        f"""SELECT layer, table_name, CASE WHEN failed THEN NULL ELSE rows END AS rows, failed,
  CASE WHEN failed THEN 'empty' END AS stood_in FROM (
  SELECT *, table_name IN ('oxygen_saturation_record_table', 'spo2') AS failed FROM (
    SELECT 'bronze' AS layer, source_table AS table_name, rows FROM ({RAW_COUNTS}) UNION ALL {LAYER_COUNTS}))"""
    ),
    "text_strip_edges": f"""SELECT doc_id, {stripped("fenced")} AS content FROM (
  SELECT doc_id, E'```python\\n' || text || E'\\n```\\n\\n \\t\\n\\n**<b>' || doc_id || E'</b>** \\n\\n\\n' AS fenced FROM documents)""",
    "week_anchor": of_week("SELECT user_id, CAST(anchor AS VARCHAR) AS anchor FROM anchors"),
    "week_rows": of_week("SELECT * FROM week"),
    "week_stats": of_week("SELECT * FROM stats"),
    "prior_week_stats": of_week("SELECT * FROM prior"),
    "week_over_week": of_week("SELECT * FROM stats JOIN prior USING (user_id)"),
    "week_rows_single_series": over(
        RAW, silver(""), gold(""), week(""), select="SELECT * FROM week"
    ),
    "report_day_text": of_report("SELECT * FROM blocks"),
    "report_week_text": of_report("SELECT * FROM week_texts"),
    "report_summary_text": of_report("SELECT user_id, summary FROM summaries"),
    "report_messages": of_report(
        chunked(
            "user_id, ",
            """SELECT user_id, E'📊 INFORME SEMANAL\\n' || fecha_inicio || ' → ' || fecha_fin || E'\\n\\n' || tabla
  AS body FROM week_texts""",
            400,
        )
    ),
    "text_strip_markup": f"SELECT page_id, {stripped('html')} AS content FROM pages",
    "text_strip_documents": f"SELECT doc_id, {stripped('text')} AS content FROM documents",
    "text_chunks": chunked("doc_id, ", "SELECT doc_id, text AS body FROM documents", 4000),
    "analysis_messages": chunked(
        "doc_id, ",
        f"SELECT doc_id, E'🤖 ANÁLISIS EXPERTO\\n\\n' || {stripped('text')} AS body FROM documents",
        4000,
    ),
    "bronze_status": over(
        RAW, select=f"SELECT source_table, rows, CAST(NULL AS VARCHAR) AS error FROM ({RAW_COUNTS})"
    ),
    "latest_snapshot": silver_table("steps"),
    "full_run_report": of_report("SELECT * FROM summaries"),
    "full_run_status": of_report(
        f"""SELECT layer, table_name, rows, CAST(NULL AS VARCHAR) AS error, CAST(NULL AS VARCHAR) AS stood_in FROM (
  SELECT 'bronze' AS layer, source_table AS table_name, rows FROM ({RAW_COUNTS})
  UNION ALL {LAYER_COUNTS})"""
    ),
}
