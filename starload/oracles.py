"""The same questions in DuckDB SQL over the same Parquet tables, by query name.

The expectations are stated from the planted rules, not by parsing the JSON again.
"""

from __future__ import annotations

# Parts as games (before the gate), and the games that pass it.
RAW = """raw AS (
  SELECT CAST(p_partkey AS INT) AS appid, p_name AS name, p_brand AS brand, p_type AS kind, p_size AS size,
    CAST(round(p_retailprice*100) AS INT) AS price,
    CASE WHEN p_size < 49 THEN CAST(round(p_retailprice*100) AS INT) END AS price_initial,
    CASE WHEN p_size < 49 THEN CAST(CAST(round(p_retailprice*100) AS BIGINT)*(100-p_size)//100 AS INT) END AS price_final,
    p_size AS price_discount_percent,
    CASE WHEN p_type <> 'MEDIUM' THEN 'USD' END AS price_currency,
    CAST(NULL AS VARCHAR) AS release_date,
    CASE WHEN p_size < 49 AND p_brand <> 'Brand#11' THEN p_type END AS short_description,
    CAST(to_json(string_split(p_name, ' ')) AS VARCHAR) AS genres,
    DATE '2024-01-01' + p_size AS updated_on
  FROM part),
games AS (SELECT * FROM raw WHERE price_initial IS NOT NULL OR price_final IS NOT NULL OR short_description IS NOT NULL),
publisher_pairs AS (
  SELECT DISTINCT appid, publisher_name, updated_on FROM (
    SELECT appid, brand AS publisher_name, size, updated_on FROM games
    UNION ALL SELECT appid, kind, size, updated_on FROM games) p
  WHERE size NOT IN (17, 19)),
genre_pairs AS (SELECT DISTINCT appid, unnest(string_split(name, ' ')) AS genre_name FROM games)"""

SHIPMENTS = """snap AS (
  SELECT CAST(l_partkey AS INT) AS appid, CAST(l_shipdate AS DATE) AS recorded_date,
    CAST(sum(l_quantity) AS INT) AS ccu, CAST(count(*) AS INT) AS score, max(l_linenumber) AS userscore,
    CAST(min(l_suppkey) AS VARCHAR) || ' .. ' || CAST(max(l_suppkey) AS VARCHAR) AS owners,
    CAST(round(max(l_tax)*100) AS INT) AS average_playtime, CAST(round(min(l_discount)*100) AS INT) AS median_playtime
  FROM lineitem GROUP BY 1, 2)"""

ACTIVITY = """snap AS (
  SELECT CAST(user_id AS INT) AS appid, CAST(ts AS DATE) AS recorded_date,
    CAST(count(*) AS INT) AS ccu, CAST(count(*) FILTER (event_type = 'purchase') AS INT) AS score,
    CAST(count(*) FILTER (event_type = 'error') AS INT) AS userscore, CAST(NULL AS VARCHAR) AS owners,
    CAST(round(max(value)*100) AS INT) AS average_playtime, CAST(round(min(value)*100) AS INT) AS median_playtime
  FROM events GROUP BY 1, 2)"""

FACT = """fact AS (
  SELECT s.*, g.name, CAST(strftime(s.recorded_date, '%Y%m%d') AS INT) AS date_key,
    CAST(strftime(s.recorded_date, '%Y%m') AS INT) AS ym, CAST(dayofweek(s.recorded_date) AS INT) AS day_of_week
  FROM snap s JOIN games g USING (appid))"""

# What the three payloads should yield.
PARSED = """listed AS (
  SELECT appid, size, kind, brand, price,
    CASE WHEN kind = 'SMALL' THEN '' WHEN size = 7 THEN NULL ELSE name END AS name,
    CASE WHEN size > 5 THEN size ELSE 0 END AS score,
    CASE WHEN size BETWEEN 40 AND 44 THEN NULL ELSE size*2 END AS userscore,
    CASE WHEN brand = 'Brand#9' THEN '' ELSE CAST(size AS VARCHAR) || ' .. ' || CAST(size*2 AS VARCHAR) END AS owners,
    CASE WHEN kind = 'MEDIUM' THEN 0 ELSE size*10 END AS average_playtime,
    CASE WHEN size >= 45 THEN NULL ELSE size+1 END AS median_playtime,
    CASE WHEN size = 3 THEN 0 WHEN size = 4 THEN NULL ELSE price END AS ccu
  FROM raw),
judged AS (
  SELECT *, CASE WHEN kind = 'PROMO' THEN 'body_not_object' WHEN kind = 'SMALL' THEN NULL
      WHEN size = 13 THEN 'data_not_object' WHEN size = 14 THEN 'price_not_object'
      WHEN size = 15 THEN 'genres_not_objects' END AS reject_reason
  FROM raw),
outcomes AS (
  SELECT *, CASE WHEN reject_reason IS NOT NULL THEN 'reject' WHEN kind = 'SMALL' THEN 'fallback' ELSE 'detail' END AS outcome
  FROM judged),
details AS (
  SELECT appid, outcome, reject_reason,
    outcome = 'detail' AND size NOT BETWEEN 20 AND 22 AS has_name,
    CASE WHEN outcome = 'detail' AND size NOT BETWEEN 20 AND 23 THEN name || ' HD' END AS detail_name,
    CASE WHEN outcome = 'detail' AND kind <> 'LARGE' THEN price_initial END AS price_initial,
    CASE WHEN outcome = 'detail' AND kind <> 'LARGE' THEN price_final END AS price_final,
    CASE WHEN outcome = 'detail' AND kind <> 'LARGE' AND size < 49 THEN size END AS price_discount_percent,
    CASE WHEN outcome = 'detail' AND kind NOT IN ('LARGE', 'MEDIUM') AND size < 49 THEN 'USD' END AS price_currency,
    CASE WHEN outcome = 'detail' AND size <= 45 THEN brand END AS release_date,
    CASE WHEN outcome = 'detail' THEN short_description END AS short_description,
    CASE WHEN outcome = 'detail' THEN CASE WHEN size = 24 THEN '[]' ELSE '["' || brand || '"]' END END AS developers,
    CASE WHEN outcome = 'detail' THEN '["' || brand || '"," ' || kind || ' "]' END AS publishers,
    CASE WHEN outcome = 'detail' THEN '["' || kind || '",null]' END AS categories,
    CASE WHEN outcome = 'detail' THEN genres END AS genres
  FROM outcomes),
counted AS (
  SELECT appid, CASE WHEN size = 32 OR brand = 'Brand#13' OR size = 30 THEN 0 WHEN size = 31 THEN NULL
    ELSE appid + 1 END AS ccu
  FROM raw),
enriched AS (
  SELECT l.appid, CASE WHEN d.has_name THEN d.detail_name ELSE l.name END AS name, l.name AS list_name,
    l.score, l.userscore, l.owners, l.average_playtime, l.median_playtime, c.ccu, l.size, l.brand, l.kind,
    d.* EXCLUDE (appid, has_name, detail_name)
  FROM listed l JOIN details d USING (appid) JOIN counted c USING (appid)),
ingested AS (
  SELECT *,
    price_initial IS NOT NULL OR short_description IS NOT NULL AS first_gate,
    price_initial IS NOT NULL OR (short_description IS NOT NULL AND size >= 12) AS second_gate
  FROM enriched WHERE reject_reason IS NULL)"""

CALENDAR = """days AS (
  SELECT CAST(unnest(generate_series(
    (SELECT CAST(min(l_shipdate) AS DATE) FROM lineitem),
    (SELECT CAST(max(l_shipdate) AS DATE) FROM lineitem), INTERVAL 1 DAY)) AS DATE) AS d)"""


def _with(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


ON_SHIPMENTS = _with(RAW, SHIPMENTS, FACT)
ON_ACTIVITY = _with(RAW, ACTIVITY, FACT)
ON_PARSED = _with(RAW, PARSED)
ON_ARRIVALS = (
    _with(RAW, ACTIVITY)
    + """, arrived AS (
  SELECT 1 AS batch, * FROM snap WHERE recorded_date <= DATE '2024-01-20'
  UNION ALL SELECT 1, * REPLACE (ccu * 2 AS ccu) FROM snap WHERE recorded_date <= DATE '2024-01-20' AND userscore > 0
  UNION ALL SELECT 2, * FROM snap WHERE recorded_date >= DATE '2024-01-18'),
stored_days AS (SELECT DISTINCT recorded_date FROM arrived WHERE batch = 1 AND appid IN (SELECT appid FROM games)),
judged AS (
  SELECT *, CASE WHEN appid NOT IN (SELECT appid FROM games) THEN 'no_game'
    WHEN batch = 2 AND recorded_date IN (SELECT recorded_date FROM stored_days) THEN 'day_stored'
    WHEN row_number() OVER (PARTITION BY batch, appid, recorded_date ORDER BY ccu DESC) > 1 THEN 'repeated' END AS reject_reason
  FROM arrived)
"""
)
RECENT = "recorded_date >= DATE '2024-01-30' - 30"
METRICS = "ccu, score, userscore, owners, average_playtime, median_playtime"

ORACLES = {
    "s1_parse_top_list": ON_PARSED
    + "SELECT appid, name, score, userscore, owners, average_playtime, median_playtime, ccu FROM listed",
    "s2_app_details": ON_PARSED + "SELECT * FROM details",
    "s3_player_count": ON_PARSED + "SELECT * FROM counted",
    "j1_enrich": ON_PARSED
    + """SELECT appid, name, score, ccu, price_final, price_currency, short_description, developers, categories, genres
    FROM enriched WHERE reject_reason IS NULL""",
    "p11_rejects": ON_PARSED
    + "SELECT appid, name, reject_reason FROM enriched WHERE reject_reason IS NOT NULL",
    "p7_gate": _with(RAW) + "SELECT appid, price_initial, short_description FROM games",
    "s7_snapshot_guard": _with(ACTIVITY)
    + """SELECT appid, recorded_date, ccu FROM snap WHERE recorded_date NOT IN
    (SELECT recorded_date FROM snap WHERE recorded_date <= DATE '2024-01-20')""",
    "a7_last_wins": """SELECT user_id, event_id, event_type FROM (
      SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events) e
    WHERE rn = 1""",
    "m1_upsert_games": _with(RAW)
    + """SELECT appid, name,
      CASE WHEN kind IN ('SMALL', 'LARGE') THEN price_final + 2 ELSE price_final END AS price_final,
      CASE WHEN kind IN ('SMALL', 'LARGE') AND size <= 25 THEN NULL ELSE short_description END AS short_description,
      genres,
      CASE WHEN kind = 'SMALL' THEN DATE '2024-03-01' ELSE DATE '2023-06-01' END AS created_on,
      CASE WHEN kind IN ('SMALL', 'LARGE') THEN DATE '2024-03-01' ELSE DATE '2023-06-01' END AS updated_on
    FROM raw""",
    "c6_ingest_games": ON_PARSED
    + """SELECT appid, name, price_final,
      CASE WHEN second_gate AND size < 12 THEN NULL ELSE short_description END AS short_description, publishers,
      '2024-05-01 06' AS created,
      CASE WHEN second_gate THEN '2024-05-02 09' ELSE '2024-05-01 06' END AS updated
    FROM ingested WHERE first_gate""",
    "c6_ingest_snapshots": ON_PARSED
    + """SELECT appid, name, recorded_date, ccu, score, userscore, owners, average_playtime, median_playtime,
      strftime(recorded_date, '%Y-%m-%d') || ' 06' AS created
    FROM (SELECT *, DATE '2024-05-01' AS recorded_date FROM ingested WHERE first_gate
      UNION ALL SELECT *, DATE '2024-05-02' FROM ingested WHERE first_gate) s""",
    "s5_calendar": _with(CALENDAR)
    + """SELECT CAST(strftime(d, '%Y%m%d') AS INT) AS date_key, d AS full_date,
      CAST(dayofweek(d) AS INT) AS day_of_week, rpad(dayname(d), 9, ' ') AS day_name,
      CAST(month(d) AS INT) AS month, rpad(monthname(d), 9, ' ') AS month_name,
      CAST(quarter(d) AS INT) AS quarter, CAST(year(d) AS INT) AS year,
      dayofweek(d) IN (0, 6) AS is_weekend, CAST(strftime(d, '%Y%m') AS INT) AS ym
    FROM days""",
    "m2_scd1": _with(RAW)
    + """SELECT appid, name, release_date, price_initial, price_final, price_discount_percent,
      CASE WHEN updated_on > DATE '2024-01-15' THEN 'EUR' ELSE price_currency END AS price_currency,
      CASE WHEN updated_on <= DATE '2024-01-15' AND short_description = 'PROMO' THEN NULL ELSE short_description END AS short_description,
      CASE WHEN updated_on <= DATE '2024-01-15' THEN DATE '2024-01-15' ELSE DATE '2024-03-01' END AS created_on,
      CASE WHEN updated_on <= DATE '2024-01-15' AND coalesce(short_description, '') <> 'PROMO' THEN DATE '2024-01-15'
        ELSE DATE '2024-03-01' END AS updated_on
    FROM games""",
    "k1_dense_keys": """SELECT count(*) AS n, CAST(1 AS BIGINT) AS lowest, count(*) AS highest, count(*) AS different
    FROM (SELECT DISTINCT l_orderkey FROM lineitem) o""",
    "j6_unnest": _with(RAW) + "SELECT appid, publisher_name FROM publisher_pairs",
    "m3_publishers": _with(RAW)
    + """SELECT publisher_name,
      CASE WHEN min(updated_on) <= DATE '2024-01-15' THEN DATE '2024-01-15' ELSE DATE '2024-03-01' END AS created_on
    FROM publisher_pairs GROUP BY 1""",
    "m3_genres": _with(RAW) + "SELECT DISTINCT genre_name FROM genre_pairs",
    "m3_insert_if_absent": _with(CALENDAR)
    + """SELECT d AS full_date, CASE WHEN year(d) <= 1998 THEN 'kept' ELSE rpad(dayname(d), 9, ' ') END AS day_name
    FROM days""",
    "m6_bridge_publishers": _with(RAW) + "SELECT appid, publisher_name FROM publisher_pairs",
    "m6_bridge_genres": _with(RAW) + "SELECT appid, genre_name FROM genre_pairs",
    "c5_fact_full": ON_SHIPMENTS + f"SELECT appid, date_key, {METRICS} FROM fact",
    "c5_fact_two_batches": ON_SHIPMENTS
    + f"""SELECT appid, date_key, {METRICS} FROM fact
    WHERE NOT (recorded_date <= DATE '1998-12-31' AND userscore = 7)""",
    "m4_upsert_fact": _with(SHIPMENTS)
    + """SELECT CAST(appid AS BIGINT) AS game_key, CAST(strftime(recorded_date, '%Y%m%d') AS INT) AS date_key,
      CASE WHEN year(recorded_date) >= 1998 THEN ccu*2 ELSE ccu END AS ccu, score, userscore,
      CASE WHEN year(recorded_date) >= 1998 THEN NULL ELSE owners END AS owners, average_playtime, median_playtime,
      CASE WHEN year(recorded_date) <= 1998 THEN DATE '2024-01-15' ELSE DATE '2024-03-01' END AS created_on
    FROM snap""",
    "p9_past_bookmark": _with(SHIPMENTS)
    + """SELECT appid, recorded_date, ccu FROM snap
    WHERE recorded_date > DATE '1998-12-31' AND recorded_date <= DATE '2000-06-30'""",
    "c5_calendar_drop": _with(RAW, SHIPMENTS)
    + """SELECT CASE WHEN g.appid IS NULL THEN 'no_game_no_day' ELSE 'no_day' END AS reason, count(*) AS n
    FROM snap s LEFT JOIN games g ON s.appid = g.appid GROUP BY 1""",
    "q5_orphans": _with(RAW, SHIPMENTS)
    + """SELECT * FROM (SELECT s.appid, s.recorded_date,
      CASE WHEN g.appid IS NULL AND year(s.recorded_date) NOT BETWEEN 1996 AND 2000 THEN 'no_game_no_day'
        WHEN g.appid IS NULL THEN 'no_game' WHEN year(s.recorded_date) NOT BETWEEN 1996 AND 2000 THEN 'no_day' END AS reason
      FROM snap s LEFT JOIN games g ON s.appid = g.appid) o WHERE reason IS NOT NULL""",
    "m5_bookmark": """SELECT 'fact_game_metrics' AS table_name, CAST(max(l_shipdate) AS DATE) AS last_loaded_date
    FROM lineitem""",
    "c3_read_bookmark": _with(ACTIVITY)
    + """SELECT 'known' AS bookmark, count(*) AS n, CAST(sum(ccu) AS BIGINT) AS ccu FROM snap WHERE recorded_date > DATE '2024-01-10'
    UNION ALL SELECT 'missing', count(*), CAST(sum(ccu) AS BIGINT) FROM snap""",
    "c1_mode": ON_ACTIVITY
    + """SELECT 'loaded' AS situation, CASE WHEN (SELECT count(*) FROM fact) = 0 OR (SELECT count(*) FROM games) = 0
      THEN 'initial' ELSE 'incremental' END AS load_mode
    UNION ALL SELECT 'no facts', CASE WHEN (SELECT count(*) FROM fact WHERE ccu < 0) = 0 OR (SELECT count(*) FROM games) = 0
      THEN 'initial' ELSE 'incremental' END
    UNION ALL SELECT 'no games', CASE WHEN (SELECT count(*) FROM fact) = 0 OR (SELECT count(*) FROM games WHERE appid < 0) = 0
      THEN 'initial' ELSE 'incremental' END""",
    "c2_changed_since": _with(RAW)
    + """SELECT appid, name FROM games WHERE updated_on >
      (SELECT max(updated_on) FROM games WHERE updated_on <= DATE '2024-01-15')""",
    "c4_load_dimensions": _with(RAW)
.rstrip()
    + """, names AS (
      SELECT 'dim_publishers' AS dim, 'bridge_game_publishers' AS links, appid, publisher_name AS name, updated_on FROM publisher_pairs
      UNION ALL SELECT 'dim_genres', 'bridge_game_genres', appid, genre_name, updated_on FROM genre_pairs JOIN games USING (appid))
    SELECT 'dim_games' AS table_name, CAST(appid AS VARCHAR) AS key,
      coalesce(name, '-') || '|' || coalesce(CAST(price_final AS VARCHAR), '-') || '|' || coalesce(short_description, '-') AS detail
    FROM games
    UNION ALL SELECT dim, name, CASE WHEN min(updated_on) <= DATE '2024-01-15' THEN '2024-01-15' ELSE '2024-03-01' END
    FROM names GROUP BY dim, name
    UNION ALL SELECT links, CAST(appid AS VARCHAR), name FROM names""",
    "c5_retry_after_failure": ON_SHIPMENTS + f"SELECT appid, date_key, {METRICS} FROM fact",
    "m4_load_overlap": ON_SHIPMENTS
    + """SELECT appid, date_key, ccu,
      CASE WHEN recorded_date <= DATE '1998-12-31' THEN DATE '2024-01-15' ELSE DATE '2024-03-01' END AS created_on
    FROM fact""",
    "p11_stored_rejects": ON_PARSED
    + """SELECT appid, name, reject_reason, run_date, run_id FROM (
      SELECT appid, name, reject_reason, unnest(['day-1', 'day-2', 'day-2-again']) AS run_id FROM enriched WHERE reject_reason IS NOT NULL
      UNION ALL SELECT appid, name, 'no_game', unnest(['day-1', 'day-2']) FROM ingested WHERE NOT first_gate) r
    JOIN (VALUES ('day-1', DATE '2024-05-01'), ('day-2', DATE '2024-05-02'), ('day-2-again', DATE '2024-05-02'))
      AS days(run_id, run_date) USING (run_id)""",
    "p11_stored_arrivals": ON_ARRIVALS
    + """SELECT appid, reject_reason, CASE batch WHEN 1 THEN DATE '2024-01-15' ELSE DATE '2024-03-01' END AS run_date,
      'batch-' || batch AS run_id
    FROM judged WHERE reject_reason IS NOT NULL""",
    "s7_stored_arrivals": ON_ARRIVALS
    + "SELECT appid, recorded_date, ccu, score, userscore FROM judged WHERE reject_reason IS NULL",
    "e2e_weekday": _with(
        "sound AS (SELECT * REPLACE (CASE WHEN p_size = 23 THEN 25 ELSE p_size END AS p_size) FROM part)",
        RAW.replace("FROM part", "FROM sound"),
        PARSED,
    )
    + """, fact AS (
      SELECT appid, name, d AS recorded_date, CAST(dayofweek(d) AS INT) AS day_of_week,
        CASE WHEN ccu > 0 THEN ccu + more ELSE ccu END AS ccu
      FROM ingested, (VALUES (DATE '2024-05-04', 0), (DATE '2024-05-05', 50)) AS days(d, more) WHERE first_gate)
    SELECT name, day_of_week, avg(ccu) AS avg_ccu FROM fact WHERE appid IN (
      SELECT appid FROM fact WHERE recorded_date = DATE '2024-05-05' ORDER BY ccu DESC NULLS FIRST, appid LIMIT 10)
    GROUP BY name, day_of_week ORDER BY name, day_of_week""",
    "k1_second_load": """SELECT l_orderkey, CASE WHEN min(CAST(l_shipdate AS DATE)) <= DATE '1998-12-31' THEN 1 ELSE 2 END AS loaded_by
    FROM lineitem GROUP BY 1""",
    "q1_unique": """SELECT l_partkey, CAST(l_shipdate AS DATE) AS ship_day, count(*) AS n
    FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1""",
    "q2_not_null": _with(RAW)
    + """SELECT * FROM (
      SELECT 'price_initial' AS "column", count(*) FILTER (price_initial IS NULL) AS n FROM raw
      UNION ALL SELECT 'price_currency', count(*) FILTER (price_currency IS NULL) FROM raw
      UNION ALL SELECT 'short_description', count(*) FILTER (short_description IS NULL) FROM raw
      UNION ALL SELECT 'publishers', count(*) FILTER (size = 17) FROM raw
      UNION ALL SELECT 'name', count(*) FILTER (name IS NULL) FROM raw
      UNION ALL SELECT 'appid', count(*) FILTER (appid IS NULL) FROM raw) v WHERE n > 0""",
    "q3_reference": _with(RAW, SHIPMENTS)
    + "SELECT appid, count(*) AS n FROM snap WHERE appid NOT IN (SELECT appid FROM games) GROUP BY 1",
    "q4_length": _with(RAW)
    + """SELECT * FROM (
      SELECT 'name' AS "column", count(*) FILTER (length(name) > 10) AS n, CAST(max(length(name)) AS INT) AS longest FROM raw
      UNION ALL SELECT 'short_description', count(*) FILTER (length(short_description) > 6), CAST(max(length(short_description)) AS INT) FROM raw
      UNION ALL SELECT 'price_currency', count(*) FILTER (length(price_currency) > 10), CAST(max(length(price_currency)) AS INT) FROM raw
    ) v WHERE n > 0""",
    "q4_range": """SELECT * FROM (
      SELECT 'order_parts' AS "column", count(*) FILTER (l_orderkey*10000000 NOT BETWEEN -2147483648 AND 2147483647) AS n FROM lineitem
      UNION ALL SELECT 'l_partkey', count(*) FILTER (l_partkey NOT BETWEEN -2147483648 AND 2147483647) FROM lineitem
      UNION ALL SELECT 'l_linenumber', count(*) FILTER (l_linenumber NOT BETWEEN -2147483648 AND 2147483647) FROM lineitem
    ) v WHERE n > 0""",
    "q6_cascade": _with(RAW, SHIPMENTS)
    + "SELECT appid, recorded_date, ccu FROM snap WHERE appid NOT IN (SELECT appid FROM raw WHERE kind = 'PROMO')",
    "g6_required": ON_PARSED
    + """SELECT appid, CASE WHEN name IS NULL THEN 'name' ELSE 'ccu' END AS missing FROM listed
    WHERE name IS NULL OR ccu IS NULL""",
    "an1_series": ON_ACTIVITY
    + f"""SELECT name, ccu, recorded_date AS full_date FROM fact WHERE appid = 12 AND {RECENT}
    ORDER BY full_date""",
    "an2_top10_weekday": ON_ACTIVITY
    + f"""SELECT name, day_of_week, avg(ccu) AS avg_ccu FROM fact WHERE {RECENT} AND appid IN (
      SELECT appid FROM fact WHERE recorded_date = DATE '2024-01-30' ORDER BY ccu DESC NULLS FIRST, appid LIMIT 10)
    GROUP BY name, day_of_week ORDER BY name, day_of_week""",
    "an3_weekday": ON_ACTIVITY
    + f"SELECT name, day_of_week, avg(ccu) AS avg_ccu FROM fact WHERE {RECENT} GROUP BY name, day_of_week",
    "an4_total_series": ON_SHIPMENTS
    + """SELECT recorded_date AS full_date, count(*) AS games, CAST(sum(ccu) AS BIGINT) AS total_ccu
    FROM fact GROUP BY 1 ORDER BY 1""",
    "an5_compare": ON_SHIPMENTS
    + """SELECT appid, name, count(*) AS days, avg(ccu) AS average, max(ccu) AS highest FROM fact
    GROUP BY appid, name ORDER BY average DESC, appid""",
    "an6_drill": ON_SHIPMENTS
    + """SELECT appid, name, recorded_date AS full_date, ccu, score, userscore FROM fact
    WHERE recorded_date BETWEEN DATE '1997-03-01' AND DATE '1999-08-31'
      AND appid IN (SELECT appid FROM genre_pairs WHERE genre_name IN ('red', 'ring'))
      AND appid IN (SELECT appid FROM publisher_pairs WHERE publisher_name IN ('PROMO', 'LARGE'))""",
    "an7_genre": ON_SHIPMENTS
    + """SELECT genre_name, count(DISTINCT appid) AS games, CAST(sum(ccu) AS BIGINT) AS total_ccu,
      avg(ccu) AS avg_ccu, max(ccu) AS peak_ccu
    FROM fact JOIN genre_pairs USING (appid) GROUP BY 1""",
    "l2_top_games": ON_ACTIVITY
    + """SELECT appid, name, ccu FROM fact WHERE recorded_date = DATE '2024-01-30'
    ORDER BY ccu DESC NULLS FIRST, appid LIMIT 25""",
    "l3_top_active": """SELECT user_id, count(*) AS activity FROM events
    WHERE CAST(ts AS DATE) BETWEEN DATE '2024-01-17' AND DATE '2024-01-30'
    GROUP BY 1 ORDER BY activity DESC, user_id LIMIT 100""",
    "g1_rollup": ON_SHIPMENTS
    + """SELECT grain, period_start, count(*) AS "rows", CAST(sum(ccu) AS BIGINT) AS total_ccu, avg(ccu) AS avg_ccu,
      max(ccu) AS peak_ccu
    FROM (SELECT 'day' AS grain, recorded_date AS period_start, ccu FROM fact
      UNION ALL SELECT 'week', CAST(date_trunc('week', recorded_date) AS DATE), ccu FROM fact
      UNION ALL SELECT 'month', CAST(date_trunc('month', recorded_date) AS DATE), ccu FROM fact) p
    GROUP BY 1, 2""",
    "g3_genre_trend": ON_SHIPMENTS
    + """SELECT genre_name, ym, count(DISTINCT appid) AS games, CAST(sum(ccu) AS BIGINT) AS total_ccu, avg(ccu) AS avg_ccu
    FROM fact JOIN genre_pairs USING (appid) GROUP BY 1, 2""",
    "g3_category_trend": ON_SHIPMENTS
    + """SELECT g.kind AS category, ym, count(DISTINCT f.appid) AS games, CAST(sum(ccu) AS BIGINT) AS total_ccu,
      avg(ccu) AS avg_ccu
    FROM fact f JOIN games g ON f.appid = g.appid GROUP BY 1, 2""",
    "g4_peak_avg": ON_SHIPMENTS
    + """SELECT appid, name, max(ccu) AS peak_ccu, avg(ccu) AS avg_ccu, count(*) AS days FROM fact
    GROUP BY appid, name""",
    "g5_moving_avg": ON_SHIPMENTS
    + """SELECT appid, date_key, ccu,
      avg(ccu) OVER (PARTITION BY appid ORDER BY date_key ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) AS moving_avg,
      ccu - lag(ccu) OVER (PARTITION BY appid ORDER BY date_key) AS change
    FROM fact""",
}

HALVES = (
    ON_ACTIVITY
    + """SELECT * FROM (SELECT appid, name,
      avg(ccu) FILTER (recorded_date >= DATE '2024-01-24') AS recent_avg,
      avg(ccu) FILTER (recorded_date < DATE '2024-01-24') AS earlier_avg,
      avg(ccu) FILTER (recorded_date >= DATE '2024-01-24') - avg(ccu) FILTER (recorded_date < DATE '2024-01-24') AS change
    FROM fact WHERE recorded_date BETWEEN DATE '2024-01-17' AND DATE '2024-01-30' GROUP BY appid, name) h
    WHERE change IS NOT NULL"""
)
ORACLES["g2_risers"] = HALVES + " ORDER BY change DESC, appid"
ORACLES["g2_top_decliners"] = HALVES + " ORDER BY change, appid LIMIT 20"
