r'''DuckDB SQL equivalent of each registered query (same column names).

The derivation rules of :mod:`riverbend.plans.derive` are repeated here from
their definitions; the oracle computes the expected result straight from the
tables, without the Spark-side parsing, routing or state.
'''

_LATEST = """
    SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority
    FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey
                                       ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn
          FROM orders) t
    WHERE rn = 1"""

_TWICE = """(SELECT o_orderkey AS t_id, o_custkey AS t_customer_id, o_totalprice AS t_amount,
                    o_orderdate AS t_time FROM orders
             UNION ALL
             SELECT o_orderkey, o_custkey, o_totalprice, o_orderdate FROM orders)"""

_EPOCH_TEXT = ("CAST(epoch_us(ts) // 1000000 AS VARCHAR) || '.' || "
               "lpad(CAST(epoch_us(ts) % 1000000 AS VARCHAR), 6, '0')")

_DEAD = f"""
    WITH m AS (
      SELECT event_id, event_type, ts, {_EPOCH_TEXT} AS tt,
             CASE WHEN event_id % 10 = 9 THEN 'missing' WHEN event_id % 97 = 13 THEN 'extra'
                  WHEN event_id % 89 = 7 THEN 'notjson' WHEN event_id % 83 = 5 THEN 'empty'
                  WHEN event_id % 79 = 3 THEN 'wrongtype' ELSE 'good' END AS kind
      FROM events)"""

_LATE = """
    WITH e AS (
      SELECT event_id AS id,
             CASE WHEN event_id > 50 AND event_id % 10 = 0 THEN 'delayed' ELSE event_type END AS data,
             CASE WHEN event_id > 50 AND event_id % 10 = 0 THEN ts - INTERVAL 5 HOUR ELSE ts END AS event_time
      FROM events),
    w AS (
      SELECT *, max((epoch_us(event_time) // 1000)) OVER (ORDER BY id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prev
      FROM e)"""

_RUNS = """
    r AS (SELECT event_id, user_id, ts, value, epoch_us(ts) AS us,
                 sum(CASE WHEN value >= 50 THEN 0 ELSE 1 END)
                   OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS run
          FROM events)"""


def _greedy(group: str) -> str:
    # group: partition of the greedy chain (device, or device + hot run)
    on = " AND ".join(f"x.{g} = s.{g}" for g in group.split(", "))
    on_e = " AND ".join(f"e.{g} = c.{g}" for g in group.split(", "))
    on_h = " AND ".join(f"h.{g} = chain.{g}" for g in group.split(", "))
    return f"""
    WITH RECURSIVE {_RUNS.strip()},
    h AS (SELECT *, row_number() OVER (PARTITION BY {group} ORDER BY ts, event_id) AS rk
          FROM r WHERE value >= 50),
    e AS (SELECT s.{group.replace(', ', ', s.')}, s.rk,
                 (SELECT min(x.rk) FROM h x WHERE {on} AND x.rk > s.rk
                                             AND x.us >= s.us + 21600000000) AS end_rk
          FROM h s),
    chain AS (
      SELECT * FROM e WHERE rk = 1 AND end_rk IS NOT NULL
      UNION ALL
      SELECT e.* FROM chain c JOIN e ON {on_e} AND e.rk = c.end_rk + 1 WHERE e.end_rk IS NOT NULL)
    SELECT h.event_id, h.user_id, h.ts, h.value
    FROM chain JOIN h ON {on_h} AND h.rk = chain.end_rk"""


_LAG = "(((epoch_us(ts) // 1000) // 60000 + 1) * 60000 - (epoch_us(ts) // 1000))"

_TXN = """
    SELECT strftime(o_orderdate, '%Y-%m-%d %H:%M:%S.%f') || '000' AS t_time,
           o_orderkey AS t_id, o_custkey AS t_customer_id,
           TRY_CAST(o_totalprice AS DECIMAL(10,2)) AS t_amount,
           strftime(o_orderdate, '%Y_%m_%d') AS t_date
    FROM orders"""

ORACLE = {
    "latest_per_key": _LATEST,
    "latest_per_key_sql": _LATEST,
    "top_n_per_key": """
        SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority,
               CAST(rn AS INTEGER) AS rn
        FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey
                                           ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn
              FROM orders) t
        WHERE rn <= 3""",
    "latest_improvements": """
        SELECT event_id, user_id, ts, event_type, value
        FROM (SELECT *, max(ts) OVER (PARTITION BY user_id ORDER BY (event_id * 7919) % 100003, event_id
                                      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prev
              FROM events) t
        WHERE prev IS NULL OR ts > prev""",
    "keep_first": """
        SELECT t_id, t_customer_id, t_amount, t_time, copy
        FROM (SELECT *, row_number() OVER (PARTITION BY t_id ORDER BY t_time, copy) AS rn
              FROM (SELECT o_orderkey AS t_id, o_custkey AS t_customer_id, o_totalprice AS t_amount,
                           o_orderdate AS t_time, 0 AS copy FROM orders
                    UNION ALL
                    SELECT o_orderkey, o_custkey, o_totalprice,
                           make_timestamp(epoch_us(o_orderdate) + (o_orderkey % 3 - 1) * 1000000), 1
                    FROM orders) s) t
        WHERE rn = 1""",
    "keep_first_sql": """
        SELECT t_id, t_customer_id, TRY_CAST(t_amount AS DECIMAL(15,2)) AS t_amount, t_time
        FROM (SELECT *, row_number() OVER (PARTITION BY t_id ORDER BY t_time, copy) AS rn
              FROM (SELECT o_orderkey AS t_id, o_custkey AS t_customer_id, o_totalprice AS t_amount,
                           o_orderdate AS t_time, 0 AS copy FROM orders
                    UNION ALL
                    SELECT o_orderkey, o_custkey, o_totalprice,
                           make_timestamp(epoch_us(o_orderdate) + (o_orderkey % 3 - 1) * 1000000), 1
                    FROM orders) s) t
        WHERE rn = 1""",
    "distinct_rows": f"SELECT DISTINCT * FROM {_TWICE} t",
    "dedup_join": f"""
        SELECT t.t_id, c.c_name, TRY_CAST(t.t_amount AS DECIMAL(15,2)) AS t_amount
        FROM customer c JOIN (SELECT DISTINCT * FROM {_TWICE} x) t ON c.c_custkey = t.t_customer_id""",
    "decimal_narrow": "SELECT o_orderkey, TRY_CAST(o_totalprice AS DECIMAL(7,2)) AS amount FROM orders",
    "cdc_apply": """
        SELECT o_orderkey AS t_id, o_custkey AS t_customer_id,
               CAST(TRY_CAST(o_totalprice AS DECIMAL(10,2))
                    + CASE WHEN o_orderkey % 5 = 4 THEN 1 ELSE 0 END AS DECIMAL(10,2)) AS t_amount
        FROM orders WHERE o_orderkey % 13 <> 6""",
    "cdc_after_images": """
        SELECT o_orderkey AS t_id, o_custkey AS t_customer_id,
               TRY_CAST(o_totalprice AS DECIMAL(10,2)) AS t_amount FROM orders
        UNION ALL
        SELECT o_orderkey, o_custkey, CAST(TRY_CAST(o_totalprice AS DECIMAL(10,2)) + 1 AS DECIMAL(10,2))
        FROM orders WHERE o_orderkey % 5 = 4""",
    "tumbling_counts": """
        SELECT time_bucket(INTERVAL '1 hour', ts) AS window_start,
               time_bucket(INTERVAL '1 hour', ts) + INTERVAL 1 HOUR AS window_end,
               event_type, count(*) AS cnt
        FROM events GROUP BY 1, 2, 3""",
    "word_count": r"""
        SELECT word, count(*) AS count
        FROM (SELECT unnest(regexp_split_to_array(lower(text), '\W+')) AS word FROM documents) t
        WHERE word <> '' GROUP BY word""",
    "session_activity": """
        WITH g AS (
          SELECT user_id, ts,
                 CASE WHEN lag(ts) OVER w IS NULL
                        OR epoch_us(ts) - epoch_us(lag(ts) OVER w) > 21600000000 THEN 1 ELSE 0 END AS new
          FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)),
        s AS (SELECT user_id, ts, sum(new) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS sid
              FROM g)
        SELECT user_id, min(ts) AS activity_start, max(ts) AS activity_end, count(*) AS num_interactions
        FROM s GROUP BY user_id, sid""",
    "split_by_priority": """
        SELECT o_orderkey, o_orderpriority,
               CASE o_orderpriority WHEN '1-URGENT' THEN 'critical' WHEN '2-HIGH' THEN 'major'
                    ELSE 'minor' END AS output
        FROM orders""",
    "late_main": _LATE + """
        SELECT id, data, event_time FROM w WHERE NOT coalesce((epoch_us(event_time) // 1000) < prev - 1, false)""",
    "late_rows": _LATE + """
        SELECT id, data, event_time FROM w WHERE coalesce((epoch_us(event_time) // 1000) < prev - 1, false)""",
    "dead_letter_good": _DEAD + """
        SELECT event_id AS id, event_type AS data, ts AS "timestamp" FROM m WHERE kind = 'good'""",
    "dead_letter_bad": _DEAD + """
        SELECT CASE kind
                 WHEN 'missing' THEN '{"data": "' || event_type || '", "timestamp": ' || tt || '}'
                 WHEN 'extra' THEN '{"id": ' || event_id || ', "data": "' || event_type || '", "timestamp": '
                                   || tt || ', "extra": 1}'
                 WHEN 'notjson' THEN 'not json: ' || event_id
                 WHEN 'empty' THEN ''
                 WHEN 'wrongtype' THEN '{"id": "x' || event_id || '", "data": "' || event_type
                                       || '", "timestamp": ' || tt || '}'
               END AS value
        FROM m WHERE kind <> 'good'""",
    "kafka_enriched": """
        SELECT event_id AS id, event_type AS data, ts AS "timestamp",
               'events' AS metadataTopic, CAST(user_id % 4 AS BIGINT) AS metadataPartition,
               event_id AS metadataOffset, (epoch_us(ts) // 1000) AS metadataTimestamp,
               'CreateTime' AS metadataTimestampType,
               CASE WHEN event_id % 11 <> 0
                    THEN 'rb=' || substr(md5(CAST(event_id AS VARCHAR)), 1, 11) END AS tracestate,
               CASE WHEN event_id % 7 = 0
                    THEN '00-' || md5(CAST(event_id AS VARCHAR) || 'x') || '-'
                         || substr(md5(CAST(event_id AS VARCHAR)), 17, 16) || '-01'
                    ELSE '00-' || md5(CAST(event_id AS VARCHAR)) || '-'
                         || substr(md5(CAST(event_id AS VARCHAR) || 'p'), 1, 16) || '-01' END AS traceparent
        FROM events""",
    "protobuf_decode": """
        SELECT strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S.%g') || 'Z' AS t_time,
               o_orderkey AS t_id, o_custkey AS t_customer_id,
               CASE WHEN o_orderkey % 17 <> 0 THEN o_totalprice END AS t_amount
        FROM orders""",
    "hot_v1": _greedy("user_id"),
    "hot_v2": _greedy("user_id, run"),
    "hot_v3": f"""
        WITH {_RUNS.strip()},
        h AS (SELECT * FROM r WHERE value >= 50 AND run >= 1),
        f AS (SELECT user_id, run, min(us) AS first_us FROM h GROUP BY user_id, run),
        c AS (SELECT h.*, row_number() OVER (PARTITION BY h.user_id, h.run ORDER BY h.ts, h.event_id) AS rn
              FROM h JOIN f ON h.user_id = f.user_id AND h.run = f.run
              WHERE h.us >= f.first_us + 21600000000)
        SELECT event_id, user_id, ts, value FROM c WHERE rn = 1""",
    "event_lag": f"SELECT event_id, user_id, ts, {_LAG} AS lag_ms FROM events",
    "lag_stats": f"""
        WITH l AS (SELECT CAST({_LAG} AS BIGINT) AS lag_ms FROM events ORDER BY event_id DESC LIMIT 10000)
        SELECT count(lag_ms) AS n, min(lag_ms) AS min_ms, max(lag_ms) AS max_ms,
               round(avg(lag_ms), 6) AS mean_ms, round(stddev_samp(lag_ms), 6) AS stddev_ms,
               round(quantile_cont(CAST(lag_ms AS DOUBLE), 0.5), 6) AS p50_ms,
               round(quantile_cont(CAST(lag_ms AS DOUBLE), 0.75), 6) AS p75_ms,
               round(quantile_cont(CAST(lag_ms AS DOUBLE), 0.95), 6) AS p95_ms,
               round(quantile_cont(CAST(lag_ms AS DOUBLE), 0.98), 6) AS p98_ms,
               round(quantile_cont(CAST(lag_ms AS DOUBLE), 0.99), 6) AS p99_ms,
               round(quantile_cont(CAST(lag_ms AS DOUBLE), 0.999), 6) AS p999_ms
        FROM l""",
    "parquet_roundtrip": _TXN,
    "compacted_roundtrip": f"SELECT *, true AS fewer_files FROM ({_TXN}) t",
}

_STATE = """
    SELECT user_id, max(event_id) AS event_id, arg_max(ts, event_id) AS ts,
           arg_max(event_type, event_id) AS content1, CAST(1 AS INTEGER) AS n_sub_events
    FROM events WHERE user_id % 5 <> 0 OR event_id <= (SELECT max(event_id) // 2 FROM events) GROUP BY user_id"""

ORACLE.update({
    "kafka_json_records": 'SELECT event_id AS id, event_type AS data, ts AS "timestamp" FROM events',
    "json_lines": """
        SELECT o_orderdate AS t_time, o_orderkey AS t_id, o_custkey AS t_customer_id,
               CAST(o_totalprice AS DECIMAL(10,0)) AS t_amount
        FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey
                                           ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn
              FROM orders) t
        WHERE rn = 1""",
    "csv_stream": """
        SELECT event_id AS id, event_type AS "character", CAST(user_id AS VARCHAR) AS location
        FROM events""",
    "exactly_once_copy": "SELECT * FROM events",
    "state_latest": _STATE,
    "state_migrated": _STATE,
})

ORACLE.update({
    "cdc_bad": """
        SELECT 'oops ' || o_orderkey AS value FROM orders WHERE o_orderkey % 29 = 3
        UNION ALL SELECT '{"op": "c", "after": {"t_id": "x' || o_orderkey || '"}}' FROM orders WHERE o_orderkey % 31 = 4
        UNION ALL SELECT '{"op": "z", "after": {"t_id": ' || o_orderkey || '}}' FROM orders WHERE o_orderkey % 37 = 5""",
    "windowed_word_count": r"""
        WITH w AS (SELECT time_bucket(INTERVAL '1 hour', make_timestamp((conv_id * 60 + turn) * 1000000)) AS window_start,
                          unnest(regexp_split_to_array(lower(text), '\W+')) AS word FROM conversations)
        SELECT window_start, window_start + INTERVAL 1 HOUR AS window_end, word, count(*) AS count
        FROM w WHERE word <> '' GROUP BY ALL""",
    "json_sql": """
        SELECT o_custkey AS payer, count(*) AS n, sum(CAST(o_totalprice AS DECIMAL(12,2))) AS paid FROM orders GROUP BY o_custkey""",
    "kafka_sql": "SELECT event_type AS data, count(DISTINCT event_id) AS n, max(ts) AS newest FROM events GROUP BY event_type",
    "insert_into": ORACLE["keep_first_sql"],
    "late_stream": """
        WITH e AS (SELECT event_id AS id,
                          CASE WHEN event_id > 50 AND event_id % 10 = 0 THEN 'delayed' ELSE event_type END AS data,
                          CASE WHEN event_id > 50 AND event_id % 10 = 0 THEN ts - INTERVAL 5 HOUR ELSE ts END AS event_time,
                          event_id AS "offset", CAST(event_id % 4 AS INTEGER) AS part FROM events)
        SELECT *, coalesce(epoch_us(event_time) // 1000 < max(epoch_us(event_time) // 1000) OVER (
            PARTITION BY part ORDER BY id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) - 1, false) AS late FROM e""",
    "improvements_stream": ORACLE["latest_improvements"],
    "dedup_join_stream": ORACLE["dedup_join"],
    "alerts_and_raw": f"""
        SELECT event_id, user_id, ts, value, 'raw' AS kind FROM events
        UNION ALL SELECT event_id, user_id, ts, value, 'alert' AS kind FROM ({ORACLE["hot_v3"]}) a""",
    "hot_v1_stream": ORACLE["hot_v1"],
    "hot_v2_stream": ORACLE["hot_v2"],
    "hot_v3_stream": ORACLE["hot_v3"],
})

_CHANGES = """
    WITH p AS (SELECT *, max(struct_pack(d := o_orderdate, k := o_orderkey)) OVER (
                   PARTITION BY o_custkey ORDER BY o_orderkey ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prev FROM orders),
    n AS (SELECT * FROM p WHERE prev IS NULL OR o_orderdate >= prev.d)
    SELECT o_orderkey AS arrival, CAST(1 AS INTEGER) AS step, CASE WHEN prev IS NULL THEN '+I' ELSE '+U' END AS kind,
           o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority FROM n
    UNION ALL
    SELECT n.o_orderkey, 0, '-U', b.o_orderkey, b.o_custkey, b.o_orderstatus, b.o_totalprice, b.o_orderdate, b.o_orderpriority
    FROM n JOIN orders b ON b.o_orderkey = n.prev.k"""

_FAULTS = """
    WITH o AS (SELECT o_orderkey AS k, o_custkey AS c, CAST(TRY_CAST(o_totalprice AS DECIMAL(10,2)) AS DECIMAL(12,2)) AS a FROM orders),
    e AS (SELECT k, k * 5 AS lsn, 'c' AS op, NULL AS b, a FROM o WHERE k % 17 <> 8
          UNION ALL SELECT k, k * 5 + 1, 'u', a, a + 1 FROM o WHERE k % 7 <> 3
          UNION ALL SELECT k, k * 5 + 2, 'u', a, a + 1 FROM o WHERE k % 11 = 5
          UNION ALL SELECT k, k * 5 + 3, 'u', a + 1, a + 2 FROM o WHERE k % 3 = 1
          UNION ALL SELECT k, k * 5 + 4, 'd', CASE WHEN k % 3 = 1 THEN a + 2 ELSE a + 1 END, NULL FROM o WHERE k % 4 = 1),
    w AS (SELECT *, lag(a) OVER x AS had, lag(op) OVER x AS op0, lag(b) OVER x AS b0 FROM e WINDOW x AS (PARTITION BY k ORDER BY lsn))
    SELECT k AS t_id, lsn, op,
           CASE WHEN op IS NOT DISTINCT FROM op0 AND b IS NOT DISTINCT FROM b0 AND a IS NOT DISTINCT FROM had THEN 'repeat'
                WHEN had IS NULL THEN 'no_history' ELSE 'gap' END AS fault,
           CAST(b AS DECIMAL(10,2)) AS before_amount, CAST(had AS DECIMAL(10,2)) AS expected_amount
    FROM w WHERE b IS DISTINCT FROM had"""

ORACLE.update({
    "changelog_stream": _CHANGES,
    "changelog_folded": _LATEST,
    "changelog_totals": f"SELECT o_orderpriority, count(*) AS n, sum(o_totalprice) AS total FROM ({_LATEST}) t GROUP BY o_orderpriority",
    "cdc_changelog": """
        WITH o AS (SELECT o_orderkey AS k, o_custkey AS c, TRY_CAST(o_totalprice AS DECIMAL(10,2)) AS a FROM orders)
        SELECT k * 3 AS arrival, '+I' AS kind, k AS t_id, c AS t_customer_id, a AS t_amount FROM o
        UNION ALL SELECT k * 3 + 1, '-U', k, c, a FROM o WHERE k % 5 = 4
        UNION ALL SELECT k * 3 + 1, '+U', k, c, CAST(a + 1 AS DECIMAL(10,2)) FROM o WHERE k % 5 = 4
        UNION ALL SELECT k * 3 + 2, '-D', k, c, CAST(a + CASE WHEN k % 5 = 4 THEN 1 ELSE 0 END AS DECIMAL(10,2)) FROM o WHERE k % 13 = 6""",
    "cdc_image_breaks": _FAULTS,
    "compacted_stream": f"SELECT *, substr(t_date, 1, 7) AS t_month, true AS one_small_file FROM ({_TXN}) t",
})

ORACLE.update({
    "state_initial": f"SELECT user_id, event_id, ts, content1 FROM ({_STATE}) t",
    "session_stream": ORACLE["session_activity"],
})

_PARTS = ", ".join(f"max(ms) FILTER (part = {p}) OVER w AS m{p}, max(id) FILTER (part = {p}) OVER w AS c{p}" for p in range(4))
_ACTIVE = [f"(id - coalesce(c{p}, first)) * 1000 <= 60000" for p in range(4)]

ORACLE.update({
    "late_by_partition": f"""
        WITH e AS (SELECT event_id AS id,
                          CASE WHEN event_id > 50 AND event_id % 10 = 0 THEN 'delayed' ELSE event_type END AS data,
                          CASE WHEN event_id > 50 AND event_id % 10 = 0 THEN ts - INTERVAL 5 HOUR ELSE ts END AS event_time,
                          event_id AS "offset",
                          CAST(CASE WHEN event_id % 2 = 0 THEN 0 WHEN event_id % 3 = 0 THEN 1
                                    WHEN event_id % 5 = 1 AND event_id < (SELECT max(event_id) // 2 FROM events) THEN 3 ELSE 2 END AS INTEGER) AS part
                   FROM events),
        x AS (SELECT *, epoch_us(event_time) // 1000 AS ms FROM e),
        s AS (SELECT *, min(id) OVER w AS first, {_PARTS} FROM x WINDOW w AS (ORDER BY id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))
        SELECT id, data, event_time, "offset", part,
               coalesce(NOT ({" OR ".join(f"({a} AND m{p} IS NULL)" for p, a in enumerate(_ACTIVE))})
                        AND ms < least({", ".join(f"CASE WHEN {a} THEN m{p} END" for p, a in enumerate(_ACTIVE))}) - 1, false) AS late FROM s""",
    "ordered_events": """
        SELECT event_id, user_id, ts, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS position FROM events""",
    "keep_first_stream": """
        SELECT o_orderkey AS t_id, o_custkey AS t_customer_id, o_orderdate AS t_time, CAST(0 AS INTEGER) AS copy FROM orders""",
})
