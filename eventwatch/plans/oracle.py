"""DuckDB SQL oracles for the registered queries.

Written independently of the Spark plans: plain window functions (lag / running max over the whole
key), a recursive CTE for the hold bags, string aggregation for banned lists.  The shared CTEs rebuild
the message adapter and the parser from the same fixed projection.
"""

from __future__ import annotations

# Shared CTE chain: fields → messages → parsed → valid.
BASE = r"""
ev0 AS (
  SELECT event_id, CAST(event_id AS VARCHAR) AS message_id,
         date_trunc('milliseconds', ts) AS publish_ts,
         CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
         event_type, value, user_id AS uid
  FROM events
),
fields AS (
  SELECT event_id, message_id, publish_ts,
         publish_ts - to_seconds(event_id % 5) AS request_ts,
         '192.6.6.' || CAST(uid % 10 + 1 AS VARCHAR) AS src_ip,
         '10.2.1.' || CAST(k AS VARCHAR) AS dst_ip,
         CASE k % 3 WHEN 0 THEN 80 WHEN 1 THEN 443 ELSE 8080 END AS dst_port,
         CASE event_type WHEN 'error' THEN 'virus1' WHEN 'signup' THEN 'another-virus' WHEN 'click' THEN NULL
              ELSE 'process' || CAST(k % 3 + 1 AS VARCHAR) END AS process_name,
         CASE WHEN event_id % 11 = 0 THEN NULL ELSE 'user' || CAST(uid AS VARCHAR) END AS user_id,
         300 + CAST(FLOOR(value * 10) AS INTEGER) AS bytes_sent,
         200 + CAST(FLOOR(value * 20) AS INTEGER) AS bytes_received,
         event_type,
         CASE WHEN event_id % 97 = 0 THEN 'junk' WHEN event_id % 89 = 0 THEN 'no_dst'
              WHEN event_id % 83 = 0 THEN 'no_sent' WHEN event_id % 79 = 0 THEN 'bad_port'
              WHEN event_id % 73 = 0 THEN 'type_a' END AS fault
  FROM ev0
),
msgs AS (
  SELECT event_id, message_id, publish_ts,
    CASE WHEN fault = 'junk' THEN 'junk' ELSE
      '{'
      || CASE WHEN fault = 'no_sent' THEN '' ELSE '"bytes_sent": '
           || CASE WHEN event_id % 13 = 0 THEN CAST(bytes_sent AS VARCHAR) || '.5' ELSE CAST(bytes_sent AS VARCHAR) END
           || ', ' END
      || CASE WHEN fault = 'no_dst' THEN '' ELSE '"destination_ip": "' || dst_ip || '", ' END
      || '"destination_port": ' || CASE WHEN fault = 'bad_port' THEN '"abc"' ELSE CAST(dst_port AS VARCHAR) END || ', '
      || CASE WHEN process_name IS NULL THEN '' ELSE '"process": "' || process_name || '", ' END
      || '"request_timestamp": ' || CAST(epoch_ms(request_ts) AS VARCHAR) || ', '
      || '"bytes_received": ' || CASE WHEN event_id % 7 = 0 THEN '"' || CAST(bytes_received AS VARCHAR) || '"'
                                      ELSE CAST(bytes_received AS VARCHAR) END || ', '
      || '"source_ip": "' || src_ip || '"'
      || CASE WHEN user_id IS NULL THEN '' ELSE ', "user": "' || user_id || '"' END
      || '}' END AS payload_text,
    CASE WHEN fault = 'type_a' THEN 'type A' WHEN event_id % 5 = 1 THEN 'proxy' END AS payload_type
  FROM fields
),
typed AS (
  SELECT m.*, coalesce(payload_type, 'Other') AS ptype,
    json_valid(payload_text) AS ok_json,
    CASE WHEN json_valid(payload_text) THEN json_type(payload_text) END AS top_type,
    CASE WHEN json_valid(payload_text) THEN json_type(payload_text, '$.process') END AS t_process,
    CASE WHEN json_valid(payload_text) THEN json_type(payload_text, '$.destination_ip') END AS t_dst,
    CASE WHEN json_valid(payload_text) THEN json_type(payload_text, '$.source_ip') END AS t_src,
    CASE WHEN json_valid(payload_text) THEN json_type(payload_text, '$.bytes_sent') END AS t_sent,
    CASE WHEN json_valid(payload_text) THEN json_type(payload_text, '$.bytes_received') END AS t_recv,
    CASE WHEN json_valid(payload_text) THEN json_type(payload_text, '$.destination_port') END AS t_port,
    CASE WHEN json_valid(payload_text) THEN json_type(payload_text, '$.user') END AS t_user,
    CASE WHEN json_valid(payload_text) THEN json_type(payload_text, '$.request_timestamp') END AS t_ts,
    CASE WHEN json_valid(payload_text) THEN json_extract_string(payload_text, '$.process') END AS s_process,
    CASE WHEN json_valid(payload_text) THEN json_extract_string(payload_text, '$.destination_ip') END AS s_dst,
    CASE WHEN json_valid(payload_text) THEN json_extract_string(payload_text, '$.source_ip') END AS s_src,
    CASE WHEN json_valid(payload_text) THEN json_extract_string(payload_text, '$.bytes_sent') END AS s_sent,
    CASE WHEN json_valid(payload_text) THEN json_extract_string(payload_text, '$.bytes_received') END AS s_recv,
    CASE WHEN json_valid(payload_text) THEN json_extract_string(payload_text, '$.destination_port') END AS s_port,
    CASE WHEN json_valid(payload_text) THEN json_extract_string(payload_text, '$.user') END AS s_user,
    CASE WHEN json_valid(payload_text) THEN json_extract_string(payload_text, '$.request_timestamp') END AS s_ts
  FROM msgs m
),
ints AS (
  SELECT t.*,
    CASE WHEN t_sent = 'VARCHAR' THEN CASE WHEN regexp_full_match(s_sent, '[+-]?[0-9]+') THEN TRY_CAST(s_sent AS INTEGER) END
         WHEN t_sent IN ('UBIGINT', 'BIGINT', 'DOUBLE') THEN
           CAST(((CAST(trunc(CAST(s_sent AS DECIMAL(38,6))) AS HUGEINT) + 2147483648) % 4294967296 + 4294967296)
                % 4294967296 - 2147483648 AS INTEGER) END AS v_sent,
    CASE WHEN t_recv = 'VARCHAR' THEN CASE WHEN regexp_full_match(s_recv, '[+-]?[0-9]+') THEN TRY_CAST(s_recv AS INTEGER) END
         WHEN t_recv IN ('UBIGINT', 'BIGINT', 'DOUBLE') THEN
           CAST(((CAST(trunc(CAST(s_recv AS DECIMAL(38,6))) AS HUGEINT) + 2147483648) % 4294967296 + 4294967296)
                % 4294967296 - 2147483648 AS INTEGER) END AS v_recv,
    CASE WHEN t_port = 'VARCHAR' THEN CASE WHEN regexp_full_match(s_port, '[+-]?[0-9]+') THEN TRY_CAST(s_port AS INTEGER) END
         WHEN t_port IN ('UBIGINT', 'BIGINT', 'DOUBLE') THEN
           CAST(((CAST(trunc(CAST(s_port AS DECIMAL(38,6))) AS HUGEINT) + 2147483648) % 4294967296 + 4294967296)
                % 4294967296 - 2147483648 AS INTEGER) END AS v_port
  FROM typed t
),
parsed AS (
  SELECT i.*,
    CASE
      WHEN NOT ok_json THEN 'Failed to parse: malformed JSON'
      WHEN top_type <> 'OBJECT' THEN 'Invalid payload: not an object'
      WHEN ptype = 'type A' THEN 'Invalid payload: type A parser not yet implemented'
      ELSE 'Invalid payload: ' || coalesce(
        CASE WHEN t_process IS NOT NULL AND t_process <> 'NULL' AND t_process <> 'VARCHAR' THEN 'process is not a string' END,
        CASE WHEN t_dst IS NULL OR t_dst = 'NULL' THEN 'Missing required field ''destination_ip'''
             WHEN t_dst <> 'VARCHAR' THEN 'destination_ip is not a string' END,
        CASE WHEN t_src IS NULL OR t_src = 'NULL' THEN 'Missing required field ''source_ip'''
             WHEN t_src <> 'VARCHAR' THEN 'source_ip is not a string' END,
        CASE WHEN t_sent IS NULL OR t_sent = 'NULL' THEN 'Null bytesSent'
             WHEN t_sent = 'VARCHAR' AND v_sent IS NULL THEN 'For input string: "' || s_sent || '"'
             WHEN t_sent NOT IN ('VARCHAR', 'UBIGINT', 'BIGINT', 'DOUBLE') THEN 'Unable to convert ' || t_sent || ' to Integer' END,
        CASE WHEN t_recv IS NULL OR t_recv = 'NULL' THEN 'Null bytesReceived'
             WHEN t_recv = 'VARCHAR' AND v_recv IS NULL THEN 'For input string: "' || s_recv || '"'
             WHEN t_recv NOT IN ('VARCHAR', 'UBIGINT', 'BIGINT', 'DOUBLE') THEN 'Unable to convert ' || t_recv || ' to Integer' END,
        CASE WHEN t_port IS NULL OR t_port = 'NULL' THEN 'Null destinationPort'
             WHEN t_port = 'VARCHAR' AND v_port IS NULL THEN 'For input string: "' || s_port || '"'
             WHEN t_port NOT IN ('VARCHAR', 'UBIGINT', 'BIGINT', 'DOUBLE') THEN 'Unable to convert ' || t_port || ' to Integer' END,
        CASE WHEN t_user IS NOT NULL AND t_user <> 'NULL' AND t_user <> 'VARCHAR' THEN 'user is not a string' END,
        CASE WHEN t_ts IS NULL OR t_ts = 'NULL' THEN 'null'
             WHEN t_ts NOT IN ('UBIGINT', 'BIGINT', 'DOUBLE') THEN 'request_timestamp is not a number' END)
    END AS failure_reason
  FROM ints i
),
valid AS (
  SELECT epoch_ms(CAST(trunc(CAST(s_ts AS DECIMAL(38,6))) AS BIGINT)) AS request_ts,
         s_src AS src_ip, s_dst AS dst_ip, v_port AS dst_port,
         CASE WHEN t_process = 'VARCHAR' THEN s_process END AS process_name,
         CASE WHEN t_user = 'VARCHAR' THEN s_user END AS user_id,
         v_sent AS bytes_sent, v_recv AS bytes_received, publish_ts, message_id, event_id
  FROM parsed WHERE failure_reason IS NULL
)"""

# Fixed replay parameters, in milliseconds / SQL intervals (same values as eventwatch.config).
GAP_MS = 30 * 60 * 1000
HOLD_MS = 6 * 3600 * 1000
RETENTION = "INTERVAL 7 DAY"

NEW_HOST = r"""
uev AS (SELECT * FROM valid WHERE user_id IS NOT NULL),
hist AS (
  SELECT u.*,
    max(request_ts) OVER (PARTITION BY user_id, dst_ip ORDER BY publish_ts, message_id
                          ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prev_max,
    lag(publish_ts) OVER (PARTITION BY user_id, dst_ip ORDER BY publish_ts, message_id) AS prev_publish
  FROM uev u
),
flags AS (
  SELECT h.*,
    prev_max IS NULL AS new_plain,
    (prev_max IS NULL OR (prev_publish < date_trunc('day', publish_ts)
                          AND prev_max <= date_trunc('day', publish_ts) - {retention})) AS new_expiry
  FROM hist h
)""".replace("{retention}", RETENTION)

FINDINGS = NEW_HOST + r""",
findings AS (
  SELECT request_ts, user_id, src_ip AS source_ip, 'warning' AS level, 'new-destination-host' AS rule_id,
         'Newly accessed host: ' || dst_ip AS description, message_id, publish_ts
  FROM flags WHERE new_expiry
  UNION ALL
  SELECT request_ts, user_id, src_ip, 'severe', 'process-name-rule', 'Suspicious process: ' || process_name,
         message_id, publish_ts
  FROM flags WHERE process_name LIKE '%virus%'
)"""

CRITICAL_FINDINGS = FINDINGS + r""",
cfind AS (
  SELECT * FROM findings
  UNION ALL
  SELECT request_ts, user_id, src_ip, 'critical', 'critical-process-rule', 'Suspicious process: ' || process_name,
         message_id, publish_ts
  FROM flags WHERE process_name LIKE '%another%'
)"""


def hold_sql(src: str) -> str:
    """Greedy hold bags per user by a recursive CTE over the user's findings in order."""
    return f""",
heldin AS (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY publish_ts, message_id, rule_id) AS rn,
         epoch_ms(publish_ts) AS t
  FROM {src} WHERE level <> 'critical'
),
chain(user_id, rn, open_t) AS (
  SELECT user_id, rn, t FROM heldin WHERE rn = 1
  UNION ALL
  SELECT h.user_id, h.rn, CASE WHEN h.t >= c.open_t + {HOLD_MS} THEN h.t ELSE c.open_t END
  FROM chain c JOIN heldin h ON h.user_id = c.user_id AND h.rn = c.rn + 1
),
held AS (
  SELECT h.request_ts, h.user_id, h.source_ip, h.level, h.rule_id, h.description, h.message_id,
         epoch_ms(c.open_t + {HOLD_MS}) AS emit_ts
  FROM heldin h JOIN chain c ON h.user_id = c.user_id AND h.rn = c.rn
  UNION ALL
  SELECT request_ts, user_id, source_ip, level, rule_id, description, message_id, publish_ts
  FROM {src} WHERE level = 'critical'
)"""


SESSIONS = f""",
sev AS (
  SELECT v.*, lag(publish_ts) OVER (PARTITION BY src_ip ORDER BY publish_ts, message_id) AS prev_t FROM valid v
),
sstart AS (
  SELECT s.*, CASE WHEN prev_t IS NULL OR epoch_ms(publish_ts) - epoch_ms(prev_t) >= {GAP_MS} THEN 1 ELSE 0 END AS is_start
  FROM sev s
),
sid AS (
  SELECT s.*, sum(is_start) OVER (PARTITION BY src_ip ORDER BY publish_ts, message_id
                                  ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS sess
  FROM sstart s
),
sess AS (
  SELECT src_ip, sess, min(publish_ts) AS session_start,
         epoch_ms(epoch_ms(max(publish_ts)) + {GAP_MS}) AS session_end,
         count(*) AS event_count,
         count(*) FILTER (WHERE process_name IN ('virus1')) AS banned_count,
         string_agg(process_name, ', ' ORDER BY publish_ts, message_id) FILTER (WHERE process_name IN ('virus1'))
           AS banned_list
  FROM sid GROUP BY src_ip, sess
),
sfind AS (
  SELECT session_end - INTERVAL 1 MILLISECOND AS request_ts, src_ip AS source_ip, 'severe' AS level,
         'banned-process-detector' AS rule_id, 'Found banned processes: ' || banned_list AS description
  FROM sess WHERE banned_count > 0
)"""


def _w(ctes: str, body: str) -> str:
    head = "WITH RECURSIVE " if "chain(" in ctes else "WITH "
    return head + BASE.strip() + ctes + "\n" + body


ISO = "strftime(request_ts, '%Y-%m-%dT%H:%M:%S.%g') || 'Z'"

ORACLES: dict[str, str] = {
    "src_messages": _w("", "SELECT message_id, publish_ts, payload_text, payload_type FROM msgs"),
    "process_dim": _w(""",
pinfo AS (
  SELECT process_name, event_type AS category, max(event_id) AS loaded_seq
  FROM fields WHERE process_name IS NOT NULL GROUP BY process_name, event_type
)""", "SELECT process_name, arg_max(category, loaded_seq) AS category FROM pinfo GROUP BY process_name"),
    "parse_reasons": _w("", "SELECT message_id, failure_reason FROM parsed"),
    "payload_dispatch": _w("", """SELECT message_id, coalesce(payload_type, 'Other') AS payload_type,
  CASE WHEN coalesce(payload_type, 'Other') = 'type A' THEN 'type A' ELSE 'proxy-request' END AS converter FROM msgs"""),
    "parse_edges": _w("", """SELECT message_id, CASE WHEN bad THEN 'Failed to parse: malformed JSON' ELSE failure_reason END AS failure_reason,
  CASE WHEN NOT bad AND failure_reason IS NULL THEN CASE WHEN event_id % 41 = 0 THEN 0 ELSE v_sent END END AS bytes_sent,
  CASE WHEN NOT bad AND failure_reason IS NULL THEN
    CASE WHEN event_id % 41 <> 0 AND event_id % 47 = 0 THEN  -- minus the number, low 32 bits, two's complement
      CAST((4294967296 + 2147483648 - list_reduce(list_prepend(CAST(0 AS HUGEINT), list_transform(string_split(long_digits, ''), lambda d: CAST(d AS HUGEINT))),
        lambda a, d: (a * 10 + d) % 4294967296)) % 4294967296 - 2147483648 AS INTEGER)
    ELSE v_recv END END AS bytes_received,
  CASE WHEN NOT bad AND failure_reason IS NULL THEN CAST(s_ts AS BIGINT)
    * CASE WHEN event_id % 43 = 0 AND event_id % 41 <> 0 AND event_id % 47 <> 0 THEN 1000 ELSE 1 END END AS request_ms
  FROM (SELECT *, event_id % 31 = 0 OR event_id % 37 = 0 AS bad,
    '7' || repeat(lpad(CAST(event_id AS VARCHAR), 19, '3'), 2) || repeat('9', CAST(event_id % 22 AS INTEGER)) AS long_digits FROM parsed)"""),
    "rejected_report": _w("", """SELECT time_bucket(INTERVAL 2 MINUTE, publish_ts) AS window_start,
  time_bucket(INTERVAL 2 MINUTE, publish_ts) + INTERVAL 2 MINUTE AS window_end, count(*) AS failed_rows
  FROM valid WHERE event_id % 41 = 0 GROUP BY 1, 2"""),
    "new_host_repeats": _w(""",
rep AS (
  SELECT user_id, dst_ip, publish_ts, request_ts, CASE WHEN event_id % 60 <> 0 THEN message_id END AS message_id,
         unnest(range(CASE WHEN event_id % 50 = 0 THEN 2 ELSE 1 END)) AS copy
  FROM valid WHERE user_id IS NOT NULL
),
seen AS (
  SELECT *, max(request_ts) OVER w AS prev_max, lag(publish_ts) OVER o AS prev_publish FROM rep
  WINDOW w AS (PARTITION BY user_id, dst_ip ORDER BY publish_ts, message_id NULLS FIRST, copy ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
         o AS (PARTITION BY user_id, dst_ip ORDER BY publish_ts, message_id NULLS FIRST, copy)
)""", """SELECT message_id, publish_ts, user_id, dst_ip, prev_max IS NULL OR (prev_publish < date_trunc('day', publish_ts)
  AND prev_max <= date_trunc('day', publish_ts) - {retention}) AS newly_accessed_host FROM seen""".replace("{retention}", RETENTION)),
    "canonical_events": _w("", """SELECT request_ts, src_ip, dst_ip, dst_port, process_name, user_id, bytes_sent,
  bytes_received, publish_ts, message_id FROM valid"""),
    "lenient_int": _w("", "SELECT message_id, bytes_sent, bytes_received, dst_port FROM valid"),
    "valid_events": _w("", """SELECT CAST(publish_ts AS DATE) AS publish_date,
  count(*) FILTER (WHERE failure_reason IS NULL) AS n_valid,
  count(*) FILTER (WHERE failure_reason IS NOT NULL) AS n_invalid FROM parsed GROUP BY 1"""),
    "dead_letters": _w("", """SELECT failure_reason, message_id, publish_ts, payload_text, payload_type
  FROM parsed WHERE failure_reason IS NOT NULL"""),
    "dead_letter_rows": _w("", """SELECT publish_ts AS published_ts, message_id, payload_text AS payload_string,
  failure_reason, CASE WHEN payload_type IS NULL THEN 0 ELSE 1 END AS attribute_count,
  CAST(publish_ts AS DATE) AS published_date FROM parsed WHERE failure_reason IS NOT NULL"""),
    "user_events": _w("", "SELECT message_id, user_id, dst_ip, request_ts FROM valid WHERE user_id IS NOT NULL"),
    "union_sources": _w("", """SELECT message_id, CASE WHEN event_id % 2 = 0 THEN 'first' ELSE 'second' END AS source,
  user_id, src_ip, dst_ip, publish_ts FROM valid"""),
    "new_host_flags": _w("," + NEW_HOST, "SELECT message_id, user_id, dst_ip, new_plain AS newly_accessed_host FROM flags"),
    "new_host_expiry": _w("," + NEW_HOST, "SELECT message_id, user_id, dst_ip, new_expiry AS newly_accessed_host FROM flags"),
    "host_last_access": _w("", """SELECT user_id, dst_ip, max(request_ts) AS last_access_ts, count(*) AS access_count
  FROM valid WHERE user_id IS NOT NULL GROUP BY user_id, dst_ip"""),
    "rule_process_name": _w("", """SELECT request_ts, user_id, src_ip AS source_ip, 'severe' AS level,
  'process-name-rule' AS rule_id, 'Suspicious process: ' || process_name AS description, message_id
  FROM valid WHERE user_id IS NOT NULL AND process_name LIKE '%virus%'"""),
    "rule_new_host": _w("," + NEW_HOST, """SELECT request_ts, user_id, src_ip AS source_ip, 'warning' AS level,
  'new-destination-host' AS rule_id, 'Newly accessed host: ' || dst_ip AS description, message_id
  FROM flags WHERE new_expiry"""),
    "user_findings": _w("," + FINDINGS, """SELECT request_ts, user_id, source_ip, level, rule_id, description, message_id
  FROM findings"""),
    "rules_as_data": _w("," + FINDINGS, """SELECT request_ts, user_id, source_ip, level, rule_id, description, message_id
  FROM findings
  UNION ALL
  SELECT v.request_ts, v.user_id, v.src_ip, 'critical', 'watch-' || p.pattern, 'Suspicious process: ' || v.process_name, v.message_id
  FROM valid v JOIN (SELECT DISTINCT process_name AS pattern FROM valid WHERE process_name LIKE '%1') p ON contains(v.process_name, p.pattern)
  WHERE v.user_id IS NOT NULL"""),
    "user_profile": _w(""",
prof AS (
  SELECT user_id FROM valid WHERE user_id IS NOT NULL GROUP BY user_id
  HAVING count(*) FILTER (WHERE process_name LIKE '%virus%') >= 20
)""", """SELECT v.user_id, CASE WHEN max(p.user_id) IS NULL THEN 'regular' ELSE 'suspicious' END AS profile_status,
  count(*) AS n_events
  FROM valid v LEFT JOIN prof p ON v.user_id = p.user_id WHERE v.user_id IS NOT NULL GROUP BY v.user_id"""),
    "held_findings": _w("," + FINDINGS + hold_sql("findings"), """SELECT request_ts, user_id, source_ip, level, rule_id,
  description, message_id, emit_ts FROM held"""),
    "critical_route": _w("," + CRITICAL_FINDINGS + hold_sql("cfind"), """SELECT request_ts, user_id, level, rule_id,
  message_id, emit_ts, CASE WHEN level = 'critical' THEN 'immediate' ELSE 'held' END AS route FROM held"""),
    "user_finding_json": _w("," + FINDINGS, f"""SELECT json_object('type', 'user-event-finding', 'request_ts', {ISO},
  'user_id', user_id, 'source_ip', source_ip, 'level', level, 'description', description)::VARCHAR AS value
  FROM findings"""),
    "user_finding_rows": _w("," + FINDINGS, """SELECT request_ts, 'user-event-finding' AS type, level, source_ip,
  description, user_id FROM findings"""),
    "sessions": _w(SESSIONS, "SELECT src_ip, session_start, session_end, event_count FROM sess"),
    "session_banned": _w(SESSIONS, """SELECT src_ip, session_start, session_end, banned_count, banned_list
  FROM sess WHERE banned_count > 0"""),
    "source_ip_findings": _w(SESSIONS, "SELECT request_ts, source_ip, level, rule_id, description FROM sfind"),
    "session_rule_rows": _w(SESSIONS, f"""SELECT request_ts, source_ip, level, rule_id, description FROM sfind
  UNION ALL
  SELECT epoch_ms(epoch_ms(max(publish_ts)) + {GAP_MS - 1}), src_ip, 'warning', 'heavy-uploads',
         concat_ws(' ', count(*) FILTER (WHERE bytes_sent > 600), CAST(sum(bytes_sent) FILTER (WHERE bytes_sent > 600) AS BIGINT),
                   max(dst_ip) FILTER (WHERE bytes_sent > 600),
                   string_agg(coalesce(process_name, '?'), ',' ORDER BY publish_ts, message_id) FILTER (WHERE bytes_sent > 600))
  FROM sid GROUP BY src_ip, sess HAVING count(*) FILTER (WHERE bytes_sent > 600) > 1"""),
    "source_finding_json": _w(SESSIONS, f"""SELECT json_object('type', 'source-ip-finding', 'request_ts', {ISO},
  'source_ip', source_ip, 'level', level, 'description', description)::VARCHAR AS value FROM sfind"""),
    "all_findings": _w("," + FINDINGS.lstrip(",") + SESSIONS, """SELECT request_ts, 'user-event-finding' AS type,
  source_ip, user_id, level, description FROM findings
  UNION ALL SELECT request_ts, 'source-ip-finding', source_ip, NULL, level, description FROM sfind"""),
    "findings_ingest": _w("," + FINDINGS.lstrip(",") + SESSIONS, """SELECT request_ts, 'user-event-finding' AS type,
  source_ip, user_id, level, description FROM findings
  UNION ALL SELECT request_ts, 'source-ip-finding', source_ip, NULL, level, description FROM sfind"""),
    "event_rows": _w("", """SELECT request_ts, dst_ip, dst_port, src_ip, bytes_sent, bytes_received, user_id,
  process_name, CAST(NULL AS VARCHAR) AS dst_hostname, CAST(request_ts AS DATE) AS request_date FROM valid"""),
    "export_partitions": _w("", """SELECT strftime(date_trunc('minute', publish_ts), '%Y-%m-%d') AS eventDate,
  strftime(date_trunc('minute', publish_ts), '%H') AS eventHour,
  strftime(date_trunc('minute', publish_ts), '%M') AS eventMinute,
  count(*) AS n_records, CAST(sum(length(json(payload_text)::VARCHAR)) AS BIGINT) AS n_chars
  FROM msgs WHERE event_id % 2 = 0 AND json_valid(payload_text) GROUP BY 1, 2, 3"""),
    "enrich_category": _w(""",
pinfo AS (
  SELECT process_name, event_type AS category, max(event_id) AS loaded_seq
  FROM fields WHERE process_name IS NOT NULL GROUP BY process_name, event_type
),
dim AS (SELECT process_name, arg_max(category, loaded_seq) AS category FROM pinfo GROUP BY process_name)""",
        """SELECT v.message_id, v.process_name, coalesce(d.category, 'UNKNOWN') AS category
  FROM valid v LEFT JOIN dim d ON v.process_name = d.process_name"""),
    "count_threshold": _w("", """SELECT t.threshold, 'read at least ' || CAST(t.threshold AS VARCHAR) || ' messages' AS message
  FROM (SELECT count(*) AS n FROM msgs) c,
       (SELECT unnest([1000, 10000, 100000, 1000000]::BIGINT[]) AS threshold) t WHERE c.n >= t.threshold"""),
    "window_sum": _w("", """SELECT time_bucket(INTERVAL 1 SECOND, publish_ts) AS window_start,
  time_bucket(INTERVAL 1 SECOND, publish_ts) + INTERVAL 1 SECOND AS window_end,
  CAST(sum(bytes_sent) AS BIGINT) AS sum_bytes, count(*) AS n FROM valid GROUP BY 1, 2"""),
    "latest_side_input": _w("", """SELECT time_bucket(INTERVAL 1 SECOND, publish_ts) AS window_start,
  CAST(sum(bytes_sent) AS BIGINT) AS sum_bytes,
  (SELECT strftime(arg_max(publish_ts, publish_ts), '%H:%M:%S') FROM valid WHERE process_name = 'another-virus') AS key_a
  FROM valid GROUP BY 1"""),
    "pipeline_counters": _w(SESSIONS, """SELECT (SELECT count(*) FROM parsed) AS elements_seen,
  (SELECT count(*) FROM parsed WHERE failure_reason IS NULL) AS total_events,
  (SELECT count(*) FROM parsed WHERE failure_reason IS NOT NULL) AS rejected_events,
  (SELECT count(*) FROM sfind) AS suspicious_activity"""),
}
