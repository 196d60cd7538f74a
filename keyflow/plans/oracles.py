"""The same queries as plain SQL over the driver tables, for DuckDB."""

from __future__ import annotations

# The inbound log, one row per delivery, with validity and dedup key.
_LOG = """
numbered AS (
  SELECT *, CAST(user_id % 4 AS INTEGER) AS part,
         row_number() OVER (PARTITION BY user_id % 4 ORDER BY ts, event_id) - 1 AS off
  FROM events),
delivered AS (
  SELECT *, ts AS arrival FROM numbered
  UNION ALL SELECT *, ts + INTERVAL 3 DAY FROM numbered WHERE event_id % 10 = 0
  UNION ALL SELECT *, ts + INTERVAL 8 DAY FROM numbered WHERE event_id % 25 = 0),
fields AS (
  SELECT 'customer.ingest.in' AS topic, part AS partition, off AS "offset",
         epoch_us(arrival) AS arrival_us, epoch_us(ts) AS timestamp_us,
         CAST(user_id AS VARCHAR) AS key, event_id, event_type, user_id,
         event_type = 'error' AND value < 2 AS is_null,
         CASE WHEN event_type = 'error' AND value >= 2 AND value < 4 THEN '  '
              ELSE CAST(user_id AS VARCHAR) END AS raw_id,
         CASE WHEN event_type = 'error' AND value >= 4 AND value < 6 THEN NULL
              ELSE '555-' || lpad(CAST(user_id % 10000 AS VARCHAR), 4, '0') END AS raw_phone,
         event_type = 'error' AND value >= 6 AND value < 8 AS no_address,
         CASE WHEN event_type = 'purchase'
              THEN CAST(user_id % 20 AS VARCHAR) || '-' ||
                   CAST(CAST(regexp_extract(props, '"k": *(-?[0-9]+)', 1) AS BIGINT) % 5 AS VARCHAR)
              WHEN event_type = 'view' THEN ' ' END AS idempotency_key
  FROM delivered),
parts AS (
  SELECT *, CASE WHEN NOT is_null THEN raw_id END AS customer_id,
         CASE WHEN NOT is_null THEN raw_phone END AS phone,
         NOT is_null AND NOT no_address AS has_address
  FROM fields),
log AS (
  SELECT *, CASE WHEN has_address THEN CAST(event_id AS VARCHAR) || ' Main' END AS street,
         CASE WHEN has_address THEN event_type END AS city,
         CASE WHEN has_address THEN 'TX' END AS state,
         CASE WHEN has_address THEN lpad(CAST(user_id AS VARCHAR), 5, '0') END AS zip,
         CASE WHEN is_null THEN 'null payload'
              WHEN NOT regexp_matches(customer_id, '\\S') THEN 'missing customerId'
              WHEN phone IS NULL OR NOT regexp_matches(phone, '\\S') THEN 'missing phoneNumber'
              WHEN NOT has_address THEN 'missing address' END AS failure,
         coalesce(regexp_matches(idempotency_key, '\\S'), false) AS has_key,
         'dedup:offset:' || topic || ':' || partition || ':' || "offset" AS offset_key,
         CASE WHEN coalesce(regexp_matches(idempotency_key, '\\S'), false)
              THEN 'dedup:idemp:' || idempotency_key
              ELSE 'dedup:offset:' || topic || ':' || partition || ':' || "offset" END AS dedup_key
  FROM parts)"""

# TTL dedup as recursion: the first row of each key, then the first one at least seven days later.
_TTL_US = 7 * 86_400_000_000
_MARKED = f"""{_LOG},
valid AS (SELECT *, struct_pack(us := arrival_us, p := partition, o := "offset", t := topic) AS place
          FROM log WHERE failure IS NULL),
chain AS (
  SELECT dedup_key, min(place) AS place FROM valid GROUP BY dedup_key
  UNION ALL
  SELECT v.dedup_key, min(v.place) FROM chain c
  JOIN valid v ON v.dedup_key = c.dedup_key AND v.arrival_us >= c.place.us + {_TTL_US}
  GROUP BY v.dedup_key),
marked AS (
  SELECT v.*, v.place = last.place AS accepted,
         CASE WHEN v.place = last.place THEN NULL
              WHEN v.topic = last.place.t AND v.partition = last.place.p AND v."offset" = last.place.o
              THEN 'offset' ELSE 'idempotency-key' END AS dedup_reason
  FROM valid v JOIN (
    SELECT w.dedup_key, w.place AS own, max(c.place) AS place
    FROM valid w JOIN chain c ON c.dedup_key = w.dedup_key AND c.place <= w.place
    GROUP BY w.dedup_key, w.place) last
  ON last.dedup_key = v.dedup_key AND last.own = v.place),
outcomes AS (
  SELECT topic, partition, "offset", arrival_us, timestamp_us, dedup_key, customer_id, phone, street,
         city, state, zip, key, event_id,
         CASE WHEN accepted THEN 'PROCESSED' ELSE 'DUPLICATE_SKIPPED' END AS outcome,
         CASE WHEN accepted THEN 'PROCESSED' ELSE 'duplicate by ' || dedup_reason END AS reason,
         dedup_reason
  FROM marked
  UNION ALL
  SELECT topic, partition, "offset", arrival_us, timestamp_us, dedup_key, customer_id, phone, street,
         city, state, zip, key, event_id, 'FAILED', failure, NULL
  FROM log WHERE failure IS NOT NULL),
done AS (SELECT * FROM outcomes WHERE outcome = 'PROCESSED')"""

# The log with holes: no topic, or neither arrival nor record time, by offset.
_HOLES = (
    _MARKED.replace("SELECT 'customer.ingest.in' AS topic", "SELECT CASE WHEN off % 97 <> 2 THEN 'customer.ingest.in' END AS topic")
    .replace("epoch_us(arrival) AS arrival_us", "CASE WHEN off % 97 <> 1 THEN epoch_us(arrival) END AS arrival_us")
    .replace(
        "CASE WHEN is_null THEN 'null payload'",
        "CASE WHEN topic IS NULL THEN 'missing topic, partition or offset' "
        "WHEN arrival_us IS NULL THEN 'missing arrival time' WHEN is_null THEN 'null payload'",
    )
)

_LATEST = f"""{_MARKED},
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY customer_id
         ORDER BY timestamp_us DESC, partition DESC, "offset" DESC, arrival_us DESC) AS place_no
  FROM done),
updates AS (
  SELECT customer_id, phone, street, city, state, zip,
         '2024-02-15T00:00:00Z' AS updated_at, topic AS last_topic,
         partition AS last_partition, "offset" AS last_offset, timestamp_us AS last_timestamp_us
  FROM ranked WHERE place_no = 1)"""

_OLD = """
old AS (
  SELECT CAST(c_custkey * 2 AS VARCHAR) AS customer_id,
         '555-' || lpad(CAST((c_custkey * 2) % 10000 AS VARCHAR), 4, '0') AS phone,
         c_name AS street, c_mktsegment AS city, 'TX' AS state,
         lpad(CAST(c_custkey * 2 AS VARCHAR), 5, '0') AS zip,
         '2023-12-31T00:00:00Z' AS updated_at
  FROM customer)"""

_MERGED = """
SELECT o.*, CAST(NULL AS VARCHAR) AS last_topic, CAST(NULL AS INTEGER) AS last_partition,
       CAST(NULL AS BIGINT) AS last_offset, CAST(NULL AS BIGINT) AS last_timestamp_us{insert_old}
FROM old o WHERE NOT EXISTS (SELECT 1 FROM updates u WHERE u.customer_id = o.customer_id)
UNION ALL
SELECT u.*{insert_new} FROM updates u LEFT JOIN old o ON o.customer_id = u.customer_id"""

_FLAG = "customer-ingest.outbound-publish"


def _bucket(column: str) -> str:
    return f"(('0x' || substr(md5('{_FLAG}.' || {column}), 1, 8))::BIGINT % 10000)"


def _enabled(column: str) -> str:
    return f"CASE WHEN {column} = '7' THEN false ELSE {_bucket(column)} < 9000 END"


_POLLS = f"""{_MARKED},
firsts AS (
  SELECT *, row_number() OVER (PARTITION BY topic, partition, "offset" ORDER BY arrival_us) AS copy_no
  FROM outcomes),
polled AS (
  SELECT topic, partition, "offset", outcome,
         row_number() OVER (PARTITION BY topic, partition ORDER BY "offset") - 1 AS n
  FROM firsts WHERE copy_no = 1),
polls AS (
  SELECT topic, partition, "offset", outcome, n // 25 AS poll, CAST(n % 25 AS INTEGER) AS idx
  FROM polled),
retry AS (
  SELECT topic, partition, poll, count(*) AS size,
         min(CASE WHEN outcome IN ('FAILED', 'LOCK_NOT_ACQUIRED') THEN idx END) AS first_retry
  FROM polls GROUP BY topic, partition, poll)"""

_PLACE = 'topic, partition, "offset", arrival_us'
_EVENT = "customer_id, phone, street, city, state, zip"
_OUTCOME_VIEW = f"SELECT {_PLACE}, dedup_key, outcome, reason, dedup_reason FROM outcomes"

# The span of a record: remote ids where the record carries any, hashes of its place otherwise.
_SPANS = """
remote AS (
  SELECT *, topic || '|' || partition || '|' || "offset" AS place_text,
         event_id % 3 < 2 AS has_parent
  FROM {source}),
traced AS (
  SELECT *, CASE WHEN has_parent THEN md5(CAST(event_id AS VARCHAR))
                 ELSE substr(sha256('trace|' || place_text), 1, 32) END AS trace_id,
         CASE WHEN has_parent
              THEN substr(md5('s' || CAST(event_id AS VARCHAR)), 1, 16) END AS parent_span_id
  FROM remote),
spans AS (
  SELECT *, substr(sha256(trace_id || '|' || place_text), 1, 16) AS span_id FROM traced)"""


def _masked(column: str) -> str:
    text = f"regexp_replace({column}, '[A-Z]', 'X', 'g')"
    text = f"regexp_replace({text}, '[a-z]', 'x', 'g')"
    return f"regexp_replace({text}, '[0-9]', 'n', 'g') AS {column}"


def _with(ctes: str, body: str) -> str:
    return f"WITH RECURSIVE {ctes.strip()}\n{body}"


_HEADER_NAMES = """
named AS (
  SELECT *, CASE WHEN event_type = 'purchase' AND event_id % 2 = 0
                 THEN ['idempotency-key', 'idempotency-key']
                 WHEN event_type IN ('purchase', 'view') THEN ['idempotency-key']
                 ELSE [] END AS own,
         CASE WHEN event_id % 3 = 0 THEN ['traceparent'] WHEN event_id % 3 = 1 THEN ['b3']
              ELSE [] END AS tracing
  FROM log)"""

_LAST_ACCEPTED = f"""{_MARKED},
seen AS (SELECT dedup_key, max(arrival_us) + {_TTL_US} AS expires_us FROM done GROUP BY dedup_key)"""

_SENT = f"""{_MARKED},
sent AS (SELECT * FROM done WHERE {_enabled("customer_id")})"""

_JSON = " || ',' || ".join(
    [
        """'{"customerId":"' || customer_id || '"'""",
        """'"phoneNumber":"' || phone || '"'""",
        """'"address":{"street":"' || street || '"'""",
        """'"city":"' || city || '"'""",
        """'"state":"' || state || '"'""",
        """'"zip":"' || zip || '"}'""",
        """'"status":"PROCESSED"'""",
        """'"processedAt":"2024-02-15T00:00:00Z"'""",
        """'"reason":"PROCESSED"'""",
        """'"inboundTopic":"' || topic || '"'""",
        """'"inboundPartition":' || partition""",
        """'"inboundOffset":' || "offset" || '}'""",
    ]
)

ORACLES = {
    "inbound_envelope": _with(
        f"{_LOG}, {_HEADER_NAMES}",
        f"SELECT {_PLACE}, timestamp_us, key, offset_key, "
        f"CAST(len(own) + len(tracing) AS INTEGER) AS headers, {_EVENT} FROM named",
    ),
    "payload_codec": _with(_LOG, f"SELECT {_PLACE}, is_null AS undecodable, {_EVENT} FROM log"),
    "payload_validity": _with(
        _LOG, f"SELECT {_PLACE}, is_null, failure IS NULL AS is_valid, failure AS reason FROM log"
    ),
    "idempotency_header": _with(
        _LOG,
        f"SELECT {_PLACE}, idempotency_key, has_key, 'dedup:idemp:' || idempotency_key AS header_key, "
        "dedup_key FROM log",
    ),
    "header_edits": _with(
        f"{_LOG}, {_HEADER_NAMES}",
        f"SELECT {_PLACE}, array_to_string(own || tracing, ',') AS names, "
        "array_to_string(tracing || ['idempotency-key'], ',') AS edited_names, "
        "'new-' || key AS edited_value FROM named",
    ),
    "dedup_first_wins": _with(
        f"""{_LOG},
ranked AS (SELECT *, row_number() OVER w AS place_no, count(*) OVER (PARTITION BY dedup_key) AS deliveries
  FROM log WHERE failure IS NULL
  WINDOW w AS (PARTITION BY dedup_key ORDER BY arrival_us, partition, "offset", topic))""",
        f"SELECT dedup_key, {_PLACE}, deliveries FROM ranked WHERE place_no = 1",
    ),
    "dedup_ttl": _with(_MARKED, f"SELECT {_PLACE}, dedup_key, accepted, dedup_reason FROM marked"),
    "seen_membership": _with(
        _LAST_ACCEPTED,
        f"SELECT {_PLACE}, dedup_key, expires_us IS NOT NULL AS known, expires_us, "
        "coalesce(expires_us > arrival_us, false) AS alive FROM log LEFT JOIN seen USING (dedup_key)",
    ),
    "outcome_log": _with(
        _MARKED,
        f"SELECT {_PLACE}, dedup_key, outcome, reason, dedup_reason, CASE outcome "
        "WHEN 'DUPLICATE_SKIPPED' THEN 'SKIPPED_DUPLICATE' ELSE outcome END AS status FROM outcomes",
    ),
    "duplicate_skips": _with(
        _MARKED,
        f"SELECT {_PLACE}, dedup_key, dedup_reason FROM outcomes WHERE outcome = 'DUPLICATE_SKIPPED'",
    ),
    "customer_upsert": _with(_LATEST, "SELECT * FROM updates"),
    "customer_lookup": _with(
        f"{_MARKED}, {_OLD}",
        "SELECT d.customer_id, count(*) AS writes, any_value(o.customer_id) IS NULL AS is_insert, "
        "any_value(o.phone) AS stored_phone, any_value(o.city) AS stored_city "
        "FROM done d LEFT JOIN old o ON o.customer_id = d.customer_id GROUP BY d.customer_id",
    ),
    "snapshot_merge": _with(
        f"{_LATEST}, {_OLD}",
        _MERGED.format(
            insert_old=", false AS is_insert", insert_new=", o.customer_id IS NULL AS is_insert"
        ),
    ),
    "flag_evaluation": _with(
        f"""{_LOG},
contexts AS (SELECT *, CASE WHEN regexp_matches(customer_id, '\\S') THEN customer_id
  ELSE 'anonymous' END AS context_key FROM log)""",
        f"SELECT {_PLACE}, context_key, {_bucket('context_key')} AS bucket, "
        f"{_enabled('context_key')} AS flag_enabled FROM contexts",
    ),
    "flag_as_of": _with(
        f"""{_LOG},
contexts AS (SELECT *, CASE WHEN regexp_matches(customer_id, '\\S') THEN customer_id ELSE 'anonymous' END AS context_key,
  make_timestamp(arrival_us) AS instant FROM log)""",
        f"""SELECT {_PLACE}, CASE
  WHEN context_key = '7' THEN instant >= '2024-01-10'
  WHEN try_cast(context_key AS BIGINT) % 5 = 0 AND instant >= '2024-01-12' AND instant < '2024-01-20' THEN true
  WHEN instant >= '2024-01-25' OR instant < '2024-01-03' THEN true
  ELSE {_bucket('context_key')} < CASE WHEN instant >= '2024-01-15' THEN 5000 ELSE 9000 END END AS flag_enabled, way
FROM contexts CROSS JOIN (VALUES ('broadcast'), ('sorted')) ways(way)""",
    ),
    "flag_app_scope": _with(
        _LOG,
        f"SELECT {_PLACE}, true AS known_flag, false AS unknown_flag, false AS offline_flag FROM log",
    ),
    "outbound_processed": _with(
        _SENT,
        f"SELECT {_EVENT}, 'PROCESSED' AS status, '2024-02-15T00:00:00Z' AS processed_at, "
        "'PROCESSED' AS reason, topic AS inbound_topic, partition AS inbound_partition, "
        '"offset" AS inbound_offset FROM sent',
    ),
    "outbound_messages": _with(
        f"{_SENT}, {_SPANS.format(source='sent')}",
        f"SELECT 'customer.ingest.out' AS topic, customer_id AS key, {_JSON} AS value, "
        "'traceparent,X-B3-TraceId,X-B3-SpanId,X-B3-Sampled,b3' AS header_names, "
        "'00-' || trace_id || '-' || span_id || '-01' AS traceparent, "
        "trace_id || '-' || span_id || '-1' AS b3, trace_id, true AS sampled FROM spans",
    ),
    "pii_redacted": _with(
        _LOG,
        f"SELECT {_PLACE}, customer_id, "
        + ", ".join(_masked(c) for c in ["phone", "street", "city", "state", "zip"])
        + " FROM log",
    ),
    "quarantine": _with(
        _MARKED, f"SELECT {_PLACE}, outcome, reason, {_EVENT} FROM outcomes WHERE outcome = 'FAILED'"
    ),
    "poll_batches": _with(_POLLS, 'SELECT topic, partition, "offset", poll, idx, outcome FROM polls'),
    "first_retryable": _with(_POLLS, "SELECT * FROM retry"),
    "committable_prefix": _with(
        _POLLS,
        'SELECT topic, partition, "offset", poll, idx FROM polls JOIN retry '
        "USING (topic, partition, poll) WHERE first_retry IS NULL OR idx < first_retry",
    ),
    "redelivery_set": _with(
        _POLLS,
        'SELECT topic, partition, "offset", poll, idx FROM polls JOIN retry '
        "USING (topic, partition, poll) WHERE idx > first_retry "
        "AND outcome NOT IN ('FAILED', 'LOCK_NOT_ACQUIRED')",
    ),
    "outcome_counts": _with(
        _MARKED,
        "SELECT topic, partition, outcome, count(*) AS records FROM outcomes "
        "GROUP BY topic, partition, outcome",
    ),
    "hot_keys": _with(
        _LOG,
        "SELECT customer_id, arrival_us // 3600000000 * 3600000000 AS window_start_us, "
        "count(*) AS records FROM log WHERE failure IS NULL GROUP BY 1, 2 HAVING count(*) > 1",
    ),
    "live_hot_keys": _with(
        _LOG,
        "SELECT customer_id, arrival_us // 3600000000 * 3600000000 AS window_start_us, "
        "count(*) AS records FROM log WHERE failure IS NULL GROUP BY 1, 2 HAVING count(*) > 1",
    ),
    "trace_columns": _with(
        f"{_LOG}, {_SPANS.format(source='log')}",
        f"SELECT {_PLACE}, trace_id, parent_span_id, span_id, true AS sampled, "
        "'customer.ingest.process' AS span_name, "
        "'kafka|' || topic || '|' || partition || '|' || \"offset\" AS tags FROM spans",
    ),
    "trace_forms": _with(
        f"""{_LOG},
placed AS (SELECT *, topic || '|' || partition || '|' || "offset" AS place_text, "offset" % 4 AS form FROM log),
traced AS (
  SELECT *, CASE WHEN form = 1 THEN lpad(substr(md5('t|' || place_text), 1, 16), 32, '0')
                 WHEN form = 3 THEN md5('w|' || place_text) ELSE md5('t|' || place_text) END AS trace_id,
         substr(md5('s|' || place_text), 1, 16) AS parent_span_id, form <> 1 AS sampled, form = 2 AS debug
  FROM placed),
spans AS (SELECT *, substr(sha256(trace_id || '|' || place_text), 1, 16) AS span_id FROM traced)""",
        f"""SELECT {_PLACE}, trace_id, parent_span_id, span_id, sampled, debug,
  trace_id || '-' || span_id || '-' || CASE WHEN debug THEN 'd' WHEN sampled THEN '1' ELSE '0' END AS b3,
  CASE WHEN debug THEN '1' END AS flags,
  '00-' || trace_id || '-' || span_id || '-0' || CASE WHEN sampled THEN '1' ELSE '0' END AS traceparent FROM spans""",
    ),
    "batch_outcomes": _with(_MARKED, _OUTCOME_VIEW),
    "batch_snapshot": _with(f"{_LATEST}, {_OLD}", _MERGED.format(insert_old="", insert_new="")),
    "stream_snapshot": _with(f"{_LATEST}, {_OLD}", _MERGED.format(insert_old="", insert_new="")),
    "stream_outcomes": _with(_MARKED, _OUTCOME_VIEW),
    "stream_backfill": _with(_MARKED, _OUTCOME_VIEW),
    "stream_bounded": _with(_MARKED, _OUTCOME_VIEW),
    "live_counts": _with(
        _MARKED,
        "SELECT outcome, count(*) AS records, memory FROM outcomes "
        "CROSS JOIN (VALUES ('log'), ('state')) memories(memory) GROUP BY outcome, memory",
    ),
    "dedup_ttl_heavy": _with(_MARKED, f"SELECT {_PLACE}, dedup_key, accepted, dedup_reason FROM marked"),
    "unplaced_records": _with(
        _HOLES,
        f"SELECT {_PLACE}, coalesce(dedup_key, '') AS dedup_key, outcome, reason, dedup_reason, way "
        "FROM outcomes CROSS JOIN (VALUES ('fold'), ('walk'), ('log'), ('state')) ways(way)",
    ),
    "redelivery_repeat": _with(
        f"""{_LATEST},
sent AS (SELECT * FROM done WHERE {_enabled("customer_id")}),
held AS (
  SELECT 'outcome_log' AS sink, concat_ws('|', topic, partition, "offset", arrival_us) AS key FROM outcomes
  UNION ALL
  SELECT 'quarantine', concat_ws('|', topic, partition, "offset", arrival_us) FROM outcomes WHERE outcome = 'FAILED'
  UNION ALL SELECT 'outbound', customer_id FROM sent
  UNION ALL SELECT 'customers', customer_id FROM updates)""",
        "SELECT sink, key, count(*) AS records, way FROM held "
        "CROSS JOIN (VALUES ('batch'), ('stream')) ways(way) GROUP BY sink, key, way",
    ),
    "landed_replay": _with(
        _LOG,
        f"SELECT {_PLACE}, dedup_key, 'FAILED' AS outcome, failure AS reason, "
        "CAST(NULL AS VARCHAR) AS dedup_reason FROM log WHERE failure IS NOT NULL",
    ),
}
