"""The same queries as SQL on the driver's tables."""

from __future__ import annotations

# Input tables, in the order in which they build on each other.
CTES = {
    "log": """
SELECT topic, part, CAST(rn - 1 + (rn - 1) // 6 + 100 * part AS BIGINT) AS off, event_id, payload, ts FROM (
  SELECT event_type AS topic, CAST(user_id % 4 AS INT) AS part,
         row_number() OVER (PARTITION BY event_type, user_id % 4 ORDER BY event_id) AS rn,
         event_id, props AS payload, ts
  FROM events) x""",
    "doclog": """
SELECT source AS topic, CAST(doc_id % 4 AS INT) AS part,
       CAST(row_number() OVER (PARTITION BY source, doc_id % 4 ORDER BY doc_id) - 1 AS BIGINT) AS off,
       text AS payload
FROM documents""",
    "ckpt": """
SELECT topic, part, CASE WHEN topic < 'f' THEN 'job-a' ELSE 'job-b' END AS job_id,
       CAST(CASE WHEN part = 1 THEN min(off) - 5
                 WHEN part = 3 AND topic = 'view' THEN max(off) + 50
                 ELSE floor((min(off) + max(off)) / 2.0) END AS BIGINT) AS committed
FROM log WHERE part <> 0 GROUP BY topic, part""",
    "commits": """
SELECT topic, part, event_id AS seq,
       CASE WHEN event_id % 6 = 1 THEN greatest(off - 60, 0) ELSE off + 1 END AS off, ts
FROM log""",
    "failed": "SELECT topic, part, off FROM log WHERE event_id % 97 = 1",
    "done": """
SELECT topic, part, off FROM log LEFT JOIN ckpt USING (topic, part) WHERE event_id % 8 <> 3 OR off < committed""",
    "still_open": "SELECT topic, part, off FROM log ANTI JOIN done USING (topic, part, off)",
    "islands": """
SELECT topic, part, min(off) AS low, max(off) AS high
FROM (SELECT topic, part, off, off - row_number() OVER (PARTITION BY topic, part ORDER BY off) AS island FROM still_open) x
GROUP BY topic, part, island""",
    "reports": """
SELECT topic, part, ts AS since, event_id AS reported,
       CAST(CASE WHEN event_id % 7 <> 0 THEN event_id % 4 END AS INT) AS leader
FROM log WHERE event_id % 53 = 1
QUALIFY row_number() OVER (PARTITION BY topic, part, ts ORDER BY event_id DESC) = 1""",
    "topic_state": """
SELECT snap, topic, part,
  '{"controller_epoch":4,"isr":[' || CAST(part % 3 AS VARCHAR) || ',' || CAST((part + 1) % 3 AS VARCHAR)
  || '],"leader":' || CASE WHEN topic = 'view' AND part = 3 AND snap = 1 THEN 'null'
       WHEN topic = 'click' AND snap >= 2 THEN CAST((part + 1) % 3 AS VARCHAR)
       ELSE CAST(part % 3 AS VARCHAR) END
  || ',"leader_epoch":' || CAST(snap AS VARCHAR) || ',"version":1}' AS state
FROM (SELECT DISTINCT topic, part FROM log) l
CROSS JOIN (VALUES (0), (1), (2), (3)) AS s(snap)""",
    "brokers": """
SELECT broker_id, '{"host":"' || host || '","jmx_port":9999,"port":' || CAST(port AS VARCHAR) || ',"version":1}' AS info
FROM (SELECT broker_id, 'node' || CAST(broker_id AS VARCHAR) || '.example' AS host, 9092 + broker_id % 2 AS port
      FROM (SELECT CAST(CASE WHEN s_suppkey >= 2 THEN s_suppkey + 1 ELSE s_suppkey END AS INT) AS broker_id FROM supplier) s) b""",
    "znode_dump": """
SELECT '/consumers/demo/offsets/' || topic || '/' || CAST(part AS VARCHAR) AS path, CAST(committed AS VARCHAR) AS data FROM ckpt
UNION ALL
SELECT '/brokers/topics/' || topic || '/partitions/' || CAST(part AS VARCHAR) || '/state', state FROM topic_state WHERE snap = 3
UNION ALL
SELECT '/brokers/ids/' || CAST(broker_id AS VARCHAR), info FROM brokers""",
    "fetches": """
SELECT CAST(user_id % 4 AS INT) AS part, event_id AS seq,
       CAST(CASE WHEN event_type = 'error' THEN event_id % 16 - 1 ELSE 0 END AS INT) AS error_code
FROM events""",
    "bounds": """
SELECT topic, part, min(off) AS earliest, max(off) + 1 AS latest, count(*) AS n_rows,
       max(off) + 1 - min(off) - count(*) AS n_missing
FROM log GROUP BY topic, part""",
    "starts": """
SELECT topic, part, earliest, committed,
       CASE WHEN committed IS NULL OR committed < earliest OR committed < 0 THEN earliest ELSE committed END AS start_off
FROM bounds LEFT JOIN ckpt USING (topic, part)""",
    "scanned": "SELECT log.* FROM log JOIN starts USING (topic, part) WHERE off >= start_off",
    "states": """
SELECT snap, topic, part, CAST(state ->> '$.leader' AS INT) AS leader,
       CAST(state ->> '$.isr[0]' AS INT) AS isr0, CAST(state ->> '$.isr[1]' AS INT) AS isr1
FROM topic_state""",
    "addresses": """
SELECT broker_id, info ->> '$.host' AS host, CAST(info ->> '$.port' AS INT) AS port FROM brokers""",
    "leaders": """
SELECT topic, part, leader, host, port
FROM states JOIN addresses ON leader = broker_id WHERE snap = 3""",
    "led": """
SELECT snap, topic, part, leader, lag(leader) OVER w AS old_leader, row_number() OVER w AS nth
FROM states WINDOW w AS (PARTITION BY topic, part ORDER BY snap)""",
    "numbered": """
SELECT *, row_number() OVER (PARTITION BY topic, part ORDER BY off) AS rn FROM log""",
    "numbered_scan": """
SELECT *, row_number() OVER (PARTITION BY topic, part ORDER BY off) AS rn FROM scanned""",
    "sized_docs": """
SELECT topic, part, off, payload, strlen(payload) AS n_bytes,
       sum(strlen(payload)) OVER (PARTITION BY topic, part ORDER BY off) AS cum,
       row_number() OVER (PARTITION BY topic, part ORDER BY off) AS rn
FROM doclog""",
    "mirrored": """
SELECT 'sync_' || topic AS topic, part, off, CAST((rn - 1) % 100 + 1 AS VARCHAR) AS new_key,
       payload AS value, CAST((rn - 1) // 100 AS BIGINT) AS batch_id
FROM numbered_scan""",
    "daily": """
SELECT topic, part, time_bucket(INTERVAL 1 DAY, ts) AS win_start, CAST(sum(strlen(payload)) AS BIGINT) AS bytes
FROM log GROUP BY topic, part, time_bucket(INTERVAL 1 DAY, ts)""",
}


def with_ctes(names: str, body: str) -> str:
    wanted = names.split()
    unknown = set(wanted) - CTES.keys()
    if unknown:
        raise KeyError(f"no such input: {sorted(unknown)}")
    parts = [f"{name} AS ({sql.strip()})" for name, sql in CTES.items() if name in wanted]
    # a body that begins with a comma goes on with inputs of its own, which may be recursive
    recursive = "RECURSIVE " if body.startswith(",") else ""
    return f"WITH {recursive}{', '.join(parts)} {body.strip()}" if parts else body.strip()


_OFFSETS = "log ckpt bounds starts"
_SCAN = f"{_OFFSETS} scanned"
_TREE = "log ckpt topic_state brokers znode_dump"
_SOURCES = {
    "log_scan": (_SCAN, "SELECT topic, part, off, payload FROM scanned"),
    "bounded_read": ("log numbered", "SELECT topic, part, off, payload FROM numbered WHERE rn <= 20"),
    "earliest_dump": (
        "doclog sized_docs",
        """SELECT topic, part, off, CAST(n_bytes AS BIGINT) AS n_bytes,
                  CAST(length(CAST(off AS VARCHAR) || ': ' || payload) AS BIGINT) AS line_len
           FROM sized_docs WHERE cum <= 65536 OR rn = 1""",
    ),
    "mirror_sink": (_SCAN, "SELECT topic, part, off, payload AS value FROM scanned"),
    "checkpoint_read": (
        _TREE,
        """SELECT split_part(path, '/', 5) AS topic, CAST(split_part(path, '/', 6) AS INT) AS part,
                  TRY_CAST(data AS BIGINT) AS committed
           FROM znode_dump WHERE path LIKE '/consumers/demo/offsets/%'""",
    ),
    "checkpoint_upsert": (
        "log commits",
        "SELECT topic, part, arg_max(off, seq) AS off, max(seq) AS seq FROM commits GROUP BY topic, part",
    ),
    "checkpoint_deltas": (
        "log commits",
        """, quarters AS (SELECT *, (seq - min(seq) OVER ()) * 4 // (max(seq) OVER () - min(seq) OVER () + 1) AS quarter FROM commits)
           SELECT topic, part, 'job' AS job_id, arg_max(off, seq) AS committed, snapshot
           FROM quarters JOIN (VALUES (1), (3)) AS s(snapshot) ON quarter <= snapshot
           GROUP BY topic, part, snapshot""",
    ),
    "znode_json": (
        _TREE,
        """SELECT path, CAST(data ->> '$.leader' AS INT) AS leader, data ->> '$.host' AS host,
                  CAST(data ->> '$.port' AS INT) AS port
           FROM znode_dump""",
    ),
    "node_writes": (
        "log ckpt topic_state brokers addresses states",
        """SELECT '/consumers/demo/offsets/' || topic || '/' || CAST(part AS VARCHAR) AS path,
                  CAST(committed AS VARCHAR) AS data, 'plain' AS form FROM ckpt
           UNION ALL
           SELECT '/consumers/demo/offsets/' || topic || '/' || CAST(part AS VARCHAR),
                  '{"topology":{"id":"' || job_id || '"},"offset":' || CAST(committed AS VARCHAR) || '}', 'job' FROM ckpt
           UNION ALL
           SELECT '/brokers/topics/' || topic || '/partitions/' || CAST(part AS VARCHAR) || '/state',
                  '{"controller_epoch":1,"isr":[' || CAST(isr0 AS VARCHAR) || ',' || CAST(isr1 AS VARCHAR) || '],"leader":'
                  || coalesce(CAST(leader AS VARCHAR), 'null') || ',"leader_epoch":1,"version":1}', 'state'
           FROM states WHERE snap = 1
           UNION ALL
           SELECT '/brokers/ids/' || CAST(broker_id AS VARCHAR),
                  '{"host":"' || host || '","jmx_port":9999,"port":' || CAST(port AS VARCHAR) || ',"version":1}', 'broker'
           FROM addresses""",
    ),
    "node_reads": ("log ckpt", "SELECT topic, part, job_id, committed FROM ckpt"),
    "gen_messages": (
        "",
        """SELECT id, substr(h, 1, 8) || '-' || substr(h, 9, 4) || '-' || substr(h, 13, 4) || '-'
                  || substr(h, 17, 4) || '-' || substr(h, 21, 12) AS value
           FROM (SELECT event_id AS id, md5('sync-' || CAST(event_id AS VARCHAR)) AS h FROM events) x""",
    ),
}

_ROWWISE = {
    "payload_decode": (
        "log",
        "SELECT topic, part, off, payload AS text, CAST(strlen(payload) AS BIGINT) AS n_bytes FROM log",
    ),
    "drop_old_offsets": (
        "log ckpt",
        """SELECT topic, part, off FROM log LEFT JOIN ckpt USING (topic, part)
           WHERE off >= coalesce(committed, 0)""",
    ),
    "retopic": ("log", "SELECT topic AS src_topic, 'sync_' || topic AS topic, part, off FROM log"),
    "rekey_sequence": (
        "log numbered",
        "SELECT topic, part, off, CAST((rn - 1) % 100 + 1 AS VARCHAR) AS new_key FROM numbered",
    ),
    "partition_by": (
        "log",
        """SELECT event_id, CAST(event_id % 10 % 3 AS INT) AS target_part,
                  CAST(CASE WHEN u >= 2147483648 THEN u - 4294967296 ELSE u END AS INT) AS jhash
           FROM (SELECT event_id,
                   list_reduce(list_prepend(CAST(0 AS BIGINT),
                     list_transform(string_split(CAST(event_id AS VARCHAR), ''), lambda c: CAST(unicode(c) AS BIGINT))),
                     lambda a, b: (a * 31 + b) & 4294967295) AS u
                 FROM log) x""",
    ),
    "encode": (
        "log",
        """SELECT 'sync_' || topic AS topic, CAST(event_id AS VARCHAR) AS key, part AS "partition",
                  '{' || CAST(strlen(payload) AS VARCHAR) || '}' || payload AS value
           FROM log""",
    ),
    "hash_partition": (
        "log",
        """SELECT event_id, CAST(h AS INT) AS jhash, CAST(((h % 8) + 8) % 8 AS INT) AS target_part
           FROM (SELECT event_id, CASE WHEN u >= 2147483648 THEN u - 4294967296 ELSE u END AS h
                 FROM (SELECT event_id,
                         list_reduce(list_prepend(CAST(0 AS BIGINT),
                           list_transform(string_split(payload, ''), lambda c: CAST(unicode(c) AS BIGINT))),
                           lambda a, b: (a * 31 + b) & 4294967295) AS u
                       FROM log) x) y""",
    ),
    "next_offset": (
        "log ckpt bounds",
        """SELECT topic, part, greatest(coalesce(committed, 0), latest) AS next_off
           FROM bounds LEFT JOIN ckpt USING (topic, part)""",
    ),
    "endpoint_parse": (
        "",
        r"""SELECT DISTINCT CASE WHEN valid THEN host END AS host, CASE WHEN valid THEN port END AS port,
                   CASE WHEN valid THEN host || ':' || CAST(port AS VARCHAR) ELSE item END AS endpoint, valid
            FROM (SELECT item, host, port,
                         n_parts <= 2 AND host <> '' AND port IS NOT NULL AS valid
                  FROM (SELECT item, split_part(bare, ':', 1) AS host, len(string_split(bare, ':')) AS n_parts,
                               CASE WHEN split_part(bare, ':', 2) = '' THEN 9092
                                    ELSE TRY_CAST(split_part(bare, ':', 2) AS INT) END AS port
                        FROM (SELECT item, rtrim(item, ':') AS bare FROM (
                          SELECT unnest([
                            'host' || CAST(user_id AS VARCHAR) || '.example' || CASE event_id % 5
                              WHEN 0 THEN '' WHEN 1 THEN ':' WHEN 2 THEN ':' || CAST(9000 + event_id % 100 AS VARCHAR)
                              WHEN 3 THEN ':1:2' ELSE ':x' END,
                            'spare' || CAST(event_id % 13 AS VARCHAR) || '.example:9093']) AS item
                          FROM events) a) b) c) d""",
    ),
    "checkpoint_paths": (
        _TREE,
        """SELECT path, kind, topic, part, 'Client_sync_' || CAST(part AS VARCHAR) AS client_id
           FROM (SELECT path, 'offset' AS kind, split_part(path, '/', 5) AS topic,
                        CAST(split_part(path, '/', 6) AS INT) AS part
                 FROM znode_dump WHERE path LIKE '/consumers/%'
                 UNION ALL
                 SELECT path, 'state', split_part(path, '/', 4), CAST(split_part(path, '/', 6) AS INT)
                 FROM znode_dump WHERE path LIKE '/brokers/topics/%'
                 UNION ALL
                 SELECT path, 'broker', NULL, NULL FROM znode_dump WHERE path LIKE '/brokers/ids/%') x""",
    ),
}

_STATES = "log topic_state states"
_JOINS = {
    "partition_leaders": (
        f"{_STATES} brokers addresses leaders",
        "SELECT topic, part, leader, host, port FROM leaders",
    ),
    "resolve_start": (_OFFSETS, "SELECT topic, part, earliest, committed, start_off FROM starts"),
    "resolve_start_job": (
        "log ckpt bounds",
        """SELECT start_mode, topic, part, CASE WHEN reason = 'saved' THEN committed ELSE start END AS start_off, reason
           FROM (SELECT *, CASE WHEN committed IS NULL THEN 'no_record'
                                WHEN job_id <> 'job-a' THEN 'forced'
                                WHEN start - committed > 300 THEN 'too_far'
                                WHEN committed <= 0 THEN 'non_positive' ELSE 'saved' END AS reason
                 FROM (SELECT topic, part, job_id, committed, 'earliest' AS start_mode, earliest AS start
                       FROM bounds LEFT JOIN ckpt USING (topic, part)
                       UNION ALL
                       SELECT topic, part, job_id, committed, 'latest', latest
                       FROM bounds LEFT JOIN ckpt USING (topic, part)) x) y""",
    ),
    "replay_failed": (
        f"{_SCAN} failed",
        """SELECT topic, part, off, payload, true AS replayed FROM log SEMI JOIN failed USING (topic, part, off)
           UNION ALL
           SELECT topic, part, off, payload, false FROM scanned ANTI JOIN failed USING (topic, part)""",
    ),
    "replica_hosts": (
        f"{_STATES} brokers addresses",
        """SELECT topic, part, string_agg(host, ',' ORDER BY pos) AS hosts
           FROM (SELECT topic, part, 0 AS pos, isr0 AS broker_id FROM states WHERE snap = 3
                 UNION ALL
                 SELECT topic, part, 1, isr1 FROM states WHERE snap = 3) r
           JOIN addresses USING (broker_id) GROUP BY topic, part""",
    ),
    "restart_flags": (
        _STATES,
        """SELECT broker_id, snap, bool_or(was IS NULL OR now IS NULL) AS changed
           FROM (SELECT coalesce(o.broker_id, n.broker_id) AS broker_id, coalesce(o.snap + 1, n.snap) AS snap,
                        o.broker_id AS was, n.broker_id AS now
                 FROM (SELECT snap, leader AS broker_id, topic, part FROM states WHERE snap < 3 AND leader IS NOT NULL) o
                 FULL JOIN (SELECT snap, leader AS broker_id, topic, part FROM states WHERE snap > 0 AND leader IS NOT NULL) n
                 ON n.snap = o.snap + 1 AND n.broker_id = o.broker_id AND n.topic = o.topic AND n.part = o.part) x
           GROUP BY broker_id, snap""",
    ),
    "accepted_leaders": (
        f"{_STATES} brokers addresses",
        """SELECT n.topic, n.part, min_by(n.host, n.snap) FILTER (WHERE n.host IS NOT NULL
                  AND (n.snap > 1 OR o.host IS NULL OR lower(n.host) <> lower(o.host))) AS host
           FROM (SELECT snap, topic, part, host FROM states LEFT JOIN addresses ON leader = broker_id WHERE snap > 0) n
           JOIN (SELECT topic, part, host FROM states LEFT JOIN addresses ON leader = broker_id WHERE snap = 0) o USING (topic, part)
           GROUP BY n.topic, n.part""",
    ),
    "assignment_diff": (
        _STATES,
        """SELECT broker_id, topic, part,
                  CASE WHEN o.snap IS NULL THEN 'added' WHEN n.snap IS NULL THEN 'removed' ELSE 'kept' END AS change
           FROM (SELECT snap, leader AS broker_id, topic, part FROM states WHERE snap = 1 AND leader IS NOT NULL) o
           FULL JOIN (SELECT snap, leader AS broker_id, topic, part FROM states WHERE snap = 2 AND leader IS NOT NULL) n
           USING (broker_id, topic, part)""",
    ),
}

_AGGREGATES = {
    "offset_bounds": ("log bounds", "SELECT topic, part, earliest, latest, n_rows, n_missing FROM bounds"),
    "offset_at_time": (
        "log",
        """SELECT topic, part, coalesce(min(off) FILTER (WHERE ts >= TIMESTAMP '2024-01-15 00:00:00'), max(off) + 1) AS off
           FROM log GROUP BY topic, part""",
    ),
    "default_offset": (
        "log bounds",
        """SELECT topic, part, force, CASE WHEN force THEN earliest ELSE latest END AS off
           FROM (SELECT topic, part, earliest, latest, unnest([true, false]) AS force FROM bounds) x""",
    ),
    "partition_count": (
        _STATES,
        "SELECT topic, count(DISTINCT part) AS n_parts FROM states GROUP BY topic",
    ),
    "partitions_led_by": (
        _STATES,
        """SELECT leader, topic, count(*) AS n, string_agg(CAST(part AS VARCHAR), ',' ORDER BY part) AS parts
           FROM states WHERE snap = 3 AND leader IS NOT NULL GROUP BY leader, topic""",
    ),
    "broker_partitions": (
        f"{_STATES} led",
        """SELECT broker_id, topic, string_agg(CAST(part AS VARCHAR), ',' ORDER BY part) AS parts
           FROM (SELECT broker_id, topic, part, arg_max(action, seq) AS action
                 FROM (SELECT leader AS broker_id, topic, part, snap * 2 + 1 AS seq, 'register' AS action
                       FROM led WHERE leader IS NOT NULL AND (nth = 1 OR leader IS DISTINCT FROM old_leader)
                       UNION ALL
                       SELECT old_leader, topic, part, snap * 2, 'unregister'
                       FROM led WHERE old_leader IS NOT NULL AND leader IS DISTINCT FROM old_leader) e
                 GROUP BY broker_id, topic, part) f
           WHERE action = 'register' GROUP BY broker_id, topic""",
    ),
    "registry_deltas": (
        f"{_STATES} led",
        """SELECT broker_id, topic, string_agg(CAST(part AS VARCHAR), ',' ORDER BY part) AS parts
           FROM (SELECT broker_id, topic, part, arg_max(action, seq) AS action
                 FROM (SELECT leader AS broker_id, topic, part, snap * 2 + 1 AS seq, 'register' AS action
                       FROM led WHERE leader IS NOT NULL AND (nth = 1 OR leader IS DISTINCT FROM old_leader)
                       UNION ALL
                       SELECT old_leader, topic, part, snap * 2, 'unregister'
                       FROM led WHERE old_leader IS NOT NULL AND leader IS DISTINCT FROM old_leader) e
                 GROUP BY broker_id, topic, part) f
           WHERE action = 'register' GROUP BY broker_id, topic""",
    ),
    "broker_id_for_host": (
        _TREE,
        """SELECT 'node1' AS prefix, max(CAST(split_part(path, '/', 4) AS INT)) AS broker_id
           FROM znode_dump WHERE path LIKE '/brokers/ids/%' AND starts_with(data ->> '$.host', 'node1')""",
    ),
    "payload_volume": (
        "log daily",
        "SELECT topic, part, win_start, bytes, bytes > 150 AS over_limit FROM daily",
    ),
    "fetch_error_rollup": (
        "fetches",
        """SELECT part, error, CASE error WHEN 'NO_ERROR' THEN 'ok' WHEN 'OFFSET_OUT_OF_RANGE' THEN 'reset'
                                        ELSE 'fail' END AS action, count(*) AS n
           FROM (SELECT part, coalesce(name, 'UNKNOWN') AS error
                 FROM fetches LEFT JOIN (VALUES (0, 'NO_ERROR'), (1, 'OFFSET_OUT_OF_RANGE'), (2, 'INVALID_MESSAGE'),
                   (3, 'UNKNOWN_TOPIC_OR_PARTITION'), (4, 'INVALID_FETCH_SIZE'), (5, 'LEADER_NOT_AVAILABLE'),
                   (6, 'NOT_LEADER_FOR_PARTITION'), (7, 'REQUEST_TIMED_OUT'), (8, 'BROKER_NOT_AVAILABLE'),
                   (9, 'REPLICA_NOT_AVAILABLE'), (10, 'MESSAGE_SIZE_TOO_LARGE'), (11, 'STALE_CONTROLLER_EPOCH'),
                   (12, 'OFFSET_METADATA_TOO_LARGE')) AS e(error_code, name) USING (error_code)) x
           GROUP BY part, error""",
    ),
}

_WINDOWS = {
    "fetch_budget": (
        "doclog sized_docs",
        """SELECT topic, part, off, CAST(cum AS BIGINT) AS cum_bytes,
                  CAST((cum - n_bytes) // 65536 AS BIGINT) AS fetch_id
           FROM sized_docs""",
    ),
    "batch_by_count": (
        "log numbered",
        """SELECT topic, part, CAST((rn - 1) // 100 AS BIGINT) AS batch_id, count(*) AS n, min(off) AS first_off,
                  max(off) AS last_off, CAST(sum(strlen(payload)) AS BIGINT) AS bytes
           FROM numbered GROUP BY topic, part, (rn - 1) // 100""",
    ),
    "emit_state": (
        f"{_SCAN}",
        """SELECT topic, part, off,
                  CASE WHEN off IS NULL THEN 'NO_EMITTED'
                       WHEN lead(off) OVER (PARTITION BY topic, part ORDER BY off) IS NULL THEN 'EMITTED_END'
                       ELSE 'EMITTED_MORE_LEFT' END AS state
           FROM starts LEFT JOIN scanned USING (topic, part)""",
    ),
    "send_progress": (
        f"{_SCAN} numbered_scan",
        """SELECT topic, part, batch_id,
                  start_off + CAST(sum(n) OVER (PARTITION BY topic, part ORDER BY batch_id) AS BIGINT) AS sent_to
           FROM (SELECT topic, part, CAST((rn - 1) // 100 AS BIGINT) AS batch_id, count(*) AS n
                 FROM numbered_scan GROUP BY topic, part, (rn - 1) // 100) b
           JOIN starts USING (topic, part)""",
    ),
    "idle_gaps": (
        "log",
        """SELECT topic, part, off, gap // 1000000 AS gap_seconds
           FROM (SELECT topic, part, off,
                        epoch_us(ts) - epoch_us(lag(ts) OVER (PARTITION BY topic, part ORDER BY off)) AS gap
                 FROM log) x
           WHERE gap > 14400000000""",
    ),
    "error_streaks": (
        "fetches",
        """SELECT part, min(seq) AS first_seq, max(seq) AS last_seq, count(*) AS n
           FROM (SELECT part, seq, error_code,
                        row_number() OVER (PARTITION BY part ORDER BY seq)
                        - row_number() OVER (PARTITION BY part, error_code = 0 ORDER BY seq) AS run
                 FROM fetches) x
           WHERE error_code <> 0 GROUP BY part, run HAVING count(*) > 2""",
    ),
    "leader_changes": (
        f"{_STATES} led",
        """SELECT topic, part, snap, old_leader, leader AS new_leader,
                  CASE WHEN leader IS NULL THEN 'no_leader' WHEN old_leader IS NULL THEN 'elected'
                       ELSE 'moved' END AS kind
           FROM led WHERE nth > 1 AND leader IS DISTINCT FROM old_leader""",
    ),
    "commit_cadence": (
        "log commits",
        """SELECT topic, part, time_bucket(INTERVAL 1 DAY, ts) AS win_start, arg_max(off, seq) AS off
           FROM commits GROUP BY topic, part, time_bucket(INTERVAL 1 DAY, ts)""",
    ),
}

_CHECKS = {
    "ordered_partitions": (
        f"{_STATES} brokers addresses leaders",
        """SELECT topic, part, host, port, CAST(dense_rank() OVER (ORDER BY host, port) AS INT) AS broker_rank
           FROM leaders""",
    ),
    "out_of_range": (
        "log ckpt bounds",
        """SELECT topic, part, committed, status,
                  CASE WHEN status = 'in_range' THEN committed WHEN policy = 'earliest' THEN earliest
                       ELSE latest END AS reset_off, policy
           FROM (SELECT *, CASE WHEN committed IS NULL THEN 'no_record' WHEN committed < earliest THEN 'below'
                                WHEN committed > latest THEN 'above' ELSE 'in_range' END AS status,
                        unnest(['earliest', 'latest']) AS policy
                 FROM bounds LEFT JOIN ckpt USING (topic, part)) x""",
    ),
    "offset_lag": (
        "log ckpt bounds",
        """SELECT topic, part, latest - committed AS lag, latest - committed > 300 AS too_far
           FROM bounds JOIN ckpt USING (topic, part)""",
    ),
    "inflight_offsets": (
        "log ckpt",
        """SELECT topic, part, count(*) FILTER (WHERE still_open) AS n_inflight,
                  coalesce(min(off) FILTER (WHERE still_open), max(off) + 1) AS safe_off
           FROM (SELECT topic, part, off, committed IS NULL OR off >= committed AS still_open
                 FROM log LEFT JOIN ckpt USING (topic, part)) x
           GROUP BY topic, part""",
    ),
    "mirror_batch": (
        f"{_SCAN} numbered_scan mirrored",
        "SELECT topic, part, off, new_key, value, batch_id FROM mirrored",
    ),
}

# one row per partition and trigger: bytes sent so far, level left after the trigger
_ADMITTED = """, sums AS (
  SELECT s.topic, s.part, off, strlen(payload) AS size, start_off,
         sum(strlen(payload)) OVER w AS total, row_number() OVER w AS rn
  FROM scanned s JOIN starts USING (topic, part) WINDOW w AS (PARTITION BY s.topic, s.part ORDER BY off)
), ends AS (
  SELECT topic, part, min(start_off) AS start_off, CAST(max(total) AS BIGINT) AS whole FROM sums GROUP BY topic, part
), triggers AS (
  SELECT topic, part, CAST(0 AS BIGINT) AS batch_id, CAST(0 AS BIGINT) AS sent, CAST(3000 AS BIGINT) AS level,
         CAST(0 AS BIGINT) AS took
  FROM ends
  UNION ALL
  SELECT t.topic, t.part, t.batch_id + 1, CAST(max(s.total) AS BIGINT),
         least(3000, t.level - CAST(max(s.total) - t.sent AS BIGINT) + 2250), CAST(max(s.total) - t.sent AS BIGINT)
  FROM triggers t JOIN ends e USING (topic, part)
  JOIN sums s ON s.topic = t.topic AND s.part = t.part AND s.total <= t.sent + t.level
  WHERE t.sent < e.whole
  GROUP BY t.topic, t.part, t.batch_id, t.sent, t.level
), taken AS (
  SELECT t.topic, t.part, t.batch_id - 1 AS batch_id, t.took AS bytes, t.sent - t.took AS sent_before, t.sent,
         (SELECT max(b.level) FROM triggers b WHERE b.topic = t.topic AND b.part = t.part AND b.batch_id = t.batch_id - 1) - t.took AS level
  FROM triggers t WHERE t.batch_id > 0
)
SELECT k.topic, k.part, k.batch_id, coalesce(max(p.off) + 1, min(e.start_off)) AS from_off, max(s.off) + 1 AS to_off,
       count(DISTINCT s.off) AS n, k.bytes, k.level
FROM taken k JOIN ends e USING (topic, part)
JOIN sums s ON s.topic = k.topic AND s.part = k.part AND s.total > k.sent_before AND s.total <= k.sent
LEFT JOIN sums p ON p.topic = k.topic AND p.part = k.part AND p.total = k.sent_before
GROUP BY k.topic, k.part, k.batch_id, k.bytes, k.level"""

_STREAMS = {
    "admitted_volume": (_SCAN, _ADMITTED),
    "admitted_mirror": (
        f"{_SCAN} numbered_scan mirrored",
        "SELECT topic, part, off, new_key, value FROM mirrored",
    ),
    "mirror_stream": (
        f"{_SCAN} numbered_scan mirrored",
        "SELECT topic, part, off, new_key, value FROM mirrored",
    ),
    "volume_stream": (
        "log daily",
        "SELECT topic, part, win_start, bytes, bytes > 150 AS over_limit FROM daily",
    ),
    "late_volume": (
        "log",
        """SELECT topic, part, win_start, CAST(coalesce(sum(size) FILTER (WHERE NOT late), 0) AS BIGINT) AS bytes,
                  CAST(coalesce(sum(size) FILTER (WHERE late), 0) AS BIGINT) AS late_bytes, count(*) FILTER (WHERE late) AS late_rows,
                  coalesce(sum(size) FILTER (WHERE NOT late), 0) > 150 AS over_limit, bool_and(closed) AS closed
           FROM (SELECT topic, part, win_start, size, closed, closed AND us < (low + high) // 2 AS late
                 FROM (SELECT topic, part, time_bucket(INTERVAL 1 DAY, ts) AS win_start, strlen(payload) AS size, epoch_us(ts) AS us,
                              epoch_us(time_bucket(INTERVAL 1 DAY, ts) + INTERVAL 1 DAY) <= high - 259200000000 AS closed, low, high
                       FROM log CROSS JOIN (SELECT min(epoch_us(ts)) AS low, max(epoch_us(ts)) AS high FROM log) e) x) y
           GROUP BY topic, part, win_start""",
    ),
    "replay_stream": (
        "log failed",
        """SELECT topic, part, off, payload, false AS replayed FROM log
           UNION ALL
           SELECT topic, part, off, payload, true FROM log SEMI JOIN failed USING (topic, part, off)""",
    ),
    "replay_from_log": (
        "log failed",
        """SELECT topic, part, off, payload, false AS replayed FROM log
           UNION ALL
           SELECT topic, part, off, payload, true FROM log SEMI JOIN failed USING (topic, part, off)""",
    ),
    "ordered_replay": (
        "log failed",
        """, rows AS (SELECT topic, part, off, payload, event_id > (SELECT (min(event_id) + max(event_id)) // 2 FROM log) AS second FROM log),
           emitted AS (SELECT *, false AS replayed FROM rows UNION ALL SELECT *, true FROM rows SEMI JOIN failed USING (topic, part, off))
           SELECT topic, part, off, payload, replayed,
                  row_number() OVER (PARTITION BY topic, part ORDER BY second, replayed DESC, off) AS emission
           FROM emitted""",
    ),
    "throttled_stream": (
        "log",
        """SELECT topic, part, count(*) AS n, CAST(sum(strlen(payload)) AS BIGINT) AS bytes, true AS kept_limit
           FROM log GROUP BY topic, part""",
    ),
    "idle_stream": (
        "log",
        """SELECT topic, part, min(ts) AS session_start, max(ts) + INTERVAL 240 MINUTE AS session_end, count(*) AS n
           FROM (SELECT topic, part, ts, sum(fresh) OVER (PARTITION BY topic, part ORDER BY ts, off) AS session
                 FROM (SELECT topic, part, ts, off,
                              CASE WHEN ts - lag(ts) OVER (PARTITION BY topic, part ORDER BY ts, off)
                                        < INTERVAL 240 MINUTE THEN 0 ELSE 1 END AS fresh
                       FROM log) x) y
           GROUP BY topic, part, session""",
    ),
    "metadata_refresh_stream": (
        f"{_STATES} brokers addresses leaders",
        "SELECT topic, part, off, host FROM log LEFT JOIN leaders USING (topic, part)",
    ),
}

_OPEN = "log ckpt done still_open islands"
_SETS = {
    "row_leaders": (
        "log reports brokers addresses",
        """SELECT topic, part, off, reported, leader, host
           FROM (SELECT l.topic, l.part, l.off, r.reported, r.leader
                 FROM log l ASOF LEFT JOIN reports r ON l.topic = r.topic AND l.part = r.part AND l.ts >= r.since) x
                LEFT JOIN addresses ON leader = broker_id""",
    ),
    "greedy_fetches": (
        "doclog sized_docs",
        """, chain AS (
             SELECT topic, part, off, cum - coalesce(n_bytes, 0) AS base FROM sized_docs WHERE rn = 1
             UNION ALL
             SELECT s.topic, s.part, s.off, s.cum - coalesce(s.n_bytes, 0)
             FROM (SELECT c.topic, c.part, min(d.off) AS off
                   FROM chain c JOIN sized_docs d ON c.topic = d.topic AND c.part = d.part AND d.off > c.off AND d.cum > c.base + 65536
                   GROUP BY c.topic, c.part) n JOIN sized_docs s USING (topic, part, off)),
           ends AS (SELECT topic, part, max(off) + 1 AS past, max(cum) AS total FROM sized_docs GROUP BY topic, part)
           SELECT topic, part, row_number() OVER w - 1 AS fetch_id, off AS first_off, coalesce(lead(off) OVER w, past) AS next_off,
                  CAST(coalesce(lead(base) OVER w, total) - base AS BIGINT) AS bytes
           FROM chain JOIN ends USING (topic, part) WINDOW w AS (PARTITION BY topic, part ORDER BY off)""",
    ),
    "spaced_saves": (
        "log commits",
        """, chain AS (
             SELECT topic, part, arg_min(seq, seq) AS seq, arg_min(ts, seq) AS ts FROM commits GROUP BY topic, part
             UNION ALL
             SELECT c.topic, c.part, min(d.seq), arg_min(d.ts, d.seq)
             FROM chain c JOIN commits d ON c.topic = d.topic AND c.part = d.part AND d.seq > c.seq AND d.ts >= c.ts + INTERVAL 6 HOUR
             GROUP BY c.topic, c.part)
           SELECT topic, part, seq, off, ts FROM commits SEMI JOIN chain USING (topic, part, seq)""",
    ),
    "open_ranges": (_OPEN, "SELECT topic, part, low, high FROM islands"),
    "inflight_ranges": (
        _OPEN,
        """SELECT topic, part, CAST(coalesce(n, 0) AS BIGINT) AS n_inflight, coalesce(n_ranges, 0) AS n_ranges,
                  coalesce(lowest, past) AS safe_off
           FROM (SELECT topic, part, max(off) + 1 AS past FROM log GROUP BY topic, part) e
           LEFT JOIN (SELECT topic, part, sum(high - low + 1) AS n, count(*) AS n_ranges, min(low) AS lowest
                      FROM islands GROUP BY topic, part) i USING (topic, part)""",
    ),
    "failed_and_done": (
        "log ckpt failed done",
        "SELECT f.topic, f.part, f.off, d.off IS NOT NULL AS done FROM failed f LEFT JOIN done d USING (topic, part, off)",
    ),
}

ORACLE = {
    name: with_ctes(*spec)
    for group in (_SOURCES, _ROWWISE, _JOINS, _AGGREGATES, _WINDOWS, _CHECKS, _STREAMS, _SETS)
    for name, spec in group.items()
}
