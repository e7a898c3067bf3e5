"""Parameters of the registered queries, shared by the Spark code and its SQL."""

SUBSCRIPTION = "subscriptions/events-reader"
FOREIGN_SUBSCRIPTION = "subscriptions/other-reader"
EPOCH = "2024-01-01"          # day 0 of the events log; checkpoint barrier k closes day k
CURSOR_AS_OF = "2024-01-15"   # committed cursors = last offset published before this
STOP_AS_OF = "2024-01-22"     # stop offsets of the bounded scan
CURSOR_PARTS = (1, 3, 5)      # partitions with a stored cursor in the discovery queries
KNOWN_BELOW = 3               # partitions < 3 are already known in incremental discovery
READERS = 2                   # partition p is read by reader p % 2
CRASH_AT = "2024-01-22"       # readers stop here and restart from committed cursors
COMMIT_READERS = 8            # checkpoint trace: partition p is read by reader p % 8
CHECKPOINT_IDS = 32           # a reader's checkpoint ids come again
TRACE_EPOCH = "1995-01-01"    # dates of orders and line items on the time axis of the events log:
TRACE_MINUTES = 17            # one day there is 17 minutes here
FINISHED_FROM = 6             # partitions 6 and 7 are finished ...
FINISHED_AT = "2024-01-20"    # ... at this time
FETCH_SIZE = 64
LI_EPOCH = "1995-01-01"
LI_CURSOR_AS_OF = "1998-01-01"
LI_CK_DAYS = 30               # lineitem log: one checkpoint barrier per 30 days


# DuckDB forms of the two logs (same rules as tidelog.sources.logs)
EVENTS_LOG_SQL = """
log AS (
  SELECT CAST(user_id % 8 AS INTEGER) AS part, event_id AS off, ts AS publish_time,
         CASE WHEN event_id % 5 = 0 THEN NULL ELSE ts - INTERVAL 90 SECOND END AS event_time,
         CASE WHEN event_id % 10 = 7 THEN 'bad:' || props ELSE props END AS data,
         event_type AS attr, value
  FROM events)"""

LINEITEM_LOG_SQL = """
log AS (
  SELECT CAST(l_orderkey % 16 AS INTEGER) AS part,
         row_number() OVER (PARTITION BY l_orderkey % 16
                            ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_shipdate) - 1 AS off,
         l_shipdate AS publish_time, CAST(NULL AS TIMESTAMP) AS event_time,
         '{"k": ' || CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) || '}' AS data,
         l_returnflag || l_linestatus AS attr, l_extendedprice AS value
  FROM lineitem)"""

# Checkpoint trace of the orders: each order adds a checkpoint to its customer's reader, which is reported
# complete when the order's last item is shipped (some before they were added).  ``fold`` replays the events of
# a reader in order: i events done, the open checkpoints, and what the last completion committed.
TRACE_SQL = f"""
ev AS MATERIALIZED (
  SELECT o_custkey % {COMMIT_READERS} AS reader, o_orderkey % {CHECKPOINT_IDS} AS ck, 0 AS kind, o_orderkey AS a, 0 AS b,
         TIMESTAMP '{EPOCH}' + (CAST(o_orderdate AS DATE) - DATE '{TRACE_EPOCH}') * INTERVAL {TRACE_MINUTES} MINUTE AS t FROM orders
  UNION ALL
  SELECT o_custkey % {COMMIT_READERS}, o_orderkey % {CHECKPOINT_IDS}, 1, o_orderkey % {CHECKPOINT_IDS}, o_orderkey,
         TIMESTAMP '{EPOCH}' + (CAST(m AS DATE) - DATE '{TRACE_EPOCH}') * INTERVAL {TRACE_MINUTES} MINUTE
  FROM orders JOIN (SELECT l_orderkey, max(l_shipdate) AS m FROM lineitem GROUP BY 1) ON l_orderkey = o_orderkey),
lists AS MATERIALIZED (
  SELECT reader, list({{'ck': ck, 't': t, 'kind': kind, 'a': a, 'b': b}} ORDER BY t, kind, a, b) AS es FROM ev GROUP BY reader),
fold AS (
  SELECT reader, 0::BIGINT AS i, CAST([] AS STRUCT(ck BIGINT, t TIMESTAMP, seq BIGINT)[]) AS pending,
         CAST(NULL AS STRUCT(ck BIGINT, t TIMESTAMP, seq BIGINT)) AS hit FROM lists
  UNION ALL
  SELECT reader, i + 1,
         CASE WHEN e.kind = 1 THEN CASE WHEN pos IS NULL THEN pending ELSE pending[pos + 1:] END
              WHEN pos IS NULL THEN list_append(pending, {{'ck': e.ck, 't': e.t, 'seq': e.a}})
              ELSE pending[:pos - 1] || [{{'ck': e.ck, 't': e.t, 'seq': e.a}}] || pending[pos + 1:] END,
         CASE WHEN e.kind = 1 THEN pending[pos] END
  FROM (SELECT f.reader, f.i, f.pending, l.es[f.i + 1] AS e, list_position([x.ck for x in f.pending], l.es[f.i + 1].ck) AS pos
        FROM fold f JOIN lists l ON l.reader = f.reader WHERE f.i < len(l.es))),
commits AS MATERIALIZED (
  SELECT reader, i, e.ck AS ck, e.t AS notified_at, e.b AS note, hit IS NOT NULL AS effective, hit.t AS added_at
  FROM (SELECT f.reader, f.i, f.hit, l.es[f.i] AS e FROM fold f JOIN lists l USING (reader) WHERE f.i > 0) WHERE e.kind = 1)"""

# decoded "k" of a payload, null when the payload is not JSON
K_SQL = "CASE WHEN json_valid(data) THEN TRY_CAST(json_extract_string(data, '$.k') AS BIGINT) END"
