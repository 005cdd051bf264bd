"""DuckDB SQL for the queries, written from the definitions, not from the Spark code."""

from __future__ import annotations

from checks import views as V
from spanledger.schemas import TABLES

VERSION = 1_000_000_000_000
TX_COLUMNS = "block_number, transaction_index, gas_limit, gas_used, value_f64, input"

STATE = f"range_state AS ({V.duck(V.RANGE_STATE)})"
LATEST = """latest AS (
  SELECT dataset, start_block, end_block,
         last(status ORDER BY created_at, insert_version) AS status,
         last(worker_id ORDER BY created_at, insert_version) AS worker_id,
         last(attempt_count ORDER BY created_at, insert_version) AS attempt_count,
         max(created_at) AS created_at,
         last(completed_at ORDER BY created_at, insert_version)
           FILTER (WHERE completed_at IS NOT NULL) AS completed_at,
         last(rows_indexed ORDER BY created_at, insert_version)
           FILTER (WHERE rows_indexed IS NOT NULL) AS rows_indexed,
         last(error_message ORDER BY created_at, insert_version)
           FILTER (WHERE error_message IS NOT NULL) AS error_message,
         last(insert_version ORDER BY created_at, insert_version) AS insert_version
  FROM range_state GROUP BY dataset, start_block, end_block)"""
LAST_EVENT = """last_event AS (
  SELECT * FROM range_state QUALIFY row_number() OVER (
    PARTITION BY dataset, start_block, end_block ORDER BY created_at DESC, insert_version DESC) = 1)"""
BLOCKS = f"blocks AS ({V.duck(V.BLOCKS)})"
DEFECTS = f"blocks AS ({V.duck(V.BLOCKS_WITH_DEFECTS)})"
EVENT_BLOCKS = f"blocks AS ({V.duck(V.EVENT_BLOCKS)})"
TXS = f"txs AS ({V.duck(V.TXS)})"
NEWEST = """newest AS (SELECT * FROM txs QUALIFY row_number() OVER (
    PARTITION BY block_number, transaction_index ORDER BY seen_at DESC, gas_limit DESC,
    gas_used DESC, l_quantity DESC, value_f64 DESC, l_discount DESC) = 1)"""
USABLE = "coalesce(timestamp > 31536000, false)"
STAMP = "make_timestamp(timestamp * 1000000)"
DATASETS = ", ".join(f"'{d}'" for d in V.DATASETS)


def _with(*parts: str) -> str:
    return "WITH " + ",\n".join(parts) + "\n"


def _status(total: str) -> str:
    return f"""CASE WHEN {total} = 0 THEN 'no_data' WHEN completed_ranges = {total} THEN 'complete'
      WHEN processing_ranges > 0 THEN 'in_progress'
      WHEN failed_ranges > 0 AND pending_ranges = 0 THEN 'failed'
      WHEN pending_ranges > 0 THEN 'pending' ELSE 'mixed' END AS overall_status"""


COUNTS = """count(*) AS total_ranges,
  count(*) FILTER (WHERE status = 'completed') AS completed_ranges,
  count(*) FILTER (WHERE status = 'processing') AS processing_ranges,
  count(*) FILTER (WHERE status = 'failed') AS failed_ranges,
  count(*) FILTER (WHERE status = 'pending') AS pending_ranges"""
PROGRESS = f"""progress AS (
  SELECT *, round(completed_ranges / total_ranges * 100, 2) AS completion_percentage,
         {_status('total_ranges')}
  FROM (SELECT dataset, {COUNTS},
               min(start_block) AS lowest_block_attempted, max(end_block) AS highest_block_attempted,
               coalesce(max(end_block) FILTER (WHERE status = 'completed'), 0) AS highest_block_completed,
               CAST(sum(rows_indexed) AS BIGINT) AS total_rows_indexed,
               min(created_at) AS first_attempt, max(completed_at) AS last_completion
        FROM latest GROUP BY dataset))"""
RUNS = """runs AS (
  SELECT dataset, min(start_block) AS continuous_start, max(end_block) AS continuous_end,
         count(*) AS num_segments
  FROM (SELECT dataset, start_block, end_block,
               start_block - sum(end_block - start_block) OVER (
                 PARTITION BY dataset ORDER BY start_block, end_block ROWS UNBOUNDED PRECEDING) AS k
        FROM latest WHERE status = 'completed')
  GROUP BY dataset, k)"""
HISTORY = f"""history AS (
  SELECT *, completed_ranges / total_ranges * 100 AS completion_percentage,
         {_status('(completed_ranges + processing_ranges + failed_ranges + pending_ranges)')}
  FROM (SELECT dataset, {COUNTS}, coalesce(max(end_block), 0) AS highest_attempted_block,
               coalesce(max(end_block) FILTER (WHERE status = 'completed'), 0) AS highest_completed_block,
               CAST(coalesce(sum(rows_indexed), 0) AS BIGINT) AS total_rows_indexed
        FROM range_state GROUP BY dataset))"""


def _gaps(events: str, lo: str, hi: str, min_gap: int) -> str:
    """Gaps per dataset over `events`; lo and hi are expressions over `highest`."""
    return f"""ev AS (SELECT dataset, start_block, end_block, status FROM {events}),
  win AS (SELECT dataset, CASE WHEN dataset LIKE '%_diffs' AND lo0 = 0 THEN 1000 ELSE lo0 END AS lo, hi
          FROM (SELECT dataset, {lo} AS lo0, {hi} AS hi
                FROM (SELECT dataset, max(end_block) AS highest FROM ev GROUP BY dataset))
          WHERE hi > CASE WHEN dataset LIKE '%_diffs' AND lo0 = 0 THEN 1000 ELSE lo0 END),
  done AS (SELECT DISTINCT e.dataset, start_block, end_block, lo, hi FROM ev e JOIN win USING (dataset)
           WHERE status = 'completed' AND start_block >= lo AND end_block <= hi),
  holes AS (SELECT dataset, greatest(lo, max(end_block) OVER (PARTITION BY dataset
                     ORDER BY start_block, end_block ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))
                     AS gap_start, start_block AS gap_end FROM done),
  cur AS (SELECT w.dataset, w.hi, greatest(w.lo, coalesce(max(d.end_block), w.lo)) AS cur
          FROM win w LEFT JOIN done d ON w.dataset = d.dataset GROUP BY w.dataset, w.lo, w.hi),
  tails AS (SELECT c.dataset, c.cur AS gap_start, least(c.hi, coalesce(min(e.start_block), c.hi)) AS gap_end
            FROM cur c LEFT JOIN ev e ON e.dataset = c.dataset AND e.status = 'processing'
              AND e.end_block > c.cur AND e.start_block < c.hi
            GROUP BY c.dataset, c.cur, c.hi),
  broken AS (SELECT DISTINCT e.dataset, start_block AS gap_start, end_block AS gap_end
             FROM ev e JOIN win USING (dataset)
             WHERE status = 'failed' AND start_block >= lo AND end_block <= hi),
  gaps AS (SELECT DISTINCT g.* FROM (SELECT * FROM holes UNION ALL SELECT * FROM tails
                                     UNION ALL SELECT * FROM broken) g
           WHERE gap_end > gap_start AND gap_end - gap_start >= {min_gap}
             AND NOT (g.dataset LIKE '%_diffs' AND gap_start = 0)
             AND NOT EXISTS (SELECT 1 FROM ev e WHERE e.dataset = g.dataset AND e.status = 'completed'
                             AND e.start_block = gap_start AND e.end_block = gap_end))"""


GAPS = _gaps("range_state", "0", "highest", 100)
ZERO_ROWS = """zero_rows AS (
  SELECT dataset, start_block, end_block FROM last_event
  WHERE status = 'completed' AND coalesce(rows_indexed, 0) = 0
    AND dataset IN ('blocks', 'transactions', 'logs', 'traces'))"""
NOT_COMPLETED = """not_completed AS (
  SELECT dataset, start_block, end_block FROM latest
  WHERE status <> 'completed' AND NOT (dataset LIKE '%_diffs' AND start_block = 0))"""
PIECES = """pieces AS (
  SELECT dataset, s AS start_block, least(s + 100, gap_end) AS end_block
  FROM (SELECT dataset, gap_end, unnest(range(gap_start, gap_end, 100)) AS s FROM gaps))"""
GATE = f"""gate AS (
  SELECT start_block, end_block, end_block - start_block AS expected, valid, present,
         valid >= end_block - start_block AS ok,
         CASE WHEN valid >= end_block - start_block THEN 'ok'
              WHEN present >= end_block - start_block THEN 'invalid' ELSE 'not_visible' END AS reason
  FROM (SELECT r.start_block, r.end_block,
               count(DISTINCT b.block_number) AS present,
               count(DISTINCT b.block_number) FILTER (WHERE {USABLE}) AS valid
        FROM ranges r LEFT JOIN blocks b
          ON b.block_number >= r.start_block AND b.block_number < r.end_block
        GROUP BY r.start_block, r.end_block))"""


def _ranges(end: str, batch: int) -> str:
    return f"""ranges AS (SELECT s AS start_block, least(s + {batch}, e) AS end_block
  FROM (SELECT e, unnest(range(0, e, {batch})) AS s FROM (SELECT {end} AS e)))"""


BLOCK_RANGES = _ranges("(SELECT max(block_number) + 1 FROM blocks)", 100)
SPANS = """ranges AS (SELECT DISTINCT min(o_orderkey) AS start_block, max(o_orderkey) AS end_block
  FROM orders GROUP BY o_custkey)"""


def _state_row(status: str, **values: str) -> str:
    """Select list of a state row around dataset, start_block, end_block."""
    row = {
        "status": f"'{status}'", "worker_id": "''", "attempt_count": "0",
        "created_at": f"TIMESTAMP '{V.AS_OF}'", "error_message": "CAST(NULL AS VARCHAR)",
        "insert_version": f"CAST({VERSION} AS BIGINT)",
    } | values
    return "dataset, start_block, end_block, " + ", ".join(f"{v} AS {k}" for k, v in row.items())


# Outcome of loading `ranges` of blocks and transactions: state and rows.
WITHDRAWN = """withdrawn AS (SELECT block_number FROM blocks
  WHERE withdrawals LIKE '[{%' AND coalesce(timestamp > 31536000, false))"""
OUTCOME = """outcome AS (
  SELECT 'blocks' AS dataset, g.*,
         (SELECT count(*) FROM blocks b WHERE b.block_number >= g.start_block AND b.block_number < g.end_block)
         + (SELECT count(*) FROM withdrawn w WHERE w.block_number >= g.start_block AND w.block_number < g.end_block)
         AS n FROM gate g
  UNION ALL
  SELECT 'transactions', g.*,
         (SELECT count(*) FROM newest t WHERE t.block_number >= g.start_block AND t.block_number < g.end_block)
  FROM gate g)"""
LOADED = f"""loaded AS (
  SELECT dataset, start_block, end_block,
         CASE WHEN ok THEN 'completed' ELSE 'failed' END AS status, '' AS worker_id,
         CASE WHEN ok THEN 0 ELSE 1 END AS attempt_count,
         TIMESTAMP '{V.AS_OF}' AS created_at,
         CASE WHEN ok THEN TIMESTAMP '{V.AS_OF}' END AS completed_at,
         CASE WHEN ok THEN n END AS rows_indexed,
         CASE WHEN NOT ok THEN concat(CASE WHEN dataset = 'blocks' THEN '' ELSE 'Skipped: ' END,
           'Block timestamps unusable (', reason, '): ', valid, '/', expected, ' valid, ', present,
           ' present') END AS error_message
  FROM outcome)"""
LOAD = (DEFECTS, TXS, NEWEST, BLOCK_RANGES, GATE, WITHDRAWN, OUTCOME, LOADED)
CONFIRMED_RANGES = """ranges AS (SELECT s AS start_block, s + 100 AS end_block
  FROM (SELECT unnest(range(0, (SELECT (max(o_orderkey) - 12) // 100 * 100 FROM orders), 100)) AS s))"""
STREAM = (DEFECTS, TXS, NEWEST, CONFIRMED_RANGES, GATE, WITHDRAWN, OUTCOME, LOADED)
LOADED_ROWS = f"""SELECT t.block_number, transaction_index, gas_limit, t.gas_used, value_f64, input,
  make_timestamp(b.timestamp * 1000000) AS block_timestamp
FROM newest t JOIN blocks b ON t.block_number = b.block_number
JOIN loaded l ON l.dataset = 'transactions' AND l.status = 'completed'
  AND t.block_number >= l.start_block AND t.block_number < l.end_block"""
# After the repair from complete blocks every range is completed.
REPAIRED = _with(BLOCKS, TXS, NEWEST, BLOCK_RANGES, GATE, WITHDRAWN, OUTCOME) + (
    "SELECT dataset, start_block, end_block, 'completed' AS status, n AS rows_indexed FROM outcome"
)

# Loads in which some values do not fit their column: those ranges store nothing of their dataset.
BAD_BLOCKS = f"""every AS ({V.duck(V.BLOCKS)}),
broken AS (SELECT r.start_block, count(*) AS n FROM ranges r JOIN every e
  ON e.block_number >= r.start_block AND e.block_number < r.end_block
  WHERE e.block_number % 977 = 3 GROUP BY r.start_block),
blocks AS (SELECT e.* FROM every e JOIN ranges r
  ON e.block_number >= r.start_block AND e.block_number < r.end_block
  WHERE r.start_block NOT IN (SELECT start_block FROM broken)),
unfit AS (SELECT r.start_block, count(*) AS n FROM ranges r JOIN newest t
  ON t.block_number >= r.start_block AND t.block_number < r.end_block
  WHERE t.block_number % 883 = 5 GROUP BY r.start_block)"""
BAD_LOADED = """loaded AS (
  SELECT dataset, o.start_block, o.end_block,
    CASE WHEN ok AND (dataset = 'blocks' OR u.n IS NULL) THEN 'completed' ELSE 'failed' END AS status,
    CASE WHEN ok AND (dataset = 'blocks' OR u.n IS NULL) THEN 0 ELSE 1 END AS attempt_count,
    CASE WHEN ok AND (dataset = 'blocks' OR u.n IS NULL) THEN o.n END AS rows_indexed,
    CASE WHEN dataset = 'blocks' AND b.n IS NOT NULL THEN concat(b.n, ' rows rejected, such as: gas_used is no bigint: many')
         WHEN NOT ok THEN concat(CASE WHEN dataset = 'blocks' THEN '' ELSE 'Skipped: ' END,
           'Block timestamps unusable (', reason, '): ', valid, '/', expected, ' valid, ', present, ' present')
         WHEN dataset <> 'blocks' AND u.n IS NOT NULL THEN concat(u.n, ' rows rejected, such as: gas_limit is no bigint: lots')
         END AS error_message
  FROM outcome o LEFT JOIN broken b ON b.start_block = o.start_block LEFT JOIN unfit u ON u.start_block = o.start_block)"""
ALL_RANGES = _ranges("(SELECT max(o_orderkey) + 1 FROM orders)", 100)
BAD_LOAD = (TXS, NEWEST, ALL_RANGES, BAD_BLOCKS, GATE, WITHDRAWN, OUTCOME, BAD_LOADED)
BAD_STREAM = (TXS, NEWEST, CONFIRMED_RANGES, BAD_BLOCKS, GATE, WITHDRAWN, OUTCOME, BAD_LOADED)

_KINDS = "'BIGINT', 'bigint'), ('INTEGER', 'int'), ('DOUBLE', 'double'), ('VARCHAR', 'string'), ('TIMESTAMP', 'timestamp'"
_FILLED = "block_number transaction_index gas_limit gas_used value_f64 input l_quantity l_discount seen_at".split()
SCHEMA_CONTRACT = (
    _with(TXS)
    + """, rows AS (SELECT * REPLACE (CAST(gas_used AS VARCHAR) AS gas_used) FROM txs),
kinds(duck, spark) AS (VALUES ("""
    + _KINDS
    + """)),
have AS (SELECT column_name AS name, spark AS actual FROM (DESCRIBE SELECT * FROM rows) JOIN kinds ON duck = column_type),
want(name, expected) AS (VALUES """
    + ", ".join(f"('{f.name}', '{f.dataType.simpleString()}')" for f in TABLES["transactions"].schema.fields)
    + """),
filled AS ("""
    + " UNION ALL ".join(f"SELECT '{c}' AS name, count({c}) AS n FROM rows" for c in _FILLED)
    + """)
SELECT name, expected, actual, CASE WHEN actual IS NULL THEN 'missing' WHEN expected IS NULL THEN 'extra'
  WHEN actual = expected THEN 'ok' ELSE 'type_differs' END AS verdict, coalesce(n, 0) AS n_filled
FROM want FULL JOIN have USING (name) LEFT JOIN filled USING (name)"""
)

EVENT_STORE = (
    EVENT_BLOCKS,
    f"raw AS ({V.duck(V.WITHDRAWALS)})",
    """elements AS (
  SELECT block_number, block_hash, withdrawals_root, chain_id, timestamp,
         unnest(from_json(withdrawals, '["json"]')) AS e
  FROM raw WHERE json_type(withdrawals) = 'ARRAY' AND coalesce(timestamp > 31536000, false))""",
    f"""withdrawn AS (
  SELECT block_number, block_hash, withdrawals_root, e->>'$.index' AS withdrawal_index,
         e->>'$.validatorIndex' AS validator_index, e->>'$.address' AS address,
         e->>'$.amount' AS amount, chain_id, {STAMP} AS block_timestamp
  FROM elements WHERE json_type(e) = 'OBJECT')""",
    """stored AS (
  SELECT block_number, block_hash, make_timestamp(timestamp * 1000000) AS second_of,
         block_timestamp, 'blocks' AS table_name FROM blocks
  UNION ALL SELECT block_number, block_hash, block_timestamp, block_timestamp, 'withdrawals' FROM withdrawn)""",
)
STORED_ROWS = """SELECT block_number, block_hash, block_timestamp,
  CAST(strftime(block_timestamp, '%Y%m%d') AS INTEGER) AS part_day,
  CAST(1 AS BIGINT) AS insert_version, count(*) AS n_rows, table_name
FROM stored WHERE {where} GROUP BY ALL"""

ORACLES = {
    "read_dataset": """SELECT l_returnflag, l_linestatus, count(*) AS n_rows,
  CAST(sum(l_orderkey) AS BIGINT) AS sum_orderkey FROM lineitem GROUP BY ALL""",
    "route_by_filename": " UNION ALL ".join(
        f"SELECT '{name}' AS dataset, count(*) AS n_rows FROM {name}" for name in V.TABLES),
    "slice_range": """SELECT event_id, user_id, event_type FROM events
WHERE event_id >= (SELECT max(event_id) // 4 FROM events)
  AND event_id < 3 * (SELECT max(event_id) // 4 FROM events)""",
    "project_dataset": """SELECT l_orderkey AS block_number, l_linenumber AS log_index,
  l_returnflag AS topic0, l_linestatus AS topic1, l_partkey AS n_data_bytes FROM lineitem""",
    "head_block": "SELECT max(event_id) AS head_block FROM events",
    "clean_documents": """SELECT doc_id,
  CASE WHEN NOT regexp_full_match(text, '\\s*') THEN text END AS text,
  CASE WHEN lang <> 'en' THEN lang END AS lang,
  CASE WHEN source <> 'src5' THEN CAST(n_chars AS DOUBLE) END AS n_chars FROM documents""",
    "hex_pages": """SELECT page_id,
  CASE WHEN length(html) > 0 THEN lower(hex(encode(html))) END AS html,
  CASE WHEN length(url) <= 30 AND length(url) > 0 THEN lower(hex(encode(url))) END AS url FROM pages""",
    "clean_blocks": _with(BLOCKS) + "SELECT block_number, block_hash, timestamp FROM blocks",
    "conform_schema": _with(TXS) + f"SELECT {TX_COLUMNS}, CAST(NULL AS VARCHAR) AS to_address FROM txs",
    "usable_timestamps": _with(DEFECTS) + f"""SELECT block_number, {USABLE} AS usable,
  CASE WHEN {USABLE} THEN {STAMP} END AS block_timestamp FROM blocks""",
    "latest_txs": _with(TXS, NEWEST) + f"SELECT {TX_COLUMNS} FROM newest",
    "latest_state": _with(STATE, LATEST)
    + "SELECT * REPLACE (coalesce(rows_indexed, -1) AS rows_indexed) FROM latest",
    "range_status": _with(STATE, LATEST) + """SELECT dataset, start_block, end_block, status FROM latest
WHERE dataset = 'transactions' AND start_block = 10000 AND end_block = 10100""",
    "enrich_strict": _with(TXS, BLOCKS) + """SELECT t.block_number, transaction_index, gas_limit,
  t.gas_used, value_f64, input, l_quantity, make_timestamp(b.timestamp * 1000000) AS block_timestamp
FROM txs t JOIN blocks b ON t.block_number = b.block_number""",
    "missing_parents": _with(TXS, DEFECTS) + f"""SELECT DISTINCT block_number FROM txs
WHERE block_number NOT IN (SELECT block_number FROM blocks WHERE {USABLE})""",
    "rejected_rows": _with(TXS, DEFECTS) + f"""SELECT {TX_COLUMNS}, l_quantity, 'null_timestamp' AS reason
FROM txs WHERE block_number NOT IN (SELECT block_number FROM blocks WHERE {USABLE})""",
    "validate_rows": _with(EVENT_BLOCKS) + "SELECT block_number, block_timestamp FROM blocks",
    "explode_withdrawals": _with(*EVENT_STORE) + "SELECT * FROM withdrawn",
    "load_blocks": _with(BLOCKS, WITHDRAWN) + """SELECT block_number // 100 * 100 AS start_block,
  block_number // 100 * 100 + 100 AS end_block, count(*) AS rows_indexed
FROM (SELECT block_number FROM blocks UNION ALL SELECT block_number FROM withdrawn) GROUP BY ALL""",
    "progress": _with(STATE, LATEST, PROGRESS) + "SELECT * FROM progress",
    "history_summary": _with(STATE, HISTORY) + "SELECT * FROM history",
    "highest_attempted": _with(STATE) + """SELECT dataset, max(end_block) AS highest_attempted
FROM range_state GROUP BY dataset""",
    "last_synced": _with(STATE) + """SELECT coalesce(min(m), 0) AS last_synced_block
FROM (SELECT max(end_block) AS m FROM range_state WHERE status = 'completed' GROUP BY dataset)""",
    "non_completed_ranges": _with(STATE, LATEST, NOT_COMPLETED) + "SELECT * FROM not_completed",
    "continuous_ranges": _with(STATE, LATEST, RUNS) + """SELECT dataset, continuous_start, continuous_end,
  num_segments, continuous_end - continuous_start AS total_blocks,
  concat(continuous_start, '-', continuous_end) AS range_description,
  round(num_segments * CAST(100 AS DOUBLE) / (continuous_end - continuous_start) * 100, 2) AS coverage_percentage,
  CASE WHEN num_segments = (continuous_end - continuous_start) / 100 THEN 'complete'
       WHEN num_segments < (continuous_end - continuous_start) / 100 THEN 'has_gaps'
       ELSE 'overlapping' END AS continuity_status FROM runs""",
    "coverage_segments": _with(STATE, LATEST) + """, done AS (
  SELECT *, max(end_block) OVER (PARTITION BY dataset ORDER BY start_block, end_block
            ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach
  FROM latest WHERE status = 'completed'),
marked AS (SELECT *, sum(CASE WHEN reach IS NULL OR start_block > reach THEN 1 ELSE 0 END)
  OVER (PARTITION BY dataset ORDER BY start_block, end_block) AS g FROM done)
SELECT dataset, min(start_block) AS segment_start, max(end_block) AS segment_end,
  max(end_block) - min(start_block) AS covered_blocks FROM marked GROUP BY dataset, g""",
    "range_summary": _with(STATE, LATEST, PROGRESS, RUNS) + """SELECT p.dataset, total_ranges, completed_ranges,
  processing_ranges, failed_ranges, pending_ranges, completion_percentage, overall_status,
  highest_block_completed, total_rows_indexed, count(r.continuous_start) AS continuous_segments,
  min(continuous_start) AS first_continuous_block, max(continuous_end) AS last_continuous_block,
  CASE WHEN count(r.continuous_start) = 1 THEN 'fully_continuous'
       WHEN count(r.continuous_start) > 1 THEN concat('fragmented_', count(r.continuous_start), '_segments')
       ELSE 'no_completed_data' END AS continuity_description
FROM progress p LEFT JOIN runs r ON p.dataset = r.dataset
GROUP BY p.dataset, total_ranges, completed_ranges, processing_ranges, failed_ranges, pending_ranges,
  completion_percentage, overall_status, highest_block_completed, total_rows_indexed""",
    "find_gaps": _with(STATE, GAPS) + "SELECT * FROM gaps",
    "find_gaps_window": _with(STATE, _gaps(
        "range_state", "(SELECT max(end_block) // 4 FROM range_state)",
        "least((SELECT max(end_block) // 2 FROM range_state), highest)", 10)) + "SELECT * FROM gaps",
    "find_gaps_latest": _with(STATE, LATEST, _gaps("latest", "0", "highest", 100)) + "SELECT * FROM gaps",
    "block_islands": """SELECT min(n) AS start_block, max(n) + 1 AS end_block
FROM (SELECT n, n - row_number() OVER (ORDER BY n) AS k
      FROM (SELECT DISTINCT event_id AS n FROM events WHERE event_type <> 'error')) GROUP BY k""",
    "validate_timestamps": _with(DEFECTS, BLOCK_RANGES, GATE) + "SELECT * FROM gate",
    "validate_uneven_ranges": _with(DEFECTS, SPANS, GATE) + "SELECT * FROM gate",
    "presence_gate": _with(DEFECTS, BLOCK_RANGES, GATE) + "SELECT * FROM gate",
    "presence_recheck": _with(DEFECTS, SPANS, GATE) + "SELECT * FROM gate",
    "presence_islands": _with(DEFECTS) + f"""SELECT min(n) AS start_block, max(n) + 1 AS end_block
FROM (SELECT n, n - row_number() OVER (ORDER BY n) AS k
      FROM (SELECT block_number AS n FROM blocks WHERE {USABLE} AND block_number % 1000 >= 150)) GROUP BY k""",
    "sample_bad_blocks": _with(DEFECTS) + f"""SELECT block_number, timestamp, {STAMP} AS formatted_timestamp
FROM blocks WHERE block_number >= (SELECT max(block_number) // 2 FROM blocks)
  AND block_number < (SELECT max(block_number) // 2 + 100 FROM blocks) ORDER BY block_number LIMIT 5""",
    "zero_row_ranges": _with(STATE, LAST_EVENT, ZERO_ROWS) + "SELECT * FROM zero_rows",
    "validate_report": _with(STATE, HISTORY, GAPS) + """SELECT h.*, coalesce(gap_count, 0) AS gap_count,
  coalesce(gap_blocks, 0) AS gap_blocks, failed_ranges = 0 AND processing_ranges = 0 AS healthy
FROM history h LEFT JOIN (SELECT dataset, count(*) AS gap_count,
  CAST(sum(gap_end - gap_start) AS BIGINT) AS gap_blocks FROM gaps GROUP BY dataset) g USING (dataset)""",
    "validate_report_window": _with(STATE, HISTORY, _gaps("range_state", "1000", "highest", 100)) + """
SELECT h.*, coalesce(gap_count, 0) AS gap_count, coalesce(gap_blocks, 0) AS gap_blocks,
  coalesce(gap_count, 0) = 0 AS healthy
FROM history h LEFT JOIN (SELECT dataset, count(*) AS gap_count,
  CAST(sum(gap_end - gap_start) AS BIGINT) AS gap_blocks FROM gaps GROUP BY dataset) g USING (dataset)""",
    "stuck_ranges": _with(STATE, LAST_EVENT) + f"""SELECT dataset, start_block, end_block, status, worker_id,
  created_at FROM last_event WHERE status = 'processing'
  AND created_at < TIMESTAMP '{V.AS_OF}' - INTERVAL 720 HOUR""",
    "recover_stuck": _with(STATE, LAST_EVENT) + f"""SELECT {_state_row('failed', attempt_count='1',
  error_message="concat('Auto-recovered: stuck processing since ', strftime(created_at, '%Y-%m-%d %H:%M:%S'))")}
FROM last_event WHERE status = 'processing' AND created_at < TIMESTAMP '{V.AS_OF}' - INTERVAL 720 HOUR""",
    "claim_ranges": _with(STATE, LATEST) + f"""SELECT {_state_row('processing', worker_id="'w1'")}
FROM (SELECT unnest([{DATASETS}]) AS dataset, c_custkey * 100 AS start_block,
             c_custkey * 100 + 100 AS end_block FROM customer) w
WHERE NOT EXISTS (SELECT 1 FROM latest l WHERE l.dataset = w.dataset AND l.start_block = w.start_block
  AND l.end_block = w.end_block AND l.status IN ('completed', 'processing'))""",
    "complete_ranges": _with(_ranges("(SELECT max(l_orderkey) + 1 FROM lineitem)", 100)) + f"""
SELECT {_state_row('completed', completed_at=f"TIMESTAMP '{V.AS_OF}'", rows_indexed="n")}
FROM (SELECT 'transactions' AS dataset, start_block, end_block, count(l_orderkey) AS n
      FROM ranges LEFT JOIN lineitem ON l_orderkey >= start_block AND l_orderkey < end_block GROUP BY ALL)""",
    "fail_ranges": _with(STATE, LATEST) + f"""SELECT {_state_row('failed', attempt_count="attempts + 1",
  error_message="substring(repeat(concat(dataset, ' broke; '), 50), 1, 500)")}
FROM (SELECT dataset, start_block, end_block FROM latest WHERE status = 'processing')
JOIN (SELECT dataset, start_block, end_block, max(attempt_count) AS attempts
      FROM range_state GROUP BY ALL) USING (dataset, start_block, end_block)""",
    "fail_dependents": _with(STATE, LATEST, DEFECTS, BLOCK_RANGES, GATE) + f"""
SELECT {_state_row('failed', attempt_count="coalesce(attempts, 0) + 1", error_message="message")}
FROM (SELECT dataset, CASE WHEN start_block = 0 AND dataset LIKE '%_diffs' THEN 1 ELSE start_block END
             AS start_block, end_block, message
      FROM (SELECT unnest(['transactions', 'logs', 'balance_diffs', 'contracts']) AS dataset, start_block,
                   end_block, concat('Skipped: ', reason) AS message FROM gate WHERE NOT ok)) w
LEFT JOIN (SELECT dataset, start_block, end_block, max(attempt_count) AS attempts
           FROM range_state GROUP BY ALL) a USING (dataset, start_block, end_block)
WHERE NOT EXISTS (SELECT 1 FROM latest l WHERE l.dataset = w.dataset AND l.start_block = w.start_block
  AND l.end_block = w.end_block AND l.status = 'completed')""",
    "mark_reprocess": _with(STATE, LAST_EVENT, ZERO_ROWS) + f"""SELECT {_state_row('failed',
  attempt_count='1', error_message="'Auto-maintain: zero rows detected, marked for reprocess'")} FROM zero_rows""",
    "split_ranges": """SELECT o_custkey, dataset, s AS start_block, least(s + 1000, e) AS end_block
FROM (SELECT o_custkey, dataset, e, unnest(range(f, e, 1000)) AS s
      FROM (SELECT o_custkey, 'blocks' AS dataset, min(o_orderkey) AS f, max(o_orderkey) AS e
            FROM orders GROUP BY o_custkey
            UNION ALL SELECT o_custkey, 'nonce_diffs', greatest(min(o_orderkey), 1), max(o_orderkey)
            FROM orders GROUP BY o_custkey))""",
    "align_start": """SELECT o_orderkey, CAST(ceil(o_orderkey / 100) AS BIGINT) * 100 AS aligned_start
FROM orders""",
    "safe_ranges": """SELECT s AS start_block, s + 100 AS end_block
FROM (SELECT unnest(range(200, (SELECT max(event_id) - 12 FROM events), 100)) AS s)
WHERE s + 100 <= (SELECT max(event_id) - 12 FROM events)""",
    "confirmed_blocks": _with(EVENT_BLOCKS) + """SELECT block_number, block_hash FROM blocks
WHERE block_number <= (SELECT max(event_id) - 12 FROM events)""",
    "repair_plan_maintain": _with(STATE, LATEST, NOT_COMPLETED, GAPS, PIECES) + """
SELECT dataset, start_block, end_block, CASE WHEN min(why) = 0 THEN 'not_completed' ELSE 'gap' END AS reason,
  CASE WHEN dataset = 'blocks' THEN 0 ELSE 1 END AS load_order
FROM (SELECT *, 0 AS why FROM not_completed UNION ALL SELECT *, 1 FROM pieces)
GROUP BY dataset, start_block, end_block""",
    "repair_plan_auto": _with(STATE, LATEST, LAST_EVENT, ZERO_ROWS, _gaps(
        "range_state", "greatest(highest - 72000, 0) // 100 * 100", "highest", 100), PIECES) + """
SELECT dataset, start_block, end_block,
  CASE min(why) WHEN 1 THEN 'gap' WHEN 2 THEN 'failed' ELSE 'zero_rows' END AS reason,
  CASE WHEN dataset = 'blocks' THEN 0 ELSE 1 END AS load_order
FROM (SELECT *, 1 AS why FROM pieces
      UNION ALL SELECT l.dataset, start_block, end_block, 2 FROM latest l
        JOIN (SELECT dataset, greatest(max(end_block) - 72000, 0) // 100 * 100 AS lo
              FROM range_state GROUP BY dataset) w ON w.dataset = l.dataset
        WHERE status = 'failed' AND start_block >= lo
      UNION ALL SELECT z.dataset, start_block, end_block, 3 FROM zero_rows z
        JOIN (SELECT dataset, greatest(max(end_block) - 72000, 0) // 100 * 100 AS lo
              FROM range_state GROUP BY dataset) w ON w.dataset = z.dataset WHERE start_block >= lo) c
WHERE NOT EXISTS (SELECT 1 FROM latest p WHERE p.dataset = c.dataset AND p.status = 'processing'
  AND p.start_block < c.end_block AND p.end_block > c.start_block)
GROUP BY dataset, start_block, end_block""",
    "detect_reorg": _with(EVENT_BLOCKS) + """, top AS (SELECT max(block_number) AS t, max(block_number) * 99 // 100 AS fork FROM blocks),
stored AS (SELECT block_number, block_hash, 2 AS v FROM blocks
  UNION ALL SELECT block_number, 'old', 1 FROM blocks WHERE block_number % 7 = 0),
ours AS (SELECT block_number, arg_max(block_hash, v) AS h FROM stored GROUP BY block_number),
theirs AS (SELECT block_number, CASE WHEN block_number > fork THEN md5(concat(block_number, 'x')) ELSE block_hash END AS h
  FROM blocks, top WHERE block_number <> fork),
pairs AS (SELECT o.block_number, o.h = t.h AS same FROM ours o LEFT JOIN theirs t USING (block_number))
SELECT t AS last_block, NOT (SELECT same FROM pairs WHERE block_number = t) AS reorg_detected,
  (SELECT max(block_number) FROM pairs WHERE same) AS common_ancestor FROM top""",
    "schema_contract": SCHEMA_CONTRACT,
    "table_ddl": _with(EVENT_BLOCKS) + """SELECT block_number, block_hash, block_timestamp,
  CAST(strftime(block_timestamp, '%Y%m%d') AS INTEGER) AS part_day, CAST(1 AS BIGINT) AS insert_version FROM blocks""",
    "delete_counts": _with(*EVENT_STORE) + """SELECT
  (SELECT count(*) FROM stored WHERE block_number >= h // 4 AND block_number < h // 2) AS with_withdrawals,
  (SELECT count(*) FROM blocks WHERE block_number >= 3 * h // 4) AS blocks_only
FROM (SELECT max(event_id) AS h FROM events)""",
    "historical_files": _with(BLOCKS) + """SELECT block_number, block_hash, timestamp,
  CASE WHEN block_number % 2 = 1 THEN gas_used ELSE -1 END AS gas_used,
  CASE WHEN block_number % 2 = 1 AND withdrawals LIKE '[{%' THEN 1 ELSE 0 END AS n_withdrawals FROM blocks""",
    "historical_bad_rows": _with(*BAD_LOAD) + """SELECT dataset, start_block, end_block, status, attempt_count,
  coalesce(rows_indexed, -1) AS rows_indexed, error_message FROM loaded""",
    "stream_bad_ranges": _with(*BAD_STREAM) + """, heads AS (SELECT k, (max(o_orderkey) - 12) // 100 * 100 AS safe
  FROM orders, (SELECT unnest([1, 2, 3, 4]) AS k), (SELECT max(o_orderkey) + 1 AS n FROM orders)
  WHERE o_orderkey < n * k // 4 GROUP BY k),
tries AS (SELECT start_block, count(*) AS n FROM ranges JOIN heads ON end_block <= safe GROUP BY start_block)
SELECT dataset, start_block, end_block, status, CAST(CASE WHEN status = 'failed' THEN least(n, 3) ELSE 0 END AS INTEGER) AS attempt_count,
  coalesce(rows_indexed, -1) AS rows_indexed FROM loaded JOIN tries USING (start_block)""",
    "range_files": _with(BLOCKS) + """, ranges AS (
  SELECT s AS start_block, s + 300 AS end_block FROM (SELECT unnest(range(900, (SELECT max(block_number) + 1 FROM blocks), 5000)) AS s)),
named AS (
  SELECT block_number, CASE WHEN gas_used % 50 = 0 THEN 'net__blocks__rest.parquet' ELSE
    printf('net__blocks__%08d_to_%08d.parquet', block_number // 1000 * 1000, block_number // 1000 * 1000 + 999) END AS file_name,
    CASE WHEN gas_used % 50 <> 0 THEN block_number // 1000 * 1000 END AS f FROM blocks),
opened AS (SELECT * FROM named n WHERE f IS NULL OR EXISTS (SELECT 1 FROM ranges r WHERE r.start_block < n.f + 1000 AND r.end_block > n.f))
SELECT file_name, count(*) AS n_read,
  count(*) FILTER (EXISTS (SELECT 1 FROM ranges r WHERE block_number >= r.start_block AND block_number < r.end_block)) AS n_rows
FROM opened GROUP BY file_name""",
    "snapshot_state": _with(STATE, LATEST) + "SELECT * REPLACE (coalesce(rows_indexed, -1) AS rows_indexed) FROM latest",
    "snapshot_progress": _with(STATE, LATEST, PROGRESS) + "SELECT * FROM progress",
    "snapshot_gaps": _with(STATE, GAPS) + "SELECT * FROM gaps",
    "snapshot_history": _with(STATE, HISTORY) + "SELECT * FROM history",
    "stream_stuck": _with(STATE) + """, ev AS (
  SELECT *, created_at + INTERVAL 36 HOUR AS failed_at, lead(created_at) OVER k AS next_at,
    coalesce(count(*) FILTER (status = 'completed') OVER (k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS seg
  FROM range_state WINDOW k AS (PARTITION BY dataset, start_block, end_block ORDER BY created_at, insert_version)),
st AS (SELECT *, status = 'processing' AND failed_at < coalesce(next_at, (SELECT max(created_at) FROM range_state)) AS stuck FROM ev),
before AS (SELECT *, coalesce(count(*) FILTER (stuck) OVER (k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS e
  FROM st WINDOW k AS (PARTITION BY dataset, start_block, end_block, seg ORDER BY created_at, insert_version)),
tried AS (SELECT *, greatest(0, max(attempt_count - e) OVER (
  PARTITION BY dataset, start_block, end_block, seg ORDER BY created_at, insert_version ROWS UNBOUNDED PRECEDING)) + e AS attempts FROM before)
SELECT dataset, start_block, end_block, CAST(attempts + 1 AS INTEGER) AS attempt_count, created_at AS claimed_at, failed_at FROM tried WHERE stuck""",
    "stream_enrich": _with(TXS, DEFECTS) + f"""SELECT t.block_number, transaction_index, gas_limit, t.gas_used, value_f64, input, l_quantity,
  make_timestamp(b.timestamp * 1000000) AS block_timestamp, CASE WHEN b.timestamp IS NULL THEN 'null_timestamp' END AS reason
FROM txs t LEFT JOIN (SELECT * FROM blocks WHERE {USABLE}) b ON t.block_number = b.block_number""",
    "confirmed_windows": """SELECT day, n_events FROM (
  SELECT date_trunc('day', CAST(ts AS TIMESTAMP))::TIMESTAMP AS day, count(*) AS n_events FROM events GROUP BY 1)
WHERE day + INTERVAL 1 DAY <= (SELECT max(CAST(ts AS TIMESTAMP)) - INTERVAL 12 HOUR FROM events)""",
    "live_stream": """SELECT event_id, event_type FROM events
WHERE CAST(ts AS TIMESTAMP) + INTERVAL 2 DAY > TIMESTAMP '2024-01-31 00:00:00'""",
    "ingest_metrics": _with(STATE, LATEST) + """SELECT dataset, ranges_completed_total, ranges_failed_total,
  rows_inserted_total, highest_completed_block, ranges_in_progress, head AS chain_head_block,
  head - highest_completed_block AS chain_lag_blocks
FROM (SELECT dataset, count(*) FILTER (WHERE status = 'completed') AS ranges_completed_total,
             count(*) FILTER (WHERE status = 'failed') AS ranges_failed_total,
             CAST(coalesce(sum(rows_indexed) FILTER (WHERE status = 'completed'), 0) AS BIGINT) AS rows_inserted_total,
             coalesce(max(end_block) FILTER (WHERE status = 'completed'), 0) AS highest_completed_block
      FROM range_state GROUP BY dataset)
JOIN (SELECT dataset, count(*) FILTER (WHERE status = 'processing') AS ranges_in_progress
      FROM latest GROUP BY dataset) USING (dataset),
     (SELECT max(end_block) + 12 AS head FROM range_state)""",
    "duration_histogram": _with(STATE, LAST_EVENT) + """, took AS (
  SELECT l.dataset, (SELECT epoch(l.completed_at) - epoch(max(s.created_at)) FROM range_state s
    WHERE s.dataset = l.dataset AND s.start_block = l.start_block AND s.end_block = l.end_block
      AND s.status = 'processing') AS seconds
  FROM last_event l WHERE l.status = 'completed' AND l.completed_at IS NOT NULL)
SELECT dataset, le, count(*) FILTER (WHERE seconds <= le) AS ranges
FROM took, (SELECT unnest([CAST(2592000 AS DOUBLE), 7776000, 15552000, 31536000, 63072000,
                           CAST('inf' AS DOUBLE)]) AS le)
WHERE seconds IS NOT NULL GROUP BY dataset, le""",
    "rows_per_batch": """SELECT event_id // 100 * 100 AS start_block, event_id // 100 * 100 + 100 AS end_block,
  count(*) AS rows_indexed FROM events GROUP BY ALL""",
    "rows_per_range": """WITH hits AS (SELECT l_orderkey AS n FROM lineitem),
ranges AS (SELECT s AS start_block, least(s + 3, e) AS end_block
  FROM (SELECT e, unnest(range(0, e, 3)) AS s FROM (SELECT max(n) + 1 AS e FROM hits)))
SELECT start_block, end_block, count(n) AS rows_indexed
FROM ranges LEFT JOIN hits ON n >= start_block AND n < end_block GROUP BY ALL""",
    "partition_keys": """SELECT strftime(date_trunc('month', o_orderdate), '%Y-%m-%d') AS part_month,
  CAST(strftime(o_orderdate, '%Y%m%d') AS INTEGER) AS part_day, count(*) AS n_rows FROM orders GROUP BY ALL""",
    "retention": """SELECT event_id AS block_number FROM events
WHERE ts + INTERVAL 2 DAY > TIMESTAMP '2024-01-31 00:00:00'""",
    "append_versioned": _with(TXS, NEWEST) + f"""SELECT {TX_COLUMNS}, seen_at AS block_timestamp,
  CAST(2 AS BIGINT) AS insert_version FROM newest""",
    "delete_range": _with(*EVENT_STORE) + STORED_ROWS.format(
        where="""block_number < (SELECT max(event_id) // 4 FROM events)
  OR block_number >= 3 * (SELECT max(event_id) // 4 FROM events)"""),
    "replace_ranges": _with(EVENT_BLOCKS) + """, again AS (
  SELECT DISTINCT event_id // 5 AS b FROM events WHERE event_type = 'purchase')
SELECT block_number, CASE WHEN b IS NULL THEN block_hash ELSE 'again' END AS block_hash, block_timestamp,
  CAST(CASE WHEN b IS NULL THEN 1 ELSE 2 END AS BIGINT) AS insert_version
FROM blocks LEFT JOIN again ON block_number // 5 = b""",
    "expire_live": _with(*EVENT_STORE) + STORED_ROWS.format(
        where="block_timestamp + INTERVAL 2 DAY > TIMESTAMP '2024-01-30 12:00:00'"),
    "compact_table": """SELECT event_id AS block_number,
  CAST(CASE WHEN user_id >= 200 THEN 3 WHEN user_id >= 100 THEN 2 ELSE 1 END AS BIGINT) AS insert_version
FROM events""",
    "historical_state": _with(*LOAD)
    + "SELECT * REPLACE (coalesce(rows_indexed, -1) AS rows_indexed) FROM loaded",
    "historical_rows": _with(*LOAD) + LOADED_ROWS,
    "maintain_state": REPAIRED,
    "auto_maintain_state": REPAIRED,
    "stream_ingest_state": _with(*STREAM) + """SELECT dataset, start_block, end_block, status,
  coalesce(rows_indexed, -1) AS rows_indexed, error_message FROM loaded""",
    "stream_ingest_rows": _with(*STREAM) + LOADED_ROWS,
    "stream_dedup": "SELECT event_id, user_id, event_type FROM events",
}
