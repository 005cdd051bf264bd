"""Views over the driver tables, one text for both engines.

`@epoch(x)` stands for the unix seconds of a timestamp, the only spelling that differs.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()

# Range events: one per order, several per range.
RANGE_STATE = """
SELECT CASE o_orderpriority WHEN '1-URGENT' THEN 'blocks' WHEN '2-HIGH' THEN 'transactions'
            WHEN '3-MEDIUM' THEN 'logs' WHEN '5-LOW' THEN 'contracts'
            ELSE 'balance_diffs' END AS dataset,
       o_custkey * 100 AS start_block,
       o_custkey * 100 + 100 AS end_block,
       CASE WHEN o_orderstatus = 'F' THEN 'completed' WHEN o_orderstatus = 'O' THEN 'processing'
            WHEN o_totalprice < 100000 THEN 'pending' ELSE 'failed' END AS status,
       CASE WHEN o_orderstatus = 'O' THEN concat('worker-', o_orderpriority) ELSE '' END AS worker_id,
       CASE WHEN o_orderstatus = 'P' THEN 1 ELSE 0 END AS attempt_count,
       CAST(o_orderdate AS TIMESTAMP) AS created_at,
       CASE WHEN o_orderstatus = 'F' THEN CAST(o_orderdate AS TIMESTAMP) END AS completed_at,
       CASE WHEN o_orderstatus = 'F'
            THEN greatest(CAST(floor(o_totalprice / 10000) AS BIGINT) - 2, 0) END AS rows_indexed,
       CASE WHEN o_orderstatus = 'P'
            THEN concat('Extraction failed: ', repeat(concat(o_orderpriority, ' '), 60)) END
            AS error_message,
       o_orderkey AS insert_version
FROM orders
"""
AS_OF = "2001-08-02 00:00:00"
DATASETS = ("blocks", "transactions", "logs", "balance_diffs", "contracts")

# One block per order, all with a usable time.
BLOCKS = """
SELECT o_orderkey AS block_number, md5(CAST(o_orderkey AS STRING)) AS block_hash,
       @epoch(o_orderdate) AS timestamp, o_custkey AS gas_used, o_orderpriority AS withdrawals_root, CAST(1 AS BIGINT) AS chain_id,
       CASE WHEN o_orderstatus = 'F'
            THEN concat('[{"index":"', o_orderkey, '","validatorIndex":', o_custkey,
                        ',"address":"', md5(o_orderpriority), '","amount":"32"},7]')
            WHEN o_orderstatus = 'O' THEN '[]' END AS withdrawals,
       o_orderkey AS insert_version
FROM orders
"""
# The same with about one block in 150 missing and one in 150 without a usable time.
BLOCKS_WITH_DEFECTS = """
SELECT block_number, block_hash, timestamp_or_not AS timestamp, gas_used, withdrawals_root, chain_id,
       withdrawals, insert_version
FROM (SELECT o_orderkey AS block_number, md5(CAST(o_orderkey AS STRING)) AS block_hash,
             CASE WHEN o_orderpriority = '1-URGENT' AND o_orderstatus = 'F' AND o_totalprice > 475000
                  THEN NULL
                  WHEN o_orderpriority = '1-URGENT' AND o_orderstatus = 'F' AND o_totalprice > 450000
                  THEN 0 ELSE @epoch(o_orderdate) END AS timestamp_or_not,
             o_custkey AS gas_used, o_orderpriority AS withdrawals_root, CAST(1 AS BIGINT) AS chain_id,
             CASE WHEN o_orderstatus = 'F'
                  THEN concat('[{"index":"', o_orderkey, '","validatorIndex":', o_custkey,
                              ',"address":"', md5(o_orderpriority), '","amount":"32"},7]')
                  WHEN o_orderstatus = 'O' THEN '[]' END AS withdrawals,
             o_orderkey AS insert_version
      FROM orders
      WHERE NOT (o_orderpriority = '5-LOW' AND o_orderstatus = 'P' AND o_totalprice > 450000)) b
"""
# Child rows; several versions per (block_number, transaction_index).
TXS = """
SELECT l_orderkey AS block_number, CAST(l_linenumber AS BIGINT) AS transaction_index,
       l_partkey AS gas_limit, l_suppkey AS gas_used, l_extendedprice AS value_f64,
       l_returnflag AS input, l_quantity, l_discount, CAST(l_shipdate AS TIMESTAMP) AS seen_at
FROM lineitem
"""
TX_ORDER = ("seen_at", "gas_limit", "gas_used", "l_quantity", "value_f64", "l_discount")
TX_KEY = ("block_number", "transaction_index")
# Block rows with withdrawals of every shape.
WITHDRAWALS = """
SELECT event_id AS block_number, md5(CAST(event_id AS STRING)) AS block_hash,
       event_type AS withdrawals_root, CAST(100 AS BIGINT) AS chain_id,
       CASE WHEN event_type = 'view' AND value < 2 THEN NULL ELSE @epoch(ts) END AS timestamp,
       CASE WHEN event_type = 'error' THEN NULL
            WHEN event_type = 'signup' AND value < 5 THEN 'null'
            WHEN event_type = 'signup' AND value < 10 THEN '[]'
            WHEN event_type = 'signup' THEN props
            WHEN event_type = 'click' THEN concat('[', props, ',7,"{}",null]')
            ELSE concat('[{"index":"', event_id, '","validatorIndex":', user_id, ',"address":"',
                        md5(event_type), '","amount":', user_id * 32, '},', props, ']')
            END AS withdrawals
FROM events
"""
EVENT_BLOCKS = """
SELECT event_id AS block_number, md5(CAST(event_id AS STRING)) AS block_hash,
       @epoch(ts) AS timestamp, user_id AS gas_used, CAST(100 AS BIGINT) AS chain_id,
       CAST(ts AS TIMESTAMP) AS block_timestamp
FROM events
"""


def _fill(text: str, epoch: str) -> str:
    return re.sub(r"@epoch\(([^()]*)\)", lambda m: epoch.format(m.group(1)), text)


def duck(text: str) -> str:
    return _fill(text, "CAST(floor(epoch({})) AS BIGINT)")


def spark_view(spark: SparkSession, sf_dir: str, text: str) -> DataFrame:
    """The view as a DataFrame that scans the Parquet files directly."""
    filled = _fill(text, "unix_seconds(CAST({} AS TIMESTAMP))")
    for name in TABLES:
        filled = re.sub(rf"\bFROM {name}\b", f"FROM parquet.`{sf_dir}/{name}.parquet`", filled)
    return spark.sql(filled)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
