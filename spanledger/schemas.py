"""Declared tables: columns, version key, time partition and load rules."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Table and column names, types, keys and status names of the data
# model. Unsigned 32 and 64 bit integers are BIGINT; 256-bit numbers stay text.
# ---------------------------------------------------------------------------
BLOCKS = """
    block_number BIGINT, block_hash STRING, parent_hash STRING, uncles_hash STRING, author STRING,
    state_root STRING, transactions_root STRING, receipts_root STRING, gas_used BIGINT,
    gas_limit BIGINT, extra_data STRING, logs_bloom STRING, timestamp BIGINT, size BIGINT,
    mix_hash STRING, nonce STRING, base_fee_per_gas BIGINT, withdrawals_root STRING, chain_id BIGINT
"""
TRANSACTIONS = """
    block_number BIGINT, transaction_index BIGINT, transaction_hash STRING, nonce BIGINT,
    from_address STRING, to_address STRING, value_binary STRING, value_string STRING,
    value_f64 DOUBLE, input STRING, gas_limit BIGINT, gas_used BIGINT, gas_price BIGINT,
    transaction_type BIGINT, max_priority_fee_per_gas BIGINT, max_fee_per_gas BIGINT, success INT,
    n_input_bytes BIGINT, n_input_zero_bytes BIGINT, n_input_nonzero_bytes BIGINT,
    n_rlp_bytes BIGINT, timestamp BIGINT, r STRING, s STRING, v BIGINT, block_hash STRING,
    chain_id BIGINT
"""
LOGS = """
    block_number BIGINT, block_hash STRING, transaction_index BIGINT, log_index BIGINT,
    transaction_hash STRING, address STRING, topic0 STRING, topic1 STRING, topic2 STRING,
    topic3 STRING, data STRING, n_data_bytes BIGINT, chain_id BIGINT
"""
CONTRACTS = """
    block_number BIGINT, block_hash STRING, create_index BIGINT, transaction_hash STRING,
    contract_address STRING, deployer STRING, factory STRING, init_code STRING, code STRING,
    init_code_hash STRING, n_init_code_bytes BIGINT, n_code_bytes BIGINT, code_hash STRING,
    chain_id BIGINT
"""
NATIVE_TRANSFERS = """
    block_number BIGINT, block_hash STRING, transaction_index BIGINT, transfer_index BIGINT,
    transaction_hash STRING, from_address STRING, to_address STRING, value_binary STRING,
    value_string STRING, value_f64 DOUBLE, chain_id BIGINT
"""
TRACES = """
    action_from STRING, action_to STRING, action_value STRING, action_gas BIGINT,
    action_input STRING, action_call_type STRING, action_init STRING, action_reward_type STRING,
    action_type STRING, result_gas_used BIGINT, result_output STRING, result_code STRING,
    result_address STRING, trace_address STRING, subtraces BIGINT, transaction_index BIGINT,
    transaction_hash STRING, block_number BIGINT, block_hash STRING, error STRING, chain_id BIGINT
"""
BALANCE_DIFFS = """
    block_number BIGINT, transaction_index BIGINT, transaction_hash STRING, address STRING,
    from_value_binary STRING, from_value_string STRING, from_value_f64 DOUBLE,
    to_value_binary STRING, to_value_string STRING, to_value_f64 DOUBLE, chain_id BIGINT
"""
CODE_DIFFS = """
    block_number BIGINT, transaction_index BIGINT, transaction_hash STRING, address STRING,
    from_value STRING, to_value STRING, chain_id BIGINT
"""
NONCE_DIFFS = """
    block_number BIGINT, transaction_index BIGINT, transaction_hash STRING, address STRING,
    from_value BIGINT, to_value BIGINT, chain_id BIGINT
"""
STORAGE_DIFFS = """
    block_number BIGINT, transaction_index BIGINT, transaction_hash STRING, address STRING,
    slot STRING, from_value STRING, to_value STRING, chain_id BIGINT
"""
WITHDRAWALS = """
    block_number BIGINT, block_hash STRING, withdrawals_root STRING, withdrawal_index STRING,
    validator_index STRING, address STRING, amount STRING, chain_id BIGINT
"""
STATE = """
    dataset STRING, start_block BIGINT, end_block BIGINT, status STRING, worker_id STRING,
    attempt_count INT, created_at TIMESTAMP, completed_at TIMESTAMP, rows_indexed BIGINT,
    error_message STRING, insert_version BIGINT
"""
COMPLETED, PROCESSING, FAILED, PENDING = "completed", "processing", "failed", "pending"
STATUSES = (COMPLETED, PROCESSING, FAILED, PENDING)
# Columns of an extracted blocks file that the blocks table does not keep.
UNWANTED_BLOCK_COLUMNS = (
    "total_difficulty_f64",
    "total_difficulty_binary",
    "total_difficulty_string",
    "difficulty",
)
# A timestamp counts only after 1971-01-01 00:00:00 UTC.
EPOCH_FLOOR_SECONDS = 31_536_000
# Gap search in a diff dataset that is asked from block 0 starts here.
DIFF_GAP_START = 1000
ERROR_TEXT_LIMIT = 500
BLOCKS_PER_HOUR = 720
BATCH_SIZE = 100
CONFIRMATIONS = 12
# Live tier: smaller ranges, fewer confirmations, retention of data and of state in days.
LIVE_BATCH_SIZE = 10
LIVE_CONFIRMATIONS = 6
LIVE_DATA_DAYS = 2
LIVE_STATE_DAYS = 7
# Named lists of datasets.
MODES = {
    "minimal": ("blocks", "transactions", "logs"),
    "extra": ("contracts", "native_transfers", "traces"),
    "diffs": ("balance_diffs", "code_diffs", "nonce_diffs", "storage_diffs"),
}
DURATION_BUCKETS = (0.5, 1, 2.5, 5, 10, 25, 50, 100, 250, 500, 1000)
STUCK_MESSAGE = "Auto-recovered: stuck processing since "
GATE_MESSAGE = "Block timestamps unusable (%s): %s/%s valid, %s present"
SKIPPED = "Skipped: "
REPROCESS_MESSAGE = "Auto-maintain: zero rows detected, marked for reprocess"
# ---------------------------------------------------------------------------


_TYPES = {
    "BIGINT": T.LongType(),
    "INT": T.IntegerType(),
    "DOUBLE": T.DoubleType(),
    "STRING": T.StringType(),
    "TIMESTAMP": T.TimestampType(),
}


def struct(columns: str) -> T.StructType:
    """Schema of a "name TYPE, ..." list; unlike fromDDL it needs no session."""
    pairs = (c.split() for c in columns.split(","))
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


@dataclass(frozen=True)
class Table:
    name: str
    columns: str
    key: tuple[str, ...]
    first_block: int = 0  # earliest block that can hold rows
    rows_expected: bool = False  # a completed range without rows is suspicious
    extra_input: tuple[str, ...] = ()  # read from the extracted file, not stored
    declared_input: bool = False  # only the declared columns are extracted

    @property
    def schema(self) -> T.StructType:
        return struct(self.columns)

    @property
    def input_columns(self) -> tuple[str, ...]:
        return tuple(self.schema.names) + self.extra_input

    @property
    def stored_schema(self) -> T.StructType:
        return struct(self.columns + ", block_timestamp TIMESTAMP, insert_version BIGINT")


_TX = ("block_number", "transaction_index")
TABLES = {
    t.name: t
    for t in (
        Table("blocks", BLOCKS, ("block_number",), rows_expected=True,
              extra_input=("withdrawals",), declared_input=True),
        Table("transactions", TRANSACTIONS, _TX, rows_expected=True),
        Table("logs", LOGS, (*_TX, "log_index"), rows_expected=True, declared_input=True),
        Table("contracts", CONTRACTS, ("block_number", "create_index")),
        Table("native_transfers", NATIVE_TRANSFERS, ("block_number", "transfer_index")),
        Table("traces", TRACES, (*_TX, "trace_address"), rows_expected=True),
        Table("balance_diffs", BALANCE_DIFFS, (*_TX, "address"), first_block=1),
        Table("code_diffs", CODE_DIFFS, (*_TX, "address"), first_block=1),
        Table("nonce_diffs", NONCE_DIFFS, (*_TX, "address"), first_block=1),
        Table("storage_diffs", STORAGE_DIFFS, (*_TX, "address", "slot"), first_block=1),
        Table("withdrawals", WITHDRAWALS, ("block_number", "withdrawal_index")),
    )
}
# What can be extracted; withdrawals are derived from blocks.
DATASETS = tuple(name for name in TABLES if name != "withdrawals")
MODES["full"] = DATASETS
DIFF_DATASETS = tuple(t.name for t in TABLES.values() if t.first_block > 0)
ROWS_EXPECTED = tuple(t.name for t in TABLES.values() if t.rows_expected)
STATE_TABLE = "indexing_state"
STATE_KEY = ("dataset", "start_block", "end_block")
STATE_SCHEMA = struct(STATE)
