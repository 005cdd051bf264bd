"""The tables and reports of a store under their SQL names."""

from __future__ import annotations

from spanledger.operators.coverage import continuous_ranges, progress, range_summary
from spanledger.schemas import STATE_TABLE, TABLES
from spanledger.sources.tables import TableStore


def register_views(store: TableStore, prefix: str = "") -> list[str]:
    """Temporary views for spark.sql: each table by its latest rows, the state history, and
    the three reports over it. They read the files present now; register again after a load."""
    state = store.state()
    views = {name: store.latest(name) for name in TABLES if store.exists(name)}
    views |= {
        STATE_TABLE: state,
        "indexing_progress": progress(state),
        "continuous_ranges": continuous_ranges(state),
        "indexing_summary": range_summary(state),
    }
    for name, df in views.items():
        df.createOrReplaceTempView(prefix + name)
    return [prefix + name for name in views]
