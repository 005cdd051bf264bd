import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from spanledger.session import local_session

    session = local_session(cpus=8, shuffle_partitions=4, app="tests")
    yield session
    session.stop()


@pytest.fixture
def state_frame(spark):
    """State rows from (dataset, start, end, status[, created_second[, rows]])."""
    from spanledger.schemas import STATE_SCHEMA

    def build(rows):
        full = []
        for version, row in enumerate(rows):
            dataset, start, end, status = row[:4]
            at = row[4] if len(row) > 4 else 0
            n = row[5] if len(row) > 5 else (1 if status == "completed" else None)
            full.append((dataset, start, end, status, "", 0, at, at, n, None, version))
        names = STATE_SCHEMA.names
        kinds = [
            "bigint" if f.name in ("created_at", "completed_at") else f.dataType.simpleString()
            for f in STATE_SCHEMA.fields
        ]
        raw = spark.createDataFrame(full, ", ".join(f"{n} {k}" for n, k in zip(names, kinds)))
        return raw.selectExpr(
            *[
                f"timestamp_seconds(1700000000 + {n}) AS {n}" if n == "created_at"
                else f"if(status = 'completed', timestamp_seconds(1700000000 + {n}), null) AS {n}"
                if n == "completed_at" else n
                for n in names
            ]
        )

    return build


def rows(df, *columns):
    """Sorted tuples of a small result."""
    picked = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in picked.collect()), key=repr)
