"""Helpers shared by the text operators: blocks of Arrow text, word hashes, written tables."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from spanledger.session import work_folder

BLOCK_BYTES = 256 << 10
ARROW_BYTES = 4 << 20  # of rows that a worker gets at once; one longer row is a batch
_BASE = 0x9E3779B97F4A7C15 | 1


def written(df: DataFrame, name: str, codec: str = "snappy") -> DataFrame:
    """The frame as a table in the shared folder: computed once, and safe when an executor is lost."""
    spark = df.sparkSession
    path = work_folder(spark, name)
    df.write.options(**{"compression": codec, "parquet.compression.codec.zstd.level": "6"}).parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.written_to = path
    return out


def discard(*tables: DataFrame) -> None:
    """Removes tables that `written` has made and that nothing will read again."""
    for df in tables:
        spark = df.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path(df.written_to)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def free_name(df: DataFrame, base: str) -> str:
    """A column name that the frame doesn't have."""
    taken = {c.lower() for c in df.columns}
    while base.lower() in taken:
        base = "_" + base
    return base


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def let(value: Column, body) -> Column:
    """body(value) with the value computed once, also where lambdas inside body use it again and again."""
    return F.transform(F.array(value), body)[0]


def partitions_for(total: int, each: int, least: int = 1) -> int:
    return max(least, -(-int(total or 0) // each))


# ------------------------------------------------------------------ text in Arrow batches

_kept: dict[str, object] = {}


def kept(name: str, make: Callable[[], object]):
    """An object that stays in the worker process for the tasks of this kind that follow; one name at a time."""
    if name not in _kept:
        release()
        _kept[name] = make()
    return _kept[name]


def release() -> None:
    """Forgets what is kept in this worker process, whose next task is of another kind, and gives free memory back."""
    _kept.clear()
    trim()


def trim() -> None:
    """Gives memory that this process has freed back to the system, where its allocators can."""
    pa.default_memory_pool().release_unused()
    give_back = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if give_back:
        give_back(0)


def in_batches(df: DataFrame, run, schema, keeps: bool = False, most: int = ARROW_BYTES) -> DataFrame:
    """mapInArrow over batches of about most bytes. Workers are reused: before and after a task, free memory goes back.

    keeps: run uses `kept`, so what is kept stays.
    """
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(most))

    def start(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if not keeps:
            release()
        yield from run(batches)
        trim()

    return df.mapInArrow(start, schema)


def text_column(batch: pa.RecordBatch, name: str) -> pa.Array:
    """The column as large strings without nulls (null reads as the empty text)."""
    column = batch.column(batch.schema.get_field_index(name))
    return pc.fill_null(column.cast(pa.large_binary()), b"")


def raw_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Offsets and bytes of a large binary array, without a copy."""
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    return offsets, np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)


def text_blocks(column: pa.Array, limit: int = BLOCK_BYTES) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, offsets from 0, bytes) for runs of whole texts of about limit bytes; one longer text is a run."""
    offsets, data = raw_bytes(column)
    row, n = 0, len(column)
    while row < n:
        end = int(np.searchsorted(offsets, offsets[row] + limit, "right")) - 1
        end = min(n, max(end, row + 1))
        yield row, offsets[row : end + 1] - offsets[row], data[offsets[row] : offsets[end]]
        row = end


# ------------------------------------------------------------------ words

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_WORD = np.zeros(256, bool)
_WORD[48:58] = _WORD[97:123] = _WORD[128:] = True

_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """base^i and base^-i modulo 2^64 for i < n."""
    size = 1 << max(16, int(n - 1).bit_length() if n > 1 else 1)
    if base not in _powers or len(_powers[base][0]) < n:
        both = []
        for b in (base, pow(base, -1, 1 << 64)):
            p = np.ones(1, np.uint64)
            while len(p) < size:
                p = np.concatenate((p, p * np.uint64(pow(b, len(p), 1 << 64))))
            both.append(p)
        _powers[base] = both[0], both[1]
    return _powers[base][0][:n], _powers[base][1][:n]


def mix(x: np.ndarray) -> np.ndarray:
    """Spreads all bits of 64-bit numbers over all bits."""
    x = x ^ (x >> np.uint64(33))
    x *= np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    x ^= x >> np.uint64(33)
    return x


def prefix_sums(data: np.ndarray, base: int = _BASE) -> np.ndarray:
    """s with hash(data[a:b]) = (s[b] - s[a]) * base^-a."""
    up, _ = powers(base, max(1, len(data)))
    s = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[: len(data)], out=s[1:])
    return s


class Words:
    """Words of a block of texts: [0-9a-z and all beyond ASCII]+ after lower-casing A-Z.

    start, end: byte positions in lower (the lower-cased block); hash: 64 bits of each word; first: for each text the
    number of its first word, and at the end the number of all words.
    """

    def __init__(self, offsets: np.ndarray, data: np.ndarray, hashes: bool = True) -> None:
        self.lower = _LOWER[data]
        inside = np.zeros(len(data) + 2, bool)
        inside[1:-1] = _WORD[self.lower]
        begin, stop = inside[1:] & ~inside[:-1], inside[:-1] & ~inside[1:]
        borders = offsets[1:-1]  # a text's last and the next one's first word may touch
        borders = borders[(borders > 0) & (borders < len(data))]
        touching = borders[inside[borders] & inside[borders + 1]]
        begin[touching] = stop[touching] = True
        self.start, self.end = np.flatnonzero(begin), np.flatnonzero(stop)
        self.first = np.searchsorted(self.start, offsets)
        self.hash = self._hash() if hashes else None

    def _hash(self) -> np.ndarray:
        out = np.empty(len(self.start), np.uint64)
        w, n = 0, len(self.start)
        while w < n:  # pieces of whole words keep the byte-wise arrays small in a very long text
            last = min(n, max(w + 1, int(np.searchsorted(self.end, self.start[w] + BLOCK_BYTES, "right"))))
            low, high = int(self.start[w]), int(self.end[last - 1])
            s = prefix_sums(self.lower[low:high])
            a, b = self.start[w:last] - low, self.end[w:last] - low
            _, down = powers(_BASE, high - low)
            out[w:last] = mix((s[b] - s[a]) * down[a] + (b - a).astype(np.uint64) * np.uint64(0xA24BAED4963EE407))
            w = last
        return out

    def grams(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """First words of all n-word windows inside one text, and the windows' hashes."""
        at = np.arange(max(0, len(self.start) - n + 1))
        text = np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))
        at = at[text[: len(at)] == text[n - 1 : n - 1 + len(at)]] if len(at) else at
        return at, fold([self.hash[at + j] for j in range(n)])

    def text(self, first: int, n: int) -> bytes:
        return b" ".join(bytes(self.lower[a:b]) for a, b in zip(self.start[first : first + n], self.end[first : first + n]))


def fold(columns: list[np.ndarray]) -> np.ndarray:
    """One 64-bit hash of several, in order."""
    out = np.full(len(columns[0]), len(columns), np.uint64)
    for c in columns:
        out = (out * np.uint64(0xD6E8FEB86659FD93)) ^ c
        out ^= out >> np.uint64(29)
    return mix(out)


def binary_rows(parts: list[bytes]) -> pa.Array:
    return pa.array(parts, pa.binary())
