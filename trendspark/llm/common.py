"""Helpers shared by the corpus operators: readers, reliable cuts of lineage, Arrow maps, hashed words."""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trendspark import session

#: Rows of an Arrow batch turned into Python objects at a time.
SLICE_ROWS = 256


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of a data folder."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def reachable(spark: SparkSession) -> None:
    """Python workers of this machine find the library where the driver found it (a cluster is sent it as a package)."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    env = spark.sparkContext.environment
    paths = [p for p in (env.get("PYTHONPATH") or os.environ.get("PYTHONPATH", "")).split(os.pathsep) if p]
    if root not in paths:
        env["PYTHONPATH"] = os.pathsep.join([*paths, root])


def map_batches(df: DataFrame, run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema) -> DataFrame:
    """``mapInArrow`` with the library in the workers' reach."""
    reachable(df.sparkSession)
    return df.mapInArrow(run, schema)


def cut(df: DataFrame) -> DataFrame:
    """``session.cut`` with the library in the workers' reach."""
    reachable(df.sparkSession)
    return session.cut(df)


def fresh(columns: list[str], *names: str) -> list[str]:
    """``names`` with so many underscores before them that none is among ``columns``."""
    taken, out = {c.lower() for c in columns}, []
    for name in names:
        while name.lower() in taken:
            name = "_" + name
        taken.add(name.lower())
        out.append(name)
    return out


def arrow_map(df: DataFrame, per_slice: Callable[[pa.RecordBatch], pa.RecordBatch | None], schema: str) -> DataFrame:
    """Apply ``per_slice`` to every slice of at most SLICE_ROWS rows of ``df``, inside Spark's tasks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, SLICE_ROWS):
                out = per_slice(batch.slice(start, SLICE_ROWS))
                if out is not None and out.num_rows:
                    yield out

    return map_batches(df, run, schema)


def crc_mod(column: str, modulus: int):
    """crc32 of a column's text, modulo ``modulus`` (null for null)."""
    return F.crc32(F.col(column).cast("string").cast("binary")) % modulus


# --- words as bytes: digits, ASCII letters in lower case and everything beyond ASCII -----------------------------

_WORD_TABLE = bytes(
    (b + 32 if 65 <= b <= 90 else b) if b >= 0x80 or 48 <= b <= 57 or 65 <= b <= 90 or 97 <= b <= 122 else 32
    for b in range(256)
)


def word_bytes(text: str | None) -> bytes:
    """The words of a text (runs of digits, letters A-Z lower-cased, and non-ASCII characters), joined by one blank."""
    return b" ".join((text or "").encode("utf-8", "replace").translate(_WORD_TABLE).split())


_P = np.uint64(0x9E3779B97F4A7C15)
_MIX1, _MIX2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_S30, _S27, _S31 = np.uint64(30), np.uint64(27), np.uint64(31)


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser (the public SplitMix64 constants)."""
    x = (x ^ (x >> _S30)) * _MIX1
    x = (x ^ (x >> _S27)) * _MIX2
    return x ^ (x >> _S31)


_POWERS: list[np.ndarray] = []


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """P**i and P**-i modulo 2**64 for i < n, kept for the longest text so far."""
    if not _POWERS or len(_POWERS[0]) < n:
        size = max(1 << 16, 1 << n.bit_length())
        inverse = np.uint64(pow(int(_P), -1, 1 << 64))
        _POWERS[:] = [np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(size - 1, p)])) for p in (_P, inverse)]
    return _POWERS[0][:n], _POWERS[1][:n]


def word_hashes(text: str | None) -> np.ndarray:
    """A 64-bit hash of each word of a whole text, in order, by one polynomial prefix sum over its bytes."""
    joined = word_bytes((text or "").lower())
    if not joined:
        return np.empty(0, np.uint64)
    raw = np.frombuffer(joined, np.uint8)
    up, down = _powers(len(raw) + 1)
    sums = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * up[:-1], out=sums[1:])
    gaps = np.flatnonzero(raw == 32)
    starts = np.concatenate([[0], gaps + 1])
    ends = np.concatenate([gaps, [len(raw)]])
    return mix64((sums[ends] - sums[starts]) * down[starts])


def shingle_hashes(text: str | None, width: int = 5) -> np.ndarray:
    """A hash of every run of ``width`` words; a text of fewer words is one shingle; without words there is none."""
    words = word_hashes(text)
    if not len(words):
        return words
    width = min(width, len(words))
    n = len(words) - width + 1
    total = np.zeros(n, np.uint64)
    for j in range(width):
        total = total * _P + words[j : j + n]
    return mix64(total)


def arrow_filter(docs: DataFrame, column: str, keep: Callable[[list], list[bool]]) -> DataFrame:
    """The rows of ``docs``, with all their columns, whose value of ``column`` ``keep`` accepts; nothing is shuffled."""
    at = docs.columns.index(column)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, SLICE_ROWS):
                part = batch.slice(start, SLICE_ROWS)
                out = part.filter(pa.array(keep(part.column(at).to_pylist()), pa.bool_()))
                if out.num_rows:
                    yield out

    return map_batches(docs, run, docs.schema)
