"""Best-fit packing of documents into bins of fixed size under conflicts (operator 5).

Method: no bin holds two documents of one source, or two of one duplicate cluster (equal texts but for blanks). Open
bins are ordered by what is left in them and carry a bitmap of the sources and clusters they hold. Documents are taken
longest first; each goes to the tightest bin that fits: the successor search starts at the first bin with enough room
and goes on until a bin's bitmap does not conflict. Without one a new bin is opened.

Lengths are bytes of UTF-8. A document longer than a bin is cut into pieces: full ones take a bin each, the last is
packed. Documents are dealt by a hash of their id into shards of about SHARD_ROWS, packed on their own, so the work of
a task is bounded and a source or cluster with a third of all rows is spread over all shards. Rows that are alike (one
id, or none, and one source, cluster and length) are counted first and dealt round all shards, from that hash on. Only
ids, sources, lengths and hashes of texts are shuffled.

Results: one row a piece: doc_id, piece, start, length, shard, bin (null for an empty or null text, which takes no
room). A null source conflicts with nothing, and so does a text without characters. Repeated rows are documents of one
cluster. Ties go to the smaller doc_id, then source; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trendspark.llm.common import cut
from trendspark.llm.exactdedup import normalised

CAPACITY, SHARD_ROWS = 16_384, 4096
#: Bins whose bitmaps are looked at together.
LOOK = 64


def best_fit(sizes: np.ndarray, conflicts: np.ndarray, capacity: int) -> tuple[np.ndarray, int]:
    """The bin of each item, and the number of bins. ``sizes`` (1 to capacity) are taken in the order given;
    ``conflicts`` holds for each item the numbers that a bin may have once, -1 for none, a column for each kind."""
    n = len(sizes)
    words = int(conflicts.max(initial=-1)) // 64 + 1
    bitmaps = np.zeros((n, max(words, 1)), np.uint64)
    left, bins = np.empty(n, np.int64), np.empty(n, np.int64)  # of the open bins, by what is left
    n_open = n_bins = 0
    out = np.empty(n, np.int64)
    for item, (size, own) in enumerate(zip(sizes.tolist(), conflicts.tolist(), strict=True)):
        marks = [(c // 64, np.uint64(1 << (c % 64))) for c in own if c >= 0]
        at = int(np.searchsorted(left[:n_open], size))
        while marks and at < n_open:
            some = bins[at : min(at + LOOK, n_open)]
            taken = np.zeros(len(some), np.uint64)
            for word, bit in marks:
                taken |= bitmaps[some, word] & bit
            free = np.flatnonzero(taken == 0)
            if len(free):
                at += int(free[0])
                break
            at += len(some)
        if at < n_open:
            chosen, rest = int(bins[at]), int(left[at]) - size
            left[at : n_open - 1], bins[at : n_open - 1] = left[at + 1 : n_open].copy(), bins[at + 1 : n_open].copy()
            n_open -= 1
        else:
            chosen, rest = n_bins, capacity - size
            n_bins += 1
        out[item] = chosen
        for word, bit in marks:
            bitmaps[chosen, word] |= bit
        if rest:
            to = int(np.searchsorted(left[:n_open], rest))
            left[to + 1 : n_open + 1], bins[to + 1 : n_open + 1] = left[to:n_open].copy(), bins[to:n_open].copy()
            left[to], bins[to] = rest, chosen
            n_open += 1
    return out, n_bins


def _numbers(values: list, offset: int) -> tuple[list[int], int]:
    """A number for each value that occurs again, counted from ``offset``; -1 for nulls and single values."""
    seen: dict = {}
    for v in values:
        seen[v] = seen.get(v, 0) + 1
    numbers = {v: offset + i for i, v in enumerate(v for v, n in seen.items() if n > 1 and v is not None)}
    return [numbers.get(v, -1) for v in values], offset + len(numbers)


def pack_shard(rows: pa.Table, capacity: int) -> pa.Table:
    """All pieces of one shard's documents with their bins; ``rows`` has doc_id, source, cluster, length, shard and
    copies, how many such rows the shard has."""
    alike = zip(*(rows[c].to_pylist() for c in ("doc_id", "source", "cluster", "length", "copies")), strict=True)
    data = sorted((r[:4] for r in alike for _ in range(r[4])), key=lambda r: (-(r[3] % capacity), r[0] is None, r[0] or 0, r[1] or "", r[3]))
    items = [r for r in data if r[3] % capacity]
    by_source, used = _numbers([r[1] for r in items], 0)
    by_cluster, _ = _numbers([r[2] for r in items], used)
    bins, n_bins = best_fit(np.array([r[3] % capacity for r in items], np.int64), np.array([by_source, by_cluster], np.int64).T.reshape(-1, 2), capacity)
    out: list[tuple] = []
    for k, (doc_id, _, _, length) in enumerate(data):
        full, rest = divmod(length, capacity)
        for piece in range(full):
            out.append((doc_id, piece, piece * capacity, capacity, n_bins))
            n_bins += 1
        if rest or not length:
            out.append((doc_id, full, full * capacity, rest, int(bins[k]) if rest else None))
    columns = list(zip(*out, strict=True)) or [()] * 5
    arrays = [pa.array(c, pa.int64()) for c in columns]
    shard = pa.array([rows["shard"][0].as_py()] * len(out), pa.int64())
    return pa.Table.from_arrays([*arrays[:4], shard, arrays[4]], ["doc_id", "piece", "start", "length", "shard", "bin"])


def pack(docs: DataFrame, capacity: int = CAPACITY, cluster: Column | None = None, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """One row per piece of each document; ``cluster`` (a long) replaces the hash of the text without blanks."""
    norm = normalised(F.col(text_col))
    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.col(source_col).cast("string").alias("source"),
        (F.when(norm != "", F.xxhash64(norm)) if cluster is None else cluster).alias("cluster"),
        F.coalesce(F.octet_length(F.col(text_col).cast("string")), F.lit(0)).cast("long").alias("length"),
    )
    rows = cut(rows)
    shards = max(1, -(-rows.count() // SHARD_ROWS))
    many = F.least(F.col("n"), F.lit(shards))
    rows = rows.groupBy("doc_id", "source", "cluster", "length").agg(F.count(F.lit(1)).alias("n"))
    rows = rows.select("*", F.explode(F.sequence(F.lit(0).cast("long"), many - 1)).alias("turn"))
    first = F.pmod(F.xxhash64("doc_id", "length"), F.lit(shards))
    rows = rows.select(
        "doc_id", "source", "cluster", "length", F.pmod(first + F.col("turn"), F.lit(shards)).alias("shard"),
        F.expr(f"n DIV {shards} + IF(turn < n % {shards}, 1, 0)").alias("copies"),
    )

    def run(group: pa.Table) -> pa.Table:
        return pack_shard(group, capacity)

    return rows.groupBy("shard").applyInArrow(run, "doc_id long, piece long, start long, length long, shard long, bin long")
