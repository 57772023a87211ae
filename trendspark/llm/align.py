"""Alignment of two tokenizers' tokens over the same text (operator 11).

Method: diagonal run skipping over the byte offsets at which tokens end. At the current index shift the two arrays are
compared by exponential probing, so a stretch in which tokens correspond one to one is jumped in a few comparisons; where
they differ, the irregular group is resolved locally (whichever side is behind moves on until both end at the same byte)
and the shift is updated. Every place where both tokenizations end a token closes a group.

Tokenizer A is a byte-level vocabulary (``.json``), encoding a blank and the text; B is a piece vocabulary (``.model``)
that adds the blank itself. Inside a group every token of A is linked with every one of B. How many documents hold an id
pair linked is counted over the whole corpus, by blocks: a task packs the documents that it reads into blocks of about
BLOCK_LINKS links, each with its distinct pairs and how many of its documents hold them, and writes them once. Only these
distinct pairs are counted (partial sums before the shuffle) and joined back to their blocks, never links or documents;
a pair that every document holds is one row a block.

Results: a text that is null or empty, or whose joined token bytes are not the blank and the text (in either vocabulary),
has no tokens: all numbers are 0 and the digest is ''. Special strings inside texts are plain text. Rows without a doc_id
and repeated rows are documents like all others; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import sentencepiece
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from trendspark.llm.bpe import byte_letters
from trendspark.llm.codec import PATTERN
from trendspark.llm.common import SLICE_ROWS, cut, map_batches, reachable

#: Links after which a block of documents is closed; bounds a task's memory and sets how far pairs are added up in it.
BLOCK_LINKS = 1 << 21
#: Groups with more links than this are linked by their distinct ids.
WIDE = 1 << 12
#: Longer runs without or of white space are left to the library that takes them in linear time.
LONG_RUN = re.compile(r"\S{2000}|\s{2000}")


class Sides:
    """Both vocabularies: ids of a text, bytes of each id, and how ids are printed."""

    def __init__(self, path_a: str, path_b: str):
        self.library = Tokenizer.from_file(path_a)
        self.library.encode_special_tokens = True
        self.library.no_truncation()
        self.library.no_padding()
        byte_of = {c: b for b, c in enumerate(byte_letters())}
        vocabulary = self.library.get_vocab(with_added_tokens=False)
        self.bytes_a = [b""] * (max(vocabulary.values()) + 1)
        for token, i in vocabulary.items():
            self.bytes_a[i] = bytes(byte_of[c] for c in token) if all(c in byte_of for c in token) else token.encode()
        added = set(self.library.get_added_tokens_decoder())
        ranks = {b: i for i, b in enumerate(self.bytes_a) if i not in added}
        self.fast = tiktoken.Encoding("a", pat_str=PATTERN.format(L=r"\p{L}", N=r"\p{N}", S=r"\s"), mergeable_ranks=ranks, special_tokens={})
        self.model = sentencepiece.SentencePieceProcessor(model_file=path_b)
        self.bytes_b = [self._piece(self.model.id_to_piece(i)) for i in range(self.model.vocab_size())]
        self.lengths_a, self.lengths_b = (np.array([len(x) for x in side], np.int64) for side in (self.bytes_a, self.bytes_b))
        # the text of an id and what comes after it, for ids inside and at the end of their side of a group
        self.printed = [f"{i}{after}" for side, ends in ((self.bytes_a, ",|"), (self.bytes_b, ",;")) for after in ends for i in range(len(side))]

    @staticmethod
    def _piece(piece: str) -> bytes:
        if re.fullmatch("<0x[0-9A-F]{2}>", piece):
            return bytes([int(piece[3:5], 16)])
        return piece.replace("▁", " ").encode()

    def ids(self, text: str | None) -> tuple[np.ndarray, np.ndarray] | None:
        """The ids of both sides; None for a text that has no tokens."""
        if not text:
            return None
        spaced = " " + text
        if LONG_RUN.search(spaced):
            a = np.array(self.library.encode(spaced, add_special_tokens=False).ids, np.int64)
        else:
            a = np.array(self.fast.encode_ordinary(spaced), np.int64)
        b = self.model.encode(text, num_threads=1)
        raw = spaced.encode("utf-8", "replace")
        # a byte-level vocabulary with all 256 bytes loses nothing, so its bytes are the text's; B's are compared
        if self.lengths_a[a].sum() != len(raw) or b"".join(map(self.bytes_b.__getitem__, b)) != raw:
            return None
        return a, np.array(b, np.int64)

    def groups(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each group the number of A tokens, and of B tokens, up to its end."""
        return aligned(np.cumsum(self.lengths_a[a]), np.cumsum(self.lengths_b[b]))

    def text_of(self, a: np.ndarray, b: np.ndarray, upto_a: np.ndarray, upto_b: np.ndarray) -> str:
        """The groups as ``a1,a2|b1;a3|b2,b3``."""
        n_a, n_b = len(self.bytes_a), len(self.bytes_b)
        code_a, code_b = a.copy(), b + 2 * n_a
        code_a[upto_a - 1] += n_a
        code_b[upto_b - 1] += n_b
        out = np.empty(len(a) + len(b), np.int64)
        # a token comes after those of its own side, and after the other side's tokens of the groups before
        # (A) or up to its own (B)
        sizes_a, sizes_b = np.diff(upto_a, prepend=0), np.diff(upto_b, prepend=0)
        out[np.arange(len(a)) + np.repeat(upto_b - sizes_b, sizes_a)] = code_a
        out[np.arange(len(b)) + np.repeat(upto_a, sizes_b)] = code_b
        return "".join(map(self.printed.__getitem__, out.tolist()))[:-1]

    def links(self, a: np.ndarray, b: np.ndarray, upto_a: np.ndarray, upto_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The distinct linked id pairs (A's id times B's number of ids, plus B's id), sorted, and their links."""
        n, first_a, first_b = len(self.bytes_b), np.concatenate([[0], upto_a[:-1]]), np.concatenate([[0], upto_b[:-1]])
        size_a, size_b = upto_a - first_a, upto_b - first_b
        each = size_a * size_b
        wide = each > WIDE
        narrow = ~wide
        count = each[narrow]
        at = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
        across = np.repeat(size_b[narrow], count)
        pairs = [a[np.repeat(first_a[narrow], count) + at // across] * n + b[np.repeat(first_b[narrow], count) + at % across]]
        times = [np.ones(len(pairs[0]), np.int64)]
        for g in np.flatnonzero(wide):
            x, nx = np.unique(a[first_a[g] : upto_a[g]], return_counts=True)
            y, ny = np.unique(b[first_b[g] : upto_b[g]], return_counts=True)
            pairs.append((x[:, None] * n + y).ravel())
            times.append((nx[:, None] * ny).ravel())
        if len(pairs) == 1:
            return np.unique(pairs[0], return_counts=True)
        found, where = np.unique(np.concatenate(pairs), return_inverse=True)
        return found, np.bincount(where, np.concatenate(times), len(found)).astype(np.int64)


@cache
def sides(path_a: str, path_b: str) -> Sides:
    """One pair of vocabularies a Python worker."""
    return Sides(path_a, path_b)


def aligned(ends_a: np.ndarray, ends_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two arrays of ends, both ending at the same byte: for each common end the number of tokens of either side up to it."""
    n, m = len(ends_a), len(ends_b)
    a, b = ends_a.tolist(), ends_b.tolist()
    # stretches are compared as bytes, four for each end (a text has less than 4 GB)
    raw_a, raw_b = ends_a.astype("<u4").tobytes(), ends_b.astype("<u4").tobytes()
    runs_a, runs_b, lengths = [], [], []  # common ends that follow each other at one shift
    i = j = 0
    while i < n:
        start, step = i, 4
        while i < n and raw_a[4 * i : 4 * (i + step)] == raw_b[4 * j : 4 * (j + step)]:
            i, j, step = i + step, j + step, step * 2
        if i >= n:
            i, j = n, m
        else:
            while step > 1:
                step //= 2
                if raw_a[4 * i : 4 * (i + step)] == raw_b[4 * j : 4 * (j + step)]:
                    i, j = i + step, j + step
        runs_a.append(start)
        runs_b.append(j - (i - start))
        lengths.append(i - start)
        if i < n:  # an irregular group: its end is the first of the next common ends
            x, y = a[i], b[j]
            while x != y:
                if x < y:
                    i += 1
                    x = a[i]
                else:
                    j += 1
                    y = b[j]
            runs_a.append(i)
            runs_b.append(j)
            lengths.append(1)
            i, j = i + 1, j + 1
    count = np.array(lengths, np.int64)
    at = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
    return np.repeat(runs_a, count) + at + 1, np.repeat(runs_b, count) + at + 1


def groups(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """One row per document: doc_id, ids_a, ids_b, and upto_a, upto_b: for each group the tokens of a side up to its end."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        s = sides(path_a, path_b)
        for batch in batches:
            for start in range(0, batch.num_rows, SLICE_ROWS):
                part = batch.slice(start, SLICE_ROWS)
                rows = []
                for text in part.column(1).to_pylist():
                    ids = s.ids(text)
                    rows.append((*ids, *s.groups(*ids)) if ids else ([], [], [], []))
                columns = [pa.array([list(map(int, x)) for x in c], pa.list_(pa.int32())) for c in zip(*rows, strict=True)]
                yield pa.RecordBatch.from_arrays([part.column(0), *columns], ["doc_id", "ids_a", "ids_b", "upto_a", "upto_b"])

    return map_batches(_own(docs), run, "doc_id long, ids_a array<int>, ids_b array<int>, upto_a array<int>, upto_b array<int>")


def _own(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


#: A block: its documents in order, their numbers, and packed (Zstandard) the distinct pairs of the block, in how many of
#: its documents each is, and for each document its distinct pairs (as places among the block's) and their links.
BLOCK = ("block long, ids array<long>, n_a array<long>, n_b array<long>, n_groups array<long>, digests array<string>, "
         "sizes binary, pairs binary, held binary, places binary, times binary")
NUMBERS = ("n_a", "n_b", "n_groups")


def _packed(array: np.ndarray, dtype: str) -> bytes:
    raw = array.astype(dtype).tobytes()
    return len(raw).to_bytes(8, "little") + pa.compress(raw, "zstd", asbytes=True)


def _unpacked(data: bytes, dtype: str) -> np.ndarray:
    return np.frombuffer(pa.decompress(data[8:], int.from_bytes(data[:8], "little"), "zstd", asbytes=True), dtype)


def blocks(docs: DataFrame, path_a: str, path_b: str, block_links: int = BLOCK_LINKS) -> DataFrame:
    """All documents, packed; a block's number is unique, and fixed once the blocks are written."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        s, part, number = sides(path_a, path_b), TaskContext.get().partitionId(), 0
        ids, numbers, digests, found = [], {c: [] for c in NUMBERS}, [], []
        links = 0

        def close() -> pa.RecordBatch:
            pairs, places, held = np.unique(np.concatenate([f[0] for f in found]), return_inverse=True, return_counts=True)
            row = [(part << 32) + number, ids, *numbers.values(), digests, _packed(np.array([len(f[0]) for f in found]), "<i8"),
                   _packed(pairs, "<i8"), _packed(held, "<i8"), _packed(places, "<u4"), _packed(np.concatenate([f[1] for f in found]), "<i8")]
            types = [pa.int64(), *[pa.list_(pa.int64())] * 4, pa.list_(pa.string()), *[pa.binary()] * 5]
            return pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip(row, types, strict=True)], [f.split()[0] for f in BLOCK.split(", ")])

        for batch in batches:
            for start in range(0, batch.num_rows, SLICE_ROWS):
                for doc_id, text in zip(*(c.to_pylist() for c in batch.slice(start, SLICE_ROWS).columns), strict=True):
                    both = s.ids(text)
                    ids.append(doc_id)
                    if both is None:
                        found.append((np.empty(0, np.int64), np.empty(0, np.int64)))
                        digests.append("")
                        sizes = (0, 0, 0)
                    else:
                        upto = s.groups(*both)
                        found.append(s.links(*both, *upto))
                        digests.append(hashlib.sha256(s.text_of(*both, *upto).encode()).hexdigest())
                        sizes = (len(both[0]), len(both[1]), len(upto[0]))
                        links += len(found[-1][0])
                    for column, value in zip(numbers.values(), sizes, strict=True):
                        column.append(value)
                    if links >= block_links:
                        yield close()
                        ids, numbers, digests, found = [], {c: [] for c in NUMBERS}, [], []
                        links, number = 0, number + 1
        if ids:
            yield close()

    return map_batches(_own(docs), run, BLOCK)


RESULT = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"


def alignment(docs: DataFrame, path_a: str, path_b: str, block_links: int = BLOCK_LINKS) -> DataFrame:
    """One row per document: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256."""
    packed = cut(blocks(docs, path_a, path_b, block_links))
    width = len(sides(path_a, path_b).bytes_b)
    reachable(docs.sparkSession)

    def entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, pairs, held in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                found = _unpacked(pairs, "<i8")
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(found), block)), pa.array(found), pa.array(_unpacked(held, "<i8"))], ["block", "pair", "n"])

    held = map_batches(packed.select("block", "pairs", "held"), entries, "block long, pair long, n long")
    counted = cut(held.groupBy("pair").agg(F.sum("n").alias("count")))
    first = F.expr(f"pair div {width}")
    # one row for each id of A, so never more than its vocabulary
    highest = counted.groupBy(first.alias("id")).agg(F.max("count").alias("highest"))
    marked = counted.join(F.broadcast(highest), first == F.col("id")).select("pair", "count", (F.col("count") == F.col("highest")).alias("best"))
    known = held.select("block", "pair").join(marked, "pair").select("block", "pair", "count", "best")

    def finish(own: pa.Table, known: pa.Table) -> pa.Table:
        row = own.to_pylist()[0]
        sizes, pairs = _unpacked(row["sizes"], "<i8"), _unpacked(row["pairs"], "<i8")
        places, times = _unpacked(row["places"], "<u4"), _unpacked(row["times"], "<i8")
        count, best = np.zeros(len(pairs), np.int64), np.zeros(len(pairs), np.int64)
        at = np.searchsorted(pairs, known["pair"].to_numpy())
        count[at], best[at] = known["count"].to_numpy(), known["best"].to_numpy().astype(np.int64)
        ends = np.cumsum(sizes)

        def sums(values: np.ndarray) -> pa.Array:
            running = np.concatenate([[0], np.cumsum(values)])
            return pa.array(running[ends] - running[ends - sizes])

        return pa.table({
            "doc_id": pa.array(row["ids"], pa.int64()), **{c: pa.array(row[c], pa.int64()) for c in NUMBERS},
            "n_links": sums(times), "n_best": sums(times * best[places]), "count_sum": sums(times * count[places]),
            "groups_sha256": pa.array(row["digests"], pa.string())})

    return packed.groupBy("block").cogroup(known.groupBy("block")).applyInArrow(finish, RESULT)
