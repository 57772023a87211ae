"""Near-duplicate documents by improved consistent weighted sampling (operator 8).

Method: a document is a weighted set of its runs of five words. A run's weight is (1 + ln tf) * idf with
idf = 1 + ln((1 + N) / (1 + df)) / ln(BUCKETS): N counts all documents, and df those with the run, exactly, by its 64-bit
hash. Documents are read in blocks; the distinct runs of a block, with the number of its documents, are dealt into parts
by their hash and counted there, and those of two or more documents go back to the block. A class whose runs that other
classes have too weigh less than THRESHOLD of it can be like none, and takes no further part. idf is damped, as runs that a large group of copies
shares must not lose their weight against the few words in which the copies differ: with df of 1 it is 2 at N = 2 BUCKETS
and 2.25 at twelve million documents. Improved consistent
weighted sampling draws BANDS * ROWS samples (k, t); two documents agree in a sample with probability equal to their
weighted Jaccard similarity. Documents that agree in all ROWS samples of a band share a bucket.

Documents of equal weighted sets are one class first. In each bucket the smallest class is compared with every other:
similarities are computed from whole texts and links kept at THRESHOLD or more. Linked classes become components. In
buckets whose other classes are still in different components every pair across components is compared, in pairs of
blocks through an inverted index of their runs, and each task returns only links that join components. So no candidate
pair is dropped, and neither copies nor candidates are expanded into all pairs.

Results: one row per document: doc_id, class_id (smallest doc_id of equal weighted sets), component_id (smallest doc_id
reachable), kept (doc_id = component_id). Words are as in ``common.word_bytes``; a text of fewer than five words is one
run; null and empty texts and those without a word are like no other and kept, and so are rows without a doc_id. Repeated
rows share a class; an id with different texts is in a class with each. An empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from collections import OrderedDict
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trendspark.llm.common import SLICE_ROWS, cut, fresh, map_batches, mix64, reachable, shingle_hashes
from trendspark.llm.components import components
from trendspark.llm.exactdedup import one_row

WIDTH, THRESHOLD = 5, 0.8
BANDS, ROWS, SEED = 12, 4, 7
#: Damps idf; also the length of a table of idf by hashed runs that may be given instead of exact frequencies.
BUCKETS = 1 << 18
#: Runs of a part in which frequencies are counted, and distinct runs (or documents) of a block.
PART_RUNS, HELD_RUNS = 1 << 20, 1 << 19
#: Bytes of a text for each run, about; only sets how many parts there are.
RUN_BYTES = 6
#: Classes of a block; an unsettled bucket of more is compared in pairs of blocks.
BLOCK = 1024
#: Runs whose samples are drawn together; bounds memory for long texts.
CHUNK = 1024
#: Texts whose weights are kept while pairs are compared.
TEXTS_KEPT = 64
_GOLD = np.uint64(0x9E3779B97F4A7C15)


def counted(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """The runs of a text, sorted, and how often each occurs."""
    return np.unique(shingle_hashes(text, WIDTH), return_counts=True)


def bucket_of(runs: np.ndarray) -> np.ndarray:
    return (runs & np.uint64(BUCKETS - 1)).astype(np.int64)


def set_hashes(runs: np.ndarray, counts: np.ndarray) -> tuple[int, int]:
    """Two hashes of a text's weighted set."""
    part = mix64(runs * np.uint64(0x9E3779B97F4A7C15) + counts.astype(np.uint64))
    return int(part.sum().astype(np.int64)), int(mix64(part).sum().astype(np.int64))


#: Either the distinct runs of a block of documents in one part, or (part below 0) the documents of a block.
DEALT = "part long, block long, runs binary, n binary, ids binary, own binary, one binary, two binary"
NONE = b""


def dealt_rows(rows: list[tuple]) -> pa.RecordBatch:
    names = [f.split()[0] for f in DEALT.split(", ")]
    types = [pa.int64(), pa.int64(), *[pa.binary()] * 6]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names)


def runs_and_documents(texts: DataFrame, parts: int, held_runs: int = HELD_RUNS) -> DataFrame:
    """The first pass over all texts (``texts``: doc_id, own, text), in blocks of documents. Of each block come its
    documents (id, hash of the text, number of runs, two hashes of the weighted set), and of its distinct runs those
    that two or more documents have anywhere: packed runs, and twice their documents plus 1 if more than one class has
    them. A run that all documents share is one entry a block, in one part."""

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        partition, number = TaskContext.get().partitionId(), 0
        classes: dict[tuple[int, int], list] = {}
        docs: list[tuple] = []
        size = 0

        def close() -> pa.RecordBatch:
            block = (partition << 32) + number
            ids = np.array([d[0] or 0 for d in docs], np.int64).tobytes() + np.array([d[0] is None for d in docs], np.int8).tobytes()
            own, one, two, n = (np.array([d[k] for d in docs], np.int64).tobytes() for k in (1, 3, 4, 2))
            rows = [(-1 - block % parts, block, NONE, n, ids, own, one, two)]
            if classes:
                runs = np.concatenate([r for r, _ in classes.values()])
                many = np.repeat(np.array([k for _, k in classes.values()], np.int64), [len(r) for r, _ in classes.values()])
                order = np.argsort(runs, kind="stable")
                runs, many = runs[order], many[order]
                first = np.flatnonzero(np.concatenate([[True], runs[1:] != runs[:-1]]))
                several = np.diff(np.append(first, len(runs))) > 1
                runs, n = runs[first], 2 * np.add.reduceat(many, first) + several
                part = (mix64(runs) % np.uint64(parts)).astype(np.int64)
                order = np.argsort(part, kind="stable")
                names, first = np.unique(part[order], return_index=True)
                pieces = zip(names.tolist(), np.split(runs[order], first[1:]), np.split(n[order], first[1:]), strict=True)
                rows += [(p, block, r.tobytes(), k.astype("<u4").tobytes(), *[NONE] * 4) for p, r, k in pieces]
            return dealt_rows(rows)

        for batch in batches:
            for start in range(0, batch.num_rows, SLICE_ROWS):
                for doc_id, own, text in zip(*(c.to_pylist() for c in batch.slice(start, SLICE_ROWS).columns), strict=True):
                    runs, counts = counted(text)
                    key = set_hashes(runs, counts) if len(runs) else (0, 0)
                    docs.append((doc_id, own or 0, len(runs), *key))
                    if len(runs):
                        if key in classes:
                            classes[key][1] += 1
                        else:
                            classes[key] = [runs, 1]
                            size += len(runs)
                    if size >= held_runs or len(docs) >= held_runs:
                        yield close()
                        classes, docs, size, number = {}, [], 0, number + 1
        if docs:
            yield close()

    def count(key: tuple, group: pa.Table) -> pa.Table:
        if key[0].as_py() < 0:
            return group
        blocks, runs, n = (group[c].to_pylist() for c in ("block", "runs", "n"))
        block = np.repeat(np.arange(len(blocks), dtype=np.int32), [len(r) // 8 for r in runs])
        runs, n = np.frombuffer(b"".join(runs), np.uint64), np.frombuffer(b"".join(n), "<u4")
        order = np.argsort(runs, kind="stable")
        runs, n, block = runs[order], n[order], block[order]
        first = np.flatnonzero(np.concatenate([[True], runs[1:] != runs[:-1]]))
        times = np.diff(np.append(first, len(runs)))
        df = np.add.reduceat((n >> 1).astype(np.int64), first)
        shared = (times > 1) | (np.maximum.reduceat(n & 1, first) > 0)
        n = np.repeat(2 * df + shared, times)
        many = np.repeat(df > 1, times)
        runs, n, block = runs[many], n[many], block[many]
        order = np.argsort(block, kind="stable")
        names, first = np.unique(block[order], return_index=True)
        pieces = zip(names.tolist(), np.split(runs[order], first[1:]), np.split(n[order], first[1:]), strict=True)
        rows = [(key[0].as_py(), blocks[b], r.tobytes(), k.tobytes(), *[NONE] * 4) for b, r, k in pieces]
        return pa.Table.from_batches([dealt_rows(rows)]) if rows else group.slice(0, 0)

    return map_batches(texts.select("doc_id", "own", "text"), deal, DEALT).groupBy("part").applyInArrow(count, DEALT)


def documents_of(dealt: DataFrame) -> DataFrame:
    """(doc_id, own, n, one, two, rep, block) of all rows: without a run or an id no hashes of the weighted set nor a class."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                own, n, one, two = (np.frombuffer(row[c], np.int64) for c in ("own", "n", "one", "two"))
                ids, none = np.frombuffer(row["ids"][: 8 * len(n)], np.int64), np.frombuffer(row["ids"][8 * len(n) :], np.int8) > 0
                lost = none | (n == 0)
                rep = mix64(one.view(np.uint64)) + mix64(mix64(two.view(np.uint64) * _GOLD))
                columns = [pa.array(ids, mask=none), pa.array(own), pa.array(n), *(pa.array(x, mask=lost) for x in (one, two, rep.view(np.int64)))]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(np.full(len(n), row["block"]))], ["doc_id", "own", "n", "one", "two", "rep", "block"])

    return map_batches(dealt.where("part < 0"), run, "doc_id long, own long, n long, one long, two long, rep long, block long")


def packed_df(df: np.ndarray) -> bytes:
    """The frequencies of a text's sorted runs, packed."""
    raw = df.astype("<u4" if df.max(initial=0) < 1 << 32 else "<u8")
    return len(raw).to_bytes(7, "little") + bytes([raw.itemsize]) + pa.compress(raw.tobytes(), "zstd", asbytes=True)


def unpacked_df(data: bytes) -> np.ndarray:
    size, each = int.from_bytes(data[:7], "little"), data[7]
    return np.frombuffer(pa.decompress(data[8:], size * each, "zstd", asbytes=True), f"<u{each}").astype(np.float64)


def weights(counts: np.ndarray, runs: np.ndarray, idf: int | np.ndarray, own: bytes | None = None) -> np.ndarray:
    """The weights of a text's sorted runs. ``idf`` is the number of documents, with ``own`` the packed frequencies of
    these runs (all 1 without it), or else a given table of idf by hashed runs."""
    if isinstance(idf, np.ndarray):
        return (1 + np.log(counts)) * idf[bucket_of(runs)]
    df = unpacked_df(own) if own else np.ones(len(runs))
    return (1 + np.log(counts)) * (1 + np.log((1 + idf) / (1 + df)) / np.log(BUCKETS))


def similarity(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Weighted Jaccard similarity of two (runs, weights)."""
    both, i, j = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    x, y = a[1][i], b[1][j]
    # copies of a run's weight add up in one order, so equal sets give exactly 1
    more = a[1].sum() + b[1].sum() - np.minimum(x, y).sum()
    return float(np.minimum(x, y).sum() / more) if len(both) else 0.0


@cache
def draws() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Multipliers of the hashes, and quantiles of Gamma(2, 1) and their logarithms at 2**16 places."""
    rng = np.random.default_rng(SEED)
    odd = rng.integers(0, 1 << 63, BANDS * ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    x = np.geomspace(1e-6, 60, 200_000)
    gamma = np.interp((np.arange(1 << 16) + 0.5) / (1 << 16), 1 - (1 + x) * np.exp(-x), x)
    return odd, gamma, np.log(gamma)


def samples(runs: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """One hash of the sample (k, t) for each of the BANDS * ROWS hash functions."""
    odd, gamma, log_gamma = draws()
    best = np.full(len(odd), np.inf)
    out = np.zeros(len(odd), np.uint64)
    every = np.arange(len(odd))
    for start in range(0, len(runs), CHUNK):
        k, log_s = runs[start : start + CHUNK, None], np.log(weight[start : start + CHUNK, None])
        u = k * odd
        u ^= u >> np.uint64(32)
        u *= np.uint64(0xD6E8FEB86659FD93)
        u ^= u >> np.uint64(32)
        r = gamma[(u & np.uint64(0xFFFF)).astype(np.int32)]
        log_c = log_gamma[((u >> np.uint64(16)) & np.uint64(0xFFFF)).astype(np.int32)]
        beta = (u >> np.uint64(32)).astype(np.float64) * 2.0**-32
        t = np.floor(log_s / r + beta)
        a = log_c - r * (t - beta + 1)
        at = np.argmin(a, axis=0)
        least = a[at, every]
        better = least < best
        best[better] = least[better]
        chosen = mix64(runs[start + at] + t[at, every].astype(np.int64).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        out[better] = chosen[better]
    return out


def bands_of(drawn: np.ndarray) -> np.ndarray:
    """One bucket a band: a hash of the band's number and its samples."""
    rows = drawn.reshape(BANDS, ROWS)
    key = np.arange(1, BANDS + 1, dtype=np.uint64)
    for j in range(ROWS):
        key = mix64(key * np.uint64(0x9E3779B97F4A7C15) + rows[:, j])
    return key.view(np.int64)


def sketches(texts: DataFrame, dealt: DataFrame, n: int, threshold: float) -> DataFrame:
    """(rep, buckets, text, df) of the classes that can be like another one; ``texts``: block, rep, text, one row a class.

    A class can only share weight in runs that another class has. If these are less than ``threshold`` of its weight, its
    similarity with every other class is below it: it needs no samples, and is left out without losing a link."""
    reachable(texts.sparkSession)

    def run(own: pa.Table, found: pa.Table) -> pa.Table:
        runs, n_of = (np.frombuffer(b"".join(found[c].to_pylist()), t) for c, t in (("runs", np.uint64), ("n", np.int64)))
        order = np.argsort(runs, kind="stable")
        runs, n_of = runs[order], n_of[order]
        out: list[tuple] = []
        for rep, text in zip(own["rep"].to_pylist(), own["text"].to_pylist(), strict=True):
            mine, counts = counted(text)
            at = np.searchsorted(runs, mine)
            at[at == len(runs)] = 0
            known = runs[at] == mine if len(runs) else np.zeros(len(mine), bool)
            value = np.where(known, n_of[at], 2) if len(runs) else np.full(len(mine), 2)
            packed = packed_df(value >> 1)
            weight = weights(counts, mine, n, packed)
            if weight[value & 1 > 0].sum() >= (threshold - 1e-9) * weight.sum():
                out.append((rep, bands_of(samples(mine, weight)), text, packed))
        columns = list(zip(*out, strict=True)) or [[]] * 4
        types = (pa.int64(), pa.list_(pa.int64()), pa.string(), pa.binary())
        return pa.table({c: pa.array(list(x), t) for c, x, t in zip(("rep", "buckets", "text", "df"), columns, types, strict=True)})

    answers = dealt.where("part >= 0").select("block", "runs", "n")
    return texts.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(run, "rep long, buckets array<long>, text string, df binary")


def verified(pairs: DataFrame, texts: DataFrame, idf: int | np.ndarray, threshold: float) -> DataFrame:
    """The pairs (a, b) whose texts are similar enough; ``texts`` has one row (id, text, df) for each class."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: OrderedDict[int, tuple] = OrderedDict()

        def features(doc_id: int, text: str, own: bytes | None) -> tuple:
            if doc_id not in kept:
                runs, counts = counted(text)
                kept[doc_id] = runs, weights(counts, runs, idf, own)
                if len(kept) > TEXTS_KEPT:
                    kept.popitem(last=False)
            kept.move_to_end(doc_id)
            return kept[doc_id]

        for batch in batches:
            a, b, s, t, f, g = batch.columns
            links = [similarity(features(a[i].as_py(), s[i].as_py(), f[i].as_py()), features(b[i].as_py(), t[i].as_py(), g[i].as_py())) >= threshold for i in range(batch.num_rows)]
            yield batch.select([0, 1]).filter(pa.array(links, pa.bool_()))

    first = texts.select(F.col("id").alias("a"), F.col("text").alias("text_a"), F.col("df").alias("df_a"))
    second = texts.select(F.col("id").alias("b"), F.col("text").alias("text_b"), F.col("df").alias("df_b"))
    # a pair's leader is a: its rows come one after another, and its weights are computed once
    both = pairs.join(second, "b").join(first, "a").select("a", "b", "text_a", "text_b", "df_a", "df_b")
    return map_batches(both, run, "a long, b long")


def cross_links(rep: list[int], root: list[int], block: list[int], texts: list[str], idf: int | np.ndarray, threshold: float, own: list[bytes | None] | None = None) -> list[tuple[int, int]]:
    """Links that join different components of one group of classes, enough to connect all that are similar.

    Every pair from different components (and, if the group has two blocks, from different blocks) is compared, through
    an inverted index of the runs; members of the largest component are only compared with the others."""
    found = [counted(t) for t in texts]
    weight = [weights(c, r, idf, o) for (r, c), o in zip(found, own or [None] * len(texts), strict=True)]
    total = np.array([w.sum() for w in weight])
    owner = np.repeat(np.arange(len(rep)), [len(w) for w in weight])
    runs, flat = np.concatenate([r for r, _ in found]), np.concatenate(weight)
    order = np.argsort(runs, kind="stable")
    runs, owner, flat = runs[order], owner[order], flat[order]
    names, group = np.unique(root, return_inverse=True)
    blocks = np.array(block)
    two = len(set(block)) > 1
    largest = int(np.argmax(np.bincount(group)))
    links = []
    for x in np.flatnonzero(group != largest):  # ``group`` changes as components join
        low = np.zeros(len(rep))
        for start in range(0, len(weight[x]), CHUNK):
            own, mine = found[x][0][start : start + CHUNK], weight[x][start : start + CHUNK]
            first, last = np.searchsorted(runs, own), np.searchsorted(runs, own, "right")
            n = last - first
            at = np.repeat(first - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum())
            low += np.bincount(owner[at], np.minimum(flat[at], np.repeat(mine, n)), len(rep))
        near = low >= threshold * (total + total[x] - low)
        if two:
            near &= blocks != blocks[x]
        for y in np.flatnonzero(near & (group != group[x])):
            if group[y] != group[x]:
                links.append((rep[x], rep[y]))
                group[group == group[y]] = group[x]
    return links


def linked(members: DataFrame, texts: DataFrame, idf: int | np.ndarray, threshold: float) -> DataFrame | None:
    """(vertex, root) of the components that similar classes sharing a bucket form; None without any bucket.
    ``members``: bucket, rep; ``texts``: id, text and, unless ``idf`` is a table, df."""
    if "df" not in texts.columns:
        texts = texts.withColumn("df", F.lit(None).cast("binary"))
    if members.isEmpty():
        return None
    # the smallest class leads in every bucket it is in, so its pairs are found once
    leader = members.groupBy("bucket").agg(F.min("rep").alias("a"))
    pairs = cut(members.join(leader, "bucket").where("rep != a").select("a", F.col("rep").alias("b")).distinct())
    links = cut(verified(pairs, texts, idf, threshold))
    roots = cut(components(links))
    # buckets whose classes are still in different components: all their pairs, in pairs of blocks
    active = members.join(roots.withColumnRenamed("vertex", "rep"), "rep", "left").withColumn("root", F.coalesce("root", "rep"))
    # a leader that is like nobody in its bucket has been compared with all of it
    rest = active.join(leader, "bucket").where("rep != a")
    open_ = rest.groupBy("bucket").agg(F.min("root").alias("low"), F.max("root").alias("high"), F.count("*").alias("n"))
    open_ = open_.where("low != high").select("bucket", F.ceil(F.col("n") / BLOCK).alias("blocks"))
    active = rest.join(open_, "bucket").withColumn("block", F.pmod(F.xxhash64("rep"), F.col("blocks")))
    active = active.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    active = active.select("bucket", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block", "rep", "root")
    active = cut(active)
    if active.isEmpty():
        return roots

    def compare(key: tuple, group: pa.Table) -> pa.Table:
        found = cross_links(*(group[c].to_pylist() for c in ("rep", "root", "block", "text")), idf, threshold, group["df"].to_pylist())
        return pa.table({"a": pa.array([a for a, _ in found], pa.int64()), "b": pa.array([b for _, b in found], pa.int64())})

    dealt = active.join(texts.withColumnRenamed("id", "rep"), "rep")
    more = cut(dealt.groupBy("bucket", "i", "j").applyInArrow(compare, "a long, b long"))
    return cut(components(links.unionByName(more)))


def near_rows(docs: DataFrame, threshold: float = THRESHOLD, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, own (hash of the text), class_id, component_id, group (a hash naming the component;
    null without a word or an id). Classes are known by a hash of their weighted set, so an id with different texts is
    in the component of each of them."""
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).withColumn("own", F.xxhash64("text"))
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    dealt = cut(runs_and_documents(texts, size // (RUN_BYTES * PART_RUNS) + 1))
    rows = cut(documents_of(dealt))
    n_docs = rows.count()
    drawn = rows.where("rep IS NOT NULL")
    # of each class the row of its smallest id stands for it, in a block that has it
    classes = drawn.groupBy("one", "two", "rep").agg(F.min(F.struct("doc_id", "own", "block")).alias("first"))
    classes = cut(classes.select("one", "two", "rep", "first.*"))
    # an id with one text is one row, however often it is repeated
    once = texts.dropDuplicates(["doc_id", "own"])
    whole = once.join(classes.select("rep", "doc_id", "own", "block"), ["doc_id", "own"]).select("block", "rep", "text")
    found = cut(sketches(whole, dealt, n_docs, threshold))
    members = cut(found.select("rep", F.explode("buckets").alias("bucket")))
    shared = members.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1").select("bucket")
    members = cut(members.join(shared, "bucket").select("bucket", "rep"))
    chosen = found.join(members.select("rep").distinct(), "rep", "left_semi").select(F.col("rep").alias("id"), "text", "df")
    idf = n_docs
    classes = classes.select("one", "two", "rep", F.col("doc_id").alias("low"))
    roots = linked(members, chosen, idf, threshold)
    known = classes.select("one", "two", "rep", F.col("low").alias("class_id"))
    if roots is not None:
        known = known.join(roots.withColumnRenamed("vertex", "rep"), "rep", "left").withColumn("group", F.coalesce("root", "rep"))
        known = cut(known.select("one", "two", "class_id", "group"))
        least = known.groupBy("group").agg(F.min("class_id").alias("component_id"))
        known = known.join(least, "group")
    else:
        known = known.select("one", "two", "class_id", F.col("rep").alias("group"), F.col("class_id").alias("component_id"))
    named = drawn.select("doc_id", "own", "one", "two").join(known, ["one", "two"]).select("doc_id", "own", "class_id", "component_id", "group")
    rest = rows.where("rep IS NULL").select("doc_id", "own", F.col("doc_id").alias("class_id"), F.col("doc_id").alias("component_id"), F.lit(None).cast("long").alias("group"))
    return named.unionByName(rest)


def near_groups(docs: DataFrame, threshold: float = THRESHOLD, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, class_id, component_id, kept."""
    rows = near_rows(docs, threshold, id_col, text_col).select("doc_id", "class_id", "component_id")
    return rows.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def keep_one(docs: DataFrame, threshold: float = THRESHOLD, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents that stay, with all their columns: one row of each group, and all without a word or an id. It has the
    smallest id of the group; of several rows of that id in the group ``exactdedup.one_row`` chooses. Columns of any
    name keep their values."""
    rows = near_rows(docs, threshold, id_col, text_col).where("group IS NOT NULL")
    own_id, own, group = fresh(docs.columns, "_id", "_own", "_group")
    marks = cut(rows.groupBy("doc_id", "own", "group", (F.col("doc_id") == F.col("component_id")).alias("kept")).agg(F.count("*").alias("n")))
    several = marks.where("kept").groupBy("group").agg(F.sum("n").alias("n")).where("n > 1").select("group")
    key = [F.col("doc_id").alias(own_id), F.col("own").alias(own)]
    repeated = cut(marks.where("kept").join(several, "group").select(*key, F.col("group").alias(group)))
    dropped = marks.where("NOT kept").select(*key)
    keyed = docs.withColumns({own_id: F.col(id_col).cast("long"), own: F.xxhash64(F.col(text_col).cast("string"))})
    if repeated.isEmpty():
        return keyed.join(dropped, [own_id, own], "left_anti").select(*docs.columns)
    out = keyed.join(dropped.unionByName(repeated.drop(group)), [own_id, own], "left_anti").select(*docs.columns)
    return out.unionByName(one_row(keyed.join(repeated, [own_id, own]), [group], docs.columns, text_col))
