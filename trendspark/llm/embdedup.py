"""Near-duplicate vectors by blocks of a label, spherical k-means cells and hyperplane tables (operator 7).

Method: equal vectors of a label are one class. A label's classes of one length are dealt into blocks of BLOCK classes
at most; a task holds one block and as many others as fit, and every pair of blocks meets in one task. A task of up to
EXACT classes compares by cells: spherical k-means over its block, each cell in shells by the angle to its centroid. With
angle t of the threshold, a vector can only link into a shell whose widest angle plus t reaches it; those are compared by
distance in the directions in which the block varies most, where a link is never farther than it is, and what is left by
cosines in double precision. No link is lost.

A larger task would compare the square of its classes so, as cells hold little back among vectors without structure.
There, vectors are put into tables by the sides of random hyperplanes they are on. A table keeps two vectors of angle t
together with a known chance, whatever the data; so many tables are taken that a link stays unfound with a chance of MISS
at most (1e-12 for one just at the threshold, far less for closer ones). All found pairs are verified in double precision.
Classes in crowded places of the first tables are compared with each other by cells, so that a dense group's links are
not met again in each table. ``miss=0`` compares all by cells, at the cost named.

A task returns link counts and a spanning forest of its links, never the pairs. Components of all forests give each
vector's smallest reachable vec_id, its one kept representative.

Results: vectors link only when labels are equal and not null. Vectors that are null, empty, zero or hold null or
non-finite components, and rows without a vec_id, link with nothing and are kept; so do vectors of different lengths.
Repeated rows are vectors of their own. An empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, FloatType

from trendspark.llm.common import cut, map_batches
from trendspark.llm.components import components

#: Classes and bytes of a block at most, and classes up to which a label is one block.
BLOCK, BLOCK_BYTES, ALONE = 500_000, 128_000_000, 50_000
#: Classes up to which a task compares by cells alone, at all and for each table that it would need; the chance at most
#: that hyperplane tables miss a link.
EXACT, EXACT_TABLE, MISS = 160_000, 40, 1e-12
#: Cells for n classes: one for every CELL_ROOT of the square root of n, CELLS at most, in shells of SHELL rows.
CELL_ROOT, CELLS, SHELL, ROUNDS = 0.25, 4096, 64, 3
#: Rows compared at a time, tables made at a time, tables that show the crowded places, rows of a crowded place at least.
CHUNK, TABLES, FIRST_TABLES, CROWD = 16_384, 8, 16, 8


def unit(vectors: np.ndarray) -> np.ndarray:
    """The vectors at length 1, in double precision."""
    x = np.asarray(vectors, np.float64)
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt(np.einsum("ij,ij->i", x, x))[:, None]


def fit_cells(vectors: np.ndarray, k: int) -> np.ndarray:
    """Centroids of length 1 by spherical k-means; starts from evenly spaced rows of the sample."""
    centroids = vectors[np.linspace(0, len(vectors) - 1, min(k, len(vectors))).astype(int)].copy()
    for _ in range(ROUNDS if len(centroids) > 1 else 0):
        home = np.concatenate([np.argmax(vectors[s : s + 2048] @ centroids.T, axis=1) for s in range(0, len(vectors), 2048)])
        order = np.argsort(home, kind="stable")
        cells, starts = np.unique(home[order], return_index=True)
        total = np.add.reduceat(vectors[order], starts, axis=0)
        length = np.linalg.norm(total, axis=1)
        some = length > 1e-6
        centroids[cells[some]] = total[some] / length[some, None]
    return centroids


class Forest:
    """Link counts and a spanning forest of the links among a task's classes; n: the rows of each class."""

    def __init__(self, n: np.ndarray):
        self.n, self.links, self.root = n.astype(np.float64), np.zeros(len(n)), np.arange(len(n))

    def find(self, at: np.ndarray) -> np.ndarray:
        root = self.root[at]
        while not np.array_equal(up := self.root[root], root):
            root = up
        self.root[at] = root
        return root

    def merge(self, a: np.ndarray, b: np.ndarray) -> None:
        while True:
            a, b = self.find(a), self.find(b)
            apart = a != b
            if not apart.any():
                return
            a, b = a[apart], b[apart]
            self.root[np.maximum(a, b)] = np.minimum(a, b)

    def block(self, rows: np.ndarray, cols: np.ndarray, linked: np.ndarray) -> None:
        """Adds a matrix of links; rows are different from each other, and cols too."""
        some = linked.any(axis=1)
        rows, linked = rows[some], linked[some]
        if not len(rows):
            return
        self.links[rows] += linked @ self.n[cols]
        self.links[cols] += self.n[rows] @ linked
        while (apart := linked & (self.find(rows)[:, None] != self.find(cols))).any():
            i, j = apart.any(axis=1), apart.any(axis=0)
            self.merge(rows[i], cols[apart[i].argmax(axis=1)])
            self.merge(cols[j], rows[apart[:, j].argmax(axis=0)])

    def pairs(self, a: np.ndarray, b: np.ndarray) -> None:
        """Adds links that are different from each other and from those of any matrix."""
        self.links += np.bincount(a, self.n[b], len(self.n)) + np.bincount(b, self.n[a], len(self.n))
        self.merge(a, b)


def directions(sample: np.ndarray, threshold: float) -> np.ndarray:
    """So many orthogonal directions, those of the sample's largest extent first, that few pairs stay as near as a link."""
    d = sample.shape[1]
    axes = np.linalg.svd(sample, full_matrices=False)[2].T
    far = sample @ sample.T < threshold - 0.1
    for m in range(8, min(d, axes.shape[1]), 8):
        y = sample @ axes[:, :m]
        half = (y * y).sum(axis=1) / 2
        if (((y @ y.T - half[:, None] - half) >= threshold - 1) & far).mean() < 1e-5:
            return np.ascontiguousarray(axes[:, :m])
    return np.eye(d, dtype=sample.dtype)


def link_by_cells(x: np.ndarray, own: np.ndarray, others: np.ndarray, threshold: float, forest: Forest, within: bool = True) -> None:
    """Adds the links of rows ``own`` of x with rows ``others`` and, if ``within``, with each other."""
    if not len(own) or not (within or len(others)):
        return
    short = lambda at: unit(x[at]).astype(np.float32)
    cells = min(CELLS, max(1, round(math.sqrt(len(own)) / CELL_ROOT)), len(own))
    drawn = short(own[np.linspace(0, len(own) - 1, min(len(own), max(2048, 8 * cells))).astype(int)])
    axes = directions(drawn[np.linspace(0, len(drawn) - 1, min(len(drawn), 2048)).astype(int)], threshold)
    centroids = fit_cells(drawn, cells)
    m = axes.shape[1]
    home, close = np.empty(len(own), np.int32), np.empty(len(own), np.float32)
    for s in range(0, len(own), 2048):
        to = short(own[s : s + 2048]) @ centroids.T
        home[s : s + 2048], close[s : s + 2048] = to.argmax(axis=1), to.max(axis=1)
    order = np.lexsort((close, home))
    own, home, close = own[order], home[order], close[order]
    starts = np.searchsorted(home, np.arange(len(centroids) + 1))
    angle = math.acos(max(-1.0, min(1.0, threshold)))
    # cosines in float32 are unsure by less than 2e-5
    reach = np.cos(np.minimum(math.pi, np.arccos(np.clip(close - 2e-5, -1, 1)) + angle)).astype(np.float32) - np.float32(2e-5)
    enough = np.float32(threshold - 1 - 1e-4)

    def placed(u: np.ndarray) -> np.ndarray:
        """Where unit vectors are in the directions, with minus half its square, and 1."""
        y = np.ones((len(u), m + 2), np.float32)
        y[:, :m] = u @ axes
        y[:, m] = -np.einsum("ij,ij->i", y[:, :m], y[:, :m]) / 2
        return y

    near = np.empty((len(own), m + 2), np.float32)  # 1 comes first here: the product is minus half the squared distance
    for s in range(0, len(own), 2048):
        near[s : s + 2048] = placed(short(own[s : s + 2048]))
    near[:, m:] = near[:, : m - 1 : -1].copy()

    def compare(rows: np.ndarray, at: int | None) -> None:
        """rows: of x; at: their first place in own, if they are of it."""
        u = short(rows)
        y = placed(u)
        u = np.ascontiguousarray(u.T)
        begin = 0 if at is None else int(home[at])
        for c in range(begin, len(centroids), 64):
            to = centroids[c : c + 64] @ u
            for k in range(c, min(c + 64, len(centroids))):
                for s in range(starts[k], starts[k + 1], SHELL):
                    e = min(s + SHELL, starts[k + 1])
                    if at is not None and e <= at:
                        continue
                    some = np.flatnonzero(to[k - c] >= reach[s])
                    if at is not None and s < at + len(rows):
                        some = some[some + at < e]
                    if not len(some):
                        continue
                    hits = np.flatnonzero(y.take(some, axis=0, mode="clip") @ near[s:e].T >= enough)
                    if not len(hits):
                        continue
                    i, j = np.zeros(len(some), bool), np.zeros(e - s, bool)
                    i[hits // (e - s)] = j[hits % (e - s)] = True
                    i, j = some[i], s + np.flatnonzero(j)
                    linked = unit(x[rows[i]]) @ unit(x[own[j]]).T >= threshold
                    if at is not None:
                        linked &= (i + at)[:, None] < j
                    forest.block(rows[i], own[j], linked)

    for s in range(0, len(own) if within else 0, CHUNK):
        compare(own[s : s + CHUNK], s)
    for s in range(0, len(others), CHUNK):
        compare(others[s : s + CHUNK], None)


def tables_for(n: int, threshold: float, miss: float) -> tuple[int, int, int]:
    """For n rows: hyperplanes of a table, tables, and planes of a round of tables between a link at most."""
    side = 1 - math.acos(max(-1.0, min(1.0, threshold))) / math.pi
    k = min(32, max(8, round(math.log2(max(2, n))) + 3))
    together = max(side**k, 1e-300)
    tables = TABLES * math.ceil(math.log(miss / 2) / math.log1p(-together) / TABLES) if together < 1 else TABLES
    planes, tail = k * TABLES, 0.0
    apart = planes
    while apart > 0 and side < 1:  # the binomial tail beyond ``apart``
        tail += math.exp(math.lgamma(planes + 1) - math.lgamma(apart + 1) - math.lgamma(planes - apart + 1) + apart * math.log(1 - side) + (planes - apart) * math.log(side)) if side > 0 else 1
        if tail > miss / 2 / (tables / TABLES):
            break
        apart -= 1
    return k, tables, apart


def link_by_tables(x: np.ndarray, own: int, threshold: float, forest: Forest, miss: float, within: bool = True) -> None:
    """Adds the links of the first ``own`` rows of x with all later ones and, if ``within``, with each other."""
    n, d = x.shape
    k, tables, most = tables_for(n, threshold, miss)
    size = np.uint64(max(1, (n - 1).bit_length()))
    place, low = np.arange(n, dtype=np.uint64), (np.uint64(1) << size) - np.uint64(1)
    peaks = [np.abs(x[s : s + CHUNK]).max(axis=1) for s in range(0, n, CHUNK)]
    even = all(1e-15 < p.min() and p.max() < 1e15 for p in peaks)  # safe in float32 as they are
    codes, sides = np.empty((n, TABLES), np.uint32), np.zeros((4096, TABLES, 32), bool)
    wide, ones = codes.view(np.uint64), np.ones(TABLES // 2, np.uint16)

    def coded(round_: int) -> None:
        planes = np.random.default_rng([7, round_]).normal(size=(d, TABLES * k)).astype(np.float32)
        for s in range(0, n, 4096):
            e = min(n, s + 4096)
            u = np.asarray(x[s:e] if even else unit(x[s:e]), np.float32)
            np.greater((u @ planes).reshape(e - s, TABLES, k), 0, out=sides[: e - s, :, :k])
            codes[s:e] = np.packbits(sides[: e - s].reshape(-1)).reshape(e - s, TABLES, 4).view(">u4")[:, :, 0]

    crowded = np.zeros(n, bool)
    for round_ in range(FIRST_TABLES // TABLES):
        coded(round_)
        for t in range(TABLES):
            key = (codes[:, t].astype(np.uint64) << size) | place
            key.sort()
            ends = np.append(np.flatnonzero(np.diff(key >> size)) + 1, n)
            starts = np.append(0, ends[:-1])
            for s, e in zip(*((v[ends - starts >= CROWD]).tolist() for v in (starts, ends)), strict=True):
                crowded[(key[s:e] & low).astype(np.int64)] = True
    dense = np.flatnonzero(crowded)
    link_by_cells(x, dense[dense < own], dense[dense >= own], threshold, forest, within)

    place |= crowded.astype(np.uint64) << size  # in a table's place, crowded rows come last
    code_at = size + np.uint64(1)

    def linked(i: np.ndarray, j: np.ndarray) -> Iterator[np.ndarray]:
        """Numbers of the pairs of rows that are links and not found yet."""
        p, q = np.minimum(i, j), np.maximum(i, j)
        asked = (p < own) & (within | (q >= own))
        p, q = p[asked], q[asked]
        for s in range(0, len(p), CHUNK):
            b, c = p[s : s + CHUNK], q[s : s + CHUNK]
            sides = np.bitwise_count(wide.take(b, axis=0, mode="clip") ^ wide.take(c, axis=0, mode="clip"))
            pair = (b * n + c)[sides @ ones <= most]
            if len(found):
                pair = pair[found.take(np.searchsorted(found, pair), mode="clip") != pair]
            if len(pair):
                yield pair[np.einsum("ij,ij->i", unit(x[pair // n]), unit(x[pair % n])) >= threshold]

    found = np.empty(0, np.int64)
    for round_ in range(tables // TABLES):
        coded(round_)
        parts = [found]
        for t in range(TABLES):
            key = (codes[:, t].astype(np.uint64) << code_at) | place
            key.sort()
            code = key >> code_at
            key &= low
            at = key.view(np.int64)
            same = code[1:] == code[:-1]
            first = np.flatnonzero(same)
            first = first[~crowded[at[first]]]
            for step in range(1, CROWD):  # nearly all places hold few rows
                parts += linked(at[first], at[first + step])
                first = first[: np.searchsorted(first, n - step - 1)]
                first = first[code[first + step + 1] == code[first]]
                if not len(first):
                    break
            if len(first):
                ends = np.append(np.flatnonzero(~same) + 1, n)
                more = ends[np.searchsorted(ends, first, side="right")] - first - CROWD
                upto = np.cumsum(more)
                s = 0
                while s < len(first):
                    e = max(s + 1, int(np.searchsorted(upto, (upto[s - 1] if s else 0) + 4 * CHUNK, side="right")))
                    i = np.repeat(first[s:e], more[s:e])
                    parts += linked(at[i], at[i + CROWD + np.arange(len(i)) - np.repeat(upto[s:e] - more[s:e] - (upto[s - 1] if s else 0), more[s:e])])
                    s = e
        found = np.unique(np.concatenate(parts))
    forest.pairs(found // n, found % n)


def _tasks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """Of each task: the rows of its own block, which come first, and rep, n and vector of all rows. Batches are sorted
    by label, d, i and o."""
    now, parts = None, []

    def ended() -> tuple[int, np.ndarray, np.ndarray, np.ndarray]:
        o, rep, n = (np.concatenate([p[c] for p in parts]) for c in range(3))
        x = np.empty((len(o), now[1]), parts[0][3].dtype)
        end = len(o)
        while parts:  # one part after the other is let go
            part = parts.pop()[3].reshape(-1, now[1])
            x[end - len(part) : end] = unit(part) if x.dtype == np.float64 else part
            end -= len(part)
        return int((o == 0).sum()), rep, n, x

    for batch in batches:
        label, d, i = batch["label"].to_pylist(), batch["d"].to_numpy(), batch["i"].to_numpy()
        new = (np.diff(d) != 0) | (np.diff(i) != 0) | np.array([a != b for a, b in zip(label[1:], label, strict=False)], bool)
        edges = [0, *(np.flatnonzero(new) + 1).tolist(), batch.num_rows]
        for s, e in zip(edges, edges[1:], strict=False):
            if s == e:
                continue
            key = (label[s], int(d[s]), int(i[s]))
            if key != now and parts:
                yield ended()
            now, rows = key, batch.slice(s, e - s)
            parts.append((*(rows[c].to_numpy() for c in ("o", "rep", "n")), rows["x"].flatten().to_numpy()))
    if parts:
        yield ended()


def vector_groups(vectors: DataFrame, threshold: float = 0.93, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", miss: float = MISS) -> DataFrame:
    """One row per vector: vec_id, n_links, component_id, kept."""
    spark = vectors.sparkSession
    kind = vectors.select(vector_col).schema[0].dataType
    single = isinstance(kind, ArrayType) and isinstance(kind.elementType, FloatType)
    v = F.col(vector_col).cast("array<float>" if single else "array<double>")
    usable = F.col(id_col).isNotNull() & F.col(label_col).isNotNull() & F.exists(v, lambda x: x != 0)
    usable &= F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).cast("string").alias("label"), v.alias("x"), F.coalesce(usable, F.lit(False)).alias("usable"))
    key = [F.xxhash64("x").alias("h1"), F.xxhash64(F.lit(7), "x").alias("h2")]  # 128 bits stand for a vector in the last join
    classes = rows.where("usable").groupBy("label", "x").agg(F.min("vec_id").alias("rep"), F.count("*").alias("n"))
    classes = cut(classes.select("label", "rep", "n", "x", F.size("x").alias("d"), *key))

    blocks = []  # of the labels with more than one: blocks, other blocks in a task, place of the first task
    at = rounds = 0
    for label, d, count in classes.groupBy("label", "d").count().where(F.col("count") > min(ALONE, BLOCK)).collect():
        most = max(1, min(BLOCK, BLOCK_BYTES // (d * (4 if single else 8))))
        s = max(3, math.ceil(count / most) // 2 * 2 + 1)  # odd, so that all tasks get as much
        width = min(s // 2, max(1, 2 * most // math.ceil(count / s) - 1))
        blocks.append((label, d, s, width, at))
        at, rounds = at + s, max(rounds, math.ceil(s // 2 / width))
    placed = classes.join(F.broadcast(spark.createDataFrame(blocks, "label string, d int, s int, width int, at int")), ["label", "d"], "left")
    places = max(at, int(spark.conf.get("spark.sql.shuffle.partitions")))
    one = F.col("s").isNull()
    part = F.when(one, 0).otherwise(F.pmod(F.xxhash64("rep", "h1"), F.col("s"))).cast("int")
    place = F.when(one, F.pmod(F.xxhash64("label", "d"), F.lit(places))).otherwise(F.col("at") + F.col("i")).cast("int")

    def dealt(round_: int) -> DataFrame:
        """Rows of block i for task i (o = 0), and those of the o-th block after i; the blocks of a ring meet once."""
        low, high = F.col("width") * round_ + 1, F.least(F.col("width") * (round_ + 1), F.floor(F.col("s") / 2).cast("int"))
        alone = F.array(F.lit(0)) if not round_ else F.array().cast("array<int>")
        to = F.when(one | (low > high), alone).otherwise(F.concat(F.array(F.lit(0)), F.sequence(low, high)))
        out = placed.withColumn("part", part).withColumn("o", F.explode(to))
        out = out.withColumn("i", F.when(one, 0).otherwise(F.pmod(F.col("part") - F.col("o"), F.col("s"))))
        return out.repartitionById(places, place).select("label", "d", "i", "o", "rep", "n", "x").sortWithinPartitions("label", "d", "i", "o")

    def compared(within: bool):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for own, rep, n, x in _tasks(batches):
                if len(rep) < 2:
                    continue
                forest = Forest(n)
                if miss <= 0 or len(rep) <= max(EXACT, EXACT_TABLE * tables_for(len(rep), threshold, miss)[1]):
                    link_by_cells(x, np.arange(own), np.arange(own, len(rep)), threshold, forest, within)
                else:
                    link_by_tables(x, own, threshold, forest, miss, within)
                some = np.flatnonzero(forest.links)
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in (rep[some], forest.links[some].astype(np.int64), rep[forest.find(some)])], ["rep", "links", "root"])

        return run

    found = None
    for round_ in range(max(1, rounds)):
        new = cut(map_batches(dealt(round_), compared(not round_), "rep long, links long, root long"))
        found = new if found is None else found.unionByName(new)
    links = found.groupBy("rep").agg(F.sum("links").alias("links"))
    roots = components(found.select(F.col("rep").alias("a"), F.col("root").alias("b")))
    groups = classes.select("label", "h1", "h2", "rep", "n").join(links, "rep", "left").join(roots.withColumnRenamed("vertex", "rep"), "rep", "left").where("n > 1 OR links IS NOT NULL")
    groups = groups.select("label", "h1", "h2", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"), F.coalesce("root", "rep").alias("component_id"))
    linked = rows.where("usable").select("vec_id", "label", *key).join(groups, ["label", "h1", "h2"], "left")
    linked = linked.select("vec_id", F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"), F.coalesce("component_id", "vec_id").alias("component_id"))
    alone = rows.where("NOT usable").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.unionByName(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


ORACLE_SQL = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, list_transform(embedding, x -> x::DOUBLE) AS x FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id
  WHERE list_cosine_similarity(a.x, b.x) >= 0.93),
reach(a, b) AS (SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
roots AS (SELECT a, least(a, min(b)) AS root FROM reach GROUP BY a),
counts AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT vec_id, coalesce(n, 0) AS n_links, coalesce(root, vec_id) AS component_id, coalesce(root, vec_id) = vec_id AS kept
FROM embeddings LEFT JOIN roots ON roots.a = vec_id LEFT JOIN counts ON counts.a = vec_id
"""
