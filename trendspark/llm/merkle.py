"""A Merkle manifest of a table of documents, with proofs (operator 13).

Method: a postorder append log. Rows are numbered inside their language by distributed prefix sums, and dealt to aligned
builders: one for every 2**LEVELS leaves. A builder appends its leaves in order and writes each inner node the
moment its last child is complete, so its segment of the log is the postorder of its subtree. Where a node stands in a
segment follows from subtree sizes alone (``position``), so the siblings of a proof are addressed in the written log and
nothing is searched. The builders' topmost nodes are the leaves of the next tier, and so on until a language has one
builder; the languages' roots are the leaves of one more tree, built and proved in the same way.

A leaf is H (lowercase hex SHA-256) of doc_id, source, lang, n_chars and text, each ``-`` if null, else its UTF-8 byte
count, ``:`` and its value. Two consecutive nodes become H of their hex digests joined; a last one alone becomes H of its
own. Only digests are shuffled, never texts; a builder holds that many, whatever the size of a language.

Results: leaves ascend by doc_id (without an id first; rows of one id by their leaf, so repeated rows are leaves of equal
value side by side); null and empty texts differ; a language of one document has its leaf as its root; an empty table
gives an empty result; other columns are not read. A count of Long.MaxValue is raised by one without overflow.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trendspark.llm.common import cut, map_batches, reachable
from trendspark.operators.ranking import numbered

#: Levels that one builder completes; it has 2**LEVELS leaves.
LEVELS = 12
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
SIZE = 32


def joined(*digests: bytes) -> bytes:
    """The digest of digests, joined as hex text."""
    return hashlib.sha256(b"".join(digests).hex().encode()).digest()


def height_of(n: int) -> int:
    """Levels above ``n`` leaves."""
    return (n - 1).bit_length() if n else 0


def position(level: int, index: int, n: int) -> int:
    """The place in the postorder log of a tree of ``n`` leaves of the node ``index`` of a level (0: leaves).

    Left of it are the whole subtrees over its first ``m`` leaves, which have ``2m - popcount(m)`` nodes; its own subtree
    ends with it."""
    m = index << level
    own = min(n - m, 1 << level)
    size = 2 * own - 1 if own == 1 << level else sum(-(-own >> k) for k in range(level + 1))
    return 2 * m - m.bit_count() + size - 1


def build(leaves: list[bytes], height: int) -> list[bytes]:
    """The log of a subtree of that height: its nodes in the order in which they are complete."""
    log: list[bytes] = []
    waiting: list[bytes] = [b""] * (height + 1)  # a complete left node of each level
    for i, node in enumerate(leaves):
        log.append(node)
        level = 0
        while level < height and i >> level & 1:
            node = joined(waiting[level], node)
            log.append(node)
            level += 1
        waiting[level] = node
    last = b""  # the node over the leaves that are left, once it is not complete by itself
    for level in range(height):
        left = waiting[level] if len(leaves) >> level & 1 else b""
        if left or last:
            last = joined(left, last)
            log.append(last)
    return log


def siblings(log: list[bytes], n: int, height: int, above: bytes = b"") -> list[bytes]:
    """For each leaf of a segment its siblings, from its own level up, before those ``above``; read from the log by their
    positions."""
    paths = [above]
    for level in range(height - 1, -1, -1):
        width = -(-n >> level)
        other = [log[position(level, i ^ 1, n)] if i ^ 1 < width else b"" for i in range(width)]
        paths = [other[i] + paths[i >> 1] for i in range(width)]
    return paths


def folded(digest: bytes, path: bytes, *trees: tuple[int, int]) -> bytes:
    """The root that a leaf and its siblings give; ``trees``: the leaf's index and the number of leaves, tree by tree."""
    at = 0
    for index, n in trees:
        for level in range(height_of(n)):
            other = b""
            if ((index >> level) ^ 1) << level < n:
                other, at = path[at : at + SIZE], at + SIZE
            digest = joined(other, digest) if index >> level & 1 else joined(digest, other)
    return digest


def leaf_of(n_chars: Column) -> Column:
    """The leaf of a row, in JVM functions."""

    def part(value: Column) -> Column:
        text = value.cast("string")
        return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))

    return F.unhex(F.sha2(F.concat(*[part(n_chars if c == "n_chars" else F.col(c)) for c in FIELDS]), 256))


def leaves(docs: DataFrame) -> DataFrame:
    """doc_id, key (its language: ``n`` for null, else ``v`` and the value, which sort as asked), leaf, and ``altered``,
    the leaf of a tampered row."""
    crc = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    more = F.col("n_chars").cast("decimal(20,0)") + 1
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.concat(F.lit("v"), F.col("lang")), F.lit("n")).alias("key"),
        leaf_of(F.col("n_chars")).alias("leaf"),
        F.when(crc % 7 == 0, leaf_of(more)).alias("altered"),
    )


SEGMENT = "key string, block long, n long, nodes binary"


def segments(nodes: DataFrame, levels: int = LEVELS) -> list[DataFrame]:
    """The log of every tree (``nodes``: key, idx, n, digest), tier by tier: one row (key, block, n leaves of the tree in
    this tier, nodes in postorder) for each aligned builder."""
    reachable(nodes.sparkSession)

    def builder(key: tuple, group: pa.Table) -> pa.Table:
        group = group.sort_by("idx")
        n = group["n"][0].as_py()
        log = build(group["digest"].to_pylist(), min(levels, height_of(n)))
        return pa.table({"key": [key[0].as_py()], "block": [key[1].as_py()], "n": [n], "nodes": pa.array([b"".join(log)], pa.binary())})

    tiers = []
    while True:
        dealt = nodes.select("key", F.shiftright("idx", levels).alias("block"), "idx", "n", "digest")
        tiers.append(cut(dealt.groupBy("key", "block").applyInArrow(builder, SEGMENT)))
        nodes = tiers[-1].where(F.col("n") > 1 << levels).select(
            "key", F.col("block").alias("idx"), F.expr(f"shiftright(n + {(1 << levels) - 1}, {levels})").alias("n"),
            F.expr(f"substring(nodes, length(nodes) - {SIZE - 1}, {SIZE})").alias("digest"))
        if nodes.isEmpty():
            return tiers


def tops(tiers: list[DataFrame], levels: int = LEVELS) -> DataFrame:
    """(key, root) of every tree."""
    last = F.expr(f"substring(nodes, length(nodes) - {SIZE - 1}, {SIZE})").alias("root")
    found = [t.where(F.col("n") <= 1 << levels).select("key", last) for t in tiers]
    out = found[0]
    for t in found[1:]:
        out = out.unionByName(t)
    return out


def nodes_of(row_nodes: bytes, n: int, block: int, levels: int) -> tuple[list[bytes], int, int]:
    """A segment's log, leaves and height."""
    log = [row_nodes[i : i + SIZE] for i in range(0, len(row_nodes), SIZE)]
    return log, min(1 << levels, n - (block << levels)), min(levels, height_of(n))


def with_paths(tiers: list[DataFrame], above: DataFrame, levels: int = LEVELS) -> DataFrame:
    """The segments of the lowest tier with the siblings above them (``path``); ``above``: key and path of each tree, with
    more columns that are carried along."""
    carried = [c for c in above.columns if c not in ("key", "path")]
    schema = f"key string, block long, path binary{''.join(f', {f.name} {f.dataType.simpleString()}' for f in above.schema if f.name in carried)}"

    def expand(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, row in enumerate(batch.to_pylist()):
                log, n, height = nodes_of(row["nodes"], row["n"], row["block"], levels)
                paths = siblings(log, n, height, row["path"])
                start = row["block"] << levels
                ends = [pa.array([row["key"]] * n, pa.string()), pa.array(range(start, start + n), pa.int64()), pa.array(paths, pa.binary())]
                same = [pa.array([row[c]] * n, batch.schema.field(c).type) for c in carried]
                yield pa.RecordBatch.from_arrays([*ends, *same], ["key", "block", "path", *carried])

    below: DataFrame | None = None
    for tier in reversed(tiers):
        # a tree's last tier has one builder, below what stands above the tree
        known = tier.where(F.col("n") <= 1 << levels).join(above, "key")
        if below is not None:
            known = known.unionByName(tier.where(F.col("n") > 1 << levels).join(below, ["key", "block"]))
        if tier is tiers[0]:
            return known
        below = map_batches(known, expand, schema)
    raise ValueError("no tier")


PROOF = "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"


def manifest(docs: DataFrame, levels: int = LEVELS) -> tuple[DataFrame, list[DataFrame], DataFrame]:
    """Of a table: its rows as numbered leaves, the log of its languages' trees, and one row for each language (key, at
    and of: its place among the languages and their number; path: its siblings; subroot; root)."""
    rows = cut(numbered(leaves(docs), ["key"], ["doc_id", "leaf"], "idx", "n"))
    tiers = segments(rows.select("key", "idx", "n", F.col("leaf").alias("digest")), levels)
    langs = tops(tiers, levels).withColumnsRenamed({"key": "name", "root": "digest"}).withColumn("key", F.lit(""))
    langs = cut(numbered(langs, ["key"], ["name"], "idx", "n"))
    upper = segments(langs.select("key", "idx", "n", "digest"), levels)
    whole = tops(upper, levels).select("key", F.lit(b"").alias("path"), "root")

    def paths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                log, n, height = nodes_of(row["nodes"], row["n"], row["block"], levels)
                start = row["block"] << levels
                found = siblings(log, n, height, row["path"])
                yield pa.RecordBatch.from_arrays([pa.array(range(start, start + n), pa.int64()), pa.array(found, pa.binary()), pa.array([row["root"]] * n, pa.binary())], ["idx", "path", "root"])

    proved = map_batches(with_paths(upper, whole, levels), paths, "idx long, path binary, root binary")
    roots = langs.join(proved, "idx").select(
        F.col("name").alias("key"), F.col("idx").alias("at"), F.col("n").alias("of"), "path", F.col("digest").alias("subroot"), "root")
    return rows, tiers, cut(roots)


def proofs(docs: DataFrame, levels: int = LEVELS) -> DataFrame:
    """One row per document: doc_id, leaf, subroot, root, proof_sha256, folded_root, verified."""
    rows, tiers, roots = manifest(docs, levels)
    logs = with_paths(tiers, roots, levels)
    dealt = rows.withColumn("block", F.shiftright("idx", levels))

    def prove(group: pa.Table, log: pa.Table) -> pa.Table:
        out: dict[str, list] = {f.split()[0]: [] for f in PROOF.split(", ")}
        for seg in log.to_pylist():  # one
            found, n, height = nodes_of(seg["nodes"], seg["n"], seg["block"], levels)
            paths = siblings(found, n, height, seg["path"])
            start, subroot, root = seg["block"] << levels, seg["subroot"].hex(), seg["root"].hex()
            for row in group.to_pylist():
                path = paths[row["idx"] - start]
                up = folded(row["altered"] or row["leaf"], path, (row["idx"], seg["n"]), (seg["at"], seg["of"])).hex()
                proof = hashlib.sha256(path.hex().encode()).hexdigest()
                for name, value in zip(out, (row["doc_id"], row["leaf"].hex(), subroot, root, proof, up, up == root), strict=True):
                    out[name].append(value)
        types = (pa.int64(), *[pa.string()] * 5, pa.bool_())
        return pa.table({c: pa.array(v, t) for (c, v), t in zip(out.items(), types, strict=True)})

    return dealt.groupBy("key", "block").cogroup(logs.groupBy("key", "block")).applyInArrow(prove, PROOF)


ORACLE_SQL = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, lang, n_chars, coalesce('v' || lang, 'n') AS k,
    coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id::VARCHAR, '-') || coalesce(strlen(source) || ':' || source, '-') ||
    coalesce(strlen(lang) || ':' || lang, '-') AS head,
    coalesce(strlen(text) || ':' || text, '-') AS tail FROM documents),
l AS (
  SELECT *, sha256(head || coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars::VARCHAR, '-') || tail) AS leaf,
    sha256(head || coalesce(strlen((n_chars + 1)::VARCHAR) || ':' || (n_chars + 1)::VARCHAR, '-') || tail) AS altered,
    xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)),
      lambda a, b: list_reduce(list_prepend(xor(a, b), [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]),
        lambda x, y: CASE WHEN x % 2 = 1 THEN xor(x // 2, 3988292384) ELSE x // 2 END)), 4294967295) AS crc FROM d),
i AS (
  SELECT *, row_number() OVER (PARTITION BY k ORDER BY doc_id NULLS FIRST, leaf) - 1 AS idx, count(*) OVER (PARTITION BY k) AS n FROM l),
tree AS (
  SELECT k, 0 AS lv, idx, n, leaf AS h FROM i
  UNION ALL
  SELECT k, lv + 1, idx // 2, (max(n) + 1) // 2, sha256(string_agg(h, '' ORDER BY idx)) FROM tree WHERE n > 1 GROUP BY k, lv, idx // 2),
subs AS (SELECT k, h AS subroot, row_number() OVER (ORDER BY k) - 1 AS idx, count(*) OVER () AS n FROM tree WHERE n = 1),
up AS (
  SELECT 0 AS lv, idx, n, subroot AS h FROM subs
  UNION ALL
  SELECT lv + 1, idx // 2, (max(n) + 1) // 2, sha256(string_agg(h, '' ORDER BY idx)) FROM up WHERE n > 1 GROUP BY lv, idx // 2),
steps AS (
  SELECT i.k, i.idx, t.lv, CASE WHEN t.idx % 2 = 1 THEN 'L' ELSE 'R' END || coalesce(s.h, '') AS step
  FROM i JOIN tree t ON t.k = i.k AND t.n > 1 AND t.idx = i.idx // (1::BIGINT << t.lv)
  LEFT JOIN tree s ON s.k = t.k AND s.lv = t.lv AND s.idx = xor(t.idx, 1)),
upsteps AS (
  SELECT b.k, list(CASE WHEN t.idx % 2 = 1 THEN 'L' ELSE 'R' END || coalesce(s.h, '') ORDER BY t.lv) AS more
  FROM subs b JOIN up t ON t.n > 1 AND t.idx = b.idx // (1::BIGINT << t.lv)
  LEFT JOIN up s ON s.lv = t.lv AND s.idx = xor(t.idx, 1) GROUP BY b.k),
own AS (SELECT k, idx, list(step ORDER BY lv) AS steps FROM steps GROUP BY k, idx),
p AS (
  SELECT i.*, b.subroot, (SELECT h FROM up WHERE n = 1) AS root,
    list_concat(coalesce(own.steps, []), coalesce(u.more, [])) AS path
  FROM i JOIN subs b USING (k) LEFT JOIN own ON own.k = i.k AND own.idx = i.idx LEFT JOIN upsteps u ON u.k = i.k),
f AS (
  SELECT *, list_reduce(list_prepend(CASE WHEN crc % 7 = 0 THEN altered ELSE leaf END, path),
    lambda a, s: sha256(CASE WHEN s[1] = 'L' THEN s[2:] || a ELSE a || s[2:] END)) AS folded_root FROM p)
SELECT doc_id, leaf, subroot, root, sha256(list_aggregate(list_prepend('', list_transform(path, lambda s: s[2:])), 'string_agg', '')) AS proof_sha256,
  folded_root, folded_root = root AS verified FROM f
"""
