"""A Merkle manifest of a dataset as a content-addressed DAG, with proofs by descent.

Every row is a leaf, the digest of its columns. Within a tree (a language, in the query) the
leaves ascend by identifier and every ``ARITY`` consecutive digests become the digest of
their concatenation, level by level, until one is left; the roots of all trees, ordered by
tree, give the root of the dataset in the same way.

The DAG is stored as records ``digest -> children``. A proof is found from above: a leaf's
request starts at the root with the leaf's rank, takes at every record the child that the
next digit of the rank names, and collects the others; the path read backwards is the proof.
Levels are taken in bands of ``BAND``: the records between a node and its descendants
``BAND`` levels below are one page of at most 1,023 records, read once by all requests that
pass it. What a page's requests collect is a segment; the segments above a page are found
once for the page and not once for each leaf. So a leaf crosses the network once per step
however high its tree is, and a tree with all rows has no larger groups than any other.

Ranks come from a sort by ranges of (tree, order) and sums over its partitions, not from a
window over a tree.

Null: columns of a leaf are marked apart from any value; rows without a tree are a tree of
their own, the first; rows without identifier come first in theirs. Rows that tie in
identifier are ordered by their digests, so repeated rows take neighbouring ranks, and which
of two equal rows has which of their two proofs is open. Texts are hashed whole where they
are read. An empty table has no leaves and no root. Only the named columns are read, under
names of the operator's own.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from kerbside.sources.workspace import stored

ARITY = 2
BAND = 10  # levels of a page

_RESERVED = {"page", "rank", "n", "path", "subroot", "root", "part", "at", "shift", "tie", "seq", "first", "own"}
_RECORDS = "tree string, page long, level int, at long, digest string, children array<string>"
_PATH = "array<struct<left: string, right: string>>"
_MASK = (1 << 33) - 1  # of monotonically_increasing_id: a row's place in its partition


def canonical(value: Column) -> Column:
    """``-`` for null, else the value's length in bytes, a colon and the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(*values: Column) -> Column:
    return F.sha2(F.concat(*map(canonical, values)), 256)


def tree_key(value: Column) -> Column:
    """A string that is never null and orders as ``value`` does, null first."""
    return F.coalesce(F.concat(F.lit("="), value.cast("string")), F.lit(""))


def ranked(leaves: DataFrame, order: Sequence[str]) -> DataFrame:
    """``leaves`` (with ``tree``) with ``rank`` from 0 within the tree, by ``order``, and
    ``n``, the tree's leaves. Written out, so ranks stay when an executor is lost."""
    spark = leaves.sparkSession
    numbered = stored(leaves, "leaves").withColumn("tie", F.monotonically_increasing_id())  # place in the files: stays
    keys = ["tree", *order, "tie"]
    placed = (numbered.repartitionByRange(int(spark.conf.get("spark.sql.shuffle.partitions")), *keys).sortWithinPartitions(*keys)
              .withColumn("seq", F.monotonically_increasing_id()))
    placed = stored(placed.withColumns({"part": F.shiftright("seq", 33), "at": F.col("seq").bitwiseAND(F.lit(_MASK))}).drop("tie", "seq"), "sorted-leaves")
    runs = placed.groupBy("tree", "part").agg(F.min("at").alias("first"), F.count("*").alias("own"))
    before = Window.partitionBy("tree").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.select("tree", "part", (F.coalesce(F.sum("own").over(before), F.lit(0)) - F.col("first")).alias("shift"),
                       F.sum("own").over(Window.partitionBy("tree")).alias("n"))
    return (placed.join(stored(runs, "leaf-runs"), ["tree", "part"])
            .withColumn("rank", F.col("at") + F.col("shift")).drop("part", "at", "shift"))


def height(n: int, arity: int = ARITY) -> int:
    """Levels above ``n`` leaves."""
    levels = 0
    while n > 1:
        n, levels = -(-n // arity), levels + 1
    return levels


def _digest(children: Sequence[str]) -> str:
    return hashlib.sha256("".join(children).encode()).hexdigest()


def _grow(arity: int, band: int) -> Callable[[pa.Table], pa.Table]:
    """The records of one page from its lowest nodes (tree, page, rank, n, digest), where
    ``rank`` and ``n`` count nodes of that level."""
    def grow(nodes: pa.Table) -> pa.Table:
        nodes = nodes.sort_by("rank")
        tree, page, n, start = (nodes.column(c)[0].as_py() for c in ("tree", "page", "n", "rank"))
        row, out = nodes.column("digest").to_pylist(), []
        for level in range(1, min(band, height(n, arity)) + 1):
            runs = [row[i:i + arity] for i in range(0, len(row), arity)]
            row, start = [_digest(run) for run in runs], start // arity
            out += [(level, start + i, digest, run) for i, (digest, run) in enumerate(zip(row, runs, strict=True))]
        levels, places, digests, children = zip(*out, strict=True) if out else ([],) * 4
        return pa.table({"tree": pa.array([tree] * len(out), pa.string()), "page": pa.array([page] * len(out), pa.int64()),
                         "level": pa.array(levels, pa.int32()), "at": pa.array(places, pa.int64()), "digest": pa.array(digests, pa.string()),
                         "children": pa.array(children, pa.list_(pa.string()))})
    return grow


def _descend(arity: int) -> Callable[[pa.Table, pa.Table], pa.Table]:
    """Proofs of one page's requests. The page's records come with one row of level 0: the
    segments above it, its tree's root and the dataset's."""
    def descend(requests: pa.Table, records: pa.Table) -> pa.Table:
        levels = records.column("level").to_pylist()
        (above,) = records.filter(pa.array([level == 0 for level in levels])).select(["path", "subroot", "root"]).to_pylist()
        children = dict(zip(records.column("digest").to_pylist(), records.column("children").to_pylist(), strict=True))  # by content
        depth = max(levels)
        top = records.column("digest")[levels.index(depth)].as_py()
        left, right, ends = [], [], [0]
        for rank, digest in zip(requests.column("rank").to_pylist(), requests.column("digest").to_pylist(), strict=True):
            node, segment = top if depth else digest, []
            for place in reversed(range(depth)):
                digit, run = rank // arity**place % arity, children[node]
                segment.append(("".join(run[:digit]), "".join(run[digit + 1:])))
                node = run[digit]
            if node != digest:
                raise ValueError("the records do not lead to the leaf")
            for before, after in reversed(segment):
                left.append(before)
                right.append(after)
            for step in above["path"]:
                left.append(step["left"])
                right.append(step["right"])
            ends.append(len(left))
        steps = pa.StructArray.from_arrays([pa.array(left, pa.string()), pa.array(right, pa.string())], names=["left", "right"])
        out = requests.append_column("path", pa.ListArray.from_arrays(pa.array(ends, pa.int32()), steps))
        for name in ("subroot", "root"):
            out = out.append_column(name, pa.array([above[name]] * len(requests), pa.string()))
        return out
    return descend


@dataclass
class Dag:
    """Stored levels of a set of trees: ``bands`` holds, from the leaves up, the nodes that
    a band starts from and the records above them; ``roots`` is (tree, digest)."""

    bands: list[tuple[DataFrame, DataFrame]]
    roots: DataFrame
    arity: int
    band: int

    def records(self) -> DataFrame:
        """(digest, children) of every node that is no leaf."""
        out = self.bands[0][1]
        for _, records in self.bands[1:]:
            out = out.unionByName(records)
        return out.select("digest", "children")


def _paged(nodes: DataFrame, width: int) -> DataFrame:
    return nodes.withColumn("page", F.floor(F.col("rank") / F.lit(width)).cast("long"))


def build(leaves: DataFrame, arity: int = ARITY, band: int = BAND) -> Dag:
    """The DAG above ``leaves`` (tree, rank, n, digest, and columns that are kept)."""
    width = arity**band
    bands, roots = [], None
    nodes = _paged(leaves, width)
    while True:
        nodes = stored(nodes, "dag-nodes")
        records = (nodes.select("tree", "page", "rank", "n", "digest").groupBy("tree", "page")
                   .applyInArrow(_grow(arity, band), _RECORDS))
        records = stored(records, "dag-records")
        bands.append((nodes, records))
        # Trees that end in this band: their one page's top, or their only leaf.
        ended = records.join(_ending(nodes, width), "tree", "left_semi").groupBy("tree").agg(F.max_by("digest", "level").alias("digest"))
        ended = ended.unionByName(nodes.filter("n = 1").select("tree", "digest"))
        roots = ended if roots is None else roots.unionByName(ended)
        open_trees = nodes.filter(F.col("n") > width).select("tree", F.ceil(F.col("n") / width).cast("long").alias("n")).distinct()
        if open_trees.isEmpty():
            return Dag(bands, stored(roots, "dag-roots"), arity, band)
        higher = records.filter(F.col("level") == band).join(open_trees, "tree")
        nodes = _paged(higher.select("tree", F.col("at").alias("rank"), "n", "digest"), width)


def _ending(nodes: DataFrame, width: int) -> DataFrame:
    return nodes.filter(F.col("n") <= width).select("tree").distinct()


def proofs(dag: Dag, above: DataFrame) -> DataFrame:
    """Every leaf of ``dag`` with ``path`` (from the leaf up; ``left`` and ``right`` are what
    its run holds beside it), ``subroot`` and ``root``. ``above`` (tree, path, subroot, root)
    is what follows each tree's root."""
    found, entry = None, ["tree", "page", "path", "subroot", "root"]
    for number in reversed(range(len(dag.bands))):
        nodes, records = dag.bands[number]
        # Trees that end in this band are entered from their roots, others page by page.
        entered = above.join(_ending(nodes, dag.arity**dag.band), "tree", "left_semi").withColumn("page", F.lit(0).cast("long")).select(*entry)
        if found is not None:
            entered = entered.unionByName(found.withColumn("page", F.col("rank")).select(*entry))
        pages = records.drop("at").unionByName(entered.withColumn("level", F.lit(0)), allowMissingColumns=True)
        schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in nodes.schema) + f", path {_PATH}, subroot string, root string"
        found = nodes.groupBy("tree", "page").cogroup(pages.groupBy("tree", "page")).applyInArrow(_descend(dag.arity), schema)
        if number:
            found = stored(found, "dag-segments")
    return found


def manifest(leaves: DataFrame, order: Sequence[str], arity: int = ARITY, band: int = BAND) -> tuple[DataFrame, Dag, Dag]:
    """Proofs of ``leaves`` (tree, digest, the columns of ``order`` and others, all kept),
    the DAG of every tree and the DAG of their roots."""
    if taken := _RESERVED & set(leaves.columns):
        raise ValueError(f"columns of these names are the operator's own: {sorted(taken)}")
    trees = build(ranked(leaves, [*order, "digest"]), arity, band)
    whole = build(ranked(trees.roots.select(F.lit("").alias("tree"), F.col("tree").alias("key"), "digest"), ["key"]), arity, band)
    start = whole.roots.select("tree", F.array().cast(_PATH).alias("path"), F.lit("").alias("subroot"), F.col("digest").alias("root"))
    above = stored(proofs(whole, start).select(F.col("key").alias("tree"), "path", F.col("digest").alias("subroot"), "root"), "dag-above")
    return proofs(trees, above).drop("tree", "page", "rank", "n"), trees, whole


def siblings_digest(path: str = "path") -> Column:
    """The digest of all siblings, from the leaf up, left to right."""
    return F.sha2(F.array_join(F.transform(path, lambda step: F.concat(step["left"], step["right"])), ""), 256)


def folded(leaf: str, path: str = "path") -> Column:
    """The root that ``leaf`` and its siblings give."""
    return F.aggregate(path, F.col(leaf), lambda digest, step: F.sha2(F.concat(step["left"], digest, step["right"]), 256))


def documents_leaves(documents: DataFrame, columns: Sequence[str], tree: str, doc_id: str = "doc_id") -> DataFrame:
    """(tree, doc_id, digest) of every row, its digest over ``columns`` in this order."""
    return documents.select(tree_key(F.col(tree)).alias("tree"), F.col(doc_id).alias("doc_id"), leaf_digest(*map(F.col, columns)).alias("digest"))


ORACLE = """
    WITH RECURSIVE fields AS (
        SELECT row_number() OVER () AS row, doc_id, lang,
               coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-')
                 || coalesce(strlen(lang) || ':' || lang, '-') AS head,
               n_chars, coalesce(strlen(text) || ':' || text, '-') AS tail,
               -- CRC-32 bit by bit, lowest bit of every character first
               xor(4294967295, list_reduce([4294967295] || flatten(list_transform(string_split(doc_id::VARCHAR, ''),
                   lambda c: list_transform(range(8), lambda i: (ascii(c) >> i) & 1))),
                   lambda s, b: xor(s >> 1, (xor(s, b) & 1) * 3988292384))) % 7 = 0 AS tampered
        FROM documents),
    leaves AS (
        SELECT row, doc_id, lang, sha256(head || coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-') || tail) AS leaf,
               CASE WHEN tampered THEN sha256(head || coalesce(strlen((n_chars + 1)::VARCHAR) || ':' || (n_chars + 1), '-') || tail) END AS claimed
        FROM fields),
    ranked AS (
        SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS rank, count(*) OVER (PARTITION BY lang) AS n,
               dense_rank() OVER (ORDER BY lang NULLS FIRST) - 1 AS tree
        FROM leaves),
    low AS (
        SELECT tree, 0 AS level, rank AS pos, n, leaf AS digest FROM ranked
        UNION ALL
        SELECT tree, level + 1, pos // 2, (n + 1) // 2, sha256(string_agg(digest, '' ORDER BY pos)) FROM low WHERE n > 1 GROUP BY tree, level, pos // 2, n),
    subroots AS (SELECT tree, digest, count(*) OVER () AS n FROM low WHERE n = 1),
    high AS (
        SELECT 0 AS level, tree AS pos, n, digest FROM subroots
        UNION ALL
        SELECT level + 1, pos // 2, (n + 1) // 2, sha256(string_agg(digest, '' ORDER BY pos)) FROM high WHERE n > 1 GROUP BY level, pos // 2, n),
    climb AS (
        SELECT row, tree, 0 AS level, rank AS pos, n, coalesce(claimed, leaf) AS folded, '' AS siblings FROM ranked
        UNION ALL
        SELECT row, c.tree, c.level + 1, c.pos // 2, (c.n + 1) // 2,
               sha256(CASE WHEN c.pos % 2 = 0 THEN folded || coalesce(s.digest, '') ELSE s.digest || folded END), siblings || coalesce(s.digest, '')
        FROM climb c LEFT JOIN low s ON s.tree = c.tree AND s.level = c.level AND s.pos = xor(c.pos, 1) WHERE c.n > 1),
    ascent AS (
        SELECT row, 0 AS level, c.tree AS pos, s.n, folded, siblings FROM climb c JOIN subroots s ON s.tree = c.tree WHERE c.n = 1
        UNION ALL
        SELECT row, a.level + 1, a.pos // 2, (a.n + 1) // 2,
               sha256(CASE WHEN a.pos % 2 = 0 THEN folded || coalesce(s.digest, '') ELSE s.digest || folded END), siblings || coalesce(s.digest, '')
        FROM ascent a LEFT JOIN high s ON s.level = a.level AND s.pos = xor(a.pos, 1) WHERE a.n > 1)
    SELECT r.doc_id, r.leaf, s.digest AS subroot, t.digest AS root, sha256(siblings) AS proof_sha256, folded AS folded_root, folded = t.digest AS verified
    FROM ranked r JOIN subroots s ON s.tree = r.tree JOIN ascent a ON a.row = r.row AND a.n = 1 JOIN high t ON t.n = 1"""
