"""A Merkle manifest of a dataset with incremental witnesses.

Rows are the leaves of one tree per group; groups' subroots are the leaves of the
top tree.  A leaf is the SHA-256 of its row's fields, a node that of a run of
``RUN`` consecutive nodes (the last run of a level may have fewer, even one).

Nodes are appended in order (``append``).  Every node that is still open keeps
the leaves below it with their partial witnesses, that is the siblings met so
far; when a later sibling completes a run, the witnesses of all of them are
extended by the others and the run becomes one open node of the next level.
Blocks of ``RUN ** LEVELS`` consecutive leaves are streamed by different tasks;
being aligned, the root of a block is an ordinary node, so block roots are
further appends, in blocks again, until one root is left.  A leaf's witness is
its own block's, then that of the block among its likes, and so on.

Places come from a sort by ranges of (group, order), with the lengths of the
ranges summed up afterwards: a group that holds all rows is spread over all tasks,
and no task sees more than a range or a block.  What is joined to the leaves is
one row a block.

Null fields are ``-`` and differ from empty ones; null groups come first, null
keys before others.  Rows with the same key are ordered by their leaf, so equal
rows (or ties) give the same root in any input order.  An empty table gives an
empty manifest; very long texts are hashed where they are read; other columns are
not read, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from forecourt.llm.common import prepare
from forecourt.session import write_scratch

RUN = 2
#: A block has ``RUN ** LEVELS`` leaves.
LEVELS = 8


def field(c: Column | str) -> Column:
    """``-`` for null, else the UTF-8 byte count, ``:`` and the value."""
    c = (F.col(c) if isinstance(c, str) else c).cast("string")
    return F.coalesce(F.concat(F.octet_length(c).cast("string"), F.lit(":"), c), F.lit("-"))


def leaf(*fields: Column | str) -> Column:
    """Lowercase hex SHA-256 of the fields."""
    return F.sha2(F.concat(*[field(c) for c in fields]).cast("binary"), 256)


def node(run: list[str]) -> str:
    return hashlib.sha256("".join(run).encode()).hexdigest()


def siblings_of(witness: bytes) -> list[str]:
    """A witness is stored as its siblings' digests, 32 bytes each."""
    return [witness[i:i + 32].hex() for i in range(0, len(witness), 32)]


class Tree:
    """Open subtrees of a stream of appended nodes, with the witnesses of its leaves.

    ``open[k]`` has the nodes of level k whose run isn't complete: (hash, first leaf,
    end of leaves).  ``witness[i]`` has the siblings' digests of leaf i, from the lowest level up.
    """

    def __init__(self, run: int = RUN):
        self.run, self.open, self.witness = run, [[]], []

    def append(self, leaf: str) -> None:
        i = len(self.witness)
        self.witness.append(bytearray())
        self._put(0, (leaf, i, i + 1))

    def _put(self, level: int, entry: tuple[str, int, int]) -> None:
        if level == len(self.open):
            self.open.append([])
        self.open[level].append(entry)
        if len(self.open[level]) == self.run:
            self._complete(level)

    def _complete(self, level: int) -> None:
        """The open run of a level becomes a node of the next; witnesses below it grow."""
        run, self.open[level] = self.open[level], []
        for k, (_, a, b) in enumerate(run):
            others = b"".join(bytes.fromhex(h) for j, (h, _, _) in enumerate(run) if j != k)
            if others:
                for i in range(a, b):
                    self.witness[i] += others
        self._put(level + 1, (node([h for h, _, _ in run]), run[0][1], run[-1][2]))

    def close(self, levels: int | None) -> str:
        """The root: ``levels`` levels up, or where one node is left."""
        level = 0
        while level < levels if levels is not None else sum(map(len, self.open)) > 1:
            if self.open[level]:
                self._complete(level)
            level += 1
        return next(e[0] for entries in self.open for e in entries)


def fold(leaf: str, place: int, size: int, witness: list[str], run: int = RUN) -> tuple[str, int]:
    """The root of a tree of ``size`` leaves from one leaf and its siblings, and how many were used."""
    used = 0
    while size > 1:
        first = place - place % run
        others = min(run, size - first) - 1
        siblings = witness[used:used + others]
        leaf = node([*siblings[:place - first], leaf, *siblings[place - first:]])
        used += others
        place, size = place // run, -(-size // run)
    return leaf, used


# ------------------------------------------------------------------ places
def numbered(leaves: DataFrame, order: list[str]) -> DataFrame:
    """``leaves`` (with ``grp``) and, per group in ``order``, ``place`` from 0 and ``size``.

    Ranges of (grp, order) are sorted and numbered each by its own task; what
    stands before a range is summed over one row per range and group.  ``leaves`` is
    read twice (for the ranges and for the sort).
    """
    keys = ["grp", *order]
    dealt = leaves.repartitionByRange(*keys).sortWithinPartitions(*keys)
    schema = dealt.schema.simpleString()[len("struct<"):-1] + ",part int,nth bigint"

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, last, nth = TaskContext.get().partitionId(), object(), 0
        for batch in batches:
            found = []
            for g in batch.column("grp").to_pylist():
                nth = nth + 1 if g == last else 0
                last = g
                found.append(nth)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array([part] * len(found), pa.int32()), pa.array(found, pa.int64())],
                names=[*batch.schema.names, "part", "nth"])

    spark = leaves.sparkSession
    stored = spark.read.parquet(write_scratch(dealt.mapInArrow(number, schema), "merkle-places"))
    ranges = stored.groupBy("grp", "part").agg(F.count("*").alias("rows"))
    before = Window.partitionBy("grp").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    ranges = ranges.select(F.col("grp").alias("g"), F.col("part").alias("p"),
                           F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("skipped"),
                           F.sum("rows").over(Window.partitionBy("grp")).alias("size"))
    joined = stored.join(ranges, F.col("grp").eqNullSafe(F.col("g")) & (F.col("part") == F.col("p")))
    return joined.select(*leaves.columns, (F.col("nth") + F.col("skipped")).alias("place"), "size")


# --------------------------------------------------------------- witnesses
def streamed(nodes: DataFrame, run: int, levels: int) -> DataFrame:
    """(grp, place, size, witness, root) of all nodes within their blocks, and the
    columns that ``nodes`` has besides; ``root`` is given with a block's first node only."""
    block = F.expr(f"place div {run ** levels}")
    dealt = nodes.withColumn("block", block)
    dealt = dealt.repartition("grp", "block").sortWithinPartitions("grp", "block", "place")
    schema = dealt.schema.simpleString()[len("struct<"):-1] + ",witness binary,root string"
    names = [*dealt.columns, "witness", "root"]

    def finish(tree: Tree, batches: list[pa.RecordBatch], whole: bool) -> pa.RecordBatch:
        root = tree.close(None if whole else levels)
        table = pa.Table.from_batches(batches).combine_chunks().to_batches()[0]
        return pa.RecordBatch.from_arrays(
            [*table.columns, pa.array(map(bytes, tree.witness), pa.binary()),
             pa.array([root] + [None] * (table.num_rows - 1), pa.string())], names=names)

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree, held, current, whole = Tree(run), [], None, True
        for batch in batches:
            keys = list(zip(batch.column("grp").to_pylist(), batch.column("block").to_pylist()))
            hashes, sizes, start = batch.column("leaf").to_pylist(), batch.column("size"), 0
            for i, key in enumerate(keys):
                if key != current:
                    if i > start:
                        held.append(batch.slice(start, i - start))
                    if held:
                        yield finish(tree, held, whole)
                    tree, held, current, start = Tree(run), [], key, i
                    whole = sizes[i].as_py() <= run ** levels
                tree.append(hashes[i])
            if start < len(keys):
                held.append(batch.slice(start))
        if held:
            yield finish(tree, held, whole)

    return dealt.mapInArrow(stream, schema)


def witnesses(nodes: DataFrame, ends: Callable[[DataFrame], DataFrame], run: int = RUN, levels: int = LEVELS) -> DataFrame:
    """``nodes`` (grp, leaf, place, size, ...) with ``witness`` and what else ``ends`` gives.

    ``ends`` gets (grp, root) and returns one row a group: (grp, witness from the group's root
    on, ...).  It meets the nodes where a group is one block and comes down block by block,
    so a group's rows are never joined by the group alone."""
    spark = nodes.sparkSession
    found = spark.read.parquet(write_scratch(streamed(nodes, run, levels), "merkle-blocks"))
    roots = found.where("root IS NOT NULL").select(
        "grp", F.col("root").alias("leaf"), F.col("block").alias("place"),
        F.expr(f"(size + {run ** levels - 1}) div {run ** levels}").alias("size"))
    if roots.where("size > 1").isEmpty():
        above = ends(roots.select("grp", F.col("leaf").alias("root"))).withColumn("place", F.lit(0).cast("long"))
    else:
        above = witnesses(roots, ends, run, levels).drop("leaf", "size")
    info = [c for c in above.columns if c not in ("grp", "place", "witness")]
    above = above.select(F.col("grp").alias("_grp"), F.col("place").alias("_block"), F.col("witness").alias("_more"),
                         *[F.col(c).alias(f"_{c}") for c in info])
    joined = found.join(above, F.col("grp").eqNullSafe(F.col("_grp")) & (F.col("block") == F.col("_block")))
    return joined.select(*nodes.columns, F.concat("witness", "_more").alias("witness"), *[F.col(f"_{c}").alias(c) for c in info])


def manifest(docs: DataFrame, group: str, key: str, fields: list[str], claimed: Column | None = None,
             run: int = RUN, levels: int = LEVELS) -> DataFrame:
    """One row per row of ``docs``: key, grp, leaf (of ``fields``), claimed, place and size in
    the group, subroot, group_place and groups (how many), root, and proof (the siblings
    from the leaf's run to the root).  ``claimed`` is a leaf to verify instead of the own
    one (null: none)."""
    spark = docs.sparkSession
    prepare(spark)
    quoted = [F.col(f"`{c}`") for c in (group, key, *fields)]
    leaves = docs.select(quoted[0].cast("string").alias("grp"), quoted[1].alias("key"), leaf(*quoted[2:]).alias("leaf"),
                         (F.lit(None).cast("string") if claimed is None else claimed).alias("claimed"))
    leaves = spark.read.parquet(write_scratch(leaves, "merkle-leaves"))

    def top(subroots: DataFrame) -> DataFrame:
        """One row a group, by the tree of the groups."""
        names = subroots.select(F.lit(None).cast("string").alias("grp"), F.col("grp").alias("name"), F.col("root").alias("leaf"))
        tree = witnesses(numbered(names, ["name"]), lambda whole: whole.select("grp", F.lit(b"").alias("witness"), "root"), run, levels)
        return tree.select(F.col("name").alias("grp"), "witness", F.col("leaf").alias("subroot"), F.col("place").alias("group_place"),
                           F.col("size").alias("groups"), "root")

    found = witnesses(numbered(leaves, ["key", "leaf"]), top, run, levels)
    return found.select("key", "grp", "leaf", "claimed", "place", "size", "subroot", "group_place", "groups", "root",
                        F.col("witness").alias("proof"))


def verify(found: DataFrame, run: int = RUN) -> DataFrame:
    """``found`` (of ``manifest``) with ``proof_sha256`` (of the siblings) and ``folded_root``
    (from the claimed leaf, else the leaf) instead of ``proof``."""
    rest = [c for c in found.columns if c != "proof"]
    schema = found.select(*rest).schema.simpleString()[len("struct<"):-1] + ",proof_sha256 string,folded_root string"

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            digests, folded = [], []
            for own, other, place, size, above, groups, proof in zip(*(batch.column(c).to_pylist() for c in (
                    "leaf", "claimed", "place", "size", "group_place", "groups", "proof"))):
                siblings = siblings_of(proof)
                digests.append(node(siblings))
                sub, used = fold(other or own, place, size, siblings, run)
                folded.append(fold(sub, above, groups, siblings[used:], run)[0])
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in rest), pa.array(digests, pa.string()), pa.array(folded, pa.string())],
                names=[*rest, "proof_sha256", "folded_root"])

    return found.mapInArrow(check, schema)
