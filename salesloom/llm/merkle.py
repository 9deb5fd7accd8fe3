"""Merkle manifest of a table with proofs and folding (operator 11).

Rows are leaves. Each group's leaves ascend by their order columns; while a group has several nodes, every FANOUT consecutive ones
(the last run may hold fewer, even one) become the SHA-256 of their digests, written as hex text. The groups' roots are the leaves of
one more tree of the same kind, whose root stands for the table.

Midstates: a parent keeps a copy of its hash state before each child slot (`Parent.before`). A changed child is folded by
resuming the state of its slot with the new digest and the siblings to its right; what lies to the left is not hashed again.

Distribution: leaves are dealt by ranges of (group, order), so no group has to fit into a task, and get their rank from counts per
range. BLOCK consecutive nodes of a group are one row of a written table (a subtree of several levels); their tops are the nodes of
the next, BLOCK times smaller table, until every group has one node. Then the way back: each block joins its top's
siblings in the levels above, and every leaf is folded to the root through the kept states of its block and of the levels above. To
the driver comes only the largest node count.

Defined cases: a null group is a group of its own and comes first; groups are ordered by their UTF-8 bytes; null order values come first;
rows that repeat the order columns are ordered by their leaf, equal ones are separate leaves; an empty table gives an empty table; extra
columns are left behind.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from salesloom.llm.common import written

FANOUT = 2
# Nodes of a block: a power of the fan-out. A block is one row of at most BLOCK * 200 bytes.
BLOCK = 64

STEPS = pa.list_(pa.struct([("left", pa.string()), ("right", pa.string())]))


class Parent:
    """A node with its children's digests and the hash states before each child slot."""

    __slots__ = ("children", "before", "digest")

    def __init__(self, children: list[str]):
        self.children, self.before = children, []
        state = hashlib.sha256()
        for child in children:
            self.before.append(state.copy())
            state.update(child.encode())
        self.digest = state.hexdigest()

    def folded(self, slot: int, digest: str) -> str:
        """Digest of this node with another child in the slot."""
        state = self.before[slot].copy()
        state.update(digest.encode())
        for sibling in self.children[slot + 1 :]:
            state.update(sibling.encode())
        return state.hexdigest()


def levels_of(digests: list[str], nodes: int, fanout: int, block: int) -> list[list[Parent]]:
    """The levels over a block of digests, lowest first. `nodes` is the number of nodes of the group at the block's level.

    Levels end with the block's top: a full block has a fixed number of them, and a group is done when it has one node."""
    levels, held, span = [], digests, 1
    while span < block and nodes > 1:
        parents = [Parent(held[k : k + fanout]) for k in range(0, len(held), fanout)]
        levels.append(parents)
        held, span, nodes = [p.digest for p in parents], span * fanout, -(-nodes // fanout)
    return levels


def top_of(digests: list[str], levels: list[list[Parent]]) -> str:
    return levels[-1][0].digest if levels else digests[0]


def way_of(place: int, levels: list[list[Parent]], fanout: int) -> Iterator[tuple[Parent, int]]:
    """Parents above a place of the block, lowest first, with the slot that the way passes."""
    for parents in levels:
        place, slot = divmod(place, fanout)
        yield parents[place], slot


@dataclass(frozen=True)
class Shape:
    fanout: int = FANOUT
    block: int = BLOCK

    def __post_init__(self) -> None:
        span = self.fanout
        while span < self.block:
            span *= self.fanout
        if self.fanout < 2 or span != self.block:
            raise ValueError("block must be a power of the fan-out")


def hashed_fields(*fields: Column) -> Column:
    """SHA-256 over fields: `-` for null, else byte count, colon and value."""
    parts = [F.coalesce(F.concat(F.octet_length(f).cast("string"), F.lit(":"), f), F.lit("-")) for f in fields]
    return F.sha2(F.concat(*parts), 256)


def ranked(nodes: DataFrame, group: str, order: list[str], name: str) -> DataFrame:
    """Add pos (rank inside the group, from 0) and n (rows of the group); no group has to fit into one task."""
    keys = [F.col(c).asc_nulls_first() for c in (group, *order)]
    columns = nodes.columns
    schema = nodes.schema
    at = columns.index(group)

    def numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, count = None, 0
        for batch in batches:
            places = []
            for value in batch.column(at).to_pylist():
                held, count = (held, count + 1) if value == held else (value, 0)
                places.append(count)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(places, pa.int64())], [*columns, "place__"])

    # The range of a row is written with it: a repeated task must not move rows behind the counts.
    dealt = nodes.repartitionByRange(*keys).sortWithinPartitions(*keys)
    dealt = dealt.mapInArrow(numbered, f"{schema.simpleString()[7:-1]},place__:bigint").withColumn("range__", F.spark_partition_id())
    placed = written(dealt, f"{name}-ranges")
    counts = placed.groupBy(group, "range__").agg(F.count("*").alias("rows__"))
    before = Window.partitionBy(group).orderBy("range__").rowsBetween(Window.unboundedPreceding, -1)
    # One row for each group and range: as many as there are tasks, and one more a group.
    offsets = counts.select(
        group, "range__", F.coalesce(F.sum("rows__").over(before), F.lit(0)).alias("offset__"), F.sum("rows__").over(Window.partitionBy(group)).alias("n")
    )
    offsets = written(offsets, f"{name}-offsets")
    return placed.join(offsets, [group, "range__"]).select(*columns, (F.col("place__") + F.col("offset__")).alias("pos"), "n")


def blocks_of(nodes: DataFrame, shape: Shape, name: str) -> DataFrame:
    """One row for each block of a group: group, pos (of the block), n (nodes of the group), members in order, top.

    nodes: group, pos, n, digest and, where given, more columns that stay with the node."""
    more = [c for c in nodes.columns if c not in ("group", "pos", "n")]
    gathered = nodes.groupBy("group", F.floor(F.col("pos") / shape.block).alias("pos"), "n").agg(
        F.sort_array(F.collect_list(F.struct("pos", *more))).alias("members")
    )
    schema = f"{gathered.schema.simpleString()[7:-1]},top:string"

    def topped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            tops = []
            for n, members in zip(batch.column("n").to_pylist(), batch.column("members")):
                digests = pa.array(members.values).field("digest").to_pylist()
                tops.append(top_of(digests, levels_of(digests, n, shape.fanout, shape.block)))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(tops, pa.string())], [*batch.schema.names, "top"])

    return written(gathered.mapInArrow(topped, schema), name)


def grown(leaves: DataFrame, shape: Shape, name: str) -> list[DataFrame]:
    """Tables of blocks, lowest first; in the last one every group is one block."""
    tables = [blocks_of(leaves, shape, f"{name}-0")]
    most = tables[0].agg(F.max("n")).first()[0] or 0
    while most > shape.block:
        nodes = tables[-1].select("group", "pos", F.ceil(F.col("n") / shape.block).alias("n"), F.col("top").alias("digest"))
        tables.append(blocks_of(nodes, shape, f"{name}-{len(tables)}"))
        most = -(-most // shape.block)
    return tables


def roots(tables: list[DataFrame]) -> DataFrame:
    """group and root of each group."""
    return tables[-1].select("group", F.col("top").alias("root"))


def _steps(place: int, levels: list[list[Parent]], fanout: int) -> list[dict]:
    found = []
    for parent, slot in way_of(place, levels, fanout):
        found.append({"left": "".join(parent.children[:slot]), "right": "".join(parent.children[slot + 1 :])})
    return found


def _above(block_table: DataFrame, steps: DataFrame, shape: Shape) -> DataFrame:
    """Siblings on the way up of every member of the blocks: those inside the block, then those above it."""

    def member_steps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            groups, places, found = [], [], []
            for row in batch.to_pylist():
                digests = [m["digest"] for m in row["members"]]
                levels = levels_of(digests, row["n"], shape.fanout, shape.block)
                for k, member in enumerate(row["members"]):
                    groups.append(row["group"])
                    places.append(member["pos"])
                    found.append(_steps(k, levels, shape.fanout) + row["steps"])
            yield pa.RecordBatch.from_arrays(
                [pa.array(groups, pa.string()), pa.array(places, pa.int64()), pa.array(found, STEPS)], ["group", "pos", "steps"]
            )

    joined = block_table.join(steps, ["group", "pos"]).select("group", "n", "members", "steps")
    return joined.mapInArrow(member_steps, "group string, pos bigint, steps array<struct<left:string,right:string>>")


def descended(tables: list[DataFrame], steps: DataFrame, shape: Shape) -> DataFrame:
    """Each lowest block with the siblings above it, given those above each group (group, pos 0, steps)."""
    for block_table in reversed(tables[1:]):
        steps = _above(block_table, steps, shape)
    return tables[0].join(steps, ["group", "pos"])


def manifest(rows: DataFrame, group: Column, order: Column, leaf: Column, changed: Column, shape: Shape = Shape()) -> DataFrame:
    """id, leaf, subroot, root, proof_sha256, folded_root and verified of every row.

    order is the id by which leaves ascend. changed is the leaf that is folded to the root in place of the row's own (null: the own)."""
    # Groups as text that sorts null first and then by UTF-8 bytes.
    named = F.coalesce(F.concat(F.lit("="), group.cast("string")), F.lit(""))
    leaves = rows.select(named.alias("group"), order.alias("id"), leaf.alias("digest"), changed.alias("changed"))
    tables = grown(ranked(leaves, "group", ["id", "digest", "changed"], "leaves"), shape, "merkle")
    # The tree over the groups' roots.
    tops = roots(tables).select(F.lit("").alias("group"), F.col("group").alias("member"), F.col("root").alias("digest"))
    top_tables = grown(ranked(tops, "group", ["member"], "tops"), shape, "merkle-top")
    no_steps = F.array().cast("array<struct<left:string,right:string>>")
    start = roots(top_tables).select("group", F.lit(0).cast("bigint").alias("pos"), no_steps.alias("steps"))
    upper = descended(top_tables, start, shape).join(roots(top_tables).withColumnRenamed("root", "table_root"), "group")

    def per_group(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, subroots, found, table_roots = [], [], [], []
            for row in batch.to_pylist():
                digests = [m["digest"] for m in row["members"]]
                levels = levels_of(digests, row["n"], shape.fanout, shape.block)
                for k, member in enumerate(row["members"]):
                    names.append(member["member"])
                    subroots.append(member["digest"])
                    table_roots.append(row["table_root"])
                    found.append(_steps(k, levels, shape.fanout) + row["steps"])
            yield pa.RecordBatch.from_arrays(
                [pa.array(names, pa.string()), pa.array(subroots, pa.string()), pa.array(table_roots, pa.string()), pa.array(found, STEPS)],
                ["group", "subroot", "table_root", "steps"],
            )

    groups = upper.select("n", "members", "steps", "table_root").mapInArrow(
        per_group, "group string, subroot string, table_root string, steps array<struct<left:string,right:string>>"
    )
    groups = written(groups, "merkle-groups")
    blocks = descended(tables, groups.select("group", F.lit(0).cast("bigint").alias("pos"), "steps"), shape)
    blocks = blocks.join(groups.drop("steps"), "group").select("n", "members", "steps", "subroot", "table_root")
    id_type = rows.select(order.alias("id")).schema["id"].dataType
    out = f"id {id_type.simpleString()}, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"

    def folded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, found = [], []
            for row in batch.to_pylist():
                members = row["members"]
                levels = levels_of([m["digest"] for m in members], row["n"], shape.fanout, shape.block)
                # The states above the block serve all its leaves: before the slot, and what comes behind it.
                above = [(hashlib.sha256(s["left"].encode()), s["right"].encode()) for s in row["steps"]]
                tail = "".join(s["left"] + s["right"] for s in row["steps"]).encode()
                for k, member in enumerate(members):
                    digest = member["changed"] or member["digest"]
                    proof = hashlib.sha256()
                    for parent, slot in way_of(k, levels, shape.fanout):
                        proof.update("".join(c for s, c in enumerate(parent.children) if s != slot).encode())
                        digest = parent.folded(slot, digest)
                    proof.update(tail)
                    for state, behind in above:
                        resumed = state.copy()
                        resumed.update(digest.encode() + behind)
                        digest = resumed.hexdigest()
                    ids.append(member["id"])
                    found.append((member["digest"], row["subroot"], row["table_root"], proof.hexdigest(), digest, digest == row["table_root"]))
            columns = list(zip(*found)) if found else [[]] * 6
            kinds = [pa.string()] * 5 + [pa.bool_()]
            id_kind = batch.schema.field("members").type.value_type.field("id").type
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, id_kind), *(pa.array(list(c), k) for c, k in zip(columns, kinds))],
                ["id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"],
            )

    return blocks.mapInArrow(folded, out)
