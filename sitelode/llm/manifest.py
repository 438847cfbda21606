"""Merkle manifest of a table by butterfly exchange.

Every row is a leaf. The leaves of a group, in order, are cut into aligned blocks of
``fanout ** levels``; a block hashes its own subtree. Then blocks meet in rounds: in round r
those whose numbers differ only in digit r (to the base of the fanout) swap the roots of
the subtrees they have so far, and each hashes the parent for itself. After the last round every
block holds the root of its group and all siblings on the way there, so nothing is sent down again.
The roots of the groups are the leaves of one more tree, built alike.

An incomplete subtree at the end has fewer blocks than its neighbours; its blocks then serve
several lanes each, so every block of the neighbours finds a partner. A lane never
holds more than ``fanout`` rows, whatever the size of a group.
"""

from __future__ import annotations

from dataclasses import dataclass
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.ranking import positions
from ..session import cut_lineage

_PROOFS = "array<struct<left:string,right:string>>"
#: Blocks that share one copy of their group's row.
_SHARED = 1024


@dataclass(frozen=True)
class Shape:
    #: Consecutive nodes that become one.
    fanout: int = 3
    #: Levels inside a block: it holds at most ``fanout ** levels`` leaves.
    levels: int = 6

    @property
    def leaves(self) -> int:
        return self.fanout**self.levels


def record(*fields: Column) -> Column:
    """Fields as one text that no other fields give: ``-`` for null, else the UTF-8 length, ``:`` and the value."""
    parts = []
    for field in fields:
        value = field.cast("string")
        parts.append(F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-")))
    return F.concat(*parts)


def digest(text: Column) -> Column:
    """Lowercase hex SHA-256."""
    return F.sha2(text, 256)


def proof_digest(proof: Column) -> Column:
    """One digest of all siblings of a proof, from the leaf up and from left to right."""
    return digest(F.array_join(F.transform(proof, lambda p: F.concat(p["left"], p["right"])), ""))


def folded(leaf: Column, proof: Column) -> Column:
    """The root that a leaf gives with the siblings of a proof."""
    return F.aggregate(proof, leaf, lambda node, p: digest(F.concat(p["left"], node, p["right"])))


def _parents(nodes: list[str], fanout: int) -> list[str]:
    runs = ("".join(nodes[i : i + fanout]) for i in range(0, len(nodes), fanout))
    return [sha256(run.encode()).hexdigest() for run in runs]


def _levels(nodes: list[str], shape: Shape, alone: bool) -> list[list[str]]:
    """Nodes of a block by level, the last level being its root. A block that is not alone has all levels."""
    levels = [nodes]
    while len(levels[-1]) > 1 or (not alone and len(levels) <= shape.levels):
        levels.append(_parents(levels[-1], shape.fanout))
    return levels


def _block_root(nodes: Column, alone: Column, shape: Shape) -> Column:
    @F.arrow_udf("string")
    def of(blocks: pa.Array, single: pa.Array) -> pa.Array:
        pairs = zip(blocks.to_pylist(), single.to_pylist(), strict=True)
        return pa.array([_levels(nodes, shape, one)[-1][0] for nodes, one in pairs], pa.string())

    return of(nodes, alone)


def _inner_proofs(nodes: Column, alone: Column, shape: Shape) -> Column:
    """For each leaf of a block, its siblings inside the block."""

    @F.arrow_udf(f"array<{_PROOFS}>")
    def of(blocks: pa.Array, single: pa.Array) -> pa.Array:
        entry = pa.list_(pa.list_(pa.struct([("left", pa.string()), ("right", pa.string())])))
        out = []
        for nodes, one in zip(blocks.to_pylist(), single.to_pylist(), strict=True):
            levels = _levels(nodes, shape, one)[:-1]
            proofs = []
            for i in range(len(nodes)):
                proof = []
                for level in levels:
                    first = i - i % shape.fanout
                    right = "".join(level[i + 1 : first + shape.fanout])
                    proof.append({"left": "".join(level[first:i]), "right": right})
                    i //= shape.fanout
                proofs.append(proof)
            out.append(proofs)
        return pa.array(out, entry)

    return of(nodes, alone)


def _exchange(state: DataFrame, round_: int, shape: Shape) -> DataFrame:
    """One round: lanes of at most ``fanout`` subtrees swap roots, and each block hashes their parent."""
    stride = shape.fanout**round_
    blocks, block = F.col("blocks"), F.col("block")
    done = blocks <= stride
    child = F.floor(block / stride) if stride > 1 else block
    lane = block % stride
    width = F.least(F.lit(stride), blocks - child * stride)
    # An incomplete subtree with neighbours serves all of their lanes.
    serves = ~done & (width < stride) & (child % shape.fanout > 0)
    lanes = F.when(serves, F.sequence(lane, F.lit(stride - 1).cast("bigint"), width)).otherwise(F.array(lane))
    sent = (
        state.withColumns({"child": child, "own": lane, "done": done, "lane": lanes})
        .withColumn("lane", F.explode("lane"))
        .withColumn("own", F.col("own") == F.col("lane"))
    )
    # What only serves another lane leaves its own proof at home.
    proof = F.when(F.col("own"), F.col("proof")).otherwise(F.array().cast(_PROOFS))
    member = F.struct("child", "block", "own", "node", proof.alias("proof"))
    parent = F.floor(F.col("child") / shape.fanout).alias("parent")
    met = sent.groupBy("group", "blocks", "done", parent, "lane").agg(F.sort_array(F.collect_list(member)).alias("members"))
    nodes = F.transform("members", lambda m: m["node"])
    node = F.when(F.col("done"), nodes[0]).otherwise(digest(F.array_join(nodes, "")))
    held = met.select("group", "blocks", "done", nodes.alias("nodes"), node.alias("node"), F.posexplode("members").alias("at", "m"))
    left = F.array_join(F.slice("nodes", F.lit(1), F.col("at")), "")
    right = F.array_join(F.slice("nodes", F.col("at") + 2, F.lit(shape.fanout)), "")
    step = F.array(F.struct(left.alias("left"), right.alias("right")))
    return held.where("m.own").select(
        "group", F.col("m.block").alias("block"), "blocks", "node",
        F.when(F.col("done"), F.col("m.proof")).otherwise(F.concat("m.proof", step)).alias("proof"),
    )


def _with_group(blocks: DataFrame, groups: DataFrame) -> DataFrame:
    """Join each block to its group's row, which is copied once for every ``_SHARED`` blocks of a large group."""
    parts = F.sequence(F.lit(0).cast("bigint"), F.floor((F.col("blocks") - 1) / _SHARED))
    copies = groups.withColumn("part", F.explode(parts))
    return blocks.withColumn("part", F.floor(F.col("block") / _SHARED)).join(copies, ["group", "part"]).drop("part")


def tree(leaves: DataFrame, order: list[str], shape: Shape | None = None) -> DataFrame:
    """The tree of each ``group`` over its ``node`` texts, one row a block.

    ``leaves`` holds ``group`` (not null), ``node`` and the columns of ``order``; the rest travels along.
    Returns ``group, block, blocks, members`` (the block's rows in order), ``root`` (of the group) and ``proof``
    (siblings above the block). Rows equal in ``order`` stand by ``node``. No leaves, no rows.
    """
    shape = shape or Shape()
    placed = positions(leaves, ["group"], [*order, "node"], "pos")
    rest = [c for c in leaves.columns if c != "group"]
    number = F.floor((F.col("pos") - 1) / shape.leaves).alias("block")
    blocks = placed.groupBy("group", number).agg(F.sort_array(F.collect_list(F.struct("pos", *rest))).alias("members"))
    blocks = cut_lineage(blocks)
    counts = blocks.groupBy("group").agg((F.max("block") + 1).alias("blocks"))
    counted = cut_lineage(_with_group(blocks, counts))
    nodes = F.transform("members", lambda m: m["node"])
    state = counted.select(
        "group", "block", "blocks", _block_root(nodes, F.col("blocks") == 1, shape).alias("node"),
        F.array().cast(_PROOFS).alias("proof"),
    )
    most = state.agg(F.max("blocks")).first()[0] or 0
    round_ = 0
    while shape.fanout**round_ < most:
        state = _exchange(state, round_, shape)
        round_ += 1
    reached = state.select("group", "block", F.col("node").alias("root"), "proof")
    return cut_lineage(counted.join(reached, ["group", "block"]))


def proofs(blocks: DataFrame, above: list[str], shape: Shape | None = None) -> DataFrame:
    """One row per leaf of :func:`tree`: the columns of its members, ``above`` and its whole ``proof`` to the root."""
    shape = shape or Shape()
    nodes = F.transform("members", lambda m: m["node"])
    inner = _inner_proofs(nodes, F.col("blocks") == 1, shape)
    opened = blocks.select(*above, F.col("proof").alias("_above"), F.explode(F.arrays_zip("members", inner.alias("inner"))).alias("_leaf"))
    return opened.select(*above, "_leaf.members.*", F.concat("_leaf.inner", "_above").alias("proof"))


def manifest(rows: DataFrame, key: str, group: str, fields: list[str], carry: dict[str, Column] | None = None, shape: Shape | None = None) -> DataFrame:
    """Leaf, subroot, root and proof of every row: a tree for each ``group`` by ``key``, and one over the groups.

    Returns ``key``, ``group`` (the given column), ``leaf``, ``subroot``, ``root``, ``proof`` and the columns of ``carry``,
    which are computed from the row while its leaf is. Nulls: a null field is hashed as ``-``; null keys stand
    first in their group, null groups are a group that stands first. Rows with one key stand by leaf, so repeated rows
    are leaves of their own with equal digests. A lone leaf is its subroot, a lone subroot the root. No rows, no result.
    """
    shape = shape or Shape()
    carry = carry or {}
    named = F.coalesce(F.concat(F.lit("="), F.col(group).cast("string")), F.lit(""))
    leaves = rows.select(
        named.alias("group"), F.col(key).alias("key"), digest(record(*[F.col(f) for f in fields])).alias("node"),
        F.struct(F.col(group).alias("group"), *[c.alias(n) for n, c in carry.items()]).alias("carried"),
    )
    # Texts are hashed once: dealing leaves out by range reads them twice.
    by_group = tree(cut_lineage(leaves), ["key"], shape)
    subroots = by_group.where("block = 0").select(
        F.lit(0).alias("group"), F.col("group").alias("name"), F.col("root").alias("node"), F.col("blocks").alias("of_blocks")
    )
    top = proofs(tree(subroots, ["name"], shape), ["root"], shape)
    upper = top.select(
        F.col("name").alias("group"), F.col("of_blocks").alias("blocks"), F.col("root").alias("top"), F.col("proof").alias("upper")
    )
    joined = _with_group(by_group.drop("blocks"), upper)
    whole = joined.withColumn("proof", F.concat("proof", "upper"))
    out = proofs(whole, ["root", "top"], shape)
    return out.select(
        F.col("key").alias(key), F.col("carried.group").alias(group), F.col("node").alias("leaf"),
        F.col("root").alias("subroot"), F.col("top").alias("root"), "proof", *[F.col(f"carried.{n}").alias(n) for n in carry],
    )
