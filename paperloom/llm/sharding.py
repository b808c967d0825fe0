"""Shards by a hierarchical weighted hash tree: region, rack, shard."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paperloom.llm.common import running

#: Shards of a rack and racks of a region in the layout of a shard count.
RACK, REGION = 4, 2
#: From this count on, the base layout stays and every further shard is a region of its own.
BASE = 16


@dataclass(frozen=True)
class Node:
    """A region, rack or shard: ``name`` enters the draws, leaves carry a shard number."""

    name: str
    weight: float
    children: tuple[Node, ...] = ()
    shard: int | None = None


def inner(name: str, children: list[Node]) -> Node:
    return Node(name, sum(c.weight for c in children), tuple(children))


def layout(shards: int, base: int = BASE) -> Node:
    """The tree of a shard count: full racks and regions up to ``base``, then one region a shard.

    A shard that joins a rack would raise the weight of its region, and rows drawn into the region
    would spread over its old shards too.  As a region of its own it takes rows into itself alone.  This
    holds from ``base`` shards up only: to grow from fewer, give the starting count as ``base`` to both trees.
    """
    leaves = [Node(f"shard{i}", 1.0, shard=i) for i in range(shards)]
    first, more = leaves[: min(base, shards)], leaves[min(base, shards):]
    racks = [inner(f"rack{i}", first[i * RACK:(i + 1) * RACK]) for i in range(-(-len(first) // RACK))]
    regions = [inner(f"region{i}", racks[i * REGION:(i + 1) * REGION]) for i in range(-(-len(racks) // REGION))]
    return inner("root", regions + [inner(f"region+{x.shard}", [inner(f"rack+{x.shard}", [x])]) for x in more])


def draw(key: Column, node: Node) -> Column:
    """The straw of a child: ln(u) / weight, u in (0, 1] from 48 bits of a hash of key and name."""
    digits = F.substring(F.md5(F.concat(key, F.lit(f":{node.name}"))), 1, 12)
    u = (F.conv(digits, 16, 10).cast("double") + 1) / float(1 << 48)
    return F.ln(u) / F.lit(float(node.weight))


def place(key: Column, node: Node) -> Column:
    """The shard of a key: from the root down, the child with the longest straw.

    Straws of other children don't change when one weight does, so rows move only to or from the
    child whose weight changed, and below it only where weights changed too.
    """
    if node.shard is not None:
        return F.lit(node.shard)
    if len(node.children) == 1:
        return place(key, node.children[0])
    straws = [draw(key, c) for c in node.children]
    best = F.greatest(*straws)
    pick = F.lit(None).cast("int")
    for child, straw in reversed(list(zip(node.children, straws))):
        pick = F.when(straw == best, place(key, child)).otherwise(pick)
    return pick


def shard(docs: DataFrame, tree: Node, grown: Node | None = None) -> DataFrame:
    """``doc_id, size, text_crc32, shard, slot`` and ``grown_shard`` under the other tree.

    The key is ``doc_id`` alone (null: empty text).  ``size`` is the UTF-8 length plus 1, a null text
    counts as empty (crc 0).  Slots number the rows of a shard without gaps in the order of a hash, by
    many tasks for each shard.  Other columns of ``docs`` don't matter; an empty table gives no rows.
    """
    key = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(
        "doc_id",
        (F.octet_length(text) + 1).cast("bigint").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        place(key, tree).alias("shard"),
        (place(key, grown) if grown else F.lit(None).cast("int")).alias("grown_shard"),
        F.md5(F.concat(F.lit("slot:"), key)).alias("order"),
    )
    slotted = running(rows, ["shard"], ["doc_id", "text_crc32"], "order", docs.count(), F.lit(1), "slot")
    return slotted.select("doc_id", "size", "text_crc32", "shard", F.col("slot").cast("bigint").alias("slot"), "grown_shard")
