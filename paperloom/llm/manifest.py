"""Merkle manifest of a dataset: proofs by a butterfly exchange between aligned partitions.

1. Leaves are digests of whole rows, numbered per group in order.  Partition p of a group holds the
   ``fanout ** PART_LEVELS`` leaves from p times that number on, so it is a whole subtree, the last one cut short.
2. Every partition starts with its own subtree's root.  In a round, partitions whose numbers agree but for
   one digit swap the roots they hold, and each of them hashes the levels above on its own.  All keep the
   siblings that they met, so after the last round every partition has the proof above its leaves
   and the group's root, and nothing is sent back down.
3. The groups' roots are leaves of one more tree of the same kind.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paperloom.session import cut_lineage, discard, with_index

#: Children of a node; levels of a partition's own subtree; levels that one round of the exchange covers.
FANOUT, PART_LEVELS, ROUND_LEVELS = 2, 12, 4
#: Columns of a leaf, in order.
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")

#: What stands left and right of a node among its siblings, a level: digests as hex text, joined.
PROOF = "array<struct<before: string, after: string>>"


def digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def written(column: Column) -> Column:
    """A value as its UTF-8 byte count, a colon and its text; ``-`` if null."""
    text = column.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(columns: list[Column]) -> Column:
    return F.sha2(F.concat(*map(written, columns)), 256)


def parents(nodes: list[str], fanout: int) -> list[str]:
    return [digest("".join(nodes[i:i + fanout])) for i in range(0, len(nodes), fanout)]


def climb(nodes: list[str], levels: int, fanout: int) -> list[list[str]]:
    """The nodes of this level and of the ``levels`` above."""
    out = [nodes]
    for _ in range(levels):
        out.append(parents(out[-1], fanout))
    return out


def siblings(levels: list[list[str]], at: int, fanout: int) -> list[tuple[str, str]]:
    """What stands before and after node ``at`` of the lowest level in its run, for each level but the last."""
    out = []
    for nodes in levels[:-1]:
        run = at - at % fanout
        out.append(("".join(nodes[run:at]), "".join(nodes[at + 1:run + fanout])))
        at //= fanout
    return out


def height(rows: Column, fanout: int, above: int = 0) -> Column:
    """Levels over ``rows`` nodes until one remains: counted in whole numbers, at most 63."""
    powers = [fanout**k for k in range(64) if fanout**k < 1 << 63]
    return reduce(lambda x, y: x + y, [F.when(rows > p, 1).otherwise(0) for p in powers]).cast("int")


def _roots(fanout: int, part_levels: int):
    """The root of a partition's own subtree."""

    def run(key: tuple, table: pa.Table) -> pa.Table:
        table = table.sort_by("at")
        depth = min(part_levels, table.column("height")[0].as_py())
        top = climb(table.column("leaf").to_pylist(), depth, fanout)[-1]
        return pa.table({"part": table.column("part")[:1], "height": table.column("height")[:1], "parts": table.column("parts")[:1], "group": table.column("group")[:1], "held": pa.array(top, pa.string())})

    return run


def _swap(fanout: int, done: int, levels: int):
    """One swap: the partitions of a group hash ``levels`` levels of what all of them hold."""

    def run(key: tuple, table: pa.Table) -> pa.Table:
        table = table.sort_by("digit")
        digits = table.column("digit").to_pylist()
        assert digits == list(range(len(digits))), "a subtree without a stand-in"
        met = climb(table.column("held").to_pylist(), max(0, min(levels, table.column("height")[0].as_py() - done)), fanout)
        mine = [i for i, own in enumerate(table.column("own").to_pylist()) if own]
        proofs = [table.column("proof")[i].as_py() + [{"before": a, "after": b} for a, b in siblings(met, i, fanout)] for i in mine]
        kept = table.take(pa.array(mine, pa.int64()))
        proof = pa.array(proofs, pa.list_(pa.struct([("before", pa.string()), ("after", pa.string())])))
        top = pa.array([met[-1][i // fanout ** (len(met) - 1)] for i in mine], pa.string())
        return kept.select(["group", "part", "parts", "height"]).append_column("held", top).append_column("proof", proof)

    return run


def butterfly(parts: DataFrame, fanout: int, part_levels: int, round_levels: int) -> DataFrame:
    """``group, part, held, proof``: the group's root and all siblings above the partition, after all rounds.

    Round r joins partitions whose numbers agree in all digits of base ``fanout ** round_levels`` but
    the r-th, so a swap has that many rows, whatever the size.  A group's last subtree can hold
    fewer partitions than its neighbours; these then stand in for those that it lacks, in turn.
    """
    state = parts.withColumn("proof", F.lit(None).cast(PROOF)).withColumn("proof", F.coalesce("proof", F.array().cast(PROOF)))
    most = parts.agg(F.max("parts")).first()[0] or 1
    base, width, done = fanout**round_levels, 1, part_levels
    while width < most:
        first = F.col("part") - F.col("part") % width
        own = F.least(F.lit(width), F.col("parts") - first)
        # the lows that this partition answers for: its own, and each own-th further one that is missing
        lows = F.when(F.col("parts") > width, F.sequence(F.col("part") % width, F.lit(width - 1).cast("bigint"), own)).otherwise(F.array(F.col("part") % width))
        dealt = state.withColumn("low", F.explode(lows)).select(
            "*", (F.col("low") == F.col("part") % width).alias("own"), F.expr(f"part div {width} % {base}").alias("digit"), F.expr(f"part div {width * base}").alias("high"))
        # a group that is whole already stays as it is
        grown = dealt.where(F.col("parts") > width).groupBy("group", "high", "low").applyInArrow(
            _swap(fanout, done, round_levels), f"group bigint, part bigint, parts bigint, height int, held string, proof {PROOF}")
        state = cut_lineage(state.where(F.col("parts") <= width).unionByName(grown))
        width, done = width * base, done + round_levels
    return state.select("group", "part", "held", "proof")


def tree(nodes: DataFrame, fanout: int = FANOUT, part_levels: int = PART_LEVELS, round_levels: int = ROUND_LEVELS) -> tuple[DataFrame, DataFrame]:
    """Of ``group, at, rows, leaf``: the nodes with ``part``, and ``group, part, held, proof`` of each partition.

    ``group`` numbers trees; ``at`` runs from 0 in each of them, over ``rows`` leaves.
    """
    size = fanout**part_levels
    placed = nodes.select(
        "*", F.expr(f"at div {size}").alias("part"), F.expr(f"(rows + {size - 1}) div {size}").alias("parts"), height(F.col("rows"), fanout).alias("height"))
    columns = placed.select("group", "part", "at", "leaf", "parts", "height")
    kind = "part bigint, height int, parts bigint, group bigint, held string"
    roots = cut_lineage(columns.groupBy("group", "part").applyInArrow(_roots(fanout, part_levels), kind))
    return placed, butterfly(roots, fanout, part_levels, round_levels)


PROVED = "doc_id bigint, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"


def fold(node: str, proof: list[tuple[str, str]]) -> str:
    """The root that a node and the siblings above it give."""
    for before, after in proof:
        node = digest(before + node + after)
    return node


def _prove(fanout: int, part_levels: int):
    """Every leaf's proof: siblings inside the partition, then those of the partition, then those of its group."""

    def run(key: tuple, leaves: pa.Table, above: pa.Table) -> pa.Table:
        names = [c.split()[0] for c in PROVED.split(", ")]
        out: list[list] = [[] for _ in names]
        leaves = leaves.sort_by("at")
        nodes = leaves.column("leaf").to_pylist()
        met = climb(nodes, min(part_levels, leaves.column("height")[0].as_py()), fanout) if nodes else [[]]
        upper = [(x["before"], x["after"]) for c in ("proof", "upper") for x in above.column(c)[0].as_py()]
        subroot, root = above.column("held")[0].as_py(), above.column("root")[0].as_py()
        for at, (doc, own, shown) in enumerate(zip(leaves.column("doc_id").to_pylist(), nodes, leaves.column("shown").to_pylist())):
            proof = siblings(met, at, fanout) + upper
            folded = fold(shown, proof)
            for column, value in zip(out, (doc, own, subroot, root, digest("".join(a + b for a, b in proof)), folded, folded == root)):
                column.append(value)
        kinds = [pa.int64()] + [pa.string()] * 5 + [pa.bool_()]
        return pa.table([pa.array(c, t) for c, t in zip(out, kinds)], names=names)

    return run


def sized(rows: DataFrame, groups: list[str]) -> DataFrame:
    """``rows`` with ``rows``: how many of them their group has."""
    counts = rows.groupBy(*groups).agg(F.count(F.lit(1)).alias("rows")).select(*[F.col(g).alias(f"__{g}") for g in groups], "rows")
    same = reduce(lambda a, b: a & b, [F.col(g).eqNullSafe(F.col(f"__{g}")) for g in groups])
    return rows.join(counts, same).select(*rows.columns, "rows")


def manifest(
    docs: DataFrame, tampered: Column | None = None, fanout: int = FANOUT, part_levels: int = PART_LEVELS, round_levels: int = ROUND_LEVELS
) -> DataFrame:
    """``doc_id, leaf, subroot, root, proof_sha256, folded_root, verified`` for every row of ``docs``.

    A leaf is the digest of ``FIELDS``, each ``-`` if null, so null and empty differ.  Leaves of a ``lang`` are
    in order of ``doc_id`` (null last), rows that repeat a ``doc_id`` in order of their digests; equal rows
    have equal leaves and a place each.  ``tampered`` tells the rows whose proof is tried with 1 more in
    ``n_chars`` (null stays, as does a null condition); the others are tried as they are.  A null ``lang`` is
    a group of its own, the first.  A text counts whole; other columns don't matter; an empty table gives no rows.
    """
    columns = [F.col(c) for c in FIELDS]
    changed = [(F.col(c).cast("bigint") + 1) if c == "n_chars" else F.col(c) for c in FIELDS]
    own = leaf(columns)
    shown = own if tampered is None else F.when(tampered & F.col("n_chars").isNotNull(), leaf(changed)).otherwise(F.lit(None))
    leaves = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("lang").cast("string").alias("lang"), own.alias("leaf"), shown.alias("shown"))
    leaves = cut_lineage(leaves.withColumn("shown", F.coalesce("shown", "leaf")).withColumn("nameless", F.col("doc_id").isNull()))

    # groups numbered in their order: null first, then by bytes
    groups = cut_lineage(with_index(leaves.groupBy("lang").agg(F.count(F.lit(1)).alias("rows")), [], ["lang"], "group"))
    numbered = with_index(leaves, ["lang"], ["nameless", "doc_id", "leaf"], "at", few_groups=False)
    named = groups.select(F.col("lang").alias("__lang"), "rows", "group")
    nodes = numbered.join(named, F.col("lang").eqNullSafe(F.col("__lang"))).select("group", "at", "rows", "leaf", "doc_id", "shown")
    placed, parts = tree(nodes, fanout, part_levels, round_levels)

    # one more tree over the groups' roots
    tops = parts.where("part = 0").select("group", F.col("held").alias("leaf"))
    n = groups.count()
    upper, upper_parts = tree(tops.select(F.lit(0).cast("bigint").alias("group"), F.col("group").alias("at"), F.lit(n).cast("bigint").alias("rows"), "leaf"), fanout, part_levels, round_levels)
    over = upper.groupBy("group", "part").cogroup(upper_parts.groupBy("group", "part")).applyInArrow(
        _own_proofs(fanout, part_levels), f"at bigint, root string, upper {PROOF}")
    above = cut_lineage(parts.join(over.withColumnRenamed("at", "group"), "group"))
    proved = placed.groupBy("group", "part").cogroup(above.groupBy("group", "part")).applyInArrow(_prove(fanout, part_levels), PROVED)
    return proved


def _own_proofs(fanout: int, part_levels: int):
    """Proofs of the leaves of a partition, themselves."""

    def run(key: tuple, leaves: pa.Table, above: pa.Table) -> pa.Table:
        leaves = leaves.sort_by("at")
        met = climb(leaves.column("leaf").to_pylist(), min(part_levels, leaves.column("height")[0].as_py()), fanout)
        rest = above.column("proof")[0].as_py()
        proofs = [[{"before": a, "after": b} for a, b in siblings(met, i, fanout)] + rest for i in range(leaves.num_rows)]
        kind = pa.list_(pa.struct([("before", pa.string()), ("after", pa.string())]))
        return pa.table({"at": leaves.column("at"), "root": pa.array(above.column("held").to_pylist() * leaves.num_rows, pa.string()), "upper": pa.array(proofs, kind)})

    return run
