"""Merkle manifest of a table: one root, and for every row the siblings that prove it.

A leaf is the SHA-256 of the row's fields, each written as its UTF-8 length, a colon and its value, or ``-`` where it is
null. Leaves of one group stand in the order of their ids; every ``arity`` consecutive nodes (the last run may be shorter, one
node included) are hashed into the next level while a level has several nodes. The roots of the groups, null group first and
then bytewise, are hashed the same way into the root. A digest enters the next hash as lowercase hex text.

Places come from a range sort: row numbers inside a partition, plus the rows of the group in partitions before it. A
level needs no join: inside a chunk of ``arity ** levels`` consecutive places, lag and lead at the fixed offsets
``j * arity ** k`` give a node its siblings, masked by its slot and the length of its run, and the row of a first child
holds the hash of its parent. One sort serves all levels of a chunk; the chunks' roots are the nodes of the next round. The
way down is the same: a later child takes what its parent's row knows by a lag of fixed offset. A group of any size is
thus cut into chunks of bounded size, and each round has one row per chunk of the one before.

Rows with equal ids are ordered by their leaf; rows equal in both are alike, each has a place and a proof of its own. Null ids
come first, a null group is a group, null and empty texts have different leaves. An empty table has no root (None) and
no proofs. Columns that are neither id, group nor field are not read.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import stage

DIGEST = 64  # characters of a digest in hex


@dataclass
class Manifest:
    """``root``: one digest. ``proofs``: (id, group, position, leaves, rank, groups, leaf, subroot, proof, carried columns).

    ``proof`` holds the siblings' digests one after the other, from the leaf's level up to the root; which of them stand on the
    left follows from position and leaves, then from rank and groups. ``depths`` are the levels of the deepest group and of
    the tree of groups.
    """

    root: str | None
    proofs: DataFrame
    arity: int
    depths: tuple[int, int]


def digest_of(fields: Sequence[Column]) -> Column:
    """Leaf of a row: SHA-256 over the fields, each with its length, null as ``-``."""
    def written(field: Column) -> Column:
        text = field.cast("string")
        return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))

    return F.sha2(F.concat(*[written(f) for f in fields]), 256)


def build(
    rows: DataFrame,
    fields: Sequence[str],
    id_col: str,
    group_col: str,
    arity: int = 2,
    levels: int = 6,
    carry: dict[str, Column] | None = None,
) -> Manifest:
    """The manifest of ``rows``; ``carry`` adds small columns, computed from the row, to its proof.

    ``levels`` sets the size of a chunk: ``arity ** levels`` rows.
    """
    if arity < 2 or levels < 1:
        raise ValueError("arity must be at least 2 and levels at least 1")
    carry = carry or {}
    leaves = stage(
        rows.select(
            F.col(id_col).alias("id"), F.col(group_col).alias("group"), digest_of([F.col(f) for f in fields]).alias("h"),
            F.monotonically_increasing_id().alias("row"), *[c.alias(f"carry_{n}") for n, c in carry.items()],
        ),
        "manifest-leaves",
    )
    below, depth = _climb(_placed(leaves, ["group"], ["id", "h", "row"]), arity, levels)
    subroots = _tops(*below[-1], ["group"])
    above, high = _climb(_placed(subroots.select(F.lit(0).alias("all"), "group", "h"), ["all"], ["group"]), arity, levels, ["all"])
    top = _tops(*above[-1], ["all"])
    root = top.first()
    ends = _descend(above, top.select("all", "pos", F.lit("").alias("proof")), ["all"]).select(
        "group", F.lit(0).cast("long").alias("pos"), F.col("h").alias("subroot"), F.col("pos").alias("rank"), F.col("n").alias("groups"), "proof"
    )
    known = _descend(below, stage(ends, "manifest-groups"), ["group"], ("subroot", "rank", "groups"))
    return Manifest(
        root["h"] if root else None,
        known.select(
            "id", "group", F.col("pos").alias("position"), F.col("n").alias("leaves"), "rank", "groups",
            F.col("h").alias("leaf"), "subroot", "proof", *[F.col(f"carry_{n}").alias(n) for n in carry],
        ),
        arity,
        (depth, high),
    )


def fold(manifest: Manifest, leaf: Column | str = "leaf") -> Column:
    """The root that follows from ``leaf`` and the proof of its row: an expression over ``manifest.proofs``."""
    start = F.struct(
        (F.col(leaf) if isinstance(leaf, str) else leaf).alias("h"), F.lit(0).alias("at"),
        F.col("position").cast("long").alias("pos"), F.col("leaves").cast("long").alias("n"),
    )
    state = _folded(start, manifest.depths[0], manifest.arity)
    again = F.struct(
        state["h"].alias("h"), state["at"].alias("at"), F.col("rank").cast("long").alias("pos"), F.col("groups").cast("long").alias("n")
    )
    return _folded(again, manifest.depths[1], manifest.arity)["h"]


def _folded(start: Column, depth: int, arity: int) -> Column:
    """One hash per level; levels above the top of a lower tree change nothing."""
    def up(s: Column, _: Column) -> Column:
        slot = s["pos"] % arity
        run = F.least(F.lit(arity).cast("long"), s["n"] - s["pos"] + slot)
        before, after = (slot * DIGEST).cast("int"), ((run - 1 - slot) * DIGEST).cast("int")
        proof = F.col("proof")
        joined = F.concat(F.substr(proof, s["at"] + 1, before), s["h"], F.substr(proof, s["at"] + before + 1, after))
        return F.when(
            s["n"] > 1,
            F.struct(
                F.sha2(joined, 256).alias("h"), (s["at"] + before + after).alias("at"),
                _part(s["pos"], arity).alias("pos"), _part(s["n"] + (arity - 1), arity).alias("n"),
            ),
        ).otherwise(s)

    return F.aggregate(F.array(*[F.lit(k) for k in range(depth)]), start, up) if depth else start


def _part(number: Column, by: int) -> Column:
    """Whole part of a quotient of longs that are not negative, without a way over doubles."""
    return F.call_function("div", number, F.lit(by).cast("long"))


def _placed(nodes: DataFrame, group: list[str], order: list[str]) -> DataFrame:
    """``nodes`` with ``pos``, their place in the group from 0, and ``n``, the nodes of the group.

    A range sort cuts groups of any size; what is counted per (partition, group) is all that a window sees of a group.
    """
    keys = [*group, *order]
    placed = stage(
        nodes.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn("at", F.monotonically_increasing_id()), "manifest-order"
    ).withColumn("part", F.shiftright("at", 33))
    parts = placed.groupBy(*group, "part").agg(F.count(F.lit(1)).alias("rows"), F.min("at").alias("first"))
    before = Window.partitionBy(*group).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select(
        *[F.col(g).alias(f"{g}_") for g in group], F.col("part").alias("part_"), "first",
        F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("before"), F.sum("rows").over(Window.partitionBy(*group)).alias("n"),
    )
    same = placed["part"] == parts["part_"]
    for g in group:
        same &= placed[g].eqNullSafe(parts[f"{g}_"])
    return placed.join(parts, same).select(*nodes.columns, (F.col("at") - F.col("first") + F.col("before")).alias("pos"), "n")


def _climb(nodes: DataFrame, arity: int, levels: int, group: Sequence[str] = ("group",)) -> tuple[list, int]:
    """All rounds from the nodes up to the groups' roots, as (stored nodes, size of a chunk), and the levels of the largest group."""
    largest, depth = nodes.agg(F.max("n")).first()[0] or 0, 0
    while arity**depth < largest:
        depth += 1
    rounds = []
    for done in range(0, max(depth, 1), levels):
        here = min(levels, depth - done)
        rounds.append((stage(_chunks(nodes, arity, here, list(group)), "manifest-round"), arity**here))
        nodes = _tops(*rounds[-1], group)
    return rounds, depth


def _tops(nodes: DataFrame, size: int, group: Sequence[str]) -> DataFrame:
    """The chunks' roots as nodes of the next round; after the last round, the groups' roots."""
    return nodes.filter(F.col("pos") % size == 0).select(
        *group, _part(F.col("pos"), size).alias("pos"), _part(F.col("n") + (size - 1), size).alias("n"), F.col("top").alias("h")
    )


def _chunks(nodes: DataFrame, arity: int, levels: int, group: list[str]) -> DataFrame:
    """Nodes with ``top``, the hash ``levels`` above on the first row of a chunk, and ``path``, the siblings on the way there."""
    pos, n = F.col("pos"), F.col("n")
    own = nodes.columns
    chunk = _part(pos, arity**levels).alias("chunk")
    window = Window.partitionBy(*group, "chunk").orderBy("pos")
    rows = nodes.select(*own, chunk, F.col("h").alias("h0"))
    for k in range(levels):
        step, h = arity**k, F.col(f"h{k}")
        width, index = _part(n + (step - 1), step), _part(pos, step)
        slot = index % arity
        run = F.least(F.lit(arity).cast("long"), width - index + slot)
        live = (pos % step == 0) & (width > 1)
        others = [F.when(live & (slot >= j), F.lag(h, j * step).over(window)) for j in range(arity - 1, 0, -1)]
        others += [F.when(live & (slot + j < run), F.lead(h, j * step).over(window)) for j in range(1, arity)]
        found = F.concat(*[F.coalesce(o, F.lit("")) for o in others])
        parent = F.when(pos % (step * arity) == 0, F.when(width > 1, F.sha2(F.concat(h, found), 256)).otherwise(h))
        seen = [f"others{i}" for i in range(k)]
        rows = rows.select(*own, "chunk", *seen, found.alias(f"others{k}"), parent.alias(f"h{k + 1}"))
    path = F.lit("")
    for k in reversed(range(levels)):
        step = arity**k
        slot, up = _part(pos, step) % arity, path
        for j in range(1, arity):
            up = F.when(slot == j, F.lag(path, j * step).over(window)).otherwise(up) if k < levels - 1 else up
        known = F.when(pos % step == 0, F.concat(f"others{k}", up)).alias("path")
        rows = rows.select(*own, "chunk", f"h{levels}", *[f"others{i}" for i in range(k)], known)
        path = F.col("path")
    return rows.select(*own, F.col(f"h{levels}").alias("top"), path.alias("path"))


def _descend(rounds: list, roots: DataFrame, group: list[str], keep: Sequence[str] = ()) -> DataFrame:
    """The nodes of the first round with ``proof``: their siblings up to the top, and what lies above it.

    ``roots`` gives each group's root (``pos`` 0) its ``proof`` and the columns to ``keep``.
    """
    upper = roots
    for nodes, size in reversed(rounds):
        named = upper.select(*[F.col(g).alias(f"{g}_") for g in group], F.col("pos").alias("chunk_"), F.col("proof").alias("proof_"), *keep)
        same = _part(nodes["pos"], size) == named["chunk_"]
        for g in group:
            same &= nodes[g].eqNullSafe(named[f"{g}_"])
        upper = nodes.join(named, same).withColumn("proof", F.concat("path", "proof_")).drop("proof_", "chunk_", *[f"{g}_" for g in group])
    return upper
