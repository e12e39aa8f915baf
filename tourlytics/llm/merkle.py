"""A manifest of a data set as Merkle trees: one a group of rows, and one over the groups.

Every leaf is the hash of a row. Rows are put in order once and numbered; runs of 2^levels nodes of one tree
(a superblock) are reduced by one task, their tops are the nodes of the next tier, and so on to one root.
On the way back each superblock is cogrouped with the outer nodes that its proofs need, the siblings of its
own path: that exchange finishes the reduction inside the block, joins the proofs and folds them, together.
"""

from __future__ import annotations

from collections.abc import Sequence
from hashlib import sha256

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import ahead, forget, lined_up, settle

LEVELS = 11  # a superblock holds 2^LEVELS nodes, unless told otherwise
ROW = ("doc_id", "source", "lang", "n_chars", "text")

Tree = list[list[str]]
_TOPS = "tree string, block long, alone string, full string"
_OUTER = "tree string, block long, sides string, proof string, subroot string, root string"
_PROVED = "id string, leaf string, subroot string, root string, sides string, proof string, folded_root string"


def field(value: Column) -> Column:
    """A value behind its number of bytes, so that fields cannot run into each other; ``-`` for null."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_hash(columns: Sequence[str] = ROW, changed: dict[str, Column] | None = None) -> Column:
    """Hash of a row's fields; ``changed`` puts other values in the place of some."""
    return F.sha2(F.concat(*[field((changed or {}).get(name, F.col(name))) for name in columns]), 256)


def _hash(nodes: Sequence[str]) -> str:
    return sha256("".join(nodes).encode()).hexdigest()


def levels_of(nodes: list[str], most: int | None = None) -> Tree:
    """The nodes and the levels above them: up to one node, or ``most`` levels whatever is left."""
    tree = [nodes]
    while len(tree) <= most if most is not None else len(tree[-1]) > 1:
        low = tree[-1]
        tree.append([_hash(low[k : k + 2]) for k in range(0, len(low), 2)])
    return tree


def path_of(tree: Tree, place: int) -> tuple[str, str]:
    """The siblings of a node up to the top: the side of each (l, r, or - for none), and their digests on end."""
    sides, digests = [], []
    for level in tree[:-1]:
        beside = place ^ 1
        there = beside < len(level)
        sides.append(("r" if beside > place else "l") if there else "-")
        digests.append(level[beside] if there else "")
        place >>= 1
    return "".join(sides), "".join(digests)


def folded(leaf: str, sides: str, proof: str) -> str:
    """The top that a node and its siblings give."""
    at = 0
    for side in sides:
        beside = "" if side == "-" else proof[at : at + 64]
        at += len(beside)
        leaf = _hash([beside, leaf] if side == "l" else [leaf, beside])
    return leaf


def _tops(levels: int, key: tuple, group: pd.DataFrame) -> pd.DataFrame:
    """A block's node in the tier above: as the only block of its tree, and as one of several."""
    nodes = group.sort_values("place")["digest"].tolist()
    alone, full = levels_of(nodes)[-1][0], levels_of(nodes, levels)[-1][0]
    return pd.DataFrame({"tree": [key[0]], "block": [key[1]], "alone": [alone], "full": [full]})


def _paths(levels: int, nodes: pd.DataFrame, outer: pd.DataFrame) -> tuple[pd.DataFrame, list[tuple[str, str]]]:
    """The nodes of a block in order, and the path of each to the root: inside the block, then the outer nodes."""
    nodes = nodes.sort_values("place")
    above = outer.iloc[0]
    tree = levels_of(nodes["digest"].tolist(), None if above["only"] else levels)
    inside = [path_of(tree, place) for place in range(len(nodes))]
    return nodes, [(sides + above["sides"], proof + above["proof"]) for sides, proof in inside]


def _handed_down(levels: int, nodes: pd.DataFrame, outer: pd.DataFrame) -> pd.DataFrame:
    """The outer nodes of every block of the tier below."""
    if not len(nodes) or not len(outer):
        return pd.DataFrame(columns=["tree", "block", "sides", "proof", "subroot", "root"])
    nodes, paths = _paths(levels, nodes, outer)
    return pd.DataFrame(
        {
            "tree": nodes["child"].to_numpy(), "block": nodes["child_block"].to_numpy(),
            "sides": [s for s, _ in paths], "proof": [p for _, p in paths],
            "subroot": outer["subroot"].iloc[0], "root": outer["root"].iloc[0],
        }
    )


def _handed_to_trees(levels: int, subroots: pd.DataFrame, outer: pd.DataFrame) -> pd.DataFrame:
    """The same for the nodes that are the subroots of trees."""
    found = _handed_down(levels, subroots, outer)
    return found.assign(subroot=subroots.sort_values("place")["digest"].to_numpy()) if len(found) else found


def _proved(levels: int, leaves: pd.DataFrame, outer: pd.DataFrame) -> pd.DataFrame:
    leaves, paths = _paths(levels, leaves, outer)
    ends = [folded(leaf if pd.isna(seen) else seen, *path) for leaf, seen, path in zip(leaves["digest"], leaves["seen"], paths)]
    return pd.DataFrame(
        {
            "id": leaves["id"].to_numpy(), "leaf": leaves["digest"].to_numpy(),
            "subroot": outer["subroot"].iloc[0], "root": outer["root"].iloc[0],
            "sides": [s for s, _ in paths], "proof": [p for _, p in paths], "folded_root": ends,
        }
    )


def _block(levels: int) -> Column:
    return F.shiftright("place", levels).alias("block")


def _with(levels: int, step):
    """A step for one size of block: (key, rows) for a group, (rows, outer) for two."""
    return lambda left, right: step(levels, left, right)


def _tiers(nodes: DataFrame, levels: int) -> tuple[list[DataFrame], DataFrame]:
    """The tiers of all trees from ``nodes`` (tree, place, digest, ...) up, and the tops (tree, tier, digest).

    A tree leaves the tiers where one block holds all its nodes. Each tier has a 2^levels-th of the nodes.
    """
    tiers, ends = [], []
    while True:
        tiers.append(nodes)
        slim = nodes.select("tree", "place", "digest", _block(levels))
        tops = settle(slim.groupBy("tree", "block").applyInPandas(_with(levels, _tops), _TOPS), "tops")
        sizes = tops.groupBy("tree").agg(F.count(F.lit(1)).alias("blocks"))
        sized = tops.join(sizes, "tree")
        ends.append(sized.where("blocks = 1").select("tree", F.lit(len(tiers) - 1).alias("tier"), F.col("alone").alias("digest")))
        if sizes.where("blocks > 1").isEmpty():
            break
        nodes = sized.where("blocks > 1").select(
            "tree", F.col("block").alias("place"), F.col("full").alias("digest"),
            F.col("tree").alias("child"), F.col("block").alias("child_block"),
        )
        nodes = settle(nodes, "tier")
    out = ends[0]
    for more in ends[1:]:
        out = out.union(more)
    return tiers, out


def _handed_to(tiers: list[DataFrame], above: DataFrame, levels: int) -> DataFrame:
    """The outer nodes of the lowest tier's blocks; ``above`` (tree, tier, sides, ...) has those of the trees' tops."""
    outer = None
    for at in range(len(tiers) - 1, -1, -1):
        kept = ("sides", "proof", "subroot", "root")
        mine = above.where(F.col("tier") == at).select("tree", F.lit(0).cast("long").alias("block"), *kept, F.lit(True).alias("only"))
        outer = mine if outer is None else outer.withColumn("only", F.lit(False)).select(mine.columns).union(mine)
        if at:
            here = tiers[at].select("tree", "place", "digest", "child", "child_block", _block(levels))
            cogrouped = here.groupBy("tree", "block").cogroup(outer.groupBy("tree", "block"))
            outer = settle(cogrouped.applyInPandas(_with(levels, _handed_down), _OUTER), "outer")
    return outer


def manifest(
    docs: DataFrame,
    columns: Sequence[str] = ROW,
    group: str = "lang",
    key: str = "doc_id",
    seen: Column | None = None,
    levels: int = LEVELS,
) -> DataFrame:
    """id, leaf, subroot, root, sides, proof, folded_root and verified of every row.

    Leaves of a group ascend by ``key`` (equal keys by their hash), null first; every two consecutive nodes
    become the hash of both, a last one the hash of itself, until one is left, the group's subroot; a lone
    leaf is its subroot. Subroots, ordered by group, null first, give the root in the same way. ``sides``
    and ``proof`` are the siblings from the leaf to the root. ``seen`` is a row's hash as it is found now,
    null where it is as recorded: ``folded_root`` is folded from it, and ``verified`` says whether that is
    the root.

    Nulls in any column are values of their own, repeated rows are leaves of their own, an empty table
    gives no rows. Only the named columns are read, so others may have any name. A group or key of any
    size is spread over blocks; texts are read once and never shuffled.
    """
    tree = F.coalesce(F.concat(F.lit("+"), F.col(group).cast("string")), F.lit(""))  # null before all others
    seen_now = F.lit(None).cast("string") if seen is None else seen
    hashed = docs.select(
        F.col(key).alias("id"), tree.alias("tree"), leaf_hash(columns).alias("digest"), seen_now.alias("seen")
    )
    id_type = hashed.schema["id"].dataType
    hashed = settle(hashed, "leaves")
    lined = lined_up(hashed, ["tree", "id", "digest"], "leaves")
    forget(hashed)
    parts = lined.groupBy("tree", "task").agg(F.count(F.lit(1)).alias("n"), F.min("at").alias("first"))
    placed = lined.join(ahead(parts, "n", "tree").drop("n"), ["tree", "task"])
    leaves = placed.select(
        "tree", (F.col("ahead") + F.col("at") - F.col("first")).alias("place"), "digest", "seen", F.col("id").cast("string").alias("id")
    )
    tiers, subroots = _tiers(leaves, levels)
    subroots = settle(subroots, "subroots")
    row = lined_up(subroots.select("tree", "digest"), ["tree"], "subroots")
    starts = ahead(row.groupBy("task").agg(F.count(F.lit(1)).alias("n")), "n").drop("n")
    forest = row.join(F.broadcast(starts), "task").select(
        F.lit("").alias("tree"), (F.col("ahead") + F.col("at")).alias("place"), "digest",
        F.col("tree").alias("child"), F.lit(0).cast("long").alias("child_block"),
    )
    high, root = _tiers(settle(forest, "forest"), levels)
    none = F.lit(None).cast("string").alias("subroot")
    start = root.select("tree", "tier", F.lit("").alias("sides"), F.lit("").alias("proof"), none, F.col("digest").alias("root"))
    outer = _handed_to(high, settle(start, "root"), levels)
    lowest = high[0].select("tree", "place", "digest", "child", "child_block", _block(levels))
    cogrouped = lowest.groupBy("tree", "block").cogroup(outer.groupBy("tree", "block"))
    handed = cogrouped.applyInPandas(_with(levels, _handed_to_trees), _OUTER)
    above = settle(handed.drop("block").join(subroots.select("tree", "tier"), "tree"), "above")
    outer = _handed_to(tiers, above, levels)
    blocks = leaves.withColumn("block", _block(levels)).groupBy("tree", "block")
    found = blocks.cogroup(outer.groupBy("tree", "block")).applyInPandas(_with(levels, _proved), _PROVED)
    ends = F.col("folded_root") == F.col("root")
    return found.withColumn("id", F.col("id").cast(id_type)).withColumn("verified", ends)


def refolded(leaf: Column, sides: Column, proof: Column) -> Column:
    """The root that a proof gives, by DataFrame functions: a check that needs the manifest's rows only."""
    steps = F.filter(F.split(sides, ""), lambda s: s != "")
    start = F.struct(leaf.alias("node"), F.lit(1).alias("at"))

    def step(state: Column, side: Column) -> Column:
        beside = F.when(side == "-", F.lit("")).otherwise(F.substring(proof, state["at"], F.lit(64)))
        pair = F.when(side == "l", F.concat(beside, state["node"])).otherwise(F.concat(state["node"], beside))
        return F.struct(F.sha2(pair, 256).alias("node"), (state["at"] + F.length(beside)).alias("at"))

    return F.aggregate(steps, start, step, lambda state: state["node"])
