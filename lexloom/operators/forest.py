"""Parent and child rows to full hierarchies: path, depth, root and number of descendants of every node, cycles told apart.

Fragment contraction. The nodes are dealt to fragments of bounded size by a hash of their id. In a fragment, a node that has a
child elsewhere is an exit; every other node walks its local parents up to the first exit (its owner), of its own fragment or
the next. The exits with their owners are the quotient forest, solved in the same way until it fits one fragment; then each
level is expanded: a node's path is its owner's and the local rest, its descendants are the local ones and those of the exits
below it. Leaves are never exits, so a level keeps at most the inner nodes. Where many fragments make chance meetings rare, a
node is instead dealt to the place of its parent if it is the parent's only child and two coins agree, so that chains shrink
by a quarter a level too. A cycle within a fragment without an exit is found there; any other cycle passes exits only of which
each owns the next, and is found in the fragment that solves them.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..runtime import cut

#: Nodes of a fragment, the work of one task.
FRAGMENT_NODES = 50_000
#: From this many fragments on, chains are dealt with their parents.
MANY_FRAGMENTS = 8

_CONTRACTED = "id string, owner string, is_exit boolean, seg string, len int, own bigint, below bigint, state string, root string, chain array<string>"


def _walk(fragment: pd.DataFrame) -> pd.DataFrame:
    """Contract one fragment. Rows: id, parent, is_exit, seg, len, w, and of a node without parent its state ('tree' or 'below') and top.

    Gives for each node: owner (the first exit above it, null if there is none), seg and len from below the owner (or from the
    root) down to the node, own (for an exit: the nodes here that it owns and itself, weighted), below (the weight of the local
    nodes under it that reach it without passing an exit, itself included), root (if there is no owner), state ('cycle' and
    'below' as far as known here), chain (for an exit: the local nodes between it and its owner).
    """
    ids, parents = fragment["id"].tolist(), [p if isinstance(p, str) else None for p in fragment["parent"]]
    parent = dict(zip(ids, parents))
    exits = {i for i, e in zip(ids, fragment["is_exit"]) if e}
    seg, length = dict(zip(ids, fragment["seg"])), dict(zip(ids, fragment["len"]))
    weight, given, top = (dict(zip(ids, fragment[c])) for c in ("w", "state", "top"))

    # owner, state and path of each node, by walks that stop at what is known
    owner: dict[str, str | None] = {}
    state: dict[str, str | None] = {}
    root: dict[str, str | None] = {}
    path: dict[str, str] = {}
    steps: dict[str, int] = {}
    order: list[str] = []  # each after the local nodes above it
    for start in ids:
        trail, place, ring, at = [], {}, None, start
        while at not in owner:
            if at in place:
                ring = trail[place[at] :]
                del trail[place[at] :]
                break
            place[at] = len(trail)
            trail.append(at)
            up = parent[at]
            if up is None or up in exits or up not in parent:
                break
            at = up
        for node in ring or ():  # a cycle that no exit interrupts
            owner[node], state[node], root[node], path[node], steps[node] = None, "cycle", None, "", 0
            order.append(node)
        for node in reversed(trail):
            up = parent[node]
            if up is None:
                owner[node], state[node], root[node], path[node], steps[node] = None, given[node], top[node], seg[node], length[node]
            elif up in exits or up not in parent:
                owner[node], state[node], root[node], path[node], steps[node] = up, None, None, seg[node], length[node]
            elif state[up] in ("cycle", "below"):
                owner[node], state[node], root[node], path[node], steps[node] = None, "below", None, "", 0
            else:
                owner[node], state[node], root[node] = owner[up], state[up], root[up]
                path[node], steps[node] = f"{path[up]}>{seg[node]}", steps[up] + length[node]
            order.append(node)

    below = dict(weight)
    own: dict[str, int] = {}
    chain: dict[str, list[str]] = {}
    for node in reversed(order):
        up = parent[node]
        if state[node] == "cycle":
            continue
        if node in exits:
            between, at = [], up
            while at is not None and at in parent and at not in exits and state[at] != "cycle":
                between.append(at)
                at = parent[at]
            chain[node] = between
        elif up is not None and up in parent and up not in exits:
            below[up] += below[node]
    for node in ids:
        holder = node if node in exits else owner[node]
        if holder is not None:
            own[holder] = own.get(holder, 0) + weight[node]
    rows = [
        (n, owner[n], n in exits, path[n], steps[n], own.get(n, 0) if n in exits else 0, below[n], state[n], root[n], chain.get(n))
        for n in ids
    ]
    # what exits of other fragments own here
    rows += [(x, None, True, None, None, w, None, None, None, None) for x, w in own.items() if x not in parent]
    return pd.DataFrame(rows, columns=["id", "owner", "is_exit", "seg", "len", "own", "below", "state", "root", "chain"])


def _solve_here(fragment: pd.DataFrame) -> pd.DataFrame:
    """The whole (quotient) forest in one fragment: no exits."""
    whole = _walk(fragment.assign(is_exit=False))
    return pd.DataFrame({"id": whole["id"], "state": whole["state"], "root": whole["root"], "depth": whole["len"], "path": whole["seg"], "size": whole["below"]})


def _fragment(node: Column, level: int, count: int) -> Column:
    return F.pmod(F.xxhash64(node, F.lit(level)), F.lit(count))


def _coin(node: Column, level: int) -> Column:
    return F.pmod(F.xxhash64(F.lit("coin"), node, F.lit(level)), F.lit(2)) == 1


def _solve(nodes: DataFrame, level: int, fragment_nodes: int, many: int) -> DataFrame:
    """nodes: id, parent, seg, len, w, state, top (materialised). Gives id, state, root, depth, path, size."""
    count = -(-nodes.count() // fragment_nodes)
    if count <= 1:
        return nodes.groupBy(F.lit(0).alias("f")).applyInPandas(
            lambda f: _solve_here(f), "id string, state string, root string, depth int, path string, size bigint"
        )
    if count >= many:
        single = nodes.where("parent is not null").groupBy("parent").agg((F.count("*") == 1).alias("single"))
        nodes = nodes.join(single, "parent", "left")
        joins = F.coalesce(F.col("single") & _coin(F.col("id"), level) & ~_coin(F.col("parent"), level), F.lit(False))
        nodes = nodes.withColumn("f", F.when(joins, _fragment(F.col("parent"), level, count)).otherwise(_fragment(F.col("id"), level, count)))
        nodes = nodes.withColumn("elsewhere", F.col("parent").isNotNull() & ~joins)
    else:
        nodes = nodes.withColumn("f", _fragment(F.col("id"), level, count))
        nodes = nodes.withColumn("elsewhere", F.col("parent").isNotNull() & (_fragment(F.col("parent"), level, count) != F.col("f")))
    exits = nodes.where("elsewhere").select(F.col("parent").alias("id")).distinct().withColumn("is_exit", F.lit(True))
    flagged = nodes.join(exits, "id", "left").withColumn("is_exit", F.coalesce("is_exit", F.lit(False)))
    contracted = cut(flagged.groupBy("f").applyInPandas(_walk, _CONTRACTED))
    quotient = (
        contracted.where("is_exit")
        .groupBy("id")
        .agg(
            F.max("owner").alias("parent"), F.max("seg").alias("seg"), F.max("len").alias("len"), F.sum("own").alias("w"),
            F.coalesce(F.max("state"), F.lit("tree")).alias("state"), F.max("root").alias("top"),
        )
    )
    solved = cut(_solve(cut(quotient), level + 1, fragment_nodes, many))
    lifted = (
        contracted.where("is_exit and size(chain) > 0")
        .select("id", F.explode("chain").alias("v"))
        .join(solved.select("id", "size", (F.col("state") == "cycle").alias("on_cycle")), "id")
        .groupBy(F.col("v").alias("id"))
        .agg(F.sum("size").alias("lifted"), F.max("on_cycle").alias("on_cycle"))
    )
    up = solved.select(F.col("id").alias("owner"), F.col("state").alias("up_state"), F.col("root").alias("up_root"), F.col("depth").alias("up_depth"), F.col("path").alias("up_path"))
    known = F.coalesce("state", F.when(F.col("up_state") == "tree", "tree").when(F.col("on_cycle") & (F.col("up_state") == "cycle"), "cycle").otherwise("below"))
    expanded = (
        contracted.where("not is_exit")
        .join(up, "owner", "left")
        .join(lifted, "id", "left")
        .select(
            "id",
            known.alias("state"),
            F.coalesce("root", "up_root").alias("root"),
            (F.col("len") + F.coalesce("up_depth", F.lit(0))).alias("depth"),
            F.concat_ws(">", "up_path", "seg").alias("path"),
            (F.col("below") + F.coalesce("lifted", F.lit(0))).alias("size"),
        )
    )
    return expanded.unionByName(solved)


def hierarchy(edges: DataFrame, child_col: str = "child", parent_col: str = "parent", fragment_nodes: int = FRAGMENT_NODES, many: int = MANY_FRAGMENTS) -> DataFrame:
    """For each node of the forest told by (child, parent) rows: word, state, root, depth, path, n_desc.

    state is 'cycle' for a node that is its own ancestor, 'below' for another with such an ancestor, else 'tree'; other nodes
    than those of trees get '', -1, '' and -1. A parent of null only names the child. Repeated rows count once; of several
    parents of a node the least counts. Null children are passed over, as are other columns. No rows give no rows.
    """
    pairs = edges.select(F.col(child_col).cast("string").alias("id"), F.col(parent_col).cast("string").alias("parent")).where("id is not null")
    named = pairs.unionByName(pairs.where("parent is not null").select(F.col("parent").alias("id"), F.lit(None).cast("string").alias("parent")))
    nodes = named.groupBy("id").agg(F.min("parent").alias("parent"))
    start = nodes.select(
        "id", "parent", F.col("id").alias("seg"), F.when(F.col("parent").isNull(), 0).otherwise(1).alias("len"),
        F.lit(1).cast("bigint").alias("w"), F.lit("tree").alias("state"), F.when(F.col("parent").isNull(), F.col("id")).alias("top"),
    )
    solved = _solve(cut(start), 0, fragment_nodes, many)
    tree = F.col("state") == "tree"
    return solved.select(
        F.col("id").alias("word"),
        "state",
        F.when(tree, F.col("root")).otherwise("").alias("root"),
        F.when(tree, F.col("depth")).otherwise(-1).cast("int").alias("depth"),
        F.when(tree, F.col("path")).otherwise("").alias("path"),
        F.when(tree, F.col("size") - 1).otherwise(-1).cast("int").alias("n_desc"),
    )
