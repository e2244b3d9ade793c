"""Prefix trie of conversations, rolled up by centroid decomposition of its parent edges.

A node is a distinct sequence of first turns.  Its key is a digest of sums over
(depth, turn) digests, so prefixes of a long conversation are running sums that
blocks of depths add up side by side; no text leaves the task that reads it.

Totals over subtrees come from a centroid decomposition.  In a component of the
forest, removing the centroid leaves components of at most half the nodes; the
total of what hangs below it, the centroid included, is added to every node on
the path from the centroid to the top of the component, and the components that
are left are split in turn.  Sizes, which choose the centroids, are kept along
the same paths.

A component must not be larger than a task holds, so Spark first cuts the forest
into connected pieces.  Nodes have ranks by the magnitude of their members: below
a node of a rank there are at most ``MEMBERS`` nodes of that rank a depth.
Ranks are done from the lowest up, and totals of their tops are added up at the
nodes they hang on, however many hang there.  A rank is cut again at every
``DEPTH`` turns; the pieces form a forest of that many times less depth, which
is rolled up in the same way, and its totals go through the pieces once more.
So a piece has at most ``MEMBERS * DEPTH`` nodes, and the number of rounds grows
with the logarithms of the conversations and of the longest one.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from toneflow.llm.ordering import positions
from toneflow.llm.tables import stored

#: Conversations by whose powers nodes are ranked; turns a piece goes deep.
MEMBERS, DEPTH = 128, 512
#: Turns of a conversation whose digests are summed in one group; conversations' ids that are joined to one string.
BLOCK, IDS = 4096, 1 << 16
#: Nodes that a task decomposes at a time, apart from a single piece with more.
BATCH = 1 << 17


def digests(conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
            text_col: str = "text") -> DataFrame:
    """(conv, pos, sha, bytes): one light row per turn, numbered from 0 by turn (nulls first), then role, then digest.

    A null role or text is empty.  Rows without a conversation id belong to no conversation and are left out.
    """
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in (role_col, text_col))
    rows = conversations.filter(F.col(conv_col).isNotNull()).select(
        F.col(conv_col).cast("long").alias("conv"), F.col(turn_col).alias("turn"), role.alias("role"),
        F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256).alias("sha"),
        F.octet_length(text).cast("long").alias("bytes"))
    return positions(rows, "conv", F.col("turn").asc_nulls_first(), F.col("role"), F.col("sha")).select("conv", "pos", "sha", "bytes")


def _key(depth: Column, low: Column, high: Column) -> Column:
    return F.md5(F.concat_ws("-", depth.cast("string"), low.cast("string"), high.cast("string")))


def _root() -> Column:
    return _key(F.lit(0), F.lit(0).cast("decimal(38,0)"), F.lit(0).cast("decimal(38,0)"))


def paths(turns: DataFrame) -> DataFrame:
    """(conv, depth, key, up, bytes) of every node on the path of every conversation of (conv, depth, sha, bytes).

    Depths of a conversation are 1, 2, ... without gaps; the root, at depth 0, is not listed.
    """
    digest = F.md5(F.concat_ws("|", F.col("depth").cast("string"), "sha"))
    lanes = {f"lane{i}": F.conv(F.substring(digest, at, 15), 16, 10).cast("decimal(20,0)") for i, at in enumerate((1, 17))}
    rows = turns.withColumns(lanes).withColumn("block", F.floor((F.col("depth") - 1) / BLOCK))
    sums = rows.groupBy("conv", "block").agg(*[F.sum(c).alias(f"{c}_all") for c in lanes])
    before = Window.partitionBy("conv").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    ahead = sums.select("conv", "block", *[F.coalesce(F.sum(f"{c}_all").over(before), F.lit(0)).alias(f"{c}_ahead") for c in lanes])
    upto = Window.partitionBy("conv", "block").orderBy("depth").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumns({f"{c}_sum": F.sum(c).over(upto) for c in lanes}).join(ahead, ["conv", "block"])
    total = [(F.col(f"{c}_sum") + F.col(f"{c}_ahead")).cast("decimal(38,0)") for c in lanes]
    last = [(t - F.col(c)).cast("decimal(38,0)") for t, c in zip(total, lanes, strict=True)]
    return rows.select("conv", "depth", _key(F.col("depth"), *total).alias("key"),
                       _key(F.col("depth") - 1, *last).alias("up"), "bytes")


def tree(steps: DataFrame, members: DataFrame) -> DataFrame:
    """(key, conv, depth, n, bytes, up, parent_conv, parent_n): the nodes of :func:`paths`, and the root of all ``members``.

    ``conv`` is the least member, ``n`` their number.  Without members there is not even a root.
    """
    found = steps.groupBy("key").agg(F.min("conv").alias("conv"), F.min("depth").cast("long").alias("depth"),
                                     F.count("*").alias("n"), F.min("bytes").alias("bytes"), F.min("up").alias("up"))
    root = members.agg(F.min("conv").alias("conv"), F.count("*").alias("n")).filter("n > 0").select(
        _root().alias("key"), "conv", F.lit(0).cast("long").alias("depth"), "n", F.lit(0).cast("long").alias("bytes"),
        F.lit(None).cast("string").alias("up"))
    nodes = stored(found.unionByName(root), "nodes")
    # A node with a third of all children is split by adaptive execution: its side is one row a key.
    above = nodes.select(F.col("key").alias("up"), F.col("conv").alias("parent_conv"), F.col("n").alias("parent_n"))
    return nodes.join(above, "up", "left")


# -- centroid decomposition in a task ----------------------------------------------------------------


def _tops(up: np.ndarray) -> np.ndarray:
    """Top of the component of every node, by doubling pointers."""
    at = np.where(up < 0, np.arange(len(up)), up)
    while not np.array_equal(further := at[at], at):
        at = further
    return at


def _sizes(up: np.ndarray) -> np.ndarray:
    """Nodes in every subtree: leaves first, one depth at a time."""
    depth, far = np.zeros(len(up), np.int64), up.copy()
    while (some := np.flatnonzero(far >= 0)).size:
        depth[some] += 1
        far[some] = up[far[some]]
    order = np.argsort(-depth, kind="stable")
    size = np.ones(len(up), np.int64)
    for level in np.split(order, np.flatnonzero(np.diff(depth[order])) + 1):
        level = level[up[level] >= 0]
        np.add.at(size, up[level], size[level])
    return size


def centroid_totals(up: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Sums of ``weights`` (nodes x columns) over all subtrees of a forest given by parents, -1 for tops."""
    totals = np.zeros_like(weights)
    if not len(up):
        return totals
    up, size = up.astype(np.int64), _sizes(up)
    alive = np.arange(len(up))
    top = _tops(up)
    while alive.size:
        # The deepest node that holds at least half of its component is the centroid.
        heavy = alive[2 * size[alive] >= size[top[alive]]]
        heavy = heavy[np.lexsort((size[heavy], top[heavy]))]
        centre = heavy[np.concatenate(([True], np.diff(top[heavy]) != 0))]
        removed = np.zeros(len(up), bool)
        removed[centre] = True
        alive = alive[~removed[alive]]
        cut = alive[(up[alive] >= 0) & removed[up[alive]]]
        hung = up[cut]
        up[cut] = -1
        # Totals of the components that are left; what hangs below a centroid adds up there.
        small = np.full(len(up), -1)
        small[alive] = np.arange(alive.size)
        inner = _tops(np.where(up[alive] >= 0, small[up[alive]], -1))
        top[alive] = alive[inner]
        whole = np.zeros_like(weights)
        np.add.at(whole, top[alive], weights[alive])
        below = np.zeros_like(weights)
        below[centre] = weights[centre]
        np.add.at(below, hung, whole[cut])
        # Along the path from every centroid to the top of its component.
        at, origin = centre, centre
        while at.size:
            totals[at] += below[origin]
            onward = up[at] >= 0
            at, origin = up[at[onward]], origin[onward]
            size[at] -= size[origin]
        up[centre] = -1
    return totals


def _decompose(columns: list[str], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Totals of whole pieces; rows come sorted by piece."""
    def totals(table: pa.Table) -> pa.Table:
        key = pd.Index(table["key"].to_pandas())
        up = key.get_indexer(pd.Index(table["up"].to_pandas()))
        up[(table["key"].to_pandas() == table["piece"].to_pandas()).to_numpy()] = -1
        weights = np.column_stack([table[c].to_numpy() for c in columns]).astype(np.int64)
        found = centroid_totals(up, weights)
        return pa.table({"key": table["key"], **{c: found[:, i] for i, c in enumerate(columns)}})

    held: list[pa.RecordBatch] = []
    for batch in batches:
        held.append(batch)
        if sum(b.num_rows for b in held) >= BATCH:
            table = pa.Table.from_batches(held)
            piece = table["piece"].to_pandas().to_numpy()
            whole = int(np.flatnonzero(piece != piece[-1])[-1]) + 1 if (piece != piece[-1]).any() else 0
            if whole:
                yield from totals(table.slice(0, whole)).to_batches()
            held = table.slice(whole).to_batches()
    if held and any(b.num_rows for b in held):
        yield from totals(pa.Table.from_batches(held)).to_batches()


def _by_piece(nodes: DataFrame, columns: list[str]) -> DataFrame:
    """(key, totals) within the pieces of (key, up, piece, weights)."""
    schema = "key string, " + ", ".join(f"{c} long" for c in columns)
    rows = nodes.select("key", "up", "piece", *columns).repartition("piece").sortWithinPartitions("piece")
    return stored(rows.mapInArrow(partial(_decompose, columns), schema), "totals")


def _plus(a: DataFrame, b: DataFrame, columns: list[str]) -> DataFrame:
    return a.unionByName(b).groupBy("key").agg(*[F.sum(c).alias(c) for c in columns])


# -- cutting the forest into pieces ------------------------------------------------------------------


def _within(nodes: DataFrame, steps: DataFrame, columns: list[str], deep: int) -> DataFrame:
    """(key, totals) over the subtrees of one rank: nodes (key, up, conv, depth, weights), paths (conv, depth, key)."""
    block = F.floor(F.col("depth") / deep)
    tops = stored(steps.groupBy("conv", block.alias("block")).agg(F.min_by("key", "depth").alias("piece")), "tops")
    nodes = stored(nodes.withColumn("block", block).join(tops, ["conv", "block"]), "pieces")
    first = _by_piece(nodes, columns)
    least, most = nodes.agg(F.min("block"), F.max("block")).first()
    if least == most:
        return first
    # The pieces are a forest themselves, with a fraction of the depth.
    whose = nodes.select(F.col("key").alias("up"), F.col("piece").alias("up_piece"))
    heads = nodes.filter("key = piece").select("key", "up", "conv", F.col("block").alias("depth")).join(whose, "up", "left")
    heads = stored(heads.join(first, "key"), "heads")
    above = _within(heads.select("key", F.col("up_piece").alias("up"), "conv", "depth", *columns),
                    tops.select("conv", F.col("block").alias("depth"), F.col("piece").alias("key")), columns, deep)
    # What hangs on a node from further pieces goes through its own piece as a weight.
    hung = heads.filter("up_piece is not null").select("key", "up").join(above, "key").groupBy("up").agg(
        *[F.sum(c).alias(c) for c in columns]).withColumnRenamed("up", "key")
    loaded = nodes.drop(*columns).join(hung, "key", "left").fillna(0, columns)
    return stored(_plus(first, _by_piece(loaded, columns), columns), "sums")


def rollup(nodes: DataFrame, steps: DataFrame, members: DataFrame, columns: list[str], width: int = MEMBERS,
           deep: int = DEPTH) -> DataFrame:
    """(key, totals): sums of weight columns over the subtree of every node of :func:`tree`, itself included."""
    def rank(n: str) -> Column:
        return F.floor(F.log(F.col(n)) / F.log(F.lit(float(width))))

    nodes = stored(nodes.select("key", "up", "conv", "depth", rank("n").alias("rank"), rank("parent_n").alias("above"), *columns), "ranks")
    every = steps.select("conv", "depth", "key").unionByName(members.select("conv", F.lit(0).cast("long").alias("depth"), _root().alias("key")))
    steps = stored(every.join(nodes.select("key", "rank"), "key"), "steps")
    done, hung = nodes.select("key", *columns).limit(0), nodes.select("key", *columns).limit(0)
    for at in range((nodes.agg(F.max("rank")).first()[0] or 0) + 1):
        here = nodes.filter(F.col("rank") == at)
        loads = here.select("key", *columns).unionByName(hung.join(here.select("key"), "key", "left_semi"))
        loads = loads.groupBy("key").agg(*[F.sum(c).alias(c) for c in columns])
        inside = here.select("key", F.when(F.col("above") == at, F.col("up")).alias("up"), "conv", "depth").join(loads, "key")
        totals = _within(inside, steps.filter(F.col("rank") == at).drop("rank"), columns, deep)
        done = done.unionByName(totals)
        tops = here.filter(F.col("above") > at).select("key", "up").join(totals, "key")
        hung = stored(hung.unionByName(tops.groupBy("up").agg(*[F.sum(c).alias(c) for c in columns]).withColumnRenamed("up", "key")), "hung")
    return done


# -- members that end at a node ----------------------------------------------------------------------


def _hash_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of the comma-joined strings of every key; rows come sorted, nothing but the digest is held."""
    now, digest = None, None
    keys: list[str] = []
    shas: list[str] = []
    for batch in batches:
        for key, ids in zip(batch.column("key").to_pylist(), batch.column("ids").to_pylist(), strict=True):
            if key != now:
                if now is not None:
                    keys.append(now)
                    shas.append(digest.hexdigest())
                now, digest = key, hashlib.sha256()
            else:
                digest.update(b",")
            digest.update(ids.encode())
        if len(keys) > 10_000:
            yield pa.RecordBatch.from_pydict({"key": keys, "sha256": shas})
            keys, shas = [], []
    if now is not None:
        yield pa.RecordBatch.from_pydict({"key": [*keys, now], "sha256": [*shas, digest.hexdigest()]})


def ends(steps: DataFrame, members: DataFrame) -> DataFrame:
    """(key, sha256) of the ascending, comma-joined ids of the conversations that end at a node.

    Ids are joined in runs of at most ``IDS``, so that a node where a third of
    all conversations end is a row per run in the pass that feeds the digest.
    """
    last = steps.groupBy("conv").agg(F.max_by("key", "depth").alias("key"))
    every = members.select("conv").join(last, "conv", "left").select("conv", F.coalesce("key", _root()).alias("key"))
    runs = every.groupBy("key", F.floor(F.col("conv") / IDS).alias("run")).agg(F.sort_array(F.collect_list("conv")).alias("ids"))
    runs = runs.select("key", "run", F.array_join(F.transform("ids", lambda i: i.cast("string")), ",").alias("ids"))
    return runs.repartition("key").sortWithinPartitions("key", "run").mapInArrow(_hash_runs, "key string, sha256 string")


def summary(turns: DataFrame, members: DataFrame, width: int = MEMBERS, deep: int = DEPTH) -> DataFrame:
    """One row per node of the trie of (conv, depth, sha, bytes) rows, for all ``members`` (conv), also those without turns.

    (key, up, conv, depth, parent_conv, n, children, leaves, saved, ends): least
    member, its parent's least member, members, children, leaves of the subtree,
    bytes that members after the first share with it over the subtree, and the
    digest of the members that end there.
    """
    steps, members = stored(paths(turns), "paths"), stored(members.select("conv").distinct(), "members")
    nodes = tree(steps, members)
    below = nodes.filter("up is not null").groupBy(F.col("up").alias("of")).agg(F.count("*").alias("children"))
    nodes = nodes.join(below, F.col("key") == F.col("of"), "left").drop("of").fillna(0, ["children"])
    nodes = stored(nodes.withColumn("leaves", (F.col("children") == 0).cast("long")).withColumn(
        "saved", (F.col("n") - 1) * F.col("bytes")), "tree")
    totals = rollup(nodes, steps, members, ["leaves", "saved"], width, deep)
    out = nodes.drop("leaves", "saved", "bytes", "parent_n").join(stored(totals, "totals"), "key")
    out = out.join(stored(ends(steps, members), "ends"), "key", "left")
    return out.withColumn("ends", F.coalesce("sha256", F.sha2(F.lit(""), 256))).drop("sha256")
