"""Merkle manifest of a dataset by butterfly exchange.

A leaf is the hash of a row's fields. The leaves of a source, in id order,
are hashed in runs of `FANOUT` consecutive nodes, level by level, until one
node is left (the subroot); the subroots are the leaves of one more tree.

1. Leaves are sorted over the cluster by source and id; a leaf's place in
   its source is its place in its part of the sort plus the sizes of the
   parts before, so a source of any share of the rows is dealt like the rest.
2. A block is an aligned range of `BLOCK` (a power of the fanout) places of a
   source: it hashes its own subtree in one task.
3. Butterfly: in round r the blocks whose numbers differ in the r-th digit
   (base `FANOUT`) only are a group. Each sends its subtree's root to all
   others of the group, and each of them puts the run together and hashes
   the parent itself, redundantly. After log(blocks) rounds every block holds
   the root and all runs on its way up, that is, the upper part of its
   leaves' proofs; nothing is sent down again. In the last, incomplete group
   a missing sender is stood in for by the last block of its subtree, which
   has the same root. A round is one shuffle of `FANOUT` small rows per block.
4. Proofs: a leaf's siblings inside its block, then those of its block's runs,
   then those of its source in the tree of subroots. A block is taken apart
   into runs before leaves, so a task holds the proof of one leaf at a time:
   a block's proofs are some 20 MB, twenty times its leaves.

A digest is 64 hexadecimal characters, and inputs of the hash are joined as
text, so the same expressions verify proofs inside Spark (`folded`).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from branchcost.llm.common import stage_table

FANOUT = 16
LEVELS = 3  # levels that a block hashes itself
HEX = 64
PATH = "array<struct<place: int, others: int>>"

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def digest(c: Column) -> Column:
    """Lower-case hex SHA-256 of a text."""
    return F.sha2(c.cast("binary"), 256)


def field(c: Column) -> Column:
    """A value as its UTF-8 byte count, a colon and the value; null as a dash."""
    text = c.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(df: DataFrame, fields=FIELDS, **instead: Column) -> Column:
    """Hash of the fields of a row of `df`; `instead` gives other values for some."""
    return digest(F.concat(*[field(instead.get(c, F.col(c))) for c in fields]))


def _height(n: int, fanout: int) -> int:
    h = 0
    while n > 1:
        n, h = -(-n // fanout), h + 1
    return h


def _subtree(leaves: Column, low: Column, fanout: int) -> Column:
    """Nodes of each level from the leaves up, `low` times hashed: a text for a level, its digests joined."""
    width = HEX * fanout

    def up(below: Column) -> Column:
        starts = F.sequence(F.lit(1), F.octet_length(below), F.lit(width))
        return F.array_join(F.transform(starts, lambda at: F.sha2(F.substring(below, at, F.lit(width)), 256)), "").cast("binary")

    levels = F.array(F.array_join(leaves, "").cast("binary"))
    return F.aggregate(F.array_repeat(F.lit(0), low), levels, lambda found, _: F.concat(found, F.array(up(F.element_at(found, -1)))))


def _without(run: Column, place: Column) -> Column:
    """A run's digests, joined, but that at `place`."""
    return F.concat(F.substring(run, F.lit(1), place * HEX), F.substring(run, (place + 1) * HEX + 1, F.octet_length(run)))


def _step(run: Column, place: Column) -> Column:
    """Entry of a proof's path for a node of the run."""
    others = F.floor(F.octet_length(run) / HEX) - 1
    return F.struct(place.cast("int").alias("place"), others.cast("int").alias("others"))


def _placed(leaves: DataFrame, group: str, order: list[str]) -> DataFrame:
    """`leaves` with `tree` (a number per group, in group order, null first), `place` (in its tree) and `size`."""
    keys = [F.col(c).asc_nulls_first() for c in [group, *order]]
    ordered = leaves.repartitionByRange(*keys).sortWithinPartitions(*keys)
    # ids count rows within each part of the sort, from a multiple of 2**33 on
    ordered = stage_table(ordered.withColumn("row", F.monotonically_increasing_id()), "merkle-sorted")
    ordered = ordered.withColumn("part", F.shiftright("row", 33))
    parts = ordered.groupBy(F.col(group).alias("g"), F.col("part").alias("p")).agg(
        F.min("row").alias("first"), F.count("*").alias("n")
    )
    trees = parts.groupBy(F.col("g").alias("t")).agg(F.min("first").alias("tree"), F.sum("n").alias("size"))
    before = Window.partitionBy("g").orderBy("p").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.withColumn("offset", F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("first"))
    parts = stage_table(parts.join(trees, F.col("g").eqNullSafe(F.col("t"))).select("g", "p", "offset", "tree", "size"), "merkle-parts")
    return (
        ordered.join(parts, (F.col("part") == F.col("p")) & F.col(group).eqNullSafe(F.col("g")))
        .withColumn("place", F.col("row") + F.col("offset"))
        .drop("g", "p", "part", "row", "offset")
    )


def _blocks(placed: DataFrame, carried: list[str], fanout: int, levels: int) -> DataFrame:
    """A row for each block: its leaves in order, the nodes of its subtree by level and its root."""
    span = fanout**levels
    row = F.struct("place", "leaf", *carried)
    packed = (
        placed.withColumn("block", F.floor(F.col("place") / span))
        .groupBy("tree", "block")
        .agg(F.max("size").alias("size"), F.sort_array(F.collect_list(row)).alias("leaves"))
    )
    # a tree of fewer levels than a block has ends in its only block
    low = sum((F.col("size") > fanout**k).cast("int") for k in range(levels))
    blocks = packed.withColumn("nodes", _subtree(F.col("leaves.leaf"), low, fanout))
    return stage_table(blocks.withColumn("root", F.element_at("nodes", -1).cast("string")), "merkle-blocks")


def _exchanged(blocks: DataFrame, fanout: int, levels: int) -> DataFrame:
    """(tree, block, root, runs): each block with its tree's root and the runs above it, lowest first."""
    span = fanout**levels
    state = blocks.select(
        "tree", "block", F.ceil(F.col("size") / span).alias("blocks"), "root", F.array().cast("array<string>").alias("runs")
    )
    most = state.agg(F.max("blocks")).first()[0] or 0
    done = None
    for turn in range(_height(most, fanout)):
        width = fanout**turn  # blocks below a node of this round
        nodes = F.ceil(F.col("blocks") / width)
        finished = state.where(nodes == 1)
        done = finished if done is None else done.unionByName(finished)
        node, low = F.floor(F.col("block") / width), F.col("block") % width
        run = F.floor(node / fanout) * fanout
        size = lambda at: F.least(F.lit(width).cast("long"), F.col("blocks") - at * width)
        sent = state.where(nodes > 1).withColumns({"node": node, "low": low, "run": run, "own_size": size(node)})
        sent = sent.withColumn("to", F.explode(F.sequence(F.col("run"), F.least(F.col("run") + fanout, nodes) - 1)))
        # the last block of a subtree also stands in for those that it lacks
        last = F.when(F.col("low") == F.col("own_size") - 1, F.lit(width - 1)).otherwise(F.col("low"))
        last = F.least(last, size(F.col("to")) - 1)
        sent = sent.where(F.col("low") <= last).withColumn("at", F.explode(F.sequence(F.col("low"), last)))
        receiver = F.col("to") * width + F.col("at")
        own = receiver == F.col("block")
        got = sent.groupBy("tree", receiver.alias("receiver")).agg(
            F.max("blocks").alias("blocks"),
            F.array_join(F.sort_array(F.collect_list(F.struct("node", "root")))["root"], "").alias("run"),
            F.first(F.when(own, F.col("runs")), ignorenulls=True).alias("runs"),
        )
        state = stage_table(
            got.select(
                "tree",
                F.col("receiver").alias("block"),
                "blocks",
                digest(F.col("run")).alias("root"),
                F.concat("runs", F.array("run")).alias("runs"),
            ),
            "merkle-round",
        )
    state = state if done is None else done.unionByName(state)
    return state.select("tree", "block", "root", "runs")


def _proved(blocks: DataFrame, states: DataFrame, carried: list[str], fanout: int, levels: int) -> DataFrame:
    """(tree, root, *carried, leaf, proof, path) of every leaf."""
    nothing, no_path = F.lit("").cast("binary"), F.array().cast(PATH)
    rows = blocks.join(states.select("tree", "block", F.col("root").alias("top"), "runs"), ["tree", "block"])

    def at_height(number: Column, height: Column) -> Column:
        """Place, in its run, of the node above a node of that number."""
        return F.floor(number / F.pow(F.lit(fanout), height)) % fanout

    # the runs above the block are the same for all its leaves
    upper = F.transform("runs", lambda run, k: _without(run, at_height(F.col("block"), k).cast("int")))
    upper_path = F.transform("runs", lambda run, k: _step(run, at_height(F.col("block"), k)))
    # a single leaf that is its tree's root is in no run
    rows = rows.withColumns({"upper": F.array_join(upper, ""), "upper_path": upper_path, "low": F.size("nodes") - 1})

    def of_run(number: Column) -> Column:
        """A run of leaves, its digests, and the proof and path that its leaves share inside the block."""
        proof, path = nothing, no_path
        for k in range(1, levels):
            place = at_height(number, F.lit(k - 1)).cast("int")
            first = F.floor(number / fanout ** (k - 1)).cast("int") - place
            run = F.substring(F.get("nodes", F.lit(k)), first * HEX + 1, F.lit(fanout * HEX))
            proof = F.concat(proof, F.when(F.col("low") > k, _without(run, place)).otherwise(nothing))
            path = F.concat(path, F.when(F.col("low") > k, F.array(_step(run, place))).otherwise(no_path))
        return F.struct(
            F.slice("leaves", number * fanout + 1, fanout).alias("leaves"),
            F.substring(F.get("nodes", F.lit(0)), number * fanout * HEX + 1, F.lit(fanout * HEX)).alias("run"),
            proof.alias("proof"),
            path.alias("path"),
        )

    numbers = F.sequence(F.lit(0), F.floor((F.size("leaves") - 1) / fanout).cast("int"))
    runs = rows.select("tree", "top", "low", "upper", "upper_path", F.explode(F.transform(numbers, of_run)).alias("r"))
    each = runs.select("*", F.posexplode("r.leaves").alias("place", "own"))
    path = F.when(F.col("low") > 0, F.array(_step(F.col("r.run"), F.col("place")))).otherwise(no_path)
    return each.select(
        "tree",
        F.col("top").alias("root"),
        *[F.col(f"own.{c}").alias(c) for c in [*carried, "leaf"]],
        F.concat(_without(F.col("r.run"), F.col("place")), F.col("r.proof"), F.col("upper").cast("binary")).cast("string").alias("proof"),
        F.concat(path, F.col("r.path"), F.col("upper_path")).alias("path"),
    )


def manifest(
    rows: DataFrame, group: str, order: list[str], leaf_col: str, carried: list[str], fanout: int = FANOUT, levels: int = LEVELS
) -> DataFrame:
    """(*carried, leaf, subroot, root, proof, path): the tree's entry of every row.

    `rows` has a leaf digest, a group (null is a group, and comes first;
    groups are ordered bytewise) and columns that order the leaves of a group
    (nulls first; ties are broken by the digest, so rows that remain tied are
    equal and interchangeable). `proof` is the digests of the siblings on all
    levels, joined, from the leaf's run up and left to right; `path` has, for
    each level, the node's place in its run and the number of its siblings. A
    group of one leaf has that as its subroot, a single subroot is the root;
    those levels have no entry. An empty table gives no rows.
    """
    named = rows.select(
        F.col(group).alias("group"),
        *[F.col(c).alias(f"order_{i}") for i, c in enumerate(order)],
        F.col(leaf_col).alias("leaf"),
        *[F.col(c).alias(f"carried_{i}") for i, c in enumerate(carried)],
    )
    kept = [f"carried_{i}" for i in range(len(carried))]
    # the sort samples its input, so the leaves are hashed before, once
    named = stage_table(named, "merkle-leaves")
    placed = _placed(named, "group", [f"order_{i}" for i in range(len(order))] + ["leaf"])
    blocks = _blocks(placed, kept, fanout, levels)
    states = stage_table(_exchanged(blocks, fanout, levels), "merkle-states")
    # the tree of subroots: one leaf for each tree, in the order of the trees' numbers
    subroots = states.where("block = 0").select(F.lit(0).alias("whole"), F.col("tree").alias("number"), F.col("root").alias("leaf"))
    top_blocks = _blocks(_placed(stage_table(subroots, "merkle-subroots"), "whole", ["number"]), ["number"], fanout, levels)
    top = _proved(top_blocks, _exchanged(top_blocks, fanout, levels), ["number"], fanout, levels)
    top = top.select(F.col("number").alias("tree"), F.col("root").alias("top"), F.col("proof").alias("top_proof"), F.col("path").alias("top_path"))
    own = _proved(blocks, states, kept, fanout, levels)
    return own.join(stage_table(top, "merkle-top"), "tree").select(
        *[F.col(k).alias(c) for k, c in zip(kept, carried)],
        "leaf",
        F.col("root").alias("subroot"),
        F.col("top").alias("root"),
        F.concat("proof", "top_proof").alias("proof"),
        F.concat("path", "top_path").alias("path"),
    )


def folded(leaf_digest: Column, proof: Column, path: Column) -> Column:
    """Root that a leaf gives with a proof."""
    start = F.struct(leaf_digest.alias("node"), F.lit(0).alias("used"))

    def up(state, step):
        run = F.concat(
            F.substring(proof, state["used"] * HEX + 1, step["place"] * HEX),
            state["node"],
            F.substring(proof, (state["used"] + step["place"]) * HEX + 1, (step["others"] - step["place"]) * HEX),
        )
        return F.struct(digest(run).alias("node"), (state["used"] + step["others"]).alias("used"))

    return F.aggregate(path, start, up, lambda state: state["node"])


def document_manifest(docs: DataFrame, tampered: Column | None = None, fanout: int = FANOUT, levels: int = LEVELS) -> DataFrame:
    """Manifest of a documents table: doc_id, source and what `manifest` returns.

    Leaves are of doc_id, source, lang, n_chars and text (`FIELDS`), ascending
    by doc_id within a source. With `tampered`, a column of texts (null: as
    it is), `shown` is the leaf with that text instead, else the leaf itself.
    Null and empty texts differ (a dash, a zero count); repeated rows are
    leaves of their own; further columns are ignored.
    """
    shown = leaf(docs) if tampered is None else F.when(tampered.isNotNull(), leaf(docs, text=tampered))
    rows = docs.select("doc_id", "source", leaf(docs).alias("leaf"), shown.alias("shown"))
    found = manifest(rows, "source", ["doc_id"], "leaf", ["doc_id", "source", "shown"], fanout, levels)
    return found.withColumn("shown", F.coalesce("shown", "leaf"))
