"""Prefix trie of conversations: blocks of turns first, single turns only where siblings diverge.

Every conversation is cut into blocks of BLOCK turns (the last may be shorter),
and each block has a digest. Conversations that agree in all blocks so far are
one class, told by running digests over the blocks' digests, so the trie of
blocks is one grouping, however many conversations or levels there are. A
class stands in the turn trie by one conversation, its smallest. Where a parent
has a single class, the turns inside are nodes as they are; where it has more,
digests of the turns so far group the classes turn by turn.

What a node needs of its subtree comes from its members alone. Let r be the
depth from which on a conversation c is the smallest member of its nodes, and
P the bytes of its turns before r. Then c shares exactly its first r - 1 turns
with smaller conversations, and a node of smallest member m saves, in its
subtree, the sum of P over its other members less the bytes above the node, once for each.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import settle_table
from .sequences import NOTHING, SPAN, digests, numbered, running

#: Turns in a block.
BLOCK = 8


def prefix_trie(conversations: DataFrame, turns: DataFrame, block: int = BLOCK) -> DataFrame:
    """One row per node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256, node.

    conversations: conv_id (whole numbers, each counted once, turnless ones
    included; nulls are left out). turns: conv_id, depth (1, 2, ... without
    gaps), role, text, of these conversations; a null role or text is empty.
    Other columns are not read. No conversations give no rows. conv_id: the
    smallest member. saved_tokens: over the subtree, (n_convs - 1) times the
    UTF-8 bytes of the last text. node names a node, parent its parent.
    """
    if block < 1:
        raise ValueError("a block holds one turn or more")
    ids = conversations.where("conv_id is not null").select(F.col("conv_id").cast("long")).distinct()
    blocks = settle_table(_blocks(turns, block))
    rows = settle_table(_turn_rows(_classes(blocks), block))
    root = ids.agg(F.min("conv_id").alias("first")).where("first is not null").select(
        F.lit(ROOT).alias("node"), F.lit(None).cast("string").alias("parent"), F.lit(0).alias("depth"),
        "first", F.lit(0).cast("long").alias("ends"), F.lit(0).cast("long").alias("above"),
    )
    nodes = rows.groupBy("node").agg(
        F.first("parent").alias("parent"), F.first("depth").alias("depth"), F.min("first").alias("first"),
        F.sum("ends").alias("ends"), F.first("above").alias("above"),
    )
    nodes = settle_table(nodes.unionByName(root))
    children = nodes.groupBy(F.col("parent").alias("node")).agg(F.count("*").alias("n_children"))

    # Of each conversation: the bytes of its turns above the first node whose smallest member it is, and whether it is
    # the smallest to end in a node without children.
    own = nodes.groupBy(F.col("first").alias("conv_id")).agg(F.min_by("above", "depth").alias("shared"))
    leaves = nodes.where("ends > 0").join(children, "node", "left_anti").select(F.col("first").alias("conv_id"), F.lit(1).alias("leaf"))
    sizes = blocks.groupBy("conv_id").agg(F.max("upto").alias("bytes"))
    people = ids.join(sizes, "conv_id", "left").join(own, "conv_id", "left").join(leaves, "conv_id", "left")
    people = settle_table(
        people.select(
            "conv_id", F.coalesce("shared", "bytes", F.lit(0)).alias("shared"), F.coalesce("leaf", F.lit(0)).alias("leaf"), "bytes"
        )
    )
    sums = [
        F.sum("shared").alias("shared"), F.min_by("shared", "conv_id").alias("first_shared"),
        F.sum("leaf").alias("n_leaves"), F.count("*").alias("members"),
    ]
    held = blocks.select("conv_id", "class").join(people, "conv_id").groupBy("class").agg(*sums)
    held = held.join(_ended(blocks.where("last").select("conv_id", "class")), "class", "left")
    merged = rows.join(held, "class").groupBy("node").agg(
        F.sum("members").alias("n_convs"), F.sum("n_leaves").alias("n_leaves"),
        (F.sum("shared") - F.min_by("first_shared", "first")).alias("shared"),
        F.max(F.when(F.col("ends") > 0, F.col("ends_sha256"))).alias("ends_sha256"),
    )
    top = people.agg(*sums).where("members > 0").select(
        F.lit(ROOT).alias("node"), F.col("members").alias("n_convs"), "n_leaves", (F.col("shared") - F.col("first_shared")).alias("shared")
    )
    turnless = people.where("bytes is null").select("conv_id", F.lit(ROOT).alias("class"))
    top = top.join(_ended(turnless).withColumnRenamed("class", "node"), "node", "left")
    every = settle_table(
        nodes.join(merged.unionByName(top), "node")
        .join(children, "node", "left")
        .select(
            "node", "parent", F.col("first").alias("conv_id"), F.col("depth").cast("long").alias("depth"), "n_convs",
            F.coalesce("n_children", F.lit(0)).cast("long").alias("n_children"),
            F.greatest("n_leaves", F.lit(1)).cast("long").alias("n_leaves"),
            (F.col("shared") - (F.col("n_convs") - 1) * F.col("above")).cast("long").alias("saved_tokens"),
            F.coalesce("ends_sha256", F.lit(NOTHING)).alias("ends_sha256"),
        )
    )
    above = every.select(F.col("node").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    # A parent may have most nodes as its children; adaptive execution splits such a join.
    return every.join(above, "parent", "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256", "node", "parent"
    )


#: The root's name. Names of nodes: running digests at the end of a whole block, else those before it, the depth and the turns' digest.
ROOT = "0:0"


def _ended(rows: DataFrame) -> DataFrame:
    """class, ends_sha256: digest of the numbers of the conversations (conv_id, class), ascending, with commas between."""
    part = rows.groupBy("class", F.floor(F.col("conv_id") / SPAN).alias("part")).agg(
        F.array_join(F.transform(F.array_sort(F.collect_list("conv_id")), lambda c: c.cast("string")), ",").alias("piece")
    )
    return digests(part, "class", "part", "piece", ",").withColumnRenamed("sha256", "ends_sha256")


def _blocks(turns: DataFrame, block: int) -> DataFrame:
    """conv_id, k, turns (digest and bytes of each), before and class (running digests), above (bytes before), upto, last."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    told = F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256)
    rows = turns.select(
        F.col("conv_id").cast("long"), F.col("depth").cast("long"), told.alias("told"), F.octet_length(text).cast("long").alias("bytes")
    )
    made = rows.groupBy("conv_id", F.floor((F.col("depth") - 1) / block).alias("k")).agg(
        F.array_sort(F.collect_list(F.struct("depth", "told", "bytes"))).alias("turns"), F.sum("bytes").alias("bytes")
    )
    digest = F.sha2(F.array_join("turns.told", ""), 256)
    # Two digests of 64 bits, mixed with the block's place, so that their running exclusive or tells the order.
    made = made.withColumns({"x": F.xxhash64("k", digest), "y": F.xxhash64(digest, "k")})
    zero = F.lit(0).cast("long")
    found = running(
        made, "conv_id", "k", {"a": (F.bit_xor, F.col("x"), zero), "b": (F.bit_xor, F.col("y"), zero), "upto": (F.sum, F.col("bytes"), zero)}
    )
    lengths = rows.groupBy("conv_id").agg(F.max("depth").alias("length"))
    return found.join(lengths, "conv_id").select(
        "conv_id", F.col("k").cast("long").alias("k"),
        F.transform("turns", lambda t: F.struct(t["told"].alias("told"), t["bytes"].alias("bytes"))).alias("turns"),
        F.concat_ws(":", F.hex(F.col("a").bitwiseXOR(F.col("x"))), F.hex(F.col("b").bitwiseXOR(F.col("y")))).alias("before"),
        F.concat_ws(":", F.hex("a"), F.hex("b")).alias("class"),
        (F.col("upto") - F.col("bytes")).alias("above"), "upto",
        (F.col("length") <= (F.col("k") + 1) * block).alias("last"),
    )


def _classes(blocks: DataFrame) -> DataFrame:
    """One row per class of blocks: class, before, k, first (member), ends (members that end in it), turns, above, alone (no sibling)."""
    classes = settle_table(
        blocks.groupBy("class").agg(
            F.first("before").alias("before"), F.first("k").alias("k"), F.min("conv_id").alias("first"),
            F.count_if("last").alias("ends"), F.first("turns").alias("turns"), F.first("above").alias("above"),
        )
    )
    # Told by the class itself, so that a parent of many children is nobody's join key.
    only = classes.groupBy("before").agg(F.count("*").alias("n"), F.min("class").alias("class")).where("n = 1")
    return classes.join(only.select("class", F.lit(True).alias("alone")), "class", "left")


def _turn_rows(classes: DataFrame, block: int) -> DataFrame:
    """A row per class and turn: node, parent, depth, class, first, ends (of this turn), above. Classes that share a turn share its node."""
    # Digests of the turns so far, made only where siblings diverge.
    so_far = F.transform(
        F.sequence(F.lit(1), F.size("turns")),
        lambda j: F.when(F.col("alone"), F.lit("")).otherwise(F.md5(F.array_join(F.slice("turns.told", F.lit(1), j), "").cast("binary"))),
    )
    rows = classes.withColumn("so_far", so_far).select("*", F.posexplode("turns").alias("at", "turn"))

    def name(j: Column) -> Column:
        return F.when(j == block, F.col("class")).otherwise(F.concat_ws(":", "before", j.cast("string"), F.get("so_far", j - 1)))

    earlier = F.aggregate(F.slice("turns.bytes", F.lit(1), F.col("at")), F.lit(0).cast("long"), lambda total, x: total + x)
    return rows.select(
        name(F.col("at") + 1).alias("node"),
        F.when(F.col("at") == 0, F.col("before")).otherwise(name(F.col("at"))).alias("parent"),
        (F.col("k") * block + F.col("at") + 1).cast("int").alias("depth"),
        "class",
        "first",
        F.when(F.col("at") + 1 == F.size("turns"), F.col("ends")).otherwise(0).alias("ends"),
        (F.col("above") + earlier).alias("above"),
    )
