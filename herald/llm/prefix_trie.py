"""Prefix trie of conversations, with subtree totals by parallel tree contraction.

A node is a distinct sequence of first turns. It is known by its depth and 128 bits
that combine a hash of every turn *with its position* by exclusive or, so that a
running window over a conversation's turns gives all its nodes, and a
conversation cut over several tasks needs one value a cut. No sequence is ever put together.

Subtree totals come from tree contraction in rounds of joins. A round first *compresses*: every
chain of nodes with one child each gives way to the node below it, by pointer doubling;
then it *rakes*: the leaves hand their totals to their parents and go. At least half of
what a compression leaves are leaves, so the rounds grow with the logarithm of the
tree. A raked node's total is known at once; a compressed one's is its own chain's
weight and the total of the node below the chain, which is looked up as the rounds
are undone, the last one first.

One conversation, turn or parent may hold a third of all rows: turns are numbered over
ranges of the sorted table, sums are combined before they are shuffled, and lookups by a
frequent key go through :func:`split_join`.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from herald.llm.common import WORD_PATTERN, Scratch, split_join

EMPTY_SHA = hashlib.sha256(b"").hexdigest()


# ---------------------------------------------------------------- turns in order

def _running(df: DataFrame, group: list[str], order: list[str], values: dict[str, Column], before: dict[str, Column],
             key: str) -> DataFrame:
    """Windowed ``values`` inside (``key``, range) parts, and ``before`` from the parts before.

    ``values`` are windowed inside a part; ``before`` aggregates a part's whole and is combined
    over the earlier parts of the same key. Only a key that goes over the end of a range has
    more than one part, so fewer parts follow another than there are ranges: these are broadcast.
    """
    parts = df.groupBy(*group).agg(*[c.alias(n) for n, c in before.items()])
    earlier = Window.partitionBy(key).orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    first = Window.partitionBy(key).orderBy("range")
    sums = {n: (F.sum(n) if n == "count" else F.bit_xor(n)).over(earlier) for n in before}
    follow = parts.withColumn("nth", F.row_number().over(first)).withColumns({f"{n}_before": c for n, c in sums.items()}) \
        .filter("nth > 1").select(*group, *[f"{n}_before" for n in before])
    inside = Window.partitionBy(*group).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    out = df.withColumns({n: c.over(inside) for n, c in values.items()})
    return out.join(F.broadcast(follow), group, "left")


def numbered_turns(turns: DataFrame, scratch: Scratch, conv_col: str, turn_col: str, role_col: str, text_col: str
                   ) -> DataFrame:
    """``conv, range, pos (from 1), key, words``: the turns of each conversation in order.

    Order is by turn, null first, ties by the turn's key, a SHA-256 of role and text, so
    that texts are never shuffled. ``range`` numbers the ranges of the sorted table.
    """
    role, text = F.coalesce(F.col(role_col), F.lit("")), F.coalesce(F.col(text_col), F.lit(""))
    key = F.unhex(F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256))
    slim = scratch.write(turns.filter(F.col(conv_col).isNotNull()).select(
        F.col(conv_col).cast("long").alias("conv"), F.col(turn_col).cast("long").alias("turn"), key.alias("key"),
        F.regexp_count(text, F.lit(WORD_PATTERN)).cast("long").alias("words"),
        F.monotonically_increasing_id().alias("nr")))
    ranged = scratch.write(slim.repartitionByRange("conv", "turn", "key", "nr")
                           .withColumn("range", F.spark_partition_id()))
    x = _running(ranged, ["conv", "range"], ["turn", "key", "nr"], {"place": F.count(F.lit(1))},
                 {"count": F.count(F.lit(1))}, "conv")
    return scratch.write(x.select("conv", "range", (F.col("place") + F.coalesce("count_before", F.lit(0))).alias("pos"),
                                  "key", "words"))


def rebuilt(numbered: DataFrame, scratch: Scratch, base_of: Column, taken: Column, most: int) -> tuple[DataFrame, DataFrame]:
    """Conversations that start with turns of another one: ``(conversations, turns)``.

    Conversation ``conv`` starts with the first ``taken`` (at most ``most``) turns of
    conversation ``base_of``, all if it has fewer, none if there is no such one; its own turns after
    its first ``taken`` follow. ``conversations``: conv; ``turns``: conv, range, pos, key, words.
    """
    first = numbered.filter("pos = 1").select("conv", "range", base_of.alias("base"), taken.cast("int").alias("h"))
    heads = numbered.filter(F.col("pos") <= most).join(first.select(F.col("base").alias("conv")).distinct(), "conv", "left_semi") \
        .groupBy(F.col("conv").alias("base")).agg(
            F.array_sort(F.collect_list(F.struct("pos", "key", "words"))).alias("head"))
    convs = split_join(first, heads, "base", scratch)
    none = F.array().cast(heads.schema["head"].dataType)
    convs = scratch.write(convs.select("conv", "range", "h", F.slice(F.coalesce("head", none), F.lit(1), F.col("h"))
                                       .alias("head")))
    lent = convs.select("conv", "range", F.explode("head").alias("t")).select("conv", "range", "t.*")
    shift = convs.filter(F.size("head") < F.col("h")).select("conv", (F.col("h") - F.size("head")).alias("less"))
    own = split_join(numbered.filter(F.col("pos") > taken), shift, "conv", scratch)
    own = own.select("conv", "range", (F.col("pos") - F.coalesce("less", F.lit(0))).alias("pos"), "key", "words")
    return convs.select("conv"), scratch.write(lent.unionByName(own))


# ---------------------------------------------------------------- nodes

def paths(turns: DataFrame, scratch: Scratch) -> DataFrame:
    """``conv, depth, a, b, pa, pb, words``: every node of a conversation but the root, and its parent."""
    own = {"ha": F.xxhash64("pos", "key"), "hb": F.xxhash64("key", "pos", F.lit("trie"))}
    x = turns.withColumns(own)
    x = _running(x, ["conv", "range"], ["pos"], {"xa": F.bit_xor("ha"), "xb": F.bit_xor("hb")},
                 {"ta": F.bit_xor("ha"), "tb": F.bit_xor("hb")}, "conv")
    zero = F.lit(0).cast("long")
    x = x.withColumns({n: F.col(c).bitwiseXOR(F.coalesce(t, zero))
                       for n, c, t in (("a", "xa", "ta_before"), ("b", "xb", "tb_before"))})
    return scratch.write(x.select("conv", F.col("pos").alias("depth"), "a", "b", F.col("a").bitwiseXOR(F.col("ha")).alias("pa"),
                                  F.col("b").bitwiseXOR(F.col("hb")).alias("pb"), "words"))


def _joined_sha(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of each node's conversation ids, comma-joined, from sorted (depth, a, b, conv) rows."""
    schema = pa.schema([("depth", pa.int64()), ("a", pa.int64()), ("b", pa.int64()), ("ends_sha256", pa.string())])
    now, sha, out = None, None, []
    for batch in batches:
        for *node, conv in zip(*(c.to_pylist() for c in batch.columns)):
            if node != now:
                if now is not None:
                    out.append((*now, sha.hexdigest()))
                now, sha = node, hashlib.sha256(str(conv).encode())
            else:
                sha.update(b",%d" % conv)
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*out), schema)], schema=schema)
            out = []
    if now is not None:
        yield pa.RecordBatch.from_arrays([pa.array([v], t.type) for v, t in zip((*now, sha.hexdigest()), schema)],
                                         schema=schema)


def trie(convs: DataFrame, turns: DataFrame, scratch: Scratch) -> DataFrame:
    """``id, parent, depth, conv, parent_conv, n_convs, words, ends_sha256`` of every node.

    ``conv`` is the node's smallest conversation, ``words`` the words of its last turn. The ids of
    a node's ending conversations go through one task in order, as a hash of one text needs,
    but are never held.
    """
    steps = paths(turns, scratch)
    ends = convs.join(steps.groupBy("conv").agg(F.max(F.struct("depth", "a", "b")).alias("e")), "conv", "left") \
        .select(*[F.coalesce(f"e.{c}", F.lit(0)).cast("long").alias(c) for c in ("depth", "a", "b")], "conv")
    shas = ends.repartition("depth", "a", "b").sortWithinPartitions("depth", "a", "b", "conv") \
        .mapInArrow(_joined_sha, "depth long, a long, b long, ends_sha256 string")
    nodes = steps.groupBy("depth", "a", "b").agg(F.min("conv").alias("conv"), F.count("*").alias("n_convs"),
                                                 F.min("words").alias("words"), F.min("pa").alias("pa"), F.min("pb").alias("pb"))
    root = convs.agg(F.lit(0).cast("long").alias("depth"), F.lit(0).cast("long").alias("a"), F.lit(0).cast("long").alias("b"),
                     F.min("conv").alias("conv"), F.count("*").alias("n_convs"), F.lit(0).cast("long").alias("words"),
                     F.lit(0).cast("long").alias("pa"), F.lit(0).cast("long").alias("pb")).filter("n_convs > 0")
    nodes = scratch.write(nodes.unionByName(root).join(shas, ["depth", "a", "b"], "left")
                          .withColumn("ends_sha256", F.coalesce("ends_sha256", F.lit(EMPTY_SHA)))
                          .withColumn("id", F.monotonically_increasing_id()))
    # a null key for the root, which has no parent
    up = F.when(F.col("depth") > 0, F.struct((F.col("depth") - 1).alias("depth"), F.col("pa").alias("a"), F.col("pb").alias("b")))
    parents = nodes.select(F.struct("depth", "a", "b").alias("up"), F.col("id").alias("parent"),
                           F.col("conv").alias("parent_conv"))
    found = split_join(nodes.withColumn("up", up), parents, "up", scratch)
    return scratch.write(found.select("id", "parent", "depth", "conv", "parent_conv", "n_convs", "words", "ends_sha256"))


# ---------------------------------------------------------------- tree contraction

def _compressed(unary: DataFrame, weights: list[str], scratch: Scratch) -> DataFrame:
    """``unary`` with ``below``, the node below each node's chain, and ``steps`` to it, by doubling.

    ``unary``: id, child, weights and other columns. A node's weights become the sum from
    itself to the end of its chain. Nodes that still jump have all jumped equally far, so no
    two of them look up one node.
    """
    kept = [c for c in unary.columns if c not in (*weights, "child")]
    jumps = scratch.write(unary.withColumnRenamed("child", "below").withColumn("steps", F.lit(1).cast("long"))
                          .withColumn("open", F.lit(True)))
    while True:
        target = jumps.select(F.col("id").alias("below"), F.col("below").alias("next"), F.col("steps").alias("more"),
                              F.col("open").alias("goes_on"), *[F.col(w).alias(f"{w}_more") for w in weights])
        step = jumps.filter("open").join(target, "below", "left").select(
            *kept, F.coalesce("next", "below").alias("below"),
            (F.col("steps") + F.coalesce("more", F.lit(0))).alias("steps"),
            F.coalesce("goes_on", F.lit(False)).alias("open"),
            *[(F.col(w) + F.coalesce(f"{w}_more", F.lit(0))).alias(w) for w in weights])
        new = scratch.write(step.unionByName(jumps.filter("not open").select(step.columns)))
        scratch.drop(jumps)
        jumps = new
        if not jumps.filter("open").limit(1).count():
            return jumps.drop("open")


def subtree_totals(tree: DataFrame, weights: list[str], scratch: Scratch | None = None) -> DataFrame:
    """``id`` and, for each of ``weights``, its sum over the node's subtree, the node included.

    ``tree``: id, parent (null for roots, of which there may be several) and long weights. Every
    parent must be a node, and there must be no cycles. An empty tree gives an empty result.
    """
    scratch = scratch or Scratch(tree.sparkSession, "subtree-totals")
    over = [f"{w}_over" for w in weights]  # what compressed nodes between a node and its parent weigh
    zero = F.lit(0).cast("long")
    alive = scratch.write(tree.select("id", "parent", *weights, *[zero.alias(o) for o in over]))
    raked, compressed = [], []
    while True:
        kids = alive.filter("parent is not null").groupBy(F.col("parent").alias("id")).agg(
            F.count("*").alias("kids"), F.min("id").alias("child"), *[F.min(o).alias(f"{o}_child") for o in over])
        state = scratch.write(alive.join(kids, "id", "left").withColumn("kids", F.coalesce("kids", zero)))
        scratch.drop(alive)
        chain = (F.col("kids") == 1) & F.col("parent").isNotNull()
        rest = state.filter(~chain).select("id", "parent", "kids", *weights, *over)
        if state.filter(chain).limit(1).count():
            # a chain node answers for itself and what is compressed between it and its child
            jumps = _compressed(state.filter(chain).select(
                "id", "parent", "child", *over, *[(F.col(w) + F.col(f"{o}_child")).alias(w) for w, o in zip(weights, over)]),
                weights, scratch)
            compressed.append(jumps)
            top = jumps.groupBy(F.col("below").alias("id")).agg(F.max(F.struct(
                "steps", F.col("parent").alias("up"), *[(F.col(w) + F.col(o)).alias(o) for w, o in zip(weights, over)])).alias("top"))
            rest = scratch.write(rest.join(top, "id", "left").select(
                "id", F.coalesce("top.up", "parent").alias("parent"), "kids", *weights,
                *[F.coalesce(f"top.{o}", o).alias(o) for o in over]))
        raked.append(scratch.write(rest.filter("kids = 0").select("id", *weights)))
        handed = rest.filter("kids = 0 and parent is not null").groupBy(F.col("parent").alias("id")).agg(
            *[F.sum(F.col(w) + F.col(o)).alias(f"{w}_in") for w, o in zip(weights, over)])
        alive = scratch.write(rest.filter("kids > 0").join(handed, "id", "left").select(
            "id", "parent", *[(F.col(w) + F.coalesce(f"{w}_in", zero)).alias(w) for w in weights], *over))
        if not alive.limit(1).count():
            break
    known = raked[0]
    for table in raked[1:]:
        known = known.unionByName(table)
    for jumps in reversed(compressed):
        total = known.select(F.col("id").alias("below"), *[F.col(w).alias(f"{w}_below") for w in weights])
        known = known.unionByName(scratch.write(split_join(jumps, total, "below", scratch).select(
            "id", *[(F.col(w) + F.col(f"{w}_below")).alias(w) for w in weights])))
    return known


# ---------------------------------------------------------------- the operator

def conversation_trie(df: DataFrame, base_of: Column | None = None, taken: Column | None = None, most: int = 0,
                      conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                      text_col: str = "text") -> DataFrame:
    """One row per node of the trie of all conversations' turns (role and text).

    ``conv_id`` (smallest member), ``depth, parent_conv_id, n_convs`` (members: conversations that
    start with the node), ``n_children, n_leaves`` and ``saved_tokens`` (over the subtree: members
    but one, times the words of the node's last text), ``ends_sha256`` (of the ids of the conversations
    that end here, ascending, comma-joined). With ``base_of`` and ``taken``, columns of ``conv``,
    each conversation is rebuilt first, see :func:`rebuilt`.

    A null role or text is empty; rows with a null conversation belong to none. Turns are
    ordered with null first; equal turn numbers by a hash of role and text, and repeated rows
    are turns of their own. Texts of any length are hashed whole. Other columns are not read;
    an empty table gives an empty result, not a root.
    """
    scratch = Scratch(df.sparkSession, "trie")
    turns = numbered_turns(df, scratch, conv_col, turn_col, role_col, text_col)
    convs = turns.filter("pos = 1").select("conv")
    if base_of is not None:
        convs, turns = rebuilt(turns, scratch, base_of, taken, most)
    tree = trie(convs, turns, scratch)
    kids = tree.filter("parent is not null").groupBy(F.col("parent").alias("id")).agg(F.count("*").alias("n_children"))
    tree = scratch.write(tree.join(kids, "id", "left").withColumn("n_children", F.coalesce("n_children", F.lit(0).cast("long"))))
    totals = subtree_totals(tree.select(
        "id", "parent", (F.col("n_children") == 0).cast("long").alias("n_leaves"),
        ((F.col("n_convs") - 1) * F.col("words")).alias("saved_tokens")), ["n_leaves", "saved_tokens"], scratch)
    return tree.join(totals, "id").select(
        F.col("conv").alias("conv_id"), "depth", F.col("parent_conv").alias("parent_conv_id"), "n_convs", "n_children",
        "n_leaves", "saved_tokens", "ends_sha256")
