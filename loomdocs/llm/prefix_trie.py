"""Trie of conversation prefixes with totals by depth bands (operator 12)."""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ._spark import discard, materialize, tasks_for

#: Levels of nodes in a band: a node gives its numbers to so many ancestors at most.
BAND = 8
#: A conversation takes over 0 to HEADS - 1 turns of the first of its FAMILY conversations.
HEADS, FAMILY = 4, 20
#: Parts of a prefix's digest: sums of 32-bit numbers, which 2^31 turns can't carry past a long.
_SUMS = ["s0", "s1", "s2", "s3"]
#: The same of a prefix's parent.
_PARENT = ["p0", "p1", "p2", "p3"]
_WORD = r"[^\x20\x09-\x0D]"


def _turn_sums(index: Column, key: Column) -> list[Column]:
    """A turn's part of the digest of every prefix it is in: 128 bits of a SHA-256 of its place and content."""
    digest = F.sha2(F.concat(F.encode(F.concat(index.cast("string"), F.lit(":")), "UTF-8"), key), 256)
    return [F.conv(F.substring(digest, 1 + 8 * i, 8), 16, 10).cast("long").alias(s) for i, s in enumerate(_SUMS)]


def _node(depth: Column, sums: list) -> Column:
    """Key of a prefix: its depth and digest."""
    return F.unhex(F.sha2(F.encode(F.concat_ws(",", depth, *sums), "UTF-8"), 256))


def placed_turns(conversations: DataFrame) -> DataFrame:
    """conv_id, part, at (place within the part), pos (place in the conversation), turn_key and n_words, as a written table.

    Rows are dealt out by range of (conv_id, turn, role, text) and sorted once;
    texts go no further. A long conversation spans several parts; its places
    count on from part to part by its rows in the parts ahead.
    """
    spark = conversations.sparkSession
    text, role = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("text", "role"))
    rows = conversations.where("conv_id IS NOT NULL").select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), role.alias("role"), text.alias("text"), F.monotonically_increasing_id().alias("spread"))
    order = ["conv_id", "turn", "role", "text", "spread"]  # spread: rows that are all the same needn't share a task
    rows = rows.repartitionByRange(tasks_for(spark), *order).sortWithinPartitions(*order)
    key = F.unhex(F.sha2(F.encode(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"), "UTF-8"), 256))
    words = F.regexp_count("text", F.lit(_WORD + "+")).cast("long")
    turns = materialize(rows.select("conv_id", F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("at"), key.alias("turn_key"), words.alias("n_words")), "turns")
    own = F.row_number().over(Window.partitionBy("part", "conv_id").orderBy("at")).cast("long") - 1
    ahead = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    # a row per conversation and part
    carried = turns.groupBy("part", "conv_id").agg(F.count("*").alias("rows")).select("part", "conv_id", F.coalesce(F.sum("rows").over(ahead), F.lit(0)).alias("carried"))
    return materialize(turns.withColumn("own", own).join(carried, ["part", "conv_id"]).select("conv_id", "part", "at", (F.col("own") + F.col("carried")).alias("pos"), "turn_key", "n_words"), "turns")


def family_heads(conv_id: Column, heads: int = HEADS) -> Column:
    """Turns that a conversation takes over: crc32 of its decimal id, modulo `heads`."""
    return (F.crc32(F.encode(conv_id.cast("string"), "UTF-8")) % heads).cast("long")


def rebuilt_prefixes(turns: DataFrame, family: int = FAMILY, heads: int = HEADS) -> DataFrame:
    """A row for each rebuilt conversation and depth from 1: conv_id, depth, node, parent's sums, n_words, is_end; depth 0 for those without turns.

    A conversation's first h turns are those of the first conversation of its
    family (c - c % family), the others its own from place h on. A prefix is
    known by its depth and the sum of its turns' digests (place and content,
    128 bits, never cut down to fewer): sums run inside each part of a
    conversation, and the parts' totals give what stands ahead.
    """
    ids = turns.groupBy("conv_id").agg(F.count("*").alias("n_turns"))
    first = turns.where(F.col("pos") < heads - 1).select(F.col("conv_id").alias("base"), F.col("pos"), "turn_key", "n_words")
    base = F.col("conv_id") - F.col("conv_id") % family
    conversations = ids.select("conv_id", "n_turns", base.alias("base"), family_heads(F.col("conv_id"), heads).alias("h"))
    # at most heads - 1 rows for a base, and `family` conversations for a base
    taken = conversations.join(first, "base").where(F.col("pos") < F.col("h")).select("conv_id", "pos", "turn_key", "n_words")
    n_taken = taken.groupBy("conv_id").agg(F.count("*").alias("k"))
    known = materialize(conversations.join(n_taken, "conv_id", "left").select("conv_id", "h", F.coalesce("k", F.lit(0)).alias("k"), (F.coalesce("k", F.lit(0)) + F.greatest(F.col("n_turns") - F.col("h"), F.lit(0))).alias("length")), "lengths")

    heads_ = taken.select("conv_id", F.lit(-1).alias("part"), F.col("pos").alias("index"), "turn_key", "n_words")
    spans = turns.groupBy("part", "conv_id").agg(F.count("*").alias("rows")).drop("rows").join(known.select("conv_id", "h", "k"), "conv_id")
    own = turns.join(spans, ["part", "conv_id"]).where(F.col("pos") >= F.col("h")).select("conv_id", "part", (F.col("pos") - F.col("h") + F.col("k")).alias("index"), "turn_key", "n_words")
    both = heads_.unionByName(own)
    digested = both.select("conv_id", "part", (F.col("index") + 1).alias("depth"), "n_words", *_turn_sums(F.col("index"), F.col("turn_key")))
    inside = Window.partitionBy("part", "conv_id").orderBy("depth")
    summed = digested.select("conv_id", "part", "depth", "n_words", *_SUMS, *[F.sum(s).over(inside).alias(f"run_{s}") for s in _SUMS])
    summed = materialize(summed, "sums")
    # a row per conversation and part
    totals = summed.groupBy("conv_id", "part").agg(*[F.sum(s).alias(s) for s in _SUMS])
    ahead = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = totals.select("conv_id", "part", *[F.coalesce(F.sum(s).over(ahead), F.lit(0)).alias(f"base_{s}") for s in _SUMS])
    lengths = bases.join(known.select("conv_id", "length"), "conv_id")
    full = summed.join(lengths, ["conv_id", "part"])
    at = [F.col(f"base_{s}") + F.col(f"run_{s}") for s in _SUMS]
    before = [x - F.col(s) for x, s in zip(at, _SUMS, strict=True)]
    prefixes = full.select("conv_id", "depth", _node(F.col("depth"), at).alias("node"), *[x.alias(p) for x, p in zip(before, _PARENT, strict=True)], "n_words", (F.col("depth") == F.col("length")).alias("is_end"))
    empty = known.where("length = 0").select("conv_id", F.lit(0).cast("long").alias("depth"), _root().alias("node"), *[F.lit(None).cast("long").alias(p) for p in _PARENT], F.lit(0).cast("long").alias("n_words"), F.lit(True).alias("is_end"))
    prefixes = materialize(prefixes.unionByName(empty), "prefixes")
    discard(summed)
    discard(known)
    return prefixes


def _root() -> Column:
    return _node(F.lit(0).cast("long"), [F.lit(0).cast("long")] * len(_SUMS))


def subtree_sums(nodes: DataFrame, paths: DataFrame, sums: list[str], band: int = BAND) -> DataFrame:
    """node and each column of `sums` added up over the node's subtree, by depth bands.

    nodes: node, depth, rep (a conversation through the node) and the columns.
    paths: conv, depth, node for every node on the way of each rep, its own and
    the root included.

    A band has `band` levels; its first level are band roots. A node gives its
    numbers to its ancestors inside its band only, found on its rep's path
    (`band` rows at most). The totals of the band roots are then the numbers of
    a tree that is `band` times lower, which is summed in the same way; and each
    band root's complete total goes to the nodes on its way through the band
    above. So rounds grow with the logarithm of the depth, and no node makes
    more than 2 `band` rows a round. Every round is a written table.
    """
    band_of = F.floor(F.col("depth") / band)

    def given_up(givers: DataFrame, to_band: Column, own: bool) -> DataFrame:
        at = givers.select("rep", to_band.alias("band"), *([F.col("depth").alias("below")] if own else []), *sums)
        way = paths.select(F.col("conv").alias("rep"), band_of.alias("band"), "depth", "node")
        met = at.join(way, ["rep", "band"])
        return (met.where("depth <= below") if own else met).select("node", *sums)

    local = given_up(nodes, band_of, True).groupBy("node").agg(*[F.sum(s).alias(s) for s in sums])
    deepest = nodes.agg(F.max("depth")).first()[0] or 0
    if deepest < band:
        return materialize(local, "subtrees")
    local = materialize(local, "subtrees")
    roots = nodes.where(F.col("depth") % band == 0).select("node", "depth", "rep").join(local, "node")
    higher = materialize(roots.select("node", (F.col("depth") / band).cast("long").alias("depth"), "rep", *sums), "band_roots")
    above = paths.where(F.col("depth") % band == 0).select("conv", (F.col("depth") / band).cast("long").alias("depth"), "node")
    complete = subtree_sums(higher, above, sums, band)
    done = higher.select("node", F.col("depth").alias("level"), "rep").join(complete, "node")
    down = given_up(done.where("level > 0"), F.col("level") - 1, False)
    every = local.unionByName(down).groupBy("node").agg(*[F.sum(s).alias(s) for s in sums])
    every = materialize(every, "subtrees")
    discard(local)
    discard(higher)
    discard(complete)
    return every


def ends_digests(ends: DataFrame) -> DataFrame:
    """node and ends_sha256: SHA-256 of the decimal conv_ids of a node's rows in ascending order, comma-joined.

    Ids are dealt out by range, so one node's many ids are joined by several
    tasks; what meets for a node is one string per task, hashed as it streams by.
    """
    spark = ends.sparkSession
    tasks = tasks_for(spark)
    dealt = ends.select("node", "conv_id").repartitionByRange(tasks, "node", "conv_id").withColumn("part", F.spark_partition_id())
    dealt = materialize(dealt, "ends")
    ids = F.array_join(F.transform(F.sort_array(F.collect_list("conv_id")), lambda x: x.cast("string")), ",")
    joined = dealt.groupBy("part", "node").agg(ids.alias("ids")).repartition(tasks, "node").sortWithinPartitions("node", "part")

    def run(batches):
        node, digest, out = None, None, []

        def flush():
            batch = pa.RecordBatch.from_arrays([pa.array([x[0] for x in out], pa.binary()), pa.array([x[1] for x in out], pa.string())], ["node", "ends_sha256"])
            out.clear()
            return batch

        for batch in batches:
            for key, some in zip(batch.column("node"), batch.column("ids"), strict=True):
                key = key.as_py()
                if key == node:
                    digest.update(b",")
                else:
                    if node is not None:
                        out.append((node, digest.hexdigest()))
                    node, digest = key, hashlib.sha256()
                digest.update(some.as_buffer())
            if len(out) > 10_000:
                yield flush()
        if node is not None:
            out.append((node, digest.hexdigest()))
        yield flush()

    return joined.select("node", "ids").mapInArrow(run, "node binary, ends_sha256 string")


def conversation_trie(conversations: DataFrame, band: int = BAND) -> DataFrame:
    """Nodes of the trie of rebuilt conversations, each known by its smallest member and depth.

    Returns conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens and ends_sha256 (see the module's functions). The root has depth
    0, no text and all conversations as members.

    Turns are ordered by (turn, role, text), null turns first; null roles and
    texts are empty. Repeated rows are turns of their own. Rows without a conv_id
    belong to no conversation and are left out. An empty table has no members
    and gives no rows. A very long text is hashed where it is sorted and moves
    once; other columns are ignored.

    A long conversation and a frequent prefix are split: the one by parts of its
    turns, the other by sums in each task before rows meet.
    """
    turns = placed_turns(conversations)
    prefixes = rebuilt_prefixes(turns)
    discard(turns)
    zero = F.lit(0).cast("long")
    roots = prefixes.where("depth <= 1").select("conv_id", zero.alias("depth"), _root().alias("node"))  # one row of each conversation
    deeper = prefixes.where("depth > 0")
    grouped = deeper.groupBy("node").agg(F.min("conv_id").alias("rep"), F.count("*").alias("n_convs"), *[F.first(c).alias(c) for c in ("depth", "n_words", *_PARENT)])
    grouped = grouped.select("node", "rep", "n_convs", "depth", _node(F.col("depth") - 1, _PARENT).alias("parent"), "n_words")
    root = roots.groupBy("node").agg(F.min("conv_id").alias("rep"), F.count("*").alias("n_convs"), F.first("depth").alias("depth")).withColumns({"parent": F.lit(None).cast("binary"), "n_words": zero})
    nodes = materialize(grouped.unionByName(root), "nodes")
    children = nodes.where("parent IS NOT NULL").groupBy(F.col("parent").alias("node")).agg(F.count("*").alias("n_children"))
    counted = nodes.join(children, "node", "left").fillna(0, ["n_children"])
    counted = materialize(counted.withColumns({"leaves": F.when(F.col("n_children") == 0, 1).otherwise(0).cast("long"), "saved": (F.col("n_convs") - 1) * F.col("n_words")}), "nodes")
    paths = deeper.select(F.col("conv_id").alias("conv"), "depth", "node").unionByName(roots.select(F.col("conv_id").alias("conv"), "depth", "node"))
    totals = subtree_sums(counted.select("node", "depth", "rep", F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens")), paths, ["n_leaves", "saved_tokens"], band)
    ended = ends_digests(prefixes.where("is_end").select("node", "conv_id"))
    # the many children of one parent: the join's side of children can be split
    parents = counted.select(F.col("node").alias("parent"), F.col("rep").alias("parent_conv_id"))
    whole = counted.join(totals, "node").join(ended, "node", "left").join(parents, "parent", "left")
    return whole.select(F.col("rep").alias("conv_id"), "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", F.coalesce("ends_sha256", F.lit(hashlib.sha256().hexdigest())).alias("ends_sha256"))
