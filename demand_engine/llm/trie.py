"""The prefix trie of conversations by Spark SQL's ROLLUP over positional columns of turn ids.

A conversation is cut into blocks of `BLOCK` turns, one row per block with a column per position. One
GROUP BY block, prior, ROLLUP (position 1 ... position 8) counts the prefixes of all blocks together:
grouping_id tells how many positions are kept, which is the depth inside the block, and `prior` names
the node where the block before ended, so that a block's prefixes go on from there. Sums over subtrees
come from a second rollup of the same rows: what lies below a node is what its members' paths pass, and
each node is counted by the member with the least id alone.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from demand_engine.llm.mixing import n_words
from demand_engine.llm.ranges import running
from demand_engine.session import cut_lineage

#: Turns per block, i.e. columns of a rollup.
BLOCK = 8
#: Conversations share the opening of the first of each stretch, up to three turns of it.
STRETCH, OPENINGS = 20, 4
#: Conversation ids joined into one piece of text before a node's pieces are hashed in order.
PIECE_IDS = 4096

_POSITIONS = [f"t{i}" for i in range(BLOCK)]


def _hashed(*parts: Column) -> Column:
    return F.unhex(F.md5(F.concat(*parts)))


def _root() -> Column:
    return F.unhex(F.md5(F.lit("").cast("binary")))


def placed_turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, place, said) per row: the place from 0 by turn, null first, and (id, words) of what was said.

    A null role or text counts as empty. Rows of one turn go by the md5 of what they say; repeated rows
    are turns of their own. Rows without a conv_id belong to no conversation and are left out. The id
    is the md5 of the role's length, the role and the text, so texts are read once and never moved. A
    conversation of any length is placed by ranges, not in one task.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    told = F.concat(F.length(role).cast("string"), F.lit(":"), role, text).cast("binary")
    said = F.struct(F.unhex(F.md5(told)).alias("id"), n_words(text).alias("words"))
    turns = cut_lineage(
        conversations.where(F.col("conv_id").isNotNull()).select(
            F.col("conv_id").cast("bigint").alias("conv_id"), F.col("turn").alias("__turn"), said.alias("said")
        )
    )
    order = [F.col("__turn").asc_nulls_first(), F.col("said.id").asc()]
    return cut_lineage(running(turns, ["conv_id"], order, {"place": F.lit(1)}).select("conv_id", "place", "said"))


def shared_openings(placed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The turns and the lengths, (conv_id, place, said) and (conv_id, length), of rebuilt conversations.

    Conversation c starts with the first h turns of conversation c - c % 20 (all, if that has fewer;
    none, if it is absent), h being crc32 of c's digits modulo 4, and goes on with its own turns after
    its first h. It may end up without turns. The remainder of a negative c is negative.
    """
    crc = F.crc32(F.col("conv_id").cast("string").cast("binary"))
    lengths = placed.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n"))
    convs = lengths.select(
        "conv_id", "n", (crc % OPENINGS).alias("h"), (F.col("conv_id") - F.col("conv_id") % STRETCH).alias("first")
    )
    firsts = lengths.select(F.col("conv_id").alias("first"), F.col("n").alias("n_first"))
    opened = F.least("h", F.coalesce("n_first", F.lit(0)))
    convs = cut_lineage(convs.join(firsts, "first", "left").withColumn("opened", opened))
    heads = placed.where(F.col("place") < OPENINGS - 1).withColumnRenamed("conv_id", "first")
    opening = convs.join(heads, "first").where("place < h").select("conv_id", "place", "said")
    own = placed.join(convs, "conv_id").where("place >= h")
    rest = own.select("conv_id", (F.col("place") - F.col("h") + F.col("opened")).alias("place"), "said")
    length = F.col("opened") + F.greatest(F.col("n") - F.col("h"), F.lit(0))
    return opening.unionByName(rest), convs.select("conv_id", length.alias("length"))


def _block_ends(blocks: DataFrame) -> DataFrame:
    """(conv_id, block, key) per full block: a hash of all turns up to the block's end.

    A block's hash is combined with the one 1, 2, 4, ... blocks before it, so that the longest
    conversation takes as many joins as the logarithm of its blocks. How hashes are combined depends
    on the block's number alone: equal prefixes have equal keys.
    """
    full = blocks.where(F.size("said") == BLOCK)
    ends = cut_lineage(full.select("conv_id", "block", "length", _hashed(*(F.get("said.id", F.lit(i)) for i in range(BLOCK))).alias("key")))
    single, longer = ends.where(f"length <= {BLOCK}"), ends.where(f"length > {BLOCK}")
    last = ends.agg(F.max("block")).first()[0] or 0
    step = 1
    while step <= last:
        before = longer.select("conv_id", (F.col("block") + step).alias("block"), F.col("key").alias("front"))
        both = longer.join(before, ["conv_id", "block"], "left")
        key = F.when(F.col("front").isNull(), F.col("key")).otherwise(_hashed("front", "key"))
        longer = cut_lineage(both.select("conv_id", "block", "length", key.alias("key")))
        step *= 2
    return single.unionByName(longer).drop("length")


def _prefix_key(columns: list[Column]) -> Column:
    return _hashed(F.col("prior"), *(F.coalesce(c, F.lit(b"")) for c in columns))


def member_blocks(turns: DataFrame, lengths: DataFrame) -> DataFrame:
    """(conv_id, length, block, prior, end, t0 ... t7): a row per conversation and block of its turns.

    `prior` is the key of the node before the block, `end` the key of the node at its end. A conversation
    without turns has one row without turns.
    """
    cut = turns.withColumn("block", F.floor(F.col("place") / BLOCK)).groupBy("conv_id", "block")
    cut = cut.agg(F.array_sort(F.collect_list(F.struct("place", "said"))).alias("placed"))
    blocks = cut_lineage(
        lengths.join(cut, "conv_id", "left").select(
            "conv_id",
            "length",
            F.coalesce("block", F.lit(0)).alias("block"),
            F.col("placed.said").alias("said"),
        )
    )
    ends = cut_lineage(_block_ends(blocks))
    priors = ends.select("conv_id", (F.col("block") + 1).alias("block"), F.col("key").alias("prior"))
    whole = blocks.join(ends, ["conv_id", "block"], "left").join(priors, ["conv_id", "block"], "left")
    flat = whole.select(
        "conv_id", "length", "block", F.coalesce("prior", _root()).alias("prior"), "key",
        *(F.get("said", F.lit(i)).alias(c) for i, c in enumerate(_POSITIONS)),
    )
    end = F.when(F.col("t0").isNull(), F.col("prior")).otherwise(_prefix_key([F.col(f"{c}.id") for c in _POSITIONS]))
    return cut_lineage(flat.withColumn("end", F.coalesce("key", end)).drop("key"))


_ROLLUP = f"""
SELECT block, prior, {BLOCK} - bit_count(grouping_id()) AS depth_in, {', '.join(_POSITIONS)}, max(end) AS end, {{sums}}
FROM {{members}} GROUP BY block, prior, ROLLUP ({', '.join(_POSITIONS)})
"""


def _rolled(members: DataFrame, sums: str) -> DataFrame:
    """The rollup, without groups that are no prefix: a level above a block's start, or beyond a member's end.

    Adds `key` (the prefix's node) and `last` (what its last turn said).
    """
    groups = members.sparkSession.sql(_ROLLUP.replace("{sums}", sums), members=members)
    turns = F.array(*_POSITIONS)
    groups = groups.withColumn("last", F.when(F.col("depth_in") > 0, F.get(turns, F.col("depth_in").cast("int") - 1)))
    groups = groups.where("CASE WHEN depth_in = 0 THEN block = 0 ELSE last IS NOT NULL END")
    inner = _prefix_key([F.col(f"{c}.id") for c in _POSITIONS])
    key = F.when(F.col("depth_in") == 0, F.col("prior")).when(F.col("depth_in") == BLOCK, F.col("end")).otherwise(inner)
    return groups.withColumn("key", key)


def trie_nodes(members: DataFrame) -> DataFrame:
    """(key, parent, depth, conv_id, n_convs, is_leaf, saved) per node; conv_id is the least member's, saved its own."""
    rolled = _rolled(members, "count(*) AS n_convs, min(conv_id) AS conv_id, max(length) AS longest")
    depth = F.col("block") * BLOCK + F.col("depth_in")
    above = [F.when(F.col("depth_in") - 1 > i, F.col(f"{c}.id")) for i, c in enumerate(_POSITIONS)]
    parent = F.when(F.col("depth_in") == 1, F.col("prior")).when(F.col("depth_in") > 1, _prefix_key(above))
    return cut_lineage(
        rolled.select(
            "key", parent.alias("parent"), depth.cast("bigint").alias("depth"), "conv_id", "n_convs",
            (F.col("longest") == depth).alias("is_leaf"),
            ((F.col("n_convs") - 1) * F.coalesce("last.words", F.lit(0))).alias("saved"),
        )
    )


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted (key, conv_id) to (key, first, ids): the ids of up to PIECE_IDS neighbours of one key."""
    key, ids = None, []

    def made(key: bytes, ids: list[int]) -> pa.RecordBatch:
        return pa.RecordBatch.from_pydict({"key": pa.array([key], pa.binary()), "first": pa.array([ids[0]], pa.int64()), "ids": [",".join(map(str, ids))]})

    for batch in batches:
        out = []
        for k, c in zip(batch.column("key").to_pylist(), batch.column("conv_id").to_pylist()):
            if ids and (k != key or len(ids) == PIECE_IDS):
                out.append(made(key, ids))
                ids = []
            key = k
            ids.append(c)
        if out:
            yield pa.Table.from_batches(out).combine_chunks().to_batches()[0]
    if ids:
        yield made(key, ids)


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted (key, first, ids) to (key, ends_sha256), hashing piece after piece."""
    key, state = None, None
    for batch in batches:
        keys, digests = [], []
        for k, ids in zip(batch.column("key").to_pylist(), batch.column("ids").to_pylist()):
            if state is not None and k == key:
                state.update(b",")
            else:
                if state is not None:
                    keys.append(key)
                    digests.append(state.hexdigest())
                key, state = k, hashlib.sha256()
            state.update(ids.encode())
        if keys:
            yield pa.RecordBatch.from_pydict({"key": pa.array(keys, pa.binary()), "ends_sha256": digests})
    if state is not None:
        yield pa.RecordBatch.from_pydict({"key": pa.array([key], pa.binary()), "ends_sha256": [state.hexdigest()]})


def end_digests(members: DataFrame) -> DataFrame:
    """(key, ends_sha256) per node where conversations end: SHA-256 of their ids, ascending, comma-joined.

    The ids are joined into pieces by ranges of (node, id); a node's pieces, a few thousandths of its
    ids, then pass one task in order, as a hash has to be taken in order. Nothing but the hash's state
    is held.
    """
    is_last = F.col("block") == F.floor(F.greatest(F.col("length") - 1, F.lit(0)) / BLOCK)
    ends = members.where(is_last).select(F.col("end").alias("key"), "conv_id")
    sorted_ends = ends.repartitionByRange("key", "conv_id").sortWithinPartitions("key", "conv_id")
    pieces = sorted_ends.mapInArrow(_pieces, "key binary, first bigint, ids string")
    return pieces.repartition("key").sortWithinPartitions("key", "first").mapInArrow(_digests, "key binary, ends_sha256 string")


def prefix_trie(turns: DataFrame, lengths: DataFrame) -> DataFrame:
    """One row per node of the trie over (conv_id, place, said) and (conv_id, length).

    conv_id (least member) and depth name a node; then parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens and ends_sha256. The root, at depth 0, has all conversations as members. Without
    conversations there is no node.
    """
    members = member_blocks(turns, lengths)
    nodes = trie_nodes(members)
    counted = running(nodes, ["conv_id"], [F.col("depth").asc()], {"above": F.col("saved")})
    own = nodes.groupBy("conv_id").agg(F.sum("saved").alias("own_saved"), F.max(F.col("is_leaf").cast("int")).alias("own_leaf"))
    own = own.where("own_saved > 0 OR own_leaf > 0")
    below = _rolled(members.join(own, "conv_id"), "sum(own_saved) AS all_saved, sum(own_leaf) AS n_leaves")
    children = nodes.where("parent IS NOT NULL").groupBy(F.col("parent").alias("key")).agg(F.count(F.lit(1)).alias("n_children"))
    parents = nodes.select(F.col("key").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    found = (
        counted.join(below.select("key", "all_saved", "n_leaves"), "key", "left")
        .join(children, "key", "left")
        .join(end_digests(members), "key", "left")
        .join(parents, "parent", "left")
    )
    zero = F.lit(0)
    return found.select(
        "conv_id", "depth", "parent_conv_id", "n_convs", F.coalesce("n_children", zero).alias("n_children"),
        F.coalesce("n_leaves", zero).alias("n_leaves"), (F.coalesce("all_saved", zero) - F.col("above")).alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"),
    )


def conversation_trie(conversations: DataFrame) -> DataFrame:
    """`prefix_trie` of the conversations as they are."""
    placed = placed_turns(conversations)
    return prefix_trie(placed, placed.groupBy("conv_id").agg(F.count(F.lit(1)).alias("length")))


def trie_report(conversations: DataFrame) -> DataFrame:
    """`prefix_trie` of the conversations after `shared_openings`. Other columns are ignored."""
    turns, lengths = shared_openings(placed_turns(conversations))
    return prefix_trie(cut_lineage(turns), cut_lineage(lengths))
