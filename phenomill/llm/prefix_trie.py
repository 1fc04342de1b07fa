"""The prefix trie of conversations, built by halving depths (the recursion of van Emde Boas).

A subproblem is a forest name and the sequences that go on from there, of at most h turns. It is cut at s = h / 2: the
first s turns of the sequences that have so many are named; of the sequences with one name a single one, with their
summed weight, stays in the upper trie, and what follows goes to the lower forest of that name. All subproblems of a
height are rows of one table, so a round handles them together, and after log2(height) rounds each is one turn
high: its nodes are the distinct turns. Then totals are grafted upward in as many rounds: the sum of a lower forest is
hung on the end of its cut prefix, and what hangs on the end of a piece is handed on to the end of its upper half.

Turns travel as digests of 16 bytes with their length in code points. A name is 128 bits wide: exclusive ors of hashed
(position, turn) pairs, which add up map-side, so a sequence of any length is never collected. Only one thing is
serial, because SHA-256 is: the ids of equal conversations are hashed in one task, from pieces of at most 4,096 ids.

Null roles and texts count as empty; rows without a conversation id belong to none and are left out; turns with the
same number come in the order of their digests, and repeated rows are turns of their own. An empty table gives no
nodes. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from phenomill.functions.ranks import expand_counts, ordered_prefix
from phenomill.llm.common import discard, written

ID_BLOCK_BITS = 12
ENDS = "w long, members long, length long, ends string"
NOTHING = hashlib.sha256(b"").hexdigest()
FOREST = ["fa", "fb"]


def ordered_turns(
    turns: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """(conv, pos, t, size): turns as digests, counted from 0 in the order of ``turn``, nulls first."""
    who, said = F.coalesce(F.col(role), F.lit("")), F.coalesce(F.col(text), F.lit(""))
    digest = F.sha2(F.concat(F.length(who).cast("string"), F.lit(":"), who, said), 256)
    rows = turns.where(F.col(conv_id).isNotNull()).select(
        F.col(conv_id).cast("long").alias("conv"),
        F.col(turn).alias("turn"),
        F.unhex(F.substring(digest, 1, 32)).alias("t"),
        F.length(said).cast("long").alias("size"),
    )
    distinct = rows.groupBy("conv", "turn", "t").agg(F.first("size").alias("size"), F.count("*").alias("copies"))
    placed = ordered_prefix(distinct, ["conv"], ["turn", "t"], "copies")
    return expand_counts(placed, "copies", "copy").select("conv", (F.col("__before") + F.col("copy")).alias("pos"), "t", "size")


def with_borrowed_heads(turns: DataFrame, every: int = 100, most: int = 6) -> DataFrame:
    """Sequences (conv, depth, t, size) in which h = crc32(conv) % ``most`` turns are those of conversation
    conv - conv % ``every``, as far as it has them, followed by the own turns after the first h.

    Each begins with the same textless row of depth 0, so a conversation without turns has a sequence, too.
    """
    heads = (
        turns.where((F.col("conv") % every == 0) & (F.col("pos") < most - 1))
        .groupBy(F.col("conv").alias("donor"))
        .agg(F.sort_array(F.collect_list(F.struct("pos", "t", "size"))).alias("head"))
    )
    shape = "array<struct<depth:bigint,t:binary,size:bigint>>"
    none = F.array().cast(shape)
    h = (F.crc32(F.col("conv").cast("string").cast("binary")) % most).cast("int")
    rows = turns.withColumns({"donor": F.col("conv") - F.col("conv") % every, "h": h}).join(heads, "donor", "left")
    lent = F.slice(F.coalesce("head", F.array().cast("array<struct<pos:bigint,t:binary,size:bigint>>")), F.lit(1), F.col("h"))
    start = F.array(F.struct(F.lit(0).alias("depth"), F.lit(b"").alias("t"), F.lit(0).alias("size"))).cast(shape)
    borrowed = F.transform(lent, lambda x: F.struct((x["pos"] + 1).alias("depth"), x["t"].alias("t"), x["size"].alias("size"))).cast(shape)
    own = F.array(F.struct((F.col("pos") - F.col("h") + F.size(lent) + 1).alias("depth"), "t", "size")).cast(shape)
    pieces = F.concat(
        F.when(F.col("pos") == 0, F.concat(start, borrowed)).otherwise(none), F.when(F.col("pos") >= F.col("h"), own).otherwise(none)
    )
    return rows.select("conv", F.inline(pieces))


def _names(position: Column, of: Column | bool = True) -> list[Column]:
    """The two lanes of the name of the rows for which ``of`` holds."""
    hashed = lambda lane: F.xxhash64(F.lit(lane), position, F.col("t"))
    return [F.bit_xor(F.when(F.lit(of) if of is True else of, hashed(lane))).alias(f"x{lane}") for lane in (1, 2)]


def _hash_ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per group of equal sequences; rows come sorted by (x1, x2, length, block)."""
    state, rows = None, []

    def done() -> tuple:
        return (state["w"], state["members"], state["key"][2], state["sha"].hexdigest())

    for batch in batches:
        for x1, x2, length, _, low, k, ids in zip(*(c.to_pylist() for c in batch.columns)):
            if state is None or state["key"] != (x1, x2, length):
                if state:
                    rows.append(done())
                state = {"key": (x1, x2, length), "w": low, "members": 0, "sha": hashlib.sha256()}
            else:
                state["sha"].update(b",")
            state["sha"].update(ids.encode())
            state["members"] += k
    if state:
        rows.append(done())
    columns = list(zip(*rows)) or [()] * 4
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string()]
    yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds)], ["w", "members", "length", "ends"])


def _distinct(rows: DataFrame) -> DataFrame:
    """(w, members, length, ends): of equal sequences the smallest conversation, their number, and the hash of their ids."""
    whole = rows.groupBy("conv").agg(*_names(F.col("depth")), F.count("*").alias("length"))
    key = ["x1", "x2", "length"]
    blocks = whole.groupBy(*key, F.shiftright("conv", ID_BLOCK_BITS).alias("block")).agg(
        F.min("conv").alias("low"),
        F.count("*").alias("k"),
        F.array_join(F.transform(F.sort_array(F.collect_list("conv")), lambda c: c.cast("string")), ",").alias("ids"),
    )
    return blocks.repartition(*key).sortWithinPartitions(*key, "block").mapInArrow(_hash_ends, ENDS)


def _cut(table: DataFrame, s: int) -> DataFrame:
    """One round over the sequences of at least ``s`` turns: their upper tries and lower forests."""
    head = F.col("pos") < s
    groups = table.groupBy(*FOREST, "w").agg(
        *_names(F.col("pos"), head), F.first("n").alias("weight"), F.max(F.when(F.col("pos") == s - 1, F.col("ends"))).alias("end")
    )
    prefix = groups.select(
        *FOREST,
        "w",
        "weight",
        "end",
        F.xxhash64(F.lit(3), "fa", "fb", "x1").alias("na"),
        F.xxhash64(F.lit(4), "fa", "fb", "x2").alias("nb"),
    )
    # Both are written, so that the join may split a prefix that very many sequences share.
    prefix = written(prefix, "trie-prefix")
    named = written(prefix.groupBy("na", "nb").agg(F.min("w").alias("rep"), F.sum("weight").alias("total"), F.max("end").alias("end")), "trie-named")
    rows = table.join(prefix.drop("weight", "end").join(named, ["na", "nb"]), [*FOREST, "w"])
    last, below = F.col("pos") == s - 1, ~head
    fa, fb = F.when(below, F.col("na")).otherwise(F.col("fa")), F.when(below, F.col("nb")).otherwise(F.col("fb"))
    return rows.where(below | (F.col("rep") == F.col("w"))).select(
        fa.alias("fa"),
        fb.alias("fb"),
        "w",
        F.when(head, F.col("total")).otherwise(F.col("n")).alias("n"),
        "depth",
        F.when(below, F.col("pos") - s).otherwise(F.col("pos")).alias("pos"),
        F.when(below, F.col("span") - s).otherwise(F.lit(s)).alias("span"),
        "t",
        "size",
        F.when(last, F.col("end")).otherwise(F.col("ends")).alias("ends"),
        F.when(below, F.col("rep")).otherwise(F.col("top")).alias("top"),
        F.when(last, F.struct(F.col("na").alias("a"), F.col("nb").alias("b"))).otherwise(F.col("id")).alias("id"),
        F.when(below, F.map_concat("roots", F.create_map(F.lit(s), F.struct(fa.alias("a"), fb.alias("b"))))).otherwise(F.col("roots")).alias("roots"),
    )


def _grafted(nodes: DataFrame, steps: list[int]) -> DataFrame:
    """(id, leaves, saved): what lies below each node that has children."""
    totals = ["leaves", "saved"]
    hung: DataFrame | None = None
    for s in steps:
        root = F.col("roots")[s]
        lower = nodes.where(F.col("depth").bitwiseAND(F.lit(s)) != 0)
        parts = lower.select(root.alias("id"), *totals)
        if hung is not None:
            ends = lower.where((F.col("depth") + 1) % (2 * s) == 0).select("id", root.alias("root"))
            parts = parts.unionByName(ends.join(hung, "id").select(F.col("root").alias("id"), *totals))
        sums = written(parts.groupBy("id").agg(*[F.sum(c).alias(c) for c in totals]), "trie-hung")
        hung = sums if hung is None else hung.unionByName(sums)
    return hung


def prefix_trie(sequences: DataFrame) -> DataFrame:
    """Nodes of the trie of ``sequences`` (conv, depth, t, size), whose rows of depth 0 are all alike.

    conv_id (smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256; the last
    turn of a node's sequence is turn ``depth`` of conversation ``conv_id``.
    """
    rows = written(sequences.select("conv", "depth", "t", "size"), "trie-rows")
    deepest = rows.agg(F.max("depth")).first()[0] or 0
    steps = [1 << k for k in reversed(range(max(1, deepest.bit_length())))]
    firsts = _distinct(rows)
    pair = "struct<a:bigint,b:bigint>"
    table = written(
        rows.join(firsts, rows["conv"] == firsts["w"]).select(
            F.lit(0).cast("long").alias("fa"),
            F.lit(0).cast("long").alias("fb"),
            "w",
            F.col("members").alias("n"),
            "depth",
            F.col("depth").alias("pos"),
            F.col("length").alias("span"),
            "t",
            "size",
            F.when(F.col("depth") == F.col("length") - 1, F.col("ends")).alias("ends"),
            F.lit(None).cast("long").alias("top"),
            F.lit(None).cast(pair).alias("id"),
            F.create_map().cast(f"map<int,{pair}>").alias("roots"),
        ),
        "trie-distinct",
    )
    discard(rows)
    # A sequence waits for the first round that cuts it; the first rounds only move the longest ones.
    made = [table]
    for s in steps:
        ready = reduce(DataFrame.unionByName, [t.where((F.col("span") >= s) & (F.col("span") <= (2 * s if t is made[-1] else 2 * s - 1))) for t in made])
        made.append(written(_cut(ready, s), "trie-cut"))
    found = made[-1].groupBy(*FOREST, "t").agg(
        F.min("w").alias("conv_id"),
        F.first("depth").alias("depth"),
        F.first("top").alias("parent_conv_id"),
        F.sum("n").alias("n_convs"),
        F.max("size").alias("size"),
        F.max("id").alias("id"),
        F.max("ends").alias("ends"),
        F.first("roots").alias("roots"),
    )
    found = written(found, "trie-found")
    for used in made:
        discard(used)
    children = found.groupBy(F.struct(F.col("fa").alias("a"), F.col("fb").alias("b")).alias("id")).agg(F.count("*").alias("n_children"))
    own = found.join(children, "id", "left").select(
        "id",
        "conv_id",
        "depth",
        "parent_conv_id",
        "n_convs",
        F.coalesce("n_children", F.lit(0)).alias("n_children"),
        F.when(F.col("n_children").isNull(), F.lit(1)).otherwise(F.lit(0)).cast("long").alias("leaves"),
        ((F.col("n_convs") - 1) * F.col("size")).alias("saved"),
        "ends",
        "roots",
    )
    nodes = written(own, "trie-nodes")
    discard(found)
    hung = _grafted(nodes, steps).select("id", F.col("leaves").alias("more_leaves"), F.col("saved").alias("more_saved"))
    return nodes.join(hung, "id", "left").select(
        "conv_id",
        "depth",
        "parent_conv_id",
        "n_convs",
        "n_children",
        (F.col("leaves") + F.coalesce("more_leaves", F.lit(0))).alias("n_leaves"),
        (F.col("saved") + F.coalesce("more_saved", F.lit(0))).alias("saved_tokens"),
        F.coalesce("ends", F.lit(NOTHING)).alias("ends_sha256"),
    )


def conversation_trie(turns: DataFrame, every: int = 100, most: int = 6) -> DataFrame:
    """The trie of all conversations with borrowed heads."""
    placed = written(ordered_turns(turns), "trie-turns")
    return prefix_trie(with_borrowed_heads(placed, every, most))
