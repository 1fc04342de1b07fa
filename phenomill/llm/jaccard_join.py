"""Jaccard self-join of documents on word shingles, and its components.

A document's set are its distinct shingles of ``size`` words (A-Z in lower case); with fewer words the whole
sequence is the only one, without words the set is empty and links with nothing. Two documents link when
100 * intersection >= percent * union.

Equal sets form one class. A class indexes a prefix of its shingles, rarest first, long enough that two sets which
link share a prefix shingle. The order needs one fixed table of counts by hash bucket over all documents, whose
size doesn't depend on the data; any fixed order gives the same links.

Classes that share a prefix shingle meet in one sorted stream, smallest sets first. Pairs must pass the length filter
and the positional filter; then the suffix filter compares how many shingles two sets have in each part of
the hash space (about as many parts as shingles), and what is left is verified on the whole sets, once per pair.

Large groups don't list all their pairs, and in the later steps the suffix filter runs before a pair leaves its task. First each member meets the first few of its group (which settles small
groups); shingles that are frequent are salted in this step. Then one member of each component meets the others of
its group. Last, members of different components meet; a group that has become one component is left out by an
aggregate, without coming together. So every pair is either compared or already in one component.

Rows without an id link with nothing and have no component; repeated ids share their links; an empty table
gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from phenomill.llm.bounded import Counts, bucket, only_in, total_counts
from phenomill.llm.common import longs, regroup, shingle_hashes, slices, texts, unsigned, word_hashes, written
from phenomill.llm.components import connected_components

SIZE = 5
PERCENT = 75
BITS = 20
FILTER_BITS = 22
LEADERS = 4
SALTED_ROWS = 50_000

PROFILE = "doc_id long, n long, key long, piece int, data binary"
ENTRY = "h long, salt int, meta long, key long"
PAIR = "a long, b long, gid long, meta long"
SET = "key long, n long, parts binary, members array<long>"
MOST_PART_BITS = 12


def shingle_set(text: bytes, size: int = SIZE) -> np.ndarray:
    """Hashes of the distinct shingles, ascending."""
    return np.unique(shingle_hashes(word_hashes(text.lower()), size))


def set_key(members: np.ndarray) -> int:
    return xxhash.xxh3_64_intdigest(members.tobytes())


def prefix_length(n: int, percent: int) -> int:
    """A partner shares at least ceil(percent * n / 100) members, so one of the first n - that + 1."""
    return n - -(-percent * n // 100) + 1


def part_counts(members: np.ndarray) -> np.ndarray:
    """Members per part of the hash space, a byte each; as many parts as members, rounded up to a power of two, but no
    more than 2^MOST_PART_BITS unless a part would hold over 255."""
    bits = min(MOST_PART_BITS, max(0, len(members) - 1).bit_length())
    while True:
        counts = np.bincount(bucket(members, bits) if bits else np.zeros(len(members), dtype=np.int64), minlength=1 << bits)
        if not len(counts) or counts.max() < 256:
            return counts.astype(np.uint8)
        bits += 1


def _folded(counts: np.ndarray, parts: int) -> np.ndarray:
    """Counts (last axis) summed up to fewer parts; parts are nested."""
    if counts.shape[-1] == parts:
        return counts
    return counts.reshape(*counts.shape[:-1], parts, -1).sum(axis=-1, dtype=np.uint16)


def most_common(one: np.ndarray, others: np.ndarray) -> np.ndarray:
    """Upper bounds of the intersections of a set with others, from their part counts (rows of ``others``)."""
    parts = min(one.shape[-1], others.shape[-1])
    return np.minimum(_folded(one, parts), _folded(others, parts)).sum(axis=-1, dtype=np.int64)


def _narrow(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))


def _profile(size: int, bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = Counts(bits)
        names = ["doc_id", "n", "key", "piece", "data"]
        for batch in slices(batches):
            n, keys = [], []
            for text in texts(batch):
                members = shingle_set(text, size)
                counts.add(members)
                n.append(len(members))
                keys.append(set_key(members))
            none = pa.nulls(len(n))
            columns = [batch.column("doc_id"), pa.array(n, pa.int64()), longs(np.array(keys, dtype=np.uint64)), none.cast(pa.int32()), none.cast(pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names)
        for number, data in counts.pieces():
            none = pa.nulls(1, pa.int64())
            yield pa.RecordBatch.from_arrays([none, none, none, pa.array([number], pa.int32()), pa.array([data], pa.binary())], names)

    return run


def _entries(size: int, percent: int, bits: int, counts: np.ndarray, salted_rows: int):
    """Prefix rows of each set that the task hasn't seen yet. meta: set size and position; salt: 0, or 1 and more for a frequent shingle."""
    common = np.minimum(counts, (1 << 20) - 1).astype(np.uint32)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in slices(batches):
            columns: list[list[np.ndarray]] = [[], [], [], []]
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), texts(batch)):
                members = shingle_set(text, size)
                n = len(members)
                key = set_key(members)
                if not n or doc_id is None or key in seen:
                    continue
                seen.add(key)
                count = common[bucket(members, bits)].astype(np.uint64)
                rank = (count << np.uint64(44)) | (members >> np.uint64(20))
                length = prefix_length(n, percent)
                first = np.argsort(rank, kind="stable")[:length]
                salts = (count[first] // np.uint64(salted_rows)).astype(np.int64) + 1
                columns[0].append(members[first])
                columns[1].append(np.where(salts > 1, (key & 0x7FFFFFFF) % salts + 1, 0))
                columns[2].append((np.int64(n) << np.int64(32)) | np.arange(length, dtype=np.int64))
                columns[3].append(np.full(length, key, dtype=np.uint64))
            if columns[0]:
                h, salt, meta, key = (np.concatenate(c) for c in columns)
                yield pa.RecordBatch.from_arrays([longs(h), pa.array(salt.astype(np.int32)), pa.array(meta), longs(key)], ["h", "salt", "meta", "key"])

    return run


def _may_link(meta_a: np.ndarray, meta_b: np.ndarray, percent: int) -> np.ndarray:
    """Length and positional filter for sets that share the shingle at these positions."""
    n_a, n_b, low = meta_a >> 32, meta_b >> 32, np.int64(0xFFFFFFFF)
    most = np.minimum(n_a - (meta_a & low), n_b - (meta_b & low))
    fits = 100 * np.minimum(n_a, n_b) >= percent * np.maximum(n_a, n_b)
    return fits & ((100 + percent) * most >= percent * (n_a + n_b))


def _pair_batch(a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
    both = np.unique(np.stack([np.minimum(a, b), np.maximum(a, b)], axis=1), axis=0)
    none = pa.nulls(len(both), pa.int64())
    return pa.RecordBatch.from_arrays([pa.array(both[:, 0]), pa.array(both[:, 1]), none, none], ["a", "b", "gid", "meta"])


def _leader_pairs(percent: int, leaders: int):
    """Streams rows sorted by (h, salt, meta, key): pairs of each row with the first rows of its group.

    Rows beyond the leaders come out again with their shingle as group id, for the later steps; of a salted group all do.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tail = None  # rows of the last group, its first ``leaders`` at most, and how many it had
        before = 0
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = np.stack([batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("h", "salt", "meta", "key")])
            held = 0
            if tail is not None and (tail[:2, 0] == rows[:2, 0]).all():
                rows = np.concatenate([tail, rows], axis=1)
                held = tail.shape[1]
            else:
                before = 0
            h, salt, meta, key = rows
            new_group = np.append(True, (h[1:] != h[:-1]) | (salt[1:] != salt[:-1]))
            start = np.maximum.accumulate(np.where(new_group, np.arange(len(h)), 0))
            rank = np.arange(len(h)) - start
            fresh = np.arange(len(h)) >= held
            first = start == 0
            # A set that several tasks sent has equal rows next to each other.
            copy = np.append(False, ~new_group[1:] & (key[1:] == key[:-1]))
            a, b = [], []
            for j in range(leaders):
                at = np.flatnonzero(fresh & ~copy & (rank > j))
                lead = start[at] + j
                ok = (key[lead] != key[at]) & _may_link(meta[lead], meta[at], percent)
                a.append(key[lead[ok]])
                b.append(key[at[ok]])
            if sum(map(len, a)):
                yield _pair_batch(np.concatenate(a), np.concatenate(b))
            real_rank = rank + np.where(first, max(0, before - held), 0)
            rest = fresh & ~copy & ((real_rank >= leaders) | (salt > 0))
            if rest.any():
                none = pa.nulls(int(rest.sum()), pa.int64())
                yield pa.RecordBatch.from_arrays([none, pa.array(key[rest]), pa.array(h[rest]), pa.array(meta[rest])], ["a", "b", "gid", "meta"])
            last = int(start[-1])
            before = int(real_rank[-1]) + 1
            tail = rows[:, last : last + leaders]

    return run


def _cross_pairs(percent: int):
    """Pairs of a group whose labels differ and that pass all filters; rows sorted by (gid, meta, key).

    A pair comes from one group only, that of the first shingle its sets share in prefix order (``gids`` in that order).
    There the positional filter holds; pairs that met a leader at an earlier one are settled.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in regroup(batches, "gid"):
            gid, meta, key, label = (part.column(c).to_numpy() for c in ("gid", "meta", "key", "label"))
            n = meta >> 32
            parts = [np.frombuffer(v.as_buffer(), dtype=np.uint8) for v in part.column("parts")]
            gids = part.column("gids").to_pylist()
            members: dict[int, set[int]] = {}
            ends = np.append(np.flatnonzero(np.diff(gid)) + 1, len(gid))
            at, a, b, size = 0, [], [], 0
            for end in ends.tolist():
                # Sets of about one size have equally many parts: one matrix for each number.
                width = np.array([len(p) for p in parts[at:end]])
                row = np.empty(end - at, dtype=np.int64)
                stacked = {}
                for w in np.unique(width).tolist():
                    own = np.flatnonzero(width == w)
                    row[own] = np.arange(len(own))
                    stacked[w] = np.stack([parts[at + i] for i in own.tolist()])
                for i in range(at, end - 1):
                    # set sizes ascend: beyond ``to`` the length filter fails
                    to = int(np.searchsorted(n[i + 1 : end], 100 * n[i] // percent, side="right")) + i + 1
                    ok = (label[i + 1 : to] != label[i]) & _may_link(meta[i : i + 1], meta[i + 1 : to], percent)
                    near = np.flatnonzero(ok) + i + 1
                    for w in np.unique(width[near - at]).tolist():
                        own = near[width[near - at] == w]
                        most = most_common(parts[i], stacked[w][row[own - at]])
                        own = own[(100 + percent) * most >= percent * (n[i] + n[own])].tolist()
                        for j in own:
                            if j not in members:
                                members[j] = set(gids[j])
                        first = int(gid[i])
                        found = key[[j for j in own if next(g for g in gids[i] if g in members[j]) == first]]
                        a.append(np.full(len(found), key[i]))
                        b.append(found)
                        size += len(found)
                    if size > 200_000:
                        yield _pair_batch(np.concatenate(a), np.concatenate(b))
                        a, b, size = [], [], 0
                at = end
            if size:
                yield _pair_batch(np.concatenate(a), np.concatenate(b))

    return run


def _sets(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            rows = []
            for wanted, text in zip(unsigned(batch.column("key")).tolist(), texts(batch)):
                members = shingle_set(text, size)
                if set_key(members) == wanted:
                    rows.append((wanted, len(members), part_counts(members).tobytes(), members.view(np.int64)))
            for at in range(0, len(rows), 500):
                key, n, parts, members = zip(*rows[at : at + 500])
                columns = [longs(np.array(key, dtype=np.uint64)), pa.array(n, pa.int64()), pa.array(parts, pa.binary()), pa.array(members, pa.list_(pa.int64()))]
                yield pa.RecordBatch.from_arrays(columns, ["key", "n", "parts", "members"])

    return run


def _suffix_filter(percent: int):
    """Keeps pairs whose counts by part of the hash space leave room for enough common members."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("parts_a"), batch.column("parts_b")):
                x, y = (np.frombuffer(v.as_buffer(), dtype=np.uint8) for v in (x, y))
                most = most_common(x, y)
                keep.append(bool((100 + percent) * most >= percent * (int(x.sum()) + int(y.sum()))))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return run


def _with_sides(rows: DataFrame, sets: DataFrame, columns: list[str]) -> DataFrame:
    for side in "ab":
        rows = rows.join(sets.select(F.col("key").alias(side), *[F.col(c).alias(f"{c}_{side}") for c in columns]), side)
    return rows


def _links(likely: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) that do link, as a stored table. ``likely`` is one, too.

    The sets meet in a join and are compared row by row, so a task never holds many of them.
    """
    keys = likely.select(F.explode(F.array("a", "b")).alias("key"))
    sets = only_in(sets.select("key", "n", "members"), "key", keys, FILTER_BITS)
    common = F.size(F.array_intersect("members_a", "members_b"))
    linked = _with_sides(likely, sets, ["n", "members"]).where((100 + percent) * common >= percent * (F.col("n_a") + F.col("n_b")))
    return written(linked.select("a", "b"), "jaccard-links")


def _labelled(groups: DataFrame, links: DataFrame) -> DataFrame:
    """Members of groups that hold more than one component, with its label."""
    labels = connected_components(links).withColumnRenamed("node", "key")
    rows = written(groups.join(labels, "key", "left").select("gid", "meta", "key", F.coalesce("component", "key").alias("label")), "jaccard-groups")
    mixed = rows.groupBy("gid").agg(F.min("label").alias("low"), F.max("label").alias("high")).where("low <> high").select("gid")
    return rows.join(mixed, "gid", "left_semi")


def link_table(docs: DataFrame, size: int = SIZE, percent: int = PERCENT, doc_id: str = "doc_id", text: str = "text") -> tuple[DataFrame, DataFrame]:
    """(profile, links): per row doc_id, n, key of its set; and links between classes (a, b: keys).

    The links connect what the whole join connects; within a component some links may be missing.
    """
    docs = _narrow(docs, doc_id, text)
    rows = written(docs.mapInArrow(_profile(size, BITS), PROFILE), "jaccard-profile")
    profile = rows.where("piece IS NULL").select("doc_id", "n", "key")
    counts = total_counts(rows.where("piece IS NOT NULL").select("piece", "data"), BITS)

    entries = docs.mapInArrow(_entries(size, percent, BITS, counts, SALTED_ROWS), ENTRY)
    ordered = entries.repartition("h", "salt").sortWithinPartitions("h", "salt", "meta", "key")
    met = written(ordered.mapInArrow(_leader_pairs(percent, LEADERS), PAIR), "jaccard-met")
    pairs = written(met.where("gid IS NULL").select("a", "b").distinct(), "jaccard-pairs")
    groups = met.where("gid IS NOT NULL").select("gid", F.col("b").alias("key"), "meta")

    wanted = pairs.select(F.explode(F.array("a", "b")).alias("key")).unionByName(groups.select("key")).distinct()
    chosen = profile.where("doc_id IS NOT NULL").groupBy("key").agg(F.min("doc_id").alias("doc_id")).join(wanted, "key")
    chosen = written(chosen, "jaccard-chosen")
    wanted_docs = only_in(docs, "doc_id", chosen.select("doc_id"), FILTER_BITS)
    sets = written(chosen.join(wanted_docs, "doc_id").select("key", "text").mapInArrow(_sets(size), SET), "jaccard-sets")

    likely = _with_sides(pairs, sets, ["parts"]).mapInArrow(_suffix_filter(percent), "a long, b long")
    links = _links(written(likely, "jaccard-likely"), sets, percent)
    if groups.limit(1).count():
        order = F.struct(F.xxhash64("key").alias("order"), "meta", "key")
        leads = _labelled(groups, links).groupBy("gid", "label").agg(F.min(order).alias("lead")).select("gid", "label", "lead.meta", "lead.key")
        for narrowed in (lambda: leads, lambda: _labelled(groups, links)):
            rows = written(narrowed(), "jaccard-mixed")
            place = F.col("meta").bitwiseAND(F.lit(0xFFFFFFFF)).alias("place")
            own = rows.groupBy("key").agg(F.array_sort(F.collect_list(F.struct(place, "gid"))).alias("own")).select("key", F.col("own.gid").alias("gids"))
            parts = only_in(sets.select("key", "parts"), "key", rows.select("key"), FILTER_BITS)
            ordered = rows.join(own.join(parts, "key"), "key").repartition("gid").sortWithinPartitions("gid", "meta", "key")
            more = ordered.mapInArrow(_cross_pairs(percent), PAIR).select("a", "b").distinct().join(pairs, ["a", "b"], "left_anti")
            more = written(more, "jaccard-more")
            links = links.unionByName(_links(more, sets, percent))
            pairs = pairs.unionByName(more)
    return profile, links


def components(docs: DataFrame, size: int = SIZE, percent: int = PERCENT, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: doc_id, n_shingles, component_id (the smallest id reachable by links)."""
    profile, links = link_table(docs, size, percent, doc_id, text)
    classes = written(profile.where("doc_id IS NOT NULL AND n > 0").groupBy("key").agg(F.min("doc_id").alias("least")), "jaccard-classes")
    for side in "ab":
        links = links.join(classes.select(F.col("key").alias(side), F.col("least").alias(f"doc_{side}")), side)
    joined = connected_components(links.select("doc_a", "doc_b"))
    of_class = written(
        classes.join(joined.withColumnRenamed("node", "least"), "least", "left").select("key", F.coalesce("component", "least").alias("component_id")),
        "jaccard-of-class",
    )
    rows = profile.join(of_class, "key", "left")
    own = F.when(F.col("doc_id").isNotNull() & (F.col("n") > 0), F.col("component_id")).otherwise(F.col("doc_id"))
    return rows.select("doc_id", F.col("n").alias("n_shingles"), own.alias("component_id"))


def _keys(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            sets = [shingle_set(text, size) for text in texts(batch, "__text")]
            columns = [longs(np.array([set_key(m) for m in sets], dtype=np.uint64)), pa.array([len(m) for m in sets], pa.int64())]
            yield pa.RecordBatch.from_arrays([*batch.columns, *columns], [*batch.schema.names, "__key", "__n"])

    return run


def drop_near_copies(docs: DataFrame, size: int = SIZE, percent: int = PERCENT, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of each component, one with the smallest id; rows without an id or without words stay, equal ones of these with
    an id once.

    Rows are told apart by id and set, so an id may belong to several texts: each is judged by itself. Only rows of ids that occur
    more than once have their sets computed again.
    """
    profile, links = link_table(docs, size, percent, doc_id, text)
    return keep_first(docs, profile, links, size, doc_id, text)


def keep_first(docs: DataFrame, profile: DataFrame, links: DataFrame, size: int, doc_id: str, text: str) -> DataFrame:
    """The rows that ``drop_near_copies`` keeps, given doc_id, n, key per row and links (a, b) between keys."""
    labels = connected_components(links).withColumnRenamed("node", "key")
    named = profile.where("doc_id IS NOT NULL AND n > 0")
    classes = named.groupBy("key").agg(F.min("doc_id").alias("least")).join(labels, "key", "left")
    classes = written(classes.select("key", "least", F.coalesce("component", "key").alias("component")), "near-classes")
    winners = written(classes.groupBy("component").agg(F.min(F.struct("least", "key")).alias("w")).select("w.*"), "near-winners")
    # A set that wins keeps the rows of its smallest id; every other row with words goes.
    won = winners.select("key", F.col("least").alias("doc_id"), F.lit(True).alias("won"))
    marked = profile.where("doc_id IS NOT NULL").join(won, ["key", "doc_id"], "left")
    stays = (F.col("n") == 0) | F.col("won").isNotNull()
    by_id = marked.groupBy("doc_id").agg(F.count("*").alias("rows"), F.count_if(stays).alias("kept"))
    by_id = written(by_id.where("rows > 1 OR kept = 0"), "near-by-id")
    same_id = lambda ids: docs[doc_id].cast("long") == ids["doc_id"]
    rest = docs.join(by_id, same_id(by_id), "left_anti")
    mixed = by_id.where("kept > 0")
    some = docs.join(mixed, same_id(mixed), "left_semi").withColumns({"__text": F.col(text), "__id": F.col(doc_id).cast("long")})
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in some.schema.fields)
    keyed = some.mapInArrow(_keys(size), f"{kinds}, __key long, __n long")
    known = winners.select(F.col("key").alias("__key"), F.col("least").alias("__id"), F.lit(True).alias("__won"))
    keyed = keyed.join(known, ["__key", "__id"], "left").where("__n = 0 OR __won IS NOT NULL")
    once = keyed.withColumn("__same", F.when(F.col("__n") == 0, F.xxhash64("__text"))).dropDuplicates(["__id", "__key", "__same"])
    return rest.unionByName(once.select(*docs.columns))
