"""The complete Jaccard self-join: every pair of different sets that may link is verified once, and links are counted.

Sets, order and prefixes are those of ``jaccard_join``. In groups of up to ``CHECKED`` sets with one prefix shingle, sets without a
candidate by length and position leave at once. Groups are cut into blocks by a hash of the
set; each pair of blocks is a task's work of its own, so a group of any size is spread. Three steps follow. With
positions and the first few shared shingles only, a set finds out in which block pairs it has a candidate by length and
position. There its counts by part of the hash space follow (a byte for about each member), and the suffix filter leaves
out candidates that can't have enough in common. Last, the members themselves follow. Sets that the pairs left connect are
verified as one group, so a set's members are sent once. Where that group would pass ``BLOCK`` sets or ``MEMBERS`` members,
its block pairs stay as they are: a pair then belongs to the first shingle that its prefixes share. Either way each pair is
verified once. No pair leaves a task: links are summed up per set, and a spanning forest gives the components.

Rows with an id are counted one by one, equal texts included; a row doesn't count itself. Rows without an id, or
without words, link with nothing.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from phenomill.llm import jaccard_join as jj
from phenomill.llm.bounded import bits_for, bucket, only_in, total_counts
from phenomill.llm.common import discard, longs, regroup, slices, texts, unsigned, written
from phenomill.llm.components import connected_components, local_roots

BLOCK = 1024
CHECKED = 256
FIRST = 8
PAIRS_AT_ONCE = 200_000
CELLS_AT_ONCE = 1 << 24
MEMBERS = 1 << 22
MOST_BITS = 27
LOW = np.int64(0xFFFFFFFF)

BLOCKS = ["h", "i", "j", "side", "meta", "key"]
NEEDED = "h long, i int, j int, side int, meta long, key long"
PARTS = "key long, data binary"
FOUND = "a long, b long, links long"


def _column(part, name: str) -> np.ndarray:
    return part.column(name).to_numpy(zero_copy_only=False) if isinstance(part, pa.RecordBatch) else part.column(name).to_numpy()


def _pairs(ends: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All pairs (row numbers) within groups of rows, some at a time; ``ends``: of the groups."""
    rows = int(ends[-1]) if len(ends) else 0
    partners = np.repeat(ends, np.diff(ends, prepend=0)) - np.arange(rows) - 1
    total = np.cumsum(partners)
    low = 0
    while low < rows:
        high = max(low + 1, int(np.searchsorted(total, (total[low - 1] if low else 0) + PAIRS_AT_ONCE, side="right")))
        count = partners[low:high]
        a = np.repeat(np.arange(low, high), count)
        yield a, a + 1 + np.arange(len(a)) - np.repeat(np.cumsum(count) - count, count)
        low = high


def _shared(percent: int):
    """Entries, each once, of shingles that several sets have; rows sorted by (h, salt, key).

    In groups of at most ``CHECKED`` sets those with a candidate by length and position only. Sets that pass at one shingle
    pass at every earlier one that they share, so a pair keeps the first.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in regroup(batches, "h"):
            h, salt, meta, key = (_column(part, c) for c in ("h", "salt", "meta", "key"))
            once = np.append(True, (h[1:] != h[:-1]) | (key[1:] != key[:-1]))
            h, salt, meta, key = h[once], salt[once], meta[once], key[once]
            start = np.flatnonzero(np.append(True, h[1:] != h[:-1]))
            n = np.diff(np.append(start, len(h)))
            size = np.repeat(n, n)
            keep = (size > CHECKED) | (salt > 0)
            small = np.flatnonzero(~keep & (size > 1))
            own = meta[small]
            for a, b in _pairs(np.cumsum(n[(n > 1) & (n <= CHECKED) & (salt[start] == 0)])):
                ok = jj._may_link(own[a], own[b], percent)
                keep[small[a[ok]]] = True
                keep[small[b[ok]]] = True
            yield pa.RecordBatch.from_arrays([pa.array(h[keep]), pa.array(meta[keep]), pa.array(key[keep])], ["h", "meta", "key"])

    return run


def _blocks(part: pa.Table) -> tuple[list[np.ndarray], np.ndarray]:
    """Columns h, i, j, side, meta, key, and the ends of the block pairs."""
    columns = [_column(part, c) for c in ("h", "i", "j", "side", "meta", "key")]
    h, i, j = columns[:3]
    change = (h[1:] != h[:-1]) | (i[1:] != i[:-1]) | (j[1:] != j[:-1])
    return columns, np.append(np.flatnonzero(change) + 1, part.num_rows)


def _room(parts: list[np.ndarray], n: np.ndarray, a: np.ndarray, b: np.ndarray, percent: int) -> np.ndarray:
    """The suffix filter: which pairs (row numbers) may have enough members in common, by their counts per part."""
    width = np.array([len(p) for p in parts])
    narrow = np.minimum(width[a], width[b])
    room = np.empty(len(a), dtype=bool)
    for w in np.unique(narrow).tolist():
        own = np.flatnonzero(narrow == w)
        rows, at = np.unique(np.concatenate([a[own], b[own]]), return_inverse=True)
        counts = np.stack([jj._folded(parts[r], w) for r in rows.tolist()])
        x, y = at[: len(own)], at[len(own) :]
        step = max(1, CELLS_AT_ONCE // w)
        for low in range(0, len(own), step):
            pairs = own[low : low + step]
            most = jj.most_common(counts[x[low : low + step]], counts[y[low : low + step]])
            room[pairs] = (100 + percent) * most >= percent * (n[a[pairs]] + n[b[pairs]])
    return room


def _candidates(percent: int, group: str, suffix: bool):
    """Rows that have a candidate in their block pair; rows sorted by (group, h, i, j).

    By length, position and the shared shingles before h; with ``suffix`` by the counts per part as well, and then
    with lead: the smallest key that the task's pairs connect a row with.
    """
    given = BLOCKS if suffix else [*BLOCKS, "first"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in regroup(batches, group):
            columns, ends = _blocks(part)
            h, i, j, side, meta, key = columns
            rows = part.num_rows
            # the shared shingles before h, as far as the list goes
            lists = part.column("first").combine_chunks()
            length = np.diff(lists.offsets.to_numpy())
            earlier = np.ones((rows, FIRST), dtype=np.int64)
            there = np.arange(FIRST) < length[:, None]
            earlier[there] = lists.flatten().to_numpy()
            at_h = (earlier == h[:, None]) & there
            earlier[np.maximum.accumulate(at_h, axis=1) | ~there] = 1
            parts = [np.frombuffer(p.as_buffer(), dtype=np.uint8) for p in part.column("parts")] if suffix else []
            needed = np.zeros(rows, dtype=bool)
            nodes = leads = np.empty(0, dtype=np.int64)
            for a, b in _pairs(ends):
                ok = ((i[a] == j[a]) | (side[a] != side[b])) & jj._may_link(meta[a], meta[b], percent)
                a, b = a[ok], b[ok]
                met = np.zeros(len(a), dtype=bool)
                for k in range(FIRST):
                    left = earlier[a, k]
                    met |= (left != 1) & (earlier[b] == left[:, None]).any(axis=1)
                a, b = a[~met], b[~met]
                if suffix and len(a):
                    room = _room(parts, meta >> 32, a, b, percent)
                    a, b = a[room], b[room]
                    nodes, leads = local_roots(np.concatenate([nodes, key[a]]), np.concatenate([leads, key[b]]))
                needed[a] = True
                needed[b] = True
            out = part.select(given).filter(pa.array(needed)).combine_chunks()
            if suffix:
                out = out.append_column("lead", pa.array(leads[np.searchsorted(nodes, key[needed])], pa.int64()))
            yield from out.to_batches()

    return run


def _data(size: int, data_of):
    """``data_of`` the set of each document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            keys, data = [], []
            for text in texts(batch):
                members = jj.shingle_set(text, size)
                keys.append(jj.set_key(members))
                data.append(data_of(members).tobytes())
            yield pa.RecordBatch.from_arrays([longs(np.array(keys, dtype=np.uint64)), pa.array(data, pa.binary())], ["key", "data"])

    return run


def _in_prefix_order(bits: int, counts: np.ndarray):
    """Members as ``jaccard_join._entries`` has them."""
    common = np.minimum(counts, (1 << 20) - 1).astype(np.uint32)

    def run(members: np.ndarray) -> np.ndarray:
        rank = (common[bucket(members, bits)].astype(np.uint64) << np.uint64(44)) | (members >> np.uint64(20))
        return members[np.argsort(rank, kind="stable")]

    return run


def _data_of_sets(docs: DataFrame, classes: DataFrame, rows: DataFrame, size: int, data_of) -> DataFrame:
    """(key, data), each key once: at least the sets in ``rows``, from one document of each. No text is shuffled for it."""
    chosen = classes.join(rows.select("key").distinct(), "key", "left_semi").select(F.col("least").alias("doc_id"))
    chosen = written(chosen, "links-chosen")
    # 32 places for each id, so that few other documents pass.
    wanted = only_in(docs, "doc_id", chosen, max(jj.FILTER_BITS, bits_for(4 * chosen.count(), MOST_BITS)))
    return wanted.mapInArrow(_data(size, data_of), PARTS).dropDuplicates(["key"])


def linked_pairs(meta: np.ndarray, side: np.ndarray, own: bool, data: list[np.ndarray], percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (row numbers) of a block pair that link and whose first shared prefix shingle is this group's.

    Rows are sorted by side; ``own``: a block with itself. ``data``: members in prefix order.
    """
    n, place = meta >> 32, meta & LOW
    stop = np.cumsum(n)
    start = stop - n
    _, ids = np.unique(np.concatenate(data), return_inverse=True)
    mark = np.zeros(int(ids.max()) + 1, dtype=np.int32)
    border = int(np.searchsorted(side, 1))
    a_all, b_all = [np.empty(0, dtype=np.int64)], [np.empty(0, dtype=np.int64)]
    for a in range(len(n) - 1 if own else border):
        low = a + 1 if own else border
        likely = np.flatnonzero(jj._may_link(meta[a : a + 1], meta[low:], percent)) + low
        if not len(likely):
            continue
        low, high = int(likely[0]), int(likely[-1]) + 1
        mine, theirs = ids[start[a] : stop[a]], ids[start[low] : stop[high - 1]]
        mark[mine] = 1
        common = np.add.reduceat(mark[theirs], start[low:high] - start[low])[likely - low]
        linked = likely[(100 + percent) * common >= percent * (n[a] + n[likely])]
        if len(linked):
            mark[mine[place[a] :]] = 0
            before = np.append(0, np.cumsum(mark[theirs]))
            at = start[linked] - start[low]
            linked = linked[before[at + place[linked]] == before[at]]
            a_all.append(np.full(len(linked), a))
            b_all.append(linked)
        mark[mine] = 0
    return np.concatenate(a_all), np.concatenate(b_all)


def _verified(percent: int):
    """Links per set (a: its key) and edges of a spanning forest (a, b: names); rows sorted by (pair, h, i, j, side, meta, key)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in regroup(batches, "pair"):
            (h, i, j, side, meta, key), ends = _blocks(part)
            name, weight = _column(part, "name"), _column(part, "weight")
            column = part.column("data").combine_chunks()
            at, out = 0, []
            for end in ends.tolist():
                rows = np.arange(at, end)
                # a set that comes from several equal rows
                rows = rows[np.append(True, (key[at + 1 : end] != key[at : end - 1]) | (side[at + 1 : end] != side[at : end - 1]))]
                data = [np.frombuffer(column[r].as_buffer(), dtype=np.uint64) for r in rows.tolist()]
                own = bool(i[at] == j[at])
                at = end
                if len(rows) < 2:
                    continue
                a, b = linked_pairs(meta[rows], side[rows], own, data, percent)
                if len(a):
                    links = np.zeros(len(rows), dtype=np.int64)
                    np.add.at(links, a, weight[rows][b])
                    np.add.at(links, b, weight[rows][a])
                    hit = np.flatnonzero(links)
                    nodes, roots = local_roots(name[rows][a], name[rows][b])
                    tree = nodes != roots
                    out += [(x, None, y) for x, y in zip(key[rows][hit].tolist(), links[hit].tolist())]
                    out += [(x, y, 0) for x, y in zip(nodes[tree].tolist(), roots[tree].tolist())]
            columns = list(zip(*out)) or [(), (), ()]
            yield pa.RecordBatch.from_arrays([pa.array(list(c), pa.int64()) for c in columns], ["a", "b", "links"])

    return run


def _gathered(likely: DataFrame) -> DataFrame:
    """Rows of ``BLOCKS``: connected sets as one block with itself (i and j -1, place 0), or the given rows where that would be too large."""
    labels = connected_components(likely.where("lead <> key").select("key", "lead")).withColumnRenamed("node", "key")
    sets = likely.groupBy("key").agg(F.max(F.shiftright("meta", 32)).alias("n")).join(labels, "key", "left")
    sets = written(sets.select("key", "n", F.coalesce("component", "key").alias("component")), "links-connected")
    large = sets.groupBy("component").agg((F.count("*") > BLOCK).alias("many"), F.sum("n").alias("members"))
    large = written(large.where(F.col("many") | (F.col("members") > MEMBERS)).select("component"), "links-too-large")
    whole = sets.join(large, "component", "left_anti").select(
        F.col("component").alias("h"), F.lit(-1).alias("i"), F.lit(-1).alias("j"), F.lit(0).alias("side"), F.shiftleft("n", 32).alias("meta"), "key"
    )
    cut = likely.join(sets.join(large, "component", "left_semi").select("key"), "key", "left_semi")
    return whole.unionByName(cut.select(*BLOCKS))


def _found(docs: DataFrame, size: int, percent: int, name: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(profile, classes, found): doc_id, n, key per row; key, least, weight per set; what ``_verified`` finds, with ``name`` for a set."""
    rows = written(docs.mapInArrow(jj._profile(size, jj.BITS), jj.PROFILE), "links-profile")
    profile = rows.where("piece IS NULL").select("doc_id", "n", "key")
    counts = total_counts(rows.where("piece IS NOT NULL").select("piece", "data"), jj.BITS)
    classes = profile.where("doc_id IS NOT NULL AND n > 0").groupBy("key").agg(F.min("doc_id").alias("least"), F.count("*").alias("weight"))
    classes = written(classes, "links-classes")

    entries = docs.mapInArrow(jj._entries(size, percent, jj.BITS, counts, jj.SALTED_ROWS), jj.ENTRY)
    ordered = entries.repartition("h", "salt").sortWithinPartitions("h", "salt", "key")
    shared = written(ordered.mapInArrow(_shared(percent), "h long, meta long, key long"), "links-shared")
    large = shared.groupBy("h").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks")).where("blocks > 1")
    large = written(large, "links-large")
    of_set = shared.groupBy("key").agg(F.array_sort(F.collect_list(F.struct("meta", "h"))).alias("own"))
    spread = of_set.select("key", F.slice("own.h", 1, FIRST).alias("first"), F.explode("own").alias("o")).select("key", "first", "o.meta", "o.h")
    spread = spread.join(large, "h", "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
    own = F.pmod(F.xxhash64("key"), F.col("blocks")).cast("int")
    dealt = spread.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    dealt = dealt.select("h", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), (F.col("own") > F.col("other")).cast("int").alias("side"), "meta", "key", "first")
    candidates = dealt.repartition("h", "i", "j").sortWithinPartitions("h", "i", "j").mapInArrow(_candidates(percent, "h", False), f"{NEEDED}, first array<long>")
    needed = written(candidates, "links-needed")
    discard(shared)

    pair = F.xxhash64("h", "i", "j").alias("pair")
    parts = _data_of_sets(docs, classes, needed, size, jj.part_counts).withColumnRenamed("data", "parts")
    counted = needed.join(parts, "key").select(pair, *BLOCKS, "first", "parts").repartition("pair").sortWithinPartitions("pair", "h", "i", "j")
    likely = written(counted.mapInArrow(_candidates(percent, "pair", True), f"{NEEDED}, lead long"), "links-likely")
    discard(needed)

    members = _data_of_sets(docs, classes, likely, size, _in_prefix_order(jj.BITS, counts))
    full = _gathered(likely).join(classes.select("key", F.col(name).alias("name"), "weight"), "key").join(members, "key").select(pair, *BLOCKS, "name", "weight", "data")
    found = written(full.repartition("pair").sortWithinPartitions("pair", *BLOCKS).mapInArrow(_verified(percent), FOUND), "links-found")
    return profile, classes, found


def linked_documents(docs: DataFrame, size: int = jj.SIZE, percent: int = jj.PERCENT, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: doc_id, n_shingles, component_id (the smallest id reachable by links), n_links (other rows it links with)."""
    profile, classes, found = _found(jj._narrow(docs, doc_id, text), size, percent, "least")
    joined = connected_components(found.where("b IS NOT NULL").select("a", "b")).withColumnRenamed("node", "least")
    links = found.where("b IS NULL").groupBy(F.col("a").alias("key")).agg(F.sum("links").alias("links"))
    of_class = written(
        classes.join(links, "key", "left")
        .join(joined, "least", "left")
        .select("key", (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links"), F.coalesce("component", "least").alias("component_id")),
        "links-of-class",
    )
    linking = F.col("doc_id").isNotNull() & (F.col("n") > 0)
    return profile.join(of_class, "key", "left").select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.when(linking, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"),
        F.when(linking, F.col("n_links")).otherwise(F.lit(0)).cast("long").alias("n_links"),
    )


def drop_near_copies(docs: DataFrame, size: int = jj.SIZE, percent: int = jj.PERCENT, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``jaccard_join.drop_near_copies`` by the components of the complete join."""
    profile, _, found = _found(jj._narrow(docs, doc_id, text), size, percent, "key")
    return jj.keep_first(docs, profile, found.where("b IS NOT NULL").select("a", "b"), size, doc_id, text)
