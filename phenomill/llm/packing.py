"""Packing documents into sequences by vector best-fit.

A document's ids (its tokens, then an end id) are cut into pieces of ``max_tokens``, of which the
first may be shorter. Each sequence has three capacities: tokens, documents and attention cost (sum of
squared piece lengths). Pieces go in decreasing order into the open sequence that fits under every capacity and
scores best: the smallest weighted norm of what would be left (``norm``), or the largest weighted
dot product of demand and what is left (``dot``). Weights divide by the capacities.

Pieces are dealt by hash into groups of about ``group_size``; each task packs whole groups, so the work spreads,
and a group wastes at most about one sequence. Ids are stable: group number and number within it.

A text that the fast encoder's splitter can't read (a very long run of white space) is encoded by the ``tokenizers`` library.

Null texts count as empty (only the end id), rows without an id and repeated rows are packed as
documents of their own, an empty table gives no rows, other columns are ignored.
"""

from __future__ import annotations

import functools
import json
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from phenomill.llm.common import regroup, written

MAX_TOKENS = 2048
GROUP_SIZE = 20_000
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
PLACED = PIECES + ", sequence_id long, offset long"


@functools.lru_cache(maxsize=2)
def encoder(path: str, pattern: str) -> tuple[tiktoken.Encoding, frozenset[str]]:
    """An encoder that gives the ids of a byte-level ``tokenizers`` file, special tokens in texts included.

    The tiktoken library applies the same merges several times faster; in such a file the id of a merged token is
    its rank, and its characters stand for bytes by the usual table.
    """
    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    byte = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}
    special = {t["content"]: t["id"] for t in spec["added_tokens"]}
    ranks = {bytes(byte[c] for c in token): i for token, i in spec["model"]["vocab"].items() if token not in special}
    return tiktoken.Encoding("file", pat_str=pattern, mergeable_ranks=ranks, special_tokens=special), frozenset(special)


@functools.lru_cache(maxsize=2)
def exact_encoder(path: str) -> Tokenizer:
    return Tokenizer.from_file(path)


def text_ids(text: str, path: str, pattern: str) -> list[int]:
    """Ids of a text as the ``tokenizers`` library gives them."""
    encoding, special = encoder(path, pattern)
    try:
        return encoding.encode(text, allowed_special=special)
    except ValueError:  # its splitter ran out of stack
        return exact_encoder(path).encode(text, add_special_tokens=False).ids


def token_pieces(
    docs: DataFrame,
    path: str,
    pattern: str,
    doc_id: str = "doc_id",
    text: str = "text",
    max_tokens: int = MAX_TOKENS,
    end_id: int = 0,
    with_ids: bool = False,
) -> DataFrame:
    """Pieces of every document, with their ids as an array if asked for."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                rows: list[tuple] = []
                for key, value in zip(part.column("doc_id").to_pylist(), part.column("text").to_pylist()):
                    ids = np.array([*text_ids(value or "", path, pattern), end_id], dtype="<u4")
                    first = (len(ids) - 1) % max_tokens + 1
                    cuts = [0, *range(first, len(ids) + 1, max_tokens)]
                    for number, (a, b) in enumerate(zip(cuts, cuts[1:])):
                        own = ids[a:b]
                        rows.append((key, number, a, b - a, zlib.crc32(own.tobytes()), own.astype(np.int32) if with_ids else None))
                columns = list(zip(*rows)) or [()] * 6
                kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int32())]
                names = ["doc_id", "piece", "start", "length", "ids_crc32", "ids"]
                take = 6 if with_ids else 5
                yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns[:take], kinds)], names[:take])

    narrow = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return narrow.mapInArrow(run, PIECES + (", ids array<int>" if with_ids else ""))


def best_fit(
    lengths: np.ndarray,
    capacity: tuple[float, float, float],
    weights: tuple[float, float, float] = (1.0, 0.05, 0.05),
    score: str = "norm",
) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of each piece. Pieces must fit an empty bin.

    Pieces are taken longest first, ties in the given order; of equally good bins the one opened first.
    """
    n = len(lengths)
    demand = np.stack([lengths.astype(float), np.ones(n), lengths.astype(float) ** 2])
    if n and (demand.max(axis=1) > np.array(capacity)).any():
        raise ValueError("a piece is larger than a sequence")
    scale = (np.array(weights) / np.array(capacity))[:, None]
    bins, offsets = np.empty(n, dtype=np.int64), np.empty(n, dtype=np.int64)
    order = np.argsort(-lengths, kind="stable")
    left = np.empty((3, max(n, 1)))  # what is left in the open bins
    number = np.empty(max(n, 1), dtype=np.int64)
    used = np.zeros(max(n, 1), dtype=np.int64)
    opened = live = 0
    least = lengths.min() if n else 0
    for i in order.tolist():
        need = demand[:, i : i + 1]
        after = left[:, :live] - need
        fits = np.flatnonzero((after >= 0).all(axis=0))
        if len(fits):
            if score == "norm":
                value = ((after[:, fits] * scale) ** 2).sum(axis=0)
            else:
                value = -(left[:, fits] * need * scale**2).sum(axis=0)
            at = int(fits[np.argmin(value)])
        else:
            at = live
            left[:, live], number[live] = capacity, opened
            opened += 1
            live += 1
        left[:, at] -= need[:, 0]
        bins[i], offsets[i] = number[at], used[number[at]]
        used[number[at]] += lengths[i]
        # A bin that can't take even the smallest piece is closed; the order of the others stays.
        if left[0, at] < least or left[1, at] < 1 or left[2, at] < least**2:
            left[:, at : live - 1] = left[:, at + 1 : live]
            number[at : live - 1] = number[at + 1 : live]
            live -= 1
    return bins, offsets


def pack(
    pieces: DataFrame,
    max_tokens: int = MAX_TOKENS,
    max_documents: int | None = None,
    max_attention: float | None = None,
    group_size: int = GROUP_SIZE,
    score: str = "norm",
) -> DataFrame:
    """``pieces`` with sequence_id and offset. Without limits on documents and attention only the tokens bind.

    ``pieces`` must be a stored table or otherwise stay the same when read twice.
    """
    capacity = (float(max_tokens), float(max_documents or max_tokens), float(max_attention or max_tokens**2))
    groups = max(1, round(pieces.count() / group_size))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in regroup(batches, "group"):
            part = part.combine_chunks()
            group = part.column("group").to_numpy()
            ends = np.append(np.flatnonzero(np.diff(group)) + 1, len(group))
            at = 0
            for end in ends.tolist():
                own = part.slice(at, end - at)
                bins, offsets = best_fit(own.column("length").to_numpy(), capacity, score=score)
                out = own.drop_columns(["group"])
                out = out.append_column("sequence_id", pa.array(bins + (int(group[at]) << 32), pa.int64()))
                out = out.append_column("offset", pa.array(offsets, pa.int64()))
                yield from out.to_batches(max_chunksize=20_000)
                at = end

    dealt = pieces.withColumn("group", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(groups)))
    order = ["group", "length", "doc_id", "piece", "ids_crc32"]
    return dealt.repartition(groups, "group").sortWithinPartitions(*order).mapInArrow(run, PLACED)


def packed_documents(docs: DataFrame, path: str, pattern: str, **options) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset: every piece of every document in its place."""
    return pack(written(token_pieces(docs, path, pattern), "pieces"), **options)


def sequences(docs: DataFrame, placed: DataFrame, path: str, pattern: str, doc_id: str = "doc_id", text: str = "text", max_tokens: int = MAX_TOKENS) -> DataFrame:
    """(sequence_id, ids, lengths): the packed sequences themselves, for trainers. Needs unique document ids."""
    ids = token_pieces(docs, path, pattern, doc_id, text, max_tokens, with_ids=True).select("doc_id", "piece", "ids")
    rows = placed.join(ids, ["doc_id", "piece"]).groupBy("sequence_id").agg(F.array_sort(F.collect_list(F.struct("offset", "ids", "length"))).alias("p"))
    return rows.select("sequence_id", F.flatten("p.ids").alias("ids"), F.col("p.length").alias("lengths"))
