"""Collocations of each language, found by Rabin-Karp fingerprints and confirmed in the text.

Fingerprints: a word's hash is a difference of prefix sums of a polynomial over its bytes, mixed with its language; a
phrase's fingerprint is a polynomial over its words' hashes. A first scan counts all fingerprints: tasks add them up in sorted
arrays, a shuffle by range of fingerprints sums them, and those with enough occurrences go into sorted files, one
for each shard, whose number grows with the bytes of text. A second scan maps these files and follows each
frequent fingerprint to its occurrences: within a chunk equal hashes are compared byte by byte, each fingerprint keeps a pointer to its
first occurrence, and the phrase is read there. Then phrases are summed up as texts, so a collision of fingerprints
never merges two phrases, and a phrase is made a string only if its fingerprint is frequent. Everything after that works
on the table of frequent phrases, which is small next to the text.

Texts: A-Z lower-cased, cut at ``[.,;:!?`` and line breaks``]`` into pieces, these at spaces and tabs into words. Null texts count as
empty, a null language as ``und``; an empty table gives no phrases; repeated rows count as often as they come;
other columns are ignored. A text of any length is read whole, about 24 bytes a word are held of the longest one.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from phenomill.functions.ranks import top_n_per_group
from phenomill.llm.common import discard, mix, written
from phenomill.llm.hashed_words import Chunk, chunks, separators
from phenomill.llm.mapped import map_file, write_file
from phenomill.session import scratch_path

LEAST, LONGEST, TOP = 10, 3, 2000
CONTAINED_PERCENT = 50
SHARD_BYTES = 8 << 20
PRINTS_AT_ONCE = 4_000_000
READ_AT_ONCE = 4 << 20
BYTES_AT_ONCE = 1 << 18

ENDS_PIECE = separators(".,;:!?\n\v\f\r")
BETWEEN = ENDS_PIECE | separators(" \t")
_BASE = np.uint64(0xD6E8FEB86659FD93)
_LANG = np.uint64(0xA0761D6478BD642F)

COUNTED = "shard int, data binary, lang string, n long"
PHRASES = "lang string, phrase string, words int, a long"


class Grams:
    """The words of a chunk with their language, and which words begin a phrase of 1, 2, ... words."""

    def __init__(self, chunk: Chunk, langs: list[str]):
        self.chunk = chunk
        self.langs, code = np.unique(langs[chunk.first : chunk.last], return_inverse=True)
        salt = np.array([int.from_bytes(blake2b(x.encode(), digest_size=8).digest(), "little") for x in self.langs], dtype=np.uint64)
        self.lang = code[chunk.owner]
        self.words = mix(chunk.hashes * _LANG + salt[self.lang])
        # A text has fewer than 2^31 bytes.
        pieces = np.cumsum(ENDS_PIECE[chunk.data], dtype=np.int32)
        together = np.zeros(len(self.words), dtype=bool)
        if len(self.words) > 1:
            # No piece ends between the last byte of a word and the first of the next.
            together[:-1] = (chunk.owner[1:] == chunk.owner[:-1]) & (pieces[chunk.ends[:-1] - 1] == pieces[chunk.starts[1:]])
        self.together = together

    def starts(self, longest: int) -> Iterator[np.ndarray]:
        """Indices of the words at which phrases of 1, 2, ... words begin."""
        ok = np.ones(len(self.words), dtype=bool)
        yield np.arange(len(ok))
        for size in range(2, longest + 1):
            ok = ok[: len(ok) - 1] & self.together[size - 2 : len(self.together) - 1] if len(ok) else ok
            yield np.flatnonzero(ok)

    def prints(self, at: np.ndarray, size: int) -> np.ndarray:
        """Fingerprints of the phrases of ``size`` words that begin at ``at``."""
        total = np.zeros(len(at), dtype=np.uint64)
        for k in range(size):
            total = total * _BASE + self.words[at + k]
        return mix(total + np.uint64(size))


def _shards(prints: np.ndarray, bits: int) -> np.ndarray:
    """Where each shard begins in sorted fingerprints, and their end."""
    first = np.arange(1 << bits, dtype=np.uint64) << np.uint64(64 - bits) if bits else np.zeros(1, np.uint64)
    return np.append(np.searchsorted(prints, first), len(prints))


def _languages(batch: pa.RecordBatch) -> list[str]:
    return batch.column(1).to_pylist()


def _pieces(shards: list[int], data: list[bytes]) -> pa.RecordBatch:
    n = len(shards)
    columns = [pa.array(shards, pa.int32()), pa.array(data, pa.binary()), pa.nulls(n, pa.string()), pa.nulls(n, pa.int64())]
    return pa.RecordBatch.from_arrays(columns, ["shard", "data", "lang", "n"])


class Held:
    """Fingerprints of a task in one array that is sorted where it lies and given out as pieces of counted ones."""

    def __init__(self, bits: int):
        self.bits, self.size, self.room = bits, 0, np.empty(PRINTS_AT_ONCE, dtype=np.uint64)

    def add(self, prints: np.ndarray) -> Iterator[pa.RecordBatch]:
        while len(prints):
            part = prints[: len(self.room) - self.size]
            self.room[self.size : self.size + len(part)] = part
            self.size += len(part)
            prints = prints[len(part) :]
            if self.size == len(self.room):
                yield from self.out()

    def out(self) -> Iterator[pa.RecordBatch]:
        held = self.room[: self.size]
        held.sort()
        cuts = _shards(held, self.bits)
        for number in np.flatnonzero(np.diff(cuts)).tolist():
            part = held[cuts[number] : cuts[number + 1]]
            first = np.flatnonzero(np.append(True, part[1:] != part[:-1]))
            counts = np.diff(first, append=len(part)).astype(np.uint32)
            yield _pieces([number], [part[first].tobytes() + counts.tobytes()])
        self.size = 0


def _count(longest: int, bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = Held(bits)
        totals: dict[str, int] = {}
        for batch in batches:
            langs = _languages(batch)
            for chunk in chunks(batch.column(0), BETWEEN):
                grams = Grams(chunk, langs)
                for number, n in enumerate(np.bincount(grams.lang, minlength=len(grams.langs)).tolist()):
                    totals[grams.langs[number]] = totals.get(grams.langs[number], 0) + n
                for k, at in enumerate(grams.starts(longest), 1):
                    yield from held.add(grams.prints(at, k))
        yield from held.out()
        n = len(totals)
        columns = [pa.array([-1] * n, pa.int32()), pa.nulls(n, pa.binary()), pa.array(list(totals), pa.string()), pa.array(list(totals.values()), pa.int64())]
        yield pa.RecordBatch.from_arrays(columns, ["shard", "data", "lang", "n"])

    return run


def _merge(folder: str, least: int):
    """Sums the pieces of each shard, writes the frequent fingerprints; passes the words by language on."""

    def finish(number: int, pieces: list[bytes]) -> None:
        sizes = [len(p) // 12 for p in pieces]
        prints = np.concatenate([np.frombuffer(p, np.uint64, n) for p, n in zip(pieces, sizes)])
        counts = np.concatenate([np.frombuffer(p, np.uint32, n, 8 * n) for p, n in zip(pieces, sizes)])
        pieces.clear()
        order = np.argsort(prints, kind="stable")
        prints, counts = prints[order], counts[order].astype(np.int64)
        first = np.flatnonzero(np.concatenate([[True], prints[1:] != prints[:-1]]))
        write_file(folder, f"{number:07d}", [prints[first][np.add.reduceat(counts, first) >= least]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, pieces = None, []
        for batch in batches:
            for row in range(batch.num_rows):
                shard, data = batch.column(0)[row].as_py(), batch.column(1)[row].as_py()
                if data is None:
                    yield batch.slice(row, 1).select(["lang", "n"])
                    continue
                if shard != number and pieces:
                    finish(number, pieces)
                number = shard
                pieces.append(data)
        if pieces:
            finish(number, pieces)

    return run


class Frequent:
    """The files of frequent fingerprints, mapped."""

    def __init__(self, folder: str, bits: int):
        self.folder, self.bits, self.open = folder, bits, {}

    def shard(self, number: int) -> np.ndarray:
        if number not in self.open:
            data = map_file(f"{self.folder}/{number:07d}")
            self.open[number] = np.empty(0, np.uint64) if data is None else data.view(np.uint64)
        return self.open[number]

    def has(self, prints: np.ndarray) -> np.ndarray:
        """Which of the ascending fingerprints are frequent."""
        out = np.zeros(len(prints), dtype=bool)
        cuts = _shards(prints, self.bits)
        for number in range(1 << self.bits):
            part = slice(cuts[number], cuts[number + 1])
            known = self.shard(number) if part.stop > part.start else ()
            if len(known):
                at = np.searchsorted(known, prints[part])
                at[at == len(known)] = 0
                out[part] = known[at] == prints[part]
        return out


def _differs(chunk: Chunk, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether words a[i] and b[i] of the chunk have different bytes."""
    size, other = (chunk.ends - chunk.starts)[a], (chunk.ends - chunk.starts)[b]
    out = size != other
    same = np.flatnonzero(~out)
    total = np.cumsum(size[same])
    low = 0
    while low < len(same):
        high = max(low + 1, int(np.searchsorted(total, (total[low - 1] if low else 0) + BYTES_AT_ONCE, side="right")))
        pairs = same[low:high]
        lengths = size[pairs]
        # Bytes of all pairs at once, pairs of like number of bytes after each other.
        first = np.cumsum(lengths) - lengths
        place = np.arange(int(lengths.sum())) - np.repeat(first, lengths)
        unlike = chunk.data[place + np.repeat(chunk.starts[a[pairs]], lengths)] != chunk.data[place + np.repeat(chunk.starts[b[pairs]], lengths)]
        if unlike.any():
            out[pairs[np.unique(np.searchsorted(first, np.flatnonzero(unlike), side="right") - 1)]] = True
        low = high
    return out


def exact_words(grams: Grams) -> tuple[np.ndarray, np.ndarray]:
    """(number of each word, a word with that number): equal numbers have equal bytes and language."""
    _, first, number = np.unique(grams.words, return_index=True, return_inverse=True)
    repeated = np.flatnonzero(first[number] != np.arange(len(number)))
    other = repeated[
        _differs(grams.chunk, repeated, first[number[repeated]]) | (grams.lang[repeated] != grams.lang[first[number[repeated]]])
    ]
    known: dict[tuple, int] = {}
    extra: list[int] = []
    for i in other.tolist():  # words whose hash another word has, too
        key = (int(grams.lang[i]), grams.chunk.data[grams.chunk.starts[i] : grams.chunk.ends[i]].tobytes())
        if key not in known:
            known[key] = len(first) + len(extra)
            extra.append(i)
        number[i] = known[key]
    return number, np.concatenate([first, np.array(extra, dtype=np.int64)])


def _said(chunk: Chunk, langs: list[str], frequent: Frequent, longest: int) -> Iterator[pa.RecordBatch]:
    """The chunk's phrases with a frequent fingerprint, and how often they occur in it."""
    grams = Grams(chunk, langs)
    number, sample = exact_words(grams)
    spans = zip(chunk.starts[sample].tolist(), chunk.ends[sample].tolist())
    word = pa.array([chunk.data[s:e].tobytes().decode() for s, e in spans], pa.string())
    named = pa.array(grams.langs.tolist(), pa.string())
    ids = number.astype(np.int64, copy=False)
    phrase = ids  # numbers of the phrases of k words that begin at each word
    for k, at in enumerate(grams.starts(longest), 1):
        if not len(at):
            break
        # A phrase is its first k - 1 words, which have a number, and one more.
        key = ids[at] if k == 1 else phrase[at] * len(sample) + ids[at + k - 1]
        _, first, back, count = np.unique(key, return_index=True, return_inverse=True, return_counts=True)
        phrase = np.zeros(len(ids), dtype=np.int64)
        phrase[at] = back
        pointer = at[first]
        prints = grams.prints(pointer, k)
        order = np.argsort(prints)
        order = order[frequent.has(prints[order])]
        pointer = pointer[order]
        parts = [word.take(pa.array(ids[pointer + j])) for j in range(k)]
        said = pc.binary_join_element_wise(*parts, " ") if k > 1 else parts[0]
        columns = [named.take(pa.array(grams.lang[pointer])), said, pa.array(np.full(len(pointer), k, np.int32)), pa.array(count[order].astype(np.int64))]
        for low in range(0, len(pointer), 50_000):
            yield pa.RecordBatch.from_arrays([c.slice(low, 50_000) for c in columns], ["lang", "phrase", "words", "a"])


def _confirm(folder: str, bits: int, longest: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frequent = Frequent(folder, bits)
        for batch in batches:
            langs = _languages(batch)
            for chunk in chunks(batch.column(0), BETWEEN, size=READ_AT_ONCE):
                if len(chunk.starts):
                    yield from _said(chunk, langs, frequent, longest)

    return run


def frequent_phrases(
    docs: DataFrame, least: int = LEAST, longest: int = LONGEST, text: str = "text", lang: str = "lang"
) -> tuple[DataFrame, DataFrame]:
    """((lang, phrase, words, a) of all phrases of at most ``longest`` words with at least ``least`` occurrences, (lang, n))."""
    rows = docs.select(F.coalesce(F.col(text), F.lit("")).alias("text"), F.coalesce(F.col(lang), F.lit("und")).alias("lang"))
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    bits = max(0, (size // SHARD_BYTES).bit_length())
    folder = scratch_path(docs.sparkSession, "fingerprints")
    counted = rows.mapInArrow(_count(longest, bits), COUNTED).repartition(1 << bits, "shard").sortWithinPartitions("shard")
    totals = written(counted.mapInArrow(_merge(folder, least), "lang string, n long").groupBy("lang").agg(F.sum("n").alias("n")), "mining-words")
    found = rows.mapInArrow(_confirm(folder, bits, longest), PHRASES).groupBy("lang", "phrase", "words").agg(F.sum("a").alias("a"))
    return written(found.where(F.col("a") >= least), "mining-phrases"), totals


def _inner_phrases(longest: int):
    """Words [from, from + size) of a phrase that are a phrase of their own but shorter than it."""
    parts = []
    for whole in range(3, longest + 1):
        for size in range(2, whole):
            for start in range(whole - size + 1):
                inner = F.array_join(F.slice("split", start + 1, size), " ")
                parts.append(F.when(F.col("words") == whole, inner))
    return F.array_compact(F.array(*parts)) if parts else F.array().cast("array<string>")


def collocations(
    docs: DataFrame,
    top: int = TOP,
    least: int = LEAST,
    longest: int = LONGEST,
    contained_percent: int = CONTAINED_PERCENT,
    text: str = "text",
    lang: str = "lang",
) -> DataFrame:
    """The best ``top`` phrases of each language: lang, rank, phrase, a, l, r, n, score.

    The score is floor(10^6 a^2 / (l r)) at the cut with the lowest one. A phrase inside a longer one with at least
    ``contained_percent`` of its occurrences is left out.
    """
    phrases, totals = frequent_phrases(docs, least, longest, text, lang)
    candidates = phrases.where(F.col("words") > 1).withColumn("split", F.split("phrase", " "))
    cut = candidates.select("lang", "phrase", "a", "split", F.explode(F.sequence(F.lit(1), F.col("words") - 1)).alias("k"))
    cut = cut.select(
        "lang",
        "phrase",
        "a",
        "k",
        F.array_join(F.slice("split", F.lit(1), F.col("k")), " ").alias("left"),
        F.array_join(F.slice("split", F.col("k") + 1, F.size("split") - F.col("k")), " ").alias("right"),
    )
    left = phrases.select("lang", F.col("phrase").alias("left"), F.col("a").alias("l"))
    right = phrases.select("lang", F.col("phrase").alias("right"), F.col("a").alias("r"))
    cut = cut.join(left, ["lang", "left"]).join(right, ["lang", "right"])
    wide = lambda c: F.col(c).cast("decimal(19,0)")
    exact = cut.withColumns({"above": wide("a") * wide("a") * F.lit(1_000_000), "under": wide("l") * wide("r")})
    scored = exact.withColumn("score", F.expr("above div under"))
    scored = scored.groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("best"))
    longer = (
        candidates.where(F.col("words") > 2)
        .select("lang", F.col("a").alias("longer"), F.explode(F.array_distinct(_inner_phrases(longest))).alias("phrase"))
        .groupBy("lang", "phrase")
        .agg(F.max("longer").alias("longer"))
    )
    kept = (
        scored.join(longer, ["lang", "phrase"], "left")
        .where(F.col("longer").isNull() | (F.col("longer") * 100 < F.col("a") * contained_percent))
        .select("lang", "phrase", "a", "best.l", "best.r", "best.score")
    )
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase").asc()]
    best = written(top_n_per_group(kept, ["lang"], order, top, ["phrase"]), "mining-best")
    discard(phrases)
    ranked = best.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)))
    return ranked.join(totals, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
