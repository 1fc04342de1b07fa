"""An interpolated modified Kneser-Ney n-gram model: counted in Spark, kept as sorted hash arrays, mapped by the workers.

Counting is one job with a shuffle per order. Tasks count the n-grams of their texts and send them as packed pieces, by shard
of the context; a shard's task adds the pieces up, writes one file and sends the n-grams without their first word on, for
the continuation counts of the next lower order. A file holds the sorted 64-bit hashes of the shard's n-grams
with their counts, and the sorted hashes of its contexts with their totals and numbers of n-grams seen once, twice and more
often. The number of shards grows with the bytes of text, so a shard's size stays the same. Contexts that
are frequent in a sample of the documents are spread over all shards by the n-gram's last word; the sample only
decides where counts are added up, never what they are.

Scoring tasks map the files they need and look up the sorted n-grams of a megabyte of text at a time. Files lie
in the shared folder. A folder that isn't a mounted file system is read file by file instead of mapped, and a few files are held.

Texts: A-Z lower-cased, words between ASCII white space, then one end token; n - 1 start marks come before the first
word. Null text counts as empty (the end token alone), a null id as empty text when its remainder is taken. Nothing is cut off or left
out, whatever the length; hashes of two of v different n-grams are equal with a chance of v * v / 2^65. Without
training texts each token has probability 1. Other columns are ignored.
"""

from __future__ import annotations

from collections import OrderedDict
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from phenomill.llm.common import longs, mix
from phenomill.llm.hashed_words import chunks
from phenomill.llm.mapped import map_file, write_file
from phenomill.session import scratch_path

ORDER = 2
SHARD_BYTES = 16 << 20
GRAMS_AT_ONCE = 1_500_000
SAMPLED = 64
HOT_SHARE = 1024
SALTS = np.uint64(64)
FILES_HELD = 64
_FACTOR = np.uint64(0x9E3779B97F4A7C15)
START, END = np.uint64(0x51A7B3C4D5E6F701), np.uint64(0xE4DC0B7A69584737)

PIECES = "level int, shard int, data binary, ctx long, total long, raw long, n1 long, n2 long, n3 long, n4 long, more long, keys long"
_NAMES = [f.split()[0] for f in PIECES.split(", ")]
_TYPES = [pa.int32(), pa.int32(), pa.binary()] + [pa.int64()] * 9


def gram_hash(words: list[np.ndarray]) -> np.ndarray:
    """Of the words in order; a single word is its own hash."""
    if len(words) == 1:
        return words[0]
    total = reduce(lambda t, w: t * _FACTOR + w, words)
    return mix(total + np.uint64(len(words)))


def windows(hashes: np.ndarray, owner: np.ndarray, texts: int, order: int) -> tuple[list[np.ndarray], np.ndarray]:
    """(words, text): for every token its n-gram, as one array for each place, and the number of its text."""
    each = np.bincount(owner, minlength=texts)
    size = each + order  # start marks and the end token
    first = np.cumsum(size) - size
    line = np.full(int(size.sum()), START, dtype=np.uint64)
    line[first + size - 1] = END
    target = np.ones(len(line), dtype=bool)
    for k in range(order - 1):
        target[first + k] = False
    inner = target.copy()
    inner[first + size - 1] = False
    line[inner] = hashes
    at = np.flatnonzero(target)
    return [line[at - back] for back in range(order - 1, -1, -1)], np.repeat(np.arange(texts), each + 1)


def _shard(context: np.ndarray, last: np.ndarray, hot: np.ndarray, bits: int) -> np.ndarray:
    if bits == 0:
        return np.zeros(len(context), dtype=np.int64)
    at = mix(context * _FACTOR)
    if len(hot):
        spread = np.isin(context, hot)
        at[spread] = mix(at[spread] + mix(last[spread]) % SALTS)
    return (at >> np.uint64(64 - bits)).astype(np.int64)


def _summed(words: list[np.ndarray], amounts: list[np.ndarray]) -> tuple[np.ndarray, list[np.ndarray], list[np.ndarray]]:
    """Distinct n-grams by ascending hash: hashes, words, summed amounts."""
    keys, first, at = np.unique(gram_hash(words), return_index=True, return_inverse=True)
    sums = [np.bincount(at, weights=a, minlength=len(keys)).astype(np.uint64) for a in amounts]
    return keys, [w[first] for w in words], sums


def _pack(words: list[np.ndarray], amounts: list[np.ndarray]) -> bytes:
    wide = any(len(a) and int(a.max()) >> 32 for a in amounts)
    kind = np.uint64 if wide else np.uint32
    head = np.array([len(words[0]), len(words), len(amounts), wide], dtype=np.uint64)
    return b"".join([head.tobytes(), *(w.tobytes() for w in words), *(a.astype(kind).tobytes() for a in amounts)])


def _unpack(data: bytes) -> tuple[list[np.ndarray], list[np.ndarray]]:
    n, k, m, wide = (int(x) for x in np.frombuffer(data, dtype=np.uint64, count=4))
    words = [np.frombuffer(data, dtype=np.uint64, count=n, offset=32 + 8 * n * i) for i in range(k)]
    size = 8 if wide else 4
    base = 32 + 8 * n * k
    return words, [np.frombuffer(data, dtype=np.uint64 if wide else np.uint32, count=n, offset=base + size * n * i) for i in range(m)]


def _row(level: int, shard: int | None = None, data: bytes | None = None, **stats) -> tuple:
    return (level, shard, data, *(stats.get(name, 0 if name != "ctx" else None) for name in _NAMES[3:]))


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [()] * len(_TYPES)
    return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, _TYPES)], _NAMES)


def _by_shard(level: int, words: list[np.ndarray], amounts: list[np.ndarray], hot: np.ndarray, bits: int) -> Iterator[pa.RecordBatch]:
    """Pieces of the n-grams, sorted within a piece so that equal words lie together."""
    context = gram_hash(words[:-1]) if len(words) > 1 else words[0]
    shard = _shard(context, words[-1], hot, bits)
    order = np.lexsort((*reversed(words), shard))
    cuts = np.searchsorted(shard[order], np.arange((1 << bits) + 1))
    for number in range(1 << bits):
        part = order[cuts[number] : cuts[number + 1]]
        if len(part):
            yield _batch([_row(level, number, _pack([w[part] for w in words], [a[part] for a in amounts]))])


@dataclass
class Model:
    folder: str
    order: int
    bits: int
    hot: dict[int, np.ndarray]
    tokens: int = 0
    types: int = 0
    levels: dict[int, dict[str, int]] = field(default_factory=dict)
    contexts: dict[int, tuple[np.ndarray, np.ndarray]] = field(default_factory=dict)  # of the hot ones

    def file(self, level: int, shard: int) -> str:
        return f"{self.folder}/{level}-{shard:07d}"

    def discounts(self, level: int) -> tuple[float, float, float]:
        """For n-grams counted once, twice, more often (Chen and Goodman); fixed ones where counts of counts don't allow them."""
        s = self.levels.get(level, {})
        n1, n2, n3, n4 = (s.get(f"n{i}", 0) for i in (1, 2, 3, 4))
        fixed = (0.5, 1.0, 1.5)
        if not (n1 and n2 and n3):
            return fixed
        y = n1 / (n1 + 2 * n2)
        out = (1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3)
        return out if all(0 <= d <= k for k, d in enumerate(out, 1)) else fixed


class Shard:
    """The arrays of one file."""

    def __init__(self, data: np.ndarray):
        n, c, size, raw = (int(x) for x in data[:32].view(np.uint64))
        at = 32
        take = lambda count, kind: (data[at : at + count * np.dtype(kind).itemsize].view(kind), at + count * np.dtype(kind).itemsize)
        self.keys, at = take(n, np.uint64)
        self.ctx, at = take(c, np.uint64)
        self.stats, at = take(4 * c, np.uint64)
        self.stats = self.stats.reshape(-1, 4)
        self.raw, at = take(n if raw else 0, np.uint64)
        self.counts, at = take(n, np.uint64 if size == 8 else np.uint32)


class Files:
    """Mapped shards of a model, the latest ones kept open."""

    def __init__(self, model: Model):
        self.model, self.open = model, OrderedDict()

    def shard(self, level: int, number: int) -> Shard | None:
        key = (level, number)
        if key not in self.open:
            data = map_file(self.model.file(level, number))
            self.open[key] = None if data is None else Shard(data)
            while len(self.open) > FILES_HELD:
                self.open.popitem(last=False)
        self.open.move_to_end(key)
        return self.open[key]

    def _found(self, level: int, shards: np.ndarray, keys: np.ndarray, table: str, columns: list[tuple[str, int | None]]) -> list[np.ndarray]:
        """Values at ``keys``, 0 where there is none."""
        out = [np.zeros(len(keys), dtype=np.float64) for _ in columns]
        order = np.lexsort((keys, shards))
        cuts = np.flatnonzero(np.diff(shards[order], prepend=-1))
        for low, high in zip(cuts, [*cuts[1:], len(order)]):
            rows = order[low:high]
            shard = self.shard(level, int(shards[rows[0]]))
            if shard is None:
                continue
            known = getattr(shard, table)
            at = np.searchsorted(known, keys[rows])
            at[at == len(known)] = 0
            hit = known[at] == keys[rows] if len(known) else np.zeros(len(rows), dtype=bool)
            for values, (name, k) in zip(out, columns):
                source = getattr(shard, name)
                values[rows[hit]] = source[at[hit]] if k is None else source[at[hit], k]
        return out

    def probabilities(self, words: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """(probability of the last word of each n-gram, its count in the training texts)."""
        model, last = self.model, words[-1]
        stats = model.levels.get(1, {})
        uniques, at = np.unique(last, return_inverse=True)
        counts, raw = self._found(1, _shard(uniques, uniques, np.empty(0, np.uint64), model.bits), uniques, "keys", [("counts", None), ("raw", None)])
        total = stats.get("total", 0)
        p = np.full(len(uniques), 1 / (model.types + 1))
        if total:
            d1, d2, d3 = model.discounts(1)
            left = (d1 * stats["n1"] + d2 * stats["n2"] + d3 * stats["more"]) / total
            p = (counts - _discount(counts, (d1, d2, d3))) / total + left * p
        p, raw = p[at], raw[at]
        for level in range(2, model.order + 1):
            gram = words[-level:]
            keys, first, at = np.unique(gram_hash(gram), return_index=True, return_inverse=True)
            gram = [w[first] for w in gram]
            context, hot = gram_hash(gram[:-1]), model.hot.get(level, np.empty(0, np.uint64))
            (counts,) = self._found(level, _shard(context, gram[-1], hot, model.bits), keys, "keys", [("counts", None)])
            contexts, back = np.unique(context, return_inverse=True)
            plain = _shard(contexts, contexts, np.empty(0, np.uint64), model.bits)
            sums = np.stack(self._found(level, plain, contexts, "ctx", [("stats", k) for k in range(4)]), axis=1)
            if level in model.contexts:
                known, values = model.contexts[level]
                place = np.minimum(np.searchsorted(known, contexts), len(known) - 1)
                hit = known[place] == contexts
                sums[hit] = values[place[hit]]
            sums = sums[back]
            d = model.discounts(level)
            seen = sums[:, 0] > 0
            whole = np.where(seen, sums[:, 0], 1)
            higher = (counts - _discount(counts, d)) / whole
            weight = np.where(seen, (d[0] * sums[:, 1] + d[1] * sums[:, 2] + d[2] * sums[:, 3]) / whole, 1.0)
            p = higher[at] + weight[at] * p
        return p, raw


def _discount(counts: np.ndarray, d: tuple[float, float, float]) -> np.ndarray:
    return np.choose(np.minimum(counts, 3).astype(np.int64), [0.0, *d])


def _count(order: int, bits: int, hot: dict[int, np.ndarray]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[list[np.ndarray]] = []

        def out() -> Iterator[pa.RecordBatch]:
            words = [np.concatenate(x) for x in zip(*held)]
            _, words, (counts,) = _summed(words, [np.ones(len(words[0]))])
            held.clear()
            yield from _by_shard(order, words, [counts], hot.get(order, np.empty(0, np.uint64)), bits)

        size = 0
        for batch in batches:
            for chunk in chunks(batch.column(0)):
                words, _ = windows(chunk.hashes, chunk.owner, chunk.last - chunk.first, order)
                held.append(words)
                size += len(words[0])
                if size >= GRAMS_AT_ONCE:
                    yield from out()
                    size = 0
        if held:
            yield from out()

    return run


def _merge(model: Model, level: int):
    """Adds up the pieces of the shards, writes their files, sends n-grams without their first word on."""
    hot, next_hot = (model.hot.get(k, np.empty(0, np.uint64)) for k in (level, level - 1))

    def finish(number: int, pieces: list[bytes]) -> Iterator[pa.RecordBatch]:
        parts = [_unpack(p) for p in pieces]
        words = [np.concatenate(x) for x in zip(*(p[0] for p in parts))]
        amounts = [np.concatenate(x) for x in zip(*(p[1] for p in parts))]
        keys, words, amounts = _summed(words, amounts)
        counts, raw = amounts[0], amounts[-1]
        ones = [counts == k for k in (1, 2, 3, 4)]
        more = counts > 2
        rows = [
            _row(
                level, total=int(counts.sum()), raw=int(raw.sum()), keys=len(keys), more=int(more.sum()),
                **{f"n{k}": int(x.sum()) for k, x in enumerate(ones, 1)},
            )
        ]
        contexts, stats = np.empty(0, np.uint64), np.empty((0, 4), np.uint64)
        if level > 1:
            contexts, at = np.unique(gram_hash(words[:-1]), return_inverse=True)
            columns = [np.bincount(at, weights=x, minlength=len(contexts)) for x in (counts, ones[0], ones[1], more)]
            stats = np.stack(columns, axis=1).astype(np.uint64)
            spread = np.isin(contexts, hot)
            for c, s in zip(contexts[spread].view(np.int64).tolist(), stats[spread].tolist()):
                rows.append(_row(level, ctx=c, total=s[0], n1=s[1], n2=s[2], more=s[3]))
            contexts, stats = contexts[~spread], stats[~spread]
        wide = bool(len(counts)) and int(counts.max()) >> 32 > 0
        head = np.array([len(keys), len(contexts), 8 if wide else 4, level == 1], dtype=np.uint64)
        body = [head, keys, contexts, stats, *([raw] if level == 1 else []), counts.astype(np.uint64 if wide else np.uint32)]
        write_file(model.folder, model.file(level, number).rsplit("/", 1)[1], body)
        yield _batch(rows)
        if level > 1:
            _, rest, sums = _summed(words[1:], [np.ones(len(keys)), raw])
            yield from _by_shard(level - 1, rest, sums, next_hot, model.bits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, pieces = None, []
        for batch in batches:
            for row in range(batch.num_rows):
                if batch.column(2)[row].as_py() is None:
                    yield batch.slice(row, 1)
                    continue
                shard = batch.column(1)[row].as_py()
                if shard != number and pieces:
                    yield from finish(number, pieces)
                    pieces = []
                number = shard
                pieces.append(batch.column(2)[row].as_py())
        if pieces:
            yield from finish(number, pieces)

    return run


def _frequent(texts: DataFrame, order: int) -> dict[int, np.ndarray]:
    """Contexts with at least 1 / HOT_SHARE of the tokens of a sample of the documents, by level; at most HOT_SHARE of each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk in chunks(batch.column(0)):
                words, _ = windows(chunk.hashes, chunk.owner, chunk.last - chunk.first, order)
                for level in range(2, order + 1):
                    keys, counts = np.unique(gram_hash(words[-level:-1]), return_counts=True)
                    kind = pa.array(np.full(len(keys), level, dtype=np.int32))
                    yield pa.RecordBatch.from_arrays([kind, longs(keys), pa.array(counts)], ["level", "ctx", "n"])

    sample = texts.where(F.pmod(F.xxhash64(F.substring("text", 1, 4096)), F.lit(SAMPLED)) == 0)
    counted = sample.select("text").mapInArrow(run, "level int, ctx long, n long").groupBy("level", "ctx").agg(F.sum("n").alias("n"))
    totals = counted.groupBy("level").agg(F.sum("n").alias("total"))
    rows = counted.join(totals, "level").where(F.col("n") * HOT_SHARE >= F.col("total")).collect()
    return {
        k: np.sort(np.array([r.ctx for r in rows if r.level == k], dtype=np.int64).view(np.uint64)) for k in range(2, order + 1)
    }


def fit(docs: DataFrame, order: int = ORDER, text: str = "text") -> Model:
    """The model of all texts of ``docs``; its files stay in the shared folder as long as scores are read."""
    spark = docs.sparkSession
    texts = docs.select(F.coalesce(F.col(text), F.lit("")).alias("text"))
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    bits = max(0, (size // SHARD_BYTES).bit_length())
    model = Model(scratch_path(spark, "kneser-ney"), order, bits, _frequent(texts, order))
    rows = texts.mapInArrow(_count(order, bits, model.hot), PIECES)
    for level in range(order, 0, -1):
        dealt = rows.repartition(1 << bits, "shard").sortWithinPartitions("shard")
        rows = dealt.mapInArrow(_merge(model, level), PIECES)
    sums = rows.groupBy("level", "ctx").agg(*[F.sum(c).alias(c) for c in _NAMES[4:]]).collect()
    for row in sums:
        if row.ctx is None:
            model.levels[row.level] = row.asDict()
    for level in range(2, order + 1):
        hot = sorted((np.uint64(r.ctx % (1 << 64)), (r.total, r.n1, r.n2, r.more)) for r in sums if r.ctx is not None and r.level == level)
        if hot:
            model.contexts[level] = (np.array([h for h, _ in hot], np.uint64), np.array([s for _, s in hot], np.float64))
    model.tokens = model.levels.get(1, {}).get("raw", 0)
    model.types = model.levels.get(1, {}).get("keys", 0)
    return model


SCORES = "n_tokens long, n_known long, base_score double, score double"


def scores(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``docs`` without its text and with n_tokens, n_known, base_score, score (sums of log10 over the tokens)."""
    others = [c for c in docs.columns if c != text]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files = Files(model)
        spread = model.tokens + 0.5 * (model.types + 1)
        for batch in batches:
            kept = [batch.column(c) for c in others]
            for chunk in chunks(batch.column(text)):
                n = chunk.last - chunk.first
                words, owner = windows(chunk.hashes, chunk.owner, n, model.order)
                p, raw = files.probabilities(words)
                values = [
                    pa.array(np.bincount(owner, minlength=n)),
                    pa.array(np.bincount(owner, weights=raw > 0, minlength=n).astype(np.int64)),
                    pa.array(np.bincount(owner, weights=np.log10((raw + 0.5) / spread), minlength=n)),
                    pa.array(np.bincount(owner, weights=np.log10(p), minlength=n)),
                ]
                head = [c.slice(chunk.first, n) for c in kept]
                yield pa.RecordBatch.from_arrays([*head, *values], [*others, "n_tokens", "n_known", "base_score", "score"])

    kinds = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in others)
    return docs.mapInArrow(run, ", ".join(x for x in (kinds, SCORES) if x))


def remainder(doc_id: Column, by: int = 5) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % by


def held_out_scores(docs: DataFrame, fold: int = 1, order: int = ORDER, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Scores of all texts under the model of those outside the fold.

    doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.
    """
    out = remainder(F.col(doc_id)) == fold
    model = fit(docs.where(~out), order, text)
    rows = docs.select(F.col(doc_id).alias("doc_id"), out.alias("held_out"), F.col(text).alias("text"))
    scored = scores(rows, model)
    return scored.select(
        "doc_id", "held_out", "n_tokens", "n_known", F.lit(model.tokens).cast("long").alias("train_tokens"), "base_score", "score"
    )
