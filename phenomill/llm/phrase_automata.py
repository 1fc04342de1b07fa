"""Repeated passages: windows of ``window`` words that a document with a smaller id also has.

1. Anchors. Of the shingles in a window the one with the smallest hash is its anchor; equal windows have equal
   anchors, so documents that share a window share an anchor. Anchors of two documents or more go into a bitmap
   whose size follows their number, up to a bound. False hits cost work only.
2. Stretches. Consecutive windows with the same anchor lie under one stretch of words. All documents give the hashes of
   their stretches under recurring anchors; equal stretches (byte by byte) are one kind, with its first and last document.
   The words of a kind are sent once, by its first document.
3. Confirmation. Windows of the kinds are counted by hash; those of several documents recur. Each is looked up in one
   kind of the first document that has it: there its consecutive recurring windows form a phrase.
4. Automata. Phrases are dealt out by anchor. Each task compiles an Aho-Corasick automaton over the anchors of its
   share, then streams the kinds of all documents through it. Each hit is extended to both sides, word
   by word, against the phrases; a common run of a whole window or more is covered if the phrase's document is earlier.
   Kinds and phrases of anchors that have many are both cut into parts, each pair of parts being a task's share.
5. Occurrences. What is covered in a kind is covered wherever the kind occurs in a later document.

A phrase holds the few windows around one anchor, so a task's automaton grows with its share of anchors only.
Kinds are told apart by 128 bits: the hash of the anchor and a BLAKE2 digest of the stretch.
Words are the runs between ASCII white space, unchanged. Null texts have no words; rows without an id neither
lose words nor make others lose any; rows with equal ids don't affect each other; an empty table gives
no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from phenomill.llm.bounded import bitmap, bits_for, in_bitmap, only_in, split_by
from phenomill.llm.common import longs, rolling_hashes, slices, texts, word_hashes, word_spans, written

WINDOW = 50
ANCHOR = 24
#: Bitmaps have 8 bits for each element they are made for, up to 2^BITS (16 MB).
BITS = 27
#: An anchor with more than this share of all kinds of stretches is cut into parts; at most 1 / share anchors have so many.
HOT_SHARE = 0.005

ANCHORS = "h long, doc_id long"
OCCURRENCES = "h long, sid long, doc_id long, starts array<long>"
TEXTS = "h long, sid long, first long, last long, at int, words binary"
WINDOWS = "w long, h long, sid long, first long, last long, i int"
PHRASES = "h long, sid long, first long, at int, words binary"
MATCHES = "h long, sid long, start long, end long, owner long"
RESULT = "doc_id long, n_words long, n_removed long, kept_sha256 string"


def _narrow(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))


def first_least(values: np.ndarray, width: int) -> np.ndarray:
    """For each run of ``width`` values the position of the smallest, of equal ones the first."""
    least, at, span = values, np.arange(len(values)), 1
    while span < width:
        step = min(span, width - span)
        left = least[:-step] <= least[step:]
        at = np.where(left, at[:-step], at[step:])
        least = np.where(left, least[:-step], least[step:])
        span += step
    return at


def window_anchors(words: np.ndarray, window: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Shingle hashes, and for each window the position of its anchor (of equal ones the first)."""
    if len(words) < window:
        return np.empty(0, dtype=np.uint64), np.empty(0, dtype=np.int64)
    shingles = rolling_hashes(words, size)
    return shingles, first_least(shingles, window - size + 1)


def _joined(items: list[bytes], size: int = 1 << 16) -> Iterator[tuple[bytes, tuple[np.ndarray, np.ndarray], np.ndarray]]:
    """Texts put together until they have ``size`` bytes, with the spans of the words and the number of each word's text."""
    at = 0
    while at < len(items):
        end, held = at + 1, len(items[at])
        while end < len(items) and held + len(items[end]) <= size:
            held += len(items[end])
            end += 1
        lengths = np.array([len(t) + 1 for t in items[at:end]])
        data = b" ".join(items[at:end])
        spans = word_spans(data)
        yield data, spans, at + np.searchsorted(np.cumsum(lengths) - lengths, spans[0], side="right") - 1
        at = end


def _whole(owner: np.ndarray, window: int) -> np.ndarray:
    """Which windows over the words of joined texts lie in one text."""
    return owner[: len(owner) - window + 1] == owner[window - 1 :] if len(owner) >= window else np.empty(0, dtype=bool)


def _with_id(batch: pa.RecordBatch) -> list[bytes]:
    """The texts, empty where the row has no id."""
    return [t if known else b"" for t, known in zip(texts(batch), batch.column("doc_id").is_valid().to_pylist())]


def _anchors(window: int, size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            for data, spans, owner in _joined(_with_id(batch)):
                shingles, at = window_anchors(word_hashes(data, spans), window, size)
                whole = np.flatnonzero(_whole(owner, window))
                hashes, owners = shingles[at[whole]], owner[whole]
                new = np.ones(len(whole), dtype=bool)
                new[1:] = (hashes[1:] != hashes[:-1]) | (owners[1:] != owners[:-1])
                yield pa.RecordBatch.from_arrays([longs(hashes[new]), batch.column("doc_id").take(pa.array(owners[new]))], ["h", "doc_id"])

    return run


def _result(words: list[bytes], removed: np.ndarray) -> tuple[int, str]:
    """Number of removed words and the digest of the others."""
    if removed.any():
        words = [w for w, gone in zip(words, removed.tolist()) if not gone]
    return int(removed.sum()), hashlib.sha256(b" ".join(words)).hexdigest()


_KINDS = {"long": pa.int64(), "int": pa.int32(), "string": pa.string(), "binary": pa.binary(), "array<long>": pa.list_(pa.int64())}


def _batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    names, kinds = zip(*(f.split() for f in schema.split(", ")))
    columns = list(zip(*rows)) or [()] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(list(c), _KINDS[k]) for c, k in zip(columns, kinds)], list(names))


def _stretches(
    data: bytes, spans: tuple[np.ndarray, np.ndarray], owner: np.ndarray, window: int, size: int, recurring: np.ndarray, bits: int
) -> tuple[np.ndarray, ...]:
    """h, sid, text, place of the anchor, first word, first byte, end byte of the stretches under windows whose anchor may recur."""
    shingles, at = window_anchors(word_hashes(data, spans), window, size)
    windows = np.flatnonzero(in_bitmap(shingles, bits, recurring)[at] & _whole(owner, window))
    new = np.ones(len(windows), dtype=bool)
    new[1:] = (np.diff(windows) > 1) | (np.diff(at[windows]) != 0)
    begin, last = windows[new], windows[np.append(new[1:], True)[: len(windows)]]
    anchor, first, end = at[begin], spans[0][begin], spans[1][last + window - 1]
    digests = b"".join([hashlib.blake2b(data[a:b], digest_size=8).digest() for a, b in zip(first.tolist(), end.tolist())])
    return shingles[anchor].view(np.int64), np.frombuffer(digests, dtype="<i8"), owner[begin], anchor - begin, begin, first, end


def _occurrences(window: int, size: int, recurring: np.ndarray, bits: int):
    """Stretches of all documents, by hash; a text that repeats itself has the same one at many starts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            for data, spans, owner in _joined(_with_id(batch)):
                h, sid, text, _, begin, _, _ = _stretches(data, spans, owner, window, size, recurring, bits)
                order = np.lexsort((begin, sid, h, text))
                h, sid, text = h[order], sid[order], text[order]
                begin = begin[order] - np.searchsorted(owner, text)
                new = np.ones(len(h), dtype=bool)
                new[1:] = (np.diff(text) != 0) | (h[1:] != h[:-1]) | (sid[1:] != sid[:-1])
                offsets = np.append(np.flatnonzero(new), len(h)).astype(np.int32)
                starts = pa.ListArray.from_arrays(pa.array(offsets), pa.array(begin.astype(np.int64)))
                columns = [pa.array(h[new]), pa.array(sid[new]), batch.column("doc_id").take(pa.array(text[new])), starts]
                yield pa.RecordBatch.from_arrays(columns, ["h", "sid", "doc_id", "starts"])

    return run


def _kind_texts(window: int, size: int, recurring: np.ndarray, bits: int):
    """The words of the kinds (h, sid, last) that a document is the first one of."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 64):
            columns = (batch.column("hs"), batch.column("sids"), batch.column("lasts"))
            wanted = [dict(zip(zip(hs, sids), lasts)) for hs, sids, lasts in zip(*(c.to_pylist() for c in columns))]
            ids = batch.column("doc_id").to_pylist()
            rows, held = [], 0
            for data, spans, owner in _joined(texts(batch)):
                found = _stretches(data, spans, owner, window, size, recurring, bits)
                for h, sid, text, place, _, first, end in zip(*(x.tolist() for x in found)):
                    last = wanted[text].pop((h, sid), None)
                    if last is not None:
                        rows.append((h, sid, ids[text], last, place, data[first:end]))
                        held += end - first
                    if held > 1 << 20:
                        yield _batch(rows, TEXTS)
                        rows, held = [], 0
            if rows:
                yield _batch(rows, TEXTS)

    return run


def _windows(window: int):
    """Hashes of the windows of each kind, with their number in it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 1000):
            for data, spans, owner in _joined(batch.column("words").to_pylist()):
                whole = np.flatnonzero(_whole(owner, window))
                hashes, row = rolling_hashes(word_hashes(data, spans), window)[whole], owner[whole]
                number = pa.array((whole - np.searchsorted(owner, row)).astype(np.int32))
                others = [batch.column(c).take(pa.array(row)) for c in ("h", "sid", "first", "last")]
                yield pa.RecordBatch.from_arrays([longs(hashes), *others, number], [f.split()[0] for f in WINDOWS.split(", ")])

    return run


def _phrases(window: int):
    """Phrases of the kinds in which recurring windows (numbers in ``own``) are looked up."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 1000):
            rows = []
            for h, sid, first, at, data, own in zip(*(batch.column(c).to_pylist() for c in ("h", "sid", "first", "at", "words", "own"))):
                words = data.split()
                for start, end in merged([(i, i + 1) for i in own]):
                    rows.append((h, sid, first, at - start, b" ".join(words[start : end - 1 + window])))
            yield _batch(rows, PHRASES)

    return run


class Automaton:
    """Anchors of phrases as word sequences; finds phrases around each occurrence."""

    def __init__(self, window: int, size: int):
        self.window, self.size = window, size
        self.word: dict[bytes, int] = {}
        self.owner: dict[tuple, int] = {}  # (words, place of the anchor) of a phrase to its first document
        self.compiled = None

    def add(self, words: list[bytes], at: int, doc_id: int) -> None:
        phrase = (tuple(self.word.setdefault(w, len(self.word) + 1) for w in words), at)
        self.owner[phrase] = min(doc_id, self.owner.get(phrase, doc_id))

    def compile(self) -> None:
        around: dict[tuple, list[tuple]] = {}
        for (ids, at), doc_id in self.owner.items():
            around.setdefault(ids[at : at + self.size], []).append((ids[:at][::-1], ids[at + self.size :], doc_id))
        if around:
            self.compiled = ahocorasick.Automaton(ahocorasick.STORE_ANY, ahocorasick.KEY_SEQUENCE)
            for key, phrases in around.items():
                left, right, owners = zip(*phrases)
                self.compiled.add_word(key, (self._rows(left), self._rows(right), np.array(owners, dtype=np.int64)))
            self.compiled.make_automaton()

    @staticmethod
    def _rows(sides: tuple[tuple, ...]) -> np.ndarray:
        """Words beside an anchor, the nearest first; -1, which no text has, behind the last."""
        out = np.full((len(sides), max(map(len, sides)) + 1), -1, dtype=np.int32)
        for row, side in zip(out, sides):
            row[: len(side)] = side
        return out

    @staticmethod
    def _common(sides: np.ndarray, words: tuple) -> np.ndarray:
        """How many words of each row ``words`` begins with."""
        own = np.zeros(sides.shape[1], dtype=np.int32)
        own[: len(words)] = words[: len(own)]
        return (sides != own).argmax(axis=1)

    def matches(self, words: list[bytes], place: int | None = None) -> list[tuple[int, int, int]]:
        """(start, end, document) of the stretches of ``words`` that lie under windows of a phrase; only around ``place`` if given.

        Of equal stretches the one of the first document.
        """
        if self.compiled is None:
            return []
        ids = tuple(self.word.get(w, 0) for w in words)
        found: dict[tuple, int] = {}
        for last, (left, right, owners) in self.compiled.iter(ids):
            first = last - self.size + 1
            if place is not None and first != place:
                continue
            before = self._common(left, ids[max(0, first - left.shape[1]) : first][::-1])
            after = self._common(right, ids[last + 1 : last + 1 + right.shape[1]])
            hit = before + after + self.size >= self.window
            for a, b, owner in zip(before[hit].tolist(), after[hit].tolist(), owners[hit].tolist()):
                span = (first - a, last + 1 + b)
                found[span] = min(owner, found.get(span, owner))
        return sorted((*span, owner) for span, owner in found.items())


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Spans joined where they touch."""
    out: list[tuple[int, int]] = []
    for start, end in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((start, end))
    return out


def _search(window: int, size: int):
    """Rows with the phrases first: compile, then stream."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton, compiled = Automaton(window, size), False
        for batch in slices(batches, 2000):
            rows = []
            for h, phrase, sid, doc_id, at, data in zip(*(batch.column(c).to_pylist() for c in ("h", "phrase", "sid", "doc_id", "at", "words"))):
                if phrase:
                    automaton.add(data.split(), at, doc_id)
                    continue
                if not compiled:
                    automaton.compile()
                    compiled = True
                # All windows of a kind lie around its one anchor.
                rows += [(h, sid, *found) for found in automaton.matches(data.split(), at) if found[2] < doc_id]
            if rows:
                yield _batch(rows, MATCHES)

    return run


def _remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        rows = []
        for doc_id, text, spans in zip(batch.column("doc_id").to_pylist(), texts(batch), batch.column("spans").to_pylist()):
            words = text.split()
            gone = np.zeros(len(words), dtype=bool)
            for span in spans or ():
                gone[span["start"] : span["end"]] = True
            rows.append((doc_id, len(words), *_result(words, gone)))
        yield _batch(rows, RESULT)


def _dealt(phrases: DataFrame, kinds: DataFrame) -> DataFrame:
    """Phrases and kinds with the number of a share beside their anchor: (h, salt, phrase, sid, doc_id, at, words).

    A kind's ``doc_id`` is the last one that has it.
    """
    many = max(1000, int(kinds.count() * HOT_SHARE))
    parts = lambda n: F.floor(F.col(n) / many).cast("int") + 1
    counted = kinds.groupBy("h").agg(F.count("*").alias("k")).where(F.col("k") > many)
    counted = counted.join(phrases.groupBy("h").agg(F.count("*").alias("p")), "h")
    hot = written(counted.select("h", parts("k").alias("k"), parts("p").alias("p")), "phrase-hot")
    one = F.lit(1)

    def salted(rows: DataFrame, phrase: bool, doc_id: str) -> DataFrame:
        k, p = F.coalesce("k", one), F.coalesce("p", one)
        if phrase:
            salts = F.transform(F.sequence(F.lit(0), k - 1), lambda i: i * p + F.pmod("sid", p).cast("int"))
        else:
            salts = F.transform(F.sequence(F.lit(0), p - 1), lambda j: F.pmod("sid", k).cast("int") * p + j)
        # At most 1 / HOT_SHARE rows.
        return rows.join(F.broadcast(hot), "h", "left").select(
            "h", F.explode(salts).alias("salt"), F.lit(phrase).alias("phrase"), "sid", F.col(doc_id).alias("doc_id"), "at", "words"
        )

    return salted(phrases, True, "first").unionByName(salted(kinds, False, "last"))


def repeated_passages(docs: DataFrame, window: int = WINDOW, size: int = ANCHOR, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, start, end): stretches of words under windows that a document with a smaller id also has."""
    docs = _narrow(docs, doc_id, text)
    several = F.min("doc_id") < F.max("doc_id")
    anchors = docs.mapInArrow(_anchors(window, size), ANCHORS).groupBy("h").agg(several.alias("several")).where("several")
    anchors = written(anchors.select("h"), "phrase-anchors")
    bits = bits_for(anchors.count(), BITS)
    recurring = bitmap(anchors, bits)

    occurrences = written(docs.mapInArrow(_occurrences(window, size, recurring, bits), OCCURRENCES), "phrase-occurrences")
    kinds = occurrences.groupBy("h", "sid").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last"))
    # What the bitmap let through in vain goes here.
    kinds = written(kinds.join(anchors, "h", "left_semi"), "phrase-kinds")
    wanted = kinds.groupBy(F.col("first").alias("doc_id")).agg(F.collect_list(F.struct("h", "sid", "last")).alias("own"))
    wanted = wanted.select("doc_id", F.col("own.h").alias("hs"), F.col("own.sid").alias("sids"), F.col("own.last").alias("lasts"))
    owners = only_in(docs, "doc_id", kinds.select("first"), bits_for(kinds.count(), BITS)).join(wanted, "doc_id")
    kinds = written(owners.mapInArrow(_kind_texts(window, size, recurring, bits), TEXTS), "phrase-texts")

    low = F.min(F.struct("first", "h", "sid", "i"))
    confirmed = kinds.mapInArrow(_windows(window), WINDOWS).groupBy("w").agg(low.alias("low"), F.max("last").alias("high"))
    confirmed = confirmed.where("low.first < high").groupBy("low.h", "low.sid").agg(F.collect_list("low.i").alias("own"))
    phrases = written(kinds.join(confirmed, ["h", "sid"]).mapInArrow(_phrases(window), PHRASES), "phrases")

    searched = only_in(kinds, "h", phrases.select("h"), bits_for(phrases.count(), BITS))
    dealt = _dealt(phrases, searched).repartition("h", "salt").sortWithinPartitions(F.col("phrase").desc())
    matches = written(dealt.mapInArrow(_search(window, size), MATCHES), "phrase-matches")
    spans = matches.groupBy("h", "sid").agg(F.collect_set(F.struct("start", "end", "owner")).alias("spans"))
    hits = occurrences.join(spans, ["h", "sid"]).select("doc_id", "starts", F.explode("spans").alias("span")).where("span.owner < doc_id")
    hits = hits.select("doc_id", "span", F.explode("starts").alias("at"))
    covered = hits.select("doc_id", (F.col("at") + F.col("span.start")).alias("start"), (F.col("at") + F.col("span.end")).alias("end"))
    return written(covered, "phrase-covered")


def remove_repeats(docs: DataFrame, window: int = WINDOW, size: int = ANCHOR, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: doc_id, n_words, n_removed, kept_sha256 (the kept words joined by spaces)."""
    docs = _narrow(docs, doc_id, text)
    covered = repeated_passages(docs, window, size)
    spans = covered.groupBy("doc_id").agg(F.collect_set(F.struct("start", "end")).alias("spans"))
    touched, whole = split_by(docs, "doc_id", covered.select("doc_id"), bits_for(covered.count(), BITS))
    none = F.lit(None).cast(spans.schema["spans"].dataType).alias("spans")
    return touched.join(spans, "doc_id", "left").unionByName(whole.select("doc_id", "text", none)).mapInArrow(_remove, RESULT)
