"""Secrets in texts: fixed patterns plus a token-efficiency test.

A byte-pair vocabulary spells ordinary words with few tokens and random strings with many. Runs of
``[A-Za-z0-9+/_=-]`` are measured in characters per token; a low ratio marks a random string. A run that passes as
a whole is searched for random stretches: its pieces between ``= / _ -``, and any 20 characters that tokens cover;
what is found is reported in whole pieces, without words at its ends. Known digests and
identifiers are left out first: hex digests of the usual lengths, UUIDs and numbers (digits, also in groups). Names
made of words have many characters per token and need no rule of their own.

Spans are in code points, end exclusive, and come per text in order of start, then kind (assign, access,
hex, random). The three base kinds are matched leftmost and non-overlapping, each kind on its own; random
spans never overlap a base span. Null and empty texts have no spans; every input row, also one without an id
and a repeated one, gives one row; other columns are ignored.
"""

from __future__ import annotations

import base64
import functools
import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from phenomill.llm.common import slices

# The base patterns and least lengths.
ASSIGN = re.compile(
    r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.ASCII | re.IGNORECASE
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
ASSIGN_LEAST, ACCESS_LEAST = 6, 20
KINDS = ("assign", "access", "hex", "random")

RUN = re.compile(r"[A-Za-z0-9+/_=-]{20,}")
DIGEST = re.compile(r"(?:0x)?(?:[0-9a-f]+|[0-9A-F]+)")
DIGEST_LENGTHS = (32, 40, 56, 64, 96, 128)
UUID = re.compile(r"[0-9A-Fa-f]{8}(?:-[0-9A-Fa-f]{4}){3}-[0-9A-Fa-f]{12}")
NUMBER = re.compile(r"[0-9+/_=-]+")

LEAST = 20
PIECE = re.compile(r"[A-Za-z0-9+]+")
WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
# What is left out inside a longer run.
INSIDE = re.compile(rf"(?<![A-Za-z0-9])(?:{UUID.pattern}|(?:0x)?(?:[0-9a-f]+|[0-9A-F]+))(?![A-Za-z0-9])")

SCHEMA = "doc_id long, spans array<struct<kind:string,start:long,end:long>>"
MAX_RATIO = 2.0


@functools.lru_cache(maxsize=2)
def encoding(path: str) -> tiktoken.Encoding:
    with open(path, "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    # Runs hold no white space, so one piece per run: the merges alone decide.
    return tiktoken.Encoding("ranks", pat_str=r"\S+|\s+", mergeable_ranks=ranks, special_tokens={})


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind number, end) of the fixed patterns."""
    found = []
    lower = text.lower()
    if "passw" in lower or "secret" in lower or "token" in lower or "key" in lower:
        found += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_LEAST]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= ACCESS_LEAST]
    # A run of 24 or more is the whole match of the pattern without the count.
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return found


def known(run: str) -> bool:
    """A digest, a UUID or a number (or no letter or digit at all): not a secret by its looks."""
    if DIGEST.fullmatch(run) and len(run.removeprefix("0x")) in DIGEST_LENGTHS or UUID.fullmatch(run):
        return True
    return NUMBER.fullmatch(run) is not None


def _ratio(run: str, tokens: tiktoken.Encoding) -> float:
    return len(run) / len(tokens.encode_ordinary(run))


def _random_parts(run: str, ratio: float, tokens: tiktoken.Encoding) -> list[tuple[int, int]]:
    """Random stretches of a run without known parts, in order and apart."""
    pieces = [m.span() for m in PIECE.finditer(run)]
    hits = [(s, e) for s, e in pieces if e - s >= LEAST and not known(run[s:e]) and _ratio(run[s:e], tokens) <= ratio]
    ends = [0]
    for token in tokens.decode_tokens_bytes(tokens.encode_ordinary(run)):
        ends.append(ends[-1] + len(token))
    last = 0
    for first, start in enumerate(ends):
        while last < len(ends) and ends[last] - start < LEAST:
            last += 1
        if last == len(ends):
            break
        if ends[last] - start <= ratio * (last - first) and not known(run[start : ends[last]]):
            hits.append((start, ends[last]))
    merged: list[list[int]] = []
    for start, end in sorted(hits):
        if merged and start <= merged[-1][1]:
            merged[-1][1] = max(merged[-1][1], end)
        else:
            merged.append([start, end])
    found: list[tuple[int, int]] = []
    at = 0
    for start, end in merged:
        while at < len(pieces) and pieces[at][1] <= start:
            at += 1
        to = at
        while to < len(pieces) and pieces[to][0] < end:
            to += 1
        own = pieces[at:to]
        word = [WORD.fullmatch(run[s:e]) is not None and _ratio(run[s:e], tokens) > ratio for s, e in own]
        keep = [p for p, w in zip(own, word) if not w]
        if keep:
            if found and keep[0][0] <= found[-1][1]:
                found[-1] = (found[-1][0], max(found[-1][1], keep[-1][1]))
            else:
                found.append((keep[0][0], keep[-1][1]))
    return found


def random_parts(run: str, ratio: float, tokens: tiktoken.Encoding) -> list[tuple[int, int]]:
    """Random stretches of a run that isn't random on the whole; digests and identifiers inside it are left out."""
    cuts = [m.span() for m in INSIDE.finditer(run) if known(m[0])]
    found, at = [], 0
    for start, end in [*cuts, (len(run), len(run))]:
        if start - at >= LEAST:
            found += [(at + s, at + e) for s, e in _random_parts(run[at:start], ratio, tokens)]
        at = end
    return found


def _apart(text: str, taken: list[tuple[int, int, int]]) -> Iterator[tuple[int, int]]:
    """Runs, and what base spans leave of them on either side; both lists are in order, so each is walked once."""
    base: list[list[int]] = []
    for start, _, end in sorted(taken):
        if base and start <= base[-1][1]:
            base[-1][1] = max(base[-1][1], end)
        else:
            base.append([start, end])
    first = 0
    for m in RUN.finditer(text):
        at, end = m.span()
        while first < len(base) and base[first][1] <= at:
            first += 1
        k = first
        while k < len(base) and base[k][0] < end:
            if base[k][0] - at >= LEAST:
                yield at, base[k][0]
            at = max(at, base[k][1])
            k += 1
        first = max(first, k - 1)
        if end - at >= LEAST:
            yield at, end


def random_spans(text: str, taken: list[tuple[int, int, int]], ratio: float, tokens: tiktoken.Encoding) -> list[tuple[int, int, int]]:
    """Random runs and stretches of runs outside the base spans."""
    found = []
    for start, end in _apart(text, taken):
        run = text[start:end]
        if known(run):
            continue
        if _ratio(run, tokens) <= ratio:
            found.append((start, 3, end))
        else:
            found += [(start + s, 3, start + e) for s, e in random_parts(run, ratio, tokens)]
    return found


def spans_of(text: str, ratio: float, tokens: tiktoken.Encoding) -> list[tuple[int, int, int]]:
    base = base_spans(text)
    return sorted(base + random_spans(text, base, ratio, tokens))


def scan(docs: DataFrame, ranks_path: str, doc_id: str = "doc_id", text: str = "text", ratio: float = MAX_RATIO) -> DataFrame:
    """(doc_id, spans) per row. ``ratio``: most characters per token of a random string."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = encoding(ranks_path)
        for batch in slices(batches):
            out = [
                [{"kind": KINDS[k], "start": s, "end": e} for s, k, e in spans_of(t or "", ratio, tokens)]
                for t in batch.column("text").to_pylist()
            ]
            kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(out, kind)], ["doc_id", "spans"])

    narrow = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return narrow.mapInArrow(run, SCHEMA)


def span_text(spans: str) -> F.Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def digest_columns(found: DataFrame) -> DataFrame:
    """Counts per kind, the digest of the base spans, and all spans as text."""

    def count(kind: str):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")

    base = F.filter("spans", lambda s: s["kind"] != "random")
    return found.select(
        "doc_id",
        count("assign").alias("n_assign"),
        count("access").alias("n_access"),
        count("hex").alias("n_hex"),
        F.sha2(span_text(base).cast("binary"), 256).alias("base_sha256"),
        span_text(F.col("spans")).alias("spans"),
        count("random").alias("n_random"),
    )


def redact(docs: DataFrame, ranks_path: str, text: str = "text", mark: str = "[secret]", ratio: float = MAX_RATIO) -> DataFrame:
    """``docs`` with every span replaced by ``mark``; overlapping spans count as one. All columns and rows stay, null stays null."""
    columns = docs.columns
    schema = docs.schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = encoding(ranks_path)
        for batch in slices(batches):
            out = []
            for value in batch.column(text).to_pylist():
                if value:
                    merged: list[list[int]] = []
                    for start, _, end in spans_of(value, ratio, tokens):
                        if merged and start < merged[-1][1]:
                            merged[-1][1] = max(merged[-1][1], end)
                        else:
                            merged.append([start, end])
                    for start, end in reversed(merged):
                        value = value[:start] + mark + value[end:]
                out.append(value)
            arrays = [pa.array(out, pa.string()) if c == text else batch.column(c) for c in columns]
            yield pa.RecordBatch.from_arrays(arrays, columns)

    return docs.mapInArrow(run, schema)
