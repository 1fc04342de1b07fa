"""Document quality by attention-based multiple-instance learning.

A document is a bag of passages of ``PASSAGE`` words. A passage is described by how often byte classes follow each other, and
by its words' lengths and repetition; a learned layer encodes it. Gated attention weights the passages,
the weighted sum is the document's representation, and a logistic unit scores it. Only the document's label is
needed to learn all of this; no language, source or id goes in.

The model is fitted on at most ``per_class`` labelled documents of either class (those first in hash order, of whole
texts), in one task. Every document is scored on its whole text, in one pass without a shuffle.

Null and empty texts are one empty passage. Labels other than 0 and 1 and labels without a document aren't used;
of repeated labels the smaller counts. Rows without an id are scored, too. Without labels of both classes every score is 0.5. An
empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import io
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from phenomill.llm.common import slices, texts, word_hashes, word_spans, written

PASSAGE = 64
PER_CLASS = 2000
CUT = 0.3
FOLDS = 5
EPOCHS = 24
WIDTH = 24
GATE = 16
SEED = 11

# Byte classes: control, space, line feed, digit, vowel, consonant, capital, single marks, rest of ASCII, UTF-8 lead and follow bytes.
_MARKS = b".,;:!?'\"-|*#$%&/<>@()=_"
CLASSES = 10 + len(_MARKS)


def _class_table() -> np.ndarray:
    out = np.full(256, 8, dtype=np.int64)
    out[:32], out[32], out[10] = 0, 1, 2
    out[48:58] = 3
    out[97:123] = 5
    out[[ord(c) for c in "aeiou"]] = 4
    out[65:91] = 6
    out[128:192], out[192:] = 7, 9
    for k, mark in enumerate(_MARKS):
        out[mark] = 10 + k
    return out


CLASS_OF = _class_table()
FEATURES = CLASSES * CLASSES + 4


def features(text: bytes) -> np.ndarray:
    """One row per passage."""
    starts, ends = word_spans(text)
    n = max(1, -(-len(starts) // PASSAGE))
    out = np.zeros((n, FEATURES), dtype=np.float32)
    if not len(starts):
        return out
    cls = CLASS_OF[np.frombuffer(text, dtype=np.uint8)]
    passage = np.zeros(len(cls), dtype=np.int64)
    passage[starts[PASSAGE::PASSAGE]] = 1
    passage = np.cumsum(passage)
    pair = passage[1:] * (CLASSES * CLASSES) + cls[:-1] * CLASSES + cls[1:]
    counts = np.bincount(pair, minlength=n * CLASSES * CLASSES).reshape(n, -1)
    out[:, :-4] = np.sqrt(counts / np.maximum(1, counts.sum(axis=1, keepdims=True)))
    of_word = np.arange(len(starts)) // PASSAGE
    number = np.bincount(of_word, minlength=n)
    lengths = np.bincount(of_word, weights=np.log1p(ends - starts), minlength=n)
    distinct = np.unique(np.stack([of_word.astype(np.uint64), word_hashes(text, (starts, ends))]), axis=1)[0]
    out[:, -4] = lengths / number / 4
    out[:, -3] = np.bincount(distinct.astype(np.int64), minlength=n) / number
    out[:, -2] = number / PASSAGE
    out[:, -1] = np.bincount(passage, minlength=n) / (8 * PASSAGE)
    return out


class AttentionModel:
    """tanh encoder, gated attention over passages, logistic score."""

    NAMES = ("encode", "encode_bias", "gate_v", "gate_u", "attend", "score", "score_bias")

    def __init__(self, weights: dict[str, np.ndarray]):
        self.w = weights

    @classmethod
    def fresh(cls) -> AttentionModel:
        rng = np.random.default_rng(SEED)
        draw = lambda *shape: (rng.standard_normal(shape) / np.sqrt(shape[0])).astype(np.float32)
        zero = lambda n: np.zeros(n, dtype=np.float32)
        parts = (draw(FEATURES, WIDTH) * 4, zero(WIDTH), draw(WIDTH, GATE), draw(WIDTH, GATE), draw(GATE), draw(WIDTH), zero(1))
        return cls(dict(zip(cls.NAMES, parts)))

    def forward(self, x: np.ndarray, bags: np.ndarray) -> tuple[np.ndarray, tuple]:
        """Scores of the bags that begin at rows ``bags`` of ``x``."""
        w = self.w
        e = np.tanh(x @ w["encode"] + w["encode_bias"])
        v, u = np.tanh(e @ w["gate_v"]), 1 / (1 + np.exp(-(e @ w["gate_u"])))
        logit = (v * u) @ w["attend"]
        size = np.diff(np.append(bags, len(x)))
        a = np.exp(logit - np.repeat(np.maximum.reduceat(logit, bags), size))
        a /= np.repeat(np.add.reduceat(a, bags), size)
        z = np.add.reduceat(e * a[:, None], bags)
        score = 1 / (1 + np.exp(-np.clip(z @ w["score"] + w["score_bias"][0], -30, 30)))
        return score, (e, v, u, a, z, size)

    def gradients(self, x: np.ndarray, bags: np.ndarray, label: np.ndarray) -> dict[str, np.ndarray]:
        w = self.w
        score, (e, v, u, a, z, size) = self.forward(x, bags)
        out = (score - label) / len(label)
        dz = out[:, None] * w["score"]
        per_row = np.repeat(dz, size, axis=0)
        da = (per_row * e).sum(axis=1)
        dlogit = a * (da - np.repeat(np.add.reduceat(a * da, bags), size))
        dgate = dlogit[:, None] * w["attend"]
        dv, du = dgate * u * (1 - v**2), dgate * v * u * (1 - u)
        de = (per_row * a[:, None] + dv @ w["gate_v"].T + du @ w["gate_u"].T) * (1 - e**2)
        grads = (x.T @ de, de.sum(axis=0), e.T @ dv, e.T @ du, (v * u).T @ dlogit, z.T @ out, np.array([out.sum()]))
        return dict(zip(self.NAMES, grads))

    def fit(self, bags: list[np.ndarray], labels: np.ndarray, epochs: int = EPOCHS, batch: int = 64, rate: float = 0.01) -> None:
        """Adam over shuffled batches of documents; the order depends on the seed only."""
        rng, step = np.random.default_rng(SEED), 0
        mean = {k: np.zeros_like(v) for k, v in self.w.items()}
        square = {k: np.zeros_like(v) for k, v in self.w.items()}
        for _ in range(epochs):
            order = rng.permutation(len(bags))
            for at in range(0, len(order), batch):
                own = order[at : at + batch]
                begin = np.cumsum([0] + [len(bags[i]) for i in own])[:-1]
                grads = self.gradients(np.concatenate([bags[i] for i in own]), begin, labels[own].astype(np.float32))
                step += 1
                for k, g in grads.items():
                    g = g + 1e-4 * self.w[k]
                    mean[k] = 0.9 * mean[k] + 0.1 * g
                    square[k] = 0.999 * square[k] + 0.001 * g**2
                    move = rate * (mean[k] / (1 - 0.9**step)) / (np.sqrt(square[k] / (1 - 0.999**step)) + 1e-8)
                    self.w[k] = (self.w[k] - move).astype(np.float32)

    def dump(self) -> bytes:
        buffer = io.BytesIO()
        np.savez(buffer, **self.w)
        return buffer.getvalue()

    @classmethod
    def load(cls, data: bytes) -> AttentionModel:
        with np.load(io.BytesIO(data)) as held:
            return cls({k: held[k] for k in cls.NAMES})


def fold(doc_id: str) -> F.Column:
    return F.pmod(F.crc32(F.col(doc_id).cast("string").cast("binary")), F.lit(FOLDS))


def _described(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        data = [features(t).astype(np.float16).tobytes() for t in texts(batch)]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("quality"), pa.array(data, pa.binary())], ["doc_id", "quality", "passages"])


def _fitted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    bags, labels = [], []
    for batch in batches:
        for data, label in zip(batch.column("passages").to_pylist(), batch.column("quality").to_pylist()):
            bags.append(np.frombuffer(data, dtype=np.float16).reshape(-1, FEATURES).astype(np.float32))
            labels.append(label)
    model = AttentionModel.fresh()
    if len(set(labels)) == 2:
        model.fit(bags, np.array(labels))
    else:
        model.w["score"] = np.zeros_like(model.w["score"])
    yield pa.RecordBatch.from_arrays([pa.array([model.dump()], pa.binary())], ["model"])


def fit(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS, doc_id: str = "doc_id", text: str = "text", quality: str = "quality") -> bytes:
    """The model. Learns only from ids whose fold isn't 0; ``per_class`` bounds the documents of either class."""
    usable = labels.where(F.col(doc_id).isNotNull() & F.col(quality).isin(0, 1) & (fold(doc_id) != 0))
    usable = usable.groupBy(F.col(doc_id).cast("long").alias("doc_id")).agg(F.min(quality).cast("int").alias("quality"))
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    chosen = [usable.where(F.col("quality") == q).orderBy(*order).limit(per_class) for q in (0, 1)]
    sample = written(chosen[0].unionByName(chosen[1]), "quality-sample")
    narrow = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    # The sample has at most 2 * per_class rows of two numbers: small enough to send to every task.
    described = written(narrow.join(F.broadcast(sample), "doc_id").mapInArrow(_described, "doc_id long, quality int, passages binary"), "quality-passages")
    model = described.repartition(1).sortWithinPartitions("doc_id", "passages").mapInArrow(_fitted, "model binary").first()
    return bytes(model.model) if model else AttentionModel.fresh().dump()


def _scores(model: bytes):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net = AttentionModel.load(model)
        for batch in slices(batches):
            scores: list[float] = []
            held, size = [], 0
            for text in texts(batch):
                held.append(features(text))
                size += len(held[-1])
                if size > 2000:
                    scores += _scored(net, held)
                    held, size = [], 0
            scores += _scored(net, held)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(scores, pa.float64())], ["doc_id", "score"])

    return run


def _scored(net: AttentionModel, bags: list[np.ndarray]) -> list[float]:
    if not bags:
        return []
    begin = np.cumsum([0] + [len(b) for b in bags])[:-1]
    return net.forward(np.concatenate(bags), begin)[0].astype(float).tolist()


def scores(docs: DataFrame, model: bytes, cut: float = CUT, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: doc_id, held_out, score, predicted."""
    narrow = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    rows = narrow.mapInArrow(_scores(model), "doc_id long, score double")
    return rows.select(
        "doc_id", F.coalesce(fold("doc_id") == 0, F.lit(False)).alias("held_out"), "score", (F.col("score") >= cut).cast("int").alias("predicted")
    )


def _in_portions(net: AttentionModel, documents: list[bytes], passages: int = 2000) -> list[float]:
    """Scores of the documents, encoded some at a time: until they have so many passages together."""
    out: list[float] = []
    held, size = [], 0
    for text in documents:
        held.append(features(text))
        size += len(held[-1])
        if size > passages:
            out += _scored(net, held)
            held, size = [], 0
    return out + _scored(net, held)


def keep_good(docs: DataFrame, model: bytes, cut: float = CUT, text: str = "text") -> DataFrame:
    """``docs`` without the rows that score below the cut; one pass, all columns stay."""
    columns, schema = docs.columns, docs.schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net = AttentionModel.load(model)
        for part in slices(batches, 50):
            good = np.array(_in_portions(net, texts(part, text))) >= cut
            yield part.select(columns).filter(pa.array(good))

    return docs.mapInArrow(run, schema)
