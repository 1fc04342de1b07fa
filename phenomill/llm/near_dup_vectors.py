"""Near-duplicate vectors by randomised-rotation binary codes.

Vectors link when their labels are equal and their cosine, in double precision, reaches the threshold. A vector is
turned by random rotations; the signs are its code. Stored with it is the correction factor, the inner product of
the (scaled) code and the turned vector. Code of one vector, turned other vector and factor give an
unbiased estimate of their inner product with an error bound; only pairs whose upper bound reaches the
threshold have their cosine computed.

Candidates meet where a band of code bits agrees. The number of bands follows from the threshold, so that a pair
just at the threshold meets in none with a probability of at most ``miss`` (pairs above it far less); the bits per band
grow with the largest label, so that buckets stay small. Buckets are cut into blocks; block pairs are compared
by matrix products, and a pair counts only in the first band where it meets. No pair leaves a task: they are summed
up as links per vector, and as a spanning forest.

Equal vectors of a label form one class with a count, whatever their number. Vectors that are null, empty, zero or
hold null or non-finite components, and rows without a label or id, link with nothing; vectors of different
length don't link. Repeated rows are vectors of their own. An empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from phenomill.llm.common import regroup, written
from phenomill.llm.components import connected_components, local_roots

THRESHOLD = 0.93
MISS = 1e-5
SPREAD = 6.0  # bound of the estimate, in standard deviations
IN_BUCKET = 64
BLOCK = 1024
SEED = 20240229

CODED = "label string, size int, band int, bucket long, class long, weight long, factor double, code binary, vector binary"
FOUND = "a long, b long, links long"


@functools.lru_cache(maxsize=8)
def rotations(size: int, bits: int) -> np.ndarray:
    """size x (whole rotations that give ``bits`` or more), scaled so that lengths stay."""
    number = -(-bits // size)
    out = []
    for k in range(number):
        q, r = np.linalg.qr(np.random.default_rng([SEED, size, k]).standard_normal((size, size)))
        out.append(q * np.sign(np.diag(r)))
    return np.concatenate(out, axis=1) / math.sqrt(number)


def bands_needed(width: int, threshold: float, miss: float) -> int:
    """Bands of ``width`` bits, so that a pair at the threshold meets in one with probability 1 - miss."""
    agree = (1 - math.acos(threshold) / math.pi) ** width
    return max(1, math.ceil(math.log(miss) / math.log1p(-agree)))


def unit(vectors: np.ndarray) -> np.ndarray:
    vectors = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return vectors / np.linalg.norm(vectors, axis=1, keepdims=True)


def encode(vectors: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Signs (rows of booleans) and correction factors."""
    turned = unit(vectors) @ rotations(vectors.shape[1], bits)
    return turned >= 0, np.abs(turned).sum(axis=1) / math.sqrt(turned.shape[1])


def upper_bounds(signs: np.ndarray, factors: np.ndarray, others: np.ndarray, spread: float = SPREAD) -> tuple[np.ndarray, np.ndarray]:
    """Estimated inner products of coded unit vectors (rows) and turned unit vectors (columns), and their upper bounds."""
    width = signs.shape[1]
    scaled = np.where(signs, 1.0, -1.0) / math.sqrt(width)
    estimate = (scaled @ others.T) / factors[:, None]
    error = spread * np.sqrt(np.maximum(0, 1 - factors**2)) / factors / math.sqrt(max(1, width - 1))
    return estimate, estimate + error[:, None]


def _band_keys(signs: np.ndarray, bands: int, width: int) -> np.ndarray:
    return signs[:, : bands * width].reshape(len(signs), bands, width) @ (1 << np.arange(width, dtype=np.int64))


def _coded(bands: int, width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [f.split()[0] for f in CODED.split(", ")]
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                sizes = np.array([len(v) for v in part.column("vector")])
                for size in np.unique(sizes).tolist():
                    own = part.take(pa.array(np.flatnonzero(sizes == size)))
                    n = own.num_rows
                    vectors = own.column("vector").flatten().to_numpy(zero_copy_only=False).astype(float).reshape(n, size)
                    signs, factors = encode(vectors, bands * width)
                    keys = _band_keys(signs, bands, width)
                    codes = [c.tobytes() for c in np.packbits(signs, axis=1)]
                    raw = [v.tobytes() for v in vectors]
                    row = np.repeat(np.arange(n), bands)
                    pick = pa.array(row)
                    columns = [
                        own.column("label").take(pick),
                        pa.array(np.full(len(row), size, dtype=np.int32)),
                        pa.array(np.tile(np.arange(bands, dtype=np.int32), n)),
                        pa.array(keys.reshape(-1)),
                        own.column("class").take(pick),
                        own.column("weight").take(pick),
                        pa.array(factors[row]),
                        pa.array(codes, pa.binary()).take(pick),
                        pa.array(raw, pa.binary()).take(pick),
                    ]
                    yield pa.RecordBatch.from_arrays(columns, names)

    return run


def _signs(codes: pa.Array, width: int) -> np.ndarray:
    packed = np.frombuffer(b"".join(codes.to_pylist()), dtype=np.uint8).reshape(len(codes), -1)
    return np.unpackbits(packed, axis=1)[:, :width].astype(bool)


def compare(rows: pa.Table, own: bool, bands: int, width: int, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Linked pairs (row numbers) of one block, or of the two blocks that column ``side`` tells apart."""
    size, band = rows.column("size")[0].as_py(), rows.column("band")[0].as_py()
    vectors = np.frombuffer(b"".join(rows.column("vector").to_pylist()), dtype=float).reshape(rows.num_rows, size)
    turn = rotations(size, bands * width)
    side = rows.column("side").to_numpy()
    left, right = (np.flatnonzero(side == 0), np.flatnonzero(side == (0 if own else 1)))
    units = unit(vectors)
    signs = _signs(rows.column("code").combine_chunks(), turn.shape[1])
    factors = rows.column("factor").to_numpy()
    keys = _band_keys(signs, bands, width)
    a_all, b_all = [], []
    for at in range(0, len(left), 256):
        part = left[at : at + 256]
        _, most = upper_bounds(signs[part], factors[part], units[right] @ turn)
        i, j = np.nonzero(most >= threshold)
        a, b = part[i], right[j]
        if own:
            a, b = a[a < b], b[a < b]
        for cut in range(0, len(a), 100_000):
            x, y = a[cut : cut + 100_000], b[cut : cut + 100_000]
            cosine = np.einsum("ij,ij->i", units[x], units[y])
            earlier = (keys[x, :band] == keys[y, :band]).any(axis=1)
            keep = (cosine >= threshold) & ~earlier
            a_all.append(x[keep])
            b_all.append(y[keep])
    none = np.empty(0, dtype=np.int64)
    return np.concatenate([none, *a_all]), np.concatenate([none, *b_all])


def _compared(bands: int, width: int, threshold: float):
    group = ["label", "size", "band", "bucket", "i", "j"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in regroup(batches, "bucket"):
            part = part.combine_chunks()
            change = np.zeros(max(0, part.num_rows - 1), dtype=bool)
            for name in group:
                values = part.column(name).to_numpy()
                change |= values[1:] != values[:-1]
            ends = [*(np.flatnonzero(change) + 1).tolist(), part.num_rows]
            at, out = 0, []
            for end in ends:
                if end - at > 1:
                    rows = part.slice(at, end - at)
                    own = rows.column("i")[0].as_py() == rows.column("j")[0].as_py()
                    a, b = compare(rows, own, bands, width, threshold)
                    if len(a):
                        ids, weight = rows.column("class").to_numpy(), rows.column("weight").to_numpy()
                        links = np.zeros(len(ids), dtype=np.int64)
                        np.add.at(links, a, weight[b])
                        np.add.at(links, b, weight[a])
                        hit = np.flatnonzero(links)
                        nodes, roots = local_roots(ids[a], ids[b])
                        tree = nodes != roots
                        out += [(c, None, n) for c, n in zip(ids[hit].tolist(), links[hit].tolist())]
                        out += [(x, y, 0) for x, y in zip(nodes[tree].tolist(), roots[tree].tolist())]
                at = end
            columns = list(zip(*out)) or [(), (), ()]
            yield pa.RecordBatch.from_arrays([pa.array(list(c), pa.int64()) for c in columns], ["a", "b", "links"])

    return run


def near_duplicates(
    vectors: DataFrame,
    threshold: float = THRESHOLD,
    miss: float = MISS,
    vec_id: str = "vec_id",
    embedding: str = "embedding",
    label: str = "label",
) -> DataFrame:
    """Per row: vec_id, n_links, component_id, kept."""
    rows = vectors.select(
        F.col(vec_id).cast("long").alias("vec_id"), F.col(embedding).alias("vector"), F.col(label).cast("string").alias("label")
    )
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    sound = F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("vector").isNotNull() & finite & F.exists("vector", lambda x: x != 0)
    rows = rows.withColumn("key", F.when(F.coalesce(sound, F.lit(False)), F.xxhash64("label", "vector")))
    # Equal keys with unequal vectors would take two of 2^64 hashes: they stay apart here and share only the row join.
    classes = written(
        rows.where("key IS NOT NULL").groupBy("key", "label", "vector").agg(F.min("vec_id").alias("class"), F.count("*").alias("weight")), "vector-classes"
    )
    largest = classes.groupBy("label").count().agg(F.max("count")).first()[0] or 1
    width = min(24, max(4, math.ceil(math.log2(largest / IN_BUCKET)))) if largest > IN_BUCKET else 4
    bands = bands_needed(width, threshold, miss)

    bucket = ["label", "size", "band", "bucket"]
    coded = written(classes.mapInArrow(_coded(bands, width), CODED), "vector-codes")
    sizes = written(coded.groupBy(*bucket).agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks")), "vector-buckets")
    own = F.pmod(F.xxhash64("class"), F.col("blocks")).cast("int")
    dealt = coded.join(sizes, bucket).withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    dealt = dealt.select(
        *coded.columns, F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), (F.col("own") > F.col("other")).cast("int").alias("side")
    )
    key = [*bucket, "i", "j"]
    ordered = dealt.repartition(*key).sortWithinPartitions("bucket", "label", "size", "band", "i", "j")
    found = written(ordered.mapInArrow(_compared(bands, width, threshold), FOUND), "vector-found")

    joined = connected_components(found.where("b IS NOT NULL").select("a", "b"))
    links = found.where("b IS NULL").groupBy("a").agg(F.sum("links").alias("links"))
    of_class = written(
        classes.select("key", "class", "weight")
        .join(links.withColumnRenamed("a", "class"), "class", "left")
        .join(joined.withColumnRenamed("node", "class"), "class", "left")
        .select("key", (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links"), F.coalesce("component", "class").alias("component_id")),
        "vector-of-class",
    )
    out = rows.select("vec_id", "key").join(of_class, "key", "left")
    component = F.coalesce("component_id", "vec_id")
    return out.select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"),
    )
