"""Vector code compression: product codes with codebooks trained by ball k-means.

Vectors of whole numbers are cut into equal parts; each part's codebook is trained by rounds of k-means
over all vectors, in exact arithmetic. The first round compares every part with every entry. After that a
part starts from the entry it had: the parts of one entry are a ball, and only entries whose centre is no farther from the ball's
than twice its radius are its neighbours. A part nearer to its centre than half way to the next entry is in the
stable core and is left alone. The others lie in rings between half the distances to one neighbour and the next, and
a ring's parts are compared with the neighbours up to theirs: by the triangle inequality no other entry can be as near.

Each round is a pass over a written table of vectors and codes, which sends a sum per entry and task.
Codebooks, ``PARTS`` times ``ENTRIES`` entries, are all that the driver and closures hold.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.common import written
from millrace.llm.hard_negatives import MOST, finite, matrix, whole

PARTS = 16
ENTRIES = 64
ROUNDS = 2
SAFE = 1 << 21  # components below this keep squared distances exact in double precision
RUN = 8192  # vectors that are assigned together
LABELS_BROADCAST = 100_000  # label sums that are broadcast; more are joined by a shuffle


def _numbers(values: np.ndarray, *others: np.ndarray) -> tuple[np.ndarray, ...]:
    """The same numbers in double precision where that is exact, else as Python's integers, which are slow."""
    every = (values, *others)
    if all(np.abs(x).max(initial=0) < SAFE for x in every):
        return tuple(np.asarray(x, np.float64) for x in every)
    return tuple(np.array([int(y) for y in x.ravel().tolist()], object).reshape(x.shape) for x in every)


def squared(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Squared distances of all rows of x to all rows of y."""
    if x.dtype == object:
        return ((x[:, None, :] - y[None, :, :]) ** 2).sum(axis=2) if x.size and y.size else np.zeros((len(x), len(y)), object)
    return (x * x).sum(axis=1)[:, None] - 2.0 * (x @ y.T) + (y * y).sum(axis=1)[None, :]


def nearest(x: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nearest entry of each row, ties to the lower index, and the squared distance."""
    apart = squared(x, entries)
    at = apart.argmin(axis=1)
    return at.astype(np.int64), apart[np.arange(len(x)), at]


def nearest_from(x: np.ndarray, entries: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """As ``nearest``, from the entry in ``start`` of each row; any start gives the same."""
    at = start.astype(np.int64).copy()
    own = ((x - entries[at]) ** 2).sum(axis=1)
    between = squared(entries, entries)
    order = np.argsort(at, kind="stable")
    edges = np.flatnonzero(np.diff(at[order], prepend=-1, append=-1))
    for low, high in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
        ball = order[low:high]
        centre = int(start[ball[0]])
        others = np.delete(np.arange(len(entries)), centre)
        others = others[np.argsort(between[centre][others], kind="stable")]
        half = between[centre][others]  # half the distance, squared, is a quarter of this
        twice = 4 * own[ball]
        # How many neighbours a part of this ball has to be compared with; none in the stable core.
        ring = np.searchsorted(half, twice, side="right")
        done = 0
        while done < len(others) and (ring > done).any():
            upto = min(max(1, 2 * done), len(others))  # rings by powers of two
            there = ball[ring > done]
            near = others[done:upto]
            apart = squared(x[there], entries[near])
            least = apart.min(axis=1)
            which = np.where(apart == least[:, None], near[None, :], len(entries)).min(axis=1)
            better = (least < own[there]) | ((least == own[there]) & (which < at[there]))
            own[there[better]], at[there[better]] = least[better], which[better]
            done = upto
    return at, own


def _parts(v: np.ndarray, parts: int) -> list[np.ndarray]:
    return np.split(v, parts, axis=1)


def _assigned(vectors: DataFrame, books: list[list[list[int]]], dim: int, coded: bool) -> DataFrame:
    """``vec_id, label, v, code, error`` of every row; ``code`` has a byte per part, and is where to start if it is there."""
    parts = len(books)
    size = len(books[0])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        entries = [np.array(b, object if max(abs(x) for e in b for x in e) >= SAFE else np.float64).reshape(size, -1) for b in books]
        for batch in batches:
            for first in range(0, batch.num_rows, RUN):
                run = batch.slice(first, RUN)
                v = whole(matrix(run.column(2), dim))
                start = np.frombuffer(b"".join(run.column(3).to_pylist()), np.uint8).reshape(-1, parts) if coded else None
                code, error = np.empty((len(v), parts), np.uint8), 0
                for k, x in enumerate(_parts(v, parts)):
                    x, e = _numbers(x, entries[k])
                    code[:, k], apart = nearest_from(x, e, start[:, k]) if coded else nearest(x, e)
                    error = error + apart
                errors = pa.array([min(int(x), MOST) for x in error.tolist()], pa.int64())
                codes = pa.array([c.tobytes() for c in code], pa.binary())
                yield pa.RecordBatch.from_arrays([*[run.column(i) for i in range(3)], codes, errors], names=["vec_id", "label", "v", "code", "error"])

    types = dict(vectors.dtypes)
    columns = ["vec_id", "label", "v", *(["code"] if coded else [])]
    shape = f"vec_id bigint, label {types['label']}, v {types['v']}, code binary, error bigint"
    return vectors.select(*columns).mapInArrow(scan, shape)


def _moved(assigned: DataFrame, books: list[list[list[int]]], dim: int) -> list[list[list[int]]]:
    """The codebooks with each used entry at the floor of its parts' mean."""
    parts, size, width = len(books), len(books[0]), dim // len(books)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((parts, size), np.int64)
        sums = np.zeros((parts, size, width), object)
        for batch in batches:
            for first in range(0, batch.num_rows, RUN):
                run = batch.slice(first, RUN)
                v = whole(matrix(run.column(0), dim))
                code = np.frombuffer(b"".join(run.column(1).to_pylist()), np.uint8).reshape(-1, parts)
                for k, x in enumerate(_parts(v, parts)):
                    counts[k] += np.bincount(code[:, k], minlength=size)
                    (exact,) = _numbers(x)
                    if exact.dtype == object:
                        np.add.at(sums[k], code[:, k], exact)
                    else:
                        for i in range(width):
                            sums[k, :, i] += np.bincount(code[:, k], exact[:, i], size).astype(np.int64)
        part, entry = np.nonzero(counts)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(part, pa.int32()), pa.array(entry, pa.int32()), pa.array(counts[part, entry], pa.int64()),
                pa.array([[str(int(x)) for x in s] for s in sums[part, entry]], pa.list_(pa.string())),
            ],
            names=["part", "entry", "n", "sums"],
        )

    def total(table: pa.Table) -> pa.Table:  # as many rows as tasks
        n = sum(table.column("n").to_pylist())
        sums = [sum(map(int, column)) for column in zip(*table.column("sums").to_pylist(), strict=True)]
        return pa.table(
            {"part": table.column("part").slice(0, 1), "entry": table.column("entry").slice(0, 1), "mean": pa.array([[str(s // n) for s in sums]], pa.list_(pa.string()))}
        )

    sent = assigned.select("v", "code").mapInArrow(add, "part int, entry int, n bigint, sums array<string>")
    means = sent.groupBy("part", "entry").applyInArrow(total, "part int, entry int, mean array<string>")
    moved = [[list(e) for e in book] for book in books]
    for row in means.collect():  # a row per entry at most
        moved[row.part][row.entry] = [int(x) for x in row["mean"]]
    return moved


def train_and_encode(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> tuple[DataFrame, list[list[list[int]]]]:
    """``vec_id, label, code, error`` of all vectors, and the codebooks: by part, entry and component.

    ``vectors`` has ``vec_id``, ``label`` and ``v`` (finite). Vectors of no length that can be cut, or of another than
    the one with the smallest id, are left out. The codebooks begin as the parts of the vectors with the smallest ids
    (nulls last, then by their components); fewer vectors make smaller codebooks. ``code`` has a byte per part.
    """
    spark: SparkSession = vectors.sparkSession
    vectors = vectors.where((F.size("v") > 0) & (F.size("v") % parts == 0))
    order = (F.col("vec_id").asc_nulls_last(), "v")
    least = vectors.orderBy(*order).select(F.size("v").alias("dim")).limit(1).collect()
    if not least:
        kind = dict(vectors.dtypes)["label"]
        return spark.createDataFrame([], f"vec_id bigint, label {kind}, code binary, error bigint"), []
    dim = least[0].dim
    vectors = vectors.where(F.size("v") == dim)
    first = [whole(np.array(r.v, np.float64)) for r in vectors.orderBy(*order).limit(entries).collect()]
    books = [[[int(x) for x in np.split(v, parts)[k].tolist()] for v in first] for k in range(parts)]
    coded = vectors
    for i in range(rounds):
        coded = written(_assigned(coded, books, dim, coded=i > 0))
        books = _moved(coded, books, dim)
    return written(_assigned(coded, books, dim, coded=rounds > 0).select("vec_id", "label", "code", "error")), books


def decoded(code: bytes, books: list[list[list[int]]]) -> list[int]:
    """The whole numbers that a code stands for."""
    return [x for k, entry in enumerate(code) for x in books[k][entry]]


def books_sha256(books: list[list[list[int]]]) -> str:
    return hashlib.sha256(",".join(str(x) for book in books for entry in book for x in entry).encode()).hexdigest()


def digest(embeddings: DataFrame) -> DataFrame:
    """``vec_id, code, error, label_error, codebooks_sha256`` of the rows of ``embeddings`` that are kept.

    Rows go whose vector is null, empty, holds a null or a component that is not finite (256-fold), cannot be cut into 16 equal
    parts, or has another length than that of the smallest id. Repeated rows count and are returned each. Errors
    beyond a long's range are held at its end. Labels that are null are one label. An empty table gives no rows.
    """
    v = F.col("embedding")
    rows = embeddings.select(F.col("vec_id").cast("bigint"), "label", v.alias("v")).where(finite(v))
    coded, books = train_and_encode(rows)
    sums = written(coded.groupBy("label").agg(F.sum(F.col("error").cast("decimal(38,0)")).alias("sum")))
    label_error = F.least("sum", F.lit(MOST).cast("decimal(38,0)")).cast("bigint")
    sums = sums.select("label", label_error.alias("label_error"))
    if sums.count() <= LABELS_BROADCAST:
        sums = F.broadcast(sums)
    same = F.col("l.label").eqNullSafe(F.col("r.label"))
    return coded.alias("l").join(sums.alias("r"), same).select(
        "l.vec_id", F.lower(F.hex("l.code")).alias("code"), "l.error", "r.label_error", F.lit(books_sha256(books)).alias("codebooks_sha256")
    )
