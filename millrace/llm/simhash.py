"""SimHash near-duplicates by deletion-variant signatures.

Fingerprints of 64 bits link when at most ``FAR`` = 4 bits differ. Cut into three segments, one of
them differs by at most one bit, as twice three is more than four. So the two have a variant in
common: a segment with one bit made a wildcard. Each fingerprint is indexed under all its variants
(one per bit), and those of one variant are verified against each other.

A variant with more fingerprints than ``BUCKET`` is not verified as it is. Its fingerprints agree in
the variant's bits and may differ by four in the others, so the same argument cuts those others into
three and indexes under both variants together. This goes on while a group is too large, whichever
bits make it so, and loses no pair. Once no more than twelve bits are open, different fingerprints
cannot be more than 4,096.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import components, written

BITS, FAR, SEGMENTS = 64, 4, 3
BUCKET = 4096
SHINGLE = 4
SEED = 42


def fingerprint(text: bytes) -> int:
    """The fingerprint of a UTF-8 text; ASCII white space parts words, only A-Z are lowered."""
    words = text.lower().split()
    if not words:
        return 0
    digest = xxhash.xxh64_intdigest
    if len(words) < SHINGLE:
        return digest(b" ".join(words), SEED)
    ones, n = np.zeros(BITS, np.int64), len(words) - SHINGLE + 1
    for start in range(0, n, 1 << 16):  # very long texts in runs
        part = words[start : start + (1 << 16) + SHINGLE - 1]
        hashes = [digest(b"%b %b %b %b" % w, SEED) for w in zip(part, part[1:], part[2:], part[3:], strict=False)]
        bits = np.unpackbits(np.array(hashes, ">u8").view(np.uint8).reshape(-1, 8), axis=1)
        ones += bits.sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > n).tobytes(), "big")


def fingerprints(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, fp`` of every row; a null text has fingerprint 0, as one without words."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.array([fingerprint(t.as_py() or b"") for t in batch.column(1)], np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found.view(np.int64))], names=["doc_id", "fp"])

    # The scan's splits are as many as its files allow; hashing is the work, so rows stay where they are.
    return docs.select(F.col(id).cast("bigint"), F.col(text).cast("binary")).mapInArrow(scan, "doc_id bigint, fp bigint")


def cuts(mask: int) -> list[int]:
    """Masks one level deeper: of the bits open in ``mask``, three segments, each less one bit."""
    open_bits = [b for b in range(BITS) if not mask >> b & 1]
    size, more = divmod(len(open_bits), SEGMENTS)
    deeper, at = [], 0
    for s in range(SEGMENTS):
        segment = open_bits[at : at + size + (s < more)]
        at += len(segment)
        whole = mask | sum(1 << b for b in segment)
        deeper += [whole ^ (1 << b) for b in segment]
    return deeper


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _variants(fps: DataFrame) -> DataFrame:
    """``mask, value, fp``: each fingerprint under each variant of its ``mask``."""
    masks = {0: cuts(0)}

    def expand(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            mask, fp = batch.column(0).to_numpy().view(np.uint64), batch.column(1).to_numpy().view(np.uint64)
            for m in np.unique(mask):
                mine = fp[mask == m]
                deeper = np.array(masks.get(int(m)) or cuts(int(m)), np.uint64)
                for part in np.array_split(mine, max(1, len(mine) * len(deeper) // 500_000)):
                    keys = np.tile(deeper, len(part))
                    every = np.repeat(part, len(deeper))
                    arrays = [pa.array(x.view(np.int64)) for x in (keys, every & keys, every)]
                    yield pa.RecordBatch.from_arrays(arrays, names=["mask", "value", "fp"])

    return fps.select("mask", "fp").mapInArrow(expand, "mask bigint, value bigint, fp bigint")


def _forest(fp: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Links that connect what is linked among ``fp``: each new one is compared with those not reached yet."""
    left = fp
    while len(left):
        front, left = [left[0]], left[1:]
        while front and len(left):
            one = front.pop()
            near = np.bitwise_count(left ^ one) <= FAR
            if near.any():
                reached, left = left[near], left[~near]
                front += list(reached)
                yield np.full(len(reached), one), reached


def _links(grouped: DataFrame) -> DataFrame:
    """Verified links ``a, b`` that connect all fingerprints of a variant that are linked.

    ``grouped`` is sorted by variant within its partitions; no variant has more than ``BUCKET`` rows.
    """

    def emit(key: np.ndarray, fp: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        starts = np.flatnonzero(np.concatenate([[True], (key[1:] != key[:-1]).any(axis=1)]))
        sizes = np.diff(np.append(starts, len(key)))
        for n in (2, 3, 4):  # small groups together, pair by pair
            first = starts[sizes == n]
            for i in range(n):
                for j in range(i + 1, n):
                    a, b = fp[first + i], fp[first + j]
                    near = np.bitwise_count(a ^ b) <= FAR
                    if near.any():
                        yield a[near], b[near]
        for start, n in zip(starts[sizes > 4].tolist(), sizes[sizes > 4].tolist(), strict=True):
            yield from _forest(fp[start : start + n])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, fp = np.empty((0, 2), np.int64), np.empty(0, np.uint64)
        for batch in batches:
            more = np.stack([batch.column(0).to_numpy(), batch.column(1).to_numpy()], axis=1)
            key, fp = np.concatenate([key, more]), np.concatenate([fp, batch.column(2).to_numpy().view(np.uint64)])
            last = len(key) - 1
            changed = np.flatnonzero((key != key[last]).any(axis=1)) if last >= 0 else []
            cut = int(changed[-1]) + 1 if len(changed) else 0  # the last group may go on
            yield from batched(emit(key[:cut], fp[:cut]) if cut else ())
            key, fp = key[cut:], fp[cut:]
        if len(key):
            yield from batched(emit(key, fp))

    def batched(pairs) -> Iterator[pa.RecordBatch]:
        for a, b in pairs:
            yield pa.RecordBatch.from_arrays([pa.array(x.view(np.int64)) for x in (a, b)], names=["a", "b"])

    return grouped.mapInArrow(scan, "a bigint, b bigint")


def links(fps: DataFrame, bucket: int = BUCKET) -> DataFrame:
    """Links among different fingerprints (column ``fp``, each once) that connect all that are linked."""
    if bucket < 16:
        raise ValueError("bucket must be 16 or more, or cutting might not end")
    found, level = [], fps.select(F.lit(0).cast("bigint").alias("mask"), "fp")
    while True:
        variants = _variants(level)
        crowded = written(variants.groupBy("mask", "value").agg(F.count("*").alias("n")).where(F.col("n") > bucket))
        none = crowded.isEmpty()
        usual = variants if none else variants.join(crowded, ["mask", "value"], "left_anti")
        # Groups of one have nothing to link; sorting brings each group's rows together.
        sorted_rows = usual.select("mask", "value", "fp").repartition("mask", "value").sortWithinPartitions("mask", "value")
        found.append(written(_links(sorted_rows).distinct()))
        if none:
            break
        level = written(variants.join(crowded, ["mask", "value"], "left_semi").select("mask", "fp").distinct())
    every = found[0]
    for more in found[1:]:
        every = every.union(more)
    return every


def classes(prints: DataFrame, bucket: int = BUCKET) -> DataFrame:
    """``fp, component_id``: each different fingerprint with the smallest id that links reach from it.

    ``prints`` has ``doc_id, fp`` and is read several times, so pass a written table.
    """
    distinct = written(prints.groupBy("fp").agg(F.min("doc_id").alias("least")))
    roots = components(links(distinct.select("fp"), bucket))
    rooted = distinct.join(roots, distinct.fp == roots.node, "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    lowest = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    return rooted.join(lowest, "root").select("fp", "component_id")


def digest(docs: DataFrame, bucket: int = BUCKET) -> DataFrame:
    """``doc_id, fingerprint, component_id`` of every row.

    A null text, or one without words, has fingerprint zero and is linked like any other. Rows that
    repeat an id are each returned. A null id is never the smallest; alone, it is its own component.
    """
    prints = written(fingerprints(docs))
    joined = prints.join(classes(prints, bucket), "fp")
    return joined.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents with the smallest id of their component, all columns as they are.

    Rows that repeat that id all stay; rows with a null id stay if their component has no other.
    """
    spoken = docs.select(F.col(id).alias(id), F.col(text).alias(text))
    prints = written(fingerprints(spoken, id, text))
    firsts = prints.join(classes(prints), "fp").where("doc_id <=> component_id").select(F.col("doc_id").alias("kept_id")).distinct()
    return docs.join(firsts, docs[id].cast("bigint").eqNullSafe(firsts["kept_id"]), "left_semi")
