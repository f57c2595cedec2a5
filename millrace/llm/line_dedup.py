"""Fuzzy line dedup by MinHash: of each group of alike lines one stays in the corpus.

Lines are alike if the sets of their character shingles have a Jaccard similarity of ``ALIKE``: of
``SHORT_SHINGLE`` characters if both have up to ``SHORT``, where one edit spoils too many longer ones, else of ``SHINGLE``
characters. Groups are the connected components. Candidates come from signatures of one-permutation MinHash in bands: at
a similarity of 0.8 a pair shares a band with a chance of 0.998, at 0.85 of 0.9999. A bin that a line leaves empty takes the
minimum of a pseudorandom other one, the same for all lines, so the bins of a band stay independent in short lines too. All candidates
are verified on the lines themselves. Equal lines need no signature; they meet by their digest.

All pairs that share a band are settled: verified, or known to be in one group. First a band's lines are
compared with its first and with the one before, in a pseudorandom order, the same in all bands, so that most
pairs of a group are the same pairs; a scan task does
so for the lines it has itself, and holds back what a band needs no more of. Most bands are one
group then. In the others every two lines of different groups are compared, in blocks of ``BLOCK`` lines
a side, so no band is one task. That is linear in a band's largest group, and grows with the square of
its other lines, divided by ``BLOCK`` for rows and not divided for comparisons.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator
from functools import cache, partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import WORD, components, written
from millrace.llm.packing import slices

ALIKE = 0.8
SHINGLE = 9  # characters; about two words, so unrelated lines of a language have few in common
SHORT, SHORT_SHINGLE = 128, 5  # short lines have few shingles of a language anyway; longer ones have an edited word at 9
MIXED = 105  # characters from which a short line can be alike to a longer one: 0.8 of the shingles of SHORT + 1 characters
BANDS, ROWS = 16, 5
SENT = 4  # lines of a band that a batch sends to the first comparison although they are verified
BLOCK = 512  # lines of a band on one side of a block of comparisons
BITS = 1024  # of a line's shingles, in blocks
PREFIX_BITS = 20  # bound of the broadcast that tells which lines' texts are wanted: 2^20 numbers

_EMPTY = np.uint32(0xFFFFFFFF)
_P = np.uint64(0x9E3779B97F4A7C15)
_P2 = np.uint64(pow(int(_P), 2, 1 << 64))


def normal(line: str) -> str:
    """What shingles are taken of: no outer white space, lower case, at least one shingle long."""
    return line.strip().lower().ljust(SHINGLE, "\0")


class Shingles:
    """The shingles of a line: ``short`` ones if it is short, ``long`` ones if a longer line can be alike to it."""

    __slots__ = ("long", "short")

    def __init__(self, text: str) -> None:
        self.long = _grams(text, SHINGLE) if len(text) >= MIXED else None
        self.short = _grams(text, SHORT_SHINGLE) if len(text) <= SHORT else None

    def __iter__(self) -> Iterator[str]:
        yield from self.long or ()
        yield from self.short or ()


def _grams(text: str, size: int) -> set[str]:
    return {text[i : i + size] for i in range(len(text) - size + 1)}


def shingles(line: str) -> Shingles:
    return Shingles(normal(line))


def _jaccard(a: set[str], b: set[str]) -> float:
    """The similarity; 0 if the sizes alone show that it is below ``ALIKE``."""
    if min(len(a), len(b)) < ALIKE * max(len(a), len(b)):
        return 0.0
    common = len(a & b)
    return common / (len(a) + len(b) - common)


def similarity(a: Shingles, b: Shingles) -> float:
    """By short shingles if both lines are short, else by long ones; 0 where lengths leave no chance of ``ALIKE``."""
    if a.short and b.short:
        return _jaccard(a.short, b.short)
    return _jaccard(a.long, b.long) if a.long and b.long else 0.0


def _mixed(h: np.ndarray) -> np.ndarray:
    h ^= h >> np.uint64(31)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(29)
    return h


def bands(lines: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Band keys, ``BANDS`` for each kind of shingles that a line has, and the number of each key's line."""
    texts = [normal(line) for line in lines]
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    keys, whose = [], []
    for mine, size, number in ((sizes >= MIXED, SHINGLE, 1), (sizes <= SHORT, SHORT_SHINGLE, 1 + BANDS)):
        chosen = np.flatnonzero(mine)
        if len(chosen):
            keys.append(_in_runs([texts[i] for i in chosen.tolist()], sizes[chosen], size, number).ravel())
            whose.append(np.repeat(chosen, BANDS))
    return np.concatenate(keys), np.concatenate(whose)


def _in_runs(texts: list[str], sizes: np.ndarray, size: int, number: int, chars: int = 100_000) -> np.ndarray:
    """Band keys, one row per text: each a hash of ``ROWS`` minima and the band's number, from ``number`` on."""
    run = np.cumsum(sizes) // chars  # runs of lines that stay in the processor's cache
    edges = [0, *(np.flatnonzero(np.diff(run)) + 1).tolist(), len(texts)]
    return np.concatenate([_bands(texts[a:b], sizes[a:b], size, number) for a, b in zip(edges, edges[1:], strict=False)])


def _inside(sizes: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Where the shingles of each of the joined texts begin, without those that run over into the next, and how many each has."""
    n = sizes - size + 1
    first = np.cumsum(sizes) - sizes
    return np.repeat(first - (np.cumsum(n) - n), n) + np.arange(int(n.sum())), n


def _rolled(c: np.ndarray, size: int, p: int, kind: type) -> np.ndarray:
    """The characters of each shingle as digits of a number, doubled up from its halves."""
    p1, p2, p4 = (kind(pow(p, k, 1 << 8 * kind().itemsize)) for k in (1, 2, 4))
    h = c[:-1] * p1 + c[1:]
    h = h[:-2] * p2 + h[2:]
    if size == SHINGLE:
        h = h[:-4] * p4 + h[4:]
    return h[:-1] * p1 + c[size - 1 :]


def _codes(texts: list[str]) -> np.ndarray:
    return np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)


def _hashes(texts: list[str], sizes: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the shingles of all texts, one text after another, and how many each has."""
    h = _mixed(_rolled(_codes(texts).astype(np.uint64), size, int(_P), np.uint64))
    places, n = _inside(sizes, size)
    return h[places], n


def _bands(texts: list[str], sizes: np.ndarray, size: int, number: int) -> np.ndarray:
    # Numbers of half the width do for signatures.
    h = _rolled(_codes(texts), size, 0x9E3779B1, np.uint32)
    for shift, factor in ((16, 0x85EBCA6B), (13, 0xC2B2AE35)):
        h ^= h >> np.uint32(shift)
        h *= np.uint32(factor)
    h ^= h >> np.uint32(16)
    places, n = _inside(sizes, size)
    h = h[places]
    bins = BANDS * ROWS
    slot = np.repeat(np.arange(len(texts)) * bins, n)
    slot += (h >> np.uint32(16)) * np.uint32(bins) >> np.uint32(16)
    least = np.full(len(texts) * bins, _EMPTY)
    np.minimum.at(least, slot, h & np.uint32(0xFFFFFFFE))
    least = least.reshape(-1, bins)
    open_rows, step = np.flatnonzero((least == _EMPTY).any(axis=1)), 0
    source = least[open_rows].copy()
    while len(open_rows):
        part = least[open_rows]
        least[open_rows] = np.where(part == _EMPTY, source[:, _other(bins, step)], part)
        still = (least[open_rows] == _EMPTY).any(axis=1)
        open_rows, source, step = open_rows[still], source[still], step + 1
    grouped = least.reshape(-1, BANDS, ROWS).astype(np.uint64)
    key = np.broadcast_to(np.arange(number, number + BANDS, dtype=np.uint64) * _P, grouped.shape[:2]).copy()
    for r in range(ROWS):
        key = _mixed((key ^ grouped[:, :, r]) * _P)
    return key


@cache
def _other(bins: int, step: int) -> np.ndarray:
    """Where each bin looks for a minimum at a step: at random, and in the end one bin after the other."""
    own = np.arange(bins)
    if step >= 4 * bins:
        return (own + step) % bins
    seed = (own.astype(np.uint64) + np.uint64(1)) * _P + np.uint64((step + 1) * int(_P2) % (1 << 64))
    return (_mixed(_mixed(seed) * _P) % np.uint64(bins)).astype(np.int64)


def _bits(texts: list[str], size: int) -> tuple[np.ndarray, np.ndarray]:
    """``BITS`` per text, of which each shingle sets one; and the number of shingles, repeats included."""
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    h, n = _hashes(texts, sizes, size)
    flags = np.zeros(len(texts) * BITS, bool)
    flags[np.repeat(np.arange(len(texts)) * BITS, n) + (h >> np.uint64(40)).astype(np.int64) % BITS] = True
    return np.packbits(flags).view(np.uint64).reshape(len(texts), -1), n


def _possible(texts: list[str], left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Which of ``left`` can be alike to which of ``right``, a matrix.

    Bits that differ stand for different shingles that only one has. Of sets of a and b shingles that are alike at
    ``ALIKE`` no more than (a + b) (1 - ALIKE) / (1 + ALIKE) are in one only.
    """
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    out = np.zeros((len(left), len(right)), bool)
    share = (1 - ALIKE) / (1 + ALIKE) + 1e-9
    for size, low, high in ((SHINGLE, MIXED, None), (SHORT_SHINGLE, 0, SHORT)):
        rows, columns = (np.flatnonzero((sizes[x] >= low) & (sizes[x] <= (high or sizes.max(initial=0)))) for x in (left, right))
        if not len(rows) or not len(columns):
            continue
        (a, na), (b, nb) = (_bits([texts[i] for i in x.tolist()], size) for x in (left[rows], right[columns]))
        for start in range(0, len(rows), 64):
            differ = np.bitwise_count(a[start : start + 64, None, :] ^ b[None, :, :]).sum(axis=2, dtype=np.int64)
            out[np.ix_(rows[start : start + 64], columns)] |= differ <= share * (na[start : start + 64, None] + nb[None, :])
    return out


_PLACE = 23  # bits of a shingle's place in a line; the next bit tells two lines apart, those above are of its hash
_OTHER = np.uint64(1 << _PLACE)
_HASH = np.uint64(((1 << 64) - 1) ^ ((1 << _PLACE + 1) - 1))
_FAR = np.uint64(_PLACE + 1)


class _Line:
    """A line's shingles, each different one once, as sorted numbers of hash and place; which kinds, as in ``Shingles``."""

    __slots__ = ("text", "codes", "long", "short")

    def __init__(self, text: str) -> None:
        self.text, self.codes, self.long, self.short = text, None, None, None

    def at(self, places: np.ndarray, size: int) -> bytes:
        """The shingles at these places, one after another."""
        if self.codes is None:
            self.codes = self.text.encode("utf-32-le", "surrogatepass")
        return np.ndarray(len(self.text) - size + 1, f"V{4 * size}", self.codes, 0, 4)[places].tobytes()


def _prepared(texts: list[str], chars: int = 500_000) -> list[_Line]:
    """The lines of normal texts; shingles are hashed together, in runs of about ``chars``."""
    lines = [_Line(text) for text in texts]
    long = [x for x in lines if MIXED <= len(x.text) <= 1 << _PLACE]
    for size, slot, chosen in ((SHINGLE, "long", long), (SHORT_SHINGLE, "short", [x for x in lines if len(x.text) <= SHORT])):
        sizes = np.fromiter((len(x.text) for x in chosen), np.int64, len(chosen))
        run = np.cumsum(sizes) // chars
        edges = [0, *(np.flatnonzero(np.diff(run)) + 1).tolist(), len(chosen)] if len(chosen) else [0]
        for low, high in zip(edges, edges[1:], strict=False):
            h, n = _hashes([x.text for x in chosen[low:high]], sizes[low:high], size)
            ends = np.cumsum(n)
            starts = ends - n
            h &= _HASH
            h |= (np.arange(len(h)) - np.repeat(starts, n)).astype(np.uint64)
            for start, end in zip(starts.tolist(), ends.tolist(), strict=True):
                h[start:end].sort()
            new = np.append(True, (h[1:] ^ h[:-1]) >> _FAR != 0)
            new[starts] = True
            h, ends = h[new], np.cumsum(new)[ends - 1].tolist()
            for line, start, end in zip(chosen[low:high], [0, *ends], ends, strict=False):
                setattr(line, slot, h[start:end])
    return lines


def _alike(a: _Line, b: _Line) -> bool:
    """Whether ``similarity`` is ``ALIKE`` or more. Counts of hashes decide unless they are near the limit and
    a hash comes twice in a line, and shingles of one hash are compared; where either leaves a doubt the strings decide."""
    size, x, y = (SHORT_SHINGLE, a.short, b.short) if a.short is not None and b.short is not None else (SHINGLE, a.long, b.long)
    if x is None or y is None:
        either = max(len(a.text), len(b.text)) > 1 << _PLACE
        return either and similarity(Shingles(a.text), Shingles(b.text)) >= ALIKE
    if min(len(x), len(y)) + 2 < ALIKE * (max(len(x), len(y)) - 2):
        return False
    both = np.concatenate([x, y | _OTHER])
    both.sort()
    met = np.flatnonzero((both[1:] ^ both[:-1]) >> _FAR == 0)
    spare = len(met) - ALIKE * (len(x) + len(y) - len(met))
    if spare < -4:
        return False
    different = len(x) == len(a.text) - size + 1 and len(y) == len(b.text) - size + 1  # no hash comes twice in a line, so no shingle does
    if spare > 4 or different:
        mask = _OTHER - np.uint64(1)
        one, two = (both[met] & mask).astype(np.int64), (both[met + 1] & mask).astype(np.int64)
        if a.at(one, size) == b.at(two, size):
            return spare > 4 or min(len(x), len(y)) >= ALIKE * max(len(x), len(y)) and len(met) / (len(x) + len(y) - len(met)) >= ALIKE
    return similarity(Shingles(a.text), Shingles(b.text)) >= ALIKE


def _first_of_bands(flat: np.ndarray, line: np.ndarray, short: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The order of the entries by band, each one's place in its band, and the band's first line."""
    order = np.argsort(flat)
    band = flat[order]
    starts = np.flatnonzero(np.concatenate([[True], band[1:] != band[:-1]]))
    sizes = np.diff(np.append(starts, len(flat)))
    # Most bands have one line; in the others they go by ``short``.
    shared = np.repeat(sizes > 1, sizes)
    some = order[shared]
    order[shared] = some[np.lexsort((short[line[some]], band[shared]))]
    place = np.arange(len(flat)) - np.repeat(starts, sizes)
    first = line[order][np.repeat(starts, sizes)]
    return order, place, first


SKETCHED = "part int, bands binary, shorts binary, a binary, b binary, short bigint, held array<bigint>"
FOUND = "band bigint, short bigint, first bigint, before bigint, copied bigint, a binary, b binary, held array<bigint>"


def _rows(schema: pa.Schema, n: int, **columns) -> pa.RecordBatch:
    """A batch of ``n`` rows with these columns, the others null."""
    arrays = [pa.array(columns[f.name], f.type) if f.name in columns else pa.nulls(n, f.type) for f in schema]
    return pa.RecordBatch.from_arrays(arrays, schema=schema)


def _schema(ddl: str) -> pa.Schema:
    kinds = {"int": pa.int32(), "bigint": pa.int64(), "binary": pa.binary(), "array<bigint>": pa.list_(pa.int64())}
    return pa.schema([(name, kinds[kind]) for name, kind in (x.split() for x in ddl.split(", "))])


def _cut(values: np.ndarray, edges: np.ndarray) -> pa.Array:
    """The bytes of ``values`` between each two ``edges``."""
    offsets = pa.py_buffer((edges * values.itemsize).astype(np.int32))
    return pa.BinaryArray.from_buffers(pa.binary(), len(edges) - 1, [None, offsets, pa.py_buffer(np.ascontiguousarray(values))])


def _joined(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.int64)


def _own(short: np.ndarray) -> np.ndarray:
    """A band that only copies of a line share."""
    return _mixed((_mixed(short.view(np.uint64) * _P) ^ _P2) * _P)


def _sketch(batches: Iterator[pa.RecordBatch], parts: int) -> Iterator[pa.RecordBatch]:
    """Verified links inside a batch (``a``, ``b``); per line its bands under ``held`` where the band's first line is
    linked and enough others go to the first comparison; the other entries (a band and a line's ``short``) packed by ``part``,
    a range of bands. A line has an entry of its ``_own`` band as well, two if it is there more than once."""
    schema = _schema(SKETCHED)
    for batch in batches:
        for _, texts in slices(batch.column(0), 4 << 20):
            counted = Counter(line for t in texts.to_pylist() for line in t.split("\n") if line.strip(" \t\n\r\x0b\x0c"))
            if not counted:
                continue
            lines = list(counted)
            short = np.array([xxhash.xxh64_intdigest(line.encode(), 42) for line in lines], np.uint64).view(np.int64)
            band, line = bands(lines)
            order, place, first = _first_of_bands(band, line, short)
            band, line = band[order], line[order]
            held = np.zeros(len(order), bool)
            later = np.flatnonzero(place > 0)
            pairs, which = np.unique(np.stack([first[later], line[later]], axis=1), axis=0, return_inverse=True)
            alike = np.zeros(len(pairs), bool)
            if len(pairs):
                used = np.unique(pairs)
                ready = dict(zip(used.tolist(), _prepared([normal(lines[x]) for x in used.tolist()]), strict=True))
                alike = np.array([_alike(ready[x], ready[y]) for x, y in pairs.tolist()])
                held[later] = alike[which.ravel()] & (place[later] >= SENT)
            links = pairs[alike].tolist()
            if links:
                keys = {x: hashlib.md5(lines[x].encode(), usedforsecurity=False).digest() for x in {x for pair in links for x in pair}}
                yield _rows(schema, len(links), part=np.arange(len(links)) % parts, a=[keys[a] for a, _ in links], b=[keys[b] for _, b in links])
            if held.any():
                back = np.argsort(line[held], kind="stable")
                whose, sizes = np.unique(line[held], return_counts=True)
                lists = pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(sizes)), pa.int32()), pa.array(band[held][back].view(np.int64)))
                yield _rows(schema, len(whose), part=whose % parts, short=short[whose], held=lists)
            several = np.repeat(short, np.fromiter((1 + (n > 1) for n in counted.values()), np.int64, len(lines)))
            entries, whose = np.concatenate([band[~held], _own(several)]), np.concatenate([short[line[~held]], several])
            part = ((entries >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)).astype(np.uint16 if parts <= 1 << 16 else np.uint32)
            order = np.argsort(part, kind="stable")
            numbers, edges = np.unique(part[order], return_index=True)
            edges = np.append(edges, len(order))
            yield _rows(schema, len(numbers), part=numbers.astype(np.int32), bands=_cut(entries[order], edges), shorts=_cut(whose[order], edges))


def _candidates(batches: Iterator[pa.RecordBatch], together: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """A row per line of a band of several lines, with the band's ``first`` line and the one ``before``; ``copied`` lines;
    and links and held lines as they come. Rows come by ``part``. Of a part of more than ``together`` entries only the
    first line of each band is kept from one run of entries to the next."""
    schema, none = _schema(FOUND), (np.zeros(0, np.int64), np.zeros(0, np.int64))
    part, waiting, size = None, [none], 0  # the first of those waiting is what was kept
    for batch in batches:
        whole = pa.Table.from_batches([batch])
        others = whole.filter(pc.is_null(whole["bands"]))
        if len(others):
            yield _rows(schema, len(others), **{c: others[c].combine_chunks() for c in ("a", "b", "short", "held")})
        entries = whole.filter(pc.is_valid(whole["bands"])).combine_chunks()
        at = entries["part"].to_numpy()
        edges = [0, *(np.flatnonzero(np.diff(at)) + 1).tolist(), len(at)] if len(at) else []
        for low, high in zip(edges, edges[1:], strict=False):
            if at[low] != part:
                yield from _settled(waiting, schema)[0]
                part, waiting, size = at[low], [none], 0
            waiting.append(tuple(_joined(entries[c].slice(low, high - low)) for c in ("bands", "shorts")))
            size += len(waiting[-1][0])
            if size >= max(together, 2 * len(waiting[0][0])):
                rows, rest = _settled(waiting, schema)
                waiting, size = [rest], 0
                yield from rows
    yield from _settled(waiting, schema)[0]


def _settled(waiting: list[tuple], schema: pa.Schema) -> tuple[list[pa.RecordBatch], tuple[np.ndarray, np.ndarray]]:
    """The rows of ``_candidates`` for these entries, and the first line of each band."""
    band, short = (np.concatenate(x) for x in zip(*waiting, strict=True))
    order = np.argsort(band)
    band, short = band[order], short[order]
    new = _changes(band)
    alone = new & np.append(new[1:], True)[: len(new)]  # most bands have one entry
    rest = band[alone], short[alone]
    band, short = band[~alone], short[~alone]
    order = np.lexsort((short, band))
    band, short = band[order], short[order]
    new = _changes(band)
    again = ~(new | _changes(short))
    copied = np.unique(short[again & (band.view(np.uint64) == _own(short))])
    band, short, new = band[~again], short[~again], new[~again]
    starts = np.flatnonzero(new)
    sizes = np.diff(np.append(starts, len(band)))
    rest = np.append(rest[0], band[starts]), np.append(rest[1], short[starts])
    first, before, several = np.repeat(short[starts], sizes), np.roll(short, 1), np.repeat(sizes > 1, sizes)
    lines = {"first": pa.array(first[several], mask=new[several]), "before": pa.array(before[several], mask=new[several])}
    lines = _rows(schema, int(several.sum()), band=band[several], short=short[several], **lines)
    return [lines, _rows(schema, len(copied), copied=copied)], rest


def _changes(x: np.ndarray) -> np.ndarray:
    """Whether each value differs from the one before."""
    return np.append(True, x[1:] != x[:-1])[: len(x)]


def _verify(batches: Iterator[pa.RecordBatch], most: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        size = np.cumsum(pc.add(pc.binary_length(batch.column(1)), pc.binary_length(batch.column(3))).to_numpy())
        edges = [0, *(np.flatnonzero(np.diff(size // most)) + 1).tolist(), len(batch)] if len(batch) else [0]
        for low, high in zip(edges, edges[1:], strict=False):
            ka, ta, kb, tb = (c.to_pylist() for c in batch.slice(low, high - low).columns)
            lines = dict(zip(ka, ta, strict=True)) | dict(zip(kb, tb, strict=True))
            ready = dict(zip(lines, _prepared([normal(x) for x in lines.values()]), strict=True))
            yield _edges([(a, b) for a, b in zip(ka, kb, strict=True) if _alike(ready[a], ready[b])])


def _across(batches: Iterator[pa.RecordBatch], together: int = 4096) -> Iterator[pa.RecordBatch]:
    """Alike pairs of different groups; rows ``band, i, j, chunk, root, key, line`` come by block ``(band, i, j)``.

    A block compares its lines of chunk ``i`` with those of chunk ``j``, or all of them where these are one. Blocks of about
    ``together`` rows share what is prepared of a line, as alike lines meet in many bands.
    """
    block, rows, blocks, size = None, [], [], 0
    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if row[:3] != block:
                blocks.append(rows)
                size += len(rows)
                block, rows = row[:3], []
                if size >= together:
                    yield _edges(_compared(blocks))
                    blocks, size = [], 0
            rows.append(row)
    yield _edges(_compared([*blocks, rows]))


def _edges(pairs: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, pa.binary()) for c in (list(zip(*pairs, strict=True)) or [(), ()])], names=["a", "b"])


def _compared(blocks: list[list]) -> list[tuple[bytes, bytes]]:
    blocks = [rows for rows in blocks if len({row[4] for row in rows}) > 1]
    above: dict[int, int] = {}  # groups that were joined here
    texts = {row[5]: row[6] for rows in blocks for row in rows}
    ready = dict(zip(texts, _prepared([normal(x) for x in texts.values()]), strict=True))

    def top(x):
        while x in above:
            x = above[x]
        return x

    out, apart = [], set()
    for rows in blocks:
        _, i, j, *_ = rows[0]
        chunk, root = np.array([row[3] for row in rows]), np.array([row[4] for row in rows])
        left, right = np.flatnonzero(chunk == i), np.flatnonzero(chunk == j)
        possible = root[left][:, None] != root[right][None, :]
        if possible.size > 4096:
            possible &= _possible([ready[row[5]].text for row in rows], left, right)
        if i == j:
            possible &= left[:, None] < right[None, :]
        for x, y in np.argwhere(possible).tolist():
            one, two = rows[left[x]], rows[right[y]]
            a, b = top(one[4]), top(two[4])
            pair = (one[5], two[5]) if one[5] < two[5] else (two[5], one[5])
            if a == b or pair in apart:
                continue
            if _alike(ready[one[5]], ready[two[5]]):
                above[a] = b
                out.append(pair)
            else:
                apart.add(pair)
    return out


def line_key(line: Column) -> Column:
    return F.unhex(F.md5(line))


def _lines(docs: DataFrame, text: str) -> Column:
    return F.split(F.coalesce(F.col(text), F.lit("")), "\n")


def _first_comparison(found: DataFrame, docs: DataFrame, id: str, text: str) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """``a, b`` found alike; the lines of bands of several lines, ``band, short``; their texts ``short, key, line``; and
    every place of these lines and of copied ones, ``doc_id, tie, line_no, key``."""
    compared = found.where("band IS NOT NULL")
    later = compared.where("first IS NOT NULL")
    pairs = later.select("short", F.col("first").alias("other")).union(later.where("before <> first").select("short", "before"))
    pairs = pairs.select(F.least("short", "other").alias("a"), F.greatest("short", "other").alias("b")).distinct()
    # Lines that are in some pair, held back or copied; all others go nowhere. The filter before the shuffle lets a few more pass.
    wanted = found.where("short IS NOT NULL").select("short", F.lit(1).alias("text"))
    wanted = wanted.union(found.where("copied IS NOT NULL").select("copied", F.lit(0)))
    wanted = written(wanted.groupBy("short").agg(F.max("text").alias("text")))
    prefix = lambda c: F.shiftrightunsigned(c, 64 - PREFIX_BITS)
    prefixes = wanted.select(prefix("short").alias("prefix")).distinct()
    places = docs.select(
        F.col(id).cast("bigint").alias("doc_id"), F.xxhash64(text).alias("tie"), F.posexplode(_lines(docs, text)).alias("line_no", "line")
    )
    places = places.withColumn("short", F.xxhash64("line")).join(F.broadcast(prefixes), prefix("short") == F.col("prefix"), "left_semi")
    places = places.join(wanted, "short").where(F.col("line").rlike(WORD))
    places = written(places.select("doc_id", "tie", "line_no", "short", line_key(F.col("line")).alias("key"), F.when(F.col("text") == 1, F.col("line")).alias("line")))
    lines = written(places.where("line IS NOT NULL").groupBy("short", "key").agg(F.first("line").alias("line")))
    left = lines.select(F.col("short").alias("a"), F.col("key").alias("key_a"), F.col("line").alias("line_a"))
    right = lines.select(F.col("short").alias("b"), F.col("key").alias("key_b"), F.col("line").alias("line_b"))
    both = pairs.join(left, "a").join(right, "b").select("key_a", "line_a", "key_b", "line_b")
    alike = found.where("a IS NOT NULL").select("a", "b").union(both.mapInArrow(_verify, "a binary, b binary"))
    return alike, compared.select("band", "short"), lines, places.select("doc_id", "tie", "line_no", "key")


def _blocks(found: DataFrame, compared: DataFrame, lines: DataFrame, roots: DataFrame) -> DataFrame:
    """Blocks of the bands that hold several groups of ``roots``: ``band, i, j, chunk, root, key, line``."""
    group = lines.select("short", F.col("key").alias("node")).join(roots, "node").select("short", F.xxhash64("root").alias("root"))

    def grouped(rows):
        return rows.join(group, "short", "left").select("band", "short", F.coalesce("root", "short").alias("root"))

    # What is held back is in the group of a line that is not, so these tell which bands hold several groups.
    # Two lines have been compared already.
    seen = written(grouped(compared))
    mixed = seen.groupBy("band").agg(F.count("*").alias("n"), F.min("root").alias("low"), F.max("root").alias("high"))
    mixed = written(mixed.where("n > 2 AND low <> high").select("band"))
    held = found.where("held IS NOT NULL").select(F.explode("held").alias("band"), "short").join(mixed, "band", "left_semi")
    members = written(seen.join(mixed, "band", "left_semi").union(grouped(held.distinct())).distinct())
    sizes = members.groupBy("band", "root").agg(F.count("*").alias("n"))
    sizes = sizes.groupBy("band").agg(F.sum("n").alias("n"), F.max(F.struct("n", "root")).alias("most"))
    # The largest group's lines are in the last chunks and not compared with each other.
    chunks = lambda n: F.ceil(n / F.lit(BLOCK)).cast("int")
    sizes = sizes.select(
        "band", F.col("most.root").alias("main"), (F.col("n") <= BLOCK).alias("small"),
        chunks(F.col("n") - F.col("most.n")).alias("others"), chunks(F.col("most.n")).alias("mains"),
    )
    place = lambda n: F.pmod(F.xxhash64("short", "band"), n).cast("int")
    chunk = F.when(F.col("small"), 0).when(F.col("root") == F.col("main"), F.col("others") + place("mains")).otherwise(place("others"))
    dealt = members.join(sizes, "band").withColumn("chunk", chunk)
    is_main = ~F.col("small") & (F.col("root") == F.col("main"))
    others = F.sequence(F.lit(0), F.when(F.col("small"), 0).when(is_main, F.col("others") - 1).otherwise(F.col("others") + F.col("mains") - 1))
    dealt = dealt.select("band", "short", "root", "chunk", F.explode(others).alias("other"))
    dealt = dealt.select("band", F.least("chunk", "other").alias("i"), F.greatest("chunk", "other").alias("j"), "chunk", "root", "short")
    return dealt.join(lines, "short").select("band", "i", "j", "chunk", "root", "key", "line")


def _linked(docs: DataFrame, id: str, text: str) -> tuple[DataFrame, DataFrame]:
    """Alike pairs of different lines, ``a, b`` by their keys, that connect all that were found alike; and every place,
    ``doc_id, tie, line_no, key``, of the lines that can be in such a pair or are there more than once."""
    parts = 4 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sketched = docs.select(F.col(text)).mapInArrow(partial(_sketch, parts=parts), SKETCHED)
    found = written(sketched.repartition("part").sortWithinPartitions("part").mapInArrow(_candidates, FOUND))
    alike, compared, lines, places = _first_comparison(found, docs, id, text)
    stars = components(alike)
    blocks = _blocks(found, compared, lines, stars)
    blocks = blocks.repartition("band", "i", "j").sortWithinPartitions("band", "i", "j")
    links = stars.select(F.col("node").alias("a"), F.col("root").alias("b")).union(blocks.mapInArrow(_across, "a binary, b binary"))
    return links, places


def repeats(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """The lines that go, ``doc_id, tie`` (hash of the text) and ``line_no`` from 0: all of a component but its
    first in order of id (nulls last), hash and number."""
    links, places = _linked(docs, id, text)
    roots = components(links)
    joined = places.join(roots, places.key == roots.node, "left").select("doc_id", "tie", "line_no", F.coalesce("root", "key").alias("component"))
    joined = written(joined)
    place = F.struct(F.col("doc_id").isNull().alias("n"), "doc_id", "tie", "line_no")
    firsts = joined.groupBy("component").agg(F.min(place).alias("first"))
    return joined.join(firsts, "component").where(place != F.col("first")).select("doc_id", "tie", "line_no")


def _dropped(docs: DataFrame, id: str, text: str) -> DataFrame:
    """Per document with lines that go: ``doc_id, tie`` and their sorted numbers."""
    # A set, as rows that are alike in id and text are one document here. Bounded by the document.
    return repeats(docs, id, text).groupBy("doc_id", "tie").agg(F.sort_array(F.collect_set("line_no")).alias("dropped"))


def digest(docs: DataFrame) -> DataFrame:
    """``doc_id, n_lines, n_dropped, dropped`` of every row: lines with a word, how many of them go as an
    alike line comes earlier in the corpus, and their numbers from 0, comma-joined.

    Null and blank texts have no lines. Lines without a word are not counted and never go. Rows that
    repeat an id are told apart by their texts; rows alike in both are treated alike: what stays in
    one stays in all. An empty table gives no rows. Other columns are not read.
    """
    plain = docs.select("doc_id", "text")
    found = _dropped(plain, "doc_id", "text").alias("r")
    n_lines = F.size(F.filter(_lines(plain, "text"), lambda line: line.rlike(WORD))).cast("bigint")
    every = plain.select(F.col("doc_id").cast("bigint"), F.xxhash64("text").alias("tie"), n_lines.alias("n_lines")).alias("l")
    same = F.col("l.doc_id").eqNullSafe(F.col("r.doc_id")) & (F.col("l.tie") == F.col("r.tie"))
    none = F.array().cast("array<int>")
    numbers = F.coalesce("r.dropped", none)
    return every.join(found, same, "left").select(
        "l.doc_id", "n_lines", F.size(numbers).cast("bigint").alias("n_dropped"),
        F.array_join(numbers.cast("array<string>"), ",").alias("dropped"),
    )


def remove(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents without the lines that go; all columns, and documents without words, stay.

    A document all of whose lines go is left with an empty text or its blank lines.
    """
    found = _dropped(docs.select(F.col(id).alias(id), F.col(text).alias(text)), id, text)
    found = found.select(F.col("doc_id").alias("__id"), F.col("tie").alias("__tie"), F.col("dropped").alias("__dropped"))
    same = docs[id].cast("bigint").eqNullSafe(F.col("__id")) & (F.xxhash64(docs[text]) == F.col("__tie"))
    left = F.filter(F.split(docs[text], "\n"), lambda line, i: ~F.array_contains(F.col("__dropped"), i))
    new = F.when(F.col("__dropped").isNull(), docs[text]).otherwise(F.array_join(left, "\n"))
    return docs.join(found, same, "left").select(*[new.alias(c) if c == text else docs[c] for c in docs.columns])
