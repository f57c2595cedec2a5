"""Packing documents into sequences of tokens: best-fit, improved by bin completion.

Documents become pieces: their tokens and an end token, cut where a document is longer than a
sequence. Pieces of one length are alike, so the packing is found on the counts per length, a table
of as many rows as a sequence has tokens however many pieces there are. Bin completion fills a
sequence around the largest piece left: undominated fillings in order of waste, searched depth first
with best-fit packings as the first incumbents and the waste that an improvement may have as bound.
The packing is a list of fillings with repeats; each piece looks up its place by its rank among
pieces of its length.
"""

from __future__ import annotations

import math
import re
import zlib
from array import array
from bisect import bisect_right
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.common import written
from millrace.llm.token_counts import _SPELLING, public_path

LENGTH = 2048
END = 0
REMEMBERED = 500_000  # words, and parts of words, that a worker keeps the tokens of; when there are more it starts anew
SLICE_BYTES = 4 << 20  # of texts whose words are looked up at a time
GATHERED = 1 << 18  # words whose tokens are put together at a time
NODES = 2_000  # search budget of bin completion; the best packing found so far always stands
SPARED = (0, 32, 64, 128, 192, 256, 320, 384, 448, 512)  # room that a filling may leave and still spare small pieces
STEPS = 20_000  # of the enumeration of one node's fillings
BUCKET_ROWS = 5_000  # pieces of one length that are numbered in one task, on average

_UNSURE = regex.compile("[\u0130\u0250-\U0010ffff]")  # what the two sides might lower or class differently
_PRE_TOKEN = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")


class Encoder:
    """Ids as the tokenizer's library gives them, from a memory of words parted by ASCII white space.

    The tokenizer drops white space and no token crosses it, so a text's ids are those of its words in
    turn. Words with special strings or characters from U+0250 on go to the library whole.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.special = re.compile("|".join(map(re.escape, special)) or r"(?!)").search
        self.tokenize = self.tokenizer.model.tokenize
        self._forget()

    def _forget(self) -> None:
        """The memory: word -> number, and of each number where its ids end in one growing buffer; piece -> its ids' place there."""
        self.codes: dict[bytes, int] = {}
        self.pieces: dict[str, int] = {}  # begin and number of ids, packed
        self.flat, self.offsets = array("I"), array("i", [0])

    def _put_ids(self, word: str) -> None:
        """Put the word's ids at the end of the buffer."""
        flat = self.flat
        if (not word.isascii() and _UNSURE.search(word)) or self.special(word):
            flat.extend(self.tokenizer.encode(word, add_special_tokens=False).ids)
            return
        for piece in _PRE_TOKEN.findall(word.lower()):
            known = self.pieces.get(piece)
            if known is not None:
                flat.extend(flat[known >> 16 : (known >> 16) + (known & 0xFFFF)])
                continue
            begin = len(flat)
            flat.extend([t.id for t in self.tokenize(piece.encode().decode("latin-1").translate(_SPELLING))])
            if len(flat) - begin < 1 << 16:
                self.pieces[piece] = begin << 16 | len(flat) - begin

    def _learn(self, word: bytes) -> int:
        code = self.codes[word] = len(self.codes)
        self._put_ids(word.decode())
        self.offsets.append(len(self.flat))
        return code

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of UTF-8 texts, one after another, and where each text's begin (and the last's end).

        The memory holds no more than ``REMEMBERED`` words and those of the texts given.
        """
        if len(self.codes) > REMEMBERED or len(self.pieces) > REMEMBERED:
            self._forget()
        words = pc.ascii_split_whitespace(texts)
        coded = words.flatten().dictionary_encode()
        get = self.codes.get
        distinct = [get(w) if w in self.codes else self._learn(w) for w in coded.dictionary.cast(pa.binary()).to_pylist()]
        at = np.array(distinct, np.int32)[coded.indices.to_numpy()] if len(coded) else np.empty(0, np.int32)
        # Views, not copies; they end with this call, before the buffers grow again.
        flat, offsets = np.frombuffer(self.flat, np.uint32) if self.flat else np.empty(0, np.uint32), np.frombuffer(self.offsets, np.int32)
        n = offsets[at + 1] - offsets[at]
        ends = np.concatenate([[0], np.cumsum(n, dtype=np.int64)])
        bounds = ends[words.offsets.to_numpy() - words.offsets[0].as_py()]
        ids = np.empty(int(ends[-1]), np.uint32)
        for low in range(0, len(at), GATHERED):
            some, count = offsets[at[low : low + GATHERED]], n[low : low + GATHERED]
            begin, end = ends[low], ends[min(low + GATHERED, len(at))]
            shift = some - (ends[low : low + len(some)] - begin)
            ids[begin:end] = flat[np.repeat(shift, count) + np.arange(end - begin)]
        return ids, bounds


def slices(column: pa.Array, most: int = SLICE_BYTES) -> Iterator[tuple[int, pa.Array]]:
    """A column of texts in runs of about ``most`` bytes, with the row each begins at; nulls are empty."""
    column = pc.fill_null(column, "" if pa.types.is_string(column.type) or pa.types.is_large_string(column.type) else b"")
    sizes = np.cumsum(pc.binary_length(column).to_numpy(zero_copy_only=False).astype(np.int64))
    start = 0
    while start < len(column):
        base = sizes[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(sizes, base + most, side="right")))
        yield start, column.slice(start, stop - start)
        start = stop


@cache
def _encoder(path: str) -> Encoder:
    return Encoder(path)


def pieces(docs: DataFrame, tokenizer: str = "word_bpe_49k.json", length: int = LENGTH, end: int = END, with_ids: bool = False, locate=public_path) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32`` (and ``ids``) of every piece of every row.

    A null text is empty: one piece that holds the end token alone.
    """
    shape = [("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64())]
    if with_ids:
        shape.append(("ids", pa.list_(pa.int32())))
    schema = pa.schema(shape)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(locate(tokenizer))
        for batch in batches:
            rows: list[list] = [[] for _ in shape]
            doc_ids = batch.column(0).to_pylist()
            for first, texts in slices(batch.column(1)):
                every, bounds = encoder.encode(texts)
                for i, (low, high) in enumerate(zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)):
                    ids = np.append(every[low:high], np.uint32(end)).astype("<u4", copy=False)
                    for piece, start in enumerate(range(0, len(ids), length)):
                        part = ids[start : start + length]
                        values = [doc_ids[first + i], piece, start, len(part), zlib.crc32(part), part]
                        for column, value in zip(rows, values, strict=False):
                            column.append(value)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(rows, shape, strict=True)], schema=schema)
            pa.default_memory_pool().release_unused()

    text = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint" + ", ids array<int>" * with_ids
    return docs.selectExpr("cast(doc_id as bigint)", "text").mapInArrow(cut, text)


# A filling is a tuple of (length, copies), largest first; a packing a list of (filling, times).


def lower_bound(counts: list[int], size: int) -> int:
    """Sequences that any packing needs: by total length, or by pieces that cannot share one."""
    total = sum(length * n for length, n in enumerate(counts))
    best = -(-total // size)
    for small in {*range(1, size // 2 + 1, max(1, size // 128))}:
        large = sum(counts[size - small + 1 :])
        middle = sum(counts[size // 2 + 1 : size - small + 1])
        room = middle * size - sum(x * counts[x] for x in range(size // 2 + 1, size - small + 1))
        rest = sum(x * counts[x] for x in range(small, size // 2 + 1))
        best = max(best, large + middle + max(0, -(-(rest - room) // size)))
    return best


def best_fit(counts: list[int], size: int) -> list[tuple[tuple, int]]:
    """Best-fit decreasing on counts: sequences with equal contents are handled together."""
    open_by_room: dict[int, dict[tuple, int]] = {}
    rooms: list[int] = []  # sorted

    def put(room: int, filling: tuple, times: int) -> None:
        if room not in open_by_room:
            open_by_room[room] = {}
            rooms.insert(bisect_right(rooms, room), room)
        open_by_room[room][filling] = open_by_room[room].get(filling, 0) + times

    for length in range(size, 0, -1):
        left = counts[length]
        while left:
            at = bisect_right(rooms, length - 1)
            if at == len(rooms):
                room, filling, there = size, (), left  # new sequences
            else:
                room = rooms[at]
                filling, there = next(iter(open_by_room[room].items()))
            each = min(room // length, left)
            times = min(there, left // each)
            if at < len(rooms):
                group = open_by_room[room]
                if times == there:
                    del group[filling]
                else:
                    group[filling] = there - times
                if not group:
                    del open_by_room[room]
                    rooms.remove(room)
            put(room - each * length, (*filling, (length, each)), times)
            left -= each * times
    return [(filling, times) for group in open_by_room.values() for filling, times in group.items()]


def _single(counts: np.ndarray, most: int) -> int:
    """The largest length up to ``most`` that is left, 0 if none."""
    there = np.flatnonzero(counts[: most + 1])
    return int(there[-1]) if len(there) else 0


def _dominates(one: tuple[int, ...], other: tuple[int, ...]) -> bool:
    """Whether the pieces of ``other`` can be laid side by side into places as long as the pieces of ``one``."""
    rooms = list(one)

    def lay(i: int) -> bool:
        if i == len(other):
            return True
        for k, room in enumerate(rooms):
            if room >= other[i] and room not in rooms[:k]:
                rooms[k] -= other[i]
                if lay(i + 1):
                    return True
                rooms[k] += other[i]
        return False

    return sum(one) >= sum(other) and (len(other) > 8 or lay(0)) and (len(other) <= 8 or one == other)


def _sums(there: list[int], room: int) -> int:
    """Sums up to ``room`` that pieces of these lengths can have, any number of each, as bits of a number."""
    mask, sums = (1 << (room + 1)) - 1, 1
    for x in there:
        step = x
        while step <= room:
            sums |= sums << step & mask
            step *= 2
    return sums


def fillings(counts: np.ndarray, room: int, waste: int, steps: int = STEPS) -> Iterator[tuple[tuple[int, ...], int]]:
    """All undominated fillings of a room, one after another, in order of waste: ``(lengths, waste)``.

    Of one sum those with large pieces come first. A filling that an earlier one dominates is left out; a
    single piece dominates all fillings that are no longer than it is. ``steps`` bounds the whole enumeration.
    """
    left = counts[: room + 1].copy()
    there = np.flatnonzero(left).tolist()[::-1]
    if not there:
        if room <= waste:
            yield (), room
        return
    sums = _sums(there, room)

    def exact(target: int, start: int) -> Iterator[tuple[int, ...]]:
        nonlocal steps
        for i in range(start, len(there)):
            x = there[i]
            if x > target or not left[x]:
                continue
            steps -= 1
            if steps < 0:
                return
            if x == target:
                yield (x,)
            elif target - x >= there[-1] and sums >> (target - x) & 1:
                left[x] -= 1
                for rest in exact(target - x, i):
                    yield (x, *rest)
                left[x] += 1

    earlier: list[tuple[int, ...]] = []
    for lost in range(min(room, waste) + 1):
        target = room - lost
        if target == 0:
            if not earlier:
                yield (), lost
            return
        if not sums >> target & 1:
            continue
        for found in exact(target, 0):
            if not any(_dominates(one, found) for one in earlier[-32:]):
                earlier.append(found)
                yield found, lost
                if len(found) == 1:
                    return


def _sparing(counts: np.ndarray, room: int, spared: int) -> tuple[int, ...] | None:
    """One or two pieces that fill a room but for ``spared``: they leave small pieces to fill others."""
    there = np.flatnonzero(counts[: room + 1])
    if not len(there):
        return None
    one = int(there[-1])
    if room - one <= spared:
        return (one,)
    # Each with the largest that fits beside it.
    beside = np.searchsorted(there, room - there, side="right") - 1
    sums = np.where(beside >= 0, there + there[beside], 0)
    alone = (beside >= 0) & (there[beside] == there) & (counts[there] < 2)
    lower = np.maximum(beside - 1, 0)
    sums = np.where(alone, np.where(beside > 0, there + there[lower], 0), sums)
    beside = np.where(alone, lower, beside)
    best = int(sums.argmax())
    if not sums[best] or room - sums[best] > spared:
        return None
    return tuple(sorted((int(there[best]), int(there[beside[best]])), reverse=True))


def _filling(pieces: tuple[int, ...]) -> tuple:
    return tuple((x, pieces.count(x)) for x in sorted(set(pieces), reverse=True))


def _times(left: np.ndarray, filling: tuple) -> int:
    return min(int(left[length]) // n for length, n in filling)


def dive(counts: np.ndarray, size: int, spared: int) -> list[tuple[tuple, int]]:
    """A packing by the first choice at each node: one or two pieces that spare small ones, else the least waste."""
    left, path = counts.copy(), []
    while largest := _single(left, size):
        left[largest] -= 1
        others = _sparing(left, size - largest, spared) if spared else None
        if others is None:
            others = next(fillings(left, size - largest, size), ((), 0))[0]
        left[largest] += 1
        filling = _filling((largest, *others))
        times = _times(left, filling)
        for length, n in filling:
            left[length] -= n * times
        path.append((filling, times))
    return path


def bin_completion(counts: list[int], size: int, nodes: int = NODES) -> list[tuple[tuple, int]]:
    """The packing with the fewest sequences that the search finds; never more than best-fit has.

    Incumbents are best-fit and a few dives; then all undominated fillings around the largest piece are searched
    depth first. A node is left when its waste is more than an improvement may have, or when what is left needs as many
    sequences as would make it no better. ``nodes`` bounds the search; without that bound it would be complete.
    """
    best = best_fit(counts, size)
    used, least = sum(times for _, times in best), lower_bound(counts, size)
    total = sum(length * n for length, n in enumerate(counts))
    start = np.array(counts, np.int64)
    for spared in SPARED if nodes else ():
        if used > least:
            path = dive(start, size, spared)
            if (n := sum(times for _, times in path)) < used:
                best, used = path, n

    def tries(left: np.ndarray, waste: int):
        """A node's children. Each filling is taken as often as can be, and after all of them once."""
        largest = _single(left, size)
        for once in (False, True):
            rest = left.copy()
            rest[largest] -= 1
            allowed = min((used - 1) * size - total - waste, size - largest)
            for others, lost in fillings(rest, size - largest, allowed):
                filling = _filling((largest, *others))
                times = _times(left, filling)
                if lost:
                    times = max(1, min(times, ((used - 1) * size - total - waste) // lost))
                if not once or times > 1:
                    yield filling, 1 if once else times, lost

    path: list[tuple[tuple, int]] = []
    stack: list = [(start, 0, 0, None)]  # counts left, waste and sequences so far, children not yet tried
    while stack and used > least and nodes > 0:
        left, waste, so_far, children = stack.pop()
        if children is None:
            nodes -= 1
            if not left.any():
                if so_far < used:
                    best, used = list(path), so_far
            elif waste <= (used - 1) * size - total and so_far + lower_bound(left.tolist(), size) < used:
                children = tries(left, waste)
        choice = next(children, None) if children else None
        if choice is None:
            if path:
                path.pop()
            continue
        stack.append((left, waste, so_far, children))
        filling, times, lost = choice
        after = left.copy()
        for length, n in filling:
            after[length] -= n * times
        path.append((filling, times))
        stack.append((after, waste + lost * times, so_far + times, None))
    return best


def places(packing: list[tuple[tuple, int]], size: int) -> dict[int, np.ndarray]:
    """By length, rows of (first rank, copies, first sequence, offset) in order of rank."""
    table: dict[int, list] = {}
    ranks: dict[int, int] = {}
    sequence = 0
    for filling, times in packing:
        offset = 0
        for length, copies in filling:
            rank = ranks.get(length, 0)
            table.setdefault(length, []).append((rank, copies, sequence, offset))
            ranks[length] = rank + copies * times
            offset += length * copies
        sequence += times
    return {length: np.array(rows, np.int64) for length, rows in table.items()}


def pack(cut: DataFrame, length: int = LENGTH) -> DataFrame:
    """Pieces with ``sequence_id`` and ``offset``: the columns of ``cut`` and these two.

    ``cut`` is read twice, so pass a written table. Identical pieces are interchangeable.
    """
    counts = [0] * (length + 1)
    for row in cut.groupBy("length").count().collect():  # at most ``length`` rows
        counts[row["length"]] = row["count"]
    table = places(bin_completion(counts, length), length)
    # Ranks among equals: within buckets, each bucket's first rank from the counts of those before.
    buckets = max(1, math.ceil(sum(counts) / BUCKET_ROWS))
    order = ("spread", "doc_id", "piece", "ids_crc32")
    spread = F.xxhash64("doc_id", "piece", "ids_crc32")
    dealt = cut.withColumns({"spread": spread, "bucket": F.pmod(spread, F.lit(buckets))})
    before = Window.partitionBy("length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    first = dealt.groupBy("length", "bucket").count().select("length", "bucket", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("first"))
    inside = Window.partitionBy("length", "bucket").orderBy(*order)
    ranked = dealt.withColumn("rank", F.row_number().over(inside) - 1).join(first, ["length", "bucket"])
    ranked = ranked.select(*cut.columns, (F.col("rank") + F.col("first")).alias("rank"))
    at_length, at_rank = cut.columns.index("length"), len(cut.columns)
    names = [*cut.columns, "sequence_id", "offset"]

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths, ranks = batch.column(at_length).to_numpy(), batch.column(at_rank).to_numpy()
            sequence, offset = np.empty(len(ranks), np.int64), np.empty(len(ranks), np.int64)
            for size in np.unique(lengths):
                mine = lengths == size
                rows = table[int(size)]
                rank = ranks[mine]
                hit = rows[np.searchsorted(rows[:, 0], rank, side="right") - 1]
                nth = rank - hit[:, 0]
                sequence[mine] = hit[:, 2] + nth // hit[:, 1]
                offset[mine] = hit[:, 3] + nth % hit[:, 1] * size
            yield pa.RecordBatch.from_arrays([*batch.columns[:at_rank], pa.array(sequence), pa.array(offset)], names=names)

    types = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in cut.schema.fields)
    return ranked.mapInArrow(place, f"{types}, sequence_id bigint, offset bigint")


def digest(docs: DataFrame) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32, sequence_id, offset`` of all documents.

    Rows that repeat an id are documents of their own. An empty table gives no rows. Other columns
    are not read.
    """
    return pack(written(pieces(docs)))
