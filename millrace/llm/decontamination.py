"""Benchmark decontamination: Wu-Manber search of all documents for windows of benchmark items.

Texts are sequences of words, and words are the search's symbols. Test strings are windows of ``WINDOW``
consecutive words of an item, or the whole item if it has fewer. For test strings of one length, a block
shift table says of every block of ``BLOCK`` words how far the search may go on at least: as far as the
block stands from the end of a test string, or past the block if none holds it. A cursor that meets a
block that ends a test string looks up the strings in a bucket by the hash of the suffix, here as long as the string,
and compares the bytes. Texts are cut into stretches whose cursors go on side by side in numpy.

Items may be many and long: they are cut into segments that overlap, dealt into blocks of at most about
``BLOCK_BYTES``, and all documents are searched for one block after another. Each is a broadcast of bounded size.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import written
from millrace.llm.packing import slices

WINDOW = 10  # words
BLOCK_BYTES = 8 << 20  # of items' words that workers search for at a time
SEGMENT = 4096  # windows of an item in one segment
STRETCH = 256  # window ends that one cursor walks
RUN_BYTES = 1 << 20  # of text whose words are hashed at a time

_SPACE = 32
_P = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xBF58476D1CE4E5B9)


def _table() -> np.ndarray:
    """Bytes of words in lower case, all others a space. Bytes from 0x80 on belong to words."""
    table = np.full(256, _SPACE, np.uint8)
    for low, high, shift in ((0x30, 0x3A, 0), (0x61, 0x7B, 0), (0x41, 0x5B, 0x20), (0x80, 0x100, 0)):
        table[low:high] = np.arange(low, high) + shift
    return table


_LOWER = _table()


def _mixed(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint64(31))
    h = h * _MIX
    return h ^ (h >> np.uint64(29))


@dataclass
class Words:
    """The words of some texts. ``plain`` has each followed by one space; word i is ``plain[starts[i]:ends[i]]``,
    ``hashes[i]`` is its hash, and text t has the words from ``first[t]`` up to ``first[t + 1]``."""

    plain: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    hashes: np.ndarray
    first: np.ndarray

    @classmethod
    def of(cls, texts: list[bytes]) -> Words:
        joined = b" ".join([*texts, b""])
        sizes = np.fromiter(map(len, texts), np.int64, len(texts)) + 1
        low = _LOWER[np.frombuffer(joined, np.uint8)]
        word = low != _SPACE
        after = np.zeros(len(word), bool)
        after[1:] = word[:-1]
        after &= ~word  # the byte that ends a word
        plain = low[word | after]
        ends = np.flatnonzero(plain == _SPACE)
        starts = np.concatenate([np.zeros(min(1, len(ends)), np.int64), ends[:-1] + 1])
        bounds = np.concatenate([[0], np.cumsum(sizes)])
        first = np.searchsorted(np.flatnonzero(after), bounds)
        return cls(plain, starts, ends, _hashes(plain, starts, ends), first)


def _hashes(plain: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Of each word: its bytes as digits of a number modulo 2^64, mixed."""
    out = np.empty(len(ends), np.uint64)
    low = 0
    while low < len(ends):
        base = starts[low]
        high = max(low + 1, int(np.searchsorted(ends, base + RUN_BYTES, side="right")))
        powers, inverse = _powers(int(ends[high - 1] - base) + 1)
        digits = plain[base : ends[high - 1]].astype(np.uint64) * powers[: ends[high - 1] - base]
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(digits, dtype=np.uint64)])
        a, b = starts[low:high] - base, ends[low:high] - base
        out[low:high] = _mixed((sums[b] - sums[a]) * inverse[a])
        low = high
    return out


_POWERS: list[tuple[np.ndarray, np.ndarray]] = []


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The powers of an odd number and of its inverse modulo 2^64, for ``n`` digits at least."""
    if not _POWERS or len(_POWERS[0][0]) < n:
        size = max(n, RUN_BYTES + 1)
        made = []
        for base in (int(_P), pow(int(_P), -1, 1 << 64)):
            factors = np.full(size, base, np.uint64)
            factors[0] = 1
            made.append(np.cumprod(factors, dtype=np.uint64))
        _POWERS[:] = [(made[0], made[1])]
    return _POWERS[0]


def _of_words(hashes: np.ndarray, last: np.ndarray, n: int) -> np.ndarray:
    """The hash of the ``n`` words that end with each of ``last``."""
    h = np.zeros(len(last), np.uint64)
    for back in range(n - 1, -1, -1):
        h = h * _P + hashes[last - back]
    return _mixed(h)


class Strings:
    """Test strings of one number of words: shift table, and buckets in order of their key."""

    def __init__(self, words: Words, last: np.ndarray, items: np.ndarray, size: int):
        self.size, self.block = size, 3 if size > 5 else min(size, 2)
        # The shift table: by the hash of a block, cut to so many bits that few blocks meet by chance.
        self.bits = max(10, int(np.ceil(np.log2(8 * (len(last) + 1)))))
        self.shift = np.full(1 << self.bits, size - self.block + 1, np.uint8)
        for back in range(size - self.block, -1, -1):  # nearer to the end wins, so it comes last
            self.shift[self._slot(words.hashes, last - back)] = back
        # Equal strings become one, with all their items. Strings of one key that differ stay apart.
        key = _of_words(words.hashes, last, size)
        text = [words.plain[words.starts[i - size + 1] : words.ends[i]].tobytes() for i in last.tolist()]
        order = sorted(range(len(text)), key=lambda i: (int(key[i]), text[i]))
        new = [n for n, i in enumerate(order) if not n or text[i] != text[order[n - 1]]]
        self.key = key[[order[n] for n in new]] if new else np.empty(0, np.uint64)
        self.text = [text[order[n]] for n in new]
        edges = [*new, len(order)]
        ordered = items[order] if len(order) else items
        self.items = [np.unique(ordered[a:b]) for a, b in zip(edges, edges[1:], strict=False)]

    def _slot(self, hashes: np.ndarray, last: np.ndarray) -> np.ndarray:
        return (_of_words(hashes, last, self.block) >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, words: Words) -> tuple[np.ndarray, np.ndarray]:
        """Last word and number of the string, of every occurrence."""
        n = np.diff(words.first) - self.size + 1
        texts = np.flatnonzero(n > 0)
        stretches = -(-n[texts] // STRETCH)
        nth = np.arange(int(stretches.sum())) - np.repeat(np.cumsum(stretches) - stretches, stretches)
        at = np.repeat(words.first[texts] + self.size - 1, stretches) + nth * STRETCH
        stop = np.minimum(at + STRETCH, np.repeat(words.first[texts + 1], stretches))
        met = []
        while len(at):
            step = self.shift[self._slot(words.hashes, at)]
            met.append(at[step == 0])
            at = at + np.maximum(step, 1)
            on = at < stop
            at, stop = at[on], stop[on]
        last = np.sort(np.concatenate(met)) if met else np.empty(0, np.int64)
        key = _of_words(words.hashes, last, self.size)
        low, high = np.searchsorted(self.key, key, side="left"), np.searchsorted(self.key, key, side="right")
        found_at, found = [], []
        for i in np.flatnonzero(low < high).tolist():
            end = int(last[i])
            text = words.plain[words.starts[end - self.size + 1] : words.ends[end]].tobytes()
            for number in range(int(low[i]), int(high[i])):
                if self.text[number] == text:
                    found_at.append(end)
                    found.append(number)
        return np.array(found_at, np.int64), np.array(found, np.int64)


class Searcher:
    """The test strings of a block of items. ``segments`` are rows of item, words, and whether it is a whole item."""

    def __init__(self, segments: list[tuple[str | None, bytes]], window: int):
        self.names = sorted({item for item, _ in segments if item is not None})
        rank = {name: i for i, name in enumerate(self.names)}
        words = Words.of([text for _, text in segments])
        n = np.diff(words.first)
        of = np.repeat(np.array([rank.get(item, -1) for item, _ in segments], np.int64), n)
        # The words that end a window: all from the window-th on, or the last of a short text.
        place = np.arange(len(of)) - np.repeat(words.first[:-1], n)
        size = np.repeat(np.minimum(n, window), n)
        ends = place + 1 >= size
        self.strings = [
            Strings(words, last := np.flatnonzero(ends & (size == k)), of[last], k) for k in np.unique(size).tolist()
        ]

    def search(self, texts: list[bytes]) -> tuple[np.ndarray, list[tuple[int, np.ndarray, np.ndarray]]]:
        """Words of each text, and of the texts with hits: the text's number, its runs of hit words
        (rows of begin and end), and the ranks of its items' names."""
        words = Words.of(texts)
        n = np.diff(words.first)
        change = np.zeros(len(words.ends) + 1, np.int32)
        held: dict[int, set[tuple[int, int]]] = {}
        for which, strings in enumerate(self.strings):
            last, number = strings.find(words)
            np.add.at(change, last - strings.size + 1, 1)
            np.add.at(change, last + 1, -1)
            for text, string in zip((np.searchsorted(words.first, last, side="right") - 1).tolist(), number.tolist(), strict=True):
                held.setdefault(text, set()).add((which, string))
        covered = np.cumsum(change) > 0
        out = []
        for text in sorted(held):
            part = covered[words.first[text] : words.first[text + 1]]
            edges = np.flatnonzero(np.diff(np.concatenate([[False], part, [False]])))
            ranks = np.unique(np.concatenate([self.strings[a].items[b] for a, b in held[text]]))
            out.append((text, edges.reshape(-1, 2), ranks[ranks >= 0]))
        return n, out


@dataclass
class Block:
    """Some segments of items, as workers get them."""

    segments: list[tuple[str | None, bytes]]
    window: int
    name: str = field(default_factory=lambda: uuid.uuid4().hex)


_BUILT: dict[str, Searcher] = {}


def _searcher(block: Block) -> Searcher:
    """A worker holds the tables of one block at a time."""
    if block.name not in _BUILT:
        _BUILT.clear()
        _BUILT[block.name] = Searcher(block.segments, block.window)
    return _BUILT[block.name]


def segments(items: DataFrame, id: str, text: str, window: int = WINDOW, most: int = SEGMENT) -> DataFrame:
    """``item, part, words`` of the items: runs of words, space-joined, that hold each window once.

    Items without words give no rows.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for item, value in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()).to_pylist(), strict=True):
                words = Words.of([value or b""])
                n = len(words.ends)
                for part, low in enumerate(range(0, max(n - window + 1, min(n, 1)), most)):
                    high = min(n, low + most + window - 1)
                    rows.append((item, part, words.plain[words.starts[low] : words.ends[high - 1]].tobytes()))
            columns = list(zip(*rows, strict=True)) or [(), (), ()]
            types = (pa.string(), pa.int32(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=["item", "part", "words"])

    return items.select(F.col(id).cast("string").alias("item"), F.col(text).alias("text")).mapInArrow(cut, "item string, part int, words binary")


def _search(docs: DataFrame, block: Block) -> DataFrame:
    """``doc_id, tie, n_words, runs, items`` of every row: see ``occurrences``. ``docs`` has ``doc_id, tie, text``."""
    shared = docs.sparkSession.sparkContext.broadcast(block)
    run = pa.struct([("lo", pa.int64()), ("hi", pa.int64())])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        searcher = _searcher(shared.value)
        for batch in batches:
            n_words, runs, items = [], [], []
            for _, texts in slices(batch.column(2), 2 << 20):
                n, found = searcher.search(texts.cast(pa.binary()).to_pylist())
                n_words.append(n)
                mine: list = [[] for _ in n]
                names: list = [[] for _ in n]
                for text, edges, ranks in found:
                    mine[text] = [{"lo": a, "hi": b} for a, b in edges.tolist()]
                    names[text] = [searcher.names[r] for r in ranks.tolist()]
                runs += mine
                items += names
            counts = pa.array(np.concatenate(n_words) if n_words else np.empty(0, np.int64), pa.int64())
            columns = [batch.column(0), batch.column(1), counts, pa.array(runs, pa.list_(run)), pa.array(items, pa.list_(pa.string()))]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "tie", "n_words", "runs", "items"])

    shape = "doc_id bigint, tie binary, n_words bigint, runs array<struct<lo: bigint, hi: bigint>>, items array<string>"
    return docs.mapInArrow(scan, shape)


def _joined(runs: Column) -> Column:
    """Runs that overlap or touch become one; ``runs`` are sorted."""

    def add(done: Column, run: Column) -> Column:
        last = F.element_at(done, -1)
        grown = F.struct(last["lo"].alias("lo"), F.greatest(last["hi"], run["hi"]).alias("hi"))
        goes_on = (F.size(done) > 0) & (F.try_element_at(done, F.lit(-1))["hi"] >= run["lo"])
        return F.when(goes_on, F.concat(F.slice(done, 1, F.size(done) - 1), F.array(grown))).otherwise(F.concat(done, F.array(run)))

    return F.aggregate(F.slice(runs, 2, F.greatest(F.size(runs) - 1, F.lit(0))), F.slice(runs, 1, 1), add)


def occurrences(
    docs: DataFrame, items: DataFrame, id: str = "doc_id", text: str = "text", item_id: str = "item_id",
    item_text: str = "text", window: int = WINDOW, block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """Where windows of the items occur, a row per row of the documents: ``doc_id, n_words, runs, items``.

    ``runs`` are the hit words, ranges ``lo`` up to ``hi`` counted from 0; ``items`` the ids of the items with windows there,
    different ones, sorted as strings. Null texts have no words. Rows that repeat an id are rows of
    their own. Items that share an id count as one; an item without an id hits words and has no entry in ``items``.
    """
    cut = written(segments(items, item_id, item_text, window))
    total = cut.agg(F.sum(F.length("words"))).first()[0] or 0
    # Dealt by hash, a block is half full on average.
    blocks = -(-2 * total // block_bytes) if total > block_bytes else min(total, 1)
    dealt = F.pmod(F.xxhash64("item", "part", "words"), F.lit(max(blocks, 1)))

    def block(i: int) -> Block:
        return Block([(r.item, bytes(r.words)) for r in cut.where(dealt == i).select("item", "words").distinct().collect()], window)

    plain = docs.select(F.col(id).cast("bigint").alias("doc_id"), F.lit(None).cast("binary").alias("tie"), F.col(text).alias("text"))
    if blocks < 2:
        return _search(plain, block(0) if blocks else Block([], window)).drop("tie")
    # Several blocks: only rows with hits are kept of each search. Rows alike in id and text are found alike.
    keyed = plain.withColumn("tie", F.unhex(F.md5(F.coalesce("text", F.lit("")))))
    found = [written(_search(keyed, block(i)).where(F.size("runs") > 0).distinct()) for i in range(blocks)]
    merged = reduce(DataFrame.union, found).groupBy("doc_id", "tie").agg(
        _joined(F.array_sort(F.flatten(F.collect_list("runs")))).alias("runs"),  # bounded by the document
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
    )
    counted = _search(keyed, Block([], window)).select("doc_id", "tie", "n_words")
    same = F.col("l.doc_id").eqNullSafe(F.col("r.doc_id")) & (F.col("l.tie") == F.col("r.tie"))
    return counted.alias("l").join(merged.alias("r"), same, "left").select(
        "l.doc_id", "l.n_words",
        F.coalesce("r.runs", F.array().cast("array<struct<lo:bigint,hi:bigint>>")).alias("runs"),
        F.coalesce("r.items", F.array().cast("array<string>")).alias("items"),
    )


def digest(docs: DataFrame, items: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``doc_id, n_words, n_hit, n_items, items_sha256, contaminated`` of every row of the documents.

    Without items or words nothing is hit. An empty table gives no rows. Other columns are not read.
    """
    found = occurrences(docs, items, block_bytes=block_bytes)
    hit = F.aggregate("runs", F.lit(0).cast("bigint"), lambda n, r: n + r["hi"] - r["lo"])
    return found.select(
        "doc_id", "n_words", hit.alias("n_hit"), F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.size("runs") > 0).alias("contaminated"),
    )


def remove(docs: DataFrame, items: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents without those that hold a window of an item. All columns, and rows without an id, are kept.

    Rows that share an id go together.
    """
    bad = occurrences(docs, items, id, text).where((F.size("runs") > 0) & F.col("doc_id").isNotNull()).select("doc_id").distinct()
    return docs.join(bad.withColumnRenamed("doc_id", "__id"), F.col(id).cast("bigint") == F.col("__id"), "left_anti")
