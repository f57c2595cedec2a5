"""Embedding near-duplicates: exact threshold pairs by dual traversal of a cover tree.

Unit vectors lie on a sphere, where a cosine is a distance. The upper levels are cells: the driver cuts a sample by nested
centres until a cell should hold ``TILE`` vectors, and each vector goes down to its nearest ones. The sample decides the cells only; all
vectors are in one. In a cell, a tile, the next level are nodes: balls whose vectors are all linked with each other, and single vectors.
Tiles farther apart than the threshold and both radii are left. The rest meet in tasks, a group of tiles with another, so that a tile is
copied once per group and not once per tile. There pairs of nodes are left in turn: a product in single precision
bounds the distance of many at once from below, along the directions that part them best and by what remains of each outside of them. Pairs
that are left over are decided in double precision: apart, linked whole, or vector by vector.

Vectors that are spread evenly over many dimensions leave no tiles to prune by: then all pairs of nodes are bounded,
and work grows with the square of the table.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import components, written

COSINE = 0.95
FAN = 16  # centres at most into which a cell is cut
TILE = 4096
SAMPLE = 64  # vectors of a tile that the driver sees to place the centres
SAMPLE_BYTES = 64 << 20  # of all vectors of a length there
ROUNDS = 16  # after which a cell that is still too large is dealt by hash
BALLS = (0.22, 0.15)  # radii of balls around a member: whether a ball of the first is all linked is looked up, of the second it is sure
GROUP_BYTES = 16 << 20  # of the vectors of a group of tiles
GROUPS = 4  # groups at least, if there are as many tiles
BLOCK = (256, 2048)  # pairs of nodes bounded at once
DENSE = 0.02  # of these, left open, from which all vectors of theirs are compared by one product
CROWD = 32  # pairs of vectors that a pair of nodes stands for, up to which that is so
SLACK = 1e-9  # of distances, for rounding; whatever it leaves open is decided on single vectors


def unit(vectors: np.ndarray) -> np.ndarray:
    """Rows of length one in double precision; scaled first, so no square leaves the range."""
    v = vectors.astype(np.float64)
    v = v / np.abs(v).max(axis=1, keepdims=True)
    return v / np.sqrt((v * v).sum(axis=1, keepdims=True))


def _matrix(column: pa.ChunkedArray, dim: int) -> np.ndarray:
    return column.combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)


class Cells:
    """Nested centres of the vectors of one length. A cell that its centres cannot part has several ``parts``."""

    def __init__(self, sample: np.ndarray, each: float, fan: int, tile: int, depth: int = 0):
        self.centres, self.below = None, []
        n = len(sample) * each  # vectors that the sample stands for
        self.parts = self.size = max(1, math.ceil(n / tile))
        k = min(fan, max(2, math.ceil(1.5 * n / tile)), len(sample))
        if self.parts == 1 or k < 2 or depth == ROUNDS:
            return
        centres = sample[:k]
        for _ in range(3):
            which = (sample @ centres.T).argmax(axis=1)
            held = np.unique(which)
            if len(held) == 1:
                return
            sums = np.stack([sample[which == c].sum(axis=0) for c in held])
            lengths = np.sqrt((sums * sums).sum(axis=1, keepdims=True))
            centres = np.where(lengths > 0, sums / np.maximum(lengths, SLACK), centres[held])
        which = (sample @ centres.T).argmax(axis=1)
        inside = [sample[which == c] for c in range(len(centres))]
        if max(map(len, inside)) == len(sample):
            return
        self.centres = centres.astype(np.float32)
        self.below = [Cells(some, each, fan, tile, depth + 1) for some in inside]
        self.size = sum(c.size for c in self.below)

    def deal(self, u: np.ndarray, ids: np.ndarray) -> np.ndarray:
        """The number of each vector's cell and part, from 0 on."""
        if self.centres is None:
            return ids.astype(np.uint64) % np.uint64(self.parts)
        out = np.empty(len(u), np.uint64)
        which = (u @ self.centres.T).argmax(axis=1)
        before = 0
        for c, cell in enumerate(self.below):
            rows = np.flatnonzero(which == c)
            if len(rows):
                out[rows] = cell.deal(u[rows], ids[rows]) + np.uint64(before)
            before += cell.size
        return out


def _covered(u: np.ndarray, rest: np.ndarray, r: float, block: int = 256) -> list[np.ndarray]:
    """Groups of ``rest``, each within ``r`` of its first: the first left is a centre, and takes all left within ``r``."""
    groups, limit = [], np.float32(1.0 - r * r / 2.0)
    left = u[rest]
    while len(rest):
        some = left[:block]
        near = some @ some.T >= limit
        np.fill_diagonal(near, True)
        free, centres = np.ones(len(some), bool), []
        for i in range(len(some)):
            if free[i]:
                centres.append(i)
                free &= ~near[i]
        near = left @ some[centres].T >= limit
        near[centres, np.arange(len(centres))] = True
        taken = near.any(axis=1)
        which = near[taken].argmax(axis=1)
        order = np.flatnonzero(taken)[np.argsort(which, kind="stable")]
        groups += np.split(rest[order], np.cumsum(np.bincount(which, minlength=len(centres)))[:-1])
        rest, left = rest[~taken], left[~taken]
    return groups


def nodes(u: np.ndarray, reach: float) -> list[np.ndarray]:
    """The rows of ``u`` as nodes: single ones first, then balls whose rows are all within ``reach`` of each other."""
    small = u.astype(np.float32)
    found = []
    for rows in _covered(small, np.arange(len(u)), BALLS[0]):
        if len(rows) > 1:
            gap = u[rows] - u[rows].mean(axis=0)
            if 2.0 * math.sqrt(np.einsum("ij,ij->i", gap, gap).max()) > reach - SLACK:
                found += _covered(small, rows, BALLS[1])
                continue
        found.append(rows)
    return sorted(found, key=lambda rows: len(rows) > 1)


class Tile:
    """Rows in the order of their nodes, of which ``low`` has the first rows, and a ball around all of them."""

    def __init__(self, u: np.ndarray, low: np.ndarray):
        self.u, self.low = u, low
        self.sizes = np.diff(np.append(low, len(u)))
        self.single = int((self.sizes == 1).sum())  # they come first
        self.balls = np.empty((0, u.shape[1]))
        self.radius = np.zeros(len(low))
        if self.single < len(low):
            first = int(low[self.single])
            sizes = self.sizes[self.single :]
            self.balls = np.add.reduceat(u[first:], low[self.single :] - first) / sizes[:, None]
            gap = u[first:] - np.repeat(self.balls, sizes, axis=0)
            self.radius[self.single :] = np.sqrt(np.maximum.reduceat(np.einsum("ij,ij->i", gap, gap), low[self.single :] - first))

    def ball(self) -> tuple[np.ndarray, float]:
        centre = self.u.mean(axis=0)
        gap = self.u - centre
        return centre, math.sqrt(np.einsum("ij,ij->i", gap, gap).max())

class Side:
    """Tiles as one table of rows and one of nodes. ``parts`` has the vectors of each tile, the first rows of its nodes, and its weights."""

    def __init__(self, parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]]):
        self.weight = np.concatenate([w for _, _, w in parts]).astype(np.float64)
        self.rows = np.cumsum([0] + [len(v) for v, _, _ in parts])
        self.nodes = np.cumsum([0] + [len(low) for _, low, _ in parts])
        many = [int((np.diff(np.append(low, len(v))) > 1).sum()) for v, low, _ in parts]
        # Single vectors are their own centres, those of balls lie behind the rows. The table is filled in place: tiles are views.
        balls = np.cumsum([self.rows[-1]] + many)
        self.x = np.empty((balls[-1], parts[0][0].shape[1]))
        self.tiles, at, ends = [], [], []
        for (v, low, _), first, b in zip(parts, self.rows, balls, strict=False):
            self.x[first : first + len(v)] = unit(v)
            tile = Tile(self.x[first : first + len(v)], low)
            self.x[b : b + len(tile.balls)] = tile.balls
            tile.balls = self.x[b : b + len(tile.balls)]
            self.tiles.append(tile)
            at += [low[: tile.single] + first, np.arange(b, b + len(tile.balls))]
            ends.append(tile.ball())
        self.at = np.concatenate(at)
        self.low = np.concatenate([t.low + first for t, first in zip(self.tiles, self.rows, strict=False)])
        self.sizes = np.concatenate([t.sizes for t in self.tiles])
        self.radius = np.concatenate([t.radius for t in self.tiles])
        self.node_weight = np.add.reduceat(self.weight, self.low)
        self.middle, self.wide = np.stack([c for c, _ in ends]), np.array([r for _, r in ends])
        self.row_count, self.node_count = np.zeros(self.rows[-1]), np.zeros(self.nodes[-1])

    def segment(self, tile: int, kind: int) -> slice:
        """The nodes of a tile: its single ones, or its balls."""
        first, cut = self.nodes[tile], self.nodes[tile] + self.tiles[tile].single
        return slice(first, cut) if not kind else slice(cut, self.nodes[tile + 1])

    def counts(self) -> np.ndarray:
        return self.row_count + np.repeat(self.node_count, self.sizes)


class Bound:
    """Bounds distances from below: those along a few directions, and the difference of what remains outside of them.

    They are bounded by one product in single precision. Any directions are right; the chosen ones are those along which a
    sample of nodes spreads most, as many as pay for comparing what they leave open.
    """

    def __init__(self, some: np.ndarray, far: float):
        dim = some.shape[1]
        self.middle, self.directions = np.zeros(dim), None
        fit, other = some[::2], some[1::2]
        if len(other) >= 64 and dim > 8:
            middle = fit.mean(axis=0)
            basis = np.linalg.svd(fit - middle, full_matrices=False)[2].T
            full = other - middle
            along, whole = full @ basis, (full * full).sum(axis=1)
            best, cost = None, 0.5 + dim / 75
            for m in (8, 12, 16, 20, 24, 28, 32, 40, 48, 64, 96, 128, 192, 256, 384, 512):
                if m >= min(dim, basis.shape[1]):
                    break
                p = along[:, :m]
                inside = (p * p).sum(axis=1)
                rest = np.sqrt(np.maximum(whole - inside, 0.0))
                gap = inside[:, None] + inside[None, :] - 2.0 * (p @ p.T) + (rest[:, None] - rest[None, :]) ** 2
                passed = max(0, int((gap <= far * far).sum()) - len(p)) / (len(p) * max(1, len(p) - 1))
                now = 0.5 + m / 75 + passed * (200 + 4 * dim)
                if now < cost:
                    best, cost = m, now
            if best:
                self.middle, self.directions = middle, basis[:, :best]
        k = dim + 2 if self.directions is None else self.directions.shape[1] + 3
        self.rounding = (k + 4) * 2.0**-20

    def of(self, x: np.ndarray, left: bool) -> np.ndarray:
        """Rows whose product with those of the other side is minus half of the square of the bound."""
        x = x - self.middle
        whole = np.einsum("ij,ij->i", x, x)
        if self.directions is not None:
            p = x @ self.directions
            x = np.column_stack([p, np.sqrt(np.maximum(whole - np.einsum("ij,ij->i", p, p), 0.0))])
        half, one = -0.5 * whole, np.ones(len(x))
        return np.column_stack([x, half, one] if left else [x, one, half]).astype(np.float32)


def _sampled(sides: list[Side], kinds: set[int], most: int = 2048) -> np.ndarray:
    """Centres of nodes of these kinds, evenly from all tiles."""
    found = []
    for side in sides:
        balls = side.sizes > 1
        at = side.at[balls] if kinds == {1} else side.at[~balls] if kinds == {0} else side.at
        found.append(side.x[at[:: max(1, len(at) * len(sides) // most)]])
    return np.concatenate(found)


def _near_nodes(a: Side, b: Side, reach: float, dense: Callable[[np.ndarray, slice, bool], None]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of nodes that the bounds leave open: each once, and none with itself.

    Blocks that leave open many go to ``dense``: nodes of a, a run of those of b, and whether only pairs with the first
    before the second count.
    """
    same = a is b
    gap = a.middle[:, None, :] - b.middle[None, :, :] if a.middle.size * len(b.middle) < 1 << 22 else None
    apart = np.sqrt((gap * gap).sum(axis=2)) if gap is not None else np.stack([np.sqrt(((m - b.middle) ** 2).sum(axis=1)) for m in a.middle])
    pairs = [(s, t) for s, t in zip(*np.nonzero(apart <= reach + a.wide[:, None] + b.wide[None, :] + SLACK), strict=True) if not same or s <= t]
    room = np.empty(BLOCK[0] * BLOCK[1], np.float32)
    for kind in ((0, 0), (0, 1), (1, 0), (1, 1)):
        parts = [(a.segment(s, kind[0]), b.segment(t, kind[1]), s, t) for s, t in pairs if not (same and s == t and kind == (1, 0))]
        parts = [p for p in parts if p[0].stop > p[0].start and p[1].stop > p[1].start]
        if not parts:
            continue
        widest = max(a.radius[x].max() for x, _, _, _ in parts) + max(b.radius[y].max() for _, y, _, _ in parts)
        bound = Bound(_sampled([a] if same else [a, b], set(kind)), reach + widest)
        left = {s: bound.of(a.x[a.at[x]], True) for s, x in {s: x for x, _, s, _ in parts}.items()}
        right = {t: np.ascontiguousarray(bound.of(b.x[b.at[y]], False).T) for t, y in {t: y for _, y, _, t in parts}.items()}
        for x, y, s, t in parts:
            far = reach + a.radius[x].max() + b.radius[y].max() + SLACK
            limit = np.float32(-0.5 * far * far - bound.rounding)
            rows, columns = left[s], right[t]
            inner = same and s == t and kind[0] == kind[1]
            for c in range(0, columns.shape[1], BLOCK[1]):
                some = np.ascontiguousarray(columns[:, c : c + BLOCK[1]])
                for r in range(0, len(rows), BLOCK[0]):
                    part = rows[r : r + BLOCK[0]]
                    product = np.matmul(part, some, out=room[: len(part) * some.shape[1]].reshape(len(part), -1))
                    hit = np.flatnonzero(product.max(axis=1) >= limit)
                    if not len(hit):
                        continue
                    left_open = product[hit] >= limit
                    if np.count_nonzero(left_open) > DENSE * product.size:
                        run = slice(y.start + c, y.start + c + some.shape[1])
                        # Nodes of many vectors are better met as such.
                        if a.sizes[hit + r + x.start].mean() * b.sizes[run].mean() <= CROWD:
                            dense(hit + r + x.start, run, inner)
                            continue
                    i, j = np.nonzero(left_open)
                    i, j = hit[i] + r, j + c
                    if inner:
                        i, j = i[i < j], j[i < j]
                    if len(i):
                        yield i + x.start, j + y.start


def _blocks(pairs: Iterator[tuple[np.ndarray, np.ndarray]], size: int = 1 << 16) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The same pairs, about ``size`` at a time."""
    held, n = [], 0
    for i, j in pairs:
        for start in range(0, len(i), size):
            held.append((i[start : start + size], j[start : start + size]))
            n += len(held[-1][0])
            if n >= size:
                yield tuple(np.concatenate(x) for x in zip(*held, strict=True))
                held, n = [], 0
    if held:
        yield tuple(np.concatenate(x) for x in zip(*held, strict=True))


def _rows(side: Side, nodes: np.ndarray) -> np.ndarray:
    """All rows of these nodes."""
    n = side.sizes[nodes]
    return np.repeat(side.low[nodes] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))


def _row_pairs(a: Side, b: Side, i: np.ndarray, j: np.ndarray, block: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """All pairs of a row of node i and one of node j, with the place of their pair of nodes; ``block`` or a little more at a time."""
    n = a.sizes[i] * b.sizes[j]
    ends = np.cumsum(n)
    first = 0
    while first < len(i):
        before = ends[first - 1] if first else 0
        last = max(first + 1, int(np.searchsorted(ends, before + block, side="right")))
        place = np.repeat(np.arange(first, last), n[first:last])
        k = np.arange(len(place)) - np.repeat(ends[first:last] - n[first:last] - before, n[first:last])
        width = b.sizes[j[place]]
        yield a.low[i[place]] + k // width, b.low[j[place]] + k % width, place
        first = last


def linked(a: Side, b: Side, cosine: float = COSINE, block: int = 1 << 16) -> np.ndarray:
    """Adds to the counts of both sides, or of one with itself (``a is b``), the weight that each row is linked with there.

    Returns a label for each node, first those of a: alike for nodes that are connected. The rows of a node are linked with each other.
    """
    same, reach = a is b, math.sqrt(2.0 - 2.0 * cosine)
    after = 0 if same else int(a.nodes[-1])
    label = np.arange(after + int(b.nodes[-1]))
    if same:
        own = np.repeat(a.node_weight, a.sizes) - a.weight
        a.row_count += np.where(np.repeat(a.sizes, a.sizes) > 1, own, 0.0)

    def join(i: np.ndarray, j: np.ndarray) -> None:
        # Labels are kept up with the pairs, so that those of a crowd need not be kept.
        x, y = label[i], label[j + after]
        new = x != y
        if new.any():
            ends, at = np.unique(np.concatenate([x[new], y[new]]), return_inverse=True)
            lowest = np.arange(len(label))
            lowest[ends] = ends[_lowest(len(ends), *np.split(at, 2))]
            label[:] = lowest[label]

    def count(side: Side, rows: np.ndarray, weight: np.ndarray, of: str) -> None:
        counts = getattr(side, of)
        counts += np.bincount(rows, weights=weight, minlength=len(counts))

    def dense(i: np.ndarray, nodes: slice, upper: bool) -> None:
        j = np.arange(nodes.start, nodes.stop)
        right, last = _rows(b, j), np.repeat(j, b.sizes[j])
        step = max(1, (1 << 20) * len(i) // (len(right) * int(a.sizes[i].sum())))
        for part in (i[n : n + step] for n in range(0, len(i), step)):
            left, first = _rows(a, part), np.repeat(part, a.sizes[part])
            yes = a.x[left] @ b.x[right].T >= cosine
            if upper:
                yes &= first[:, None] < last[None, :]
            ones = yes.astype(np.float64)
            a.row_count[left] += ones @ b.weight[right]
            b.row_count[right] += a.weight[left] @ ones
            rows, columns = np.nonzero(yes & (label[first][:, None] != label[last + after][None, :]))
            join(first[rows], last[columns])

    for i, j in _blocks(_near_nodes(a, b, reach, dense), block):
        x, y = a.x[a.at[i]], b.x[b.at[j]]
        single = (a.sizes[i] == 1) & (b.sizes[j] == 1)
        gap = x - y
        apart = np.sqrt(np.einsum("ij,ij->i", gap, gap))
        radii = a.radius[i] + b.radius[j]
        whole = np.where(single, np.einsum("ij,ij->i", x, y) >= cosine, apart + radii < reach - SLACK)
        mixed = ~single & ~whole & (apart <= reach + radii + SLACK)
        count(a, i[whole], b.node_weight[j[whole]], "node_count")
        count(b, j[whole], a.node_weight[i[whole]], "node_count")
        join(i[whole], j[whole])
        i, j = i[mixed], j[mixed]
        large = a.sizes[i] * b.sizes[j] > 4096
        found = np.zeros(int(large.sum()), bool)
        for k, (p, q) in enumerate(zip(i[large], j[large], strict=True)):
            rows, columns = slice(a.low[p], a.low[p] + a.sizes[p]), slice(b.low[q], b.low[q] + b.sizes[q])
            step = max(1, (1 << 21) // int(b.sizes[q]))
            for r in range(rows.start, rows.stop, step):
                some = slice(r, min(r + step, rows.stop))
                yes = a.x[some] @ b.x[columns].T >= cosine
                ones = yes.astype(np.float64)
                a.row_count[some] += ones @ b.weight[columns]
                b.row_count[columns] += a.weight[some] @ ones
                found[k] |= yes.any()
        join(i[large][found], j[large][found])
        i, j = i[~large], j[~large]
        for rows, columns, place in _row_pairs(a, b, i, j, block):
            yes = np.einsum("ij,ij->i", a.x[rows], b.x[columns]) >= cosine
            rows, columns, place = rows[yes], columns[yes], np.unique(place[yes])
            count(a, rows, b.weight[columns], "row_count")
            count(b, columns, a.weight[rows], "row_count")
            join(i[place], j[place])
    return label


def _lowest(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest row that each row is connected with."""
    label = np.arange(n)
    while True:
        before = label.copy()
        np.minimum.at(label, a, label[b])
        np.minimum.at(label, b, label[a])
        label = label[label]
        if (label == before).all():
            return label


def cut(rows: DataFrame, fan: int = FAN, tile: int = TILE) -> dict[int, Cells]:
    """The cells of each length that more than ``tile`` vectors have; ``rows`` has ``v``, repeated or not, and whether it is ``fine``."""
    dim = F.size("v")
    sizes = rows.groupBy(dim.alias("dim")).agg(F.count("*").alias("n")).where(f"n > {tile} AND dim > 0").collect()
    shares = {r.dim: min(1.0, SAMPLE / tile, SAMPLE_BYTES / (8 * r.dim * r.n)) for r in sizes}
    if not shares:
        return {}
    # By the hash of the vector, so that copies are seen together, and counted once.
    share = F.create_map(*[F.lit(x) for d, s in shares.items() for x in (d, int(s * (1 << 40)))])
    hashed = F.xxhash64("v", F.lit("centre"))
    sample = rows.where(F.pmod(hashed, F.lit(1 << 40)) < F.element_at(share, dim)).where("fine")
    sample = sample.select(dim.alias("dim"), hashed.alias("hash"), "v").dropDuplicates(["dim", "hash"]).orderBy("dim", "hash").toArrow()
    lengths = sample.column("dim").to_numpy()
    out = {}
    for d, s in shares.items():
        some = sample.filter(pa.array(lengths == d))
        if len(some):
            out[d] = Cells(unit(_matrix(some.column("v"), d)), 1.0 / s, fan, tile)
    return out


def dealt(vectors: DataFrame, cells: dict[int, Cells]) -> DataFrame:
    """The rows ``own, vec_id, v, copies`` with the number of their ``cell``; vectors of a length are numbered together."""
    kind = dict(vectors.dtypes)["v"]
    item = pa.float32() if "float" in kind else pa.float64()
    shape = pa.schema([("own", pa.int64()), ("vec_id", pa.int64()), ("v", pa.list_(item)), ("copies", pa.int64()), ("cell", pa.int64())])

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            table = pa.Table.from_batches([batch])
            dims, ids = table.column("dim").to_numpy(), table.column("own").to_numpy()
            number = dims.astype(np.int64) << 32
            for d in np.unique(dims):
                rows = np.flatnonzero(dims == d)
                if int(d) in cells:
                    u = unit(_matrix(table.column("v").take(pa.array(rows)), int(d))).astype(np.float32)
                    number[rows] += cells[int(d)].deal(u, ids[rows]).astype(np.int64)
            yield from table.drop_columns(["dim"]).append_column("cell", pa.array(number)).cast(shape).to_batches()

    return vectors.select("own", "vec_id", "v", "copies", F.size("v").alias("dim")).mapInArrow(
        deal, f"own bigint, vec_id bigint, v {kind}, copies bigint, cell bigint"
    )


def _tiles(vectors: DataFrame, reach: float) -> DataFrame:
    """A row for each cell, with its vectors as bytes in the order of its nodes."""
    width = np.dtype("<f4" if "float" in dict(vectors.dtypes)["v"] else "<f8")

    def build(table: pa.Table) -> pa.Table:
        table = table.sort_by("own")
        dim = table.column("cell")[0].as_py() >> 32
        v = _matrix(table.column("v"), dim).astype(width)
        u = unit(v)
        runs = nodes(u, reach)
        order, sizes = np.concatenate(runs), np.array([len(r) for r in runs])
        centre, radius = Tile(u[order], np.cumsum(sizes) - sizes).ball()
        held = {
            "ids": table.column("own").to_numpy()[order].astype("<i8"), "copies": table.column("copies").to_numpy()[order].astype("<i8"),
            "vectors": v[order], "low": (np.cumsum(sizes) - sizes).astype("<i4"), "centre": centre.astype("<f8"),
        }
        columns = {name: pa.array([x.tobytes()], pa.binary()) for name, x in held.items()}
        return pa.table({"cell": table.column("cell").slice(0, 1), "n": pa.array([len(u)]), "radius": pa.array([radius]), **columns})

    return vectors.select("cell", "own", "copies", "v").groupBy("cell").applyInArrow(
        build, "cell bigint, n bigint, radius double, ids binary, copies binary, vectors binary, low binary, centre binary"
    )


def _tasks(heads: pa.Table, width: int, reach: float) -> tuple[dict[int, int], dict[int, list[int]], int]:
    """Of each tile its group, and the tasks it takes part in; a task is a pair of groups. And how many tasks there are.

    ``heads`` has ``cell, n, radius, centre``. Tiles of one length go together, neighbours first.
    """
    group, tasks, numbers, first = {}, {}, {}, 0
    heads = heads.sort_by("cell")
    lengths = heads.column("cell").to_numpy() >> 32
    for dim in np.unique(lengths):
        some = heads.filter(pa.array(lengths == dim))
        cell, n, radius = (some.column(c).to_numpy() for c in ("cell", "n", "radius"))
        centre = np.frombuffer(b"".join(some.column("centre").to_pylist()), "<f8").reshape(-1, int(dim))
        count = min(len(cell), max(GROUPS, math.ceil(n.sum() * int(dim) * width / GROUP_BYTES)))
        place = np.minimum((np.cumsum(n) - n // 2 - 1) * count // n.sum(), count - 1)
        place = np.unique(place, return_inverse=True)[1]
        tiles = [np.flatnonzero(place == g) for g in range(place.max() + 1)]
        for g, left in enumerate(tiles):
            for h, right in enumerate(tiles[g:], g):
                near = np.zeros((len(left), len(right)), bool)
                for k, t in enumerate(left):
                    near[k] = np.sqrt(((centre[right] - centre[t]) ** 2).sum(axis=1)) <= reach + radius[right] + radius[t] + SLACK
                if near.any():
                    number = numbers.setdefault((first + g, first + h), len(numbers))
                    for t in {*left[near.any(axis=1)].tolist(), *right[near.any(axis=0)].tolist()}:
                        tasks.setdefault(int(cell[t]), []).append(number)
        group |= dict(zip(cell.tolist(), (place + first).tolist(), strict=True))
        first += len(tiles)
    return group, tasks, len(numbers)


def links(tiles: DataFrame, width: int) -> DataFrame:
    """``own, n, other`` per vector and task with links: how many vectors it is linked with
    there, copies counted, and the smallest vector it is connected with.
    """
    reach = math.sqrt(2.0 - 2.0 * COSINE)
    group, tasks, n = _tasks(tiles.select("cell", "n", "radius", "centre").toArrow(), width, reach)
    spark, shape = tiles.sparkSession, "own bigint, n bigint, other bigint"
    if not tasks:
        return spark.createDataFrame([], shape)
    number = np.dtype(f"<f{width}")

    def compare(table: pa.Table) -> pa.Table:
        cells, groups = table.column("cell").to_numpy(), table.column("group").to_numpy()
        sides: dict[int, list[int]] = {}
        for k in np.lexsort((cells, groups)).tolist():
            sides.setdefault(int(groups[k]), []).append(k)

        def held(k: int, name: str, kind: str | np.dtype) -> np.ndarray:
            return np.frombuffer(table.column(name)[k].as_buffer(), kind)

        both = [
            Side([(held(k, "vectors", number).reshape(-1, int(cells[k]) >> 32), held(k, "low", "<i4").astype(np.int64), held(k, "copies", "<i8")) for k in some])
            for some in sides.values()
        ]
        ids = np.concatenate([held(k, "ids", "<i8") for some in sides.values() for k in some])
        label = linked(both[0], both[-1])
        label = np.repeat(label, np.concatenate([s.sizes for s in both]))
        least = np.full(len(ids), np.iinfo(np.int64).max)
        np.minimum.at(least, label, ids)
        count = np.rint(np.concatenate([s.counts() for s in both])).astype(np.int64)
        hit = count > 0
        return pa.table({"own": ids[hit], "n": count[hit], "other": least[label][hit]})

    numbers = pa.array([group[c] for c in tasks], pa.int32())
    members = spark.createDataFrame(pa.table({"cell": list(tasks), "group": numbers, "tasks": pa.array(tasks.values(), pa.list_(pa.int32()))}))
    dealt_out = tiles.join(F.broadcast(members), "cell").select(
        F.explode("tasks").alias("task"), "cell", "group", "ids", "copies", "vectors", "low"
    )
    # By range: a hash would put several tasks into one partition and none into another.
    return dealt_out.repartitionByRange(n, "task").groupBy("task").applyInArrow(compare, shape)


def digest(embeddings: DataFrame, fan: int = FAN, tile: int = TILE) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` of every row of the embeddings.

    Vectors that are null, empty, zero or hold a null or a number that is not finite link with nothing,
    as do vectors of different lengths among each other. Equal vectors are linked. Rows that repeat
    an id are vectors of their own. A row with a null id is returned as its own component.
    """
    v = F.col("embedding")
    fine = F.coalesce(
        F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(v, lambda x: x != 0), F.lit(False)
    ) & F.col("vec_id").isNotNull()
    rows = embeddings.select(F.col("vec_id").cast("bigint"), F.col("embedding").alias("v"), fine.alias("fine"))
    distinct = rows.where("fine").groupBy("v").agg(F.min("vec_id").alias("vec_id"), F.count("*").alias("copies"))
    # Two vectors may have one id: inside, each is known by a number of its own.
    distinct = distinct.select(F.xxhash64("v").alias("own"), "vec_id", "v", "copies")
    distinct = written(dealt(distinct, cut(rows, fan, tile)))
    width = 4 if "float" in dict(distinct.dtypes)["v"] else 8
    found = written(links(written(_tiles(distinct, math.sqrt(2.0 - 2.0 * COSINE))), width))
    counts = found.groupBy("own").agg(F.sum("n").alias("n"))
    roots = components(found.select(F.col("own").alias("a"), F.col("other").alias("b")))
    known = (
        distinct.join(counts, "own", "left")
        .join(roots.withColumnRenamed("node", "own"), "own", "left")
        .select("own", F.xxhash64(F.lit("more"), "v").alias("more"), "vec_id", "copies", F.coalesce("n", F.lit(0)).alias("n"), F.coalesce("root", "own").alias("root"))
    )
    known = written(known)
    least = known.groupBy("root").agg(F.min("vec_id").alias("component"))
    known = known.join(least, "root").select("own", "more", "component", (F.col("n") + F.col("copies") - 1).alias("n_links"))
    # Equal vectors are as fine as each other, so a row with an id needs no other look at its values; it is known by 128 bits of them.
    hashed = [F.when(F.col("vec_id").isNotNull(), h).alias(name) for name, h in (("own", F.xxhash64("v")), ("more", F.xxhash64(F.lit("more"), "v")))]
    out = rows.select("vec_id", *hashed).join(known, ["own", "more"], "left")
    component = F.coalesce("component", "vec_id")
    return out.select(
        "vec_id", F.coalesce("n_links", F.lit(0).cast("bigint")).alias("n_links"), component.alias("component_id"),
        (F.col("vec_id").eqNullSafe(component)).alias("kept"),
    )
