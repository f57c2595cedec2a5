"""Hard-negative mining with bounds along a spanning tree of anchors.

An anchor's positives are the vectors of its label with the highest inner products; its hard negatives are
the highest of other labels within a window of each positive's score. Anchors are dealt into trees: a minimum spanning
tree over the anchors of a tree and the origin, by Euclidean distance. A candidate's score at a parent
plus or minus the edge's length times the candidate's norm bounds its score at the child, as
<child - parent, c> is at most |child - parent| |c|. At the origin all scores are 0. Only candidates whose bounds overlap
the scores sought are scored anew; the bounds of the others go on down the tree, wider by each edge.

Anchors are a query set against all rows: trees are dealt into groups of bounded size, each is broadcast, and
all candidates pass by it where they lie, without a shuffle. Each task keeps the best of its own, and
only those are shuffled.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.common import written

POSITIVES, NEGATIVES = 5, 10
LOW, HIGH = 30, 90  # a negative's score, in hundredths of its positive's
TREE = 512  # anchors of a tree, on average
GROUP_BYTES = 32 << 20  # of anchors that are broadcast at a time
RUN = 4096  # candidates that pass along a tree together
SCALE = 256.0
SLACK = 1e-9  # of bounds, for rounding
LEAST, MOST = -(1 << 63), (1 << 63) - 1


def finite(v: Column) -> Column:
    """No null, and all components finite, also after scaling."""
    most = np.finfo(np.float64).max / SCALE
    return F.coalesce(F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) <= most)), F.lit(False))


def whole(values: np.ndarray) -> np.ndarray:
    """``floor(256 x)`` in double precision, where each is an exact integer."""
    return np.floor(values.astype(np.float64) * SCALE)


def matrix(column: pa.Array, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), dim)


def scores(rows: np.ndarray, most: float, anchor: np.ndarray) -> np.ndarray:
    """Exact inner products of integer vectors as int64; ``most`` is the largest component of all rows.

    Products that leave a long's range are held at its ends.
    """
    if most * np.abs(anchor).max(initial=0.0) * max(1, len(anchor)) < 2.0**53:
        return (rows @ anchor).astype(np.int64)
    exact = [int(x) for x in anchor.tolist()]
    sums = (sum(int(x) * y for x, y in zip(row, exact, strict=True)) for row in rows.tolist())
    return np.array([min(max(s, LEAST), MOST) for s in sums], np.int64)


@dataclass
class Tree:
    """Anchors in an order in which parents come first, each one's deepest child last.

    ``parent`` is a place in that order, or -1 for the origin; ``edge`` the distance from it.
    """

    name: str
    ids: np.ndarray
    labels: np.ndarray
    vectors: np.ndarray
    parent: np.ndarray
    edge: np.ndarray

    @classmethod
    def of(cls, name: str, ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray) -> Tree:
        parent, edge = _spanning(vectors)
        children: list[list[int]] = [[] for _ in range(len(ids) + 1)]
        for child, above in enumerate(parent.tolist()):
            children[above].append(child)  # the origin's are last
        # Sizes from the leaves up, then the order from the origin down.
        down, todo = [], list(children[-1])
        while todo:
            down.append(todo.pop())
            todo += children[down[-1]]
        size = np.ones(len(ids), np.int64)
        for node in reversed(down):
            if parent[node] >= 0:
                size[parent[node]] += size[node]
        order, todo = [], sorted(children[-1], key=lambda n: -size[n])
        while todo:
            order.append(todo.pop())
            todo += sorted(children[order[-1]], key=lambda n: -size[n])
        place = np.empty(len(ids) + 1, np.int64)
        place[order], place[-1] = np.arange(len(ids)), -1
        at = np.array(order, np.int64)
        return cls(name, ids[at], labels[at], vectors[at], place[parent[at]], edge[at])

    def walk(self, run: Run, sought) -> None:
        """For each anchor: ``sought(place)`` gives candidates (a mask), a lowest and a highest score, and what to do
        with the places and scores of those that can lie between."""
        bounds: dict[int, tuple[np.ndarray, np.ndarray]] = {-1: (np.zeros(len(run.ids)), np.zeros(len(run.ids)))}
        left = np.bincount(self.parent + 1, minlength=len(self.ids) + 1)
        for place, (above, edge) in enumerate(zip(self.parent.tolist(), self.edge.tolist(), strict=True)):
            low, high = bounds[above]
            left[above + 1] -= 1
            if not left[above + 1]:
                del bounds[above]
            reach = edge * (1 + SLACK) * run.norms
            low, high = low - reach, high + reach
            wanted, least, most, use = sought(place)
            slack = 1.0 + SLACK * np.maximum(np.abs(low), np.abs(high))
            near = np.flatnonzero(wanted & (high + slack >= least) & (low - slack <= most))
            if len(near):
                rows = run.vectors if 2 * len(near) > len(run.ids) else run.vectors[near]
                exact = scores(rows, run.most, self.vectors[place])
                exact = exact[near] if len(exact) != len(near) else exact
                inside = (exact > LEAST) & (exact < MOST)  # a score that is held at an end bounds nothing
                low[near[inside]] = high[near[inside]] = exact[inside]
                use(near, exact)
            if left[place + 1]:
                bounds[place] = low, high


def _spanning(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each vector's parent in a minimum spanning tree with the origin, -1, and the distance from it."""
    # Scaled, so that no square leaves the range.
    unit = max(1.0, float(np.abs(vectors).max(initial=0.0)))
    v = vectors / unit
    distance = np.sqrt((v * v).sum(axis=1))
    parent, edge = np.full(len(v), -1, np.int64), np.zeros(len(v))
    out = np.ones(len(v), bool)
    for _ in range(len(v)):
        node = int(np.where(out, distance, np.inf).argmin())
        out[node], edge[node] = False, distance[node]
        apart = v - v[node]
        apart = np.sqrt((apart * apart).sum(axis=1))
        nearer = out & (apart < distance)
        parent[nearer], distance[nearer] = node, apart[nearer]
    return parent, edge * unit


@dataclass
class Run:
    """Candidates that pass along the trees together."""

    ids: np.ndarray
    labels: np.ndarray
    vectors: np.ndarray
    norms: np.ndarray = field(init=False)
    most: float = field(init=False)

    def __post_init__(self):
        self.most = float(np.abs(self.vectors).max(initial=0.0))
        unit = max(1.0, self.most)
        self.norms = np.sqrt(((self.vectors / unit) ** 2).sum(axis=1)) * unit


def runs(batch: pa.RecordBatch) -> Iterator[Run]:
    """Candidates ``vec_id, label, v`` of one dimension each, in runs."""
    ids, labels = batch.column(0).to_numpy(), batch.column(1).to_numpy()
    dims = np.diff(batch.column(2).offsets.to_numpy())
    for dim in np.unique(dims).tolist():
        mine = np.flatnonzero(dims == dim)
        for start in range(0, len(mine), RUN):
            part = mine[start : start + RUN]
            yield Run(ids[part], labels[part], whole(matrix(batch.column(2).take(pa.array(part)), dim)))


class Best:
    """The ``most`` highest scores so far, ties by smaller id."""

    __slots__ = ("most", "scores", "ids")

    def __init__(self, most: int):
        self.most, self.scores, self.ids = most, np.empty(0, np.int64), np.empty(0, np.int64)

    @property
    def least(self) -> float:
        """What a score must reach."""
        return float(self.scores[-1]) if len(self.scores) == self.most else -np.inf

    def add(self, found: np.ndarray, ids: np.ndarray) -> None:
        every, whose = np.concatenate([self.scores, found]), np.concatenate([self.ids, ids])
        if len(every) > 8 * self.most:  # only those that reach the last place are put in order
            some = every >= np.partition(every, len(every) - self.most)[-self.most]
            every, whose = every[some], whose[some]
        order = np.lexsort((whose, ~every))[: self.most]
        self.scores, self.ids = every[order], whose[order]


@dataclass
class Group:
    """Trees as workers get them, with the positives of each anchor: by tree and id's place, ``(rank, id, score)``."""

    trees: list[Tree]
    positives: dict[tuple[str, int], list[tuple[int, int, int]]] = field(default_factory=dict)


def _trees(anchors: DataFrame, size: int) -> DataFrame:
    """Trees of about ``size`` anchors, one row each: by dimension, and by label where there are many of one."""
    total = anchors.count()
    key = F.pmod(F.xxhash64("label"), F.lit(max(1, -(-total // size))))
    keyed = anchors.select("*", F.size("v").alias("dim"), key.alias("key"))
    sizes = keyed.groupBy("dim", "key").agg(F.ceil(F.count("*") / size).alias("parts"))
    dealt = keyed.join(sizes, ["dim", "key"]).withColumn("part", F.pmod(F.xxhash64("vec_id", "v"), F.col("parts")))

    def build(table: pa.Table) -> pa.Table:
        dim = table.column("dim")[0].as_py()
        table = table.combine_chunks().sort_by([("vec_id", "ascending"), ("label", "ascending")])
        v = whole(matrix(table.column("v").combine_chunks(), dim))
        made = Tree.of("", table.column("vec_id").to_numpy(), table.column("label").to_numpy(), v)
        arrays = [a.astype(kind).tobytes() for a, kind in zip((made.ids, made.labels, made.vectors, made.parent, made.edge), _KINDS, strict=True)]
        columns = {name: pa.array([value], pa.binary()) for name, value in zip(_PARTS, arrays, strict=True)}
        return pa.table({"tree": pa.array([uuid.uuid4().hex]), "dim": pa.array([dim], pa.int32()), **columns})

    dealt = dealt.select("dim", "key", "part", "vec_id", "label", "v")
    return dealt.groupBy("dim", "key", "part").applyInArrow(build, "tree string, dim int, " + ", ".join(f"{p} binary" for p in _PARTS))


_PARTS = ("ids", "labels", "vectors", "parent", "edge")
_KINDS = ("<i8", "<i8", "<f8", "<i8", "<f8")


def _collected(trees: DataFrame) -> list[Tree]:
    out = []
    for row in trees.orderBy("tree").collect():
        arrays = [np.frombuffer(row[p], k) for p, k in zip(_PARTS, _KINDS, strict=True)]
        arrays[2] = arrays[2].reshape(len(arrays[0]), row.dim)
        out.append(Tree(row.tree, *arrays))
    return out


def _best_positives(candidates: DataFrame, group: Group, most: int) -> DataFrame:
    """``tree, place, vec_id, score`` of the ``most`` best of each anchor's label, other than itself, in each task."""
    shared = candidates.sparkSession.sparkContext.broadcast(group)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees = shared.value.trees
        best = [[Best(most) for _ in tree.ids] for tree in trees]
        for batch in batches:
            for run in runs(batch):
                for tree, held in zip(trees, best, strict=True):
                    if tree.vectors.shape[1] != run.vectors.shape[1]:
                        continue

                    def sought(place, tree=tree, held=held, run=run):
                        mine = held[place]
                        wanted = run.labels == tree.labels[place]
                        for self_at in np.flatnonzero(wanted & (run.ids == tree.ids[place])).tolist():
                            if (run.vectors[self_at] == tree.vectors[place]).all():
                                wanted[self_at] = False  # the anchor itself
                                break
                        return wanted, mine.least, np.inf, lambda near, s: mine.add(s, run.ids[near])

                    tree.walk(run, sought)
        rows = [(tree.name, place, b) for tree, held in zip(trees, best, strict=True) for place, b in enumerate(held)]
        n = [len(b.ids) for *_, b in rows]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([x for (x, _, _), k in zip(rows, n, strict=True) for _ in range(k)], pa.string()),
                pa.array([x for (_, x, _), k in zip(rows, n, strict=True) for _ in range(k)], pa.int32()),
                pa.array(np.concatenate([b.ids for *_, b in rows] or [np.empty(0, np.int64)])),
                pa.array(np.concatenate([b.scores for *_, b in rows] or [np.empty(0, np.int64)])),
            ],
            names=["tree", "place", "vec_id", "score"],
        )

    return candidates.mapInArrow(scan, "tree string, place int, vec_id bigint, score bigint")


def window_of(positive: int, low: int = LOW, high: int = HIGH) -> tuple[int, int]:
    """The lowest and the highest whole score s with low * positive <= 100 * s <= high * positive."""
    return -((-low * positive) // 100), high * positive // 100


def _best_negatives(candidates: DataFrame, group: Group, most: int) -> DataFrame:
    """``tree, place, nth, vec_id, score``: for each anchor and positive the best of each task within its window."""
    shared = candidates.sparkSession.sparkContext.broadcast(group)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees, positives = shared.value.trees, shared.value.positives
        windows = {key: [(nth, *window_of(score), Best(most)) for nth, _, score in found] for key, found in positives.items()}
        for batch in batches:
            for run in runs(batch):
                for tree in trees:
                    if tree.vectors.shape[1] != run.vectors.shape[1]:
                        continue

                    def sought(place, tree=tree, run=run):
                        mine = windows.get((tree.name, place), [])
                        least = min((max(low, b.least) for _, low, _, b in mine), default=np.inf)
                        highest = max((high for _, _, high, _ in mine), default=-np.inf)

                        def use(near, s):
                            for _, low, high, b in mine:
                                fits = (s >= low) & (s <= high)
                                if b.scores.size == b.most:
                                    fits &= s >= b.scores[-1]
                                if fits.any():
                                    b.add(s[fits], run.ids[near[fits]])

                        return run.labels != tree.labels[place], least, highest, use

                    tree.walk(run, sought)
        rows = [(*key, nth, int(i), int(s)) for key, found in windows.items() for nth, _, _, b in found for i, s in zip(b.ids, b.scores, strict=True)]
        columns = list(zip(*rows, strict=True)) or [()] * 5
        types = (pa.string(), pa.int32(), pa.int32(), pa.int64(), pa.int64())
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=["tree", "place", "nth", "vec_id", "score"])

    return candidates.mapInArrow(scan, "tree string, place int, nth int, vec_id bigint, score bigint")


def _top(found: DataFrame, most: int, *key: str) -> DataFrame:
    """The ``most`` best rows of each key, numbered from 1. Each task has sent no more than that."""
    order = Window.partitionBy(*key).orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= most)


def mine(
    vectors: DataFrame, positives: int = POSITIVES, negatives: int = NEGATIVES, tree: int = TREE, group_bytes: int = GROUP_BYTES
) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score`` for every anchor, positive and negative.

    ``vectors`` has ``vec_id``, ``label`` (long), ``v`` (finite) and ``is_anchor``, and is read several times: pass a written
    table of different rows. Rows that share an id but not all else are rows of their own. Vectors of
    different lengths have no score.
    """
    candidates = vectors.select("vec_id", "label", "v")
    trees = written(_trees(vectors.where("is_anchor").select("vec_id", "label", "v"), tree))
    size = trees.agg(F.sum(F.length("vectors") + 4 * F.length("ids"))).first()[0] or 0
    groups = -(-2 * size // group_bytes) if size > group_bytes else 1  # dealt by hash, half full on average
    out = []
    for i in range(groups):
        group = Group(_collected(trees.where(F.pmod(F.xxhash64("tree"), F.lit(groups)) == i)))
        names = {(t.name, place): int(x) for t in group.trees for place, x in enumerate(t.ids)}
        best = _top(_best_positives(candidates, group, positives), positives, "tree", "place")
        for row in best.collect():  # at most ``positives`` of each anchor of the group
            group.positives.setdefault((row.tree, row.place), []).append((row["rank"], row.vec_id, row.score))
        known = [(t, p, nth, names[t, p], pid, score) for (t, p), found in group.positives.items() for nth, pid, score in found]
        about = vectors.sparkSession.createDataFrame(known, "tree string, place int, nth int, anchor_id bigint, positive_id bigint, positive_score bigint")
        best = _top(_best_negatives(candidates, group, negatives), negatives, "tree", "place", "nth")
        rows = best.join(about, ["tree", "place", "nth"]).select(
            "anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")
        )
        out.append(written(rows) if groups > 1 else rows)
    return reduce(DataFrame.union, out)


def digest(embeddings: DataFrame, tree: int = TREE, group_bytes: int = GROUP_BYTES) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score`` of ``embeddings``.

    Anchors are the ids divisible by 100; of ids divisible by 7 the label is moved on by one, modulo 10. Rows with a null id,
    label or vector, or a component that is null or not finite (256-fold), take no part. Rows that are alike in id, label and vector
    count once; anchors without positives, and positives without negatives, give no rows, as an empty table does.
    Scores beyond a long's range are held at its ends.
    """
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = embeddings.select(F.col("vec_id").cast("bigint"), label.cast("bigint").alias("label"), F.col("embedding").alias("v"))
    rows = rows.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & finite(F.col("v"))).distinct()
    return mine(written(rows.withColumn("is_anchor", F.col("vec_id") % 100 == 0)), tree=tree, group_bytes=group_bytes)
