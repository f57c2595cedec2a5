"""Decontamination, hard negatives and vector codes: brute force on small tables, odd rows, several blocks."""

import hashlib
import re

import numpy as np
import pytest

pytest.importorskip("millrace.llm")
from pyspark.sql import functions as F

from millrace.llm import ball_codes, decontamination, hard_negatives

DOCS = "doc_id bigint, text string"
ITEMS = "item_id string, text string"


def item_words(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)


def contaminated(docs, items, window=10):
    """By comparing every window with every place."""
    out = []
    for doc_id, text in docs:
        ws, hit, names = item_words(text), set(), set()
        for item, test in items:
            ts = item_words(test)
            k = min(window, len(ts))
            strings = {tuple(ts[i : i + k]) for i in range(len(ts) - k + 1)} if k else set()
            for i in range(len(ws) - k + 1):
                if tuple(ws[i : i + k]) in strings:
                    hit |= set(range(i, i + k))
                    if item is not None:
                        names.add(item)
        digest = hashlib.sha256(",".join(sorted(names)).encode()).hexdigest()
        out.append((doc_id, len(ws), len(hit), len(names), digest, bool(hit)))
    return sorted(out, key=repr)


def some_texts(rng):
    vocabulary = ["alpha", "Beta", "gamma", "d", "ÉTÉ", "été", "日本", "x1", "42", "the"]
    passage = [" ".join(rng.choice(vocabulary, n)) for n in (1, 2, 3, 9, 10, 11, 12, 30, 200)]
    items = [(f"i{n}", p) for n, p in enumerate(passage)] + [("i3", passage[7]), ("z", None), ("y", ""), ("w", " -- "), (None, passage[4]), ("i4", passage[4])]
    docs = []
    for i in range(60):
        parts = [" ".join(rng.choice([*vocabulary, "other", "words", "of", "its", "own"], rng.integers(0, 40)))]
        if i % 3 == 0:
            chosen = item_words(passage[int(rng.integers(0, 9))])
            parts += ["! ".join(chosen).upper() if i % 2 else "\n".join(chosen)]
        docs.append((i, " ".join(rng.permutation(parts))))
    docs += [(100, None), (101, ""), (102, "..."), (None, passage[6]), (7, docs[0][1]), (7, docs[0][1]), (103, "w " * 3000 + passage[8] + " v" * 2000)]
    return docs, items


@pytest.mark.parametrize("block_bytes", [1 << 20, 300])  # the small one makes several blocks
def test_windows_against_brute_force(spark, rows, block_bytes):
    docs, items = some_texts(np.random.default_rng(block_bytes))
    frame = spark.createDataFrame(docs, DOCS).withColumns({c: F.lit(1) for c in ("tie", "runs", "items", "item_id")})
    got = rows(decontamination.digest(frame, spark.createDataFrame(items, ITEMS), block_bytes))
    assert got == sorted(contaminated(docs, items), key=repr)


def test_long_items_in_segments_and_runs(spark, monkeypatch):
    monkeypatch.setattr(decontamination, "STRETCH", 7)
    rng = np.random.default_rng(1)
    item = [f"t{i}" for i in rng.integers(0, 50, 300)]
    cut = decontamination.segments(spark.createDataFrame([("a", " ".join(item))], ITEMS), "item_id", "text", most=20)
    windows = [tuple(w[i : i + 10]) for r in cut.orderBy("part").collect() for w in [r.words.decode().split()] for i in range(len(w) - 9)]
    assert windows == [tuple(item[i : i + 10]) for i in range(291)]
    docs = [(i, "lead " + " ".join(item[i : i + 9 + i % 4]) + " trail") for i in range(0, 290, 3)]
    found = decontamination.occurrences(spark.createDataFrame(docs, DOCS), spark.createDataFrame([("a", " ".join(item))], ITEMS))
    for row in found.collect():
        hit = 9 + row.doc_id % 4
        assert [tuple(r) for r in row.runs] == ([(1, 1 + hit)] if hit >= 10 else [])
    clean = decontamination.remove(spark.createDataFrame(docs, DOCS), spark.createDataFrame([("a", " ".join(item))], ITEMS))
    assert sorted(r.doc_id for r in clean.collect()) == [i for i, _ in docs if i % 4 == 0]


def test_words_that_share_a_key_are_compared(spark, rows, monkeypatch):
    """Every word, block and string with one hash: only the comparison of bytes tells them apart."""
    monkeypatch.setattr(decontamination, "_mixed", lambda h: h & np.uint64(0))
    docs, items = some_texts(np.random.default_rng(3))
    docs, items = docs[:8], items[:6]
    words = decontamination.Searcher([(i, " ".join(item_words(t)).encode() + b" ") for i, t in items], 10)
    for _, text in docs:
        n, found = words.search([(text or "").encode()])
        want = contaminated([(0, text)], items)[0]
        assert (int(n[0]), sum(int(b - a) for _, e, _ in found for a, b in e)) == want[1:3]


def test_nothing_to_find(spark):
    docs, items = spark.createDataFrame([(1, "some words"), (2, None)], DOCS), spark.createDataFrame([("a", "some words")], ITEMS)
    empty = hashlib.sha256(b"").hexdigest()
    got = {tuple(r) for r in decontamination.digest(docs, items.limit(0)).collect()}
    assert got == {(1, 2, 0, 0, empty, False), (2, 0, 0, 0, empty, False)}
    assert decontamination.digest(docs.limit(0), items).count() == 0
    assert [r.doc_id for r in decontamination.remove(docs, items).collect()] == [2]


VECTORS = "vec_id bigint, embedding array<float>, label int"


def some_vectors(rng, n=400, dim=32):
    centres = rng.normal(size=(10, dim))
    labels = rng.integers(0, 10, n)
    v = (centres[labels] * 0.6 + rng.normal(size=(n, dim)) * 0.5).astype(np.float32)
    v[1::50] = v[::50]  # ties
    return [(int(i), [float(x) for x in v[i]], int(labels[i])) for i in range(n)]


def bad_vectors(dim=32):
    nan, inf, one = float("nan"), float("inf"), [1.0] * (dim - 1)
    return [
        (700, None, 1), (800, [nan, *one], 1), (900, [inf, *one], 2), (1000, [None, *one], 2), (1100, one + [1.0], None), (None, one + [1.0], 3),
    ]


def hard_by_brute_force(rows):
    kept = {}
    for vec_id, v, label in rows:
        if vec_id is None or label is None or v is None or any(x is None or not np.isfinite(x) for x in v):
            continue
        whole = tuple(int(np.floor(256 * float(x))) for x in v)
        kept[(vec_id, (label + 1) % 10 if vec_id % 7 == 0 else label, tuple(v))] = whole
    out = []
    for key, a in kept.items():
        if key[0] % 100:
            continue
        scored = [(sum(x * y for x, y in zip(a, c, strict=True)), k) for k, c in kept.items() if k != key and len(c) == len(a)]
        same = sorted((-s, k[0]) for s, k in scored if k[1] == key[1])[:5]
        for minus, positive in same:
            p = -minus
            fits = sorted((-s, k[0]) for s, k in scored if k[1] != key[1] and 30 * p <= 100 * s <= 90 * p)[:10]
            out += [(key[0], positive, rank, k, p, -s) for rank, (s, k) in enumerate(fits, 1)]
    return sorted(out)


@pytest.mark.parametrize(("tree", "group_bytes"), [(512, 1 << 20), (3, 200)])  # the small ones make many trees and groups
def test_hard_negatives_against_brute_force(spark, rows, tree, group_bytes):
    table = some_vectors(np.random.default_rng(4)) + bad_vectors()
    table += [table[0], (100, [0.5] * 32, 3), (100, [0.5] * 16, 3), (2, [0.25] * 16, 3), (3, [0.125] * 16, 4), (200, [], 5)]
    df = spark.createDataFrame(table, VECTORS).withColumns({c: F.lit(1) for c in ("v", "score", "is_anchor", "tree")}).repartition(5)
    got = sorted(map(tuple, hard_negatives.digest(df, tree, group_bytes).collect()))
    want = hard_by_brute_force(table)
    assert len(want) > 100 and got == want
    assert hard_negatives.digest(df.limit(0)).count() == 0


def test_scores_that_need_whole_numbers(spark):
    rng = np.random.default_rng(8)
    table = [(i * 50, [float(x) * 2.0**22 for x in rng.normal(size=4)], i % 3) for i in range(40)]
    df = spark.createDataFrame(table, "vec_id bigint, embedding array<double>, label int")
    assert sorted(map(tuple, hard_negatives.digest(df).collect())) == hard_by_brute_force(table)
    ends = [(0, [1e200, 1.0], 1), (1, [1e200, 2.0], 1), (2, [1e200, 0.0], 2), (3, [1e-3, 0.0], 2)]
    assert hard_negatives.digest(spark.createDataFrame(ends, "vec_id bigint, embedding array<double>, label int")).count() == 0


def test_bounds_along_a_tree_leave_candidates_out(spark):
    rng = np.random.default_rng(6)
    centre = rng.normal(size=(3, 8)) * 200
    anchors = np.floor(np.concatenate([c + rng.normal(size=(20, 8)) * 3 for c in centre]))
    tree = hard_negatives.Tree.of("t", np.arange(60), np.zeros(60, np.int64), anchors)
    assert (tree.parent < np.arange(60)).all() and (tree.edge[tree.parent >= 0] < 60).mean() > 0.9
    run = hard_negatives.Run(np.arange(500), np.ones(500, np.int64), np.floor(rng.normal(size=(500, 8)) * 50))
    scored = []
    exact = run.vectors @ tree.vectors.T

    def sought(place):
        def use(near, s):
            scored.append(len(near))
            assert (s == exact[near, place]).all()
            assert set(np.flatnonzero(exact[:, place] >= 20_000)) <= set(near.tolist())

        return np.ones(500, bool), 20_000, np.inf, use

    tree.walk(run, sought)
    assert sum(scored) < 0.5 * 500 * 60


def codes_by_brute_force(rows, parts=16, entries=64, rounds=2):
    kept = [(i, label, [int(np.floor(256 * float(x))) for x in v]) for i, v, label in rows]
    width = len(kept[0][2]) // parts
    cut = [[v[k * width : (k + 1) * width] for k in range(parts)] for _, _, v in kept]
    first = sorted(range(len(kept)), key=lambda n: (kept[n][0] is None, kept[n][0] or 0, rows[n][1]))[:entries]
    books = [[cut[n][k] for n in first] for k in range(parts)]

    def assign():
        return [[min((sum((x - y) ** 2 for x, y in zip(v[k], e, strict=True)), i) for i, e in enumerate(books[k])) for k in range(parts)] for v in cut]

    for _ in range(rounds):
        best = assign()
        for k in range(parts):
            for i in range(len(books[k])):
                mine = [v[k] for v, b in zip(cut, best, strict=True) if b[k][1] == i]
                if mine:
                    books[k][i] = [sum(x) // len(mine) for x in zip(*mine, strict=True)]
    best = assign()
    error = [sum(d for d, _ in b) for b in best]
    by_label = {}
    for (_, label, _), e in zip(kept, error, strict=True):
        by_label[label] = by_label.get(label, 0) + e
    sha = ball_codes.books_sha256(books)
    return sorted(((i, "".join(f"{e:02x}" for _, e in b), x, by_label[label], sha) for (i, label, _), b, x in zip(kept, best, error, strict=True)), key=repr)


@pytest.mark.parametrize("n", [400, 40])  # fewer vectors than entries
def test_codes_against_brute_force(spark, rows, n):
    good = some_vectors(np.random.default_rng(n), n) + [(None, [0.5] * 32, None), (5, [0.25] * 32, None)]
    bad = [r for r in bad_vectors() if r[0] not in (None, 1100)] + [(2, [1.0] * 16, 3), (3, [], 3), (4, [1.0] * 31, 1)]
    df = spark.createDataFrame(good + bad, VECTORS).withColumns({c: F.lit(1) for c in ("v", "code", "error", "dim")}).repartition(5)
    assert rows(ball_codes.digest(df)) == codes_by_brute_force(good)
    assert ball_codes.digest(df.limit(0)).count() == 0


def test_codes_of_huge_components(spark, rows):
    rng = np.random.default_rng(12)
    table = [(i, [float(x) for x in (rng.normal(size=16) * 10.0 ** rng.integers(0, 12)).tolist()], i % 2) for i in range(90)]
    table += [(200, [1e30] * 16, 1), (201, [1e30] * 16, 1)]
    df = spark.createDataFrame(table, "vec_id bigint, embedding array<double>, label int")
    most = hard_negatives.MOST
    want = [(i, code, min(error, most), sha) for i, code, error, _, sha in codes_by_brute_force(table)]
    sums = {even: min(most, sum(e for i, _, e, _ in want if i % 2 == even)) for even in (0, 1)}
    assert rows(ball_codes.digest(df)) == sorted(((i, code, error, sums[i % 2], sha) for i, code, error, sha in want), key=repr)


def test_any_start_finds_the_nearest():
    rng = np.random.default_rng(9)
    for spread in (1, 8, 300):
        entries = np.floor(rng.normal(size=(64, 4)) * 100)
        entries[5] = entries[40]  # ties go to the lower
        x = np.floor(entries[rng.integers(0, 64, 3000)] + rng.normal(size=(3000, 4)) * spread)
        want, apart = ball_codes.nearest(x, entries)
        for start in (want, rng.integers(0, 64, 3000)):
            at, own = ball_codes.nearest_from(x, entries, start)
            assert (at == want).all() and (own == apart).all()


def test_codes_decode_to_their_error(spark):
    table = some_vectors(np.random.default_rng(2), 200)
    vectors = spark.createDataFrame(table, VECTORS).select("vec_id", "label", F.col("embedding").alias("v"))
    coded, books = ball_codes.train_and_encode(vectors)
    plain = {i: np.floor(256 * np.array(v, np.float64)) for i, v, _ in table}
    for r in coded.collect():
        assert ((plain[r.vec_id] - np.array(ball_codes.decoded(bytes(r.code), books))) ** 2).sum() == r.error
