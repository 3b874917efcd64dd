import random

import numpy as np
from pyspark.sql import functions as F

import corpus_pipeline as P
from ridgeline.llm import nearcopies
from ridgeline.llm.simhash import within
from tests.llm.conftest import SCHEMA, prose


def brute(rows):
    """The smallest id of each row's group, by all pairs."""

    def of(t):
        w = (t or "").lower().split()
        return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()

    sets = [of(t) for _, t in rows]
    root = list(range(len(rows)))

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if 5 * both >= 4 * (len(a) + len(sets[j]) - both):
                x, y = sorted((top(i), top(j)))
                root[y] = x
    least = {}
    for i, (k, _) in enumerate(rows):
        least[top(i)] = min(k, least.get(top(i), k))
    return {k: least[top(i)] for i, (k, _) in enumerate(rows)}


def changed(rng, text, n):
    """n words replaced: each takes up to five shingles."""
    w = text.split(" ")
    for i in rng.sample(range(len(w)), n):
        w[i] = f"new{rng.random()}"
    return " ".join(w)


def near_rows():
    rng = random.Random(9)
    rows = [(i, prose(rng, 150)) for i in range(40)]
    rows += [(100 + 10 * i + n, changed(rng, rows[i][1], n)) for i in range(30) for n in range(1, 6)]
    big = prose(rng, 150)
    rows += [(1000 + i, changed(rng, big, 1 + i % 5)) for i in range(60)]
    rows += [(2000, rows[0][1]), (2001, None), (2002, " "), (2003, "two words"), (2004, "TWO  words"), (2005, prose(rng, 5000))]
    rows.append((2006, rows[-1][1] + " and more"))
    return rows


def test_groups_are_brute_force(spark):
    rows = near_rows()
    want = brute(rows)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert sum(want[k] != k for k in want) > 100 and len({want[k] for k in range(1000, 1060)}) > 1
    for tile in (nearcopies.TILE, 7):
        assert {r.doc_id: r.component for r in nearcopies.grouped(docs, tile=tile).collect()} == want


def test_stage_keeps_one_of_each_group(spark):
    rows = near_rows()
    full = [(i, t, "en", "s", None if t is None else len(t), 0.1, "k", 1, 2, "b") for i, t in rows]
    got = P.drop_near_copies(spark, spark.createDataFrame(full, SCHEMA).repartition(3), "").collect()
    assert sorted(r.doc_id for r in got) == sorted(set(brute(rows).values()))


def test_a_shingle_is_the_same_anywhere():
    h = np.random.default_rng(1).integers(0, 1 << 64, 40, dtype=np.uint64)
    before = h.copy()
    whole = set(nearcopies.shingles(h).tolist())
    assert len(whole) == 36 and (h == before).all()
    assert set(nearcopies.shingles(h[3:21]).tolist()) < whole and len(nearcopies.shingles(h[3:21])) == 14


def test_empty(empty):
    assert nearcopies.grouped(empty).count() == 0


def test_bits_of_long_fingerprints():
    rng = np.random.default_rng(4)
    base = rng.integers(0, 1 << 64, (20, 2), dtype=np.uint64)
    fps = np.repeat(base, 15, axis=0)
    for _ in range(30):
        fps[np.arange(300), rng.integers(0, 2, 300)] ^= np.uint64(1) << rng.integers(0, 64, 300).astype(np.uint64)
    group = np.sort(rng.integers(0, 4, 300))
    away = np.bitwise_count(fps[:, None] ^ fps[None]).sum(2)
    for radius in (0, 1, 4, 31, 32, 52):
        got = {(i, int(j)) for i, others in within(fps, group, radius, chunk=500) for j in others}
        want = {(i, j) for i in range(300) for j in range(i + 1, 300) if group[i] == group[j] and away[i, j] <= radius}
        assert got == want


def test_pairs_at_the_least_similarity_are_within_the_radius():
    rng = np.random.default_rng(5)
    for n in (4, 8, 40, 400):
        for _ in range(300):
            x = rng.integers(0, 1 << 64, n + n // 4, dtype=np.uint64)
            a, b = nearcopies.fingerprint(x), nearcopies.fingerprint(x[:n])
            assert np.bitwise_count(a ^ b).sum() <= nearcopies.RADIUS


def test_sketches_of_near_pairs_are_near():
    rng = np.random.default_rng(6)
    far = []
    for n in (4, 8, 40, 400):
        for _ in range(200):
            x = rng.integers(0, 1 << 64, n + n // 4, dtype=np.uint64)
            a, b = (nearcopies.sketch(nearcopies.minima(s)) for s in (x, x[:n]))
            assert np.bitwise_count(a ^ b).sum() <= nearcopies.NEAR
        x = rng.integers(0, 1 << 64, 8 * n, dtype=np.uint64)
        a, b = (nearcopies.sketch(nearcopies.minima(s)) for s in (x[: 5 * n], x[3 * n :]))  # a quarter in common
        far.append(int(np.bitwise_count(a ^ b).sum()))
    assert min(far) > nearcopies.NEAR


def test_no_task_holds_what_bands_connect(spark, monkeypatch):
    """Texts of pairwise similarity 0.3 to 0.5, without near copies but a few, make no family that meets in one task."""
    rng = random.Random(12)
    common = [prose(rng, 12) + f" mark{k}" for k in range(40)]

    def text(i):
        alone = set(rng.sample(range(40), 8))
        return " ".join(prose(rng, 12) + f" own{i}x{k}" if k in alone else common[k] for k in range(40))

    rows = [(i, text(i)) for i in range(800)]
    rows += [(5000 + i, changed(rng, rows[i * 7][1], 2)) for i in range(40)]
    sets = [{tuple(w[k : k + 5]) for k in range(len(w) - 4)} for w in (t.split() for _, t in rows[:60])]
    alike = [len(a & b) / len(a | b) for k, a in enumerate(sets) for b in sets[:k]]
    assert max(alike) < 0.78 and 0.3 < sum(alike) / len(alike) < 0.6
    tile, seen = 16, []
    kept = nearcopies._found

    def watched(rows, sketches):
        seen.append((sketches, rows.groupBy("c", "at", "tile").agg(F.count_distinct("d").alias("n")).agg(F.max("n"), F.sum("n")).first()))
        return kept(rows, sketches)

    monkeypatch.setattr(nearcopies, "_found", watched)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = {r.doc_id: r.component for r in nearcopies.grouped(docs, tile=tile).collect()}
    assert got == brute(rows) and all(got[5000 + i] == i * 7 for i in range(40))
    assert max(n for _, (n, _) in seen if n) <= 4 * tile  # tiles are dealt by hash: about two of TILE
    assert all(total < 20 * len(rows) for sketches, (_, total) in seen if not sketches)
