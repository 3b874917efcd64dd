import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from ridgeline.llm import grulm, lattice
from ridgeline.llm.components import components

SPACED = re.compile(r"[^\x20\x09-\x0D]+")


def low(t):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")


def test_components(spark):
    rng = np.random.default_rng(3)
    edges = [(int(a), int(b)) for a, b in rng.integers(0, 300, (180, 2))] + [(1000, k) for k in range(1001, 1200)] + [(5, 5), (None, 3)] + [(k, k + 1) for k in range(2000, 2060)]
    root = {}

    def top(x):
        root.setdefault(x, x)
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        if a is not None and a != b:
            x, y = sorted((top(a), top(b)))
            root[y] = x
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {x: top(x) for x in root}
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_nearest_lattice_point():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(400, 8)) * 2
    p = lattice.nearest_point(x)
    around = p[:, None] + lattice.shortest()[None]
    assert (((x[:, None] - around) ** 2).sum(2).min(1) >= ((x - p) ** 2).sum(1) - 1e-9).all()
    assert len(np.unique(lattice.shortest(), axis=0)) == 240


def test_lattice_links(spark):
    rng = np.random.default_rng(1)
    base = rng.normal(size=(120, 16))
    rows = [(i, v.tolist()) for i, v in enumerate(base)]
    rows += [(1000 + i, (v + 0.05 * rng.normal(size=16)).tolist()) for i, v in enumerate(base[:60])]
    rows += [(2000 + k, (base[0] + 0.02 * rng.normal(size=16)).tolist()) for k in range(70)] + [(3000 + k, base[1].tolist()) for k in range(40)]
    rows += [(4000, None), (4001, [0.0] * 16), (4002, [1.0, None] + [0.0] * 14), (4003, [float("nan")] * 16), (4004, [float("inf")] + [1.0] * 15), (4005, []), (4006, [1.0, 0.0]), (4007, [2.0, 0.001]), (None, base[2].tolist())]
    rows += [(7, base[7].tolist())]  # a repeated row
    rows += [(5000 + k, (base[3] * s).tolist()) for k, s in enumerate((1e200, 1e-200, 1e300))]  # squares out of range
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("label", F.lit(1))
    got = {r.id: r for r in lattice.grouped(frame, tile=32).collect() if r.id is not None}
    valid = {i: np.array(v) / np.abs(v).max() for i, v in rows if i is not None and v and None not in v and np.isfinite(v).all() and np.abs(v).max() > 0}
    links = {i: {j for j in valid if j != i and len(valid[j]) == len(valid[i]) and valid[i] @ valid[j] / np.linalg.norm(valid[i]) / np.linalg.norm(valid[j]) >= 0.95} for i in valid}
    total = sum(map(len, links.values()))
    assert all(got[i].n_links <= len(links[i]) for i in valid) and sum(got[i].n_links for i in valid) >= 0.97 * total
    assert all(got[i].n_links == 0 and got[i].component == i and got[i].kept for i in (4000, 4001, 4002, 4003, 4004, 4005))
    assert all(got[5000 + k].component == 3 and got[5000 + k].n_links >= 3 for k in range(3))
    assert got[3039].component == 1 and got[3039].n_links >= 39 and not got[3039].kept
    assert lattice.grouped(frame.limit(0)).count() == 0


def test_lattice_recall_at_64_dimensions(spark):
    """Pairs planted at cosines from 0.95 up, each with a partner of its own."""
    rng = np.random.default_rng(11)
    base, side = rng.normal(size=(2, 600, 64))
    base /= np.linalg.norm(base, axis=1, keepdims=True)
    side -= (side * base).sum(1, keepdims=True) * base
    side /= np.linalg.norm(side, axis=1, keepdims=True)
    c = np.linspace(0.9505, 0.995, 600)[:, None]
    other = c * base + np.sqrt(1 - c * c) * side
    frame = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(np.concatenate([base, other]))], "vec_id long, embedding array<float>")
    got = {r.id: r for r in lattice.grouped(frame).collect()}
    assert sum(got[600 + k].component == k for k in range(600)) >= 590
    assert all(got[k].n_links <= 1 for k in range(1200))


def brute_base(rows):
    held = lambda i: zlib.crc32(("null" if i is None else str(i)).encode()) % 7 == 2
    count = Counter()
    for i, t in rows:
        if not held(i):
            count.update([*SPACED.findall(low(t)), "\n"])
    n, v = sum(count.values()), len(count)
    return held, count, n, v


def test_language_model(docs, rows):
    got = grulm.scored(docs, block_bytes=1 << 16)
    out = got.collect()
    held, count, n, v = brute_base(rows)
    want = []
    for i, t in rows:
        w = [*SPACED.findall(low(t)), "\n"]
        want.append((i if i is not None else -1, held(i), len(w), sum(count[x] > 0 for x in w), n, round(sum(np.log10((count[x] + 1) / (n + v + 1)) for x in w), 4)))
    assert Counter((r.doc_id if r.doc_id is not None else -1, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 4)) for r in out) == Counter(want)
    assert all(r.score < 0 for r in out)
    tested = [r for r in out if r.held_out and r.n_tokens > 20]
    assert tested and sum(r.score for r in tested) > 1.03 * sum(r.base_score for r in tested)


def test_model_is_a_distribution():
    """Over all words and the end, the classes' and words' probabilities add up to one."""
    rng = np.random.default_rng(2)
    stats = grulm.Stats(1000, 700, 10, rng.integers(0, 1 << 62, grulm.HEAD).astype(np.uint64), rng.integers(1, 50, grulm.HEAD), rng.integers(0, 30, grulm.TAIL), rng.integers(0, 9, grulm.TAIL))
    w = grulm.initial(stats)
    h = rng.normal(size=(1, grulm.HIDDEN)).astype(np.float32)
    p = [np.exp(grulm.output(w, h, np.array([t]))[0][0]) for t in range(grulm.END + 1)]
    assert abs(sum(p) - 1) < 1e-4


def test_gradients():
    rng = np.random.default_rng(4)
    stats = grulm.Stats(100, 60, 5, np.arange(grulm.HEAD, dtype=np.uint64), np.ones(grulm.HEAD), np.ones(grulm.TAIL), np.ones(grulm.TAIL))
    w = {k: x.astype(np.float64) for k, x in grulm.initial(stats).items()}
    rows, targets = rng.integers(0, grulm.END + 1, (5, 3)), rng.integers(0, grulm.END + 1, (5, 3))

    def loss(w):
        h, total = np.zeros((3, grulm.HIDDEN)), 0.0
        for x, y in zip(rows, targets, strict=True):
            h, _ = grulm.step(w, x, h * (x != grulm.END)[:, None])
            total -= grulm.output(w, h, y)[0].sum()
        return total

    t = grulm.Trainer({k: x.copy() for k, x in w.items()}, rate=0.0)
    grads = {}
    keep = grulm.output
    t.window(rows, targets, np.zeros((3, grulm.HIDDEN)))
    scale = {k: t.m[k] / 0.1 for k in w}  # the gradient, scaled alike in all weights
    ratios = []
    for k in ("u", "wc", "bc", "win", "ww"):
        flat = scale[k].ravel()
        j = int(np.abs(flat).argmax())
        moved = {n: x.copy() for n, x in w.items()}
        moved[k].ravel()[j] += 1e-5
        up = loss(moved)
        moved[k].ravel()[j] -= 2e-5
        ratios.append((up - loss(moved)) / 2e-5 / flat[j])
    assert np.allclose(ratios, ratios[0], rtol=1e-3), ratios
    assert grads == {} and keep is grulm.output


def test_state_carries_over_windows():
    """A text longer than a window scores as step by step."""
    rng = np.random.default_rng(6)
    stats = grulm.Stats(100, 60, 5, np.arange(grulm.HEAD, dtype=np.uint64), np.ones(grulm.HEAD), np.ones(grulm.TAIL), np.ones(grulm.TAIL))
    w = grulm.initial(stats)
    lengths = [100, 0, 7, 24, 55]
    rows = rng.integers(0, grulm.END, sum(lengths))
    first = np.concatenate([[0], np.cumsum(lengths)])
    got = grulm.likelihood(w, rows, first)
    for k, n in enumerate(lengths):
        h, x, total = np.zeros((1, grulm.HIDDEN), np.float32), grulm.END, 0.0
        for y in [*rows[first[k] : first[k] + n].tolist(), grulm.END]:
            h, _ = grulm.step(w, np.array([x]), h)
            total += grulm.output(w, h, np.array([y]))[0][0]
            x = y
        assert abs(total - got[k]) < 1e-2


def test_every_training_document_is_learned_from(docs, rows):
    """The rounds' shares together are all blocks, and a block's rows are all words of its training texts."""
    blocks = grulm.blocked(docs, "doc_id", "text", 1 << 12).withColumn("share", grulm.share_of(4))
    got = blocks.collect()
    assert len(got) > 4 and {r.share for r in got} <= {0, 1, 2, 3} and sum(r.n_texts for r in got) == len(rows)
    stats = grulm.Stats(0, 0, 0, np.zeros(0, np.uint64), np.zeros(0), np.zeros(grulm.TAIL), np.zeros(grulm.TAIL))
    held, _, n, _ = brute_base(rows)
    assert sum(len(grulm.training_rows(r.asDict(), stats)) - 1 for r in got) == n
    seen = []
    t = grulm.Trainer(grulm.initial(stats))
    t.window = lambda x, y, h, live=None: seen.append(x.size if live is None else int(live.sum())) or h
    for size in (1, 2, 23, 24, 25, 1000, 7001):
        seen.clear()
        t.texts(np.full(size + 1, grulm.END))
        assert sum(seen) == size


def test_many_short_texts_take_bounded_memory():
    """The outputs that are alive at a time don't grow with the number of texts."""
    import tracemalloc

    stats = grulm.Stats(100, 60, 5, np.arange(grulm.HEAD, dtype=np.uint64), np.ones(grulm.HEAD), np.ones(grulm.TAIL), np.ones(grulm.TAIL))
    w = grulm.initial(stats)
    peaks = []
    for n in (20_000, 80_000):
        rows = np.random.default_rng(1).integers(0, grulm.END, 3 * n).astype(np.int16)
        first = np.arange(n + 1) * 3
        tracemalloc.start()
        grulm.likelihood(w, rows, first)
        peaks.append(tracemalloc.get_traced_memory()[1] - 4 * 8 * n)
        tracemalloc.stop()
    assert peaks[1] < 1.5 * peaks[0] < 60 << 20


def test_rows_merge_in_steps_of_fixed_fan_in(spark, monkeypatch):
    monkeypatch.setattr(grulm, "FAN_IN", 3)

    def add(table):
        return pa.table({"n": pa.array([sum(table.column("n").to_pylist())], pa.int64())})

    frame = spark.range(40).selectExpr("id as n")
    assert grulm.merged(frame, 40, add, "n long", "sums").collect() == [(780,)]


def test_empty_corpus(empty):
    assert grulm.scored(empty).count() == 0
