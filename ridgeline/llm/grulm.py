"""A gated recurrent language model in numpy, with a class-factored softmax.

A word's probability is that of its class given the state, times that of the word in its class. The HEAD most
frequent words stand in classes of CLASS words by rank, each with its own softmax over the state; all others
stand in TAIL classes by their last two bytes, within which they share by corpus counts, plus one, with one place
for unseen words. The end of a text is a class of its own. So probabilities add up to one over all words.

Counts are exact and cover the whole training corpus. Each task turns its texts into blocks once: codes into the
block's own distinct words (a hash of 64 bits and a count each). All later steps read blocks, no text. Tasks add up
their blocks' words before these go to buckets of words; buckets answer each block with the counts of its words, at
most SALT blocks a group. Counts set the class and word biases, so the untrained model is the class unigram model.

Weights are learned by truncated backpropagation over windows of WINDOW steps, the state carried from one window
to the next and set to zero where a text ends. A round trains on one share of the blocks, each task on its part, and
the tasks' weights are averaged; the rounds together take every training document once. Scoring runs over every
document whole, windows of steps at a time with the state carried on, so a text's score is its complete
log-likelihood. At most LANES texts are scored side by side, the longest ones together, so memory is bounded by
LANES times WINDOW whatever the texts' number and lengths.

Cases: null and empty texts are the end alone; with no training document all counts are zero and words of a class
are equally likely; rows may repeat and count each time; null ids hash as the text "null"; an empty table gives
an empty table.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StructField, StructType

from ridgeline.llm.shared import flat, on_workers, pa_type, schema_of, written
from ridgeline.llm.textgrid import LOWER, SPACED, Hasher, U, mix, words

HEAD, CLASS, TAIL, HIDDEN = 512, 32, 64, 32
WINDOW, STREAMS, LANES = 24, 256, 2048
#: Rows of outputs worked on at a time.
_ROWS = 1024
#: Blocks that a bucket of words answers in one group; numbers merged at a time.
SALT, FAN_IN = 1 << 16, 64
CLASSES = HEAD // CLASS + TAIL + 1
END_CLASS = CLASSES - 1
#: Input rows: head words, tail classes, the end.
END = HEAD + TAIL
#: Bytes of text in a block, and of those turned into words at a time.
BLOCK_BYTES, PIECE_BYTES = 6 << 20, 1 << 20


def held_out(doc_id: Column, remainder: int = 2, modulus: int = 7) -> Column:
    text = F.coalesce(doc_id.cast("string"), F.lit("null"))
    return F.pmod(F.crc32(F.encode(text, "UTF-8")), F.lit(modulus)) == remainder


def tail_class(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    last = data[ends - 1].astype(U)
    before = np.where(ends - starts > 1, data[np.maximum(ends - 2, 0)], 0).astype(U)
    return (mix(last * U(257) + before + U(1)) % U(TAIL)).astype(np.int64)


def tokens(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash, tail class) of all words, and each text's first word."""
    low = LOWER[data]
    starts, ends, first = words(low, off, SPACED)
    return Hasher(low).spans(starts, ends), tail_class(low, starts, ends), first


@dataclass
class Stats:
    """Corpus counts: n tokens and v distinct ones with ends; head words' hashes by rank; of tail classes tokens and types."""

    n: int
    v: int
    ends: int
    head: np.ndarray
    head_count: np.ndarray
    tail_n: np.ndarray
    tail_v: np.ndarray

    def __post_init__(self) -> None:
        self.by_hash = np.argsort(self.head)
        self.sorted = self.head[self.by_hash]

    def row(self, h: np.ndarray, tail: np.ndarray) -> np.ndarray:
        """Input row of each word."""
        if not len(self.sorted):
            return HEAD + tail
        at = np.minimum(np.searchsorted(self.sorted, h), len(self.sorted) - 1)
        return np.where(self.sorted[at] == h, self.by_hash[at], HEAD + tail)


def class_of(row: np.ndarray) -> np.ndarray:
    return np.where(row < HEAD, row // CLASS, row - HEAD + HEAD // CLASS)


SHAPES = {"win": (END + 1, 3 * HIDDEN), "u": (HIDDEN, 3 * HIDDEN), "wc": (HIDDEN, CLASSES), "bc": (CLASSES,), "ww": (HEAD // CLASS, HIDDEN, CLASS), "bw": (HEAD // CLASS, CLASS)}


def initial(stats: Stats, seed: int = 5) -> dict[str, np.ndarray]:
    rng = np.random.default_rng(seed)
    w = {k: (rng.normal(size=s) * (0.1 if k in ("win", "u") else 0.02)).astype(np.float32) for k, s in SHAPES.items()}
    head = np.zeros(HEAD)
    head[: len(stats.head_count)] = stats.head_count
    head = head.reshape(-1, CLASS)
    by_class = np.concatenate([head.sum(1), stats.tail_n + 1, [stats.ends]])  # a tail class has a place for the unseen
    w["bc"] = np.log(np.maximum(by_class, 0.5) / max(by_class.sum(), 1)).astype(np.float32)
    w["bw"] = np.log((head + 0.5) / (head + 0.5).sum(1, keepdims=True)).astype(np.float32)
    return w


def packed(w: dict[str, np.ndarray]) -> bytes:
    return b"".join(w[k].astype("<f4").tobytes() for k in SHAPES)


def unpacked(b: bytes) -> dict[str, np.ndarray]:
    a, out, at = np.frombuffer(b, "<f4"), {}, 0
    for k, s in SHAPES.items():
        n = int(np.prod(s))
        out[k] = a[at : at + n].reshape(s).copy()
        at += n
    return out


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


def step(w: dict, row: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, tuple]:
    """The state after reading a row; what backpropagation needs of it."""
    a, g = w["win"][row], h @ w["u"]
    gate = _sigmoid(a[:, : 2 * HIDDEN] + g[:, : 2 * HIDDEN])
    z, r, q = gate[:, :HIDDEN], gate[:, HIDDEN:], g[:, 2 * HIDDEN :]
    n = np.tanh(a[:, 2 * HIDDEN :] + r * q)
    return n + z * (h - n), (row, h, z, r, q, n)


def _by_gate(w: dict) -> tuple[np.ndarray, np.ndarray]:
    """win and u as (3, rows, HIDDEN), the two gates' halved: a sigmoid is a hyperbolic tangent of half its input."""
    win, u = (w[k].reshape(-1, 3, HIDDEN).transpose(1, 0, 2).copy() for k in ("win", "u"))
    win[:2] *= 0.5
    u[:2] *= 0.5
    return win, u


def _exponentials(x: np.ndarray, bound: float) -> tuple[np.ndarray, np.ndarray, np.ndarray | float]:
    """(exp(x - top) in x's place, its sums by row, top); top is zero where no number can grow too large."""
    top: np.ndarray | float = 0.0
    if bound > 60:
        top = x.max(1)
        x -= top[:, None]
    np.exp(x, out=x)
    return x, x @ np.ones(x.shape[1], x.dtype), top


def _bound(w: np.ndarray, b: np.ndarray) -> float:
    """The largest output, as states are within one of zero."""
    return float((np.abs(w).sum(-2) + np.abs(b)).max())


def output(w: dict, h: np.ndarray, target: np.ndarray, grads: dict | None = None, live: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray | None]:
    """Natural log of P(class) and, for head words, P(word | class); the gradient of h, weights' gradients added to grads.

    Rows that live (0 or 1) leaves out add nothing to the gradients."""
    c = class_of(target)
    out, dh = np.empty(len(h), h.dtype), None if grads is None else np.empty_like(h)
    bound, wc_t = _bound(w["wc"], w["bc"]), w["wc"].T.copy()
    for lo in range(0, len(h), _ROWS):  # what stays in the cache
        own, k = slice(lo, lo + _ROWS), c[lo : lo + _ROWS]
        x = h[own] @ w["wc"]
        x += w["bc"]
        at = np.arange(len(x))
        own_x = x[at, k]
        e, total, top = _exponentials(x, bound)
        out[own] = own_x - top - np.log(total)
        if grads is not None:
            alive = 1 if live is None else live[own]
            e *= (alive / total)[:, None].astype(e.dtype)
            e[at, k] -= alive
            grads["wc"] += h[own].T @ e
            grads["bc"] += np.ones(len(e), e.dtype) @ e
            np.matmul(e, wc_t, out=dh[own])
    inside = np.flatnonzero(target < HEAD)
    order = inside[np.argsort(c[inside].astype(np.uint8), kind="stable")]
    cut = np.searchsorted(c[order], np.arange(HEAD // CLASS + 1))
    states, inner = h[order], (target[order] % CLASS)
    back, share = np.empty_like(states) if grads is not None else None, np.empty(len(order), out.dtype)
    bounds = (np.abs(w["ww"]).sum(1) + np.abs(w["bw"])).max(1)
    for k in range(HEAD // CLASS):
        a, b = int(cut[k]), int(cut[k + 1])
        if a == b:
            continue
        y = states[a:b] @ w["ww"][k]
        y += w["bw"][k]
        at, j = np.arange(b - a), inner[a:b]
        own_y = y[at, j]
        e, total, top = _exponentials(y, bounds[k])
        share[a:b] = own_y - top - np.log(total)
        if grads is not None:
            alive = 1 if live is None else live[order[a:b]]
            e *= (alive / total)[:, None].astype(e.dtype)
            e[at, j] -= alive
            grads["ww"][k] += states[a:b].T @ e
            grads["bw"][k] += np.ones(len(e), e.dtype) @ e
            np.matmul(e, w["ww"][k].T, out=back[a:b])
    out[order] += share
    if grads is not None:
        dh[order] += back
    return out, dh


class Trainer:
    """Adam over truncated windows of parallel streams of text."""

    def __init__(self, w: dict, rate: float = 0.004):
        self.w, self.rate, self.t = w, rate, 0
        self.m, self.s = ({k: np.zeros_like(x) for k, x in w.items()} for _ in range(2))
        self.seen = 0
        self.loss = 0.0
        self.room: dict[str, np.ndarray] = {}

    def _room(self, name: str, *shape: int, kind=np.float32) -> np.ndarray:
        """An array that windows use again, so that its memory is touched once."""
        size = int(np.prod(shape))
        have = self.room.get(name)
        if have is None or have.size < size or have.dtype != kind:
            have = self.room[name] = np.empty(size, kind)
        return have[:size].reshape(shape)

    def window(self, rows: np.ndarray, targets: np.ndarray, h: np.ndarray, live: np.ndarray | None = None) -> np.ndarray:
        """Learns from rows and targets (steps, streams), from those that live marks if given; the state after them."""
        w, (steps, streams) = self.w, rows.shape
        keep = (rows != END)[:, :, None].astype(h.dtype)
        room = lambda name, *parts: self._room(name, *parts, steps, streams, HIDDEN, kind=h.dtype)
        win, u = _by_gate(w)
        into = np.take(win, rows, axis=1, out=room("into", 3), mode="clip")
        before, after, n, q, gate = room("before"), room("after"), room("n"), room("q"), room("gate", 2)
        g = self._room("g", 3, streams, HIDDEN, kind=h.dtype)
        for t in range(steps):
            np.multiply(h, keep[t], out=before[t])
            np.matmul(before[t], u, out=g)
            x = gate[:, t]
            np.add(into[:2, t], g[:2], out=x)
            np.tanh(x, out=x)
            x += 1
            x *= 0.5
            q[t] = g[2]
            y = n[t]
            np.multiply(x[1], g[2], out=y)
            y += into[2, t]
            np.tanh(y, out=y)
            h = after[t]
            np.subtract(before[t], y, out=h)
            h *= x[0]
            h += y
        g = {k: np.zeros_like(x) for k, x in w.items()}
        logp, dh_all = output(w, after.reshape(-1, HIDDEN), targets.ravel(), g, None if live is None else live.ravel().astype(h.dtype))
        dh_all = dh_all.reshape(steps, streams, HIDDEN)
        z, r = gate
        d, back, dh = into, room("back", 3), np.zeros_like(h)  # d takes the place of what was read
        u_t = w["u"].reshape(HIDDEN, 3, HIDDEN).transpose(1, 2, 0).copy()
        by, one = (self._room(k, streams, HIDDEN, kind=h.dtype) for k in ("by", "one"))
        for t in range(steps - 1, -1, -1):
            dh += dh_all[t]
            np.subtract(1, z[t], out=one)
            np.subtract(before[t], n[t], out=by)
            by *= z[t]
            by *= one
            np.multiply(dh, by, out=d[0, t])
            np.multiply(n[t], n[t], out=by)
            np.subtract(1, by, out=by)
            by *= one
            np.multiply(dh, by, out=d[2, t])
            np.subtract(1, r[t], out=by)
            by *= r[t]
            np.multiply(d[2, t], r[t], out=back[2, t])
            by *= q[t]
            np.multiply(d[2, t], by, out=d[1, t])
            dh *= z[t]
            dh += d[0, t] @ u_t[0]
            dh += d[1, t] @ u_t[1]
            dh += back[2, t] @ u_t[2]
            dh *= keep[t]
        states = before.reshape(-1, HIDDEN).T
        row = rows.ravel()
        order = np.argsort(row.astype(np.uint16), kind="stable")
        cut = np.flatnonzero(np.concatenate([[True], np.diff(row[order]) != 0]))
        for k, x in enumerate((d[0], d[1], back[2])):
            own = slice(k * HIDDEN, (k + 1) * HIDDEN)
            g["u"][:, own] = states @ x.reshape(-1, HIDDEN)
            g["win"][row[order[cut]], own] = np.add.reduceat(d[k].reshape(-1, HIDDEN)[order], cut)
        size = targets.size if live is None else int(live.sum())
        norm = np.sqrt(sum(float((x * x).sum()) for x in g.values())) / size
        scale = np.float32(min(1.0, 1.0 / max(norm, 1e-9)) / size)
        self.t += 1
        for k, x in g.items():
            x *= scale
            self.m[k] += 0.1 * (x - self.m[k])
            self.s[k] += 0.01 * (x * x - self.s[k])
            fix = np.float32(self.rate * np.sqrt(1 - 0.99**self.t) / (1 - 0.9**self.t))
            w[k] -= fix * self.m[k] / (np.sqrt(self.s[k]) + 1e-6)
        self.seen += size
        self.loss -= float((logp if live is None else logp * live.ravel()).sum())
        return h.copy()

    def texts(self, rows: np.ndarray) -> None:
        """Learns from joined texts, each END and its words, to the last of them; rows ends with END."""
        n = len(rows) - 1
        if n < 1:
            return
        streams = max(1, min(STREAMS, n // WINDOW))
        length = -(-n // streams)
        room = streams * length
        place = lambda a: np.concatenate([a, np.full(room - n, END, a.dtype)]).reshape(streams, length).T
        x, y, live = place(rows[:-1]), place(rows[1:]), (np.arange(room) < n).reshape(streams, length).T
        h = np.zeros((streams, HIDDEN), np.float32)
        for t in range(0, length, WINDOW):
            part = live[t : t + WINDOW]
            h = self.window(x[t : t + WINDOW], y[t : t + WINDOW], h, None if part.all() else part)


def _likelihoods(w: dict, rows: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Of texts in descending order of length, which counts the end."""
    n, most = len(length), int(length[0])
    longer = np.searchsorted(-length, -np.arange(most + 1), "left")  # texts of more than t steps
    win, u = _by_gate(w)
    total, h = np.zeros(n), np.zeros((n, HIDDEN), np.float32)
    x = np.full(n, END)
    states_room, targets_room = np.empty((n * min(WINDOW, most), HIDDEN), np.float32), np.empty(n * min(WINDOW, most), np.int64)
    a_room, g_room = np.empty(3 * n * HIDDEN, np.float32), np.empty(3 * n * HIDDEN, np.float32)
    for lo in range(0, most, WINDOW):  # the state carries over from window to window
        hi = min(lo + WINDOW, most)
        size = longer[lo:hi]
        edge = np.concatenate([[0], np.cumsum(size)])
        if lo:  # the last state is in the place that the next ones take
            h, x = h.copy(), x.copy()
        states, targets = states_room[: edge[-1]], targets_room[: edge[-1]]
        for k in range(hi - lo):
            active, goes_on = int(size[k]), int(longer[lo + k + 1])
            a, g = (m[: 3 * active * HIDDEN].reshape(3, active, HIDDEN) for m in (a_room, g_room))
            np.take(win, x[:active], axis=1, out=a, mode="clip")
            np.matmul(h[:active], u, out=g)
            gate, y = a[:2], g[2]
            gate += g[:2]
            np.tanh(gate, out=gate)
            gate += 1
            gate *= 0.5
            y *= gate[1]
            y += a[2]
            np.tanh(y, out=y)
            new = states[edge[k] : edge[k + 1]]
            np.subtract(h[:active], y, out=new)
            new *= gate[0]
            new += y
            h = new
            x = targets[edge[k] : edge[k + 1]]
            x[goes_on:] = END
            x[:goes_on] = rows[start[:goes_on] + (lo + k)]
        logp, _ = output(w, states, targets)
        for k in range(hi - lo):
            total[: size[k]] += logp[edge[k] : edge[k + 1]]
    return total


def likelihood(w: dict, rows: np.ndarray, first: np.ndarray, lanes: int = LANES) -> np.ndarray:
    """Sum over each text's words and end of the natural logs that output() gives; rows are the words, text by text."""
    n_words = np.diff(first)
    order = np.argsort(-n_words, kind="stable")
    out = np.zeros(len(order))
    for lo in range(0, len(order), lanes):
        own = order[lo : lo + lanes]
        out[own] = _likelihoods(w, rows, first[:-1][own], n_words[own] + 1)
    return out


def _blob(a: np.ndarray, kind: str) -> bytes:
    return np.ascontiguousarray(a.astype(kind)).tobytes()


class Words:
    """A block in the making: texts as codes into the block's distinct words."""

    def __init__(self):
        self.parts: list[tuple] = []
        self.bytes = 0

    def add(self, piece: pa.RecordBatch, text_col: str) -> None:
        data, off = flat(piece.column(text_col))
        h, tail, first = tokens(data, off)
        distinct, at, inv = np.unique(h, return_index=True, return_inverse=True)
        self.parts.append((distinct, tail[at].astype(np.uint8), inv.astype(np.int32), np.diff(first)))
        self.bytes += len(data)

    def joined(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(distinct, tail classes, codes, words of each text)."""
        every, tails, codes, n_words = zip(*self.parts, strict=True)
        distinct, at, inv = np.unique(np.concatenate(every), return_index=True, return_inverse=True)
        base = np.cumsum([0, *(len(x) for x in every[:-1])])
        codes = np.concatenate([inv[b + c] for b, c in zip(base, codes, strict=True)])
        return distinct, np.concatenate(tails)[at], codes, np.concatenate(n_words)


#: A block's row, but for the ids: its name, its texts' numbers of words and held-out flags, its words' codes, and of each distinct word hash, count in training texts and tail class.
_BLOCK = {"block": pa.int64(), "n_texts": pa.int64(), "words": pa.binary(), "held": pa.binary(), "codes": pa.binary(), "hash": pa.binary(), "n": pa.binary(), "tail": pa.binary(), "ends": pa.int64()}


def _codes(blob: bytes, distinct: int) -> np.ndarray:
    return np.frombuffer(blob, "<u2" if distinct <= 1 << 16 else "<u4")


def blocked(docs: DataFrame, id_col: str, text_col: str, block_bytes: int) -> DataFrame:
    """The table of blocks, each a row with the ids of its texts in `ids`; one scan of the texts."""
    id_type = pa_type(docs, id_col)

    def run(batches):
        from pyspark import TaskContext

        from ridgeline.llm.shared import pieces

        name = TaskContext.get().partitionId() << 32
        now, ids, held = Words(), [], []

        def row() -> pa.RecordBatch:
            distinct, tail, codes, n_words = now.joined()
            flags = np.concatenate(held)
            learned = np.repeat(~flags, n_words)
            count = np.bincount(codes[learned], minlength=len(distinct)) if len(distinct) else np.zeros(0)
            values = (name, len(n_words), _blob(n_words, "<i4"), _blob(flags, "u1"), _blob(codes, "<u2" if len(distinct) <= 1 << 16 else "<u4"), _blob(distinct, "<u8"), _blob(count, "<i8"), _blob(tail, "u1"), int((~flags).sum()))
            of_ids = pa.chunked_array(ids, id_type).combine_chunks()
            lists = pa.ListArray.from_arrays(pa.array([0, len(of_ids)], pa.int32()), of_ids)
            return pa.RecordBatch.from_pydict({"ids": lists} | {c: pa.array([v], t) for (c, t), v in zip(_BLOCK.items(), values, strict=True)})

        for piece in pieces(batches, text_col, min(PIECE_BYTES, block_bytes)):
            now.add(piece, text_col)
            ids.append(piece.column(id_col))
            held.append(np.array(piece.column("_held"), bool))
            if now.bytes >= block_bytes:
                yield row()
                name, now, ids, held = name + 1, Words(), [], []
        if now.parts:
            yield row()

    source = docs.select(F.col(f"`{id_col}`"), F.col(f"`{text_col}`"), held_out(F.col(f"`{id_col}`")).alias("_held"))
    sql = {pa.int64(): "long", pa.binary(): "binary"}
    schema = StructType([StructField("ids", ArrayType(docs.schema[id_col].dataType))] + StructType.fromDDL(", ".join(f"{c} {sql[t]}" for c, t in _BLOCK.items())).fields)
    return source.mapInArrow(run, schema)


def _by_bucket(hashes: np.ndarray, buckets: int) -> list[tuple[int, int, int]]:
    """(bucket, from, to) of sorted hashes."""
    edge = np.searchsorted(((hashes >> U(32)) * U(buckets) >> U(32)).astype(np.int64), np.arange(buckets + 1))
    used = np.flatnonzero(np.diff(edge))
    return [(int(k), int(edge[k]), int(edge[k + 1])) for k in used]


def _summed(h: list[np.ndarray], n: list[np.ndarray], tail: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    hashes, at, inv = np.unique(np.concatenate(h), return_index=True, return_inverse=True)
    total = np.zeros(len(hashes), np.int64)
    np.add.at(total, inv, np.concatenate(n))
    return hashes, total, np.concatenate(tail)[at]


def counted(blocks: DataFrame, buckets: int) -> DataFrame:
    """(bucket, hash, n, tail): the words of training texts and their counts, a row a bucket."""

    def partial(batches):
        held: list[tuple] = []

        def rows() -> pa.RecordBatch:
            h, n, tail = _summed(*zip(*held, strict=True))
            cut = _by_bucket(h, buckets)
            return pa.RecordBatch.from_pydict({"bucket": pa.array([k for k, _, _ in cut], pa.int64())} | {c: pa.array([_blob(x[a:b], t) for _, a, b in cut], pa.binary()) for c, x, t in (("hash", h, "<u8"), ("n", n, "<i8"), ("tail", tail, "u1"))})

        size = 0
        for batch in batches:
            for r in batch.to_pylist():
                n = np.frombuffer(r["n"], "<i8")
                known = n > 0
                held.append((np.frombuffer(r["hash"], "<u8")[known], n[known], np.frombuffer(r["tail"], "u1")[known]))
                size += int(known.sum())
                if size > 1 << 21:
                    held = [_summed(*zip(*held, strict=True))]
                    size = len(held[0][0])
                    if size > 1 << 20:
                        yield rows()
                        held, size = [], 0
        if size:
            yield rows()

    def total(table: pa.Table) -> pa.Table:
        get = lambda c, kind: [np.frombuffer(b, kind) for b in table.column(c).to_pylist()]
        h, n, tail = _summed(get("hash", "<u8"), get("n", "<i8"), get("tail", "u1"))
        return pa.table({"bucket": table.column("bucket")[:1], "hash": pa.array([_blob(h, "<u8")], pa.binary()), "n": pa.array([_blob(n, "<i8")], pa.binary()), "tail": pa.array([_blob(tail, "u1")], pa.binary())})

    schema = "bucket long, hash binary, n binary, tail binary"
    return blocks.select("hash", "n", "tail").mapInArrow(partial, schema).repartition(buckets, "bucket").groupBy("bucket").applyInArrow(total, schema)


def answered(blocks: DataFrame, counts: DataFrame, buckets: int, salts: int) -> DataFrame:
    """(block, bucket, answer): the counts of a block's words of one bucket, in the order of their hashes."""

    def ask(batches):
        for batch in batches:
            for r in batch.to_pylist():
                h = np.frombuffer(r["hash"], "<u8")
                cut = _by_bucket(h, buckets)
                yield pa.RecordBatch.from_pydict({
                    "bucket": pa.array([k for k, _, _ in cut], pa.int64()), "salt": pa.array([r["block"] % salts] * len(cut), pa.int64()), "block": pa.array([r["block"]] * len(cut), pa.int64()),
                    "hash": pa.array([_blob(h[a:b], "<u8") for _, a, b in cut], pa.binary()),
                })

    def answer(left: pa.Table, right: pa.Table) -> pa.Table:
        h, n = np.zeros(0, U), np.zeros(0, np.int64)
        if right.num_rows:
            h, n = np.frombuffer(right.column("hash")[0].as_py(), "<u8"), np.frombuffer(right.column("n")[0].as_py(), "<i8")
        told = []
        for b in left.column("hash").to_pylist():
            own = np.frombuffer(b, "<u8")
            at = np.minimum(np.searchsorted(h, own), max(len(h) - 1, 0))
            told.append(_blob(np.where(h[at] == own, n[at], 0) if len(h) else np.zeros(len(own)), "<i8"))
        return pa.table({"block": left.column("block"), "bucket": left.column("bucket"), "answer": pa.array(told, pa.binary())})

    asked = blocks.select("block", "hash").mapInArrow(ask, "bucket long, salt long, block long, hash binary")
    spread = counts.select("bucket", "hash", "n", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(salts - 1).cast("long"))).alias("salt"))
    n = buckets * salts
    return asked.repartition(n, "bucket", "salt").groupBy("bucket", "salt").cogroup(spread.repartition(n, "bucket", "salt").groupBy("bucket", "salt")).applyInArrow(answer, "block long, bucket long, answer binary")


def scored(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", rounds: int = 4, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(id_col, held_out, n_tokens, n_known, train_tokens, base_score, score), every row once. Each training document is trained on in one of `rounds` rounds."""
    spark = docs.sparkSession
    on_workers(spark)
    blocks = written(blocked(docs, id_col, text_col, block_bytes), "blocks")
    n_blocks, texts, entries, ends = blocks.agg(F.count(F.lit(1)), F.sum("n_texts"), F.sum((F.octet_length("hash") / 8).cast("long")), F.sum("ends")).first()
    n_blocks, entries = n_blocks or 0, entries or 0
    salts = max(1, -(-n_blocks // SALT))
    session = int(spark.conf.get("spark.sql.shuffle.partitions", "8"))
    buckets = max(1, -(-entries // (salts << 20)), min(session, entries >> 16))
    counts = written(counted(blocks, buckets), "counts")
    stats = corpus_stats(counts, ends or 0)
    weights = trained(blocks, stats, rounds)
    tasks = max(1, min(n_blocks, max(session, n_blocks // 8)))
    told = answered(blocks, counts, buckets, salts).repartition(tasks, "block")
    names = ("n_tokens", "n_known", "train_tokens", "base_score", "score")
    id_type = pa_type(docs, id_col)

    def score(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows:
            return pa.table({id_col: pa.array([], id_type), "held_out": pa.array([], pa.bool_())} | {c: pa.array([], pa.int64() if i < 3 else pa.float64()) for i, c in enumerate(names)})
        ids = left.column("ids").combine_chunks().flatten()
        r = left.drop_columns("ids").to_pylist()[0]
        distinct, tail = np.frombuffer(r["hash"], "<u8"), np.frombuffer(r["tail"], "u1").astype(np.int64)
        answers = sorted(zip(right.column("bucket").to_pylist(), right.column("answer").to_pylist(), strict=True))
        c = np.frombuffer(b"".join(a for _, a in answers), "<i8")
        codes, n_words = _codes(r["codes"], len(distinct)), np.frombuffer(r["words"], "<i4").astype(np.int64)
        first = np.concatenate([[0], np.cumsum(n_words)])
        doc = np.repeat(np.arange(len(n_words), dtype=np.int32), n_words)
        by_text = lambda x: np.bincount(doc, x[codes], len(n_words))
        room = np.log10(stats.n + stats.v + 1)
        base = by_text(np.log10(c + 1.0)) + np.log10(stats.ends + 1.0) - (n_words + 1) * room
        rows = stats.row(distinct, tail)
        share = np.where(rows >= HEAD, np.log((c + 1.0) / (stats.tail_n[tail] + stats.tail_v[tail] + 1.0)), 0.0)
        known = by_text((c > 0).astype(float)) + (stats.ends > 0)
        model = (likelihood(weights, rows.astype(np.int16)[codes], first) + by_text(share)) / np.log(10)
        held = np.frombuffer(r["held"], "u1") > 0
        return pa.table({
            id_col: ids, "held_out": pa.array(held), "n_tokens": pa.array(n_words + 1, pa.int64()), "n_known": pa.array(known.astype(np.int64), pa.int64()),
            "train_tokens": pa.array(np.full(len(n_words), stats.n), pa.int64()), "base_score": pa.array(base, pa.float64()), "score": pa.array(model, pa.float64()),
        })

    left = blocks.select("block", "ids", "words", "held", "codes", "hash", "tail").repartition(tasks, "block")
    schema = schema_of(docs, [id_col], "held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")
    return left.groupBy("block").cogroup(told.groupBy("block")).applyInArrow(score, schema)


def merged(parts: DataFrame, rows: int, merge, schema: str, name: str) -> DataFrame:
    """One row from `rows` of them, by as many steps as it takes when FAN_IN are merged at a time."""
    while rows > 1:
        rows = -(-rows // FAN_IN)
        place = F.pmod(F.xxhash64(*(F.col(c) for c in parts.columns)), F.lit(rows)).alias("_k")
        parts = written(parts.select("*", place).repartition(min(rows, 1 << 12), "_k").groupBy("_k").applyInArrow(merge, schema), name)
        rows = parts.count()
    return parts


def corpus_stats(counts: DataFrame, ends: int) -> Stats:
    """From buckets of words: HEAD words and TAIL classes of each, merged until one row is left, which the driver gets."""
    schema = "answer binary, hash binary, n binary, tail binary"

    def row(by_class: np.ndarray, h: np.ndarray, n: np.ndarray, t: np.ndarray) -> dict:
        top = np.lexsort((h, -n))[:HEAD]
        return {"answer": _blob(by_class, "<i8"), "hash": _blob(h[top], "<u8"), "n": _blob(n[top], "<i8"), "tail": _blob(t[top], "u1")}

    def reduce(batches):
        for batch in batches:
            for r in batch.to_pylist():
                h, n, t = np.frombuffer(r["hash"], "<u8"), np.frombuffer(r["n"], "<i8"), np.frombuffer(r["tail"], "u1")
                by_class = np.column_stack([np.bincount(t, n, TAIL), np.bincount(t, minlength=TAIL)])
                yield pa.RecordBatch.from_pydict({c: pa.array([v], pa.binary()) for c, v in row(by_class, h, n, t).items()})

    def merge(table: pa.Table) -> pa.Table:
        get = lambda c, kind: [np.frombuffer(b, kind) for b in table.column(c).to_pylist()]
        by_class = sum(x.reshape(TAIL, 2) for x in get("answer", "<i8"))
        return pa.table({c: pa.array([v], pa.binary()) for c, v in row(by_class, *(np.concatenate(get(c, k)) for c, k in (("hash", "<u8"), ("n", "<i8"), ("tail", "u1")))).items()})

    parts = written(counts.mapInArrow(reduce, schema), "tops")
    got = merged(parts, parts.count(), merge, schema, "tops").first()
    if got is None:
        return Stats(ends, int(ends > 0), ends, np.zeros(0, U), np.zeros(0), np.zeros(TAIL), np.zeros(TAIL))
    h, n, t = np.frombuffer(got["hash"], "<u8"), np.frombuffer(got["n"], "<i8"), np.frombuffer(got["tail"], "u1")
    by_class = np.frombuffer(got["answer"], "<i8").reshape(TAIL, 2).astype(np.int64).copy()
    n_all, v = int(by_class[:, 0].sum()) + ends, int(by_class[:, 1].sum()) + (ends > 0)
    np.subtract.at(by_class, (t, 0), n)  # head words stand in classes of their own
    np.subtract.at(by_class, (t, 1), 1)
    return Stats(n_all, v, ends, h, n, by_class[:, 0], by_class[:, 1])


def training_rows(block: dict, stats: Stats) -> np.ndarray:
    """The input rows of a block's training texts, each after an END, and an END at last."""
    distinct, tail = np.frombuffer(block["hash"], "<u8"), np.frombuffer(block["tail"], "u1").astype(np.int64)
    n_words, learned = np.frombuffer(block["words"], "<i4").astype(np.int64), np.frombuffer(block["held"], "u1") == 0
    rows = stats.row(distinct, tail)[_codes(block["codes"], len(distinct))] if len(distinct) else np.zeros(0, np.int64)
    first = np.concatenate([[0], np.cumsum(n_words[learned])[:-1]]) if learned.any() else np.zeros(0, np.int64)
    return np.append(np.insert(rows[np.repeat(learned, n_words)], first, END), END)


def share_of(rounds: int) -> Column:
    """The round that a block is trained on."""
    return F.pmod(F.xxhash64(F.lit(23), "block"), F.lit(rounds)).cast("int")


def trained(blocks: DataFrame, stats: Stats, rounds: int) -> dict[str, np.ndarray]:
    weights, schema = packed(initial(stats)), "n long, w binary"
    for k in range(rounds):
        start = weights

        def run(batches, start=start, k=k):
            t = Trainer(unpacked(start), 0.004 / min(k + 1, 2))
            for batch in batches:
                for block in batch.to_pylist():
                    t.texts(training_rows(block, stats))
            if t.seen:
                yield pa.RecordBatch.from_pydict({"n": pa.array([t.seen], pa.int64()), "w": pa.array([packed(t.w)], pa.binary())})

        def mean(table: pa.Table) -> pa.Table:
            n = np.array(table.column("n"), np.float64)
            total = np.zeros(len(table.column("w")[0].as_py()) // 4)
            for i in np.lexsort((table.column("w").to_pylist(), n)).tolist():
                total += np.frombuffer(table.column("w")[i].as_py(), "<f4") * (n[i] / n.sum())
            return pa.table({"n": pa.array([int(n.sum())], pa.int64()), "w": pa.array([total.astype("<f4").tobytes()], pa.binary())})

        own = blocks.where(share_of(rounds) == k).select("words", "held", "codes", "hash", "tail")
        parts = written(own.mapInArrow(run, schema), "weights")
        row = merged(parts, parts.count(), mean, schema, "weights").first()
        weights = bytes(row["w"]) if row is not None else weights
    return unpacked(weights)
