"""Quality rules: gradient-boosted trees over document statistics.

Statistics come from numpy over the joined bytes of many texts. Trees are grown by histograms on a bounded,
documented sample of labelled rows (sample_rows, those with the smallest hash of their id), with monotonic
constraints: more repeated words, more repeated lines and more symbols never raise a score. The trees are then
flattened into node arrays and all rows of a batch walk them level by level.

Cases: null and empty texts have zeros everywhere and fail the base rule; without labelled rows of both classes
the trees are empty and the base rule alone decides; rows may repeat, and of rows with one labelled id the smallest
text is learned from; a column to keep that is named like an output is an error; an empty table gives an empty table.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ridgeline.llm.shared import flat, map_texts, schema_of
from ridgeline.llm.textgrid import SPACED, Hasher, U, mix, per_text, words

SYMBOLS = b"#*$%&|<>"
#: Monotonic constraints: -1 where a larger value never raises the score.
FEATURES = {
    "log_words": 0, "mean_word": 0, "symbols_per_word": -1, "dup_line_share": -1, "repeat_share": -1, "upper_share": 0, "digit_share": 0, "punct_share": 0,
    "wide_share": 0, "distinct_share": 0, "words_per_line": 0, "long_words": 0, "space_share": 0, "stops_per_word": 0,
}
BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
#: Labelled rows that the trees are fitted on at most.
SAMPLE_ROWS = 20_000
#: A document is kept from this probability of being good on. Low: the filter must not take clean documents.
KEEP_FROM = 0.5


def _table(chars: bytes) -> np.ndarray:
    t = np.zeros(256, bool)
    t[list(chars)] = True
    return t


_SYMBOL, _UPPER, _DIGIT = _table(SYMBOLS), _table(bytes(range(65, 91))), _table(b"0123456789")
_PUNCT, _STOP = _table(b".,;:!?'\"()-"), _table(b".!?")


def statistics(data: np.ndarray, off: np.ndarray) -> tuple[dict[str, np.ndarray], np.ndarray]:
    """The base columns, and a row of features for each text."""
    n = len(off) - 1
    starts, ends, first = words(data, off, SPACED)
    n_words = np.diff(first)
    by_byte = lambda flag: per_text(flag, off)
    char = (data & 0xC0) != 0x80
    word_chars = by_byte(char & SPACED[data])
    doc = np.repeat(np.arange(n), n_words)
    hasher = Hasher(data)
    with np.errstate(over="ignore"):
        salt = mix(np.arange(n, dtype=U) * U(0x2545F4914F6CDD1D) + U(1))
        h = hasher.spans(starts, ends)
        # repeated three-word windows: the first and all later ones mark their words
        marked = np.zeros(len(h), bool)
        if len(h) > 2:
            inside = doc[:-2] == doc[2:]
            window = mix(h[:-2] * U(0x9FB21C651E98DF25) + h[1:-1] * U(0xD1342543DE82EF95) + h[2:] * U(0xA0761D6478BD642F) ^ salt[doc[:-2]])[inside]
            place = np.flatnonzero(inside)
            order = np.argsort(window)
            same = window[order][1:] == window[order][:-1]
            twice = np.zeros(len(window), bool)
            twice[order[1:][same]] = True
            twice[order[:-1][same]] = True
            for k in range(3):
                marked[place[twice] + k] = True
        distinct = np.bincount(doc[np.unique(h ^ salt[doc], return_index=True)[1]], minlength=n) if len(h) else np.zeros(n, np.int64)
        newline = np.flatnonzero(data == 10)
        line_s = np.sort(np.concatenate([off[:-1], newline + 1]))
        line_e = np.sort(np.concatenate([newline, off[1:]]))
        line_doc = np.repeat(np.arange(n), by_byte(data == 10) + 1)
        worded = np.searchsorted(starts, line_s) < np.searchsorted(starts, line_e)
        line_s, line_e, line_doc = line_s[worded], line_e[worded], line_doc[worded]
        lines = np.bincount(line_doc, minlength=n)
        kept = np.bincount(line_doc[np.unique(hasher.spans(line_s, line_e) ^ salt[line_doc], return_index=True)[1]], minlength=n) if len(line_s) else np.zeros(n, np.int64)
    base = {"n_words": n_words, "word_chars": word_chars, "n_symbols": by_byte(_SYMBOL[data]), "n_dup_lines": lines - kept, "n_repeat_words": per_text(marked, first)}
    base = {k: v.astype(np.int64) for k, v in base.items()}
    w, c, b = np.maximum(n_words, 1), np.maximum(word_chars, 1), np.maximum(np.diff(off), 1)
    features = np.column_stack([
        np.log1p(n_words), word_chars / w, base["n_symbols"] / w, base["n_dup_lines"] / np.maximum(lines, 1), base["n_repeat_words"] / w, by_byte(_UPPER[data]) / c, by_byte(_DIGIT[data]) / c,
        by_byte(_PUNCT[data]) / c, by_byte((data & 0xC0) == 0x80) / b, distinct / w, n_words / np.maximum(lines, 1), per_text(ends - starts > 12, first) / w, by_byte(~SPACED[data]) / b, by_byte(_STOP[data]) / w,
    ])
    return base, features


@dataclass
class Trees:
    """Complete trees as arrays, a row a tree: node k's children are 2k + 1 and 2k + 2."""

    feature: np.ndarray
    cut: np.ndarray
    leaf: np.ndarray
    start: float

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probability of class 1 for each row."""
        total = np.full(len(x), self.start)
        row = np.arange(len(x))
        for feature, cut, leaf in zip(self.feature, self.cut, self.leaf, strict=True):
            node = np.zeros(len(x), np.int64)
            while node.size and node[0] < len(feature):
                node = 2 * node + 1 + (x[row, feature[node]] > cut[node])
            total += leaf[node - len(feature)]
        return 1 / (1 + np.exp(-total))


def grown(x: np.ndarray, y: np.ndarray, signs: np.ndarray, trees: int = 60, depth: int = 3, rate: float = 0.15, bins: int = 32, l2: float = 1.0, least: float = 20.0) -> Trees:
    """Newton boosting of log loss on histograms. A split against its feature's sign is not taken, and what stands
    below a constrained split stays on its side of the midpoint, so whole trees are monotonic."""
    pos = float(y.mean()) if len(y) else 0.5
    empty = Trees(np.zeros((0, 2**depth - 1), np.int64), np.zeros((0, 2**depth - 1)), np.zeros((0, 2**depth)), 0.0)
    if not len(y) or not 0 < pos < 1:
        return empty
    cuts = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, bins + 1)[1:-1])) for f in range(x.shape[1])]
    code = np.column_stack([np.searchsorted(c, x[:, f], "left") for f, c in enumerate(cuts)])
    total = np.full(len(x), start := float(np.log(pos / (1 - pos))))
    out = []
    for _ in range(trees):
        p = 1 / (1 + np.exp(-total))
        g, h = y - p, p * (1 - p)
        inner, node = 2**depth - 1, np.zeros(len(x), np.int64)
        feature, cut, lo, hi, leaf = np.zeros(inner, np.int64), np.full(inner, np.inf), {0: -np.inf}, {0: np.inf}, np.zeros(2**depth)
        value = lambda G, H, k: np.clip(G / (H + l2), lo[k], hi[k])  # noqa: E731, B023
        for k in range(inner):
            own = np.flatnonzero(node == k)
            best = (1e-6, 0, np.inf, 0.0, 0)
            G, H = g[own].sum(), h[own].sum()
            v = value(G, H, k)
            gain0 = G * v - (H + l2) * v * v / 2
            for f in range(x.shape[1]):
                if not len(cuts[f]) or len(own) < 2 * least:
                    continue
                n_bins = len(cuts[f]) + 1
                gl = np.cumsum(np.bincount(code[own, f], g[own], n_bins))[:-1]
                hl = np.cumsum(np.bincount(code[own, f], h[own], n_bins))[:-1]
                nl = np.cumsum(np.bincount(code[own, f], minlength=n_bins))[:-1]
                vl, vr = value(gl, hl, k), value(G - gl, H - hl, k)
                gain = gl * vl - (hl + l2) * vl**2 / 2 + (G - gl) * vr - (H - hl + l2) * vr**2 / 2 - gain0
                gain[(nl < least) | (len(own) - nl < least) | (signs[f] * (vr - vl) < 0)] = -1
                j = int(gain.argmax())
                if gain[j] > best[0]:
                    best = (gain[j], f, cuts[f][j], (vl[j] + vr[j]) / 2, int(signs[f]))
            _, f, c, mid, sign = best
            feature[k], cut[k] = f, c
            left, right = 2 * k + 1, 2 * k + 2
            lo[left], hi[left], lo[right], hi[right] = lo[k], hi[k], lo[k], hi[k]
            if sign < 0:
                lo[left], hi[right] = max(lo[k], mid), min(hi[k], mid)
            elif sign > 0:
                hi[left], lo[right] = min(hi[k], mid), max(lo[k], mid)
            node[own] = left + (x[own, f] > c)
        for k in range(2**depth):
            own = node == k + inner
            leaf[k] = rate * value(g[own].sum(), h[own].sum(), k + inner)
        total += leaf[node - inner]
        out.append((feature, cut, leaf))
    return Trees(*(np.array(a) for a in zip(*out, strict=True)), start)


def sampled(labels: DataFrame, label_col: str, rows: int, id_col: str = "doc_id") -> DataFrame:
    """At most `rows` labelled rows: those with the smallest hash of their id, one an id."""
    clean = labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull()).groupBy(id_col).agg(F.max(label_col).alias("y"))
    return clean.orderBy(F.xxhash64(id_col), id_col).limit(rows).select(F.col(id_col).alias("of"), F.col("y").cast("int").alias("y"))


def labelled(docs: DataFrame, labels: DataFrame, label_col: str, rows: int, text_col: str = "text") -> DataFrame:
    """(doc_id, y, text_col) of the sampled ids, one row an id however often it occurs: its smallest text."""
    some = F.broadcast(sampled(labels, label_col, rows))  # `rows` pairs of numbers at most
    met = docs.select("doc_id", text_col).join(some, F.col("doc_id") == F.col("of"))
    return met.groupBy("doc_id").agg(F.min("y").alias("y"), F.min(F.struct(F.col(text_col))).alias("t")).select("doc_id", "y", F.col("t")[text_col].alias(text_col))


def fitted(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS, text_col: str = "text") -> Trees:
    """Trees from the sample; only its features come to the driver (sample_rows rows of numbers at most)."""
    sample = labelled(docs, labels, "quality", sample_rows, text_col)

    def make():
        def f(piece: pa.RecordBatch) -> dict:
            _, x = statistics(*flat(piece.column(text_col)))
            return {"doc_id": piece.column("doc_id"), "y": piece.column("y"), "x": pa.array(list(x), pa.list_(pa.float64()))}

        return f

    got = map_texts(sample, ["doc_id", "y", text_col], schema_of(docs, ["doc_id"], "y int, x array<double>"), make, text_col).toArrow()
    x = np.array(got.column("x").combine_chunks().flatten()).reshape(-1, len(FEATURES)) if got.num_rows else np.zeros((0, len(FEATURES)))
    order = np.lexsort((*x.T, np.array(got.column("doc_id"))))  # the same trees whatever the order of rows
    return grown(x[order], np.array(got.column("y"))[order].astype(float) if got.num_rows else np.zeros(0), np.array(list(FEATURES.values())))


def judged(docs: DataFrame, trees: Trees, keep: list[str], keep_from: float = KEEP_FROM, text_col: str = "text") -> DataFrame:
    """The columns of keep, the base columns, base_failed, quality double and kept. Every row once."""
    def make():
        def f(piece: pa.RecordBatch) -> dict:
            base, x = statistics(*flat(piece.column(text_col)))
            failed = (base["n_words"] < 50) | (100 * base["n_repeat_words"] > 50 * base["n_words"])
            p = trees.score(x)
            return {c: piece.column(c) for c in keep} | base | {"base_failed": failed, "quality": p, "kept": ~failed & (p >= keep_from)}

        return f

    return map_texts(docs, list(dict.fromkeys([*keep, text_col])), schema_of(docs, keep, "".join(f"{c} long, " for c in BASE) + "base_failed boolean, quality double, kept boolean"), make, text_col)
