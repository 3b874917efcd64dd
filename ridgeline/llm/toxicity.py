"""Toxicity by a lexicon that tolerates misspellings, weighed by context.

The lexicon is learned: words, and word beginnings (stems) where many inflected words share one, that are far
more frequent in documents labelled toxic than in others. It is held as a trie. A Levenshtein automaton runs
against the trie: a state is the set of trie nodes that a word read so far can stand at, with the fewest edits
for each; states are made when first reached and their transitions kept, so a word costs a table lookup a
letter and most words reach the dead state after a few. Distinct words of a batch are run once.

Hits count by kind: exact, misspelled, and standing in a quotation (between a mark that opens and the one that closes
it, both within CONTEXT words, or beside a reporting word within CONTEXT words). Marks pair within a line, as quotations() says;
an apostrophe between letters is none, and words between two quotations are not quoted. A logistic regression on these turns them into a probability; its weights are drawn
towards a prior that counts a quoted hit for little.

Only the text enters a score. The lexicon and the regression are fitted on a bounded sample of labelled rows
(sample_rows, those with the smallest hash of their id); the scan covers whole texts of all documents.

Terms below 5 letters and stems that need two words take no edits, so their misspellings are not caught.

Cases: null and empty texts get the score of a text without hits; without labelled rows of both classes the
lexicon is empty and every score is 0; rows may repeat, and of rows with one labelled id the smallest text is
learned from; a null id is never learned from; ties in worth go to the smaller term; a column to keep that is
named score or hits is an error; an empty table gives an empty table.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections import Counter
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ridgeline.llm.quality import labelled
from ridgeline.llm.shared import flat, map_texts, parts_for, schema_of, written
from ridgeline.llm.textgrid import ALNUM, LOWER, Hasher, U, mix, words

SAMPLE_ROWS = 20_000
STEM_LENGTHS = (3, 4, 5, 6, 7, 8)
CONTEXT = 6
# Words that report what others said, in four languages.
REPORTING = frozenset("said says say called calls quote quoted quotes quoting wrote writes term word phrase reported dit disait cite mot sagte sagt zitat wort dijo dice cita palabra".split())
#: What closes what, in the same languages; either guillemet opens, and a straight mark closes an open one.
CLOSES = {'"': '"', "”": "“„”", "“": "„", "»": "«", "«": "»", "’": "‘", "‘": "‚"}
OPENS = frozenset('"“„”«»‘‚')
_MARK = re.compile('["“”„«»‘’‚\n]')
#: What a misspelled and a quoted hit count for against an exact one, before the corrections below.
MISSPELLED, QUOTED = 0.8, 0.1
#: Of the offset, of the hit terms' weights, of those of misspelled and of quoted ones again (corrections to the above),
#: and of the logarithm of one plus the unquoted hits. A hit that stands alone though its term needs two counts for nothing.
PRIOR = np.array([-5.0, 1.0, 0.0, 0.0, 1.0])


@dataclass
class Term:
    """need: a stem that stands in clean documents once in a while tells something from two words a document on."""

    text: str
    stem: bool
    edits: int
    need: int = 1
    weight: float = 1.0


def edits_for(text: str) -> int:
    """Edits that a term of this length tolerates."""
    return 0 if len(text) < 5 else 1 if len(text) < 9 else 2


@dataclass
class LexiconAutomaton:
    """The product of the trie of terms and a Levenshtein automaton, built as words reach its states."""

    terms: list[Term]
    children: list[dict[str, int]] = field(default_factory=lambda: [{}])
    ends: list[list[int]] = field(default_factory=lambda: [[]])
    limit: list[int] = field(default_factory=lambda: [-1])

    def __post_init__(self) -> None:
        for i, t in enumerate(self.terms):
            node = 0
            self.limit[0] = max(self.limit[0], t.edits)
            for c in t.text:
                if c not in self.children[node]:
                    self.children[node][c] = len(self.children)
                    self.children.append({})
                    self.ends.append([])
                    self.limit.append(-1)
                node = self.children[node][c]
                self.limit[node] = max(self.limit[node], t.edits)
            self.ends[node].append(i)
        self.ids: dict[tuple, int] = {}
        self.states: list[tuple] = []
        self.moves: list[dict[str, int]] = []
        self.at_end: list[tuple[int, int] | None] = []
        self.at_stem: list[tuple[int, int] | None] = []
        self.start = self._state({0: 0})

    def _state(self, nodes: dict[int, int]) -> int:
        todo = list(nodes)
        while todo:  # a letter of the term that the word leaves out
            node = todo.pop()
            e = nodes[node] + 1
            for child in self.children[node].values():
                if e <= self.limit[child] and e < nodes.get(child, 9):
                    nodes[child] = e
                    todo.append(child)
        key = tuple(sorted(nodes.items()))
        if key not in self.ids:
            self.ids[key] = len(self.states)
            self.states.append(key)
            self.moves.append({})
            done = [(e, t, self.terms[t].stem) for node, e in key for t in self.ends[node] if e <= self.terms[t].edits]
            self.at_end.append(min(((e, t) for e, t, _ in done), default=None))
            self.at_stem.append(min(((e, t) for e, t, stem in done if stem), default=None))
        return self.ids[key]

    def _move(self, state: int, c: str) -> int:
        nodes: dict[int, int] = {}
        for node, e in self.states[state]:
            if e + 1 <= self.limit[node]:
                nodes[node] = min(nodes.get(node, 9), e + 1)
            for letter, child in self.children[node].items():
                cost = e + (letter != c)
                if cost <= self.limit[child]:
                    nodes[child] = min(nodes.get(child, 9), cost)
        self.moves[state][c] = new = self._state(nodes)
        return new

    def match(self, word: str) -> tuple[int, int] | None:
        """(edits, term) with the fewest edits: the whole word for a word, its beginning for a stem."""
        state, best = self.start, None
        for c in word:
            new = self.moves[state].get(c)
            state = self._move(state, c) if new is None else new
            if not self.states[state]:
                return best
            stem = self.at_stem[state]
            if stem is not None and (best is None or stem < best):
                best = stem
        end = self.at_end[state]
        return end if end is not None and (best is None or end < best) else best


def trained_on(doc_id: Column, not_equal: int = 1, modulus: int = 3) -> Column:
    """Whether a row's label may be learned from; a null id hashes as the text "null"."""
    return F.pmod(F.crc32(F.encode(F.coalesce(doc_id.cast("string"), F.lit("null")), "UTF-8")), F.lit(modulus)) != not_equal


def _sample(docs: DataFrame, labels: DataFrame, rows: int, text_col: str) -> DataFrame:
    allowed = labels.where(trained_on(F.col("doc_id")))
    # copies tell no more than one of them: a word of theirs would look like one that many toxic documents share
    once = labelled(docs, allowed, "toxic", rows, text_col).groupBy(text_col).agg(F.max("y").alias("y"))
    return once.select("y", text_col).repartition(parts_for(docs.sparkSession, rows, 4_000))


def _term_counts(sample: DataFrame, text_col: str) -> DataFrame:
    """(term, stem, need, toxic, clean): in how many sampled documents of either label a word or word beginning
    stands `need` times at least."""

    def make():
        def f(piece: pa.RecordBatch) -> dict:
            data, off = flat(piece.column(text_col))
            low = LOWER[data]
            starts, ends, first = words(low, off, ALNUM)
            toxic = np.array(piece.column("y")) > 0
            doc = np.repeat(np.arange(len(off) - 1), np.diff(first))
            char = np.concatenate([[0], np.cumsum((low & 0xC0) != 0x80)])
            length = char[ends] - char[starts]
            place = np.flatnonzero((low & 0xC0) != 0x80)  # of each code point
            h, raw = Hasher(low), low.tobytes()
            out: dict[str, list] = {"term": [], "stem": [], "need": [], "toxic": [], "clean": []}
            for n in (0, *STEM_LENGTHS):
                use = np.flatnonzero(length > n if n else length >= 3)
                if not len(use):
                    continue
                s = starts[use]
                e = ends[use] if not n else place[char[s] + n]
                with np.errstate(over="ignore"):
                    hashes = h.spans(s, e)
                    _, once, times = np.unique(hashes ^ mix(doc[use].astype(U) * U(0x2545F4914F6CDD1D) + U(1)), return_index=True, return_counts=True)
                for need in (1, 2) if n else (1,):
                    own = once[times >= need]
                    _, at, inv = np.unique(hashes[own], return_index=True, return_inverse=True)
                    t = np.bincount(inv, toxic[doc[use][own]], minlength=len(at)).astype(np.int64)
                    out["toxic"].append(t)
                    out["clean"].append(np.bincount(inv, minlength=len(at)) - t)
                    out["term"] += [raw[a:b].decode("utf-8", "replace") for a, b in zip(s[own][at].tolist(), e[own][at].tolist(), strict=True)]
                    out["stem"] += [n > 0] * len(at)
                    out["need"] += [need] * len(at)
            if not out["term"]:
                return None
            return {"term": out["term"], "stem": out["stem"], "need": pa.array(out["need"], pa.int32()), "toxic": np.concatenate(out["toxic"]), "clean": np.concatenate(out["clean"])}

        return f

    counts = map_texts(sample, ["y", text_col], "term string, stem boolean, need int, toxic long, clean long", make, text_col)
    return counts.groupBy("term", "stem", "need").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))


def learned_terms(counts: DataFrame, n_toxic: int, n_clean: int, least: int = 8, ratio: float = 20.0) -> list[Term]:
    """Terms whose rate among toxic documents is `ratio` times that among clean ones. Of words and stems that stand
    for each other's words, those are taken first that cover most at the surest rate."""
    if not n_toxic or not n_clean:
        return []
    rate = (F.col("toxic") / n_toxic) / ((F.col("clean") + 3) / (n_clean + 3))  # a rare term's rate is held for lower
    good = counts.where((F.col("toxic") >= least) & (rate >= ratio)).withColumn("rate", F.log(rate)).withColumn("worth", F.col("toxic") * F.col("rate"))
    found = good.orderBy(F.desc("worth"), "need", "stem", F.length("term"), "term").collect()
    # a stem has to be worth a quarter more than the longer terms that it begins, else these stand for themselves
    longer: dict[str, float] = {}
    for r in found:
        for k in range(1, len(r["term"]) + (not r["stem"])):
            longer[r["term"][:k]] = max(longer.get(r["term"][:k], 0.0), r["worth"])
    chosen: dict[str, Term] = {}
    for r in found:
        t = r["term"]
        if t not in chosen and (not r["stem"] or r["worth"] >= 1.25 * longer.get(t, 0.0)):
            chosen[t] = Term(t, r["stem"], edits_for(t) if r["need"] == 1 else 0, r["need"], r["rate"])
    covered = lambda t: any(t[:k] in chosen and chosen[t[:k]].stem for k in range(1, len(t)))
    return [t for t in chosen.values() if not covered(t.text)]


def quotations(text: str) -> list[tuple[int, int]]:
    """(place of the opening mark, place of the closing one) of each quotation, in order of the closing marks.

    A mark closes the last open one that it can close, and what was opened since is forgotten; else it opens one. What is
    open at the end of a line is no quotation. A single mark between letters or digits is an apostrophe."""
    out, open_ = [], []
    for m in _MARK.finditer(text):
        c, at = m.group(), m.start()
        if c == "\n":
            open_ = []
            continue
        if c in "‘’" and 0 < at < len(text) - 1 and text[at - 1].isalnum() and text[at + 1].isalnum():
            continue
        k = next((k for k in range(len(open_) - 1, -1, -1) if open_[k][0] in CLOSES.get(c, "")), None)
        if k is not None:
            out.append((open_[k][1], at))
            del open_[k:]
        elif c in OPENS:
            open_.append((c, at))
    return out


def hits(text: str, words_with_places: list[tuple[str, int, int]], found: dict[str, tuple[int, int]]) -> list[tuple[int, int, bool, int]]:
    """(edits, term, quoted, word number) of each hit in a text, whose words stand at the given places."""
    out = []
    pairs = quotations(text)
    closed = [b for _, b in pairs]
    for i, (w, s, e) in enumerate(words_with_places):
        m = found.get(w)
        if m is None:
            continue
        lo, hi = words_with_places[max(0, i - CONTEXT)][1], words_with_places[min(len(words_with_places) - 1, i + CONTEXT)][2]
        near = pairs[bisect_right(closed, e - 1) : bisect_right(closed, hi)]  # marks that close within CONTEXT words
        inside = any(lo - 1 <= a < s for a, _ in near)
        reports = any(x[0] in REPORTING for x in words_with_places[max(0, i - CONTEXT) : i + CONTEXT + 1])
        out.append((*m, inside or reports, i))
    return out


def _scan(piece: pa.RecordBatch, text_col: str, automaton: LexiconAutomaton) -> tuple[np.ndarray, list[list]]:
    """Features of each text (as at PRIOR) and its hits."""
    data, off = flat(piece.column(text_col))
    n = len(off) - 1
    low = LOWER[data]
    starts, ends, first = words(low, off, ALNUM)
    x, where = np.zeros((n, len(PRIOR))), [[] for _ in range(n)]
    x[:, 0] = 1
    if not len(starts) or not automaton.terms:
        return x, where
    raw = low.tobytes()
    hashes, at, inv = np.unique(Hasher(low).spans(starts, ends), return_index=True, return_inverse=True)
    found: dict[str, tuple[int, int]] = {}
    hit = np.zeros(len(hashes), bool)
    for k, (a, b) in enumerate(zip(starts[at].tolist(), ends[at].tolist(), strict=True)):
        w = raw[a:b].decode("utf-8", "replace")
        m = automaton.match(w)
        if m is not None:
            found[w], hit[k] = m, True
    places = np.flatnonzero(hit[inv])
    for d in np.unique(np.searchsorted(first, places, "right") - 1):
        own = slice(first[d], first[d + 1])
        text = raw[off[d] : off[d + 1]].decode("utf-8", "replace")
        base = off[d]
        # places as code points of the text
        char = np.concatenate([[0], np.cumsum((low[off[d] : off[d + 1]] & 0xC0) != 0x80)])
        spans = [(raw[a:b].decode("utf-8", "replace"), int(char[a - base]), int(char[b - base])) for a, b in zip(starts[own].tolist(), ends[own].tolist(), strict=True)]
        where[d] = hits(text, spans, found)
        times = Counter(t for _, t, _, _ in where[d])
        by_kind: list[dict[int, float]] = [{}, {}, {}]
        plain = 0
        for e, t, quoted, _ in where[d]:
            if times[t] >= automaton.terms[t].need:
                by_kind[2 if quoted else int(e > 0)][t] = automaton.terms[t].weight
                plain += not quoted
        exact, wrong, told = (sum(k.values()) for k in by_kind)
        x[d, 1:] = exact + MISSPELLED * wrong + QUOTED * told, wrong, told, np.log1p(plain)
    return x, where


def regression(x: np.ndarray, y: np.ndarray, prior: np.ndarray = PRIOR, pull: float = 0.5) -> np.ndarray:
    """Weights of a logistic regression by Newton steps, drawn towards the prior; the offset is free."""
    w, ridge = prior.copy(), np.full(x.shape[1], pull)
    ridge[0] = 1e-3
    for _ in range(40):
        p = 1 / (1 + np.exp(-x @ w))
        step = np.linalg.solve((x.T * (p * (1 - p))) @ x + np.diag(ridge), x.T @ (y - p) - ridge * (w - prior))
        w += np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-9:
            break
    return w


@dataclass
class Model:
    terms: list[Term]
    weights: np.ndarray


def fitted(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS, text_col: str = "text") -> Model:
    """The lexicon and weights. Of the sample, a row an id, only numbers come to the driver, and the terms that pass the bounds."""
    sample = written(_sample(docs, labels, sample_rows, text_col), "sample")
    n = {r["y"]: r["n"] for r in sample.groupBy((F.col("y") > 0).alias("y")).agg(F.count(F.lit(1)).alias("n")).collect()}
    terms = learned_terms(_term_counts(sample, text_col), n.get(True, 0), n.get(False, 0))
    if not terms:
        return Model([], np.array([-50.0, 0, 0, 0, 0]))

    def make(automaton=None):
        def f(piece: pa.RecordBatch) -> dict:
            nonlocal automaton
            automaton = automaton or LexiconAutomaton(terms)
            x, where = _scan(piece, text_col, automaton)
            kinds = [sorted({t for e, t, _, _ in h if e}) for h in where]
            return {"y": piece.column("y"), "x": pa.array(list(x), pa.list_(pa.float64())), "fuzzy": pa.array(kinds, pa.list_(pa.int32()))}

        return f

    def features():
        return map_texts(sample, ["y", text_col], "y int, x array<double>, fuzzy array<int>", make, text_col).toArrow().to_pylist()

    rows = features()
    # a term whose misspellings stand in clean documents too is taken literally
    seen = np.zeros((len(terms), 2))
    for r in rows:
        for t in r["fuzzy"]:
            seen[t, int(r["y"] > 0)] += 1
    loose = [t for t in range(len(terms)) if (seen[t, 0] + 0.5) / (n[False] + 1) * 5 > (seen[t, 1] + 0.5) / (n[True] + 1) and seen[t, 0] > 0]
    if loose:
        for t in loose:
            terms[t].edits = 0
        rows = features()
    rows.sort(key=lambda r: (r["y"], r["x"]))
    return Model(terms, regression(np.array([r["x"] for r in rows]), np.array([float(r["y"] > 0) for r in rows])))


def scored(docs: DataFrame, model: Model, keep: list[str], text_col: str = "text") -> DataFrame:
    """The columns of keep, score double and hits (term, edits, quoted, word number). Every row once."""
    terms, weights = model.terms, model.weights

    def make():
        automaton = LexiconAutomaton(terms)

        def f(piece: pa.RecordBatch) -> dict:
            x, where = _scan(piece, text_col, automaton)
            shown = [[{"term": terms[t].text, "edits": e, "quoted": q, "word": i} for e, t, q, i in h] for h in where]
            kind = pa.list_(pa.struct([("term", pa.string()), ("edits", pa.int32()), ("quoted", pa.bool_()), ("word", pa.int32())]))
            return {c: piece.column(c) for c in keep} | {"score": 1 / (1 + np.exp(-x @ weights)), "hits": pa.array(shown, kind)}

        return f

    return map_texts(docs, list(dict.fromkeys([*keep, text_col])), schema_of(docs, keep, "score double, hits array<struct<term: string, edits: int, quoted: boolean, word: int>>"), make, text_col)
