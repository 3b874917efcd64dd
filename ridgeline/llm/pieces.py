"""SentencePiece BPE encoding and decoding with byte fallback, by a table of prefixes.

Merging always takes the neighbours whose piece ranks first, the leftmost of equals. So what it makes of a text's
prefix ends in one token alone, and a row of tokens is a text's encoding where all its neighbours are compatible:
where no merge would have bridged the border before both had become what they are. The table has the last token of
each prefix: of the pieces that the automaton finds ending there, the only one compatible with the last token of
the prefix that it leaves. Ids are then recovered from the end backwards. No piece is ever merged.

A border's merges are known from the two tokens: the parts at their facing edges, each with the rank at which it
went up in the next larger one. That needs pieces to rank behind the parts that merging makes them of, as they do in
trained models; others are refused, and so are models that normalize texts or have no byte pieces.

Texts fall apart where no piece of the model reaches across (checked when it is read): into words before runs of spaces,
words after letters and digits and around characters that stand in no longer piece. The ids of words and of their parts
are kept in a table of bounded size.

Cases: null and empty texts have no ids; texts of any length and script are read whole; characters without a piece
become their bytes; strings of control pieces are plain text; rows may repeat and each is encoded; an empty table
gives an empty table; columns not in keep are left out, and a column in keep that has the name of an output column
is an error (see shared.boxed).
"""

from __future__ import annotations

import codecs
import hashlib
import math
import re
from array import array
from collections.abc import Callable
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from sentencepiece import SentencePieceProcessor

from ridgeline.llm.shared import flat, map_texts, schema_of

SPACE = "▁"
#: Words and parts of words that a worker keeps, and pairs of tokens; a table starts anew beyond that. Longer words are not kept.
KEPT, PAIRS, LONG = 500_000, 400_000, 64
codecs.register_error("ridgeline-each-byte", lambda e: ("�" * (e.end - e.start), e.end))

#: The parts of a token at one of its edges, from the character up: (part, rank at which it goes up in the next).
Edge = list[tuple[str, float]]


class Pieces:
    """The pieces of a model, what they are made of, and the encoder over them."""

    def __init__(self, model_path: str):
        model = SentencePieceProcessor(model_file=model_path)
        ids = range(model.get_piece_size())
        if model.normalize("a  b\n") != f"{SPACE}a{SPACE}{SPACE}b\n" or not all(float(model.get_score(i)).is_integer() for i in ids):
            raise ValueError("only BPE models that leave texts as they are, but for a space before them")
        plain = {model.id_to_piece(i): i for i in ids if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i))}
        self.byte_id = {int(model.id_to_piece(i)[3:5], 16): i for i in ids if model.is_byte(i)}
        if len(self.byte_id) < 256 or any(model.is_unused(i) for i in ids):
            raise ValueError("only models with a piece for each byte and none out of use")
        self.control = {i for i in ids if model.is_control(i)}
        self.id_of = plain
        self.rank = {p: -model.get_score(i) for p, i in plain.items() if len(p) > 1}
        self.bytes_of = [p.replace(SPACE, " ").encode() if (p := model.id_to_piece(i)) in plain else bytes([int(p[3:5], 16)]) if model.is_byte(i) else b"" for i in ids]
        self.names = [str(i) for i in ids]
        self.left: dict[str, Edge] = {}
        self.right: dict[str, Edge] = {}
        self.pairs: dict[tuple[str, str], bool] = {}
        self.known: dict[str, bytes] = {}
        self.found = ahocorasick.Automaton()
        for piece in sorted(self.rank, key=len):
            self.learn(piece)
        for piece in self.left:
            if len(piece) > 1:
                self.found.add_word(piece, (piece, len(piece)))
        self.found.make_automaton()
        self.spaced = not any(re.search(f"[^{SPACE}]{SPACE}", p) for p in self.rank)
        self.runs = re.compile(f"{SPACE}+[^{SPACE}]*").findall
        self.split = self.splitter()

    def splitter(self):
        """What cuts a text into parts, (spaces) (signs) (letters and digits), as long as no piece goes on behind them."""
        joined = {c for p in self.rank for c in p}
        alone = "".join(re.escape(chr(c)) for c in range(128) if chr(c) not in joined and not (chr(c).isalnum() or chr(c) == "_"))
        sign, word = rf"(?:[^\w{SPACE}{alone}]|_)", r"[^\W_]"
        if not self.spaced:
            return re.compile(r"(?s:.+)").findall
        loose = "".join(sorted({re.escape(c) for p in self.rank for c in re.findall(f"({word}){sign}", p)}))
        if loose:  # such as a raised 2 before a full stop: signs behind it stay with it
            word = rf"(?:[^\W_{loose}]|[{loose}]{sign}*)"
        return re.compile(f"{SPACE}*{sign}*{word}+|{SPACE}*{sign}+|{SPACE}+|[{alone}]").findall

    def edges(self, of: dict[str, Edge], token: str) -> Edge:
        return of[token] if len(token) > 1 else [(token, math.inf)]

    def learn(self, piece: str) -> None:
        """The last merge that makes the piece, if merging makes it at all: the split whose halves nothing bridges before."""
        rank = self.rank[piece]
        for k in range(1, len(piece)):
            a, b = piece[:k], piece[k:]
            if (k == 1 or a in self.left) and (k == len(piece) - 1 or b in self.left) and self.unbridged(a, b):
                if max(self.rank.get(a, 0), self.rank.get(b, 0)) > rank:
                    raise ValueError(f"{piece!r} ranks before a part that it is merged of")
                up, down = self.edges(self.left, a), self.edges(self.right, b)
                self.left[piece] = [*up[:-1], (a, rank), (piece, math.inf)]
                self.right[piece] = [*down[:-1], (b, rank), (piece, math.inf)]
                return

    def unbridged(self, a: str, b: str) -> bool:
        """Whether no merge over the border between a and b comes before both are whole."""
        xs, ys = self.edges(self.right, a), self.edges(self.left, b)
        i = j = 0
        while i < len(xs) - 1 or j < len(ys) - 1:
            (x, x_up), (y, y_up) = xs[i], ys[j]
            rank = self.rank.get(x + y)
            if rank is not None and rank < x_up and rank <= y_up:  # of two equal merges the left one comes first
                return False
            if x_up <= y_up:
                i += 1
            else:
                j += 1
        return True

    def compatible(self, a: str, b: str) -> bool:
        """Whether a and b stay apart where they meet in a text."""
        return a + b not in self.rank and self.unbridged(a, b)

    def tokens(self, word: str) -> list[str]:
        last = ["", *word]  # of each prefix; a character where no piece is found
        pairs = self.pairs
        if len(pairs) >= PAIRS:
            pairs.clear()
        settled = -1
        for end, (piece, size) in self.found.iter(word):  # of those with one end the longest comes first
            if end == settled:
                continue
            before = last[end + 1 - size]
            if before:
                key = (before, piece)
                fits = pairs.get(key)
                if fits is None:
                    fits = pairs[key] = self.compatible(before, piece)
                if not fits:
                    continue
            last[end + 1] = piece
            settled = end
        out, k = [], len(word)
        while k:
            out.append(last[k])
            k -= len(last[k])
        out.reverse()
        return out

    def part(self, part: str) -> bytes:
        """The ids of what splitter() leaves whole, 4 bytes an id."""
        ids: list[int] = []
        for t in self.tokens(part):
            i = self.id_of.get(t)
            if i is None:
                ids += [self.byte_id[x] for x in t.encode()]
            else:
                ids.append(i)
        return array("i", ids).tobytes()

    def fresh(self, word: str) -> bytes:
        """The ids of a word that is not known; it and its parts are kept if they are short."""
        known, parts = self.known, self.split(word)
        if len(parts) == 1:
            ids = self.part(word)
        else:
            found = []
            for p in parts:
                x = known.get(p)
                if x is None:
                    x = self.part(p)
                    if len(p) <= LONG:
                        known[p] = x
                found.append(x)
            ids = b"".join(found)
        if len(word) <= LONG:
            known[word] = ids
        return ids

    def encode(self, text: str) -> bytes:
        """The ids of a whole text, 4 bytes an id in the machine's order."""
        if not text:
            return b""
        known = self.known
        if len(known) >= KEPT:
            known.clear()
        text = SPACE + text.replace(" ", SPACE)
        if not self.spaced:
            words = [text]
        elif SPACE + SPACE in text:
            words = self.runs(text)
        else:
            words = [SPACE + w for w in text[1:].split(SPACE)]
        ids = list(map(known.get, words))
        k = -1
        for _ in range(ids.count(None)):
            k = ids.index(None, k + 1)
            ids[k] = known.get(words[k]) or self.fresh(words[k])
        return b"".join(ids)

    def decode(self, ids: list[int]) -> str:
        """The text of ids: without the space before it, control ids nothing, bytes that are no text U+FFFD each."""
        if self.control.isdisjoint(ids):
            return self.decoded(ids, True)
        cut = [-1, *(k for k, i in enumerate(ids) if i in self.control), len(ids)]  # they part the bytes around them
        runs = [ids[a + 1 : b] for a, b in zip(cut, cut[1:], strict=False) if b > a + 1]
        return "".join(self.decoded(x, k == 0) for k, x in enumerate(runs))

    def decoded(self, ids: list[int], first: bool) -> str:
        of = self.bytes_of
        raw = b"".join([of[i] for i in ids])
        if first and raw[:1] == b" " and ids[0] != self.byte_id[0x20]:
            raw = raw[1:]
        return raw.decode("utf-8", "ridgeline-each-byte")


@lru_cache(maxsize=2)
def pieces_of(model_path: str) -> Pieces:
    """One a worker."""
    return Pieces(model_path)


def encoded(docs: DataFrame, keep: list[str], model_path: str, text_col: str = "text") -> DataFrame:
    """The columns of keep, and n_tokens long, ids binary (4 bytes an id), ids_sha256, decoded_sha256."""
    def make():
        model = pieces_of(model_path)

        def f(piece: pa.RecordBatch) -> dict:
            data, off = flat(piece.column(text_col))
            raw = data.tobytes()
            ids = [model.encode(raw[off[k] : off[k + 1]].decode("utf-8")) for k in range(piece.num_rows)]
            lists = [np.frombuffer(x, np.int32).tolist() for x in ids]
            return {c: piece.column(c) for c in keep} | {
                "n_tokens": np.array([len(x) for x in lists], np.int64), "ids": ids,
                "ids_sha256": [hashlib.sha256(",".join([model.names[i] for i in x]).encode()).hexdigest() for x in lists],
                "decoded_sha256": [hashlib.sha256(model.decode(x).encode()).hexdigest() for x in lists],
            }

        return f

    return map_texts(docs, [*keep, text_col], schema_of(docs, keep, "n_tokens long, ids binary, ids_sha256 string, decoded_sha256 string"), make, text_col)
