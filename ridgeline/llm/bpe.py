"""Byte-level BPE encoding and decoding with content-defined chunk reuse.

A text is cut into chunks where a rolling hash of the last bytes says so, so that copies and shared passages
fall into the same chunks wherever they stand. A distinct chunk is encoded once in a batch and then found in
a table. Encoding a chunk by itself can differ from encoding it in its text near its ends, so each chunk knows
its first and last safe cut: a place between two pre-tokens whatever stands further out. What lies between the
cuts is the chunk's own ids. A join, from one chunk's last safe cut to the next one's first, is encoded again as
one piece; a chunk without a safe cut goes into the join whole, which grows until both its ends are safe. Ends
of texts are safe. So the ids agree exactly with those of the whole text.

Ids are the tokenizers library's. A pre-token met before is taken from a table of bounded size; a new one is
merged by tiktoken's core where its vocabulary file is given and by tokenizers itself elsewhere; the tests hold
both against tokenizers on whole texts. A text with the string of an added token is encoded by tokenizers whole,
since such strings are cut out before anything else.

Cases: null and empty texts have no ids; texts of any length and script are read whole; rows may repeat.
"""

from __future__ import annotations

import base64
import hashlib
import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from tokenizers import Tokenizer

from ridgeline.llm.shared import map_texts, schema_of
from ridgeline.llm.textgrid import Rolling, U

#: Pre-tokens and joins that a worker keeps; the table starts anew beyond that.
CACHE = 100_000
#: A cut where the hash of WINDOW bytes ends in CUT_BITS zero bits: one in 2**CUT_BITS places.
WINDOW, CUT_BITS = 24, 9
# Fixed value: the pre-tokens of byte-level BPE vocabularies, as regex's syntax has them.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
# The same over Latin letters of U+0000 to U+02AF, in re's syntax, which is twice as fast there.
_LATIN = "A-Za-zªµºÀ-ÖØ-öø-ʯ"
_FAST = re.compile(rf"'(?:[stmd]|re|ve|ll)| ?[{_LATIN}]+| ?[0-9²³¹¼-¾]+| ?[^\s{_LATIN}0-9²³¹¼-¾]+|\s+(?!\S)|\s+")
# Letters and digits beyond the fast table, and what the two engines call space differently.
_SLOW = re.compile(r"[^\x00-\x1b\x20-\x84\x86-ʯ–-‧‰-⁞€]")
#: Letter, space, letter: a pre-token always ends before that space.
_SAFE = re.compile(r"(?<=[A-Za-zÀ-ÖØ-öø-ʯ]) (?=[A-Za-zÀ-ÖØ-öø-ʯ])")


class Encoder:
    """Exact ids as little-endian unsigned 32-bit bytes (2 bytes where the vocabulary has room)."""

    def __init__(self, tokenizer_path: str, ranks_path: str | None = None):
        import regex

        self.tokenizer = Tokenizer.from_file(tokenizer_path)
        self.tokenizer.no_padding()
        self.tokenizer.no_truncation()
        self.dtype = np.dtype("<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4")
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.any_script = regex.compile(PATTERN)
        self.known: dict[str, bytes] = {}
        self.core = None
        if ranks_path is not None:
            import tiktoken

            with open(ranks_path, "rb") as f:
                ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
            self.core = tiktoken.Encoding("pieces", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})._core_bpe.encode_single_piece

    def whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, self.dtype).tobytes()

    def is_plain(self, text: str) -> bool:
        return not any(a in text for a in self.added)

    def plain(self, text: str) -> bytes:
        """Ids of a text without added tokens, pre-token by pre-token."""
        found = (self.any_script if _SLOW.search(text) else _FAST).findall(text)
        known = self.known
        try:
            return b"".join([known[p] for p in found])
        except KeyError:
            if len(known) > CACHE:
                known.clear()
            for p in set(found).difference(known):
                known[p] = np.array(self.core(p.encode()), self.dtype).tobytes() if self.core else self.whole(p)
            return b"".join([known[p] for p in found])

    def encode(self, text: str) -> bytes:
        return self.plain(text) if self.is_plain(text) else self.whole(text)


@lru_cache(maxsize=2)
def encoder(tokenizer_path: str, ranks_path: str | None = None) -> Encoder:
    """One a worker."""
    return Encoder(tokenizer_path, ranks_path)


def boundaries(data: np.ndarray, off: np.ndarray) -> list[np.ndarray]:
    """Places of each text's chunk ends, as bytes from its start: content-defined, never inside a character, the end last."""
    out = []
    n = len(off) - 1
    at = np.zeros(0, np.int64)
    if len(data) > WINDOW:
        at = np.flatnonzero((Rolling(data).grams(WINDOW) & U((1 << CUT_BITS) - 1)) == 0) + WINDOW
        at = at[at < len(data)]
        at = at[(data[at] & 0xC0) != 0x80]
    lo = np.searchsorted(at, off[:-1] + WINDOW, "left")  # a window never reaches into the text before
    hi = np.searchsorted(at, off[1:], "left")
    for k in range(n):
        own = at[lo[k] : max(lo[k], hi[k])] - off[k]
        out.append(np.append(own, off[k + 1] - off[k]) if off[k + 1] > off[k] else own)
    return out


Chunk = tuple[str, bytes, str] | None


def split_chunk(text: str, enc: Encoder) -> Chunk:
    """(before the first safe cut, ids between, after the last safe cut); None without a safe cut."""
    first = _SAFE.search(text)
    if first is None:
        return None
    lo = first.start()
    tail = text.rfind(" ")
    while not _SAFE.match(text, tail):
        tail = text.rfind(" ", 0, tail)
    return text[:lo], enc.plain(text[lo:tail]), text[tail:]


class ChunkReuse:
    """Encodes texts chunk by chunk; keeps what a batch has met."""

    def __init__(self, enc: Encoder):
        self.enc = enc
        self.chunks: dict[str, Chunk] = {}
        self.joins: dict[str, bytes] = {}
        self.met = self.made = 0

    def batch(self, data: np.ndarray, off: np.ndarray) -> list[bytes]:
        if len(self.chunks) > CACHE // 20:
            self.chunks.clear()
        if len(self.joins) > CACHE // 4:
            self.joins.clear()
        raw = data.tobytes()
        out = []
        for k, cuts in enumerate(boundaries(data, off)):
            text_bytes = raw[off[k] : off[k + 1]]
            text = text_bytes.decode("utf-8")
            if not self.enc.is_plain(text):
                out.append(self.enc.whole(text))
                continue
            ids, join, lo = [], "", 0
            for hi in cuts.tolist():
                chunk = text_bytes[lo:hi].decode("utf-8")
                lo = hi
                self.met += 1
                if chunk in self.chunks:
                    parts = self.chunks[chunk]
                else:
                    self.made += 1
                    parts = self.chunks[chunk] = split_chunk(chunk, self.enc)
                if parts is None:
                    join += chunk
                    continue
                ids += [self.joined(join + parts[0]), parts[1]]
                join = parts[2]
            ids.append(self.joined(join))
            out.append(b"".join(ids))
        return out

    def joined(self, text: str) -> bytes:
        """A join, encoded from one safe cut to the next."""
        found = self.joins.get(text)
        if found is None:
            found = self.enc.plain(text)
            if len(text) < 200:
                self.joins[text] = found
        return found


def byte_values() -> dict[str, int]:
    """The bytes that byte-level vocabularies write as printable characters: printable ones as themselves, the rest from U+0100 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(0x100 + i): b for i, b in enumerate(hidden)}


@lru_cache(maxsize=2)
def vocabulary(tokenizer_path: str) -> tuple[list[bytes], list[str]]:
    """(bytes, decimal name) of each id."""
    t = Tokenizer.from_file(tokenizer_path)
    values = byte_values()
    added = {i: a.content.encode() for i, a in t.get_added_tokens_decoder().items()}
    size = max([*t.get_vocab().values(), *added]) + 1
    of: list[bytes] = [b""] * size
    for token, i in t.get_vocab().items():
        of[i] = added[i] if i in added else bytes(values[c] for c in token)
    return of, [str(i) for i in range(size)]


def decoded(ids: list[int], tokenizer_path: str) -> str:
    """As the library's decode(ids, skip_special_tokens=False)."""
    of, _ = vocabulary(tokenizer_path)
    return b"".join([of[i] for i in ids]).decode("utf-8", "replace")


def encoded(docs: DataFrame, keep: list[str], tokenizer_path: str, ranks_path: str | None = None, text_col: str = "text") -> DataFrame:
    """The columns of keep, and n_tokens long, ids binary (little-endian, 2 or 4 bytes an id), id_bytes int, ids_sha256, decoded_sha256."""
    def make():
        enc = encoder(tokenizer_path, ranks_path)
        reuse = ChunkReuse(enc)
        of, names = vocabulary(tokenizer_path)

        def f(piece: pa.RecordBatch) -> dict:
            from ridgeline.llm.shared import flat

            ids = reuse.batch(*flat(piece.column(text_col)))
            lists = [np.frombuffer(b, enc.dtype).tolist() for b in ids]
            return {c: piece.column(c) for c in keep} | {
                "n_tokens": np.array([len(x) for x in lists], np.int64), "ids": ids, "id_bytes": np.full(len(ids), enc.dtype.itemsize, np.int32),
                "ids_sha256": [hashlib.sha256(",".join([names[i] for i in x]).encode()).hexdigest() for x in lists],
                "decoded_sha256": [hashlib.sha256(b"".join([of[i] for i in x]).decode("utf-8", "replace").encode()).hexdigest() for x in lists],
            }

        return f

    return map_texts(docs, [*keep, text_col], schema_of(docs, keep, "n_tokens long, ids binary, id_bytes int, ids_sha256 string, decoded_sha256 string"), make, text_col)
