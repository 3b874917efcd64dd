import hashlib
import random

import numpy as np
import pytest
from sentencepiece import SentencePieceProcessor

from ridgeline.llm import pieces, queries
from ridgeline.llm.queries import piece_model


@pytest.fixture(scope="module")
def model():
    return pieces.pieces_of(piece_model())


@pytest.fixture(scope="module")
def library():
    return SentencePieceProcessor(model_file=piece_model())


def ids_of(model, text):
    return np.frombuffer(model.encode(text), np.int32).tolist()


def plain_merges(model, text):
    """Merging as the algorithm is defined: the neighbours whose piece ranks first, the leftmost of equals."""
    parts = list(text)
    while True:
        ranked = [(model.rank[a + b], k) for k, (a, b) in enumerate(zip(parts, parts[1:], strict=False)) if a + b in model.rank]
        if not ranked:
            return parts
        k = min(ranked)[1]
        parts[k : k + 2] = [parts[k] + parts[k + 1]]


def test_tokens_are_those_of_merging(model):
    rng = random.Random(2)
    names = list(model.id_of)
    for _ in range(300):
        word = "".join(rng.choice(names) for _ in range(rng.randint(1, 5)))
        assert model.tokens(word) == plain_merges(model, word)
    for letters in ("ab", "aei", "sch", "▁ t"):
        word = "".join(rng.choice(letters) for _ in range(40))
        assert model.tokens(word) == plain_merges(model, word)


def test_every_script_and_space(model, library):
    rng = random.Random(4)
    names, chars = list(model.id_of), [p for p in model.id_of if len(p) == 1]
    texts = ["", " ", "   ", "▁", "a▁ b", "\n\n", "x" * 3000, "ab" * 700, "中文字符测试" * 60, "😀é\u0000", "<s></s><unk><0x0A>", "m².a ².", "��", "  　", "1234567890" * 5, "a" + " " * 40 + "b ", "https://a.b/c?d=e&f_g=1"]
    texts += ["".join(rng.choice(chars) for _ in range(rng.randint(1, 60))) for _ in range(500)]
    texts += ["".join(rng.choice(names) for _ in range(rng.randint(1, 12))).replace("▁", rng.choice(" ▁")) for _ in range(1500)]
    texts += ["".join(rng.choice("aeinst ▁.,\n²'") for _ in range(rng.randint(1, 80))) for _ in range(1500)]
    for t in texts:
        ids = ids_of(model, t)
        assert ids == library.encode(t), t
        assert model.decode(ids) == library.decode(ids), t


def test_any_ids_decode_as_the_library_does(model, library):
    rng = random.Random(6)
    for _ in range(3000):
        ids = [rng.choice([rng.randrange(3, 32000), rng.randrange(3, 259), rng.randrange(1, 3), 259]) for _ in range(rng.randint(0, 8))]
        assert model.decode(ids) == library.decode(ids), ids


def test_table_starts_anew(model, library, monkeypatch):
    monkeypatch.setattr(pieces, "KEPT", 3)
    monkeypatch.setattr(pieces, "PAIRS", 3)
    for t in ("one two, three four five", "one two, three", "six seven"):
        assert ids_of(model, t) == library.encode(t)


def test_whole_rows(spark, docs, rows, empty, library):
    got = pieces.encoded(docs, ["doc_id", "kept"], piece_model()).collect()

    def sha(t):
        return hashlib.sha256(t.encode()).hexdigest()

    def plain(t):
        ids = library.encode(t or "")
        return len(ids), sha(",".join(map(str, ids))), sha(library.decode(ids))

    assert sorted((r.doc_id or -1, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in got) == sorted((i or -1, *plain(t)) for i, t in rows)
    assert all(np.frombuffer(r.ids, np.int32).size == r.n_tokens and r.kept == "yes" for r in got)
    assert pieces.encoded(empty, ["doc_id"], piece_model()).count() == 0
    with pytest.raises(ValueError):
        pieces.encoded(docs.withColumnRenamed("bucket", "ids"), ["ids"], piece_model())


def test_query(spark, tmp_path, docs, rows):
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    out = queries.op13_prefix_table_pieces(spark, str(tmp_path))
    assert out.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"] and out.count() == len(rows)
