import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score double, kept string, spans int, `_block` int, bucket string"
WORDS = "the of and river stone light garden window morning paper silver market winter silent table orange maple cloud harbor lantern été über niño straße".split()


def prose(rng: random.Random, n: int) -> str:
    return " ".join(rng.choice(WORDS) + rng.choice(["", "", "", ".", ","]) for _ in range(n))


def corpus() -> list[tuple[int | None, str | None]]:
    """Nulls, empty and blank texts, equal rows, copies, near copies, shared passages, a long text, a null id."""
    rng = random.Random(3)
    base = prose(rng, 150)
    passage = prose(rng, 40)
    rows: list[tuple[int | None, str | None]] = [(1, None), (2, ""), (3, " \n\t "), (4, base), (5, base), (5, base), (6, base.replace("river", "delta", 1)), (None, base), (None, None)]
    rows += [(10 + i, prose(rng, 60) + "\n" + passage + "\n" + prose(rng, 30)) for i in range(6)]
    rows += [(20 + i, prose(rng, rng.choice([1, 2, 3, 5, 80]))) for i in range(12)]
    rows += [(40, prose(rng, 60_000)), (41, "x" * 3000), (42, "x" * 2000), (43, "ab " * 700), (44, "ab " * 500), (45, "Licensed under the MIT License. <|endoftext|> 中文 😀"), (46, "Licensed\nunder the\nGNU general PUBLIC license, version 3")]
    return rows


@pytest.fixture(scope="session")
def rows():
    return corpus()


@pytest.fixture(scope="session")
def docs(spark, rows):
    full = [(i, t, "en", "src", None if t is None else len(t), 0.5, "yes", 7, 1, "b") for i, t in rows]
    return spark.createDataFrame(full, SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)
