import random

import pytest

# A few syllables make words that repeat, so that passages and sets overlap.
WORDS = [a + b for a in "ka lo mi ré tu".split() for b in "na st er ou ti xs".split()]


def passage(seed: int, words: int) -> str:
    rng = random.Random(seed)
    return " ".join(rng.choice(WORDS) for _ in range(words))


def changed(text: str, seed: int, times: int) -> str:
    rng, words = random.Random(seed), text.split(" ")
    for _ in range(times):
        words[rng.randrange(len(words))] = rng.choice(WORDS)
    return " ".join(words)


def corpus() -> list[tuple]:
    """(doc_id, text): nulls, empty texts, ties, copies, near copies, shared
    passages, a text that repeats itself, odd white space, and a long text."""
    base, hot = passage(1, 120), passage(2, 90)
    texts = [base, base, changed(base, 3, 1), changed(base, 4, 2), changed(base, 5, 9), base.upper()]
    texts += [f"{passage(10 + i, 40)} {hot} {passage(30 + i, 30 + i)}" for i in range(8)]
    texts += [f"{passage(50, 14)}\n" * 4, f"{hot}\t\n {hot}", passage(51, 13), passage(52, 12), passage(53, 3)]
    texts += [passage(53, 3), None, "", "  \n\t", "é", "x" * 3000, "a b " * 400, passage(60, 9000)]
    rows = [(i * 3, text) for i, text in enumerate(texts)]
    return [*rows, (0, base), (None, base), (None, passage(70, 50)), (9, rows[3][1])]


@pytest.fixture(scope="session")
def documents(spark):
    """The corpus with columns whose names the operators use themselves."""
    rows = [(i, t, "en", "s", 1, 7, b"x", 2) for i, t in corpus()]
    schema = "doc_id long, text string, lang string, source string, n_chars long, id long, c binary, number int"
    return spark.createDataFrame(rows, schema).repartition(3)


@pytest.fixture
def no_documents(documents):
    return documents.limit(0)
