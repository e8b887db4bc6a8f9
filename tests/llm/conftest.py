import random

import pytest

ALPHABET = ["the", "of", "and", "to", "été", "für", "ñu", "Zug", "x", "lorem", "ipsum", "dolor", "Ω", "🙂"]


def some_text(rnd: random.Random, words: int) -> str:
    return " ".join(rnd.choice(ALPHABET) + str(rnd.randrange(40)) for _ in range(words))


def documents(seed: int = 1) -> list[tuple]:
    """Nulls in any column, empty and very long texts, repeated rows, near copies, shared passages."""
    rnd = random.Random(seed)
    base, passage = some_text(rnd, 80), some_text(rnd, 60)
    texts = [None, "", " \t\n", "word", "a b c", base, base, base + " tail", "head " + base, base.upper()]
    texts += [some_text(rnd, rnd.randrange(5, 120)) for _ in range(12)]
    texts += [some_text(rnd, 30) + "\n" + passage + "\n" + some_text(rnd, 30) for _ in range(5)]
    texts += [some_text(rnd, 6000), "ab " * 400, "line one\nline one\nline two\n\nline one", "ééé" * 90]
    texts += ["Licensed under CC BY-NC 4.0.\n" + base, "see the MIT License, mit license", "x" * 700]
    rows = [(k, t, "en" if k % 3 else None, f"s{k % 4}" if k % 5 else None) for k, t in enumerate(texts)]
    return [*rows, (5, base, "en", "s1"), (None, base, "en", "s1"), (None, None, None, None)]


SCHEMA = "doc_id long, text string, lang string, source string"


@pytest.fixture(scope="session")
def edge_rows():
    return documents()


@pytest.fixture(scope="session")
def edge_docs(spark, edge_rows):
    return spark.createDataFrame(edge_rows, SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)
