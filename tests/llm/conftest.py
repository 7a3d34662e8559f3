import random

import pytest

SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, "
    # Columns that a table may bring along, named like those that operators use inside.
    "key string, bucket int, shard int, slot long, score double, kept boolean, component_id long, word string, c long, size long, id long, comp long, label string"
)
EXTRA = ("x", 1, 2, 3, 0.5, True, 9, "w", 4, 5, 6, 7, "l")


def words(n: int, seed: int) -> str:
    r = random.Random(seed)
    return " ".join("".join(r.choices("abcdeinorst", k=r.randint(1, 7))) for _ in range(n))


def rows() -> list[tuple]:
    base = words(120, 1)
    edited = base.split()
    edited[60] = "edited"
    passage = words(50, 2)
    texts = [
        (0, base, "en"),
        (1, base.replace(" ", "\n"), "en"),
        (2, " ".join(edited), "en"),
        (3, base, "en"),
        (4, None, "en"),
        (5, "", "fr"),
        (6, " \t\n\x0b\x0c\r", None),
        (7, "word", "fr"),
        (8, "Word", "fr"),
        (9, "one two three four", "de"),
        (10, "12 34 !!", "de"),
        (11, words(40, 3) + " " + passage + " " + words(40, 4), "en"),
        (12, words(30, 5) + " " + passage + " " + words(70, 6), "en"),
        (13, (words(20, 7) + "\n") * 30, "en"),
        (14, words(30_000, 8), "en"),
        (15, "ñandú 漢字 😀 été " * 8, "es"),
        (16, "x" * 50_000, "es"),
        (None, words(60, 9), "fr"),
        (None, None, None),
        (-5, words(60, 10), "fr"),
        (3, base, "en"),  # a repeated row
        (7, "word", "fr"),
        # Different texts without an id or with a shared one, which hold the same passage.
        (None, words(30, 21) + " " + passage + " " + words(30, 22), "en"),
        (None, passage + " " + words(45, 23), "en"),
        (11, words(25, 24) + " " + passage, "en"),
        (11, "two", "fr"),
    ]
    return [(i, t, lang, f"s{(i or 0) % 3}", None if t is None else len(t), *EXTRA) for i, t, lang in texts]


@pytest.fixture(scope="session")
def odd(spark):
    return spark.createDataFrame(rows(), SCHEMA).repartition(3).persist()


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def plain_rows():
    return [r[:3] for r in rows()]
