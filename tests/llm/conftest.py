import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score double, ids string, _crc string, size string"


@pytest.fixture(scope="session")
def words():
    rng = random.Random(5)
    return ["".join(rng.choice(["ba", "ko", "the", "ri", "n", "um", "é"]) for _ in range(rng.randint(1, 4))) for _ in range(400)]


@pytest.fixture(scope="session")
def rows(words):
    """Plain texts, near copies, exact copies, nulls, blanks, repeated rows and a long text."""
    rng = random.Random(6)
    text = lambda n: " ".join(rng.choice(words) for _ in range(n))
    out, base = [], [text(80) for _ in range(12)]
    for i, t in enumerate(base):
        out.append((i, t, rng.choice(["en", "de"]), f"s{i % 4}"))
    for k in range(30):             # a chain and a star of edits of one text
        t = base[0].split()
        for _ in range(k % 6):
            t[rng.randrange(len(t))] = rng.choice(words)
        out.append((100 + k, " ".join(t), "en", "hot"))
    out += [(200 + k, base[1], "en", "hot") for k in range(6)]
    out += [(300, None, None, None), (301, "", "en", "s1"), (302, " \t\n", "en", None), (303, "one two", "en", "s1"),
            (304, "ONE TWO", "de", "s1"), (305, "1 2 3 !!", "fr", "s2"), (306, text(4000), "en", "s3"), (306, "other text of one id", "en", "s3"),
            (None, base[2], "de", "s2"), (None, None, None, None), (5, base[5], "en", "s1"), (-7, "<|endoftext|> ok <|end|>", "en", "s1")]
    return [(a, b, c, d, None if b is None else len(b), 0.1, "x", "y", "z") for a, b, c, d in out]


@pytest.fixture(scope="session")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(3).cache()


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)
