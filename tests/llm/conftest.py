import random

import pytest

SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, score double, spans string, row int, "
          "key string, kind string, text_crc32 string")


def rows_of(texts, ids=None):
    ids = range(len(texts)) if ids is None else ids
    return [(i, t, None, "src", None if t is None else len(t), None, "x", 1, "k", None, "c") for i, t in zip(ids, texts)]


def invented(seed, words=60, vocabulary=400):
    rng = random.Random(seed)
    syllables = ["ba", "re", "tion", "ou", "ça", "né", "st", "ing", "qu", "zo", "ei"]
    known = ["".join(rng.choice(syllables) for _ in range(rng.randint(1, 4))) for _ in range(vocabulary)]
    return " ".join(rng.choice(known) for _ in range(words))


@pytest.fixture(scope="session")
def odd(spark):
    """Null and empty texts, null ids, repeated rows, copies, near copies, a long text, clashing columns."""
    base = [invented(i) for i in range(12)]
    passage = invented(99, 40)
    near = base[0].split()
    near[30] = "changed"
    texts = [*base, None, "", "   \n\t", "one two", base[0], " ".join(near), base[1], base[1], passage + " " + base[2],
             base[3] + " " + passage, passage, "x" * 250 + " " + "y" * 130 + "x" * 250, "😀 ça\x85va \x1c " + base[4],
             "\n".join([base[5]] * 3), invented(7, 20_000), "password = \"Zx9Qw3Er5Ty7Ui1Op\" end",
             "call +1 (743) 555-3824 or a.b@c.example.com at 10.0.0.1 card 4111 1111 1111 1111 ok"]
    rows = rows_of(texts)
    rows.append(rows[5])                                # a repeated row
    rows += rows_of([base[6], None, base[7]], [None, None, None])
    return spark.createDataFrame(rows, SCHEMA).repartition(5)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def no_labels(spark):
    return spark.createDataFrame([], "doc_id long, quality int, toxic int")
