"""Sample rows and the fixture that the tests of this folder share."""

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, id long, score string, kept string"


@pytest.fixture(scope="session")
def documents(spark):
    """Rows with NULLs, empty, long and repeated texts, and columns named like the operators' own."""

    def make(texts):
        rows = [(k, t, "en", "s", None if t is None else len(t), 7, "x", "y") for k, t in texts]
        frame = spark.createDataFrame(rows, SCHEMA)
        path = f"{spark.conf.get('spark.checkpoint.dir')}/in-{abs(hash(str(texts)))}"
        frame.write.mode("overwrite").parquet(path)
        return spark.read.parquet(path)

    return make


def prose(seed, n, words=400):
    import random

    r = random.Random(seed)
    return " ".join(f"w{int(r.paretovariate(0.6)) % words}" for _ in range(n))


BASE = prose(1, 120)
EDGE = [
    (1, BASE),
    (2, BASE),
    (3, None),
    (4, ""),
    (5, " \n\t "),
    (6, "One two"),
    (7, "one TWO"),
    (None, prose(2, 60)),
    (None, None),
    (8, BASE.replace(" w1 ", " changed ", 1) + " tail"),
    (9, prose(3, 30_000)),
    (10, prose(4, 40) + " " + BASE + " " + prose(5, 40)),
    (11, "aé中### don't\n\n  x12 !! y"),
    (12, prose(6, 80)),
    (12, prose(6, 80)),
]
