import random
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent))

# Names that the operators use for columns of their own.
CLASHING = "chunk string, bucket long, label string, x string, id long, row long, n long, found_n string, spans string, c0 string, copy int, quality string, secrets string"


def texts(seed: int, n: int = 50) -> list[tuple]:
    """(doc_id, text): random texts over few words with shared passages, runs of one word, copies, nulls and repeated rows."""
    rng = random.Random(seed)
    words = ["".join(rng.choices("abé", k=rng.randint(1, 3))) for _ in range(14)] + ["Und", "X9", "1.2.3.4", "a@b.co"]
    docs = []
    for i in range(n):
        t = " ".join(rng.choices(words, k=rng.randint(0, 90)))
        if docs and rng.random() < 0.5:
            s = rng.choice(docs)[1] or ""
            a = rng.randint(0, len(s))
            t = t[:rng.randint(0, len(t))] + s[a:a + rng.randint(0, 300)] + t[rng.randint(0, len(t)):]
        if rng.random() < 0.1:
            t = (rng.choice(words) + " ") * rng.randint(1, 80) + t
        if docs and rng.random() < 0.1:
            t = rng.choice(docs)[1]
        docs.append((i * 3 + 1, t))
    docs += [(900, None), (901, ""), (902, " \n\t "), docs[3], docs[3], (None, docs[4][1]), (None, None)]
    docs.append((903, (docs[5][1] or "") + " long" * 4000 + " é😀 " + "z" * 30000))
    rng.shuffle(docs)
    return docs


@pytest.fixture(scope="session")
def given():
    return texts(1)


@pytest.fixture(scope="session")
def documents(spark, given):
    return with_clashes(spark, given)


@pytest.fixture(scope="session")
def nothing(spark):
    return with_clashes(spark, [])


def with_clashes(spark, docs):
    rows = [(d, t, *([None] * CLASHING.count(",")), "kept") for d, t in docs]
    return spark.createDataFrame(rows, f"doc_id long, text string, {CLASHING}").repartition(3)


def plain(rows):
    return sorted(map(repr, rows))
