import random

import pytest

WORDS = ["lo", "mi", "ren", "sa", "to", "quel", "vor", "An", "THE", "the", "née", "größe", "x1", "--", "é"]


def prose(rng: random.Random, n: int) -> str:
    return " ".join(rng.choice(WORDS) + str(rng.randrange(40)) for _ in range(n))


@pytest.fixture(scope="session")
def texts():
    """Texts by id: copies, near copies, a shared passage, a repeating text, short, empty, null and a very long one."""
    rng = random.Random(3)
    base = [prose(rng, n) for n in (60, 200, 35, 34, 4, 5, 1, 120, 90, 300)]
    out = dict(enumerate(base))
    for k in range(8):  # near copies of text 1: one word in forty changed
        words = base[1].split()
        words[10 + 20 * k] = f"changed{k}"
        out[20 + k] = " ".join(words)
    passage = prose(rng, 45)
    for k in range(6):
        out[40 + k] = prose(rng, 50) + "\n" + passage + "\t" + prose(rng, 30)
    out |= {60: base[0], 61: base[0].upper(), 62: base[4], 63: "", 64: "  \n ", 65: None, 66: "Orre " * 400, 67: prose(rng, 8000), 68: None}
    out |= {70: base[2] + "  " + base[2], 71: "\x1cone\xa0word " + base[3], 72: base[9] + " " + base[7]}
    return out


@pytest.fixture(scope="session")
def docs(spark, texts):
    """The texts as documents with another column order, a null id, a repeated row and columns with clashing names."""
    rows = [(t, i, f"src{i % 3}" if i % 7 else None, i, "k", 1.0) for i, t in texts.items()]
    rows += [(texts[1], None, "src1", 0, "k", 1.0), (texts[0], 0, None, 0, "k", 1.0)]
    return spark.createDataFrame(rows, "text string, doc_id long, source string, n long, key string, score double").repartition(3)


@pytest.fixture(scope="session")
def no_docs(docs):
    return docs.limit(0)
