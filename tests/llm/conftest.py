import random

import pytest

SYLLABLES = "an er th in on re at or en es ing ed".split()


def prose(rng: random.Random, n: int) -> str:
    out = []
    for i in range(n):
        w = "".join(rng.choice(SYLLABLES) for _ in range(rng.randint(1, 4)))
        out.append(w.capitalize() if i % 11 == 0 else w + "." if i % 11 == 10 else w)
    return " ".join(out)


@pytest.fixture(scope="session")
def odd(spark):
    """Null, empty, blank, very long, repeated and odd rows, with extra columns of clashing names."""
    rng = random.Random(5)
    long = prose(rng, 30_000)
    texts = [
        None, "", " \t\n", "one", "Ärger ßo İx  y", long, long, "\n".join([prose(rng, 60)] * 5), "a" * 50_000,
        "the end. " * 40, "#$%& " * 30, prose(rng, 80), "IDIOT you\nare", "x\x1cy z\x85w",
    ]
    names = ["n", "fp", "h", "o", "key", "word", "rate", "seed", "_id", "_h", "salt", "host", "y", "item_id", "domain", "same"]
    rows = [(i, t, "en", "s0" if i % 3 else None, 5, *[i] * len(names)) for i, t in enumerate(texts)]
    rows += [rows[5], rows[11], rows[0]]  # repeated rows
    rows += [(None, "no id here but words enough to be kept by all of them " * 3, None, None, None, *[0] * len(names)),
             (3, "another text under a known id", "en", "s1", 1, *[0] * len(names))]
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint, " + ", ".join(f"{n} int" for n in names)
    return spark.createDataFrame(rows, schema)


@pytest.fixture(scope="session")
def labels(spark):
    rows = [(i, int(i % 4 != 0), int(i % 5 == 0)) for i in range(40)] + [(1, 0, 0), (None, 1, 1), (2, None, None)]
    return spark.createDataFrame(rows, "doc_id bigint, quality int, toxic int")


@pytest.fixture(scope="session")
def rng():
    return random.Random(11)


@pytest.fixture(scope="session")
def text(rng):
    return lambda n: prose(rng, n)


@pytest.fixture(scope="session")
def sf():
    return "/root/testdata/sf0.001"
