import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, sequence_id string, slot string, component string, hashes int"


def words(rng, n, letters="abcdefghijklm"):
    return " ".join("".join(rng.choice(letters) for _ in range(rng.randint(2, 8))) for _ in range(n))


@pytest.fixture(scope="session")
def corpus():
    """(doc_id, text): prose, copies, near copies, shared passages, repeated rows, odd texts."""
    rng = random.Random(5)
    prose = [words(rng, rng.choice([5, 30, 120, 400])) for _ in range(40)]
    passage = words(rng, 60)
    out = [(n, t) for n, t in enumerate(prose)]
    out += [(100 + n, prose[n]) for n in range(6)]
    out += [(200 + n, prose[3] + "\n" + words(rng, 3)) for n in range(3)]
    out += [(300 + n, words(rng, 20) + " " + passage + " " + words(rng, 25)) for n in range(5)]
    out += [(400, ""), (401, None), (402, " \n\t "), (403, "é" * 300), (404, "漢字 かな 🙂 " * 40), (405, "x")]
    out += [(406, "Ab ab " * 200), (407, words(rng, 9000)), (408, "a\nb\na\nb\n" * 30), (409, "\x1c\x00 nul")]
    out += [(1, prose[1]), (None, prose[2]), (None, None), (410, "-1"), (-7, words(rng, 15))]
    return out


@pytest.fixture(scope="session")
def docs(spark, corpus):
    """The corpus with the usual columns, some null, and others whose names clash with results."""
    rows = [
        (d, t, ("en", "de", None)[n % 3], None if n % 7 == 0 else f"src{n % 4}", None if t is None else len(t), "s", "x", "c", 1)
        for n, (d, t) in enumerate(corpus)
    ]
    return spark.createDataFrame(rows, SCHEMA).repartition(5)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture
def as_rows():
    def collect(df, *columns):
        return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)

    return collect
