import random
import re
from itertools import permutations

import pytest

from keepsake.llm import filter_audit

NAMES = (
    "part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"
)


def failing(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    return {
        f
        for f, bad in (
            ("A", len(words) < 50),
            ("B", len(set(words)) * 100 < len(words) * 65),
            ("C", 100 * len(re.findall("[A-Z]", text)) > 5 * len(text)),
            ("D", any(c in text for c in "#$%&*|")),
        )
        if bad
    }


def brute_force(rows, labels):
    """Every order applied document by document."""
    docs = []
    for doc_id, source, text in rows:
        fails = failing(text or "")
        copy = any(
            other is not None and doc_id is not None and other < doc_id and (t or "") == (text or "")
            for other, _, t in rows
        )
        good = any(d == doc_id and q == 1 for d, q, _ in labels if d is not None)
        toxic = any(d == doc_id and t == 1 for d, _, t in labels if d is not None)
        docs.append((source or "", fails | ({"E"} if copy else set()), good, toxic))
    out = []
    for part in {p for p, *_ in docs}:
        mine = [d for d in docs if d[0] == part]
        steps, shares = [], dict.fromkeys("ABCDE", 0)
        for order in permutations("ABCDE"):
            left = mine
            for k, f in enumerate(order):
                gone = [d for d in left if f in d[1]]
                left = [d for d in left if f not in d[1]]
                shares[f] += len(gone)
                redundant = sum(f in d[1] for d in mine) - len(gone)
                unique = sum(d[1] == {f} for d in mine)
                lost = (sum(d[2] for d in gone), sum(d[3] for d in gone))
                steps.append((f, part, "".join(order), k + 1, len(left), len(gone), redundant, unique, *lost))
        out += [(*s, shares[f]) for f, *s in steps]
    return sorted(out)


def test_against_brute_force(spark, corpus, as_rows):
    rng = random.Random(3)
    extra = [
        (500, "WORD " * 60), (501, "a $ b " * 40), (502, "Each Word Is Capital " * 20), (503, "WORD " * 60),
        (None, "WORD " * 60), (503, "WORD " * 60), (499, None), (504, " ".join(f"w{k}" for k in range(80))),
    ]
    rows = [(d, rng.choice(["a", "b", None, "", "é"]), t) for d, t in corpus + extra * 2]
    labels = [(d, rng.choice([0, 1, None, 2]), rng.choice([0, 1, None])) for d, _ in corpus + extra + extra]
    docs = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, source string, text string, part string, n int")
    marks = spark.createDataFrame([(*r, 7) for r in labels], "doc_id long, quality int, toxic int, n int")
    got = as_rows(filter_audit.audit(docs.repartition(4), marks.repartition(3)), *NAMES)
    assert sorted(got) == brute_force(rows, labels)


def test_steps_add_up(spark, docs, no_docs):
    marks = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    out = filter_audit.audit(docs, marks).collect()
    parts = {r["part"] for r in out}
    assert len(out) == 600 * len(parts)
    sizes = {r["part"]: r["n"] for r in filter_audit.cells(docs, marks).groupBy("part").agg({"n": "sum"}).withColumnRenamed("sum(n)", "n").collect()}
    for r in out:
        before = sizes[r["part"]] if r["step"] == 1 else None
        assert before is None or r["kept"] + r["removed"] == before
        assert r["unique_fails"] <= r["removed"] and r["good_lost"] == r["toxic_lost"] == 0
    assert filter_audit.audit(no_docs, marks).count() == 0


@pytest.mark.parametrize(
    ("text", "bits"),
    [(None, 1), ("", 1), ("A" * 5 + "b" * 95, 1), ("A" * 6 + "b" * 94, 5), ("|", 9), ("a " * 50, 2), ("#" * 1, 9)],
)
def test_conditions(text, bits):
    assert filter_audit.conditions(text) == bits
