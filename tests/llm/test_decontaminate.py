import hashlib
import re

import pytest

from keepsake.llm import decontaminate

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def brute_force(corpus, items):
    patterns = {}
    for item, text in items:
        w = words(text)
        for k in range(max(1, len(w) - 9) if w else 0):
            patterns.setdefault(tuple(w[k : k + 10]), set()).update([] if item is None else [str(item)])
    out = []
    for doc_id, text in corpus:
        w, hit, named = words(text), set(), set()
        for m in {len(p) for p in patterns}:
            for k in range(len(w) - m + 1):
                if tuple(w[k : k + m]) in patterns:
                    hit.update(range(k, k + m))
                    named |= patterns[tuple(w[k : k + m])]
        digest = hashlib.sha256(",".join(sorted(named)).encode()).hexdigest()
        out.append((doc_id, len(w), len(hit), len(named), digest, bool(hit)))
    return sorted(out, key=repr)


@pytest.fixture(scope="module")
def items(corpus):
    texts = dict(corpus)
    some = words(texts[4])
    return [
        (1, texts[300].upper()),
        (2, " -- ".join(some[3:22])),
        (10, " ".join(some[5:17])),
        (3, "漢字, かな"),
        (4, "x"),
        (5, ""),
        (6, None),
        (7, "Ab ab ab"),
        (7, "ab ab ab"),
        (None, " ".join(some[:10])),
        (8, "nothing like this occurs anywhere in the given texts at all"),
    ]


@pytest.mark.parametrize("block", [200_000, 7])
def test_against_brute_force(spark, docs, corpus, items, block, as_rows):
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    found = decontaminate.digest(decontaminate.scan(docs, benchmark, block=block))
    assert as_rows(found, *found.columns) == brute_force(corpus, items)
    clean = decontaminate.clean(docs, benchmark, block=block)
    assert clean.schema == docs.schema
    wanted = sorted((r[0] for r in brute_force(corpus, items) if not r[5]), key=repr)
    assert [r[0] for r in as_rows(clean, "doc_id")] == wanted


def test_empty_tables(spark, docs, no_docs, corpus, items):
    nothing = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.digest(decontaminate.scan(docs, nothing)).where("contaminated").count() == 0
    assert decontaminate.clean(docs, nothing).count() == len(corpus)
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    assert decontaminate.digest(decontaminate.scan(no_docs, benchmark)).count() == 0


def test_shifts_skip_words():
    pattern = tuple(b"w%d" % n for n in range(10))
    table = decontaminate.WuManber({pattern: {"1"}})
    looked = []

    class Seen(dict):
        def get(self, key, default):
            looked.append(key)
            return dict.get(self, key, default)

    table.shift = Seen(table.shift)
    text = [b"other"] * 900 + list(pattern) + [b"other"] * 900
    assert [end for end, _ in table.find(text)] == [910]
    assert len(looked) < len(text) / 7
