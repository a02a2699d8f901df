import random

import numpy as np

from keepsake.llm import cotraining

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score string"


def made(rng, n, bad):
    words = [rng.choice("alpha beta gamma delta eps zeta eta theta".split()) + rng.choice("abcdefgh") for _ in range(60)]
    if bad:
        words = [w + rng.choice(["###", "$$"]) for w in words] if n % 2 else [*words, "idiot", "scum"]
    text = " ".join(words)
    return n, text, rng.choice(["en", "de", None]), "junk" if bad and rng.random() < 0.7 else rng.choice(["s1", "s2"]), len(text), "x"


def test_held_out_accuracy(spark):
    rng = random.Random(1)
    truth = {n: n % 4 != 0 and n % 7 != 0 for n in range(1200)}
    docs = spark.createDataFrame([made(rng, n, not g) for n, g in truth.items()], SCHEMA)
    labels = [(n, int(g or n % 3 == 0), int(not g and n % 3 == 0)) for n, g in truth.items() if n < 600]
    labels += [(None, 1, 0), (5, None, None), (1, 1, None)]
    model = cotraining.train(docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    out = cotraining.score(docs, model)
    assert out.columns == ["doc_id", "text", "lang", "source", "n_chars", "score", "kept"]
    wrong = [r["doc_id"] for r in out.collect() if r["doc_id"] >= 600 and r["kept"] != truth[r["doc_id"]]]
    assert len(wrong) <= 6


def test_rounds_take_the_surest_of_all_documents(spark, monkeypatch):
    rng = random.Random(3)
    rows = [made(rng, n, n % 4 == 0) for n in range(3600)]
    docs = spark.createDataFrame(rows + rows[700:720], SCHEMA)
    labels = spark.createDataFrame([(n, int(n % 4 != 0), 0) for n in range(600)], "doc_id long, quality int, toxic int")
    learned, views = [], []

    def fit(rows, *sizes, of=cotraining.fit):
        learned.append(list(rows.slots))
        return of(rows, *sizes)

    def calibrate(view, rows, of=cotraining.calibrate):
        views.append(of(view, rows))
        return views[-1]

    monkeypatch.setattr(cotraining, "fit", fit)
    monkeypatch.setattr(cotraining, "calibrate", calibrate)
    monkeypatch.setattr(cotraining, "ROUNDS", 1)
    cotraining.train(docs, labels)
    meta = {r[0]: cotraining.meta_slots(r[2], r[3], r[4]) for r in rows[600:]}
    text = {r[0]: cotraining.text_slots(r[1]) for r in rows[600:]}
    odds = {r[0]: views[0].log_odds(text[r[0]], cotraining.shapes(r[1])) for r in rows[600:]}
    sure = np.log(cotraining.SURE / (1 - cotraining.SURE))
    want = []
    for sign in (1, -1):
        first = sorted(odds, key=lambda d: (-sign * odds[d], d))[: cotraining.PER_ROUND]
        want += [meta[d] for d in first if sign * odds[d] >= sure]
    assert len(want) > 200 and learned[3][len(learned[1]) :] == want


def test_odd_rows_are_scored(spark, docs, corpus, no_docs):
    labels = spark.createDataFrame([(n, n % 2, 0) for n in range(40)], "doc_id long, quality int, toxic int")
    model = cotraining.train(docs, labels)
    out = cotraining.score(docs, model)
    assert out.count() == len(corpus) and out.where("score is null or score < 0 or score > 1").count() == 0
    assert cotraining.score(no_docs, cotraining.train(no_docs, labels)).count() == 0


def test_without_both_kinds_of_labels_all_stay(spark, docs, corpus):
    for rows in ([], [(n, 1, 0) for n in range(30)]):
        model = cotraining.train(docs, spark.createDataFrame(rows, "doc_id long, quality int, toxic int"))
        assert cotraining.score(docs, model).where("kept").count() == len(corpus)


def test_calibration_recovers_probabilities():
    rng = np.random.default_rng(0)
    dense = rng.normal(size=(4000, 1))
    good = rng.random(4000) < 1 / (1 + np.exp(-(1.5 * dense[:, 0] + 0.5)))
    rows = cotraining.Rows([[]] * 4000, dense.tolist(), good.astype(float).tolist())
    view = cotraining.calibrate(cotraining.View(np.zeros(1), np.array([7.0]), 3.0), rows)
    odds = np.array([view.log_odds([], d) for d in dense.tolist()])
    assert abs(np.polyfit(dense[:, 0], odds, 1) - [1.5, 0.5]).max() < 0.25
