import re

from pyspark.sql import functions as F

from keepsake.llm import quality_rules

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def measures(text):
    text = text or ""
    words = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    windows = [tuple(words[k : k + 8]) for k in range(len(words) - 7)]
    covered = {k + j for k, w in enumerate(windows) if windows.count(w) > 1 for j in range(8)} if len(windows) < 2000 else set()
    n = len(words)
    failed = n < 20 or 100 * len(covered) > 30 * n
    return n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered), failed


def test_measures(docs, corpus, as_rows):
    out = quality_rules.apply(docs)
    got = as_rows(out, "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    assert got == sorted(((d, *measures(t)) for d, t in corpus), key=repr)
    assert out.where("kept and base_failed").count() == 0


def test_rules_and_order(spark):
    plain = " ".join(f"word{n}" for n in range(60))
    texts = {
        1: plain,
        2: " ".join(f"a{n}### b{n}$$" for n in range(40)),
        3: plain.upper(),
        4: " ".join(f"Go{n}!!" for n in range(40)),
        5: "\n".join([plain.split(" ")[k % 2 * 2 + 0] + " " + str(k % 2) for k in range(40)]) + "\n" + plain,
        6: " ".join(f"w{n} w{n}" for n in range(40)),
        7: " ".join("x" * 30 + str(n) for n in range(40)),
    }
    rows = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    kept = {r["doc_id"]: r["rejected_by"] for r in quality_rules.apply(rows).collect()}
    assert kept[1] is None and kept[2] == "symbols" and kept[3] == "capitals" and kept[4] == "exclamations"
    assert kept[6] == "stuttering" and kept[7] == "word length" and kept[5] in ("repeated lines", "base")
    never = quality_rules.Rule("never", F.sha2(F.repeat("text", 200), 512) == "x")
    often = quality_rules.Rule("often", F.col("n_words") > 0)
    assert [r.name for r in quality_rules.ordered(rows, [never, often])] == ["often", "never"]


def test_order_by_cost_and_by_what_is_left(spark):
    rows = spark.createDataFrame([(n, " ".join(f"w{n}x{k}" for k in range(60 + n % 2))) for n in range(200)], "doc_id long, text string")
    odd = F.col("n_words") % 2 == 1
    dear = quality_rules.Rule("dear", odd & (F.length(F.sha2(F.repeat("text", 100), 512)) > 0))
    cheap = quality_rules.Rule("cheap", odd)
    # What "cheap" rejects is gone when "same" is judged; "few" still finds a tenth of the rest.
    few = quality_rules.Rule("few", F.col("text").contains("5x1 "))
    same = quality_rules.Rule("same", odd & (F.col("word_chars") > 0))
    for rules in ([dear, cheap], [cheap, dear]):
        assert [r.name for r in quality_rules.ordered(rows, rules)] == ["cheap", "dear"]
    names = [r.name for r in quality_rules.ordered(rows, [dear, few, cheap])]
    assert names == ["cheap", "few", "dear"]
    assert {r.name for r in quality_rules.ordered(rows, [same, few, cheap])} == {"same", "few", "cheap"}


def test_no_python_in_the_plan(docs):
    plan = quality_rules.apply(docs)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas", plan)


def test_nothing(no_docs):
    assert quality_rules.apply(no_docs).count() == 0
