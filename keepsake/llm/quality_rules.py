"""Quality rules as a short-circuit cascade, in built-in column functions only.

Each rule's cost and rejection rate are measured on a bounded sample by hash, the rate on what the rules before
it keep; rules run in the order of rejections per second, and a rejected document is not shown to later rules. The order changes the
time, never the verdict, as a document is kept only if no rule rejects it.
"""

from __future__ import annotations

import json
import time
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keepsake.sources.staging import stage

SAMPLE_ROWS = 400
SAMPLE_CHARS = 20_000  # of a sampled text; only the estimates see the cut
REPEATS = 100
WINDOW = 8


@dataclass(frozen=True)
class Rule:
    """``rejects`` may use ``text``, ``words`` and the measures."""

    name: str
    rejects: Column


def default_rules() -> list[Rule]:
    words = F.greatest(F.col("n_words"), F.lit(1))
    chars = F.greatest(F.col("word_chars"), F.lit(1))
    capitals = F.length(F.regexp_replace("text", r"[^\p{Lu}]+", ""))
    shouts = F.regexp_count("text", F.lit(r"!!"))
    followed = F.size(
        F.filter(F.zip_with("words", F.slice("words", 2, words), lambda a, b: a.eqNullSafe(b)), lambda same: same)
    )
    return [
        Rule("symbols", F.col("n_symbols") * 10 > words),
        Rule("repeated lines", F.col("n_dup_lines") * 2 > F.col("n_lines")),
        Rule("word length", (chars < 2 * words) | (chars > 20 * words)),
        Rule("capitals", capitals * 2 > chars),
        Rule("exclamations", shouts * 5 > words),
        Rule("stuttering", followed * 4 > words),
    ]


def _let(value: Column, use) -> Column:
    """``use`` of ``value``, which is computed once for each row."""
    return F.transform(F.array(value), use)[0]


def _repeated_words(windows: Column) -> Column:
    """Words inside windows whose hash occurs again, from the hashes of all windows in order."""

    def neighbours(s: Column) -> Column:
        pairs = F.transform(
            F.sequence(F.lit(0), F.size(s) - 2),
            lambda k: F.when(
                s[k]["h"] == s[k + 1]["h"], F.array(s[k]["i"], s[k + 1]["i"])
            ).otherwise(F.array().cast("array<int>")),
        )
        return F.sort_array(F.array_distinct(F.flatten(pairs)))

    def covered(at: Column) -> Column:
        steps = F.transform(
            F.sequence(F.lit(1), F.size(at) - 1), lambda k: F.least(F.lit(WINDOW), at[k] - at[k - 1])
        )
        more = F.when(F.size(at) > 1, F.aggregate(steps, F.lit(0), lambda a, x: a + x)).otherwise(0)
        return more + WINDOW

    placed = F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i")))
    return _let(F.sort_array(placed), lambda s: _let(neighbours(s), covered))


def _measures(text: Column) -> Column:
    """All measures as one struct, every intermediate list bound once.

    As one expression they stay linear where the optimizer copies them into a filter.
    """

    def of_windows(windows: Column) -> Column:
        again = F.size(F.array_distinct(windows)) < F.size(windows)
        return F.when(again, _repeated_words(windows)).otherwise(0)

    def of_hashes(hashes: Column) -> Column:
        each = F.transform(
            F.sequence(F.lit(0), F.size(hashes) - WINDOW),
            lambda i: F.xxhash64(*[F.get(hashes, i + k) for k in range(WINDOW)]),
        )
        return F.when(F.size(hashes) >= WINDOW, _let(each, of_windows)).otherwise(0)

    def of_lines(lines: Column, words: Column) -> Column:
        return F.struct(
            words.alias("words"),
            F.size(words).cast("long").alias("n_words"),
            F.length(F.array_join(words, "")).cast("long").alias("word_chars"),
            (F.length(text) - F.length(F.translate(text, "#*$%&|<>", ""))).cast("long").alias("n_symbols"),
            F.size(lines).cast("long").alias("n_lines"),
            (F.size(lines) - F.size(F.array_distinct(lines))).cast("long").alias("n_dup_lines"),
            _let(F.transform(words, lambda w: F.xxhash64(w)), of_hashes).cast("long").alias("n_repeat_words"),
        )

    lines = F.filter(F.split(text, "\n"), lambda line: line.rlike(r"[^ \t-\r]"))
    words = F.array_remove(F.split(text, r"[ \t-\r]+"), "")
    return _let(words, lambda w: _let(lines, lambda n: of_lines(n, w)))


def measured(docs: DataFrame) -> DataFrame:
    """(doc_id, text, words) and the measures: n_words, word_chars, n_symbols, n_lines, n_dup_lines,
    n_repeat_words. Windows are compared by 64-bit hash within one text.
    """
    found = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    return found.withColumn("m", _measures(F.col("text"))).select("doc_id", "text", "m.*")


def base_failed() -> Column:
    return (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))


def _sample(docs: DataFrame, rows: int) -> DataFrame:
    """The measures of the ``rows`` documents of least hash that pass the base, staged."""
    cut = F.left("text", F.lit(SAMPLE_CHARS)).alias("text")
    few = docs.select("doc_id", cut).orderBy(F.xxhash64(F.col("doc_id").cast("string")), "doc_id").limit(rows)
    # The sample goes back as one constant: its size is bounded by rows times characters.
    listed = json.dumps([{"doc_id": r["doc_id"], "text": r["text"]} for r in few.collect()])
    parsed = F.from_json(F.lit(listed), "array<struct<doc_id:long,text:string>>")
    sample = docs.sparkSession.range(1).select(F.inline(parsed))
    return stage(measured(sample).where(~base_failed()), "sample")


def _costs(sample: DataFrame, rules: list[Rule]) -> dict[str, float]:
    """Seconds that a rule takes for a row: one job evaluates it ``REPEATS`` times a row, less an empty job."""
    again = sample.coalesce(1).select("*", F.explode(F.sequence(F.lit(1), F.lit(REPEATS))).alias("again"))

    def seconds(condition: Column) -> float:
        spent = []
        for _ in range(3):
            began = time.perf_counter()
            again.agg(F.count_if(condition)).collect()
            spent.append(time.perf_counter() - began)
        return min(spent)

    # The counter takes part, so that no evaluation is taken for a repetition of the one before.
    empty = seconds(F.col("again") < 0)
    each = max(1, sample.count()) * REPEATS
    return {r.name: max(seconds(r.rejects & (F.col("again") > 0)) - empty, 1e-4) / each for r in rules}


def ordered(docs: DataFrame, rules: list[Rule], sample_rows: int = SAMPLE_ROWS) -> list[Rule]:
    """The rules by rejections per second, each judged on the sampled documents that the rules before it keep."""
    sample = _sample(docs, sample_rows)
    cost = _costs(sample, rules)
    flags = sample.select(*[F.coalesce(r.rejects, F.lit(False)).alias(str(n)) for n, r in enumerate(rules)]).collect()
    left, rest, out = list(flags), list(range(len(rules))), []
    while rest:
        gain = {n: (sum(row[n] for row in left) + 0.5) / (len(left) + 1) / cost[rules[n].name] for n in rest}
        best = max(rest, key=lambda n: (gain[n], -n))
        out.append(rules[best])
        rest.remove(best)
        left = [row for row in left if not row[best]]
    return out


def apply(docs: DataFrame, rules: list[Rule] | None = None) -> DataFrame:
    """The measures, ``base_failed``, ``rejected_by`` (null if kept) and ``kept`` of every row.

    ``rejected_by`` names the first rule that rejects, in the order found. Null and empty texts have
    no words and fail the base; repeated rows are judged alike; other columns are ignored; an empty
    table gives no rows.
    """
    rules = ordered(docs, default_rules() if rules is None else rules)
    found = measured(docs).select("*", base_failed().alias("base_failed"))
    verdict = F.when(F.col("base_failed"), F.lit("base"))
    for rule in rules:
        verdict = verdict.when(rule.rejects, F.lit(rule.name))
    return found.select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        verdict.alias("rejected_by"),
    ).withColumn("kept", F.col("rejected_by").isNull())
