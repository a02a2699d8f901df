"""URL filter by association rules, in DataFrame functions and Spark's FP-growth only.

Given prefix rules decide first, the longest that fits. Other URLs are judged by mined rules: token
combinations that go with bad labels often and surely enough, tokens that always go together being one. The mined
rules are matched through an inverted index from token to rules: a constant while the rules are few, where no row is shuffled to be
judged, else a table that distinct URLs are joined with. No rule is left out for their number.
"""

from __future__ import annotations

import json
import math
import zlib
from functools import reduce
from itertools import product

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keepsake.llm.common import ascii_lower
from keepsake.sources.staging import stage

BAD = "=bad"
SLOTS = 1024
MAX_INDEXED = 1000  # rules, and tokens of their classes, held as a constant; more are matched as a table

# The given prefix rules.
RULES = (("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/"))


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z in lower case) and path; both empty where the URL is null or has no ``://``."""
    url = F.coalesce(url, F.lit(""))
    host = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    path = F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1)
    return ascii_lower(host), path


def prefix_rule(host: Column, path: Column, rules=RULES) -> Column:
    """The longest rule that fits the host or a parent domain, and the path's start; else null."""
    out = F.lit(None).cast("string")
    for _, rule in sorted(rules, key=lambda r: (len(r[1]), r[1].index("/"), r[1])):
        domain, slash, rest = rule.partition("/")
        fits = ((host == domain) | host.endswith("." + domain)) & path.startswith(slash + rest)
        out = F.when(fits, F.lit(rule)).otherwise(out)
    return out


def tokens(url: Column) -> Column:
    """Distinct tokens: words of the host, of the path and of the rest, each marked with its part.

    Numbers are left out: they tell one page from another, not one kind from another.
    """
    url = ascii_lower(F.coalesce(url, F.lit("")))

    def part(mark: str, pattern: str) -> Column:
        words = F.split(F.regexp_extract(url, pattern, 1), r"[^\p{L}\p{N}_]+")
        return F.transform(
            F.filter(words, lambda w: (w != "") & ~w.rlike("^[0-9]+$")), lambda w: F.concat(F.lit(mark), w)
        )

    return F.array_distinct(
        F.concat(
            part("scheme ", r"(?s)^(.*?)://"),
            part("host ", r"(?s)^.*?://([^/?#]*)"),
            part("path ", r"(?s)^.*?://[^/?#]*([^?#]*)"),
            part("rest ", r"(?s)^.*?://[^?#]*(.*)$"),
        )
    )


def labelled_urls(pages: DataFrame, labels: DataFrame) -> DataFrame:
    """(url, bad): pages whose first number in the path is a labelled document's id.

    Bad is low quality or toxic. Copies of a label row count once, contradicting ones as bad; null
    ids and null labels are left out.
    """
    marked = (
        labels.where("doc_id is not null and quality is not null")
        .groupBy("doc_id")
        .agg(F.max(((F.col("quality") == 0) | (F.coalesce("toxic", F.lit(0)) == 1)).cast("int")).alias("bad"))
    )
    path = host_and_path(F.col("url"))[1]
    number = F.regexp_extract(path, r"/([0-9]{1,18})(?![0-9])", 1)
    found = pages.select("url", F.when(number != "", number.cast("long")).alias("number")).where("number is not null")
    return found.join(marked, F.col("number") == F.col("doc_id")).select("url", (F.col("bad") == 1).alias("bad"))


def token_classes(baskets: DataFrame, least: int) -> DataFrame:
    """(token, class) of the tokens in at least ``least`` rows (row, items): those of equal rows are one class.

    A class is named by its first token. Rows are compared by their number and two sums of 64-bit hashes. A token in a
    given share of all rows, as tokens here are, has less than 1 / share others for each token of a mean row.
    """
    listed = baskets.select("row", F.explode("items").alias("token"))
    wide = "decimal(38,0)"
    marks = listed.groupBy("token").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.xxhash64("row").cast(wide)).alias("s1"),
        F.sum(F.xxhash64(F.lit(1), "row").cast(wide)).alias("s2"),
    )
    alike = marks.where(F.col("n") >= least).groupBy("n", "s1", "s2").agg(F.sort_array(F.collect_list("token")).alias("tokens"))
    return alike.select(F.explode("tokens").alias("token"), F.element_at("tokens", 1).alias("class"))


def mined_rules(
    labelled: DataFrame, min_support: float = 0.005, min_confidence: float = 0.75
) -> tuple[DataFrame, DataFrame] | None:
    """Rules ``classes -> bad`` as (t, confidence, support), ``t`` sorted, and the classes; none without labelled rows.

    Tokens that occur in the same rows are mined as one class: a set with two of them holds nothing that one does not. So a
    long URL, however often it is there, adds one token for all that only it has. A rule is dropped if a part of
    it is a rule of at least its confidence; all others stay. Sets grow by one a round, and each learns the best rule
    below it from the sets one smaller, which are all there, as a part of a frequent set is frequent.
    """
    baskets = labelled.select(
        F.monotonically_increasing_id().alias("row"), tokens(F.col("url")).alias("items"), "bad"
    )
    # A third of the pages may share one URL: copies of a basket are mined with the rest, in place.
    baskets = stage(baskets, "baskets")
    total = baskets.count()
    if not total:
        return None
    least = max(1, math.ceil(min_support * total))
    classes = stage(token_classes(baskets, least), "classes")
    merged = (
        baskets.select("row", "bad", F.explode("items").alias("token"))
        .join(F.broadcast(classes), "token")
        .groupBy("row", "bad")
        .agg(F.collect_set("class").alias("items"))
        .select(F.when(F.col("bad"), F.concat("items", F.array(F.lit(BAD)))).otherwise(F.col("items")).alias("items"))
    )
    merged = stage(merged, "merged")
    # Rows without a frequent token are gone; the least number of rows stays the same.
    share = (least - 0.5) / max(1, merged.count())
    frequent = stage(FPGrowth(itemsCol="items", minSupport=min(1.0, share)).fit(merged).freqItemsets, "itemsets")
    is_bad = F.array_contains("items", BAD)
    bad = frequent.where(is_bad & (F.size("items") > 1)).select(
        F.sort_array(F.array_remove("items", BAD)).alias("t"), F.col("freq").alias("both")
    )
    sets = stage(
        bad.join(frequent.where(~is_bad).select(F.sort_array("items").alias("t"), "freq"), "t").select(
            "t", (F.col("both") / F.col("freq")).alias("confidence"), (F.col("both") / F.lit(total)).alias("support")
        ),
        "sets",
    )
    is_rule = F.col("confidence") >= min_confidence
    longest = sets.agg(F.max(F.size("t"))).first()[0] or 0
    below = sets.where("size(t) = 1").withColumn("below", F.lit(0.0))
    levels = [below]
    for size in range(2, longest + 1):
        best = F.greatest("below", F.when(is_rule, F.col("confidence")).otherwise(0.0))
        smaller = below.select(F.col("t").alias("part"), best.alias("best"))
        parts = sets.where(F.size("t") == size).select("*", F.explode("t").alias("x"))
        parts = parts.select("t", "confidence", "support", F.expr("array_remove(t, x)").alias("part"))
        found = parts.join(smaller, "part").groupBy("t", "confidence", "support")
        below = stage(found.agg(F.max("best").alias("below")), "level")
        levels.append(below)
    kept = reduce(DataFrame.union, levels).where(is_rule & (F.col("below") < F.col("confidence")))
    rules = stage(kept.select("t", "confidence", "support"), "rules")
    used = rules.select(F.explode("t").alias("class")).distinct()
    return rules, classes.join(used, "class", "left_semi").select("token", "class")


def mine(labelled: DataFrame, **mining) -> list[tuple[tuple[str, ...], float, float]]:
    """All of ``mined_rules`` as (tokens, confidence, support), strongest first, a token of every class in each."""
    found = mined_rules(labelled, **mining)
    if found is None:
        return []
    members: dict[str, list[str]] = {}
    for token, name in found[1].collect():
        members.setdefault(name, []).append(token)
    kept = [
        (tuple(sorted(t)), r["confidence"], r["support"])
        for r in found[0].collect()
        for t in product(*(members[c] for c in r["t"]))
    ]
    return sorted(kept, key=lambda r: (-r[1], len(r[0]), -r[2], r[0]))


def _slotted(keys: dict[str, int]) -> Column:
    """A constant with the number of each key, in slots by hash."""
    slots: list[list[dict]] = [[] for _ in range(SLOTS)]
    for k, n in keys.items():
        slots[zlib.crc32(k.encode()) % SLOTS].append({"t": k, "n": n})
    return F.from_json(F.lit(json.dumps(slots)), "array<array<struct<t:string,n:int>>>")


def matches(url: Column, rules: list[tuple[str, ...]], classes: dict[str, str] | None = None) -> Column:
    """Whether some rule has all its classes in the URL; without ``classes`` every token is one."""
    if not rules:
        return F.lit(False)
    names = {c: n for n, c in enumerate(sorted({c for rule in rules for c in rule}))}
    of = {c: c for c in names} if classes is None else classes
    listed: list[list[int]] = [[] for _ in names]
    for n, rule in enumerate(rules):
        for c in rule:
            listed[names[c]].append(n)
    index = _slotted({t: names[c] for t, c in of.items() if c in names})
    by_class = F.from_json(F.lit(json.dumps(listed)), "array<array<int>>")
    sizes = F.from_json(F.lit(json.dumps([len(r) for r in rules])), "array<int>")

    def found_in(t: Column) -> Column:
        slot = F.get(index, (F.crc32(t) % SLOTS).cast("int"))
        return F.transform(F.filter(slot, lambda e: e["t"] == t), lambda e: e["n"])

    held = F.array_distinct(F.flatten(F.transform(tokens(url), found_in)))
    met = F.flatten(F.transform(held, lambda c: F.get(by_class, c)))
    # Runs of one rule in the sorted list: a rule matches when its run is as long as the rule.
    start = F.struct(F.lit(-1).alias("rule"), F.lit(0).alias("n"), F.lit(False).alias("found"))

    def step(acc: Column, rule: Column) -> Column:
        n = F.when(acc["rule"] == rule, acc["n"] + 1).otherwise(1)
        return F.struct(
            rule.alias("rule"), n.alias("n"), (acc["found"] | (n >= F.get(sizes, rule))).alias("found")
        )

    return F.aggregate(F.sort_array(met), start, step)["found"]


def matched(urls: DataFrame, rules: DataFrame, classes: DataFrame) -> DataFrame:
    """The distinct ``url`` that have all classes of some rule (``t``), by joins.

    A rule is listed under the class that the fewest rules have, so that common ones list few.
    """
    listed = rules.select("t", F.explode("t").alias("class"))
    spread = listed.groupBy("class").agg(F.count(F.lit(1)).alias("n"))
    index = (
        listed.join(spread, "class")
        .groupBy("t")
        .agg(F.min(F.struct("n", "class"))["class"].alias("class"))
    )
    cut = (
        urls.select("url").distinct().select("url", F.explode(tokens(F.col("url"))).alias("token"))
        .join(classes, "token")
        .groupBy("url")
        .agg(F.collect_set("class").alias("has"))
    )
    met = cut.select("url", "has", F.explode("has").alias("class")).join(index, "class")
    return met.where(F.size(F.array_except("t", "has")) == 0).select("url").distinct()


def judge(pages: DataFrame, labels: DataFrame, rules=RULES, max_indexed: int = MAX_INDEXED, **mining) -> DataFrame:
    """(page_id, host, path, rule, verdict) of every page row.

    A URL that no prefix rule fits is blocked if a mined rule matches, else allowed; so are null and
    malformed URLs, which have no tokens. Repeated rows are judged alike; other columns are ignored;
    empty tables give no rows, or no mined rules.
    """
    mined, classes = mined_rules(labelled_urls(pages, labels), **mining) or (None, None)
    few = [] if mined is None else [tuple(r["t"]) for r in mined.select("t").limit(max_indexed + 1).collect()]
    of = {} if mined is None else dict(map(tuple, classes.select("token", "class").limit(max_indexed + 1).collect()))
    actions = F.create_map(*[F.lit(x) for action, rule in rules for x in (rule, action)])
    host, path = host_and_path(F.col("url"))
    found = pages.select("page_id", "url", host.alias("host"), path.alias("path")).select(
        "*", prefix_rule(F.col("host"), F.col("path"), rules).alias("rule")
    )
    if max(len(few), len(of)) <= max_indexed:
        found = found.withColumn("mined", matches(F.col("url"), few, of))
    else:
        blocked = matched(found.where("rule is null"), mined, classes).withColumn("mined", F.lit(True))
        found = found.join(blocked, "url", "left")
    learned = F.when(F.col("mined"), F.lit("block")).otherwise(F.lit("allow"))
    verdict = F.when(F.col("rule").isNotNull(), F.try_element_at(actions, F.col("rule"))).otherwise(learned)
    return found.select("page_id", "host", "path", "rule", verdict.alias("verdict"))
