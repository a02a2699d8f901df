import random
import re
from itertools import combinations

import pytest
from pyspark.sql import functions as F

from keepsake.llm import url_rules

URLS = [
    "http://a.net/x", "https://example.net/en/1", "https://www.EXAMPLE.net/en/", "http://example.com/de/5?x=1", "http://b.example.com/de",
    "http://org/fr/1", "http://q.org/fr/2#a", "http://q.org/frx", "http://xnet/", "http://net", "http://a.net", "http://a.net?b/c", None, "",
    "no scheme", "x://y://z/w", "http:///p", "http://H.ORG/FR/", "http://example.net/en", "ftp://u@h.net:80/p\nq",
]


def split(url):
    url = url or ""
    if "://" not in url:
        return "", ""
    rest = re.match(r"([^/?#]*)([^?#]*)", url.split("://", 1)[1], re.S)
    return re.sub("[A-Z]", lambda m: m[0].lower(), rest[1]), rest[2]


def ruled(host, path, rules=url_rules.RULES):
    fits = []
    for action, rule in rules:
        domain, _, rest = rule.partition("/")
        if (host == domain or host.endswith("." + domain)) and path.startswith("/" + rest):
            fits.append((len(rule), rule, action))
    return max(fits)[1:] if fits else (None, None)


def test_prefix_rules(spark):
    pages = spark.createDataFrame(list(enumerate(URLS)), "page_id long, url string").withColumn("rule", F.lit(1))
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    got = {r["page_id"]: tuple(r)[1:] for r in url_rules.judge(pages, labels).collect()}
    for n, url in enumerate(URLS):
        host, path = split(url)
        rule, action = ruled(host, path)
        assert got[n] == (host, path, rule, action or "allow"), url
    assert url_rules.judge(pages.limit(0), labels).count() == 0


@pytest.fixture(scope="module")
def mined(spark):
    rng = random.Random(2)
    pages, labels = [], []
    for n in range(800):
        cheap, shop = rng.random() < 0.3, rng.random() < 0.3
        host = ("cheap-" if cheap else "") + rng.choice(["one", "two", "three"]) + ".example.info"
        pages.append((n, f"http://{host}/{'shop' if shop else 'read'}/{n}?page={n}"))
        if n < 600:
            bad = cheap and shop if rng.random() < 0.97 else not (cheap and shop)
            labels.append((n, int(not bad), 0))
    labels += [(None, 0, 0), (3, None, 1), (10_000, 0, 0)]
    return (
        spark.createDataFrame(pages, "page_id long, url string"),
        spark.createDataFrame(labels, "doc_id long, quality int, toxic int"),
        pages,
    )


def test_mined_rules_judge_the_rest(mined):
    pages, labels, rows = mined
    rules = url_rules.mine(url_rules.labelled_urls(pages, labels), min_support=0.02)
    assert ("host cheap", "path shop") in [r[0] for r in rules]
    kept = [set(r[0]) for r in rules]
    assert not any(a < b for a in kept for b in kept)
    got = {r["page_id"]: r["verdict"] for r in url_rules.judge(pages, labels, min_support=0.02).collect()}
    for n, url in rows:
        assert got[n] == ("block" if "cheap-" in url and "/shop/" in url else "allow"), url


def test_index_against_brute_force(spark):
    rng = random.Random(8)
    letters = "abcdefgh"
    rules = [tuple(sorted({f"path {rng.choice(letters)}" for _ in range(rng.randint(1, 4))})) for _ in range(30)]
    rules = [r for r in rules if len(r) > 1]
    urls = [f"http://x/{'/'.join(rng.sample(letters, rng.randint(0, 6)))}" for _ in range(200)]
    df = spark.createDataFrame(list(enumerate(urls)), "n long, url string")
    got = dict(df.select("n", url_rules.matches(F.col("url"), rules)).collect())
    for n, url in enumerate(urls):
        tokens = {f"path {t}" for t in url[9:].split("/")}
        assert got[n] == any(set(r) <= tokens for r in rules)


def test_no_python_in_the_plan(mined):
    plan = url_rules.judge(mined[0], mined[1])._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas", plan)


def test_many_rules_of_one_url_hide_no_other(spark):
    """A long hot URL gives 2**11 - 1 antecedents of confidence 1.0; the weaker rules stay."""
    hot = "http://" + ".".join(f"hot{n}" for n in range(10)) + "/{}"
    urls, labels = [], []
    for n in range(300):
        urls.append(hot.format(n) if n < 100 else f"http://pills/buy/{n}" if n < 150 else f"http://fine/buy/{n}")
        labels.append((n, int(n >= 140), 0))
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    labels = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    labelled = url_rules.labelled_urls(pages, labels)
    baskets = [({"scheme http", *(f"host {w}" for w in u[7:].split("/")[0].split("."))} | ({"path buy"} if "/buy/" in u else set()), n < 140)
               for n, u in enumerate(urls)]
    every = {}
    for size in range(1, 13):
        for held in {frozenset(b) for b, _ in baskets}:
            for t in combinations(sorted(held), size):
                n_bad, n = (sum(1 for b, bad in baskets if set(t) <= b and (bad or not only)) for only in (True, False))
                if n_bad >= 0.005 * 300 and n_bad / n >= 0.75:
                    every[t] = n_bad / n
    want = {t: c for t, c in every.items() if not any(set(u) < set(t) and every[u] >= c for u in every)}
    got = url_rules.mine(labelled)
    assert {t: c for t, c, _ in got} == want and ("host pills",) in want and len(every) > 2000
    verdicts = [r[0] for r in url_rules.judge(pages, labels).orderBy("page_id").select("verdict").collect()]
    assert verdicts == ["block"] * 150 + ["allow"] * 150


def test_rules_as_a_table(mined):
    pages, labels, _ = mined
    assert len(url_rules.mine(url_rules.labelled_urls(pages, labels), min_support=0.02)) > 0
    pages = pages.union(pages.limit(9)).unionByName(pages.limit(1).selectExpr("page_id", "cast(null as string) url"))
    constant, table = (
        sorted(map(tuple, url_rules.judge(pages, labels, max_indexed=n, min_support=0.02).collect()), key=repr)
        for n in (url_rules.MAX_INDEXED, 0)
    )
    assert table == constant and {r[4] for r in table} == {"block", "allow"}


def test_a_long_hot_url_ends(spark):
    """30 parameters in a third of the labels: 2**30 sets if they were mined one by one."""
    hot = "http://track.example.info/go/{}?" + "&".join(f"p{n}=v{n}" for n in range(30))
    urls, labels = [], []
    for n in range(300):
        urls.append(hot.format(n) if n < 100 else f"http://pills.info/buy/{n}?p1=x" if n < 150 else f"http://fine.info/buy/{n}?p2=v2")
        labels.append((n, int(n >= 140), 0))
    urls += ["http://x/?p7=1", "http://x/?p2=1", "http://x/?p1=1", "http://pills.info/", "http://track.fine/"]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    labels = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    rules = {t for t, _, _ in url_rules.mine(url_rules.labelled_urls(pages, labels))}
    # Of the hot URL every token of its own alone is a rule.
    assert {("rest p7",), ("rest v7",), ("host track",), ("path go",), ("host pills",)} <= rules
    for judged in (url_rules.judge(pages, labels), url_rules.judge(pages, labels, max_indexed=0)):
        verdicts = [r[0] for r in judged.orderBy("page_id").select("verdict").collect()]
        assert verdicts[:150] == ["block"] * 150 and verdicts[150:300] == ["allow"] * 150
        assert verdicts[300:] == ["block", "allow", "block", "block", "block"]
