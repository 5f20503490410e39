"""URL rules: parsing, listed rules, mined rules against brute force."""

from __future__ import annotations

import random
import re
from collections import defaultdict
from itertools import combinations
from urllib.parse import urlsplit

import pytest
import xxhash
from pyspark.sql import functions as F

from millrace.llm import urlrules
from millrace.llm.queries import LISTED, QUERIES

URLS = ["http://A.example.ORG/es/1", "https://example.org/en/12?x=/a", "http://example.org/en/2", "http://myexample.org/es/", "ftp://b.com/fr/#x",
        "http://b.com/de/", "http://b.com", "http://com/de/x", "no scheme", "", None, "http://h?q", "http://h#f/x", "a://b://c/d", "http://ÄB.org/", "http://x.org/a\nb"]


@pytest.fixture
def pages(spark):
    def make(urls):
        return spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")

    return make


def parsed(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    cut = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:cut])
    path = rest[cut:]
    return host, path[:min([path.find(c) for c in "?#" if c in path] or [len(path)])]


def verdict(url):
    host, path = parsed(url)
    fits = [r for r in LISTED if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    best = max(fits, key=lambda r: len(r.host + r.path), default=None)
    return best and best.host + best.path, best.verdict if best else "allow"


def test_hosts_paths_and_listed_rules(spark, pages):
    none = urlrules.mine(pages([]).withColumn("blocked", F.lit(True)), "url", "blocked")
    df = pages([*URLS, URLS[0]]).withColumn("host", F.lit("clash"))
    for r in urlrules.judge(df, "url", LISTED, none).collect():
        assert (r.host, r.path, r.rule, r.verdict) == (*parsed(r.url), *verdict(r.url)), r.url
    assert urlrules.judge(df.limit(0), "url", LISTED, none).count() == 0


def labelled():
    rng = random.Random(4)
    for i in range(400):
        spam, site = rng.random() < 0.4, rng.choice(["ads", "shop", "news"])
        url = f"http://{'m' if spam else 'www'}.{site}.net/{'win' if spam else 'read'}/{i}?ref=x"
        yield url, spam and site == "ads" if rng.random() > 0.05 else None
    yield None, True
    yield "", False


def brute(rows, tokens, support, confidence, count=5, most=10, sure=3.0):
    """Rules by counting all subsets of each URL's leading tokens."""
    labels = defaultdict(list)
    for u, b in rows:
        if b is not None and tokens.get(u):
            labels[u].append(b)
    known = [(u, tokens[u], sum(b) >= len(b) / 2, xxhash.xxh64_intdigest(u.encode(), 42)) for u, b in labels.items()]
    known = [(u, t, b, (h - (1 << 64) if h >> 63 else h) % 3 == 2) for u, t, b, h in known]
    train, test = ([(t, b) for _, t, b, held in known if held == side] for side in (False, True))
    share, base = sum(b for _, b in train) / len(train), sum(b for _, b in test) / len(test)

    def told(s, side):
        have = [b for t, b in side if s <= t]
        return len(have), sum(have)

    less = {}
    for w in {w for t, _ in train for w in t}:
        n, b = told({w}, train)
        if b >= count:
            less[w] = (n * share - b) / (n * share * (1 - share)) ** 0.5
    first = [sorted((w for w in t if w in less), key=lambda w: (less[w], w))[:most] for t, _ in train]
    good = {}
    for s in {frozenset(c) for t in first for k in range(1, len(t) + 1) for c in combinations(t, k)}:
        seen = sum(b and s <= set(t) for t, (_, b) in zip(first, train))
        (n, b), (tn, tb) = told(s, train), told(s, test)
        if seen < max(count, support * len(train)) or b < max(count, support * len(train), confidence * n) or tn < count:
            continue
        z2 = sure * sure
        if (tb + z2 / 2 - sure * (tb * (tn - tb) / tn + z2 / 4) ** 0.5) / (tn + z2) > base:
            good[s] = b / n, tb / tn
    return {s: x for s, x in good.items() if not any(good.get(s - {w}, (-1,))[0] >= x[0] for w in s)}


def test_mined_rules_and_matches(spark, pages):
    rows = list(labelled())
    rows += [("http://m.shop.net/win/0?ref=x", True)] * 300     # comes often, is one URL
    df = spark.createDataFrame(rows, "url string, blocked boolean")
    mined = urlrules.mine(df, "url", "blocked", 0.02, 0.7)
    found = {frozenset(r.tokens): (round(r.confidence, 9), round(r.tested, 9)) for r in mined.collect()}
    tokens = {r.url: frozenset(r.t) for r in df.select("url", urlrules.tokens(F.col("url")).alias("t")).collect()}
    want = {s: (round(c, 9), round(t, 9)) for s, (c, t) in brute(rows, tokens, 0.02, 0.7).items()}
    assert found == want and want
    assert all(r.rarest in r.tokens for r in mined.collect())
    fresh = pages(["http://m.ads.net/win/77", "http://www.ads.net/read/3?ref=y", "http://m.news.net/win/1", None, ""])
    own = {r.page_id: frozenset(r.t) for r in fresh.select("page_id", urlrules.tokens(F.col("url")).alias("t")).collect()}
    got = {r.page_id: r.verdict for r in urlrules.judge(fresh, "url", [], mined).collect()}
    assert got == {i: "block" if any(s <= t for s in want) else "allow" for i, t in own.items()}
    assert got[0] == "block" and got[2] == "allow"


def test_labels_that_do_not_depend_on_urls_teach_nothing(spark):
    rng = random.Random(7)
    rows = [(f"http://{rng.choice('abc')}.{rng.choice(['x', 'y'])}.net/{rng.choice('pqr')}/{i}?s={i}", rng.random() < 0.2) for i in range(900)]
    assert urlrules.mine(spark.createDataFrame(rows, "url string, blocked boolean"), "url", "blocked", confidence=0.1).count() == 0


def test_urls_of_sixty_tokens_end(spark):
    """Subsets of sixty tokens are more than anybody can count."""
    query = "&".join(f"q{k}=1" for k in range(50))
    rows = [(f"http://h.spam.net/{'/'.join('abcdefgh')}/{i}?{query}", True) for i in range(60)] + [(f"http://www.good.net/{i}?q1=2&q2=3", False) for i in range(120)]
    df = spark.createDataFrame(rows, "url string, blocked boolean")
    mined = urlrules.mine(df, "url", "blocked").collect()
    assert mined and all(len(r.tokens) == 1 and r.confidence == r.tested == 1 for r in mined)
    fresh = spark.createDataFrame([("http://h.spam.net/a/1?q9=1&q30=", ), ("http://www.good.net/7?q1=2",)], "url string")
    assert [r.verdict for r in urlrules.judge(fresh, "url", [], urlrules.mine(df, "url", "blocked")).orderBy("url").collect()] == ["block", "allow"]


def test_no_token_of_a_long_url_is_left_out(spark):
    """URLs of more than ten tokens that can be in a rule: every one of them counts."""
    rng, rows = random.Random(9), []
    for i in range(300):
        x, y = rng.random() < 0.5, rng.random() < 0.5
        spam = x and y if rng.random() < 0.95 else not (x and y)
        names = [n for n in "abcdefghij" if rng.random() < (0.8 if spam else 0.7)] + ["x"] * x + ["y"] * y
        rows.append((f"http://h{i}.net/?{'&'.join(n + '=1' for n in names)}", spam))
    df = spark.createDataFrame(rows, "url string, blocked boolean")
    tokens = {r.url: frozenset(r.t) for r in df.select("url", urlrules.tokens(F.col("url")).alias("t")).collect()}
    common = {u: frozenset(w for w in t if w.startswith("query:") or w == "host:net") for u, t in tokens.items()}   # the others are of one URL
    want, cut = (brute(rows, common, 0.15, 0.6, most=most) for most in (99, 10))
    found = {frozenset(r.tokens): (round(r.confidence, 9), round(r.tested, 9)) for r in urlrules.mine(df, "url", "blocked", 0.15, 0.6).collect()}
    assert found == {s: (round(c, 9), round(t, 9)) for s, (c, t) in want.items()}
    assert want.keys() - cut.keys() and max(map(len, want)) > 3


def test_tokens(pages):
    t = pages(["http://m.a.org/de/12-x.html?ref=1&b"]).select(urlrules.tokens(F.col("url")).alias("t")).first().t
    assert set(t) == {"host:m", "host:a", "host:org", "path:de", "path:#-x.html", "query:ref", "query:b"}


def test_query(spark, sf_dir):
    """Listed verdicts by the contract, all others by rules that brute force finds."""
    rows = QUERIES["op7_url_rules"](spark, sf_dir).collect()
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    labels = {r.doc_id: bool(r.toxic == 1 or r.quality == 0) for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    made_from = {r.url: int(m.group(1)) for r in pages.collect() if r.url and (m := re.search(r"/([0-9]+)(\.html)?/?([?#].*)?$", r.url))}
    tokens = {r.url: frozenset(r.t) for r in pages.select("url", urlrules.tokens(F.col("url")).alias("t")).collect()}
    mined = brute([(u, labels[i]) for u, i in made_from.items() if i in labels], tokens, urlrules.MIN_SUPPORT, urlrules.MIN_CONFIDENCE)
    assert len(rows) == pages.count()
    for r in rows:
        assert (r.host, r.path) == parsed(r.url) and r.host == (urlsplit(r.url).hostname or "")
        rule, listed = verdict(r.url)
        assert r.rule == rule
        assert r.verdict == (listed if rule else "block" if any(s <= tokens[r.url] for s in mined) else "allow")
