"""URL filter: listed rules first, then association rules mined from labelled URLs.

All of it is DataFrame work.  A URL's host is what stands after its first ``://`` up to
``/``, ``?``, ``#`` or the end, A-Z lower-cased; its path goes on from there up to ``?``,
``#`` or the end.  A null URL, or one without ``://``, has an empty host and path and no
tokens.  Repeated URLs get equal verdicts; rows repeat as often as they come in.

Rules are mined from distinct URLs, so that a page that comes often is no evidence of its
own.  Two thirds of them (by hash) are mined, the others test: a rule stands if, of the
test URLs that it fits, surely more are blocked than of all.  A set of n tokens has 2**n subsets, so
FP-growth mines the URLs of up to ``MOST_TOKENS`` tokens, and the sets that a longer URL holds are
found level by level, from those one token shorter: only sets that can be, or be a part of, a rule are made longer.
"""

from __future__ import annotations

import string
from collections.abc import Sequence
from typing import NamedTuple

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.operators.joins import salted_join
from millrace.scratch import keep

ALLOW, BLOCK = "allow", "block"
#: Stands among the tokens of a blocked URL.
MARK = "label:block"
#: Least share, and least number, of the mined URLs that hold a rule's tokens and are blocked.
MIN_SUPPORT = 0.001
MIN_COUNT = 5
#: Least share of blocked ones among the mined URLs that hold a rule's tokens.
MIN_CONFIDENCE = 0.6
#: Tokens up to which a URL is mined by FP-growth, and above which level by level.
MOST_TOKENS = 10
#: By how many standard errors a rule's share of blocked test URLs is above that of all.
SURE = 3.0
#: One of so many URLs tests.
FOLDS = 3


class Listed(NamedTuple):
    """A rule for a host, all its subdomains, and the paths that start with ``path``."""

    verdict: str
    host: str
    path: str


def _rest(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substr(url, at + 3))


def host(url: Column) -> Column:
    name = F.regexp_extract(_rest(url), "^[^/?#]*", 0)
    return F.coalesce(F.translate(name, string.ascii_uppercase, string.ascii_lowercase), F.lit(""))


def path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(_rest(url), "^[^/?#]*([^?#]*)", 1), F.lit(""))


def listed(host: Column, path: Column, rules: Sequence[Listed]) -> Column:
    """Struct (verdict, rule) of the longest listed rule that fits, null if none does."""
    out = F.lit(None).cast("struct<verdict:string,rule:string>")
    for r in sorted(rules, key=lambda r: (len(r.host + r.path), r)):  # a longer one overrides
        fits = ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path)
        out = F.when(fits, F.struct(F.lit(r.verdict).alias("verdict"), F.lit(r.host + r.path).alias("rule"))).otherwise(out)
    return out


def tokens(url: Column) -> Column:
    """Distinct tokens: labels of the host, segments of the path (digits as one token), the
    file's ending, names in the query."""
    query = F.regexp_extract(F.coalesce(_rest(url), F.lit("")), r"^[^?#]*\?([^#]*)", 1)
    segment = F.transform(F.split(path(url), "/"), lambda s: F.regexp_replace(s, "[0-9]+", "#"))
    return F.array_distinct(F.filter(F.concat(
        F.transform(F.split(host(url), r"\."), lambda s: F.concat(F.lit("host:"), s)),
        F.transform(segment, lambda s: F.concat(F.lit("path:"), s)),
        F.transform(F.split(query, "&"), lambda s: F.concat(F.lit("query:"), F.substring_index(s, "=", 1))),
    ), lambda t: ~t.endswith(":")))


def _labelled(labelled: DataFrame, url: str, blocked: str) -> DataFrame:
    """Stored: url, held (tokens), blocked, test of the distinct labelled URLs.  A URL with labels of both
    kinds is blocked if half of them or more are."""
    some = labelled.where(F.col(blocked).isNotNull() & F.col(url).isNotNull()).groupBy(F.col(url).alias("url")).agg(
        (F.avg(F.col(blocked).cast("int")) >= 0.5).alias("blocked"))
    rows = some.select("url", tokens(F.col("url")).alias("held"), "blocked", (F.pmod(F.xxhash64("url"), F.lit(FOLDS)) == FOLDS - 1).alias("test"))
    return keep(rows.where(F.size("held") > 0), "urls")


def _known(train: DataFrame, count: int) -> DataFrame:
    """Stored: url, blocked, items (the tokens of each mined URL that can be in a rule)."""
    each = keep(train.select("url", "blocked", F.explode("held").alias("token")), "tokens")
    known = each.where("blocked").groupBy(F.col("token").alias("known")).count().where(F.col("count") >= count).select("known")
    return keep(salted_join(each, known, [("token", "known")]).groupBy("url", "blocked").agg(F.collect_list("token").alias("items")), "items")


def surely(b: Column, n: Column, errors: float) -> Column:
    """Lower end of Wilson's interval for a share of ``b`` in ``n``."""
    z2 = errors * errors
    return (b + z2 / 2 - errors * F.sqrt(b * (n - b) / n + z2 / 4)) / (n + z2)


def _counted(each: DataFrame, sets: DataFrame, freq: DataFrame) -> DataFrame:
    """Stored: tokens, rarest, mn, mb, tn, tb, longs of the token ``sets``: how many mined and test URLs hold them, how
    many of those are blocked, how many URLs are long.  URLs meet a set under its ``rarest`` token, that fewest of them hold."""
    named = sets.select("tokens", F.xxhash64("tokens").alias("rule_id"))
    rarest = (
        named.select("rule_id", "tokens", F.explode("tokens").alias("token")).join(freq, "token")
        .groupBy("rule_id", "tokens").agg(F.min_by("token", F.struct("freq", "token")).alias("rarest"))
    )
    index = keep(rarest.select(F.col("rarest").alias("known"), "rule_id", "tokens"), "rules")
    fits = salted_join(each, index, [("token", "known")]).where(F.size(F.array_except("tokens", "held")) == 0)

    def told(name: str, test: bool) -> list[Column]:
        return [F.count_if(F.col("test") == test).alias(f"{name}n"), F.count_if((F.col("test") == test) & F.col("blocked")).alias(f"{name}b")]

    counts = fits.groupBy("rule_id").agg(*told("m", False), *told("t", True), F.count_if("long").alias("longs"))
    return keep(index.withColumnRenamed("known", "rarest").join(counts, "rule_id"), "rules")


def _by_level(each: DataFrame, freq: DataFrame, needs: Column, total: int) -> DataFrame:
    """tokens: the sets that some ``long`` URL holds and that can be rules, each longer one from those a
    token shorter.  ``needs`` says of a set's counts whether it or a longer one may be a rule.

    Two kinds of sets are made no longer, as no longer one is left in the end.  One that a subset's URLs all
    hold has the subset's counts, and so has each longer one; the same rule without a token is as good.
    One whose URLs are all blocked, test ones too, is as good a rule as any longer one.
    """
    tokens = each.where("long").select("token").distinct()
    sets, found, size = tokens.select(F.array("token").alias("tokens"), F.lit(total).cast("long").alias("least")), None, 1
    while True:
        counted = _counted(each, sets, freq).join(sets, "tokens")
        free = keep(counted.where(needs & (F.col("longs") > 0) & (F.col("mn") + F.col("tn") < F.col("least"))).select(
            "tokens", "mn", "mb", "tn", "tb"), "sets")
        found = free.select("tokens") if found is None else found.union(free.select("tokens"))
        live = free.where("mn > mb OR tn > tb").select("tokens", (F.col("mn") + F.col("tn")).alias("n"), F.slice("tokens", 1, size - 1).alias("first"))
        other = live.select(F.col("first").alias("same"), F.col("tokens")[size - 1].alias("last"))
        longer = salted_join(keep(live, "sets"), keep(other, "sets"), [("first", "same")]).where(F.col("tokens")[size - 1] < F.col("last"))
        longer = longer.select(F.concat("tokens", F.array("last")).alias("tokens"))
        parts = longer.select("tokens", F.explode("tokens").alias("token")).select("tokens", F.array_remove("tokens", F.col("token")).alias("part"))
        sets = keep(parts.join(live.select(F.col("tokens").alias("part"), "n"), "part").groupBy("tokens").agg(
            F.count("*").alias("parts"), F.min("n").alias("least")).where(F.col("parts") == size + 1).select("tokens", "least"), "sets")
        if sets.isEmpty():
            return found
        size += 1


def mine(labelled: DataFrame, url: str, blocked: str, support: float = MIN_SUPPORT, confidence: float = MIN_CONFIDENCE,
         count: int = MIN_COUNT, most: int = MOST_TOKENS, sure: float = SURE) -> DataFrame:
    """Rules (rule_id, tokens, rarest, support, confidence, tested): token combinations of which
    enough labelled URLs are blocked, and which hold on the URLs that test.  ``tested`` is the share of
    blocked ones there.  Rows with a null label or URL teach nothing.  A rule is left out
    if without one of its tokens it is as good.

    ``rarest`` is the token of the combination that fewest labelled URLs hold: the one under
    which the index has the rule.
    """
    rows = _labelled(labelled, url, blocked)
    schema = "rule_id long, tokens array<string>, rarest string, support double, confidence double, tested double"
    sums = {r.test: r for r in rows.groupBy("test").agg(F.count("*").alias("n"), F.count_if("blocked").alias("b")).collect()}
    if len(sums) < 2 or not sums[False].b:
        return rows.sparkSession.createDataFrame([], schema)
    n, share, base = sums[False].n, sums[False].b / sums[False].n, sums[True].b / sums[True].n
    freq = keep(rows.select(F.explode("held").alias("token")).groupBy("token").agg(F.count("*").alias("freq")), "tokens")
    needed = max(float(count), support * n)
    known = _known(rows.where("NOT test"), count)
    short = keep(known.where(F.size("items") <= most).select(
        F.concat("items", F.when(F.col("blocked"), F.array(F.lit(MARK))).otherwise(F.array().cast("array<string>"))).alias("items")), "items")
    of_short = max(short.count(), 1)
    model = FPGrowth(itemsCol="items", minSupport=min(1.0, max(needed - 0.5, 0.5) / of_short), minConfidence=0.0).fit(short)
    found = model.associationRules.where(F.col("consequent")[0] == MARK).select(F.array_sort("antecedent").alias("tokens"))
    longs = known.where(F.size("items") > most).select(F.col("url").alias("__url"), F.lit(True).alias("__long"))
    some = not longs.isEmpty()
    marked = rows.join(longs, F.col("url") == F.col("__url"), "left") if some else rows.withColumn("__long", F.lit(False))
    each = keep(marked.select("held", "blocked", "test", F.coalesce("__long", F.lit(False)).alias("long"), F.explode("held").alias("token")), "tokens")
    if some:
        # surely more than ``base`` of a set's test URLs are blocked only if enough are, even if all of them were
        needs = (F.col("mb") >= needed) & (F.col("tn") >= count) & (F.col("tb") >= base * (F.col("tb") + sure * sure) - 1e-9)
        found = found.union(_by_level(each, freq, needs, rows.count())).distinct()
    found = _counted(each, keep(found, "rules"), freq)
    good = keep(
        found.where((F.col("mb") >= count) & (F.col("mb") >= support * n) & (F.col("mb") >= confidence * F.col("mn")))
        .where((F.col("tn") >= count) & (surely(F.col("tb"), F.col("tn"), sure) > base))
        .select("rule_id", "tokens", "rarest", (F.col("mb") / n).alias("support"), (F.col("mb") / F.col("mn")).alias("confidence"),
                (F.col("tb") / F.col("tn")).alias("tested")), "rules")
    # the same rule without one of its tokens
    shorter = good.where(F.size("tokens") > 1).select("rule_id", "confidence", F.explode("tokens").alias("token"), "tokens").select(
        "rule_id", "confidence", F.xxhash64(F.array_remove("tokens", F.col("token"))).alias("without"))
    other = good.select(F.col("rule_id").alias("without"), F.col("confidence").alias("as_good"))
    idle = shorter.join(other, "without").where(F.col("as_good") >= F.col("confidence")).select("rule_id").distinct()
    return keep(good.join(idle, "rule_id", "left_anti").select(*[c.split()[0] for c in schema.split(", ")]), "rules")


def matched(urls: DataFrame, url: str, rules: DataFrame) -> DataFrame:
    """url, confidence (the best rule's) of the distinct URLs that a rule fits.  A URL's
    tokens find the rules that the index has under them; those whose other tokens it holds
    too fit."""
    held = urls.select(F.col(url).alias("url")).where("url IS NOT NULL").distinct().withColumn("held", tokens(F.col("url")))
    index = rules.select(F.col("rarest").alias("token"), "tokens", "confidence")
    return (
        held.select("url", "held", F.explode("held").alias("token")).join(index, "token")
        .where(F.size(F.array_except("tokens", "held")) == 0)
        .groupBy("url").agg(F.max("confidence").alias("confidence"))
    )


def judge(pages: DataFrame, url: str, listed_rules: Sequence[Listed], mined: DataFrame) -> DataFrame:
    """``pages`` with host, path, rule and verdict: a listed rule's verdict, else ``block``
    where a mined rule fits, else ``allow``.  Columns of these names are replaced."""
    own = [c for c in pages.columns if c not in ("host", "path", "rule", "verdict")]
    rows = pages.select(*own, host(F.col(url)).alias("host"), path(F.col(url)).alias("path"))
    rows = rows.withColumn("__listed", listed(F.col("host"), F.col("path"), listed_rules))
    hits = matched(rows.where("__listed IS NULL"), url, mined).select(F.col("url").alias("__url"), F.lit(BLOCK).alias("__mined"))
    return (
        rows.join(hits, F.col(url) == F.col("__url"), "left")
        .select(*own, "host", "path", F.col("__listed.rule").alias("rule"),
                F.coalesce("__listed.verdict", "__mined", F.lit(ALLOW)).alias("verdict"))
    )
