"""URL filters: a list of host and path rules, and association rules mined from labels.

A URL is judged by the longest rule that fits it. All others are judged by what labelled URLs
teach: a URL is a basket of tokens (labels of the host, words of path, query and fragment,
each marked with its place), a bad one holds the item ``BAD`` too, and Spark's FP-growth
finds the token combinations that imply it. Combinations are pruned by support (rows that
hold them and are bad) and confidence (the bad share of the rows that hold them), and dropped
where a part of them says as much. They match through an inverted index: a combination is
filed under its rarest token, the tokens of a URL fetch their candidates by an equi-join, and
only candidates are compared as a whole. Each distinct URL is judged once.

FP-growth is exponential in the length of a basket, however alike its tokens are. Where a
labelled URL has more than ``max_tokens`` frequent tokens, the same combinations are grown by
joins instead, a token at a time, and those with a part that says as much are not grown
on: tokens that always come together, or one inside the other, make no combinations. Every
frequent token of every labelled URL takes part either way.

Defined results:

* null url, or one without ``://``: host and path empty, no rule, no token, so ``allow``;
* host ``A-Z`` is lower-cased, nothing else is changed; a port or user name stays part of it;
* a rule fits its host and the subdomains of it, not a host that merely ends like it;
* no labelled row, or no bad one: nothing is mined, and URLs without rule are allowed;
* repeated rows: each is returned; contradicting labels of one row: bad wins;
* empty table: empty result; other columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from zonepulse.llm.common import materialise, read_table

BAD = "=bad"


class Rule(NamedTuple):
    host: str
    path: str
    verdict: str

    @property
    def name(self) -> str:
        return self.host + self.path


#: Fixed values of the task: the rule list.
RULES = (
    Rule("org", "/", "allow"),
    Rule("example.org", "/es/", "block"),
    Rule("example.org", "/en/1", "block"),
    Rule("com", "/fr/", "allow"),
    Rule("com", "/de/", "block"),
)

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)"


def host_of(url: Column) -> Column:
    """Host of a URL, ``A-Z`` lower-cased; empty without ``://``."""
    return F.coalesce(F.translate(F.regexp_extract(url, _PARTS, 1), _UPPER, _LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    """Path of a URL up to ``?`` or ``#``; empty without ``://``."""
    return F.coalesce(F.regexp_extract(url, _PARTS, 2), F.lit(""))


def longest_rule(host: Column, path: Column, rules: Sequence[Rule]) -> Column:
    """Struct (name, verdict) of the longest rule that fits; null if none does."""
    found = F.lit(None).cast("struct<name: string, verdict: string>")
    for r in sorted(rules, key=lambda r: (len(r.name), r.name)):              # the last to be tried first
        fits = ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path)
        found = F.when(fits, F.struct(F.lit(r.name).alias("name"), F.lit(r.verdict).alias("verdict"))).otherwise(found)
    return found


def tokens_of(url: Column) -> Column:
    """Distinct tokens of a URL, marked h: (host), p: (path), q: (query) or f: (fragment); null has none."""
    def words(place: str, part: Column) -> Column:
        found = F.split(F.lower(part), r"[^\p{L}\p{N}_]+")
        return F.transform(F.filter(found, lambda w: w != ""), lambda w: F.concat(F.lit(place + ":"), w))

    after = F.regexp_extract(url, r"(?s)^.*?://[^?#]*(\?[^#]*)?(#.*)?$", 1)
    fragment = F.regexp_extract(url, r"(?s)^.*?://[^?#]*(\?[^#]*)?(#.*)?$", 2)
    every = F.concat(words("h", host_of(url)), words("p", path_of(url)), words("q", after), words("f", fragment))
    return F.array_distinct(F.coalesce(every, F.array().cast("array<string>")))


_MINED = "tokens array<string>, key string, confidence double, support bigint"


def _needed_by_trees(baskets: DataFrame, n: int, least: int, min_confidence: float) -> DataFrame:
    """tokens, confidence, support of the rules of Spark's FP-growth that no part makes idle."""
    marked = baskets.select(F.when(F.col("bad"), F.array_append("items", F.lit(BAD))).otherwise(F.col("items")).alias("items"))
    model = FPGrowth(itemsCol="items", minSupport=(least - 0.5) / n, minConfidence=min_confidence).fit(marked)
    rules = materialise(
        model.associationRules.where(F.col("consequent") == F.array(F.lit(BAD)))
        .select(F.array_sort("antecedent").alias("tokens"), "confidence", F.round(F.col("support") * n).cast("long").alias("support")),
        "url-rules")
    parts = rules.select("tokens", "confidence", F.explode(F.transform(
        "tokens", lambda t: F.array_remove(F.col("tokens"), t))).alias("part"))
    idle = (parts.alias("w").join(rules.alias("s"), (F.col("w.part") == F.col("s.tokens")) & (F.col("s.confidence") >= F.col("w.confidence")))
            .select("w.tokens").distinct())
    return rules.join(idle, "tokens", "left_anti")


def _needed_by_growth(baskets: DataFrame, frequent: DataFrame, least: int, min_confidence: float) -> DataFrame:
    """The same rules for baskets of any length: combinations grow by a token at a time.

    A combination is grown only if every token of it takes rows away and some of its rows are
    not bad. Any other has a part in as many rows, or one that is always bad, and so has all
    that contains it: the part says as much. Equal baskets are one row with their number, and
    combinations of one basket that differ in the last token meet by an equi-join.
    """
    share = F.col("worse") / F.col("uses")
    weighed = (baskets.where(F.size("items") > 0).groupBy("items").agg(F.count("*").alias("n"), F.count(F.when(F.col("bad"), 1)).alias("n_bad"))
               .select(F.monotonically_increasing_id().alias("basket"), "n", "n_bad", "items"))
    found = frequent.select(F.array("token").alias("tokens"), "uses", "worse", F.lit(0.0).alias("told"))
    n_all = baskets.count()
    held = materialise(weighed, "url-weighed").select("basket", "n", "n_bad", F.explode("items").alias("token")).select(
        "basket", "n", "n_bad", F.array("token").alias("tokens"))
    rules, size = [], 1
    while True:
        # told: the greatest confidence of a part that is a rule
        rules.append(found.where((share >= min_confidence) & (share > F.col("told")))
                     .select("tokens", share.alias("confidence"), F.col("worse").alias("support")))
        live = materialise(found.where((F.col("worse") < F.col("uses")) & (F.col("uses") < n_all)), f"url-live-{size}")
        if live.isEmpty():
            break
        held = held.join(live.select("tokens"), "tokens", "left_semi").select(
            "basket", "n", "n_bad", F.slice("tokens", 1, size - 1).alias("head"), F.element_at("tokens", -1).alias("last"))
        held = materialise(held, f"url-held-{size}")
        a, b = held.alias("a"), held.select("basket", "head", F.col("last").alias("next")).alias("b")
        held = a.join(b, ["basket", "head"]).where(F.col("last") < F.col("next")).select(
            "basket", "n", "n_bad", F.concat("head", F.array("last", "next")).alias("tokens"))
        size += 1
        grown = (held.groupBy("tokens").agg(F.sum("n").alias("uses"), F.sum("n_bad").alias("worse")).where(F.col("worse") >= least))
        parts = grown.select("tokens", "uses", "worse", F.explode(F.transform(
            "tokens", lambda t: F.array_remove(F.col("tokens"), t))).alias("part"))
        said = live.select(F.col("tokens").alias("part"), F.col("uses").alias("part_uses"), share.alias("part_share"))
        found = materialise(
            parts.join(said, "part").groupBy("tokens", "uses", "worse").agg(
                F.count("*").alias("parts"), F.min("part_uses").alias("fewest"),
                F.max(F.when(F.col("part_share") >= min_confidence, F.col("part_share")).otherwise(F.lit(0.0))).alias("told"))
            .where((F.col("parts") == size) & (F.col("fewest") > F.col("uses"))).select("tokens", "uses", "worse", "told"), f"url-found-{size}")
    needed = rules[0]
    for more in rules[1:]:
        needed = needed.unionByName(more)
    return needed


def mine_rules(labelled: DataFrame, min_support: float = 0.001, min_count: int = 10, min_confidence: float = 0.7,
               max_tokens: int = 12) -> DataFrame:
    """Token combinations that imply ``bad``: tokens, key (the rarest token), confidence, support.

    ``labelled`` has url and bad (boolean). A combination needs ``min_count`` bad rows and
    ``min_support`` of all labelled rows. ``max_tokens`` is the longest basket for FP-growth;
    it decides the way, not the result.
    """
    spark = labelled.sparkSession
    baskets = materialise(labelled.where(F.col("bad").isNotNull()).select(
        F.monotonically_increasing_id().alias("row"), "bad", tokens_of(F.col("url")).alias("tokens")), "baskets")
    n, n_bad = baskets.agg(F.count("*"), F.count(F.when(F.col("bad"), 1))).first()
    least = max(min_count, -int(-n * min_support // 1))
    if n_bad < least:
        return spark.createDataFrame([], _MINED)
    pairs = baskets.select("row", "bad", F.explode("tokens").alias("token"))
    frequent = materialise(
        pairs.groupBy("token").agg(F.count("*").alias("uses"), F.count(F.when(F.col("bad"), 1)).alias("worse"))
        .where(F.col("worse") >= least), "url-tokens")
    kept = pairs.join(frequent, "token").groupBy("row").agg(F.array_sort(F.collect_list("token")).alias("items"))
    items = F.coalesce("items", F.array().cast("array<string>"))
    baskets = materialise(baskets.join(kept, "row", "left").select("bad", items.alias("items")), "url-baskets")
    if (baskets.agg(F.max(F.size("items"))).first()[0] or 0) <= max_tokens:
        needed = _needed_by_trees(baskets, n, least, min_confidence)
    else:
        needed = _needed_by_growth(baskets, frequent, least, min_confidence)
    rarest = (needed.select("tokens", F.explode("tokens").alias("token")).join(frequent, "token")
              .groupBy("tokens").agg(F.min_by("token", F.struct("uses", "token")).alias("key")))
    return materialise(needed.join(rarest, "tokens").select("tokens", "key", "confidence", "support"), "url-index")


def match_rules(urls: DataFrame, mined: DataFrame) -> DataFrame:
    """url, pattern, confidence: the best mined rule of each distinct url that one matches."""
    key = [F.xxhash64("url").alias("k1"), F.xxhash64(F.lit(7), "url").alias("k2")]
    distinct = materialise(urls.where(F.col("url").isNotNull()).select(*key, "url").groupBy("k1", "k2").agg(F.first("url").alias("url")), "urls")
    tokens = distinct.select("k1", "k2", F.explode(tokens_of(F.col("url"))).alias("key"))
    candidates = tokens.join(mined, "key").select("k1", "k2", "tokens", "confidence", "support")
    whole = (candidates.join(distinct, ["k1", "k2"])
             .where(F.size(F.array_except("tokens", tokens_of(F.col("url")))) == 0))
    best = F.max(F.struct("confidence", "support", F.array_join("tokens", " ").alias("pattern")))
    return (whole.groupBy("k1", "k2").agg(F.first("url").alias("url"), best.alias("b"))
            .select("url", "b.pattern", "b.confidence"))


def judge_urls(pages: DataFrame, labelled: DataFrame, rules: Sequence[Rule] = RULES, **mining) -> DataFrame:
    """page_id, host, path, rule, verdict, pattern, confidence of every row of ``pages`` (page_id, url)."""
    url = F.col("url")
    ruled = pages.select("page_id", "url", host_of(url).alias("host"), path_of(url).alias("path"))
    ruled = ruled.withColumn("r", longest_rule(F.col("host"), F.col("path"), rules))
    matched = match_rules(ruled.where(F.col("r").isNull()).select("url"), mine_rules(labelled, **mining))
    judged = ruled.alias("p").join(matched.alias("m"), F.col("p.r").isNull() & (F.col("p.url") == F.col("m.url")), "left")
    return judged.select("page_id", "host", "path", F.col("r.name").alias("rule"),
                         F.coalesce("r.verdict", F.when(F.col("pattern").isNotNull(), F.lit("block")).otherwise(F.lit("allow"))).alias("verdict"),
                         "pattern", "confidence")


def labelled_urls(pages: DataFrame, labels: DataFrame) -> DataFrame:
    """url and bad of the pages whose page_id is labelled: bad if quality is 0 or toxic 1."""
    bad = (F.col("quality") == 0) | (F.col("toxic") == 1)
    known = (labels.where(F.col("doc_id").isNotNull()).select(F.col("doc_id").alias("page_id"), bad.alias("bad"))
             .groupBy("page_id").agg(F.max("bad").alias("bad")))
    return pages.select("page_id", "url").join(known, "page_id").select("url", "bad")


def op11_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's URL by the rule list, else by what the labels table says of its tokens."""
    pages = read_table(spark, sf_dir, "pages").select("page_id", "url")
    return judge_urls(pages, labelled_urls(pages, read_table(spark, sf_dir, "labels")))
