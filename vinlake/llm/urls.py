"""URL filters: given host and path rules first, then association rules mined from labelled pages.

A URL becomes a set of tokens: labels of its host, segments of its path, names of its parameters, digits as
``0``. Spark's FP-growth mines token combinations that go together with the label of bad pages; rules below the
wanted support, confidence or lift are pruned, and so are rules that a shorter kept rule implies. The rules
that remain are found through an inverted index on each rule's rarest token: a URL meets only rules whose
rarest token it has, and then has to have all the others.

DataFrame operations and Spark's FP-growth only, all in the JVM.
"""

from dataclasses import dataclass
from functools import reduce
from operator import or_
from string import ascii_lowercase, ascii_uppercase

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vinlake.llm.common import stored
from vinlake.operators.joins import left_join_splittable

BAD = "label=bad"
SUPPORT = 0.002  # of the labelled pages
LEAST = 10  # bad pages that a rule has to have at least, so that few labels do not make rules of chance
CONFIDENCE = 0.8
LIFT = 2.0


@dataclass(frozen=True)
class Rule:
    """A verdict for a host with its subdomains, where the path starts with ``path``."""

    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


# The rules that every page is held against first.
GIVEN = [
    Rule("allow", "com", "/"),
    Rule("block", "example.com", "/en/"),
    Rule("allow", "www.example.com", "/en/"),
    Rule("block", "net", "/es/"),
    Rule("block", "net", "/fr/"),
]


def with_parts(pages: DataFrame) -> DataFrame:
    """``page_id, url, host, path``; both parts are empty for NULL and for URLs without ``://``."""
    begin = F.instr("url", "://")
    rest = F.when(begin > 0, F.expr("substr(url, instr(url, '://') + 3)")).otherwise("")
    split = pages.select("page_id", "url", F.coalesce(rest, F.lit("")).alias("_rest"))
    split = split.withColumn("_host", F.regexp_extract("_rest", "^[^/?#]*", 0))
    after = F.expr("substr(_rest, length(_host) + 1)")
    host, path = F.translate("_host", ascii_uppercase, ascii_lowercase), F.regexp_extract(after, "^[^?#]*", 0)
    return split.select("page_id", "url", host.alias("host"), path.alias("path"), after.alias("_after"))


def fits(rule: Rule) -> Column:
    """Whether a rule fits ``host`` and ``path``."""
    here = (F.col("host") == rule.host) | F.col("host").endswith("." + rule.host)
    return here & F.col("path").startswith(rule.path)


def longest(rules: list[Rule], value: str) -> Column:
    """``text`` or ``verdict`` of the longest rule that fits, NULL if none does."""
    out = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda rule: (len(rule.text), rule.text)):
        out = F.when(fits(rule), F.lit(getattr(rule, value))).otherwise(out)
    return out


def tokens() -> Column:
    """Distinct tokens of a URL from ``host``, ``path`` and ``_after``, in lower case."""

    def marked(mark: str, parts: Column) -> Column:
        named = F.filter(parts, lambda part: part != "")
        return F.transform(named, lambda part: F.concat(F.lit(mark), F.regexp_replace(F.lower(part), "[0-9]+", "0")))

    query = F.regexp_extract("_after", r"\?([^#]*)", 1)
    names = F.transform(F.split(query, "&"), lambda part: F.substring_index(part, "=", 1))
    parts = [marked("host:", F.split("host", r"\.")), marked("path:", F.split("path", "/")), marked("key:", names)]
    return F.array_distinct(F.concat(*parts))


def mine(pages: DataFrame, labels: DataFrame) -> DataFrame:
    """``rule`` (tokens), ``key`` (the rarest), ``confidence`` of the kept rules, as many as there are.

    ``pages`` has page_id and tokens, ``labels`` doc_id and quality, 0 for a bad page; the label of a page is
    that of its number, and a page with several labels is bad if one says so. No labels, no rules.
    """
    marks = labels.filter(F.col("quality").isNotNull() & F.col("doc_id").isNotNull())
    marks = marks.groupBy(F.col("doc_id").alias("_id")).agg(F.min("quality").alias("_quality"))
    known = pages.join(marks, F.col("page_id") == F.col("_id")).filter(F.size("tokens") > 0)
    items = F.when(F.col("_quality") == 0, F.array_append("tokens", F.lit(BAD))).otherwise(F.col("tokens"))
    baskets = stored(known.select(items.alias("items")), "baskets")
    n = max(baskets.count(), 1)
    support = min(max(SUPPORT, LEAST / n), 1.0)
    found = FPGrowth(itemsCol="items", minSupport=support, minConfidence=CONFIDENCE).fit(baskets)
    enough = (F.col("lift") >= LIFT) & (F.round(F.col("support") * n) >= LEAST)
    rules = found.associationRules.filter((F.col("consequent") == F.array(F.lit(BAD))) & enough)
    rules = stored(rules.select(F.array_sort("antecedent").alias("rule"), "confidence"), "rules")
    # A rule is implied if dropping one of its tokens leaves a kept rule. Lists of one length can't imply each other.
    shorter = rules.select(F.col("rule").alias("_rule"), F.explode("rule").alias("_drop"))
    shorter = shorter.select("_rule", F.array_remove("_rule", F.col("_drop")).alias("_left"))
    implied = shorter.join(rules, F.col("_left") == F.col("rule")).select("_rule").distinct()
    rules = rules.join(implied, F.col("rule") == F.col("_rule"), "left_anti")
    single = found.freqItemsets.filter(F.size("items") == 1).select(F.col("items")[0].alias("_token"), "freq")
    rarest = rules.select("rule", "confidence", F.explode("rule").alias("_part")).join(single, F.col("_part") == F.col("_token"))
    rarest = rarest.groupBy("rule", "confidence").agg(F.min_by("_part", F.struct("freq", "_part")).alias("key"))
    return stored(rarest, "index")


def matched(pages: DataFrame, index: DataFrame) -> DataFrame:
    """``_url`` of the distinct URLs that have all tokens of a mined rule."""
    distinct = pages.groupBy("url").agg(F.first("tokens").alias("tokens"))
    met = distinct.select("url", "tokens", F.explode("tokens").alias("_token"))
    met = met.join(index, F.col("_token") == F.col("key"))
    return met.filter(F.size(F.array_except("rule", "tokens")) == 0).select(F.col("url").alias("_url")).distinct()


def judge(pages: DataFrame, labels: DataFrame, rules: list[Rule] | None = None) -> DataFrame:
    """``page_id, host, path, rule, verdict`` of every page.

    ``pages`` has page_id and url; other columns are not read. The longest given rule that fits decides (of
    equally long ones the last by text); without one a mined rule blocks, else the page is allowed. NULL and
    malformed URLs have empty parts and are allowed. Repeated rows get equal results. URLs of any length are
    taken whole. An empty table gives an empty result.
    """
    rules = GIVEN if rules is None else rules
    split = with_parts(pages).withColumn("tokens", tokens())
    fit = reduce(or_, [fits(rule) for rule in rules], F.lit(False))
    bad = matched(split.filter(~fit), mine(split.select("page_id", "tokens"), labels))
    bad = stored(bad.select("_url", F.lit("block").alias("mined")), "matched")
    given = split.select("page_id", "url", "host", "path", longest(rules, "text").alias("rule"), longest(rules, "verdict").alias("_given"))
    joined = left_join_splittable(given, bad.withColumnRenamed("_url", "url"), "url")
    verdict = F.coalesce("_given", "mined", F.lit("allow"))
    return joined.select("page_id", "host", "path", "rule", verdict.alias("verdict"))
