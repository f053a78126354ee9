"""URL filter: a list of rules, and association rules mined from labelled URLs for what the list leaves open.

A URL is a set of tokens. FP-growth finds the token combinations that are frequent among labelled URLs together with
their label; rules of enough support and confidence remain, unless a shorter rule is as good. Confidence is balanced: it is
what it would be if either label were as frequent, so a rule must tell more than the frequent label does by itself, and the
rare label can have rules. An inverted index from a rule's rarest token to the rule finds the rules of a URL, and the most
confident one decides.

* Different URLs count once, in mining and in matching, so copies of a URL cost nothing. Of several labels for a URL the
  most frequent one counts, ties block.
* Fitting takes at most ``most_labelled`` labelled URLs, those with the smallest hash, with every token of each; support
  alone bounds the miner. Tokens that the same URLs have are mined as one, and a rule of theirs holds for each of them.
  Tokens of every URL are left out: a rule with one is never more confident than the same without. Matching reads every
  token of every URL.
* A missing URL, or one without ``://``, has no host, path or tokens, fits no rule and is allowed; so is a URL that no rule
  decides, and every URL where nothing is labelled. Repeated rows get equal verdicts. Extra columns are kept.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.common import fresh, lower_ascii
from ledgerlens.session import staged

ALLOW, BLOCK = "allow", "block"
CLASS = "class="


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path


@dataclass(frozen=True)
class Settings:
    least_support: float = 0.005
    #: In small samples, a combination must also occur so often.
    least_count: int = 5
    #: Of the balanced confidence.
    least_confidence: float = 0.8
    most_labelled: int = 50_000


def _after_scheme(url: Column) -> Column:
    mark = F.instr(url, "://")
    return F.when(mark > 0, F.substr(url, mark + 3)).otherwise("")


def host_of(url: Column) -> Column:
    return F.coalesce(lower_ascii(F.regexp_extract(_after_scheme(url), r"^[^/?#]*", 0)), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(_after_scheme(url), r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def listed(host: Column, path: Column, rules: Sequence[Rule]) -> Column:
    """The longest rule that fits, as a struct (name, verdict); null if none does."""
    found = F.lit(None).cast("struct<name:string,verdict:string>")
    for r in sorted(rules, key=lambda r: len(r.name)):
        fits = ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path)
        found = F.when(fits, F.struct(F.lit(r.name).alias("name"), F.lit(r.verdict).alias("verdict"))).otherwise(found)
    return found


def tokens(url: Column) -> Column:
    """Scheme, host labels and their words, the last label, path pieces with digits made equal, ending, query keys."""
    host, path = host_of(url), path_of(url)
    tagged = lambda tag, items: F.transform(items, lambda x: F.concat(F.lit(tag), x))
    pieces = F.transform(F.split(path, "/"), lambda x: F.regexp_replace(lower_ascii(x), "[0-9]+", "0"))
    query = F.regexp_extract(url, r"\?([^#]*)", 1)
    keys = F.transform(F.split(query, "&"), lambda x: F.regexp_extract(x, "^[^=]*", 0))
    found = F.concat(
        F.array(F.concat(F.lit("scheme="), lower_ascii(F.substring_index(url, "://", 1)))),
        tagged("host=", F.split(host, r"\.")), tagged("hostword=", F.split(host, "[.-]")),
        F.array(F.concat(F.lit("last="), F.substring_index(host, ".", -1))),
        F.array(F.concat(F.lit("first="), F.element_at(F.concat(F.slice(pieces, 2, 1), F.array(F.lit(""))), 1))),
        tagged("path=", pieces), F.array(F.concat(F.lit("ending="), F.regexp_extract(path, r"\.([A-Za-z0-9]+)$", 1))),
        tagged("key=", keys), F.when(F.contains(url, F.lit("#")), F.array(F.lit("mark=#"))).otherwise(F.array(F.lit("mark="))),
    )
    named = F.filter(F.array_distinct(found), lambda x: ~x.endswith("="))
    return F.when(F.contains(url, F.lit("://")), named).otherwise(F.array().cast("array<string>"))


def _labelled(urls: DataFrame, s: Settings) -> DataFrame:
    """(url, tokens, blocked): a bounded sample of the different URLs with a label."""
    known = urls.filter(F.contains("url", F.lit("://")) & F.col("label").isin(ALLOW, BLOCK))
    once = known.groupBy("url").agg((F.avg((F.col("label") == BLOCK).cast("int")) >= 0.5).alias("blocked"))
    some = once.orderBy(F.xxhash64("url"), "url").limit(s.most_labelled)
    return some.select("url", tokens(F.col("url")).alias("tokens"), "blocked")


def mined(urls: DataFrame, s: Settings = Settings()) -> DataFrame:
    """(antecedent, verdict, balanced, confidence, support, token) from rows (url, label allow or block); token is the rarest."""
    schema = "antecedent array<string>, verdict string, balanced double, confidence double, support double, token string"
    sample = staged(_labelled(urls, s), "labelled")
    rate, n = sample.agg(F.avg(F.col("blocked").cast("int")), F.count("*")).first()
    if rate in (None, 0.0, 1.0):  # one label alone teaches nothing
        return sample.sparkSession.createDataFrame([], schema)
    each = sample.select("url", F.explode("tokens").alias("token"))
    counts = staged(
        each.groupBy("token").agg(
            F.count("*").alias("n"), F.bit_xor(F.xxhash64("url")).alias("mark"), F.bit_xor(F.xxhash64("url", F.lit(1))).alias("mark2")
        ),
        "tokens",
    )
    # A token of every URL tells nothing, alone or beside others. Of tokens that the same URLs have, one is mined.
    alike = counts.filter(F.col("n") < n).groupBy("n", "mark", "mark2").agg(
        F.min("token").alias("item"), F.sort_array(F.collect_list("token")).alias("tokens")
    )
    of_url = each.join(alike.select(F.col("item").alias("token")), "token").groupBy("url").agg(F.collect_list("token").alias("found"))
    label = F.concat(F.lit(CLASS), F.when(F.col("blocked"), BLOCK).otherwise(ALLOW))
    none = F.array().cast("array<string>")
    items = sample.join(of_url, "url", "left").select(F.array_append(F.coalesce("found", none), label).alias("items"))
    support = min(1.0, max(s.least_support, s.least_count / n))
    # The confidence that is as good as the balanced one, for the rarer label.
    odds = s.least_confidence / (1 - s.least_confidence) * min(rate, 1 - rate) / max(rate, 1 - rate)
    model = FPGrowth(itemsCol="items", minSupport=support, minConfidence=odds / (1 + odds)).fit(items)
    found = model.associationRules.filter(F.element_at("consequent", 1).startswith(CLASS) & (F.col("lift") > 1))
    verdict = F.substring_index(F.element_at("consequent", 1), "=", -1)
    own = F.when(verdict == BLOCK, F.lit(rate)).otherwise(F.lit(1 - rate))
    agree, differ = F.col("confidence") / own, (1 - F.col("confidence")) / (1 - own)
    rules = staged(
        found.select(
            F.array_sort("antecedent").alias("antecedent"), verdict.alias("verdict"), (agree / (agree + differ)).alias("balanced"),
            "confidence", "support",
        ).filter(F.col("balanced") >= s.least_confidence - 1e-12),
        "rules",
    )
    # A rule goes if leaving out one of its tokens gives a rule for the same verdict that is as confident.
    shorter = rules.withColumn("left_out", F.explode("antecedent")).select(
        "antecedent", "verdict", "confidence", F.array_remove("antecedent", F.col("left_out")).alias("part")
    )
    parts = rules.select(F.col("antecedent").alias("part"), "verdict", F.col("confidence").alias("part_confidence"))
    needless = shorter.join(parts, ["part", "verdict"]).filter("part_confidence >= confidence").select("antecedent", "verdict")
    pruned = rules.join(needless, ["antecedent", "verdict"], "left_anti")
    by_token = _spelled(pruned, alike).withColumn("token", F.explode("antecedent")).join(counts.select("token", "n"), "token")
    rarest = by_token.groupBy("antecedent", "verdict", "balanced", "confidence", "support").agg(F.min(F.struct("n", "token")).alias("rare"))
    return staged(rarest.select("antecedent", "verdict", "balanced", "confidence", "support", "rare.token"), "rules")


def _spelled(rules: DataFrame, alike: DataFrame) -> DataFrame:
    """The rules in every spelling: each item of an antecedent stands for any one of the tokens that the same URLs have."""
    each = rules.withColumn("item", F.explode("antecedent")).join(alike.select("item", "tokens"), "item")
    lists = each.groupBy("antecedent", "verdict", "balanced", "confidence", "support").agg(F.collect_list("tokens").alias("lists"))
    longer = lambda found, tokens: F.flatten(
        F.transform(found, lambda part: F.transform(tokens, lambda token: F.array_append(part, token)))
    )
    spellings = F.aggregate("lists", F.array(F.array().cast("array<string>")), longer)
    return lists.select(F.explode(spellings).alias("spelling"), "verdict", "balanced", "confidence", "support").select(
        F.array_sort("spelling").alias("antecedent"), "verdict", "balanced", "confidence", "support"
    )


def matched(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """(url, verdict, confidence, antecedent) for the different URLs that some mined rule fits."""
    once = urls.select("url").distinct().withColumn("tokens", tokens(F.col("url")))
    candidates = once.withColumn("token", F.explode("tokens")).join(rules, "token")
    fitting = candidates.filter(F.size(F.array_except("antecedent", "tokens")) == 0)
    # Ties go to the rule of more support, then to blocking.
    best = F.max(F.struct("balanced", "support", "verdict", "antecedent", "confidence")).alias("best")
    return fitting.groupBy("url").agg(best).select("url", "best.verdict", "best.confidence", "best.antecedent")


def judged(
    pages: DataFrame, labelled: DataFrame, rules: Sequence[Rule], settings: Settings = Settings(), url: str = "url",
    name: str = "judged",
) -> DataFrame:
    """The pages with a struct column (host, path, rule, verdict, confidence, antecedent)."""
    mined_rules = mined(labelled, settings)
    u = F.col(url)
    open_urls = pages.filter(listed(host_of(u), path_of(u), rules).isNull()).select(u.alias("url"))
    key, found = fresh(pages, "_url"), fresh(pages, "_found")
    hits = matched(open_urls, mined_rules).select(
        F.col("url").alias(key), F.struct("verdict", "confidence", "antecedent").alias(found)
    )
    # A plain join: the rows of a hot URL are split by the adaptive planner.
    joined = pages.join(hits, F.col(url) == F.col(key), "left")
    rule, hit = listed(host_of(u), path_of(u), rules), F.col(found)
    result = F.struct(
        host_of(u).alias("host"), path_of(u).alias("path"), rule["name"].alias("rule"),
        F.coalesce(rule["verdict"], hit["verdict"], F.lit(ALLOW)).alias("verdict"), hit["confidence"].alias("confidence"),
        hit["antecedent"].alias("antecedent"),
    )
    return joined.withColumn(name, result).select(*pages.columns, name)
