"""URL filters: host and path rules, then association rules mined from labelled URLs.

A URL becomes a set of tokens (scheme, host, host suffixes, path segments, query keys,
fragment). ``FPGrowth`` mines the token combinations of labelled URLs together with a label
item; rules ``tokens -> block`` are pruned by support and confidence, and a rule more
specific than a kept rule of at least its confidence is dropped. Rules match through an
inverted index: the posting of a rule is its rarest token, and a URL that holds this token
is checked for the rest.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BLOCK = "label=block"
SALTS = 16

# The contract's rules: host, path, action.
PATH_RULES = (("net", "/", "block"), ("example.net", "/en/", "allow"),
              ("example.com", "/de/", "block"), ("org", "/fr/", "allow"))


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/ ? #`` or end, A-Z lower-cased; else empty."""
    rest = F.when(F.instr(url, "://") > 0, F.expr("substring(url, instr(url, '://') + 3)"))
    host = F.regexp_extract(rest, r"^([^/?#]*)", 1)
    return F.coalesce(F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ",
                                  "abcdefghijklmnopqrstuvwxyz"), F.lit(""))


def path_of(url: Column) -> Column:
    """After the host up to ``? #`` or end; empty without ``://``."""
    rest = F.when(F.instr(url, "://") > 0, F.expr("substring(url, instr(url, '://') + 3)"))
    return F.coalesce(F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def path_rule(host: Column, path: Column, rules: Sequence[tuple] = PATH_RULES) -> Column:
    """The longest rule that fits (as struct rule, action), or null.

    A rule fits its host and all subdomains if the path starts with the rule's path; of
    several the longest host + path text wins.
    """
    picked = F.lit(None).cast("struct<rule:string,action:string>")
    for h, p, action in sorted(rules, key=lambda r: len(r[0] + r[1])):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        picked = F.when(fits, F.struct(F.lit(h + p).alias("rule"),
                                       F.lit(action).alias("action"))).otherwise(picked)
    return picked


def url_tokens(url: Column, host: Column, path: Column) -> Column:
    """Distinct tokens of a URL (numbers are folded into one token)."""
    labels = F.split(host, r"\.")
    n = F.size(labels)
    segments = F.filter(F.split(path, "/"), lambda s: s != "")
    query = F.regexp_extract(url, r"\?([^#]*)", 1)
    return F.array_distinct(F.filter(F.concat(
        F.array(F.concat(F.lit("scheme="), F.regexp_extract(url, r"^([A-Za-z0-9+.-]*)://", 1)),
                F.concat(F.lit("host="), host),
                F.concat(F.lit("tld="), F.element_at(labels, -1)),
                F.when(n >= 2, F.concat(F.lit("site="), F.array_join(F.slice(
                    labels, F.greatest(n - 2, F.lit(1)), F.lit(3)), "."))),
                F.when(url.contains("#"), F.lit("fragment"))),
        F.transform(labels, lambda s: F.concat(F.lit("name="), s)),
        F.transform(segments, lambda s: F.concat(
            F.lit("path="), F.regexp_replace(s, r"[0-9]+", "0"))),
        F.transform(F.filter(F.split(query, "&"), lambda s: s != ""),
                    lambda s: F.concat(F.lit("query="), F.regexp_extract(s, r"^([^=]*)", 1)))),
        lambda t: t.isNotNull() & ~t.endswith("=")))


def mine_rules(labelled: DataFrame, min_support: float = 0.002, min_confidence: float = 0.7,
               min_rows: int = 20) -> DataFrame:
    """Rules (rule_id, tokens, confidence, support, key) from rows (tokens, blocked).

    A rule needs ``min_support`` of the labelled rows and at least ``min_rows`` of them.
    ``key`` is the rule's rarest token among the labelled rows. A rule is dropped when a
    rule on a subset of its tokens has at least its confidence. An empty input or one
    without a blocked row gives no rules.
    """
    items = labelled.select(F.when(F.col("blocked"), F.array_append("tokens", F.lit(BLOCK)))
                            .otherwise(F.col("tokens")).alias("items"))
    n = items.count()
    model = FPGrowth(itemsCol="items", minSupport=min(1.0, max(min_support, min_rows / max(n, 1))),
                     minConfidence=min_confidence).fit(items)
    rules = (model.associationRules
             .where((F.size("consequent") == 1) & (F.col("consequent")[0] == BLOCK))
             .select(F.array_sort("antecedent").alias("tokens"), "confidence", "support")
             .withColumn("rule_id", F.xxhash64("tokens")))
    # A more general rule: an antecedent without one of the tokens; compared through the id
    # of every one-smaller token set, so no pairs of rules are formed.
    smaller = rules.select(
        "rule_id", "confidence",
        F.explode(F.transform("tokens", lambda t: F.xxhash64(
            F.array_remove(F.col("tokens"), t)))).alias("general_id"))
    redundant = (smaller.alias("s").join(
        rules.select(F.col("rule_id").alias("general_id"),
                     F.col("confidence").alias("general_confidence")), "general_id")
        .where("general_confidence >= confidence").select("rule_id").distinct())
    kept = rules.join(redundant, "rule_id", "left_anti")
    singles = (model.freqItemsets.where(F.size("items") == 1)
               .select(F.col("items")[0].alias("token"), F.col("freq")))
    return (kept.select("*", F.explode("tokens").alias("token"))
            .join(singles, "token")
            .groupBy("rule_id").agg(F.first("tokens").alias("tokens"),
                                    F.first("confidence").alias("confidence"),
                                    F.first("support").alias("support"),
                                    F.min(F.struct("freq", "token"))["token"].alias("key")))


def judge_urls(pages: DataFrame, labels: DataFrame, id_col: str = "page_id",
               url_col: str = "url", rules: Sequence[tuple] = PATH_RULES,
               min_support: float = 0.002, min_confidence: float = 0.7,
               min_rows: int = 20) -> DataFrame:
    """Per page: page_id, host, path, rule, verdict, rule_confidence.

    ``labels`` holds (url, blocked) rows. The path rules decide first; else ``block`` if an
    association rule fires, else ``allow``. Pages without a usable URL have empty host and path and are allowed;
    distinct URLs are judged once, so repeated URLs cost one look-up.
    """
    url = F.col("url")
    urls = (pages.select(F.col(url_col).alias("url")).where("url is not null").distinct()
            .select("url", host_of(url).alias("host"), path_of(url).alias("path"))
            .withColumn("tokens", url_tokens(url, F.col("host"), F.col("path"))))
    known = (labels.select("url", "blocked").where("url is not null and blocked is not null")
             .select("blocked", url_tokens(url, host_of(url), path_of(url)).alias("tokens")))
    mined = mine_rules(known, min_support, min_confidence, min_rows)
    # Inverted index: the posting list of a rule is its key token. Only the keys of rules
    # are looked up, and the rest of the rule is checked on the URL's own tokens.
    fired = (urls.select("url", "tokens", F.explode("tokens").alias("key"))
             .join(mined.select("key", F.col("tokens").alias("need"), "confidence"), "key")
             .where(F.size(F.array_except("need", "tokens")) == 0)
             .groupBy("url").agg(F.max("confidence").alias("rule_confidence")))
    # Salted look-up: one URL may hold a third of all pages.
    spread = fired.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    judged = (pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"))
              .withColumn("salt", F.pmod(F.xxhash64("page_id"), F.lit(SALTS)).cast("int"))
              .join(spread, ["url", "salt"], "left"))
    host, path = host_of(url), path_of(url)
    return (judged.select("page_id", host.alias("host"), path.alias("path"),
                          path_rule(host, path, rules).alias("picked"), "rule_confidence")
            .select("page_id", "host", "path", F.col("picked.rule").alias("rule"),
                    F.coalesce("picked.action",
                               F.when(F.col("rule_confidence").isNotNull(), F.lit("block"))
                               .otherwise(F.lit("allow"))).alias("verdict"),
                    "rule_confidence"))


def labelled_urls(pages: DataFrame, labels: DataFrame) -> DataFrame:
    """(url, blocked): the last number of a page's path names its document, whose quality or
    toxicity label decides (quality 0 or toxic 1: blocked)."""
    doc = F.regexp_extract(path_of(F.col("url")), r"/(\d{1,18})(?:\.[a-z]+)?/?$", 1)
    marks = (labels.groupBy("doc_id").agg(F.min("quality").alias("quality"),
                                          F.max("toxic").alias("toxic")))
    return (pages.select("url", F.nullif(doc, F.lit("")).cast("long").alias("doc_id"))
            .join(marks, "doc_id")
            .select("url", ((F.coalesce("quality", F.lit(1)) == 0)
                            | (F.coalesce("toxic", F.lit(0)) == 1)).alias("blocked")))
