"""URL filter: a list of rules, and gradient-boosted trees on lexical features for the urls that no rule fits.

The trees learn from labelled urls, at most ``sample`` of them, which are those the rules judge. Features: lengths, path depth, digit
ratio, entropy of the characters, number of parameters, and smoothed block rates of the last one and two labels of
the host, which are counted over all urls that a rule judges. DataFrame functions and Spark's own tree learner only. The
rule list is a short parameter of the query; suffix statistics of more than ``BROADCAST`` rows are joined by a shuffle.

Defined cases: a null url or one without ``://`` has an empty host and path; where labelled urls are missing or all
of one kind, that kind is the verdict (``allow`` without any); repeated rows are judged alike; an empty table gives an
empty result.
"""

from __future__ import annotations

import string

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from transferlens.llm.common import about, staged

Rule = tuple[str, str]
SAMPLE = 20_000
BROADCAST = 20_000
PRIOR = 10.0
FEATURES = ["url_length", "host_length", "path_length", "depth", "labels", "digit_ratio", "host_digit_ratio", "dashes",
            "entropy", "parameters", "last_rate", "last_two_rate"]


def parts(df: DataFrame, url: str = "url") -> DataFrame:
    at = F.locate("://", F.coalesce(F.col(url), F.lit("")))
    rest = F.when(at > 0, F.expr(f"substring(`{url}`, locate('://', `{url}`) + 3)")).otherwise("")
    host = F.translate(F.regexp_extract(rest, "^[^/?#]*", 0), string.ascii_uppercase, string.ascii_lowercase)
    return df.withColumn("host", host).withColumn("path", F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1))


def fits(rule: str) -> Column:
    name, slash, path = rule.partition("/")
    host = (F.col("host") == name) | F.col("host").endswith("." + name)
    return host & F.col("path").startswith(slash + path)


def by_rule(df: DataFrame, rules: list[Rule]) -> DataFrame:
    """rule: the longest that fits; ruled: its verdict."""
    longest = sorted(rules, key=lambda x: -len(x[1]))
    first = [F.when(fits(r), F.struct(F.lit(r).alias("rule"), F.lit(v).alias("verdict"))) for v, r in longest]
    found = F.coalesce(*first) if first else F.lit(None).cast("struct<rule:string,verdict:string>")
    return df.withColumn("_r", found).withColumn("rule", F.col("_r.rule")).withColumn("ruled", F.col("_r.verdict")).drop("_r")


def lexical(df: DataFrame, url: str = "url") -> DataFrame:
    u = F.coalesce(F.col(url), F.lit(""))
    digits = lambda c: F.length(c) - F.length(F.translate(c, string.digits, ""))
    share = lambda n, c: F.when(F.length(c) > 0, n / F.length(c)).otherwise(0.0)
    chars = F.array_distinct(F.split(u, ""))
    portion = lambda c: (F.length(u) - F.length(F.replace(u, c, F.lit("")))) / F.length(u)
    entropy = F.aggregate(chars, F.lit(0.0), lambda sum_, c: sum_ - F.when((c != "") & (portion(c) > 0), portion(c) * F.log2(portion(c))).otherwise(0.0))
    labels = F.split("host", r"\.")
    return df.withColumns({
        "url_length": F.length(u).cast("double"), "host_length": F.length("host").cast("double"),
        "path_length": F.length("path").cast("double"), "depth": F.regexp_count("path", F.lit("/")).cast("double"),
        "labels": F.size(labels).cast("double"), "digit_ratio": share(digits(u), u),
        "host_digit_ratio": share(digits(F.col("host")), F.col("host")),
        "dashes": F.regexp_count("host", F.lit("-")).cast("double"), "entropy": F.coalesce(entropy, F.lit(0.0)),
        "parameters": F.regexp_count(u, F.lit("[?&][^=&#]+=")).cast("double"),
        "last": F.substring_index("host", ".", -1), "last_two": F.substring_index("host", ".", -2),
    })


def block_rates(ruled: DataFrame, base: float) -> dict[str, DataFrame]:
    """The smoothed block rate of each host suffix, over all of ``ruled``."""
    rate = (F.sum("label") + F.lit(PRIOR * base)) / (F.count("*") + F.lit(PRIOR))
    found = {}
    for name in ("last", "last_two"):
        # Written out, so that both sides of a join are shuffled and a hot suffix can be split.
        rates = staged(ruled.groupBy(name).agg(rate.alias(f"{name}_rate")), f"{name}_rates")
        found[name] = F.broadcast(rates) if rates.count() <= BROADCAST else rates
    return found


def with_rates(df: DataFrame, rates: dict[str, DataFrame], base: float) -> DataFrame:
    """Adds the smoothed block rate of both host suffixes; suffixes without a judged url get the base rate."""
    for name, known in rates.items():
        df = df.join(known, name, "left").fillna({f"{name}_rate": base})
    return df


def judge(pages: DataFrame, rules: list[Rule], key: str = "page_id", url: str = "url", sample: int = SAMPLE,
          trees: int = 15, depth: int = 4) -> DataFrame:
    """One row per url: key, host, path, rule, verdict, block_score (null where a rule decides)."""
    rows = pages.select(F.col(key).alias("key"), F.col(url).alias("url"))
    rows = lexical(by_rule(parts(rows), rules))
    label = (F.col("ruled") == "block").cast("double")
    ruled = rows.filter(F.col("ruled").isNotNull()).withColumn("label", label).drop("rule", "ruled")
    # About as many as asked for pass the first filter, so that the exact choice sees no more.
    drawn = about(ruled, sample + sample // 10)
    labelled = staged(drawn.orderBy(F.xxhash64("key", "url"), "url").limit(sample), "labelled_urls")
    n, blocked = ruled.agg(F.count("*"), F.coalesce(F.sum("label"), F.lit(0.0))).first()
    base = blocked / n if n else 0.0
    if base in (0.0, 1.0):
        score = F.lit(base)
        scored = rows
    else:
        rates = block_rates(ruled, base)
        assembler = VectorAssembler(inputCols=FEATURES, outputCol="features")
        train = assembler.transform(with_rates(labelled, rates, base)).select("features", "label").coalesce(4)
        model = GBTClassifier(maxIter=trees, maxDepth=depth, seed=7, cacheNodeIds=False).fit(train.cache())
        train.unpersist()
        scored = model.transform(assembler.transform(with_rates(rows, rates, base)))
        score = F.call_function("element_at", vector(F.col("probability")), F.lit(2))
    scored = scored.withColumn("block_score", F.when(F.col("rule").isNull(), score))
    verdict = F.coalesce("ruled", F.when(F.col("block_score") >= 0.5, "block").otherwise("allow"))
    return scored.select("key", "host", "path", "rule", verdict.alias("verdict"), "block_score")


def vector(column: Column) -> Column:
    from pyspark.ml.functions import vector_to_array

    return vector_to_array(column)
