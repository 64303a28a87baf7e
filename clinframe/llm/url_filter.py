"""URL filter: allow/block rules, and gradient-boosted trees on lexical features for the rest."""

from __future__ import annotations

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut

#: (verdict, host, path) rules of the registered query (fixed values).
RULES = [("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"),
         ("allow", "com", "/fr/"), ("block", "com", "/de/")]

#: The trees are fitted on at most so many labelled URLs, those of smallest hash.
MAX_TRAINING = 20_000

FEATURES = ["url_length", "host_length", "path_length", "depth", "host_labels", "digit_ratio", "entropy", "n_params",
            "n_hyphens", "has_query", "has_fragment", "is_https", "suffix_log_count", "suffix_block", "section_log_count", "section_block"]


def split_url(url: Column) -> tuple[Column, Column]:
    """(host, path): host after the first :// with A-Z lower-cased, path before ? and #; both empty without ://."""
    rest = F.when(F.instr(url, "://") > 0, F.substring(url, F.instr(url, "://") + 3, F.length(url))).otherwise(F.lit(""))
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    host = F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), upper, lower)
    return F.coalesce(host, F.lit("")), F.coalesce(F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def match_rule(host: Column, path: Column, rules) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits; both null if none does."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for v, h, p in sorted(rules, key=lambda r: (len(r[1]) + len(r[2]), r)):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        rule, verdict = F.when(fits, F.lit(h + p)).otherwise(rule), F.when(fits, F.lit(v)).otherwise(verdict)
    return rule, verdict


def _entropy(text: Column) -> Column:
    """Bits per character."""
    n = F.length(text)
    share = lambda c: (n - F.length(F.replace(text, c, F.lit("")))) / n
    return F.when(n > 0, F.aggregate(F.array_distinct(F.split(text, "")), F.lit(0.0),
                                     lambda acc, c: F.when(c == "", acc).otherwise(acc - share(c) * F.log2(share(c))))).otherwise(0.0)


def _featured(urls: DataFrame) -> DataFrame:
    u = F.coalesce("url", F.lit(""))
    count = lambda c: F.length(u) - F.length(F.replace(u, F.lit(c), F.lit("")))
    labels = F.split("host", r"\.")
    return urls.select(
        "*",
        F.length(u).cast("double").alias("url_length"), F.length("host").cast("double").alias("host_length"),
        F.length("path").cast("double").alias("path_length"),
        (F.length("path") - F.length(F.replace("path", F.lit("/"), F.lit("")))).cast("double").alias("depth"),
        F.size(labels).cast("double").alias("host_labels"),
        (F.length(F.regexp_replace(u, "[^0-9]", "")) / F.greatest(F.length(u), F.lit(1))).alias("digit_ratio"),
        _entropy(u).alias("entropy"), (count("&") + (count("?") > 0).cast("int")).cast("double").alias("n_params"),
        count("-").cast("double").alias("n_hyphens"), (count("?") > 0).cast("double").alias("has_query"),
        (count("#") > 0).cast("double").alias("has_fragment"), u.startswith("https:").cast("double").alias("is_https"),
        F.substring_index("host", ".", -2).alias("suffix"), F.regexp_extract("path", r"^/([^/]*)", 1).alias("section"))


#: Label shares of a training URL come from the other folds, so that they don't tell its own label.
FOLDS = 5


def _statistics(urls: DataFrame, key: str) -> DataFrame:
    """Per value of ``key``: log count of the different URLs, and per fold how many are labelled and labelled block."""
    count = lambda f, c: F.count(F.when((F.col("fold") == f) & c, 1))
    return urls.groupBy(key).agg(
        F.log(F.count("*") + 1.0).alias(f"{key}_log_count"),
        F.array(*[count(f, F.col("label").isNotNull()) for f in range(FOLDS)]).alias(f"{key}_labelled"),
        F.array(*[count(f, F.col("label") == 1) for f in range(FOLDS)]).alias(f"{key}_blocked"))


def _shares(rows: DataFrame, without_fold: bool) -> DataFrame:
    """Smoothed share of block among the labelled URLs of suffix and section; in training those of the other folds."""
    def total(c):
        whole = sum((F.col(c)[f] for f in range(1, FOLDS)), F.col(c)[0])
        return whole - F.col(c)[F.col("fold")] if without_fold else whole
    return rows.withColumns({f"{k}_block": (total(f"{k}_blocked") + 1.0) / (total(f"{k}_labelled") + 2.0) for k in ("suffix", "section")})


def url_verdicts(pages: DataFrame, rules=RULES, max_training: int = MAX_TRAINING, trees: int = 20, depth: int = 4,
                 url_col: str = "url") -> DataFrame:
    """``pages`` with host, path, rule, block_score and verdict (allow or block).

    The longest rule that fits decides (host or subdomain, and start of the
    path).  URLs without a rule get the verdict of gradient-boosted trees, for
    which the URLs that a rule decides are the labelled ones.  Suffix and
    section statistics cover all different URLs; the trees are fitted on the
    ``max_training`` different labelled URLs of smallest hash, each with the
    label shares of other folds.  A URL counts once however many rows have it.
    Without labelled URLs everything else is allowed; with labels of one kind
    that kind is returned.

    Null URLs and URLs without :// have an empty host and path, fit no rule and
    are judged by the trees.  Repeated rows each get their verdict; columns
    named like a result are replaced.  Statistics are aggregated map-side and
    joined by size; a host with a third of all rows is no hot group, as the
    join's other side is small or split by adaptive execution.
    """
    made = {"host", "path", "rule", "block_score", "verdict"}
    names = [c for c in pages.columns if c not in made]
    host, path = split_url(F.col("u.url"))
    base = pages.select(F.struct(*names).alias("row"), F.struct(F.col(url_col).alias("url")).alias("u"))
    base = base.select("row", "u.url", host.alias("host"), path.alias("path"))
    rule, verdict = match_rule(F.col("host"), F.col("path"), rules)
    ruled = base.select("*", rule.alias("rule"), verdict.alias("ruled"))
    keyed = _featured(ruled.withColumn("label", F.when(F.col("ruled") == "block", 1).when(F.col("ruled") == "allow", 0)))
    # rule, label, suffix and section follow from the URL
    urls = cut(keyed.groupBy("url").agg(*[F.first(c).alias(c) for c in ("label", "suffix", "section")])
               .withColumn("fold", F.pmod(F.xxhash64("url", F.lit("fold")), F.lit(FOLDS)).cast("int")), "urls")
    suffixes, sections = cut(_statistics(urls, "suffix"), "suffixes"), cut(_statistics(urls, "section"), "sections")
    rows = _shares(keyed.join(suffixes, "suffix").join(sections, "section"), False)
    chosen = urls.filter("label is not null").orderBy(F.xxhash64("url"), "url").limit(max_training)
    split = split_url(F.col("url"))
    chosen = _featured(chosen.drop("suffix", "section").withColumn("host", split[0]).withColumn("path", split[1]))
    sample = cut(_shares(chosen.join(suffixes, "suffix").join(sections, "section"), True)
                 .select("url", *FEATURES, F.col("label").cast("double").alias("label")), "labelled")
    kinds = [r[0] for r in sample.select("label").distinct().collect()]  # two at most
    if len(kinds) < 2:
        scored = rows.withColumn("block_score", F.lit(kinds[0] if kinds else 0.0))
    else:
        assembler = VectorAssembler(inputCols=FEATURES, outputCol="features")
        model = GBTClassifier(labelCol="label", featuresCol="features", maxIter=trees, maxDepth=depth, seed=17).fit(
            assembler.transform(sample))
        scored = model.transform(assembler.transform(rows)).withColumn("block_score", vector_to_array("probability")[1])
    judged = F.when(F.col("block_score") >= 0.5, "block").otherwise("allow")
    return scored.select("row.*", "host", "path", "rule", "block_score", F.coalesce("ruled", judged).alias("verdict"))
