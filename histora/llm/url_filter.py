"""URL filter: host and path rules first, then gradient-boosted trees over lexical features of the URL.

Everything is built from DataFrame functions and MLlib's DataFrame estimators; no Python runs in tasks.
The trees are trained on the URLs that the rules already decide (their verdict is the label), on a
bounded sample of them; the statistics of host suffixes are counted over all labelled rows.

Defined cases: a null URL, or one without ``://``, has an empty host and an empty path, no rule, and is
judged by the method like any other. Repeated rows are judged alike. If the rules leave only one class
(or no row at all), the verdict is that class (``allow`` for none). Columns of the input other than the
URL and its id are ignored, so clashing names do no harm.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from histora.llm.common import stored


@dataclass(frozen=True)
class Rule:
    host: str
    path: str
    verdict: str

    @property
    def name(self) -> str:
        return self.host + self.path


# The rules of the registered query.
RULES = (
    Rule("com", "/", "allow"),
    Rule("example.com", "/en/", "block"),
    Rule("www.example.com", "/en/", "allow"),
    Rule("net", "/es/", "block"),
    Rule("net", "/fr/", "block"),
)

#: Rows at most (in expectation) that the trees are trained on, and hash buckets of host suffixes.
TRAIN_ROWS = 50_000
SUFFIX_BUCKETS = 1024

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    return F.coalesce(F.translate(F.regexp_extract(url, r"://([^/?#]*)", 1), _UPPER, _UPPER.lower()), F.lit(""))


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; else empty."""
    return F.coalesce(F.regexp_extract(url, r"://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_fits(rule: Rule, host: Column, path: Column) -> Column:
    return ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)


def matched_rule(rules, host: Column, path: Column, value) -> Column:
    """``value(rule)`` of the longest rule that fits, null if none does."""
    hit = None
    for rule in sorted(rules, key=lambda r: (-len(r.name), r.name)):
        cond = rule_fits(rule, host, path)
        hit = F.when(cond, value(rule)) if hit is None else hit.when(cond, value(rule))
    return hit if hit is not None else F.lit(None).cast("string")


def _count(text: Column, pattern: str) -> Column:
    return F.regexp_count(text, F.lit(pattern)).cast("double")


def _entropy(text: Column) -> Column:
    """Shannon entropy in bits of the text's characters."""
    n = F.greatest(F.length(text), F.lit(1)).cast("double")

    def term(acc, ch):
        p = (F.length(text) - F.length(F.replace(text, ch))) / n
        return acc - F.when(p > 0, p * F.log2(p)).otherwise(F.lit(0.0))

    return F.aggregate(F.array_distinct(F.split(text, "")), F.lit(0.0), term)


def lexical_features(url: Column, host: Column, path: Column) -> dict[str, Column]:
    """The features that need nothing but the URL itself."""
    text = F.coalesce(url, F.lit(""))
    n = F.greatest(F.length(text), F.lit(1)).cast("double")
    return {
        "f_length": F.length(text).cast("double"),
        "f_host_length": F.length(host).cast("double"),
        "f_path_length": F.length(path).cast("double"),
        "f_labels": _count(host, r"[^.]+"),
        "f_depth": _count(path, r"/[^/]+"),
        "f_digit_ratio": _count(text, r"[0-9]") / n,
        "f_symbol_ratio": _count(text, r"[^0-9A-Za-z]") / n,
        "f_entropy": _entropy(text),
        "f_host_entropy": _entropy(host),
        "f_params": F.when(text.contains("?"), _count(text, "&") + 1).otherwise(F.lit(0.0)),
        "f_hyphens": _count(host, "-"),
        "f_fragment": text.contains("#").cast("double"),
        "f_secure": text.startswith("https:").cast("double"),
    }


def suffix_bucket(host: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(F.substring_index(host, ".", -1)), F.lit(buckets)).cast("int")


def features(df: DataFrame, url: str, rules, buckets: int) -> DataFrame:
    """``df`` with host, path, rule, rule verdict and the lexical features."""
    out = df.withColumns({"host": host_of(F.col(url)), "path": path_of(F.col(url))})
    host, path = F.col("host"), F.col("path")
    return out.withColumns({
        "rule": matched_rule(rules, host, path, lambda r: F.lit(r.name)),
        "rule_verdict": matched_rule(rules, host, path, lambda r: F.lit(r.verdict)),
        "suffix": suffix_bucket(host, buckets),
        **lexical_features(F.col(url), host, path),
    })


def suffix_statistics(labelled: DataFrame) -> DataFrame:
    """Per suffix bucket the smoothed share of blocked rows and the size; at most ``buckets`` rows."""
    block = (F.col("rule_verdict") == "block").cast("double")
    return labelled.groupBy("suffix").agg(
        ((F.sum(block) + 1.0) / (F.count(F.lit(1)) + 2.0)).alias("f_suffix_share"),
        F.log1p(F.count(F.lit(1)).cast("double")).alias("f_suffix_size"))


def with_suffix(df: DataFrame, stats: DataFrame) -> DataFrame:
    """Attach the suffix statistics; the table has a row a bucket at most, so it may be broadcast."""
    return df.join(F.broadcast(stats), "suffix", "left").na.fill({"f_suffix_share": 0.5, "f_suffix_size": 0.0})


def train(feats: DataFrame, stats: DataFrame, rows: int = TRAIN_ROWS,
          seed: int = 7) -> tuple[GBTClassificationModel | None, VectorAssembler, str]:
    """(trees or None if there is one class only, assembler, verdict without trees)."""
    labelled = feats.where(F.col("rule_verdict").isNotNull())
    names = [c for c in feats.columns if c.startswith("f_")] + ["f_suffix_share", "f_suffix_size"]
    assembler = VectorAssembler(inputCols=names, outputCol="features", handleInvalid="keep")
    counts = {r["rule_verdict"]: r["n"] for r in
              labelled.groupBy("rule_verdict").agg(F.count(F.lit(1)).alias("n")).collect()}
    if len(counts) < 2:
        return None, assembler, next(iter(counts), "allow")
    share = min(1.0, rows / sum(counts.values()))
    picked = labelled.where(F.pmod(F.xxhash64("host", "path", "f_length"), F.lit(1_000_000)) < int(share * 1_000_000))
    sample = stored(with_suffix(picked, stats).select(
        (F.col("rule_verdict") == "block").cast("double").alias("label"), *names), "url-train")
    trees = GBTClassifier(labelCol="label", featuresCol="features", maxIter=12, maxDepth=4, maxBins=32,
                          stepSize=0.3, seed=seed)
    return trees.fit(assembler.transform(sample.coalesce(8))), assembler, "allow"


def judge_urls(pages: DataFrame, rules=RULES, *, id_col: str = "page_id", url_col: str = "url",
               train_rows: int = TRAIN_ROWS, buckets: int = SUFFIX_BUCKETS) -> DataFrame:
    """Per row: id, host, path, rule, verdict (the rule's, else the trees'), block_score (null without trees)."""
    feats = features(pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("_url")), "_url", rules, buckets)
    stats = stored(suffix_statistics(feats.where(F.col("rule_verdict").isNotNull())), "url-suffix")
    model, assembler, fallback = train(feats, stats, train_rows)
    if model is None:
        judged = feats.withColumn("block_score", F.lit(None).cast("double"))
        method = F.lit(fallback)
    else:
        scored = model.transform(assembler.transform(with_suffix(feats, stats)))
        judged = scored.withColumn("block_score", vector_to_array("probability")[1])
        method = F.when(F.col("block_score") >= 0.5, "block").otherwise("allow")
    return judged.select("page_id", "host", "path", "rule",
                         F.coalesce("rule_verdict", method).alias("verdict"), "block_score")
