"""URL filter: rules first, then gradient-boosted trees on lexical features.

DataFrame functions and MLlib's DataFrame estimators only.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, functions as F

from voltmesh.operators.skew import join_apart

from .common import ascii_lower, digits, settle

#: Different labelled URLs the trees are fitted on, at most so many, chosen by hash.
TRAIN_ROWS = 20_000
#: Host suffixes whose table (about 60 bytes each) may be broadcast; beyond, a join.
BROADCAST_SUFFIXES = 20_000
TREES, DEPTH = 12, 4

FEATURES = (
    "length host_length path_length depth labels digit_ratio host_digit_ratio hyphens entropy "
    "parameters query_length escapes longest_label has_fragment secure numeric_host suffix_urls "
    "suffix_share suffix_block"
).split()


@dataclass(frozen=True)
class Rule:
    """A verdict for a host, its subdomains, and paths that start with `path`."""

    host: str
    path: str
    verdict: str

    @property
    def text(self) -> str:
        return f"{self.host}{self.path}"


RULES = (
    Rule("net", "/", "block"),
    Rule("example.net", "/en/", "allow"),
    Rule("example.com", "/de/", "block"),
    Rule("org", "/fr/", "allow"),
)


def host_of(url: Column) -> Column:
    """After the first '://' up to '/', '?' or '#', A-Z lower-cased; else empty."""
    return ascii_lower(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_column(rules: Sequence[Rule], host: Column, path: Column, field: str) -> Column:
    """`field` of the longest rule that fits, null if none does; of two as long, the first."""
    out = F.lit(None).cast("string")
    for rule in sorted(reversed(rules), key=lambda r: len(r.text)):
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        out = F.when(fits, F.lit(getattr(rule, field))).otherwise(out)
    return out


def _share(text: Column, pattern: str) -> Column:
    """Share of the characters that match."""
    left = F.length(F.regexp_replace(text, pattern, ""))
    return (F.length(text) - left) / F.greatest(F.length(text), F.lit(1))


def entropy(text: Column) -> Column:
    """Bits per character."""
    size = F.length(text)

    def bits(char: Column) -> Column:
        p = (size - F.length(F.replace(text, char, F.lit("")))) / size
        return -p * F.log2(p)

    chars = F.filter(F.array_distinct(F.split(text, "")), lambda c: c != "")
    return F.coalesce(F.aggregate(F.transform(chars, bits), F.lit(0.0), lambda a, b: a + b), F.lit(0.0))


def suffix_of(host: Column) -> Column:
    """The last two labels of a host."""
    return F.substring_index(host, ".", -2)


def lexical(urls: DataFrame, url: str) -> DataFrame:
    """Add host, path, suffix and all features but the suffix statistics."""
    text = F.coalesce(F.col(url), F.lit(""))
    host, path, query = F.col("host"), F.col("path"), F.regexp_extract(text, r"(?s)\?([^#]*)", 1)
    labels = F.split(host, r"\.")
    values = {
        "length": F.length(text),
        "host_length": F.length(host),
        "path_length": F.length(path),
        "depth": F.size(F.filter(F.split(path, "/"), lambda p: p != "")),
        "labels": F.size(labels),
        "digit_ratio": _share(text, "[0-9]"),
        "host_digit_ratio": _share(host, "[0-9]"),
        "hyphens": F.length(host) - F.length(F.replace(host, F.lit("-"), F.lit(""))),
        "entropy": entropy(text),
        "parameters": F.size(F.filter(F.split(query, "&"), lambda p: p != "")),
        "query_length": F.length(query),
        "escapes": F.length(text) - F.length(F.replace(text, F.lit("%"), F.lit(""))),
        "longest_label": F.array_max(F.transform(labels, lambda p: F.length(p))),
        "has_fragment": text.contains("#").cast("int"),
        "secure": ascii_lower(text).startswith("https://").cast("int"),
        "numeric_host": host.rlike(r"^[0-9.:]+$").cast("int"),
    }
    placed = urls.withColumns({"host": host_of(F.col(url)), "path": path_of(F.col(url))})
    out = placed.withColumns({k: v.cast("double") for k, v in values.items()})
    return out.withColumn("suffix", suffix_of(host))


def suffix_table(rows: DataFrame) -> DataFrame:
    """Per suffix over all rows: number of URLs, share of labelled ones, smoothed block rate."""
    known = F.count("label").cast("double")
    blocked = F.sum(F.coalesce("label", F.lit(0.0)))
    return rows.groupBy("suffix").agg(
        F.log1p(F.count("*").cast("double")).alias("suffix_urls"),
        (known / F.count("*")).alias("suffix_share"),
        known.alias("_known"),
        blocked.alias("_blocked"),
        ((blocked + 1.0) / (known + 2.0)).alias("suffix_block"),
    )


def _without_itself(df: DataFrame) -> DataFrame:
    """A labelled URL's suffix has the block rate of the other rows with a label, so that its own
    label is not among what explains it. `_copies` is how many rows the URL and label have."""
    rest = (F.col("_blocked") - F.col("label") * F.col("_copies") + 1.0) / (F.col("_known") - F.col("_copies") + 2.0)
    return df.withColumn("suffix_block", rest)


def judge(
    urls: DataFrame,
    rules: Sequence[Rule] = RULES,
    labelled: DataFrame | None = None,
    url: str = "url",
    train_rows: int = TRAIN_ROWS,
) -> DataFrame:
    """Columns of the input, then host, path, rule, verdict and block_score.

    `labelled` has url and label (1: block); None takes the URLs that a rule decides, with
    the rule's verdict, as the labelled ones. Suffix statistics are over all URLs, those of the
    labels over all labelled ones; the trees are fitted on `train_rows` different labelled URLs, those
    with the least hashes, all of them if there are fewer. With labels of one kind only among them,
    that verdict holds where no rule fits; with none, it is allow.
    Null and empty URLs have empty host and path and are judged like others. Input
    columns with the names of results are replaced. Repeated URLs get equal verdicts.
    """
    results = ["host", "path", "rule", "verdict", "block_score"]
    keep = [c for c in urls.columns if c not in results]
    packed = urls.select(F.struct(*keep).alias("row"), F.col(url).alias("url"))

    def ruled(df: DataFrame) -> DataFrame:
        host, path = F.col("host"), F.col("path")
        return df.withColumns(
            {"rule": rule_column(rules, host, path, "text"), "ruled": rule_column(rules, host, path, "verdict")}
        )

    rows = ruled(lexical(packed, "url"))
    if labelled is None:
        short = urls.select(F.col(url).alias("url"))
        placed = ruled(short.withColumns({"host": host_of(F.col("url")), "path": path_of(F.col("url"))}))
        known = placed.withColumn("label", (F.col("ruled") == "block").cast("double"))
        known = known.select("url", "label", suffix_of(F.col("host")).alias("suffix"))
        every = known
    else:
        own = labelled.select("url", F.col("label").cast("double").alias("label"))
        known = own.withColumn("suffix", suffix_of(host_of(F.col("url"))))
        none = F.lit(None).cast("double").alias("label")
        every = rows.select("suffix", none).unionAll(known.select("suffix", "label"))
    # The statistics of all suffixes and the sample are written once; the trees go by the sample alone.
    table = settle(suffix_table(every), "suffixes")
    few = table.limit(BROADCAST_SUFFIXES + 1).count() <= BROADCAST_SUFFIXES
    statistics = table.drop("_known", "_blocked")

    def with_suffix(df: DataFrame, found: DataFrame) -> DataFrame:
        return df.join(F.broadcast(found), "suffix") if few else join_apart(df, found, ["suffix"])

    different = known.filter("label is not null").groupBy("url", "label").agg(F.count("*").cast("double").alias("_copies"))
    mark = digits(F.lit("train"), F.coalesce("url", F.lit("")))
    # A few more than asked for are sorted, not all.
    near = mark < int(min(1.0, (1.1 * train_rows + 100) / max(1, different.count())) * (1 << 52))
    first = different.filter(near).orderBy(mark, "url", "label").limit(train_rows)
    sample = settle(_without_itself(with_suffix(lexical(first, "url"), table)).select("label", *FEATURES), "sample")
    total, lowest, highest = sample.agg(F.count("*"), F.min("label"), F.max("label")).first()
    rows = with_suffix(rows, statistics)
    if not total or lowest == highest:
        scored = rows.withColumn("block_score", F.lit(highest or 0.0).cast("double"))
    else:
        assembler = VectorAssembler(inputCols=FEATURES, outputCol="features")
        fitted = GBTClassifier(
            labelCol="label", maxIter=TREES, maxDepth=DEPTH, seed=7, cacheNodeIds=False
        ).fit(assembler.transform(sample).select("label", "features"))
        scored = fitted.transform(assembler.transform(rows)).withColumn(
            "block_score", vector_to_array("probability")[1]
        )
    verdict = F.coalesce("ruled", F.when(F.col("block_score") > 0.5, "block").otherwise("allow"))
    return scored.select("row.*", "host", "path", "rule", verdict.alias("verdict"), "block_score")
