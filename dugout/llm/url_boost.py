"""URL filter: rules first, then gradient-boosted trees on lexical features.

Everything is a column expression or Spark's own tree learner. The labelled URLs are those
that a rule settles, each once however many pages have it; of them a sample of at most
``most_labelled``, the smallest by a hash of the whole URL, is stored and trains the trees.
Suffix statistics are block rates of the last one and two labels of the host in that
sample, drawn towards the overall rate; a URL that trains has rates without its own label.
They have at most as many rows as the sample, which bounds what their join broadcasts. The
pages are read three times: for the sample, for what a rule settles, for the rest.

Defined cases: a null url or one without ``://`` has an empty host and path and no rule; a
rule needs its whole path, so one with the path ``/`` does not fit a URL that ends after
the host; the longest rule wins, of equally long ones the first in order of text. If the
sample has one verdict only, that verdict is the method's for every page; if it has none,
the method allows. Ids are passed through, repeated or null. Further columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stored

# The rules in force.
RULES = (("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow"))
FEATURES = ("url_length", "host_length", "path_length", "host_labels", "depth", "digit_ratio", "entropy", "parameters", "hyphens", "last_rate", "last_two_rate")
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Rows that draw a suffix's rate towards the overall one.
PRIOR = 10.0


def parts(url: Column) -> tuple[Column, Column]:
    """Host in lower case and path."""
    text = F.coalesce(url, F.lit(""))
    at = F.instr(text, "://")
    rest = F.when(at > 0, text.substr(at + 3, F.length(text))).otherwise("")
    return F.translate(F.regexp_extract(rest, "^[^/?#]*", 0), UPPER, LOWER), F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)


def longest_rule(host: Column, path: Column, rules: tuple[tuple[str, str], ...]) -> Column:
    """Struct (rule, verdict) of the rule that wins, or null."""
    found = F.lit(None).cast("struct<rule:string,verdict:string>")
    for rule, verdict in sorted(rules, key=lambda r: (-len(r[0]), r[0]), reverse=True):
        rule_host, slash, rule_path = rule.partition("/")
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(slash + rule_path)
        found = F.when(fits, F.struct(F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(found)
    return found


def _count(text: Column, mark: str) -> Column:
    return (F.length(text) - F.length(F.replace(text, F.lit(mark), F.lit("")))).cast("double")


def featured(pages: DataFrame) -> DataFrame:
    """Adds the features that a URL has by itself, and its suffixes."""
    url, size = F.coalesce("url", F.lit("")), F.greatest(F.length(F.coalesce("url", F.lit(""))), F.lit(1)).cast("double")
    share = lambda c: (F.length(url) - F.length(F.replace(url, c, F.lit("")))) / size
    entropy = F.aggregate(F.array_distinct(F.split(url, "")), F.lit(0.0), lambda a, c: F.when(share(c) > 0, a - share(c) * F.log2(share(c))).otherwise(a))
    query = F.regexp_extract(url, r"\?([^#]*)", 1)
    return pages.withColumns(
        {
            "url_length": F.length(url).cast("double"),
            "host_length": F.length("host").cast("double"),
            "path_length": F.length("path").cast("double"),
            "host_labels": _count(F.col("host"), ".") + 1,
            "depth": _count(F.col("path"), "/"),
            "digit_ratio": F.length(F.regexp_replace(url, "[^0-9]", "")) / size,
            "entropy": entropy,
            "parameters": F.when(query == "", 0.0).otherwise(_count(query, "&") + 1),
            "hyphens": _count(F.col("host"), "-"),
            "last": F.substring_index("host", ".", -1),
            "last_two": F.substring_index("host", ".", -2),
        }
    )


def _with_rates(rows: DataFrame, sample: DataFrame, overall: float, own: bool = False) -> DataFrame:
    """Adds the block rates of a URL's suffixes; with ``own``, rows are of the sample and count for nothing in their rates."""
    for key in ("last", "last_two"):
        sums = F.broadcast(sample.groupBy(F.col(key).alias("_key")).agg(F.sum("label").alias("_sum"), F.count(F.lit(1)).alias("_n")))
        label, one = (F.col("label"), 1) if own else (F.lit(0.0), 0)
        blocked, n = F.coalesce(F.col("_sum") - label, F.lit(0.0)), F.coalesce(F.col("_n") - one, F.lit(0))
        rows = rows.join(sums, F.col(key) == F.col("_key"), "left").withColumn(f"{key}_rate", (blocked + PRIOR * overall) / (n + PRIOR)).drop("_key", "_sum", "_n")
    return rows


def _assembled(rows: DataFrame) -> DataFrame:
    from pyspark.ml.feature import VectorAssembler

    return VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(rows)


def trained(sample: DataFrame, overall: float, trees: int = 20, depth: int = 3):
    """Trees from a stored sample of (url, host, path, label)."""
    from pyspark.ml.classification import GBTClassifier

    known = featured(sample)
    train = _assembled(_with_rates(known, known, overall, own=True)).select("features", "label")
    return GBTClassifier(maxIter=trees, maxDepth=depth, seed=7).fit(train)


def scored(rows: DataFrame, model, sample: DataFrame, overall: float) -> DataFrame:
    """Adds the trees' ``verdict`` and ``score`` for block to rows of (url, host, path)."""
    from pyspark.ml.functions import vector_to_array

    judged_rows = model.transform(_assembled(_with_rates(featured(rows), featured(sample), overall)))
    return judged_rows.withColumns({"verdict": F.when(F.col("prediction") == 1, "block").otherwise("allow"), "score": vector_to_array("probability")[1]})


def judged(
    pages: DataFrame,
    rules: tuple[tuple[str, str], ...] = RULES,
    id_col: str = "page_id",
    url_col: str = "url",
    most_labelled: int = 20_000,
    trees: int = 20,
    depth: int = 3,
) -> DataFrame:
    """Per page: page_id, host, path, rule, verdict, and the trees' score for block (null where they were not needed)."""
    host, path = parts(F.col("url"))
    rows = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).cast("string").alias("url")).withColumns({"host": host, "path": path})
    rows = rows.withColumn("won", longest_rule(F.col("host"), F.col("path"), rules))
    settled = rows.where("won is not null")
    labelled = settled.select("url", "host", "path", (F.col("won.verdict") == "block").cast("double").alias("label")).distinct()
    sample = stored(labelled.orderBy(F.xxhash64("url"), "url").limit(most_labelled), "url-sample")
    n, blocked = sample.agg(F.count(F.lit(1)), F.coalesce(F.sum("label"), F.lit(0.0))).first()
    known = settled.select("page_id", "host", "path", "won.rule", "won.verdict", F.lit(None).cast("double").alias("score"))
    open_rows = rows.where("won is null")
    none = F.lit(None).cast("string").alias("rule")
    if blocked in (0, n):
        verdict = "block" if n and blocked == n else "allow"
        score = F.lit(1.0 if verdict == "block" else 0.0)
        return known.unionByName(open_rows.select("page_id", "host", "path", none, F.lit(verdict).alias("verdict"), score.alias("score")))
    overall = blocked / n
    rest = scored(open_rows, trained(sample, overall, trees, depth), sample, overall)
    return known.unionByName(rest.select("page_id", "host", "path", none, "verdict", "score"))
