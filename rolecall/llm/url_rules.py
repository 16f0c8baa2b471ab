"""URL filters: a rule list, and association rules mined from the urls that it labels.

A rule of the list fits its host and all subdomains where the url's path starts with
the rule's. Urls without such a rule are judged by mined rules: FP-growth finds the
token combinations that are frequent among labelled urls, and those that imply a label
with enough confidence become rules. Each rule is posted under its rarest token; a url
meets the rules of its tokens and follows the most confident one that holds.
"""

import math
from dataclasses import dataclass

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.window import Window

from rolecall.sources.sinks import stage


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str = "/"


# The rule list.
RULES = (
    Rule("block", "net", "/"), Rule("allow", "example.net", "/en/"), Rule("block", "example.com", "/de/"), Rule("allow", "org", "/fr/"),
)
VERDICTS = ("allow", "block")
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def host_of(url: Column) -> Column:
    """From the first ``://`` to the next ``/``, ``?``, ``#`` or the end, A-Z in lower case;
    empty for a null and without ``://``."""
    return F.translate(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")), _UPPER, _UPPER.lower())


def path_of(url: Column) -> Column:
    """What follows the host, up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def fitting_rule(host: Column, path: Column, rules=RULES) -> Column:
    """struct<rule, verdict> of the longest rule that fits, null without one; of equally
    long ones that with the longer host, then ``block``."""
    ordered = sorted(rules, key=lambda r: (-len(r.host + r.path), -len(r.host), r.verdict != "block", r.host, r.path))
    fits = [
        F.when(((host == r.host) | host.endswith(f".{r.host}")) & path.startswith(r.path),
               F.struct(F.lit(r.host + r.path).alias("rule"), F.lit(r.verdict).alias("verdict")))
        for r in ordered
    ]
    return F.coalesce(*fits, F.lit(None).cast("struct<rule:string,verdict:string>"))


def url_tokens(url: Column, host: Column, path: Column) -> Column:
    """Distinct tokens of a url: labels of the host, segments of the path, the ending of
    the last one, and names of the query's arguments."""
    named = lambda kind, values: F.transform(F.array_remove(values, ""), lambda x: F.concat(F.lit(f"{kind}:"), x))
    query = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^[^?#]*\?([^#]*)", 1)
    names = F.transform(F.split(query, "&"), lambda x: F.split(x, "=", 2)[0])
    ending = F.regexp_extract(path, r"\.([A-Za-z0-9]+)\z", 1)
    return F.array_distinct(F.concat(
        named("host", F.split(host, r"\.")), named("path", F.split(path, "/")), named("ending", F.array(ending)), named("argument", names)
    ))


def mine_rules(
    labelled: DataFrame, tokens: str = "tokens", label: str = "label", labels=VERDICTS,
    least_support: float = 0.005, least_rows: int = 20, least_confidence: float = 0.8,
) -> DataFrame:
    """(antecedent, label, confidence, support, anchor): token combinations of which at
    least ``least_confidence`` have the label.

    A combination is frequent in the share ``least_support`` of the distinct labelled
    token sets and in ``least_rows`` of them at least, so rules do not grow with the
    rows. Of tokens that always come together only the first by name is mined, else one
    long shared path would have a combination for each of its subsets. A rule is
    dropped where one with fewer tokens has the same label and at least its confidence. Rows
    with a null or other label and copies of one token set (with its label) add nothing.
    ``anchor`` is the rule's rarest token; support is a share.
    """
    spark = labelled.sparkSession
    none = spark.createDataFrame([], "antecedent array<string>, label string, confidence double, support double, anchor string")
    rows = labelled.where(F.col(label).isin(*labels)).select(F.array_sort(F.array_distinct(tokens)).alias("tokens"), F.col(label).alias("label"))
    rows = stage(rows.where("tokens is not null").distinct(), "labelled-urls")
    total = rows.count()
    if not total:
        return none
    least = math.ceil(max(least_rows, least_support * total))
    # tokens with the same rows: equal numbers and equal sums of row hashes
    row = F.xxhash64("tokens", "label").cast("decimal(38,0)")
    counted = rows.select(F.explode("tokens").alias("token"), row.alias("row")).groupBy("token").agg(
        F.count(F.lit(1)).alias("n"), F.sum("row").alias("rows")
    )
    together = counted.where(F.col("n") >= least).groupBy("n", "rows").agg(F.min("token").alias("token"))
    number = {r["token"]: r["n"] for r in together.collect()}  # frequent tokens: a token set holds few, so 1 / least_support times that
    if not number:
        return none
    frequent = F.array(*[F.lit(t) for t in sorted(number)])
    baskets = rows.select(F.concat(F.array_intersect("tokens", frequent), F.array(F.concat(F.lit("label:"), F.col("label")))).alias("items"))
    mined = FPGrowth(itemsCol="items", minSupport=min(1.0, (least - 0.5) / total), minConfidence=least_confidence).fit(baskets)
    named = [f"label:{x}" for x in labels]
    found = mined.associationRules.where(F.col("consequent")[0].isin(*named) & ~F.arrays_overlap("antecedent", F.array(*[F.lit(x) for x in named])))
    count = F.create_map(*[x for t in sorted(number) for x in (F.lit(t), F.lit(number[t]))])
    rarest = F.array_min(F.transform("antecedent", lambda t: F.struct(F.element_at(count, t).alias("n"), t.alias("t"))))["t"]
    rules = stage(found.select(
        F.array_sort("antecedent").alias("antecedent"), F.substring_index(F.col("consequent")[0], "label:", -1).alias("label"),
        "confidence", "support", rarest.alias("anchor"),
    ), "mined-rules")
    wider = rules.select(F.col("antecedent").alias("_fewer"), F.col("label").alias("_label"), F.col("confidence").alias("_confidence"), F.col("anchor").alias("_token"))
    met = rules.select("antecedent", "label", "confidence", F.explode("antecedent").alias("_token")).join(wider, "_token").where(
        (F.col("label") == F.col("_label")) & (F.size("_fewer") < F.size("antecedent")) & (F.col("_confidence") >= F.col("confidence"))
        & (F.size(F.array_except("_fewer", "antecedent")) == 0)
    )
    return stage(rules.join(met.select("antecedent", "label").distinct(), ["antecedent", "label"], "left_anti"), "url-rules").select(*none.columns)


def follow_rules(token_sets: DataFrame, rules: DataFrame, tokens: str = "tokens") -> DataFrame:
    """(tokens, mined, mined_verdict) of the token sets that some rule holds for: the most
    confident rule, then that of the greatest support, the most tokens, the first by
    name. ``token_sets`` are distinct; ``mined`` joins the rule's tokens by spaces."""
    met = token_sets.select(tokens, F.explode(tokens).alias("anchor")).join(rules, "anchor").where(
        F.size(F.array_except("antecedent", tokens)) == 0
    )
    best = F.min(F.struct(
        (-F.col("confidence")).alias("c"), (-F.col("support")).alias("s"), (-F.size("antecedent")).alias("n"), "antecedent", "label"
    ))
    return met.groupBy(tokens).agg(best.alias("b")).select(tokens, F.array_join("b.antecedent", " ").alias("mined"), F.col("b.label").alias("mined_verdict"))


def judge_urls(
    df: DataFrame, url: str = "url", id_column: str = "page_id", rules=RULES, otherwise: str = "allow",
    least_support: float = 0.005, least_rows: int = 20, least_confidence: float = 0.8,
) -> DataFrame:
    """(id, host, path, rule, verdict, mined) of every row of ``df``.

    ``verdict`` is that of the longest fitting rule of the list, else of the mined rule
    that the url follows, else ``otherwise``. The labels that rules are mined from are
    the list's own verdicts on the urls that it covers. A null url and one without
    ``://`` have an empty host and path and no tokens. Repeated rows and ids are judged
    each; other columns are left out; an empty table gives an empty result.

    Urls are reduced to the tokens of the mined rules, and each distinct set is judged
    once, so neither a hot host nor a common url is gathered.
    """
    parted = df.select(F.col(id_column).alias("id"), F.col(url).alias("url"), host_of(F.col(url)).alias("host"), path_of(F.col(url)).alias("path"))
    ruled = parted.withColumn("fit", fitting_rule(F.col("host"), F.col("path"), rules))
    rows = stage(ruled.select(
        "id", "host", "path", "fit.rule", F.col("fit.verdict").alias("given"),
        F.when(F.col("host") == "", F.array().cast("array<string>")).otherwise(url_tokens(F.col("url"), F.col("host"), F.col("path"))).alias("tokens"),
    ), "urls")
    mined = mine_rules(rows.withColumnRenamed("given", "label"), "tokens", "label", VERDICTS, least_support, least_rows, least_confidence)
    # bounded by the support: see mine_rules
    known = sorted(r["token"] for r in mined.select(F.explode("antecedent").alias("token")).distinct().collect())
    reduced = F.array_sort(F.array_intersect("tokens", F.array(*[F.lit(t) for t in known]).cast("array<string>")))
    rows = rows.withColumn("tokens", F.when(F.col("given").isNull(), reduced))
    # stored, so that the join may split a token set that very many rows share
    followed = stage(follow_rules(rows.select("tokens").where("tokens is not null").distinct(), mined), "followed-rules")
    joined = rows.join(followed, "tokens", "left")
    return joined.select(
        F.col("id").alias(id_column), "host", "path", "rule", F.coalesce("given", "mined_verdict", F.lit(otherwise)).alias("verdict"), "mined"
    )
