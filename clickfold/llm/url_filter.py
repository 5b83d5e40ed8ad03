"""URL filter: host and path rules first, then boosted trees on lexical
features (native DataFrame functions and MLlib only).

Features of a URL: lengths of it, its host, path and query, path depth, digit
ratios, character entropy, numbers of parameters, host labels and hyphens,
scheme and ending, and, for the last one to three labels of its host, how
often labelled URLs carry that suffix and how many of them are blocked (for a
labelled URL without its own label).  Gradient-boosted trees are fitted on a
bounded sample of labelled URLs.

Cases: a NULL or empty URL, or one without ``://``, has empty host and path;
no rule fits it and the trees judge it; repeated URLs are judged alike;
without labels of both kinds every URL gets the label seen (``allow`` if
none); an empty table gives an empty result; only ``page_id`` and ``url`` are
read, whatever other columns there are.
"""

from __future__ import annotations

import string
from dataclasses import dataclass

from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickfold.session import write_table

#: Bound of the labelled sample, and so of the suffix table (3 rows each).
MAX_TRAINING_URLS = 20_000
ROUNDS, DEPTH = 20, 4
SUFFIX_LABELS = (1, 2, 3)
PRIOR = 8.0             # weight of the overall rate in a suffix's rate
FOLDS = 5


@dataclass(frozen=True)
class Rule:
    """``block`` or ``allow`` a host with all subdomains below a path."""
    verdict: str
    rule: str

    @property
    def host(self) -> str:
        return self.rule.partition("/")[0]

    @property
    def path(self) -> str:
        return "/" + self.rule.partition("/")[2]


def parts(url: Column) -> dict[str, Column]:
    """Host (A-Z lower-cased), path and query of a URL."""
    after = F.coalesce(F.regexp_extract(url, "(?s)^.*?://(.*)$", 1), F.lit(""))
    host = F.regexp_extract(after, "(?s)^[^/?#]*", 0)
    path = F.regexp_extract(after, "(?s)^[^/?#]*([^?#]*)", 1)
    query = F.regexp_extract(after, "(?s)^[^?#]*\\?([^#]*)", 1)
    return {"host": F.translate(host, string.ascii_uppercase, string.ascii_lowercase),
            "path": path, "query": query}


def rule_of(rules: list[Rule], field: str) -> Column:
    """The longest rule that fits (``field``: rule or verdict), else NULL."""
    found = F.lit(None).cast("string")
    for r in sorted(rules, key=lambda r: (len(r.rule), r.rule)):
        fits = ((F.col("host") == r.host) | F.col("host").endswith("." + r.host)) \
            & F.col("path").startswith(r.path)
        found = F.when(fits, F.lit(getattr(r, field))).otherwise(found)
    return found


def _ratio(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, part / whole).otherwise(F.lit(0.0))


def lexical(df: DataFrame) -> tuple[DataFrame, list[str]]:
    """Add the lexical features of ``_u`` (not NULL), ``host``, ``path`` and
    ``query``; returns their names too."""
    def count(c: str, chars: str) -> Column:
        return F.length(c) - F.length(F.translate(c, chars, ""))

    n = F.length("_u")
    chars = F.array_distinct(F.split("_u", ""))
    counts = F.transform(F.filter(chars, lambda c: c != ""),
                         lambda c: (n - F.length(F.replace(F.col("_u"), c, F.lit("")))) / n)
    entropy = F.aggregate(counts, F.lit(0.0), lambda a, p: a - p * F.log2(p))
    f = {
        "f_length": n, "f_host_length": F.length("host"), "f_path_length": F.length("path"),
        "f_query_length": F.length("query"), "f_depth": count("path", "/"),
        "f_digits": _ratio(count("_u", string.digits), n),
        "f_host_digits": _ratio(count("host", string.digits), F.length("host")),
        "f_path_digits": _ratio(count("path", string.digits), F.length("path")),
        "f_entropy": F.when(n > 0, entropy).otherwise(F.lit(0.0)),
        "f_parameters": F.when(F.length("query") > 0, count("query", "&") + 1).otherwise(F.lit(0)),
        "f_labels": count("host", ".") + 1, "f_hyphens": count("host", "-"),
        "f_other": count("_u", "%@=~_+,;"),
        "f_https": F.col("_u").startswith("https://").cast("int"),
        "f_slash_end": F.col("path").endswith("/").cast("int"),
        "f_dot_end": F.col("path").rlike("\\.[A-Za-z]{2,5}$").cast("int"),
        "f_fragment": F.col("_u").contains("#").cast("int"),
    }
    return df.withColumns({k: v.cast("double") for k, v in f.items()}), list(f)


def _prepared(urls: DataFrame) -> DataFrame:
    df = urls.withColumn("_u", F.coalesce("url", F.lit("")))
    df = df.withColumns(parts(F.col("_u")))
    labels = F.split("host", "\\.")
    return df.withColumns({f"s{k}": F.array_join(F.slice(
        labels, F.greatest(F.lit(1), F.size(labels) - (k - 1)), k), ".") for k in SUFFIX_LABELS})


@dataclass
class UrlModel:
    suffixes: dict[int, DataFrame]
    rate: float
    trees: GBTClassificationModel | None
    always: str | None
    features: list[str]


def _suffix_features(df: DataFrame, suffixes: dict[int, DataFrame], rate: float,
                     fold: Column | None) -> tuple[DataFrame, list[str]]:
    """Counts and blocked rates of the host's suffixes among labelled URLs
    (``fold``: without that fold).  The tables have at most MAX_TRAINING_URLS
    rows, so they are broadcast."""
    names = []
    for k, table in suffixes.items():
        df = df.join(F.broadcast(table), f"s{k}", "left")
        n, bad = F.coalesce(f"n{k}", F.lit(0)), F.coalesce(f"bad{k}", F.lit(0.0))
        if fold is not None:
            n = n - F.coalesce(F.try_element_at(f"folds{k}", fold)["n"], F.lit(0))
            bad = bad - F.coalesce(F.try_element_at(f"folds{k}", fold)["bad"], F.lit(0.0))
        share = F.lit(0.8 if fold is None else 1.0)     # a model sees 4 of 5 folds
        df = df.withColumns({f"f_n{k}": F.log1p(n * share),
                             f"f_rate{k}": (bad + PRIOR * rate) / (n + PRIOR)})
        names += [f"f_n{k}", f"f_rate{k}"]
    return df.drop(*[f"folds{k}" for k in suffixes]), names


def _suffix_table(sample: DataFrame, k: int) -> DataFrame:
    each = sample.groupBy(f"s{k}", "fold").agg(F.count(F.lit(1)).alias("n"),
                                               F.sum("blocked").alias("bad"))
    return each.groupBy(f"s{k}").agg(
        F.sum("n").alias(f"n{k}"), F.sum("bad").alias(f"bad{k}"),
        F.map_from_entries(F.collect_list(F.struct("fold", F.struct("n", "bad"))))
        .alias(f"folds{k}"))


def fit(labelled: DataFrame, seed: int = 7) -> UrlModel:
    """Fit on ``url`` and ``blocked`` (0 or 1; NULL is left out)."""
    usable = labelled.where("blocked IS NOT NULL").select("url", F.col("blocked").cast("double"))
    total = usable.count()
    h = F.pmod(F.xxhash64("url"), F.lit(1 << 30))
    share = min(1.0, 0.95 * MAX_TRAINING_URLS / max(total, 1))
    sample = write_table(_prepared(usable.where(h < int(share * (1 << 30))).withColumn("_h", h)
                                   .orderBy("_h", "url").limit(MAX_TRAINING_URLS)
                                   .withColumn("fold", F.pmod(F.xxhash64("url", F.lit(1)),
                                                              F.lit(FOLDS)).cast("int"))),
                         name="labelled")
    n, bad = sample.agg(F.count("blocked"), F.sum("blocked")).first()
    if not n or bad in (0.0, float(n)):
        return UrlModel({}, 0.0, None, "block" if n and bad else "allow", [])
    rate = bad / n
    suffixes = {k: write_table(_suffix_table(sample, k), name="suffixes") for k in SUFFIX_LABELS}
    train, names = lexical(sample)
    train, more = _suffix_features(train, suffixes, rate, F.col("fold"))
    features = names + more
    # Few, fixed partitions in a fixed order: a fit does not depend on the cluster.
    rows = train.select("_h", "url", "blocked", *features).repartition(4, "_h").sortWithinPartitions(
        "_h", "url")
    vectors = VectorAssembler(inputCols=features, outputCol="features").transform(rows)
    trees = GBTClassifier(featuresCol="features", labelCol="blocked", maxIter=ROUNDS, maxDepth=DEPTH,
                          stepSize=0.2, seed=seed).fit(write_table(
                              vectors.select("features", "blocked"), name="url_vectors"))
    return UrlModel(suffixes, rate, trees, None, features)


def score(urls: DataFrame, model: UrlModel) -> DataFrame:
    """Add ``p_block`` and the trees' ``method_verdict`` to prepared URLs."""
    if model.trees is None:
        p = F.lit(1.0 if model.always == "block" else 0.0)
        return urls.withColumns({"p_block": p, "method_verdict": F.lit(model.always)})
    df, _ = lexical(urls)
    df, _ = _suffix_features(df, model.suffixes, model.rate, None)
    df = VectorAssembler(inputCols=model.features, outputCol="_features").transform(df)
    trees = model.trees.copy().setFeaturesCol("_features").setProbabilityCol("_p") \
        .setRawPredictionCol("_raw").setPredictionCol("_y")
    df = trees.transform(df)
    p = F.get(vector_to_array("_p"), F.lit(1))
    return df.withColumn("p_block", p).withColumn(
        "method_verdict", F.when(F.col("p_block") >= 0.5, "block").otherwise("allow"))


def judge(pages: DataFrame, labelled: DataFrame, rules: list[Rule]) -> DataFrame:
    """``page_id, host, path, rule, verdict, p_block`` of every URL."""
    model = fit(labelled)
    df = score(_prepared(pages.select("page_id", "url")), model)
    rule, verdict = rule_of(rules, "rule"), rule_of(rules, "verdict")
    return df.select("page_id", "host", "path", rule.alias("rule"),
                     F.coalesce(verdict, "method_verdict").alias("verdict"), "p_block")


def page_labels(pages: DataFrame, labels: DataFrame) -> DataFrame:
    """Labelled URLs of these tables: a page shows the document whose number
    is in its path; it is blocked if that document is labelled of low quality
    or toxic."""
    number = F.regexp_extract(parts(F.coalesce("url", F.lit("")))["path"], "/([0-9]{1,18})(?![0-9])", 1)
    marked = labels.groupBy("doc_id").agg(F.max(
        ((F.col("quality") == 0) | F.coalesce(F.col("toxic") == 1, F.lit(False))).cast("int"))
        .alias("blocked"))
    return (pages.select("url", F.when(number != "", number).try_cast("long").alias("_doc"))
            .join(marked, F.col("_doc") == F.col("doc_id")).select("url", "blocked"))
