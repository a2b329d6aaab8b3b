"""Quality classifier: document evidence with hierarchical empirical-Bayes site evidence.

**Document.**  A logistic regression over a dozen measures of the text (length, repeated
words, capitals, symbols, separators) is trained on all labelled rows that are not held
out.

**Sites.**  A host has paths, a path has documents.  Every document adds one unit of
evidence to its path and host: its label if it is a training row, else the classifier's
probability.  With ``mu`` the overall share of good documents, hosts vary around ``mu``
like a Beta distribution of strength ``s``, paths around their host's mean likewise; the
strengths are moment estimates from grouped sums (the spread of the rates beyond what
the group sizes explain).  Posterior means

    host = (good + s * mu) / (n + s),      path = (good + s' * host) / (n + s')

shrink sparse sites towards the host, and hosts towards the global prior.

**Together.**  ``logit(quality) = logit(document) + logit(path) - logit(mu)``, where a
document's own evidence is first taken out of its path and host.

Groups are sums, combined before they are shuffled, so a host with a third of all rows
is one row per task.

Defined cases: a null or empty text has zero measures; a null host or path is a site of
its own; a null or missing label trains nothing; several labels of one id all train;
without both classes among the training rows the document probability is the share of
good ones (1/2 if there is none); repeated rows each count.
"""

from __future__ import annotations

import math
from collections import Counter

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pageloom.llm.text import per_text
from pageloom.plans.staging import stage

MEASURES = (
    "log_words",
    "distinct_words",
    "top_word",
    "same_as_before",
    "capitals",
    "shouted_words",
    "symbols",
    "separators",
    "symbol_runs",
    "digits",
    "word_length",
    "lines_repeated",
)
THRESHOLD = 0.5
#: Bounds of a group level's strength, in documents.
STRENGTH = (1.0, 1e6)

_SYMBOLS = str.maketrans("", "", "!#$%&*+<=>@^_`{}~|\\")
_SEPARATORS = str.maketrans("", "", "|")
_DIGITS = str.maketrans("", "", "0123456789")


def measures(text: str | None) -> list[float]:
    """The measures of one text, in the order of ``MEASURES``."""
    words = (text or "").split()
    if not words:
        return [0.0] * len(MEASURES)
    n, size = len(words), len(text)
    counts = Counter(words)
    letters = "".join(words)
    lines = [x for x in text.split("\n") if x]
    upper = sum(map(str.isupper, letters))
    return [
        math.log1p(n),
        len(counts) / n,
        max(counts.values()) / n,
        sum(a == b for a, b in zip(words, words[1:], strict=False)) / n,
        upper / len(letters),
        sum(w.isupper() and len(w) > 1 for w in words) / n,
        (size - len(text.translate(_SYMBOLS))) / size,
        min(1.0, (size - len(text.translate(_SEPARATORS))) / n),
        sum(w[-1] in "!#$%&*" and w[-2:-1] == w[-1] for w in words) / n,
        (size - len(text.translate(_DIGITS))) / size,
        len(letters) / n,
        1 - len(set(lines)) / max(1, len(lines)),
    ]


def held_out(doc_id: Column | str) -> Column:
    """Rows whose labels are never read: CRC-32 of the id, as text, is 1 modulo 3."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def _logit(p: Column) -> Column:
    q = F.least(F.greatest(p, F.lit(1e-6)), F.lit(1 - 1e-6))
    return F.log(q / (1 - q))


def document_probability(rows: DataFrame) -> DataFrame:
    """``rows`` (``x``: measures, ``y``: label or null) with the classifier's ``p``."""
    seen = {r["y"]: r["n"] for r in rows.where("y IS NOT NULL").groupBy("y").agg(F.count("*").alias("n")).collect()}
    if len(seen) < 2:
        share = (sum(y * n for y, n in seen.items()) / sum(seen.values())) if seen else 0.5
        return rows.withColumn("p", F.lit(float(share)))
    fit = LogisticRegression(featuresCol="v", labelCol="y", maxIter=50, regParam=1e-4).fit(
        rows.where("y IS NOT NULL").select(array_to_vector("x").alias("v"), F.col("y").cast("double").alias("y"))
    )
    z = F.lit(float(fit.intercept))
    for i, w in enumerate(fit.coefficients.toArray()):
        z = z + F.get("x", F.lit(i)) * float(w)
    return rows.withColumn("p", 1 / (1 + F.exp(-F.least(F.greatest(z, F.lit(-30.0)), F.lit(30.0)))))


def strength(groups: DataFrame, good: str, n: str, mean: Column) -> float:
    """Moment estimate of the strength with which groups keep to their prior mean."""
    p, size = mean, F.col(n)
    row = groups.agg(
        F.sum((F.col(good) - size * p) ** 2).alias("ss"),
        F.sum(size * p * (1 - p)).alias("within"),
        F.sum(size * (size - 1) * p * (1 - p)).alias("pairs"),
    ).first()
    if not row["pairs"]:
        return STRENGTH[1]
    # ss = within + rho * pairs in the mean, and the strength is 1 / rho - 1
    rho = max((row["ss"] - row["within"]) / row["pairs"], 0.0)
    s = 1 / rho - 1 if rho > 0 else STRENGTH[1]
    return min(max(s, STRENGTH[0]), STRENGTH[1])


def quality(
    docs: DataFrame,
    labels: DataFrame,
    *,
    key: str = "doc_id",
    text: str = "text",
    host: Column | str = "source",
    path: Column | str = "lang",
    label: str = "quality",
) -> DataFrame:
    """``(id, p_document, p_host, p_path, quality)`` per row of ``docs``."""
    as_column = lambda c: F.col(c) if isinstance(c, str) else c
    known = labels.select(F.col(key).alias("known"), F.col(label).cast("int").alias("y"))
    known = known.where("known IS NOT NULL AND y IN (0, 1)").groupBy("known").agg(F.avg("y").alias("y"))
    own = stage(
        docs.select(
            F.col(key).alias("id"),
            as_column(host).cast("string").alias("host"),
            as_column(path).cast("string").alias("path"),
            per_text(lambda: measures, T.ArrayType(T.DoubleType()))(F.col(text)).alias("x"),
        ),
        "measures",
    )
    train = known.where(~held_out("known"))
    rows = own.join(train, own["id"] == train["known"], "left").drop("known")
    rows = rows.withColumn("y", F.when(F.col("y") >= 0.5, 1).when(F.col("y") < 0.5, 0))
    rows = document_probability(stage(rows, "training"))
    rows = rows.select("id", "host", "path", "p", F.coalesce(F.col("y"), F.col("p")).alias("g"))
    paths = stage(
        rows.groupBy("host", "path").agg(F.sum("g").alias("good"), F.count("*").alias("n")), "paths"
    )
    hosts = stage(
        paths.groupBy("host").agg(F.sum("good").alias("host_good"), F.sum("n").alias("host_n")), "hosts"
    )
    total = hosts.agg(F.sum("host_good"), F.sum("host_n")).first()
    mu = total[0] / total[1] if total[1] else 0.5
    s_host = strength(hosts, "host_good", "host_n", F.lit(float(mu)))
    sites = paths.join(hosts, paths["host"].eqNullSafe(hosts["host"])).drop(hosts["host"])
    mean = (F.col("host_good") + s_host * mu) / (F.col("host_n") + s_host)
    s_path = strength(sites, "good", "n", mean)
    sites = stage(sites.withColumnsRenamed({"host": "h", "path": "q"}), "sites")
    same = F.col("host").eqNullSafe(F.col("h")) & F.col("path").eqNullSafe(F.col("q"))
    g, one = F.col("g"), F.lit(1)
    p_host = (F.col("host_good") - g + s_host * mu) / (F.col("host_n") - one + s_host)
    p_path = (F.col("good") - g + s_path * F.col("p_host")) / (F.col("n") - one + s_path)
    z = _logit(F.col("p")) + _logit(F.col("p_path")) - _logit(F.lit(float(mu)))
    return (
        rows.join(sites, same)
        .withColumn("p_host", p_host)
        .withColumn("p_path", p_path)
        .select("id", F.col("p").alias("p_document"), "p_host", "p_path", (1 / (1 + F.exp(-z))).alias("quality"))
    )


def query(spark, sf_dir: str) -> DataFrame:
    """op1: quality of every document; the source is the host, the language its path."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "source", "lang")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return quality(docs, labels).select(
        F.col("id").alias("doc_id"),
        held_out("id").alias("held_out"),
        "p_document",
        "p_host",
        "p_path",
        "quality",
        (F.col("quality") >= THRESHOLD).alias("keep"),
    )
