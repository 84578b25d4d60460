"""Soft-membership mixing: documents get rates so that expected domain tokens match targets.

1. A naive Bayes classifier over hashed words, fitted on a labelled table, gives
   every document posteriors over the domains (rounded to 1/GRID, the precision
   the rates are fitted at).
2. Nonnegative rates r minimise ``sum_k (sum_d r_d t_d p_dk - T_k)^2 / (2 S_k) +
   keep / 2 * sum_d t_d (r_d - 1)^2`` by projected gradient, t being a
   document's tokens, T the targets and S the tokens at rate 1 (with these
   weights a step of 1 is safe, and enough where domains hardly overlap).  The gradient of a document depends on
   its posteriors only, so tokens are summed by posterior first and a step is an
   aggregate over these cells; only one number a domain reaches the driver.
3. A rate becomes whole copies: its floor, and one more with the odds of the rest
   (decided by a hash of the doc_id).

DataFrame and SQL functions only.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .sampling import first_by_hash
from .workspace import Workspace, plain_names

BUCKETS, GRID, DOMAINS_MOST = 512, 64, 64
#: The classifier is fitted on at most so many labelled rows (the first by a hash of their id).
TRAINING_ROWS = 20_000
#: Words of evidence that count at most: a longer text is as sure as one of so many words.
EVIDENCE = 30.0
STEPS, KEEP, CLOSE = 60, 1e-3, 1e-4


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(F.lower(F.coalesce(text.cast("string"), F.lit(""))), r"\s+"), "")


def _buckets(words: Column) -> Column:
    return F.transform(words, lambda w: F.pmod(F.xxhash64(w), F.lit(BUCKETS)).cast("int"))


def _array(values: list[float]) -> Column:
    return F.split(F.lit(",".join(repr(float(v)) for v in values)), ",").cast("array<double>")


@dataclass(frozen=True)
class Classifier:
    domains: list[str]
    priors: list[float]
    #: log probability of each bucket, by domain
    weights: list[list[float]]


def train(docs: DataFrame, labelled: DataFrame, rows: int = TRAINING_ROWS) -> Classifier:
    """``labelled`` has doc_id, domain; null domains are ignored, of several domains the first in order counts."""
    from math import log

    own = labelled.filter(F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.min(F.col("domain").cast("string")).alias("domain")).filter("domain is not null")
    chosen = first_by_hash(own, "doc_id", rows)  # at most ``rows`` ids are broadcast
    texts = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    hashed = texts.select("domain", F.explode_outer(_buckets(words_of(F.col("text")))).alias("bucket"))
    counts = hashed.groupBy("domain", "bucket").agg(F.count(F.lit(1)).alias("n")).collect()  # domains x (buckets + 1) rows
    domains = sorted({r["domain"] for r in counts})
    if len(domains) > DOMAINS_MOST:
        raise ValueError(f"{len(domains)} domains; at most {DOMAINS_MOST}")
    table = {d: [0.5] * BUCKETS for d in domains}
    for r in counts:
        if r["bucket"] is not None:
            table[r["domain"]][r["bucket"]] += r["n"]
    sums = {d: sum(table[d]) for d in domains}
    whole = sum(sums.values())
    return Classifier(domains, [log(sums[d] / whole) for d in domains], [[log(x / sums[d]) for x in table[d]] for d in domains])


def _evidence(buckets: Column, weights: Column) -> Column:
    return F.aggregate(buckets, F.lit(0.0), lambda acc, b: acc + F.get(weights, b))


def posteriors(docs: DataFrame, model: Classifier) -> DataFrame:
    """``docs`` with __tokens and __p, an array with the posterior of each domain in steps of 1/GRID."""
    worded = docs.withColumn("__words", words_of(F.col("text")))
    hashed = worded.select(*docs.columns, F.size("__words").cast("long").alias("__tokens"), _buckets(F.col("__words")).alias("__buckets"))
    sums = [_evidence(F.col("__buckets"), _array(w)) for w in model.weights]
    n = F.greatest(F.col("__tokens"), F.lit(1)).cast("double")
    scored = hashed.select(*docs.columns, "__tokens", F.array(*[s / n * F.least(n, F.lit(EVIDENCE)) + F.lit(p) for s, p in zip(sums, model.priors, strict=True)]).alias("__s"))
    topped = scored.withColumn("__e", F.transform("__s", lambda s: F.exp(s - F.array_max("__s"))))
    total = F.aggregate("__e", F.lit(0.0), lambda acc, e: acc + e)
    p = F.transform("__e", lambda e: F.round(e / total * GRID) / GRID)
    return topped.select(*docs.columns, "__tokens", p.alias("__p"))


def _rate(p: Column, steps: list[list[float]], eta: float, keep: float) -> Column:
    """The rate after the steps, from the residuals that each of them saw."""
    if not steps:
        return F.lit(1.0)
    k = len(steps[0])
    flat = _array([x for step in steps for x in step])
    starts = F.sequence(F.lit(0), F.lit((len(steps) - 1) * k), F.lit(k))

    # the state carries p, so that its expression is evaluated once a row and not once a step
    def one(state: Column, at: Column) -> Column:
        own, r = state["p"], state["r"]
        slope = sum((F.get(own, F.lit(i)) * F.get(flat, at + i) for i in range(1, k)), F.get(own, F.lit(0)) * F.get(flat, at))
        return F.struct(F.greatest(F.lit(0.0), r - F.lit(eta) * (slope + F.lit(keep) * (r - 1))).alias("r"), own.alias("p"))

    return F.aggregate(starts, F.struct(F.lit(1.0).alias("r"), p.alias("p")), one, lambda state: state["r"])


def fit_rates(scored: DataFrame, k: int, shares: list[float], ws: Workspace, steps: int = STEPS, keep: float = KEEP) -> tuple[list[list[float]], float]:
    """The residuals of each gradient step, and the step size."""
    cells = ws.table(scored.groupBy("__p").agg(F.sum("__tokens").alias("t")))
    totals = lambda rate: [float(x or 0) for x in cells.agg(*[F.sum(F.col("t") * rate * F.get(F.col("__p"), F.lit(i))) for i in range(k)]).first()]
    now = totals(F.lit(1.0))
    target = [sum(now) * s for s in shares]
    if not sum(target):
        return [], 0.0
    size = [max(n, 1.0) for n in now]
    eta = 1.0 / (1.0 + keep)
    seen: list[list[float]] = []
    for _ in range(steps):
        off = [(n - t) / z for n, t, z in zip(now, target, size, strict=True)]
        if seen and max(abs(a - b) for a, b in zip(off, seen[-1], strict=True)) < CLOSE:
            break
        seen.append(off)
        now = totals(_rate(F.col("__p"), seen, eta, keep))
    return seen, eta


def rates(docs: DataFrame, labelled: DataFrame, weights: Mapping[str, float]) -> tuple[DataFrame, list[str]]:
    """doc_id, __tokens, __p, __rate, __copies for each document, and the domains in the order of __p.

    ``weights`` (domain -> weight) are the shares of tokens wanted; a domain
    that no labelled row has, or with no weight, is left at 0, and the rest is
    scaled to the tokens there are.  Null and empty texts have no tokens and
    the prior's posteriors.  Without labelled rows, or without any tokens,
    every rate is 1.  Repeated rows get equal rates and copies; an empty table
    gives an empty result.
    """
    ws, docs = Workspace(docs.sparkSession, "mixing"), plain_names(docs)
    model = train(docs, labelled)
    if not model.domains:
        return docs.select("doc_id", F.size(words_of(F.col("text"))).cast("long").alias("__tokens")).withColumns({"__p": F.array().cast("array<double>"), "__rate": F.lit(1.0), "__copies": F.lit(1)}), []
    known = ws.table(posteriors(docs.select("doc_id", "text"), model).drop("text"))
    wanted = [max(float(weights.get(d, 0.0)), 0.0) for d in model.domains]
    shares = [w / sum(wanted) for w in wanted] if sum(wanted) else [0.0] * len(wanted)
    seen, eta = fit_rates(known, len(model.domains), shares, ws)
    rate = F.round(_rate(F.col("__p"), seen, eta, KEEP), 6)
    return known.withColumn("__rate", rate).withColumn("__copies", copies_of(F.col("doc_id"), F.col("__rate"))), model.domains


def report(docs: DataFrame, labelled: DataFrame, weights: Mapping[str, float]) -> DataFrame:
    """doc_id, n_tokens, domain (likeliest), p_<domain> for each domain, rate, copies."""
    out, domains = rates(docs, labelled, weights)
    p = F.col("__p")
    best = F.lit(None).cast("string")
    for i, d in reversed(list(enumerate(domains))):
        best = F.when(F.get(p, F.lit(i)) == F.array_max(p), F.lit(d)).otherwise(best)
    posts = [F.get(p, F.lit(i)).alias(f"p_{d}") for i, d in enumerate(domains)]
    return out.select("doc_id", F.col("__tokens").alias("n_tokens"), best.alias("domain"), *posts, F.col("__rate").alias("rate"), F.col("__copies").alias("copies"))


def mix(docs: DataFrame, labelled: DataFrame, weights: Mapping[str, float]) -> DataFrame:
    """The columns of ``docs``, each row as often as its copies say (rates are functions of a row, so nothing is joined).

    Nulls, empty tables and missing labels are treated as in ``rates``; repeated
    rows are copied alike; all columns are kept, whatever their names.
    """
    spark, names, docs = docs.sparkSession, docs.columns, plain_names(docs)
    model = train(docs, labelled)
    if not model.domains:
        return docs.toDF(*names)
    ws = Workspace(spark, "mixing")
    wanted = [max(float(weights.get(d, 0.0)), 0.0) for d in model.domains]
    shares = [w / sum(wanted) for w in wanted] if sum(wanted) else [0.0] * len(wanted)
    scored = posteriors(docs, model)
    seen, eta = fit_rates(scored.select("__tokens", "__p"), len(model.domains), shares, ws)
    return _copied(scored, docs.columns, seen, eta).toDF(*names)


def _copied(scored: DataFrame, columns: list[str], seen: list[list[float]], eta: float) -> DataFrame:
    rate = F.round(_rate(F.col("__p"), seen, eta, KEEP), 6)
    copy = F.transform(F.array(rate), lambda r: F.array_repeat(F.lit(0), copies_of(F.col("doc_id"), r)))  # the rate is evaluated once
    return scored.select(*columns, F.explode(F.flatten(copy)).alias("__copy")).select(*columns)


def copies_of(doc_id: Column, rate: Column) -> Column:
    odds = F.pmod(F.xxhash64(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit("copies")), F.lit(1 << 20)) / F.lit(float(1 << 20))
    return (F.floor(rate) + F.when(odds < rate - F.floor(rate), 1).otherwise(0)).cast("int")
