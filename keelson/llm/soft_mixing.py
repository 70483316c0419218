"""Mixing sources to target weights by soft membership (operator 9), native Spark only.

1. Every document gets a few counts of its text as features, made of built-in
   functions. A Gaussian classifier is fitted on all labelled documents (the
   class means, spreads and shares are plain aggregates over the label table
   joined with the features) and gives each document posteriors over domains.
2. Nonnegative document rates ``r`` are fitted by projected-gradient least
   squares: the expected tokens of domain k are the sum of rate x tokens x
   posterior, and their relative distance to the targets is minimised. All
   documents take part in every step; only the domains' totals, a handful of
   numbers, reach the driver. A rate starts at 1 and depends on the document's
   own posteriors and on the steps' residuals alone, so a step replays the
   residuals on the small feature table instead of storing rates.
3. A rate becomes whole copies: its floor, and one more where a seeded hash of
   the document falls below the fraction.

Defined cases: a null or empty text has no tokens, flat features and a rate
like any other; a document labelled twice counts once for each label row; an
empty label table or a domain without labels gets no posterior, and its target
is shared among the others; a labelled domain without a target is an error, and
0 must be asked for; a gap that the steps leave open is warned of; without documents the result is empty; a null id
can't meet a label but is mixed; all columns come back in struct ``doc``.
"""

from __future__ import annotations

import math
import warnings
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from keelson.session import scratch_dir

#: Domain of a labelled document, and the share of all tokens that each is to have.
DOMAIN = "case when quality = 0 then 'junk' else lang end"
TARGETS = {"en": 0.55, "fr": 0.17, "de": 0.16, "es": 0.10, "junk": 0.02}
STEPS = 20
CLOSE = 1e-4
SEED = 977
#: Letters and signs that are counted; their densities tell languages and junk apart.
COUNTED = ("é", "è", "ö", "ü", "ß", "ó", "ñ", "|", "%", "$", "!")
#: Columns of the documents, beside the features, that a domain expression may name.
KNOWN = ("lang", "source")
FEATURES = ("long", "word", "wide", *(f"sign{i}" for i in range(len(COUNTED))))
#: Totals are summed as whole numbers, so the order of summing can't change them.
_UNIT = 1_000
#: Added to each variance, as a feature may be constant within a domain.
VARIANCE = 1e-4


def features(text_col: str = "text") -> list[Column]:
    """Token count and the features of a text, by built-in functions."""
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    size = F.octet_length(text)
    tokens = F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("long")
    density = lambda n: F.sqrt(n / (size + 1.0))
    values = [F.log(size + 1.0), F.log((size + 1.0) / (tokens + 1.0)), density(size - F.length(text)),
              *(density((size - F.octet_length(F.replace(text, F.lit(c)))) / len(c.encode())) for c in COUNTED)]
    return [tokens.alias("tokens"), *(F.round(v, 6).alias(k) for k, v in zip(FEATURES, values))]


def fit_domains(table: DataFrame, labels: DataFrame, id_col: str, domain: str) -> dict[str, dict]:
    """Share, means and variances of every labelled domain (one row each).

    ``domain`` is an expression over the labels' columns and those of ``table``."""
    known = labels.withColumnRenamed(id_col, "id").where("id is not null")
    known = known.select("id", *(c for c in known.columns if c != "id" and c not in table.columns))
    stats = [f(k).alias(f"{n}_{k}") for k in FEATURES for n, f in (("mean", F.avg), ("var", F.var_pop))]
    rows = (known.join(table, "id").withColumn("domain", F.expr(domain)).where("domain is not null").groupBy("domain").agg(F.count(F.lit(1)).alias("n"), *stats)
            .orderBy("domain").collect())
    total = sum(r["n"] for r in rows)
    # rounded: the last digits of a mean depend on the order of summing
    return {r["domain"]: {"share": r["n"] / total,
                          "mean": {k: round(r[f"mean_{k}"], 9) for k in FEATURES},
                          "var": {k: round(r[f"var_{k}"], 9) + VARIANCE for k in FEATURES}} for r in rows}


def posteriors(table: DataFrame, model: dict[str, dict], keep: list[str]) -> DataFrame:
    """``keep`` and P(domain | features) as ``p0``, ``p1``, ... in the model's
    order. One projection a step: written as one expression, the log densities
    would be repeated within each other many times over."""
    n = len(model)
    logs = []
    for i, m in enumerate(model.values()):
        terms = [(F.col(k) - m["mean"][k]) * (F.col(k) - m["mean"][k]) * (-0.5 / m["var"][k]) for k in FEATURES]
        start = math.log(m["share"]) - 0.5 * sum(math.log(m["var"][k]) for k in FEATURES)
        logs.append(reduce(lambda a, b: a + b, terms, F.lit(start)).alias(f"log{i}"))
    top = F.greatest(*(F.col(f"log{i}") for i in range(n))) if n > 1 else F.col("log0")
    scaled = (table.select(*keep, *logs).select("*", top.alias("top"))
              .select(*keep, *(F.exp(F.col(f"log{i}") - F.col("top")).alias(f"e{i}") for i in range(n))))
    total = reduce(lambda a, b: a + b, (F.col(f"e{i}") for i in range(n)))
    return scaled.select("*", total.alias("total")).select(
        *keep, *(F.round(F.col(f"e{i}") / F.col("total"), 6).alias(f"p{i}") for i in range(n)))


def rate_after(residuals: list[list[float]], p: list[Column]) -> Column:
    """A document's rate after the steps so far: from 1, each step moves it
    against the gradient and projects it to zero or more."""
    rate = F.lit(1.0)
    if not residuals:
        return rate
    steps = F.array(*(F.array(*map(F.lit, r)) for r in residuals))
    return F.aggregate(steps, rate, lambda r, e: F.greatest(
        F.lit(0.0), r - reduce(lambda a, b: a + b, (x * e[i] for i, x in enumerate(p)))))


def fit_rates(table: DataFrame, targets: list[float], steps: int = STEPS, close: float = CLOSE) -> list[list[float]]:
    """Residuals of the projected-gradient steps.

    ``table`` has ``tokens`` and ``p0``, ``p1``, ... The gradient is scaled by
    each domain's tokens, so a rare domain closes its relative gap as fast."""
    p = [F.col(f"p{i}") for i in range(len(targets))]
    whole = lambda c: F.coalesce(F.sum(F.round(c * _UNIT).cast("long")), F.lit(0))
    start = table.agg(*(whole(F.col("tokens") * x).alias(f"t{i}") for i, x in enumerate(p))).first()
    total = sum(start)
    if not total:
        return []
    residuals: list[list[float]] = []
    for step in range(steps + 1):
        rate = rate_after(residuals, p)
        now = table.select("tokens", *p, rate.alias("rate")).agg(
            *(whole(F.col("rate") * F.col("tokens") * x).alias(f"t{i}") for i, x in enumerate(p))).first()
        gap = [now[i] / total - t for i, t in enumerate(targets)]
        if max(map(abs, gap)) < close:
            break
        if step == steps:
            warnings.warn(f"domains are up to {max(map(abs, gap)):.4f} of all tokens from their targets after {steps} steps", stacklevel=2)
            break
        residuals.append([g * total / s if s else 0.0 for g, s in zip(gap, start)])
    return residuals


def mix(docs: DataFrame, labels: DataFrame, targets: dict[str, float] | None = None, domain: str = DOMAIN,
        id_col: str = "doc_id", text_col: str = "text", steps: int = STEPS, seed: int = SEED) -> DataFrame:
    """Every row of ``docs`` as struct ``doc`` with ``tokens``, ``posterior``
    (map of domain to probability), ``rate`` and whole ``copies``."""
    spark = docs.sparkSession
    targets = TARGETS if targets is None else targets
    known = [F.col(f"`{c}`") for c in docs.columns if c in KNOWN]
    docs.select(F.col(f"`{id_col}`").alias("id"), *known, *features(text_col)).write.parquet(
        path := scratch_dir(spark, "features"))
    table = spark.read.parquet(path)
    model = fit_domains(table, labels, id_col, domain)
    if not model:
        return _copies(docs.select(_whole(docs), features(text_col)[0], F.lit(1.0).alias("rate"),
                                   F.lit(None).cast("map<string,double>").alias("posterior")), id_col, text_col, seed)
    if missing := sorted(model.keys() - targets.keys()):
        raise ValueError(f"labelled domains without a target: {missing}")
    wanted = [targets[k] for k in model]
    wanted = [w / (sum(wanted) or 1) for w in wanted]
    names = [f"p{i}" for i in range(len(model))]
    posteriors(table, model, ["tokens"]).write.parquet(path := scratch_dir(spark, "posteriors"))
    residuals = fit_rates(spark.read.parquet(path), wanted, steps)
    # features again from the text in hand, rather than a join by an id that may repeat
    pairs = [y for k, n in zip(model, names) for y in (F.lit(k), F.col(n))]
    return _copies(posteriors(docs.select(_whole(docs), *features(text_col)), model, ["doc", "tokens"]).select(
        "doc", "tokens", F.round(rate_after(residuals, [F.col(n) for n in names]), 6).alias("rate"),
        F.create_map(*pairs).alias("posterior")), id_col, text_col, seed)


def _whole(docs: DataFrame) -> Column:
    return F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("doc")


def _copies(rated: DataFrame, id_col: str, text_col: str, seed: int) -> DataFrame:
    """Whole copies: a rate's fraction is drawn by a hash of id and text, so rows of
    one id (or none) draw apart; rows equal in both are drawn alike."""
    row = F.xxhash64(F.lit(seed), F.col(f"doc.`{id_col}`").cast("string"), F.col(f"doc.`{text_col}`").cast("string"))
    draw = F.pmod(row, F.lit(1_000_000)) / 1e6
    return rated.withColumn("copies", (F.floor("rate") + (draw < F.col("rate") - F.floor("rate")).cast("int")).cast("int"))


def resample(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """The rows of ``docs``, each as often as its rate says (none to several times)."""
    copies = F.when(F.col("copies") > 0, F.sequence(F.lit(1), F.col("copies")))
    # rows without copies go after the generator: a condition on ``copies`` itself would be
    # pushed down to the scan with the whole classifier written into it, many times over
    return (mix(docs, labels, **options).select("doc", F.explode_outer(copies).alias("copy"))
            .where("copy is not null").select("doc.*"))
