"""Mixing documents to target weights of soft domains, with DataFrame functions only.

A classifier learned from a table of labels gives every document a chance of each domain. Rates
(how often to take a document) are then fitted by projected-gradient least squares: the expected
tokens of each domain, sum of rate x tokens x chance, are to match the targets, and rates stay
nonnegative. A gradient step subtracts from a rate the document's chances times one number per
domain, so a document's rate follows from these numbers alone. The squares are weighted by the
inverse of the overlap of the domains, the sums of tokens x chance x chance over documents whose
rate is not zero: domains that the classifier parts poorly then need no more steps than others. One
pass gives both the sums and the overlaps, a few numbers per domain. A step that does not bring the
sums nearer is halved.
"""

from __future__ import annotations

import json
import logging
import math

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from depotflow.llm.common import stash
from depotflow.llm.textarrays import labelled_sample

#: Marker words are learned from at most so many labelled documents of each class.
SAMPLE_PER_CLASS = 1000
MARKERS = 48
TARGETS = {"good": 0.90, "low": 0.07, "toxic": 0.03}
#: Passes at most; a target is met within this part of itself, a target of zero of all tokens.
PASSES, TOLERANCE = 40, 1e-3
#: A step is halved at most so often; targets that then still are not nearer are out of reach.
HALVINGS = 6
_SHARES = [0.0, 1e-4, 3e-4, 1e-3, 3e-3, 1e-2, 3e-2, 1e-1, 3e-1]
_LENGTHS = [3.0, 4.0, 4.5, 5.0, 5.5, 6.0, 7.0, 8.0, 10.0]


def domain_of(labels: DataFrame) -> Column:
    """The domain that labels name: toxic, low quality, or good."""
    return F.when(F.col("toxic") == 1, "toxic").when(F.col("quality") == 0, "low").when(F.col("quality") == 1, "good")


def marker_words(docs: DataFrame, labels: DataFrame, column: str = "toxic", per_class: int = SAMPLE_PER_CLASS) -> list[str]:
    """Word beginnings whose shares of documents differ most between the classes of a label."""
    sample = labelled_sample(docs, labels, column, per_class)
    words = F.array_distinct(F.regexp_extract_all(F.lower("text"), F.lit(r"\p{L}{4,}"), F.lit(0)))
    starts = F.array_distinct(F.transform(words, lambda w: F.substring(w, 1, 6)))
    counted = (
        sample.select("label", F.explode(starts).alias("start"))
        .groupBy("start")
        .agg(F.sum("label").alias("one"), F.count(F.lit(1)).alias("all"))
        .filter("one >= 5")
    )
    sizes = {row[0]: row[1] for row in sample.groupBy("label").count().collect()}
    if len(sizes) < 2:
        return []
    pooled = F.col("all") / F.lit(float(sizes[0] + sizes[1]))
    gap = F.col("one") / sizes[1] - (F.col("all") - F.col("one")) / sizes[0]
    z = gap / F.sqrt(F.greatest(pooled * (1 - pooled), F.lit(1e-9)) * (1 / sizes[0] + 1 / sizes[1]))
    top = counted.withColumn("z", z).filter("z > 5").orderBy(F.desc("z"), "start").limit(MARKERS)
    return sorted(row[0] for row in top.collect())


def _features(text: Column, tokens: Column, markers: list[str]) -> dict[str, tuple[Column, list[float]]]:
    """The value of each feature, and the bounds that are counted where it exceeds them."""
    letters = F.greatest(F.char_length(text), F.lit(1))
    words = F.greatest(tokens, F.lit(1))
    hits = F.lit(0)
    if markers:
        hits = F.regexp_count(F.lower(text), F.lit(r"(?<!\p{L})(?:" + "|".join(markers) + ")"))
    return {
        "capitals": (F.regexp_count(text, F.lit("[A-Z]")) / letters, _SHARES),
        "signs": (F.regexp_count(text, F.lit(r"[!%$#&*|<>{}\[\]]")) / letters, _SHARES),
        "echoes": (F.regexp_count(text, F.lit(r"(?<![^ ])([^ \n]+) \1(?![^ \n])")) / words, _SHARES),
        "markers": (hits / words, _SHARES),
        "length": (letters / words, _LENGTHS),
    }


def _bin(value: Column, bounds: list[float]) -> Column:
    """How many of the bounds a value exceeds."""
    return sum(((value > b).cast("int") for b in bounds), F.lit(0))


def domain_posteriors(docs: DataFrame, labels: DataFrame) -> tuple[DataFrame, list[str]]:
    """(doc_id, n_tokens, chances) of every row, written, and the names of the chances.

    Naive Bayes over binned features, with counts over all labelled documents. NULL texts have
    no tokens. Labels that name no domain or no document do not count; of several the smallest
    name does. Without any label there is one domain, ``all``.
    """
    markers = marker_words(docs, labels)
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text.alias("text"))
    rows = rows.withColumn("n_tokens", F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+")).cast("bigint"))
    features = _features(F.col("text"), F.col("n_tokens"), markers)
    valued = rows.select("doc_id", "n_tokens", *[value.alias(name) for name, (value, _) in features.items()])
    bins_of = [_bin(F.col(name), bounds).alias(name) for name, (_, bounds) in features.items()]
    binned = stash(valued.select("doc_id", "n_tokens", *bins_of), "mixing-features")
    known = (
        labels.select(F.col("doc_id").cast("bigint").alias("doc_id"), domain_of(labels).alias("domain"))
        .filter("domain IS NOT NULL")
        .groupBy("doc_id")
        .agg(F.min("domain").alias("domain"))
    )
    joined = binned.join(known, "doc_id")
    pairs = F.explode(F.array(*[F.struct(F.lit(n).alias("feature"), F.col(n).alias("bin")) for n in features]))
    counts = joined.select("domain", pairs.alias("p")).groupBy("domain", "p.feature", "p.bin").count().collect()
    domains = sorted({row["domain"] for row in counts}) or ["all"]
    bins = len(_SHARES) + 1
    total = {d: sum(r["count"] for r in counts if r["domain"] == d) / len(features) for d in domains}
    held = {(r["feature"], r["bin"], r["domain"]): r["count"] for r in counts}
    everything = sum(total.values())
    logs = [F.lit(math.log((total[d] + 1) / (everything + len(domains)))) for d in domains]
    for name in features:
        matrix = [
            [math.log((held.get((name, b, d), 0) + 0.5) / (total[d] + 0.5 * bins)) for d in domains] for b in range(bins)
        ]
        row = F.get(F.from_json(F.lit(json.dumps(matrix)), "array<array<double>>"), F.col(name))
        logs = [value + F.get(row, k) for k, value in enumerate(logs)]
    scored = binned.select("doc_id", "n_tokens", F.array(*logs).alias("logs"))
    scored = scored.withColumn("raw", F.transform("logs", lambda v: F.exp(v - F.array_max("logs"))))
    sums = F.aggregate("raw", F.lit(0.0), lambda a, v: a + v)
    return stash(scored.select("doc_id", "n_tokens", F.transform("raw", lambda v: v / sums).alias("chances")), "mixing-chances"), domains


def _rate(steps: list[list[float]]) -> Column:
    """A document's rate after gradient steps with these relative excesses."""
    if not steps:
        return F.lit(1.0)
    history = F.from_json(F.lit(json.dumps(steps)), "array<array<double>>")

    def slope(excess: Column) -> Column:
        products = F.zip_with(F.col("chances"), excess, lambda p, g: p * g)
        return F.aggregate(products, F.lit(0.0), lambda a, v: a + v)

    return F.aggregate(history, F.lit(1.0), lambda rate, excess: F.greatest(F.lit(0.0), rate - slope(excess)))


class _Target:
    """What the domains are to sum up to, and how far sums are from it."""

    def __init__(self, base: np.ndarray, weights: np.ndarray):
        self.wanted = weights * (base.sum() / weights.sum()) if weights.sum() else np.zeros(len(base))
        self.allowed = TOLERANCE * np.where(self.wanted > 0, self.wanted, max(base.sum(), 1.0))

    def misses(self, sums: np.ndarray) -> np.ndarray:
        return np.abs(sums - self.wanted) / self.allowed

    def met(self, sums: np.ndarray) -> bool:
        return bool((self.misses(sums) <= 1).all())


def _sums(chances: DataFrame, count: int, rate: Column) -> tuple[np.ndarray, np.ndarray]:
    """Expected tokens of each domain at these rates, and the overlap of every two domains over the
    documents whose rate is above zero; one pass, one row."""
    pairs = [(k, j) for k in range(count) for j in range(k + 1)]
    weighed = chances.select("chances", F.col("n_tokens").cast("double").alias("tokens"), rate.alias("rate"))
    live = F.when(F.col("rate") > 0, F.col("tokens")).otherwise(0.0)
    row = weighed.agg(
        *[F.sum(F.col("tokens") * F.col("rate") * F.get("chances", k)) for k in range(count)],
        *[F.sum(live * F.get("chances", k) * F.get("chances", j)) for k, j in pairs],
    ).first()
    values = np.array([float(v or 0) for v in row])
    overlap = np.zeros((count, count))
    for (k, j), value in zip(pairs, values[count:], strict=True):
        overlap[k, j] = overlap[j, k] = value
    return values[:count], overlap


def _step(overlap: np.ndarray, excess: np.ndarray) -> np.ndarray:
    """The step that would take the excess away if no rate became zero; none along domains without tokens."""
    size = np.sqrt(np.diag(overlap))
    scale = np.divide(1.0, size, out=np.zeros_like(size), where=size > 0)
    return scale * np.linalg.lstsq(overlap * np.outer(scale, scale), excess * scale, rcond=1e-9)[0]


def fit_steps(chances: DataFrame, domains: list[str], targets: dict[str, float]) -> tuple[list[list[float]], list[dict]]:
    """The gradient steps, and per domain its expected tokens before and after them, the target, and
    whether it is met. Targets are weights of domains; the total of expected tokens is to stay what it is."""
    base, overlap = _sums(chances, len(domains), _rate([]))
    target = _Target(base, np.array([max(0.0, targets.get(d, 0.0)) for d in domains]))
    steps: list[list[float]] = []
    sums, passes, halved = base, 1, 0
    step = _step(overlap, sums - target.wanted)
    while not target.met(sums) and passes < PASSES and halved <= HALVINGS:
        tried, tried_overlap = _sums(chances, len(domains), _rate([*steps, step.tolist()]))
        passes += 1
        if np.square(target.misses(tried)).sum() < (1 - 1e-6) * np.square(target.misses(sums)).sum():
            steps.append(step.tolist())
            sums, halved = tried, 0
            step = _step(tried_overlap, sums - target.wanted)
        else:
            step, halved = step / 2, halved + 1
    report = [
        {"domain": d, "tokens": float(b), "expected": float(s), "target": float(w), "met": bool(m <= 1)}
        for d, b, s, w, m in zip(domains, base, sums, target.wanted, target.misses(sums), strict=True)
    ]
    missed = [f"{r['domain']}: {r['expected']:.0f} for {r['target']:.0f}" for r in report if not r["met"]]
    if missed:
        logging.getLogger(__name__).warning("Targets out of reach after %d passes: %s", passes, "; ".join(missed))
    return steps, report


def fit_rates(chances: DataFrame, domains: list[str], targets: dict[str, float]) -> DataFrame:
    """The rows with their ``rate``, and with ``unmet``, the domains whose target was not reached
    (a domain that no document has any chance of cannot be), in the order of their names."""
    steps, report = fit_steps(chances, domains, targets)
    unmet = F.array(*[F.lit(row["domain"]) for row in report if not row["met"]]).cast("array<string>")
    return chances.withColumns({"rate": _rate(steps), "unmet": unmet})


def mixing_rates(docs: DataFrame, labels: DataFrame, targets: dict[str, float] | None = None) -> DataFrame:
    """(doc_id, n_tokens, p_<domain>..., rate, copies, unmet) of every row of the documents.

    ``unmet`` names the domains whose target is out of reach, the same in every row. ``copies`` rounds the rate up or down by a hash of the id, so that sums of copies come near
    sums of rates.
    """
    chances, domains = domain_posteriors(docs, labels)
    rated = fit_rates(chances, domains, TARGETS if targets is None else targets)
    chance = F.pmod(F.xxhash64("doc_id", F.lit("mixing")), F.lit(1_000_000)) / 1_000_000
    return rated.select(
        "doc_id",
        "n_tokens",
        *[F.get("chances", k).alias(f"p_{d}") for k, d in enumerate(domains)],
        "rate",
        (F.floor("rate") + (chance < F.col("rate") - F.floor("rate")).cast("int")).cast("int").alias("copies"),
        "unmet",
    )
