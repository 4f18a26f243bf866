"""Document quality by hierarchical empirical Bayes.

A classifier gives each document's own evidence. Labels summed up per host and
per path of a host say how good its site is: a path's rate is shrunk towards its
host's, and that towards the rate of all labels, the more so the fewer labels
there are and the more alike sites turn out to be. Both logits add up.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reachbook.llm.common import SPACE, in_batches, stored


@dataclass(frozen=True)
class Fit:
    """The classifier sees at most `rows` labelled documents, those whose id
    hashes lowest, as sets of words hashed to `buckets` and a few shares."""

    rows: int = 6000
    buckets: int = 1 << 14
    epochs: int = 40
    least_steps: int = 500
    rate: float = 0.5
    decay: float = 1e-3
    seed: int = 11


#: Shares of a text in steps of this size are words of their own.
_STEPS = 10


def features(text: str, fit: Fit) -> np.ndarray:
    """Numbers of the buckets that a text's words and shares fall into."""
    data = text.lower().encode()
    words = data.split()
    distinct = set(words)
    ink = max(1, len(data.translate(None, SPACE)))
    letters = sum(c.isalpha() for c in text)
    shares = {
        "distinct": len(distinct) / max(1, len(words)),
        "letters": letters / max(1, len(text)),
        "symbols": (len(data) - len(data.translate(None, b"#*$%&|<>!{}[]=_~^"))) / ink,
        "digits": (len(data) - len(data.translate(None, b"0123456789"))) / ink,
        "upper": sum(c.isupper() for c in text) / max(1, letters),
        "size": min(1.0, np.log1p(len(words)) / 10),
        "long": min(1.0, ink / max(1, len(words)) / 20),
    }
    marks = [f"{name}:{int(share * _STEPS)}".encode() for name, share in shares.items()]
    hashed = {xxhash.xxh3_64_intdigest(w) % fit.buckets for w in distinct}
    hashed |= {xxhash.xxh3_64_intdigest(m, 1) % fit.buckets for m in marks}
    return np.fromiter(sorted(hashed), np.int32, len(hashed))


class Classifier:
    """Logistic regression on sets of buckets, one column per label."""

    def __init__(self, labels: int, fit: Fit):
        self.fit_plan = fit
        self.weights = np.zeros((fit.buckets, labels))
        self.offset = np.zeros(labels)

    def logits(self, sets: list[np.ndarray]) -> np.ndarray:
        sizes = np.array([len(s) for s in sets])
        every = np.concatenate(sets)
        starts = np.cumsum(sizes) - sizes
        sums = np.add.reduceat(self.weights[every], starts, axis=0)
        return sums + self.offset

    def learn(self, sets: list[np.ndarray], labels: np.ndarray) -> None:
        """Adagrad in a fixed order; every set holds a bucket at least."""
        plan = self.fit_plan
        rng = np.random.default_rng(plan.seed)
        squares = np.full_like(self.weights, 1e-3)
        rate = np.clip(labels.mean(axis=0), 0.01, 0.99)
        self.offset = np.log(rate / (1 - rate))
        batches = -(-len(sets) // 256)
        for _ in range(max(plan.epochs, plan.least_steps // batches)):
            order = rng.permutation(len(sets))
            for low in range(0, len(order), 256):
                chosen = order[low : low + 256]
                own = [sets[i] for i in chosen]
                error = 1 / (1 + np.exp(-np.clip(self.logits(own), -30, 30))) - labels[chosen]
                sizes = np.array([len(s) for s in own])
                gradient = np.zeros_like(self.weights)
                np.add.at(gradient, np.concatenate(own), np.repeat(error, sizes, axis=0))
                touched = np.flatnonzero(gradient.any(axis=1))
                step = gradient[touched] / len(chosen) + plan.decay * self.weights[touched]
                squares[touched] += step**2
                self.weights[touched] -= plan.rate * step / np.sqrt(squares[touched])
                self.offset -= plan.rate * 0.1 * error.mean(axis=0)


def _classifier(docs: DataFrame, labels: DataFrame, fit: Fit) -> Classifier:
    """Fitted to (doc_id, good, toxic) of a bounded sample. A label that is null does not count."""
    known = labels.where("good is not null and toxic is not null and doc_id is not null")
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(fit.rows)

    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        sets = [features(t or "", fit).tobytes() for t in batch.column(1).to_pylist()]
        return pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(sets, pa.binary()), batch.column(2), batch.column(3)], ["doc_id", "own", "good", "toxic"]
        )

    sample = docs.select("doc_id", "text").join(chosen, "doc_id").select("doc_id", "text", "good", "toxic")
    rows = in_batches(sample, step, "doc_id long, own binary, good int, toxic int").orderBy("doc_id", "own").limit(2 * fit.rows)
    found = Classifier(2, fit)
    rows = rows.collect()
    if rows:
        found.learn([np.frombuffer(r["own"], np.int32) for r in rows], np.array([[r["good"], r["toxic"]] for r in rows], float))
    return found


@dataclass(frozen=True)
class Level:
    """Strength of a prior in labels: how many it takes to weigh as much."""

    mean: float
    host: float
    path: float


def _strength(excess: float, groups: int, labels: int, spread: float) -> float:
    """From the spread of rates between groups beyond what chance makes of it.

    Weighed by labels, rates spread by m (1 - m) (g + (1 - g) / (k + 1)) for g
    groups per label and a prior worth k labels.
    """
    chance = min(groups / labels, 0.99) if labels else 0.99
    alike = (excess / spread - chance) / (1 - chance) if spread else 0.0
    return 1 / min(max(alike, 1e-4), 0.99) - 1


def _levels(paths: DataFrame) -> Level:
    """Priors from the sums of labels per path (_host, _path, n, good, host_n, host_good)."""
    rate, host_rate = F.col("good") / F.col("n"), F.col("host_good") / F.col("host_n")
    total = paths.agg(F.sum("n"), F.sum("good"), F.count("*"), F.sum(F.col("n") / F.col("host_n"))).first()
    labels, good, groups, hosts = total[0] or 0, total[1] or 0, total[2], total[3] or 0.0
    mean = (good + 1) / (labels + 2)
    spread = mean * (1 - mean)
    if not labels:
        return Level(mean, 1.0, 1.0)
    between = paths.agg(
        F.sum(F.col("n") * (host_rate - F.lit(mean)) ** 2), F.sum(F.col("n") * (rate - host_rate) ** 2)
    ).first()
    return Level(
        mean,
        _strength(between[0] / labels, round(hosts), labels, spread),
        _strength(between[1] / labels, max(0, groups - round(hosts)), labels, spread),
    )


def _logit(p: Column) -> Column:
    p = F.least(F.greatest(p, F.lit(1e-6)), F.lit(1 - 1e-6))
    return F.log(p / (1 - p))


def _named(column: str) -> Column:
    """A null is a name of its own."""
    name = F.col(column).cast("string")
    return F.when(name.isNull(), "b").otherwise(F.concat(F.lit("a"), name))


def site_quality(
    docs: DataFrame,
    labels: DataFrame,
    *,
    fit: Fit = Fit(),
    least: float = 0.5,
    key: str = "doc_id",
    text: str = "text",
    host: str = "source",
    path: str = "lang",
) -> DataFrame:
    """One row per document: p_doc of its text alone, p_site of its path, both
    together as p_quality, p_toxic, and kept (good enough and not toxic).

    A document's own label never counts for its own site. Hosts and paths
    without labels get the rates above them. A null host or path is one of its
    own; null texts are empty; labels of unknown documents are ignored, and so
    is all but one of repeated labels; repeated rows are alike; other columns
    are ignored; no labels leave every probability of quality at a half.
    """
    each = docs.select(
        F.col(key).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"),
        _named(host).alias("_host"), _named(path).alias("_path"),
    )
    marks = labels.select(
        F.col(key).cast("long").alias("doc_id"), F.col("quality").cast("int").alias("good"), F.col("toxic").cast("int").alias("toxic")
    )
    marks = stored(marks.groupBy("doc_id").agg(F.min("good").alias("good"), F.max("toxic").alias("toxic")))
    classifier = _classifier(each, marks, fit)

    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        sets = [features(t or "", fit) for t in batch.column(1).to_pylist()]
        logits = classifier.logits(sets)
        columns = [batch.column(0), batch.column(2), batch.column(3), pa.array(logits[:, 0]), pa.array(logits[:, 1])]
        return pa.RecordBatch.from_arrays(columns, ["doc_id", "_host", "_path", "own", "toxic_logit"])

    scored = in_batches(each, step, "doc_id long, _host string, _path string, own double, toxic_logit double")
    scored = stored(scored.join(marks.select("doc_id", "good"), "doc_id", "left"))
    by_path = stored(
        scored.where("good is not null").groupBy("_host", "_path").agg(F.count("*").alias("n"), F.sum("good").alias("good"))
    )
    by_host = stored(by_path.groupBy("_host").agg(F.sum("n").alias("host_n"), F.sum("good").alias("host_good")))
    paths = stored(by_path.join(by_host, "_host"))
    level = _levels(paths)
    hosts = by_host.select("_host", "host_n", "host_good")
    placed = scored.join(hosts, "_host", "left").join(
        by_path.withColumnsRenamed({"n": "path_n", "good": "path_good"}), ["_host", "_path"], "left"
    )
    mine, is_marked = F.coalesce("good", F.lit(0)), F.col("good").isNotNull().cast("int")

    def others(count: str, minus: Column) -> Column:
        return F.greatest(F.coalesce(count, F.lit(0)) - minus, F.lit(0))

    host_rate = (others("host_good", mine) + F.lit(level.mean * level.host)) / (others("host_n", is_marked) + F.lit(level.host))
    path_rate = (others("path_good", mine) + host_rate * F.lit(level.path)) / (others("path_n", is_marked) + F.lit(level.path))
    together = F.col("own") + _logit(F.col("p_site")) - _logit(F.lit(level.mean))
    return (
        placed.withColumn("p_site", path_rate)
        .withColumn("p_quality", 1 / (1 + F.exp(-together)))
        .select(
            F.col("doc_id").alias(key),
            (1 / (1 + F.exp(-F.col("own")))).alias("p_doc"),
            "p_site",
            "p_quality",
            (1 / (1 + F.exp(-F.col("toxic_logit")))).alias("p_toxic"),
            ((F.col("p_quality") >= least) & (F.col("toxic_logit") < 0)).alias("kept"),
        )
    )
