"""Quality classifier: document evidence combined with host and path posteriors by hierarchical empirical Bayes."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from tidemark.llm.common import beta_strength, packed, slices, unpacked, utf8
from tidemark.plans.storage import store

#: Byte classes: upper-case letters, digits, marks of running text, other marks.
CLASSES = np.zeros(256, dtype=np.int64)
CLASSES[[*range(ord("A"), ord("Z") + 1)]] = 1
CLASSES[[*range(ord("0"), ord("9") + 1)]] = 2
CLASSES[list(b".,;:'\"()?-")] = 3
CLASSES[list(b"!#$%&*+/<=>@[\\]^_`{|}~")] = 4
FEATURES = 9


def features(text: bytes) -> list[float]:
    """Shares of kinds of characters, lengths of words and lines, and how much repeats."""
    words = text.split()
    if not words:
        return [0.0] * FEATURES
    kinds = np.bincount(CLASSES, weights=np.bincount(np.frombuffer(text, dtype=np.uint8), minlength=256), minlength=5) / len(text)
    lines = [line for line in text.split(b"\n") if line.strip()]
    letters = sum(map(len, words))
    return [
        kinds[1],
        kinds[2],
        kinds[3],
        kinds[4],
        min(letters / len(words), 30.0) / 10,
        sum(map(eq, words, words[1:])) / len(words),
        len(set(words)) / len(words) ** 0.9,
        1 - len(set(lines)) / len(lines),
        np.log1p(len(words)) / 10,
    ]


@dataclass(frozen=True)
class Model:
    """Logistic regression on standardised features; ``base`` is the log-odds of its sample."""

    mean: tuple[float, ...]
    scale: tuple[float, ...]
    weights: tuple[float, ...]
    intercept: float
    base: float

    def log_odds(self, x: np.ndarray) -> np.ndarray:
        return (x - np.array(self.mean)) / np.array(self.scale) @ np.array(self.weights) + self.intercept


def fit(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, steps: int = 50) -> Model:
    """Newton's method with a ridge penalty. Without both classes all weights are 0 and the intercept is that of no evidence."""
    if not len(y) or y.min() == y.max():
        return Model((0.0,) * FEATURES, (1.0,) * FEATURES, (0.0,) * FEATURES, 0.0, 0.0)
    mean, scale = x.mean(axis=0), x.std(axis=0)
    scale[scale == 0] = 1.0
    z = np.column_stack([(x - mean) / scale, np.ones(len(y))])
    penalty = np.diag([ridge] * FEATURES + [1e-6])
    w = np.zeros(FEATURES + 1)
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        step = np.linalg.solve((z.T * (p * (1 - p))) @ z + penalty, z.T @ (p - y) + penalty @ w)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    base = float(np.log(y.mean() / (1 - y.mean())))
    return Model(tuple(mean.tolist()), tuple(scale.tolist()), tuple(w[:-1].tolist()), float(w[-1]), base)


def train(docs: DataFrame, labels: DataFrame, sample: int = 20_000) -> Model:
    """Fit the classifier on ``sample`` labelled documents, the smallest by a hash of doc_id; only these features reach the driver.

    ``labels`` has doc_id and good (0 or 1); rows with null in either are left out. A document with several labels counts with each.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            found = [features(text) for text in utf8(batch["text"])]
            yield pa.RecordBatch.from_arrays([batch["doc_id"], batch["good"], pa.array(found, pa.list_(pa.float64()))], names=["doc_id", "good", "x"])

    chosen = labels.select(F.col("doc_id").cast("long").alias("_labelled"), F.col("good").cast("int").alias("good"))
    chosen = chosen.where("_labelled is not null and good is not null").orderBy(F.xxhash64("_labelled"), "_labelled", "good").limit(sample)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    rows = texts.join(F.broadcast(chosen), texts["doc_id"] == chosen["_labelled"]).select("doc_id", "good", "text")
    found = sorted(tuple(r) for r in rows.mapInArrow(run, "doc_id long, good int, x array<double>").collect())
    return fit(np.array([x for _, _, x in found]).reshape(-1, FEATURES), np.array([good for _, good, _ in found], dtype=float))


def evidence(docs: DataFrame, model: Model, limit: float = 12.0) -> DataFrame:
    """Puts ``_evidence`` in the place of ``text``: the log likelihood ratio of good to bad, at most ``limit``; 0 without words.

    Without a column ``text`` the field of that name in ``_row`` is read. The other columns pass through.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            texts = utf8(batch["text"] if "text" in batch.schema.names else batch["_row"].field("text").cast(pa.string()))
            x = np.array([features(text) for text in texts]).reshape(-1, FEATURES)
            found = np.clip(model.log_odds(x) - model.base, -limit, limit)
            found[[not text.strip() for text in texts]] = 0.0
            yield pa.RecordBatch.from_arrays([*[batch[c] for c in passed], pa.array(found, pa.float64())], names=[*passed, "_evidence"])

    passed = [c for c in docs.columns if c != "text"]
    return docs.mapInArrow(run, StructType([*[docs.schema[c] for c in passed], StructField("_evidence", DoubleType())]))


def _logit(p: Column) -> Column:
    return F.log(p / (1 - p))


def own_rate(base: float) -> Column:
    """A document's probability of being good by its own text, at the sample's base rate."""
    return 1 / (1 + F.exp(-(F.col("_evidence") + F.lit(base))))


@dataclass(frozen=True)
class Sites:
    """Outcomes of every path and host (``rates``), and what the levels above them are worth."""

    rates: DataFrame
    prior: float
    host_strength: float
    path_strength: float


def site_outcomes(scored: DataFrame, labels: DataFrame, base: float, folder: str) -> Sites:
    """Good and all outcomes of each path and host, in pseudo-counts.

    ``scored`` has doc_id, host, path and _evidence. Every document is an outcome with the probability that its text gives, and every
    label of a document is one more with what it says. The strength of each level is the beta-binomial's by the method of moments.
    Hot hosts and paths are sums. A null host or path is one like any other.
    """
    told = labels.select(F.col("doc_id").cast("long").alias("_labelled"), F.col("good").cast("double").alias("_good"))
    told = told.where("_labelled is not null and _good is not null").groupBy("_labelled").agg(F.sum("_good").alias("_good"), F.count(F.lit(1)).alias("_labels"))
    joined = scored.join(told, scored["doc_id"] == told["_labelled"], "left")
    k, n = own_rate(base) + F.coalesce("_good", F.lit(0.0)), F.lit(1.0) + F.coalesce("_labels", F.lit(0))
    paths = store(joined.groupBy("host", "path").agg(F.sum(k).alias("k"), F.sum(n).alias("n")), folder, "paths")
    hosts = store(paths.groupBy("host").agg(F.sum("k").alias("k"), F.sum("n").alias("n")), folder, "hosts")
    good, every = hosts.agg(F.sum("k"), F.sum("n")).first()
    prior = (good + 1.0) / (every + 2.0) if every else 0.5
    above = hosts.select(F.col("host").alias("_of"), F.col("k").alias("_host_k"), F.col("n").alias("_host_n"))
    rates = paths.join(above, F.col("host").eqNullSafe(F.col("_of")))
    rates = rates.select(F.col("host").alias("_host"), F.col("path").alias("_path"), F.col("k").alias("_path_k"), F.col("n").alias("_path_n"), "_host_k", "_host_n")
    return Sites(store(rates, folder, "site_rates"), prior, beta_strength(hosts), beta_strength(paths))


def with_posteriors(judged: DataFrame, sites: Sites, base: float) -> DataFrame:
    """Adds host_posterior, path_posterior and posterior to rows with host, path and _evidence.

    A document's own text is left out of the outcomes of its host and path, as it counts by itself: a path of one document without a label
    is its host's, and a host of one document the global prior.
    """
    own = own_rate(base)
    rows = judged.join(sites.rates, F.col("host").eqNullSafe(F.col("_host")) & F.col("path").eqNullSafe(F.col("_path")))

    def shrunk(level: str, above: Column, strength: float) -> Column:
        k, n = F.greatest(F.col(f"_{level}_k") - own, F.lit(0.0)), F.greatest(F.col(f"_{level}_n") - 1, F.lit(0.0))
        return (k + strength * above) / (n + strength)

    rows = rows.withColumn("host_posterior", shrunk("host", F.lit(sites.prior), sites.host_strength))
    rows = rows.withColumn("path_posterior", shrunk("path", F.col("host_posterior"), sites.path_strength))
    return rows.withColumn("posterior", 1 / (1 + F.exp(-(F.col("_evidence") + _logit(F.col("path_posterior"))))))


def classify(docs: DataFrame, labels: DataFrame, folder: str, host: str = "source", path: str = "lang", keep: list[str] | None = None, threshold: float = 0.5) -> DataFrame:
    """The columns ``keep`` (by default all) of every row of ``docs`` as the struct ``_row``, with evidence, host_posterior, path_posterior,
    posterior and kept.

    ``docs`` has doc_id, text and two columns that name a document's host and, within it, its path; ``labels`` has doc_id and good (0 or
    1). The posterior log-odds are the path's plus the text's evidence; a document stays if the posterior is at least ``threshold``. A null
    text counts as empty; a text without words gives no evidence and stands or falls with its path. A null doc_id has no label. Repeated
    rows are judged alike, and each counts. Texts of any length are read whole. Extra columns, whatever their names, stay in ``_row``. An
    empty table gives an empty result.
    """
    model = train(docs, labels)
    names = docs.columns if keep is None else keep
    row = F.struct(*[F.col(f"_row.`{c}`").alias(c) for c in names]).alias("_row")
    sites = [F.col("doc_id").cast("long").alias("doc_id"), F.col(host).cast("string").alias("host"), F.col(path).cast("string").alias("path")]
    rows = packed(docs, *sites, F.col("text").cast("string").alias("text"))
    if "text" in names:
        # The texts are read again rather than stored twice: the caller stores the rows that stay.
        scored = evidence(rows.select("doc_id", "host", "path", "text"), model)
        judged = evidence(rows.select(row, "host", "path"), model)
    else:
        scored = judged = store(evidence(rows.select(row, "doc_id", "host", "path", "text"), model), folder, "scored")
    found = site_outcomes(scored.select("doc_id", "host", "path", "_evidence"), labels, model.base, folder)
    judged = with_posteriors(judged, found, model.base).withColumn("kept", F.col("posterior") >= threshold)
    return judged.select("_row", F.col("_evidence").alias("evidence"), "host_posterior", "path_posterior", "posterior", "kept")


def accepted(docs: DataFrame, labels: DataFrame, folder: str, **options) -> DataFrame:
    """The rows of ``docs`` that the classifier keeps, with all their columns."""
    return unpacked(classify(docs, labels, folder, **options).where("kept"), docs.columns)
