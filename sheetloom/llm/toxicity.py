"""Toxicity: a factorization machine over hashed terms.

A text's terms are its distinct words (lower-cased runs of letters, digits and ``_``) and,
for longer words, their first letters, so that inflected forms share a term. Each term falls
into one of a fixed number of buckets, is weighted by its inverse document frequency, and the
weights of a text are scaled to length one. Score = logistic(bias + sum w_i x_i + sum over
pairs <v_i, v_j> x_i x_j): the factors learn pairs, such as an insult with the mention of a
group, that additive weights miss. Learned by AdaGrad on a bounded sample, ``per_label`` rows
of each label, every fifth of which fits the final scale and shift, weighted to the labels'
true shares. Document frequencies are counted over all documents.

Null and empty texts have no terms and get the score of the bias alone. A document labelled
more than once is toxic if any of its labels is; null labels are ignored. Repeated rows score alike, an empty table gives an empty result,
and without labelled rows of both kinds all scores are 0. Only the key, text and label columns are
read, whatever else the tables hold.
"""

import re
import zlib
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import bounded_sample, count_buckets, crc_mod, release

BITS = 18
FACTORS = 8
STEM = 5  # letters of a longer word that count as a term of their own
PER_LABEL = 4000
THRESHOLD = 0.5
_WORD = re.compile(r"\w+")


def term_buckets(text: str | None, bits: int = BITS) -> np.ndarray:
    words = set(_WORD.findall((text or "").lower()))
    terms = words | {f"{w[:STEM]}*" for w in words if len(w) > STEM}
    mask = (1 << bits) - 1
    found = {zlib.crc32(t.encode("utf-8", "surrogatepass")) & mask for t in terms}
    return np.fromiter(found, np.int64, len(found))


def logistic(x):
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


@dataclass
class FactorizationMachine:
    idf: np.ndarray
    bias: float
    weights: np.ndarray
    factors: np.ndarray  # buckets x FACTORS
    scale: float = 1.0
    shift: float = 0.0
    known: bool = True

    def vector(self, buckets: np.ndarray) -> np.ndarray:
        values = self.idf[buckets]
        return values / max(np.linalg.norm(values), 1e-12)

    def margin(self, buckets: np.ndarray) -> float:
        x = self.vector(buckets)
        v = self.factors[buckets]
        summed = x @ v
        return float(self.bias + x @ self.weights[buckets] + 0.5 * ((summed * summed).sum() - ((x * x) @ (v * v)).sum()))

    def score(self, text: str | None) -> float:
        return float(logistic(self.scale * self.margin(term_buckets(text)) + self.shift)) if self.known else 0.0


def learn(model: FactorizationMachine, rows: list[np.ndarray], y: np.ndarray, epochs=4, rate=0.05, l2=1e-4) -> None:
    """AdaGrad over single rows, in a fixed random order."""
    rng = np.random.default_rng(11)
    sums_w, sums_v, sum_b = np.full(len(model.weights), 1e-6), np.full(model.factors.shape, 1e-6), 1e-6
    for _ in range(epochs):
        for k in rng.permutation(len(rows)):
            at = rows[k]
            x, w, v = model.vector(at), model.weights[at], model.factors[at]
            summed = x @ v
            margin = model.bias + x @ w + 0.5 * ((summed * summed).sum() - ((x * x) @ (v * v)).sum())
            wrong = logistic(margin) - y[k]
            gw = wrong * x + l2 * w
            gv = wrong * (np.outer(x, summed) - v * (x * x)[:, None]) + l2 * v
            sums_w[at] += gw * gw
            sums_v[at] += gv * gv
            sum_b += wrong * wrong
            model.weights[at] = w - rate * gw / np.sqrt(sums_w[at])
            model.factors[at] = v - rate * gv / np.sqrt(sums_v[at])
            model.bias -= rate * wrong / np.sqrt(sum_b)


def calibrate(margins: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Scale and shift of the margins under which ``y`` is likeliest; a few Newton steps."""
    a, b = 1.0, 0.0
    for _ in range(50):
        p = logistic(a * margins + b)
        g, h = weight * (p - y), weight * p * (1 - p) + 1e-9
        gradient = np.array([(g * margins).sum() + 0.1 * (a - 1), g.sum() + 0.1 * b])
        hessian = np.array([[(h * margins * margins).sum() + 0.1, (h * margins).sum()], [(h * margins).sum(), h.sum() + 0.1]])
        a, b = np.array([a, b]) - np.clip(np.linalg.solve(hessian, gradient), -1, 1)
        a = max(a, 0.1)
    return float(a), float(b)


def fit(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic", per_label: int = PER_LABEL) -> FactorizationMachine:
    """Frequencies from all of ``docs``; weights from a bounded sample of those with a row in ``labels``."""
    df = count_buckets(docs, text, term_buckets, 1 << BITS)
    idf = np.log((1 + max(int(df.max(initial=0)), 1)) / (1 + df)) + 0.1
    rng = np.random.default_rng(5)
    model = FactorizationMachine(idf.astype(np.float32), 0.0, np.zeros(1 << BITS, np.float32), rng.normal(0, 0.02, (1 << BITS, FACTORS)).astype(np.float32), known=False)
    labels = labels.filter(F.col(label).isNotNull() & F.col(key).isNotNull()).groupBy(key).agg(F.max(F.col(label).cast("int")).alias("_y"))
    shares = {r["_y"]: r["count"] for r in labels.groupBy("_y").count().collect()}
    chosen = bounded_sample(labels, key, "_y", per_label)  # bounded, hence small enough to send to every task
    with_text = docs.select(key, text).join(F.broadcast(chosen), key)

    def features(frames):
        for frame in frames:
            yield pd.DataFrame({"key": frame[key].astype(str), "y": frame["_y"], "buckets": [np.sort(term_buckets(t)).astype("<i4").tobytes() for t in frame[text]]})

    rows = with_text.mapInPandas(features, "key string, y int, buckets binary").toPandas()  # as bytes: numbers would be an object each on the driver
    release(docs.sparkSession)
    if rows["y"].nunique() < 2:
        return model
    rows["buckets"] = [np.frombuffer(b, "<i4") for b in rows["buckets"]]
    rows = rows.assign(n=rows["buckets"].map(len)).sort_values(["key", "n"]).reset_index(drop=True)
    y = rows["y"].to_numpy(float)
    buckets = list(rows["buckets"])
    kept = np.array([zlib.crc32(k.encode()) % 7 == 0 for k in rows["key"]])
    learn(model, [b for b, k in zip(buckets, kept) if not k], y[~kept])
    if len(set(y[kept])) == 2:
        weight = np.array([shares[int(v)] / max((y == v).sum(), 1) for v in y[kept]])
        model.scale, model.shift = calibrate(np.array([model.margin(b) for b, k in zip(buckets, kept) if k]), y[kept], weight / weight.mean())
    model.known = True
    return model


def score(model: FactorizationMachine, text: str = "text") -> Column:
    @F.pandas_udf("double")
    def toxic(texts: pd.Series) -> pd.Series:
        return texts.map(model.score)

    return toxic(F.coalesce(F.col(text).cast("string"), F.lit("")))


def score_held_out(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic", folds: int = 5, held: int = 0) -> DataFrame:
    """Learn from labels outside fold ``held`` and score every row."""
    fold = crc_mod(key, folds)
    model = fit(docs, labels.filter(fold != held), key, text, label)
    out = docs.select(key, (fold == held).alias("held_out"), score(model, text).alias("score"))
    return out.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))


def keep_clean(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic") -> DataFrame:
    """Documents that score below the threshold, with their columns as they are."""
    model = fit(docs, labels, key, text, label)
    return docs.withColumn("__toxic", score(model, text)).filter(F.col("__toxic") < THRESHOLD).drop("__toxic")
