"""Language ID: multinomial logistic regression on TF-IDF character n-grams.

Texts are lower-cased and everything but letters (digits and other number characters such as fractions too) becomes one space; n-grams of one to
three characters, spaces included, are hashed into a fixed number of buckets. Weights are
learned with follow-the-regularised-leader (per-coordinate rates, L1 and L2 penalties)
and stay sparse; a temperature fitted on rows kept from the learner calibrates the
probabilities. Document frequencies are counted over all training rows; the learner sees
a bounded sample of them, ``per_label`` rows of each language.

Null and empty texts and texts without any letter are ``und`` with score 0. Repeated rows
are predicted alike, ties go to the first label in order, an empty table gives an
empty result. Only the id, text and label columns are read, so further columns, whatever
their names, do no harm. Without labelled rows every text is ``und``.
"""

import sys
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import bounded_sample, count_buckets, crc_mod, release

BITS = 15
UNKNOWN = "und"
REJECT_BELOW = 0.4  # in the filter, a language less likely than this counts as unknown
_LETTERS = np.fromiter((chr(c).isalpha() for c in range(sys.maxunicode + 1)), bool)
_LETTERS = _LETTERS[:np.flatnonzero(_LETTERS)[-1] + 2]  # ends with one that stands for all beyond
_BLANK = ord(" ")
_MULTIPLIERS = np.array([2654435761, 2246822519, 3266489917], np.uint32)


def letter_codes(text: str | None) -> np.ndarray:
    """The code points of a cleaned text between two spaces; without any letter, none."""
    codes = np.frombuffer((text or "").lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    inside = np.zeros(len(codes) + 2, bool)
    inside[1:-1] = np.take(_LETTERS, codes, mode="clip")
    spaced = np.full(len(inside), _BLANK, np.uint32)
    np.copyto(spaced[1:-1], codes, where=inside[1:-1])
    stays = inside.copy()
    stays[1:] |= inside[:-1]  # the first of those between two words
    if not stays.any():
        return spaced[:0]
    stays[0] = True
    return spaced[stays]


def letters(text: str | None) -> str:
    return letter_codes(text)[1:-1].tobytes().decode("utf-32-le")


def ngram_buckets(codes: np.ndarray, bits: int = BITS) -> np.ndarray:
    """The buckets of all n-grams of a text's ``letter_codes``, repeats included."""
    one, two, three = _MULTIPLIERS
    pairs = codes[:-1] * one + codes[1:] * two
    triples = pairs[:-1] * three + codes[2:] * one
    shift = np.uint32(32 - bits)
    hashed = np.concatenate([codes * three, pairs * two, triples * two])
    return ((hashed ^ (hashed >> np.uint32(15))) * one >> shift).astype(np.int64)


def term_counts(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    codes = letter_codes(text)
    if not len(codes):
        return np.empty(0, np.int64), np.empty(0)
    counts = np.bincount(ngram_buckets(codes), minlength=1 << BITS)
    found = np.flatnonzero(counts)
    return found, counts[found]


def distinct_ngrams(text: str | None) -> np.ndarray:
    return term_counts(text)[0]


def vector(buckets: np.ndarray, counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    values = (1 + np.log(counts)) * idf[buckets]
    return values / max(np.linalg.norm(values), 1e-12)


def softmax(logits: np.ndarray) -> np.ndarray:
    raised = np.exp(logits - logits.max(axis=-1, keepdims=True))
    return raised / raised.sum(axis=-1, keepdims=True)


@dataclass
class LanguageModel:
    labels: list[str]
    idf: np.ndarray
    weights: np.ndarray  # buckets x labels
    bias: np.ndarray
    temperature: float

    def logits(self, buckets: np.ndarray, counts: np.ndarray) -> np.ndarray:
        return vector(buckets, counts, self.idf) @ self.weights[buckets] + self.bias

    def predict(self, text: str | None) -> tuple[str, float]:
        buckets, counts = term_counts(text)
        if not len(buckets) or not self.labels:
            return UNKNOWN, 0.0
        likely = softmax(self.logits(buckets, counts) / self.temperature)
        best = int(likely.argmax())
        return self.labels[best], float(likely[best])


def follow_leader(rows, targets, size: int, labels: int, alpha=1.0, beta=1.0, l1=0.002, l2=0.002, epochs=4):
    """FTRL-proximal over sparse rows (buckets, values); gives weights and bias."""
    z, n = np.zeros((size + 1, labels)), np.zeros((size + 1, labels))

    def leader(at):
        held = np.sign(z[at]) * np.maximum(np.abs(z[at]) - l1, 0)
        return -held / ((beta + np.sqrt(n[at])) / alpha + l2)

    order = np.random.default_rng(7)
    for _ in range(epochs):
        for k in order.permutation(len(rows)):
            at, x = np.append(rows[k][0], size), np.append(rows[k][1], 1.0)
            w = leader(at)
            wrong = softmax(x @ w)
            wrong[targets[k]] -= 1
            g = np.outer(x, wrong)
            sigma = (np.sqrt(n[at] + g * g) - np.sqrt(n[at])) / alpha
            z[at] += g - sigma * w
            n[at] += g * g
    weights = leader(slice(None))
    return weights[:size].astype(np.float32), weights[size].astype(np.float32)


def fit_temperature(logits: np.ndarray, targets: np.ndarray) -> float:
    """The temperature under which kept-out rows are likeliest."""
    if not len(targets):
        return 1.0
    temperatures = np.geomspace(0.05, 5, 60)
    loss = [-np.log(softmax(logits / t)[np.arange(len(targets)), targets] + 1e-12).mean() for t in temperatures]
    return float(temperatures[int(np.argmin(loss))])


def fit(train: DataFrame, key: str = "doc_id", text: str = "text", label: str = "lang", per_label: int = 500) -> LanguageModel:
    """Learn from ``train``: frequencies from all its rows, weights from ``per_label`` rows a label,
    every fifth of which sets the temperature."""
    train = train.select(key, text, label).filter(F.col(label).isNotNull())
    df = count_buckets(train, text, distinct_ngrams, 1 << BITS)

    def features(frames):
        for frame in frames:
            found = [term_counts(t) for t in frame[text]]
            yield pd.DataFrame({"label": frame[label], "kept": frame["_kept"], "buckets": [b.astype("<i4").tobytes() for b, _ in found], "counts": [c.astype("<i4").tobytes() for _, c in found]})

    chosen = bounded_sample(train, key, label, per_label).withColumn("_kept", F.pmod(F.hash(key), F.lit(5)) == 0).withColumn("_order", F.xxhash64(key))
    rows = chosen.mapInPandas(lambda frames: features(frames), "label string, kept boolean, buckets binary, counts binary").toPandas()  # as bytes: numbers would be an object each on the driver
    release(train.sparkSession)
    rows = rows[rows["buckets"].map(len) > 0]
    labels = sorted(rows["label"].unique())
    n = max(int(df.max(initial=0)), 1)
    idf = np.log((1 + n) / (1 + df)) + 1
    model = LanguageModel(labels, idf.astype(np.float32), np.zeros((1 << BITS, len(labels)), np.float32), np.zeros(len(labels), np.float32), 1.0)
    if not labels:
        return model
    rows["y"] = rows["label"].map(labels.index)
    rows["b"], rows["c"] = ([np.frombuffer(x, "<i4").astype(np.int64) for x in rows[c]] for c in ("buckets", "counts"))
    rows = rows.assign(_tie=[(y, len(b), int(b.sum()), int(c.sum())) for y, b, c in zip(rows["y"], rows["b"], rows["c"])]).sort_values("_tie")
    learned, kept = rows[~rows["kept"]], rows[rows["kept"]]
    model.weights, model.bias = follow_leader([(b, vector(b, c, model.idf)) for b, c in zip(learned["b"], learned["c"])], learned["y"].to_numpy(), 1 << BITS, len(labels))
    if len(kept):
        model.temperature = fit_temperature(np.array([model.logits(b, c) for b, c in zip(kept["b"], kept["c"])]), kept["y"].to_numpy())
    return model


def prediction(model: LanguageModel, text: str = "text") -> Column:
    """``struct(lang_pred, score)`` for a text column; the model travels with the function."""
    @F.pandas_udf("lang_pred string, score double")
    def predict(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([model.predict(t) for t in texts], columns=["lang_pred", "score"])

    return predict(F.col(text).cast("string"))


def predict_held_out(df: DataFrame, key: str = "doc_id", text: str = "text", label: str = "lang", folds: int = 3, held: int = 1, per_label: int = 500) -> DataFrame:
    """Learn outside fold ``held`` and predict every row."""
    fold = crc_mod(key, folds)
    model = fit(df.filter(fold != held), key, text, label, per_label)
    out = df.select(key, (fold == held).alias("held_out"), prediction(model, text).alias("_p"))
    return out.select(key, "held_out", "_p.lang_pred", "_p.score")


def keep_known(df: DataFrame, model: LanguageModel, text: str = "text", reject_below: float = REJECT_BELOW) -> DataFrame:
    """Rows whose language is recognised, with their columns as they are."""
    judged = df.withColumn("__language", prediction(model, text))
    known = (F.col("__language.lang_pred") != UNKNOWN) & (F.col("__language.score") >= reject_below)
    return judged.filter(known).drop("__language")
