"""Quality classifier: Bradley-Terry scores learnt from preference pairs.

Defined results: null or empty text has zero features and still a score; labels that are null are
not learnt from; a doc_id with several label rows is learnt from once a row; with labels of one
class only, or none, every score is 0.5; rows with a null doc_id are scored and not held out.
Bounded samples, both parameters: max_train labelled rows of documents, and `pairs` preference pairs drawn
of them; rows are chosen by a hash of doc_id and text, so a doc_id that repeats in docs or labels counts
once a row and can take no more than that bound. A text of any length is read whole, in one task's memory;
an empty table has no scores.
A line counts towards the "worst line" from 40 characters on, in texts of every length.
"""
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cols, text_udf

N_FEATURES = 14
#: Where the features stand for a moment; no column of a table is called so.
FEATURES = "cadenza:features"


def features(text: str):
    """Shares that describe form only; the worst line stands beside the whole."""

    def shares(t):
        w = t.split()
        n, c = max(1, len(w)), max(1, len(t))
        letters = n_letters(t)
        odd = sum(t.count(x) for x in "#%&*$!|@~^=<>{}[]\\/_")
        again = sum(a == b for a, b in zip(w, w[1:]))
        return (odd / c, sum(map(str.isupper, w)) / n, again / n, len(set(w)) / n, letters / c, len(w))

    whole = shares(text)
    lines = [x for x in text.split("\n") if len(x) >= 40] or [text]
    worst = [shares(x) for x in lines] if len(lines) > 1 else [whole]
    size = sum(x[5] for x in worst) or 1
    bad = sum(x[5] for x in worst if x[0] > 0.05 or x[1] > 0.5 or x[2] > 0.3 or x[3] < 0.3 and x[5] > 20) / size
    import math

    return [
        whole[0], whole[1], whole[2], whole[3], whole[4], math.log1p(whole[5]),
        max(x[0] for x in worst), max(x[1] for x in worst), max(x[2] for x in worst), min(x[4] for x in worst),
        bad, float(bad > 0), text.count("\n") / (len(text) + 1), sum(map(len, text.split())) / max(1, whole[5]) / 10,
    ]


_ASCII = bytes(range(128))
_ASCII_LETTERS = bytes(c for c in _ASCII if chr(c).isalpha())


def n_letters(text: str) -> int:
    """Characters that are letters in any script (str.isalpha); those of ASCII are counted as bytes."""
    b = text.encode("utf-8", "surrogatepass")
    n = len(b) - len(b.translate(None, _ASCII_LETTERS))
    return n if len(b) == len(text) else n + sum(map(str.isalpha, b.translate(None, _ASCII).decode("utf-8", "surrogatepass")))


def feature_column(text="text"):
    """array<double> of a text column; only the text goes to Python."""

    def run(texts):
        import pyarrow as pa

        return pa.array([features(t.decode("utf-8", "replace")) for t in texts], pa.list_(pa.float64()))

    return text_udf(run, "array<double>")(text)


def held_out(doc_id="doc_id"):
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0


def fit(x, y, pairs=60_000, steps=400, seed=7):
    """Bradley-Terry: logistic loss on standardised feature differences of (better, worse) pairs.

    Returns (mean, scale, weights, threshold, slope); the threshold is the quantile of the
    training scores with the best balanced accuracy, which score() maps to 0.3.
    """
    import numpy as np

    x, y = np.asarray(x, float), np.asarray(y)
    if len(set(y.tolist())) < 2:
        return None
    mu, sd = x.mean(0), x.std(0) + 1e-9
    z, rng = np.clip((x - mu) / sd, -8, 8), np.random.default_rng(seed)
    d = z[rng.choice(np.flatnonzero(y == 1), pairs)] - z[rng.choice(np.flatnonzero(y == 0), pairs)]
    w, v = np.zeros(z.shape[1]), np.zeros(z.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(np.clip(d @ w, -30, 30)))
        v = 0.9 * v + (d * p[:, None]).mean(0) - 1e-3 * w
        w = w + 0.1 * v
    s = z @ w
    best = (-1.0, 0.0)
    for q in np.linspace(0.005, 0.995, 199):
        t = np.quantile(s, q)
        best = max(best, (((s >= t)[y == 1].mean() + (s < t)[y == 0].mean()) / 2, float(t)))
    return mu.tolist(), sd.tolist(), w.tolist(), best[1], 1.0


def quality_scores(docs: DataFrame, labels: DataFrame, label: str = "quality", max_train: int = 20_000, pairs: int = 60_000, cut: float = 0.3, carry=()) -> DataFrame:
    """docs(doc_id, text), labels(doc_id, label) -> (doc_id, held_out, score, predicted), one row per row of docs.

    Columns of docs named in carry stay on their row, in place of doc_id alone.

    Learns from at most max_train rows of labelled documents outside the held-out fold; the bound holds
    after labels and documents have met. The same scores go to every document.
    """
    import math

    base = math.log(cut / (1 - cut))
    known = labels.filter(F.col(label).isNotNull() & F.col("doc_id").isNotNull() & ~held_out()).select("doc_id", F.col(label).alias("y"))
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_train)  # a broadcast of max_train rows at most
    met = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select(F.xxhash64("doc_id", "text").alias("h"), "doc_id", "y", feature_column().alias("x"))
    train = met.orderBy("h", "doc_id", "y", "x").limit(max_train)
    train = train.orderBy("doc_id", "y", "x").select("x", "y").collect()
    model = fit([r.x for r in train], [int(r.y) for r in train], pairs) if train else None
    x = F.col(FEATURES)
    if model is None:
        score = F.lit(0.5)
    else:
        mu, sd, w, t, slope = model
        terms = [F.greatest(F.lit(-8.0), F.least(F.lit(8.0), (x[i] - mu[i]) / sd[i])) * w[i] for i in range(len(w))]
        score = 1 / (1 + F.exp(-((sum(terms[1:], terms[0]) - t) * slope + base)))
    kept = cols(docs, carry or ["doc_id"])
    rows = docs.withColumn(FEATURES, feature_column())
    return rows.select(*kept, F.coalesce(held_out(), F.lit(False)).alias("held_out"), score.alias("score")).withColumn("predicted", (F.col("score") >= cut).cast("int"))
