"""Quality classifier from positive and unlabelled texts (non-negative PU learning).

Trusted positives and unlabelled web text are turned into statistics of the
whole text. A linear model over the statistics and their squares minimises the
non-negative unbiased risk: the risk of the positives, plus what the unlabelled
texts say about the negative class, never below zero.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Bounds of the training sample (rows held on the driver).
MAX_POSITIVES = 15_000
MAX_UNLABELLED = 30_000
EPOCHS = 400
RATE = 0.05
RIDGE = 1e-4
SEED = 7

SYMBOLS = b"#*$%&|<>=~^_{}[]\\@+/"
_N_STATS = 16


def text_statistics(texts: list[str | None]):
    """A matrix of statistics, one row per text; null and empty texts give zeros (a short-text row)."""
    import numpy as np

    symbol = np.zeros(256)
    symbol[list(SYMBOLS)] = 1
    out = np.zeros((len(texts), _N_STATS))
    for i, text in enumerate(texts):
        words = text.split() if text else []
        if not words:
            continue
        n = len(words)
        raw = np.frombuffer(text.encode("utf-8", "replace"), dtype=np.uint8)
        count = np.bincount(raw, minlength=256)
        chars = max(1, int(count.sum() - count[9:14].sum() - count[32]))
        lengths = np.fromiter(map(len, words), dtype=np.int64, count=n)
        upper, lower, digits = int(count[65:91].sum()), int(count[97:123].sum()), int(count[48:58].sum())
        lines = [x for x in text.split("\n") if x.strip()]
        pairs = set(zip(words, words[1:], words[2:]))
        out[i] = (
            np.log(n + 1.0),
            lengths.mean(), min(lengths.std(), 20.0),
            upper / chars, lower / chars, digits / chars,
            float(count @ symbol) / chars,
            int(count[124]) / n, int(count[33]) / n,
            (int(count[44]) + int(count[46])) / n, (int(count[58]) + int(count[59]) + int(count[63])) / n,
            len(set(words)) / n ** 0.8,
            1 - len(pairs) / max(1, n - 2) if n > 2 else 0.0,
            1 - len(set(lines)) / len(lines),
            np.log(n / len(lines) + 1.0),
            int(count[128:].sum()) / chars,
        )
    return out


def _design(stats, centre, scale):
    import numpy as np

    z = np.clip((stats - centre) / scale, -8, 8)
    return np.hstack([z, z * z / 4, np.ones((len(z), 1))])


def fit_nnpu(positive, unlabelled, prior: float, epochs: int = EPOCHS):
    """(centre, scale, weights) of the linear model with the least non-negative unbiased risk.

    R = prior * E_p[l(+)] + max(0, E_u[l(-)] - prior * E_p[l(-)]), logistic loss l. When the
    second part is below zero, the step goes against it instead, which undoes overfitting.
    """
    import numpy as np

    centre = np.median(unlabelled, axis=0)
    scale = np.maximum(unlabelled.std(axis=0), 1e-3)
    p, u = _design(positive, centre, scale), _design(unlabelled, centre, scale)
    w = np.zeros(p.shape[1])
    m, v = np.zeros_like(w), np.zeros_like(w)

    def sigmoid(x):
        return 1 / (1 + np.exp(-np.clip(x, -35, 35)))

    for t in range(1, epochs + 1):
        sp, su = sigmoid(p @ w), sigmoid(u @ w)
        negative = np.mean(-np.log(np.maximum(1 - su, 1e-15))) - prior * np.mean(-np.log(np.maximum(1 - sp, 1e-15)))
        from_positive = prior * (p.T @ (sp - 1)) / len(p)
        from_negative = (u.T @ su) / len(u) - prior * (p.T @ sp) / len(p)
        grad = (from_positive + from_negative if negative >= 0 else -from_negative) + RIDGE * w
        m = 0.9 * m + 0.1 * grad
        v = 0.999 * v + 0.001 * grad * grad
        w = w - RATE * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.999 ** t)) + 1e-9)
    return centre, scale, w


def score_statistics(stats, model):
    """Probability of the positive class for each row of statistics."""
    import numpy as np

    centre, scale, w = model
    return 1 / (1 + np.exp(-np.clip(_design(stats, centre, scale) @ w, -35, 35)))


def _thinned(rows: DataFrame, total: int, most: int) -> DataFrame:
    """About ``most`` of ``total`` rows (all if fewer), by a hash of id, text and place: equal rows are told apart, none is cut off at an end."""
    cut = int(min(1.0, most / max(total, 1)) * 2 ** 31)
    if cut == 2 ** 31:
        return rows
    return rows.where(F.pmod(F.xxhash64(F.lit(SEED), "_id", "_text", F.monotonically_increasing_id()), F.lit(2 ** 31)) < cut)


def _sample(docs: DataFrame, doc_id: str, text: str, ids: DataFrame | None, most: int) -> DataFrame:
    """(_id, _text) of about ``most`` rows spread over the table; ``ids`` limits them to those ids, of which ``most`` are looked up."""
    rows = docs.select(F.col(doc_id).alias("_id"), F.col(text).cast("string").alias("_text"))
    if ids is not None:
        few = ids.orderBy(F.xxhash64(F.lit(SEED), "_key"), "_key").limit(most)
        rows = rows.join(F.broadcast(few), F.col("_id") == F.col("_key"), "left_semi")
    return _thinned(rows, rows.select("_id").count(), most)


def _statistics_of(sample: DataFrame):
    import numpy as np

    def task(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                stats = text_statistics(batch.column(0).slice(at, 256).to_pylist())
                yield pa.RecordBatch.from_arrays([pa.array(list(stats), pa.list_(pa.float64()))], ["stats"])

    rows = sample.select("_text").mapInArrow(task, "stats array<double>").collect()
    return np.array([r[0] for r in rows], dtype=float).reshape(len(rows), _N_STATS)


def train(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text",
          label: str = "quality", prior: float | None = None):
    """Fit on ``labels`` (all of whose rows are taken as training rows) and the texts of ``docs`` as unlabelled web text.

    The class prior is the share of positives among the labelled rows unless one is given; with no negative
    among them, 0.9. Without positives or texts there is no model (None): every score is then 0.5. Repeated rows and ids count as often as
    they stand; other columns, whatever their names, are not read. Samples hold about MAX_POSITIVES and MAX_UNLABELLED rows.
    """
    marked = labels.where(F.col(label).isNotNull() & F.col(doc_id).isNotNull()).select(F.col(doc_id).alias("_key"), F.col(label).alias("mark"))
    share = marked.agg(F.avg((F.col("mark") == 1).cast("double"))).first()[0]
    if share is None or share == 0:
        return None
    if prior is None:
        prior = share if share < 1 else 0.9
    positive = _statistics_of(_sample(docs, doc_id, text, marked.where("mark = 1").select("_key").distinct(), MAX_POSITIVES))
    unlabelled = _statistics_of(_sample(docs, doc_id, text, None, MAX_UNLABELLED))
    if not len(positive) or not len(unlabelled):
        return None
    return fit_nnpu(positive, unlabelled, prior)


def score(docs: DataFrame, model, text: str = "text", name: str = "score") -> DataFrame:
    """``docs`` with a score from 0 to 1 for every row; null and empty texts are scored as texts without words.

    A column of ``docs`` named like the score is replaced. Every row is scored on its whole text, in the task that reads it.
    """
    from pyspark.sql.functions import pandas_udf

    def points(texts):
        import pandas as pd

        if model is None:
            return pd.Series([0.5] * len(texts))
        values = texts.where(texts.notna(), None).tolist()
        return pd.Series([float(x) for at in range(0, len(values), 256)
                          for x in score_statistics(text_statistics(values[at:at + 256]), model)])

    import pandas as pd
    points.__annotations__ = {"texts": pd.Series, "return": pd.Series}
    return docs.withColumn(name, pandas_udf(points, "double")(F.col(text).cast("string")))
