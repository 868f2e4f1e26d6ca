"""A regularised quadratic discriminant over document statistics.

Every text gives a few counts; shares are taken as smoothed log odds and sizes
as logarithms, which makes them nearly normal.  Each class has a mean and a
covariance, shrunk towards the pooled covariance and then towards a multiple of
the identity.  The class sums (number, sum, sum of products) are one grouped
aggregation over all labelled rows of the training part, so the driver gets two
rows whatever the input.  A score is the difference of the classes' log
densities by Mahalanobis distances, with Cholesky factors that are computed
once, divided by the number of statistics (which spreads the scores and leaves
their order and sign), through the logistic function.

* null or empty text: zero counts; scored like any other text.
* labels that are null, and labels of unknown documents, are not learned from;
  repeated label rows count as often as they come.
* a null id is never held out.
* without rows of both classes every score is 0.5.
* texts of any length are read whole; repeated rows are scored each; an empty table
  gives no rows; other columns are not read, whatever their names.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from forecourt.llm.common import WHITE, id_text, map_blocks, texts
from forecourt.session import write_scratch

POOL, RIDGE = 0.1, 0.02
#: Printable characters that are neither alphanumeric nor common in prose.
MARKS = bytes(c for c in range(33, 127) if not chr(c).isalnum() and chr(c) not in ".,;:'\"-()?")
UPPER, DIGITS, STOPS = bytes(range(65, 91)), bytes(range(48, 58)), b".!?"
NAMES = ("size", "word_length", "marks", "upper", "digits", "stops", "distinct", "pairs", "lines", "top")


def odds(part: float, whole: float) -> float:
    return float(np.log((part + 0.5) / (max(whole - part, 0) + 0.5)))


def statistics(text: bytes) -> list[float]:
    """The transformed statistics of a text, in the order of ``NAMES``."""
    words = text.split()
    solid = text.translate(None, WHITE)
    n, size = len(words), len(solid)
    count = lambda chars: size - len(solid.translate(None, chars))
    lines = [x for x in text.split(b"\n") if x.strip(WHITE)]
    seen: dict[bytes, int] = {}
    for w in words:
        seen[w] = seen.get(w, 0) + 1
    return [float(np.log1p(n)), float(np.log1p(size / n)) if n else 0.0, odds(count(MARKS), size),
            odds(count(UPPER), size), odds(count(DIGITS), size), odds(min(count(STOPS), n), n), odds(len(seen), n),
            odds(len(set(zip(words, words[1:]))), max(n - 1, 0)), odds(len(lines) - len(set(lines)), len(lines)),
            odds(max(seen.values(), default=0), n)]


@dataclass
class Discriminant:
    """Means, whitening factors (inverse Cholesky factors) and constants by class."""

    means: np.ndarray
    whiten: np.ndarray
    offset: np.ndarray

    def score(self, x: np.ndarray) -> np.ndarray:
        z = np.einsum("cij,cnj->cni", self.whiten, x[None] - self.means[:, None])
        density = self.offset[:, None] - 0.5 * (z * z).sum(axis=2)
        return 1 / (1 + np.exp(-np.clip((density[1] - density[0]) / x.shape[1], -500, 500)))


def fit(n: np.ndarray, total: np.ndarray, products: np.ndarray, pool: float = POOL, ridge: float = RIDGE) -> Discriminant | None:
    """From the number, sums and products of both classes; None if one is empty."""
    if (n < 1).any():
        return None
    d = total.shape[1]
    means = total / n[:, None]
    scatter = products - n[:, None, None] * means[:, :, None] * means[:, None, :]
    own = scatter / np.maximum(n - 1, 1)[:, None, None]
    pooled = scatter.sum(axis=0) / max(n.sum() - 2, 1)
    whiten, offset = [], []
    for c in range(2):
        s = (1 - pool) * own[c] + pool * pooled
        s = (1 - ridge) * s + ridge * max(np.trace(s) / d, 1e-6) * np.eye(d)
        factor = np.linalg.cholesky(s)
        whiten.append(np.linalg.inv(factor))
        offset.append(np.log(n[c] / n.sum()) - np.log(np.diag(factor)).sum())
    return Discriminant(means, np.array(whiten), np.array(offset))


def measured(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, x): the statistics of every text."""
    def run(block: pa.RecordBatch) -> dict:
        return {"doc_id": block.column("doc_id"), "x": [statistics(t) for t in texts(block)]}

    schema = f"doc_id {docs.schema[doc_id].dataType.simpleString()}, x array<double>"
    return map_blocks(id_text(docs, doc_id, text), "text", schema, run)


def learn(rows: DataFrame, labels: DataFrame, label: str, training: Column, doc_id: str = "doc_id",
          pool: float = POOL, ridge: float = RIDGE) -> Discriminant | None:
    """Fit on the rows (doc_id, x) with a label 0 or 1 for which ``training`` holds."""
    d = len(NAMES)
    marked = labels.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{label}`").cast("int").alias("y"))
    known = rows.join(marked.where(F.col("y").isin(0, 1)), "doc_id").where(training)
    x = [F.col("x")[i] for i in range(d)]
    pairs = [(i, j) for i in range(d) for j in range(i, d)]
    sums = known.groupBy("y").agg(F.count("*").alias("n"), F.array(*[F.sum(c) for c in x]).alias("s"),
                                  F.array(*[F.sum(x[i] * x[j]) for i, j in pairs]).alias("p"))
    n, total, products = np.zeros(2), np.zeros((2, d)), np.zeros((2, d, d))
    for r in sums.collect():  # two rows
        n[r.y], total[r.y] = r.n, r.s
        for (i, j), v in zip(pairs, r.p):
            products[r.y, i, j] = products[r.y, j, i] = v
    return fit(n, total, products, pool, ridge)


def score(docs: DataFrame, labels: DataFrame, label: str, training: Column, doc_id: str = "doc_id",
          text: str = "text") -> DataFrame:
    """(doc_id, score, x) for every document; ``training`` is a condition on doc_id."""
    rows = docs.sparkSession.read.parquet(write_scratch(measured(docs, doc_id, text), "qda"))
    model = learn(rows, labels, label, training, doc_id)

    def run(batches):
        for b in batches:
            x = np.array(b.column("x").flatten()).reshape(-1, len(NAMES))
            s = model.score(x) if model else np.full(len(x), 0.5)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(s), b.column("x")], names=["doc_id", "score", "x"])

    schema = f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, score double, x array<double>"
    return rows.mapInArrow(run, schema)
