"""Quality by regularised quadratic discriminant analysis of document statistics.

Each document is described by transformed statistics of its whole text. The class means and
covariances come from exact sums over all labelled training rows (no sample), taken in one
aggregation; the covariance of a class is shrunk towards the pooled diagonal. A score is the
logistic of the difference of the two log-densities, from Mahalanobis distances by Cholesky
factors that are computed once and travel with the model.

Defined cases: null text counts as empty, and an empty text has the statistics of no words; labels
that are null are ignored; rows that repeat count as often as they stand; with labels of one kind
only every score is that label, without any it is 0.5; an empty table gives an empty result;
further columns are ignored by ``scores`` and passed through by ``keep``.
"""

from __future__ import annotations

import unicodedata
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._spark import fresh, text_of

NAMES = ("length", "word", "upper", "symbol", "digit", "distinct", "doubled", "top", "bare", "ends", "lines", "spread")
SHRINK = 0.02
#: The largest log-density difference that is believed; the tails of a normal density say more than a sample can know.
BOUND = 12.0
#: Labelled ids up to which they are broadcast (8 bytes each).
BROADCAST_ROWS = 1_000_000

_TABLE = 0x110000
_KINDS = np.zeros(_TABLE, dtype=np.uint8)  # 0 letter without case or other, 1 lower, 2 upper, 3 digit, 4 space, 5 symbol
for _c in range(_TABLE):
    _k = unicodedata.category(chr(_c))
    _KINDS[_c] = 1 if _k == "Ll" else 2 if _k in ("Lu", "Lt") else 3 if _k[0] == "N" else 4 if chr(_c).isspace() else 5 if _k[0] in "PSC" else 0


def statistics(text: str) -> list[float]:
    """The transformed statistics of a text, in the order of NAMES."""
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    kinds = np.bincount(_KINDS[codes], minlength=6)
    letters, solid = max(1, int(kinds[:3].sum())), max(1, len(codes) - int(kinds[4]))
    words = text.split()
    n = len(words)
    counts = Counter(words)
    lines = text.split("\n")
    lengths = np.fromiter(map(len, words), dtype=np.float64, count=n)
    bare = sum(c for w, c in counts.items() if not any(map(str.isalnum, w)))
    ends = sum(c for w, c in counts.items() if len(w) > 2 and not w[-1].isalnum() and not w[-2].isalnum())
    doubled = sum(map(eq, words, words[1:]))
    share = lambda part, whole: float(np.log((part + 0.5) / (whole + 1.0)))  # noqa: E731  rare and frequent alike on a log scale
    return [
        float(np.log1p(len(codes))),
        float(np.log1p(lengths.mean())) if n else 0.0,
        share(int(kinds[2]), letters),
        share(int(kinds[5]), solid),
        share(int(kinds[3]), solid),
        share(len(counts), n),
        share(doubled, n),
        share(max(counts.values(), default=0), n),
        share(bare, n),
        share(ends, n),
        share(len(lines) - len(set(lines)), len(lines)),
        float(np.log1p(lengths.std())) if n else 0.0,
    ]


def features(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and a column per statistic."""
    rows = docs.select(F.col(id_col).alias("doc_id"), text_of(text_col).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.array([statistics(t.as_py()) for t in batch.column(1)], dtype=np.float64).reshape(-1, len(NAMES))
            yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array(found[:, j]) for j in range(len(NAMES))]], names=["doc_id", *NAMES])

    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, " + ", ".join(f"{n} double" for n in NAMES))


@dataclass(frozen=True)
class Model:
    """Means, inverse Cholesky factors and constants of the two classes; or one score for all."""

    means: np.ndarray
    factors: np.ndarray
    constants: np.ndarray
    fixed: float | None = None

    def score(self, x: np.ndarray) -> np.ndarray:
        if self.fixed is not None:
            return np.full(len(x), self.fixed)
        density = [c - 0.5 * (((x - m) @ f.T) ** 2).sum(1) for m, f, c in zip(self.means, self.factors, self.constants)]
        return 1 / (1 + np.exp(-np.clip(density[1] - density[0], -BOUND, BOUND)))


def fit(described: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", label_col: str = "quality", shrink: float = SHRINK) -> Model:
    """A model from all labelled rows of ``described``; two rows of sums reach the driver."""
    known = labels.filter(F.col(label_col).isin(0, 1)).select(F.col(id_col).alias("doc_id"), F.col(label_col).cast("int").alias("_y"))
    d = len(NAMES)
    pairs = [(i, j) for i in range(d) for j in range(i + 1)]
    sums = [F.sum(n).alias(f"s{i}") for i, n in enumerate(NAMES)] + [F.sum(F.col(NAMES[i]) * F.col(NAMES[j])).alias(f"p{i}_{j}") for i, j in pairs]
    rows = {r["_y"]: r for r in described.join(known, "doc_id").groupBy("_y").agg(F.count(F.lit(1)).alias("n"), *sums).collect()}
    if len(rows) < 2:
        none = np.zeros(0)
        return Model(none, none, none, float(next(iter(rows))) if rows else 0.5)
    means, covariances, sizes = [], [], []
    for y in (0, 1):
        r, n = rows[y], rows[y]["n"]
        mean, second = np.array([r[f"s{i}"] / n for i in range(d)]), np.zeros((d, d))
        for i, j in pairs:
            second[i, j] = second[j, i] = r[f"p{i}_{j}"] / n
        means.append(mean)
        covariances.append(second - np.outer(mean, mean))
        sizes.append(n)
    pooled = np.diag(np.diag(sum(c * n for c, n in zip(covariances, sizes)) / sum(sizes)))
    factors, constants = [], []
    for c, n in zip(covariances, sizes):
        own = (1 - shrink) * c + shrink * pooled + 1e-4 * np.eye(d)
        lower = np.linalg.cholesky(own)
        factors.append(np.linalg.inv(lower))
        constants.append(np.log(n / sum(sizes)) - np.log(np.diag(lower)).sum())
    return Model(np.array(means), np.array(factors), np.array(constants))


def scores(described: DataFrame, model: Model) -> DataFrame:
    """doc_id, score."""

    @F.pandas_udf("double")
    def score(*columns: pd.Series) -> pd.Series:
        return pd.Series(model.score(np.stack([c.to_numpy() for c in columns], 1)))

    return described.select("doc_id", score(*NAMES).alias("score"))


def keep(docs: DataFrame, labels: DataFrame, *, threshold: float = 0.7, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", shrink: float = SHRINK) -> DataFrame:
    """The input's rows and columns whose score reaches the threshold; only labelled rows are described twice."""
    known = labels.filter(F.col(label_col).isin(0, 1)).select(F.col(id_col).alias(fresh(docs, "_known"))).distinct()
    match = F.col(id_col) == F.col(fresh(docs, "_known"))
    taught = docs.join(F.broadcast(known) if known.count() <= BROADCAST_ROWS else known, match, "left_semi")
    model = fit(features(taught, id_col=id_col, text_col=text_col), labels, id_col=id_col, label_col=label_col, shrink=shrink)

    @F.pandas_udf("double")
    def score(text: pd.Series) -> pd.Series:
        return pd.Series(model.score(np.array([statistics(t) for t in text], dtype=np.float64).reshape(-1, len(NAMES))))

    return docs.filter(score(text_of(text_col)) >= threshold)
