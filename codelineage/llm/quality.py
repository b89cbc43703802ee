"""Quality scores of texts: a Gaussian-kernel ridge classifier over document statistics.

The kernel is approximated by random Fourier features. Tasks sum their share of the normal
equations, one sum per fold; the ridge solutions that leave one fold out score that
fold, and isotonic regression on those scores gives the calibration. What reaches the driver is
matrices of fixed size and counts of score bins, never rows.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from codelineage.storage import written

FOLDS = 4
BINS = 1000
# Tasks that sum the training rows; a sum is (features + 1)^2 numbers a fold.
SUMMING_TASKS = 16

_CLASSES = np.zeros((256, 8))
for _i, _bytes in enumerate((range(97, 123), range(65, 91), range(48, 58), b" \t", b"\n\r", b".,;:?'\"()-", range(128, 192))):
    _CLASSES[list(_bytes), _i] = 1
_CLASSES[:, 7] = 1 - _CLASSES.sum(1)
_CLASSES[192:, 7] = 0  # first bytes of longer characters are counted by the bytes that follow
N_STATISTICS = 22


def statistics(text: str | None) -> np.ndarray:
    """Statistics of a text, none of which tells its language, source or number."""
    data = text.encode() if text else b""
    words = data.split()
    n, w = max(1, len(data)), max(1, len(words))
    share = np.bincount(np.frombuffer(data, np.uint8), minlength=256) @ _CLASSES / n
    lengths = np.fromiter(map(len, words), np.float64, len(words)) if words else np.zeros(1)
    counts = Counter(words)
    lines = [x for x in data.split(b"\n") if x]
    line_counts = Counter(lines)
    k = max(1, len(lines))
    repeated = sum(map(bytes.__eq__, words, words[1:]))
    ends = sum(x[-1:] in (b".", b"!", b"?", b":") for x in lines)
    return np.array([
        *share, np.log1p(len(data)), np.log1p(len(words)), np.log1p(len(lines)),
        lengths.mean(), lengths.std(), np.mean(lengths <= 1),
        len(counts) / w, max(counts.values(), default=0) / w, repeated / w,
        len(line_counts) / k, ends / k, np.log1p(n / k),
        data.count(b"!") / w, (data.count(b"|") + data.count(b"<") + data.count(b"#")) / w,
    ])


@dataclass(frozen=True)
class Model:
    """All that scoring needs; its size does not depend on the rows it was fitted on."""

    centre: np.ndarray
    scale: np.ndarray
    directions: np.ndarray
    phases: np.ndarray
    weights: np.ndarray
    knots: np.ndarray
    values: np.ndarray

    def features(self, rows: np.ndarray) -> np.ndarray:
        x = np.clip((rows - self.centre) / self.scale, -6, 6)
        waves = np.sqrt(2 / len(self.phases)) * np.cos(x @ self.directions + self.phases)
        return np.hstack([waves, np.ones((len(rows), 1))])

    def score(self, rows: np.ndarray) -> np.ndarray:
        return np.interp(self.features(rows) @ self.weights, self.knots, self.values)


def isotonic(at: np.ndarray, count: np.ndarray, total: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rising means by pooling neighbours that violate the order: (centre, mean) of each block."""
    blocks: list[list[float]] = []  # count, sum of labels, sum of places
    for x, n, y in zip(at, count, total, strict=True):
        blocks.append([n, y, x * n])
        while len(blocks) > 1 and blocks[-2][1] * blocks[-1][0] >= blocks[-1][1] * blocks[-2][0]:
            last = blocks.pop()
            blocks[-1] = [a + b for a, b in zip(blocks[-1], last, strict=True)]
    found = np.array(blocks, float)
    return found[:, 2] / found[:, 0], found[:, 1] / found[:, 0]


def fold_of(key: str, folds: int = 3):
    """crc32 of the key as text, modulo ``folds``."""
    return F.crc32(F.col(key).cast("string").cast("binary")) % folds


def _rows(batch) -> np.ndarray:
    return np.stack(batch["x"].to_numpy()).astype(np.float64)


def fit(
    docs: DataFrame, labels: DataFrame, *, key: str = "doc_id", text: str = "text", features: int = 256,
    width: float = 4.0, ridge: float = 1e-3, max_rows: int = 500_000, seed: int = 11,
) -> Model:
    """Fit on the rows of ``docs`` whose key stands in ``labels(key, label)``.

    Labels are 0 or 1; null keys and null labels are left out, and of labels that disagree on a key the
    majority counts, 1 if they are even. If there are more than ``max_rows`` labelled rows, a sample of about
    that many is taken by a hash of the key; every row of ``docs`` is scored whatever the
    sample. Without labels, or with labels of one kind, every text gets their mean (1 without any).
    """
    @F.pandas_udf("array<double>")
    def measured(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: statistics(t).tolist())

    wanted = labels.filter(F.col("label").isNotNull() & F.col(key).isNotNull()).groupBy(key).agg(
        (F.avg("label") >= 0.5).cast("int").alias("label"))
    n = wanted.count()
    if n > max_rows:
        wanted = wanted.filter(F.pmod(F.xxhash64(key), F.lit(1_000_000)) < int(1_000_000 * max_rows / n))
    fold = F.pmod(F.xxhash64(key, F.lit("fold")), F.lit(FOLDS)).cast("int")
    rows = written(docs.select(key, measured(text).alias("x")).join(wanted, key).select("x", "label", fold.alias("fold")), "training")

    summed = rows.agg(
        F.count("label").alias("n"), F.sum("label").alias("ones"),
        *[f(F.col("x")[i]).alias(f"{name}{i}") for i in range(N_STATISTICS) for name, f in (("m", F.avg), ("s", F.stddev_pop))],
    ).first()
    n, ones = summed["n"], summed["ones"] or 0
    rng = np.random.default_rng(seed)
    plain = Model(
        np.array([summed[f"m{i}"] or 0.0 for i in range(N_STATISTICS)]),
        np.array([max(summed[f"s{i}"] or 0.0, 1e-6) for i in range(N_STATISTICS)]),
        rng.normal(size=(N_STATISTICS, features)) / width, rng.uniform(0, 2 * np.pi, features),
        np.zeros(features + 1), np.array([0.0]), np.array([ones / n if n else 1.0]),
    )
    if ones in (0, n):
        return plain

    def equations(batches):
        size = features + 1
        total = {f: (np.zeros((size, size)), np.zeros(size)) for f in range(FOLDS)}
        for batch in batches:
            z, y, own = plain.features(_rows(batch)), batch["label"].to_numpy(float), batch["fold"].to_numpy()
            for f, (a, b) in total.items():
                a += z[own == f].T @ z[own == f]
                b += z[own == f].T @ y[own == f]
        yield pd.DataFrame({
            "fold": list(total), "a": [a.tobytes() for a, _ in total.values()], "b": [b.tobytes() for _, b in total.values()]})

    size = features + 1
    a, b = np.zeros((FOLDS, size, size)), np.zeros((FOLDS, size))
    spread = rows.repartition(SUMMING_TASKS)
    for part in spread.mapInPandas(equations, "fold int, a binary, b binary").toLocalIterator():
        a[part["fold"]] += np.frombuffer(part["a"]).reshape(size, size)
        b[part["fold"]] += np.frombuffer(part["b"])

    def solved(left_out: int | None) -> np.ndarray:
        use = [f for f in range(FOLDS) if f != left_out]
        return np.linalg.solve(a[use].sum(0) + ridge * n * np.eye(size) / size, b[use].sum(0))

    by_fold = np.stack([solved(f) for f in range(FOLDS)])

    def binned(batches):
        for batch in batches:
            z = plain.features(_rows(batch))
            s = (z * by_fold[batch["fold"].to_numpy()]).sum(1)
            place = np.clip(np.round(s * BINS), -BINS, 2 * BINS).astype(int)
            yield pd.DataFrame({"place": place, "label": batch["label"]}).groupby("place", as_index=False).agg(
                n=("label", "size"), ones=("label", "sum"))

    bins = rows.mapInPandas(binned, "place int, n long, ones long").groupBy("place").agg(
        F.sum("n").alias("n"), F.sum("ones").alias("ones")).orderBy("place").toPandas()  # 3 * BINS + 1 rows at most
    knots, values = isotonic(bins["place"].to_numpy() / BINS, bins["n"].to_numpy(), bins["ones"].to_numpy())
    return Model(plain.centre, plain.scale, plain.directions, plain.phases, solved(None), knots, values)


def score(docs: DataFrame, model: Model, *, text: str = "text", into: str = "quality") -> DataFrame:
    """Add ``into``: a score from 0 to 1, higher for texts more like those labelled 1.

    Every row is scored from its whole text alone, a null one like an empty one; all rows and other columns stay.
    A column that is named ``into`` already is replaced.
    """
    @F.pandas_udf("double")
    def scores(texts: pd.Series) -> pd.Series:
        if not len(texts):
            return pd.Series([], dtype=float)
        return pd.Series(model.score(np.stack([statistics(t) for t in texts])))

    return docs.withColumn(into, scores(F.col(text)))
