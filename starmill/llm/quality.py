"""Quality of texts, learned from trusted positives and unlabelled texts (positive-unlabelled learning).

No negative example is used.  With the class prior p (the share of good texts), the risk of a linear score g under
the logistic loss l is p E+[l(g)] + max(0, Eu[l(-g)] - p E+[l(-g)]): means over the trusted positives (E+) and over
all texts (Eu).  The second part estimates the risk on the bad texts; it cannot be negative, so it is cut
off at 0, which is where an unbiased estimate would go on to overfit.  The prior is estimated by the best
bin: where a classifier of positives against all texts is sure, all texts are as often there as the
prior times the positives, so the least upper bound of that ratio over all cuts gives the prior.

A text is described by the shapes of its characters and by how its words and lines repeat.  All sums over
texts are Spark aggregations; the driver sees one number for each pair of features at most.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starmill.llm.common import add_columns, claim_memory, fresh, python_ready, stored

# Shapes of characters: other, lower, upper, digit, blank, line end, the marks of sentences, marks within them, ASCII symbols, letters without case.
SHAPES = 11
SENTENCE, BANG, INNER = ".,;:?…", "!", "'\"’“”«»()[]-–—"
WORD_FEATURES = 9
SIZE = SHAPES * SHAPES + WORD_FEATURES + 1  # and a constant
RIDGE = 1e-3
MAX_STEPS, CLOSE = 40, 1e-7
BINS = 4096
# Of the best bin's bound: how sure, and how much the bound counts.
DELTA, GAMMA = 0.1, 0.01
MAX_PRIOR = 0.999
_SLICE = 1 << 19
_FLOAT = np.dtype("<f4")


@lru_cache(maxsize=1)
def _shapes() -> np.ndarray:
    """Shape of every code point."""
    def shape(c: str) -> int:
        if c.isalpha():
            return 1 if c.islower() else 2 if c.isupper() else 9
        if c.isdigit():
            return 3
        if c.isspace():
            return 5 if c in "\n\r" else 4
        for number, marks in ((6, SENTENCE), (7, INNER), (10, BANG)):
            if c in marks:
                return number
        return 8 if c.isascii() and c.isprintable() else 0

    return np.array([shape(chr(c)) for c in range(0x110000)], np.uint8)


def _shape_pairs(texts: list[str]) -> np.ndarray:
    """Counts of pairs of neighbouring shapes, a row for each text; long texts are read in slices."""
    out = np.zeros((len(texts), SHAPES * SHAPES))
    block: list[str] = []
    owner: list[int] = []

    def close() -> None:
        codes = np.frombuffer("".join(block).encode("utf-32-le", "surrogatepass"), np.uint32)
        shape = _shapes()[codes].astype(np.int64)
        lengths = np.array([len(b) for b in block])
        pair = shape[:-1] * SHAPES + shape[1:]
        row = np.repeat(np.array(owner), lengths)[:-1]
        keep = np.ones(len(pair), bool)
        keep[np.cumsum(lengths)[:-1] - 1] = False  # no pair reaches over two texts
        at = np.bincount(row[keep] * SHAPES * SHAPES + pair[keep], minlength=out.size)
        out.ravel()[:] += at

    held = 0
    for i, t in enumerate(texts):
        for a in range(0, max(1, len(t) - 1), _SLICE):
            piece = t[a:a + _SLICE + 1]
            if piece:
                block.append(piece), owner.append(i)
                held += len(piece)
            if held >= _SLICE:
                close()
                block, owner, held = [], [], 0
    if block:
        close()
    return out


def _repeats(text: str) -> list[float]:
    words, lines = text.split(), [x for x in text.splitlines() if x.strip()]
    n = max(1, len(words))
    counts = Counter(words)
    most = max(counts.values(), default=0)
    doubled = sum(a == b for a, b in zip(words, words[1:]))
    letters = sum(map(len, words))
    return [float(not words), np.log1p(len(words)) / 8, len(counts) / n, len(counts) / n ** 0.5 / 8, most / n, doubled / n,
            letters / n / 10, len(set(lines)) / max(1, len(lines)), np.log1p(letters / max(1, len(lines))) / 8]


def describe(texts: list[str | None]) -> np.ndarray:
    """A row of SIZE numbers for each text; a null text is an empty one."""
    plain = [t or "" for t in texts]
    if not plain:
        return np.zeros((0, SIZE))
    pairs = _shape_pairs(plain)
    rates = np.sqrt(pairs / np.maximum(1, pairs.sum(axis=1, keepdims=True)))
    words = np.array([_repeats(t) for t in plain])
    return np.concatenate([rates, words, np.ones((len(plain), 1))], axis=1)


def with_features(df: DataFrame, name: str, text: str = "text") -> DataFrame:
    """All columns of ``df`` and the text's description, SIZE floats as binary; a column of that name is replaced."""
    def add(texts: list[str | None]) -> dict[str, pa.Array]:
        claim_memory(describe)
        return {name: pa.array([x.tobytes() for x in describe(texts).astype(_FLOAT)], pa.binary())}

    return add_columns(df.drop(name), {name: "binary"}, add, text)


def _matrix(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), _FLOAT).reshape(-1, SIZE).astype(np.float64)


def _sums(rows: DataFrame, of: str, value) -> np.ndarray:
    """The sum over all batches of what ``value(x, positive)`` gives, an array of always the same length.

    Each task sums up its own; what is gathered has one row for each number.
    """
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        claim_memory(describe)
        total = 0
        for batch in batches:
            total = total + value(_matrix(batch.column(0)), np.array(batch.column(1).to_pylist(), float))
        if np.ndim(total):
            at = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["k", "v"])

    found = rows.select(of, "positive").mapInArrow(add, "k long, v double").groupBy("k").agg(F.sum("v").alias("v")).toArrow()
    out = np.zeros(len(value(np.zeros((0, SIZE)), np.zeros(0))))
    out[found.column("k").to_numpy()] = found.column("v").to_numpy()
    return out


def _softplus(g: np.ndarray) -> np.ndarray:
    return np.logaddexp(0, g)


def _sigmoid(g: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(g, -40, 40)))


@dataclass(frozen=True)
class Scale:
    """Means and deviations of the features over all texts; numbers of texts and of positives."""

    mean: np.ndarray
    spread: np.ndarray
    texts: float
    positives: float

    def apply(self, x: np.ndarray) -> np.ndarray:
        return np.clip((x - self.mean) / self.spread, -8, 8)


def _scale(rows: DataFrame, of: str) -> Scale:
    found = _sums(rows, of, lambda x, y: np.concatenate([[len(x), y.sum()], x.sum(axis=0), (x * x).sum(axis=0)]))
    n = max(1.0, found[0])
    mean, square = found[2:2 + SIZE] / n, found[2 + SIZE:] / n
    spread = np.sqrt(np.maximum(square - mean ** 2, 0))
    known = spread > 1e-4
    known[-1] = False
    # The constant stays 1, and what never varies says nothing.
    return Scale(np.where(known, mean, np.where(np.arange(SIZE) == SIZE - 1, 0, mean)), np.where(known, spread, 1.0), found[0], found[1])


def _passes(rows: DataFrame, of: str, scale: Scale, beta: np.ndarray) -> dict[str, np.ndarray]:
    """All sums that a step needs, in one pass: over all texts (u) and over the positives (p)."""
    upper = np.triu_indices(SIZE)

    def value(x: np.ndarray, y: np.ndarray) -> np.ndarray:
        x = scale.apply(x)
        g = x @ beta
        s = _sigmoid(g)
        curve = (x * (s * (1 - s))[:, None]).T @ x
        return np.concatenate([[_softplus(g).sum(), (_softplus(-g) * y).sum(), (_softplus(g) * y).sum()],
                               x.T @ s, x.T @ (s * y), x.T @ y, curve[upper]])

    found = _sums(rows, of, value)
    parts = np.split(found, np.cumsum([3, SIZE, SIZE, SIZE]))
    curve = np.zeros((SIZE, SIZE))
    curve[upper] = parts[4]
    u, p = max(1.0, scale.texts), max(1.0, scale.positives)
    return {"u_bad": parts[0][0] / u, "p_good": parts[0][1] / p, "p_bad": parts[0][2] / p, "u_slope": parts[1] / u,
            "p_slope": parts[2] / p, "p_mean": parts[3] / p, "curve": (curve + np.triu(curve, 1).T) / u}


def risk(sums: dict, prior: float, beta: np.ndarray) -> float:
    """The non-negative risk, with the ridge."""
    return prior * sums["p_good"] + max(0.0, sums["u_bad"] - prior * sums["p_bad"]) + RIDGE / 2 * float(beta[:-1] @ beta[:-1])


def minimise(passes, prior: float) -> np.ndarray:
    """Weights of least non-negative risk; ``passes(beta)`` gives the sums over the data.

    While the estimated risk on bad texts is positive, the risk is convex and Newton's steps go down it; where it
    would be negative, only the risk on the positives counts.  A step is halved until the risk falls.
    """
    ridge = RIDGE * np.append(np.ones(SIZE - 1), 1e-3)
    beta = np.zeros(SIZE)
    sums = passes(beta)
    for _ in range(MAX_STEPS):
        slope = prior * (sums["p_slope"] - sums["p_mean"])  # of the positives' risk
        if sums["u_bad"] > prior * sums["p_bad"]:
            slope = slope + sums["u_slope"] - prior * sums["p_slope"]
        step = -np.linalg.solve(sums["curve"] + np.diag(ridge), slope + ridge * beta)
        before, share = risk(sums, prior, beta), 1.0
        while True:
            trial = beta + share * step
            after = passes(trial)
            if risk(after, prior, trial) < before:
                break
            share /= 4
            if share < 1e-3:
                return beta
        beta, sums = trial, after
        if before - risk(sums, prior, beta) < CLOSE:
            break
    return beta


def best_bin(positives: np.ndarray, texts: np.ndarray) -> float:
    """The class prior from histograms of a classifier's scores, ascending: of positives and of all texts."""
    p, u = positives[::-1].cumsum(), texts[::-1].cumsum()
    if not p[-1] or not u[-1]:
        return 0.0
    slack = np.sqrt(np.log(4 / DELTA) / 2) * (u[-1] ** -0.5 + p[-1] ** -0.5)
    share = np.maximum(p / p[-1], 1e-9)
    at = np.argmin((u / u[-1] + (1 + GAMMA) * slack) / share)
    return float(min(MAX_PRIOR, u[at] / u[-1] / share[at]))


@dataclass(frozen=True)
class Model:
    scale: Scale
    beta: np.ndarray
    prior: float

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probability of a good text for rows of ``describe``."""
        return _sigmoid(self.scale.apply(x) @ self.beta) if self.prior else np.zeros(len(x))


def _histograms(rows: DataFrame, of: str, scale: Scale, beta: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    def value(x: np.ndarray, y: np.ndarray) -> np.ndarray:
        at = np.minimum(BINS - 1, (_sigmoid(scale.apply(x) @ beta) * BINS).astype(int))
        return np.concatenate([np.bincount(at, y, BINS), np.bincount(at, minlength=BINS)])

    both = _sums(rows, of, value)
    return both[:BINS], both[BINS:]


def fit(rows: DataFrame, features: str, positive: Column) -> Model:
    """Learn from ``rows`` with ``features``: those for which ``positive`` holds are trusted, all rows are unlabelled texts.

    First positives are told from all texts as if half of them were good, which gives a first prior; with
    it, and again with the prior that the fitted scores give, the non-negative risk is minimised.  All passes read the
    features, not the texts.  Without positives the prior is 0, and so is every score.
    """
    python_ready(rows.sparkSession)
    rows = stored(rows.select(features, F.coalesce(positive, F.lit(False)).cast("int").alias("positive")), "quality-rows")
    scale = _scale(rows, features)
    if not scale.positives:
        return Model(scale, np.zeros(SIZE), 0.0)

    def passes(beta: np.ndarray) -> dict:
        return _passes(rows, features, scale, beta)

    prior, beta = 0.5, np.zeros(SIZE)
    for _ in range(3):
        beta = minimise(passes, prior)
        found = best_bin(*_histograms(rows, features, scale, beta))
        if abs(found - prior) < 0.005:
            break
        prior = found
    return Model(scale, beta, prior)


def trusted(labels: DataFrame, id_column: str = "doc_id", label: str = "quality") -> DataFrame:
    """``id_column``, ``good``: ids all of whose labels say 1, each once; missing ids and labels say nothing."""
    known = labels.select(F.col(f"`{id_column}`"), F.col(f"`{label}`").cast("int").alias("good"))
    known = known.filter(F.col(f"`{id_column}`").isNotNull() & F.col("good").isNotNull())
    return known.groupBy(f"`{id_column}`").agg((F.min("good") == 1).alias("good")).filter("good")


def learning(id_column: str, folds: int = 4, held: int = 2) -> Column:
    """Whether a row's label may be learned from: CRC-32 of the id (as text) leaves another rest than ``held``."""
    return F.coalesce(F.crc32(F.col(f"`{id_column}`").cast("string")) % folds != held, F.lit(True))


def with_score(df: DataFrame, labels: DataFrame, score: str = "score", id_column: str = "doc_id", text: str = "text",
               label: str = "quality") -> tuple[DataFrame, Model]:
    """All columns of ``df`` but the text, and the score (0 to 1, higher: better); and the fitted model.

    Texts are read once and described; the description is stored and serves the passes and the scores.  A text's
    score depends on its description alone: equal texts have equal scores, null and empty ones that of an empty text.
    Labels of rows that ``learning`` leaves out are not used.  Rows without an id are unlabelled.
    An empty table gives an empty result; a column named like the score is replaced.
    """
    keep = [c for c in df.columns if c.lower() not in (text.lower(), score.lower())]
    x, n = fresh(df, "_features"), fresh(df, "_good")
    made = stored(with_features(df.select(*[F.col(f"`{c}`") for c in keep], F.col(f"`{text}`")), x, text).drop(text), "quality")
    known = trusted(labels, id_column, label).withColumnRenamed("good", n)
    model = fit(made.join(known.filter(learning(id_column)), id_column, "left"), x, F.col(n))
    shared = df.sparkSession.sparkContext.broadcast(model)
    names, plain = [*keep, x], [f"c{i}" for i in range(len(keep) + 1)]

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = pa.array(shared.value.score(_matrix(batch.column(len(keep)))))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], values], names=[*plain[:-1], "s"])

    rows = made.select(*[F.col(f"`{c}`").alias(p) for c, p in zip(names, plain)])
    kinds = ", ".join([f"{p} {made.schema[c].dataType.simpleString()}" for c, p in zip(keep, plain)] + ["s double"])
    return rows.mapInArrow(add, kinds).toDF(*keep, score), model
