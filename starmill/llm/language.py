"""Language of a text by error-correcting output codes over character n-grams.

Every language has a codeword.  For each bit, a binary classifier tells languages with a 1 there
from those with a 0: the mean log-odds of the text's letter trigrams (hashed), scaled by a
logistic fit.  Loss-weighted decoding takes the codeword with the least loss, every bit weighted by
its classifier's reliability; a text whose two nearest codewords lie close together is ambiguous.
"""

from __future__ import annotations

import itertools
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starmill.llm.common import add_columns, claim_memory, fresh, python_ready

GRAM_BUCKETS = 1 << 16
MAX_LANGUAGES = 1000
# Labelled rows, at most, on which the scales of the bit classifiers are fitted; the n-grams come from all.
CALIBRATION_ROWS = 20_000
# Two losses closer than this are ambiguous.
AMBIGUOUS = 0.5
UNKNOWN = "und"
_SLICE = 1 << 19
_SMOOTH = 0.5


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    return np.array([chr(c).isalpha() for c in range(0x110000)])


def grams(texts: list[str | None]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Blocks of (text number, gram bucket): a gram is a letter with its neighbours, case ignored, non-letters as blanks.

    A block has about _SLICE characters, whatever the length of the texts; a long text is in several.
    """
    claim_memory(grams)
    block: list[str] = []
    owner: list[int] = []
    held = 0

    def close() -> tuple[np.ndarray, np.ndarray]:
        codes = np.frombuffer("".join(block).encode("utf-32-le", "surrogatepass"), np.uint32)
        letter = _letters()[codes]
        codes = np.where(letter, codes, np.uint32(32))
        middle = letter[1:-1].copy()
        lengths = [len(b) for b in block]
        ends = np.cumsum(lengths)
        middle[np.concatenate([ends[:-1] - 2, ends[:-1] - 1])] = False  # the first and last of a slice are neighbours only
        at = np.flatnonzero(middle)
        h = (codes[at] * np.uint32(0x9E3779B1) + codes[at + 1]) * np.uint32(0x85EBCA6B) + codes[at + 2]
        h = (h * np.uint32(0xC2B2AE35)) >> np.uint32(16)
        return np.repeat(owner, lengths)[at + 1], h

    for i, text in enumerate(texts):
        if not text:
            continue
        padded = f" {text.lower()} "
        for a in range(0, len(padded) - 2, _SLICE):
            block.append(padded[a:a + _SLICE + 2])
            owner.append(i)
            held += len(block[-1])
            if held >= _SLICE:
                yield close()
                block, owner, held = [], [], 0
    if block:
        yield close()


def codewords(n: int, seed: int = 7) -> np.ndarray:
    """A row of +1 and -1 for each of ``n`` languages: all splits for few, else random ones far apart."""
    if n < 2:
        return np.ones((n, 0))
    if n <= 6:
        splits = [(1, *rest) for rest in itertools.product((1, -1), repeat=n - 1) if -1 in rest]
        return np.array(splits, float).T
    rng, best, apart = np.random.default_rng(seed), None, -1
    for _ in range(50):
        code = rng.choice([-1.0, 1.0], (n, int(np.ceil(10 * np.log2(n)))))
        code = code[:, np.abs(code.sum(axis=0)) < n]
        distance = code @ code.T
        np.fill_diagonal(distance, -np.inf)
        if -distance.max() > apart or best is None:
            best, apart = code, -distance.max()
    return best


@dataclass(frozen=True)
class Model:
    languages: list[str]
    code: np.ndarray  # languages x bits
    weights: np.ndarray  # gram buckets x bits
    slope: np.ndarray
    shift: np.ndarray
    trust: np.ndarray

    def margins(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Mean log-odds for each bit, and the number of grams, of each text."""
        bits = self.code.shape[1]
        total, n = np.zeros((len(texts), bits)), np.zeros(len(texts), np.int64)
        for who, gram in grams(texts):
            n += np.bincount(who, minlength=len(texts))
            if bits and len(who):
                starts = np.flatnonzero(np.diff(who, prepend=-1))
                total[who[starts]] += np.add.reduceat(self.weights[gram], starts, axis=0, dtype=np.float64)
        return total / np.maximum(n, 1)[:, None], n

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Language, score (0 to 1) and whether it is ambiguous, for each text."""
        return self.decide(*self.margins(texts))

    def decide(self, margin: np.ndarray, n: np.ndarray) -> tuple[list[str], np.ndarray, np.ndarray]:
        """``predict`` from the margins and numbers of grams."""
        if not self.languages:
            return [UNKNOWN] * len(n), np.zeros(len(n)), np.zeros(len(n), bool)
        signed = (self.slope * margin + self.shift)[:, None, :] * self.code[None]
        loss = (np.logaddexp(0, -signed) * self.trust).sum(axis=2)
        best = loss.argmin(axis=1)
        gaps = np.sort(loss, axis=1)
        near = (gaps[:, 1] - gaps[:, 0] < AMBIGUOUS) if len(self.languages) > 1 else np.zeros(len(n), bool)
        share = np.exp(-(loss - gaps[:, :1]))
        score = np.where(n > 0, 1 / share.sum(axis=1), 0.0)
        return [self.languages[b] if k else UNKNOWN for b, k in zip(best, n)], score, near & (n > 0)


def _logistic(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and shift of a logistic fit of y (+1, -1), classes weighted alike, with a small ridge."""
    w = np.where(y > 0, 0.5 / max(1, (y > 0).sum()), 0.5 / max(1, (y < 0).sum()))
    basis, beta = np.stack([x, np.ones_like(x)], axis=1), np.array([1.0, 0.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(np.clip(y * (basis @ beta), -30, 30)))
        grad = basis.T @ (w * y * p) - 1e-4 * beta
        hess = (basis * (w * p * (1 - p))[:, None]).T @ basis + 1e-4 * np.eye(2)
        beta = beta + np.linalg.solve(hess, grad)
    return max(float(beta[0]), 1e-3), float(beta[1])


def _gram_counts(rows: DataFrame) -> dict[str, np.ndarray]:
    """Counts of all grams of all rows by language: a row for each language and bucket at most."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, np.ndarray] = defaultdict(lambda: np.zeros(GRAM_BUCKETS, np.int64))
        for batch in batches:
            lang = batch.column(0).to_pylist()
            for who, gram in grams(batch.column(1).to_pylist()):
                starts = np.flatnonzero(np.diff(who, prepend=-1)).tolist()
                for a, z in zip(starts, [*starts[1:], len(who)]):
                    held[lang[who[a]]] += np.bincount(gram[a:z], minlength=GRAM_BUCKETS)
        for name, counts in held.items():
            at = np.flatnonzero(counts)
            yield pa.RecordBatch.from_arrays(
                [pa.array([name] * len(at)), pa.array(at, pa.int32()), pa.array(counts[at])], names=["lang", "gram", "n"])

    found = rows.mapInArrow(count, "lang string, gram int, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    out: dict[str, np.ndarray] = defaultdict(lambda: np.zeros(GRAM_BUCKETS))
    for part in found.toArrow().to_batches():
        lang = part.column("lang").to_pylist()
        for name, g, n in zip(lang, part.column("gram").to_pylist(), part.column("n").to_pylist()):
            out[name][g] = n
    return dict(out)


def fit(df: DataFrame, learn: Column, lang: str = "lang", text: str = "text") -> Model:
    """Learn from the rows of ``df`` for which ``learn`` holds and whose language is known."""
    spark = df.sparkSession
    python_ready(spark)
    rows = df.filter(learn & F.col(lang).isNotNull() & F.col(text).isNotNull()).select(F.col(lang).alias("lang"), F.col(text).alias("text"))
    sizes = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().limit(MAX_LANGUAGES + 1).collect()}
    if len(sizes) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    counts = _gram_counts(rows)
    languages = sorted(counts)
    code = codewords(len(languages))
    p = np.stack([counts[x] / counts[x].sum() for x in languages]) if languages else np.zeros((0, GRAM_BUCKETS))
    # Smoothed by half a gram of the smallest language's counts, so that unseen grams say little.
    least = _SMOOTH / min((counts[x].sum() for x in languages), default=1)
    weights = np.zeros((GRAM_BUCKETS, code.shape[1]), np.float32)
    for b in range(code.shape[1]):
        ones = code[:, b] > 0
        weights[:, b] = np.log(p[ones].mean(axis=0) + least) - np.log(p[~ones].mean(axis=0) + least)
    bits = code.shape[1]
    raw = Model(languages, code, weights, np.ones(bits), np.zeros(bits), np.ones(bits))
    if not bits:
        return raw
    # A sample whose size does not grow with the input, for each language alike.
    share = F.create_map(*[x for k, n in sizes.items() for x in
                           (F.lit(k), F.lit(min(1.0, CALIBRATION_ROWS / len(sizes) / n)))])[F.col("lang")]
    picked = F.pmod(F.xxhash64("text"), F.lit(1 << 20)) < share * (1 << 20)
    shared = spark.sparkContext.broadcast(raw)

    def margins(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            m, n = shared.value.margins(batch.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n), pa.array(list(m), pa.list_(pa.float64()))],
                                             names=["lang", "n", "m"])

    seen = (rows.filter(picked).dropDuplicates(["lang", "text"]).mapInArrow(margins, "lang string, n long, m array<double>")
            .filter("n > 0").limit(2 * CALIBRATION_ROWS).toPandas())
    if not len(seen):
        return raw
    y, x = code[[languages.index(k) for k in seen["lang"]]], np.stack(seen["m"])
    fits = [_logistic(x[:, b], y[:, b]) if len(set(y[:, b])) == 2 else (1.0, 0.0) for b in range(bits)]
    slope, shift = np.array([f[0] for f in fits]), np.array([f[1] for f in fits])
    wrong = ((slope * x + shift) * y <= 0).mean(axis=0)
    trust = np.clip(np.log((1 - wrong + 1e-3) / (wrong + 1e-3)), 0.1, None)
    return Model(languages, code, weights, slope, shift, trust / trust.mean())


def identify(df: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """All columns of ``df`` and ``lang_pred``, ``score`` (0 to 1), ``ambiguous``; columns so named are replaced.

    A text that is null, empty or has no letter is ``und`` with score 0.  With one learned language
    every other text is of it; with none, all are ``und``.
    """
    shared = df.sparkSession.sparkContext.broadcast(model)

    def add(texts: list[str | None]) -> dict[str, pa.Array]:
        lang, score, near = shared.value.predict(texts)
        return {"lang_pred": pa.array(lang, pa.string()), "score": pa.array(score), "ambiguous": pa.array(near)}

    new = {"lang_pred": "string", "score": "double", "ambiguous": "boolean"}
    return add_columns(df.drop(*new), new, add, text)


def fold(id_column: str, folds: int) -> Column:
    """Fold of a row: CRC-32 of the id as text; a null id has fold 0."""
    return F.coalesce(F.crc32(F.col(id_column).cast("string")) % folds, F.lit(0))


def without_unknown(df: DataFrame, model: Model, text: str = "text", lang: str = "lang") -> DataFrame:
    """The rows whose text has grams; texts without a letter go, whether or not a language was learned.

    A row whose ``lang`` is null gets the language that the model tells, or stays null if none was learned; else rows are as they are.
    """
    n, told = fresh(df, "_grams"), fresh(df, "_told")
    shared = df.sparkSession.sparkContext.broadcast(model)

    def add(texts: list[str | None]) -> dict[str, pa.Array]:
        margin, grams = shared.value.margins(texts)
        found = shared.value.decide(margin, grams)[0] if shared.value.languages else [None] * len(texts)
        return {n: pa.array(grams), told: pa.array(found, pa.string())}

    known = F.coalesce(F.col(lang), F.col(told)).alias(lang)
    columns = [known if c == lang else F.col(f"`{c}`") for c in df.columns]
    return add_columns(df, {n: "long", told: "string"}, add, text).filter(F.col(n) > 0).select(*columns)
