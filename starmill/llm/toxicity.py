"""Toxicity of texts through noisy-channel restoration.

1. A character model (interpolated 4-grams of 40 symbols) is counted over all documents.
2. Disguised words are restored: a token with look-alike symbols, inserted separators, spaced-out or
   doubled letters opens a lattice of readings, and Viterbi decoding takes the most likely one under the
   character model and the channel's costs.  Any other token has only one reading, itself.
3. Restored words are scored by their beginnings: how much more often labelled toxic texts have them,
   as a lower confidence bound.  A logistic model joins a text's highest word scores.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache
from os.path import commonprefix

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmill.llm.common import add_columns, all_columns, claim_memory, fresh, python_ready

# Symbols that stand in for letters.
LOOKALIKES = {
    "0": "o", "1": "il", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "€": "e",
}
SYMBOLS = 40  # 0: word boundary; 1 to 26: a to z; the rest: other letters, by code point
_OTHER = SYMBOLS - 27
BACKOFF = 5.0
# Costs of the channel, in nats.
COST_LOOKALIKE, COST_SEPARATOR, COST_SYMBOL = 1.5, 1.0, 2.0
COST_DOUBLED, COST_REPEAT = 2.1, 0.7  # to leave out a letter's first repetition, and each further one
# To read a look-alike mark at either end of a token as a mark: usual ones once, others each.
COST_MARK, COST_EDGE = 1.0, 4.0
USUAL_FIRST, USUAL_LAST = "@|+", "!|"
LATTICE_CHARS = 200  # after so many characters, what all readings have in common is put out

FEATURES = 1 << 20
PREFIXES = range(3, 9)
MIN_TEXTS = 3  # toxic texts that must have a beginning before it counts
Z = 1.0
TOP = 8
# Labelled rows, at most, on which the classifier is fitted.
MAX_TOXIC, MAX_CLEAN = 8_000, 16_000
FOLDS = 5
MAX_KNOWN, MAX_TOKEN = 1_000_000, 64  # tokens that a worker remembers, and their length
_SLICE = 1 << 20
_BEGINS, _WHOLE = zlib.crc32(b"^"), zlib.crc32(b"=")

_LETTERS = re.compile(r"[^\W\d_]+")
_TWICE = re.compile(r"([^\W\d_])\1", re.I)
_MARKS = re.escape("".join(c for c in LOOKALIKES if not c.isalnum()))
# From the first letter, digit or look-alike to the last one.
_CORE = re.compile(rf"(?:[^\W_]|[{_MARKS}])(?:.*(?:[^\W_]|[{_MARKS}]))?", re.S)
# Three single characters or more, with blanks or separators between them; not parts of words, nor after an apostrophe.
_GAP = re.compile(r"[\s.*_-]+")
_SPACED = re.compile(rf"(?<![^\W_])(?<![^\W_]['’])(?:[^\W_]|[{_MARKS}])[\s.*_-]++(?:[^\s.*_-][\s.*_-]++)+"
                     rf"(?:[^\W_]|[{_MARKS}])(?![^\W_]|['’][^\W_])")


def symbol(char: str) -> int:
    """Symbol of a lower-case character."""
    c = ord(char)
    return c - 96 if 97 <= c <= 122 else 27 + c % _OTHER if char.isalpha() else 0


@lru_cache(maxsize=1)
def _symbols() -> np.ndarray:
    """Symbol of every code point, upper case as lower case."""
    return np.array([symbol(chr(c).lower()[:1] or " ") for c in range(0x110000)], np.int32)


def count_grams(texts: list[str | None], counts: np.ndarray) -> None:
    """Add the 4-grams of all words; before a word, and after it, are boundaries."""
    joined = "\n".join(["   ", *[t for t in texts if t], ""])  # no word runs over two texts
    for a in range(3, len(joined), _SLICE):  # each with three characters of context
        codes = np.frombuffer(joined[a - 3:a + _SLICE].encode("utf-32-le", "surrogatepass"), np.uint32)
        s = _symbols()[codes]
        c, d = s[2:-1], s[3:]
        b = s[1:-2] * (c > 0)
        w = s[:-3] * (b > 0)
        at = (((w * SYMBOLS + b) * SYMBOLS + c) * SYMBOLS + d)[(d > 0) | (c > 0)]
        counts += np.bincount(at, minlength=len(counts))


def char_model(df: DataFrame, text: str = "text") -> np.ndarray:
    """Log-probability of each symbol after each three, from the words of all rows.

    A task sums up its own counts; what is gathered has a row for each 4-gram seen, 40^4 at most.
    """
    python_ready(df.sparkSession)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        claim_memory(count_grams)
        counts = np.zeros(SYMBOLS ** 4, np.int64)
        for batch in batches:
            count_grams(batch.column(0).to_pylist(), counts)
        at = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(counts[at])], names=["gram", "n"])

    rows = df.select(F.col(f"`{text}`").alias("text"))
    found = rows.mapInArrow(count, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n")).toArrow()
    counts = np.zeros(SYMBOLS ** 4)
    counts[found.column("gram").to_numpy()] = found.column("n").to_numpy()
    return log_probabilities(counts)


def log_probabilities(counts: np.ndarray) -> np.ndarray:
    p = np.full(SYMBOLS, 1 / SYMBOLS)
    for order in range(1, 5):
        n = counts.reshape(-1, SYMBOLS ** order).sum(axis=0).reshape(-1, SYMBOLS)
        p = np.tile(p.reshape(-1, SYMBOLS), (n.shape[0] // max(1, p.size // SYMBOLS), 1))
        p = (n + BACKOFF * p) / (n.sum(axis=1, keepdims=True) + BACKOFF)
    return np.log(p).astype(np.float32).ravel()


def decode(token: str, logp: np.ndarray) -> str:
    """The most likely reading of a token: lower-case words, separated by blanks."""
    size, cubed, token = SYMBOLS, SYMBOLS ** 3, token.lower()
    inner = [i for i, c in enumerate(token) if c.isalnum()]
    first, last = (inner[0], inner[-1]) if inner else (len(token), len(token))
    states: dict[int, tuple[float, str]] = {0: (0.0, "")}  # last three symbols: cost, output
    before, run, common = "", 0, []
    for i, char in enumerate(token):
        run = run + 1 if char == before else 0
        letters = [(char, 0.0)] if char.isalpha() else [(x, COST_LOOKALIKE) for x in LOOKALIKES.get(char, "")]
        edge = bool(letters) and not first <= i <= last
        usual = edge and char in (USUAL_FIRST if i < first else USUAL_LAST)
        new: dict[int, tuple[float, str]] = {}

        def offer(state: int, cost: float, out: str) -> None:
            if state not in new or cost < new[state][0]:
                new[state] = (cost, out)

        for state, (cost, out) in states.items():
            for letter, extra in letters:
                at = state * size + symbol(letter)
                offer(at % cubed, cost + extra - float(logp[at]), out + letter)
            if run and letters and (state or not edge):
                offer(state, cost + (COST_DOUBLED if run == 1 else COST_REPEAT), out)
            if not char.isalpha():
                end = -float(logp[state * size]) if state % size else 0.0
                if edge:  # a mark before or after the word
                    mark = COST_EDGE if not usual else COST_MARK if state or not i else 0.0
                else:
                    mark = 0.0 if char.isspace() else COST_SYMBOL
                    if not char.isalnum():
                        offer(state, cost + COST_SEPARATOR, out)  # put in between letters
                offer(0, cost + end + mark, f"{out} ")
        states, before = new, char
        if i % LATTICE_CHARS == LATTICE_CHARS - 1:
            common.append(commonprefix([out for _, out in states.values()]))
            states = {s: (cost, out[len(common[-1]):]) for s, (cost, out) in states.items()}
    ends = ((cost - (float(logp[s * size]) if s % size else 0.0), out) for s, (cost, out) in states.items())
    return "".join([*common, min(ends)[1]]).strip()


def decode_spaced(run: str, logp: np.ndarray) -> str:
    """The most likely reading of spaced-out letters; several blanks count as one."""
    return decode(_GAP.sub(lambda gap: gap.group().strip()[:1] or " ", run), logp)


def features(word: str) -> list[int]:
    """Buckets of a word's beginnings and of the word itself."""
    data, crc32 = word.encode(), zlib.crc32
    whole = crc32(data, _WHOLE) % FEATURES
    if len(data) != len(word):
        return [*[crc32(word[:k].encode(), _BEGINS) % FEATURES for k in PREFIXES if k <= len(word)], whole]
    if len(data) < PREFIXES[0]:
        return [whole]
    crc = crc32(data[:PREFIXES[0]], _BEGINS)  # a beginning's checksum goes on from that of the one before
    found = [crc % FEATURES]
    for k in range(PREFIXES[0], min(len(data), PREFIXES[-1])):
        crc = crc32(data[k:k + 1], crc)
        found.append(crc % FEATURES)
    found.append(whole)
    return found


@dataclass
class Reader:
    """Restored words of tokens and texts."""

    logp: np.ndarray

    def read(self, token: str) -> tuple[str, ...]:
        if token.isalpha():  # letters only: all of it is the core
            core = token
        else:
            found = _CORE.search(token)
            core = found.group() if found else ""
        if core.isalpha() and not _TWICE.search(core):
            return (core.lower(),)
        if not any(c.isalpha() for c in core):
            return ()
        return tuple(_LETTERS.findall(decode(core, self.logp)))

    def runs(self, text: str) -> list[str]:
        """Words that were spaced out."""
        return [w for run in _SPACED.finditer(text) for w in _LETTERS.findall(decode_spaced(run.group(), self.logp))]

    def restored(self, text: str | None) -> str:
        """The text with every token as restored; runs of spaced letters first."""
        text = _SPACED.sub(lambda m: decode_spaced(m.group(), self.logp), text or "")
        return " ".join(" ".join(self.read(t)) for t in text.split())


@dataclass
class Model:
    reader: Reader
    weights: dict[int, float]  # score of the feature buckets that have one
    beta: np.ndarray
    known: dict[str, tuple[tuple[float, str], ...]] = field(default_factory=dict)

    def __getstate__(self):
        return {"reader": self.reader, "weights": self.weights, "beta": self.beta, "known": {}}

    def marked(self, words: tuple[str, ...] | list[str]) -> tuple[tuple[float, str], ...]:
        """Words with a score above 0."""
        weights, found = self.weights, []
        for w in words:
            if scores := [weights[f] for f in features(w) if f in weights]:
                found.append((max(scores), w))
        return tuple(found)

    def evidence(self, text: str | None) -> list[float]:
        """The highest scores of a text's distinct words, summed up, and its length in distinct tokens."""
        tokens, known = set((text or "").split()), self.known
        if len(known) >= MAX_KNOWN:  # between two texts, so that none of its tokens is lost
            known.clear()
        found = set(self.marked(self.reader.runs(text or "")))
        for token in tokens.difference(known):
            new = self.marked(self.reader.read(token))
            found.update(new)
            if len(token) <= MAX_TOKEN:
                known[token] = new
        for marked in filter(None, map(known.get, tokens)):
            found.update(marked)
        top = sorted((score for score, _ in found), reverse=True)[:TOP]
        top += [0.0] * (TOP - len(top))
        return [top[0], top[1], top[2], sum(top), max(0.0, top[0] - 4.0), float(np.log1p(len(tokens))), 1.0]

    def score(self, texts: list[str | None]) -> np.ndarray:
        claim_memory(self, self.known.clear)
        x = np.array([self.evidence(t) for t in texts]).reshape(len(texts), -1)
        return 1 / (1 + np.exp(-np.clip(x @ self.beta, -30, 30)))


def _logistic(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    beta = np.zeros(x.shape[1])
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        hess = (x * (p * (1 - p))[:, None]).T @ x + 1e-2 * np.eye(len(beta))
        beta = beta + np.linalg.solve(hess, x.T @ (y - p) - 1e-2 * beta)
    return beta


def labelled_sample(df: DataFrame, labels: DataFrame, id_column: str, text: str, label: str) -> DataFrame:
    """``text``, ``toxic``, ``calibrate`` of learning rows, at most about MAX_TOXIC and MAX_CLEAN of them.

    Learning rows are those whose CRC-32 of the id (as text) is no multiple of FOLDS.  Of several labels of
    an id the higher counts; missing ones don't.  Of equal texts with equal labels one is taken.
    """
    crc = F.crc32(F.col("id").cast("string"))
    known = (labels.select(F.col(f"`{id_column}`").alias("id"), F.col(f"`{label}`").cast("int").alias("toxic"))
             .filter("toxic is not null and id is not null").filter(crc % FOLDS != 0)
             .groupBy("id").agg((F.max("toxic") > 0).cast("int").alias("toxic")))
    sizes = {r["toxic"]: r["count"] for r in known.groupBy("toxic").count().collect()}
    share = F.when(F.col("toxic") == 1, F.lit(MAX_TOXIC / max(1, sizes.get(1, 0)))).otherwise(
        F.lit(MAX_CLEAN / max(1, sizes.get(0, 0))))
    picked = known.filter(F.pmod(F.xxhash64("id", F.lit(11)), F.lit(1 << 20)) < share * (1 << 20))
    picked = picked.withColumn("calibrate", F.floor(crc / FOLDS) % 4 == 0)
    rows = df.select(F.col(f"`{id_column}`").alias("id"), F.col(f"`{text}`").alias("text"))
    # The sample's size is bounded above, whatever the size of the tables.
    return rows.join(F.broadcast(picked), "id").drop("id").dropDuplicates(["text", "toxic"])


def fit(df: DataFrame, labels: DataFrame, id_column: str = "doc_id", text: str = "text", label: str = "toxic") -> Model:
    """Character model of all rows of ``df``, and the classifier from the labelled learning rows among them.

    Three quarters of the sample give the word scores, the rest the logistic model over them.
    Without toxic or without clean examples every text scores the share of toxic ones (0 if there are none).
    """
    spark = df.sparkSession
    reader = Reader(char_model(df, text))
    sample = labelled_sample(df, labels, id_column, text, label)
    shared = spark.sparkContext.broadcast(reader)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, texts, known = np.zeros((2, FEATURES), np.int32), [0, 0], {}
        claim_memory(known, known.clear)
        for batch in batches:
            for t, toxic, calibrate in zip(*(batch.column(i).to_pylist() for i in range(3))):
                if calibrate:
                    continue
                texts[toxic] += 1
                found = {f for w in shared.value.runs(t or "") for f in features(w)}
                if len(known) >= MAX_KNOWN // 4:  # an entry has some ten numbers
                    known.clear()
                for token in set((t or "").split()):
                    new = known.get(token)
                    if new is None:
                        new = tuple({f for w in shared.value.read(token) for f in features(w)})
                        if len(token) <= MAX_TOKEN:
                            known[token] = new
                    found.update(new)
                counts[toxic, list(found)] += 1
        at = np.flatnonzero(counts.any(axis=0))
        yield pa.RecordBatch.from_arrays(
            [pa.array([*at, FEATURES], pa.int64()), pa.array([*counts[0, at], texts[0]], pa.int64()),
             pa.array([*counts[1, at], texts[1]], pa.int64())], names=["f", "clean", "toxic"])

    found = sample.mapInArrow(count, "f long, clean long, toxic long").groupBy("f").agg(
        F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic")).toArrow()  # a row for each bucket at most
    clean, toxic = np.zeros(FEATURES + 1), np.zeros(FEATURES + 1)
    clean[found.column("f").to_numpy()] = found.column("clean").to_numpy()
    toxic[found.column("f").to_numpy()] = found.column("toxic").to_numpy()
    ratio = np.log((toxic + 0.5) / (toxic[-1] + 1)) - np.log((clean + 0.5) / (clean[-1] + 1))
    bound = ratio - Z * np.sqrt(1 / (toxic + 0.5) + 1 / (clean + 0.5))
    strong = np.flatnonzero((toxic[:-1] >= MIN_TEXTS) & (bound[:-1] > 0)).tolist()
    model = Model(reader, {f: float(bound[f]) for f in strong}, np.zeros(7))
    sharing = spark.sparkContext.broadcast(model)

    def calibrate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            claim_memory(sharing.value, sharing.value.known.clear)
            x = [sharing.value.evidence(t) for t in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.list_(pa.float64())), batch.column(1)], names=["x", "toxic"])

    seen = sample.filter("calibrate").mapInArrow(calibrate, "x array<double>, toxic int").toPandas()
    if seen["toxic"].nunique() == 2:
        model.beta = _logistic(np.stack(seen["x"]), seen["toxic"].to_numpy(float))
    else:
        known = toxic[-1] + clean[-1]
        share = min(0.99, max(1e-6, toxic[-1] / known)) if known else 1e-6
        model.beta[-1] = np.log(share / (1 - share))
    return model


def with_score(df: DataFrame, model: Model, score: str = "score", text: str = "text") -> DataFrame:
    """All columns of ``df`` and the score, 0 to 1; a null text counts as empty.  A column of that name is replaced."""
    shared = df.sparkSession.sparkContext.broadcast(model)

    def add(texts: list[str | None]) -> dict[str, pa.Array]:
        return {score: pa.array(shared.value.score(texts))}

    return add_columns(df.drop(score), {score: "double"}, add, text)


def without_toxic(df: DataFrame, model: Model, text: str = "text", limit: float = 0.5) -> DataFrame:
    """The rows that score below ``limit``, as they are."""
    score = fresh(df, "_score")
    return with_score(df, model, score, text).filter(F.col(score) < limit).select(*all_columns(df))
