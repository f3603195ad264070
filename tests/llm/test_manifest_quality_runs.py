"""Merkle manifest, quality scores and periodic runs against brute force, on odd tables and on the driver's."""

import hashlib
import os
import random
import zlib

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from starmill.llm import merkle, periodic_runs, quality
from starmill.llm.queries import QUERIES

SMALL, LARGER = "/root/testdata/sf0.001", "/root/testdata/sf0.01"
needs_tables = pytest.mark.skipif(not os.path.isdir(SMALL), reason="driver tables are not here")


def digest(*parts: str) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def field(value) -> str:
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def climb(nodes: list[str], at: int, shown: str) -> tuple[str, list[str], str]:
    """Top of a tree, siblings of a leaf on the way up, and the top with ``shown`` in the leaf's place."""
    proof = []
    while len(nodes) > 1:
        run = nodes[at - at % 3:at - at % 3 + 3]
        others = run[:at % 3] + run[at % 3 + 1:]
        proof += others
        shown = digest(*run[:at % 3], shown, *run[at % 3 + 1:])
        nodes, at = [digest(*nodes[i:i + 3]) for i in range(0, len(nodes), 3)], at // 3
    return nodes[0], proof, shown


def slow_manifest(rows: list[tuple]) -> list[tuple]:
    """(group, id, leaf, shown) -> (id, leaf, shown, subroot, root, proof, folded, verified)."""
    groups = {}
    for r in sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2], r[3])):
        groups.setdefault(r[0], []).append(r)
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    subroots = [climb([r[2] for r in groups[g]], 0, "")[0] for g in names]
    out = []
    for number, name in enumerate(names):
        leaves = [r[2] for r in groups[name]]
        for at, (_, i, leaf, shown) in enumerate(groups[name]):
            subroot, low, folded = climb(leaves, at, shown)
            root, high, folded = climb(subroots, number, folded)
            out.append((i, leaf, shown, subroot, root, digest(*low, *high), folded, folded == root))
    return out


@pytest.mark.parametrize("block_levels", [2, 8])
def test_manifest(spark, block_levels):
    """Groups of one to hundreds of rows, null and odd group names, missing and repeated ids, equal rows, clashing columns."""
    rng = random.Random(4)
    names = [None, "", "=", "a", "é", "\U0001f642", "b" * 50, *[f"s{i}" for i in range(12)]]
    rows = []
    for name, n in zip(names, [5, 1, 2, 3, 9, 10, 1, *range(11, 23)]):
        rows += [(name, i if i % 7 else None, digest(str(rng.random()))) for i in range(n)]
    rows += [("hot", i // 2, digest(str(i // 6))) for i in range(300)]  # ties, and rows equal in all
    rows = [(g, i, leaf, leaf if int(leaf, 16) % 2 else digest(leaf)) for g, i, leaf in rows]
    rows = [*rows, rows[-1], rows[-1]]
    df = spark.createDataFrame(rows, "grp string, id long, leaf string, shown string").repartition(3)
    for c in ("g", "item", "digest", "c0", "tie", "part", "block", "first", "Root", "verified", "a.b"):
        df = df.withColumn(c, F.lit(7))
    found = merkle.build(df, "grp", ["id"], "leaf", block_levels).verify("shown")
    assert {"g", "item", "a.b", "first"} <= set(found.columns) and found.columns.count("verified") == 1
    columns = ["id", "leaf", "shown", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    assert sorted(map(tuple, found.select(columns).collect()), key=repr) == sorted(slow_manifest(rows), key=repr)
    assert merkle.build(df.filter("false"), "grp", ["id"], "leaf", block_levels).verify("shown").count() == 0
    lone = merkle.build(df.filter("grp = ''"), "grp", ["id"], "leaf", block_levels).verify("leaf").first()
    assert lone["root"] == lone["subroot"] == lone["leaf"] and lone["proof_sha256"] == digest() and lone["verified"]


def test_midstates_are_those_of_sha256():
    """A node is what hashlib says; a kept state resumes at its slot without what lies to the left."""
    rng = random.Random(1)
    for n in (1, 2, 3, 4, 9, 10, 28, 82):
        leaves, new = ([digest(str(rng.random())) for _ in range(n)] for _ in range(2))
        raw, fresh = (np.frombuffer(bytes.fromhex("".join(x)), np.uint8).reshape(-1, 32) for x in (leaves, new))
        built = merkle.Tree.over(raw)
        tree = merkle.Tree.read(n, built.nodes(), built.kept())
        folded = tree.fold(np.arange(n), fresh)
        for i in range(n):
            top, proof, want = climb(leaves, i, new[i])
            assert bytes(tree.levels[-1][0]).hex() == top and bytes(folded[i]).hex() == want
            assert tree.siblings(np.array([i]))[0].hex() == "".join(proof)
            assert bytes(merkle._resume(fresh[i:i + 1], tree.steps(i))[0]).hex() == want


def test_leaf_of_odd_values(spark):
    rows = [(1, None, "é\n", None), (None, "", "", 5), (2, "x" * 70_000, "漢", -1)]
    df = spark.createDataFrame(rows, "a long, b string, c string, d int")
    got = [r[0] for r in df.select(merkle.leaf(*[F.col(c) for c in df.columns])).collect()]
    assert got == [digest(*map(field, r)) for r in rows]


def slow_runs(words: list[str]) -> list[tuple[int, int, int]]:
    out = []
    for q in range(1, len(words) // 4 + 1):
        i = q
        while i < len(words):
            begin = i
            while i < len(words) and words[i] == words[i - q]:
                i += 1
            run = words[begin - q:i]
            if len(run) >= max(6, 4 * q) and not any(run[p:] == run[:-p] for p in range(1, q)):
                out.append((begin - q, len(run), q))
            i += 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def slow_rest(words: list[str], runs: list[tuple[int, int, int]]) -> str:
    dropped = {i for s, n, q in runs for i in range(s + q, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in dropped)


def periodic_texts(n: int) -> list[list[str]]:
    """Random words of few kinds, blocks with partial repetitions, Fibonacci words, near repetitions."""
    rng, out = random.Random(2), []
    for k in range(n):
        if k % 5 == 0:
            words = [rng.choice("ab") for _ in range(rng.randint(0, 70))]
        elif k % 5 == 1:
            words = []
            for _ in range(rng.randint(1, 5)):
                unit = [rng.choice("abc") for _ in range(rng.randint(1, 9))]
                words += unit * rng.randint(1, 7) + unit[:rng.randint(0, len(unit))]
        elif k % 5 == 2:
            a, b = "a", "ab"
            for _ in range(rng.randint(1, 9)):
                a, b = b, b + a
            words = list(b[rng.randint(0, 5):130])
        elif k % 5 == 3:
            words = ["a"] * rng.randint(0, 40) + [rng.choice("ab")] + ["a"] * rng.randint(0, 40)
        else:
            words = [str(rng.randint(0, 50)) for _ in range(rng.randint(1, 40))] * rng.randint(3, 6)
            for _ in range(rng.randint(0, 2)):
                words[rng.randrange(len(words))] = "z"
        out.append(words)
    return out


def test_runs_of_words():
    texts = periodic_texts(1500)
    found = list(periodic_runs.runs_of([[w.encode() for w in t] for t in texts]))
    assert len(found) == len(texts) and sum(map(len, found)) > 800
    for words, runs in zip(texts, found):
        assert list(map(tuple, runs.tolist())) == slow_runs(words)


def test_frequent_words_cost_no_square():
    """A million equal words, and a million of two kinds: seconds, where pairs of occurrences would be 10 ** 11."""
    rng = random.Random(3)
    assert [tuple(r) for r in next(periodic_runs.runs_of([[b"a"] * 1_000_000])).tolist()] == [(0, 1_000_000, 1)]
    words = [rng.choice([b"a", b"b"]) for _ in range(300_000)] + [b"x", b"y", b"z"] * 1000
    found = next(periodic_runs.runs_of([words])).tolist()
    assert [300_000, 3000, 3] in found and len(found) > 1000


def test_runs_on_odd_rows(spark):
    said = [None, "", " \n\t", "a", "a a a a a", "a a a a a a", "x a\x0ba a\ta  a\na y", "no\xa0break no\xa0break " * 4, "\x1c \x1c " * 4,
            "é ö " * 30_000, "one two three " * 5 + "one", "w" * 50_000]
    rows = [(i, t) for i, t in enumerate(said + said[4:7])] + [(None, "b b b b b b b")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("runs", F.lit(1)).withColumn("n0", F.lit(2))
    got = periodic_runs.with_runs(df).collect()
    want = []
    for i, t in rows:
        words = [w.decode() for w in (t or "").encode().split()]
        runs = slow_runs(words) if len(words) < 1000 else [(0, len(words), 2)]
        want.append((i, runs, slow_rest(words, runs)))
    assert sorted([(r["doc_id"], [tuple(x) for x in r["runs"]], r["collapsed"]) for r in got], key=repr) == sorted(want, key=repr)
    assert periodic_runs.with_runs(df.filter("false")).count() == 0


@needs_tables
def test_runs_query(spark, tmp_path):
    docs = pd.read_parquet(f"{SMALL}/documents.parquet")
    more = pd.DataFrame({"doc_id": range(10_000, 10_300), "text": [None, "", "p q " * 5] * 100})
    both = pd.concat([docs, more], ignore_index=True)
    both.to_parquet(f"{tmp_path}/documents.parquet")
    found = {r["doc_id"]: r for r in QUERIES["op13_periodic_runs"](spark, str(tmp_path)).collect()}
    assert len(found) == len(both)
    planted = 0
    for doc_id, text in zip(both["doc_id"], both["text"]):
        words = [w.decode() for w in (text or "").encode().split()]
        h, n = zlib.crc32(str(doc_id).encode()), len(words)
        if h % 10 == 0 and n:
            g, planted = h // 10, planted + 1
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = words[:a] + [words[a + (i - a) % p] for i in range(a, n)]
        if n > 3000 and h % 10:
            continue  # the slow way takes the square of the words
        runs, r = slow_runs(words), found[doc_id]
        best = min(runs, key=lambda x: (-x[1], x[0], x[2]), default=(None, None, None))
        assert (r["n_runs"], r["start"], r["length"], r["period"]) == (len(runs), *best)
        assert r["exponent_milli"] == (1000 * best[1] // best[2] if runs else None)
        assert r["runs_sha256"] == digest("".join(f"{s},{m},{q}\n" for s, m, q in runs))
        assert r["collapsed_sha256"] == digest(slow_rest(words, runs))
    assert planted > 20


def slow_description(text: str) -> np.ndarray:
    table, counts = quality._shapes(), np.zeros((quality.SHAPES, quality.SHAPES))
    for a, b in zip(text, text[1:]):
        counts[table[ord(a)], table[ord(b)]] += 1
    words, lines = text.split(), [x for x in text.splitlines() if x.strip()]
    n, letters = max(1, len(words)), sum(map(len, words))
    most = max((words.count(w) for w in set(words)), default=0)
    return np.array([*np.sqrt(counts / max(1, counts.sum())).ravel(), not words, np.log1p(len(words)) / 8, len(set(words)) / n,
                     len(set(words)) / n ** 0.5 / 8, most / n, sum(a == b for a, b in zip(words, words[1:])) / n, letters / n / 10,
                     len(set(lines)) / max(1, len(lines)), np.log1p(letters / max(1, len(lines))) / 8, 1])


def test_descriptions(monkeypatch):
    texts = ["", "a", "Hello, world!\n\nTwo two lines 12", "$$$ ### é漢字 “q”", None, "x" * 3000, "ab cd\n" * 500]
    want = np.array([slow_description(t or "") for t in texts])
    assert np.allclose(quality.describe(texts), want)
    monkeypatch.setattr(quality, "_SLICE", 100)  # texts cross slices
    assert np.allclose(quality.describe(texts), want) and quality.describe([]).shape == (0, quality.SIZE)


def dense_passes(x: np.ndarray, y: np.ndarray):
    """The sums of a step, from matrices."""
    u, p = len(x), y.sum()

    def passes(beta):
        g = x @ beta
        s = 1 / (1 + np.exp(-g))
        return {"u_bad": np.logaddexp(0, g).sum() / u, "p_good": (np.logaddexp(0, -g) * y).sum() / p, "p_bad": (np.logaddexp(0, g) * y).sum() / p,
                "u_slope": x.T @ s / u, "p_slope": x.T @ (s * y) / p, "p_mean": x.T @ y / p, "curve": (x * (s * (1 - s))[:, None]).T @ x / u}

    return passes


def test_risk_is_never_negative_and_least():
    """No direction goes down from the weights found, with a right prior and with one far too high, where the cut matters."""
    rng = np.random.default_rng(0)
    x = np.concatenate([rng.normal(0, 1, (6000, quality.SIZE - 1)), np.ones((6000, 1))], axis=1)
    good = x[:, 0] + x[:, 1] > -0.8
    y = (good & (rng.random(6000) < 0.3)).astype(float)
    passes = dense_passes(x, y)
    for prior in (good.mean(), 0.97):
        beta = quality.minimise(passes, prior)
        least = quality.risk(passes(beta), prior, beta)
        assert 0 <= least < quality.risk(passes(beta * 0), prior, beta * 0)
        for _ in range(50):
            other = beta + rng.normal(0, 0.05, quality.SIZE)
            assert quality.risk(passes(other), prior, other) > least - 2e-3
    assert ((x @ quality.minimise(passes, good.mean()) > 0) == good).mean() > 0.85


def test_prior_by_the_best_bin():
    rng = np.random.default_rng(5)
    for prior in (0.3, 0.6, 0.9):
        good, bad = rng.beta(6, 2, 40_000), rng.beta(2, 6, 40_000)
        kept = 0 if prior == 1 else int(40_000 * (1 - prior) / prior)
        texts = np.concatenate([good, bad[:kept]]) if kept <= 40_000 else np.concatenate([good[:int(40_000 * prior / (1 - prior))], bad])
        trusted = rng.beta(6, 2, 5_000)
        bins = np.linspace(0, 1, quality.BINS + 1)
        found = quality.best_bin(np.histogram(trusted, bins)[0], np.histogram(texts, bins)[0])
        assert abs(found - prior) < 0.08, prior
    assert quality.best_bin(np.zeros(8), np.ones(8)) == 0


def test_quality_of_odd_rows(spark):
    rng = random.Random(8)
    plain = "the weather report says that a mild wind will come over the hills and bring some rain".split()
    rows, labels = [], []
    for i in range(400):
        bad = i % 5 == 0
        text = " ".join(rng.choice(plain) + ("$$" if bad else "") for _ in range(rng.randint(20, 60))).capitalize() + "."
        rows.append((i, text))
        labels.append((i, int(not bad)))
    rows += [(900, None), (901, ""), (902, " "), (None, "the wind"), (903, "x" * 30_000), (904, "漢字"), *rows[:3]]
    labels += [(None, 1), (1, None), (2, 1), (2, 0), (5000, 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("score", F.lit("x")).withColumn("_features", F.lit(1)).withColumn("_good", F.lit(2))
    marks = spark.createDataFrame(labels, "doc_id long, quality int")
    found, model = quality.with_score(docs, marks)
    got = found.collect()
    assert found.columns == ["doc_id", "_features", "_good", "score"] and len(got) == len(rows) and all(0 <= r["score"] <= 1 for r in got)
    score = {r["doc_id"]: r["score"] for r in got}
    assert len({r["score"] for r in got if r["doc_id"] in (900, 901)}) == 1 and 0.6 < model.prior < 0.95
    held = [(score[i] >= 0.7, bool(q)) for i, q in labels[:400] if zlib.crc32(str(i).encode()) % 4 == 2]
    assert len(held) > 50 and np.mean([a == b for a, b in held]) > 0.95
    assert {r["good"] for r in quality.trusted(marks).collect()} == {True} and quality.trusted(marks).filter("doc_id in (1, 2)").collect()[0]["doc_id"] == 1
    assert {r["score"] for r in quality.with_score(docs, marks.filter("false"))[0].collect()} == {0.0}
    assert quality.with_score(docs.filter("false"), marks)[0].count() == 0


@needs_tables
def test_quality_query(spark):
    found = QUERIES["op12_pu_quality"](spark, LARGER).toPandas()
    assert found["score"].between(0, 1).all() and (found["predicted"] == (found["score"] >= 0.7)).all()
    assert (found["held_out"] == found["doc_id"].map(lambda i: zlib.crc32(str(i).encode()) % 4 == 2)).all()
    both = found.merge(pd.read_parquet(f"{LARGER}/labels.parquet"), on="doc_id")
    held = both[both["held_out"]]
    assert (held["predicted"] == held["quality"]).mean() > 0.9 and held[held["quality"] == 0]["predicted"].mean() < 0.1
