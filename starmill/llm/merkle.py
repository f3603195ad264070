"""Merkle manifest of a dataset: a tree of SHA-256 midstates over groups of rows, then over the groups.

A node is the SHA-256 of its children's digests as hex text, which is 64 bytes and so exactly one block of
SHA-256.  The hash state before each child is therefore eight words without a rest: every parent retains
a copy of it for each child slot.  To fold a changed child upwards, the state before its slot is resumed,
the replacement and the siblings to its right are fed to it, and it is closed; what lies to the left is not
read again.

Rows are placed by one range shuffle of their digests.  Then FANOUT ** BLOCK_LEVELS neighbours are one
block, whose nodes and states are computed at once and stored in one row; the blocks' roots are again
cut into blocks, until each group has one root.  The groups' roots are the leaves of the upper tree.  Paths
are handed down from block to block, and a row meets them in its own block only.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starmill.llm.common import extended, ordered_prefix, python_ready, stored

FANOUT = 3
BLOCK_LEVELS = 8  # 6,561 leaves a block, some 2 MB with all states
DIGEST = 32
_BLOCK = "g string, block long, size int, top binary, nodes binary, states binary"
_PATH = "g string, item long, proof binary, steps binary, subroot binary, root binary"
_HEX = np.frombuffer(b"0123456789abcdef", np.uint8)


def leaf(*columns: Column) -> Column:
    """Hex SHA-256 of a row: of each value ``-`` if null, else its bytes in UTF-8, a colon and the value as text."""
    parts = []
    for c in columns:
        value = c.cast("string")
        parts.append(F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-")))
    return F.sha2(F.concat(*parts), 256)


@lru_cache(maxsize=1)
def _constants() -> tuple[np.ndarray, np.ndarray]:
    """First 32 bits of the fractions of the square roots of 8 primes and the cube roots of 64."""
    primes = [n for n in range(2, 312) if all(n % d for d in range(2, n))]

    def root(n: int, k: int) -> int:
        x = 1 << (n.bit_length() // k + 1)
        while x ** k > n:
            x = ((k - 1) * x + n // x ** (k - 1)) // k
        return x & 0xFFFFFFFF

    return (np.array([root(p << 64, 2) for p in primes[:8]], np.uint32),
            np.array([root(p << 96, 3) for p in primes], np.uint32))


_N = [np.uint32(n) for n in range(33)]


def _turns(x: np.ndarray, a: int, b: int, c: int) -> np.ndarray:
    return (x >> _N[a] | x << _N[32 - a]) ^ (x >> _N[b] | x << _N[32 - b]) ^ (x >> _N[c] | x << _N[32 - c])


def _schedule(block: np.ndarray) -> list[np.ndarray]:
    """What the 64 rounds add: the constants and the words spread from a block (16 x n)."""
    w = list(block)
    for t in range(16, 64):
        x, y = w[t - 15], w[t - 2]
        w.append(w[t - 16] + ((x >> _N[7] | x << _N[25]) ^ (x >> _N[18] | x << _N[14]) ^ (x >> _N[3]))
                 + w[t - 7] + ((y >> _N[17] | y << _N[15]) ^ (y >> _N[19] | y << _N[13]) ^ (y >> _N[10])))
    return [x + k for x, k in zip(w, _constants()[1])]


@lru_cache(maxsize=FANOUT)
def _ending(children: int) -> list[np.ndarray]:
    """The last block of a node: a bit and the length of what was fed."""
    last = np.zeros((16, 1), np.uint32)
    last[0], last[15] = 1 << 31, children * 2 * DIGEST * 8
    return _schedule(last)


def _rounds(state: np.ndarray, words: list[np.ndarray]) -> np.ndarray:
    a, b, c, d, e, f, g, h = state
    for w in words:
        one = h + _turns(e, 6, 11, 25) + (g ^ (e & (f ^ g))) + w
        a, b, c, d, e, f, g, h = one + _turns(a, 2, 13, 22) + ((a & b) | (c & (a | b))), a, b, c, d + one, e, f, g
    return np.stack([a, b, c, d, e, f, g, h]) + state


def absorb(state: np.ndarray, block: np.ndarray) -> np.ndarray:
    """States (8 x n) after one block each (16 x n, or 16 x 1 for the same block)."""
    return _rounds(state, _schedule(block))


def _as_block(digests: np.ndarray) -> np.ndarray:
    """Digests (n x 32 bytes) as hex text: 16 words each."""
    text = np.empty((len(digests), 2 * DIGEST), np.uint8)
    text[:, 0::2], text[:, 1::2] = _HEX[digests >> 4], _HEX[digests & 15]
    return text.view(">u4").astype(np.uint32).T


def _digests(state: np.ndarray) -> np.ndarray:
    """States as bytes, n x 32."""
    return np.ascontiguousarray(state.T).astype(">u4").view(np.uint8).reshape(-1, DIGEST)


def _state(data: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(data).view(">u4").astype(np.uint32).T


def _closed(state: np.ndarray, children: np.ndarray) -> np.ndarray:
    """Digests of states to which so many children have been fed."""
    out = np.empty((state.shape[1], DIGEST), np.uint8)
    for n in np.unique(children).tolist():
        out[children == n] = _digests(_rounds(state[:, children == n], _ending(n)))
    return out


@dataclass
class Tree:
    """Nodes of one block, level by level from the leaves, and for each parent the states before its slots."""

    levels: list[np.ndarray]
    states: list[np.ndarray]  # one less: parents x FANOUT x 32 bytes

    @classmethod
    def over(cls, leaves: np.ndarray, height: int | None = None) -> Tree:
        """The tree of some leaves (n x 32): of ``height`` levels above them, or up to a single node."""
        levels, states = [leaves], []
        while len(levels[-1]) > 1 if height is None else len(states) < height:
            nodes = levels[-1]
            n = -(-len(nodes) // FANOUT)
            children = np.minimum(FANOUT, len(nodes) - FANOUT * np.arange(n))
            state = np.repeat(_constants()[0][:, None], n, axis=1)
            before = np.zeros((n, FANOUT, DIGEST), np.uint8)
            for slot in range(FANOUT):
                has = children > slot
                before[has, slot] = _digests(state[:, has])
                state[:, has] = absorb(state[:, has], _as_block(nodes[slot::FANOUT]))
            levels.append(_closed(state, children))
            states.append(before)
        return cls(levels, states)

    def nodes(self) -> bytes:
        return b"".join(x.tobytes() for x in self.levels)

    def kept(self) -> bytes:
        return b"".join(x.tobytes() for x in self.states)

    @classmethod
    def read(cls, size: int, nodes: bytes, states: bytes) -> Tree:
        node, state, tree = np.frombuffer(nodes, np.uint8).reshape(-1, DIGEST), np.frombuffer(states, np.uint8), cls([], [])
        state = state.reshape(-1, FANOUT, DIGEST)
        while len(node):
            tree.levels.append(node[:size])
            node, size = node[size:], -(-size // FANOUT)
            if len(node):
                tree.states.append(state[:size])
                state = state[size:]
        return tree

    def fold(self, at: np.ndarray, digests: np.ndarray) -> np.ndarray:
        """What the top would be if leaf ``at[i]`` alone had ``digests[i]``, for each i."""
        for nodes, states in zip(self.levels, self.states):
            at, slot = np.divmod(at, FANOUT)
            state = absorb(_state(states[at, slot]), _as_block(digests))
            children = np.minimum(FANOUT, len(nodes) - FANOUT * at)
            for right in range(1, FANOUT):
                has = slot + right < children
                if has.any():
                    state[:, has] = absorb(state[:, has], _as_block(nodes[FANOUT * at[has] + slot[has] + right]))
            digests = _closed(state, children)
        return digests

    def siblings(self, at: np.ndarray) -> list[bytes]:
        """For each leaf, the digests of its siblings, level by level, from left to right."""
        out = [b""] * len(at)
        for nodes in self.levels[:len(self.states)]:
            runs = {}
            for i, a in enumerate(at.tolist()):
                if a not in runs:
                    first = a - a % FANOUT
                    runs[a] = nodes[first:a].tobytes() + nodes[a + 1:first + FANOUT].tobytes()
                out[i] += runs[a]
            at = at // FANOUT
        return out

    def steps(self, at: int) -> bytes:
        """How to go on from a leaf: for each level the state before it, the number of siblings to its right and in all, the right ones."""
        out = []
        for nodes, states in zip(self.levels, self.states):
            first = at - at % FANOUT
            right = nodes[at + 1:first + FANOUT]
            out.append(states[at // FANOUT, at % FANOUT].tobytes() + bytes([len(right), len(nodes[first:first + FANOUT])]) + right.tobytes())
            at //= FANOUT
        return b"".join(out)


def _resume(digests: np.ndarray, steps: bytes) -> np.ndarray:
    """Fold digests, which all stand at one node, along that node's ``steps``."""
    data = np.frombuffer(steps, np.uint8)
    while len(data):
        start, (right, children), data = data[:DIGEST], data[DIGEST:DIGEST + 2].tolist(), data[DIGEST + 2:]
        state = absorb(np.repeat(_state(start[None]), len(digests), axis=1), _as_block(digests))
        for sibling in data[:right * DIGEST].reshape(-1, DIGEST):
            state = absorb(state, _as_block(sibling[None]))
        digests, data = _closed(state, np.full(len(digests), children)), data[right * DIGEST:]
    return digests


def _bytes(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(-1, DIGEST)


def _hex(digests: np.ndarray) -> pa.Array:
    return pa.array([d.hex() for d in map(bytes, digests)], pa.string())


def _blocks(items: DataFrame, block_levels: int, name: str) -> DataFrame:
    """Items (``g``, ``item``, ``digest``) as blocks of neighbours; a group that one block holds is closed to a single node."""
    whole = FANOUT ** block_levels

    def build(group: pa.Table) -> pa.Table:
        at = np.argsort(group.column("item").to_numpy())
        leaves = _bytes(group.column("digest"))[at]
        block = group.column("block")[0].as_py()
        alone = block == 0 and len(leaves) < whole  # places have no gaps: there is no other block
        tree = Tree.over(leaves, None if alone else block_levels)
        return pa.table({"g": [group.column("g")[0].as_py()], "block": pa.array([block], pa.int64()),
                         "size": pa.array([len(leaves)], pa.int32()), "top": [tree.levels[-1][0].tobytes()],
                         "nodes": [tree.nodes()], "states": [tree.kept()]})

    rows = items.select("g", "item", "digest", F.floor(F.col("item") / whole).alias("block"))
    return stored(rows.groupBy("g", "block").applyInArrow(build, _BLOCK), name)


def _floors(items: DataFrame, block_levels: int, name: str) -> list[DataFrame]:
    """Blocks of the items, blocks of those blocks' tops, and so on until each group has a single block."""
    floors = [_blocks(items, block_levels, name)]
    while not floors[-1].filter("block > 0").isEmpty():
        floors.append(_blocks(floors[-1].select("g", F.col("block").alias("item"), F.col("top").alias("digest")), block_levels, name))
    return floors


def _paths(blocks: DataFrame) -> DataFrame:
    """Blocks that know the way from their tops to the root, as ways of all their items."""
    def down(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                tree = Tree.read(r["size"], r["nodes"], r["states"])
                for a in range(0, r["size"], 500):
                    at = np.arange(a, min(a + 500, r["size"]))
                    first = r["block"] * r["whole"]
                    n = len(at)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([r["g"]] * n, pa.string()), pa.array(at + first), pa.array([s + r["proof"] for s in tree.siblings(at)], pa.binary()),
                         pa.array([tree.steps(i) + r["steps"] for i in at.tolist()], pa.binary()),
                         pa.array([r["subroot"]] * n, pa.binary()), pa.array([r["root"]] * n, pa.binary())],
                        names=["g", "item", "proof", "steps", "subroot", "root"])

    return blocks.mapInArrow(down, _PATH)


@dataclass
class Manifest:
    """A stored tree: ``placed`` rows (``g``, ``item``, ``digest``, and the given columns ``names`` as c0, c1, ...) and blocks.

    ``floors`` are the blocks of each group from the rows upwards, ``groups`` the numbered subroots (``g``, ``item``,
    ``digest``), and ``upper`` the blocks of the tree over them.
    """

    placed: DataFrame
    names: list[str]
    floors: list[DataFrame]
    groups: DataFrame
    upper: list[DataFrame]
    block_levels: int

    def _descend(self, floors: list[DataFrame], tops: DataFrame) -> DataFrame:
        """The lowest floor's blocks with the way from their tops to the root; ``tops`` has that of the highest floor's."""
        whole = FANOUT ** self.block_levels
        for blocks in reversed(floors):
            here = blocks.join(tops.withColumnRenamed("item", "block"), ["g", "block"]).withColumn("whole", F.lit(whole))
            tops = _paths(here)
        return here

    def blocks(self) -> DataFrame:
        """The lowest floor's blocks, each with ``subroot``, ``root`` and the way (``proof``, ``steps``) to the root."""
        top = self.upper[-1].select("g", F.col("block").alias("item"), F.lit(b"").alias("proof"), F.lit(b"").alias("steps"),
                                    F.lit(b"").alias("subroot"), F.col("top").alias("root"))
        groups = _paths(self._descend(self.upper, top))  # items of the upper tree are groups, by number
        named = self.groups.join(groups.drop("g"), "item").select(
            "g", F.lit(0).cast("long").alias("item"), "proof", "steps", F.col("digest").alias("subroot"), "root")
        return self._descend(self.floors, stored(named, "merkle-ways"))

    def verify(self, new: str) -> DataFrame:
        """All given columns, and of each row: ``subroot``, ``root``, ``proof_sha256`` (of its siblings on the way to the
        root), ``folded_root`` (with the row's column ``new``, a hex digest, in its place) and ``verified``.  Columns so named are replaced."""
        made = {"subroot": "string", "root": "string", "proof_sha256": "string", "folded_root": "string", "verified": "boolean"}
        kept = {f"c{i}": c for i, c in enumerate(self.names) if c.lower() not in made}
        whole, plain = FANOUT ** self.block_levels, list(kept)

        def fold(rows: pa.Table, block: pa.Table) -> pa.Table:
            b = block.to_pylist()[0]
            tree = Tree.read(b["size"], b["nodes"], b["states"])
            at = rows.column("item").to_numpy() - b["block"] * whole
            digests = np.frombuffer(bytes.fromhex("".join(rows.column("new").to_pylist())), np.uint8).reshape(-1, DIGEST)
            top, origin = np.unique(tree.fold(at, digests), axis=0, return_inverse=True)
            folded = _resume(top, b["steps"])[origin.ravel()]
            above = b["proof"].hex()
            proofs = [hashlib.sha256((s.hex() + above).encode()).hexdigest() for s in tree.siblings(at)]
            root, n = b["root"], len(at)
            made = {"subroot": pa.array([b["subroot"].hex()] * n), "root": pa.array([root.hex()] * n), "proof_sha256": pa.array(proofs),
                    "folded_root": _hex(folded), "verified": pa.array((folded == np.frombuffer(root, np.uint8)).all(axis=1))}
            return pa.table([*[rows.column(p) for p in plain], *made.values()], names=[*plain, *made])

        rows = self.placed.select("g", "item", F.floor(F.col("item") / whole).alias("block"),
                                  F.col(f"c{self.names.index(new)}").alias("new"), *plain)
        schema = extended(rows.select(*plain).schema, **made)
        out = rows.groupBy("g", "block").cogroup(self.blocks().groupBy("g", "block")).applyInArrow(fold, schema)
        return out.toDF(*kept.values(), *made)


def _numbered(tops: DataFrame) -> DataFrame:
    """A row per group with ``item``, the group's number in their order: only totals of ranges are summed up centrally."""
    return ordered_prefix(tops.drop("item"), [F.col("g").asc()], {}, "merkle-groups").withColumnRenamed("_row", "item")


def _placed(rows: DataFrame, order: list[str]) -> DataFrame:
    """Stored ``rows`` (with ``g``) and ``item``: a row's place in its group, from 0, in the given order.

    One range shuffle; the scan order breaks ties, so that equal rows spread.  A range begins inside at most one
    group, so only one number per range is sent to all tasks.
    """
    keys = ["g", *order, "tie"]
    parts = max(2, int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    cut = rows.withColumn("tie", F.monotonically_increasing_id()).repartitionByRange(parts, *keys)
    cut = stored(cut.withColumn("part", F.spark_partition_id()), "merkle-ranges")
    counts = cut.groupBy("part", "g").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("g").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("part", "g", F.sum("n").over(before).alias("first")).filter("first is not null")
    inside = F.row_number().over(Window.partitionBy("part", "g").orderBy(*order, "tie"))
    placed = cut.join(F.broadcast(starts), ["part", "g"], "left")
    return placed.withColumn("item", (F.coalesce("first", F.lit(0)) + inside - 1).cast("long")).drop("part", "tie", "first")


def build(df: DataFrame, group: str, order: list[str], digest: str, block_levels: int = BLOCK_LEVELS) -> Manifest:
    """The manifest of rows with a hex ``digest`` (never null): per value of ``group`` a tree of its rows in the given order, and a tree over the groups.

    While a group has several nodes, every FANOUT consecutive ones (of the last ones fewer, even one) become
    their parent; a group of one row is that row's digest.  Groups are ordered bytewise, null first, and make the upper
    tree in the same way.  Rows that are null in ``order`` come first; rows equal in ``order`` are taken by digest, and
    equal rows are separate leaves.  All columns are carried along, whatever their names, so wide ones should be dropped
    before.  An empty table has no root, and ``verify`` gives no rows.
    """
    python_ready(df.sparkSession)
    plain = {c: f"c{i}" for i, c in enumerate(df.columns)}
    key = F.coalesce(F.concat(F.lit("="), F.col(f"`{group}`").cast("string")), F.lit(""))  # sorts like the group, null first
    rows = stored(df.select(key.alias("g"), F.unhex(F.col(f"`{digest}`")).alias("digest"),
                            *[F.col(f"`{c}`").alias(p) for c, p in plain.items()]), "merkle-leaves")
    placed = _placed(rows, [*[plain[c] for c in order], "digest"])
    floors = _floors(placed, block_levels, "merkle-blocks")
    groups = stored(_numbered(floors[-1].select("g", F.col("top").alias("digest"))), "merkle-subroots")
    upper = _floors(groups.withColumn("g", F.lit("")), block_levels, "merkle-upper")
    return Manifest(placed, df.columns, floors, groups, upper, block_levels)
