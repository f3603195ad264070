"""Conversations as a prefix tree: initial turns that conversations share are written once, depth first.

Every turn is formatted as ``### role: text</turn>`` and a line end; control strings inside are escaped
reversibly.  A node of the tree is a turn after certain turns, known by a digest of all of them.
The output has two tables.  Places count code points of the whole stream of nodes:

* nodes: ``start`` (place in the stream), ``text`` (formatted), ``position`` (of its first code point
  in the conversation; the others follow), ``ancestors`` (intervals of the stream that it may attend to
  besides itself, joined where they touch), ``loss_from``, ``loss_to`` (the text under the loss mask);
* conversations: the id, ``rank`` of its distinct sequence of turns, and the sequence's ``spans`` of the stream.

Sorted by their digests, conversations that share a beginning are neighbours, so the order of the
first conversation that has a node, then of the turn, is the depth-first order of the tree.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmill.llm.common import ordered_prefix, python_ready, stored

# The marks of a turn, and what is escaped inside texts and roles.
HEAD, END = "### ", "</turn>\n"
ASSISTANT = "assistant"
_MARKS = ("###", "</turn>")
_ESCAPED = re.compile(r"\\(\\|###|</turn>|:)")
_TURN_HEAD = re.compile(r"### ((?:[^\\:]|\\.)*): ", re.S)
_TURN_END = re.compile(r"(?<!\\)(?:\\\\)*</turn>\n")
BUCKET = 1 << 12  # code points of the stream in which conversations and nodes meet


def escape(text: str) -> str:
    text = text.replace("\\", "\\\\")
    for mark in _MARKS:
        text = text.replace(mark, f"\\{mark}")
    return text


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


def format_turn(role: str, text: str) -> tuple[str, int, int]:
    """The formatted turn, and from where to where it is under the loss mask (nowhere unless the assistant speaks)."""
    head = f"{HEAD}{escape(role).replace(':', chr(92) + ':')}: "
    body = escape(text)
    end = len(head) + len(body) if role == ASSISTANT else len(head)
    return f"{head}{body}{END}", len(head), end


def parse(formatted: str) -> list[tuple[str, str]]:
    """Roles and texts of formatted turns in a row; ``ValueError`` if it isn't that."""
    turns, at = [], 0
    while at < len(formatted):
        head = _TURN_HEAD.match(formatted, at)
        end = head and _TURN_END.search(formatted, head.end())
        if not end:
            raise ValueError("not a formatted conversation")
        turns.append((unescape(head[1]), unescape(formatted[head.end():end.end() - len(END)])))
        at = end.end()
    return turns


def _chain(parent: bytes, role: str, text: str) -> bytes:
    data = b"%d\n%s%s" % (len(role.encode()), role.encode(), text.encode())
    return hashlib.blake2b(parent + data, digest_size=16).digest()


def formatted_turns(df: DataFrame) -> DataFrame:
    """A row per turn of ``df`` (conv_id, turn, role, text) in order, with its node; the last one has the path of nodes.

    Turns stream by in order: of a conversation, only 16 bytes per turn are held.  Null texts and roles are
    empty; null turn numbers come first; equal numbers go by role, then text; a null conv_id is one conversation.
    """
    python_ready(df.sparkSession)
    rows = df.select(F.col("conv_id").cast("long").alias("conv_id"), "turn", F.coalesce("role", F.lit("")).alias("role"),
                     F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.repartition("conv_id").sortWithinPartitions("conv_id", F.col("turn").asc_nulls_first(), "role", "text")
    schema = pa.schema([
        ("conv_id", pa.int64()), ("seq", pa.int64()), ("node", pa.binary()), ("text", pa.string()), ("chars", pa.int64()),
        ("position", pa.int64()), ("loss_from", pa.int64()), ("loss_to", pa.int64()), ("path", pa.binary())])

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, path, held, position = None, [], None, 0
        for batch in batches:
            out = []
            for conv_id, _, role, text in zip(*(batch.column(i).to_pylist() for i in range(4))):
                if held and conv_id != conv:
                    out.append(held | {"path": b"".join(path)})
                    path, held, position = [], None, 0
                elif held:
                    out.append(held)
                conv = conv_id
                formatted, a, z = format_turn(role, text)
                path.append(_chain(path[-1] if path else b"", role, text))
                held = {"conv_id": conv, "seq": len(path) - 1, "node": path[-1], "text": formatted, "chars": len(formatted),
                        "position": position, "loss_from": a, "loss_to": z}
                position += len(formatted)
            yield pa.RecordBatch.from_pylist(out, schema)
        if held:
            yield pa.RecordBatch.from_pylist([held | {"path": b"".join(path)}], schema)

    return rows.mapInArrow(walk, "conv_id long, seq long, node binary, text string, chars long, position long,"
                                 " loss_from long, loss_to long, path binary")


def build(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The tables of nodes and of conversations, stored; an empty table gives empty ones.

    Copies of a conversation are folded into one sequence, and a node's first holder is found by a minimum
    aggregated before the shuffle.  A first turn that many share is one row of the node table; the join
    that hands its place to all sequences that have it is an equi-join, which adaptive execution splits.
    """
    spark = df.sparkSession
    turns = stored(formatted_turns(df), "turns")
    ends = turns.filter("path is not null").select("conv_id", F.col("node").alias("leaf"), "path")
    # The least id stands for all copies; a null id only for itself.
    sequences = ends.groupBy("leaf").agg(F.min("conv_id").alias("one"), F.min("path").alias("path"))
    ranked = ordered_prefix(sequences, [F.col("path").asc()], {}, "sequences").select(
        "leaf", "one", F.col("_row").alias("rank"))
    held = turns.join(ranked.select(F.col("one").alias("conv"), "rank"), F.col("conv_id").eqNullSafe(F.col("conv")))
    held = stored(held.select("rank", "seq", "node", "chars", "position"), "held")
    first = held.groupBy("node").agg(F.min(F.struct("rank", "seq")).alias("o"), F.max("chars").alias("chars"))
    first = first.select("node", F.col("o.rank").alias("owner"), F.col("o.seq").alias("depth"), "chars")
    placed = ordered_prefix(first, [F.col("owner").asc(), F.col("depth").asc()], {"start": F.col("chars")}, "places")
    placed = stored(placed.select("node", "owner", "start"), "placed")
    steps = held.join(placed, "node").select("rank", "seq", "node", "owner", "start", "chars")
    steps = steps.repartition("rank").sortWithinPartitions("rank", "seq")

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """For each node, in its first holder, the intervals before it; at a sequence's end, all of them."""
        rank, spans = None, []
        schema = pa.schema([("rank", pa.int64()), ("node", pa.binary()), ("start", pa.int64()),
                            ("spans", pa.list_(pa.list_(pa.int64())))])
        for batch in batches:
            out = []
            for r, _, node, owner, start, chars in zip(*(batch.column(i).to_pylist() for i in range(6))):
                if r != rank:
                    if spans:
                        out.append({"rank": rank, "spans": spans})
                    rank, spans = r, []
                if owner == r:
                    out.append({"node": node, "start": start, "spans": [list(s) for s in spans]})
                if spans and spans[-1][1] == start:
                    spans[-1][1] += chars
                else:
                    spans.append([start, start + chars])
            yield pa.RecordBatch.from_pylist(out, schema)
        if spans:
            yield pa.RecordBatch.from_pylist([{"rank": rank, "spans": spans}], schema)

    merged = stored(steps.mapInArrow(merge, "rank long, node binary, start long, spans array<array<long>>"), "spans")
    spans = F.transform("spans", lambda s: F.struct(s[0].alias("from"), s[1].alias("to")))
    of_node = merged.filter("node is not null").select("node", "start", spans.alias("ancestors"))
    owned = held.join(placed.select("node", "owner"), "node").filter("rank = owner").select("node", "rank")
    # A node's text comes from the conversation that stands for its owner.
    one = owned.join(ranked.select("rank", "one"), "rank").select(F.col("node").alias("n"), F.col("one").alias("conv"))
    texts = turns.join(one, (F.col("node") == F.col("n")) & F.col("conv_id").eqNullSafe(F.col("conv")))
    nodes = of_node.join(texts.select("node", "text", "position", "loss_from", "loss_to"), "node").drop("node")
    of_sequence = merged.filter("rank is not null").select("rank", spans.alias("spans"))
    conversations = ends.join(ranked.select("leaf", "rank"), "leaf").select("conv_id", "rank")
    conversations = conversations.join(of_sequence, "rank")
    return stored(nodes, "chat-nodes"), stored(conversations, "chat-conversations")


def read_back(nodes: DataFrame, conversations: DataFrame) -> DataFrame:
    """Digests of each conversation, from the two tables: each distinct sequence is put together and parsed once."""
    python_ready(nodes.sparkSession)
    sequences = conversations.dropDuplicates(["rank"]).select("rank", F.explode("spans").alias("s")).select("rank", "s.from", "s.to")
    sequences = sequences.withColumn("bucket", F.explode(F.expr(f"sequence(`from` div {BUCKET}, (`to` - 1) div {BUCKET})")))
    at = nodes.select("start", "text", "loss_from", "loss_to", F.expr(f"start div {BUCKET}").alias("bucket"))
    rows = sequences.join(at, "bucket").filter("start >= `from` and start < `to`")
    rows = rows.select("rank", "start", "text", "loss_from", "loss_to").repartition("rank").sortWithinPartitions("rank", "start")
    schema = pa.schema([("rank", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()),
                        ("loss_sha256", pa.string()), ("formatted_chars", pa.int64())])

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rank, turns, loss, n = None, hashlib.sha256(), hashlib.sha256(), [0, 0, 0]

        def row() -> dict:
            return dict(zip(schema.names, [rank, n[0], turns.hexdigest(), n[1], loss.hexdigest(), n[2]]))

        for batch in batches:
            out = []
            for r, _, text, a, z in zip(*(batch.column(i).to_pylist() for i in range(5))):
                if r != rank:
                    if n[0]:
                        out.append(row())
                    rank, turns, loss, n = r, hashlib.sha256(), hashlib.sha256(), [0, 0, 0]
                for role, said in parse(text):
                    turns.update(f"{role}\n{said}\n".encode())
                    n[0] += 1
                under = unescape(text[a:z])
                loss.update(under.encode())
                n[1], n[2] = n[1] + len(under), n[2] + len(text)
            yield pa.RecordBatch.from_pylist(out, schema)
        if n[0]:
            yield pa.RecordBatch.from_pylist([row()], schema)

    found = rows.mapInArrow(digest, "rank long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string,"
                                    " formatted_chars long")
    return conversations.select("conv_id", "rank").join(found, "rank").drop("rank")
