"""Operator 11: chat formatting over reply trees.

Messages are nodes with a parent. Iterative self-joins enumerate root-to-leaf paths by doubling: step k joins each
node's 2^k-th ancestor with that node's own 2^k-th ancestor, so a chain of n messages takes log2(n) joins of narrow
rows, and the same steps add up scores and depths. Leaves are ranked within their tree by the mean score of their
path; the best ones' paths are then expanded with the same ancestor tables (the messages of a path double with each
join). Every path becomes one conversation, written in pieces of at most ``PIECE_TURNS`` turns so that no
conversation has to fit into a task or a row.

Template, one line group a turn: ``### role: text</turn>`` and a line feed. Inside texts and roles a backslash is
doubled, a ``#`` behind a ``#`` and the slash of ``</turn>`` get a backslash before them, and so does a role's colon;
a text then holds neither ``##`` nor ``</turn>``, and ``unescape`` turns it back. The loss mask is the list of the
assistant texts' spans (code points of the piece).

Nothing is collected; every step is written under the shared folder. A hot tree spreads by node keys and pieces; only
the digest of one conversation, which is sequential by its nature, is a stream through one task (bounded memory).

Defined cases: null texts and roles are empty; a null tree (conversation) id is a tree of its own; a null or unknown
parent, or one in another tree, makes a root; a null score counts 0; equal scores go to the leaf that comes first in
(tree, id) order; rows that share an id are messages of their own, and replies to that id hang below the first of
them; a ring of replies is cut above its first message; turns of one number follow in order of role and MD5 of the
text, and rows equal in all three in any order; very long texts end a piece after ``PIECE_CHARS``; an empty table
gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators.numbering import number_rows
from .common import Workspace, small_batches, task

PIECE_TURNS, PIECE_CHARS = 64, 1 << 20
END = "</turn>\n"
LOSS_ROLE = "assistant"
HEADER = re.compile(r"### ((?:[^\\:]|\\.)*): ", re.S)
UNESCAPE = re.compile(r"\\(.)", re.S)
DOUBLE_HASH = re.compile("(?<=#)#")


def escape(text: str) -> str:
    text = text.replace("\\", "\\\\").replace("</turn>", "<\\/turn>")
    return DOUBLE_HASH.sub(r"\\#", text) if "##" in text else text


def unescape(text: str) -> str:
    return UNESCAPE.sub(r"\1", text) if "\\" in text else text


def render(role: str, text: str) -> tuple[str, int]:
    """(the formatted turn, where its text starts in it)"""
    head = f"### {escape(role).replace(':', chr(92) + ':')}: "
    return f"{head}{escape(text)}{END}", len(head)


def parse(piece: str) -> Iterator[tuple[str, str]]:
    """(role, text) of every turn of a formatted piece."""
    for turn in piece.split(END)[:-1]:
        head = HEADER.match(turn)
        yield unescape(head[1]), unescape(turn[head.end():])


# ---- messages (key, tree, role, text) and edges (key, tree, parent: a key or null, score)

def _rows(df: DataFrame, tree: str, *more) -> DataFrame:
    small_batches(df.sparkSession)
    text = lambda c: F.coalesce(df[c].cast("string"), F.lit(""))
    rows = df.select(df[tree].cast("long").alias("tree"), *more, text("role").alias("role"), text("text").alias("text"))
    return rows.withColumn("digest", F.md5(F.col("text").cast("binary")))


def _edges(messages: DataFrame, found: DataFrame, work: Workspace) -> DataFrame:
    parents = found.select(F.col("key").alias("__child"), "parent")
    return work.stage(messages.select("key", "tree", "score").join(
        parents, F.col("key") == F.col("__child"), "left").drop("__child"), "edges")


def by_turn(conversations: DataFrame, work: Workspace) -> tuple[DataFrame, DataFrame]:
    """Linear conversations (conv_id, turn, role, text): every row replies to the row before it."""
    rows = _rows(conversations, "conv_id", conversations["turn"].cast("long").alias("turn"),
                 F.lit(0.0).alias("score"))
    messages = number_rows(rows, ["tree", "turn", "role", "digest"], work.stage, "key", ties=["text"])
    above = messages.select(F.col("key").alias("parent"), F.col("tree").alias("__tree"))
    same = (F.col("key") - 1 == F.col("parent")) & F.col("tree").eqNullSafe(F.col("__tree"))
    return messages, _edges(messages, messages.select("key", "tree").join(above, same), work)


def by_reply(posts: DataFrame, work: Workspace) -> tuple[DataFrame, DataFrame]:
    """Reply trees (tree, id, parent, role, text, score)."""
    rows = _rows(posts, "tree", posts["id"].cast("long").alias("id"), posts["parent"].cast("long").alias("reply_to"),
                 F.coalesce(posts["score"].cast("double"), F.lit(0.0)).alias("score"))
    messages = number_rows(rows, ["tree", "id", "reply_to", "score", "role", "digest"], work.stage, "key",
                           ties=["text"])
    first = messages.groupBy(F.col("tree").alias("__tree"), F.col("id").alias("__id")).agg(F.min("key").alias("parent"))
    same = (F.col("reply_to") == F.col("__id")) & F.col("tree").eqNullSafe(F.col("__tree"))
    return messages, _edges(messages, messages.select("key", "tree", "reply_to").join(first, same), work)


class _Ancestors:
    """Ancestor tables by doubling: ``jumps[k]`` holds (key, up) for nodes with a 2^k-th ancestor; ``ended`` every
    node's depth and the score from it up to its root."""

    def __init__(self, edges: DataFrame, work: Workspace):
        self.work = work
        self.n = edges.count()
        cut = None
        while True:
            rings = self._double(edges if cut is None else self._cut(edges, cut))
            if rings is None:
                break
            cut = rings if cut is None else cut.unionByName(rings)

    @staticmethod
    def _cut(edges: DataFrame, cut: DataFrame) -> DataFrame:
        roots = cut.select(F.col("key").alias("__cut"))
        parent = F.when(F.col("__cut").isNull(), F.col("parent"))
        return edges.join(roots, edges["key"] == roots["__cut"], "left").withColumn("parent", parent).drop("__cut")

    def _double(self, edges: DataFrame) -> DataFrame | None:
        """Fill the tables; where nodes are left over (rings of replies), the first node of every ring."""
        state = self.work.stage(edges.select(
            "key", F.col("parent").alias("up"), F.col("score").alias("sum"), F.lit(0).cast("long").alias("depth"),
            F.col("key").alias("least")), "up")
        self.jumps, done = [], state.where("up is null")
        going = state.where("up is not null")
        while (1 << len(self.jumps)) <= 2 * self.n and going.head(1):
            k = len(self.jumps)
            self.jumps.append(going.select("key", "up"))
            there = done.unionByName(going).select(*[F.col(c).alias(f"__{c}") for c in going.columns])
            far = there["__up"].isNotNull()
            both = going.join(there, going["up"] == there["__key"])
            state = self.work.stage(both.select(
                "key", F.col("__up").alias("up"), (F.col("sum") + F.col("__sum")).alias("sum"),
                F.when(far, F.lit(0)).otherwise(F.col("__depth") + F.lit(1 << k)).cast("long").alias("depth"),
                F.least("least", "__least").alias("least")), "up")
            done, going = done.unionByName(state.where("up is null")), state.where("up is not null")
        if going.head(1):
            on_ring = going.select(F.col("up").alias("__on")).distinct()
            return self.work.stage(going.join(on_ring, going["key"] == on_ring["__on"], "left_semi")
                                   .where("key = least").select("key"), "rings")
        self.ended = done.select("key", "sum", "depth")
        return None


def reply_paths(messages: DataFrame, edges: DataFrame, work: Workspace, best: int | None = 1) -> DataFrame:
    """The messages of the ``best`` root-to-leaf paths of every tree (None: of all): tree, path (the leaf's key),
    rank of the path, position from the root, role, text."""
    up = _Ancestors(edges, work)
    replied = up.jumps[0].select(F.col("up").alias("key")).distinct() if up.jumps else None
    leaves = up.ended if replied is None else up.ended.join(replied, "key", "left_anti")
    ranked = leaves.join(edges.select("key", "tree"), "key").withColumn("rank", F.row_number().over(
        Window.partitionBy("tree").orderBy(F.desc(F.col("sum") / (F.col("depth") + 1)), "key")))
    if best is not None:
        ranked = ranked.where(F.col("rank") <= best)
    chosen = work.stage(ranked.select(F.col("key").alias("path"), F.col("key").alias("node"), "rank",
                                      F.col("depth").alias("position")), "paths")
    members = chosen
    for k, jump in enumerate(up.jumps):
        far = members.where(F.col("position") >= F.lit(1 << k)).join(jump, F.col("node") == jump["key"])
        members = members.unionByName(work.stage(far.select(
            "path", F.col("up").alias("node"), "rank", (F.col("position") - F.lit(1 << k)).alias("position")),
            "paths"))
    return members.join(messages.select("key", "tree", "role", "text"), F.col("node") == F.col("key")).select(
        "tree", "path", "rank", "position", "role", "text")


PIECES = ("tree long, path long, rank long, block long, piece long, turns long, text string, "
          "loss array<struct<start:long,stop:long>>")


def format_paths(paths: DataFrame) -> DataFrame:
    """The conversations as formatted pieces, in the order of (block, piece) within a path."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["tree", "path", "rank", "block", "piece", "turns", "text", "loss"]
        loss_type = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))
        key, piece, turns, spans, parts, size = None, 0, 0, [], [], 0
        rows: list[tuple] = []

        def flush() -> Iterator[pa.RecordBatch]:
            nonlocal rows
            if rows:
                columns = list(zip(*rows))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, pa.int64()) for c in columns[:6]] + [pa.array(columns[6], pa.string()),
                                                                      pa.array(columns[7], loss_type)], names)
                rows = []

        held = 0
        for batch in batches:
            for tree, path, rank, block, role, text in zip(*(batch.column(c).to_pylist() for c in (
                    "tree", "path", "rank", "block", "role", "text"))):
                own = key == (tree, path, rank, block)
                if key is not None and (not own or size >= PIECE_CHARS):
                    rows.append((*key, piece, turns, "".join(parts), spans))
                    held += size
                    piece = piece + 1 if own else 0
                    turns, spans, parts, size = 0, [], [], 0
                    if held >= PIECE_CHARS:
                        yield from flush()
                        held = 0
                key = (tree, path, rank, block)
                turn, at = render(role, text)
                if role == LOSS_ROLE:
                    spans.append({"start": size + at, "stop": size + len(turn) - len(END)})
                parts.append(turn)
                turns, size = turns + 1, size + len(turn)
        if key is not None:
            rows.append((*key, piece, turns, "".join(parts), spans))
        yield from flush()

    blocks = paths.withColumn("block", F.floor(F.col("position") / PIECE_TURNS).cast("long"))
    dealt = blocks.repartition("path", "block").sortWithinPartitions("path", "block", "position")
    return dealt.mapInArrow(task(run), PIECES)


DIGESTS = ("conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
           "formatted_chars long")


def read_digests(pieces: DataFrame) -> DataFrame:
    """Per conversation, from its formatted pieces: turns, loss text and lengths, as a stream in order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [c.split()[0] for c in DIGESTS.split(", ")]
        types = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
        now, tree, rows = None, None, []
        n = chars = loss_chars = 0
        turns, loss = hashlib.sha256(), hashlib.sha256()
        for batch in batches:
            for conv, path, text, spans in zip(*(batch.column(c).to_pylist() for c in ("tree", "path", "text",
                                                                                       "loss"))):
                if now is not None and path != now:
                    rows.append((tree, n, turns.hexdigest(), loss_chars, loss.hexdigest(), chars))
                    n = chars = loss_chars = 0
                    turns, loss = hashlib.sha256(), hashlib.sha256()
                now, tree = path, conv
                for role, said in parse(text):
                    turns.update(f"{role}\n{said}\n".encode())
                    n += 1
                for span in spans:
                    said = unescape(text[span["start"]:span["stop"]])
                    loss.update(said.encode())
                    loss_chars += len(said)
                chars += len(text)
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)
                rows = []
        if now is not None:
            rows.append((tree, n, turns.hexdigest(), loss_chars, loss.hexdigest(), chars))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)

    small_batches(pieces.sparkSession)
    ordered = pieces.repartition("path").sortWithinPartitions("path", "block", "piece")
    return ordered.select("tree", "path", "text", "loss").mapInArrow(task(run), DIGESTS)


def chat_conversations(spark: SparkSession, conversations: DataFrame) -> DataFrame:
    """The conversations, every row of them on the one path of its tree, formatted, written and read back."""
    work = Workspace(spark, "chat")
    return read_digests(work.stage(format_paths(reply_paths(*by_turn(conversations, work), work)), "formatted"))
