"""Reply trees: paths against a plain walk, template round trips, pieces, odd conversations."""

import hashlib
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from conftest import SF_SMALL
from kiln.llm import chat
from kiln.llm.common import Workspace
from kiln.llm.registry import MARKED, op11_chat_formatting

POSTS = "tree long, id long, parent long, role string, text string, score double, path string, node long, up long"
TURNS = "conv_id long, turn long, role string, text string, key long, tree long, score string"


def sha(x):
    return hashlib.sha256(x.encode()).hexdigest()


PARTS = list("\\#</>turn:ab\n é😀") + ["</turn>", "###", "</turn>\n", "\\### "]
ALPHABET = st.lists(st.sampled_from(PARTS), max_size=20).map("".join)


@settings(max_examples=400, deadline=None)
@given(st.lists(st.tuples(ALPHABET, ALPHABET), max_size=4))
def test_template_round_trip(turns):
    piece = "".join(chat.render(r, t)[0] for r, t in turns)
    assert list(chat.parse(piece)) == turns
    for r, t in turns:
        escaped = chat.escape(t)
        assert "##" not in escaped and "</turn>" not in escaped and chat.unescape(escaped) == t
        turn, at = chat.render(r, t)
        assert turn[at:len(turn) - len(chat.END)] == escaped


def digests(rows):
    """Expected rows of the query for (conv_id, turn, role, text)."""
    out = []
    for conv in {r[0] for r in rows}:
        own = sorted((r for r in rows if r[0] == conv), key=lambda r: (
            r[1] is not None, r[1] or 0, r[2] or "", hashlib.md5((r[3] or "").encode()).hexdigest()))
        said = [(r[2] or "", r[3] or "") for r in own]
        loss = "".join(t for r, t in said if r == "assistant")
        out.append((conv, len(own), sha("".join(f"{r}\n{t}\n" for r, t in said)), len(loss), sha(loss),
                    sum(len(chat.render(r, t)[0]) for r, t in said)))
    return sorted(out, key=str)


def test_query_equals_brute_force(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/conversations.parquet")
            .select("conv_id", "turn", "role", "text").collect()]
    assert sorted(map(tuple, op11_chat_formatting(spark, SF_SMALL).collect()), key=str) == digests(rows + MARKED)


def test_odd_conversations(spark):
    rows = [(1, 0, "user", "hi"), (1, 1, "assistant", None), (2, 0, None, "x"), (None, 0, "user", "no id"),
            (None, 3, "assistant", "### a"), (3, 1, "assistant", "b"), (3, 1, "assistant", "a"), (3, 1, "user", "c"),
            (3, None, "system", "first"), (4, 5, "assistant", "twice"), (4, 5, "assistant", "twice"),
            (5, 0, "role: odd\\", "a: b"), (6, 0, "assistant", ""), (7, -2, "user", "y" * 200_000)]
    rows += [(8, k, "user" if k % 2 else "assistant", f"t{k} </turn>\n### x: ") for k in range(300)]
    df = spark.createDataFrame([(*r, 1, 2, "s") for r in rows], TURNS)
    assert sorted(map(tuple, chat.chat_conversations(spark, df).collect()), key=str) == digests(rows)
    assert chat.chat_conversations(spark, df.limit(0)).collect() == []


def test_pieces_are_bounded_and_whole(spark, monkeypatch):
    rows = [(1, k, "assistant", f"{k} " * 50) for k in range(200)] + [(2, 0, "user", "z" * 9000), (2, 1, "user", "a")]
    work = Workspace(spark, "chat-test")
    df = spark.createDataFrame([(*r, 1, 2, "s") for r in rows], TURNS)
    paths = work.stage(chat.reply_paths(*chat.by_turn(df, work), work), "paths")
    pieces = [r.asDict(recursive=True) for r in chat.format_paths(paths).collect()]
    assert max(p["turns"] for p in pieces) <= chat.PIECE_TURNS and sum(p["turns"] for p in pieces) == len(rows)
    for conv in (1, 2):
        own = sorted((p for p in pieces if p["tree"] == conv), key=lambda p: (p["block"], p["piece"]))
        assert [t for p in own for t in chat.parse(p["text"])] == [r[2:] for r in rows if r[0] == conv]
        assert "".join(chat.unescape(p["text"][x["start"]:x["stop"]]) for p in own for x in p["loss"]) == "".join(
            r[3] for r in rows if r[0] == conv and r[2] == "assistant")


def walk(posts, best):
    """Paths of a forest by recursion: posts are (tree, id, parent, role, text, score) in key order."""
    keys = {}
    for k, p in enumerate(posts):
        keys.setdefault((p[0], p[1]), k)
    parent = [None if p[2] is None else keys.get((p[0], p[2])) for p in posts]
    for k in range(len(posts)):                      # cut rings above their first message
        seen, at = [], k
        while at is not None and at not in seen:
            seen.append(at)
            at = parent[at]
        if at is not None:
            parent[min(seen[seen.index(at):])] = None
    out = []
    for tree in {p[0] for p in posts}:
        found = []
        for leaf in (k for k in range(len(posts)) if posts[k][0] == tree and k not in parent):
            path, at = [], leaf
            while at is not None:
                path.append(at)
                at = parent[at]
            mean = sum(posts[k][5] or 0 for k in path) / len(path)
            found.append((-mean, leaf, path[::-1]))
        for rank, (_, leaf, path) in enumerate(sorted(found)[:best], 1):
            out += [(tree, leaf, rank, pos, posts[k][3], posts[k][4]) for pos, k in enumerate(path)]
    return sorted(out, key=str)


@pytest.mark.parametrize("seed, best", [(1, 1), (2, 3), (3, None), (4, 2)])
def test_paths_of_random_trees(spark, seed, best):
    rng = random.Random(seed)
    posts = []
    for tree in [0, 1, 2, 3, None]:
        n = rng.randint(1, 40)
        for i in range(n):
            back = rng.choice([None, rng.randrange(n), max(0, i - 1), max(0, i - 1), 99])   # rings, unknown parents
            posts.append((tree, rng.choice([i, i, i, rng.randrange(n)]), back, rng.choice(["user", "assistant"]),
                          f"m{len(posts)}", rng.choice([0.0, 1.0, 0.5, None, 2.0])))
    first = lambda x: (x is not None, x if x is not None else 0)
    posts.sort(key=lambda p: (first(p[0]), first(p[1]), first(p[2]), p[5] or 0, p[3],
                              hashlib.md5(p[4].encode()).hexdigest()))
    df = spark.createDataFrame([(*p, "x", 1, 2) for p in posts], POSTS)
    work = Workspace(spark, "chat-test")
    got = chat.reply_paths(*chat.by_reply(df.repartition(3), work), work, best)
    assert sorted(map(tuple, got.collect()), key=str) == walk(posts, best)


def test_long_chain_takes_logarithmic_joins(spark):
    rows = [(1, k, "user", str(k)) for k in range(1000)]
    df = spark.createDataFrame([(*r, 1, 2, "s") for r in rows], TURNS)
    work = Workspace(spark, "chat-test")
    messages, edges = chat.by_turn(df, work)
    assert len(chat._Ancestors(edges, work).jumps) == 10
    got = chat.reply_paths(messages, edges, work).collect()
    assert sorted((r["position"], r["text"]) for r in got) == sorted((k, str(k)) for k in range(1000))
