"""Byte-level BPE, token files and unigram counts against their libraries and brute force."""

import hashlib
import math
import random
import zlib

import numpy as np
import public_tokenizers as P
import pyarrow as pa
import pytest
import regex
import tiktoken
import tokenizers

from conftest import SF_SMALL
from llm_fixtures import EMPTY_SHA, documents, none, odd, texts  # noqa: F401
from kiln.llm import bpe, pretokens, token_file, unigram
from kiln.llm.registry import PATTERN, RANKS, op5_byte_bpe, op7_token_binary, op10_token_counts

WORDS = P.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def encoding():
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=bpe.read_ranks(RANKS), special_tokens={})


@pytest.fixture(scope="module")
def tokenizer():
    return tokenizers.Tokenizer.from_file(WORDS)


@pytest.fixture(scope="module")
def ordinary():
    """The tokenizer that takes special strings as ordinary text, as it is used for units."""
    t = tokenizers.Tokenizer.from_file(WORDS)
    t.encode_special_tokens = True
    return t


@pytest.fixture(scope="module")
def coder():
    return bpe.ByteBPE(RANKS, PATTERN)


def sha(x):
    return hashlib.sha256(x if isinstance(x, bytes) else x.encode()).hexdigest()


def test_units_never_split_a_match(ordinary):
    rng = random.Random(1)
    find = regex.compile(PATTERN).findall
    signs = [" ", "  ", "\n", "\t", "\r", "\x1c", "\x85", "\xa0", "　", "a", "b", "S", "t", "é", "ß", "字", "'", "'s",
             "'ll", ".", " .", "!", "—", "…", "1", "23", "٣", "́", "😀", "_", "<|endoftext|>", "Σ", "İ"]
    for _ in range(400):
        texts = ["".join(rng.choice(signs) for _ in range(rng.randint(0, 14))) for _ in range(4)]
        for lower in (False, True):
            u = pretokens.Units(pa.array(texts), lower=lower)
            for i, t in enumerate(texts):
                own = [u.distinct[c] for c in u.codes[u.offsets[i]:u.offsets[i + 1]]]
                assert "".join(own).lower() == t.lower()
                if not lower:
                    assert [w for x in own for w in find(x)] == find(t)
                assert [i for x in own for i in ordinary.encode(x, add_special_tokens=False).ids] == \
                    ordinary.encode(t, add_special_tokens=False).ids


@pytest.mark.parametrize("text", ["", " ", "a" * 3000, " " * 400 + "x", "ab" * 900, "\n x\n\ny  \n", "don't I'll 'S"])
def test_bpe_contracts_like_the_library(encoding, coder, text):
    ids, decoded = coder.encode_texts(pa.array([text]))
    assert ids[0].as_py() == " ".join(map(str, encoding.encode_ordinary(text)))
    assert decoded[0].as_py() == text.encode()


def test_bpe_long_words_in_several_rounds(encoding, coder):
    rng = random.Random(2)
    words = ["".join(rng.choice("etaoinshrdlu") for _ in range(n)) for n in (65, 300, 1500)]
    got = coder.encode_words(words)
    for w, (ids, hexed) in zip(words, got):
        assert [int(x) for x in ids.split()] == encoding.encode_ordinary(w)
        assert bytes.fromhex(hexed) == w.encode()


def test_every_token_comes_out_of_its_merges(coder):
    ranks = bpe.read_ranks(RANKS)
    words = pa.array(list(ranks), pa.large_binary())
    ids, hexed = coder.encode(words)
    assert ids.to_pylist() == [str(r) for r in ranks.values()] and hexed.to_pylist() == [t.hex() for t in ranks]


def test_bpe_words_around_the_block_size(encoding, coder, monkeypatch):
    rng = random.Random(3)
    words = ["".join(rng.choice("aeiou stnr") for _ in range(rng.choice([1, 5, 9, 63, 64, 65, 80]))) for _ in range(300)]
    words = ["x" + w.replace(" ", "e") for w in words]
    for rows in (1, 64, 65, 1000):
        monkeypatch.setattr(bpe, "ROWS", rows)
        got = coder.encode_words(words)
        assert [[int(x) for x in i.split()] for i, _ in got] == [encoding.encode_ordinary(w) for w in words]


def test_bpe_decode(encoding, coder):
    coded = [encoding.encode_ordinary(t) for t in ("hello wörld", "", "x")]
    assert coder.decode(coded) == ["hello wörld".encode(), b"", b"x"]


def test_bpe_query(spark, texts, encoding):
    rows = op5_byte_bpe(spark, SF_SMALL).collect()
    assert len(rows) == len(texts)
    for r in rows:
        ids = encoding.encode_ordinary(texts[r["doc_id"]] or "")
        assert (r["n_tokens"], r["ids_sha256"]) == (len(ids), sha(" ".join(map(str, ids))))
        assert r["decoded_sha256"] == sha(texts[r["doc_id"]] or "")


def test_bpe_odd_documents(odd, none, encoding):
    rows = bpe.bpe_encode(odd, RANKS, PATTERN, keep_ids=True).collect()
    assert len(rows) == odd.count()
    by = {(r["doc_id"], r["decoded"]): r for r in rows}
    for d in odd.collect():
        text = d["text"] or ""
        assert by[(d["doc_id"], text)]["ids"] == encoding.encode_ordinary(text)
    assert by[(3, "")]["ids_sha256"] == EMPTY_SHA and by[(2, "")]["n_tokens"] == 0
    assert bpe.bpe_encode(none, RANKS, PATTERN).collect() == []


def test_bpe_encodes_a_unit_once_over_slices(encoding, monkeypatch):
    own = bpe.ByteBPE(RANKS, PATTERN)
    seen, encode = [], own.encode
    monkeypatch.setattr(own, "encode", lambda words: seen.extend(words.to_pylist()) or encode(words))
    slices = ["the cat, the dög 12\n", "the cat and the dög 12\n", "", "\u3000 the cat's 1234 \t dög\n"]
    for n, text in enumerate(slices * 2):
        if n == len(slices):
            once = len(seen)
        ids, decoded = own.encode_texts(pa.array([text, None, text]))
        assert ids.to_pylist() == [" ".join(map(str, encoding.encode_ordinary(t))) for t in (text, "", text)]
        assert decoded.to_pylist() == [text.encode(), b"", text.encode()]
    assert len(seen) == once and seen.count(" the") == 1
    own.cache.kept = 1                                 # emptied over and over
    assert own.encode_texts(pa.array(slices))[0].to_pylist() == [" ".join(map(str, encoding.encode_ordinary(t))) for t in slices]


def check_token_rows(rows, docs, tokenizer):
    """Rows against whole-text encoding, documents in (doc_id, text) order."""
    start, expected = 0, []
    for doc_id, text in docs:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [2]
        expected.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert sorted(tuple(r) for r in rows) == sorted(expected)


def test_token_file_query(spark, texts, tokenizer):
    check_token_rows(op7_token_binary(spark, SF_SMALL).collect(), sorted(texts.items()), tokenizer)


def test_token_file_odd_documents(spark, odd, none, tokenizer, tmp_path):
    docs = odd.where("doc_id is not null")
    rows = token_file.token_binary(spark, docs, WORDS, str(tmp_path / "shards")).collect()
    ordered = sorted(((d["doc_id"], d["text"] or "") for d in docs.collect()))
    check_token_rows(rows, ordered, tokenizer)
    sizes = [f.stat().st_size for f in (tmp_path / "shards").glob("*.ids")]
    assert sum(sizes) == 2 * sum(r["n_tokens"] for r in rows)      # 16 bits per id
    assert token_file.token_binary(spark, none, WORDS).collect() == []
    with_null = token_file.token_binary(spark, odd, WORDS).collect()
    assert [r["start"] for r in with_null if r["doc_id"] is None] == [0]


def test_special_strings_become_their_ids_as_in_the_plain_call(spark, tokenizer, tmp_path):
    special = ["hello <|endoftext|> there", "hello <|ENDOFTEXT|> there", "a<|startoftext|>B", "<|endoftext|>", "<|endoftext|",
               "It's <|startoftext|><|endoftext|>  x\n" * 40, "no mark at all", "", "<|StartOfText|>é<|endoftext|>É"]
    docs = spark.createDataFrame(list(enumerate(special)), "doc_id long, text string")
    rows = token_file.token_binary(spark, docs, WORDS, str(tmp_path / "shards")).collect()
    check_token_rows(rows, list(enumerate(special)), tokenizer)
    assert tokenizer.encode(special[0], add_special_tokens=False).ids == [3306, 49407, 997]


def test_words_of_latin_1_letters_go_straight_to_the_model(tokenizer, monkeypatch):
    coder = token_file.WordTokenizer(WORDS)
    letters = token_file.LETTERS + "AZ"
    words = [a + b for a in letters for b in letters] + ["ÉTÉ", " Ça", "straße", "naïveté", " ÿþÿ", "ÀÉÎÕÜ" * 9]
    far = ["e\u0301te", "été\u0301", "µm", "ªº", "×÷", "été's", "İé", "ǅé", "éΣ", "é1", "é²", "x\u0300é", " é  é", "ﬁé"]
    expected = [tokenizer.encode(w, add_special_tokens=False).ids for w in words + far]
    got = [np.frombuffer(b, coder.dtype).tolist() for b in coder.encode(pa.array(words + far)).to_pylist()]
    assert got == expected

    class NoEncode:
        def encode(self, *args, **kwargs):
            raise AssertionError("a word of Latin-1 letters went through the whole call")

    monkeypatch.setattr(coder, "tokenizer", NoEncode())
    assert [np.frombuffer(b, coder.dtype).tolist() for b in coder._units([w.lower() for w in words])] == expected[:len(words)]


def test_token_file_needs_a_mounted_folder():
    with pytest.raises(ValueError, match="mounted"):
        token_file.local_path("hdfs://somewhere/x")


def brute_unigram(word, scores):
    best = [(0.0, 0)] + [(-math.inf, 0)] * len(word)
    for end in range(1, len(word) + 1):
        for start in range(end):
            s = scores.get(word[start:end])
            if s is not None:
                cand = (best[start][0] + s, best[start][1] + 1)
                if cand[0] > best[end][0] or cand[0] == best[end][0] and cand[1] < best[end][1]:
                    best[end] = cand
    return best[-1][1], best[-1][0]


def test_trie_scores_like_plain_dynamic_programming():
    scores = unigram.zipf_scores(bpe.read_ranks(RANKS))
    words = [w.encode() for w in (" the", " then", " there", "théâtre", "x", "aaaaaaaaaaaa", "tionention", " the")]
    trie = unigram.ForwardTrie(scores)
    got = trie.segment(words)
    assert [n for n, _ in got] == [brute_unigram(w, scores)[0] for w in words]
    assert [s for _, s in got] == pytest.approx([brute_unigram(w, scores)[1] for w in words])
    nodes = {w[:k] for w in words for k in range(len(w) + 1)}
    assert len(trie.best) == len(nodes)                # a shared prefix is one node
    small = unigram.ForwardTrie(scores, max_nodes=3)   # emptied over and over
    assert small.segment(words) == got


def test_trie_prefers_fewer_pieces_on_ties():
    trie = unigram.ForwardTrie({b"a": -1.0, b"b": -1.0, b"ab": -2.0})
    assert trie.segment([b"ab"]) == [(1, -2.0)]


def test_unigram_query(spark, texts):
    scores = unigram.zipf_scores(bpe.read_ranks(RANKS))
    find = regex.compile(PATTERN).findall
    known = {}
    rows = {r["doc_id"]: r for r in op10_token_counts(spark, SF_SMALL).collect()}
    assert len(rows) == len(texts)
    for doc_id in sorted(texts)[:25]:
        words = find(texts[doc_id] or "")
        for w in words:
            if w not in known:
                known[w] = brute_unigram(w.encode(), scores)
        assert (rows[doc_id]["n_words"], rows[doc_id]["n_tokens"]) == (len(words), sum(known[w][0] for w in words))
        assert rows[doc_id]["score"] == pytest.approx(sum(known[w][1] for w in words))


def test_unigram_odd_documents(odd, none):
    rows = unigram.token_counts(odd, RANKS, PATTERN).collect()
    assert len(rows) == odd.count()
    empty = [r for r in rows if r["doc_id"] in (2, 3)]
    assert all((r["n_words"], r["n_tokens"], r["score"]) == (0, 0, 0.0) for r in empty)
    assert unigram.token_counts(none, RANKS, PATTERN).collect() == []
