"""Vector codes: box search and codebooks against plain loops, odd vectors, ties, large codebooks."""

import hashlib
import math
import random

import numpy as np
import pytest

from conftest import SF_SMALL
from kiln.llm import vector_codes as vc
from kiln.llm.registry import op13_vector_codes

SCHEMA = "vec_id long, embedding array<float>, label int, code string, part long, e int"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, lab, "own", 1, 2) for i, v, lab in rows], SCHEMA)


def brute(rows, parts=8, entries=16, rounds=6):
    """(vec_id, code, error, label_error, digest) of each kept row by loops over Python integers."""
    kept = [(i, [math.floor(4096 * x) for x in v], lab) for i, v, lab in rows
            if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    if not kept:
        return []
    width = max(1, -(-max(len(v) for _, v, _ in kept) // parts))
    cut = [[(v + [0] * (parts * width - len(v)))[p * width:(p + 1) * width] for p in range(parts)] for _, v, _ in kept]
    order = sorted(range(len(kept)), key=lambda r: (kept[r][0] is None, kept[r][0] or 0, kept[r][1]))
    books = [[list(cut[r][p]) for r in order[:entries]] for p in range(parts)]

    def nearest(x, book):
        return min((sum((a - b) ** 2 for a, b in zip(x, c)), e) for e, c in enumerate(book))

    for _ in range(rounds):
        for p in range(parts):
            groups = {}
            for c in cut:
                groups.setdefault(nearest(c[p], books[p])[1], []).append(c[p])
            for e, g in groups.items():
                books[p][e] = [sum(x) // len(g) for x in zip(*g)]
    found = [[nearest(c[p], books[p]) for p in range(parts)] for c in cut]
    errors = [sum(d for d, _ in f) for f in found]
    labels = {}
    for (_, _, lab), e in zip(kept, errors):
        labels[lab] = labels.get(lab, 0) + e
    digest = hashlib.sha256(",".join(str(x) for b in books for c in b for x in c).encode()).hexdigest()
    return [(i, "".join(f"{e:02x}" for _, e in f), err, labels[lab], digest)
            for (i, _, lab), f, err in zip(kept, found, errors)]


def got(df):
    return sorted(map(tuple, df.collect()), key=str)


def random_rows(n, dims, seed=1):
    rng = random.Random(seed)
    f32 = lambda x: float(np.float32(x))
    return [(i * 3 % 97 + i, [f32(rng.gauss(0, 0.2)) for _ in range(dims)], rng.choice([0, 1, None])) for i in range(n)]


@pytest.mark.parametrize("dims", [16, 24, 19, 5])
def test_codes_equal_brute_force(spark, dims):
    rows = random_rows(120, dims, seed=dims)
    assert got(vc.vector_codes(spark, frame(spark, rows))) == sorted(brute(rows), key=str)


def test_query_equals_brute_force(spark):
    table = spark.read.parquet(f"{SF_SMALL}/embeddings.parquet").select("vec_id", "embedding", "label")
    assert got(op13_vector_codes(spark, SF_SMALL)) == sorted(brute([tuple(r) for r in table.collect()]), key=str)


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [0.5] * 16, 1), (1, [0.5] * 16, 1), (2, None, 1), (3, [nan] + [0.0] * 15, 2), (4, [inf] * 16, None),
            (5, [None] + [0.0] * 15, 2), (None, [-0.25] * 16, None), (6, [], 3), (7, [1.0, -1.0], None),
            (8, [0.5] * 16, 1), (8, [-0.5] * 16, 1)]
    assert got(vc.vector_codes(spark, frame(spark, rows))) == sorted(brute(rows), key=str)
    for none in ([], rows[2:6], [(6, [], None)]):
        assert got(vc.vector_codes(spark, frame(spark, none))) == sorted(brute(none), key=str)


def test_ties_and_equal_rows(spark):
    rows = [(i, [float(i % 3)] * 8, 0) for i in range(60)]      # entries repeat: the lower index wins everywhere
    out = got(vc.vector_codes(spark, frame(spark, rows)))
    assert out == sorted(brute(rows), key=str) and {r[2] for r in out} == {0}


def test_large_components_count_as_the_bound(spark):
    rows = [(1, [3e38] + [0.0] * 7, 0), (2, [1e5] + [0.0] * 7, 0), (3, [-3e38] + [0.0] * 7, 0)]
    ints = {r["vec_id"]: r["v"][0] for r in vc.integer_vectors(frame(spark, rows)).collect()}
    assert ints == {1: vc.LIMIT, 2: vc.LIMIT, 3: -vc.LIMIT}
    assert {r[2] for r in got(vc.vector_codes(spark, frame(spark, rows)))} == {0}


@pytest.mark.parametrize("entries, width, spread", [(1, 3, 5), (16, 8, 900), (64, 4, 30), (130, 6, 60), (300, 2, 9)])
def test_boxes_hold_the_nearest_entry_and_its_ties(entries, width, spread):
    rng = np.random.default_rng(entries)
    book = vc.Codebook(rng.integers(-spread, spread + 1, (entries, width)))
    x = rng.integers(-2 * spread, 2 * spread + 1, (2000, width))
    distance = np.square(x[:, None] - book.entries[None]).sum(axis=2)
    index, least = book.nearest(x)
    assert (index == distance.argmin(axis=1)).all() and (least == distance.min(axis=1)).all()
    radius = rng.integers(0, 3 * spread, len(x))
    inside = (np.abs(x[:, None] - book.entries[None]) <= radius[:, None, None]).all(axis=2)
    mask = book.boxes(x, radius)
    for e in range(entries):
        assert ((mask[:, e // 64] >> np.uint64(e % 64) & np.uint64(1)).astype(bool) == inside[:, e]).all()


def test_decoded_vectors_have_the_stated_error(spark):
    rows = random_rows(80, 16, seed=9)
    vectors = vc.integer_vectors(frame(spark, rows))
    books = vc.fit_codebooks(vectors, parts=4, entries=300, rounds=2)
    assert books.shape == (4, 80, 4)
    whole = {r["vec_id"]: np.array(r["v"]) for r in vectors.collect()}
    for r in vc.encode(vectors, books).collect():
        assert np.square(vc.decode(r["code"], books) - whole[r["vec_id"]]).sum() == r["error"]
