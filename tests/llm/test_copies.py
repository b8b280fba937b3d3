"""The near-duplicates stage against exact Jaccard similarities of whole texts."""

import math
import random

import pytest

import corpus_pipeline
from siltworks.llm import copies, graph


def shingles(text):
    words = text.lower().split()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))}


def similarity(a, b):
    x, y = shingles(a), shingles(b)
    return len(x & y) / len(x | y)


def pairs(least, below, count, sizes):
    """Texts and edited copies of them, at similarities in a range."""
    rng, out = random.Random(11), []
    word = lambda: "".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randrange(3, 9)))
    while len(out) < count:
        words = [word() for _ in range(rng.randrange(*sizes))]
        other = list(words)
        while similarity(" ".join(words), " ".join(other)) >= below:
            if rng.random() < 0.5 and len(other) > 6:
                del other[rng.choice((0, -1))]
            else:
                other[rng.randrange(len(other))] = word()
        if least <= similarity(" ".join(words), " ".join(other)):
            out.append((" ".join(words), " ".join(other)))
    return out


def kept(spark, sf, texts):
    rows = [(i, t) for i, t in enumerate(texts)]
    return {r["doc_id"] for r in corpus_pipeline.near_duplicates(spark, spark.createDataFrame(rows, "doc_id long, text string"), sf).collect()}


def test_texts_below_the_similarity_stay(spark, sf):
    texts = [t for pair in pairs(0.7, 0.799, 150, (80, 400)) for t in pair]
    assert kept(spark, sf, texts) == set(range(len(texts)))


@pytest.mark.parametrize("sizes", [(9, 30), (80, 400)])
def test_no_pair_at_the_similarity_is_lost(spark, sf, sizes):
    texts = [t for pair in pairs(0.8, 0.84, 150, sizes) for t in pair]
    assert kept(spark, sf, texts) == set(range(0, len(texts), 2))


def test_large_group_of_copies_and_near_misses(spark, sf):
    rng = random.Random(3)
    base = [f"w{i}" for i in range(120)]
    texts = []
    for i in range(200):
        own = list(base)
        for k in range(rng.choice((1, 2, 4, 8))):
            own[rng.randrange(len(own))] = f"x{i}y{k}"
        texts.append(" ".join(own))
    root = list(range(len(texts)))
    for i in range(len(texts)):
        for j in range(i):
            if similarity(texts[i], texts[j]) >= 0.8 and root[i] != root[j]:
                root = [min(root[i], root[j]) if r in (root[i], root[j]) else r for r in root]
    assert 2 < len(set(root)) < 150
    assert kept(spark, sf, texts) == set(root)


def test_pairs_without_a_common_signature_are_found(spark, sf):
    texts = []
    for seed in (15187, 568099, 796383, 899328):  # four of five shingles in common, but no four least values of 24 times four orders
        words = [f"w{seed}x{i}" for i in range(9)]
        texts += [" ".join(words), " ".join(words[:8])]
        assert similarity(*texts[-2:]) == 0.8
    assert kept(spark, sf, texts) == {0, 2, 4, 6}


@pytest.mark.parametrize("tiles", [1, 2, 64])
def test_all_pairs_of_tiles_are_compared(spark, tiles):
    rng = random.Random(tiles)
    rows = []
    while len(rows) < 900:
        own = [rng.getrandbits(64) for _ in range(4)]
        for _ in range(rng.choice((1, 1, 1, 2, 5))):
            size = rng.choice((50, 60, 75, 300))
            other = list(own)
            for _ in range(rng.randrange(60, 100)):
                other[rng.randrange(4)] ^= 1 << rng.randrange(64)
            rows.append((len(rows), size, *other))
    signed = [(i, n, *(x - (x >> 63 << 64) for x in u)) for i, n, *u in rows]
    links = copies.near_links(spark.createDataFrame(signed, "node long, size int, u0 long, u1 long, u2 long, u3 long"), tiles=tiles)
    found = {r["node"]: r["root"] for r in graph.components(links).collect()}
    root, level = list(range(len(rows))), [int(math.log(n) / -math.log(0.8) + 1e-9) for _, n, *_ in rows]
    for i, _, *x in rows:
        for j, _, *y in rows[:i]:
            if abs(level[i] - level[j]) <= 1 and sum((p ^ q).bit_count() for p, q in zip(x, y, strict=True)) <= 80 and root[i] != root[j]:
                old, new = max(root[i], root[j]), min(root[i], root[j])
                root = [new if r == old else r for r in root]
    cold = len(set(root))
    assert 400 < cold < 900
    if tiles > 1:  # one tile has no levels
        assert [found.get(i, i) for i in range(len(rows))] == root
    else:
        assert len({found.get(i, i) for i in range(len(rows))}) <= cold
