"""Operators over groups of documents, against plain versions: SimHash, substrings, decontamination."""

import math
import random
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from siltworks.llm import copies, decontam, graph, queries, simhash, substring


def plain_fingerprint(text):
    words = (text or "").encode().lower().split()
    shingles = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(fps, ids, radius=2):
    root = list(range(len(fps)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= radius:
                root[find(i)] = find(j)
    least = {}
    for i, own in enumerate(ids):
        if own is not None:
            least[find(i)] = min(own, least.get(find(i), own))
    return [least.get(find(i)) for i in range(len(fps))]


def test_simhash_matches_brute_force(spark, sf):
    got = {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in queries.op6_simhash(spark, sf).collect()}
    docs = queries.table(spark, sf, "documents").select("doc_id", "text").collect()
    fps = [plain_fingerprint(r["text"]) for r in docs]
    ids = [r["doc_id"] for r in docs]
    want = {i: (f"{f:016x}", c) for i, f, c in zip(ids, fps, plain_components(fps, ids), strict=True)}
    assert got == want


def test_simhash_on_odd_rows(spark, odd, none):
    got = simhash.near_duplicates(odd).collect()
    assert len(got) == odd.count()
    rows = odd.select("doc_id", "text").collect()
    fps = [plain_fingerprint(r["text"]) for r in rows]
    want = sorted(map(str, zip([r["doc_id"] for r in rows], fps, plain_components(fps, [r["doc_id"] for r in rows]), strict=True)))
    assert sorted(str((r["id"], r["fp"] % (1 << 64), r["component"])) for r in got) == want
    assert simhash.near_duplicates(none).count() == 0
    kept = simhash.one_of_each(odd)
    assert kept.columns == odd.columns
    assert kept.where("doc_id IN (0, 1, 2)").count() == 1
    assert simhash.one_of_each(none).count() == 0


@pytest.mark.parametrize("tile", [4, 16, 2048])
def test_tiles_lose_no_link(spark, tile):
    rng = random.Random(tile)
    base = rng.getrandbits(64)
    fps = {base}
    while len(fps) < 150:  # one hot bucket: a few bits about one value, all in the last block
        fps.add(base ^ sum(1 << (43 + rng.randrange(20)) for _ in range(rng.randrange(1, 6))))
    fps |= {rng.getrandbits(64) for _ in range(100)}
    fps = sorted(fps)
    nodes = spark.createDataFrame([(int(np.uint64(f).astype(np.int64)),) for f in fps], "node long")
    links = simhash.links(nodes, 2, tile)
    found = {r["node"] % (1 << 64): r["root"] % (1 << 64) for r in graph.components(links).collect()}
    want = plain_components(fps, list(range(len(fps))))
    groups, mine = {}, {}
    for i, f in enumerate(fps):
        groups.setdefault(want[i], set()).add(f)
        mine.setdefault(found.get(f, f), set()).add(f)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, mine.values()))


@pytest.mark.parametrize("pick", [simhash.one_of_each, copies.one_of_each])
def test_rows_that_share_an_id_are_judged_by_their_text(spark, pick):
    a, b, c = (" ".join(f"{x}{i}" for i in range(60)) for x in "abc")
    rows = [(3, b), (5, b), (5, a), (9, c), (9, c), (None, a), (None, a)]
    for parts in (1, 3):
        got = pick(spark.createDataFrame(rows, "doc_id long, text string").repartition(parts)).collect()
        assert sorted(map(str, got)) == sorted(map(str, spark.createDataFrame([(3, b), (5, a), (9, c), (None, a), (None, a)], "doc_id long, text string").collect()))


def test_components_of_long_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(0, 64)] + [(100, i) for i in range(101, 160)] + [(7, 7), (None, 3), (101, 100)]
    got = {(r["node"], r["root"]) for r in graph.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {(i, 0) for i in range(1, 65)} | {(i, 100) for i in range(101, 160)}
    assert graph.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_substrings_find_planted_passages(spark):
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randrange(3, 9)))
    passages = [" ".join(word() for _ in range(rng.randrange(51, 90))) for _ in range(60)]
    rows, planted = [], set()
    for i in range(400):
        words = [word() for _ in range(rng.randrange(80, 300))]
        if i % 3 == 0:
            at = rng.randrange(len(words))
            words[at:at] = passages[i // 3 % len(passages)].split()
            planted.add(i)
        rows.append((i, "  ".join(words) if i % 2 else " ".join(words)))
    got = substring.repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    found = {r["id"] for r in got}
    assert not found - planted
    assert len(planted - found) <= 1  # a cut at both ends of a passage is a matter of chance: 1 in 400 at most
    text = {i: t.split() for i, t in rows}
    for r in got:
        run = " ".join(text[r["id"]][r["first_word"] : r["first_word"] + r["n_words"]])
        assert any(run in " ".join(w) for i, w in text.items() if i != r["id"])


def test_chunks_resist_insertions():
    rng = random.Random(3)
    words = ["".join(rng.choice("abcdefgh") for _ in range(rng.randrange(2, 9))) for _ in range(600)]
    a, b = " ".join(words), " ".join(words[:200] + ["inserted"] + words[200:])
    owner, _, _, digest = substring.chunks([a.encode(), b.encode()])
    one, two = set(digest[owner == 0]), set(digest[owner == 1])
    assert len(one & two) > 0.9 * len(one)


def test_substrings_on_odd_rows(odd, none):
    found = {r["id"] for r in substring.repeats(odd).collect()}
    assert found == {5, 6, 7, 8, 9, 10}
    assert substring.repeats(none).count() == 0


def in_words(text):
    return re.findall(r"\w+", (text or "").lower())


def share_of(part, words):
    """The share of a part's five-word sequences (a shorter part: of itself) that words have."""
    n = min(5, len(part))
    own = {" ".join(part[i : i + n]) for i in range(len(part) - n + 1)}
    return len(own & {" ".join(words[i : i + n]) for i in range(len(words) - n + 1)}) / len(own)


def plain_leaks(docs, items, overlap=0.8):
    """Every item against every window, with nothing of the operator's."""
    out = set()
    docs = [(i, in_words(t)) for i, t in docs]
    for key, text in items:
        own = in_words(text)
        if not own:
            continue
        ask, mark, reply = text.partition("?")
        question, answer = in_words(ask), in_words(reply)
        if not (mark and question and answer):
            k = math.ceil(2 * len(own) / 3)
            question, answer = own[:k], own[k:]
        if len(answer) < 5:
            answer = own[-5:]
        for i, w in docs:
            if len(own) == 1:
                if w == own:
                    out.add((i, key))
                continue
            if not set(question) & set(w):
                continue
            for at in range(0, max(1, len(w)), 16):
                here = w[at : at + 2 * max(64, len(own))]
                if share_of(question, here) >= overlap and share_of(answer, here) >= overlap:
                    out.add((i, key))
                    break
    return out


def test_decontamination_matches_brute_force(spark, sf):
    docs = queries.table(spark, sf, "documents").select("doc_id", "text").collect()
    items = queries.table(spark, sf, "benchmark").select("item_id", "text").collect()
    got = {(r["doc_id"], r["item_id"]) for r in queries.op8_decontamination(spark, sf).collect()}
    assert got == plain_leaks(docs, items)


def test_no_passage_over_the_threshold_is_lost():
    rng = random.Random(1)
    vocabulary = [f"v{i}" for i in range(400)]
    items = [(i, " ".join(rng.choices(vocabulary, k=rng.randrange(6, 60)))) for i in range(90)]
    texts = [rng.choices(vocabulary, k=rng.randrange(0, 700)) for _ in range(40)]
    for t in texts[::3]:
        t[len(t) // 2 : len(t) // 2] = rng.choice(items)[1].split()
    index = decontam.Index(items, 64, decontam.Statistics.of([t for _, t in items]))
    got = {(a, b, i): s for a, b, i, s in index.search(texts, 0.35)}
    # plain BM25 over whole items, with the share of an item's own score
    own = [t.split() for _, t in items]
    mean = sum(map(len, own)) / len(own)
    idf = {w: math.log(1 + (len(own) - n + 0.5) / (n + 0.5)) for w in vocabulary for n in [sum(w in o for o in own)]}
    want = {}
    for i, o in enumerate(own):
        impact = {w: idf[w] * o.count(w) * 2.2 / (o.count(w) + 1.2 * (0.25 + 0.75 * len(o) / mean)) for w in set(o)}
        for a, t in enumerate(texts):
            for p in range(max(1, -(-len(t) // 64) - 1)):
                score = sum(impact.get(w, 0) for w in set(t[p * 64 : p * 64 + 128])) / sum(impact.values())
                if score >= 0.35:
                    want[a, p * 64, i] = score
    assert got.keys() == want.keys()
    assert all(abs(got[k] - want[k]) < 1e-6 for k in want)


def test_scores_do_not_depend_on_the_blocks_of_the_benchmark(spark, sf):
    docs, items = queries.table(spark, sf, "documents"), queries.table(spark, sf, "benchmark")
    found = [sorted((r["id"], r["item_id"], round(r["score"], 9), r["first_word"]) for r in decontam.find(docs, items, block_items=n).collect()) for n in (10_000, 17, 5)]
    assert found[0] == found[1] == found[2] and found[0]
    left = [sorted(r["doc_id"] for r in decontam.clean(docs, items, block_items=n).collect()) for n in (10_000, 17)]
    assert left[0] == left[1] and set(left[0]) == {r["doc_id"] for r in docs.collect()} - {i for i, *_ in found[0]}


def test_decontamination_on_odd_rows(spark, odd, none):
    items = spark.createDataFrame([(1, "What will the quick brown fox do? jumps over the lazy dog while many"), (2, None), (3, ""), (4, " ".join(f"w{i}x{i}" for i in range(200))), (1, "What")], "item_id long, text string")
    found = {(r["id"], r["item_id"]) for r in decontam.find(odd, items).collect()}
    rows = odd.select("doc_id", "text").collect()
    assert found == plain_leaks(rows, [tuple(r) for r in items.collect()])
    kept = decontam.clean(odd, items)
    assert kept.columns == odd.columns and kept.count() == odd.where(~F.col("doc_id").isin([i for i, _ in found if i is not None]) | F.col("doc_id").isNull()).count()
    clash = odd.select("*", *(F.lit(1).alias(c) for c in ("id", "item_id", "score", "key", "word", "n")))
    assert {(r["id"], r["item_id"]) for r in decontam.find(clash, items.withColumn("key", F.lit(1))).collect()} == found
    assert decontam.clean(clash, items).columns == clash.columns
    assert decontam.find(none, items).count() == 0
    assert decontam.find(odd, items.limit(0)).count() == 0
    assert decontam.clean(odd, items.limit(0)).count() == odd.count()


def test_short_parts_of_items_are_found(spark):
    rng = random.Random(2)
    fill = lambda: " ".join(f"f{rng.randrange(10**6)}" for _ in range(150))
    texts = ["Who wrote Hamlet? The play is a work of William Shakespeare of Stratford", "Who wrote Macbeth? Shakespeare", "Why? because the sky scatters blue light more than red", "the capital of france is paris", "name three primes now", "seven words"]
    items = spark.createDataFrame(list(enumerate(texts)), "item_id long, text string")
    docs = spark.createDataFrame([*((i, f"{fill()} {t} {fill()}") for i, t in enumerate(texts)), (100, fill()), (101, "who wrote it? words seven, primes name three")], "doc_id long, text string")
    assert {(r["id"], r["item_id"]) for r in decontam.find(docs, items).collect()} == {(i, i) for i in range(len(texts))}
    assert {r["doc_id"] for r in decontam.clean(docs, items).collect()} == {100, 101}
