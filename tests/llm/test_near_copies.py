"""Near copies by wide SimHash against exact Jaccard similarities."""

import random

import numpy as np
import pytest

from runscope.llm import near_copies as N

SCHEMA = "doc_id long, text string, mark string, print string"


def shingles(text, size=5):
    words = (text or "").lower().split()
    return frozenset(" ".join(words[i : i + size]) for i in range(len(words) - size + 1)) or frozenset([" ".join(words)] if words else [])


def jaccard(a, b):
    return len(a & b) / len(a | b) if a | b else 1.0


def edited(words, r, share):
    """A text with about this share of its words replaced."""
    return " ".join(f"z{r.randrange(10**6)}" if r.random() < share else w for w in words)


def test_fingerprints_estimate_similarity():
    r = random.Random(1)
    for share in (0.0, 0.01, 0.03, 0.06):
        base = [f"w{r.randrange(5000)}" for _ in range(800)]
        texts = [" ".join(base), edited(base, r, share)]
        raw = "".join(texts).encode()
        prints, names = N.fingerprints_of(np.frombuffer(raw, np.uint8), np.array([0, len(texts[0]), len(raw)]))
        j = jaccard(*map(shingles, texts))
        apart = int(np.bitwise_count(prints[0] ^ prints[1]).sum())
        assert abs(apart / N.BITS - N.bit_share(j)) < 0.07
        assert (names[0] == names[1]).all() == (j == 1)


def test_shingle_sets():
    texts = ["a b c d e f a b c d e", "A  B\tc d e", "one two", "", "one  TWO", " . "]
    raw = "".join(texts).encode()
    offsets = np.append(0, np.cumsum([len(t.encode()) for t in texts]))
    rows, hashes = N.shingle_sets(np.frombuffer(raw, np.uint8), offsets, 5)
    sets = [frozenset(hashes[rows == i].tolist()) for i in range(len(texts))]
    assert [len(s) for s in sets] == [len(shingles(t)) for t in texts]
    assert sets[1] < sets[0] and sets[2] == sets[4] and not sets[3]


@pytest.mark.parametrize("large, group", [(1024, 40), (16, 40), (16, 200)])
def test_bit_sliced_links_match_brute_force(large, group):
    r = np.random.default_rng(group + large)
    base = r.integers(0, 1 << 63, (5, N.BITS // 64), dtype=np.uint64)
    flips = lambda n, k: np.packbits(r.random((n, N.BITS)) < k / N.BITS, axis=1).view(np.uint64)
    prints = np.concatenate([base[0] ^ flips(group, 30), base[1] ^ flips(30, 45), base[2] ^ flips(9, 5), r.integers(0, 1 << 63, (60, N.BITS // 64), dtype=np.uint64), base[3:4]])
    bucket = np.sort(r.integers(0, 2, len(prints)))
    apart = np.bitwise_count(prints[:, None] ^ prints[None]).sum(2)
    linked = (apart <= 80) & (bucket[:, None] == bucket[None]) & ~np.eye(len(prints), dtype=bool)
    pairs = N.links_in(prints, bucket, 80, large=large, cells=512)
    assert all(linked[a, b] for a, b in pairs)

    def groups(edges):
        parent, _ = N.forest(len(prints), np.array([a for a, _ in edges], int), np.array([b for _, b in edges], int))
        return N.roots(parent).tolist()

    assert groups(pairs) == groups(np.argwhere(linked).tolist())


def corpus(r):
    """(texts, groups of near copies): pairs with a share of words replaced, a large group around one text, clean texts."""
    make = lambda: [f"w{r.randrange(20000)}" for _ in range(r.randrange(150, 400))]
    texts = [" ".join(make()) for _ in range(200)]
    for _ in range(150):
        base = make()
        texts += [" ".join(base), edited(base, r, r.choice([0.002, 0.01, 0.02, 0.03, 0.1]))]
    base = make()
    texts += [edited(base, r, 0.01) for _ in range(300)]
    return texts


@pytest.mark.parametrize("bucket_rows", [100_000, 60])
def test_one_of_each_group_of_near_copies_stays(spark, monkeypatch, bucket_rows):
    found = N.links
    monkeypatch.setattr(N, "links", lambda *x: found(*x, bucket_rows=bucket_rows))
    r = random.Random(5)
    texts = corpus(r)
    rows = [(i, t) for i, t in enumerate(texts)]
    rows += [(5000, texts[3].upper()), (None, texts[4]), (None, "only here"), (None, "Only  here"), (6000, None), (6001, ""), (6002, "two words"), (6003, "two  WORDS"), (None, None), rows[7], rows[7]]
    r.shuffle(rows)
    docs = spark.createDataFrame([(*x, "clash", "clash") for x in rows], SCHEMA).repartition(5)
    out = N.keep_one(docs)
    assert out.columns == docs.columns
    kept = [(x["doc_id"], x["text"]) for x in out.collect()]
    ids = {d for d, _ in kept}
    assert len(kept) == len(set(kept)) and {6000, 6002, 3, 4, 7} <= ids and not {5000, 6001, 6003} & ids
    assert sum(d is None for d, _ in kept) == 1  # of those without an id only "only here" has no like with one
    sets = {d: shingles(t) for d, t in rows if d is not None and d < 4000}
    assert set(range(200)) <= ids  # clean texts stay
    pairs = [(i, i + 1, jaccard(sets[i], sets[i + 1])) for i in range(200, 500, 2)]
    assert all(i in ids for i, *_ in pairs)
    near, far = [j for *_, j in pairs if j >= 0.8], [j for *_, j in pairs if j < 0.6]
    caught = sum(k not in ids for _, k, j in pairs if j >= 0.8)
    assert len(near) > 60 and len(far) > 20 and caught >= 0.9 * len(near)
    assert not any(k not in ids for _, k, j in pairs if j < 0.6)
    # of the large group some texts are under 0.8 to all others, and stay by right
    group = [sets[i] for i in range(500, 800)]
    edges = [(i, j) for i in range(300) for j in range(i) if jaccard(group[i], group[j]) >= 0.8]
    parts = len(set(N.roots(N.forest(300, *np.array(edges).T)[0]).tolist()))
    assert parts <= len(ids & set(range(500, 800))) <= parts + 6
    assert N.keep_one(docs.limit(0)).count() == 0


def test_similarities_are_exact():
    r = random.Random(8)
    texts = [" ".join(r.choices("abcdefg", k=r.randint(0, 40))) for _ in range(120)] + ["", "x", "X", "a b c d e f", "a b c d e F"]
    left, right = texts, texts[1:] + texts[:1]
    packed = [(np.frombuffer("".join(side).encode(), np.uint8), np.append(0, np.cumsum([len(t) for t in side]))) for side in (left, right)]
    want = [1.0 if not shingles(a) and not shingles(b) else jaccard(shingles(a), shingles(b)) for a, b in zip(left, right, strict=True)]
    assert np.allclose(N.similarities(*packed, 5), want)


def test_pairs_under_the_similarity_stay_apart(spark):
    """Pairs of random edits: nearly all at 0.8 and above lose one document, none below does."""
    r = random.Random(9)
    texts = []
    for _ in range(500):
        base = [f"w{r.randint(0, 10**6)}" for _ in range(r.randint(150, 400))]
        texts += [" ".join(base), edited(base, r, r.choice([0.01, 0.02, 0.025, 0.03, 0.035, 0.04, 0.05]))]
    docs = spark.createDataFrame([(i, t, "x", "y") for i, t in enumerate(texts)], SCHEMA).repartition(4)
    ids = {x["doc_id"] for x in N.keep_one(docs).select("doc_id").collect()}
    similar = [jaccard(shingles(texts[i]), shingles(texts[i + 1])) for i in range(0, len(texts), 2)]
    assert set(range(0, len(texts), 2)) <= ids
    lost = [i not in ids for i in range(1, len(texts), 2)]
    near = [x for x, j in zip(lost, similar, strict=True) if j >= 0.8]
    border = [x for x, j in zip(lost, similar, strict=True) if 0.8 <= j < 0.85]
    under = [x for x, j in zip(lost, similar, strict=True) if j < 0.8]
    assert len(border) > 20 and len(under) > 50
    assert sum(near) >= 0.95 * len(near) and sum(border) >= 0.9 * len(border) and not any(under)


def test_long_texts_and_many_blocks_give_the_plain_bits():
    r = np.random.default_rng(5)
    texts = [" ".join(map(str, r.integers(0, 5000, n))) for n in (3, 259, 260, 514, 2000)] + [""]
    buffer = np.frombuffer("".join(texts).encode(), np.uint8)
    offsets = np.cumsum([0, *map(len, texts)])
    rows, hashes = N.shingle_sets(buffer, offsets, 5)
    prints, _ = N.fingerprints_of(buffer, offsets)
    for word, odd in enumerate(N.WIDEN[: N.BITS // 64]):
        for row in range(len(texts)):
            wide = N.A.mixed(N.A.mixed(hashes[rows == row] * odd)).tolist()
            assert int(prints[row, word]) == sum(1 << i for i in range(64) if 2 * sum(h >> i & 1 for h in wide) > len(wide))
    many = r.integers(0, 1 << 63, (64 * 130 + 5, N.BITS // 64), dtype=np.uint64)
    planes = N.planes_of(many)
    assert planes.shape == (N.BITS, 131)
    for j in (0, 63, 64, 1023):
        bits = (many[:, j // 64] >> np.uint64(j % 64)) & np.uint64(1)
        got = np.unpackbits(planes[j].view(np.uint8), bitorder="little")
        assert (got[: len(many)] == bits).all() and not got[len(many) :].any()


@pytest.mark.parametrize("tries", [1, 8])
def test_candidates_beyond_the_nearest_are_tried_too(spark, tries):
    """0 and 2 are alike, but each has a nearer candidate that isn't; 4 needs no proof against 2 once it is proved against 0."""
    bits = lambda *on: np.packbits(np.isin(np.arange(N.BITS), np.concatenate([np.arange(a, b) for a, b in on])), bitorder="little").tobytes()
    prints = [bits((0, 0)), bits((0, 130)), bits((200, 400)), bits((200, 530)), bits((600, 720))]
    same = " ".join(f"w{i}" for i in range(100))
    texts = [same, "other words " * 9, same + " x", "more of others " * 9, same + " y"]
    classes = spark.createDataFrame(list(zip(range(5), range(5), prints)), "id long, first long, print binary")
    rows = spark.createDataFrame([(i, t.encode()) for i, t in enumerate(texts)], "first long, text binary")
    candidates = spark.createDataFrame([(0, 1), (2, 3), (0, 2), (0, 4), (2, 4)], "a long, b long")
    found = {(r["a"], r["b"]) for r in N.proved(candidates, classes, rows, 5, 0.8, 0.08, tries=tries).collect()}
    assert (0, 4) in found and found & {(0, 2), (2, 4)}
    assert not found & {(0, 1), (2, 3)}


def test_pairs_between_trees_are_all_found():
    """Links within the sure radius join trees; of what is still in two, every pair of a bucket within the wide one comes, once."""
    r = np.random.default_rng(3)
    base = r.integers(0, 1 << 63, (3, N.BITS // 64), dtype=np.uint64)
    flips = lambda n, k: np.packbits(r.random((n, N.BITS)) < k / N.BITS, axis=1).view(np.uint64)
    prints = np.concatenate([base[0] ^ flips(200, 60), base[1] ^ flips(40, 45), base[2] ^ flips(30, 20), r.integers(0, 1 << 63, (60, N.BITS // 64), dtype=np.uint64)])
    order = r.permutation(len(prints))
    prints, n = prints[order], len(prints)
    bucket, trees = np.sort(r.integers(0, 3, n)), r.integers(0, 250, n)
    apart = np.bitwise_count(prints[:, None] ^ prints[None]).sum(2)
    together = bucket[:, None] == bucket[None]
    joined = together & ((trees[:, None] == trees[None]) | (apart <= 90))
    tree = N.roots(N.forest(n, *np.argwhere(joined).T)[0])
    want = {(a, b) for a, b in np.argwhere(together & (apart <= 110) & (tree[:, None] != tree[None])).tolist() if a < b}
    linked, *found = N.pairs_across(prints, bucket, trees, 110, 90, large=16, cells=64)
    assert all(apart[a, b] <= 90 for a, b in zip(*linked, strict=True))
    assert (N.roots(N.forest(n, *np.argwhere(together & (trees[:, None] == trees[None])).T)[0]) != tree).any()
    got = [(min(a, b), max(a, b)) for x, y in found for a, b in zip(x.tolist(), y.tolist(), strict=True)]
    assert len(want) > 100 and len(got) == len(set(got)) and set(got) == want


def test_links_in_no_spanning_forest_are_tried(spark, monkeypatch):
    """Two texts are alike, and both look like a third that isn't: a forest of the bucket holds them together by the third alone."""
    monkeypatch.setattr(N, "bands_for", lambda *_: (1, 3))
    r = random.Random(11)
    texts = []
    for _ in range(40):
        base = [f"w{r.randrange(10**6)}" for _ in range(300)]
        places, own = r.sample(range(10, 290, 10), 7), (base[:], base[:])
        for k, i in enumerate(places):
            own[0][i], own[1][i] = f"z{k}", f"z{k}" if k < 3 else f"y{k}"
        texts += [" ".join(base), *map(" ".join, own)]
    assert all(jaccard(*map(shingles, (texts[i], texts[i + k]))) < 0.8 <= jaccard(*map(shingles, texts[i + 1 : i + 3])) for i in range(0, 120, 3) for k in (1, 2))
    docs = spark.createDataFrame([(i, t, "x", "y") for i, t in enumerate(texts)], SCHEMA).repartition(4)
    ids = {x["doc_id"] for x in N.keep_one(docs).select("doc_id").collect()}
    assert set(range(0, 120, 3)) | set(range(1, 120, 3)) <= ids
    assert len(ids & set(range(2, 120, 3))) <= 1  # one band of a bit may part a pair
