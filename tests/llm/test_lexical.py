"""Ranked lexical search against brute force."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from runscope.llm import lexical

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items, k=20):
    vectors = [(i, Counter(terms(t))) for i, t in docs]
    vectors = [(i, v) for i, v in vectors if v]
    n_docs, n_terms = len(vectors), sum(sum(v.values()) for _, v in vectors)
    df = Counter(t for _, v in vectors for t in v)
    out = []
    for item, text in items:
        words, rows = Counter(terms(text)), []
        for doc, v in vectors:
            m = 100 - 25 + (25 * sum(v.values()) * n_docs) // n_terms
            score = sum(c * math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((1000000000 * v[t]) // (1000 * v[t] + 12 * m)) for t, c in words.items() if t in v)
            if score > 0:
                rows.append((-score, doc is None, doc or 0))
        out += [(item, rank, None if none else doc, -score) for rank, (score, none, doc) in enumerate(sorted(rows)[:k], 1)]
    return sorted(out, key=str)


def sample(n, seed):
    r = random.Random(seed)
    words = [f"w{int(r.paretovariate(0.6)) % 300}" for _ in range(3000)] + ["Ünï", "İx", "a1", "B", "ÉTÉ"]
    text = lambda most: " ,".join(r.choice(words) for _ in range(r.randint(0, most)))
    docs = [(i * 3, text(60)) for i in range(n)]
    docs += [(10_000 + i, docs[0][1]) for i in range(150)] + [(20_000 + i, "w1 " * i) for i in range(70)]  # copies, and ties of one term
    docs += [(None, docs[5][1]), (None, None), (7, None), (8, ""), (9, ".,;"), (10, "zzz " * 3000 + "w1"), (12, docs[4][1]), (12, docs[4][1]), (13, "x" * 100_000 + " w2")]
    items = [(i, text(12)) for i in range(25)] + [(1, "w1 w1 w1 W1"), (None, "w2 é"), (50, ""), (51, None), (52, "w1 w1 w1 W1"), (53, "notfound"), (54, "ÉTÉ b"), (55, "zzz")]
    return docs, items


@pytest.mark.parametrize("how", [{}, {"block_postings": 700, "leaf_docs": 4}, {"item_bytes": 300, "leaf_docs": 16}])
def test_ranks_match_brute_force(spark, how):
    docs, items = sample(400, 1)
    d = spark.createDataFrame([(*row, 1, "x", 2, [1]) for row in docs], "doc_id long, text string, item long, score string, n long, terms array<int>").repartition(5)
    b = spark.createDataFrame([(*row, 3) for row in items], "item_id long, text string, rank int")
    got = sorted(map(tuple, lexical.ranked(d, b, **how).collect()), key=str)
    assert got == brute(docs, items)


def test_other_ids_and_k(spark):
    docs, items = sample(60, 2)
    named = [(None if i is None else f"d{i}", t) for i, t in docs]
    want = sorted([x for item, text in items for x in brute_named(named, item, text)], key=str)
    got = lexical.ranked(spark.createDataFrame(named, "name string, body string"), spark.createDataFrame(items, "item_id long, text string"), k=3, doc_id="name", text="body", leaf_docs=8)
    assert sorted(map(tuple, got.collect()), key=str) == want


def brute_named(docs, item, text):
    numbers = {d: i for i, d in enumerate(sorted({d for d, _ in docs if d is not None}))}
    names = {i: d for d, i in numbers.items()}
    rows = brute([(None if d is None else numbers[d] + 1, t) for d, t in docs], [(item, text)], 3)
    return [(i, rank, None if d is None else names[d - 1], s) for i, rank, d, s in rows]


def test_empty_tables(spark):
    docs, items = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string"), spark.createDataFrame([(1, "a")], "item_id long, text string")
    assert lexical.ranked(docs.limit(0), items).count() == 0
    assert lexical.ranked(docs, items.limit(0)).count() == 0
    assert lexical.ranked(docs.filter("text is null"), items).count() == 0
    assert lexical.ranked(docs, items).columns == ["item_id", "rank", "doc_id", "score"]


def test_bounds_leave_out_documents_but_none_that_counts(spark):
    """One item's best documents stand out: a third are never scored, and the bounds of nodes hold for all below."""
    r = np.random.default_rng(3)
    n, vocabulary = 4000, 200
    lists = [np.sort(r.choice(vocabulary, r.integers(1, 12), replace=False)) for _ in range(n)]
    offsets = np.append(0, np.cumsum([len(x) for x in lists]))
    place, tf, m = np.concatenate(lists), r.geometric(0.5, offsets[-1]).astype(np.int64), r.integers(76, 300, n)
    root = lexical.fp_tree(offsets, place, tf, m, 32)
    places, weights = np.array([3, 50, 120, 180]), np.array([100, 2000, 5000, 7000])
    scores = [sum(int(w) * int(lexical.counted(tf[i], m[d])) for i in range(offsets[d], offsets[d + 1]) for p, w in zip(places, weights, strict=True) if place[i] == p) for d in range(n)]
    best = lexical.Best(20)
    scored = lexical.search(root, places, weights, best, list(range(n)))
    assert [(-s, d) for s, _, d in best.rows] == sorted(((s, d) for d, s in enumerate(scores)), key=lambda x: (-x[0], x[1]))[:20]
    assert scored < 0.7 * n

    def walk(node):
        docs = node.docs.tolist() if node.docs is not None else [d for c in node.children for d in walk(c)]
        assert lexical._sum(node, places, weights) >= max(scores[d] for d in docs)
        return docs

    assert sorted(walk(root)) == list(range(n))


def test_query_reads_its_tables(spark):
    from runscope.llm import queries

    out = queries.op11_lexical_search(spark, "/root/testdata/sf0.001")
    assert out.groupBy("item_id").agg(F.max("rank").alias("r")).filter("r > 20").count() == 0
