"""Mixing sources against a plain computation of targets, and the schedule against its points."""

import re
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from runscope.llm import mixing

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def targets(sizes, weights=(5, 2, 1), most=3):
    """Target of each source: shares by weight, stopped at `most` times the size, the excess reshared until none is above."""
    names = sorted([s for s in sizes if s is not None], key=lambda s: s.encode()) + [s for s in sizes if s is None]
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    out, open_, left = {}, set(names), sum(sizes.values())
    while open_:
        level = left / sum(weight[s] for s in open_)
        full = {s for s in open_ if most * sizes[s] <= level * weight[s]}
        if not full:
            return out | {s: level * weight[s] for s in open_}
        out |= {s: float(most * sizes[s]) for s in full}
        left -= sum(most * sizes[s] for s in full)
        open_ -= full
    return out


def sample(seed=1):
    r = np.random.default_rng(seed)
    rows = []
    for i in range(600):
        source = "hot" if i % 3 == 0 else ["a", "Z", "é", "b c", "", None, "tiny", "\U0001f600", "￿"][int(r.integers(0, 9))]
        words = int(r.geometric(0.02)) if source != "tiny" else 1
        rows.append((i, "\t".join(f"w{j}" for j in range(words)), source))
    rows += [(906, "same text here", "a")] * 3 + [(None, "no id", "a"), (900, None, "a"), (901, "", "b c"), (902, " \n\t\x0b ", None), (903, None, "only empty"), (904, "word word 　x", "a")]
    rows.append((905, "long " * 30_000, "hot"))
    return rows


SCHEMA = "doc_id long, text string, source string, size string, target int, row int, number int, salt int, rank long"


def frame(spark, rows, parts=5):
    return spark.createDataFrame([(*r, "x", 1, 2, 3, 4, 5) for r in rows], SCHEMA).repartition(parts)


@pytest.mark.parametrize("how", [{}, {"block_words": 50, "slice_rows": 20}, {"block_words": 1, "weights": (1,), "most_epochs": 1}, {"block_words": 300, "weights": (90, 1, 1, 1), "most_epochs": 2}])
def test_targets_and_taken_words(spark, how):
    rows = sample()
    words = lambda t: len(WORD.findall(t or ""))
    sizes = defaultdict(int)
    for _, text, source in rows:
        sizes[source] += words(text)
    want = targets(sizes, how.get("weights", (5, 2, 1)), how.get("most_epochs", 3))
    mix = mixing.mix(frame(spark, rows), **how)
    got = mix.documents.collect()
    ids = lambda x: -1 if x is None else x
    assert sorted((ids(g["doc_id"]), g["size"]) for g in got) == sorted((ids(i), words(t)) for i, t, _ in rows)
    source_of = {i: s for i, _, s in rows}
    taken = defaultdict(int)
    for g in got:
        source = source_of[g["doc_id"]]
        assert g["source_size"] == sizes[source] and g["target"] == pytest.approx(want[source], rel=1e-12)
        assert 0 <= g["taken"] <= how.get("most_epochs", 3) * g["size"]
        taken[source] += g["taken"]
    for source, target in want.items():
        assert abs(taken[source] - target) <= 0.5001
    # pieces fill their blocks without gaps, and each epoch takes a word once at most
    pieces = mix.pieces.collect()
    blocks, spans = defaultdict(list), defaultdict(list)
    for p in pieces:
        blocks[p["slot"]].append((p["place"], p["length"], p["source"]))
        if p["doc_id"] is not None and p["doc_id"] != 906:
            spans[p["doc_id"], p["epoch"]].append((p["start"], p["length"]))
    size = how.get("block_words", 4096)
    for own in blocks.values():
        own.sort(key=lambda x: x[:2])
        assert [a + n for a, n, _ in own[:-1]] == [a for a, _, _ in own[1:]] and own[0][0] == 0 and sum(n for _, n, _ in own) <= size and len({s for *_, s in own}) == 1
    assert sum(sum(n for _, n, _ in own) < size for own in blocks.values()) <= len(want)
    for own in spans.values():
        own.sort()
        assert all(a + n <= b for (a, n), (b, _) in zip(own, own[1:], strict=False))


def test_reruns_agree(spark):
    rows = sample(2)
    key = lambda d: sorted(map(str, d.collect()))
    one, two = mixing.mix(frame(spark, rows, 3), block_words=64), mixing.mix(frame(spark, rows[::-1], 7), block_words=64)
    assert key(one.documents) == key(two.documents) and key(one.pieces) == key(two.pieces)


def test_every_stretch_of_slots_is_near_the_weights(spark):
    rows = [(i, "w " * 40, s) for i in range(900) for s in ("a", "b", "c")]
    pieces = mixing.mix(frame(spark, rows), block_words=40).pieces
    order = [r["source"] for r in pieces.orderBy("slot", "place").collect()]
    shares = [order[:n].count("a") / n for n in (100, 200, 400, 800, 1600)]
    assert all(abs(x - 5 / 8) < 0.03 for x in shares)
    half = order[37 : 37 + 160]
    assert abs(half.count("c") / 160 - 1 / 8) < 0.04


def test_nothing_to_mix(spark):
    empty = mixing.mix(frame(spark, sample()).limit(0))
    assert empty.documents.count() == 0 and empty.pieces.count() == 0
    blank = mixing.mix(frame(spark, [(1, None, "a"), (2, "", None)]))
    assert sorted(map(tuple, blank.documents.collect())) == [(1, 0, 0, 0.0, 0), (2, 0, 0, 0.0, 0)] and blank.pieces.count() == 0


def test_slots_of_ranks():
    """The slots of an interval of points, by reversing the bits of every slot."""
    bits = mixing.BITS
    slots = np.arange(1 << 12)
    points = np.array([int(format(i, f"0{bits}b")[::-1], 2) for i in slots.tolist()])
    r = np.random.default_rng(4)
    borders = [0, *sorted(int(x) for x in r.integers(1, 1 << bits, 12)), 1 << bits]
    for first, end in zip(borders, borders[1:], strict=False):
        want = slots[(points >= first) & (points < end)]
        got = mixing.slots_of(np.full(len(want), first), np.full(len(want), end), np.arange(len(want)))
        assert got.tolist() == want.tolist()


def test_words(spark):
    texts = [None, "", " ", "a", " a  b\x0bc\r\nd e ", "　"]
    got = [r[0] for r in spark.createDataFrame([(t,) for t in texts], "text string").select(mixing.words_in(F.col("text"))).collect()]
    assert got == [len(WORD.findall(t or "")) for t in texts]
