"""Ranked lexical search: the best documents for each of a set of items, by branch and bound on trees of documents' term vectors.

A term is a maximal run of letters a-z (A-Z lower-cased), digits and code points from 0x80 on. One pass over the texts restricts each
document to the terms of the items: (doc_id, n: all its terms, terms, tfs), a table that is much smaller than the texts. Sums over it
give N, L and the document frequencies, which fix every term's weight and the order of terms, the most frequent first.

A task then cuts its documents into blocks of `block_postings` postings and builds an FP-tree of each: documents sorted by their terms
in that order share paths, a node is a common prefix that more than `leaf_docs` documents have, smaller ones under a node are put
together in leaves. A node holds, for each term of its documents, the most occurrences in one of them, and the least m. As a score
rises with tf and falls with m, these bound the score of all documents below. An item goes through the tree depth first, the highest
bound first, and leaves out all nodes whose bound is below its k-th best score so far in the task; leaves are scored exactly. Each task
sends k documents an item, whose best k are taken in two steps, the first over `SALTS` parts of an item.

Scores are 64-bit integers: the sum over an item's terms, repeats included, of w * ((1000000000 * tf) div (1000 * tf + 12 * m)), with
w = floor(1000 * ln((2N + 2) / (2df + 1))) and m = 75 + ((25 * n * N) div L).

Items are read to the workers in groups of `item_bytes` of text, a pass over the documents each; so their number is not bounded.

Defined cases: null and empty texts and those without terms are in no ranking and do not count in N; items without terms have no rows;
repeated rows are documents and items each; of equal scores the smaller doc_id comes first, null last; a null item_id is kept; scores of
0 are left out; empty tables give an empty result; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from runscope.llm import arrays as A
from runscope.llm.shared import landed, ship

TERM = np.zeros(256, bool)
TERM[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
SLICE = 1 << 20
SALTS = 64


class Vocabulary:
    """Terms by number; `find` looks words of a buffer up by their hash and compares their bytes."""

    def __init__(self, terms: list[bytes]):
        joined = np.frombuffer(b" ".join(terms), np.uint8)
        ends = np.cumsum([len(t) + 1 for t in terms]) - 1 if terms else np.zeros(0, np.int64)
        begins = ends - np.array([len(t) for t in terms], np.int64)
        hashes = A.range_hashes(A.BYTE_VALUES[joined], begins, ends) if terms else np.zeros(0, np.uint64)
        self.size = len(terms)
        self.joined, self.order = joined, np.argsort(hashes, kind="stable")
        self.hashes, self.begins, self.lengths = hashes[self.order], begins[self.order], (ends - begins)[self.order]
        if (self.hashes[1:] == self.hashes[:-1]).any():
            raise ValueError("two terms share a hash")

    def find(self, low: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which words are terms, and the number of the term of each of those."""
        if not self.size or not len(begins):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        hashes = A.range_hashes(A.BYTE_VALUES[low], begins, ends)
        at = np.minimum(np.searchsorted(self.hashes, hashes), self.size - 1)
        some = np.flatnonzero((self.hashes[at] == hashes) & (self.lengths[at] == ends - begins))
        at, lengths = at[some], self.lengths[at[some]]
        same = low[A.spread(begins[some], lengths)] == self.joined[A.spread(self.begins[at], lengths)]
        right = np.logical_and.reduceat(same, np.cumsum(lengths) - lengths) if len(some) else np.zeros(0, bool)
        return some[right], self.order[at[right]]


def terms_of(text: str | None) -> list[bytes]:
    buffer = A.LOWER[np.frombuffer((text or "").encode(), np.uint8)]
    begins, ends = A.words(buffer, np.array([0, len(buffer)]), TERM) if len(buffer) else (np.zeros(0, int),) * 2
    return [buffer[b:e].tobytes() for b, e in zip(begins, ends, strict=True)]


VECTOR = "n long, terms array<int>, tfs array<int>"


def _vectors(vocabulary):
    """(doc_id, text) -> (doc_id, n, terms: numbers, rising, tfs) of the documents that have terms."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            buffer, offsets = A.texts(batch.column("text"))
            for first, end in A.slices(offsets, SLICE):
                at = offsets[first : end + 1] - offsets[first]
                low = A.LOWER[buffer[offsets[first] : offsets[end]]]
                begins, ends = A.words(low, at, TERM)
                row = np.searchsorted(at, begins, side="right") - 1
                n = np.bincount(row, minlength=end - first)
                some, term = vocabulary.value.find(low, begins, ends)
                key, tf = np.unique(row[some] * max(1, vocabulary.value.size) + term, return_counts=True)
                of, term = np.divmod(key, max(1, vocabulary.value.size))
                kept = np.flatnonzero(n)
                borders = pa.array(np.append(np.searchsorted(of, kept), len(of)).astype(np.int32))
                lists = [pa.ListArray.from_arrays(borders, pa.array(x.astype(np.int32))) for x in (term, tf)]
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").take(pa.array(first + kept)), pa.array(n[kept].astype(np.int64)), *lists], names=["doc_id", "n", "terms", "tfs"])

    return run


@dataclass
class Node:
    """terms (places in the order, rising) of the documents below, and value: what one occurrence of a term's weight can count at most."""

    terms: np.ndarray
    tf: np.ndarray
    m: int
    value: np.ndarray = field(init=False)
    children: list[Node] = field(default_factory=list)
    #: Of leaves: the documents' places in the block, and by term the postings: local document and exact value.
    docs: np.ndarray | None = None
    starts: np.ndarray | None = None
    local: np.ndarray | None = None
    exact: np.ndarray | None = None

    def __post_init__(self):
        self.value = counted(self.tf, self.m)


def counted(tf: np.ndarray, m) -> np.ndarray:
    return (1_000_000_000 * tf) // (1000 * tf + 12 * m)


def _leaf(docs: np.ndarray, starts: np.ndarray, ends: np.ndarray, place: np.ndarray, tf: np.ndarray, m: np.ndarray) -> Node:
    lengths = ends[docs] - starts[docs]
    at = A.spread(starts[docs], lengths)
    local = np.repeat(np.arange(len(docs)), lengths)
    order = np.argsort(place[at], kind="stable")
    at, local = at[order], local[order]
    begins, _ = A.runs(np.append(True, place[at[1:]] != place[at[:-1]])) if len(at) else (np.zeros(0, np.int64),) * 2
    node = Node(place[at[begins]], np.maximum.reduceat(tf[at], begins) if len(at) else np.zeros(0, np.int64), int(m[docs].min()))
    node.docs, node.starts, node.local, node.exact = docs, np.append(begins, len(at)), local, counted(tf[at], m[docs[local]])
    return node


def _above(children: list[Node]) -> Node:
    terms = np.concatenate([c.terms for c in children])
    order = np.argsort(terms, kind="stable")
    terms, tf = terms[order], np.concatenate([c.tf for c in children])[order]
    begins, _ = A.runs(np.append(True, terms[1:] != terms[:-1]))
    node = Node(terms[begins], np.maximum.reduceat(tf, begins), min(c.m for c in children))
    node.children = children
    return node


def fp_tree(offsets: np.ndarray, place: np.ndarray, tf: np.ndarray, m: np.ndarray, leaf_docs: int) -> Node:
    """The tree of documents with terms `place` (rising in each document, one at least) and tf between their offsets."""
    starts, ends = offsets[:-1], offsets[1:]
    key = place.astype(">u4").tobytes()
    order = np.array(sorted(range(len(m)), key=lambda i: key[4 * starts[i] : 4 * ends[i]]), np.int64)
    # the length of the prefix that each document, in this order, shares with the one before
    lengths = (ends - starts)[order]
    at = A.spread(starts[order], lengths)
    depth = at - np.repeat(starts[order], lengths)
    before = np.append(order[0], order[:-1])
    shared = depth < np.repeat((ends - starts)[before], lengths)
    other = np.minimum(np.repeat(starts[before], lengths) + depth, len(place) - 1)
    apart = ~shared | (place[at] != place[other])
    common = np.minimum.reduceat(np.where(apart, depth, 1 << 40), np.cumsum(lengths) - lengths)
    common = np.minimum(common, lengths)

    def leaves(first: int, end: int) -> list[Node]:
        return [_leaf(order[i : min(end, i + leaf_docs)], starts, ends, place, tf, m) for i in range(first, end, leaf_docs)]

    def child_ranges(first: int, end: int) -> list[tuple[int, int, bool]]:
        """Documents under each branch of the node with documents first to end; small branches side by side are one range without a node."""
        own = common[first + 1 : end]
        cuts = [first, *(first + 1 + np.flatnonzero(own == own.min())).tolist(), end]
        out: list[tuple[int, int, bool]] = []
        for a, b in zip(cuts, cuts[1:], strict=False):
            large = b - a > leaf_docs
            if out and not large and not out[-1][2] and b - out[-1][0] <= leaf_docs:
                out[-1] = (out[-1][0], b, False)
            else:
                out.append((a, b, large))
        return out

    # depth first without recursion, as paths can be long: a node is made when all below it are
    root: list[Node] = []
    stack: list[tuple[int, int, list[Node], list[Node] | None]] = [(0, len(order), root, None)]
    while stack:
        first, end, into, below = stack.pop()
        if below is not None:
            into.append(_above(below))
        elif end - first <= leaf_docs:
            into.extend(leaves(first, end))
        else:
            made: list[Node] = []
            stack.append((first, end, into, made))
            stack.extend((a, b, made, None) for a, b, _ in child_ranges(first, end))
    return root[0]


class Best:
    """The k best documents of an item so far: (-score, without id, id), in order."""

    def __init__(self, k: int):
        self.k, self.rows = k, []
        self.least = 1  # the score that a document needs

    def add(self, scores: np.ndarray, docs: np.ndarray, ids: list) -> None:
        some = np.flatnonzero(scores >= self.least)
        if len(some):
            new = [(-int(s), ids[d] is None, 0 if ids[d] is None else ids[d]) for s, d in zip(scores[some], docs[some], strict=True)]
            self.rows = sorted(self.rows + new)[: self.k]
            if len(self.rows) == self.k:
                self.least = -self.rows[-1][0]


def _sum(node: Node, places: np.ndarray, weights: np.ndarray) -> int:
    """The bound of a node for an item."""
    at = np.searchsorted(node.terms, places)
    at[at == len(node.terms)] = 0
    return int(node.value[at] @ (weights * (node.terms[at] == places)))


def _scores(leaf: Node, places: np.ndarray, weights: np.ndarray) -> np.ndarray:
    at = np.minimum(np.searchsorted(leaf.terms, places), len(leaf.terms) - 1)
    known = leaf.terms[at] == places
    at, weights = at[known], weights[known]
    lengths = leaf.starts[at + 1] - leaf.starts[at]
    postings = A.spread(leaf.starts[at], lengths)
    out = np.zeros(len(leaf.docs), np.int64)
    np.add.at(out, leaf.local[postings], np.repeat(weights, lengths) * leaf.exact[postings])
    return out


def search(root: Node, places: np.ndarray, weights: np.ndarray, best: Best, ids: list) -> int:
    """Adds the tree's documents to best, depth first by the highest bound; returns how many were scored."""
    scored = 0
    stack = [(_sum(root, places, weights), root)]
    while stack:
        bound, node = stack.pop()
        if bound < best.least:
            continue
        if node.docs is not None:
            best.add(_scores(node, places, weights), node.docs, ids)
            scored += len(node.docs)
            continue
        below = [(_sum(c, places, weights), i) for i, c in enumerate(node.children)]
        stack.extend((b, node.children[i]) for b, i in sorted(below) if b >= best.least)
    return scored


@dataclass
class Model:
    """place: of each term in the order of frequency; items: (item, places rising, weight times occurrences); N and L."""

    place: np.ndarray
    items: list[tuple[int, np.ndarray, np.ndarray]]
    n_docs: int
    n_terms: int

    def m(self, n: np.ndarray) -> np.ndarray:
        if 25 * int(n.max()) * self.n_docs < 1 << 63:
            return 75 + (25 * n * self.n_docs) // self.n_terms
        return np.array([75 + 25 * x * self.n_docs // self.n_terms for x in n.tolist()], np.int64)


def trees(batch: pa.RecordBatch, model: Model, block_postings: int, leaf_docs: int) -> Iterator[tuple[Node, list]]:
    """An FP-tree of each block of a batch, and its documents' ids."""
    column = batch.column("terms")
    offsets = np.append(0, np.cumsum(column.value_lengths().to_numpy()))
    term, tf = column.flatten().to_numpy(), batch.column("tfs").flatten().to_numpy().astype(np.int64)
    row = np.repeat(np.arange(batch.num_rows), np.diff(offsets))
    place = model.place[term]
    order = np.argsort(row * len(model.place) + place, kind="stable")
    place, tf = place[order], tf[order]
    m = model.m(batch.column("n").to_numpy())
    for first, end in A.slices(offsets, block_postings):
        at = slice(offsets[first], offsets[end])
        yield fp_tree(offsets[first : end + 1] - offsets[first], place[at], tf[at], m[first:end], leaf_docs), batch.column("doc_id").slice(first, end - first).to_pylist()


def _search(model, k: int, block_postings: int, leaf_docs: int):
    """(doc_id, n, terms, tfs) -> (item, doc_id, score): each item's k best documents of this task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best, kind = {item: Best(k) for item, _, _ in model.value.items}, None
        for batch in batches:
            kind = batch.schema.field("doc_id").type
            if batch.num_rows:
                for root, ids in trees(batch, model.value, block_postings, leaf_docs):
                    for item, places, weights in model.value.items:
                        search(root, places, weights, best[item], ids)
        rows = [(item, None if row[1] else row[2], -row[0]) for item, own in best.items() for row in own.rows]
        if rows:
            item, doc, score = zip(*rows, strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(item, pa.int64()), pa.array(doc, kind), pa.array(score, pa.int64())], names=["item", "doc_id", "score"])

    return run


def _top(rows: DataFrame, k: int, *by: str) -> DataFrame:
    order = Window.partitionBy(*by).orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    return rows.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def ranked(docs: DataFrame, items: DataFrame, k: int = 20, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text", item_bytes: int = 16 << 20, block_postings: int = 1 << 20, leaf_docs: int = 64) -> DataFrame:
    """(item_id, rank, doc_id, score): the k best documents of each item."""
    spark = docs.sparkSession
    ship(spark)
    own = landed(items.select(F.col(item_id).alias("item_id"), F.col(item_text).alias("text")).withColumn("item", F.monotonically_increasing_id()), "search-items")
    groups = max(1, -(-(own.agg(F.sum(F.octet_length("text"))).first()[0] or 0) // item_bytes))
    texts = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    found = []
    for group in range(groups):
        rows = own.filter(F.pmod(F.xxhash64("item"), F.lit(groups)) == group).select("item", "text").collect()  # item_bytes of text
        found.append(_ranked_group(texts, [(r["item"], terms_of(r["text"])) for r in rows], k, block_postings, leaf_docs))
    best = _top(_top(reduce(DataFrame.unionByName, found), k, "item", "salt"), k, "item")
    return best.join(own.select("item", "item_id"), "item").select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")


def _ranked_group(texts: DataFrame, items: list[tuple[int, list[bytes]]], k: int, block_postings: int, leaf_docs: int) -> DataFrame:
    spark, kind = texts.sparkSession, dict(texts.dtypes)["doc_id"]
    terms = sorted({t for _, own in items for t in own})
    number = {t: i for i, t in enumerate(terms)}
    vectors = landed(texts.mapInArrow(_vectors(spark.sparkContext.broadcast(Vocabulary(terms))), f"doc_id {kind}, {VECTOR}"), "term-vectors")
    n_docs, n_terms = vectors.agg(F.count("*"), F.sum("n")).first()
    df = np.zeros(len(terms), np.int64)
    for row in vectors.select(F.explode("terms").alias("term")).groupBy("term").count().collect():  # the terms of a group of items
        df[row["term"]] = row["count"]
    weight = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * x + 1))) for x in df.tolist()], np.int64)
    place = np.empty(len(terms), np.int64)
    place[np.lexsort((np.arange(len(terms)), -df))] = np.arange(len(terms))
    own = []
    for item, words in items:
        if words:
            numbers, times = np.unique([number[w] for w in words], return_counts=True)
            order = np.argsort(place[numbers])
            own.append((item, place[numbers][order], (weight[numbers] * times)[order]))
    model = spark.sparkContext.broadcast(Model(place, own, n_docs, n_terms or 1))
    found = vectors.filter(F.size("terms") > 0).mapInArrow(_search(model, k, block_postings, leaf_docs), f"item long, doc_id {kind}, score long")
    return found.withColumn("salt", F.pmod(F.spark_partition_id(), F.lit(SALTS)))
