"""Suffix-array dedup: bytes in any string of `width` bytes that also starts elsewhere are removed.

Suffixes are taken where a window of `width` bytes has its minimiser, the least hash of `gram` bytes in it: windows with one
content then have their suffix at one place in them, and about one suffix stands for ninety bytes of text, with the windows
around it in one packed run (see repeats). All byte suffixes would shuffle some two hundred times the text.

Sampled splitters range-partition the suffixes by their leading token, the first 8 bytes; as many may share it, a range is dealt over
WITHIN buckets by the minimiser, the first 16 bytes. A bucket sorts its suffixes by
multikey quicksort, with 8 bytes as one character, and the texts before them, read backwards, in the same way. Common prefixes of
neighbours in the two orders tell how far each suffix agrees with any other to the right and to the left, and so which windows can
repeat; a window repeats if another suffix lies in the same interval of both orders: that of the prefixes of its right part and that of its
left part. The orders decide in every slice and bucket; what a task has sent before is known to it again by a hash and then its bytes
(`repeats.Seen`), which spares sending it for each slice. Suffixes with one leading token are never parted by a splitter, so suffixes
on two sides of a boundary differ in their first 8 bytes, and in two buckets of a range in their first 16: no window's two places
are in two buckets.

Inside a task the same is done for each slice of text before anything is sent.

Defined cases: texts are UTF-8 bytes, null is empty; matches never cross documents but may lie in one document; repeated rows are
each other's copies; a null doc_id is a document like any other; other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import dataclasses
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from runscope.llm import arrays as A
from runscope.llm import repeats as R
from runscope.llm.shared import discard, landed


def multikey_sort(text: np.ndarray, suffixes: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes in the order of their first `depth` bytes, and how many bytes each shares with the one before it.

    Multikey quicksort with 8-byte characters: the ranges that still agree are each parted by their next character.
    """
    chars = R.characters(text)
    order = np.arange(len(suffixes))
    shared = np.zeros(len(suffixes), np.int64)
    tied = np.arange(len(suffixes))  # places in order that agree with a neighbour so far
    group = np.zeros(len(suffixes), np.int64)
    for done in range(0, depth, 8):
        if not len(tied):
            break
        at = np.minimum(suffixes[order[tied]] + done, len(text))
        char = chars[at].astype(np.uint64)
        by = np.lexsort((char, group))
        order[tied], char = order[tied][by], char[by]
        same_group = np.append(False, group[1:] == group[:-1])[: len(group)]
        differs = np.append(True, char[1:] != char[:-1])[: len(char)]
        parted = np.flatnonzero(same_group & differs)
        shared[tied[parted]] = done + common_bytes(char[parted], char[parted - 1])
        shared[tied[same_group & ~differs]] = done + 8
        first, last = A.runs(~same_group | differs)
        size = np.repeat(last - first, last - first)
        group = np.repeat(np.arange(len(first)), last - first)[size > 1]
        tied = tied[size > 1]
    return order, np.minimum(shared, depth)


def common_bytes(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Leading bytes that two different characters share."""
    x, out = a ^ b, np.zeros(len(a), np.int64)
    for n in range(1, 8):
        out += x >> np.uint64(64 - 8 * n) == 0
    return out


def reach(shared: np.ndarray, order: np.ndarray) -> np.ndarray:
    """For each suffix, the most bytes that it shares with any other: with a neighbour in the order."""
    out = np.zeros(len(shared), np.int64)
    out[order] = np.maximum(shared, np.append(shared[1:], 0)[: len(shared)])
    return out


def suffix_classes(width: int):
    """Classes of equal windows, from the order of their suffixes and of what stands before these."""

    def classes(units: R.Units, runs: R.Runs) -> tuple[np.ndarray, np.ndarray]:
        n, text = len(runs.first), units.plain
        backwards = np.ascontiguousarray(text[::-1])
        right, shared_right = multikey_sort(text, runs.anchor, width)
        left, shared_left = multikey_sort(backwards, len(text) - runs.anchor, width)
        # a window `back` bytes before its suffix repeats only if that many agree to the left, and the others to the right
        most = runs.anchor - runs.first
        low = np.maximum(most - runs.windows + 1, width - reach(shared_right, right))
        high = np.minimum(most, reach(shared_left, left))
        count = np.maximum(high - low + 1, 0)
        run, back = np.repeat(np.arange(n), count), A.spread(low, count)
        by_back = np.argsort(back, kind="stable")
        run, back = run[by_back], back[by_back]
        in_right, in_left = (np.argsort(order, kind="stable") for order in (right, left))
        windows, numbers, total = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], 0
        first, last = A.runs(np.append(True, back[1:] != back[:-1])[: len(back)])
        before = np.cumsum(runs.windows) - runs.windows
        for i, j in zip(first.tolist(), last.tolist(), strict=True):
            own, b = run[i:j], int(back[i])
            both = interval(shared_left, b)[in_left[own]] * n + interval(shared_right, width - b)[in_right[own]]
            some = np.flatnonzero(R.equal_before(both))
            different, number = np.unique(both[some], return_inverse=True)
            windows.append(before[own[some]] + most[own[some]] - b)
            numbers.append(total + number)
            total += len(different)
        return np.concatenate(windows), np.concatenate(numbers)

    return classes


def interval(shared: np.ndarray, depth: int) -> np.ndarray:
    """For each place in an order of suffixes, the first one that agrees with it in `depth` bytes."""
    return np.maximum.accumulate(np.where(shared < depth, np.arange(len(shared)), 0))


#: Buckets that one range of leading tokens is dealt over by the minimiser, as many suffixes may share their first 8 bytes.
WITHIN = 4


def splitters(how: R.How, sizes: R.Sizes, hot, each: int = 200) -> np.ndarray:
    """Leading tokens that part the suffixes evenly into sizes.buckets / WITHIN ranges, of about `each` leads a range of the sample."""
    ranges = -(-sizes.buckets // WITHIN)
    if ranges == 1:
        return np.zeros(0, np.uint64)
    expected = sizes.bytes * sizes.share / 80
    leads = R.sampled_leads(how, sizes, hot)
    return parted(leads.sample(each * ranges / expected, seed=3) if expected > each * ranges else leads, ranges)


def parted(leads: DataFrame, ranges: int) -> np.ndarray:
    """Edges that part numbers (one column of longs, their bits unsigned) into ranges of like sizes.

    They are sorted by Spark, and the driver gets the edges alone, 8 bytes a range: so there are as many ranges as the input asks for.
    """
    name = leads.columns[0]
    shifted = leads.select(F.col(name).bitwiseXOR(F.lit(-(1 << 63))).alias("lead"))  # signed order of these is unsigned order
    ordered = landed(shifted.orderBy("lead").withColumn("at", F.monotonically_increasing_id()), "leads")
    part = F.shiftright("at", 33)
    sums = ordered.groupBy(part.alias("part")).agg(F.count("*").alias("n"))
    total = sums.agg(F.sum("n")).first()[0] or 0
    before = sums.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("before"))
    place = F.col("before") + F.col("at").bitwiseAND(F.lit((1 << 33) - 1))
    cut = lambda x: F.floor(x * ranges / total)  # noqa: E731  the range of a place
    edges = ordered.join(before, part == F.col("part")).filter((place > 0) & (cut(place) > cut(place - 1))).select("lead").collect() if total else []
    discard(ordered)
    return np.sort(np.array([r[0] ^ -(1 << 63) for r in edges], np.int64).view(np.uint64))


def _kept(width: int):
    """(row, text, spans) -> (row, remaining bytes, number of bytes, number removed, runs removed, sha256)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept, counts, removed, runs, digests = [], [], [], [], []
            for text, spans in zip(batch.column("text"), batch.column("spans"), strict=True):
                whole = text.as_buffer().to_pybytes()
                cuts = R.merged(spans.as_py(), width) if spans.is_valid else []
                left, at = [], 0
                for begin, end in cuts:
                    left.append(whole[at:begin])
                    at = end
                kept.append(b"".join([*left, whole[at:]]))
                counts.append(len(whole))
                removed.append(sum(e - b for b, e in cuts))
                runs.append(len(cuts))
                digests.append(hashlib.sha256(kept[-1]).hexdigest())
            out = [batch.column("row"), pa.array(kept, pa.binary()), *(pa.array(x, pa.int64()) for x in (counts, removed, runs)), pa.array(digests)]
            yield pa.RecordBatch.from_arrays(out, names=["row", "kept", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    return run


def dedup(docs: DataFrame, row: Column, row_type: str, doc_id: str = "doc_id", text: str = "text", width: int = 200, gram: int = 16) -> DataFrame:
    """(row, kept as binary, n_bytes, n_removed, n_spans, kept_sha256) for every document; row: what to carry along."""
    sizes = R.Sizes.of(docs, text)
    context = docs.sparkSession.sparkContext
    how = R.How(width, gram, False, False, suffix_classes(width), None)
    R.ship(docs.sparkSession)
    hot = R.hot_grams(how, sizes, unit_bytes=1)
    edges = context.broadcast(splitters(how, sizes, hot))  # 8 bytes for each bucket

    def bucket_of(units, key, anchor):
        part = np.searchsorted(edges.value, R.characters(units.plain)[anchor].astype(np.uint64), side="right")
        return part * WITHIN + (key % np.uint64(WITHIN)).astype(np.int64)

    how = dataclasses.replace(how, bucket_of=bucket_of)
    spans = R.removed(docs, doc_id, text, how, sizes, hot, part=R.BUCKET_BYTES)
    schema = f"row {row_type}, kept binary, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    return R.with_spans(docs, row, spans, doc_id, text).mapInArrow(_kept(width), schema)
