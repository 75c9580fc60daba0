"""Benchmark decontamination: a broadcast hash set of normalised test n-grams is looked up for every window of the documents.

A word is a maximal run of a-z, 0-9 and code points from 0x80 on, after lower-casing A-Z. A window is `width` consecutive
words of a benchmark item; an item with fewer words, but not none, is one window. Hits of the hash set are verified by their
words. The set is broadcast if it takes at most `block_bytes` in a worker. A larger benchmark is cut into blocks of that size: block
after block is broadcast, one pass over the documents finds its hits, these are written and the block is let go; hits depend on a
text only and are gathered by its SHA-256. So a worker holds one block at a time and none is left out.

Defined cases: null or empty texts have no words and are never contaminated; items with a null id or no words are left out; ids are
told apart as strings; repeated documents are scanned each; other columns are carried along unread; an empty benchmark contaminates
nothing.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from runscope.llm import arrays as A
from runscope.llm.shared import beside_text, landed, ship, together

WORD = np.zeros(256, bool)
WORD[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
SLICE = 1 << 20
HIT = "struct<start:int,length:int,item:string>"
#: What a window takes in a worker besides its words.
WINDOW_BYTES = 300
SALTS = 16


def split(buffer: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Lower-cased bytes, begin and end of each word, and the row that each word is in."""
    low = A.LOWER[buffer]
    begins, ends = A.words(low, offsets, WORD)
    return low, begins, ends, np.searchsorted(offsets, begins, side="right") - 1


def _windows(width: int):
    """(item_id, text) -> (item_id, words, window): each item's different windows, their words joined by a space."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, sizes, out = [], [], []
            for item, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                buffer = np.frombuffer(text.as_buffer().to_pybytes() if text.is_valid else b"", np.uint8)
                low, begins, ends, _ = split(buffer, np.array([0, len(buffer)]))
                own = [low[b:e].tobytes() for b, e in zip(begins, ends, strict=True)]
                size = min(width, len(own))
                for window in {b" ".join(own[i : i + size]) for i in range(len(own) - size + 1)} if own else ():
                    ids.append(item)
                    sizes.append(size)
                    out.append(window)
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.string()), pa.array(sizes, pa.int32()), pa.array(out, pa.binary())], names=["item", "words", "window"])

    return run


def benchmark_windows(benchmark: DataFrame, width: int = 10, item_id: str = "item_id", text: str = "text") -> DataFrame:
    """(item, words, window) of every item that has an id and words."""
    ship(benchmark.sparkSession)
    items = benchmark.filter(F.col(item_id).isNotNull()).select(F.col(item_id).cast("string").alias("item"), F.col(text).cast("binary").alias("text"))
    return items.mapInArrow(_windows(width), "item string, words int, window binary").distinct()


class Block:
    """A part of the benchmark's windows: by number of words, a bitmap of hash prefixes and the windows by their hash."""

    BITS = 22

    def __init__(self, rows: list[tuple[str, int, bytes]]):
        self.sizes: dict[int, tuple[np.ndarray, dict[int, dict[bytes, list[str]]]]] = {}
        for size in {r[1] for r in rows}:
            own = [r for r in rows if r[1] == size]
            text = np.frombuffer(b" ".join(r[2] for r in own), np.uint8)
            low, begins, ends, _ = split(text, np.array([0, len(text)]))
            hashes = A.window_hashes(A.range_hashes(A.BYTE_VALUES[low], begins, ends), size)[::size]
            seen, bitmap = {}, np.zeros(1 << self.BITS, bool)
            bitmap[hashes >> np.uint64(64 - self.BITS)] = True
            for h, (item, _, window) in zip(hashes.tolist(), own, strict=True):
                seen.setdefault(h, {}).setdefault(window, []).append(item)
            self.sizes[size] = np.packbits(bitmap), seen

    def hits(self, low: np.ndarray, begins: np.ndarray, ends: np.ndarray, row: np.ndarray) -> list[tuple[int, int, str]]:
        """(first word, words, item) of each occurrence of a window inside one row."""
        out = []
        values = A.range_hashes(A.BYTE_VALUES[low], begins, ends)
        for size, (packed, seen) in self.sizes.items():
            hashes = A.window_hashes(values, size)
            if not len(hashes):
                continue
            bitmap = np.unpackbits(packed).view(bool)
            maybe = np.flatnonzero(bitmap[hashes >> np.uint64(64 - self.BITS)] & (row[: len(hashes)] == row[size - 1 :]))
            for i in maybe.tolist():
                if found := seen.get(int(hashes[i])):
                    window = b" ".join(low[b:e].tobytes() for b, e in zip(begins[i : i + size], ends[i : i + size], strict=True))
                    out += [(i, size, item) for item in found.get(window, ())]
        return out


def _hits(batch: pa.RecordBatch, block: Block) -> tuple[list[list[dict]], list[int]]:
    """Each row's hits of a block, and its number of words."""
    buffer, offsets = A.texts(batch.column("text"))
    hits: list[list[dict]] = []
    n_words: list[int] = []
    for first, end in A.slices(offsets, SLICE):
        at = offsets[first : end + 1]
        low, begins, ends, row = split(buffer[at[0] : at[-1]], at - at[0])
        starts = np.searchsorted(row, np.arange(end - first + 1))
        found: list[list[dict]] = [[] for _ in range(first, end)]
        for i, size, item in block.hits(low, begins, ends, row):
            found[row[i]].append({"start": int(i - starts[row[i]]), "length": size, "item": item})
        hits += found
        n_words += np.diff(starts).tolist()
    return hits, n_words


def _block_hits(block):
    """(text, sha) -> (sha, hits) of the texts that hold a window of the block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hits, _ = _hits(batch, block.value)
            some = np.flatnonzero([bool(x) for x in hits])
            yield pa.RecordBatch.from_arrays([batch.column("sha").take(pa.array(some)), pa.array([hits[i] for i in some.tolist()], HITS)], names=["sha", "hits"])

    return run


HITS = pa.list_(pa.struct([("start", pa.int32()), ("length", pa.int32()), ("item", pa.string())]))
COUNTS = "n_words long, n_hit long, n_items long, items_sha256 string"


def _counts(block):
    """(row, text[, hits]) -> (row, text, hits, numbers of words, hit words and items, digest of the items); hits of the block, or those given."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hits, n_words = _hits(batch, block.value if block else Block([]))
            if block is None:
                hits = [x or [] for x in batch.column("hits").to_pylist()]
            items = [sorted({h["item"] for h in x}) for x in hits]
            digests = [hashlib.sha256(",".join(x).encode()).hexdigest() for x in items]
            more = [pa.array(hits, HITS), pa.array(n_words, pa.int64()), pa.array([covered(x) for x in hits], pa.int64()), pa.array([len(x) for x in items], pa.int64()), pa.array(digests, pa.string())]
            yield pa.RecordBatch.from_arrays([batch.column("row"), batch.column("text"), *more], names=["row", "text", "hits", "n_words", "n_hit", "n_items", "items_sha256"])

    return run


def covered(hits: list[dict]) -> int:
    """Words that lie in any hit."""
    total = end = 0
    for start, size in sorted({(h["start"], h["length"]) for h in hits}):
        total += max(0, start + size - max(start, end))
        end = max(end, start + size)
    return total


def broadcast_block(windows: DataFrame):
    return windows.sparkSession.sparkContext.broadcast(Block([(r["item"], r["words"], bytes(r["window"])) for r in windows.collect()]))


def scan(docs: DataFrame, benchmark: DataFrame, row: Column, row_type: str, text: str = "text", width: int = 10, block_bytes: int = 128 << 20) -> DataFrame:
    """(row, text as binary, hits, n_words, n_hit, n_items, items_sha256) of every document; row: what to carry along.

    hits: start (first word, from 0), length in words and item of each occurrence of a window.
    """
    windows = landed(benchmark_windows(benchmark, width), "benchmark-windows")
    size = windows.agg(F.sum(F.octet_length("window") + WINDOW_BYTES)).first()[0] or 0
    blocks = max(1, -(-size // block_bytes))
    own = docs.select(row.alias("row"), F.col(text).cast("binary").alias("text"))
    schema = f"row {row_type}, text binary, hits array<{HIT}>, {COUNTS}"
    if blocks == 1:
        return own.mapInArrow(_counts(broadcast_block(windows)), schema)
    sha = F.sha2(F.coalesce(F.col("text"), F.lit(b"")), 256)
    found = []
    for b in range(blocks):
        block = broadcast_block(windows.filter(F.pmod(F.xxhash64("item", "window"), F.lit(blocks)) == b))
        texts = docs.select(F.col(text).cast("binary").alias("text")).withColumn("sha", sha)
        found.append(landed(texts.mapInArrow(_block_hits(block), f"sha string, hits array<{HIT}>").dropDuplicates(["sha"]), "block-hits"))
        block.destroy()
    # one text may hold most rows: those with hits are dealt over SALTS, and its hits go to each of them
    hits = reduce(DataFrame.unionByName, found).groupBy("sha").agg(F.flatten(F.collect_list("hits")).alias("hits"))
    hits = hits.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    dealt = own.withColumns({"sha": sha, "salt": F.pmod(F.monotonically_increasing_id(), F.lit(SALTS)).cast("int")})
    return dealt.join(hits, ["sha", "salt"], "left").select("row", "text", "hits").mapInArrow(_counts(None), schema)


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts without their hit words and what stands between hit words."""
    for batch in batches:
        out = []
        for text, hits in zip(batch.column("text"), batch.column("hits").to_pylist(), strict=True):
            whole = text.as_buffer().to_pybytes() if text.is_valid else None
            if whole and hits:
                buffer = np.frombuffer(whole, np.uint8)
                _, begins, ends, _ = split(buffer, np.array([0, len(buffer)]))
                kept, at = [], 0
                for h in sorted(hits, key=lambda h: (h["start"], h["length"])):
                    kept.append(whole[at : max(at, begins[h["start"]])])
                    at = max(at, int(ends[h["start"] + h["length"] - 1]))
                whole = b"".join([*kept, whole[at:]])
            out.append(whole)
        yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(out, pa.binary())], names=["row", "text"])


def remove_documents(docs: DataFrame, benchmark: DataFrame, text: str = "text", **how) -> DataFrame:
    """The documents, with all their columns, that hold no window of the benchmark."""
    row, kind = beside_text(docs, text)
    return together(docs, scan(docs, benchmark, row, kind, text, **how).filter("n_hit = 0"), text)


def remove_spans(docs: DataFrame, benchmark: DataFrame, text: str = "text", **how) -> DataFrame:
    """All documents, with all their columns, their texts without the hit words."""
    row, kind = beside_text(docs, text)
    return together(docs, scan(docs, benchmark, row, kind, text, **how).select("row", "text", "hits").mapInArrow(_cut, f"row {kind}, text binary"), text)
