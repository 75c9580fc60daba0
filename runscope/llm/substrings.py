"""Substring dedup by super-k-mers: windows of words that a smaller document holds too are removed.

A window is `width` consecutive words. Windows that share a minimiser travel as one packed string to its bucket (see repeats),
where sorting finds the windows that repeat and the smallest document that each starts in. Windows are sorted by a 64-bit hash and
those of one hash are compared byte by byte, in tasks before the shuffle as in buckets: what is removed does not depend on hashes
or on partitions.

Defined cases: words are runs of bytes other than `[\\x20\\x09-\\x0D]`; null or empty texts have none; a null doc_id is larger than all
others; rows of one doc_id never remove each other's words; windows never cross documents; other columns are ignored; an empty
table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame

from runscope.llm import repeats as R


def _kept(width: int):
    """(row, text, spans) -> (row, kept words joined by a space, number of words, number removed, sha256)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept, counts, removed, digests = [], [], [], []
            for text, spans in zip(batch.column("text"), batch.column("spans"), strict=True):
                words = text.as_buffer().to_pybytes().split()  # bytes.split() knows these blanks only
                n, gone = len(words), 0
                if spans.is_valid:
                    left, at = [], 0
                    for begin, end in R.merged(spans.as_py(), width):
                        left += words[at:begin]
                        gone, at = gone + end - begin, end
                    words = left + words[at:]
                kept.append(b" ".join(words))
                counts.append(n)
                removed.append(gone)
                digests.append(hashlib.sha256(kept[-1]).hexdigest())
            out = [batch.column("row"), pa.array(kept, pa.binary()), pa.array(counts, pa.int64()), pa.array(removed, pa.int64()), pa.array(digests)]
            yield pa.RecordBatch.from_arrays(out, names=["row", "kept", "n_words", "n_removed", "kept_sha256"])

    return run


def dedup(docs: DataFrame, row: Column, row_type: str, doc_id: str = "doc_id", text: str = "text", width: int = 50, gram: int = 5) -> DataFrame:
    """(row, kept as binary, n_words, n_removed, kept_sha256) for every document; row: what to carry along."""
    sizes = R.Sizes.of(docs, text, 2 * R.BUCKET_BYTES)  # a bucket is compared in parts of 1 MB, which takes little besides
    buckets = sizes.buckets

    def bucket_of(units, key, anchor):
        return key % np.uint64(buckets)

    how = R.How(width, gram, True, True, R.hashed_classes(width), bucket_of)
    R.ship(docs.sparkSession)
    spans = R.removed(docs, doc_id, text, how, sizes, R.hot_grams(how, sizes, unit_bytes=6), part=1 << 20)
    schema = f"row {row_type}, kept binary, n_words long, n_removed long, kept_sha256 string"
    return R.with_spans(docs, row, spans, doc_id, text).mapInArrow(_kept(width), schema)
