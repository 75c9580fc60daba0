"""SimHash near-dedup: 64-bit fingerprints of shingles, linked at a small Hamming distance, one document kept for each group.

Fingerprints: text with A-Z lower-cased is split at `[\\x20\\x09-\\x0D]+`; each `shingle` consecutive words, joined by a space, is
hashed with XXH64 (seed 42); a bit is set if over half of the hashes have it. A text of fewer words is one shingle, one without
words has fingerprint zero.

Links: different fingerprints only are compared. Cut into four parts of 16 bits, two fingerprints at most 2 bits apart agree in
two parts at least, so each fingerprint goes to the six buckets of two of its parts. A bucket with more than `bucket_rows` is
cut again by the same rule over the remaining 32 bits (three parts, one must agree), which loses no link. In a bucket
fingerprints are held bit-sliced: plane j has bit j of 64 fingerprints in a word; the planes that differ from a query are
added to all distances at once by carry-save counters, and blocks of 64 in which all exceed the radius are abandoned. A bucket
gives a spanning forest of its links, never all its pairs.

Defined cases: null or empty texts have fingerprint zero and link like any other; a null doc_id is never a component's id unless
all of its documents' are null; repeated rows share a fingerprint; other columns are ignored; an empty table gives none.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from runscope.llm import arrays as A
from runscope.llm.components import connected_components
from runscope.llm.shared import landed, ship

SLICE = 1 << 20
ONE = np.uint64(1)


def fingerprints_of(buffer: np.ndarray, offsets: np.ndarray, shingle: int = 3) -> np.ndarray:
    """The fingerprint of each row of a text buffer."""
    import xxhash

    digest = xxhash.xxh64_intdigest
    out = np.zeros(len(offsets) - 1, np.uint64)
    low = A.LOWER[buffer]
    begins, ends = A.words(low, offsets, ~A.SPACE)
    row = np.searchsorted(offsets, begins, side="right") - 1
    firsts = np.searchsorted(row, np.arange(len(out) + 1))
    # words with one space after each: a shingle is then one range of bytes
    sizes = ends - begins
    plain = np.full(int(sizes.sum()) + len(sizes), 0x20, np.uint8)
    at = np.cumsum(sizes + 1) - sizes - 1
    plain[A.spread(at, sizes)] = low[A.spread(begins, sizes)]
    whole = plain.tobytes()
    starts, stops = at.tolist(), (at + sizes).tolist()
    for r in range(len(out)):
        first, last = int(firsts[r]), int(firsts[r + 1])
        if last == first:
            continue
        size = min(shingle, last - first)
        hashes = np.array([digest(whole[a:b], 42) for a, b in zip(starts[first : last - size + 1], stops[first + size - 1 : last], strict=True)], np.uint64)
        bits = np.zeros(64, np.int64)
        for part in range(0, len(hashes), 4096):
            bits += np.unpackbits(hashes[part : part + 4096].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
        out[r] = np.packbits(bits * 2 > len(hashes), bitorder="little").view(np.uint64)[0]
    return out


def _fingerprints(shingle: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            buffer, offsets = A.texts(batch.column(1))
            parts = [np.zeros(0, np.uint64)]
            for first, last in A.slices(offsets, SLICE):
                at = offsets[first : last + 1]
                parts.append(fingerprints_of(buffer[at[0] : at[-1]], at - at[0], shingle))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.concatenate(parts).view(np.int64))], names=["doc_id", "print"])

    return run


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = 3) -> DataFrame:
    """(doc_id, print: the fingerprint as a signed long)."""
    ship(docs.sparkSession)
    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("binary").alias("text")).mapInArrow(_fingerprints(shingle), "doc_id long, print long")


def planes(prints: np.ndarray) -> np.ndarray:
    """[64, blocks] words: bit i of word b of plane j is bit j of fingerprint 64 b + i."""
    blocks = -(-len(prints) // 64)
    padded = np.zeros(blocks * 64, np.uint64)
    padded[: len(prints)] = prints
    bits = np.unpackbits(padded.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")  # fingerprint x bit
    return np.packbits(np.ascontiguousarray(bits.T).reshape(64, blocks, 64), axis=2, bitorder="little").copy().view(np.uint64).reshape(64, blocks)


def within_radius(prints: np.ndarray, query: np.ndarray, block: np.ndarray, sliced: np.ndarray, radius: int = 2, step: int = 8) -> tuple[np.ndarray, np.ndarray]:
    """(query, lane) with a distance of at most radius (3 at most), of the fingerprints prints[query] to all lanes of their blocks.

    step: planes between two looks for dead blocks.
    """
    ones, twos, over = (np.zeros(len(query), np.uint64) for _ in range(3))
    for j in range(64):
        x = sliced[j, block] ^ (np.uint64(0) - ((prints[query] >> np.uint64(j)) & ONE))
        carry = ones & x
        ones ^= x
        over |= twos & carry
        twos ^= carry
        if j % step == step - 1:
            live = beyond(ones, twos, over, radius) != ~np.uint64(0)
            if not live.all():
                query, block, ones, twos, over = query[live], block[live], ones[live], twos[live], over[live]
            if not len(query):
                break
    near = ~beyond(ones, twos, over, radius)
    bits = np.unpackbits(near.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    at, lane = np.nonzero(bits)
    return query[at], block[at] * 64 + lane


def beyond(ones: np.ndarray, twos: np.ndarray, over: np.ndarray, radius: int) -> np.ndarray:
    """Lanes whose counter (over: 4 or more) exceeds the radius."""
    return {0: over | twos | ones, 1: over | twos, 2: over | (twos & ones), 3: over}[radius]


def forest(n: int, a: np.ndarray, b: np.ndarray, parent: np.ndarray | None = None) -> tuple[np.ndarray, list[tuple[int, int]]]:
    """Union-find over pairs of places: the parents, and the pairs that joined two trees."""
    up = list(range(n)) if parent is None else parent.tolist()

    def root(i: int) -> int:
        while up[i] != i:
            up[i] = up[up[i]]
            i = up[i]
        return i

    joined = []
    for x, y in zip(a.tolist(), b.tolist(), strict=True):
        rx, ry = root(x), root(y)
        if rx != ry:
            up[max(rx, ry)] = min(rx, ry)
            joined.append((x, y))
    return np.array(up, np.int64), joined


def links_in(prints: np.ndarray, bucket: np.ndarray, radius: int = 2, cells: int = 1 << 18) -> list[tuple[int, int]]:
    """A spanning forest of the links inside each bucket, as places; bucket: sorted, one for each fingerprint."""
    n = len(prints)
    first, last = A.runs(np.append(True, bucket[1:] != bucket[:-1])[:n])
    sizes = last - first
    blocks = -(-sizes // 64)
    block0 = np.repeat(np.cumsum(blocks) - blocks, sizes)
    rank = np.arange(n) - np.repeat(first, sizes)
    lane = block0 * 64 + rank
    row_at = np.full(int(blocks.sum()) * 64, -1, np.int64)
    row_at[lane] = np.arange(n)
    padded = np.zeros(len(row_at), np.uint64)
    padded[lane] = prints
    sliced, parent, out = planes(padded), np.arange(n), []
    # a link is seen from its later fingerprint: blocks after its own are not needed
    needed = rank // 64 + 1
    done = np.cumsum(needed)
    begin = 0
    while begin < n:
        end = max(begin + 1, int(np.searchsorted(done, (done[begin - 1] if begin else 0) + cells, side="right")))
        query = np.repeat(np.arange(begin, end), needed[begin:end])
        q, at = within_radius(prints, query, A.spread(block0[begin:end], needed[begin:end]), sliced, radius)
        other = row_at[at]
        keep = (other >= 0) & (other < q)
        parent, new = forest(n, q[keep], other[keep], parent)
        out += new
        begin = end
    return out


def _bucket_links(radius: int, together: int = 1 << 14):
    """Links in each bucket. Rows come sorted by bucket; whole buckets with about `together` rows are compared at a time."""

    def links(rows: list[np.ndarray]) -> pa.RecordBatch:
        kinds, buckets, ids, prints = (np.concatenate(x) for x in zip(*rows, strict=True))
        change = np.append(True, (np.diff(buckets) != 0) | (np.diff(kinds) != 0))[: len(ids)]
        pairs = np.array(links_in(prints.view(np.uint64), np.cumsum(change), radius), np.int64).reshape(-1, 2)
        return pa.RecordBatch.from_arrays([pa.array(ids[pairs[:, 0]]), pa.array(ids[pairs[:, 1]])], names=["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, ...]] = []
        count = 0
        for batch in batches:
            held.append(tuple(batch.column(c).to_numpy().copy() for c in ("kind", "bucket", "id", "print")))
            count += batch.num_rows
            if count < together:
                continue
            kinds, buckets, ids, prints = (np.concatenate(x) for x in zip(*held, strict=True))
            whole = int(np.flatnonzero((kinds == kinds[-1]) & (buckets == buckets[-1]))[0])  # the last bucket may go on
            if whole:
                yield links([(kinds[:whole], buckets[:whole], ids[:whole], prints[:whole])])
            held, count = [(kinds[whole:], buckets[whole:], ids[whole:], prints[whole:])], len(ids) - whole
        if count:
            yield links(held)

    return run


def _parts(mask_bits: list[tuple[int, int]]) -> list[int]:
    return [((1 << width) - 1) << shift for shift, width in mask_bits]


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def links(classes: DataFrame, radius: int = 2, bucket_rows: int = 20_000) -> DataFrame:
    """(a, b) ids of different fingerprints at most `radius` (2 at most) bits apart: a spanning forest of each bucket's links.

    classes: id, print; each print once.
    """
    pairs = [sum(p) for p in combinations(_parts([(0, 16), (16, 16), (32, 16), (48, 16)]), 2)]
    rows = classes.select("id", "print", F.explode(F.array(*[F.struct(F.lit(k).alias("kind"), F.col("print").bitwiseAND(F.lit(_signed(m))).alias("bucket")) for k, m in enumerate(pairs)])).alias("at")).select("id", "print", "at.kind", "at.bucket")
    sizes = rows.groupBy("kind", "bucket").count()
    # alone in a bucket: nothing to compare; too many: cut again
    rows = rows.join(sizes.filter("count > 1"), ["kind", "bucket"])
    plain = rows.filter(F.col("count") <= bucket_rows).select("kind", "bucket", "id", "print")
    thirds = []
    for k, m in enumerate(pairs):
        free = [j for j in range(64) if not m >> j & 1]
        for t in range(3):
            extra = sum(1 << j for j in free[t * 11 : (t + 1) * 11])
            thirds.append((k, F.struct(F.lit(len(pairs) * (t + 1) + k).alias("kind"), F.col("print").bitwiseAND(F.lit(_signed(m | extra))).alias("bucket"))))
    by_kind = [F.when(F.col("kind") == k, F.array(*[s for kk, s in thirds if kk == k])) for k in range(len(pairs))]
    large = rows.filter(F.col("count") > bucket_rows).select("id", "print", F.explode(F.coalesce(*by_kind)).alias("at")).select("at.kind", "at.bucket", "id", "print")
    dealt = plain.unionByName(large).repartition("kind", "bucket").sortWithinPartitions("kind", "bucket")
    return dealt.mapInArrow(_bucket_links(radius), "a long, b long")


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = 3, radius: int = 2) -> DataFrame:
    """(doc_id, print, component_id) for every row: the smallest doc_id that links reach."""
    return _groups(docs, doc_id, text, shingle, radius).select("doc_id", "print", "component_id")


def _groups(docs: DataFrame, doc_id: str, text: str, shingle: int, radius: int) -> DataFrame:
    """(doc_id, print, component_id, component: the smallest print that links reach) for every row."""
    prints = landed(fingerprints(docs, doc_id, text, shingle), "fingerprints")
    # a class is its fingerprint: those whose documents all have a null doc_id link like any other
    classes = landed(prints.groupBy("print").agg(F.min("doc_id").alias("least")), "fingerprint-classes")
    reached = connected_components(links(classes.select(F.col("print").alias("id"), "print"), radius))
    named = classes.join(reached.withColumnRenamed("node", "print"), "print", "left").withColumn("component", F.coalesce("component", "print"))
    least = named.groupBy("component").agg(F.min("least").alias("component_id"))
    return prints.join(named.join(least, "component").select("print", "component_id", "component"), "print").select("doc_id", "print", "component_id", "component")


def keep_one(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = 3, radius: int = 2) -> DataFrame:
    """The documents, with all their columns, that are the first of their group; of rows that share that doc_id and text one stays.

    Of a group in which no row has a doc_id, the rows of one text stay as one: the text with the smallest fingerprint, then the smallest text.
    """
    groups = landed(_groups(docs, doc_id, text, shingle, radius), "groups")
    first = groups.filter(F.col("doc_id") == F.col("component_id")).select(F.col("doc_id").alias("_first")).distinct()
    kept = docs.join(first, F.col(doc_id) == F.col("_first"), "left_semi")
    nameless = groups.filter("component_id is null").groupBy("component").agg(F.min("print").alias("print"))
    if not nameless.isEmpty():
        # rows have no id to be found by: their different texts are numbered and fingerprinted once more
        without = docs.filter(F.col(doc_id).isNull())
        texts = landed(without.select(F.col(text).alias("_text")).distinct().withColumn("_n", F.monotonically_increasing_id()), "nameless-texts")
        own = fingerprints(texts, "_n", "_text", shingle).withColumnRenamed("doc_id", "_n").join(nameless.select("print"), "print").join(texts, "_n")
        chosen = own.groupBy("print").agg(F.min("_text").alias("_text")).select("_text")
        kept = kept.unionByName(without.join(chosen, F.col(text).eqNullSafe(F.col("_text")), "left_semi"))
    repeated = groups.groupBy("doc_id").count().filter("count > 1")
    return kept if repeated.isEmpty() else kept.dropDuplicates([doc_id, text])
