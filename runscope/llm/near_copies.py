"""Near copies by wide SimHash: documents whose sets of word shingles have a Jaccard similarity of `similarity` or more.

Fingerprints: text with A-Z lower-cased is split at `[\\x20\\x09-\\x0D]+`; each different run of `shingle` words (fewer words: all of
them) has a hash, widened to 1,024 bits; a bit is set if over half of the hashes have it. For sets of a like size with similarity J two
fingerprints differ in a share acos(2J / (1 + J)) / pi of their bits on average, so a distance estimates J: with 1,024 bits to 0.025
(one standard deviation at 0.8). Documents are candidates at or under the distance of `similarity` - `slack`.

Proof: candidates whose distance is that of `similarity` + `sure` or less are linked, three deviations away from a mistake. Between the
groups so linked, each document's `tries` nearest candidates are decided by the shingles of the two texts, counted exactly; only proved
ones link. Rounds of four times as many follow until no candidate between two groups is left untried. So documents under the similarity
stay apart, but for chains of proved links. The first candidates are a spanning forest of each bucket, which settles most groups. Where
documents that it holds together are still of several groups, every candidate of theirs between two groups follows, of each bucket, and
is decided in the same way: no pair of a bucket within the distance is left out. Their number is that of pairs under the similarity
that look alike, which in the worst case is quadratic; they are found and decided in parts, none of which is held whole.

Links: texts with one set of shingles are one class. A class goes to a bucket in each of `bands` bands, by `key_bits` of its bits, of which
there are enough for a pair at `similarity` to share a bucket with a probability of 0.99; a larger table has longer keys and more bands.
Buckets are compared bit-sliced: plane j has bit j of 64 fingerprints in a word, the planes that differ from a query are added to
all 64 distances at once by a tree of carry-save adders, and blocks in which all exceed the radius are abandoned. In a large
bucket some leaders are compared with all first; the rows of the largest tree so found are linked already and only the others are queries, so
a group of near copies takes a few passes, not all its pairs. A bucket of more than `bucket_rows` is cut again by further bits, in
several ways. A bucket gives a spanning forest.

Defined cases: texts without words are one class, as they are equal; a null doc_id comes after all others; repeated rows are in one
class; other columns are carried along; an empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from runscope.llm import arrays as A
from runscope.llm.components import connected_components
from runscope.llm.shared import discard, landed, ship
from runscope.llm.simhash import forest

BITS = 1024
SLICE = 1 << 20
#: Odd numbers that widen a hash, a word of the fingerprint each, and two that name sets.
WIDEN = np.random.default_rng(20240301).integers(1 << 62, 1 << 63, BITS // 64 + 2, dtype=np.uint64) | np.uint64(1)
COUNTERS = BITS.bit_length()
#: The eight bits of each octet, in a byte each of a word, and how many such words can be added before a byte is full.
LANES = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").view(np.uint64)[:, 0]
PIECE = 255


def bit_share(similarity: float) -> float:
    """The share of bits in which fingerprints of sets with this similarity differ on average."""
    return math.acos(2 * similarity / (1 + similarity)) / math.pi


def shingle_sets(buffer: np.ndarray, offsets: np.ndarray, shingle: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, hash) of each row's different shingles, in the order of rows."""
    low = A.LOWER[buffer]
    begins, ends = A.words(low, offsets, ~A.SPACE)
    row = np.searchsorted(offsets, begins, side="right") - 1
    values = A.range_hashes(A.BYTE_VALUES[low], begins, ends)
    firsts = np.searchsorted(row, np.arange(len(offsets)))
    hashes = A.window_hashes(values, shingle)
    at = np.flatnonzero(row[: len(hashes)] == row[shingle - 1 :])
    short = np.flatnonzero((np.diff(firsts) > 0) & (np.diff(firsts) < shingle))
    whole = [A.window_hashes(values[firsts[r] : firsts[r + 1]], int(firsts[r + 1] - firsts[r])) for r in short.tolist()]
    rows, hashes = np.concatenate([row[at], short]), np.concatenate([hashes[at], *whole])
    order = np.lexsort((hashes, rows))
    rows, hashes = rows[order], hashes[order]
    new = np.append(True, (rows[1:] != rows[:-1]) | (hashes[1:] != hashes[:-1]))[: len(rows)]
    return rows[new], hashes[new]


def piece_sums(octets: np.ndarray, begin: np.ndarray, step: int = 64) -> np.ndarray:
    """[pieces, 64] how often each bit is set among the hashes of a piece, of at most PIECE hashes; step: pieces whose bits are spread out at a time."""
    out = np.empty((len(begin), 8), np.uint64)
    edges = np.append(begin, len(octets))
    for i in range(0, len(begin), step):
        own = edges[i : i + step + 1]
        out[i : i + step] = np.add.reduceat(LANES[octets[own[0] : own[-1]]], own[:-1] - own[0], axis=0)
    return out.view(np.uint8)


def fingerprints_of(buffer: np.ndarray, offsets: np.ndarray, shingle: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """[rows, 16] words of fingerprints, and [rows, 2] names of the sets of shingles."""
    n = len(offsets) - 1
    prints, names = np.zeros((n, BITS // 64), np.uint64), np.zeros((n, 2), np.uint64)
    rows, hashes = shingle_sets(buffer, offsets, shingle)
    if len(rows):
        first, last = A.runs(np.append(True, rows[1:] != rows[:-1]))
        own = rows[first]
        pieces = -(-(last - first) // PIECE)
        begin = np.repeat(first, pieces) + PIECE * A.spread(np.zeros(len(first), np.int64), pieces)
        at_piece = np.cumsum(pieces) - pieces
        for word, odd in enumerate(WIDEN):
            wide = A.mixed(A.mixed(hashes * odd))
            if word < BITS // 64:
                sums = piece_sums(wide.view(np.uint8).reshape(-1, 8), begin)
                over = 2 * np.add.reduceat(sums, at_piece, axis=0, dtype=np.int64) > (last - first)[:, None]
                prints[own, word] = np.packbits(over, axis=1, bitorder="little").view(np.uint64)[:, 0]
            else:
                names[own, word - BITS // 64] = np.add.reduceat(wide, first)
    return prints, names


def _sketches(shingle: int):
    """(doc_id, mark, text) -> (doc_id, mark, one, two: the set's name, print)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            buffer, offsets = A.texts(batch.column("text"))
            for first, last in A.slices(offsets, SLICE):
                at = offsets[first : last + 1]
                prints, names = fingerprints_of(buffer[at[0] : at[-1]], at - at[0], shingle)
                blob = pa.array([p.tobytes() for p in prints], pa.binary())
                own = batch.slice(first, last - first)
                yield pa.RecordBatch.from_arrays([own.column("doc_id"), own.column("mark"), *(pa.array(x.view(np.int64).copy()) for x in names.T), blob], names=["doc_id", "mark", "one", "two", "print"])

    return run


def bands_for(classes: int, similarity: float, per_bucket: int = 500, recall: float = 0.99) -> tuple[int, int]:
    """(key_bits, bands): keys long enough for about per_bucket unlike rows in a bucket, and bands enough for the recall at this similarity."""
    key_bits = max(12, round(math.log2(max(classes, 1) / per_bucket)))
    together = (1 - bit_share(similarity)) ** key_bits
    return key_bits, math.ceil(math.log(1 - recall) / math.log(1 - together))


def band_bits(key_bits: int, bands: int, seed: int = 7) -> np.ndarray:
    """[bands, key_bits] places of bits: all bits are used once before any is used again."""
    r = np.random.default_rng(seed)
    rounds = -(-key_bits * bands // BITS)
    return np.concatenate([r.permutation(BITS) for _ in range(rounds)])[: key_bits * bands].reshape(bands, key_bits)


def keys_of(prints: np.ndarray, bits: np.ndarray) -> np.ndarray:
    """A number from the given bits (at most 62) of each fingerprint."""
    out = np.zeros(len(prints), np.int64)
    for j in bits.tolist():
        out = out << 1 | ((prints[:, j // 64] >> np.uint64(j % 64)) & np.uint64(1)).astype(np.int64)
    return out


def _matrix(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint64).reshape(-1, BITS // 64)


def _banded(bits: np.ndarray):
    """(id, print, ...) -> (band, key, id, print, ...) for each band."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = _matrix(batch.column("print"))
            for band, own in enumerate(bits):
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(prints), band, np.int32)), pa.array(keys_of(prints, own)), *batch.columns], names=["band", "key", *batch.schema.names])

    return run


def _cut_again(bits: np.ndarray, bands: int):
    """Rows of large buckets (band, key, id, print, ...) once for each further set of bits, in bands of their own."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints, band, key = _matrix(batch.column("print")), batch.column("band").to_numpy(), batch.column("key").to_numpy()
            for k, own in enumerate(bits):
                yield pa.RecordBatch.from_arrays([pa.array(((k + 1) * bands + band).astype(np.int32)), pa.array(key << len(own) | keys_of(prints, own)), *batch.columns[2:]], names=batch.schema.names)

    return run


def planes_of(prints: np.ndarray, step: int = 64) -> np.ndarray:
    """[BITS, blocks] words: bit i of word b of plane j is bit j of fingerprint 64 b + i; step: blocks whose bits are spread out at a time."""
    blocks = -(-len(prints) // 64)
    padded = np.zeros((blocks * 64, prints.shape[1]), np.uint64)
    padded[: len(prints)] = prints
    out = np.empty((BITS, blocks), np.uint64)
    for b in range(0, blocks, step):
        bits = np.unpackbits(padded[b * 64 : (b + step) * 64].view(np.uint8), axis=1, bitorder="little")
        columns = np.ascontiguousarray(bits.T).reshape(BITS, -1, 64)
        out[:, b : b + step] = np.packbits(columns, axis=2, bitorder="little").view(np.uint64)[:, :, 0]
    return out


def added(a: np.ndarray, b: np.ndarray, c: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A carry-save adder: the sum and the carry of three bits in each lane."""
    half = a ^ b
    return half ^ c, (a & b) | (half & c)


def beyond(counts: list[np.ndarray], radius: int) -> np.ndarray:
    """Lanes whose count (a bit in each array, the lowest first) exceeds the radius."""
    over, equal = np.zeros_like(counts[0]), ~np.zeros_like(counts[0])
    for k in reversed(range(len(counts))):
        if radius >> k & 1:
            equal &= counts[k]
        else:
            over |= equal & counts[k]
            equal &= ~counts[k]
    return over


def within_radius(prints: np.ndarray, query: np.ndarray, block: np.ndarray, planes: np.ndarray, radius: int, step: int = 64) -> tuple[np.ndarray, np.ndarray]:
    """(query, lane) at most `radius` apart, of the fingerprints prints[query] to all lanes of their blocks; step: planes between two looks for dead blocks."""
    counts = [np.zeros(len(query), np.uint64) for _ in range(COUNTERS)]
    one = np.uint64(1)
    for j in range(0, BITS, 8):
        word = prints[query, j // 64]
        x = [planes[j + i, block] ^ (np.uint64(0) - ((word >> np.uint64((j + i) % 64)) & one)) for i in range(8)]
        ones, twos, fours = counts[:3]
        carries = []
        for i in (0, 4):
            ones, a = added(ones, x[i], x[i + 1])
            ones, b = added(ones, x[i + 2], x[i + 3])
            twos, four = added(twos, a, b)
            carries.append(four)
        fours, carry = added(fours, *carries)
        counts[:3] = ones, twos, fours
        for k in range(3, COUNTERS):
            counts[k], carry = counts[k] ^ carry, counts[k] & carry
        if (j + 8) % step == 0 and j + 8 < BITS:
            live = beyond(counts, radius) != ~np.uint64(0)
            if not live.all():
                query, block, counts = query[live], block[live], [c[live] for c in counts]
            if not len(query):
                break
    near = ~beyond(counts, radius)
    at, lane = np.nonzero(np.unpackbits(near.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little"))
    return query[at], block[at] * 64 + lane


def roots(parent: np.ndarray) -> np.ndarray:
    while (up := parent[parent]).tolist() != parent.tolist():
        parent = up
    return parent


class Buckets:
    """Fingerprints of whole buckets, bit-sliced, and the trees of their links so far. bucket: sorted, one for each fingerprint; trees: a tree for each, by default its own."""

    def __init__(self, prints: np.ndarray, bucket: np.ndarray, trees: np.ndarray | None = None):
        n = len(prints)
        self.prints = prints
        self.first, self.last = A.runs(np.append(True, bucket[1:] != bucket[:-1])[:n])
        self.sizes = self.last - self.first
        self.blocks = -(-self.sizes // 64)
        self.at_block = np.cumsum(self.blocks) - self.blocks
        self.rank = np.arange(n) - np.repeat(self.first, self.sizes)
        lane = np.repeat(self.at_block, self.sizes) * 64 + self.rank
        self.row_at = np.full(int(self.blocks.sum()) * 64, -1, np.int64)
        self.row_at[lane] = np.arange(n)
        padded = np.zeros((len(self.row_at), prints.shape[1]), np.uint64)
        padded[lane] = prints
        self.planes, self.parent = planes_of(padded), np.arange(n)
        if trees is not None:
            order = np.lexsort((trees, bucket))
            new = np.append(True, (trees[order][1:] != trees[order][:-1]) | (bucket[order][1:] != bucket[order][:-1]))[:n]
            self.parent[order] = order[np.maximum.accumulate(np.where(new, np.arange(n), 0))]

    def near(self, query: np.ndarray, begin: np.ndarray, count: np.ndarray, radius: int, cells: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(query, other) within the radius: each query is compared with `count` blocks from `begin`, some `cells` of them at a time."""
        done = np.cumsum(count)
        i = 0
        while i < len(query):
            j = max(i + 1, int(np.searchsorted(done, (done[i - 1] if i else 0) + cells, side="right")))
            q, at = within_radius(self.prints, np.repeat(query[i:j], count[i:j]), A.spread(begin[i:j], count[i:j]), self.planes, radius)
            other = self.row_at[at]
            yield q[other >= 0], other[other >= 0]
            i = j

    def largest(self, b: int) -> np.ndarray:
        """Which rows of a bucket are in its largest tree."""
        root = roots(self.parent)[self.first[b] : self.last[b]] - self.first[b]
        return root == np.bincount(root).argmax()

    def link(self, radius: int, large: int, leaders: int, cells: int) -> list[tuple[int, int]]:
        """The links that join trees, as places: a spanning forest of each bucket's."""
        first, last, sizes, blocks, at_block, out = self.first, self.last, self.sizes, self.blocks, self.at_block, []

        def compare(query: np.ndarray, begin: np.ndarray, count: np.ndarray, earlier: bool) -> None:
            for q, other in self.near(query, begin, count, radius, cells):
                keep = (other < q) if earlier else (other != q)
                self.parent, new = forest(len(self.prints), q[keep], other[keep], self.parent)
                out.extend(new)

        plain = sizes <= large
        for b in np.flatnonzero(~plain).tolist():
            rows, asked = np.arange(first[b], last[b]), []
            for turn in range(leaders):
                inside = self.largest(b)
                left = np.setdiff1d(np.flatnonzero(~inside) if turn else np.arange(len(rows)), asked)
                if not len(left) or (turn == 2 and inside.sum() < len(rows) / 16):
                    break
                asked.append(left[len(left) // 2])
                compare(rows[asked[-1:]], at_block[b : b + 1], blocks[b : b + 1], False)
            inside = self.largest(b)
            plain[b] = inside.sum() < len(rows) / 16
            if not plain[b]:  # all inside the largest tree are linked
                rest = rows[~inside]
                compare(rest, np.full(len(rest), at_block[b]), np.full(len(rest), blocks[b]), False)
        # a link is seen from its later fingerprint: blocks after its own are not needed
        every = np.flatnonzero(np.repeat(plain, sizes))
        compare(every, np.repeat(at_block, sizes)[every], self.rank[every] // 64 + 1, True)
        return out

    def across(self, radius: int, cells: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """All pairs of places within the radius whose trees differ, each once: rows outside their bucket's largest tree are compared with all of it."""
        tree, n = roots(self.parent), len(self.prints)
        weight = np.bincount(tree, minlength=n)[tree] * n - tree
        inside = weight == np.repeat(np.maximum.reduceat(weight, self.first), self.sizes)
        rest = np.flatnonzero(~inside)
        for q, other in self.near(rest, np.repeat(self.at_block, self.sizes)[rest], np.repeat(self.blocks, self.sizes)[rest], radius, cells):
            keep = (tree[q] != tree[other]) & (inside[other] | (other < q))
            yield q[keep], other[keep]


def links_in(prints: np.ndarray, bucket: np.ndarray, radius: int, large: int = 128, leaders: int = 8, cells: int = 1 << 13) -> list[tuple[int, int]]:
    """A spanning forest of the links inside each bucket, as places; bucket: sorted, one for each fingerprint."""
    return Buckets(prints, bucket).link(radius, large, leaders, cells)


def pairs_across(prints: np.ndarray, bucket: np.ndarray, trees: np.ndarray, radius: int, sure: int, large: int = 128, leaders: int = 8, cells: int = 1 << 13) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of places of each bucket between the given trees: links within `sure` until none joins two trees, then all pairs within the radius that are still between two."""
    own = Buckets(prints, bucket, trees)
    linked = np.array(own.link(sure, large, leaders, cells), np.int64).reshape(-1, 2)
    yield linked[:, 0], linked[:, 1]
    yield from own.across(radius, cells)


def _in_buckets(pairs_of: Callable[..., Iterable[tuple[np.ndarray, np.ndarray]]], *more: str, together: int = 1 << 14):
    """(a, b) that pairs_of finds in buckets, from their prints, buckets and further columns. Rows come sorted by bucket; whole buckets with about `together` rows are compared at a time."""

    def found(rows: list[tuple]) -> Iterator[pa.RecordBatch]:
        bands, keys, ids, *others, prints = (np.concatenate(x) for x in zip(*rows, strict=True))
        change = np.append(True, (np.diff(bands) != 0) | (np.diff(keys) != 0))[: len(ids)]
        for a, b in pairs_of(prints, np.cumsum(change), *others):
            yield pa.RecordBatch.from_arrays([pa.array(np.minimum(ids[a], ids[b])), pa.array(np.maximum(ids[a], ids[b]))], names=["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        count = 0
        for batch in batches:
            held.append((*(batch.column(c).to_numpy().copy() for c in ("band", "key", "id", *more)), _matrix(batch.column("print"))))
            count += batch.num_rows
            if count < together:
                continue
            columns = [np.concatenate(x) for x in zip(*held, strict=True)]
            bands, keys = columns[:2]
            whole = int(np.flatnonzero((bands == bands[-1]) & (keys == keys[-1]))[0])  # the last bucket may go on
            if whole:
                yield from found([tuple(c[:whole] for c in columns)])
            held, count = [tuple(c[whole:] for c in columns)], len(bands) - whole
        if count:
            yield from found(held)

    return run


def in_buckets(rows: DataFrame, classes: int, similarity: float, find: Callable, bucket_rows: int = 100_000) -> DataFrame:
    """(a, b), a < b, that find (of _in_buckets) gives of the buckets of rows (id, further numbers, print); classes: how many fingerprints the buckets are made for."""
    key_bits, bands = bands_for(classes, similarity)
    bits = band_bits(key_bits, bands)
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema.fields)
    row = f"band int, key long, {kinds.replace('bigint', 'long')}"
    banded = rows.mapInArrow(_banded(bits), row)
    sizes = rows.mapInArrow(_banded(bits), row).groupBy("band", "key").count()
    full = F.broadcast(sizes.filter(F.col("count") > bucket_rows).select("band", "key"))  # one in bucket_rows rows at most
    further = band_bits(8, 12, seed=8)  # a pair at 0.8 agrees in one of them with a probability of 0.97
    cut = banded.join(full, ["band", "key"]).select("band", "key", *rows.columns).mapInArrow(_cut_again(further, bands), row)
    dealt = banded.join(full, ["band", "key"], "left_anti").unionByName(cut).repartition("band", "key").sortWithinPartitions("band", "key")
    return dealt.mapInArrow(find, "a long, b long")


def links(classes: DataFrame, similarity: float, slack: float, bucket_rows: int = 100_000) -> DataFrame:
    """(a, b) ids of linked classes (id, print): a spanning forest of each bucket's links."""
    radius = int(BITS * bit_share(similarity - slack))
    forests = lambda prints, bucket: [tuple(np.array(links_in(prints, bucket, radius), np.int64).reshape(-1, 2).T)]
    return in_buckets(classes.select("id", "print"), classes.count(), similarity, _in_buckets(forests), bucket_rows)


def between_groups(classes: DataFrame, candidates: DataFrame, linked: DataFrame, similarity: float, slack: float, sure: float, bucket_rows: int = 100_000) -> DataFrame | None:
    """(a, b) candidates between the groups of linked (a, b): all but those that links within `sure` join inside a bucket; None where there are none.

    Whatever has a candidate has one in the forests (candidates), so only what these hold together, but in several groups, is compared again.
    """
    group = connected_components(linked).toDF("id", "group")
    held = connected_components(candidates).toDF("id", "whole").join(group, "id", "left").withColumn("group", F.coalesce("group", "id"))
    held = landed(held, "wide-held")
    several = held.groupBy("whole").agg(F.min("group").alias("least"), F.max("group").alias("most")).filter("least < most").select("whole")
    rows = landed(held.join(several, "whole").select("id", "group").join(classes.select("id", "print"), "id"), "wide-several")
    discard(held)
    if rows.isEmpty():
        return None
    radius, near = (int(BITS * bit_share(min(1.0, x))) for x in (similarity - slack, similarity + sure))
    find = _in_buckets(lambda prints, bucket, trees: pairs_across(prints, bucket, trees, radius, near), "group")
    return in_buckets(rows, classes.count(), similarity, find, bucket_rows).distinct()


def _distances(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(a, b, print_a, print_b) -> (a, b, apart: bits in which they differ)."""
    for batch in batches:
        apart = np.bitwise_count(_matrix(batch.column("print_a")) ^ _matrix(batch.column("print_b"))).sum(1).astype(np.int64)
        yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), pa.array(apart)], names=["a", "b", "apart"])


def similarities(left: tuple[np.ndarray, np.ndarray], right: tuple[np.ndarray, np.ndarray], shingle: int) -> np.ndarray:
    """The Jaccard similarity of the sets of shingles of each two texts (bytes and offsets on either side); 1 for two without words."""
    n = len(left[1]) - 1
    sets = [shingle_sets(*side, shingle) for side in (left, right)]
    sizes = [np.bincount(rows, minlength=n) for rows, _ in sets]
    rows, hashes = (np.concatenate(x) for x in zip(*sets, strict=True))
    order = np.lexsort((hashes, rows))
    rows, hashes = rows[order], hashes[order]
    both = np.bincount(rows[1:][(rows[1:] == rows[:-1]) & (hashes[1:] == hashes[:-1])], minlength=n)
    every = sizes[0] + sizes[1] - both
    return np.where(every == 0, 1.0, both / np.maximum(every, 1))


def _proved(shingle: int, similarity: float):
    """(a, b, text_a, text_b) -> (a, b) of those that are similar."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            (one, at_one), (two, at_two) = (A.texts(batch.column(c)) for c in ("text_a", "text_b"))
            for first, last in A.slices((at_one - at_one[0]) + (at_two - at_two[0]), SLICE):
                sides = [(buffer[at[first] : at[last]], at[first : last + 1] - at[first]) for buffer, at in ((one, at_one), (two, at_two))]
                good = pa.array(first + np.flatnonzero(similarities(*sides, shingle) >= similarity))
                yield pa.RecordBatch.from_arrays([batch.column("a").take(good), batch.column("b").take(good)], names=["a", "b"])

    return run


def proved(candidates: DataFrame, classes: DataFrame, texts: DataFrame, shingle: int, similarity: float, sure: float, tries: int = 8, more: Callable[[DataFrame], DataFrame | None] | None = None) -> DataFrame:
    """The links among candidates (a, b); classes: id, first, print; texts: first, text. tries: nearest candidates of a document that the first round asks.

    more: further candidates between the groups of the links (a, b) that it is given, asked when the first candidates are settled.
    """
    prints = classes.select("id", "print")
    limit = int(BITS * bit_share(min(1.0, similarity + sure)))
    named = lambda rows, group, side: rows.join(group.toDF(side, f"_{side}"), side, "left").withColumn(f"_{side}", F.coalesce(f"_{side}", side))
    links, tried = candidates.limit(0).select("a", "b"), []
    while candidates is not None:
        both = candidates.join(prints.toDF("a", "print_a"), "a").join(prints.toDF("b", "print_b"), "b")
        apart = landed(both.select("a", "b", "print_a", "print_b").mapInArrow(_distances, "a long, b long, apart long"), "wide-distances")
        near = F.col("apart") <= limit
        links = links.unionByName(apart.filter(near).select("a", "b"))
        group = landed(connected_components(links), "wide-groups")
        left = landed(named(named(apart.filter(~near), group, "a"), group, "b").filter("_a <> _b"), "wide-across")
        most = tries
        while not left.isEmpty():
            ends = left.select(F.explode(F.array(F.struct(F.col("a").alias("id"), "a", "b", "apart"), F.struct(F.col("b").alias("id"), "a", "b", "apart"))).alias("e")).select("e.*")
            rank = F.row_number().over(Window.partitionBy("id").orderBy("apart", "a", "b"))
            asked = landed(ends.withColumn("rank", rank).filter(F.col("rank") <= most).select("a", "b").distinct(), "wide-asked")
            ends = asked.select(F.col("a").alias("id")).unionByName(asked.select(F.col("b").alias("id"))).distinct().join(classes.select("id", "first"), "id")
            own = landed(texts.join(ends, "first").select("id", "text").dropDuplicates(["id"]), "wide-texts")
            pairs = asked.join(own.toDF("a", "text_a"), "a").join(own.toDF("b", "text_b"), "b").select("a", "b", "text_a", "text_b")
            found = landed(pairs.mapInArrow(_proved(shingle, similarity), "a long, b long"), "wide-proved")
            links = links.unionByName(found)
            # the groups that are one now need no further proof; what is left between others is asked in the next round
            rest = left.join(asked, ["a", "b"], "left_anti")
            if not rest.isEmpty():
                one = connected_components(left.join(found, ["a", "b"], "left_semi").select(F.col("_a").alias("a"), F.col("_b").alias("b")))
                for side in ("_a", "_b"):
                    rest = rest.join(one.toDF(side, "_one"), side, "left").withColumn(side, F.coalesce("_one", side)).drop("_one")
                rest = rest.filter("_a <> _b").select(*left.columns)
            discarded, left, most = [left, own], landed(rest, "wide-across"), most * 4
            for table in discarded:
                discard(table)
            tried.append(asked)
        candidates, more = more(links) if more else None, None
        for asked in tried if candidates is not None else ():
            candidates = candidates.join(asked, ["a", "b"], "left_anti")
    return links


def keep_one(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = 5, similarity: float = 0.8, slack: float = 0.07, sure: float = 0.08) -> DataFrame:
    """The documents, with all their columns, that are the first of their group, by doc_id and then by a hash of the text; of equal rows one stays."""
    ship(docs.sparkSession)
    mark = F.xxhash64(F.coalesce(F.col(text), F.lit("")))
    own = docs.select(F.col(doc_id).cast("long").alias("doc_id"), mark.alias("mark"), F.col(text).cast("binary").alias("text"))
    sketches = landed(own.mapInArrow(_sketches(shingle), "doc_id long, mark long, one long, two long, print binary"), "wide-prints")
    name = F.struct(F.col("doc_id").isNull().alias("none"), F.coalesce("doc_id", F.lit(0)).alias("doc"), F.col("mark").alias("mark"))
    classes = sketches.groupBy("one", "two").agg(F.min(name).alias("first"), F.min("print").alias("print"))
    classes = landed(classes.select(F.monotonically_increasing_id().alias("id"), "first", "print"), "wide-classes")
    texts = own.select(name.alias("first"), "text")
    candidates = landed(links(classes, similarity, slack).distinct(), "wide-links")
    more = lambda linked: between_groups(classes, candidates, linked, similarity, slack, sure)
    reached = connected_components(proved(candidates, classes, texts, shingle, similarity, sure, more=more)).withColumnRenamed("node", "id")
    groups = classes.select("id", "first").join(reached, "id", "left").groupBy(F.coalesce("component", "id").alias("group")).agg(F.min("first").alias("first"))
    chosen = landed(groups.select("first.*"), "wide-chosen")
    repeated = sketches.groupBy("doc_id", "mark").count().filter("count > 1")
    several = not repeated.isEmpty()
    discard(sketches)
    first = chosen.select(*[F.col(c).alias(f"_first_{c}") for c in ("none", "doc", "mark")])
    same = (F.col(doc_id).isNull() == F.col("_first_none")) & (F.coalesce(F.col(doc_id).cast("long"), F.lit(0)) == F.col("_first_doc")) & (mark == F.col("_first_mark"))
    kept = docs.join(first, same, "left_semi")
    return kept.dropDuplicates([doc_id, text]) if several else kept
