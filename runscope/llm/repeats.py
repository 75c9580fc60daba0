"""Windows of a fixed width that travel to buckets in packed runs; shared by suffix-array and substring dedup.

A window is `width` consecutive units (bytes or words) of one document. All windows with one content contain the same grams of
`gram` units, so they agree on the least gram hash, their minimiser, and on where it stands first in them. Consecutive windows with
the same minimiser form a run, and a run travels as one packed string to the bucket of its minimiser: all windows with one content
meet there.

Which windows are the same is told by a function `classes(units, runs) -> (windows, class of each)`, a suffix array or a sort of
hashes whose ties are compared byte by byte; it is asked inside each slice of a task before the shuffle, and inside buckets. A
task remembers the repeated windows that it has sent, with their bytes: of thousands of copies in a task, one is sent. So a hot
passage is a row for each task, not one for each document.

Grams that stand in many runs (a common line with other text around it) would gather all of these in one bucket. They are found on
a sample and lose against all other grams, so a run around them goes by a gram of its surroundings; windows with one content still
agree. The sample decides how evenly buckets are filled and nothing else.

A document is named by its doc_id (null: the largest) and a hash of its text, so rows that share a doc_id stay apart unless they
are equal in both.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from runscope.llm import arrays as A
from runscope.llm.shared import landed, ship

LAST_ID = (1 << 63) - 1
SLICE = 1 << 19
#: Packed text that a task gathers before it is cut into blobs: neighbours in a blob overlap and so compress well.
GATHER = 32 << 20
#: Packed text that one bucket gets on average, and shuffle partitions that buckets are dealt over at most.
BUCKET_BYTES, MOST_PARTITIONS = 8 << 20, 20_000
#: Text in the sample: at least so many bytes, and at least this share of all.
SAMPLE_BYTES, SAMPLE_SHARE = 16 << 20, 0.001
#: Grams that are sent along as hot at most; others stay ordinary ones, which unbalances buckets only.
MOST_HOT = 100_000
HEAD = np.dtype([("doc", "<i8"), ("mark", "<i8"), ("key", "<u8"), ("start", "<i4"), ("windows", "<i4"), ("anchor", "<i4"), ("bytes", "<i4")])
TOP = np.uint64(1 << 63)


class Units:
    """The units of a slice of rows: their places in `plain`, the row of each and their hash values."""

    def __init__(self, buffer: np.ndarray, offsets: np.ndarray, by_word: bool):
        self.by_word, self.offsets, self._hashes = by_word, offsets, {}
        if by_word:
            begins, ends = A.words(buffer, offsets, ~A.SPACE)
            self.row = np.searchsorted(offsets, begins, side="right") - 1
            sizes = ends - begins
            self.begins = np.cumsum(sizes + 1) - sizes - 1
            self.ends = self.begins + sizes
            self.plain = np.full(int(sizes.sum()) + len(sizes), 0x20, np.uint8)
            self.plain[A.spread(self.begins, sizes)] = buffer[A.spread(begins, sizes)]
            self.first = np.searchsorted(self.row, np.arange(len(offsets)))
        else:
            self.plain, self.first = np.ascontiguousarray(buffer), offsets

    @cached_property
    def row(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.offsets) - 1), np.diff(self.offsets))

    @cached_property
    def values(self) -> np.ndarray:
        return A.range_hashes(A.BYTE_VALUES[self.plain], self.begins, self.ends) if self.by_word else A.BYTE_VALUES[self.plain]

    def hashes(self, width: int) -> np.ndarray:
        """The hash of the window that begins at each unit."""
        if width not in self._hashes:
            self._hashes[width] = A.window_hashes(self.values, width)
        return self._hashes[width]

    def span(self, first, count) -> tuple:
        """Where `count` units from `first` on lie in plain."""
        return (self.begins[first], self.ends[first + count - 1]) if self.by_word else (first, first + count)


@dataclass
class Runs:
    """Runs of windows: the first window's unit, how many, their minimiser and the unit where it stands first in them."""

    first: np.ndarray
    windows: np.ndarray
    key: np.ndarray
    anchor: np.ndarray

    def units_of(self, some: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(number of the window among all windows of the runs, its unit) of the windows of some runs."""
        before = np.cumsum(self.windows) - self.windows
        return A.spread(before[some], self.windows[some]), A.spread(self.first[some], self.windows[some])


class Hot:
    """Grams that lose against all others: sorted hashes, and a bitmap to see most others off."""

    def __init__(self, grams: np.ndarray):
        self.grams, self.maybe = np.sort(grams), np.zeros(1 << 16, bool)
        self.maybe[(grams & np.uint64(0xFFFF)).astype(np.int64)] = True

    def ranked(self, hashes: np.ndarray) -> np.ndarray:
        """Hashes without their top bit, hot ones with it: they are the largest."""
        hashes = hashes >> np.uint64(1)
        if len(self.grams):
            some = np.flatnonzero(self.maybe[(hashes & np.uint64(0xFFFF)).astype(np.int64)])
            at = np.minimum(np.searchsorted(self.grams, hashes[some]), len(self.grams) - 1)
            hashes[some[self.grams[at] == hashes[some]]] |= TOP
        return hashes


def runs_of(units: Units, width: int, gram: int, hot: Hot, by_anchor: bool) -> Runs:
    """All windows as runs; by_anchor: the minimiser of a run stands at one place."""
    n = len(units.plain) if not units.by_word else len(units.row)
    if n < width:
        none = np.zeros(0, np.int64)
        return Runs(none, none, none.view(np.uint64), none)
    least, anchor = A.sliding_min(hot.ranked(A.window_hashes(units.values, gram, 1)), width - gram + 1)
    at = np.flatnonzero(units.row[: len(least)] == units.row[width - 1 :])
    least, anchor = least[at], anchor[at].astype(np.int64)
    same = anchor if by_anchor else least
    begins, ends = A.runs(np.append(True, (at[1:] != at[:-1] + 1) | (same[1:] != same[:-1]))[: len(at)])
    return Runs(at[begins], ends - begins, least[begins] & ~TOP, anchor[begins])


def equal_before(keys: np.ndarray) -> np.ndarray:
    """Whether each key stands more than once."""
    order = np.argsort(keys, kind="stable")
    same = np.zeros(len(keys), bool)
    twin = keys[order[1:]] == keys[order[:-1]]
    same[order[1:]] |= twin
    same[order[:-1]] |= twin
    return same


def hashed_classes(width: int):
    """Classes of equal windows by sorting their hashes; ties are then compared byte by byte, so a collision joins no two contents."""

    def classes(units: Units, runs: Runs) -> tuple[np.ndarray, np.ndarray]:
        window, at = runs.units_of(np.flatnonzero(equal_before(runs.key)))
        if not len(at):
            return window, at
        one = units.hashes(width)[at]
        some = np.flatnonzero(equal_before(one))
        window, at, one = window[some], at[some], one[some]
        order = np.argsort(one, kind="stable")
        group, stop = A.runs(np.append(True, one[order][1:] != one[order][:-1])[: len(one)])
        number, leader = np.empty(len(at), np.int64), np.empty(len(at), np.int64)
        number[order] = np.repeat(np.arange(len(group)), stop - group)
        leader[order] = np.repeat(order[group], stop - group)
        if not same_bytes(units, at, at[leader], width):
            number = classes_by_content(units, at, width)
        return window, number

    return classes


def same_bytes(units: Units, a: np.ndarray, b: np.ndarray, width: int) -> bool:
    """Whether the windows at a have the bytes of those at b; neighbouring pairs are compared as one range."""
    order = np.argsort(a, kind="stable")
    a, b = a[order], b[order]
    first, last = A.runs(np.append(True, (a[1:] != a[:-1] + 1) | (b[1:] != b[:-1] + 1))[: len(a)])
    left, lend = units.span(a[first], last - first + width - 1)
    right, rend = units.span(b[first], last - first + width - 1)
    whole = memoryview(units.plain)
    return all(i == k or (j - i == m - k and whole[i:j] == whole[k:m]) for i, j, k, m in zip(left.tolist(), lend.tolist(), right.tolist(), rend.tolist(), strict=True))


def classes_by_content(units: Units, at: np.ndarray, width: int) -> np.ndarray:
    """The same by a table of the windows' bytes, for windows of which two contents share a hash."""
    left, right = units.span(at, width)
    numbers: dict[bytes, int] = {}
    whole = units.plain.tobytes()
    return np.array([numbers.setdefault(whole[i:j], len(numbers)) for i, j in zip(left.tolist(), right.tolist(), strict=True)], np.int64)


def settle(number: np.ndarray, doc: np.ndarray, ordered: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(removed, sent, repeated) for windows by their class and document.

    ordered: a window goes where a smaller document has it; those of the smallest are sent. Else all that repeat go, one is sent.
    """
    order = np.lexsort((doc, number))
    c, d = number[order], doc[order]
    first, last = A.runs(np.append(True, c[1:] != c[:-1])[: len(c)])
    size = np.repeat(last - first, last - first)
    least = np.repeat(d[first], last - first)
    leader = np.zeros(len(c), bool)
    leader[first] = True
    removed, sent, many = np.zeros(len(c), bool), np.zeros(len(c), bool), np.zeros(len(c), bool)
    removed[order] = d > least if ordered else size > 1
    sent[order] = d == least if ordered else leader
    many[order] = size > 1
    return removed, sent, many


class Seen:
    """Repeated windows that a task has sent, with their bytes and the smallest document that it sent them for.

    A table of a fixed size: what another window displaces, or what no longer fits the bytes that are kept, is sent again.
    """

    def __init__(self, width: int, slots: int = 1 << 19, kept: int = 16 << 20):
        self.width, self.shift = width, np.uint64(65 - slots.bit_length())
        self.one, self.doc, self.place, self.size = np.zeros(slots, np.uint64), np.zeros(slots, np.int64), np.zeros(slots, np.int64), np.zeros(slots, np.int32)
        self.keys, self.text, self.used = np.zeros(1 << 20, bool), np.zeros(kept, np.uint8), 0

    def may_hold(self, runs: Runs) -> np.ndarray:
        """The runs whose minimiser a window was sent with."""
        return np.flatnonzero(self.keys[(runs.key & np.uint64(len(self.keys) - 1)).astype(np.int64)])

    def smallest(self, units: Units, at: np.ndarray) -> np.ndarray:
        """The document that each window (by its unit, in order) was sent for; the largest id if it wasn't."""
        out = np.full(len(at), LAST_ID)
        slot = units.hashes(self.width)[at]
        one, slot = slot, slot >> self.shift
        hit = np.flatnonzero((self.one[slot] == one) & (self.size[slot] > 0))
        if not len(hit):
            return out
        left, right = units.span(at[hit], self.width)
        slot = slot[hit]
        place, size = self.place[slot], self.size[slot].astype(np.int64)
        # windows that follow each other here and there are compared as one range
        follows = (at[hit][1:] == at[hit][:-1] + 1) & (left[1:] - left[:-1] == place[1:] - place[:-1])
        first, last = A.runs(np.append(True, ~follows)[: len(hit)])
        here, there = memoryview(units.plain), memoryview(self.text)
        good = size == right - left
        for i, j in zip(first.tolist(), last.tolist(), strict=True):
            if not (good[i:j].all() and here[left[i] : right[j - 1]] == there[place[i] : place[j - 1] + size[j - 1]]):
                for k in range(i, j):
                    good[k] &= here[left[k] : right[k]] == there[place[k] : place[k] + size[k]]
        out[hit[good]] = self.doc[slot[good]]
        return out

    def put(self, units: Units, at: np.ndarray, doc: np.ndarray, key: np.ndarray) -> None:
        """Windows (in order, with their documents and minimisers) that are sent now."""
        if not len(at):
            return
        first, last = A.runs(np.append(True, at[1:] != at[:-1] + 1))
        left, right = units.span(at, self.width)
        begin, end = left[first], right[last - 1]
        if self.used + int((end - begin).sum()) > len(self.text):
            self.size[:], self.keys[:], self.used = 0, False, 0
            if int((end - begin).sum()) > len(self.text):
                return
        base = self.used + np.cumsum(end - begin) - (end - begin)
        for i, j, k in zip(begin.tolist(), end.tolist(), base.tolist(), strict=True):
            self.text[k : k + j - i] = units.plain[i:j]
        self.used += int((end - begin).sum())
        one = units.hashes(self.width)[at]
        slot = one >> self.shift
        self.one[slot], self.doc[slot], self.place[slot], self.size[slot] = one, doc, left - np.repeat(begin - base, last - first), right - left
        self.keys[(key & np.uint64(len(self.keys) - 1)).astype(np.int64)] = True


class Packed:
    """Runs that wait to be sent, by bucket."""

    def __init__(self):
        self.size, self.waiting = 0, {}

    def add(self, bucket: int, heads: bytes, text: list[memoryview], size: int) -> None:
        own = self.waiting.setdefault(bucket, ([], []))
        own[0].append(heads)
        own[1].append(b"".join(text))
        self.size += size

    def blobs(self) -> pa.RecordBatch:
        """All of them, a compressed blob for each bucket."""
        pack, out = zstandard.ZstdCompressor(level=3).compress, []
        for heads, texts in self.waiting.values():
            heads = b"".join(heads)
            out.append(pack(b"".join([np.array([len(heads) // HEAD.itemsize], "<i8").tobytes(), heads, *texts])))
        columns = [pa.array(list(self.waiting), pa.int32()), pa.array(out, pa.binary()), *(pa.nulls(len(out), k) for k in (pa.int64(), pa.int64(), pa.int32(), pa.int32()))]
        self.size, self.waiting = 0, {}
        return pa.RecordBatch.from_arrays(columns, names=["bucket", "blob", "doc", "mark", "start", "windows"])


@dataclass(frozen=True)
class How:
    """What is compared: windows of `width` words or bytes by minimisers of `gram`; how classes and buckets are told."""

    width: int
    gram: int
    by_word: bool
    ordered: bool
    classes: object
    bucket_of: object

    def slices(self, batch: pa.RecordBatch) -> Iterator[tuple[Units, int, int, int]]:
        """(units, first row, last row, units of the row before them) of a batch with a column text."""
        buffer, offsets = A.texts(batch.column("text"))
        for first, last in A.slices(offsets, SLICE):
            at = offsets[first : last + 1]
            for piece, cut, skipped in pieces(buffer[at[0] : at[-1]], at - at[0], self.width, self.by_word):
                yield Units(piece, cut, self.by_word), first, last, skipped

    def runs(self, units: Units, hot: Hot) -> Runs:
        return runs_of(units, self.width, self.gram, hot, by_anchor=not self.by_word)


def _send(how: How, hot, buckets: int):
    """(doc, mark, text) -> (bucket, blob) packed runs for the buckets, and (bucket, doc, mark, start, windows) that are settled already."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, packed = Seen(how.width), Packed()
        for batch in batches:
            docs, marks = batch.column("doc").to_numpy(), batch.column("mark").to_numpy()
            for units, first, last, skipped in how.slices(batch):
                runs = how.runs(units, hot.value)
                if len(runs.first):
                    yield from one_slice(units, runs, skipped, docs[first:last], marks[first:last], seen, packed)
                if packed.size >= GATHER:
                    yield packed.blobs()
        if packed.size:
            yield packed.blobs()

    def one_slice(units, runs, skipped, docs, marks, seen, packed):
        row = units.row[runs.first]
        run = np.repeat(np.arange(len(runs.first)), runs.windows)
        at = A.spread(runs.first, runs.windows)
        doc = docs[row][run]
        removed, sent = np.zeros(len(at), bool), np.ones(len(at), bool)
        some, number = how.classes(units, runs)
        keep = some
        if len(some):
            removed[some], sent[some], many = settle(number, doc[some], how.ordered)
            keep = some[many & sent[some]]
        maybe, units_of = runs.units_of(seen.may_hold(runs))
        if len(maybe):
            least = seen.smallest(units, units_of)
            before = least < doc[maybe] if how.ordered else least < LAST_ID
            removed[maybe] |= before
            sent[maybe] &= ~before
            keep = keep[sent[keep]]
        keep = np.sort(keep)
        seen.put(units, at[keep], doc[keep], runs.key[run[keep]])
        place = at - units.first[row][run] + skipped
        yield from settled(docs, marks, row[run], place, removed)
        change = np.append(True, (run[1:] != run[:-1]) | (sent[1:] != sent[:-1]))
        begins, ends = A.runs(change)
        keep = sent[begins]
        begins, ends = begins[keep], ends[keep]
        if not len(begins):
            return
        own = run[begins]
        left, right = units.span(at[begins], ends - begins + how.width - 1)
        head = np.empty(len(begins), HEAD)
        head["doc"], head["mark"], head["key"] = docs[row[own]], marks[row[own]], runs.key[own]
        head["start"], head["windows"], head["bytes"] = place[begins], ends - begins, right - left
        head["anchor"] = runs.anchor[own] - at[begins]
        bucket = how.bucket_of(units, runs.key[own], runs.anchor[own])
        order = np.argsort(bucket, kind="stable")
        head, left, right, bucket = head[order], left[order].tolist(), right[order].tolist(), bucket[order]
        whole = memoryview(units.plain)
        groups, stops = A.runs(np.append(True, bucket[1:] != bucket[:-1]))
        for i, j in zip(groups.tolist(), stops.tolist(), strict=True):
            text = [whole[a:b] for a, b in zip(left[i:j], right[i:j], strict=True)]
            packed.add(int(bucket[i]), head[i:j].tobytes(), text, int(head["bytes"][i:j].sum()))

    def settled(docs, marks, row, place, removed):
        change = np.append(True, (row[1:] != row[:-1]) | (place[1:] != place[:-1] + 1) | (removed[1:] != removed[:-1]))
        begins, ends = A.runs(change)
        keep = removed[begins]
        begins, ends = begins[keep], ends[keep]
        if n := len(begins):
            own = row[begins]
            bucket = (A.mixed(docs[own].view(np.uint64)) % np.uint64(buckets)).astype(np.int32)  # any will do
            yield pa.RecordBatch.from_arrays([pa.array(bucket), pa.nulls(n, pa.binary()), pa.array(docs[own]), pa.array(marks[own]), pa.array(place[begins].astype(np.int32)), pa.array((ends - begins).astype(np.int32))], names=["bucket", "blob", "doc", "mark", "start", "windows"])

    return run


def pieces(buffer: np.ndarray, offsets: np.ndarray, width: int, by_word: bool, most: int = 2 << 20) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
    """The slice itself, or a very long single row in parts that share width - 1 units; with the number of units before a part."""
    if len(offsets) > 2 or len(buffer) <= most:
        yield buffer, offsets, 0
        return
    begins, ends = A.words(buffer, offsets, ~A.SPACE) if by_word else (None, None)
    count = len(begins) if by_word else len(buffer)
    step = most // 8 if by_word else most
    for first in range(0, count - width + 1, step):
        last = min(count, first + step + width - 1)
        part = buffer[begins[first] : ends[last - 1]] if by_word else buffer[first:last]
        yield part, np.array([0, len(part)]), first


def opened(blobs: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Heads of a bucket's runs, where each run's text begins, and the text."""
    heads, texts, at, begins = [], [], 0, []
    unpack = zstandard.ZstdDecompressor().decompress
    for blob in blobs:
        raw = unpack(blob.as_buffer())
        n = int(np.frombuffer(raw, "<i8", 1)[0])
        head = np.frombuffer(raw, HEAD, n, 8)
        heads.append(head)
        text = np.frombuffer(raw, np.uint8, offset=8 + n * HEAD.itemsize)
        edge = np.cumsum(head["bytes"], dtype=np.int64)
        begins.append(edge - head["bytes"] + at)
        texts.append(text)
        at += len(text)
    return np.concatenate(heads), np.concatenate(begins), np.concatenate(texts)


def token_parts(head: np.ndarray, begin: np.ndarray, token: np.ndarray, most: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Runs in the order of a token that equal windows share, but those that are alone with theirs; in parts of whole tokens with about `most` bytes each."""
    some = np.flatnonzero(equal_before(token))
    some = some[np.argsort(token[some], kind="stable")]
    head, begin, token = head[some], begin[some], token[some]
    first, last = A.runs(np.append(True, token[1:] != token[:-1])[: len(head)])
    held = np.append(0, np.cumsum(head["bytes"], dtype=np.int64))[last]
    at = 0
    while at < len(first):
        end = max(at + 1, int(np.searchsorted(held, (held[at - 1] if at else 0) + most, side="right")))
        yield head[first[at] : last[end - 1]], begin[first[at] : last[end - 1]]
        at = end


def removed_windows(how: How, head: np.ndarray, begin: np.ndarray, text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(run, window) of the windows of these runs that go, as places in head and in the run."""
    sizes, windows = head["bytes"].astype(np.int64), head["windows"].astype(np.int64)
    whole, edges = memoryview(text), np.append(0, np.cumsum(sizes))
    own = b"".join([whole[i : i + n] for i, n in zip(begin.tolist(), sizes.tolist(), strict=True)])
    units = Units(np.frombuffer(own, np.uint8), edges, how.by_word)
    first = units.first[:-1]
    some, number = how.classes(units, Runs(first, windows, head["key"], first + head["anchor"]))
    run = np.repeat(np.arange(len(head)), windows)[some]
    removed, _, many = settle(number, head["doc"][run], how.ordered)
    goes = removed & many
    return run[goes], (some - (np.cumsum(windows) - windows)[run])[goes]


def as_rows(head: np.ndarray, run: np.ndarray, window: np.ndarray) -> pa.Table:
    """(doc, mark, start, windows): neighbouring windows of a run as one row."""
    order = np.lexsort((window, run))
    run, window = run[order], window[order]
    first, last = A.runs(np.append(True, (run[1:] != run[:-1]) | (window[1:] != window[:-1] + 1))[: len(run)])
    own = head[run[first]]
    return pa.table({"doc": pa.array(own["doc"]), "mark": pa.array(own["mark"]), "start": pa.array((own["start"] + window[first]).astype(np.int32)), "windows": pa.array((last - first).astype(np.int32))})


FOUND = "doc long, mark long, start int, windows int"


def read(docs: DataFrame, doc_id: str, text: str, *more: str) -> DataFrame:
    own = docs.select(F.coalesce(F.col(doc_id).cast("long"), F.lit(LAST_ID)).alias("doc"), F.coalesce(F.col(text).cast("binary"), F.lit(b"")).alias("text"), *more)
    return own.select("doc", F.xxhash64("text").alias("mark"), "text", *more)


@dataclass
class Sizes:
    """Bytes of all texts, buckets for the runs, which hold some three times the text, and a landed sample of texts with its share."""

    bytes: int
    buckets: int
    sample: DataFrame
    share: float

    @classmethod
    def of(cls, docs: DataFrame, text: str, bucket_bytes: int | None = None) -> Sizes:
        size = docs.agg(F.sum(F.octet_length(text))).first()[0] or 0
        share = min(1.0, max(SAMPLE_SHARE, SAMPLE_BYTES / max(size, 1)))
        texts = docs.select(F.coalesce(F.col(text).cast("binary"), F.lit(b"")).alias("text"))
        return cls(size, max(1, -(-3 * size // (bucket_bytes or BUCKET_BYTES))), landed(texts.sample(share, seed=17) if share < 1 else texts, "repeats-sample"), share)


def _sampled(how: How, hot):
    """(text) -> (lead) of all runs: the 8 bytes where the minimiser stands."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for units, *_ in how.slices(batch):
                lead = characters(units.plain)[how.runs(units, hot.value).anchor].astype(np.uint64)
                yield pa.RecordBatch.from_arrays([pa.array(lead.view(np.int64))], names=["lead"])

    return run


def sampled_leads(how: How, sizes: Sizes, hot) -> DataFrame:
    return sizes.sample.mapInArrow(_sampled(how, hot), "lead long")


def characters(text: np.ndarray) -> np.ndarray:
    """The 8 bytes from each place on as one number, in the order of the bytes; the text is padded by zeros."""
    padded = np.append(text, np.zeros(8, np.uint8))
    return np.ndarray((len(text) + 1,), ">u8", padded, strides=(1,))


def _common(how: How):
    """(text) -> (gram, n) of the grams that are small enough to become minimisers; each batch counts its own."""
    # of as many grams as a window has, the least is above this share of all hashes once in ten million windows
    largest = np.uint64(int(min(1.0, 16 / (how.width - how.gram + 1)) * ((1 << 63) - 1)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [np.zeros(0, np.uint64)]
            for units, *_ in how.slices(batch):
                grams = A.window_hashes(units.values, how.gram, 1) >> np.uint64(1)
                found.append(grams[grams <= largest])
            gram, n = np.unique(np.concatenate(found), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(gram.view(np.int64)), pa.array(n.astype(np.int64))], names=["gram", "n"])

    return run


def hot_grams(how: How, sizes: Sizes, unit_bytes: int):
    """A broadcast Hot: grams so common that the runs around them, were they different, would fill a quarter of a bucket. unit_bytes: of a unit, about."""
    least = max(8, BUCKET_BYTES / 4 * sizes.share / (1.5 * how.width * unit_bytes))
    counts = sizes.sample.mapInArrow(_common(how), "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n")).filter(F.col("n") >= least)
    found = [r["gram"] for r in counts.orderBy(F.desc("n"), "gram").limit(MOST_HOT).collect()]
    return sizes.sample.sparkSession.sparkContext.broadcast(Hot(np.array(found, np.int64).view(np.uint64)))


def removed(docs: DataFrame, doc_id: str, text: str, how: How, sizes: Sizes, hot, part: int) -> DataFrame:
    """(doc, mark, spans): for each document with removed windows, their runs (first window, windows). part: bytes that a bucket compares at once."""
    ship(docs.sparkSession)
    buckets = sizes.buckets
    sent = read(docs, doc_id, text).mapInArrow(_send(how, hot, buckets), f"bucket int, blob binary, {FOUND}")

    def one_bucket(table):
        blobs = table["blob"].drop_null()
        out = [table.filter(table["blob"].is_null()).select(["doc", "mark", "start", "windows"])]  # settled before: only passing by
        if len(blobs):
            head, begin, content = opened(blobs)
            token = head["key"] if how.by_word else characters(content)[begin + head["anchor"]].astype(np.uint64)
            for own, at in token_parts(head, begin, token, part):
                out.append(as_rows(own, *removed_windows(how, own, at, content)))
        return pa.concat_tables(out)

    # as many partitions as buckets, whatever the session's number: a task has about one of them
    found = sent.repartition(min(buckets, MOST_PARTITIONS), "bucket").groupBy("bucket").applyInArrow(one_bucket, FOUND)
    return found.groupBy("doc", "mark").agg(F.collect_list(F.struct("start", F.col("windows").alias("length"))).alias("spans"))


def merged(spans: list[dict], width: int) -> list[tuple[int, int]]:
    """Maximal runs of units (begin, end) that removed windows cover."""
    out: list[tuple[int, int]] = []
    for begin, end in sorted((s["start"], s["start"] + s["length"] + width - 1) for s in spans):
        if out and begin <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((begin, end))
    return out


def with_spans(docs: DataFrame, row, spans: DataFrame, doc_id: str, text: str) -> DataFrame:
    """(row, text, spans) for every document; spans is null where nothing goes."""
    own = read(docs.withColumn("_row", row), doc_id, text, "_row")
    return own.join(spans, ["doc", "mark"], "left").select(F.col("_row").alias("row"), "text", "spans")
