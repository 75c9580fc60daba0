"""Best-two-fit packing of tokenised documents into sequences of a fixed capacity.

Each document becomes its token ids and a closing id; only longer ones are cut into pieces of `capacity`. Packing needs to
know only how many pieces there are of each length, at most `capacity` numbers, so the plan is made from that histogram: a
bin is filled greedily, longest fitting piece first; then its smallest piece is replaced by two unpacked ones if these fill the
gap so made more tightly; the bin is repeated for as long as its lengths last. The task that encodes a piece numbers it among its
own of that length; with the counts of the tasks before it that gives its rank, and by its rank each piece finds its place in
the plan. So neither the driver nor one task ever holds the pieces, and nothing is sorted.

Defined cases: null or empty text is the closing id alone; repeated documents are packed each; other columns are ignored; an
empty table has no pieces. A null doc_id is carried along.
"""

from __future__ import annotations

import os
import zlib
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from runscope.llm import arrays as A
from runscope.llm.shared import landed, ship

#: Words that a worker remembers and ids of them, and bytes of text that it encodes at a time.
CACHE, CACHE_IDS, SLICE = 400_000, 8 << 20, 4 << 20
#: Stands behind each word of those that are encoded together; words that hold it are encoded alone.
MARK = "\x01"
_encoders: dict[str, TextEncoder] = {}  # one for each tokenizer file in a worker, kept from task to task


class WordStore:
    """Ids of words: word i has sizes[i] of them from starts[i] on. When it is full, the half that fewest slices held is forgotten."""

    def __init__(self, encode):
        self.encode = encode
        self.number: dict[str, int] = {}
        self.starts, self.sizes, self.uses, self.ids = (np.zeros(0, np.int64) for _ in range(4))

    def numbers(self, words: list[str]) -> np.ndarray:
        """The number of each of these different words; those that are new are encoded."""
        new = [w for w in words if w not in self.number]
        if len(self.number) + len(new) > CACHE or len(self.ids) > CACHE_IDS:
            self.forget()
            new = [w for w in words if w not in self.number]
        if new:
            ids, sizes = self.encode(new)
            self.number.update(zip(new, range(len(self.number), len(self.number) + len(new)), strict=True))
            self.starts = np.concatenate([self.starts, len(self.ids) + np.cumsum(sizes) - sizes])
            self.sizes, self.ids = np.concatenate([self.sizes, sizes]), np.concatenate([self.ids, ids])
            self.uses = np.append(self.uses, np.zeros(len(new), np.int64))
        found = np.fromiter(map(self.number.__getitem__, words), np.int64, len(words))
        self.uses[found] += 1
        return found

    def forget(self) -> None:
        if not len(self.uses):
            return
        middle = len(self.uses) // 2
        keep = np.flatnonzero(self.uses > np.partition(self.uses, middle)[middle])
        words = list(self.number)  # in the order of their numbers
        self.number = {words[i]: n for n, i in enumerate(keep.tolist())}
        self.ids = self.ids[A.spread(self.starts[keep], self.sizes[keep])]
        self.sizes, self.uses = self.sizes[keep], self.uses[keep] // 2
        self.starts = np.cumsum(self.sizes) - self.sizes


class TextEncoder:
    """Ids of texts for a tokenizer that drops blanks, so that no token crosses one: what stands between blanks is encoded once.

    Rows of characters under U+0300, which NFC leaves alone, are lower-cased here if the tokenizer's normaliser does no more than
    that to them, and full stops and commas are then parted from a letter before them, where a token ends too. Rows that may hold a
    special token are encoded as they are, as those are found before normalising.
    """

    def __init__(self, file: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs a worker for each core; threads would each keep memory
        from tokenizers import Tokenizer, normalizers

        self.tokenizer = Tokenizer.from_file(file)
        self.normalizer, self.none = self.tokenizer.normalizer, normalizers.Sequence([])
        mark = self.tokenizer.encode(MARK, add_special_tokens=False).ids
        self.mark = mark[0] if len(mark) == 1 else -1
        suffix = getattr(self.tokenizer.model, "end_of_word_suffix", None)
        self.ends_word = np.zeros(self.tokenizer.get_vocab_size(), bool)
        self.ends_word[[i for t, i in self.tokenizer.get_vocab().items() if suffix and t.endswith(suffix)]] = True
        probe = "AZ a\u00c9\u0130 .,"
        self.lowers = self.normalizer is not None and self.normalizer.normalize_str(probe) == probe.lower()
        self.special = sorted({t.content.lower().encode() for t in self.tokenizer.get_added_tokens_decoder().values()})
        self.plain, self.other = WordStore(lambda words: self.encoded(words, self.none)), WordStore(lambda words: self.encoded(words, self.normalizer))

    def encoded(self, words: list[str], normalizer) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the words in one array, and the number of each word's."""
        if normalizer is not None:
            self.tokenizer.normalizer = normalizer
        words = [w.rstrip(" ") for w in words]
        letters = np.fromiter((w.isalpha() for w in words), bool, len(words)) & self.ends_word.any()
        order = np.concatenate([np.flatnonzero(letters), np.flatnonzero(~letters)])
        # words of letters are one each to the tokenizer: their last tokens tell where they end
        parts = [self.together([words[i] for i in np.flatnonzero(letters).tolist()], " "), self.together([words[i] for i in np.flatnonzero(~letters).tolist()], f" {MARK} ")]
        ids, sizes = (np.concatenate([p[k] for p in parts]) for k in (0, 1))
        starts, at = np.cumsum(sizes) - sizes, np.empty(len(words), np.int64)
        at[order] = np.arange(len(words))
        return ids[A.spread(starts[at], sizes[at])], sizes[at]

    def together(self, words: list[str], between: str, size: int = 256) -> tuple[np.ndarray, np.ndarray]:
        """The same, for many words at a time with something between them; where that does not tell them apart, each alone."""
        encode, marked = self.tokenizer.encode_batch_fast, between != " "
        groups = [words[i : i + size] for i in range(0, len(words), size)]
        ids, sizes = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for group, joined in zip(groups, encode([between.join([*g, ""]) for g in groups], add_special_tokens=False), strict=True):
            own = np.array(joined.ids, np.int64)
            last = own == self.mark if marked else self.ends_word[own]
            cuts = np.flatnonzero(last)
            if len(cuts) == len(group):
                ids.append(own[~last] if marked else own)
                sizes.append(np.diff(cuts, prepend=-1) - marked)
            else:
                alone = [np.array(one.ids, np.int64) for one in encode(group, add_special_tokens=False)]
                ids += alone
                sizes.append(np.array([len(x) for x in alone], np.int64))
        return np.concatenate(ids), np.concatenate(sizes)

    def texts(self, buffer: np.ndarray, offsets: np.ndarray, closing: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(rows, their ids in one array, where each row's end): all rows, in one part or two. Each row ends with the closing id."""
        raw = buffer[offsets[0] : offsets[-1]].tobytes()
        begins, ends = offsets[:-1] - offsets[0], offsets[1:] - offsets[0]
        is_plain = np.full(len(begins), self.lowers)
        if self.lowers:
            # in UTF-8 the characters from U+0300 on, and no other bytes, begin with 0xCC or more
            for at in (np.flatnonzero(buffer[offsets[0] : offsets[-1]] >= 0xCC), self.special_places(raw)):
                is_plain[np.searchsorted(ends, at, side="right")] = False
        for rows, store in ((np.flatnonzero(is_plain), self.plain), (np.flatnonzero(~is_plain), self.other)):
            if len(rows):
                texts = [raw[a:b] for a, b in zip(begins[rows].tolist(), ends[rows].tolist(), strict=True)]
                yield rows, *self.row_ids(b" ".join([*texts, b""]), ends[rows] - begins[rows], store, closing)

    def special_places(self, raw: bytes) -> np.ndarray:
        """Where special tokens stand in a text, upper or lower case."""
        low, found = raw.lower(), []
        for token in self.special:
            at = low.find(token)
            while at >= 0:
                found.append(at)
                at = low.find(token, at + 1)
        return np.array(found, np.int64)

    def row_ids(self, joined: bytes, lengths: np.ndarray, store: WordStore, closing: int) -> tuple[np.ndarray, np.ndarray]:
        """For rows that are each followed by a space: all ids, and where each row's end."""
        data = np.frombuffer(joined, np.uint8)
        blanks_to = np.searchsorted(np.flatnonzero((data == 0x20) | (data == 0x0A)), np.cumsum(lengths + 1) - 1, side="right")
        joined = joined.replace(b"\n", b" ")
        if store is self.plain:
            joined = joined.lower() if joined.isascii() else joined.decode().lower().encode()
        data = np.frombuffer(joined, np.uint8)
        cuts = data == 0x20
        row_ends = np.flatnonzero(cuts)[blanks_to - 1]
        if store is self.plain:
            # a cut behind a byte: after blanks, and between a letter and a full stop or comma
            cuts[:-1] |= ((data[1:] == 0x2E) | (data[1:] == 0x2C)) & (data[:-1] >= 0x61) & (data[:-1] <= 0x7A)
        edges = np.append(0, np.flatnonzero(cuts) + 1)
        words = pa.LargeStringArray.from_buffers(len(edges) - 1, pa.py_buffer(edges.astype(np.int64)), pa.py_buffer(joined)).dictionary_encode()
        number = store.numbers(words.dictionary.to_pylist())[words.indices.to_numpy()]
        sizes = store.sizes[number]
        ids = store.ids[A.spread(store.starts[number], sizes)]
        ends = np.cumsum(sizes)[np.searchsorted(edges, row_ends, side="right") - 1]
        return np.insert(ids, ends, closing), ends + np.arange(1, len(ends) + 1)


NAMES = ("doc_id", "piece", "start", "length", "ids_crc32", "task", "nth")
PIECE = "doc_id long, piece int, start long, length long, ids_crc32 long, task int, nth long"


def _pieces(tokenizer: str, closing: int, capacity: int):
    """(doc_id, text) -> a row for each piece: doc_id, piece, start, length, ids_crc32, and its number among the task's of that length."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if tokenizer not in _encoders:
            _encoders[tokenizer] = TextEncoder(tokenizer)
        encoder, context = _encoders[tokenizer], TaskContext.get()
        task = context.partitionId() if context else 0
        counted = np.zeros(capacity + 1, np.int64)
        for batch in batches:
            docs, (buffer, offsets) = batch.column(0), A.texts(batch.column(1))
            for first, last in A.slices(offsets, SLICE):
                for rows, ids, ends in encoder.texts(buffer, offsets[first : last + 1], closing):
                    begins = np.append(0, ends[:-1])
                    many = -(-(ends - begins) // capacity)
                    piece = A.spread(np.zeros(len(rows), np.int64), many)
                    at = np.repeat(begins, many) + piece * capacity
                    to = np.minimum(at + capacity, np.repeat(ends, many))
                    view = memoryview(ids.astype("<u4")).cast("B")
                    crc = [zlib.crc32(view[4 * a : 4 * b]) for a, b in zip(at.tolist(), to.tolist(), strict=True)]
                    length = to - at
                    nth = counted[length] + place_in_run(length)
                    counted += np.bincount(length, minlength=capacity + 1)
                    columns = [docs.take(pa.array(first + np.repeat(rows, many))), pa.array(piece.astype(np.int32)), *(pa.array(x) for x in (piece * capacity, length)), pa.array(crc, pa.int64())]
                    yield pa.RecordBatch.from_arrays([*columns, pa.array(np.full(len(at), task, np.int32)), pa.array(nth)], names=list(NAMES))

    return run


def place_in_run(values: np.ndarray) -> np.ndarray:
    """How many equal values stand before each."""
    order = np.argsort(values, kind="stable")
    first, last = A.runs(np.append(True, np.diff(values[order]) != 0)[: len(values)])
    out = np.empty(len(values), np.int64)
    out[order] = np.arange(len(values)) - np.repeat(first, last - first)
    return out


def pieces(docs: DataFrame, tokenizer: str, closing: int = 0, capacity: int = 2048, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, piece (from 0), start (ids before it in its document), length and crc32 of its little-endian 32-bit ids.

    task and nth: the task that made it, and its number (from 0) among the task's pieces of that length.
    """
    ship(docs.sparkSession)
    own = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return own.mapInArrow(_pieces(tokenizer, closing, capacity), PIECE)


def plan(histogram: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int]]:
    """Slots (length, first rank, bins, first sequence, offset) for the pieces, ranked from 0 within their length.

    A slot takes the pieces of a length with ranks from `first rank` on, one in each of `bins` sequences from `first sequence` on.
    """
    left = {k: n for k, n in histogram.items() if n > 0}
    lengths = sorted(left)
    used = dict.fromkeys(left, 0)
    slots, sequence = [], 0
    while lengths:
        bin_: list[int] = []
        room, spare = capacity, dict(left)
        while (i := bisect_right(lengths, room)) and room:
            while i and not spare[lengths[i - 1]]:
                i -= 1
            if not i:
                break
            take = lengths[i - 1]
            fit = min(spare[take], room // take)
            bin_ += [take] * fit
            spare[take] -= fit
            room -= take * fit
        if room and len(bin_) > 1:
            bin_, room = _two_for_smallest(bin_, room, lengths, spare)
        uses = {k: bin_.count(k) for k in set(bin_)}
        bins = min(left[k] // n for k, n in uses.items())
        offset = 0
        taken = dict(used)
        for k in bin_:
            slots.append((k, taken[k], bins, sequence, offset))
            taken[k] += bins
            offset += k
        used = taken
        sequence += bins
        for k, n in uses.items():
            left[k] -= n * bins
            if not left[k]:
                del left[k]
                lengths.remove(k)
    return slots


def _two_for_smallest(bin_: list[int], room: int, lengths: list[int], spare: dict[int, int]) -> tuple[list[int], int]:
    """The bin with its smallest piece replaced by the two unpacked pieces that fill the larger gap best, if better than before."""
    gap = room + bin_[-1]
    best, pair = bin_[-1], None
    low, high = 0, bisect_right(lengths, gap) - 1
    while low <= high:
        a, b = lengths[low], lengths[high]
        if a + b > gap:
            high -= 1
        elif not spare[b] or (a == b and spare[a] < 2):
            high -= 1
        elif not spare[a]:
            low += 1
        else:
            if a + b > best:
                best, pair = a + b, (b, a)
            low += 1
    if pair is None:
        return bin_, room
    return sorted([*bin_[:-1], *pair], reverse=True), gap - best


def _placed(slots: list[tuple[int, int, int, int, int]]):
    """Adds sequence_id and offset to each piece by its length and rank."""
    by_length = np.array(sorted(slots), np.int64).reshape(-1, 5)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, rank = (batch.column(c).to_numpy() for c in ("length", "rank"))
            begins = np.searchsorted(by_length[:, 0], length)
            keys = by_length[:, 0] * (1 << 40) + by_length[:, 1]
            at = np.searchsorted(keys, length * (1 << 40) + rank, side="right") - 1
            assert (at >= begins).all()
            found = by_length[at]
            own = [batch.column(c) for c in ("doc_id", "piece", "start", "length", "ids_crc32")]
            yield pa.RecordBatch.from_arrays([*own, pa.array(found[:, 3] + rank - found[:, 1]), pa.array(found[:, 4])], names=["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])

    return run


def ranked(pieces: DataFrame) -> DataFrame:
    """Numbers the pieces of each length from 0: those of a task follow those of the tasks before it, so counts are all that is gathered."""
    before = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    counts = pieces.groupBy("length", "task").count()
    firsts = counts.select("length", "task", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("first"))
    return pieces.join(firsts, ["length", "task"]).withColumn("rank", F.col("first") + F.col("nth"))


def pack(docs: DataFrame, tokenizer: str, closing: int = 0, capacity: int = 2048, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset: each piece with its place."""
    all_pieces = landed(pieces(docs, tokenizer, closing, capacity, doc_id, text), "pieces")
    histogram = {r["length"]: r["count"] for r in all_pieces.groupBy("length").count().collect()}  # capacity rows at most
    slots = plan(histogram, capacity)
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"
    return ranked(all_pieces).select("doc_id", "piece", "start", "length", "ids_crc32", "rank").mapInArrow(_placed(slots), schema)
