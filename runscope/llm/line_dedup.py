"""Line dedup that can be taken back: exact reference counts of lines, with sharded cuckoo filters in front.

A store holds three logs. `refs` has a row for each (line key, document that holds it), put in or taken out; `repeated` has the keys
that two or more documents refer to, with their numbers of references and their smallest document: the exact reference-count table;
`filters` has a cuckoo filter for each shard of the key space, holding the repeated keys. `insert` and `delete` append the rows of
the keys that a batch touches and the filters of the shards in which a key became repeated or ceased to be; nothing else is
written, and deleting a batch gives back the store as it was. Shards are doubled when they hold more than `shard_keys` on average, and
every `most_batches` batches the logs are written anew, as one.

`drop_repeated` reads documents against a store. Line keys travel to their shard and meet its filter; the few that it knows are
looked up among the shard's exact keys, so a filter's false positives never drop a line. Keys that a large share of the lines have
would crowd their shard: those with a ten-thousandth of all references, and 10,000 at least, are at most 10,000 keys, are sent to
every task with their smallest document and decided there.

Line key: the line without `[\\x20\\x09-\\x0D]` at both ends, A-Z lower-cased, as 128 bits of blake2b. Keys of fewer than
`min_chars` code points never count. A line is dropped if its key is also in a document with a smaller doc_id.

Defined cases: null or empty text is one empty line; a null doc_id counts as larger than all others, and all null ones as one document;
rows of one doc_id are one document for the counts, and each is rewritten; other columns are ignored; an empty table gives an empty
result.
"""

from __future__ import annotations

import dataclasses
import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from runscope.llm import arrays as A
from runscope.llm.shared import landed, ship

STRIP = b"\x20\x09\x0a\x0b\x0c\x0d"
LAST_ID = (1 << 63) - 1
SLOTS = 4
KEY = ("hi", "lo")


def line_key(line: bytes, min_chars: int) -> bytes | None:
    """128 bits for a line that can count, else None. bytes.lower() changes A-Z only."""
    key = line.strip(STRIP)
    if len(key) < min_chars:  # there are no more code points than bytes
        return None
    key = key.lower()
    if not key.isascii() and len(key) < 4 * min_chars and len(key.decode("utf-8", "replace")) < min_chars:
        return None
    return hashlib.blake2b(key, digest_size=16).digest()


def shard_of(hi: np.ndarray, shards: int) -> np.ndarray:
    return ((hi.view(np.uint64) >> np.uint64(32)) * np.uint64(shards)) >> np.uint64(32)


class CuckooFilter:
    """Buckets of four 16-bit fingerprints; a key lies in one of two buckets. Keys are (hi, lo) pairs of 64 bits."""

    def __init__(self, table: np.ndarray):
        self.table = table
        self.mask = np.uint64(len(table) - 1)

    @classmethod
    def of(cls, hi: np.ndarray, lo: np.ndarray) -> CuckooFilter:
        buckets = 1 << max(0, int(np.ceil(np.log2(max(1, len(hi)) / (SLOTS * 0.8)))))
        while True:
            filled = cls(np.zeros((buckets, SLOTS), np.uint16))
            if filled.insert(hi, lo):
                return filled
            buckets *= 2

    @classmethod
    def read(cls, blob: bytes) -> CuckooFilter:
        return cls(np.frombuffer(blob, np.uint16).reshape(-1, SLOTS).copy())

    def blob(self) -> bytes:
        return self.table.tobytes()

    def places(self, hi: np.ndarray, lo: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Fingerprint (never 0) and the two buckets of each key."""
        lo = lo.view(np.uint64)
        prints = (lo >> np.uint64(48)).astype(np.uint16)
        prints[prints == 0] = 1
        first = lo & self.mask
        return prints, first, self.other(first, prints)

    def other(self, bucket: np.ndarray, prints: np.ndarray) -> np.ndarray:
        return (bucket ^ ((prints.astype(np.uint64) * np.uint64(0x5BD1E995)) >> np.uint64(7))) & self.mask

    def contains(self, hi: np.ndarray, lo: np.ndarray) -> np.ndarray:
        prints, first, second = self.places(hi, lo)
        return (self.table[first] == prints[:, None]).any(1) | (self.table[second] == prints[:, None]).any(1)

    def insert(self, hi: np.ndarray, lo: np.ndarray) -> bool:
        """False if a key found no slot; the filter is then to be made anew, larger. Only keys whose two buckets are full go one by one."""
        prints, first, second = self.places(hi, lo)
        left = np.flatnonzero(~self._take(first, np.zeros_like(prints), prints))
        left = left[~self._take(second[left], np.zeros_like(prints[left]), prints[left])]
        return all(self._kick(b, one) for b, one in zip(second[left].tolist(), prints[left].tolist(), strict=True))

    def delete(self, hi: np.ndarray, lo: np.ndarray) -> None:
        """Only for keys that were inserted."""
        prints, first, second = self.places(hi, lo)
        left = np.flatnonzero(~self._take(first, prints, np.zeros_like(prints)))
        self._take(second[left], prints[left], np.zeros_like(prints[left]))

    def _take(self, buckets: np.ndarray, old: np.ndarray, new: np.ndarray) -> np.ndarray:
        """Puts each new value in a slot of its bucket that holds the old one, no slot twice; which found one."""
        order = np.lexsort((old, buckets))
        b, o = buckets[order], old[order]
        first, last = A.runs(np.append(True, (b[1:] != b[:-1]) | (o[1:] != o[:-1]))[: len(b)])
        rank = np.arange(len(b)) - np.repeat(first, last - first)
        fits = self.table[b] == o[:, None]
        chosen = fits & (np.cumsum(fits, axis=1) == rank[:, None] + 1)
        row, slot = np.nonzero(chosen)
        self.table[b[row], slot] = new[order][row]
        found = np.zeros(len(b), bool)
        found[order[row]] = True
        return found

    def _put(self, bucket: int, one: int) -> bool:
        row = self.table[bucket]
        for slot in range(SLOTS):
            if not row[slot]:
                row[slot] = one
                return True
        return False

    def _kick(self, bucket: int, one: int) -> bool:
        for turn in range(500):
            slot = turn % SLOTS
            one, self.table[bucket, slot] = int(self.table[bucket, slot]), one
            bucket = int(self.other(np.uint64(bucket), np.asarray(one, np.uint16)))
            if self._put(bucket, one):
                return True
        return False


def _keys(min_chars: int):
    """(doc, mark, text) -> (doc, mark, hi, lo) once for each row's different keys."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, keys = [], []
            for row, text in enumerate(batch.column("text")):
                own = {line_key(line, min_chars) for line in (text.as_buffer().to_pybytes() if text.is_valid else b"").split(b"\n")}
                own.discard(None)
                keys += own
                rows += [row] * len(own)
                if len(keys) > 200_000:
                    yield _key_batch(batch, rows, keys)
                    rows, keys = [], []
            yield _key_batch(batch, rows, keys)

    return run


def _key_batch(batch: pa.RecordBatch, rows: list[int], keys: list[bytes]) -> pa.RecordBatch:
    both = np.frombuffer(b"".join(keys), np.int64).reshape(-1, 2)
    at = pa.array(rows, pa.int64())
    return pa.RecordBatch.from_arrays([batch.column("doc").take(at), batch.column("mark").take(at), pa.array(both[:, 0]), pa.array(both[:, 1])], names=["doc", "mark", *KEY])


def _read(docs: DataFrame, doc_id: str, text: str, *more: Column) -> DataFrame:
    """(doc, mark: a hash of the text, text) and more: rows of one doc_id, or of none, are told apart by their texts."""
    own = docs.select(F.coalesce(F.col(doc_id).cast("long"), F.lit(LAST_ID)).alias("doc"), F.col(text).cast("binary").alias("text"), *more)
    return own.withColumn("mark", F.xxhash64("text"))


def references(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", min_chars: int = 10) -> DataFrame:
    """(doc, hi, lo): each long line's key with each document that holds it, once."""
    ship(docs.sparkSession)
    lines = _read(docs, doc_id, text).select("doc", "mark", "text").mapInArrow(_keys(min_chars), "doc long, mark long, hi long, lo long")
    return lines.select("doc", *KEY).distinct()


def counted(refs: DataFrame) -> DataFrame:
    """Keys of two or more documents, with their references. All is combined before the shuffle, so a hot key is a row a task."""
    both = refs.groupBy(*KEY).agg(F.count("*").alias("n"), F.min("doc").alias("first_doc"), F.max("doc").alias("last_doc"))
    return both.filter("first_doc < last_doc")


VALUES = ("n", "first_doc", "last_doc")


@dataclass(frozen=True)
class LineStore:
    """Logs refs (doc, hi, lo, change: 1 or -1), repeated (hi, lo, n, first_doc, last_doc, version) and filters (shard, filter, version).

    Of a key or a shard the row with the largest version holds; keys: how many are repeated.
    """

    refs: DataFrame
    repeated: DataFrame
    filters: DataFrame
    shards: int
    keys: int
    version: int = 0
    min_chars: int = 10
    shard_keys: int = 100_000
    most_batches: int = 16

    @classmethod
    def of(cls, docs: DataFrame, doc_id: str = "doc_id", text: str = "text", min_chars: int = 10, shard_keys: int = 100_000) -> LineStore:
        """A store with these documents; one doc_id's rows count once."""
        refs = references(docs, doc_id, text, min_chars)
        repeated = landed(counted(refs).withColumn("version", F.lit(0)), "repeated-lines")
        keys = repeated.count()
        shards = max(1, -(-keys // shard_keys))
        return cls(refs.withColumn("change", F.lit(1)), repeated, filters_of(repeated, shards, 0), shards, keys, 0, min_chars, shard_keys)

    def live_refs(self, only: DataFrame | None = None, on: tuple[str, ...] = KEY) -> DataFrame:
        """(doc, hi, lo) that hold now; only: those whose `on` columns stand in it."""
        log = self.refs if only is None else self.refs.join(only, list(on), "left_semi")
        return log.groupBy("doc", *KEY).agg(F.sum("change").alias("change")).filter("change > 0").drop("change")

    def live_repeated(self, only: DataFrame | None = None) -> DataFrame:
        """(hi, lo, n, first_doc, last_doc) of the keys that are repeated now; only: of these keys."""
        log = self.repeated if only is None else self.repeated.join(only, list(KEY), "left_semi")
        if not self.version:
            return log.select(*KEY, *VALUES)
        return log.groupBy(*KEY).agg(F.max_by(F.struct(*VALUES), "version").alias("now")).select(*KEY, "now.*").filter("n > 0")

    def live_filters(self) -> DataFrame:
        return self.filters.groupBy("shard").agg(F.max_by("filter", "version").alias("filter"))

    def insert(self, docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> LineStore:
        """The store with further documents; a (key, document) that is there already is not counted twice."""
        new = landed(references(docs, doc_id, text, self.min_chars), "line-batch")
        known = self.live_refs(new.select(*KEY).distinct())
        return self._changed(new.join(known, ["doc", *KEY], "left_anti").withColumn("change", F.lit(1)))

    def delete(self, docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> LineStore:
        """The store without these documents (all lines held under their doc_ids)."""
        gone = _read(docs, doc_id, text).select("doc").distinct()
        return self._changed(self.live_refs(gone, ("doc",)).withColumn("change", F.lit(-1)))

    def _changed(self, batch: DataFrame) -> LineStore:
        """Counts only the touched keys anew, and puts them into the filters or takes them out."""
        batch, version = landed(batch.select("doc", *KEY, "change"), "line-refs"), self.version + 1
        touched = batch.select(*KEY).distinct()
        log = dataclasses.replace(self, refs=self.refs.unionByName(batch))
        now, was = counted(log.live_refs(touched)), self.live_repeated(touched)
        both = now.join(was.select(*KEY, F.lit(True).alias("was")), list(KEY), "full")
        rows = landed(both.select(*KEY, F.coalesce("n", F.lit(0)).alias("n"), "first_doc", "last_doc", F.lit(version).alias("version"), (F.coalesce("n", F.lit(0)) > 0).cast("int").alias("is"), F.coalesce("was", F.lit(False)).cast("int").alias("was")), "repeated-lines")
        changes = rows.select(*KEY, (F.col("is") - F.col("was")).alias("change")).filter("change <> 0")
        keys = self.keys + (changes.agg(F.sum("change")).first()[0] or 0)
        log = dataclasses.replace(log, repeated=self.repeated.unionByName(rows.select(*self.repeated.columns)), keys=keys, version=version)
        if version % self.most_batches == 0:
            log = dataclasses.replace(log, refs=landed(log.live_refs().withColumn("change", F.lit(1)), "line-refs"), repeated=landed(log.live_repeated().withColumn("version", F.lit(version)), "repeated-lines"))
        shards = self.shards
        while keys > 2 * shards * self.shard_keys:
            shards *= 2
        if shards > self.shards or version % self.most_batches == 0:
            return dataclasses.replace(log, shards=shards, filters=filters_of(log.live_repeated(), shards, version))
        return dataclasses.replace(log, filters=self.filters.unionByName(_updated(log, changes)))


def _sharded(keys: DataFrame, shards: int) -> DataFrame:
    return keys.withColumn("shard", F.expr(f"cast((shiftrightunsigned(hi, 32) * {shards}L) >> 32 as int)"))


FILTER = "shard int, filter binary, version int"


def _filter_row(shard: int, made: CuckooFilter | None, version: int) -> pa.Table:
    return pa.table({"shard": pa.array([shard], pa.int32()), "filter": pa.array([made and made.blob()], pa.binary()), "version": pa.array([version], pa.int32())})


def filters_of(keys: DataFrame, shards: int, version: int) -> DataFrame:
    """(shard, filter, version) of the keys; a shard has a bounded number of keys, as shards are made by their count."""

    def build(key, table):
        return _filter_row(key[0].as_py(), CuckooFilter.of(table["hi"].to_numpy(), table["lo"].to_numpy()), version)

    return landed(_sharded(keys.select(*KEY), shards).groupBy("shard").applyInArrow(build, FILTER), "line-filters")


def _updated(store: LineStore, changes: DataFrame) -> DataFrame:
    """New filters (shard, filter, version) of the shards that changes (hi, lo, change) touch; one that overflows is made anew from its keys."""
    version = store.version

    def change(key, have, rows):
        old = CuckooFilter.read(have["filter"][0].as_py()) if have.num_rows else CuckooFilter.of(np.zeros(0, np.int64), np.zeros(0, np.int64))
        hi, lo, way = (rows[c].to_numpy() for c in (*KEY, "change"))
        old.delete(hi[way < 0], lo[way < 0])
        full = not old.insert(hi[way > 0], lo[way > 0])
        return _filter_row(key[0].as_py(), None if full else old, version)

    changes = _sharded(changes, store.shards)
    have = store.live_filters().join(changes.select("shard").distinct(), "shard", "left_semi")
    changed = landed(have.groupBy("shard").cogroup(changes.groupBy("shard")).applyInArrow(change, FILTER), "line-filters")
    full = changed.filter("filter is null").select("shard")
    if full.isEmpty():
        return changed
    anew = filters_of(_sharded(store.live_repeated(), store.shards).join(full, "shard", "left_semi"), store.shards, version)
    return landed(changed.filter("filter is not null").unionByName(anew), "line-filters")


def heavy_keys(store: LineStore, share: float = 1e-4, least: int = 10_000) -> np.ndarray:
    """[keys, 3] hi, lo and smallest document of the keys with `share` of all references and `least` at least: 1 / share rows at most."""
    live = store.live_repeated()
    total = live.agg(F.sum("n")).first()[0] or 0
    rows = live.filter(F.col("n") >= max(least, total * share)).select(*KEY, "first_doc").collect()
    return np.array(sorted(map(tuple, rows)), np.int64).reshape(-1, 3)


def _routed(min_chars: int, shards: int, salts: int, heavy):
    """(doc, mark, text) -> (shard, salt, doc, mark, hi, lo, known): lines to look up, and those of heavy keys that go (known), which only pass by."""
    keys = _keys(min_chars)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = heavy.value
        names = own[:, 0].view(np.uint64) ^ (own[:, 1].view(np.uint64) >> np.uint64(1))
        order = np.argsort(names)
        own, names = own[order], names[order]
        for batch in keys(batches):
            hi, lo, doc = (np.ascontiguousarray(batch.column(c).to_numpy()) for c in (*KEY, "doc"))
            known, keep = np.zeros(len(hi), bool), np.ones(len(hi), bool)
            if len(own):
                at = np.minimum(np.searchsorted(names, hi.view(np.uint64) ^ (lo.view(np.uint64) >> np.uint64(1))), len(own) - 1)
                known = (own[at, 0] == hi) & (own[at, 1] == lo)
                keep = ~known | (own[at, 2] < doc)
            salt = (A.mixed(doc.view(np.uint64)) % np.uint64(salts)).astype(np.int32)
            shard = np.where(known, A.mixed(doc.view(np.uint64) + np.uint64(1)) % np.uint64(shards), shard_of(hi, shards)).astype(np.int32)
            out = pa.RecordBatch.from_arrays([pa.array(shard), pa.array(salt), *batch.columns, pa.array(known)], names=["shard", "salt", *batch.schema.names, "known"])
            yield out.filter(pa.array(keep))

    return run


def _look_up(key, lines: pa.Table, shard: pa.Table) -> pa.Table:
    """The lines of a shard that go: its filter knows them and its exact keys (with the filter in a row of their own) agree."""
    out = lines.select(["doc", "mark", *KEY])
    known = lines["known"].to_numpy()
    filters = shard["filter"].drop_null()
    if not len(filters):
        return out.filter(pa.array(known))
    hi, lo, doc = (np.ascontiguousarray(lines[c].to_numpy()) for c in (*KEY, "doc"))
    suspect = np.flatnonzero(~known & CuckooFilter.read(filters[0].as_py()).contains(hi, lo))
    exact = shard.filter(shard["filter"].is_null())
    exact_hi, exact_lo, first = (np.ascontiguousarray(exact[c].to_numpy()) for c in (*KEY, "first_doc"))
    order = np.argsort(exact_hi, kind="stable")
    exact_hi, exact_lo, first = exact_hi[order], exact_lo[order], first[order]
    begin, end = (np.searchsorted(exact_hi, hi[suspect], side=s) for s in ("left", "right"))
    line, place = np.repeat(suspect, end - begin), A.spread(begin, end - begin)  # all exact keys with this first half
    goes = line[(exact_lo[place] == lo[line]) & (first[place] < doc[line])]
    known[goes] = True
    return out.filter(pa.array(known))


def repeats(docs: DataFrame, store: LineStore, doc_id: str = "doc_id", text: str = "text", group_bytes: int = 16 << 20) -> DataFrame:
    """(doc, mark, drop): for each document with lines to drop, their keys. group_bytes: of text, whose lines of one shard are looked up together."""
    ship(docs.sparkSession)
    size = docs.agg(F.sum(F.octet_length(text))).first()[0] or 0
    salts = max(1, -(-size // (group_bytes * store.shards)))
    heavy = docs.sparkSession.sparkContext.broadcast(heavy_keys(store))  # 10,000 keys at most
    where = "shard int, salt int, doc long, mark long, hi long, lo long, known boolean"
    lines = _read(docs, doc_id, text).select("doc", "mark", "text").mapInArrow(_routed(store.min_chars, store.shards, salts, heavy), where)
    exact = _sharded(store.live_repeated(), store.shards).select("shard", *KEY, "first_doc", F.lit(None).cast("binary").alias("filter"))
    filters = store.live_filters().select("shard", *[F.lit(None).cast("long").alias(c) for c in (*KEY, "first_doc")], "filter")
    held = exact.unionByName(filters).withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    dropped = lines.groupBy("shard", "salt").cogroup(held.groupBy("shard", "salt")).applyInArrow(_look_up, "doc long, mark long, hi long, lo long")
    return dropped.groupBy("doc", "mark").agg(F.collect_set(F.struct(*KEY)).alias("drop"))


def _rewrite(min_chars: int):
    """(doc_id, text, drop) -> (doc_id, text without those lines, numbers of lines, sha256 of the text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept, lines, dropped, digests = [], [], [], []
            for text, drop in zip(batch.column("text"), batch.column("drop"), strict=True):
                whole = text.as_buffer().to_pybytes() if text.is_valid else b""
                own = whole.split(b"\n")
                stay = own
                if drop.is_valid:
                    gone = {r["hi"].to_bytes(8, "little", signed=True) + r["lo"].to_bytes(8, "little", signed=True) for r in drop.as_py()}
                    stay = [x for x in own if line_key(x, min_chars) not in gone]
                left = b"\n".join(stay) if len(stay) < len(own) else whole
                kept.append(left)
                lines.append(len(own))
                dropped.append(len(own) - len(stay))
                digests.append(hashlib.sha256(left).hexdigest())
            out = [batch.column("row"), pa.array(kept, pa.large_binary()).cast(pa.binary()), pa.array(lines, pa.int64()), pa.array(dropped, pa.int64()), pa.array(digests, pa.string())]
            yield pa.RecordBatch.from_arrays(out, names=["row", "kept", "n_lines", "n_dropped", "kept_sha256"])

    return run


def drop_repeated(docs: DataFrame, store: LineStore, row: Column, row_type: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(row, kept: text as binary, n_lines, n_dropped, kept_sha256) for every document; row: what to carry along."""
    own = _read(docs, doc_id, text, row.alias("row"))
    joined = own.join(repeats(docs, store, doc_id, text), ["doc", "mark"], "left").select("row", "text", "drop")
    return joined.mapInArrow(_rewrite(store.min_chars), f"row {row_type}, kept binary, n_lines long, n_dropped long, kept_sha256 string")
