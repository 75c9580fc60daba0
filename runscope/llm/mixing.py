"""Mixing sources to target weights: a van der Corput schedule of slots, each filled with a block of its source's shuffled words.

Targets. Sources in the order of their code points, null last, take the weights in turn and share all words by them; a target stops at
`most_epochs` times its source's words and the excess goes to the others by weight, until none is above (`with_targets`).

Schedule. Slot i has the point that i's bits give when they are reversed, a number below 2^52. Cumulative targets cut those points into
one interval a source: a slot belongs to the source whose interval holds its point, so any stretch of slots has each source near its
share. A source takes the slots of its first ranks, as many as it has blocks. The slot of a rank is found by descending the bits of the
slot, counting the points of each half inside the interval: exact, for each rank by itself, without a sort of all slots.

Blocks. A source's documents stand in an order by a hash, another one in each epoch; their words in a row, epoch after epoch up to the
target rounded to whole words, are cut into blocks of `block_words`, the last one shorter. Blocks meet slots by source and rank. So a
source takes its target to half a word, and a document `most_epochs` times its size at most.

Places in a source are sums over slices of the hash's range, so a source with a third of all rows is dealt over its slices. Numbers of
sources, ranks and slots grow as tables; the driver sees sums only.

Defined cases: null texts have no words; a null source is a source of its own; null doc_ids and repeated rows are documents each, and rows
equal in doc_id and text are interchangeable; documents without words are listed and take nothing, as do all if there are no words; an
empty table gives an empty mix; other columns are ignored. Reruns agree, whatever the partitions.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from runscope.llm.shared import landed, ship

#: Bits of a point.
BITS = 52
#: Ranks of a source that one row of the schedule's input stands for.
CHUNK = 4096
SALTS = 32


def words_in(text: Column) -> Column:
    """Maximal runs of anything but space and the controls from tab to carriage return."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def slots_of(first: np.ndarray, end: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """The slot of the rank-th point, in the order of slots, among those in [first, end)."""
    slot, point, rank = np.zeros_like(rank), np.zeros_like(rank), rank.copy()
    for bit in range(BITS - 1, -1, -1):
        step = 1 << (BITS - bit)  # of the points that share the bits of the slot above this one, and have a zero here
        here = (point - first) // step - (point - end) // step
        beyond = rank >= here
        rank -= np.where(beyond, here, 0)
        slot += np.where(beyond, 1 << bit, 0)
        point += np.where(beyond, 1 << (BITS - 1 - bit), 0)
    return slot


def _schedule(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(number, first, end, rank, ranks) -> (number, rank, slot) for each of the ranks."""
    for batch in batches:
        number, first, end, rank, ranks = (batch.column(c).to_numpy() for c in ("number", "first", "end", "rank", "ranks"))
        for i in range(len(number)):
            own = rank[i] + np.arange(ranks[i])
            slot = slots_of(np.full(len(own), first[i]), np.full(len(own), end[i]), own)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(own), number[i])), pa.array(own), pa.array(slot)], names=["number", "rank", "slot"])


def _before(rows: DataFrame, value: Column, name: str) -> DataFrame:
    """rows with the sum of value over the rows that stand before, by their `at` (a partition's number above 33 bits); one row a partition meets in one task."""
    part = F.shiftright("at", 33)
    own = rows.withColumns({"_part": part, "_value": value})
    sums = own.groupBy("_part").agg(F.sum("_value").alias("_sum"))
    before = lambda w: F.coalesce(F.sum(w[1]).over(w[0].rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    base = sums.select("_part", before((Window.orderBy("_part"), "_sum")).alias("_base"))
    out = own.join(base, "_part").withColumn(name, F.col("_base") + before((Window.partitionBy("_part").orderBy("at"), "_value")))
    return out.drop("_part", "_value", "_base")


def with_targets(sources: DataFrame, weights: Sequence[float], most_epochs: int) -> DataFrame:
    """sources (source, source_size, rows) with their number, target (double) and words: the target in whole words.

    The level is what a weight of one gets: it rises, one sum over the sources after another, until no more sources stop at their most.
    """
    in_order = landed(sources.orderBy(F.col("source").asc_nulls_last()).withColumn("at", F.monotonically_increasing_id()), "mix-sources")
    numbered = _before(in_order, F.lit(1).cast("long"), "number")
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("number") % len(weights) + 1).cast("int"))
    weighed = landed(numbered.withColumns({"weight": weight, "most": F.col("source_size") * most_epochs}), "mix-weights")
    total = weighed.agg(F.sum("source_size")).first()[0] or 0
    level, stopped = 0.0, -1
    while total:
        full = F.col("most") <= F.col("weight") * level
        at_most, free, now = weighed.agg(F.coalesce(F.sum(F.when(full, F.col("most"))), F.lit(0)), F.sum(F.when(~full, F.col("weight"))), F.count(F.when(full, 1))).first()
        if not free or now == stopped:
            break
        level, stopped = (total - at_most) / free, now
    target = F.least(F.col("most").cast("double"), F.col("weight") * level)
    return weighed.withColumn("target", target).withColumn("words", F.rint("target").cast("long"))


@dataclass
class Mix:
    """documents: every document with size, source_size, target and taken. pieces: (slot, place, source, epoch, doc_id, start, length), places in words."""

    documents: DataFrame
    pieces: DataFrame


def mix(
    docs: DataFrame, weights: Sequence[float] = (5, 2, 1), most_epochs: int = 3, block_words: int = 4096, slice_rows: int = 5_000, seed: int = 17, doc_id: str = "doc_id", text: str = "text", source: str = "source"
) -> Mix:
    spark = docs.sparkSession
    ship(spark)
    own = docs.select(F.col(doc_id).alias("doc_id"), F.col(source).cast("string").alias("source"), words_in(F.col(text)).alias("size"), F.xxhash64(doc_id, text).alias("key"))
    sized = landed(own.withColumn("row", F.monotonically_increasing_id()), "mix-documents")
    sources = landed(with_targets(sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("rows")), weights, most_epochs), "mix-targets")
    salted = sources.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))).withColumnRenamed("source", "_source")
    dealt = sized.withColumn("salt", F.pmod("row", F.lit(SALTS)).cast("int"))
    known = dealt.join(salted, F.col("source").eqNullSafe(F.col("_source")) & (dealt["salt"] == salted["salt"])).drop("salt", "_source")
    pieces = _pieces(known, block_words, slice_rows, seed).join(_slots(sources, block_words), ["number", "rank"])
    pieces = landed(pieces.select("row", "slot", "place", "source", "epoch", "doc_id", "start", "length"), "mix-pieces")
    taken = pieces.groupBy("row").agg(F.sum("length").alias("taken"))
    documents = known.join(taken, "row", "left").select("doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).alias("taken"))
    return Mix(documents, pieces.drop("row"))


def _pieces(known: DataFrame, block_words: int, slice_rows: int, seed: int) -> DataFrame:
    """The words of each document that the mix takes, cut at the borders of blocks: number and rank of the block, epoch, start, length and place in it."""
    epochs = F.ceil(F.col("words") / F.col("source_size"))
    read = known.filter("size > 0 and words > 0").withColumn("epoch", F.explode(F.sequence(F.lit(0).cast("long"), epochs - 1)))
    order = F.xxhash64("key", "epoch", F.lit(seed))
    share = F.shiftrightunsigned(order, 1) / F.lit(float(1 << 63))
    read = read.withColumns({"order": order, "slice": F.floor(share * F.ceil(F.col("rows") / slice_rows))})
    group = ["number", "epoch", "slice"]
    sums = read.groupBy(*group).agg(F.sum("size").alias("_sum"))
    base = sums.select(*group, F.sum("_sum").over(Window.partitionBy("number", "epoch").orderBy("slice")).alias("_end"), "_sum")
    inside = F.sum("size").over(Window.partitionBy(*group).orderBy("order", "key", "row"))
    placed = read.join(base, group).withColumn("begin", F.col("epoch") * F.col("source_size") + F.col("_end") - F.col("_sum") + inside - F.col("size"))
    placed = placed.withColumn("end", F.least(F.col("begin") + F.col("size"), F.col("words"))).filter("begin < end")
    cut = placed.withColumn("rank", F.explode(F.expr(f"sequence(begin div {block_words}, (end - 1) div {block_words})")))
    first = F.greatest("begin", F.col("rank") * block_words)
    last = F.least("end", (F.col("rank") + 1) * block_words)
    return cut.select("number", "rank", "row", "doc_id", "source", "epoch", (first - F.col("begin")).alias("start"), (last - first).alias("length"), (first - F.col("rank") * block_words).alias("place"))


def _slots(sources: DataFrame, block_words: int) -> DataFrame:
    """(number, rank, slot) of all blocks of the mix."""
    total = sources.agg(F.sum("words")).first()[0] or 1
    ends = _before(sources, F.col("words"), "words_before")
    point = lambda words: F.expr(f"(cast({words} as decimal(20,0)) * {1 << BITS}) div {total}")
    blocks = F.ceil(F.col("words") / block_words)
    chunks = ends.filter("words > 0").select("number", point("words_before").alias("first"), point("words_before + words").alias("end"), blocks.alias("blocks"))
    chunks = chunks.withColumn("rank", F.explode(F.expr(f"sequence(0L, blocks - 1, {CHUNK}L)"))).withColumn("ranks", F.least(F.lit(CHUNK), F.col("blocks") - F.col("rank")))
    dealt = chunks.repartition(F.xxhash64("number", "rank"))  # a large source has many chunks
    return dealt.select("number", "first", "end", "rank", "ranks").mapInArrow(_schedule, "number long, rank long, slot long")
