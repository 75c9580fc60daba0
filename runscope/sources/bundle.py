"""The bundle of normalized tables as JSON lines, and sinks for report sections."""

from __future__ import annotations

import gzip
import json
import struct
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from runscope.sources import files, schemas
from runscope.sources.folders import new_folder, released
from runscope.sources.order import ORDINAL, file_order, numbered

#: The line that a section of a report begins with: its name as JSON.
NAME = r'^("(?:[^"\\]|\\.)*"): '


def write_bundle(tables: dict[str, DataFrame | None], folder: str) -> None:
    """One folder of JSON lines, packed by gzip, for each table that is given; nulls are written out. A table with a column ordinal is written in its order."""
    for name, table in tables.items():
        if table is not None:
            rows = table.orderBy("ordinal").drop("ordinal") if "ordinal" in table.columns else table
            with released(rows.sparkSession):
                rows.write.mode("overwrite").option("ignoreNullFields", False).option("compression", "gzip").json(f"{folder}/{name}.jsonl")


def read_bundle(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """Every table of a bundle, with the ordinal of its rows; one that is not there is empty. Lines that are not JSON are an error, blank lines are not."""
    out = {}
    for name, schema in schemas.BUNDLE.items():
        try:
            rows = spark.read.schema(schema).option("mode", "FAILFAST").json(f"{folder}/{name}.jsonl")
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            out[name] = spark.createDataFrame([], schema).withColumn("ordinal", F.lit(None).cast(ORDINAL))
            continue
        out[name] = rows.withColumn("ordinal", file_order())
    return out


def write_sections(sections: dict[str, DataFrame | None], folder: str, kind: str = "parquet") -> None:
    """Each section as a folder of its own."""
    for name, section in sections.items():
        if section is not None:
            section.write.mode("overwrite").format(kind).save(f"{folder}/{name}")


def report_document(sections: dict[str, DataFrame | None], most_rows: int = 200_000) -> str:
    """All sections as one JSON object, for small reports: a section of more than most_rows is refused."""
    out = {}
    for name, section in sections.items():
        rows = None if section is None else [r.asDict(recursive=True) for r in section.take(most_rows + 1)]
        if rows is not None and len(rows) > most_rows:
            raise ValueError(f"{name} has more than {most_rows} rows: write it with write_sections")
        out[name] = rows
    return json.dumps(out, default=str)


def _member(text: bytes) -> bytes:
    """A gzip member that tells its size in its header, so that a reader can step over it."""
    body = zlib.compress(text, 1, wbits=-15)
    head = b"\x1f\x8b\x08\x04\0\0\0\0\0\xff" + struct.pack("<H2sHI", 8, b"RS", 4, HEAD + len(body) + 8)
    return head + body + struct.pack("<2I", zlib.crc32(text), len(text) & 0xFFFFFFFF)


#: Bytes before a member's body, bytes of text in a member, about, and the member between two parts of a section.
HEAD, MEMBER = 20, 4 << 20
BETWEEN = _member(b",\n")


def _encoder(folder: str):
    """(body: a row's JSON) -> (part, path): a packed file for each part that has rows, with BETWEEN before them, their lines whole in its members."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, out, held, size = TaskContext.get(), None, [], 0
        path = f"{folder}/part-{task.partitionId()}-{task.taskAttemptId()}"
        try:
            for batch in batches:
                for row in batch.column("body").to_pylist():
                    if out is None:
                        store, name = files.located(path)
                        store.create_dir(name.rsplit("/", 1)[0], recursive=True)
                        out = store.open_output_stream(name, compression=None)
                        out.write(BETWEEN)
                    if size >= MEMBER:
                        out.write(_member((",\n".join(held) + ",\n").encode()))
                        held, size = [], 0
                    held.append(row)
                    size += len(row)
            if out is not None:
                out.write(_member(",\n".join(held).encode()))
        finally:
            if out is not None:
                out.close()
        if out is not None:
            yield pa.RecordBatch.from_pydict({"part": pa.array([task.partitionId()], pa.int32()), "path": [path]})

    return run


def _joined(target: str, sections: dict[str, list[str] | None], piece: int = 1 << 20):
    """Streams the sections' parts in order into one object, packed as they are or unpacked. A section's name has a line of its own, and each row has one."""
    packed = target.endswith(".gz")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, name = files.located(target)
        with store.open_output_stream(name, compression=None) as out:
            put = lambda text: out.write(_member(text) if packed else text)
            for i, (section, paths) in enumerate(sections.items()):
                put((b",\n" if i else b"{\n") + json.dumps(section).encode() + b": " + (b"null" if paths is None else b"[\n"))
                for k, path in enumerate(paths or ()):
                    own, file = files.located(path)
                    with own.open_input_stream(file, compression=None) as raw:
                        if not k:
                            raw.read(len(BETWEEN))
                        rows = raw if packed else gzip.GzipFile(fileobj=raw)
                        while data := rows.read(piece):
                            out.write(data)
                if paths is not None:
                    put(b"\n]" if paths else b"]")
            put(b"\n}" if sections else b"{}")
        for batch in batches:
            yield batch

    return run


def write_report(sections: dict[str, DataFrame | None], path: str) -> None:
    """All sections as one JSON object in the file path, in the order of their rows; packed by gzip if the path ends with .gz.

    Each section is encoded and packed in parallel, a part of its order a task; one task then streams the parts into the file, some MB at a
    time, so neither it nor the driver holds a section. A packed file's members are the parts', so it takes no packing again. A section
    that is None is null, one without rows an empty list. The file is complete or not there: it is renamed when all has been written.
    """
    spark = next((s for s in sections.values() if s is not None)).sparkSession
    folder, named = new_folder(spark, "report-parts"), {}
    for i, (name, section) in enumerate(sections.items()):
        if section is None:
            named[name] = None
            continue
        with released(spark):
            bodies = section.select(F.to_json(F.struct(*[F.col(f"`{c}`") for c in section.columns]), {"ignoreNullFields": "false"}).alias("body"))
            found = bodies.mapInArrow(_encoder(f"{folder}/{i}"), "part int, path string").collect()
        named[name] = [r["path"] for r in sorted(found, key=lambda r: r["part"])]
    end = ".gz" if path.endswith(".gz") else ""
    written = f"{path}.{folder.rsplit('-', 1)[1]}{end}"
    spark.range(0, 1, 1, 1).mapInArrow(_joined(written, named), "id long").collect()
    store, name = files.located(written)
    store.move(name, files.located(path)[1])
    if any(named.values()):
        parts, at = files.located(folder)
        parts.delete_dir(at)


def _members(path: str):
    """-> (block, size) of the members of a packed report, found by stepping from head to head."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _ in batches:
            store, name = files.located(path)
            blocks, at = [], 0
            with store.open_input_file(name) as file:
                while at < file.size():
                    file.seek(at)
                    size = struct.unpack("<I", file.read(HEAD)[-4:])[0]
                    blocks.append((at, size))
                    at += size
            yield pa.RecordBatch.from_pydict({"block": pa.array([b for b, _ in blocks], pa.int64()), "size": pa.array([n for _, n in blocks], pa.int64())})

    return run


def _lines(path: str):
    """(block, size) -> (value, ordinal): the lines of each member, but for those that only part rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, name = files.located(path)
        with store.open_input_file(name) as file:
            for batch in batches:
                for block, size in zip(*(batch.column(c).to_pylist() for c in ("block", "size")), strict=True):
                    file.seek(block)
                    lines = [line for line in gzip.decompress(file.read(size)).decode().split("\n") if line not in ("", ",")]
                    places = pa.StructArray.from_arrays([pa.array([name] * len(lines), pa.string()), pa.array([block] * len(lines), pa.int64()), pa.array(range(len(lines)), pa.int64())], ["file", "block", "row"])
                    yield pa.RecordBatch.from_arrays([pa.array(lines, pa.string()), places], names=["value", "ordinal"])

    return run


def read_report(spark: SparkSession, path: str) -> DataFrame:
    """(section, place: from 1, body: a row's JSON) of a file of write_report; a section that is null has one row with the body null.

    Such a file holds a row in each line, so tasks read blocks of it; of a packed file they read members. Only the lines that name a
    section, a few, go to all of them.
    """
    if path.endswith(".gz"):
        members = spark.range(0, 1, 1, 1).mapInArrow(_members(path), "block long, size long")
        text = members.repartition(int(spark.conf.get("spark.sql.shuffle.partitions"))).mapInArrow(_lines(path), f"value string, ordinal {ORDINAL}")
    else:
        text = spark.read.option("lineSep", "\n").text(path).withColumn("ordinal", file_order())
    lines = numbered(text, "line")
    line, null = F.col("value"), F.rtrim(F.col("value"), F.lit(",")).endswith(": null")
    name = F.from_json(F.concat(F.lit("["), F.regexp_extract("value", NAME, 1), F.lit("]")), "array<string>")[0]
    following = F.lead("line", 1, 1 << 62).over(Window.orderBy("line"))
    heads = lines.filter(line.startswith('"')).select(name.alias("section"), F.col("line").alias("first"), following.alias("next"))
    whole = lines.filter((line.startswith("{") & (line != "{")) | (line.startswith('"') & null))
    rows = whole.join(F.broadcast(heads), (F.col("line") >= F.col("first")) & (F.col("line") < F.col("next")))
    own = F.when(line.startswith('"'), "null").when(line.endswith(","), line.substr(F.lit(1), F.length(line) - 1)).otherwise(line)
    return rows.select("section", F.greatest(F.col("line") - F.col("first"), F.lit(1)).alias("place"), own.alias("body"))
