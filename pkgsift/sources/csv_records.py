"""Record-aligned parallel CSV (A1, A4): many tasks read one quoted file.

Line ends inside quotes are data, so a byte range of a CSV file does not tell
where its records start.  Each range is read twice.  First, every line maps
"outside quotes" and "inside quotes" to the state after it, and a range's lines
compose to one such map; folding the maps of a file's ranges gives the state
that each range starts in.  Then every range splits its lines into records: whole ones are
parsed where they are, and only the broken pieces at its two ends, if any, meet
those of its neighbours in a small shuffle.

A quote opens a quoted field only at the field's start, and two quotes inside stand
for one, as RFC 4180 and pandas have it.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pkgsift.session import bound_arrow_batches, ship_package

#: A null is no text of its own: an empty field is null, a quoted empty one is empty.
CSV_OPTIONS = {"quote": '"', "escape": '"', "emptyValue": "", "nullValue": "\ufdd0", "mode": "PERMISSIVE", "multiLine": "true"}

# A line from outside quotes ends inside them if, after whole fields, a quote opens that nothing closes.
_FIELDS = r'(?:(?:"(?:[^"]|"")*+"[^,]*+|[^",][^,]*+|),)*+'
_OPENS = re.compile(_FIELDS + r'"(?:[^"]|"")*+\Z')
_STAYS = re.compile(r'(?:[^"]|"")*+\Z')
_CLOSES = re.compile(r'(?:[^"]|"")*+"[^,]*+(?:,|\Z)')


def ends_inside(line: str, inside: bool) -> bool:
    """The state after a line that starts inside or outside quotes."""
    if '"' not in line:
        return inside
    if not inside:
        return _OPENS.match(line) is not None
    if _STAYS.match(line):
        return True
    rest = _CLOSES.match(line)
    return rest.end() < len(line) and line[rest.end() - 1] == "," and _OPENS.match(line, rest.end()) is not None


def _lines(spark: SparkSession, path: str) -> DataFrame:
    return (spark.read.option("lineSep", "\n").text(path)
            .select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block")))


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, int, str]]:
    for b in batches:
        yield from zip(b.column(1).to_pylist(), b.column(2).to_pylist(), b.column(0).to_pylist())


def range_maps(lines: DataFrame) -> DataFrame:
    """(file, block, outside, inside): per byte range, the state after it for both states before it."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, state = None, [False, True]
        for file, block, line in _runs(batches):
            if (file, block) != now:
                if now is not None:
                    yield row(now, state)
                now, state = (file, block), [False, True]
            if '"' in line:
                state = [ends_inside(line, s) for s in state]
        if now is not None:
            yield row(now, state)

    def row(now: tuple[str, int], state: list[bool]) -> pa.RecordBatch:
        return pa.RecordBatch.from_pydict({"file": [now[0]], "block": [now[1]], "outside": [state[0]], "inside": [state[1]]})

    return lines.mapInArrow(run, "file string, block long, outside boolean, inside boolean")


def open_ranges(maps: DataFrame) -> DataFrame:
    """(file, block) of the ranges that start inside quotes: a file's maps, one row per range, folded in order."""
    ordered = F.sort_array(F.collect_list(F.struct("block", "outside", "inside")))
    # the fold keeps the state and the ranges found open so far, which are few
    fold = F.aggregate("r", F.struct(F.lit(False).alias("s"), F.array().cast("array<bigint>").alias("o")),
                       lambda a, x: F.struct(F.when(a["s"], x["inside"]).otherwise(x["outside"]).alias("s"),
                                             F.when(a["s"], F.concat(a["o"], F.array(x["block"]))).otherwise(a["o"]).alias("o")))
    return maps.groupBy("file").agg(ordered.alias("r")).select("file", F.explode(fold["o"]).alias("block"))


def records(spark: SparkSession, path: str) -> DataFrame:
    """(file, block, seq, record): every record's text, header records included, blank ones not."""
    ship_package(spark)
    bound_arrow_batches(spark)
    lines = _lines(spark, path)
    starts = {(r["file"], r["block"]) for r in open_ranges(range_maps(lines)).toLocalIterator()}  # at most one entry per byte range
    held = spark.sparkContext.broadcast(starts)
    schema = pa.schema([("file", pa.string()), ("block", pa.int64()), ("seq", pa.int64()), ("kind", pa.string()), ("record", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_, rows, size = held.value, [], 0
        now, inside, kind, part, seq = None, False, "whole", [], 0

        def close(last: bool) -> None:
            """A record, or the piece of one, ends: with its line, or with the range."""
            nonlocal seq, part, kind, size
            # head: ends here, began before; tail: begins here, ends later; middle: neither
            what = kind if not last or not inside else {"whole": "tail", "head": "middle"}[kind]
            text = "\n".join(part)
            if part and (what != "whole" or text not in ("", "\r")):
                rows.append((*now, seq, what, text))
                size += len(text) + 64
            seq, part, kind = seq + 1, [], "whole"

        for file, block, line in _runs(batches):
            if (file, block) != now:
                if part:
                    close(True)
                now, seq, part = (file, block), 0, []
                inside = now in open_
                kind = "head" if inside else "whole"
            part.append(line)
            inside = ends_inside(line, inside)
            if not inside:
                close(False)
            if size > 8 << 20:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)
                rows, size = [], 0
        if part:
            close(True)
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    from pkgsift.operators.split import _stored
    found = _stored(lines.mapInArrow(run, "file string, block long, seq long, kind string, record string"), "csv-records")
    pieces = found.where("kind <> 'whole'")
    # a tail starts a record; the pieces of later ranges belong to it up to the next tail
    # two rows per range at most; the last piece of a record that never ends stays with it
    order = Window.partitionBy("file").orderBy("block", "seq").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    owner = F.last(F.when(F.col("kind") == "tail", F.struct("block", "seq")), ignorenulls=True).over(order)
    joined = (pieces.withColumn("own", owner).groupBy("file", "own")
              .agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("block", "seq", "record"))), lambda x: x["record"]), "\n").alias("record"))
              .select("file", F.col("own.block").alias("block"), F.col("own.seq").alias("seq"), "record"))
    return found.where("kind = 'whole'").select("file", "block", "seq", "record").unionByName(joined)


def read_csv_parallel(spark: SparkSession, path: str) -> DataFrame:
    """The rows of CSV files with a header, as strings, in any number of tasks per file.

    Column names come from the first file's header; every file's first record is
    left out.  Empty fields and records of too few or too many fields are read as
    the single-task reader reads them."""
    reader = spark.read.options(**CSV_OPTIONS).option("header", True).option("inferSchema", False)
    schema = reader.csv(path).schema
    all_records = records(spark, path)
    first = all_records.groupBy(F.col("file").alias("_f")).agg(F.min(F.struct("block", "seq")).alias("_m"))
    body = (all_records.join(first, F.col("file") == F.col("_f"))
            .where((F.col("block") != F.col("_m.block")) | (F.col("seq") != F.col("_m.seq"))))
    text = F.regexp_replace("record", "\r$", "")
    parsed = F.from_csv(text, _ddl(schema), CSV_OPTIONS)
    return body.select(parsed.alias("_r")).select("_r.*")


def _ddl(schema) -> str:
    return ", ".join(f"`{f.name.replace('`', '``')}` string" for f in schema.fields)
