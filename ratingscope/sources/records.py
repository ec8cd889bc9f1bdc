"""CSV files with line breaks in fields, read by many tasks.

Whether a line break ends a record depends on the quotes before it, back to the start of the
file. A task that reads a piece of a file knows the lines of its piece alone, so it cuts them
into records twice: once as if a record began with the piece, once as if the piece began inside
a quoted field. Where both come to the same, the rest is cut once. A first pass sums a piece up
to two answers: how it ends if it begins between records, and if it begins inside a field. One
row for each piece, in file order, then tells how each piece really begins, and the records cut
under the other guess fall away. What a piece has of a record that crosses its edges is joined
to the rest of that record.

The rules are those of Spark's own reader: a quote opens a field only at its start; inside, two
quotes are one; a field whose closing quote is followed by anything but a separator or a line
end goes on without quotes.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

RECORD, HEAD, TAIL = 0, 1, 2
# Lines a worker hands on at a time.
LINES = 4096


def inside_after(line: str, inside: bool, sep: str) -> bool:
    """Whether the end of a line is inside a quoted field, by where its start is."""
    at = 0
    fields, first, rest = _patterns(sep)
    if inside:
        # The rest of the field, and what stands between its closing quote and the next one.
        found = first.match(line)
        if found is None:
            return rest.match(line) is None
        at = found.end()
    at = fields.match(line, at).end()
    return line.startswith('"', at) and rest.match(line, at + 1) is None


@cache
def _patterns(sep: str) -> tuple[re.Pattern, re.Pattern, re.Pattern]:
    """Whole fields with their separators; the rest of a quoted one with its separator; up to its closing quote."""
    other = f"[^{re.escape(sep)}]*+" if len(sep) == 1 else f"(?:(?!{re.escape(sep)}).)*+"
    close = '(?:[^"]++|"")*+"'
    fields = f'(?:(?:"{close}|(?!")){other}{re.escape(sep)})*+'
    return re.compile(fields, re.S), re.compile(close + other + re.escape(sep), re.S), re.compile(close, re.S)


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple, pa.Array | None]]:
    """What names a piece (all columns but the last) and lines of it, and None at its end."""
    last = None
    for batch in batches:
        *names, lines = batch.columns
        # The rows at which another piece begins.
        new = np.zeros(max(0, len(lines) - 1), bool)
        for column in names:
            new |= pc.not_equal(column.slice(1), column.slice(0, max(0, len(lines) - 1))).to_numpy(zero_copy_only=False)
        cuts = [0, *(np.flatnonzero(new) + 1).tolist(), len(lines)]
        for at, end in zip(cuts, cuts[1:]):
            if at == end:
                continue
            piece = tuple(column[at].as_py() for column in names)
            if last is not None and last != piece:
                yield last, None
            last = piece
            yield piece, lines.slice(at, end - at)
    if last is not None:
        yield last, None


def _summed_up(sep: str):
    """Task function: how each piece ends, begun between records and begun inside a field."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, states, size, crlf = [], [False, True], 0, None
        for piece, lines in _pieces(batches):
            if lines is None:
                rows.append((*piece, *states, size, crlf))
                states, size, crlf = [False, True], 0, None
                continue
            crlf = lines[0].as_py().endswith("\r") if crlf is None else crlf
            size += pc.sum(pc.binary_length(lines)).as_py() + len(lines)
            # A line without quotes leaves both as they are.
            for line in lines.filter(pc.match_substring(lines, '"')).to_pylist():
                if states[0] == states[1]:
                    states = [inside_after(line, states[0], sep)] * 2
                else:
                    states = [inside_after(line, s, sep) for s in states]
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows)], names=["path", "start", "size", "outside", "inside", "bytes", "crlf"])

    return task


class _Cutter:
    """The records of a piece under one guess of how it begins."""

    def __init__(self, inside: bool):
        self.inside, self.kind, self.open, self.first = inside, HEAD if inside else RECORD, [], 0

    def line(self, line: str, sep: str, seq: int) -> tuple[int, int, str] | None:
        """What the line ends, if it ends something, and the number of its first line."""
        if '"' in line:
            self.inside = inside_after(line, self.inside, sep)
        if not self.open:
            if not self.inside and self.kind == RECORD:
                return seq, RECORD, line.removesuffix("\r")
            self.first = seq
        self.open.append(line)
        if self.inside:
            return None
        text, kind = "\n".join(self.open), self.kind
        self.open, self.kind = [], RECORD
        return self.first, kind, text.removesuffix("\r")

    def rest(self) -> tuple[int, int, str] | None:
        """What the piece has of a record that goes on after it."""
        return (self.first, HEAD if self.kind == HEAD else TAIL, "\n".join(self.open)) if self.open else None


def _cut(sep: str, whole: bool):
    """Task function, by guess (null: the same under both): whole records, or parts of those that cross an edge."""
    names = ["path", "start", "guess", "seq", "kind", "text", "ended"]
    types = [pa.string(), pa.int64(), pa.bool_(), pa.int64(), pa.int32(), pa.string(), pa.bool_()]

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        both, seq = [_Cutter(False), _Cutter(True)], 0

        def out(piece: tuple) -> pa.RecordBatch:
            columns = [pa.repeat(pa.scalar(v, t), len(rows)) for v, t in zip(piece, types)]
            columns += [pa.array(c, type=t) for c, t in zip(zip(*rows), types[len(piece) :])]
            return pa.RecordBatch.from_arrays(columns, names=names)

        for piece, lines in _pieces(batches):
            if lines is None:
                for cutter in both:
                    found = cutter.rest()
                    if found is not None and not whole:
                        rows.append((None if len(both) == 1 else cutter is both[1], *found, False))
                both, seq = [_Cutter(False), _Cutter(True)], 0
            else:
                for line in lines.to_pylist():
                    seq += 1
                    for cutter in both:
                        found = cutter.line(line, sep, seq)
                        if found is not None and (found[1] == RECORD) == whole:
                            rows.append((None if len(both) == 1 else cutter is both[1], *found, True))
                    if len(both) == 2 and not both[0].open and not both[1].open:
                        # Both stand between records: one goes on for both.
                        both = both[:1]
                    if len(rows) >= LINES:
                        yield out(piece)
                        rows = []
            if rows and lines is None:
                yield out(piece)
                rows = []

    return task


def csv_records(spark: SparkSession, path: str | list[str], sep: str = ",") -> DataFrame:
    """``path, start, seq, record``: each record of the files as text, line breaks included.

    ``start`` and ``seq`` give the order within a file. A quoted field that is never closed runs
    to the end of its file, as in the one-task reader.
    """
    lines = spark.read.option("lineSep", "\n").text(path)
    meta = [F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("start")]
    sized = lines.select(*meta, F.col("_metadata.file_size").alias("size"), "value")
    pieces = sized.mapInArrow(_summed_up(sep), "path string, start long, size long, outside boolean, inside boolean, bytes long, crlf boolean")
    # One row for each piece. A piece that ends alike either way settles the state; between those,
    # pieces that turn it around are counted.
    in_file = Window.partitionBy("path").orderBy("start")
    up_to, before = in_file.rowsBetween(Window.unboundedPreceding, 0), in_file.rowsBetween(Window.unboundedPreceding, -1)
    turned = F.sum(F.when(F.col("outside") & ~F.col("inside"), 1).otherwise(0)).over(up_to)
    pieces = pieces.withColumn("turns", turned)
    settled = F.when(F.col("outside") == F.col("inside"), F.struct(F.col("outside").alias("state"), "turns"))
    last = F.last(settled, ignorenulls=True).over(before)
    turns = F.coalesce(F.last("turns").over(before), F.lit(0)) - F.coalesce(last["turns"], F.lit(0))
    begins = (F.coalesce(last["state"], F.lit(False)).cast("int") + turns) % 2 == 1
    file = Window.partitionBy("path")
    crlf = F.coalesce(F.max(F.when(F.col("start") == 0, F.col("crlf"))).over(file), F.lit(False))
    whole = F.sum("bytes").over(file) == F.col("size")
    # One number, so that both joins below read one broadcast, with one row for each piece.
    says = begins.cast("int") + 2 * F.coalesce(whole, F.lit(False)).cast("int") + 4 * crlf.cast("int")
    known = F.broadcast(pieces.select(F.col("path").alias("_path"), F.col("start").alias("_start"), says.alias("says")))

    def true(whole: bool) -> DataFrame:
        """What was cut under the guess that holds."""
        cut = lines.select(*meta, "value").mapInArrow(_cut(sep, whole), "path string, start long, guess boolean, seq long, kind int, text string, ended boolean")
        rows = cut.join(known, (F.col("path") == F.col("_path")) & (F.col("start") == F.col("_start")))
        rows = rows.where(F.col("guess").isNull() | (F.col("guess") == (F.getbit("says", F.lit(0)) == 1)))
        return rows.withColumns({n: F.getbit("says", F.lit(i)) == 1 for i, n in ((1, "whole"), (2, "crlf"))})

    records = true(whole=True).select("path", "start", "seq", F.col("text").alias("record"), "crlf")
    # Few rows: what records that cross an edge have on each side of it.
    parts = true(whole=False)
    number = F.sum(F.when(F.col("kind") == TAIL, 1).otherwise(0)).over(in_file.orderBy("start", "seq").rowsBetween(Window.unboundedPreceding, 0))
    joined = parts.withColumn("number", number).groupBy("path", "number").agg(
        F.sort_array(F.collect_list(F.struct("start", "seq", "text"))).alias("p"), F.max("ended").alias("ended"), F.first("whole").alias("whole"), F.first("crlf").alias("crlf")
    )
    text = F.array_join(F.transform("p", lambda x: x["text"]), "\n")
    # A field that is never closed holds the last line break of its file as well.
    text = F.when(~F.col("ended") & F.col("whole"), F.concat(text, F.lit("\n"))).otherwise(text)
    crossing = joined.select("path", F.col("p")[0]["start"].alias("start"), F.col("p")[0]["seq"].alias("seq"), text.alias("record"), "crlf")
    # Where lines end in two characters, one stands for them, in fields too.
    plain = F.when(F.col("crlf"), F.replace("record", F.lit("\r\n"), F.lit("\n"))).otherwise(F.col("record"))
    return records.unionByName(crossing).select("path", "start", "seq", plain.alias("record"))


def read_records(spark: SparkSession, path: str | list[str], columns: Sequence[str], sep: str = ",") -> DataFrame:
    """The fields of :func:`csv_records` as strings, headers left out.

    A file whose header differs from ``columns`` is an error.
    """
    rows = csv_records(spark, path, sep)
    # A byte order mark is no part of the first name.
    text = F.when((F.col("start") == 0) & (F.col("seq") == 1), F.regexp_replace("record", "^\\x{FEFF}", "")).otherwise(F.col("record"))
    schema = ", ".join(f"`{c.replace('`', '``')}` STRING" for c in columns)
    options = {"sep": sep, "quote": '"', "escape": '"', "mode": "PERMISSIVE", "multiLine": "true", "maxCharsPerColumn": "-1"}
    fields = F.from_csv(text, F.lit(schema), options)
    first = (F.col("start") == 0) & (F.col("seq") == 1)
    header = F.to_json(F.struct(*[F.trim(F.coalesce(fields[c], F.lit(""))).alias(f"c{i}") for i, c in enumerate(columns)]))
    expected = F.to_json(F.struct(*[F.lit(c).alias(f"c{i}") for i, c in enumerate(columns)]))
    wrong = F.raise_error(F.concat(F.lit("the header of "), F.col("path"), F.lit(" differs: "), F.col("record")))
    row = F.when(first & (header != expected), wrong.cast("boolean")).otherwise(~first)
    return rows.where(F.col("record") != "").where(row).select(fields.alias("f")).select("f.*")
