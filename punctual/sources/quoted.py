"""Records of quoted text files whose fields hold line breaks, read in as many parts as the files have.

A line break ends a record if an even number of quotes stands before it in its file. Every part of a file counts its quotes; a
prefix sum of the parities, one row per part, tells whether a part begins inside a field. Then every part joins its own lines
into records. Only a record that goes on in the next part leaves its part: in fragments, at most two for each part.

Quotes must stand where the format wants them: around a field, and doubled inside one (``escape`` is the quote itself). Files are
UTF-8; a record ends in ``\\n`` or ``\\r\\n``. Breaks inside a field stay as they are, but for a record which ends in ``\\r\\n``, where they become
``\\n``, as they do in Spark's reader. A file that ends inside a field gives its last record as it is.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

QUOTE = '"'
_TAIL, _HEAD = 0, 1
_SCHEMA = "file string, part long, kind int, first boolean, record string"


def _lines(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("part"), "value")


def odd_parts(lines: DataFrame) -> DataFrame:
    """``file``, ``part`` of the parts that begin inside a field."""
    quotes = F.length("value") - F.length(F.replace("value", F.lit(QUOTE), F.lit("")))
    parity = lines.groupBy("file", "part").agg((F.sum(quotes) % 2).alias("odd"))
    before = F.sum("odd").over(Window.partitionBy("file").orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    return parity.withColumn("before", before).filter("before % 2 = 1").select("file", "part")


class _Part:
    """The lines of one part, as they come."""

    def __init__(self, file: str, part: int, inside: bool) -> None:
        self.file, self.part, self.inside, self.tail = file, part, int(inside), inside
        self.open: list[str] = []
        self.begun = self.open_first = False  # whether a line that isn't empty was seen; whether the open record is the file's first

    def batch(self, kinds: list, firsts: list, records) -> pa.RecordBatch:
        n = len(records)
        return pa.RecordBatch.from_arrays(
            [pa.array([self.file] * n, pa.string()), pa.array([self.part] * n, pa.int64()), pa.array(kinds, pa.int32()),
             pa.array(firsts, pa.bool_()), records if isinstance(records, pa.Array) else pa.array(records, pa.string())],
            names=["file", "part", "kind", "first", "record"])

    def add(self, value: pa.Array) -> Iterator[pa.RecordBatch]:
        opening = -1  # the place of the file's first line that isn't empty
        if self.part == 0 and not self.begun:
            opening = next((i for i, line in enumerate(value) if line.as_py() not in ("", "\r")), -1)
            self.begun = opening >= 0
        after = (self.inside + np.cumsum(pc.count_substring(value, QUOTE).to_numpy(zero_copy_only=False))) & 1
        before = np.r_[self.inside, after[:-1]]
        self.inside = int(after[-1])
        whole = (before == 0) & (after == 0)
        places = np.flatnonzero(whole)
        kinds, firsts, joined, ends = [None] * len(places), (places == opening).tolist(), [], []
        others = np.flatnonzero(~whole)
        for i, line in zip(others.tolist(), value.take(pa.array(others)).to_pylist()):
            if not self.open:
                self.open_first = i == opening
            self.open.append(line)
            if not after[i]:
                kinds.append(_TAIL if self.tail else None)
                firsts.append(self.open_first)
                joined.append("\n".join(self.open))
                ends.append(i)
                self.open, self.tail = [], False
        if kinds:  # in the order in which the records end
            found = self.batch(kinds, firsts, pa.concat_arrays([value.take(pa.array(places)), pa.array(joined, value.type)]).cast(pa.string()))
            yield found.take(pa.array(np.argsort(np.r_[places, np.array(ends, np.int64)]))) if ends else found

    def end(self) -> Iterator[pa.RecordBatch]:
        if self.open:
            yield self.batch([_TAIL if self.tail else _HEAD], [self.open_first], ["\n".join(self.open)])


def _joined(odd: frozenset[tuple[str, int]]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now: _Part | None = None
        for batch in batches:
            if not batch.num_rows:
                continue
            file, part, value = batch.columns
            parts = part.to_numpy(zero_copy_only=False)
            # A change of file without a change of place: small files one after the other.
            same = pc.equal(file.slice(1), file.slice(0, len(file) - 1)).to_numpy(zero_copy_only=False).astype(bool) & (parts[1:] == parts[:-1])
            cuts = [0, *(np.flatnonzero(~same) + 1).tolist(), len(parts)]
            for a, b in zip(cuts, cuts[1:]):
                key = (file[a].as_py(), int(parts[a]))
                if now is None or key != (now.file, now.part):
                    if now is not None:
                        yield from now.end()
                    now = _Part(*key, key in odd)
                yield from now.add(value.slice(a, b - a))
        if now is not None:
            yield from now.end()

    return run


def records(spark: SparkSession, path: str) -> DataFrame:
    """``file``, ``first`` (of its file), ``record``; empty lines between records are left out.

    The places of the parts that begin inside a field come to the driver: less than a row for each task.
    """
    lines = _lines(spark, path)
    odd = frozenset((r["file"], r["part"]) for r in odd_parts(lines).collect())
    found = lines.mapInArrow(_joined(odd), _SCHEMA)
    pieces = found.filter("kind is not null")
    whole = found.filter("kind is null").select("file", "first", "record")
    if odd:
        # A head begins a record, the tails behind it up to the next head go on with it.
        number = F.sum("kind").over(Window.partitionBy("file").orderBy("part", "kind"))
        told = pieces.withColumn("number", number).groupBy("file", "number").agg(
            F.max("first").alias("first"), F.sort_array(F.collect_list(F.struct("part", "kind", "record"))).alias("pieces"))
        whole = whole.unionByName(told.select("file", "first", F.array_join(F.col("pieces.record"), "\n").alias("record")))
    else:
        whole = found.select("file", "first", "record")  # a file may end inside a field
    ended = F.when(F.endswith("record", F.lit("\r")), F.replace(F.expr("left(record, length(record) - 1)"), F.lit("\r\n"), F.lit("\n"))).otherwise(F.col("record"))
    return whole.withColumn("record", ended).filter("record <> ''")


def _named(record: Column, schema: T.StructType, options: dict[str, str]) -> Column:
    """True if the fields of a header are the schema's names."""
    names = T.StructType([T.StructField(f"c{i}", T.StringType()) for i in range(len(schema.fields))])
    header = F.from_csv(record, names.toDDL(), options)
    told = F.array(*[F.lower(F.coalesce(header[f.name], F.lit(""))) for f in names.fields])
    return told == F.array(*[F.lit(f.name.lower()) for f in schema.fields])


def read_quoted(spark: SparkSession, path: str, schema: T.StructType, sep: str = ",", mode: str = "PERMISSIVE") -> DataFrame:
    """Quoted text files with a header; a header that doesn't name the schema's columns raises an error."""
    options = {"sep": sep, "quote": QUOTE, "escape": QUOTE, "mode": mode, "multiLine": "true"}
    found = records(spark, path)
    wrong = F.raise_error(F.concat(F.lit("the header does not name the columns of the schema: "), "record")).cast("boolean")
    rows = found.filter(F.when(F.col("first"), F.when(_named(F.col("record"), schema, options), F.lit(False)).otherwise(wrong)).otherwise(F.lit(True)))
    fields = T.StructType([T.StructField(f.name, f.dataType, True) for f in schema.fields])
    return rows.select(F.from_csv("record", fields.toDDL(), options).alias("row")).select("row.*")
