"""CSV files whose columns differ, read in byte ranges.

Spark's text reader splits big files and packs small ones; a task sees the lines of its ranges and
holds one batch of them. Quoted cells may hold line breaks, so a line's meaning
depends on whether a quoted cell is open where it starts. Each range is read under both
assumptions at once (what a line does to an open or a closed cell does not depend on the lines before
it); what a range does as a whole is one of four functions, and these are composed along each
file, one row a range. The lines that are records by themselves, nearly all, are then parsed where
they are; only those that share a record are brought together.

Headers stay with the lines of a file's first range and are joined to those of later ranges. The lines are
stored once in the shared folder, so a file is read once whatever is asked of it afterwards.
"""

from __future__ import annotations

import csv
import io
import re
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from annolake.functions.columns import NULL_WORDS, nullify
from annolake.operators.scan import running_agg
from annolake.session import cut_lineage

_PIECES = re.compile(r"[^\r\n]*\r(?!\n)|[^\r]+\Z|[^\r]*\r\n")


def opens(line: str, inside: bool) -> bool:
    """Whether a quoted cell is open after ``line``, by the rules of ``csv.reader``: a quote opens a cell
    only at its start, a doubled quote stays inside, and after a closing quote the cell goes on to the next comma."""
    at = 0
    while True:
        if inside:
            at = line.find('"', at)
            while at >= 0 and line[at + 1:at + 2] == '"':
                at = line.find('"', at + 2)
            if at < 0:
                return True
            at = line.find(",", at + 1) + 1
            if not at:
                return False
            inside = False
        elif line[at:at + 1] == '"':
            inside, at = True, at + 1
        else:
            at = line.find(',"', at) + 2
            if at == 1:
                return False
            inside = True


def cells(record: str) -> list[str]:
    """The cells of one record, its line end included."""
    record = record[:-2] if record.endswith("\r\n") else record[:-1] if record.endswith(("\n", "\r")) else record
    return next(csv.reader(io.StringIO(record, newline="")), [])


LINES = "path string, block bigint, n bigint, line string, head array<string>, of_head boolean, b0 boolean, b1 boolean, a0 boolean, a1 boolean"


def stored_lines(spark: SparkSession, root: str, glob: str, keep: Column | None = None) -> DataFrame:
    """The lines of the files ``glob`` under ``root``, stored once: path, range, number, text with its line end, header (in the first
    range), and whether a quoted cell is open before and after, had the range begun outside (0) or inside (1) one."""
    src = (spark.read.option("lineSep", "\n").option("pathGlobFilter", glob).option("recursiveFileLookup", "true").text(root)
           .select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("block"), "value"))
    if keep is not None:
        src = src.where(keep)

    def run(batches):
        import pyarrow as pa

        csv.field_size_limit(1 << 30)
        at, n, state, head, begun = None, 0, [False, True], None, ""
        for batch in batches:
            out = []
            for path, block, value in zip(*(c.to_pylist() for c in batch.columns)):
                if at != (path, block):
                    at, n, state, head, begun = (path, block), 0, [False, True], None, ""
                    if block == 0:
                        value = value.removeprefix("﻿")
                full = value + "\n"
                for line in _PIECES.findall(full) if "\r" in value else (full,):
                    before = state
                    if '"' in line:
                        state = [opens(line, s) for s in before] if before[0] != before[1] else [opens(line, before[0])] * 2
                    of_head = block == 0 and head is None
                    if of_head:
                        begun += line
                        if not state[0]:
                            head = [h.strip() for h in cells(begun)]
                    out.append((path, block, n, line, head, of_head, *before, *state))
                    n += 1
            cols = list(zip(*out)) if out else [[]] * 10
            kinds = [pa.string(), pa.int64(), pa.int64(), pa.string(), pa.list_(pa.string())] + [pa.bool_()] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)],
                                             names=["path", "block", "n", "line", "head", "of_head", "b0", "b1", "a0", "a1"])

    return cut_lineage(src.mapInArrow(run, LINES), "csv_lines")


def range_states(lines: DataFrame) -> DataFrame:
    """(path, block, carry) of the later ranges: whether a quoted cell is open where each begins."""
    last = lines.groupBy("path", "block").agg(F.max_by(F.struct("a0", "a1"), "n").alias("a")).select("path", "block", "a.*")
    w = Window.partitionBy("path").orderBy("block")
    before = w.rowsBetween(Window.unboundedPreceding, -1)
    flip = (F.col("a0") & ~F.col("a1")).cast("int")
    d = last.withColumn("flips", F.sum(flip).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    known = F.when(F.col("a0") == F.col("a1"), F.struct(F.col("a0").alias("v"), F.col("flips").alias("f")))
    d = d.withColumn("known", F.last(known, ignorenulls=True).over(before)).withColumn("so_far", F.max("flips").over(before))
    odd = (F.coalesce("so_far", F.lit(0)) - F.coalesce("known.f", F.lit(0))) % 2 == 1
    return d.where("block > 0").select("path", "block", (F.coalesce("known.v", F.lit(False)) != odd).alias("carry"))


def csv_records(lines: DataFrame, null_words: Iterable[str] = NULL_WORDS) -> DataFrame:
    """``stored_lines`` -> (path, row MAP<STRING,STRING>), one for each CSV record after the header.

    Cells that are null words and cells that a short row lacks are null; blank lines are no
    rows; of two columns of one name the last counts. A record has to end for its row to begin a new
    one: a quote that is never closed takes the rest of its file, as in any CSV reader.
    """
    body = ["path", "block", "n", "line", "head"]
    first = lines.where("block = 0 and not of_head").select(*body, F.col("b0").alias("inside"), F.col("a0").alias("after"))
    later = lines.where("block > 0").join(range_states(lines), ["path", "block"]).select(
        *body, F.expr("if(carry, b1, b0)").alias("inside"), F.expr("if(carry, a1, a0)").alias("after"))
    every = first.unionByName(later)
    alone = every.where("not inside and not after").select("path", "head", "line")
    parts = every.where("inside or after").withColumn("start", (~F.col("inside")).cast("long"))
    parts = running_agg(parts, ["path"], ["block", "n"], "start", "record", "sum", chunk_of=F.col("block"))
    joined = parts.groupBy("path", "record").agg(
        F.array_sort(F.collect_list(F.struct("block", "n", "line"))).alias("l"), F.min_by("head", F.struct("block", "n")).alias("head")).select(
        "path", "head", F.array_join(F.transform("l", lambda x: x["line"]), "").alias("line"))
    found = alone.unionByName(joined)
    heads = lines.where("of_head and head is not null").select("path", F.col("head").alias("known"))
    rows = found.where("head is not null").unionByName(
        found.where("head is null").drop("head").join(heads, "path").select("path", F.col("known").alias("head"), "line"))

    def parse(batches):
        import pyarrow as pa

        csv.field_size_limit(1 << 30)
        for batch in batches:
            out = []
            for path, head, line in zip(*(c.to_pylist() for c in batch.columns)):
                r = cells(line)
                if r:
                    out.append((path, list(dict(zip(head, [*r, *[None] * (len(head) - len(r))])).items())))
            yield pa.RecordBatch.from_arrays([pa.array([p for p, _ in out], pa.string()), pa.array([m for _, m in out], pa.map_(pa.string(), pa.string()))],
                                             names=["path", "row"])

    out = rows.mapInArrow(parse, "path string, row map<string,string>")
    return out.select("path", F.transform_values("row", lambda k, v: nullify(v, null_words)).alias("row"))


def header_names(lines: DataFrame) -> list[str]:
    """The distinct column names of all files, sorted."""
    return sorted(r[0] for r in lines.where("of_head and head is not null").select(F.explode("head").alias("k")).distinct().collect())
