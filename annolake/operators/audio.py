"""Cutting recordings to their clips (I8, I9 on WAV files).

Recordings come as (key, content) rows, e.g. from the ``binaryFile`` reader, so any store that Spark reads
will do; a recording has to fit a row (2 GB). The RIFF chunks are walked and the
pieces put together in column expressions; a recording's clips travel to its one row as an array, and the
pieces of disjoint clips are together no longer than the recording.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from annolake.functions.columns import clip_name

CHUNKS = (8, 4096)     # chunks looked at first, and, where the samples are not among them, further ones; a file with more is no WAV file


def _swap(h: Column, size: int) -> Column:
    return F.concat(*[F.substring(h, 2 * k + 1, 2) for k in reversed(range(size))])


def little_endian(content: Column, at: Column | int, size: int) -> Column:
    """The unsigned number of ``size`` bytes at byte ``at`` (from 0)."""
    start = (F.lit(at) if isinstance(at, int) else at) + 1
    return F.conv(_swap(F.hex(F.substring(content, start.cast("int"), F.lit(size))), size), 16, 10).cast("long")


def to_little_endian(n: Column, size: int) -> Column:
    return F.unhex(_swap(F.lpad(F.hex(n.cast("long")), 2 * size, "0"), size))


def _text(content: Column, at: Column | int) -> Column:
    start = (F.lit(at) if isinstance(at, int) else at) + 1
    return F.hex(F.substring(content, start.cast("int"), F.lit(4)))


def _id(name: str) -> Column:
    return F.lit(name.encode().hex().upper())


def wav_layout(content: Column) -> Column:
    """struct(fmt_at, fmt_len, data_at, data_len, rate, frame): where format and samples lie, samples a second and bytes a
    frame; null where ``content`` is no WAV file. Sample chunks that claim more than the file has (an
    interrupted or streamed recording) end with the file's last whole frame."""
    size = F.length(content).cast("long")
    none = F.lit(None).cast("long")
    begin = F.struct(F.lit(12).cast("long").alias("at"), none.alias("fmt_at"), none.alias("fmt_len"), none.alias("data_at"), none.alias("data_len"))

    def step(s, _):
        more = s["data_at"].isNull() & (s["at"] + 8 <= size)
        kind, n = _text(content, s["at"]), little_endian(content, s["at"] + 4, 4)
        fmt, data = more & (kind == _id("fmt ")) & s["fmt_at"].isNull(), more & (kind == _id("data"))
        return F.struct(F.when(more & ~data, s["at"] + 8 + n + n % 2).otherwise(s["at"]).alias("at"),
                        F.when(fmt, s["at"] + 8).otherwise(s["fmt_at"]).alias("fmt_at"), F.when(fmt, n).otherwise(s["fmt_len"]).alias("fmt_len"),
                        F.when(data, s["at"] + 8).otherwise(s["data_at"]).alias("data_at"),
                        F.when(data, F.least(n, size - s["at"] - 8)).otherwise(s["data_len"]).alias("data_len"))

    def walk(state, n):
        return F.aggregate(F.sequence(F.lit(1), F.lit(n)), state, step)

    walked = F.get(F.transform(F.array(walk(begin, CHUNKS[0])), lambda w: F.when(
        w["data_at"].isNotNull() | (w["at"] + 8 > size), w).otherwise(walk(w, CHUNKS[1]))), 0)
    fine = (size >= 44) & (_text(content, 0) == _id("RIFF")) & (_text(content, 8) == _id("WAVE"))
    found = F.transform(F.array(walked), lambda w: F.when(
        w["fmt_at"].isNotNull() & w["data_at"].isNotNull() & (w["fmt_len"] >= 16),
        F.struct(w["fmt_at"].alias("fmt_at"), w["fmt_len"].alias("fmt_len"), w["data_at"].alias("data_at"), w["data_len"].alias("data_len"),
                 little_endian(content, w["fmt_at"] + 4, 4).alias("rate"), little_endian(content, w["fmt_at"] + 12, 2).alias("frame"))))
    found = F.transform(found, lambda w: F.when(w["frame"] > 0, w.withField("data_len", w["data_len"] - w["data_len"] % w["frame"])))
    return F.when(fine, F.get(found, 0))


def cut_wav(files: DataFrame, clips: DataFrame, key: str = "recording_filename", content: str = "content",
            existing: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(pieces, bad): ``pieces`` are (key, clip_start, clip_end, output, content), a WAV file for each clip, from the sample frame
    at its start to before the one at its end, under its clip name (P6); ``bad`` are keys of files that are no WAV.

    Clips (key, start, end in ms) reach at most to the end of the samples; a clip beyond them gives a file without samples. Clips
    whose name is among ``existing`` (first column) are not cut again; clips without a file give nothing. A repeated clip is cut once.
    """
    asked = clips.select(F.col(key), F.col("start").cast("long").alias("s"), F.col("end").cast("long").alias("e")).distinct()
    asked = asked.withColumn("output", clip_name(F.col(key).cast("string"), "s", "e"))
    if existing is not None:
        asked = asked.join(existing.select(F.col(existing.columns[0]).alias("output")), "output", "left_anti")
    lists = asked.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("s", "e", "output"))).alias("_clips"))
    f = files.select(F.col(key), F.col(content).alias("_content")).join(lists, key)
    whole = F.col("_content")

    def piece(at, c):
        first, last = (F.least(F.greatest(F.floor(c[x] * at["rate"] / 1000), F.lit(0)) * at["frame"], at["data_len"]) for x in ("s", "e"))
        n = F.greatest(last - first, F.lit(0).cast("long"))
        samples = F.substring(whole, (at["data_at"] + first + 1).cast("int"), n.cast("int"))
        fmt = F.substring(whole, (at["fmt_at"] + 1).cast("int"), at["fmt_len"].cast("int"))
        odd = lambda k: F.when(k % 2 == 1, F.unhex(F.lit("00"))).otherwise(F.unhex(F.lit("")))
        size = 4 + 8 + at["fmt_len"] + at["fmt_len"] % 2 + 8 + n + n % 2
        word = lambda t: F.unhex(_id(t))
        return F.struct(c["s"].alias("clip_start"), c["e"].alias("clip_end"), c["output"].alias("output"), F.concat(
            word("RIFF"), to_little_endian(size, 4), word("WAVE"), word("fmt "), to_little_endian(at["fmt_len"], 4), fmt, odd(at["fmt_len"]),
            word("data"), to_little_endian(n, 4), samples, odd(n)).alias("content"))

    # the layout is bound as a lambda's variable: as a column it would be worked out again at each use
    cut = F.get(F.transform(F.array(wav_layout(whole)), lambda at: F.when(at.isNotNull(), F.transform("_clips", lambda c: piece(at, c)))), 0)
    return f.select(key, F.explode(cut).alias("p")).select(key, "p.*"), f.where(wav_layout(whole).isNull()).select(key)


def read_recordings(spark, root: str, glob: str = "*.wav", key: str = "recording_filename") -> DataFrame:
    """(key, content) of the recordings under ``root``, the key being the path below it."""
    below = root.rstrip("/").split("://")[-1].lstrip("/") + "/"
    files = spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", "true").load(root)
    return files.select(F.substring_index("path", below, -1).alias(key), "content")


def write_pieces(pieces: DataFrame, root: str) -> DataFrame:
    """Write each piece as the file ``<root>/<output>`` and return (output, n_bytes). The tasks write through pyarrow's file
    systems (local and shared folders, HDFS, object stores); a piece appears under its name when it is complete, so a repeated
    task only writes the same file again."""
    def run(batches):
        import uuid

        import pyarrow as pa
        from pyarrow import fs

        store, base = fs.FileSystem.from_uri(root if "://" in root else f"file://{root}")
        for batch in batches:
            names, contents = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for name, data in zip(names, contents):
                path = f"{base.rstrip('/')}/{name}"
                store.create_dir(path.rsplit("/", 1)[0], recursive=True)
                new = f"{path}.{uuid.uuid4().hex}.part"
                with store.open_output_stream(new) as out:
                    out.write(data)
                store.move(new, path)
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array([len(c) for c in contents], pa.int64())], names=["output", "n_bytes"])

    return pieces.select("output", "content").mapInArrow(run, "output string, n_bytes bigint")
