"""CSV files read in byte ranges, against ``csv.reader`` over the whole file."""

import csv
import io
import random

import pytest
from pyspark.sql import functions as F

from annolake.sources.csv_records import csv_records, opens, range_states, stored_lines
from annolake.sources.index import scan_index


def whole(text):
    csv.field_size_limit(1 << 30)
    lines = csv.reader(io.StringIO(text.removeprefix("﻿"), newline=""))
    head = [h.strip() for h in next(lines, [])]
    null = lambda v: None if v is None or v.strip(" ") in ("", "NA") else v
    return [{k: null(v) for k, v in zip(head, [*r, *[None] * (len(head) - len(r))])} for r in lines if r]


def records(rng, end, n):
    out = ["a,b,c"]
    for _ in range(n):
        row = []
        for _ in range(rng.choice([1, 2, 3, 3, 3, 4])):
            raw = "".join(rng.choice(['x', 'y', '"', ',', '\n', '\r\n', ' ', 'é', '12']) for _ in range(rng.randint(0, 7)))
            if rng.random() < 0.5:
                row.append('"' + raw.replace('"', '""') + '"' + rng.choice(["", "", "t", 't"u']))
            else:
                row.append(rng.choice(["", "x"]) + raw.replace(",", "").replace("\n", "").replace("\r", "").lstrip('"'))
        out.append(",".join(row))
        if rng.random() < 0.1:
            out.append("")
    return end.join(out) + rng.choice(["", end])


@pytest.mark.parametrize("size", ["48b", "300b", "128m"])
def test_ranges_give_the_rows_of_the_whole_file(spark, tmp_path, size):
    rng = random.Random(size)
    texts = {}
    for k in range(14):
        end = ["\n", "\r\n", "\r"][k % 3]
        texts[f"f{k}.csv"] = ["", "﻿"][k % 2] + records(rng, end, [0, 3, 12, 30][k % 4])
    texts["quoted_head.csv"] = '"a\nb",c\r\n1,2\r\n'
    texts["empty.csv"], texts["open.csv"] = "", 'a,b\n1,2\n3,"never closed\n5,6\n7,8'
    for name, t in texts.items():
        (tmp_path / name).write_bytes(t.encode())
    keys = {"spark.sql.files.maxPartitionBytes": size, "spark.sql.files.openCostInBytes": "0", "spark.sql.files.minPartitionNum": "1"}
    old = {k: spark.conf.get(k, None) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    try:
        lines = stored_lines(spark, str(tmp_path), "*.csv")
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    got = {name: [] for name in texts}
    for r in csv_records(lines).collect():
        got[r.path.rsplit("/", 1)[1]].append(r.row)
    ranges = lines.select("path", "block").distinct().count()
    order = lambda rows: sorted(map(str, rows))
    for name, t in texts.items():
        want = whole(t)
        assert order(got[name]) == order(want), name
    assert ranges > 60 if size == "48b" else ranges > 0


def test_opens_follows_the_reader():
    rng = random.Random(2)
    for _ in range(4000):
        line = "".join(rng.choice('ab",,""') for _ in range(rng.randint(0, 12)))
        for inside in (False, True):
            text = ('"' if inside else "") + line + "\n" + "END\n"
            rows = list(csv.reader(io.StringIO(text, newline="")))
            assert opens(line + "\n", inside) == (rows[-1] != ["END"]), (line, inside)


def test_states_of_ranges(spark):
    rows = [("f", 0, 0, False, True), ("f", 10, 0, True, False), ("f", 20, 0, True, False), ("f", 30, 0, True, True), ("f", 40, 1, True, False),
            ("f", 40, 0, True, True), ("f", 50, 0, False, False), ("f", 60, 0, False, True), ("g", 0, 0, True, True), ("g", 9, 0, False, True), ("g", 12, 0, True, False)]
    df = spark.createDataFrame(rows, "path string, block long, n long, a0 boolean, a1 boolean")
    got = {(r.path, r.block): r.carry for r in range_states(df).collect()}
    assert got == {("f", 10): False, ("f", 20): True, ("f", 30): False, ("f", 40): True, ("f", 50): False, ("f", 60): False,
                   ("g", 9): True, ("g", 12): True}


def test_a_big_file_is_read_by_many_tasks(spark, tmp_path):
    """One annotation index of some megabytes with line breaks in its cells."""
    folder = tmp_path / "c1" / "metadata"
    folder.mkdir(parents=True)
    with open(folder / "annotations.csv", "w", newline="") as f:
        w = csv.writer(f)
        w.writerow(["annotation_filename", "set", "range_onset", "range_offset", "notes"])
        for k in range(40_000):
            w.writerow([f"r{k}_0_9.csv", "s", k, k + 9, 'line one\nline "two"' if k % 3 == 0 else "plain, text"])
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "256k")
    try:
        df = scan_index(spark, str(tmp_path), "annotations")
        assert df.select(F.sum("range_onset"), F.sum(F.length("notes")), F.count("*"), F.countDistinct("annotation_filename")).first() == (
            sum(range(40_000)), 13334 * len('line one\nline "two"') + 26666 * len("plain, text"), 40_000, 40_000)
        lines = stored_lines(spark, str(tmp_path), "annotations.csv")
        assert lines.select("block").distinct().count() >= 6
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
