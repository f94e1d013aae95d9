"""Rows without a key: identity by place, and a re-split that does not lose copies."""

import csv
from collections import Counter

import pytest
from pyspark.sql import functions as F

from corpusloom.plans.labeled import resplit_pool
from corpusloom.sources import pool

TEXTS = ['plain', 'with, comma and "quotes"', 'two\nlines', '', 'NA', ' blanks ', 'plain', 'é中']


@pytest.fixture
def folder(tmp_path):
    rows = {
        "train": [(TEXTS[i % len(TEXTS)], i % 2) for i in range(700)],
        "val": [("copy", 1)] * 300,
        "a b+c%20é": [(f"row {i // 3}", 0) for i in range(100)],
    }
    for name, held in rows.items():
        with open(tmp_path / f"{name}.csv", "w", newline="", encoding="utf-8") as file:
            writer = csv.writer(file)
            writer.writerow(["text", "label"])
            writer.writerows(held)
    return tmp_path, [f"{tmp_path}/{n}.csv" for n in (*rows, "missing")], [r for x in rows.values() for r in x]


def test_every_row_has_a_place_of_its_own(spark, folder):
    path, files, rows = folder
    got = pool.read_pool(spark, files, "text string, label int")
    held = [(r[pool.FILE], r[pool.ROW], r["text"], r["label"]) for r in got.collect()]
    assert Counter(h[2:] for h in held) == Counter(rows)
    places = Counter(h[0] for h in held)
    assert sorted(places.values()) == [100, 300, 700]
    for file, n in places.items():
        assert sorted(h[1] for h in held if h[0] == file) == list(range(n))
    # in the order of the file
    first = sorted(h[1:] for h in held if places[h[0]] == 700)
    assert [h[1:] for h in first] == rows[:700]


def test_identity_does_not_depend_on_blocks_or_the_folder(spark, folder, tmp_path_factory):
    path, files, rows = folder
    other = tmp_path_factory.mktemp("moved")
    for file in path.glob("*.csv"):
        (other / file.name).write_bytes(file.read_bytes())

    def places(where):
        got = pool.read_pool(spark, [f"{where}/*.csv"], "text string, label int")
        return sorted((r[pool.FILE], r[pool.ROW], r["text"]) for r in got.collect())

    whole = places(path)
    assert len(whole) == 1100 and all(not p[0].startswith("0:file") for p in whole)
    assert places(other) == whole


def test_rows_of_split_files_are_numbered_through(spark, tmp_path):
    """Lines of one large file, read in many blocks."""
    lines = [f"line {i}" for i in range(30_000)]
    (tmp_path / "one.txt").write_text("\n".join(lines))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20k")
    try:
        scan = spark.read.text(str(tmp_path)).select(
            "value", F.lit("f").alias(pool.FILE), F.col("_metadata.file_block_start").alias("row_block")
        )
        got = pool.numbered_in_blocks(scan).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    blocks = {r["row_block"] for r in got}
    assert len(blocks) > 5
    ordered = sorted((r["row_block"], r[pool.ROW], r["value"]) for r in got)
    assert [r[2] for r in ordered] == lines
    assert len({r[:2] for r in ordered}) == len(lines)


def test_resplit_keeps_all_copies_and_sizes(spark, folder):
    path, files, rows = folder
    split = resplit_pool(spark, files, train_ratio=0.9)
    held = split.collect()
    assert Counter((r["text"], r["label"]) for r in held) == Counter(rows)
    assert Counter(r["split"] for r in held) == {"train": 990, "validation": 54, "test": 56}
    # copies are dealt out like other rows
    assert len({r["split"] for r in held if r["text"] == "copy"}) == 3
    again = resplit_pool(spark, files, train_ratio=0.9)
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, held))


def test_no_file(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        pool.read_pool(spark, [f"{tmp_path}/none.csv"], "text string, label int")
    empty = resplit_pool(spark, [f"{tmp_path}/none.csv"], require_any=False)
    assert empty.count() == 0 and "split" in empty.columns
    with pytest.raises(ValueError):
        pool.read_pool(spark, [], "row_file string")
