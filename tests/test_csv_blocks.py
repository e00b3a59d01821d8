"""CSV files read in blocks of bytes, against Python's csv module."""

import csv
import random

import pytest

from rostrum.sources import csv_blocks

SCHEMA = "id bigint, body string, text string"


def write(path, rows, end):
    with open(path, "w", newline="", encoding="utf-8") as f:
        w = csv.writer(f, lineterminator=end)
        w.writerow(["id", "body", "text"])
        w.writerows(rows)


def rows(n, seed):
    rng = random.Random(seed)
    bits = ["plain", 'say "x"', "line\nbreak", "cr\r\nlf", ",", '"', "", "ü東", '\n\n"\n', "x" * 80, "NA", "last\n"]
    return [(i, rng.choice(["House", "Senate", "", "N/A"]), "".join(rng.choice(bits) for _ in range(rng.randint(0, 6)))) for i in range(n)]


@pytest.mark.parametrize("size,end", [(64, "\n"), (1000, "\r\n"), (1 << 27, "\n")])
def test_blocks(spark, tmp_path, size, end):
    spark.conf.set("spark.sql.files.maxPartitionBytes", size)
    spark.conf.set("spark.sql.files.openCostInBytes", 0)
    spark.conf.set("spark.sql.files.minPartitionNum", 1)
    try:
        folder = tmp_path / "in"
        folder.mkdir()
        parts = [rows(120, 1), rows(40, 2), []]
        for i, part in enumerate(parts):
            write(folder / f"f{i}.csv", part, end)
        df = csv_blocks.read_csv_blocks(spark, str(folder), SCHEMA)
        got = df.collect()
        blocks = {(r.file, r.block) for r in got}
        assert len(blocks) > 50 if size == 64 else len(blocks) >= 2
        na = lambda x: None if x in ("", "NA", "N/A") else x
        for i, part in enumerate(parts):
            mine = sorted((r for r in got if r.file.endswith(f"f{i}.csv")), key=lambda r: (r.block, r.line))
            assert [(r.id, r.body, r.text) for r in mine] == [(a, na(b), na(c)) for a, b, c in part]
        totals = csv_blocks.chunk_totals(df.na.fill("none"), "body").collect()
        for b in {r.body for r in totals}:
            mine = sorted((r for r in totals if r.body == b), key=lambda r: (r.file, r.block))
            run = 0
            for r in mine:
                run += r.rows
                assert r.total == run
            assert run == sum((na(x[1]) or "none") == b for part in parts for x in part)
    finally:
        for c in ("maxPartitionBytes", "openCostInBytes", "minPartitionNum"):
            spark.conf.unset(f"spark.sql.files.{c}")


def test_missing_column(spark, tmp_path):
    write(tmp_path / "f.csv", rows(3, 1), "\n")
    with pytest.raises(ValueError, match="lacks: date"):
        csv_blocks.read_csv_blocks(spark, str(tmp_path), "id bigint, date string")
    few = csv_blocks.read_csv_blocks(spark, str(tmp_path), "text string, id bigint")  # other columns are left out
    assert few.columns == ["file", "block", "line", "text", "id"] and sorted(r.id for r in few.collect()) == [0, 1, 2]
