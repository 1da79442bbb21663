"""Sinks (write / read round trips, previews) and the streaming counts."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from sparktally.plans import reviews as rq
from sparktally.sinks import dump, preview, write_csv, write_delimited, write_key_value
from sparktally.sources import REVIEW_SCHEMA, read_delimited
from sparktally.streaming import ingested_counts, start_review_ingest
from tests.conftest import write_lines as write_file


def test_key_value_and_csv_round_trip(spark, tmp_path):
    df = spark.createDataFrame([("a", "x, y", 1), ("b", None, 2)], "k string, v string, n long")
    kv = str(tmp_path / "kv")
    write_key_value(df, kv, "k", "v")
    write_key_value(df, kv, "k", "v")  # a re-run replaces the target
    assert sorted(r.value for r in spark.read.text(kv).collect()) == ["a\tx, y", "b\t"]
    csv = str(tmp_path / "csv")
    write_csv(df, csv)
    back = spark.read.csv(csv, schema="k string, v string, n long").orderBy("k").collect()
    assert [tuple(r) for r in back] == [("a", "x, y", 1), ("b", None, 2)]


def test_delimited_refuses_a_field_with_the_separator(spark, tmp_path):
    df = spark.createDataFrame([("a", None, 1)], "k string, v string, n long")
    write_delimited(df, str(tmp_path / "ok"), ",")
    assert [r.value for r in spark.read.text(str(tmp_path / "ok")).collect()] == ["a,,1"]
    with pytest.raises(Exception, match="holds the separator"):
        write_delimited(df.withColumn("k", F.lit("room, view")), str(tmp_path / "no"), ",")


def test_preview_of_a_sorted_frame_is_its_first_rows(spark):
    df = spark.range(0, 1000, numPartitions=7).select(F.format_string("%04d", "id").alias("value"))
    assert [r.value for r in dump(df.orderBy("value"), 15)] == [f"{i:04d}" for i in range(15)]


def test_preview_and_dump_are_bounded(spark):
    df = spark.range(100)
    assert preview(df, 15).count() == 15
    assert len(dump(df.orderBy("id"), 10)) == 10
    assert [r.id for r in dump(df.orderBy(F.desc("id")), 3)] == [99, 98, 97]


def test_streaming_ingest_counts_match_batch(spark, tmp_path):
    src = tmp_path / "incoming"
    src.mkdir()
    first = ["1;Tốt;Room;View;positive", "2;Tệ;Food;Price;negative", "3;;Room;View;positive"]
    second = ["4;Ổn;ROOM;Staff;neutral", ";Không id;Room;View;positive", "6;Được;Service;Staff;positive"]
    write_file(src / "part1.csv", first)
    table = str(tmp_path / "ingested")
    ckpt = str(tmp_path / "ckpt")
    q = start_review_ingest(spark, str(src), table, checkpoint=ckpt)
    q.awaitTermination(120)
    got = {r.category: r.total_comments for r in ingested_counts(spark, table).collect()}
    assert got == {"room": 1, "food": 1}
    write_file(src / "part2.csv", second)
    q = start_review_ingest(spark, str(src), table, checkpoint=ckpt)  # resumes: only part2 is new
    q.awaitTermination(120)
    got = {r.category: r.total_comments for r in ingested_counts(spark, table).collect()}
    batch = rq.category_counts(read_delimited(spark, str(src), REVIEW_SCHEMA)).collect()
    assert got == {r.category: r.total_comments for r in batch} == {"room": 2, "food": 1, "service": 1}
    assert spark.read.parquet(table).count() == 5  # every valid row once, none twice
    aspects = {r.aspect: r.total_comments for r in ingested_counts(spark, table, "aspect").collect()}
    assert aspects == {"view": 1, "price": 1, "staff": 2}


def test_two_targets_of_one_source_are_both_complete(spark, tmp_path):
    src = tmp_path / "incoming"
    src.mkdir()
    write_file(src / "part1.csv", ["1;Tốt;Room;View;positive", "2;Tệ;Food;Price;negative"])
    for name in ("a", "b"):
        start_review_ingest(spark, str(src), str(tmp_path / name), str(tmp_path / f"ckpt-{name}")).awaitTermination(120)
        assert spark.read.parquet(str(tmp_path / name)).count() == 2


def test_command_line(tmp_path):
    import subprocess
    import sys

    movies = write_file(tmp_path / "movies.txt", ["1, A (2000), X|Y", "2, B (2001), Y"])
    ratings = write_file(tmp_path / "r.txt", ["u1, 1, 4.0, 1", "u2, 1, 3.0, 1", "u1, 2, 5.0, 1"])
    out = tmp_path / "out"
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    res = subprocess.run(
        [sys.executable, "-m", "sparktally", "--master", "local[2]", "ratings", "movies",
         "--movies", movies, "--ratings", ratings, "--out", str(out)],
        cwd=root, capture_output=True, text=True, timeout=300,
    )
    assert res.returncode == 0, res.stderr[-2000:]
    assert res.stdout.splitlines()[:2] == [
        "A (2000)\tAverageRating: 3.50 (TotalRatings: 2)",
        "B (2001)\tAverageRating: 5.00 (TotalRatings: 1)",
    ]


def test_command_line_reviews(tmp_path):
    import subprocess
    import sys

    reviews = write_file(tmp_path / "r.csv", ["1;Phòng đẹp, rất đẹp;Room;View;positive", "2;Đồ ăn dở;Food;Price;negative"])
    stop = write_file(tmp_path / "s.txt", ["rất"], newline="\n", final_newline=True)
    out = tmp_path / "out"
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    res = subprocess.run(
        [sys.executable, "-m", "sparktally", "--master", "local[2]", "reviews",
         "--reviews", reviews, "--stopwords", stop, "--out", str(out)],
        cwd=root, capture_output=True, text=True, timeout=300,
    )
    assert res.returncode == 0, res.stderr[-2000:]
    names = [line.split("\t")[0] for line in res.stdout.splitlines()]
    assert "tokens" in names and "top5_all" in names
    top = sorted(open(f).read() for f in (out / "top5_all").glob("part-*"))
    assert "room,đẹp,2\n" in "".join(top)
