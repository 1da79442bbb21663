"""Replacing targets, line order over files, rejected lines, long stop lists."""

from __future__ import annotations

import os
import subprocess
import sys
import time

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from sparktally.operators import count_by, remove_stopwords
from sparktally.plans.files import FILE_QUERIES, _written_lines
from sparktally.sinks import replacing, write_csv, write_delimited, write_key_value, write_parquet
from sparktally.sources import number_lines, parse_ratings, read_delimited, read_lines, read_ratings, read_stopwords
from tests.conftest import SF_SMOKE, write_lines
from tests.test_skew import skew_conf  # noqa: F401


def _text(path):
    parts = sorted(f for f in os.listdir(path) if f.startswith("part-"))
    return [line for p in parts for line in open(os.path.join(path, p), encoding="utf-8").read().splitlines()]


@pytest.fixture
def target(tmp_path):
    return str(tmp_path / "out" / "table")


def _frame(spark, n=50):
    return spark.range(n).select(F.col("id").cast("string").alias("k"), F.concat(F.lit("v"), "id").alias("v")).repartition(3, "k")


def _failing(df):
    """Fails in the task of one row, when others may be written already."""
    return df.withColumn("v", F.when(F.col("k") == "7", F.raise_error(F.lit("broken row")).cast("string")).otherwise(F.col("v")))


@pytest.mark.parametrize(
    "write",
    [
        lambda df, p: write_key_value(df, p, "k", "v"),
        write_delimited,
        write_csv,
        lambda df, p: write_csv(df, p, sep=";"),
    ],
)
def test_a_failed_write_leaves_the_old_target(spark, target, write):
    write(_frame(spark), target)
    old = _text(target)
    assert len(old) == 50
    with pytest.raises(Exception, match="broken row"):
        write(_failing(_frame(spark)), target)
    assert _text(target) == old
    write(_frame(spark, 5), target)
    assert len(_text(target)) == 5
    assert os.listdir(os.path.dirname(target)) == ["table"]  # nothing left beside it


def test_a_field_with_the_separator_leaves_the_old_target(spark, target):
    write_delimited(_frame(spark), target)
    with pytest.raises(Exception, match="holds the separator"):
        write_delimited(_frame(spark).withColumn("v", F.lit("a,b")), target)
    assert len(_text(target)) == 50


def test_a_first_write_that_fails_leaves_nothing(spark, target):
    with pytest.raises(Exception, match="broken row"):
        write_parquet(_failing(_frame(spark)), target)
    assert not os.path.exists(target)


def test_a_target_can_be_replaced_from_itself(spark, target):
    write_parquet(_frame(spark), target, partition_by=["k"])
    again = spark.read.parquet(target).select("v", "k").where("k < 3")
    write_parquet(again, target, partition_by=["k"])
    assert sorted(r.v for r in spark.read.parquet(target).collect()) == sorted(f"v{i}" for i in range(3))


def test_an_error_of_the_caller_keeps_the_target(spark, target):
    write_delimited(_frame(spark), target)
    with pytest.raises(KeyError):
        with replacing(spark, target) as new:
            _frame(spark).write.parquet(new)
            raise KeyError("second output")
    assert len(_text(target)) == 50
    assert os.listdir(os.path.dirname(target)) == ["table"]


def test_lines_are_numbered_over_files_in_name_order(spark, tmp_path):
    for name, n in (("c.txt", 3), ("a.txt", 2000), ("b.txt", 1), ("empty.txt", 0)):
        write_lines(tmp_path / name, [f"{name} {i}" for i in range(n)], newline="\n")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")  # several splits of one file
        rows = number_lines(read_lines(spark, str(tmp_path))).orderBy("position").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    want = [f"a.txt {i}" for i in range(2000)] + ["b.txt 0"] + [f"c.txt {i}" for i in range(3)]
    assert [(r.position, r.value) for r in rows] == list(enumerate(want, 1))


def test_rejected_lines_are_counted_in_the_same_scan(spark, tmp_path):
    lines = ["u1, 10, 4.0, 1", "u2, 10", "u3, 10, abc, 1", "u4,,", "", "u5, 11, NaN, 1", "u6, 11, , 2", "u7, 12, 3.5"]
    path = write_lines(tmp_path / "r.txt", lines, newline="\n")
    seen = Observation()
    df = read_ratings(spark, path, seen)
    scans = df._jdf.queryExecution().executedPlan().toString().count("FileScan")
    rows = df.collect()
    assert scans == 1
    assert seen.get == {"lines": len(lines), "short": 3, "unparsable": 2}
    plain = read_ratings(spark, path)
    assert plain.schema == df.schema
    key = lambda r: (r.user_id, str(r))
    assert [str(r) for r in sorted(rows, key=key)] == [str(r) for r in sorted(plain.collect(), key=key)]


def test_counts_stand_for_all_files_and_none(spark, tmp_path):
    paths = [write_lines(tmp_path / f"{i}.txt", [f"u{i}, 1, {i}.0, 1", "short"], newline="\n") for i in range(6)]
    seen = Observation()
    assert read_ratings(spark, paths, seen).count() == 6
    assert (seen.get["lines"], seen.get["short"], seen.get["unparsable"]) == (12, 6, 0)
    none = Observation()
    empty = spark.createDataFrame([], "value string, line_no int")
    assert parse_ratings(empty, none).collect() == []
    assert none.get == {"lines": 0, "short": 0, "unparsable": 0}


def test_a_hot_word_against_a_long_stop_list_is_split(spark, skew_conf, tmp_path):  # noqa: F811
    """A third of all tokens is one word, and the list is joined by a shuffle:
    the hot word's partition is cut into several tasks."""
    stop = [f"w{i}" for i in range(0, 4000, 2)] + ["two words", "w0", ""]
    entries = read_stopwords(spark, write_lines(tmp_path / "stop.txt", stop, newline="\n"))
    tokens = spark.range(60_000).select(
        F.col("id").cast("string").alias("id"),
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("w"), F.col("id") % 4000)).alias("word"),
        F.sha2(F.col("id").cast("string"), 256).alias("more"),
    ).repartition(8)
    kept = remove_stopwords(tokens, entries, long_list=True)
    counts = kept.groupBy("word").agg(F.count("id").alias("n"), F.max("more"))
    got = {r.word: r.n for r in counts.collect()}
    want = {"hot": 20_000}
    for i in range(60_000):
        if i % 3 and (i % 4000) % 2:
            want[f"w{i % 4000}"] = want.get(f"w{i % 4000}", 0) + 1
    assert got == want
    # The same without the promise of a long list: equal result.
    assert {r.word: r.n for r in count_by(remove_stopwords(tokens, entries), ["word"], "id").collect()} == want
    plan = counts._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin(skew=true)" in plan and "LeftAnti" in plan


def test_delimited_rows_read_back(spark, target):
    rows = [("1", None, '"q"'), ("2", "a b", ""), ("3", "", "x;y")]
    df = spark.createDataFrame(rows, "a string, b string, c string")
    write_delimited(df, target, sep=",")
    got = sorted(map(tuple, read_delimited(spark, target, "a string, b string, c string", sep=",").collect()))
    assert got == [("1", None, '"q"'), ("2", "a b", None), ("3", None, "x;y")]


def test_scratch_tables_go_when_the_driver_ends(tmp_path):
    """In a driver of its own: what a query left in the scratch folder is
    there while it runs and gone afterwards."""
    code = (
        "import os, sys\n"
        "from sparktally.plans.files import q_csv_fields\n"
        "from sparktally.session import get_session\n"
        "spark = get_session('local[2]', extra_conf={'spark.checkpoint.dir': sys.argv[1]})\n"
        "assert q_csv_fields(spark, sys.argv[2]).count() > 0\n"
        "assert any(f.startswith('files-') for f in os.listdir(sys.argv[1]))\n"
    )
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    folder = tmp_path / "scratch"
    folder.mkdir()
    subprocess.run([sys.executable, "-c", code, str(folder), SF_SMOKE], check=True, cwd=root, timeout=300)
    for _ in range(60):  # the JVM ends a moment after its driver
        if not any(f.startswith("files-") for f in os.listdir(folder)):
            return
        time.sleep(0.5)
    raise AssertionError(os.listdir(folder))


def test_large_written_lines_are_split_by_size(spark, skew_conf):  # noqa: F811
    """Files follow the size of the lines, also of one that is very often
    repeated; no fixed number of them."""
    df = spark.range(60_000).select(F.when(F.col("id") % 2 == 0, 0).otherwise(F.col("id")).alias("id")).repartition(8)
    path = _written_lines(df, "sha2(cast(id AS string), 256)", "split")
    files = [f for f in os.listdir(path) if f.startswith("part-")]
    assert len(files) > 8
    assert spark.read.text(path).count() == 60_000


def test_tokens_are_counted_before_they_meet_a_long_stop_list(spark):
    plan = FILE_QUERIES["long_stop_list"](spark, SF_SMOKE)._jdf.queryExecution().optimizedPlan().toString()
    # What meets the list are stored counts, not the tokens.
    assert "Generate explode" not in plan and "LeftAnti" in plan
