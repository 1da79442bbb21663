"""One small test per semantic rule S1-S32 of SURVEY section 1.4, on tiny
in-code frames."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from sparktally.functions import clean_text, java_trim, two_decimals, two_decimals_or
from sparktally.operators import (
    clean_tokens,
    count_by,
    frequent,
    rate_by_segment,
    rate_entities,
    rate_tags,
    remove_stopwords,
    tokenize,
    top_k,
    top_rated,
)
from sparktally.plans import movies as mq
from sparktally.sinks.reports import band_report, gender_report, movie_report
from sparktally.sources import REVIEW_SCHEMA, parse_movies, parse_ratings, parse_users, read_delimited, read_lines
from tests.conftest import write_lines


def _lines(spark, lines):
    return spark.createDataFrame([(v, i) for i, v in enumerate(lines)], "value string, line_no long")


def _movies(spark, lines):
    return parse_movies(_lines(spark, lines))


def _ratings(spark, lines):
    return parse_ratings(_lines(spark, lines))


def _users(spark, lines):
    return parse_users(_lines(spark, lines))


def test_s01_fields_trimmed_java_style(spark):
    r = _users(spark, ["u1,\tM\t, 30"]).collect()[0]
    assert (r.user_id, r.gender, r.age) == ("u1", "M", 30)
    assert spark.range(1).select(java_trim(F.lit("\x0b x \x1f"))).first()[0] == "x"


def test_s02_too_few_fields_dropped(spark):
    assert _movies(spark, ["1"]).count() == 0
    assert _ratings(spark, ["u1, 1"]).count() == 0
    assert _users(spark, ["u1"]).count() == 0
    assert _movies(spark, ["1, Title"]).first().genres is None  # enough for the title, not for genres


def test_s03_trailing_empty_fields_dropped(spark):
    assert _ratings(spark, ["u1, 1, 3.0,"]).first().rating == 3.0
    m = _movies(spark, ["1, T, Drama,,"]).first()
    assert (m.title, m.genres) == ("T", "Drama")


def test_s04_title_between_first_and_last_comma(spark):
    m = _movies(spark, ["1, Hello, World (1999), Drama"]).first()
    assert (m.title, m.genres) == ("Hello, World (1999)", "Drama")


def test_s05_unparsable_rating_ignored(spark):
    ratings = _ratings(spark, ["u1, 1, 4.0", "u2, 1, abc", "u3, 1, 2.0d"])
    r = rate_entities(ratings).first()
    assert (r.avg_rating, r.n) == (3.0, 2)


def test_s06_unparsable_age_drops_user(spark):
    users = _users(spark, ["u1, M, 25.7", "u2, M, 30"])
    segs = {r.user_id for r in mq.age_segments(users).collect()}
    assert segs == {"u2"}


def test_s07_grouped_by_id_not_title(spark):
    movies = _movies(spark, ["1, Same, X", "2, Same, X"])
    out = rate_entities(_ratings(spark, ["u, 1, 1.0", "u, 2, 3.0"]), movies).collect()
    assert [(r.movie_id, r.title, r.avg_rating) for r in out] == [("1", "Same", 1.0), ("2", "Same", 3.0)]


def test_s08_unknown_movie_kept_then_dropped_for_tags(spark):
    ratings = _ratings(spark, ["u, 9, 2.0"])
    movies = _movies(spark, ["1, A, X"])
    assert rate_entities(ratings, movies).first().title == "Unknown Movie"
    assert rate_tags(ratings, movies).count() == 0


def test_s09_no_usable_rating_no_row(spark):
    assert rate_entities(_ratings(spark, ["u, 1, abc"])).count() == 0


def test_s10_best_movie_tie_lowest_id_or_nothing(spark):
    rated = rate_entities(_ratings(spark, [f"u{i}, {m}, 4.0" for m in ("20", "10") for i in range(5)]))
    assert top_rated(rated, 5).first().movie_id == "10"
    assert top_rated(rated, 6).count() == 0


def test_s11_tag_average_weighted_by_ratings(spark):
    ratings = _ratings(spark, ["u, 1, 5.0", "u, 2, 1.0", "u, 2, 1.0", "u, 2, 1.0"])
    movies = _movies(spark, ["1, A, G", "2, B, G"])
    r = rate_tags(ratings, movies).first()
    assert (r.avg_rating, r.n) == (2.0, 4)  # (5 + 3) / 4, not the mean of 5 and 1


def test_s12_genre_exclusions_trim_and_repeats(spark):
    ratings = _ratings(spark, ["u, 1, 4.0", "u, 2, 2.0", "u, 3, 3.0"])
    movies = _movies(spark, ["1, A, Drama | Drama", "2, B, (no genres listed)", "3, C, "])
    got = {r.genre: r.n for r in rate_tags(ratings, movies).collect()}
    assert got == {"Drama": 2}


def test_s13_gender_synonyms(spark):
    users = _users(spark, [f"u{i}, {g}" for i, g in enumerate(["M", "male", "1", "f", "FEMALE", "0", "X"])])
    segs = {r.user_id: r.segment for r in mq.gender_segments(users).collect()}
    assert [segs[f"u{i}"] for i in range(7)] == ["male"] * 3 + ["female"] * 3 + [None]


def test_s14_unknown_user_counts_nowhere(spark):
    ratings = _ratings(spark, ["ghost, 1, 5.0", "u1, 1, 1.0"])
    users = _users(spark, ["u1, M, 20"])
    g = mq.gender_ratings(ratings, users, _movies(spark, ["1, A, X"])).first()
    assert (g.avg_male, g.avg_female) == (1.0, None)
    assert mq.age_ratings(_ratings(spark, ["ghost, 1, 5.0"]), users, _movies(spark, ["1, A, X"])).count() == 0


def test_s15_bands_right_closed(spark):
    users = _users(spark, [f"u{a}, M, {a}" for a in (18, 19, 35, 36, 50, 51)])
    segs = {r.user_id: r.segment for r in mq.age_segments(users).collect()}
    assert [segs[f"u{a}"] for a in (18, 19, 35, 36, 50, 51)] == ["0-18", "18-35", "18-35", "35-50", "35-50", "50+"]


def test_s16_missing_average_labels(spark):
    df = spark.createDataFrame([("T", None, 2.0)], "title string, avg_male double, avg_female double")
    assert gender_report(df).first().value == "Male: N/A , Female: 2.00"
    df = spark.createDataFrame([("T", None, 4.0, None, None)], "title string, a double, b double, c double, d double")
    assert band_report(df, ["a", "b", "c", "d"]).first().value == "0-18: NA   18-35: 4.00 35-50: NA   50+: NA  "


def test_s17_duplicates(spark):
    users = _users(spark, ["u1, M, 20", "u1, F, 20"])
    assert mq.gender_segments(users).first().segment == "female"  # the last line wins
    movies = _movies(spark, ["1, A, X", "1, B, Y"])
    r = rate_entities(_ratings(spark, ["u, 1, 3.0"]), movies).first()
    assert r.n == 1  # not multiplied by the duplicate movie row


def _reviews(spark, rows):
    return spark.createDataFrame(rows, REVIEW_SCHEMA)


def test_s18_review_must_be_present(spark):
    df = _reviews(spark, [("1", None, "c", "a", "positive"), ("2", "", "c", "a", "positive"), ("3", "ok", "c", "a", "p")])
    assert [r.id for r in clean_tokens(df).collect()] == ["3"]


def test_s19_cleaning_order(spark):
    got = spark.range(1).select(clean_text(F.lit("Tốt,đẹp A-b^C “x” 7up"))).first()[0]
    assert got == "tốtđẹp a b c “x” up"


def test_s20_no_empty_tokens(spark):
    df = _reviews(spark, [("1", "!!! 123", "c", "a", "p"), ("2", " a  b ", "c", "a", "p")])
    assert sorted(r.word for r in clean_tokens(df).collect()) == ["a", "b"]


def test_s21_stopwords_whole_token(spark):
    df = _reviews(spark, [("1", "Of the cat, the end", "c", "a", "p")])
    stop = spark.createDataFrame([("of the",), ("the",), ("the",), (None,)], "stopword string")
    assert sorted(r.word for r in clean_tokens(df, stop).collect()) == ["cat", "end", "of"]
    tokens = spark.createDataFrame([("1", "cat"), ("2", "the")], "id string, word string")
    assert [r.word for r in remove_stopwords(tokens, stop).collect()] == ["cat"]


def test_s22_count_first_field_zero_groups_kept(spark):
    df = spark.createDataFrame([(None, "a"), (None, "a"), ("1", "b")], "id string, k string")
    assert {r.k: r.n for r in count_by(df, ["k"], "id").collect()} == {"a": 0, "b": 1}


def test_s23_labels_compared_lower_case(spark):
    df = _reviews(spark, [("1", "x", "Room", "VIEW", "Positive"), ("2", "y", "room", "view", "POSITIVE")])
    tokens = clean_tokens(df)
    assert {(r.category, r.aspect, r.sentiment) for r in tokens.collect()} == {("room", "view", "positive")}


def test_s24_rows_not_distinct_ids(spark):
    df = spark.createDataFrame([("1", "a"), ("1", "a")], "id string, k string")
    assert count_by(df, ["k"], "id").first().n == 2


def test_s25_threshold_strict(spark):
    df = spark.createDataFrame([("w500", 500), ("w501", 501)], "word string, freq long")
    assert [r.word for r in frequent(df, "freq", 500, "word").collect()] == ["w501"]


def test_s26_ties_broken_by_key(spark):
    df = spark.createDataFrame([("c", "b", 2), ("c", "a", 2), ("c", "z", 3)], "category string, word string, n long")
    got = [r.word for r in top_k(df, 2, [F.desc("n"), F.asc("word")], per=["category"]).collect()]
    assert got == ["z", "a"]


def test_s27_half_up_two_decimals(spark):
    assert spark.range(1).select(two_decimals(F.lit(4.125))).first()[0] == "4.13"


def test_s28_decimal_point(spark):
    df = spark.createDataFrame([("T", 4.25, 2)], "title string, avg_rating double, n long")
    assert movie_report(df).first().value == "AverageRating: 4.25 (TotalRatings: 2)"


def test_s29_null_test_before_formatting(spark):
    assert spark.range(1).select(two_decimals_or(F.lit(None).cast("double"), "NA")).first()[0] == "NA"


def test_s30_crlf_stripped(spark, tmp_path):
    path = write_lines(tmp_path / "m.txt", ["1, A, X", "2, B, Y"])
    assert all("\r" not in r.value for r in read_lines(spark, path).collect())


def test_s31_nan_never_wins(spark):
    rated = rate_entities(_ratings(spark, [f"u{i}, 1, NaN" for i in range(5)] + [f"u{i}, 2, 1.0" for i in range(5)]))
    assert math.isnan({r.movie_id: r.avg_rating for r in rated.collect()}["1"])
    assert top_rated(rated, 5).first().movie_id == "2"


def test_s32_delimited_load(spark, tmp_path):
    path = write_lines(tmp_path / "r.csv", ['1;a "b;c;d;e', "2;;c;d;e", "3;x", "4;x;c;d;e;extra"])
    rows = {r.id: tuple(r) for r in read_delimited(spark, path, REVIEW_SCHEMA).collect()}
    assert rows["1"][1] == 'a "b'
    assert rows["2"][1] is None
    assert rows["3"] == ("3", "x", None, None, None)
    assert rows["4"] == ("4", "x", "c", "d", "e")


def test_tokenize_keeps_other_columns(spark):
    df = spark.createDataFrame([("1", "a b", "c")], "id string, review string, category string")
    assert [tuple(r) for r in tokenize(df).collect()] == [("1", "a", "c"), ("1", "b", "c")]


def test_segments_keep_null_averages(spark):
    ratings = _ratings(spark, ["u1, 1, 2.0"])
    segs = spark.createDataFrame([("u1", "x")], "user_id string, segment string")
    r = rate_by_segment(ratings, segs, ("x", "y")).first()
    assert (r.avg_x, r.avg_y) == (2.0, None)


def test_last_line_wins_across_files(spark, tmp_path):
    from sparktally.sources import read_users

    a = write_lines(tmp_path / "a_users.txt", ["u1, M, 20"])
    b = write_lines(tmp_path / "b_users.txt", ["u2, F, 30"] * 50 + ["u1, F, 40"])  # larger file, later name
    seg = {r.user_id: r.segment for r in mq.gender_segments(read_users(spark, [b, a])).collect()}
    assert seg["u1"] == "female"  # the line of the later file wins, whatever the read order


def test_min_fields_of_a_delimited_load(spark, tmp_path):
    path = write_lines(tmp_path / "r.csv", ["1;a;b", "2;;", "3;x", "4;;z;extra"])
    got = read_delimited(spark, path, "id int, a string, b string", min_fields=2).collect()
    assert sorted(tuple(r) for r in got) == [(1, "a", "b"), (3, "x", None), (4, None, "z")]
