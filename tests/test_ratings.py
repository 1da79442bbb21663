"""Rating questions Q1-Q5 on invented text fixtures: readers, operators,
reports. Expectations come from the line-at-a-time model in
``ratings_model`` plus a few values stated by hand."""

from __future__ import annotations

import math
import os

import pytest

from sparktally.plans import movies as mq
from sparktally.sources import read_movies, read_ratings, read_users
from tests import ratings_model as model
from tests.conftest import write_lines

MOVIES = [
    "10, Alpha (2001), Action|Comedy",
    "11, Beta, the Sequel (2002), Drama||",  # comma in the title, trailing pipes
    "12, Gamma (2003), (no genres listed)",
    "13, Delta (2004), ",  # empty genres
    "14, Epsilon (2005), Action|Action",  # repeated genre
    "15",  # too few fields
    "16, Zeta (2006), Horror",  # never rated
    "17, Alpha (2001), Comedy",  # same title as 10
    "10, Alpha Duplicate (2001), Western",  # duplicate id
    "18, Eta (2007), Drama|Thriller",
    "19, Theta (2008), Drama",
    "20, Iota (2009), Sci-Fi",
    "21, Kappa (2010)",  # two fields: title, no genres
    "22, Lambda (2011), |a||b",  # inner empty genres
]

RATINGS_1 = [
    "u1, 10, 4.0, 100",
    "u2, 10, 3.0,",  # trailing comma
    "u3, 10",  # too few fields
    "u1, 10, abc, 101",  # not a number
    "u5, 10, nan, 1",  # words that only look like special numbers
    "u6, 10, inf, 1",
    "u7, 10, INFINITY, 1",
    "u8, 10, -inf, 1",
    "u4, 99, 2.0, 1",  # movie not in movies
    "u9, 11, 1.0, 5",  # user not in users
    "u1, 11, 4.0, 100",  # also in the second file
    "u2, 12, 5.0, 1",
    "u3, 13, 3.5, 1",
    "u4, 14, 4.0d, 1",
    "u5, 14, NaN, 1",
    "u6, 14, 3.0, 1",
    "u7, 14, 2.0, 1",
    "u8, 14, 1.0, 1",
    "u1, 17, 2.5, 1",
    "u10, 22, 4.0, 1",
]
RATINGS_2 = [
    "u1, 11, 4.0, 100",  # the same line as in the first file
    "u2, 18, 4.0, 1",
    "u3, 18, 4.0, 1",
    "u4, 18, 4.0, 1",
    "u5, 18, 4.0, 1",
    "u6, 18, 4.0, 1",  # 18: exactly 5 ratings, mean 4.0
    "u1, 19, 5.0, 1",
    "u2, 19, 5.0, 1",
    "u3, 19, 4.0, 1",
    "u4, 19, 4.0, 1",
    "u5, 19, 2.0, 1",  # 19: 5 ratings, mean 4.0 too -> tie, 18 wins
    "u6, 20, 5.0, 1",
    "u7, 20, 5.0, 1",
    "u8, 20, 5.0, 1",
    "u1, 20, 5.0, 1",  # 20: higher mean, only 4 ratings
    "u10, 21, 3.0, 1",
]
USERS = [
    "u1, M, 18, 1, 111",
    "u2, male, 19, 2, 222",
    "u3, 1, 35, 3, 333",
    "u4, F, 36, 4, 444",
    "u5, FEMALE, 50, 5, 555",
    "u6, 0, 51, 6, 666",
    "u7, X, abc, 7, 777",
    "u8, F, 25.7, 8, 888",
    "u1, F, 40, 9, 999",  # duplicate user: the last line wins
    "u10,\tM\t, 30",  # tabs around a field
]


@pytest.fixture(scope="module")
def files(tmp_path_factory):
    d = tmp_path_factory.mktemp("ratings")
    return {
        "movies": write_lines(d / "movies.txt", MOVIES),
        "ratings": [write_lines(d / "ratings_1.txt", RATINGS_1), write_lines(d / "ratings_2.txt", RATINGS_2)],
        "users": write_lines(d / "users.txt", USERS),
        "dir": d,
    }


@pytest.fixture(scope="module")
def frames(spark, files):
    return (
        read_movies(spark, files["movies"]),
        read_ratings(spark, files["ratings"]),
        read_users(spark, files["users"]),
    )


@pytest.fixture(scope="module")
def expected():
    mv = model.movies(MOVIES)
    rt = model.ratings(RATINGS_1 + RATINGS_2)
    gender, age = model.users(USERS)
    return mv, rt, gender, age


def _same(a, b):
    if a is None or b is None:
        return a is b
    if isinstance(a, float) and math.isnan(a):
        return isinstance(b, float) and math.isnan(b)
    return a == b if not isinstance(a, float) else abs(a - b) < 1e-12


def test_readers(frames):
    movies, ratings, users = frames
    m = {r.movie_id: (r.title, r.genres) for r in movies.collect() if r.movie_id != "10"}
    assert m["11"] == ("Beta, the Sequel (2002)", "Drama||")
    assert m["13"] == ("Delta (2004)", "")
    assert m["21"] == ("Kappa (2010)", None)
    assert "15" not in m
    rows = ratings.collect()
    assert len(rows) == len(RATINGS_1) + len(RATINGS_2) - 1  # only the 2-field line is dropped
    assert sum(1 for r in rows if r.user_id == "u1" and r.movie_id == "11") == 2
    assert [r.rating for r in rows if r.movie_id == "10"].count(None) == 5
    u = {(r.user_id, r.line_no): (r.gender, r.age) for r in users.collect()}
    assert ("M", 30) in u.values()  # tabs trimmed
    assert [v for k, v in u.items() if k[0] == "u8"] == [("F", None)]  # '25.7' is not an int


def test_q1_movie_ratings(frames, expected):
    movies, ratings, _ = frames
    mv, rt, _, _ = expected
    got = {r.movie_id: (r.title, r.avg_rating, r.n) for r in mq.movie_ratings(ratings, movies).collect()}
    exp = model.q1(mv, rt)
    assert got.keys() == exp.keys()
    for k in exp:
        assert all(_same(a, b) for a, b in zip(got[k], exp[k])), k
    assert got["99"][0] == "Unknown Movie"
    assert got["10"][2] == 2  # 4.0 and 3.0; 'abc' and the short line count nowhere
    assert got["11"][2] == 3  # duplicated line in both files counted twice
    assert "16" not in got  # never rated
    assert math.isnan(got["14"][1])


def test_q1_sorted_by_id(frames):
    movies, ratings, _ = frames
    ids = [r.movie_id for r in mq.movie_ratings(ratings, movies).collect()]
    assert ids == sorted(ids)


def test_q2_best_movie(frames, expected):
    movies, ratings, _ = frames
    mv, rt, _, _ = expected
    rows = mq.best_movie(ratings, movies).collect()
    assert len(rows) == 1
    best = model.q2(mv, rt)
    assert (rows[0].movie_id, rows[0].title, rows[0].avg_rating, rows[0].n) == best
    assert rows[0].movie_id == "18"  # tie with 19 -> lowest id; 20 has only 4 ratings; 14 is NaN


def test_q2_no_qualifying_movie(frames):
    movies, ratings, _ = frames
    assert mq.best_movie(ratings, movies, min_support=100).count() == 0


def test_q3_genre_ratings(frames, expected):
    movies, ratings, _ = frames
    mv, rt, _, _ = expected
    got = {r.genre: (r.avg_rating, r.n) for r in mq.genre_ratings(ratings, movies).collect()}
    exp = model.q3(mv, rt)
    assert got.keys() == exp.keys()
    for k in exp:
        assert all(_same(a, b) for a, b in zip(got[k], exp[k])), k
    assert "(no genres listed)" not in got
    assert "Western" in got  # the duplicate id 10 keeps one genre list, its ratings counted once
    assert got["Western"][1] == 2


def test_q3_sorted_by_genre(frames):
    movies, ratings, _ = frames
    genres = [r.genre for r in mq.genre_ratings(ratings, movies).collect()]
    assert genres == sorted(genres)


def test_q4_gender_ratings(frames, expected):
    movies, ratings, users = frames
    mv, rt, gender, _ = expected
    got = {r.movie_id: (r.title, r.avg_male, r.avg_female) for r in mq.gender_ratings(ratings, users, movies).collect()}
    exp = model.q4(mv, rt, gender)
    assert got.keys() == exp.keys()
    for k in exp:
        assert all(_same(a, b) for a, b in zip(got[k], exp[k])), k
    assert got["17"][1:] == (None, 2.5)  # u1 is female by its last line


def test_q5_age_ratings(frames, expected):
    movies, ratings, users = frames
    mv, rt, _, age = expected
    df = mq.age_ratings(ratings, users, movies)
    assert df.columns == ["movie_id", "title", *mq.AGE_COLUMNS]
    got = {r[0]: tuple(r[1:]) for r in df.collect()}
    exp = model.q5(mv, rt, age)
    assert got.keys() == exp.keys()
    for k in exp:
        assert all(_same(a, b) for a, b in zip(got[k], exp[k])), k


def test_reports_render(spark, files):
    out = os.path.join(files["dir"], "out_movies")
    mq.run_rating_report(spark, "movies", files["movies"], files["ratings"], out)
    lines = spark.read.text(out).collect()
    text = [r.value for r in lines]
    assert "Unknown Movie\tAverageRating: 2.00 (TotalRatings: 1)" in text
    assert (
        "Eta (2007) is the highest rated movie with an average rating of 4.00 among movies with at least 5 ratings.\t"
        in text
    )
    genres = [r.value for r in spark.read.text(_write(spark, mq, "genres", files)).collect()]
    assert "Drama\tAvg: 3.62, Count: 13" in genres or any(g.startswith("Drama\tAvg: ") for g in genres)
    gender = [r.value for r in spark.read.text(_write(spark, mq, "gender", files)).collect()]
    assert any(g.startswith("Alpha (2001)" + " " * 23 + "\tMale: N/A , Female: 2.50") for g in gender)
    age = [r.value for r in spark.read.text(_write(spark, mq, "age", files)).collect()]
    assert any("0-18: NA   18-35: " in a for a in age)


def _write(spark, mod, question, files):
    out = os.path.join(files["dir"], f"out_{question}")
    mod.run_rating_report(spark, question, files["movies"], files["ratings"], out, files["users"])
    return out
