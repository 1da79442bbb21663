"""Rating aggregates: per entity, best entity, per tag, per user segment.

Shape shared by all: aggregate the fact table by key first (partial
aggregation before the shuffle, so a hot key costs one row per map task),
then join the dimension, which is reduced to one row per key. Shuffles then
carry one row per key, not one per rating.

Averages are exact sums divided once (``functions/exact.py``): they do not
depend on the order of the rows, so neither does a tie between two of them.

Column roles (defaults follow the movie-rating data): ratings have
``user_id, movie_id, rating``; movies have ``movie_id, title, genres``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparktally.functions.exact import LIMBS, add_limbs, exact_avg, exact_avg_where, limb_sums, limbs, limbs_total
from sparktally.functions.text import java_trim
from sparktally.functions.values import split_fields, strip_trailing
from sparktally.operators.joins import left_join_default, one_per_key, splittable_join

# The title given to a rated movie missing from the movie
# table, and the placeholder that marks a movie without genres.
UNKNOWN_TITLE = "Unknown Movie"
NO_GENRES = "(no genres listed)"


def rating_stats(ratings: DataFrame, key: str = "movie_id", value: str = "rating") -> DataFrame:
    """(key, avg_rating, n): average and count of usable ratings per key;
    NULL ratings count nowhere and a key without a usable rating gives no
    row. Partial aggregation runs before the shuffle."""
    return (
        ratings.groupBy(key)
        .agg(exact_avg(value).alias("avg_rating"), F.count(value).alias("n"))
        .where(F.col("n") > 0)
    )


def rate_entities(
    ratings: DataFrame,
    movies: DataFrame | None = None,
    key: str = "movie_id",
    value: str = "rating",
    label: str = "title",
    default: str = UNKNOWN_TITLE,
    ordered: bool = True,
) -> DataFrame:
    """Average and count of usable ratings per entity, with its label.

    -> (key, label, avg_rating, n). NULL ratings (unparsable) count nowhere;
    an entity without a usable rating gives no row. Rated entities missing
    from ``movies`` get ``default`` as label. Sorted by key when ``ordered``.
    """
    agg = rating_stats(ratings, key, value)
    if movies is None:
        out = agg.select(key, F.lit(default).alias(label), "avg_rating", "n")
    else:
        dim = one_per_key(movies.select(key, label), key, [label])
        out = left_join_default(agg, dim, key, {label: default}).select(key, label, "avg_rating", "n")
    return out.orderBy(key) if ordered else out


def top_rated(
    rated: DataFrame,
    min_support: int = 5,
    key: str = "movie_id",
    avg_col: str = "avg_rating",
    n_col: str = "n",
    movies: DataFrame | None = None,
    label: str = "title",
    default: str = UNKNOWN_TITLE,
) -> DataFrame:
    """The entity with the highest average among those with at least
    ``min_support`` ratings: zero or one row.

    A tie goes to the smallest key. NaN averages never win. Planned as
    ``TakeOrderedAndProject``: each task keeps its best row, no full sort.

    With ``movies``, ``rated`` holds statistics only (``rating_stats``) and
    the label is looked up for the winner alone: its key (one row, a proven
    bound) is broadcast into a semi-join with the movie scan, so the movie
    table is neither shuffled nor joined with every entity.
    """
    best = (
        rated.where((F.col(n_col) >= min_support) & ~F.isnan(F.col(avg_col)))
        .orderBy(F.desc(avg_col), F.asc(key))
        .limit(1)
    )
    if movies is None:
        return best
    winner = F.broadcast(best.select(key))
    dim = one_per_key(movies.select(key, label).join(winner, on=key, how="left_semi"), key, [label])
    return left_join_default(best, dim, key, {label: default}).select(key, label, avg_col, n_col)


def tag_parts(tags: Column, sep: str = "|") -> Column:
    """Split a list field like Java ``split``: trailing empty elements
    dropped (a field of separators only gives none), inner empty elements
    kept; elements are not trimmed. Explode the result and trim each tag
    afterwards (``java_trim``): both stay in whole-stage code generation."""
    empty = strip_trailing(tags, sep) == ""
    return F.when(empty, F.array().cast("array<string>")).otherwise(split_fields(tags, sep))


def rate_tags(
    ratings: DataFrame,
    movies: DataFrame,
    key: str = "movie_id",
    value: str = "rating",
    tags: str = "genres",
    tag_name: str = "genre",
    sep: str = "|",
    exclude: Sequence[str] = (NO_GENRES,),
    ordered: bool = True,
) -> DataFrame:
    """Rating-weighted average and count per tag of a multi-valued field.

    -> (tag_name, avg_rating, n). Each movie adds its rating sum and count
    to every tag it lists (a tag listed twice adds twice), so the average is
    sum of ratings / number of ratings over the tag, not a mean of movie
    means. Movies missing from ``movies``, with empty tags or with a tag
    field equal to one of ``exclude`` contribute nothing.
    """
    per_movie = (
        ratings.groupBy(key)
        .agg(limb_sums(limbs(value)).alias("_sum"), F.count(value).alias("_n"))
        .where(F.col("_n") > 0)
    )
    dim = one_per_key(movies.select(key, tags).where(F.col(tags).isNotNull()), key, [tags])
    dim = dim.where((F.col(tags) != "") & ~F.col(tags).isin(list(exclude)))
    exploded = per_movie.join(dim, on=key, how="inner").select(
        F.explode(tag_parts(F.col(tags), sep)).alias("_tag"), "_sum", "_n"
    )
    out = exploded.groupBy(java_trim("_tag").alias(tag_name)).agg(
        (limbs_total(add_limbs("_sum")) / F.sum("_n")).alias("avg_rating"), F.sum("_n").alias("n")
    )
    return out.orderBy(tag_name) if ordered else out


def rate_by_segment(
    ratings: DataFrame,
    segments: DataFrame,
    labels: Sequence[str],
    movies: DataFrame | None = None,
    key: str = "movie_id",
    user_key: str = "user_id",
    value: str = "rating",
    segment: str = "segment",
    label: str = "title",
    default: str = UNKNOWN_TITLE,
    prefix: str = "avg_",
    names: Sequence[str] | None = None,
    ordered: bool = True,
) -> DataFrame:
    """Average rating per entity for each user segment, side by side.

    ``segments`` maps each user to one segment value (one row per user;
    NULL or a value outside ``labels`` = in no segment). -> (key, label,
    prefix + l for l in labels, or ``names``); a column is NULL where the segment has no
    usable rating; entities with no usable rating in any segment give no row.

    Users outside every segment are dropped before the join (inner join), so
    their ratings never reach the shuffle of the aggregate. A user with a large
    share of the ratings is split (``splittable_join``). The segment averages
    are conditional aggregates in a single pass, with partial aggregation.
    """
    avg_cols = list(names) if names is not None else [prefix + lab for lab in labels]
    if len(avg_cols) != len(labels):
        raise ValueError("one column name per label")
    seg = segments.select(F.col(user_key), F.col(segment)).where(F.col(segment).isin(list(labels)))
    joined = splittable_join(ratings.select(user_key, key, value), seg, user_key)
    # Cut every rating once, not once for each segment.
    parts = [f"_{name}" for name in LIMBS]
    joined = joined.select(key, segment, value, *[p.alias(n) for p, n in zip(limbs(value), parts)])
    aggs = []
    counts = []
    for i, (lab, name) in enumerate(zip(labels, avg_cols)):
        hit = F.col(segment) == F.lit(lab)
        aggs.append(exact_avg_where(parts, value, hit).alias(name))
        aggs.append(F.count(F.when(hit, F.col(value))).alias(f"_n{i}"))
        counts.append(F.col(f"_n{i}") > 0)
    any_rated = counts[0]
    for c in counts[1:]:
        any_rated = any_rated | c
    agg = joined.groupBy(key).agg(*aggs).where(any_rated)
    if movies is None:
        out = agg.select(key, F.lit(default).alias(label), *avg_cols)
    else:
        dim = one_per_key(movies.select(key, label), key, [label])
        out = left_join_default(agg, dim, key, {label: default}).select(key, label, *avg_cols)
    return out.orderBy(key) if ordered else out
