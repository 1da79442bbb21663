"""DataFrame -> DataFrame operators."""

from sparktally.operators.counts import count_by, frequent, group_collect, top_k
from sparktally.operators.joins import (
    anti_join,
    last_per_key,
    left_join_default,
    one_per_key,
    splittable_join,
)
from sparktally.operators.ratings import (
    NO_GENRES,
    UNKNOWN_TITLE,
    rate_by_segment,
    rate_entities,
    rate_tags,
    rating_stats,
    tag_parts,
    top_rated,
)
from sparktally.operators.setops import union_all
from sparktally.operators.text import (
    clean_tokens,
    remove_stopwords,
    tokenize,
    valid_reviews,
)

__all__ = [
    "NO_GENRES",
    "UNKNOWN_TITLE",
    "anti_join",
    "clean_tokens",
    "count_by",
    "frequent",
    "group_collect",
    "last_per_key",
    "left_join_default",
    "one_per_key",
    "rate_by_segment",
    "rate_entities",
    "rate_tags",
    "rating_stats",
    "remove_stopwords",
    "splittable_join",
    "tag_parts",
    "tokenize",
    "top_k",
    "top_rated",
    "union_all",
    "valid_reviews",
]
