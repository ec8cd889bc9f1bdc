from .casts import (
    digits_only_int,
    imdb_id,
    lenient_double,
    lenient_int,
    lenient_long,
    parse_date,
    parse_month_date,
)
from .credits import parse_credits
from .text import (
    clean_review,
    escape_quotes,
    is_positive,
    json_names,
    resolve_columns,
    strip,
    words_of,
)
from .titles import jaccard, match_score, title_tokens, year_score
from .urls import is_clean_title, review_url, slug_plain, slug_squeezed

__all__ = [
    "clean_review", "digits_only_int", "escape_quotes", "imdb_id", "is_clean_title",
    "is_positive", "jaccard", "json_names", "lenient_double", "lenient_int", "lenient_long",
    "match_score", "parse_credits", "parse_date", "parse_month_date",
    "resolve_columns", "review_url", "slug_plain", "slug_squeezed", "strip",
    "title_tokens", "words_of", "year_score",
]
