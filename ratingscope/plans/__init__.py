from .abt import ABT_COLUMNS, AbtSources, build_abt
from .merge import attach_category
from .urls import review_urls, route_titles
from .wordstats import category_words, clean_word_table, word_weights

__all__ = [
    "ABT_COLUMNS", "AbtSources", "attach_category", "build_abt", "category_words",
    "clean_word_table", "review_urls", "route_titles", "word_weights",
]
