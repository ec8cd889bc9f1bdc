from .batches import assign_batches, input_order_batches, running_counts
from .classify import (
    classify_ratings,
    classify_with_clusters,
    cluster_table,
    feature_stats,
    fit_classes,
    rating_quadrant,
)
from .crawl import extract_class_text, fetch_outcomes, fetch_totals, pending, running_totals
from .dedupe import first_rows, keep_one, repeated_apart
from .joins import band_join, hot_keys, hot_keys_if_any, not_broadcast, or_join, salted_join
from .match import fuzzy_match
from .reports import file_report, listed_files, match_report, review_aggregates, stop_word_report
from .words import (
    avg_tfidf,
    count_words,
    drop_stop_words,
    drop_tagged_words,
    removed_sample,
    removed_words,
    top_words,
    with_totals,
    word_frequency,
    word_totals,
)

__all__ = [
    "assign_batches", "avg_tfidf", "band_join", "classify_ratings", "classify_with_clusters", "cluster_table", "count_words", "drop_stop_words",
    "drop_tagged_words", "extract_class_text", "feature_stats", "fetch_outcomes",
    "fetch_totals", "file_report", "first_rows", "fit_classes", "fuzzy_match", "hot_keys", "hot_keys_if_any", "input_order_batches", "keep_one",
    "listed_files", "match_report", "not_broadcast", "or_join", "pending", "rating_quadrant", "removed_sample", "removed_words", "repeated_apart",
    "review_aggregates", "running_counts", "running_totals", "salted_join", "stop_word_report", "top_words", "with_totals", "word_frequency", "word_totals",
]
