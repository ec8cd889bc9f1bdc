"""The movie table: links, metadata, ratings, critic site, catalogue, credits, reviews."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.casts import (
    digits_only_int,
    imdb_id,
    lenient_double,
    lenient_int,
    lenient_long,
    parse_date,
    parse_month_date,
)
from ..functions.credits import parse_credits
from ..functions.text import json_names
from ..operators.dedupe import keep_one, repeated_apart
from ..operators.joins import hot_keys_if_any, or_join, salted_join
from ..operators.match import THRESHOLD, fuzzy_match
from ..operators.reports import review_aggregates
from ..sources.catalog import Catalog
from ..workdir import materialized

# The columns of the movie table, in order.
ABT_COLUMNS = [
    "imdb_id", "imdb_id_numeric", "tmdb_id", "movieId",
    "title", "original_title", "release_date", "release_year", "original_language",
    "genres_tmdb", "budget_usd", "revenue_usd", "runtime_minutes", "status",
    "popularity_tmdb", "vote_average_tmdb", "vote_count_tmdb",
    "imdb_average_rating", "imdb_num_votes",
    "rt_movie_title", "rt_original_release_date",
    "rt_tomatometer_rating", "rt_audience_rating",
    "rt_audience_status", "rt_audience_count",
    "rt_match_score", "rt_match_method",
    "nf_available", "nf_title", "nf_release_year", "nf_type",
    "nf_show_id", "nf_date_added", "nf_match_score", "nf_match_method",
    "rev_count", "rev_pos_share", "rev_avg_len",
    "main_cast_names", "main_cast_characters",
    "director_names", "writer_names", "producer_names",
]

# Columns of the critic site and of the catalogue, as they stand above.
CRITIC_COLUMNS = [
    "rt_movie_title", "rt_original_release_date", "rt_tomatometer_rating",
    "rt_audience_rating", "rt_audience_status", "rt_audience_count",
]
CATALOGUE_COLUMNS = ["nf_title", "nf_release_year", "nf_type", "nf_show_id", "nf_date_added"]


@dataclass
class AbtSources:
    """The seven raw tables, all columns string."""

    links: DataFrame
    movies: DataFrame
    ratings: DataFrame
    credits: DataFrame
    critic: DataFrame
    catalogue: DataFrame
    reviews: DataFrame

    @classmethod
    def from_catalog(cls, catalog: Catalog) -> AbtSources:
        return cls(
            links=catalog.table("links"),
            movies=catalog.table("movies_metadata"),
            ratings=catalog.table("imdb_ratings"),
            credits=catalog.table("credits"),
            critic=catalog.table("rotten_tomatoes_movies"),
            catalogue=catalog.table("netflix"),
            reviews=catalog.table("imdb_reviews"),
        )


def clean_links(links: DataFrame) -> DataFrame:
    """One row per ``imdb_id``; of several, the one with the lowest ``movieId``."""
    typed = links.select(
        lenient_int(F.col("movieId")).alias("movieId"),
        lenient_int(F.col("tmdbId")).alias("tmdb_id"),
        F.col("imdbId").cast("string").alias("imdb_id_numeric"),
        imdb_id(F.col("imdbId")).alias("imdb_id"),
    )
    order = [F.asc_nulls_last(c) for c in ("movieId", "tmdb_id", "imdb_id_numeric")]
    return keep_one(typed, "imdb_id", order)


def clean_movies(movies: DataFrame) -> DataFrame:
    released = parse_date(F.col("release_date"))
    return movies.select(
        F.col("imdb_id").alias("imdb_id_movies"),
        digits_only_int(F.col("id")).alias("id_int"),
        "title",
        "original_title",
        released.alias("release_date"),
        F.year(released).alias("release_year"),
        "original_language",
        json_names(F.col("genres")).alias("genres_tmdb"),
        lenient_long(F.col("budget")).alias("budget_usd"),
        lenient_long(F.col("revenue")).alias("revenue_usd"),
        lenient_double(F.col("runtime")).alias("runtime_minutes"),
        "status",
        lenient_double(F.col("popularity")).alias("popularity_tmdb"),
        lenient_double(F.col("vote_average")).alias("vote_average_tmdb"),
        lenient_int(F.col("vote_count")).alias("vote_count_tmdb"),
    )


def clean_ratings(ratings: DataFrame) -> DataFrame:
    return ratings.select(
        F.col("tconst").alias("imdb_id"),
        lenient_double(F.col("averageRating")).alias("imdb_average_rating"),
        lenient_int(F.col("numVotes")).alias("imdb_num_votes"),
    )


def clean_critic(critic: DataFrame) -> DataFrame:
    released = parse_date(F.col("original_release_date"))
    return critic.where(F.col("movie_title").isNotNull()).select(
        F.col("movie_title").alias("rt_movie_title"),
        released.alias("rt_original_release_date"),
        F.year(released).alias("rt_year"),
        lenient_int(F.col("tomatometer_rating")).alias("rt_tomatometer_rating"),
        lenient_int(F.col("audience_rating")).alias("rt_audience_rating"),
        F.col("audience_status").alias("rt_audience_status"),
        lenient_int(F.col("audience_count")).alias("rt_audience_count"),
    )


def clean_catalogue(catalogue: DataFrame) -> DataFrame:
    return catalogue.where(F.col("title").isNotNull()).select(
        F.col("title").alias("nf_title"),
        lenient_int(F.col("release_year")).alias("nf_release_year"),
        F.col("type").alias("nf_type"),
        F.col("show_id").alias("nf_show_id"),
        parse_month_date(F.col("date_added")).alias("nf_date_added"),
    )


def _parsed_credits(texts: DataFrame, mode: str) -> DataFrame:
    return parse_credits(texts, mode=mode).select(
        "tmdb_id", "main_cast_names", "main_cast_characters",
        "director_names", "writer_names", "producer_names",
        F.size("main_cast_names").alias("cast_count"),
        (F.size("main_cast_names") > 0).alias("has_cast"),
        (F.size("director_names") > 0).alias("has_director"),
        (F.size("writer_names") > 0).alias("has_writer"),
        (F.size("producer_names") > 0).alias("has_producer"),
        "extract_method",
    )


def clean_credits(credits: DataFrame, mode: str = "auto", *, joined_by_id: bool = False) -> DataFrame:
    """Parsed credits, one row per ``tmdb_id``: of several, the one with most actors.

    The ids are counted first, so that only rows of repeated ids are shuffled. ``joined_by_id``
    states that a join on ``tmdb_id`` follows: it shuffles all rows anyway, so they are
    compared there and ``credits`` is read once.
    """
    texts = credits.select(lenient_int(F.col("id")).alias("tmdb_id"), "cast", "crew")

    def kept(rows: DataFrame) -> DataFrame:
        parsed = _parsed_credits(rows, mode)
        order = [F.desc("cast_count")] + [
            F.col(c) for c in parsed.columns if c.endswith(("_names", "_characters", "_method"))
        ]
        return keep_one(parsed, "tmdb_id", order)

    if joined_by_id:
        return kept(texts)
    alone, repeated = repeated_apart(texts, "tmdb_id")
    return _parsed_credits(alone, mode).unionByName(kept(repeated))


def base_table(links: DataFrame, movies: DataFrame, work_dir: str | None = None) -> DataFrame:
    """Links with metadata, matched by either id. A link that matches twice gives two rows.

    The join reads both sides several times, so each is cleaned and written once.
    """
    links = materialized(links, "abt-links", work_dir)
    movies = materialized(movies, "abt-movies", work_dir)
    joined = or_join(links, movies, ("imdb_id", "imdb_id_movies"), ("tmdb_id", "id_int"))
    return joined.drop("imdb_id_movies", "id_int")


def match_critic(base: DataFrame, critic: DataFrame, **options) -> DataFrame:
    return fuzzy_match(
        base.where(F.col("imdb_id").isNotNull()),
        critic,
        left_id="imdb_id", left_title="title", left_year="release_year",
        right_title="rt_movie_title", right_year="rt_year",
        right_columns=CRITIC_COLUMNS,
        tie_break=["rt_movie_title", "rt_original_release_date"],
        score_name="rt_match_score", method_name="rt_match_method",
        **options,
    )


def match_catalogue(base: DataFrame, catalogue: DataFrame, **options) -> DataFrame:
    best = fuzzy_match(
        base.where(F.col("imdb_id").isNotNull()),
        catalogue,
        left_id="imdb_id", left_title="title", left_year="release_year",
        right_title="nf_title", right_year="nf_release_year",
        right_columns=CATALOGUE_COLUMNS,
        tie_break=["nf_title", "nf_date_added", "nf_show_id"],
        score_name="nf_match_score", method_name="nf_match_method",
        **options,
    )
    return best.withColumn("nf_available", F.lit(True))


def build_abt(
    sources: AbtSources,
    *,
    blank_matches: bool = False,
    threshold: float = THRESHOLD,
    credits_mode: str = "auto",
    one_row_per_id: bool = False,
    work_dir: str | None = None,
) -> DataFrame:
    """The movie table, one row per link and metadata row, with ABT_COLUMNS.

    The joined base is read three times, so it is written once to the shared folder
    (or ``work_dir``) and read back pruned.
    """
    base = base_table(clean_links(sources.links), clean_movies(sources.movies), work_dir)
    if one_row_per_id:
        base = keep_one(base, "imdb_id", ["movieId", "title", "release_date", "tmdb_id"])
    base = materialized(base, "abt-base", work_dir)
    options = {"threshold": threshold, "blank_matches": blank_matches, "work_dir": work_dir}
    by_movie = [
        clean_ratings(sources.ratings),
        match_critic(base, clean_critic(sources.critic), **options),
        match_catalogue(base, clean_catalogue(sources.catalogue), **options),
        review_aggregates(sources.reviews),
    ]
    # Unless a movie has very many rows, these joins share one partitioning of the base.
    hot = hot_keys_if_any(base, ["imdb_id"])
    spread = ["title", "movieId", "release_date", "popularity_tmdb"]
    abt = base
    for table in by_movie:
        abt = salted_join(abt, table, ["imdb_id"], hot, spread_left=spread, how="left")
    abt = salted_join(
        abt,
        clean_credits(sources.credits, credits_mode, joined_by_id=True),
        ["tmdb_id"],
        hot_keys_if_any(base, ["tmdb_id"]),
        spread_left=["imdb_id", *spread],
        how="left",
    )
    abt = abt.withColumn("nf_available", F.coalesce("nf_available", F.lit(False)))
    return abt.select(*ABT_COLUMNS)
