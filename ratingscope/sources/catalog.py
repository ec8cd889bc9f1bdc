"""Logical dataset names and how each file is read."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from .readers import read_csv

# Dataset names and their paths below the base folder.
PATHS = {
    "movies_metadata": "project/movies_dataset/movies_metadata.csv",
    "ratings": "project/movies_dataset/ratings.csv",
    "ratings_small": "project/movies_dataset/ratings_small.csv",
    "credits": "project/movies_dataset/credits.csv",
    "keywords": "project/movies_dataset/keywords.csv",
    "links": "project/movies_dataset/links.csv",
    "links_small": "project/movies_dataset/links_small.csv",
    "imdb_basics": "project/imdb_datasets/title.basics.tsv",
    "imdb_ratings": "project/imdb_datasets/title.ratings.tsv",
    "imdb_principals": "project/imdb_datasets/title.principals.tsv",
    "imdb_names": "project/imdb_datasets/name.basics.tsv",
    "imdb_akas": "project/imdb_datasets/title.akas.tsv",
    "imdb_episode": "project/imdb_datasets/title.episode.tsv",
    "imdb_crew": "project/imdb_datasets/title.crew.tsv",
    "imdb_reviews": "project/imdb_50k_reviews/IMDBDataset.csv",
    "rotten_tomatoes_movies": "project/rotten_tomatoes_reviews/rotten_tomatoes_movies.csv",
    "rotten_tomatoes_reviews": "project/rotten_tomatoes_reviews/rotten_tomatoes_critic_reviews.csv",
    "netflix": "project/netflix_movies_tv_shows/netflix_titles.csv",
}

# Files whose fields hold line breaks.
MULTILINE = {"movies_metadata", "credits", "keywords"}


class Catalog:
    """Tables by name, below one base folder.

    ``paths`` overrides single locations; ``multiline`` the set of tables read
    with embedded line breaks.
    """

    def __init__(
        self,
        spark: SparkSession,
        base: str,
        paths: Mapping[str, str] | None = None,
        multiline: set[str] | None = None,
    ):
        self.spark = spark
        self._multiline = MULTILINE if multiline is None else multiline
        root = base.rstrip("/")
        self._paths = {name: f"{root}/{path}" for name, path in PATHS.items()}
        self._paths.update(paths or {})

    def names(self) -> list[str]:
        return list(self._paths)

    def path(self, name: str) -> str:
        if name not in self._paths:
            raise KeyError(f"unknown dataset {name!r}; known: {', '.join(self._paths)}")
        return self._paths[name]

    def table(self, name: str) -> DataFrame:
        path = self.path(name)
        sep = "\t" if path.endswith(".tsv") else ","
        broken = name in self._multiline
        return read_csv(self.spark, path, sep=sep, multiline=broken, parallel=broken)

    def register(self, *names: str) -> None:
        """Temporary views for the named tables, or for all of them."""
        for name in names or self.names():
            self.table(name).createOrReplaceTempView(name)
