from datetime import date

import pytest

from ratingscope.plans import ABT_COLUMNS, AbtSources, build_abt
from ratingscope.plans.abt import clean_catalogue, clean_critic, clean_links, clean_movies
from ratingscope.sources import Catalog

FILES = {
    "links": "movieId,imdbId,tmdbId\n1,0114709,862\n2,0113497,8844.0\n3,10872600,634649\n4,,15602\n5,,11862\n"
    "9,0114709,999\n6,0000006,\n",
    "movies_metadata": (
        "id,imdb_id,title,original_title,release_date,original_language,genres,budget,revenue,runtime,status,"
        "popularity,vote_average,vote_count\n"
        '862,tt0114709,"Toy\n""Story""",Toy Story,1995-10-30,en,"[{\'id\': 16, \'name\': \'Animation\'}, '
        "{'id': 35, 'name': 'Comedy'}]\",30000000,373554033.0,81.0,Released,21.9,7.7,5415.0\n"
        "8844,,Jumanji,Jumanji,12/15/1995,en,[],65000000,x,104,Released,17.0,6.9,2413\n"
        "1997-08-20,tt10872600,No Way Home,NWH,2021/12/15,en,broken,,,,,,,\n"
        "15602,tt0000000,Grumpy,Grumpy,,en,,0,0,101,Released,11.7,6.5,92\n"
    ),
    "imdb_ratings": "tconst\taverageRating\tnumVotes\ntt0114709\t8.3\t900000\ntt0113497\tbad\t1.0\n",
    "rotten_tomatoes_movies": (
        "movie_title,audience_status,audience_count,tomatometer_rating,audience_rating,original_release_date\n"
        "Toy Story,Upright,100,100,92.0,1995-11-22\nToy Story,Spilled,5,1,2,1998-11-22\n"
        "Jumanji!,Upright,7,52,63,1996-01-02\n,Upright,1,1,1,1995-01-01\n"
    ),
    "netflix": (
        "show_id,type,title,release_year,date_added\n"
        's1,Movie,No Way Home,2021,"September 9, 2021"\ns2,Movie,no way home,2021,9/9/2021\n'
        's3,TV Show,Jumanji,1995," August 1, 2020"\n'
    ),
    "credits": (
        "cast,crew,id\n"
        "\"[{'character': 'Woody', 'name': 'Tom Hanks', 'order': 0}]\","
        "\"[{'job': 'Director', 'name': 'John Lasseter'}]\",862\n"
        "[],[],8844\n[],[],862\n"
    ),
    "imdb_reviews": "review,sentiment\nfine,positive\n",
}


@pytest.fixture(scope="module")
def catalog(spark, tmp_path_factory):
    base = tmp_path_factory.mktemp("movies")
    found = Catalog(spark, str(base))
    for name, text in FILES.items():
        path = base / found.path(name)
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text(text)
    return found


@pytest.fixture(scope="module")
def movies(catalog):
    abt = build_abt(AbtSources.from_catalog(catalog))
    assert abt.columns == ABT_COLUMNS and len(ABT_COLUMNS) == 43
    return [r.asDict() for r in abt.collect()]


def one(movies, **key):
    (found,) = [m for m in movies if all(m[k] == v for k, v in key.items())]
    return found


def test_links_fold_to_one_row_per_id(catalog):
    rows = {r.imdb_id: (r.movieId, r.tmdb_id) for r in clean_links(catalog.table("links")).collect()}
    assert rows == {
        "tt0114709": (1, 862), "tt0113497": (2, 8844), "tt10872600": (3, 634649), None: (4, 15602), "tt0000006": (6, None)
    }


def test_every_link_has_a_row(movies):
    assert len(movies) == 5


def test_movie_with_everything(movies):
    m = one(movies, movieId=1)
    assert m["title"] == 'Toy\n"Story"' and m["genres_tmdb"] == ["Animation", "Comedy"]
    assert (m["release_date"], m["release_year"]) == (date(1995, 10, 30), 1995)
    assert (m["budget_usd"], m["revenue_usd"], m["vote_count_tmdb"]) == (30000000, 373554033, 5415)
    assert (m["imdb_average_rating"], m["imdb_num_votes"]) == (8.3, 900000)
    assert (m["rt_movie_title"], m["rt_tomatometer_rating"], m["rt_audience_rating"]) == ("Toy Story", 100, 92)
    assert m["rt_match_score"] == 1.0 and m["rt_match_method"] == "jaccard_year_v1"
    assert m["nf_available"] is False and m["nf_title"] is None
    assert m["main_cast_names"] == ["Tom Hanks"] and m["director_names"] == ["John Lasseter"]
    assert m["rev_count"] is None


def test_movie_found_by_the_second_key(movies):
    m = one(movies, movieId=2)
    assert (m["title"], m["release_year"], m["revenue_usd"]) == ("Jumanji", 1995, None)
    assert (m["imdb_average_rating"], m["imdb_num_votes"]) == (None, 1)
    assert m["rt_movie_title"] == "Jumanji!" and m["rt_match_score"] == pytest.approx(0.85 + 0.105)
    assert m["nf_available"] is True and m["nf_date_added"] is None and m["nf_match_score"] == 1.0


def test_long_id_and_tie_break(movies):
    m = one(movies, movieId=3)
    assert (m["title"], m["genres_tmdb"], m["budget_usd"]) == ("No Way Home", None, None)
    assert (m["nf_show_id"], m["nf_date_added"]) == ("s1", date(2021, 9, 9))


def test_null_id_keeps_its_row(movies):
    m = one(movies, movieId=4)
    assert m["imdb_id"] is None and m["title"] == "Grumpy" and m["rt_movie_title"] is None


def test_unmatched_link(movies):
    m = one(movies, movieId=6)
    assert m["title"] is None and m["nf_available"] is False


def test_reviews_with_id(spark, catalog):
    sources = AbtSources.from_catalog(catalog)
    sources.reviews = spark.createDataFrame([("tt0114709", "abcd", "positive")], "IMDB_ID string, Review string, sentiment string")
    rows = build_abt(sources, one_row_per_id=True).collect()
    assert {r.imdb_id: (r.rev_count, r.rev_pos_share, r.rev_avg_len) for r in rows}["tt0114709"] == (1, 1.0, 4.0)
    assert "tt10872600" in {r.imdb_id for r in rows}


def test_cleaned_types(catalog):
    types = dict(clean_movies(catalog.table("movies_metadata")).dtypes)
    assert (types["id_int"], types["budget_usd"], types["popularity_tmdb"], types["vote_count_tmdb"]) == (
        "int", "bigint", "double", "int"
    )
    assert clean_critic(catalog.table("rotten_tomatoes_movies")).count() == 3
    assert dict(clean_catalogue(catalog.table("netflix")).dtypes)["nf_date_added"] == "date"


def test_all_tables_go_to_the_work_folder(spark, catalog, tmp_path, monkeypatch):
    from ratingscope import workdir

    monkeypatch.setattr(workdir, "work_root", lambda spark: "/nowhere")
    assert build_abt(AbtSources.from_catalog(catalog), work_dir=f"{tmp_path}/w").count() > 0
    names = {p.name.rsplit("-", 1)[0] for p in (tmp_path / "w").iterdir()}
    assert {"abt-links", "abt-movies", "abt-base", "match-rows", "match-left", "match-right", "match-best"} <= names
