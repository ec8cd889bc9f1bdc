"""The driver queries as DuckDB SQL. Matching is spelled out over all pairs there."""

from __future__ import annotations

from ratingscope.functions.stopwords import ENGLISH
from ratingscope.plans.abt import ABT_COLUMNS

from .queries import CHAIN_FILES, CLASSES, CLEAR_AUDIENCE, CLEAR_CRITIC, LIST_WORDS, TAGS


def _in_list(words) -> str:
    return ", ".join("'" + w.replace("'", "''") + "'" for w in words)


def _tokens(text: str) -> str:
    return (
        "list_sort(list_filter(list_distinct(string_split(lower(trim(regexp_replace("
        f"coalesce({text}, ''), '[^a-zA-Z0-9]+', ' ', 'g'))), ' ')), lambda t: t <> ''))"
    )


def _words(text: str, stop=()) -> str:
    dropped = f" AND w NOT IN ({_in_list(stop)})" if stop else ""
    return (
        "list_filter(regexp_split_to_array(lower(regexp_replace("
        f"coalesce({text}, ''), '[^a-zA-Z0-9\\s]', '', 'g')), '\\s'), lambda w: w <> ''{dropped})"
    )


def _union(a: str, b: str) -> str:
    return f"(len({a}) + len({b}) - len(list_intersect({a}, {b})))"


def _best_match(left: str, right: str, tie: str, found: str) -> str:
    """CTEs ``scored`` and ``best``; left(id, toks, year), right(toks, year, ...)."""
    return f"""
scored AS (
  SELECT a.id, {found},
    CASE WHEN {_union('a.toks', 'b.toks')} = 0 THEN 0::DOUBLE
      ELSE len(list_intersect(a.toks, b.toks))::DOUBLE / {_union('a.toks', 'b.toks')} END * 0.85::DOUBLE
    + CASE WHEN a.year = b.year THEN 1::DOUBLE ELSE 0.7::DOUBLE END * 0.15::DOUBLE AS score
  FROM {left} a JOIN {right} b ON abs(a.year - b.year) <= 1
),
best AS (
  SELECT * FROM scored WHERE score >= 0.7::DOUBLE
  QUALIFY row_number() OVER (PARTITION BY id ORDER BY score DESC, {tie}) = 1
)"""


def _quadrant(critic: str, audience: str, high: str) -> str:
    return (
        f"CASE WHEN {critic} >= {high} THEN 'high_tomatometer_' ELSE 'low_tomatometer_' END || "
        f"CASE WHEN {audience} >= {high} THEN 'high_audience' ELSE 'low_audience' END"
    )


_PAD = "CASE WHEN length({0}) >= 7 THEN {0} ELSE lpad({0}, 7, '0') END"

_LABELS = f"labelled AS (SELECT doc_id, {_quadrant('quality', 'toxic', '1')} AS category FROM labels)"

_DATES = """dated AS (
  SELECT o_orderkey, CASE o_orderkey % 8
    WHEN 0 THEN strftime(o_orderdate, '%Y-%m-%d') WHEN 1 THEN strftime(o_orderdate, '%Y/%m/%d')
    WHEN 2 THEN strftime(o_orderdate, '%m/%d/%Y') WHEN 3 THEN strftime(o_orderdate, '%d/%m/%Y')
    WHEN 4 THEN strftime(o_orderdate, '%B %-d, %Y') WHEN 5 THEN strftime(o_orderdate, '%b %-d, %Y')
    WHEN 6 THEN strftime(o_orderdate, '%-m/%-d/%Y') ELSE 'soon' END AS raw
  FROM orders),
parsed AS (
  SELECT o_orderkey,
    coalesce(
      CASE WHEN raw ~ '\\d{4}-\\d{2}-\\d{2}' THEN try_strptime(raw, '%Y-%m-%d') END,
      CASE WHEN raw ~ '\\d{4}/\\d{2}/\\d{2}' THEN try_strptime(raw, '%Y/%m/%d') END,
      CASE WHEN raw ~ '\\d{2}/\\d{2}/\\d{4}' THEN try_strptime(raw, '%m/%d/%Y') END,
      CASE WHEN raw ~ '\\d{2}/\\d{2}/\\d{4}' THEN try_strptime(raw, '%d/%m/%Y') END)::DATE AS numeric_date,
    coalesce(
      CASE WHEN raw ~ '[A-Z].*' THEN try_strptime(raw, '%B %d, %Y') END,
      CASE WHEN raw ~ '[A-Z].*' THEN try_strptime(raw, '%b %d, %Y') END,
      CASE WHEN raw ~ '\\d{1,2}/\\d{1,2}/\\d{4}' THEN try_strptime(raw, '%m/%d/%Y') END)::DATE AS named_date
  FROM dated)"""

_REVIEWS = """SELECT user_id::VARCHAR AS imdb_id, count(*)::INTEGER AS rev_count,
  round(avg(CASE WHEN event_type = 'purchase' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END), 6) AS rev_pos_share,
  round(avg(length(props))::DOUBLE, 6) AS rev_avg_len
FROM events GROUP BY user_id"""

_RATED = """rated AS (
  SELECT c_custkey, round(c_acctbal / 100)::INTEGER AS audience, p.critic
  FROM customer JOIN (
    SELECT o_custkey, round(avg(o_totalprice) / 5000)::INTEGER AS critic FROM orders GROUP BY 1
  ) p ON o_custkey = c_custkey)"""

_OUTCOMES = """SELECT event_id, CASE WHEN event_type = 'error' THEN 'wrong_url'
  WHEN event_type IN ('view', 'signup', 'purchase') THEN 'success' ELSE 'no_reviews' END AS outcome
FROM events"""

_COUNTS = f"""counts AS (
  SELECT 'c' AS side, lang AS category, word, count(*) AS word_occurrences
  FROM (SELECT lang, unnest({_words('text')}) AS word FROM documents) GROUP BY lang, word)"""

_WORD_FREQ = f"""WITH {_LABELS},
words AS (
  SELECT CASE WHEN lang = 'en' THEN 'c' ELSE 'u' END AS side, category, unnest({_words('text', ENGLISH)}) AS word
  FROM documents JOIN labelled USING (doc_id)),
counts AS (SELECT side, category, word, count(*) AS word_occurrences FROM words GROUP BY ALL)
SELECT *, (sum(word_occurrences) OVER (PARTITION BY side, category))::BIGINT AS total_word_occurrences FROM counts"""

_PAIRED = f"""WITH rows AS (
  SELECT 'turn_' || u.turn AS category, {_words('c.text', ENGLISH)} AS cw, {_words('u.text', ENGLISH)} AS uw
  FROM conversations u JOIN conversations c ON u.conv_id = c.conv_id AND c.turn = u.turn + 1
  WHERE u.role = 'user' AND c.role = 'assistant'),
pairs AS (SELECT category, c_word, unnest(uw) AS u_word FROM (SELECT category, uw, unnest(cw) AS c_word FROM rows)),
counts AS (
  SELECT 'c' AS side, category, c_word AS word, count(*) AS word_occurrences FROM pairs GROUP BY ALL
  UNION ALL
  SELECT 'u' AS side, category, u_word AS word, count(*) AS word_occurrences FROM pairs GROUP BY ALL)
SELECT *, (sum(word_occurrences) OVER (PARTITION BY side, category))::BIGINT AS total_word_occurrences FROM counts"""


def _tfidf(rows: str, by: str) -> str:
    """Mean over the rows that hold the word, spelled out; rows(id, by, words)."""
    return f"""{rows},
tf AS (SELECT id, {by}, word, count(*) AS tf FROM (SELECT id, {by}, unnest(words) AS word FROM texts) GROUP BY ALL),
sizes AS (SELECT {by}, count(*) AS n FROM texts GROUP BY ALL),
df AS (SELECT {by}, word, count(*) AS df FROM tf GROUP BY ALL)
SELECT {by}, word, round(avg(tf * ln((n + 1)::DOUBLE / (df + 1))), 6) AS avg_tfidf
FROM tf JOIN df USING ({by}, word) JOIN sizes USING ({by}) GROUP BY {by}, word"""


_SLUG = (
    "lower(regexp_replace(replace(regexp_replace(trim({0}), '[’'']', '', 'g'), '&', 'and'), "
    "'[^\\p{{L}}\\p{{N}}]+', '_', 'g'))"
)
_URL = "'https://www.rottentomatoes.com/m/' || {0} || '/reviews'"
_PAGES = "titles AS (SELECT page_id::VARCHAR AS imdb_id, regexp_extract(html, '<title>([^<]*)</title>', 1) AS title FROM pages)"

_BATCHES = """SELECT o_custkey, o_orderkey, ((row_number() OVER (ORDER BY o_custkey, o_orderkey) - 1) // 1200 + 1)::INTEGER AS part
FROM orders"""

_JOBS = ["Director", "Writer/Producer", "Executive Producer", "Screenplay", "Editor"]


def _credits(fallback: bool, whole: int = 7, method: str = "eval") -> str:
    quote, its = ("", "") if fallback else ("''", "It''s ")
    actors = []
    for i in range(7):
        # The patterns skip the missing character, so later ones move up by one.
        j = i + 1 if fallback and i >= 4 else i
        character = "''" if not fallback and i == 4 else f"'{its}' || o_orderstatus || ' {j}'"
        actors.append(
            f"{{'ord': (o_orderkey * 7 + {i * 3}) % 11, 'name': 'Actor O{quote}{i} ' || o_orderpriority, 'played': {character}}}"
        )
    actors = actors[: 6 if fallback else whole]
    space = " " if fallback else ""

    def person(i: int, pad: str) -> str:
        return f"'{pad}{_JOBS[i][0]}' || (o_orderkey % {i + 3})"

    def people(indexes: list[int]) -> str:
        return " || '|' || ".join(person(i, space) for i in indexes)

    return f"""WITH actors AS (
  SELECT *, list_sort([{', '.join(actors)}])[1:5] AS top FROM orders)
SELECT o_orderkey::INTEGER AS tmdb_id,
  array_to_string(list_transform(top, lambda a: a.name), '|') AS main_cast_names,
  array_to_string(list_transform(top, lambda a: a.played), '|') AS main_cast_characters,
  {people([0])} AS director_names,
  {people([1, 3])} AS writer_names,
  {people([1, 2] if fallback else [2])} AS producer_names,
  5 AS cast_count, true AS has_cast, true AS has_director, true AS has_writer, true AS has_producer,
  '{"regex" if fallback else method}' AS extract_method
FROM actors"""


_CODE = _PAD.format("(p_partkey * 1013)::VARCHAR")

_PART_TITLES = f"""lefts AS (
  SELECT p_partkey AS id, p_type || ' ' || p_name || ' ' || replace(p_brand, '#', ' #') AS title,
    1950 + p_size AS year FROM part),
rights AS (
  SELECT upper(string_split(p_name, ' ')[1][1]) || string_split(p_name, ' ')[1][2:] || ' ' ||
      upper(string_split(p_name, ' ')[2][1]) || string_split(p_name, ' ')[2][2:]
      || ': the ' || p_type || ' Brand-' || ((p_partkey * 7) % 25 + 1) AS found_title,
    (1950 + p_size + p_partkey % 2)::INTEGER AS found_year, p_partkey AS found_id FROM part),
ltok AS (SELECT id, year, {_tokens('title')} AS toks FROM lefts),
rtok AS (SELECT *, found_year AS year, {_tokens('found_title')} AS toks FROM rights)"""

_TITLE_MATCH = f"""WITH {_PART_TITLES},
{_best_match('ltok', 'rtok', 'found_title, found_id', 'b.found_title, b.found_year, b.found_id')}
SELECT id AS p_partkey, found_title, found_year, found_id, round(score, 6) AS match_score,
  'jaccard_year_v1' AS match_method FROM best"""

_DOC_MATCH = f"""WITH docs AS (
  SELECT doc_id, 1900 + n_chars // 100 AS year, {_tokens('text')} AS toks FROM documents),
ltok AS (SELECT doc_id AS id, year, toks FROM docs WHERE doc_id IN (SELECT doc_id FROM labels)),
rtok AS (SELECT doc_id AS found_id, year, toks FROM docs WHERE doc_id NOT IN (SELECT doc_id FROM labels)),
{_best_match('ltok', 'rtok', 'found_id', 'b.found_id')}
SELECT id AS doc_id, found_id, round(score, 6) AS match_score, 'jaccard_year_v1' AS match_method FROM best"""


def _movie_table(critic_rating: str = "{0} % 101", audience_rating: str = "{0} % 89") -> str:
    critic = _best_match(
        "base", "ctok", "rt_movie_title, rt_original_release_date",
        "b.rt_movie_title, b.rt_original_release_date, b.rt_tomatometer_rating, b.rt_audience_rating, "
        "b.rt_audience_status, b.rt_audience_count",
    ).replace("scored", "cscored").replace("best AS", "cbest AS")
    critic = critic.replace(
        "ORDER BY score DESC, rt_movie_title, rt_original_release_date",
        "ORDER BY score DESC, rt_movie_title, rt_original_release_date, rt_tomatometer_rating, "
        "rt_audience_rating, rt_audience_status, rt_audience_count",
    )
    catalogue = _best_match(
        "base", "ntok", "nf_title, nf_date_added, nf_show_id",
        "b.nf_title, b.nf_release_year, b.nf_type, b.nf_show_id, b.nf_date_added",
    ).replace("scored", "nscored").replace("best AS", "nbest AS")
    return f"""WITH {_PART_TITLES},
movies AS (
  SELECT p.p_partkey AS k,
    CASE WHEN p.p_partkey % 5 = 0 THEN NULL ELSE (p.p_partkey + 1)::INTEGER END AS id_int,
    CASE WHEN p.p_partkey % 3 <> 0 THEN 'tt' || {_CODE} END AS imdb_id_movies,
    l.title, p_name || ',' || chr(10) || '"cut"' AS original_title,
    CASE WHEN p.p_partkey % 7 <> 0
      THEN make_date((1950 + p_size)::BIGINT, (1 + p.p_partkey % 12)::BIGINT, 13::BIGINT) END AS release_date,
    p.*
  FROM part p JOIN lefts l ON l.id = p.p_partkey),
links AS (
  SELECT 'tt' || {_CODE} AS imdb_id, (p_partkey * 1013)::VARCHAR AS imdb_id_numeric,
    (p_partkey + 1)::INTEGER AS tmdb_id, p_partkey::INTEGER AS "movieId" FROM part),
base AS (
  SELECT l.*, l.imdb_id AS id, year(release_date)::INTEGER AS year, {_tokens('title')} AS toks, m.title,
    m.original_title, m.release_date, m.p_size, m.p_type, m.p_name, m.p_brand, m.p_retailprice, m.k
  FROM links l LEFT JOIN movies m ON l.imdb_id = m.imdb_id_movies OR l.tmdb_id = m.id_int),
ratings AS (
  SELECT 'tt' || {_CODE} AS imdb_id, round(avg(l_quantity), 2) AS imdb_average_rating,
    count(*)::INTEGER AS imdb_num_votes
  FROM (SELECT l_partkey AS p_partkey, l_quantity FROM lineitem) GROUP BY p_partkey),
ctok AS (
  SELECT found_title AS rt_movie_title, make_date(found_year::BIGINT, 6::BIGINT, 1::BIGINT) AS rt_original_release_date,
    ({critic_rating.format("found_id")})::INTEGER AS rt_tomatometer_rating, ({audience_rating.format("found_id")})::INTEGER AS rt_audience_rating,
    CASE WHEN found_id % 2 = 0 THEN 'Upright' ELSE 'Spilled' END AS rt_audience_status,
    (found_id * 10)::INTEGER AS rt_audience_count, year, toks FROM rtok),
ntok AS (
  SELECT nf_title, year::INTEGER AS nf_release_year, nf_type, nf_show_id, nf_date_added, year,
    {_tokens('nf_title')} AS toks
  FROM (
    SELECT CASE WHEN p_partkey % 11 <> 0 THEN p_name || ' ' || p_type || ' brand ' || string_split(p_brand, '#')[2] END AS nf_title,
      1950 + p_size + p_partkey % 4 AS year,
      CASE WHEN p_partkey % 2 = 0 THEN 'Movie' ELSE 'TV Show' END AS nf_type, 's' || p_partkey AS nf_show_id,
      make_date(2010 + p_partkey % 9, 1 + p_partkey % 12, 1 + p_partkey % 28) AS nf_date_added
    FROM part) WHERE nf_title IS NOT NULL),
{critic},
{catalogue},
reviews AS (
  SELECT 'tt' || {_PAD.format("(user_id * 1013)::VARCHAR")} AS imdb_id, count(*)::INTEGER AS rev_count,
    round(avg(CASE WHEN event_type = 'purchase' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END), 6) AS rev_pos_share,
    round(avg(length(props))::DOUBLE, 6) AS rev_avg_len
  FROM events GROUP BY user_id),
credits AS (
  SELECT (p_partkey + 1)::INTEGER AS tmdb_id, 'M ' || p_name || '|N ' || p_brand AS main_cast_names,
    'D|C ' || p_type AS main_cast_characters, p_name AS director_names, '' AS writer_names, p_type AS producer_names
  FROM part),
wide AS (
  SELECT b.* EXCLUDE (release_date), b.release_date::VARCHAR AS release_date, b.year AS release_year,
    CASE WHEN k IS NOT NULL THEN 'en' END AS original_language, p_type AS genres_tmdb,
    k * 1000 AS budget_usd, k * 3000 AS revenue_usd, p_size::DOUBLE AS runtime_minutes,
    CASE WHEN k IS NOT NULL THEN 'Released' END AS status, round(p_retailprice, 6) AS popularity_tmdb,
    p_size / 4 AS vote_average_tmdb, p_size AS vote_count_tmdb,
    imdb_average_rating, imdb_num_votes,
    rt_movie_title, rt_original_release_date::VARCHAR AS rt_original_release_date, rt_tomatometer_rating,
    rt_audience_rating, rt_audience_status, rt_audience_count, round(c.score, 6) AS rt_match_score,
    CASE WHEN c.id IS NOT NULL THEN 'jaccard_year_v1' END AS rt_match_method,
    n.id IS NOT NULL AS nf_available, nf_title, nf_release_year, nf_type, nf_show_id,
    nf_date_added::VARCHAR AS nf_date_added, round(n.score, 6) AS nf_match_score,
    CASE WHEN n.id IS NOT NULL THEN 'jaccard_year_v1' END AS nf_match_method,
    rev_count, rev_pos_share, rev_avg_len,
    main_cast_names, main_cast_characters, director_names, writer_names, producer_names
  FROM base b LEFT JOIN ratings USING (imdb_id) LEFT JOIN cbest c ON c.id = b.imdb_id
    LEFT JOIN nbest n ON n.id = b.imdb_id LEFT JOIN reviews USING (imdb_id) LEFT JOIN credits USING (tmdb_id))
SELECT {', '.join(f'"{c}"' for c in ABT_COLUMNS)} FROM wide"""


_CLEAR = f"""clear AS (
  SELECT c_custkey, (CASE WHEN c_custkey % 17 <> 0 THEN {CLEAR_CRITIC.format('c_custkey')} END)::INTEGER AS critic,
    (CASE WHEN c_custkey % 19 <> 0 THEN {CLEAR_AUDIENCE.format('c_custkey')} END)::INTEGER AS audience FROM customer),
classed AS (
  SELECT *, {_quadrant('critic', 'audience', '60')} AS category FROM clear
  WHERE critic IS NOT NULL AND audience IS NOT NULL)"""

_CHAIN = f"""WITH abt AS ({_movie_table(CLEAR_CRITIC, CLEAR_AUDIENCE)}),
classes AS (
  SELECT DISTINCT imdb_id, {_quadrant('rt_tomatometer_rating', 'rt_audience_rating', '60')} AS category FROM abt
  WHERE rt_tomatometer_rating IS NOT NULL AND rt_audience_rating IS NOT NULL),
reviews AS (
  SELECT 'tt' || {_PAD.format("((doc_id + 1) * 1013)::VARCHAR")} AS imdb_id, CASE WHEN lang = 'en' THEN 'c' WHEN lang <> 'en' THEN 'u' END AS side, text
  FROM documents),
merged AS (SELECT category FROM reviews LEFT JOIN classes USING (imdb_id)),
words AS (SELECT side, category, unnest({_words('text', ENGLISH)}) AS word FROM reviews JOIN classes USING (imdb_id) WHERE side IS NOT NULL),
counts AS (SELECT side, category, word, count(*) AS n FROM words GROUP BY ALL),
top AS (
  SELECT * FROM counts WHERE word NOT IN ({_in_list(LIST_WORDS)})
  QUALIFY row_number() OVER (PARTITION BY side, category ORDER BY n DESC, word) <= 100),
named AS (SELECT unnest([{_in_list(CLASSES)}]) AS category),
sides AS (SELECT unnest(['c', 'u']) AS side)
SELECT 'top' AS kind, side, category, word, n FROM top
UNION ALL
SELECT 'total', side, category, NULL, coalesce(sum(n), 0)::BIGINT
FROM named JOIN sides ON true LEFT JOIN counts USING (side, category) GROUP BY side, category
UNION ALL SELECT 'report', NULL, 'files', NULL, {CHAIN_FILES + 1}
UNION ALL SELECT 'report', NULL, 'total', NULL, (SELECT count(*) FROM reviews)
UNION ALL SELECT 'report', NULL, 'matched', NULL, count(category) FROM merged
UNION ALL SELECT 'report', NULL, 'unmatched', NULL, count(*) - count(category) FROM merged"""


ORACLE: dict[str, str] = {
    "q_norm_id": f"""SELECT o_orderkey, 'tt' || {_PAD.format('raw')} AS imdb_id
FROM (SELECT o_orderkey, (o_orderkey * 997)::VARCHAR AS raw FROM orders)""",
    "q_guarded_cast": """SELECT l_orderkey, l_linenumber, l_partkey::INTEGER AS part_int,
  NULL::INTEGER AS quantity_guarded, trunc(l_quantity)::INTEGER AS quantity_int,
  trunc(l_extendedprice)::BIGINT AS price_long, round(l_extendedprice, 6) AS price_double,
  NULL::INTEGER AS flag_int FROM lineitem""",
    "q_brand_number": """SELECT p_partkey, string_split(p_brand, '#')[2]::INTEGER AS brand,
  TRY_CAST(p_name AS INTEGER) AS name_int FROM part""",
    "q_multi_date": f"""WITH {_DATES}
SELECT o_orderkey, numeric_date::VARCHAR AS numeric_date, named_date::VARCHAR AS named_date,
  year(numeric_date)::INTEGER AS numeric_year, year(named_date)::INTEGER AS named_year FROM parsed""",
    "q_json_array": "SELECT event_id, 1 AS n, (props::JSON ->> '$.k')::INTEGER AS k FROM events",
    "q_flags": f"""SELECT doc_id, len({_tokens('text')})::INTEGER AS n_tokens, len({_tokens('text')}) > 0 AS has_tokens,
  coalesce(toxic = 1, false) AS toxic, 'tokens_v1' AS method FROM documents LEFT JOIN labels USING (doc_id)""",
    "q_title_tokens": f"""SELECT doc_id, len(toks)::INTEGER AS n_tokens, array_to_string(toks, ' ') AS tokens
FROM (SELECT doc_id, {_tokens('text')} AS toks FROM documents)""",
    "q_turn_similarity": f"""WITH pairs AS (
  SELECT a.conv_id, a.turn, {_tokens('a.text')} AS x, {_tokens('b.text')} AS y,
    abs(2000 + a.turn % 3 - 2001) AS gap
  FROM conversations a JOIN conversations b ON a.conv_id = b.conv_id AND b.turn = a.turn + 1),
parts AS (
  SELECT conv_id, turn, CASE WHEN {_union('x', 'y')} = 0 THEN 0::DOUBLE
      ELSE len(list_intersect(x, y))::DOUBLE / {_union('x', 'y')} END AS j,
    CASE gap WHEN 0 THEN 1::DOUBLE WHEN 1 THEN 0.7::DOUBLE ELSE 0::DOUBLE END AS s FROM pairs)
SELECT conv_id, turn, round(j, 6) AS jaccard, s AS year_score,
  round(j * 0.85::DOUBLE + s * 0.15::DOUBLE, 6) AS score FROM parts""",
    "q_review_clean": """SELECT doc_id, regexp_replace(text, '[^a-zA-Z0-9\\s]', '', 'g') AS glued,
  regexp_replace(regexp_replace(text, '[\\[\\]'']', '', 'g'), '[^a-zA-Z0-9\\s]', ' ', 'g') AS spaced FROM documents""",
    "q_quote_escape": "SELECT event_id, replace(props, '\"', '\\\"') AS escaped FROM events",
    "q_sentiment": """SELECT event_id, CASE WHEN event_type = 'purchase' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS is_pos,
  length(props)::INTEGER AS rev_len FROM events""",
    "q_or_join": """WITH movies AS (
  SELECT CASE WHEN c_mktsegment <> 'BUILDING' THEN c_custkey * 2 END AS first_key,
    CASE WHEN c_mktsegment <> 'MACHINERY' THEN c_custkey END AS second_key, c_name FROM customer)
SELECT o_orderkey, o_custkey, first_key, second_key, c_name
FROM orders LEFT JOIN movies ON o_orderkey = first_key OR o_custkey = second_key""",
    "q_band_join": """SELECT c_custkey, c_name, s_key, s_name FROM customer
JOIN (SELECT CASE WHEN s_acctbal > 0 THEN s_suppkey * 3 END AS s_key, s_name FROM supplier)
ON abs(c_custkey - s_key) <= 1""",
    "q_title_match": _TITLE_MATCH,
    "q_best_match": _DOC_MATCH,
    "q_star_join": """SELECT o_orderkey, c_name, n_name, n_lines, sum_qty FROM orders
LEFT JOIN (SELECT l_orderkey, count(*) AS n_lines, round(sum(l_quantity), 6) AS sum_qty FROM lineitem GROUP BY 1)
  ON l_orderkey = o_orderkey
LEFT JOIN customer ON c_custkey = o_custkey LEFT JOIN nation ON n_nationkey = c_nationkey""",
    "q_pending": """SELECT o_orderkey, o_orderpriority FROM orders
WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)""",
    "q_review_agg": _REVIEWS,
    "q_optional_source": """SELECT c_custkey::VARCHAR AS imdb_id, NULL::INTEGER AS rev_count,
  NULL::DOUBLE AS rev_pos_share, NULL::DOUBLE AS rev_avg_len FROM customer""",
    "q_empty_table": "SELECT c_custkey, c_name, NULL::DOUBLE AS score FROM customer",
    "q_keep_one": """SELECT o_custkey, o_orderkey, o_totalprice FROM orders
QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey) = 1""",
    "q_quadrant": f"WITH {_RATED} SELECT {_quadrant('critic', 'audience', '60')} AS category, count(*) AS n FROM rated GROUP BY 1",
    "q_scaler_stats": f"""WITH {_RATED} SELECT round(avg(critic), 6) AS mean_critic, round(avg(audience), 6) AS mean_audience,
  round(stddev_samp(critic), 6) AS std_critic, round(stddev_samp(audience), 6) AS std_audience FROM rated""",
    "q_classify": f"WITH {_CLEAR} SELECT * FROM classed",
    "q_cluster_table": f"""WITH {_CLEAR} SELECT category, round(avg(critic), 4) AS critic_center,
  round(avg(audience), 4) AS audience_center FROM classed GROUP BY category""",
    "q_left_outer_report": f"""WITH {_LABELS},
merged AS (SELECT category FROM documents LEFT JOIN labelled USING (doc_id))
SELECT (SELECT count(*) FROM documents) AS total, count(category) AS matched,
  count(*) - count(category) AS unmatched FROM merged""",
    "q_attached_category": f"""WITH {_LABELS}
SELECT doc_id, source, length(text)::INTEGER AS n, category FROM documents LEFT JOIN labelled USING (doc_id)""",
    "q_outcomes": f"SELECT outcome, count(*) AS n FROM ({_OUTCOMES}) GROUP BY outcome",
    "q_outcome_rows": f"""SELECT *, count(*) FILTER (outcome = 'success') OVER w AS n_success,
  count(*) FILTER (outcome = 'wrong_url') OVER w AS n_wrong_url, count(*) FILTER (outcome = 'no_reviews') OVER w AS n_no_reviews
FROM ({_OUTCOMES}) WINDOW w AS (ORDER BY event_id ROWS UNBOUNDED PRECEDING)""",
    "q_word_freq": _WORD_FREQ,
    "q_word_freq_paired": _PAIRED,
    "q_stopword_anti": f"WITH {_COUNTS} SELECT * FROM counts WHERE word NOT IN ({_in_list(LIST_WORDS)})",
    "q_stopword_semi": f"WITH {_COUNTS} SELECT * FROM counts WHERE word IN ({_in_list(LIST_WORDS)})",
    "q_stopword_report": f"""WITH {_COUNTS}, marked AS (SELECT side, category, word IN ({_in_list(LIST_WORDS)}) AS hit FROM counts)
SELECT side, category, count(*) AS before, count(*) FILTER (NOT hit) AS after, count(*) FILTER (hit) AS removed
FROM marked GROUP BY GROUPING SETS ((side, category), ())""",
    "q_removed_sample": f"""WITH {_COUNTS} SELECT * FROM counts WHERE word IN ({_in_list(LIST_WORDS)})
ORDER BY side, category, word_occurrences DESC, word LIMIT 20""",
    "q_tagged_words": f"""WITH {_COUNTS} SELECT * FROM counts
WHERE word NOT IN ({_in_list(w for w, t in TAGS if t in ('ADJ', 'JJ', 'JJR', 'JJS'))})""",
    "q_top_words": f"""WITH {_COUNTS}, kept AS (SELECT * FROM counts WHERE word NOT IN ({_in_list(LIST_WORDS)}))
SELECT *, (row_number() OVER w)::INTEGER AS rank,
  round(word_occurrences / max(word_occurrences) OVER (PARTITION BY side, category), 6) AS relative_weight
FROM kept WINDOW w AS (PARTITION BY side, category ORDER BY word_occurrences DESC, word) QUALIFY rank <= 100""",
    "q_tfidf": _tfidf(f"WITH texts AS (SELECT doc_id AS id, lang, {_words('text', ENGLISH)} AS words FROM documents)", "lang"),
    "q_category_tfidf": _tfidf(
        f"""WITH {_LABELS}, texts AS (
  SELECT doc_id AS id, category, {_words("CASE WHEN lang = 'en' THEN text END", ENGLISH)} AS words
  FROM documents JOIN labelled USING (doc_id))""",
        "category",
    ),
    "q_slug": f"""WITH {_PAGES}, slugs AS (SELECT imdb_id, title, {_SLUG.format('title')} AS slug FROM titles)
SELECT imdb_id, slug, lower(replace(trim(title), ' ', '_')) AS plain, {_URL.format('slug')} AS url FROM slugs""",
    "q_route": f"""WITH {_PAGES}, tested AS (
  SELECT imdb_id, trim(title) AS title,
    regexp_matches(regexp_replace(translate(trim(title), '×·–…™', '     '), '[[:punct:]’]', ' ', 'g'),
      '^[\\p{{L}}\\p{{N}}\\s]*$') AS clean FROM titles)
SELECT title, imdb_id, clean, CASE WHEN clean THEN {_URL.format("lower(replace(title, ' ', '_'))")} END AS url FROM tested""",
    "q_urls": f"""WITH titles AS (SELECT p_name || ' & ' || p_brand AS title, lpad(p_partkey::VARCHAR, 12, '0') AS imdb_id FROM part),
slugs AS (SELECT *, {_SLUG.format('title')} AS slug FROM titles)
SELECT title, imdb_id, {_URL.format('slug')} AS url,
  ((row_number() OVER (ORDER BY imdb_id, title) - 1) // 1200 + 1)::INTEGER AS part FROM slugs""",
    "q_batches_input_order": """SELECT o_orderkey, o_custkey, ((row_number() OVER (ORDER BY o_orderkey) - 1) // 1200 + 1)::INTEGER AS part
FROM orders""",
    "q_batches": _BATCHES,
    "q_extract_class": """WITH ads AS (
  SELECT page_id, list_transform(regexp_extract_all(html, '<div class="ad">(.*?)</div>', 1, 's'),
    lambda x: trim(regexp_replace(x, '\\s+', ' ', 'g'))) AS texts FROM pages)
SELECT page_id, len(texts)::INTEGER AS n, array_to_string(texts, '|') AS text FROM ads""",
    "q_extract_inner": """WITH ads AS (
  SELECT page_id, list_transform(regexp_extract_all(html, '<div class="ad">(.*?)</div>', 1, 's'),
    lambda x: trim(regexp_replace(x, '\\s+', ' ', 'g'))) AS found FROM pages),
kept AS (SELECT page_id, CASE WHEN page_id % 3 = 0 THEN [] ELSE found END AS texts FROM ads)
SELECT page_id, len(texts)::INTEGER AS n, array_to_string(texts, '|') AS text FROM kept""",
    "q_credits": _credits(fallback=False),
    "q_credits_fallback": _credits(fallback=True),
    "q_credits_recovered": _credits(fallback=False, whole=6, method="objects"),
    "q_roundtrip_csv": r"""SELECT c_custkey, c_name, 'Say "' || c_name || '", then \ or \"go\"' AS quoted,
  round(c_acctbal, 6) AS c_acctbal, c_mktsegment FROM customer""",
    "q_roundtrip_tsv": "SELECT event_id, event_type, props FROM events",
    "q_roundtrip_parquet": "SELECT p_partkey, p_name, p_size FROM part",
    "q_roundtrip_multiline": "SELECT doc_id, text FROM documents",
    "q_roundtrip_one_csv": "SELECT doc_id, lang, text, 1::BIGINT AS files FROM documents",
    "q_roundtrip_words": _WORD_FREQ,
    "q_roundtrip_batches": rf"""SELECT part, count(*) AS n, max('"' || o_orderkey || '", a \ b') AS title,
  min(o_custkey) AS first_customer FROM ({_BATCHES}) GROUP BY part""",
    "q_word_list": """SELECT DISTINCT word FROM (
  SELECT lower(p_name) AS word FROM part UNION ALL SELECT lower(p_type) FROM part)""",
    "q_first_rows": "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 5",
    "q_movie_table": _movie_table(),
    "q_pipeline": _CHAIN,
}
