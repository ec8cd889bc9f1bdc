"""Operators on the driver's tables. No movie data there, so columns stand in for it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ratingscope import functions as rf
from ratingscope import operators as op
from ratingscope.plans import (
    AbtSources,
    attach_category,
    build_abt,
    category_words,
    clean_word_table,
    review_urls,
    route_titles,
    word_weights,
)
from ratingscope.sources import (
    Catalog,
    empty,
    read_csv,
    read_parquet,
    read_word_list,
    require_columns,
    small_table,
    write_batches,
    write_csv,
    write_one_csv,
    write_parquet,
    write_quoted_csv,
    write_word_counts,
)
from ratingscope.workdir import new_path

LIST_WORDS = [
    "the", "and", "of", "to", "in", "la", "de", "les", "der", "die", "que", "un",
    "is", "that", "con", "para", "und", "von",
]
CHAIN_FILES = 8
ONE_CSV_PARTS = 5
TAGS = [("the", "DT"), ("and", "CC"), ("un", "JJ"), ("la", "JJR"), ("die", "ADJ"), ("is", "VBZ"), ("of", "JJS")]


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def dealt(df: DataFrame, key: str) -> DataFrame:
    """Narrow columns dealt out by a key: the file of a small table is a single task.

    The number is given, as rows this short would else be put together again in few tasks.
    """
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), key)


def r6(c: Column) -> Column:
    return F.round(c, 6)


# -- scalar functions ---------------------------------------------------------


def norm_id(spark, sf):
    raw = (F.col("o_orderkey") * 997).cast("string")
    return table(spark, sf, "orders").select(
        "o_orderkey", rf.imdb_id(raw).alias("imdb_id")
    )


def guarded_cast(spark, sf):
    quantity = F.col("l_quantity").cast("string")
    price = F.col("l_extendedprice").cast("string")
    return table(spark, sf, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        rf.digits_only_int(F.col("l_partkey").cast("string")).alias("part_int"),
        rf.digits_only_int(quantity).alias("quantity_guarded"),
        rf.lenient_int(quantity).alias("quantity_int"),
        rf.lenient_long(price).alias("price_long"),
        r6(rf.lenient_double(price)).alias("price_double"),
        rf.lenient_int(F.col("l_returnflag")).alias("flag_int"),
    )


def brand_number(spark, sf):
    return table(spark, sf, "part").select(
        "p_partkey",
        rf.digits_only_int(F.element_at(F.split("p_brand", "#"), 2)).alias("brand"),
        rf.digits_only_int(F.col("p_name")).alias("name_int"),
    )


_DATE_TEXTS = [
    "yyyy-MM-dd", "yyyy/MM/dd", "MM/dd/yyyy", "dd/MM/yyyy", "MMMM d, yyyy", "MMM d, yyyy", "M/d/yyyy",
]


def _date_text() -> Column:
    kind = F.col("o_orderkey") % 8
    text = F.lit("soon")
    for i, pattern in enumerate(_DATE_TEXTS):
        text = F.when(kind == i, F.date_format("o_orderdate", pattern)).otherwise(text)
    return text


def multi_date(spark, sf):
    dated = table(spark, sf, "orders").select("o_orderkey", _date_text().alias("raw"))
    numeric, named = rf.parse_date(F.col("raw")), rf.parse_month_date(F.col("raw"))
    return dated.select(
        "o_orderkey",
        numeric.cast("string").alias("numeric_date"),
        named.cast("string").alias("named_date"),
        F.year(numeric).alias("numeric_year"),
        F.year(named).alias("named_year"),
    )


def json_array(spark, sf):
    values = rf.json_names(F.concat(F.lit("["), F.col("props"), F.lit("]")), "k", "int")
    return table(spark, sf, "events").select(
        "event_id", F.size(values).alias("n"), F.element_at(values, 1).alias("k")
    )


def flags(spark, sf):
    tokens = rf.title_tokens(F.col("text"))
    labels = table(spark, sf, "labels").select("doc_id", (F.col("toxic") == 1).alias("is_toxic"))
    docs = table(spark, sf, "documents").select(
        "doc_id", F.size(tokens).alias("n_tokens"), (F.size(tokens) > 0).alias("has_tokens"), "text"
    )
    return docs.join(labels, "doc_id", "left").select(
        "doc_id",
        "n_tokens",
        "has_tokens",
        F.coalesce("is_toxic", F.lit(False)).alias("toxic"),
        F.lit("tokens_v1").alias("method"),
    )


def title_tokens(spark, sf):
    tokens = F.array_sort(rf.title_tokens(F.col("text")))
    return table(spark, sf, "documents").select(
        "doc_id", F.size(tokens).alias("n_tokens"), F.array_join(tokens, " ").alias("tokens")
    )


def turn_similarity(spark, sf):
    turns = table(spark, sf, "conversations")
    reply = turns.select(
        "conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("reply"), F.lit(2001).alias("ryear")
    )
    pairs = turns.join(reply, ["conv_id", "turn"])
    j = rf.jaccard(rf.title_tokens(F.col("text")), rf.title_tokens(F.col("reply")))
    y = rf.year_score(F.lit(2000) + F.col("turn") % 3, F.col("ryear"))
    return pairs.select(
        "conv_id", "turn", r6(j).alias("jaccard"), y.alias("year_score"), r6(rf.match_score(j, y)).alias("score")
    )


def review_clean(spark, sf):
    return table(spark, sf, "documents").select(
        "doc_id",
        rf.clean_review(F.col("text")).alias("glued"),
        rf.clean_review(F.col("text"), glue=False).alias("spaced"),
    )


def quote_escape(spark, sf):
    return table(spark, sf, "events").select("event_id", rf.escape_quotes(F.col("props")).alias("escaped"))


def sentiment(spark, sf):
    return table(spark, sf, "events").select(
        "event_id",
        rf.is_positive(F.when(F.col("event_type") == "purchase", "POSITIVE").otherwise(F.col("event_type"))).alias("is_pos"),
        F.length("props").alias("rev_len"),
    )


# -- joins and matching -------------------------------------------------------


def or_join(spark, sf):
    links = table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    movies = table(spark, sf, "customer").select(
        F.when(F.col("c_mktsegment") != "BUILDING", F.col("c_custkey") * 2).alias("first_key"),
        F.when(F.col("c_mktsegment") != "MACHINERY", F.col("c_custkey")).alias("second_key"),
        "c_name",
    )
    return op.or_join(links, movies, ("o_orderkey", "first_key"), ("o_custkey", "second_key"))


def band_join(spark, sf):
    left = table(spark, sf, "customer").select("c_custkey", "c_name")
    right = table(spark, sf, "supplier").select(
        F.when(F.col("s_acctbal") > 0, F.col("s_suppkey") * 3).alias("s_key"), "s_name"
    )
    return op.band_join(left, right, "c_custkey", "s_key")


def _part_titles(spark, sf):
    part = table(spark, sf, "part")
    year = F.lit(1950) + F.col("p_size")
    left = part.select(
        "p_partkey",
        F.concat_ws(" ", "p_type", "p_name", F.replace("p_brand", F.lit("#"), F.lit(" #"))).alias("title"),
        year.alias("year"),
    )
    # Brand numbers and years shifted: exact, near and no matches come out.
    right = part.select(
        F.concat(
            F.initcap("p_name"), F.lit(": the "), F.col("p_type"), F.lit(" Brand-"),
            ((F.col("p_partkey") * 7) % 25 + 1).cast("string"),
        ).alias("found_title"),
        (year + F.col("p_partkey") % 2).cast("int").alias("found_year"),
        F.col("p_partkey").alias("found_id"),
    )
    return left, right


def title_match(spark, sf):
    left, right = _part_titles(spark, sf)
    best = op.fuzzy_match(
        left, right,
        left_id="p_partkey", left_title="title", left_year="year",
        right_title="found_title", right_year="found_year",
        right_columns=["found_title", "found_year", "found_id"],
        tie_break=["found_title", "found_id"],
    )
    return best.withColumn("match_score", r6(F.col("match_score")))


def best_match(spark, sf):
    docs = table(spark, sf, "documents").select(
        "doc_id", "text", (F.lit(1900) + F.floor(F.col("n_chars") / 100)).cast("int").alias("year")
    )
    labels = table(spark, sf, "labels").select("doc_id")
    known = docs.join(labels, "doc_id", "left_semi")
    other = docs.join(labels, "doc_id", "left_anti").select(
        F.col("doc_id").alias("found_id"), F.col("text").alias("found_text"), F.col("year").alias("found_year")
    )
    best = op.fuzzy_match(
        known, other,
        left_id="doc_id", left_title="text", left_year="year",
        right_title="found_text", right_year="found_year",
        right_columns=["found_id"], tie_break=["found_id"],
    )
    return best.withColumn("match_score", r6(F.col("match_score")))


def star_join(spark, sf):
    nation = table(spark, sf, "nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
    customer = table(spark, sf, "customer").select(
        F.col("c_custkey").alias("o_custkey"), "c_name", "c_nationkey"
    )
    lines = (
        table(spark, sf, "lineitem")
        .groupBy(F.col("l_orderkey").alias("o_orderkey"))
        .agg(F.count(F.lit(1)).alias("n_lines"), r6(F.sum("l_quantity")).alias("sum_qty"))
    )
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    hot = op.hot_keys(orders, ["o_custkey"])
    return (
        op.salted_join(
            orders.join(lines, "o_orderkey", "left"), customer, ["o_custkey"], hot,
            spread_left=["o_orderkey"], how="left",
        )
        .join(nation, "c_nationkey", "left")
        .select("o_orderkey", "c_name", "n_name", "n_lines", "sum_qty")
    )


def pending(spark, sf):
    todo = table(spark, sf, "orders").select("o_orderkey", "o_orderpriority")
    done = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"))
    return op.pending(todo, done, "o_orderkey")


# -- aggregates ---------------------------------------------------------------


def _reviews(spark, sf):
    return table(spark, sf, "events").select(
        F.col("user_id").cast("string").alias("IMDB_ID"),
        F.col("props").alias("Review"),
        F.when(F.col("event_type") == "purchase", "Positive").otherwise("negative").alias("sentiment"),
    )


def _rounded_reviews(df):
    return df.withColumns({c: r6(F.col(c)) for c in ("rev_pos_share", "rev_avg_len")})


def review_agg(spark, sf):
    return _rounded_reviews(op.review_aggregates(_reviews(spark, sf)))


def optional_source(spark, sf):
    users = table(spark, sf, "customer").select(F.col("c_custkey").cast("string").alias("imdb_id"))
    without_id = _reviews(spark, sf).select("Review", "sentiment")
    return users.join(op.review_aggregates(without_id), "imdb_id", "left")


def keep_one(spark, sf):
    orders = table(spark, sf, "orders").select("o_custkey", "o_orderkey", "o_totalprice", "o_orderdate")
    return op.keep_one(orders, "o_custkey", [F.desc("o_orderdate"), "o_orderkey"]).drop("o_orderdate")


# Ratings in four well separated groups of a key, the same text in both dialects.
CLEAR_CRITIC = "CASE {0} % 4 WHEN 0 THEN 90 WHEN 1 THEN 85 WHEN 2 THEN 18 ELSE 12 END + {0} % 3"
CLEAR_AUDIENCE = "CASE {0} % 4 WHEN 0 THEN 88 WHEN 1 THEN 20 WHEN 2 THEN 82 ELSE 15 END + {0} % 5"
CLASSES = [
    "high_tomatometer_high_audience", "high_tomatometer_low_audience",
    "low_tomatometer_high_audience", "low_tomatometer_low_audience",
]


def _clear_ratings(spark, sf):
    key = "c_custkey"
    return table(spark, sf, "customer").select(
        key,
        F.expr(f"CASE WHEN {key} % 17 <> 0 THEN {CLEAR_CRITIC.format(key)} END").cast("int").alias("critic"),
        F.expr(f"CASE WHEN {key} % 19 <> 0 THEN {CLEAR_AUDIENCE.format(key)} END").cast("int").alias("audience"),
    )


def _customer_ratings(spark, sf):
    prices = table(spark, sf, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        F.round(F.avg("o_totalprice") / 5000).cast("int").alias("critic")
    )
    audience = F.round(F.col("c_acctbal") / 100).cast("int").alias("audience")
    return table(spark, sf, "customer").select("c_custkey", audience).join(prices, "c_custkey", "left")


def quadrant(spark, sf):
    rated = _customer_ratings(spark, sf).where(F.col("critic").isNotNull() & F.col("audience").isNotNull())
    named = rated.withColumn("category", op.rating_quadrant(F.col("critic"), F.col("audience")))
    return named.groupBy("category").agg(F.count(F.lit(1)).alias("n"))


def scaler_stats(spark, sf):
    stats = op.feature_stats(_customer_ratings(spark, sf).dropna(), ["critic", "audience"])
    return stats.select(*[r6(F.col(c)).alias(c) for c in stats.columns])


def classify(spark, sf):
    return op.classify_ratings(_clear_ratings(spark, sf), "critic", "audience")


def cluster_table(spark, sf):
    clusters = op.classify_with_clusters(_clear_ratings(spark, sf), "critic", "audience")[1]
    return clusters.select("category", *[F.round(c, 4).alias(c) for c in ("critic_center", "audience_center")])


def left_outer_report(spark, sf):
    return _merged(spark, sf)[1]


def _merged(spark, sf):
    reviews = table(spark, sf, "documents").select("doc_id", "source", "text")
    categories = table(spark, sf, "labels").select(
        "doc_id", op.rating_quadrant(F.col("quality"), F.col("toxic"), 1).alias("category")
    )
    return attach_category(reviews, categories, key="doc_id", required=("source", "text"))


def attached_category(spark, sf):
    return _merged(spark, sf)[0].select("doc_id", "source", F.length("text").alias("n"), "category")


def outcomes(spark, sf):
    return op.fetch_totals(_outcome_rows(spark, sf))


def _outcome_rows(spark, sf):
    kind = F.col("event_type")
    none = F.array().cast("array<string>")
    log = table(spark, sf, "events").select(
        "event_id",
        F.when(kind == "error", F.col("props")).alias("error"),
        F.when(kind.isin("view", "signup"), F.array("props")).otherwise(none).alias("reviews_c"),
        F.when(kind == "purchase", F.array("props", "event_type")).alias("reviews_u"),
    )
    return op.fetch_outcomes(log)


def outcome_rows(spark, sf):
    """Each fetch with the three counters of the log up to it."""
    return op.running_totals(_outcome_rows(spark, sf).select("event_id", "outcome"), ["event_id"])


# -- words --------------------------------------------------------------------


def _labelled_texts(spark, sf):
    english = F.col("lang") == "en"
    reviews = table(spark, sf, "documents").select(
        F.col("doc_id").cast("string").alias("imdb_id"),
        F.when(english, F.col("text")).alias("reviews_c"),
        F.when(~english, F.col("text")).alias("reviews_u"),
    )
    clusters = table(spark, sf, "labels").select(
        F.col("doc_id").cast("string").alias("imdb_id"),
        op.rating_quadrant(F.col("quality"), F.col("toxic"), 1).alias("category"),
    )
    return reviews, clusters


def word_freq(spark, sf):
    return category_words(*_labelled_texts(spark, sf))


def word_freq_paired(spark, sf):
    turns = table(spark, sf, "conversations")
    asked = turns.where(F.col("role") == "user").select(
        "conv_id", "turn", F.col("text").alias("reviews_u"), F.concat(F.lit("turn_"), "turn").alias("category")
    )
    answered = turns.where(F.col("role") == "assistant").select(
        "conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("reviews_c")
    )
    return op.word_frequency(asked.join(answered, ["conv_id", "turn"]), mode="paired")


def _counts(spark, sf):
    return op.count_words(
        table(spark, sf, "documents").select(
            F.col("lang").alias("category"), F.col("text").alias("reviews_c"), F.lit(None).cast("string").alias("reviews_u")
        ),
        stop_words=[],
    )


def _list(spark):
    return small_table(spark, [(w,) for w in LIST_WORDS], "word string")


def stopword_anti(spark, sf):
    return clean_word_table(_counts(spark, sf), _list(spark))[0]


def stopword_semi(spark, sf):
    return op.removed_words(_counts(spark, sf), _list(spark))


def stopword_report(spark, sf):
    return clean_word_table(_counts(spark, sf), _list(spark))[1]


def removed_sample(spark, sf):
    return op.removed_sample(_counts(spark, sf), _list(spark))


def tagged_words(spark, sf):
    tags = small_table(spark, TAGS, "word string, tag string")
    return op.drop_tagged_words(_counts(spark, sf), tags)


def top_words(spark, sf):
    best = clean_word_table(_counts(spark, sf), _list(spark))[2]
    return best.withColumn("relative_weight", r6(F.col("relative_weight")))


def tfidf(spark, sf):
    weights = op.avg_tfidf(table(spark, sf, "documents"), "text", ["lang"])
    return weights.withColumn("avg_tfidf", r6(F.col("avg_tfidf")))


def category_tfidf(spark, sf):
    weights = word_weights(*_labelled_texts(spark, sf), text="reviews_c")
    return weights.withColumn("avg_tfidf", r6(F.col("avg_tfidf")))


# -- urls, batches, pages, credits --------------------------------------------


def _page_titles(spark, sf):
    return table(spark, sf, "pages").select(
        F.col("page_id").cast("string").alias("imdb_id"),
        F.regexp_extract("html", "<title>([^<]*)</title>", 1).alias("title"),
    )


def slug(spark, sf):
    return _page_titles(spark, sf).select(
        "imdb_id",
        rf.slug_squeezed(F.col("title")).alias("slug"),
        rf.slug_plain(F.col("title")).alias("plain"),
        rf.review_url(rf.slug_squeezed(F.col("title"))).alias("url"),
    )


def route(spark, sf):
    return route_titles(_page_titles(spark, sf))


def urls(spark, sf):
    titles = table(spark, sf, "part").select(
        F.concat_ws(" & ", "p_name", "p_brand").alias("title"),
        F.lpad(F.col("p_partkey").cast("string"), 12, "0").alias("imdb_id"),
    )
    return review_urls(titles)


def batches_input_order(spark, sf):
    """Batches of a file's rows as they stand in it."""
    numbered = op.input_order_batches(spark, f"{sf}/orders.parquet")
    return numbered.select("o_orderkey", "o_custkey", "part")


def batches(spark, sf):
    orders = table(spark, sf, "orders").select("o_custkey", "o_orderkey")
    return op.assign_batches(orders, ["o_custkey", "o_orderkey"])


def extract_class(spark, sf):
    texts = op.extract_class_text(F.col("html"), "ad")
    return table(spark, sf, "pages").select("page_id", texts.alias("texts")).select(
        "page_id", F.size("texts").alias("n"), F.array_join("texts", "|").alias("text")
    )


def extract_inner(spark, sf):
    """The first inner element of each container; in every third page the containers lack it."""
    boxed = r'<div class="box">by me <span class="ad">$1</span><span class="ad">later</span></div>'
    bare = r'<div class="box">$1</div>'
    to_box = lambda by: F.regexp_replace("html", r'(?s)<div class="ad">(.*?)</div>', by)
    html = F.when(F.col("page_id") % 3 == 0, to_box(bare)).otherwise(to_box(boxed))
    texts = op.extract_class_text(html, "box", inner="ad")
    return table(spark, sf, "pages").select("page_id", texts.alias("texts")).select(
        "page_id", F.size("texts").alias("n"), F.array_join("texts", "|").alias("text")
    )


def _credit_texts(spark, sf):
    key = F.col("o_orderkey")
    actors = []
    for i in range(7):
        order = ((key * 7 + i * 3) % 11).cast("string")
        name = F.concat(F.lit(f"Actor O\\'{i} "), F.col("o_orderpriority"))
        character = F.lit("None") if i == 4 else F.concat(
            F.lit('"It\'s '), F.col("o_orderstatus"), F.lit(f' {i}"')
        )
        actors.append(F.concat(
            F.lit("{'cast_id': None, 'character': "), character, F.lit(", 'name': '"), name,
            F.lit("', 'order': "), order, F.lit("}"),
        ))
    cast = F.concat(F.lit("["), F.concat_ws(", ", *actors), F.lit("]"))
    jobs = ["Director", "Writer/Producer", "Executive Producer", "Screenplay", "Editor"]
    crew = F.concat(
        F.lit("["),
        F.concat_ws(", ", *[
            F.concat(F.lit(f"{{'job': '{job}', 'gender': 0, 'name': ' {job[0]}"), (key % (i + 3)).cast("string"), F.lit("'}"))
            for i, job in enumerate(jobs)
        ]),
        F.lit("]"),
    )
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderpriority", "o_orderstatus")
    return dealt(orders, "o_orderkey").select(
        F.col("o_orderkey").cast("string").alias("id"), cast.alias("cast"), crew.alias("crew")
    )


def _credit_columns(df):
    lists = ["main_cast_names", "main_cast_characters", "director_names", "writer_names", "producer_names"]
    flags = ["cast_count", "has_cast", "has_director", "has_writer", "has_producer", "extract_method"]
    return df.select("tmdb_id", *[F.array_join(c, "|").alias(c) for c in lists], *flags)


def credits(spark, sf):
    from ratingscope.plans.abt import clean_credits

    return _credit_columns(clean_credits(_credit_texts(spark, sf)))


def credits_fallback(spark, sf):
    """The same text with its last character lost, so that patterns must do."""
    from ratingscope.plans.abt import clean_credits

    texts = _credit_texts(spark, sf).select(
        "id",
        F.regexp_replace(F.replace("cast", F.lit('"'), F.lit("'")), r"It's |\]$|\\'", "").alias("cast"),
        F.regexp_replace("crew", r"\]$", "").alias("crew"),
    )
    return _credit_columns(clean_credits(texts))


def credits_recovered(spark, sf):
    """Texts cut off inside their last object: all objects before it are found."""
    from ratingscope.plans.abt import clean_credits

    key = F.col("id").cast("int")
    cut = lambda c, most: F.left(c, F.length(c) - 2 - key % most).alias(c)
    return _credit_columns(clean_credits(_credit_texts(spark, sf).select("id", cut("cast", 50), cut("crew", 20)), "recover"))


# -- files --------------------------------------------------------------------


def roundtrip_csv(spark, sf):
    path = new_path(spark, "csv")
    quoted = F.concat(F.lit('Say "'), F.col("c_name"), F.lit('", then \\ or \\"go\\"'))
    write_csv(table(spark, sf, "customer").withColumn("quoted", quoted), path)
    return read_csv(spark, path).select(
        rf.lenient_long(F.col("c_custkey")).alias("c_custkey"), "c_name", "quoted",
        r6(rf.lenient_double(F.col("c_acctbal"))).alias("c_acctbal"), "c_mktsegment",
    )


def roundtrip_tsv(spark, sf):
    path = new_path(spark, "tsv")
    write_csv(table(spark, sf, "events").select("event_id", "event_type", "props"), path, sep="\t")
    df = read_csv(spark, path, sep="\t", multiline=True)
    return df.select(rf.lenient_long(F.col("event_id")).alias("event_id"), "event_type", "props")


def roundtrip_parquet(spark, sf):
    path = new_path(spark, "parquet")
    write_parquet(table(spark, sf, "part"), path)
    return read_parquet(spark, path, ["p_partkey", "p_name", "p_size"])


def roundtrip_multiline(spark, sf):
    path = new_path(spark, "multiline")
    write_quoted_csv(table(spark, sf, "documents").select("doc_id", "lang", "text"), path)
    df = read_csv(spark, path, multiline=True, parallel=True, columns=["doc_id", "text"])
    return df.select(rf.lenient_long(F.col("doc_id")).alias("doc_id"), "text")


def roundtrip_one_csv(spark, sf):
    """One file, read again."""
    path = new_path(spark, "one") + ".csv"
    docs = table(spark, sf, "documents").select("doc_id", "lang", "text")
    # Some parts to join, and more as the scan of the table has more.
    write_one_csv(docs.repartition(max(ONE_CSV_PARTS, docs.rdd.getNumPartitions())), path)
    df = read_csv(spark, path, multiline=True, parallel=True)
    files = op.listed_files(spark, path).first()["files"]
    return df.select(rf.lenient_long(F.col("doc_id")).alias("doc_id"), "lang", "text", F.lit(files).alias("files"))


def roundtrip_words(spark, sf):
    path = new_path(spark, "words")
    write_word_counts(word_freq(spark, sf), path)
    df = require_columns(read_csv(spark, path), ["side", "category", "word"])
    return df.select(
        "side", "category", "word",
        rf.lenient_long(F.col("word_occurrences")).alias("word_occurrences"),
        rf.lenient_long(F.col("total_word_occurrences")).alias("total_word_occurrences"),
    )


def roundtrip_batches(spark, sf):
    path = new_path(spark, "batches")
    title = F.concat(F.lit('"'), F.col("o_orderkey").cast("string"), F.lit('", a \\ b'))
    write_batches(batches(spark, sf).withColumn("title", title), path)
    return read_csv(spark, path).groupBy("part").agg(
        F.count(F.lit(1)).alias("n"),
        F.max("title").alias("title"),
        F.min(rf.lenient_long(F.col("o_custkey"))).alias("first_customer"),
    ).withColumn("part", F.col("part").cast("int"))


def word_list(spark, sf):
    path = new_path(spark, "list")
    words = table(spark, sf, "part").select(F.concat(F.lit(" "), F.upper("p_name"), F.lit(",, "), "p_type").alias("value"))
    words.write.text(path)
    return read_word_list(spark, path)


def first_rows(spark, sf):
    rows = table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    return op.first_rows(rows, [F.desc("o_totalprice"), "o_orderkey"])


# -- the movie table ----------------------------------------------------------


def _abt_files(spark, sf, critic: str = "{0} % 101", audience: str = "{0} % 89") -> Catalog:
    """The seven source files, made from the driver's tables; ratings as SQL of a key."""
    base = new_path(spark, "movies")
    catalog = Catalog(spark, base)
    part, key = dealt(table(spark, sf, "part"), "p_partkey"), F.col("p_partkey")
    code = (key * 1013).cast("string")
    tt = F.concat(F.lit("tt"), F.when(F.length(code) >= 7, code).otherwise(F.lpad(code, 7, "0")))
    left, right = _part_titles(spark, sf)
    right = dealt(right, "found_id")

    write_csv(
        part.select(key.alias("movieId"), code.alias("imdbId"), F.concat((key + 1).cast("string"), F.lit(".0")).alias("tmdbId")),
        catalog.path("links"),
    )
    released = F.date_format(F.make_date(F.lit(1950) + F.col("p_size"), F.lit(1) + key % 12, F.lit(13)), "MM/dd/yyyy")
    write_csv(
        part.join(op.not_broadcast(left), "p_partkey").select(
            F.when(key % 5 == 0, "1997-08-20").otherwise((key + 1).cast("string")).alias("id"),
            F.when(key % 3 != 0, tt).alias("imdb_id"),
            "title",
            F.concat(F.col("p_name"), F.lit(',\n"cut"')).alias("original_title"),
            F.when(key % 7 == 0, "unknown").otherwise(released).alias("release_date"),
            F.lit("en").alias("original_language"),
            F.concat(F.lit("[{'id': "), F.col("p_size"), F.lit(", 'name': '"), F.col("p_type"), F.lit("'}]")).alias("genres"),
            (key * 1000).alias("budget"),
            F.concat((key * 3000).cast("string"), F.lit(".0")).alias("revenue"),
            F.col("p_size").cast("double").alias("runtime"),
            F.lit("Released").alias("status"),
            F.col("p_retailprice").alias("popularity"),
            (F.col("p_size") / 4).alias("vote_average"),
            F.concat(F.col("p_size").cast("string"), F.lit(".0")).alias("vote_count"),
        ),
        catalog.path("movies_metadata"),
    )
    sold = table(spark, sf, "lineitem").groupBy(F.col("l_partkey").alias("p_partkey")).agg(
        F.count(F.lit(1)).alias("n"), F.round(F.avg("l_quantity"), 2).alias("rating")
    )
    write_csv(
        sold.select(tt.alias("tconst"), F.col("rating").alias("averageRating"), F.col("n").alias("numVotes")),
        catalog.path("imdb_ratings"), sep="\t",
    )
    write_csv(
        right.select(
            F.col("found_title").alias("movie_title"),
            F.concat(F.col("found_year"), F.lit("-06-01")).alias("original_release_date"),
            F.expr(critic.format("found_id")).alias("tomatometer_rating"),
            F.concat(F.expr(audience.format("found_id")).cast("string"), F.lit(".0")).alias("audience_rating"),
            F.when(F.col("found_id") % 2 == 0, "Upright").otherwise("Spilled").alias("audience_status"),
            (F.col("found_id") * 10).alias("audience_count"),
        ),
        catalog.path("rotten_tomatoes_movies"),
    )
    write_csv(
        part.select(
            F.concat(F.lit("s"), key.cast("string")).alias("show_id"),
            F.when(key % 2 == 0, "Movie").otherwise("TV Show").alias("type"),
            F.when(key % 11 != 0, F.concat_ws(" ", "p_name", "p_type", F.lit("brand"), F.element_at(F.split("p_brand", "#"), 2))).alias("title"),
            F.date_format(F.make_date(F.lit(2010) + key % 9, F.lit(1) + key % 12, F.lit(1) + key % 28), "MMMM d, yyyy").alias("date_added"),
            (F.lit(1950) + F.col("p_size") + key % 4).alias("release_year"),
        ),
        catalog.path("netflix"),
    )
    write_csv(
        part.select(
            (key + 1).alias("id"),
            F.concat(F.lit("[{'character': 'C "), "p_type", F.lit("', 'name': 'N "), "p_brand", F.lit("', 'order': 1}, {'character': 'D', 'name': 'M "), "p_name", F.lit("', 'order': 0}]")).alias("cast"),
            F.concat(F.lit("[{'job': 'Director', 'name': '"), "p_name", F.lit("'}, {'job': 'Producer', 'name': '"), "p_type", F.lit("'}]")).alias("crew"),
        ),
        catalog.path("credits"),
    )
    user_code = (F.col("user_id") * 1013).cast("string")
    write_csv(
        table(spark, sf, "events").select(
            F.concat(F.lit("tt"), F.when(F.length(user_code) >= 7, user_code).otherwise(F.lpad(user_code, 7, "0"))).alias("IMDB_ID"),
            F.col("props").alias("review"),
            F.when(F.col("event_type") == "purchase", "Positive").otherwise("negative").alias("Sentiment"),
        ),
        catalog.path("imdb_reviews"),
    )
    return catalog


def movie_table(spark, sf):
    """All sources from files to the 43 columns; lists as joined text, dates as text."""
    abt = build_abt(AbtSources.from_catalog(_abt_files(spark, sf)))
    lists = {f.name for f in abt.schema if f.dataType.typeName() == "array"}
    doubles = {f.name for f in abt.schema if f.dataType.typeName() == "double"}
    dates = {f.name for f in abt.schema if f.dataType.typeName() == "date"}

    def plain(c: str) -> Column:
        if c in lists:
            return F.array_join(c, "|").alias(c)
        if c in doubles:
            return r6(F.col(c)).alias(c)
        return F.col(c).cast("string").alias(c) if c in dates else F.col(c)

    return abt.select(*[plain(c) for c in abt.columns])


def chain(spark, sf):
    """The whole run, each link through its file: movie table, classes, reviews with their
    class, words per class, stop words, top words. Rows of all reports in one table."""
    folder = new_path(spark, "chain")
    write_parquet(build_abt(AbtSources.from_catalog(_abt_files(spark, sf, CLEAR_CRITIC, CLEAR_AUDIENCE))), f"{folder}/movies")
    classes = op.classify_ratings(read_parquet(spark, f"{folder}/movies")).select("imdb_id", "category").distinct()
    write_parquet(classes, f"{folder}/classes")
    classes = read_parquet(spark, f"{folder}/classes")

    code = ((F.col("doc_id") + 1) * 1013).cast("string")
    reviews = table(spark, sf, "documents").select(
        F.concat(F.lit("tt"), F.when(F.length(code) >= 7, code).otherwise(F.lpad(code, 7, "0"))).alias("imdb_id"),
        F.col("source").alias("title"),
        F.when(F.col("lang") == "en", F.col("text")).alias("reviews_c"),
        F.when(F.col("lang") != "en", F.col("text")).alias("reviews_u"),
    )
    write_quoted_csv(reviews.repartition(CHAIN_FILES), f"{folder}/reviews")
    # A crawl that found nothing leaves an empty file, which counts as well.
    nothing = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/reviews/nothing.csv")
    nothing.getFileSystem(spark._jsc.hadoopConfiguration()).create(nothing).close()
    reviews = read_csv(spark, f"{folder}/reviews", multiline=True)
    report = attach_category(reviews, classes, files=f"{folder}/reviews")[1]

    write_word_counts(category_words(reviews, classes), f"{folder}/words", CLASSES)
    counts = read_csv(spark, f"{folder}/words").withColumn("word_occurrences", rf.lenient_long(F.col("word_occurrences")))
    _, _, best = clean_word_table(counts.drop("total_word_occurrences"), _list(spark))
    totals = op.word_totals(counts, CLASSES)

    def rows(df, kind, side, category, word, n):
        return df.select(F.lit(kind).alias("kind"), side.alias("side"), category.alias("category"), word.alias("word"), n.cast("long").alias("n"))

    none, side, category = F.lit(None).cast("string"), F.col("side"), F.col("category")
    pairs = [F.struct(F.lit(c).alias("name"), F.col(c).alias("n")) for c in ("files", "total", "matched", "unmatched")]
    named = report.select(F.explode(F.array(*pairs)).alias("r"))
    return (
        rows(best, "top", side, category, F.col("word"), F.col("word_occurrences"))
        .unionByName(rows(totals, "total", side, category, none, F.col("total_word_occurrences")))
        .unionByName(rows(named, "report", none, F.col("r.name"), none, F.col("r.n")))
    )


def empty_table(spark, sf):
    """An absent source joined to a full one: the row stays, the columns are null."""
    none = empty(spark, "c_custkey long, score double")
    return table(spark, sf, "customer").select("c_custkey", "c_name").join(none, "c_custkey", "left")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "q_norm_id": norm_id,
    "q_guarded_cast": guarded_cast,
    "q_brand_number": brand_number,
    "q_multi_date": multi_date,
    "q_json_array": json_array,
    "q_flags": flags,
    "q_title_tokens": title_tokens,
    "q_turn_similarity": turn_similarity,
    "q_review_clean": review_clean,
    "q_quote_escape": quote_escape,
    "q_sentiment": sentiment,
    "q_or_join": or_join,
    "q_band_join": band_join,
    "q_title_match": title_match,
    "q_best_match": best_match,
    "q_star_join": star_join,
    "q_pending": pending,
    "q_review_agg": review_agg,
    "q_optional_source": optional_source,
    "q_empty_table": empty_table,
    "q_keep_one": keep_one,
    "q_quadrant": quadrant,
    "q_scaler_stats": scaler_stats,
    "q_classify": classify,
    "q_cluster_table": cluster_table,
    "q_left_outer_report": left_outer_report,
    "q_attached_category": attached_category,
    "q_outcomes": outcomes,
    "q_outcome_rows": outcome_rows,
    "q_word_freq": word_freq,
    "q_word_freq_paired": word_freq_paired,
    "q_stopword_anti": stopword_anti,
    "q_stopword_semi": stopword_semi,
    "q_stopword_report": stopword_report,
    "q_removed_sample": removed_sample,
    "q_tagged_words": tagged_words,
    "q_top_words": top_words,
    "q_tfidf": tfidf,
    "q_category_tfidf": category_tfidf,
    "q_slug": slug,
    "q_route": route,
    "q_urls": urls,
    "q_batches": batches,
    "q_batches_input_order": batches_input_order,
    "q_extract_class": extract_class,
    "q_extract_inner": extract_inner,
    "q_credits": credits,
    "q_credits_fallback": credits_fallback,
    "q_credits_recovered": credits_recovered,
    "q_roundtrip_csv": roundtrip_csv,
    "q_roundtrip_tsv": roundtrip_tsv,
    "q_roundtrip_parquet": roundtrip_parquet,
    "q_roundtrip_multiline": roundtrip_multiline,
    "q_roundtrip_one_csv": roundtrip_one_csv,
    "q_roundtrip_words": roundtrip_words,
    "q_roundtrip_batches": roundtrip_batches,
    "q_word_list": word_list,
    "q_first_rows": first_rows,
    "q_movie_table": movie_table,
    "q_pipeline": chain,
}
