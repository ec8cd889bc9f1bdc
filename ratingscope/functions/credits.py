"""Cast and crew out of Python-literal list text, without a Python worker.

The text is turned into JSON and parsed by Spark. Text that will not parse
falls back to patterns. Cast and crew fall back separately.

Patterns find names and characters apart, so these shift against each other where one
is missing. ``mode="recover"`` cuts damaged text into its objects first, ``{..}`` with
balanced braces outside quotes, and parses each: a truncated text gives all its whole
objects. Patterns are left for text without any.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .text import strip

# Fallback patterns and limits.
NAME_PATTERN = r"'name'\s*:\s*'([^']*)'"
CHARACTER_PATTERN = r"'character'\s*:\s*'([^']*)'"
ORDER_PATTERN = r"'order'\s*:\s*(\d+)"
DIRECTOR_PATTERN = r"'job'\s*:\s*'Director'[^}]*'name'\s*:\s*'([^']*)'"
WRITER_PATTERN = (
    r"(?i)'job'\s*:\s*'[^']*(?:Writer|Screenplay)[^']*'[^}]*'name'\s*:\s*'([^']*)'"
)
PRODUCER_PATTERN = r"(?i)'job'\s*:\s*'[^']*Producer[^']*'[^}]*'name'\s*:\s*'([^']*)'"
CAST_LIMIT = 5
MISSING_ORDER = 999

_CAST_TYPE = "array<struct<name: string, character: string, `order`: int>>"
_CREW_TYPE = "array<struct<name: string, job: string>>"
_JSON_OPTIONS = {"allowSingleQuotes": "true", "allowBackslashEscapingAnyCharacter": "true"}

_QUOTED = r"'[^'\\]*+(?:\\.[^'\\]*+)*+'|\"[^\"\\]*+(?:\\.[^\"\\]*+)*+\""

# A whole object: quoted text, objects of one level inside, anything else but braces and quotes.
# Text ends where a mark follows, so that a stray quote spoils its own object alone.
_ITEM = rf"(?:[^{{}}'\"]++|(?:{_QUOTED})(?=\s*+[:,}}\]]))"
OBJECT_PATTERN = rf"(?s)\{{(?:{_ITEM}|\{{{_ITEM}*+\}})*+\}}"


def literal_to_json(c: Column) -> Column:
    """Python list text as lenient JSON: constants and ``\\x`` escapes rewritten.

    Constants are replaced outside quoted text only: each match starts where the
    last one ended and skips whole quoted strings.
    """
    def replaced(text: Column, constant: str, value: str) -> Column:
        first, rest = constant[0], constant[1:]
        skip = rf"(?:[^'\"{first}]++|{_QUOTED}|{first}(?!{rest}\b))*+"
        return F.regexp_replace(text, rf"(?s)\G({skip}){constant}\b", rf"$1{value}")

    without_none = replaced(c, "None", "null")
    rare = replaced(replaced(without_none, "True", "true"), "False", "false")
    rare = F.regexp_replace(rare, r"(?<!\\)((?:\\\\)*)\\x([0-9a-fA-F]{2})", r"$1\\u00$2")
    has_rare = c.contains("True") | c.contains("False") | c.contains("\\x")
    return F.when(has_rare, rare).when(c.contains("None"), without_none).otherwise(c)


def _is_blank(c: Column) -> Column:
    return c.isNull() | strip(c).isin("", "[]")


def _no_names() -> Column:
    return F.array().cast("array<string>")


def _named(people: Column) -> Column:
    return F.filter(people, lambda x: x["name"].isNotNull() & (x["name"] != ""))


def _top_cast(actors: Column) -> Column:
    """First actors by order, ties in text order, names stripped, blanks dropped."""
    first = F.slice(F.sort_array(actors), 1, CAST_LIMIT)
    tidy = F.transform(
        first,
        lambda x: F.struct(
            strip(x["name"]).alias("name"),
            strip(F.coalesce(x["character"], F.lit(""))).alias("character"),
        ),
    )
    return F.filter(tidy, lambda x: x["name"] != "")


def _structured_cast(parsed: Column) -> Column:
    actors = F.transform(
        _named(parsed),
        lambda x, i: F.struct(
            F.coalesce(x["order"], F.lit(MISSING_ORDER)).alias("order"),
            i.alias("position"),
            x["name"].alias("name"),
            x["character"].alias("character"),
        ),
    )
    return _top_cast(actors)


def _pattern_cast(names: Column, characters: Column, orders: Column) -> Column:
    """The lists are columns: as expressions they would be found again for each actor."""
    shortest = F.least(F.size(names), F.size(characters), F.size(orders))
    actors = F.transform(
        F.slice(names, F.lit(1), shortest),
        lambda name, i: F.struct(
            F.get(orders, i).try_cast("decimal(38,0)").alias("order"),
            i.alias("position"),
            name.alias("name"),
            F.get(characters, i).alias("character"),
        ),
    )
    return _top_cast(actors)


def _pattern_names(c: Column, pattern: str) -> Column:
    return F.regexp_extract_all(F.coalesce(c, F.lit("")), F.lit(pattern), 1)


def _parsed(c: Column, type_name: str, mode: str) -> Column:
    if mode == "regex":
        return F.lit(None).cast(type_name)
    # A list that never ends does not parse.
    endless = c.startswith("[") & ~c.contains("]")
    return F.when(~endless, F.from_json(literal_to_json(c), type_name, _JSON_OPTIONS))


def _whole_objects(df: DataFrame, texts: dict[str, Column], types: dict[str, str]) -> DataFrame:
    """``df`` with the whole objects of each text that parse, or null if there are none, in ``_whole_..``.

    They are parsed as one list. Where one of them does not parse, or lacks what may have
    been lost with the list, each is parsed alone. What one projection finds the next reads.
    """
    df = df.withColumns({f"_found_{n}": F.regexp_extract_all(c, F.lit(OBJECT_PATTERN), 0) for n, c in texts.items()})
    listed = {f"_list_{n}": F.concat(F.lit("["), F.array_join(f"_found_{n}", ","), F.lit("]")) for n in texts}
    df = df.withColumns(listed)
    df = df.withColumns({f"_all_{n}": F.from_json(literal_to_json(F.col(f"_list_{n}")), types[n], _JSON_OPTIONS) for n in texts})

    def whole(name: str) -> Column:
        fields = ["name", "order"] if "`order`" in types[name] else ["name"]
        every, found = F.col(f"_all_{name}"), F.col(f"_found_{name}")
        sound = F.forall(every, lambda x: reduce(and_, [x[f].isNotNull() for f in fields]))
        one = types[name].removeprefix("array<").removesuffix(">")
        alone = F.transform(found, lambda o: F.from_json(literal_to_json(o), one, _JSON_OPTIONS))
        alone = F.filter(alone, lambda x: x.isNotNull() & x["name"].isNotNull())
        return F.when((F.size(every) == F.size(found)) & sound, every).otherwise(alone)

    df = df.withColumns({f"_whole_{n}": whole(n) for n in texts})
    df = df.drop(*[f"_{step}_{n}" for n in texts for step in ("found", "list", "all")])
    return df.withColumns({f"_whole_{n}": F.when(F.size(f"_whole_{n}") > 0, F.col(f"_whole_{n}")) for n in texts})


def _workers(parsed: Column) -> Column:
    """Named crew with stripped name and one letter for the job; others are left out."""
    # In lower case once, as what one list holds the next reads.
    lower = F.transform(_named(parsed), lambda x: F.struct(x["name"].alias("name"), F.lower(F.coalesce(x["job"], F.lit(""))).alias("job")))
    kind = lambda x: (
        F.when(x["job"] == "director", "d").when(x["job"].rlike("writer|screenplay"), "w").when(x["job"].contains("producer"), "p")
    )
    known = F.transform(lower, lambda x: F.struct(strip(x["name"]).alias("name"), kind(x).alias("kind")))
    return F.filter(known, lambda x: x["kind"].isNotNull())


def parse_credits(df: DataFrame, cast: str = "cast", crew: str = "crew", mode: str = "auto") -> DataFrame:
    """``df`` with the first five actors, directors, writers, producers and the method.

    A job that names writing wins over producing; the patterns are not exclusive.
    ``mode="regex"`` uses the patterns for every text that is not blank; ``mode="recover"``
    takes the whole objects of damaged text, with the method ``objects``. Each text is
    parsed in one projection and read in the next, so it is parsed once.
    """
    if mode not in ("auto", "regex", "recover"):
        raise ValueError(f"unknown mode {mode!r}")
    parsed = df.withColumns(
        {
            "_cast": _parsed(F.col(cast), _CAST_TYPE, mode),
            "_crew": _parsed(F.col(crew), _CREW_TYPE, mode),
            "_no_cast": _is_blank(F.col(cast)),
            "_no_crew": _is_blank(F.col(crew)),
        }
    )

    recovered = F.lit(False)
    if mode == "recover":
        damaged = {p: F.when(F.col(f"_{p}").isNull() & ~F.col(f"_no_{p}"), F.col(c)) for p, c in (("cast", cast), ("crew", crew))}
        parsed = _whole_objects(parsed, damaged, {"cast": _CAST_TYPE, "crew": _CREW_TYPE})
        recovered = F.col("_whole_cast").isNotNull() | F.col("_whole_crew").isNotNull()
        parsed = parsed.withColumns(
            {"_recovered": recovered, "_cast": F.coalesce("_cast", "_whole_cast"), "_crew": F.coalesce("_crew", "_whole_crew")}
        )
        recovered = F.col("_recovered")
    unread = ~F.col("_no_cast") & F.col("_cast").isNull()
    patterns = {"_names": NAME_PATTERN, "_characters": CHARACTER_PATTERN, "_orders": ORDER_PATTERN}
    parsed = parsed.withColumns(
        {"_workers": _workers(F.col("_crew"))}
        | {c: F.when(unread, F.regexp_extract_all(cast, F.lit(p), 1)) for c, p in patterns.items()}
    )

    def people(kind: str, pattern: str) -> Column:
        chosen = F.transform(F.filter("_workers", lambda x: x["kind"] == kind), lambda x: x["name"])
        return (
            F.when(F.col("_no_crew"), _no_names())
            .when(F.col("_crew").isNotNull(), chosen)
            .otherwise(_pattern_names(F.col(crew), pattern))
        )

    empty = F.array().cast("array<struct<name: string, character: string>>")
    read = parsed.withColumns(
        {
            "_actors": F.when(F.col("_no_cast"), empty)
            .when(F.col("_cast").isNotNull(), _structured_cast(F.col("_cast")))
            .otherwise(_pattern_cast(F.col("_names"), F.col("_characters"), F.col("_orders"))),
            "director_names": people("d", DIRECTOR_PATTERN),
            "writer_names": people("w", WRITER_PATTERN),
            "producer_names": people("p", PRODUCER_PATTERN),
            "extract_method": F.when(
                (F.col("_no_cast") | F.col("_cast").isNotNull())
                & (F.col("_no_crew") | F.col("_crew").isNotNull()),
                F.when(recovered, "objects").otherwise("eval"),
            ).otherwise("regex"),
        }
    )
    return read.withColumns(
        {
            "main_cast_names": F.transform("_actors", lambda x: x["name"]),
            "main_cast_characters": F.transform("_actors", lambda x: x["character"]),
        }
    ).drop(*patterns, "_cast", "_crew", "_workers", "_no_cast", "_no_crew", "_actors", "_whole_cast", "_whole_crew", "_recovered")
