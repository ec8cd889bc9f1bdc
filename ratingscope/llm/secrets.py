"""Secret scans: fixed patterns plus character Markov models, in SQL functions only.

Two order-1 character models are trained on the corpus itself. The random one learns from
what the fixed patterns hit (of an assignment the value, whole), the ordinary one from all runs of two or
more characters outside such hits that recur (RECURS) in a bounded sample of documents, as words,
names and numbers do and keys do not. Pairs seen seldom lean on how often their second character
is seen at all. A candidate is any
run of 12 or more characters of ``[A-Za-z0-9+/_=-]``; the mean log-likelihood ratio of its
character pairs alone decides. Runs are cut at base spans, which stay as they are; what is left
of 12 or more characters on either side is a candidate of its own.

A span is the whole match, ``kind:start:end`` in code points, end exclusive. Kinds: ``assign``,
``access``, ``hex`` (base) and ``markov`` (added).

Edge cases. Null and empty texts have no spans. Without labelled samples (an empty table, a
corpus without any secret) the models are flat and add nothing. Repeated rows get equal spans.
The work on a text grows with n log n, whatever it holds.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..workdir import materialized

# Fixed values of the task: kinds in the order that breaks ties, patterns, least lengths.
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ASSIGN_LEAST = 6
# A longer run of the same class is one match, so the least length can be in the pattern.
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
KINDS = ("assign", "access", "hex", "markov")

RUN = "[A-Za-z0-9+/_=-]"
LEAST = 12
CANDIDATE = rf"{RUN}{{{LEAST},}}"
ORDINARY = rf"{RUN}{{2,}}"
# Documents whose runs train the ordinary model; chosen by a hash of the id.
SAMPLE_DOCS = 20_000
CODES = 128
SMOOTH = 0.5
# Pairs that the frequency of single characters counts for.
PRIOR = 32
# Times an ordinary run is in the sample at least.
RECURS = 3
# Mean log-likelihood ratio of a pair from which a candidate counts as random.
THRESHOLD = 0.5
SPAN = "array<struct<start:int,end:int,kind:int>>"
FOUND = "array<struct<start:int,end:int,kind:int,t:string>>"
# After the last character of any text.
END = (1 << 31) - 1


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value worked out once for each row."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _running(values: Column, add: Callable[[Column, Column], Column], zero: Column) -> Column:
    """Running totals of an array by doubling: each round adds what stands 1, 2, 4, .. places before.

    n log n steps. Appending to a growing array would copy it each time.
    """
    rounds = F.transform(F.sequence(F.lit(0), F.length(F.bin(F.size(values))) - 1), lambda k: F.call_function("shiftleft", F.lit(1), k))

    def once(sums: Column, step: Column) -> Column:
        by = F.least(step, F.size(sums))
        return F.zip_with(sums, F.concat(F.array_repeat(zero, by), F.slice(sums, F.lit(1), F.size(sums) - by)), add)

    return F.aggregate(rounds, values, once)


def _found(text: Column, pattern: str, kind: int, least: int = 0) -> Column:
    """Leftmost non-overlapping matches with their places, from the pieces between them.

    ``t`` is the match, or its second group where that must have ``least`` characters.
    """

    def placed(found: Column) -> Column:
        secret = F.regexp_extract_all(text, F.lit(pattern), F.lit(2)) if least else found
        sizes = F.zip_with(F.slice(F.split(text, pattern, -1), F.lit(1), F.size(found)), found, lambda b, m: F.length(b) + F.length(m))
        ends = _running(sizes, lambda a, b: a + b, F.lit(0))
        spans = F.zip_with(ends, found, lambda e, m: F.struct((e - F.length(m)).alias("start"), e.alias("end"), F.lit(kind).alias("kind")))
        spans = F.zip_with(spans, secret, lambda s, t: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"), t.alias("t")))
        return F.filter(spans, lambda s: F.length(s["t"]) >= least) if least else spans

    nothing = F.array().cast(FOUND)
    return F.when(F.regexp_like(text, F.lit(pattern)), _let(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), placed)).otherwise(nothing)


def _by_place(spans: Column) -> Column:
    return F.array_sort(spans, lambda a, b: F.when(a["start"] != b["start"], a["start"] - b["start"]).otherwise(a["kind"] - b["kind"]))


def _places(found: Column) -> Column:
    return F.transform(found, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind")))


def _base(text: Column) -> Column:
    kinds = [(ASSIGN, ASSIGN_LEAST), (ACCESS, 0), (HEX, 0)]
    return _by_place(F.concat(*[_found(text, p, k, least) for k, (p, least) in enumerate(kinds)]))


def base_spans(text: Column) -> Column:
    """Spans of the fixed patterns, by start, then kind."""
    return _places(_base(text))


def joined(spans: Column) -> Column:
    kinds = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.element_at(kinds, s["kind"] + 1), s["start"], s["end"])), ",")


def _pairs(run: Column) -> Column:
    """Character pairs of a run as numbers. Its characters are ASCII, so they are found by byte."""

    def numbered(raw: Column) -> Column:
        code = lambda i: F.ascii(F.substring(raw, i, F.lit(1)).cast("string"))
        return F.transform(F.sequence(F.lit(1), F.octet_length(raw) - 1), lambda i: code(i) * CODES + code(i + 1))

    return F.when(F.length(run) < 2, F.array().cast("array<int>")).otherwise(_let(run.cast("binary"), numbered))


def pair_table(samples: DataFrame) -> str | None:
    """Log-likelihood ratios of all CODES x CODES pairs, from (``secret`` boolean, ``t``).

    The counts are summed in Spark. At most 2 x CODES x CODES numbers reach the driver.
    """
    runs = samples.groupBy("secret", "t").agg(F.count(F.lit(1)).alias("n")).where(F.col("secret") | (F.col("n") >= RECURS))
    counted = runs.select("secret", "n", F.explode(_pairs(F.col("t"))).alias("pair")).groupBy("pair").agg(
        F.sum(F.when(F.col("secret"), F.col("n")).otherwise(0)).alias("random"), F.sum(F.when(F.col("secret"), 0).otherwise(F.col("n"))).alias("ordinary")
    )
    rows = counted.collect()
    if not any(r["random"] for r in rows) or not any(r["ordinary"] for r in rows):
        return None
    seen: dict[str, list[float]] = {"random": [0.0] * (CODES * CODES), "ordinary": [0.0] * (CODES * CODES)}
    for r in rows:
        for name in seen:
            seen[name][r["pair"]] = float(r[name])
    single = {name: [(sum(counts[second::CODES]) + SMOOTH) / (sum(counts) + SMOOTH * 64) for second in range(CODES)] for name, counts in seen.items()}
    ratios = []
    for first in range(CODES):
        row = {name: counts[first * CODES : (first + 1) * CODES] for name, counts in seen.items()}
        total = {name: sum(counts) + PRIOR for name, counts in row.items()}
        logs = {name: [math.log((n + PRIOR * p) / total[name]) for n, p in zip(row[name], single[name])] for name in row}
        ratios += [a - b for a, b in zip(logs["random"], logs["ordinary"])]
    return ",".join(f"{x:.4f}" for x in ratios)


def _free(spans: Column) -> Column:
    """The stretches outside ``spans`` (sorted by start), empty ones included."""
    ends = _running(F.transform(spans, lambda s: s["end"]), lambda a, b: F.greatest(a, b), F.lit(0))
    starts = F.concat(F.transform(spans, lambda s: s["start"]), F.array(F.lit(END)))
    return F.zip_with(F.concat(F.array(F.lit(0)), ends), starts, lambda a, b: F.struct(a.alias("start"), b.alias("end")))


def _outside(runs: Column, spans: Column) -> Column:
    """The parts of ``runs`` outside ``spans`` that are long enough.

    A part begins where a run or a free stretch begins. All beginnings are sorted; running
    counts of either sort tell which run and which stretch each one stands in.
    """

    def cut(free: Column) -> Column:
        begins = lambda of, is_run: F.transform(of, lambda x: F.struct(x["start"].alias("at"), F.lit(is_run).alias("run")))

        def parts(marks: Column) -> Column:
            def part(mark: Column, n: Column, i: Column) -> Column:
                run, stretch = F.get(runs, n - 1), F.get(free, i - n)
                end = F.least(run["end"], stretch["end"])
                t = F.substring(run["t"].cast("binary"), mark["at"] - run["start"] + 1, end - mark["at"]).cast("string")
                one = F.struct(mark["at"].alias("start"), end.alias("end"), F.lit(3).alias("kind"), t.alias("t"))
                return F.when((n > 0) & (i >= n) & (end - mark["at"] >= LEAST), one)

            # Runs begun so far, this one included; the other marks up to here are stretches.
            nth = _running(F.transform(marks, lambda m: m["run"]), lambda a, b: a + b, F.lit(0))
            both = F.zip_with(marks, nth, lambda m, n: F.struct(m["at"].alias("at"), n.alias("n")))
            return F.filter(F.transform(both, lambda m, i: part(m, m["n"], i)), lambda x: x.isNotNull())

        return _let(F.sort_array(F.concat(begins(runs, 1), begins(free, 0))), parts)

    return F.when((F.size(spans) > 0) & (F.size(runs) > 0), _let(_free(spans), cut)).otherwise(runs)


def scan_secrets(docs: DataFrame, *, threshold: float = THRESHOLD, sample_docs: int = SAMPLE_DOCS, work_dir: str | None = None) -> DataFrame:
    """``doc_id``, ``text_hash`` (xxhash64), ``base`` and ``spans`` (arrays of start, end, kind)
    of every document."""
    share = min(1.0, sample_docs / max(1, docs.count()))
    sampled = F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 30)) < int(share * (1 << 30))
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), F.xxhash64("text").alias("text_hash"))
    rows = rows.withColumns({"found": _base(F.col("text")), "long": _found(F.col("text"), CANDIDATE, 3)})
    rows = rows.select("doc_id", "text_hash", _places(F.col("found")).alias("base"), _outside(F.col("long"), F.col("found")).alias("runs"), F.transform("found", lambda s: s["t"]).alias("hits"))
    rows = materialized(rows, "secrets-rows", work_dir)
    random = rows.select(F.lit(True).alias("secret"), F.explode("hits").alias("t"))
    rest = F.coalesce("text", F.lit(""))
    for pattern in (ASSIGN, ACCESS, HEX):
        rest = F.regexp_replace(rest, pattern, " ")
    ordinary = docs.where(sampled).select(F.lit(False).alias("secret"), F.explode(F.regexp_extract_all(rest, F.lit(ORDINARY), F.lit(0))).alias("t"))
    ratios = pair_table(random.unionByName(ordinary))
    spans = F.col("base")
    if ratios is not None:
        table = F.split(F.lit(ratios), ",").cast("array<double>")
        mean = lambda r: F.aggregate(_pairs(r["t"]), F.lit(0.0), lambda s, p: s + F.element_at(table, p + 1)) / (F.length(r["t"]) - 1)
        added = _places(F.filter("runs", lambda r: mean(r) >= threshold))
        spans = F.when(F.size("runs") > 0, _by_place(F.concat("base", added))).otherwise(spans)
    return rows.select("doc_id", "text_hash", "base", spans.alias("spans"))


def redacted(text: Column, spans: Column, mark: str = "[SECRET]") -> Column:
    """``text`` with every span replaced; overlapping spans become one mark.

    Four bytes hold a character, so that pieces are found by place. Each begins with a byte
    order mark, which decoding takes away.
    """
    order_mark = F.lit(b"\x00\x00\xfe\xff")

    def joined_up(wide: Column) -> Column:
        # A stretch that ends before it begins lies between spans that overlap.
        free = F.filter(_free(spans), lambda s: s["start"] <= s["end"])
        size = F.octet_length(wide) / 4
        piece = lambda s: F.decode(F.concat(order_mark, F.substring(wide, s["start"] * 4 + 1, ((F.least(s["end"], size) - s["start"]) * 4).cast("int"))), "UTF-32")
        return F.array_join(F.transform(free, piece), mark)

    return F.when(F.size(spans) > 0, _let(F.encode(text, "UTF-32"), joined_up)).otherwise(text)
