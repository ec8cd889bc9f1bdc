"""How far the sources of a language differ in their words.

Rows of a matrix are the groups (language and source), columns the terms kept in the language.
A cell becomes a share p, in billionths and above zero even where the count is zero; two groups
differ by the sum of the differences of their shares over all columns.

The matrix is cut into tiles of ROWS groups and about COLUMNS terms, and each task takes a
column tile of two row tiles. There both are K-squared quadtrees (K = 2): a quadrant is split
while it holds a nonzero count. The trees are walked jointly, for all pairs of their rows at
once. Where neither has a count the quadrant is priced without a look at its cells: all shares
of a row with no count are equal, so it costs its columns times the difference of two numbers.
Where one has counts, the walk goes down to leaves of LEAF x LEAF cells, which are compared cell
by cell. Terms in many groups come first in a tile, those of one source side by side, so that
zeros lie together.

A task holds 2 x ROWS x COLUMNS cells, however many groups, terms and documents there are.
Shares are whole numbers from decimal arithmetic, so sums are exact.

Edge cases. Null text, language and source count as empty ones. Each row is a document of its
own, repeated ids and texts included. A group without terms has equal shares everywhere; in a
language that keeps no term all pairs differ by 0. A source that is alone in its language has no
pairs. An empty table gives no rows. Other columns are not looked at.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..workdir import materialized

# Bytes that are no part of a term become spaces; all those of characters beyond ASCII are.
TO_TERMS = bytes(b if b > 127 else ord(chr(b).lower()) if chr(b).isalpha() else 32 for b in range(256))
# Fixed values of the task: documents of a kept term, the unit and pseudo-count of a share, and
# ranks of the report by term.
LEAST_DOCS, UNIT, PSEUDO, TOP = 30, 1_000_000_000, 5, 50
# Groups and terms of a tile, and the side of a leaf. Powers of two.
ROWS, COLUMNS, LEAF = 64, 2048, 8
# Leaf pairs compared at a time.
CHUNK = 256
# Terms that a worker counts before it hands on its counts.
HELD = 250_000


def terms(text: str | None) -> list[bytes]:
    """Terms of a text in order, in UTF-8, only A to Z lower-cased."""
    return (text or "").encode("utf-8", "surrogatepass").translate(TO_TERMS).split()


def share(count: Column | int, total: Column, kept: Column) -> Column:
    """1 + floor(UNIT * (count + PSEUDO) / (total + PSEUDO * kept)) in exact arithmetic."""
    n = count if isinstance(count, Column) else F.lit(count)
    above = (n.cast("decimal(20,0)") + PSEUDO) * F.lit(UNIT).cast("decimal(12,0)")
    below = total.cast("decimal(20,0)") + kept.cast("decimal(20,0)") * PSEUDO
    return F.call_function("div", above, below) + F.lit(1).cast("long")


def quadtree(tiles: np.ndarray) -> list[np.ndarray]:
    """Whether each quadrant holds a count, from the leaves up to the whole tile."""
    levels = [tiles]
    while levels[-1].size > 1:
        at = levels[-1]
        for axis in (0, 1):
            if at.shape[axis] > 1:
                at = np.logical_or.reduceat(at, range(0, at.shape[axis], 2), axis=axis)
        levels.append(at)
    return levels


def tile_differences(shares: tuple[np.ndarray, np.ndarray], zeros: tuple[np.ndarray, np.ndarray], counts: tuple[np.ndarray, np.ndarray], width: int) -> np.ndarray:
    """Sum of |p - q| over the first ``width`` columns, for each row of the one tile and the other.

    ``shares`` are zero beyond ``width``, ``zeros`` the share of a zero count by row, ``counts``
    tells which cells have one. All sides are powers of two of LEAF or more.
    """
    (p, q), (y, z) = shares, zeros
    cut = lambda m: m.reshape(m.shape[0] // LEAF, LEAF, -1, LEAF)
    trees = [quadtree(cut(m).any(axis=(1, 3))) for m in counts]
    rows, columns = p.shape[0] // LEAF, p.shape[1] // LEAF
    leaves_p, leaves_q = cut(p).swapaxes(1, 2), cut(q).swapaxes(1, 2)
    priced = np.zeros((rows, rows), dtype=np.int64)
    out = np.zeros((rows, rows, LEAF, LEAF), dtype=np.int64)
    a = b = c = np.zeros(1, dtype=np.int64)
    for level in range(len(trees[0]) - 1, -1, -1):
        one, other = trees[0][level], trees[1][level]
        high, wide = rows // one.shape[0], LEAF * columns // one.shape[1]
        full = one[a, c] | other[b, c]
        cost = np.clip(width - c[~full] * wide, 0, wide)
        by_rows = np.zeros((one.shape[0],) * 2, dtype=np.int64)
        np.add.at(by_rows, (a[~full], b[~full]), cost)
        priced += by_rows.repeat(high, axis=0).repeat(high, axis=1)
        a, b, c = a[full], b[full], c[full]
        if level:
            # Each quadrant is split along the sides that are longer one level down.
            finer = trees[0][level - 1].shape
            for side, (x, split) in enumerate(((a, finer[0] > one.shape[0]), (b, finer[0] > one.shape[0]), (c, finer[1] > one.shape[1]))):
                if split:
                    a, b, c = (np.repeat(v, 2) for v in (a, b, c))
                    half = np.arange(len(a)) % 2
                    if side == 0:
                        a = 2 * a + half
                    elif side == 1:
                        b = 2 * b + half
                    else:
                        c = 2 * c + half
    for at in range(0, len(a), CHUNK):
        i, j, k = a[at : at + CHUNK], b[at : at + CHUNK], c[at : at + CHUNK]
        apart = np.abs(leaves_p[i, k][:, :, None, :] - leaves_q[j, k][:, None, :, :]).sum(axis=3)
        np.add.at(out, (i, j), apart)
    return out.swapaxes(1, 2).reshape(rows * LEAF, rows * LEAF) + priced.repeat(LEAF, axis=0).repeat(LEAF, axis=1) * np.abs(y[:, None] - z[None, :])


def _tile(batches: pa.Table, rows: int) -> pa.Table:
    """One pair of row tiles over one column tile: differences of its pairs of groups.

    Rows with ``cp`` below zero carry the zero share of a group and the width of the tile.
    """
    get = lambda name: batches.column(name).to_numpy()
    lang, i, j = batches.column("lang")[0].as_py(), int(get("i")[0]), int(get("j")[0])
    rb, rp, cp, p = get("rb"), get("rp"), get("cp"), get("p")
    named = cp < 0
    width = int(get("width")[named][0])
    columns = LEAF
    while columns < width:
        columns *= 2
    shares, zeros, counts, there = [], [], [], []
    for block in (i, j):
        mine = rb == block
        zero, known = np.zeros(rows, dtype=np.int64), np.zeros(rows, dtype=bool)
        zero[rp[mine & named]], known[rp[mine & named]] = p[mine & named], True
        cells = mine & ~named
        m, n = np.zeros((rows, columns), dtype=np.int64), np.zeros((rows, columns), dtype=bool)
        m[:, :width] = zero[:, None]
        m[rp[cells], cp[cells]], n[rp[cells], cp[cells]] = p[cells], True
        shares.append(m), zeros.append(zero), counts.append(n), there.append(known)
    apart = tile_differences(tuple(shares), tuple(zeros), tuple(counts), width)
    pairs = there[0][:, None] & there[1][None, :]
    if i == j:
        pairs = np.triu(pairs, 1)
    s, t = np.nonzero(pairs)
    n = len(s)
    return pa.table({"lang": pa.array([lang] * n, type=pa.string()), "i": pa.array([i] * n, type=pa.int32()), "j": pa.array([j] * n, type=pa.int32()), "s": s.astype(np.int32), "t": t.astype(np.int32), "value": apart[s, t]})


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Task function: occurrences and documents of the terms of each group, added up in the task."""
    counts: dict[tuple[str, str], tuple[Counter, Counter]] = defaultdict(lambda: (Counter(), Counter()))

    def counted() -> Iterator[pa.RecordBatch]:
        for (lang, source), (n, docs) in counts.items():
            columns = [pa.repeat(pa.scalar(x, pa.string()), len(n)) for x in (lang, source)]
            columns += [pa.array(list(n), type=pa.binary()).cast(pa.string()), pa.array(list(n.values()), type=pa.int64()), pa.array([docs[t] for t in n], type=pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=["lang", "source", "term", "n", "docs"])
        counts.clear()

    held = 0
    for batch in batches:
        for lang, source, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
            found = terms(text.as_py())
            if not found:
                continue
            n, docs = counts[lang, source]
            held -= len(n)
            n.update(found)
            docs.update(set(found))
            held += len(n)
            if held >= HELD:
                yield from counted()
                held = 0
    yield from counted()


def _cells(docs: DataFrame) -> DataFrame:
    """Occurrences and documents of each term of each group."""
    named = [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source")]
    found = docs.select(*named, F.col("text").cast("string").alias("text")).mapInArrow(_counted, "lang string, source string, term string, n long, docs long")
    return found.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def source_divergence(docs: DataFrame, *, least_docs: int = LEAST_DOCS, top: int = TOP, rows: int = ROWS, columns: int = COLUMNS, work_dir: str | None = None) -> DataFrame:
    """``lang, source, part, item, value, rank``: each group against the other sources of its
    language (part ``pair``) and its most overused terms (part ``term``).
    """
    if rows < LEAF or columns < LEAF or rows & (rows - 1) or columns & (columns - 1):
        raise ValueError("tiles have powers of two of LEAF or more rows and columns")
    group = ["lang", "source"]
    cells = materialized(_cells(docs), "divergence-cells", work_dir)
    by_term = cells.groupBy("lang", "term").agg(F.sum("docs").alias("docs"), F.sum("n").alias("total"), F.count(F.lit(1)).alias("spread"), F.min("source").alias("first"))
    kept = materialized(by_term.where(F.col("docs") >= least_docs), "divergence-terms", work_dir)
    langs = materialized(kept.groupBy("lang").agg(F.count(F.lit(1)).alias("kept"), F.sum("total").alias("lang_total")), "divergence-langs", work_dir)
    held = materialized(cells.join(kept.select("lang", "term"), ["lang", "term"]).select(*group, "term", "n"), "divergence-kept", work_dir)

    named = [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in group]
    totals = held.groupBy(*group).agg(F.sum("n").alias("total"))
    groups = docs.select(*named).distinct().join(totals, group, "left").join(langs, "lang", "left")
    groups = groups.select(*group, F.coalesce("total", F.lit(0)).alias("total"), "kept")
    number = F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1
    zero = F.coalesce(share(0, F.col("total"), F.col("kept")), F.lit(0))
    groups = groups.select("*", F.floor(number / rows).cast("int").alias("rb"), (number % rows).cast("int").alias("rp"), zero.alias("zero"))
    groups = materialized(groups, "divergence-groups", work_dir)

    tiles = F.greatest(F.lit(1), F.pow(F.lit(2.0), F.ceil(F.log2(F.col("kept") / columns)))).cast("long")
    placed = kept.join(langs, "lang").select("lang", "term", "spread", "first", share(F.col("total"), F.col("lang_total"), F.col("kept")).alias("q"), F.pmod(F.xxhash64("term"), tiles).cast("int").alias("cb"))
    column = F.row_number().over(Window.partitionBy("lang", "cb").orderBy(F.desc("spread"), "first", "term")) - 1
    placed = materialized(placed.select("lang", "term", "q", "cb", column.alias("cp")), "divergence-columns", work_dir)

    shares = held.join(groups, group).select(*group, "term", "rb", "rp", share(F.col("n"), F.col("total"), F.col("kept")).alias("p"))
    shares = materialized(shares.join(placed, ["lang", "term"]), "divergence-shares", work_dir)

    best = Window.partitionBy(*group).orderBy(F.desc("value"), "item")
    over = shares.where("p > q").select(*group, F.lit("term").alias("part"), F.col("term").alias("item"), (F.col("p") - F.col("q")).alias("value"))
    over = over.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= top)

    blocks = groups.groupBy("lang").agg((F.max("rb") + 1).alias("blocks"))
    widths = placed.groupBy("lang", "cb").agg(F.count(F.lit(1)).cast("int").alias("width"))
    at_zero = groups.join(widths, "lang", "left").select("lang", "rb", "rp", F.coalesce("cb", F.lit(0)).alias("cb"), F.lit(-1).alias("cp"), F.col("zero").alias("p"), F.coalesce("width", F.lit(0)).alias("width"))
    cells_at = shares.select("lang", "rb", "rp", "cb", "cp", "p", F.lit(0).alias("width"))
    both = at_zero.unionByName(cells_at).join(blocks, "lang")
    both = both.withColumn("o", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select("lang", F.least("rb", "o").alias("i"), F.greatest("rb", "o").alias("j"), "cb", "rb", "rp", "cp", "p", "width")
    # A group is one column tile of two row tiles: 2 x rows x columns cells or so.
    found = both.groupBy("lang", "i", "j", "cb").applyInArrow(lambda t: _tile(t, rows), "lang string, i int, j int, s int, t int, value long")
    summed = found.groupBy("lang", "i", "j", "s", "t").agg(F.sum("value").alias("value"))
    names = groups.select("lang", "rb", "rp", "source")
    one = names.toDF("lang", "i", "s", "one")
    other = names.toDF("lang", "j", "t", "other")
    pairs = materialized(summed.join(one, ["lang", "i", "s"]).join(other, ["lang", "j", "t"]).select("lang", "one", "other", "value"), "divergence-pairs", work_dir)
    ordered = pairs.select("lang", F.col("one").alias("source"), F.col("other").alias("item"), "value").unionByName(pairs.select("lang", F.col("other").alias("source"), F.col("one").alias("item"), "value"))
    ordered = ordered.select(*group, F.lit("pair").alias("part"), "item", "value").withColumn("rank", F.row_number().over(best))
    return ordered.unionByName(over)


SQL = r"""
WITH d AS (SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS low FROM documents),
g AS (SELECT DISTINCT lang, source FROM d),
o AS (SELECT r, lang, source, unnest(regexp_extract_all(low, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d),
k AS (SELECT lang, term, count(*) AS total FROM o GROUP BY lang, term HAVING count(DISTINCT r) >= 30),
l AS (SELECT lang, count(*) AS v, sum(total) AS n FROM k GROUP BY lang),
c AS (SELECT lang, source, term, count(*) AS n FROM o JOIN k USING (lang, term) GROUP BY lang, source, term),
t AS (SELECT lang, source, coalesce(sum(n), 0) AS n FROM g LEFT JOIN c USING (lang, source) GROUP BY lang, source),
p AS (SELECT t.lang, t.source, k.term, coalesce(c.n, 0) AS cnt,
    1 + (1000000000::HUGEINT * (coalesce(c.n, 0) + 5)) // (t.n + 5 * l.v) AS p,
    1 + (1000000000::HUGEINT * (k.total + 5)) // (l.n + 5 * l.v) AS q
  FROM t JOIN k USING (lang) JOIN l USING (lang) LEFT JOIN c ON c.lang = t.lang AND c.source = t.source AND c.term = k.term),
a AS (SELECT x.lang, x.source, y.source AS item, sum(abs(x.p - y.p)) AS value FROM p x JOIN p y ON x.lang = y.lang AND x.term = y.term AND x.source <> y.source GROUP BY ALL),
u AS (SELECT x.lang, x.source, 'pair' AS part, y.source AS item, coalesce(a.value, 0) AS value
    FROM g x JOIN g y ON x.lang = y.lang AND x.source <> y.source LEFT JOIN a ON a.lang = x.lang AND a.source = x.source AND a.item = y.source
  UNION ALL SELECT lang, source, 'term', term, p - q FROM p WHERE cnt > 0 AND p > q),
z AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, encode(item)) AS rank FROM u)
SELECT lang, source, part, item, value::BIGINT AS value, rank::INTEGER AS rank FROM z WHERE part = 'pair' OR rank <= 50
"""
