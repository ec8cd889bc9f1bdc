"""Compression of vectors to codes, with a GNAT over the entries of each codebook.

A vector is cut into equal parts; each part becomes the number of the nearest entry of its
codebook. The codebooks are fitted on the whole table: every round assigns all parts and moves
each entry to the mean of its parts. Tasks send one sum for each entry they used, so a round
shuffles a few rows of each task, and the driver holds the codebooks alone.

The nearest entry is searched in a geometric near-neighbour access tree. A node compares its
split points directly and hangs each other entry below the nearest of them. For each split
point and each child it stores the range of distances between the two. A query whose distance
to a split point, plus or minus the best distance so far, misses that range leaves out the
child with all below it. All distances are rounded outwards and a child at the very edge is
visited, so no entry that ties is lost; which one wins is settled in integers.

Edge cases. Vectors that are null or hold null or non-finite components take no part, nor do
those with a component so large that squared distances would leave 64 bits (half a million for
64 components). Shorter vectors count as filled with zeros, up to the longest length or the
next multiple of the number of parts; empty ones are all zeros. Codebooks have fewer entries
where there are fewer vectors. Repeated rows count each; null ids come after all others, equal
ids by their components. An error sum beyond 64 bits is null. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..workdir import materialized

# Fixed values of the task.
SCALE, PARTS, ENTRIES, ROUNDS = 256, 16, 64, 2
# Split points of a node, and most entries that are compared without a node.
FANOUT, LEAF = 8, 8
# Rows that a worker assigns at a time.
ROWS = 4096


def _down(x: np.ndarray) -> np.ndarray:
    return np.nextafter(np.nextafter(x, -np.inf), -np.inf)


def _up(x: np.ndarray) -> np.ndarray:
    return np.nextafter(np.nextafter(x, np.inf), np.inf)


def _squares(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared distances of all rows of ``a`` from all rows of ``b``."""
    out = np.zeros((len(a), len(b)), dtype=np.int64)
    for i in range(a.shape[1]):
        out += np.square(a[:, i, None] - b[None, :, i])
    return out


class Node:
    """Split points, the children below them, and the range of distances from split to child."""

    def __init__(self, entries: np.ndarray, members: np.ndarray, fanout: int, leaf: int):
        self.splits = np.sort(members[self._far_apart(entries[members], fanout)])
        rest = members[~np.isin(members, self.splits)]
        far = _squares(entries[self.splits], entries[rest])
        own = far.argmin(axis=0) if len(rest) else np.zeros(0, dtype=np.int64)
        self.children: list[Node | np.ndarray] = []
        self.low, self.high = (np.zeros((len(self.splits), len(self.splits))) for _ in range(2))
        for j in range(len(self.splits)):
            below = rest[own == j]
            if len(below):
                reach = np.sqrt(far[:, own == j].astype(np.float64))
                self.low[:, j], self.high[:, j] = _down(reach.min(axis=1)), _up(reach.max(axis=1))
            self.children.append(below if len(below) <= leaf else Node(entries, below, fanout, leaf))

    @staticmethod
    def _far_apart(points: np.ndarray, count: int) -> list[int]:
        """Places of points, each the farthest from those before it."""
        chosen = [0]
        gap = _squares(points, points[:1])[:, 0]
        while len(chosen) < min(count, len(points)):
            gap[chosen] = -1
            chosen.append(int(gap.argmax()))
            gap = np.minimum(gap, _squares(points, points[chosen[-1:]])[:, 0])
        return chosen


class Gnat:
    """Nearest entry of a codebook, ties to the lower number."""

    def __init__(self, entries: np.ndarray, fanout: int = FANOUT, leaf: int = LEAF):
        self.entries = entries
        members = np.arange(len(entries))
        self.root = members if len(entries) <= leaf else Node(entries, members, fanout, leaf)

    def nearest(self, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Entry number and squared distance of each query."""
        best = np.full(len(queries), np.iinfo(np.int64).max)
        entry = np.full(len(queries), len(self.entries))
        self._visit(self.root, queries, np.arange(len(queries)), best, entry)
        return entry, best

    def _compare(self, numbers: np.ndarray, queries: np.ndarray, rows: np.ndarray, best: np.ndarray, entry: np.ndarray) -> np.ndarray:
        # ``numbers`` ascend, so argmin takes the lowest of equal ones.
        squares = _squares(queries[rows], self.entries[numbers])
        at = squares.argmin(axis=1)
        near, number = squares[np.arange(len(rows)), at], numbers[at]
        better = (near < best[rows]) | ((near == best[rows]) & (number < entry[rows]))
        best[rows[better]], entry[rows[better]] = near[better], number[better]
        return squares

    def _visit(self, node: Node | np.ndarray, queries: np.ndarray, rows: np.ndarray, best: np.ndarray, entry: np.ndarray) -> None:
        if not len(rows):
            return
        if isinstance(node, np.ndarray):
            if len(node):
                self._compare(node, queries, rows, best, entry)
            return
        squares = self._compare(node.splits, queries, rows, best, entry)
        distance = np.sqrt(squares.astype(np.float64))
        least, most = _down(distance), _up(distance)
        own = squares.argmin(axis=1)
        for j, child in enumerate(node.children):
            self._visit(child, queries, rows[own == j], best, entry)
        for j, child in enumerate(node.children):
            radius = _up(np.sqrt(best[rows].astype(np.float64)))[:, None]
            out = (_down(least - radius) > node.high[:, j]) | (_up(most + radius) < node.low[:, j])
            self._visit(child, queries, rows[(own != j) & ~out.any(axis=1)], best, entry)


@dataclass(frozen=True)
class Codebooks:
    """Entries by part: ``int64[parts, entries, components]``."""

    entries: np.ndarray

    def digest(self) -> str:
        """SHA-256 of all components in decimal, joined by commas."""
        return hashlib.sha256(",".join(map(str, self.entries.ravel().tolist())).encode()).hexdigest()

    def assign(self, vectors: np.ndarray, trees: list[Gnat]) -> tuple[np.ndarray, np.ndarray]:
        """Entry number and squared distance of each part of each vector."""
        parts = vectors.reshape(len(vectors), self.entries.shape[0], self.entries.shape[2])
        found = [tree.nearest(np.ascontiguousarray(parts[:, p])) for p, tree in enumerate(trees)]
        return np.stack([f[0] for f in found], axis=1), np.stack([f[1] for f in found], axis=1)

    def decode(self, code: str) -> list[int]:
        """The integer vector that a code stands for."""
        numbers = bytes.fromhex(code)
        return [int(x) for part, n in zip(self.entries, numbers) for x in part[n]]


def _blocks(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Slices of the batches with their vectors as a matrix."""
    for batch in batches:
        for at in range(0, batch.num_rows, ROWS):
            part = batch.slice(at, ROWS)
            yield part, part.column("q").flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(part.num_rows, width)


def _sums(books: Codebooks):
    """Task function: count and component sums of the parts each entry is nearest to."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, entries, size = books.entries.shape
        trees = [Gnat(e) for e in books.entries]
        n, s = np.zeros((parts, entries), dtype=np.int64), np.zeros((parts, entries, size), dtype=np.int64)
        for _, vectors in _blocks(batches, parts * size):
            numbers, _ = books.assign(vectors, trees)
            cut = vectors.reshape(len(vectors), parts, size)
            for p in range(parts):
                n[p] += np.bincount(numbers[:, p], minlength=entries)
                np.add.at(s[p], numbers[:, p], cut[:, p])
        part, entry = np.nonzero(n)
        if len(part):
            yield pa.RecordBatch.from_pydict({"part": part.astype(np.int32), "entry": entry.astype(np.int32), "n": n[part, entry], "s": pa.array(list(s[part, entry]), type=pa.list_(pa.int64()))})

    return task


def _refitted(rows: DataFrame, books: Codebooks) -> Codebooks:
    """One round: all parts assigned, each entry moved to the floored mean of its parts."""
    sums = rows.select("q").mapInArrow(_sums(books), "part int, entry int, n long, s array<long>")
    size = books.entries.shape[2]
    wide = [F.sum(F.col("s")[i].cast("decimal(38,0)")).alias(f"s{i}") for i in range(size)]
    entries = books.entries.copy()
    # A row for each used entry of each part: the size of the codebooks.
    for row in sums.groupBy("part", "entry").agg(F.sum("n").alias("n"), *wide).collect():
        entries[row["part"], row["entry"]] = [int(row[f"s{i}"]) // row["n"] for i in range(size)]
    return Codebooks(entries)


def _coded(books: Codebooks):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees = [Gnat(e) for e in books.entries]
        width = books.entries.shape[0] * books.entries.shape[2]
        for batch, vectors in _blocks(batches, width):
            numbers, squares = books.assign(vectors, trees)
            codes = [bytes(row).hex() for row in numbers.astype(np.uint8)]
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), batch.column("label"), pa.array(codes), pa.array(squares.sum(axis=1))], names=["vec_id", "label", "code", "error"])

    return task


def _usable(vector: Column) -> Column:
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return vector.isNotNull() & F.coalesce(finite, F.lit(False))


def integer_vectors(vectors: DataFrame, parts: int = PARTS, work_dir: str | None = None) -> tuple[DataFrame, int]:
    """``vec_id, label, q`` of the vectors that take part, and the components of ``q``."""
    real = vectors.select("vec_id", "label", F.col("embedding").cast("array<double>").alias("x")).where(_usable(F.col("x")))
    longest = real.agg(F.max(F.size("x"))).first()[0] or 0
    width = parts * max(1, -(-longest // parts))
    limit = 1 << ((62 - width.bit_length()) // 2 - 1)
    small = real.where(F.forall("x", lambda v: F.abs(v * SCALE) < limit - 1))
    whole = F.transform("x", lambda v: F.floor(v * SCALE).cast("long"))
    filled = F.concat(whole, F.array_repeat(F.lit(0).cast("long"), F.lit(width) - F.size("x")))
    return materialized(small.select("vec_id", "label", filled.alias("q")), "gnat-rows", work_dir), width


def compress(vectors: DataFrame, *, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, work_dir: str | None = None) -> tuple[DataFrame, Codebooks]:
    """``vec_id, label, code, error`` of each vector, and the codebooks.

    ``entries`` is 256 at most, as a code has two hex digits for each part. The first codebooks
    are the vectors of the smallest ids.
    """
    if not 1 <= entries <= 256:
        raise ValueError("entries must be 1 to 256")
    rows, width = integer_vectors(vectors, parts, work_dir)
    first = rows.select("vec_id", "q").orderBy(F.col("vec_id").asc_nulls_last(), "q").limit(entries).collect()
    start = np.array([r["q"] for r in first], dtype=np.int64).reshape(len(first), parts, width // parts)
    books = Codebooks(np.ascontiguousarray(start.transpose(1, 0, 2)))
    types = {f.name: f.dataType.simpleString() for f in rows.schema.fields}
    schema = f"vec_id {types['vec_id']}, label {types['label']}, code string, error long"
    if not first:
        return rows.sparkSession.createDataFrame([], schema), books
    for _ in range(rounds):
        books = _refitted(rows, books)
    return materialized(rows.mapInArrow(_coded(books), schema), "gnat-codes", work_dir), books


def with_label_error(codes: DataFrame, work_dir: str | None = None) -> DataFrame:
    """``codes`` with ``label_error``, the error summed over equal labels, nulls together."""
    total = codes.groupBy("label").agg(F.sum(F.col("error").cast("decimal(38,0)")).alias("s"))
    total = materialized(total.select(F.col("label").alias("same"), F.col("s").try_cast("long").alias("label_error")), "gnat-labels", work_dir)
    # Both sides are shuffled for this join alone, so a hot label is split.
    return codes.join(total, F.col("label").eqNullSafe(F.col("same"))).drop("same")


SQL = """
WITH kept AS (SELECT row_number() OVER () AS r, vec_id, label, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS q
  FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
cut AS (SELECT r, p, list_slice(q, p * len(q) // 16 + 1, (p + 1) * len(q) // 16) AS v FROM kept, range(16) t(p)),
b0 AS (SELECT p, e, v FROM (SELECT r, row_number() OVER (ORDER BY vec_id) - 1 AS e FROM kept) JOIN cut USING (r) WHERE e < 64),
"""
for _k in range(3):
    SQL += f"""
d{_k} AS (SELECT r, c.p, e, list_sum(list_transform(list_zip(c.v, b.v), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT AS d FROM cut c JOIN b{_k} b ON c.p = b.p),
a{_k} AS (SELECT r, p, arg_min(e, (d, e)) AS e, min(d) AS d FROM d{_k} GROUP BY r, p),
m{_k} AS (SELECT p, e, list(x ORDER BY i) AS v FROM (SELECT p, e, i, floor(sum(v[i]) / count(*))::BIGINT AS x FROM a{_k} JOIN cut USING (r, p), range(1, 1 + (SELECT max(len(v)) FROM cut)) t(i) GROUP BY p, e, i) GROUP BY p, e),
b{_k + 1} AS (SELECT b.p, b.e, coalesce(m.v, b.v) AS v FROM b{_k} b LEFT JOIN m{_k} m ON b.p = m.p AND b.e = m.e),"""
SQL += """
h AS (SELECT sha256(string_agg(array_to_string(v, ','), ',' ORDER BY p, e)) AS codebooks_sha256 FROM b2),
f AS (SELECT r, string_agg(printf('%02x', e), '' ORDER BY p) AS code, sum(d)::BIGINT AS error FROM a2 GROUP BY r)
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, codebooks_sha256 FROM f JOIN kept USING (r), h
"""
