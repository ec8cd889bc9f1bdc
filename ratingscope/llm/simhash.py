"""SimHash near-duplicates by covering locality-sensitive hashing.

Each of the 64 bit positions gets a vector m of r + 1 bits. For every nonzero v of r + 1 bits
one table keeps the positions where <m, v> = 1 and blanks out the others. Any r differing
positions span at most r dimensions, so some nonzero v is orthogonal to all of them, and in
that table the two fingerprints collide: no pair within r bits is missed.

Buckets never turn into pairs. Equal fingerprints are folded first. A bucket of up to BUCKET
fingerprints gives a spanning forest of its links. A larger one is not collected at all: two
fingerprints within r bits share a midpoint, so each lists the points within r / 2 of it
(a fixed number, changing only bits its table leaves free), and equal points link, which is
linear in the bucket and spreads over all tasks.

Edge cases. Null and empty texts have fingerprint zero and link like any other. Repeated rows
share a component. A component with no doc_id at all has a null ``component_id``.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..workdir import materialized

# Fixed values of the task: seed, words in a shingle, differing bits of a link.
SEED, SHINGLE, RADIUS = 42, 4, 4
BITS = 64
# Most fingerprints of a bucket that one row may hold (8 bytes each).
BUCKET = 4096
# Hashes whose bits are counted at a time.
CHUNK = 8192


def shingle_hashes(text: str | None, shingle: int = SHINGLE) -> np.ndarray:
    """One hash for each run of ``shingle`` words of a text, or of the whole where it has fewer."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.zeros(0, dtype=np.uint64)
    joined = b" ".join(words)
    ends = (np.cumsum([len(w) + 1 for w in words]) - 1).tolist()
    starts = [0] + [e + 1 for e in ends[:-1]]
    spans = zip(starts, ends[shingle - 1 :]) if len(words) >= shingle else [(0, len(joined))]
    digest = xxhash.xxh64_intdigest
    return np.array([digest(joined[a:b], SEED) for a, b in spans], dtype=np.uint64)


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """SimHash of a whole text, unsigned."""
    hashes = shingle_hashes(text, shingle).astype(">u8")
    if not len(hashes):
        return 0
    ones = np.zeros(BITS, dtype=np.int64)
    for at in range(0, len(hashes), CHUNK):
        block = hashes[at : at + CHUNK]
        ones += np.unpackbits(block.view(np.uint8).reshape(len(block), 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(ones * 2 > len(hashes)).tobytes(), "big")


def fingerprints(text: Column) -> Column:
    """SimHash of each text as a signed long."""

    @F.arrow_udf("long")
    def prints(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in texts:
            made = np.fromiter((fingerprint(t.as_py()) for t in batch), dtype=np.uint64, count=len(batch))
            yield pa.array(made.view(np.int64))

    return prints(text)


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def covering_masks(radius: int = RADIUS) -> list[int]:
    """2^(r+1) - 1 masks such that any r bits are blank in at least one of them."""
    vectors = [i % ((2 << radius) - 1) + 1 for i in range(BITS)]
    return [
        sum(1 << i for i, m in enumerate(vectors) if (m & v).bit_count() % 2)
        for v in range(1, 2 << radius)
    ]


def spanning_forest(prints: list[int], radius: int = RADIUS) -> list[tuple[int, int]]:
    """Edges that connect the same fingerprints as all links within ``radius`` do."""
    rest = np.array(prints, dtype=np.int64)
    edges: list[tuple[int, int]] = []
    frontier: list[int] = []
    while len(rest):
        if not frontier:
            frontier, rest = [int(rest[0])], rest[1:]
            continue
        at = frontier.pop()
        near = np.bitwise_count((rest ^ at).view(np.uint64)) <= radius
        found = rest[near].tolist()
        edges.extend((at, other) for other in found)
        frontier.extend(found)
        rest = rest[~near]
    return edges


def _forest_udf(radius: int):
    @F.arrow_udf("array<struct<a:long,b:long>>")
    def forests(groups: Iterator[pa.Array]) -> Iterator[pa.Array]:
        kind = pa.list_(pa.struct([("a", pa.int64()), ("b", pa.int64())]))
        for batch in groups:
            made = [[{"a": a, "b": b} for a, b in spanning_forest(g, radius)] for g in batch.to_pylist()]
            yield pa.array(made, type=kind)

    return forests


def link_edges(prints: DataFrame, radius: int = RADIUS, bucket: int = BUCKET, work_dir: str | None = None) -> DataFrame:
    """Edges (a, b) that connect distinct fingerprints ``fp`` just as all links do."""
    masks = covering_masks(radius)
    keys = prints.select("fp", F.posexplode(F.array(*[F.col("fp").bitwiseAND(F.lit(_signed(m))) for m in masks])).alias("t", "k"))
    sizes = keys.groupBy("t", "k").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    sizes = materialized(sizes, "simhash-buckets", work_dir)
    shared = keys.join(sizes, ["t", "k"])
    small = shared.where(F.col("n") <= bucket).groupBy("t", "k").agg(F.collect_list("fp").alias("g"))
    edges = small.select(F.explode(_forest_udf(radius)("g")).alias("e")).select("e.a", "e.b")
    if not sizes.where(F.col("n") > bucket).isEmpty():
        half = (radius + 1) // 2
        changes = []
        for m in masks:
            free = [1 << i for i in range(BITS) if not m >> i & 1]
            changes.append([_signed(sum(c)) for k in range(half + 1) for c in combinations(free, k)])
        by_table = F.from_json(F.lit(str(changes)), "array<array<bigint>>")
        large = shared.where(F.col("n") > bucket)
        points = large.select("t", "k", "fp", F.explode(F.element_at(by_table, F.col("t") + 1)).alias("c"))
        # At most len(changes[t]) fingerprints reach one point, whatever the bucket holds.
        reach = points.groupBy("t", "k", F.col("fp").bitwiseXOR(F.col("c")).alias("z")).agg(F.collect_list("fp").alias("g")).where(F.size("g") > 1)
        edges = edges.unionByName(reach.select(F.array_min("g").alias("a"), F.explode("g").alias("b")).where("a != b"))
    return edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()


def components(edges: DataFrame, work_dir: str | None = None) -> DataFrame:
    """(``fp``, ``root``) for every node of ``edges`` (u > v): the smallest node it reaches.

    Alternates two star steps: the larger neighbours of a node, then the smaller ones, are
    hung below its smallest neighbour. The number of rounds grows with the logarithm of the
    longest chain; each is written to the shared folder, which cuts the lineage.
    """

    def state(df: DataFrame) -> tuple:
        return tuple(df.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())

    now = materialized(edges, "simhash-edges", work_dir)
    seen = state(now)
    while True:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = materialized(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")), "simhash-least", work_dir)
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = materialized(large, "simhash-large", work_dir)
        least = materialized(large.groupBy("u").agg(F.min("v").alias("m")), "simhash-least", work_dir)
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v")
        now = materialized(small.unionByName(least.select("u", F.col("m").alias("v"))).distinct(), "simhash-edges", work_dir)
        last, seen = seen, state(now)
        if last == seen:
            return now.select(F.col("u").alias("fp"), F.col("v").alias("root")).unionByName(now.select(F.col("v").alias("fp"), F.col("v").alias("root")).distinct())


def simhash_components(docs: DataFrame, *, radius: int = RADIUS, bucket: int = BUCKET, work_dir: str | None = None) -> DataFrame:
    """One row per document: ``doc_id, fp`` (signed long), ``fingerprint, component_id``."""
    rows = materialized(docs.select("doc_id", fingerprints(F.col("text")).alias("fp")), "simhash-rows", work_dir)
    prints = materialized(rows.groupBy("fp").agg(F.min("doc_id").alias("lowest")), "simhash-prints", work_dir)
    roots = components(link_edges(prints.select("fp"), radius, bucket, work_dir), work_dir)
    rooted = prints.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    rooted = materialized(rooted, "simhash-roots", work_dir)
    lowest = materialized(rooted.groupBy("root").agg(F.min("lowest").alias("component_id")), "simhash-lowest", work_dir)
    label = materialized(rooted.join(lowest, "root").select("fp", "component_id"), "simhash-labels", work_dir)
    # Both sides are shuffled for this join alone, so a hot fingerprint is split.
    return rows.join(label, "fp").select("doc_id", "fp", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def drop_near_duplicates(docs: DataFrame, *, radius: int = RADIUS, bucket: int = BUCKET, work_dir: str | None = None) -> DataFrame:
    """``docs`` with one row of each component of links: the one with the smallest doc_id, then
    text hash; rows without a doc_id come last. Rows that repeat both are one document.
    """
    first = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", F.xxhash64("text").alias("text_hash"))
    prints = docs.select(first.alias("m"), fingerprints(F.col("text")).alias("fp")).groupBy("fp").agg(F.min("m").alias("m"))
    prints = materialized(prints, "near-prints", work_dir)
    roots = components(link_edges(prints.select("fp"), radius, bucket, work_dir), work_dir)
    rooted = prints.join(roots, "fp", "left").groupBy(F.coalesce("root", "fp").alias("root"))
    keep = rooted.agg(F.min("m").alias("m")).select(F.col("m.doc_id").alias("keep_id"), F.col("m.text_hash").alias("keep_hash"))
    # Packed, so that columns of any name come through.
    rows = docs.select(F.struct("*").alias("row"), F.xxhash64("text").alias("hash"))
    kept = rows.join(keep, F.col("row.doc_id").eqNullSafe(F.col("keep_id")) & (F.col("hash") == F.col("keep_hash")), "left_semi")
    one = Window.partitionBy("row.doc_id", "hash").orderBy(F.xxhash64("row"))
    return kept.select("row", F.row_number().over(one).alias("at")).where("at = 1").select("row.*")
