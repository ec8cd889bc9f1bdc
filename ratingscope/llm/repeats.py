"""Removal of passages that an earlier document holds too.

Every window of WINDOW words gets Rabin-Karp hashes: word hashes times powers of an odd base,
summed up once along the text, so that a window is the difference of two sums whatever its
length. The windows of all documents meet by hash in one shuffle, where a window that occurs in
a document of smaller id is found repeated. A window is told by 64 bits of one hash and 15 of a
second one with another base, so among 10^13 windows some hundred may be taken for another.
These, a bit that says "settled" and 48 bits that tell texts of one doc_id apart travel as two
longs: rows of one text then differ in ten bytes that lie together, and the shuffle's
compression takes the rest.

Before the shuffle each block of documents settles what it can: of the windows with one hash
only that of the smallest id still needs to be compared with other blocks; the others are
repeated already and travel spread by their document. So a passage that many documents share
sends one row from each block, and no key is hot.

Back at the text, the repeated windows merge into maximal intervals of words, which go.

Edge cases. Null and empty texts have no words; a text of fewer words than a window loses none.
Rows with a null doc_id lose nothing and take nothing from others. Rows that share a doc_id do
not count as earlier than each other; each loses what a smaller id holds. An empty table gives
no rows. Other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..workdir import materialized, shuffle_files_freed

# Fixed value of the task: words of a window.
WINDOW = 13
SEED = 13
# Odd bases of the two hashes, as random bits.
BASES = tuple(xxhash.xxh64_intdigest(b"base %d" % i, SEED) | 1 for i in range(2))
# Low bits of a tag: whether the window is settled, then the second hash. Above: the text.
TAG_BITS = 16
# Windows of a block, and words whose hash a worker remembers.
BLOCK, MEMO = 500_000, 400_000


class WordHashes(dict):
    """64-bit hash of a word, remembered."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= MEMO:
            self.clear()
        found = self[word] = xxhash.xxh64_intdigest(word, SEED)
        return found


def words_of(text: str | None) -> list[bytes]:
    """Runs of characters other than space, tab, line feed, vertical tab, form feed and return."""
    return (text or "").encode("utf-8", "surrogatepass").split()


def _powers(base: int, count: int) -> np.ndarray:
    """base^0 to base^(count - 1), modulo 2^64."""
    out = np.full(count, base, dtype=np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


class Hasher:
    """Hashes of all windows of a text."""

    def __init__(self, window: int):
        self.window, self.hash = window, WordHashes()
        self.powers = [(np.zeros(0, dtype=np.uint64),) * 2] * len(BASES)

    def _tables(self, count: int) -> list[tuple[np.ndarray, np.ndarray]]:
        """Powers of each base and of its inverse, for ``count`` words at least."""
        if len(self.powers[0][0]) < count:
            self.powers = [(_powers(b, 2 * count), _powers(pow(b, -1, 1 << 64), 2 * count)) for b in BASES]
        return self.powers

    def windows(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The two hashes of each window, the second one as the low bits of a tag."""
        count = len(words) - self.window + 1
        if count <= 0:
            return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
        codes = np.fromiter(map(self.hash.__getitem__, words), dtype=np.uint64, count=len(words))
        found = []
        for up, down in self._tables(len(words)):
            sums = np.concatenate([np.zeros(1, dtype=np.uint64), np.cumsum(codes * up[: len(words)], dtype=np.uint64)])
            found.append((sums[self.window :] - sums[:count]) * down[:count])
        return found[0].view(np.int64), (found[1] >> np.uint64(65 - TAG_BITS) << np.uint64(1)).view(np.int64)


def _settled(ids: list[int], hashes: list[np.ndarray], tags: list[np.ndarray]) -> pa.RecordBatch:
    """The windows of a block of texts, each once for a text, settled where it can be."""
    order = sorted(range(len(ids)), key=ids.__getitem__)
    owner = np.repeat(order, [len(hashes[i]) for i in order])
    h, tag = np.concatenate([hashes[i] for i in order]), np.concatenate([tags[i] for i in order])
    # Stable, so equal windows stand by ascending id.
    at = np.argsort(h, kind="stable")
    h, tag, owner = h[at], tag[at], owner[at]
    check = tag & ((1 << TAG_BITS) - 1)
    starts = np.ones(len(h), dtype=bool)
    starts[1:] = (h[1:] != h[:-1]) | (check[1:] != check[:-1])
    names = np.array(ids, dtype=np.int64)[owner]
    least = names[np.flatnonzero(starts)[np.cumsum(starts) - 1]]
    once = starts.copy()
    once[1:] |= owner[1:] != owner[:-1]
    # By text, so that neighbouring rows compress well.
    keep = np.flatnonzero(once)
    keep = keep[np.argsort(owner[keep], kind="stable")]
    columns = [h[keep], tag[keep] | (names > least)[keep], names[keep]]
    return pa.RecordBatch.from_arrays([pa.array(x) for x in columns], names=["hash", "tag", "doc_id"])


def _windows(window: int, block: int):
    """Task function: rows of (doc_id, print, text) to rows of windows."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher(window)
        ids, hashes, tags, held = [], [], [], 0
        seen: set[tuple[int, int]] = set()
        for batch in batches:
            for doc_id, text_tag, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                # A row that repeats id and text has the same windows.
                if (doc_id, text_tag) in seen:
                    continue
                h, check = hasher.windows(words_of(text.as_py()))
                if len(h):
                    seen.add((doc_id, text_tag))
                # A long text is dealt out over blocks.
                for at in range(0, len(h), block):
                    ids.append(doc_id), hashes.append(h[at : at + block]), tags.append(check[at : at + block] | text_tag)
                    held += len(hashes[-1])
                    if held >= block:
                        yield _settled(ids, hashes, tags)
                        ids, hashes, tags, held = [], [], [], 0
                        seen = {(doc_id, text_tag)}
        if held:
            yield _settled(ids, hashes, tags)

    return task


def _text_tag(text: Column) -> Column:
    """The bits of a tag that tell a text."""
    return F.xxhash64(text).bitwiseAND(-1 << TAG_BITS)


def repeated_windows(docs: DataFrame, *, window: int = WINDOW, block: int = BLOCK, work_dir: str | None = None) -> DataFrame:
    """``doc_id, text_tag, hashes``: for each text the windows that a document of smaller id holds.

    ``text_tag`` is a hash of the text. The list of a text is never longer than the text.
    """
    texts = docs.where(F.col("doc_id").isNotNull() & (F.length("text") >= 2 * window - 1))
    texts = texts.select(F.col("doc_id").cast("long"), _text_tag(F.col("text")), F.col("text").cast("string"))
    found = texts.mapInArrow(_windows(window, block), "hash long, tag long, doc_id long")
    check, text_tag = F.col("tag").bitwiseAND((1 << TAG_BITS) - 1), F.col("tag").bitwiseAND(-1 << TAG_BITS)
    # Settled windows travel under a key that is spread by text and gives the hash back.
    settled = F.col("tag").bitwiseAND(1) == 1
    spread = F.when(settled, F.xxhash64("doc_id", text_tag)).otherwise(F.lit(0).cast("long"))
    keyed = found.select(F.col("hash").bitwiseXOR(spread).alias("key"), "tag", "doc_id").repartition("key")
    least = F.min("doc_id").over(Window.partitionBy("key", check))
    repeated = keyed.withColumn("least", least).where(settled | (F.col("least") < F.col("doc_id")))
    hashes = repeated.select("doc_id", text_tag.alias("text_tag"), F.col("key").bitwiseXOR(spread).alias("hash"))
    # Sorted, as the table lies beside the large shuffle for a while.
    with shuffle_files_freed(docs.sparkSession):
        hashes = materialized(hashes.sortWithinPartitions("doc_id", "text_tag"), "repeats-windows", work_dir)
    lists = hashes.groupBy("doc_id", "text_tag").agg(F.collect_set("hash").alias("hashes"))
    with shuffle_files_freed(docs.sparkSession):
        return materialized(lists, "repeats-lists", work_dir)


def covered(places: np.ndarray, window: int) -> list[tuple[int, int]]:
    """Maximal intervals (start, end) of words that the windows at ascending ``places`` cover."""
    if not len(places):
        return []
    cuts = np.flatnonzero(np.diff(places) > window) + 1
    return [(int(run[0]), int(run[-1]) + window) for run in np.split(places, cuts)]


def _without(window: int):
    kind = pa.struct([("n_words", pa.int64()), ("n_removed", pa.int64()), ("removed", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))), ("kept", pa.string())])

    @F.arrow_udf("struct<n_words:long,n_removed:long,removed:array<struct<start:long,end:long>>,kept:string>")
    def without(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        hasher = Hasher(window)
        for texts, lists in batches:
            made = []
            for text, hashes in zip(texts, lists):
                words, spans, kept = words_of(text.as_py()), [], []
                if hashes.is_valid:
                    h, _ = hasher.windows(words)
                    spans = covered(np.flatnonzero(np.isin(h, hashes.values.to_numpy())), window)
                at = 0
                for start, end in spans:
                    kept += words[at:start]
                    at = end
                kept += words[at:]
                made.append({"n_words": len(words), "n_removed": len(words) - len(kept), "removed": [{"start": a, "end": b} for a, b in spans], "kept": b" ".join(kept).decode("utf-8", "replace")})
            yield pa.array(made, type=kind)

    return without


def remove_repeats(docs: DataFrame, *, window: int = WINDOW, block: int = BLOCK, work_dir: str | None = None) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, n_words, n_removed, removed, kept``.

    ``removed`` holds the maximal intervals of word places, end exclusive; ``kept`` the other
    words, joined by one space.
    """
    lists = repeated_windows(docs, window=window, block=block, work_dir=work_dir)
    lists = lists.select(F.col("doc_id").alias("id"), F.col("text_tag").alias("same"), "hashes")
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"), _text_tag(F.col("text")).alias("text_tag"))
    joined = rows.join(lists, (F.col("doc_id") == F.col("id")) & (F.col("text_tag") == F.col("same")), "left")
    return joined.select("doc_id", _without(window)("text", "hashes").alias("r")).select("doc_id", "r.*")


SQL = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT r, doc_id, i, list_slice(w, i, i + 12) AS g FROM d, unnest(range(1, len(w) - 11)) t(i)),
m AS (SELECT g, min(doc_id) AS first FROM s GROUP BY g),
c AS (SELECT DISTINCT r, i + k AS i FROM s JOIN m USING (g), range(13) t(k) WHERE first < doc_id),
k AS (SELECT r, list(i) AS gone FROM c GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(len(gone), 0)::BIGINT AS n_removed,
  sha256(array_to_string(list_transform(list_filter(range(1, len(w) + 1), lambda i: NOT coalesce(list_contains(gone, i), false)), lambda i: w[i]), ' ')) AS kept_sha256
FROM d LEFT JOIN k USING (r)
"""
