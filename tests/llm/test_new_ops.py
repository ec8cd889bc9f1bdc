"""Vector codes, source divergence and repeated windows against brute force on small tables."""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from ratingscope.llm import divergence, gnat, repeats

WORD = re.compile(r"[^\x20\x09-\x0D]+")
TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


# --- op11: GNAT over entries ---------------------------------------------------------------


@settings(max_examples=60, deadline=None)
@given(st.integers(0, 2**32 - 1), st.integers(1, 90), st.integers(1, 5), st.sampled_from([2, 40, 2**26 - 1]))
def test_gnat_finds_the_nearest_entry_and_lowest_of_ties(seed, n, size, reach):
    rng = np.random.default_rng(seed)
    entries, queries = rng.integers(-reach, reach + 1, (n, size)), rng.integers(-reach, reach + 1, (50, size))
    queries = np.concatenate([queries, entries])
    squares = np.square(queries[:, None] - entries[None]).sum(axis=2)
    number, square = gnat.Gnat(entries, fanout=3, leaf=2).nearest(queries)
    assert (number == squares.argmin(axis=1)).all() and (square == squares.min(axis=1)).all()


def test_gnat_leaves_out_subtrees():
    """Clustered entries: most of them are never compared."""
    rng = np.random.default_rng(5)
    centres = rng.integers(-100_000, 100_000, (8, 4))
    entries = np.repeat(centres, 8, axis=0) + rng.integers(-50, 50, (64, 4))
    tree, compared = gnat.Gnat(entries), []
    plain = tree._compare
    tree._compare = lambda numbers, queries, rows, *more: compared.append(len(numbers) * len(rows)) or plain(numbers, queries, rows, *more)
    tree.nearest(np.repeat(centres, 20, axis=0))
    assert sum(compared) < 0.4 * 64 * 160


def _codes_by_hand(rows, parts, entries, rounds):
    kept = [(i, lab, [int(np.floor(256 * float(np.float32(x)))) for x in v]) for i, lab, v in rows if v is not None and all(x is not None and np.isfinite(x) for x in v)]
    width = parts * max(1, -(-max((len(v) for *_, v in kept), default=0) // parts))
    kept = [(i, lab, v + [0] * (width - len(v))) for i, lab, v in kept]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[2]))
    size = width // parts
    cut = lambda v, p: v[p * size : (p + 1) * size]
    books = [[cut(v, p) for *_, v in kept[:entries]] for p in range(parts)]

    def nearest(p, x):
        return min((sum((a - b) ** 2 for a, b in zip(x, e)), n) for n, e in enumerate(books[p]))

    for _ in range(rounds):
        found = [[nearest(p, cut(v, p))[1] for p in range(parts)] for *_, v in kept]
        for p in range(parts):
            groups = defaultdict(list)
            for f, (*_, v) in zip(found, kept):
                groups[f[p]].append(cut(v, p))
            for n, g in groups.items():
                books[p][n] = [sum(x) // len(g) for x in zip(*g)]
    out, by_label = [], Counter()
    for i, lab, v in kept:
        best = [nearest(p, cut(v, p)) for p in range(parts)]
        out.append((i, lab, "".join(f"{n:02x}" for _, n in best), sum(d for d, _ in best)))
        by_label[lab] += out[-1][3]
    digest = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    return Counter((i, c, e, by_label[lab]) for i, lab, c, e in out), digest


@pytest.mark.parametrize("n", [0, 1, 5, 300])
def test_codes_equal_brute_force(spark, n):
    rng = random.Random(n)
    rows = [(rng.randrange(2 * n), rng.choice([None, 1, 2]), [rng.uniform(-1, 1) for _ in range(8)]) for _ in range(n)]
    if n > 5:
        # Repeated rows and ids, ties, shorter vectors, and vectors that take no part.
        rows += rows[:9] + [(None, 1, [0.5] * 8), (3, None, [0.25, -0.5]), (4, 2, [])]
        rows += [(5, 1, None), (6, 1, [0.1, None]), (7, 1, [float("nan")]), (8, 1, [float("inf")] * 8), (9, 2, [1e30] * 8)]
    # Columns with the names the operator uses inside.
    df = spark.createDataFrame([(*r, "x", 7) for r in rows], "vec_id long, label int, embedding array<float>, q string, code int").repartition(3)
    codes, books = gnat.compress(df, parts=4, entries=16)
    got = Counter(map(tuple, gnat.with_label_error(codes).select("vec_id", "code", "error", "label_error").collect()))
    want, digest = _codes_by_hand([r for r in rows if r[2] != [1e30] * 8], 4, 16, 2)
    assert got == want
    if n:
        assert books.digest() == digest
        code = next(iter(want))[1]
        assert len(books.decode(code)) == 8


# --- op12: K-squared quadtree --------------------------------------------------------------


@settings(max_examples=40, deadline=None)
@given(st.integers(0, 2**32 - 1), st.sampled_from([8, 16, 64]), st.integers(0, 128), st.sampled_from([0.0, 0.01, 0.3, 1.0]))
def test_joint_walk_equals_cell_by_cell(seed, rows, width, filled):
    rng = np.random.default_rng(seed)
    columns = 8
    while columns < width:
        columns *= 2
    sides = []
    for _ in range(2):
        there = (rng.random((rows, columns)) < filled) & (np.arange(columns) < width)
        zero = rng.integers(1, 50, rows)
        sides.append((np.where(there, rng.integers(1, 1000, (rows, columns)), zero[:, None]) * (np.arange(columns) < width), zero, there))
    (p, y, m), (q, z, n) = sides
    want = np.abs(p[:, None] - q[None]).sum(axis=2)
    assert (divergence.tile_differences((p, q), (y, z), (m, n), width) == want).all()


def _divergence_by_hand(rows, least, top):
    docs = [(lang or "", source or "", TERM.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))) for lang, source, text in rows]
    out = Counter()
    for lang in {d[0] for d in docs}:
        mine = [d for d in docs if d[0] == lang]
        df = Counter(t for d in mine for t in set(d[2]))
        kept = sorted(t for t in df if df[t] >= least)
        groups = {s: Counter(t for d in mine if d[1] == s for t in d[2] if df[t] >= least) for s in {d[1] for d in mine}}
        whole = sum(groups.values(), Counter())
        share = lambda c: {t: 1 + 1_000_000_000 * (c[t] + 5) // (sum(c.values()) + 5 * len(kept)) for t in kept}
        q, p = share(whole), {s: share(c) for s, c in groups.items()}
        for s in groups:
            pair = sorted((-sum(abs(p[s][t] - p[o][t]) for t in kept), o.encode()) for o in groups if o != s)
            term = sorted((q[t] - p[s][t], t.encode()) for t in kept if groups[s][t] and p[s][t] > q[t])[:top]
            for part, found in (("pair", pair), ("term", term)):
                out.update((lang, s, part, item.decode(), -v, r) for r, (v, item) in enumerate(found, 1))
    return out


@pytest.mark.parametrize(("n", "sources"), [(0, 1), (1, 1), (400, 3), (900, 30)])
def test_divergence_equals_brute_force(spark, n, sources):
    rng = random.Random(n)
    words = [f"{c}{d}" for c in "abcdefghijkl" for d in "xyzé"] + ["ÜBER", "Mixed", "naïve", "𝒳y"]
    rows = [(rng.choice(["en", "en", "fr", None]), rng.choice([None, *map(str, range(sources))]), " ".join(rng.choices(words, k=rng.randrange(12))) + rng.choice(["", "!1", "\x00A[b`c{d\x7fe"])) for _ in range(n)]
    if n > 1:
        rows += rows[:7] + [("xx", "only", "a b"), ("yy", "s", None), ("yy", "t", ""), ("en", "none", "qqq"), ("en", "long", "ax " * 30_000)]
    df = spark.createDataFrame([(*r, 1, "t") for r in rows], "lang string, source string, text string, n int, term string").repartition(3)
    # Small tiles, so that groups and terms fall into several.
    got = divergence.source_divergence(df, least_docs=5, top=4, rows=8, columns=8)
    assert Counter(map(tuple, got.select("lang", "source", "part", "item", "value", "rank").collect())) == _divergence_by_hand(rows, 5, 4)


def test_counts_are_handed_on_in_parts(spark, monkeypatch):
    monkeypatch.setattr(divergence, "HELD", 3)
    batch = spark.createDataFrame([("l", "s", "a b c a"), ("l", "t", "a"), ("l", "s", "a d")], "lang string, source string, text string").toArrow()
    n = Counter()
    for part in divergence._counted(iter(batch.to_batches())):
        for row in part.to_pylist():
            n[row["source"], row["term"]] += row["n"]
    assert n == {("s", "a"): 3, ("s", "b"): 1, ("s", "c"): 1, ("t", "a"): 1, ("s", "d"): 1}


# --- op13: Rabin-Karp windows --------------------------------------------------------------


def _repeats_by_hand(rows, window):
    first: dict[tuple, int] = {}
    for doc_id, text in rows:
        words = WORD.findall(text or "")
        for i in range(len(words) - window + 1 if doc_id is not None else 0):
            key = tuple(words[i : i + window])
            first[key] = min(first.get(key, doc_id), doc_id)
    out = Counter()
    for doc_id, text in rows:
        words = WORD.findall(text or "")
        gone = set()
        for i in range(len(words) - window + 1 if doc_id is not None else 0):
            if first[tuple(words[i : i + window])] < doc_id:
                gone.update(range(i, i + window))
        out[doc_id, len(words), len(gone), " ".join(w for i, w in enumerate(words) if i not in gone)] += 1
    return out


@pytest.mark.parametrize(("n", "block"), [(0, 50), (1, 50), (300, 50), (300, 500_000)])
def test_repeats_equal_brute_force(spark, n, block):
    rng = random.Random(n)
    passages = [[f"w{rng.randrange(40)}" for _ in range(rng.randrange(3, 30))] for _ in range(8)]
    rows = []
    for i in range(n):
        parts = [rng.choice(passages) if rng.random() < 0.4 else [f"w{rng.randrange(40)}" for _ in range(rng.randrange(9))] for _ in range(6)]
        rows.append((i * 3 % 200, rng.choice([" ", "\n", "\t "]).join(w for p in parts for w in p)))
    if n > 1:
        # A third of the rows hold one passage; one word repeated; equal ids and texts; nulls.
        rows += [(1000 + i, " ".join(passages[0] * 3)) for i in range(150)]
        rows += [(5, "x " * 2000), (4, "x " * 9), (6, "x " * 700), (7, "a b " * 400), (8, "b a " * 300)]
        rows += [(9, None), (10, ""), (11, " \n"), (None, rows[0][1]), (None, None), (12, "é ü ß " * 30), (13, "é ü ß " * 30)]
        rows += rows[:5]
    df = spark.createDataFrame([(*r, "k", 1) for r in rows], "doc_id long, text string, hash string, kept int").repartition(4)
    got = repeats.remove_repeats(df, window=5, block=block).collect()
    assert Counter((r["doc_id"], r["n_words"], r["n_removed"], r["kept"]) for r in got) == _repeats_by_hand(rows, 5)
    for r in got:
        assert sum(s["end"] - s["start"] for s in r["removed"]) == r["n_removed"]
        # Maximal: intervals ascend and neither touch nor overlap.
        assert all(a["end"] < b["start"] for a, b in zip(r["removed"], r["removed"][1:]))


def test_window_hash_depends_on_its_words_alone():
    hasher = repeats.Hasher(3)
    one, _ = hasher.windows([b"a", b"b", b"c", b"d", b"e"])
    other, _ = hasher.windows([b"z"] * 5000 + [b"b", b"c", b"d"])
    assert one[1] == other[-1] and len(set(one.tolist())) == 3 and one[0] != other[-1]
