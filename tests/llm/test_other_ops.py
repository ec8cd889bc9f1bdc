"""Nearest neighbours, archives, page extraction and the pipeline, on small tables."""

from __future__ import annotations

import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from ratingscope.llm import ann, pages, warc

# -- nearest neighbours ---------------------------------------------------------


def exact(vectors, queries, k):
    out = []
    for q in queries:
        scores = sorted(((-float(np.dot(vectors[q], v)), i) for i, v in vectors.items() if i != q))
        out += [(q, n, i, -s) for n, (s, i) in enumerate(scores[:k], 1)]
    return out


def table(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")


def test_probing_retrieves_every_code_in_the_radius():
    rng = np.random.default_rng(0)
    codes = rng.integers(0, 1 << 63, size=(300, 4), dtype=np.uint64)
    codes[100:200] = codes[:100] ^ (np.uint64(1) << rng.integers(0, 63, size=(100, 4)).astype(np.uint64))
    index = ann.SubstringIndex(codes)
    distance = np.bitwise_count(codes[:50, None] ^ codes[None]).sum(axis=2)
    for radius in (0, 3, 4, 15, 16, 40, 100, 130):
        q, row = index.within(codes[:50], radius)
        assert set(zip(q, row)) == set(zip(*np.nonzero(distance <= radius)))


def test_recall_and_scores(spark):
    rng = np.random.default_rng(2)
    centers = rng.normal(size=(12, 24))
    data = {i: (centers[i % 12] + 0.6 * rng.normal(size=24)).astype(np.float32) * (1 + i % 3) for i in range(1500)}
    rows = [(i, [float(x) for x in v], 0) for i, v in data.items()]
    got = ann.nearest(table(spark, rows)).collect()
    want = exact({i: v.astype(float) for i, v in data.items()}, [i for i in data if i % 20 == 0], 20)
    assert len(got) == len(want)
    found = {(r.query_id, r.vec_id) for r in got}
    assert len(found & {(q, i) for q, _, i, _ in want}) >= 0.9 * len(want)
    for r in got[:200]:
        assert r.score == pytest.approx(float(np.dot(data[r.query_id].astype(float), data[r.vec_id].astype(float))))


def test_ties_and_hot_vectors(spark):
    same = [1.0] + [0.0] * 7
    rows = [(i, same, 0) for i in range(400)] + [(400 + i, [0.5] * 8, 0) for i in range(20)]
    got = {}
    for r in ann.nearest(table(spark, rows)).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id))
    assert [v for _, v in sorted(got[40])] == list(range(20))
    assert [v for _, v in sorted(got[0])] == list(range(1, 21))


def test_odd_vectors_take_no_part(spark):
    rows = [(0, [1.0, 0.0], 0), (20, [0.0, 1.0], 0), (1, None, 0), (2, [], 0), (3, [0.0, 0.0], 0), (4, [float("nan"), 1.0], 0), (5, [float("inf"), 1.0], 0), (6, [None, 1.0], 0), (7, [1.0], 0), (None, [1.0, 1.0], 0), (0, [1.0, 0.0], 0), (8, [2.0, 1.0], 0)]
    got = sorted((r.query_id, r.rank, r.vec_id, r.score) for r in ann.nearest(table(spark, rows)).collect())
    assert got == [(0, 1, 8, 2.0), (0, 2, 20, 0.0), (20, 1, 8, 1.0), (20, 2, 0, 0.0)]
    assert ann.nearest(table(spark, [])).count() == 0
    assert ann.nearest(table(spark, [(0, [1.0], 0)])).count() == 0


# -- archives -------------------------------------------------------------------

PAGES = "page_id long, url string, html string, extra string"


def report(rows):
    return sorted(((r.page_id is None, r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in rows), key=str)


def test_archive_round_trip(spark, tmp_path):
    rng = random.Random(1)
    big = "".join(rng.choice("abcé日\r\nWARC/1.1 0\r\n\r\n") for _ in range(400_000))
    same = "<p>" + "copy " * 40
    rows = [(9, "http://a/é?q=1 2", same, "x"), (3, None, same, "x"), (5, "u", same, None), (1, "u", None, None), (2, "u", "", None), (4, "u", "short", None), (6, "u", "short", None), (7, "u", big, None), (8, "u", big, None), (None, "u", same, None), (10, "u", "x" * 99, None), (11, "u", "x" * 99, None), (12, "u", big + "2", None), (12, "u", big + "2", None)]
    df = spark.createDataFrame(rows, PAGES)
    first = {}
    for page, _, html, _ in rows:
        body = (html or "").encode()
        if len(body) >= 100 and page is not None:
            first[body] = min(page, first.get(body, page))
    expected = []
    for page, _, html, _ in rows:
        body = (html or "").encode()
        to = first.get(body) if body in first and first[body] != page else None
        expected.append((page is None, page, len(body), hashlib.sha256(body).hexdigest(), "revisit" if to is not None else "response", to))
    got = warc.archive_and_read(df).collect()
    assert report(got) == sorted(expected, key=str)
    assert warc.archive_and_read(df.limit(0)).count() == 0

    path = f"file://{tmp_path}/w"
    warc.write_archives(df, path, segment=10_000)
    found = warc.read_records(spark, path).groupBy("kind").count().collect()
    assert dict(map(tuple, found))["continuation"] > 100
    texts = {r.page_id: bytes(r.payload) for r in warc.read_pages(spark, path).where("payload is not null").collect()}
    assert texts[7] == big.encode() and texts[12] == (big + "2").encode() and 8 not in texts


def test_missing_segments_are_an_error(spark):
    rows = [(1, "a", "response", "o", 1, None, "d", None, bytearray(b"x")), (1, "b", "continuation", "o", 3, 3, "d", None, bytearray(b"z"))]
    with pytest.raises(Exception, match="segments missing"):
        warc.assembled(spark.createDataFrame(rows, warc.RECORDS)).collect()


def test_chunks():
    for data in (b"", b"a", b"x" * 8192, b"y" * 20000, b"0\r\n\r\n"):
        assert warc.dechunked(warc.chunked(data)) == data
    with pytest.raises(ValueError):
        warc.dechunked(b"5\r\nab\r\n0\r\n\r\n")
    with pytest.raises(ValueError):
        list(warc.parse(warc.record({"WARC-Type": "x"}, b"abc")[:-3]))


# -- pages ----------------------------------------------------------------------


def test_blocks():
    html = """<!doctype html><head><title>T</title><style>p{}</style></head><body><nav><ul><li><a href="/x">One</a><li>Two</ul></nav>
    <!-- <p>no</p> --><article class="Post main"><h1>A &amp; B</h1><p>first <b>bold</b>
    text<br>more<p>second &lt;x&gt;<script>var t = "</p>";</script> end</article><footer>&copy; z"""
    found = pages.blocks_of(html)
    assert [b.text for b in found] == ["One", "Two", "A & B", "first bold text more", "second <x>", "end", "© z"]
    assert found[0].linked == 1.0 and "nav" in found[0].path and ".post" in found[3].path and found[-1].path[-1] == "footer"
    assert pages.blocks_of(None) == pages.blocks_of("") == pages.blocks_of("<p></p> <div> ") == []
    assert [b.text for b in pages.blocks_of("plain < text > only <b")] == ["plain < text > only <b"]


def test_unclosed_options_and_formulas_lose_no_text():
    said = lambda html: [b.text for b in pages.blocks_of(html)]
    article = "<article><p>all of it</p></article>"
    assert said(f"<datalist><option value=a><option value=b></datalist>{article}") == ["all of it"]
    assert said(f"<option value=a>{article}<select><option>x</option></select><p>end") == ["all of it", "end"]
    assert said(f"<select><option>x<option>y</select>{article}") == ["all of it"]
    assert said(f"<noscript>{article}") == said(f"<svg>{article}") == ["all of it"]
    assert said("<p>so <math><mi>x</mi><mo>=</mo><mn>1</mn></math> holds</p>") == ["so x=1 holds"]
    assert said(f"<script>var x = 1;{article}") == []
    assert len(said("<svg>a<p>" * 40_000)) == 40_000


def test_deep_nesting_stays_small():
    """Time and memory of broken pages grow with their length, not with its square."""
    deep = "".join(f"<div class='c{i % 5}'>x{i}" for i in range(40_000))
    found = pages.blocks_of(deep + "</nav>" * 40_000 + "<h2>" * 40_000 + "</section>end")
    assert len(found) == 40_001 and found[-1].text == "end"
    assert max(len(b.path) for b in found) == 7 and len({id(b.path) for b in found}) < 10
    assert pages.blocks_of("<div><ul><li>a</div>b")[1].path == ()


def test_gradients_of_the_labeller():
    rng = np.random.default_rng(0)
    model = pages.Labeller(1)
    x, mask = rng.normal(size=(2, 4, pages.WIDTH)), np.array([[1, 1, 1, 1], [1, 1, 0, 0]], dtype=float)
    y = rng.integers(0, 2, size=(2, 4)).astype(float)

    def loss():
        p = np.clip(model.probabilities(x, mask), 1e-12, 1 - 1e-12)
        return float(-(mask * (y * np.log(p) + (1 - y) * np.log(1 - p))).sum() / mask.sum())

    for parameter, gradient in zip(model.parameters(), model.gradients(x, mask, y, mask)):
        at = tuple(int(rng.integers(n)) for n in parameter.shape)
        before = parameter[at]
        parameter[at] = before + 1e-5
        high = loss()
        parameter[at] = before - 1e-5
        low = loss()
        parameter[at] = before
        assert gradient[at] == pytest.approx((high - low) / 2e-5, rel=1e-3, abs=1e-7)


def _page(rng, kind):
    word = lambda n: " ".join(rng.choice(["alpha", "river", "stone", "night", "walk", "green", "cloud"]) for _ in range(n))
    body = [word(rng.randint(8, 60)) + "." for _ in range(rng.randint(1, 6))]
    open_, close = {"article": ("<article><h1>%s</h1>" % word(4), "</article>"), "main": ("<main>", "</main>"), "div": ("<div class='content'>", "</div>")}[kind]
    title = [b.text for b in pages.blocks_of(open_)]
    html = f"<html><body><nav><ul><li><a href=/a>{word(1)}</a></li></ul></nav><div class='ad'>{word(6)}</div>{open_}" + "".join(f"<p>{b}</p>" for b in body) + close
    if rng.random() < 0.5:
        html += f"<aside><p>{word(9)}</p></aside><section class='comments'><div class='comment'><p>{word(20)}</p></div></section><form><p>{word(5)}</p></form>"
    return html + f"<footer>&copy; {word(5)}</footer></body></html>", "\n".join(title + body)


def test_main_text(spark):
    rng = random.Random(4)
    made = [_page(rng, rng.choice(["article", "article", "main", "div"])) for _ in range(200)]
    rows = [(i, "u", html) for i, (html, _) in enumerate(made)] + [(1000, "u", None), (1001, None, ""), (1002, "u", "<p>" * 30_000)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    model = pages.fit_labeller(df)
    got = {r.page_id: r.text for r in df.select("page_id", pages.main_text(F.col("html"), model).alias("text")).collect()}
    assert sum(got[i] == text for i, (_, text) in enumerate(made)) >= 190
    assert got[1000] == got[1001] == got[1002] == ""
    assert df.limit(0).select(pages.main_text(F.col("html"), pages.fit_labeller(df.limit(0)))).count() == 0


# -- the pipeline ---------------------------------------------------------------


def test_pipeline(spark, tmp_path):
    import corpus_pipeline
    from tests.llm.test_text_ops import awkward, docs_of, slow_components, slow_fingerprint, _labelled

    texts, labels = _labelled(spark, 200)
    long = " ".join(f"w{i}" for i in range(200))
    texts = texts + awkward() + [long, long + " end", "password=7602ad27cf5550de1c " + long.replace("w", "v")]
    docs = docs_of(spark, texts).cache()
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    left = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before, left = left, stage(spark, left, str(tmp_path)).cache()
        assert left.columns == docs.columns
        rows, was = left.collect(), before.collect()
        if name == "toxicity":
            assert len(was) - len(rows) == pytest.approx(40, abs=8) and {r.doc_id for r in rows} >= set(range(200, len(texts)))
        if name == "simhash_near_dedup":
            prints = {r.doc_id: slow_fingerprint(r.text) for r in was}
            roots = slow_components(sorted(prints.values()))
            assert sorted(r.doc_id for r in rows) == sorted({roots[p]: min(i for i in prints if roots[prints[i]] == roots[p]) for p in prints.values()}.values())
        if name == "secret_scans":
            assert len(rows) == len(was) and not any("7602ad27" in (r.text or "") for r in rows)
            assert all(r.n_chars is None or r.n_chars == len(r.text) for r in rows)
    out = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert sorted(r.doc_id for r in out) == sorted(r.doc_id for r in left.collect()) and all(r.exact for r in out)


CLASHING = ["row", "spans", "text_hash", "row_hash", "hash", "copies", "new", "at", "fp", "score", "label", "component_id", "_toxic", "part", "size", "a.b"]


def test_stages_keep_columns_of_any_name(spark, tmp_path):
    """Further columns, whatever they are called, come out of each stage as they went in."""
    import corpus_pipeline
    from tests.llm.test_text_ops import docs_of, _labelled

    texts, labels = _labelled(spark, 60)
    texts += [None, "", "token=0123456789abcdef0123456789 " + texts[1], texts[2], texts[2] + " more"]
    plain = docs_of(spark, texts)
    wide = plain.select(*[F.concat(F.lit(f"{name}-"), F.col("doc_id").cast("string")).alias(name) for name in CLASHING[:8]], "*", *[F.concat(F.lit(f"{name}-"), F.col("doc_id").cast("string")).alias(name) for name in CLASHING[8:]])
    wide.write.parquet(f"{tmp_path}/documents.parquet")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out, expected = stage(spark, wide, str(tmp_path)), stage(spark, plain, str(tmp_path))
        assert out.columns == wide.columns, name
        rows = out.collect()
        assert sorted(str((r.doc_id, r.text, r.source, r.n_chars)) for r in rows) == sorted(str((r.doc_id, r.text, r.source, r.n_chars)) for r in expected.collect()), name
        assert all(r[c] == f"{c}-{r.doc_id}" for r in rows for c in CLASHING), name
    left = corpus_pipeline.run(spark, str(tmp_path))
    assert left.columns == ["doc_id", "source", "lang", "n_tokens", "ids", "exact"] and left.count()


def test_pipeline_of_odd_tables(spark, tmp_path):
    """Empty tables, and one whose every column is null in some row."""
    import corpus_pipeline
    from tests.llm.test_text_ops import DOCS, docs_of

    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    odd = spark.createDataFrame([(None, None, None, None, None), (None, "a b c", None, None, 5), (1, None, "en", "s", None), (2, "a b c", None, None, None), (2, "a b c", None, None, None)], DOCS)
    for name, docs in (("empty", docs_of(spark, [])), ("odd", odd)):
        docs.write.parquet(f"{tmp_path}/{name}/documents.parquet")
        labels.write.parquet(f"{tmp_path}/{name}/labels.parquet")
        rows = corpus_pipeline.run(spark, f"{tmp_path}/{name}").collect()
        assert all(r.exact for r in rows)
        assert {r.doc_id for r in rows} <= {None, 1, 2}
        assert bool(rows) == (name == "odd")
