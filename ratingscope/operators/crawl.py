"""Bookkeeping of fetched review pages, and review text out of saved pages."""

from __future__ import annotations

from collections.abc import Iterator
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .batches import running_counts

# Page classes that hold review text.
CRITIC_CLASS = "review-text"
AUDIENCE_CONTAINER = "review-text-container"
AUDIENCE_CLASS = "audience-reviews__review"

# Names of the outcomes.
OUTCOMES = ("success", "wrong_url", "no_reviews")

# HTML elements without an end tag, and those whose text is not shown.
_VOID = frozenset(
    "area base br col embed hr img input link meta param source track wbr".split()
)
_HIDDEN = frozenset(("script", "style", "template", "noscript"))


def fetch_outcomes(log: DataFrame, critic: str = "reviews_c", audience: str = "reviews_u") -> DataFrame:
    """``outcome`` of each fetch: ``wrong_url``, ``success`` or ``no_reviews``."""
    found = F.coalesce(F.size(critic), F.lit(0)) + F.coalesce(F.size(audience), F.lit(0))
    outcome = (
        F.when(F.col("error").isNotNull(), "wrong_url").when(found > 0, "success").otherwise("no_reviews")
    )
    return log.withColumn("outcome", outcome)


def fetch_totals(outcomes: DataFrame) -> DataFrame:
    return outcomes.groupBy("outcome").agg(F.count(F.lit(1)).alias("n"))


def running_totals(outcomes: DataFrame, order: list[str | Column], work_dir: str | None = None) -> DataFrame:
    """Each fetch with the counters of the log up to it: ``n_success``, ``n_wrong_url``, ``n_no_reviews``."""
    counters = {f"n_{name}": F.col("outcome") == name for name in OUTCOMES}
    return running_counts(outcomes, order, counters, work_dir)


def pending(todo: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """Work not yet in the log of finished rows."""
    return todo.join(done.select(key), key, "left_anti")


# Names of HTML, fixed by the standard: what ends an unclosed paragraph or list item.
_BLOCKS = frozenset(
    "address article aside blockquote div dl fieldset footer form h1 h2 h3 h4 h5 h6 header hr main nav ol p pre section table ul".split()
)
_ITEMS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}}
_SCOPES = frozenset("article aside body button div dl fieldset footer form header main nav ol section table ul".split())


class _ClassText(HTMLParser):
    """Shown text of all elements of a class, or of the first ``inner`` in each of them."""

    def __init__(self, name: str, inner: str | None):
        super().__init__(convert_charrefs=True)
        self.name, self.inner = name, inner
        self.found: list[dict] = []
        # Open elements: tag, the container it is, the texts it feeds.
        self.open: list[tuple[str, dict | None, list[list[str]]]] = []

    def handle_starttag(self, tag, attrs):
        if tag in _VOID:
            if tag == "br":
                self.handle_data(" ")
            return
        self._close_implied(tag)
        classes = (dict(attrs).get("class") or "").split()
        container, feeds = None, []
        if self.inner and self.inner in classes:
            for _, around, _ in self.open:
                if around is not None and around["text"] is None:
                    around["text"] = []
                    feeds.append(around["text"])
        if self.name in classes:
            container = {"text": None if self.inner else []}
            self.found.append(container)
            if not self.inner:
                feeds.append(container["text"])
        self.open.append((tag, container, feeds))

    def _close_implied(self, tag):
        """An unclosed paragraph ends where a block begins, a list item where the next one does."""
        ends = {"p"} if tag in _BLOCKS else set()
        if tag in _ITEMS:
            ends |= _ITEMS[tag]
        for at in range(len(self.open) - 1, -1, -1):
            name = self.open[at][0]
            if name in ends:
                del self.open[at:]
            if name in _SCOPES:
                return

    def handle_endtag(self, tag):
        if any(name == tag for name, _, _ in self.open):
            while self.open.pop()[0] != tag:
                pass

    def handle_data(self, data):
        if any(name in _HIDDEN for name, _, _ in self.open):
            return
        for _, _, feeds in self.open:
            for text in feeds:
                text.append(data)

    def texts(self) -> list[str]:
        if any(hit["text"] is None for hit in self.found):
            return []
        return [" ".join("".join(hit["text"]).split()) for hit in self.found]


def extract_class_text(html: Column, class_name: str = CRITIC_CLASS, inner: str | None = None) -> Column:
    """Text of every element of a class in a saved page.

    With ``inner``, the text of the first element of that class in each of them;
    a page where one of them lacks it gives an empty list, as does a null page.
    Critic reviews: the default. Audience reviews: ``AUDIENCE_CONTAINER`` with
    ``AUDIENCE_CLASS``. Only the page column travels to Python, in Arrow batches.
    """

    def read(page: str | None) -> list[str]:
        if not page:
            return []
        parser = _ClassText(class_name, inner)
        parser.feed(page)
        parser.close()
        return parser.texts()

    @F.pandas_udf("array<string>")
    def extract(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for pages in batches:
            yield pages.map(read, na_action=None)

    # Pages without the class name hold no such element and stay in the JVM.
    return F.when(html.contains(class_name), extract(F.when(html.contains(class_name), html))).otherwise(F.array().cast("array<string>"))
