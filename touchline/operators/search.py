"""Search specification as a predicate, and stored response pages."""

from __future__ import annotations

import logging
from dataclasses import dataclass, field as dataclass_field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from touchline.functions.once import once
from touchline.functions.text import fold, normalize_text, whole_word_pattern
from touchline.functions.variants import as_variant, field, text_of, truthy
from touchline.operators.running import running_total
from touchline.vocabulary import (
    MAX_RESULTS_PER_COLLECT,
    MAX_RESULTS_PER_PAGE,
    MIN_RESULTS_PER_COLLECT,
)

logger = logging.getLogger(__name__)


@dataclass(frozen=True)
class SearchConfig:
    """What to collect. An explicit ``query`` replaces keywords and their filters.

    The text of such a query is for the search service. What it means for posts at hand is given beside it as
    ``where``: a Column (built from ``mentions``, ``is_retweet`` and columns) or a filter in Spark SQL.

    With a ``ceiling``, as a collection has one, ``max_results`` above it becomes the ceiling.
    """

    keywords: str = "Ligue1"
    max_results: int = MAX_RESULTS_PER_COLLECT
    lang: str | None = None
    start_time: str | None = None
    end_time: str | None = None
    expansions: tuple[str, ...] = ("author_id",)
    tweet_fields: tuple[str, ...] = (
        "created_at", "public_metrics", "lang", "text", "id",
        "author_id", "context_annotations", "entities",
    )
    user_fields: tuple[str, ...] = ("username", "name", "verified", "public_metrics")
    min_retweets: int | None = None
    query: str | None = None
    where: Column | str | None = dataclass_field(default=None, compare=False)
    ceiling: int | None = None
    explicit_query: bool = dataclass_field(init=False, default=False)

    def __post_init__(self) -> None:
        if self.max_results < MIN_RESULTS_PER_COLLECT:
            raise ValueError(
                f"max_results doit être >= {MIN_RESULTS_PER_COLLECT}, reçu {self.max_results}"
            )
        if self.ceiling is not None and self.max_results > self.ceiling:
            logger.warning("max_results=%d capped at %d", self.max_results, self.ceiling)
            object.__setattr__(self, "max_results", self.ceiling)
        object.__setattr__(self, "explicit_query", self.query is not None)
        if self.query is None:
            minimum = [f"min_retweets:{self.min_retweets}"] if self.min_retweets is not None else []
            text = " ".join([f"({self.keywords})", *minimum, "-is:retweet"])
            object.__setattr__(self, "query", text)

    @property
    def terms(self) -> list[str]:
        """The keywords or phrases joined by ``OR``."""
        return [t.strip().strip('"') for t in self.keywords.split(" OR ") if t.strip()]

    def page_size(self, collected: int) -> int:
        """How many posts the next page should ask for."""
        remaining = self.max_results - collected
        return max(MIN_RESULTS_PER_COLLECT, min(remaining, MAX_RESULTS_PER_PAGE))

    def request_params(self) -> dict[str, str | int]:
        """The specification as request parameters of the search API."""
        language = f" lang:{self.lang}" if self.lang else ""
        params: dict[str, str | int] = {
            "query": f"{self.query}{language}",
            "max_results": min(self.max_results, MAX_RESULTS_PER_PAGE),
            "expansions": ",".join(self.expansions),
            "tweet.fields": ",".join(self.tweet_fields),
        }
        if "author_id" in self.expansions:
            params["user.fields"] = ",".join(self.user_fields)
        bounds = {"start_time": self.start_time, "end_time": self.end_time}
        return params | {k: v for k, v in bounds.items() if v}

    def predicate(self) -> Column:
        """The specification as a filter over ``text, lang, retweet_count, created_at``.

        The cheap typed comparisons come first; ``start`` is inclusive and ``end``
        exclusive.
        """
        tests: list[Column] = []
        if self.lang:
            tests.append(F.col("lang") == self.lang)
        if self.start_time:
            tests.append(F.col("created_at") >= F.lit(self.start_time).cast("timestamp"))
        if self.end_time:
            tests.append(F.col("created_at") < F.lit(self.end_time).cast("timestamp"))
        if self.explicit_query:
            if self.where is None:
                raise ValueError("an explicit query is the service's own; give `where` to filter posts here")
            tests.append(F.expr(self.where) if isinstance(self.where, str) else self.where)
        else:
            if self.min_retweets is not None:
                tests.append(F.col("retweet_count") >= self.min_retweets)
            tests.append(~is_retweet())
            tests.append(mentions(*self.terms))
        combined = tests[0]
        for test in tests[1:]:
            combined = combined & test
        return combined


def is_retweet() -> Column:
    return F.col("text").startswith("RT @")


def mentions(*terms: str) -> Column:
    """Whether the text has any of the words or phrases, whatever their case and accents."""
    return normalize_text("text").rlike(whole_word_pattern([fold(t) for t in terms]))


def search_filter(tweets: DataFrame, config: SearchConfig) -> DataFrame:
    return tweets.where(config.predicate())


def cap_results(df: DataFrame, run: str, order: list[str], cap: int) -> DataFrame:
    """The first ``cap`` rows of each run.

    Spark turns the rank filter into a limit before the shuffle, so a run sends
    at most ``cap`` rows per task. It does so up to ``spark.sql.optimizer.windowGroupLimitThreshold``, which a session
    of larger caps has to raise; the result is the same without it.
    """
    window = Window.partitionBy(run).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(window)).where(F.col("_rank") <= cap).drop("_rank")


def _parsed(pages: DataFrame) -> DataFrame:
    """Pages with ``items``, ``n_items`` and whether a run goes on after them, instead of their ``body``."""
    items = F.try_variant_get("_v", "$.data", "array<variant>")
    return (
        once(pages, _v=as_variant(pages, "body"))
        .withColumns({"items": items, "_token": truthy(field("_v", "meta.next_token"))})
        .withColumn("n_items", F.greatest(F.coalesce(F.size("items"), F.lit(0)), F.lit(0)))
        .select(
            *[c for c in pages.columns if c != "body"],
            "items",
            "n_items",
            ((F.col("n_items") > 0) & F.coalesce("_token", F.lit(False))).alias("_continues"),
        )
    )


def _read_pages(pages: DataFrame) -> DataFrame:
    """``page_prefix`` without a cap.

    Which pages are read, and what comes before them, follows from three small columns per page. Bodies meet that
    table by run and page, and only those that were read are parsed into items.
    """
    small = _parsed(pages).select("run_id", "page", "n_items", "_continues")
    totals = running_total(small, ["run_id"], "page", [], "n_items", "_upto")
    stops = totals.where(~F.col("_continues")).groupBy("run_id").agg(F.min("page").alias("_stop"))
    kept = totals.join(stops.withColumnRenamed("run_id", "_run"), F.col("run_id").eqNullSafe(F.col("_run")), "left")
    places = kept.where((F.col("n_items") > 0) & (F.col("page") <= F.coalesce("_stop", "page"))).select(
        F.col("run_id").alias("_place_run"),
        F.col("page").alias("_place_page"),
        (F.col("_upto") - F.col("n_items")).alias("n_before"),
    )
    same = F.col("run_id").eqNullSafe(F.col("_place_run")) & (F.col("page") == F.col("_place_page"))
    return _parsed(pages.join(places, same).drop("_place_run", "_place_page")).select(
        *[c for c in pages.columns if c != "body"], "items", "n_items", "n_before"
    )


def page_prefix(pages: DataFrame, cap: int | None = None) -> DataFrame:
    """The pages of each run that a collection would have read.

    Adds ``items``, ``n_items`` and ``n_before``. A run stops at the first page without
    data or without a following token, or once ``cap`` posts are in. Pages of a run have
    different numbers.

    With a ``cap``, every page read holds at least one post, so the first ``cap`` pages of a
    run decide the outcome: the unparsed pages are limited to these, below the shuffle, and
    the windows look at no more. Without one, the stop of a run is the smallest page that
    ends it, a minimum, and the posts before a page are a running total over narrow rows.
    """
    if cap is None:
        return _read_pages(pages)
    parsed = _parsed(cap_results(pages, "run_id", ["page"], cap)).withColumn("items", F.slice("items", 1, cap))
    by_page = Window.partitionBy("run_id").orderBy("page")
    earlier = by_page.rowsBetween(Window.unboundedPreceding, -1)
    return (
        parsed.withColumns(
            {
                "_reached": F.coalesce(F.min("_continues").over(earlier), F.lit(True)),
                "n_before": F.coalesce(F.sum("n_items").over(earlier), F.lit(0)),
            }
        )
        .where(F.col("_reached") & (F.col("n_items") > 0) & (F.col("n_before") < cap))
        .drop("_reached", "_continues")
    )


def read_response_pages(pages: DataFrame, cap: int | None = None) -> DataFrame:
    """Posts of stored API responses in arrival order: ``run_id, rank, post``.

    A collection job passes the published ``cap`` of a collection; stored responses can be read without.
    """
    found = (
        page_prefix(pages, cap)
        .select("run_id", "n_before", F.posexplode("items").alias("_pos", "post"))
        .select("run_id", (F.col("n_before") + F.col("_pos") + 1).cast("long").alias("rank"), "post")
    )
    return found if cap is None else found.where(F.col("rank") <= cap)


def post_fields(posts: DataFrame) -> DataFrame:
    """The usual fields of collected VARIANT posts as columns."""
    return posts.select(
        "run_id",
        "rank",
        text_of("post", "id").alias("tweet_id"),
        text_of("post", "text").alias("text"),
        text_of("post", "author_id").alias("author_id"),
    )
