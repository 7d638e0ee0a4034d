"""Collection cost against a budget, in exact decimals."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from touchline.operators.running import running_total
from touchline.vocabulary import (
    BUDGET_LIMIT,
    BUDGET_WARNING_RATIO,
    COST_PER_TWEET,
    MAX_RESULTS_PER_COLLECT,
)


def _money(text: str) -> Column:
    return F.lit(text).cast("decimal(18,3)")


def api_cost(tweets: Column) -> Column:
    return (tweets.cast("decimal(18,0)") * _money(COST_PER_TWEET)).cast("decimal(22,3)")


def with_api_cost(df: DataFrame, tweets: str = "tweets_fetched", budget: str = BUDGET_LIMIT) -> DataFrame:
    """Add cost, what is left of the budget, and how far that would still reach."""
    left = F.greatest(_money("0") .cast("decimal(22,3)"), _money(budget).cast("decimal(22,3)") - F.col("api_cost"))
    per_collection = _money(COST_PER_TWEET) * F.lit(MAX_RESULTS_PER_COLLECT).cast("decimal(5,0)")
    return (
        df.withColumn("api_cost", api_cost(F.col(tweets)))
        .withColumn("remaining_budget", left)
        .withColumns(
            {
                "remaining_tweets": F.floor(F.col("remaining_budget") / _money(COST_PER_TWEET)).cast("long"),
                "remaining_collections": F.floor(F.col("remaining_budget") / per_collection).cast("long"),
            }
        )
    )


def budget_status(cost: Column | str, budget: str = BUDGET_LIMIT) -> Column:
    """``EXCEEDED`` at the budget, ``WARNING`` from 80 percent of it, else ``OK``."""
    cost = F.col(cost) if isinstance(cost, str) else cost
    warning = _money(budget) * F.lit(BUDGET_WARNING_RATIO).cast("decimal(3,2)")
    return (
        F.when(cost >= _money(budget), F.lit("EXCEEDED"))
        .when(cost >= warning, F.lit("WARNING"))
        .otherwise(F.lit("OK"))
    )


def cumulative_cost(
    runs: DataFrame,
    account: str = "account",
    started: str = "run_started",
    order: tuple[str, ...] = ("run_id",),
    tweets: str = "tweets_fetched",
    budget: str = BUDGET_LIMIT,
) -> DataFrame:
    """Running posts and cost of each account, with the budget status they reach."""
    total = running_total(runs, [account], started, order, tweets, "cumulative_tweets")
    return total.withColumn("cumulative_cost", api_cost(F.col("cumulative_tweets"))).withColumn(
        "status", budget_status("cumulative_cost", budget)
    )
