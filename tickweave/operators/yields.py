"""Yield routes: eligibility, holding-period yield, staking rewards by rank (designed in documents, not run by any feed)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tickweave.operators.validate import codes
from tickweave.schemas import WIDE

#: Places that count votes, and those of them that also earn for blocks.
VOTED, PRODUCING = 127, 27


def eligibility(cost_kind: Column) -> Column:
    """candidate where the exit cost is none or fixed, rejected where it varies, else unknown."""
    return F.when(cost_kind.isin("none", "fixed"), "candidate").when(cost_kind == "variable", "rejected").otherwise("unknown")


def net_yield(income: Column, entry: Column, exit_: Column, penalty: Column, loss: Column) -> Column:
    """Exact income over a holding period less what entering, leaving, penalties and fixed losses cost; null if any is unknown."""
    return income.cast(WIDE) - entry.cast(WIDE) - exit_.cast(WIDE) - penalty.cast(WIDE) - loss.cast(WIDE)


def tiered_income(amounts: DataFrame, tiers: DataFrame) -> DataFrame:
    """What amounts (yield_route_id, position_id, amount) earn in a year at their route's tiers: rows with ``income``, exact to 18 places.

    ``marginal`` tiers pay on what lies within each, ``whole_balance`` pays all
    at the rate of the tier that holds it (its start included, its end not),
    ``none`` is one rate for all.  Amounts have up to 9 places and rates too.
    Nothing is earned on nothing; where a tier that applies has no rate or an
    unknown mode, or none applies, the income is unknown (null).  Amounts meet
    the tiers of their route that begin below them, which are few.
    """
    amount, low, high = F.col("amount").cast("decimal(19,9)"), F.col("tier_min_amount").cast("decimal(19,9)"), F.col("tier_max_amount").cast("decimal(19,9)")
    rate, mode = F.col("rate").cast("decimal(18,9)"), F.col("tier_mode")
    within = F.when(mode == "marginal", amount > low).otherwise((amount >= low) & (high.isNull() | (amount < high)))
    known = tiers.select("yield_route_id", "tier_no", "tier_min_amount", "tier_max_amount", "tier_mode", "rate")
    met = amounts.select("yield_route_id", "position_id", "amount").join(known, "yield_route_id", "left")
    part = F.when(mode == "marginal", (F.least(amount, F.coalesce(high, amount)) - low).cast("decimal(19,9)") * rate).when(mode.isin("whole_balance", "none"), amount * rate)
    applies = F.coalesce(within, F.lit(False))
    sums = met.groupBy("yield_route_id", "position_id", "amount").agg(
        F.sum(F.when(applies, part)).cast("decimal(38,18)").alias("_sum"), F.count_if(applies).alias("_n"), F.count_if(applies & part.isNull()).alias("_open")
    )
    income = F.when(F.col("amount") <= 0, F.lit(0).cast("decimal(38,18)")).when((F.col("_n") > 0) & (F.col("_open") == 0), F.col("_sum"))
    return sums.select("yield_route_id", "position_id", "amount", income.alias("income"))


def observation() -> Column:
    """Broken rules of a yield observation: its reward arrays, its eligibility and its tier."""
    mode = F.col("rule_principal_loss_mode")
    return codes(
        reward_lengths=F.size("reward_asset_keys") != F.size("reward_component_rates"),
        rule_eligibility=F.when(mode == "variable", F.col("rule_eligibility") != "rejected").when(mode == "unknown", F.col("rule_eligibility") != "unknown").otherwise(~mode.isin("none", "fixed")),
        fixed_principal_loss_rate=F.col("fixed_principal_loss_rate").isNotNull() != (mode == "fixed"),
        tier_no=~(F.col("tier_no") >= 1),
        tier_mode=~F.col("tier_mode").isin("none", "marginal", "whole_balance", "unknown"),
        tier_amounts=~(F.col("tier_min_amount") >= 0) | F.coalesce(F.col("tier_max_amount") <= F.col("tier_min_amount"), F.lit(False)),
    )


def rate_yield(first: Column, last: Column, days: Column) -> Column:
    """Yearly yield from an exchange rate at either end of a period; null for an empty period."""
    return F.when((first > 0) & (days > 0), F.pow(last / first, F.lit(365.0) / days) - 1)


def staking(candidates: DataFrame, vote_pool: int, block_pool: int, votes: str = "votes", key: str = "candidate_id") -> DataFrame:
    """Rewards of the 127 candidates with most votes: a share of the vote pool by votes, and of the block pool for the first 27.

    The top is taken before anything is ranked, so no window sees all candidates.
    """
    top = candidates.orderBy(F.desc(votes), key).limit(VOTED)
    ranked = top.withColumn("place", F.row_number().over(Window.orderBy(F.desc(votes), key)))
    whole = F.sum(votes).over(Window.partitionBy(F.lit(1)))
    return ranked.withColumn("vote_reward", F.floor(F.lit(vote_pool) * F.col(votes) / whole).cast("long")).withColumn(
        "block_reward", F.when(F.col("place") <= PRODUCING, F.lit(block_pool // PRODUCING)).otherwise(F.lit(0)).cast("long")
    )
