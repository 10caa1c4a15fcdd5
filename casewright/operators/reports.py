"""Report queries over the finished queue."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from casewright.operators.ordering import queue_head, top_n
from casewright.operators.statistics import group_count, long_factors, share_summary

FACTORS = ["top_risk_factor_1", "top_risk_factor_2", "top_risk_factor_3"]
DETAIL = ["confidence_band", *FACTORS, "priority_rank"]


def _score_first(key: str) -> list[Column]:
    return [F.col("risk_score").desc(), F.col(key).asc()]


def candidates(queue: DataFrame, action: str, n: int = 20, key: str = "entity_id") -> DataFrame:
    """Highest scores that got one action."""
    chosen = top_n(queue.where(F.col("recommended_action") == action), _score_first(key), n)
    return chosen.select(key, F.round("risk_score", 4).alias("risk_score"), *DETAIL)


def diverse_high_risk(
    queue: DataFrame, exclude: Sequence[str], least: float = 0.7, n: int = 30, key: str = "entity_id"
) -> DataFrame:
    """High scores whose first reason is not one of the common ones; a NULL reason is left out too."""
    rows = queue.where((F.col("risk_score") >= least) & ~F.col(FACTORS[0]).isin(*exclude))
    return top_n(rows, _score_first(key), n).select(
        key, F.round("risk_score", 4).alias("risk_score"), "recommended_action", *FACTORS, "priority_rank"
    )


def inspect_explanations(explanations: DataFrame, n: int = 30, key: str = "entity_id") -> DataFrame:
    """Raw feature names next to the reasons they were mapped to, highest scores first."""
    return top_n(explanations, _score_first(key), n).select(
        key, F.round("risk_score", 4).alias("risk_score"),
        *[f"raw_feature_{i}" for i in (1, 2, 3)],
        *[F.col(f"factor_{i}").alias(f"mapped_{i}") for i in (1, 2, 3)],
    )


def needing_support(queue: DataFrame, predicted: str = "predicted") -> DataFrame:
    return queue.agg(
        F.count_if(F.col("intervention_tier") == "high").alias("high_tier"),
        F.count_if(F.col(predicted) == 1).alias("predicted_positive"),
    )


def manual_review(queue: DataFrame) -> DataFrame:
    flagged = F.col("fairness_review_flag") == 1
    return queue.agg(
        F.count_if(flagged).alias("flagged"),
        F.count_if(F.col("recommended_action") == "high_priority_case_review").alias("case_review"),
    )


def by_tier(queue: DataFrame) -> DataFrame:
    return group_count(queue, ["intervention_tier"], "n")


def action_breakdown(queue: DataFrame) -> DataFrame:
    return share_summary(queue, ["recommended_action"], "risk_score")


def top_priority(queue: DataFrame, n: int = 20) -> DataFrame:
    return queue_head(queue, n)


def common_factors(queue: DataFrame) -> DataFrame:
    """How many times each reason appears in any position."""
    return long_factors(queue, FACTORS).groupBy("factor").agg(F.count(F.lit(1)).alias("n"))


def factors_by_tier(queue: DataFrame) -> DataFrame:
    return long_factors(queue, FACTORS, ["intervention_tier"]).groupBy("intervention_tier", "factor").agg(
        F.count(F.lit(1)).alias("n")
    )


def dashboard(queue: DataFrame, n: int = 20, key: str = "entity_id", predicted: str = "predicted") -> DataFrame:
    """(tile, label, detail, n, pct, avg_risk, low_risk, high_risk): all tiles from one pass over the queue.

    Each row is counted once for each of its three reasons; grouping sets add the counts up for every tile at once, in each task before
    anything is shuffled. What is left has one row for each tier, action, reason, pair of tier and reason, and head entry. ``detail`` is a reason
    in ``factors_by_tier`` and an action in ``top_priority``, where ``n`` is the rank.
    """
    first = F.col("at") == 0
    head = F.when(first & (F.col("priority_rank") <= n), F.struct("priority_rank", F.col(key).cast("string").alias("id"), "recommended_action"))
    rows = queue.select(key, "risk_score", predicted, "intervention_tier", "recommended_action", "fairness_review_flag", "priority_rank", F.posexplode(F.array(*FACTORS)).alias("at", "factor"))
    keyed = rows.select("*", head.alias("head"))
    once = lambda c: F.when(first, c)
    risk = once(F.col("risk_score"))
    sets = [["intervention_tier"], ["recommended_action"], ["factor"], ["intervention_tier", "factor"], ["head"], []]
    # 1 in the binary number of a row: the column is not part of its set, in the order of the columns.
    tier, action, factor, both, top, whole = 0b0111, 0b1011, 0b1101, 0b0101, 0b1110, 0b1111
    grouped = keyed.groupingSets(sets, "intervention_tier", "recommended_action", "factor", "head").agg(
        F.grouping_id().alias("set"), F.count(once(F.lit(1))).alias("entities"), F.count(F.lit(1)).alias("reasons"), F.avg(risk).alias("avg"), F.min(risk).alias("low"), F.max(risk).alias("high"),
        F.count_if(first & (F.col("intervention_tier") == "high")).alias("high_tier"), F.count_if(first & (F.col(predicted) == 1)).alias("predicted_positive"),
        F.count_if(first & (F.col("fairness_review_flag") == 1)).alias("flagged"), F.count_if(first & (F.col("recommended_action") == "high_priority_case_review")).alias("case_review"),
    )
    # A few rows a label.
    total = F.max(F.when(F.col("set") == whole, F.col("entities"))).over(Window.partitionBy())
    empty = F.lit(None)

    def line(tile: str, label: Column, count: Column, detail: Column = empty, *more: Column) -> Column:
        pct, avg, low, high = more or [empty.cast("double")] * 4
        return F.struct(F.lit(tile).alias("tile"), label.cast("string").alias("label"), detail.cast("string").alias("detail"), count.cast("bigint").alias("n"),
                        pct.alias("pct"), avg.alias("avg_risk"), low.alias("low_risk"), high.alias("high_risk"))

    measures = [F.round(F.lit(100.0) * F.col("entities") / F.col("total"), 2), *[F.round(c, 4) for c in ("avg", "low", "high")]]
    counts = lambda tile, names: [line(tile, F.lit(name), F.col(name)) for name in names]
    lines = {
        whole: counts("needing_support", ["high_tier", "predicted_positive"]) + counts("manual_review", ["flagged", "case_review"]),
        tier: [line("by_tier", F.col("intervention_tier"), F.col("entities"))],
        action: [line("action_breakdown", F.col("recommended_action"), F.col("entities"), empty, *measures), line("resources", F.col("recommended_action"), F.col("entities"))],
        factor: [line("common_factors", F.col("factor"), F.col("reasons"))],
        both: [line("factors_by_tier", F.col("intervention_tier"), F.col("reasons"), F.col("factor"))],
        top: [line("top_priority", F.col("head.id"), F.col("head.priority_rank"), F.col("head.recommended_action"))],
    }
    chosen = F.array().cast("array<struct<tile:string,label:string,detail:string,n:bigint,pct:double,avg_risk:double,low_risk:double,high_risk:double>>")
    for number, parts in lines.items():
        wanted = (F.col("set") == number) & (F.col("head").isNotNull() if number == top else F.lit(True))
        chosen = F.when(wanted, F.array(*parts)).otherwise(chosen)
    return grouped.withColumn("total", total).select(F.inline(chosen))


def resources_by_action(queue: DataFrame, key: str = "entity_id") -> DataFrame:
    """Entities per action. The queue has one row per entity, so counting rows counts entities."""
    return queue.groupBy("recommended_action").agg(F.count(key).alias("entities"))
