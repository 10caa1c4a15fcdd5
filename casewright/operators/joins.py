"""Joins between entity tables, lookup tables and one-row aggregates."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from casewright.functions.expressions import cross_attribute
from casewright.operators.dominance import Staircase, best_fitting, staircase
from casewright.session import measured


def star_join(base: DataFrame, dims: Sequence[DataFrame], key: str, how: str = "inner") -> DataFrame:
    """Join tables that share one key.

    All joins use the same key, so every input is exchanged once and the running result is not
    exchanged again. Inputs stored by ``write_bucketed`` with equal buckets are not exchanged at all.
    """
    return reduce(lambda left, right: left.join(right, key, how), dims, base)


def enrich(facts: DataFrame, dim: DataFrame, key: str, columns: Sequence[str], how: str = "inner") -> DataFrame:
    """Add selected columns of a dimension."""
    return facts.join(dim.select(key, *columns), key, how)


def left_join_default(left: DataFrame, right: DataFrame, key: str, defaults: Mapping[str, object]) -> DataFrame:
    """Left join where missing values of the right side take a stated default."""
    joined = left.join(right, key, "left")
    return joined.withColumns(
        {name: F.coalesce(F.col(name), F.lit(value)) for name, value in defaults.items()}
    )


def null_safe_lookup(
    df: DataFrame, lookup: DataFrame, keys: Sequence[str], how: str = "left", stored: bool = False
) -> DataFrame:
    """Attach a per-key lookup; NULL keys match each other.

    The lookup is measured, never hinted; a ``stored`` table has a known size already.
    """
    sized = lookup if stored else measured(lookup)
    renamed = sized.select(
        *[F.col(k).alias(f"_lookup_{k}") for k in keys], *[c for c in sized.columns if c not in keys]
    )
    condition = reduce(
        lambda left, right: left & right, [df[k].eqNullSafe(renamed[f"_lookup_{k}"]) for k in keys]
    )
    return df.join(renamed, condition, how).drop(*[f"_lookup_{k}" for k in keys])


def attach_global(df: DataFrame, one_row: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Put the values of a one-row aggregate on every row, as one scalar subquery (no join)."""
    names = list(columns or one_row.columns)
    packed = one_row.select(F.struct(*names).alias("packed")).scalar()
    return df.withColumns({name: packed[name] for name in names})


def assign(
    queue: DataFrame, assignments: DataFrame, key: str = "entity_id", active: str = "active_flag"
) -> DataFrame:
    """Queue rows with their active assignees; an unset active flag counts as active."""
    current = assignments.where(F.coalesce(F.col(active), F.lit(1)) == 1).drop(active)
    return queue.join(current, key)


def suppress_recent(df: DataFrame, recent: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Drop rows whose keys were already notified. A NULL key never matches, so it is kept."""
    return df.join(recent.select(*keys), list(keys), "left_anti")


def semi(df: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    """Rows whose key occurs in ``ids``."""
    return df.join(ids.select(key), key, "left_semi")


def audit_frame(
    predictions: DataFrame,
    attributes: Sequence[DataFrame],
    key: str,
    protected: Sequence[str],
    crosses: Mapping[str, Sequence[str]] | None = None,
    missing: str = "unknown",
) -> DataFrame:
    """Predictions with protected attributes as text, gaps spelled out, plus intersection keys."""
    joined = star_join(predictions, attributes, key, "left")
    text: dict[str, Column] = {
        name: F.coalesce(F.col(name).cast("string"), F.lit(missing)) for name in protected
    }
    joined = joined.withColumns(text)
    for name, parts in (crosses or {}).items():
        joined = joined.withColumn(name, cross_attribute(parts, missing=missing))
    return joined


CATALOG_FIELDS = ["success_rate", "intervention_type", "avg_cost", "description", "category"]


def catalog_index(catalog: DataFrame, k: int) -> Staircase:
    """The index over an intervention catalogue that gives the ``k`` most successful rows for a risk and a stress level."""
    order = [F.col("success_rate").desc_nulls_last(), "intervention_type"]
    return staircase(catalog, "risk_score_threshold", "financial_stress_level", order, CATALOG_FIELDS, k)


def recommend_interventions(
    entities: DataFrame,
    catalog: DataFrame,
    key: str,
    risk: str,
    stress: str,
    k: int = 5,
    risk_slack: float = 0.15,
    stress_slack: int = 1,
) -> DataFrame:
    """The ``k`` most successful interventions whose thresholds fit each entity, by an index over the catalogue.

    A catalogue of any size: no entity meets rows that it does not keep, and nothing but its stretch of the index is joined to it.
    """
    limits = F.col(risk) + F.lit(risk_slack), F.col(stress) + F.lit(stress_slack)
    found = best_fitting(entities.select(key, risk, stress), catalog_index(catalog, k), *limits, name="_best")
    options = found.select(key, risk, stress, F.posexplode("_best").alias("_at", "_item"))
    return options.select(
        key, risk, stress, (F.col("_at") + 1).cast("bigint").alias("option_rank"),
        *[F.col(f"_item.{f}").alias(f) for f in ("intervention_type", "success_rate", "avg_cost", "description", "category")],
    )


def fitting_interventions(
    entities: DataFrame, catalog: DataFrame, key: str, risk: str, stress: str, risk_slack: float = 0.15, stress_slack: int = 1
) -> DataFrame:
    """Every intervention that fits each entity: (key, intervention_type, success_rate), as many rows as there are fits.

    Thresholds are cut at the distinct levels: an entity's rows are those of all levels up to its own, so both sides meet on the level.
    """
    rows = catalog.select(F.col("financial_stress_level").alias("_level"), F.col("risk_score_threshold").alias("_from"), "intervention_type", "success_rate")
    rows = measured(rows)  # a small catalogue is sent to the entities; they are not gathered by their few levels
    levels = rows.select("_level").where("_level IS NOT NULL").distinct().agg(F.sort_array(F.collect_list("_level")).alias("l")).scalar()
    mine = entities.select(key, F.col(risk).alias("_risk"), F.col(stress).alias("_stress"), levels.alias("_levels"))
    mine = mine.select(key, "_risk", F.explode(F.filter("_levels", lambda x: x <= F.col("_stress") + stress_slack)).alias("_level"))
    return mine.join(rows, "_level").where(F.col("_from") <= F.col("_risk") + F.lit(risk_slack)).select(key, "intervention_type", "success_rate")


def intervention_reach(
    entities: DataFrame, catalog: DataFrame, risk: str, stress: str, risk_slack: float = 0.15, stress_slack: int = 1
) -> DataFrame:
    """(intervention_type, entities): how many entities each intervention fits; interventions that fit none are left out.

    Entities with equal risk and stress fit the same interventions, so they are counted before they meet the catalogue.
    """
    alike = entities.groupBy(F.col(risk).alias("_risk_of"), F.col(stress).alias("_stress_of")).agg(F.count(F.lit(1)).alias("_entities"))
    fits = fitting_interventions(alike, catalog, "_entities", "_risk_of", "_stress_of", risk_slack, stress_slack)
    return fits.groupBy("intervention_type").agg(F.sum("_entities").alias("entities"))
