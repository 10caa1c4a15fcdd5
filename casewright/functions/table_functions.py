"""SQL functions over registered views: parameterised tables and scalar helpers."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from casewright.operators.dominance import BITS, flat_steps
from casewright.operators.joins import catalog_index
from casewright.operators.ordering import with_global_rank
from casewright.session import staged


def register_safe_ratio(spark: SparkSession) -> None:
    spark.sql(
        "CREATE OR REPLACE TEMPORARY FUNCTION safe_ratio(num DOUBLE, den DOUBLE) RETURNS DOUBLE "
        "RETURN CASE WHEN den > 0 THEN num / den ELSE CAST(0 AS DOUBLE) END"
    )


def register_table_functions(profiles: DataFrame, catalog: DataFrame, key: str = "entity_id") -> None:
    """``entity_profile(id)``, ``similar_interventions(risk, stress)`` and ``top_risk(threshold, n)``.

    The catalogue is indexed and the profiles are ranked once, here: a call looks its step up by an equality join, or filters
    ranked rows; none sorts or compares all pairs. ``profiles`` needs the key, ``dropout_risk_score``, ``financial_stress_index`` and any further
    profile columns; ``catalog`` is the intervention catalogue.
    """
    spark = profiles.sparkSession
    profiles.createOrReplaceTempView("cw_profiles")
    catalog.createOrReplaceTempView("cw_interventions")
    columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in profiles.schema)
    picked = ", ".join(f"p.{c}" for c in profiles.columns)
    spark.sql(
        f"CREATE OR REPLACE TEMPORARY FUNCTION entity_profile(wanted BIGINT) RETURNS TABLE({columns}) "
        f"RETURN SELECT {picked} FROM cw_profiles p WHERE p.{key} = entity_profile.wanted"
    )
    index = catalog_index(catalog, 5)
    flat_steps(index).createOrReplaceTempView("cw_interventions")
    levels, starts = index.finder.select("levels", "starts").first()
    # The levels, and as many starts as ``dominance.SEARCHED``, written into the function.
    level_list = f"from_json('{json.dumps(levels)}', 'array<double>')"
    start_list = f"from_json('{json.dumps([s.asDict() for s in starts])}', 'array<struct<level:double,risk:double>>')"
    jumps = f"array({', '.join(str(1 << b) for b in reversed(range(BITS)))})"

    def upto(values: str, limit: str) -> str:
        return f"aggregate({jumps}, 0, (at, jump) -> CASE WHEN at + jump <= size({values}) AND get({values}, at + jump - 1) <= {limit} THEN at + jump ELSE at END)"

    spark.sql(
        "CREATE OR REPLACE TEMPORARY FUNCTION reached_level(stress DOUBLE) RETURNS DOUBLE "
        f"RETURN get({level_list}, {upto(level_list, 'reached_level.stress')} - 1)"
    )
    at = "named_struct('level', reached_step.level, 'risk', reached_step.risk)"
    spark.sql(
        "CREATE OR REPLACE TEMPORARY FUNCTION reached_step(risk DOUBLE, level DOUBLE) RETURNS BIGINT "
        f"RETURN CAST({upto(start_list, at)} - 1 AS BIGINT)"
    )
    fields = "intervention_type STRING, success_rate DOUBLE, avg_cost DOUBLE, description STRING, category STRING"
    spark.sql(
        f"CREATE OR REPLACE TEMPORARY FUNCTION similar_interventions(risk DOUBLE, stress INT) RETURNS TABLE({fields}) "
        "RETURN SELECT c.intervention_type, c.success_rate, c.avg_cost, c.description, c.category FROM cw_interventions c "
        "WHERE c.cell = reached_step(similar_interventions.risk + 0.15D, reached_level(CAST(similar_interventions.stress + 1 AS DOUBLE))) "
        "AND c.level = reached_level(CAST(similar_interventions.stress + 1 AS DOUBLE)) "
        "AND c.low <= similar_interventions.risk + 0.15D AND similar_interventions.risk + 0.15D < c.high"
    )
    # Places among all are places among those with a score of ``least`` or more, which come first.
    ranked = staged(with_global_rank(profiles, [F.col("dropout_risk_score").desc_nulls_last(), key], "cw_place"))
    ranked.createOrReplaceTempView("cw_ranked")
    spark.sql(
        f"CREATE OR REPLACE TEMPORARY FUNCTION top_risk(least DOUBLE, n INT) RETURNS TABLE({columns}) "
        f"RETURN SELECT {picked} FROM cw_ranked p WHERE p.dropout_risk_score >= top_risk.least AND p.cw_place <= top_risk.n"
    )
