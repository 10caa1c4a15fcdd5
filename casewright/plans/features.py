"""Feature formulas over a two-period entity table. Column names are parameters."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from casewright.functions import expressions as x
from casewright.operators.fitted import fit_group_statistics, with_out_of_fold_mean
from casewright.operators.selection import Cut, cut_column, select_cuts
from casewright.operators.statistics import below_quantile_flag


class Period(NamedTuple):
    """Columns of one period: what was taken, evaluated, passed, its mark, and what was missed."""

    enrolled: str
    evaluated: str
    approved: str
    grade: str
    missed: str


class Money(NamedTuple):
    """0/1 columns on the financial situation."""

    debtor: str
    paid: str
    scholar: str


class Entity(NamedTuple):
    """All columns the feature formulas read."""

    key: str
    first: Period
    second: Period
    money: Money
    group: str
    admission: str
    application_order: str


def ratio_columns(first: Period, second: Period) -> dict[str, Column]:
    """Approval, evaluation and non-evaluation ratio per period, 0 when nothing was taken."""
    columns = {}
    for prefix, period in (("sem1", first), ("sem2", second)):
        columns[f"{prefix}_approval_ratio"] = x.safe_ratio(period.approved, period.enrolled)
        columns[f"{prefix}_evaluation_ratio"] = x.safe_ratio(period.evaluated, period.enrolled)
        columns[f"{prefix}_non_evaluated_ratio"] = x.safe_ratio(period.missed, period.enrolled)
    return columns


def financial_risk_band(money: Money) -> Column:
    debtor, unpaid = F.col(money.debtor) == 1, F.col(money.paid) == 0
    return x.case_rules(
        [(debtor & unpaid, "high"), (debtor | unpaid | (F.col(money.scholar) == 0), "medium")], "low"
    )


def financial_stress(money: Money) -> Column:
    return x.indicator_sum(
        [F.col(money.debtor) == 1, F.col(money.paid) == 0, F.col(money.scholar) == 0]
    )


def financial_segment(index: str) -> Column:
    return x.band(
        index, [(">=", 2, "high_financial_stress"), ("==", 1, "moderate_financial_stress")], "low_financial_stress"
    )


def change_columns(first: Period, second: Period) -> dict[str, Column]:
    """Deltas, means, totals and the pooled ratio over both periods."""
    return {
        "sem_grade_delta": x.delta(second.grade, first.grade),
        "sem_approval_delta": x.delta("sem2_approval_ratio", "sem1_approval_ratio"),
        "evaluation_delta": x.delta(second.evaluated, first.evaluated),
        "non_evaluated_delta": x.delta(second.missed, first.missed),
        "academic_load_delta": x.delta(second.enrolled, first.enrolled),
        "overall_grade_avg": x.mean_of(first.grade, second.grade),
        "overall_approval_ratio": x.pooled_ratio(
            [first.approved, second.approved], [first.enrolled, second.enrolled]
        ),
        "absenteeism_index": x.total(first.missed, second.missed),
        "total_approved_units": x.total(first.approved, second.approved),
    }


def engagement_risk(first: Period, second: Period) -> Column:
    return x.indicator_sum(
        [F.col(first.evaluated) == 0, F.col(second.evaluated) == 0, F.col(first.missed) > 0, F.col(second.missed) > 0]
    )


def flag_columns(second: Period, application_order: str) -> dict[str, Column]:
    return {
        "grade_drop_flag": x.flag(F.col("sem_grade_delta") < 0),
        "approval_drop_flag": x.flag(F.col("sem_approval_delta") < 0),
        "engagement_drop_flag": x.flag(F.col("evaluation_delta") < 0),
        "is_ghosting": x.flag((F.col(second.evaluated) == 0) & (F.col(second.enrolled) > 0)),
        "is_primary_choice": x.flag(F.col(application_order) == 1),
    }


def group_context(
    df: DataFrame, entity: Entity, fit_on: DataFrame | None = None, state: str | None = None
) -> DataFrame:
    """Group means, the gap to them, and the flag for groups that mark low.

    The quantile runs over entities, so large groups weigh more: it is selected on the group table, weighted by
    rows. Pass the training rows as ``fit_on`` to keep test rows out of the statistics; ``state`` names a table to keep them in.
    """
    stats = {
        "course_rigor_score": x.mean_of(entity.first.grade, entity.second.grade),
        "competitive_density": F.col(entity.admission),
    }
    fitted = fit_group_statistics(df if fit_on is None else fit_on, [entity.group], stats, name=state)
    cut = fitted.quantile("course_rigor_score", 0.25)
    flagged = below_quantile_flag(fitted.apply(df), "course_rigor_score", cut, "grade_deflation_flag")
    return flagged.withColumn("admission_gap", x.delta(entity.admission, "course_rigor_score"))


def feature_table(
    df: DataFrame, entity: Entity, fit_on: DataFrame | None = None, state: str | None = None
) -> DataFrame:
    """The full feature table from the joined or validated entity rows."""
    first, second = entity.first, entity.second
    wide = (
        df.withColumns(ratio_columns(first, second))
        .withColumn("financial_risk_band", financial_risk_band(entity.money))
        .withColumns(change_columns(first, second))
        .withColumn("financial_stress_index", financial_stress(entity.money))
        .withColumns(
            {
                "financial_segment": financial_segment("financial_stress_index"),
                "engagement_risk_proxy": engagement_risk(first, second),
                "academic_momentum_band": x.momentum_band("sem_grade_delta", "sem_approval_delta"),
                **flag_columns(second, entity.application_order),
            }
        )
    )
    return group_context(wide, entity, fit_on, state)


# --- horizon-aware variant: what is known after the first period, and the full picture -------------

EARLY_FEATURES = [
    "financial_stress_index", "financial_risk_score", "admission_tier",
    "sem1_approval_rate", "sem1_evaluation_rate", "sem1_absenteeism",
    "course_avg_grade_sem1", "course_approval_rate", "course_dropout_rate", "is_high_rigor_course",
    "student_vs_course_gap_sem1", "competitive_density", "admission_vs_course_gap",
    "is_primary_choice", "commitment_ratio_sem1",
    "financial_stress_x_rigor", "low_grade_high_absence_sem1", "dropout_risk_sem1",
    "target_binary", "target_multiclass",
]
LATE_FEATURES = [
    "sem2_approval_rate", "sem2_absenteeism", "avg_grade", "overall_approval_rate", "total_absenteeism",
    "sem_grade_trend", "sem_approval_trend", "is_ghosting_sem2", "course_avg_grade_overall", "dropout_risk_full",
]
OUTCOME_CODES = {"Dropout": 0, "Enrolled": 1, "Graduate": 2}
AGE_CUTS = [("<=", 20, "Teen"), ("<=", 25, "Young_Adult"), ("<=", 35, "Adult")]


def age_group(age: str) -> Column:
    return x.band(age, AGE_CUTS, "Mature")


def stress_two_part(money: Money) -> Column:
    """Debt plus unpaid fees, 0 to 2; gaps count as no problem."""
    return F.coalesce(F.col(money.debtor), F.lit(0)) + 1 - F.coalesce(F.col(money.paid), F.lit(1))


def financial_risk_score(money: Money) -> Column:
    unpaid = F.lit(1) - F.coalesce(F.col(money.paid), F.lit(1))
    unsupported = F.lit(1) - F.coalesce(F.col(money.scholar), F.lit(0))
    return x.weighted_score([(money.debtor, 2.0, 0), (unpaid, 1.5, None), (unsupported, 0.5, None)])


def macro_risk_score(unemployment: str, inflation: str, gdp: str) -> Column:
    return x.weighted_score([(unemployment, 0.5, 0), (inflation, 0.3, 0), (gdp, -0.2, 0)])


BACKGROUND_FEATURES = ["age_group", "qualification_to_admission_gap", "parent_education_index", "macro_risk_score", "age_x_absenteeism"]


def background_columns(
    age: str, admission: str, earlier_grade: str, parents: tuple[str, str], absences: str, macro: tuple[str, str, str] | None = None
) -> dict[str, Column]:
    """Demographic, family and macro-economic features; the macro score only where its three columns are there."""
    columns = {
        "age_group": age_group(age),
        "qualification_to_admission_gap": F.round(x.delta(admission, earlier_grade), 2),
        "parent_education_index": x.mean_of(*parents),
        "age_x_absenteeism": F.round(F.col(age) * F.col(absences) / F.lit(100.0), 2),
    }
    return columns if macro is None else columns | {"macro_risk_score": macro_risk_score(*macro)}


def composite_risk(stress: str, absences: str, approval_rate: str, grade: str, rigor: str) -> Column:
    """Weighted risk; unbounded above because absences are not capped."""
    failing = F.when(F.col(grade) < 10, F.lit(0.2)).otherwise(F.lit(0.0))
    missing_approval = F.lit(1.0) - F.coalesce(F.col(approval_rate), F.lit(100.0)) / F.lit(100.0)
    return x.weighted_score(
        [(stress, 0.25, None), (absences, 0.15, 0), (missing_approval, 0.30, None), (failing, 1.0, None), (rigor, 0.10, None)]
    )


def horizon_features(
    df: DataFrame, entity: Entity, outcome: str = "target", extra: Mapping[str, Column] | None = None,
    fit_rows: Column | None = None, folds: int = 5,
) -> DataFrame:
    """All early and late features on one frame; choose a view with ``feature_view``.

    ``df`` is a stored table. With ``fit_rows`` group averages and quantiles are taken from those rows only, and the group's rate of
    the outcome is an out-of-fold mean for them, so no row sees its own outcome; without, all rows are averaged, the row itself included.
    """
    source = df if fit_rows is None else df.where(fit_rows)
    first, second, money = entity.first, entity.second, entity.money
    dropped = F.when(F.col(outcome) == "Dropout", F.lit(1.0)).otherwise(F.lit(0.0))
    taken = F.when(F.col(first.enrolled) == 0, F.lit(1)).otherwise(F.col(first.enrolled))
    averages = {
        "course_avg_grade_sem1": F.col(first.grade),
        "course_avg_grade_overall": x.mean_of(first.grade, second.grade),
        "course_approval_rate": F.lit(100.0) * F.col(first.approved) / taken,
        "competitive_density": F.col(entity.admission),
    }
    digits = dict.fromkeys(averages, 2)
    if fit_rows is None:
        averages["course_dropout_rate"], digits["course_dropout_rate"] = dropped, 4
    with_context = fit_group_statistics(source, [entity.group], averages, digits).apply(df)
    if fit_rows is not None:
        with_context = with_out_of_fold_mean(
            with_context, [entity.group], dropped, entity.key, "course_dropout_rate", fit_rows, folds, digits=4
        )
    cuts = {"low_mark": Cut(first.grade, 0.25), "tier_low": Cut(entity.admission, 0.25), "tier_high": Cut(entity.admission, 0.75)}
    found = select_cuts(source, cuts, reread=True)
    low_mark, tier_low, tier_high = (cut_column(source, cut, found[name]) for name, cut in cuts.items())
    admission = F.col(entity.admission)
    base = with_context.withColumns(
        {
            "financial_stress_index": stress_two_part(money),
            "financial_risk_score": financial_risk_score(money),
            "admission_tier": x.case_rules(
                [(admission >= tier_high, "High"), (admission >= tier_low, "Mid")], "Low"
            ),
            "sem1_approval_rate": x.null_ratio(first.approved, first.enrolled, 100.0, 2),
            "sem1_evaluation_rate": x.null_ratio(first.evaluated, first.enrolled, 1.0, 4),
            "sem2_approval_rate": x.null_ratio(second.approved, second.enrolled, 100.0, 2),
            "overall_approval_rate": x.null_ratio(
                x.total(first.approved, second.approved), x.total(first.enrolled, second.enrolled), 100.0, 2
            ),
            "avg_grade": F.round(x.mean_of(first.grade, second.grade), 2),
            "sem_grade_trend": F.round(x.delta(second.grade, first.grade), 2),
            "sem_approval_trend": x.delta(second.approved, first.approved),
            "sem1_absenteeism": F.col(first.missed),
            "sem2_absenteeism": F.col(second.missed),
            "total_absenteeism": x.total(first.missed, second.missed),
            "is_ghosting_sem2": x.flag((F.col(second.evaluated) == 0) & (F.col(second.enrolled) > 0)),
            "is_primary_choice": x.flag(F.col(entity.application_order) == 1),
            "is_high_rigor_course": x.flag(F.col("course_avg_grade_sem1") < low_mark),
            "student_vs_course_gap_sem1": F.round(x.delta(first.grade, "course_avg_grade_sem1"), 2),
            "admission_vs_course_gap": F.round(x.delta(entity.admission, "course_avg_grade_sem1"), 2),
            "target_binary": x.flag(F.col(outcome) == "Dropout"),
            "target_multiclass": x.encode_target(outcome, OUTCOME_CODES),
            **(extra or {}),
        }
    )
    return base.withColumns(
        {
            "commitment_ratio_sem1": F.col("sem1_evaluation_rate"),
            "financial_stress_x_rigor": x.product("financial_stress_index", "is_high_rigor_course"),
            "low_grade_high_absence_sem1": x.flag((F.col(first.grade) < 10) & (F.col("sem1_absenteeism") > 2)),
            "dropout_risk_sem1": composite_risk(
                "financial_stress_index", "sem1_absenteeism", "sem1_approval_rate", first.grade, "is_high_rigor_course"
            ),
            "dropout_risk_full": composite_risk(
                "financial_stress_index", "total_absenteeism", "overall_approval_rate", "avg_grade", "is_high_rigor_course"
            ),
        }
    )


def column_list(*lists: Sequence[str], available: Sequence[str] | None = None) -> list[str]:
    """Lists merged in order without duplicates; limited to existing columns when those are given."""
    merged = dict.fromkeys(name for names in lists for name in names)
    return [name for name in merged if available is None or name in available]


def feature_view(
    df: DataFrame, horizon: str, base: Sequence[str], optional: Sequence[str] = (),
) -> DataFrame:
    """``early`` leaves out everything that is only known after the second period; ``full`` has all."""
    lists = {"early": [base, EARLY_FEATURES], "full": [base, EARLY_FEATURES, LATE_FEATURES]}[horizon]
    background = [c for c in BACKGROUND_FEATURES if c not in optional]
    return df.select(*column_list(*lists), *column_list(optional, background, available=df.columns))


def drop_protected(df: DataFrame, attributes: Sequence[str]) -> DataFrame:
    """Everything but the protected attributes."""
    return df.select(*[c for c in df.columns if c not in attributes])


def split_tables(df: DataFrame, spec: Mapping[str, Mapping[str, tuple[str, str]]], key: str) -> dict[str, DataFrame]:
    """Subject tables from one wide table: ``{table: {output: (input, type)}}``, each with the key."""
    return {
        table: df.select(
            F.col(key).cast("bigint").alias(key),
            *[F.col(source).cast(kind).alias(name) for name, (source, kind) in columns.items()],
        )
        for table, columns in spec.items()
    }
