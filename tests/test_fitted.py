"""What is fitted on training rows does not see the others."""

import random

from pyspark.sql import functions as F

from casewright.operators.fitted import fit_group_statistics, fold_of, load_group_statistics, with_out_of_fold_mean
from casewright.operators.learning import ModelColumns, build_preprocessor
from casewright.plans import features as f
from casewright.plans.proxy import SUBJECT

SCHEMA = (
    "entity_id bigint, course int, segment string, app_order int, admission double, target string, debtor int, paid int, scholar int, "
    + ", ".join(f"{c}{p} bigint" for p in (1, 2) for c in ("enr", "eval", "appr", "noeval")) + ", grade1 double, grade2 double, is_test int"
)


def entities(spark, other_tests=False):
    rng = random.Random(11)
    rows = []
    for i in range(400):
        row = [i, rng.choice([None, 1, 2, 3]), "s", rng.randint(0, 3), rng.uniform(90, 190), rng.choice(["Dropout", "Graduate"]), *[rng.randint(0, 1) for _ in range(3)]]
        row += [rng.randint(0, 6) for _ in range(8)] + [rng.uniform(0, 20), rng.uniform(0, 20), int(i % 5 == 0)]
        if other_tests and row[-1]:
            row[1], row[4], row[5], row[-3], row[-2] = 3, 9999.0, "Dropout", 0.0, 0.0
        rows.append(tuple(row))
    return spark.createDataFrame(rows, SCHEMA)


def test_changed_test_rows_leave_training_features_alone(spark):
    def training(df):
        full = f.feature_table(df, SUBJECT, fit_on=df.where("is_test = 0"))
        horizon = f.horizon_features(df, SUBJECT, fit_rows=F.col("is_test") == 0)
        return [sorted(map(str, rows.where("is_test = 0").collect())) for rows in (full, horizon)]

    assert training(entities(spark)) == training(entities(spark, other_tests=True))


def test_no_row_contributes_to_its_own_mean(spark):
    rows = entities(spark).withColumn("y", F.when(F.col("target") == "Dropout", 1).otherwise(0)).withColumn("fold", fold_of("entity_id", 5, 42))
    got = with_out_of_fold_mean(rows, ["course"], F.col("y"), "entity_id", "rate", F.col("is_test") == 0).collect()
    for r in got:
        others = [t["y"] for t in got if not t["is_test"] and t["course"] == r["course"] and (r["is_test"] or t["fold"] != r["fold"])]
        assert abs(r["rate"] - sum(others) / len(others)) < 1e-6
    alone = spark.createDataFrame([(1, "a", 1, True), (2, "b", 1, False), (3, None, None, True)], "id int, g string, y int, fit boolean")
    means = {r["id"]: r["m"] for r in with_out_of_fold_mean(alone, ["g"], F.col("y"), "id", "m", F.col("fit")).collect()}
    assert means == {1: None, 2: None, 3: None}


def test_fitted_table_is_kept_and_read_again(spark):
    rows = entities(spark)
    spark.sql("CREATE DATABASE IF NOT EXISTS fitting_test")
    stats = {"mean": F.col("admission")}
    first = fit_group_statistics(rows.where("is_test = 0"), ["course"], stats, name="fitting_test.state")
    again = load_group_statistics(spark, ["course"], "fitting_test.state")
    assert sorted(map(str, first.apply(rows).collect())) == sorted(map(str, again.apply(rows).collect()))
    spark.sql("DROP DATABASE fitting_test CASCADE")


def test_medians_are_exact_and_gaps_filled(spark):
    from pyspark.ml import Pipeline

    train = spark.createDataFrame([(float(i), None, "a") for i in range(101)] + [(None, None, "b"), (float("nan"), None, "b")], "x double, none double, c string")
    model = Pipeline(stages=build_preprocessor(train, ModelColumns(["x", "none"], ["c"]))[:1]).fit(train)
    filled = model.transform(train).where("c = 'b'").select("num__x", "num__none").collect()
    assert [tuple(r) for r in filled] == [(50.0, 0.0)] * 2
