"""Exact cuts of many columns, and statistics that are fitted on a training part only."""

from __future__ import annotations

from pyspark.sql import functions as F

from casewright.operators import mitigation
from casewright.operators.fitted import fit_group_statistics, with_out_of_fold_mean
from casewright.operators.ordering import top_rows
from casewright.operators.selection import Cut, select_cuts
from casewright.plans import features as f
from casewright.plans.checks.formulas import HORIZON, VIEW_BASE
from casewright.plans.checks.registry import check
from casewright.plans.checks.sql import SUBJ
from casewright.plans.proxy import SUBJECT, entity_table, table
from casewright.session import staged

FRACTIONS = [0.01, 0.25, 0.5, 0.75, 0.99]
CUT_COLUMNS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_orderkey"]


@check("quantile_cuts", " UNION ALL ".join(
    f"SELECT '{c}' AS name, CAST({q} AS DOUBLE) AS fraction, CAST(quantile_disc({c}, {q}) AS DOUBLE) AS cut FROM lineitem" for c in CUT_COLUMNS for q in FRACTIONS))
def quantile_cuts(spark, sf_dir):
    cuts = {f"{c} {q}": Cut(c, q) for c in CUT_COLUMNS for q in FRACTIONS}
    found = select_cuts(table(spark, sf_dir, "lineitem"), cuts, reread=True)
    return spark.createDataFrame([(c.value, c.fraction, float(found[name])) for name, c in cuts.items()], "name string, fraction double, cut double")


@check("weighted_cuts", """WITH s AS (SELECT o_totalprice AS v, sum(c_acctbal::BIGINT) AS w FROM orders JOIN customer ON o_custkey = c_custkey
    WHERE c_acctbal::BIGINT > 0 GROUP BY 1), r AS (SELECT v, sum(w) OVER (ORDER BY v) AS upto, sum(w) OVER () AS total FROM s)
  SELECT f AS fraction, min(v) FILTER (WHERE upto >= f * total) AS cut FROM r, (SELECT unnest([0.1::DOUBLE, 0.5, 0.9]) AS f) GROUP BY f""")
def weighted_cuts(spark, sf_dir):
    orders, customer = table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer")
    rows = orders.join(customer, orders.o_custkey == customer.c_custkey).select("o_totalprice", F.round("c_acctbal").cast("bigint").alias("w"))
    found = select_cuts(rows, {str(q): Cut("o_totalprice", q, "w") for q in (0.1, 0.5, 0.9)})
    return spark.createDataFrame([(float(q), v) for q, v in found.items()], "fraction double, cut double")


@check("top_orders", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 10000")
def top_orders(spark, sf_dir):
    return top_rows(table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice"), "o_totalprice", "o_orderkey", 10_000)


TRAINING = "substr(md5(entity_id || '-42'), 1, 2) < 'cd'"
FOLD = "CAST('0x' || substr(md5(entity_id || '-fold-42'), 1, 8) AS BIGINT) % 5"


def training():
    """About four rows of five, by a hash of the id."""
    return F.substring(F.md5(F.concat_ws("-", F.col("entity_id").cast("string"), F.lit("42"))), 1, 2) < "cd"


def rate_of(digits):
    """SQL for (entity_id, rate): the dropout rate of the group over training rows, without the row's own fold if it is one."""
    return f"""marked AS (SELECT entity_id, course, CAST(target = 'Dropout' AS INTEGER) AS y, {TRAINING} AS fit, {FOLD} AS fold FROM subj),
oof AS (SELECT m.entity_id, round(sum(t.y) / count(t.y), {digits}) AS rate
  FROM marked m LEFT JOIN marked t ON t.fit AND t.course IS NOT DISTINCT FROM m.course AND NOT (m.fit AND t.fold = m.fold) GROUP BY m.entity_id)"""


@check("out_of_fold_mean", f"WITH {SUBJ}, {rate_of(6)} SELECT entity_id, rate AS course_rate FROM oof")
def out_of_fold_mean(spark, sf_dir):
    dropped = F.when(F.col("target") == "Dropout", 1).otherwise(0)
    rows = with_out_of_fold_mean(entity_table(spark, sf_dir), ["course"], dropped, "entity_id", "course_rate", training())
    return rows.select("entity_id", "course_rate")


@check("fitted_group_means", f"""WITH {SUBJ}, t AS (SELECT course, round(avg(admission), 6) AS density, round(avg((grade1 + grade2) / 2), 6) AS rigor
    FROM subj WHERE {TRAINING} GROUP BY 1), c AS (SELECT quantile_disc(rigor, 0.25) AS cut FROM subj JOIN t USING (course) WHERE {TRAINING})
  SELECT entity_id, density, rigor, CAST(coalesce(rigor < cut, false) AS INTEGER) AS low_marks FROM subj LEFT JOIN t ON t.course IS NOT DISTINCT FROM subj.course, c""")
def fitted_group_means(spark, sf_dir):
    rows = entity_table(spark, sf_dir)
    averages = {"density": F.col("admission"), "rigor": (F.col("grade1") + F.col("grade2")) / 2}
    fitted = fit_group_statistics(rows.where(training()), ["course"], averages)
    low = F.when(F.col("rigor") < fitted.quantile("rigor", 0.25), 1).otherwise(0)
    return fitted.apply(rows).select("entity_id", "density", "rigor", low.alias("low_marks"))


# The horizon features with every statistic taken from the training rows.
FITTED = HORIZON.replace("FROM subj GROUP BY course)", f"FROM subj WHERE {TRAINING} GROUP BY course)").replace(
    "AS a75 FROM subj)", f"AS a75 FROM subj WHERE {TRAINING}), {rate_of(4)}"
).replace("cs.* EXCLUDE (course)", "cs.* EXCLUDE (course, course_dropout_rate), oof.rate AS course_dropout_rate").replace(
    "FROM subj JOIN cs ON cs.course IS NOT DISTINCT FROM subj.course, q)", "FROM subj JOIN oof USING (entity_id) LEFT JOIN cs ON cs.course IS NOT DISTINCT FROM subj.course, q)"
)


@check("feature_view_fitted", f"WITH {FITTED} SELECT " + ", ".join(VIEW_BASE + f.EARLY_FEATURES) + " FROM h")
def feature_view_fitted(spark, sf_dir):
    rows = f.horizon_features(entity_table(spark, sf_dir), SUBJECT, fit_rows=training())
    return f.feature_view(rows, "early", VIEW_BASE)


# --- hulls: the corners one after the other by the steepest way on, and every crossing tried -----------------------

HULLS = """r AS (SELECT doc_id, nullif(lang, 'es') AS g, CAST(n_chars AS DOUBLE) AS s, quality AS y FROM documents JOIN labels USING (doc_id)),
tot AS (SELECT g, sum(y) AS p, count(*) - sum(y) AS n FROM r GROUP BY g),
pts AS (SELECT g, sum(sum(y)) OVER w AS tp, sum(count(*) - sum(y)) OVER w AS fp FROM r GROUP BY g, s WINDOW w AS (PARTITION BY g ORDER BY s DESC)),
hull AS (
  SELECT g, CAST(0 AS HUGEINT) AS fp, CAST(0 AS HUGEINT) AS tp FROM tot
  UNION ALL SELECT g, fp, tp FROM (
    SELECT h.g, q.fp, q.tp, row_number() OVER (PARTITION BY h.g ORDER BY atan2(q.tp - h.tp, q.fp - h.fp) DESC, q.fp DESC, q.tp DESC) AS nth
    FROM hull h JOIN pts q ON q.g IS NOT DISTINCT FROM h.g AND (q.fp > h.fp OR q.fp = h.fp AND q.tp > h.tp)) WHERE nth = 1
), corner AS (SELECT hull.g, fp / n AS x, tp / p AS y FROM hull JOIN tot ON tot.g IS NOT DISTINCT FROM hull.g),
piece AS (SELECT g, x, y, (y1 - y) / (x1 - x) AS slope FROM (SELECT *, lead(x) OVER w AS x1, lead(y) OVER w AS y1 FROM corner WINDOW w AS (PARTITION BY g ORDER BY x, y)) WHERE x1 > x),
tries AS (SELECT x FROM corner UNION SELECT (b.y - b.slope * b.x - a.y + a.slope * a.x) / (a.slope - b.slope) FROM piece a JOIN piece b ON a.slope > b.slope),
best AS (SELECT t.x, min(piece.y + slope * (t.x - piece.x)) AS y FROM tries t, piece WHERE t.x BETWEEN 0 AND 1 GROUP BY t.x ORDER BY round(min(piece.y + slope * (t.x - piece.x)) - t.x, 12) DESC, t.x LIMIT 1)"""


def hull_rows(spark, sf_dir):
    documents, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    rows = documents.select("doc_id", F.nullif("lang", F.lit("es")).alias("lang"), F.col("n_chars").cast("double").alias("score"))
    return staged(rows.join(labels.select("doc_id", "quality"), "doc_id"))


@check("hull_thresholds", f"WITH RECURSIVE {HULLS} SELECT g AS group_name, round(y, 6) AS true_positive_rate, round(x, 6) AS false_positive_rate FROM tot, best")
def hull_thresholds(spark, sf_dir):
    rules = mitigation.fit_hull_thresholds(hull_rows(spark, sf_dir), "lang", "score", "quality")
    return rules.select("group_name", F.round("true_positive_rate", 6).alias("true_positive_rate"), F.round("false_positive_rate", 6).alias("false_positive_rate"))


@check("hull_decisions", f"WITH RECURSIVE {HULLS} SELECT g AS group_name, round(y, 6) AS expected_tpr, round(x, 6) AS expected_fpr, p + n AS decided FROM tot, best")
def hull_decisions(spark, sf_dir):
    """What the decisions' chances add up to on the rows themselves."""
    rows = hull_rows(spark, sf_dir)
    rules = mitigation.fit_hull_thresholds(rows, "lang", "score", "quality")
    fair = mitigation.apply_hull_thresholds(rows, rules, "lang", "score", "doc_id")
    chance = lambda y: F.round(F.avg(F.when(F.col("quality") == y, F.col("fair_predicted_chance"))), 6)
    return fair.groupBy(F.col("lang").alias("group_name")).agg(
        chance(1).alias("expected_tpr"), chance(0).alias("expected_fpr"), F.count("fair_predicted").alias("decided")
    )
