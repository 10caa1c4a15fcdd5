"""Identity, lineage and data-quality checks."""

from __future__ import annotations

from pyspark.sql import functions as F

from casewright.operators import identity, loads, quality
from casewright.operators.ordering import with_arrival_id, with_row_id, with_unique_id
from casewright.plans.checks.registry import check
from casewright.plans.checks.sql import SUBJ
from casewright.plans.proxy import AS_OF, entity_table, periods, subjects, table


@check("row_id", """SELECT c_custkey,
  row_number() OVER (ORDER BY c_mktsegment, c_acctbal DESC, c_custkey) AS row_id FROM customer""")
def row_id(spark, sf_dir):
    rows = table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment", "c_acctbal")
    order = ["c_mktsegment", F.col("c_acctbal").desc(), "c_custkey"]
    return with_row_id(rows, order, "row_id").select("c_custkey", "row_id")


@check("arrival_row_id", "SELECT count(*) AS n, CAST(1 AS BIGINT) AS low, count(*) AS high, count(*) AS different FROM orders")
def arrival_row_id(spark, sf_dir):
    ids = with_row_id(table(spark, sf_dir, "orders").select("o_orderkey"), name="row_id")
    return ids.agg(
        F.count("*").alias("n"), F.min("row_id").alias("low"), F.max("row_id").alias("high"),
        F.count_distinct("row_id").alias("different"),
    )


@check("file_row_id", "SELECT o_orderkey, row_number() OVER () AS row_id FROM orders")
def file_row_id(spark, sf_dir):
    return with_arrival_id(table(spark, sf_dir, "orders"), "row_id").select("o_orderkey", "row_id")


@check("unique_id", "SELECT count(*) AS n, count(*) AS different FROM lineitem")
def unique_id(spark, sf_dir):
    ids = with_unique_id(table(spark, sf_dir, "lineitem").select("l_orderkey"), "row_id")
    return ids.agg(F.count("*").alias("n"), F.count_distinct("row_id").alias("different"))


@check("record_hash", f"""WITH {SUBJ} SELECT entity_id, sha256(concat_ws('||',
  coalesce(CAST(course AS VARCHAR), 'NULL'), coalesce(segment, 'NULL'), coalesce(target, 'NULL'),
  coalesce(CAST(enr1 AS VARCHAR), 'NULL'), coalesce(CAST(appr2 AS VARCHAR), 'NULL'))) AS record_hash FROM subj""")
def record_hash(spark, sf_dir):
    rows = subjects(spark, sf_dir).select("entity_id", "course", "segment", "target", "enr1", "appr2")
    return identity.with_record_hash(rows, ["entity_id"]).select("entity_id", "record_hash")


@check("lineage_columns", """SELECT c_custkey, TIMESTAMP '2024-01-31 00:00:00' AS ingestion_ts,
  'customer' AS source_file FROM customer""")
def lineage_columns(spark, sf_dir):
    return identity.with_lineage(table(spark, sf_dir, "customer").select("c_custkey"), F.lit(AS_OF), "customer")


@check("key_cast", "SELECT CAST(c_nationkey AS BIGINT) AS c_nationkey, c_name FROM customer")
def key_cast(spark, sf_dir):
    return identity.cast_key(table(spark, sf_dir, "customer"), "c_nationkey").select("c_nationkey", "c_name")


CHANGES = """WITH halves AS (
  SELECT user_id || ':' || event_type AS k, ts < TIMESTAMP '2024-01-16 00:00:00' AS early, count(*) AS n
  FROM events GROUP BY 1, 2)
SELECT coalesce(o.k, w.k) AS k,
  CASE WHEN o.k IS NULL THEN 'new' WHEN w.k IS NULL THEN 'gone' WHEN o.n = w.n THEN 'same' ELSE 'changed' END AS change
FROM (FROM halves WHERE early) o FULL JOIN (FROM halves WHERE NOT early) w ON o.k = w.k"""


def half_loads(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    half = F.col("ts") < F.lit("2024-01-16 00:00:00").cast("timestamp")
    counts = lambda part: events.where(part).groupBy(F.concat_ws(":", "user_id", "event_type").alias("k")).agg(F.count("*").alias("n"))
    return [identity.with_record_hash(counts(part)) for part in (half, ~half)]


@check("change_detection", CHANGES)
def change_detection(spark, sf_dir):
    return identity.diff_by_hash(*half_loads(spark, sf_dir), "k")


@check("change_detection_stored", CHANGES)
def change_detection_stored(spark, sf_dir):
    """The same from two stored fingerprint tables."""
    old, new = (loads.store_fingerprints(load, "k", buckets=16) for load in half_loads(spark, sf_dir))
    return loads.changed_rows(old, new, unchanged=True)


def rules():
    return [
        quality.rule_in_set("outside_set", ["enr1", "enr2"], [0, 1, 2, 3]),
        quality.rule_min("negative", ["prior_grade", "admission", "grade1"], 0),
        quality.rule_le("part_over_whole", ["noeval1", "appr1"], "eval1"),
        quality.rule_in_set("bad_label", ["target"], ["Dropout", "Graduate", "Enrolled"]),
        quality.rule_between("odd_age", "age", 20, 50, enforce=False),
    ]


RULE_NAMES = ["outside_set", "negative", "part_over_whole", "bad_label", "odd_age"]
FLAGS = SUBJ + """,
flags AS (SELECT entity_id,
  enr1 NOT IN (0, 1, 2, 3) OR enr2 NOT IN (0, 1, 2, 3) AS outside_set,
  prior_grade < 0 OR admission < 0 OR grade1 < 0 AS negative,
  noeval1 > eval1 OR appr1 > eval1 AS part_over_whole,
  target NOT IN ('Dropout', 'Graduate', 'Enrolled') AS bad_label,
  age < 20 OR age > 50 AS odd_age FROM subj),
judged AS (SELECT *, outside_set OR negative OR part_over_whole OR bad_label AS bad FROM flags)"""

def flagged(name):
    def query(spark, sf_dir):
        chosen = [rule for rule in rules() if rule.name == name]
        return quality.with_flags(subjects(spark, sf_dir), chosen).select("entity_id", name)

    return query


for rule_name in RULE_NAMES:
    check(f"rule_{rule_name}", f"WITH {FLAGS} SELECT entity_id, {rule_name} FROM flags")(flagged(rule_name))


@check("valid_rows", f"WITH {FLAGS} SELECT entity_id FROM judged WHERE NOT bad")
def valid_rows(spark, sf_dir):
    return quality.apply_rules(subjects(spark, sf_dir), rules()).select("entity_id")


@check("valid_rows_keeping_undecided", f"WITH {FLAGS} SELECT entity_id FROM judged WHERE bad IS NOT TRUE")
def valid_rows_keeping_undecided(spark, sf_dir):
    return quality.apply_rules(subjects(spark, sf_dir), rules(), "keep").select("entity_id")


@check("rule_report", f"""WITH {FLAGS} SELECT count(*) FILTER (WHERE outside_set) AS outside_set_rows,
  count(*) FILTER (WHERE negative) AS negative_rows, count(*) FILTER (WHERE part_over_whole) AS part_over_whole_rows,
  count(*) FILTER (WHERE bad_label) AS bad_label_rows, count(*) FILTER (WHERE odd_age) AS odd_age_rows,
  count(*) FILTER (WHERE bad IS NULL) AS undecided_rows FROM judged""")
def rule_report(spark, sf_dir):
    return quality.rule_report(subjects(spark, sf_dir), rules())


@check("quarantine", f"""WITH {FLAGS} SELECT entity_id, CASE WHEN bad THEN concat_ws('|',
  CASE WHEN outside_set THEN 'outside_set' END, CASE WHEN negative THEN 'negative' END,
  CASE WHEN part_over_whole THEN 'part_over_whole' END, CASE WHEN bad_label THEN 'bad_label' END)
  ELSE 'undecided' END AS failed_rules FROM judged WHERE bad IS NOT FALSE""")
def quarantine(spark, sf_dir):
    rows = quality.quarantine(subjects(spark, sf_dir), rules())
    return rows.select("entity_id", F.concat_ws("|", "failed_rules").alias("failed_rules"))


AUDITED = ["enr1", "grade1", "course", "prior_grade"]


@check("null_audit", f"WITH {SUBJ} SELECT " + ", ".join(f"count(*) FILTER (WHERE {c} IS NULL) AS {c}" for c in AUDITED) + " FROM subj")
def null_audit(spark, sf_dir):
    return quality.null_audit(subjects(spark, sf_dir), AUDITED)


@check("null_audit_long", f"WITH {SUBJ} " + " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, count(*) FILTER (WHERE {c} IS NULL) AS null_rows FROM subj" for c in AUDITED))
def null_audit_long(spark, sf_dir):
    return quality.null_audit(subjects(spark, sf_dir), AUDITED, long=True)


@check("numeric_profile", f"""WITH {SUBJ} SELECT count(*) AS total_rows, CAST(sum(debtor) AS BIGINT) AS sum_debtor,
  CAST(sum(scholar) AS BIGINT) AS sum_scholar, round(avg(noeval1), 4) AS avg_noeval1,
  round(avg(admission), 4) AS avg_admission FROM subj""")
def numeric_profile(spark, sf_dir):
    return quality.profile(subjects(spark, sf_dir), ["debtor", "scholar"], ["noeval1", "admission"])


@check("layer_summary", """SELECT 'orders' AS layer, count(*) AS n_rows, 6 AS n_columns FROM orders
  UNION ALL SELECT 'lineitem', count(*), 11 FROM lineitem UNION ALL SELECT 'customer', count(*), 5 FROM customer""")
def layer_summary(spark, sf_dir):
    return quality.layer_summary({n: table(spark, sf_dir, n) for n in ("orders", "lineitem", "customer")})


@check("reconcile_counts", f"""WITH {SUBJ}, n AS (
  SELECT 'orders' AS layer, count(*) AS n_rows FROM orders UNION ALL SELECT 'entities', count(*) FROM subj
  UNION ALL SELECT 'with_lines', count(*) FROM per)
SELECT layer, n_rows, (SELECT count(*) FROM orders) - n_rows AS missing_rows,
  CAST(n_rows = (SELECT count(*) FROM orders) AS INTEGER) AS matches FROM n""")
def reconcile_counts(spark, sf_dir):
    layers = {
        "orders": table(spark, sf_dir, "orders"), "entities": entity_table(spark, sf_dir),
        "with_lines": periods(spark, sf_dir),
    }
    return quality.reconcile_counts(layers, "orders")
