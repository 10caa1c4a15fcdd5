"""Files, names, catalog tables and stored models: what is written is read back and compared with the given tables."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from casewright.operators import learning, metrics, quality
from casewright.plans import features
from casewright.plans.checks.models import SPLIT, prepared
from casewright.plans.checks.registry import check
from casewright.plans.proxy import table
from casewright.session import staging_root
from casewright.sources import catalog
from casewright.sources.files import read_csv
from casewright.sources.names import normalize_columns

CUSTOMER = "c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment"


def customers(spark, sf_dir):
    return table(spark, sf_dir, "customer").select(*CUSTOMER.split(", "))


def folder(spark, name):
    return f"{staging_root(spark)}/{name}-{uuid.uuid4().hex}"


@check("csv_scan", f"SELECT {CUSTOMER} FROM customer")
def csv_scan(spark, sf_dir):
    """Written with a header, read with inferred types."""
    path = folder(spark, "csv")
    customers(spark, sf_dir).write.option("header", True).csv(path)
    rows = read_csv(spark, path)
    return rows.select(F.col("c_custkey").cast("bigint").alias("c_custkey"), "c_name", F.col("c_nationkey").cast("int").alias("c_nationkey"), F.col("c_acctbal").cast("double").alias("c_acctbal"), "c_mktsegment")


@check("csv_scan_options", "SELECT doc_id, lang, text FROM documents")
def csv_scan_options(spark, sf_dir):
    """Texts with line ends, quotes and separators, under another separator and quote, with a given schema."""
    path = folder(spark, "csv")
    rows = table(spark, sf_dir, "documents").select("doc_id", "lang", "text")
    rows.write.option("header", True).option("sep", ";").option("quote", "'").option("escape", "'").option("lineSep", "\n").csv(path)
    return read_csv(spark, path, "doc_id bigint, lang string, text string", sep=";", quote="'", escape="'", multi_line=True)


@check("normalized_names", "SELECT c_custkey AS customers_key, c_name AS name_of_customer, c_acctbal AS balance_pct FROM customer")
def normalized_names(spark, sf_dir):
    rows = customers(spark, sf_dir).select(F.col("c_custkey").alias("Customer's  key"), F.col("c_name").alias(" Name/of (customer)"), F.col("c_acctbal").alias("balance %"))
    return normalize_columns(rows)


@check("sanitized_names", "SELECT c_custkey AS customer_s_key, c_name AS name, c_mktsegment AS name_1, c_acctbal AS balance FROM customer")
def sanitized_names(spark, sf_dir):
    rows = customers(spark, sf_dir).select(F.col("c_custkey").alias("Customer's key"), F.col("c_name").alias("Name"), F.col("c_mktsegment").alias("name?"), F.col("c_acctbal").alias("balance %"))
    return normalize_columns(rows, style="sanitize", dedupe=True)


def database(spark):
    """A database of this session alone, under the staging folder."""
    name = f"cw_check_{uuid.uuid4().hex[:12]}"
    catalog.ensure_schemas(spark, [name, name], staging_root(spark))
    return name


@check("written_table", f"SELECT {CUSTOMER} FROM customer")
def written_table(spark, sf_dir):
    """Overwritten with another schema, key cast, then read by name."""
    name = f"{database(spark)}.customers"
    catalog.write_table(customers(spark, sf_dir).select("c_custkey").limit(3), name)
    catalog.write_table(customers(spark, sf_dir), name, key="c_custkey")
    return catalog.read_table(spark, name)


@check("appended_table", "SELECT c_mktsegment, 2 * count(*) AS n, count(DISTINCT c_custkey) AS customers FROM customer GROUP BY 1")
def appended_table(spark, sf_dir):
    name = f"{database(spark)}.log"
    catalog.ensure_table(spark, name, "c_custkey BIGINT, c_mktsegment STRING")
    catalog.ensure_table(spark, name, "c_custkey BIGINT, c_mktsegment STRING")
    rows = customers(spark, sf_dir).select(F.col("c_custkey").cast("bigint").alias("c_custkey"), "c_mktsegment")
    for _ in range(2):
        catalog.write_table(rows, name, mode="append")
    return catalog.read_table(spark, name).groupBy("c_mktsegment").agg(F.count("*").alias("n"), F.countDistinct("c_custkey").alias("customers"))


@check("reset_table", "SELECT count(*) AS n, false AS still_there, true AS other_there FROM nation")
def reset_table(spark, sf_dir):
    """Dropped, dropped again, and written anew; a table beside it stays."""
    base = database(spark)
    for name in ("one", "two"):
        catalog.write_table(table(spark, sf_dir, "nation"), f"{base}.{name}")
    catalog.reset_tables(spark, [f"{base}.one", f"{base}.missing"])
    catalog.reset_tables(spark, [f"{base}.one"])
    there = [spark.catalog.tableExists(f"{base}.{name}") for name in ("one", "two")]
    return catalog.read_table(spark, f"{base}.two").agg(F.count("*").alias("n")).select("n", F.lit(there[0]).alias("still_there"), F.lit(there[1]).alias("other_there"))


@check("empty_result", "SELECT c_custkey, c_name FROM customer WHERE c_acctbal > 1e12 UNION ALL SELECT n_nationkey, n_name FROM nation")
def empty_result(spark, sf_dir):
    """A typed empty result where nothing qualifies takes part in a union."""
    rich = customers(spark, sf_dir).where("c_acctbal > 1e12").select("c_custkey", "c_name")
    found = rich if not rich.isEmpty() else catalog.empty(spark, rich.schema)
    return found.union(table(spark, sf_dir, "nation").select("n_nationkey", "n_name"))


@check("required_columns", "SELECT c_nationkey, count(*) AS n, true AS refused FROM customer GROUP BY 1")
def required_columns(spark, sf_dir):
    rows = quality.require_columns(customers(spark, sf_dir), ["c_custkey", "c_nationkey"])
    try:
        quality.require_columns(rows, ["c_custkey", "absent"])
        refused = False
    except ValueError as error:
        refused = "absent" in str(error)
    return rows.groupBy("c_nationkey").agg(F.count("*").alias("n")).withColumn("refused", F.lit(refused))


@check("merged_columns", "SELECT c_custkey, c_name, c_acctbal FROM customer")
def merged_columns(spark, sf_dir):
    rows = customers(spark, sf_dir)
    return rows.select(*features.column_list(["c_custkey", "c_name"], ["c_name", "c_acctbal", "absent"], available=rows.columns))


@check("preview_rows", "SELECT 7 AS n, 7 AS known FROM customer LIMIT 1")
def preview_rows(spark, sf_dir):
    rows = customers(spark, sf_dir)
    shown = catalog.preview(rows, 7, ["c_custkey"])
    return shown.join(rows.select("c_custkey", "c_name"), "c_custkey", "left").agg(F.count("*").alias("n"), F.count("c_name").alias("known"))


@check("model_columns", "SELECT o_orderkey, o_totalprice FROM orders")
def model_columns(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice", "o_orderpriority")
    chosen = learning.ml_columns(orders, ["o_orderpriority"], ["o_orderkey", "o_orderstatus"], [])
    return orders.select("o_orderkey", *chosen.numeric)


@check("stored_model", f"WITH {SPLIT} SELECT doc_id, true AS same FROM split WHERE is_test")
def stored_model(spark, sf_dir):
    """Two models saved, the better one found by its metrics row, loaded, and scoring as before."""
    parts, train, stages, _ = prepared(spark, sf_dir)
    test, root = parts.where("is_test = 1"), folder(spark, "models")
    models = {"slow": learning.fit_lr(train, stages, "quality"), "blunt": learning.fit_lr(train, stages, "quality", max_iter=0)}
    scored = {name: learning.score(model, test).select("doc_id", "quality", "predicted", "risk_score") for name, model in models.items()}
    evaluated = {name: metrics.evaluate(rows, "quality", "predicted", "risk_score") for name, rows in scored.items()}
    places = {name: learning.save_model(model, f"{root}/{name}") for name, model in models.items()}
    told = metrics.metrics_table(spark, evaluated, "slow", F.lit("2024-01-31 00:00:00"), places)
    best, row = learning.load_best(spark, told)
    again = learning.score(best, test).select("doc_id", F.col("risk_score").alias("again"))
    same = F.abs(F.col("again") - F.col("risk_score")) < 1e-12
    return scored[row["model_name"]].join(again, "doc_id").select("doc_id", same.alias("same"))
