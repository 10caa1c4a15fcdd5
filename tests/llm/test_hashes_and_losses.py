"""Texts whose spans collide under weak hashes, documents that share an id, and columns with any name."""

import pytest
from pyspark.sql import functions as F

from casewright.llm import decontaminate, jaccard, pieces, quality, queries, shards
from casewright.llm.text import fresh

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint, _text string, _key string, _hash int, spans int, hits string, whole_row int, own_hash string"
PLAIN = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen"


def table(spark, rows):
    return spark.createDataFrame([(i, t, "en", "s", len(t or ""), "a", "b", 1, 2, "c", 3, "d") for i, t in rows], DOCS)


def complements(n):
    """Two words over a and b in which every position differs and that agree under polynomials modulo powers of two."""
    word = "".join("ab"[bin(i).count("1") % 2] for i in range(n))
    return word, word.translate(str.maketrans("ab", "ba"))


@pytest.mark.parametrize("n", [1024, 4096])
def test_colliding_words_stay_apart(spark, n):
    one, two = complements(n)
    docs = table(spark, [(1, one), (2, two), (3, one)])
    decoded = {r["doc_id"]: r["decoded"] for r in pieces.encode(docs).collect()}
    assert decoded == {1: one, 2: two, 3: one}
    assert {r["doc_id"]: r["component_id"] for r in jaccard.near_duplicates(docs).collect()} == {1: 1, 2: 2, 3: 1}


def test_few_labels_are_learned_from(spark):
    """A small table: over half of the held-out toxic documents are found, and clean ones left alone."""
    folder = "/root/testdata/sf0.01"
    marked = queries.toxic(spark, folder).join(spark.read.parquet(f"{folder}/labels.parquet"), "doc_id").where("held_out")
    row = marked.agg(F.count_if(F.col("toxic") == 1).alias("all"), F.count_if((F.col("toxic") == 1) & (F.col("predicted") == 1)).alias("found"),
                     F.count_if((F.col("toxic") == 0) & (F.col("predicted") == 1)).alias("wrong"), F.count_if(F.col("toxic") == 0).alias("clean")).first()
    assert 2 * row["found"] >= row["all"] > 0 and 20 * row["wrong"] <= row["clean"]


def test_fresh_names():
    assert fresh(["a", "_B", "__b"], "a", "b", "c", "c") == ["_a", "b", "c", "_c"]


def test_equal_texts_share_a_shard(spark):
    rows = [(i, f"text {i} " * (1 + i % 50)) for i in range(400)] + [(1000 + i, "long copy " * 200) for i in range(3)] + [(2000 + i, f"pair {i // 2} " * 90) for i in range(60)]
    got = shards.assign_shards(table(spark, rows).select("doc_id", "text"), carry=["text"])
    assert got.groupBy("text").agg(F.countDistinct("shard").alias("n")).where("n > 1").count() == 0


def test_pipeline_loses_no_distinct_text(spark):
    import corpus_pipeline

    rows = [(7, PLAIN), (7, "another text under the same id with words of its own entirely"), (3, PLAIN), (3, PLAIN), (3, "third text, id three, unlike both of the others here"),
            (None, PLAIN), (None, PLAIN), (8, None), (8, ""), (8, " \n"), (9, PLAIN + " x"), (9, "short")]
    docs = table(spark, rows)
    left = corpus_pipeline.one_of_each_group(spark, docs, "")
    assert left.columns == docs.columns
    got = sorted((str(r["doc_id"]), str(r["text"])) for r in left.collect())
    assert got == sorted((str(i), str(t)) for i, t in [rows[1], rows[2], rows[4], *rows[5:10], rows[11]])
    assert corpus_pipeline.one_of_each_group(spark, docs.limit(0), "").count() == 0


def test_stages_keep_columns_with_any_name(spark):
    import corpus_pipeline

    docs = table(spark, [(1, f"write to ann@example.org {PLAIN}"), (2, PLAIN), (2, PLAIN), (None, "bob@example.org"), (4, None)])
    bench = spark.createDataFrame([("i", "seven eight nine ten eleven twelve thirteen fourteen one two three four five")], "item_id string, text string")
    for how in ("documents", "spans"):
        clean = decontaminate.cleaned(docs, bench, how)
        assert clean.columns == docs.columns and clean.count() == 5
    cut = decontaminate.cleaned(docs, spark.createDataFrame([("i", PLAIN)], "item_id string, text string"), "spans")
    assert {r["text"] for r in cut.where("doc_id = 2").collect()} == {" " * 13}
    private = corpus_pipeline.without_personal_data(spark, docs, "")
    assert private.columns == docs.columns and private.where("text LIKE '%@%'").count() == 0 and private.count() == 5
    assert decontaminate.cleaned(docs.limit(0), bench).count() == 0


def test_ratios_are_the_same_with_and_without_broadcast(spark, monkeypatch):
    docs = table(spark, [(i, f"word{i % 7} and word{i % 5} more {i}") for i in range(60)] + [(3, PLAIN), (None, PLAIN)])
    trusted = spark.createDataFrame([(i,) for i in [*range(0, 60, 3), 3, 3]] + [(None,)], "doc_id bigint")
    small = quality.log_ratios(docs, trusted)
    monkeypatch.setattr(quality, "BROADCAST_ROWS", 2)
    assert quality.log_ratios(docs, trusted) == pytest.approx(small, abs=1e-12)


