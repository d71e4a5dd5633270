"""Membership without a shuffle, skips on keys alone, and shared stems."""

import re

import pytest
from pyspark.sql import functions as F

from inkmill.operators import membership
from inkmill.operators.membership import Exceeded, marked, member_test
from inkmill.operators.selection import split_keys
from inkmill.plans.catalog import inputs
from inkmill.plans.convert import attempted, convert, late_paths
from inkmill.sources.staging import kept
from tests.conftest import SF_DIR

BODY = "The mill stands by the river and grinds all winter.\n\nIn spring the wheel is mended before the flood comes.\n"


@pytest.mark.parametrize("inside, outside", [(5000, 5000), (300, 20_000), (20_000, 300), (0, 50), (50, 0), (1, 1), (7000, 0)])
def test_membership_is_exact(spark, monkeypatch, inside, outside):
    monkeypatch.setattr(membership, "LEAST_BITS", 1)  # several levels
    monkeypatch.setattr(membership, "_PART_BITS", 32768)
    keys = spark.range(inside + outside).select(F.concat(F.lit("/k/"), "id").alias("path"), (F.col("id") < inside).alias("want"))
    found = marked(keys, keys.filter("want").select("path"), keys.filter("NOT want").select("path"), "path", "found")
    assert found.filter("found != want OR found IS NULL").count() == 0
    assert "Exchange" not in _above_subqueries(found)


def test_small_bitmaps_take_many_levels(spark, monkeypatch):
    """With one bit for every eighth key most keys hit by chance, and the chain of bitmaps has to sort them out."""
    monkeypatch.setattr(membership, "LEAST_BITS", 1)
    monkeypatch.setattr(membership, "BITS_PER_KEY", 2)
    keys = spark.range(120_000).select(F.col("id").cast("string").alias("path"), (F.col("id") % 2 == 0).alias("want"))
    test = member_test(keys.filter("want").select("path"), keys.filter("NOT want").select("path"), "path")
    assert keys.withColumn("found", test).filter("found != want").count() == 0


def test_sets_too_large_for_bitmaps_are_joined(spark, monkeypatch):
    monkeypatch.setattr(membership, "MOST_BYTES", 1000)
    keys = spark.range(500).select(F.col("id").cast("string").alias("path"), (F.col("id") % 3 == 0).alias("want"))
    sides = keys.filter("want").select("path"), keys.filter("NOT want").select("path")
    with pytest.raises(Exceeded):
        member_test(*sides, "path")
    assert marked(keys, *sides, "path", "found").filter("found != want").count() == 0


def _above_subqueries(df):
    """The plan of the rows themselves."""
    return df._jdf.queryExecution().sparkPlan().toString().split("Subqueries")[0]


@pytest.fixture
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("key", ["path", "stem"])
def test_no_document_is_shuffled_to_be_skipped(spark, no_broadcast, key):
    files = inputs.files(spark, SF_DIR)
    earlier = inputs.converted_before(spark, SF_DIR).select(key)
    done = attempted(files, existing=earlier, key=key)
    plan = _above_subqueries(done)
    assert not re.search("Exchange|Join", plan) and "text" in plan
    keys = {r[0] for r in earlier.collect()}
    want = {r.path for r in files.select("path", key).collect() if r[key] in keys}
    skipped = {r.path for r in done.select("path", "status").collect() if r.status == "skipped"}
    assert skipped == want


def test_shared_stems_are_staged_once_and_not_shuffled(spark, no_broadcast):
    done = convert(inputs.files(spark, SF_DIR), key="stem")
    plan = _above_subqueries(done)
    # One scan of the written attempts; no conversion, no exchange.
    assert plan.count("FileScan") == 1 and not re.search("Exchange|Join|regexp", plan)


def test_hot_stem_is_spread(spark):
    rows = spark.range(9000).select(
        F.concat(F.lit("/in/"), F.lpad(F.col("id").cast("string"), 5, "0"), F.lit("/index.txt")).alias("path"), F.lit(BODY).alias("text")
    )
    more = spark.range(500).select(F.concat(F.lit("/in/page"), "id", F.lit(".txt")).alias("path"), F.lit(BODY).alias("text"))
    docs = inputs.documents(rows.unionByName(more), F.col("path"), F.col("text"))
    done = kept(docs.select("path", "stem", F.lit("standard").alias("mode"), F.lit(False).alias("skip"), F.col("text").alias("raw_md")))
    late, others = late_paths(done)
    assert late.count() == 8999 and others.count() == 501
    assert others.filter("path = '/in/00000/index.txt'").count() == 1


def test_split_keys_reads_keys_only(spark):
    files = inputs.files(spark, SF_DIR)
    skipped, pending = split_keys(files, inputs.converted_before(spark, SF_DIR))
    assert skipped.columns == pending.columns == ["path"]
    assert skipped.count() + pending.count() == files.count()
    assert skipped.join(pending, "path").count() == 0
