"""Whole runs on files, the sinks, the stream, and what the plans look like."""

import json
from pathlib import Path

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from inkmill.functions.normalize import normalize
from inkmill.functions.validate import validate
from inkmill.operators.escalation import escalate
from inkmill.operators.routing import route
from inkmill.plans.catalog import inputs
from inkmill.plans.catalog.oracles import ORACLES
from inkmill.plans.catalog.queries import QUERIES
from inkmill.plans.convert import BatchFailed, convert, run_batch
from inkmill.settings import Batch, Settings
from inkmill.sources.files import discover, read_markdown
from inkmill.streaming.incremental import convert_stream
from tests.conftest import SF_DIR

BODY = "The mill stands by the river and grinds all winter.\n\nIn spring the wheel is mended before the flood comes.\n"


@pytest.fixture
def folder(tmp_path):
    source = tmp_path / "in"
    (source / "deep").mkdir(parents=True)
    (source / "sample.txt").write_text("# River Mill\n\n* " + BODY)
    (source / "page.html").write_text(f"<html><head><title>Mill</title></head><body><h1>Wheel</h1><p>{BODY}</p></body></html>")
    (source / "table.csv").write_text("grain,sacks,barn\nwheat,30,north\nrye,25,south\nbarley,35,river\n")
    (source / "scan.jpg").write_bytes(b"\xff\xd8\xff\xe0\x00")
    (source / "blob.xyz").write_bytes(b"\x00\x01\x02")
    (source / ".hidden.txt").write_text(BODY)
    (source / "deep" / "sample.md").write_text("# Deep\n\n" + BODY)
    return source


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def names(df):
    return sorted(r.name for r in df.select("name").collect())


def test_discovery(spark, folder):
    top = ["blob.xyz", "page.html", "sample.txt", "scan.jpg", "table.csv"]
    assert names(discover(spark, str(folder))) == top
    assert names(discover(spark, str(folder), recursive=True)) == sorted([*top, "sample.md"])
    assert "content" not in plan(discover(spark, str(folder)).select("path", "size")).split("ReadSchema")[1]


def test_read_markdown(spark, folder):
    rows = read_markdown(spark, str(folder / "deep")).select("size", normalize("text").alias("clean")).collect()
    assert len(rows) == 1 and rows[0].clean.startswith("# Deep") and rows[0].size == len("# Deep\n\n" + BODY)


def test_run_skip_force_and_collisions(spark, folder, tmp_path):
    target = str(tmp_path / "out")
    docs = discover(spark, str(folder), recursive=True)

    first = run_batch(docs, target, run_id="one")
    assert first.summary.first().asDict() == {"total": 6, "success": 4, "failed": 2, "skipped": 0}
    errors = {r.file: r.error for r in first.failures.collect()}
    assert errors == {
        "blob.xyz": "unsupported file type: .xyz",
        "scan.jpg": "no extractor registered for mode 'high_accuracy'",
    }
    clean = {Path(r.path).name: r.clean_md for r in spark.read.parquet(f"{target}/clean").collect()}
    assert clean["sample.txt"].startswith("# River Mill\n\n- The mill") and "scan.jpg" not in clean
    raw = {Path(r.path).name: r for r in spark.read.parquet(f"{target}/raw").collect()}
    assert raw["sample.txt"].raw_md == "# River Mill\n\n* " + BODY and raw["page.html"].title == "Mill"

    # The documents that failed before any text was there are tried again, the others are skipped.
    second = run_batch(docs, target, run_id="two")
    assert second.summary.first().asDict() == {"total": 6, "success": 0, "failed": 2, "skipped": 4}
    # A repeated run ignores its own earlier output and replaces it.
    again = run_batch(docs, target, run_id="one")
    assert again.summary.first().success == 4
    assert spark.read.parquet(f"{target}/raw").count() == 4
    forced = run_batch(docs, target, run_id="three", force=True)
    assert forced.summary.first().success == 4 and spark.read.parquet(f"{target}/raw").count() == 8

    stems = run_batch(docs, str(tmp_path / "stems"), key="stem", run_id="one")
    assert stems.summary.first().asDict() == {"total": 6, "success": 3, "failed": 2, "skipped": 1}

    failed = spark.read.parquet(f"{target}/failed").filter("run_id = 'one'").collect()
    assert {r.input_file: bytes(r.content) for r in failed}["blob.xyz"] == b"\x00\x01\x02"


def test_cured_run_leaves_no_failed_rows(spark, tmp_path):
    target, rows = str(tmp_path / "out"), "path string, text string"
    shape = lambda text: inputs.documents(spark.createDataFrame([("/c/a.txt", text)], rows), F.col("path"), F.col("text"))
    first = run_batch(shape("short"), target, run_id="r")
    assert first.summary.first().failed == 1 and spark.read.parquet(f"{target}/failed").count() == 1
    again = run_batch(shape("# Cured\n\n" + BODY), target, run_id="r")
    assert again.summary.first().asDict() == {"total": 1, "success": 1, "failed": 0, "skipped": 0}
    assert again.failures.count() == 0 and spark.read.parquet(f"{target}/failed").count() == 0
    assert [tuple(r) for r in again.details.collect()] == [("a.txt", "success", None)]
    assert not list(Path(target).glob("staging/*"))


def test_run_without_any_text_can_be_followed(spark, tmp_path):
    target, rows = str(tmp_path / "out"), "path string, text string"
    nothing = inputs.documents(spark.createDataFrame([("/c/a.jpg", None)], rows), F.col("path"), F.col("text"))
    for run in ("one", "two"):
        assert run_batch(nothing, target, run_id=run).summary.first().failed == 1
    some = inputs.documents(spark.createDataFrame([("/c/a.jpg", None), ("/c/b.txt", BODY)], rows), F.col("path"), F.col("text"))
    assert run_batch(some, target, run_id="three").summary.first().success == 1


def test_first_document_with_text_has_the_stem(spark, tmp_path):
    rows = [("/in/a.jpg", None), ("/in/a.txt", BODY), ("/in/z/a.md", BODY), ("/in/b.xyz", None), ("/in/b.txt", BODY)]
    docs = inputs.documents(spark.createDataFrame(rows, "path string, text string"), F.col("path"), F.col("text"))
    want = {"/in/a.jpg": "failed", "/in/a.txt": "success", "/in/z/a.md": "skipped", "/in/b.xyz": "failed", "/in/b.txt": "success"}
    assert {r.path: r.status for r in convert(docs, key="stem").collect()} == want
    target = str(tmp_path / "out")
    assert run_batch(docs, target, key="stem", run_id="one").summary.first().asDict() == {"total": 5, "success": 2, "failed": 2, "skipped": 1}
    assert run_batch(docs, target, key="stem", run_id="two").summary.first().success == 0


def test_log_records(spark, folder, tmp_path):
    target = str(tmp_path / "out")
    run_batch(discover(spark, str(folder)), target, run_id="r")
    lines = [json.loads(x) for f in Path(target, "logs", "run_id=r").glob("*.json") for x in f.read_text().splitlines()]
    assert len(lines) == 5
    assert set(lines[0]) == {
        "input_file", "input_size_bytes", "detected_type", "selected_mode", "escalated_to", "retry_count", "engine_version",
        "output_raw", "output_clean", "validation", "duration_seconds", "status", "error", "timestamp", "spark_version",
    }
    by_type = {x["detected_type"]: x for x in lines}
    assert by_type[".xyz"]["validation"] is None and by_type[".xyz"]["selected_mode"] == "unknown"
    assert by_type[".txt"]["validation"]["passed"] and by_type[".txt"]["error"] is None
    assert by_type[".jpg"]["output_raw"] is None and by_type[".jpg"]["retry_count"] == 2


def test_error_policy(spark, folder, tmp_path):
    docs = discover(spark, str(folder))
    with pytest.raises(BatchFailed, match="blob.xyz: unsupported file type: .xyz"):
        run_batch(docs, str(tmp_path / "out"), Settings(batch=Batch(continue_on_error=False)))
    assert spark.read.json(str(tmp_path / "out" / "logs")).count() == 5


def test_empty_input(spark, tmp_path):
    docs = discover(spark, SF_DIR).filter("false")
    assert run_batch(docs, str(tmp_path / "out")).summary.first().asDict() == {"total": 0, "success": 0, "failed": 0, "skipped": 0}


def test_stream_converts_what_arrives(spark, tmp_path):
    source, target = tmp_path / "in", str(tmp_path / "out")
    rows = spark.createDataFrame([(f"/s/{i}.txt", f"# Doc {i}\n\n{BODY}") for i in range(6)], "path string, text string")
    rows.coalesce(1).write.parquet(str(source))

    def arrive(name="first", checkpoint="cp"):
        stream = spark.readStream.schema("path string, text string").parquet(str(source))
        docs = inputs.documents(stream, F.col("path"), F.col("text"))
        query = convert_stream(docs, target, name).option("checkpointLocation", str(tmp_path / checkpoint)).trigger(availableNow=True).start()
        query.awaitTermination()

    arrive()
    assert spark.read.parquet(f"{target}/clean").count() == 6
    spark.createDataFrame([("/s/1.txt", BODY), ("/s/9.txt", "# New\n\n" + BODY)], "path string, text string").coalesce(
        1
    ).write.mode("append").parquet(str(source))
    arrive()
    assert spark.read.parquet(f"{target}/clean").count() == 7
    statuses = spark.read.json(f"{target}/logs").groupBy("status").count().collect()
    assert {r.status: r["count"] for r in statuses} == {"success": 7, "skipped": 1}

    # Another stream keeps out of the way of the first and knows what it wrote.
    arrive("second", "other")
    assert spark.read.parquet(f"{target}/clean").count() == 7
    assert spark.read.json(f"{target}/logs").filter("run_id like 'second-%' and status = 'skipped'").count() == 8


def test_text_work_neither_shuffles_nor_leaves_the_jvm(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    shaped = inputs.documents(docs, F.concat(F.lit("/d/"), "doc_id", F.lit(".txt")), F.col("text"))
    for text in (plan(convert(shaped)), plan(escalate(route(shaped).withColumn("skip", F.lit(False))))):
        assert "Exchange" not in text and "Python" not in text and "Join" not in text
        assert "lang" not in text.split("ReadSchema")[1]


def test_expensive_columns_are_computed_once(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("text", F.octet_length("text").alias("size"))
    judged = docs.withColumn("clean", normalize("text")).withColumn("v", validate("clean", "size"))
    text = judged.select("clean", "v.passed", "v.char_count")._jdf.queryExecution().optimizedPlan().toString()
    assert text.count("(?s)```") == 2  # one extraction, one split


def test_catalog_is_consistent(spark):
    queries, oracles = entry.queries(), entry.oracle_sql()
    assert set(oracles) <= set(queries)
    assert set(QUERIES) == set(ORACLES) and "discover_files" not in queries
    assert entry.entry(spark).count() > 0
