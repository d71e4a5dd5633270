"""Attempts tables, files that arrive, and one Markdown file per document."""

from pathlib import Path

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from inkmill.operators.escalation import attempt_summary
from inkmill.plans.catalog import inputs
from inkmill.plans.convert import convert, run_batch
from inkmill.sinks.markdown import MarkdownFiles, MarkdownWriter, Written, file_name, write_files
from inkmill.sources.files import discover, discover_stream, read_markdown
from inkmill.streaming.incremental import convert_stream
from tests.conftest import SF_DIR

BODY = "The mill stands by the river and grinds all winter.\n\nIn spring the wheel is mended before the flood comes.\n"


def test_a_run_writes_its_attempts(spark, tmp_path):
    pages = inputs.tier_files(spark, SF_DIR).drop("mode", "skip")
    run_batch(pages, str(tmp_path), inputs.tier_settings(), inputs.tier_extractors(), run_id="r")
    attempts = spark.read.parquet(f"{tmp_path}/attempts")
    log = spark.read.schema("input_file string, selected_mode string, escalated_to string, retry_count int, status string").json(f"{tmp_path}/logs")
    summary = attempt_summary(attempts.drop("run_id"))
    both = log.join(summary.withColumnRenamed("path", "input_file").alias("s"), "input_file")
    same = ["selected_mode", "escalated_to", "retry_count"]
    differs = [~log[c].eqNullSafe(summary[c]) for c in same]
    assert both.count() == log.count() == 50
    assert both.filter(differs[0] | differs[1] | differs[2]).count() == 0
    assert both.filter((F.col("status") == "success") != F.col("s.validation.passed")).count() == 0
    assert log.select("retry_count").distinct().count() > 1


def test_files_convert_as_they_arrive(spark, tmp_path):
    source, target = tmp_path / "in", str(tmp_path / "out")
    source.mkdir()

    def arrive():
        docs = discover_stream(spark, str(source), files_at_once=2)
        writer = convert_stream(docs, target, "files").option("checkpointLocation", str(tmp_path / "cp"))
        writer.trigger(availableNow=True).start().awaitTermination()

    for i in range(3):
        (source / f"{i}.txt").write_text(f"# Doc {i}\n\n{BODY}")
    (source / ".hidden.txt").write_text(BODY)
    arrive()
    assert spark.read.parquet(f"{target}/clean").count() == 3
    for i in (3, 4):
        (source / f"{i}.txt").write_bytes(b"\xff\xfe" + f"# Doc {i}\n\n{BODY}".encode("utf-16-le"))
    arrive()
    arrive()
    clean = spark.read.parquet(f"{target}/clean")
    assert clean.count() == clean.select("path").distinct().count() == 5
    assert spark.read.json(f"{target}/logs").groupBy("input_file").count().filter("count > 1").count() == 0


def test_one_file_per_document(spark, tmp_path):
    rows = [(f"/in/{i}.txt", f"# Doc {i} é\n\n{BODY}") for i in range(40)] + [("/in/short.txt", "x"), ("/in/deep/3.txt", f"# Other\n\n{BODY}")]
    docs = inputs.documents(spark.createDataFrame(rows, "path string, text string").repartition(5), F.col("path"), F.col("text"))
    done = convert(docs, key="stem")
    target = tmp_path / "clean"
    write_files(done, str(target))
    want = {f"{r.stem}.md": r.clean_md for r in done.filter("status = 'success'").collect()}
    assert len(want) == 40 and {p.name: p.read_text() for p in target.glob("*.md")} == want
    assert {r.text for r in read_markdown(spark, str(target)).filter("path LIKE '%.md'").collect()} == set(want.values())
    # Writing again replaces; nothing else is left.
    write_files(done, f"file://{target}")
    assert sorted(p.name for p in target.iterdir() if p.is_file() and not p.name.endswith(".crc")) == sorted([*want, "_SUCCESS"])
    assert not list((target / "_temporary").glob("*"))
    write_files(convert(docs), str(tmp_path / "raw"), text="raw_md", key="path")
    assert len(list((tmp_path / "raw").glob("*.md"))) == 42


def test_a_task_that_runs_again_leaves_no_second_file(tmp_path):
    writer = MarkdownWriter(str(tmp_path / "out"))

    def dying():
        yield Row(name="a", text="one")
        raise OSError("executor lost")

    with pytest.raises(OSError):
        writer.write(dying())
    assert not list((tmp_path / "out").glob("*.md"))
    rows = [Row(name="a", text="one"), Row(name="b", text=None), Row(name="a", text="two")]
    assert writer.write(iter(rows)) == writer.write(iter(rows)) == Written(1)
    writer.commit([Written(1)])
    assert sorted(p.name for p in (tmp_path / "out").iterdir()) == ["_SUCCESS", "_temporary", "a.md"]
    assert (tmp_path / "out" / "a.md").read_text() == "two" and not list((tmp_path / "out" / "_temporary").iterdir())
    MarkdownWriter(str(tmp_path / "none")).abort([])


def test_file_names():
    assert file_name("a b é") == "a b é.md"
    odd = ["a/b", "a\\b", "", "..", "x" * 300, "é" * 150, "a\nb", ".hidden"]
    names = [file_name(n) for n in odd]
    assert len(set(names)) == len(odd) and all("/" not in n and len(n.encode()) < 255 and not n.startswith(".") for n in names)
    with pytest.raises(ValueError):
        MarkdownFiles({"path": "/x"}).writer(type("S", (), {"names": ["other"]})(), False)
