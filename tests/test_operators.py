"""Operators on small inputs."""

import random

import pytest
from pyspark.sql import functions as F

from inkmill.functions import html as H, markup, normalize as N, sniff, validate as V
from inkmill.operators.escalation import attempt_summary, escalate, next_mode, outcome
from inkmill.operators.extraction import Extractors, PythonExtractor, extract, extracted, failed, recognised, standard
from inkmill.operators.routing import EXTENSION_MODES, route
from inkmill.operators.selection import first_of_stem, flag_existing, pending
from inkmill.settings import DEFAULT_CHAIN, Modes, Settings, Validation
from inkmill.sources.tables import documents


def files(spark, rows):
    """(path, text) rows as documents."""
    df = spark.createDataFrame(rows, "path string, text string")
    return documents(df, F.col("path"), F.col("text"))


# settings


def test_settings_from_nested_dictionaries():
    s = Settings.from_dict(
        {
            "modes": {"chain": ["standard", "ocr"], "max_retries": 3, "extension_overrides": {".tif": "ocr"}},
            "validation": {"min_char_count": 5},
            "normalization": {"bullet_char": "*"},
            "batch": {"max_workers": 2, "continue_on_error": False},
        }
    )
    assert s.modes.escalation_order() == ("standard", "ocr")
    assert s.modes.extension_overrides == {".tif": "ocr"}
    assert (s.validation.min_char_count, s.validation.max_repetition_count) == (5, 5)
    assert s.normalization.bullet_char == "*" and not s.batch.continue_on_error
    assert Settings.from_dict(None) == Settings() == Settings.from_dict({})
    assert Modes(chain=()).escalation_order() == DEFAULT_CHAIN


def test_settings_refuse_nonsense():
    with pytest.raises(ValueError):
        Validation(max_repetition_count=0)


# normalization and validation, case by case


@pytest.mark.parametrize(
    "step, given, expected",
    [
        (N.strip_trailing, "hello   \nworld  \n", "hello\nworld\n"),
        (N.strip_trailing, "  indented line  \n", "  indented line\n"),
        (N.strip_trailing, "", ""),
        (N.collapse_newlines, "a\n\n\n\n\nb", "a\n\nb"),
        (N.collapse_newlines, "a\n\nb", "a\n\nb"),
        (lambda t: N.collapse_newlines(t, 1), "a\n\n\nb", "a\nb"),
        (N.unify_bullets, "* a\n+ b\n- c\n  * nested\n**bold** text", "- a\n- b\n- c\n  - nested\n**bold** text"),
        (N.unify_bullets, "* * *", "- * *"),
        (N.drop_empty_headings, "## \n# \ncontent", "content"),
        (N.drop_empty_headings, "# Title\n## Section", "# Title\n## Section"),
        (N.drop_empty_headings, "##\n##", ""),
        (N.collapse_repeats, "ab ab ab ab ab", "ab ab ab ab ab"),
        (N.collapse_repeats, "hello world!" * 3 + " extra", "hello world! extra"),
        (N.normalize, "", ""),
        (N.normalize, "# Title   \n\n\n\nParagraph.\n", "# Title\n\nParagraph."),
        (N.normalize, "```sql\n* FROM t\n##  \n```", "```sql\n* FROM t\n##  \n```"),
        (N.normalize, "A\n\n##\n\nB", "A\n\n\nB"),
        (N.normalize, "    * four spaces", "- four spaces"),
    ],
)
def test_normalization_cases(evaluate, step, given, expected):
    assert evaluate(step, [given]) == [expected]


def test_null_text_stays_null(evaluate):
    assert evaluate(N.normalize, [None, "a"]) == [None, "a"]
    assert evaluate(lambda t: V.validate(t, "1"), [None, "a"])[0] is None


def test_many_code_blocks_come_back_in_place(evaluate):
    text = "\n".join(f"+ item {i} ```x\n  body {i}  \n```  " for i in range(500))
    expected = "\n".join(f"- item {i} ```x\n  body {i}  \n```" for i in range(500))
    lookalike = "__CODEBLOCK_" + "0" * 32 + "__ ```\nx\n```"
    assert evaluate(N.normalize, [text, lookalike]) == [expected, lookalike]


def test_validation_cases(evaluate):
    line = "again and again the same words"
    rows = [
        ("", 10),
        ("Short", None),
        ("# Report\n\n" + "The mill ran all night long. " * 2, None),
        ("# Harvest\n\nWheat, rye and barley were brought in." * 3, 1_000_000),
        ("\n".join([line] * 6), None),
        ("# H1\n## H2\n\n" + "plain text. " * 4, 0),
        ("Just a plain paragraph, and nothing else in it at all.", 54),
    ]
    found = evaluate(V.validate, rows, "text string, size bigint")
    assert [r.passed for r in found] == [False, False, True, False, False, True, True]
    assert found[0].failure_reasons == [V.EMPTY_REASON] and found[0].warnings == []
    assert found[1].failure_reasons == ["char_count=5 < min=50"]
    assert found[3].failure_reasons == ["extraction_ratio=0.0001 < min=0.01"]
    assert found[4].failure_reasons == ["repetition detected: same 10+ char string repeated 5+ times"]
    assert found[4].warnings == [V.NO_HEADING_WARNING]
    assert (found[5].heading_count, found[5].extraction_ratio) == (2, None)
    assert found[6].extraction_ratio == 1.0 and found[6].warnings == [V.NO_HEADING_WARNING]


def test_heading_blanks_may_span_lines(evaluate):
    assert evaluate(V.heading_count, ["# \n## \n# Real Title", "# H1\n## H2\n### H3\ncontent", "plain"]) == [2, 3, 0]


def test_ratio_text_is_rounded_from_the_binary_value(evaluate):
    rng = random.Random(1)
    rows = [(f"{'x' * a}", a * 0 + b) for a, b in [(3, 800), (1, 800), (5, 800), (7, 1600), (1, 32), (3, 32), (1, 160)]]
    rows += [("x" * rng.randint(1, 60), rng.choice([100, 800, 1600, 3200, 20000, 7, 13])) for _ in range(300)]
    options = Validation(min_char_count=0, min_extraction_ratio=100.0, repetition_min_length=1000)
    found = evaluate(lambda t, s: V.validate(t, s, options), rows, "text string, size bigint")
    assert [r.failure_reasons[0] for r in found] == [f"extraction_ratio={len(t) / s:.4f} < min=100.0" for t, s in rows]


# routing and selection


def test_routing_priorities(spark):
    names = [f"/in/test{ext}" for ext in EXTENSION_MODES] + ["/in/test.PDF", "/in/a.xyz", "/in/noextension", "/in/.hidden"]
    df = files(spark, [(n, "") for n in names])
    found = {r.path: r.mode for r in route(df).collect()}
    assert all(found[f"/in/test{ext}"] == mode for ext, mode in EXTENSION_MODES.items())
    assert found["/in/test.PDF"] == "standard"
    assert found["/in/a.xyz"] == found["/in/noextension"] == found["/in/.hidden"] == "unknown"
    override = Modes(extension_overrides={".tif": "ocr", ".PDF": "ocr"})
    found = {r.path: r.mode for r in route(df, override).collect()}
    assert (found["/in/test.tif"], found["/in/test.pdf"], found["/in/test.PDF"]) == ("ocr", "standard", "standard")
    assert {r.mode for r in route(df, override, "high_accuracy").collect()} == {"high_accuracy"}


def test_signatures(spark):
    contents = {
        "application/pdf": b"%PDF-1.7 ...",
        "image/png": b"\x89PNG\r\n\x1a\n....",
        "image/webp": b"RIFF\x00\x00\x00\x00WEBPVP8 ",
        "application/zip": b"PK\x03\x04....",
        "application/epub+zip": b"PK\x03\x04" + b"\x00" * 26 + b"mimetypeapplication/epub+zip",
        None: b"\x00\x01\x02",
    }
    df = spark.createDataFrame([(k, bytearray(v)) for k, v in contents.items()], "expected string, content binary")
    for row in df.select("expected", sniff.binary_type("content").alias("found")).collect():
        assert row.found == row.expected


def test_path_parts(spark):
    names = ["a.b.TXT", "noext", ".dot", "..a", "trail.", "x/y/z.tar.gz", "a b.md"]
    found = {r.path: (r.stem, r.suffix, r.ext) for r in files(spark, [(n, "") for n in names]).collect()}
    assert found == {
        "a.b.TXT": ("a.b", ".TXT", ".txt"),
        "noext": ("noext", "", ""),
        ".dot": (".dot", "", ""),
        "..a": (".", ".a", ".a"),
        "trail.": ("trail.", "", ""),
        "x/y/z.tar.gz": ("z.tar", ".gz", ".gz"),
        "a b.md": ("a b", ".md", ".md"),
    }


def test_hot_stem_keeps_every_row(spark):
    rows = [(f"/in/{i:04d}/index.html", "") for i in range(600)] + [(f"/in/page{i}.html", "") for i in range(1200)]
    df = files(spark, rows).select("path", "stem")
    first = first_of_stem(df)
    assert first.count() == 1800 and first.filter("is_first").count() == 1201
    known = df.filter("path = '/in/0007/index.html' OR path = '/in/page3.html'")
    flagged = flag_existing(df, known, "stem")
    assert flagged.count() == 1800 and flagged.filter("has_output").count() == 601
    assert pending(df, known, "stem").count() == 1199
    assert pending(df, known, "path").count() == 1798
    assert pending(df, known, "path", force=True).count() == 1800


# extraction


def test_csv_tables(evaluate):
    cases = {
        "tree,height\noak,30\nelm,25\n": "| tree | height |\n| --- | --- |\n| oak | 30 |\n| elm | 25 |",
        'a,b\r\n"x, ""y""\nz",1,extra\r\n\r\nshort': '| a | b |  |\n| --- | --- | --- |\n| x, "y" z | 1 | extra |\n| short |  |  |',
        'a"b,c\n"open, to the\nend': '| a"b | c |\n| --- | --- |\n| open, to the end |  |',
        "": "",
        "x|y,": "| x\\|y |  |\n| --- | --- |",
    }
    assert evaluate(lambda t: markup.csv_to_markdown(F.col(t)), list(cases)) == list(cases.values())


def test_long_quoted_cell_does_not_exhaust_the_stack(evaluate):
    cell = '""quoted"" text, ' * 50_000
    (found,) = evaluate(lambda t: markup.csv_to_markdown(F.col(t)), [f'a,b\n"{cell}",2'])
    assert found == "| a | b |\n| --- | --- |\n| " + cell.replace('""', '"') + " | 2 |"


def test_html(evaluate):
    html = (
        "<!DOCTYPE html>\n<html><head><title> T &amp; U </title></head><body><h1 class=x>Hello</h1><p>One<br>two</p>"
        "<ul><li>a</li><li><a href='/u'>b</a></li></ul><script>if (a<b) '</p>'</script>3 < 4</body></html>"
    )
    (md,) = evaluate(H.html_to_markdown, [html])
    assert [x for x in md.split("\n") if x] == ["# Hello", "One", "two", "* a", "* [b](/u)", "3 < 4"]
    assert evaluate(H.html_title, [html, "<p>none</p>"]) == ["T & U", None]


def test_recognised_lines(spark):
    line = "named_struct('box', cast(null as array<array<double>>), 'info', named_struct('text', {0}, 'confidence', 0.9D))"
    pages = f"array(array({line.format(repr(' one '))}, {line.format('cast(null as string)')}), null, array({line.format(repr('  '))}, {line.format(repr('two'))}))"
    df = spark.sql(f"select 'p' as path, {pages} as ocr union all select 'q', null")
    found = {r.path: r for r in extract(df, recognised).collect()}
    assert found["p"].raw_md == "one\n\ntwo" and found["q"].extract_error == "no recognition result"


def test_standard_extraction_reports_what_it_cannot_read(spark):
    df = files(spark, [("a.pdf", "x"), ("b.txt", None), ("c.rst", "text"), ("d", "<html><title>t</title><p>x</p></html>")])
    found = {r.path: r for r in extract(df, standard).collect()}
    assert found["a.pdf"].extract_error == "no extractor registered for .pdf"
    assert found["b.txt"].extract_error == "content is not text"
    assert found["c.rst"].raw_md == "text" and found["d"].title == "t" and found["d"].raw_md.strip() == "x"


# escalation


def test_next_mode(spark):
    def after(mode, chain):
        df = spark.createDataFrame([(mode,)], "mode string")
        return df.select(next_mode(F.col("mode"), Settings(modes=Modes(chain=chain))).alias("n")).first().n

    assert [after(m, ()) for m in DEFAULT_CHAIN] == [*DEFAULT_CHAIN[1:], None]
    assert after("b", ("a", "b", "c")) == "c" and after("only", ("only",)) is None and after("x", ("a", "b")) is None
    assert after("a", ("a", "b", "a", "c")) == "b"


LONG = "word after word in a text that is long enough to pass every check there is"


def run(spark, rows, extractors, settings=Settings()):
    df = spark.createDataFrame(rows, "path string, text string, mode string")
    docs = documents(df, F.col("path"), F.col("text")).join(df.select("path", "mode"), "path")
    done = outcome(escalate(docs.withColumn("skip", F.lit(False)), settings, extractors))
    return {r.path: r for r in done.collect()}


def test_escalation_keeps_the_last_error_and_validation(spark):
    modes = {
        "standard": lambda: extracted(F.lit("short")),
        "paddle_ocr": lambda: failed(F.lit("boom")),
        "ocr": lambda: F.when(F.col("path") == "ok.txt", extracted(F.lit(LONG), F.lit("t"))).otherwise(failed(F.lit("bang"))),
        "high_accuracy": lambda: extracted(F.lit("")),
        "own": lambda: extracted(F.lit("tiny")),
    }
    rows = [("ok.txt", LONG, "standard"), ("late.txt", LONG, "paddle_ocr"), ("bad.txt", LONG, "standard"),
            ("own.txt", LONG, "own"), ("odd.txt", LONG, "nobody knows")]
    got = run(spark, rows, Extractors(modes))
    ok, late, bad, own, odd = (got[p] for p, _, _ in rows)
    assert (ok.status, ok.retry_count, ok.escalated_to, ok.error, ok.title) == ("success", 2, "ocr", None, "t")
    assert (late.status, late.retry_count, late.error) == ("failed", 2, "bang; empty output: char_count=0")
    assert (bad.status, bad.retry_count, bad.escalated_to) == ("failed", 3, "high_accuracy")
    assert bad.failure_reasons == ["bang", "empty output: char_count=0"] and bad.raw_md == ""
    assert (own.status, own.retry_count, own.escalated_to, own.error) == ("failed", 0, None, "char_count=4 < min=50")
    assert odd.error == "char_count=5 < min=50" and odd.retry_count == 0


def test_unregistered_modes_only_leave_an_error(spark):
    got = run(spark, [("a.txt", "short", "standard"), ("b.jpg", None, "paddle_ocr")], Extractors())
    assert got["a.txt"].error == "no extractor registered for mode 'high_accuracy'; char_count=5 < min=50"
    assert got["a.txt"].raw_md == "short" and got["b.jpg"].raw_md is None
    assert got["b.jpg"].error == "no extractor registered for mode 'high_accuracy'" and got["b.jpg"].validation is None


def test_chain_without_standard_and_cyclic_chain(spark):
    chain = Settings(modes=Modes(chain=("ocr", "standard")))
    got = run(spark, [("a.txt", LONG, "ocr")], Extractors(), chain)
    assert got["a.txt"].status == "success" and got["a.txt"].retry_count == 1
    got = run(spark, [("a.txt", LONG, "magic")], Extractors(), Settings(modes=Modes(chain=("ocr",))))
    assert got["a.txt"].status == "success" and got["a.txt"].retry_count == 0
    with pytest.raises(ValueError):
        run(spark, [("a.txt", LONG, "ocr")], Extractors(), Settings(modes=Modes(chain=("ocr", "standard", "ocr"))))


def test_python_engine_sees_only_its_rows(spark):
    def factory():
        seen = []

        def engine(row):
            seen.append(row["path"])
            if "broken" in row["path"]:
                raise ValueError("cannot read " + row["path"])
            return (LONG + " " + row["text"], "title " + row["path"])

        return engine

    rows = [(f"{i}.txt", LONG if i % 3 else "short", "standard") for i in range(30)] + [("broken.txt", "short", "standard")]
    got = run(spark, rows, Extractors({"paddle_ocr": PythonExtractor(factory)}))
    assert all(got[p].retry_count == (1 if text == "short" else 0) for p, text, _ in rows if p != "broken.txt")
    assert got["0.txt"].title == "title 0.txt" and got["0.txt"].raw_md.endswith("short")
    assert got["broken.txt"].failure_reasons[0] == "no extractor registered for mode 'high_accuracy'"
    assert all(r.status == "success" for p, r in got.items() if p != "broken.txt")


def test_engines_that_cannot_be_built_or_answer_oddly(spark):
    def broken():
        raise ImportError("no such package")

    rows = [("a.txt", "short", "standard"), ("b.txt", LONG, "standard")]
    got = run(spark, rows, Extractors({"paddle_ocr": PythonExtractor(broken), "high_accuracy": PythonExtractor(lambda: lambda row: (7, None))}))
    assert got["a.txt"].status == "failed" and got["b.txt"].status == "success"
    assert got["a.txt"].failure_reasons[0] == "extractor answered with int instead of text"
    only = run(spark, rows, Extractors({"high_accuracy": PythonExtractor(broken)}))
    assert only["a.txt"].failure_reasons[0] == "no such package" and only["a.txt"].raw_md == "short"


def test_attempt_summary(spark):
    rows = [("a", 0, "standard", 1, None), ("a", 1, "ocr", None, "boom"), ("a", 2, "high_accuracy", 3, None), ("b", 0, "ocr", None, None)]
    df = spark.createDataFrame(rows, "path string, attempt int, mode string, validation int, error string")
    got = {r.path: r for r in attempt_summary(df).collect()}
    assert tuple(got["a"]) == ("a", "standard", "high_accuracy", 2, 3, "boom")
    assert tuple(got["b"]) == ("b", "ocr", None, 0, None, None)
