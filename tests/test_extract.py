"""Golden cases of the extractors."""

from __future__ import annotations

import time

import pytest
from pyspark.sql import functions as F

from docsync.functions import text as T
from docsync.operators import html, mail, paragraphs


def rows(df, *columns):
    return [tuple(r[c] for c in columns) for r in df.orderBy("source_path", "paragraph_num").collect()]


def files(spark, *texts, column="raw"):
    return spark.createDataFrame([(f"/f{i}", t) for i, t in enumerate(texts)], f"source_path string, {column} string")


def texts_of(df):
    return [x[0] for x in rows(df, "text")]


@pytest.mark.parametrize(
    "raw, want",
    [
        ("---\na: 1\n---\nHi", ["Hi"]),
        ("---\n---\nHi", ["--- --- Hi"]),
        ("---\na\n\nb", ["--- a", "b"]),
        ("a\r\n\r\nb\rc", ["a", "b c"]),
        ("  x\x1c y　\n  \n\nz", ["x y", "z"]),
        ("", []),
        (" \n\n \n", []),
        ("# h\n\n* a\n* b", ["# h", "* a * b"]),
    ],
)
def test_markdown(spark, raw, want):
    assert texts_of(paragraphs.markdown(files(spark, raw))) == want


def test_markdown_numbers_kept_blocks_and_skips_nulls(spark):
    df = paragraphs.markdown(files(spark, "a\n\n \n\nb", None))
    assert rows(df, "source_path", "paragraph_num", "page_num", "text") == [("/f0", 1, 1, "a"), ("/f0", 2, 1, "b")]


LOG = [
    ("2026-01-01 10:00:00,1 | [INFO] | a | [x] | b", "2026-01-01 10:00:00,1 [INFO] a | [x] | b"),
    ("t | [ERROR] | (f.py:3) | m", "t [ERROR] (f.py:3) | m"),
    ("plain", "plain"),
    ("a | b | c", "a | b | c"),
    ("x|[L]|y  z", "x [L] y z"),
]


def test_log(spark):
    raw = "\n\n ".join(line for line, _ in LOG) + "\n"
    assert texts_of(paragraphs.log(files(spark, raw))) == [want for _, want in LOG]


def test_log_lines_equal_whole_files(spark):
    raw = "\n\n ".join(line for line, _ in LOG)
    lines = files(spark, raw).select("source_path", F.posexplode(F.split("raw", "\n")).alias("line_no", "line")).withColumn("split_no", F.floor(F.col("line_no") / 3))
    assert rows(paragraphs.log_lines(lines), "paragraph_num", "text") == rows(paragraphs.log(files(spark, raw)), "paragraph_num", "text")


def test_log_fields(spark):
    df = paragraphs.log_fields(spark.createDataFrame([("t | [I] | m | n",), ("none",)], "line string"))
    assert [(r.timestamp, r.level, r.message) for r in df.collect()] == [("t", "I", "m | n"), (None, None, None)]


def test_word_text(spark):
    df = paragraphs.word_text(files(spark, "A\r\rB\x0cC", "a\x0bb\x13c\nd\te\x07 \x07f", column="raw_text"))
    assert rows(df, "text", "paragraph_num", "page_num") == [("A", 1, 1), ("B", 3, 1), ("C", 4, 2), ("a bcd\te", 1, 1), ("f", 3, 1)]


def test_word_paragraphs(spark):
    df = spark.createDataFrame([("/d", 1, "A", False, 1), ("/d", 2, " ", None, 0), ("/d", 3, " B  b ", True, None)], "source_path string, para_idx int, text string, break_before boolean, breaks_inside int")
    assert rows(paragraphs.word_paragraphs(df), "text", "paragraph_num", "page_num") == [("A", 1, 1), ("B  b", 3, 3)]


def test_paged(spark):
    df = spark.createDataFrame([("/p", 1, "x"), ("/p", 2, " \n"), ("/p", 3, "y\n\nz")], "source_path string, page_num int, raw_text string")
    assert rows(paragraphs.paged(df), "text", "paragraph_num", "page_num") == [("x", 1, 1), ("y", 2, 3), ("z", 3, 3)]
    split = paragraphs.split_pages(files(spark, "x\f \n\fy\n\nz"))
    assert rows(paragraphs.paged(split), "text", "page_num") == [("x", 1), ("y", 3), ("z", 3)]


MAIL = "source_path string, subject string, sender string, to string, cc string, bcc string, date string, attachments array<string>, body string, html_body string"


def test_mail(spark):
    df = spark.createDataFrame(
        [
            ("/a", "S", " F ", None, "", None, None, ["a", " ", "b", None], "hi\n\nyo​­", None),
            ("/b", None, None, None, None, None, None, None, " ", "<p>x&amp;y</p><style>no</style><p>z</p>"),
            ("/c", None, None, None, None, None, None, None, None, None),
        ],
        MAIL,
    )
    assert rows(mail.messages(df), "source_path", "paragraph_num", "text") == [
        ("/a", 1, "Subject: S From: F Attachments: a, b"), ("/a", 2, "hi"), ("/a", 3, "yo"), ("/b", 1, "x&y z")
    ]
    assert df.select(mail.attrs().alias("m")).first().m["attachments"] == "a; b"


def page(body, title=""):
    return f"<html><head><title>{title}</title></head><body>{body}</body></html>"


@pytest.mark.parametrize(
    "body, want",
    [
        ("<form><main><p>a</p></main></form>", []),
        ("<ul><li>a<ul><li>b</li></ul></li></ul>", [("li", "a b"), ("li", "b")]),
        ("<p><b>fo</b>o</p>", [("p", "fo o")]),
        ("<p>x&amp;y &foo; &#147;q</p>", [("p", "x&y &foo “q")]),
        ("<nav><p>n</p></nav><p>a<!-- c -->b</p><script><p>s</p></script>", [("p", "a b")]),
        ("<p>out</p><main><p>in</p></main>", [("p", "in")]),
        ("<p>a<br>b<p>c", [("p", "a b c"), ("p", "c")]),
        ("<p></p><td>t</td></table>", [("td", "t")]),
    ],
)
def test_html_blocks(body, want):
    assert html.parse_blocks(page(body))[1] == want


def test_html_titles():
    assert html.parse_blocks(page("", " A\n &amp; B "))[0] == "A & B"
    assert html.parse_blocks(None) == ("", [])
    assert html.parse_blocks("<svg><title>no</title></svg><p>a")[0] == ""


def test_html_headings(spark):
    df = html.html(files(spark, page("<h1>A</h1><h2>B</h2><p>x</p><h1>C</h1><p>y</p>", "T"), page("<p>z</p>"), "", None), "raw")
    assert texts_of(df) == ["Title: T. Section: A. A", "Title: T. Section: A > B. B", "Title: T. Section: A > B. x", "Title: T. Section: C. C", "Title: T. Section: C. y", "z"]


def test_one_bad_page_is_set_aside(spark):
    def parse(text):
        if "bad" in text:
            raise RuntimeError("cannot be read")
        return html.parse_blocks(text)

    df = html.html_blocks(files(spark, page("<p>a</p>"), page("<p>bad</p>"), page("<p>c</p>")), "raw", parse)
    assert [(r.source_path, r.error) for r in df.filter("error is not null").collect()] == [("/f1", "RuntimeError: cannot be read")]
    assert texts_of(html.html_paragraphs(df.filter("error is null"))) == ["a", "c"]


def test_a_number_that_no_parser_takes_is_an_error_of_its_page(spark):
    df = html.html_blocks(files(spark, page("<p>a</p>"), page("<p>&#" + "9" * 5000 + ";</p>")), "raw")
    assert [r.source_path for r in df.filter("error is not null").collect()] == ["/f1"]


@pytest.mark.parametrize("text", ["<div>x" * 30000, "<div>x</b>" * 30000, "<title>" * 30000, "<p>a</p>" * 30000, "<main><li>" * 20000])
def test_deep_pages_are_read_in_linear_time(text):
    began = time.perf_counter()
    html.BlockParser().feed(text)
    assert time.perf_counter() - began < 10


def test_strip_is_linear(spark):
    began = time.perf_counter()
    got = spark.createDataFrame([("x" + " " * 1_000_000 + "y ",)], "t string").select(F.length(T.strip(F.col("t"))).alias("n")).first().n
    assert got == 1_000_002 and time.perf_counter() - began < 10


def test_utf8(spark):
    df = spark.createDataFrame([(bytearray(b"a\xff\r\nb\rc"),)], "content binary")
    assert df.select(T.utf8(F.col("content")).alias("t")).first().t == "a�\nb\nc"


def test_no_shuffle_before_chunks(spark):
    plan = paragraphs.markdown(files(spark, "a"))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


def listed(spark, folder, place):
    from docsync.sources import files as sources

    found, errors = sources.walk(spark, str(folder), str(place))
    assert errors.count() == 0
    return found


def test_listing_equals_a_recursive_walk(spark, tmp_path):
    import os
    import pathlib

    from docsync.sources.files import SUFFIXES

    root = tmp_path / "in"
    deep = root
    for k in range(12):
        deep = deep / f"level {k}"
        deep.mkdir(parents=True)
        (deep / f"{k}.md").write_text("x" * k)
    for name in ("a b.md", "c.HTML", "d.txt", ".md", "._hidden.log", "_under.md", ".dir/e.log", "_dir/f.msg", "g%20{x}[y]*.md", "\u00e9.doc"):
        (root / name).parent.mkdir(exist_ok=True)
        (root / name).write_bytes(b"" if "hidden" in name else b"l\xff")
    (root / "empty").mkdir()
    for i in range(300):
        (root / f"wide{i % 30}").mkdir(exist_ok=True)
        (root / f"wide{i % 30}" / f"{i}.log").write_text("l")
    os.symlink(root / "a b.md", root / "link.md")
    os.symlink(root, root / "_dir" / "loop")  # links to directories are not followed
    os.symlink(root / "nowhere", root / "broken.md")
    want = {}
    for p in pathlib.Path(root).rglob("*"):
        if p.is_file() and p.suffix.lower() in SUFFIXES:
            s = p.stat()
            want.setdefault(str(p.resolve()), []).append((s.st_size, s.st_mtime_ns, f"{s.st_size}:{s.st_mtime_ns}"))
    got = {}
    for r in listed(spark, root, tmp_path / "place").collect():
        got.setdefault(r.source_path, []).append((r.size, r.mtime_ns, r.file_signature))
    assert got == want and len(got[str(root / "a b.md")]) == 2 and got[str(root / "._hidden.log")][0][0] == 0
    assert listed(spark, f"file://{root}", tmp_path / "again").count() == sum(map(len, want.values()))


def test_a_folder_that_is_not_there_is_an_error(spark, tmp_path):
    from docsync.sources import files as sources

    with pytest.raises(FileNotFoundError):
        sources.walk(spark, str(tmp_path / "none"), str(tmp_path / "place"))


def test_paths_below_directories(spark):
    from docsync.sources import files as sources

    paths = spark.createDataFrame([("/a/b/c.md",), ("/a/bc/d.md",), ("/e.md",)], "source_path string")
    bad = spark.createDataFrame([("/a/b", "x"), ("/f", "x")], "path string, error string")
    assert [r[0] for r in sources.under(paths, bad).collect()] == ["/a/b/c.md"]
    assert sources.under(paths, bad.withColumn("path", F.lit("/a"))).count() == 2


@pytest.mark.parametrize("size", [1, 2, 3, 7, 64, 10_000])
def test_lines_of_ranges_equal_lines_of_the_file(size):
    import io
    import random
    import re

    from docsync.sources.files import log_range

    for seed in range(40):
        r = random.Random(seed)
        data = b"".join(r.choice([b"a", b"bc", b"\n", b"\r", b"\r\n", b"\xc3\xa9", b" "]) for _ in range(r.randrange(60)))
        got = [x for first in range(0, len(data), size) for x in log_range(io.BytesIO(data + b"added later\n"), first, size, len(data), 1000)]
        want = re.split(b"\r\n|\n|\r", data)
        assert [x for x in got if x] == [x for x in want if x], data
    assert list(log_range(io.BytesIO(b"\xef\xbb\xbfa\nb"), 0, 6, 6, 1000)) == [b"a", b"b"]


def test_log_files_by_range_equal_whole_files(spark, tmp_path):
    from docsync.sources import files as sources

    body = "\n".join(f"2026-01-01 {i} | [INFO] |  m {i} \u00e9" if i % 3 else " " for i in range(5000))
    (tmp_path / "in").mkdir()
    for name in ("a b+c%20.log", "{x}[y].log", "d.log", "empty.log"):
        (tmp_path / "in" / name).write_bytes(b"" if name == "empty.log" else ("\r\n" if name == "d.log" else "\n").join(body.split("\n")).encode() + b"\xff")
    found = listed(spark, tmp_path / "in", tmp_path / "place")
    contents = sources.read_files(found, str(tmp_path / "read"), range_bytes=20_000)
    assert contents.filter("outcome = 'ok'").count() > 20 and sources.failed_files(contents).count() == 0
    split = rows(paragraphs.log_lines(sources.log_lines(contents)), "source_path", "paragraph_num", "text")
    raw = spark.read.text([str(tmp_path / "in")], wholetext=True)
    whole = paragraphs.log(raw.select(sources.key_of(F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))).alias("source_path"), F.make_valid_utf8("value").alias("raw")))
    assert split == rows(whole, "source_path", "paragraph_num", "text") and len(split) == 3 * 3333


def test_reads_are_one_job_of_even_tasks(spark, tmp_path):
    from docsync.sources import files as sources

    (tmp_path / "in").mkdir()
    for i in range(3000):
        (tmp_path / "in" / f"{i}.md").write_bytes(b"x" * (i % 1500))
    (tmp_path / "in" / "long.log").write_bytes(b"l\n" * 2_000_000)
    files = listed(spark, tmp_path / "in", tmp_path / "place")
    planned = sources.ranges(files, 200_000).withColumns({"part": F.spark_partition_id(), "at": F.monotonically_increasing_id()})
    planned.write.parquet(str(tmp_path / "planned"))
    planned = spark.read.parquet(str(tmp_path / "planned"))
    total, n = planned.agg(F.sum("n_bytes"), F.count("*")).first()
    dealt, bins = sources.packed(planned, total, n, 4, 1_000_000)
    each = [r.b for r in dealt.groupBy("bin").agg(F.sum(F.col("n_bytes") + sources.OPEN_BYTES).alias("b")).collect()]
    assert len(each) == bins and max(each) <= 2 * sum(each) / len(each) and dealt.count() == n
    plan = dealt.repartitionById(bins, F.col("bin"))
    assert plan.groupBy(F.spark_partition_id().alias("p"), "bin").count().count() == bins  # a task reads one bin

    spark.sparkContext.setJobGroup("reads", "")
    contents = sources.read_files(files, str(tmp_path / "read"))
    jobs = spark.sparkContext.statusTracker().getJobIdsForGroup("reads")
    spark.sparkContext.setJobGroup("", "")
    assert len(jobs) <= 8  # planning, sums, reading: however many files there are
    assert contents.filter("outcome = 'ok'").count() == 3001 and contents.filter("line_no is not null").count() == 2_000_000


def test_outcomes_of_files(spark, tmp_path):
    from docsync.sources import files as sources

    names = ("good.md", "gone.md", "locked.md", "huge.md", "huge.log", "wide.log")
    for name in names:
        (tmp_path / name).write_text("first\nsecond")
    (tmp_path / "wide.log").write_text("x" * 5000)
    found = [(str(tmp_path / n), str(tmp_path / n), n[n.index(".") :], 3 << 30 if n == "huge.md" else (tmp_path / n).stat().st_size) for n in names]
    (tmp_path / "gone.md").unlink()

    def opener(path):
        if path.endswith("locked.md"):
            raise PermissionError(path)
        return open(path, "rb")

    files = spark.createDataFrame(found, "path string, source_path string, suffix string, size long")
    contents = sources.read_files(files, str(tmp_path / "read"), opener, largest=1000)
    bad = {r.source_path.rsplit("/", 1)[1]: r.error.split(":")[0] for r in sources.failed_files(contents).collect()}
    assert bad == {"gone.md": "missing", "locked.md": "unreadable", "huge.md": "too large", "wide.log": "too large"}
    assert [r.raw for r in sources.texts(contents).collect()] == ["first\nsecond"]
    assert sorted(r.line for r in sources.log_lines(contents).collect()) == ["first", "second"]
    assert sources.read_files(files.limit(0), str(tmp_path / "none")).count() == 0


def test_pages_of_many_blocks_go_out_in_small_batches(spark, monkeypatch):
    """A worker holds a few thousand blocks, however many the pages of its batch have."""
    import pandas as pd

    from docsync.operators import html

    taken = {}

    class Given:
        def select(self, *_):
            return self

        def mapInPandas(self, run, schema):  # noqa: N802  as Spark's
            taken["run"] = run

    html.html_blocks(Given())
    page = "<title>t</title>" + "<p>some text</p>" * 1_000
    frames = list(taken["run"](iter([pd.DataFrame({"source_path": [f"/{i}" for i in range(30)], "html": [page] * 30})])))
    assert sum(map(len, frames)) == 30_000 and max(map(len, frames)) <= html.ROWS
    rows = [(r.source_path, r.pos) for frame in frames for r in frame.itertuples()]
    assert rows == [(f"/{i}", k) for i in range(30) for k in range(1_000)]
    long = f"<p>{'x' * html.BATCH_CHARS}</p>"
    assert max(map(len, taken["run"](iter([pd.DataFrame({"source_path": list("abc"), "html": [long] * 3})])))) == 1


@pytest.mark.parametrize("given, want", [("x &copyright y", "x &copyright y"), ("?a=1&regional=2", "?a=1&regional=2"), ("token = &quot", 'token = "'), ("a &amp", "a &")])
def test_names_of_characters_are_whole(given, want):
    """A name that only begins with a known one is text; a known one needs no semicolon, as in a title that was cut in its middle."""
    assert html.parse_blocks(page(f"<h1>{given}</h1>", given)) == (want, [("h1", want)])
