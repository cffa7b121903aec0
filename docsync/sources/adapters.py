"""The driver's tables as the inputs that the operators read. Each adapter is deterministic and narrow unless said otherwise."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from docsync.functions.tables import dealt_out, shared_dir
from docsync.operators import sync
from docsync.sources.files import SUFFIXES, Store, name_of, suffix_of


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return dealt_out(spark.read.parquet(f"{sf_dir}/{name}.parquet"))


def doc_path(suffix: Column | str = ".md") -> Column:
    suffix = F.lit(suffix) if isinstance(suffix, str) else suffix
    return F.concat(F.lit("/docs/"), F.coalesce("source", F.lit("none")), F.lit("/"), F.col("doc_id").cast("string"), suffix)


def _lines() -> Column:
    return F.split("text", "\n")


def stored_suffix() -> Column:
    return F.when(F.col("doc_id") % 50 == 9, ".MD").otherwise(".md")


def md_files(docs: DataFrame, suffix: Column | str = ".md") -> DataFrame:
    """Documents as Markdown: blank lines between their lines, front matter on even ids."""
    front = F.when(F.col("doc_id") % 2 == 0, F.concat(F.lit("---\nlang: "), F.coalesce("lang", F.lit("")), F.lit("\n---\n"))).otherwise(F.lit(""))
    return docs.select(doc_path(suffix).alias("source_path"), F.concat(front, F.regexp_replace("text", "\n", "\n\n")).alias("raw"))


def event_line() -> Column:
    value = F.floor(F.col("value") * 100).cast("string")
    stamp = F.date_format("ts", "yyyy-MM-dd HH:mm:ss")
    plain = F.concat_ws(" ", F.lit("plain"), "event_type", value)
    return F.when(F.col("event_id") % 7 == 0, plain).otherwise(F.concat(stamp, F.lit(" | ["), F.upper("event_type"), F.lit("] |  value="), value, F.lit(" "), F.coalesce("props", F.lit(""))))


def log_lines(events: DataFrame) -> DataFrame:
    """Events as log lines, a file per user, a split per day; every 11th event is followed by a blank line."""
    path = F.concat(F.lit("/logs/"), F.col("user_id").cast("string"), F.lit(".log"))
    day = F.datediff("ts", F.lit("1970-01-01")).cast("long")
    base = events.select(path.alias("source_path"), day.alias("split_no"), "ts", "event_id", event_line().alias("line"))
    order = Window.partitionBy("source_path", "split_no").orderBy("ts", "event_id")
    numbered = base.withColumn("rn", F.row_number().over(order))
    lines = F.when(F.col("event_id") % 11 == 0, F.array("line", F.lit("  "))).otherwise(F.array("line"))
    return numbered.select("source_path", "split_no", "rn", F.posexplode(lines).alias("i", "line")).select("source_path", "split_no", (F.col("rn") * 2 + F.col("i")).alias("line_no"), "line")


def word_text(docs: DataFrame) -> DataFrame:
    """Documents as the character stream of a Word file, with page, cell and field marks."""
    mark = lambda i: F.when(i % 5 == 4, "\f").when(i % 5 == 0, "\r\r").when(i % 5 == 1, "\x07").otherwise("\r")
    one = lambda x, i: F.concat(F.when(i % 3 == 2, "\x0b").otherwise(""), x, F.when(i % 4 == 3, "\x13").otherwise(""), mark(i))
    return docs.select(doc_path(".doc").alias("source_path"), F.array_join(F.transform(_lines(), one), "").alias("raw_text"))


def word_paragraphs(docs: DataFrame) -> DataFrame:
    """Documents as Word paragraphs, one per line, with breaks; a blank one follows every fifth line."""
    lines = F.flatten(F.transform(_lines(), lambda x, i: F.when(i % 5 == 4, F.array(x, F.lit(" "))).otherwise(F.array(x))))
    rows = docs.select(doc_path(".docx").alias("source_path"), F.posexplode(lines).alias("i", "text"))
    n = F.col("i") + 1
    return rows.select("source_path", n.alias("para_idx"), "text", (n % 9 == 0).alias("break_before"), F.when(n % 5 == 0, 1).otherwise(0).alias("breaks_inside"))


def pages_text(docs: DataFrame) -> DataFrame:
    """Documents as paged text: five lines a page, a blank page after every third."""
    rows = docs.select(doc_path(".pdf").alias("source_path"), _lines().alias("lines"))
    page = lambda p: F.array_join(F.slice("lines", p * 5 + 1, 5), "\n\n")
    pages = F.transform(F.sequence(F.lit(0), F.ceil(F.size("lines") / 5).cast("int") - 1), lambda p: F.when(p % 3 == 2, F.array(page(p), F.lit(" \n"))).otherwise(F.array(page(p))))
    return rows.select("source_path", F.posexplode(F.flatten(pages)).alias("p", "raw_text")).select("source_path", (F.col("p") + 1).alias("page_num"), "raw_text")


def messages(conversations: DataFrame) -> DataFrame:
    """Conversation turns as mails; some have an HTML body only, some zero-width characters."""
    odd, third = F.col("turn") % 2 == 1, F.col("turn") % 3 == 0
    body = F.regexp_replace(F.regexp_replace("text", r"\. ", ".​­ "), "\n", "\n\n")
    html_only = F.col("conv_id") % 10 == 0
    escaped = F.replace(F.replace(F.replace("text", F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))
    page = F.concat(F.lit("<div><p>"), F.replace(escaped, F.lit("\n"), F.lit("</p><p>")), F.lit("</p><style>p{margin:0}</style></div>"))
    return conversations.select(
        F.concat(F.lit("/mail/"), F.col("conv_id").cast("string"), F.lit("-"), F.col("turn").cast("string"), F.lit(".msg")).alias("source_path"),
        F.concat(F.lit(" Talk "), F.col("conv_id").cast("string")).alias("subject"),
        F.col("role").alias("sender"),
        F.lit("team").alias("to"),
        F.when(~odd, F.concat(F.lit("cc"), F.col("turn").cast("string"))).alias("cc"),
        F.lit("").alias("bcc"),
        F.concat(F.lit("2026-01-0"), (F.col("turn") % 9 + 1).cast("string")).alias("date"),
        F.when(third, F.array(F.lit("a.txt "), F.lit(" "), F.concat(F.lit("b"), F.col("turn").cast("string")))).alias("attachments"),
        F.when(html_only, "  ").otherwise(body).alias("body"),
        F.when(html_only, page).alias("html_body"),
    )


def html_files(pages: DataFrame) -> DataFrame:
    return pages.select(F.concat(F.lit("/pages/"), F.col("page_id").cast("string"), F.lit(".html")).alias("source_path"), "html")


def varied_pages(docs: DataFrame) -> DataFrame:
    """Documents as HTML pages, a line in an element of each kind in turn, some of them no content; even ones have a title and a ``main`` with more around it, odd ones a body only."""
    kinds = [
        "<h2>{}</h2>", "<p>{}</p>", "<ul><li>{}</li></ul>", "<table><tr><td>{}</td><th> </th></tr></table>", "<blockquote>{}</blockquote>", "<figure><img><figcaption>{}</figcaption></figure>",
        "<aside><div><p>{}</p></div></aside>", "<nav><ul><li>{}</li></ul></nav>", "<div>{}</div><script>if (1 < 2) '<p>x</p>'</script><!-- <p>y</p> -->",
    ]
    escaped = lambda c: F.replace(F.replace(F.replace(c, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&#62;"))
    kind = lambda pos: F.element_at(F.array(*map(F.lit, kinds)), (pos % len(kinds) + 1).cast("int"))
    body = F.array_join(F.transform(_lines(), lambda line, pos: F.replace(kind(pos), F.lit("{}"), escaped(line))), "\n")
    head = F.concat(F.lit("<html><head><title> "), escaped(F.coalesce("source", F.lit(""))), F.lit("</title><style>p {}</style></head><body><p>before</p>"))
    around = F.concat(F.lit("<body><header><p>top</p></header>"), body, F.lit("<footer><p>foot</p></footer></body>"))
    inside = F.concat(head, F.lit("<main>"), body, F.lit("</main><p>after</p></body></html>"))
    page = F.when(F.col("doc_id") % 2 == 0, inside).otherwise(around)
    return docs.filter("text is not null").select(doc_path(".html").alias("source_path"), page.alias("html"))


def heading_blocks(docs: DataFrame) -> DataFrame:
    """Documents as HTML blocks, one per line; every third is a heading of a level that follows id and place."""
    rows = docs.select("doc_id", "source", doc_path(".html").alias("source_path"), F.posexplode(_lines()).alias("pos", "line"))
    tag = F.when(F.col("pos") % 3 == 0, F.concat(F.lit("h"), (1 + (F.col("doc_id") + F.col("pos")) % 6).cast("string"))).otherwise("p")
    title = F.when(F.col("doc_id") % 2 == 0, F.col("source")).otherwise("")
    return rows.select("source_path", F.col("pos").cast("long").alias("pos"), tag.alias("tag"), F.col("line").alias("block_text"), title.alias("title"))


def line_paragraphs(docs: DataFrame) -> DataFrame:
    """Documents as paragraphs, one per line."""
    rows = docs.select(doc_path().alias("source_path"), F.posexplode(_lines()).alias("i", "text"))
    return rows.select("source_path", (F.col("i") + 1).alias("paragraph_num"), F.lit(1).alias("page_num"), "text")


def line_nodes(docs: DataFrame) -> DataFrame:
    """Documents as nodes of a file, one per line."""
    return line_paragraphs(docs).withColumn("node", F.col("paragraph_num") - 1)


def listing(docs: DataFrame) -> DataFrame:
    """Documents as a folder listing: a tenth is gone from disk, some have other suffixes."""
    suffix = F.when(F.col("doc_id") % 50 == 7, ".txt").when(F.col("doc_id") % 50 == 9, ".MD").otherwise(".md")
    path = doc_path(suffix)
    mtime = (F.lit(1700000000) + F.col("doc_id")) * F.lit(1000000000)
    rows = docs.filter(F.col("doc_id") % 10 != 0).select(path.alias("source_path"), F.col("n_chars").alias("size"), mtime.alias("mtime_ns"))
    rows = rows.withColumns({"source_name": name_of(F.col("source_path")), "suffix": suffix_of(F.col("source_path")), "file_signature": sync.signature(F.col("size"), F.col("mtime_ns"))})
    return rows.filter(F.col("suffix").isin(".md"))


def collection(docs: DataFrame) -> DataFrame:
    """Documents as the stored collection before a pass, their lines in one to four chunks: some new, some changed in each of three ways, some out of scope."""
    current = sync.signature(F.col("n_chars"), (F.lit(1700000000) + F.col("doc_id")) * F.lit(1000000000))
    r, n = F.col("doc_id") % 10, (F.col("doc_id") % 4 + 1).cast("int")
    each = F.ceil(F.size(_lines()) / n).cast("int")
    rows = docs.filter(r != 1).select("doc_id", "text", each.alias("each"), doc_path(stored_suffix()).alias("path"), current.alias("current"), F.explode(F.sequence(F.lit(0), n - 1)).alias("i"))
    r, h = F.col("doc_id") % 10, F.col("doc_id") % 100
    sig = F.when(r == 2, "1:1").when((r == 3) & (F.col("i") == 0), F.lit(None)).when((r == 4) & (F.col("i") == F.col("doc_id") % 4), "2:2").otherwise(F.col("current"))
    path = F.when(h == 5, F.lit(None)).when(h == 6, "").otherwise(F.col("path"))
    chunk_id = F.when(h == 15, F.lit(None)).when(h == 16, "").otherwise(F.concat_ws("-", F.col("doc_id").cast("string"), F.col("i").cast("string")))
    text = F.array_join(F.slice(_lines(), F.col("i") * F.col("each") + 1, F.col("each")), "\n")
    return rows.select(
        chunk_id.alias("chunk_id"), path.alias("source_path"), sig.alias("file_signature"), F.col("i").alias("chunk_index"), text.alias("text"),
        F.lit(1).alias("paragraph_num"), F.lit(1).alias("page_num"), name_of(F.col("path")).alias("source_name"), F.when(h != 25, F.create_map().cast("map<string,string>")).alias("attrs"),
    )


def any_files(docs: DataFrame) -> DataFrame:
    """Documents as files of all supported suffixes and one other, with upper-case names among them: (source_path, suffix)."""
    names = F.array(*[F.lit(x) for x in (*SUFFIXES, ".txt")])
    suffix = F.element_at(names, (F.col("doc_id") % (len(SUFFIXES) + 1) + 1).cast("int"))
    path = doc_path(F.when(F.col("doc_id") % 4 == 0, F.upper(suffix)).otherwise(suffix))
    return docs.select(path.alias("source_path")).withColumn("suffix", suffix_of(F.col("source_path")))


def listed_twice(docs: DataFrame) -> DataFrame:
    """The listing with every third file listed again with another signature."""
    rows = listing(docs).select("source_path", "file_signature", "size")
    again = rows.filter("size % 3 = 0").withColumn("file_signature", F.concat(F.lit("9"), "file_signature"))
    return rows.unionByName(again).drop("size")


def write_lines(lines: DataFrame, folder: str, key: str, order: list[str], extension: str) -> None:
    """Write (key, line, *order) as one file of lines for each value of ``key``, in ``order``, with the three letters of ``extension`` as suffix. Texts are written as they are.
    Tasks write their files themselves: a commit by the driver moves one file after the other."""
    spark, run_name = lines.sparkSession, uuid.uuid4().hex
    tasks = max(4 * spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, now, file, n = Store(folder), None, None, 0
        for batch in batches:
            for value, line in zip(*batch.columns, strict=True):
                value, line = value.as_py(), line.as_py()
                if value != now:
                    if file:
                        file.close()
                    now, n = value, n + 1
                    file = store.create(f"{key}={value}/part-{run_name}.{extension}")
                file.write(line.encode() + b"\n")
        if file:
            file.close()
        yield pa.RecordBatch.from_pydict({"n": [n]})

    rows = lines.repartition(tasks, key).sortWithinPartitions(key, *order).select(F.coalesce(F.col(key).cast("string"), F.lit("none")).alias("key"), F.coalesce("line", F.lit("")).alias("line"))
    rows.mapInArrow(run, "n long").agg(F.sum("n")).collect()


def folder_of_files(spark: SparkSession, sf_dir: str) -> str:
    """A new folder in the shared one, with a log file for each user of ``events`` and an HTML file for each of ``pages``."""
    folder = f"{shared_dir(spark).rstrip('/')}/files-{uuid.uuid4().hex}"
    logs = log_lines(table(spark, sf_dir, "events")).withColumn("user", F.regexp_extract("source_path", r"(\d+)\.log$", 1))
    write_lines(logs, f"{folder}/logs", "user", ["split_no", "line_no"], "log")
    write_pages(table(spark, sf_dir, "pages"), folder)
    return folder


def write_pages(pages: DataFrame, folder: str) -> None:
    """An HTML file for each of ``pages`` in a folder of files."""
    lines = pages.select("page_id", F.posexplode(F.split("html", "\n")).alias("n", "line"))
    write_lines(lines, f"{folder}/pages", "page_id", ["n"], "htm")


def delete_folders(keys: DataFrame, folder: str, key: str) -> None:
    """Delete the folders of ``keys`` (one column) in a folder of files, in tasks."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        store, n = Store(folder), 0
        for frame in frames:
            for value in frame["key"]:
                store.delete(f"{key}={value}")
                n += 1
        yield pd.DataFrame({"n": [n]})

    names = keys.select(F.col(key).cast("string").alias("key")).distinct()
    names.mapInPandas(run, "n long").agg(F.sum("n")).collect()
