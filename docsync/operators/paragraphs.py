"""Paragraph extraction for every format: DataFrame in, (source_path, paragraph_num, page_num, text) out.

Paragraphs are numbered inside the row's array before they are exploded, so that no extractor
that reads one row per file shuffles. Further columns named in ``keep`` are carried along.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docsync.functions import text as T

# Fixed value: the form of a log line.
LOG_LINE = rf"(?d)^(.+?){T.WS}*\|{T.WS}*\[(.+?)\]{T.WS}*\|{T.WS}*(.+)$"


def _explode(df: DataFrame, numbered: Column, keep: Sequence[str], page: Column | None = None) -> DataFrame:
    rows = df.select("source_path", *keep, F.explode(numbered).alias("p"))
    page = F.lit(1) if page is None else page
    return rows.select("source_path", F.col("p.paragraph_num").alias("paragraph_num"), page.cast("int").alias("page_num"), F.col("p.text").alias("text"), *keep)


def without_front_matter(c: Column) -> Column:
    """The text after a front matter block: ``---`` on the first line up to the next line of ``---``."""
    close = F.locate("\n---\n", c, 5)
    return F.when(F.startswith(c, F.lit("---\n")) & (close > 0), F.substr(c, close + 5)).otherwise(c)


def markdown(files: DataFrame, text_col: str = "raw", keep: Sequence[str] = ()) -> DataFrame:
    """Blank-line blocks of Markdown, white space collapsed, front matter left out."""
    body = T.strip(without_front_matter(T.newlines(F.col(text_col))))
    return _explode(files, T.number_kept(T.blank_line_blocks(body)), keep)


def log_message(line: Column) -> Column:
    """``time | [level] | message`` as ``time [level] message``; other lines as they are."""
    return T.collapse(F.regexp_replace(line, LOG_LINE, "$1 [$2] $3"))


def log(files: DataFrame, text_col: str = "raw", keep: Sequence[str] = ()) -> DataFrame:
    """One paragraph per log line that is not blank."""
    lines = F.transform(F.split(T.strip(T.newlines(F.col(text_col))), "\n"), lambda x: log_message(T.strip(x)))
    return _explode(files, T.number_kept(lines), keep)


def log_lines(lines: DataFrame) -> DataFrame:
    """The same for logs too large for one row: ``lines`` (source_path, split_no, line_no, line) in file order by
    (split_no, line_no). Lines are counted per split first, then splits get their offsets, so no task sees a whole file
    unless it is one split."""
    text = log_message(T.strip(F.col("line")))
    kept = lines.select("source_path", "split_no", "line_no", text.alias("text")).filter(F.length("text") > 0)
    within = Window.partitionBy("source_path", "split_no").orderBy("line_no")
    numbered = kept.withColumn("in_split", F.row_number().over(within))
    sizes = numbered.groupBy("source_path", "split_no").agg(F.count("*").alias("n"))
    earlier = Window.partitionBy("source_path").orderBy("split_no").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("source_path", "split_no", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("offset"))
    placed = numbered.join(offsets, ["source_path", "split_no"])
    number = (F.col("offset") + F.col("in_split")).cast("int")
    return placed.select("source_path", number.alias("paragraph_num"), F.lit(1).alias("page_num"), "text")


def log_fields(lines: DataFrame, line_col: str = "line") -> DataFrame:
    """``timestamp``, ``level`` and ``message`` of log lines; null where a line has another form."""
    line = T.strip(T.newlines(F.col(line_col)))
    part = lambda i: F.when(line.rlike(LOG_LINE), F.regexp_extract(line, LOG_LINE, i))
    return lines.withColumns({"timestamp": part(1), "level": part(2), "message": part(3)})


def paged(pages: DataFrame) -> DataFrame:
    """Blank-line blocks of paged text (source_path, page_num, raw_text); numbers run on over the pages.
    A page's own paragraphs are numbered in its row, only the pages' counts meet in the window; a page is one row."""
    blocks = F.filter(T.blank_line_blocks(T.strip(T.newlines(F.col("raw_text")))), lambda t: F.length(t) > 0)
    each = pages.select("source_path", "page_num", blocks.alias("blocks"))
    earlier = Window.partitionBy("source_path").orderBy("page_num").rowsBetween(Window.unboundedPreceding, -1)
    counts = each.groupBy("source_path", "page_num").agg(F.sum(F.size("blocks")).alias("n"))
    offsets = counts.select("source_path", "page_num", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("offset"))
    placed = each.join(offsets, ["source_path", "page_num"])
    rows = placed.select("source_path", "page_num", "offset", F.posexplode("blocks").alias("i", "text"))
    number = (F.col("offset") + F.col("i") + 1).cast("int")
    return rows.select("source_path", number.alias("paragraph_num"), F.col("page_num").cast("int").alias("page_num"), "text")


def split_pages(files: DataFrame, text_col: str = "raw") -> DataFrame:
    """Text with form feeds between pages as (source_path, page_num, raw_text)."""
    return files.select("source_path", F.posexplode(F.split(text_col, "\f")).alias("p", "raw_text")).select("source_path", (F.col("p") + 1).alias("page_num"), "raw_text")


def word_text(files: DataFrame, text_col: str = "raw_text", keep: Sequence[str] = ()) -> DataFrame:
    """The character stream of a binary Word file: form feeds end pages, carriage returns and cell marks end paragraphs,
    vertical tabs are spaces, field marks and other control characters go. Blank paragraphs count but are left out."""
    segments = F.flatten(
        F.transform(
            F.split(text_col, "\f"),
            lambda page, p: F.transform(F.split(page, "[\r\x07]"), lambda s: F.struct((p + 1).alias("page"), s.alias("text"))),
        )
    )
    clean = lambda s: T.strip(F.regexp_replace(F.translate(s, "\x0b", " "), "[\\x00-\\x08\\x0a\\x0e-\\x1f]", ""))
    numbered = F.transform(segments, lambda s, i: F.struct((i + 1).cast("int").alias("paragraph_num"), s["page"].alias("page"), clean(s["text"]).alias("text")))
    kept = F.filter(numbered, lambda s: F.length(s["text"]) > 0)
    return _explode(files, kept, keep, page=F.col("p.page"))


def word_paragraphs(paras: DataFrame) -> DataFrame:
    """Word paragraphs (source_path, para_idx, text, break_before, breaks_inside): blank ones count but are left out; pages
    turn at a break before a paragraph and after each break inside one."""
    order = Window.partitionBy("source_path").orderBy("para_idx")
    before = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    earlier = order.rowsBetween(Window.unboundedPreceding, -1)
    page = 1 + F.sum(F.coalesce("break_before", F.lit(False)).cast("int")).over(before) + F.coalesce(F.sum("breaks_inside").over(earlier), F.lit(0))
    numbered = paras.select("source_path", F.row_number().over(order).alias("paragraph_num"), page.cast("int").alias("page_num"), T.strip(F.col("text")).alias("text"))
    return numbered.filter(F.length("text") > 0)
