"""The registered queries of the document jobs. Integers are given as bigint, so that they compare with SQL's."""

from __future__ import annotations

import hashlib
import re
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docsync.functions.tables import shared_dir, written
from docsync.jobs.sync_folder import routed, sync_folder
from docsync.operators import chunks, html, mail, paragraphs, sync
from docsync.sources import adapters as A
from docsync.sources.collection import Collection
from docsync.sources.files import open_path, walk
from docsync.streaming.changes import Snapshots
from docsync.streaming.incremental import take_new_files

SIZE, OVERLAP = 50, 8


def big(df: DataFrame) -> DataFrame:
    return df.select(*[F.col(c).cast("long").alias(c) if t in ("int", "tinyint", "smallint") else F.col(c) for c, t in df.dtypes])


def _docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.table(spark, sf_dir, "documents")


def md_paragraphs(spark, sf_dir):
    return paragraphs.markdown(A.md_files(_docs(spark, sf_dir)))


def log_paragraphs(spark, sf_dir):
    return paragraphs.log_lines(A.log_lines(A.table(spark, sf_dir, "events")))


def log_fields(spark, sf_dir):
    lines = A.table(spark, sf_dir, "events").select("event_id", A.event_line().alias("line"))
    return paragraphs.log_fields(lines).select("event_id", F.col("timestamp").alias("line_time"), "level", "message")


def doc_paragraphs(spark, sf_dir):
    return paragraphs.word_text(A.word_text(_docs(spark, sf_dir)))


def docx_paragraphs(spark, sf_dir):
    return paragraphs.word_paragraphs(A.word_paragraphs(_docs(spark, sf_dir)))


def pdf_paragraphs(spark, sf_dir):
    return paragraphs.paged(A.pages_text(_docs(spark, sf_dir)))


def msg_paragraphs(spark, sf_dir):
    return mail.messages(A.messages(A.table(spark, sf_dir, "conversations")))


def msg_metadata(spark, sf_dir):
    rows = A.messages(A.table(spark, sf_dir, "conversations")).select("source_path", mail.attrs().alias("attrs"))
    return rows.select("source_path", *[F.element_at("attrs", F.lit(k)).alias(f"mail_{k}") for k in ("subject", "sender", "to", "cc", "bcc", "date", "attachments")])


def html_paragraphs(spark, sf_dir):
    return html.html(A.html_files(A.table(spark, sf_dir, "pages")))


def html_titles(spark, sf_dir):
    blocks = html.html_blocks(A.html_files(A.table(spark, sf_dir, "pages")))
    return blocks.filter("pos = 0").select("source_path", "title")


def html_varied_blocks(spark, sf_dir):
    """Blocks of pages with elements of all kinds, inside and outside ``main`` and of those that are no content."""
    return html.html_blocks(A.varied_pages(_docs(spark, sf_dir))).select("source_path", "pos", "tag", "block_text", "title")


def heading_path(spark, sf_dir):
    return html.html_paragraphs(A.heading_blocks(_docs(spark, sf_dir)))


def sentences(spark, sf_dir):
    return chunks.sentences(A.line_paragraphs(_docs(spark, sf_dir)))


def token_chunks(spark, sf_dir):
    return chunks.token_windows(A.line_paragraphs(_docs(spark, sf_dir)), SIZE, OVERLAP)


def md_token_chunks(spark, sf_dir):
    """Markdown to collection rows: paragraphs, windows and metadata."""
    docs = _docs(spark, sf_dir)
    files = A.listing(docs)
    made = chunks.token_windows(paragraphs.markdown(A.md_files(docs)))
    return sync.with_metadata(made, files).drop("attrs")


def semantic_breaks(spark, sf_dir):
    rows = chunks.semantic_breaks(A.line_paragraphs(_docs(spark, sf_dir)))
    return rows.select("source_path", "paragraph_num", "sent_idx", (F.round("distance", 6) + F.lit(0.0)).alias("distance"), "cut")


def semantic_chunks(spark, sf_dir):
    return chunks.semantic_chunks(A.line_paragraphs(_docs(spark, sf_dir)))


def repair_boundaries(spark, sf_dir):
    return chunks.repair_sentences(A.line_nodes(_docs(spark, sf_dir))).select("source_path", "node", "text", "paragraph_num", "page_num")


def file_signatures(spark, sf_dir):
    return A.listing(_docs(spark, sf_dir)).select("source_path", "source_name", "suffix", "file_signature")


def sync_plan(spark, sf_dir):
    docs = _docs(spark, sf_dir)
    return sync.plan(A.listing(docs), A.collection(docs))


def sync_plan_in_order(spark, sf_dir):
    return sync.in_order(sync_plan(spark, sf_dir))


def sync_removed(spark, sf_dir):
    docs = _docs(spark, sf_dir)
    return sync.removed(A.listing(docs), A.collection(docs))


def sync_new(spark, sf_dir):
    docs = _docs(spark, sf_dir)
    return sync.added(A.listing(docs), A.collection(docs))


def sync_changed(spark, sf_dir):
    docs = _docs(spark, sf_dir)
    return sync.changed(A.listing(docs), A.collection(docs))


def sync_apply(spark, sf_dir):
    """The plan applied with the chunks of the new and changed files' whole texts."""
    docs = _docs(spark, sf_dir)
    files, before = A.listing(docs), A.collection(docs)
    plan = sync.plan(files, before)
    todo = plan.filter(F.col("action").isin("new", "changed")).select("source_path")
    texts = A.md_files(docs, A.stored_suffix()).join(todo, "source_path", "left_semi")
    fresh = sync.with_metadata(chunks.chunk(paragraphs.markdown(texts), "simple"), files)
    return sync.apply(before, plan, fresh).drop("attrs")


class Fours:
    """A coder whose tokens are up to four characters."""

    def encode_ordinary_batch(self, texts: list[str]) -> list[list[int]]:
        return [[int.from_bytes(b"\1" + t[i : i + 4].encode()) for i in range(0, len(t), 4)] for t in texts]

    def decode_single_token_bytes(self, token: int) -> bytes:
        return token.to_bytes((token.bit_length() + 7) // 8)[1:]


def coder_chunks(spark, sf_dir):
    """Token windows by a coder that workers load."""
    return chunks.token_windows(A.line_paragraphs(_docs(spark, sf_dir)), SIZE, OVERLAP, chunks.coder_tokens(Fours))


def _load_bag():
    """A model: the default embedding, computed in Python."""

    def vectors(texts: list[str]) -> list[list[float]]:
        found = []
        for text in texts:
            counts = [0.0] * 32
            for word in re.split("[^a-z0-9]+", text.lower()):
                if word:
                    counts[int(hashlib.md5(word.encode()).hexdigest()[:4], 16) % 32] += 1
            found.append(counts)
        return found

    return vectors


def model_breaks(spark, sf_dir):
    """Semantic breakpoints by a model that workers load, its vectors stored by content: the second of two runs takes them from there."""
    stored = chunks.StoredVectors(chunks.model_embedding(_load_bag), f"{shared_dir(spark).rstrip('/')}/vectors-{uuid.uuid4().hex}")
    for _ in range(2):
        rows = chunks.semantic_breaks(A.line_paragraphs(_docs(spark, sf_dir)), embed=stored)
    return rows.select("source_path", "paragraph_num", "sent_idx", (F.round("distance", 6) + F.lit(0.0)).alias("distance"), "cut")


def _keyed() -> list[Column]:
    key = F.regexp_extract("source_path", r"/(logs/user|pages/page_id)=(\d+)/", 2).cast("long")
    return [F.regexp_extract("source_path", r"\.([a-z]+)$", 1).alias("kind"), key.alias("key")]


def streamed_files(spark, sf_dir):
    """A folder taken by the stream of new files in batches of 400: what the collection holds then."""
    folder, place = A.folder_of_files(spark, sf_dir), f"{shared_dir(spark).rstrip('/')}/stream-{uuid.uuid4().hex}"
    take_new_files(spark, folder, f"{place}/collection", f"{place}/work", f"{place}/state", max_files=400, chunker="simple").awaitTermination()
    rows = Collection(spark, f"{place}/collection").read()
    return rows.select(*_keyed(), "chunk_index", "text", "paragraph_num", "page_num")


def folder_changes(spark, sf_dir):
    """The differences of three listings of a folder: all files come, those of some users and pages go, and those of some pages come again."""
    folder, place = A.folder_of_files(spark, sf_dir), f"{shared_dir(spark).rstrip('/')}/changes-{uuid.uuid4().hex}"
    snapshots, found = Snapshots(spark, folder, place), []
    for number in range(3):
        if number == 1:
            A.delete_folders(A.table(spark, sf_dir, "events").filter("user_id % 3 = 0").select(F.col("user_id").alias("user")), f"{folder}/logs", "user")
            A.delete_folders(A.table(spark, sf_dir, "pages").filter("page_id % 3 = 0").select("page_id"), f"{folder}/pages", "page_id")
        if number == 2:
            A.write_pages(A.table(spark, sf_dir, "pages").filter("page_id % 6 = 0"), folder)
        changes = snapshots.take(number)
        found.append(written(changes.select(*_keyed(), F.lit(number).cast("long").alias("listing"), "change"), "changes"))  # only the last two are kept in place
    return found[0].unionByName(found[1]).unionByName(found[2])


def sync_pass(spark, sf_dir):
    """Two passes over a folder of files written from ``events`` and ``pages``: what the collection holds after them."""
    folder, place = A.folder_of_files(spark, sf_dir), f"{shared_dir(spark).rstrip('/')}/pass-{uuid.uuid4().hex}"
    for _ in range(2):
        sync_folder(spark, folder, f"{place}/collection", f"{place}/work", chunker="simple")
    rows = Collection(spark, f"{place}/collection").read()
    key = F.regexp_extract("source_path", r"/(logs/user|pages/page_id)=(\d+)/", 2).cast("long")
    return rows.select(F.regexp_extract("source_path", r"\.([a-z]+)$", 1).alias("kind"), key.alias("key"), "chunk_index", "text", "paragraph_num", "page_num")


def sync_pass_runs(spark, sf_dir):
    """The summaries of two passes over such a folder: the second has nothing to do."""
    folder, place = A.folder_of_files(spark, sf_dir), f"{shared_dir(spark).rstrip('/')}/pass-{uuid.uuid4().hex}"
    for _ in range(2):
        sync_folder(spark, folder, f"{place}/collection", f"{place}/work", chunker="simple")
    return Collection(spark, f"{place}/collection").runs().drop("finished_at")


def walked_files(spark, sf_dir):
    """A walk over such a folder: the files of its tree, and how many have a usable signature."""
    folder, place = A.folder_of_files(spark, sf_dir), f"{shared_dir(spark).rstrip('/')}/walk-{uuid.uuid4().hex}"
    found, _ = walk(spark, folder, place)
    kind = F.substring("suffix", 2, 10).alias("kind")
    key = F.regexp_extract("source_path", r"/(logs/user|pages/page_id)=(\d+)/", 2).cast("long").alias("key")
    return found.groupBy(kind, key).agg(F.count("*").alias("n_files"), F.count_if(F.col("file_signature").rlike(r"^\d+:\d+$")).alias("n_signed"))


def _failing(path: str):
    """Opens files but those of some users and pages, as a live folder may give them."""
    key = int(re.search(r"/(?:logs/user|pages/page_id)=(\d+)/", path)[1])
    if key % 7 == 0:
        raise FileNotFoundError(path)
    if key % 7 == 1:
        raise PermissionError(path)
    return open_path(path)


def sync_quarantine(spark, sf_dir):
    """What becomes of the files of such a folder in a pass to which some of them are missing or unreadable: published or the reason."""
    folder, place = A.folder_of_files(spark, sf_dir), f"{shared_dir(spark).rstrip('/')}/pass-{uuid.uuid4().hex}"
    sync_folder(spark, folder, f"{place}/collection", f"{place}/work", opener=_failing, chunker="simple")
    store = Collection(spark, f"{place}/collection")
    published = store.index().select("source_path", F.lit("published").alias("outcome"))
    bad = store.quarantine().select("source_path", F.concat_ws(" ", "stage", F.element_at(F.split("error", ":"), 1)).alias("outcome"))
    key = F.regexp_extract("source_path", r"/(logs/user|pages/page_id)=(\d+)/", 2).cast("long").alias("key")
    return published.unionByName(bad).select(F.regexp_extract("source_path", r"\.([a-z]+)$", 1).alias("kind"), key, "outcome")


def distinct_files(spark, sf_dir):
    return sync.distinct_files(A.listed_twice(_docs(spark, sf_dir)))


def normalised_rows(spark, sf_dir):
    rows = sync.normalised(A.collection(_docs(spark, sf_dir)))
    return rows.select("chunk_id", "source_path", "chunk_index", F.size("attrs").alias("n_attrs"))


def routed_files(spark, sf_dir):
    return routed(A.any_files(_docs(spark, sf_dir)))


def _simple(found: DataFrame) -> DataFrame:
    return chunks.chunk(found, " Simple ", chunk_size=60, overlap_ratio=0.15)


def html_chunks(spark, sf_dir):
    return _simple(html_paragraphs(spark, sf_dir))


def log_chunks(spark, sf_dir):
    return _simple(log_paragraphs(spark, sf_dir))


def pdf_chunks(spark, sf_dir):
    return _simple(pdf_paragraphs(spark, sf_dir))


def docx_chunks(spark, sf_dir):
    return _simple(docx_paragraphs(spark, sf_dir))


def doc_chunks(spark, sf_dir):
    return _simple(doc_paragraphs(spark, sf_dir))


def msg_chunks(spark, sf_dir):
    return _simple(msg_paragraphs(spark, sf_dir))


def sync_summary(spark, sf_dir):
    docs = _docs(spark, sf_dir)
    files, before = A.listing(docs), A.collection(docs)
    return sync.summary(files, before, sync.plan(files, before))


def ingest_batches(spark, sf_dir):
    docs = _docs(spark, sf_dir)
    return sync.ingest_batches(chunks.token_windows(A.line_paragraphs(docs), 5, 1))


def chunk_batches(spark, sf_dir):
    docs = _docs(spark, sf_dir)
    numbered = sync.batch_numbers(chunks.token_windows(A.line_paragraphs(docs), 5, 1))
    return numbered.groupBy("source_path", "batch").agg(F.count("*").alias("n_chunks"), F.min("chunk_index").alias("first_chunk"))


NAMES = (
    md_paragraphs, log_paragraphs, log_fields, doc_paragraphs, docx_paragraphs, pdf_paragraphs, msg_paragraphs, msg_metadata, html_paragraphs, html_titles, html_varied_blocks, heading_path,
    sentences, token_chunks, md_token_chunks, semantic_breaks, semantic_chunks, repair_boundaries, file_signatures, sync_plan, sync_plan_in_order, sync_removed, sync_new, sync_changed, sync_apply,
    sync_summary, ingest_batches, chunk_batches, coder_chunks, model_breaks, streamed_files, folder_changes, sync_pass, sync_pass_runs, sync_quarantine, walked_files, distinct_files, normalised_rows, routed_files, html_chunks, log_chunks, pdf_chunks, docx_chunks,
    doc_chunks, msg_chunks,
)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: (lambda spark, sf_dir, f=f: big(f(spark, sf_dir))) for f in NAMES}
