"""The sync: plans, passes over a folder, versions, streaming."""

from __future__ import annotations

import os

import pytest

from docsync.jobs.sync_folder import sync_folder
from docsync.operators import sync
from docsync.sources import outside
from docsync.sources.collection import Collection, Conflict, buckets_for
from docsync.streaming.incremental import reconcile_on_timer, take_new_files

STORED = "chunk_id string, source_path string, file_signature string"


def test_plan(spark):
    files = spark.createDataFrame([("/same", "s"), ("/same", "s"), ("/new", "n"), ("/sig", "2"), ("/null", "x"), ("/mixed", "m"), ("/empty_id", "e")], "source_path string, file_signature string")
    stored = spark.createDataFrame(
        [("1", "/same", "s"), ("2", "/same", "s"), ("3", "/gone", "g"), ("4", "/sig", "1"), ("5", "/null", "x"), ("6", "/null", None), ("7", "/mixed", "m"), ("8", "/mixed", "k"), ("9", None, "z"), ("10", "", "z"), ("", "/empty_id", "e"), (None, "/ghost", "e")],
        STORED,
    )
    got = {r.source_path: (r.action, r.old_chunks) for r in sync.plan(files, stored).collect()}
    assert got == {"/same": ("unchanged", 2), "/new": ("new", 0), "/gone": ("removed", 1), "/sig": ("changed", 1), "/null": ("changed", 2), "/mixed": ("changed", 2), "/empty_id": ("new", 0)}
    assert [r.source_path for r in sync.in_order(sync.plan(files, stored)).collect()] == ["/gone", *sorted(set(got) - {"/gone"})]
    kept = sync.kept(stored, sync.plan(files, stored)).collect()
    assert sorted(str(r.chunk_id) for r in kept) == ["", "1", "10", "2", "9", "None"]


def test_passes_over_a_folder(spark, tmp_path):
    folder, root, work = (str(tmp_path / n) for n in ("in", "collection", "work"))
    os.makedirs(folder)

    def put(name, text):
        with open(f"{folder}/{name}", "w") as f:
            f.write(text)

    put("a.md", "One sentence. Two sentences.\n\nThree.")
    put("b.html", "<title>T</title><h1>H</h1><p>text.</p>")
    put("c.log", "t | [I] | m.")
    run = sync_folder(spark, folder, root, work, chunker="simple")
    assert (run["local_files"], run["remote_docs"], run["removed_paths"], run["added_or_updated_files"]) == (3, 0, 0, 3)
    first = {r.source_name: r.text for r in Collection(spark, root).read().collect()}
    assert first["c.log"] == "t [I] m. " and first["b.html"].startswith("Title: T. Section: H. H ")

    again = sync_folder(spark, folder, root, work, chunker="simple")
    assert (again["added_or_updated_files"], again["removed_paths"], again["version"]) == (0, 0, run["version"])

    put("a.md", "Now another text of another length.")
    put("c.log", " \n")
    os.remove(f"{folder}/b.html")
    third = sync_folder(spark, folder, root, work, chunker="simple")
    assert (third["removed_paths"], third["added_or_updated_files"]) == (1, 2)
    assert {r.source_name: r.text for r in Collection(spark, root).read().collect()} == {"a.md": "Now another text of another length. "}

    fourth = sync_folder(spark, folder, root, work, chunker="simple")  # the blank file has no chunks and is new each time
    assert (fourth["added_or_updated_files"], fourth["removed_paths"]) == (1, 0)

    fresh = str(tmp_path / "fresh")
    sync_folder(spark, folder, fresh, work, chunker="simple")
    whole = lambda r: sorted(map(str, Collection(spark, r).read().collect()))
    assert whole(root) == whole(fresh)


def test_decoded_formats_converge_and_lose_nothing(spark, tmp_path):
    folder, root, work = (str(tmp_path / n) for n in ("in", "collection", "work"))
    os.makedirs(folder)
    for name in ("a.md", "p.pdf", "q.pdf", "w.doc", "x.docx", "m.msg", "h.htm", "l.log", "blank.md"):
        with open(f"{folder}/{name}", "w") as f:
            f.write(" " if name == "blank.md" else f"t | [I] | {name}.")
    texts = {
        ".pdf": spark.createDataFrame([(f"{folder}/p.pdf", 1, "one.\n\ntwo.")], "source_path string, page_num int, raw_text string"),
        ".doc": spark.createDataFrame([(f"{folder}/w.doc", "A\rB")], "source_path string, raw_text string"),
        ".docx": spark.createDataFrame([(f"{folder}/x.docx", 1, "X", False, 0)], "source_path string, para_idx int, text string, break_before boolean, breaks_inside int"),
        ".msg": spark.createDataFrame(
            [(f"{folder}/m.msg", "S", "F", None, None, None, None, ["a"], "hi", None)],
            "source_path string, subject string, sender string, to string, cc string, bcc string, date string, attachments array<string>, body string, html_body string",
        ),
    }
    stored = lambda: {r.source_name: r.text for r in Collection(spark, root).read().collect()}
    run = sync_folder(spark, folder, root, work, texts, chunker="simple")
    first = stored()
    assert first["p.pdf"] == "one. two. " and first["w.doc"] == "A B " and first["x.docx"] == "X " and first["m.msg"].startswith("Subject: S From: F Attachments: a hi")
    assert set(first) == {"a.md", "p.pdf", "w.doc", "x.docx", "m.msg", "h.htm", "l.log"} - {"h.htm"} and run["version"] == 1  # a page without paragraphs has no chunks
    mail = Collection(spark, root).read().filter("source_name = 'm.msg'").first().attrs
    assert mail["subject"] == "S" and mail["attachments"] == "a"

    again = sync_folder(spark, folder, root, work, texts, chunker="simple")
    assert (again["version"], again["added_chunks"], again["deleted_chunks"]) == (1, 0, 0) and stored() == first

    with open(f"{folder}/p.pdf", "w") as f:
        f.write("changed on disk, not decoded yet")
    waits = sync_folder(spark, folder, root, work, {k: v for k, v in texts.items() if k != ".pdf"}, chunker="simple")
    assert (waits["version"], waits["deleted_chunks"]) == (1, 0) and stored() == first
    texts[".pdf"] = spark.createDataFrame([(f"{folder}/p.pdf", 1, "three.")], "source_path string, page_num int, raw_text string")
    assert sync_folder(spark, folder, root, work, texts, chunker="simple")["version"] == 2
    assert stored() == first | {"p.pdf": "three. "}
    with pytest.raises(ValueError):
        sync_folder(spark, folder, root, work, {".txt": texts[".doc"]})


def test_only_changed_files_are_opened(spark, tmp_path):
    folder, root, work, seen = (str(tmp_path / n) for n in ("in", "collection", "work", "seen"))
    os.makedirs(folder), os.makedirs(seen)
    for name in ("a.md", "b.md", "c.html", "d.log", "e.log"):
        with open(f"{folder}/{name}", "w") as f:
            f.write(f"<p>{name}.")

    def opener(path):
        open(f"{seen}/{os.path.basename(path)}", "a").write("x")
        return open(path, "rb")

    sync_folder(spark, folder, root, work, chunker="simple")
    for name in ("b.md", "e.log"):
        with open(f"{folder}/{name}", "a") as f:
            f.write(" more.")
    sync_folder(spark, folder, root, work, opener=opener, chunker="simple")
    assert {n: open(f"{seen}/{n}").read() for n in os.listdir(seen)} == {"b.md": "x", "e.log": "x"}


def put(folder, **files):
    os.makedirs(folder, exist_ok=True)
    for name, text in files.items():
        with open(f"{folder}/{name.replace('_', '.')}", "w") as f:
            f.write(text)


def test_a_pass_survives_its_files(spark, tmp_path):
    """A vanished, an unreadable, a too large and an unparsable file, and a directory that can't be listed, beside a good one."""
    folder, root, work = (str(tmp_path / n) for n in ("in", "collection", "work"))
    put(folder, good_md="Good.", gone_md="Old.", locked_log="Old.", huge_md="Old.", left_md="Stays.")
    sync_folder(spark, folder, root, work, chunker="simple")
    put(folder, good_md="Better text.", gone_md="New text.", locked_log="New text.", fresh_html="<p>Fresh.")
    with open(f"{folder}/huge.md", "r+b") as f:
        f.truncate(3 << 30)  # a sparse file: 3 GB that take no disk

    def opener(path):
        if path.endswith("gone.md"):
            os.remove(path)  # between listing and reading
        if path.endswith("locked.log"):
            raise PermissionError(path)
        return open(path, "rb")

    run = sync_folder(spark, folder, root, work, opener=opener, chunker="simple")
    store = Collection(spark, root)
    stored = lambda: {r.source_name: r.text for r in store.read().collect()}
    assert stored() == {"good.md": "Better text. ", "fresh.html": "Fresh. ", "gone.md": "Old. ", "locked.log": "Old. ", "huge.md": "Old. ", "left.md": "Stays. "}
    assert (run["added_or_updated_files"], run["added_chunks"], run["version"]) == (2, 2, 2)
    bad = {(os.path.basename(r.source_path), r.stage, r.error.split(":")[0], r.version) for r in store.quarantine().collect()}
    assert bad == {("gone.md", "read", "missing", 2), ("locked.log", "read", "unreadable", 2), ("huge.md", "read", "too large", 2)}
    assert os.listdir(work) == []  # nothing is left of a pass

    again = sync_folder(spark, folder, root, work, opener=opener, chunker="simple")  # the vanished one is now gone, the others still fail
    assert (again["removed_paths"], again["added_chunks"], again["version"]) == (1, 0, 3) and "gone.md" not in stored()
    assert sync_folder(spark, folder, root, work, opener=opener, chunker="simple")["version"] == 3
    os.remove(f"{folder}/huge.md")
    done = sync_folder(spark, folder, root, work, chunker="simple")
    assert done["version"] == 4 and stored() == {"good.md": "Better text. ", "fresh.html": "Fresh. ", "locked.log": "New text. ", "left.md": "Stays. "}


def test_files_below_an_unlisted_directory_are_not_gone(spark, tmp_path, monkeypatch):
    from docsync.sources import files as sources

    folder, root, work = (str(tmp_path / n) for n in ("in", "collection", "work"))
    put(folder, a_md="A.")
    put(f"{folder}/sub", b_md="B.")
    put(f"{folder}/sub/deep", c_md="C.")
    sync_folder(spark, folder, root, work, chunker="simple")
    walk = sources.walk

    def half(session, place, where):  # as if "sub" gave an error
        found, _ = walk(session, place, where)
        return found.filter("source_path not like '%/sub/%'"), session.createDataFrame([(f"{folder}/sub", "PermissionError")], "path string, error string")

    monkeypatch.setattr(sources, "walk", half)
    os.remove(f"{folder}/a.md")
    run = sync_folder(spark, folder, root, work, chunker="simple")
    assert run["removed_paths"] == 1 and {r.source_name for r in Collection(spark, root).read().collect()} == {"b.md", "c.md"}
    assert [(r.source_path, r.stage) for r in Collection(spark, root).quarantine().collect()] == [(f"{folder}/sub", "list")]
    monkeypatch.undo()
    sync_folder(spark, folder, root, work, chunker="simple")
    assert {r.source_name for r in Collection(spark, root).read().collect()} == {"b.md", "c.md"}


def test_errors_of_plug_ins_concern_their_files(spark, tmp_path):
    from docsync.operators import chunks

    folder, root, work = (str(tmp_path / n) for n in ("in", "collection", "work"))
    put(folder, good_md="One good sentence. Another one here. A third.", bad_md="One. The poison is here. Three.", log_log="fine")

    def load():
        def vectors(texts):
            if any("poison" in t for t in texts):
                raise ValueError("poison")
            return [[float(len(t)), 1.0] for t in texts]

        return vectors

    class Coder:
        def encode_ordinary_batch(self, texts):
            if any("poison" in t for t in texts):
                raise ValueError("poison")
            return [list(t.encode()) for t in texts]

        def decode_single_token_bytes(self, i):
            return bytes([i])

    for n, settings in enumerate(({"chunker": "semantic", "embed": chunks.model_embedding(load)}, {"chunker": "simple", "tokens": chunks.coder_tokens(Coder)})):
        sync_folder(spark, folder, f"{root}{n}", work, **settings)
        store = Collection(spark, f"{root}{n}")
        assert {r.source_name for r in store.read().collect()} == {"good.md", "log.log"}
        assert [(os.path.basename(r.source_path), r.stage) for r in store.quarantine().collect()] == [("bad.md", "chunk")]


def one_chunk(spark, path, text="t"):
    files = spark.createDataFrame([(path, path[1:], "1")], "source_path string, source_name string, file_signature string")
    chunk = spark.createDataFrame([(path, 0, text, 1, 1)], "source_path string, chunk_index int, text string, paragraph_num int, page_num int")
    return files, sync.with_metadata(chunk, files)


def test_of_two_writers_one_has_to_start_again(spark, tmp_path):
    first, second = Collection(spark, str(tmp_path / "c")), Collection(spark, str(tmp_path / "c"))
    first.create()
    base = second.manifest()
    for store, path in ((first, "/a"), (second, "/b")):
        files, fresh = one_chunk(spark, path)
        plan = sync.plan(files, store.read(manifest=base))
        if store is first:
            assert store.write(plan, fresh, base) == 1
        else:
            with pytest.raises(Conflict):
                store.write(plan, fresh, base)
            second.manifest = lambda: base  # even if it had not seen the other's manifest, the name is taken
            second._latest = lambda: 0
            with pytest.raises(Conflict):
                store.write(plan, fresh, base)
            plan = sync.plan(files, first.read()).filter("action = 'new'")
            assert first.write(plan, fresh) == 2
    assert sorted(r.source_path for r in first.read().collect()) == ["/a", "/b"]
    assert not [n for n in os.listdir(tmp_path / "c") if n.startswith("_temporary")]


def test_an_overtaken_pass_starts_again(spark, tmp_path, monkeypatch):
    folder, root, work = (str(tmp_path / n) for n in ("in", "collection", "work"))
    put(folder, a_md="A.")
    write, calls = Collection.write, []

    def overtaken(self, plan, fresh, base=None):
        calls.append(base["version"])
        if len(calls) == 1:
            files, other = one_chunk(spark, "/elsewhere")
            write(self, sync.plan(files, self.read()), other, base)
        return write(self, plan, fresh, base)

    monkeypatch.setattr(Collection, "write", overtaken)
    run = sync_folder(spark, folder, root, work, chunker="simple")
    assert calls == [0, 1] and run["version"] == 2 and run["removed_paths"] == 1  # the other writer's file is not in this folder
    assert [r.source_name for r in Collection(spark, root).read().collect()] == ["a.md"]


def test_index_equals_the_chunks_and_a_pass_reads_no_chunks(spark, tmp_path):
    folder, root, work = (str(tmp_path / n) for n in ("in", "collection", "work"))
    put(folder, a_md="A. " * 900, b_md="B.", c_log="C.")
    sync_folder(spark, folder, root, work, chunker="simple")
    put(folder, b_md="Other text.")
    os.remove(f"{folder}/c.log")
    sync_folder(spark, folder, root, work, chunker="simple")
    store = Collection(spark, root)
    rows = lambda df: sorted(map(tuple, df.select("source_path", "old_chunks", "lowest", "highest").collect()))
    assert rows(store.index()) == rows(sync.stored_files(store.read())) and store.index().count() == 2
    for path in (tmp_path / "collection").glob("v*/chunks/bucket=*/*.parquet"):
        path.unlink()  # a pass with nothing to do does not look at them
    run = sync_folder(spark, folder, root, work, chunker="simple")
    assert (run["version"], run["remote_docs"], run["added_or_updated_files"]) == (2, store.index().agg({"old_chunks": "sum"}).first()[0], 0)


def test_rows_out_of_reach_are_counted_and_kept(spark, tmp_path):
    store = Collection(spark, str(tmp_path / "c"), buckets=2)
    store.create()
    foreign = spark.createDataFrame([("1", None, "s", 0, "x", 1, 1, "n", {}), ("2", "", None, 0, "y", 1, 1, "n", {}), ("", "/p", "s", 0, "z", 1, 1, "n", {})], sync.COLLECTION)
    store.write(spark.createDataFrame([], "source_path string, action string, old_chunks long, file_signature string"), foreign)
    assert store.read().count() == 3 and [(r.source_path, r.old_chunks) for r in store.index().collect()] == [(None, 2)]
    assert store.resize(3) == 2 and store.read().count() == 3


def test_buckets_are_fitted(spark, tmp_path, monkeypatch):
    from docsync.sources import collection

    store = Collection(spark, str(tmp_path / "c"), buckets=1)
    store.create()
    for i in range(3):
        files, fresh = one_chunk(spark, f"/{i}", "word " * 500)
        store.write(sync.plan(files, store.read()).filter("action = 'new'"), fresh)
    assert store.n_bytes() > 0
    monkeypatch.setattr(collection, "BUCKETS", 1)
    monkeypatch.setattr(collection, "BUCKET_BYTES", store.n_bytes() // 5)
    assert store.fit() == 4 and store.manifest()["n_buckets"] >= 5 and store.read().count() == 3
    monkeypatch.setattr(collection, "BUCKET_BYTES", 1 << 20)
    assert store.fit() is None


def test_runs_are_recorded_and_a_failed_one_changes_nothing(spark, tmp_path, monkeypatch):
    folder, root, work = (str(tmp_path / n) for n in ("in", "collection", "work"))
    os.makedirs(folder)
    with open(f"{folder}/a.md", "w") as f:
        f.write("One.")
    sync_folder(spark, folder, root, work, chunker="simple")
    with open(f"{folder}/a.md", "w") as f:
        f.write("Another one.")
    monkeypatch.setattr(Collection, "_replace", lambda *a: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        sync_folder(spark, folder, root, work, chunker="simple")
    monkeypatch.undo()
    store = Collection(spark, root)
    assert [(r.added_chunks, r.version, (r.error or "")[:17]) for r in store.runs().orderBy("finished_at").collect()] == [(1, 1, ""), (None, None, "ZeroDivisionError")]
    assert [r.text for r in store.read().collect()] == ["One. "]


def test_resize_and_clean(spark, tmp_path):
    store = Collection(spark, str(tmp_path / "c"), buckets=4)
    store.create()
    files = spark.createDataFrame([(f"/{i}", str(i), "1") for i in range(40)], "source_path string, source_name string, file_signature string")
    chunk = spark.createDataFrame([(f"/{i}", 0, f"t{i}", 1, 1) for i in range(40)], "source_path string, chunk_index int, text string, paragraph_num int, page_num int")
    store.write(sync.plan(files, store.read()), sync.with_metadata(chunk, files))
    rows = sorted(map(str, store.read().collect()))
    assert store.resize(16) == 2 and store.manifest()["n_buckets"] == 16 and sorted(map(str, store.read().collect())) == rows
    assert store.clean() == []  # the version before may still have readers
    store.resize(8)
    assert len(store.clean()) == 1 and sorted(map(str, store.read().collect())) == rows
    assert buckets_for(1 << 50) == 1 << 21


def test_empty_collection(spark, tmp_path):
    store = Collection(spark, str(tmp_path / "c"))
    store.create()
    store.create()
    assert store.read().count() == 0 and store.manifest()["version"] == 0


def test_a_pass_that_dies_leaves_the_old_version(spark, tmp_path):
    root = str(tmp_path / "c")
    store = Collection(spark, root)
    store.create()
    files, fresh = one_chunk(spark, "/a")
    store.write(sync.plan(files, store.read()), fresh)
    os.makedirs(f"{root}/v2-broken/chunks/bucket=1")
    with open(f"{root}/_temporary-x", "w") as f:  # died before its manifest had a name
        f.write("{")
    assert [r.text for r in store.read().collect()] == ["t"] and store.manifest()["version"] == 1
    assert store.clean() == ["v2-broken"]


def test_batches(spark):
    rows = spark.createDataFrame([("/a", i, "t") for i in range(401)] + [("/b", 0, "t")], "source_path string, chunk_index int, text string")
    assert {(r.source_path, r.n_chunks, r.n_batches) for r in sync.ingest_batches(rows).collect()} == {("/a", 401, 3), ("/b", 1, 1)}
    got = {(r.chunk_index, r.batch) for r in sync.batch_numbers(rows).filter("source_path = '/a'").collect()}
    assert {(0, 1), (199, 1), (200, 2), (400, 3)} <= got


def test_an_outside_store_follows_the_collection(spark, tmp_path):
    folder, root, work, shelf = (str(tmp_path / n) for n in ("in", "collection", "work", "shelf"))
    os.makedirs(shelf)
    put(folder, a_md="A. " * 900, b_md="Poison.", c_log="C.", d_md="D.")

    class Shelf:
        """A file for each chunk; the first call of every task fails, one text always does, and so does one deletion."""

        def __init__(self):
            self.fresh = True

        def once(self):
            if self.fresh:
                self.fresh = False
                raise ConnectionError("the first call")

        def put(self, chunks):
            assert len(chunks) <= 200
            self.once()
            for c in chunks:
                if "Poison" in c["text"]:
                    raise ValueError("poison")
                with open(f"{shelf}/{c['chunk_id']}", "w") as f:
                    f.write(f"{os.path.basename(c['source_path'])} {c['chunk_index']}")

        def delete(self, chunk_id):
            self.once()
            if os.path.exists(f"{shelf}/{chunk_id}") and open(f"{shelf}/{chunk_id}").read().startswith("d.md"):
                raise PermissionError("kept")
            os.remove(f"{shelf}/{chunk_id}")

    held = lambda: sorted(open(f"{shelf}/{n}").read() for n in os.listdir(shelf))
    store = Collection(spark, root)
    store.create()
    versions = [store.manifest()]
    sync_folder(spark, folder, root, work, chunker="simple")
    versions.append(store.manifest())
    n_a = store.read().filter("source_path like '%a.md'").count()
    assert n_a > 1
    assert outside.mirror(store, *versions, Shelf, str(tmp_path / "out1")) == {"deletes": 0, "puts": n_a + 2, "failed": 1}
    assert held() == sorted([f"a.md {i}" for i in range(n_a)] + ["c.log 0", "d.md 0"])
    assert outside.mirror(store, *versions, Shelf, str(tmp_path / "again"))["puts"] == n_a + 2 and len(held()) == n_a + 2  # a repeated run adds nothing

    put(folder, a_md="Short.", b_md="Fine now.")
    os.remove(f"{folder}/c.log"), os.remove(f"{folder}/d.md")
    sync_folder(spark, folder, root, work, chunker="simple")
    versions.append(store.manifest())
    run = outside.mirror(store, *versions[1:], Shelf, str(tmp_path / "out2"))
    assert run == {"deletes": n_a + 1, "puts": 2, "failed": 2}  # b's old chunk was never there, d's is kept
    bad = outside.failed(store, str(tmp_path / "out2")).collect()
    assert {r.action for r in bad} == {"delete"} and {r.error.split(":")[0] for r in bad} == {"FileNotFoundError", "PermissionError"}
    assert held() == ["a.md 0", "b.md 0", "d.md 0"]
    assert outside.mirror(store, versions[2], versions[2], Shelf, str(tmp_path / "out3")) == {"deletes": 0, "puts": 0, "failed": 0}


def test_new_files_stream_into_the_collection(spark, tmp_path):
    folder, root, work, state = (str(tmp_path / n) for n in ("in", "collection", "work", "state"))
    store = Collection(spark, root)
    texts = lambda: {r.source_name: r.text for r in store.read().collect()}
    put(folder, **{"1_md": "text 1.", "a_log": "t | [I] | one.", "later_pdf": "no text yet"})
    take_new_files(spark, folder, root, work, state, chunker="simple").awaitTermination(300)
    assert texts() == {"1.md": "text 1. ", "a.log": "t [I] one. "}
    assert {(os.path.basename(r.source_path), r.stage) for r in store.quarantine().collect()} == {("later.pdf", "text")}
    put(folder, **{"2_md": "text 2.", "1_md": "changed text 1."})
    take_new_files(spark, folder, root, work, state, chunker="simple").awaitTermination(300)
    assert texts()["2.md"] == "text 2. " and len(texts()) == 3
    version = store.manifest()["version"]
    take_new_files(spark, folder, root, work, str(tmp_path / "lost state"), chunker="simple").awaitTermination(300)  # all files come again
    assert texts()["1.md"] == "changed text 1. " and store.manifest()["version"] == version + (1 if version == 2 else 0)
    run = sync_folder(spark, folder, root, work, chunker="simple")  # stream and pass agree on signatures
    assert (run["added_or_updated_files"], run["removed_paths"]) == (0, 0)


def test_vectors_are_reused_by_content(spark, tmp_path):
    from docsync.operators import chunks

    seen = str(tmp_path / "seen")

    def load():
        def vectors(texts):
            with open(seen, "a") as f:
                f.writelines(f"{t}\n" for t in texts)
            return [[float(sum(map(ord, t)) % 97), float(len(t)), 1.0] for t in texts]

        return vectors

    def rows(text):
        return spark.createDataFrame([("/a", 1, 1, text), ("/b", 1, 1, "Same one. Same two. Same three.")], "source_path string, paragraph_num int, page_num int, text string")

    text = " ".join(f"Sentence number {i} says something." for i in range(20))
    plain = chunks.model_embedding(load)
    stored = chunks.StoredVectors(plain, str(tmp_path / "vectors"))
    cuts = lambda embed, t: sorted(map(tuple, chunks.semantic_breaks(rows(t), embed=embed).collect()))
    want, want_changed = cuts(plain, text), cuts(plain, text.replace("number 7 ", "number seven "))
    os.remove(seen)
    assert cuts(stored, text) == want and len(open(seen).read().splitlines()) == 23
    os.remove(seen)
    assert cuts(stored, text.replace("number 7 ", "number seven ")) == want_changed and len(open(seen).read().splitlines()) == 3
    os.remove(seen)
    assert cuts(stored, text) == want and not os.path.exists(seen)


def test_reconcile_goes_on_after_errors(spark, tmp_path):
    passes = []

    def once(number):
        passes.append(number)
        raise RuntimeError("a pass that fails")

    query = reconcile_on_timer(spark, once, str(tmp_path / "timer"), "1 second")
    for _ in range(60):
        if len(passes) > 1:
            break
        query.awaitTermination(1)
    query.stop()
    assert len(passes) > 1  # the second pass comes although the first failed


def test_a_pass_writes_the_paragraphs_of_all_formats_in_one_job(spark, tmp_path, monkeypatch):
    from docsync.jobs import sync_folder as job

    calls, add = [], job.Work.add
    monkeypatch.setattr(job.Work, "add", lambda self, df, name: (calls.append(name), add(self, df, name))[1])
    folder, root, work = (str(tmp_path / n) for n in ("in", "collection", "work"))
    put(folder, a_md="text a.", b_log="t | [I] | one.", c_html="<p>text c.</p>")
    sync_folder(spark, folder, root, work, chunker="simple")
    assert {r.source_name: r.text for r in Collection(spark, root).read().collect()} == {"a.md": "text a. ", "b.log": "t [I] one. ", "c.html": "text c. "}
    assert calls == ["paragraphs"]


def test_a_pass_sends_no_rows_of_the_driver_through_python_workers(spark, tmp_path, monkeypatch):
    """Rows of the driver need Python workers of another kind, which every executor would keep beside those that read files."""
    from pyspark.sql import SparkSession

    from docsync.functions.tables import few_rows
    from docsync.jobs.sync_folder import sync_folder
    from docsync.sources.collection import Collection

    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.html").write_text("<p>one</p>")
    (tmp_path / "in" / "b.log").write_text("two")

    def refuse(*_, **__):
        raise AssertionError("rows of the driver go through Python workers")

    monkeypatch.setattr(SparkSession, "createDataFrame", refuse)
    for _ in range(2):
        sync_folder(spark, str(tmp_path / "in"), str(tmp_path / "collection"), str(tmp_path / "work"), chunker="simple")
    store = Collection(spark, str(tmp_path / "collection"))
    assert store.read().count() == 2 and store.quarantine().count() == 0
    assert [r.added_chunks for r in store.runs().orderBy("finished_at").collect()] == [2, 0]
    assert [tuple(r) for r in few_rows(spark, "a string, n long", ("x", None), (None, 2)).collect()] == [("x", None), (None, 2)]


def test_a_stream_adds_layers_and_rewrites_no_bucket(spark, tmp_path, monkeypatch):
    from docsync.sources import collection

    monkeypatch.setattr(collection, "MERGED", 2)
    folder, root, work, state = (str(tmp_path / n) for n in ("in", "collection", "work", "state"))
    os.makedirs(folder)
    store = Collection(spark, root)
    take_new_files(spark, folder, root, work, state, max_files=2, chunker="simple").awaitTermination(300)  # an empty folder
    assert store._versions() == []
    put(folder, **{f"{i}_md": f"text {i}." for i in range(7)}, late_pdf="no text yet")
    take_new_files(spark, folder, root, work, state, max_files=2, chunker="simple").awaitTermination(300)
    now = store.manifest()
    assert now["version"] == 4 and now["buckets"] == {} and [rank for _, rank in now["layers"]] == [2]
    assert sorted(r.text for r in store.read().collect()) == [f"text {i}. " for i in range(7)]
    rows = lambda df: sorted(map(tuple, df.select("source_path", "old_chunks", "lowest", "highest").collect()))
    assert rows(store.index()) == rows(sync.stored_files(store.read()))
    assert [r.stage for r in store.quarantine().collect()] == ["text"]
    put(folder, new_md="a new text.")
    take_new_files(spark, folder, root, work, state, max_files=2, chunker="simple").awaitTermination(300)  # the others don't come again
    then = store.manifest()
    assert [rank for _, rank in then["layers"]] == [2, 0] and store.runs().count() == 5
    gone, added = outside.changes(store, now, then)
    assert gone.count() == 0 and [r.source_name for r in added.collect()] == ["new.md"]
    assert len(store.clean()) == 6 and store.read().count() == 8

    put(folder, **{"1_md": "another text."})
    os.remove(f"{folder}/2.md")
    run = sync_folder(spark, folder, root, work, chunker="simple")  # a pass takes all layers into the buckets
    last = store.manifest()
    assert (run["added_or_updated_files"], run["removed_paths"], last.get("layers", [])) == (1, 1, []) and len(last["buckets"]) > 1
    assert sorted(r.text for r in store.read().collect()) == sorted([f"text {i}. " for i in (0, 3, 4, 5, 6)] + ["a new text. ", "another text. "])
    gone, added = outside.changes(store, then, last)
    assert gone.count() == 2 and [r.text for r in added.collect()] == ["another text. "]
