"""The stream of changes of a folder."""

from __future__ import annotations

import os

import pytest

from docsync.sources.collection import Collection
from docsync.streaming.changes import Snapshots, publish, stream_changes


def put(folder, **files):
    os.makedirs(folder, exist_ok=True)
    for name, text in files.items():
        with open(f"{folder}/{name.replace('_', '.')}", "w") as f:
            f.write(text)


def seen(df):
    return {(os.path.basename(r.source_path), r.change) for r in df.collect()}


def test_differences_of_listings(spark, tmp_path, monkeypatch):
    folder, place = str(tmp_path / "in"), str(tmp_path / "place")
    put(folder, a_md="a", b_md="b", c_txt="no")
    put(f"{folder}/sub", d_log="d")
    snapshots = Snapshots(spark, folder, place)
    assert seen(snapshots.take(0)) == {("a.md", "added"), ("b.md", "added"), ("d.log", "added")}
    assert seen(snapshots.take(3)) == set()  # numbers may have gaps
    put(folder, a_md="longer a", e_html="e")
    os.remove(f"{folder}/b.md")
    want = {("a.md", "changed"), ("e.html", "added"), ("b.md", "removed")}
    assert seen(snapshots.take(4)) == want
    put(folder, f_md="f")
    assert seen(snapshots.take(4)) == want  # repeated after a failure: as it was
    assert seen(snapshots.take(5)) == {("f.md", "added")}

    from docsync.sources import files as sources

    walk = sources.walk

    def half(session, where, to):
        found, _ = walk(session, where, to)
        return found.filter("source_path not like '%/sub/%'"), session.createDataFrame([(f"{folder}/sub", "PermissionError")], "path string, error string")

    monkeypatch.setattr(sources, "walk", half)
    assert seen(snapshots.take(6)) == set()
    monkeypatch.undo()
    os.remove(f"{folder}/sub/d.log")
    assert seen(snapshots.take(7)) == {("d.log", "removed")}
    assert sorted(os.listdir(f"{place}/listings")) == sorted(os.listdir(f"{place}/changes")) == ["000000000006", "000000000007"]


def test_a_batch_that_died_is_made_again(spark, tmp_path):
    folder, place = str(tmp_path / "in"), str(tmp_path / "place")
    put(folder, a_md="a")
    snapshots = Snapshots(spark, folder, place)
    snapshots.take(0)
    put(folder, b_md="b")
    snapshots.take(1)
    for kind in ("changes", "listings"):  # as if the job had ended before these were whole
        os.remove(f"{place}/{kind}/000000000001/_SUCCESS")
    put(folder, c_md="c")
    assert seen(snapshots.take(1)) == {("b.md", "added"), ("c.md", "added")}


def test_a_restarted_stream_loses_and_repeats_nothing(spark, tmp_path):
    folder, place, state, root, work = (str(tmp_path / n) for n in ("in", "place", "state", "collection", "work"))
    put(folder, a_md="A.", b_md="B.")
    Collection(spark, root).create()
    handle, fail = publish(spark, root, work, chunker="simple"), [False]

    def sometimes(changes, number):
        if fail[0] and not changes.isEmpty():
            fail[0] = False
            raise RuntimeError("between listing and publishing")
        handle(changes, number)

    def until(names):
        query = stream_changes(spark, folder, place, state, sometimes, "1 second")
        try:
            for _ in range(120):
                stored = {r.source_name for r in Collection(spark, root).read().collect()}
                if stored == names or query.exception():
                    return stored
                query.awaitTermination(1)
            return stored
        finally:
            query.stop()

    assert until({"a.md", "b.md"}) == {"a.md", "b.md"}
    os.remove(f"{folder}/b.md")
    put(folder, c_log="C.")
    fail[0] = True
    with pytest.raises(Exception):  # noqa: B017  the query ends with the handler's error
        query = stream_changes(spark, folder, place, state, sometimes, "1 second")
        query.awaitTermination(120)
    assert {r.source_name for r in Collection(spark, root).read().collect()} == {"a.md", "b.md"}
    assert until({"a.md", "c.log"}) == {"a.md", "c.log"}
    runs = [r.asDict() for r in Collection(spark, root).runs().orderBy("finished_at").collect()]
    assert [(r["added_or_updated_files"], r["removed_paths"]) for r in runs] == [(2, 0), (1, 1)]


def test_folders_are_written_listed_and_deleted_by_few_tasks(spark, tmp_path):
    from docsync.sources import adapters, files

    assert files.list_tasks(4_000, 12) == 24 and files.list_tasks(3, 12) == 3 and files.list_tasks(10_000_000, 12) == files.LIST_TASKS
    folder = f"file://{tmp_path}/top"
    rows = spark.createDataFrame([(k, n, None if n == 1 else f' k{k} "{n}" ') for k in range(50) for n in range(3)], "key long, n int, line string")
    adapters.write_lines(rows, folder, "key", ["n"], "log")
    (name,) = os.listdir(tmp_path / "top" / "key=7")
    assert name.endswith(".log") and (tmp_path / "top" / "key=7" / name).read_text() == ' k7 "0" \n\n k7 "2" \n'
    adapters.write_lines(rows.filter("key < 2"), folder, "key", ["n"], "log")
    assert [len(os.listdir(tmp_path / "top" / f"key={k}")) for k in range(4)] == [2, 2, 1, 1]
    adapters.delete_folders(rows.filter("key % 2 = 0").select("key"), folder, "key")
    adapters.delete_folders(spark.range(60, 61).withColumnRenamed("id", "key"), folder, "key")  # one that is not there
    assert sorted(os.listdir(tmp_path / "top")) == sorted(f"key={k}" for k in range(1, 50, 2))
