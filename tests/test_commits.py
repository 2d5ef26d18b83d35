"""Commits, the ledger on top of them, and generations of tables: several writers, and runs that break off."""

import threading

import pytest

from fraclake.operators import ledger as work
from fraclake.shared import claim, small_text
from fraclake.streaming import commits, ingest
from fraclake.streaming.commits import commit, newest, sweep
from fraclake.streaming.ingest import compact_table, compact_unique_set, grow_unique_set, grow_unique_table, read_grown_set, read_grown_table
from fraclake.streaming.ledger import compact_ledger, newest_version, publish, read_ledger_version, record_outcomes
from fraclake.types import OUTCOMES

LISTED = "subdir string, filename string, url string, size bigint, mtime string"


class Lost(Exception):
    pass


def listed(spark, *names):
    return spark.createDataFrame([("AAA", n, f"u{n}", 1, "m") for n in names], LISTED)


def add(*names, now=1.0):
    return lambda before: work.upsert_rows(before, listed(before.sparkSession, *names), now)


def content(spark, root):
    return {r.filename: (r.id, r.status, r.updated_at) for r in read_ledger_version(spark, root).collect()}


def test_one_of_several_claims_succeeds(spark, tmp_path):
    won, start = [], threading.Barrier(6)

    def run(i):
        start.wait()
        if claim(spark, str(tmp_path / "sub" / "claimed"), f"writer {i}"):
            won.append(i)

    threads = [threading.Thread(target=run, args=(i,)) for i in range(6)]
    [t.start() for t in threads]
    [t.join() for t in threads]
    assert len(won) == 1 and small_text(spark, str(tmp_path / "sub" / "claimed")) == f"writer {won[0]}"
    assert [p.name for p in (tmp_path / "sub").iterdir() if not p.name.endswith(".crc")] == ["claimed"]


def test_every_writer_at_once_lands(spark, tmp_path):
    root = str(tmp_path)
    start = threading.Barrier(4)

    def run(i):
        start.wait()
        for j in range(3):
            commit(spark, root, lambda state, n, folder: state | {"folders": [*state.get("folders", []), f"{i}-{j}"]}, f"writer {i}", j)

    threads = [threading.Thread(target=run, args=(i,)) for i in range(4)]
    [t.start() for t in threads]
    [t.join() for t in threads]
    number, state = newest(spark, root)
    assert number == 12 and sorted(state["folders"]) == sorted(f"{i}-{j}" for i in range(4) for j in range(3))
    assert state["applied"] == {f"writer {i}": 2 for i in range(4)}


def test_a_publisher_that_comes_second_keeps_what_the_first_did(spark, tmp_path):
    root, turns = str(tmp_path / "ledger"), []

    def slow(before):
        if not turns:
            turns.append(publish(spark, root, "other@noon/1", add("g1", "g2")))
        return work.upsert_rows(before, listed(spark, "f1"), 2.0)

    assert publish(spark, root, "slow", slow) == 2 and turns == [1]
    assert content(spark, root).keys() == {"g1", "g2", "f1"}
    assert sorted(i for i, *_ in content(spark, root).values()) == [1, 2, 3]
    assert publish(spark, root, "other@noon/1", add("g3")) == publish(spark, root, "slow", add("g3")) == 2  # both are known
    assert len(list((tmp_path / "ledger").glob("changes-*"))) == 2  # what the first try wrote is gone


def test_a_change_writes_its_rows_and_compaction_the_touched_buckets(spark, tmp_path, monkeypatch):
    monkeypatch.setattr("fraclake.streaming.ledger.BUCKET_BITS", 6)
    root = tmp_path / "ledger"
    publish(spark, str(root), "all", add(*[f"f{i:04}" for i in range(1000)]))
    assert compact_ledger(spark, str(root)) == 2 and compact_ledger(spark, str(root)) == 2
    assert not newest(spark, str(root))[1]["changes"]
    old = newest(spark, str(root))[1]["base"]
    assert len(old) == 16
    some = spark.createDataFrame([(i, "DONE", f"/{i}", None, False, 9.0) for i in (70, 71, 72)] + [(71, "ERROR", None, "x", True, 8.0)], OUTCOMES)
    assert record_outcomes(spark, str(root), some, "some") == 3
    written = newest(spark, str(root))[1]["changes"][0]
    assert spark.read.option("recursiveFileLookup", True).parquet(str(root / written)).count() == 3
    record_outcomes(spark, str(root), spark.createDataFrame([(71, "GONE", None, "y", False, 10.0)], OUTCOMES), "more")
    before = sorted(map(tuple, read_ledger_version(spark, str(root)).collect()))
    compact_ledger(spark, str(root))
    assert sorted(map(tuple, read_ledger_version(spark, str(root)).collect())) == before and len(before) == 1000
    assert {r[0]: (r[6], r[7]) for r in before if r[0] in (70, 71, 72, 73)} == {70: ("DONE", 0), 71: ("GONE", 1), 72: ("DONE", 0), 73: ("PENDING", 0)}
    now = newest(spark, str(root))[1]["base"]
    assert {b for b in now if now[b] != old[b]} == {"1"}


def test_changes_made_during_compaction_stay(spark, tmp_path, monkeypatch):
    root, real, done = str(tmp_path / "ledger"), commits.claim, []
    publish(spark, root, "a", add("f1"))
    publish(spark, root, "b", add("f2"))

    def late(spark_, uri, text):
        if not done:
            done.append(1)
            publish(spark, root, "c", add("f3"))
            publish(spark, root, "d", add("f1", now=7.0))
        return real(spark_, uri, text)

    monkeypatch.setattr(commits, "claim", late)
    compact_ledger(spark, root)
    state = newest(spark, root)[1]
    assert len(state["changes"]) == 2 and len(state["base"]) == 1
    assert content(spark, root) == {"f1": (1, "PENDING", 7.0), "f2": (2, "PENDING", 1.0), "f3": (3, "PENDING", 1.0)}
    assert len(list((tmp_path / "ledger").glob("base-*"))) == 1


def test_old_versions_go_and_the_rest_is_readable(spark, tmp_path):
    root = tmp_path / "ledger"
    for i in range(5):
        publish(spark, str(root), "steps", add(f"f{i}"), number=i, keep=2, compact_after=3)
    assert newest_version(spark, str(root)) > 5 and len(content(spark, str(root))) == 5
    assert len(commits.commits(spark, str(root))) == 2
    (root / "changes-left-by-a-killed-writer").mkdir()
    sweep(spark, str(root))
    named = set().union(*(commits.folders_of(commits.state_of(spark, str(root), n)) for n in commits.commits(spark, str(root))))
    assert {p.name for p in root.iterdir() if p.is_dir()} == named | {"_commits"} and len(content(spark, str(root))) == 5
    with pytest.raises(ValueError):
        read_ledger_version(spark, str(root), 1)


def test_upserted_rows_are_what_upsert_changes(spark, tmp_path):
    start = work.upsert(spark.createDataFrame([], work.LEDGER), listed(spark, "a", "b", "c"), 1.0)
    after = {tuple(r) for r in work.upsert(start, listed(spark, "b", "d"), 2.0).collect()}
    rows = {tuple(r) for r in work.upsert_rows(start, listed(spark, "b", "d"), 2.0).collect()}
    assert rows == after - {tuple(r) for r in start.collect()} and {r[2] for r in rows} == {"b", "d"}


def hashes(spark, folder, lo, hi):
    spark.range(lo, hi).selectExpr("31 AS ksize", "id AS hash").write.mode("append").parquet(folder)
    return spark.readStream.schema("ksize int, hash bigint").parquet(folder)


def test_sets_that_are_compacted_while_they_grow(spark, tmp_path, monkeypatch):
    folder, out, real, done = str(tmp_path / "in"), str(tmp_path / "out"), commits.claim, []
    grow_unique_set(hashes(spark, folder, 0, 20), out, str(tmp_path / "cp")).awaitTermination()
    grow_unique_set(hashes(spark, folder, 10, 30), out, str(tmp_path / "cp")).awaitTermination()
    stream = hashes(spark, folder, 25, 40)

    def late(spark_, uri, text):
        if not done:
            done.append(1)
            grow_unique_set(stream, out, str(tmp_path / "cp")).awaitTermination()
        return real(spark_, uri, text)

    monkeypatch.setattr(commits, "claim", late)
    compact_unique_set(spark, out, keep=1)
    assert sorted(r.hash for r in read_grown_set(spark, out).collect()) == list(range(40))
    assert [f.split("-")[0] for f in newest(spark, out)[1]["folders"]] == ["whole", "added"]
    assert len([p for p in (tmp_path / "out").iterdir() if p.is_dir()]) == 3


@pytest.mark.parametrize("step", ["write", "point", "after the write", "after the point", "drop"])
def test_compaction_that_breaks_off_loses_nothing(spark, tmp_path, monkeypatch, step):
    """At each of its steps; then streams and the next compaction go on."""
    table = f"broken_{step.replace(' ', '_')}"
    folder, checkpoint = str(tmp_path / "in"), str(tmp_path / "cp")
    grow_unique_table(hashes(spark, folder, 0, 50), table, checkpoint, 4).awaitTermination()
    append, point, sql = ingest._append_buckets, ingest._point, type(spark).sql

    def broken(real, after):
        def run(*arguments):
            if after:
                real(*arguments)
            raise Lost(step)
        return run

    with monkeypatch.context() as patch:
        if "write" in step:
            patch.setattr(ingest, "_append_buckets", broken(append, "after" in step))
        elif "point" in step:
            patch.setattr(ingest, "_point", broken(point, "after" in step))
        else:
            patch.setattr(type(spark), "sql", lambda self, text, *a, **b: broken(sql, False)() if text.startswith("DROP") else sql(self, text, *a, **b))
        with pytest.raises(Lost):
            compact_table(spark, table, 4)
    assert sorted(r.hash for r in read_grown_table(spark, table).collect()) == list(range(50))
    grow_unique_table(hashes(spark, folder, 40, 60), table, checkpoint, 4).awaitTermination()
    compact_table(spark, table, 4)
    assert sorted(r.hash for r in read_grown_table(spark, table).collect()) == list(range(60))
    assert len(ingest._generations(spark, table)) == 1


def test_a_plain_table_becomes_the_first_generation(spark, tmp_path):
    spark.range(5).selectExpr("31 AS ksize", "id AS hash").repartition(4, "ksize", "hash").write.bucketBy(4, "ksize", "hash").sortBy("ksize", "hash").saveAsTable("plain_before")
    grow_unique_table(hashes(spark, str(tmp_path / "in"), 3, 9), "plain_before", str(tmp_path / "cp"), 4).awaitTermination()
    assert sorted(r.hash for r in read_grown_table(spark, "plain_before").collect()) == list(range(9))
    assert ingest._pointed(spark, "plain_before") == 1
