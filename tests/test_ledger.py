"""Ledger transitions, listings and streams against plain Python models."""

import bz2
import gzip
import os
import zlib

import pytest
from pyspark.sql import functions as F

from fraclake.operators import ledger as work
from fraclake.operators.hash_sets import difference
from fraclake.operators.listing import classified_links, listing_candidates, page_links
from fraclake.plans import listings
from fraclake.sources.files import TASKS
from fraclake.sources.listings import read_pages
from fraclake.streaming.ingest import (INGESTED, compact_table, grow_unique_set, grow_unique_table, ingest_archives, ingested,
                                       ingested_hashes, read_grown_set, worklist)
from fraclake.streaming.ledger import feed_ledger, newest_version, publish, read_ledger_version, record_outcomes
from fraclake.types import LEDGER, OUTCOMES

NOW = 10_000.0


def row(i, status="PENDING", tries=0, updated=None, error=None, out=None, name=None):
    return (i, "AAA", name or f"f{i}", f"u{i}", None, None, status, tries, error, out, updated, 1.0)


def ledger(spark, *rows):
    return spark.createDataFrame(list(rows), LEDGER)


def by_id(df):
    return {r.id: r for r in df.collect()}


def test_upsert_keeps_history_and_numbers_new_files(spark):
    before = ledger(spark, row(4, "DONE", 3, 50.0, out="o"), row(9, "ERROR", 2, 60.0, "boom"))
    listed = spark.createDataFrame([("AAA", "f4", "new", 5, "m", 1), ("AAA", "f4", "newer", 6, "m", 2)]
                                   + [("BBB", f"n{i % 40}", f"v{i}", i, None, i) for i in range(400)],
                                   "subdir string, filename string, url string, size bigint, mtime string, seq int")
    after = by_id(work.upsert(before, listed, NOW, order="seq"))
    assert len(after) == 42 and sorted(after) == [4] + list(range(9, 50))
    assert (after[4].url, after[4].size, after[4].status, after[4].tries, after[4].updated_at, after[4].created_at) == (
        "newer", 6, "DONE", 3, NOW, 1.0)
    assert (after[9].url, after[9].updated_at, after[9].last_error) == ("u9", 60.0, "boom")
    new = {r.filename: r for i, r in after.items() if i > 9}
    assert all(new[f"n{j}"].url == f"v{360 + j}" and new[f"n{j}"].status == "PENDING" for j in range(40))
    quiet = by_id(work.upsert(before, listed, NOW, order="seq", touch=False))
    assert quiet[4].updated_at == 50.0


def test_upsert_into_an_empty_ledger(spark):
    listed = spark.createDataFrame([("A", "x", "u", None, None)] * 3, "subdir string, filename string, url string, size bigint, mtime string")
    rows = work.upsert(ledger(spark), listed, NOW).collect()
    assert [(r.id, r.tries, r.created_at) for r in rows] == [(1, 0, NOW)]


def test_requeue(spark):
    files = ledger(spark, row(1, "DOWNLOADING", updated=NOW - 3601), row(2, "SKETCHING"), row(3, "SKETCHING", updated=NOW - 3600),
                   row(4, "ERROR", updated=0.0))
    after = by_id(work.requeue_stale(files, NOW))
    assert [after[i].status for i in (1, 2, 3, 4)] == ["PENDING", "PENDING", "SKETCHING", "ERROR"]
    assert after[1].updated_at == after[2].updated_at == NOW and after[3].updated_at == NOW - 3600


@pytest.mark.parametrize("keep", [False, True])
def test_outcomes(spark, keep):
    files = ledger(spark, row(1, "SKETCHING", 2, error="old", out="was"), row(2, "SKETCHING"))
    results = [(1, "ERROR", None, "bad", True, 5.0), (1, "ERROR", None, "worse", True, 6.0), (1, "DONE", "p", None, False, 7.0)]
    after = by_id(work.apply_outcomes(files, spark.createDataFrame(results, OUTCOMES), keep))
    assert (after[1].status, after[1].out_path, after[1].tries, after[1].updated_at) == ("DONE", "p", 4, 7.0)
    assert after[1].last_error == ("old" if keep else None)
    assert (after[2].status, after[2].tries, after[2].updated_at) == ("SKETCHING", 0, None)
    tally = work.outcome_tally(spark.createDataFrame(results + [(3, "GONE", None, "x", True, 1.0)], OUTCOMES)).first()
    assert tuple(tally) == (1, 1, 2)


def test_claims_and_candidates(spark):
    files = ledger(spark, row(1, "ERROR", 1, NOW - 1800), row(2, "ERROR", 1), row(3, "ERROR", 20, 0.0), row(4, "ERROR", 0, NOW - 1799),
                   row(5), row(6, "DONE"), row(7, "GONE"), row(8, "ERROR", 2, NOW - 9000), row(9, "SKETCHING"), row(10))
    assert [r.id for r in work.claim_plan(files, NOW, 10).collect()] == [5, 10, 2, 8, 1]
    assert [r.id for r in work.claim_plan(files, NOW, 3).collect()] == [5, 10, 2]
    assert [r.id for r in work.candidates(files, NOW).collect()] == [1, 2, 5, 8, 10]
    assert [r.id for r in work.candidates(files, NOW, limit=2).collect()] == [1, 2]
    assert [r.id for r in work.next_batch(files, 3).collect()] == [1, 2, 3]
    assert [r.id for r in work.unfinished(files).collect()] == [1, 2, 3, 4, 5, 8, 9, 10]
    claimed = by_id(work.mark_claimed(files, work.claim_plan(files, NOW, 2), NOW))
    assert [i for i, r in sorted(claimed.items()) if r.status == "DOWNLOADING" and r.updated_at == NOW] == [5, 10]
    assert {r.status: r.files for r in work.status_counts(files).collect()} == {
        "ERROR": 5, "PENDING": 2, "DONE": 1, "GONE": 1, "SKETCHING": 1, None: 10}
    assert tuple(work.unfinished_counts(files).first()) == (8, 1)
    left = by_id(work.with_eligibility(files))
    assert (left[3].attempts_left, left[1].next_retry_at, left[5].next_retry_at, left[8].retry_delay) == (0, NOW, None, 4)


def test_hot_key_does_not_lose_rows(spark):
    """One file listed very often, and one ledger row with very many results."""
    listed = spark.range(20_000).selectExpr("'A' AS subdir", "IF(id % 3 = 0, 'hot', concat('f', id % 50)) AS filename",
                                            "concat('u', id) AS url", "id AS size", "CAST(NULL AS STRING) AS mtime", "id AS seq")
    rows = {r.filename: r.size for r in work.upsert(ledger(spark), listed, NOW, order="seq").collect()}
    assert rows["hot"] == 19_998 and len(rows) == 51
    results = spark.range(9_000).selectExpr("1L AS id", "'ERROR' AS status", "CAST(NULL AS STRING) AS out_path", "'e' AS error",
                                            "true AS inc_tries", "CAST(id AS DOUBLE) AS ts")
    assert by_id(work.apply_outcomes(ledger(spark, row(1)), results))[1].tries == 9_000


PAGES = {
    "": '<a href="../">up</a> <A HREF="AAS/">x</A> <a href="Z/">z</a> <a href="LONG/">l</a><a href="ab1/">no</a>',
    "AAS/": '<a href="wgs.AASD.1.fsa_nt.gz">f</a><a href="wgs.AASD.1.gbff.gz">g</a><a href="wgs.AASD.1.fsa_nt.gz">again</a><a href="r.txt">',
    "Z/": '<a href="./"></a><a href="wgs.Z1.fsa_nt.gz">',
    "CAD/": '<a href="wgs.CAD1.fsa_nt.gz">not linked from the root</a>',
}


def test_listing(spark):
    pages = spark.createDataFrame([(f"http://h/w/{p}", h) for p, h in PAGES.items()], "url string, html string")
    assert page_links(pages).count() == 12
    kinds = {(r.href, r.kind) for r in classified_links(pages).collect()}
    assert ("AAS/", "dir") in kinds and ("Z/", "dir") in kinds and ("wgs.AASD.1.gbff.gz", "file") in kinds
    assert not any(h in ("LONG/", "ab1/", "../", "./", "r.txt") for h, _ in kinds)
    rows = {(r.subdir, r.filename, r.url) for r in listing_candidates(pages, "http://h/w/").collect()}
    assert rows == {("AAS", "wgs.AASD.1.fsa_nt.gz", "http://h/w/AAS/wgs.AASD.1.fsa_nt.gz"),
                    ("Z", "wgs.Z1.fsa_nt.gz", "http://h/w/Z/wgs.Z1.fsa_nt.gz")}
    loose = listing_candidates(pages, "http://h/w", follow_root=False)
    assert {r.subdir for r in loose.collect()} == {"AAS", "Z", "CAD"}


def test_saved_pages(spark, tmp_path):
    for name, html in PAGES.items():
        folder = tmp_path / name
        folder.mkdir(exist_ok=True)
        (folder / "index.html").write_text(html)
    urls = {r.url for r in read_pages(spark, str(tmp_path), "http://h/w/").collect()}
    assert urls == {f"http://h/w/{p}index.html" for p in PAGES}


def test_saved_pages_of_many_forms(spark, tmp_path):
    """Whole pages, whatever their form or name; none that is hidden or empty; any way to write the folder."""
    forms = {"lines.html": b"a\r\nb\n", "a b/p.html": b"p", "a%20b.html": b"q", "g.html.gz": gzip.compress(b"g1") + gzip.compress(b"g2"),
             "b.BZ2": bz2.compress(b"b"), "d/z.Deflate": zlib.compress(b"z"), "gz": b"plain", "\u00fc\u2028#.html": b"u", "_k=1/k.html": b"k",
             "bad.html": b"\xff", "empty.html": b"", "_hidden/h.html": b"h", ".dot.html": b"h", "_h.html": b"h"}
    for name, content in forms.items():
        (tmp_path / name).parent.mkdir(exist_ok=True)
        (tmp_path / name).write_bytes(content)
    expected = {("lines.html", b"a\r\nb\n"), ("a%20b/p.html", b"p"), ("a%2520b.html", b"q"), ("g.html.gz", b"g1g2"), ("b.BZ2", b"b"),
                ("d/z.Deflate", b"z"), ("gz", b"plain"), ("\u00fc%E2%80%A8%23.html", b"u"), ("_k=1/k.html", b"k"), ("bad.html", b"\xff")}
    for folder in (str(tmp_path), f"{tmp_path}/", f"file:{tmp_path}", f"file://{tmp_path}"):
        rows = read_pages(spark, folder, "P/").selectExpr("url", "CAST(html AS BINARY) AS html").collect()
        assert sorted((r.url, bytes(r.html)) for r in rows) == sorted((f"P/{u}", h) for u, h in expected)
    with pytest.raises(FileNotFoundError):
        read_pages(spark, f"{tmp_path}/none", "P/")


def test_many_saved_pages_are_few_tasks(spark, tmp_path):
    for i in range(1_500):
        (tmp_path / f"{i}.html").write_text(f"page {i}")
    pages = read_pages(spark, str(tmp_path), "")
    assert pages.rdd.getNumPartitions() <= TASKS * spark.sparkContext.defaultParallelism
    assert {(r.url, r.html) for r in pages.collect()} == {(f"{i}.html", f"page {i}") for i in range(1_500)}


def test_saved_pages_query_reads_each_page_once(spark, tmp_path, monkeypatch):
    """The same rows as from the table, also where the shared folder is given with its store."""
    spark.range(40).selectExpr("id AS page_id", "concat('u', id) AS url", "'<a href=\"x.gz\">x</a>\n<a href=\"y\n' AS html").write.parquet(f"{tmp_path}/t/pages.parquet")
    monkeypatch.setattr(listings, "shared_folder", lambda session, label: f"file://{tmp_path}/{label}")
    read = listings.saved_pages(spark, f"{tmp_path}/t")
    plan = read._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" not in plan and "Scan text" not in plan
    rows = sorted(map(str, read.collect()))
    assert len(rows) > 20 and rows == sorted(map(str, listings.candidates(spark, f"{tmp_path}/t").collect()))


def test_stream_ledger_replays_safely(spark, tmp_path):
    root = str(tmp_path / "out")

    def arrive(checkpoint, content, name="listing"):
        if content:
            spark.createDataFrame(content, "url string, html string").coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        pages = spark.readStream.schema("url string, html string").parquet(str(tmp_path / "in"))
        feed_ledger(pages, "http://h/w", root, str(tmp_path / checkpoint), lambda n: 100.0 + n, name).awaitTermination()

    now = lambda: sorted(map(tuple, read_ledger_version(spark, root).collect()))
    arrive("cp", [(f"http://h/w/{p}", PAGES[p]) for p in ("", "AAS/")])
    done = spark.createDataFrame([(1, "DONE", "/x", None, False, 100.5)], OUTCOMES)
    assert record_outcomes(spark, root, done, "w1") == 2 and record_outcomes(spark, root, done, "w1") == 2
    arrive("cp", [("http://h/w/Z/", PAGES["Z/"])])
    once = now()
    assert [r[:3] for r in once] == [(1, "AAS", "wgs.AASD.1.fsa_nt.gz"), (2, "Z", "wgs.Z1.fsa_nt.gz")]
    assert [r[6] for r in once] == ["DONE", "PENDING"] and [r[-1] for r in once] == [100.0, 101.0]
    assert newest_version(spark, root) == 3
    arrive("a new checkpoint, same name", [])  # its batch 0 is known
    assert now() == once
    arrive("a new checkpoint, another name", [], "again")  # all pages once more: nothing is lost
    assert [(r[0], r[6], r[9], r[-1]) for r in now()] == [(r[0], r[6], r[9], r[-1]) for r in once]


def test_unfinished_version_is_written_anew(spark, tmp_path):
    root = str(tmp_path / "out")
    listed = spark.createDataFrame([("AAA", "f", "u", 1, "m")], "subdir string, filename string, url string, size bigint, mtime string")

    def fails(before):
        raise RuntimeError("lost")

    with pytest.raises(RuntimeError):
        publish(spark, root, "a", fails)
    assert newest_version(spark, root) == 0
    assert publish(spark, root, "b", lambda before: work.upsert(before, listed, 1.0)) == 1
    assert publish(spark, root, "a", lambda before: work.upsert(before, listed, 2.0), keep=1) == 2
    assert [r.updated_at for r in read_ledger_version(spark, root).collect()] == [2.0]
    assert len(list((tmp_path / "out" / "_commits").glob("0*"))) == 1


def test_ties_between_outcomes_go_to_success(spark):
    ledger = spark.createDataFrame([(1, "s", "f", "u", None, None, "SKETCHING", 0, None, None, 1.0, 1.0)], LEDGER)
    outcomes = spark.createDataFrame([(1, "DONE", "/x", None, False, 5.0), (1, "ERROR", None, "late", True, 5.0)], OUTCOMES)
    row = work.apply_outcomes(ledger, outcomes).first()
    assert (row.status, row.out_path, row.tries) == ("DONE", "/x", 1)


def test_stream_unique_set_is_idempotent(spark, tmp_path):
    def run(checkpoint):
        stream = spark.readStream.schema("ksize int, hash bigint").parquet(str(tmp_path / "in"))
        grow_unique_set(stream, str(tmp_path / "out"), str(tmp_path / checkpoint)).awaitTermination()
        return sorted(map(tuple, read_grown_set(spark, str(tmp_path / "out")).collect()))

    bag = lambda lo, hi: spark.range(lo, hi).selectExpr("31 AS ksize", "id % 100 AS hash")
    bag(0, 250).write.mode("append").parquet(str(tmp_path / "in"))
    assert run("cp") == [(31, h) for h in range(100)]
    spark.range(90, 130).selectExpr("31 AS ksize", "id AS hash").write.mode("append").parquet(str(tmp_path / "in"))
    assert run("cp") == [(31, h) for h in range(130)]
    assert run("a new checkpoint replays everything") == [(31, h) for h in range(130)]


def test_stream_unique_table_does_not_shuffle_the_stored_side(spark, tmp_path):
    spark.range(500).selectExpr("31 AS ksize", "id AS hash").write.parquet(str(tmp_path / "in"))
    for name in ("one", "two"):
        stream = spark.readStream.schema("ksize int, hash bigint").parquet(str(tmp_path / "in"))
        grow_unique_table(stream, "grown_hashes", str(tmp_path / name), 4).awaitTermination()
    assert spark.table("grown_hashes").count() == 500
    new = spark.range(10).selectExpr("CAST(id % 33 AS INT) AS ksize", "id AS hash").distinct()
    lost = difference(new, spark.table("grown_hashes").hint("merge"))
    plan = lost._jdf.queryExecution().executedPlan().toString()
    assert "Bucketed: true" in plan and plan.count("Exchange") == 1  # only the new hashes move


def test_stream_archives_reads_each_once(spark, tmp_path):
    from test_archives import FILES
    root, out, log = (str(tmp_path / x) for x in ("in", "out", "log"))
    for names in (["AAA/good.sig.zip"], ["AAB/half.sig.zip", "AAC/broken.sig.zip"], []):
        for name in names:
            path = tmp_path / "in" / name
            path.parent.mkdir(parents=True, exist_ok=True)
            path.write_bytes(FILES[name])
            os.utime(path, (1e9, 1e9))  # older than anything seen
        run = ingest_archives(spark, root, out, log, (15, 31, 33))
    assert run == 3 and ingested_hashes(spark, out, log).count() == 11
    seen = ingested(spark, log).collect()
    assert {r.path.rsplit("/", 1)[1] for r in seen} == {"good.sig.zip", "half.sig.zip", "broken.sig.zip"}
    assert all(r.error for r in seen if r.status.startswith("bad")) and {r.status for r in seen} >= {"ok", "bad_archive"}
    # a run that broke off before its commit leaves hashes that do not count, and is done again
    (tmp_path / "log" / "run=2" / "_SUCCESS").unlink()
    (tmp_path / "log" / "run=3" / "_SUCCESS").unlink()
    assert ingest_archives(spark, root, out, log, (15, 31, 33)) == 2
    assert ingested_hashes(spark, out, log).count() == 11


def test_null_hashes_are_kept_once(spark, tmp_path):
    spark.createDataFrame([(31, None), (31, None), (31, 1)], "ksize int, hash bigint").write.parquet(str(tmp_path / "in"))
    for name in ("one", "two"):
        stream = spark.readStream.schema("ksize int, hash bigint").parquet(str(tmp_path / "in"))
        grow_unique_set(stream, str(tmp_path / "out"), str(tmp_path / f"a{name}")).awaitTermination()
        grow_unique_table(stream, "grown_with_null", str(tmp_path / f"b{name}"), 4).awaitTermination()
    compact_table(spark, "grown_with_null", 4)
    for rows in (read_grown_set(spark, str(tmp_path / "out")), spark.table("grown_with_null")):
        assert sorted((r.hash or 0) for r in rows.collect()) == [0, 1]


def test_clean_up_leaves_nothing(spark):
    from fraclake import shared

    shared.clean_up(spark)
    database = shared.fresh_database(spark)
    spark.range(5).write.saveAsTable(f"{database}.t")
    shared.stored(spark.range(5), "five")
    folders = list(shared._folders)
    assert all(shared.exists(spark, f) for f in folders) and len(folders) == 2
    shared.clean_up(spark)
    assert not any(shared.exists(spark, f) for f in folders) and not spark.catalog.databaseExists(database)


def test_archives_that_are_due(spark):
    listed = spark.createDataFrame([(p, 10, 5.0) for p in "abcdefgh"], "path string, length bigint, mtime double")
    seen = [("b", 10, 5.0, 1, 100.0, "m", "ok", None, 1), ("c", 10, 5.0, 1, 100.0, None, "bad_archive", "x", 1),
            ("d", 9, 5.0, 1, 100.0, None, "bad_archive", "x", 1), ("e", 10, 4.0, 3, 100.0, "m", "bad_read", "x", 1), ("e", 10, 4.0, 3, 100.0, "n", "ok", None, 1),
            ("f", 10, 5.0, 1, 90.0, None, "bad_open", "x", 1), ("f", 10, 5.0, 2, 100.0, None, "bad_open", "x", 2),
            ("g", 10, 5.0, 20, 0.0, None, "bad_open", "x", 1),
            ("h", 9, 4.0, 1, 100.0, None, "bad_archive", "x", 1), ("h", 10, 5.0, 1, 101.0, "m", "ok", None, 2)]
    log = spark.createDataFrame(seen, INGESTED)
    due = lambda now: {r.path: r.attempt for r in worklist(listed, log, now).collect()}
    # new; cut short or replaced when it was tried; not opened, after the delay for two attempts
    assert due(103.9) == {"a": 1, "d": 1, "e": 1} and due(104.0) == {"a": 1, "d": 1, "e": 1, "f": 3}
    old = log.withColumns({c: F.lit(None).cast(t) for c, t in (("mtime", "double"), ("attempt", "int"), ("tried_at", "double"))})
    assert {r.path: r.attempt for r in worklist(listed, old, 500.0).collect()} == {"a": 1, "d": 1, "f": 2, "g": 2}  # a log without attempts


def test_an_archive_that_was_cut_short_is_taken_up_when_whole(spark, tmp_path):
    from test_archives import FILES
    root, out, log = (str(tmp_path / x) for x in ("in", "out", "log"))
    path = tmp_path / "in" / "AAA" / "good.sig.zip"
    path.parent.mkdir(parents=True)
    for content, total in ((FILES["AAA/good.sig.zip"][:300], 0), (b"", 0), (FILES["AAA/good.sig.zip"], 10), (FILES["AAA/good.sig.zip"], 10)):
        path.write_bytes(content)
        run = ingest_archives(spark, root, out, log, (15, 31, 33))
        assert ingested_hashes(spark, out, log).count() == total
    last = ingested(spark, log).where(f"run = {run - 1}").collect()
    assert {r.status for r in last} == {"ok", "no_match"} and not ingested(spark, log).where(f"run = {run}").count()
