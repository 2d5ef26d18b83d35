"""Vectors and archives as formats of spark.read and spark.readStream."""

import os
import time

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql.datasource import EqualTo, In
from test_archives import EDGES, FILES

from fraclake.functions.unsigned import signed
from fraclake.sources import formats
from fraclake.sources.archives import flat_hashes
from fraclake.sources.formats import NAME, VECTORS, ArchiveStream, VectorReader, register
from fraclake.sources.vectors import find_vectors, read_vectors


@pytest.fixture
def vectors(tmp_path):
    base = tmp_path / "set"
    for folder, count in (("ksize=15/part=0a", 3000), ("ksize=31/part=0a", 70_000), ("ksize=31/part=ff", 0), ("ksize=31/part=1b/ksize=15", 10), ("loose", 20)):
        (base / folder).mkdir(parents=True)
        values = np.array([*EDGES, *range(count)] if count else [], "<u8")
        (base / folder / "w1.bin").write_bytes(values.tobytes() + b"abc")
        np.save(base / folder / "w1.npy", values[:50].astype("<u4"))
    return str(base)


def rows(df):
    return sorted(map(tuple, df.select(F.coalesce("ksize", F.lit(-1)), "part", "hash").collect()))


@pytest.mark.parametrize("suffix, values", [(".bin", 1000), (".npy", 1 << 22)])
def test_vectors_as_a_format(spark, vectors, suffix, values):
    register(spark)
    read = spark.read.format(VECTORS).option("suffix", suffix).option("values", values).load(vectors)
    whole = read_vectors(find_vectors(spark, vectors, suffix), values).cache()
    assert rows(read) == rows(whole) and read.count() > 100
    for wanted in ("ksize = 31", "ksize IN (15, 33)", "part = '0a'", "part = ''", "ksize = 31 AND part IN ('1b', 'ff')", "ksize IS NULL", "hash = 7"):
        assert rows(read.where(wanted)) == rows(whole.where(wanted)), wanted
    whole.unpersist()


def test_folders_of_other_k_are_not_opened(vectors, monkeypatch):
    reader = VectorReader(vectors, ".bin", 1000)
    kept = EqualTo(("hash",), 1)
    assert list(reader.pushFilters([EqualTo(("ksize",), 31), In(("part",), ("0a", "1b")), kept])) == [kept]
    opened, children = [], formats._children
    monkeypatch.setattr(formats, "_children", lambda top, came=False: opened.append(top) or children(top, came))
    assert {p.folder.removeprefix(vectors) for p in reader.partitions()} == {"", "/ksize=31", "/loose", "/ksize=31/part=0a", "/ksize=31/part=1b", "/ksize=31/part=1b/ksize=15"}
    assert not [o for o in opened if "ksize=15/part" in o or "ff" in o]
    parts = [p for p in reader.partitions() if p.folder.endswith("ksize=31/part=0a")]
    read = [sum(b.num_rows for b in reader.read(p)) for p in parts]
    assert sum(read) == 70_004 and sum(n > 0 for n in read) == len(parts) > 1  # one file is shared


def test_wide_trees_are_left_to_tasks(vectors, monkeypatch):
    whole = VectorReader(vectors, ".bin", 1000)
    count = lambda reader: sorted(v for p in reader.partitions() for b in reader.read(p) for v in b["hash"].to_pylist())
    expected = count(whole)
    monkeypatch.setattr(formats, "FOLDERS", 8)  # the planner stops at two folders
    assert any(p.deep for p in whole.partitions()) and count(whole) == expected
    assert signed((1 << 64) - 1) in expected


def test_odd_folders_of_vectors(spark, vectors, tmp_path):
    register(spark)
    assert spark.read.format(VECTORS).load(str(tmp_path / "none")).count() == 0
    assert spark.read.format(VECTORS).load(f"{vectors}/ksize=15/part=0a/w1.bin").count() == 3004
    for options in ({}, {"path": vectors, "values": "0"}):
        with pytest.raises(Exception, match="folder|range"):
            spark.read.format(VECTORS).options(**options).load().count()


def test_archives_as_a_stream(spark, tmp_path):
    register(spark)

    def put(name, as_name=None):
        path = tmp_path / "in" / (as_name or name)
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_bytes(FILES[name])
        os.utime(path, (1e9, 1e9))  # a copy that keeps times long past

    def run(settle=0, ksizes="15,31,33"):
        arriving = spark.readStream.format(NAME).option("settle", settle).option("ksizes", ksizes).load(str(tmp_path / "in"))
        (arriving.select("path", "status", "error", "member", "ksize", "hashes", "scaled", "max_hash", "filename", "member_head").writeStream
         .option("checkpointLocation", str(tmp_path / "checkpoint")).format("parquet").trigger(availableNow=True).start(str(tmp_path / "out")).awaitTermination())
        time.sleep(0.05)  # clocks of files lag behind
        return spark.read.parquet(str(tmp_path / "out"))

    put("AAA/good.sig.zip")
    time.sleep(0.05)
    assert flat_hashes(run()).count() == 10
    put("AAC/broken.sig.zip", "AAB/half.sig.zip")
    time.sleep(0.05)
    seen = run()
    assert flat_hashes(seen).count() == 10 and [r.status for r in seen.where("path LIKE '%half%'").collect()] == ["bad_archive"]
    put("AAB/half.sig.zip")  # replaced: it comes again; the others do not
    time.sleep(0.05)
    seen = run()
    statuses = sorted(r.status for r in seen.where("path LIKE '%half%' AND status <> 'no_match'").collect())
    assert statuses == ["bad_archive", "bad_content", "bad_content", "bad_read", "ok"]
    assert flat_hashes(run()).count() == 11 and run().count() == seen.count()
    put("AAB/deep/none.sig.zip")
    assert run(settle=3600).count() == seen.count()  # it has not settled
    time.sleep(0.05)
    assert run().count() == seen.count() + 1


def test_offsets_of_archives_do_not_go_back(tmp_path, monkeypatch):
    stream = ArchiveStream(str(tmp_path), False, None, 0.0)
    first = stream.latestOffset()
    monkeypatch.setattr(formats.time, "time", lambda: 1.0)
    assert stream.latestOffset() == first
    again = ArchiveStream(str(tmp_path), False, None, 0.0)
    again.partitions({"until": 0.0}, first)  # what a restart takes from the checkpoint
    assert again.latestOffset() == first and again.initialOffset() == {"until": 0.0}
