"""Archives, loose JSON and raw vectors, good and damaged."""

import gzip
import io
import json
import zipfile

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql.datasource import EqualTo

from fraclake.functions.unsigned import signed
from fraclake.operators.counting import extraction_counts, row_count, run_statistics, sized_counts
from fraclake.operators.hash_sets import unique_hashes
from fraclake.sinks.archives import write_files, write_vectors
from fraclake.sources.archives import decode_archives, find_archives, flat_hashes, list_archives, sketch_rows
from fraclake.sources.files import dealt_by_bytes, list_files
from fraclake.sources.formats import NAME, ArchiveReader, register
from fraclake.sources.signatures import decode_signatures
from fraclake.sources.vectors import find_vectors, read_vectors

EDGES = [0, (1 << 63) - 1, 1 << 63, (1 << 64) - 1]


def archive(members):
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        for name, body in members.items():
            z.writestr(name, body)
    return out.getvalue()


def sig(document):
    return gzip.compress(json.dumps(document).encode())


def record(*signatures, name="genome.fa"):
    return [{"class": "x", "filename": name, "signatures": list(signatures)}]


FILES = {
    "AAA/good.sig.zip": archive({
        "MANIFEST.csv": "not,used",
        "signatures/1.sig.gz": sig(record({"ksize": 31, "scaled": 1000, "mins": EDGES + [0]},
                                          {"ksize": 31, "scaled": 1000, "mins": [7]}, {"ksize": 21, "mins": [5]})),
        "x/signatures/2.sig.gz": sig({"filename": "", "signatures": [{"ksize": 15, "max_hash": 18446744073709552, "mins": [9]}]}),
        "signatures/3.sig.gz": sig({"ksize": 33, "mins": [], "hashes": {"11": 2, "12": 1}}),
        "signatures/4.sig.gz": sig([{"ksize": 33, "max_hash": 1 << 64, "hashes": [13]}]),
        "signatures/5.sig.gz": sig(record({"ksize": 21, "mins": [1]})),
        "elsewhere/6.sig.gz": sig(record({"ksize": 31, "mins": [99]})),
    }),
    "AAB/half.sig.zip": archive({
        "signatures/1.sig.gz": b"this is not gzip",
        "signatures/2.sig.gz": gzip.compress(b"{not json"),
        "signatures/3.sig.gz": sig(record({"ksize": 31, "mins": [1]}, {"ksize": 31, "mins": [1 << 64]})),
        "signatures/4.sig.gz": sig(record({"ksize": 31, "mins": [2]})),
    }),
    "AAB/deep/none.sig.zip": archive({"readme": "x"}),
    "AAC/broken.sig.zip": b"PK no zip at all",
    "AAC/other.txt": b"ignored",
}


@pytest.fixture(scope="module")
def root(spark, tmp_path_factory):
    base = str(tmp_path_factory.mktemp("archives"))
    write_files(spark.createDataFrame([(f"{base}/{p}", c) for p, c in FILES.items()], "path string, content binary"))
    return base


def test_discovery(spark, root):
    names = lambda df: sorted(r.path.rsplit("/", 1)[1] for r in df.select("path").collect())
    assert names(find_archives(spark, root)) == ["broken.sig.zip", "good.sig.zip", "half.sig.zip", "none.sig.zip"]
    assert names(find_archives(spark, root, recursive=False)) == ["broken.sig.zip", "good.sig.zip", "half.sig.zip"]


def test_decode_isolates_every_failure(spark, root):
    rows = decode_archives(find_archives(spark, root), (15, 31, 33)).cache()
    status = {(r.path.rsplit("/", 1)[1][:4], (r.member or "-").rsplit("/", 1)[-1][:1]): r.status
              for r in rows.where("member_head or member is null").collect()}
    assert status == {("good", "1"): "ok", ("good", "2"): "ok", ("good", "3"): "ok", ("good", "4"): "ok",
                      ("good", "5"): "no_match", ("half", "1"): "bad_read", ("half", "2"): "bad_content",
                      ("half", "3"): "bad_content", ("half", "4"): "ok", ("none", "-"): "empty", ("brok", "-"): "bad_archive"}
    counts = extraction_counts(rows).first().asDict()
    assert counts == {"archives": 4, "members_read": 8, "members_ok": 5, "members_bad": 3}
    stats = run_statistics(rows).first().asDict()
    assert stats == {"total_files": 4, "processed_files": 3, "failed_files": 1, "total_hashes": 11}
    unique = {(r.ksize, r.hash) for r in unique_hashes(flat_hashes(rows)).collect()}
    assert unique == {(31, signed(v)) for v in EDGES} | {(31, 7), (31, 2), (15, 9), (33, 11), (33, 12), (33, 13)}
    sketches = {(r.ksize, r.num_hashes, r.scaled, r.sketch_name.rsplit("/", 1)[-1]) for r in sketch_rows(rows).collect()}
    assert sketches == {(31, 5, 1000, "genome.fa"), (31, 1, 1000, "genome.fa"), (15, 1, 1000, "good.sig.zip"),
                        (33, 2, 0, "good.sig.zip"), (33, 1, 1, "good.sig.zip"), (31, 1, 0, "genome.fa")}
    rows.unpersist()


def test_archives_as_a_format(spark, root):
    register(spark)
    read = lambda **o: spark.read.format(NAME).options(**o).load(root)
    plain = lambda df: sorted(repr(tuple(r)) for r in df.withColumn("error", F.lit(0)).withColumn("path", F.regexp_replace("path", "^file:", "")).collect())
    whole = decode_archives(find_archives(spark, root))
    assert plain(read()) == plain(whole)
    assert plain(read(root_only="true")) == plain(decode_archives(find_archives(spark, root), root_only=True))
    for wanted in ("ksize = 31", "ksize IN (15, 33)", "ksize = 31 AND ksize IN (15, 33)", "ksize = 31 AND status = 'ok'"):
        flat = lambda df: sorted(map(tuple, flat_hashes(df.where(wanted)).select("hash", "ksize", "scaled").collect()))
        assert flat(read()) == flat(whole)
    reader = ArchiveReader(root, False)
    other = EqualTo(("status",), "ok")
    assert list(reader.pushFilters([EqualTo(("ksize",), 31), other])) == [other] and reader.ksizes == {31}
    assert all(b["ksize"].to_pylist() == [31] * b.num_rows for p in reader.partitions() for b in reader.read(p))
    with pytest.raises(Exception, match="folder"):
        spark.read.format(NAME).load().count()


def test_member_rule_and_all_ksizes(spark, root):
    rows = decode_archives(find_archives(spark, root), root_only=True)
    found = {(r.ksize, r.hash) for r in unique_hashes(flat_hashes(rows)).collect()}
    assert (15, 9) not in found and {(21, 5), (21, 1)} <= found


def test_long_sketches_are_cut_into_rows(spark):
    values = list(range(200_000))
    df = spark.createDataFrame([("a", archive({"signatures/1.sig.gz": sig(record({"ksize": 31, "mins": values}))}))],
                               "path string, content binary")
    rows = decode_archives(df).cache()
    assert rows.count() == 4 and rows.where("sketch_head").count() == 1
    assert flat_hashes(rows).count() == 200_000
    assert run_statistics(rows).first().total_hashes == 200_000
    rows.unpersist()


def test_loose_json(spark):
    texts = [record({"ksize": 31, "scaled": 5, "mins": EDGES}), {"filename": "f", "signatures": [{"ksize": 15, "max_hash": 1 << 63, "mins": [1]}]},
             {"ksize": 33, "mins": [], "hashes": {"3": 1, "4": 2}}, [{"ksize": 33, "hashes": [5]}],
             record({"ksize": 31, "mins": [1]}, {"ksize": 31, "mins": [1 << 64]}), {"mins": [1]}, record({"ksize": 31, "mins": []})]
    df = spark.createDataFrame([(i, json.dumps(t)) for i, t in enumerate(texts)] + [(9, "{broken")], "id int, j string")
    got = {(r.id, r.filename, r.ksize, r.scaled, tuple(r.hashes)) for r in decode_signatures(df, "j", ["id"]).collect()}
    assert got == {(0, "genome.fa", 31, 5, tuple(signed(v) for v in EDGES)), (1, "f", 15, 2, (1,)),
                   (2, None, 33, 0, (3, 4)), (3, None, 33, 0, (5,))}


def test_scale_from_largest_hash_is_exact(spark):
    cases = {str(t): int((1 << 64) / t) if t < 1 << 64 else 1 for t in
             [18446744073709552, 1 << 63, 1 << 64, 6148914691236517205, 6148914691236517888, 12345, (1 << 64) - 1]}
    df = spark.createDataFrame([(t, f'{{"ksize":31,"max_hash":{t},"mins":[1]}}') for t in cases], "id string, j string")
    assert {r.id: r.scaled for r in decode_signatures(df, "j", ["id"]).collect()} == cases


def test_vectors(spark, tmp_path):
    folder = tmp_path / "ksize=31" / "part=0a"
    folder.mkdir(parents=True)
    (folder / "w1.bin").write_bytes(np.array(EDGES, "<u8").tobytes() + b"abc")
    (folder / "w2.bin").write_bytes(b"")
    np.save(folder / "part.npy", np.array(EDGES, np.uint64))
    files = find_vectors(spark, str(tmp_path))
    values = read_vectors(files)
    assert [(r.ksize, r.part) for r in values.select("ksize", "part").distinct().collect()] == [(31, "0a")]
    assert sorted(r.hash for r in values.collect()) == sorted(signed(v) for v in EDGES)
    counts = sized_counts(files.select("path", "length")).first()
    assert (counts.hashes, counts.files, counts.mean_per_file) == (4, 1, 4.0)  # empty files are not listed
    assert row_count(values).first()[0] == counts.hashes
    assert sorted(r.hash for r in read_vectors(find_vectors(spark, str(tmp_path), ".npy")).collect()) == sorted(
        signed(v) for v in EDGES)
    assert "content" not in files.select("path", "length").columns


def test_written_vectors_come_back(spark, tmp_path):
    bag = spark.range(5000).selectExpr("CAST(IF(id % 3 = 0, 15, 31) AS INT) AS ksize", "id * 7 AS hash")
    root = str(tmp_path / "vectors")
    write_vectors(bag, root, bits=6)
    back = read_vectors(find_vectors(spark, root), 7)  # ranges of seven values
    assert not [p for p in tmp_path.iterdir() if "writing" in p.name]
    with pytest.raises(FileExistsError):
        write_vectors(bag, root, bits=6)
    assert back.selectExpr("ksize", "hash").exceptAll(bag).isEmpty() and back.count() == 5000
    assert back.where("conv(part, 16, 10) <> (hash & 63)").isEmpty()


@pytest.mark.parametrize("kind", ["<u1", "<u2", ">u2", "<u4", "<i4", "<u8", ">u8", "<i8"])
def test_arrays_of_every_width(spark, tmp_path, kind):
    folder = tmp_path / "ksize=31" / "part=0a"
    folder.mkdir(parents=True)
    values = np.arange(10_000).astype(kind)
    np.save(folder / "part.npy", values)
    np.save(folder / "text.npy", np.array(["x"]))
    (folder / "cut.npy").write_bytes((folder / "part.npy").read_bytes()[:40])
    for size in (1 << 22, 100, 1):
        found = read_vectors(find_vectors(spark, str(tmp_path), ".npy"), size)
        assert sorted(r.hash for r in found.collect()) == sorted(values.astype(np.int64).tolist())


def test_lists_of_files(spark, tmp_path):
    for name in ("a.x", "one/b.x", "one/two/c.x", "one/two/three/d.x", "one/e.y", "empty/"):
        path = tmp_path / name
        (path if name.endswith("/") else path.parent).mkdir(parents=True, exist_ok=True)
        if not name.endswith("/"):
            path.write_bytes(b"12345")
    names = lambda **k: sorted(r.path.removeprefix(f"{tmp_path}/") for r in list_files(spark, str(tmp_path), ".x", **k).collect())
    assert names() == ["a.x", "one/b.x", "one/two/c.x", "one/two/three/d.x"]
    assert names(levels=0) == ["a.x"] and names(levels=1) == ["a.x", "one/b.x"]
    assert [tuple(r) for r in list_files(spark, str(tmp_path / "a.x")).select("path", "length").collect()] == [(str(tmp_path / "a.x"), 5)]
    assert list_files(spark, str(tmp_path / "none")).count() == 0
    assert {r.path for r in list_archives(spark, str(tmp_path), recursive=False).collect()} == set()


def test_a_wide_folder(spark, tmp_path):
    for i in range(25_000):
        (tmp_path / f"{i}.sig.zip").touch()
    listed = list_archives(spark, str(tmp_path))
    assert listed.count() == 25_000 and listed.where("length = 0 and mtime > 1e9").count() == 25_000


def test_work_dealt_by_bytes(spark):
    files = spark.range(2000).selectExpr("concat('f', id) AS path", "IF(id = 7, 500000, 100 + id % 50) AS length", "id AS other")
    dealt = dealt_by_bytes(files, 10, 20_000)
    sizes = sorted(r.n for r in dealt.groupBy(F.spark_partition_id()).agg(F.sum("length").alias("n")).collect())
    assert dealt.count() == 2000 and set(dealt.columns) == {"path", "length", "other"}
    assert sizes[-1] < 500_000 + 40_000 and sizes[-2] <= 60_000 and len(sizes) >= 10
    assert dealt_by_bytes(files.limit(0)).count() == 0
