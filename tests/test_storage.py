"""Layouts, manifests, tables."""

import json
import random

import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from fraclake.functions.unsigned import signed
from fraclake.operators.aligned_difference import aligned_difference
from fraclake.operators.hash_sets import difference
from fraclake.operators.stored_comparison import compare_stored, stored_difference
from fraclake.shared import fresh_database
from fraclake.sinks import hash_sets as layouts
from fraclake.sinks.reports import write_report
from fraclake.sinks.tables import ingest
from fraclake.sources.hash_sets import (discover_ksizes, manifests_agree, read_bucketed_set, read_flat_hashes, read_manifest,
                                        read_unique_set, require_compatible)


def sample(spark, n=3000):
    return spark.range(n).selectExpr("CAST(IF(id % 2 = 0, 15, 31) AS INT) AS ksize", "id * 2654435761 AS hash")


def stored(spark, root, bits=4, mode="mix"):
    layouts.write_unique_set(sample(spark), root, bits, mode)
    layouts.write_manifest(layouts.manifest(read_unique_set(spark, root), bits, mode, "2025-01-01 00:00:00"), root)
    return root


@pytest.mark.parametrize("mode,bits", [("mix", 4), ("low", 5), ("high", 3)])
def test_unique_set_roundtrip(spark, tmp_path, mode, bits):
    root = stored(spark, str(tmp_path / "s"), bits, mode)
    back = read_unique_set(spark, root)
    assert back.select("ksize", "hash").exceptAll(sample(spark)).isEmpty() and back.count() == 3000
    assert all(len(r.part) == 1 + (bits > 4) for r in back.select("part").distinct().collect())
    m = read_manifest(spark, root).first()
    assert m.total_distinct == 3000 and m.ksizes["15"].distinct_count == 1500 and m.partition_bits == bits
    assert m.ksizes["31"].partitions == back.where("ksize = 31").select("part").distinct().count()


def test_a_dominant_partition_is_split(spark, tmp_path):
    """Mode high with small hashes puts every row in one partition; several tasks write it."""
    small = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k", "spark.sql.adaptive.coalescePartitions.minPartitionSize": "1k"}
    for key, value in small.items():
        spark.conf.set(key, value)
    try:
        rows = spark.range(400_000, numPartitions=8).selectExpr("31 AS ksize", "id AS hash")
        layouts.write_unique_set(rows, str(tmp_path / "s"), 8, "high")
    finally:
        for key in small:
            spark.conf.unset(key)
    stats = layouts.layout_stats(layouts.list_parquet(spark, str(tmp_path / "s")), "part").first()
    assert stats.partitions == 1 and stats.files > 3
    assert read_unique_set(spark, str(tmp_path / "s")).count() == 400_000


def test_labels_are_not_read_as_numbers(spark, tmp_path):
    values = [0, (1 << 63) - 1, 1 << 63, (1 << 64) - 1]
    for part in ("0009", "1e10"):
        folder = tmp_path / "ksize=31" / f"part={part}"
        folder.mkdir(parents=True)
        pq.write_table(pa.table({"hash": pa.array(values, pa.uint64())}), folder / "part.parquet")
    rows = read_unique_set(spark, str(tmp_path)).collect()
    assert {r.part for r in rows} == {"0009", "1e10"} and {r.hash for r in rows} == {signed(v) for v in values}
    assert {r.hash for r in read_flat_hashes(spark, str(tmp_path)).collect()} == {signed(v) for v in values}
    (tmp_path / "_MANIFEST.json").write_text(json.dumps({"format": "parquet", "partition_bits": 16, "partition_mode": "mix",
                                                         "created_at": "x", "ksizes": {"31": {"partitions": 2, "distinct_count": 8}},
                                                         "total_distinct": 8}, indent=2))
    assert read_manifest(spark, str(tmp_path)).first().ksizes["31"].distinct_count == 8


def test_discovery_of_ksizes(spark, tmp_path):
    root = stored(spark, str(tmp_path / "s"))
    assert discover_ksizes(spark, root) == [15, 31]
    assert discover_ksizes(spark, root, [31, 33]) == [31]
    with pytest.raises(ValueError):
        discover_ksizes(spark, root, [33])


def test_manifest_guard(spark, tmp_path):
    a, b = stored(spark, str(tmp_path / "a")), stored(spark, str(tmp_path / "b"), 5)
    none = read_manifest(spark, str(tmp_path / "missing"))
    require_compatible(read_manifest(spark, a), read_manifest(spark, a))
    require_compatible(read_manifest(spark, a), none)
    assert manifests_agree(none, none).first().compatible
    with pytest.raises(ValueError):
        require_compatible(read_manifest(spark, a), read_manifest(spark, b))
    broken = tmp_path / "broken"
    broken.mkdir()
    (broken / "_MANIFEST.json").write_text("{nope")
    assert read_manifest(spark, str(broken)).isEmpty()


def set_of(spark, root, values, bits=3, mode="low", nulls=0):
    rows = [(31 if v % 3 else 15, signed(v)) for v in values] + [(31, None)] * nulls
    layouts.write_unique_set(spark.createDataFrame(rows, "ksize int, hash bigint"), root, bits, mode)
    layouts.write_manifest(layouts.manifest(read_unique_set(spark, root), bits, mode, "2025-01-01 00:00:00"), root)
    return root


@pytest.mark.parametrize("piece", [1, 7, 1 << 23])
def test_aligned_difference(spark, tmp_path, piece):
    rng = random.Random(piece)
    every = [0, 1, (1 << 63) - 1, 1 << 63, (1 << 64) - 1] + [rng.randrange(1 << 64) for _ in range(300)]
    left, right = rng.sample(every, 200), rng.sample(every, 200)
    lhs, rhs = set_of(spark, str(tmp_path / "l"), left, nulls=1), set_of(spark, str(tmp_path / "r"), right, nulls=1)
    found = aligned_difference(spark, lhs, rhs, [15, 31], piece)
    wanted = {(31 if v % 3 else 15, signed(v)) for v in set(right) - set(left)} | {(31, None)}
    rows = found.collect()
    assert {(r.ksize, r.hash) for r in rows} == wanted and len(rows) == len(wanted)
    assert all(r.part == (None if r.hash is None else f"{r.hash & 7:x}") for r in rows)
    assert aligned_difference(spark, lhs, rhs, [15], piece).where("ksize <> 15").isEmpty()
    assert aligned_difference(spark, rhs, rhs, [15, 31], piece).where("hash IS NOT NULL").isEmpty()


def test_aligned_difference_of_unsigned_and_unsorted_files(spark, tmp_path):
    for side, values in (("l", [5, 1 << 63, 2]), ("r", [(1 << 64) - 1, 2, 1 << 63, 9, (1 << 63) + 5])):
        folder = tmp_path / side / "ksize=31" / "part=0"
        folder.mkdir(parents=True)
        pq.write_table(pa.table({"other": ["x"] * len(values), "hash": pa.array(values, pa.uint64() if side == "r" else pa.int64()) if side == "r"
                                 else pa.array([signed(v) for v in values], pa.int64())}), folder / "part.parquet", row_group_size=2)
    found = aligned_difference(spark, str(tmp_path / "l"), str(tmp_path / "r"), [31], 1)
    assert {r.hash for r in found.collect()} == {-1, 9, signed((1 << 63) + 5)}


def test_stored_sides_are_not_shuffled_where_manifests_agree(spark, tmp_path):
    a, b, c = set_of(spark, str(tmp_path / "a"), range(100)), set_of(spark, str(tmp_path / "b"), range(50, 150)), set_of(spark, str(tmp_path / "c"), range(100), 4, "mix")
    for lhs, scans in ((a, 0), (c, 2)):
        lost = stored_difference(spark, lhs, b, [15, 31])
        plan = lost._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Scan parquet") == plan.count("FileScan parquet") == scans  # the aligned one reads files in tasks
        assert {r.hash for r in lost.collect()} == set(range(100, 150))
    assert compare_stored(spark, c, b).first().total == 50
    with pytest.raises(ValueError):
        compare_stored(spark, c, b, strict=True)


def test_bucketed_sorted_and_flat(spark, tmp_path):
    layouts.write_bucketed(sample(spark), str(tmp_path / "b"), 3)
    back = read_bucketed_set(spark, str(tmp_path / "b"))
    assert back.count() == 3000 and back.where("bucket <> (hash & 7)").isEmpty()
    layouts.write_sorted_unique(sample(spark).union(sample(spark)), str(tmp_path / "u"))
    assert spark.read.parquet(str(tmp_path / "u")).count() == 3000
    with pytest.raises(RuntimeError):
        (tmp_path / "empty").mkdir()
        layouts.require_parquet(spark, str(tmp_path / "empty"))


def test_empty_difference_writes_no_partitions(spark, tmp_path):
    layouts.write_difference(sample(spark).limit(0), str(tmp_path / "d"))
    assert not list((tmp_path / "d").glob("ksize=*"))


def test_ingest_without_manifest(spark, tmp_path):
    root = str(tmp_path / "s")
    layouts.write_unique_set(sample(spark), root, 2)
    schema = fresh_database(spark)
    assert ingest(spark, root, schema, "per-ksize", analyze=True).first().rows_ingested == 3000
    meta = spark.table(f"{schema}.meta_dataset").first()
    assert meta.format is None and meta.source_manifest is None and meta.ksizes == "15,31"
    assert spark.table(f"{schema}.meta_ksize").count() == 2
    ingest(spark, root, schema, "per-ksize")
    assert spark.table(f"{schema}.meta_dataset").count() == 2 and spark.table(f"{schema}.hashes_15").count() == 1500
    with pytest.raises(ValueError):
        ingest(spark, root, schema, "other")


def test_statistics_of_loaded_tables(spark, tmp_path):
    root = stored(spark, str(tmp_path / "s"))
    schema = fresh_database(spark)
    ingest(spark, root, schema, "per-ksize", analyze=True)
    ingest(spark, root, schema, "single", analyze=True)
    for table, n in (("hashes_15", 1500), ("hashes_31", 1500), ("hashes", 3000)):
        told = {r.info_name: r.info_value for r in spark.sql(f"DESCRIBE EXTENDED {schema}.{table} hash").collect()}
        values = [r.hash for r in spark.table(f"{schema}.{table}").collect()]
        assert len(values) == n and (int(told["min"]), int(told["max"]), told["num_nulls"]) == (min(values), max(values), "0")
        assert abs(int(told["distinct_count"]) - n) <= 0.15 * n
        assert f"{n} rows" in {r.col_name: r.data_type for r in spark.sql(f"DESCRIBE EXTENDED {schema}.{table}").collect()}["Statistics"]


def test_bucketed_tables_join_without_a_shuffle(spark, tmp_path):
    root = stored(spark, str(tmp_path / "s"))
    schemas = [fresh_database(spark) for _ in range(2)]
    for schema in schemas:
        ingest(spark, root, schema, "per-ksize", ksizes=[15], hash_buckets=4)
    a, b = (spark.table(f"{s}.hashes_15") for s in schemas)
    lost = difference(a, b.hint("merge"), ["hash"])
    assert lost.isEmpty() and "Exchange" not in lost._jdf.queryExecution().executedPlan().toString()


def test_report(spark, tmp_path):
    df = spark.createDataFrame([(1, "x", None)], "a int, b string, c int")
    write_report(df, str(tmp_path / "r"))
    assert spark.read.json(str(tmp_path / "r" / "json")).first().a == 1
    assert [r.value for r in spark.read.text(str(tmp_path / "r" / "text")).collect()] == ["a: 1", "b: x", "c: -"]
