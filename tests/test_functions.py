"""Column helpers: unsigned edges, SplitMix64, partition ids, hash vectors, file names."""

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from fraclake.functions import register_sql
from fraclake.functions.hashing import murmur64, murmur64_bytes
from fraclake.functions.mixing import hex_label, low_bits, with_partition_id, with_splitmix64
from fraclake.functions.paths import (is_target_file, output_path, retry_delay, shard_of)
from fraclake.functions.unsigned import (bits_from_decimal, decimal_from_bits, signed, unsigned_at_most,
                                         unsigned_key)

TOP = (1 << 64) - 1
EDGES = [0, 1, (1 << 63) - 1, 1 << 63, TOP]


def splitmix(x):
    z = (x + 0x9E3779B97F4A7C15) & TOP
    z = ((z ^ (z >> 30)) * 0xBF58476D1CE4E5B9) & TOP
    z = ((z ^ (z >> 27)) * 0x94D049BB133111EB) & TOP
    return z ^ (z >> 31)


def test_unsigned_conversions_and_order(spark):
    from decimal import Decimal

    df = spark.createDataFrame([(Decimal(v),) for v in EDGES], "u decimal(20,0)")
    bits = df.select("u", bits_from_decimal("u").alias("h"))
    rows = bits.select("u", "h", decimal_from_bits("h").alias("back")).collect()
    assert all(r.h == signed(int(r.u)) and r.back == r.u for r in rows)
    assert [int(r.u) for r in bits.orderBy(unsigned_key("h")).collect()] == EDGES
    for bound in (0, 5, (1 << 63) - 1, 1 << 63, TOP):
        kept = {int(r.u) for r in bits.where(unsigned_at_most("h", bound)).collect()}
        assert kept == {v for v in EDGES if v <= bound}


def test_values_of_2_to_64_are_refused(spark):
    df = spark.createDataFrame([(1,)], "x int").select(F.expr(f"CAST({1 << 64} AS DECIMAL(20,0))").alias("u"))
    with pytest.raises(PySparkException):
        df.select(bits_from_decimal("u")).collect()


@settings(max_examples=5, deadline=None)
@given(st.lists(st.integers(0, TOP), min_size=1, max_size=40))
def test_splitmix_and_partitions_match_integers(spark, values):
    df = spark.createDataFrame([(signed(v),) for v in values + EDGES], "hash bigint")
    out = with_splitmix64(df, "hash", "m")
    for mode, bits in (("mix", 14), ("low", 9), ("high", 8)):
        out = with_partition_id(out, bits, mode, target=mode)
    for r in out.withColumn("label", hex_label("mix", 14)).collect():
        v = r.hash & TOP
        assert r.m == signed(splitmix(v))
        assert r.mix == splitmix(v) >> 50 and r.label == format(r.mix, "04x")
        assert r.low == v & 511 and r.high == v >> 56


def test_partition_arguments_are_checked(spark):
    df = spark.createDataFrame([(1,)], "hash bigint")
    with pytest.raises(ValueError):
        with_partition_id(df, 0)
    with pytest.raises(ValueError):
        with_partition_id(df, 8, "middle")


def test_sql_functions(spark):
    register_sql(spark)
    df = spark.createDataFrame([(signed(v),) for v in EDGES], "h bigint")
    rows = spark.sql("SELECT h, splitmix64(h) AS m, hash_bucket(h, 9) AS b, murmur64('ACG') AS k FROM {d}", d=df).collect()
    assert all(r.m == signed(splitmix(r.h & TOP)) and r.b == r.h & 511 for r in rows)
    assert {r.k for r in rows} == {1731421407650554201}


def test_murmur_vectors(spark):
    known = {"ACG": 1731421407650554201, "ACGTTGCATGTCGCA": 14203271668276977412, "A" * 31: 2689060699658636553,
             "ACGTACGTACGTACGTACGTACGTACGTACG": 17897553464741958189}
    assert murmur64_bytes([k.encode() for k in known]).tolist() == list(known.values())
    assert int(murmur64_bytes([b"hello"], seed=0)[0]) == 0xCBD8A7B341BD9B02
    df = spark.createDataFrame([(k,) for k in known] + [(None,)], "s string").select("s", murmur64("s").alias("h"))
    assert {r.s: r.h for r in df.collect()} == {**{k: signed(v) for k, v in known.items()}, None: None}


def test_murmur_does_not_depend_on_the_batch():
    for length in range(0, 40):
        key = bytes(range(length))
        one, many = murmur64_bytes([key], seed=7)[0], murmur64_bytes([b"x" * length, key, key], seed=7)
        assert one == many[1] == many[2]


def test_target_files_and_shards(spark):
    names = ["wgs.AASDTR.1.fsa_nt.gz", "wgs.BCDE01.2.fsa_nt.gz", "wgs.QWERTY.fsa_nt.gz", "wgs.AASDTR.1.gbff.gz",
             "stats.wgs.AASDTR/file.txt", "x/wgs.CADASZ.1.fsa_nt.gz", "other.txt", "wgs..1.fsa_nt.gz", "wgs."]
    df = spark.createDataFrame([(n,) for n in names], "n string")
    rows = df.select("n", is_target_file("n").alias("t"), shard_of("n").alias("s")).collect()
    assert [r.t for r in rows] == [True, True, True, False, False, True, False, False, False]
    assert [r.s for r in rows] == ["AAS", "BCD", "QWE", "AAS", "misc", "CAD", "misc", "misc", "misc"]


def test_output_path_prefers_the_listed_folder(spark):
    df = spark.createDataFrame([("", "wgs.AASDTR.1.fsa_nt.gz"), (None, "wgs.AASDTR.1.fsa_nt.gz"), ("ZZZ", "wgs.AASDTR.1.fsa_nt.gz")],
                               "d string, f string")
    paths = [r.p for r in df.select(output_path("out", "d", "f").alias("p")).collect()]
    assert paths == ["out/AAS/wgs.AASDTR.1.fsa_nt.gz.sig.zip"] * 2 + ["out/ZZZ/wgs.AASDTR.1.fsa_nt.gz.sig.zip"]


def test_retry_delay(spark):
    df = spark.range(0, 80).select("id", retry_delay(F.col("id").cast("int")).alias("d"))
    assert all(r.d == min(300, 2 ** r.id) for r in df.collect())


def test_low_bits_of_negative_patterns(spark):
    df = spark.createDataFrame([(-1,), (signed(1 << 63),)], "h bigint")
    assert [r.b for r in df.select(low_bits("h", 9).alias("b")).collect()] == [511, 0]
    assert np.uint64(1 << 63) & np.uint64(511) == 0
