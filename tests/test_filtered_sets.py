"""Block filters, and sets that grow with them."""

import pytest
from pyspark.sql import functions as F

from fraclake.operators.block_filter import PER_BLOCK, block_bits, filter_blocks, suspected
from fraclake.streaming import filtered
from fraclake.streaming.commits import newest
from fraclake.streaming.filtered import compact_filtered_set, grow_filtered_set
from fraclake.streaming.ingest import compact_unique_set, grow_unique_set, read_grown_set

SCHEMA = "ksize int, hash bigint"


def numbers(spark, first, last, k=21):
    return spark.range(first, last).select(F.lit(k).cast("int").alias("ksize"), F.xxhash64("id", F.lit("h")).alias("hash"))


@pytest.fixture
def feed(spark, tmp_path):
    """Append rows to the stream's folder and let it run."""

    def run(rows, grow=grow_filtered_set, **options):
        rows.write.mode("append").parquet(str(tmp_path / "in"))
        stream = spark.readStream.schema(SCHEMA).parquet(str(tmp_path / "in"))
        grow(stream, str(tmp_path / "out"), str(tmp_path / "cp"), **options).awaitTermination()

    return run


@pytest.fixture
def read_rows(monkeypatch):
    """How many stored rows each lookup has read."""
    read, parts = [], filtered._parts

    def counted(*args):
        rows = parts(*args)
        read.append(rows.count())
        return rows

    monkeypatch.setattr(filtered, "_parts", counted)
    return read


def content(spark, out):
    rows = [tuple(r) for r in read_grown_set(spark, str(out)).select("ksize", "hash").collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def test_block_bits():
    assert [block_bits(n) for n in (0, 1, PER_BLOCK, 2 * PER_BLOCK, 2 * PER_BLOCK + 1, 1 << 20)] == [1, 1, 1, 1, 2, 15]
    assert block_bits(10, least=6) == 6


def test_filters_miss_nothing_and_let_few_pass(spark):
    held, other = numbers(spark, 0, 20000), numbers(spark, 20000, 60000)
    bits = block_bits(20000)
    parts = [(bits, filter_blocks(held.where("hash % 2 = 0"), bits)), (bits - 1, filter_blocks(held.where("hash % 2 != 0"), bits - 1))]
    assert suspected(held.unionByName(held), parts).agg(F.count("*"), F.count_if("maybe")).first()[:] == (20000, 20000)
    total, passed = suspected(other, parts).agg(F.count("*"), F.count_if("maybe")).first()[:]
    assert total == 40000 and passed < 0.005 * total
    assert suspected(held.withColumn("ksize", F.lit(31)), parts).where("maybe").count() < 100  # another k is another hash
    assert suspected(held, []).where("maybe").count() == 0 and suspected(held.limit(0), parts).count() == 0


def test_nulls_are_values(spark):
    rows = spark.createDataFrame([(21, None), (None, 5), (None, None), (21, 5)], SCHEMA)
    held = [(3, filter_blocks(rows, 3))]
    assert suspected(rows, held).where("maybe").count() == 4


def test_stored_rows_are_read_for_known_hashes_only(spark, tmp_path, feed, read_rows):
    feed(numbers(spark, 0, 30000), bits=5)
    assert read_rows == []
    feed(numbers(spark, 30000, 30100), bits=5)  # all are new: next to nothing passes the filter
    new_only = sum(read_rows)
    assert new_only <= 2 * 30000 / 32 * 1.2
    read_rows.clear()
    feed(numbers(spark, 100, 104).unionByName(numbers(spark, 40000, 40100)), bits=5)
    some = sum(read_rows)
    assert 0 < some < 30000 * 7 / 32
    read_rows.clear()
    feed(numbers(spark, 0, 20000), bits=5)
    assert sum(read_rows) > 29000
    assert content(spark, tmp_path / "out") == {tuple(r) for r in numbers(spark, 0, 30100).unionByName(numbers(spark, 40000, 40100)).collect()}


def test_growth_is_exact_for_repeats_nulls_and_several_k(spark, tmp_path, feed):
    odd = spark.createDataFrame([(21, None), (None, 7), (None, None), (31, -1), (31, -1), (21, None)], SCHEMA)
    feed(odd.unionByName(numbers(spark, 0, 50)), bits=2)
    feed(odd.unionByName(numbers(spark, 40, 60)).unionByName(numbers(spark, 0, 20, 31)), bits=2)
    expected = {tuple(r) for r in odd.unionByName(numbers(spark, 0, 60)).unionByName(numbers(spark, 0, 20, 31)).collect()}
    assert content(spark, tmp_path / "out") == expected
    number = newest(spark, str(tmp_path / "out"))[0]
    feed(odd.unionByName(numbers(spark, 0, 60)), bits=2)  # nothing new, no commit
    feed(odd.limit(0), bits=2)
    assert newest(spark, str(tmp_path / "out"))[0] == number and content(spark, tmp_path / "out") == expected


def test_plain_and_filtered_growth_may_be_mixed(spark, tmp_path, feed, read_rows):
    out = tmp_path / "out"
    feed(numbers(spark, 0, 40), grow_unique_set)
    feed(numbers(spark, 30, 60), bits=1)
    feed(numbers(spark, 50, 80), grow_unique_set)
    feed(numbers(spark, 0, 100), bits=2)
    assert content(spark, out) == {tuple(r) for r in numbers(spark, 0, 100).collect()}
    compact_unique_set(spark, str(out))
    feed(numbers(spark, 90, 110), bits=2)
    assert content(spark, out) == {tuple(r) for r in numbers(spark, 0, 110).collect()}
    compact_filtered_set(spark, str(out), bits=3, keep=1)
    state = newest(spark, str(out))[1]
    assert len(state["folders"]) == len(state["filters"]) == 1
    assert sorted(p.name for p in out.iterdir() if p.name != "_commits") == sorted([*state["folders"], *state["filters"].values()])
    read_rows.clear()
    feed(numbers(spark, 0, 115), bits=2)
    assert sum(read_rows) == 110 and content(spark, out) == {tuple(r) for r in numbers(spark, 0, 115).collect()}


def test_what_is_added_during_compaction_keeps_its_filter(spark, tmp_path, feed, monkeypatch):
    out, written, busy = tmp_path / "out", filtered._written, []
    feed(numbers(spark, 0, 40), bits=2)
    feed(numbers(spark, 40, 60), bits=2)

    def slow(*args):
        names = written(*args)
        if not busy:
            busy.append(True)
            feed(numbers(spark, 50, 70), bits=2)
        return names

    monkeypatch.setattr(filtered, "_written", slow)
    compact_filtered_set(spark, str(out), bits=2)
    state = newest(spark, str(out))[1]
    assert len(state["folders"]) == 2 and set(state["filters"]) == set(state["folders"])
    assert content(spark, out) == {tuple(r) for r in numbers(spark, 0, 70).collect()}


def test_part_bits_are_bounded(spark, tmp_path):
    with pytest.raises(ValueError, match="part bits"):
        compact_filtered_set(spark, str(tmp_path), bits=13)
