"""Work lists that are dealt to tasks, and hashing by array arithmetic against the libraries."""

import hashlib
import random
import re

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from fraclake.functions.unsigned import signed
from fraclake.operators.aligned_difference import aligned_difference, work_list
from fraclake.operators.sketching import canonical_md5, word_run_hashes
from fraclake.plans.sketches import synthetic_sets
from fraclake.plans.streams import _with_null
from fraclake.sinks import hash_sets as layouts
from fraclake.sinks.archives import write_files, write_vectors
from fraclake.sources import fasta_ranges
from fraclake.sources.archives import decode_archive_files, list_archives
from fraclake.sources.fasta_ranges import _pieces, read_fasta_ranges
from fraclake.sources.vectors import find_vectors, read_vectors

SWAP = str.maketrans("ACGT", "TGCA")


def top64(text):
    return int(hashlib.md5(text.encode()).hexdigest()[:16], 16)


def tasks(df):
    return df.select(F.spark_partition_id().alias("task")).distinct().count()


def set_of(spark, root, values):
    layouts.write_unique_set(spark.createDataFrame([(31, signed(v)) for v in values], "ksize int, hash bigint"), root, 1)
    return root


def test_pieces_read_each_value_a_few_times(spark, tmp_path):
    lhs, rhs = set_of(spark, str(tmp_path / "l"), range(0, 4000, 8)), set_of(spark, str(tmp_path / "r"), range(0, 4000, 16))
    pieces = work_list(spark, lhs, rhs, [31], 1).collect()
    assert sum(len(r.groups) for r in pieces) <= 3 * len({(g.side, g.path, g.row_group) for r in pieces for g in r.groups})


def test_small_row_groups_allow_small_pieces(spark, tmp_path):
    for side in "lr":
        folder = tmp_path / side / "ksize=31" / "part=0"
        folder.mkdir(parents=True)
        pq.write_table(pa.table({"hash": pa.array(range(1000), pa.int64())}), folder / "part.parquet", row_group_size=10)
    sizes = [len(r.groups) for r in work_list(spark, str(tmp_path / "l"), str(tmp_path / "r"), [31], 20).collect()]
    assert len(sizes) == 100 and max(sizes) <= 6


def test_short_lists_are_dealt_to_many_tasks(spark, tmp_path):
    lhs, rhs = set_of(spark, str(tmp_path / "l"), range(400)), set_of(spark, str(tmp_path / "r"), range(800))
    for n, root in enumerate((lhs, rhs)):  # small row groups, so that there are many pieces
        for path in (tmp_path / "lr"[n]).rglob("*.parquet"):
            pq.write_table(pq.read_table(path), path, row_group_size=10)
    assert tasks(aligned_difference(spark, lhs, rhs, [31], 20)) > 1
    write_vectors(spark.range(4000).select(F.lit(31).alias("ksize"), F.col("id").alias("hash")), str(tmp_path / "v"), 3)
    values = read_vectors(find_vectors(spark, str(tmp_path / "v")), 50)
    assert tasks(values) > 1 and values.count() == 4000
    (tmp_path / "f").mkdir()
    (tmp_path / "f" / "a.fa").write_bytes(b">x\n" + bytes(random.Random(3).choices(b"ACGT", k=20_000)))
    assert tasks(read_fasta_ranges(spark, str(tmp_path / "f"), 21, size=500)) > 1


def test_archives_of_one_folder_are_decoded_by_many_tasks(spark, tmp_path):
    names = spark.range(60).select(F.concat(F.lit(f"{tmp_path}/in/AAA/"), "id", F.lit(".sig.zip")).alias("path"), F.lit(b"no zip").alias("content"))
    write_files(names)
    rows = decode_archive_files(list_archives(spark, str(tmp_path / "in")))
    assert tasks(rows) > 1 and rows.where("status = 'bad_archive'").count() == 60
    assert decode_archive_files(list_archives(spark, str(tmp_path / "in")).select("path"), deal=False).count() == 60


def test_a_short_range_reads_little(monkeypatch):
    class Counted:
        def __init__(self, raw):
            self.file, self.read = pa.BufferReader(raw), 0

        def size(self):
            return self.file.size()

        def read_at(self, length, at):
            found = self.file.read_at(length, at)
            self.read += len(found)
            return found

    raw = b">x\n" + b"ACGT" * 500_000
    file = Counted(raw)
    assert list(_pieces(file, "no", 1000, 1500, False, 31)) == [raw[1000:1500], raw[1470:1530]]
    assert file.read <= 500 + fasta_ranges.BEHIND


def test_generated_sets_use_several_tasks(spark):
    assert tasks(synthetic_sets(spark, "/root/testdata/sf0.001")) > 1


def test_a_bag_is_made_once(spark):
    bag = spark.range(50).select(F.lit(31).alias("ksize"), F.conv(F.substring(F.md5(F.col("id").cast("string")), 1, 15), 16, 10).cast("bigint").alias("hash"))
    both = _with_null(bag)
    assert "md5" not in both._jdf.queryExecution().optimizedPlan().toString()
    assert both.count() == 51 and both.where("hash is null").count() == 1


@pytest.mark.parametrize("k", [1, 5, 8, 9, 16, 31, 32, 33, 55, 56, 70])
def test_canonical_md5_matches_the_library(k):
    rng = random.Random(k)
    pieces = ["".join(rng.choices("ACGT", k=rng.randrange(300))) for _ in range(60)] + ["ACGT" * 40, "A" * 90, "GAATTC" * 20, "".join(rng.choices("ACGT", k=40_000))]
    for chunk in (64, 1 << 16):
        expected = [(i, top64(min(w, w.translate(SWAP)[::-1]))) for i, p in enumerate(pieces) for w in (p[j:j + k] for j in range(min(chunk, len(p) - k + 1)))]
        found = canonical_md5(pa.array([b"AC"] + [p.encode() for p in pieces]).slice(1), k, chunk)
        assert [(int(r), int(h)) for rows, hashes in found for r, h in zip(rows, hashes)] == expected


def test_word_runs_match_the_library():
    rng = random.Random(1)
    texts = [None, "", " ", "a", "a b", " a  b\n\nc ", "x " * 30, "ä ö " * 9, "\t", None, "w" * 300 + " v u"]
    texts += ["".join(rng.choice("ab \n\té") for _ in range(rng.randrange(200))) for _ in range(200)]
    texts += [" ".join("w" * rng.randrange(30) for _ in range(50)) for _ in range(30)]
    found = word_run_hashes(pa.array(texts).cast(pa.large_binary()).slice(1), (1, 3, 5), np.uint64(1 << 63))
    for k, (cuts, hashes) in zip((1, 3, 5), found):
        for i, text in enumerate(texts[1:]):
            words = re.split(r"[ \n\t\r]+", text) if text is not None else []
            expected = [h for j in range(len(words) - k + 1) if (h := top64(" ".join(words[j:j + k]))) <= 1 << 63]
            assert [int(h) for h in hashes[cuts[i]:cuts[i + 1]]] == expected
