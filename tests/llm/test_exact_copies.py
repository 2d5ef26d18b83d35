import hashlib

import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from fraclake.llm import exact_copies
from fraclake.llm.exact_copies import GROWTH, HEAD, report, without_copies


def plainly(rows):
    """{(doc_id, text): (keep_id, size)} of (doc_id, text) rows; a null id ranks lowest."""
    groups = {}
    for i, t in rows:
        groups.setdefault(t or "", []).append(i)
    best = {t: max((i for i in ids if i is not None), default=None) for t, ids in groups.items()}
    return {(i, t or ""): (best[t or ""], len(groups[t or ""])) for i, t in rows}


def agree(spark, rows):
    found = report(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    texts = {hashlib.sha256((t or "").encode()).hexdigest(): t or "" for _, t in rows}
    wanted = plainly(rows)
    assert len(found) == len(rows)
    for r in found:
        assert (r.keep_id, r.group_size) == wanted[r.doc_id, texts[r.text_sha256]]
    kept = [r for r in found if r.kept]
    assert len(kept) == len(texts) == len({r.text_sha256 for r in kept})
    assert all(r.doc_id == r.keep_id for r in kept)


def test_copies_that_differ_late(spark):
    base = "é" * (HEAD * (1 + GROWTH + GROWTH**2))
    ends = [HEAD, HEAD * (1 + GROWTH), HEAD * (1 + GROWTH + GROWTH**2)]
    texts = [base, base + "x", base + "y", None, "", " ", "\0", "a", "A"]
    texts += [base.encode()[:n + d].decode(errors="ignore") for n in ends for d in (-2, 0, 2)]
    rows = [(i, t) for i, t in enumerate(texts * 3)] + [(None, base), (None, "only without an id"), (5, texts[5]), (3, "")]
    agree(spark, rows)
    agree(spark, [(i, "one text for all") for i in range(300)])


def test_entries_of_many_batches(spark):
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        agree(spark, [(i, ("long " * 40 + str(i % 5)) if i % 3 else "hot") for i in range(400)])
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 5), st.text(alphabet="ab", max_size=3)), max_size=30))
def test_gathered_rows(rows):
    batch = pa.RecordBatch.from_arrays([pa.array([i for i, _ in rows], pa.int64()), pa.array([t for _, t in rows], pa.string())], names=["id", "text"])
    found = [(t, i) for part in exact_copies.gathered(iter([batch])) for ids, t in zip(part["ids"].to_pylist(), part["text"].to_pylist()) for i in ids]
    assert sorted(found) == sorted((t.encode(), i) for i, t in rows)
    assert sum(part.num_rows for part in exact_copies.gathered(iter([batch]))) == len({t for _, t in rows})


def test_rows_that_stay(odd, empty):
    kept = without_copies(odd)
    assert kept.columns == odd.columns
    assert kept.count() == odd.select(F.coalesce("text", F.lit(""))).distinct().count()
    assert kept.where("doc_id is null").count() == 1  # the only row of its text
    assert report(odd).count() == odd.count()
    assert report(empty).count() == without_copies(empty).count() == 0


def test_documents(documents):
    agree(documents.sparkSession, [(r.doc_id, r.text) for r in documents.collect()])
