import random

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import brute
import corpus_pipeline
from brute import TEXTS
from fraclake.llm import decontamination, line_frequency, near_duplicates, queries
from fraclake.llm.components import closed
from check import compare


@pytest.fixture(scope="module")
def connection(small):
    c = duckdb.connect()
    for t in ("documents", "benchmark", "embeddings"):
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{small}/{t}.parquet'")
    return c


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_agreement(spark, connection, small, name):
    good, note = compare(spark, connection, small, name, queries.QUERIES[name], queries.ORACLES[name])
    assert good, note


def near_copies(seed=5):
    """Chains and stars of edited copies, and texts that share a passage only."""
    r = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(3000)]
    passage = [r.choice(vocabulary) for _ in range(60)]
    rows, texts = [], []
    for _ in range(6):
        base = [r.choice(vocabulary) for _ in range(150)]
        for _ in range(14):
            copy = base.copy()
            for _ in range(r.choice([0, 1, 2, 4, 5, 6, 7, 9])):
                copy[r.randrange(len(copy))] = r.choice(vocabulary)
            texts.append(copy)
            if r.random() < 0.3:
                base = copy
    texts += [[r.choice(vocabulary) for _ in range(40)] + passage for _ in range(30)]
    r.shuffle(texts)
    return [(i, " ".join(t)) for i, t in enumerate(texts)]


def test_components_equal_brute_force(spark):
    rows = near_copies()
    expected = brute.components(rows)
    found = near_duplicates.link(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in found} == expected
    assert all(r.kept == (r.component_id == r.doc_id) for r in found)


def test_estimates_are_close(spark):
    rows = near_copies(6)[:40]
    sets = [brute.shingles(t) for _, t in rows]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").select("doc_id", near_duplicates.by_text(near_duplicates.sketches, f"struct<{near_duplicates.SKETCH}>")("text").alias("s"))
    a = df.select(F.col("doc_id").alias("a"), F.col("s.bits").alias("bits_a"))
    b = df.select(F.col("doc_id").alias("b"), F.col("s.bits").alias("bits_b"))
    pairs = a.join(b, F.col("a") < F.col("b")).select("a", "b", near_duplicates.similarity("bits_a", "bits_b").alias("e")).collect()
    errors = [r.e - len(sets[r.a] & sets[r.b]) / len(sets[r.a] | sets[r.b]) for r in pairs]
    assert abs(np.mean(errors)) < 0.01 and max(map(abs, errors)) < 0.25


def test_near_duplicates_of_odd_rows(odd, empty):
    rows = near_duplicates.link(odd).collect()
    assert len(rows) == odd.count()
    expected = brute.components(list(enumerate(TEXTS)))
    for r in rows:
        if r.doc_id is None:
            assert r.component_id is None and r.kept
        else:
            assert (r.n_shingles, r.component_id) == expected[r.doc_id]
    kept = near_duplicates.representatives(odd)
    assert kept.columns == odd.columns and kept.where("doc_id = 6").count() == 1 and kept.where("doc_id is null").count() == 1
    assert near_duplicates.link(empty).count() == 0 and near_duplicates.representatives(empty).count() == 0


def test_rows_that_repeat_an_id_are_linked_by_their_own_texts(spark, small):
    r = random.Random(8)
    a, b = ([f"w{r.randrange(10**6)}" for _ in range(120)] for _ in range(2))
    texts = {"A": " ".join(a), "Ax": " ".join([*a[:-1], "x"]), "B": " ".join(b), "By": " ".join([*b[:-1], "y"])}
    rows = [(1, "A"), (2, "Ax"), (2, "B"), (3, "By"), (3, "By"), (2, "B"), (None, "A")]
    docs = spark.createDataFrame([(i, texts[t], "s", "en", len(texts[t])) for i, t in rows], "doc_id bigint, text string, source string, lang string, n_chars bigint")
    found = near_duplicates.link(docs.select("doc_id", "text"), also=()).collect()
    names = {(r.doc_id, r.component_id, r.kept) for r in found}
    assert len(found) == 7 and names == {(1, 1, True), (2, 1, False), (2, 2, True), (3, 2, False), (None, None, True)}
    kept = near_duplicates.representatives(docs)
    assert kept.columns == docs.columns and sorted((r.doc_id or 0, r.text) for r in kept.collect()) == [(0, texts["A"]), (1, texts["A"]), (2, texts["B"])]
    several = line_frequency.without_boilerplate(docs, near=True)
    assert several.count() == 7


def test_pipeline_of_odd_rows(spark, small, odd):
    """Nulls, empty and repeated rows and columns with clashing names go through every stage but the last, which packs them."""
    texts = [r.text for r in odd.select("text").collect()]
    for docs in (odd, odd.limit(0)):
        for name, stage in corpus_pipeline.STAGES:
            before = docs
            docs = queries_stored(stage(spark, docs, small), name)
            if name != corpus_pipeline.STAGES[-1][0]:
                assert docs.columns == before.columns and docs.count() <= before.count()
                assert {r.text for r in docs.collect()} <= set(texts)
        assert docs.count() >= (before.count() > 0)


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(100, 140)] + [(7, i) for i in range(8, 20)] + [(50, 51), (51, 50), (60, 60)]
    labels = {r.node: r.label for r in closed(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert labels == {i: 100 for i in range(100, 141)} | {i: 7 for i in range(7, 20)} | {50: 50, 51: 50}


ITEMS = [(1, "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda"), (2, "Short, item!"), (2, "short item"), (3, None), (4, "--"), (None, "nameless passage here"), (12, "eta theta iota")]


def test_contamination_by_hand(spark):
    docs = [(1, "x ALPHA beta, gamma delta epsilon zeta eta theta iota kappa end"), (2, "a short item and a Short ITEM"), (3, None), (4, "nothing"),
            (5, "nameless passage here"), (6, ""), (7, "beta gamma delta epsilon zeta eta theta iota kappa lambda alpha beta gamma delta epsilon zeta eta theta iota kappa lambda")]
    items = spark.createDataFrame(ITEMS, "item_id bigint, text string")
    for block in (decontamination.BLOCK_WINDOWS, 1):
        found = {r.doc_id: r.contamination for r in decontamination.contamination(spark.createDataFrame(docs, "doc_id bigint, text string"), items, block=block).collect()}
        for doc_id, text in docs:
            n, hit, ids = brute.windows_hit(text, {k: v for k, v in enumerate(t for _, t in ITEMS)})
            ids = sorted({ITEMS[k][0] for k in ids} - {None})
            assert (found[doc_id]["n_words"], found[doc_id]["n_hit"], found[doc_id]["items"]) == (n, hit, ids)
    cut = {r.doc_id: r.text for r in decontamination.without_spans(spark.createDataFrame(docs, "doc_id bigint, text string"), items).collect()}
    assert cut[2] == "a  and a " and cut[4] == "nothing" and cut[3] is None


def test_contamination_of_odd_rows(spark, odd, empty):
    items = spark.createDataFrame(ITEMS, "item_id bigint, text string")
    found = decontamination.contamination(odd, items)
    assert found.columns == [*odd.columns, "_contamination"] and found.count() == odd.count()
    assert decontamination.without_contaminated(odd, items).columns == odd.columns
    assert decontamination.digest(empty, items).count() == 0
    assert decontamination.digest(odd, items.limit(0)).where("contaminated").count() == 0


def test_lines_by_hand(spark, odd, empty):
    pages = [(i, f"own line {i}\n menu \nfooter {i % 2}", "a" if i < 10 else None) for i in range(20)] + [(99, "own line\nmenu", "b"), (100, None, "a"), (101, "menu\nmenu", "a")]
    docs = spark.createDataFrame([(*p, 5) for p in pages] + [(*pages[0], 5)] * 3, "doc_id bigint, text string, source string, n_chars int")
    found = {r.doc_id: r.text for r in line_frequency.without_boilerplate(docs, ratio=0.6, least=3).collect()}
    assert found[0] == "own line 0\nfooter 0" and found[15] == "own line 15\nfooter 1" and found[99] == "own line\nmenu"
    assert found[100] is None and 101 not in found
    assert line_frequency.without_boilerplate(odd, least=1, ratio=0.9).columns == odd.columns
    assert line_frequency.without_boilerplate(empty).count() == 0


def test_pipeline_stages(spark, documents, small):
    """Each stage against a plain version of its decision, on its own input."""
    docs = documents
    for name, stage in corpus_pipeline.STAGES:
        before = {r.doc_id: r for r in docs.collect()}
        docs = queries_stored(stage(spark, docs, small), name)
        rows = docs.collect()
        if name != corpus_pipeline.STAGES[-1][0]:
            assert docs.columns == documents.columns
        if name == "MinHash near-dedup":
            expected = {c for _, c in brute.components([(d, r.text) for d, r in before.items()]).values()} | {d for d, r in before.items() if not brute.shingles(r.text)}
            assert {r.doc_id for r in rows} == expected
        if name == "benchmark decontamination":
            items = {r.item_id: r.text for r in spark.read.parquet(f"{small}/benchmark.parquet").collect()}
            assert {r.doc_id for r in rows} == {d for d, r in before.items() if not brute.windows_hit(r.text, items)[1]}
        if name == "line dedup":
            pages = {}
            for r in {(r.source, r.text) for r in before.values()}:
                pages.setdefault(r[0], []).append({x.strip(line_frequency.AROUND) for x in r[1].split("\n")} - {""})
            often = {s: {x for x in set().union(*p) if (n := sum(x in q for q in p)) >= line_frequency.LEAST_PAGES and n >= line_frequency.RATIO * len(p)} for s, p in pages.items()}
            expected = {d: "\n".join(x for x in r.text.split("\n") if x.strip(line_frequency.AROUND) not in often[r.source]) for d, r in before.items()}
            assert {r.doc_id: r.text for r in rows} == {d: t for d, t in expected.items() if t.strip() or t == before[d].text}
        if name == "best-fit packing":
            assert {r.doc_id for r in rows} == set(before)


def queries_stored(df, name):
    from fraclake.llm.frames import stored

    return stored(df, name.replace(" ", "-"))


def test_near_copies_leave_their_representative_whole(spark):
    import corpus_pipeline

    def lines(key, n):
        return [" ".join(f"{key}w{i}x{j}" for j in range(20)) for i in range(n)]

    copied = lines("copied", 6)
    rows = [(i, "\n".join([*copied, f"changed to {i}", "the footer"]), "site") for i in range(80)]
    rows += [(i, "\n".join([*lines(f"own{i}", 2), "the footer"]), "site") for i in range(80, 120)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    cleaned = corpus_pipeline.lines(spark, docs, "")
    kept = {r.doc_id: r.text for r in corpus_pipeline.near_copies(spark, cleaned, "").collect()}
    assert sorted(kept) == [0, *range(80, 120)]
    assert kept[0] == "\n".join([*copied, "changed to 0"])
    assert all("the footer" not in t for t in kept.values())
