import math
import random
import struct

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

import brute
from fraclake.llm import decision_lists, importance, language, toxicity
from fraclake.llm.top_k import kth_largest


@pytest.mark.parametrize("values,k", [([5, 1, 4, 4, 2], 3), ([7] * 50, 20), ([1.5, -2.5, 0.0], 1), ([3], 1), (list(range(1000)), 990)])
def test_kth_largest(spark, monkeypatch, values, k):
    from fraclake.llm import top_k

    monkeypatch.setattr(top_k, "FEW", 3)
    monkeypatch.setattr(top_k, "RANGES", 7)
    df = spark.createDataFrame([(v,) for v in values] + [(None,)], f"v {'double' if isinstance(values[0], float) else 'bigint'}")
    assert kth_largest(df, "v", k) == sorted(values, reverse=True)[k - 1]
    assert kth_largest(df, "v", len(values) + 1) is None and kth_largest(df, "v", 0) is None


def test_importance_weights_by_hand(spark):
    docs = spark.createDataFrame([(1, "good words here"), (2, "good words there"), (3, "*** bad bad bad"), (4, None), (5, "bad ***")], "doc_id bigint, text string")
    labels = spark.createDataFrame([(1, 1), (2, 1), (3, 0)], "doc_id bigint, quality int")
    texts = {r.doc_id: r.text or "" for r in docs.collect()}

    def grams(i):
        found, first = importance.buckets(pa.array([texts[i]]))
        w = brute.WORD.findall(texts[i])
        assert len(found) == first[-1] == max(0, 2 * len(w) - 1)
        return found.tolist()

    raw = np.bincount([g for i in texts for g in grams(i)], minlength=importance.BUCKETS)
    good = np.bincount([g for i in (1, 2) for g in grams(i)], minlength=importance.BUCKETS)
    ratio = np.log((good + 1) / (good.sum() + importance.BUCKETS)) - np.log((raw + 1) / (raw.sum() + importance.BUCKETS))
    rows = {r.doc_id: r for r in importance.report(docs, labels).collect()}
    for i in texts:
        assert rows[i].log_weight == pytest.approx(sum(ratio[g] for g in grams(i)), abs=1e-5)
    k = round(5 * (2 / 3 + importance.MARGIN))
    best = sorted(rows, key=lambda i: -rows[i].key)[:k]
    assert {i for i in rows if rows[i].kept} == set(best)


def test_importance_of_odd_rows(odd, empty, labels):
    found, name = importance.sampled(odd, labels)
    assert found.count() == odd.count() and importance.kept_rows(odd, labels).columns == odd.columns
    # the three equal rows stand or fall together
    assert found.where("doc_id = 6").select(f"{name}.kept").distinct().count() == 1
    assert importance.report(empty, labels).count() == 0
    assert importance.report(odd, labels.limit(0)).where("kept").count() == odd.count()


def test_importance_keeps_clean_documents(spark, documents, small):
    labels = spark.read.parquet(f"{small}/labels.parquet")
    judged = importance.report(documents, labels).join(labels, "doc_id")
    assert judged.where("quality = 1 and not kept").count() == 0
    assert judged.where("quality = 0 and not kept").count() >= 0.6 * judged.where("quality = 0").count()


NAMES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def test_statistics(spark, documents, odd, empty):
    for docs in (documents, odd, spark.createDataFrame([(1, "a b c d e f g h " * 3 + "x"), (2, "#<>| a\n#<>| a\n \n "), (3, " a b c d e f g h b c d e f g h b")], "doc_id bigint, text string")):
        texts = sorted(brute.statistics(r.text) for r in docs.collect())
        assert sorted(tuple(r) for r in decision_lists.statistics(docs).select(*NAMES).collect()) == texts
    assert decision_lists.statistics(empty).count() == 0


def test_no_python_in_the_plan(documents):
    plan = decision_lists.statistics(documents)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_learned_rules(spark):
    rows = [(i, "plain words of a text " * 5 + f"number {i} " + ("*** $$ " * 12 if i % 4 == 0 else "")) for i in range(400)]
    texts = [(i, " ".join(f"{w}{k}" for k, w in enumerate(t.split()))) for i, t in rows]
    docs = spark.createDataFrame(texts, "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, int(i % 4 != 0)) for i in range(0, 400, 2)], "doc_id bigint, quality int")
    found = decision_lists.judged(docs, labels)
    assert {r.doc_id for r in found.where("not kept").collect()} == {i for i in range(400) if i % 4 == 0}
    assert found.where("base_failed").count() == 0


def covering(rows, cuts):
    """Sequential covering row by row: ``rows`` are (features, bad, grows)."""
    fires = lambda x, rule: all(x[f] >= t if op == ">=" else x[f] < t for f, op, t in rule)
    counts = lambda found: (sum(bad for _, bad, _ in found), sum(not bad for _, bad, _ in found))
    rules = []
    while len(rules) < decision_lists.MOST_RULES:
        rule = []
        while len(rule) < decision_lists.MOST_TESTS:
            inside = [r for r in rows if r[2] and fires(r[0], rule)]
            p0, n0 = counts(inside)
            if not p0 or not n0:
                break
            best, most = None, 0.0
            for test in ((f, op, t) for f, ts in cuts.items() for t in ts for op in (">=", "<")):
                p, n = counts([r for r in inside if fires(r[0], [test])])
                gain = p * (math.log2(p / (p + n)) - math.log2(p0 / (p0 + n0))) if p else 0.0
                if gain > most + 1e-9:
                    best, most = test, gain
            if best is None:
                break
            rule.append(best)
        if not rule:
            break
        prefixes = []
        for k in range(1, len(rule) + 1):
            hit = [r for r in rows if fires(r[0], rule[:k])]
            (p, n), (u, v) = counts(hit), counts([r for r in hit if not r[2]])
            prefixes.append(((u - v) / (u + v) if u + v else -1.0, p, -k, min(p / max(1, p + n), u / (u + v) if u + v else 1.0)))
        _, p, k, precision = max(prefixes)
        if precision < decision_lists.LEAST_PRECISION or p < decision_lists.LEAST_COVER:
            break
        rules.append(rule[:-k])
        rows = [r for r in rows if not fires(r[0], rules[-1])]
    return rules


@pytest.mark.parametrize("seed, noise", [(1, 0.0), (2, 0.01), (3, 0.3)])
def test_rules_equal_brute_force(spark, seed, noise):
    rng = random.Random(seed)
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_distinct_words", "n_upper", "n_marks"]
    rows, table = [], []
    for i in range(500):
        words, lines = rng.randint(20, 200), rng.randint(1, 12)
        chars = words * rng.randint(3, 7)
        values = [words, chars, rng.randint(0, words), rng.randint(0, lines - 1), rng.randint(0, words // 4), lines, rng.randint(words // 2, words), rng.randint(0, chars // 2), rng.randint(0, words // 3)]
        x = dict(zip(["words", "word_length", "symbols_per_word", "dup_line_share", "repeat_share", "distinct_share", "upper_share", "marks_per_word", "words_per_line"],
                     [float(words), chars / words, values[2] / words, values[3] / lines, values[4] / words, values[6] / words, values[7] / chars, values[8] / words, words / lines]))
        bad = ((x["upper_share"] >= 0.3 and words < 110) or x["marks_per_word"] >= 0.28) != (rng.random() < noise)
        digest = xxhash.xxh64(struct.pack("<q", i), seed=42).intdigest()
        rows.append((x, bad, (digest - (1 << 64) if digest >> 63 else digest) % 3 > 0))
        table.append((i, *values, bad))
    labelled = spark.createDataFrame(table, ", ".join(["doc_id bigint", *(f"{n} bigint" for n in names), "bad boolean"]))
    cuts = dict(zip(decision_lists.features(), decision_lists._thresholds(labelled)))
    assert all(set(ts) <= {x[f] for x, _, _ in rows} and 1 < len(ts) <= 62 for f, ts in cuts.items())
    found = decision_lists.learn(labelled)
    assert found == covering(rows, cuts)
    assert noise or len(found) >= 2


def test_verdicts_lead_the_columns(odd, labels):
    assert decision_lists.judged(odd, labels).columns[:8] == ["doc_id", *NAMES, "base_failed", "kept"]


def test_decision_list_of_odd_rows(odd, empty, labels):
    found = decision_lists.judged(odd, labels)
    assert found.count() == odd.count()
    assert found.where("base_failed != (n_words < 20 or 100 * n_repeat_words > 30 * n_words)").count() == 0
    assert decision_lists.judged(odd, labels.limit(0)).where("kept = base_failed").count() == 0
    assert decision_lists.judged(empty, labels).count() == 0


def test_decision_list_keeps_clean_documents(spark, documents, small):
    labels = spark.read.parquet(f"{small}/labels.parquet")
    judged = decision_lists.judged(documents, labels).where("not base_failed").join(labels, "doc_id")
    assert judged.where("quality = 1 and not kept").count() == 0


def test_presence_kernel_by_hand():
    texts = ["abcab", "abc", "xyz zyx", "ab", "a", ""]
    found = language.presence(pa.array(texts))
    spectrum = [{t.encode()[i:i + n] for n in language.LENGTHS for i in range(len(t.encode()) - n + 1)} for t in texts]
    assert [len(f) for f in found] == [len(s) for s in spectrum]
    for i, a in enumerate(found):
        for j, b in enumerate(found):
            assert len(np.intersect1d(a, b)) == len(spectrum[i] & spectrum[j])
    model = language.fit(found[:4], ["x", "x", "y", "x"], landmarks=4)
    scores = model.scores(found)
    # brute force: kernel ridge regression in the landmarks' feature space, term by term
    marks = [0, 1, 2]
    order = [i for name in ("x", "y") for i, n in enumerate(["x", "x", "y", "x"]) if n == name][:2] + [2]
    kernel = lambda p, q: len(spectrum[p] & spectrum[q]) / np.sqrt(max(1, len(spectrum[p])) * max(1, len(spectrum[q])))
    inner = np.array([[kernel(i, j) for j in order] for i in order])
    values, vectors = np.linalg.eigh(inner)
    kept = values > 1e-6 * values.max()
    lift = vectors[:, kept] / np.sqrt(values[kept])
    phi = lambda rows: np.hstack([np.array([[kernel(i, j) for j in order] for i in rows]) @ lift, np.ones((len(rows), 1))])
    x, y = phi(range(4)), np.array([[1, -1], [1, -1], [-1, 1], [1, -1]], float)
    weights = np.linalg.solve(x.T @ x + language.RIDGE * 4 / 100 * np.eye(x.shape[1]), x.T @ y)
    assert np.allclose(scores, phi(range(6)) @ weights, atol=1e-3) and marks


def test_language_held_out(documents):
    found = language.languages(documents).join(documents.select("doc_id", "lang"), "doc_id").where("held_out")
    assert found.where("lang = lang_pred").count() >= 0.9 * found.count()
    assert found.where("score < 0 or score > 1 or score is null").count() == 0


def test_language_of_odd_rows(odd, empty):
    rows = language.languages(odd).collect()
    assert len(rows) == odd.count()
    assert {r.lang_pred for r in rows if r.doc_id in (0, 1, 2)} == {"und"}
    assert language.languages(empty).count() == 0
    assert {r.lang_pred for r in language.languages(odd.withColumn("lang", F.lit(None).cast("string"))).collect()} == {"und"}


def test_nearest_is_exact():
    rng = np.random.default_rng(3)

    def vector():
        terms = np.unique(rng.integers(0, 40, rng.integers(1, 8)))
        w = rng.random(len(terms)) + 0.1
        return terms, w / np.sqrt((w**2).sum())

    docs = [vector() for _ in range(700)]
    index = toxicity.BlockMaxIndex(docs, 40)
    dense = np.zeros((700, 40))
    for i, (t, w) in enumerate(docs):
        dense[i, t] = w
    for _ in range(60):
        t, w = vector()
        cosines = dense[:, t] @ w
        best = sorted(((round(c, 9), -i) for i, c in enumerate(cosines) if c > 0), reverse=True)[:15]
        found = index.nearest(t, w, 15)
        assert [round(c, 9) for c, _ in found] == [c for c, _ in best]
        assert [i for _, i in found] == [-i for _, i in best]


def test_toxic_documents_are_found(spark):
    plain = "the of a to in on for with by from this that was is are be it as and"
    rng = np.random.default_rng(4)
    rows = [(i, " ".join(rng.choice(plain.split(), 60)) + (" you Foul " + ("swine" if i % 2 else "rotter") + "!" if i % 5 == 0 else "")) for i in range(600)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, int(i % 5 == 0)) for i in range(600)], "doc_id bigint, toxic int")
    found = toxicity.toxicity(docs, labels).where("held_out").collect()
    assert all(r.predicted == int(r.doc_id % 5 == 0) for r in found)
    assert all(r.evidence for r in found if r.predicted)


def test_toxic_text_without_telling_words_has_its_twin_as_evidence(spark):
    rng = np.random.default_rng(6)
    plain = [f"w{chr(97 + i // 26)}{chr(97 + i % 26)}" for i in range(300)]
    rows = [(i, " ".join(rng.choice(plain, 40)), int(i % 10 == 0)) for i in range(400)]
    held = {r.doc_id for r in spark.createDataFrame([(i,) for i in range(2000)], "doc_id bigint").where(toxicity.held_out()).collect()}
    learned = [i for i in range(400) if i % 10 == 0 and i not in held and toxicity.hash_of(i) % 3]
    twins = dict(zip([i for i in range(1000, 2000) if i in held], learned))
    texts = {i: t for i, t, _ in rows}
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows] + [(i, texts[j].upper()) for i, j in twins.items()], "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id bigint, toxic int")
    found = {r.doc_id: r for r in toxicity.toxicity(docs, labels).collect()}
    assert len(twins) > 10 and all(found[i].evidence[0] == j for i, j in twins.items())
    clean = [found[i].score for i, _, y in rows if i in held and not y]
    assert min(found[i].score for i in twins) > np.mean(clean)


def test_toxic_documents_outrank_clean_ones_on_a_small_table(spark, small, documents):
    labels = spark.read.parquet(f"{small}/labels.parquet")
    rows = toxicity.toxicity(documents, labels).where("held_out").join(labels.select("doc_id", "toxic"), "doc_id").collect()
    toxic, clean = ([r.score for r in rows if r.toxic == y] for y in (1, 0))
    assert toxic and clean and np.mean(toxic) > np.mean(clean)
    assert all(r.evidence for r in rows)


def test_toxicity_of_odd_rows(odd, empty, labels):
    rows = toxicity.toxicity(odd, labels).collect()
    assert len(rows) == odd.count() and all(0 <= r.score <= 1 for r in rows)
    assert toxicity.toxicity(empty, labels).count() == 0
    assert {r.score for r in toxicity.toxicity(odd, labels.limit(0)).collect()} == {0.0}
