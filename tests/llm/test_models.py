import itertools
import random
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from panelkit.llm import language_mixture as lm
from panelkit.llm import ordinal_quality as oq

SF = "/root/testdata/sf0.01"


def test_held_out_documents_get_their_language(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = lm.learn_and_predict(docs).join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert len(got) == docs.count()
    out = [r for r in got if r["held_out"]]
    assert out and np.mean([r["lang"] == r["lang_pred"] for r in out]) > 0.98
    for r in got:
        assert 0 <= r["score"] <= 1
        assert abs(sum(r["shares"]) - 1) < 1e-6 and r["shares"] == sorted(r["shares"], reverse=True)


def test_mixtures_are_taken_apart(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = docs.withColumn("held_out", lm.held_out())
    model = lm.fit(lm.count_grams(rows.filter("not held_out")))
    texts = {}
    for r in rows.filter("held_out and length(text) > 1500").select("lang", "text").collect():
        texts.setdefault(r["lang"], r["text"])
    for a, b, cut in (("en", "fr", 500), ("de", "es", 300), ("fr", "de", 700)):
        langs, shares = model.mixture(texts[a][:1000] + " " + texts[b][:cut])
        assert set(langs) == {a, b} and langs[0] == a
        assert abs(shares[0] - 1000 / (1000 + cut)) < 0.12
    # a text in one language, but for a name or a licence line
    assert all(model.mixture(t)[1][0] > 0.9 for t in texts.values())


def test_em_finds_the_best_proportions():
    """On a grid of proportions none is likelier."""
    rng = np.random.default_rng(0)
    prob = rng.dirichlet(np.ones(40), 2)
    n = rng.integers(1, 9, 40).astype(float)
    share, likely = lm.Model._fit(prob, n, np.array([0.5, 0.5]), -np.inf)
    grid = [n @ np.log(p * prob[0] + (1 - p) * prob[1]) for p in np.linspace(0.001, 0.999, 999)]
    assert likely >= max(grid) - 0.01
    assert abs(share.sum() - 1) < 1e-9


def test_language_edges(spark, documents):
    rows = [
        (1, "the cat and the dog", "en", "s"), (3, "le chat et le chien", "fr", "s"), (4, None, "en", "s"), (5, "", None, "s"),
        (6, "123 !?", "fr", "s"), (7, "é", None, "s"), (None, "the cat", "en", "s"), (7, "the " * 30_000, None, "s"),
    ]
    docs = documents(rows).withColumn("lang_pred", F.lit("zz")).withColumn("n", F.lit(1))
    got = lm.learn_and_predict(docs).collect()
    assert [r["doc_id"] for r in got] == [r[0] for r in rows]
    assert [r["lang_pred"] for r in got][2:5] == ["und"] * 3
    assert [r["score"] for r in got][2:5] == [0.0] * 3
    assert all(r["lang_pred"] in ("en", "fr") for r in (got[0], got[1], got[5], got[6], got[7]))
    nothing = lm.learn_and_predict(docs.withColumn("lang", F.lit(None).cast("string"))).collect()
    assert {r["lang_pred"] for r in nothing} == {"und"}
    assert lm.learn_and_predict(docs.limit(0)).count() == 0


def test_language_of_a_document_is_no_input(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = lm.fit(lm.count_grams(docs.filter(~lm.held_out())))
    lied = docs.select("doc_id", "text", F.lit("xx").alias("lang"), F.lit("yy").alias("source"))
    a, b = (sorted(lm.predict(d, model).collect(), key=lambda r: r["doc_id"]) for d in (docs, lied))
    assert a == b


def test_grades_of_documents_not_learned_from(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet").select("doc_id", oq.grade_of().alias("grade"))
    learned = labels.filter("doc_id % 4 != 1")
    model = oq.fit(docs, learned)
    got = oq.predict(docs, model).join(labels.filter("doc_id % 4 = 1"), "doc_id").collect()
    right = np.mean([r["kept"] == (r["grade"] == 2) for r in got])
    assert right > 0.85
    means = [np.mean([r["expected_grade"] for r in got if r["grade"] == g]) for g in range(3)]
    assert means[0] < means[1] < means[2]


def test_thresholds_are_ordered_and_fit():
    rng = random.Random(1)
    rows, grade = [], []
    for _ in range(900):
        g = rng.randrange(3)
        words = [f"common{rng.randrange(50)}" for _ in range(20)] + [f"mark{g}"] * (rng.random() < 0.9)
        rows.append(oq.features(" ".join(words)))
        grade.append(g)
    model = oq.fit_rows(rows, np.array(grade), 3, least_docs=1)
    assert model.thresholds[0] < model.thresholds[1]
    assert np.mean([int((model.tails(r) > 0.5).sum()) == g for r, g in zip(rows, grade, strict=True)]) > 0.85


def test_grades_come_out_in_order():
    """Texts of a higher grade come out higher, and a flaw more costs more."""
    rows = [oq.features(t) for t in ("bad awful", "bad", "fair", "fair good", "good", "good fine")]
    model = oq.fit_rows(rows, np.array([0, 0, 1, 1, 2, 2]), 3, least_docs=1)
    expected = [model.tails(r).sum() for r in rows]
    assert max(expected[:2]) < min(expected[2:4]) < max(expected[2:4]) < min(expected[4:])


def test_grade_edges(spark, documents):
    docs = documents([(1, "fine text here"), (2, None), (2, None), (None, ""), (3, "word " * 30_000), (4, "bad *** text")])
    docs = docs.withColumn("grade", F.lit("x")).withColumn("kept", F.lit("y"))
    labels = spark.createDataFrame([(1, 2), (4, 0), (9, 1), (None, 1), (2, None)], "doc_id bigint, grade int")
    got = oq.predict(docs, oq.fit(docs, labels)).collect()
    assert len(got) == 6
    assert all(0 <= r["p_good"] <= 1 and 0 <= r["expected_grade"] <= 2 for r in got)
    assert got[1] == got[2] and got[1]["p_good"] == got[3]["p_good"]
    none = oq.fit(docs, labels.limit(0))
    assert {round(r["expected_grade"], 9) for r in oq.predict(docs, none).collect()} == {1.0}
    assert oq.predict(docs.limit(0), none).count() == 0


def test_fit_as_by_plain_descent():
    """The same likelihood with the same prior, by the slope of its plain formula in small steps."""
    rng = random.Random(11)
    texts, grade = [], []
    for _ in range(120):
        g = rng.randrange(3)
        texts.append(" ".join(rng.choice(["aa", "bb", "cc"][: g + 1] + ["dd"]) for _ in range(3)))
        grade.append(g)
    found = [oq.features(t) for t in texts]
    columns = sorted({int(f) for row in found for f in row})
    x = np.array([[c in row for c in columns] for row in (set(r.tolist()) for r in found)], float)
    y, n, m = np.array(grade), len(grade), len(columns)

    def loss(v):
        cuts = np.array([v[m], v[m] + np.exp(v[m + 1])])
        tail = 1 / (1 + np.exp(cuts[None, :] - (x @ v[:m])[:, None]))  # P(grade > k)
        chance = np.c_[1 - tail[:, 0], tail[:, 0] - tail[:, 1], tail[:, 1]][np.arange(n), y]
        return -np.log(chance).mean() + 0.5 * oq.PRIOR / n * (v[:m] @ v[:m])

    v = np.zeros(m + 2)
    for _ in range(3000):
        slope = np.array([(loss(v + 1e-5 * e) - loss(v - 1e-5 * e)) / 2e-5 for e in np.eye(m + 2)])
        v -= 0.5 * slope
        if np.abs(slope).max() < 1e-6:
            break
    model = oq.fit_rows(found, y, 3, least_docs=1)
    assert np.allclose(model.thresholds, [v[m], v[m] + np.exp(v[m + 1])], atol=2e-2)
    tails = 1 / (1 + np.exp(np.array([v[m], v[m] + np.exp(v[m + 1])])[None, :] - (x @ v[:m])[:, None]))
    assert np.allclose([model.tails(f) for f in found], tails, atol=1e-2)


def test_a_repeated_id_is_one_row_of_the_sample(spark, documents, monkeypatch):
    """However many rows share an id, the fit gets one for each id of the sample, whatever the order of the rows."""
    rows = [(i % 5, f"text {k} of {i % 5} word{k % 7}") for k, i in enumerate(range(3000))]
    labels = spark.createDataFrame([(i, i % 3) for i in range(5)] + [(1, 0), (1, 2)], "doc_id bigint, grade int")
    assert oq.sample_ids(labels).count() == 5
    models = [oq.fit(documents(part).repartition(k), labels) for k, part in ((1, rows), (7, rows[::-1]))]
    assert np.array_equal(models[0].weights, models[1].weights)
    assert np.array_equal(models[0].thresholds, models[1].thresholds)
    first = documents(rows).groupBy("doc_id").agg(F.min_by("text", F.xxhash64("text")).alias("text"))
    one = [r["text"] for r in first.orderBy("doc_id").collect()]
    want = oq.fit_rows([oq.features(t) for t in one], np.array([0, 0, 2, 0, 1]), 3)
    assert np.allclose(models[0].thresholds, want.thresholds)


def test_counts_as_one_by_one(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").filter("doc_id % 3 = 0")
    want = Counter()
    for r in docs.collect():
        if r["text"] is not None and r["lang"] is not None:
            want.update((r["lang"], int(b)) for b in lm.grams(r["text"]))
    got = {(r["lang"], r["bucket"]): r["n"] for r in lm.count_grams(docs.repartition(5)).collect()}
    assert got == want


def test_language_sets_as_by_all_sets(spark):
    """Every set of languages with its best proportions: none has a higher likelihood less its penalty than the chosen."""
    docs = spark.read.parquet(f"{SF}/documents.parquet").withColumn("held_out", lm.held_out())
    model = lm.fit(lm.count_grams(docs.filter("not held_out")))
    by_lang = {}
    for r in docs.filter("held_out and length(text) > 1200").select("lang", "text").collect():
        by_lang.setdefault(r["lang"], []).append(r["text"])
    rng = random.Random(4)
    texts = [" ".join(rng.choice(by_lang[x])[: rng.choice([80, 300, 900])] for x in rng.sample(sorted(by_lang), k)) for k in (1, 2, 3, 4) for _ in range(8)]
    for text in texts:
        bucket, n = np.unique(lm.grams(text), return_counts=True)
        cost = lm.PENALTY * 0.5 * np.log(n.sum())
        best = {}
        for k in range(1, len(model.langs) + 1):
            for some in itertools.combinations(range(len(model.langs)), k):
                prob, share = model.prob[list(some)][:, bucket], np.full(k, 1 / k)
                for _ in range(300):
                    share = share * ((prob / (share @ prob)) @ n) / n.sum()
                best[some] = float(n @ np.log(share @ prob)) - cost * k
        chosen = tuple(sorted(model.langs.index(x) for x in model.mixture(text)[0]))
        assert best[chosen] >= max(best.values()) - 0.5, (chosen, max(best, key=best.get))
