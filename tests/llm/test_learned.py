"""Quality, toxicity and language: held-out accuracy, parts, and odd documents."""

from __future__ import annotations

import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from lakeops.llm import language, learning, quality, toxicity
from lakeops.llm.common import bounded_sample, fold
from lakeops.llm.queries import QUERIES

SF_DIR = "/root/testdata/sf0.01"


@pytest.mark.parametrize("name, label, least", [("op7_quality", "quality", 0.95), ("op8_toxicity", "toxic", 0.9)])
def test_held_out_accuracy(spark, name, label, least):
    got = QUERIES[name](spark, SF_DIR)
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet")
    both = got.join(labels, "doc_id").filter("held_out")
    assert both.count() > 40
    assert both.agg(F.avg((F.col("predicted") == F.col(label)).cast("int"))).first()[0] >= least
    assert got.filter("score < 0 or score > 1 or score is null").count() == 0


def test_held_out_languages(spark):
    got = QUERIES["op9_language"](spark, SF_DIR)
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "lang")
    both = got.join(docs, "doc_id").filter("held_out")
    assert both.agg(F.avg((F.col("lang_pred") == F.col("lang")).cast("int"))).first()[0] > 0.97


def test_odd_documents(spark, odd_docs, no_docs, no_labels):
    labels = spark.createDataFrame(
        [(i, i % 2, int(i > 4)) for i in range(10)] + [(None, 1, 1), (3, None, None), (3, 1, 0)],
        "doc_id long, quality int, toxic int",
    )
    for docs in (odd_docs, no_docs):
        for marks in (labels, no_labels):
            for module, score in ((quality, quality.quality_score), (toxicity, toxicity.toxicity_score)):
                model = module.learn(docs, marks, F.lit(True))
                got = [r.s for r in docs.select(score(model, F.col("text")).alias("s")).collect()]
                assert len(got) == docs.count() and all(0 <= s <= 1 for s in got)
        model = language.learn(docs, F.lit(True))
        got = {r.id: r for r in language.identify(docs, model).collect()}
        assert len(got) == docs.select("doc_id").distinct().count()
        if got:
            assert got[0].lang_pred == got[2].lang_pred == got[9].lang_pred == "und" and got[9].score == 0
            assert got[3].lang_pred in ("en", "fr") and got[51].lang_pred == "und"


def test_dictionaries_tell_texts_apart(spark):
    rng = random.Random(2)
    good, bad = [[f"{c}{i}{i * 7 % 13}" for i in range(60)] for c in "gb"]
    rows = [(i, " ".join(rng.choice((bad, good)[i % 2]) for _ in range(rng.randint(5, 200))), i % 2) for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, quality int")
    model = quality.learn(docs, docs, F.col("id") < 200)
    scores = docs.filter("doc_id >= 200").select("quality", quality.quality_score(model, F.col("text")).alias("s"))
    assert scores.filter((F.col("s") > 0.5) == (F.col("quality") == 1)).count() >= 97
    assert 0 < model.score("") < 1


def test_grammar():
    model = toxicity.Toxicity({"idiot$": 4.0, "scum": 3.0}, [1.0, 1.0, -2.0], 0.1)

    def weights(text):
        return [w for _, _, w in model.matches(text)]

    assert weights("an idiot and idiots") == [4.0]
    assert weights("scummy") == [3.0]  # a stem
    assert weights("he is not an idiot") == [3.0]  # weaker after "not", stronger after a target
    assert weights("he said idiot") == [3.0]
    assert weights("not a very long way from an idiot") == [4.0]
    assert weights("said this. idiot") == [4.0]  # clauses end the scope
    assert weights("kill the lights") == [] and weights("I will kill you, kill") == [4.5]
    assert model.score("nothing here") < 0.3 < model.score("idiot scum")
    assert toxicity.Toxicity({}, [], 0.25).score("idiot") == 0.25


def test_composition_is_the_product():
    parts = [toxicity.window(toxicity.NEGATES, 2, 0.5), toxicity.in_clause(toxicity.REPORTS, 0.3), toxicity.threat()]
    both = toxicity.composed(parts)
    rng = random.Random(1)
    states, state = [0, 0, 0], 0
    for _ in range(500):
        x = rng.randrange(7)
        states = [p.step[s][x] for p, s in zip(parts, states)]
        state = both.step[state][x]
        assert both.factor[state] == pytest.approx(np.prod([p.factor[s] for p, s in zip(parts, states)]))
        assert both.final[state] == pytest.approx(np.prod([p.final[s] for p, s in zip(parts, states)]))
        assert both.accepts[state] == frozenset().union(*(p.accepts[s] for p, s in zip(parts, states)))


def test_words_bend_a_clause_from_both_sides():
    model = toxicity.Toxicity({"idiot$": 4.0}, [1.0, 1.0, -2.0], 0.1)

    def weights(text):
        return [w for _, _, w in model.matches(text)]

    assert weights("I will kill you") == weights("kill you") == weights("you, I will kill") == [4.5]
    assert weights("they never kill") == [2.25] and weights("kill time. you") == []
    assert weights("you idiot") == weights("idiot, you") == [6.0]
    assert weights("you idiot, she said") == weights("she said you idiot") == [3.0]
    for apostrophe in "'’":
        assert weights(f"aren{apostrophe}t an idiot") == [2.0]
    assert weights("l'idiot") == weights("an idiot's") == [4.0]


def test_matches_equal_a_plain_reading():
    """Scores of random texts, worked out clause by clause without a machine."""
    model = toxicity.Toxicity({"idiot$": 4.0, "scum": 3.0}, [1.0, 0.5, -2.0], 0.1)
    rng = random.Random(8)
    vocabulary = ["idiot", "scummy", "kill", "beat", "you", "said", "not", "the", "a", "house", ".", "!", "didn't"]

    def plain(text):
        kinds = {}
        for clause in re.split(r"[.!?;:\n]", text):
            words = clause.replace("n't", " n't").split()
            insults = {"idiot": 4.0, "scummy": 3.0}
            near = lambda i: 0.5 if {"not", "n't"} & set(words[max(0, i - 3) : i]) else 1.0
            whole = (1.5 if "you" in words else 1.0) * (0.5 if "said" in words else 1.0)
            found = {}
            for i, w in enumerate(words):
                if w in insults:
                    found[w] = max(found.get(w, 0.0), insults[w] * near(i) * whole)
            threats = [(3.0 * near(i) * whole, -i, w) for i, w in enumerate(words) if w in ("kill", "beat")]
            if threats and "you" in words:
                found[max(threats)[2]] = max(threats)[0]
            if found:
                key = frozenset(found)
                kinds[key] = max(kinds.get(key, 0.0), sum(found.values()))
        return np.log1p([max(kinds.values(), default=0.0), sum(kinds.values())])

    for _ in range(500):
        text = " ".join(rng.choice(vocabulary) for _ in range(rng.randint(0, 40)))
        assert model.features(text) == pytest.approx(plain(text).tolist())


def test_a_long_text_is_read_whole(spark):
    """20 MB in one text: the insult at its end counts, for the score and for the language."""
    text = "a plain sentence about the weather.\n" * 560_000 + "you idiot"
    model = toxicity.Toxicity({"idiot$": 4.0}, [1.0, 1.0, -2.0], 0.1)
    assert len(text) > 20_000_000
    docs = spark.createDataFrame([(1, text), (2, text[:-9])], "doc_id long, text string")
    got = docs.select("doc_id", toxicity.toxicity_score(model, F.col("text")).alias("s")).collect()
    assert {r.doc_id: r.s > 0.5 for r in got} == {1: True, 2: False}


def test_mixtures_are_found():
    p = np.r_[np.tile([0.9, 0.05, 0.05], (70, 1)), np.tile([0.05, 0.9, 0.05], (30, 1)), [[1 / 3] * 3]]
    shares = language.mixture(p, np.array([100, 1]))
    assert shares[0] == pytest.approx([0.7, 0.3, 0.0], abs=0.05) and shares[0, 2] == 0
    assert (shares[1] > 0).sum() == 1 and shares.sum(axis=1) == pytest.approx([1, 1])


def test_counts_stand_for_repeated_words():
    rng = np.random.default_rng(4)
    p, times = rng.dirichlet([1, 1, 1], 40), rng.integers(1, 6, 40)
    once = language.mixture(p, np.array([25, 15]), times.astype(float))
    each = language.mixture(np.repeat(p, times, axis=0), np.array([times[:25].sum(), times[25:].sum()]))
    assert once == pytest.approx(each)


def test_scores_equal_a_plain_estimation(spark):
    """The mixture of whole documents once more, word by word, and with many more steps."""
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text", "lang")
    model = language.learn(docs, fold("id", 3) != 1)
    got = {r.id: r for r in language.identify(docs, model).collect()}

    def plain(text, steps):
        words = [w for w in re.findall(r"[^\W\d_]+", text.lower()) if any(c.isalpha() for c in w)]
        rows = np.array([np.sum([model.table[model.grams.get(g, -1)] for g in language.ngrams(w)], axis=0) for w in words])
        rows = np.exp(np.maximum(rows - rows.max(axis=1, keepdims=True), -60.0))

        def fit(share, steps):
            for _ in range(steps):
                share = np.mean([r * share / (r @ share) for r in rows], axis=0)
            return share, sum(np.log(r @ share) for r in rows)

        m = rows.shape[1]
        price = language.PENALTY + 0.5 * np.log(len(words))
        share, value = fit(np.full(m, 1 / m), steps)
        value -= price * (share > 0).sum()
        while (share > 0).sum() > 1:
            fewer = share.copy()
            fewer[np.where(share > 0, share, np.inf).argmin()] = 0
            fewer = np.where(fewer > 0, fewer + 1e-6, 0)
            tried, worth = fit(fewer / fewer.sum(), max(1, steps // 3))
            worth -= price * ((share > 0).sum() - 1)
            if worth < value:
                break
            share, value = tried, worth
        return share

    texts = [(r.doc_id, r.text) for r in docs.filter("length(text) between 20 and 3000").orderBy(F.xxhash64("doc_id")).limit(40).collect()]
    for doc, text in texts:
        assert got[doc].score == pytest.approx(plain(text, language.STEPS).max(), abs=1e-6)
        assert model.names[plain(text, 5 * language.STEPS).argmax()] == got[doc].lang_pred


def test_a_long_text_is_one_mixture():
    names = ["en", "fr"]
    grams = {g: i for i, g in enumerate([" th", "the", "he ", " le", "le "])}
    table = np.log(np.array([[9, 1]] * 3 + [[1, 9]] * 2 + [[1, 1]]) / 30)
    model = language.Languages(names, grams, table)
    shares, some = model.mixtures(["the " * 5_000_000 + "le " * 1_000_000, "", "le"])
    assert some.tolist() == [True, False, True] and shares[0, 0] == pytest.approx(5 / 6, abs=0.02) and shares[2, 1] == 1


def test_one_language_is_not_split():
    rng = np.random.default_rng(1)
    p = rng.dirichlet([8, 2, 2], 200)
    p /= p.max(axis=1, keepdims=True)
    shares = language.mixture(p, np.array([200]))
    assert shares[0, 0] > 0.5


def test_logistic_matches_known_odds():
    rng = np.random.default_rng(3)
    x = rng.normal(size=(4000, 1))
    y = (rng.random(4000) < learning.sigmoid(2 * x[:, 0] - 1)).astype(float)
    w = learning.logistic(x, y)
    assert w == pytest.approx([2, -1], abs=0.2)


def test_samples_are_bounded_and_repeat(spark):
    df = spark.range(5000).selectExpr("id", "if(id % 10 = 0, 'b', 'a') as g")
    for n in (50, 1000):
        got = bounded_sample(df, "id", ["g"], n).groupBy("g").count().collect()
        assert {r.g: r["count"] for r in got} == {"a": min(n, 4500), "b": min(n, 500)}
    again = [{r.id for r in bounded_sample(df.repartition(k), "id", ["g"], 20).collect()} for k in (1, 4)]
    assert again[0] == again[1]


def test_copies_are_learned_from_once(spark):
    base = " ".join(f"w{i}" for i in range(50))
    rows = [(1, base, 0), (2, base + " more", 0), (3, "other text entirely here", 1), (4, "", 0), (5, "", 0)]
    kept = learning.without_copies(spark.createDataFrame(rows, "id long, text string, y int"))
    assert sorted(r.id for r in kept.collect()) == [1, 3, 4]


def test_fold(spark):
    import zlib

    got = spark.range(50).select("id", fold("id", 5).alias("f")).collect()
    assert all(r.f == zlib.crc32(str(r.id).encode()) % 5 for r in got)


def test_samples_send_few_rows_of_a_group(spark):
    """The hash limit stands below the exchange by group, also in the plan that ran."""
    rows = spark.range(50_000).select(F.col("id"), (F.col("id") % 2).alias("y"))
    chosen = bounded_sample(rows, "id", ["y"], 100)
    assert {r["count"] for r in chosen.groupBy("y").count().collect()} == {100}
    chosen.collect()
    plan = chosen._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    window = plan[plan.index("Window") :]
    assert window.index("Exchange") < window.index("BroadcastHashJoin")  # the join is below the exchange
