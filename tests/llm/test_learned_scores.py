"""Language and toxicity scores against the plain formulas; the quality stage against its query; odd rows of both."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from causeway.llm import bigru, language, quality, toxicity

SF = "/root/testdata/sf0.001"
SAMPLE = {"en": "the house that stands by the river with some more words about water and stone",
          "de": "das haus steht an dem fluss und hat noch einige worte über wasser und stein",
          "fr": "la maison qui se trouve près de la rivière avec des mots sur l'eau et la pierre"}


def made(n, seed):
    r = np.random.default_rng(seed)
    langs = [sorted(SAMPLE)[k] for k in r.integers(0, 3, n)]
    return [" ".join(r.choice(SAMPLE[k].split(), r.integers(1, 12))) for k in langs], langs


def test_language_scores_equal_the_dense_kernel():
    texts, langs = made(70, 1)
    new, _ = made(40, 2)
    model = language.fit_language(texts, langs, landmarks=9, ridge=0.05)
    present = language.Presence()
    bags = [set(present(t).tolist()) for t in texts + new]

    def k(a, b):
        return len(a & b) / np.sqrt(len(a) * len(b))
    names = sorted(set(langs))
    marks = [i for name in names for i in [j for j, x in enumerate(langs) if x == name][:9]]
    kernel = np.array([[k(a, bags[m]) for m in marks] for a in bags])
    values, vectors = np.linalg.eigh(kernel[marks])
    large = values > 1e-6 * values.max()
    z = kernel @ (vectors[:, large] / np.sqrt(values[large]))
    x, y = z[:70], np.array([[1.0 if a == name else -1.0 for name in names] for a in langs])
    w = np.array([1 / langs.count(a) for a in langs])
    # Weighted ridge with a free intercept, solved whole.
    left = np.block([[x.T @ (w[:, None] * x) + 0.05 * w.mean() * np.eye(x.shape[1]), (x.T @ w)[:, None]], [(w @ x)[None], np.array([[w.sum()]])]])
    beta = np.linalg.solve(left, np.vstack([x.T @ (w[:, None] * y), (w @ y)[None]]))
    want = z[70:] @ beta[:-1] + beta[-1]
    got = model.scores([present(t) for t in new])
    assert model.languages == names and np.allclose(got, want, atol=2e-3)
    assert (got.argmax(axis=1) == want.argmax(axis=1)).all()


def plain_score(model, words):
    """The network's probability for one window, word by word, without tables or batches."""
    p, h = {k: v.astype(np.float64) for k, v in model.p.items()}, bigru.HIDDEN

    def sig(v):
        return 1 / (1 + np.exp(-v))
    inputs = []
    for word in words:
        buckets, _ = bigru.word_ngrams([word])
        row = model.vocabulary.get(word, 0)
        inputs.append(np.concatenate([p["word"][row] * (row > 0), p["char"][buckets].mean(axis=0)]))
    both = []
    for part, own, seq in ((0, "wf", inputs), (1, "wb", inputs[::-1])):
        wx, bx = p["wx"][:, part * 3 * h:(part + 1) * 3 * h], p["bx"][part * 3 * h:(part + 1) * 3 * h]
        state, out = np.zeros(h), []
        for x in seq:
            g, r = x @ wx + bx, state @ p[own]
            z, reset = sig(g[:h] + r[:h]), sig(g[h:2 * h] + r[h:2 * h])
            c = np.tanh(g[2 * h:] + reset * r[2 * h:])
            state = (1 - z) * c + z * state
            out.append(state)
        both.append(out if part == 0 else out[::-1])
    hidden = np.array([np.concatenate(pair) for pair in zip(*both)])
    s = np.tanh(hidden @ p["a"] + p["ab"]) @ p["v"]
    share = np.exp(s - s.max()) / np.exp(s - s.max()).sum()
    return sig((share @ hidden) @ p["o"] + p["ob"][0])


def test_toxicity_scores_equal_the_plain_network():
    texts, langs = made(60, 3)
    model = toxicity.fit_toxicity(texts, [int(k == "de") for k in langs], rounds=1)
    new = [" ".join(made(12, s)[0]) for s in range(4)] + ["one", "", "...", None, "x" * 500]
    got = toxicity.scores_of(model, new)
    for text, score in zip(new, got):
        words, ids = toxicity.numbered([text])
        windows, _ = toxicity.windows_of(ids)
        want = max((plain_score(model, [words[i] for i in row if i != bigru.PAD]) for row in windows), default=0.0)
        assert score == pytest.approx(want, abs=2e-4)


def test_training_rows_do_not_depend_on_arrival(spark):
    rows = [(i % 5, f"text {i}", "en" if i % 5 else "de") for i in range(40)] + [(None, "x", "en"), (7, None, "de")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(5)] + [(1, 0), (None, 1)], "doc_id long, toxic int")
    every = F.lit(True)
    lang = [language.training_rows(docs.repartition(n, "text"), every) for n in (1, 7)]
    tox = [toxicity.training_rows(docs.repartition(n, "text"), labels, every) for n in (1, 7)]
    assert lang[0] == lang[1] and tox[0] == tox[1]
    assert sorted(t for t, _ in lang[0] if t != "x") == sorted(f"text {min((i for i in range(40) if i % 5 == k), key=lambda i: f'text {i}')}" for k in range(5))
    assert len(tox[0][0]) == 5
    assert language.training_rows(docs.limit(0), every) == [] and toxicity.training_rows(docs.limit(0), labels.limit(0), every) == ([], [])


def test_learned_operators_on_odd_tables(spark):
    docs = spark.createDataFrame([(None, None), (1, ""), (2, "42 !"), (2, "das haus"), (2, "das haus")], "doc_id long, text string")
    model = language.fit_language(*made(30, 5))
    found = [(r["doc_id"], r["lang_pred"]) for r in language.predict(docs, model).collect()]
    assert sorted(map(str, found)) == sorted(map(str, [(None, "und"), (1, "und"), (2, "und"), (2, "de"), (2, "de")]))
    assert language.predict(docs.limit(0), model).count() == 0
    net = toxicity.fit_toxicity(*[list(x) for x in zip(*[(t, int(k == "de")) for t, k in zip(*made(30, 5))])], rounds=1)
    scored = toxicity.score_texts(docs, net).collect()
    assert len(scored) == 5 and sorted(r["score"] > 0 for r in scored) == [False, False, True, True, True]
    assert toxicity.score_texts(docs.limit(0), net).count() == 0


def test_quality_stage_keeps_what_its_query_keeps(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").withColumn("f", F.lit("clash")).withColumn("_q_f", F.lit(1))
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    want = sorted(r["doc_id"] for r in quality.judge(docs, labels).filter("kept").collect())
    kept = quality.keep_good(docs, labels)
    assert kept.columns == docs.columns and sorted(r["doc_id"] for r in kept.collect()) == want
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "ArrowEvalPython" not in plan  # the counts are written with the rows
    assert not any("text" in line for line in plan.splitlines() if "Exchange" in line)
    assert quality.keep_good(docs.limit(0), labels).count() == 0
    twice = spark.createDataFrame([(None, "en", None), (1, None, ""), (1, "en", "word " * 200), (1, "en", "a b c " * 90)],
                                  "doc_id long, lang string, text string")
    assert quality.keep_good(twice, labels.limit(0)).count() == 0
