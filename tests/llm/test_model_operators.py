"""Token counts, near-duplicates, languages, toxicity, quality, token files and the pipeline."""

import itertools
import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer, models, pre_tokenizers

import corpus_pipeline
from causeway.llm import bags, bigru, byte_bpe, language, near_dup, quality, token_file, toxicity, unigram
from causeway.llm.common import table

SF = "/root/testdata/sf0.001"
ODD_TEXTS = [None, "", " ", "\n\n", "a", "  two  blanks ", "tab\there", "é漢🙂 x", "word " * 5000, "x" * 20_000, "▁▁ under", "a\n b\r\nc"]


@pytest.fixture(scope="module")
def docs(spark):
    return table(spark, SF, "documents")


@pytest.mark.parametrize("byte_fallback", [True, False])
def test_unigram_counts_equal_the_library(byte_fallback):
    whole = unigram.load_vocabulary(public_tokenizers.path("piece_bpe_32k.model"))
    vocabulary = unigram.UnigramVocabulary(whole.pieces, byte_fallback)
    pieces = [("<unk>", 0.0), *([(f"<0x{b:02X}>", 0.0) for b in range(256)] if byte_fallback else []), *whole.pieces]
    low = min(s for _, s in whole.pieces)
    pieces = [(p, low if i < len(pieces) - len(whole.pieces) else s) for i, (p, s) in enumerate(pieces)]
    t = Tokenizer(models.Unigram(pieces, 0, byte_fallback))
    t.pre_tokenizer = pre_tokenizers.Metaspace(prepend_scheme="always", split=True)
    counter, r = unigram.PieceCounter(vocabulary), random.Random(3)
    made = ["".join(r.choice("abc eé漢🙂tion \n") for _ in range(r.randint(1, 40))) for _ in range(300)]
    for text in [x for x in ODD_TEXTS if x and len(x) < 3000] + made:
        assert counter.text(text)[0] == len(t.encode(text, add_special_tokens=False).ids), repr(text)


def test_unigram_rows(spark):
    rows = [(i, t, 1) for i, t in enumerate(ODD_TEXTS)] + [(None, "x", 2)]
    got = unigram.count_tokens(spark.createDataFrame(rows, "doc_id long, text string, score int"),
                               unigram.load_vocabulary(public_tokenizers.path("piece_bpe_32k.model"))).collect()
    assert len(got) == len(rows) and [r["n_tokens"] for r in got if r["doc_id"] in (0, 1)] == [0, 0]


def naive_jaccard(a, b):
    return sum(1 / sum(max(a.get(j, 0) / a[i], b.get(j, 0) / b[i]) for j in a.keys() | b.keys()) for i in a.keys() & b.keys())


def as_bag(d):
    return np.array(sorted(d), np.uint64), np.array([d[k] for k in sorted(d)], np.uint32)


def test_probability_jaccard_and_its_estimate():
    r = random.Random(5)
    for _ in range(30):
        a = {r.randrange(60): r.choice([1, 1, 2, 5]) for _ in range(30)}
        b = {r.randrange(60): r.choice([1, 1, 3]) for _ in range(30)}
        exact = near_dup.probability_jaccard(*as_bag(a), *as_bag(b))
        assert exact == pytest.approx(naive_jaccard(a, b))
    hashed = [as_bag({int(near_dup.mix64(np.array([k], np.uint64))[0]): n for k, n in x.items()}) for x in (a, b)]
    sig = near_dup.signatures(np.concatenate([x[0] for x in hashed]), np.concatenate([x[1] for x in hashed]),
                              np.repeat([0, 1], [len(x[0]) for x in hashed]), 2, 4096)
    assert (sig[0] == sig[1]).mean() == pytest.approx(exact, abs=0.03)


def brute_classes(rows):
    lists = bags.word_lists([t for _, t in rows])
    made = [bags.shingle_bags(w, 5) for w in lists]
    label = list(range(len(rows)))
    for i, j in itertools.combinations(range(len(rows)), 2):
        if lists[i] and lists[j] and (lists[i] == lists[j] or near_dup.probability_jaccard(*made[i], *made[j]) >= 0.8):
            label = [label[i] if x == label[j] else x for x in label]
    groups = {}
    for k, x in enumerate(label):
        groups.setdefault(x, []).append(k)
    return {frozenset(g) for g in groups.values()}


@pytest.mark.parametrize("block", [near_dup.BLOCK_SHINGLES, 900, 300])
def test_near_duplicates_equal_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(near_dup, "BLOCK_SHINGLES", block)
    r = random.Random(9)
    rows = []
    for g in range(4):
        base = [f"g{g}w{r.randrange(400)}" for _ in range(120)]
        for c in range(14):
            w = list(base)
            for _ in range(r.choice([0, 0, 1, 2, 3, 4])):
                w[r.randrange(len(w))] = f"new{r.randrange(10**6)}"
            rows.append(" ".join(w))
    rows += [None, "", "!!", "one two", "one two", "One TWO", "alone " * 40]
    rows = list(enumerate(rows))
    got = near_dup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS class_id", "'k' AS key")).collect()
    groups = {}
    for x in got:
        groups.setdefault(x["class_id"], set()).add(x["doc_id"])
    assert {frozenset(g) for g in groups.values()} == brute_classes(rows)
    assert all(k == min(g) for k, g in groups.items()) and all(len(groups[x["class_id"]]) == x["class_rows"] for x in got)


@pytest.mark.parametrize("repeats", [False, True])
def test_block_labels_equal_all_pairs(repeats):
    r = random.Random(5)
    bases = [[f"b{b}w{i}" for i in range(60)] for b in range(4)]
    texts = []
    for _ in range(60):
        w = list(r.choice(bases))
        for _ in range(r.choice([0, 1, 1, 2, 3])):
            w[r.randrange(len(w))] = f"new{r.randrange(10**6)}"
        texts.append(w * r.choice([1, 2, 3]) if repeats else w)
    made = [near_dup.shorter(*bags.shingle_bags(w, 5)) for w in texts]
    for side in (np.full(60, 2), np.array([r.choice([0, 1, 2]) for _ in texts])):
        start = np.array([k - k % 2 if r.random() < 0.3 else k for k in range(60)])
        want = start.copy()
        for u, v in itertools.product(range(60), range(60)):
            if side[u] != 1 and side[v] > 0 and near_dup.probability_jaccard(*made[u], *made[v]) >= 0.8:
                want[want == want[v]] = want[u]
        got = near_dup.joined_labels(side, start, made, 0.8)
        assert {frozenset(np.flatnonzero(got == x)) for x in got} == {frozenset(np.flatnonzero(want == x)) for x in want}
        assert len(set(want)) < len(set(start))


def test_keep_one(spark):
    rows = [(1, "a b c d e f g"), (1, "a b c d e f g"), (2, "A b c d e f g"), (None, "x y z q r s"), (None, "x y z q r s"),
            (3, None), (3, None), (4, "solo words in a row here")]
    kept = near_dup.keep_one(spark.createDataFrame([(k, t, 1) for k, t in rows], "doc_id long, text string, node int"))
    assert kept.columns == ["doc_id", "text", "node"]
    assert Counter(r["doc_id"] for r in kept.collect()) == Counter([1, None, 3, 3, 4])
    assert near_dup.near_duplicates(kept.limit(0)).count() == 0


def test_languages(spark, docs):
    rows = language.training_rows(docs, docs["doc_id"] % 2 == 0)
    model = language.fit_language([r[0] for r in rows], [r[1] for r in rows])
    got = language.predict(docs.filter("doc_id % 2 = 1"), model, keep=["doc_id", "lang"]).collect()
    assert np.mean([r["lang"] == r["lang_pred"] for r in got]) > 0.9 and all(0 <= r["score"] <= 1 for r in got)
    odd = language.predict(spark.createDataFrame(list(enumerate(ODD_TEXTS)), "doc_id long, text string"), model).collect()
    assert [r["doc_id"] for r in odd if r["lang_pred"] == "und"] == [0, 1, 2, 3]
    assert language.predict(docs, language.fit_language([], [])).filter("lang_pred <> 'und'").count() == 0


def test_kernel_is_the_share_of_common_ngrams():
    present = language.Presence()
    a, b = present("abcab"), present("abd")
    assert len(a) == len({"a", "b", "c", "ab", "bc", "ca", "abc", "bca", "cab", "abca", "bcab"})
    assert len(np.intersect1d(a, b)) == len({"a", "b", "ab"})


def test_network_gradients():
    m = bigru.BiGru.fresh({"aa": 1, "bb": 2})
    m.p = {k: v.astype(np.float64) for k, v in m.p.items()}
    words, ids = ["aa", "bb", "ccc", "dddd"], np.array([[0, 1, 2, -1], [3, 0, 1, 2], [2, -1, -1, -1]])
    y, w = np.array([1.0, 0, 1]), np.array([1.0, 2, 1])

    def loss():
        p = m.forward(m.table(words), ids)
        return float(-((y * np.log(p) + (1 - y) * np.log(1 - p)) * w).sum() / w.sum())
    g = m.gradients(m.table(words), ids, y, w)
    for name, p in m.p.items():
        flat, i = p.reshape(-1), int(np.abs(g[name]).argmax())
        old = flat[i]
        flat[i] = old + 1e-4
        up = loss()
        flat[i] = old - 1e-4
        down = loss()
        flat[i] = old
        assert (up - down) / 2e-4 == pytest.approx(float(g[name].reshape(-1)[i]), abs=2e-5), name


def test_toxicity_finds_planted_words(spark):
    r = random.Random(1)
    plain = ["".join(r.choice("aeiou") + r.choice("bdgklm") for _ in range(r.randint(1, 3))) for _ in range(300)]

    def text(bad):
        w = [r.choice(plain) for _ in range(r.randint(5, 150))]
        if bad:
            w[r.randrange(len(w))] = "zxq" + r.choice(["ul", "ob", "im", "ad"])
        return " ".join(w)
    y = [i % 3 == 0 for i in range(400)]
    texts = [text(b) for b in y]
    model = toxicity.fit_toxicity(texts[:300], [int(b) for b in y[:300]])
    s = toxicity.scores_of(model, texts[300:])
    assert np.mean((s >= 0.7) == np.array(y[300:])) > 0.95
    df = spark.createDataFrame([(i, t, 0.5) for i, t in enumerate(ODD_TEXTS)], "doc_id long, text string, score double")
    got = {x["doc_id"]: x["score"] for x in toxicity.score_texts(df, model, keep=["doc_id"]).collect()}
    assert len(got) == len(ODD_TEXTS) and got[0] == got[1] == 0 and all(0 <= v <= 1 for v in got.values())
    assert toxicity.score_texts(df, None).filter("score <> 0").count() == 0


def test_windows_cover_every_word():
    for n in (1, 39, 40, 41, 60, 61, 1000):
        windows, owner = toxicity.windows_of([np.arange(n, dtype=np.int32), np.zeros(0, np.int32)])
        assert set(windows.ravel().tolist()) - {bigru.PAD} == set(range(n)) and set(owner) == {0}


@pytest.mark.parametrize("ids", [np.zeros(0, np.uint32), np.array([7], np.uint32), np.full(5000, 3, np.uint32),
                                 np.random.default_rng(0).integers(0, 50257, 9999).astype(np.uint32),
                                 (np.random.default_rng(1).zipf(1.4, 5000) % 2**31).astype(np.uint32),
                                 np.array([2**32 - 1, 0, 5], np.uint32)])
def test_blocks_round_trip(ids):
    starts, blocks = token_file.encode_ids(ids)
    assert (token_file.decode_ids(starts, blocks) == ids).all()
    for a, n in ((0, 1), (3, 1500), (len(ids) // 2, 10)):
        assert (token_file.read_range(starts, blocks, a, n) == ids[a:a + n]).all()


def test_byte_bpe_equals_the_library():
    coder = byte_bpe.ByteBpe(open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8").read())
    r = random.Random(2)
    made = ["".join(r.choice("ab Zé  \n\t.,'s1\x1c\x85 　́-<|endoftext|>") for _ in range(r.randint(0, 15))) for _ in range(4000)]
    texts = [t or "" for t in ODD_TEXTS] + made
    for t, data in zip(texts, coder.encode_many(texts)):
        assert np.frombuffer(data, "<u2").tolist() == coder.tokenizer.encode(t, add_special_tokens=False).ids, repr(t)


def token_rows(rows):
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    start, out = 0, []
    for k, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or "")):
        ids = t.encode(text or "", add_special_tokens=False).ids + [0]
        out.append((k, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def test_token_file(spark):
    rows = [(i * 3 % 12, t) for i, t in enumerate(ODD_TEXTS)] + [(5, "same id"), (None, "no id")]
    df = spark.createDataFrame([(k, t, 9) for k, t in rows], "doc_id long, text string, start int").repartition(3)
    got = token_file.tokens_of(df, public_tokenizers.path("byte_bpe_50k.json"))
    assert sorted(map(tuple, got.collect()), key=lambda r: r[1]) == token_rows(rows)
    assert token_file.tokens_of(df.limit(0), public_tokenizers.path("byte_bpe_50k.json")).count() == 0


def brute_repeated(words):
    windows = Counter(tuple(words[i:i + 3]) for i in range(len(words) - 2))
    return len({p for i in range(len(words) - 2) if windows[tuple(words[i:i + 3])] > 1 for p in range(i, i + 3)})


def test_quality_features():
    r = random.Random(4)
    for _ in range(200):
        words = [r.choice("abcd") for _ in range(r.randint(0, 40))]
        assert quality.repeated_words(words) == brute_repeated(words)
    assert quality.text_features(None) == (0, 0, 0, 0, 0, 0)
    n, chars, symbols, dup, repeat, lines = quality.text_features("a #b\na #b\nc\xa0d $")
    assert (n, chars, symbols, dup, repeat, lines) == (6, 10, 3, 1, 0, 3)


def test_thresholds_keep_their_promise():
    assert quality.log_binomial_cdf(2, 10, 0.3) == pytest.approx(np.log(0.3827827864))
    rejected = np.zeros(quality.STEPS + 1, int)
    rejected[:11] = 500
    assert quality.strictest_cut(rejected, 1000, 0.05, 0.01) == 11
    assert quality.strictest_cut(rejected, 20, 0.05, 0.01) is None and quality.strictest_cut(rejected, 0, 0.05, 0.01) is None


def test_quality_judgement(spark, docs):
    got = quality.judge(docs, table(spark, SF, "labels")).collect()
    text = {r["doc_id"]: r["text"] for r in docs.collect()}
    for r in got:
        n, chars, symbols, dup, repeat, _ = quality.text_features(text[r["doc_id"]])
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == (n, chars, symbols, dup, repeat)
        assert r["base_failed"] == (n < 50 or 100 * repeat > 50 * n) and not (r["kept"] and r["base_failed"])
    odd = spark.createDataFrame([(i, t, None) for i, t in enumerate(ODD_TEXTS)], "doc_id long, text string, lang string")
    none = table(spark, SF, "labels").limit(0)
    # Only base rules apply: every odd text is short or repeats itself.
    assert quality.judge(odd, none).count() == len(ODD_TEXTS)
    assert quality.judge(odd, none).filter("kept").count() == 0 == quality.keep_good(odd, none).count()
    assert quality.judge(odd.limit(0), none).count() == 0


def test_small_strata_reject_planted_poor_rows(spark):
    r = random.Random(9)
    rows, marks = [], []
    for lang, n_good in (("a", 1000), ("b", 320), ("c", 40), (None, 200)):
        for i in range(n_good + 20):
            poor = i >= n_good
            words = ["".join(r.choice("abcdefghij") for _ in range(r.randint(3, 7))) for _ in range(60)]
            rows.append((len(rows), " ".join("#" + w if poor and k % 3 == 0 else w for k, w in enumerate(words)), lang))
            marks.append((rows[-1][0], int(not poor)))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    labels = spark.createDataFrame(marks, "doc_id long, quality int")
    kept = {x["doc_id"] for x in quality.judge(docs, labels).filter("kept").collect()}
    assert kept == {x["doc_id"] for x in quality.keep_good(docs, labels).collect()}
    for lang in ("a", "b", "c", None):
        own = [i for i, _, of in rows if of == lang]
        assert not any(i in kept for i in own if not marks[i][1])
        assert sum(i not in kept for i in own if marks[i][1]) <= 0.03 * len(own)


def test_paths_are_whole_and_small_strata_share_one():
    steps = np.array([[0, 0, 5, 9, 10], [20, 0, 0, 9, 10], [0, 0, 40, 9, 10]])
    path = quality.layout(steps, np.array([90.0, 0, 1]), np.array([0, 12.0, 0]))
    assert path[:31] == [(0, k) for k in range(50, 19, -1)] and len(set(path)) == len(path) == 5 * quality.STEPS
    sizes = [{"stratum": s, "good": True, "count": n} for s, n in (("a", 2000), ("b", 280), (None, 150), ("c", 90))]
    members, level = quality._paths(sizes, 0.02, 0.05)
    assert [m[:2] for m in members] == [("a", 0), ("b", 1), (None, quality.POOL), ("c", quality.POOL), ("a", quality.POOL), ("b", quality.POOL)]
    assert level == 0.05 / 3 and [m[4] for m in members] == [True] * 4 + [False] * 2


def test_pipeline_equals_its_parts_by_brute_force(spark, docs):
    kept = {r["doc_id"] for r in corpus_pipeline.quality_rules(spark, docs, SF).collect()}
    verdict = {r["doc_id"] for r in quality.judge(docs, table(spark, SF, "labels")).collect() if r["kept"]}
    assert kept == verdict
    good = docs.filter(docs["doc_id"].isin(list(kept)))
    rows = [(r["doc_id"], r["text"]) for r in good.collect()]
    once = corpus_pipeline.near_dedup(spark, good, SF)
    assert once.columns == docs.columns
    assert {r["doc_id"] for r in once.collect()} == {min(rows[i][0] for i in g) for g in brute_classes(rows)}
    clean = corpus_pipeline.decontaminate(spark, once, SF)
    mixed = corpus_pipeline.mix_sources(spark, clean, SF)
    out = corpus_pipeline.run(spark, SF).collect()
    want = token_rows([(r["doc_id"], r["text"]) for r in mixed.collect()])
    assert sorted((r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in out) == sorted((k, n, c) for k, _, n, c in want)
