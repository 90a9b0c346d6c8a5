"""Rules, classifier, language ID and class-bigram scores: brute-force counts
and held-out accuracy."""

import collections
import math
import random
import re
import zlib

import numpy as np
import pytest

from turnfold.llm import brown, langid, quality_fm, quality_rules, queries
from turnfold.llm.textops import buffer_of, span_hashes, word_spans

from .conftest import SF_BIG

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def remainder(key, modulus):
    return zlib.crc32(str(key).encode()) % modulus


def base_counts(text):
    text = text or ""
    words = WORD.findall(text)
    seen, dup = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    grams = collections.Counter(tuple(words[i:i + 3]) for i in range(len(words) - 2))
    again = {j for i in range(len(words) - 2) if grams[tuple(words[i:i + 3])] > 1 for j in (i, i + 1, i + 2)}
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(again)


def check_rules(rows, texts):
    for r in rows:
        own = base_counts(texts[r["doc_id"]])
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == own
        assert r["base_failed"] == (own[0] < 50 or 100 * own[4] > 50 * own[0])
        assert not (r["base_failed"] and r["kept"])


def test_op3_counts_and_verdicts(spark):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF_BIG}/documents.parquet").collect()}
    quality = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{SF_BIG}/labels.parquet").collect()}
    rows = queries.op3_quality_rules(spark, SF_BIG).collect()
    check_rules(rows, texts)
    assert len(rows) == len(texts)
    judged = [(quality[r["doc_id"]], r["kept"]) for r in rows if r["doc_id"] in quality and not r["base_failed"]]
    good, bad = [k for q, k in judged if q == 1], [k for q, k in judged if q == 0]
    assert np.mean(good) > 0.99 and np.mean(bad) < 0.1


def test_rules_of_odd_rows(spark, odd_rows, no_rows):
    labels = spark.createDataFrame([(7, 0, 0), (10, 1, None), (11, 1, 0), (11, 1, 0), (12, None, 1), (None, 1, 0)],
                                   "doc_id long, quality int, toxic int")
    for marks in (labels, labels.limit(0)):
        rows = quality_rules.judge_documents(odd_rows, marks).collect()
        assert len(rows) == odd_rows.count()
        texts = {r["doc_id"]: r["text"] for r in odd_rows.collect()}
        check_rules([r for r in rows if r["doc_id"] not in (None, 3)], texts)
        assert quality_rules.judge_documents(no_rows, marks).count() == 0


def test_forest_finds_outliers():
    rng = np.random.default_rng(3)
    x = rng.normal(size=(3000, 4))
    x[:60, 1] += 9
    good = np.arange(3000) >= 60
    score = quality_rules.anomaly(quality_rules.fit_forest(x, good), x)
    assert np.quantile(score[:60], 0.1) > np.quantile(score[60:], 0.98)
    assert quality_rules.calibrate([(3, 1, 90), (9, 0, 10)], 10, 0.0) > 0.3
    assert quality_rules.calibrate([(3, 1, 90)], 10) == float("inf")


def test_op4_held_out(spark):
    quality = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{SF_BIG}/labels.parquet").collect()}
    rows = queries.op4_quality_fm(spark, SF_BIG).collect()
    assert len(rows) == 1000
    for r in rows:
        assert r["held_out"] == (remainder(r["doc_id"], 3) == 1)
        assert 0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5)
    held = [(quality[r["doc_id"]], r["predicted"]) for r in rows if r["held_out"] and r["doc_id"] in quality]
    assert np.mean([p == q for q, p in held]) > 0.95


def test_factorisation_identity():
    rng = np.random.default_rng(2)
    model = {"w0": 0.3, "w": rng.normal(size=quality_fm.WIDTH), "v": rng.normal(size=(quality_fm.WIDTH, 3))}
    col, val = np.array([5, 17, 400, 9000]), np.array([0.5, 1.5, -0.2, 0.9])
    want = 0.3 + (model["w"][col] * val).sum()
    for i in range(4):
        for j in range(i):
            want += model["v"][col[i]] @ model["v"][col[j]] * val[i] * val[j]
    got = quality_fm.margins(model, np.ones(4, int), col, val, 3)
    assert got[1] == pytest.approx(want) and got[0] == got[2] == pytest.approx(0.3)


def test_factorisation_learns_an_interaction():
    rng = np.random.default_rng(6)
    a, b = rng.integers(0, 2, 2000), rng.integers(0, 2, 2000)
    rows = [(np.array([10 + x, 20 + y]), np.array([1.0, 1.0])) for x, y in zip(a, b, strict=True)]
    y = (a ^ b).astype(float)
    model = quality_fm.fit(rows, y, epochs=30)
    got = [quality_fm.margins(model, np.zeros(2, int), *r, 1)[0] > 0 for r in rows]
    assert np.mean(got == (y == 1)) > 0.95


def test_classifier_of_odd_rows(spark, odd_rows, no_rows):
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(14)] + [(None, 1, 0)], "doc_id long, quality int, toxic int")
    for marks in (labels, labels.where("quality = 1"), labels.limit(0)):
        rows = quality_fm.classify(odd_rows, marks).collect()
        assert len(rows) == odd_rows.count() and all(0 <= r["score"] <= 1 for r in rows)
        assert len({r["score"] for r in rows if r["doc_id"] == 7}) == 1
        assert quality_fm.classify(no_rows, marks).count() == 0


def test_op5_held_out(spark):
    lang = {r["doc_id"]: r["lang"] for r in spark.read.parquet(f"{SF_BIG}/documents.parquet").collect()}
    rows = queries.op5_language_id(spark, SF_BIG).collect()
    assert len(rows) == len(lang)
    assert all(r["held_out"] == (remainder(r["doc_id"], 4) == 2) and 0 <= r["score"] <= 1 for r in rows)
    held = [r["lang_pred"] == lang[r["doc_id"]] for r in rows if r["held_out"]]
    assert np.mean(held) > 0.98
    assert np.mean([r["ambiguous"] for r in rows]) < 0.01


def test_language_of_odd_rows(spark, odd_rows, no_rows):
    rows = langid.identify(odd_rows).collect()
    by = {r["doc_id"]: r for r in rows}
    assert len(rows) == odd_rows.count()
    for key in (0, 1, 2, 10):
        assert (by[key]["lang_pred"], by[key]["score"]) == ("und", 0.0)
    assert by[9]["lang_pred"] in ("en", "fr") and by[11]["lang_pred"] in ("en", "fr")
    assert langid.identify(no_rows).count() == 0
    nothing = langid.identify(odd_rows.withColumn("lang", odd_rows["lang"].substr(9, 1)).where("lang IS NULL"))
    assert {r["lang_pred"] for r in nothing.collect()} == {"und"}
    kept = langid.keep_identified(odd_rows)
    assert kept.columns == odd_rows.columns and kept.where("doc_id IN (0, 1, 2, 10)").count() == 0


@pytest.mark.parametrize("n", [1, 2, 4, 6, 9, 40])
def test_codewords_differ(n):
    code = langid.codewords(n)
    assert len(code) == n and len({tuple(c) for c in code}) == n
    if n >= 4:
        gap = (code[:, None] != code[None]).sum(axis=2)[~np.eye(n, dtype=bool)]
        assert gap.min() >= 3  # a wrong bit is corrected


def test_decoding_mends_a_wrong_bit():
    counts = [(name, 100 * i + j, 50) for i, name in enumerate(("a", "b", "c", "d")) for j in range(40)]
    model = langid.fit(counts)
    cell = np.arange(200, 240)
    row = np.zeros(40, int)
    assert model["langs"][langid.decode(model, row, cell, 1)[0][0]] == "c"
    model["w"][0] = -model["w"][0]
    assert model["langs"][langid.decode(model, row, cell, 1)[0][0]] == "c"


def base_scores(rows):
    """doc_id: (tokens, known, training tokens, base score)."""
    split = [(k, WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), t or "")) + [None]) for k, t in rows]
    count = collections.Counter(w for k, words in split if k is None or remainder(k, 10) for w in words)
    n, v = sum(count.values()), len(count)
    return [(k, len(w), sum(count[x] > 0 for x in w), n,
             sum(math.log10((count[x] + 0.1) / (n + 0.1 * (v + 1))) for x in w)) for k, w in split]


def check_scores(got, rows):
    order = lambda x: (x[0] is None, x[0] or 0, x[1], x[4])
    mine = sorted([(r["doc_id"], r["n_tokens"], r["n_known"], r["train_tokens"], r["base_score"]) for r in got], key=order)
    for a, b in zip(mine, sorted(base_scores(rows), key=order), strict=True):
        assert a[:4] == b[:4] and a[4] == pytest.approx(b[4], rel=1e-9, abs=1e-9)
    assert all(r["held_out"] == (r["doc_id"] is not None and remainder(r["doc_id"], 10) == 0) for r in got)
    assert all(r["score"] < 0 for r in got)


def test_op10_base_and_gain(spark):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF_BIG}/documents.parquet").collect()]
    got = queries.op10_brown_scores(spark, SF_BIG).collect()
    check_scores(got, rows)
    held = [r for r in got if r["held_out"]]
    assert sum(r["score"] for r in held) > sum(r["base_score"] for r in held)


def test_scores_over_many_buckets_and_odd_rows(spark, odd_rows, no_rows, monkeypatch):
    monkeypatch.setattr(brown, "BUCKET_BYTES", 1 << 15)
    monkeypatch.setattr(brown, "BUCKETS_A_RANGE", 3)
    check_scores(brown.score_documents(odd_rows).collect(), [(r["doc_id"], r["text"]) for r in odd_rows.collect()])
    assert brown.score_documents(no_rows).count() == 0
    alone = odd_rows.where("doc_id = 11").selectExpr("4L AS doc_id", "text")  # held out: nothing to learn from
    assert remainder(4, 10) != 0 or brown.score_documents(alone).first()["n_known"] == 0


def likelihood(counts, cls):
    k = cls.max() + 1
    m = np.zeros((k, k))
    np.add.at(m, (cls[:, None], cls[None, :]), counts)
    f = lambda x: (x * np.log(np.maximum(x, 1e-300))).sum()
    return f(m) - f(m.sum(axis=0)) - f(m.sum(axis=1))


def test_exchange_raises_the_likelihood():
    rng = np.random.default_rng(1)
    kind = rng.integers(0, 3, 40)
    step = np.array([[0.1, 0.8, 0.1], [0.1, 0.1, 0.8], [0.8, 0.1, 0.1]])
    counts = rng.poisson(30 * step[kind][:, kind]).astype(np.int64)
    counts = np.pad(counts, ((0, 1), (0, 1)), constant_values=1)
    cls = brown.exchange(counts, classes=3, passes=50)
    start = np.append(np.minimum(np.arange(40), 2), 3)
    assert likelihood(counts, cls) > likelihood(counts, start)
    for u in range(40):  # no single move is better
        for k in range(3):
            other = cls.copy()
            other[u] = k
            assert likelihood(counts, other) <= likelihood(counts, cls) + 1e-6
    assert cls[40] == 3 and (cls[:40] < 3).all()


def test_model_probabilities_sum_to_one():
    rng = np.random.default_rng(3)
    counts = np.zeros((brown.UNITS, brown.UNITS), np.int64)
    some = np.r_[0:20, 640:650, brown.END]
    counts[np.ix_(some, some)] = rng.integers(0, 9, (len(some), len(some)))
    tokens = counts.sum(axis=0)
    words = np.where(tokens > 0, 1, 0)
    model = brown.fit({"unit_tokens": tokens, "unit_words": words}, counts)
    assert (10 ** model["step"]).sum(axis=1) == pytest.approx(1.0)


def test_rare_words_are_clustered_by_their_neighbours(spark):
    """1 400 words outside the frequent units, all with one ending: half stand
    between red and wool, half between iron and ore, as 20 frequent words each do."""
    rng = random.Random(5)
    frequent = [f"w{i:03d}x" for i in range(700)] * 40
    kinds = [[f"{place}{i}end" for i in range(700)] for place in ("p", "q")]
    often = [[f"{place}often{i}" for i in range(20)] for place in ("p", "q")]
    pair = [lambda w: f"red {w} wool", lambda w: f"iron {w} ore"]
    rng.shuffle(frequent)
    rows, key = [(None, " ".join(frequent))], 0
    while len(rows) < 400:
        key += 1
        if remainder(key, 10):
            rows.append((key, " ".join(pair[key % 2](w) for w in rng.sample(kinds[key % 2], 40) + rng.choices(often[key % 2], k=40))))
    held = [k for k in range(1, 2000) if not remainder(k, 10)][:8]
    right = [(k, " ".join(pair[i % 2](w) for w in kinds[i % 2][i::70])) for i, k in enumerate(held[:4])]
    wrong = [(k, " ".join(pair[1 - i % 2](w) for w in kinds[i % 2][i::70])) for i, k in enumerate(held[4:])]
    got = {r["doc_id"]: r for r in brown.score_documents(spark.createDataFrame(rows + right + wrong, "doc_id long, text string")).collect()}
    assert all(got[k]["held_out"] and got[k]["n_known"] == got[k]["n_tokens"] for k in held)
    for a, b in zip(right, wrong, strict=True):
        assert got[a[0]]["score"] > got[b[0]]["score"] + 5.0


def test_class_gains_follow_the_likelihood():
    rng = np.random.default_rng(2)
    size = brown.CLASSES + 1
    m = rng.integers(500, 5000, (size, size)).astype(float)
    before, after = (rng.poisson(0.2, (5, size)).astype(float) for _ in range(2))
    f = lambda x: (x * np.log(x)).sum()
    got = brown.class_gains(m, before, after)
    for w in range(5):
        want = []
        for c in range(brown.CLASSES):
            more = m.copy()
            more[c] += after[w]
            more[:, c] += before[w]
            want.append(f(more) - f(more.sum(axis=0)) - f(more.sum(axis=1)))
        want = np.array(want)
        assert got[w] - got[w].mean() == pytest.approx(want - want.mean(), abs=0.05)


def test_word_hashes_tell_words_apart():
    import pyarrow as pa

    buf, offs = buffer_of(pa.array(["Ab aB ab é É", None, "ab\x0bc"]))
    s, e, _ = word_spans(buf, offs)
    low, own = span_hashes(buf, s, e, True), span_hashes(buf, s, e, False)
    assert low[0] == low[1] == low[2] == low[5] and len(set(own[:3].tolist())) == 3 and low[3] != low[4]
