"""Factorisation machine and output codes against plain loops."""

import math

import numpy as np
import pytest

from turnfold.llm import langid, quality_fm, queries

from .conftest import SF
from .test_scores import remainder


def test_margins_are_the_pairwise_sum():
    rng = np.random.default_rng(4)
    rows = [(np.sort(rng.choice(200, 12, replace=False)), rng.random(12)) for _ in range(60)]
    y = rng.integers(0, 2, 60).astype(float)
    model = quality_fm.fit(rows, y, epochs=3)
    row = np.repeat(np.arange(60), 12)
    got = quality_fm.margins(model, row, np.concatenate([c for c, _ in rows]), np.concatenate([v for _, v in rows]), 60)
    for (c, x), out in zip(rows, got, strict=True):
        want = model["w0"] + sum(model["w"][i] * a for i, a in zip(c, x, strict=True))
        for i in range(len(c)):
            for j in range(i):
                want += float(model["v"][c[i]] @ model["v"][c[j]]) * x[i] * x[j]
        assert out == pytest.approx(want, abs=1e-12)


def test_op4_scores_are_those_of_its_features(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    model = quality_fm.fit(*quality_fm.training_rows(docs, labels))
    got = {r["doc_id"]: r for r in queries.op4_quality_fm(spark, SF).collect()}
    for r in docs.limit(25).collect():
        text = (r["text"] or "").encode()
        buf, offs = np.frombuffer(text, np.uint8), np.array([0, len(text)])
        _, col, val = quality_fm.features(buf, offs)
        x = dict(zip(col.tolist(), val.tolist(), strict=True))
        z = model["w0"] + sum(model["w"][i] * a for i, a in x.items())
        keys = sorted(x)
        v = np.array([model["v"][i] * x[i] for i in keys])
        z += sum(float(v[i] @ v[:i].sum(axis=0)) for i in range(1, len(keys)))
        one = got[r["doc_id"]]
        assert one["score"] == pytest.approx(1 / (1 + math.exp(-z)), abs=1e-9)
        assert one["predicted"] == int(one["score"] >= 0.5) and one["held_out"] == (remainder(r["doc_id"], 3) == 1)


def plain_grams(text):
    out, last = [], None
    for b in (text or "").encode():
        c = b + 32 if 65 <= b <= 90 else b
        c = c if 97 <= c <= 122 or c >= 128 else 32
        if not (c == 32 and last == 32):
            out.append(c)
        last = c
    cells = []
    for k in (1, 2, 3, 4):
        for i in range(len(out) - k + 1):
            if k == 1 and out[i] == 32:
                continue
            code = 0
            for c in out[i:i + k]:
                code = (code * 257 + c + 1) % 2**64
            cells.append((code * 0x9E3779B97F4A7C15 % 2**64) >> 49)
    return cells


def test_op5_equals_a_plain_decoder(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    counts = {}
    for r in docs:
        if r["lang"] is not None and r["text"] is not None and remainder(r["doc_id"], 4) != 2:
            own = counts.setdefault(r["lang"], np.zeros(1 << 15))
            np.add.at(own, np.array(plain_grams(r["text"]), np.int64), 1)
    langs = sorted(counts)
    share = {x: (counts[x] + 0.5) / (counts[x] + 0.5).sum() for x in langs}
    bits = []
    for part in range(1, 2 ** (len(langs) - 1)):  # every way to part up to six languages in two
        one = [x for i, x in enumerate(langs) if part >> i & 1]
        zero = [x for x in langs if x not in one]
        w = np.log(np.mean([share[x] for x in one], axis=0)) - np.log(np.mean([share[x] for x in zero], axis=0))
        mean = {x: float(share[x] @ w) for x in langs}
        low, high = min(mean[x] for x in one), max(mean[x] for x in zero)
        bits.append((one, w, (low + high) / 2, max(low - high, 1e-3)))
    got = {r["doc_id"]: r for r in queries.op5_language_id(spark, SF).collect()}
    for r in docs[:60]:
        one = got[r["doc_id"]]
        assert one["held_out"] == (remainder(r["doc_id"], 4) == 2)
        if not any(c.isalpha() for c in r["text"] or ""):
            assert (one["lang_pred"], one["score"]) == ("und", 0.0)
            continue
        cells = plain_grams(r["text"])
        loss = dict.fromkeys(langs, 0.0)
        for ones, w, bias, trust in bits:
            z = (w[cells].sum() / max(len(cells), 1) - bias) / trust * 4.0
            for x in langs:
                loss[x] += min(trust, 1.0) * np.logaddexp(0.0, -z if x in ones else z)
        best = min(langs, key=lambda x: (loss[x], x))
        assert one["lang_pred"] == best
        assert one["score"] == pytest.approx(1 / sum(math.exp(loss[best] - loss[x]) for x in langs), abs=1e-6)
