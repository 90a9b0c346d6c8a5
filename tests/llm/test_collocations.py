"""Collocations against plain counting."""

import collections
import re

import numpy as np

from turnfold.llm import collocations as C

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, least, top):
    f, n = collections.Counter(), collections.Counter()
    for text, lang in rows:
        lang = lang if lang is not None else "und"
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for k in range(1, 6):
                for i in range(len(words) - k + 1):
                    f[lang, tuple(words[i:i + k])] += 1
    found = {x: c for x, c in f.items() if c >= least and len(x[1]) > 1}
    held = {(lang, p[lo:lo + m]) for (lang, p), c in found.items() for m in range(2, len(p)) for lo in range(len(p) - m + 1)
            if 100 * c >= 100 * f[lang, p[lo:lo + m]]}
    out = collections.defaultdict(list)
    for (lang, p), a in found.items():
        if (lang, p) not in held:
            cuts = [(1000 * a * n[lang] // (f[lang, p[:k]] * f[lang, p[k:]]), k) for k in range(1, len(p))]
            score, k = min(cuts)
            out[lang].append((-score, -a, " ".join(p).encode(), f[lang, p[:k]], f[lang, p[k:]]))
    return {(lang, i + 1, p.decode(), -a, x, y, n[lang], -s) for lang, rows in out.items()
            for i, (s, a, p, x, y) in enumerate(sorted(rows)[:top])}


def texts(seed=7, n=220):
    rng = np.random.default_rng(seed)
    words = [f"w{i}" for i in range(12)] + ["The", "THE", "é", "日本", "a\x01b", "-"]
    fixed = ["the big Red dog runs", "w1 w2 w3", "red dog", "日本 é 日本"]
    out = []
    for i in range(n):
        size = int(rng.integers(0, 40))
        parts = [fixed[int(rng.integers(len(fixed)))] if rng.random() < 0.35 else words[int(rng.zipf(1.5)) % len(words)]
                 for _ in range(size)]
        gaps = rng.choice([" ", "  ", "\t", ", ", ".", "\n", " ? "], size=size, p=[0.6, 0.1, 0.05, 0.1, 0.05, 0.05, 0.05])
        out.append(("".join(p + g for p, g in zip(parts, gaps, strict=True)), ["en", "fr", None, "und"][i % 4]))
    return out + [(None, "en"), ("", None), ("one", "xx"), (" .,. ", "fr")] + out[:9]


def test_against_brute_force(spark):
    rows = texts()
    docs = spark.createDataFrame([(t, x, i, t) for i, (t, x) in enumerate(rows)], "text string, lang string, k1 long, word string")
    for least, top, heavy, bucket in ((12, 2000, C.HEAVY, C.BUCKET), (3, 40, 4, 64), (2, 5, 1, 16)):
        got = [tuple(r) for r in C.collocations(docs, least=least, top=top, heavy=heavy, bucket=bucket).collect()]
        want = brute(rows, least, top)
        assert len(got) == len(set(got))
        assert set(got) == want
        assert want


def test_odd_rows(spark, odd_rows, no_rows):
    rows = [(r["text"], r["lang"]) for r in odd_rows.collect()]
    got = {tuple(r) for r in C.collocations(odd_rows, least=3).collect()}
    assert got == brute(rows, 3, 2000) and got
    assert C.collocations(no_rows).count() == 0


def test_quicksort_counts_and_abandons():
    rng = np.random.default_rng(1)
    keys = rng.integers(1, 5, size=(400, 5))
    keys[rng.random(400) < 0.3, 3:] = 0
    weight = rng.integers(1, 9, 400)
    want = collections.Counter()
    for row, w in zip(keys.tolist(), weight.tolist(), strict=True):
        for d in range(1, 6):
            if row[d - 1] == 0:
                break
            want[tuple(row[:d])] += w
    for least, whole in ((1, 1), (60, 1), (60, 3)):
        got = {tuple(keys[p, :d].tolist()): n for p, d, n in C.multikey_counts(keys, weight, least, whole)}
        assert got == {x: n for x, n in want.items() if n >= least or len(x) < whole}


def test_exact_scores_beyond_64_bits(spark):
    big = 3_000_000_000_000
    rows = [(1, 2, 0, 0, 0, 2, big - 7, "en")]
    cand = spark.createDataFrame(rows, "k1 long, k2 long, k3 long, k4 long, k5 long, size int, a long, lang string")
    counts = spark.createDataFrame([(1, 0, 0, 0, 0, big - 1), (2, 0, 0, 0, 0, big - 2)], "k1 long, k2 long, k3 long, k4 long, k5 long, a long")
    totals = spark.createDataFrame([("en", 97 * big + 13)], "lang string, n long")
    row = C.scored(cand, counts, totals).first()
    assert row["score"] == 1000 * (big - 7) * (97 * big + 13) // ((big - 1) * (big - 2))
