"""Phrase collocations by multikey quicksort of suffix pointers.

Texts are cut into pieces and words; a suffix pointer is a word's place with
the up to ``DEPTH`` words from there to the end of its piece.

1. Words are counted per language.  The frequent ones mark a bit set of
   bounded size, so tasks can end a suffix at a word that no candidate holds.
2. Neighbouring pairs of frequent words are counted and mark a second bit
   set; suffixes end at a pair that no candidate holds.  A false mark only
   leaves more work to the exact counts.
3. Equal suffixes become one weighted pointer, and pointers are routed by
   their leading words: two, and more where a leading pair is too large for
   one task.  In a routed group a multikey (three-way) quicksort parts the
   pointers by one word at a time.  The weight of an equal partition is the
   count of its phrase; partitions lighter than the least count are abandoned.
   Counts of phrases shorter than their group's route are partial and are
   added up afterwards.
4. Candidates that a longer one with the same count holds are dropped, the
   others are scored at every cut in exact decimals and ranked per language.

Words are known by 64-bit keys (``textops.span_hashes`` and the language);
the word counts keep the spelling, so a frequent word's key and text are one
row.  Defined results: null and empty texts have no words; a null language
is ``und``; repeated rows and ids count as often as they occur (the key of a
row is never read); other columns are not read; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .frames import written
from .textops import U64, mix, row_of, span_hashes, text_slices

DEPTH = 5
SLICE = 8 << 20
BITS_LEAST, BITS_MOST = 1 << 18, 1 << 29  # of a bit set: 32 kB to 64 MB
BUCKET = 1 << 18    # weighted pointers a sorting task takes, about
HEAVY = 1 << 16     # pointers of one leading phrase that are routed together
HEAVY_GROUPS = 4096  # no more leading phrases than this can be heavy
KEYS = [f"k{i + 1}" for i in range(DEPTH)]

_BREAK = np.zeros(256, bool)
_BREAK[[ord(c) for c in ".,;:!?\n\x0b\x0c\r"]] = True
_GAP = _BREAK.copy()
_GAP[[0x20, 0x09]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def language_salt(lang: str) -> int:
    return int.from_bytes(hashlib.blake2b(lang.encode(), digest_size=8).digest(), "little")


def words_of(buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, row, piece) of every word; pieces never cross a row."""
    if not len(buf):
        z = np.zeros(0, np.int64)
        return z, z, z, z
    ink = ~_GAP[buf]
    start, end = ink.copy(), ink.copy()
    start[1:] &= ~ink[:-1]
    end[:-1] &= ~ink[1:]
    full = offs[1:] > offs[:-1]
    start[offs[:-1][full]] = ink[offs[:-1][full]]
    end[offs[1:][full] - 1] = ink[offs[1:][full] - 1]
    s = np.flatnonzero(start)
    row = row_of(offs, s)
    return s, np.flatnonzero(end) + 1, row, np.cumsum(_BREAK[buf])[s] + row


def word_keys(buf, offs, langs: np.ndarray):
    """Spans, rows, pieces and keys of the words of a slice."""
    s, e, row, piece = words_of(buf, offs)
    names, code = np.unique(langs.astype(str), return_inverse=True)
    salt = np.array([language_salt(str(x)) for x in names], np.uint64)
    key = mix(span_hashes(buf, s, e, lower=True) ^ salt[code[row]]) if len(s) else np.zeros(0, np.uint64)
    key[key == 0] = U64(1)  # 0 stands for no word
    return s, e, row, piece, key


def spelled(buf: np.ndarray, s: np.ndarray, e: np.ndarray) -> pa.Array:
    """The lower-cased text of spans."""
    size = e - s
    ends = np.cumsum(size)
    at = np.arange(ends[-1] if len(ends) else 0) + np.repeat(s - (ends - size), size)
    offsets = np.concatenate([[0], ends]).astype(np.int64)
    return pa.LargeStringArray.from_buffers(len(s), pa.py_buffer(offsets), pa.py_buffer(_LOWER[buf[at]])).cast(pa.string())


def _batches(batches: Iterator[pa.RecordBatch]):
    for batch in batches:
        langs = np.array(batch.column(1).to_pylist(), dtype=object)
        for lo, hi, buf, offs in text_slices(batch.column(0), SLICE):
            yield buf, langs[lo:hi], word_keys(buf, offs, langs[lo:hi])


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64))


def word_counts(docs: DataFrame) -> DataFrame:
    """``lang, k, word, n`` of all words."""
    def run(batches):
        for buf, langs, (s, e, row, _, key) in _batches(batches):
            found, first, n = np.unique(key, return_index=True, return_counts=True)
            names = pa.array([str(langs[r]) for r in row[first]], pa.string())
            yield pa.RecordBatch.from_arrays([names, _signed(found), spelled(buf, s[first], e[first]), pa.array(n)],
                                             ["lang", "k", "word", "n"])
    return docs.mapInArrow(run, "lang string, k long, word string, n long").groupBy("lang", "k", "word").agg(F.sum("n").alias("n"))


def bit_set(keys: DataFrame, column: str = "k") -> np.ndarray:
    """Bits of all keys, modulo a power of two near 16 bits a key and within
    ``BITS_LEAST`` and ``BITS_MOST``; Spark builds it in blocks of 4 kB."""
    bits = BITS_LEAST
    n = keys.count()
    while bits < min(16 * n, BITS_MOST):
        bits *= 2
    place = F.expr(f"({column} & {bits - 1}L) + 1")
    blocks = (keys.select(place.alias("at")).groupBy(F.expr("bitmap_bucket_number(at)").alias("block"))
              .agg(F.expr("bitmap_construct_agg(bitmap_bit_position(at))").alias("bitmap")))
    out = np.zeros((bits >> 15, 4096), np.uint8)
    for block, bitmap in blocks.collect():
        out[block - 1] = np.frombuffer(bitmap, np.uint8)
    return out.ravel()


def marked(bits: np.ndarray, key: np.ndarray) -> np.ndarray:
    at = (key & U64(8 * len(bits) - 1)).astype(np.int64)
    return (bits[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1


def pair_keys(key: np.ndarray) -> np.ndarray:
    return mix(key[:-1] * U64(0x9FB21C651E98DF25) + (key[1:] ^ U64(0x243F6A8885A308D3)))


def linked(key: np.ndarray, piece: np.ndarray, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(pair key, whether word i and the next are marked words of one piece)."""
    good = marked(words, key)
    return pair_keys(key), good[:-1] & good[1:] & (piece[:-1] == piece[1:])


def pair_counts(docs: DataFrame, words: np.ndarray) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(words)

    def run(batches):
        for _, _, (_, _, _, piece, key) in _batches(batches):
            if len(key) < 2:
                continue
            pair, ok = linked(key, piece, shared.value)
            found, n = np.unique(pair[ok], return_counts=True)
            yield pa.RecordBatch.from_arrays([_signed(found), pa.array(n)], ["k", "n"])
    return docs.mapInArrow(run, "k long, n long").groupBy("k").agg(F.sum("n").alias("n"))


def suffixes(docs: DataFrame, words: np.ndarray, pairs: np.ndarray) -> DataFrame:
    """Distinct suffixes ``k1 .. k5`` (0: none) with their weight ``n``."""
    shared = docs.sparkSession.sparkContext.broadcast((words, pairs))
    fields = ", ".join(f"{k} long" for k in KEYS) + ", n long"

    def run(batches):
        for _, _, (_, _, _, piece, key) in _batches(batches):
            if len(key) < 2:
                continue
            pair, ok = linked(key, piece, shared.value[0])
            ok[ok] = marked(shared.value[1], pair[ok])
            first = np.flatnonzero(ok)
            # an end mark behind the last word keeps later words out of reach
            link = np.concatenate([ok, np.zeros(DEPTH, bool)])
            tail = np.concatenate([key, np.zeros(DEPTH, np.uint64)])
            cols, alive, whole = [key[first]], np.ones(len(first), bool), key[first].copy()
            for d in range(1, DEPTH):
                alive = alive & link[first + d - 1]
                cols.append(np.where(alive, tail[first + d], U64(0)))
                whole = mix(whole * U64(0x9E3779B97F4A7C15) + cols[-1])
            # equal suffixes of the slice become one; ones with an equal hash stay apart
            order = np.argsort(whole, kind="stable")
            cols = [c[order] for c in cols]
            new = np.ones(len(order), bool)
            if len(order):
                new[1:] = np.any([c[1:] != c[:-1] for c in cols], axis=0)
            at = np.flatnonzero(new)
            yield pa.RecordBatch.from_arrays([_signed(c[at]) for c in cols] + [pa.array(np.diff(np.append(at, len(order))))],
                                             [*KEYS, "n"])
    return docs.mapInArrow(run, fields).groupBy(*KEYS).agg(F.sum("n").alias("n"))


def multikey_counts(keys: np.ndarray, weight: np.ndarray, least: int, whole: int) -> list[tuple[int, int, int]]:
    """(pointer to one occurrence, depth, weight) of the phrases of the
    pointers in ``keys`` (pointers x depth, 0: no word).  Phrases of at least
    ``whole`` words are complete here: the light ones are abandoned.  Shorter
    ones are partial and all are given."""
    out = []
    stack = [(np.arange(len(weight)), 0)] if len(weight) else []
    while stack:
        p, d = stack.pop()
        if d + 1 >= whole and weight[p].sum() < least:
            continue  # abandoned: no phrase of this partition is frequent
        word = keys[p, d]
        pivot = np.sort(word[[0, len(p) // 2, -1]])[1]
        equal = word == pivot
        if not equal.all():
            for side in (p[word < pivot], p[word > pivot]):
                if len(side):
                    stack.append((side, d))
            p = p[equal]
        if pivot == 0:
            continue  # the suffixes end here
        total = int(weight[p].sum())
        if total >= least or d + 1 < whole:
            out.append((int(p[0]), d + 1, total))
            if d + 1 < keys.shape[1]:
                stack.append((p, d + 1))
    return out


def phrase_counts(pointers: DataFrame, least: int, heavy: int = HEAVY, bucket: int = BUCKET) -> DataFrame:
    """``k1 .. k5, size, a`` of all phrases of two words and more with a count
    of at least ``least``."""
    n = pointers.count()
    bound = max(heavy, n // HEAVY_GROUPS)
    routed = pointers.withColumn("route", F.lit(2))
    for depth in range(2, DEPTH):
        lead = KEYS[:depth]
        # fewer than HEAVY_GROUPS rows can pass this bound, whatever the input
        large = routed.where(F.col("route") == depth).groupBy(*lead).agg(F.count(F.lit(1)).alias("m")).where(F.col("m") > bound)
        if large.isEmpty():
            break
        routed = (routed.join(F.broadcast(large.withColumn("more", F.lit(1))), lead, "left")
                  .withColumn("route", F.when(F.col("more") == 1, depth + 1).otherwise(F.col("route"))).drop("m", "more"))
    buckets = max(1, -(-n // bucket))
    lead = F.array(*[F.when(F.col("route") > i, F.col(k)).otherwise(F.lit(0)) for i, k in enumerate(KEYS)])
    fields = ", ".join(f"{k} long" for k in KEYS) + ", size int, a long"

    def run(group: pa.Table) -> pa.Table:
        group = group.combine_chunks()
        keys = np.stack([group[k].to_numpy() for k in KEYS], axis=1)
        weight, route = group["n"].to_numpy(), group["route"].to_numpy()
        rows, sizes, counts = [], [], []
        for whole in np.unique(route):
            mine = np.flatnonzero(route == whole)
            for at, depth, total in multikey_counts(keys[mine], weight[mine], least, int(whole)):
                if depth >= 2:
                    rows.append(mine[at])
                    sizes.append(depth)
                    counts.append(total)
        sizes = np.array(sizes, np.int32)
        found = keys[np.array(rows, np.int64)]
        found[np.arange(DEPTH)[None, :] >= sizes[:, None]] = 0
        return pa.table([pa.array(found[:, i]) for i in range(DEPTH)] + [pa.array(sizes), pa.array(np.array(counts, np.int64))],
                        names=[*KEYS, "size", "a"])

    sorted_out = (routed.withColumn("bucket", F.pmod(F.xxhash64(lead), F.lit(buckets))).groupBy("bucket")
                  .applyInArrow(run, fields))
    return sorted_out.groupBy(*KEYS, "size").agg(F.sum("a").alias("a")).where(F.col("a") >= least)


def _words(keep) -> Column:
    """A phrase as a struct of keys; ``keep(i)`` gives word i, null for none."""
    return F.struct(*[F.coalesce(keep(i), F.lit(0).cast("long")).alias(k) for i, k in enumerate(KEYS)])


def _word(i: int) -> Column:
    return F.col(KEYS[i]) if i < DEPTH else F.lit(None).cast("long")


def maximal(phrases: DataFrame) -> DataFrame:
    """Without phrases that a longer one of the same count holds.  If any
    does, one that is longer by a word does, for counts only fall with length."""
    parts = F.explode(F.array(_words(lambda i: F.when(F.col("size") > i + 1, _word(i))), _words(lambda i: _word(i + 1))))
    held = phrases.where("size > 2").select(parts.alias("held"), F.col("a").alias("held_a"))
    return phrases.join(held, (F.struct(*KEYS) == F.col("held")) & (F.col("a") == F.col("held_a")), "left_anti")


def scored(candidates: DataFrame, counts: DataFrame, totals: DataFrame) -> DataFrame:
    """Adds ``l, r, n, score`` of the lowest-scoring cut.  ``counts`` holds
    all phrases and words (``k1 .. k5, a``), ``totals`` the ``n`` of a lang.
    The quotient is taken in whole decimals of 38 digits."""
    cut = F.explode(F.array(*[F.struct(F.lit(k).alias("cut"), _words(lambda i, k=k: _word(i) if i < k else F.lit(None)).alias("left"),
                                       _words(lambda i, k=k: _word(i + k)).alias("right")) for k in range(1, DEPTH)]))
    cuts = candidates.select("*", cut.alias("c")).where("c.cut < size").select(*candidates.columns, "c.*")
    part = F.struct(*KEYS)
    cuts = cuts.join(counts.select(part.alias("left"), F.col("a").alias("l")), "left")
    cuts = cuts.join(counts.select(part.alias("right"), F.col("a").alias("r")), "right")
    up, down = [" * ".join(f"cast({x} as decimal(38,0))" for x in xs) for xs in (("1000", "a", "n"), ("l", "r"))]
    best = F.expr(f"min(struct(({up}) div ({down}) AS score, cut, l, r))").alias("best")
    return (cuts.join(totals, "lang").groupBy("lang", *KEYS, "size", "a", "n").agg(best)
            .select("lang", *KEYS, "size", "a", "n", "best.l", "best.r", "best.score"))


def collocations(docs: DataFrame, text: str = "text", lang: str = "lang", least: int = 100, top: int | None = 2000,
                 heavy: int = HEAVY, bucket: int = BUCKET) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: the first ``top`` phrases of
    each language (all with None) by score, count and spelling."""
    docs = docs.select(F.col(text).alias("text"), F.coalesce(F.col(lang), F.lit("und")).alias("lang"))
    words = written(word_counts(docs), "words")
    totals = words.groupBy("lang").agg(F.sum("n").alias("n"))
    frequent = words.where(F.col("n") >= least)
    word_bits = bit_set(frequent)
    pair_bits = bit_set(written(pair_counts(docs, word_bits).where(F.col("n") >= least), "pairs"))
    pointers = written(suffixes(docs, word_bits, pair_bits), "suffixes")
    phrases = written(phrase_counts(pointers, least, heavy, bucket), "phrases")
    singles = frequent.select(F.col("k").alias("k1"), *[F.lit(0).cast("long").alias(k) for k in KEYS[1:]], F.col("n").alias("a"))
    counts = phrases.select(*KEYS, "a").unionByName(singles)
    tongue = frequent.select(F.col("k").alias("k1"), "lang")
    ranked = written(scored(maximal(phrases).join(tongue, "k1"), counts, totals), "scored")
    order = [F.desc("score"), F.desc("a")]
    if top is not None:  # ties at the border stay until spelling decides
        ranked = ranked.withColumn("_r", F.rank().over(Window.partitionBy("lang").orderBy(*order))).where(F.col("_r") <= top).drop("_r")
    spelling = frequent.select("k", "word")
    for i, k in enumerate(KEYS):
        ranked = ranked.join(spelling.select(F.col("k").alias(k), F.col("word").alias(f"w{i}")), k, "left")
    ranked = ranked.withColumn("phrase", F.concat_ws(" ", *[f"w{i}" for i in range(DEPTH)]))
    ranked = ranked.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order, "phrase")).cast("long"))
    if top is not None:
        ranked = ranked.where(F.col("rank") <= top)
    return ranked.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
