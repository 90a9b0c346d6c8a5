"""Language-model scores from Brown classes.

The ``FREQUENT`` most frequent training words are units of their own, all other
words share ``SPELLINGS`` units by their ending.  Exchange clustering moves units
between classes as long as the likelihood of the class bigrams grows.  Then every
other training word, whatever its rank, leaves its spelling's unit: it is counted
with the classes next to it in all training texts and goes to the class where the
likelihood is highest.  Only words without training tokens stay by spelling.  A
text's score is

    sum_i log10 P(class_i | class_i-1) + log10 P(word_i | class_i)

with the class transition smoothed by the class unigram and the emission by
add-``ADD`` counts of the single words, an unseen word included.

Counts cover all training words: texts are dealt to buckets by hash, a bucket
sends its distinct words and their neighbours' classes as arrays to ranges of
hashes, a range sums them and answers each bucket with the totals and classes of
its words in the same order.  Each task holds one bucket's or one range's words;
what the driver gets is bounded by the number of units.  Class bigrams are then
counted anew over the classes of all training texts.  Words are known by 64-bit hashes.

Defined results: a null text counts as empty, that is the end token alone; an
end token follows every text; repeated rows count and score as often as they
occur; an empty table gives no rows; without training rows all words are
unseen; only the key and the text are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .frames import fold, ship, written
from .textops import U64, span_hashes, text_slices, word_spans

FREQUENT = 640
SPELLINGS = 96
CLASSES = 48
PASSES = 4
ADD = 0.1
PRIOR = 40.0  # weight of the class unigram in a transition
BUCKET_BYTES = 8 << 20
BUCKETS_A_RANGE = 8
BUCKETS_A_CLASS_RANGE = 2  # words with their neighbours take more room
PART_WORDS = 1 << 16  # words of a range that are classified together
TEXTS = 1 << 10       # texts of a batch whose classes are read together
END = FREQUENT + SPELLINGS  # unit of the end token
UNITS = END + 1
RANGE_COLUMNS = {"names": np.uint64, "used": np.int32, "spell": np.uint8, "before": np.uint8, "before_n": np.int32,
                 "before_size": np.uint8, "after": np.uint8, "after_n": np.int32, "after_size": np.uint8}


def words_of(buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, hash, spelling) of every word, A-Z lower-cased."""
    s, e, row = word_spans(buf, offs)
    h = span_hashes(buf, s, e, lower=True)
    from_end = span_hashes(buf, np.maximum(s, e - 3), e, lower=True)
    return row, h, (from_end % U64(SPELLINGS)).astype(np.uint8)


def _ranges(h: np.ndarray, n: int) -> np.ndarray:
    """Bounds, in sorted hashes, of the ``n`` equal ranges of all hashes."""
    step = (1 << 64) // n
    return np.searchsorted(h, np.array([i * step for i in range(1, n)], np.uint64)) if n > 1 else np.zeros(0, np.int64)


def _words(table: pa.Table):
    for lo, hi, buf, offs in text_slices(table["text"], 4 << 20):
        yield lo, hi, *words_of(buf, offs)


def _dealt_words(table: pa.Table) -> tuple[dict, list[np.ndarray], int]:
    """Distinct words of a bucket, sorted by hash (``names, used, spell``: hash,
    training count, spelling), the text row and place among the names of every
    word, and the bucket's number."""
    train = table["train"].to_numpy(zero_copy_only=False).astype(np.int64)
    parts = [(lo + row, h, sp) for lo, _, row, h, sp in _words(table)]
    row = np.concatenate([p[0] for p in parts] or [np.zeros(0, np.int64)])
    h = np.concatenate([p[1] for p in parts] or [np.zeros(0, np.uint64)])
    spell = np.concatenate([p[2] for p in parts] or [np.zeros(0, np.uint8)])
    names, first, at = np.unique(h, return_index=True, return_inverse=True)
    used = np.bincount(at, weights=train[row], minlength=len(names)).astype(np.int32)
    return {"names": names, "used": used, "spell": spell[first]}, [row, at], table["bucket"][0].as_py()


def _to_ranges(columns: dict[str, np.ndarray], names: np.ndarray, ranges: int, bucket: int, sizes: dict[str, np.ndarray]
               ) -> pa.Table:
    """One row a range that has words: ``range, bucket`` and the bytes of its
    part of every column.  A column in ``sizes`` has so many entries a word,
    others one."""
    cuts = _ranges(names, ranges)
    some = np.flatnonzero(np.diff(np.concatenate([[0], cuts, [len(names)]])))
    cols = {}
    for name, values in columns.items():
        at = np.concatenate([[0], np.cumsum(sizes[name])])[cuts] if name in sizes else cuts
        parts = np.split(values, at)
        cols[name] = pa.array([parts[i].tobytes() for i in some], pa.binary())
    return pa.table({"range": pa.array(some, pa.int32()), "bucket": pa.array([bucket] * len(some), pa.int32()), **cols})


def word_totals(dealt: DataFrame, ranges: int) -> DataFrame:
    """Rows of kind 1: a range's most frequent words; of kind 2: words and
    tokens by spelling."""
    def send(table: pa.Table) -> pa.Table:
        words, _, bucket = _dealt_words(table)
        return _to_ranges(words, words["names"], ranges, bucket, {})

    def total(table: pa.Table) -> pa.Table:
        names = np.frombuffer(b"".join(table["names"].to_pylist()), np.uint64)
        used = np.frombuffer(b"".join(table["used"].to_pylist()), np.int32)
        flat, first, at = np.unique(names, return_index=True, return_inverse=True)
        spell = np.frombuffer(b"".join(table["spell"].to_pylist()), np.uint8)[first]
        n = np.bincount(at, weights=used, minlength=len(flat)).astype(np.int64)
        top = np.lexsort((flat, -n))[:FREQUENT]
        top = top[n[top] > 0]
        kinds = np.bincount(spell[n > 0], minlength=SPELLINGS).astype(np.int64)
        tokens = np.bincount(spell, weights=n, minlength=SPELLINGS).astype(np.int64)
        blobs = [np.concatenate([flat[top].view(np.int64), n[top], spell[top].astype(np.int64)]).tobytes(),
                 np.concatenate([kinds, tokens]).tobytes()]
        return pa.table({"kind": pa.array([1, 2], pa.int32()), "blob": pa.array(blobs, pa.binary())})

    sent = dealt.groupBy("bucket").applyInArrow(send, "range int, bucket int, names binary, used binary, spell binary")
    return sent.groupBy("range").applyInArrow(total, "kind int, blob binary")


def _summed(blobs: DataFrame, size: int) -> np.ndarray:
    """Sum of the ``size`` numbers of each row, added up on the executors."""
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        whole = np.zeros(size, np.int64)
        for batch in batches:
            for blob in batch.column(0).to_pylist():
                whole += np.frombuffer(blob, np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(size)), pa.array(whole)], ["i", "n"])

    whole = np.zeros(size, np.int64)
    for r in blobs.mapInArrow(add, "i long, n long").groupBy("i").agg(F.sum("n").alias("n")).collect():
        whole[r["i"]] += r["n"]
    return whole


def vocabulary(totals: DataFrame, train_docs: int) -> dict:
    """Frequent words, counts by spelling, and the sizes N and V.  Frequent
    lists are cut down range by range before they reach the driver."""
    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for blob in batch.column(0).to_pylist():
                h, n, spell = np.frombuffer(blob, np.int64).reshape(3, -1)
                yield pa.RecordBatch.from_arrays([pa.array(h), pa.array(n), pa.array(spell)], ["h", "n", "spell"])

    top = (totals.where("kind = 1").select("blob").mapInArrow(split, "h long, n long, spell long")
           .orderBy(F.desc("n"), "h").limit(FREQUENT).toArrow().sort_by([("n", "descending"), ("h", "ascending")]))
    h, n, spell = (top[c].to_numpy() for c in ("h", "n", "spell"))
    whole = _summed(totals.where("kind = 2").select("blob"), 2 * SPELLINGS)
    kinds, tokens = whole[:SPELLINGS], whole[SPELLINGS:]
    size_v, size_n = int(kinds.sum()) + (train_docs > 0), int(tokens.sum()) + train_docs
    unit_words = np.zeros(UNITS, np.int64)
    unit_tokens = np.zeros(UNITS, np.int64)
    unit_words[FREQUENT:END] = kinds - np.bincount(spell, minlength=SPELLINGS)
    unit_tokens[FREQUENT:END] = tokens - np.bincount(spell, weights=n, minlength=SPELLINGS).astype(np.int64)
    unit_words[:len(h)], unit_tokens[:len(h)] = 1, n
    unit_words[END], unit_tokens[END] = 1, train_docs
    names = h.view(np.uint64)
    order = np.argsort(names)
    return {"names": names[order], "unit": order.astype(np.int64), "N": size_n, "V": size_v, "end": train_docs,
            "unit_words": unit_words, "unit_tokens": unit_tokens}


def units_of(vocab: dict, h: np.ndarray, spell: np.ndarray) -> np.ndarray:
    out = spell.astype(np.int64) + FREQUENT
    if len(vocab["names"]) and len(h):
        at = np.minimum(np.searchsorted(vocab["names"], h), len(vocab["names"]) - 1)
        hit = vocab["names"][at] == h
        out[hit] = vocab["unit"][at[hit]]
    return out


def _chains(row: np.ndarray, unit: np.ndarray, n: int, end: int = END) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, unit before, unit) of all tokens, the end of each row included;
    the end unit also stands before the first word."""
    size = np.bincount(row, minlength=n)
    ends = np.cumsum(size + 1) - 1
    token = np.full(len(unit) + n, end, np.int64)
    inner = np.ones(len(token), bool)
    inner[ends] = False
    token[inner] = unit
    before = np.empty_like(token)
    before[1:] = token[:-1]
    before[:1] = end
    return np.repeat(np.arange(n), size + 1), before, token


def unit_bigrams(train: DataFrame, vocab: dict) -> np.ndarray:
    """UNITS x UNITS counts over all training texts; each task sends one
    matrix in stripes, summed on the executors."""
    shared = train.sparkSession.sparkContext.broadcast(vocab)
    stripes = 8
    edges = np.linspace(0, UNITS, stripes + 1).astype(int)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.zeros(UNITS * UNITS, np.int64)
        for batch in batches:
            for lo, hi, row, h, spell in _words(pa.Table.from_batches([batch])):
                _, before, token = _chains(row, units_of(shared.value, h, spell), hi - lo)
                table += np.bincount(before * UNITS + token, minlength=UNITS * UNITS)
        table = table.reshape(UNITS, UNITS)
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(stripes), pa.int32()),
             pa.array([table[a:b].tobytes() for a, b in zip(edges[:-1], edges[1:], strict=True)], pa.binary())],
            ["stripe", "blob"])

    def add(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = 0
        for batch in batches:
            for blob in batch.column("blob"):
                total = total + np.frombuffer(blob.as_buffer(), np.int64)
        yield pa.RecordBatch.from_arrays([pa.array([key[0].as_py()], pa.int32()), pa.array([total.tobytes()], pa.binary())],
                                         ["stripe", "blob"])

    got = (train.select("text").mapInArrow(count, "stripe int, blob binary")
           .groupBy("stripe").applyInArrow(add, "stripe int, blob binary").collect())
    out = np.zeros((UNITS, UNITS), np.int64)
    for r in got:
        out[edges[r["stripe"]]:edges[r["stripe"] + 1]] = np.frombuffer(r["blob"], np.int64).reshape(-1, UNITS)
    return out


def _xlogx(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.maximum(x, 1.0))


def exchange(counts: np.ndarray, classes: int = CLASSES, passes: int = PASSES) -> np.ndarray:
    """Class of every unit; the last unit (the end) keeps a class of its own.

    Units start in order of frequency, the frequent ones alone; each is taken
    out and put where the log likelihood of the class bigrams is highest."""
    n = len(counts) - 1
    counts = counts.astype(np.float64)
    weight = counts.sum(axis=0)[:n]
    order = np.argsort(-weight, kind="stable")
    cls = np.full(n + 1, classes, np.int64)
    cls[order] = np.minimum(np.arange(n), classes - 1)
    member = np.eye(classes + 1)[cls]
    m = member.T @ counts @ member
    for _ in range(passes):
        moved = 0
        for u in order:
            if not weight[u] and not counts[u].any():
                continue
            old = cls[u]
            out = np.bincount(cls, weights=counts[u], minlength=classes + 1)
            into = np.bincount(cls, weights=counts[:, u], minlength=classes + 1)
            own = counts[u, u]
            out[old] -= own
            into[old] -= own
            m[old] -= out
            m[:, old] -= into
            m[old, old] -= own
            f = _xlogx(m)
            rows = _xlogx(m + out[None, :]) - f
            cols = _xlogx(m + into[:, None]) - f
            both = np.diag(m) + out + into + own
            gain = (rows.sum(axis=1) - np.diag(rows) + cols.sum(axis=0) - np.diag(cols) + _xlogx(both) - np.diag(f))
            # a class's own totals hold its tokens before and after u wherever u goes
            for side, more in ((m.sum(axis=1) + into, out.sum() + own), (m.sum(axis=0) + out, into.sum() + own)):
                gain -= _xlogx(side + more) - _xlogx(side)
            gain[classes] = -np.inf
            new = int(np.argmax(gain))
            if gain[new] <= gain[old] + 1e-9:
                new = int(old)
            cls[u] = new
            m[new] += out
            m[:, new] += into
            m[new, new] += own
            moved += new != old
        if not moved:
            break
    return cls


def class_bigrams(counts: np.ndarray, cls: np.ndarray) -> np.ndarray:
    member = np.eye(CLASSES + 1)[cls]
    return member.T @ counts @ member


def tables(m: np.ndarray, tokens: np.ndarray, kinds: np.ndarray) -> dict:
    """Log10 tables by class: transitions, and emission totals from the
    classes' tokens and distinct words."""
    prior = (m.sum(axis=0) + 0.5) / (m.sum() + 0.5 * len(m))
    step = np.log10((m + PRIOR * prior[None, :]) / (m.sum(axis=1, keepdims=True) + PRIOR))
    return {"step": step, "emit": np.log10(tokens + ADD * (kinds + 1))}


def fit(vocab: dict, counts: np.ndarray) -> dict:
    """Classes of the units and their log10 tables, emission totals by unit."""
    cls = exchange(counts)
    member = np.eye(CLASSES + 1)[cls]
    model = tables(class_bigrams(counts, cls), member.T @ vocab["unit_tokens"], member.T @ vocab["unit_words"])
    return {"class": cls, "step": model["step"], "emit": model["emit"][cls]}


def class_gains(m: np.ndarray, before: np.ndarray, after: np.ndarray) -> np.ndarray:
    """What each class adds to the log likelihood of the class bigrams for
    words with ``before`` and ``after`` counts (words x classes) of the classes
    next to them: the change by the word's own share in the class totals is
    left out, which a single word other than the frequent ones hardly moves."""
    row, col = m.sum(axis=1), m.sum(axis=0)
    log = np.log(m + 0.5)
    return (after @ (log - np.log(row + 0.5 * len(m))[:, None]).T + before @ (log - np.log(col + 0.5 * len(m))[None, :]))[:, :CLASSES]


def _neighbours(at: np.ndarray, cls: np.ndarray, words: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Number of distinct classes of each word, those classes and their counts,
    by word."""
    key, n = np.unique(at * (CLASSES + 1) + cls, return_counts=True)
    return np.bincount(key // (CLASSES + 1), minlength=words), (key % (CLASSES + 1)).astype(np.uint8), n.astype(np.int32)


def word_classes(dealt: DataFrame, ranges: int, vocab: dict, counts: np.ndarray) -> DataFrame:
    """The class of every word.  Units keep the class that the exchange gave
    them; every other training word is counted with the classes next to it in
    all training texts and goes to the class with the highest likelihood, a word
    that occurs in no training text to its spelling's class.

    Rows of kind 0: ``bucket, range`` with training counts and classes of the
    bucket's words, in order; of kind 1: training words by class."""
    cls = exchange(counts)
    shared = dealt.sparkSession.sparkContext.broadcast((vocab, cls, class_bigrams(counts, cls)))

    def send(table: pa.Table) -> pa.Table:
        v, unit_class, _ = shared.value
        words, (row, at), bucket = _dealt_words(table)
        names, some = words["names"], len(words["names"])
        known = np.append(unit_class[units_of(v, names, words["spell"])], CLASSES)
        whose, before, token = _chains(row, at, table.num_rows, some)
        use = table["train"].to_numpy(zero_copy_only=False)[whose]
        before, token = before[use], token[use]
        sizes = {}
        for name, own, other in (("before", token, before), ("after", before, token)):
            inner = own < some
            sizes[name], words[name], words[name + "_n"] = _neighbours(own[inner], known[other[inner]], some)
            sizes[name + "_n"] = sizes[name]
            words[name + "_size"] = sizes[name].astype(np.uint8)
        return _to_ranges(words, names, ranges, bucket, sizes)

    def classify(table: pa.Table) -> pa.Table:
        v, unit_class, m = shared.value
        got = {c: [np.frombuffer(x.as_buffer(), kind) for x in table[c]] for c, kind in RANGE_COLUMNS.items()}
        starts = {c: [np.concatenate([[0], np.cumsum(x, dtype=np.int64)]) for x in got[c + "_size"]] for c in ("before", "after")}
        buckets = range(table.num_rows)
        totals, classes = [[] for _ in buckets], [[] for _ in buckets]
        kinds = np.zeros(CLASSES + 1, np.int64)
        # words are taken in parts, in the order of their hashes
        every = np.sort(np.concatenate(got["names"]))
        edges = [*every[::PART_WORDS], None]
        del every
        for low, high in zip(edges[:-1], edges[1:], strict=True):
            lo = [int(np.searchsorted(x, low)) for x in got["names"]]
            hi = [len(x) if high is None else int(np.searchsorted(x, high)) for x in got["names"]]
            cut = {c: np.concatenate([got[c][i][lo[i]:hi[i]] for i in buckets]) for c in ("names", "used", "spell")}
            flat, first, at = np.unique(cut["names"], return_index=True, return_inverse=True)
            if not len(flat):
                continue
            spell = cut["spell"][first]
            n = np.bincount(at, weights=cut["used"], minlength=len(flat)).astype(np.int64)
            sides = []
            for c in ("before", "after"):
                entry = [np.repeat(np.arange(hi[i] - lo[i]), got[c + "_size"][i][lo[i]:hi[i]]) for i in buckets]
                shift = np.cumsum([0, *[hi[i] - lo[i] for i in buckets]])
                whose = at[np.concatenate([e + shift[i] for i, e in enumerate(entry)])]
                part = {x: np.concatenate([got[x][i][starts[c][i][lo[i]]:starts[c][i][hi[i]]] for i in buckets]) for x in (c, c + "_n")}
                sides.append(np.bincount(whose * (CLASSES + 1) + part[c], weights=part[c + "_n"], minlength=len(flat) * (CLASSES + 1))
                             .reshape(len(flat), -1))
            unit = units_of(v, flat, spell)
            moved = (unit >= FREQUENT) & (n > 0)
            own = unit_class[unit].astype(np.uint8)
            own[moved] = class_gains(m, *[x[moved] for x in sides]).argmax(axis=1)
            kinds += np.bincount(own[n > 0], minlength=CLASSES + 1)
            shift = np.cumsum([0, *[hi[i] - lo[i] for i in buckets]])
            for i in buckets:
                mine = at[shift[i]:shift[i + 1]]
                totals[i].append(n[mine])
                classes[i].append(own[mine])
        place = table["range"][0].as_py()
        join = lambda parts: b"".join(x.tobytes() for x in parts)
        return pa.table({"kind": pa.array([0] * len(buckets) + [1], pa.int32()),
                         "bucket": pa.array([*table["bucket"].to_pylist(), -1], pa.int32()),
                         "range": pa.array([place] * (len(buckets) + 1), pa.int32()),
                         "totals": pa.array([*map(join, totals), kinds.tobytes()], pa.binary()),
                         "classes": pa.array([*map(join, classes), b""], pa.binary())})

    sent = dealt.groupBy("bucket").applyInArrow(send, "range int, bucket int, " + ", ".join(f"{c} binary" for c in RANGE_COLUMNS))
    return sent.groupBy("range").applyInArrow(classify, "kind int, bucket int, range int, totals binary, classes binary")


def read_classes(dealt: DataFrame, answers: DataFrame, vocab: dict) -> DataFrame:
    """``doc_id, train, n_tokens, n_known, base_score, word_log, classes``: a
    text's words as classes, a byte each, and the sum of their log counts."""
    shared = dealt.sparkSession.sparkContext.broadcast({k: vocab[k] for k in ("N", "V", "end")})

    def read(left: pa.Table, right: pa.Table) -> pa.Table:
        v = shared.value
        _, (row, at), _ = _dealt_words(left)
        place, n = np.argsort(right["range"].to_numpy()), left.num_rows
        totals, classes = (np.frombuffer(b"".join(right[c].take(place).to_pylist()), kind)
                           for c, kind in (("totals", np.int64), ("classes", np.uint8)))
        size = np.bincount(row, minlength=n)
        logc = np.bincount(row, weights=np.log10(totals[at] + ADD), minlength=n).astype(float)
        floor = np.log10(v["N"] + ADD * (v["V"] + 1))
        tokens = classes[at].tobytes()
        ends = np.cumsum(size).tolist()
        return pa.table({
            "doc_id": left["doc_id"], "train": left["train"], "n_tokens": pa.array(size + 1, pa.int64()),
            "n_known": pa.array(np.bincount(row, weights=totals[at] > 0, minlength=n).astype(np.int64) + (v["end"] > 0)),
            "base_score": logc + np.log10(v["end"] + ADD) - floor * (size + 1), "word_log": logc,
            "classes": pa.array([tokens[a:b] for a, b in zip([0, *ends[:-1]], ends, strict=True)], pa.binary())})

    return dealt.groupBy("bucket").cogroup(answers.groupBy("bucket")).applyInArrow(
        read, "doc_id long, train boolean, n_tokens long, n_known long, base_score double, word_log double, classes binary")


def _class_chains(blobs: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    blobs = blobs.to_pylist()
    row = np.repeat(np.arange(len(blobs)), [len(x) for x in blobs])
    return _chains(row, np.frombuffer(b"".join(blobs), np.uint8), len(blobs), CLASSES)


def counted_classes(texts: DataFrame) -> np.ndarray:
    """Class bigrams of the training texts, one matrix a task, summed on the
    executors."""
    size = CLASSES + 1

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.zeros(size * size, np.int64)
        for batch in batches:
            for lo in range(0, batch.num_rows, TEXTS):
                _, before, token = _class_chains(batch.column(0).slice(lo, TEXTS))
                table += np.bincount(before * size + token, minlength=size * size)
        yield pa.RecordBatch.from_arrays([pa.array(range(size * size), pa.int32()), pa.array(table)], ["i", "n"])

    got = texts.where("train").select("classes").mapInArrow(count, "i int, n long").groupBy("i").agg(F.sum("n").alias("n")).collect()
    out = np.zeros(size * size)
    for r in got:
        out[r["i"]] = r["n"]
    return out.reshape(size, size)


def score_documents(docs: DataFrame, key: str = "doc_id", text: str = "text", modulus: int = 10, held: int = 0) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score,
    perplexity`` of every whole text."""
    spark = docs.sparkSession
    ship(spark)
    rows = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"))
    # a null key has no remainder: such rows train and are not held out
    rows = rows.withColumn("train", F.coalesce(fold("doc_id", modulus) != held, F.lit(True)))
    sizes = rows.agg(F.sum(F.octet_length("text")).alias("bytes"), F.count_if("train").alias("docs")).first()
    buckets = max(1, -(-(sizes["bytes"] or 0) // BUCKET_BYTES))
    ranges = max(1, -(-buckets // BUCKETS_A_RANGE))
    spread = F.pmod(F.xxhash64("doc_id", F.length("text")), F.lit(buckets)).cast("int")
    dealt = rows.withColumn("bucket", spread)
    vocab = vocabulary(written(word_totals(dealt, ranges), "word-totals"), int(sizes["docs"]))
    classes = word_classes(dealt, max(1, -(-buckets // BUCKETS_A_CLASS_RANGE)), vocab, unit_bigrams(rows.where("train"), vocab))
    answers = written(classes, "word-classes")
    texts = written(read_classes(dealt, answers.where("kind = 0").select("bucket", "range", "totals", "classes"), vocab), "word-class-texts")
    m = counted_classes(texts)
    kinds = _summed(answers.where("kind = 1").select("totals"), CLASSES + 1)
    kinds[CLASSES] += vocab["end"] > 0
    model = spark.sparkContext.broadcast(tables(m, m.sum(axis=0), kinds))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = model.value
        # an end has no word of its own to be drawn
        emit = np.append(t["emit"][:CLASSES], 0.0)
        for batch in batches:
            for lo in range(0, batch.num_rows, TEXTS):
                part = batch.slice(lo, TEXTS)
                whose, before, token = _class_chains(part.column("classes"))
                own = np.bincount(whose, weights=t["step"][before, token] - emit[token], minlength=part.num_rows)
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(own + part.column("word_log").to_numpy())] + [
                    part.column(c) for c in ("train", "n_tokens", "n_known", "base_score")],
                    ["doc_id", "score", "train", "n_tokens", "n_known", "base_score"])

    scored = texts.mapInArrow(score, "doc_id long, score double, train boolean, n_tokens long, n_known long, base_score double")
    return scored.select("doc_id", (~F.col("train")).alias("held_out"), "n_tokens", "n_known",
                         F.lit(vocab["N"]).cast("long").alias("train_tokens"), "base_score", "score",
                         F.pow(F.lit(10.0), F.least(-F.col("score") / F.col("n_tokens"), F.lit(300.0))).alias("perplexity"))
