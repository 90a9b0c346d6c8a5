"""Alignment of the tokens of two tokenizers on the same texts.

A is a byte-level tokenizer over space + text, B a sentencepiece model over
the text (it puts the space in front itself).  Both cut the same bytes, so an
A and a B token that end at the same byte of a document close a group.

Work inside a task is Arrow's: both sides are list columns, flattened with
their parent indices; token sizes become ends by a cumulative sum less the
sum before the document; an Acero hash join on (document, end) gives the
links, whose id pairs are counted by block of documents as they come.  Spark
adds the blocks' counts up, finds the highest count of each B id, and brings
the pairs that a block holds back to the block, where they are looked up.  So
only distinct pairs of a block travel for the counts, never single links.

Defined results: null and empty texts, and those whose joined token bytes
differ from space + text on either side (a text with U+2581 does), have no
tokens: zeros and an empty ``groups_sha256``.  Special tokens' strings are
plain text.  Repeated rows and ids, and null ids, are rows of their own;
other columns are not read; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .frames import written
from .idtokens import TOKENIZER, PieceMemory, distinct_pieces, spread, tokenizer_path

PIECES = "piece_bpe_32k.model"
SLICE = 1 << 19  # characters of text that a task aligns at once; a longer text is a slice of its own
SLICES = 16      # of a task that share a block, whose counts are kept apart
SHIFT = 40  # bits of a document-end key that hold the byte
ROW = ("block long, doc_id long, n_a long, n_b long, n_groups long, groups_sha256 string, pairs array<long>, "
       "held array<long>, counts array<long>")
COLUMNS = ["block", "doc_id", "n_a", "n_b", "n_groups", "groups_sha256", "pairs", "held", "counts"]
_OPEN: dict[tuple[str, str], tuple] = {}


def byte_level_alphabet() -> dict[str, int]:
    """Byte-level tokenizers write each byte as a printable character: those
    that print stand for themselves, the others for 256 and up, in order."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(others)}


class Side:
    """A tokenizer: ids of texts, and the bytes of every id.  Neither side
    joins a character and the blank after it, so distinct pieces are encoded
    once (``idtokens.PieceMemory``)."""

    def __init__(self, token_bytes: list[bytes], fine: bool):
        self.bytes = pa.array(token_bytes, pa.large_binary())
        self.sizes = pc.binary_length(self.bytes).cast(pa.int64())
        self.memory, self.fine = PieceMemory(self.encode), fine
        digits = max(len(str(len(token_bytes))), 1)
        text = [str(i).rjust(digits) for i in range(len(token_bytes))]
        self.decimal = np.frombuffer("".join(text).encode(), np.uint8).reshape(-1, digits)

    def encode(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        got = self.ids(pieces)
        sizes = np.fromiter(map(len, got), np.int64, len(got))
        return np.fromiter(chain.from_iterable(got), np.uint32, int(sizes.sum())), sizes

    def lists(self, spaced: pa.Array) -> pa.Array:
        """Ids of texts that start with the added space."""
        pieces, index, counts = distinct_pieces(spaced, self.fine)
        flat, lengths = spread(*self.memory.lists(pieces.to_pylist()), index, counts)
        offsets = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)
        return pa.ListArray.from_arrays(offsets, pa.array(flat.astype(np.int32)))

    def joined(self, lists: pa.Array) -> tuple[bytes, np.ndarray]:
        """Joined token bytes of all texts and the place behind each text."""
        flat = pc.take(self.bytes, pc.list_flatten(lists))
        ends = np.frombuffer(flat.buffers()[1], np.int64)[:len(flat) + 1]
        return flat.buffers()[2].to_pybytes() if ends[-1] else b"", ends[np.asarray(lists.offsets)[1:]]


class ByteLevel(Side):
    """The ids of a byte-level BPE file: its vocabulary numbers the merges in
    rank order, so it is a rank table over bytes; added tokens are left out."""

    def __init__(self, path: str):
        import public_tokenizers
        import tiktoken

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        added = {t["content"] for t in spec["added_tokens"]}
        alphabet = byte_level_alphabet()
        ranks = {bytes(alphabet[c] for c in token): i for token, i in spec["model"]["vocab"].items() if token not in added}
        self.encoding = tiktoken.Encoding(path, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        table = [b""] * (max(ranks.values()) + 1)
        for token, i in ranks.items():
            table[i] = token
        super().__init__(table, fine=True)

    def ids(self, pieces: list[str]) -> list[list[int]]:
        return list(map(self.encoding.encode_ordinary, pieces))


class Pieces(Side):
    """A sentencepiece model with byte fallback.  It puts the space in front
    itself, so a piece goes in without the one it starts with; of an empty
    text it makes nothing, so a lone blank has its ids from a word before it."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        names = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        if any("\u2581" in p.lstrip("\u2581") for p in names):
            raise ValueError("the model joins a character and the space after it")
        word, longer = self.model.encode(["x", "x "])
        self.blank = longer[len(word):]  # of a blank at the end of a text
        super().__init__([bytes([int(p[3:5], 16)]) if self.model.is_byte(i) else p.replace("\u2581", " ").encode()
                          for i, p in enumerate(names)], fine=False)

    def ids(self, pieces: list[str]) -> list[list[int]]:
        got = self.model.encode([p[1:] for p in pieces], num_threads=1)
        return [ids if len(p) > 1 else self.blank for p, ids in zip(pieces, got, strict=True)]


def sides(path_a: str, path_b: str) -> tuple[Side, Side]:
    """Both tokenizers, opened once per worker process."""
    if (path_a, path_b) not in _OPEN:
        _OPEN[path_a, path_b] = (ByteLevel(path_a), Pieces(path_b))
    return _OPEN[path_a, path_b]


def without(lists: pa.Array, rows: np.ndarray) -> pa.Array:
    """The lists, those of ``rows`` (a mask) emptied."""
    sizes = np.asarray(pc.list_value_length(lists))
    keep = np.repeat(~rows, sizes)
    offsets = np.concatenate([[0], np.cumsum(np.where(rows, 0, sizes))]).astype(np.int32)
    return pa.ListArray.from_arrays(offsets, pc.list_flatten(lists).filter(pa.array(keep)))


def token_table(side: Side, lists: pa.Array, name: str) -> pa.Table:
    """``end, <name>, at_<name>``: every token by its document-end key (number
    of the document, byte behind the token inside it), its id and its place in
    the flat list."""
    ids, doc = pc.list_flatten(lists), pc.list_parent_indices(lists).cast(pa.int64())
    total = pc.cumulative_sum(pc.take(side.sizes, ids))
    before = np.concatenate([[0], np.asarray(total)])[np.asarray(lists.offsets)[:-1]]
    end = pc.subtract(total, pc.take(pa.array(before), doc))
    key = pc.bit_wise_or(pc.shift_left(doc, pa.scalar(SHIFT, pa.int64())), end)
    return pa.table({"end": key, name: ids, f"at_{name}": pa.array(np.arange(len(ids)))})


def groups_of(last: np.ndarray, n: int) -> np.ndarray:
    """Number of the group of each of ``n`` tokens from the groups' last ones."""
    mark = np.zeros(n, np.int64)
    mark[last] = 1
    return np.cumsum(mark) - mark


def spell_groups(decimal: np.ndarray, a: np.ndarray, b: np.ndarray, group_a: np.ndarray, group_b: np.ndarray,
                 doc_a: np.ndarray, doc_b: np.ndarray, n_docs: int) -> list[bytes]:
    """``a1,a2|b1;a3|b2,b3`` of every document; groups are numbered over all.
    ``decimal`` holds the ids' digits, blanks in front."""
    def last_of(x):
        last = np.ones(len(x), bool)
        last[:-1] = x[1:] != x[:-1]
        return last

    n_a, n_b = len(a), len(b)
    ids, after, doc = np.empty(n_a + n_b, np.int64), np.empty(n_a + n_b, np.uint8), np.empty(n_a + n_b, np.int64)
    groups = int(group_a[-1]) + 1 if n_a else 0  # the last token of a document always ends a group
    place_a = np.arange(n_a) + np.concatenate([[0], np.cumsum(np.bincount(group_b, minlength=groups))])[group_a]
    place_b = np.arange(n_b) + np.cumsum(np.bincount(group_a, minlength=groups))[group_b]
    ids[place_a], ids[place_b] = a, b
    doc[place_a], doc[place_b] = doc_a, doc_b
    after[place_a] = np.where(last_of(group_a), ord("|"), ord(","))
    after[place_b] = np.where(last_of(doc_b), 0, np.where(last_of(group_b), ord(";"), ord(",")))
    size = np.concatenate([(decimal > 32).sum(axis=1)[ids] + (after > 0), [0]])
    cut = np.concatenate([[0], np.cumsum(size[:-1])])[np.searchsorted(doc, np.arange(n_docs + 1))]
    parts = []
    for lo in range(0, len(ids), 1 << 18):
        grid = np.concatenate([decimal[ids[lo:lo + (1 << 18)]], after[lo:lo + (1 << 18), None]], axis=1)
        parts.append(grid[grid > 32].tobytes())
    whole = b"".join(parts)
    return [whole[cut[i]:cut[i + 1]] for i in range(n_docs)]


def align(texts: list[str | None], side_a: Side, side_b: Side) -> dict:
    """Counts, group spellings and links (id pairs in order, as lists) of texts."""
    texts = [t or "" for t in texts]
    spaced = pa.array([" " + t if t else "" for t in texts], pa.string())
    lists = [side_a.lists(spaced), side_b.lists(spaced)]
    bad = np.zeros(len(texts), bool)
    for side, own in zip((side_a, side_b), lists, strict=True):
        joined, ends = side.joined(own)
        lo = 0
        for i, (text, hi) in enumerate(zip(texts, ends.tolist(), strict=True)):
            bad[i] |= not text or joined[lo:hi] != b" " + text.encode()
            lo = hi
    lists = [without(x, bad) for x in lists]
    table_a, table_b = token_table(side_a, lists[0], "a"), token_table(side_b, lists[1], "b")
    links = table_a.join(table_b, "end", join_type="inner", use_threads=False).sort_by("end").combine_chunks()
    n = len(texts)
    a, b = np.asarray(lists[0].values), np.asarray(lists[1].values)
    doc_a, doc_b = (np.asarray(pc.list_parent_indices(x)) for x in lists)
    # a token is of the first group whose last token is not before it
    group_a, group_b = (groups_of(links[f"at_{x}"].to_numpy(), n) for x, n in (("a", len(a)), ("b", len(b))))
    decimal = max(side_a.decimal, side_b.decimal, key=len)
    spelled = spell_groups(decimal, a, b, group_a, group_b, doc_a, doc_b, n)
    per_doc = np.bincount(links["end"].to_numpy() >> SHIFT, minlength=n)
    pairs = links["a"].to_numpy().astype(np.int64) * len(side_b.bytes) + links["b"].to_numpy()
    return {"n_a": np.bincount(doc_a, minlength=n), "n_b": np.bincount(doc_b, minlength=n), "n_groups": per_doc,
            "spelled": spelled, "pairs": pa.ListArray.from_arrays(np.concatenate([[0], np.cumsum(per_doc)]).astype(np.int32), pa.array(pairs))}


def slices_of(texts: list[str | None], most: int = SLICE) -> Iterator[tuple[int, int]]:
    return slices_by([len(t or "") for t in texts], most)


def slices_by(sizes: list[int], most: int = SLICE) -> Iterator[tuple[int, int]]:
    lo = 0
    while lo < len(sizes):
        hi, chars = lo, 0
        while hi < len(sizes) and (hi == lo or chars + sizes[hi] <= most):
            chars += sizes[hi]
            hi += 1
        yield lo, hi
        lo = hi


def counted_row(block: int, counts: list[tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch:
    """A block's distinct id pairs and how often its links hold them."""
    held, at = np.unique(np.concatenate([c[0] for c in counts]), return_inverse=True)
    n = np.zeros(len(held), np.int64)
    np.add.at(n, at, np.concatenate([c[1] for c in counts]))
    offsets = np.array([0, len(held)], np.int32)
    none = [pa.nulls(1, t) for t in (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.list_(pa.int64()))]
    return pa.RecordBatch.from_arrays([pa.array([block]), *none, *[pa.ListArray.from_arrays(offsets, pa.array(x)) for x in (held, n)]], COLUMNS)


def aligned(docs: DataFrame, key: str = "doc_id", text: str = "text", path_a: str | None = None,
            path_b: str | None = None) -> DataFrame:
    """A row a document: ``block, doc_id, n_a, n_b, n_groups, groups_sha256,
    pairs``; a pair is A id times the number of B ids plus B id, one for each
    link, in order.  And a row a block: ``block, held, counts``, its distinct
    pairs and their links, the other columns null."""
    path_a, path_b = path_a or tokenizer_path(TOKENIZER), path_b or tokenizer_path(PIECES)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = sides(path_a, path_b)
        task, made, counts = TaskContext.get().partitionId(), 0, []
        for batch in batches:
            for lo, hi in slices_by(pc.fill_null(pc.utf8_length(batch.column(1)), 0).to_pylist()):
                block = (task << 32) + made // SLICES
                got = align(batch.column(1).slice(lo, hi - lo).to_pylist(), *own)
                digest = [hashlib.sha256(x).hexdigest() if x else "" for x in got["spelled"]]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(hi - lo, block)), batch.column(0).slice(lo, hi - lo)]
                    + [pa.array(got[c].astype(np.int64)) for c in ("n_a", "n_b", "n_groups")]
                    + [pa.array(digest, pa.string()), got["pairs"]] + 2 * [pa.nulls(hi - lo, pa.list_(pa.int64()))], COLUMNS)
                counts.append(np.unique(np.asarray(got["pairs"].values), return_counts=True))
                made += 1
                if made % SLICES == 0:
                    yield counted_row(block, counts)
                    counts = []
            pa.default_memory_pool().release_unused()
        if counts:
            yield counted_row(block, counts)

    return docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text")).mapInArrow(run, ROW)


def block_counts(rows: DataFrame) -> DataFrame:
    """``of, pair, n``: how often the links of a block hold an id pair."""
    return (rows.where("counts is not null").select("block", F.explode(F.arrays_zip("held", "counts")).alias("x"))
            .select(F.col("block").alias("of"), F.col("x.held").alias("pair"), F.col("x.counts").alias("n")))


def pair_counts(counted: DataFrame, n_b: int) -> DataFrame:
    """``pair, n, best``: corpus-wide counts of the linked id pairs, and
    whether a pair's count is the highest of its B id."""
    total = counted.groupBy("pair").agg(F.sum("n").alias("n")).withColumn("b", F.pmod("pair", F.lit(n_b)))
    highest = total.groupBy("b").agg(F.max("n").alias("highest"))  # one row for each B id, no more than n_b
    return total.join(F.broadcast(highest), "b").select("pair", "n", (F.col("n") == F.col("highest")).alias("best"))


def look_up(rows: DataFrame, known: DataFrame) -> DataFrame:
    """``rows`` with ``n_links, n_best, count_sum``; ``known`` holds ``of,
    pair, n, best`` for every pair of a block."""
    out = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"

    def run(docs: pa.Table, pairs: pa.Table) -> pa.Table:
        docs, pairs = docs.combine_chunks(), pairs.combine_chunks().sort_by("pair")
        lists = pa.concat_arrays(docs["pairs"].chunks) if docs.num_rows else pa.array([], pa.list_(pa.int64()))
        at = np.searchsorted(pairs["pair"].to_numpy(), np.asarray(pc.list_flatten(lists)))
        sizes = np.asarray(pc.list_value_length(lists))
        cut = np.concatenate([[0], np.cumsum(sizes)])

        def added(column):
            found = pairs[column].to_numpy(zero_copy_only=False).astype(np.int64)[at] if len(at) else np.zeros(0, np.int64)
            total = np.concatenate([[0], np.cumsum(found)])
            return pa.array(total[cut[1:]] - total[cut[:-1]])

        return pa.table({"doc_id": docs["doc_id"], "n_a": docs["n_a"], "n_b": docs["n_b"], "n_groups": docs["n_groups"],
                         "n_links": pa.array(sizes.astype(np.int64)), "n_best": added("best"), "count_sum": added("n"),
                         "groups_sha256": docs["groups_sha256"]})

    return rows.groupBy("block").cogroup(known.groupBy("of")).applyInArrow(run, out)


def align_documents(docs: DataFrame, key: str = "doc_id", text: str = "text", path_a: str | None = None,
                    path_b: str | None = None) -> DataFrame:
    """``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum,
    groups_sha256`` of every row."""
    rows = written(aligned(docs, key, text, path_a, path_b), "aligned")
    n_b = len(Pieces(path_b or tokenizer_path(PIECES)).bytes)
    counted = block_counts(rows)
    known = counted.select("of", "pair").join(pair_counts(counted, n_b), "pair")
    return look_up(rows.where("counts is null").drop("held", "counts"), known)
