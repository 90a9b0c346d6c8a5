"""Token ids of whole texts by the ``tokenizers`` library.

A byte-level tokenizer first cuts a text into words, numbers, signs and white
space, and joins nothing across such a cut.  Texts are therefore cut where one
must be, each distinct piece of a batch is encoded once, and the ids are put
together again.  A worker remembers pieces in two generations: when the young
one is full it becomes the old one, and what is met again moves up, so
frequent pieces stay and those met once go.  Texts that hold the text of an
added token (it becomes that token, as by the library's default) are encoded
in one go.
"""

from __future__ import annotations

import re
from itertools import repeat

import numpy as np
import pyarrow as pa

TOKENIZER = "byte_bpe_50k.json"
REMEMBERED = 150_000  # pieces of a generation
# white space other than blank and newline, by the Unicode property, and the separators that some libraries add
_OTHER_SPACE = re.compile("[\t\x0b\x0c\r\x1c-\x1f\x85\xa0\u1680\u180e\u2000-\u200b\u2028\u2029\u202f\u205f\u3000\ufeff]")
_OPEN: dict[str, Encoder] = {}

_INK = np.zeros(256, bool)
_INK[0x21:0x7F] = True
_LETTER = np.zeros(256, bool)
_LETTER[65:91] = _LETTER[97:123] = True
_SIGN = _INK.copy()
_SIGN[48:58] = _SIGN[65:91] = _SIGN[97:123] = False
_SIGN[ord("'")] = False  # it may open a contraction
_LEAD = np.zeros(256, bool)
_LEAD[0xC3:0xE0] = True  # of two-byte characters, none of them white space


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def piece_starts(buf: np.ndarray, offs: np.ndarray, fine: bool) -> np.ndarray:
    """Places where every byte-level tokenizer cuts, text starts among them:
    a blank behind a character that is not white space; if ``fine`` also a
    newline there, a sign behind an ASCII letter, an ASCII letter behind a
    sign (of several signs no one knows), and what follows a lone newline."""
    n = len(buf)
    cut = np.zeros(n, bool)
    if n > 1:
        ink = _INK[buf]
        ink[1:] |= (buf[1:] >= 0x80) & (buf[1:] < 0xC0) & _LEAD[buf[:-1]]
        cut[1:] = ink[:-1] & (buf[1:] == 0x20)
        if fine:
            line = buf == 0x0A
            cut[1:] |= ink[:-1] & line[1:]
            cut[1:] |= _LETTER[buf[:-1]] & _SIGN[buf[1:]]
            cut[1:] |= _SIGN[buf[:-1]] & _LETTER[buf[1:]]
            cut[2:] |= ink[:-2] & line[1:-1] & ink[2:]
    cut[offs[:-1][offs[1:] > offs[:-1]]] = True
    return np.flatnonzero(cut)


def distinct_pieces(texts: pa.Array, fine: bool) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """(distinct pieces, place of each piece among them, pieces of each text)."""
    from .textops import buffer_of

    buf, offs = buffer_of(texts)
    starts = piece_starts(buf, offs, fine)
    ends = np.append(starts, len(buf)).astype(np.int64)
    pieces = pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(ends), pa.py_buffer(buf))
    coded = pieces.dictionary_encode()
    return coded.dictionary, np.asarray(coded.indices), np.diff(np.searchsorted(starts, offs))


class Pool:
    """Id lists of remembered pieces, side by side in one array."""

    def __init__(self):
        self.table: dict[str, int] = {}
        self.ids = np.zeros(1 << 16, np.uint32)
        self.offset = np.zeros(1 << 14, np.int64)
        self.length = np.zeros(1 << 14, np.int64)
        self.used = 0

    def add(self, pieces: list[str], flat: np.ndarray, sizes: np.ndarray) -> None:
        first, need = len(self.table), self.used + len(flat)
        while need > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros_like(self.ids)])
        while first + len(pieces) > len(self.offset):
            self.offset = np.concatenate([self.offset, np.zeros_like(self.offset)])
            self.length = np.concatenate([self.length, np.zeros_like(self.length)])
        self.ids[self.used:need] = flat
        self.offset[first:first + len(pieces)] = self.used + np.cumsum(sizes) - sizes
        self.length[first:first + len(pieces)] = sizes
        self.used = need
        self.table.update(zip(pieces, range(first, first + len(pieces)), strict=True))

    def get(self, code: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Flat ids and lengths of pieces by place."""
        size = self.length[code]
        total = np.cumsum(size)
        at = np.repeat(self.offset[code] - (total - size), size) + np.arange(total[-1] if len(total) else 0)
        return self.ids[at], size


class PieceMemory:
    """Ids of pieces by ``encode`` (list of pieces to flat ids and lengths),
    remembered in two generations."""

    def __init__(self, encode, generation: int = REMEMBERED):
        self.encode, self.generation = encode, generation
        self.young, self.old = Pool(), Pool()

    def lists(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Flat ids and lengths of distinct pieces."""
        if len(self.young.table) > self.generation:
            self.young, self.old = Pool(), self.young
        n = len(pieces)
        code = np.fromiter(map(self.young.table.get, pieces, repeat(-1)), np.int64, n)
        absent = np.flatnonzero(code < 0)
        if len(absent):
            missing = [pieces[i] for i in absent]
            known = np.fromiter(map(self.old.table.get, missing, repeat(-1)), np.int64, len(missing))
            again, new = np.flatnonzero(known >= 0), np.flatnonzero(known < 0)
            first = len(self.young.table)
            self.young.add([missing[i] for i in again], *self.old.get(known[again]))
            if len(new):
                unknown = [missing[i] for i in new]
                self.young.add(unknown, *self.encode(unknown))
            code[absent[np.concatenate([again, new])]] = first + np.arange(len(missing))
        return self.young.get(code)


def spread(flat: np.ndarray, size: np.ndarray, index: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ids of texts from those of distinct pieces: flat ids and lengths."""
    begin = np.cumsum(size) - size
    own = size[index]
    total = np.cumsum(own)
    at = np.repeat(begin[index] - (total - own), own) + np.arange(total[-1] if len(total) else 0)
    ends = np.concatenate([[0], total])[np.concatenate([[0], np.cumsum(counts)])]
    return flat[at], np.diff(ends)


class Encoder:
    """Encodes lists of texts; ids as one flat uint32 array and lengths."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.added = sorted({t.content for t in self.tokenizer.get_added_tokens_decoder().values()})
        newline = self.tokenizer.encode("\n", add_special_tokens=False).ids
        self.newline = newline[0] if len(newline) == 1 else None
        self.memory = PieceMemory(self._learn)

    def _ids(self, part: list[str], as_lines: bool) -> tuple[np.ndarray, np.ndarray]:
        """Flat ids and lengths.  Pieces with at most one blank, in front, can
        be encoded as lines of one text: a newline before a blank or a word is
        a token of its own, and none is inside such a piece."""
        if not as_lines:
            got = [e.ids for e in self.tokenizer.encode_batch_fast(part, add_special_tokens=False)]
            sizes = np.fromiter(map(len, got), np.int64, len(got))
            return np.fromiter((i for ids in got for i in ids), np.uint32, int(sizes.sum())), sizes
        ids = np.array(self.tokenizer.encode_batch_fast(["\n".join(part)], add_special_tokens=False)[0].ids, np.uint32)
        ends = np.append(np.flatnonzero(ids == self.newline), len(ids))
        return ids[ids != self.newline], np.diff(ends, prepend=-1) - 1

    def _learn(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        single = np.fromiter((self.newline is not None and "\n" not in p and not p.startswith("  ") and not p.endswith(" ")
                              and not _OTHER_SPACE.search(p) for p in pieces), bool, len(pieces))
        flats, sizes, order = [], [], []
        for as_lines, step in ((True, 512), (False, 4096)):
            own = np.flatnonzero(single == as_lines)
            for lo in range(0, len(own), step):
                flat, size = self._ids([pieces[i] for i in own[lo:lo + step]], as_lines)
                flats.append(flat)
                sizes.append(size)
            order.append(own)
        place = np.empty(len(pieces), np.int64)
        place[np.concatenate(order)] = np.arange(len(pieces))
        return spread(np.concatenate(flats), np.concatenate(sizes), place, np.ones(len(pieces), np.int64))

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        whole = {i: np.array(self.tokenizer.encode(t, add_special_tokens=False).ids, np.uint32)
                 for i, t in enumerate(texts) if any(a in t for a in self.added)}
        pieces, index, counts = distinct_pieces(pa.array(["" if i in whole else t for i, t in enumerate(texts)], pa.string()), fine=True)
        flat, lengths = spread(*self.memory.lists(pieces.to_pylist()), index, counts)
        if whole:
            ends = np.concatenate([[0], np.cumsum(lengths)])
            parts = [whole.get(i, flat[ends[i]:ends[i + 1]]) for i in range(len(texts))]
            return np.concatenate(parts), np.fromiter(map(len, parts), np.int64, len(parts))
        return flat, lengths


def encoder(path: str) -> Encoder:
    """One encoder per worker process and path."""
    if path not in _OPEN:
        _OPEN[path] = Encoder(path)
    return _OPEN[path]


def encode_batches(column: pa.Array, path: str, end_id: int, max_chars: int = 2 << 20):
    """(lo, hi, ids, lengths) of row ranges of a text column, ``end_id`` put
    behind every text; null counts as empty."""
    own = encoder(path)
    texts = [t or "" for t in column.to_pylist()]
    lo = 0
    while lo < len(texts):
        hi, chars = lo, 0
        while hi < len(texts) and (hi == lo or chars + len(texts[hi]) <= max_chars):
            chars += len(texts[hi])
            hi += 1
        ids, lengths = own.encode(texts[lo:hi])
        ends = np.cumsum(lengths + 1)
        out = np.empty(int(ends[-1]), np.uint32)
        out[ends - 1] = end_id
        mask = np.ones(len(out), bool)
        mask[ends - 1] = False
        out[mask] = ids
        yield lo, hi, out, lengths + 1
        lo = hi
