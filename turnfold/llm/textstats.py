"""Counts of one pass over whole texts, shared by the quality operators."""

from __future__ import annotations

import numpy as np

from .textops import per_row, repeated, row_of, span_hashes, windows, word_spans

BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
EXTRA = ["n_chars_all", "n_lines", "n_upper", "n_lower", "n_digits", "n_punct", "n_bangs", "n_other_ascii",
         "n_distinct_words", "n_short_words", "n_long_words", "n_capital_words", "n_same_next"]
COUNTS = BASE + EXTRA

_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True


def _mask(chars: bytes) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(chars)] = True
    return out


_UPPER = _mask(bytes(range(65, 91)))
_LOWER = _mask(bytes(range(97, 123)))
_DIGIT = _mask(b"0123456789")
_PUNCT = _mask(b".,;:'\"()-")
_BANG = _mask(b"!?")
_OTHER = _mask(b"@/\\_=+~^`[]{}")
_LEAD = np.ones(256, bool)
_LEAD[0x80:0xC0] = False


def line_spans(buf, offs):
    """(start, end, row) of every line: texts cut at each newline byte."""
    n_rows = len(offs) - 1
    cuts = np.flatnonzero(buf == 10)
    starts = np.concatenate([offs[:-1], cuts + 1])
    ends_rows = np.concatenate([np.arange(n_rows), row_of(offs, cuts) if len(cuts) else cuts])
    order = np.lexsort((starts, ends_rows))
    starts, rows = starts[order], ends_rows[order]
    ends = np.empty(len(starts), np.int64)
    if len(starts):
        nxt_same = np.zeros(len(starts), bool)
        nxt_same[:-1] = rows[:-1] == rows[1:]
        ends[:-1] = np.where(nxt_same[:-1], starts[1:] - 1, offs[rows[:-1] + 1])
        ends[-1] = offs[rows[-1] + 1]
    return starts, ends, rows


def count_texts(buf: np.ndarray, offs: np.ndarray) -> dict[str, np.ndarray]:
    """All ``COUNTS`` of every text of a slice, as int64 arrays."""
    n = len(offs) - 1
    s, e, row = word_spans(buf, offs)
    tally = lambda at, mask=None: np.bincount(at if mask is None else at[mask], minlength=n).astype(np.int64)
    out = {"n_words": tally(row)}
    lead = np.zeros(len(buf) + 1, np.int64)
    np.cumsum(_LEAD[buf], out=lead[1:])
    length = lead[e] - lead[s]
    out["word_chars"] = np.bincount(row, weights=length, minlength=n).astype(np.int64)
    out["n_chars_all"] = lead[offs[1:]] - lead[offs[:-1]]
    for name, mask in (("n_symbols", _SYMBOL), ("n_upper", _UPPER), ("n_lower", _LOWER), ("n_digits", _DIGIT),
                       ("n_punct", _PUNCT), ("n_bangs", _BANG), ("n_other_ascii", _OTHER)):
        out[name] = per_row(mask[buf], offs)
    h = span_hashes(buf, s, e, lower=False)
    _, later = repeated(row, h)
    out["n_distinct_words"] = tally(row, ~later)
    out["n_short_words"] = tally(row, length <= 3)
    out["n_long_words"] = tally(row, length >= 12)
    out["n_capital_words"] = tally(row, _UPPER[buf[s]] if len(s) else np.zeros(0, bool))
    same_next = np.zeros(len(h), bool)
    if len(h) > 1:
        same_next[1:] = (h[1:] == h[:-1]) & (row[1:] == row[:-1])
    out["n_same_next"] = tally(row, same_next)
    win, first = windows(h, row, 3)
    again, _ = repeated(row[first], win)
    hit = np.zeros(len(h), bool)
    for j in range(3):
        hit[first[again] + j] = True
    out["n_repeat_words"] = tally(row, hit)
    ls, le, lr = line_spans(buf, offs)
    word_at = np.zeros(len(buf) + 1, np.int64)
    if len(s):
        word_at[s + 1] = 1
    seen = np.cumsum(word_at)
    # a line's words begin inside it: lines end at newlines, which are white space
    filled = (seen[le] - seen[ls] > 0) if len(ls) else np.zeros(0, bool)
    ls, le, lr = ls[filled], le[filled], lr[filled]
    _, later = repeated(lr, span_hashes(buf, ls, le, lower=False))
    out["n_lines"] = tally(lr)
    out["n_dup_lines"] = tally(lr, later)
    return out


def ratios(c: dict[str, np.ndarray]) -> np.ndarray:
    """Rule statistics as an (n, d) matrix: shares of characters, words and
    lines, each smoothed so that a very short text gives a mild value."""
    f = {k: v.astype(np.float64) for k, v in c.items()}
    chars, words, lines = f["n_chars_all"] + 40.0, f["n_words"] + 8.0, f["n_lines"] + 2.0
    letters = f["n_upper"] + f["n_lower"] + 40.0
    return np.column_stack([
        f["n_symbols"] / chars, f["n_upper"] / letters, f["n_digits"] / chars, f["n_punct"] / chars,
        f["n_bangs"] / chars, f["n_other_ascii"] / chars, f["n_repeat_words"] / words, f["n_dup_lines"] / lines,
        f["n_same_next"] / words, f["n_capital_words"] / words, f["n_short_words"] / words,
        f["n_long_words"] / words, (f["word_chars"] + 40.0) / words])


RATIO_NAMES = ["symbol_share", "upper_share", "digit_share", "punct_share", "bang_share", "other_share",
               "repeat_share", "dup_line_share", "same_next_share", "capital_share", "short_share", "long_share",
               "mean_word"]
