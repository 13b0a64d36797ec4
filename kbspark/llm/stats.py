"""Counts of whole texts, for the quality rules and the quality classifier."""

from __future__ import annotations

import numpy as np

from . import words

_U = np.uint64
COUNTS = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "n_distinct", "n_upper", "n_letters", "n_digits", "n_shouts", "n_ended")


def _table(chars: bytes) -> np.ndarray:
    t = np.zeros(256, bool)
    t[list(chars)] = True
    return t


_SYMBOL, _SHOUT, _END = _table(b"#*$%&|<>"), _table(b"!"), _table(b".!?;:,\"')")
_UPPER, _DIGIT = _table(bytes(range(65, 91))), _table(bytes(range(48, 58)))
# a letter: A-Z, a-z, or the first byte of a character beyond ASCII
_LETTER = _table(bytes(range(65, 91)) + bytes(range(97, 123)) + bytes(range(0xC3, 256)))
_CHAR = ~_table(bytes(range(0x80, 0xC0)))


def text_counts(texts: list[bytes]) -> dict[str, np.ndarray]:
    """For each text: the counts named in COUNTS.

    n_lines: lines (between newlines) with a word; n_dup_lines: those equal to an earlier one;
    n_repeat_words: words in three-word windows found twice or more in the text; n_distinct: distinct
    words; n_ended: lines whose last character ends or breaks a sentence.
    """
    out = {k: np.zeros(len(texts), np.int64) for k in COUNTS}
    for lo, hi in words.batches(texts):
        own = texts[lo:hi]
        w = words.Words(own)
        n = hi - lo
        at = w.at.copy()
        at[-1] -= 1
        at = np.minimum(at, len(w.bytes))

        def total(mask: np.ndarray, at=at) -> np.ndarray:
            sums = np.concatenate([[0], np.cumsum(mask)])
            return sums[at[1:]] - sums[at[:-1]]

        def per(key: np.ndarray, doc: np.ndarray, n=n) -> np.ndarray:
            """How often each key occurs in its document."""
            _, back, c = np.unique(words.mix(key + doc.astype(_U) * _U(words.BASE)), return_inverse=True, return_counts=True)
            return back, c

        doc, h = w.doc, w.hashes()
        inside = ~words._SPACE[w.bytes]
        out["n_words"][lo:hi] = np.diff(w.first)
        out["word_chars"][lo:hi] = total(inside & _CHAR[w.bytes])
        for name, t in (("n_symbols", _SYMBOL), ("n_upper", _UPPER), ("n_letters", _LETTER), ("n_digits", _DIGIT), ("n_shouts", _SHOUT)):
            out[name][lo:hi] = total(t[w.bytes])
        if len(h):
            _, first = np.unique(words.mix(h + doc.astype(_U) * _U(words.BASE)), return_index=True)
            out["n_distinct"][lo:hi] = np.bincount(doc[first], minlength=n)
        if len(h) >= 3:
            run = words.windows(h, 3)
            whole = doc[:-2] == doc[2:]
            back, c = per(run[whole], doc[:-2][whole])
            places = np.flatnonzero(whole)[c[back] > 1]
            again = np.zeros(len(h), bool)
            for k in range(3):
                again[places + k] = True
            out["n_repeat_words"][lo:hi] = np.bincount(doc[again], minlength=n)
        lines = words.Words(own, newline=True)
        sums = np.concatenate([[0], np.cumsum(inside)])
        real = sums[lines.end] > sums[lines.start]
        ld = lines.doc[real]
        out["n_lines"][lo:hi] = np.bincount(ld, minlength=n)
        if len(ld):
            lh = lines.hashes()[real]
            _, first = np.unique(words.mix(lh + ld.astype(_U) * _U(words.BASE)), return_index=True)
            out["n_dup_lines"][lo:hi] = out["n_lines"][lo:hi] - np.bincount(ld[first], minlength=n)
            out["n_ended"][lo:hi] = np.bincount(ld[_END[lines.bytes[lines.end[real] - 1]]], minlength=n)
    return out
