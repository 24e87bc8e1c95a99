"""Fill-in-the-middle: texts cut in three at token boundaries and written in another order.

A text's boundaries are indexed by a piecewise-linear model of their offsets:
straight pieces from rank to offset that miss no boundary by more than
``ERROR`` code points, and the small differences from them. A cut is found by
its piece, predicted, and corrected by the difference stored for it.
"""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from courtside.llm.common import each_text

ERROR = 31
SEED = 42
# Of a hundred texts, so many are cut, and of a hundred that are cut, so many put the suffix first.
CUT_PERCENT = 50
SPM_PERCENT = 80
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
# Ranks a piece is tried over at first; code points looked at at once.
_FIRST_REACH = 64
_STEP = 1 << 20


def boundaries(text: str) -> np.ndarray:
    """Offsets, in code points, at which tokens end, with 0 before the first one.

    A token is a word with the white space before it, or white space at the end of the text.
    """
    ends, word = [np.zeros(1, np.int64)], False
    for at in range(0, len(text), _STEP):
        points = np.frombuffer(text[at : at + _STEP].encode("utf-32-le", "surrogatepass"), "<u4")
        words = (points != 32) & ((points < 9) | (points > 13))
        # A word ends before white space.
        ends.append(np.flatnonzero(np.r_[word, words[:-1]] & ~words) + at)
        word = words[-1]
    if text:
        ends.append(np.array([len(text)]))
    return np.concatenate(ends)


class RankIndex:
    """Offset of each rank, by straight pieces and what they miss."""

    def __init__(self, offsets: np.ndarray, error: int = ERROR):
        starts, bases, slopes = [], [], []
        at = 0
        while at < len(offsets):
            size, slope = self._piece(offsets, at, error)
            starts.append(at)
            bases.append(offsets[at])
            slopes.append(slope)
            at += size
        self.starts, self.bases, self.slopes = np.array(starts), np.array(bases), np.array(slopes)
        ranks = np.arange(len(offsets))
        missed = offsets - self._predicted(ranks, np.repeat(np.arange(len(starts)), np.diff([*starts, len(offsets)])))
        self.missed = missed.astype(np.min_scalar_type(-error - 2))

    @staticmethod
    def _piece(offsets: np.ndarray, at: int, error: int) -> tuple[int, float]:
        """Number of ranks from ``at`` on that one line through the first serves within ``error``, and its slope."""
        reach = _FIRST_REACH
        while True:
            rise = offsets[at + 1 : at + reach] - offsets[at]
            if not len(rise):
                return 1, 0.0
            run = np.arange(1, len(rise) + 1)
            steepest = np.minimum.accumulate((rise + error) / run)
            flattest = np.maximum.accumulate((rise - error) / run)
            broken = np.flatnonzero(flattest > steepest)
            last = broken[0] - 1 if len(broken) else len(rise) - 1
            if len(broken) or at + reach >= len(offsets):
                return int(last) + 2, float(steepest[last] + flattest[last]) / 2
            reach *= 2

    def _predicted(self, ranks: np.ndarray, piece: np.ndarray) -> np.ndarray:
        return self.bases[piece] + np.floor(self.slopes[piece] * (ranks - self.starts[piece])).astype(np.int64)

    def offset(self, rank: int) -> int:
        piece = np.searchsorted(self.starts, rank, "right") - 1
        return int(self._predicted(np.array([rank]), np.array([piece]))[0]) + int(self.missed[rank])


def _written(seed: int, cut_percent: int, spm_percent: int):
    def written(doc_id, text):
        text = text or ""
        drawn = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
        h1, h2, h3, h4 = (int(drawn[8 * i : 8 * i + 8], 16) for i in range(4))
        offsets = boundaries(text)
        n = len(offsets) - 1
        if not text or h3 % 100 >= cut_percent or any(mark in text for mark in (PREFIX, SUFFIX, MIDDLE)):
            return doc_id, n, "plain", None, None, text
        index = RankIndex(offsets)
        a, b = sorted(index.offset(h % (n + 1)) for h in (h1, h2))
        before, middle, after = text[:a], text[a:b], text[b:]
        if h4 % 100 < spm_percent:
            form, output = "spm", f"{SUFFIX}{after}{PREFIX}{before}{MIDDLE}{middle}"
        else:
            form, output = "psm", f"{PREFIX}{before}{SUFFIX}{after}{MIDDLE}{middle}"
        return doc_id, n, form, a, b - a, output

    return written


def fill_in_middle(docs: DataFrame, seed: int = SEED, cut_percent: int = CUT_PERCENT, spm_percent: int = SPM_PERCENT) -> DataFrame:
    """``docs`` (doc_id, text, any others) rewritten: doc_id, n, form, prefix_chars, middle_chars, output; a row per row.

    n is the number of tokens, and form is plain, psm (prefix, suffix, middle)
    or spm (suffix, prefix, middle); cuts and form follow from ``seed`` and doc_id
    alone. NULL and empty texts, and texts that contain one of the marks, stay
    plain; a NULL text has an empty output. Rows that repeat, and rows that
    share a doc_id, are rows of their own, cut at the same draws; a missing
    doc_id draws as an empty one. An empty table gives no rows.
    """
    schema = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string"
    return each_text(docs, _written(seed, cut_percent, spm_percent), ["doc_id", "text"], schema)


def restored(output: Column, form: Column) -> Column:
    """The text that an output was made of: its three parts, told apart by the marks, in their first order.

    Marks occur once each, as texts that contain one stay plain. NULL for a NULL output or form.
    """
    between = lambda a, b: F.substring_index(F.substring_index(output, b, 1), a, -1)
    middle = F.substring_index(output, MIDDLE, -1)
    return (
        F.when(form == "plain", output)
        .when(form == "psm", F.concat(between(PREFIX, SUFFIX), middle, between(SUFFIX, MIDDLE)))
        .when(form == "spm", F.concat(between(PREFIX, MIDDLE), middle, between(SUFFIX, PREFIX)))
    )
