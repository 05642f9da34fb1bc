"""Pre-tokens of byte-level BPE, found without a regular expression.

The split is that of the public pattern (contractions, letters, numbers, other signs, each with one blank
in front, and white space that leaves its last blank to what follows). Code points become symbols by table
lookups and by looking at their neighbours; a small automaton over the symbols tells where a pre-token
begins. Its transition functions are composed block by block (composition is associative), the functions of
the blocks are scanned, and a second pass runs all blocks at once from their true states.
"""

from __future__ import annotations

import unicodedata
from functools import cache

import numpy as np

# Classes of code points.
LETTER, NUMBER, SIGN, SPACE = 0, 1, 2, 3
# White space of the pattern's \s: fixed values.
WHITE = [0x9, 0xA, 0xB, 0xC, 0xD, 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]

# Symbols: the first four are the classes; white space here is any but the last before a sign or letter.
LAST_WHITE, LAST_BLANK, SHORT_CONTRACTION, LONG_CONTRACTION, NEW_TEXT = 4, 5, 6, 7, 8
# States: nothing open, a run of each class, an attached blank, one or two letters of a contraction to go.
OPEN, IN_LETTERS, IN_NUMBERS, IN_SIGNS, IN_SPACE, AFTER_BLANK, ONE_TO_GO, TWO_TO_GO = range(8)
STATES, SYMBOLS, BEGINS = 8, 9, 8
_RUN = {LETTER: IN_LETTERS, NUMBER: IN_NUMBERS, SIGN: IN_SIGNS, SPACE: IN_SPACE}


@cache
def classes() -> np.ndarray:
    """The class of each code point."""
    table = np.full(0x110000, SIGN, np.uint8)
    for cp in range(0x110000):
        kind = unicodedata.category(chr(cp))[0]
        if kind == "L":
            table[cp] = LETTER
        elif kind == "N":
            table[cp] = NUMBER
    table[WHITE] = SPACE
    return table


def _step(state: int, symbol: int) -> int:
    """The next state, plus ``BEGINS`` if a pre-token begins at this symbol."""
    if symbol == NEW_TEXT:
        return OPEN
    if symbol == LAST_WHITE:
        return OPEN + BEGINS
    if symbol == LAST_BLANK:
        return AFTER_BLANK + BEGINS
    if symbol == LETTER and state in (ONE_TO_GO, TWO_TO_GO):
        return OPEN if state == ONE_TO_GO else ONE_TO_GO
    if symbol in (SHORT_CONTRACTION, LONG_CONTRACTION):
        if state in (IN_SIGNS, AFTER_BLANK):
            return IN_SIGNS
        return (ONE_TO_GO if symbol == SHORT_CONTRACTION else TWO_TO_GO) + BEGINS
    run = _RUN[symbol]
    goes_on = state == run or (state == AFTER_BLANK and symbol != SPACE)
    return run + (0 if goes_on else BEGINS)


_NEXT = np.array([[_step(s, x) for x in range(SYMBOLS)] for s in range(STATES)], np.uint8)


def _symbols(cp: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Symbols of the code points; ``first`` marks the texts' first ones."""
    kind = classes()[cp]
    n = len(cp)
    last = np.ones(n, bool)  # of its text
    last[:-1] = first[1:]
    white = kind == SPACE
    before_other = np.zeros(n, bool)
    before_other[:-1] = white[:-1] & ~white[1:]
    before_other &= ~last
    out = kind.copy()
    out[before_other] = LAST_WHITE
    out[before_other & (cp == 0x20)] = LAST_BLANK
    marks = np.flatnonzero((cp == 0x27) & ~last)
    if len(marks):
        padded = np.concatenate([cp, np.zeros(2, cp.dtype)])
        one, two = padded[marks + 1], padded[marks + 2]
        two[last[np.minimum(marks + 1, n - 1)]] = 0
        short = np.isin(one, [ord(c) for c in "stmd"])
        pairs = [(one == ord(a)) & (two == ord(b)) for a, b in ("re", "ve", "ll")]
        out[marks[short]] = SHORT_CONTRACTION
        out[marks[pairs[0] | pairs[1] | pairs[2]]] = LONG_CONTRACTION
    return out


def _begins(symbols: np.ndarray, width: int = 256) -> np.ndarray:
    """Where pre-tokens begin: a scan over the transition functions of blocks of ``width`` symbols."""
    n = len(symbols)
    blocks = -(-n // width)
    table = np.full(blocks * width, NEW_TEXT, np.uint8)
    table[:n] = symbols
    table = np.ascontiguousarray(table.reshape(blocks, width).T)
    flat = np.ascontiguousarray((_NEXT % BEGINS).ravel())
    whole = np.tile(np.arange(STATES, dtype=np.uint8)[:, None], (1, blocks))
    for column in table:
        whole = flat[whole * np.uint8(SYMBOLS) + column]
    # The scan over block functions: one small function after the other.
    state = np.empty(blocks, np.uint8)
    now = OPEN
    for i, function in enumerate(whole.T.tolist()):
        state[i] = now
        now = function[now]
    out = np.empty((width, blocks), bool)
    both = np.ascontiguousarray(_NEXT.ravel())
    for j, column in enumerate(table):
        got = both[state * np.uint8(SYMBOLS) + column]
        out[j] = got >= BEGINS
        state = got & np.uint8(BEGINS - 1)
    return out.T.ravel()[:n]


def pretoken_starts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Byte positions at which pre-tokens begin; the texts lie one after the other in ``data``."""
    if not len(data):
        return np.zeros(0, np.int64)
    at = np.flatnonzero((data & 0xC0) != 0x80)
    cp = np.frombuffer(data.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
    filled = offsets[:-1][np.diff(offsets) > 0]
    places = np.searchsorted(at, filled)
    first = np.zeros(len(cp), bool)
    first[places] = True
    symbols = _symbols(cp, first)
    # One symbol more in front of each text sets the automaton back.
    spaced = np.insert(symbols, places, NEW_TEXT)
    begins = np.delete(_begins(spaced), places + np.arange(len(places)))
    return at[begins]
