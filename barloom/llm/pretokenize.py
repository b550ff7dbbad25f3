"""Pre-tokenisation of byte-level BPE without regular expressions at run time.

Every code point becomes a symbol (its class, and for white space and apostrophes what the
next characters are). A symbol is a function from scanner states to scanner states. Such
functions compose associatively, so the text is cut into rows that are scanned side by side:
first each row's composite function, then the state in which each row starts, then the states
of all positions at once. Boundaries are where a state and the next symbol do not continue
the same slice.
"""

from __future__ import annotations

from functools import cache
from unicodedata import category

import numpy as np
from tokenizers.pre_tokenizers import ByteLevel

#: The endings after an apostrophe that are slices of their own.
ONE_LETTER, TWO_LETTERS = "stmd", ("re", "ve", "ll")

# Classes of code points.
OTHER, LETTER, NUMBER, SPACE, BLANK, END = range(6)
# Symbols: the classes OTHER, LETTER, NUMBER, and
LAST_SPACE, LAST_BLANK, MORE_BLANK, ONE, TWO, BREAK = range(3, 9)
# States: which kind of slice is open after a character.
FRESH, IN_LETTERS, IN_NUMBERS, IN_OTHERS, IN_BLANKS, AFTER_SPACE, ONE_LEFT, TWO_LEFT = range(8)
STATES, SYMBOLS = 8, 9
#: Letters and numbers are assigned below this point only.
LAST_ASSIGNED = 0x32400
ROW = 256


@cache
def classes() -> np.ndarray:
    """The class of every code point."""
    kinds = {"L": LETTER, "N": NUMBER, "Z": BLANK}
    table = np.array([kinds.get(category(chr(c))[0], OTHER) for c in range(0x110000)], np.uint8)
    table[[*range(0x09, 0x0E), 0x85]] = BLANK
    # The tokenizers know a later version of Unicode than Python does, so the points that Python
    # calls unassigned are put to them: does the point continue a slice of letters or numbers?
    cut = ByteLevel(add_prefix_space=False, use_regex=True).pre_tokenize_str
    for point in range(LAST_ASSIGNED):
        if table[point] == OTHER and category(chr(point)) == "Cn":
            for kind, run in ((LETTER, "a"), (NUMBER, "1")):
                if len(cut(run + chr(point))) == 1:
                    table[point] = kind
    table[0x20] = SPACE
    return table


@cache
def machine() -> tuple[np.ndarray, np.ndarray]:
    """Next state and whether a slice begins, for each symbol and state (flat)."""
    after, begins = np.zeros((SYMBOLS, STATES), np.uint8), np.ones((SYMBOLS, STATES), np.uint8)
    runs = {LETTER: IN_LETTERS, NUMBER: IN_NUMBERS, OTHER: IN_OTHERS, ONE: ONE_LEFT, TWO: TWO_LEFT}
    for symbol, state in runs.items():
        after[symbol] = state
        kept = IN_OTHERS if symbol in (ONE, TWO) else state
        for previous in (AFTER_SPACE, kept):
            after[symbol, previous], begins[symbol, previous] = kept, 0
    after[LETTER, TWO_LEFT], begins[LETTER, TWO_LEFT] = ONE_LEFT, 0
    after[LETTER, ONE_LEFT], begins[LETTER, ONE_LEFT] = FRESH, 0
    after[MORE_BLANK] = IN_BLANKS
    begins[MORE_BLANK, IN_BLANKS] = 0
    after[LAST_SPACE] = AFTER_SPACE
    after[LAST_BLANK] = after[BREAK] = FRESH
    return after.ravel(), begins.ravel()


def symbols(points: np.ndarray, kinds: np.ndarray) -> np.ndarray:
    """Symbols from code points and their classes; kinds has END after each text."""
    out = kinds.copy()
    ahead = np.append(kinds[1:], END)
    blank = (kinds == SPACE) | (kinds == BLANK)
    last = ahead < SPACE
    out[blank] = MORE_BLANK
    out[(kinds == SPACE) & last] = LAST_SPACE
    out[(kinds == BLANK) & last] = LAST_BLANK
    out[kinds == END] = BREAK
    at = np.flatnonzero((points == ord("'")) & (ahead == LETTER))
    if len(at):
        padded = np.append(points, [0, 0])
        first, second = padded[at + 1], padded[at + 2]
        # The second letter lies in the same text: after its end comes END, whose point is 0.
        for letter in ONE_LETTER:
            out[at[first == ord(letter)]] = ONE
        for a, b in TWO_LETTERS:
            out[at[(first == ord(a)) & (second == ord(b))]] = TWO
    return out


def scan(signs: np.ndarray) -> np.ndarray:
    """Positions at which a slice begins."""
    after, begins = machine()
    n = len(signs)
    rows = -(-n // ROW)
    grid = np.full(rows * ROW, BREAK, np.uint8)
    grid[:n] = signs
    grid = np.ascontiguousarray(grid.reshape(rows, ROW).T).astype(np.uint8) * np.uint8(STATES)
    composite = np.repeat(np.arange(STATES, dtype=np.uint8)[:, None], rows, 1)
    for column in grid:
        composite = after[composite + column]
        if (composite == composite[0]).all():
            break  # constant functions: what follows does not depend on the start
    else:
        column = None
    starts = np.zeros(rows, np.uint8)
    if column is not None:
        # Every row forgets its start early; its last state follows from any start.
        state = np.zeros(rows, np.uint8)
        for column in grid:
            state = after[state + column]
        starts[1:] = state[:-1]
    else:
        state = 0
        for row, function in enumerate(composite.T.tolist()):
            starts[row] = state
            state = function[state]
    cuts = np.empty(grid.shape, bool)
    state = starts
    for k, column in enumerate(grid):
        at = state + column
        cuts[k] = begins[at]
        state = after[at]
    return np.flatnonzero(cuts.T.reshape(-1)[:n])


def slices(texts: list[str]) -> tuple[list[str], list[int]]:
    """The slices of all texts in order, and for each text how many slices end with it."""
    joined = "\0".join(texts) + "\0"
    points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), "<u4")
    kinds = classes()[points]
    ends = np.cumsum([len(t) + 1 for t in texts]) - 1
    kinds[ends] = END
    cuts = scan(symbols(points, kinds))
    marks = np.searchsorted(cuts, ends)
    bounds = np.append(cuts, len(joined)).tolist()
    parts = [joined[a:b] for a, b in zip(bounds, bounds[1:])]
    # Each text's closing mark is a slice of its own; it is left out.
    out, counts, begin = [], [], 0
    for mark in marks.tolist():
        out += parts[begin:mark]
        counts.append(len(out))
        begin = mark + 1
    return out, counts
