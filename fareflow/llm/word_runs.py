"""Periodic run detection (operator 12): stretches of words that repeat with a period, at least ``least_exponent`` times.

Words are numbered by first use, and the texts of a slice of rows become one sequence with a different mark after each
text. Recompression turns it into a run-length grammar: in turns, blocks of one symbol become a new symbol, and then
pairs of different symbols do, where symbols are split in two halves and pairs go from one half to the other. Equal
symbols of a level stand for equal words, and what two places have in common is parsed alike but for its ends.

Candidates lie on a harmonic grid: a run of period ``p`` that is four periods long holds four neighbouring multiples of ``p``,
at which the words are equal. Over all periods these are about n ln n places. For each candidate, the grammar answers how
far the text agrees with itself one period on, to the right and, by the mirrored grammar, to the left: it climbs level by
level while symbols agree and then descends to the first difference. That gives the exact ends of the run. Periods come in
rising order, so the first one found for a stretch is its smallest.

A run is reported with its whole length; ``collapsed`` is the text without what repeats, its words joined by single spaces.
A missing, empty or blank text has no words and no runs. Each row gets a row: ids may be missing or repeat. An empty
table gives no rows; columns other than id and text are not read. There is no shuffle. A slice holds at most 4 MB of
texts, or one longer text, and needs some tens of bytes for each byte of it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_rows

# Candidates that are answered together.
TOGETHER = 4096
# Words of one grammar, unless one text has more.
GRAMMAR_WORDS = 1 << 18
_ODD = np.uint64(0x9E3779B97F4A7C15)


class Grammar:
    """A run-length grammar over a sequence that begins and ends with symbols found nowhere else.

    ``starts[v]`` are the places at which the symbols of level ``v`` begin, with the length of the sequence at the end;
    ``blocks[v]`` says that the level above joins equal neighbours.
    """

    def __init__(self, words: np.ndarray):
        self.size = len(words)
        starts, symbols = np.arange(self.size, dtype=np.int64), _named(words.astype(np.int64))
        self.starts, self.symbols, self.blocks = [np.append(starts, self.size)], [symbols], []
        while symbols.max(initial=0) + 1 < len(symbols):
            first = np.flatnonzero(np.append(True, symbols[1:] != symbols[:-1]))
            if len(first) < len(symbols):
                lengths = np.diff(np.append(first, len(symbols)))
                self._add(starts[first], _named(symbols[first] * (len(symbols) + 1) + lengths), True)
                starts, symbols = self.starts[-1][:-1], self.symbols[-1]
                continue
            joined = self._pairs(symbols)
            head = np.flatnonzero(~np.append(False, joined[:-1]))
            after = np.where(joined[head], np.append(symbols[1:], 0)[head] + 1, 0)
            self._add(starts[head], _named(symbols[head] * (len(symbols) + 2) + after), False)
            starts, symbols = self.starts[-1][:-1], self.symbols[-1]

    def _add(self, starts: np.ndarray, symbols: np.ndarray, blocks: bool) -> None:
        self.starts.append(np.append(starts, self.size))
        self.symbols.append(symbols)
        self.blocks.append(blocks)

    def _pairs(self, symbols: np.ndarray) -> np.ndarray:
        """Which symbols are joined with the next one. Of both ways through a split of the symbols, the one with more pairs;
        neighbours differ, so on some split there is a pair."""
        salt = len(self.starts)
        while True:
            with np.errstate(over="ignore"):
                half = ((symbols.astype(np.uint64) + np.uint64(salt)) * _ODD >> np.uint64(40)) * _ODD >> np.uint64(63) == 1
            up = np.append(half[1:] & ~half[:-1], False)
            down = np.append(half[:-1] & ~half[1:], False)
            best = up if up.sum() >= down.sum() else down
            if best.any():
                return best
            salt += 7919

    def mirrored(self) -> Grammar:
        """The grammar of the reversed sequence."""
        other = object.__new__(Grammar)
        other.size, other.blocks = self.size, self.blocks
        other.starts = [(self.size - starts)[::-1] for starts in self.starts]
        other.symbols = [symbols[::-1] for symbols in self.symbols]
        return other

    def _agree(self, level: int, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Whether the symbols at two places are equal, and how far to go if they are: over as much of a block as is left of both."""
        starts, symbols = self.starts[level], self.symbols[level]
        at = np.searchsorted(starts, a)
        equal = symbols[at] == symbols[np.searchsorted(starts, b)]
        if level < len(self.blocks) and self.blocks[level]:
            above = self.starts[level + 1]
            left = [above[np.searchsorted(above, x, "right")] - x for x in (a, b)]
            return equal, np.minimum(*left)
        return equal, starts[at + 1] - starts[at]

    def common(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """How many words from two different places on agree, for many pairs of places at once."""
        a, b = a.astype(np.int64).copy(), b.astype(np.int64).copy()
        begin = a.copy()
        stopped = np.full(len(a), -1)
        top = len(self.starts) - 1
        climbing = np.arange(len(a))
        for level in range(top + 1):
            here = climbing
            while len(here):
                if level < top:
                    above = self.starts[level + 1]
                    both = (above[np.searchsorted(above, a[here])] == a[here]) & (above[np.searchsorted(above, b[here])] == b[here])
                    here = here[~both]
                equal, step = self._agree(level, a[here], b[here])
                stopped[here[~equal]] = level
                here, step = here[equal], step[equal]
                a[here] += step
                b[here] += step
            climbing = climbing[stopped[climbing] < 0]
        for level in range(top - 1, -1, -1):
            here = np.flatnonzero(stopped > level)
            while len(here):
                equal, step = self._agree(level, a[here], b[here])
                here, step = here[equal], step[equal]
                a[here] += step
                b[here] += step
        return a - begin


def _named(values: np.ndarray) -> np.ndarray:
    return np.unique(values, return_inverse=True)[1].reshape(-1).astype(np.int64)


def _uncovered(at: np.ndarray, p: int, runs: dict[tuple[int, int], int]) -> np.ndarray:
    """Candidates that do not lie in a run whose period divides theirs; extending those would give that run again."""
    held = sorted((s, e) for (s, e), q in runs.items() if p % q == 0 and e - s >= 4 * p)
    if not held:
        return at
    starts, ends = np.array(held).T
    last = np.searchsorted(starts, at, "right") - 1
    return at[(last < 0) | (at + 3 * p >= ends[last])]


def runs_of(words: np.ndarray, text: np.ndarray, longest: int, least: int) -> dict[tuple[int, int], int]:
    """All runs of at least ``least`` periods (four or more) as begin and end, with their smallest period.

    ``text`` numbers the text of each place, and ``longest`` is the length of the longest text. Texts are apart by
    symbols found nowhere else.
    """
    runs: dict[tuple[int, int], int] = {}
    grammar = mirror = None
    waiting: list[tuple[int, np.ndarray]] = []

    def answer() -> None:
        nonlocal grammar, mirror
        if not waiting:
            return
        if grammar is None:
            grammar = Grammar(words)
            mirror = grammar.mirrored()
        period = np.concatenate([np.full(len(at), p) for p, at in waiting])
        a = np.concatenate([at for _, at in waiting])
        waiting.clear()
        begin = a - mirror.common(len(words) - a, len(words) - a - period)
        end = a + period + grammar.common(a, a + period)
        long = end - begin >= least * period
        for s, e, p in zip(begin[long].tolist(), end[long].tolist(), period[long].tolist(), strict=True):
            runs.setdefault((s, e), p)

    for p in range(1, longest // 4 + 1):
        grid, of = words[::p], text[::p]
        same = grid[1:] == grid[:-1]
        at = np.flatnonzero(same[:-2] & same[1:-1] & same[2:])
        at = at[of[at] == of[at + 3]]
        if not len(at):
            continue
        heads = at[np.append(True, np.diff(at) > 1)] * p
        if len(at) > 64:
            # One candidate of each row of them first; most others are then known to be in its run.
            answer()
            waiting.append((p, _uncovered(heads, p, runs)))
            answer()
        waiting.append((p, _uncovered(at * p, p, runs)))
        if sum(len(x) for _, x in waiting) >= TOGETHER:
            answer()
    answer()
    return runs


def _slices(texts: list[list[bytes]]) -> Iterator[range]:
    """Texts that share a grammar: few enough words, or one text."""
    begin = size = 0
    for i, words in enumerate(texts):
        if size and size + len(words) > GRAMMAR_WORDS:
            yield range(begin, i)
            begin, size = i, 0
        size += len(words)
    yield range(begin, len(texts))


def find_runs(
    docs: DataFrame, least_words: int = 6, least_exponent: int = 4, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Per row: the id, ``runs`` (array of start, length, period; by start, then period) and ``collapsed``.

    Runs have ``least_words`` words and ``least_exponent`` periods or more; the exponent is at least 4.
    """
    if least_exponent < 4:
        raise ValueError("the grid finds runs of four periods or more")

    def found(texts: list[list[bytes]]) -> list[list[tuple[int, int, int]]]:
        out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
        if max(map(len, texts), default=0) < least_words:
            return out
        numbers: dict[bytes, int] = {}
        parts = [[-1]]
        for i, words in enumerate(texts):
            parts += [[numbers.setdefault(word, len(numbers)) for word in words], [-2 - i]]
        places = np.cumsum([0, *map(len, parts)])
        sequence = np.concatenate([np.array(part, np.int64) for part in parts])
        text = np.repeat(np.arange(len(parts)), np.diff(places))
        runs = runs_of(sequence, text, max(map(len, texts)), least_exponent)
        for (s, e), p in runs.items():
            if e - s >= least_words:
                part = int(text[s])
                out[part // 2].append((s - int(places[part]), e - s, p))
        return [sorted(x, key=lambda run: (run[0], run[2])) for x in out]

    def collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> str:
        if runs:
            change = np.zeros(len(words) + 1, np.int64)
            for start, length, period in runs:
                change[start + period] += 1
                change[start + length] -= 1
            words = [word for word, depth in zip(words, np.cumsum(change).tolist(), strict=False) if not depth]
        return b" ".join(words).decode()

    def rows(slices: Iterator[dict]) -> Iterator[dict]:
        for part in slices:
            texts = [(text or "").encode().split() for text in part["text"]]
            for some in _slices(texts):
                held = [texts[i] for i in some]
                runs = found(held)
                yield {
                    id_col: [part["id"][i] for i in some],
                    "n_words": list(map(len, held)),
                    "runs": [[dict(zip(("start", "length", "period"), run, strict=True)) for run in x] for x in runs],
                    "collapsed": list(map(collapsed, held, runs)),
                }

    kind = docs.schema[id_col].dataType.simpleString()
    return map_rows(
        docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")),
        f"`{id_col}` {kind}, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string",
        rows,
    )
