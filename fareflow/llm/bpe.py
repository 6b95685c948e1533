"""Byte-level BPE by dynamic programming over prefixes.

For every prefix of a piece there is exactly one last token that an encoding of this prefix can end
with: a sequence of tokens is what BPE gives if and only if BPE leaves each pair of neighbours as it
is. An automaton over all tokens gives those that end at each byte, from left to right, and the one among them that may
follow the last token before it is the last token there. So one walk finds the last token of every prefix, in time
that grows with the length of the piece, and the number of tokens of every prefix comes with it.

What is stored for a prefix never depends on what follows. That allows appending without encoding
again, cutting a text at a token budget, and encoding again only the pieces around an edit.
"""

from __future__ import annotations

import base64
import json
from collections.abc import Iterator
from functools import lru_cache
from itertools import accumulate, chain
from struct import pack

import ahocorasick
import numpy as np
import regex

# Fixed value: how the vocabularies cut a text into pieces.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

# Decisions on pairs of tokens that a worker keeps.
PAIRS = 600_000
# Bytes of words that a worker keeps with their tokens.
CACHE_BYTES = 96 << 20
# Words that are looked up together, and bytes up to which pieces are walked together.
TOGETHER = 1 << 19
SHORT = 48
# Characters that are cut into pieces at once.
BLOCK = 1 << 18
_ID = (1 << 32) - 1


class Vocabulary:
    """Tokens as bytes with their ids, and the order in which BPE merges pairs.

    ``merges`` gives the rank of a pair of tokens; without it, the rank of a pair is that of the
    joined token. With ``whole``, a piece that is a token stays whole however its bytes would merge.
    """

    def __init__(
        self,
        ids: dict[bytes, int],
        merges: dict[tuple[bytes, bytes], int] | None = None,
        specials: dict[str, int] | None = None,
        whole: bool = False,
    ):
        missing = [b for b in range(256) if bytes([b]) not in ids]
        if missing:
            raise ValueError(f"the vocabulary lacks single bytes: {missing[:5]}")
        self.ids = ids
        self.tokens = {number: token for token, number in ids.items()}
        self.merges = merges
        self.specials = specials or {}
        self.tokens |= {number: text.encode() for text, number in self.specials.items()}
        self.whole = whole
        self.sizes = {number: len(token) for token, number in ids.items()}
        self.longest = max(map(len, ids))
        # Bytes as characters of the same number: the automaton takes text.
        self.automaton = ahocorasick.Automaton()
        for token, number in ids.items():
            self.automaton.add_word(token.decode("latin-1"), len(token) << 32 | number)
        self.automaton.make_automaton()
        # By id: whether BPE makes the token of its own bytes (1 if it does, 2 if not, 0 if that is not known yet).
        self._alone = bytearray(max(ids.values()) + 1)
        self._size_of = np.zeros(len(self._alone), np.int64)
        self._size_of[list(self.sizes)] = list(self.sizes.values())
        # By ids of two neighbours.
        self._pairs: dict[int, bool] = {}
        self._first: dict[bytes, tuple[list[int], list[bytes]]] = {}
        self._last: dict[bytes, tuple[list[int], list[bytes]]] = {}
        self._never = 1 << 62

    def _rank(self, left: bytes, right: bytes) -> int | None:
        return self.ids.get(left + right) if self.merges is None else self.merges.get((left, right))

    def _merged(self, data: bytes) -> tuple[list[bytes], tuple[int, bytes, bytes] | None]:
        """BPE as defined, for a few bytes: merge the leftmost pair of lowest rank until none is left.

        Also gives the last merge.
        """
        parts = [data[i : i + 1] for i in range(len(data))]
        merge = None
        while len(parts) > 1:
            ranks = [(rank, i) for i in range(len(parts) - 1) if (rank := self._rank(parts[i], parts[i + 1])) is not None]
            if not ranks:
                break
            rank, i = min(ranks)
            merge = rank, parts[i], parts[i + 1]
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
        return parts, merge

    def stands(self, token: bytes) -> bool:
        """BPE makes this token of its own bytes. Notes by which merges its outer parts grew."""
        number = self.ids[token]
        if not self._alone[number]:
            parts, merge = self._merged(token)
            self._alone[number] = 1 if parts == [token] else 2
            if parts == [token]:
                if merge is None:
                    self._first[token] = self._last[token] = ([], [token])
                else:
                    rank, left, right = merge
                    # The parts of a merge stand by themselves, or BPE could not have come to them.
                    self.stands(left), self.stands(right)
                    ranks, grown = self._first[left]
                    self._first[token] = [*ranks, rank], [*grown, token]
                    ranks, grown = self._last[right]
                    self._last[token] = [*ranks, rank], [*grown, token]
        return self._alone[number] == 1

    def adjoins(self, left: int, right: int) -> bool:
        """BPE leaves these neighbours as they are: no merge over the border comes before their own merges.

        The parts at the border grow by merges of rising rank. While one is still to grow, a merge over
        the border wins if its rank is lower; of equal ranks, the one further left.
        """
        if len(self._pairs) >= PAIRS:
            self._pairs.clear()
        known = self._pairs[left << 32 | right] = self._compare(self.tokens[left], self.tokens[right])
        return known

    def _compare(self, left: bytes, right: bytes) -> bool:
        left_ranks, lefts = self._last[left]
        right_ranks, rights = self._first[right]
        i = j = 0
        while True:
            next_left = left_ranks[i] if i < len(left_ranks) else self._never
            next_right = right_ranks[j] if j < len(right_ranks) else self._never
            over = self._rank(lefts[i], rights[j])
            if over is not None and over < next_left and over <= next_right:
                return False
            if next_left is next_right is self._never:
                return True
            if next_left <= next_right:
                i += 1
            else:
                j += 1

    def last_tokens(self, data: bytes, last: list[int]) -> None:
        """Add to ``last``, by length of prefix, the one token that the encoding of each longer prefix of ``data`` ends with."""
        alone, pairs = self._alone, self._pairs
        known = len(last)
        last += [-1] * (len(data) + 1 - known)
        # Tokens that end behind the known prefixes begin no further back than the longest token.
        skipped = max(0, known - self.longest)
        for at, value in self.automaton.iter((data[skipped:] if skipped else data).decode("latin-1")):
            end, length, token = skipped + at + 1, value >> 32, value & _ID
            # Each prefix has one; the rest of the tokens that end here need no look.
            if last[end] >= 0 or alone[token] == 2:
                continue
            if not alone[token] and not self.stands(self.tokens[token]):
                continue
            if end == length:
                last[end] = token
                continue
            left = last[end - length]
            pair = left << 32 | token
            fits = pairs.get(pair)
            if fits or fits is None and self.adjoins(left, token):
                last[end] = token

    def encoded(self, data: bytes) -> list[int]:
        """The ids of a piece: the last tokens of all prefixes, followed back from the end."""
        last, sizes, found, at = [0], self.sizes, [], len(data)
        self.last_tokens(data, last)
        while at:
            found.append(last[at])
            at -= sizes[last[at]]
        return found[::-1]

    def _fit(self, pairs: np.ndarray) -> np.ndarray:
        found = list(map(self._pairs.get, pairs.tolist()))
        if None in found:
            for i, known in enumerate(found):
                if known is None:
                    pair = int(pairs[i])
                    known = self._pairs.get(pair)
                    found[i] = self.adjoins(pair >> 32, pair & _ID) if known is None else known
        return np.array(found, bool)

    def encoded_together(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of many pieces, one after the other, and how many each has: the same walk, for prefixes of one length at a time."""
        sizes = np.fromiter(map(len, pieces), np.int64, len(pieces))
        starts = np.cumsum(sizes + 1) - sizes - 1
        # No token has the character between pieces.
        joined = "\u0100".join(piece.decode("latin-1") for piece in pieces)
        found = np.fromiter(chain.from_iterable(self.automaton.iter(joined)), np.int64)
        ends, lengths, tokens = found[::2] + 1, found[1::2] >> 32, found[1::2] & _ID
        alone = np.frombuffer(self._alone, np.uint8)
        for token in np.unique(tokens[alone[tokens] == 0]).tolist():
            self.stands(self.tokens[token])
        alone = alone[tokens] == 1
        ends, lengths, tokens = ends[alone], lengths[alone], tokens[alone]
        prefix = ends - np.repeat(starts, sizes + 1)[ends - 1]
        last = np.full(len(joined) + 1, -1, np.int64)
        whole = lengths == prefix
        last[ends[whole]] = tokens[whole]
        open_ = np.flatnonzero(last[ends] < 0)
        open_ = open_[np.argsort(prefix[open_], kind="stable")]
        borders = np.flatnonzero(np.diff(prefix[open_])) + 1
        for group in np.split(open_, borders) if len(open_) else ():
            end, token = ends[group], tokens[group]
            fits = self._fit(last[end - lengths[group]] << 32 | token)
            last[end[fits]] = token[fits]
        of, at, steps = np.arange(len(pieces)), starts + sizes, []
        while len(of):
            steps.append((of, last[at]))
            at = at - self._size_of[last[at]]
            going = at > starts[of]
            of, at = of[going], at[going]
        piece = np.concatenate([x for x, _ in steps])
        turn = np.repeat(np.arange(len(steps)), [len(x) for x, _ in steps])
        ids = np.concatenate([x for _, x in steps])[np.lexsort((-turn, piece))]
        return ids, np.bincount(piece, minlength=len(pieces))


class Prefixes:
    """Last token and number of tokens of every prefix of one piece."""

    def __init__(self, vocabulary: Vocabulary, data: bytes = b""):
        self.vocabulary = vocabulary
        self.data = b""
        self.last: list[int] = [0]
        self.count: list[int] = [0]
        self.extend(data)

    def extend(self, more: bytes) -> None:
        """Append bytes. What is stored for earlier prefixes stays right."""
        begin, self.data = len(self.data), self.data + more
        self.vocabulary.last_tokens(self.data, self.last)
        for end in range(begin + 1, len(self.data) + 1):
            self.count.append(self.count[end - self.vocabulary.sizes[self.last[end]]] + 1)

    def ids(self, end: int | None = None) -> list[int]:
        """The encoding of a prefix, read from its end."""
        found, at = [], len(self.data) if end is None else end
        while at:
            found.append(self.last[at])
            at -= self.vocabulary.sizes[self.last[at]]
        return found[::-1]


_PIECES = regex.compile(PATTERN)
# No piece goes on with white space after another character, so a text may be cut there.
_SAFE = regex.compile(r"(?<=\S)(?=\s)")
_WORDS = regex.compile(r"\s*\S+|\s+")
_RUN = regex.compile(r"\s[ \n]")


def blocks(text: str, size: int = BLOCK) -> Iterator[str]:
    """Parts of a text whose pieces together are the pieces of the text."""
    start = 0
    while len(text) - start > size and (cut := _SAFE.search(text, start + size)):
        yield text[start : cut.start()]
        start = cut.start()
    yield text[start:]


def words(text: str) -> Iterator[list[str]]:
    """Smaller parts of that kind, in lists: mostly a space or a line feed with all that follows up to the next one."""
    for block in blocks(text):
        if _RUN.search(block):
            yield _WORDS.findall(block)
        else:
            # No white space next to another: a part may begin at any space and at any line feed.
            first, *lines = block.split("\n")
            for line in [first, *("\n" + line for line in lines)]:
                head, *rest = line.split(" ")
                yield [head, *(" " + word for word in rest)]


class Encoder:
    """Encodes texts piece by piece and keeps what frequent words give."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        # Ids of words and pieces: those met since the last change of generation, and the ones before.
        self._ids: dict[str, bytes] = {}
        self._old: dict[str, bytes] = {}
        self._held = 0
        self._special = regex.compile("|".join(map(regex.escape, vocabulary.specials))) if vocabulary.specials else None

    def _solved(self, pieces: list[str]) -> Iterator[tuple[str, bytes]]:
        """The ids of pieces."""
        vocabulary, together = self.vocabulary, []
        for piece in pieces:
            data = piece.encode()
            if vocabulary.whole and data in vocabulary.ids:
                yield piece, pack("<I", vocabulary.ids[data])
            elif len(data) > SHORT:
                ids = vocabulary.encoded(data)
                yield piece, pack(f"<{len(ids)}I", *ids)
            else:
                together.append((piece, data))
        if together:
            ids, counts = vocabulary.encoded_together([data for _, data in together])
            packed, ends = ids.astype("<u4").tobytes(), (4 * np.cumsum(counts)).tolist()
            for (piece, _), begin, end in zip(together, [0, *ends], ends, strict=False):
                yield piece, packed[begin:end]

    def _learn(self, found: list[list[str]]) -> None:
        """Have the ids of some words at hand. Each different word is looked up once, and cut into pieces if it is new."""
        if self._held > CACHE_BYTES // 2:
            self._ids, self._old, self._held = {}, self._ids, 0
        ids, old = self._ids, self._old
        before = len(ids)

        def unknown(wanted: set[str]) -> set[str]:
            wanted = wanted - ids.keys()
            back = wanted & old.keys()
            ids.update((word, old[word]) for word in back)
            return wanted - back

        cut = {word: _PIECES.findall(word) for word in unknown(set().union(*found))}
        ids.update(self._solved(list(unknown({piece for pieces in cut.values() for piece in pieces}))))
        ids.update((word, b"".join(map(ids.__getitem__, pieces))) for word, pieces in cut.items() if len(pieces) != 1)
        # Both objects and their place in the dictionary take some 200 bytes besides their content.
        self._held += 200 * (len(ids) - before) + 3 * sum(map(len, cut))

    def _walks(self, texts: list[str]) -> Iterator[list[tuple[int, list[str], str]]]:
        """Words of all texts with the number of their text and the special string after them, some at a time, with their ids
        at hand."""
        held, size = [], 0
        for i, text in enumerate(texts):
            for part, special in self._parts(text):
                for found in words(part):
                    held.append((i, found, ""))
                    size += len(found)
                    if size >= TOGETHER:
                        self._learn([found for _, found, _ in held])
                        yield held
                        held, size = [], 0
                if special:
                    held.append((i, [], special))
        self._learn([found for _, found, _ in held])
        yield held

    def _parts(self, text: str) -> Iterator[tuple[str, str]]:
        """Ordinary text and the special string after it, in turns."""
        start = 0
        for found in self._special.finditer(text) if self._special else ():
            yield text[start : found.start()], found[0]
            start = found.end()
        yield text[start:], ""

    def encode_all(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        out: list[list[bytes]] = [[] for _ in texts]
        for walk in self._walks(texts):
            for i, found, special in walk:
                out[i].append(b"".join(map(self._ids.__getitem__, found)))
                if special:
                    out[i].append(pack("<I", self.vocabulary.specials[special]))
        return list(map(b"".join, out))

    def encode(self, text: str) -> bytes:
        return self.encode_all([text])[0]

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.vocabulary.tokens.__getitem__, memoryview(ids).cast("I")))

    def measure_all(self, texts: list[str], budget: int) -> list[tuple[int, int]]:
        """Tokens of each text, and the bytes of its longest start of whole tokens that has at most ``budget`` of them.

        One walk gives both: what each token covers is known, so the cut is a sum and nothing is encoded for it.
        """
        total, at = [0] * len(texts), [0] * len(texts)
        cut: list[int | None] = [None] * len(texts)
        for walk in self._walks(texts):
            for i, found, special in walk:
                ids = list(map(self._ids.__getitem__, found))
                more = (sum(map(len, ids)) >> 2) + bool(special)
                if cut[i] is None:
                    if total[i] + more > budget:
                        within = np.frombuffer(b"".join(ids), "<u4")[: budget - total[i]]
                        cut[i] = at[i] + int(self.vocabulary._size_of[within].sum())
                    else:
                        at[i] += len("".join(found).encode()) + len(special.encode())
                total[i] += more
        return [(n, end if c is None else c) for n, c, end in zip(total, cut, at, strict=True)]

    def count(self, text: str) -> int:
        return self.measure_all([text], 1 << 62)[0][0]

    def prefix_counts(self, text: str) -> Iterator[tuple[int, list[int]]]:
        """For each piece, its place in bytes and the number of tokens up to each of its bytes."""
        at = total = 0
        for part, special in self._parts(text):
            for block in blocks(part):
                for piece in _PIECES.findall(block):
                    data = piece.encode()
                    counts = Prefixes(self.vocabulary, data).count[1:]
                    if self.vocabulary.whole and data in self.vocabulary.ids:
                        counts[-1] = 1
                    yield at, [total + n for n in counts]
                    at += len(data)
                    total += counts[-1]
            if special:
                size = len(special.encode())
                total += 1
                yield at, [total] * size
                at += size


class Encoding:
    """A text with its ids that can be appended to and edited; only pieces near a change are encoded again."""

    def __init__(self, encoder: Encoder, text: str = ""):
        self.encoder = encoder
        self.texts = [text] if text else []
        self.parts = [encoder.encode(text)] if text else []
        #: Characters encoded so far, over all changes.
        self.encoded = len(text)
        self._refine()

    def _refine(self) -> None:
        """Keep the text in blocks that can be encoded apart from each other."""
        texts, parts = [], []
        for text, ids in zip(self.texts, self.parts, strict=True):
            if len(text) > 2048:
                cut = list(blocks(text, 1024))
                texts += cut
                parts += [self.encoder.encode(x) for x in cut]
            else:
                texts.append(text)
                parts.append(ids)
        self.texts, self.parts = texts, parts

    @property
    def text(self) -> str:
        return "".join(self.texts)

    @property
    def ids(self) -> bytes:
        return b"".join(self.parts)

    def replace(self, start: int, end: int, new: str) -> None:
        """Put ``new`` in place of the characters from ``start`` to ``end``."""
        if self.encoder.vocabulary.specials:
            raise ValueError("special strings could span blocks; use a vocabulary without them")
        ends = list(accumulate(map(len, self.texts)))
        first = next((i for i, at in enumerate(ends) if at >= start), max(0, len(ends) - 1))
        last = next((i for i, at in enumerate(ends) if at > end), len(ends) - 1)
        last = max(first, last)
        before = ends[first - 1] if first else 0
        changed = "".join(self.texts[first : last + 1])
        changed = changed[: start - before] + new + changed[end - before :]
        # A change can reach the neighbours only if a piece now goes over the border.
        while first and not _SAFE.match(self.texts[first - 1][-1:] + changed[:1], 1):
            first -= 1
            changed = self.texts[first] + changed
        while last + 1 < len(self.texts) and not _SAFE.match(changed[-1:] + self.texts[last + 1][:1], 1):
            last += 1
            changed += self.texts[last]
        self.texts[first : last + 1] = [changed] if changed else []
        self.parts[first : last + 1] = [self.encoder.encode(changed)] if changed else []
        self.encoded += len(changed)
        self._refine()

    def append(self, more: str) -> None:
        size = len(self.text)
        self.replace(size, size, more)


@lru_cache(maxsize=2)
def load(path: str) -> Encoder:
    """The encoder of a vocabulary file, kept by each process. Files: ``.tiktoken`` ranks or ``.json`` of a tokenizer."""
    if path.endswith(".tiktoken"):
        with open(path, "rb") as lines:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        return Encoder(Vocabulary(ranks, whole=True))
    with open(path, encoding="utf-8") as file:
        content = json.load(file)
    model = content["model"]
    places = _byte_places()
    as_bytes = lambda text: bytes(places[c] for c in text)
    specials = {x["content"]: x["id"] for x in content["added_tokens"]}
    ids = {as_bytes(text): number for text, number in model["vocab"].items() if text not in specials}
    pairs = [pair.split(" ") if isinstance(pair, str) else pair for pair in model["merges"]]
    merges = {(as_bytes(left), as_bytes(right)): rank for rank, (left, right) in enumerate(pairs)}
    return Encoder(Vocabulary(ids, merges, specials))


def _byte_places() -> dict[str, int]:
    """Characters that stand for bytes in such files: printable ones for themselves, others moved past 255."""
    printable = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    rest = [b for b in range(256) if b not in set(printable)]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(rest)}
