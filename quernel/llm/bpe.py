"""Byte-level BPE by dynamic programming over prefixes.

Every prefix of a piece has exactly one last token in its encoding. An automaton over all tokens
finds the ones that end at each position; the right one is the longest whose pair with the last
token of the prefix before it is compatible, that is, whose two tokens the merges would leave
apart. Following the stored last tokens back from the end gives the ids, without running merges.
"""

from __future__ import annotations

import json
from array import array

import ahocorasick
import regex

#: Fixed values of the vocabulary: the split pattern of its public description.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_NEVER = 1 << 60


def byte_letters() -> dict[str, int]:
    """The letters that stand for bytes in the vocabulary file: printable bytes for themselves, the others from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + n): b for n, b in enumerate(rest)}


class ByteBpe:
    """An encoder for one vocabulary file (tokenizers JSON with a byte-level BPE model)."""

    def __init__(self, path: str, cached: int = 400_000) -> None:
        with open(path, encoding="utf-8") as file:
            model = json.load(file)["model"]
        letters = byte_letters()
        raw = lambda token: bytes(letters[c] for c in token).decode("latin-1")
        self.ids: dict[str, int] = {raw(t): i for t, i in model["vocab"].items()}
        self.texts = {i: t for t, i in self.ids.items()}
        self.rank: dict[tuple[int, int], int] = {}
        self.parts: dict[int, tuple[int, int]] = {}
        self.born: dict[int, int] = {}  # the rank of the merge that makes a token, -1 for bytes
        for n, pair in enumerate(model["merges"]):
            a, b = (raw(x) for x in (pair if isinstance(pair, list) else pair.split(" ")))
            left, right, whole = self.ids[a], self.ids[b], self.ids[a + b]
            self.rank[left, right] = n
            if whole not in self.parts:
                self.parts[whole], self.born[whole] = (left, right), n
        self.automaton = ahocorasick.Automaton()
        for text, token in self.ids.items():
            self.automaton.add_word(text, (token, len(text)))
        self.automaton.make_automaton()
        self.split = regex.compile(SPLIT).findall
        self._pairs: dict[tuple[int, int], bool] = {}
        self._sound: dict[int, bool] = {}
        self.first, self.rest = _Chunks(self, "", cached), _Chunks(self, " ", cached)
        self._spaces = regex.compile(r"\s\s").search
        self._cut = regex.compile(r" (?=\S)").split

    def compatible(self, a: int, b: int) -> bool:
        """Whether the merges leave the neighbours a and b apart.

        While both grow from bytes, the tokens that meet at the seam are those on the right edge of a
        and on the left edge of b. Two that meet merge if their rank comes before the merges that would
        take either into its next larger token; of equal ranks the left merge goes first.
        """
        known = self._pairs.get((a, b))
        if known is None:
            known = self._pairs[a, b] = self._meets_apart(a, b)
        return known

    def _meets_apart(self, a: int, b: int) -> bool:
        left, x, until = [], a, _NEVER
        while True:
            left.append((x, until))
            if x not in self.parts:
                break
            until, x = self.born[x], self.parts[x][1]
        right, y, until = [], b, _NEVER
        while True:
            right.append((y, until))
            if y not in self.parts:
                break
            until, y = self.born[y], self.parts[y][0]
        for x, x_until in left:
            for y, y_until in right:
                rank = self.rank.get((x, y))
                if rank is not None and rank < x_until and rank <= y_until and rank != _NEVER:
                    return False
        return True

    def sound(self, token: int) -> bool:
        """Whether the merges make the token from its own bytes at all."""
        known = self._sound.get(token)
        if known is None:
            if token not in self.parts:
                known = len(self.texts[token]) == 1
            else:
                a, b = self.parts[token]
                known = self.sound(a) and self.sound(b) and self._joins(a, b)
            self._sound[token] = known
        return known

    def _joins(self, a: int, b: int) -> bool:
        """Whether a and b are whole before anything else at their seam merges."""
        own = self.rank[a, b]
        left, x, until = [], a, _NEVER
        while x in self.parts:
            left.append((x, until))
            until, x = self.born[x], self.parts[x][1]
        left.append((x, until))
        right, y, until = [], b, _NEVER
        while y in self.parts:
            right.append((y, until))
            until, y = self.born[y], self.parts[y][0]
        right.append((y, until))
        for x, x_until in left:
            for y, y_until in right:
                rank = self.rank.get((x, y))
                if rank is not None and (x, y) != (a, b) and rank < min(own, x_until) and rank <= y_until:
                    return False
        return True

    def piece(self, text: str) -> list[int]:
        """Ids of one piece, its bytes given as Latin-1 text."""
        whole = self.ids.get(text)
        if whole is not None and self.sound(whole):
            return [whole]
        last = [-1] * len(text)  # the last token of each prefix, by its end
        length = [0] * len(text)
        compatible, sound = self.compatible, self.sound
        for end, (token, size) in self.automaton.iter(text):
            if last[end] >= 0:
                continue
            start = end - size
            if sound(token) and (start < 0 or (last[start] >= 0 and compatible(last[start], token))):
                last[end], length[end] = token, size
        found, at = [], len(text) - 1
        while at >= 0:
            found.append(last[at])
            at -= length[at]
        return found[::-1]

    def chunk(self, text: str) -> bytes:
        """Ids of a text as packed 32-bit integers."""
        ids = array("i")
        for piece in self.split(text):
            ids.extend(self.piece(piece.encode("utf-8").decode("latin-1")))
        return ids.tobytes()

    def encode_packed(self, text: str | None) -> bytes:
        """Ids of a text, packed; empty for null and empty texts.

        A space before a letter, digit or mark always begins a piece, so the text is cut there and the
        parts are looked up; only new parts are encoded.
        """
        if not text:
            return b""
        parts = text.split(" ") if self._spaces(text) is None else self._cut(text)
        head = self.first[parts[0]]
        return head + b"".join(map(self.rest.__getitem__, parts[1:])) if len(parts) > 1 else head

    def encode(self, text: str | None) -> list[int]:
        ids = array("i")
        ids.frombytes(self.encode_packed(text))
        return list(ids)


class _Chunks(dict):
    """Packed ids of parts of texts, as far as they are remembered; emptied when it is full."""

    #: Longer parts are not kept: they hardly come again and would fill the memory.
    LONGEST = 64

    def __init__(self, bpe: ByteBpe, before: str, most: int) -> None:
        super().__init__()
        self.bpe, self.before, self.most = bpe, before, most

    def __missing__(self, part: str) -> bytes:
        packed = self.bpe.chunk(self.before + part)
        if len(part) <= self.LONGEST:
            if len(self) >= self.most:
                self.clear()
            self[part] = packed
        return packed
