"""Exact BPE by dynamic programming over prefixes: ids, counts of every prefix, and decoding.

For each prefix of a word the *unique* last token of its encoding is stored. A token that is a suffix of the prefix
(found by an Aho-Corasick automaton over the vocabulary, whose failure links are suffix links) is that last token if
and only if it is compatible with the last token of the prefix before it: the two, encoded together, stay as they are.
Following the stored tokens backwards gives the exact ids, and each prefix's token count is one more than that of the
prefix before its last token. The merge rules are only used to test pairs, and every answer is remembered.

Vocabularies are files of public tokenizers (``.json`` of the tokenizers library); their path is a parameter.
"""

from __future__ import annotations

import json
import re
import unicodedata
from collections.abc import Callable, Iterator

import ahocorasick
import regex

#: Words kept per Python worker, and pairs whose test is remembered; bounds its memory, results do not depend on it.
WORDS_KEPT, PAIRS_KEPT = 400_000, 400_000
#: Longer words are encoded but not kept.
KEPT_LENGTH = 64


class Remembered(dict):
    """What ``make`` gives for a word, kept for two generations of WORDS_KEPT / 2 words."""

    def __init__(self, make: Callable):
        super().__init__()
        self.make, self.old = make, {}

    def __missing__(self, word: str):
        value = self.old.get(word)
        if value is None:
            value = self.make(word)
        if len(word) <= KEPT_LENGTH:
            if len(self) >= WORDS_KEPT // 2:
                self.old = dict(self)
                self.clear()
            self[word] = value
        return value


def finder(pattern: str) -> Callable[[str], list[str]]:
    """All matches of a pattern with the classes {L} letters, {N} numbers and {S} white space. Texts of Latin-1 letters,
    the usual case, take a pattern with those classes spelt out, which finds the same and is several times faster."""
    latin = [chr(i) for i in range(256)]
    spelt = {k: re.escape("".join(c for c in latin if unicodedata.category(c)[0] == k)) for k in "LN"}
    spelt["S"] = re.escape("".join(c for c in latin if regex.match(r"\s", c)))
    fast = re.compile(pattern.format(**spelt)).findall
    full = regex.compile(pattern.format(L=r"\p{L}", N=r"\p{N}", S=r"\s")).findall

    def find(text: str) -> list[str]:
        try:
            text.encode("latin-1")
        except UnicodeEncodeError:
            return full(text)
        return fast(text)

    return find


def byte_letters() -> list[str]:
    """The letter that stands for each byte in byte-level vocabularies: itself if printable, else one from U+0100 on."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = iter(range(0x100, 0x200))
    return [chr(b) if b in printable else chr(next(others)) for b in range(256)]


class PrefixBpe:
    """One vocabulary with its merges; words are strings of symbols of that vocabulary."""

    def __init__(self, vocab: dict[str, int], merges: list, end: str = ""):
        self.vocab, self.end = vocab, end
        pairs = [tuple(m) if isinstance(m, list) else tuple(m.split(" ", 1)) for m in merges]
        self.rank = {p: i for i, p in enumerate(pairs)}
        self.parts: dict[str, tuple[str, str]] = {}
        self.inner, self.last = ahocorasick.Automaton(), ahocorasick.Automaton()
        for token, i in vocab.items():
            ends_word = bool(end) and token.endswith(end) and token != end
            text = token[: -len(end)] if ends_word else token
            # a token that its own letters do not merge into can end no encoding
            if len(text) > 1 and not self._made(token):
                continue
            (self.last if ends_word else self.inner).add_word(text, (len(text), token, i))
        for automaton in (self.inner, self.last):
            if len(automaton):
                automaton.make_automaton()
        made_at = {t: self.rank[p] for t, p in self.parts.items()}
        #: Whether every token is made by a later rule than its parts, so that rules apply in the order of their ranks.
        self.ordered = all(made_at[t] > max(made_at.get(x, -1) for x in p) for t, p in self.parts.items())
        self.edges: dict[tuple[str, int], list[tuple[str, int]]] = {}
        self.known: dict[int, bool] = {}
        self.known_old: dict[int, bool] = {}

    def _symbols(self, token: str) -> list[str]:
        if self.end and token.endswith(self.end) and token != self.end:
            text = token[: -len(self.end)]
            return [*text[:-1], text[-1] + self.end]
        return list(token)

    def _merged(self, symbols: list[str]) -> tuple[list[str], tuple[str, str] | None]:
        """Plain merging of a few symbols, lowest rank first and leftmost first; with the last pair merged."""
        symbols, pair = list(symbols), None
        while len(symbols) > 1:
            rank, at = min((self.rank.get(p, 1 << 60), k) for k, p in enumerate(zip(symbols, symbols[1:], strict=False)))
            if rank == 1 << 60:
                break
            pair = symbols[at], symbols[at + 1]
            symbols[at : at + 2] = ["".join(pair)]
        return symbols, pair

    def _made(self, token: str) -> bool:
        symbols, pair = self._merged(self._symbols(token))
        if symbols == [token]:
            self.parts[token] = pair
        return symbols == [token]

    def _edge(self, token: str, side: int) -> list[tuple[str, int]]:
        """The pieces that stand at one end of a token while it is being made, each with the rank that ends it."""
        edge = self.edges.get((token, side))
        if edge is None:
            edge, ended = [], 1 << 60
            piece = token
            while True:
                edge.append((piece, ended))
                if piece not in self.parts:
                    break
                ended = self.rank[self.parts[piece]]
                piece = self.parts[piece][side]
            self.edges[token, side] = edge
        return edge

    def compatible(self, a: str, b: str) -> bool:
        """Whether two tokens, side by side, are their own encoding: no rule joins a piece at the end of the first
        with a piece at the start of the second before either is used up (of equal rules the left one comes first)."""
        if self.ordered:
            rank = self.rank.get
            return not any(
                (r := rank((x, y))) is not None and r < x_end and r <= y_end
                for x, x_end in self._edge(a, 1)
                for y, y_end in self._edge(b, 0)
            )
        return self._merged([*self._symbols(a), *self._symbols(b)])[0] == [a, b]

    def _step(self, matches: list[tuple[int, str, int]], i: int, back: list, what: str) -> tuple:
        for length, token, ident in matches:
            j = i - length
            if j == 0 or self._joins(back[j], token, ident):
                return (j, token, ident, (back[j][3] if j else 0) + 1)
        raise ValueError(f"no encoding ends at {i} of {what[:40]!r}")

    def _joins(self, before: tuple, token: str, ident: int) -> bool:
        """``compatible`` of a prefix's last token and the next one, remembered by their ids for two generations."""
        key = before[2] << 32 | ident
        known = self.known_old.get(key)
        if known is None:
            known = self.compatible(before[1], token)
        if len(self.known) >= PAIRS_KEPT // 2:
            self.known_old, self.known = self.known, {}
        self.known[key] = known
        return known

    def prefixes(self, word: str) -> list[tuple]:
        """For each prefix without a word end: (start of its last token, that token, its id, tokens so far)."""
        back: list = [(0, "", -1, 0)]
        at, known = 1, self.known  # the prefix whose last token is looked for
        for end, (length, token, ident) in self.inner.iter(word):  # by ends, the longest match of each first
            if end + 1 != at:
                if end + 1 < at:
                    continue
                break
            if length == at:
                back.append((0, token, ident, 1))
                at += 1
                continue
            before = back[at - length]
            joins = known.get(before[2] << 32 | ident)
            if joins is None:
                joins = self._joins(before, token, ident)
                known = self.known
            if joins:
                back.append((at - length, token, ident, before[3] + 1))
                at += 1
        if at <= len(word):
            raise ValueError(f"no encoding ends at {at} of {word[:40]!r}")
        return back

    def ended(self, word: str, back: list[tuple], every: bool = False) -> list[tuple]:
        """The same for prefixes that end a word (the whole word; with ``every`` all of them)."""
        found: dict[int, list] = {}
        for at, match in self.last.iter(word):
            if every or at + 1 == len(word):
                found.setdefault(at + 1, []).append(match)
        wanted = range(1, len(word) + 1) if every else (len(word),)
        return [self._step(found.get(i, ()), i, back, word) for i in wanted]

    def encode(self, word: str) -> list[int]:
        """The exact ids of one word."""
        back = self.prefixes(word)
        last = self.ended(word, back)[0] if self.end else back[-1]
        ids = []
        while last[2] >= 0:
            ids.append(last[2])
            last = back[last[0]]
        return ids[::-1]

    def counts(self, word: str) -> list[int]:
        """The exact token count of every prefix of a word, each taken as a word of its own."""
        back = self.prefixes(word)
        return [x[3] for x in (self.ended(word, back, every=True) if self.end else back[1:])]


class ByteVocabulary:
    """A byte-level tokenizer file: special strings, pre-tokenizer pattern, prefix encoder, bytes of each id."""

    def __init__(self, path: str, pattern: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self.bpe = PrefixBpe(model["vocab"], model["merges"], model.get("end_of_word_suffix") or "")
        self.letters = byte_letters()
        byte_of = {c: b for b, c in enumerate(self.letters)}
        end = self.bpe.end
        self.bytes_of = {
            i: bytes(byte_of[c] for c in (t[: -len(end)] if end and t.endswith(end) else t)) for t, i in model["vocab"].items()
        }
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.bytes_of |= {i: t.encode() for t, i in self.special.items()}
        self.split = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")") if self.special else None
        self.find = finder(pattern)

    def pieces(self, text: str) -> Iterator[tuple[str, bool]]:
        """The text cut at special strings: (piece, whether it is one)."""
        if self.split is None or not any(s in text for s in self.special):
            yield text, False
            return
        for piece in self.split.split(text):
            if piece:
                yield piece, piece in self.special

    def symbols(self, word: str) -> str:
        return "".join(map(self.letters.__getitem__, word.encode("utf-8", "replace")))
