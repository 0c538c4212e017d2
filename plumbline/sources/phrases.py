"""Phrases found in marked-up text in one pass, whatever their number.

A text is laid end to end without its markup and white space, with a map back to the places its
stretches come from, and one automaton over all phrases walks it once. A hit counts where each
word of the phrase lies in one stretch, so tags and white space may part words but not letters.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Iterator, Sequence
from itertools import accumulate

import ahocorasick

# What may stand between two words of a phrase.
FILLER = re.compile(r"(?=[\s<&])(?:\s+|<[^>]*>|&(?:nbsp|#160|#8217);)+")
_PARTED, _SPACED = re.compile(f"({FILLER.pattern})"), re.compile(r"(\s+)")
_TAG, _WORD, _MARK = re.compile(r"<[^>]*>"), re.compile(r"[^\s<>]+"), re.compile(r"[\s<>]+")


def _lower(text: str) -> str:
    """Lower case with a letter for each letter, so that places stay."""
    low = text.lower()
    return low if len(low) == len(text) else "".join(c.lower()[0] for c in text)


def _pieces(text: str, low: str) -> tuple[list[str], list[int]]:
    """The stretches of a text without markup and white space, in lower case or ASCII, and where they start."""
    parts = (_PARTED if "<" in text or "&" in text else _SPACED).split(text)
    places = list(accumulate(map(len, parts), initial=0))
    # Lower case of letters of other scripts depends on those beside them, so it is taken of the whole text.
    return parts[::2] if text.isascii() else [low[a:b] for a, b in zip(places[::2], places[1::2])], places[::2]


def phrase_letters(phrase: str) -> str:
    """What of a phrase is looked up: its words, end to end."""
    return "".join(_lower(phrase).split())


def text_letters(text: str) -> str:
    """All that ``Places`` walks in a text: every phrase that it finds there is somewhere in these letters."""
    low = _lower(text)
    if "<" not in text and "&" not in text:
        return "".join(low.split())
    letters = "".join(_pieces(text, low)[0])
    tags = _MARK.sub("", "\0".join(_TAG.findall(low))) if "<" in low else ""
    # As in the walk, each tag ends with a letter that keeps it apart.
    return f"{letters.lower() if letters.isascii() else letters}\0{tags}\0"


class Places:
    """Where each of some phrases begins in a text.

    With ``most`` a phrase counts for its first so many places only, where places are asked for.
    """

    def __init__(self, phrases: Sequence[str], most: int | None = None):
        self.most = most
        self.words = [_lower(p).split() for p in phrases]
        # A phrase without a word stands at the beginning of every text.
        self.empty = [i for i, w in enumerate(self.words) if not w]
        self.auto = ahocorasick.Automaton()
        for i, words in enumerate(self.words):
            if words:
                key = "".join(words)
                self.auto.add_word(key, (*self.auto.get(key, ()), i))
        if len(self.auto):
            self.auto.make_automaton()

    def _walk(self, pieces: list[str], starts: Sequence[int], out: set[tuple[int, int]]) -> None:
        """Hits in the pieces of a text that start at these places."""
        letters = "".join(pieces)
        found = list(self.auto.iter(letters.lower() if letters.isascii() else letters))
        begin = list(accumulate(map(len, pieces), initial=0)) if found else []
        for last, phrases in found:
            for i in phrases:
                words = self.words[i]
                place = first = last + 1 - sum(map(len, words))
                for w in words:
                    s = bisect_right(begin, place) - 1
                    if place + len(w) > begin[s + 1]:
                        break
                    place += len(w)
                else:
                    s = bisect_right(begin, first) - 1
                    out.add((starts[s] + first - begin[s], i))

    def hits(self, text: str) -> list[tuple[int, int]]:
        """(place, number of the phrase), in the order of the text."""
        out = {(0, i) for i in self.empty} if text else set()
        if len(self.auto) and text:
            low = _lower(text)
            self._walk(*_pieces(text, low), out)
            # Most markup holds no phrase: its places are worked out where its letters alone have one.
            tags = _TAG.findall(low) if "<" in low else ()
            if not tags or next(self.auto.iter(_MARK.sub("", "\0".join(tags))), None) is None:
                return sorted(out)
            inside, starts = [], []
            for tag in _TAG.finditer(text):
                words = [w.span() for w in _WORD.finditer(text, tag.start() + 1, tag.end() - 1)]
                # Something between them keeps the words of two tags apart.
                inside += [*(low[a:b] for a, b in words), "\0"]
                starts += [*(a for a, _ in words), tag.end()]
            self._walk(inside, starts, out)
        return sorted(out)

    def of(self, text: str) -> Iterator[int]:
        """The places, each once, in the order of the text."""
        seen: dict[int, int] = {}
        last = None
        for place, i in self.hits(text):
            seen[i] = seen.get(i, 0) + 1
            if (self.most is None or seen[i] <= self.most) and place != last:
                last = place
                yield place


def hint(phrases: Sequence[str], most: int = 200) -> str | None:
    """Pattern of the longest words of some phrases, for dropping texts that have none of them.

    None where it would not help: a phrase without a word, or more than ``most`` words.
    """
    longest = {max(p.split(), key=len, default="") for p in phrases}
    if "" in longest or len(longest) > most:
        return None
    return "(?iuU)" + "|".join(sorted(re.sub(r"([^\w\s])", r"\\\1", w) for w in longest))
