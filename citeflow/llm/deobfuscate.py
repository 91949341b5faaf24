"""A noisy channel for disguised words: character lattices of leet signs, spacing and repetition, decoded by Viterbi.

A stretch of text that may be disguised (signs among letters, single characters apart, a letter three times or more) becomes
a lattice: each place offers what the writer may have meant, with the channel's cost, and the characters' language model
prices every path. The cheapest one replaces the stretch. Other text has one path, itself, and is not touched.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterable, Iterator

#: What a sign may stand for. Fixed values.
SIGNS = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "€": "e", "(": "c", "*": "aeiou",
}
#: log10 of the channel: a sign for a letter, a sign as itself within a word, a letter drawn out, letters set apart.
DISGUISED, ITSELF, DRAWN_OUT, APART = -0.8, -1.3, -0.5, -0.3
ORDER = 4
EDGE = " "

_LETTER = r"[^\W\d_]"
_SIGN = r"[0-9@$!|+€(*]"
_ONE = rf"(?:{_LETTER}|{_SIGN})"
_END = r"[.,;:?!\"')]*"
#: A token that may be disguised: signs within, in front or behind, letters apart by other signs than spaces, or drawn out.
_MARKS = re.compile(rf"{_LETTER}{_SIGN}+{_LETTER}|^[\"'(]?[0-9@$€]+{_LETTER}{{2}}|{_LETTER}{{2}}[0-9@$€]+{_END}$|^{_ONE}(?:[._-]{_ONE}){{2,}}{_END}$|({_LETTER})\1\1")
_DRAWN = re.compile(rf"({_LETTER})\1\1")
_AROUND = ".,;:?!\"'()|"
#: Single characters with a space between them, at least three.
_APART = re.compile(rf"(?<!\S){_ONE}(?: {_ONE}){{2,}}(?=[\s.,;:?!]|$)")


class Model:
    """Interpolated counts of up to ``ORDER`` characters (Witten and Bell); unseen characters share what is left."""

    def __init__(self, grams: Iterable[tuple[str, int]]) -> None:
        self.counts = dict(grams)
        self.after: dict[str, list[int]] = {}  # by context: how often, how many kinds
        for gram, n in self.counts.items():
            seen = self.after.setdefault(gram[:-1], [0, 0])
            seen[0] += n
            seen[1] += 1
        self.kinds = max(256, 2 * sum(len(g) == 1 for g in self.counts))
        self._known: dict[tuple[str, str], float] = {}

    def cost(self, context: str, c: str) -> float:
        """log10 of the probability of ``c`` after ``context``."""
        key = context, c
        found = self._known.get(key)
        if found is None:
            p = 1 / self.kinds
            for k in range(len(context), -1, -1):
                n, kinds = self.after.get(context[k:], (0, 0))
                if n:
                    p = (self.counts.get(context[k:] + c, 0) + kinds * p) / (n + kinds)
            found = math.log10(p)
            if len(self._known) < 1_000_000:
                self._known[key] = found
        return found


def grams_of(word: str) -> list[str]:
    """The runs of up to ``ORDER`` characters that end at each character of a word and at its end."""
    text = EDGE + word + EDGE
    return [text[max(0, i - k) : i + 1] for i in range(1, len(text)) for k in range(min(ORDER - 1, i) + 1)]


def lattice(stretch: str) -> list[list[tuple[str, float]]]:
    """For each place what may stand there: characters and the channel's cost; EDGE is the border of a word."""
    out: list[list[tuple[str, float]]] = []
    apart = bool(re.fullmatch(rf"{_ONE}(?:[ ._-]{_ONE}){{2,}}", stretch.rstrip(".,;:?!")))
    i = 0
    while i < len(stretch):
        c, j = stretch[i], i + 1
        while j < len(stretch) and stretch[j] == c:
            j += 1
        letters = [(x, DISGUISED) for x in SIGNS.get(c, "")]
        if c.isalpha() and j - i >= 3:
            out.append([(c, DRAWN_OUT), (c + c, DRAWN_OUT), (c * (j - i), 0.0)])
            i = j
            continue
        if c.isalpha():
            out.append([(c, 0.0)])
        elif apart and c in " ._-":
            out.append([("", APART), (EDGE, 0.0)])
        elif c.isdigit():
            if j - i >= 3:
                out.append([(stretch[i:j], 0.0), *((x, cost + DRAWN_OUT) for x, cost in letters)])
                i = j
                continue
            out.append([(c, 0.0), *letters])
        else:
            out.append([(EDGE, ITSELF if letters and c != "!" else 0.0), *letters])
        i += 1
    return out


def paths_cost(model: Model, text: str) -> float:
    """log10 of the probability of a text of words, each from its border to its border; borders together are one."""
    out, context = 0.0, EDGE
    for c in text + EDGE:
        if c == EDGE and context[-1:] == EDGE:
            continue
        out += model.cost(context, c)
        context = EDGE if c == EDGE else (context + c)[-(ORDER - 1) :]
    return out


def decoded(model: Model, stretch: str) -> str:
    """The likeliest text behind a stretch; equal costs are decided by the text, least first."""
    best: dict[str, tuple[float, str]] = {EDGE: (0.0, "")}
    for place in [*lattice(stretch), [(EDGE, 0.0)]]:
        new: dict[str, tuple[float, str]] = {}
        for context, (cost, text) in best.items():
            for chars, channel in place:
                total, now = cost + channel, context
                for c in chars:
                    if c != EDGE or now[-1:] != EDGE:
                        total += model.cost(now, c)
                        now = EDGE if c == EDGE else (now + c)[-(ORDER - 1) :]
                old, found = new.get(now), text + chars
                if old is None or total > old[0] or (total == old[0] and found < old[1]):
                    new[now] = total, found
        best = new
    return best[EDGE][1].strip(EDGE)


def marked(token: str) -> bool:
    """Whether a token (lower case) may be disguised; most are letters between marks, and need one look for drawn out ones."""
    return (_DRAWN if token.strip(_AROUND).isalpha() else _MARKS).search(token) is not None


def pieces(text: str, size: int = 1 << 18) -> Iterator[str]:
    """The text in pieces that end at white space, no run of single characters cut."""
    start = 0
    while start < len(text):
        end = start + size
        while end < len(text) and not (text[end].isspace() and not text[end + 2 : end + 3].isspace()):
            end += 1
        yield text[start:end]
        start = end


class Restorer:
    """Restores texts token by token; remembers what it found in a task, up to a bound."""

    def __init__(self, model: Model, most: int = 200_000) -> None:
        self.model, self.most = model, most
        self.known: dict[str, str] = {}

    def token(self, token: str) -> str:
        """A token (lower case) as it was meant."""
        found = self.known.get(token)
        if found is None:
            found = decoded(self.model, token) if marked(token) else token
            if len(self.known) < self.most:
                self.known[token] = found
        return found

    def tokens(self, text: str) -> Iterator[list[str]]:
        """The tokens of a text in lower case, piece by piece; characters apart by spaces are put together first."""
        for piece in pieces(text):
            piece = piece.lower()
            found = piece.split()
            if sum(len(x) == 1 for x in found) > 2:
                found = _APART.sub(lambda m: ".".join(m.group().split(" ")), piece).split()
            yield found

    def restored(self, text: str) -> str:
        """The restored tokens with a space between them."""
        return " ".join(self.token(x) for found in self.tokens(text) for x in found)
