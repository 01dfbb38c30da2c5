"""License scans: which license notices a text holds, by conditional compression.

Candidate blocks are windows of about a notice's length, wherever they stand in a sentence, line or wrapped
paragraph; windows that lack too many of a notice's words to be it are passed over, which loses nothing.
Each block is compressed alone, and with every candidate notice as a raw zstandard dictionary. The bytes
that a dictionary saves rank the notices: the one that explains most of a block comes first, a longer
notice before one that is part of it. In that order winners are confirmed by their exact wording: an
alignment of the notice with the words there may differ in few words, and in none that decides between
licenses, such as a number, ``lesser`` or a clause (:data:`tidelog.llm.notices.DECISIVE`). A notice that is
not confirmed leaves its words to the next one; all that do not overlap are reported.

Defined results: null and empty texts hold no notice; of equal savings the name that sorts first wins;
notices that repeat in a text are reported once each; rows are scanned one by one, so
repeated rows get equal results; an empty table gives an empty table; only the named columns are read.
"""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import zstandard
from pyspark.sql import DataFrame

from tidelog.llm.batches import map_texts
from tidelog.llm.notices import DECISIVE, NOTICES

# Words of notices that any prose may use.
_PLAIN = frozenset(
    "this that with from under have either later either person files work terms code form free use "
    "software general public version source following".split()
)
# One of these words makes a candidate; of the notices' other rare words it takes two.
_TELLING = frozenset("license licensed licence licenced copyright redistribution".split())
# Of notices longer than this many words only such long ones count as rare: full texts use plain words.
_FULL_TEXT, _LONG_WORD = 40, 10

# A notice may differ from its template by this share of the template's words. On a block it must save
# this share of the bytes that it saves on its own template.
MAX_DIFFERENCE, LEAST_SAVING = 0.2, 0.35

_TELLING_BYTES = frozenset(w.encode() for w in _TELLING)
_APART = bytes(b if b < 0x80 and chr(b).isalnum() else 0x20 for b in range(256))
_WORD = re.compile(r"[A-Za-z0-9]+")
# What makes a number or a name go on behind its last word.
_GOES_ON = re.compile(r"\.[0-9]+|-[A-Za-z0-9]+|\+")
# What closes a notice belongs to its span.
_CLOSE = re.compile(r"""["')\]]*[.!?:;]?""")


def _words(text: str) -> list[str]:
    return [w.lower() for w in _WORD.findall(text)]


class Scanner:
    """Compressors and words of every notice."""

    def __init__(self, notices=NOTICES):
        self.notices = [(name, _words(text)) for name, text in notices]
        self.rare = frozenset(
            w for _, words in self.notices for w in words
            if len(w) > (3 if len(words) <= _FULL_TEXT else _LONG_WORD - 1) and w.isalpha()
        ) - _PLAIN
        self.rare_bytes = frozenset(w.encode() for w in self.rare)
        self.distinct = [sorted(set(words)) for _, words in self.notices]
        self.numbered = [any(w.isdigit() for w in words) for _, words in self.notices]
        self.decisive = [self._decisive(i, words) for i, (_, words) in enumerate(self.notices)]
        # What must not follow a notice: the decisive words by which a longer one goes on.
        self.goes_on = [
            [(len(long) - len(words), self._decisive(j, long[len(words):]).keys())
             for j, (_, long) in enumerate(self.notices)
             if len(long) > len(words) and long[:len(words)] == words and self.decisive[j] != own]
            for (_, words), own in zip(self.notices, self.decisive, strict=True)
        ]
        self.alone = zstandard.ZstdCompressor(level=19)
        self.given = []
        for _, words in self.notices:
            held = zstandard.ZstdCompressionDict(
                (" ".join(words) + " ").encode().rjust(8), dict_type=zstandard.DICT_TYPE_RAWCONTENT
            )
            self.given.append(zstandard.ZstdCompressor(level=19, dict_data=held))
        self.full = [self.saved(i, words)[0] for i, (_, words) in enumerate(self.notices)]

    def _decisive(self, i: int, words: list[str]) -> Counter:
        """The words that decide between licenses, as far as they do for notice ``i``."""
        numbers = self.numbered[i]
        return Counter(w for w in words if w in DECISIVE or numbers and w.isdigit())

    @staticmethod
    def _telling(words, rare: frozenset, telling: frozenset) -> bool:
        return not telling.isdisjoint(words) or len(rare.intersection(words)) > 1

    def regions(self, i: int, at: dict[str, np.ndarray], size: int) -> list[tuple[int, int]]:
        """Runs of words, of ``size``, outside of which notice ``i`` cannot be."""
        allowed = int(MAX_DIFFERENCE * len(self.notices[i][1]))
        own = [at[w] for w in self.distinct[i] if w in at]
        least = max(1, len(self.distinct[i]) - allowed)
        if len(own) < least:
            return []
        # Different words of the notice in the window that ends with each word.
        reach = len(self.notices[i][1]) + allowed
        change = np.zeros(size + 1, np.int32)
        for places in own:
            ends = np.minimum(places + reach, size)
            ends[:-1] = np.minimum(ends[:-1], places[1:])
            np.add.at(change, places, 1)
            np.subtract.at(change, ends, 1)
        full = np.flatnonzero(np.cumsum(change[:-1]) >= least)
        if not len(full):
            return []
        cuts = np.flatnonzero(np.diff(full) > reach)
        starts, stops = full[np.append(0, cuts + 1)], full[np.append(cuts, len(full) - 1)]
        return [(max(0, int(a) - reach + 1), int(b) + 1)
                for a, b in zip(starts, stops, strict=True)]

    def align(self, i: int, words: list[str]) -> list[tuple[int, int, int]]:
        """Blocks within the allowed differences of notice ``i``: differences, first word, end.

        Differences are the notice's words that are missing and the words of others in between; of
        blocks with one end, the one with the fewest differences, and of these the shortest.
        """
        notice = self.notices[i][1]
        allowed, n = int(MAX_DIFFERENCE * len(notice)), len(words)
        codes = {w: k for k, w in enumerate(self.distinct[i])}
        got = np.array([codes.get(w, -1) for w in words], np.int64)
        # Costs in steps of ``unit``; below that, the later start is the smaller number.
        unit, place = n + 1, np.arange(n + 1, dtype=np.int64)
        row = n - place
        for w in notice:
            new = row + unit
            same = np.flatnonzero(got == codes[w]) + 1
            new[same] = np.minimum(new[same], row[same - 1])
            row = np.minimum.accumulate(new - place * unit) + place * unit
        cost, start = row // unit, n - row % unit
        # The last word of a block is the notice's: one word less is no closer.
        ends = np.flatnonzero((cost[1:] <= allowed) & (cost[1:] <= cost[:-1])) + 1
        return [(int(cost[e]), int(start[e]), int(e)) for e in ends if start[e] < e]

    def saved(self, i: int, words: list[str], alone: int | None = None) -> tuple[int, int]:
        """Bytes that notice ``i`` as dictionary saves on the words, and their size without it."""
        data = " ".join(words).encode()
        size = len(self.alone.compress(data)) if alone is None else alone
        return size - len(self.given[i].compress(data)), size

    def ranked(self, words: list[str], regions: list[tuple[int, int, int]]) -> list[tuple]:
        """Candidates ``(-saved, license, notice, first word, end, region)``, the largest saving first.

        Blocks are cut for every notice's length; in each, all notices whose region is there compete.
        """
        blocks = set()
        for i, a, b in regions:
            reach = len(self.notices[i][1]) + int(MAX_DIFFERENCE * len(self.notices[i][1]))
            step = max(1, reach // 4)
            blocks |= {(k, min(k + reach, b)) for k in range(a, max(a + 1, b - reach + step), step)}
        out, known = [], {}
        for a, b in sorted(blocks):
            block = words[a:b]
            for r, (i, low, high) in enumerate(regions):
                if low >= b or high <= a:
                    continue
                key = (i, tuple(block))
                if key not in known:
                    alone = known.get(key[1])
                    saved, known[key[1]] = self.saved(i, block, alone)
                    known[key] = saved
                if known[key] >= LEAST_SAVING * self.full[i]:
                    out.append((-known[key], self.notices[i][0], i, a, b, r))
        return sorted(out)

    def confirmed(self, i: int, text: str, spans: list, words: list[str], start: int, stop: int) -> bool:
        """Whether the words of a block are the notice's in all that decides, and end where it ends."""
        if self._decisive(i, words[start:stop]) != self.decisive[i]:
            return False
        for more, signs in self.goes_on[i]:
            reach = more + int(MAX_DIFFERENCE * more) + 1
            if 2 * len(signs & set(words[stop:stop + reach])) >= len(signs):
                return False
        # A version or a name that goes on, such as 2.1 after 2, or MIT-0; but 3.0 is 3.
        end = spans[stop - 1][1]
        rest = _GOES_ON.match(text, end)
        return rest is None or rest[0] == ".0"

    def scan(self, text: str | None) -> list[dict]:
        """The notices of a whole text, in order."""
        # Most texts are told by their set of words alone.
        every = set((text or "").lower().encode("utf-8", "replace").translate(_APART).split())
        if not self._telling(every, self.rare_bytes, _TELLING_BYTES):
            return []
        spans = [m.span() for m in _WORD.finditer(text)]
        words = [text[a:b].lower() for a, b in spans]
        wanted = frozenset(w for distinct in self.distinct for w in distinct)
        at: dict = {}
        for k, w in enumerate(words):
            if w in wanted:
                at.setdefault(w, []).append(k)
        at = {w: np.array(places) for w, places in at.items()}
        regions = [
            (i, a, b) for i in range(len(self.notices)) for a, b in self.regions(i, at, len(words))
        ]
        taken, out, aligned = np.zeros(len(words), bool), [], {}
        for _, name, i, low, high, r in self.ranked(words, regions):
            if taken[low:high].all():
                continue
            if r not in aligned:
                _, a, b = regions[r]
                aligned[r] = sorted(
                    (apart, a + start, a + stop) for apart, start, stop in self.align(i, words[a:b])
                    if self.confirmed(i, text, spans, words, a + start, a + stop)
                )
            for apart, start, stop in aligned[r]:
                if start < high and stop > low and not taken[start:stop].any():
                    taken[start:stop] = True
                    saved, alone = self.saved(i, words[start:stop])
                    out.append((start, stop, name, saved / alone, apart))
        return [
            {"start": spans[start][0], "stop": _CLOSE.match(text, spans[stop - 1][1]).end(),
             "license": name, "saving": saving, "n_diff": apart}
            for start, stop, name, saving, apart in sorted(out)
        ]


def scan_licenses(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", notices=NOTICES
) -> DataFrame:
    """The id column with ``notices``: span, license, saving and word differences of each."""

    def make():
        scanner = Scanner(notices)
        return lambda texts: {"notices": [scanner.scan(t) for t in texts]}

    return map_texts(
        docs, [id_col], text_col,
        "notices array<struct<start:int,stop:int,license:string,saving:double,n_diff:int>>", make,
    )
