"""Toxicity: restore disguised words by a noisy channel, then score the restored text.

Words that hide letters (digits and signs for letters, separators or spaces between letters, letters
repeated) become lattices of what was meant. Viterbi search picks the path that a character trigram
model and the costs of the channel like best; the model is counted over all documents learned from. A
word without any such sign is a lattice with one path and stays as it is.

Restored words, and their first four and five letters, are scored by a lexicon of log-odds learned from
labelled documents; a logistic function of a document's hits gives the score.

Defined results: null and empty texts have no words and get the score of a text without hits; labels
that are null are not learned from; if there are no labels of both kinds every score is 0; repeated rows
are scored one by one; an empty table gives an empty table; only the named columns are read.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelog.llm.batches import labelled, map_texts, remainder, ship_package, steps
from tidelog.session import stage

# Bounds of what is learned: labelled documents, and entries of the lexicon.
TRAIN_DOCS = 20_000
LEXICON = 20_000
# A lexicon entry occurs in so many toxic documents, so many times likelier than in others.
MIN_DOCS, MIN_RATIO = 5, 20.0
# Tokens that each of the cache's two generations may hold.
CACHE_TOKENS = 300_000

# Letters that digits and signs may stand for.
LEET = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b",
    "9": "g", "@": "a", "$": "s", "!": "il", "|": "il", "+": "t", "(": "c", "€": "e", "£": "l",
}
SEPARATORS = " .-_*~·'\"/\\,:;#%^&=<>)[]{}?`"
# Costs of the channel in nats: a sign for a letter, a separator, a repeated letter.
SIGN, GAP, REPEAT = 0.5, 0.3, 1.0

_EDGE, _OTHER, _SYMBOLS = 26, 27, 28
_SIGNS = re.escape("".join(LEET))
_HIDING = re.compile(rf"[{_SIGNS}]|(.)\1\1|\w[{re.escape(SEPARATORS)}]+\w")
_SPACED = re.compile(rf"(?<!\S)(?:[^\W_]|[{_SIGNS}])(?:\s+(?:[^\W_]|[{_SIGNS}])){{2,}}(?!\S)")
_BLANKS = re.compile(r"\s+")
_CORE = re.compile(r"[^\W\d_](?:.*[^\W\d_])?", re.DOTALL)
_SIDES = re.compile(rf"[{_SIGNS}]{{0,2}}[^\W\d_](?:.*[^\W\d_])?[{_SIGNS}]{{0,2}}", re.DOTALL)
_RUNS = re.compile(r"(.)\1+", re.DOTALL)
_DOUBLED = re.compile(r"([^\W\d_])\1")
# Words of one letter in the languages that use these letters.
_ALONE = frozenset("aeiouy")


def _symbol(letter: str) -> int:
    return ord(letter) - 97 if "a" <= letter <= "z" else _OTHER if letter.isalpha() else _EDGE


def trigram_counts(texts: Iterable[str | None]) -> np.ndarray:
    """Counts of three symbols in a row (letters a to z, an edge, any other letter)."""
    # Bytes of letters beyond ASCII count as one symbol each; runs of edges are not counted.
    data = np.frombuffer(
        "  ".join(["", *(t.lower() for t in texts if t), ""]).encode("utf-8", "replace"), np.uint8
    )
    table = np.full(256, _EDGE, np.int32)
    table[97:123] = np.arange(26)
    table[0x80:] = _OTHER
    s = table[data]
    if len(s) < 3:
        return np.zeros(_SYMBOLS ** 3, np.int64)
    code = (s[:-2] * _SYMBOLS + s[1:-1]) * _SYMBOLS + s[2:]
    code = code[~((s[1:-1] == _EDGE) & (s[2:] == _EDGE))]
    return np.bincount(code, minlength=_SYMBOLS ** 3)


class Channel:
    """Viterbi search over the letters that a disguised word may mean."""

    def __init__(self, counts: np.ndarray):
        c3 = counts.reshape(_SYMBOLS, _SYMBOLS, _SYMBOLS).astype(float)
        c2 = c3.sum(axis=0)
        p1 = (c2.sum(axis=0) + 1) / (c2.sum() + _SYMBOLS)
        p2 = (c2 + 5 * p1) / (c2.sum(axis=1, keepdims=True) + 5)
        p3 = (c3 + 5 * p2) / (c3.sum(axis=2, keepdims=True) + 5)
        self.cost = (-np.log(p3)).tolist()

    def restore(self, word: str, repeats: bool = True) -> str:
        """The likeliest letters behind ``word`` (in lower case); repeats may be dropped."""
        paths = {(_EDGE, _EDGE): (0.0, None)}
        previous = ""
        for sign in word:
            moves = []
            if sign.isalpha():
                moves.append((sign, 0.0))
            moves += [(letter, SIGN) for letter in LEET.get(sign, "")]
            if sign in SEPARATORS or not moves:
                moves.append(("", GAP))
            if repeats and sign == previous:
                moves.append(("", REPEAT))
            previous = sign
            after: dict = {}
            for (a, b), (cost, path) in paths.items():
                for letter, extra in moves:
                    if letter:
                        c = _symbol(letter)
                        key, to = (b, c), (cost + extra + self.cost[a][b][c], (path, letter))
                    else:
                        key, to = (a, b), (cost + extra, path)
                    if key not in after or to[0] < after[key][0]:
                        after[key] = to
            paths = after
        _, path = min(
            ((cost + self.cost[a][b][_EDGE], path) for (a, b), (cost, path) in paths.items()),
            key=lambda x: x[0],
        )
        letters = []
        while path:
            path, letter = path
            letters.append(letter)
        return "".join(reversed(letters))

    def words(self, letters: str) -> set[str]:
        """What letters that stood apart may say: one word, or the likeliest words in a row.

        Between two letters the lattice may close a word and begin the next one.
        """
        paths = {(_EDGE, _EDGE): (0.0, None)}
        for at, sign in enumerate(letters):
            moves = [(sign, 0.0)] if sign.isalpha() else []
            moves += [(letter, SIGN) for letter in LEET.get(sign, "")]
            after: dict = {}
            for (a, b), (cost, path) in paths.items():
                for letter, extra in moves or [("", GAP)]:
                    if not letter:
                        ways = [((a, b), cost + extra, path)]
                    else:
                        c = _symbol(letter)
                        ways = [((b, c), cost + extra + self.cost[a][b][c], (path, letter))]
                        if at and b != _EDGE:
                            close = self.cost[a][b][_EDGE] + self.cost[b][_EDGE][c]
                            ways.append(((_EDGE, c), cost + extra + close, (path, f" {letter}")))
                    for key, total, way in ways:
                        if key not in after or total < after[key][0]:
                            after[key] = (total, way)
            paths = after
        _, path = min(
            ((cost + self.cost[a][b][_EDGE], path) for (a, b), (cost, path) in paths.items()),
            key=lambda x: x[0],
        )
        said = []
        while path:
            path, letter = path
            said.append(letter)
        whole = {self.restore(letters), self.restore(_RUNS.sub(r"\1", letters))}
        # A word of one letter may stand in front of the spaced one.
        rest = {self.restore(letters[1:])} if len(letters) > 3 and letters[0] in _ALONE else set()
        return whole | rest | {w for w in "".join(reversed(said)).split() if len(w) > 2}

    def readings(self, token: str) -> set[str]:
        """What a token of text may say: itself without signs around it, and its restored forms."""
        core = _CORE.search(token)
        if not core:
            return set()
        out = {core[0]}
        if _DOUBLED.search(core[0]):
            out.add(_RUNS.sub(r"\1", core[0]))
        for shape in {core[0], _SIDES.search(token)[0]}:
            if _HIDING.search(shape):
                out.add(self.restore(shape))
                out.add(self.restore(_RUNS.sub(r"\1", shape)))
                out.add(self.restore(_RUNS.sub(r"\1\1", shape), repeats=False))
        return out


def entries(word: str) -> list[str]:
    """Lexicon entries that a word may hit: itself, and how it starts."""
    return [word, f"^{word[:4]}", f"^{word[:5]}"] if len(word) > 5 else [word]


def tokens(text: str | None) -> tuple[set[str], list[str]]:
    """Distinct tokens in lower case, and runs of three or more letters with blanks between them.

    A run whose gaps differ is cut at the wider ones, where words end.
    """
    if not text:
        return set(), []
    lower, runs = text.lower(), []
    for found in _SPACED.finditer(lower):
        letters, gaps = _BLANKS.split(found[0]), _BLANKS.findall(found[0])
        narrow, start = min(map(len, gaps)), 0
        for i, gap in enumerate([*gaps, None], 1):
            if gap is None or len(gap) > narrow:
                if i - start > 2:
                    runs.append("".join(letters[start:i]))
                start = i
    return set(lower.split()), runs


@dataclass
class Model:
    """The channel's trigrams, the lexicon, and the logistic function of hits."""

    counts: np.ndarray
    lexicon: dict[str, float]
    curve: np.ndarray

    def scorer(self):
        channel, weights = Channel(self.counts), self.lexicon.get
        young: dict[str, float] = {}
        old: dict[str, float] = {}

        def weigh(readings: set[str]) -> float:
            return max((weights(e, 0.0) for w in readings for e in entries(w)), default=0.0)

        def hits(text: str | None) -> tuple[float, float]:
            """The summed weight, and the number, of different tokens that hit the lexicon."""
            nonlocal young, old
            found, runs = tokens(text)
            total = count = 0.0
            for token in found:
                weight = young.get(token)
                if weight is None:
                    weight = old.get(token)
                    if weight is None:
                        weight = weigh(channel.readings(token))
                    if len(young) >= CACHE_TOKENS:
                        young, old = {}, young
                    if len(token) <= 64:
                        young[token] = weight
                if weight:
                    total += weight
                    count += 1
            for run in runs:
                weight = weigh(channel.words(run))
                if weight:
                    total += weight
                    count += 1
            return total, count

        return hits

    def score(self, total: float, count: float) -> float:
        z = self.curve @ np.array([1.0, math.log1p(total), math.log1p(count)])
        return float(1 / (1 + math.exp(-max(-30.0, min(30.0, z)))))


def held_out(docs: DataFrame, id_col: str = "doc_id") -> Column:
    """Rows that are never learned from: crc32 of the id's text leaves 1 by 3."""
    return remainder(docs[id_col], 3) == 1


def _count_trigrams(docs: DataFrame, text_col: str) -> np.ndarray:
    """Trigram counts over all rows, added up by Spark."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(_SYMBOLS ** 3, np.int64)
        for batch in batches:
            column = batch.column(0)
            for a, b in steps(column):
                total += trigram_counts(column.slice(a, b - a).to_pylist())
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], ["code", "n"])

    parts = docs.select(docs[text_col].alias("text")).mapInArrow(run, "code long, n long")
    out = np.zeros(_SYMBOLS ** 3, np.int64)
    for row in parts.groupBy("code").agg(F.sum("n").alias("n")).collect():
        out[row.code] = row.n
    return out


def _learn_lexicon(
    known: DataFrame, counts: np.ndarray, toxic: int, clean: int, bound: int
) -> dict[str, float]:
    """Entries that are much commoner in toxic documents, with their log-odds."""
    shared = known.sparkSession.sparkContext.broadcast(counts)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        channel = Channel(shared.value)
        for batch in batches:
            for a, b in steps(batch.column(0)):
                seen = (Counter(), Counter())
                part = batch.slice(a, b - a)
                for text, label in zip(*(c.to_pylist() for c in part.columns), strict=True):
                    found, runs = tokens(text)
                    words = {w for t in found for w in channel.readings(t)}
                    words |= {w for r in runs for w in channel.words(r)}
                    seen[label].update({e for w in words for e in entries(w)})
                names = list(seen[0].keys() | seen[1].keys())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(names), *(pa.array([s[n] for n in names], pa.int64()) for s in seen)],
                    ["entry", "clean", "toxic"],
                )

    made = known.select("text", "label").mapInArrow(
        run, "entry string, clean long, toxic long"
    ).groupBy("entry").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
    odds = F.log(
        ((F.col("toxic") + 0.5) / (toxic + 1)) / ((F.col("clean") + 0.5) / (clean + 1))
    )
    best = made.where(F.col("toxic") >= MIN_DOCS).withColumn("odds", odds).where(
        F.col("odds") >= math.log(MIN_RATIO)
    ).orderBy(F.desc("toxic"), "entry").limit(bound)
    return {r.entry: r.odds for r in best.collect()}


def _fit_curve(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Logistic regression with a light penalty, by Newton steps."""
    x = np.column_stack([np.ones(len(x)), np.log1p(x)])
    w = np.zeros(x.shape[1])
    keep = np.diag([1e-6, 1e-2, 1e-2]) * len(x) ** 0.5
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (p - y) + keep @ w
        bend = (x * (p * (1 - p))[:, None]).T @ x + keep + 1e-9 * np.eye(len(w))
        step = np.linalg.solve(bend, slope)
        w -= step
        if abs(step).max() < 1e-8:
            break
    return w


def fit(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
    train_docs: int = TRAIN_DOCS,
    lexicon: int = LEXICON,
) -> Model | None:
    """Learn the channel from all of ``docs``, and the scores from at most ``train_docs`` labels."""
    ship_package(docs.sparkSession)
    known = stage(labelled(docs, labels, label_col, train_docs, id_col, text_col), "labelled-texts")
    sizes = {r.label: r.n for r in known.groupBy("label").agg(F.count("*").alias("n")).collect()}
    if len(sizes) < 2:
        return None
    counts = _count_trigrams(docs, text_col)
    words = _learn_lexicon(known, counts, sizes[1], sizes[0], lexicon)
    draft = Model(counts, words, np.zeros(3))
    rows = _hits(known, draft, ["label"], "text").collect()
    rows.sort(key=lambda r: (r.label, r.total, r["count"]))
    x = np.array([(r.total, r["count"]) for r in rows])
    draft.curve = _fit_curve(x, np.array([r.label for r in rows], float))
    return draft


def _hits(docs: DataFrame, model: Model, keep: list[str], text_col: str) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def make():
        hits = shared.value.scorer()

        def step(texts):
            total, count = zip(*map(hits, texts), strict=True)
            return {"total": list(total), "count": list(count)}

        return step

    return map_texts(docs, keep, text_col, "total double, count double", make)


def score(
    docs: DataFrame, model: Model | None, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """The id column with ``score`` (0 to 1, higher is more toxic) of every whole text."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def make():
        if shared.value is None:
            return lambda texts: {"score": [0.0] * len(texts)}
        hits = shared.value.scorer()
        return lambda texts: {"score": [shared.value.score(*hits(t)) for t in texts]}

    return map_texts(docs, [id_col], text_col, "score double", make)
