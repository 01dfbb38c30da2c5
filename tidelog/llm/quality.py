"""Quality: a linear-chain conditional random field over lines, folded into a score per document.

Every line of a text is good or bad. What speaks for either are shares of kinds of characters, repeated
words and the like, of the line itself and of the lines before and after it, and how labels follow one
another. Forward-backward gives each line its chance to be good; a document's quality is their mean,
weighted by the lines' lengths, put on the scale of the labels by a logistic function. Lines of a
labelled document learn its label.

All lines of many documents are one chain for the computation: the matrix at a document's first line
forgets what came before it. So one scan does forward, and one backward, for a whole batch.

Defined results: a null or empty text is one empty line and gets that line's score; null labels are not
learned from; without labels of both kinds every score is the share of good ones (1 if there are none);
repeated rows are scored one by one; an empty table gives an empty table; only the named columns are
read.
"""

from __future__ import annotations

from dataclasses import dataclass
from operator import eq

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelog.llm.batches import labelled, map_texts, remainder
from tidelog.llm.scans import chain

# Bounds of what is learned: labelled documents, and lines over all of them. If they have more, the
# longest documents are learned from in part, by evenly spaced runs of so many lines.
TRAIN_DOCS = 3000
TRAIN_LINES = 300_000
RUN = 25
ROUNDS, RATE, PENALTY = 250, 0.05, 1e-4

_KINDS = 8
(_LOWER, _UPPER, _DIGIT, _SPACE, _POINT, _BANG, _SIGN, _BEYOND) = range(_KINDS)


def _kind(byte: int) -> int:
    letter = chr(byte)
    if byte >= 0x80:
        return _BEYOND
    if letter.isalpha():
        return _LOWER if letter.islower() else _UPPER
    if letter.isdigit():
        return _DIGIT
    if letter.isspace() or byte < 0x20:
        return _SPACE
    return _BANG if letter == "!" else _POINT if letter in ".,;:'\"-?()" else _SIGN


_TABLE = np.array([_kind(b) for b in range(256)], np.int64)
FEATURES = 18


def line_features(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Features of every line of all texts, the lines' lengths in bytes, and each text's lines."""
    lines = [(t or "").split("\n") for t in texts]
    counts = np.array([len(x) for x in lines])
    data = "\n".join(t or "" for t in texts).encode("utf-8", "replace")
    b = np.frombuffer(data, np.uint8)
    broken = b == 10
    line = np.cumsum(broken)
    n = int(counts.sum())
    kinds = np.bincount(
        (line * _KINDS + _TABLE[b])[~broken], minlength=n * _KINDS
    ).reshape(n, _KINDS).astype(float)
    size = kinds.sum(axis=1)
    some = np.maximum(size, 1)
    words = np.zeros((n, 3))
    same = np.zeros(n)
    i = 0
    for own in lines:
        before = None
        for text in own:
            w = text.split()
            if w:
                words[i] = len(w), len(set(w)), sum(map(eq, w, w[1:]))
            same[i] = text == before
            before = text
            i += 1
    total = np.maximum(words[:, 0], 1)
    letters = np.maximum(kinds[:, _LOWER] + kinds[:, _UPPER] + kinds[:, _BEYOND], 1)
    share = kinds / some[:, None]
    upper = kinds[:, _UPPER] / letters
    different, again = words[:, 1] / total, words[:, 2] / total
    x = np.column_stack([
        np.log1p(size) / 5, upper, share[:, _DIGIT], share[:, _SPACE], share[:, _POINT],
        share[:, _BANG], share[:, _SIGN], share[:, _BEYOND], different, again,
        size / total / 10, same, size == 0,
        (upper > 0.5) & (words[:, 0] > 2), share[:, _SIGN] > 0.02, share[:, _BANG] > 0.02,
        again > 0.1, (different < 0.5) & (words[:, 0] > 7),
    ]).astype(float)
    x[:, 10] = np.minimum(x[:, 10], 5)
    return x, size, counts


def with_neighbours(x: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Each line's features beside those of the lines before and after it in its document."""
    last = np.append(first[1:], True)
    before, after = np.zeros_like(x), np.zeros_like(x)
    before[1:] = x[:-1]
    after[:-1] = x[1:]
    before[first], after[last] = 0, 0
    return np.hstack([np.ones((len(x), 1)), x, before, after, first[:, None], last[:, None]])


def firsts(counts: np.ndarray) -> np.ndarray:
    """Whether each line is the first of its document."""
    out = np.zeros(int(counts.sum()), bool)
    out[np.cumsum(counts) - counts] = True
    return out


def marginals(
    score: np.ndarray, first: np.ndarray, moves: np.ndarray, begin: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Each line's chances (bad, good), and of each pair of neighbours' labels."""
    score = np.clip(score, -40, 40)
    emit = np.column_stack([np.exp(-np.maximum(score, 0)), np.exp(np.minimum(score, 0))])
    step = np.exp(moves - moves.max())
    full = step[None] * emit[:, None, :]
    start = np.exp(begin - begin.max())
    full[first] = (start * emit[first])[:, None, :]
    alpha = chain(np.array([0.5, 0.5]), full)
    # Backward is the same chain, reversed, over transposed matrices.
    beta = np.ones_like(alpha)
    if len(full) > 1:
        beta[:-1] = chain(np.array([0.5, 0.5]), full[:0:-1].transpose(0, 2, 1))[::-1]
    both = alpha * beta
    both /= both.sum(axis=1, keepdims=True)
    pairs = np.zeros((len(full), 2, 2))
    pairs[1:] = alpha[:-1, :, None] * full[1:] * beta[1:, None, :]
    pairs[first] = 0
    total = pairs.sum(axis=(1, 2), keepdims=True)
    return both, pairs / np.where(total > 0, total, 1)


@dataclass
class Model:
    """Weights of the lines' features, of label changes and of first labels; the final curve."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    moves: np.ndarray
    begin: np.ndarray
    curve: tuple[float, float]

    def good(self, x: np.ndarray, counts: np.ndarray) -> np.ndarray:
        first = firsts(counts)
        full = (with_neighbours(x, first) - self.mean) / self.scale
        return marginals(full @ self.weights, first, self.moves, self.begin)[0][:, 1]

    def qualities(self, x: np.ndarray, size: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """Length-weighted mean of the lines' chances to be good, per document."""
        weight = size + 1
        at = np.cumsum(counts) - counts
        return np.add.reduceat(self.good(x, counts) * weight, at) / np.add.reduceat(weight, at)

    def scores(self, texts: list[str | None]) -> list[float]:
        q = self.qualities(*line_features(texts))
        return _curve(q, *self.curve).tolist()


def _curve(q: np.ndarray, a: float, b: float) -> np.ndarray:
    q = np.clip(q, 1e-4, 1 - 1e-4)
    return 1 / (1 + np.exp(-(a + b * np.log(q / (1 - q)))))


def train(x: np.ndarray, size: np.ndarray, counts: np.ndarray, labels: np.ndarray) -> Model:
    """Maximum conditional likelihood of the lines' labels, by gradient steps over all lines."""
    first = firsts(counts)
    full = with_neighbours(x, first)
    mean, scale = full.mean(axis=0), full.std(axis=0) + 1e-6
    mean[0], scale[0] = 0, 1
    full = (full - mean) / scale
    y = np.repeat(labels, counts)
    # Every document weighs the same, however many lines it has.
    weight = np.repeat(1 / counts, counts) / len(counts)
    target = np.zeros((2, 2))
    inner = ~first
    np.add.at(target, (y[:-1][inner[1:]], y[1:][inner[1:]]), weight[1:][inner[1:]])
    heads = np.bincount(y[first], weight[first], minlength=2)
    params = np.zeros(full.shape[1] + 6)
    m, v = np.zeros_like(params), np.zeros_like(params)
    for t in range(1, ROUNDS + 1):
        w, moves, begin = params[:-6], params[-6:-2].reshape(2, 2), params[-2:]
        both, pairs = marginals(full @ w, first, moves, begin)
        slope = np.concatenate([
            full.T @ (weight * (y - both[:, 1])),
            (target - (pairs * weight[:, None, None]).sum(axis=0)).ravel(),
            heads - (both[first] * weight[first, None]).sum(axis=0),
        ]) - PENALTY * params
        m = 0.9 * m + 0.1 * slope
        v = 0.999 * v + 0.001 * slope ** 2
        params = params + RATE * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.999 ** t)) + 1e-9)
    model = Model(mean, scale, params[:-6], params[-6:-2].reshape(2, 2), params[-2:], (0.0, 1.0))
    q = np.clip(model.qualities(x, size, counts), 1e-4, 1 - 1e-4)
    model.curve = _fit_curve(np.log(q / (1 - q)), labels)
    return model


def _fit_curve(z: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Logistic regression on one value, by Newton steps with a light penalty."""
    x = np.column_stack([np.ones(len(z)), z])
    w = np.array([0.0, 1.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (p - y) + 0.1 * w
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + 0.1 * np.eye(2), slope)
        w -= np.clip(step, -2, 2)
        if abs(step).max() < 1e-8:
            break
    return float(w[0]), float(w[1])


def held_out(docs: DataFrame, id_col: str = "doc_id") -> Column:
    """Rows that are never learned from: crc32 of the id's text is divisible by 5."""
    return remainder(docs[id_col], 5) == 0


def longest_part(sizes: list[tuple[int, int]], total: int) -> int:
    """The most lines a document may give, so that all give at most ``total``; at least one each.

    ``sizes`` are numbers of lines with how many documents have them.
    """
    left, docs = total, sum(d for _, d in sizes)
    for n, d in sorted(sizes):
        if n * docs > left:
            return max(1, left // docs)
        left, docs = left - n * d, docs - d
    return max((n for n, _ in sizes), default=1)


def spread_lines(lines: int, most: int, run: int = RUN) -> np.ndarray:
    """Which of a document's lines are learned from: all, or evenly spaced runs that make ``most``."""
    if lines <= most:
        return np.arange(lines)
    run = min(run, most)
    runs = most // run
    starts = np.linspace(0, lines - run, runs).astype(int) if runs > 1 else [(lines - run) // 2]
    return np.unique(np.concatenate([np.arange(s, s + run) for s in starts]))


def fit(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
    train_docs: int = TRAIN_DOCS,
    train_lines: int = TRAIN_LINES,
) -> Model | float:
    """Learn from at most ``train_docs`` labelled documents and ``train_lines`` lines of theirs.

    Lines become features where the texts are; only those reach the driver. An id on several rows is
    learned from once. Without labels of both kinds the share of good labels is returned, and stands
    for every score.
    """
    known = labelled(docs, labels, label_col, train_docs, id_col, text_col, once=True)
    lines = F.size(F.split(F.coalesce("text", F.lit("")), "\n"))
    sizes = known.groupBy(lines.alias("n")).agg(F.count("*").alias("docs")).collect()
    most = longest_part([(r.n, r.docs) for r in sizes], train_lines)

    def make():
        def step(texts):
            x, size, counts = line_features(texts)
            at = np.cumsum(counts)[:-1]
            rows = zip(np.split(x, at), np.split(size, at), counts.tolist(), strict=True)
            made = [
                np.column_stack([a, s])[spread_lines(c, most)].astype("<f4").tobytes()
                for a, s, c in rows
            ]
            return {"lines": made}

        return step

    rows = map_texts(known, ["label"], "text", "lines binary", make)
    rows = sorted(rows.collect(), key=lambda r: (r.label, bytes(r.lines)))
    y = np.array([r.label for r in rows], np.int64)
    if len(set(y.tolist())) < 2:
        return float(y.mean()) if len(y) else 1.0
    tables = [np.frombuffer(r.lines, "<f4").reshape(-1, FEATURES + 1) for r in rows]
    whole = np.concatenate(tables).astype(float)
    return train(whole[:, :-1], whole[:, -1], np.array([len(t) for t in tables]), y)


def score(
    docs: DataFrame, model: Model | float, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """The id column with ``score`` (0 to 1, higher is better) of every whole text."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def make():
        if isinstance(shared.value, float):
            return lambda texts: {"score": [shared.value] * len(texts)}
        return lambda texts: {"score": shared.value.scores(texts)}

    return map_texts(docs, [id_col], text_col, "score double", make)
