"""Language ID in two steps: the language family first, then the language within the family.

A text is the square root of the shares of its hashed letter trigrams. Linear support vector machines,
one for each pair of classes, vote: first between families, then between the languages of the family
that won. Families are those that are known, each other language is one of its own; where more than
``BRANCH`` families or languages meet, those with like trigrams are put together first, so a language
adds about as many machines as others stand beside it, and there is no bound on languages. The machines
are trained in numpy on a bounded sample that is spread evenly over the languages; every text is scored
whole, in place, without a shuffle.

Machines choose between the learned languages, whatever the text. How well a text fits a language is
measured apart: the mean log ratio of its trigrams' shares in that language to even chance, with three
standard errors granted to it. The fit is that of the chosen language or, if its trigrams are less likely
there than by chance, of the language it fits best; it is negative for texts that fit none.

Defined results: a null text or one without a letter is ``und`` with score 0, and so is every text if
no language can be learned; ties go to the name that sorts first; a language with one document is
learned from it; rows are scored one by one, so repeated rows get equal results; an empty table gives
an empty table; only the named columns are read.
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import combinations

import numpy as np
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidelog.llm.batches import map_texts, remainder

UNKNOWN = "und"
SLOTS = 4096
# Bound of what is learned: documents over all languages, and one of each language at least. A column
# of more values than MOST_LANGUAGES does not name languages, and is refused.
TRAIN_DOCS = 2400
MOST_LANGUAGES = 20_000
# Classes that machines tell apart at once; beyond that, like ones are grouped first.
BRANCH = 12
# Votes are logistic in the margin, with this slope.
SLOPE = 4.0
# Standard errors granted to the fit of a text, and the least share of chance in a language's trigrams.
ERRORS, CHANCE = 3.0, 0.1
# Families of languages with close relatives; any other language is its own family.
FAMILIES = {
    "germanic": "af da de en fy is lb nb nl nn no sv yi",
    "romance": "ca es fr gl it la oc pt ro",
    "slavic": "be bg bs cs hr mk pl ru sk sl sr uk",
    "baltic": "lt lv",
    "uralic": "et fi hu",
    "turkic": "az kk ky tr uz",
    "indic": "bn gu hi mr ne pa ur",
    "semitic": "am ar he mt",
    "austronesian": "id jv ms tl",
}
_FAMILY = {lang: family for family, langs in FAMILIES.items() for lang in langs.split()}
_LETTER = regex.compile(r"\p{L}")
_BARE = bytes(b if b >= 0x80 or chr(b).isalpha() else 0x20 for b in range(256))


def family(lang: str) -> str:
    return _FAMILY.get(lang.lower().split("-")[0], lang)


def trigrams(text: str) -> np.ndarray:
    """Counts of hashed trigrams of letters and gaps, over the whole text."""
    data = (" " + text.lower() + " ").encode("utf-8", "replace").translate(_BARE)
    b = np.frombuffer(data, np.uint8).astype(np.uint32)
    gap = b == 0x20
    real = ~(gap[:-2] & gap[1:-1] | gap[1:-1] & gap[2:])
    mixed = (b[:-2] * 0x9E3779B1 ^ b[1:-1] * 0x85EBCA77 ^ b[2:] * 0xC2B2AE3D)[real]
    mixed ^= mixed >> 15
    return np.bincount(mixed * np.uint32(0x2C1B3C6D) >> 20, minlength=SLOTS)


def features(counts: np.ndarray) -> np.ndarray:
    """Square roots of the shares of trigrams."""
    return np.sqrt(counts / max(1, counts.sum())).astype(np.float32)


def train_svm(x: np.ndarray, y: np.ndarray, cost: float = 4.0, rounds: int = 25) -> np.ndarray:
    """Weights and bias of a linear SVM (y is 1 or -1), by dual coordinate descent."""
    rng = np.random.default_rng(0)
    x = np.hstack([x, np.ones((len(x), 1), np.float32)])
    share = np.where(y > 0, 1 / max(1, (y > 0).sum()), 1 / max(1, (y < 0).sum()))
    bound = cost * share * len(y) / 2
    alpha, w = np.zeros(len(y)), np.zeros(x.shape[1])
    norms = (x.astype(np.float64) ** 2).sum(axis=1)
    for _ in range(rounds):
        moved = 0.0
        for i in rng.permutation(len(y)):
            step = (1 - y[i] * (w @ x[i])) / norms[i]
            new = min(max(alpha[i] + step, 0.0), bound[i])
            if new != alpha[i]:
                w += (new - alpha[i]) * y[i] * x[i]
                moved = max(moved, abs(new - alpha[i]))
                alpha[i] = new
        if moved < 1e-3:
            break
    return w.astype(np.float32)


@dataclass
class Votes:
    """One-versus-one machines between classes."""

    names: list[str]
    pairs: list[tuple[int, int]]
    weights: np.ndarray

    @staticmethod
    def train(x: np.ndarray, labels: list[str], names: list[str]) -> Votes:
        pairs = list(combinations(range(len(names)), 2))
        got = np.array(labels)
        weights = [np.zeros((0, SLOTS + 1), np.float32)]
        for a, b in pairs:
            of = (got == names[a]) | (got == names[b])
            weights.append(train_svm(x[of], np.where(got[of] == names[a], 1.0, -1.0))[None])
        return Votes(names, pairs, np.concatenate(weights))

    def shares(self, x: np.ndarray) -> np.ndarray:
        """Each row's mean vote for each class, between 0 and 1."""
        total = np.zeros((len(x), len(self.names)))
        if not self.pairs:
            return total + 1
        margins = x @ self.weights[:, :-1].T + self.weights[:, -1]
        for k, (a, b) in enumerate(self.pairs):
            vote = 1 / (1 + np.exp(-SLOPE * margins[:, k].astype(np.float64)))
            total[:, a] += vote
            total[:, b] += 1 - vote
        return total / (len(self.names) - 1)


def log_ratios(x: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Log ratios of a language's trigrams to chance, from its texts' features and trigram counts.

    Chance has the share that new trigrams have in the texts: the fewer were seen, the more.
    """
    shares = (x.astype(np.float64) ** 2).mean(axis=0)
    shares /= max(shares.sum(), 1e-9)
    kinds = np.count_nonzero(shares)
    chance = max(CHANCE, kinds / max(1, kinds + sizes.sum()))
    return np.log((1 - chance) * shares * SLOTS + chance)


def group_alike(centres: np.ndarray, groups: int) -> list[list[int]]:
    """Rows put together by their nearest of some rows that lie far apart; each group has one of them."""
    chosen = [0]
    apart = np.full(len(centres), np.inf)
    nearest = np.zeros(len(centres), int)
    for k in range(groups):
        gap = ((centres - centres[chosen[-1]]) ** 2).sum(axis=1)
        nearest = np.where(gap < apart, k, nearest)
        apart = np.minimum(apart, gap)
        chosen.append(int(apart.argmax()))
    return [g for k in range(groups) if (g := np.flatnonzero(nearest == k).tolist())]


@dataclass
class Tree:
    """Machines between groups of languages, and what tells each group's languages apart."""

    votes: Votes
    below: list[Tree | str]

    @staticmethod
    def grow(x: np.ndarray, langs: np.ndarray, groups: list[list[str]]) -> Tree | str:
        """``groups`` of languages are told apart first, then the languages of each."""
        if len(groups) == 1:
            if len(groups[0]) == 1:
                return groups[0][0]
            groups = [[lang] for lang in groups[0]]
        whole = groups
        if len(groups) > BRANCH:
            centres = np.stack([x[np.isin(langs, g)].mean(axis=0) for g in groups])
            alike = group_alike(centres, BRANCH)
            if len(alike) > 1:  # equal centres cannot be grouped: their machines meet at once
                whole = [[lang for i in some for lang in groups[i]] for some in alike]
        of = {lang: k for k, g in enumerate(whole) for lang in g}
        labels = [str(of[lang]) for lang in langs.tolist()]
        votes = Votes.train(x, labels, [str(k) for k in range(len(whole))])
        below = []
        for g in whole:
            own = np.isin(langs, g)
            inside = [h for h in groups if h[0] in set(g)] if whole is not groups else [g]
            below.append(Tree.grow(x[own], langs[own], inside))
        return Tree(votes, below)

    def predict(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Each row's language, and the product of the shares of votes that led to it."""
        langs, scores = np.empty(len(x), object), np.zeros(len(x))
        if not len(x):
            return langs, scores
        shares = self.votes.shares(x)
        best = shares.argmax(axis=1)
        for k, child in enumerate(self.below):
            own = np.flatnonzero(best == k)
            if isinstance(child, str):
                langs[own], scores[own] = child, shares[own, k]
            elif len(own):
                found, inner = child.predict(x[own])
                langs[own], scores[own] = found, inner * shares[own, k]
        return langs, scores


@dataclass
class Model:
    """Machines between families and between the languages of each; log ratios by language."""

    tree: Tree
    ratios: dict[str, np.ndarray]

    @staticmethod
    def train(x: np.ndarray, langs: list[str], sizes: list[int]) -> Model | None:
        if not langs:
            return None
        names = sorted(set(langs))
        families: dict[str, list[str]] = {}
        for lang in names:
            families.setdefault(family(lang), []).append(lang)
        got, sizes = np.array(langs, object), np.array(sizes)
        tree = Tree.grow(x, got, [families[f] for f in sorted(families)])
        if isinstance(tree, str):
            tree = Tree(Votes.train(x, ["0"] * len(x), ["0"]), [tree])
        ratios = {lang: log_ratios(x[got == lang], sizes[got == lang]) for lang in names}
        return Model(tree, ratios)

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float], list[float | None]]:
        """Languages, scores and fits; ``und`` has no fit."""
        langs, scores = [UNKNOWN] * len(texts), [0.0] * len(texts)
        fits: list[float | None] = [None] * len(texts)
        rows = [i for i, t in enumerate(texts) if t and _LETTER.search(t)]
        if rows:
            counts = [trigrams(texts[i]) for i in rows]
            found, shares = self.tree.predict(np.stack([features(c) for c in counts]))
            for i, row in enumerate(rows):
                langs[row], scores[row] = found[i], float(shares[i])
                fit = self.fit_of(counts[i], found[i])
                if fit < 0:
                    fit = max(self.fit_of(counts[i], lang) for lang in self.ratios)
                fits[row] = fit
        return langs, scores, fits

    def fit_of(self, counts: np.ndarray, lang: str) -> float:
        """The mean log ratio of a text's trigrams, with the standard errors granted to it."""
        at = np.flatnonzero(counts)
        n = counts[at].sum()
        if not n:
            return 0.0
        ratios = self.ratios[lang][at]
        mean = counts[at] @ ratios / n
        spread = max(0.0, counts[at] @ (ratios - mean) ** 2 / n)
        return float(mean + ERRORS * (spread / n) ** 0.5)


def fit(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    train_docs: int = TRAIN_DOCS,
) -> Model | None:
    """Learn from at most ``train_docs`` documents, as many of each language as there can be, but one
    of each language at least."""
    known = docs.select(
        docs[id_col].alias("id"), docs[text_col].alias("text"), docs[lang_col].alias("lang")
    ).where(F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}"))
    counts = docs.where(docs[lang_col].isNotNull() & docs[text_col].isNotNull()).groupBy(
        docs[lang_col].alias("lang")
    ).agg(F.count("*").alias("n"))
    counts = counts.limit(MOST_LANGUAGES + 1).collect()
    if not counts:
        return None
    if len(counts) > MOST_LANGUAGES:
        raise ValueError(f"{lang_col} has more than {MOST_LANGUAGES} values: it does not name languages")
    each = max(1, train_docs // len(counts))
    # Twice as many candidates as are kept, by a hash, so that few texts are read through.
    # Few would be too few by chance.
    several = max(2 * each, 64)
    shares = docs.sparkSession.createDataFrame(
        [(r.lang, min(1.0, several / r.n)) for r in counts], "lang string, share double"
    )
    draw = F.xxhash64(F.col("id").cast("string"), "text")
    some = known.join(F.broadcast(shares), "lang").where(
        F.pmod(draw, F.lit(1 << 20)) < F.col("share") * (1 << 20)
    ).withColumn("draw", draw)

    def make():
        def step(texts):
            counts = [trigrams(t) for t in texts]
            return {"x": [features(c).astype("<f2").tobytes() for c in counts],
                    "n": [int(c.sum()) for c in counts]}

        return step

    made = map_texts(some, ["lang", "draw"], "text", "x binary, n long", make)
    first = Window.partitionBy("lang").orderBy("draw", "x")
    rows = made.withColumn("r", F.row_number().over(first)).where(F.col("r") <= each).collect()
    if not rows:
        return None
    rows.sort(key=lambda r: (r.lang, r.r))
    x = np.stack([np.frombuffer(r.x, "<f2") for r in rows]).astype(np.float32)
    return Model.train(x, [r.lang for r in rows], [r.n for r in rows])


def predict(
    docs: DataFrame, model: Model | None, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """The id column with ``lang_pred`` and ``score`` (0 to 1) of every whole text."""
    return predict_keeping(docs, model, [id_col], text_col).drop("fit")


def predict_keeping(
    docs: DataFrame, model: Model | None, keep: list[str], text_col: str = "text"
) -> DataFrame:
    """The ``keep`` columns with ``lang_pred``, ``score`` and ``fit`` (null for ``und``)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def make():
        def step(texts):
            if shared.value is None:
                n = len(texts)
                return {"lang_pred": [UNKNOWN] * n, "score": [0.0] * n, "fit": [None] * n}
            langs, scores, fits = shared.value.predict(texts)
            return {"lang_pred": langs, "score": scores, "fit": fits}

        return step

    return map_texts(docs, keep, text_col, "lang_pred string, score double, fit double", make)


def held_out(docs: DataFrame, id_col: str = "doc_id"):
    """Rows that are never learned from: crc32 of the id's text leaves 2 by 4."""
    return remainder(docs[id_col], 4) == 2
