"""LM scoring: a log-bilinear model over words, trained by noise-contrastive estimation.

The words of all training documents are counted in Spark. The commonest ones, the end of a text among
them, are classes of their own; all rarer words form one class. The vector predicted for a position is
the sum of the two previous classes' vectors, each scaled by position; its product with a class's vector,
plus a bias, is the class's score. Training passes over the counts of all class trigrams in the corpus:
every partition takes gradient steps against shared noise samples in numpy, and Spark averages the
parameters between rounds. The model has a fixed number of contexts, so their normalisers come from
batched matrix products once, and every token's log-probability is exactly normalised.

A rare word's probability is that of its class times its smoothed share of the class's counts. Counts of
the commonest words travel to the tasks (a fixed number of them); all others are joined by a shuffle of
the words' hashes, each document's different rare words once.

Defined results: null and empty texts are one end token; without training documents every count is 0 and
the score is the base score; rows that repeat a document are scored alike; an empty table gives an empty
table; only the named columns are read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelog.llm.batches import (
    DOC_KEY,
    document_key,
    map_texts,
    remainder,
    ship_package,
    steps,
)
from tidelog.session import scratch, stage

# Classes of the model (the last one holds all rarer words), the vectors' length, training rounds, and
# the partitions of the trigram table a round starts from at least.
CLASSES, WIDTH, ROUNDS = 1024, 16, 2
# Counts that travel to every task: a fixed number, whatever the corpus.
HEAD = 1 << 18
BATCH, NOISE, RATE = 2048, 32, 0.008
# Hashes a task gathers before it counts them.
_HELD = 1 << 21

END = np.uint64(xxhash.xxh3_64_intdigest(b"")).astype(np.int64)


def hashes(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all tokens, each text's end included, and the number of tokens of each text."""
    split = [t.encode("utf-8", "replace").lower().split() if t else [] for t in texts]
    for words in split:
        words.append(b"")
    counts = np.array([len(w) for w in split])
    digest = xxhash.xxh3_64_intdigest
    flat = np.fromiter((digest(w) for words in split for w in words), np.uint64, counts.sum())
    return flat.view(np.int64), counts


def _tally(
    docs: DataFrame, text_col: str, name: str, make: Callable[[], Callable]
) -> DataFrame:
    """Count the codes that a function finds in whole texts: ``name, n`` over all rows."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes_of, held, size = make(), [], 0

        def counted() -> pa.RecordBatch:
            codes, n = np.unique(np.concatenate(held), return_counts=True)
            return pa.RecordBatch.from_arrays([pa.array(codes), pa.array(n)], [name, "n"])

        for batch in batches:
            for a, b in steps(batch.column(0)):
                held.append(codes_of(batch.column(0).slice(a, b - a).to_pylist()))
                size += len(held[-1])
                if size >= _HELD:
                    yield counted()
                    held, size = [], 0
        if size:
            yield counted()

    ship_package(docs.sparkSession)
    found = docs.select(docs[text_col].alias("text")).mapInArrow(run, f"{name} long, n long")
    return found.groupBy(name).agg(F.sum("n").alias("n"))


class Lookup:
    """Numbers by hash, in two sorted arrays."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        order = np.argsort(keys)
        self.keys, self.values = keys[order], values[order]

    def get(self, wanted: np.ndarray, default: int) -> np.ndarray:
        if not len(self.keys):
            return np.full(len(wanted), default, np.int64)
        at = np.searchsorted(self.keys, wanted)
        at[at == len(self.keys)] = 0
        return np.where(self.keys[at] == wanted, self.values[at], default)


def contexts(classes: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The two classes before every token; before a text's start there is the end's class, 0."""
    starts = np.cumsum(counts) - counts
    before = np.zeros_like(classes)
    before[1:] = classes[:-1]
    before[starts] = 0
    earlier = np.zeros_like(classes)
    earlier[1:] = before[:-1]
    earlier[starts] = 0
    return earlier, before


@dataclass
class Params:
    """Vectors of classes as context and as target, the scales of the two positions, biases."""

    context: np.ndarray
    target: np.ndarray
    scale: np.ndarray
    bias: np.ndarray

    @staticmethod
    def initial(unigram: np.ndarray) -> Params:
        rng = np.random.default_rng(0)
        n = len(unigram)
        return Params(
            rng.normal(0, 0.1, (n, WIDTH)), rng.normal(0, 0.1, (n, WIDTH)),
            np.ones((2, WIDTH)) * [[0.5], [1.0]], np.log(unigram),
        )

    def flat(self) -> np.ndarray:
        return np.concatenate([x.ravel() for x in
                               (self.context, self.target, self.scale, self.bias)])

    def filled(self, values: np.ndarray) -> Params:
        out, at = [], 0
        for x in (self.context, self.target, self.scale, self.bias):
            out.append(values[at:at + x.size].reshape(x.shape).copy())
            at += x.size
        return Params(*out)

    def predicted(self, earlier: np.ndarray, before: np.ndarray) -> np.ndarray:
        return self.context[earlier] * self.scale[0] + self.context[before] * self.scale[1]

    def normalisers(self) -> np.ndarray:
        """The log of the summed scores of all classes, for every context."""
        n = len(self.bias)
        every = np.arange(n)
        target, bias = self.target.T.astype(np.float32), self.bias.astype(np.float32)
        out = np.empty((n, n), np.float32)
        for a in range(n):
            scores = self.predicted(np.full(n, a), every).astype(np.float32) @ target + bias
            top = scores.max(axis=1, keepdims=True)
            out[a] = top[:, 0] + np.log(np.exp(scores - top).sum(axis=1))
        return out


def _by_class(classes: np.ndarray, rows: np.ndarray, n: int) -> np.ndarray:
    """The sum of the rows of each class."""
    cells = classes[:, None] * WIDTH + np.arange(WIDTH)
    return np.bincount(cells.ravel(), rows.ravel(), n * WIDTH).reshape(n, WIDTH)


def noise_contrastive(
    params: Params, unigram: np.ndarray, trigrams: np.ndarray, counts: np.ndarray, seed: int,
    rate: float = RATE,
) -> Params:
    """One pass of gradient steps over weighted trigrams, against noise drawn from the unigrams."""
    rng = np.random.default_rng(seed)
    n = len(unigram)
    values = params.flat()
    m, v = np.zeros_like(values), np.zeros_like(values)
    log_noise = np.log(unigram * NOISE)
    # A trigram far commoner than the mean takes part several times, so no step is its alone.
    times = np.ceil(counts / (4 * counts.mean())).astype(np.int64)
    order = rng.permutation(np.repeat(np.arange(len(trigrams)), times))
    share = counts / times / counts.mean()
    for t, at in enumerate(range(0, len(order), BATCH), 1):
        part = order[at:at + BATCH]
        code = trigrams[part]
        earlier, before, word = code // (n * n), code // n % n, code % n
        weight = share[part] / len(part)
        q = params.predicted(earlier, before)
        noise = rng.choice(n, NOISE, p=unigram)
        real = (q * params.target[word]).sum(axis=1) + params.bias[word] - log_noise[word]
        fake = q @ params.target[noise].T + params.bias[noise] - log_noise[noise]
        up = weight / (1 + np.exp(np.clip(real, -30, 30)))
        down = weight[:, None] / (1 + np.exp(-np.clip(fake, -30, 30)))
        target = _by_class(word, up[:, None] * q, n) - _by_class(noise, down.T @ q, n)
        bias = np.bincount(word, up, n) - np.bincount(noise, down.sum(axis=0), n)
        back = up[:, None] * params.target[word] - down @ params.target[noise]
        context = _by_class(earlier, back * params.scale[0], n)
        context += _by_class(before, back * params.scale[1], n)
        scale = np.stack([(back * params.context[earlier]).sum(axis=0),
                          (back * params.context[before]).sum(axis=0)])
        slope = np.concatenate([x.ravel() for x in (context, target, scale, bias)])
        m = 0.9 * m + 0.1 * slope
        v = 0.99 * v + 0.01 * slope ** 2
        step = (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.99 ** t)) + 1e-8)
        values += rate * step
        params = params.filled(values)
    return params


def _train(trigrams: DataFrame, unigram: np.ndarray, rounds: int) -> Params:
    """Rounds of passes over all trigrams; Spark averages what the partitions arrive at."""
    spark = trigrams.sparkSession
    params = Params.initial(unigram)
    for r in range(rounds):
        shared = spark.sparkContext.broadcast((params, unigram))

        def run(batches: Iterable[pa.RecordBatch], shared=shared, r=r):
            start, unigram = shared.value
            total = sums = 0
            held, size = [], 0

            def passed(own: Params) -> Params:
                whole = pa.Table.from_batches(held)
                codes, n = (whole.column(i).to_numpy() for i in (0, 1))
                return noise_contrastive(
                    own, unigram, codes, n.astype(float), r + len(codes), RATE / (1 + r)
                )

            own = start
            for batch in batches:
                held.append(batch)
                size += batch.num_rows
                total += batch.num_rows
                if size >= _HELD:
                    own, held, size = passed(own), [], 0
            if size:
                own = passed(own)
            if total:
                sums = own.flat() * total
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.arange(len(sums))), pa.array(sums),
                     pa.array(np.full(len(sums), total))],
                    ["i", "x", "w"],
                )

        moved = trigrams.mapInArrow(run, "i long, x double, w long").groupBy("i").agg(
            (F.sum("x") / F.sum("w")).alias("x")
        ).toArrow()
        if not moved.num_rows:
            return params
        values = np.empty(moved.num_rows)
        values[moved.column("i").to_numpy()] = moved.column("x").to_numpy()
        params = params.filled(values)
        shared.unpersist()
    return params


@dataclass
class Model:
    """What the tasks need to score texts, and the table of all counts."""

    counts: DataFrame
    tokens: int
    distinct: int
    head: Lookup
    classes: Lookup
    rare: int
    rare_tokens: int
    rare_distinct: int
    params: Params | None
    normalisers: np.ndarray | None


def _commonest(counts: DataFrame, bound: int) -> DataFrame:
    """Words of the highest counts, as many as fit ``bound`` with all words of equal rank.

    Ranks are counts, in steps of a third of a percent from 4,096 on. There is a fixed number of
    them, so the rank to cut at is found without sorting words anywhere.
    """
    n = F.col("n")
    rank = F.when(n < 4096, n).otherwise(4096 + F.floor(F.log2(n / 4096) * 256)).cast("long")
    sizes = counts.groupBy(rank.alias("rank")).agg(F.count("*").alias("words")).collect()
    cut, held = None, 0
    for r in sorted(sizes, key=lambda r: -r["rank"]):
        held += r.words
        if held > bound:
            break
        cut = r["rank"]
    return counts.where(F.lit(False) if cut is None else rank >= cut).select("h", "n")


def fit(
    docs: DataFrame, text_col: str = "text", classes: int = CLASSES, head: int = HEAD,
    rounds: int = ROUNDS,
) -> Model:
    """Count all of ``docs`` and train the model on all of it."""
    counts = stage(
        _tally(docs, text_col, "h", lambda: lambda texts: hashes(texts)[0]), "token-counts"
    )
    tokens, distinct = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    top = _commonest(counts, head).toArrow()
    top_hash, top_n = top.column("h").to_numpy(), top.column("n").to_numpy()
    # The end has class 0 whatever its count, the commonest words follow, the rest is one class.
    words = [i for i in np.lexsort((top_hash, -top_n)) if top_hash[i] != END][:classes - 2]
    known = np.array([END, *top_hash[words]], np.int64)
    seen = np.array([top_n[top_hash == END].sum(), *top_n[words]], float)
    rare = len(known)
    model = Model(
        counts, tokens, distinct, Lookup(top_hash, top_n), Lookup(known, np.arange(rare)), rare,
        int(tokens - seen.sum()), int(distinct - (seen > 0).sum()), None, None,
    )
    if tokens:
        n = rare + 1
        unigram = np.append(seen, model.rare_tokens) + 0.5
        unigram /= unigram.sum()
        lookup = model.classes

        def make():
            def codes(texts):
                flat, sizes = hashes(texts)
                own = lookup.get(flat, rare)
                earlier, before = contexts(own, sizes)
                return (earlier * n + before) * n + own

            return codes

        with scratch(docs.sparkSession):
            trigrams = stage(_tally(docs, text_col, "code", make), "trigrams")
            model.params = _train(trigrams, unigram, rounds)
        model.normalisers = model.params.normalisers()
    return model


def score(
    docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """The id column with ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score``, ``score``.

    One row per row of ``docs``; both scores are log10 probabilities of the whole text.
    """
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(
        (model.head, model.classes, model.rare, model.params, model.normalisers)
    )

    def make():
        head, classes, rare, params, normalisers = shared.value

        def step(texts):
            flat, sizes = hashes(texts)
            n = len(sizes)
            owner = np.repeat(np.arange(n), sizes)
            kinds, of = np.unique(flat, return_inverse=True)
            found = head.get(kinds, 0)
            own = classes.get(kinds, rare)
            c, cls = found[of], own[of]
            near, is_rare = c > 0, cls == rare
            logs = np.log10(c + 0.5)
            chance = np.zeros(len(flat))
            if params is not None:
                earlier, before = contexts(cls, sizes)
                q = params.predicted(earlier, before)
                chance = (q * params.target[cls]).sum(axis=1) + params.bias[cls]
                chance = (chance - normalisers[earlier, before]) / np.log(10)
            # Rare words that no task knows the count of: each once per text, to be joined.
            far = np.flatnonzero(~near)
            pair, times = np.unique(owner[far] * len(kinds) + of[far], return_counts=True)
            owners = pair // max(1, len(kinds))
            ends = np.searchsorted(owners, np.arange(n + 1))
            unknown, times = kinds[pair % max(1, len(kinds))], times.astype(np.int32)
            total = lambda w: np.bincount(owner, w, n).tolist()
            return {
                "n_tokens": sizes.tolist(),
                "known": np.bincount(owner, near, n).astype(np.int64).tolist(),
                "rare": np.bincount(owner, is_rare, n).astype(np.int64).tolist(),
                "logs": total(np.where(near, logs, 0.0)),
                "rare_logs": total(np.where(near & is_rare, logs, 0.0)),
                "chance": total(chance),
                "far": [unknown[a:b] for a, b in zip(ends, ends[1:], strict=False)],
                "times": [times[a:b] for a, b in zip(ends, ends[1:], strict=False)],
            }

        return step

    keyed = docs.select(*document_key(docs, id_col, text_col), docs[id_col].alias("id"),
                        docs[text_col].alias("text"))
    near = stage(
        map_texts(
            keyed, [*DOC_KEY, "id"], "text",
            "n_tokens long, known long, rare long, logs double, rare_logs double, chance double, "
            "far array<bigint>, times array<int>", make,
        ),
        "lm-near",
    )
    far = near.where(F.size("far") > 0).select(
        *DOC_KEY, F.size("far").alias("entries"),
        F.inline(F.arrays_zip(F.col("far").alias("h"), F.col("times").alias("times"))),
    )
    joined = far.join(model.counts, "h", "left").withColumn("c", F.coalesce("n", F.lit(0)))
    # A document that several rows repeat has its entries as often; they are counted once.
    once = F.first("entries") / F.count("*")
    late = joined.groupBy(*DOC_KEY).agg(
        (F.sum(F.col("times") * F.log10(F.col("c") + 0.5)) * once).alias("late_logs"),
        F.round(F.sum(F.when(F.col("c") > 0, F.col("times")).otherwise(0)) * once)
        .cast("long").alias("late_known"),
    )
    n, v = model.tokens, model.distinct
    total = float(np.log10(n + 0.5 * (v + 1)))
    rare_total = float(np.log10(model.rare_tokens + 0.5 * (model.rare_distinct + 1)))
    late_logs = F.coalesce("late_logs", F.lit(0.0))
    base = F.col("logs") + late_logs - F.col("n_tokens") * F.lit(total)
    own = F.col("chance") + F.col("rare_logs") + late_logs - F.col("rare") * F.lit(rare_total)
    return near.join(late, DOC_KEY, "left").select(
        F.col("id").alias(id_col), "n_tokens",
        (F.col("known") + F.coalesce("late_known", F.lit(0))).alias("n_known"),
        F.lit(n).cast("long").alias("train_tokens"), base.alias("base_score"),
        (own if model.params is not None else base).alias("score"),
    )


def held_out(docs: DataFrame, id_col: str = "doc_id"):
    """Rows that are never learned from: crc32 of the id's text leaves 1 by 5."""
    return remainder(docs[id_col], 5) == 1
