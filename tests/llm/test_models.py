"""Learned operators: held-out accuracy on the given tables, edges, and what they must not use."""

import zlib

import numpy as np
import pytest

from tidelog.llm import language_id, lm_scoring, quality, queries, toxicity
from tests.llm.conftest import EDGES

DATA = "/root/testdata/sf0.01"


def crc(i):
    return zlib.crc32(("" if i is None else str(i)).encode())


@pytest.fixture(scope="module")
def languages(spark):
    return queries.QUERIES["op5_language_id"](spark, DATA).collect()


def test_language_accuracy(spark, languages):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    lang = {r.doc_id: r.lang for r in docs.select("doc_id", "lang").collect()}
    held = [r for r in languages if r.held_out]
    assert {r.doc_id for r in held} == {i for i in lang if crc(i) % 4 == 2}
    assert sum(lang[r.doc_id] == r.lang_pred for r in held) >= 0.98 * len(held)
    assert all(0 <= r.score <= 1 for r in languages) and len(languages) == len(lang)


def test_language_edges(spark, edges, nothing):
    rows = [(i, f"the {w} of and with", "en") for i, w in enumerate("abcdefgh")]
    rows += [(20 + i, f"der {w} und mit von", "de") for i, w in enumerate("abcdefgh")]
    rows += [(40, "слово и дело", "ru"), (41, None, "fr"), (42, "ohne", None)]
    model = language_id.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    found = language_id.predict(edges, model).collect()
    assert len(found) == len(EDGES)
    texts = dict(EDGES)
    for r in found:
        if r.doc_id in (1, 2, 3, 9, 11):
            assert (r.lang_pred, r.score) == ("und", 0.0)
        elif r.doc_id is not None:
            assert r.lang_pred in ("en", "de", "ru"), texts[r.doc_id]
    assert {r.lang_pred for r in found if r.doc_id == 12} == {"en"}
    assert language_id.predict(nothing, model).collect() == []
    assert language_id.fit(nothing) is None
    assert {r.lang_pred for r in language_id.predict(edges, None).collect()} == {"und"}


@pytest.mark.parametrize(
    ("name", "label", "held", "recall"),
    [("op4_quality", "quality", lambda i: crc(i) % 5 == 0, 0.98),
     ("op6_toxicity", "toxic", lambda i: crc(i) % 3 == 1, 0.75)],
)
def test_label_accuracy(spark, name, label, held, recall):
    rows = queries.QUERIES[name](spark, DATA).collect()
    labels = spark.read.parquet(f"{DATA}/labels.parquet").collect()
    known = {r.doc_id: r[label] for r in labels}
    assert all(r.held_out == held(r.doc_id) and 0 <= r.score <= 1 for r in rows)
    test = [r for r in rows if r.held_out and r.doc_id in known]
    right = sum(r.predicted == known[r.doc_id] for r in test)
    found = [r.predicted for r in test if known[r.doc_id] == 1]
    clean = [r.predicted for r in test if known[r.doc_id] == 0]
    assert right >= 0.96 * len(test) and np.mean(found) >= recall
    assert name != "op6_toxicity" or not any(clean)


@pytest.mark.parametrize("module", [quality, toxicity])
def test_scores_at_the_edges(spark, edges, nothing, module):
    column = "quality" if module is quality else "toxic"
    texts = [f"calm words {i} here\nand there" for i in range(30)]
    texts += [f"BAD!! idiot {i} ###\nBAD!! idiot" for i in range(30)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = [(i, int((i < 30) == (module is quality))) for i in range(60)] + [(None, 1), (5, None)]
    labels = spark.createDataFrame(rows, f"doc_id long, {column} int")
    model = module.fit(docs, labels)
    scored = {r.doc_id: r.score for r in module.score(docs, model).collect()}
    high = scored.values() if module is quality else [scored[i] for i in range(30, 60)]
    assert np.mean([s for i, s in scored.items() if (i < 30) == (module is quality)]) > 0.8
    assert len(list(high))
    for made in (model, module.fit(docs, labels.limit(0))):
        found = module.score(edges, made).collect()
        assert len(found) == len(EDGES) and all(0 <= r.score <= 1 for r in found)
        assert module.score(nothing, made).collect() == []
        same = {r.score for r in found if r.doc_id in (12, 13)}
        assert len(same) == 1


def test_channel_restores():
    words = ["the pathetic idiot", "a worthless moron", "stupid disgusting loser", "stop this class"]
    channel = toxicity.Channel(toxicity.trigram_counts(words * 200))
    for shown, meant in [("1d10t", "idiot"), ("w0rthle55", "worthless"), ("l.o.s.e.r", "loser"),
                         ("stuuupid", "stupid"), ("d1sgust1ng,", "disgusting"), ("m0r0n!", "moron"),
                         ("p@thet1c", "pathetic"), ("class", "class")]:
        assert meant in channel.readings(shown), shown
    assert toxicity.tokens("an i d i o t ok")[1] == ["idiot"]
    assert toxicity.tokens("a  b c d  e f g h  x y")[1] == ["bcd", "efgh"]
    assert toxicity.tokens("l   o\to  s")[1] == [] and toxicity.tokens("o d d")[1] == ["odd"]
    assert channel.restore("i d i o t") == "idiot"
    assert channel.readings("###") == set()
    for shown, meant in [("idiot", {"idiot"}), ("astupid", {"stupid"}),
                         ("1d10tmor0n", {"idiot", "moron"})]:
        assert meant <= channel.words(shown), shown


def test_words_of_a_run_are_the_likeliest_split():
    """The lattice with word edges against every split of the letters, by plain sums."""
    channel = toxicity.Channel(toxicity.trigram_counts(["the cat sat on a mat", "a dog ran to the hat"] * 50))

    def cost(words):
        total, a, b = 0.0, toxicity._EDGE, toxicity._EDGE
        for word in words:
            for letter in word:
                c = toxicity._symbol(letter)
                total, a, b = total + channel.cost[a][b][c], b, c
            total, a, b = total + channel.cost[a][b][toxicity._EDGE], b, toxicity._EDGE
        return total

    for letters in ("thecat", "adogran", "onamat", "zzz", "tothehat"):
        cuts = range(2 ** (len(letters) - 1))
        splits = ["".join(x + (" " if cut >> i & 1 else "") for i, x in enumerate(letters)).split() for cut in cuts]
        best = min(splits, key=cost)
        assert {w for w in best if len(w) > 2} <= channel.words(letters)


@pytest.fixture(scope="module")
def toxic_model(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "text")
    return toxicity.fit(docs, spark.read.parquet(f"{DATA}/labels.parquet").select("doc_id", "toxic"))


def test_disguises_score_as_the_plain_word(toxic_model):
    hits = toxic_model.scorer()

    def score(text):
        return toxic_model.score(*hits(text))

    plain, clean = score("you are a loser"), score("you are a farmer")
    assert plain > 0.6 > 0.2 > clean
    for text in ["losser", "l0ser", "looser!!", "l.o.s.e.r", "l o s e r", "l  o  s  e  r", "a l o s e r",
                 "you are a l o s e r now", "lllooossseeerrr"]:
        assert score(text) == pytest.approx(plain), text
    for text in ["l o s e r i d i o t", "l o s e r  i d i o t", "iddiot loserr"]:
        assert score(text) >= plain - 0.02, text
    for text in ["a b c", "i a m", "plan b c d e", "a loose letter rolls off the hill", "", None]:
        assert score(text) == pytest.approx(clean), text


def test_marginals_equal_enumeration():
    rng = np.random.default_rng(0)
    counts = np.array([1, 3, 4])
    first = quality.firsts(counts)
    score, moves, begin = rng.normal(size=8), rng.normal(size=(2, 2)), rng.normal(size=2)
    got = quality.marginals(score, first, moves, begin)[0][:, 1]
    at = 0
    for c in counts:
        weights = np.zeros(c)
        total = 0.0
        for labels in np.ndindex(*[2] * c):
            logs = begin[labels[0]] + sum(moves[a, b] for a, b in zip(labels, labels[1:], strict=False))
            w = np.exp(logs + sum(score[at + i] for i in range(c) if labels[i]))
            total += w
            weights += w * np.array(labels)
        assert np.allclose(got[at:at + c], weights / total)
        at += c


def test_long_chains_do_not_overflow():
    n = 20_000
    first = np.zeros(n, bool)
    first[0] = True
    got = quality.marginals(np.full(n, 30.0), first, np.array([[9.0, -9.0], [-9.0, 9.0]]), np.zeros(2))
    assert np.isfinite(got[0]).all() and np.isfinite(got[1]).all()


def lm_brute(rows):
    texts = [(i, (t or "").encode().lower().split() + [b""]) for i, t in rows]
    counts = {}
    for i, words in texts:
        if crc(i) % 5 != 1:
            for w in words:
                counts[w] = counts.get(w, 0) + 1
    n, v = sum(counts.values()), len(counts)
    return sorted(((
        i, len(words), sum(w in counts for w in words), n,
        round(sum(np.log10((counts.get(w, 0) + 0.5) / (n + 0.5 * (v + 1))) for w in words), 6),
    ) for i, words in texts), key=repr)


@pytest.mark.parametrize("head", [4, 1 << 18])
def test_lm_counts(edges, head):
    model = lm_scoring.fit(edges.where(~lm_scoring.held_out(edges)), classes=5, head=head, rounds=1)
    got = lm_scoring.score(edges, model).collect()
    assert sorted(((r.doc_id, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6))
                   for r in got), key=repr) == lm_brute(EDGES)
    assert all(np.isfinite(r.score) and r.score <= 0 for r in got)


def test_lm_is_normalised_and_better_than_the_base(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    model = lm_scoring.fit(docs.where(~lm_scoring.held_out(docs)), classes=64)
    p = model.params
    every = np.arange(len(p.bias))
    for a, b in [(0, 0), (3, 5), (63, 63)]:
        q = p.predicted(np.array([a]), np.array([b]))
        chance = np.exp((q @ p.target.T + p.bias)[0] - model.normalisers[a, b])
        assert len(every) == 64 and abs(chance.sum() - 1) < 1e-4
    rows = lm_scoring.score(docs, model).collect()
    assert sum(r.score for r in rows) > sum(r.base_score for r in rows)


def test_lm_empty(edges, nothing):
    model = lm_scoring.fit(nothing)
    assert lm_scoring.score(nothing, model).collect() == []
    rows = lm_scoring.score(edges, model).collect()
    assert len(rows) == len(EDGES)
    assert all((r.n_known, r.train_tokens) == (0, 0) and abs(r.base_score) < 1e-6 for r in rows)


def test_folds_are_by_id_text(spark):
    ids = spark.createDataFrame([(i,) for i in [None, *range(50)]], "doc_id long")
    got = {r.doc_id: r.x for r in ids.select("doc_id", lm_scoring.held_out(ids).alias("x")).collect()}
    assert got == {i: crc(i) % 5 == 1 for i in got}


def made_up(rng, lang, words):
    """Prose of a made-up language: syllables of its own."""
    own = np.random.default_rng(lang)
    syllables = ["".join(own.choice(list("abcdefghijklmnopqrstuvwxyz"), 3)) for _ in range(30)]
    return " ".join("".join(rng.choice(syllables, rng.integers(1, 4))) for _ in range(words))


def test_hundreds_of_languages_all_can_be_predicted(spark):
    """450 languages that no list of families names, one of them with a thousandth of the rows."""
    rng = np.random.default_rng(0)
    rows = [(1000 * k + i, made_up(rng, k, 80), f"x{k:03d}") for k in range(450) for i in range(3 if k else 40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language_id.fit(docs)
    tests = [(k, made_up(rng, k, 60)) for k in range(450)]
    found = model.predict([t for _, t in tests])[0]
    assert sum(f"x{k:03d}" == f for (k, _), f in zip(tests, found, strict=True)) >= 0.95 * 450
    machines, trees = 0, [model.tree]
    while trees:
        tree = trees.pop()
        machines += len(tree.votes.weights)
        assert len(tree.below) <= language_id.BRANCH
        trees += [b for b in tree.below if not isinstance(b, str)]
    assert machines < 450 * language_id.BRANCH


def test_two_steps_equal_votes_counted_by_hand():
    """Families first, then the languages of the winner; all pairs' votes by plain loops."""
    rng = np.random.default_rng(1)
    langs = ["de", "en", "fr", "es", "xx"]
    texts = [(lang, made_up(rng, k, 40)) for k, lang in enumerate(langs) for _ in range(6)]
    x = np.stack([language_id.features(language_id.trigrams(t)) for _, t in texts])
    model = language_id.Model.train(x, [lang for lang, _ in texts], [1] * len(texts))

    def best(votes, row):
        n = len(votes.names)
        total = [0.0] * n
        for k, (a, b) in enumerate(votes.pairs):
            margin = float(np.dot(votes.weights[k, :-1], row) + votes.weights[k, -1])
            p = 1 / (1 + np.exp(-language_id.SLOPE * margin))
            total[a] += p / (n - 1)
            total[b] += (1 - p) / (n - 1)
        return max(range(n), key=lambda i: total[i]), max(total)

    for k, lang in enumerate(langs):
        text = made_up(rng, k, 30)
        row = language_id.features(language_id.trigrams(text))
        node, score = model.tree, 1.0
        while not isinstance(node, str):
            i, share = best(node.votes, row)
            node, score = node.below[i], score * share
        got = model.predict([text])
        assert (got[0][0], got[1][0]) == (node, pytest.approx(score, rel=1e-4)) and node == lang


def test_long_labelled_documents_are_learned_from(spark):
    """Only documents of thousands of lines carry a label; one id is on many rows."""
    rows = [(i, "\n".join(["good words in a calm line"] * 3000), 1) for i in range(4)]
    rows += [(10 + i, "\n".join(["BUY!!! $$$ NOW 999"] * 3000), 0) for i in range(4)]
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows + rows[:1] * 50], "doc_id long, text string")
    labels = spark.createDataFrame([(i, q) for i, _, q in rows], "doc_id long, quality int")
    model = quality.fit(docs, labels, train_lines=2000)
    good, bad = model.scores([rows[0][1], rows[-1][1]])
    assert good > 0.8 > 0.2 > bad


def test_lines_are_shared_out_and_spread():
    assert quality.longest_part([(3, 10), (5, 2)], 1000) == 5
    assert quality.longest_part([(3, 10), (1000, 2)], 130) == 50
    assert quality.longest_part([(9, 10)], 5) == 1 and quality.longest_part([], 5) == 1
    for lines, most in ((10, 10), (1000, 100), (1000, 7), (26, 25), (3000, 2000)):
        at = quality.spread_lines(lines, most)
        assert len(at) <= most and at.max() < lines and (len(at) > 0.5 * most)
        assert most < 50 or lines <= most or (at[0] == 0 and at[-1] == lines - 1)


def test_quality_is_the_length_weighted_mean_over_all_labelings():
    """The score of small documents, from the sum over every labelling of their lines."""
    from itertools import product
    texts = ["a plain line\nshort", "BUY NOW!!!\n$$$ 999\nmore words here", ""]
    rng = np.random.default_rng(4)
    x, size, counts = quality.line_features(texts)
    full = quality.with_neighbours(x, quality.firsts(counts))
    model = quality.Model(full.mean(axis=0), full.std(axis=0) + 1, rng.normal(size=full.shape[1]),
                          rng.normal(size=(2, 2)), rng.normal(size=2), (0.3, 1.2))
    emit = ((full - model.mean) / model.scale) @ model.weights
    start = 0
    for text, n, got in zip(texts, counts, model.scores(texts), strict=True):
        own, weight = emit[start:start + n], size[start:start + n] + 1
        total = good = 0.0
        for labels in product((0, 1), repeat=int(n)):
            energy = model.begin[labels[0]] + sum(e for e, y in zip(own, labels, strict=True) if y)
            energy += sum(model.moves[a, b] for a, b in zip(labels, labels[1:], strict=False))
            p = np.exp(energy)
            total += p
            good += p * (np.array(labels) @ weight) / weight.sum()
        q = good / total
        assert got == pytest.approx(1 / (1 + np.exp(-(0.3 + 1.2 * np.log(q / (1 - q))))), rel=1e-6), text
        start += n
