import random
from collections import Counter

import corpus_pipeline
from tidelog.llm import bpe, queries
from tidelog.session import stage
from tests.llm.conftest import EDGES, SMALL
from tests.llm.test_decontamination import brute as contaminated
from tests.llm.test_line_dedup import brute as without_lines
from tests.llm.test_minhash import brute as components


def test_stages_equal_brute_force(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    columns = docs.columns
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "language_id", "line_dedup", "near_dedup", "decontamination", "bpe"]
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    got = stage(corpus_pipeline.keep_known_languages(spark, docs, SMALL), "t")
    assert got.columns == columns
    assert got.count() == len(rows)  # every given text is in a known language
    lined = stage(corpus_pipeline.drop_shared_lines(spark, got, SMALL), "t")
    want = [(i, text) for i, _, _, text in without_lines(rows, 10)]
    assert lined.columns == columns
    assert sorted((r.doc_id, r.text) for r in lined.collect()) == sorted(want)
    assert all(r.n_chars == len(r.text) for r in lined.collect())
    single = stage(corpus_pipeline.keep_one_of_each_group(spark, lined, SMALL), "t")
    kept = {i for i, _, c in components(want, 5) if i == c}
    want = [(i, t) for i, t in want if i in kept]
    assert sorted((r.doc_id, r.text) for r in single.collect()) == sorted(want)
    items = [tuple(r) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    clean = stage(corpus_pipeline.drop_contaminated(spark, single, SMALL), "t")
    dirty = {i for i, _, hit, _ in contaminated(want, items) if hit}
    want = [(i, t) for i, t in want if i not in dirty]
    assert sorted((r.doc_id, r.text) for r in clean.collect()) == sorted(want)
    path = queries.vocabulary_path()
    tokens = corpus_pipeline.run(spark, SMALL).collect()
    assert sorted((r.doc_id, bpe.decode(r.ids, path).decode()) for r in tokens) == sorted(want)


def test_edges(spark, edges, nothing):
    """Each stage on nulls, repeats and clashing columns keeps the columns and the clean rows."""
    for frame in (edges, nothing):
        docs = frame.withColumn("lang", frame.lang)
        for _, function in corpus_pipeline.STAGES[:-1]:
            docs = stage(function(spark, docs, SMALL), "t")
            assert docs.columns == frame.columns
        left = Counter(r.doc_id for r in docs.select("doc_id").collect())
        assert corpus_pipeline.tokenise(spark, docs, SMALL).count() == sum(left.values())
        if frame is edges:
            assert set(left) == {i for i, _ in EDGES} - {13}  # 13 is a copy of 12
            assert left[6] == 1 and left[None] == 2
        else:
            assert not left


def test_unknown_languages_go(spark):
    rows = [(i, f"the {w} of and with", "en") for i, w in enumerate("abcdefgh")]
    rows += [(20, "1 2 3 !!", "en"), (21, None, "en"), (22, "the one", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    left = corpus_pipeline.keep_known_languages(spark, docs, SMALL)
    assert sorted(r.doc_id for r in left.collect()) == [*range(8), 22]


def test_gibberish_and_unlearned_languages_go(spark):
    rnd = random.Random(0)
    mash = " ".join("".join(rnd.choices("asdfghjklqwertyuiopzxcvbnm", k=rnd.randint(2, 9)))
                    for _ in range(60))
    hexes = " ".join(f"{rnd.getrandbits(64):016x}" for _ in range(60))
    polish = ("Wszyscy ludzie rodzą się wolni i równi pod względem swej godności i swych praw. Są oni "
              "obdarzeni rozumem i sumieniem i powinni postępować wobec innych w duchu braterstwa.")
    russian = ("Все люди рождаются свободными и равными в своем достоинстве и правах. Они наделены "
               "разумом и совестью и должны поступать в отношении друг друга в духе братства.")
    given = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text", "lang")
    new = [(-1, mash, None), (-2, hexes, None), (-3, polish, None), (-4, russian, None),
           (-5, "asdkjh qwoeiu zxmcnb qpwoei", None)]
    docs = given.unionByName(spark.createDataFrame(new, given.schema))
    left = corpus_pipeline.keep_known_languages(spark, docs, SMALL)
    # Of the given texts all stay, and of the new ones none.
    assert sorted(r.doc_id for r in left.collect()) == sorted(r.doc_id for r in given.collect())


def test_texts_that_share_an_id_are_documents_of_their_own(spark):
    """Only copies go: neither other texts of a copy's id, nor all but one text of an id."""
    prose = "nobody knew where the river went and the old men said nothing of it that {} day"
    rows = [(1, prose.format("first"), "a"), (2, prose.format("first"), "b"),
            (2, "quite another text that shares its id with a copy of the first one", "c"),
            (3, "one text of three words", "d"), (3, "and one with other words in it", "e"),
            (3, "and one with other words in it", "f"), (None, prose.format("first"), "g"),
            (0, "and one with other words in it", "h"), (5, "", "i"), (5, None, "j")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, key string")
    left = corpus_pipeline.keep_one_of_each_group(spark, docs, SMALL)
    assert left.columns == docs.columns
    got = sorted(((r.doc_id, r.text) for r in left.collect()), key=repr)
    assert got == sorted(((i, t) for i, t, k in rows if k in "acdghij"), key=repr)
