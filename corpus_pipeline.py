"""The corpus pipeline: language ID, line dedup, near-dedup, decontamination, tokens.

Each stage takes what its predecessor kept and returns the columns of ``documents``; the last returns
token ids. Rows with clean texts stay, whatever their columns hold: rejected are only documents without
a recognisable language, copies of a document that stays, and documents with benchmark windows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.llm import bpe, decontamination, language_id, line_dedup, minhash
from tidelog.llm.batches import document_key
from tidelog.llm.queries import table, vocabulary_path
from tidelog.operators.lookup import lookup_join
from tidelog.operators.numbering import number_in_order
from tidelog.session import stage

# A text that fits every learned language worse than chance is rejected, as is ``und``.
MIN_FIT = 0.0


def keep_known_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose text is in one of the languages learned from them (all, if none is)."""
    model = language_id.fit(docs.where(~language_id.held_out(docs)))
    if model is None:
        return docs
    rows = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"),
                       docs["text"].alias("text"))
    found = language_id.predict_keeping(rows, model, ["row"])
    known = found.where((F.col("lang_pred") != language_id.UNKNOWN) & (F.col("fit") >= MIN_FIT))
    return known.select(*[F.col("row").getField(c).alias(c) for c in docs.columns])


def drop_shared_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that ten or more of them share; ``n_chars`` follows the text."""
    kept = line_dedup.apply_masks(docs, line_dedup.line_masks(docs))
    new = {"text": F.col("kept"), "n_chars": F.char_length("kept").cast("long")}
    return kept.select(
        *[new.get(c, F.col("row").getField(c)).alias(c) for c in docs.columns]
    )


def keep_one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: five-word shingles, similarity 0.8 or more.

    A document is an id with its text. Where ids stand for several texts, numbers of documents, told
    apart by 128 bits of both, take the ids' place, and each group keeps its smallest id. Rows without an
    id all stay.
    """
    k1, k2 = document_key(docs, "doc_id", "text")
    named = docs["doc_id"].isNotNull()
    texts = docs.select(docs["doc_id"].alias("id"), k1.alias("k")).where("id IS NOT NULL")
    clashes = texts.groupBy("id").agg(F.min("k").alias("a"), F.max("k").alias("b")).where("a <> b")
    clash = not clashes.isEmpty()
    keyed = docs.select(
        F.struct(*[docs[c] for c in docs.columns]).alias("row"), docs["doc_id"].alias("id"),
        docs["text"].alias("text"), docs["doc_id"].alias("key"), k1, k2,
    )
    if clash:
        names = docs.where(named).select(k1, k2).distinct()
        names = stage(number_in_order(names, [], ["k1", "k2"], "key"), "documents")
        keyed = lookup_join(keyed.drop("key").where("id IS NOT NULL"), names, ["k1", "k2"]).unionByName(
            keyed.where("id IS NULL").withColumn("key", F.lit(None).cast("long"))
        )
    found = minhash.near_duplicates(keyed, "key", shingle_words=5, percent=80)
    if clash:
        members = found.where("key IS NOT NULL").select("key", "component_id").distinct().join(
            keyed.select("key", "id").distinct(), "key"
        )
        members = stage(members, "members")
        least = stage(
            members.groupBy("component_id").agg(F.min(F.struct("id", "key")).alias("least")), "least"
        )
        found = lookup_join(members, least, "component_id").select(
            "key", (F.col("key") == F.col("least.key")).alias("kept")
        )
    gone = stage(found.where(~F.col("kept")).select("key").distinct(), "copies")
    left = lookup_join(keyed, gone, "key", "left_anti")
    repeated = left.groupBy("key").count().where("count > 1 AND key IS NOT NULL")
    if not repeated.isEmpty():
        once = left.where("key IS NOT NULL").dropDuplicates(["key"])
        left = once.unionByName(left.where("key IS NULL"))
    return left.select(*[F.col("row").getField(c).alias(c) for c in docs.columns])


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any ten-word window of a benchmark item."""
    return decontamination.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def tokenise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id``, ``n_tokens`` and ``ids`` (packed 32-bit integers) of every document left."""
    return bpe.encode_texts(docs, vocabulary_path())


STAGES = [
    ("language_id", keep_known_languages),
    ("line_dedup", drop_shared_lines),
    ("near_dedup", keep_one_of_each_group),
    ("decontamination", drop_contaminated),
    ("bpe", tokenise),
]
# Line dedup alone could be written in SQL; the others cannot, so tests use brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every stage in turn over ``documents``; each one's rows are stored before the next."""
    docs = table(spark, sf_dir, "documents")
    for name, function in STAGES[:-1]:
        docs = stage(function(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
