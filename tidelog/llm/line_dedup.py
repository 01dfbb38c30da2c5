"""Line dedup: lines that many documents share are dropped; the answer is a bitmap per document.

Every line becomes a 128-bit hash. The hashes are range-partitioned together with their document, so
one very common line spreads over as many partitions as its documents need, and each partition is
sorted by hash, document and position: occurrences stream past in order and only the first one in a
document counts. Texts never move while lines are counted. All of it is DataFrame operations.

Defined results: a null or empty text is one empty line; lines whose key is empty are never
dropped; rows that repeat a document's id and text are one document; an empty table gives an
empty table; only the named id and text columns are read.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelog.llm.batches import DOC_KEY, document_key
from tidelog.operators.lookup import lookup_join
from tidelog.session import scratch, stage

# Fixed value: the white space that a line's key is stripped of, \x20 and \x09 to \x0D.
STRIPPED = " \t\n\x0b\x0c\r"
_HASH = ["h1", "h2"]


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def _key_parts(line: Column) -> list[Column]:
    """Two texts that are equal for two lines exactly if their keys are.

    A key is the line without outer white space and with A to Z in lower case. Spark's ``lower``
    is fast but lowers every script, so a line with other letters adds its shape: those letters as
    they are, with a mark for each run of ASCII. Only the dotted capital I and the Kelvin sign
    turn into ASCII when lowered; lines that hold one are translated letter by letter.
    """
    bare = F.trim(line, F.lit(STRIPPED))
    ascii_only = F.octet_length(bare) == F.char_length(bare)
    to_ascii = F.contains(bare, F.lit("\u0130")) | F.contains(bare, F.lit("\u212a"))
    translated = F.translate(bare, string.ascii_uppercase, string.ascii_lowercase)
    return [
        F.when(ascii_only | ~to_ascii, F.lower(bare)).otherwise(translated),
        F.when(ascii_only, F.lit("")).otherwise(
            F.regexp_replace(bare, r"[\x00-\x7F]+", "a")
        ),
    ]


def line_masks(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_docs: int = 10,
    min_chars: int = 1,
) -> DataFrame:
    """Which lines every document keeps: ``k1, k2, id, n_lines, n_dropped, keep_runs``.

    Keys of at least ``min_chars`` code points found in at least ``min_docs`` documents lose all
    their lines. ``keep_runs`` is the bitmap of kept lines as lengths of runs, the first one kept
    (it may be 0), then dropped, kept, and so on. One row per different (id, text).
    """
    line = F.col("line")
    parts = _key_parts(line)
    with scratch(docs.sparkSession) as kept:
        # Stored, so that sampling the range bounds does not split the texts a second time.
        lines = stage(
            docs.select(*document_key(docs, id_col, text_col),
                        F.posexplode(_lines(docs[text_col])).alias("pos", "line"))
            .where(F.char_length(F.trim(line, F.lit(STRIPPED))) >= max(1, min_chars))
            .select(F.xxhash64(F.lit(1), *parts).alias("h1"), F.xxhash64(*parts, F.lit(2)).alias("h2"),
                    *DOC_KEY, "pos"),
            "lines",
        )
        ranged = (
            lines.repartitionByRange(*_HASH, *DOC_KEY)
            .sortWithinPartitions(*_HASH, *DOC_KEY, "pos")
        )
        firsts = ranged.groupBy(*_HASH, *DOC_KEY).agg(F.collect_set("pos").alias("positions"))
        firsts = kept.keep(stage(firsts, "line-keys"))
    common = stage(
        firsts.groupBy(*_HASH).agg(F.count("*").alias("n")).where(F.col("n") >= min_docs)
        .select(*_HASH),
        "common-lines",
    )
    hit = lookup_join(firsts, common, _HASH, "left_semi")
    dropped = hit.groupBy(*DOC_KEY).agg(
        F.sort_array(F.flatten(F.collect_list("positions"))).alias("dropped")
    )
    whole = docs.select(
        *document_key(docs, id_col, text_col),
        docs[id_col].alias("id"),
        F.size(_lines(docs[text_col])).alias("n_lines"),
    ).dropDuplicates(DOC_KEY)
    # Arrays that a lambda looks into are columns of their own, so each is computed once.
    x = F.col("dropped")
    return (
        whole.join(dropped, DOC_KEY, "left")
        .withColumn("dropped", F.coalesce("dropped", F.array().cast("array<int>")))
        .withColumns({
            "starts": F.filter(x, lambda p, i: (i == 0) | (F.get(x, F.greatest(i - 1, F.lit(0)))
                                                           != p - 1)),
            "ends": F.filter(x, lambda p, i: (i == F.size(x) - 1) | (F.get(x, i + 1) != p + 1)),
        })
        .withColumn("edges", F.concat(
            F.array(F.lit(0)),
            F.flatten(F.transform(F.arrays_zip("starts", "ends"),
                                  lambda r: F.array(r["starts"], r["ends"] + 1))),
            F.array("n_lines"),
        ).cast("array<int>"))
        .select(
            *DOC_KEY, "id", F.col("n_lines").cast("long").alias("n_lines"),
            F.size("dropped").cast("long").alias("n_dropped"),
            F.transform(F.slice("edges", 2, F.size("edges") - 1),
                        lambda edge, i: edge - F.get(F.col("edges"), i)).alias("keep_runs"),
        )
    )


def apply_masks(
    docs: DataFrame, masks: DataFrame, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Every row of ``docs`` with the text that its bitmap keeps, and the two counts.

    Returns the id, ``n_lines``, ``n_dropped``, ``kept`` and the other columns of ``docs``.
    """
    keyed = docs.select(
        *document_key(docs, id_col, text_col), F.struct(*[docs[c] for c in docs.columns])
        .alias("row")
    )
    joined = keyed.join(masks.drop("id"), DOC_KEY, "left")
    text = F.coalesce(F.col("row").getField(text_col), F.lit(""))
    flags = F.flatten(F.transform("keep_runs", lambda n, i: F.array_repeat(i % 2 == 0, n)))
    kept = F.array_join(
        F.transform(
            F.filter(F.arrays_zip(_lines(text).alias("line"), flags.alias("keep")),
                     lambda x: x["keep"]),
            lambda x: x["line"],
        ),
        "\n",
    )
    return joined.select(
        "row", "n_lines", "n_dropped",
        F.when(F.col("n_dropped") == 0, text).otherwise(kept).alias("kept"),
    )
