"""The registered queries of the operators, and the SQL of those that SQL can express."""

from __future__ import annotations

import hashlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.llm import (
    ann,
    bpe,
    decontamination,
    language_id,
    licenses,
    line_dedup,
    lm_scoring,
    merkle,
    minhash,
    quality,
    top_products,
    toxicity,
    vector_codes,
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def _query(name: str, sql: str | None = None):
    def register(function):
        QUERIES[name] = function
        if sql is not None:
            ORACLES[name] = sql
        return function

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@_query("op1_minhash")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return minhash.near_duplicates(docs, shingle_words=2, percent=80)


def vocabulary_path() -> str:
    """The rank file of the installed public tokenizers; the same path on every machine."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


@_query("op2_bpe")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(table(spark, sf_dir, "documents"), vocabulary_path())


@_query("op3_nearest_neighbours")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest(table(spark, sf_dir, "embeddings"), lambda i: i % 100 == 0, k=10)


@_query("op4_quality")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality")
    model = quality.fit(
        docs.where(~quality.held_out(docs)), labels.where(~quality.held_out(labels))
    )
    found = quality.score(docs, model)
    return found.select(
        "doc_id", quality.held_out(found).alias("held_out"), "score",
        (F.col("score") >= 0.3).cast("int").alias("predicted"),
    )


@_query("op5_language_id")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = language_id.held_out(docs)
    model = language_id.fit(docs.where(~held_out))
    found = language_id.predict(docs, model)
    return found.select(
        "doc_id", language_id.held_out(found).alias("held_out"), "lang_pred", "score"
    )


@_query("op6_toxicity")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").select("doc_id", "toxic")
    model = toxicity.fit(
        docs.where(~toxicity.held_out(docs)), labels.where(~toxicity.held_out(labels))
    )
    found = toxicity.score(docs, model)
    return found.select(
        "doc_id", toxicity.held_out(found).alias("held_out"), "score",
        (F.col("score") >= 0.7).cast("int").alias("predicted"),
    )


LOWER = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"


@_query("op7_license_scan")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: its notices, the licenses they name, and how close the farthest match is."""
    found = licenses.scan_licenses(table(spark, sf_dir, "documents"))
    names = F.array_sort(F.array_distinct(F.col("notices.license")))
    return found.select(
        "doc_id", F.size("notices").cast("long").alias("n_notices"),
        F.array_join(names, ",").alias("licenses"),
        F.array_max("notices.n_diff").alias("max_diff"),
        F.array_min("notices.saving").alias("min_saving"),
    )


WORDS = r"regexp_extract_all(translate(coalesce(text, ''), {}), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"


@_query("op8_decontamination", f"""
WITH item AS (SELECT item_id, {WORDS.format(LOWER)} AS w FROM benchmark),
windows AS (
  SELECT DISTINCT item_id, least(10, len(w)) AS n,
    unnest(list_transform(range(1, len(w) - least(10, len(w)) + 2),
      lambda i: array_to_string(w[i:i + least(10, len(w)) - 1], ' '))) AS s
  FROM item WHERE len(w) > 0),
doc AS (SELECT doc_id, {WORDS.format(LOWER)} AS w FROM documents),
spot AS (
  SELECT doc_id, n, unnest(range(1, len(w) - n + 2)) AS p,
    unnest(list_transform(range(1, len(w) - n + 2),
      lambda i: array_to_string(w[i:i + n - 1], ' '))) AS s
  FROM doc, (SELECT DISTINCT n FROM windows) WHERE len(w) >= n),
occ AS (SELECT doc_id, p, n, item_id FROM spot JOIN windows USING (n, s)),
hit AS (
  SELECT doc_id, count(DISTINCT q) AS n_hit
  FROM (SELECT doc_id, unnest(range(p, p + n)) AS q FROM occ) GROUP BY doc_id),
named AS (
  SELECT doc_id, count(*) AS n_items, string_agg(i, ',' ORDER BY i) AS items
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS i FROM occ) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit,
  coalesce(n_items, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AS contaminated
FROM doc LEFT JOIN hit USING (doc_id) LEFT JOIN named USING (doc_id)
""")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontamination.contamination(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), window=10
    )
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["stop"] - s["start"])
    names = F.array_sort(F.transform("items", lambda i: i.cast("string")))
    return found.select(
        "doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join(names, ",").cast("binary"), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
    )


@_query("op9_line_dedup", f"""
WITH lines AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
    generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos
  FROM documents),
keyed AS (
  SELECT *, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
    {LOWER}) AS k FROM lines),
bad AS (
  SELECT k FROM keyed WHERE length(k) >= 1 GROUP BY k HAVING count(DISTINCT doc_id) >= 10)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (bad.k IS NOT NULL) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (bad.k IS NULL), ''))
    AS kept_sha256
FROM keyed LEFT JOIN bad ON keyed.k = bad.k GROUP BY doc_id
""")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    kept = line_dedup.apply_masks(docs, line_dedup.line_masks(docs, min_docs=10, min_chars=1))
    return kept.select(
        F.col("row.doc_id").alias("doc_id"), "n_lines", "n_dropped",
        F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"),
    )


@_query("op10_lm_scoring")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = lm_scoring.fit(docs.where(~lm_scoring.held_out(docs)))
    found = lm_scoring.score(docs, model)
    return found.select(
        "doc_id", lm_scoring.held_out(found).alias("held_out"), "n_tokens", "n_known",
        "train_tokens", "base_score", "score",
    )


# Integer components of the vectors that take part, as a table of rows (vec_id, label, i, x).
INTEGERS = """kept AS (
  SELECT vec_id, label, embedding AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0),
cell AS (
  SELECT vec_id, label, unnest(range(len(v))) AS i,
    unnest(list_transform(v, lambda c: CAST(floor(256 * CAST(c AS DOUBLE)) AS BIGINT))) AS x
  FROM kept)"""


def _assigned(number: int) -> str:
    """Nearest entries by the codebooks of round ``number``; a distance and its entry are one number."""
    return f"""a{number} AS MATERIALIZED (
  SELECT vec_id, label, p, min(d * 64 + j) % 64 AS j, min(d * 64 + j) // 64 AS d
  FROM (SELECT vec_id, label, p, j, sum((part.x - c.x) * (part.x - c.x))::BIGINT AS d
        FROM part JOIN c{number} c USING (p, w) GROUP BY ALL)
  GROUP BY vec_id, label, p)"""


def _averaged(number: int) -> str:
    """The codebooks after round ``number``: floored means, unused entries as they were."""
    return f"""c{number} AS MATERIALIZED (
  SELECT p, j, w, coalesce((s - ((s % n) + n) % n) // n, x) AS x
  FROM c{number - 1} LEFT JOIN (
    SELECT p, j, w, sum(x)::BIGINT AS s, count(*) AS n
    FROM part JOIN a{number - 1} USING (vec_id, p) GROUP BY p, j, w) USING (p, j, w))"""


@_query("op11_vector_codes", f"""
WITH {INTEGERS},
part AS MATERIALIZED (
  SELECT vec_id, label, i // n AS p, i % n AS w, x
  FROM cell, (SELECT (max(i) + 1) // 16 AS n FROM cell)),
c0 AS MATERIALIZED (
  SELECT p, j, w, x FROM part JOIN (
    SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS j
    FROM kept ORDER BY vec_id LIMIT 64) USING (vec_id)),
{_assigned(0)}, {_averaged(1)}, {_assigned(1)}, {_averaged(2)}, {_assigned(2)},
coded AS (
  SELECT vec_id, label, string_agg(printf('%02x', CAST(j AS INTEGER)), '' ORDER BY p) AS code,
    sum(d)::BIGINT AS error
  FROM a2 GROUP BY vec_id, label)
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error,
  (SELECT sha256(string_agg(CAST(x AS VARCHAR), ',' ORDER BY p, j, w)) FROM c2) AS codebooks_sha256
FROM coded
""")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    found, books = vector_codes.compress(table(spark, sf_dir, "embeddings"))
    digest = hashlib.sha256((books.text() if books else "").encode()).hexdigest()
    return found.select(
        F.col("id").alias("vec_id"), "code", "error", "label_error",
        F.lit(digest).alias("codebooks_sha256"),
    )


FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]


def _row_digest(text: str) -> str:
    parts = [f"coalesce(strlen({c}) || ':' || {c}, '-')" for c in
             ("CAST(doc_id AS VARCHAR)", "source", "lang", "CAST(n_chars AS VARCHAR)", text)]
    return f"sha256({' || '.join(parts)})"


def _climb(name: str, start: str) -> str:
    """All levels of trees whose leaves are ``start`` (tree, idx, n, h): runs of three make a node."""
    return f"""{name}(tree, level, idx, n, h) AS (
  SELECT tree, 0, idx, n, h FROM {start}
  UNION ALL
  SELECT tree, level + 1, idx // 3, (n + 2) // 3, sha256(string_agg(h, '' ORDER BY idx))
  FROM {name} WHERE n > 1 GROUP BY tree, level, idx // 3, n)"""


def _steps(name: str, tree: str) -> str:
    """Per leaf and level of ``tree``, what comes before its own node in the run and what after it."""
    return f"""{name} AS (
  SELECT o.tree, o.idx, o.level,
    coalesce(string_agg(s.h, '' ORDER BY s.idx) FILTER (s.idx < o.own), '') AS before,
    coalesce(string_agg(s.h, '' ORDER BY s.idx) FILTER (s.idx > o.own), '') AS after
  FROM (SELECT a.tree, a.idx, l.level, a.idx // CAST(3 ** l.level AS BIGINT) AS own
        FROM {tree} a JOIN (SELECT DISTINCT tree, level FROM {tree} WHERE n > 1) l
          ON a.level = 0 AND a.tree IS NOT DISTINCT FROM l.tree) o
  JOIN {tree} s ON s.tree IS NOT DISTINCT FROM o.tree AND s.level = o.level
    AND s.idx // 3 = o.own // 3
  GROUP BY o.tree, o.idx, o.level)"""


@_query("op12_merkle_manifest", f"""
WITH RECURSIVE docs AS (
  SELECT doc_id, source AS tree, {_row_digest("text")} AS leaf,
    CASE WHEN list_reduce([4294967295] || list_transform(string_split(CAST(doc_id AS VARCHAR), ''),
        lambda c: CAST(ascii(c) AS BIGINT)), lambda r, b: list_reduce(
          [xor(r, b)] || [0, 0, 0, 0, 0, 0, 0, 0],
          lambda x, z: xor(x >> 1, 3988292384 * (x & 1)))) % 2 = 1
      THEN {_row_digest("replace(text, chr(10), '')")} END AS tampered
  FROM documents),
leaves AS MATERIALIZED (
  SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS idx,
    count(*) OVER (PARTITION BY tree) AS n, leaf AS h FROM docs),
{_climb("grown", "leaves")},
subroots AS MATERIALIZED (
  SELECT tree AS source, h, CAST(NULL AS VARCHAR) AS tree,
    row_number() OVER (ORDER BY encode(tree) NULLS FIRST) - 1 AS idx, count(*) OVER () AS n
  FROM grown WHERE n = 1),
{_climb("top", "subroots")},
{_steps("inner_steps", "grown")}, {_steps("top_steps", "top")},
path AS MATERIALIZED (
  SELECT d.tree, d.idx, s.level AS k, before, after
  FROM leaves d JOIN inner_steps s ON s.tree IS NOT DISTINCT FROM d.tree AND s.idx = d.idx
  UNION ALL
  SELECT d.tree, d.idx, 1000 + s.level, before, after
  FROM leaves d JOIN subroots r ON r.source IS NOT DISTINCT FROM d.tree
    JOIN top_steps s ON s.idx = r.idx),
ordered AS MATERIALIZED (
  SELECT tree, idx, before, after, row_number() OVER (PARTITION BY tree, idx ORDER BY k) AS k
  FROM path),
folded(tree, idx, k, h) AS (
  SELECT tree, idx, 0, coalesce(tampered, leaf) FROM leaves
  UNION ALL
  SELECT f.tree, f.idx, f.k + 1, sha256(o.before || f.h || o.after)
  FROM folded f JOIN ordered o
    ON o.tree IS NOT DISTINCT FROM f.tree AND o.idx = f.idx AND o.k = f.k + 1),
proof AS (
  SELECT tree, idx, max(k) AS k, string_agg(before || after, '' ORDER BY k) AS p
  FROM ordered GROUP BY tree, idx),
root AS (SELECT h FROM top WHERE n = 1)
SELECT d.doc_id, d.leaf, r.h AS subroot, root.h AS root, sha256(coalesce(p.p, '')) AS proof_sha256,
  f.h AS folded_root, f.h = root.h AS verified
FROM leaves d JOIN subroots r ON r.source IS NOT DISTINCT FROM d.tree
  LEFT JOIN proof p ON p.tree IS NOT DISTINCT FROM d.tree AND p.idx = d.idx
  JOIN folded f ON f.tree IS NOT DISTINCT FROM d.tree AND f.idx = d.idx AND f.k = coalesce(p.k, 0),
  root
""")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Half of the rows later present a text without line breaks; rows without an id never do."""
    docs = table(spark, sf_dir, "documents")
    stripped = F.replace(docs["text"], F.lit("\n"), F.lit(""))
    changed = merkle.leaf_digest([docs[c] for c in FIELDS[:-1]] + [stripped])
    drawn = F.crc32(docs["doc_id"].cast("string").cast("binary")) % 2 == 0
    manifest = merkle.build(docs, FIELDS, claim=F.when(drawn, changed))
    found = merkle.prove(manifest, docs)
    return found.select(
        F.col("key").alias("doc_id"), "leaf", "subroot", "root",
        F.sha2(F.col("proof").cast("binary"), 256).alias("proof_sha256"), "folded_root",
        (F.col("folded_root") == F.col("root")).alias("verified"),
    )


@_query("op13_exact_top_k", f"""
WITH {INTEGERS},
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, sum(q.x * c.x)::BIGINT AS score
  FROM cell q JOIN cell c USING (i) WHERE q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id
  GROUP BY 1, 2),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM ranked WHERE rank <= 5
""")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_products.top_products(
        table(spark, sf_dir, "embeddings"), lambda i: i % 50 == 0, k=5
    )
