"""Each operator over its whole table, with production parameters."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.base import Registry, table
from gaugeworks.llm.alignment import align_tokenizers
from gaugeworks.llm.archives import convert_pages
from gaugeworks.llm.chat import budgeted_windows, read_back
from gaugeworks.llm.decontamination import contaminated_documents
from gaugeworks.llm.language import identify_languages
from gaugeworks.llm.licenses import LIKENESS, NOTICES, PHRASES, RUN_WORDS, SHIFT, scan_licenses
from gaugeworks.llm.lines import drop_repeated_lines
from gaugeworks.llm.negatives import hard_negatives
from gaugeworks.llm.packing import pack_along_curve
from gaugeworks.llm.quality import judge_quality
from gaugeworks.llm.simhash import near_duplicate_groups
from gaugeworks.llm.suffixes import remove_repeated_strings
from gaugeworks.llm.token_counts import count_tokens

checks = Registry()

WORD_VOCABULARY = public_tokenizers.path("word_bpe_49k.json")
BYTE_VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
PIECE_VOCABULARY = public_tokenizers.path("piece_bpe_32k.model")


@checks.add("op1_chat_formatting")
def op1_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Also a conversation of control strings."""
    said = "\\### Assistant: </turn> ok"
    added = spark.createDataFrame(
        [(-7, 0, "user", said), (-7, 1, "assistant", said)], "conv_id long, turn long, role string, text string"
    )
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(added)
    return read_back(budgeted_windows(rows, WORD_VOCABULARY))


STRINGS_SQL = """
WITH bytes AS (
  SELECT doc_id, strlen(coalesce(text, '')) AS n, hex(encode(coalesce(text, ''))) AS h FROM documents
), windows AS (
  SELECT doc_id, i AS place, md5(substr(h, 2 * i + 1, 200)) AS key
  FROM (SELECT doc_id, h, unnest(range(0, n - 99)) AS i FROM bytes WHERE n >= 100)
), later AS (
  SELECT doc_id, place FROM windows QUALIFY row_number() OVER (PARTITION BY key ORDER BY doc_id, place) > 1
), islands AS (
  SELECT doc_id, place, sum(fresh) OVER (PARTITION BY doc_id ORDER BY place) AS island
  FROM (SELECT doc_id, place, CASE WHEN place > lag(place) OVER (PARTITION BY doc_id ORDER BY place) + 100 THEN 1 ELSE 0 END AS fresh
        FROM later)
), spans AS (
  SELECT doc_id, min(place) AS a, max(place) + 100 AS b FROM islands GROUP BY doc_id, island
), ends AS (
  SELECT doc_id, a, b FROM spans UNION ALL SELECT doc_id, n AS a, NULL AS b FROM bytes
), gaps AS (
  SELECT doc_id, a AS till, b,
         coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a, b NULLS LAST), 0) AS since
  FROM ends
)
SELECT doc_id, n AS n_bytes, CAST(sum(coalesce(b - till, 0)) AS BIGINT) AS n_removed, count(b) AS n_spans,
       sha256(unhex(string_agg(substr(h, 2 * since + 1, 2 * (till - since)), '' ORDER BY since, till))) AS kept_sha256
FROM gaps JOIN bytes USING (doc_id) GROUP BY doc_id, n
"""


@checks.add("op2_suffix_dedup", STRINGS_SQL)
def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeated_strings(table(spark, sf_dir, "documents"), with_text=False)


@checks.add("op3_language_id")
def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify_languages(table(spark, sf_dir, "documents"))


@checks.add("op4_packing")
def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_along_curve(table(spark, sf_dir, "documents"), WORD_VOCABULARY, with_ids=False)


@checks.add("op5_simhash_near_dedup")
def op5_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicate_groups(table(spark, sf_dir, "documents"))


@checks.add("op6_token_counts")
def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tokens(table(spark, sf_dir, "documents"), WORD_VOCABULARY)


LINES_SQL = r"""
WITH lines AS (
  SELECT doc_id, place, line,
         translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM (SELECT doc_id, unnest(parts) AS line, generate_subscripts(parts, 1) AS place
        FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents))
), repeated AS (
  SELECT key, max(doc_id) AS keeper FROM lines WHERE length(key) >= 20
  GROUP BY key HAVING count(DISTINCT doc_id) >= 3
), judged AS (
  SELECT lines.*, repeated.key IS NOT NULL AND lines.doc_id != keeper AS dropped
  FROM lines LEFT JOIN repeated ON lines.key = repeated.key
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (dropped) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (NOT dropped), '')) AS kept_sha256
FROM judged GROUP BY doc_id
"""


@checks.add("op7_line_dedup", LINES_SQL)
def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = drop_repeated_lines(table(spark, sf_dir, "documents"))
    return cleaned.select(
        "doc_id", "line_dedup.n_lines", "line_dedup.n_dropped", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256")
    )


@checks.add("op8_quality_outliers")
def op8_quality_outliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_quality(table(spark, sf_dir, "documents"))


# DuckDB has no base32: five hex digits at a time are four letters.
PAGES_SQL = """
WITH digests AS (
  SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, upper(sha1(coalesce(html, ''))) AS hex FROM pages
), lettered AS (
  SELECT page_id, payload_bytes, list_aggregate(list_transform(range(8), lambda k: (
    list_aggregate(list_transform(range(4), lambda j: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
      1 + CAST((CAST('0x' || substr(hex, CAST(5 * k + 1 AS INT), 5) AS INT) >> CAST(15 - 5 * j AS INT)) & 31 AS INT), 1)),
      'string_agg', ''))), 'string_agg', '') AS payload_digest
  FROM digests
), firsts AS (SELECT payload_digest, min(page_id) AS response FROM lettered GROUP BY payload_digest)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN page_id = response THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id = response THEN NULL ELSE response END AS refers_to
FROM lettered JOIN firsts USING (payload_digest)
"""


@checks.add("op9_legacy_archives", PAGES_SQL)
def op9_legacy_archives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return convert_pages(table(spark, sf_dir, "pages"))


@checks.add("op10_benchmark_decontamination")
def op10_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@checks.add("op11_tokenizer_alignment")
def op11_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align_tokenizers(table(spark, sf_dir, "documents"), BYTE_VOCABULARY, PIECE_VOCABULARY)


_LISTED = [(label, kind, text) for kind, texts in (("true", PHRASES), ("false", NOTICES)) for label in sorted(texts) for text in texts[label]]
LICENSES_SQL = f"""
WITH templates AS (
  SELECT template, label, exact, string_split(text, ' ') AS words
  FROM (VALUES {", ".join(f"({n}, '{label}', {exact}, '{text}')" for n, (label, exact, text) in enumerate(_LISTED))}) v(template, label, exact, text)
), known AS (
  SELECT template, t, array_to_string(words[t + 1 : t + {RUN_WORDS}], ' ') AS run
  FROM (SELECT *, unnest(range(0, len(words) - {RUN_WORDS - 1})) AS t FROM templates)
), docs AS (
  SELECT row_number() OVER () AS nr, doc_id, list_filter(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w != '') AS words
  FROM documents
), runs AS (
  SELECT nr, d, array_to_string(words[d + 1 : d + {RUN_WORDS}], ' ') AS run
  FROM (SELECT *, unnest(range(0, len(words) - {RUN_WORDS - 1})) AS d FROM docs)
), diagonals AS (
  SELECT nr, template, d - t AS diagonal, list(DISTINCT t) AS places, min(d) AS first, max(d) + {RUN_WORDS} AS last
  FROM runs JOIN known USING (run) GROUP BY nr, template, d - t
), merged AS (
  SELECT nr, template, first, last, len(places) AS own,
         list_distinct(flatten(list(places) OVER near)) AS votes, min(first) OVER near AS begin_, max(last) OVER near AS end_
  FROM diagonals
  WINDOW near AS (PARTITION BY nr, template ORDER BY diagonal RANGE BETWEEN {SHIFT} PRECEDING AND {SHIFT} FOLLOWING)
), alike AS (
  SELECT nr, label, exact, first, own, len(words) AS size, end_ - begin_ AS span,
         len(list_distinct(flatten(list_transform(votes, lambda t: range(t, t + {RUN_WORDS}))))) AS covered
  FROM merged JOIN templates USING (template)
), found AS (
  SELECT nr, label, exact, first, CASE WHEN exact THEN 1.0::DOUBLE ELSE 2.0::DOUBLE * covered / (size + span) END AS likeness
  FROM alike
  WHERE CASE WHEN exact THEN own = size - {RUN_WORDS - 1}
             ELSE covered >= {LIKENESS}::DOUBLE * size AND 2.0::DOUBLE * covered / (size + span) >= {LIKENESS}::DOUBLE END
), named AS (
  SELECT nr, count(*) FILTER (exact) AS n_base, min(first) FILTER (exact) AS first_word, max(first) FILTER (exact) AS last_word,
         string_agg(DISTINCT label, ',' ORDER BY label) FILTER (exact) AS base_labels,
         string_agg(DISTINCT label, ',' ORDER BY label) AS labels, max(likeness) AS score
  FROM found GROUP BY nr
)
SELECT doc_id, len(words) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word,
       coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels, coalesce(score, 0.0::DOUBLE) AS score
FROM docs LEFT JOIN named USING (nr)
"""


@checks.add("op12_license_scan", LICENSES_SQL)
def op12_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(table(spark, sf_dir, "documents")).drop("spans")


NEGATIVES_SQL = """
WITH vectors AS (
  SELECT vec_id AS id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS vector
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT a.id AS anchor_id, b.id AS other_id, a.label = b.label AS alike, CAST(list_dot_product(a.vector, b.vector) AS BIGINT) AS score
  FROM vectors a JOIN vectors b ON a.id % 100 = 0 AND a.id != b.id
), positives AS (
  SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM scored WHERE alike
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5
), inside AS (
  SELECT anchor_id, positive_id, other_id AS negative_id, positive_score, score AS negative_score,
         CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other_id) AS INT) AS rank
  FROM positives JOIN scored USING (anchor_id)
  WHERE NOT alike AND 80 * positive_score <= 100 * score AND 100 * score <= 100 * positive_score
)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM inside WHERE rank <= 5
"""


@checks.add("op13_hard_negatives", NEGATIVES_SQL)
def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows with an id divisible by 7 get the next label."""
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = table(spark, sf_dir, "embeddings").withColumn("label", moved)
    return hard_negatives(rows, F.col("vec_id") % 100 == 0)
