"""The registered query of each operator, over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linkwatch.llm import html_extraction
from linkwatch.llm.chat_format import digests, formatted
from linkwatch.llm.circulant_minhash import NearRule, near_components
from linkwatch.llm.common import SPACE_CHARS, SPACE_CLASS, table
from linkwatch.llm.compression_classifier import bucket, fitted, scored
from linkwatch.llm.decontamination import LEAKS, contaminated
from linkwatch.llm.lexical_search import ranked
from linkwatch.llm.license_scan import document_frequencies, scanned
from linkwatch.llm.packing import Capacities, pack_documents
from linkwatch.llm.parity_join import Similarity, similar_components
from linkwatch.llm.quality_rules import base_failed, quality_verdicts
from linkwatch.llm.substring_dedup import Passages, deduplicated
from linkwatch.llm.token_alignment import aligned_tokens
from linkwatch.llm.token_files import read_token_files, write_token_files
from linkwatch.llm.tokens import default_tokenizer
from linkwatch.session import scratch_path

END_ID = 2
# tokens are the only hard limit; runs and attention cost have a say in the choice of a bin
SEQUENCE = Capacities(tokens=1024, weights=(1.0, 1.0, 1.0))


def op1_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    cut = deduplicated(docs, Passages(length=13))
    words = F.regexp_replace(F.trim("text", F.lit(SPACE_CHARS)), SPACE_CLASS + "+", " ")
    return cut.select("doc_id", "n_words", "n_removed", F.sha2(words, 256).alias("kept_sha256"))


def op2_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    return similar_components(table(spark, folder, "documents"), Similarity(words=4, num=85))


def op3_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return contaminated(table(spark, folder, "documents"), table(spark, folder, "benchmark"), LEAKS)


def op4_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return scanned(docs, document_frequencies(docs))


def op5_html_extraction(spark: SparkSession, folder: str) -> DataFrame:
    pages = table(spark, folder, "pages").select("page_id", "url", "html")
    text = html_extraction.extracted(pages, html_extraction.fitted(pages))
    return text.withColumn("n_chars", F.length("text").cast("long"))


def op6_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    return pack_documents(table(spark, folder, "documents"), default_tokenizer(), END_ID, SEQUENCE)


def op7_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "lang", "text")
    labels = table(spark, folder, "labels")
    # texts are not needed beside the counts
    rows = quality_verdicts(docs, labels, carried=("doc_id",))
    m = F.col(rows.columns[-2])
    return rows.select(
        "doc_id",
        *[
            m[c].alias(c)
            for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
        ],
        base_failed(m).alias("base_failed"),
        F.col(rows.columns[-1]).alias("kept"),
    )


def op8_compression_classifier(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    model = fitted(docs, table(spark, folder, "labels"))
    return scored(docs, model).select(
        "doc_id",
        (bucket(F.col("doc_id")) == 2).alias("held_out"),
        "score",
        (F.col("score") >= 0.7).cast("int").alias("predicted"),
    )


def op9_chat_format(spark: SparkSession, folder: str) -> DataFrame:
    text = "</s>[INST] ok [/INST]"
    planted = spark.createDataFrame(
        [(-7, 0, "user", text), (-7, 1, "assistant", text)],
        "conv_id long, turn long, role string, text string",
    )
    rows = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    # every row is a message of its own, also one that repeats another
    events = rows.unionByName(planted).select(
        "conv_id",
        F.col("turn").alias("seq"),
        F.lit("message").alias("kind"),
        F.monotonically_increasing_id().alias("message"),
        "role",
        "text",
    )
    return digests(formatted(events))


def op10_token_files(spark: SparkSession, folder: str) -> DataFrame:
    where = scratch_path(spark, "token-files")
    docs = table(spark, folder, "documents")
    manifest = write_token_files(docs, where, default_tokenizer(), END_ID)
    return read_token_files(spark, where, manifest).drop("partition")


def op11_token_alignment(spark: SparkSession, folder: str) -> DataFrame:
    return aligned_tokens(table(spark, folder, "documents"))


def op12_lexical_search(spark: SparkSession, folder: str) -> DataFrame:
    return ranked(table(spark, folder, "documents"), table(spark, folder, "benchmark"), 50)


def op13_minhash_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return near_components(table(spark, folder, "documents"), NearRule(words=5, num=85))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_substring_dedup": op1_substring_dedup,
    "op2_jaccard_join": op2_jaccard_join,
    "op3_decontamination": op3_decontamination,
    "op4_license_scan": op4_license_scan,
    "op5_html_extraction": op5_html_extraction,
    "op6_best_fit_packing": op6_best_fit_packing,
    "op7_quality_rules": op7_quality_rules,
    "op8_compression_classifier": op8_compression_classifier,
    "op9_chat_format": op9_chat_format,
    "op10_token_files": op10_token_files,
    "op11_token_alignment": op11_token_alignment,
    "op12_lexical_search": op12_lexical_search,
    "op13_minhash_dedup": op13_minhash_dedup,
}

# The marks of a turn and their two blanks have 17, 15 and 14 characters.
CHAT_SQL = r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'
), marked AS (
  SELECT *,
    regexp_replace(text, '(</?s>|<</?SYS>>|\[/?INST\]|\[ANSWER\]|\[ROLE:[^\]\s]*\]|\[/ROLE\])', '\\\1', 'g') AS body,
    CASE role WHEN 'system' THEN 17 WHEN 'user' THEN 15 WHEN 'assistant' THEN 14 END AS frame
  FROM turns
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, body)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, body) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(length(body) + frame) AS BIGINT) AS formatted_chars
FROM marked GROUP BY conv_id
"""

PASSAGE_SQL = r"""
WITH texts AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words
  FROM documents
), runs AS (
  SELECT doc_id, i, words[i : i + 12] AS run
  FROM texts, unnest(generate_series(1, len(words) - 12)) AS t(i)
), firsts AS (
  SELECT run, min(doc_id) AS least FROM runs GROUP BY run
), covered AS (
  SELECT DISTINCT doc_id, p
  FROM runs JOIN firsts USING (run), unnest(generate_series(i, i + 12)) AS t(p)
  WHERE least < doc_id
), placed AS (
  SELECT doc_id, p, words[p] AS word FROM texts, unnest(generate_series(1, len(words))) AS t(p)
), kept AS (
  SELECT doc_id, string_agg(word, ' ' ORDER BY p) AS body
  FROM placed ANTI JOIN covered USING (doc_id, p) GROUP BY doc_id
), lost AS (
  SELECT doc_id, count(*) AS n FROM covered GROUP BY doc_id
)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, coalesce(n, 0) AS n_removed,
  sha256(coalesce(body, '')) AS kept_sha256
FROM texts LEFT JOIN kept USING (doc_id) LEFT JOIN lost USING (doc_id)
"""

JACCARD_SQL = r"""
WITH RECURSIVE texts AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS words
  FROM documents
), shingles AS (
  SELECT DISTINCT doc_id, words[i : i + 3] AS shingle
  FROM texts, unnest(generate_series(1, greatest(1, len(words) - 3))) AS t(i)
  WHERE len(words) > 0
), sizes AS (
  SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), common AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n
  FROM shingles AS a JOIN shingles AS b USING (shingle)
  WHERE a.doc_id <> b.doc_id GROUP BY 1, 2
), links AS (
  SELECT a, b FROM common JOIN sizes AS x ON x.doc_id = a JOIN sizes AS y ON y.doc_id = b
  WHERE 100 * common.n >= 85 * (x.n + y.n - common.n)
), reach AS (
  SELECT doc_id AS a, doc_id AS b FROM texts
  UNION
  SELECT reach.a, links.b FROM reach JOIN links ON links.a = reach.b
), least AS (
  SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a
)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id
FROM least LEFT JOIN sizes USING (doc_id)
"""

NEAR_SQL = r"""
WITH RECURSIVE texts AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS words
  FROM documents
), shingles AS (
  SELECT DISTINCT doc_id, words[i : i + 4] AS shingle
  FROM texts, unnest(generate_series(1, greatest(1, len(words) - 4))) AS t(i)
  WHERE len(words) > 0
), sizes AS (
  SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), common AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n
  FROM shingles AS a JOIN shingles AS b USING (shingle)
  WHERE a.doc_id <> b.doc_id GROUP BY 1, 2
), links AS (
  SELECT a, b FROM common JOIN sizes AS x ON x.doc_id = a JOIN sizes AS y ON y.doc_id = b
  WHERE 100 * common.n >= 85 * (x.n + y.n - common.n)
), reach AS (
  SELECT doc_id AS a, doc_id AS b FROM texts
  UNION
  SELECT reach.a, links.b FROM reach JOIN links ON links.a = reach.b
), least AS (
  SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a
)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id, doc_id = component_id AS kept
FROM least LEFT JOIN sizes USING (doc_id)
"""

SEARCH_SQL = r"""
WITH documents_ AS (
  SELECT row_number() OVER () AS d, doc_id, regexp_extract_all(translate(text,
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms
  FROM documents
), items AS (
  SELECT row_number() OVER () AS i, item_id, list_distinct(regexp_extract_all(translate(text,
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS terms
  FROM benchmark
), totals AS (
  SELECT count(*) AS n_docs, CAST(sum(len(terms)) AS BIGINT) AS n_terms
  FROM documents_ WHERE len(terms) > 0
), counts AS (
  SELECT d, doc_id, len(terms) AS n, unnest(terms) AS term FROM documents_
), postings AS (
  SELECT d, any_value(doc_id) AS doc_id, term, any_value(n) AS n, count(*) AS tf
  FROM counts GROUP BY d, term
), weights AS (
  SELECT term, CAST(floor(1000 * ln((2 * n_docs + 2) / (2 * count(*) + 1))) AS BIGINT) AS w
  FROM postings, totals GROUP BY term, n_docs
), impacts AS (
  SELECT d, doc_id, term,
    (1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * n_docs) // n_terms)) AS impact
  FROM postings, totals
), scores AS (
  SELECT i, item_id, d, doc_id, CAST(sum(w * impact) AS BIGINT) AS score
  FROM (SELECT i, item_id, unnest(terms) AS term FROM items)
  JOIN weights USING (term) JOIN impacts USING (term)
  GROUP BY ALL
)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id) AS rank
  FROM scores WHERE score > 0
) WHERE rank <= 50
"""

# Rate 0.05 over five rules, confidence 0.95 over rules, strata and twelve cutoffs, penalty 10.
QUALITY_SQL = r"""
WITH texts AS (
  SELECT doc_id, coalesce(lang, '') AS stratum, coalesce(text, '') AS text,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words,
    list_filter(string_split(coalesce(text, ''), chr(10)),
      lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
  FROM documents
), runs AS (
  SELECT doc_id, i, words[i : i + 7] AS run
  FROM texts, unnest(generate_series(1, len(words) - 7)) AS t(i)
), again AS (
  SELECT doc_id, unnest(list(i)) AS i FROM runs GROUP BY doc_id, run HAVING count(*) > 1
), repeated AS (
  SELECT doc_id, count(DISTINCT p) AS n FROM again, unnest(generate_series(i, i + 7)) AS t(p)
  GROUP BY doc_id
), measures AS (
  SELECT doc_id, stratum, CAST(len(words) AS BIGINT) AS n_words,
    CAST(length(array_to_string(words, '')) AS BIGINT) AS word_chars,
    CAST(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
    CAST(length(regexp_replace(text, '[^!]', '', 'g')) AS BIGINT) AS n_exclaims,
    CAST(length(regexp_replace(text, '[^\p{Lu}]', '', 'g')) AS BIGINT) AS n_capitals,
    len(lines) AS n_lines,
    CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
    coalesce(n, 0) AS n_repeat_words
  FROM texts LEFT JOIN repeated USING (doc_id)
), judged AS (
  SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM measures
), shares AS (
  SELECT doc_id, stratum, base_failed, unnest([
    {'rule': 'symbols', 'share': n_symbols / nullif(word_chars, 0)},
    {'rule': 'exclaims', 'share': n_exclaims / nullif(word_chars, 0)},
    {'rule': 'capitals', 'share': n_capitals / nullif(word_chars, 0)},
    {'rule': 'lines', 'share': n_dup_lines / nullif(n_lines, 0)},
    {'rule': 'repeats', 'share': n_repeat_words / nullif(n_words, 0)}], recursive := true)
  FROM judged
), marks AS (
  SELECT doc_id, min(quality) = 1 AS good FROM labels WHERE quality IS NOT NULL GROUP BY doc_id
), known AS (
  SELECT * FROM shares JOIN marks USING (doc_id) WHERE NOT base_failed
), candidates AS (
  SELECT stratum, rule, cutoff, count(*) FILTER (good) AS n_good, count(*) FILTER (NOT good) AS n_bad,
    count(*) FILTER (good AND share > cutoff) AS good_lost,
    count(*) FILTER (NOT good AND share > cutoff) AS bad_lost
  FROM known, (SELECT unnest([0.02, 0.05, 0.1, 0.15, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9]::DOUBLE[]) AS cutoff)
  GROUP BY ALL
), tested AS (
  SELECT *, bad_lost / nullif(n_bad, 0) - 10 * good_lost / nullif(n_good, 0) AS useful,
    CASE WHEN good_lost >= n_good * 0.01 THEN 1 ELSE list_sum(list_transform(range(0, good_lost + 1),
      lambda i: exp(lgamma(n_good + 1) - lgamma(i + 1) - lgamma(n_good - i + 1)
        + i * ln(0.01) + (n_good - i) * ln(0.99)))) END AS tail
  FROM candidates
), chosen AS (
  SELECT stratum, rule, arg_max(cutoff, {'u': useful, 'c': cutoff}) AS cutoff FROM tested
  WHERE useful > 0
    AND tail <= 0.05 / (5 * 12 * (SELECT count(DISTINCT stratum) FROM known))
  GROUP BY ALL
), broken AS (
  SELECT DISTINCT doc_id FROM shares JOIN chosen USING (stratum, rule) WHERE share > cutoff
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND doc_id NOT IN (SELECT doc_id FROM broken) AS kept
FROM judged
"""

ORACLES: dict[str, str] = {
    "op1_substring_dedup": PASSAGE_SQL,
    "op2_jaccard_join": JACCARD_SQL,
    "op7_quality_rules": QUALITY_SQL,
    "op9_chat_format": CHAT_SQL,
    "op12_lexical_search": SEARCH_SQL,
    "op13_minhash_dedup": NEAR_SQL,
}
