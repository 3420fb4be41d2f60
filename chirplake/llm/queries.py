"""The registered queries of the operators, with their production parameters, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chirplake.llm import (
    bag_search,
    decontaminate,
    host_rules,
    importance,
    line_dedup,
    piece_fst,
    rank_fold,
    rendezvous,
    simhash,
    token_orc,
    token_scan,
    url_filter,
    whitening,
)
from chirplake.llm.common import prepare, table
from chirplake.settings import new_run_folder

# Fixed values of the url rules.
URL_RULES = (
    url_filter.Rule("block", "net/"),
    url_filter.Rule("allow", "example.net/en/"),
    url_filter.Rule("block", "example.com/de/"),
    url_filter.Rule("allow", "org/fr/"),
)
SHARDS = 40
BYTE_TOKENIZER = "byte_bpe_50k.json"
PIECE_MODEL = "piece_bpe_32k.model"
RANKS = "byte_bpe_multi_50k.tiktoken"


def tokenizer_file(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document's lines, lines dropped, and the checksum of what stays."""
    docs = table(prepare(spark), sf_dir, "documents").select("doc_id", "text")
    return line_dedup.dedup_lines(docs).select(
        "doc_id", "n_lines", "n_dropped", F.sha2(F.col("text"), 256).alias("kept_sha256")
    )


def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each page's host, path, rule and verdict."""
    judged = url_filter.judge(table(prepare(spark), sf_dir, "pages"), URL_RULES)
    return judged.select("page_id", "host", "path", "rule", "verdict", "score")


def op3_token_orc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document's span of ids and their checksum, read back from ORC."""
    docs = table(prepare(spark), sf_dir, "documents")
    path = new_run_folder(spark, "token-orc")
    token_orc.write_tokens(docs, path, tokenizer_file(BYTE_TOKENIZER))
    return token_orc.token_spans(token_orc.read_tokens(spark, path))


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document's place and number of ids, found by scanning flat token files."""
    docs = table(prepare(spark), sf_dir, "documents")
    path = new_run_folder(spark, "token-flat")
    token_scan.write_flat(docs, path, tokenizer_file(PIECE_MODEL))
    return token_scan.count_tokens(spark, path).select("document", "start", "n_tokens", "complete")


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document's fingerprint and near-duplicate group."""
    groups = simhash.near_groups(table(prepare(spark), sf_dir, "documents"))
    return groups.select(
        "doc_id",
        F.lower(F.lpad(F.hex("code"), 16, "0")).alias("fingerprint"),
        F.col("component").alias("component_id"),
    )


def op6_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document's ids as number and checksum, and whether they decode to its text."""
    docs = table(prepare(spark), sf_dir, "documents").select("doc_id", "text")
    model = tokenizer_file(PIECE_MODEL)
    decoded = piece_fst.decode(piece_fst.encode(docs, model), model)
    return decoded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.xxhash64("ids").alias("ids_xxhash64"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
        (F.col("decoded") == F.coalesce("text", F.lit(""))).alias("round_trip"),
    )


def op7_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document's words inside benchmark windows and the items they come from."""
    docs = table(prepare(spark), sf_dir, "documents")
    hits = decontaminate.find_hits(docs, table(spark, sf_dir, "benchmark"))
    n_hit = F.size(decontaminate.hit_words(F.col("hits"))).cast("long")
    return hits.select(
        "doc_id",
        F.col("n_words").cast("long").alias("n_words"),
        n_hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join(F.array_sort("items"), ","), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
    )


def op8_host_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document's base numbers and whether rules and host verdict keep it."""
    judged = host_rules.judge(table(prepare(spark), sf_dir, "documents"))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept", "source", "host_rejected",
    )


def op9_rendezvous(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document's shard and place in it, and its shard when there is one more."""
    docs = table(prepare(spark), sf_dir, "documents")
    placed = rendezvous.shard(docs, [1.0] * SHARDS, [1.0] * (SHARDS + 1))
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard"
    )


def op10_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document's importance weight, rank, and whether it is drawn."""
    docs = table(prepare(spark), sf_dir, "documents")
    return importance.resample(docs, table(spark, sf_dir, "labels"))


def op11_rank_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document's ids as number and checksum, and the checksum of the bytes they decode to."""
    docs = table(prepare(spark), sf_dir, "documents").select("doc_id", "text")
    ranks = tokenizer_file(RANKS)
    decoded = rank_fold.decode(rank_fold.encode(docs, ranks), ranks)
    return decoded.select(
        "doc_id",
        F.expr("octet_length(ids) div 4").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op12_bag_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each benchmark item's ten best documents."""
    docs = table(prepare(spark), sf_dir, "documents")
    found = bag_search.search(docs, table(spark, sf_dir, "benchmark"))
    return found.select("item_id", "rank", F.col("doc_id").cast("long").alias("doc_id"), "score")


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each vector's first whitened components, with the figures that certify them."""
    return whitening.whiten(table(prepare(spark), sf_dir, "embeddings"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    query.__name__: query
    for query in (
        op1_line_dedup, op2_url_filter, op3_token_orc, op4_token_counts, op5_simhash,
        op6_sentencepiece, op7_decontaminate, op8_host_rules, op9_rendezvous, op10_importance,
        op11_rank_bpe, op12_bag_search, op13_whitening,
    )
}

_KEY = r"""regexp_replace(translate(line, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '^[\x09-\x0D ]+|[\x09-\x0D ]+$', '', 'g')"""

_LOWER = "translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"

_WINDOW_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"

ORACLE_SQL: dict[str, str] = {
    "op1_line_dedup": rf"""
WITH split AS (
  SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents
), rows AS (
  SELECT doc_id, unnest(lines) AS line, generate_subscripts(lines, 1) AS pos FROM split
), keyed AS (
  SELECT doc_id, pos, line, {_KEY} AS key FROM rows
), firsts AS (
  SELECT key, min(doc_id) AS first_doc FROM keyed WHERE length(key) >= 10 GROUP BY key
), marked AS (
  SELECT k.doc_id, k.pos, k.line, f.key IS NOT NULL AND k.doc_id <> f.first_doc AS gone
  FROM keyed k LEFT JOIN firsts f ON k.key = f.key
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id""",
    "op7_decontaminate": rf"""
WITH items AS (
  SELECT item, words, len(words) AS n, least(10, len(words)) AS k
  FROM (SELECT coalesce(CAST(item_id AS VARCHAR), '') AS item,
          regexp_extract_all({_LOWER.format("text")}, '{_WINDOW_WORD}') AS words FROM benchmark)
  WHERE len(words) > 0
), grams AS (
  SELECT DISTINCT item, k, array_to_string(words[i:i + k - 1], ' ') AS gram
  FROM (SELECT *, unnest(range(1, n - k + 2)) AS i FROM items)
), docs AS (
  SELECT doc_id, coalesce(regexp_extract_all({_LOWER.format("text")}, '{_WINDOW_WORD}'), []) AS words
  FROM documents
), hits AS (
  SELECT doc_id, i, k, item
  FROM (SELECT doc_id, k, i, array_to_string(words[i:i + k - 1], ' ') AS gram
        FROM (SELECT *, unnest(range(1, len(words) - k + 2)) AS i
              FROM docs, (SELECT DISTINCT k FROM grams)))
  JOIN grams USING (k, gram)
), hit_words AS (
  SELECT doc_id, count(DISTINCT place) AS n_hit
  FROM (SELECT doc_id, unnest(range(i, i + k)) AS place FROM hits) GROUP BY doc_id
), hit_items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT doc_id, item FROM hits) GROUP BY doc_id
)
SELECT doc_id, len(words) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM docs LEFT JOIN hit_words USING (doc_id) LEFT JOIN hit_items USING (doc_id)""",
    "op8_host_rules": rf"""
WITH split AS (
  SELECT row_number() OVER () AS row, doc_id, source, coalesce(text, '') AS text,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents
), lines AS (
  SELECT row, count(*) - count(DISTINCT line) AS n_dup_lines
  FROM (SELECT row, unnest(string_split(text, chr(10))) AS line FROM split)
  WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY row
), windows AS (
  SELECT row, i, count(*) OVER (PARTITION BY row, gram) AS times
  FROM (SELECT row, i, array_to_string(words[i:i + 4], ' ') AS gram
        FROM (SELECT row, words, unnest(range(1, len(words) - 3)) AS i FROM split))
), repeats AS (
  SELECT row, count(DISTINCT place) AS n_repeat_words
  FROM (SELECT row, unnest(range(i, i + 5)) AS place FROM windows WHERE times > 1) GROUP BY row
), measured AS (
  SELECT doc_id, source, len(words) AS n_words, length(array_to_string(words, '')) AS word_chars,
    length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
    coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words
  FROM split LEFT JOIN lines USING (row) LEFT JOIN repeats USING (row)
), failed AS (
  SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM measured
), hosts AS (
  SELECT source, CAST(count(*) AS DOUBLE) AS n, CAST(count(*) FILTER (base_failed) AS DOUBLE) AS bad
  FROM failed GROUP BY source
), totals AS (
  SELECT count(*) AS hosts, sum(n) AS n, sum(bad) / sum(n) AS mean, sum(n * n) AS squares FROM hosts
), spread AS (
  SELECT any_value(mean) AS mean, any_value(mean) * (1 - any_value(mean)) AS chance,
    (sum(h.n * (bad / h.n - mean) ** 2) - (any_value(hosts) - 1) * any_value(mean) * (1 - any_value(mean)))
      / nullif(any_value(t.n) - any_value(squares) / any_value(t.n), 0) AS beyond
  FROM hosts h, totals t
), verdicts AS (
  SELECT source, CASE WHEN beyond > 0 AND chance > 0
      THEN (bad + mean * greatest(chance / beyond - 1, 1)) / (n + greatest(chance / beyond - 1, 1))
      ELSE mean END > 0.8 AS host_rejected
  FROM hosts, spread
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND NOT host_rejected AS kept, f.source, host_rejected
FROM failed f JOIN verdicts v ON f.source IS NOT DISTINCT FROM v.source""",
    "op12_bag_search": rf"""
WITH doc_terms AS (
  SELECT row_number() OVER () AS doc, doc_id, regexp_extract_all({_LOWER.format("text")}, '{_TERM}') AS terms
  FROM documents
), docs AS (
  SELECT doc, doc_id, terms, len(terms) AS n FROM doc_terms WHERE len(terms) > 0
), totals AS (
  SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS terms FROM docs
), item_terms AS (
  SELECT item, item_id, unnest(list_distinct(terms)) AS term
  FROM (SELECT row_number() OVER () AS item, item_id,
          regexp_extract_all({_LOWER.format("text")}, '{_TERM}') AS terms FROM benchmark)
), postings AS (
  SELECT doc, term, count(*) AS tf FROM (SELECT doc, unnest(terms) AS term FROM docs)
  WHERE term IN (SELECT term FROM item_terms) GROUP BY doc, term
), weights AS (
  SELECT term, CAST(floor(1000 * ln(CAST(2 * any_value(docs) + 2 AS DOUBLE) / (2 * count(*) + 1))) AS BIGINT) AS w
  FROM postings, totals GROUP BY term
), gains AS (
  SELECT p.doc, d.doc_id, p.term,
    w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * t.docs) // t.terms))) AS gain
  FROM postings p JOIN weights USING (term) JOIN docs d USING (doc), totals t
), scores AS (
  SELECT item, any_value(item_id) AS item_id, any_value(doc_id) AS doc_id, CAST(sum(gain) AS BIGINT) AS score
  FROM item_terms JOIN gains USING (term) GROUP BY item, doc
), ranked AS (
  SELECT item_id, row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id) AS rank, doc_id, score
  FROM scores WHERE score > 0
)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM ranked WHERE rank <= 10""",
}
