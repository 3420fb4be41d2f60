"""The same results as SQL over the same Parquet tables, for DuckDB."""

from __future__ import annotations

from chirplake.functions.labels import CLASS_IDS
from chirplake.plans.catalog import TABLES, TEXT_COLUMNS

POSTS = """
posts AS (
  SELECT event_id AS post_id, event_type, event_id % 97 = 0 AS is_broken,
    CASE WHEN event_id % 101 = 0 THEN NULL WHEN event_id % 103 = 0 THEN 'not a date'
         ELSE strftime(ts, '%a %b %d %H:%M:%S UTC %Y') END AS "date",
    CASE WHEN event_id % 211 <> 0 THEN 'user' || user_id END AS "user",
    CASE event_id % 12
      WHEN 0 THEN w
      WHEN 1 THEN '@' || k || ' ' || w
      WHEN 2 THEN w || ' @' || k
      WHEN 3 THEN '@' || k || ' @' || j || ' ' || w
      WHEN 4 THEN 'mail ' || k || '@example.com ' || w
      WHEN 5 THEN '@' || k || '@' || j || ' ' || w
      WHEN 6 THEN '@@' || k || ' ' || w
      WHEN 7 THEN '(@' || k || '), ' || w || '!'
      WHEN 8 THEN 'a @ b ' || w
      WHEN 9 THEN '@' || k || ' @' || k || ' ' || w
      WHEN 11 THEN '@José ' || w
    END AS text,
    CASE WHEN event_type IN ('purchase', 'signup') THEN 'positive'
         WHEN event_type = 'view' THEN 'neutral' ELSE 'negative' END AS sentiment
  FROM (
    SELECT *, 'h' || (user_id % 23) AS k, 'h' || (event_id % 7) AS j,
      CASE event_id % 5 WHEN 0 THEN 'love it' WHEN 1 THEN 'great day' WHEN 2 THEN 'so so'
           WHEN 3 THEN 'hate it' ELSE 'awful news' END AS w
    FROM events
  )
)"""

PARSED = "try_strptime(\"date\", '%a %b %d %H:%M:%S UTC %Y')"
CLEANED = r"regexp_replace(text, '@\w+', '', 'g')"
TOKEN_TEXT = r"regexp_replace({0}, '[^@\w]', ' ', 'g')"
HAS_MENTION = r"regexp_matches({0}, '(^|[^@\w])@\w')"

SILVER = rf"""
silver AS (
  SELECT {PARSED} AS "timestamp", mention, {CLEANED} AS cleaned_text, sentiment
  FROM (SELECT *, unnest(string_split({TOKEN_TEXT.format("text")}, ' ')) AS mention FROM posts)
  WHERE regexp_matches(mention, '^@\w')
)"""


def _scored(source: str, text: str) -> str:
    """Rows of ``source`` with the lexicon label and score of a text column."""
    return rf"""
    SELECT *,
      CASE WHEN p > n THEN 'POS' WHEN n > p THEN 'NEG' ELSE 'NEU' END AS label,
      CASE WHEN p + n = 0 THEN CAST(0.5 AS DOUBLE)
           ELSE CAST(0.5 AS DOUBLE) + CAST(0.5 AS DOUBLE) * abs(p - n) / (p + n) END AS score
    FROM (
      SELECT *, coalesce(len(regexp_extract_all({text}, '\b(love|great)\b')), 0) AS p,
        coalesce(len(regexp_extract_all({text}, '\b(hate|awful)\b')), 0) AS n
      FROM {source})"""


GIVEN_ID = """CAST(CASE sentiment WHEN 'positive' THEN 1 WHEN 'negative' THEN 0 ELSE 2 END
    AS INTEGER) AS sentiment_id"""
PREDICTED_ID = """CAST(CASE label WHEN 'POS' THEN 1 ELSE 0 END AS INTEGER)
    AS predicted_sentiment_id"""

GOLD = f"""
gold AS (
  SELECT "timestamp", mention, cleaned_text, sentiment, score * 100 AS predicted_score,
    label AS predicted_sentiment, {GIVEN_ID}, {PREDICTED_ID}
  FROM ({_scored("silver", "cleaned_text")})
)"""

COUNTS = """
  count(*) FILTER (predicted_sentiment = 'NEG') AS negative,
  count(*) FILTER (predicted_sentiment = 'NEU') AS neutral,
  count(*) FILTER (predicted_sentiment = 'POS') AS positive"""
TIMES = 'min("timestamp") AS min_timestamp, max("timestamp") AS max_timestamp'

CONFUSED = """
cells AS (
  SELECT count(*) FILTER (sentiment_id = 1 AND predicted_sentiment_id = 1) AS true_positive,
    count(*) FILTER (sentiment_id = 0 AND predicted_sentiment_id = 1) AS false_positive,
    count(*) FILTER (sentiment_id = 1 AND predicted_sentiment_id = 0) AS false_negative,
    count(*) FILTER (sentiment_id = 0 AND predicted_sentiment_id = 0) AS true_negative
  FROM gold
)"""


def _ratio(part: str, whole: str) -> str:
    return f"CASE WHEN {whole} = 0 THEN CAST(0 AS DOUBLE) ELSE ({part}) / ({whole}) END"


def _measures(tp: str, fp: str, fn: str) -> str:
    return f"""{_ratio(tp, f"({tp} + {fp})")} AS "precision",
      {_ratio(tp, f"({tp} + {fn})")} AS recall,
      {_ratio(f"2 * {tp}", f"(2 * {tp} + {fp} + {fn})")} AS f1_score"""


METRICS = f"""
metrics AS (
  SELECT *, {_measures("true_positive", "false_positive", "false_negative")} FROM cells
)"""

CLASSES = "(VALUES " + ", ".join(f"({c})" for c in CLASS_IDS) + ")"

LINE = """'{' || concat_ws(',',
    CASE WHEN "date" IS NOT NULL THEN '"date":"' || "date" || '"' END,
    CASE WHEN "user" IS NOT NULL THEN '"user":"' || "user" || '"' END,
    CASE WHEN text IS NOT NULL THEN '"text":"' || text || '"' END,
    '"sentiment":"' || sentiment || '"')"""

FILES = "greatest(12, CAST(ceil(count(*) / 1000000.0) AS BIGINT))"


def _with(*parts: str) -> str:
    return "WITH " + ",".join(parts)


def _missing(table: str) -> str:
    def count(column: str) -> str:
        name = column.rstrip("*")
        or_nan = f' OR isnan("{name}")' if column.endswith("*") else ""
        return f"""SELECT '{table}' AS table_name, '{name}' AS column_name, count(*) AS rows,
          count(*) FILTER ("{name}" IS NULL{or_nan}) AS missing FROM {table}"""

    return " UNION ALL ".join(count(column) for column in TABLE_COLUMNS[table].split())


# Columns of the test tables; a star marks floating point.
TABLE_COLUMNS = {
    "region": "r_regionkey r_name",
    "nation": "n_nationkey n_name n_regionkey",
    "customer": "c_custkey c_name c_nationkey c_acctbal* c_mktsegment",
    "supplier": "s_suppkey s_name s_nationkey s_acctbal*",
    "part": "p_partkey p_name p_brand p_type p_size p_retailprice*",
    "orders": "o_orderkey o_custkey o_orderstatus o_totalprice* o_orderdate o_orderpriority",
    "lineitem": "l_orderkey l_partkey l_suppkey l_linenumber l_quantity* l_extendedprice* "
    "l_discount* l_tax* l_returnflag l_linestatus l_shipdate",
    "events": "event_id ts user_id event_type value* props",
    "documents": "doc_id text lang source n_chars",
    "embeddings": "vec_id embedding label",
    "pages": "page_id url html",
    "benchmark": "item_id text",
    "labels": "doc_id quality toxic",
    "conversations": "conv_id turn role text",
    "posts": "post_id date user text sentiment",
}


def oracle_sql() -> dict[str, str]:
    posts, silver, gold = _with(POSTS), _with(POSTS, SILVER), _with(POSTS, SILVER, GOLD)
    given = _with(POSTS, SILVER, GOLD, CONFUSED, METRICS)
    application = f"""{gold}
      SELECT *, negative + neutral + positive AS total
      FROM (SELECT mention, {TIMES}, {COUNTS} FROM gold GROUP BY mention)"""
    silver_rows = f"{silver} SELECT * FROM silver"
    gold_rows = f"{gold} SELECT * FROM gold"
    raw_rows = f'{posts} SELECT "date", "user", text, sentiment FROM posts'

    def top(label: str, name: str) -> str:
        return f"""{gold} SELECT mention, count(*) FILTER (predicted_sentiment = '{label}') AS {name}
          FROM gold GROUP BY mention ORDER BY {name} DESC, mention LIMIT 20"""

    def presence(found: str) -> str:
        return f"""{posts} SELECT count(*) AS total, count(*) FILTER ({found}) AS with_mention,
          count(*) - count(*) FILTER ({found}) AS without_mention FROM posts"""

    def text_profile(table: str, column: str) -> str:
        return f"""SELECT '{table}' AS table_name, count(*) AS rows,
          count(*) FILTER ({column} LIKE '%@%') AS with_at_sign,
          count(*) FILTER ({HAS_MENTION.format(column)}) AS with_mention,
          CAST(sum(len(string_split({TOKEN_TEXT.format(column)}, ' '))) AS BIGINT) AS tokens,
          CAST(sum(length(regexp_replace({column}, '@\\w+', '', 'g'))) AS BIGINT) AS cleaned_chars
          FROM {table}"""

    throughput = """
      SELECT event_type AS stream,
        make_timestamp(epoch_us(ts) // 10000000 * 10000000) AS slot_start,
        CAST(sum(event_id % 13) AS BIGINT) AS rows,
        avg(CASE WHEN event_id % 5 <> 0 THEN event_id % 700 END) AS mean_duration_ms
      FROM events GROUP BY ALL"""

    return {
        "application_table": application,
        "silver_mentions": silver_rows,
        "silver_by_tokens": f"{silver} SELECT mention, count(*) AS rows FROM silver GROUP BY mention",
        "gold_scored": gold_rows,
        "gold_scored_per_post": gold_rows,
        "gold_model_scored": gold_rows,
        "silver_flags": f"""{posts} SELECT "date" AS "timestamp",
          CAST(CASE WHEN contains(text, '@') THEN 1 ELSE 0 END AS INTEGER) AS mention,
          {CLEANED} AS text, sentiment, 'silver' AS data_layer, TRUE AS has_processing_time
          FROM posts WHERE text IS NOT NULL""",
        "parsed_timestamp": f'{posts} SELECT post_id, "date", {PARSED} AS "timestamp" FROM posts',
        "cleaned_text": f"{posts} SELECT post_id, {CLEANED} AS cleaned_text FROM posts",
        "post_tokens": f"""{posts} SELECT post_id, {TOKEN_TEXT.format("text")} AS token_text,
          len(string_split({TOKEN_TEXT.format("text")}, ' ')) AS tokens FROM posts""",
        "class_ids": f"""{posts} SELECT post_id, {GIVEN_ID}, {PREDICTED_ID}
          FROM ({_scored("posts", "text")})""",
        "text_tables_presence": " UNION ALL ".join(
            text_profile(*entry) for entry in TEXT_COLUMNS.items()
        ),
        "layer_row_counts": f"""{silver} SELECT 'bronze' AS layer, count(*) AS rows FROM posts
          UNION ALL SELECT 'silver', count(*) FROM silver
          UNION ALL SELECT 'gold', count(*) FROM silver""",
        "layer_preview": f"{gold_rows} ORDER BY ALL LIMIT 5",
        "silver_preview": f"{silver_rows} ORDER BY ALL LIMIT 5",
        "bronze_preview": f"{raw_rows} ORDER BY ALL LIMIT 5",
        "null_profile": f"{posts} {_missing('posts')}",
        "null_profile_all_tables": " UNION ALL ".join(_missing(table) for table in TABLES),
        "posts_per_user": f'{posts} SELECT "user", count(*) AS posts FROM posts GROUP BY "user"',
        "top_users": f"""{posts} SELECT "user", count(*) AS posts FROM posts GROUP BY "user"
          ORDER BY count(*) DESC, "user" NULLS FIRST LIMIT 20""",
        "at_sign_presence": presence("text LIKE '%@%'"),
        "mention_presence": presence(HAS_MENTION.format("text")),
        "key_skew_profile": f"""{silver} SELECT *, largest / median AS largest_to_median,
            largest / rows AS largest_share
          FROM (SELECT count(*) AS keys, CAST(sum(size) AS BIGINT) AS rows, max(size) AS largest,
                  quantile_cont(size, 0.5) AS median
                FROM (SELECT count(*) AS size FROM silver GROUP BY mention))""",
        "mention_total": f"""{gold} SELECT count(mention) AS mentions,
          count(DISTINCT mention) AS distinct_mentions FROM gold""",
        "mention_pivot": f"""{gold} SELECT *, negative + neutral + positive AS total
          FROM (SELECT mention, {COUNTS} FROM gold GROUP BY mention)""",
        "mention_time_range": f"{silver} SELECT mention, {TIMES} FROM silver GROUP BY mention",
        "top_positive_mentions": top("POS", "positive"),
        "top_negative_mentions": top("NEG", "negative"),
        "most_mentioned": f"""{silver} SELECT mention, count(*) AS total
          FROM silver GROUP BY mention ORDER BY total DESC, mention LIMIT 10""",
        "salted_mention_totals": f"""{silver}
          SELECT mention, count(*) AS total FROM silver GROUP BY mention""",
        "classifier_metrics": f"{given} SELECT * FROM metrics",
        "confusion_matrix": f"""{gold},
          counted AS (SELECT sentiment_id, predicted_sentiment_id, count(*) AS rows
                      FROM gold GROUP BY ALL)
          SELECT CAST(a.id AS INTEGER) AS sentiment_id, CAST(p.id AS INTEGER)
            AS predicted_sentiment_id, coalesce(rows, 0) AS rows
          FROM {CLASSES} AS a(id) CROSS JOIN {CLASSES} AS p(id)
          LEFT JOIN counted ON sentiment_id = a.id AND predicted_sentiment_id = p.id""",
        "per_class_metrics": f"""{gold}
          SELECT class_id, {_measures("tp", "fp", "fn")}, tp + fn AS support
          FROM (
            SELECT CAST(id AS INTEGER) AS class_id,
              count(*) FILTER (sentiment_id = id AND predicted_sentiment_id = id) AS tp,
              count(*) FILTER (sentiment_id <> id AND predicted_sentiment_id = id) AS fp,
              count(*) FILTER (sentiment_id = id AND predicted_sentiment_id <> id) AS fn
            FROM gold, {CLASSES} AS c(id) GROUP BY id)""",
        "evaluation_run": f"""{given}
          SELECT 'post_scores' AS run_name, kind, key, text_value, metric_value,
            TRUE AS is_set
          FROM (
            SELECT 'metric' AS kind, 'precision' AS key, NULL AS text_value,
              "precision" AS metric_value FROM metrics
            UNION ALL SELECT 'metric', 'recall', NULL, recall FROM metrics
            UNION ALL SELECT 'metric', 'f1_score', NULL, f1_score FROM metrics
            UNION ALL SELECT * FROM (VALUES
              ('param', 'scorer', 'lexicon', NULL), ('param', 'engine_version', NULL, NULL),
              ('param', 'silver_batch', NULL, NULL), ('param', 'scored_table', NULL, NULL),
              ('tag', 'task', 'post sentiment', NULL), ('tag', 'posts_from', 'events', NULL),
              ('tag', 'layer', 'gold', NULL), ('artifact', 'confusion_matrix', NULL, NULL)))""",
        "scorer_agreement": f"""{silver}
          SELECT count(*) AS rows, CAST(0 AS BIGINT) AS different FROM silver""",
        "source_file_totals": f"""{posts} SELECT {FILES} AS files,
          CAST(sum(octet_length(encode({LINE} || '}}')) + 1) AS BIGINT) AS bytes FROM posts""",
        "json_inferred_scan": raw_rows,
        "text_line_scan": f"{posts} SELECT {LINE} || '}}' AS value FROM posts",
        "bronze_stream": f"""{posts} SELECT "date", "user", text, sentiment,
          TRUE AS has_source_file, TRUE AS has_processing_time FROM posts""",
        "silver_stream": silver_rows,
        "gold_stream": gold_rows,
        "application_stream": application,
        "table_streamed_directly": "SELECT * FROM events",
        "source_file_coverage": f"""{posts} SELECT {FILES} AS files, count(*) AS rows,
          CAST(0 AS BIGINT) AS rows_without_file FROM posts""",
        "batches_per_stream": f"""
          WITH landed AS (SELECT {FILES} AS files FROM events),
          rate AS (SELECT files, CAST(10 AS BIGINT) AS per_batch FROM landed),
          batches AS (
            SELECT least(per_batch, files - start) AS files_in_batch
            FROM (SELECT *, unnest(range(0, files, per_batch)) AS start FROM rate))
          SELECT files_in_batch, count(*) AS batches FROM batches GROUP BY files_in_batch""",
        "rerun_is_noop": f"""{silver}
          SELECT count(*) AS rows, CAST(0 AS BIGINT) AS rows_read_again FROM silver""",
        "incremental_ingest": f"""{posts}
          SELECT CAST(CASE sentiment WHEN 'negative' THEN 2 ELSE 1 END AS INTEGER) AS run,
            sentiment, count(*) AS rows FROM posts GROUP BY sentiment""",
        "schema_merge_read": f"""{posts} SELECT "date", "user", text, sentiment,
          CASE sentiment WHEN 'negative' THEN event_type END AS event_type FROM posts""",
        "malformed_json_split": f"""{posts}
          SELECT CASE WHEN NOT is_broken THEN "date" END AS "date",
            CASE WHEN NOT is_broken THEN "user" END AS "user",
            CASE WHEN NOT is_broken THEN text END AS text,
            CASE WHEN NOT is_broken THEN sentiment END AS sentiment,
            CASE WHEN is_broken THEN {LINE} END AS rejected_line FROM posts""",
        "compacted_table": gold_rows,
        "compacted_then_appended": raw_rows,
        "stream_rows": f"""{silver} SELECT 'bronze_stream' AS stream, count(*) AS rows FROM posts
          UNION ALL SELECT 'silver_stream', count(*) FROM posts
          UNION ALL SELECT 'gold_stream', count(*) FROM silver
          UNION ALL SELECT 'application_stream', count(*) FROM silver""",
        "archived_landing": f"""{posts} SELECT "date", "user", text, sentiment,
          CAST(0 AS BIGINT) AS files_left FROM posts""",
        "levelled_compaction": f"{gold} SELECT *, TRUE AS few_copies FROM gold",
        "clustered_mention": f"{gold} SELECT * FROM gold WHERE mention = '@h3'",
        "reconciled_generations": """SELECT event_id,
            CASE WHEN event_id % 2 = 0 THEN '' ELSE 'user' END || user_id AS "user",
            CASE WHEN event_id % 2 <> 0 THEN event_type END AS event_type FROM events""",
        "heavy_mentions": f"""{silver} SELECT mention, count(*) AS rows, TRUE AS is_given, TRUE AS is_inside
          FROM silver GROUP BY mention HAVING count(*) * 100 >= (SELECT count(*) FROM silver)""",
        "salted_join_counts": f"""{gold} SELECT "timestamp", mention, predicted_sentiment,
          count(*) OVER (PARTITION BY mention) AS total FROM gold""",
        "length_quantile_bounds": """SELECT CAST(share AS DOUBLE) AS share, TRUE AS is_near
          FROM (VALUES (0.05), (0.25), (0.5), (0.75), (0.95)) AS t(share)""",
        "gold_memo_scored": gold_rows,
        "gold_memo_stream": gold_rows,
        "gold_cost_balanced": gold_rows,
        "nested_landing_ingest": raw_rows,
        "chained_quarantine": rf"""{posts}
          SELECT mention, {CLEANED} AS cleaned_text, NULL AS rejected_line
          FROM (SELECT *, unnest(string_split({TOKEN_TEXT.format("text")}, ' ')) AS mention
                FROM posts WHERE NOT is_broken)
          WHERE regexp_matches(mention, '^@\w')
          UNION ALL SELECT NULL, NULL, {LINE} FROM posts WHERE is_broken""",
        "table_versions": f"""SELECT CAST(ceil({FILES} / 10.0) - 1 AS BIGINT) AS bronze_version
          FROM events""",
        "throughput_of_events": throughput,
        "live_throughput_of_events": throughput,
        "ml_scored_profile": f"""{silver}
          SELECT count(*) AS rows, count(*) AS known_labels, count(*) AS scores_in_range,
            CAST(0 AS BIGINT) AS texts_with_two_predictions FROM silver""",
    }
