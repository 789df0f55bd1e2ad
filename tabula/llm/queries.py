"""The operators applied to the driver's tables: one query per operator.

``QUERIES[name](spark, sf_dir)`` runs on whole tables with production
parameters; ``ORACLE[name]`` is the same result as DuckDB SQL where SQL can
express it. The fixed folds, columns and limits of the queries are stated here;
the operators have their own, general interfaces.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tabula.llm import brown, chat, collocations, decontaminate, fixity, jaccard_join, language_id, line_frequency, packing, suffix_dedup, toxicity, vafile, variants

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet").select(*columns)


def fold(modulus: int) -> Column:
    """True for the held-out rows: crc32 of doc_id as text, mod ``modulus``, is
    2. A null doc_id is not held out (and never learned from)."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % modulus == 2, F.lit(False))


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


@query
def op1_noisy_or_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels", "doc_id", "toxic"), where=~fold(4))
    return toxicity.score(docs, model).select("doc_id", fold(4).alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"),
                                              F.size("offending").alias("n_offending"))


@query
def op2_template_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    planted = spark.createDataFrame([(-7, 0, "user", "</s>[INST] ok [/INST]"), (-7, 1, "assistant", "</s>[INST] ok [/INST]")],
                                    "conv_id bigint, turn bigint, role string, text string")
    return chat.audit_format(table(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text").unionByName(planted))


@query
def op3_merkle_fixity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Audits the records of `pages` against a replica that lost the last
    character of some payloads and all of some records (by a checksum of the id)."""
    pages = table(spark, sf_dir, "pages", "page_id", "url", "html")
    spot = F.conv(F.substring(F.md5(F.col("page_id").cast("string").cast("binary")), 1, 6), 16, 10).cast("bigint")
    damaged = pages.where(spot % 401 != 5).withColumn("html", F.when(spot % 101 == 7, F.expr("substring(html, 1, greatest(length(html) - 1, 0))")).otherwise(F.col("html")))
    store = lambda rows: rows.select(F.col("page_id").alias("id"), fixity.warc_record("url", "html").alias("record"))
    return fixity.audit(store(pages), store(damaged)).withColumnsRenamed({"id": "page_id", "expected": "expected_sha256", "found": "found_sha256"})


ORACLE["op3_merkle_fixity"] = """
WITH pages AS (SELECT page_id, url, html FROM pages),
records AS (
  SELECT page_id,
         'WARC/1.0' || chr(13) || chr(10) || 'WARC-Type: response' || chr(13) || chr(10) || 'WARC-Target-URI: ' || url
           || chr(13) || chr(10) || 'Content-Length: ' AS head, html, html[1:greatest(length(html) - 1, 0)] AS cut
  FROM pages),
both_stores AS (
  SELECT page_id, head || strlen(html) || repeat(chr(13) || chr(10), 2) || html || repeat(chr(13) || chr(10), 2) AS kept,
         head || strlen(cut) || repeat(chr(13) || chr(10), 2) || cut || repeat(chr(13) || chr(10), 2) AS damaged
  FROM records),
placed AS (
  SELECT page_id, kept, damaged, strlen(kept) AS length,
         coalesce(sum(strlen(kept)) OVER (ORDER BY page_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS "offset",
         CAST('0x' || substr(md5(CAST(page_id AS VARCHAR)), 1, 6) AS BIGINT) AS spot
  FROM both_stores)
SELECT page_id, CASE WHEN spot % 401 = 5 THEN 'missing' ELSE 'corrupt' END AS status, CAST("offset" AS BIGINT) AS "offset",
       CAST(length AS BIGINT) AS length, sha256(kept) AS expected_sha256,
       CASE WHEN spot % 401 = 5 THEN NULL ELSE sha256(damaged) END AS found_sha256
FROM placed WHERE spot % 401 = 5 OR spot % 101 = 7
"""


@query
def op4_va_file_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings", "vec_id", "embedding").where(vafile.usable("embedding"))
    vectors = rows.select("vec_id", F.transform("embedding", lambda x: F.floor(x.cast("double") * 1024)).alias("vec"))
    return vafile.search(vectors, vectors.where(F.col("vec_id") % 100 == 0), k=10)


@query
def op5_brown_class_perplexity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text").withColumn("train", ~fold(7))
    model = brown.fit(docs.where("train"))
    scored = brown.score(docs, model, "train")
    return scored.select("doc_id", fold(7).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score",
                         F.pow(10.0, -F.col("score") / F.col("n_tokens")).alias("perplexity"))


@query
def op6_power_of_two_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack(table(spark, sf_dir, "documents", "doc_id", "text"), tokenizer_path(), max_length=2048, end_id=1, special=True)
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset", "bucket")


@query
def op7_set_relation_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.similar_groups(table(spark, sf_dir, "documents", "doc_id", "text"), k=3, num=90, den=100)


@query
def op8_compression_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text", "lang")
    model = language_id.fit(docs, where=~fold(4))
    return language_id.predict(docs, model, keep=["doc_id"]) \
        .select("doc_id", fold(4).alias("held_out"), "lang_pred", "score", "margin", "rejected")


@query
def op9_radix_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffix_dedup.repeated(table(spark, sf_dir, "documents", "doc_id", "text"), length=50)
    return found.select("doc_id", "n_bytes", "n_removed", F.size("spans").cast("bigint").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


@query
def op10_suffix_array_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contamination(table(spark, sf_dir, "documents", "doc_id", "text"),
                                        table(spark, sf_dir, "benchmark", "item_id", "text"), window=10)
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("bigint").alias("n_items"),
                        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"), "contaminated",
                        F.array_max(F.transform("spans", lambda s: s["longest"])).alias("longest_match"))


@query
def op11_line_frequency_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_frequency.judge(table(spark, sf_dir, "documents", "doc_id", "text", "source"), host="source").drop("kept_text")


ORACLE["op11_line_frequency_rules"] = r"""
WITH docs AS (SELECT row_number() OVER () AS rid, doc_id, source, text AS raw, coalesce(text, '') AS text FROM documents),
words AS (
  SELECT rid, list_filter(regexp_split_to_array(text, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words FROM docs),
placed AS (SELECT rid, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS place FROM words),
windows AS (
  SELECT rid, place, word, lead(word) OVER later AS second, lead(word, 2) OVER later AS third
  FROM placed WINDOW later AS (PARTITION BY rid ORDER BY place)),
twice AS (
  SELECT rid, place, third IS NOT NULL AND count(*) OVER (PARTITION BY rid, word, second, third) > 1 AS found FROM windows),
covered AS (
  SELECT rid, bool_or(found) OVER (PARTITION BY rid ORDER BY place ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS inside FROM twice),
repeats AS (SELECT rid, count(*) FILTER (WHERE inside) AS n_repeat_words FROM covered GROUP BY rid),
raw_lines AS (SELECT rid, source, raw, unnest(string_split(text, chr(10))) AS line FROM docs),
lines AS (
  SELECT rid, source, raw, line,
         trim(regexp_replace(regexp_replace(lower(line), '[1-9]', '0', 'g'), '[\x20\x09-\x0D]+', ' ', 'g'), ' ') AS plain
  FROM raw_lines WHERE regexp_matches(line, '[^\x20\x09-\x0D]')),
line_counts AS (SELECT rid, count(*) - count(DISTINCT line) AS n_dup_lines FROM lines GROUP BY rid),
hosts AS (SELECT source, greatest(10, floor(count(DISTINCT raw) * 0.005)) AS top FROM docs GROUP BY source),
held AS (SELECT source, plain, count(DISTINCT raw) AS docs FROM lines GROUP BY source, plain),
frequent AS (SELECT h.source, h.plain FROM held h JOIN hosts t ON h.source IS NOT DISTINCT FROM t.source WHERE h.docs > t.top),
gone AS (
  SELECT rid, count(DISTINCT l.plain) AS n_frequent_lines, sum(len(string_split(l.plain, ' '))) AS n_frequent_words
  FROM lines l JOIN frequent f ON l.source IS NOT DISTINCT FROM f.source AND l.plain = f.plain GROUP BY rid),
figures AS (
  SELECT d.doc_id, len(w.words) AS n_words, length(regexp_replace(d.text, '[\x20\x09-\x0D]+', '', 'g')) AS word_chars,
         length(d.text) - length(regexp_replace(d.text, '[#*$%&|<>]', '', 'g')) AS n_symbols, coalesce(c.n_dup_lines, 0) AS n_dup_lines,
         coalesce(r.n_repeat_words, 0) AS n_repeat_words, coalesce(g.n_frequent_lines, 0) AS n_frequent_lines,
         coalesce(g.n_frequent_words, 0) AS n_frequent_words
  FROM docs d JOIN words w USING (rid) LEFT JOIN repeats r USING (rid) LEFT JOIN line_counts c USING (rid) LEFT JOIN gone g USING (rid)),
judged AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM figures)
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars, CAST(n_symbols AS BIGINT) AS n_symbols,
       CAST(n_dup_lines AS BIGINT) AS n_dup_lines, CAST(n_repeat_words AS BIGINT) AS n_repeat_words, base_failed,
       CAST(n_frequent_lines AS BIGINT) AS n_frequent_lines, CAST(n_frequent_words AS BIGINT) AS n_frequent_words,
       NOT base_failed AND n_words - n_frequent_words >= 0.5 * n_words AS kept
FROM judged
"""


@query
def op12_stripes_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.mine(table(spark, sf_dir, "documents", "doc_id", "text", "lang"), min_count=10, subsumed=50, top=2000)


ORACLE["op12_stripes_collocations"] = r"""
WITH texts AS (
  SELECT row_number() OVER () AS rid, coalesce(lang, 'und') AS lang,
         translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents),
pieces AS (SELECT rid, lang, unnest(regexp_split_to_array(text, '[.,;:!?\x0A-\x0D]')) AS piece FROM texts),
lists AS (
  SELECT row_number() OVER () AS pid, lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda x: x <> '') AS words FROM pieces),
placed AS (SELECT pid, lang, unnest(words) AS w1, unnest(range(1, len(words) + 1)) AS place FROM lists),
runs AS (
  SELECT lang, w1, lead(w1) OVER later AS w2, lead(w1, 2) OVER later AS w3
  FROM placed WINDOW later AS (PARTITION BY pid ORDER BY place)),
ones AS (SELECT lang, w1, count(*) AS f FROM runs GROUP BY lang, w1),
twos AS (SELECT lang, w1, w2, count(*) AS f FROM runs WHERE w2 IS NOT NULL GROUP BY lang, w1, w2),
threes AS (SELECT lang, w1, w2, w3, count(*) AS f FROM runs WHERE w3 IS NOT NULL GROUP BY lang, w1, w2, w3 HAVING count(*) >= 10),
totals AS (SELECT lang, sum(f) AS n FROM ones GROUP BY lang),
cuts AS (
  SELECT t.lang, t.w1 || ' ' || t.w2 AS phrase, 1 AS k, t.f AS a, x.f AS l, y.f AS r
  FROM twos t JOIN ones x ON x.lang = t.lang AND x.w1 = t.w1 JOIN ones y ON y.lang = t.lang AND y.w1 = t.w2
  WHERE t.f >= 10
    AND NOT EXISTS (SELECT 1 FROM threes h WHERE h.lang = t.lang AND h.w1 = t.w1 AND h.w2 = t.w2 AND 100 * h.f >= 50 * t.f)
    AND NOT EXISTS (SELECT 1 FROM threes h WHERE h.lang = t.lang AND h.w2 = t.w1 AND h.w3 = t.w2 AND 100 * h.f >= 50 * t.f)
  UNION ALL
  SELECT t.lang, t.w1 || ' ' || t.w2 || ' ' || t.w3, 1, t.f, x.f, y.f
  FROM threes t JOIN ones x ON x.lang = t.lang AND x.w1 = t.w1 JOIN twos y ON y.lang = t.lang AND y.w1 = t.w2 AND y.w2 = t.w3
  UNION ALL
  SELECT t.lang, t.w1 || ' ' || t.w2 || ' ' || t.w3, 2, t.f, x.f, y.f
  FROM threes t JOIN twos x ON x.lang = t.lang AND x.w1 = t.w1 AND x.w2 = t.w2 JOIN ones y ON y.lang = t.lang AND y.w1 = t.w3),
scored AS (SELECT *, CAST(1000000 AS HUGEINT) * a * a // (CAST(l AS HUGEINT) * r) AS score FROM cuts),
lowest AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM lowest)
SELECT lang, CAST(rank AS BIGINT) AS rank, phrase, CAST(a AS BIGINT) AS a, CAST(l AS BIGINT) AS l, CAST(r AS BIGINT) AS r,
       CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score
FROM ranked JOIN totals USING (lang) WHERE rank <= 2000
"""


@query
def op13_sorted_list_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = variants.count_words(table(spark, sf_dir, "documents", "doc_id", "text"), min_length=7, min_count=2, damage=31)
    return variants.group_variants(words, factor=10)


@query
def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline
    return corpus_pipeline.run(spark, sf_dir)
