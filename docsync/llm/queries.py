"""The registered queries of the training-data operators, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docsync.llm import ann, bpe, chat, exact_dedup, fim, html_extract, langid, minhash, mixing, packing, periodic, ppm, suffix_dedup
from docsync.llm.common import bucket_of


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = bucket_of("doc_id", 4) == 2
    found = langid.detect(docs, langid.learn_profiles(docs.filter(~held_out)))
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(table(spark, sf_dir, "documents"))


def op3_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract_main_text(table(spark, sf_dir, "pages"))


def op4_ppm(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = bucket_of("doc_id", 7) == 2
    found = ppm.score(docs, ~held_out)
    return found.select("doc_id", held_out.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op5_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.bpe_digests(table(spark, sf_dir, "documents"), tokenizer_path())


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixing_plan(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op7_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove_repeats(table(spark, sf_dir, "documents"), keep_text=False)


def op8_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


def op9_minhash_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"), percent=85)


def op10_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.maximal_conversations(table(spark, sf_dir, "conversations")).select("conv_id", "n_turns", "n_copies", "rendered")


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs in documents of which one in ten has been made to repeat a group of its words from some word on."""
    docs = table(spark, sf_dir, "documents")
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    g, made = F.floor(h / 10), h % 10 == 0
    n = F.when(made, F.regexp_count("text", F.lit(periodic.WORD))).cast("long")
    start = F.when(n > 0, g % n)
    period = 1 + F.floor((n - start) / (3 + g % 8))
    # only the texts to be changed go through the function
    changed = periodic.cycled(F.when(n > 0, F.col("text")), start, period)
    rows = docs.withColumn("text", F.coalesce(changed, "text"))
    found = periodic.detect(rows.select("doc_id", "text")).withColumn("best", periodic.longest_run(F.col("runs")))
    length, by = F.col("best.length"), F.col("best.period")
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), F.col("best.start").alias("start"), length.alias("length"), by.alias("period"),
        F.floor(length * 1000 / by).cast("long").alias("exponent_milli"), F.sha2(periodic.listed(F.col("runs")), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = fim.fill_in_middle(table(spark, sf_dir, "documents")).withColumn("restored", fim.restored(F.col("form"), F.col("output")))
    return made.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"), F.sha2("restored", 256).alias("restored_sha256"))


def op13_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer_path("word_bpe_49k.json"), keep_ids=False)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_language_id": op1_language_id,
        "op2_exact_dedup": op2_exact_dedup,
        "op3_html_extract": op3_html_extract,
        "op4_ppm": op4_ppm,
        "op5_bpe": op5_bpe,
        "op6_mixing": op6_mixing,
        "op7_suffix_dedup": op7_suffix_dedup,
        "op8_ann": op8_ann,
        "op9_minhash_forest": op9_minhash_forest,
        "op10_chat_format": op10_chat_format,
        "op11_periodic_runs": op11_periodic_runs,
        "op12_fill_in_middle": op12_fill_in_middle,
        "op13_packing": op13_packing,
    }


OP2_SQL = """
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id IS NOT DISTINCT FROM max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))
"""

OP6_SQL = r"""
WITH sized AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size FROM documents
), totals AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         [3, 1, 2][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3] AS weight
  FROM sized GROUP BY source
), levels AS (
  SELECT *, 2.0::DOUBLE * source_size AS room,
         (1.5::DOUBLE * sum(source_size) OVER () - 2.0::DOUBLE * coalesce(sum(source_size) OVER (
            ORDER BY 2.0::DOUBLE * source_size / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
         / sum(weight) OVER (ORDER BY 2.0::DOUBLE * source_size / weight, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM totals
), targets AS (
  SELECT source, source_size,
         least(room, coalesce((max(level) FILTER (WHERE level * weight <= room) OVER ()) * weight, room)) AS target
  FROM levels
), rated AS (
  SELECT source, source_size, target, rate FROM (
    SELECT *, CASE WHEN source_size > 0 THEN target / source_size ELSE 0.0::DOUBLE END AS rate FROM targets)
), drawn AS (
  SELECT doc_id, source, size, ('0x' || substr(md5('mix:' || coalesce(doc_id::VARCHAR, '')), 1, 13))::BIGINT AS draw,
         length(bin(size)) * 16 + list_reduce([0] || list_transform(string_split(rpad(substr(bin(size), 1, 4), 4, '0'), ''), lambda x: x::INT), lambda a, x: 2 * a + x) AS class
  FROM sized
), counted AS (
  SELECT source, class, draw >> 40 AS bin, count(*)::BIGINT AS n FROM drawn GROUP BY 1, 2, 3
), binned AS (
  SELECT *, coalesce(sum(n) OVER (PARTITION BY source, class ORDER BY bin ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS before,
         coalesce(sum(n) OVER (PARTITION BY source ORDER BY class RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 0)::BIGINT AS upto,
         (sum(n) OVER (PARTITION BY source, class))::BIGINT AS of_class
  FROM counted
), wanting AS (
  SELECT b.*, floor((rate - floor(rate)) * upto + start)::BIGINT - floor((rate - floor(rate)) * (upto - of_class) + start)::BIGINT AS wanted
  FROM binned b JOIN (
    SELECT source, rate, ('0x' || substr(md5('mix:start:' || coalesce('=' || source, '')), 1, 13))::BIGINT / 4503599627370496.0::DOUBLE AS start FROM rated
  ) r ON b.source IS NOT DISTINCT FROM r.source
), bounds AS (
  SELECT source, class, bin * 1099511627776 + ceil((wanted - before) * 1099511627776.0::DOUBLE / n)::BIGINT AS bound FROM wanting WHERE before < wanted AND wanted <= before + n
)
SELECT doc_id, size, source_size, target, size * (floor(rate)::BIGINT + CASE WHEN draw < coalesce(bound, 0) THEN 1 ELSE 0 END) AS taken
FROM drawn d JOIN rated r ON d.source IS NOT DISTINCT FROM r.source LEFT JOIN bounds b ON d.source IS NOT DISTINCT FROM b.source AND d.class = b.class
"""

OP12_SQL = r"""
WITH drawn AS (
  SELECT doc_id, coalesce(text, '') AS body, sha256('42:' || coalesce(doc_id::VARCHAR, '')) AS digest,
         regexp_extract_all(coalesce(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS tokens
  FROM documents
), placed AS (
  SELECT doc_id, body, tokens, len(tokens) AS n, ('0x' || digest[1:8])::BIGINT % (len(tokens) + 1) AS one, ('0x' || digest[9:16])::BIGINT % (len(tokens) + 1) AS other,
         CASE WHEN body = '' OR contains(body, '<P>') OR contains(body, '<S>') OR contains(body, '<M>') OR ('0x' || digest[17:24])::BIGINT % 100 >= 50 THEN 'plain'
              WHEN ('0x' || digest[25:32])::BIGINT % 100 < 80 THEN 'spm' ELSE 'psm' END AS form
  FROM drawn
), cut AS (
  SELECT doc_id, body, n, form, array_to_string(tokens[1:least(one, other)], '') AS p, array_to_string(tokens[least(one, other) + 1:greatest(one, other)], '') AS m,
         array_to_string(tokens[greatest(one, other) + 1:], '') AS s
  FROM placed
)
SELECT doc_id, n::BIGINT AS n, form, CASE WHEN form <> 'plain' THEN length(p) END::BIGINT AS prefix_chars, CASE WHEN form <> 'plain' THEN length(m) END::BIGINT AS middle_chars,
       sha256(CASE form WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m WHEN 'spm' THEN '<S>' || s || '<P>' || p || '<M>' || m ELSE body END) AS output_sha256,
       sha256(body) AS restored_sha256
FROM cut
"""

OP10_SQL = r"""
WITH turns AS (
  SELECT conv_id, turn, role, text, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST) AS k
  FROM conversations WHERE conv_id IS NOT NULL
), convs AS (
  SELECT conv_id, count(*) AS n_turns, list(struct_pack(r := role, t := text) ORDER BY k) AS body,
         string_agg('<|' || coalesce(role, 'user') || '|>' || chr(10) || coalesce(text, '') || '<|end|>' || chr(10), '' ORDER BY k) AS rendered
  FROM turns GROUP BY conv_id
), copies AS (
  SELECT min(conv_id) AS conv_id, count(*) AS n_copies, body, any_value(n_turns) AS n_turns, any_value(rendered) AS rendered FROM convs GROUP BY body
), prefixes AS (
  SELECT DISTINCT body[1:i] AS body FROM (SELECT body, unnest(range(1, n_turns)) AS i FROM copies)
)
SELECT conv_id, n_turns, n_copies, rendered FROM copies ANTI JOIN prefixes ON copies.body = prefixes.body
"""


def oracle_sql() -> dict[str, str]:
    return {"op2_exact_dedup": OP2_SQL, "op6_mixing": OP6_SQL, "op10_chat_format": OP10_SQL, "op12_fill_in_middle": OP12_SQL}
