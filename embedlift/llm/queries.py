"""One registered query per operator of this package, on the whole given tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from embedlift.llm import bpe, decontaminate, lines, ordermin, periods, personal, pseudolm, quality, repair, runindex, secrets, tokencount, warc
from embedlift.llm.base import QUERIES, register, table
from embedlift.workspace import scratch_path

__all__ = ["QUERIES"]


def tokenizer_path(name: str) -> str:
    """Where a public tokenizer file lies on this machine; the same on every executor."""
    import public_tokenizers

    return public_tokenizers.path(name)


OP6_SQL = r"""
with w as (
  select doc_id, coalesce(text, '') as text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as words from documents
), lines as (
  select doc_id, i, line, row_number() over (partition by doc_id, line order by i) as k
  from (select doc_id, unnest(string_split(text, chr(10))) as line, generate_subscripts(string_split(text, chr(10)), 1) as i from w)
  where regexp_matches(line, '[^\x20\x09-\x0D]')
), line_stats as (
  select doc_id, count(*) as n_lines, count(*) filter (where k > 1) as n_dup_lines from lines group by doc_id
), tokens as (
  select doc_id, unnest(words) as word, generate_subscripts(words, 1) as i from w
), windows as (
  select doc_id, i, word, lead(word, 1) over d as b, lead(word, 2) over d as c from tokens window d as (partition by doc_id order by i)
), again as (
  select doc_id, i, count(*) over (partition by doc_id, word, b, c) as n from windows where c is not null
), covered as (
  select doc_id, count(*) as n_repeat_words from (
    select distinct doc_id, i + s as i from again, (values (0), (1), (2)) as t(s) where n > 1) group by doc_id
), word_stats as (
  select doc_id, count(*) as n_words, sum(length(word)) as word_chars,
         count(*) filter (where regexp_full_match(regexp_replace(word, '^[-.,;:!?''"()\[\]]+|[-.,;:!?''"()\[\]]+$', '', 'g'), '[\p{L}]+')) as n_alpha_words
  from tokens group by doc_id
), m as (
  select w.doc_id, coalesce(n_words, 0) as n_words, coalesce(word_chars, 0)::bigint as word_chars,
         length(w.text) - length(regexp_replace(w.text, '[#*$%&|<>]', '', 'g')) as n_symbols,
         coalesce(n_lines, 0) as n_lines, coalesce(n_dup_lines, 0) as n_dup_lines, coalesce(n_repeat_words, 0) as n_repeat_words,
         coalesce(n_alpha_words, 0) as n_alpha_words
  from w left join line_stats using (doc_id) left join covered using (doc_id) left join word_stats using (doc_id)
)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       n_words < 50 or 100 * n_repeat_words > 50 * n_words as base_failed,
       not (n_words < 50 or 100 * n_repeat_words > 50 * n_words or 10 * n_symbols > n_words
            or (n_words > 0 and word_chars < 3 * n_words) or word_chars > 10 * n_words or 100 * n_dup_lines > 50 * n_lines
            or 100 * n_alpha_words < 70 * n_words) as kept
from m
"""


@register("op4_repeated_passages")
def op4_repeated_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = runindex.repeats(table(spark, sf_dir, "documents"))
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["begin"])
    return found.select("doc_id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


@register("op5_pseudo_likelihood")
def op5_pseudo_likelihood(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = pseudolm.scored_by_itself(docs)
    return found.select("doc_id", "n_words", F.round("score", 3).alias("score"), F.round("mean_score", 6).alias("mean_score"))


@register("op6_quality_rules", OP6_SQL)
def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = quality.ledger(docs).withColumn("kept", quality.accepts("v2")).withColumn("base_failed", ~quality.accepts("v1"))
    return found.select("doc_id", *[f"quality.{c}" for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")], "base_failed", "kept")


@register("op1_benchmark_leaks")
def op1_benchmark_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@register("op2_secret_scan")
def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.scan(table(spark, sf_dir, "documents"), secrets.labelled_findings(spark))
    return found.select("doc_id", "at", "kind", F.sha2("value", 256).alias("value_sha256"), "score", "is_secret")


@register("op3_fuzzy_line_dedup")
def op3_fuzzy_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return lines.deduplicated(docs).select("doc_id", F.col("n_removed_lines").cast("long").alias("n_removed_lines"),
                                           F.length("text").cast("long").alias("n_chars_kept"), F.sha2("text", 256).alias("kept_sha256"))


@register("op7_bpe_codec")
def op7_bpe_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = tokenizer_path("word_bpe_49k.json")
    texts = bpe.decoded(bpe.encoded(table(spark, sf_dir, "documents"), path), path)
    return texts.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(F.array_join("ids", " "), 256).alias("ids_sha256"),
                        F.sha2("decoded", 256).alias("decoded_sha256"))


@register("op8_token_counts")
def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = tokencount.prefix_counts(table(spark, sf_dir, "documents"), tokenizer_path("piece_bpe_32k.model"))
    return counts.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > 4096).alias("over_limit"))


@register("op9_order_minhash")
def op9_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ordermin.near_duplicates(table(spark, sf_dir, "documents"))


@register("op10_warc_reassembly", """
with p as (select page_id, coalesce(html, '') as body from pages),
q as (select page_id, octet_length(encode(body)) as payload_bytes, sha256(body) as payload_digest from p),
f as (select *, min(page_id) over (partition by payload_digest) as first from q)
select page_id, payload_bytes, payload_digest,
       case when payload_bytes >= 100 and page_id <> first then 'revisit' else 'response' end as record_type,
       case when payload_bytes >= 100 and page_id <> first then first end as refers_to
from f
""")
def op10_warc_reassembly(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "warc")
    warc.write_archives(table(spark, sf_dir, "pages"), path)
    pages = warc.read_pages(spark, path)
    checked = F.when(F.col("problem").isNull(), F.col("payload_bytes")).otherwise(F.raise_error(F.concat(F.lit("page "), F.col("page_id").cast("string"), F.lit(": "), F.col("problem"))).cast("long"))
    return pages.select("page_id", checked.alias("payload_bytes"), "payload_digest", "record_type", "refers_to")


@register("op12_periodic_runs")
def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = periods.with_known_periods(table(spark, sf_dir, "documents").select("doc_id", "text"))
    found = periods.with_runs(docs).withColumn("best", periods.first_strongest(F.col("periodic.runs")))
    lines_of = F.transform("periodic.runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return found.select("doc_id", F.size("periodic.runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
                        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
                        F.sha2(F.array_join(lines_of, ""), 256).alias("runs_sha256"), F.sha2("periodic.collapsed", 256).alias("collapsed_sha256"))


@register("op11_turn_repair")
def op11_turn_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    planned, kept = repair.repair(repair.damaged(given))
    all_ids = given.select(F.col("conv_id").alias("id")).distinct()
    found = all_ids.join(planned, F.col("id").eqNullSafe(F.col("conv_id")), "left").drop("conv_id")
    found = found.join(repair.digests(kept), F.col("id").eqNullSafe(F.col("conv_id")), "left")
    numbers = [F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return found.select(F.col("id").alias("conv_id"), *numbers, F.coalesce("audit", F.lit("")).alias("audit"),
                        F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"))


@register("op13_personal_data")
def op13_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = personal.with_personal_data(docs, personal.train(docs))

    def counted(kind: str) -> Column:
        return F.size(F.filter("personal.base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    def listed(spans: str) -> Column:
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    return found.select("doc_id", *map(counted, personal.KINDS), F.sha2(listed("personal.base"), 256).alias("base_sha256"), listed("personal.spans").alias("spans"))
