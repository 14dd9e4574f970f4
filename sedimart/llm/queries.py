"""Registered queries of the training-data operators, next to their SQL where SQL can express them."""

from __future__ import annotations

import uuid
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from sedimart.llm import ann, bytebpe, jaccard, langid, lm, packing, periodic, quality, resample, sharding, suffixes, urls, warc
from sedimart.session import shared_folder
from sedimart.sources.landing import read_table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(build: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[build.__name__] = build
    return build


@query
def op1_recurrent_language(spark: SparkSession, folder: str) -> DataFrame:
    documents = read_table(spark, folder, "documents")
    return langid.predict_language(documents, langid.learn(documents))


@query
def op2_risk_controlled_rules(spark: SparkSession, folder: str) -> DataFrame:
    return quality.judge_quality(read_table(spark, folder, "documents"), read_table(spark, folder, "labels"))


_CUTOFFS = ", ".join(f"('{m}', {j}, {c!r}::double)" for m, steps in quality.CUTOFFS.items() for j, c in enumerate(steps))
_MEASURES = ", ".join(quality.CUTOFFS)
_RISK, _LIMIT = quality.RISK / len(quality.CUTOFFS), f"{quality.FAILURE!r} / (strata * {sum(map(len, quality.CUTOFFS.values()))})"

ORACLES["op2_risk_controlled_rules"] = rf"""
with texts as (
  select row_number() over () as row, doc_id, lang, coalesce(text, '') as text from documents
), cut as (
  select row, doc_id, lang, list_filter(regexp_split_to_array(text, '[\x20\x09-\x0D]+'), lambda x: x <> '') as words,
         list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) as lines,
         regexp_replace(text, '[^A-Z]', '', 'g') as upper, regexp_replace(text, '[^#*$%&|<>]', '', 'g') as symbols, regexp_replace(text, '[^!]', '', 'g') as exclaims
  from texts
), tokens as (
  select row, unnest(words) as w, generate_subscripts(words, 1) as i from cut
), triples as (
  select row, i, w, lead(w, 1) over own as x, lead(w, 2) over own as y from tokens window own as (partition by row order by i)
), windows as (
  select row, i, count(*) over (partition by row, w, x, y) as times from triples where y is not null
), repeated as (
  select row, count(distinct i + d) as n from windows, (values (0), (1), (2)) as t(d) where times > 1 group by row
), counted as (
  select row, doc_id, lang, len(words) as n_words, length(array_to_string(words, '')) as word_chars, length(symbols) as n_symbols,
         len(lines) - len(list_distinct(lines)) as n_dup_lines, coalesce(n, 0) as n_repeat_words,
         len(lines) as n_lines, length(exclaims) as n_exclaim, length(upper) as n_upper
  from cut left join repeated using (row)
), measured as (
  select *, case when n_words > 0 then n_symbols / n_words else 0 end::double as symbol_ratio,
         case when n_words > 0 then n_exclaim / n_words else 0 end::double as exclaim_ratio,
         case when word_chars > 0 then n_upper / word_chars else 0 end::double as upper_ratio,
         case when n_lines > 0 then n_dup_lines / n_lines else 0 end::double as dup_line_ratio,
         case when n_words > 0 then n_repeat_words / n_words else 0 end::double as repeat_ratio,
         case when n_words > 0 then word_chars / n_words else 0 end::double as word_length
  from counted
), long as (
  unpivot (select row, doc_id, lang, {_MEASURES} from measured) on {_MEASURES} into name measure value value
), label as (
  select doc_id, max(quality) as quality from labels where quality is not null and doc_id in (select doc_id from documents group by doc_id having count(*) = 1) group by doc_id
), cutoffs(measure, step, cutoff) as (
  values {_CUTOFFS}
), tests as (
  select lang, measure, step, cutoff, count(*) filter (quality > 0) as n, count(*) filter (quality > 0 and value > cutoff) as k,
         count(*) filter (quality <= 0 and value > cutoff) as caught
  from long join label using (doc_id) join cutoffs using (measure) group by all
), tails as (
  select *, (select sum(exp(lgamma(n + 1) - lgamma(i + 1) - lgamma(n - i + 1) + i * ln({_RISK!r}) + (n - i) * ln(1 - {_RISK!r})))
             from (select unnest(generate_series(0::bigint, k)) as i)) as chance,
         (select count(distinct coalesce(lang, '')) from tests) as strata
  from tests where n > 0
), chosen as (
  select lang, measure, arg_max(cutoff, caught * 1000 - step) as cutoff from tails where k < n * {_RISK!r} and chance <= {_LIMIT} group by all
), failed as (
  select distinct row from long join chosen on long.measure = chosen.measure and long.lang is not distinct from chosen.lang and value > cutoff
)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       n_words < 50 or 100 * n_repeat_words > 50 * n_words as base_failed,
       not (n_words < 50 or 100 * n_repeat_words > 50 * n_words) and failed.row is null as kept
from measured left join failed using (row)
"""


@query
def op3_collision_counting(spark: SparkSession, folder: str) -> DataFrame:
    return ann.nearest(read_table(spark, folder, "embeddings"), F.col("vec_id") % 20 == 0)


@query
def op4_best_two_fit(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack_documents(read_table(spark, folder, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


URL_RULES = [("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/")]


@query
def op5_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    return urls.filter_urls(read_table(spark, folder, "pages"), urls.rules_frame(spark, URL_RULES))


ORACLES["op5_url_filter"] = r"""
with cut as (
  select page_id, case when instr(url, '://') > 0 then substr(url, instr(url, '://') + 3) else '' end as rest from pages
), urls as (
  select row_number() over () as n, page_id,
         translate(regexp_extract(rest, '^[^/?#]*', 0), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) as path
  from cut
), rules(action, rule_host, rule_path) as (
  values ('block', 'net', '/'), ('allow', 'example.net', '/en/'), ('block', 'example.com', '/de/'), ('allow', 'org', '/fr/')
), fitting as (
  select n, arg_max(rule_host || rule_path, length(rule_host || rule_path)) as rule, arg_max(action, length(rule_host || rule_path)) as action
  from urls join rules on (host = rule_host or ends_with(host, '.' || rule_host)) and starts_with(path, rule_path)
  group by n
)
select page_id, host, path, rule, coalesce(action, 'allow') as verdict from urls left join fitting using (n)
"""


@query
def op6_rendezvous(spark: SparkSession, folder: str) -> DataFrame:
    return sharding.assign_shards(read_table(spark, folder, "documents"))


@query
def op7_log_bilinear(spark: SparkSession, folder: str) -> DataFrame:
    return lm.score_documents(read_table(spark, folder, "documents"))


@query
def op8_multiple_orders(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard.link_groups(read_table(spark, folder, "documents"))


@query
def op9_sparse_suffixes(spark: SparkSession, folder: str) -> DataFrame:
    return suffixes.repeated_passages(read_table(spark, folder, "documents")).drop("doc")


@query
def op10_chunked_bpe(spark: SparkSession, folder: str) -> DataFrame:
    documents = read_table(spark, folder, "documents")
    return bytebpe.encode_documents(documents, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


@query
def op11_median_cutoff_resampling(spark: SparkSession, folder: str) -> DataFrame:
    return resample.resample(read_table(spark, folder, "documents"), read_table(spark, folder, "benchmark"))


@query
def op13_difference_cover_runs(spark: SparkSession, folder: str) -> DataFrame:
    """Every tenth id's words are first made to repeat with a period that follows from the id's CRC-32."""
    documents = read_table(spark, folder, "documents")
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    words = F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda w: w != "")
    cut = documents.select("doc_id", "text", h.alias("h"), F.floor(h / 10).alias("g"), F.when(h % 10 == 0, words).alias("words"))
    n = F.size("words")
    cut = cut.withColumn("a", F.when(n > 0, F.col("g") % n).cast("int"))
    cut = cut.withColumn("p", (1 + F.floor((n - F.col("a")) / (3 + F.col("g") % 8))).cast("int"))
    again = lambda i: F.when(i < F.col("a"), i).otherwise(F.col("a") + (i - F.col("a")) % F.col("p"))
    made = F.array_join(F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.get("words", again(i))), " ")
    text = F.when(F.col("a").isNotNull(), made).otherwise(F.col("text"))
    found = periodic.periodic_runs(cut, "doc_id", text)
    longest = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    lines = F.concat_ws("", F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], F.concat(r["period"].cast("string"), F.lit("\n")))))
    best = found.withColumn("best", longest).withColumn("length", F.col("best.length")).withColumn("period", -F.col("best.period"))
    return best.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), (-F.col("best.start")).alias("start"), "length", "period",
        F.floor(1000 * F.col("length") / F.col("period")).cast("long").alias("exponent_milli"),
        F.sha2(lines, 256).alias("runs_sha256"), F.sha2(F.col("collapsed"), 256).alias("collapsed_sha256"),
    )


@query
def op12_warc_segments(spark: SparkSession, folder: str) -> DataFrame:
    archives = warc.write_archives(read_table(spark, folder, "pages"), f"{shared_folder(spark)}/warc-{uuid.uuid4().hex}")
    return warc.read_pages(spark, archives, whole=False).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


ORACLES["op12_warc_segments"] = """
with payloads as (
  select row_number() over () as row, page_id, strlen(coalesce(html, '')) as payload_bytes, sha256(coalesce(html, '')) as payload_digest from pages
), placed as (
  select *, row_number() over same as place, first_value(page_id) over same as owner
  from payloads window same as (partition by payload_digest order by page_id nulls last, row)
)
select page_id, payload_bytes, payload_digest, case when payload_bytes >= 100 and place > 1 then 'revisit' else 'response' end as record_type,
       case when payload_bytes >= 100 and place > 1 then owner end as refers_to
from placed
"""
