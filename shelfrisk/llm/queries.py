"""Registered queries of the training-data operators: each applies its operator to its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfrisk.llm import (bpe, html, importance, jaccard, langid, mixing, neardup, negatives, quality, substring, suffixdup, topk,
                           toxicity)

RANKS = "byte_bpe_multi_50k.tiktoken"
# The test tables name no domain: the last character of a source's name stands for it.
DOMAIN = "right(source, 1)"
WEIGHTS = {"lang": {"en": 3, "de": 2, "fr": 2}}


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_bpe(spark: SparkSession, folder: str) -> DataFrame:
    where = public_tokenizers.path(RANKS), public_tokenizers.PATTERN
    coded = bpe.decode(bpe.encode(_table(spark, folder, "documents"), *where), *where)
    return coded.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op2_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    kept = substring.drop_repeated_passages(_table(spark, folder, "documents"))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


def op3_mix_sources(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents").withColumn("domain", F.expr(DOMAIN))
    return mixing.mix(docs, ["domain", "lang", "source"], WEIGHTS)


def op4_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents")
    return toxicity.score(docs, toxicity.train(docs, _table(spark, folder, "labels")))


def op5_exact_top_k(spark: SparkSession, folder: str) -> DataFrame:
    vectors = _table(spark, folder, "embeddings")
    return topk.top_k(vectors, vectors.filter("vec_id % 20 = 0"))


def op6_language(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents")
    return langid.predict(docs, langid.train(docs.filter(~langid.held_out())))


def op7_main_text(spark: SparkSession, folder: str) -> DataFrame:
    return html.extract(_table(spark, folder, "pages"))


def op8_ngram_jaccard(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard.similar_components(_table(spark, folder, "documents"))


def op9_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    kept = suffixdup.drop_repeated_bytes(_table(spark, folder, "documents"))
    return kept.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op10_embedding_neardup(spark: SparkSession, folder: str) -> DataFrame:
    return neardup.near_duplicates(_table(spark, folder, "embeddings"))


def op11_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    vectors = _table(spark, folder, "embeddings").withColumn("label", label)
    return negatives.mine(vectors, vectors.filter("vec_id % 100 = 0"))


def op12_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    return quality.filter_quality(_table(spark, folder, "documents"), _table(spark, folder, "labels")).drop("failed_rules")


def op13_importance_resampling(spark: SparkSession, folder: str) -> DataFrame:
    return importance.resample(_table(spark, folder, "documents"), _table(spark, folder, "benchmark"))


QUERIES = [op1_bpe, op2_substring_dedup, op3_mix_sources, op4_toxicity, op5_exact_top_k, op6_language, op7_main_text,
           op8_ngram_jaccard, op9_suffix_dedup, op10_embedding_neardup, op11_hard_negatives, op12_quality_rules, op13_importance_resampling]


def _shared(parent: str, path: str, last: str, weight: str, above: str) -> str:
    """Budgets of the children of each node, as SQL: see mixing.leaf_budgets."""
    keys = f"partition by {parent}" if parent else ""
    join = " and ".join(f"n.{c} is not distinct from b.{c}" for c in parent.split(", ")) if parent else "true"
    return f"""(select {path}, least(capacity, max(level) over ({keys}) * weight) as budget from (
      select *, (budget - coalesce(sum(capacity) over ({keys} order by capacity / weight, {last} nulls first rows between unbounded preceding and 1 preceding), 0.0))
        / sum(weight) over ({keys} order by capacity / weight, {last} nulls first rows between current row and unbounded following) as level
      from (select n.*, b.budget from (select {path}, cast(sum(tokens) * 2 as double) as capacity, max({weight}) as weight from leaves group by {path}) n
        join {above} b on {join})))"""


MIX_SQL = f"""
with docs as (select doc_id, right(source, 1) as domain, lang, source,
    coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0) as n_tokens from documents),
  leaves as (select domain, lang, source, sum(n_tokens) as tokens from docs group by all),
  b0 as (select least(cast(sum(tokens) as double), cast(sum(tokens) * 2 as double)) as budget from leaves),
  b1 as {_shared("", "domain", "domain", "cast(1 as double)", "b0")},
  b2 as {_shared("domain", "domain, lang", "lang", "cast(case lang when 'en' then 3 when 'de' then 2 when 'fr' then 2 else 1 end as double)", "b1")},
  b3 as {_shared("domain, lang", "domain, lang, source", "source", "cast(1 as double)", "b2")},
  plan as (select l.*, cast(floor(b.budget + 1e-6) as bigint) as budget from leaves l join b3 b
    on l.domain is not distinct from b.domain and l.lang is not distinct from b.lang and l.source is not distinct from b.source),
  parts as (select *, case when tokens > 0 then cast(floor(budget / tokens) as bigint) else 0 end as whole from plan),
  taken as (select d.*, p.whole, p.budget - p.whole * p.tokens as rest from docs d join parts p
    on d.domain is not distinct from p.domain and d.lang is not distinct from p.lang and d.source is not distinct from p.source),
  running as (select *, sum(n_tokens) over (partition by domain, lang, source
    order by md5(concat('17:', whole, ':', doc_id)), doc_id) as upto from taken)
select doc_id, domain, lang, source, unnest(range(whole)) as epoch, n_tokens from taken where whole > 0
union all
select doc_id, domain, lang, source, whole, n_tokens from running where rest > 0 and upto <= rest
"""

# Every anchor against all rows; the vectors are lists of whole numbers, whose products doubles hold exactly.
NEGATIVES_SQL = """
with v as (select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
    list_transform(embedding, lambda x: floor(256 * x::double)) as x
  from embeddings where label is not null and len(embedding) > 0
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
  scored as (select a.vec_id as anchor_id, b.vec_id, a.label = b.label as same, cast(list_dot_product(a.x, b.x) as bigint) as score
    from v a join v b on a.vec_id % 100 = 0 and a.vec_id <> b.vec_id),
  positives as (select anchor_id, vec_id as positive_id, score as positive_score from scored where same
    qualify row_number() over (partition by anchor_id order by score desc, vec_id) <= 5)
select p.*, s.vec_id as negative_id, s.score as negative_score,
  cast(row_number() over (partition by p.anchor_id, p.positive_id order by s.score desc, s.vec_id) as int) as rank
from positives p join scored s on s.anchor_id = p.anchor_id and not s.same
  and 30 * positive_score <= 100 * s.score and 100 * s.score <= 90 * positive_score
qualify rank <= 10
"""

_RULES = ", ".join(f"{{'rule': {i}, 'part': {r.part}, 'whole': {r.whole}, 'cutoffs': {list(r.cutoffs)}}}" for i, r in enumerate(quality.RULES))
_N_RULES = len(quality.RULES)

# Counts by list functions, the binomial sums term by term.
QUALITY_SQL = f"""
with t as (select doc_id, lang, coalesce(text, '') as text, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') as w,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda l: regexp_matches(l, '[^\\x20\\x09-\\x0D]')) as lines from documents),
  spelled as (select doc_id, unnest(w) as word, generate_subscripts(w, 1) as i from t),
  fives as (select doc_id, i, lead(word, 4) over own as last, concat_ws(' ', word, lead(word) over own, lead(word, 2) over own, lead(word, 3) over own,
      lead(word, 4) over own) as five from spelled window own as (partition by doc_id order by i)),
  windows as (select doc_id, i, count(*) over (partition by doc_id, five) as often from fives where last is not null),
  repeats as (select doc_id, count(distinct i + k) as n from windows, range(0, 5) r(k) where often > 1 group by doc_id),
  base as (select t.doc_id, lang, len(w) as n_words, length(array_to_string(w, '')) as word_chars,
      length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) as n_symbols, length(regexp_replace(text, '[^A-Z]', '', 'g')) as n_capitals,
      length(regexp_replace(text, '[^!?]', '', 'g')) as n_marks, len(list_filter(list_zip(w, w[2:]), lambda z: z[1] = z[2])) as n_stutters,
      len(lines) as n_lines, len(lines) - len(list_distinct(lines)) as n_dup_lines, coalesce(n, 0) as n_repeat_words
    from t left join repeats r on t.doc_id = r.doc_id),
  judged as (select *, n_words < 10 or 100 * n_repeat_words > 20 * n_words as base_failed from base),
  known as (select doc_id, max(quality) > 0 as good from labels where quality is not null group by doc_id having min(quality) = max(quality)),
  tried as (select doc_id, lang, r.rule, i, r.cutoffs[i] as cutoff, 1000 * r.part > r.cutoffs[i] * r.whole as rejects
    from (select doc_id, lang, r, unnest(range(1, len(r.cutoffs) + 1)) as i
      from (select doc_id, lang, unnest([{_RULES}]) as r from judged where not base_failed))),
  tallies as (select lang, rule, i, cutoff, count(*) filter (good) as n, count(*) filter (good and rejects) as x,
      count(*) filter (not good and rejects) as caught from tried join known using (doc_id) group by all),
  tested as (select *, n > 0 and x < n * 0.05::double / {_N_RULES} and list_sum(list_transform(range(0, x + 1), lambda k:
      exp(lgamma(n + 1) - lgamma(k + 1) - lgamma(n - k + 1) + k * ln(0.05::double / {_N_RULES}) + (n - k) * ln(1 - 0.05::double / {_N_RULES}))))
      <= 0.05::double / ({_N_RULES} * (select count(*) from (select distinct lang from tallies))) as holds from tallies),
  certain as (select *, bool_and(holds) over (partition by lang, rule order by i) as sure from tested),
  chosen as (select lang, rule, i from certain where sure and caught > x
    qualify row_number() over (partition by lang, rule order by caught - x desc, i) = 1),
  failed as (select distinct t.doc_id from tried t join chosen c on t.lang is not distinct from c.lang and t.rule = c.rule and t.i = c.i where rejects)
select j.* exclude (lang), not base_failed and f.doc_id is null as kept from judged j left join failed f on j.doc_id = f.doc_id
"""

# The table of crc32 for one byte is made from its rule; a checksum runs over the hex digits of each different feature.
RESAMPLE_SQL = """
with sums as (select list(list_reduce([i] || range(8), lambda c, k: case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end) order by i) as t
    from range(256) r(i)),
  words as (select kind, id, regexp_extract_all(lower_az, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') as w
    from (select kind, id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as lower_az
      from (select 'd' as kind, doc_id as id, text from documents union all select 'b', item_id, text from benchmark))),
  features as (select kind, id, unnest(w || list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) as feature from words),
  numbers as (select feature, xor(list_reduce([4294967295] || list_transform(range(0, octet_length(encode(feature))), lambda i:
      cast('0x' || substr(hex(encode(feature)), 2 * i + 1, 2) as bigint)), lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) % 10000 as bucket
    from (select distinct feature from features), sums),
  counted as (select kind, id, bucket, count(*) as n from features join numbers using (feature) group by all),
  shares as (select bucket, coalesce(sum(n) filter (kind = 'd'), 0)::double as s, coalesce(sum(n) filter (kind = 'b'), 0)::double as t from counted group by bucket),
  wholes as (select coalesce(sum(s), 0) as ss, coalesce(sum(t), 0) as tt from shares),
  gains as (select bucket, cast(floor(1000 * ln((t + 1) * (ss + 10000) / ((s + 1) * (tt + 10000)))) as bigint) as gain from shares, wholes),
  weights as (select id, sum(n) as n_features, cast(floor(sum(n * gain)::double / sum(n)) as bigint) as weight
    from counted join gains using (bucket) where kind = 'd' group by id),
  scored as (select id as doc_id, coalesce(n_features, 0)::bigint as n_features, coalesce(weight, 0) as weight, len(w) >= 20 as able,
      coalesce(weight, 0) + cast(floor(-1000 * ln(-ln((cast('0x' || substr(sha256('7:' || id), 1, 8) as bigint) + 0.5::double) / 4294967296))) as bigint) as score
    from words left join weights using (id) where kind = 'd'),
  placed as (select *, row_number() over (partition by able order by score desc, doc_id) as place from scored)
select doc_id, n_features, weight, score,
  case when able and place <= (select 25 * count(*) // 100 from scored where able) then place end as rank from placed
"""

ORACLE_SQL = {"op3_mix_sources": MIX_SQL, "op11_hard_negatives": NEGATIVES_SQL, "op12_quality_rules": QUALITY_SQL,
              "op13_importance_resampling": RESAMPLE_SQL}
