"""The queries op1 to op13 on the given tables, and SQL where it can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from icegrid.llm import (
    bpe,
    decontaminate,
    embedding_dedup,
    hard_negatives,
    language,
    lexical,
    license_scan,
    minhash,
    pii,
    quality,
    sharding,
    toxicity,
    urls,
)
from icegrid.llm.text import tune_texts

SHARDS = 40
VOCABULARY = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
# The list of op9: pages of these host families, and link farms, whose html has more than LINKS
# links for each paragraph.
LISTED_HOSTS = r"(^|\.)(spam-farm|cheap-pills|free-bets|casino-win|ads-track|adult-x)\."
LINKS = 3


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return tune_texts(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = docs.select("doc_id", license_scan.scan_licenses(F.col("text")).alias("l"))
    return found.select("doc_id", "l.*")


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.site_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op3_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_vectors(table(spark, sf_dir, "embeddings"), 0.98)


def op4_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    classes = minhash.near_duplicates(table(spark, sf_dir, "documents"), 0.85)
    return classes.select("doc_id", "n_shingles", "component_id", "kept")


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontaminate.find_leaks(docs, table(spark, sf_dir, "benchmark"))
    found = found.select("row.doc_id", F.col("leak").alias("l"))
    return found.select(
        "doc_id", "l.n_words", "l.n_hit", F.size("l.items").cast("long").alias("n_items"),
        decontaminate.items_digest(F.col("l.items")).alias("items_sha256"),
        (F.col("l.n_hit") > 0).alias("contaminated"),
    )


def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.assign_shards(table(spark, sf_dir, "documents"), SHARDS).drop("group")


def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = docs.select("doc_id", pii.find_spans(F.col("text"), pii.fit(docs)).alias("f"))
    return found.select(
        "doc_id",
        *[F.size(f"f.{k}.base").cast("long").alias(f"n_{k}") for k in pii.KINDS],
        F.sha2(pii.spans_text(F.col("f"), "base"), 256).alias("base_sha256"),
        pii.spans_text(F.col("f"), "all").alias("spans"),
    )


def op8_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held = language.held_out(F.col("doc_id"))
    model = language.fit(docs.where(~held))
    found = docs.select("doc_id", held.alias("held_out"),
                        language.identify(F.col("text"), model, spark).alias("l"))
    return found.select("doc_id", "held_out", "l.lang_pred", "l.score")


def op9_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    links, paragraphs = (F.size(F.split("html", mark)) - 1 for mark in ("<a ", "<p>"))
    farm = F.coalesce(links > LINKS * paragraphs, F.lit(False))
    bad_host = urls.host_of(F.col("url")).rlike(LISTED_HOSTS)
    return urls.judge(pages.select("page_id", "url"), pages.where(bad_host | farm).select("url"))


def op10_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    tokens = bpe.read_ranks(VOCABULARY)
    both = bpe.encode_and_back(F.col("text"), tokens, public_tokenizers.PATTERN, spark)
    rows = docs.select("doc_id", both.alias("b"))
    rows = rows.select("doc_id", "b.ids", F.col("b.back").alias("decoded"))
    joined = F.array_join(F.col("ids").cast("array<string>"), ",")
    return rows.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(joined, 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op11_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    labels = table(spark, sf_dir, "labels")
    held = language.held_out(F.col("doc_id"))
    model = toxicity.fit(docs, labels.where(~held))
    found = docs.select("doc_id", held.alias("held_out"),
                        toxicity.score(F.col("text"), model, spark).alias("t"))
    return found.select("doc_id", "held_out", "t.score",
                        (F.col("t.score") >= toxicity.THRESHOLD).cast("int").alias("predicted"),
                        F.size("t.spans").cast("long").alias("n_sentences"))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(vectors.withColumn("label", label), F.col("vec_id") % 100 == 0)


def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), 10)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (op1_license_scan, op2_quality, op3_embedding_dedup, op4_minhash_dedup,
              op5_decontamination, op6_sharding, op7_pii, op8_language, op9_url_filter, op10_bpe,
              op11_toxicity, op12_hard_negatives, op13_lexical_search)
}

_LOWER = "translate(coalesce({}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
# links a, b between names make components: the smallest name that is reachable
_REACH = """
  both_ as (select a x, b y from links union select b, a from links),
  reach(x, y) as (select x, y from both_ union select r.x, l.y from reach r join both_ l on r.y = l.x),
  root as (select x, least(x, min(y)) r from reach group by x)"""

SQL: dict[str, str] = {
    "op3_embedding_dedup": rf"""
with recursive v as (
  select vec_id, label, embedding::double[] e, embedding from embeddings
  where label is not null and len(embedding) > 0
    and len(list_filter(embedding, lambda x: x is null or isnan(x) or isinf(x))) = 0
    and len(list_filter(embedding, lambda x: x <> 0)) > 0),
  nodes as (select label, e, min(vec_id) id, count(*) copies from v group by label, e),
  links as (
    select a.id a, b.id b, b.copies from nodes a join nodes b
      on a.label = b.label and len(a.e) = len(b.e) and a.id <> b.id
    where list_cosine_similarity(a.e, b.e) >= 0.98),
  counts as (select a, sum(copies) n from links group by a), {_REACH}
select t.vec_id, cast(coalesce(n.copies - 1 + coalesce(c.n, 0), 0) as bigint) n_links,
  coalesce(r.r, n.id, t.vec_id) component_id, t.vec_id = coalesce(r.r, n.id, t.vec_id) kept
from embeddings t left join v on v.vec_id = t.vec_id
  left join nodes n on n.label = v.label and n.e = v.e
  left join counts c on c.a = n.id left join root r on r.x = n.id""",
    "op4_minhash_dedup": rf"""
with recursive w as (
  select doc_id, regexp_extract_all({_LOWER.format("text")}, '[^\x20\x09-\x0D]+') w from documents),
  s as (select doc_id, list_sort(list_distinct(case
      when len(w) >= 5 then list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))
      when len(w) > 0 then [array_to_string(w, ' ')] else [] end)) s from w),
  named as (select doc_id, len(s) n, case when len(s) > 0 then md5(array_to_string(s, '|')) end k, s from s),
  sets as (select min(doc_id) id, k, any_value(n) n, any_value(s) s from named where k is not null group by k),
  flat as (select id, n, unnest(s) g from sets),
  links as (
    select a.id a, b.id b from flat a join flat b on a.g = b.g and a.id <> b.id
      and 100 * least(a.n, b.n) >= 85 * greatest(a.n, b.n)
    group by a.id, b.id, a.n, b.n having 100 * count(*) >= 85 * (a.n + b.n - count(*))), {_REACH}
select d.doc_id, cast(d.n as bigint) n_shingles, coalesce(r.r, s.id, d.doc_id) component_id,
  d.doc_id = coalesce(r.r, s.id, d.doc_id) kept
from named d left join sets s on s.k = d.k left join root r on r.x = s.id""",
    "op5_decontamination": rf"""
with d as (
  select doc_id, regexp_extract_all({_LOWER.format("text")}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') w from documents),
  i as (
  select item_id, regexp_extract_all({_LOWER.format("text")}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') w from benchmark),
  win as (
  select distinct item_id, least(10, len(w)) n, array_to_string(w[p:p + least(10, len(w)) - 1], ' ') g
  from (select item_id, w, unnest(range(1, len(w) - least(10, len(w)) + 2)) p from i where len(w) > 0)),
  lens as (select distinct n from win),
  runs as (
  select doc_id, p, n, array_to_string(w[p:p + n - 1], ' ') g
  from (select doc_id, w, n, unnest(range(1, len(w) - n + 2)) p from d, lens where len(w) >= n)),
  hits as (select r.doc_id, r.p, r.n, win.item_id from runs r join win on win.n = r.n and win.g = r.g),
  cover as (
  select doc_id, count(distinct q) n_hit from (select doc_id, unnest(range(p, p + n)) q from hits) group by doc_id),
  items as (
  select doc_id, count(*) n_items, string_agg(i, ',' order by i) names
  from (select distinct doc_id, cast(item_id as varchar) i from hits) group by doc_id)
select d.doc_id, cast(len(w) as bigint) n_words, coalesce(n_hit, 0) n_hit, coalesce(n_items, 0) n_items,
  sha256(coalesce(names, '')) items_sha256, coalesce(n_hit, 0) > 0 contaminated
from d left join cover c on c.doc_id = d.doc_id left join items x on x.doc_id = d.doc_id""",
    "op9_url_filter": rf"""
with r as (
  select page_id, case when strpos(url, '://') > 0 then substr(url, strpos(url, '://') + 3) end rest from pages),
  p as (select page_id, rest, {_LOWER.format("regexp_extract(rest, '^[^/?#]*')")} host,
    coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') path from r),
  q as (select *, regexp_replace(regexp_replace(
      regexp_extract(rest, '^[^?#]*\?([^#]*)', 1), '(?:^|&){urls.TRACKING}', '', 'g'), '^&', '') query from p),
  c as (select page_id, host, path, case when rest is not null then
      regexp_replace(regexp_replace(host, '^(?:www|m)\.', ''), ':(?:80|443)$', '')
      || regexp_replace(regexp_replace(path, '(?:/index)?\.html?$', ''), '/+$', '')
      || case when query <> '' then '?' || query else '' end end canonical from q),
  farms as (select page_id from pages
    where len(string_split(html, '<a ')) - 1 > {LINKS} * (len(string_split(html, '<p>')) - 1)),
  listed as (select distinct canonical from c where canonical is not null
    and (regexp_matches(host, '{LISTED_HOSTS}') or page_id in (select page_id from farms))),
  v as (select c.*, l.canonical is not null listed,
    case when (host = 'example.org' or host like '%.example.org') and starts_with(path, '/en/1') then 'example.org/en/1'
      when (host = 'example.org' or host like '%.example.org') and starts_with(path, '/es/') then 'example.org/es/'
      when (host = 'com' or host like '%.com') and starts_with(path, '/fr/') then 'com/fr/'
      when (host = 'com' or host like '%.com') and starts_with(path, '/de/') then 'com/de/'
      when (host = 'org' or host like '%.org') and starts_with(path, '/') then 'org/' end rule
    from c left join listed l on l.canonical = c.canonical)
select page_id, host, path, rule, canonical, listed, case when rule in ('org/', 'com/fr/') then 'allow'
  when rule is not null or listed then 'block' else 'allow' end verdict from v""",
    "op12_hard_negatives": """
with v as (
  select distinct vec_id id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
    list_transform(embedding, lambda x: floor(256 * x::double)) e from embeddings
  where vec_id is not null and label is not null and embedding is not null
    and len(list_filter(embedding, lambda x: x is null or isnan(x) or isinf(x))) = 0),
  s as (
  select a.id a, b.id b, a.label = b.label same, cast(list_inner_product(a.e, b.e) as bigint) s
  from v a join v b on a.id % 100 = 0 and a.id <> b.id and len(a.e) = len(b.e)),
  p as (select a, b, s, row_number() over (partition by a order by s desc, b) k from s where same),
  n as (
  select p.a, p.b, p.s ps, s.b neg, s.s ns, row_number() over (partition by p.a, p.b order by s.s desc, s.b) k
  from p join s on s.a = p.a where p.k <= 5 and not s.same and 80 * p.s <= 100 * s.s and 100 * s.s <= 100 * p.s)
select a anchor_id, b positive_id, cast(k as integer) as rank, neg negative_id, ps positive_score,
  ns negative_score from n where k <= 5""",
    "op13_lexical_search": rf"""
with d as (
  select doc_id, regexp_extract_all({_LOWER.format("text")}, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') w
  from documents),
  i as (
  select distinct item_id, regexp_extract_all({_LOWER.format("text")},
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') w from benchmark),
  c as (select count(*) n_docs, cast(sum(len(w)) as bigint) n_terms from d where len(w) > 0),
  q as (select item_id, g, count(*) c from (select item_id, unnest(w) g from i) group by item_id, g),
  t as (
  select doc_id, n, g, count(*) tf from (select doc_id, len(w) n, unnest(w) g from d)
  where g in (select g from q) group by doc_id, n, g),
  wt as (
  select g, cast(floor(1000 * ln((2 * any_value(n_docs) + 2) / (2 * count(*) + 1))) as bigint) wt
  from t, c group by g),
  s as (
  select item_id, doc_id, cast(sum(q.c * wt * ((1000000000 * tf)
    // (1000 * tf + 8 * (100 - 75 + ((75 * n * n_docs) // n_terms))))) as bigint) score
  from q join t on t.g = q.g join wt on wt.g = q.g, c group by item_id, doc_id),
  r as (
  select item_id, doc_id, score, row_number() over (partition by item_id order by score desc, doc_id) k
  from s where score > 0)
select item_id, cast(k as integer) as rank, doc_id, score from r where k <= 10""",
}
