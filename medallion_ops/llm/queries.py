"""The registered queries of the corpus operators, with production parameters, and their DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from medallion_ops.llm.ann import search
from medallion_ops.llm.common import table
from medallion_ops.llm.decontaminate import scan_benchmark
from medallion_ops.llm.mixing import mix_to_weights
from medallion_ops.llm.negatives import mine_negatives
from medallion_ops.llm.phrases import collocations
from medallion_ops.llm.pii_crf import KINDS, example_table, find_pii, fit_pii
from medallion_ops.llm.quality_crf import fit_quality, score_quality
from medallion_ops.llm.secret_ledger import RULES, scan_versions
from medallion_ops.llm.simhash import near_duplicates
from medallion_ops.llm.token_counts import count_tokens, ranked_vocabulary
from medallion_ops.llm.token_files import read_index, write_token_files
from medallion_ops.llm.toxicity import fit_toxicity, score_toxicity
from medallion_ops.llm.warc_derivatives import read_records, responses_of_pages, write_derivatives


def tokenizer_path(name: str) -> str:
    """A public vocabulary file, which every executor has at the same place."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_mix_to_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mix of all documents: sources weigh 3, 1, 2 in turn and share 150% of all words."""
    mix = mix_to_weights(table(spark, sf_dir, "documents"), weights=(3, 1, 2), budget=1.5, epochs=2)
    return mix.select("doc_id", "size", "source_size", "target", "taken")


def op2_warc_derivatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metadata and conversion records of every page, written to files and read back."""
    folder, index = write_derivatives(responses_of_pages(table(spark, sf_dir, "pages")))
    return read_records(folder, index, blocks=False).drop("block")


def op3_adaptive_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest rows by inner product of every row whose vec_id is divisible by 20."""
    return search(table(spark, sf_dir, "embeddings"), k=20)


def op4_secret_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in every document, scanned once per distinct content."""
    docs = table(spark, sf_dir, "documents")
    findings, _ = scan_versions(docs, path_col="doc_id", text_col="text")
    spans = F.concat_ws(",", F.transform("findings", lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))))
    count = lambda kind: F.size(F.filter("findings", lambda s: s["kind"] == kind)).cast("bigint")
    return findings.select(F.col("path").alias("doc_id"), *[count(r.kind).alias(f"n_{r.kind}") for r in RULES],
                           F.sha2(spans.cast("binary"), 256).alias("base_sha256"), spans.alias("spans"))


def remainder(modulus: int):
    """crc32 of doc_id as text, modulo ``modulus``: which rows labels are learned from."""
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % modulus


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document; labels are learned where the remainder modulo 5 is not 0."""
    docs = table(spark, sf_dir, "documents")
    model = fit_toxicity(docs, table(spark, sf_dir, "labels"), learn=remainder(5) != 0)
    scored = score_toxicity(docs, model, keep=["doc_id"], score_col="score")
    return scored.select("doc_id", (remainder(5) == 0).alias("held_out"), "score",
                         (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unigram token counts of every document."""
    return count_tokens(table(spark, sf_dir, "documents"), ranked_vocabulary(tokenizer_path("piece_bpe_32k.model")),
                        keep=["doc_id"])


def op7_quality_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every document; labels are learned where the remainder modulo 4 is not 2."""
    docs = table(spark, sf_dir, "documents")
    model = fit_quality(docs, table(spark, sf_dir, "labels"), learn=remainder(4) != 2)
    scored = score_quality(docs, model, keep=["doc_id"], score_col="score")
    return scored.select("doc_id", (remainder(4) == 2).alias("held_out"), "score",
                         (F.col("score") >= 0.7).cast("int").alias("predicted"))


def op8_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents as token files, read back document by document."""
    folder, manifest = write_token_files(table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"),
                                         end_id=0)
    return read_index(folder, manifest)


def op9_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark windows of 10 words in every document."""
    found = scan_benchmark(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), n=10, keep=["doc_id"])
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("bigint").alias("n_items"),
                        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
                        (F.col("n_hit") > 0).alias("contaminated"))


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate groups of all documents: 3-word shingles, at most 3 differing bits."""
    found = near_duplicates(table(spark, sf_dir, "documents"), shingle=3, distance=3)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
                        F.col("component").alias("component_id"))


def op11_pii_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every document: counts and digest of the base patterns, and all spans, the chain's included."""
    found = find_pii(table(spark, sf_dir, "documents"), fit_pii(example_table(spark)), keep=["doc_id"])
    listed = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
    base = F.filter("spans", lambda s: s["base"])
    count = lambda kind: F.size(F.filter(base, lambda s: s["kind"] == kind)).cast("bigint")
    return found.select("doc_id", *[count(k).alias(f"n_{k}") for k in KINDS],
                        F.sha2(listed(base).cast("binary"), 256).alias("base_sha256"), listed(F.col("spans")).alias("spans"))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every row whose vec_id is divisible by 100; a seventh of the rows moves on by one label."""
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return mine_negatives(table(spark, sf_dir, "embeddings").withColumn("label", moved))


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 2,000 best phrases of two and three words of each language of the documents."""
    found = collocations(table(spark, sf_dir, "documents"), top=2000, least=10, overlap=50)
    return found.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


QUERIES = {
    "op1_mix_to_weights": op1_mix_to_weights,
    "op2_warc_derivatives": op2_warc_derivatives,
    "op3_adaptive_scan": op3_adaptive_scan,
    "op4_secret_ledger": op4_secret_ledger,
    "op5_toxicity": op5_toxicity,
    "op6_token_counts": op6_token_counts,
    "op7_quality_crf": op7_quality_crf,
    "op8_token_files": op8_token_files,
    "op9_decontaminate": op9_decontaminate,
    "op10_simhash": op10_simhash,
    "op11_pii_crf": op11_pii_crf,
    "op12_hard_negatives": op12_hard_negatives,
    "op13_collocations": op13_collocations,
}

ORACLE: dict[str, str] = {}

ORACLE["op1_mix_to_weights"] = r"""
with sized as (
  select doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::bigint as size,
         md5('mix:' || cast(doc_id as varchar)) as shuffle
  from documents),
per as (
  select source, sum(size)::double as source_size,
         [3.0, 1.0, 2.0][(row_number() over (order by source nulls last) - 1) % 3 + 1] as weight,
         row_number() over (order by source nulls last) as place
  from sized group by source),
ratio as (select *, 2 * source_size as cap, 2 * source_size / weight as r from per),
filled as (
  select *, cap_sum + r * (all_weight - weight_sum) <= tokens as capped from (
    select *, sum(cap) over (order by r, place) as cap_sum, sum(weight) over (order by r, place) as weight_sum,
           sum(weight) over () as all_weight, 1.5 * sum(source_size) over () as tokens
    from ratio)),
aim as (
  select *, case when capped then cap else weight * (
      (tokens - coalesce(sum(cap) filter (capped) over (), 0)) / sum(weight) filter (not capped) over ()) end as target
  from filled),
placed as (
  select s.*, a.source_size, a.weight, a.place, a.target, a.tokens,
         sum(size) over (partition by a.place order by shuffle, doc_id, size rows unbounded preceding) - size / 2.0
           as middle
  from sized s join aim a on s.source is not distinct from a.source),
queue as (
  select p.*, e.epoch, (middle + e.epoch * source_size) / weight as vtime
  from placed p cross join (select unnest([0, 1]) as epoch) e where size > 0),
cut as (
  select max(vtime) as t from (
    select vtime, size, tokens,
           sum(size) over (order by vtime, place, epoch, shuffle, doc_id, size rows unbounded preceding) as run
    from queue) where run - size / 2.0 <= tokens)
select doc_id, size, source_size::bigint as source_size, target,
       (case when size = 0 then 0
        else size * ((middle / weight <= t)::bigint + ((middle + source_size) / weight <= t)::bigint) end)::bigint
         as taken
from placed, cut
"""

ORACLE["op4_secret_ledger"] = r"""
with rules as (
  select * from (values
    ('assign', 0, '(?i)(password|passwd|secret|token|api_?key)["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)', 2, 6),
    ('access', 1, 'AKIA[A-Z0-9]{16,}', 0, 20),
    ('hex', 2, '[0-9a-f]{24,}', 0, 24)) as r(kind, place, pattern, grp, least)),
docs as (select row_number() over () as n, doc_id, coalesce(text, '') as text from documents),
cut as (
  select n, 'assign' as kind, 0 as place,
         string_split_regex(text, (select pattern from rules where kind = 'assign')) as gaps,
         regexp_extract_all(text, '(?i)(password|passwd|secret|token|api_?key)["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)', 0) as hits,
         regexp_extract_all(text, '(?i)(password|passwd|secret|token|api_?key)["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)', 2) as sized
  from docs
  union all
  select n, 'access', 1, string_split_regex(text, 'AKIA[A-Z0-9]{16,}'), regexp_extract_all(text, 'AKIA[A-Z0-9]{16,}'),
         regexp_extract_all(text, 'AKIA[A-Z0-9]{16,}') from docs
  union all
  select n, 'hex', 2, string_split_regex(text, '[0-9a-f]{24,}'), regexp_extract_all(text, '[0-9a-f]{24,}'),
         regexp_extract_all(text, '[0-9a-f]{24,}') from docs),
each as (
  select n, kind, place, gaps, hits, sized, unnest(range(1, len(hits) + 1)) as i from cut where len(hits) > 0),
spans as (
  select n, kind, place, len(sized[i]) as measured,
         list_sum(list_transform(gaps[1:i], lambda g: len(g)))
           + coalesce(list_sum(list_transform(hits[1:i - 1], lambda h: len(h))), 0) as b, len(hits[i]) as l
  from each),
kept as (select * from spans s where measured >= (select least from rules r where r.kind = s.kind)),
per as (
  select n, count(*) filter (kind = 'assign') as n_assign, count(*) filter (kind = 'access') as n_access,
         count(*) filter (kind = 'hex') as n_hex,
         string_agg(kind || ':' || b::bigint || ':' || (b + l)::bigint, ',' order by b, place) as spans
  from kept group by n)
select doc_id, coalesce(n_assign, 0)::bigint as n_assign, coalesce(n_access, 0)::bigint as n_access,
       coalesce(n_hex, 0)::bigint as n_hex, sha256(coalesce(spans, '')) as base_sha256, coalesce(spans, '') as spans
from docs left join per using (n)
"""

ORACLE["op12_hard_negatives"] = r"""
with fine as (
  select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
         [floor(256 * x::double) for x in embedding] as v
  from embeddings
  where label is not null and embedding is not null
    and len([x for x in embedding if x is null or isnan(x) or isinf(x)]) = 0),
against as (
  select a.vec_id as anchor_id, b.vec_id, a.label = b.label as same,
         list_inner_product(a.v, b.v)::bigint as score
  from fine a join fine b on a.vec_id <> b.vec_id where a.vec_id % 100 = 0),
positive as (
  select anchor_id, vec_id as positive_id, score as positive_score from against where same
  qualify row_number() over (partition by anchor_id order by score desc, vec_id) <= 5),
negative as (
  select anchor_id, positive_id, positive_score, n.vec_id as negative_id, n.score as negative_score,
         row_number() over (partition by anchor_id, positive_id order by n.score desc, n.vec_id) as rank
  from positive join against n using (anchor_id)
  where not n.same and 30 * positive_score <= 100 * n.score and 100 * n.score <= 90 * positive_score)
select anchor_id, positive_id, rank::int as rank, negative_id, positive_score, negative_score
from negative where rank <= 10
"""

ORACLE["op13_collocations"] = r"""
with pieces as (
  select coalesce(lang, 'und') as lang, unnest(regexp_split_to_array(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[.,;:!?\x0A-\x0D]')) as piece
  from documents),
spoken as (select lang, regexp_extract_all(piece, '[^\x20\x09]+') as w from pieces),
grams as (
  select lang, 1 as k, unnest(w) as phrase from spoken
  union all
  select lang, k, unnest([array_to_string(w[i:i + k - 1], ' ') for i in range(1, len(w) - k + 2)])
  from spoken, (values (2), (3)) as sizes(k) where len(w) >= k),
counted as (select lang, k, phrase, count(*)::hugeint as f from grams group by all),
totals as (select lang, sum(f)::bigint as n from counted where k = 1 group by lang),
candidates as (
  select lang, k, phrase, f as a, string_split(phrase, ' ') as w from counted where k > 1 and f >= 10),
cuts as (
  select c.*, cut, array_to_string(w[1:cut], ' ') as head, array_to_string(w[cut + 1:k], ' ') as tail
  from candidates c, (values (1), (2)) as places(cut) where cut < k),
scored as (
  select c.*, h.f as l, t.f as r, (1000000::hugeint * a * a) // (h.f * t.f) as score
  from cuts c join counted h on h.lang = c.lang and h.k = c.cut and h.phrase = c.head
  join counted t on t.lang = c.lang and t.k = c.k - c.cut and t.phrase = c.tail),
worst as (
  select * from scored qualify row_number() over (partition by lang, k, phrase order by score, cut) = 1),
held as (
  select lang, inner_phrase, max(a) as longer from (
    select lang, a, unnest([array_to_string(w[1:2], ' '), array_to_string(w[2:3], ' ')]) as inner_phrase
    from candidates where k = 3) group by all),
kept as (
  select c.* from worst c left join held x on c.k = 2 and x.lang = c.lang and x.inner_phrase = c.phrase
  where x.longer is null or 100 * x.longer < 50 * c.a),
ranked as (select *, row_number() over (partition by lang order by score desc, a desc, phrase) as rank from kept)
select lang, rank::bigint as rank, phrase, a::bigint as a, l::bigint as l, r::bigint as r, n, score::bigint as score
from ranked join totals using (lang) where rank <= 2000
"""

ORACLE["op9_decontaminate"] = r"""
with docs as (
  select row_number() over () as n, doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w
  from documents),
tests as (
  select coalesce(cast(item_id as varchar), 'null') as item, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w
  from benchmark),
windows as (
  select distinct item, k, unnest([array_to_string(w[i:i + k - 1], ' ') for i in range(1, len(w) - k + 2)]) as gram
  from (select item, w, least(len(w), 10) as k from tests where len(w) > 0)),
spoken as (
  select n, k, i, array_to_string(w[i:i + k - 1], ' ') as gram
  from (select n, k, w, unnest(range(1, len(w) - k + 2)) as i
        from docs, (select distinct k from windows) as lengths where len(w) >= k)),
hits as (select n, i, spoken.k, item from spoken join windows using (k, gram)),
covered as (select n, count(distinct place) as n_hit from (select n, unnest(range(i, i + k)) as place from hits) group by n),
named as (
  select n, count(*) as n_items, string_agg(item, ',' order by item) as items
  from (select distinct n, item from hits) group by n)
select doc_id, len(w)::bigint as n_words, coalesce(n_hit, 0)::bigint as n_hit, coalesce(n_items, 0)::bigint as n_items,
       sha256(coalesce(items, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from docs left join covered using (n) left join named using (n)
"""
