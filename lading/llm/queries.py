"""The registered queries of this subpackage, each over the whole table it is meant for."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..session import new_run_dir, stored
from . import (
    bpe, chunks, clusters, divergence, hyperminhash, kneser_ney, ledger, mixing, mixture, neighbours,
    quality, templates, token_files,
)

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query("op10_quality_rules", r"""
with d as (
  select doc_id, coalesce(text, '') as text,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w
  from documents),
lines as (
  select doc_id, row_number() over (partition by doc_id, line) as nth
  from (select doc_id, unnest(string_split(text, chr(10))) as line from d)
  where regexp_matches(line, '[^\x20\x09-\x0D]')),
line_counts as (
  select doc_id, count(*) as n_lines, count(*) filter (where nth > 1) as n_dup_lines
  from lines group by doc_id),
windows as (
  select doc_id, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] as win
  from (select doc_id, w, unnest(range(1, greatest(len(w) - 1, 1))) as i from d)),
again as (
  select doc_id, i from (
    select doc_id, i, count(*) over (partition by doc_id, win) as n from windows) where n > 1),
repeats as (
  select doc_id, count(distinct p) as n_repeat_words
  from (select doc_id, unnest([i, i + 1, i + 2]) as p from again) group by doc_id),
m as (
  select d.doc_id, len(w)::bigint as n_words, length(array_to_string(w, ''))::bigint as word_chars,
         (length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')))::bigint as n_symbols,
         coalesce(n_lines, 0) as n_lines, coalesce(n_dup_lines, 0) as n_dup_lines,
         coalesce(n_repeat_words, 0) as n_repeat_words,
         length(regexp_replace(text, '[^\p{Lu}]+', '', 'g')) as n_upper,
         len(list_distinct(w)) as n_distinct
  from d left join line_counts using (doc_id) left join repeats using (doc_id)),
bits as (
  select *,
    (n_words < 50)::int::bigint
    + 2 * (100 * n_repeat_words > 50 * n_words)::int
    + 4 * (word_chars > 20 * n_words)::int
    + 8 * (word_chars < 2 * n_words)::int
    + 16 * (5 * n_symbols > n_words)::int
    + 32 * (10 * n_dup_lines > 3 * n_lines)::int
    + 64 * (2 * n_upper > word_chars)::int
    + 128 * (n_distinct * n_distinct < n_words)::int as failed
  from m)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines::bigint as n_dup_lines,
       n_repeat_words::bigint as n_repeat_words,
       n_words < 50 or 100 * n_repeat_words > 50 * n_words as base_failed,
       failed = 0 as kept, failed
from bits""")
def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    entries = ledger.ledger(ledger.measure(table(spark, sf_dir, "documents")))
    return entries.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines",
        "n_repeat_words", ledger.fails(ledger.BASE).alias("base_failed"),
        (~ledger.fails(ledger.STANDARD)).alias("kept"), "failed",
    )


@query("op3_hyperminhash")
def op3_hyperminhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hyperminhash.near_duplicates(table(spark, sf_dir, "documents"), width=2)


@query("op8_substring_dedup")
def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The passages to cut: whose they are, where, how long, and which document keeps them."""
    return chunks.repeated_runs(table(spark, sf_dir, "documents")).select(
        F.col("id").alias("doc_id"), F.col("first_id").alias("first_doc_id"),
        "first_place", "last_place", F.col("words").cast("long").alias("n_words"))


def remainder(column: str, divisor: int):
    """crc32 of the decimal text of an id, modulo ``divisor``."""
    return F.crc32(F.col(column).cast("string").cast("binary")) % divisor


@query("op5_quality_classifier")
def op5_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    measured = stored(quality.with_statistics(table(spark, sf_dir, "documents")), "statistics")
    forest = quality.fit(
        measured, table(spark, sf_dir, "labels"), "quality", remainder("id", 5) != 0)
    return quality.scored(measured, forest).select(
        F.col("id").alias("doc_id"), F.coalesce(remainder("id", 5) == 0, F.lit(False)).alias("held_out"),
        "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    """Where the public tokenizer files lie on the driver."""
    import public_tokenizers

    return str(public_tokenizers.path(name))


@query("op2_bpe")
def op2_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = tokenizer_path()
    encoded = bpe.encode(table(spark, sf_dir, "documents").select("doc_id", "text"), path)
    decoded = bpe.decode(encoded.select("doc_id", "token_ids"), path)
    return decoded.select(
        "doc_id", (F.length("token_ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("token_ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


@query("op1_source_mixing")
def op1_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return mixing.mix(docs).select("doc_id", "size", "source_size", "target", "taken")


@query("op7_logistic_mixing")
def op7_logistic_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scores = mixture.score_texts(docs, remainder("doc_id", 7) != 2)
    return scores.select(
        "doc_id", F.coalesce(remainder("doc_id", 7) == 2, F.lit(False)).alias("held_out"),
        "n_tokens", "n_known", "train_tokens", "base_score", "score", "bits_per_byte")


@query("op4_kneser_ney")
def op4_kneser_ney(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return kneser_ney.identify(docs, remainder("doc_id", 4) != 2).select(
        "doc_id", F.coalesce(remainder("doc_id", 4) == 2, F.lit(False)).alias("held_out"),
        "lang_pred", "score", "cross_entropy", "rejected")


@query("op6_block_matrix_neighbours")
def op6_block_matrix_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest(table(spark, sf_dir, "embeddings"), F.col("id") % 50 == 0)


URL_RULES = (
    templates.Rule("block", "net", "/"), templates.Rule("allow", "example.net", "/en/"),
    templates.Rule("block", "example.com", "/de/"), templates.Rule("allow", "org", "/fr/"),
)


@query("op9_url_templates")
def op9_url_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return templates.judge(table(spark, sf_dir, "pages").select("page_id", "url"), URL_RULES)


END_ID = 2


@query("op11_token_files")
def op11_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = new_run_dir(spark, "tokens")
    token_files.write_tokens(
        table(spark, sf_dir, "documents").select("doc_id", "text"), folder, tokenizer_path(), END_ID)
    return token_files.read_tokens(spark, folder)


def _rounds_sql(rounds: int) -> str:
    """Lloyd's rounds in SQL: ``a<r>`` assigns, ``c<r + 1>`` are the centroids after it."""
    out = []
    for r in range(rounds + 1):
        out.append(f"""
a{r} as materialized (
  select r, vec_id, v, least_key % 8 as cluster, least_key // 8 as distance from (
    select k.r, any_value(k.vec_id) as vec_id, any_value(k.v) as v,
           min(8 * list_sum([(z[1] - z[2]) * (z[1] - z[2]) for z in list_zip(k.v, c.v)])::bigint
               + c.cluster) as least_key
    from kept k cross join c{r} c group by k.r))""")
        if r < rounds:
            out.append(f"""
s{r} as (
  select cluster, i, sum(x) as s, count(*) as n
  from (select cluster, unnest(v) as x, unnest(range(1, 65)) as i from a{r}) group by cluster, i),
m{r} as (
  select cluster, list(((s - ((s % n) + n) % n) // n)::bigint order by i) as v from s{r} group by cluster),
c{r + 1} as materialized (
  select c.cluster, coalesce(m.v, c.v) as v from c{r} c left join m{r} m using (cluster))""")
    return ",".join(out)


@query("op12_shallot_clusters", rf"""
with kept as materialized (
  select row_number() over () as r, vec_id,
         [floor(1024 * x::double)::bigint for x in embedding] as v
  from embeddings
  where len(embedding) = 64
    and len([x for x in embedding if x is not null and isfinite(x)]) = 64),
c0 as materialized (
  select row_number() over (order by h, v) - 1 as cluster, v
  from (select sha256('3:' || vec_id) as h, v from kept order by h, v limit 8)),
{_rounds_sql(10).strip()},
t as (select cluster, sum(distance) as s from a10 group by cluster)
select vec_id, cluster::integer as cluster, distance::bigint as distance,
       t.s::bigint as cluster_inertia, (select sum(distance) from a10)::bigint as inertia,
       sha256(array_to_string(c.v, ',')) as centroid_sha256
from a10 join t using (cluster) join c10 c using (cluster)""")
def op12_shallot_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clusters.cluster(table(spark, sf_dir, "embeddings"))


@query("op13_source_divergence", r"""
with d as (
  select row_number() over () as r, coalesce(lang, '') as lang, coalesce(source, '') as source,
         coalesce(text, '') as text
  from documents),
w as (
  select r, lang, source,
         translate(unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as term
  from d),
kept as (select lang, term from w group by lang, term having count(distinct r) >= 10),
v as (select lang, count(*) as v from kept group by lang),
g as (select distinct lang, source from d),
n as (select lang, source, term, count(*) as n from w semi join kept using (lang, term) group by all),
grid as (
  select g.lang, g.source, k.term, coalesce(n.n, 0) as n
  from g join kept k using (lang) left join n using (lang, source, term)),
p as (
  select lang, source, term, n,
         (1 + (1000000000::hugeint * (n + 2))
              // (sum(n) over (partition by lang, source) + 2 * v))::bigint as p
  from grid join v using (lang)),
l as (
  select lang, term,
         (1 + (1000000000::hugeint * (n + 2)) // (sum(n) over (partition by lang) + 2 * v))::bigint as q
  from (select lang, term, sum(n) as n from grid group by lang, term) join v using (lang)),
pairs as (
  select a.lang, a.source, b.source as item,
         coalesce(sum(((x.p - y.p) * (x.p - y.p)) // (x.p + y.p)), 0)::bigint as value
  from g a join g b on a.lang = b.lang and a.source <> b.source
    left join p x on x.lang = a.lang and x.source = a.source
    left join p y on y.lang = b.lang and y.source = b.source and y.term = x.term
  group by a.lang, a.source, b.source),
terms as (
  select p.lang, p.source, p.term as item,
         (((p.p - l.q) * (p.p - l.q)) // (p.p + l.q))::bigint as value
  from p join l using (lang, term) where p.n > 0 and p.p > l.q),
ranked as (
  select lang, source, 'pair' as part, item, value from pairs
  union all select lang, source, 'term', item, value from terms)
select lang, source, part, item, value,
       (row_number() over (partition by lang, source, part order by value desc, encode(item)))::integer as rank
from ranked qualify part = 'pair' or rank <= 10""")
def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.divergence(table(spark, sf_dir, "documents").select("text", "lang", "source"))
