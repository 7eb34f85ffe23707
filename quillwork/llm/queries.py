"""The registered queries of the numbered operators, with their SQL where SQL can express them."""

from __future__ import annotations

import hashlib
from collections.abc import Callable

import numpy as np
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillwork.llm import (
    bpe, editcount, hmm, langid, linededup, merkle, ngramjoin, packing, quality, runs,
    toxicity, urlfilter, vectorjoin,
)
from quillwork.llm.arrow import Answer, map_rows
from quillwork.session import settle

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in pieces of power-of-two length."""
    return packing.pack(table(spark, sf_dir, "documents"), bpe.read_vocabulary(VOCABULARY),
                        with_ids=False)


def op2_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document by a model of the documents outside the held-out fold."""
    docs = table(spark, sf_dir, "documents")
    chain = langid.learn(docs)
    return langid.languages_of(docs, chain).select(
        "doc_id", F.coalesce(langid.fold(F.col("doc_id")) == 0, F.lit(False)).alias("held_out"),
        "lang_pred", "score")


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the lines that ten documents or more have."""
    kept = linededup.dedup_lines(table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "_lines.n_lines", "_lines.n_dropped",
                       F.sha2("text", 256).alias("kept_sha256"))


OP3_SQL = """
with rows as (
    select row_number() over () as row, doc_id, coalesce(text, '') as text, md5(text) as same from documents
), lines as (
    select row, doc_id, same, unnest(string_split(text, chr(10))) as line,
           unnest(range(len(string_split(text, chr(10))))) as place
    from rows
), keyed as (
    select *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as line_key
    from lines
), gone as (
    select line_key from keyed where line_key <> ''
    group by line_key having count(distinct (doc_id, same)) >= 10
)
select doc_id, count(*)::bigint as n_lines,
       count(*) filter (where g.line_key is not null)::bigint as n_dropped,
       sha256(coalesce(string_agg(line, chr(10) order by place)
                       filter (where g.line_key is null), '')) as kept_sha256
from keyed k left join gone g on k.line_key = g.line_key
group by row, doc_id
"""


def op4_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The group of near copies of every document."""
    return ngramjoin.ngram_groups(table(spark, sf_dir, "documents"))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document by a model of the labelled rows outside the held-out fold."""
    docs = table(spark, sf_dir, "documents")
    model = toxicity.learn(docs, table(spark, sf_dir, "labels"))
    return toxicity.with_scores(docs.select("doc_id", "text"), model).select(
        "doc_id",
        F.coalesce(toxicity.crc_of(F.col("doc_id")) % 4 == 2, F.lit(False)).alias("held_out"),
        F.col("_toxicity").alias("score"),
        (F.col("_toxicity") >= toxicity.CUT).cast("int").alias("predicted"))


def op6_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and components of every vector."""
    return vectorjoin.near_vectors(table(spark, sf_dir, "embeddings"))


OP6_SQL = """
with recursive pairs as materialized (
    select a.vec_id as a, b.vec_id as b from embeddings a, embeddings b
    where a.vec_id <> b.vec_id
      and list_cosine_similarity(a.embedding::double[], b.embedding::double[]) >= 0.9
), reach as (
    select vec_id, vec_id as other from embeddings
    union select r.vec_id, p.b from reach r join pairs p on r.other = p.a
), least as (
    select vec_id, min(other) as component_id from reach group by vec_id
), counts as (
    select a as vec_id, count(*) as n from pairs group by a
)
select l.vec_id, coalesce(c.n, 0)::bigint as n_links, l.component_id,
       l.vec_id = l.component_id as kept
from least l left join counts c using (vec_id)
"""


def op7_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page judged by the list entries active on the day it was fetched."""
    pages = table(spark, sf_dir, "pages")
    return urlfilter.judge(urlfilter.dated_captures(pages), urlfilter.dated_list(pages))


OP7_SQL = r"""
with parsed as (
    select page_id, url,
           nullif(rtrim(regexp_extract(lower(url),
               '^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)', 1), '.'), '') as host,
           list_filter(string_split(regexp_extract(url,
               '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)', 1), '/'), lambda x: x <> '') as levels,
           date '2024-01-01' + (('0x' || substr(md5(page_id::varchar), 1, 7))::bigint % 365)::int
               as fetched_at
    from pages
), entries as (
    select distinct host, unnest(['', coalesce(levels[1], '')]) as path
    from parsed where host is not null
), seeded as (
    select host, path, ('0x' || substr(md5(host || '/' || path), 1, 7))::bigint as seed from entries
), changes as (
    select host, path, case (seed // 3 + step) % 3 when 0 then 'block' when 1 then 'allow'
               else 'remove' end as action,
           date '2024-01-01' + ((seed // 9 + 97 * step) % 365)::int as changed
    from seeded, range(3) as steps(step) where seed % 3 <> 0
), at_once as (
    select host, path, changed, arg_min(action, case action when 'block' then 0 when 'allow' then 1
                                           else 2 end) as action
    from changes group by host, path, changed
), turned as (
    select * from at_once
    qualify coalesce(lag(action) over (partition by host, path order by changed), '') <> action
), intervals as (
    select host, path, action, changed as valid_from,
           lead(changed) over (partition by host, path order by changed) as valid_to
    from turned qualify action <> 'remove'
), hits as (
    select p.page_id, e.path, e.valid_from, e.action,
           row_number() over (partition by p.page_id order by len(e.path) desc) as place
    from parsed p join intervals e on p.host = e.host
        and (e.path = '' or e.path = p.levels[1])
        and p.fetched_at >= e.valid_from and (e.valid_to is null or p.fetched_at < e.valid_to)
)
select p.page_id, p.host, p.fetched_at, h.path as entry_path, h.valid_from as entry_from,
       coalesce(h.action = 'block', false) as blocked
from parsed p left join hits h on p.page_id = h.page_id and h.place = 1
"""


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts of every document before and after its edits."""
    vocabulary = bpe.read_vocabulary(VOCABULARY)
    trees = settle(editcount.build(table(spark, sf_dir, "documents"), vocabulary))
    # Each document's edits follow from its own row, so there is nothing to join.
    rows = editcount.edited(trees.withColumn("edits", editcount.derived_edits()), vocabulary, keep=False)
    return rows.select("doc_id", "tokens_before", "tokens_after", "n_edits", "n_encoded_again")


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and verdict of every document."""
    return quality.judge(table(spark, sf_dir, "documents"))


OP9_SQL = r"""
with base as (
    select doc_id, lang, source, coalesce(text, '') as text,
           list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'),
                       lambda w: w <> '') as words,
           list_filter(string_split(coalesce(text, ''), chr(10)), lambda l: trim(
               l, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) <> '') as lines
    from documents
), windows as (
    select *, list_transform(range(len(words) - 7),
                             lambda i: array_to_string(list_slice(words, i + 1, i + 8), ' ')) as ws
    from base
), positions as (
    select doc_id, lang, source, unnest(ws) as w, unnest(range(len(ws))) as i from windows
), twice as (
    select doc_id, i from positions
    qualify count(*) over (partition by doc_id, w) > 1
), reach as (
    select doc_id, sum(least(8, coalesce(after - i, 8))) as n from (
        select doc_id, i, lead(i) over (partition by doc_id order by i) as after from twice)
    group by doc_id
), counts as (
    select doc_id, lang, source, len(words)::bigint as n_words,
           length(array_to_string(words, ''))::bigint as word_chars,
           length(regexp_replace(text, '[^#*$%&|<>]+', '', 'g'))::bigint as n_symbols,
           len(lines)::bigint as n_lines,
           (len(lines) - len(list_distinct(lines)))::bigint as n_dup_lines,
           coalesce(reach.n, 0)::bigint as n_repeat_words
    from windows left join reach using (doc_id)
), failed as (
    select *, n_words < 20 or 100 * n_repeat_words > 30 * n_words as base_failed,
           case when n_words > 0 then 100 * word_chars // n_words else 0 end as word_length,
           case when n_words > 0 then 1000 * n_symbols // n_words else 0 end as symbols,
           case when n_lines > 0 then 1000 * n_dup_lines // n_lines else 0 end as dup_lines,
           case when n_words > 0 then 1000 * n_repeat_words // n_words else 0 end as repeats
    from counts
), rates as (
    select lang, source, unnest(['word_length', 'symbols', 'dup_lines', 'repeats']) as rate,
           unnest([word_length, symbols, dup_lines, repeats]) as value
    from failed where not base_failed
), sketch as (
    select level, rate, bucket, count(*) as n,
           case when level < 2 then lang end as lang, case when level < 1 then source end as source
    from (select *, greatest(length(bin(value)) - 6, 0) as shift,
                 (value >> shift) << shift as bucket from rates), range(3) as levels(level)
    group by all
), ranked as (
    select *, sum(n) over (partition by level, lang, source, rate) as rows,
           sum(n) over (partition by level, lang, source, rate order by bucket) as upto
    from sketch
), points as (
    select level, lang, source, rate, first(rows) as rows,
           min(bucket) filter (where 100 * upto >= 5 * rows) as q5,
           min(bucket) filter (where 100 * upto >= 50 * rows) as q50,
           min(bucket) filter (where 100 * upto >= 90 * rows) as q90,
           min(bucket) filter (where 100 * upto >= 99 * rows) as q99
    from ranked group by level, lang, source, rate
), limits as (
    select level, lang, source, rate, rows,
           case when rate = 'word_length' then q50 - 6 * greatest(q50 - q5, q50 // 32) else 0 end as low,
           case when rate in ('dup_lines', 'repeats') then q99
                when rate = 'symbols' then q50 + 6 * (q90 - q50)
                else q50 + 6 * greatest(q90 - q50, q50 // 32) end as high
    from points
), wide as (
    select l.lang, l.rate, floor((l.rows * l.low + 200 * a.low) / (l.rows + 200)) as low,
           floor((l.rows * l.high + 200 * a.high) / (l.rows + 200)) as high
    from limits l join limits a on a.level = 2 and a.rate = l.rate where l.level = 1
), own as (
    select o.lang, o.source, o.rate, floor((o.rows * o.low + 200 * w.low) / (o.rows + 200)) as low,
           floor((o.rows * o.high + 200 * w.high) / (o.rows + 200)) as high
    from limits o join wide w on w.lang is not distinct from o.lang and w.rate = o.rate where o.level = 0
), chosen as (
    select lang, source, max(low) filter (where rate = 'word_length') as word_low,
           max(high) filter (where rate = 'word_length') as word_high,
           max(high) filter (where rate = 'symbols') as symbols_high,
           max(high) filter (where rate = 'dup_lines') as dup_high,
           max(high) filter (where rate = 'repeats') as repeats_high
    from own group by lang, source
)
select f.doc_id, f.lang, f.source, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       base_failed,
       not base_failed and coalesce(word_length between word_low and word_high
           and 1000 * (n_symbols - 2) <= symbols_high * n_words
           and 1000 * (n_dup_lines - 1) <= dup_high * n_lines
           and 1000 * (n_repeat_words - 16) <= repeats_high * n_words, false) as kept
from failed f left join chosen t
    on f.lang is not distinct from t.lang and f.source is not distinct from t.source
"""


def op10_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document encoded and decoded again, as digests."""
    shipped = spark.sparkContext.broadcast(bpe.read_vocabulary(VOCABULARY))

    def digests(texts: list[str | None]) -> Answer:
        own, counts, encoded, decoded = bpe.encoder(shipped.value), [], [], []
        for raw in own.encode_all(texts):
            counts.append(len(raw) // 4)
            encoded.append(hashlib.sha256(raw).hexdigest())
            back = own.decode(np.frombuffer(raw, "<u4"))
            decoded.append(hashlib.sha256(back.encode()).hexdigest())
        return None, {"n_tokens": counts, "ids_sha256": encoded, "decoded_sha256": decoded}

    return map_rows(table(spark, sf_dir, "documents"), "doc_id", [F.col("text")],
                    "n_tokens long, ids_sha256 string, decoded_sha256 string", digests)


def with_planted_runs(docs: DataFrame) -> DataFrame:
    """``doc_id, text``; a tenth of the texts go on periodically from some word on."""
    words = F.filter(F.split(F.coalesce("text", F.lit("")), r"[\x20\x09-\x0D]+"), lambda w: w != "")
    crc = F.crc32(F.col("doc_id").cast("string"))
    rest = docs.filter(F.coalesce(crc % 10 != 0, F.lit(True))).select("doc_id", "text")
    chosen = docs.filter(crc % 10 == 0).select(
        "doc_id", words.alias("words"), F.floor(crc / 10).alias("g")).withColumn(
        "n", F.size("words")).withColumn("a", F.expr("cast(if(n > 0, g % n, 0) as int)")).withColumn(
        "p", F.expr("cast(1 + floor((n - a) / (3 + g % 8)) as int)"))
    planted = F.array_join(F.concat(F.slice("words", F.lit(1), F.col("a")), F.expr(
        "transform(if(n > a, sequence(a, n - 1), cast(array() as array<int>)), "
        "i -> words[a + (i - a) % p])")), " ")
    return rest.unionByName(chosen.select("doc_id", planted.alias("text")))


def op11_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The periodic runs of every document, and digests of the texts without their repeats."""
    found = runs.periodic_runs(with_planted_runs(table(spark, sf_dir, "documents")))
    # Runs come by start, then period, so the first of equal exponents stays.
    best = F.expr("""aggregate(runs, cast(null as struct<start:bigint,length:bigint,period:bigint>),
        (best, r) -> if(best is null or r.length * best.period > best.length * r.period, r, best))""")
    lines = F.array_join(F.transform("runs", lambda r: F.concat(
        F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))), "")
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), best.alias("best"),
        F.sha2(lines, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    ).select("doc_id", "n_runs", "best.*",
             F.expr("1000 * best.length div best.period").alias("exponent_milli"),
             "runs_sha256", "collapsed_sha256")


def op12_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's likelihood under a model of the documents outside the held-out fold."""
    held_out = F.crc32(F.col("doc_id").cast("string")) % 7 == 2
    return hmm.score_texts(table(spark, sf_dir, "documents"), ~held_out, held_out)


def op13_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's leaf, proof and, of one in seven tampered with, the root that follows."""
    docs = table(spark, sf_dir, "documents")
    tampered = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 7 == 0, F.lit(False))
    fields = [F.when(tampered, F.col("n_chars") + 1).otherwise(F.col("n_chars"))
              if c == "n_chars" else F.col(c) for c in merkle.FIELDS]
    rows = merkle.manifest(docs, carry={"found": merkle.leaf_digest(*fields)}).withColumn(
        "folded", merkle.folded(F.col("found"), F.col("path")))
    return rows.select(
        F.col("id").alias("doc_id"), *[merkle.shown(c).alias(c) for c in ("leaf", "subroot", "root")],
        merkle.proof_digest(F.col("path")).alias("proof_sha256"),
        merkle.shown("folded").alias("folded_root"), (F.col("folded") == F.col("root")).alias("verified"))


OP13_SQL = """
with recursive given as (
    select row_number() over () as id, doc_id, coalesce('=' || lang, '') as tree,
           coalesce(strlen(doc_id::varchar) || ':' || doc_id, '-')
               || coalesce(strlen(source) || ':' || source, '-')
               || coalesce(strlen(lang) || ':' || lang, '-') as head,
           n_chars, coalesce(strlen(text) || ':' || text, '-') as tail,
           xor(4294967295::bigint, list_reduce(list_prepend(4294967295::bigint, list_transform(
               string_split(doc_id::varchar, ''), lambda c: ascii(c)::bigint)),
               lambda crc, byte: list_reduce(
                   list_prepend(xor(crc, byte), [0, 0, 0, 0, 0, 0, 0, 0]::bigint[]),
                   lambda x, _: case x % 2 when 1 then xor(x // 2, 3988292384) else x // 2 end))) as crc
    from documents
), leaves as (
    select id, doc_id, tree,
           sha256(head || coalesce(strlen(n_chars::varchar) || ':' || n_chars, '-') || tail) as leaf,
           sha256(head || coalesce(strlen((n_chars + 1)::varchar) || ':' || (n_chars + 1), '-') || tail)
               as altered, coalesce(crc % 7 = 0, false) as tampered
    from given
), ranked as (
    select *, row_number() over (partition by tree order by doc_id nulls first, leaf, id) - 1 as place
    from leaves
), levels as (
    select tree, 0 as level, list(leaf order by place) as row from ranked group by tree
    union all
    select tree, level + 1, list_transform(range((len(row) + 1) // 2), lambda i: sha256(
        row[2 * i + 1] || coalesce(row[2 * i + 2], '')))
    from levels where len(row) > 1
), nodes as (
    select tree, level, unnest(row) as digest, unnest(range(len(row))) as place from levels
), heights as (
    select tree, max(level) as height, arg_max(row[1], level) as subroot,
           row_number() over (order by tree) - 1 as place
    from levels group by tree
), top_levels as (
    select 0 as level, list(subroot order by place) as row from heights
    union all
    select level + 1, list_transform(range((len(row) + 1) // 2), lambda i: sha256(
        row[2 * i + 1] || coalesce(row[2 * i + 2], '')))
    from top_levels where len(row) > 1
), top_nodes as (
    select level, unnest(row) as digest, unnest(range(len(row))) as place from top_levels
), summit as (
    select max(level) as height, arg_max(row[1], level) as root from top_levels
), walk as (
    select id, tree, 0 as level, place, case when tampered then altered else leaf end as now, '' as proof
    from ranked
    union all
    select w.id, w.tree, w.level + 1, w.place // 2,
           sha256(case w.place % 2 when 1 then s.digest || w.now else w.now || coalesce(s.digest, '') end),
           w.proof || coalesce(s.digest, '')
    from walk w join heights h on h.tree = w.tree and w.level < h.height
    left join nodes s on s.tree = w.tree and s.level = w.level and s.place = xor(w.place, 1)
), climb as (
    select w.id, 0 as level, h.place, w.now, w.proof
    from walk w join heights h on h.tree = w.tree and h.height = w.level
    union all
    select c.id, c.level + 1, c.place // 2,
           sha256(case c.place % 2 when 1 then s.digest || c.now else c.now || coalesce(s.digest, '') end),
           c.proof || coalesce(s.digest, '')
    from climb c join summit t on c.level < t.height
    left join top_nodes s on s.level = c.level and s.place = xor(c.place, 1)
)
select r.doc_id, r.leaf, h.subroot, t.root, sha256(c.proof) as proof_sha256, c.now as folded_root,
       c.now = t.root as verified
from ranked r join heights h using (tree) join climb c on c.id = r.id join summit t on t.height = c.level
"""


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_packing": op1_packing,
    "op2_language": op2_language,
    "op3_line_dedup": op3_line_dedup,
    "op4_ngram_join": op4_ngram_join,
    "op5_toxicity": op5_toxicity,
    "op6_embedding_dedup": op6_embedding_dedup,
    "op7_url_filter": op7_url_filter,
    "op8_token_counts": op8_token_counts,
    "op9_quality_rules": op9_quality_rules,
    "op10_bpe": op10_bpe,
    "op11_runs": op11_runs,
    "op12_language_model": op12_language_model,
    "op13_merkle": op13_merkle,
}

ORACLE: dict[str, str] = {
    "op3_line_dedup": OP3_SQL,
    "op6_embedding_dedup": OP6_SQL,
    "op7_url_filter": OP7_SQL,
    "op9_quality_rules": OP9_SQL,
    "op13_merkle": OP13_SQL,
}
