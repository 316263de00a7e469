"""Registered queries of this subpackage and their DuckDB statements.

Each query applies one operator, with production parameters, to its whole
table. Operators without a statement (token files, edit distance, a fitted
classifier, byte-pair encoding) are tested against brute force instead.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from textlab.llm import (decontaminate, kdshards, licenses, linequality, neardup, pieces, records, repair, sitelines,
                         toxicity, trie, urls, warc)

WORD_TOKENIZER, WORD_VOCABULARY, WORD_END = "word_bpe_49k.json", 49_408, 2
PIECE_MODEL = "piece_bpe_32k.model"


def tokenizer_path(name: str) -> str:
    import public_tokenizers
    return str(public_tokenizers.path(name))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = records.token_records(table(spark, sf_dir, "documents"), tokenizer_path(WORD_TOKENIZER),
                                WORD_END, WORD_VOCABULARY, keep_ids=False)
    return out.select("doc_id", "start", "n_tokens", "ids_crc32")


def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge_urls(table(spark, sf_dir, "pages"), urls.rule_table(spark))


def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licenses(table(spark, sf_dir, "documents"))


def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.benchmark_matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive_pages(table(spark, sf_dir, "pages")).drop("url")


def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linequality.clean_lines(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_lines_failed",
        "lost_chars", "base_failed", "kept")


def held_out() -> Column:
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, F.lit(False))


def toxicity_model(spark: SparkSession, docs: DataFrame, sf_dir: str) -> toxicity.Model:
    return toxicity.fit(docs, table(spark, sf_dir, "labels").where(~held_out()))


def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scored = toxicity.score_documents(docs, toxicity_model(spark, docs, sf_dir))
    return scored.select("doc_id", held_out().alias("held_out"), "score", "predicted")


def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return pieces.encode_documents(docs, tokenizer_path(PIECE_MODEL), check=True).drop("text")


def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(table(spark, sf_dir, "documents"), k=3, percent=85).select(
        "doc_id", "n_shingles", "component_id", "kept")


def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sitelines.drop_site_lines(table(spark, sf_dir, "documents")).select(
        "doc_id", "source", F.col("_tl_dropped").alias("n_dropped"), "text")


def damage(rows: DataFrame) -> DataFrame:
    """Conversations with faults planted by crc32 of ``conv_id:turn`` (nulls: one space)."""
    def shown(c: str) -> Column:
        return F.coalesce(F.col(c).cast("string"), F.lit(" "))
    fault = F.crc32(F.concat(shown("conv_id"), F.lit(":"), shown("turn")).cast("binary")) % 20
    text = F.when(fault == 1, F.lit("")).when(fault == 2, F.translate(shown("text"), ".!?", "")).otherwise(shown("text"))
    return (rows.where(fault != 0)
            .select("conv_id", "turn", F.when(fault == 4, F.lit("user")).otherwise(shown("role")).alias("role"),
                    text.alias("text"), F.explode(F.sequence(F.lit(1), F.when(fault == 3, 2).otherwise(1))).alias("copy"))
            .drop("copy"))


def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation, damaged and repaired; one without rows left has no edits."""
    rows = table(spark, sf_dir, "conversations")
    repaired = repair.repair_conversations(damage(rows))
    every = rows.select(F.col("conv_id").alias("id")).distinct()
    out = every.join(repaired, F.col("id").eqNullSafe(F.col("conv_id")), "left").drop("conv_id")
    nothing = hashlib.sha256(b"").hexdigest()
    return out.select(F.col("id").alias("conv_id"),
                      *[F.coalesce(c, F.lit(0)).cast("long").alias(c)
                        for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")],
                      F.coalesce("audit", F.lit("")).alias("audit"),
                      F.coalesce("repaired_sha256", F.lit(nothing)).alias("repaired_sha256"))


def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie.rebased_trie(table(spark, sf_dir, "conversations"))


def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = kdshards.shard_documents(table(spark, sf_dir, "documents"), shards=40)
    return placed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                         F.lit(None).cast("int").alias("grown_shard"))


QUERIES = {
    "op1_token_records": op1, "op2_url_rules": op2, "op3_license_scan": op3, "op4_benchmark_leaks": op4,
    "op5_warc_records": op5, "op6_line_quality": op6, "op7_toxicity": op7, "op8_piece_encoding": op8,
    "op9_near_duplicates": op9, "op10_site_lines": op10, "op11_conversation_repair": op11,
    "op12_conversation_trie": op12, "op13_kd_shards": op13,
}

# ---- DuckDB statements ------------------------------------------------------

_WORD = r"[^\x20\x09-\x0D]+"


def _rules_sql() -> str:
    return ", ".join(f"('{r[:r.index('/')]}', '{r[r.index('/'):]}', '{r}', '{v}')" for r, v in urls.RULES)


_ABC = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"

# The pages name no canonical link and no refresh, so alias groups are those of one spelling.
OP2_SQL = rf"""
with rules(h, p, rule, v) as (values {_rules_sql()}),
u as (select page_id, url,
             translate(coalesce(regexp_extract(url, '^.*?://([^/?#]*)([^?#]*)', 1, 's'), ''), {_ABC}) as host,
             coalesce(regexp_extract(url, '^.*?://([^/?#]*)([^?#]*)', 2, 's'), '') as path,
             coalesce(regexp_extract(url, '^.*?://[^?#]*\?([^#]*)', 1, 's'), '') as query
      from pages),
fit as (select distinct on (page_id) page_id, rule, v
        from u join rules on (host = h or host like '%.' || h) and starts_with(path, p)
        order by page_id, length(rule) desc, rule desc),
form as (select u.*, rule, v,
                regexp_replace(host, '^(www|m)\.', '') || regexp_replace(path, '(\.html)?/*$', '') || '?' ||
                array_to_string(list_sort(list_filter(string_split(query, '&'), lambda x: x <> '' and
                    not regexp_matches(x, '^(utm_[a-z]+|ref|gclid|fbclid)='))), '&') as form
         from u left join fit using (page_id)),
spread as (select form, bool_or(v = 'allow') as allowed, bool_or(v = 'block') as blocked
           from form where url like '%://%' group by form)
select page_id, host, path, rule,
       case when v is not null then v when url not like '%://%' or url is null then 'allow'
            when allowed then 'allow' when blocked then 'block' else 'allow' end as verdict,
       case when rule is not null then 'rule' when url like '%://%' and (allowed or blocked) then 'alias'
            else 'default' end as decided_by
from form left join spread using (form)
"""

def _license_values() -> str:
    rows = []
    for k, (name, text) in enumerate(licenses.TEMPLATES):
        quoted = text.replace("'", "''")
        rows.append(f"({k}, '{name}', '{quoted}')")
    return ", ".join(rows)


OP3_SQL = rf"""
with given(k, license, body) as (values {_license_values()}),
tw as (select k, license, regexp_extract_all(lower(body), '[\p{{L}}\p{{N}}]+') as w from given),
tb as (select k, license, list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) as b from tw),
parts as (select doc_id, string_split(text, chr(10)) as lines, text,
                 regexp_split_to_array(text, '\n[ \t]*\n\s*') as paragraphs
          from documents where text is not null),
listed as (select doc_id, lines || (case when len(paragraphs) > 1 then paragraphs else [] end) || [text] as units from parts),
each as (select doc_id, unnest(units) as unit_text, unnest(range(len(units))) as place from listed),
first as (select doc_id, unit_text, min(place) as place from each group by all),
numbered as (select doc_id, unit_text, row_number() over (partition by doc_id order by place) - 1 as unit from first),
words as (select doc_id, unit, unit_text, regexp_extract_all(lower(unit_text), '[\p{{L}}\p{{N}}]+') as w from numbered),
ub as (select doc_id, unit, unit_text, list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) as b
       from words where len(w) between 2 and 400),
scored as (select doc_id, unit, unit_text, license, len(list_intersect(ub.b, tb.b)) as shared, len(ub.b) as unit_bigrams,
                  len(tb.b) as template_bigrams
           from ub, tb where 3 * len(ub.b) >= 2 * len(tb.b) and 2 * len(ub.b) <= 3 * len(tb.b))
select doc_id, unit::int as unit, license, shared::int as shared, unit_bigrams::int as unit_bigrams,
       template_bigrams::int as template_bigrams, unit_text
from scored where 10 * 2 * shared >= 8 * (unit_bigrams + template_bigrams)
qualify row_number() over (partition by doc_id, unit
                           order by shared * 2.0 / (unit_bigrams + template_bigrams) desc, license) = 1
"""

OP5_SQL = f"""
with p as (select page_id, coalesce(html, '') as body from pages),
d as (select page_id, octet_length(encode(body))::bigint as payload_bytes, sha1(body) as payload_digest from p),
o as (select payload_digest, payload_bytes, max(page_id) as owner from d where payload_bytes >= {warc.MIN_REVISIT} group by all)
select page_id, payload_bytes, payload_digest,
       case when owner is null or owner = page_id then 'response' else 'revisit' end as record_type,
       case when owner <> page_id then owner end as refers_to
from d left join o using (payload_digest, payload_bytes)
"""

_PHRASES = linequality.PHRASE
_CLOSING = linequality.CLOSING.replace("'", "''")

OP6_SQL = rf"""
with t as (select doc_id, coalesce(text, '') as t from documents),
a as (select doc_id, t, regexp_extract_all(t, '{_WORD}') as w,
             list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '{_WORD}')) as l from t),
g as (select doc_id, i, array_to_string(w[i:i + 4], ' ') as gram
      from (select doc_id, w, unnest(range(1, len(w) - 3)) as i from a where len(w) >= 5)),
twice as (select doc_id, i from g qualify count(*) over (partition by doc_id, gram) > 1),
covered as (select doc_id, count(distinct i + j) as n from twice, (select unnest(range(5)) as j) group by doc_id),
b as (select doc_id, t, len(w) as n_words, l,
             list_filter(l, lambda x: regexp_matches(x, '{_CLOSING}')
                 and 20 * (length(x) - length(translate(x, '{linequality.SYMBOLS}', ''))) <= length(x)
                 and not regexp_matches(x, '{linequality.NAVIGATION}')
                 and not regexp_matches(lower(x), '{_PHRASES}')) as ok,
             coalesce(n, 0) as n_repeat_words
      from a left join covered using (doc_id)),
c as (select doc_id, n_words::bigint as n_words,
             length(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g'))::bigint as word_chars,
             (length(t) - length(translate(t, '{linequality.SYMBOLS}', '')))::bigint as n_symbols,
             (len(l) - len(list_distinct(l)))::bigint as n_dup_lines, n_repeat_words::bigint as n_repeat_words,
             len(l)::bigint as n_lines, (len(l) - len(ok))::bigint as n_lines_failed,
             coalesce(list_sum(list_transform(l, lambda x: length(x))), 0)::bigint as total,
             (coalesce(list_sum(list_transform(l, lambda x: length(x))), 0)
              - coalesce(list_sum(list_transform(ok, lambda x: length(x))), 0))::bigint as lost_chars,
             n_words < 10 or 100 * n_repeat_words > 20 * n_words as base_failed
      from b)
select * exclude (total), not base_failed and 2 * lost_chars <= total as kept from c
"""

OP9_SQL = rf"""
with recursive w as (
    select doc_id, regexp_extract_all(translate(coalesce(text, ''), {_ABC}), '{_WORD}') as w from documents),
s as (select doc_id, list_distinct(case when len(w) = 0 then [] when len(w) < 3 then [array_to_string(w, ' ')]
             else list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]) end) as s from w),
n as (select doc_id, len(s)::bigint as n_shingles from s),
e as (select doc_id, unnest(s) as g from s),
met as (select a.doc_id as x, b.doc_id as y, count(*) as i from e a join e b on a.g = b.g and a.doc_id < b.doc_id group by all),
link as (select x, y from met join n p on p.doc_id = x join n q on q.doc_id = y
         where 100 * i >= 85 * (p.n_shingles + q.n_shingles - i)),
edge as (select x, y from link union all select y, x from link),
reach(a, b) as (select doc_id, doc_id from n union select a, y from reach join edge on b = x),
comp as (select a as doc_id, min(b) as component_id from reach group by a)
select doc_id, n_shingles, component_id, doc_id = component_id as kept from n join comp using (doc_id)
"""

OP10_SQL = r"""
with l as (select doc_id, coalesce(source, '') as host, unnest(string_split(text, chr(10))) as line,
                  unnest(range(len(string_split(text, chr(10))))) as pos from documents),
k as (select *, trim(translate(line, chr(9) || chr(13) || chr(11) || chr(12), '    ')) as bare from l),
tot as (select coalesce(source, '') as host, count(*) as pages from documents group by 1),
frequent as (select host, bare, true as is_bad from k join tot using (host) where bare <> '' group by host, bare, pages
        having count(distinct doc_id) >= 2 and count(distinct doc_id) > 0.05::double * pages),
m as (select doc_id, pos, line, coalesce(is_bad, false) as is_bad from k left join frequent using (host, bare)),
r as (select doc_id, count(*) filter (where is_bad) as n_dropped,
             coalesce(string_agg(line, chr(10) order by pos) filter (where not is_bad), '') as cleaned from m group by doc_id)
select doc_id, source, coalesce(n_dropped, 0)::bigint as n_dropped, case when text is not null then cleaned end as text
from documents left join r using (doc_id)
"""

# crc32 byte by byte, and bit by bit within a byte (0xEDB88320 is its fixed polynomial).
_CRC_OF_ID = """xor(4294967295::ubigint, list_reduce(
    list_prepend(4294967295::ubigint, list_transform(string_split(conv_id::varchar, ''), lambda x: ascii(x)::ubigint)),
    lambda c, b: list_reduce(list_prepend(xor(c, b), [0, 0, 0, 0, 0, 0, 0, 0]::ubigint[]),
                             lambda k, z: xor(k >> 1, 3988292384::ubigint * (k & 1)))))"""

OP12_SQL = rf"""
with t as (select conv_id, coalesce(role, '') as role, coalesce(text, '') as text,
                  row_number() over (partition by conv_id order by turn nulls first, role, text) as place
           from conversations where conv_id is not null),
c as (select conv_id, count(*) as own, conv_id - conv_id % 20 as base, ({_CRC_OF_ID} % 4)::bigint as h from t group by conv_id),
p as (select c.*, least(h, coalesce(b.own, 0)) as head from c left join (select conv_id as base, own from c) b using (base)),
r as (select p.conv_id, place as depth, role, text from p join t on t.conv_id = p.base and place <= head
      union all select p.conv_id, head + place - h, role, text from p join t on t.conv_id = p.conv_id and place > h),
k as (select conv_id, depth, len(regexp_extract_all(text, '{_WORD}')) as words,
             md5(string_agg(md5(length(role) || ':' || role || text), '') over (partition by conv_id order by depth)) as key
      from r union all select conv_id, 0, 0, '' from c),
n as (select depth, key, min(conv_id) as conv_id, count(*) as n_convs, any_value(words) as words from k group by depth, key),
up as (select n.*, q.key as parent from n left join k q on q.conv_id = n.conv_id and q.depth = n.depth - 1),
children as (select depth - 1 as depth, parent as key, count(*) as n_children from up where depth > 0 group by all),
own as (select up.*, coalesce(n_children, 0) as n_children from up left join children using (depth, key)),
sums as (select k.depth, k.key, sum(case when n_children = 0 then 1 else 0 end) as n_leaves, sum((n_convs - 1) * own.words) as saved
         from own join k on k.conv_id = own.conv_id and k.depth <= own.depth group by all),
last as (select conv_id, max(depth) as depth from k group by conv_id),
ends as (select depth, key, sha256(string_agg(conv_id::varchar, ',' order by conv_id)) as sha from last join k using (conv_id, depth) group by all)
select own.conv_id, own.depth::bigint as depth, q.conv_id as parent_conv_id, own.n_convs, own.n_children::bigint as n_children,
       n_leaves::bigint as n_leaves, saved::bigint as saved_tokens, coalesce(sha, sha256('')) as ends_sha256
from own join sums using (depth, key) left join ends using (depth, key)
left join n q on q.depth = own.depth - 1 and q.key = own.parent
"""

ORACLE = {"op12_conversation_trie": OP12_SQL, "op2_url_rules": OP2_SQL, "op3_license_scan": OP3_SQL, "op5_warc_records": OP5_SQL,
          "op6_line_quality": OP6_SQL, "op9_near_duplicates": OP9_SQL, "op10_site_lines": OP10_SQL}
