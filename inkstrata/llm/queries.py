"""The registered queries of this subpackage, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from inkstrata.llm import chat, decontaminate, exact_dedup, language, licenses, lm_score, near_dedup, packing, shards, warc
from inkstrata.llm.store import table


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(table(spark, sf_dir, "documents"))


def op3_shard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shards.shard(table(spark, sf_dir, "documents"), 16)


def op4_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents"))


def op5_chat_perspectives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.rotate_perspectives(table(spark, sf_dir, "conversations"))


def op6_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = language.identify(docs.select("doc_id", "text"), language.fit(docs))
    return found.select("doc_id", language.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


def op7_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = lm_score.score_documents(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "n_backoff", F.round("log_score", 3).alias("log_score"))


def op8_warc_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = warc.archive_round_trip(table(spark, sf_dir, "pages"))
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op9_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licenses(table(spark, sf_dir, "documents"))


def op10_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), tokenizer_path())


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {f.__name__: f for f in (op1_decontaminate, op2_exact_dedup, op3_shard, op4_near_duplicates, op5_chat_perspectives, op6_language, op7_lm_score, op8_warc_round_trip, op9_license_scan, op10_pack, pipeline)}

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_ALNUM_WORDS = rf"regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
_SPACED_WORDS = rf"regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^\x20\x09-\x0D]+')"

ORACLE_SQL = {
    "op1_decontaminate": rf"""
with i as (select cast(item_id as varchar) item, w, least(len(w), 13) L from (select item_id, {_ALNUM_WORDS} w from benchmark) where len(w) > 0),
iw as (select distinct item, L, array_to_string(w[s:s + L - 1], ' ') win from (select *, unnest(range(1, len(w) - L + 2)) s from i)),
d as (select row_number() over () r, doc_id, {_ALNUM_WORDS} w from documents),
dw as (select r, s, L, array_to_string(w[s:s + L - 1], ' ') win from (select d.r, d.w, l.L, unnest(range(1, len(d.w) - l.L + 2)) s from d, (select distinct L from iw) l where len(d.w) >= l.L)),
h as (select r, s, dw.L, item from dw join iw on dw.L = iw.L and dw.win = iw.win),
hw as (select r, count(distinct p) n from (select r, unnest(range(s, s + L)) p from (select distinct r, s, L from h)) group by r),
hi as (select r, count(*) n, string_agg(item, ',' order by item) items from (select distinct r, item from h) group by r)
select doc_id, cast(len(w) as bigint) n_words, cast(coalesce(hw.n, 0) as bigint) n_hit, cast(coalesce(hi.n, 0) as bigint) n_items,
  sha256(coalesce(hi.items, '')) items_sha256, coalesce(hw.n, 0) > 0 and 20 * coalesce(hw.n, 0) >= len(w) contaminated
from d left join hw on d.r = hw.r left join hi on d.r = hi.r""",
    "op2_exact_dedup": r"""
select doc_id, min(doc_id) over g keep_id, cast(count(*) over g as bigint) group_size, row_number() over (partition by n order by doc_id) = 1 kept, sha256(n) text_sha256
from (select doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') n from documents) window g as (partition by n)""",
    "op5_chat_perspectives": r"""
with r as (select conv_id, turn, translate(coalesce(role, 'unknown'), '<|>' || chr(13) || chr(10), '_____') role, replace(coalesce(text, ''), '<|', '< |') text, coalesce(cast(floor(turn / 64.0) as bigint), -1) block from conversations),
n as (select *, row_number() over (partition by conv_id, block order by turn, role, text) - 1 n from r),
p as (select *, n // 64 part from n),
q as (select p.*, x.perspective, case when p.role = x.perspective then '<|assistant|>' else '<|user name=' || p.role || '|>' end || chr(10) head from p join (select distinct conv_id, role perspective from p) x on p.conv_id is not distinct from x.conv_id),
o as (select *, coalesce(sum(length(head) + length(text) + 1) over (partition by conv_id, perspective, block, part order by n rows between unbounded preceding and 1 preceding), 0) begins from q)
select conv_id, perspective, block, cast(part as bigint) part, count(*) n_turns, string_agg(head || text || chr(10), '' order by n) rendered,
  coalesce(string_agg(cast(begins + length(head) as bigint) || '-' || cast(begins + length(head) + length(text) as bigint), ',' order by n) filter (role = perspective), '') mask,
  cast(coalesce(sum(length(text)) filter (role = perspective), 0) as bigint) n_masked
from o group by conv_id, perspective, block, part""",
    "op7_lm_score": rf"""
with d as (select row_number() over () r, doc_id, {_SPACED_WORDS} w from documents),
t as (select r, i, w[i] c, case when i > 1 then w[i - 1] end b, case when i > 2 then w[i - 2] end a from (select r, w, unnest(range(1, len(w) + 1)) i from d)),
o1 as (select r, c, count(*) k from t group by all), o2 as (select r, b, c, count(*) k from t where b is not null group by all), o3 as (select r, a, b, c, count(*) k from t where a is not null group by all),
e1 as (select r, c, sum(k) over (partition by c) - k k from o1), e2 as (select r, b, c, sum(k) over (partition by b, c) - k k from o2), e3 as (select r, a, b, c, sum(k) over (partition by a, b, c) - k k from o3),
n as (select r, greatest(1, sum(count(*)) over () - count(*)) n from t group by r),
x as (select t.*, e3.k k3, e2.k k2, e1.k k1, f2.k x3, f1.k x2, cast(n.n as double) n, least(3, i) top from t join n using (r) join e1 on e1.r = t.r and e1.c = t.c left join e2 on e2.r = t.r and e2.b = t.b and e2.c = t.c left join e3 on e3.r = t.r and e3.a = t.a and e3.b = t.b and e3.c = t.c
  left join e2 f2 on f2.r = t.r and f2.b = t.a and f2.c = t.b left join e1 f1 on f1.r = t.r and f1.c = t.b),
s as (select r, count(*) n_words, count(*) filter (not case top when 3 then k3 > 0 when 2 then k2 > 0 else k1 > 0 end) n_backoff,
  sum(case when top = 3 and k3 > 0 then ln(k3 / cast(x3 as double)) when top >= 2 and k2 > 0 then ln(k2 / cast(x2 as double)) + (top - 2) * ln(0.4)
    when k1 > 0 then ln(k1 / n) + (top - 1) * ln(0.4) else top * ln(0.4) - ln(n) end) score from x group by r)
select doc_id, cast(coalesce(n_words, 0) as bigint) n_words, cast(coalesce(n_backoff, 0) as bigint) n_backoff, round(coalesce(score, 0), 3) log_score from d left join s on d.r = s.r""",
    "op8_warc_round_trip": r"""
with q as (select page_id, octet_length(encode(coalesce(html, ''))) n, sha256(coalesce(html, '')) h from pages),
r as (select *, row_number() over (partition by h order by page_id) k, min(page_id) over (partition by h) f from q)
select page_id, cast(n as bigint) payload_bytes, h payload_digest, case when n < 100 or k = 1 then 'response' else 'revisit' end record_type, case when n < 100 or k = 1 then null else f end refers_to from r""",
}
