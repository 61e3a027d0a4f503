"""Registered queries: each applies one operator to the whole of its table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kestrel.llm import bpe, decontaminate, filter_audit, hard_negatives, html_text, langid, licenses, lm_scores, near_dups, pii, quality, repeats, toxicity
from kestrel.llm.batches import table


def op1_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of every document."""
    return near_dups.near_duplicates(table(spark, sf_dir, "documents"))


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, item_id, edits, end_char) of every document that holds a test item, within 5 % edits."""
    return decontaminate.matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept) of every document."""
    return quality.judge(table(spark, sf_dir, "documents")).drop("rejected_by")


def op4_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(page_id, url, text, n_chars) of every page."""
    return html_text.extract(table(spark, sf_dir, "pages")).withColumn("n_chars", F.length("text").cast("long"))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, severity, grade, toxic) of every document."""
    docs = table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def bpe_files() -> tuple[str, str]:
    """Rank file and pre-splitting pattern of the public multilingual vocabulary."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN


def op6_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of every document, decoded from its ids."""
    files = bpe_files()
    both = bpe.encode_and_decode(table(spark, sf_dir, "documents"), *files)
    return both.select("doc_id", F.expr("octet_length(token_ids) div 4").alias("n_tokens"),
                       F.sha2("token_ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans) of every document."""
    shown = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    return pii.find(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_email", "n_ip", "n_card", "n_phone", F.sha2(shown("base"), 256).alias("base_sha256"), shown("spans").alias("spans"))


def op8_repeated_strings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) of every document."""
    return repeats.without_repeats(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def held_out() -> Column:
    """True for the documents that language models are never fitted on."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False))


def op9_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, held_out, lang_pred, score) of every document; fitted on those not held out."""
    docs = table(spark, sf_dir, "documents")
    model = langid.fit(docs.where(~held_out()))
    return langid.predict(docs, model).select("doc_id", held_out().alias("held_out"), "lang_pred", "score")


def op10_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, licence, score) of every document."""
    return licenses.scan(table(spark, sf_dir, "documents"))


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley) per source."""
    return filter_audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op12_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) of every document."""
    learned = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 7 != 2, F.lit(True))
    return lm_scores.score(table(spark, sf_dir, "documents"), learned, *bpe_files())


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) of every 100th vector."""
    rows = hard_negatives.integer_vectors(table(spark, sf_dir, "embeddings"))
    # labels disagree on purpose: some of each class pass for the next one
    mixed = rows.withColumn("label", F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")))
    return hard_negatives.mine(mixed, F.col("vec_id") % 100 == 0)


OP1_SQL = r"""
with recursive d as (select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') as ws from documents),
sh as (select distinct doc_id, array_to_string(list_slice(ws, i, i + 4), ' ') as k from d, unnest(range(1, greatest(len(ws) - 3, 2))) t(i) where len(ws) > 0),
n as (select doc_id, count(*) as n from sh group by doc_id),
x as (select a.doc_id as a, b.doc_id as b, count(*) as c from sh a join sh b on a.k = b.k and a.doc_id <> b.doc_id group by 1, 2),
e as (select a, b from x join n p on p.doc_id = a join n q on q.doc_id = b where 100 * c >= 75 * (p.n + q.n - c)),
r(a, b) as (select doc_id, doc_id from d union select r.a, e.b from r join e on r.b = e.a)
select doc_id, coalesce(n.n, 0)::bigint as n_shingles, f.c as component_id, doc_id = f.c as kept
from d left join n using (doc_id) join (select a as doc_id, min(b) as c from r group by a) f using (doc_id)"""


def op10_sql() -> str:
    """Dice over word bigrams of lines, paragraphs and whole texts, against the templates as values."""
    rows = ", ".join("({}, {}, {})".format(i, *("'" + x.replace("'", "''") + "'" for x in t)) for i, t in enumerate(licenses.TEMPLATES))
    return rf"""
with d as (select doc_id, coalesce(text, '') as text from documents),
u as (select doc_id, unnest(string_split(text, chr(10))) as t from d
  union all select doc_id, unnest(regexp_split_to_array(text, '\n[^\S\n]*\n')) from d union all select doc_id, text from d),
w as (select row_number() over () as u, doc_id, regexp_extract_all(lower(t), '[\p{{L}}\p{{N}}]+') as ws from u),
g as (select u, doc_id, ws[i] as x, ws[i + 1] as y, count(*) as n, any_value(len(ws) - 1) as a from w, unnest(range(1, len(ws))) s(i) group by all),
tw as (select i, name, regexp_extract_all(lower(t), '[\p{{L}}\p{{N}}]+') as ws from (values {rows}) v(i, name, t)),
tg as (select i, name, ws[j] as x, ws[j + 1] as y, count(*) as n, any_value(len(ws) - 1) as b from tw, unnest(range(1, len(ws))) s(j) group by all),
m as (select doc_id, u, i, name, 2 * sum(least(g.n, tg.n)) / (any_value(a) + any_value(b)) as dice from g join tg using (x, y) group by all),
best as (select doc_id, name, dice from m where dice >= 0.8 qualify row_number() over (partition by doc_id order by dice desc, name) = 1)
select doc_id, name as licence, coalesce(dice, 0)::double as score from d left join best using (doc_id)"""


#: The order of the cascade doesn't change its verdict, so the oracle names the rules in any order.
OP3_SQL = r"""
with d as (select row_number() over () as r, doc_id, coalesce(text, '') as text from documents),
w as (select r, doc_id, text, regexp_extract_all(text, '[^\x20\x09-\x0D]+') as ws,
        list_filter(string_split(text, chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) as ls from d),
c as (select r, doc_id, ws, len(ws) as n_words, coalesce(length(array_to_string(ws, '')), 0) as word_chars,
        length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) as n_symbols, len(ls) as n_lines,
        len(ls) - len(list_distinct(ls)) as n_dup_lines, length(regexp_replace(text, '[^!]', '', 'g')) as n_shouts,
        length(regexp_replace(text, '\P{Lu}', '', 'g')) as n_upper, length(regexp_replace(text, '\P{L}', '', 'g')) as n_letters,
        len(list_filter(ws, lambda x: regexp_matches(x, '\p{L}'))) as n_lettered from w),
win as (select r, i, array_to_string(list_slice(ws, i, i + 4), ' ') as k from c, unnest(range(1, len(ws) - 3)) t(i)),
twice as (select r, i from win qualify count(*) over (partition by r, k) > 1),
rep as (select r, count(distinct i + j) as n from twice, range(0, 5) o(j) group by r),
st as (select r, count(*) as n from (select r, unnest(range(2, len(ws) + 1)) as i, ws from c) where ws[i] = ws[i - 1] group by r),
a as (select c.*, coalesce(rep.n, 0) as n_repeat_words, coalesce(st.n, 0) as n_stutter from c left join rep using (r) left join st using (r)),
b as (select *, n_words < 10 or 100 * n_repeat_words > 20 * n_words as base_failed from a)
select doc_id, n_words::bigint as n_words, word_chars::bigint as word_chars, n_symbols::bigint as n_symbols, n_dup_lines::bigint as n_dup_lines,
  n_repeat_words::bigint as n_repeat_words, base_failed,
  not (base_failed or n_symbols * 10 > n_words or n_dup_lines * 100 > n_lines * 40 or not (word_chars between n_words * 2 and n_words * 12)
    or n_shouts * 10 > n_words * 3 or n_upper * 2 > n_letters or n_lettered * 2 < n_words or n_stutter * 10 > n_words * 2) as kept
from b"""

OP11_SQL = r"""
with d as (select doc_id, coalesce(source, '') as part, coalesce(text, '') as text,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as ws from documents),
m as (select text, min(doc_id) as first from d group by text),
l as (select doc_id, max((quality = 1)::int) as good, max((toxic = 1)::int) as toxic from labels group by doc_id),
f as (select part, coalesce(good, 0) = 1 as good, coalesce(toxic, 0) = 1 as toxic,
    (len(ws) < 50)::int + 2 * (100 * len(list_distinct(ws)) < 65 * len(ws))::int
    + 4 * (100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 5 * length(text))::int
    + 8 * regexp_matches(text, '[#$%&*|]')::int + 16 * coalesce(doc_id > first, false)::int as fails
  from d join m using (text) left join l using (doc_id)),
c(i, x) as (values (0, 'A'), (1, 'B'), (2, 'C'), (3, 'D'), (4, 'E')),
o as (select a.x || b.x || c.x || d.x || e.x as filter_order, [a.i, b.i, c.i, d.i, e.i] as fs
  from c a, c b, c c, c d, c e where len(list_distinct([a.i, b.i, c.i, d.i, e.i])) = 5),
s as (select filter_order, k::int as step, (1 << fs[k])::int as own, coalesce(list_sum(list_transform(fs[1:k - 1], lambda i: 1 << i)), 0)::int as before
  from o, range(1, 6) t(k)),
g as (select part, fails, good, toxic, count(*) as n from f group by all),
r as (select part, filter_order, step, own, coalesce(sum(n) filter ((fails & (before | own)) = 0), 0) as kept,
    coalesce(sum(n) filter ((fails & before) = 0 and (fails & own) > 0), 0) as removed,
    coalesce(sum(n) filter ((fails & before) > 0 and (fails & own) > 0), 0) as redundant,
    coalesce(sum(n) filter (fails = own), 0) as unique_fails,
    coalesce(sum(n) filter ((fails & before) = 0 and (fails & own) > 0 and good), 0) as good_lost,
    coalesce(sum(n) filter ((fails & before) = 0 and (fails & own) > 0 and toxic), 0) as toxic_lost
  from g, s group by part, filter_order, step, own)
select part, filter_order, step, kept::bigint as kept, removed::bigint as removed, redundant::bigint as redundant, unique_fails::bigint as unique_fails,
  good_lost::bigint as good_lost, toxic_lost::bigint as toxic_lost, (sum(removed) over (partition by part, own))::bigint as shapley from r"""


OP13_SQL = """
with v as (select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
    list_transform(embedding, lambda x: floor(256 * x::double)) as v from embeddings
  where label is not null and embedding is not null and not list_contains(list_transform(embedding, lambda x: coalesce(not isfinite(x), true)), true)),
s as (select a.vec_id as a, b.vec_id as b, a.label = b.label as same, list_dot_product(a.v, b.v)::bigint as score
  from v a join v b on a.vec_id % 100 = 0 and a.vec_id <> b.vec_id),
p as (select a, b, score from s where same qualify row_number() over (partition by a order by score desc, b) <= 5),
n as (select p.a, p.b as pos, p.score as ps, s.b as neg, s.score as ns, row_number() over (partition by p.a, p.b order by s.score desc, s.b) as rank
  from p join s on s.a = p.a and not s.same and 80 * p.score <= 100 * s.score and s.score <= p.score)
select a as anchor_id, pos as positive_id, rank::int as rank, neg as negative_id, ps as positive_score, ns as negative_score from n where rank <= 5"""

QUERIES = {f.__name__: f for f in (op1_near_duplicates, op2_decontamination, op3_quality_rules, op4_html_text, op5_toxicity, op6_bpe, op7_pii, op8_repeated_strings, op9_language, op10_licenses,
                                   op11_filter_audit, op12_lm_scores, op13_hard_negatives)}
ORACLE: dict[str, str] = {"op1_near_duplicates": OP1_SQL, "op10_licenses": op10_sql(), "op3_quality_rules": OP3_SQL,
                          "op11_filter_audit": OP11_SQL, "op13_hard_negatives": OP13_SQL}
