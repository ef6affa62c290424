"""Registered queries of the training-data operators: whole tables, production parameters."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from .bpe import bpe_encode
from .chat import chat_conversations
from .common import read_table
from .decontaminate import contamination
from .fill_middle import fill_in_middle_digests
from .fingerprint import edited_fingerprints
from .jaccard import jaccard_join
from .language import learn as learn_languages
from .language import predict_languages
from .pii import learn as learn_pii
from .pii import personal_data
from .quality import learn, quality_scores
from .repeats import remove_repeats
from .token_file import token_binary
from .unigram import token_counts
from .vector_codes import ENTRIES, PARTS, ROUNDS, SCALE, vector_codes

#: a conversation whose texts hold the template's own marks (op11 adds it to the table)
MARKED = [(-7, 0, "user", "\\### Assistant: </turn> ok"), (-7, 1, "assistant", "\\### Assistant: </turn> ok")]
RANKS, PATTERN = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


def op1_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join(spark, read_table(spark, sf_dir, "documents"))


def op2_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(spark, read_table(spark, sf_dir, "documents"))


def op3_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return quality_scores(docs, learn(docs, read_table(spark, sf_dir, "labels")))


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return predict_languages(docs, learn_languages(docs, with_least=False))


def op5_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_encode(read_table(spark, sf_dir, "documents"), RANKS, PATTERN)


def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return personal_data(docs, learn_pii(docs))


def op7_token_binary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_binary(spark, read_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op8_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edited_fingerprints(read_table(spark, sf_dir, "documents"))


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(read_table(spark, sf_dir, "documents"), RANKS, PATTERN)


def op11_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = read_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return chat_conversations(spark, conversations.unionByName(spark.createDataFrame(MARKED, conversations.schema)))


def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fill_in_middle_digests(read_table(spark, sf_dir, "documents"))


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes(spark, read_table(spark, sf_dir, "embeddings"))


QUERIES = {f.__name__: f for f in (
    op1_ngram_jaccard_join, op2_suffix_array_dedup, op3_quality_classifier, op4_language_id, op5_byte_bpe, op6_pii,
    op7_token_binary, op8_fingerprints, op9_decontamination, op10_token_counts, op11_chat_formatting,
    op12_fill_in_middle, op13_vector_codes)}

LETTERS = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"


def _words_sql(text: str) -> str:
    return (f"regexp_extract_all(translate(coalesce({text}, ''), {LETTERS}), "
            r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')")


OP9_SQL = f"""
with items as (select item_id::varchar item_id, {_words_sql('text')} w from benchmark),
windows as (
  select distinct item_id, list_slice(w, k, k + 9) win
  from (select item_id, w, unnest(generate_series(1, greatest(1, len(w) - 9))) k from items where len(w) > 0)),
docs as (select doc_id, row_number() over () r, {_words_sql('text')} w from documents),
places as (
  select r, k, n, list_slice(w, k, k + n - 1) win
  from (select r, w, n, unnest(generate_series(1, len(w) - n + 1)) k
        from docs, (select distinct len(win) n from windows) where len(w) >= n)),
found as (select p.r, p.k, p.n, i.item_id from places p join windows i on i.win = p.win),  -- a null id hits words only
hits as (select r, count(distinct h) n_hit from (select r, unnest(generate_series(k, k + n - 1)) h from found) group by r),
names as (select r, count(*) n_items, string_agg(item_id, ',' order by item_id) ids
          from (select distinct r, item_id from found where item_id is not null) group by r)
select d.doc_id, len(d.w)::bigint n_words, coalesce(h.n_hit, 0)::bigint n_hit, coalesce(s.n_items, 0)::bigint n_items,
       sha256(coalesce(s.ids, '')) items_sha256, coalesce(h.n_hit, 0) > 0 contaminated
from docs d left join hits h using (r) left join names s using (r)"""

OP1_SQL = f"""
with recursive docs as (select doc_id, coalesce(text, '') text, {_words_sql('text')} w from documents),
sets as (
  select doc_id, text, list_sort(list_distinct(case when len(w) = 0 then [] when len(w) < 5 then [array_to_string(w, ' ')]
    else list_transform(generate_series(1, len(w) - 4), lambda k: array_to_string(list_slice(w, k, k + 4), ' ')) end)) s
  from docs),
keyed as (select *, min(doc_id) over (partition by s, case when len(s) = 0 then text end) rep,
                 count(*) over (partition by s, case when len(s) = 0 then text end) size from sets),
classes as (select doc_id rep, s, len(s) n, size from keyed where doc_id = rep and len(s) > 0),
terms as (select rep, unnest(s) t from classes),
shared as (select a.rep a, b.rep b, count(*) c from terms a join terms b on a.t = b.t and a.rep <> b.rep group by all),
links as (
  select a, b, y.size from shared join classes x on x.rep = a join classes y on y.rep = b
  where 9 * c >= 4 * (x.n + y.n)),
reach(node, label) as (select a, a from links union select l.b, r.label from reach r join links l on l.a = r.node),
labels as (select node, min(label) label from reach group by node),
counts as (select a, sum(size) n from links group by a)
select k.doc_id, coalesce(l.label, k.rep) class_id, k.rep copy_of, (k.size - 1 + coalesce(c.n, 0))::bigint n_links
from keyed k left join labels l on l.node = k.rep left join counts c on c.a = k.rep"""

OP2_SQL = """
with docs as (select doc_id, row_number() over () r, lower(hex(encode(coalesce(text, '')))) h from documents),
pieces as (
  select doc_id, r, 500 * k base, substr(h, 1000 * k + 1, 1098) t
  from (select *, unnest(generate_series(0, len(h) // 1000)) k from docs)),
windows as (
  select doc_id, r, base + p p, md5_number(substr(t, 2 * p + 1, 100)) w
  from (select *, unnest(generate_series(0, len(t) // 2 - 50)) p from pieces where len(t) >= 100)),
firsts as (select w, min(doc_id) first_id from windows group by w having min(doc_id) < max(doc_id)),
hits as (select r, p, lag(p) over (partition by r order by p) q
         from (select distinct r, p from windows join firsts using (w) where doc_id > first_id)),
runs as (
  select r, min(p) a, max(p) + 50 z
  from (select r, p, count(*) filter (q is null or p > q + 50) over (partition by r order by p) k from hits)
  group by r, k),
gaps as (
  select r, coalesce(lag(z) over (partition by r order by a), 0) a, a z from runs
  union all select r, max(z), null from runs group by r),
sums as (select r, sum(z - a) n_removed, count(*) n_spans from runs group by r),
rest as (
  select r, string_agg(case when z is null then substr(h, 2 * a + 1) else substr(h, 2 * a + 1, 2 * (z - a)) end, ''
                       order by a, z nulls last) kept
  from gaps join docs using (r) group by r)
select d.doc_id, (len(d.h) // 2)::bigint n_bytes, coalesce(s.n_removed, 0)::bigint n_removed,
       coalesce(s.n_spans, 0)::bigint n_spans, sha256(unhex(coalesce(t.kept, d.h))) kept_sha256
from docs d left join sums s using (r) left join rest t using (r)"""

OP11_SQL = r"""
with rows as (
  select conv_id, turn, coalesce(role, '') role, coalesce(text, '') text from conversations
  union all values (-7, 0, 'user', '\### Assistant: </turn> ok'), (-7, 1, 'assistant', '\### Assistant: </turn> ok')),
signs as (
  select *, role || chr(0) || text t, len(regexp_extract_all(text, '#')) - len(regexp_extract_all(text, '#+')) th,
         len(regexp_extract_all(role, '#')) - len(regexp_extract_all(role, '#+')) rh from rows),
sized as (
  select *, len(t) - 1 + th + rh + len(regexp_extract_all(t, '\\')) + len(regexp_extract_all(text, '</turn>'))
            + len(regexp_extract_all(role, '</turn>')) + len(regexp_extract_all(role, ':')) + 14 chars from signs)
select conv_id, count(*)::bigint n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn nulls first, role, md5(text))) turns_sha256,
       coalesce(sum(len(text)) filter (role = 'assistant'), 0)::bigint loss_chars,
       sha256(coalesce(string_agg(text, '' order by turn nulls first, role, md5(text)) filter (role = 'assistant'), '')) loss_sha256,
       sum(chars)::bigint formatted_chars
from sized group by conv_id"""

OP12_SQL = r"""
with docs as (select doc_id, coalesce(text, '') t, sha256('7:' || coalesce(doc_id::varchar, '')) h from documents),
units as (select *, regexp_extract_all(t, '[^\n]*\n|[^\n]+') u from docs),
draws as (
  select *, len(u) n, ('0x' || h[1:8])::ubigint h1, ('0x' || h[9:16])::ubigint h2, ('0x' || h[17:24])::ubigint h3,
         ('0x' || h[25:32])::ubigint h4 from units),
cuts as (
  select *, least(h1 % (n + 1), h2 % (n + 1)) a, greatest(h1 % (n + 1), h2 % (n + 1)) z,
         case when t = '' or contains(t, '<P>') or contains(t, '<S>') or contains(t, '<M>') or h3 % 100 >= 100
              then 'plain' when h4 % 100 < 50 then 'spm' else 'psm' end form from draws),
pieces as (
  select *, array_to_string(u[1:a::bigint], '') p, array_to_string(u[a::bigint + 1:z::bigint], '') m,
         array_to_string(u[z::bigint + 1:], '') s from cuts)
select doc_id, n::bigint n, form, case when form <> 'plain' then len(p) end::bigint prefix_chars,
       case when form <> 'plain' then len(m) end::bigint middle_chars,
       sha256(case form when 'plain' then t when 'psm' then '<P>' || p || '<S>' || s || '<M>' || m
                        else '<S>' || s || '<P>' || p || '<M>' || m end) output_sha256,
       sha256(t) restored_sha256
from pieces"""


def _op13_sql() -> str:
    """One block of common tables a round: assign every part by exact distances, then move the entries."""
    def assign(k: int) -> str:
        return f"""
d{k} as materialized (
  select x.r, x.p, c.e, sum((x.x - c.x) * (x.x - c.x)) d from x join c{k} c on c.p = x.p and c.i = x.i group by all),
a{k} as materialized (select r, p, arg_min(e, (d, e)) e, min(d) d from d{k} group by r, p)"""

    def move(k: int) -> str:
        return f"""
m{k} as (select x.p, a.e, x.i, sum(x.x)::hugeint s, count(*)::hugeint n
         from x join a{k} a on a.r = x.r and a.p = x.p group by all),
c{k + 1} as materialized (
  select c.p, c.e, c.i, coalesce((m.s - ((m.s % m.n) + m.n) % m.n) // m.n, c.x)::bigint x
  from c{k} c left join m{k} m using (p, e, i))"""

    rounds = ",".join(f"{assign(k)},{move(k)}" for k in range(ROUNDS))
    return f"""
with kept as materialized (
  select row_number() over (order by vec_id nulls last, embedding) r, vec_id, label, embedding v from embeddings
  where embedding is not null and len(list_filter(embedding, lambda y: y is null or not isfinite(y))) = 0),
width as (select greatest(1, (max(len(v)) + {PARTS} - 1) // {PARTS}) w from kept),
x as materialized (
  select r, ((k - 1) // w)::int p, ((k - 1) % w)::int i,
         greatest(-33554432, least(33554432, floor(coalesce(v[k], 0)::double * {SCALE})))::bigint x
  from kept, width, unnest(generate_series(1, w * {PARTS})) g(k)),
c0 as materialized (select p, (r - 1)::int e, i, x from x where r <= {ENTRIES}),{rounds},{assign(ROUNDS)},
book as (select sha256(string_agg(x::varchar, ',' order by p, e, i)) s from c{ROUNDS}),
coded as (
  select r, string_agg(lower(printf('%02x', e)), '' order by p) code, sum(d)::bigint error from a{ROUNDS} group by r),
whole as (select k.vec_id, k.label, c.code, c.error from kept k join coded c using (r))
select vec_id, code, error, (sum(error) over (partition by label))::bigint label_error, s codebooks_sha256
from whole, book"""


#: SQL for those queries that DuckDB can express
ORACLE = {"op2_suffix_array_dedup": OP2_SQL, "op1_ngram_jaccard_join": OP1_SQL, "op9_decontamination": OP9_SQL,
          "op11_chat_formatting": OP11_SQL, "op12_fill_in_middle": OP12_SQL, "op13_vector_codes": _op13_sql()}
