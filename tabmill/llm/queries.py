"""The registered queries of the training-data operators, and their SQL where SQL can express them."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabmill.llm import line_frequency as lf
from tabmill.llm import (arc_convert, bpe_bitmap, conversation_repair, html_consensus, line_runs, mix_hierarchy, prefix_forest, token_counts,
                         whitening, window_dedup)
from tabmill.llm import chat_parts as cp
from tabmill.llm import minhash_icws as mh
from tabmill.llm.common import read

QUERIES: dict = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(f):
        QUERIES[name] = f
        if sql:
            ORACLE[name] = sql
        return f
    return register


WS_SQL = r"[\x20\x09-\x0D]+"

OP7_SQL = rf"""
with d as (select row_number() over () rid, doc_id, coalesce(source, '') host, coalesce(text, '') text from documents),
w as (select *, list_filter(string_split_regex(text, '{WS_SQL}'), lambda x: x <> '') w,
  list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) raw from d),
win as (select rid, i, list_aggregate(list_slice(w, i, i + 4), 'string_agg', chr(10)) g
  from (select rid, w, unnest(range(1, len(w) - 3)) i from w where len(w) >= 5)),
rep as (select rid, i from (select rid, i, count(*) over (partition by rid, g) c from win) where c >= 2),
rw as (select rid, sum(least(5, coalesce(nx - i, 5))) n from
  (select rid, i, lead(i) over (partition by rid order by i) nx from rep) group by rid),
ln as (select rid, host, text, regexp_replace(lower(trim(regexp_replace(l, '{WS_SQL}', ' ', 'g'))), '[0-9]', '0', 'g') k
  from (select rid, host, text, unnest(raw) l from w)),
hd as (select host, count(distinct text) docs from d group by host),
fr as (select host, k from (select host, k, count(distinct text) n from ln group by host, k) join hd using (host)
  where n > {lf.MIN_DOCS} and n > docs * {lf.SHARE}),
lost as (select rid, sum(len(string_split(k, ' '))) lost from ln join fr using (host, k) group by rid),
o as (select doc_id, len(w)::bigint n_words, len(regexp_replace(text, '{WS_SQL}', '', 'g'))::bigint word_chars,
  len(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::bigint n_symbols, (len(raw) - len(list_distinct(raw)))::bigint n_dup_lines,
  coalesce(n, 0)::bigint n_repeat_words, coalesce(lost, 0)::bigint lost from w left join rw using (rid) left join lost using (rid))
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  (not base_failed and n_words - lost >= {lf.MIN_LEFT} and n_words - lost >= {lf.MIN_LEFT_SHARE} * n_words) kept,
  (n_words - lost)::bigint left_words
from (select *, (n_words < 10 or 100 * n_repeat_words > 20 * n_words) base_failed from o)
"""


@query("op7_line_frequency", OP7_SQL)
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    verdicts, _ = lf.line_frequency(read(spark, sf_dir, "documents"))
    return verdicts.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                           "base_failed", "kept", "left_words")


OP4_SQL = rf"""
with recursive d as (select doc_id, string_split(coalesce(text, ''), chr(10)) raw from documents),
l0 as (select doc_id, unnest(raw) s, unnest(range(0, len(raw))) line from d),
l as (select doc_id, line, k, len(string_split(k, ' ')) n, row_number() over (partition by doc_id order by line) pos
  from (select doc_id, line, lower(trim(regexp_replace(s, '{WS_SQL}', ' ', 'g'))) k from l0) where k <> ''),
c as (select *, sum(n) over (partition by doc_id order by pos) upto from l),
f as (select a.doc_id, a.pos, min(b.pos) last from c a join c b on a.doc_id = b.doc_id and b.pos >= a.pos
  and b.upto - a.upto + a.n >= {line_runs.MIN_WORDS} group by 1, 2),
g as (select b.doc_id, max(a.pos) pos, b.pos last from c a join c b on a.doc_id = b.doc_id and b.pos >= a.pos
  and b.upto - a.upto + a.n >= {line_runs.MIN_WORDS} group by 1, 3),
r as (select r.doc_id, r.pos, r.last, string_agg(c.k, chr(10) order by c.pos) body from
  (select * from f union select doc_id, pos, last from g) r
  join c on c.doc_id = r.doc_id and c.pos between r.pos and r.last group by 1, 2, 3),
x as (select *, row_number() over (partition by body order by doc_id, pos) nth from r),
z as (select distinct c.doc_id, c.line from x join c on c.doc_id = x.doc_id and c.pos between x.pos and x.last where nth > 1),
k as (select l0.doc_id, l0.line, l0.s, z.line is not null gone from l0 left join z on z.doc_id = l0.doc_id and z.line = l0.line)
select doc_id, count(*)::int n_lines, (count(*) filter (where gone))::int n_gone,
  coalesce(list(line order by line) filter (where gone), []) gone,
  md5(coalesce(string_agg(s, chr(10) order by line) filter (where not gone), '')) text_md5 from k group by doc_id
"""


@query("op4_line_runs", OP4_SQL)
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = line_runs.dedup_lines(read(spark, sf_dir, "documents"))
    gone = F.coalesce("_gone", F.array().cast("array<int>"))
    text = F.coalesce("text", F.lit(""))
    return out.select("doc_id", (F.size(F.split(text, "\n")) + F.size(gone) - ((text == "") & (F.size(gone) > 0)).cast("int")).alias("n_lines"),
                      F.size(gone).alias("n_gone"), gone.alias("gone"), F.md5(text).alias("text_md5"))


@query("op6_near_duplicates")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mh.near_duplicates(read(spark, sf_dir, "documents")).select("doc_id", "class_id")


@query("op8_token_counts")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(read(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


@query("op10_byte_bpe")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_bitmap.round_trip(read(spark, sf_dir, "documents"),
                                 public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)


#: Targets of the mix: domains, languages within a domain; sources share alike.
MIX_WEIGHTS = {1: {("domain0",): 4.0, ("domain1",): 3.0, ("domain2",): 2.0, ("domain3",): 1.0},
               2: {("en",): 5.0, ("fr",): 2.0, ("de",): 2.0, ("es",): 1.0}}
MIX_SHARE, MIX_EPOCHS = 0.8, 2


def mix_levels() -> dict:
    """domain: the number at the end of the source's name, modulo 4; a source without one is in domain0."""
    number = F.coalesce(F.regexp_extract("source", "([0-9]{1,9})$", 1).try_cast("long"), F.lit(0))
    return {"domain": F.concat(F.lit("domain"), (number % 4).cast("string")), "lang": F.col("lang"), "source": F.col("source")}


def _mix_sql() -> str:
    case = lambda c, d: f"case {c} " + " ".join(f"when '{k[0]}' then {w}::double" for k, w in MIX_WEIGHTS[d].items()) + " else 1.0::double end"
    levels, family, steps = ["domain", "lang", "source"], "", []
    for i, name in enumerate(levels):
        path, up = ", ".join(levels[:i + 1]), ", ".join(["0", *levels[:i]])
        w = case(name, i + 1) if i < 2 else "1.0::double"
        parent = "cross join b0" if i == 0 else f"join b{i} using ({family})"
        steps.append(f"""
n{i} as (select {path}, cap, w, pb, cap / w ratio from (select {path}, sum(cap) cap, {w} w from leaf group by {path})
  join (select {family + ', ' if i else ''}budget pb from b{i}) using ({family}))""".replace("using ()", "on true") + f""",
l{i} as (select *, (pb - coalesce(sum(cap) over (partition by {up} order by ratio, {name} rows between unbounded preceding and 1 preceding), 0))
  / sum(w) over (partition by {up} order by ratio, {name} rows between current row and unbounded following) lvl from n{i}),
b{i + 1} as (select {path}, case when cap <= w * lvl then cap::double else greatest(w * max(case when cap > w * lvl then lvl end)
  over (partition by {up}), 0.0) end budget from l{i})""")
        family = path
    return f"""
with d as (select doc_id, coalesce(lang, '') lang, coalesce(source, '') source,
  'domain' || (coalesce(try_cast(regexp_extract(source, '([0-9]{{1,9}})$', 1) as bigint), 0) % 4) as domain,
  len(list_filter(string_split_regex(coalesce(text, ''), '{WS_SQL}'), lambda x: x <> ''))::bigint n_tokens from documents),
leaf as (select domain, lang, source, sum(n_tokens)::bigint t, sum(n_tokens)::bigint * {MIX_EPOCHS} cap from d group by all),
b0 as (select least(sum(t) * {MIX_SHARE}::double, sum(cap)::double) budget from leaf), {','.join(steps)},
p as (select domain, lang, source, floor(budget / t + 1e-9)::bigint f, floor(budget - floor(budget / t + 1e-9) * t + 1e-6)::bigint rest
  from leaf join b3 using (domain, lang, source) where t > 0),
o as (select d.*, f, rest, ('0x' || substr(md5(doc_id || ':{mix_hierarchy.SEED}:' || f), 1, 15))::bigint h from d join p using (domain, lang, source)),
c as (select *, sum(n_tokens) over (partition by domain, lang, source order by h, doc_id) upto from o)
select doc_id, domain, lang, source, n_tokens, unnest(range(0, f + (case when rest > 0 and upto <= rest then 1 else 0 end)))::int epoch from c
"""


@query("op2_mix_hierarchy", _mix_sql())
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = mix_hierarchy.mix(read(spark, sf_dir, "documents"), mix_levels(), MIX_WEIGHTS, MIX_SHARE, MIX_EPOCHS)
    return out.select("doc_id", F.col("_domain").alias("domain"), F.col("_lang").alias("lang"), F.col("_source").alias("source"),
                      F.col("_tokens").alias("n_tokens"), F.col("_epoch").alias("epoch"))


OP5_SQL = r"""
with c as (select conv_id, turn, coalesce(role, '') role, coalesce(text, '') body from conversations
  union all select -1, 0, 'user', '<|im_end|><|im_start|>assistant ok' union all select -1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok'),
e as (select *, replace(replace(replace(role, '\', '\\'), '<|', '<\|'), chr(10), '\n') er, replace(replace(body, '\', '\\'), '<|', '<\|') et from c)
select conv_id, count(*)::bigint n_turns, sha256(string_agg(role || chr(10) || body || chr(10), '' order by turn)) turns_sha256,
  coalesce(sum(len(body)) filter (where role = 'assistant'), 0)::bigint loss_chars,
  sha256(coalesce(string_agg(body, '' order by turn) filter (where role = 'assistant'), '')) loss_sha256,
  sum(len('<|im_start|>') + len(er) + 1 + len(et) + len('<|im_end|>') + 1)::bigint formatted_chars from e group by conv_id
"""


@query("op5_chat_parts", OP5_SQL)
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = "<|im_end|><|im_start|>assistant ok"
    rows = read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    rows = rows.unionByName(spark.createDataFrame([(-1, 0, "user", own), (-1, 1, "assistant", own)], rows.schema))
    done = cp.format_conversations(rows.select("conv_id", "turn", "role", cp.text_part(F.col("text")).alias("parts")))
    back = done.select("conv_id", "formatted", cp.read_turns(F.col("formatted")).alias("t"),
                       cp.masked_text(F.col("formatted"), F.col("loss_spans")).alias("loss"))
    return back.select("conv_id", F.size("t").cast("long").alias("n_turns"),
                       F.sha2(F.array_join(F.transform("t", lambda x: F.concat(x["role"], F.lit("\n"), x["text"], F.lit("\n"))), ""), 256).alias("turns_sha256"),
                       F.length("loss").cast("long").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"),
                       F.length("formatted").cast("long").alias("formatted_chars"))


@query("op9_arc_convert")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return arc_convert.pages_through_warc(read(spark, sf_dir, "pages"))


@query("op3_html_consensus")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_consensus.main_text(read(spark, sf_dir, "pages"))


@query("op1_prefix_forest")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_forest.neighbours(read(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


@query("op11_whitening")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(read(spark, sf_dir, "embeddings"))


def damaged(rows: DataFrame) -> DataFrame:
    """``conversations`` with the contract's damage, by a checksum of conversation and turn."""
    key = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")])
    kind = F.crc32(key.cast("binary")) % 20
    rows = rows.select("conv_id", "turn", *[F.coalesce(c, F.lit(" ")).alias(c) for c in ("role", "text")], kind.alias("kind")).where("kind <> 0")
    text = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    rows = rows.select("conv_id", "turn", F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"),
                       F.explode(F.when(F.col("kind") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))).alias("copy"))
    return rows.drop("copy")


def _repair_sql() -> str:
    ws = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
    add = lambda x, k, e: f"lpad((left({x}, 12)::bigint + {k})::varchar, 12, '0') || substr({x}, 13) || {e}"
    pick = lambda own: (f"(case when l = upper(l) then {conversation_repair.TRUNCATED} else 0 end + case when lower(l) = '{own}' then 0 else {conversation_repair.RETYPE} end)",
                        f"case when lower(l) = '{own}' then 'K' else 'R' end")
    never = "'900000000000'"
    step = {c: f"least({add(c, conversation_repair.DELETE, chr(39) + 'D' + chr(39))}, {e})" for c, e in {
        "z": never, "s": f"case when lower(l) = 's' then {add('z', pick('s')[0], chr(39) + 'K' + chr(39))} else {never} end",
        "u": f"case when l = 'd' then {never} else {add('least(z, s, a)', *pick('u'))} end",
        "a": f"case when l = 'd' then {never} else {add('u', *pick('a'))} end"}.items()}
    one = lambda x: add(x, conversation_repair.INSERT, "'I'")
    close = f"z, s, least(u, {one('z')}, {one('s')}, {one('a')}) u, a"
    close = f"select conv_id, n, z, s, u, least(a, {one('u')}) a from (select conv_id, n, {close} from "
    return rf"""
with recursive o as (select *, coalesce(conv_id::varchar, ' ') || ':' || coalesce(turn::varchar, ' ') as k from conversations),
crct as (select list_transform(range(0, 256), lambda i: list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0],
  lambda c, z: case when c & 1 = 1 then xor(3988292384, c >> 1) else c >> 1 end)) t),
m as (select conv_id, turn, coalesce(role, ' ') as role, coalesce(text, ' ') as text, xor(4294967295, list_reduce(list_concat([4294967295],
  list_transform(string_split(k, ''), lambda x: ascii(x)::bigint)), lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]))) % 20 as kind from o, crct),
dm as (select conv_id, turn, case when kind = 4 then 'user' else role end as role, case when kind = 1 then '' when kind = 2 then
  regexp_replace(text, '[.!?]', '', 'g') else text end as text, unnest(case when kind = 3 then [1, 2] else [1] end) as copy from m where kind <> 0),
f as (select *, rtrim(text, {ws}) as body, row_number() over (partition by conv_id, role, text order by turn nulls first, copy) as seen,
  row_number() over w as n, lag(role) over w as before from dm window w as (partition by conv_id order by turn nulls first, role, md5(text), copy)),
g as (select *, case when body = '' then 'blank' when seen > 1 then 'duplicate' when right(body, 1) not in ('.', '!', '?') then 'truncated' end as fault,
  case when left(role, 1) in ('s', 'u', 'a') then left(role, 1) else 'x' end as i from f),
r as (select *, case when fault in ('blank', 'duplicate') then 'd' when fault = 'truncated' then upper(i) else i end as l from g),
dp as ({close} (select distinct conv_id, 0::bigint n, lpad('', 12, '0') z, {never} s, {never} u, {never} a from conversations))
  union all {close} (select dp.conv_id, r.n, {', '.join(f'{e} {c}' for c, e in step.items())} from dp join r on r.conv_id is not distinct from dp.conv_id and r.n = dp.n + 1))),
best as (select conv_id, left(x, 12)::bigint as cost, substr(x, 13) as audit from (select conv_id, least(arg_max(z, n), arg_max(a, n)) x from dp group by conv_id)),
e as (select conv_id, p, substr(audit, p, 1) as e, length(regexp_replace(left(audit, p), 'I', '', 'g')) as n from
  (select conv_id, audit, unnest(range(1, length(audit) + 1)) p from best)),
kept as (select e.*, role, text, e = 'K' and left(role, 1) = 's' as sys from e left join r on r.conv_id is not distinct from e.conv_id and r.n = e.n and e <> 'I' where e <> 'D'),
seq as (select *, count(*) filter (where not sys) over (partition by conv_id order by p) as m from kept),
rep as (select conv_id, string_agg(case when e = 'K' then role when m % 2 = 1 then 'user' else 'assistant' end || ':' || case when e = 'I' then '' else text end, chr(10) order by p) as t
  from seq group by conv_id),
c as (select conv_id, coalesce(max(turn) - min(turn) + 1 - count(distinct turn), 0) gaps, count(*) filter (where fault = 'blank') blank, count(*) filter (where fault = 'duplicate') duplicate,
  count(*) filter (where fault = 'truncated') truncated, count(*) filter (where before is not null and left(before, 1) || left(role, 1) not in ('su', 'ua', 'au')) illegal from r group by conv_id)
select best.conv_id, coalesce(gaps, 0)::bigint gaps, coalesce(blank, 0)::bigint blank, coalesce(duplicate, 0)::bigint duplicate, coalesce(truncated, 0)::bigint truncated,
  coalesce(illegal, 0)::bigint illegal, cost, audit, sha256(coalesce(t, '')) repaired_sha256
from best left join c on c.conv_id is not distinct from best.conv_id left join rep on rep.conv_id is not distinct from best.conv_id
"""


@query("op12_conversation_repair", _repair_sql())
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    report, _, digests = conversation_repair.repair(damaged(rows))
    all_ids = rows.select(F.col("conv_id").alias("id")).distinct()
    found = report.join(digests.withColumnRenamed("conv_id", "of"), F.col("conv_id").eqNullSafe(F.col("of")))
    out = all_ids.join(found, F.col("id").eqNullSafe(F.col("conv_id")), "left")
    zero = [F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return out.select(F.col("id").alias("conv_id"), *zero, F.coalesce("audit", F.lit("")).alias("audit"),
                      F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"))


OP13_SQL = rf"""
with d as (select row_number() over () rid, doc_id, list_filter(string_split_regex(coalesce(text, ''), '{WS_SQL}'), lambda x: x <> '') w from documents),
win as (select rid, doc_id, i, list_aggregate(list_slice(w, i, i + {window_dedup.WIDTH - 1}), 'string_agg', ' ') g
  from (select rid, doc_id, w, unnest(range(1, len(w) - {window_dedup.WIDTH - 2})) i from d where len(w) >= {window_dedup.WIDTH})),
first as (select g, min(doc_id) least_id from win group by g),
gone as (select distinct rid, unnest(range(i, i + {window_dedup.WIDTH})) p from win join first using (g) where doc_id > least_id),
word as (select rid, unnest(w) x, generate_subscripts(w, 1) p from d),
kept as (select rid, count(*) n, string_agg(x, ' ' order by p) t from word anti join gone using (rid, p) group by rid)
select doc_id, len(w)::bigint n_words, (len(w) - coalesce(n, 0))::bigint n_removed, sha256(coalesce(t, '')) kept_sha256 from d left join kept using (rid)
"""


@query("op13_window_dedup", OP13_SQL)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = window_dedup.remove_repeats(read(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))
