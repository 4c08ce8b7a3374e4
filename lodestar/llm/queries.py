"""The registered queries of this subpackage and their DuckDB SQL (where SQL can express them)."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    chat_format,
    decontaminate,
    fill_in_middle,
    language_id,
    license_scan,
    near_dedup,
    packing,
    periodic_runs,
    quality_rules,
    resampling,
    secret_scan,
    sharding,
    token_counts,
)

QUERIES: dict = {}
ORACLE: dict = {}


def query(fn, sql: str | None = None):
    QUERIES[fn.__name__] = fn
    if sql is not None:
        ORACLE[fn.__name__] = sql
    return fn


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf.rstrip('/')}/{name}.parquet")


@query
def op6_quality_rules(spark: SparkSession, sf: str) -> DataFrame:
    """Weakly supervised quality verdict for every document."""
    return quality_rules.judged(table(spark, sf, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        F.col("posterior"))


@query
def op7_near_dedup(spark: SparkSession, sf: str) -> DataFrame:
    """Near-duplicate classes of all documents (4-word shingles, similarity 0.8)."""
    return near_dedup.near_duplicates(table(spark, sf, "documents"), near_dedup.Join(width=4))


_WORDS = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_ASCII_LOWER = "translate(coalesce({}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_OP2 = f"""
with d as (select doc_id, regexp_extract_all({_ASCII_LOWER.format('text')}, '{_WORDS}') as w from documents),
b as (select item_id, regexp_extract_all({_ASCII_LOWER.format('text')}, '{_WORDS}') as w from benchmark),
bw as (select item_id, least(10, len(w)) as k, unnest(range(1, len(w) - least(10, len(w)) + 2)) as p, w from b where len(w) > 0),
bg as (select distinct item_id, k, array_to_string(w[p:p + k - 1], ' ') as g from bw),
ks as (select distinct k from bg),
dw as (select doc_id, k, unnest(range(1, len(w) - k + 2)) as p, w from d, ks where len(w) >= k),
dg as (select doc_id, k, p, array_to_string(w[p:p + k - 1], ' ') as g from dw),
m as (select dg.doc_id, dg.k, dg.p, bg.item_id from dg join bg on dg.k = bg.k and dg.g = bg.g),
h as (select doc_id, count(*) as n_hit from (select distinct doc_id, unnest(range(p, p + k)) as x from m) group by doc_id),
i as (select doc_id, count(*) as n_items, string_agg(id, ',' order by id) as ids
      from (select distinct doc_id, cast(item_id as varchar) as id from m) group by doc_id)
select d.doc_id, len(d.w) as n_words, coalesce(h.n_hit, 0) as n_hit, coalesce(i.n_items, 0) as n_items,
       sha256(coalesce(i.ids, '')) as items_sha256, h.n_hit is not null as contaminated
from d left join h using (doc_id) left join i using (doc_id)"""


def op2_decontaminate(spark: SparkSession, sf: str) -> DataFrame:
    """Benchmark windows found verbatim in every document."""
    return decontaminate.digest(decontaminate.contamination(table(spark, sf, "documents"), table(spark, sf, "benchmark")))


query(op2_decontaminate, _OP2)


def vocabulary_path(name: str = "word_bpe_49k.json") -> str:
    """File of a public vocabulary (every executor has it installed)."""
    import public_tokenizers

    return public_tokenizers.path(name)


@query
def op10_best_fit_packing(spark: SparkSession, sf: str) -> DataFrame:
    """Every document packed into sequences of 2048 tokens."""
    return packing.pack(table(spark, sf, "documents"), vocabulary_path())


@query
def op4_language_id(spark: SparkSession, sf: str) -> DataFrame:
    """Predicted language of every document."""
    docs = table(spark, sf, "documents")
    found = language_id.predict(docs.select("doc_id", "text"), language_id.fit(docs))
    return found.select("row.doc_id", "lang_pred", "score").select(
        "doc_id", language_id.held_out().alias("held_out"), "lang_pred", "score")


@query
def op8_ring_sharding(spark: SparkSession, sf: str) -> DataFrame:
    """All documents on a ring of 24 shards whose row counts differ by one at most."""
    return sharding.ring_shards(table(spark, sf, "documents"), 24).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))


def _escape_sql(text: str) -> str:
    out = f"replace(coalesce({text}, ''), '\\', '\\e')"
    for c in chat_format.CONTROL:
        out = f"replace({out}, '{c}', '{'\\l' if c[0] == '<' else '\\b'}{c[1:]}')"
    return out


_MARKED = "</s>[INST] ok [/INST]"  # a text made of control strings
_OP3 = f"""
with t as (select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all select -7, 0, 'user', '{_MARKED}' union all select -7, 1, 'assistant', '{_MARKED}'),
f as (select *, '<|im_start|>' || replace({_escape_sql('role')}, chr(10), '\n') || chr(10) || {_escape_sql('text')}
  || '<|im_end|>' || chr(10) as line from t),
g as (select conv_id, count(*) as n_turns, sum(length(line)) as formatted_chars,
  string_agg(role || chr(10) || text || chr(10), '' order by turn nulls first, line) as said,
  coalesce(string_agg(text, '' order by turn nulls first, line) filter (where role = 'assistant'), '') as learned
  from f group by conv_id)
select conv_id, n_turns, sha256(said) as turns_sha256, length(learned) as loss_chars, sha256(learned) as loss_sha256,
  cast(formatted_chars as bigint) as formatted_chars from g"""


def op3_chat_format(spark: SparkSession, sf: str) -> DataFrame:
    """All conversations and one made of control strings (a record of another layout), formatted and read back."""
    said = [{"role": r, "content": _MARKED} for r in ("user", "assistant")]
    record = spark.range(1).select(F.lit(-7).cast("long").alias("id"), F.lit(json.dumps({"messages": said})).alias("record"))
    turns = chat_format.turn_rows(table(spark, sf, "conversations")).unionByName(
        chat_format.json_turn_rows(record, "id", "record").drop("layout"))
    back = chat_format.read_back(chat_format.format_chat(turns))
    line = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return back.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(F.array_join(line, ""), 256).alias("turns_sha256"),
        F.length("loss_text").cast("long").alias("loss_chars"), F.sha2("loss_text", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"))


query(op3_chat_format, _OP3)


def _op1_sql() -> str:
    rows = ", ".join(f"({t}, '{label}', {str(base).lower()}, {n}, {i}, '{a} {b}')"
                     for t, label, base, n, i, a, b in license_scan.template_grams())
    return f"""
with d as (select row_number() over () as row, doc_id, regexp_extract_all({_ASCII_LOWER.format('text')}, '{_WORDS}') as w from documents),
g(template, label, base, grams, place, pair) as (values {rows}),
r as (select row, unnest(range(len(w) - 1)) as x, w from d where len(w) > 1),
h as (select distinct r.row, g.template, g.label, g.base, g.grams, g.place, r.x, r.x - g.place as diagonal
      from (select row, x, w[x + 1] || ' ' || w[x + 2] as pair from r) r join g on g.pair = r.pair),
v as (select *, coalesce(diagonal - lag(diagonal) over (partition by row, template order by diagonal)
      > case when base then 0 else {license_scan.GAP} end, true) as fresh from (select distinct row, template, base, diagonal from h)),
n as (select row, template, diagonal, sum(fresh::int) over (partition by row, template order by diagonal) as grp from v),
q as (select h.*, n.grp from h join n using (row, template, diagonal)),
a as (select distinct row, template, label, base, grams, grp, x from q),
s as (select a.*, count(distinct q.place) as votes, list(distinct q.x) as ats from a join q on q.row = a.row and q.template = a.template
      and q.grp = a.grp and q.x >= a.x and q.x < a.x + 2 * a.grams group by all),
b as (select *, row_number() over (partition by row, template, grp order by votes desc, x) as best from s),
m as (select b.row, b.template, b.label, b.base, b.grams, b.grp, votes, ats, votes / b.grams::double as covered, diagonal
      from b join (select row, template, grp, min(diagonal) as diagonal from q group by all) y using (row, template, grp)
      where best = 1 and votes >= case when b.base then b.grams else least(2, b.grams) end),
e as (select row, template, grp, votes, grams, unnest(ats) as word from m where not base and covered >= {license_scan.COVERED}),
t as (select distinct row, template, grp from (select *, max(votes) over (partition by row, word) as most from e)
      where votes = most or votes = grams),
f as (select row, count(*) filter (where base) as n_base, min(diagonal) filter (where base) as first_word,
      max(diagonal) filter (where base) as last_word,
      array_to_string(list_sort(list(distinct label) filter (where base)), ',') as base_labels,
      array_to_string(list_sort(list(distinct label) filter (where base or sure)), ',') as labels,
      max(covered) as score from (select m.*, t.row is not null as sure from m left join t using (row, template, grp)) group by row)
select d.doc_id, len(d.w) as n_words, coalesce(n_base, 0) as n_base, first_word, last_word,
  coalesce(base_labels, '') as base_labels, coalesce(labels, '') as labels, coalesce(score, 0.0::double) as score
from d left join f using (row)"""


def op1_license_scan(spark: SparkSession, sf: str) -> DataFrame:
    """Licence phrases and notices in every document."""
    return license_scan.scan(table(spark, sf, "documents"))


query(op1_license_scan, _op1_sql())


@query
def op5_importance_resample(spark: SparkSession, sf: str) -> DataFrame:
    """A quarter of all documents, drawn by how much they look like those labelled good."""
    good = table(spark, sf, "labels").where("quality = 1").select("doc_id")
    return resampling.resample(table(spark, sf, "documents"), good)


@query
def op9_token_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Greedy longest-match token counts of every document."""
    return token_counts.token_counts(table(spark, sf, "documents"), vocabulary_path("piece_bpe_32k.model"))


def _listed(spans: str):
    """``kind:start:end`` of the spans, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


@query
def op11_secret_scan(spark: SparkSession, sf: str) -> DataFrame:
    """Secrets in every document: base patterns, and strings that compress badly beside a sensitive word."""
    found = secret_scan.scan_secrets(table(spark, sf, "documents")).withColumn(
        "base", F.filter("spans", lambda s: s["kind"] != "novel"))
    counts = [F.expr(f"bigint(size(filter(spans, s -> s.kind = '{k}')))").alias(f"n_{k}") for k in secret_scan.KINDS]
    return found.select("doc_id", *counts, F.sha2(_listed("base"), 256).alias("base_sha256"), _listed("spans").alias("spans"))


_OP12 = r"""
with t as (select doc_id, coalesce(text, '') as text,
    regexp_extract_all(coalesce(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') as w,
    sha256('42:' || coalesce(cast(doc_id as varchar), '')) as h from documents),
u as (select doc_id, text, w, len(w) as n, cast('0x' || h[1:8] as bigint) as h1, cast('0x' || h[9:16] as bigint) as h2,
    cast('0x' || h[17:24] as bigint) as h3, cast('0x' || h[25:32] as bigint) as h4 from t),
f as (select *, least(h1 % (n + 1), h2 % (n + 1)) as a, greatest(h1 % (n + 1), h2 % (n + 1)) as z,
    case when text = '' or contains(text, '<P>') or contains(text, '<S>') or contains(text, '<M>') or h3 % 100 >= 50
    then 'plain' when h4 % 100 < 80 then 'spm' else 'psm' end as form from u),
p as (select *, array_to_string(w[1:a], '') as prefix, array_to_string(w[a + 1:z], '') as middle,
    array_to_string(w[z + 1:], '') as suffix from f)
select doc_id, n, form, case when form <> 'plain' then length(prefix) end as prefix_chars,
    case when form <> 'plain' then length(middle) end as middle_chars,
    sha256(case form when 'plain' then text when 'psm' then '<P>' || prefix || '<S>' || suffix || '<M>' || middle
    else '<S>' || suffix || '<P>' || prefix || '<M>' || middle end) as output_sha256, sha256(text) as restored_sha256 from p"""


def op12_fill_in_middle(spark: SparkSession, sf: str) -> DataFrame:
    """Every document with its middle moved to the end, and read back from that."""
    back = fill_in_middle.restore(fill_in_middle.transform(table(spark, sf, "documents")))
    return back.select("doc_id", "n", "form", "prefix_chars", "middle_chars",
                       F.sha2("output", 256).alias("output_sha256"), F.sha2("restored", 256).alias("restored_sha256"))


query(op12_fill_in_middle, _OP12)


def _with_tails(docs: DataFrame) -> DataFrame:
    """``docs`` with a periodic tail in a tenth of the texts: h = crc32 of the id, g = h / 10;
    if h % 10 = 0 the words from a = g % n on repeat their first 1 + (n - a) / (3 + g % 8)."""
    h = F.crc32(F.col("doc_id").cast("string"))
    words = F.regexp_extract_all("text", F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))
    tail = F.expr("array_join(transform(words, (w, i) -> if(i < a, w, words[int(a + (i - a) % p)])), ' ')")
    chosen = docs.select("doc_id", "text", F.when(h % 10 == 0, words).alias("words"), F.floor(h / 10).alias("g")).select(
        "*", F.when(F.size("words") > 0, F.col("g") % F.size("words")).alias("a")).select(
        "*", (1 + F.floor((F.size("words") - F.col("a")) / (3 + F.col("g") % 8))).alias("p"))
    return chosen.select("doc_id", F.when(F.col("a").isNotNull(), tail).otherwise(F.col("text")).alias("text"))


_OP13 = r"""
with t as (select row_number() over () as row, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w,
    list_reduce(list_concat([4294967295], list_transform(string_split(cast(doc_id as varchar), ''), lambda c: cast(ascii(c) as bigint))),
        lambda c, b: list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, y: xor(x >> 1, 3988292384 * (x & 1)))) as c from documents),
u as (select row, doc_id, w, len(w) as n, xor(c, 4294967295) as h, xor(c, 4294967295) // 10 as g from t),
v as (select *, case when h % 10 = 0 and n > 0 then g % n end as a from u),
x as (select *, 1 + (n - a) // (3 + g % 8) as p from v),
d as (select row, doc_id, n, case when a is null then w else
    list_transform(range(n), lambda i: w[1 + case when i < a then i else a + (i - a) % p end]) end as w from x),
e as (select row, n, unnest(range(n - 7)) as i, w from d where n >= 24),
o as (select row, n, i, array_to_string(w[i + 1:i + 8], ' ') as eight from e),
m as (select l.row, r.i - l.i as q, l.i from o l join o r on l.row = r.row and l.eight = r.eight
    and r.i > l.i and 3 * (r.i - l.i) <= l.n),
k as (select row, q, i, i - row_number() over (partition by row, q order by i) as chain from m),
s as (select row, q, min(i) as start, count(*) + 7 + q as length from k group by row, q, chain),
r as (select row, start, length, min(q) as period from s where length >= greatest(24, 3 * q) group by row, start, length),
b as (select *, row_number() over (partition by row order by length / period::double desc, start, period) as best from r),
f as (select row, count(*) as n_runs, any_value(start) filter (where best = 1) as start, any_value(length) filter (where best = 1) as length,
    any_value(period) filter (where best = 1) as period,
    string_agg(start || ',' || length || ',' || period || chr(10), '' order by start, period) as runs,
    list({'lo': start + period, 'hi': start + length}) as cut from b group by row),
j as (select d.row, i, w[i + 1] as word from (select row, w, unnest(range(n)) as i from d) d left join f using (row)
    where cut is null or len(list_filter(cut, lambda z: i >= z.lo and i < z.hi)) = 0),
l as (select row, string_agg(word, ' ' order by i) as collapsed from j group by row)
select doc_id, coalesce(n_runs, 0) as n_runs, start, length, period, 1000 * length // period as exponent_milli,
    sha256(coalesce(runs, '')) as runs_sha256, sha256(coalesce(collapsed, '')) as collapsed_sha256
from d left join f using (row) left join l using (row)"""


def op13_periodic_runs(spark: SparkSession, sf: str) -> DataFrame:
    """Periodic runs of words in every document, a tenth of them with a periodic tail, and the text without the repeats."""
    found = periodic_runs.collapse_runs(_with_tails(table(spark, sf, "documents")))
    # the greatest length / period, compared exactly; then the smallest start and period
    order = F.expr("""array_sort(runs, (x, y) -> case
        when x.length * y.period <> y.length * x.period then if(x.length * y.period > y.length * x.period, -1, 1)
        when x.start <> y.start then if(x.start < y.start, -1, 1) else int(sign(x.period - y.period)) end)""")
    lines = F.array_join(F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))), "")
    return found.withColumn("best", F.get(order, F.lit(0))).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
        F.floor(1000 * F.col("best.length") / F.col("best.period")).cast("long").alias("exponent_milli"),
        F.sha2(lines, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))


query(op13_periodic_runs, _OP13)
