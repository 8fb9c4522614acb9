"""The queries of this subpackage: name -> (spark, sf_dir) -> DataFrame, and their SQL where it can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reelsift.llm.op1_quality import graded, score, train
from reelsift.llm.op2_mixing import mix_sources
from reelsift.llm.op3_decontamination import find_leaks
from reelsift.llm.op4_lines import line_report
from reelsift.llm.op5_token_files import token_index
from reelsift.llm.op6_substring import remove_repeats
from reelsift.llm.op7_minhash import near_duplicates
from reelsift.llm.op8_images import copy_search
from reelsift.llm.op9_html import extract_pages
from reelsift.llm.op10_chat import digests, format_conversations


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    out = score(docs, train(docs, graded(_table(spark, sf_dir, "labels"))))
    return out.select("doc_id", "expected_grade", "tail_probability", "keep")


def op2_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = mix_sources(_table(spark, sf_dir, "documents").select("doc_id", "text", "source"))
    return out.select("doc_id", "size", "source_size", "target", "taken")


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = find_leaks(_table(spark, sf_dir, "documents").select("doc_id", "text"), _table(spark, sf_dir, "benchmark"))
    n = F.size("items").cast("long")
    return out.select("doc_id", "n_words", "n_hit", n.alias("n_items"), F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (n >= 2).alias("contaminated"))


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = line_report(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_lines", "n_removed", "n_similar", F.array_join(F.col("kept").cast("array<string>"), ",").alias("kept"))


def op5_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_index(_table(spark, sf_dir, "documents"))


def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = remove_repeats(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op7_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(_table(spark, sf_dir, "documents").select("doc_id", "text"))


def op8_image_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return copy_search(_table(spark, sf_dir, "embeddings"))


def op9_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = extract_pages(_table(spark, sf_dir, "pages"))
    return out.select("page_id", "url", F.col("main_text").alias("text"), F.length("main_text").cast("long").alias("n_chars"))


def op10_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = "</s>[INST] ok [/INST]"
    role = F.when(F.col("id") == 0, "user").otherwise("assistant")
    hard = spark.range(2).select(F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"), role.alias("role"), F.lit(said).alias("text"))
    turns = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(hard)
    return digests(format_conversations(turns))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_quality_classifier": op1_quality_classifier,
    "op2_source_mix": op2_source_mix,
    "op3_decontamination": op3_decontamination,
    "op4_line_dedup": op4_line_dedup,
    "op5_token_files": op5_token_files,
    "op6_substring_dedup": op6_substring_dedup,
    "op7_minhash": op7_minhash,
    "op8_image_copies": op8_image_copies,
    "op9_html_text": op9_html_text,
    "op10_chat_format": op10_chat_format,
}

#: Turns as they are rendered: escaped where they hold a control string or a backslash.
_TURNS = r"""
with said as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all select -1, unnest([0, 1]), unnest(['user', 'assistant']), '</s>[INST] ok [/INST]'
), shown as (
  select *, case when regexp_matches(role || chr(10) || text, '\\|<s>|</s>|\[INST\]|\[/INST\]') then length(regexp_replace(replace(role || text, chr(92), chr(92) || chr(92)),
    '(<|\[)(s>|/s>|INST\]|/INST\])', '\1\\\2', 'g')) else length(role || text) end + 17 as chars from said
)
"""

#: The mix: sources share all words, lengths share a source's, rows are ranked, cut and filled up as in op2_mixing.
_MIX = r"""
with d as (
  select doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::bigint as size, md5('1 ' || coalesce(doc_id::varchar, '') || ' ' || coalesce(text, '')) as h from documents
), e as (
  select *, case when size > 0 then length(bin(size)) - 1 else 0 end as length, (('0x' || substr(h, 1, 13))::bigint + 0.5) / (1::bigint << 52)::double as u from d
), s as (
  select source, sum(size)::bigint as source_size, [5.0, 2.0, 1.0][1 + (row_number() over (order by source nulls last) - 1) % 3]::double as weight from e group by source
), s1 as (
  select *, source_size * 2.0::double as lim, sum(source_size) over () * 1.5::double as share from s where source_size > 0
), s2 as (
  select *, row_number() over o as place, (share - coalesce(sum(lim) over (order by lim / weight, source nulls last rows between unbounded preceding and 1 preceding), 0))
    / sum(weight) over (order by lim / weight, source nulls last rows between current row and unbounded following) as level from s1 window o as (order by lim / weight, source nulls last)
), s3 as (
  select source, source_size, coalesce(least(lim, weight * min_by(level, place) filter (level <= lim / weight) over ()), lim)::double as target from s2
), l as (
  select e.source, e.length, sum(size)::bigint as words, any_value(coalesce(source_size, 0)) as source_size, any_value(coalesce(target, 0))::double as target
  from e left join s3 on e.source is not distinct from s3.source group by e.source, e.length
), l1 as (
  select *, words * 2.0::double as lim, greatest(24 - length, 1) * words::double as weight from l where words > 0
), l2 as (
  select *, row_number() over (partition by source order by lim / weight, length) as place,
    (target - coalesce(sum(lim) over (partition by source order by lim / weight, length rows between unbounded preceding and 1 preceding), 0))
    / sum(weight) over (partition by source order by lim / weight, length rows between current row and unbounded following) as level from l1
), l3 as (
  select source, length, source_size, target, coalesce(least(lim, weight * min_by(level, place) filter (level <= lim / weight) over (partition by source)), lim) / words as copies from l2
  union all select source, length, source_size, target, 0 from l where words = 0
), r as (
  select e.*, source_size, target, floor(copies)::bigint as sure, case when copies > floor(copies) then (u / (1 - u)) / ((copies - floor(copies)) / (1 - (copies - floor(copies)))) end as rank
  from e join l3 on e.source is not distinct from l3.source and e.length = l3.length
), n as (
  select *, target - sum(sure * size) over (partition by source) as need from r
), c as (
  select *, rank is not null and size <= need and sum(case when rank is not null and size <= need then size end) over (partition by source order by (rank is null or size > need), rank, h, size) <= need as inside from n
), m as (
  select *, need - sum(case when inside then size else 0 end) over (partition by source) as missing from c
), f as (
  select source, arg_min(doc_id, {'off': abs(size - missing), 'rank': rank, 'h': h}) as one, arg_min(size, {'off': abs(size - missing), 'rank': rank, 'h': h}) as was
  from m where rank is not null and not inside and size > 0 and size < 2 * missing group by source
), m2 as (
  select m.*, f.one, missing - coalesce(f.was, 0) as still from m left join f on m.source is not distinct from f.source
), f2 as (
  select source, arg_min(doc_id, {'off': abs(size - still), 'rank': rank, 'h': h}) as two
  from m2 where rank is not null and not inside and doc_id is distinct from one and size > 0 and size < 2 * still group by source
)
select doc_id, size, source_size::bigint as source_size, target, (size * (sure + case when inside or doc_id = one or doc_id = two then 1 else 0 end))::bigint as taken
from m2 left join f2 on m2.source is not distinct from f2.source
"""

_PLAIN = "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"

_LEAKS = f"""
with d as (select doc_id, {_PLAIN} as w from documents), b as (select coalesce(item_id::varchar, 'null') as item, {_PLAIN} as w from benchmark),
bk as (select item, w, least(8, len(w)) as k from b where len(w) > 0),
bw as (select distinct item, k, array_to_string(w[i : i + k - 1], ' ') as win from (select item, w, k, unnest(range(1, len(w) - k + 2)) as i from bk) x),
ks as (select distinct k from bw),
dw as (select doc_id, k, i, array_to_string(w[i : i + k - 1], ' ') as win from (select doc_id, w, k, unnest(range(1, len(w) - k + 2)) as i from d, ks where len(w) >= k) x),
hit as (select doc_id, i, dw.k, item from dw join bw on dw.k = bw.k and dw.win = bw.win),
n as (select doc_id, count(distinct p) as n_hit from (select doc_id, unnest(range(i, i + k)) as p from hit) x group by doc_id),
t as (select doc_id, list_sort(list_distinct(list(item))) as items from hit group by doc_id)
select d.doc_id, len(w)::bigint as n_words, coalesce(n_hit, 0)::bigint as n_hit, coalesce(len(items), 0)::bigint as n_items, sha256(coalesce(array_to_string(items, ','), '')) as items_sha256, coalesce(len(items), 0) >= 2 as contaminated
from d left join n on d.doc_id = n.doc_id left join t on d.doc_id = t.doc_id
"""

_LINES = """
with l as (
  select doc_id, unnest(range(0, len(string_split(text, chr(10)))::bigint)) as place, unnest(string_split(lower(text), chr(10))) as line from documents where text is not null
), w as (select doc_id, place, list_sort(list_distinct(regexp_extract_all(line, '[^ ]+'))) as ws from l),
c as (select ws, min({'d': doc_id, 'p': place}) as head from w where len(ws) > 0 group by ws),
i as (select row_number() over (order by head) as c, head, ws, len(ws) as n from c),
x as (select c, n, unnest(ws) as word from i), f as (select word, count(*) as df from x group by word),
p as (select c, n, x.word, row_number() over (partition by c order by df, x.word) as nth from x join f on x.word = f.word),
q as (select * from p where nth <= n - ceil(n * 0.8 - 1e-9) + 1),
pairs as (select distinct a.c as a, b.c as b from q a join q b on a.word = b.word and b.c < a.c and least(a.n, b.n) >= 0.8 * greatest(a.n, b.n) - 1e-9),
gone as (select distinct a from pairs join i x on x.c = pairs.a join i y on y.c = pairs.b where len(list_intersect(x.ws, y.ws)) >= 0.8 * (x.n + y.n - len(list_intersect(x.ws, y.ws))) - 1e-9),
k as (select w.doc_id, place, len(w.ws) = 0 or (i.head.d = w.doc_id and i.head.p = place and gone.a is null) as stay, i.head.d = w.doc_id and i.head.p = place and gone.a is not null as alike
  from w left join i on w.ws = i.ws left join gone on gone.a = i.c),
s as (select doc_id, count(*) as n_lines, count(*) filter (not stay) as n_removed, count(*) filter (alike) as n_similar, string_agg(place::varchar, ',' order by place) filter (stay) as kept from k group by doc_id)
select d.doc_id, coalesce(n_lines, 0)::bigint as n_lines, coalesce(n_removed, 0)::bigint as n_removed, coalesce(n_similar, 0)::bigint as n_similar, coalesce(kept, '') as kept from documents d left join s on d.doc_id = s.doc_id
"""

_REPEATS = r"""
with d as (select doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w from documents),
x as (select doc_id, w, unnest(range(1, len(w) - 33)) as i from d where len(w) >= 35),
y as (select doc_id, i, count(*) over (partition by array_to_string(w[i : i + 34], ' ')) as n from x),
g as (select distinct doc_id, unnest(range(i, i + 35)) as p from y where n > 1),
k as (select d.doc_id, unnest(w) as word, unnest(range(1, len(w) + 1)) as p from d),
s as (select k.doc_id, count(g.p) as n_removed, string_agg(word, ' ' order by k.p) filter (g.p is null) as kept from k left join g on g.doc_id = k.doc_id and g.p = k.p group by k.doc_id)
select d.doc_id, len(w)::bigint as n_words, coalesce(n_removed, 0)::bigint as n_removed, sha256(coalesce(kept, '')) as kept_sha256 from d left join s on s.doc_id = d.doc_id
"""

_COPIES = f"""
with recursive d as (select doc_id, text, {_PLAIN} as w from documents),
t as (select text, any_value(w) as w, min(doc_id) as id, count(*) as k from d where text is not null group by text),
g as (select id, array_to_string(w[i : i + least(5, len(w)) - 1], ' ') as sh from (select id, w, unnest(range(1, len(w) - least(5, len(w)) + 2)) as i from t where len(w) > 0) x),
m as (select id, sh || ' ' || (row_number() over (partition by id, sh))::varchar as e from g), n as (select id, count(*) as n from m group by id),
f as (select e, count(*) as df from m group by e),
o as (select m.id, m.e, n.n, row_number() over (partition by m.id order by f.df, m.e) as nth from m join f on m.e = f.e join n on n.id = m.id),
q as (select * from o where nth <= n - ceil(n * 0.8 - 1e-9) + 1),
pairs as (select distinct a.id as a, b.id as b, a.n as na, b.n as nb from q a join q b on a.e = b.e and a.id < b.id and least(a.n, b.n) >= 0.8 * greatest(a.n, b.n) - 1e-9),
both_ as (select a, b, na, nb, count(*) as shared from pairs join m x on x.id = a join m y on y.id = b and x.e = y.e group by a, b, na, nb),
links as (select a, b from both_ where shared >= 0.8 * (na + nb - shared) - 1e-9 union select b, a from both_ where shared >= 0.8 * (na + nb - shared) - 1e-9),
walk as (select id, id as seen from t union select walk.id, links.b from walk join links on walk.seen = links.a),
r as (select id, min(seen) as root from walk group by id), z as (select root, sum(k)::bigint as copies from r join t on r.id = t.id group by root)
select d.doc_id, coalesce(r.root, d.doc_id) as class_id, coalesce(z.copies, 1)::bigint as copies from d left join t on d.text = t.text left join r on r.id = t.id left join z on z.root = r.root
"""

ORACLE_SQL: dict[str, str] = {
    "op2_source_mix": _MIX,
    "op3_decontamination": _LEAKS,
    "op4_line_dedup": _LINES,
    "op6_substring_dedup": _REPEATS,
    "op7_minhash": _COPIES,
    "op10_chat_format": _TURNS
    + """
select conv_id, count(*) as n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn, role, text)) as turns_sha256,
  coalesce(sum(length(text)) filter (role = 'assistant'), 0)::bigint as loss_chars,
  sha256(coalesce(string_agg(text, '' order by turn, role, text) filter (role = 'assistant'), '')) as loss_sha256, (3 + sum(chars))::bigint as formatted_chars
from shown group by conv_id
""",
}
