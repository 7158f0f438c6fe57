"""The text operators as named queries over whole tables, and their SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

import corpus_pipeline
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ratingloom.llm import bpe, codes, decontam, html, langid, licenses, mixing, neardup, quotes, resampling, rules, substrings, tokencounts

Query = Callable[[SparkSession, str], DataFrame]
LLM_REGISTRY: dict[str, Query] = {}
LLM_ORACLES: dict[str, str] = {}

#: The vocabulary of the encoding queries; a path is all that is kept of it.
RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def register(query: Query) -> Query:
    LLM_REGISTRY[query.__name__] = query
    return query


def _table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet").select(*columns)


@register
def op1_remove_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = substrings.remove_repeats(_table(spark, sf_dir, "documents", "doc_id", "text"))
    return cut.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


LLM_ORACLES["op1_remove_repeats"] = r"""
with words as (
  select doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as ws from documents
), windows as (
  select doc_id, i, array_to_string(list_slice(ws, i, i + 12), ' ') as said
  from words, lateral (select unnest(range(1, len(ws) - 11)) as i)
), owned as (
  select doc_id, i, min(doc_id) over (partition by said) as owner from windows
), removed as (
  select doc_id, list(distinct i + k) as gone from owned, range(13) as t(k) where owner < doc_id group by doc_id
), kept as (
  select doc_id, ws, coalesce(gone, []::bigint[]) as gone,
         list_filter(ws, lambda w, i: not list_contains(coalesce(gone, []::bigint[]), i)) as stay
  from words left join removed using (doc_id)
)
select doc_id, len(ws) as n_words, len(gone) as n_removed,
       sha256(array_to_string(stay, ' ')) as kept_sha256
from kept
"""


@register
def op5_section_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _table(spark, sf_dir, "documents", "doc_id", "text")
    return tokencounts.section_token_counts(documents, RANKS, public_tokenizers.PATTERN, "most")


@register
def op8_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _table(spark, sf_dir, "documents", "doc_id", "text")
    return bpe.encode_digests(documents, RANKS, public_tokenizers.PATTERN)


@register
def op3_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licenses(_table(spark, sf_dir, "documents", "doc_id", "text")).drop("matches")


HELD_OUT = "coalesce(crc32(cast(cast(doc_id as string) as binary)) % 4 = 2, false)"


@register
def op4_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _table(spark, sf_dir, "documents", "doc_id", "text", "lang")
    learned = documents.where(f"doc_id is not null and not {HELD_OUT}").select("text", "lang")
    found = langid.identify(documents.select("doc_id", "text"), langid.fit(learned))
    shares = F.transform("languages", lambda x: F.concat_ws(":", x["lang"], F.round(x["share"], 4).cast("string")))
    return found.select("doc_id", F.expr(HELD_OUT).alias("held_out"), "lang_pred", "score", F.array_join(shares, ",").alias("languages"))


@register
def op6_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.extract(_table(spark, sf_dir, "pages", "page_id", "url", "html")).drop("blocks")


@register
def op2_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicate_classes(_table(spark, sf_dir, "documents", "doc_id", "text"))


@register
def op7_contamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _table(spark, sf_dir, "documents", "doc_id", "text")
    found = decontam.contamination(documents, _table(spark, sf_dir, "benchmark", "item_id", "text"))
    digest = F.sha2(F.array_join("items", ","), 256).alias("items_sha256")
    return found.select("doc_id", "n_words", "n_hit", "n_items", digest, "contaminated")


LLM_ORACLES["op7_contamination"] = r"""
with said as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as ws from documents
), items as (
  select item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                     '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as ws from benchmark
), phrases as (
  select distinct item_id, least(len(ws), 13) as n, array_to_string(list_slice(ws, i, i + 12), ' ') as phrase
  from items, lateral (select unnest(range(1, greatest(2, len(ws) - 11))) as i) where len(ws) > 0
), sizes as (
  select distinct n from phrases
), places as (
  select doc_id, i, n, array_to_string(list_slice(ws, i, i + n - 1), ' ') as phrase
  from said, sizes, lateral (select unnest(range(1, len(ws) - n + 2)) as i)
), matches as (
  select distinct doc_id, i, n, item_id from places join phrases using (phrase, n)
), hits as (
  select doc_id, count(distinct i + k) as n_hit from matches, range(13) as t(k) where k < n group by doc_id
), held as (
  select doc_id, count(distinct item_id) as n_items,
         array_to_string(list_sort(list(distinct cast(item_id as varchar))), ',') as items
  from matches group by doc_id
)
select doc_id, len(ws) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items,
       sha256(coalesce(items, '')) as items_sha256,
       coalesce(n_hit, 0) > 0 and 20 * coalesce(n_hit, 0) >= len(ws) as contaminated
from said left join hits using (doc_id) left join held using (doc_id)
"""


@register
def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = rules.judge(_table(spark, sf_dir, "documents", "doc_id", "text"))
    counts = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    return judged.select("doc_id", *counts, "base_failed", "kept", "votes", F.round("quality", 6).alias("quality"))


@register
def op9_reply_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quotes.reply_order(_table(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text"))


LLM_ORACLES["op9_reply_order"] = r"""
with recursive messages as (
  select conv_id, turn, role, coalesce(text, '') as text, row_number() over () as row from conversations
), lines as (
  select conv_id, turn, row, unnest(string_split(text, chr(10))) as line from messages
), found as (
  select conv_id, turn, row, length(regexp_replace(regexp_extract(line, '^[ \t]*>[ \t>]*'), '[^>]', '', 'g')) as level,
         lower(trim(regexp_replace(regexp_replace(line, '^[ \t]*>[ \t>]*', ''), '[\x20\x09-\x0D]+', ' ', 'g'))) as passage
  from lines
), quoted as (
  select q.conv_id, q.turn, q.row, q.level,
         (select max(s.turn) from found s where s.level = 0 and s.conv_id = q.conv_id and s.passage = q.passage and s.turn < q.turn) as source
  from found q where q.level > 0 and q.passage <> '' and q.conv_id is not null and q.turn is not null
), support as (
  select conv_id, turn, row, source, min(level) as level, count(*) as n from quoted where source is not null group by all
), answered as (
  select conv_id, turn, row, source as parent from support
  qualify row_number() over (partition by row order by level, n desc, source desc) = 1
), up as (
  select conv_id, turn, max(parent) as parent from answered group by all
), chain as (
  select conv_id, turn, parent as root, 1 as depth from up
  union all
  select c.conv_id, c.turn, u.parent, c.depth + 1 from chain c join up u on u.conv_id = c.conv_id and u.turn = c.root
), threads as (
  select conv_id, turn, min(root) as root, max(depth) as depth from chain group by all
), counted as (
  select row, count(*) as n_quotes, count(source) as n_linked from quoted group by row
), own as (
  select row, regexp_replace(array_to_string(list_filter(string_split(text, chr(10)), lambda line: not regexp_matches(line, '^[ \t]*>[ \t>]*')), chr(10)),
                             '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g') as said
  from messages
)
select conv_id, turn, role, said as text, parent as parent_turn, coalesce(root, turn) as root_turn,
       cast(coalesce(depth, 0) as bigint) as depth, coalesce(n_quotes, 0) as n_quotes, coalesce(n_linked, 0) as n_linked,
       '<|' || coalesce(role, '') || '|>' || chr(10) || said || chr(10) || '<|end|>' as chat
from messages join own using (row) left join counted using (row) left join answered using (conv_id, turn, row)
left join threads using (conv_id, turn)
"""


@register
def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return codes.labelled_codes(_table(spark, sf_dir, "embeddings", "vec_id", "embedding", "label"))


def _lloyd_sql(rounds: int) -> str:
    steps = []
    for k in range(rounds + 1):
        steps.append(f"""a{k} as materialized (
  select row, p, arg_min(e, d * 256 + e) as e, min(d) as d from (
    select row, p, e, list_dot_product(y, y) - 2 * list_dot_product(x, y) as d from parts join c{k} using (p)
  ) group by row, p
)""")
        if k < rounds:
            steps.append(f"""c{k + 1} as materialized (
  select p, e, coalesce(z, y) as y from c{k} left join (
    select p, e, list(cast((s - ((s % n) + n) % n) // n as double) order by i) as z from (
      select p, e, i, cast(sum(x[i]) as bigint) as s, count(*) as n
      from a{k} join parts using (row, p), lateral (select unnest(range(1, len(x) + 1)) as i) group by p, e, i
    ) group by p, e
  ) using (p, e)
)""")
    return ", ".join(steps)


LLM_ORACLES["op11_vector_codes"] = f"""
with kept as materialized (
  select row_number() over () as row, vec_id, label, list_transform(embedding, lambda x: floor(1024 * cast(x as double))) as v
  from embeddings
  where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
), parts as materialized (
  select row, p, list_slice(v, p * (len(v) // 4) + 1, (p + 1) * (len(v) // 4)) as x from kept, range(4) as t(p)
), c0 as materialized (
  select p, e, x as y from parts join (
    select row, row_number() over (order by vec_id nulls last, v) - 1 as e from kept
  ) using (row) where e < 256
), {_lloyd_sql(4)}, coded as materialized (
  select row, string_agg(format('{{:02x}}', e), '' order by p) as code, cast(sum(d + list_dot_product(x, x)) as bigint) as error
  from a4 join parts using (row, p) group by row
), books as (
  select sha256(string_agg(array_to_string(list_transform(y, lambda v: cast(v as bigint)), ','), ',' order by p, e)) as digest from c4
)
select vec_id, code, error, cast(sum(error) over (partition by label) as bigint) as label_error, digest as codebooks_sha256
from kept join coded using (row), books
"""


@register
def op12_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    drawn = resampling.resample(_table(spark, sf_dir, "documents", "doc_id", "text"), _table(spark, sf_dir, "benchmark", "text"))
    return drawn.select("doc_id", "n_features", "weight", "score", "rank")


LLM_ORACLES["op12_importance_resampling"] = r"""
with said as (
  select row_number() over () as row, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as ws from documents
), asked as (
  select regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as ws from benchmark
), features as materialized (
  select row, unnest(list_concat(ws, list_transform(range(1, len(ws)), lambda i: ws[i] || ' ' || ws[i + 1]))) as f from said
), wanted as materialized (
  select unnest(list_concat(ws, list_transform(range(1, len(ws)), lambda i: ws[i] || ' ' || ws[i + 1]))) as f from asked
), steps as (
  select list(v order by i) as tab from (
    select i, list_reduce(list_prepend(i, range(8)), lambda c, k: case when c % 2 = 1 then xor(c // 2, 3988292384) else c // 2 end) as v
    from range(256) as t(i)
  )
), distinct_features as (
  select f, hex(encode(f)) as h from (select f from features union select f from wanted)
), hashed as materialized (
  select f, xor(list_reduce(list_prepend(cast(4294967295 as bigint), list_transform(range(len(h) // 2), lambda k: cast('0x' || substr(h, 2 * k + 1, 2) as bigint))),
                            lambda c, b: xor(tab[xor(c, b) % 256 + 1], c // 256)), cast(4294967295 as bigint)) % 10000 as bucket
  from distinct_features, steps
), raw as (
  select bucket, count(*) as s from features join hashed using (f) group by bucket
), target as (
  select bucket, count(*) as t from wanted join hashed using (f) group by bucket
), totals as (
  select (select count(*) from features) as ss, (select count(*) from wanted) as tt
), gains as (
  select b.bucket, cast(floor(1000 * ln(cast((coalesce(t, 0) + 1) * (ss + 10000) as double) / ((coalesce(s, 0) + 1) * (tt + 10000)))) as bigint) as gain
  from range(10000) as b(bucket) left join raw using (bucket) left join target using (bucket), totals
), weights as (
  select row, count(*) as n_features, cast(sum(gain) as bigint) as total from features join hashed using (f) join gains using (bucket) group by row
), scored as (
  select row, doc_id, len(ws) as n_words, coalesce(n_features, 0) as n_features,
         coalesce((total - ((total % n_features) + n_features) % n_features) // n_features, 0) as weight,
         cast('0x' || substr(sha256('7:' || doc_id), 1, 8) as bigint) as h
  from said left join weights using (row)
), ranked as (
  select *, weight + cast(floor(-1000 * ln(-ln((h + 0.5::double) / 4294967296::double))) as bigint) as score from scored
), eligible as (
  select row, row_number() over (order by score desc, doc_id, n_features, weight) as place, count(*) over () as n
  from ranked where n_words >= 20 and score is not null
)
select doc_id, n_features, weight, score, case when place <= 25 * n // 100 then place end as rank
from ranked left join eligible using (row)
"""


@register
def op13_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(_table(spark, sf_dir, "documents", "doc_id", "text", "source")).select("doc_id", "size", "source_size", "target", "taken")


LLM_ORACLES["op13_source_mix"] = r"""
with recursive sized as (
  select row_number() over () as row, doc_id, source, cast(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) as bigint) as size
  from documents
), sources as (
  select source, sum(size) as source_size, row_number() over (order by source nulls last) - 1 as number from sized group by source
), weighed as (
  select *, 3 * source_size as cap, number % 3 + 1 as weight from sources
), rounds as (
  select 0 as step, cast(-1 as bigint) as over, cast(0 as bigint) as now, cast(sum(source_size) as bigint) as remaining, cast(sum(weight) as bigint) as parts from weighed
  union all
  select step + 1, now, n, total - used, rest from (
    select step, now, count(*) filter (cap * parts < remaining * weight) as n, cast(sum(source_size) as bigint) as total,
           cast(coalesce(sum(cap) filter (cap * parts < remaining * weight), 0) as bigint) as used,
           greatest(1, cast(coalesce(sum(weight) filter (cap * parts >= remaining * weight), 0) as bigint)) as rest
    from rounds, weighed where over <> now group by step, now
  )
), last as (
  select remaining, parts from rounds qualify row_number() over (order by step desc) = 1
), targets as (
  select number, source, cast(source_size as bigint) as source_size,
         case when cap < remaining * weight / parts then cast(cap as double) else cast(remaining * weight as double) / parts end as target
  from weighed, last
), owed as (
  select *, source_size // 512 as whole, (source_size + 511) // 512 as n, least(cast(round(target) as bigint), 3 * source_size) as owed from targets
), slotted as (
  select *, owed // source_size as passes, owed % source_size as rest from owed where source_size > 0 and owed > 0
), passed as (
  select number, whole, p as pass, case when p < passes then source_size else rest end as here from slotted, lateral (select unnest(range(passes + 1)) as p)
), keyed as (
  select *, list_transform(range(1, 25), lambda r: md5('13:block:' || number || ':' || pass || ':' || r)) as hs from passed
), keys as (
  select number, whole, pass, here,
         list_transform(hs, lambda h: cast('0x' || substr(h, 15, 14) as bigint) % greatest(whole, 1)) as k,
         list_transform(hs, lambda h: cast('0x' || substr(h, 1, 7) as bigint) + 1) as a,
         list_transform(hs, lambda h: cast('0x' || substr(h, 8, 7) as bigint)) as b
  from keyed
), slots as (
  select *, s as nth from keys, lateral (select unnest(range((here + 511) // 512)) as s)
), drawn as (
  select number, least(512, here - nth * 512) as words, case when nth >= whole then nth else
         list_reduce(list_prepend(nth, range(1, 25)), lambda x, r:
           case when ((greatest(x, ((k[r] - x) % whole + whole) % whole) % 2147483647 * a[r] + b[r]) % 2147483647) // 32768 % 2 = 1
                then ((k[r] - x) % whole + whole) % whole else x end) end as block
  from slots
), begun as (
  select row, number, size, coalesce(sum(size) over (partition by number order by doc_id nulls last, size, row rows between unbounded preceding and 1 preceding), 0) as start
  from sized join sources on sized.source is not distinct from sources.source
), taken as (
  select row, sum(least(start + size, block * 512 + words) - greatest(start, block * 512)) as n
  from begun join drawn using (number) where block * 512 < start + size and block * 512 + words > start group by row
)
select doc_id, size, source_size, target, cast(coalesce(n, 0) as bigint) as taken
from sized join targets on sized.source is not distinct from targets.source left join taken using (row)
"""


LLM_REGISTRY["pipeline"] = corpus_pipeline.run
if corpus_pipeline.ORACLE_SQL is not None:
    LLM_ORACLES["pipeline"] = corpus_pipeline.ORACLE_SQL
