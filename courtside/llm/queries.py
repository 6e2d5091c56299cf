"""The queries of this subpackage, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from courtside.llm import byte_pairs
from courtside.llm.archives import archived
from courtside.llm.decontamination import contamination
from courtside.llm.filter_audit import filter_interactions
from courtside.llm.hidden_markov import text_scores
from courtside.llm.language import languages
from courtside.llm.licenses import license_labels
from courtside.llm.manifest import manifest
from courtside.llm.mixing import mix_sources
from courtside.llm.near_documents import near_documents
from courtside.llm.near_vectors import near_vectors
from courtside.llm.neighbours import neighbours
from courtside.llm.quality import quality
from courtside.llm.sending import small_batches

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(build):
        @wraps(build)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            small_batches(spark)
            return build(spark, sf_dir)

        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = sql
        return build

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


LINKED_VECTORS = """
with recursive v as (
  select vec_id, embedding::double[] as e from embeddings
), pair as (
  select a.vec_id as a, b.vec_id as b from v a join v b on a.vec_id <> b.vec_id
  where list_cosine_similarity(a.e, b.e) >= 0.9
), reach(a, b) as (
  select vec_id, vec_id from v union select r.a, p.b from reach r join pair p on r.b = p.a
), least as (select a, min(b) as c from reach group by a)
select vec_id, (select count(*) from pair p where p.a = v.vec_id) as n_links, c as component_id, c = vec_id as kept
from v join least on a = vec_id
"""


@query("op1_near_vectors", LINKED_VECTORS)
def _op1(spark, sf_dir):
    return near_vectors(table(spark, sf_dir, "embeddings"), threshold=0.9)


@query("op2_hidden_markov")
def _op2(spark, sf_dir):
    return text_scores(table(spark, sf_dir, "documents"))


@query("op3_quality")
def _op3(spark, sf_dir):
    return quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op4_languages")
def _op4(spark, sf_dir):
    return languages(table(spark, sf_dir, "documents"))


@query("op5_byte_pairs")
def _op5(spark, sf_dir):
    import public_tokenizers

    tokens = byte_pairs.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    return byte_pairs.digests(table(spark, sf_dir, "documents"), tokens, public_tokenizers.PATTERN)


MIXED_SOURCES = r"""
with d as (
  select doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::bigint as size,
    ('0x' || substr(md5(doc_id::varchar), 1, 15))::bigint as k
  from documents
), s as (
  select source, sum(size)::bigint as source_size, ((row_number() over (order by source nulls last) - 1) % 3 + 1)::bigint as weight
  from d group by source
), l as (
  select *, source_size * 3 as room, (source_size * 3)::double / weight::double as per_weight from s
), f as (
  select *, row_number() over w as pos,
    (sum(source_size) over () - coalesce(sum(room) over (w rows between unbounded preceding and 1 preceding), 0))::double
    / (sum(weight) over () - coalesce(sum(weight) over (w rows between unbounded preceding and 1 preceding), 0))::double as lvl
  from l window w as (order by per_weight, source nulls last)
), g as (select min_by(lvl, pos) as lvl from f where per_weight >= lvl
), t as (
  select f.source, source_size, least(room::double, coalesce(g.lvl * weight, room::double)) as target from f, g
), p as (
  select d.*, source_size, target, case when source_size > 0 then floor(target / source_size) else 0 end::bigint as full_epochs,
    coalesce(sum(size) over (partition by d.source order by k, doc_id, size rows between unbounded preceding and 1 preceding), 0) as place
  from d join t on d.source is not distinct from t.source
)
select doc_id, size, source_size, target,
  case when size > 0 then size * (full_epochs + case when (2 * place + size)::double <= 2 * (target - full_epochs * source_size) then 1 else 0 end)
  else 0 end::bigint as taken
from p
"""


@query("op6_mix_sources", MIXED_SOURCES)
def _op6(spark, sf_dir):
    return mix_sources(table(spark, sf_dir, "documents")).drop("copies")


ARCHIVED_PAGES = """
with p as (
  select page_id, coalesce(html, '') as body, octet_length(encode(coalesce(html, '')))::bigint as payload_bytes from pages
), d as (
  select page_id, payload_bytes, sha1(body) as payload_digest, max(page_id) over (partition by body) as last_id from p
)
select page_id, payload_bytes, payload_digest,
  case when payload_bytes >= 1000 and page_id <> last_id then 'revisit' else 'response' end as record_type,
  case when payload_bytes >= 1000 and page_id <> last_id then last_id end as refers_to
from d
"""


@query("op7_archives", ARCHIVED_PAGES)
def _op7(spark, sf_dir):
    return archived(table(spark, sf_dir, "pages"))


@query("op8_near_documents")
def _op8(spark, sf_dir):
    return near_documents(table(spark, sf_dir, "documents"), k=4, percent=80)


@query("op9_neighbours")
def _op9(spark, sf_dir):
    return neighbours(table(spark, sf_dir, "embeddings"), every=20, k=20)


@query("op10_licenses")
def _op10(spark, sf_dir):
    return license_labels(table(spark, sf_dir, "documents"))


HIT_WORDS = r"""
with d as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from documents
), i as (
  select coalesce(item_id::varchar, '') as item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from benchmark
), window_of as (
  select distinct item_id, least(len(w), 10) as m, array_to_string(w[p : p + least(len(w), 10) - 1], ' ') as passage
  from (select item_id, w, unnest(range(1, len(w) - least(len(w), 10) + 2)) as p from i where len(w) > 0)
), place as (
  select doc_id, p, m, array_to_string(w[p : p + m - 1], ' ') as passage
  from (select doc_id, w, m, unnest(range(1, len(w) - m + 2)) as p from d, (select distinct m from window_of))
), hit as (
  select doc_id, p, place.m, item_id from place join window_of on place.m = window_of.m and place.passage = window_of.passage
), word as (
  select doc_id, count(distinct q) as n_hit from (select doc_id, unnest(range(p, p + m)) as q from (select distinct doc_id, p, m from hit)) group by doc_id
), owner as (
  select doc_id, count(distinct item_id) as n_items, string_agg(distinct item_id, ',' order by item_id) as items from hit group by doc_id
)
select doc_id, len(w)::bigint as n_words, coalesce(n_hit, 0)::bigint as n_hit, coalesce(n_items, 0)::bigint as n_items,
  sha256(coalesce(items, '')) as items_sha256, n_hit is not null as contaminated
from d left join word using (doc_id) left join owner using (doc_id)
"""


@query("op11_decontamination", HIT_WORDS)
def _op11(spark, sf_dir):
    return contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


FILTER_STEPS = r"""
with w as (
  select doc_id, coalesce(source, '') as part, coalesce(text, '') as t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as words from documents
), d as (
  select part, coalesce(l.quality = 1, false) as good, coalesce(l.toxic = 1, false) as toxic, [
    len(words) < 200,
    100 * len(list_distinct(words)) < 50 * len(words),
    100 * (length(t) - length(regexp_replace(t, '[A-Z]', '', 'g'))) > 2 * length(t),
    regexp_matches(t, '[#$%&*|]'),
    coalesce(w.doc_id > min(w.doc_id) over (partition by t), false)
  ] as fails from w left join labels l on w.doc_id = l.doc_id
), letter as (
  select * from (values ('A', 1), ('B', 2), ('C', 3), ('D', 4), ('E', 5)) as v(f, i)
), orders as (
  select a.f || b.f || c.f || d.f || e.f as filter_order, [a.i, b.i, c.i, d.i, e.i] as seq
  from letter a, letter b, letter c, letter d, letter e
  where len(list_distinct([a.i, b.i, c.i, d.i, e.i])) = 5
), counted as (
  select part, good, toxic, fails, count(*) as n from d group by all
), judged as (
  select part, filter_order, step, good, toxic, n, fails[seq[step]] as fails_here,
    list_bool_or(list_transform(seq[1 : step - 1], lambda i: fails[i])) is true as gone,
    list_sum(list_transform(fails, lambda x: x::int)) = 1 as fails_once, seq[step] as f
  from counted, orders, range(1, 6) as s(step)
), figures as (
  select part, filter_order, step, f, sum(case when not gone and not fails_here then n else 0 end) as kept,
    sum(case when not gone and fails_here then n else 0 end) as removed, sum(case when gone and fails_here then n else 0 end) as redundant,
    sum(case when fails_here and fails_once then n else 0 end) as unique_fails,
    sum(case when not gone and fails_here and good then n else 0 end) as good_lost,
    sum(case when not gone and fails_here and toxic then n else 0 end) as toxic_lost
  from judged group by all
)
select part, filter_order, step::int as step, kept::bigint as kept, removed::bigint as removed, redundant::bigint as redundant,
  unique_fails::bigint as unique_fails, good_lost::bigint as good_lost, toxic_lost::bigint as toxic_lost,
  (sum(removed) over (partition by part, f))::bigint as shapley
from figures
"""


@query("op12_filter_audit", FILTER_STEPS)
def _op12(spark, sf_dir):
    return filter_interactions(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


MERKLE_PROOFS = r"""
with recursive field as (
  select doc_id, source, lang, n_chars, text, unnest([false, true]) as tampered from documents
), changed as (
  select doc_id, source, tampered, [
    doc_id::varchar, source, lang, n_chars::varchar, case when tampered and even then replace(text, chr(10), '') else text end
  ] as v
  from (
    select *, list_reduce(list_prepend(4294967295, list_transform(range(1, length(doc_id::varchar) + 1), lambda p: ord(substr(doc_id::varchar, p, 1))::bigint)),
      lambda x, b: list_reduce(list_prepend(xor(x, b), range(8)), lambda y, k: case when y & 1 = 1 then xor(y >> 1, 3988292384) else y >> 1 end)) & 1 = 1 as even
    from field
  )
), hashed as (
  select doc_id, source, tampered, sha256(array_to_string(list_transform(v, lambda x: case when x is null then '-' else octet_length(encode(x))::varchar || ':' || x end), '')) as leaf
  from changed
), leaf as (
  select doc_id, source, leaf, row_number() over (partition by source order by doc_id nulls first, leaf) - 1 as place from hashed where not tampered
), up(source, level, place, node) as (
  select source, 0, place, leaf from leaf
  union all
  select distinct source, level + 1, place // 3, sha256(string_agg(node, '') over (partition by source, place // 3 order by place rows between unbounded preceding and unbounded following))
  from (select *, count(*) over (partition by source) as n from up) where n > 1
), subroot as (
  select source, arg_max(node, level) as node, row_number() over (order by source nulls first) - 1 as place from up group by source
), top(level, place, node) as (
  select 0, place, node from subroot
  union all
  select distinct level + 1, place // 3, sha256(string_agg(node, '') over (partition by place // 3 order by place rows between unbounded preceding and unbounded following))
  from (select *, count(*) over () as n from top) where n > 1
), run as (
  select source, level, place, string_agg(node, '') filter (where p < place) as before, string_agg(node, '') filter (where p > place) as after
  from (select a.source, a.level, a.place, b.place as p, b.node from up a join up b on a.source is not distinct from b.source and a.level = b.level and a.place // 3 = b.place // 3 order by b.place)
  group by all
), top_run as (
  select level, place, string_agg(node, '') filter (where p < place) as before, string_agg(node, '') filter (where p > place) as after
  from (select a.level, a.place, b.place as p, b.node from top a join top b on a.level = b.level and a.place // 3 = b.place // 3 order by b.place)
  group by all
), height as (select source, max(level) as top from up group by source
), fold(doc_id, source, place, level, proof, x) as (
  select l.doc_id, l.source, l.place, 0, '', t.leaf from leaf l join hashed t on t.tampered and l.source is not distinct from t.source and l.doc_id is not distinct from t.doc_id
  union all
  select f.doc_id, f.source, f.place // 3, f.level + 1, f.proof || coalesce(r.before, '') || coalesce(r.after, ''), sha256(coalesce(r.before, '') || f.x || coalesce(r.after, ''))
  from fold f join height h on f.source is not distinct from h.source and f.level < h.top
  join run r on f.source is not distinct from r.source and f.level = r.level and f.place = r.place
), fold_top(doc_id, source, place, level, proof, x) as (
  select f.doc_id, f.source, s.place, 0, f.proof, f.x from fold f join height h on f.source is not distinct from h.source and f.level = h.top
  join subroot s on f.source is not distinct from s.source
  union all
  select f.doc_id, f.source, f.place // 3, f.level + 1, f.proof || coalesce(r.before, '') || coalesce(r.after, ''), sha256(coalesce(r.before, '') || f.x || coalesce(r.after, ''))
  from fold_top f join top_run r on f.level = r.level and f.place = r.place where f.level < (select max(level) from top)
)
select f.doc_id, l.leaf, s.node as subroot, t.node as root, sha256(f.proof) as proof_sha256, f.x as folded_root, f.x = t.node as verified
from fold_top f join leaf l on f.doc_id is not distinct from l.doc_id and f.source is not distinct from l.source
join subroot s on f.source is not distinct from s.source
join (select * from top order by level desc limit 1) t on f.level = t.level
"""


@query("op13_manifest", MERKLE_PROOFS)
def _op13(spark, sf_dir):
    return manifest(table(spark, sf_dir, "documents"))
