"""The registered queries of this subpackage; each applies an operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import additive_ann, decontaminate, fill_middle, html_main, metric_join, piece_codec, quartile_digest, sharding, token_archive, toxicity, unit_dedup, vector_codes, warc
from .common import scratch_path


ARRIVALS = 4
PASSAGE_WORDS = 20  # repeats of fewer words in a row are stock phrases, which clean documents share


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents arrive in four parts, one after the other, are compacted, and are read back through the last manifest."""
    root = scratch_path(spark, "sharding")
    docs = _table(spark, sf_dir, "documents")
    for part in range(ARRIVALS):
        sharding.append(docs.where(F.pmod(F.xxhash64("doc_id"), F.lit(ARRIVALS)) == part), root)
    version = sharding.compact(spark, root)
    sharding.vacuum(spark, root, version)
    rows = sharding.read(spark, root, version)
    return rows.select("doc_id", "lang", "source", "n_chars", F.sha2(F.col("text").cast("binary"), 256).alias("text_sha256"))


def op2_token_archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return token_archive.read_archive(token_archive.archive_documents(docs, public_tokenizers.path("word_bpe_49k.json"), end_id=2))


def op3_html_main(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_main.extract(_table(spark, sf_dir, "pages"))


def op4_piece_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return piece_codec.round_trip(docs, public_tokenizers.path("piece_bpe_32k.model"))


def op5_unit_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row for each repeated passage: documents without one don't appear. The operator itself reports shorter repeats too."""
    runs = unit_dedup.repeated_runs(_table(spark, sf_dir, "documents"), PASSAGE_WORDS)
    return runs.withColumn("kept_in", F.array_join("kept_in", "|")).drop("version")


def op6_metric_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metric_join.join_components(_table(spark, sf_dir, "documents"))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score_documents(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op8_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.matches(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op9_additive_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    return additive_ann.search(_table(spark, sf_dir, "embeddings"))


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.page_records(warc.write_warc(_table(spark, sf_dir, "pages")))


def op11_quartile_digest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quartile_digest.with_next(_table(spark, sf_dir, "documents"))


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes.compress(_table(spark, sf_dir, "embeddings"))


def op13_fill_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = fill_middle.transform(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    sha256 = lambda text: F.sha2(text.cast("binary"), 256)
    restored = fill_middle.restore(F.col("output"), F.col("form"))
    return made.select("row.doc_id", "n", "form", "prefix_chars", "middle_chars", sha256(F.col("output")).alias("output_sha256"), sha256(restored).alias("restored_sha256"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = (op1_sharding, op2_token_archive, op3_html_main, op4_piece_codec, op5_unit_dedup, op6_metric_join, op7_toxicity, op8_decontaminate, op9_additive_ann, op10_warc)
    return {f.__name__: f for f in (*found, op11_quartile_digest, op12_vector_codes, op13_fill_middle)}


def oracle_sql() -> dict[str, str]:
    found = {"op1_sharding": SHARDING, "op5_unit_dedup": UNIT_DEDUP, "op6_metric_join": METRIC_JOIN, "op10_warc": WARC}
    return found | {"op11_quartile_digest": QUARTILE_DIGEST, "op12_vector_codes": VECTOR_CODES, "op13_fill_middle": FILL_MIDDLE}


SHARDING = """
select doc_id, lang, source, n_chars, sha256(text) as text_sha256 from documents
"""

# a mark goes before each line's end and behind each sign that white space follows; units are what stands between marks
_WHITE = "chr(9) || chr(10) || chr(11) || chr(12) || chr(13) || ' '"
UNIT_DEDUP = f"""
with t as (select doc_id, string_split(replace(regexp_replace(text, '([.!?])([ \\t\\n\\v\\f\\r])', '\\1' || chr(57344) || '\\2', 'g'), chr(10), chr(57344) || chr(10)), chr(57344)) as parts from documents where text is not null),
p as (select doc_id, unnest(parts) as piece, generate_subscripts(parts, 1) as i from t),
o as (select *, coalesce(sum(length(piece)) over (partition by doc_id order by i rows between unbounded preceding and 1 preceding), 0) as off, trim(regexp_replace(lower(piece), '[ \\t\\n\\v\\f\\r]+', ' ', 'g')) as norm from p),
u as (select doc_id, off + length(piece) - length(ltrim(piece, {_WHITE})) as s, off + length(piece) as e, norm, len(string_split(norm, ' ')) as words, row_number() over (partition by doc_id order by i) as place from o where norm <> ''),
r as (select *, row_number() over (partition by norm order by doc_id, place) as nth, first_value(doc_id) over (partition by norm order by doc_id, place) as kept from u),
l as (select *, place - row_number() over (partition by doc_id order by place) as run from r where nth > 1)
select doc_id, cast(min(s) as integer) as start, cast(max(e) as integer) as "end", count(*) as n_units, cast(sum(words) as bigint) as n_words, array_to_string(list_sort(list(distinct kept)), '|') as kept_in from l group by doc_id, run having sum(words) >= {PASSAGE_WORDS}
"""

METRIC_JOIN = r"""
with recursive d as (select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as w from documents),
s as (select doc_id, case when len(w) = 0 then [] when len(w) < 5 then [array_to_string(w, ' ')] else list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) end as g from d),
k as (select doc_id, len(g) as n, case when len(g) > 0 then sha256(array_to_string(list_sort(g), chr(10))) end as key, g from s),
c as (select key, min(doc_id) as id, count(*) as copies, any_value(n) as n, any_value(g) as g from k where key is not null group by key),
x as (select id, n, unnest(g) as h from c),
links as (select a.id as a, b.id as b from x a join x b on a.h = b.h and a.id <> b.id and least(a.n, b.n) * 100 >= greatest(a.n, b.n) * 80 group by a.id, b.id, a.n, b.n having 100 * count(*) >= 80 * (a.n + b.n - count(*))),
reach as (select id as a, id as b from c union select reach.a, links.b from reach join links on reach.b = links.a),
comp as (select a, min(b) as component from reach group by a)
select doc_id, k.n as n_shingles, coalesce(component, doc_id) as component_id, coalesce(c.id, doc_id) as class_id, coalesce(copies, 1) as copies from k left join c using (key) left join comp on comp.a = c.id
"""

# five hexadecimal digits of a SHA-1 are four digits to the base of 32
WARC = """
with d as (select page_id, strlen(coalesce(html, '')) as payload_bytes, sha1(coalesce(html, '')) as x from pages), f as (select x, min(page_id) as first from d group by x)
select page_id, payload_bytes, array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + ((cast('0x' || substr(x, 5 * (i // 4) + 1, 5) as bigint) >> (15 - 5 * (i % 4))) & 31), 1)), '') as payload_digest,
  case when page_id > first then 'revisit' else 'response' end as record_type, case when page_id > first then first end as refers_to from d join f using (x)
"""

# a text's bytes are a list of small integers; the header's digits and the bounded difference are spelled out
QUARTILE_DIGEST = """
with d as (select doc_id, coalesce(text, '') as t, length(coalesce(text, '')) as n, coalesce(lead(coalesce(text, '')) over (order by doc_id), first_value(coalesce(text, '')) over (order by doc_id)) as following, coalesce(lead(doc_id) over (order by doc_id), first_value(doc_id) over (order by doc_id)) as next_id from documents),
e as (select *, t[1:n - n // 2] || following[1:n // 2] as edited from d),
b as (select doc_id, 'own' as side, t from e union all select doc_id, 'edited', edited from e),
x as (select doc_id, side, strlen(t) as size, list_transform(regexp_extract_all('0000' || hex(encode(t)) || '0000', '..'), lambda h: cast('0x' || h as bigint)) as raw from b),
u as (select doc_id, side, raw, unnest(range(1, size + 3)) as i from x),
h as (select doc_id, side, ((raw[i] * 2654435761 + raw[i + 1] * 2246822507 + raw[i + 2] * 3266489909) & 4294967295) >> 24 as bucket from u),
c as (select doc_id, side, bucket, count(*) as c from h group by all),
f as (select doc_id, side, size, list_transform(range(0, 256), lambda k: coalesce(m[k], 0)) as counts from x join (select doc_id, side, map(list(bucket), list(c)) as m from c group by all) using (doc_id, side)),
q as (select *, list_sort(counts)[64] as q1, list_sort(counts)[128] as q2, list_sort(counts)[192] as q3 from f),
g as (select doc_id, side, list_transform(counts, lambda k: (k > q1)::int + (k > q2)::int + (k > q3)::int) as codes, case when q3 > 0 then least(15, 16 * q1 // q3) else 0 end as s1, case when q3 > 0 then least(15, 16 * q2 // q3) else 0 end as s2,
  case when size > 0 then 4 * length(bin(size)) + 2 * substr(bin(size) || '00', 2, 1)::int + substr(bin(size) || '00', 3, 1)::int else 0 end as size_code from q),
o as (select *, lower(printf('%02x%x%x', size_code, s1, s2) || array_to_string(list_transform(range(0, 64), lambda j: printf('%02x', 64 * codes[4 * j + 1] + 16 * codes[4 * j + 2] + 4 * codes[4 * j + 3] + codes[4 * j + 4])), '')) as fingerprint from g),
pairs as (select e.doc_id, e.n, e.edited, a.fingerprint, z.fingerprint as edited_fingerprint, a, z, y from e join o a on a.doc_id = e.doc_id and a.side = 'own' join o z on z.doc_id = e.doc_id and z.side = 'edited' join o y on y.doc_id = e.next_id and y.side = 'own'),
s as (select *, list_sum(list_transform(range(1, 257), lambda j: [0, 1, 2, 6][1 + abs(a.codes[j] - z.codes[j])])) + abs(a.s1 - z.s1) + abs(a.s2 - z.s2) + least(16, abs(a.size_code - z.size_code)) as apart_edited,
  list_sum(list_transform(range(1, 257), lambda j: [0, 1, 2, 6][1 + abs(a.codes[j] - y.codes[j])])) + abs(a.s1 - y.s1) + abs(a.s2 - y.s2) + least(16, abs(a.size_code - y.size_code)) as apart_next from pairs)
select doc_id, n as n_chars, sha256(edited) as edited_sha256, fingerprint, edited_fingerprint, 1 - least(apart_edited, 832)::double / 832 as near_edited, 1 - least(apart_next, 832)::double / 832 as near_next from s
"""


def _vector_codes_sql(rounds: int = 4) -> str:
    """Distances in doubles, which are exact here: all integers stay far below 2^53."""
    steps = []
    for i in range(rounds + 1):
        steps.append(
            f"near{i} as (select id, p, vec, arg_min(e, (list_inner_product(c, c) - 2 * list_inner_product(vec, c), e)) as e, min(list_inner_product(vec, vec) - 2 * list_inner_product(vec, c) + list_inner_product(c, c)) as apart from parts join book{i} using (p) group by id, p, vec)"
        )
        if i < rounds:
            steps.append(f"sums{i} as (select p, e, j, cast(sum(x) as bigint) as s, count(*) as n from (select p, e, unnest(range(1, len(vec) + 1)) as j, unnest(vec) as x from near{i}) group by all)")
            steps.append(f"means{i} as (select p, e, list(cast((s - ((s % n) + n) % n) // n as double) order by j) as c from sums{i} group by p, e)")
            steps.append(f"book{i + 1} as materialized (select p, e, coalesce(m.c, b.c) as c from book{i} b left join means{i} m using (p, e))")
    ctes = ",\n".join(steps)
    return f"""
with kept as (select vec_id, label, list_transform(embedding, lambda x: floor(1024 * cast(x as double))) as v from embeddings where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
rows as (select *, row_number() over (order by vec_id, v) as id from kept),
parts as materialized (select id, p, v[p * len(v) // 4 + 1:(p + 1) * len(v) // 4] as vec from rows, range(0, 4) t(p)),
book0 as materialized (select p, id - 1 as e, vec as c from parts where id <= 256),
{ctes},
coded as (select id, string_agg(printf('%02x', e), '' order by p) as code, cast(sum(apart) as bigint) as error from near{rounds} group by id),
digest as (select sha256(string_agg(array_to_string(list_transform(c, lambda x: cast(cast(x as bigint) as varchar)), ','), ',' order by p, e)) as codebooks_sha256 from book{rounds})
select vec_id, code, error, cast(sum(error) over (partition by label) as bigint) as label_error, codebooks_sha256 from coded join rows using (id), digest
"""


VECTOR_CODES = _vector_codes_sql()

FILL_MIDDLE = """
with d as (select doc_id, coalesce(text, '') as t, sha256('1:' || coalesce(cast(doc_id as varchar), '')) as h from documents),
u as (select *, regexp_extract_all(t, '[A-Za-z]+|[^A-Za-z]') as units, list_transform(range(0, 4), lambda i: cast('0x' || substr(h, 8 * i + 1, 8) as bigint)) as r from d),
k as (select *, len(units) as n, least(r[1] % (len(units) + 1), r[2] % (len(units) + 1)) as a, greatest(r[1] % (len(units) + 1), r[2] % (len(units) + 1)) as b from u),
p as (select *, array_to_string(units[1:a], '') as prefix, array_to_string(units[a + 1:b], '') as middle, array_to_string(units[b + 1:], '') as suffix,
  case when t = '' or contains(t, '<P>') or contains(t, '<S>') or contains(t, '<M>') or r[3] % 100 >= 90 then 'plain' when r[4] % 100 < 20 then 'spm' else 'psm' end as form from k)
select doc_id, n, form, case when form <> 'plain' then length(prefix) end as prefix_chars, case when form <> 'plain' then length(middle) end as middle_chars,
  sha256(case form when 'plain' then t when 'psm' then '<P>' || prefix || '<S>' || suffix || '<M>' || middle else '<S>' || suffix || '<P>' || prefix || '<M>' || middle end) as output_sha256, sha256(t) as restored_sha256 from p
"""
