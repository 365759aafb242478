"""The registered queries opN_<name>, their DuckDB SQL, and the pipeline query."""

from __future__ import annotations

from pyspark.sql import functions as F

from tripkpi.llm.byte_convnet import quality
from tripkpi.llm.decontaminate import contamination
from tripkpi.llm.fill_in_middle import fill_in_middle, restored
from tripkpi.llm.html_consensus import main_text
from tripkpi.llm.kmeans_tree_ann import search
from tripkpi.llm.line_dedup import dedup_lines
from tripkpi.llm.minhash_hamming import near_duplicates
from tripkpi.llm.ppm_langid import languages
from tripkpi.llm.source_mix import mix
from tripkpi.llm.spelling_variants import spelling_variants
from tripkpi.llm.splitter_shards import shard
from tripkpi.llm.suffix_dedup import remove_repeats
from tripkpi.llm.tables import table
from tripkpi.llm.warc_normaliser import archived


def op1_minhash_hamming(spark, sf_dir):
    return near_duplicates(table(spark, sf_dir, "documents"))


def op2_kmeans_tree_ann(spark, sf_dir):
    return search(table(spark, sf_dir, "embeddings"))


def op3_source_mix(spark, sf_dir):
    return mix(table(spark, sf_dir, "documents"))


def op4_html_consensus(spark, sf_dir):
    return main_text(table(spark, sf_dir, "pages"))


def op5_byte_convnet(spark, sf_dir):
    return quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6_splitter_shards(spark, sf_dir):
    return shard(table(spark, sf_dir, "documents"))


def op7_line_dedup(spark, sf_dir):
    return dedup_lines(table(spark, sf_dir, "documents"))


def op8_suffix_dedup(spark, sf_dir):
    return remove_repeats(table(spark, sf_dir, "documents"), texts=False).drop("kept", "spans")


def op9_ppm_langid(spark, sf_dir):
    return languages(table(spark, sf_dir, "documents"))


def op10_decontaminate(spark, sf_dir):
    hits = contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return hits.drop("item_ids", "hit_words")


def op11_fill_in_middle(spark, sf_dir):
    back = restored(fill_in_middle(table(spark, sf_dir, "documents")))
    return back.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
                       F.sha2("restored", 256).alias("restored_sha256"))


def op12_spelling_variants(spark, sf_dir):
    return spelling_variants(table(spark, sf_dir, "documents"))


def op13_warc_normaliser(spark, sf_dir):
    return archived(table(spark, sf_dir, "pages")).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


QUERIES = {f.__name__: f for f in (op1_minhash_hamming, op2_kmeans_tree_ann, op3_source_mix, op4_html_consensus, op5_byte_convnet,
                                   op6_splitter_shards, op7_line_dedup, op8_suffix_dedup, op9_ppm_langid, op10_decontaminate,
                                   op11_fill_in_middle, op12_spelling_variants, op13_warc_normaliser)}

_WORDS10 = (r"regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
            r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')")

ORACLES = {
    "op1_minhash_hamming": r"""
with recursive
d as (select doc_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                 '[^\x20\x09-\x0D]+'), []) as w from documents),
s as (select distinct doc_id, array_to_string(w[i:i + 4], ' ') as g
      from (select doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) as i from d where len(w) > 0)),
n as (select doc_id, count(*) as n from s group by doc_id),
g as (select g, row_number() over () as gid from (select g from s group by g having count(*) > 1)),
t as (select doc_id, gid from s join g using (g)),
p as (select a.doc_id as a, b.doc_id as b, count(*) as k from t a join t b on a.gid = b.gid and a.doc_id < b.doc_id
      group by all),
l as (select a, b from p join n x on x.doc_id = a join n y on y.doc_id = b where 100 * k >= 85 * (x.n + y.n - k)),
e as (select a, b from l union all select b, a from l),
r(id, hop) as (select doc_id, doc_id from documents union select r.id, e.b from r join e on e.a = r.hop)
select d.doc_id, coalesce(n.n, 0)::bigint as n_shingles, c.component_id, d.doc_id = c.component_id as kept
from d left join n using (doc_id) join (select id, min(hop) as component_id from r group by id) c on c.id = d.doc_id
""",
    "op7_line_dedup": r"""
with u as (select doc_id, i as unit_no, lines[i] as line
           from (select doc_id, lines, unnest(range(1, len(lines) + 1)) as i
                 from (select doc_id, string_split(text, chr(10)) as lines from documents where text is not null))),
l as (select *, coalesce(sum(length(line) + 1) over (partition by doc_id order by unit_no
                                                     rows between unbounded preceding and 1 preceding), 0) as lo from u),
c as (select *, regexp_extract_all(line, '[^.!?]+[.!?]*|[.!?]+') as parts from l),
s as (select doc_id, unit_no, lo, parts, unnest(range(1, len(parts) + 1)) as k from c where len(parts) > 1),
x as (select doc_id, unit_no, 0 as k, line as piece, lo from l
      union all
      select doc_id, unit_no, k, parts[k], lo + length(array_to_string(parts[1:k - 1], '')) from s),
n as (select *, trim(regexp_replace(translate(piece, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[\x20\x09-\x0D]+', ' ', 'g'), ' ') as norm from x),
p as (select *, row_number() over (partition by norm order by doc_id, unit_no, k) > 1
                and length(norm) - length(replace(norm, ' ', '')) >= 4 as late from n),
w as (select doc_id, unit_no from p where k = 0 and late),
gone as (select p.* from p left join w using (doc_id, unit_no) where late and (k = 0 or w.unit_no is null)),
kept as (select p.doc_id, p.unit_no, string_agg(p.piece, '' order by p.k) as piece
         from p left join w using (doc_id, unit_no) left join (select doc_id, unit_no, len(parts) as m from c) using (doc_id, unit_no)
         where w.unit_no is null and not p.late and (p.k > 0 or m <= 1) group by p.doc_id, p.unit_no),
t as (select doc_id, string_agg(piece, chr(10) order by unit_no) as text from kept group by doc_id),
g as (select doc_id, count(*) as n_removed,
             string_agg(lo::bigint || '-' || (lo + length(piece))::bigint, ',' order by unit_no, k) as spans from gone group by doc_id)
select d.doc_id, case when d.text is null then 0 else len(string_split(d.text, chr(10))) end::bigint as n_units,
       coalesce(n_removed, 0)::bigint as n_removed, coalesce(spans, '') as removed_spans,
       case when d.text is not null then coalesce(t.text, '') end as text
from documents d left join t using (doc_id) left join g using (doc_id)
""",
    "op10_decontaminate": f"""
with d as (select row_number() over () as rid, doc_id, coalesce({_WORDS10}, []) as w from documents),
b as (select item_id, {_WORDS10} as w from benchmark where text is not null),
g as (select distinct item_id, least(10, len(w)) as size,
             array_to_string(w[i:i + least(10, len(w)) - 1], ' ') as gram
      from (select item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) as i from b where len(w) > 0)),
s as (select distinct size from g),
x as (select rid, size, i, array_to_string(w[i:i + size - 1], ' ') as gram
      from (select rid, w, size, unnest(range(1, len(w) - size + 2)) as i from d, s where len(w) >= size)),
hit as (select x.rid, x.i, x.size, g.item_id from x join g on x.gram = g.gram and x.size = g.size),
words as (select rid, count(distinct k) as n_hit
          from (select rid, unnest(range(i, i + size)) as k from hit) group by rid),
items as (select rid, count(*) as n_items, string_agg(item_id, ',' order by item_id) as names
          from (select distinct rid, coalesce(item_id::varchar, 'null') as item_id from hit) group by rid)
select doc_id, len(w)::bigint as n_words, coalesce(n_hit, 0)::bigint as n_hit, coalesce(n_items, 0)::bigint as n_items,
       sha256(coalesce(names, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from d left join words using (rid) left join items using (rid)
""",
    "op8_suffix_dedup": """
with d as (select doc_id, hex(encode(coalesce(text, ''))) as h from documents),
n as (select doc_id, h, length(h) // 2 as n from d),
w as (select doc_id, p, substr(h, 2 * p + 1, 100) as s
      from (select doc_id, h, unnest(range(0, n - 49)) as p from n where n >= 50)),
m as (select s, min(doc_id) as first from w group by s having min(doc_id) <> max(doc_id)),
c as (select w.doc_id, p from w join m using (s) where m.first < w.doc_id),
r as (select doc_id, p, case when p <= lag(p) over (partition by doc_id order by p) + 50 then 0 else 1 end as starts from c),
g as (select doc_id, p, sum(starts) over (partition by doc_id order by p) as run from r),
x as (select doc_id, run, min(p) as lo, max(p) + 50 as hi from g group by all),
y as (select doc_id, lo, coalesce(lag(hi) over (partition by doc_id order by lo), 0) as prev, hi from x),
k as (select n.doc_id, n.h, n.n, count(lo) as n_spans, coalesce(sum(hi - lo), 0) as n_removed,
             coalesce(string_agg(substr(n.h, 2 * prev + 1, 2 * (lo - prev)), '' order by lo), '') as head,
             coalesce(max(hi), 0) as tail
      from n left join y using (doc_id) group by n.doc_id, n.h, n.n)
select doc_id, n::bigint as n_bytes, n_removed::bigint as n_removed, n_spans::bigint as n_spans,
       sha256(unhex(head || substr(h, 2 * tail + 1))) as kept_sha256
from k
""",
    "op11_fill_in_middle": r"""
with t as (select doc_id, coalesce(text, '') as text, regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') as w,
                  sha256('1:' || coalesce(doc_id::varchar, '')) as d from documents),
h as (select *, len(w)::bigint as n, ('0x' || substr(d, 1, 8))::bigint as h1, ('0x' || substr(d, 9, 8))::bigint as h2,
             ('0x' || substr(d, 17, 8))::bigint as h3, ('0x' || substr(d, 25, 8))::bigint as h4 from t),
c as (select *, least(h1 % (n + 1), h2 % (n + 1)) as a, greatest(h1 % (n + 1), h2 % (n + 1)) as b,
             case when text = '' or contains(text, '<P>') or contains(text, '<S>') or contains(text, '<M>') or h3 % 100 >= 90
                  then 'plain' when h4 % 100 < 20 then 'spm' else 'psm' end as form from h),
p as (select *, array_to_string(w[1:a], '') as pre, array_to_string(w[a + 1:b], '') as mid, array_to_string(w[b + 1:], '') as suf
      from c)
select doc_id, n, form, case when form <> 'plain' then length(pre) end as prefix_chars,
       case when form <> 'plain' then length(mid) end as middle_chars,
       sha256(case form when 'plain' then text when 'psm' then '<P>' || pre || '<S>' || suf || '<M>' || mid
                        else '<S>' || suf || '<P>' || pre || '<M>' || mid end) as output_sha256,
       sha256(text) as restored_sha256
from p
""",
    "op12_spelling_variants": r"""
with recursive
tbl as (select list(v order by k) as t from (
          select k, list_reduce(list_concat([k], range(8)),
                                lambda x, i: case when x & 1 = 1 then xor(x >> 1, 3988292384) else x >> 1 end) as v
          from (select unnest(range(256)) as k))),
runs as (select doc_id, w, count(*) as n
         from (select doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                        '[A-Za-z\x{C0}-\x{FF}]+')) as w from documents)
         where length(w) >= 6 group by all),
byte as (select w, doc_id, n, hex(encode(coalesce(doc_id::varchar, '') || ':' || w)) as x from runs),
crc as (select w, n, xor(list_reduce(list_concat([4294967295], [('0x' || substr(x, 2 * i + 1, 2))::bigint for i in range(length(x) // 2)]),
                                     lambda c, b: xor(c >> 8, t[xor(c & 255, b) + 1])), 4294967295) as h
        from byte, tbl),
spelt as (select case when h % 199 = 0 then substr(w, 1, h % length(w)) || substr(w, h % length(w) + 2) else w end as word, n from crc),
words as (select word, sum(n)::bigint as n from spelt where length(word) >= 6 group by word having sum(n) >= 5),
holes as (select word, unnest(range(0, length(word))) as i from words),
gaps as (select word, substr(word, 1, i) || '*' || substr(word, i + 2) as g from holes),
less as (select distinct word, substr(word, 1, i) || substr(word, i + 2) as g from holes),
pairs as (select a.word, b.word as near from gaps a join gaps b using (g) where a.word <> b.word
          union all select l.word, w.word from less l join words w on l.g = w.word
          union all select w.word, l.word from less l join words w on l.g = w.word),
best as (select p.word, count(*) as n_near, first(near order by w.n desc, near) as near, max(w.n) as near_n
         from pairs p join words w on w.word = p.near group by p.word),
known as (select words.word, words.n, coalesce(n_near, 0) as n_near, case when near_n >= 5 * n then near end as form,
                 case when near_n >= 5 * n then near_n end as form_n from words left join best using (word)),
walk(word, hop, step) as (select word, word, 0 from known
                         union all select walk.word, form, step + 1 from walk join known on known.word = walk.hop
                         where form is not null)
select word, form, root, n, n_near, form_n
from known join (select word, arg_max(hop, step) as root from walk group by word) using (word)
""",
    "op13_warc_normaliser": """
with p as (select page_id, coalesce(html, '') as html from pages),
d as (select page_id, octet_length(encode(html))::bigint as payload_bytes, sha1(html) as x from p),
v as (select *, [('0x' || substr(x, 1 + 5 * g, 5))::bigint for g in range(8)] as groups from d),
b as (select page_id, payload_bytes,
             array_to_string([array_to_string([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', (q >> s & 31) + 1, 1) for s in [15, 10, 5, 0]], '')
                              for q in groups], '') as payload_digest from v),
m as (select payload_digest, max(page_id) as kept from b group by payload_digest)
select page_id, payload_bytes, payload_digest, case when page_id = kept then 'response' else 'revisit' end as record_type,
       case when page_id < kept then kept end as refers_to
from b join m using (payload_digest)
""",
}
