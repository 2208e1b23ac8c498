"""DuckDB SQL of the queries that SQL can express."""

from __future__ import annotations

from aurum.llm.rules import STOP_WORDS

ORACLE: dict[str, str] = {}

ORACLE["op5_exact_dedup"] = r"""
with t as (
    select doc_id, coalesce(text, '') as body,
           regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') as norm
    from documents
), k as (
    select doc_id, norm, count(*) over (partition by norm) as group_size,
           first_value(doc_id) over (partition by norm order by length(body) desc, doc_id) as keep_id
    from t
)
select doc_id, keep_id, group_size, doc_id = keep_id as kept, sha256(norm) as text_sha256 from k
"""

ORACLE["op1_line_dedup"] = r"""
with l as (
    select doc_id, source, unnest(string_split(text, chr(10))) as line,
           generate_subscripts(string_split(text, chr(10)), 1) as pos
    from documents where text is not null
), b as (
    select line, min(doc_id * 1000000000 + pos) as first from l
    where trim(line, ' ') <> '' group by line having count(distinct source) >= 8
), k as (
    select l.doc_id, count(*) as n_lines,
           count(*) filter (where b.line is not null and l.doc_id * 1000000000 + l.pos <> b.first) as n_removed,
           coalesce(string_agg(l.line, chr(10) order by l.pos)
                    filter (where b.line is null or l.doc_id * 1000000000 + l.pos = b.first), '') as kept
    from l left join b on l.line = b.line group by l.doc_id
)
select d.doc_id, coalesce(n_lines, 0) as n_lines, coalesce(n_removed, 0) as n_removed,
       sha256(coalesce(kept, '')) as kept_sha256
from documents d left join k on d.doc_id = k.doc_id
"""

ORACLE["op2_substring_dedup"] = r"""
with t as (
    select doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w from documents
), p as (
    select doc_id, w, unnest(range(1, len(w) - 11)) as i from t where len(w) >= 13
), g as (
    select doc_id, i, array_to_string(w[i:i + 12], ' ') as g from p
), r as (
    select doc_id, i from (select doc_id, i, min(doc_id) over (partition by g) as low from g) where low < doc_id
), gone as (
    select distinct doc_id, unnest(range(i, i + 13)) as i from r
), a as (
    select doc_id, count(*) as n_removed from gone group by doc_id
), e as (
    select doc_id, unnest(w) as word, generate_subscripts(w, 1) as i from t
), k as (
    select doc_id, string_agg(word, ' ' order by i) as kept from e anti join gone using (doc_id, i) group by doc_id
)
select t.doc_id, cast(len(w) as bigint) as n_words, coalesce(n_removed, 0) as n_removed,
       sha256(coalesce(kept, '')) as kept_sha256
from t left join a on t.doc_id = a.doc_id left join k on t.doc_id = k.doc_id
"""

ORACLE["op4_jaccard_join"] = r"""
with recursive t as (
    select doc_id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x20\x09-\x0D]+') as w
    from documents
), s as (
    select distinct doc_id, array_to_string(w[i:i + 4], ' ') as g
    from (select doc_id, w, unnest(range(1, greatest(len(w) - 3, 2))) as i from t where len(w) > 0)
), z as (
    select doc_id, count(*) as n from s group by doc_id
), p as (
    select a.doc_id as x, b.doc_id as y, count(*) as c from s a join s b on a.g = b.g and a.doc_id <> b.doc_id group by 1, 2
), l as (
    select x, y from p join z a on a.doc_id = x join z b on b.doc_id = y where 100 * c >= 80 * (a.n + b.n - c)
), r(doc_id, low) as (
    select doc_id, doc_id from z
    union
    select y, low from r join l on x = r.doc_id where low < y
)
select t.doc_id, coalesce(n, 0) as n_shingles, coalesce(low, t.doc_id) as component_id
from t left join z on t.doc_id = z.doc_id
left join (select doc_id, min(low) as low from r group by doc_id) m on t.doc_id = m.doc_id
"""

ORACLE["op6_suffix_dedup"] = r"""
with t as (
    select doc_id, hex(encode(coalesce(text, ''))) as x from documents
), w as (
    select doc_id, i, x[2 * i + 1:2 * i + 100] as g
    from (select doc_id, x, unnest(range(0, len(x) // 2 - 49)) as i from t where len(x) >= 100)
), r as (
    select doc_id, i from (select doc_id, i, min(doc_id) over (partition by g) as low from w) where low < doc_id
), runs as (
    select doc_id, min(i) as lo, max(i) + 50 as hi
    from (select doc_id, i, sum(fresh) over (partition by doc_id order by i) as k
          from (select doc_id, i, case when i - lag(i) over (partition by doc_id order by i) <= 50 then 0 else 1 end as fresh from r))
    group by doc_id, k
), cut as (
    select t.doc_id, lo, hi, coalesce(lag(hi) over (partition by doc_id order by lo), 0) as before, x
    from runs join t using (doc_id)
), k as (
    select doc_id, sum(hi - lo) as n_removed, count(*) as n_spans,
           string_agg(x[2 * before + 1:2 * lo], '' order by lo) || max(x)[2 * max(hi) + 1:] as kept
    from cut group by doc_id
)
select t.doc_id, cast(len(x) // 2 as bigint) as n_bytes, cast(coalesce(n_removed, 0) as bigint) as n_removed,
       coalesce(n_spans, 0) as n_spans, sha256(unhex(coalesce(kept, x))) as kept_sha256
from t left join k on t.doc_id = k.doc_id
"""

ORACLE["op11_fill_in_middle"] = r"""
with t as (
    select doc_id, coalesce(text, '') as x, length(coalesce(text, '')) as n, sha256('1:' || doc_id) as h from documents
), u as (
    select *, ('0x' || h[1:8])::bigint % (n + 1) as u1, ('0x' || h[9:16])::bigint % (n + 1) as u2,
           ('0x' || h[17:24])::bigint % 100 as h3, ('0x' || h[25:32])::bigint % 100 as h4 from t
), f as (
    select *, least(u1, u2) as a, greatest(u1, u2) as b,
           case when n = 0 or contains(x, '<P>') or contains(x, '<S>') or contains(x, '<M>') or h3 >= 90 then 'plain'
                when h4 < 20 then 'spm' else 'psm' end as form from u
), o as (
    select *, case form when 'plain' then x
        when 'psm' then '<P>' || substring(x, 1, a) || '<S>' || substring(x, b + 1) || '<M>' || substring(x, a + 1, b - a)
        else '<S>' || substring(x, b + 1) || '<P>' || substring(x, 1, a) || '<M>' || substring(x, a + 1, b - a) end as y from f
), r as (
    select *, case form when 'plain' then y
        when 'psm' then substring(y, 4, strpos(y, '<S>') - 4) || substring(y, strpos(y, '<M>') + 3)
                        || substring(y, strpos(y, '<S>') + 3, strpos(y, '<M>') - strpos(y, '<S>') - 3)
        else substring(y, strpos(y, '<P>') + 3, strpos(y, '<M>') - strpos(y, '<P>') - 3) || substring(y, strpos(y, '<M>') + 3)
                        || substring(y, 4, strpos(y, '<P>') - 4) end as z from o
)
select doc_id, n, form, case when form <> 'plain' then a end as prefix_chars,
       case when form <> 'plain' then b - a end as middle_chars, sha256(y) as output_sha256, sha256(z) as restored_sha256
from r
"""

ORACLE["op12_source_divergence"] = r"""
with d as (
    select row_number() over () as i, coalesce(lang, '') as lang, coalesce(source, '') as source,
           regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                              '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') as w
    from documents
), e as (
    select i, lang, source, unnest(w) as term from d
), k as (
    select lang, term, count(*) as c from e group by lang, term having count(distinct i) >= 3
), g as (
    select distinct lang, source from d
), c as (
    select e.lang, e.source, e.term, count(*) as c from e join k using (lang, term) group by all
), n as (
    select g.lang, g.source, coalesce(sum(c.c), 0)::hugeint as n from g left join c using (lang, source) group by all
), l as (
    select lang, count(*)::hugeint as v, sum(c)::hugeint as n from k group by lang
), p as (
    select n.lang, n.source, k.term, coalesce(c.c, 0) as c,
           1 + (1000000000::hugeint * (coalesce(c.c, 0) + 1)) // (n.n + l.v) as p,
           1 + (1000000000::hugeint * (k.c + 1)) // (l.n + l.v) as q
    from n join l using (lang) join k using (lang) left join c on c.lang = n.lang and c.source = n.source and c.term = k.term
), pair as (
    select a.lang, a.source, b.source as item, sum(((a.p - b.p) * (a.p - b.p)) // b.p) as value
    from p a join p b on a.lang = b.lang and a.term = b.term and a.source <> b.source group by all
    union all
    select a.lang, a.source, b.source, 0 from g a join g b on a.lang = b.lang and a.source <> b.source
    where a.lang not in (select lang from l)
), term as (
    select lang, source, term as item, ((p - q) * (p - q)) // q as value from p where c > 0 and p > q
), ranked as (
    select lang, source, 'pair' as part, item, value, row_number() over (partition by lang, source order by value desc, item) as rank from pair
    union all
    select lang, source, 'term', item, value, row_number() over (partition by lang, source order by value desc, item) from term
)
select lang, source, part, item, cast(value as bigint) as value, cast(rank as int) as rank
from ranked where part = 'pair' or rank <= 200
"""

ORACLE["op13_quality_rules"] = r"""
with t as (
    select row_number() over () as r, doc_id, coalesce(text, '') as x,
           regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w,
           list_filter(string_split(coalesce(text, ''), chr(10)), lambda s: regexp_matches(s, '[^\x20\x09-\x0D]')) as lines
    from documents
), g as (
    select r, i, array_to_string(w[i:i + 4], ' ') as g from (select r, w, unnest(range(1, len(w) - 3)) as i from t where len(w) >= 5)
), again as (
    select r, i from (select r, i, count(*) over (partition by r, g) as k from g) where k > 1
), covered as (
    select r, count(*) as n from (select distinct r, unnest(range(i, i + 5)) as i from again) group by r
), m as (
    select doc_id, len(w) as n_words, length(array_to_string(w, '')) as word_chars,
           length(x) - length(translate(x, '#*$%&|<>', '')) as n_symbols,
           len(lines) - len(list_distinct(lines)) as n_dup_lines, coalesce(covered.n, 0) as n_repeat_words, len(lines) as n_lines,
           len(list_filter(string_split(translate(x, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ.,;:!?"''()' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13),
                                                     'abcdefghijklmnopqrstuvwxyz               '), ' '),
                           lambda s: s in (@STOP_WORDS@))) as n_stop_words
    from t left join covered using (r)
), f as (
    select *, n_words < 10 or 100 * n_repeat_words > 20 * n_words as base_failed from m
)
select doc_id, cast(n_words as bigint) as n_words, cast(word_chars as bigint) as word_chars, cast(n_symbols as bigint) as n_symbols,
       cast(n_dup_lines as bigint) as n_dup_lines, cast(n_repeat_words as bigint) as n_repeat_words, base_failed,
       not base_failed and 100 * word_chars between 200 * n_words and 1500 * n_words and 100 * n_symbols <= 10 * n_words
           and (n_words < 50 or 100 * n_stop_words >= 2 * n_words) and (n_lines < 4 or 100 * n_dup_lines <= 30 * n_lines) as kept,
       cast(n_lines as bigint) as n_lines, cast(n_stop_words as bigint) as n_stop_words
from f
""".replace("@STOP_WORDS@", ", ".join(f"'{w}'" for w in sorted(set(STOP_WORDS))))
