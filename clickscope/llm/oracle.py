"""DuckDB SQL for the operators that SQL can express."""

from __future__ import annotations

QUALITY_FEATURES = r"""
docs as (select row_number() over () as rid, doc_id, lang, coalesce(text, '') as t from documents),
split as (select *, list_filter(string_split_regex(t, '[\x20\x09-\x0D]+'), lambda x: x <> '') as w,
                 list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) as l from docs),
grams as (select rid, i, w[i:i + 4] as g from (select rid, w, unnest(range(1, len(w) - 3)) as i from split where len(w) >= 5)),
twice as (select rid, i from (select rid, i, count(*) over (partition by rid, g) as c from grams) where c > 1),
covered as (select rid, cast(sum(least(5, coalesce(nxt - i, 5))) as bigint) as n from
            (select rid, i, lead(i) over (partition by rid order by i) as nxt from twice) group by rid),
counts as (select s.rid, doc_id, lang, cast(len(w) as bigint) as n_words,
                  cast(length(array_to_string(w, '')) as bigint) as word_chars,
                  cast(len(regexp_extract_all(t, '[#*$%&|<>]')) as bigint) as n_symbols,
                  cast(len(l) as bigint) as n_lines,
                  cast(len(l) - len(list_distinct(l)) as bigint) as n_dup_lines,
                  coalesce(c.n, 0) as n_repeat_words,
                  len(regexp_extract_all(t, '\p{Lu}')) as n_capitals, len(regexp_extract_all(t, '[!?]')) as n_exclaims
           from split s left join covered c on s.rid = c.rid),
scores as (select *, n_words < 10 or 100 * n_repeat_words > 20 * n_words as base_failed,
                  [least(1000, 1000 * n_symbols // greatest(word_chars, 1)), least(1000, 1000 * n_capitals // greatest(word_chars, 1)),
                   least(1000, 1000 * n_exclaims // greatest(n_words, 1)), least(1000, 1000 * n_dup_lines // greatest(n_lines, 1)),
                   least(1000, 1000 * n_repeat_words // greatest(n_words, 1))] as s from counts)"""

QUALITY = f"""
with {QUALITY_FEATURES},
good as (select doc_id, min(quality) as q from labels where doc_id is not null and quality is not null group by doc_id),
held as (select lang, r, s[r] as cut, q from scores join good using (doc_id), range(1, 6) rules(r) where not base_failed),
cuts as (select lang, r, cut, sum(cast(q = 1 as bigint)) as g, sum(cast(q <> 1 as bigint)) as b from held group by all),
cum as (select *, sum(g) over (partition by lang, r) as n,
               cast(sum(g) over (partition by lang, r order by cut desc) as bigint) as k,
               sum(b) over (partition by lang, r order by cut desc) as hit,
               (select greatest(1, count(*)) from (select distinct lang from cuts)) as strata from cuts),
tested as (select *, case when k > n * 0.005 then 1 else list_sum(list_transform(range(0, k + 1), lambda j:
               exp(lgamma(n + 1) - lgamma(j + 1) - lgamma(n - j + 1) + j * ln(0.005) + (n - j) * ln(0.995)))) end as p
           from cum where cut > 0),
best as (select lang, r, arg_max(cut, [cast(hit - 10 * k as double), cut]) as cutoff from tested
         where p <= 0.05 / (5 * strata) and hit - 10 * k > 0 group by lang, r),
fired as (select distinct rid from scores join best on scores.lang is not distinct from best.lang and s[r] >= cutoff)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       not base_failed and fired.rid is null as kept
from scores left join fired using (rid)"""

CHAT = r"""
with rows as (select conv_id, turn, role, text from conversations
              union all select -1, 0, 'user', '</s>[INST] ok [/INST]'
              union all select -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
r as (select conv_id, row_number() over (partition by conv_id order by turn nulls first, role nulls first, text nulls first) as n,
             coalesce(role, '') as role, coalesce(text, '') as text from rows),
c as (select conv_id, count(*) as n_turns, string_agg(role || chr(10) || text || chr(10), '' order by n) as said,
             coalesce(string_agg(case when role = 'assistant' then text end, '' order by n), '') as lost,
             sum(9 + length(role) + len(regexp_extract_all(role, '[\\<\[\n]')) + length(text)
                 + len(regexp_extract_all(text, '[\\<\[]'))) as size
      from r group by conv_id)
select conv_id, n_turns, sha256(said) as turns_sha256, cast(length(lost) as bigint) as loss_chars,
       sha256(lost) as loss_sha256, cast(size as bigint) as formatted_chars from c"""

WARC = """
with p as (select page_id, coalesce(html, '') as h from pages),
f as (select *, strlen(h) as n, min(page_id) over (partition by h) as first from p)
select page_id, cast(n as bigint) as payload_bytes, sha256(h) as payload_digest,
       case when n >= 100 and page_id is distinct from first then 'revisit' else 'response' end as record_type,
       case when n >= 100 and page_id is distinct from first then first end as refers_to
from f"""

PHRASES = r"""
with t as (select coalesce(lang, 'und') as lang, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as t
           from documents),
pieces as (select lang, unnest(string_split_regex(t, '[.,;:!?\x0A-\x0D]')) as p from t),
words as (select lang, list_filter(string_split_regex(p, '[\x20\x09]+'), lambda x: x <> '') as w from pieces),
total as (select lang, cast(sum(len(w)) as bigint) as n from words group by lang),
grams as (select lang, m, array_to_string(w[i:i + m - 1], ' ') as phrase
          from (select lang, w, m, unnest(range(1, len(w) - m + 2)) as i from words, range(1, 4) sizes(m) where len(w) >= m)),
f as (select lang, m, phrase, count(*) as f from grams group by all having count(*) >= 10),
cand as (select lang, m, phrase, f as a, string_split(phrase, ' ') as w from f where m > 1),
cuts as (select c.lang, c.phrase, c.a, k, l.f as l, r.f as r,
                cast(1000000 * cast(c.a as hugeint) * c.a // (cast(l.f as hugeint) * r.f) as bigint) as score
         from (select *, unnest(range(1, m)) as k from cand) c
         join f l on l.lang = c.lang and l.phrase = array_to_string(w[1:k], ' ')
         join f r on r.lang = c.lang and r.phrase = array_to_string(w[k + 1:], ' ')),
best as (select lang, phrase, a, arg_min(struct_pack(l := l, r := r, score := score), [score, k]) as b from cuts group by all),
longer as (select lang, p, max(a) as a from (select lang, a, unnest([array_to_string(w[1:2], ' '), array_to_string(w[2:3], ' ')]) as p
                                             from cand where m = 3) group by all),
kept as (select best.* from best left join longer on best.lang = longer.lang and best.phrase = longer.p
         where longer.a is null or 100 * longer.a < 50 * best.a),
ranked as (select *, row_number() over (partition by lang order by b.score desc, a desc, phrase) as rank from kept)
select ranked.lang, cast(rank as integer) as rank, phrase, a, b.l as l, b.r as r, n, b.score as score
from ranked join total on ranked.lang = total.lang where rank <= 2000"""


def oracle_sql() -> dict[str, str]:
    return {"op1_quality_rules": QUALITY, "op6_chat_formatting": CHAT, "op7_warc": WARC, "op13_phrases": PHRASES}
