"""DuckDB SQL of the corpus queries that SQL can express on the whole tables."""

from __future__ import annotations

from recunify.llm import collocations, lines, urls

# words of every document, told apart by a row number
_WORDS = r"""docs as (
  select row_number() over () as r, doc_id, source, coalesce(text, '') as text,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w
  from documents)"""


def _windows(k: int, table: str = "docs") -> str:
    return (f"select r, i, list_slice(w, i, i + {k - 1}) as g "
            f"from (select r, w, unnest(range(1, len(w) - {k - 2})) as i from {table} where len(w) >= {k})")


SUBSTRING = f"""
with {_WORDS},
grams as ({_windows(13)}),
first as (select g, min(doc_id) as lo from grams join docs using (r) group by g),
hits as (select grams.r, i from grams join first using (g) join docs on docs.r = grams.r where lo < doc_id),
gone as (select distinct r, i + k as i from hits, range(0, 13) as t(k)),
spread as (select r, unnest(w) as word, generate_subscripts(w, 1) as i from docs),
kept as (select r, string_agg(word, ' ' order by i) as text from spread
         where not exists (select 1 from gone where gone.r = spread.r and gone.i = spread.i) group by r),
lost as (select r, count(*) as n from gone group by r)
select doc_id, len(w) as n_words, coalesce(lost.n, 0) as n_removed, sha256(coalesce(kept.text, '')) as kept_sha256
from docs left join kept on kept.r = docs.r left join lost on lost.r = docs.r
"""

JACCARD = f"""
with recursive {_WORDS},
grams as (select distinct r, g from ({_windows(5)})
          union all select r, w from docs where len(w) between 1 and 4),
sizes as (select r, count(*) as n from grams group by r),
common as (select a.r as a, b.r as b, count(*) as n from grams a join grams b on a.g = b.g and a.r < b.r group by a.r, b.r),
pairs as (select a, b, x.n = y.n and x.n = c.n as same
          from common c join sizes x on x.r = c.a join sizes y on y.r = c.b
          where 5 * c.n >= 4 * (x.n + y.n - c.n)),
links as (select a, b, same from pairs union all select b, a, same from pairs),
reach as (select r as a, r as b from docs union select reach.a, links.b from reach join links on links.a = reach.b),
class as (select reach.a as r, min(doc_id) as class_id from reach join docs on docs.r = reach.b group by reach.a),
counts as (select a as r, count(*) filter (not same) as n_links, count(*) filter (same) as n_copies from links group by a)
select doc_id, class_id, coalesce(n_links, 0) as n_links, coalesce(n_copies, 0) as n_copies
from docs join class on class.r = docs.r left join counts on counts.r = docs.r
"""

QUALITY = f"""
with {_WORDS},
grams as ({_windows(5)}),
twice as (select r, g from grams group by r, g having count(*) > 1),
repeated as (select r, count(distinct i + k) as n from grams join twice using (r, g), range(0, 5) as t(k) group by r),
split as (select r, source, unnest(string_split(text, chr(10))) as line from docs),
full_lines as (select r, source, line, len(regexp_extract_all(line, '[^\\x20\\x09-\\x0D]+')) as n,
                      regexp_replace(lower(trim(regexp_replace(line, '[\\x20\\x09-\\x0D]+', ' ', 'g'), ' ')),
                                     '[0-9]+', '0', 'g') as norm
               from split where regexp_matches(line, '[^\\x20\\x09-\\x0D]')),
dup as (select r, count(*) - count(distinct line) as n from full_lines group by r),
often as (select source, norm from full_lines group by source, norm having count(distinct r) > {lines.LIMIT}),
lost as (select f.r, sum(f.n) as n from full_lines f
         where exists (select 1 from often o where o.norm = f.norm and o.source is not distinct from f.source) group by f.r),
base as (
  select docs.r, doc_id, len(w) as n_words, len(array_to_string(w, '')) as word_chars,
         len(text) - len(regexp_replace(text, '[#*$%&|<>]', '', 'g')) as n_symbols,
         coalesce(dup.n, 0) as n_dup_lines, coalesce(repeated.n, 0) as n_repeat_words, coalesce(lost.n, 0) as gone
  from docs left join dup on dup.r = docs.r left join repeated on repeated.r = docs.r left join lost on lost.r = docs.r)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       n_words < 10 or 100 * n_repeat_words > 20 * n_words as base_failed,
       not (n_words < 10 or 100 * n_repeat_words > 20 * n_words) and n_words - gone >= {lines.KEEP_SHARE} * n_words as kept,
       cast(n_words - gone as bigint) as words_left, n_words - gone < {lines.KEEP_SHARE} * n_words as depleted
from base
"""

_FOLD = (r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
         r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')")

DECONTAMINATION = f"""
with docs as (select row_number() over () as r, doc_id, {_FOLD} as w from documents),
items as (select item_id, {_FOLD} as w from benchmark),
parts as (select item_id, least(len(w), 13) as m, w, unnest(range(1, len(w) - least(len(w), 13) + 2)) as i
          from items where len(w) > 0),
patterns as (select distinct item_id, m, list_slice(w, i, i + m - 1) as g from parts),
lengths as (select distinct m from patterns),
grams as (select r, m, i, list_slice(w, i, i + m - 1) as g
          from (select r, m, w, unnest(range(1, len(w) - m + 2)) as i from docs, lengths where len(w) >= m)),
hits as (select r, grams.m, i, item_id from grams join patterns on patterns.g = grams.g),
words as (select r, count(distinct i + k) as n from hits, range(0, 13) as t(k) where k < m group by r),
found as (select r, count(*) as n, string_agg(id, ',' order by id) as ids
          from (select distinct r, cast(item_id as varchar) as id from hits) group by r)
select doc_id, len(w) as n_words, coalesce(words.n, 0) as n_hit, coalesce(found.n, 0) as n_items,
       sha256(coalesce(ids, '')) as items_sha256, coalesce(words.n > 0 and 20 * words.n >= len(w), false) as contaminated
from docs left join words on words.r = docs.r left join found on found.r = docs.r
"""

COLLOCATIONS = f"""
with pieces as (
  select row_number() over () as r, coalesce(lang, 'und') as lang, regexp_extract_all(piece, '[^\\x20\\x09]+') as w
  from (select lang, unnest(regexp_split_to_array(
          translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]')) as piece
        from documents where text is not null)),
spread as (select r, lang, unnest(w) as a, generate_subscripts(w, 1) as i from pieces),
spots as (select lang, a, lead(a, 1) over (partition by r order by i) as b, lead(a, 2) over (partition by r order by i) as c
          from spread),
f as (select lang, 1 as k, [a] as g, count(*) as n from spots group by lang, a
      union all select lang, 2, [a, b], count(*) from spots where b is not null group by lang, a, b
      union all select lang, 3, [a, b, c], count(*) from spots where c is not null group by lang, a, b, c),
totals as (select lang, sum(n) as n from f where k = 1 group by lang),
often as (select * from f where k > 1 and n >= {collocations.MIN_COUNT}),
parts as (select lang, list_slice(g, j, j + 1) as g, max(n) as n
          from often, range(1, 3) as t(j) where k = 3 group by lang, list_slice(g, j, j + 1)),
kept as (select often.* from often left join parts on k = 2 and parts.lang = often.lang and parts.g = often.g
         where parts.n is null or 100 * parts.n < {collocations.DROP_PERCENT} * often.n),
cuts as (select kept.lang, kept.g, j, kept.n as a, x.n as l, y.n as r,
                (1000000::hugeint * kept.n::hugeint * kept.n::hugeint) // (x.n::hugeint * y.n::hugeint) as score
         from kept, range(1, 3) as t(j)
         join f x on x.lang = kept.lang and x.g = list_slice(kept.g, 1, j)
         join f y on y.lang = kept.lang and y.g = list_slice(kept.g, j + 1, kept.k) where j < kept.k),
worst as (select * from cuts qualify row_number() over (partition by lang, g order by score, j) = 1),
ranked as (select lang, row_number() over (partition by lang order by score desc, a desc,
                                           encode(array_to_string(g, ' '))) as rank,
                  array_to_string(g, ' ') as phrase, a, l, r, score from worst)
select lang, rank, phrase, a, l, r, cast(n as bigint) as n, cast(score as bigint) as score
from ranked join totals using (lang) where rank <= {collocations.TOP}
"""

# crc32 of a text, byte by byte: a table of 256 remainders, and one step of the recursion for each byte
SPELLING = r"""
with recursive
remainder as (select i, 0 as k, i::bigint as c from range(256) as t(i)
              union all select i, k + 1, case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end from remainder where k < 8),
bytes as (select i, c from remainder where k = 8),
runs as (select coalesce(cast(doc_id as varchar), '') as id,
                translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as run
         from (select doc_id, unnest(regexp_extract_all(text, '[A-Za-z\x{00C0}-\x{00FF}]+')) as run from documents)
         where length(run) >= 5),
texts as (select row_number() over () as r, id, run, n, hex(encode(id || ':' || run)) as h
          from (select id, run, count(*) as n from runs group by id, run)),
crc as (select r, 0 as k, 4294967295 as c from texts
        union all
        select crc.r, crc.k + 1, xor(crc.c >> 8, bytes.c)
        from crc join texts using (r)
        join bytes on bytes.i = xor(crc.c & 255, (instr('0123456789ABCDEF', substr(h, 2 * crc.k + 1, 1)) - 1) * 16
                                                 + instr('0123456789ABCDEF', substr(h, 2 * crc.k + 2, 1)) - 1)
        where 2 * crc.k < length(h)),
hashed as (select run, n, xor(c, 4294967295) as h from crc join texts using (r) where 2 * k = length(texts.h)),
vocab as (select word, cast(sum(n) as bigint) as n
          from (select case when h % 97 = 0 then substr(run, 1, cast(h % length(run) as int))
                                                 || substr(run, cast(h % length(run) as int) + 2) else run end as word, n
                from hashed)
          where length(word) >= 5 group by word having sum(n) >= 3),
holes as (select word, i, substr(word, 1, i - 1) as head, substr(word, i + 1) as tail
          from (select word, unnest(range(1, length(word) + 1)) as i from vocab)),
near as (select a.word, b.word as near from holes a join holes b using (i, head, tail) where a.word <> b.word
         union select holes.word, vocab.word from holes join vocab on vocab.word = head || tail
         union select vocab.word, holes.word from holes join vocab on vocab.word = head || tail),
ranked as (select near.word, near, v.n, count(*) over (partition by near.word) as n_near,
                  row_number() over (partition by near.word order by v.n desc, near) as place
           from near join vocab v on v.word = near.near),
found as (select vocab.word, vocab.n, coalesce(n_near, 0) as n_near,
                case when ranked.n >= 2 * vocab.n then near end as form, case when ranked.n >= 2 * vocab.n then ranked.n end as form_n
         from vocab left join ranked on ranked.word = vocab.word and place = 1),
chain as (select word, word as last, form as next from found
          union all select chain.word, found.word, found.form from chain join found on found.word = chain.next)
select found.word, form, last as root, n, n_near, form_n from found join chain on chain.word = found.word and chain.next is null
"""

SQL = {
    "op1_substring_dedup": SUBSTRING,
    "op3_url_filter": urls.SQL,
    "op5_jaccard_join": JACCARD,
    "op6_quality_rules": QUALITY,
    "op10_decontamination": DECONTAMINATION,
    "op11_spelling_variants": SPELLING,
    "op13_collocations": COLLOCATIONS,
}
