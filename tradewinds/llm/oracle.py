"""SQL for what SQL can state, written from the definitions and run by another engine.

The other operators have no such text: a learned model (3), a tokenizer's vocabulary (1, 5), hashes
that the other engine lacks (7, 8), a search (9) and distances that end in a rounded verdict (6). They
are tested against brute force.
"""

from __future__ import annotations

import re

from tradewinds.llm.common import LOWER, UPPER
from tradewinds.llm.licenses import BASE, TEMPLATES
from tradewinds.llm.secretscan import BASE_RULES, RULES

_WORDS = r"'[^\x20\x09-\x0D]+'"

_MIX = f"""
with d as (
  select doc_id, source, cast(len(regexp_extract_all(coalesce(text, ''), {_WORDS})) as bigint) as size,
         cast('0x' || substr(md5('mix:' || coalesce(cast(doc_id as varchar), '') || ':' || coalesce(text, '')), 1, 15) as bigint) as place
  from documents
), by_source as (select source, cast(sum(size) as bigint) as source_size from d group by source),
weighed as (
  select source, source_size, [5, 2, 1][(row_number() over (order by source nulls last) - 1) % 3 + 1] as w from by_source
), whole as (select cast(sum(source_size) as double) as t, sum(w) as w from weighed),
sorted as (
  select row_number() over o as j, 3.0 * source_size / w as r, sum(3 * source_size) over o as capped, sum(w) over o as capped_w
  from weighed window o as (order by 3.0 * source_size / w, source nulls last rows unbounded preceding)
), steps as (
  select 0 as j, 0 as capped, 0 as capped_w union all select j, capped, capped_w from sorted
), levels as (
  select steps.j, (whole.t - steps.capped) / (whole.w - steps.capped_w) as level, following.r as next_r
  from steps cross join whole left join sorted as following on following.j = steps.j + 1
  where whole.w > steps.capped_w
), chosen as (select level from levels where next_r > level order by j limit 1),
targets as (
  select source, source_size,
         case when cast(3 * source_size as double) <= level * w then cast(3 * source_size as double) else level * w end as target
  from weighed cross join chosen
), parts as (
  select *, case when source_size > 0 then cast(floor(target / source_size) as bigint) else 0 end as k from targets
), rests as (select *, target - k * source_size as rest from parts),
placed as (
  select d.*, r.source_size, r.target, r.k, r.rest,
         sum(d.size) over (partition by d.source order by d.place range unbounded preceding) as upto
  from d join rests r on d.source is not distinct from r.source
), marked as (select *, rest > 0 and upto <= rest as again from placed),
gaps as (select source, rest - coalesce(max(upto) filter (where again), 0) as gap from marked where rest > 0 group by source, rest),
fillers as (
  select m.source, arg_min(m.place, {{'off': abs(m.size - g.gap), 'place': m.place}}) as place
  from marked m join gaps g on m.source is not distinct from g.source
  where not m.again and abs(m.size - g.gap) < g.gap group by m.source
)
select m.doc_id, m.size, m.source_size, m.target,
       cast(m.size * (m.k + case when m.again or f.place is not null then 1 else 0 end) as bigint) as taken
from marked m left join fillers f on m.source is not distinct from f.source and m.place = f.place
"""

_NEAR = f"""
with recursive w as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), {_WORDS}) as words from documents
), s as (
  select doc_id, case when len(words) >= 3 then list_distinct([array_to_string(words[i:i + 2], ' ') for i in range(1, len(words) - 1)])
                      when len(words) > 0 then [array_to_string(words, ' ')] else [] end as shingles from w
), n as (select doc_id, cast(len(shingles) as bigint) as n from s),
g as (select doc_id, unnest(shingles) as shingle from s),
shares as (
  select a.doc_id as a, b.doc_id as b, count(*) as shared from g a join g b on a.shingle = b.shingle and a.doc_id < b.doc_id group by 1, 2
), links as (
  select a, b from shares join n x on x.doc_id = a join n y on y.doc_id = b where 100 * shared >= 85 * (x.n + y.n - shared)
), edges as (select a, b from links union all select b, a from links),
reach as (
  select doc_id as a, doc_id as b from n union select reach.a, edges.b from reach join edges on edges.a = reach.b
), smallest as (select a, min(b) as component_id from reach group by a)
select n.doc_id, n.n as n_shingles, smallest.component_id, n.doc_id = smallest.component_id as kept
from n join smallest on smallest.a = n.doc_id
"""


def _license_sql() -> str:
    words, phrases = [], []
    for number, template in enumerate(TEMPLATES):
        run = template.text.split()
        key = set()
        for phrase in template.keys:
            wanted = phrase.split()
            at = next(i for i in range(len(run)) if run[i:i + len(wanted)] == wanted)
            key.update(range(at, at + len(wanted)))
        words += [f"({number}, '{template.label}', {len(run)}, {k}, '{w}', {int(k in key)}, {len(key)})" for k, w in enumerate(run)]
    for number, (phrase, label) in enumerate(BASE.items()):
        run = phrase.split()
        phrases += [f"({number}, '{label}', {len(run)}, {k}, '{w}')" for k, w in enumerate(run)]
    pattern = r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'"
    return f"""
with w as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), {pattern}) as words from documents
), p as (select doc_id, unnest(words) as word, unnest(range(len(words))) as at from w),
template(t, label, size, k, word, key, keys) as (values {', '.join(words)}),
phrase(t, label, size, k, word) as (values {', '.join(phrases)}),
base as (
  select doc_id, label, p.at - k as start from p join phrase using (word) group by doc_id, t, label, size, p.at - k having count(*) = size
), found as (
  select doc_id, label, count(*) / cast(size as double) as share from p join template using (word)
  group by doc_id, t, label, size, keys, p.at - k having sum(key) = keys and count(*) / cast(size as double) >= 0.8
), labels as (select doc_id, label from base union select doc_id, label from found),
base_rows as (
  select doc_id, count(*) as n, min(start) as first_word, max(start) as last_word,
         string_agg(distinct label, ',' order by label) as labels from base group by doc_id
), label_rows as (select doc_id, string_agg(distinct label, ',' order by label) as labels from labels group by doc_id),
score as (select doc_id, max(share) as score from found group by doc_id)
select w.doc_id, cast(len(words) as bigint) as n_words, coalesce(b.n, 0) as n_base, b.first_word, b.last_word,
       coalesce(b.labels, '') as base_labels, coalesce(l.labels, '') as labels, coalesce(s.score, 0.0) as score
from w left join base_rows b using (doc_id) left join label_rows l using (doc_id) left join score s using (doc_id)
"""

_AUDIT = f"""
with t as (
  select doc_id, coalesce(source, '') as part, coalesce(text, '') as text,
         regexp_extract_all(coalesce(text, ''), {_WORDS}) as words,
         doc_id > min(doc_id) over (partition by coalesce(text, '')) as copied
  from documents
), said as (
  select doc_id, coalesce(max(cast(quality = 1 as int)), 0) as good, coalesce(max(cast(toxic = 1 as int)), 0) as toxic
  from labels where doc_id is not null group by doc_id
), marked as (
  select part, [len(words) < 50, 100 * len(list_distinct(words)) < 65 * len(words),
                100 * len(regexp_extract_all(text, '[A-Z]')) > 5 * length(text), regexp_matches(text, '[#$%&*|]'),
                coalesce(copied, false)] as fails, coalesce(good, 0) as good, coalesce(toxic, 0) as toxic
  from t left join said using (doc_id)
), classes as (
  select part, fails, count(*) as n, sum(good) as good, sum(toxic) as toxic from marked group by part, fails
), letters as (select unnest(['A', 'B', 'C', 'D', 'E']) as f, unnest([1, 2, 3, 4, 5]) as i),
orders as (
  select a.f || b.f || c.f || d.f || e.f as filter_order, [a.i, b.i, c.i, d.i, e.i] as turn
  from letters a, letters b, letters c, letters d, letters e
  where len(list_distinct([a.i, b.i, c.i, d.i, e.i])) = 5
), steps as (
  select part, filter_order, step, turn[step] as i, n, good, toxic, fails[turn[step]] as failing,
         len(list_filter(turn[1:step - 1], lambda x: fails[x])) > 0 as gone, list_sum([cast(x as int) for x in fails]) as times
  from classes, orders, (select unnest([1, 2, 3, 4, 5]) as step)
), counted as (
  select part, filter_order, step, i, sum(n) filter (not gone and not failing) as kept, sum(n) filter (failing and not gone) as removed,
         sum(n) filter (failing and gone) as redundant, sum(n) filter (failing and times = 1) as unique_fails,
         sum(good) filter (failing and not gone) as good_lost, sum(toxic) filter (failing and not gone) as toxic_lost
  from steps group by part, filter_order, step, i
)
select part, filter_order, step, cast(coalesce(kept, 0) as bigint) as kept, cast(coalesce(removed, 0) as bigint) as removed,
       cast(coalesce(redundant, 0) as bigint) as redundant, cast(coalesce(unique_fails, 0) as bigint) as unique_fails,
       cast(coalesce(good_lost, 0) as bigint) as good_lost, cast(coalesce(toxic_lost, 0) as bigint) as toxic_lost,
       cast(sum(coalesce(removed, 0)) over (partition by part, i) as bigint) as shapley
from counted
"""

_PHRASES = f"""
with t as (
  select coalesce(lang, 'und') as lang,
         unnest(string_split_regex(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[.,;:!?\\x0A-\\x0D]')) as piece
  from documents
), w as (select lang, regexp_extract_all(piece, '[^\\x20\\x09]+') as words from t),
totals as (select lang, cast(sum(len(words)) as bigint) as n from w group by lang),
found as (
  select lang, size, unnest([words[i:i + size - 1] for i in range(1, len(words) - size + 2)]) as phrase
  from w, (select unnest([1, 2, 3, 4]) as size)
), f as (select lang, size, phrase, count(*) as n from found group by all having count(*) >= 30),
parts as (
  select lang, size, phrase, n as a, k, phrase[:k] as lft, phrase[k + 1:] as rgt from f, (select unnest([1, 2, 3]) as k) where k < size
), sides as (select lang, phrase as lft, phrase as rgt, n as l, n as r from f),
cuts as (
  select parts.*, x.l, y.r, (2000000 * cast(a as hugeint)) // (x.l + y.r) as score
  from parts join sides x on x.lang = parts.lang and x.lft = parts.lft join sides y on y.lang = parts.lang and y.rgt = parts.rgt
), lowest as (select * from cuts qualify row_number() over (partition by lang, phrase order by score, k) = 1),
inner_phrases as (
  select lang, n, unnest(list_concat(
    [phrase[i:i + 1] for i in range(1, size)], case when size > 3 then [phrase[i:i + 2] for i in range(1, size - 1)] else [] end)) as phrase
  from f where size > 2
), covered as (select lang, phrase, max(n) as longer from inner_phrases group by all),
kept as (
  select lowest.lang, array_to_string(lowest.phrase, ' ') as phrase, a, l, r, score
  from lowest left join covered using (lang, phrase) where longer is null or 100 * cast(longer as hugeint) < 80 * cast(a as hugeint)
)
select lang, row_number() over (partition by lang order by score desc, a desc, phrase) as rank, phrase, a, l, r, n, cast(score as bigint) as score
from kept join totals using (lang) qualify rank <= 2000
"""


def _any_case(pattern: str) -> str:
    """Scoped (?i:...) as classes of both cases: the other engine would fold letters beyond A-Z too."""
    def both(match: re.Match) -> str:
        return "(?:" + re.sub("[a-z]", lambda letter: f"[{letter[0]}{letter[0].upper()}]", match[1]) + ")"
    return re.sub(r"\(\?i:([^()]*)\)", both, pattern)


def _secret_sql() -> str:
    found = []
    for number, rule in enumerate(RULES):
        pattern = _any_case(rule.pattern).replace("'", "''")
        found.append(f"""select doc_id, {number} as k, '{rule.kind}' as kind, {rule.least} as least, string_split_regex(text, '{pattern}') as before,
            regexp_extract_all(text, '{pattern}') as hit, regexp_extract_all(text, '{pattern}', {rule.value}) as value from t""")
    counts = ", ".join(f"count(s.k) filter (k = {number}) as n_{rule.kind}" for number, rule in enumerate(BASE_RULES))
    return f"""
with t as (select doc_id, coalesce(text, '') as text from documents),
found as ({' union all '.join(found)}),
hits as (
  select doc_id, k, kind, least, unnest(before[:len(hit)]) as before, unnest(hit) as hit, unnest(value) as value, unnest(range(len(hit))) as i
  from found where len(hit) > 0
), ends as (
  select *, cast(sum(length(before) + length(hit)) over (partition by doc_id, k order by i) as bigint) as upto from hits
), spans as (
  select doc_id, k, upto - length(hit) as start, kind || ':' || cast(upto - length(hit) as varchar) || ':' || cast(upto as varchar) as span
  from ends where length(value) >= least
)
select t.doc_id, {counts},
       sha256(coalesce(string_agg(span, ',' order by start, k) filter (k < {len(BASE_RULES)}), '')) as base_sha256,
       coalesce(string_agg(span, ',' order by start, k), '') as spans
from t left join spans s using (doc_id) group by t.doc_id
"""


EXPECTED: dict[str, str] = {
    "op2_mix_sources": _MIX, "op4_license_scan": _license_sql(), "op10_minhash_near_dedup": _NEAR,
    "op11_phrase_collocations": _PHRASES,
    "op12_secret_scan": _secret_sql(), "op13_filter_audit": _AUDIT,
}
