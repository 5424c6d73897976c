"""The same results as plain SQL, for the operators that SQL can express.

These statements spell out the definitions: all windows, all pairs that share a shingle, all places.
Patterns, rules and notices come from the operators' own lists of fixed values.
"""

from __future__ import annotations

import re

from colophon.llm import licenses, mixing, quality, search, secret_scan, spelling

WORDS = "regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')"


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _values(rows: list[tuple]) -> str:
    return "(values " + ", ".join("(" + ", ".join(
        _quoted(x) if isinstance(x, str) else str(x) for x in row) + ")" for row in rows) + ")"


OP7 = f"""
with w as (select row_number() over () as rid, doc_id, {WORDS} as ws from documents),
win as (select rid, doc_id, i, md5(array_to_string(ws[i:i + 49], ' ')) as h
        from (select rid, doc_id, ws, unnest(range(1, len(ws) - 48)) as i from w where len(ws) >= 50)),
least as (select h, min(doc_id) as m from win group by h),
gone as (select distinct rid, unnest(range(i, i + 50)) as p from win join least using (h) where m < doc_id),
placed as (select rid, ws[p] as word, p from (select rid, ws, unnest(range(1, len(ws) + 1)) as p from w)),
kept as (select rid, count(*) as n, string_agg(word, ' ' order by p) as text
         from placed anti join gone using (rid, p) group by rid)
select doc_id, len(ws)::bigint as n_words, (len(ws) - coalesce(n, 0))::bigint as n_removed,
       sha256(coalesce(text, '')) as kept_sha256
from w left join kept using (rid)"""

OP2 = f"""
with recursive w as (select doc_id, {WORDS} as ws from documents where doc_id is not null),
sets as (select doc_id, list_distinct(case when len(ws) between 1 and 4 then [array_to_string(ws, ' ')]
             else [array_to_string(ws[i:i + 4], ' ') for i in range(1, len(ws) - 3)] end) as s from w),
held as (select doc_id, unnest(s) as x from sets),
sized as (select doc_id, len(s) as n, md5(array_to_string(list_sort(s), chr(10))) as own from sets),
common as (select a.doc_id as a, b.doc_id as b, count(*) as c
           from held a join held b on a.x = b.x and a.doc_id <> b.doc_id group by all),
links as (select a, b, x.own as own, y.own as other from common join sized x on a = x.doc_id join sized y on b = y.doc_id
          where c * 10 >= 8 * (x.n + y.n - c)),
reach as (select a, b from links union select reach.a, links.b from reach join links on reach.b = links.a),
class as (select a, min(b) as least from reach group by a),
counts as (select a, count(*) as n, count(distinct case when own <> other then other end) as texts from links group by a)
select doc_id, least(doc_id, coalesce(least, doc_id)) as class_id, coalesce(n, 0)::bigint as n_links,
       coalesce(texts, 0)::bigint as n_linked_texts, doc_id <= coalesce(least, doc_id) as kept
from w left join class on class.a = doc_id left join counts on counts.a = doc_id
union all select null, null, 0, 0, true from documents where doc_id is null"""

OP13 = f"""
with w as (select row_number() over () as rid, doc_id, source, len({WORDS})::bigint as size from documents),
src as (select source, sum(size)::bigint as n,
               ((row_number() over (order by source nulls last) - 1) % {len(mixing.WEIGHTS)} + 1)::bigint as weight from w group by source),
rising as (select *, sum(n) over () - {mixing.MOST} * coalesce(sum(n) over below, 0) as rest,
                  sum(weight) over () - coalesce(sum(weight) over below, 0) as weights from src
           window below as (order by n / weight, source rows between unbounded preceding and 1 preceding)),
level as (select rest, weights from rising where weight * rest <= {mixing.MOST} * n * weights order by n / weight, source limit 1),
goals as (select source, n as source_size, case when weight * rest > {mixing.MOST} * n * weights then ({mixing.MOST} * n)::double
                 else (weight * rest)::double / weights::double end as target from src, level),
sized as (select w.*, source_size, target, floor(target + 0.5)::bigint // nullif(source_size, 0) as passes,
                 floor(target + 0.5)::bigint % nullif(source_size, 0) as rest
          from w join goals on w.source is not distinct from goals.source),
blocks as (select *, least({mixing.BLOCK}, size - k * {mixing.BLOCK}) as words,
                  md5(concat_ws(':', coalesce(doc_id::varchar, ''), k::varchar, '{mixing.SEED}')) as hash
           from (select *, unnest(range(0, (size + {mixing.BLOCK - 1}) // {mixing.BLOCK})) as k from sized)),
fronts as (select *, coalesce(sum(words) over (partition by source order by hash, words, rid
                  rows between unbounded preceding and 1 preceding), 0) as before from blocks),
taken as (select rid, sum(passes * words + greatest(0, least(words, rest - before))) as taken from fronts group by rid)
select doc_id, size, source_size, target, coalesce(taken, 0)::bigint as taken from sized left join taken using (rid)"""

_TERMS = ("regexp_extract_all(translate(coalesce(text, ''), '{0}', '{1}'), "
          "'[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')").format(licenses.UPPER, licenses.LOWER)
OP11 = f"""
with d as (select row_number() over () as rid, doc_id, {_TERMS} as ws from documents),
items as (select row_number() over () as iid, item_id, {_TERMS} as ws from benchmark),
asked as (select iid, term, count(*) as k from (select iid, unnest(ws) as term from items) group by all),
totals as (select count(*) as n_docs, sum(len(ws))::bigint as n_terms from d where len(ws) > 0),
posting as (select rid, term, count(*) as tf from (select rid, unnest(ws) as term from d)
            where term in (select term from asked) group by all),
weights as (select term, floor(1000 * ln((2 * any_value(n_docs) + 2)::double / (2 * count(*) + 1)))::bigint as w
            from posting, totals group by term),
norm as (select rid, 75 + (25 * len(ws)::bigint * n_docs) // n_terms as m from d, totals),
scores as (select iid, rid, sum(k * w * ((1000000000 * tf) // (1000 * tf + 12 * m)))::bigint as score
           from asked join posting using (term) join weights using (term) join norm using (rid) group by all having score > 0)
select item_id, rank::int as rank, doc_id, score from (
    select item_id, doc_id, score, row_number() over (partition by iid order by score desc, doc_id nulls last) as rank
    from scores join d using (rid) join items using (iid)) where rank <= {search.KEPT}"""

# The checksum's table by its rule: eight shifts of every byte, with the reversed polynomial 0xEDB88320.
OP12 = f"""
with recursive steps as (
    select list(list_reduce(list_prepend(i::bigint, range(8)), lambda c, k: case when c & 1 = 1 then xor(c >> 1, 3988292384)
                else c >> 1 end) order by i) as t from range(256) r(i)),
runs as (select coalesce(doc_id::varchar, '') || ':' as doc, translate(unnest(regexp_extract_all(coalesce(text, ''),
                '[A-Za-z\\x{{00C0}}-\\x{{00FF}}]{{{spelling.SHORTEST},}}')), '{licenses.UPPER}', '{licenses.LOWER}') as run from documents),
each as (select doc, run, count(*) as k, hex(encode(doc || run)) as x from runs group by all),
hashed as (select run, k, xor(list_reduce(list_prepend(4294967295::bigint, list_transform(range(1, len(x)::bigint, 2),
                  lambda i: ('0x' || substr(x, i, 2))::bigint)), lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) as h
           from each, steps),
words as (select word, sum(k)::bigint as n from (
              select k, case when h % {spelling.SLIP} = 0 then left(run, h % length(run)) || substr(run, h % length(run) + 2)
                             else run end as word from hashed)
          where length(word) >= {spelling.SHORTEST} group by word having sum(k) >= {spelling.OFTEN}),
cut as (select word, n, i, left(word, i - 1) || substr(word, i + 1) as rest
        from words, unnest(range(1, length(word) + 1)) u(i)),
near as (select a.word, b.word as near, b.n as near_n from cut a join cut b on a.i = b.i and a.rest = b.rest and a.word <> b.word
         union select cut.word, words.word, words.n from cut join words on rest = words.word
         union select words.word, cut.word, cut.n from cut join words on rest = words.word),
best as (select word, count(*) as n_near, min(struct_pack(less := -near_n, near := near)) as b from near group by word),
told as (select word, n, coalesce(n_near, 0)::bigint as n_near, case when -b.less >= 2 * n then b.near end as form,
                case when -b.less >= 2 * n then (-b.less)::bigint end as form_n from words left join best using (word)),
way as (select word, word as root from told
        union all select way.word, told.form from way join told on way.root = told.word where told.form is not null)
select word, told.form, way.root, told.n, n_near, form_n from told join way using (word)
where way.root in (select word from told where form is null)"""


def _op3() -> str:
    n_strata, n_rules = len(quality.STRATA) + 1, len(quality.RULES)
    hypotheses = n_strata * sum(len(grid) for _, grid in quality.RULES.values())
    limit = 0.02 / n_rules
    rates = ", ".join(
        f"coalesce(({top})::double / nullif({under}, 0), 0) as r_{name}"
        for name, (top, under) in ((k, v[0].split(" / ")) for k, v in quality.RULES.items()))
    stratum = " + ".join(f"(n_words >= {n})::int" for n in quality.STRATA)
    grid = _values([(name, c) for name, (_, values) in quality.RULES.items() for c in values])
    value = "case rule " + " ".join(f"when '{name}' then r_{name}" for name in quality.RULES) + " end"
    rejected = "list_filter([" + ", ".join(
        f"case when r_{name} > (select cutoff from chosen c where c.rule = '{name}' and c.stratum = d.stratum)"
        f" then '{name}' end" for name in quality.RULES) + "], lambda x: x is not null)"
    return f"""
with w as (select row_number() over () as rid, doc_id, coalesce(text, '') as text, {WORDS} as ws from documents),
lines as (select rid, list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) as ls from w),
win as (select rid, i, md5(array_to_string(ws[i:i + 4], ' ')) as h
        from (select rid, ws, unnest(range(1, len(ws) - 3)) as i from w where len(ws) >= 5)),
twice as (select rid, h from win group by all having count(*) > 1),
covered as (select rid, count(distinct p) as n from (
    select rid, unnest(range(i, i + 5)) as p from win join twice using (rid, h)) group by rid),
m as (select doc_id, len(ws)::bigint as n_words, length(regexp_replace(text, '[\\x20\\x09-\\x0D]', '', 'g'))::bigint as word_chars,
             length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::bigint as n_symbols,
             length(regexp_replace(text, '[^A-Z]', '', 'g'))::bigint as n_capitals, len(ls)::bigint as n_lines,
             (len(ls) - len(list_distinct(ls)))::bigint as n_dup_lines, coalesce(covered.n, 0)::bigint as n_repeat_words
      from w join lines using (rid) left join covered using (rid)),
d as (select *, {stratum} as stratum, {rates}, n_words < 10 or 100 * n_repeat_words > 20 * n_words as base_failed from m),
good as (select doc_id from labels where quality is not null group by doc_id having min(quality) = 1),
tested as (select stratum, rule, cutoff, count(*) as n, count(*) filter ({value} > cutoff) as k
           from d semi join good using (doc_id), {grid} g(rule, cutoff) where not base_failed group by all),
chosen as (select stratum, rule, min(cutoff) as cutoff from tested
           where k < {limit} * n and list_sum([exp(lgamma(n + 1) - lgamma(i + 1) - lgamma(n - i + 1) + i * ln({limit})
                 + (n - i) * ln(1 - {limit})) for i in range(0, k + 1)]) <= {0.05 / hypotheses} group by all)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       not base_failed and len({rejected}) = 0 as kept, array_to_string({rejected}, ',') as rejected_by
from d"""


def _op1() -> str:
    def spans(name: str, kind: int, pattern: str, group: int, wanted: str) -> str:
        p = _quoted(pattern)
        return f"""{name} as (select rid, {kind} as kind, stop - length(m) as start, stop as stop, part
    from (select rid, m, part, sum(length(gap) + length(m)) over (partition by rid order by k) as stop from (
        select rid, unnest(range(1, len(ms) + 1)) as k, unnest(ms) as m, unnest(parts) as part, unnest(gaps[:len(ms)]) as gap
        from (select rid, regexp_extract_all(text, {p}) as ms, regexp_extract_all(text, {p}, {group}) as parts,
                     string_split_regex(text, {p}) as gaps from w)))
    where {wanted})"""

    classes = " ".join(f"when regexp_matches(part, {_quoted(p)}) then {limit or 'null'}"
                       for p, limit in secret_scan.CLASSES if p)
    repeated = "|".join(f"{re.escape(c)}{{8}}" for c in secret_scan.ALPHABET)
    allowed = "|".join(f"(?:{p})" if "\\1" not in p else f"(?:{repeated})" for p in secret_scan.ALLOWED if "(?i)" not in p)
    folded = "|".join(p.removeprefix("(?i)") for p in secret_scan.ALLOWED if "(?i)" in p)
    names = "[" + ", ".join(map(_quoted, secret_scan.KINDS)) + "]"
    n = secret_scan.WINDOW
    text = "coalesce(string_agg({} || ':' || start || ':' || stop, ',' order by start, kind, stop){}, '')"
    count = "count(*) filter (kind = {})"
    return f"""
with w as (select row_number() over () as rid, doc_id, coalesce(text, '') as text from documents),
{spans('assign', 0, secret_scan.ASSIGN, 2, 'length(part) >= 6')},
{spans('access', 1, secret_scan.ACCESS, 0, 'length(m) >= 20')},
{spans('hexes', 2, secret_scan.HEX, 0, 'length(m) >= 24')},
{spans('candidate', 3, secret_scan.CANDIDATE, 0, 'true')},
judged as (select *, case {classes} else {secret_scan.CLASSES[-1][1]} end as bits from candidate
           where not regexp_matches(part, {_quoted(allowed)}) and not regexp_matches(part, {_quoted('(?i)' + folded)})),
win as (select rid, start, bits, i, unnest(string_split(part[i:i + {n - 1}], '')) as c
        from (select *, unnest(range(1, length(part) - {n - 2})) as i from judged where bits is not null)),
entropy as (select rid, start, bits, i, -sum(c * log2(c / {n}.0)) / {n} as h from (
    select rid, start, bits, i, c as letter, count(*) as c from win group by all) group by all),
found as (select rid, 3 as kind, start + min(i) - 1 as start, start + max(i) - 1 + {n} as stop
          from entropy where round(h, 6) >= bits group by rid, entropy.start),
spans as (select rid, kind, start, stop from assign union all select rid, kind, start, stop from access
          union all select rid, kind, start, stop from hexes union all from found)
select doc_id, {', '.join(f'{count.format(k)}::bigint as n_{name}' for k, name in enumerate(secret_scan.KINDS))},
       sha256({text.format(f'{names}[kind + 1]', ' filter (kind < 3)')}) as base_sha256,
       {text.format(f'{names}[kind + 1]', '')} as spans
from w left join spans using (rid) group by rid, doc_id"""


def _op9() -> str:
    notices = _values([(t, q, w) for t, (_, text, _) in enumerate(licenses.TEMPLATES) for q, w in enumerate(text.split())])
    labels = _values([(t, label) for t, (label, _, _) in enumerate(licenses.TEMPLATES)])
    phrases = _values([(t, p, len(f" {text} ".split(f" {p} ")[0].split()), len(p.split()))
                       for t, (_, text, found) in enumerate(licenses.TEMPLATES) for p in found])
    base = _values([(label, " ".join(p), len(p)) for label, p in licenses.BASE.items()])
    return f"""
with w as (select row_number() over () as rid, doc_id,
                  regexp_extract_all(translate(coalesce(text, ''), '{licenses.UPPER}', '{licenses.LOWER}'),
                                     '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') as ws from documents),
placed as (select rid, unnest(range(0, len(ws))) as i, unnest(ws) as word from w),
notice as (from {notices} n(t, q, word)),
df as (select word, count(distinct rid) as n from placed where word in (select word from notice) group by word),
weighted as (select notice.*, ln(((select count(*) from w) + 1) / (coalesce(df.n, 0) + 1)) + 1 as idf
             from notice left join df using (word)),
rare as (select t, word from (select distinct t, word, idf from weighted)
         qualify row_number() over (partition by t order by idf desc, word) <= {licenses.RARE}),
found as (select rid, t, i - q as start from placed join weighted using (word) semi join rare using (t, word)
          group by all having count(*) >= {licenses.AGREE}),
scored as (select found.rid, t, start, sum(case when placed.word = weighted.word then idf else 0 end) / sum(idf) as score
           from found join weighted using (t) left join placed on placed.rid = found.rid and placed.i = start + q group by found.rid, t, start),
proven as (select rid, t, score from scored join w using (rid) join {phrases} p(t, phrase, place, n) using (t)
           group by rid, t, start, score having score >= 0.5 and bool_and(contains(' ' || array_to_string(
               ws[greatest(start + place - {licenses.SLACK}, 0) + 1:greatest(start + place - {licenses.SLACK}, 0) + n + {2 * licenses.SLACK}],
               ' ') || ' ', ' ' || phrase || ' '))),
base as (select rid, label, i from w, {base} b(label, phrase, n), unnest(range(0, len(ws) - n + 1)) u(i)
         where list_contains(ws, 'license') and array_to_string(ws[i + 1:i + n], ' ') = phrase),
places as (select rid, count(*) as n, min(i) as first_word, max(i) as last_word,
                  string_agg(distinct label, ',' order by label) as labels from base group by rid),
named as (select rid, string_agg(distinct label, ',' order by label) as labels from (
    select rid, label from base union all select rid, label from proven join {labels} l(t, label) using (t)) group by rid),
best as (select rid, max(score) as score from proven group by rid)
select doc_id, len(ws)::bigint as n_words, coalesce(n, 0)::bigint as n_base, first_word::bigint as first_word,
       last_word::bigint as last_word, coalesce(places.labels, '') as base_labels, coalesce(named.labels, '') as labels,
       round(coalesce(score, 0), 6) as score
from w left join places using (rid) left join named using (rid) left join best using (rid)"""


OP1, OP3, OP9 = _op1(), _op3(), _op9()
