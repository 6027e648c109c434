"""SQL (DuckDB) for the queries that SQL can express."""

from __future__ import annotations

from hourloom.llm import mixing, rules
from hourloom.llm.common import UPPER

_SPACES = "chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
_WORD = r"[^\x20\x09-\x0D]+"


def _histograms() -> tuple[str, str]:
    """The columns that count characters by class, and the rows of the word lists."""
    classes = ", ".join(
        f"length(text) - length(regexp_replace(text, '{p.replace(chr(39), chr(39) * 2)}', '', 'g')) as {name}"
        for name, p in rules.CLASSES.items()
    )
    lists = ", ".join(
        f"('{lang}', {k}, '{word}')" for lang, ws in sorted(rules.COMMON_WORDS.items()) for k, word in enumerate(ws)
    )
    return classes, lists


def quality() -> str:
    classes, lists = _histograms()
    n = len(next(iter(rules.COMMON_WORDS.values())))
    names = list(rules.CLASSES)

    def distance(table: str) -> str:
        return f"""select doc_id, sqrt(greatest(0.0, sum(0.5 * (
                case when p > 0 then p * log2(p / ((p + q) / 2)) else 0 end
                + case when q > 0 then q * log2(q / ((p + q) / 2)) else 0 end)))) as d
            from (select doc_id, v / sum(v) over (partition by doc_id) as p, r / sum(r) over (partition by doc_id) as q
                from {table} join (select lang, k, sum(v) as r from {table} where lang is not null group by all) using (lang, k))
            group by doc_id"""

    return f"""
    with base as (select doc_id, lang, coalesce(text, '') as text from documents),
    parts as materialized (select doc_id, lang, regexp_extract_all(text, '{_WORD}') as w from base),
    spots as (select doc_id, unnest(range(1, len(w) - 1)) as k, w from parts where len(w) > 3),
    windows as (select doc_id, k, w[k] || ' ' || w[k + 1] || ' ' || w[k + 2] as s from spots),
    repeated as (select doc_id, k from windows qualify count(*) over (partition by doc_id, s) > 1),
    repeats as (select doc_id, count(distinct k + d) as n from repeated, (values (0), (1), (2)) t(d) group by doc_id),
    lines as (select doc_id, unnest(string_split(text, chr(10))) as line from base),
    dups as (select doc_id, count(*) - count(distinct line) as n from lines
        where regexp_matches(line, '[^\\x20\\x09-\\x0D]') group by doc_id),
    counts as (select doc_id, length(text) as chars, {classes} from base),
    measured as materialized (
        select p.doc_id, p.lang, len(p.w)::bigint as n_words, length(array_to_string(p.w, ''))::bigint as word_chars,
            symbol::bigint as n_symbols, coalesce(dups.n, 0)::bigint as n_dup_lines, coalesce(repeats.n, 0)::bigint as n_repeat_words,
            counts.* exclude (doc_id)
        from parts p join counts using (doc_id) left join dups using (doc_id) left join repeats using (doc_id)),
    class_hist as (
        select doc_id, lang, unnest(range({len(names) + 1})) as k,
            unnest([{", ".join(names)}, chars - {" - ".join(names)}])::double as v from measured),
    common(lang, k, word) as (values {lists}),
    hits as (select p.doc_id, c.k, count(*) as v
        from (select doc_id, lang, unnest(w) as word from parts) p join common c using (lang, word) group by all),
    listed as (select doc_id, m.lang, c.k, coalesce(h.v, 0) as v
        from measured m join common c using (lang) left join hits h using (doc_id, k)),
    word_hist as materialized (
        select doc_id, lang, k, v::double as v from listed
        union all
        select doc_id, lang, {n}, (any_value(n_words) - sum(v))::double from listed join measured using (doc_id, lang) group by doc_id, lang),
    class_far as ({distance("class_hist")}),
    word_far as ({distance("word_hist")})
    select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
        n_words < {rules.MIN_WORDS} or 100 * n_repeat_words > {rules.MAX_REPEATED_PERCENT} * n_words as base_failed,
        not (n_words < {rules.MIN_WORDS} or 100 * n_repeat_words > {rules.MAX_REPEATED_PERCENT} * n_words
            or (chars >= {rules.MIN_COMPARED_CHARS} and coalesce(c.d, 0) > {rules.MAX_CLASS_DISTANCE})
            or (n_words >= {rules.MIN_COMPARED_WORDS} and coalesce(w.d, 0) > {rules.MAX_WORD_DISTANCE})) as kept
    from measured left join class_far c using (doc_id) left join word_far w using (doc_id)
    """


LINE_DEDUP = f"""
    with split as (select doc_id, string_split(coalesce(text, ''), chr(10)) as l from documents),
    lines as materialized (
        select doc_id, line, place, translate(trim(line, {_SPACES}), '{UPPER}', '{UPPER.lower()}') as key
        from (select doc_id, unnest(l) as line, unnest(range(len(l))) as place from split)),
    shared as (select key, min(doc_id) as keeper from lines where length(key) >= 10 group by key having count(distinct doc_id) >= 2),
    marked as (select lines.*, keeper is not null and doc_id <> keeper as gone from lines left join shared using (key))
    select doc_id, count(*) as n_lines, count(*) filter (gone) as n_dropped,
        sha256(coalesce(string_agg(line, chr(10) order by place) filter (not gone), '')) as kept_sha256
    from marked group by doc_id
    """

MIXING = f"""
    with recursive g as materialized (
        select coalesce('=' || source, '') as g, count(*) as n from documents group by 1),
    w as materialized (
        select g, greatest(1, floor({mixing.FRAME_BLOCKS} * sqrt(n) / (select sum(sqrt(n)) from g) + 0.5))::bigint as p,
            (n + {mixing.BLOCK_ROWS - 1}) // {mixing.BLOCK_ROWS} as b, row_number() over (order by g) - 1 as s from g),
    changes as (select 0::bigint as c union select b // p from w union select (b + p - 1) // p from w),
    kinds as (select row_number() over (order by c) - 1 as kind, c as first, lead(c) over (order by c) as after
        from changes qualify after is not null),
    framed as (select kind, first, after, list(greatest(0, least(p, b - first * p)) order by s) as m from kinds, w group by all),
    starts as materialized (
        select *, list_sum(m)::bigint as size,
            coalesce(sum((after - first) * list_sum(m)) over (order by kind rows between unbounded preceding and 1 preceding), 0)::bigint as slot
        from framed),
    edf(kind, t, m, size, nxt, s, k) as (
        select kind, 0::bigint, m, size, list_transform(m, lambda x: 0::bigint), null::bigint, null::bigint from starts
        union all
        select kind, t + 1, m, size, list_transform(nxt, lambda x, i: x + (case when i = pick.s + 1 then 1 else 0 end)), pick.s, pick.k
        from (select *, list_min(list_filter(list_transform(range(len(m)), lambda j: case
                when nxt[j + 1] < m[j + 1] and (nxt[j + 1] * size) // m[j + 1] <= t
                then {{'due': ((nxt[j + 1] + 1) * size + m[j + 1] - 1) // m[j + 1], 's': j, 'k': nxt[j + 1]}} end),
                lambda x: x is not null)) as pick
            from edf where t < size)),
    numbered as (
        select doc_id, source, coalesce('=' || source, '') as g,
            row_number() over (partition by source order by ((doc_id % 2147483648) * {mixing.SPREAD}) % 2147483648, doc_id) - 1 as i
        from documents),
    placed as (select doc_id, source, s, i % {mixing.BLOCK_ROWS} as place, i // {mixing.BLOCK_ROWS} // p as frame,
            (i // {mixing.BLOCK_ROWS}) % p as k
        from numbered join w using (g))
    select doc_id, source, x.slot + (frame - x.first) * x.size + e.t - 1 as slot, place
    from placed join starts x on frame >= x.first and frame < x.after join edf e on e.kind = x.kind and e.s = placed.s and e.k = placed.k
    """

MERKLE = r"""
with recursive fields as (
    select doc_id, lang, source, n_chars, text,
        list_transform([doc_id::varchar, source, lang, n_chars::varchar], lambda v: coalesce(strlen(v) || ':' || v, '-')) as f,
        list_transform(string_split(doc_id::varchar, ''), lambda c: ord(c)) as id_bytes
    from documents),
crc as (
    select *, xor(4294967295, list_reduce(list_prepend(4294967295::ubigint, list_transform(id_bytes, lambda b: b::ubigint)),
        lambda c, b: list_reduce(list_prepend(xor(c, b), [0::ubigint, 0, 0, 0, 0, 0, 0, 0]),
            lambda x, i: xor(x >> 1, 3988292384::ubigint * (x & 1::ubigint))))) % 3 = 0 as hit
    from fields),
hashed as (
    select doc_id, lang, sha256(f[1] || f[2] || f[3] || f[4] || coalesce(strlen(text) || ':' || text, '-')) as leaf,
        sha256(f[1] || f[2] || f[3] || f[4] || coalesce(strlen(text) || ':' || case when coalesce(hit, false)
            then translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') else text end, '-')) as tampered
    from crc),
langs as (select lang, row_number() over (order by lang nulls first) - 1 as tree, count(*) as n from hashed group by lang),
leaves as materialized (
    select l.tree, row_number() over (partition by l.tree order by h.doc_id nulls first, h.leaf) - 1 as idx, l.n, h.*
    from hashed h join langs l on h.lang is not distinct from l.lang),
levels(tree, level, idx, h, n) as (
    select tree, 0, idx, leaf, n from leaves
    union all
    select tree, level + 1, idx // 8, sha256(string_agg(h, '' order by idx)), (any_value(n) + 7) // 8
    from levels where n > 1 group by tree, level, idx // 8),
tops as (select tree, h as subroot from levels where n = 1),
over_tops(level, idx, h, n) as (
    select 0, tree, subroot, (select count(*) from tops) from tops
    union all
    select level + 1, idx // 8, sha256(string_agg(h, '' order by idx)), (any_value(n) + 7) // 8
    from over_tops where n > 1 group by level, idx // 8),
nodes as materialized (
    select tree, level, idx, h, n from levels where n > 1
    union all
    select -1, level, idx, h, n from over_tops where n > 1),
runs as materialized (
    select tree, level, idx // 8 as up, list(h order by idx) as hs from nodes group by all),
tree_top as (select tree, max(level) as top from levels group by tree),
climb(tree, doc_id, leaf, at_tree, level, idx, folded, siblings) as (
    select l.tree, doc_id, leaf, case when n > 1 then l.tree else -1 end, 0, case when n > 1 then l.idx else l.tree end, tampered, ''
    from leaves l
    union all
    select c.tree, c.doc_id, c.leaf, case when c.at_tree >= 0 and c.level + 1 = t.top then -1 else c.at_tree end,
        case when c.at_tree >= 0 and c.level + 1 = t.top then 0 else c.level + 1 end,
        case when c.at_tree >= 0 and c.level + 1 = t.top then c.tree else c.idx // 8 end,
        sha256(array_to_string(r.hs[:c.idx % 8], '') || c.folded || array_to_string(r.hs[c.idx % 8 + 2:], '')),
        c.siblings || array_to_string(r.hs[:c.idx % 8], '') || array_to_string(r.hs[c.idx % 8 + 2:], '')
    from climb c join runs r on r.tree = c.at_tree and r.level = c.level and r.up = c.idx // 8 join tree_top t on t.tree = c.tree),
root as (select h as root from over_tops where n = 1)
select doc_id, leaf, subroot, root, sha256(siblings) as proof_sha256, folded as folded_root, folded = root as verified
from climb c join tops using (tree) cross join root
where at_tree = -1 and not exists (select 1 from runs r where r.tree = -1 and r.level = c.level)
"""

COLLOCATIONS = r"""
with pieces as (
    select coalesce(lang, 'und') as lang, unnest(string_split_regex(translate(coalesce(text, ''),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) as piece
    from documents),
worded as materialized (select lang, regexp_extract_all(piece, '[^\x20\x09]+') as w from pieces),
spots as (select lang, w, unnest(range(1, len(w) + 1)) as i from worded where len(w) > 0),
spans as (
    select lang, w[i:i + k - 1] as phrase from spots, (values (1), (2), (3), (4)) t(k) where i + k - 1 <= len(w)),
counts as materialized (select lang, phrase, count(*) as a from spans group by all having count(*) >= 30),
totals as (select lang, sum(len(w))::bigint as n from worded group by lang),
cuts as (
    select c.lang, c.phrase, c.a, k, c.phrase[:k] as head, c.phrase[k + 1:] as tail
    from (select *, unnest(range(1, len(phrase))) as k from counts where len(phrase) > 1) c),
scored as (
    select u.lang, u.phrase, u.a, x.a as l, y.a as r, (2000000::hugeint * u.a // (x.a + y.a))::bigint as score
    from cuts u join counts x on x.lang = u.lang and x.phrase = u.head join counts y on y.lang = u.lang and y.phrase = u.tail
    qualify row_number() over (partition by u.lang, u.phrase order by 2000000::hugeint * u.a // (x.a + y.a), k) = 1),
inner_phrases as (
    select s.lang, s.phrase[i:i + k - 1] as phrase, max(s.a) as most
    from (select *, unnest(range(1, len(phrase))) as i from counts where len(phrase) > 2) s, (values (2), (3)) t(k)
    where k < len(s.phrase) and i + k - 1 <= len(s.phrase) group by all),
kept as (
    select s.lang, array_to_string(s.phrase, ' ') as phrase, s.a, s.l, s.r, s.score
    from scored s left join inner_phrases m on m.lang = s.lang and m.phrase = s.phrase
    where m.most is null or 100::hugeint * m.most < 80::hugeint * s.a)
select lang, rank, phrase, a, l, r, n, score
from (select *, row_number() over (partition by lang order by score desc, a desc, phrase) as rank from kept) join totals using (lang)
where rank <= 2000
"""

ORACLES = {
    "op2_quality_rules": quality(),
    "op3_line_dedup": LINE_DEDUP,
    "op5_mixing": MIXING,
    "op12_merkle": MERKLE,
    "op13_collocations": COLLOCATIONS,
}
