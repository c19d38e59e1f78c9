"""DuckDB SQL for the operators that SQL can express."""

from __future__ import annotations

from millrace.llm import licenses

_WORD = r"[^\x20\x09-\x0D]+"


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _split(above: str, path: list[str], depth: int, weight: str) -> str:
    name, parent = path[-1], ", ".join(path[:-1])
    part = f"partition by {parent}" if parent else ""
    given = f"p{depth - 1}.budget" if depth else "(select asked from totals)"
    join = f"join p{depth - 1} using ({parent})" if depth else ""
    return f"""
        n{depth} as (
            select {', '.join(path)}, sum(tokens * 3)::hugeint as cap, ({weight})::hugeint as weight
            from leaves group by {', '.join(path)}
        ), r{depth} as (
            select n.*, {given}::hugeint as given,
                   coalesce(sum(cap) over (need rows between unbounded preceding and 1 preceding), 0)::hugeint as used,
                   (sum(weight) over (need rows between current row and unbounded following))::hugeint as later
            from n{depth} n {join}
            window need as ({part} order by cap::double / weight::double, {name})
        ), f{depth} as (
            select *, cap * later <= (given - used) * weight as filled from r{depth}
        ), o{depth} as (
            select *, case when filled then 0 else weight end::hugeint as open from f{depth}
        ), s{depth} as (
            select *, given - coalesce(sum(case when filled then cap end) over ({part}), 0)::hugeint as rest,
                   (sum(open) over ({part}))::hugeint as everyone,
                   (sum(open) over ({part} order by {name} rows between unbounded preceding and current row))::hugeint as upto
            from o{depth}
        ), p{depth} as (
            select {', '.join(path)},
                   case when filled then cap
                        else (rest * upto) // everyone - (rest * (upto - open)) // everyone end::bigint as budget
            from s{depth}
        )"""


def _mixing() -> str:
    levels = ["domain", "lang", "source"]
    weights = [
        "case domain when 'web' then 4 when 'books' then 3 when 'code' then 2 else 1 end",
        "case lang when 'en' then 5 when 'de' then 2 when 'fr' then 2 else 1 end",
        "1",
    ]
    steps = ",".join(_split("", levels[: d + 1], d, weights[d]) for d in range(3))
    return f"""
        with docs as (
            select doc_id, coalesce(lang, '') as lang, coalesce(source, '') as source,
                   substr(md5(coalesce(source, '')), 1, 1) as digit,
                   coalesce(len(regexp_extract_all(text, '{_WORD}')), 0)::bigint as tokens
            from documents
        ), thin as (
            select doc_id, lang, source, tokens,
                   case when digit < '4' then 'web' when digit < '8' then 'books' when digit < 'c' then 'code' else 'news' end as domain
            from docs
        ), leaves as (
            select domain, lang, source, sum(tokens)::bigint as tokens from thin group by all
        ), totals as (
            select coalesce(sum(tokens), 0)::bigint as asked from leaves
        ), {steps}, plan as (
            select l.domain, l.lang, l.source,
                   case when l.tokens > 0 then b.budget // l.tokens else 0 end as whole,
                   case when l.tokens > 0 then b.budget % l.tokens else 0 end as rest
            from leaves l join p2 b using (domain, lang, source)
        ), used as (
            select t.*, whole, rest from thin t join plan using (domain, lang, source)
        ), repeated as (
            select doc_id, domain, lang, source, tokens, unnest(range(whole))::int as epoch, tokens as taken
            from used where whole > 0
        ), placed as (
            select *, md5(concat('17:', whole, ':', coalesce(doc_id::varchar, ''))) as place
            from used where rest > 0 and tokens > 0
        ), summed as (
            select *, sum(tokens) over (
                partition by domain, lang, source order by place, tokens rows between unbounded preceding and current row
            )::bigint as upto
            from placed
        ), prefix as (
            select doc_id, domain, lang, source, tokens, whole::int as epoch, least(tokens, rest - upto + tokens) as taken
            from summed where rest - upto + tokens > 0
        )
        select * from repeated union all select * from prefix"""


def _licenses() -> str:
    word = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
    places, labels = [], []
    for phrase, label in licenses.PHRASES.items():
        parts = phrase.split(" ")
        stands = " and ".join(f"ws[i + {k + 1}] = {_quoted(p)}" for k, p in enumerate(parts))
        places.append(f"list_filter(range(len(ws) - {len(parts) - 1}), lambda i: {stands})")
        labels.append(f"case when len(spots[{len(labels) + 1}]) > 0 then {_quoted(label)} end")
    rows = ", ".join(
        f"({_quoted(t)}, {_quoted(label)}, {sorted(set(t.split(' ')))!r})" for t, label in licenses.TEMPLATES.items()
    )
    return f"""
        with lowered as (
            select doc_id, translate(coalesce(text, ''), '{licenses._UPPER}', '{licenses._LOWER}') as x from documents
        ), worded as (
            select doc_id, regexp_extract_all(x, '{word}') as ws from lowered
        ), placed as (
            select doc_id, len(ws)::bigint as n_words, [{', '.join(places)}] as spots from worded
        ), based as (
            select doc_id, n_words, flatten(spots) as every, list_distinct(list_filter([{', '.join(labels)}], lambda l: l is not null)) as base
            from placed
        ), templates(template, label, own) as (
            values {rows}
        ), blocks as (
            select doc_id, list_distinct(regexp_extract_all(unnest(regexp_split_to_array(x, '\\n[ \\t\\r]*\\n|[.!?;][ \\t\\r\\n]+')), '{word}')) as tokens
            from lowered
        ), matched as (
            select doc_id, label, len(list_intersect(tokens, own)) as overlap, len(own) as size
            from blocks join templates on list_has_any(tokens, own)
            where 100 * len(list_intersect(tokens, own)) >= {licenses.PERCENT} * len(own)
        ), found as (
            select doc_id, list(distinct label) as more, max(overlap / size) as share from matched group by doc_id
        )
        select doc_id, n_words, len(every)::bigint as n_base,
               list_min(every)::bigint as first_word, list_max(every)::bigint as last_word,
               array_to_string(list_sort(base), ',') as base_labels,
               array_to_string(list_sort(list_distinct(list_concat(base, coalesce(more, [])))), ',') as labels,
               case when len(every) > 0 then 1.0 else coalesce(share, 0.0) end::double as score
        from based left join found using (doc_id)"""


_FILTER_AUDIT = rf"""
    with d as (
        select doc_id, coalesce(source, '') as part, coalesce(text, '') as t,
               regexp_extract_all(coalesce(text, ''), '{_WORD}') as w
        from documents
    ), l as (
        select doc_id, max((coalesce(quality, 0) = 1)::int) as good, max((coalesce(toxic, 0) = 1)::int) as toxic
        from labels group by doc_id
    ), judged as (
        select part, coalesce(good, 0) as good, coalesce(toxic, 0) as toxic, [
            len(w) < 50,
            100 * len(list_distinct(w)) < 65 * len(w),
            100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 5 * length(t),
            regexp_matches(t, '[#$%&*|]'),
            coalesce(d.doc_id > min(d.doc_id) over (partition by t), false)] as failed
        from d left join l using (doc_id)
    ), letters as (
        select unnest(range(1, 6))::int as f
    ), orders as (
        select [a.f, b.f, c.f, d.f, e.f] as o, row_number() over () as nr
        from letters a, letters b, letters c, letters d, letters e
        where len(list_distinct([a.f, b.f, c.f, d.f, e.f])) = 5
    ), masks as (
        select part, failed, count(*) as n, sum(good) as good, sum(toxic) as toxic from judged group by part, failed
    ), removed_at as (
        select m.*, nr, o, coalesce(list_position(list_transform(o, lambda f: failed[f]), true), 6) as hit
        from masks m, orders
    ), steps as (
        select part, array_to_string(list_transform(o, lambda f: chr(64 + f)), '') as filter_order,
               s.f as step, o[s.f] as letter,
               sum(n) filter (hit > s.f) as kept,
               sum(n) filter (hit = s.f) as removed,
               sum(n) filter (hit < s.f and failed[o[s.f]]) as redundant,
               sum(n) filter (failed[o[s.f]] and len(list_filter(failed, lambda x: x)) = 1) as unique_fails,
               sum(good) filter (hit = s.f) as good_lost,
               sum(toxic) filter (hit = s.f) as toxic_lost
        from removed_at, letters s group by part, o, s.f
    )
    select part, filter_order, step, {', '.join(f'coalesce({c}, 0)::bigint as {c}' for c in ('kept', 'removed', 'redundant', 'unique_fails', 'good_lost', 'toxic_lost'))},
           coalesce(sum(removed) over (partition by part, letter), 0)::bigint as shapley
    from steps"""


_LETTERS = r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+"
_SHARE = "1 + (1000000000::hugeint * ({n} + 5)) // ({total} + 5 * v)"
_SOURCE_DIVERGENCE = rf"""
    with d as (
        select row_number() over () as nr, coalesce(lang, '') as lang, coalesce(source, '') as source,
               translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as t
        from documents
    ), w as (
        select nr, lang, source, unnest(regexp_extract_all(t, '{_LETTERS}')) as term from d
    ), kept as (
        select lang, term, count(*) as q from w group by lang, term having count(distinct nr) >= 30
    ), langs as (
        select lang, count(k.term) as v, coalesce(sum(q), 0) as nl from (select distinct lang from d) left join kept k using (lang) group by lang
    ), groups as (
        select distinct lang, source from d
    ), counted as (
        select lang, source, term, count(*) as n from w join kept using (lang, term) group by lang, source, term
    ), dense as (
        select g.lang, g.source, k.term, coalesce(c.n, 0)::hugeint as n, k.q::hugeint as q, v::hugeint as v, nl::hugeint as nl,
               (sum(coalesce(c.n, 0)) over (partition by g.lang, g.source))::hugeint as ns
        from groups g join kept k using (lang) join langs using (lang)
        left join counted c on c.lang = g.lang and c.source = g.source and c.term = k.term
    ), shares as (
        select lang, source, term, n, {_SHARE.format(n='n', total='ns')} as p, {_SHARE.format(n='q', total='nl')} as q from dense
    ), pairs as (
        select a.lang, a.source, b.source as item, sum(abs(a.p - b.p)) as value
        from shares a join shares b on a.lang = b.lang and a.term = b.term and a.source <> b.source
        group by all
    ), every as (
        select a.lang, a.source, 'pair' as part, b.source as item, coalesce(value, 0)::bigint as value
        from groups a join groups b on a.lang = b.lang and a.source <> b.source
        left join pairs p on p.lang = a.lang and p.source = a.source and p.item = b.source
        union all
        select lang, source, 'term', term, (p - q)::bigint from shares where n > 0 and p > q
    )
    select *, row_number() over (partition by lang, source, part order by value desc, item)::int as rank
    from every qualify part = 'pair' or rank <= 50"""


ORACLES = {
    "op13_source_divergence": _SOURCE_DIVERGENCE,
    "op11_filter_interaction": _FILTER_AUDIT,
    "op1_source_mixing": _mixing(),
    "op4_license_scan": _licenses(),
    "op10_exact_top_k": """
        with v as (
            select vec_id, list_transform(embedding, lambda x: floor(64 * x::double)::bigint) as w
            from embeddings
            where vec_id is not null and embedding is not null and len(embedding) > 0
              and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
        ), pairs as (
            select q.vec_id as query_id, c.vec_id,
                   list_sum(list_transform(list_zip(q.w, c.w), lambda p: p[1] * p[2]))::bigint as score
            from v q join v c on q.vec_id <> c.vec_id
            where q.vec_id % 20 = 0
        ), ranked as (
            select *, row_number() over (partition by query_id order by score desc, vec_id)::int as rank from pairs
        )
        select query_id, rank, vec_id, score from ranked where rank <= 20
    """,
}
