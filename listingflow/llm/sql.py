"""DuckDB SQL that the corpus queries must agree with, where SQL can express them."""

from listingflow.llm.licenses import GAP, NEIGHBOURS, TEMPLATES, distinguishing, in_order, needed, spare, template_words

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

def _template_rows() -> str:
    """Every template: its label, distinct words, words needed, words of a block, words beside it, names it needs and forbids."""
    every = [(label, template_words(text), len(in_order(text)), spare(text)) for label, text in TEMPLATES + NEIGHBOURS]
    rows = []
    for (label, words, length, beside), (names, others) in zip(every, distinguishing([words for _, words, _, _ in every]), strict=True):
        lists = [f"{sorted(x)}::varchar[]" for x in (names, others)]
        rows.append(f"select '{label}' as label, {words} as words, {needed(len(words), 0.85)} as need, {length + beside} as room, {beside} as beside, {lists[0]} as names, {lists[1]} as others")
    return " union all ".join(rows)


#: A term: letters, digits and everything beyond ASCII.
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"

ORACLES = {
    "op7_exact_dedup": f"""
        with d as (select doc_id, {_LOWER} as t from documents)
        select doc_id, max(doc_id) over (partition by t) as keep_id, count(*) over (partition by t) as group_size,
               row_number() over (partition by t order by doc_id desc) = 1 as kept, sha256(t) as text_sha256
        from d
    """,
    "op8_line_dedup": """
        with l as (
            select doc_id, generate_subscripts(parts, 1) as pos, unnest(parts) as line
            from (select doc_id, string_split(coalesce(text, ''), chr(10)) as parts from documents)
        ), k as (
            select *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                                'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as key
            from l
        ), h as (
            select key, max(doc_id) as holder from k where length(key) >= 20 group by key having count(distinct doc_id) >= 3
        ), m as (
            select k.*, h.holder is not null and h.holder <> k.doc_id as gone from k left join h using (key)
        )
        select doc_id, count(*) as n_lines, count(*) filter (where gone) as n_dropped,
               sha256(coalesce(string_agg(line, chr(10) order by pos) filter (where not gone), '')) as kept_sha256
        from m group by doc_id
    """,
    "op9_license_scans": f"""
        with d as (select row_number() over () as r, doc_id, {_LOWER} as t from documents),
        w as (select *, list_filter(string_split_regex(t, '{GAP}'), lambda x: x <> '') as words from d),
        u as (select r, unnest(words) as a, generate_subscripts(words, 1) - 1 as i from w),
        n as (select *, lead(a) over (partition by r order by i) as b, lead(a, 2) over (partition by r order by i) as c from u),
        h as (
            select r, i, case when a = 'mit' and b = 'license' then 'mit' when a = 'apache' and b = 'license' then 'apache'
                              when a = 'general' and b = 'public' and c = 'license' then 'gpl' end as label from n
        ),
        base as (select r, count(*) as n_base, min(i) as first_word, max(i) as last_word from h where label is not null group by r),
        templates as ({_template_rows()}),
        -- A block begins at every word that a template has.
        blocks as (select u.r, u.i, t.label, t.words, t.names, t.others, t.beside, t.need, w.words as text, list_slice(w.words, u.i + 1, u.i + t.room) as block
                   from u join templates t on list_contains(t.words, u.a) join w on w.r = u.r where len(w.words) - u.i >= t.need),
        held as (select *, list_intersect(words, block) as hit from blocks),
        reached as (select *, list_max(list_transform(hit, lambda x: list_position(block, x))) as last from held
                    where len(hit) >= need and len(list_intersect(names, block)) = len(names)),
        found as (select r, label, len(hit) / len(words) as share from reached
                  where not list_has_any(others, list_slice(text, greatest(i - beside, 0) + 1, i + last + beside))),
        tags as (select r, label from found union select r, label from h where label is not null)
        select doc_id, len(w.words) as n_words, coalesce(n_base, 0) as n_base, first_word, last_word,
               coalesce((select string_agg(distinct label, ',' order by label) from h where h.r = w.r), '') as base_labels,
               coalesce((select string_agg(distinct label, ',' order by label) from tags where tags.r = w.r), '') as labels,
               coalesce((select max(share) from found where found.r = w.r), case when n_base > 0 then 1.0::double end, 0.0::double) as score
        from w left join base using (r)
    """,
    "op11_hard_negatives": """
        with e as (
            select vec_id as id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
                   list_transform(embedding, lambda x: floor(256 * x::double)) as v
            from embeddings
            where vec_id is not null and label is not null and embedding is not null
              and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
        ), s as (
            select a.id as anchor_id, r.id, a.label = r.label as same, list_inner_product(a.v, r.v)::bigint as score
            from e a, e r where a.id % 100 = 0 and r.id <> a.id
        ), p as (
            select * from s where same qualify row_number() over (partition by anchor_id order by score desc, id) <= 5
        )
        select p.anchor_id, p.id as positive_id, row_number() over w ::int as rank, n.id as negative_id, p.score as positive_score,
               n.score as negative_score
        from p join s n on n.anchor_id = p.anchor_id and not n.same and 80 * p.score <= 100 * n.score and n.score <= p.score
        window w as (partition by p.anchor_id, p.id order by n.score desc, n.id)
        qualify row_number() over w <= 5
    """,
    "op12_ranked_search": f"""
        with d as (select doc_id, regexp_extract_all({_LOWER}, '{TERM}') as terms from documents),
        u as (select doc_id, unnest(terms) as term, len(terms) as n from d),
        f as (select doc_id, term, any_value(n) as n, count(*) as tf from u group by doc_id, term),
        c as (select count(*) as docs, sum(len(terms))::bigint as total from d where len(terms) > 0),
        w as (select term, floor(1000 * ln((2 * docs + 2)::double / (2 * count(*) + 1)))::bigint as w from f, c group by term, docs),
        i as (select distinct item_id, unnest(regexp_extract_all({_LOWER}, '{TERM}')) as term from benchmark),
        s as (
            select item_id, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (100 - 50 + (50 * n * docs) // total))))::bigint as score
            from i join f using (term) join w using (term), c group by item_id, doc_id
        )
        select item_id, row_number() over o ::int as rank, doc_id, score from s where score > 0
        window o as (partition by item_id order by score desc, doc_id) qualify row_number() over o <= 50
    """,
}
