"""DuckDB SQL of the numbered operators that SQL can express."""

ORACLE_SQL = {
    "op8_near_vectors": """
        with recursive v as (select vec_id, cast(embedding as double[]) as x from embeddings),
             e as (select a.vec_id as a, b.vec_id as b from v a join v b on a.vec_id != b.vec_id
                   where list_cosine_similarity(a.x, b.x) >= 0.95),
             reach(a, r) as (select vec_id, vec_id from v union select reach.a, e.b from reach join e on e.a = reach.r),
             c as (select a, min(r) as component_id from reach group by 1),
             n as (select a, count(*) as n_links from e group by 1)
        select vec_id, coalesce(n_links, 0) as n_links, component_id, vec_id = component_id as kept
        from v join c on c.a = vec_id left join n on n.a = vec_id""",
    "op10_jaccard_join": """
        with recursive w as (
               select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                                           'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') as ws
               from documents),
             sets as (select doc_id, case when len(ws) >= 5 then list_distinct([array_to_string(ws[i:i + 4], ' ')
                                                                                for i in range(1, len(ws) - 3)])
                                          when len(ws) > 0 then [array_to_string(ws, ' ')] else [] end as sh from w),
             one as (select doc_id, unnest(sh) as s from sets),
             size as (select doc_id, len(sh) as n from sets),
             p as (select a.doc_id as a, b.doc_id as b, count(*) as common
                   from one a join one b on a.s = b.s and a.doc_id < b.doc_id group by 1, 2),
             link as (select p.a, p.b from p join size x on x.doc_id = p.a join size y on y.doc_id = p.b
                      where 100 * common >= 75 * (x.n + y.n - common)),
             e as (select a, b from link union all select b, a from link),
             reach(a, r) as (select doc_id, doc_id from w union select reach.a, e.b from reach join e on e.a = reach.r)
        select size.doc_id, cast(n as bigint) as n_shingles, min(r) as component_id
        from size join reach on reach.a = size.doc_id group by 1, 2""",
    "op11_filter_audit": """
        with t as (select doc_id, coalesce(lang, '') as part, coalesce(text, '') as x from documents),
             w as (select *, regexp_extract_all(x, '[^\\x20\\x09-\\x0D]+') as ws, min(doc_id) over (partition by x) as first_id from t),
             f as (select doc_id, part,
                          case when len(ws) < 100 then 1 else 0 end
                          + case when 100 * len(list_distinct(ws)) < 80 * len(ws) then 2 else 0 end
                          + case when 100 * length(regexp_replace(x, '[^A-Z]', '', 'g')) > 10 * length(x) then 4 else 0 end
                          + case when regexp_matches(x, '[#$%&*|]') then 8 else 0 end
                          + case when first_id < doc_id then 16 else 0 end as bits from w),
             l as (select doc_id, max(quality) as quality, max(toxic) as toxic from labels group by 1),
             c as (select part, bits, count(*) as n, count(*) filter (where quality = 1) as good,
                          count(*) filter (where toxic = 1) as toxic from f left join l using (doc_id) group by 1, 2),
             a as (select unnest(['A', 'B', 'C', 'D', 'E']) as k, unnest([1, 2, 4, 8, 16]) as b),
             o as (select a.k || b.k || c.k || d.k || e.k as filter_order, [a.b, b.b, c.b, d.b, e.b] as bs
                   from a, a as b, a as c, a as d, a as e
                   where a.b + b.b + c.b + d.b + e.b = 31 and a.b != b.b and a.b != c.b and a.b != d.b and a.b != e.b and b.b != c.b
                     and b.b != d.b and b.b != e.b and c.b != d.b and c.b != e.b and d.b != e.b),
             s as (select filter_order, cast(step as int) as step, bs[step] as own, coalesce(list_sum(bs[1:step - 1]), 0)::int as gone
                   from o, range(1, 6) as r(step)),
             x as (select part, filter_order, step, own,
                          sum(case when bits & own = 0 and bits & gone = 0 then n else 0 end) as kept,
                          sum(case when bits & own != 0 and bits & gone = 0 then n else 0 end) as removed,
                          sum(case when bits & own != 0 and bits & gone != 0 then n else 0 end) as redundant,
                          sum(case when bits = own then n else 0 end) as unique_fails,
                          sum(case when bits & own != 0 and bits & gone = 0 then good else 0 end) as good_lost,
                          sum(case when bits & own != 0 and bits & gone = 0 then toxic else 0 end) as toxic_lost
                   from c, s group by 1, 2, 3, 4)
        select part, filter_order, step, kept::bigint as kept, removed::bigint as removed, redundant::bigint as redundant,
               unique_fails::bigint as unique_fails, good_lost::bigint as good_lost, toxic_lost::bigint as toxic_lost,
               (sum(removed) over (partition by part, own))::bigint as shapley from x""",
}
