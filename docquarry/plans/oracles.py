"""DuckDB SQL for the registered queries, over the same tables.

Every statement is a chain of named steps: ``STEPS`` in order of use, then the final select.
"""

from __future__ import annotations

import re

from docquarry.config import ACT_COLUMNS, DEFAULTS, MISSING_SPELLINGS
from docquarry.plans.fixtures import SECOND, THIRD
from docquarry.plans.pipeline import INTERCEPT


def _strings(values) -> str:
    return ", ".join("'" + value.replace("'", "''") + "'" for value in values)


_STOP = f"[{_strings(DEFAULTS.stop_words)}]"
_MISSING = _strings(MISSING_SPELLINGS)


def _known(column: str) -> str:
    return f"case when {column} in ({_MISSING}) then null else {column} end"


def _words(text: str) -> str:
    contraction = r"(n['’]t|['’](s|ll|re|ve|d|m))([^\p{L}\p{N}]|$)".replace("'", "''")
    return (
        f"regexp_split_to_array(regexp_replace(lower({text}), '{contraction}', ' ', 'g'), "
        r"'[^\p{L}\p{N}]+')"
    )


def _kept(text: str, letters_only: bool) -> str:
    letters = r" and regexp_full_match(x, '\p{L}+')" if letters_only else ""
    return f"list_filter({_words(text)}, lambda x: length(x) >= 2 and not list_contains({_STOP}, x){letters})"


_STEM = r"regexp_replace(regexp_replace(x, '([^ae])ies$', '\1y'), '([^us])s$', '\1')"


def _tokens(text: str, letters_only: bool) -> str:
    return f"list_transform({_kept(text, letters_only)}, lambda x: {_STEM})"


def lemma_tokens(key: str, text: str, source: str, letters_only: bool) -> str:
    """Tokens with lemmas from the table, one row each."""
    return f"""
        select {key}, pos, coalesce(lemma, {_STEM}) as token
        from (select {key}, unnest(kept) as x, generate_subscripts(kept, 1) - 1 as pos
              from (select {key}, {_kept(text, letters_only)} as kept from {source}))
        left join lemma_table on surface = x"""


def _gram_words(text: str) -> str:
    return f"regexp_extract_all(lower({text}), " + r"'[\p{L}\p{N}_]{2,}')"


def _grams(words: str) -> str:
    return (
        f"list_concat({words}, list_transform(range(1, len({words})), "
        f"lambda i: {words}[i] || ' ' || {words}[i + 1]))"
    )


VALUES = {"SECOND": SECOND, "THIRD": THIRD, "INTERCEPT": f"({INTERCEPT})::double"}

STEPS: dict[str, str] = {
    "labelled": "select d.*, l.quality, l.toxic from documents d left join labels l on d.doc_id = l.doc_id",
    "raw_acts": """
        select doc_id as row_no, upper(lang) as Act_type,
               case when quality is null then 'NA' else source end as Act_name,
               'D' || lpad(cast(doc_id as varchar), 8, '0') as CELEX, text as act_raw_text,
               case when n_chars >= 200 then concat_ws('; ', upper(lang), 'Source ' || substr(source, 4),
                 case when quality = 1 then 'High Quality' when quality = 0 then 'Low Quality' end,
                 case when toxic = 1 then 'Toxic' end, '') end as EUROVOC
        from labelled
        union all
        select item_id + %(THIRD)d, 'NOTICE', 'NULL', 'B' || lpad(cast(item_id as varchar), 8, '0'),
               case when length(text) < 150 then 'NA' when length(text) < 250 then 'n/a'
                    when length(text) < 350 then '' end, 'EN'
        from benchmark""",
    "raw_acts_dup": """
        select * from raw_acts
        union all
        select row_no + %(SECOND)d, Act_type, Act_name, CELEX, 'second copy ' || act_raw_text, EUROVOC
        from raw_acts where row_no in (select doc_id from labels where toxic = 1)""",
    "wide_acts": """
        select a.*, n_chars, quality, toxic from raw_acts a left join labelled d on a.row_no = d.doc_id""",
    "known_acts": "select row_no, " + ", ".join(f"{_known(c)} as {c}" for c in ACT_COLUMNS) + " from raw_acts",
    "acts": """
        select row_no, lower(coalesce(Act_type, '')) as Act_type, lower(coalesce(Act_name, '')) as Act_name,
               lower(coalesce(CELEX, '')) as CELEX, lower(act_raw_text) as act_raw_text,
               case when lower(coalesce(EUROVOC, '')) = 'nan' then cast([] as varchar[])
                    else list_filter(list_transform(string_split(lower(coalesce(EUROVOC, '')), ';'),
                         lambda x: trim(x)), lambda x: x <> '') end as EUROVOC
        from known_acts where act_raw_text is not null""",
    "corpus": f"""
        select CELEX as doc_id, row_no, EUROVOC as tags, {_tokens('act_raw_text', True)} as tokens
        from (select *, row_number() over (partition by CELEX order by row_no desc) as copy from acts)
        where copy = 1""",
    "dup_tokens": f"""
        select lower(coalesce({_known('CELEX')}, '')) as doc_id, row_no,
               {_tokens('act_raw_text', True)} as tokens
        from raw_acts_dup where {_known('act_raw_text')} is not null""",
    "postings": """
        select doc_id, term, count(*) as tf from (select doc_id, unnest(tokens) as term from corpus)
        group by doc_id, term""",
    "lengths": "select doc_id, len(tokens) as length from corpus",
    "doc_freq": "select term, count(*) as df from postings group by term",
    "stats": """
        select count(*) as n, coalesce(sum(len(tokens)), 0) as total, coalesce(avg(len(tokens)), 0.0) as avgdl
        from corpus""",
    "idf": """
        select term, df, ln((n - df + 0.5::double) / (df + 0.5::double) + 1) as idf from doc_freq, stats""",
    "tag_names": """
        select distinct trim(t) as tag from (select unnest(string_split(lower(EUROVOC), ';')) as t
        from raw_acts where EUROVOC is not null) where trim(t) <> ''""",
    "query_set": """
        select 'P' || lpad(cast(item_id as varchar), 8, '0') as qid, text as raw_query,
               cast(null as varchar) as target_label from benchmark
        union all select 'L ' || tag, tag, replace(tag, ' ', '_') from tag_names
        union all select 'E1', '', null
        union all select 'E2', 'the of and', null
        union all select 'E3', 'zzzz qqqq 2024', null
        union all select 'E4', 'Toxic things, things and EN', 'unknown_label'""",
    "queries": f"select *, {_tokens('raw_query', False)} as tokens from query_set",
    "last_acts": """
        select CELEX as doc_id, act_raw_text from
          (select *, row_number() over (partition by CELEX order by row_no desc) as copy from acts) where copy = 1""",
    "lemma_table": f"""
        select surface, substr(surface, 1, length(surface) - 3) as lemma
        from (select distinct unnest({_words('act_raw_text')}) as surface from acts)
        where surface like '%%ing' and length(surface) > 5""",
    "query_terms": """
        select qid, term, count(*) as qtf from (select qid, unnest(tokens) as term from queries)
        group by qid, term""",
    "scores": """
        select q.qid, p.doc_id,
               sum(q.qtf * i.idf * p.tf * 2.5::double / (p.tf + 1.5::double * (0.25::double
                   + 0.75::double * l.length / s.avgdl))) as score
        from query_terms q join idf i on q.term = i.term join postings p on p.term = q.term
        join lengths l on l.doc_id = p.doc_id cross join stats s
        group by q.qid, p.doc_id""",
    "dup_postings": """
        select doc_id, term, arg_max(tf, row_no) as tf from
          (select doc_id, row_no, term, count(*) as tf
           from (select doc_id, row_no, unnest(tokens) as term from dup_tokens) group by all)
        group by doc_id, term""",
    "dup_lengths": "select doc_id, arg_max(len(tokens), row_no) as length from dup_tokens group by doc_id",
    "dup_idf": """
        select term, ln((n - df + 0.5::double) / (df + 0.5::double) + 1) as idf
        from (select term, count(*) as df from dup_postings group by term), (select count(*) as n from dup_tokens)""",
    "dup_scores": """
        select q.qid, p.doc_id,
               sum(q.qtf * i.idf * p.tf * 2.5::double / (p.tf + 1.5::double * (0.25::double
                   + 0.75::double * l.length / s.avgdl))) as score
        from query_terms q join dup_idf i on q.term = i.term join dup_postings p on p.term = q.term
        join dup_lengths l on l.doc_id = p.doc_id cross join (select avg(len(tokens)) as avgdl from dup_tokens) s
        group by q.qid, p.doc_id""",
    "label_freq": """
        select label, count(*) as n from (select unnest(tags) as label from corpus) group by label""",
    "top_labels": """
        select * from (select label, n, row_number() over (order by n desc, label) as rank from label_freq)
        where rank <= 100""",
    "kept_tags": """
        select * from (select doc_id, tokens, list_filter(tags, lambda t: list_contains(names, t)) as kept_tags
               from corpus cross join (select list(label) as names from top_labels)) where len(kept_tags) > 0""",
    "kept_pairs": """
        select distinct doc_id, label from (select doc_id, unnest(kept_tags) as label from kept_tags)""",
    "split": """
        select doc_id, ('0x' || substr(md5(doc_id || '|42'), 1, 8))::bigint %% 100 < 20 as is_test, tokens
        from kept_tags""",
    "train": "select doc_id from split where not is_test",
    "test": "select doc_id from split where is_test",
    "gram_tf": f"""
        select doc_id, gram, count(*) as tf from (select doc_id, unnest({_grams('w')}) as gram
          from (select doc_id, {_gram_words("array_to_string(tokens, ' ')")} as w from corpus))
        group by doc_id, gram""",
    "vocab": """
        select gram, idx, n, df, ln((1 + (select count(*) from train)) / (1.0::double + df)) + 1 as idf
        from (select gram, sum(tf)::bigint as n, count(*) as df,
                     row_number() over (order by sum(tf) desc, gram) - 1 as idx
              from gram_tf where doc_id in (select doc_id from train) group by gram)
        where idx < 50000""",
    "weights": """
        select doc_id, gram, tf * idf / sqrt(sum(tf * idf * tf * idf) over (partition by doc_id)) as weight
        from gram_tf join vocab using (gram)""",
    "train_pairs": "select * from kept_pairs where doc_id in (select doc_id from train)",
    "label_sizes": "select label, count(*) as nl from train_pairs group by label",
    "coefs": """
        select label, gram, case when a * ((select count(*) from train) - nl) > (df - a) * nl
                                 then 1.0::double else -1.0::double end as coef
        from (select p.label, v.gram, any_value(v.df) as df, count(*) as a
              from vocab v join gram_tf g on g.gram = v.gram join train_pairs p on p.doc_id = g.doc_id
              group by p.label, v.gram) join label_sizes using (label)""",
    "margins": """
        select d.doc_id, t.label, t.rank, coalesce(m, 0) + %(INTERCEPT)s as margin
        from corpus d cross join top_labels t left join
          (select doc_id, label, sum(weight * coef) as m from weights join coefs using (gram)
           group by doc_id, label) x on x.doc_id = d.doc_id and x.label = t.label""",
    "label_index": "select label, doc_id from margins where round(margin, 9) > 0",
    "truth": "select * from kept_pairs where doc_id in (select doc_id from test)",
    "guess": "select doc_id, label from label_index where doc_id in (select doc_id from test)",
    "cells": """
        select doc_id, label, (t and p)::int as tp, (p and not t)::int as fp, (t and not p)::int as fn
        from (select doc_id, label, max(t) as t, max(p) as p from
               (select doc_id, label, true as t, false as p from truth
                union all select doc_id, label, false, true from guess) group by doc_id, label)""",
    "label_counts": """
        select t.label, coalesce(sum(tp), 0)::bigint as tp, coalesce(sum(fp), 0)::bigint as fp,
               coalesce(sum(fn), 0)::bigint as fn
        from top_labels t left join cells c on c.label = t.label group by t.label""",
    "label_report": """
        select label, case when tp + fp > 0 then tp / (tp + fp) else 0.0 end as precision,
               case when tp + fn > 0 then tp / (tp + fn) else 0.0 end as recall,
               case when tp + fp + fn > 0 then 2 * tp / (2 * tp + fp + fn) else 0.0 end as f1,
               tp + fn as support from label_counts""",
    "doc_counts": "select doc_id, sum(tp) as tp, sum(fp) as fp, sum(fn) as fn from cells group by doc_id",
    "query_gram_tf": f"""
        select qid, gram, count(*) as tf from (select qid, unnest({_grams('w')}) as gram
          from (select qid, {_gram_words('raw_query')} as w from query_set))
        group by qid, gram""",
    "query_weights": """
        select qid, gram, tf * idf / sqrt(sum(tf * idf * tf * idf) over (partition by qid)) as weight
        from query_gram_tf join vocab using (gram)""",
    "query_margins": """
        select q.qid, t.label, t.rank, coalesce(m, 0) + %(INTERCEPT)s as margin
        from query_set q cross join top_labels t left join
          (select qid, label, sum(weight * coef) as m from query_weights join coefs using (gram)
           group by qid, label) x on x.qid = q.qid and x.label = t.label""",
    "query_labels": "select qid, label, rank from query_margins where round(margin, 9) > 0",
    "targets": """
        select q.qid, t.label, t.rank from query_set q join top_labels t
          on lower(replace(q.target_label, '_', ' ')) = lower(replace(t.label, '_', ' '))""",
    "query_label_set": """
        select qid, label, rank from targets
        union all select qid, label, rank from query_labels where qid not in (select qid from targets)""",
    "tag_docs": "select distinct qid, doc_id from query_label_set join label_index using (label)",
    "union_docs": "select distinct t.qid, p.doc_id from query_terms t join postings p on p.term = t.term",
    "methods": """
        select qid, tokens, case
          when qid in (select qid from targets) then 'classifier_eval'
          when qid in (select qid from tag_docs) then 'ml_prediction + bm25'
          when qid in (select qid from query_labels) then 'boolean_fallback'
          when len(tokens) = 0 then 'none' else 'boolean_only' end as method
        from queries""",
    "candidates": """
        select qid, doc_id from methods join tag_docs using (qid)
        where method in ('classifier_eval', 'ml_prediction + bm25')
        union all select qid, doc_id from methods join union_docs using (qid)
        where method in ('boolean_only', 'boolean_fallback')""",
    "candidate_scores": """
        select c.qid, c.doc_id, coalesce(s.score, 0.0) as score
        from candidates c left join scores s on s.qid = c.qid and s.doc_id = c.doc_id""",
    "ranked": """
        select qid, doc_id, score,
               row_number() over (partition by qid order by round(score, 9) desc, doc_id) as rank
        from candidate_scores""",
    "id_map": """
        select doc_id as row_no, cast(doc_id as varchar) as DocID,
               case when n_chars < 400 then 'null' when n_chars < 500 then ''
                    else 'D' || lpad(cast(doc_id as varchar), 8, '0') end as CelexID from documents
        union all
        select doc_id + %(SECOND)d, cast(doc_id as varchar), 'D' || lpad(cast(doc_id as varchar), 8, '0')
        from labels where quality = 0
        union all select doc_id + %(THIRD)d, cast(doc_id as varchar), 'NULL' from labels where toxic = 1""",
    "ids": """
        select DocID as source_id, arg_max(lower(CelexID), row_no) as doc_id from id_map
        where CelexID <> '' and lower(CelexID) <> 'null' group by DocID""",
    "tagged": """
        select row_no, unnest(tags) as tag, generate_subscripts(tags, 1) - 1 as pos from
          (select row_no, list_filter(list_transform(string_split(lower(EUROVOC), ';'), lambda x: trim(x)),
                                      lambda x: x <> '') as tags
           from raw_acts where EUROVOC is not null and row_no < %(SECOND)d)""",
    "marked": """
        select t.*, d.n_chars, d.quality, d.toxic from tagged t join labelled d on d.doc_id = t.row_no""",
    "judgment_lines": """
        select row_no * 100 + pos as line_no, replace(tag, ' ', '_') || ' ' || cast(row_no as varchar) ||
               case when n_chars < 300 then '' when quality = 1 then ' 2' when quality = 0 then ' 0'
                    else ' 1' end as line from marked
        union all
        select row_no * 100 + pos + %(SECOND)d::bigint * 100,
               '  ' || replace(tag, ' ', '_') || chr(9) || cast(row_no as varchar) || '  3'
        from marked where toxic = 1
        union all
        select row_no * 100 + pos + %(THIRD)d::bigint * 100, 'unknown_label ' || cast(row_no as varchar) || ' 1'
        from marked where toxic = 1 and pos = 0""",
    "judged": r"""
        select line_no, f[1] as label, f[2] as source_id, cast(f[3] as integer) as rel
        from (select line_no, regexp_split_to_array(regexp_replace(line, '^\s+|\s+$', '', 'g'), '\s+') as f
              from judgment_lines) where len(f) = 3""",
    "kept_judged": """
        select *, lower(replace(label, '_', ' ')) as qid from judged
        where lower(replace(label, '_', ' ')) in (select lower(replace(label, '_', ' ')) from top_labels)""",
    "mapped_judged": """
        select k.line_no, k.qid, i.doc_id, k.rel from kept_judged k join ids i on i.source_id = k.source_id""",
    "final_judged": """
        select qid, doc_id, arg_max(rel, line_no) as rel from mapped_judged group by qid, doc_id""",
    "eval_set": """
        select qid, min(line_no) as first_seen from mapped_judged group by qid
""",
    "eval_terms": f"""
        select qid, term, count(*) as qtf from (select qid, unnest({_tokens('qid', False)}) as term from eval_set)
        group by qid, term""",
    "eval_scores": """
        select q.qid, p.doc_id,
               sum(q.qtf * i.idf * p.tf * 2.5::double / (p.tf + 1.5::double * (0.25::double
                   + 0.75::double * l.length / s.avgdl))) as score
        from eval_terms q join idf i on q.term = i.term join postings p on p.term = q.term
        join lengths l on l.doc_id = p.doc_id cross join stats s
        group by q.qid, p.doc_id""",
    "eval_ranked": """
        select * from (select qid, doc_id, score,
          row_number() over (partition by qid order by round(score, 9) desc, doc_id) as rank
          from (select e.qid, x.doc_id, coalesce(s.score, 0.0) as score from eval_set e
                join label_index x on lower(replace(x.label, '_', ' ')) = e.qid
                left join eval_scores s on s.qid = e.qid and s.doc_id = x.doc_id)) where rank <= 50""",
    "eval_judged": "select * from final_judged where qid in (select qid from eval_set)",
    "relevant": "select qid, sum((rel >= 1)::int)::bigint as relevant from eval_judged group by qid",
    "ideal": """
        select qid, sum(case when place <= 10 then rel / log2(place + 1) else 0 end) as ideal_10,
               sum(rel / log2(place + 1)) as ideal_20
        from (select qid, rel, row_number() over (partition by qid order by rel desc, doc_id) as place
              from eval_judged) where place <= 20 group by qid""",
    "found": """
        select *, (rel >= 1)::int as hit,
               sum((rel >= 1)::int) over (partition by qid order by rank) as hits
        from eval_ranked join eval_judged using (qid, doc_id)""",
    "seen": """
        select qid, sum(hit * hits / rank) as precision_sum, max(case when hit = 1 then 1.0::double / rank end) as rr,
               sum(case when rank <= 10 then rel / log2(rank + 1) else 0 end) as gain_10,
               sum(case when rank <= 20 then rel / log2(rank + 1) else 0 end) as gain_20,
               sum(case when rank <= 10 then hit else 0 end) as hits_10,
               sum(case when rank <= 20 then hit else 0 end) as hits_20
        from found group by qid""",
    "per_query": """
        select qid,
               case when relevant > 0 then coalesce(precision_sum, 0) / relevant else 0.0 end as map,
               coalesce(rr, 0.0) as mrr,
               case when ideal_10 > 0 then coalesce(gain_10, 0) / ideal_10 else 0.0 end as ndcg_10,
               coalesce(hits_10, 0) / 10.0::double as precision_10,
               case when relevant > 0 then coalesce(hits_10, 0) / relevant else 0.0 end as recall_10,
               case when relevant > 0 then 2 * coalesce(hits_10, 0) / (relevant + 10) else 0.0 end as f1_10,
               case when ideal_20 > 0 then coalesce(gain_20, 0) / ideal_20 else 0.0 end as ndcg_20,
               coalesce(hits_20, 0) / 20.0::double as precision_20,
               case when relevant > 0 then coalesce(hits_20, 0) / relevant else 0.0 end as recall_20,
               case when relevant > 0 then 2 * coalesce(hits_20, 0) / (relevant + 20) else 0.0 end as f1_20
        from relevant left join ideal using (qid) left join seen using (qid)""",
}


def chain(final: str) -> str:
    """The final select behind the steps it needs, directly or through other steps."""
    needed: set[str] = set()
    todo = [final]
    while todo:
        text = todo.pop()
        for name, body in STEPS.items():
            if name not in needed and re.search(rf"\b{name}\b", text):
                needed.add(name)
                todo.append(body)
    steps = ", ".join(
        f"{name} as ({body % VALUES})"
        for name, body in STEPS.items()
        if name in needed
    )
    return f"with {steps} {final}" if steps else final
