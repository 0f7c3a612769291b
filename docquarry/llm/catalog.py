"""The registered queries of the numbered operators, with production parameters, and their SQL."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docquarry.llm import (
    alignment,
    collocations,
    decontaminate,
    jaccard,
    languages,
    neighbours,
    packing,
    quality,
    repair,
    secrets,
    toxicity,
    warc,
    wordpiece,
)
from docquarry.llm.common import held_out, reachable, shared_path, table
from docquarry.llm.tokens import vocabulary_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def registered(oracle: str | None = None):
    def add(query: Callable[[SparkSession, str], DataFrame]):
        @wraps(query)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            reachable(spark)
            return query(spark, sf_dir)

        QUERIES[query.__name__] = run
        if oracle is not None:
            ORACLES[query.__name__] = oracle
        return query

    return add


def _words_sql(text: str) -> str:
    """Words as the shingle operators take them."""
    lower = f"translate(coalesce({text}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    return f"list_filter(string_split_regex({lower}, '[\\x20\\x09-\\x0D]+'), lambda w: w <> '')"


_DECONTAMINATION = f"""
with docs as (select row_number() over () as row, doc_id, {_words_sql('text')} as w from documents),
items as (select row_number() over () as item_row, item_id, {_words_sql('text')} as w from benchmark),
item_shingles as (
    select distinct item_row, item_id, width, array_to_string(w[i: i + width - 1], ' ') as shingle
    from (select *, least(5, len(w)) as width from items where len(w) > 0), lateral (select unnest(range(1, len(w) - width + 2)) as i)),
sizes as (select item_row, count(*) as item_shingles from item_shingles group by item_row),
doc_shingles as (
    select distinct row, doc_id, width, array_to_string(w[i: i + width - 1], ' ') as shingle
    from (select * from docs, (select distinct width from item_shingles) where len(w) >= width),
        lateral (select unnest(range(1, len(w) - width + 2)) as i))
select doc_id, item_id, item_shingles, count(*) as shared, count(*) / item_shingles as containment
from doc_shingles join item_shingles using (width, shingle) join sizes using (item_row)
group by row, doc_id, item_row, item_id, item_shingles having 5 * count(*) >= 4 * item_shingles
"""


@registered(_DECONTAMINATION)
def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every benchmark item that a document holds."""
    return decontaminate.matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def _secrets_sql() -> str:
    """The same spans from DuckDB's regular expressions; entropy by counting each window anew."""
    assign = r"""((?i:password|passwd|secret|token|api_?key))["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)"""
    kinds = [
        ("assign", assign, 2, 8, 0),
        ("access", "AKIA[A-Z0-9]+", 0, 16, 1),
        ("hex", "[0-9a-f]+", 0, 32, 2),
        ("entropy", secrets.CANDIDATE, 0, secrets.WINDOW, 3),
    ]
    masked = "body"
    for word in secrets.ALLOWED_WORDS:
        masked = f"regexp_replace({masked}, '(?i){word}', '{' ' * len(word)}', 'g')"
    cut = ", ".join(
        f"string_split_regex({text}, '{regex}') as g{o}, regexp_extract_all({text}, '{regex}', 0) as h{o}, "
        f"regexp_extract_all({text}, '{regex}', {group}) as v{o}"
        for text, (_, regex, group, _, o) in zip(["body"] * 3 + ["masked"], kinds)
    )
    placed = " union all ".join(
        f"select row, '{kind}' as kind, {o} as ord, unnest(h{o}) as hit, length(unnest(v{o})) as size, {least} as least, "
        f"length(unnest(g{o}[1:len(h{o})])) as gap, unnest(range(len(h{o}))) as nth from cut"
        for kind, _, _, least, o in kinds
    )
    allowed = " or ".join(f"regexp_matches(hit, '{rule}')" for rule in secrets.ALLOWED)
    weights = ", ".join(map(str, secrets.WEIGHTS[1:]))
    w = secrets.WINDOW
    return f"""
    with numbered as (select row_number() over () as row, doc_id, coalesce(text, '') as body from documents),
    cut as (select row, {cut} from (select *, {masked} as masked from numbered)),
    placed as ({placed}),
    spans as (
        select row, kind, ord, hit, size, least,
            sum(gap + length(hit)) over (partition by row, ord order by nth) - length(hit) as s,
            sum(gap + length(hit)) over (partition by row, ord order by nth) as e
        from placed),
    windows as (
        select row, s, e, p, case when regexp_matches(hit, '{secrets.HEX_ONLY}')
                then {secrets.most_weight(secrets.THRESHOLDS['hex'])}
                else {secrets.most_weight(secrets.THRESHOLDS['base64'])} end as most,
            substr(hit, p + 1, {w}) as win
        from (select *, unnest(range(length(hit) - {w} + 1)) as p from spans where kind = 'entropy' and not ({allowed}))),
    letters as (select row, s, p, most, c, count(*) as n
        from (select row, s, p, most, unnest(string_split(win, '')) as c from windows) group by all),
    dense as (select row, s, min(p) as first, max(p) as last
        from (select row, s, p, most from letters group by row, s, p, most having sum(([{weights}])[n]) <= most) group by row, s),
    kept as (
        select row, ord, kind, s, e from spans where kind <> 'entropy' and size >= least
        union all select row, 3, 'entropy', s + first, s + last + {w} from dense),
    found as (
        select row, count(*) filter (kind = 'assign') as n_assign, count(*) filter (kind = 'access') as n_access,
            count(*) filter (kind = 'hex') as n_hex,
            coalesce(string_agg(kind || ':' || s || ':' || e, ',' order by s, ord) filter (kind <> 'entropy'), '') as base,
            string_agg(kind || ':' || s || ':' || e, ',' order by s, ord) as spans
        from kept group by row)
    select doc_id, coalesce(n_assign, 0) as n_assign, coalesce(n_access, 0) as n_access, coalesce(n_hex, 0) as n_hex,
        sha256(coalesce(base, '')) as base_sha256, coalesce(spans, '') as spans
    from numbered left join found using (row)
    """


@registered()
def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words and greedy longest-match pieces of every document."""
    return wordpiece.token_counts(table(spark, sf_dir, "documents", "doc_id", "text"), vocabulary_path("word_bpe_49k.json"))


@registered()
def op3_warc_archives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page written to archives and read back from them."""
    folder = shared_path(spark, "warc")
    warc.write_archives(table(spark, sf_dir, "pages", "page_id", "url", "html"), folder)
    return warc.read_pages(spark, folder).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "n_segments", "problem"
    )


@registered(_secrets_sql())
def op4_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every document: counts, a digest of the pattern spans, and all spans."""
    found = secrets.find_secrets(table(spark, sf_dir, "documents", "doc_id", "text"))
    return found.select(
        "doc_id",
        "n_assign",
        "n_access",
        "n_hex",
        F.sha2(secrets.joined("base_spans").cast("binary"), 256).alias("base_sha256"),
        secrets.joined("secret_spans").alias("spans"),
    )


@registered()
def op5_token_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document as token ids in grammar-compressed shards, read back from the files."""
    folder = shared_path(spark, "token_shards")
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    repair.write_shards(docs, folder, vocabulary_path("word_bpe_49k.json"))
    return repair.crc32_of_ids(repair.read_documents(spark, folder))


_JACCARD = f"""
with recursive docs as (select row_number() over () as row, doc_id, {_words_sql('text')} as w from documents),
shingles as (
    select distinct row, doc_id, case when len(w) < 3 then array_to_string(w, ' ') else array_to_string(w[i: i + 2], ' ') end as shingle
    from docs, lateral (select unnest(range(1, greatest(len(w) - 1, 2))) as i) where len(w) > 0),
sizes as (select row, doc_id, count(*) as n, list_sort(list(shingle)) as all_shingles from shingles group by row, doc_id),
classes as (select all_shingles, n, min(doc_id) as head from sizes where doc_id is not null group by all_shingles, n),
members as (select head, n, unnest(all_shingles) as shingle from classes),
pairs as (
    select a.head as a, b.head as b from members a join members b using (shingle)
    where a.head < b.head group by a.head, b.head, a.n, b.n having 100 * count(*) >= 90 * (a.n + b.n - count(*))),
edges as (select a, b from pairs union select b, a from pairs),
reach(a, b) as (select a, b from edges union select r.a, e.b from reach r join edges e on r.b = e.a),
lowest as (select a as head, least(a, min(b)) as component from reach group by a)
select docs.doc_id, coalesce(sizes.n, 0) as n_shingles,
    case when docs.doc_id is not null then coalesce(component, classes.head, docs.doc_id) end as component_id
from docs left join sizes using (row) left join classes using (all_shingles) left join lowest using (head)
"""


@registered(_JACCARD)
def op6_jaccard_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The component of every document under Jaccard links of 0.9 between sets of three-word shingles."""
    return jaccard.component_ids(table(spark, sf_dir, "documents", "doc_id", "text"))


@registered()
def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document from its nearest labelled examples."""
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    scored = toxicity.score(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))
    return scored.select(
        "doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), "evidence"
    )


@registered()
def op8_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten nearest vectors of every hundredth row, by learned partitions."""
    return neighbours.search(table(spark, sf_dir, "embeddings"), "vec_id % 100 = 0")


@registered()
def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every document from learnt subword vectors."""
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    scored = quality.score(docs, quality.fit(docs, table(spark, sf_dir, "labels")))
    return scored.select(
        "doc_id", held_out().alias("held_out"), "score", (F.col("score") >= quality.CUT).cast("int").alias("predicted")
    )


@registered()
def op10_packed_sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document in sequences of at most 2048 tokens."""
    return packing.pack(table(spark, sf_dir, "documents", "doc_id", "text"), vocabulary_path("byte_bpe_50k.json"))


_COLLOCATIONS = f"""
with docs as (
    select row_number() over () as row, coalesce(lang, 'und') as lang,
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as body from documents),
pieces as (select row, lang, unnest(string_split_regex(body, '[.,;:!?\\x0A-\\x0D]')) as piece from docs),
worded as (select row_number() over () as p, lang, list_filter(string_split_regex(piece, '[\\x20\\x09]+'), lambda w: w <> '') as w from pieces),
grams as (
    select lang, k, array_to_string(w[i: i + k - 1], ' ') as phrase
    from worded, (select unnest(range(1, 5)) as k), lateral (select unnest(range(1, len(w) - k + 2)) as i)),
f as (select lang, k, phrase, count(*)::hugeint as f from grams group by all),
n as (select lang, sum(f)::bigint as n from f where k = 1 group by lang),
candidates as (select lang, k, phrase, f as a, string_split(phrase, ' ') as w from f where k > 1 and f >= {collocations.LEAST}),
cuts as (
    select c.lang, c.phrase, a, c.k, w, cut, l.f as l, r.f as r, ({collocations.SCALE}::hugeint * a) // (l.f + r.f) as score
    from (select *, unnest(range(1, k)) as cut from candidates) c
    join f l on l.lang = c.lang and l.phrase = array_to_string(w[:cut], ' ')
    join f r on r.lang = c.lang and r.phrase = array_to_string(w[cut + 1:], ' ')),
best as (select * from cuts qualify row_number() over (partition by lang, phrase order by score, cut) = 1),
inner_parts as (
    select lang, a as longer, array_to_string(w[i: i + s - 1], ' ') as phrase
    from (select *, unnest(range(2, k)) as s from candidates), lateral (select unnest(range(1, k - s + 2)) as i)),
around as (select lang, phrase, max(longer) as longer from inner_parts group by all),
kept as (
    select b.* from best b left join around o on o.lang = b.lang and o.phrase = b.phrase
    where o.longer is null or 100 * o.longer < {collocations.COVERED} * b.a),
ranked as (select *, row_number() over (partition by lang order by score desc, a desc, phrase collate c) as rank from kept)
select lang, rank, phrase, a::bigint as a, l::bigint as l, r::bigint as r, n, score::bigint as score
from ranked join n using (lang) where rank <= {collocations.MOST}
"""


@registered(_COLLOCATIONS)
def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 2,000 best phrases of each language."""
    return collocations.collocations(table(spark, sf_dir, "documents", "text", "lang"))


@registered()
def op12_languages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document by its code length in each language."""
    docs = table(spark, sf_dir, "documents", "doc_id", "text", "lang")
    found = languages.predict(docs, languages.fit(docs))
    return found.select("doc_id", languages.held_out().alias("held_out"), "lang_pred", "score")


@registered()
def op13_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The tokens of two tokenizers linked over every document."""
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    return alignment.align(docs, vocabulary_path("byte_bpe_50k.json"), vocabulary_path("piece_bpe_32k.model"))
