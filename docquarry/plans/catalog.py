"""The registered queries: name, Spark plan, and DuckDB SQL where one exists."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docquarry.config import ACT_COLUMNS, DEFAULTS, TEXT_CAP
from docquarry.operators import (
    clean,
    corpus,
    index,
    judgments,
    labels,
    profile,
    ranking_metrics,
    retrieve,
    search,
    svm,
    tagging_metrics,
    tfidf,
)
from docquarry.plans import fixtures
from docquarry.plans.oracles import chain, lemma_tokens
from docquarry.plans.pipeline import Stages, stages
from docquarry.session import join_hot, shared_folder, spread, store
from docquarry.sources import files, tables

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def registered(oracle: str | None = None):
    """Register a plan over the stages under its own name."""

    def add(plan: Callable[[Stages], DataFrame]):
        QUERIES[plan.__name__] = lambda spark, sf_dir: plan(stages(spark, sf_dir))
        if oracle is not None:
            ORACLES[plan.__name__] = chain(oracle)
        return plan

    return add


def rounded(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({name: F.round(name, 6) for name in columns})


def known_acts(s: Stages) -> DataFrame:
    return clean.blank_to_null(fixtures.raw_acts(s.spark, s.sf_dir), ACT_COLUMNS)


# --- cleaning ---


@registered("""
    select row_no, Act_type, Act_name, CELEX, act_raw_text, array_to_string(EUROVOC, '|') as tags from acts""")
def acts_clean(s: Stages) -> DataFrame:
    return s.acts().withColumn("tags", F.array_join("EUROVOC", "|")).drop("EUROVOC")


@registered("""
    select count(*) as rows_in, count(act_raw_text) as rows_kept,
           count(*) - count(act_raw_text) as rows_dropped from known_acts""")
def acts_dropped(s: Stages) -> DataFrame:
    return clean.dropped_counts(known_acts(s))


def partly_nameless_acts(s: Stages) -> DataFrame:
    """The acts, with the id taken from those that have no quality label."""
    known = known_acts(s)
    return clean.clean_acts(known.withColumn("CELEX", F.when(F.col("Act_name").isNotNull(), F.col("CELEX"))), carry=("row_no",))


@registered("""
    select count(*) as rows, count(*) filter (Act_name = '') as without_id,
           greatest(count(*) filter (Act_name = '') - 1, 0) as rows_lost from acts""")
def acts_without_id(s: Stages) -> DataFrame:
    return clean.missing_id_counts(partly_nameless_acts(s))


@registered("select case when Act_name = '' then 'row ' || row_no else CELEX end as doc_id, row_no, len(EUROVOC) as n_tags from acts")
def acts_kept_apart(s: Stages) -> DataFrame:
    acts = clean.with_own_ids(partly_nameless_acts(s), "row_no")
    apart = corpus.last_copy(acts, "CELEX", "row_no")
    return apart.select(F.col("CELEX").alias("doc_id"), "row_no", F.size("EUROVOC").alias("n_tags"))


@registered("""
    select row_no, unnest(EUROVOC) as tag, generate_subscripts(EUROVOC, 1) - 1 as pos from acts""")
def acts_tags(s: Stages) -> DataFrame:
    return s.acts().select("row_no", F.posexplode("EUROVOC").alias("pos", "tag"))


@registered("""
    select row_no, coalesce(CELEX, 'N/A') as id,
           case when length(act_raw_text) > 150 then substr(act_raw_text, 1, 150) || '...'
                else act_raw_text end as preview, EUROVOC as tags from raw_acts""")
def text_preview(s: Stages) -> DataFrame:
    return clean.preview_rows(fixtures.raw_acts(s.spark, s.sf_dir), carry=("row_no",))


@registered("""
    select row_no, length(act_raw_text) as n_chars, least(length(act_raw_text), 100000) as n_kept,
           length(act_raw_text) > 100000 as is_cut from known_acts where act_raw_text is not null""")
def text_cap(s: Stages) -> DataFrame:
    acts = known_acts(s).where(F.col("act_raw_text").isNotNull())
    return corpus.text_cap_report(acts, TEXT_CAP).select("row_no", "n_chars", "n_kept", "is_cut")


# --- text ---


@registered("""
    select doc_id, unnest(tokens) as token, generate_subscripts(tokens, 1) - 1 as pos from corpus""")
def tokens(s: Stages) -> DataFrame:
    acts = corpus.with_tokens(spread(s.acts(), "row_no"))
    # Outer, so that no test of the array, and with it the tokenizer, is pushed below the explosion.
    rows = acts.select(F.col("CELEX").alias("doc_id"), F.posexplode_outer("tokens").alias("pos", "token"))
    return rows.where("pos is not null")


@registered("select doc_id, array_to_string(tokens, ' ') as joined from corpus")
def tokens_joined(s: Stages) -> DataFrame:
    return s.corpus.select("doc_id", F.array_join("tokens", " ").alias("joined"))


@registered("select qid, unnest(tokens) as token, generate_subscripts(tokens, 1) - 1 as pos from queries")
def query_tokens(s: Stages) -> DataFrame:
    return s.queries().select("qid", F.posexplode_outer("tokens").alias("pos", "token")).where("pos is not null")


def lemmas(s: Stages) -> DataFrame:
    return s.once("lemmas", lambda: store(fixtures.lemma_table(s.acts()), "lemmas"))


@registered(lemma_tokens("doc_id", "act_raw_text", "last_acts", True))
def tokens_lemma(s: Stages) -> DataFrame:
    rows = corpus.build_corpus(s.acts(), "row_no", lemmas=lemmas(s))
    return rows.select("doc_id", F.posexplode_outer("tokens").alias("pos", "token")).where("pos is not null")


@registered(lemma_tokens("qid", "raw_query", "query_set", False))
def query_tokens_lemma(s: Stages) -> DataFrame:
    rows = corpus.with_query_tokens(fixtures.query_set(s.spark, s.sf_dir), lemmas=lemmas(s))
    return rows.select("qid", F.posexplode_outer("tokens").alias("pos", "token")).where("pos is not null")


@registered("select doc_id, array_to_string(tokens, ' ') as joined from corpus")
def corpus_saved(s: Stages) -> DataFrame:
    path = s.once("saved_corpus", lambda: written(s, "saved_corpus", lambda p: tables.save_corpus(s.corpus, p)))
    return tables.load_corpus(s.spark, path).select("doc_id", F.array_join("tokens", " ").alias("joined"))


# --- index ---


@registered("select doc_id, term, tf from postings")
def postings(s: Stages) -> DataFrame:
    return index.postings(s.corpus).select("doc_id", "term", "tf")


def dup_tokens(s: Stages) -> DataFrame:
    known = clean.blank_to_null(fixtures.raw_acts_dup(s.spark, s.sf_dir), ACT_COLUMNS)
    acts = corpus.with_tokens(spread(clean.clean_acts(known, carry=("row_no",)), "row_no"))
    return acts.select(F.col("CELEX").alias("doc_id"), "row_no", "tokens")


@registered("""
    select doc_id, term, arg_max(tf, row_no) as tf from (
      select doc_id, row_no, term, count(*) as tf
      from (select doc_id, row_no, unnest(tokens) as term from dup_tokens) group by all)
    group by doc_id, term""")
def postings_dup(s: Stages) -> DataFrame:
    return index.overwriting_postings(dup_tokens(s), "row_no")


@registered("select doc_id, arg_max(len(tokens), row_no) as length from dup_tokens group by doc_id")
def doc_lengths_dup(s: Stages) -> DataFrame:
    return index.overwriting_lengths(dup_tokens(s), "row_no")


@registered("""
    select count(*) as total_documents, sum(len(tokens))::bigint as total_length,
           round(avg(len(tokens)), 6) as avgdl from dup_tokens""")
def corpus_stats_dup(s: Stages) -> DataFrame:
    return index.corpus_stats(dup_tokens(s)).withColumn("avgdl", F.round("avgdl", 6))


@registered("select doc_id, length from lengths")
def doc_lengths(s: Stages) -> DataFrame:
    return index.doc_lengths(s.corpus)


@registered("""
    select n as total_documents, total::bigint as total_length, round(avgdl, 6) as avgdl from stats""")
def corpus_stats(s: Stages) -> DataFrame:
    return index.corpus_stats(s.corpus).withColumn("avgdl", F.round("avgdl", 6))


@registered("select count(*) as unique_terms from doc_freq")
def unique_terms(s: Stages) -> DataFrame:
    return index.unique_terms(index.doc_freq(s.index.postings))


@registered("select term, df from doc_freq")
def doc_freq(s: Stages) -> DataFrame:
    return index.doc_freq(s.index.postings)


# --- retrieval ---


@registered("select term, df, round(idf, 6) as idf from idf")
def bm25_idf(s: Stages) -> DataFrame:
    table = retrieve.idf_table(s.index.doc_freq, s.index.total_documents)
    return table.withColumn("idf", F.round("idf", 6))


@registered("""
    select distinct q.qid, p.doc_id from query_terms q join postings p on p.term = q.term""")
def union_retrieval(s: Stages) -> DataFrame:
    return retrieve.union_retrieval(s.query_terms, s.index)


@registered("select qid, doc_id, round(score, 6) as score from scores")
def bm25_scores(s: Stages) -> DataFrame:
    return retrieve.bm25_scores(s.query_terms, s.index).withColumn("score", F.round("score", 6))


@registered("""
    select * from (select qid, doc_id, round(score, 6) as score,
           row_number() over (partition by qid order by round(score, 9) desc, doc_id) as rank from scores)
    where rank <= 10""")
def bm25_topk(s: Stages) -> DataFrame:
    scores = retrieve.bm25_scores(s.query_terms, s.index)
    return retrieve.top_k(scores, 10).withColumn("score", F.round("score", 6))


def top_ten(scores: DataFrame) -> DataFrame:
    return retrieve.top_k(scores, 10).withColumn("score", F.round("score", 6))


_TOP_TEN = """
    select * from (select qid, doc_id, round(score, 6) as score,
           row_number() over (partition by qid order by round(score, 9) desc, doc_id) as rank from {scores})
    where rank <= 10"""


@registered(_TOP_TEN.format(scores="dup_scores"))
def bm25_topk_dup(s: Stages) -> DataFrame:
    # Stored, as postings, lengths and statistics each read the tokens.
    built = s.once("dup_index", lambda: index.build_index(store(dup_tokens(s), "dup_corpus"), "overwrite", "row_no"))
    return top_ten(retrieve.bm25_scores(retrieve.weighted_terms(s.queries(), built), built))


@registered(_TOP_TEN.format(scores="scores"))
def index_saved(s: Stages) -> DataFrame:
    path = s.once("saved_index", lambda: written(s, "saved_index", lambda p: tables.save_index(s.index, p)))
    loaded = s.once("loaded_index", lambda: tables.load_index(s.spark, path))
    return top_ten(retrieve.bm25_scores(retrieve.weighted_terms(s.queries(), loaded), loaded))


@registered("""
    select q.qid, count(u.doc_id) as total_hits from query_set q left join
      (select distinct t.qid, p.doc_id from query_terms t join postings p on p.term = t.term) u
      on u.qid = q.qid group by q.qid""")
def search_hits(s: Stages) -> DataFrame:
    return retrieve.hit_counts(s.queries(), retrieve.union_retrieval(s.query_terms, s.index))


# --- labels ---


@registered("select label, n from label_freq")
def label_freq(s: Stages) -> DataFrame:
    return labels.label_freq(s.corpus)


@registered("select label, n, rank from top_labels")
def top_labels(s: Stages) -> DataFrame:
    return labels.top_labels(s.corpus)


@registered("select doc_id, unnest(kept_tags) as label, generate_subscripts(kept_tags, 1) - 1 as pos from kept_tags")
def filtered_tags(s: Stages) -> DataFrame:
    return s.kept().select("doc_id", F.posexplode("kept_tags").alias("pos", "label"))


@registered("""
    select (select count(*) from corpus) as documents, count(*) as labelled_documents from kept_tags""")
def filtered_documents(s: Stages) -> DataFrame:
    kept = F.size(F.filter("tags", lambda tag: tag.isin(*s.label_names))) > 0
    return s.corpus.agg(
        F.count(F.lit(1)).alias("documents"), F.count(F.when(kept, True)).alias("labelled_documents")
    )


@registered("select p.doc_id, t.rank - 1 as target from kept_pairs p join top_labels t on t.label = p.label")
def binarized_labels(s: Stages) -> DataFrame:
    return s.kept().select("doc_id", F.explode("targets").alias("target"))


@registered("select doc_id, is_test from split")
def train_test_split(s: Stages) -> DataFrame:
    return s.kept().select("doc_id", "is_test")


@registered("""
    select doc_id, row_number() over (order by ('0x' || substr(md5(doc_id || '|42'), 1, 13))::bigint, doc_id)
           <= ceil((select count(*) from kept_tags) * 20 / 100.0) as is_test from kept_tags""")
def exact_split(s: Stages) -> DataFrame:
    return labels.with_exact_split(s.kept().select("doc_id")).select("doc_id", "is_test")


# --- tf-idf ---


@registered("select doc_id, gram, tf from gram_tf")
def ngrams(s: Stages) -> DataFrame:
    return tfidf.document_gram_counts(tfidf.with_grams(s.corpus))


@registered("select gram, idx, n, df from vocab")
def tfidf_vocab(s: Stages) -> DataFrame:
    counts = tfidf.gram_counts(tfidf.with_grams(s.kept().where("not is_test")))
    table = tfidf.vocabulary(store(counts, "gram_counts"), s.train_rows)
    return table.select("gram", "idx", "n", "df")


@registered("select gram, df, round(idf, 6) as idf from vocab")
def tfidf_idf(s: Stages) -> DataFrame:
    return s.tfidf.table.select("gram", "df", F.round("idf", 6).alias("idf"))


@registered("""
    select doc_id, gram, round(weight, 6) as weight from weights where doc_id in (select doc_id from train)""")
def tfidf_weights(s: Stages) -> DataFrame:
    vectors = s.vectors(s.kept().where("not is_test"))
    return tfidf.long_weights(vectors, s.tfidf).withColumn("weight", F.round("weight", 6))


@registered("select qid, gram, round(weight, 6) as weight from query_weights")
def tfidf_transform(s: Stages) -> DataFrame:
    vectors = search.query_vectors(s.queries(), s.tfidf)
    return tfidf.long_weights(vectors, s.tfidf, key="qid").withColumn("weight", F.round("weight", 6))


# --- classification ---


@registered("select doc_id, label, round(margin, 6) as margin from margins")
def svc_margin(s: Stages) -> DataFrame:
    return svm.long_margins(s.vectors(), s.tagger.model).withColumn("margin", F.round("margin", 6))


@registered("select doc_id, label, round(margin, 6) as margin from margins")
def tagger_saved(s: Stages) -> DataFrame:
    path = s.once("saved_tagger", lambda: written(s, "saved_tagger", lambda p: tables.save_tagger(s.tagger, p)))
    loaded = s.once("loaded_tagger", lambda: tables.load_tagger(s.spark, path))
    vectors = loaded.tfidf.transform(tfidf.with_grams(s.corpus))
    return svm.long_margins(vectors, loaded.model).withColumn("margin", F.round("margin", 6))


@registered("select label, doc_id from label_index")
def label_index(s: Stages) -> DataFrame:
    return s.tag_index.label_index()


@registered("""
    select count(*) as labels, round(avg(n), 6) as avg_docs, sum((n > 0)::int)::bigint as nonempty_labels
    from (select t.label, count(x.doc_id) as n from top_labels t left join label_index x on x.label = t.label
          group by t.label)""")
def label_index_stats(s: Stages) -> DataFrame:
    stats = labels.label_index_stats(s.label_vocabulary, s.tag_index.label_index())
    return stats.withColumn("avg_docs", F.round("avg_docs", 6))


@registered("select qid, label, row_number() over (partition by qid order by rank) - 1 as pos from query_labels")
def query_tags(s: Stages) -> DataFrame:
    tags = search.classify_queries(s.queries(), s.tagger)
    return tags.select("qid", F.posexplode_outer("labels").alias("pos", "label")).where("pos is not null")


@registered("select label, round(precision, 6) as precision, round(recall, 6) as recall, round(f1, 6) as f1, support from label_report")
def clf_report_labels(s: Stages) -> DataFrame:
    return rounded(tagging_metrics.label_report(s.cells, s.label_vocabulary), "precision", "recall", "f1")


@registered("""
    select average, round(precision, 6) as precision, round(recall, 6) as recall, round(f1, 6) as f1, support from (
      select 'micro' as average, sum(tp) / sum(tp + fp) as precision, sum(tp) / sum(tp + fn) as recall,
             2 * sum(tp) / (2 * sum(tp) + sum(fp) + sum(fn)) as f1, sum(tp + fn)::bigint as support from cells
      union all
      select 'macro', avg(precision), avg(recall), avg(f1), sum(support)::bigint from label_report
      union all
      select 'weighted', sum(precision * support) / sum(support), sum(recall * support) / sum(support),
             sum(f1 * support) / sum(support), sum(support)::bigint from label_report
      union all
      select 'samples', sum(case when tp + fp > 0 then tp / (tp + fp) else 0 end) / (select count(*) from test),
             sum(case when tp + fn > 0 then tp / (tp + fn) else 0 end) / (select count(*) from test),
             sum(2 * tp / (2 * tp + fp + fn)) / (select count(*) from test), sum(tp + fn)::bigint
      from doc_counts)""")
def clf_report_avgs(s: Stages) -> DataFrame:
    report = tagging_metrics.average_report(s.cells, s.label_vocabulary, s.test_rows)
    return rounded(report, "precision", "recall", "f1")


@registered("""
    select sum(fp + fn)::bigint as wrong_cells, any_value(n) as cells, round(sum(fp + fn) / any_value(n), 6) as hamming_loss
    from cells cross join (select (select count(*) from test) * (select count(*) from top_labels) as n)""")
def hamming_loss(s: Stages) -> DataFrame:
    loss = tagging_metrics.hamming_loss(s.cells, s.test_rows, len(s.label_names))
    return rounded(loss, "hamming_loss")


@registered()
def svc_fit(s: Stages) -> DataFrame:
    """Fitted models: no SQL, the solver is iterative; the tests compare it with a plain solver."""
    model, objective = s.fitted
    table = svm.coefficient_rows(model.to_table(s.spark), s.tfidf.table)
    norms = table.groupBy("label").agg(
        F.count(F.lit(1)).alias("nonzero"), F.round(F.sqrt(F.sum(F.col("coef") ** 2)), 3).alias("norm")
    )
    summary = s.spark.createDataFrame(
        [
            (label, float(round(b, 3)), float(round(value, 3)))
            for label, b, value in zip(model.labels, model.intercepts, objective)
        ],
        "label string, intercept double, objective double",
    )
    return summary.join(norms, "label", "left")


@registered("""
    select t.label, coalesce(nl, 0) as positives, (select count(*) from train) as rows,
           coalesce(nl, 0) > 0 and coalesce(nl, 0) < (select count(*) from train) as learnable
    from top_labels t left join label_sizes z on z.label = t.label""")
def svc_learnable(s: Stages) -> DataFrame:
    """Rows with each label, and whether the fit learnt it; labels with one class in training get a constant answer."""
    model, _ = s.fitted
    learnt = [(label, bool(abs(b) < float("inf"))) for label, b in zip(model.labels, model.intercepts)]
    learnt = F.broadcast(s.spark.createDataFrame(learnt, "label string, learnable boolean"))  # at most 100 labels
    sizes = s.kept_pairs(False).groupBy("label").agg(F.count(F.lit(1)).alias("positives"))
    return learnt.join(sizes, "label", "left").select(
        "label", F.coalesce("positives", F.lit(0)).alias("positives"), F.lit(s.train_rows).cast("long").alias("rows"), "learnable"
    )


# Labels whose sums a row takes part in at a time: with more columns Spark would not compile the sums.
TOGETHER = 32


@registered("""
    select label, true as converged from (select label, nl, (select count(*) from train) as n from label_sizes)
    where nl < n""")
def svc_optimality(s: Stages) -> DataFrame:
    """Whether the gradient at the fitted weights is within the fit's tolerance, in plain SQL terms.

    The gradient of ``0.5 (|w|^2 + b^2) + C sum(max(0, 1 - y m)^2)`` is recomputed from the tf-idf rows and
    the coefficient rows; at zero every row is short by 1, which gives the gradient to compare with.
    """
    model, _ = s.fitted
    coefs = store(svm.coefficient_rows(model.to_table(s.spark), s.tfidf.table), "coefficients")
    known = [(i, name, float(b)) for i, (name, b) in enumerate(zip(model.labels, model.intercepts)) if abs(b) < float("inf")]
    found = s.spark.createDataFrame([], "label string, converged boolean")
    for start in range(0, len(known), TOGETHER):
        found = found.unionByName(optimal_labels(s, coefs, known[start: start + TOGETHER]))
    return found


def optimal_labels(s: Stages, coefs: DataFrame, known: list[tuple[int, str, float]]) -> DataFrame:
    """``(label, converged)`` of the labels ``(place, label, intercept)``.

    Each label is a column, so that a tf-idf row stays one row for all of them, and what the rows of a document share
    is joined before they are taken apart.
    """
    one, c, spots = [F.col("label") == name for _, name, _ in known], -2 * DEFAULTS.svc_c, range(len(known))
    wide = coefs.groupBy("gram").agg(*[F.sum(F.when(is_it, F.col("coef")).otherwise(0.0)).alias(f"c{i}") for i, is_it in enumerate(one)])
    wide = store(wide, "wide_coefficients")
    weights = join_hot(tfidf.long_weights(s.training_table, s.tfidf), wide, "gram", "doc_id", DEFAULTS.broadcast_rows)
    sums = weights.groupBy("doc_id").agg(*[F.sum(F.col("weight") * F.col(f"c{i}")).alias(f"m{i}") for i in spots])
    signs = [F.when(F.array_contains("targets", place), 1.0).otherwise(-1.0) for place, _, _ in known]
    held = s.training_table.select("doc_id", F.array(*signs).alias("y")).join(sums, "doc_id", "left")
    short = [F.greatest(F.lit(0.0), 1 - F.col("y")[i] * (F.coalesce(f"m{i}", F.lit(0.0)) + b)) for i, (_, _, b) in enumerate(known)]
    pulls = held.select("doc_id", "y", F.array(*[c * F.col("y")[i] * short[i] for i in spots]).alias("pull"))
    pulls = store(pulls, "pulls")
    rows = s.training_table.join(pulls, "doc_id").select(F.struct("doc_id", "y", "pull").alias("held"), "indices", "values")
    slopes = tfidf.long_weights(rows, s.tfidf, key="held").groupBy("gram").agg(
        *[F.sum(F.col("weight") * F.col("held.pull")[i]).alias(f"g{i}") for i in spots],
        *[F.sum(F.col("weight") * c * F.col("held.y")[i]).alias(f"h{i}") for i in spots],
    )
    slopes = slopes.join(wide, "gram", "left").agg(
        *[F.sum((F.col(f"g{i}") + F.coalesce(f"c{i}", F.lit(0.0))) ** 2).alias(f"g{i}") for i in spots],
        *[F.sum(F.col(f"h{i}") ** 2).alias(f"h{i}") for i in spots],
    )
    ends = pulls.agg(
        F.count(F.lit(1)).alias("n"),
        *[((F.sum(F.col("pull")[i]) + b) ** 2).alias(f"e{i}") for i, (_, _, b) in enumerate(known)],
        *[F.sum(F.col("y")[i]).alias(f"y{i}") for i in spots],
    )

    def within(i: int):
        steep, start = F.col(f"g{i}") + F.col(f"e{i}"), F.col(f"h{i}") + (c * F.col(f"y{i}")) ** 2
        rarer = (F.col("n") - F.abs(f"y{i}")) / 2 / F.col("n")
        return F.sqrt(steep) <= 1.001e-4 * rarer * F.sqrt(start)

    checked = [F.struct(F.lit(name).alias("label"), within(i).alias("converged")) for i, (_, name, _) in enumerate(known)]
    # Both sides have one row.
    return slopes.crossJoin(ends).select(F.inline(F.array(*checked))).where("converged is not null")


@registered()
def svc_report(s: Stages) -> DataFrame:
    """Held-out report of the fitted models."""
    return tagging_metrics.average_report(
        s.once("fitted_cells", lambda: s.outcomes(s.fitted_tag_index)), s.label_vocabulary, s.test_rows
    )


# --- label retrieval and whole searches ---


@registered("select qid, doc_id from tag_docs")
def label_union(s: Stages) -> DataFrame:
    chosen = search.choose_methods(
        s.queries(), search.classify_queries(s.queries(), s.tagger), s.tag_index, s.label_names
    )
    wanted = chosen.select("qid", F.explode("tags").alias("label"))
    return retrieve.label_documents(wanted, s.tag_index.label_index())


def target_labels(s: Stages) -> DataFrame:
    target = search.matched_target(F.col("target_label"), s.label_names)
    return s.queries().select("qid", target.alias("label")).where("label is not null")


@registered("select t.qid, x.doc_id from targets t join label_index x on x.label = t.label")
def label_target(s: Stages) -> DataFrame:
    return retrieve.label_documents(target_labels(s), s.tag_index.label_index())


@registered("""
    select t.qid, x.doc_id, round(coalesce(s.score, 0.0), 6) as score from targets t
    join label_index x on x.label = t.label left join scores s on s.qid = t.qid and s.doc_id = x.doc_id""")
def bm25_label_restricted(s: Stages) -> DataFrame:
    scores = retrieve.bm25_scores(s.query_terms, s.index)
    return rounded(retrieve.restricted_scores(target_labels(s), s.tag_index.doc_labels, scores), "score")


@registered("""
    select m.qid, m.method, array_to_string(m.tokens, ' ') as tokens,
           coalesce((select string_agg(label, '|' order by rank) from query_label_set l where l.qid = m.qid), '') as tags,
           (select count(*) from candidates c where c.qid = m.qid) as total_hits,
           r.rank, r.doc_id, round(r.score, 6) as score
    from methods m left join (select * from ranked where rank <= 10) r on r.qid = m.qid""")
def search_batch(s: Stages) -> DataFrame:
    found = search.search(s.queries(), s.index, s.tag_index, s.tagger, k=10)
    flat = found.withColumns({"tokens": F.array_join("tokens", " "), "tags": F.array_join("tags", "|")})
    return rounded(flat, "score")


# --- judgments and ranking metrics ---


@registered("select source_id, doc_id from ids")
def id_map_clean(s: Stages) -> DataFrame:
    return judgments.clean_id_map(fixtures.id_map(s.spark, s.sf_dir), "row_no")


@registered("select line_no, label, source_id, rel from judged")
def qrels_parsed(s: Stages) -> DataFrame:
    return s.parsed_judgments().withColumn("rel", F.col("rel").cast("int"))


@registered("select qid, doc_id, rel from final_judged")
def qrels_filtered(s: Stages) -> DataFrame:
    return judgments.final_judgments(s.mapped_judgments, "line_no")


@registered("""
    select count(*) as skipped from judged where lower(replace(label, '_', ' ')) not in
      (select lower(replace(label, '_', ' ')) from top_labels)""")
def qrels_skipped(s: Stages) -> DataFrame:
    return judgments.skipped_judgments(s.parsed_judgments(), s.label_vocabulary)


@registered("select qid, first_seen from eval_set order by first_seen, qid limit 500")
def eval_queries(s: Stages) -> DataFrame:
    return s.evaluation_queries(500)


@registered("select qid, doc_id, round(score, 6) as score, rank from eval_ranked")
def eval_run(s: Stages) -> DataFrame:
    return rounded(s.evaluation_run, "score")


RANKING_METRICS = (
    "map", "mrr", "ndcg_10", "precision_10", "recall_10", "f1_10",
    "ndcg_20", "precision_20", "recall_20", "f1_20",
)


def ranking_report(s: Stages) -> DataFrame:
    return ranking_metrics.query_metrics(s.evaluation_run, s.evaluation_judgments)


@registered("select qid, " + ", ".join(f"round({m}, 6) as {m}" for m in RANKING_METRICS) + " from per_query")
def ir_metrics_by_query(s: Stages) -> DataFrame:
    return rounded(ranking_report(s), *RANKING_METRICS)


@registered("select 'queries' as metric, count(*)::double as value from per_query" + "".join(
    f" union all select '{m}', round(avg({m}), 6) from per_query" for m in RANKING_METRICS))
def ir_metrics(s: Stages) -> DataFrame:
    return rounded(ranking_metrics.mean_metrics(ranking_report(s)), "value")


# --- file sources: the fixtures written as files in the shared folder and read back ---


def written(s: Stages, name: str, write) -> str:
    """A fresh path in the shared folder, filled by ``write``."""
    path = f"{shared_folder(s.spark)}/docquarry/{name}_{uuid.uuid4().hex[:12]}"
    write(path)
    return path


def csv_path(s: Stages, df: DataFrame, name: str) -> str:
    return written(
        s, name, lambda path: df.write.option("header", True).option("quoteAll", True).option("escape", '"').csv(path)
    )


@registered("""
    select Act_type, Act_name, CELEX, act_raw_text, array_to_string(EUROVOC, '|') as tags from acts""")
def acts_from_csv(s: Stages) -> DataFrame:
    path = s.once("acts_csv", lambda: csv_path(s, fixtures.raw_acts(s.spark, s.sf_dir), "acts_csv"))
    acts = clean.clean_acts(files.read_acts(s.spark, path))
    return acts.withColumn("tags", F.array_join("EUROVOC", "|")).drop("EUROVOC")


def wide_csv(s: Stages) -> str:
    return s.once("wide_csv", lambda: csv_path(s, fixtures.wide_acts(s.spark, s.sf_dir).orderBy("row_no"), "wide_csv"))


@registered("select row_no, " + ", ".join(f"nullif({name}, '') as {name}" for name in ("Act_type", "CELEX"))
            + ", length(case when act_raw_text in ('NA', 'n/a', '') then null else act_raw_text end) as n_text, "
            + "n_chars, quality::bigint as quality, toxic::bigint as toxic from wide_acts")
def wide_acts_from_csv(s: Stages) -> DataFrame:
    """All columns of a CSV, their types inferred, as written but for missing values."""
    wide = files.read_wide_acts(s.spark, wide_csv(s), ("CELEX",))
    return wide.select("row_no", "Act_type", "CELEX", F.length("act_raw_text").alias("n_text"), "n_chars", "quality", "toxic")


@registered("select row_no::varchar as row_no, Act_type, CELEX from wide_acts order by wide_acts.row_no limit 5")
def acts_head(s: Stages) -> DataFrame:
    """The first rows of a CSV, all columns as strings."""
    first = min(s.spark.read.text(wide_csv(s)).inputFiles())
    return files.read_head(s.spark, first).select("row_no", "Act_type", "CELEX")


@registered("select source_id, doc_id from ids")
def id_map_from_csv(s: Stages) -> DataFrame:
    rows = fixtures.id_map(s.spark, s.sf_dir).orderBy("row_no").drop("row_no")
    path = s.once("id_map_csv", lambda: csv_path(s, rows, "id_map_csv"))
    return judgments.clean_id_map(files.read_id_map(s.spark, path), "row_order")


@registered("select qid, doc_id, rel from final_judged")
def qrels_from_text(s: Stages) -> DataFrame:
    lines = fixtures.judgment_lines(s.spark, s.sf_dir).orderBy("line_no").select("line")
    path = s.once("judgment_text", lambda: written(s, "judgment_text", lines.write.text))
    parsed = judgments.parse_judgments(files.read_judgment_lines(s.spark, path), "row_order")
    kept = judgments.vocabulary_judgments(parsed, s.label_vocabulary)
    ids = judgments.clean_id_map(fixtures.id_map(s.spark, s.sf_dir), "row_no")
    return judgments.final_judgments(judgments.mapped_judgments(kept, ids), "row_order")


# --- data inspection ---

WIDE_TYPES = {
    "row_no": "bigint", "Act_type": "string", "Act_name": "string", "CELEX": "string",
    "act_raw_text": "string", "EUROVOC": "string", "n_chars": "bigint", "quality": "int", "toxic": "int",
}


@registered(" union all ".join(
    f"select '{name}' as column_name, '{kind}' as type, count(*) as rows, count({name}) as non_null from wide_acts"
    for name, kind in WIDE_TYPES.items()))
def profile_nulls(s: Stages) -> DataFrame:
    return profile.null_profile(fixtures.wide_acts(s.spark, s.sf_dir))


@registered(" union all ".join(
    f"""select '{name}' as column_name, count({name}) as count, round(avg({name}), 6) as mean,
        round(stddev_samp({name}), 6) as std, min({name})::double as min,
        round(quantile_cont({name}::double, 0.25), 6) as q25, round(quantile_cont({name}::double, 0.5), 6) as q50,
        round(quantile_cont({name}::double, 0.75), 6) as q75, max({name})::double as max from wide_acts"""
    for name, kind in WIDE_TYPES.items() if kind != "string"))
def profile_describe(s: Stages) -> DataFrame:
    summary = profile.describe_numbers(fixtures.wide_acts(s.spark, s.sf_dir))
    return rounded(summary, "mean", "std", "q25", "q50", "q75")


@registered("select * from wide_acts order by row_no limit 5")
def profile_head(s: Stages) -> DataFrame:
    return profile.first_rows(fixtures.wide_acts(s.spark, s.sf_dir), "row_no")


@registered(" union all ".join(
    f"select {place} as position, '{name}' as column_name, '{kind}' as type where exists (from wide_acts)"
    for place, (name, kind) in enumerate(WIDE_TYPES.items())))
def column_listing(s: Stages) -> DataFrame:
    return profile.column_types(fixtures.wide_acts(s.spark, s.sf_dir))


@registered("select count(*) as rows, true as both_sides from kept_tags")
def random_split_counts(s: Stages) -> DataFrame:
    """A seeded random split keeps every row on one side and puts about a fifth into the test."""
    train, test = labels.random_split(s.kept())
    sides = train.select(F.lit(0).alias("side")).unionByName(test.select(F.lit(1).alias("side")))
    share = F.avg("side")
    return sides.agg(F.count(F.lit(1)).alias("rows"), share.between(0.05, 0.4).alias("both_sides"))
