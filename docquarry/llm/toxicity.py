"""Toxicity from the nearest labelled examples by exact TF-IDF cosine.

Terms are words and the beginnings of words. Every term of the examples counts, however rare, so their texts
bound the index; how many documents of the whole corpus hold each term gives its weight. Terms that no example
holds meet nothing and have no weight.

The examples lie in blocks of an inverted index. Postings of terms that one example in ``DENSE`` holds are full
columns, and a product of matrices adds them up for all documents of a step at once. All other terms have short
postings, with their largest weight in every block that holds them. For a document the column sums and these
maxima bound the cosine of every example in a block; only blocks whose bound reaches the ``NEIGHBOURS``-th
largest cosine known so far are scored, or all where most blocks do. What rare terms add is double precision;
for examples near the last cosine that stays so is what dense terms add. Texts of a step that are equal are
searched once. Terms are found by 64-bit hashes.

The nearest examples vote with the square of the cosine, weighed by how many labelled rows an example stands
for, and a small share of the base rate keeps scores of distant documents low. Votes are calibrated: examples
are scored without themselves, and a logistic curve over their votes gives the chance of label 1. The nearest
examples are returned as evidence.

At most ``EXAMPLES`` rows of each class, of texts of at most ``EXAMPLE_BYTES``, are examples, the first by a
hash of the id. That is the only bound; document counts and scores cover every row and whole texts.

Defined results: null and empty texts and texts without a known term get the base rate of such examples, and
no evidence. Equal cosines go to the smaller example id. Without labels of both classes every score is the
share of label 1, or 0.5. Null ids are scored, never learnt from; repeated rows are scored each. Other
columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docquarry.llm.common import column, labelled_sample, learnable, release, steps
from docquarry.llm.shingles import Spans

EXAMPLES = 3000
EXAMPLE_BYTES = 1 << 16
PREFIXES = (4, 5, 6)
NEIGHBOURS = 30
BLOCK = 64
# Terms that at least one example in so many holds are full columns.
DENSE = 32
EVIDENCE = 3
PRIOR = 0.2
# Examples of each class that the calibration scores without themselves.
CALIBRATING = 700
# More than the rounding of sums in single precision.
SLACK = 1e-4
# Bytes of text whose words are looked up at once.
PORTION = 4 << 20
_MARKS = ".,;:!?\"'()[]{}<>*&%$#|-_/"
_OTHER, _BLANK, _MARK = 0, 1, 2
_KIND = np.zeros(256, np.uint8)
_KIND[list(b" \t\n\x0b\x0c\r")] = _BLANK
_KIND[list(_MARKS.encode())] = _MARK


def terms_of(word: str) -> list[str]:
    """The word and its beginnings, without the marks around it."""
    bare = word.strip(_MARKS)
    return [bare, *(bare[:n] + "~" for n in PREFIXES if len(bare) > n)] if bare else []


def spans_of(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The bytes of all lower-cased texts, where each word without the marks around it begins and ends, and the text it is in."""
    lowered = [(t or "").lower().encode() for t in texts]
    raw = np.frombuffer(b"\n".join([*lowered, b""]), np.uint8)
    kind = _KIND[raw]
    inside = kind != _BLANK
    edges = np.flatnonzero(inside[1:] != inside[:-1]) + 1
    if len(raw) and inside[0]:
        edges = np.concatenate([[0], edges])
    begin, end = edges[0::2].copy(), edges[1::2].copy()
    for move, ends in ((begin, False), (end, True)):
        live = np.arange(len(begin))
        while len(live := live[(begin[live] < end[live]) & (kind[move[live] - ends] == _MARK)]):
            move[live] += -1 if ends else 1
    kept = begin < end
    begin, end = begin[kept], end[kept]
    starts = np.cumsum([0, *(len(t) + 1 for t in lowered)])
    return raw, begin, end, np.searchsorted(starts, begin, "right") - 1


def words_of(text: str | None) -> set[bytes]:
    """The words of a lower-cased text, without the marks around them."""
    raw, begin, end, _ = spans_of([text])
    whole = raw.tobytes()
    return {whole[i:j] for i, j in zip(begin.tolist(), end.tolist())}


class Terms:
    """Finds the numbers of the terms that count by 64-bit hashes, in buckets of about one hash in two."""

    def __init__(self, number: dict[str, int]) -> None:
        names = [term.encode() for term in number]
        ends = np.cumsum([len(n) for n in names], dtype=np.int64)
        begin = ends - np.array([len(n) for n in names], np.int64)
        hashes = Spans(np.frombuffer(b"".join(names), np.uint8)).hashes(begin, ends)
        order = np.argsort(hashes)
        self.size = len(names)
        self.hashes, self.numbers = hashes[order], np.fromiter(number.values(), np.int32, len(names))[order]
        self.shift = np.uint64(63 - max(1, len(names)).bit_length())
        counts = np.bincount((self.hashes >> self.shift).astype(np.int64), minlength=1 << (64 - int(self.shift)))
        self.first = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """The number of the term with each hash, or -1."""
        found = np.full(len(hashes), -1, np.int32)
        bucket = (hashes >> self.shift).astype(np.int64)
        at, last = self.first[bucket], self.first[bucket + 1]
        live = np.flatnonzero(at < last)
        while len(live):
            place = at[live]
            equal = self.hashes[place] == hashes[live]
            found[live[equal]] = self.numbers[place[equal]]
            live = live[~equal]
            at[live] += 1
            live = live[at[live] < last[live]]
        return found

    def counts(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The distinct terms of each text in a row, ascending; how often each occurs; and where each text ends."""
        raw, begin, end, of = spans_of(texts)
        width, keys = max(self.size, 1), []
        # Long texts in portions, as sums over bytes take eight times their room.
        cuts = np.searchsorted(begin, np.arange(PORTION, len(raw) + PORTION, PORTION))
        for low, high in zip([0, *cuts[:-1].tolist()], cuts.tolist()):
            if low < high:
                first, text = int(begin[low]), of[low:high]
                keys += self._keys(raw[first: int(end[high - 1])], begin[low:high] - first, end[low:high] - first, text * width)
        key, counts = np.unique(np.concatenate([*keys, np.empty(0, np.int64)]), return_counts=True)
        return key % width, counts, np.searchsorted(key // width, np.arange(len(texts)), "right")

    def _keys(self, raw: np.ndarray, begin: np.ndarray, end: np.ndarray, row: np.ndarray) -> Iterator[np.ndarray]:
        """For every known term of every word its number, added to the word's ``row``."""
        spans = Spans(raw)
        # Where the characters begin, as beginnings of words have whole ones.
        lead = (raw & 0xC0) != 0x80
        ascii = bool(lead.all())
        places = None if ascii else np.append(np.flatnonzero(lead), [len(raw)] * max(PREFIXES))
        rank = begin if ascii else (np.cumsum(lead) - 1)[begin]
        for size in (0, *PREFIXES):
            if size:
                stop = begin + size if ascii else places[rank + size]
                longer = np.flatnonzero(stop < end)
                found, of = self.find(spans.hashes(begin[longer], stop[longer], b"~")), row[longer]
            else:
                found, of = self.find(spans.hashes(begin, end)), row
            known = found >= 0
            yield of[known] + found[known]


class Index(NamedTuple):
    """``columns``: example x dense term. Other postings by term, then block: a cell is a term in a block that holds it;
    term ``t`` has the cells from ``cells[t]`` on, cell ``c`` the postings from ``starts[c]`` on. All weights of
    example ``e`` are those from ``ends[e - 1]`` on, those of its dense terms from ``dense_ends[e - 1]`` on."""

    number: dict[str, int]
    idf: np.ndarray
    ids: np.ndarray
    labels: np.ndarray
    stands_for: np.ndarray
    dense: np.ndarray  # the column of each term, or -1
    columns: np.ndarray
    cells: np.ndarray
    blocks: np.ndarray  # the block of each cell
    most: np.ndarray  # the largest weight of each cell
    starts: np.ndarray
    examples: np.ndarray
    weights: np.ndarray
    ends: np.ndarray
    terms: np.ndarray
    all_weights: np.ndarray
    dense_ends: np.ndarray
    dense_terms: np.ndarray  # the column of each weight
    dense_weights: np.ndarray
    base: float
    slope: float = 1.0
    offset: float = 0.0


def choose_terms(texts: list[str], labels: list[int], most: int | None = None, least: int = 1) -> dict[str, int]:
    """All terms, by chi-squared of their occurrence against the label; ties go to the smaller term."""
    counts = (Counter(), Counter())
    for text, label in zip(texts, labels):
        counts[label].update({term for word in words_of(text) for term in terms_of(word.decode())})
    share = sum(labels) / len(labels)

    def weight(zeros: int, ones: int) -> float:
        expected = (zeros + ones) * share
        return (ones - expected) ** 2 / expected + (expected - ones) ** 2 / (zeros + ones - expected)

    held = ((term, counts[0][term], counts[1][term]) for term in counts[0] | counts[1])
    ranked = sorted((-weight(zeros, ones), term) for term, zeros, ones in held if zeros + ones >= least)
    return {term: i for i, (_, term) in enumerate(ranked[:most])}


def document_counts(docs: DataFrame, number: dict[str, int], text: str = "text") -> tuple[np.ndarray, int]:
    """In how many of all documents each term occurs, and how many documents there are."""
    rows = docs.select(F.col(text).cast("string").alias("text"))
    known = docs.sparkSession.sparkContext.broadcast(Terms(number))

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms, sums = known.value, np.zeros(known.value.size + 1, np.int64)
        for batch in steps(batches):
            sums[-1] += batch.num_rows
            sums[:-1] += np.bincount(terms.counts(column(batch, "text").to_pylist())[0], minlength=len(sums) - 1)
        yield pa.record_batch([pa.array(np.arange(len(sums))), pa.array(sums)], ["term", "n"])
        release()

    found = rows.mapInArrow(counted, "term long, n long").where("n > 0").groupBy("term").agg(F.sum("n").alias("n"))
    counts = np.zeros(len(number) + 1, np.int64)
    sums = found.toArrow()  # one row per term of the examples
    counts[sums["term"].to_numpy()] = sums["n"].to_numpy()
    return counts[:-1], int(counts[-1])


def weighted(terms: np.ndarray, counts: np.ndarray, ends: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """TF-IDF weights, of unit length in each text."""
    weights = (1 + np.log(counts)) * idf[terms]
    row = np.repeat(np.arange(len(ends)), np.diff(ends, prepend=0))
    return weights / np.sqrt(np.bincount(row, weights * weights, len(ends)))[row]


def build(
    ids: list[int], texts: list[str], labels: list[int], shares: dict[int, int], number: dict[str, int], df: np.ndarray, n_docs: int,
    dense_share: int = DENSE,
) -> Index:
    """The index of the examples. ``shares``: how many labelled rows each class has."""
    idf = np.log((1 + n_docs) / (1 + df)) + 1
    terms = Terms(number)
    rows = []
    for i in range(0, len(texts), 200):
        present, counts, ends = terms.counts(texts[i: i + 200])
        weights = weighted(present, counts, ends, idf)
        rows += list(zip(np.split(present, ends[:-1]), np.split(weights, ends[:-1])))
    marks = np.array(labels)
    stands = np.array([shares[c] / max(1, labels.count(c)) for c in (0, 1)])[marks]
    # Examples with the same strongest term, of those that a tenth of them hold, lie together, so a block's maxima
    # are close to its members.
    held = np.bincount(np.concatenate([*(present for present, _ in rows), np.empty(0, np.int64)]), minlength=len(number))
    common = held * 10 >= len(rows)

    def place(i: int) -> tuple[int, int]:
        present, weights = rows[i]
        strong = np.where(common[present], weights, 0)
        return int(present[strong.argmax()]) if strong.any() else len(number), ids[i]

    order = sorted((i for i, (present, _) in enumerate(rows) if len(present)), key=place)
    without = np.array([i for i, (present, _) in enumerate(rows) if not len(present)], np.int64)
    rate = float((marks * stands).sum() / stands.sum())
    # The base rate, from the examples without a term; ten rows at the overall rate steady it.
    base = float(((marks * stands)[without].sum() + 10 * rate) / (stands[without].sum() + 10))
    order_at = np.array(order, np.int64)
    sizes = [len(rows[i][0]) for i in order]
    example = np.repeat(np.arange(len(order)), sizes)
    term = np.concatenate([*(rows[i][0] for i in order), np.empty(0, np.int64)])
    weight = np.concatenate([*(rows[i][1] for i in order), np.empty(0)])
    n_blocks = -(-len(order) // BLOCK)
    ends, all_terms, all_weights = np.cumsum(sizes).astype(np.int64), term, weight
    dense = np.full(len(number), -1)
    full = np.flatnonzero((held * dense_share >= len(rows)) & (held > 0))
    dense[full] = np.arange(len(full))
    in_column = dense[term] >= 0
    dense_ends = np.cumsum(np.bincount(example[in_column], minlength=len(order)))
    dense_terms, dense_weights = dense[term[in_column]].astype(np.int32), weight[in_column]
    term, example, weight = term[~in_column], example[~in_column], weight[~in_column]
    placed = np.lexsort((example, term))
    term, example, weight = term[placed], example[placed], weight[placed]
    cell = term * n_blocks + example // BLOCK
    begin = np.flatnonzero(np.diff(cell, prepend=-1))
    most = np.maximum.reduceat(weight, begin) if len(begin) else np.empty(0)
    cells = np.searchsorted(term[begin], np.arange(len(number) + 1))
    index = Index(
        number, idf, np.array(ids, np.int64)[order_at], marks[order_at], stands[order_at], dense, None, cells,
        (cell[begin] % max(1, n_blocks)).astype(np.int32), most, np.append(begin, len(cell)), example.astype(np.int32), weight,
        ends, all_terms, all_weights, dense_ends, dense_terms, dense_weights, base,
    )
    return index._replace(columns=columns_of(index))


def columns_of(index: Index) -> np.ndarray:
    """The full columns, from the weights of dense terms; tasks make them anew instead of being sent them."""
    columns = np.zeros((len(index.ids), int(index.dense.max(initial=-1)) + 1), np.float32)
    columns[np.repeat(np.arange(len(index.ids)), np.diff(index.dense_ends, prepend=0)), index.dense_terms] = index.dense_weights
    return columns


def _runs(begin: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The places of runs one after the other."""
    ends = np.cumsum(sizes)
    at = np.repeat(begin - (ends - sizes), sizes)
    at += np.arange(len(at))
    return at


def column_sums(index: Index, terms: np.ndarray, weights: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Text x example: the part of the cosine that dense terms make, in single precision."""
    asked = np.zeros((len(ends), index.columns.shape[1]), np.float32)
    row = np.repeat(np.arange(len(ends)), np.diff(ends, prepend=0))
    column_of = index.dense[terms]
    held = column_of >= 0
    asked[row[held], column_of[held]] = weights[held]
    return asked @ index.columns.T


def nearest(
    index: Index, terms: np.ndarray, weights: np.ndarray, sums: np.ndarray, k: int = NEIGHBOURS, without: int = -1
) -> tuple[np.ndarray, np.ndarray]:
    """The ``k`` examples of the largest cosine and the cosines; only those above 0. ``sums``: the text's row of ``column_sums``.

    ``without`` is an example that takes no part.
    """
    n, n_blocks = len(index.ids), -(-len(index.ids) // BLOCK)
    column_of = index.dense[terms]
    rare = column_of < 0
    of_rare, weight_of = terms[rare], weights[rare]
    first, last = index.cells[of_rare], index.cells[of_rare + 1]
    cells, weight_in = _runs(first, last - first), np.repeat(weight_of, last - first)
    block_of = index.blocks[cells]
    bounds = np.maximum.reduceat(sums, np.arange(0, n, BLOCK)) + np.bincount(block_of, weight_in * index.most[cells], n_blocks)
    # Rare terms only add, so the k-th largest sum so far is a bound from below.
    kept = min(k + (without >= 0), n)
    least = float(np.partition(sums, n - kept)[n - kept])
    ready = (bounds >= max(least, 0.0) - SLACK)[block_of]
    if 2 * np.count_nonzero(ready) < len(cells):
        cells, weight_of = cells[ready], weight_in[ready]
        begin, end = index.starts[cells], index.starts[cells + 1]
    else:  # whole postings are read faster than their parts
        begin, end = index.starts[first], index.starts[last]
    at = _runs(begin, end - begin)
    added = np.bincount(index.examples[at], np.repeat(weight_of, end - begin) * index.weights[at], n)
    scores = sums + added
    if without >= 0:
        scores[without] = -1.0
    # Only scored blocks can hold the nearest; the dense terms of those near the last place are added up again.
    least = float(np.partition(scores, n - min(k, n))[n - min(k, n)])
    near = np.flatnonzero(scores >= max(least - 2 * SLACK, 0.0))
    near = near[near != without]
    full = np.zeros(index.columns.shape[1])
    full[column_of[~rare]] = weights[~rare]
    ends = index.dense_ends[near].tolist()
    own = [slice(begin, end) for begin, end in zip((index.dense_ends[near - 1] * (near > 0)).tolist(), ends)]
    exact = added[near] + [full[index.dense_terms[o]] @ index.dense_weights[o] for o in own]
    best = np.lexsort((index.ids[near], -exact.round(12)))
    best = best[exact[best] > 1e-12][:k]
    return near[best], exact[best]


def vote(index: Index, best: np.ndarray, cosines: np.ndarray) -> float:
    votes = cosines**2 * index.stands_for[best] / index.stands_for.mean() if len(best) else cosines
    return float(((votes * index.labels[best]).sum() + PRIOR * index.base) / (votes.sum() + PRIOR))


def calibrated(index: Index, raw: np.ndarray) -> np.ndarray:
    """The chance of label 1 for these votes."""
    odds = np.log(np.clip(raw, 1e-6, 1 - 1e-6)) - np.log1p(-np.clip(raw, 1e-6, 1 - 1e-6))
    return 1 / (1 + np.exp(-np.clip(index.slope * odds + index.offset, -30, 30)))


def calibrate(index: Index, most: int = CALIBRATING) -> Index:
    """The curve over the votes for examples that are scored without themselves; at most ``most`` of each class."""
    chosen = np.concatenate([np.flatnonzero(index.labels == c)[:: max(1, int((index.labels == c).sum()) // most)][:most] for c in (0, 1)])
    raw = np.empty(len(chosen))
    for first in range(0, len(chosen), 200):
        part = chosen[first: first + 200]
        begin = np.concatenate([[0], index.ends])[part]
        sizes = index.ends[part] - begin
        at, ends = _runs(begin, sizes), np.cumsum(sizes)
        terms, weights = index.terms[at], index.all_weights[at]
        sums = column_sums(index, terms, weights, ends)
        for i, (example, low, high) in enumerate(zip(part.tolist(), (ends - sizes).tolist(), ends.tolist())):
            raw[first + i] = vote(index, *nearest(index, terms[low:high], weights[low:high], sums[i], without=example))
    odds = np.log(np.clip(raw, 1e-6, 1 - 1e-6)) - np.log1p(-np.clip(raw, 1e-6, 1 - 1e-6))
    marks = index.labels[chosen]
    # A class weighs what it weighs among all labelled rows.
    weight = np.array([index.stands_for[index.labels == c].sum() / max(1, (marks == c).sum()) for c in (0, 1)])[marks]
    weight /= weight.mean()
    x, point = np.stack([odds, np.ones(len(odds))], 1), np.array([1.0, 0.0])
    for _ in range(30):  # Newton steps, drawn a little towards the uncalibrated vote
        chance = 1 / (1 + np.exp(-np.clip(x @ point, -30, 30)))
        slope = x.T @ (weight * (chance - marks)) + (point - [1.0, 0.0])
        point = point - np.linalg.solve((x * (weight * chance * (1 - chance))[:, None]).T @ x + np.eye(2), slope)
    # A curve that falls would say that the votes tell nothing.
    return index._replace(slope=float(max(point[0], 0.05)), offset=float(point[1]))


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic", most: int = EXAMPLES) -> Index | float:
    """The index, or the score of every row where the labels have one class only."""
    shares = {r["label"]: r["count"] for r in learnable(labels, label).groupBy("label").count().collect()}
    ids, raw, marks = labelled_sample(docs, labels, label, most, EXAMPLE_BYTES)
    if len(set(marks)) < 2:
        return float(np.mean(marks)) if marks else 0.5
    texts = [t.decode("utf-8", "replace") for t in raw]
    number = choose_terms(texts, marks)
    df, n_docs = document_counts(docs, number)
    index = build(ids, texts, marks, shares, number, df, n_docs)
    index = calibrate(index) if len(set(index.labels.tolist())) == 2 else index
    return index._replace(columns=None)  # each task makes its own


def searched(index: Index, terms: Terms, texts: list[str | None]) -> list[tuple[float, list[dict]]]:
    """Score and evidence of each text."""
    present, counts, ends = terms.counts(texts)
    weights = weighted(present, counts, ends, index.idf)
    raw, evidence = np.full(len(texts), index.base), [[] for _ in texts]
    begin = np.concatenate([[0], ends[:-1]])
    for first in range(0, len(texts), 256):  # 256 x examples sums at a time
        last = min(first + 256, len(texts))
        part = slice(int(begin[first]), int(ends[last - 1]))
        sums = column_sums(index, present[part], weights[part], ends[first:last] - begin[first])
        for i in range(first, last):
            own = slice(int(begin[i]), int(ends[i]))
            if ends[i] > begin[i] and len(index.ids):
                best, cosines = nearest(index, present[own], weights[own], sums[i - first])
                raw[i] = vote(index, best, cosines)
                evidence[i] = [{"doc_id": d, "cosine": c} for d, c in zip(index.ids[best[:EVIDENCE]].tolist(), cosines[:EVIDENCE].tolist())]
    return list(zip(calibrated(index, raw).tolist(), evidence))


def score(docs: DataFrame, model: Index | float, text: str = "text", doc: str = "doc_id") -> DataFrame:
    """(doc_id, score, evidence) of every row; the model has a fixed bound and goes to every task."""
    rows = docs.select(F.col(doc).alias("doc_id"), F.col(text).cast("string").alias("text"))
    sent = (model, None) if isinstance(model, float) else (model._replace(  # what only bounds cosines, in single precision
        number=None, columns=None, terms=None, all_weights=None, ends=None, most=model.most.astype(np.float32),
        starts=model.starts.astype(np.int32), cells=model.cells.astype(np.int32), dense=model.dense.astype(np.int32),
    ), Terms(model.number))
    known = docs.sparkSession.sparkContext.broadcast(sent)
    kind = pa.list_(pa.struct([("doc_id", pa.int64()), ("cosine", pa.float64())]))

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index, terms = known.value
        if terms is not None:
            index = index._replace(columns=columns_of(index))
        for batch in steps(batches):
            texts = column(batch, "text").to_pylist()
            if terms is None:
                scores, evidence = [index] * len(texts), [[]] * len(texts)
            else:
                place = {t: i for i, t in enumerate(dict.fromkeys(texts))}
                found = searched(index, terms, list(place))
                scores, evidence = zip(*(found[place[t]] for t in texts))
            yield pa.record_batch(
                [column(batch, "doc_id"), pa.array(scores, pa.float64()), pa.array(evidence, kind)], ["doc_id", "score", "evidence"]
            )
        release()

    id_type = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(scored, f"doc_id {id_type}, score double, evidence array<struct<doc_id:long,cosine:double>>")
