import zlib

import numpy as np
import pyarrow as pa
import pytest
from helpers import documents
from hypothesis import given, settings
from hypothesis import strategies as st

from docquarry.llm import packing, repair, tokens, wordpiece
from docquarry.llm.common import shared_path

WORD, BYTE = tokens.vocabulary_path("word_bpe_49k.json"), tokens.vocabulary_path("byte_bpe_50k.json")
ODD = [
    None, "", " ", "\n", "  a  b\n\n c\t\td  ", "don't I'll 'S  's\x1c\x1dq a\x85b", "Ünï çö́de İstanbul ΣΑΣ ß  ", "a \n b",
    "日本語 テキスト。 かな", "<|startoftext|> hi <|endoftext|>x <|ENDOFTEXT|>", "hello...world!! 12,34. ٣٤", "é ́x .́", " 　a　 b",
    "word. word, Word! WORD?", "x" * 3000, "tab\tend ", " lead",
]
ROWS = [(i, t) for i, t in enumerate(ODD)] + [(3, ODD[3]), (40, "same"), (41, "same"), (None, "lost id"), (-7, "negative")]


def whole(path, text):
    return tokens.encoder(path, path == WORD).tokenizer.encode(text or "", add_special_tokens=False).ids


@pytest.mark.parametrize("path", [WORD, BYTE])
def test_pieces_give_the_ids_of_whole_texts(path):
    ids, sizes = tokens.encoder(path, path == WORD).encode(ODD)
    found = np.split(ids, np.cumsum(sizes)[:-1])
    assert [f.tolist() for f in found] == [whole(path, t) for t in ODD]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(st.sampled_from("aZé.,'s \n\t\x1d\x85　ßΣ12-_<|>🙂́×ÿ日\xa0"), max_size=40), min_size=1, max_size=3))
def test_pieces_give_the_ids_of_any_text(texts):
    for path in (WORD, BYTE):
        ids, sizes = tokens.encoder(path, path == WORD).encode(texts)
        assert [f.tolist() for f in np.split(ids, np.cumsum(sizes)[:-1])] == [whole(path, t) for t in texts]


def test_special_names_as_plain_text():
    own = tokens.encoder(BYTE, False, plain=True)
    text = "a <|endoftext|> b<|endoftext|>"
    ids = own.encode([text, None, text.encode()])[0].tolist()
    assert ids == 2 * own.tokenizer.encode(text, add_special_tokens=False).ids
    assert 50256 not in ids and 50256 in whole(BYTE, text)


def test_tasks_leave_no_pieces_behind():
    own = tokens.encoder(BYTE, False)
    own.encode(["some words to remember"])
    tokens.forget()
    assert not own.known and own.encode(["some words"])[0].tolist() == whole(BYTE, "some words")


def test_forgetting_pieces_changes_nothing(monkeypatch):
    monkeypatch.setattr(tokens.Remembering, "most", 3)
    own = tokens.PieceEncoder(BYTE, False)
    for text in ODD * 2:
        assert own.encode([text])[0].tolist() == whole(BYTE, text)


# --- word pieces ---


def greedy(word, pieces, longest):
    symbols, at, count = (*word, wordpiece.END), 0, 0
    while at < len(symbols):
        size = next((n for n in range(min(longest, len(symbols) - at), 0, -1) if symbols[at: at + n] in pieces), 0)
        if not size:
            return 1
        at += size
        count += 1
    return count


@settings(max_examples=200, deadline=None)
@given(st.sets(st.text("ab", min_size=1, max_size=4), max_size=8), st.sets(st.text("ab", min_size=1, max_size=3), max_size=5), st.text("ab", min_size=1, max_size=12))
def test_automaton_counts_the_greedy_cut(inner, closing, word):
    pieces = [tuple(p.encode()) for p in inner] + [(*p.encode(), wordpiece.END) for p in closing]
    assert wordpiece.Automaton(pieces).count(word.encode()) == greedy(word.encode(), set(pieces), 5)


def test_counts_with_a_public_vocabulary(spark):
    listed = wordpiece.pieces_of(WORD)
    pieces, longest = set(listed), max(map(len, listed))
    found = wordpiece.token_counts(documents(spark, ROWS), WORD).collect()
    expected = []
    for i, text in ROWS:
        cut = (text or "").encode().lower().split()
        expected.append((i, len(cut), sum(greedy(w, pieces, longest) for w in cut)))
    assert sorted(map(tuple, found), key=repr) == sorted(expected, key=repr)


# --- grammar shards ---


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 4), max_size=300), st.integers(0, 300), st.integers(0, 60))
def test_grammar_round_trip(ids, start, length):
    ids = np.array(ids, np.int64)
    grammar = repair.compress(ids, first_rule=5, least=2)
    assert repair.expand(grammar, grammar.sequence).tolist() == ids.tolist()
    length = max(0, min(length, len(ids) - start))
    if length:
        assert repair.decode_range(grammar, start, length).tolist() == ids[start: start + length].tolist()


def test_grammar_is_smaller_on_repetitive_ids():
    grammar = repair.compress(np.tile(np.arange(50), 200))
    assert len(grammar.sequence) < 10_000 / 8
    assert int(grammar.lengths.max()) >= 8


def test_ids_above_the_limit_are_refused():
    with pytest.raises(ValueError):
        repair.compress(np.array([50_000]))


def test_rules_are_made_until_no_pair_is_frequent():
    rng = np.random.default_rng(4)
    passage = rng.integers(0, 40_000, 3000)
    ids = np.concatenate([np.append(passage, rng.integers(0, 40_000, 9)) for _ in range(20)] + [np.full(5000, 7)])
    grammar = repair.compress(ids)
    left = grammar.sequence.astype(np.int64)
    assert len(grammar.rules) < repair.SYMBOLS - repair.FIRST_RULE
    assert np.unique((left[:-1] << 16) | left[1:], return_counts=True)[1].max() < repair.LEAST
    assert grammar.lengths.max() > 1000
    assert repair.expand(grammar, grammar.sequence).tolist() == ids.tolist()


@pytest.mark.parametrize("shard_ids", [1 << 20, 20])
def test_shards_hold_every_document_in_order(spark, shard_ids):
    folder = shared_path(spark, "shards")
    repair.write_shards(documents(spark, ROWS).repartition(3), folder, WORD, shard_ids=shard_ids)
    found = sorted(repair.crc32_of_ids(repair.read_documents(spark, folder)).collect(), key=lambda r: r["start"])
    ordered = [r["doc_id"] for r in found]
    assert ordered == sorted(ordered, key=lambda i: (i is not None, i))
    text_of = dict(ROWS)
    start = 0
    for row in found:
        ids = np.array([*whole(WORD, text_of[row["doc_id"]]), repair.END_ID], "<u4")
        assert (row["start"], row["n_tokens"], row["ids_crc32"]) == (start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)
    assert len(found) == len(ROWS)


def test_files_in_path_order_hold_ascending_ids(spark):
    folder = shared_path(spark, "shards")
    rows = [(i * 7 % 500, "word " * (i % 9)) for i in range(500)] + [(None, "first"), (-3, "second")]
    repair.write_shards(documents(spark, rows).repartition(5), folder, WORD, shard_ids=40)
    files = spark.read.format("binaryFile").load(folder).select("path", "content").orderBy("path").collect()
    shards = [list(repair.unpack_shards(bytes(f["content"]))) for f in files]
    assert {len(found) for found in shards} == {1} and len(files) > 30
    held = [i for found in shards for shard in found for i in shard.doc_ids]
    assert held == [None, *sorted(i for i, _ in rows if i is not None)]


def test_no_documents(spark):
    folder = shared_path(spark, "shards")
    repair.write_shards(documents(spark, []), folder, WORD)
    assert repair.read_documents(spark, folder).count() == 0
    assert packing.pack(documents(spark, []), BYTE).count() == 0
    assert wordpiece.token_counts(documents(spark, []), WORD).count() == 0


def test_damaged_shards_are_noticed():
    shard = repair.Shard(0, 0, [1], np.array([3]), repair.compress(np.array([1, 2, 3])))
    packed = repair.pack_shard(shard)
    assert next(repair.unpack_shards(packed + b"\n")).doc_ids == [1]
    for bad in (packed[:-1], b"x" + packed, packed[:10]):
        with pytest.raises(ValueError):
            list(repair.unpack_shards(bad))


# --- packing ---


def brute_best(counts, seed, capacity):
    """The largest sum up to the capacity that holds the seed, over all multisets."""
    sums = {0}
    rest = dict(counts)
    rest[seed] -= 1
    for length, n in rest.items():
        for _ in range(n):
            sums |= {s + length for s in sums if s + length + seed <= capacity}
    return max(sums) + seed


@settings(max_examples=80, deadline=None)
@given(st.dictionaries(st.integers(1, 64), st.integers(1, 5), min_size=1, max_size=6))
def test_plan_places_every_piece_and_fills_closest(counts):
    seed = max(counts)
    chosen = packing.choose(counts, seed, 64)
    total = sum(n * u for n, u in chosen.items())
    best = brute_best(counts, seed, 64)
    assert total == best
    assert all(u <= counts[n] for n, u in chosen.items())
    parts = packing.plan(counts, 64)
    lengths = np.repeat(list(counts), list(counts.values()))
    ranks = np.concatenate([np.arange(c) for c in counts.values()])
    sequence, offset = packing.places(parts, lengths, ranks)
    order = np.lexsort((offset, sequence))
    end = {}
    for s, o, n in zip(sequence[order], offset[order], lengths[order]):
        assert o == end.get(s, 0)
        end[s] = o + n
    assert max(end.values()) <= 64


def test_packed_documents(spark, monkeypatch):
    monkeypatch.setattr(packing, "BUCKET_PIECES", 3)
    rows = [(i, t) for i, t in ROWS] + [(100 + i, "word " * (40 * i)) for i in range(30)] + [(200, "long " * 9000)]
    found = packing.pack(documents(spark, rows).repartition(4), BYTE, capacity=128).collect()
    text_of, pieces, end = dict(rows), {}, {}
    for row in sorted(found, key=lambda r: (r["sequence_id"], r["offset"])):
        assert row["offset"] == end.get(row["sequence_id"], 0)
        end[row["sequence_id"]] = row["offset"] + row["length"]
        ids = np.array([*whole(BYTE, text_of[row["doc_id"]]), packing.END_ID], "<u4")
        assert row["doc_tokens"] == len(ids)
        assert row["ids_crc32"] == zlib.crc32(ids[row["start"]: row["start"] + row["length"]].tobytes())
        pieces.setdefault(row["doc_id"], []).append((row["start"], row["length"]))
    assert max(end.values()) <= 128
    for i, _ in rows:
        times = sum(1 for j, _ in rows if j == i)
        assert sum(n for _, n in pieces[i]) == times * len([*whole(BYTE, text_of[i]), 1])
    assert sum(128 - e for e in end.values() if e & (e - 1)) <= 0.01 * sum(end.values())


def test_packing_tokenizes_a_megabyte_at_a_time(spark, monkeypatch):
    docs, held = documents(spark, [(0, "a")]), []

    class Recording:
        def encode(self, texts):
            held.append(sum(map(len, texts)))
            return np.zeros(len(texts), np.int32), np.ones(len(texts), np.int64)

    monkeypatch.setattr(packing, "encoder", lambda *_: Recording())
    monkeypatch.setattr(type(docs), "mapInArrow", lambda rows, cut, schema: cut)
    cut = packing.cut_pieces(docs, BYTE)
    batch = pa.record_batch({"doc_id": pa.array(range(30), pa.int64()), "text": ["x" * 100_000] * 30})
    assert sum(out.num_rows for out in cut(iter([batch]))) == 30
    assert sum(held) == 3_000_000 and max(held) <= 1 << 20
