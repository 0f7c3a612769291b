"""Alignment against whole texts tokenized by the libraries and linked by plain loops."""

import hashlib
import re
from collections import Counter

import numpy as np
import pytest
from helpers import documents
from hypothesis import given, settings
from hypothesis import strategies as st

from docquarry.llm import alignment
from docquarry.llm.common import table
from docquarry.llm.tokens import vocabulary_path

PATHS = vocabulary_path("byte_bpe_50k.json"), vocabulary_path("piece_bpe_32k.model")
ODD = [
    None, "", " ", "  ", "a", " a", "a ", "a  b", "a\tb", "a\n b\n  c", "x▁y", "▁", "é é", "Ａ ﬁ fi", "<|endoftext|> <s> <unk> </s> <0x41>",
    "🙂🙂 日本語テキスト 한국어", "\x00a \x1c b", "a b  c", "a b c　d", "don't can't 12345 3.14 !!??", "q" * 3000, "the " * 2000,
    "zwj 👨‍👩‍👧 end", "\r\n\r\n", "éa ñ", "good x▁y bad ▁", "the cat", "the cat",
]


def tokens(text):
    from sentencepiece import SentencePieceProcessor
    from tokenizers import Tokenizer

    if not tokens.__dict__:
        tokens.a, tokens.b = Tokenizer.from_file(PATHS[0]), SentencePieceProcessor(model_file=PATHS[1])
        tokens.a.encode_special_tokens = True
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
        others = [b for b in range(256) if b not in plain]
        tokens.byte = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}
    a, b = tokens.a.encode(" " + text, add_special_tokens=False).ids, tokens.b.encode(text)
    a_parts = [bytes(tokens.byte[c] for c in tokens.a.id_to_token(i)) for i in a]
    b_parts = []
    for piece in map(tokens.b.id_to_piece, b):
        byte = re.fullmatch("<0x([0-9A-F]{2})>", piece)
        b_parts.append(bytes.fromhex(byte[1]) if byte else piece.replace("▁", " ").encode())
    return a, b, a_parts, b_parts


def linked(text):
    """Groups of (A ids, B ids) of a text, or None."""
    if not text:
        return None
    a, b, a_parts, b_parts = tokens(text)
    if b"".join(a_parts) != (" " + text).encode() or b"".join(b_parts) != (" " + text).encode():
        return None
    groups, i, j, a_end, b_end, own = [], 0, 0, 0, 0, ([], [])
    while i < len(a) or j < len(b):
        if j >= len(b) or i < len(a) and a_end <= b_end:
            own[0].append(a[i])
            a_end += len(a_parts[i])
            i += 1
        else:
            own[1].append(b[j])
            b_end += len(b_parts[j])
            j += 1
        if a_end == b_end:
            groups.append(own)
            own = ([], [])
    return groups


def brute(rows):
    docs = [(i, linked(t)) for i, t in rows]
    count = Counter()
    for _, groups in docs:
        count.update({(x, y) for a, b in groups or [] for x in a for y in b})
    most = Counter()
    for (x, _), n in count.items():
        most[x] = max(most[x], n)
    found = []
    for i, groups in docs:
        if groups is None:
            found.append((i, 0, 0, 0, 0, 0, 0, ""))
            continue
        links = [(x, y) for a, b in groups for x in a for y in b]
        shown = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in groups)
        found.append((
            i, sum(len(a) for a, _ in groups), sum(len(b) for _, b in groups), len(groups), len(links),
            sum(count[x, y] == most[x] for x, y in links), sum(count[p] for p in links), hashlib.sha256(shown.encode()).hexdigest(),
        ))
    return sorted(found, key=repr)


def rows_of(df):
    names = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    return sorted(map(tuple, df.select(*names).collect()), key=repr)


@pytest.mark.parametrize("most_marks", [alignment.MARKS, 10])
def test_odd_texts(spark, most_marks):
    rows = [(i if i != 3 else None, t) for i, t in enumerate(ODD)]
    assert rows_of(alignment.align(documents(spark, rows).repartition(3), *PATHS, most_marks=most_marks)) == brute(rows)


def test_whole_texts_of_the_documents(spark):
    docs = table(spark, "/root/testdata/sf0.001", "documents")
    rows = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]
    assert rows_of(alignment.align(docs, *PATHS)) == brute(rows)


def test_pieces_are_tokenized_as_whole_texts_are(spark):
    texts = [t for t in ODD if t and "▁" not in t] + [r["text"] for r in table(spark, "/root/testdata/sf0.01", "pages").selectExpr("html as text").limit(150).collect()]
    aligner = alignment.Aligner(*PATHS)
    ids, sizes = aligner.b_side.encode_bytes([b" " + t.encode() for t in texts])
    assert [f.tolist() for f in np.split(ids, np.cumsum(sizes)[:-1])] == aligner.b_side.model.encode(texts)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.text(st.sampled_from("aZé.,'s \n\t▁ßΣ12<|>🙂́日\xa0"), max_size=30), min_size=1, max_size=4))
def test_any_texts(texts):
    if not hasattr(test_any_texts, "aligner"):
        test_any_texts.aligner = alignment.Aligner(*PATHS)
    facts, digests, ends, pairs, times = test_any_texts.aligner.align([t.encode() for t in texts])
    begin = 0
    for text, fact, digest, end in zip(texts, facts.tolist(), digests, ends.tolist()):
        groups = linked(text)
        places = Counter((x, y) for a, b in groups or [] for x in a for y in b)
        found = {(p >> alignment.ID_BITS, p & (1 << alignment.ID_BITS) - 1): n for p, n in zip(pairs[begin:end].tolist(), times[begin:end].tolist())}
        begin = end
        shown = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in groups or [])
        assert found == places
        assert digest == (hashlib.sha256(shown.encode()).hexdigest() if groups else "")
        assert fact == [sum(len(a) for a, _ in groups or []), sum(len(b) for _, b in groups or []), len(groups or []), sum(places.values())]


def test_windows_are_remembered_by_ids_and_forgotten(monkeypatch):
    aligner = alignment.Aligner(*PATHS)
    texts = [b"the cat  sat", b"cat the", "x▁y".encode(), b"the cat  sat the cat the", None]
    whole = aligner.align(texts)
    assert len(aligner.known) == len(aligner.shown) <= 8
    monkeypatch.setattr(alignment, "WINDOWS", 0)
    monkeypatch.setattr(alignment, "GROUP_LINKS", 0)
    single = [aligner.align([t]) for t in texts]
    assert [whole[0][i].tolist() for i in range(5)] == [s[0][0].tolist() for s in single]
    assert whole[1] == [s[1][0] for s in single]
    assert whole[3].tolist() == [p for s in single for p in s[3].tolist()]
    assert whole[4].tolist() == [p for s in single for p in s[4].tolist()]


def test_no_rows_and_clashing_columns(spark):
    assert rows_of(alignment.align(documents(spark, []), *PATHS)) == []
    odd = documents(spark, [(1, "the cat"), (2, None)]).selectExpr("doc_id", "text", "7 as row", "8 as pairs", "9 as pair", "'x' as n_a")
    assert rows_of(alignment.align(odd, *PATHS)) == brute([(1, "the cat"), (2, None)])
    assert rows_of(alignment.align(documents(spark, [(1, None), (2, "")]), *PATHS)) == brute([(1, None), (2, "")])
