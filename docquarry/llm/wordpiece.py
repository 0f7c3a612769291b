"""Token counts of greedy longest-match word pieces, by an automaton that reads each character once.

The vocabulary is a trie. Each node has a failure link and the number of pieces popped when it is
taken: if the text leaves the trie at a node, the longest pieces of what the node spells are counted at
once, and the link leads to the node that spells the rest. A word is counted in time linear in its
length, and no piece is ever built.

Words are runs without ASCII white space, with A-Z lower-cased, taken as UTF-8 bytes and closed by an
end mark that is part of its last piece. A word that the vocabulary cannot spell counts as one token.

Defined results: null and empty texts have no words and no tokens. Repeated rows are counted each. Other
columns, also of the same names as the counts, are not returned unless named in ``keep``. Very long texts
and words are read whole; an empty table gives an empty table.
"""

from __future__ import annotations

import json
from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from docquarry.llm.common import binary_values, column, steps
from docquarry.llm.tokens import PRINTED

END = 256
END_TEXT = "</w>"
WORDS = 500_000


def pieces_of(path: str) -> list[tuple[int, ...]]:
    """The vocabulary of a tokenizer file, each piece as bytes with ``END`` for the end mark."""
    with open(path, encoding="utf-8") as file:
        vocabulary = json.load(file)["model"]["vocab"]
    printed = {chr(PRINTED.get(b, b)): b for b in range(256)}
    found = []
    for piece in vocabulary:
        closed = piece.endswith(END_TEXT) and piece != END_TEXT
        letters = piece[: -len(END_TEXT)] if closed else piece
        if letters and all(c in printed for c in letters):
            found.append((*(printed[c] for c in letters), *([END] if closed else [])))
    return found


class Automaton:
    """Trie, failure links and popped counts; node 0 is the root."""

    def __init__(self, pieces: list[tuple[int, ...]]) -> None:
        self.next: list[dict[int, int]] = [{}]
        whole: set[int] = set()
        for piece in pieces:
            node = 0
            for symbol in piece:
                if symbol not in self.next[node]:
                    self.next[node][symbol] = len(self.next)
                    self.next.append({})
                node = self.next[node][symbol]
            whole.add(node)
        self.fail = [-1] * len(self.next)
        self.popped = [0] * len(self.next)
        queue = deque([0])
        while queue:
            parent = queue.popleft()
            for symbol, node in self.next[parent].items():
                if node in whole:
                    self.fail[node], self.popped[node] = 0, 1
                else:
                    link, count = self.fail[parent], self.popped[parent]
                    while link >= 0 and symbol not in self.next[link]:
                        count += self.popped[link]
                        link = self.fail[link]
                    if link >= 0:
                        self.fail[node], self.popped[node] = self.next[link][symbol], count
                queue.append(node)

    def count(self, word: bytes) -> int:
        """How many pieces the greedy longest match cuts the word into; 1 if it cannot be spelt."""
        node = count = 0
        for symbol in (*word, END):
            step = self.next[node].get(symbol)
            while step is None:
                count += self.popped[node]
                node = self.fail[node]
                if node < 0:
                    return 1
                step = self.next[node].get(symbol)
            node = step
        while node > 0:
            count += self.popped[node]
            node = self.fail[node]
        return count if node == 0 else 1


_counters: dict[str, tuple[Automaton, dict[bytes, int]]] = {}


def _counter(path: str) -> tuple[Automaton, dict[bytes, int]]:
    """One automaton per worker, and the counts of the words it has met; at most ``WORDS`` are remembered."""
    if path not in _counters:
        _counters[path] = (Automaton(pieces_of(path)), {})
    return _counters[path]


def count_tokens(texts: list[bytes | None], path: str) -> list[tuple[int, int]]:
    """Words and pieces of each text."""
    automaton, known = _counter(path)
    if len(known) > WORDS:
        known.clear()
    found = []
    for text in texts:
        words = (text or b"").lower().split()
        for word in set(words):
            if word not in known:
                known[word] = automaton.count(word)
        found.append((len(words), sum(map(known.__getitem__, words))))
    return found


def token_counts(docs: DataFrame, path: str, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` columns, ``n_words`` and ``n_tokens`` of every row; ``path`` names the vocabulary on the executors."""
    rows = docs.select(*keep, docs[text].cast("string").alias("_text"))

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches, "_text"):
            counts = np.array(count_tokens(binary_values(column(batch, "_text")), path), np.int64).reshape(-1, 2)
            kept = [column(batch, name) for name in keep]
            yield pa.record_batch([*kept, pa.array(counts[:, 0]), pa.array(counts[:, 1])], [*keep, "n_words", "n_tokens"])

    kept_schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.select(*keep).schema)
    return rows.mapInArrow(counted, f"{kept_schema}, n_words long, n_tokens long")
