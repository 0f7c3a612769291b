"""Token ids of whole texts from a public tokenizer file, fast by remembering the ids of pieces.

The tokenizers split a text before merging, and never merge across that split. So texts are cut at places where
the split surely cuts, all of a step at once, each distinct piece is encoded by the library, and the ids of a
text are the ids of its pieces in a row. Cuts are where white space follows something else, after a single line
break or tab, and between ASCII letters (or accented Latin ones), digits and marks other than the apostrophe.
Where characters leave it open whether they are white space, nothing is cut. A test holds this against encoding
whole texts. Texts that may name special tokens are encoded whole.

The memory is bounded: an encoder forgets its pieces after ``PIECES`` of them or ``PIECE_BYTES`` bytes, and tasks
call ``forget`` when they end, so workers that go on to other stages hold none.
"""

from __future__ import annotations

import gc
import os
import re
import zlib
from itertools import chain, repeat

import numpy as np
import pyarrow as pa

PIECES = 300_000
PIECE_BYTES = 16 << 20
# Bytes of text that are cut at once: repeated pieces of a step are looked up once.
STEP = 4 << 20
# Latin letters that normalization leaves alone.
_LATIN = re.compile("[a-zA-ZÀ-ÖØ-öø-ɏ]+")
# How byte-level vocabularies print bytes: printable ones as themselves, the others from 256 on.
_PRINTABLE = {*range(33, 127), *range(161, 173), *range(174, 256)}
PRINTED = {b: 256 + i for i, b in enumerate(b for b in range(256) if b not in _PRINTABLE)}

# Kinds of bytes. _OPEN: perhaps white space, or the middle of a character; _SOLID: no white space, else unknown.
_OPEN, _LETTER, _DIGIT, _MARK, _SOLID, _SPACE, _BREAK = range(7)


def _kinds() -> np.ndarray:
    """The kind of each byte as the first of a character."""
    kind = np.full(256, _OPEN, np.uint8)
    for byte in range(33, 127):
        letter = chr(byte)
        kind[byte] = _LETTER if letter.isalpha() else _DIGIT if letter.isdigit() else _MARK
    kind[ord("'")] = _SOLID
    kind[ord(" ")] = _SPACE
    kind[list(b"\t\n\x0b\x0c\r")] = _BREAK
    # Lead bytes; those of 0xc2 and 0xe1 to 0xe3 also begin white space.
    kind[0xC3:0xE1] = _SOLID
    kind[0xE4:0xF5] = _SOLID
    return kind


_KIND = _kinds()
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A"): ord("Z") + 1] += 32


def vocabulary_path(name: str) -> str:
    """The file of a public tokenizer."""
    import public_tokenizers

    return public_tokenizers.path(name)


def _kinds_of(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The kind of each byte as the first and as the last of a character."""
    first = _KIND[raw]
    last = first.copy()
    inner = np.flatnonzero((raw[1:] & 0xC0) == 0x80) + 1
    lead = raw[inner - 1]
    last[inner] = np.where((lead >= 0xC3) & (lead < 0xE0), _SOLID, _OPEN)
    # The accented letters of Latin 1; the signs for multiplication and division are none.
    latin = inner[(lead == 0xC3) & (raw[inner] != 0x97) & (raw[inner] != 0xB7)]
    last[latin] = _LETTER
    first[latin - 1] = _LETTER
    return first, last


class Remembering:
    """The ids of pieces, each encoded once until it is forgotten. ``most``: pieces that are remembered."""

    most = PIECES

    def __init__(self) -> None:
        self.forget()

    def forget(self) -> None:
        self.known: dict[bytes, int] = {}
        self.ids = np.empty(1 << 16, np.int32)
        self.first = np.zeros(1 << 14, np.int64)
        self.used = self.size = 0

    def cut(self, texts: list[bytes]) -> tuple[pa.Array, np.ndarray]:
        """The pieces of all texts in a row, and how many each text has."""
        raise NotImplementedError

    def learn(self, fresh: list[bytes]) -> None:
        """Encode pieces and ``append`` their ids."""
        raise NotImplementedError

    def append(self, pieces: list[bytes], found: list[list[int]]) -> None:
        ids, sizes = list(chain.from_iterable(found)), list(map(len, found))
        place, end = len(self.known), self.used + len(ids)
        while end > len(self.ids):
            self.ids = np.concatenate([self.ids, np.empty_like(self.ids)])
        while place + len(pieces) + 1 > len(self.first):
            self.first = np.concatenate([self.first, np.zeros_like(self.first)])
        self.ids[self.used: end] = ids
        self.first[place + 1: place + 1 + len(pieces)] = self.used + np.cumsum(sizes)
        self.used = end
        self.size += sum(map(len, pieces))
        self.known.update(zip(pieces, range(place, place + len(pieces))))

    def _ids_of(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of these pieces in a row, and how many each has."""
        begin = self.first[codes]
        sizes = self.first[codes + 1] - begin
        ends = np.cumsum(sizes)
        total = int(ends[-1]) if len(ends) else 0
        return self.ids[np.repeat(begin - (ends - sizes), sizes) + np.arange(total)], sizes

    def encode_bytes(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts in a row, and how many each text has."""
        if len(self.known) > self.most or self.size > PIECE_BYTES:
            self.forget()
        cut, counts = self.cut(texts)
        encoded = cut.dictionary_encode()
        pieces = encoded.dictionary.to_pylist()
        codes = np.fromiter(map(self.known.get, pieces, repeat(-1)), np.int64, len(pieces))
        missing = np.flatnonzero(codes < 0).tolist()
        if missing:
            gc.disable()  # very many small lists, none of them cyclic
            self.learn([pieces[i] for i in missing])
            gc.enable()
            codes[missing] = [self.known[pieces[i]] for i in missing]
        ids, sizes = self._ids_of(codes[encoded.indices.to_numpy()])
        ends = np.concatenate([[0], np.cumsum(sizes)])
        return ids, np.diff(ends[np.concatenate([[0], np.cumsum(counts)])])


class PieceEncoder(Remembering):
    """Encodes texts with one tokenizer file. ``drops_white_space``: its split removes white space and lower-cases.
    ``plain``: names of special tokens in a text are ordinary text."""

    def __init__(self, path: str, drops_white_space: bool, plain: bool = False) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = plain
        self.model = self.tokenizer.model
        self.drops_white_space = drops_white_space
        self.plain = plain
        super().__init__()

    def cut(self, texts: list[bytes]) -> tuple[pa.Array, np.ndarray]:
        raw = np.frombuffer(b"".join(texts), np.uint8)
        starts = np.cumsum([0, *map(len, texts)])
        first, last = _kinds_of(raw)
        before, now = last[:-1], first[1:]
        begins = np.zeros(len(raw) + 1, bool)
        begins[starts[:-1]] = True
        sides = (before != now) & (before >= _LETTER) & (before <= _MARK) & (now >= _LETTER) & (now <= _MARK)
        if self.drops_white_space:
            blank = first >= _SPACE
            begins[1:-1] |= sides | (blank[:-1] & ~blank[1:])
            stays = ~blank
            begins[:-1] &= stays
            raw = _LOWER[raw[stays]]
            place = np.concatenate([[0], np.cumsum(stays)])
        else:
            solid_before, solid = (before >= _LETTER) & (before <= _SOLID), (now >= _LETTER) & (now <= _SOLID)
            alone = (before == _BREAK) & solid
            alone[1:] &= solid_before[:-1]
            begins[1:-1] |= sides | (solid_before & (now >= _SPACE)) | alone
            place = None
        begins[len(first):] = False
        at = np.flatnonzero(begins)
        offsets = np.append(at if place is None else place[at], len(raw))
        pieces = pa.Array.from_buffers(pa.large_binary(), len(at), [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(raw)])
        return pieces, np.diff(np.searchsorted(at, starts))

    def learn(self, fresh: list[bytes]) -> None:
        # Latin letters, perhaps after a space, need no normalizing or splitting: the model alone is asked.
        space, tokenize = chr(PRINTED[0x20]), self.model.tokenize
        words, printed, others = [], [], []
        for piece in fresh:
            bare = piece[1:] if piece[:1] == b" " else piece
            if bare.isalpha():  # ASCII letters
                text = bare.decode()
            else:
                text = bare.decode()
                if not _LATIN.fullmatch(text) or self.drops_white_space and not text.islower():
                    others.append(piece)
                    continue
                text = bare.decode("latin-1").translate(PRINTED)
            words.append(piece)
            printed.append(text if len(bare) == len(piece) else space + text)
        self.append(words, [[t.id for t in tokenize(p)] for p in printed])
        found = self.tokenizer.encode_batch_fast([p.decode() for p in others], add_special_tokens=False)
        self.append(others, [e.ids for e in found])

    def encode(self, texts: list[str | bytes | None]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts in a row, and how many each text has."""
        raw = [t.encode() if isinstance(t, str) else t or b"" for t in texts]
        special = [] if self.plain else [i for i, t in enumerate(raw) if b"<|" in t]
        if not special:
            return self.encode_bytes(raw)
        ids, sizes = self.encode_bytes([b"" if b"<|" in t else t for t in raw])
        found = np.split(ids, np.cumsum(sizes)[:-1])
        for i, e in zip(special, self.tokenizer.encode_batch_fast([raw[i].decode() for i in special], add_special_tokens=False)):
            found[i] = np.array(e.ids, np.int32)
        return np.concatenate(found), np.array([len(f) for f in found])


_encoders: dict[tuple, PieceEncoder] = {}


def encoder(path: str, drops_white_space: bool, plain: bool = False) -> PieceEncoder:
    """One encoder per worker process and file."""
    key = (path, drops_white_space, plain)
    if key not in _encoders:
        _encoders[key] = PieceEncoder(*key)
    return _encoders[key]


def forget() -> None:
    """Drop the pieces of all encoders of this process; tasks call it at their end."""
    for known in _encoders.values():
        known.forget()


def crc32(ids: np.ndarray) -> int:
    """The unsigned crc32 of the ids as little-endian unsigned 32-bit integers."""
    return zlib.crc32(ids.astype("<u4", copy=False).tobytes())
