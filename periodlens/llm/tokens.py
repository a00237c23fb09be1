"""Token ids by the tokenizers library, with a cache per space-delimited chunk.

Both public tokenizers split a text before a space followed by a non-space and merge
bytes only inside the parts, so ids of a text are the ids of its chunks one after
another. Most chunks repeat: a bounded cache per Python worker holds their ids as
bytes, in two generations: when the younger one is full, the older one goes, and what is
used again moves up, so that frequent chunks stay. A text where white space stands around a space (where the split would differ)
is encoded whole; so is a chunk with characters beyond Latin-1 letters.
"""

from __future__ import annotations

import os
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from periodlens.llm import texts

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

#: entries of a generation of a worker's cache (there are two); "word" has fewer, as its encoder runs after other work in a
#: pipeline's executors
CHUNKS = {"byte": 400_000, "word": 100_000}

_LETTERS = "A-Za-zÀ-ÖØ-öø-ÿ"
_PLAIN = re.compile(rf"[\n\t\r\x20-\x7e{_LETTERS}]*").fullmatch
_AROUND = re.compile(r" (?=\s|\Z)(?<=\s )").search
_CONTRACTIONS = "'s|'t|'re|'ve|'m|'ll|'d"
#: the split patterns of the two vocabularies, for the characters of _PLAIN
_BYTE_PARTS = re.compile(rf"{_CONTRACTIONS}| ?[{_LETTERS}]+| ?[0-9]+| ?[^\s{_LETTERS}0-9]+|\s+(?!\S)|\s+").findall
_WORD_PARTS = re.compile(rf"{_CONTRACTIONS}|[{_LETTERS}]+|[0-9]|[^\s{_LETTERS}0-9]+").findall


#: closing punctuation after a letter or digit, before a space or the end: always a part of its own in both splits
_CLOSING = rf'([{_LETTERS}0-9])([.,;:!?")]+)( |$)'
#: a line's end between letters or digits: the punctuation, the line break and what follows are parts of their own, too
_LINE_END = rf'([{_LETTERS}0-9])([.,;:!?")]*)\n([{_LETTERS}0-9])'
#: stands before what is cut off so, in place of a space that isn't there
_MARK = "\x01"


def byte_characters() -> dict[int, str]:
    """Byte-level BPE writes each byte as a printable character: itself, or the next free one from 256 on."""
    keep = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return {b: chr(b if b in keep else next(spare)) for b in range(256)}


class Encoder:
    """``encode(text)`` gives the ids of one text as bytes of little-endian ``dtype``.

    ``kind`` is "byte" (a space belongs to the next word) or "word" (lower case, no white space).
    ``known`` holds the ids of a chunk: with the space before it for "byte"."""

    def __init__(self, path: str, kind: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.spaced = kind == "byte"
        self.most = CHUNKS[kind]
        size = self.tokenizer.get_vocab_size()
        self.dtype = np.dtype("<u2" if size <= 1 << 16 else "<u4")
        self.table = byte_characters()
        self.packed = [i.to_bytes(self.dtype.itemsize, "little") for i in range(size)]
        self.known: dict[str, bytes] = {}
        self.inner: dict[str, bytes] = {}
        self.older: tuple[dict[str, bytes], dict[str, bytes]] = {}, {}

    def whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, self.dtype).tobytes()

    def merged(self, part: str) -> bytes:
        """The ids of one part of the split."""
        mapped = part.replace(" ", "Ġ") if part.isascii() and part.isprintable() else part.encode().decode("latin-1").translate(self.table)
        packed = self.packed
        return b"".join([packed[t.id] for t in self.model.tokenize(mapped)])

    def part(self, part: str) -> bytes:
        """As merged(), kept: after a space, or for "word", it is a chunk of its own."""
        if self.spaced != part.startswith(" "):
            store, old, key = self.inner, self.older[1], part
        else:
            store, old, key = self.known, self.older[0], part[self.spaced :]
        ids = store.get(key)
        if ids is None:
            ids = store[key] = old.get(key) or self.merged(part)
        return ids

    def chunk(self, text: str, space: str) -> bytes:
        """The ids of a chunk that follows ``space``."""
        if "<|" in text or not _PLAIN(text):
            return self.whole(space + text)
        if self.spaced:
            if text.isalpha():
                return self.merged(space + text)
            return b"".join(map(self.part, _BYTE_PARTS(space + text)))
        text = text.lower()
        return b"".join(map(self.part, [text] if text.isalpha() else _WORD_PARTS(text)))

    def _ids(self, chunks: list[str], marked: bool) -> list[bytes]:
        """The ids of chunks that follow a space, or, with a mark, nothing."""
        known, old, space = self.known, self.older[0], " " if self.spaced else ""
        tokenize, packed, room = self.model.tokenize, self.packed, self.most - len(self.known) - len(self.inner)
        out = list(map(known.get, chunks)) if marked else [None if _MARK in x else known.get(x) for x in chunks]
        for i in [i for i, ids in enumerate(out) if ids is None]:
            x = chunks[i]
            if not marked and _MARK in x:  # a text's own character
                out[i] = self.whole(space + x)
                continue
            ids = old.get(x) if old else None
            if ids is None:
                if x.isascii() and x.isalpha():  # most chunks: a word by itself
                    tokens = tokenize("Ġ" + x if space else x.lower())
                    ids = packed[tokens[0].id] if len(tokens) == 1 else b"".join([packed[t.id] for t in tokens])
                else:
                    before = len(self.inner)
                    ids = self.chunk(x[1:], "") if x.startswith(_MARK) else self.chunk(x, space)
                    room -= len(self.inner) - before
            out[i] = known[x] = ids
            room -= 1
            if room < 0:
                self.older = known, self.inner
                self.known, self.inner = {}, {}
                known, old, room = self.known, self.older[0], self.most
        return out

    def encode_all(self, column: pa.Array, end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts one after another, each with the end id; offsets of the texts). Null is an empty text.

        Arrow splits the texts and tells their distinct chunks; Python sees each of these once, numpy lays their ids out."""
        heads, rest = [], []
        for text in column.to_pylist():
            text = text or ""
            if not self.spaced:  # lower case as the tokenizer's, for these characters; both cases are one chunk
                rest.append(text.lower() if "<|" not in text and _PLAIN(text) else text)
            elif _AROUND(text):
                heads.append(self.whole(text))
                rest.append(None)
            else:
                first, space, more = text.partition(" ")
                heads.append(self.chunk(first, ""))
                rest.append(more if space else None)
        rest, marked = pa.array(rest, pa.string()), not any(_MARK in x for x in rest if x)
        if marked:  # a word with a full stop is the word and the full stop: fewer distinct chunks
            rest = pc.replace_substring_regex(rest, _LINE_END, f"\\1 {_MARK}\\2 {_MARK}\n {_MARK}\\3")
            rest = pc.replace_substring_regex(rest, _CLOSING, f"\\1 {_MARK}\\2\\3")
        pieces = pc.split_pattern(rest, " ")
        n, size = len(column), pc.fill_null(pc.list_value_length(pieces), 0).to_numpy()
        chunks = pieces.flatten().dictionary_encode()
        end = np.array([end_id], self.dtype).tobytes()
        blobs = [*self._ids(chunks.dictionary.to_pylist(), marked), *(heads or [b""] * n), end]
        length = np.fromiter(map(len, blobs), np.int64, len(blobs)) // self.dtype.itemsize
        start = np.cumsum(length) - length
        # each text is its head, its chunks, the end id
        first = np.cumsum(size + 2) - size - 2
        order = np.full(int(size.sum()) + 2 * n, len(blobs) - 1, np.int64)
        order[first] = len(chunks.dictionary) + np.arange(n)
        order[np.repeat(first + 1 - (np.cumsum(size) - size), size) + np.arange(len(chunks))] = chunks.indices.to_numpy()
        length, start = length[order], start[order]
        ends = np.cumsum(length)
        ids = np.frombuffer(b"".join(blobs), self.dtype)[np.repeat(start - ends + length, length) + np.arange(ends[-1] if len(ends) else 0)]
        return ids, np.concatenate(([0], ends[first + size + 1])) if n else np.zeros(1, np.int64)

    def encode(self, text: str) -> bytes:
        """The ids of one text, without an end id."""
        return self.encode_all(pa.array([text], pa.string()), 0)[0][:-1].tobytes()


def binaries(ids: np.ndarray, cuts: np.ndarray) -> pa.Array:
    """ids[cuts[0]:cuts[1]], ids[cuts[1]:cuts[2]], ... as little-endian binary values."""
    at = (cuts * ids.dtype.itemsize).astype(np.int64)
    return pa.Array.from_buffers(pa.large_binary(), len(cuts) - 1, [None, pa.py_buffer(at), pa.py_buffer(np.ascontiguousarray(ids))]).cast(pa.binary())


_ENCODERS: dict[tuple[str, str], Encoder] = {}
texts.KEPT.append(_ENCODERS.clear)


def encoder(path: str, kind: str) -> Encoder:
    """The worker's encoder for a vocabulary file."""
    if (path, kind) not in _ENCODERS:
        _ENCODERS[path, kind] = Encoder(path, kind)
    return _ENCODERS[path, kind]


def vocabulary(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)

