"""Exact tokenization of whole texts, with each distinct word encoded once.

The tokenizer file lower-cases, drops white space and never lets a piece cross
it, so a text's ids are the ids of its white-space-separated chunks in a row.
A worker keeps the ids of the chunks it has met (up to ``CACHE_CHUNKS``, then it
starts anew: memory stays bounded and results don't depend on it). New chunks
that consist of letters are encoded in one call, as one text, and parted again
at the ids that end a word; the others are encoded one by one. A text that
holds the start of a special token's string is given to the tokenizer whole, and
so is one with a capital that composes with a mark only in lower case.
"""

from __future__ import annotations

import os
import re
import unicodedata
from collections.abc import Iterator
from functools import cache
from itertools import islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

TOKENIZER = "word_bpe_49k.json"
#: Distinct chunks a worker remembers.
CACHE_CHUNKS = 600_000
#: Marks that may follow a word; with it they make two pieces. (An apostrophe may not: it starts a piece with letters.)
MARKS = b"!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"


#: H, J, T, W and Y have letters with marks that exist in lower case only (U+1E96 to U+1E99, U+01F0).
_CAPITAL = re.compile(rb"[HJTWY][\x80-\xff]")


def default_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _letters(chunk: bytes) -> bool:
    """Whether a chunk is letters only, and stays so in lower case (that of U+0130 ends in a
    mark, which a mark behind it joins)."""
    return chunk.isalpha() or ((text := chunk.decode()).isalpha() and (b"\xc4\xb0" not in chunk or text.lower().isalpha()))


class _Codes(dict):
    """Numbers its keys as they are first asked for."""

    def __missing__(self, key: bytes) -> int:
        self[key] = code = len(self)
        return code


class WordTokenizer:
    """``encode(texts)`` gives each text's ids as uint32, without special tokens."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer, pre_tokenizers

        self._tokenizer = Tokenizer.from_file(path)
        # the same model behind white space alone, for words that are normalised already
        self._words = Tokenizer(self._tokenizer.model)
        self._words.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        vocabulary = self._tokenizer.get_vocab(with_added_tokens=False)
        self.size = max(self._tokenizer.get_vocab(with_added_tokens=True).values()) + 1
        self._ends = np.zeros(self.size, dtype=bool)
        self._ends[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
        self._special = tuple(t.content.encode() for t in self._tokenizer.get_added_tokens_decoder().values())
        self._opening = os.path.commonprefix(self._special)
        self._reset()

    def _reset(self) -> None:
        self._codes = _Codes()
        self._used = 0
        self._flat = np.zeros(1 << 16, np.uint32)  # ids of the chunks known, and by code where they lie
        self._at = np.zeros(1 << 16, np.int64)
        self._n = np.zeros(1 << 16, np.int64)

    def _direct(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self._tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _put(self, codes: list[int], flat: np.ndarray, ends: np.ndarray) -> None:
        """Keep, for chunks of these codes, the ids that lie in ``flat``, each up to its end."""
        while len(self._codes) > len(self._at):
            self._at, self._n = (np.concatenate([x, np.zeros_like(x)]) for x in (self._at, self._n))
        while self._used + len(flat) > len(self._flat):
            self._flat = np.concatenate([self._flat, np.zeros_like(self._flat)])
        n = np.diff(ends, prepend=0)
        self._n[codes] = n
        self._at[codes] = self._used + ends - n
        self._flat[self._used : self._used + len(flat)] = flat
        self._used += len(flat)

    def _put_each(self, codes: list[int], chunks: list[bytes]) -> None:
        ids = self._direct([c.decode() for c in chunks])
        self._put(codes, np.array([i for x in ids for i in x], np.uint32), np.cumsum([len(x) for x in ids], dtype=np.int64))

    def _put_words(self, codes: list[int], words: list[bytes]) -> None:
        """Words of letters only: each is one piece, so it ends at its first word-end id."""
        text = unicodedata.normalize("NFC", b" ".join(words).decode())
        if not text.isascii():
            plain = "\u0130" not in text and "\u03a3" not in text  # str.lower treats these two by context
            text = text.lower() if plain else ""
        if text and text.replace(" ", "").isalpha():
            ids = np.array(self._words.encode_batch_fast([text], add_special_tokens=False)[0].ids, np.uint32)
            ends = np.flatnonzero(self._ends[ids]) + 1
            if len(ends) == len(words) and ends[-1] == len(ids):
                self._put(codes, ids, ends)
                return
        self._put_each(codes, words)

    def _learn(self, base: int) -> None:
        """Encode the chunks that were numbered from ``base`` on."""
        words, rest, marked, parts = ([], []), ([], []), [], []
        numbers = self._codes
        for code, chunk in enumerate(self._newest(base), base):
            if chunk[-1] in MARKS:
                stem = chunk.rstrip(MARKS)
                if stem and _letters(stem):
                    marked.append(code)  # letters and the marks behind them are two pieces
                    parts += (numbers[stem], numbers[chunk[len(stem) :]])
                    continue
            elif _letters(chunk):
                words[0].append(code)
                words[1].append(chunk)
                continue
            rest[0].append(code)
            rest[1].append(chunk)
        extra = base + len(marked) + len(words[0]) + len(rest[0])
        for code, chunk in enumerate(self._newest(extra), extra):
            codes, chunks = rest if chunk[-1] in MARKS else words
            codes.append(code)
            chunks.append(chunk)
        if words[0]:
            self._put_words(*words)
        if rest[0]:
            self._put_each(*rest)
        if marked:
            self._put(marked, *self._gather(np.array(parts, np.int64), 2))

    def _newest(self, before: int) -> list[bytes]:
        return list(islice(reversed(self._codes), len(self._codes) - before))[::-1]

    def _gather(self, codes: np.ndarray, group: int = 1) -> tuple[np.ndarray, np.ndarray]:
        """The ids of the chunks of ``codes`` in a row, and where each ``group`` of chunks ends."""
        n = self._n[codes]
        ends = np.cumsum(n)
        total = int(ends[-1]) if len(ends) else 0
        return self._flat[np.repeat(self._at[codes] - ends + n, n) + np.arange(total)], ends[group - 1 :: group]

    def encode(self, texts: list[str | bytes | None]) -> list[np.ndarray]:
        out: list[np.ndarray | None] = [None] * len(texts)
        chunks: list[bytes] = []
        counts: list[int] = []
        for i, text in enumerate(texts):
            raw = text.encode() if isinstance(text, str) else text or b""
            data = raw.lower()
            if (self._opening in data and any(s in data for s in self._special)) or (b"\xcc" in raw and _CAPITAL.search(raw)):
                out[i] = np.array(self._direct([raw.decode()])[0], np.uint32)
                counts.append(0)
            else:
                found = data.split()
                chunks += found
                counts.append(len(found))
        if len(self._codes) > CACHE_CHUNKS:
            self._reset()
        before = len(self._codes)
        codes = np.fromiter(map(self._codes.__getitem__, chunks), np.int64, len(chunks))
        if len(self._codes) > before:
            self._learn(before)
        ids, ends = self._gather(codes)
        cuts = np.append(0, ends)[np.cumsum(counts)].tolist()
        for i, (a, b) in enumerate(zip([0, *cuts], cuts)):
            if out[i] is None:
                out[i] = ids[a:b]
        return out  # type: ignore[return-value]


@cache
def tokenizer(path: str) -> WordTokenizer:
    return WordTokenizer(path)


def text_blocks(batches: Iterator[pa.RecordBatch], column: str, most: int = 4 << 20, raw: bool = False) -> Iterator[tuple[pa.RecordBatch, list]]:
    """Slices of the batches with about ``most`` bytes of text each, so that memory
    doesn't follow the batch size; and their texts (``raw``: as UTF-8)."""
    for batch in batches:
        texts = batch.column(column)
        sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
        block = np.cumsum(sizes) // most
        cuts = [0, *(np.flatnonzero(np.diff(block)) + 1).tolist(), batch.num_rows]
        for a, b in zip(cuts, cuts[1:]):
            if b > a:
                piece = batch.slice(a, b - a)
                held = piece.column(column)
                yield piece, (held.cast(pa.binary()) if raw else held).to_pylist()
