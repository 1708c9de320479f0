"""Token ids of whole texts by a public tokenizer file, a column at a time.

A byte-level BPE never merges across the borders of its pre-tokens, and a border always lies where a blank or line end
follows another kind of character. Arrow cuts a slice of the column into such chunks and these into distinct ones, so each
distinct word of a slice goes to the tokenizer's model once, many words per call, and numpy puts the ids of the texts
together. What is no plain word (digits, signs, rare letters) goes through the whole tokenizer; so do texts with any other
white space, with longer runs of it, or with the string of a special token. All give the ids of
``Tokenizer.encode(text, add_special_tokens=False)`` on the tokenizer as its file has it.
"""

from __future__ import annotations

import os
from collections.abc import Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Bytes of text that are cut into chunks together (a bound on the worker's memory but for longer texts: its arrays take about
# twelve times as much), words per call.
SLICE_BYTES, WORDS = 1 << 22, 20_000
# Documents end with this id.
END_ID = 2

# Texts that blanks and line ends alone don't cut into pre-tokens: other white space, runs of it but for an empty line.
_ODD = r"[\t\r\x0b\x0c\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]|  | \n|\n |\n\n\n|\n\n\z"
# A word is letters of long standing, then marks: two pre-tokens at most.
_LETTER_RANGES = r"A-Za-z\x{c0}-\x{d6}\x{d8}-\x{f6}\x{f8}-\x{1bf}\x{391}-\x{3a1}\x{3a3}-\x{3ce}\x{400}-\x{481}\x{5d0}-\x{5ea}\x{620}-\x{64a}\x{3041}-\x{3096}\x{30a1}-\x{30fa}\x{4e00}-\x{9fa5}\x{ac00}-\x{d7a3}"
_WORD, _MARKS = rf"^[{_LETTER_RANGES}]+\z", ".,;:!?"


def _byte_letters() -> dict[int, str]:
    """The letter that stands for each byte in a byte-level vocabulary: printable Latin-1 stands for itself, the rest
    are numbered from 256."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(rest)}


_BLANK = _byte_letters()[32]
# Line ends stand between words here, and become the blanks at which the words are told apart.
_LETTERS = _byte_letters() | {10: " "}


class _Pieces:
    """Ids of numbered pieces, one after another; number 0 is the empty piece."""

    def __init__(self) -> None:
        self._flat, self._lengths, self.count = [np.empty(0, dtype="<u4")], [np.zeros(1, dtype=np.int64)], 1

    def add(self, flat: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Numbers of the new pieces."""
        self._flat.append(flat)
        self._lengths.append(lengths)
        self.count += len(lengths)
        return np.arange(self.count - len(lengths), self.count)

    def joined(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of a sequence of pieces, and the length of each."""
        flat, lengths = np.concatenate(self._flat), np.concatenate(self._lengths)
        taken = lengths[numbers]
        shift = (np.cumsum(lengths) - lengths)[numbers] - (np.cumsum(taken) - taken)
        return flat[np.repeat(shift, taken) + np.arange(taken.sum())], taken


class Encoder:
    """Encodes texts to little-endian unsigned 32-bit ids."""

    def __init__(self, path: str) -> None:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer, pre_tokenizers

        self._tokenizer = Tokenizer.from_file(path)
        # Strings with an id of their own wherever they stand.
        self._special = [t.content for t in self._tokenizer.get_added_tokens_decoder().values()]
        # The same model over words that are cut and in the vocabulary's letters already. Its own cache only costs time
        # here, where no word is asked for twice.
        self._model = Tokenizer.from_file(path).model
        self._model._resize_cache(0)
        self._words = Tokenizer(self._model)
        self._words.pre_tokenizer = pre_tokenizers.CharDelimiterSplit(" ")
        vocabulary = self._tokenizer.get_vocab()
        self._after_blank = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
        self._after_blank[[i for token, i in vocabulary.items() if token.startswith(_BLANK)]] = True

    def vocabulary_size(self) -> int:
        return self._tokenizer.get_vocab_size()

    def document(self, text: str | None, end_id: int = END_ID) -> np.ndarray:
        """Ids of a document with its end id; NULL is an empty text."""
        return next(self.documents(pa.array([text], pa.string()), end_id))

    def documents(self, texts: pa.Array, end_id: int = END_ID) -> Iterator[np.ndarray]:
        """Ids of each document of an Arrow string column, each with its end id; NULL is an empty text."""
        ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64))
        at = 0
        while at < len(texts):
            stop = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + SLICE_BYTES, side="right")))
            flat, begins = self._slice(texts.slice(at, stop - at), end_id)
            for a, b in pairwise(begins.tolist()):
                yield flat[a:b]
            at = stop

    def _whole(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids and their number, by the whole tokenizer."""
        found = [np.array(x.ids, dtype="<u4") for x in self._tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        return np.concatenate([np.empty(0, dtype="<u4"), *found]), np.array([len(x) for x in found], dtype=np.int64)

    def _behind_blank(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids and their number of plain words that stand behind a blank."""
        borders = np.append(np.arange(0, len(words), WORDS), len(words))
        parts = pc.binary_join(pa.ListArray.from_arrays(pa.array(borders, pa.int32()), words), "\n ").to_pylist()
        flat = [np.empty(0, dtype="<u4")]
        for part in parts:
            letters = f" {part}".encode().decode("latin-1").translate(_LETTERS)
            flat.append(np.array(self._words.encode_batch_fast([letters], add_special_tokens=False)[0].ids, dtype="<u4"))
        ids = np.concatenate(flat)
        # Only a word's first token starts with the letter that stands for the blank.
        return ids, np.diff(np.append(np.flatnonzero(self._after_blank[ids]), len(ids)))

    def _at_line_start(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids and their number of plain words that no blank precedes."""
        found = [[x.id for x in self._model.tokenize(w.encode().decode("latin-1").translate(_LETTERS))] for w in words]
        return np.array([i for ids in found for i in ids], dtype="<u4"), np.array([len(ids) for ids in found], dtype=np.int64)

    def _chunks(self, chunks: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of distinct chunks one after another, and how many each has. A chunk stands behind a blank unless it starts
        with a line end."""
        on_line = pc.starts_with(chunks, "\n")
        body = pc.utf8_ltrim(chunks, characters="\n")
        word = pc.utf8_rtrim(body, characters=_MARKS)
        plain = pc.match_substring_regex(word, _WORD)
        behind, starts = (x.to_numpy(zero_copy_only=False) for x in (pc.and_(plain, pc.invert(on_line)), pc.and_(plain, on_line)))
        marked = (pc.binary_length(body).to_numpy() > pc.binary_length(word).to_numpy()) & (behind | starts)
        rest = ~(behind | starts)

        pieces = _Pieces()
        # Up to three pieces a chunk: the line end, the word or whatever it is, the marks.
        numbers = np.zeros((len(chunks), 3), dtype=np.int64)
        words = word.filter(pa.array(behind)).dictionary_encode()
        numbers[behind, 1] = pieces.add(*self._behind_blank(words.dictionary))[words.indices.to_numpy()]
        words = word.filter(pa.array(starts)).dictionary_encode()
        numbers[starts, 1] = pieces.add(*self._at_line_start(words.dictionary.to_pylist()))[words.indices.to_numpy()]
        numbers[starts, 0] = pieces.add(*self._whole(["\n"]))
        odd = [x if x.startswith("\n") else f" {x}" for x in chunks.filter(pa.array(rest)).to_pylist()]
        numbers[rest, 1] = pieces.add(*self._whole(odd))
        marks = pc.replace_substring_regex(body.filter(pa.array(marked)), rf"^.*[^{_MARKS}]", "").dictionary_encode()
        numbers[marked, 2] = pieces.add(*self._whole(marks.dictionary.to_pylist()))[marks.indices.to_numpy()]
        flat, lengths = pieces.joined(numbers.ravel())
        return flat, lengths.reshape(-1, 3).sum(axis=1)

    def _slice(self, texts: pa.Array, end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after another, and where each one begins, with the end as a last entry."""
        texts = pc.fill_null(texts, "")
        odd = pc.match_substring_regex(texts, _ODD)
        for special in self._special:
            odd = pc.or_(odd, pc.match_substring(texts, special))
        split = pc.split_pattern(pc.replace_substring(pc.if_else(odd, "", texts), "\n", " \n"), " ")
        coded = split.flatten().dictionary_encode()
        heads = split.offsets.to_numpy()[:-1] - split.offsets[0].as_py()
        # What stands before the first blank has no blank before it; an odd text is one piece. Both get pieces of their own.
        firsts = pc.if_else(odd, texts, coded.take(pa.array(heads)).cast(pa.string())).to_pylist()
        pieces = _Pieces()
        known = pieces.add(*self._chunks(coded.dictionary))
        numbers = known[coded.indices.to_numpy()]
        numbers[heads] = pieces.add(*self._whole(firsts))
        flat, lengths = pieces.joined(numbers)
        ends = np.cumsum(lengths)[np.append(heads[1:], len(numbers)) - 1]
        return np.insert(flat, ends, np.uint32(end_id)), np.append(0, ends + np.arange(1, len(ends) + 1))


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """The worker's encoder for that file."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]
