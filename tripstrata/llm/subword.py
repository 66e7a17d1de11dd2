"""Encoding by a public tokenizer's file, a run of characters at a time.

Both kinds of tokenizers used here never join what stands on the two sides of a *safe cut*: a place
before ASCII white space that follows a character which is no white space. The pieces between safe
cuts are encoded by the library and remembered, since most of them recur. Texts with rare white space
or separator controls, on which libraries differ, are encoded whole.
"""

from __future__ import annotations

import os
import re
from array import array

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from tripstrata.llm import words as W

_PIECE = re.compile(r"[ \t\n\r\f\v]*[^ \t\n\r\f\v]+|[ \t\n\r\f\v]+")
_ODD_CODES = [*range(0x1C, 0x20), 0x85, 0xA0, 0x1680, 0x180E, *range(0x2000, 0x200C), 0x2028, 0x2029]
_ODD_CODES += [0x202F, 0x205F, 0x3000, 0xFEFF]
_ODD = re.compile("[" + "".join(map(chr, _ODD_CODES)) + "]")
_HARD = ("  ", " \n", "\n ", "\n\n", "\t", "\r", "\f", "\v", "\x1c", "\x1d", "\x1e", "\x1f")
_PLAIN = re.compile("([ \n]?)([A-Za-zÀ-ÖØ-öø-ÿ]+)([.,;:!?|]*)")
_LONGEST = 64
_JOINED = 1000


class _Memo(dict):
    """Ids of pieces; ``lead`` is what stands before each key in the text."""

    def __init__(self, ids, lead: str = ""):
        self.ids, self.lead = ids, lead

    def __missing__(self, key: str) -> bytes:
        found = self.ids(key if key[:1] == "\n" else self.lead + key)
        if len(key) <= _LONGEST:
            self[key] = found
        return found


class Subwords:
    """``limit`` bounds the number of remembered pieces, and so the memory of a task."""

    _loaded: dict = {}

    def __init__(self, path: str, limit: int = 1_000_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        size = self.library.get_vocab_size(with_added_tokens=True)
        self.kind = np.dtype("<u2" if size <= 1 << 16 else "<u4")
        self._code = "H" if self.kind.itemsize == 2 else "I"
        self.names = [self.library.id_to_token(i) for i in range(size)]
        self.limit = limit
        self._model = self.library.model
        self._forget()
        self._words = self._direct_words()
        self._sizes = self._byte_sizes()

    @classmethod
    def of(cls, path: str) -> Subwords:
        """One per process, so that what a task has learned serves the next."""
        if path not in cls._loaded:
            cls._loaded[path] = cls(path)
        return cls._loaded[path]

    def _forget(self) -> None:
        self._spaced, self._whole = _Memo(self._ids, " "), _Memo(self._ids)
        self._recent, self._older = {}, {}

    def _library_ids(self, text: str) -> bytes:
        ids = self.library.encode(text, add_special_tokens=False).ids
        return array(self._code, ids).tobytes()

    def _direct_words(self):
        """How a run of Latin letters enters the model itself, or None if that can't be told.

        Letters that stand alone pass the normalizer and the splitter as one word, so the model can be
        asked directly. Which form it gets is found by trying both on samples.
        """
        samples = ["Word", " Wörter", "ÉTÉ", " naïveté", "x", " Zürich"]
        by_byte = {}
        free = 256
        for code in range(256):
            if 33 <= code <= 126 or 161 <= code <= 172 or code >= 174:
                by_byte[code] = chr(code)
            else:
                by_byte[code], free = chr(free), free + 1

        def kept(lead: str, letters: str) -> str:
            return (lead + letters).encode().decode("latin-1").translate(by_byte)

        def folded(lead: str, letters: str) -> str:
            return letters.lower().encode().decode("latin-1").translate(by_byte)

        for form in (kept, folded):
            split = [_PLAIN.fullmatch(x).groups()[:2] for x in samples]
            if all(
                self._model_ids(form(*parts)) == self._library_ids(x)
                for parts, x in zip(split, samples, strict=True)
            ):
                return form
        return None

    def _model_ids(self, word: str) -> bytes:
        try:
            return array(self._code, [x.id for x in self._model.tokenize(word)]).tobytes()
        except Exception:  # a form that this vocabulary lacks
            return b""

    def _ids(self, piece: str) -> bytes:
        found = _PLAIN.fullmatch(piece) if self._words else None
        if not found or found[1] == "\n":
            return self._library_ids(piece)
        if found[3]:
            return self._whole[found[1] + found[2]] + self._whole[found[3]]
        return self._model_ids(self._words(found[1], found[2]))

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text, as little-endian integers of ``self.kind``."""
        if len(self._spaced) + len(self._whole) > self.limit:
            self._forget()
        spaced, whole, out = self._spaced.__getitem__, self._whole.__getitem__, []
        for text in texts:
            odd = not text.isascii() and _ODD.search(text)
            if not odd and text[:1] not in (" ", "\n") and not any(x in text for x in _HARD):
                first, *rest = text.replace("\n", " \n").split(" ")
                out.append((whole(first) if first else b"") + b"".join(map(spaced, rest)))
            elif not odd and not _ODD.search(text):
                out.append(b"".join(map(whole, _PIECE.findall(text))))
            else:
                out.append(self._library_ids(text))
        return out

    def encode_array(self, texts: pa.LargeStringArray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, one after another, and how many each text has; no text is NULL.

        Arrow tells which pieces of the texts are equal, so that Python meets each of them once.
        """
        odd = pc.match_substring_regex(texts, _ODD.pattern).to_numpy(zero_copy_only=False)
        pieces, first = W.with_space(texts, odd)
        coded = pieces.dictionary_encode()
        places = coded.indices.to_numpy()
        single = np.zeros(len(coded.dictionary), bool)
        single[places[first[:-1][odd]]] = True
        ids = pa.array(self._unique_ids(coded.dictionary, single), pa.large_binary())
        data, offsets = W.raw(ids.take(coded.indices))
        return data.view(self.kind), np.diff(offsets[first]) // self.kind.itemsize

    def _unique_ids(self, pieces: pa.LargeStringArray, single: np.ndarray) -> list[bytes]:
        """Ids of different pieces; the last two generations of pieces are remembered, half of ``limit`` each.

        Pieces between two safe cuts may follow one another in a text, so unknown ones are encoded together.
        The ``single`` ones and those at an end of their text are not.
        """
        if len(self._recent) + len(self._whole) > self.limit // 2:
            older = self._recent
            self._forget()
            self._older = older
        names = pieces.to_numpy(zero_copy_only=False).tolist()
        found = list(map(self._recent.get, names))
        missing = [k for k, ids in enumerate(found) if ids is None]
        if not missing:
            return found
        data, offsets = W.raw(pieces)
        lone = single | ~W.SPACE[data[offsets[:-1]]] | W.SPACE[data[offsets[1:] - 1]]
        lone, sizes = lone.tolist(), np.diff(offsets)
        together = []
        for k in missing:
            found[k] = self._older.get(names[k])
            if found[k] is None and (lone[k] or self._sizes is None):
                found[k] = self._ids(names[k])
            elif found[k] is None:
                together.append(k)
        for k in range(0, len(together), _JOINED):
            group = together[k : k + _JOINED]
            for at, ids in zip(group, self._joined([names[x] for x in group], sizes[group]), strict=True):
                found[at] = ids
        for k in missing:
            if len(names[k]) <= _LONGEST:
                self._recent[names[k]] = found[k]
        return found

    def _joined(self, pieces: list[str], sizes: np.ndarray) -> list[bytes]:
        """Ids of pieces that are encoded as one text, cut where the bytes of the tokens reach the ends of the pieces."""
        ids = self.library.encode_batch_fast(["".join(pieces)], add_special_tokens=False)[0].ids
        ids = np.array(ids, self.kind)
        reached, ends = np.cumsum(self._sizes[ids]), np.cumsum(sizes)
        cuts = np.searchsorted(reached, ends)
        if not len(ids) or reached[-1] != ends[-1] or not np.array_equal(reached[cuts], ends):
            return list(map(self._ids, pieces))
        cuts = ((cuts + 1) * self.kind.itemsize).tolist()
        raw = ids.tobytes()
        return [raw[a:b] for a, b in zip([0, *cuts], cuts, strict=False)]

    def _byte_sizes(self) -> np.ndarray | None:
        """How many bytes of the text each token stands for, if a vocabulary is one of bytes."""
        if self.library.normalizer or type(self.library.pre_tokenizer).__name__ != "ByteLevel":
            return None
        sizes = np.array([len(x or "") for x in self.names])
        for k, token in self.library.get_added_tokens_decoder().items():
            sizes[k] = len(token.content.encode())
        return sizes

    def wide(self, ids: bytes) -> bytes:
        """The ids as little-endian unsigned 32-bit integers."""
        return np.frombuffer(ids, self.kind).astype("<u4").tobytes()

    def decode(self, ids: bytes) -> str:
        numbers = np.frombuffer(ids, self.kind).tolist()
        if self.library.decoder is None:  # the library then joins the tokens by blanks
            return " ".join(map(self.names.__getitem__, numbers))
        return self.library.decode(numbers, skip_special_tokens=False)


def ends(text: str) -> tuple[int, int]:
    """The first and the last safe cut in a text, or -1 and -1."""
    first = _FIRST.search(text)
    if not first:
        return -1, -1
    at = len(text)
    while True:  # the last white space that follows something else
        at = max(text.rfind(c, 0, at) for c in " \t\n\r\f\v")
        if text[at - 1] not in " \t\n\r\f\v":
            return first.start() + 1, at


_FIRST = re.compile(r"[^ \t\n\r\f\v](?=[ \t\n\r\f\v])")


def odd(text: str) -> bool:
    return _ODD.search(text) is not None
