"""Token ids by the ``tokenizers`` library, remembering the ids of words."""

from __future__ import annotations

import os
import re
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex

#: Fixed values of the byte-level format: how it splits a text, and which bytes stand for themselves.
_SPLIT = regex.compile(r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+""")
_PLAIN = [*range(33, 127), *range(161, 173), *range(174, 256)]
#: White space beyond ASCII, as UTF-8.
_WIDE = [chr(c).encode() for c in (0x85, 0xA0, 0x1680, 0x180E, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)]
#: Pieces whose ids a worker keeps, and the longest one that is kept.
MOST_WORDS, LONGEST_KEPT = 500_000, 64
#: Bytes of text that are encoded at once.
SLICE_BYTES = 3 << 20
#: Characters that leave a piece to the library: controls, and those whose class may depend on the version of Unicode.
_ODD = re.compile("[\x00-\x08\x0b\x0c\x0e-\x1f\u0250-\U0010ffff]")

_BLANK = np.zeros(256, bool)
_BLANK[[10, 32]] = True
_WHITE = np.zeros(256, bool)
_WHITE[[*range(9, 14), *range(28, 33)]] = True
_LETTER = np.zeros(256, bool)
_LETTER[[*range(65, 91), *range(97, 123)]] = True
_MARK = np.zeros(256, bool)
_MARK[[*range(33, 48), *range(58, 65), *range(91, 97), *range(123, 127)]] = True
_LEAD = np.zeros(256, bool)
_LEAD[[w[0] for w in _WIDE]] = True


def _letters() -> dict[int, int]:
    """The character that stands for each byte: itself, or the next free one from 256 on."""
    rest = [b for b in range(256) if b not in set(_PLAIN)]
    return {b: b for b in _PLAIN} | {b: 256 + i for i, b in enumerate(rest)}


def _laid_out(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts behind one another, and where each begins, with the end of the last."""
    texts = texts.cast(pa.string())
    _, places, data = texts.buffers()
    if not len(texts) or data is None:
        return np.zeros(0, np.uint8), np.zeros(len(texts) + 1, np.int64)
    places = np.frombuffer(places, np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    return np.frombuffer(data, np.uint8)[places[0] : places[-1]], places - places[0]


def _safe_cuts(data: np.ndarray, places: np.ndarray, whole: np.ndarray) -> np.ndarray:
    """Where texts begin, every single blank or line end between two others, and every mark behind an ASCII letter.

    Byte-level BPE never joins across these: the pre-tokenizer always ends a word there and takes a
    single blank as part of the word behind it. Texts marked in ``whole`` stay uncut.
    """
    white = _WHITE[data]
    lead = np.flatnonzero(_LEAD[data])
    if len(lead):
        byte, padded = data[lead], np.concatenate([data, np.zeros(2, np.uint8)])
        second, third = padded[lead + 1], padded[lead + 2]
        for w in _WIDE:
            here = (byte == w[0]) & (second == w[1])
            at = lead[here if len(w) == 2 else here & (third == w[2])]
            white[at] = True
            white[at + len(w) - 1] = True
    cut = _BLANK[data]
    cut[1:] &= ~white[:-1]
    cut[:-1] &= ~white[1:]
    some = places[1:] > places[:-1]
    cut[places[1:][some] - 1] = False
    cut[1:] |= _LETTER[data[:-1]] & _MARK[data[1:]]
    for i in np.flatnonzero(whole):
        cut[places[i] : places[i + 1]] = False
    cut[places[:-1][some]] = True
    return np.flatnonzero(cut)


def slices(texts: pa.Array, most: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of rows of about ``most`` bytes; a longer text is a range of its own."""
    _, places = _laid_out(texts)
    low = 0
    while low < len(texts):
        high = max(low + 1, int(np.searchsorted(places, places[low] + most, "right")) - 1)
        yield low, high
        low = high


class Encoder:
    """Ids of whole texts, equal to the library's own.

    Texts are cut where byte-level BPE never joins (``_safe_cuts``), the pieces of a batch are
    numbered by their content in Arrow, and the library's model encodes each distinct piece once. Its
    ids are kept in one array, for at most ``MOST_WORDS`` pieces; longer pieces are encoded again in
    each batch. What a text has is gathered from that array, with no Python object for a word.
    Texts that hold a special token, pieces with unusual characters, and files of another kind than
    byte-level BPE go through the library's whole path.
    """

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer, models, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        plain = self.tokenizer.normalizer is None and self.tokenizer.post_processor is None
        kind = isinstance(self.tokenizer.pre_tokenizer, pre_tokenizers.ByteLevel) and isinstance(self.model, models.BPE)
        added = list(self.tokenizer.get_added_tokens_decoder().values())
        self.special = [t.content for t in added]
        # an added token that takes in blanks or words beside it needs all of them
        self.by_word = plain and kind and self.tokenizer.pre_tokenizer.use_regex and not self.tokenizer.pre_tokenizer.add_prefix_space
        self.by_word = self.by_word and not any(t.lstrip or t.rstrip or t.single_word or t.normalized for t in added)
        self.letters = _letters()
        self.blank = chr(self.letters[32])
        self._forget()

    def _forget(self, keep: int = 0) -> None:
        """Drop all pieces but the ``keep`` that were met in the most slices."""
        names = list(self.known) if keep else []
        n = len(names)
        best = np.sort(np.argsort(self.hits[:n], kind="stable")[n - keep :]) if n > keep else np.arange(n)
        first, length = (self.first[best], self.length[best]) if keep else (np.zeros(0, np.int64), np.zeros(0, np.int64))
        ends = length.cumsum()
        ids = self.pool[np.repeat(first - ends + length, length) + np.arange(length.sum())] if keep else np.zeros(0, "<u4")
        self.known: dict[bytes, int] = {names[i]: k for k, i in enumerate(best.tolist())}
        self.parts: dict[str, list[int]] = {}
        self.used, self.words = len(ids), len(best)
        self.pool = np.concatenate([ids, np.zeros(1 << 16, "<u4")])
        spare = np.zeros(1 << 14, np.int64)
        self.first, self.length = np.concatenate([ends - length, spare]), np.concatenate([length, spare])
        self.hits = np.concatenate([np.zeros_like(length), spare])

    def _whole(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def _word(self, word: str) -> list[int]:
        return [t.id for t in self.model.tokenize(word.encode().decode("latin-1").translate(self.letters))]

    def _piece(self, piece: bytes) -> list[int]:
        if piece[:1] == b" " and piece[1:].isalpha():  # ASCII letters stand for themselves
            return [t.id for t in self.model.tokenize(self.blank + piece[1:].decode())]
        text = piece.decode()
        if _ODD.search(text) or any(s in text for s in self.special):
            return self._whole(text)
        if text[0] == " " and text[1:].isalpha():
            return self._word(text)
        out: list[int] = []
        for word in _SPLIT.findall(text):
            ids = self.parts.get(word)
            if ids is None:
                ids = self._word(word)
                if len(word) < 5 and len(self.parts) < MOST_WORDS:
                    self.parts[word] = ids
            out += ids
        return out

    def _lay(self, ids: Sequence[int]) -> int:
        """A new number for a piece of these ids, which are laid at the end of the pool."""
        while self.used + len(ids) > len(self.pool):
            self.pool = np.concatenate([self.pool, np.zeros_like(self.pool)])
        if self.words == len(self.first):
            self.first, self.length, self.hits = (np.concatenate([x, np.zeros_like(x)]) for x in (self.first, self.length, self.hits))
        self.pool[self.used : self.used + len(ids)] = ids
        self.first[self.words], self.length[self.words], self.hits[self.words] = self.used, len(ids), 0
        self.used, self.words = self.used + len(ids), self.words + 1
        return self.words - 1

    def _numbers(self, pieces: list[bytes]) -> np.ndarray:
        """The numbers of distinct pieces; long ones come last, so that they can be dropped again."""
        known = self.known
        out = np.fromiter((known.get(p, -1) for p in pieces), np.int64, len(pieces))
        new = np.flatnonzero(out < 0).tolist()
        for i in new:
            if len(pieces[i]) <= LONGEST_KEPT:
                out[i] = known[pieces[i]] = self._lay(self._piece(pieces[i]))
        for i in new:
            if len(pieces[i]) > LONGEST_KEPT:
                out[i] = self._lay(self._piece(pieces[i]))
        self.hits[out] += 1
        return out

    def _encoded(self, texts: pa.Array, with_ids: bool) -> tuple[np.ndarray | None, np.ndarray]:
        if not self.by_word:
            got = [self._whole(t) for t in texts.to_pylist()]
            ids = np.array([i for g in got for i in g], "<u4") if with_ids else None
            return ids, np.array([len(g) for g in got], np.int64)
        data, places = _laid_out(texts)
        if not len(data):
            return np.zeros(0, "<u4"), np.zeros(len(texts), np.int64)
        if len(self.known) > MOST_WORDS:
            self._forget(MOST_WORDS // 2)
        whole = np.zeros(len(texts), bool)
        for token in self.special:
            whole |= pc.match_substring(texts, token).to_numpy(zero_copy_only=False)
        starts = _safe_cuts(data, places, whole)
        bounds = pa.py_buffer(np.append(starts, len(data)).astype(np.int32))
        numbered = pa.Array.from_buffers(pa.binary(), len(starts), [None, bounds, pa.py_buffer(data)]).dictionary_encode()
        flat, ends = numbered.dictionary.buffers()[2].to_pybytes(), np.frombuffer(numbered.dictionary.buffers()[1], np.int32)
        ends = ends[: len(numbered.dictionary) + 1].tolist()
        pieces = [flat[a:b] for a, b in zip(ends, ends[1:])]  # noqa: B905
        of = self._numbers(pieces)[numbered.indices.to_numpy()]
        length = self.length[of]
        before = np.concatenate([[0], length.cumsum()])
        rows = np.searchsorted(starts, places)
        counts = before[rows[1:]] - before[rows[:-1]]
        ids = None
        if with_ids:
            ids = self.pool[np.repeat(self.first[of] - before[:-1], length) + np.arange(before[-1])]
        # long pieces were numbered last: what lies behind the kept ones is free again
        kept = len(self.known)
        self.words, self.used = kept, (int(self.first[kept - 1] + self.length[kept - 1]) if kept else 0)
        return ids, counts

    def encode_array(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts behind one another as little-endian unsigned 32-bit integers, and how many each text has."""
        return self._encoded(texts, True)

    def count_array(self, texts: pa.Array) -> np.ndarray:
        """How many ids each text has."""
        return self._encoded(texts, False)[1]

    def encode(self, texts: Sequence[str] | pa.Array) -> list[bytes]:
        """The ids of each text as little-endian unsigned 32-bit bytes."""
        ids, counts = self.encode_array(texts if isinstance(texts, pa.Array) else pa.array(texts, pa.string()))
        data, ends = ids.tobytes(), counts.cumsum()
        return [data[4 * (e - n) : 4 * e] for e, n in zip(ends.tolist(), counts.tolist(), strict=True)]


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One encoder for each file and worker, kept between tasks."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def default_path() -> str:
    """The byte-level vocabulary of 50,257 ids where the public tokenizer files are installed."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")
