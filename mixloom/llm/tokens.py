"""Encoding of whole texts with a tokenizer of the tokenizers library, and where tokens stand in the text.

A tokenizer encodes each piece that its pre-tokenizer cuts on its own, and no piece reaches over the place before a run
of other characters and the one white space that stands before it. So texts are cut there, over the bytes of a whole column at once,
Arrow's dictionary finds the different units among them, and each of these is encoded once and remembered by the worker process, up
to ``REMEMBERED`` at a time: beyond that the half used least is forgotten. That is done for texts of Latin-1 characters, whose
cutting, lower case and normal form are plain; any other text, and one that holds a special token's string, is encoded as a whole.
"""

from __future__ import annotations

import hashlib
import re
import sys
import types

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

REMEMBERED = 1_000_000
#: Units of more bytes are encoded each time that they are met, so that what is remembered is bounded in bytes too.
LONGEST = 128
_ODD = re.compile(r"[^\t\n\v\f\r\x20-\x7e\xa1-\xff]")
# Letters, and other numbers than digits, of Latin-1.
_LETTERS = "A-Za-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-\xff"
_NUMBERS = "0-9\xb2\xb3\xb9\xbc-\xbe"
# How the two kinds of tokenizers cut texts.
PIECES = {
    "words": rf"[{_LETTERS}]+|'s|'t|'re|'ve|'m|'ll|'d|[{_NUMBERS}]|[^\s{_LETTERS}{_NUMBERS}]+",
    "bytes": rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{_LETTERS}]+| ?[{_NUMBERS}]+| ?[^\s{_LETTERS}{_NUMBERS}]+|\s+(?!\S)|\s+",
}
_SPACES = (9, 10, 11, 12, 13, 32)


def _flags(*values: int) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(values)] = True
    return out


def _buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts and where each begins, with the end of the last."""
    offsets = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + len(texts) + 1]
    if not texts.buffers()[2]:
        return np.empty(0, np.uint8), offsets - offsets[0]
    return np.frombuffer(texts.buffers()[2], np.uint8)[offsets[0] : offsets[-1]], offsets - offsets[0]


class Encoder:
    """``kind``: ``words`` for lower-cased words without white space, ``bytes`` for byte-level pieces of all text."""

    def __init__(self, definition: str, kind: str):
        from tokenizers import Tokenizer, normalizers, pre_tokenizers

        self._tokenizer = Tokenizer.from_str(definition)
        self._tokenizer.no_padding()
        self._tokenizer.no_truncation()
        self.special = [t.content for t in self._tokenizer.get_added_tokens_decoder().values()]
        self.words = kind == "words"
        self.cut = re.compile(PIECES[kind]).findall
        levels = [pre_tokenizers.Split("\x00", "removed"), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)]
        # How whole texts are prepared, and how pieces that are cut already and stand between zero characters: one
        # tokenizer serves both, as its tables are large.
        self.whole = (self._tokenizer.normalizer or normalizers.Sequence([]), self._tokenizer.pre_tokenizer)
        self.by_piece = (normalizers.Sequence([]), pre_tokenizers.Sequence(levels))
        self.sizes = token_bytes(self._tokenizer)
        self.space = _flags(*_SPACES)
        # Controls, and first bytes of characters beyond Latin-1.
        self.strange = _flags(*set(range(32)) - set(_SPACES), 127, *range(0xC4, 256))
        # An Arrow column of units, so that a million of them take few bytes; then the ids of each and how often it was met.
        self.known = pa.array([], pa.string())
        self.flat, self.lengths, self.uses = np.empty(0, np.uint32), np.empty(0, np.int32), np.empty(0, np.int32)

    def _prepared(self, way: tuple):
        self._tokenizer.normalizer, self._tokenizer.pre_tokenizer = way
        return self._tokenizer

    @property
    def tokenizer(self):
        """The tokenizer for whole texts."""
        return self._prepared(self.whole)

    def plain(self, text: str) -> bool:
        return _ODD.search(text) is None and not any(s in text for s in self.special)

    def _odd(self, texts: pa.Array) -> np.ndarray:
        """Which texts are encoded as a whole."""
        data, starts = _buffers(texts)
        strange = self.strange[data]
        # Of the characters from 128 on, those below 161 are no plain ones.
        strange[:-1] |= (data[:-1] == 0xC2) & (data[1:] < 0xA1)
        odd = np.diff(np.searchsorted(np.flatnonzero(strange), starts)) > 0
        for special in self.special:
            odd |= pc.match_substring(texts, special).to_numpy(zero_copy_only=False)
        return odd

    def _units(self, texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
        """Units of all texts, and how many each text has."""
        data, starts = _buffers(texts)
        space = self.space[data]
        begins = np.zeros(len(data) + 1, bool)
        begins[: max(0, len(data) - 1)] = space[:-1] & ~space[1:]
        begins[starts] = True
        at = np.flatnonzero(begins).astype(np.int32)
        units = pa.StringArray.from_buffers(len(at) - 1, pa.py_buffer(at), pa.py_buffer(np.ascontiguousarray(data)))
        return units, np.diff(np.searchsorted(at, starts))

    def _encoded(self, units: list[str]) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """Ids of units, and how many each has: that many as make up its bytes without what stands between pieces."""
        flat, lengths, tokenizer = [], [], self._prepared(self.by_piece)
        for at in range(0, len(units), 1000):
            cut = ["\x00".join(self.cut(u)) for u in units[at : at + 1000]]
            (encoded,) = tokenizer.encode_batch_fast(["\x00".join(cut)], add_special_tokens=False)
            ids = np.array(encoded.ids, np.uint32)
            ends = np.cumsum([len(c.encode()) - c.count("\x00") for c in cut])
            upto = np.searchsorted(np.cumsum(self.sizes[ids]), ends, side="right")
            flat.append(ids)
            lengths.append(np.diff(upto, prepend=0).astype(np.int32))
        return flat, lengths

    def _forget(self, most: int) -> None:
        keep = np.zeros(len(self.lengths), bool)
        keep[np.argpartition(self.uses, -(most // 2))[-(most // 2) :]] = True
        self.flat = self.flat[np.repeat(keep, self.lengths)]
        self.lengths, self.uses = self.lengths[keep], self.uses[keep] >> 1
        self.known = self.known.filter(pa.array(keep))

    def _plain_ids(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        if self.words:
            texts = pc.utf8_lower(texts)
        units, counts = self._units(texts)
        coded = units.dictionary_encode()
        different, number = coded.dictionary, coded.indices.to_numpy()
        found = pc.index_in(different, value_set=self.known)
        fresh = different.filter(found.is_null())
        long = pc.greater(pc.binary_length(fresh), LONGEST)
        # The long ones come last, as they are not kept.
        order = np.argsort(long.to_numpy(zero_copy_only=False), kind="stable")
        more, own = self._encoded(fresh.take(pa.array(order)).to_pylist())
        flat, lengths = np.concatenate([self.flat, *more]), np.concatenate([self.lengths, *own])
        place = pc.fill_null(found, 0).to_numpy().astype(np.int64)
        place[np.flatnonzero(found.is_null().to_numpy(zero_copy_only=False))[order]] = len(self.known) + np.arange(len(order))
        met = np.zeros(len(lengths), np.int32)
        met[place] = np.bincount(number, minlength=len(different))
        starts = (np.cumsum(lengths, dtype=np.int64) - lengths).astype(np.int32)
        at = place[number]
        own_lengths = lengths[at]
        ends = np.cumsum(own_lengths, dtype=np.int64)
        shift = (starts[at] - (ends - own_lengths)).astype(np.int32)
        ids = flat[np.repeat(shift, own_lengths) + np.arange(ends[-1] if len(ends) else 0, dtype=np.int32)]
        kept = len(lengths) - (pc.sum(long).as_py() or 0)
        self.known = pa.concat_arrays([self.known, fresh.filter(pc.invert(long))])
        self.flat, self.lengths = flat[: int(lengths[:kept].sum())], lengths[:kept]
        self.uses = np.concatenate([self.uses, np.zeros(kept - len(self.uses), np.int32)]) + met[:kept]
        if kept > REMEMBERED:
            self._forget(REMEMBERED)
        return ids, np.diff(np.concatenate([[0], ends])[np.concatenate([[0], np.cumsum(counts)])])

    def encode_column(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts one after the other, and how many each has; a null text is empty."""
        texts = pc.fill_null(texts.cast(pa.string()), "")
        odd = self._odd(texts)
        if not odd.any():
            return self._plain_ids(texts)
        flat, lengths = self._plain_ids(texts.filter(pa.array(~odd)))
        counts = np.zeros(len(texts), np.int64)
        counts[~odd] = lengths
        parts = np.split(flat, np.cumsum(lengths)[:-1]) if len(lengths) else []
        own: list[np.ndarray] = [np.empty(0, np.uint32)] * len(texts)
        for n, ids in zip(np.flatnonzero(~odd), parts):
            own[n] = ids
        for n in np.flatnonzero(odd):
            own[n] = np.array(self.tokenizer.encode_batch_fast([texts[n].as_py()], add_special_tokens=False)[0].ids, np.uint32)
            counts[n] = len(own[n])
        return np.concatenate(own), counts

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text."""
        if not texts:
            return []
        ids, counts = self.encode_column(pa.array(texts, pa.string()))
        return np.split(ids, np.cumsum(counts)[:-1])


def worker_encoder(definition: str, kind: str) -> Encoder:
    """The worker process's encoder of a definition, made once: later tasks find what earlier ones remembered."""
    kept = sys.modules.setdefault("_kept_encoders", types.ModuleType("_kept_encoders"))
    key = hashlib.sha256(f"{kind}\n{definition}".encode()).hexdigest()
    if key not in vars(kept):
        vars(kept).clear()
        setattr(kept, key, Encoder(definition, kind))
    return getattr(kept, key)


def token_bytes(tokenizer) -> np.ndarray:
    """Bytes of each token of a byte-level vocabulary, in which each character stands for a byte."""
    suffix = getattr(tokenizer.model, "end_of_word_suffix", None) or ""
    out = np.zeros(tokenizer.get_vocab_size(with_added_tokens=True), np.int64)
    for token, n in tokenizer.get_vocab(with_added_tokens=True).items():
        out[n] = len(token) - (len(suffix) if suffix and token.endswith(suffix) else 0)
    return out


def spans(text: str, ids: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First character and end of each token of a Latin-1 text of which tokens leave out nothing."""
    wide = 1 + (np.frombuffer(text.encode("latin-1"), np.uint8) >= 128)
    character = np.repeat(np.arange(len(text)), wide)
    ends = np.cumsum(sizes[ids])
    return character[ends - sizes[ids]], character[ends - 1] + 1
