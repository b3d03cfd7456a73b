"""Token ids of whole texts by the ``tokenizers`` library, with a cache of text units.

Both vocabularies cut a text at single white space before they merge, so the ids
of a text are those of its space-separated units in turn. A unit that was met
before is looked up; new units of a batch are encoded by the library in one call.
Texts for which the cut is not certain (runs of white space, unusual spaces,
zero characters) are encoded whole by the library. Strings of special tokens
count as ordinary text.
"""

from __future__ import annotations

import os
import unicodedata
from array import array

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from paysignal.llm.task_memory import holders
from paysignal.llm.words import text_buffers

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

CACHE_UNITS = 500_000
_CALL_CHARS = 1 << 18
_CALL_WORDS = 32
_FIRST, GLUED = "\x00", "\x02"
# Marks that often follow a word; they are units of their own, so that fewer units differ.
_MARKS = (",", ".")
# White space that only some of the involved libraries know as such.
_UNUSUAL = ("\x00", "\x02", "\x1c", "\x1d", "\x1e", "\x1f")
_IS_UNUSUAL = np.zeros(32, dtype=bool)
_IS_UNUSUAL[[ord(c) for c in _UNUSUAL]] = True

_PUNCTUATION = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"


def _shown_bytes() -> dict[int, int]:
    """Byte-level vocabularies write a byte that is no printable character as the next free code point from 256 on."""
    printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
    hidden = [b for b in range(256) if b not in printable]
    return {b: 256 + i for i, b in enumerate(hidden)}


_SHOWN = _shown_bytes()
_SHOWN_SPACE = chr(_SHOWN[32])
_SHOWN_CODES = np.array([_SHOWN.get(b, b) for b in range(256)], dtype="<u2")
_SHOWN_END = chr(_SHOWN[0])


class UnitEncoder:
    """Ids as little-endian 16-bit bytes; vocabularies here have fewer than 65 536 ids."""

    def __init__(self, path: str, keeps_space: bool, cache_units: int = CACHE_UNITS):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        if self.tokenizer.get_vocab_size() > 1 << 16:
            raise ValueError("ids do not fit 16 bits")
        self.keeps_space = keeps_space
        self.cache: dict[str, bytes | bool] = {}
        self.cache_units = cache_units
        self.mark = "\n" if keeps_space else " \x00 "
        self.mark_id = self._ids("\n" if keeps_space else "\x00")
        if len(self.mark_id) != 1:
            raise ValueError("the mark between units is not one id")
        self.mark_id = self.mark_id[0]
        self.newline = self.mark_id.to_bytes(2, "little")
        self.model = self.tokenizer.model
        self.older: dict[str, bytes | bool] = {}
        self.tails: dict[str, bytes] = {}
        # Words may be merged in one string if no token but its own holds the character between them.
        vocabulary = self.tokenizer.get_vocab()
        self.end_id = vocabulary.get(_SHOWN_END)
        self.words_apart = keeps_space and self.end_id is not None and not self.model.ignore_merges and not any((
            self.model.continuing_subword_prefix, self.model.end_of_word_suffix)) and not any(
            _SHOWN_END in token and token != _SHOWN_END for token in vocabulary)

    def _ids(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def whole(self, text: str) -> np.ndarray:
        return np.array(self._ids(text), dtype="<u2")

    def _units(self, texts: pa.Array) -> pa.ListArray:
        """Units as cache keys: the first one of a text and of a line have a mark in front."""
        for mark in _MARKS:
            texts = pc.replace_substring(texts, f"{mark} ", f" {GLUED}{mark} ")
        if not self.keeps_space:
            return pc.utf8_split_whitespace(texts)
        texts = pc.binary_join_element_wise(_FIRST, texts, "")
        for mark in _MARKS:
            texts = pc.replace_substring(texts, f"{mark}\n", f" {GLUED}{mark}\n")
        return pc.split_pattern(pc.replace_substring(texts, "\n", " \n"), " ")

    def _found(self, units: list[str]) -> list[bytes | bool]:
        """Ids of all units. What was used lately stays when the cache is full."""
        if len(self.cache) > self.cache_units // 2:
            self.older, self.cache = self.cache, {}
        found = list(map(self.cache.get, units))
        missing = [i for i, ids in enumerate(found) if ids is None]
        new = []
        for i in missing:
            unit = units[i]
            ids = self.older.get(unit)
            if ids is None:
                new.append(unit)
            else:
                self.cache[unit] = ids
        self._learn(new)
        for i in missing:
            found[i] = self.cache[units[i]]
        return found

    def _simple(self, unit: str) -> bytes | None:
        """Ids of letters followed by plain punctuation: two pieces that merge apart."""
        lead = ""
        if self.keeps_space and unit[:1] in (_FIRST, "\n"):
            lead, unit = unit[:1], unit[1:]
        word = unit.rstrip(_PUNCTUATION)
        if not word.isalpha():
            return None
        shown = word
        if not self.keeps_space:
            shown = word.lower() if word.isascii() else unicodedata.normalize("NFC", word).lower()
            if not shown.isalpha() or "\u03c2" in shown:  # a final sigma is lower-cased by its place
                return None
        if not shown.isascii():
            shown = shown.encode().decode("latin-1").translate(_SHOWN)
        if self.keeps_space and not lead:
            shown = _SHOWN_SPACE + shown
        found = array("H", [t.id for t in self.model.tokenize(shown)]).tobytes()
        if len(word) < len(unit):
            found += self._tail(unit[len(word) :])
        return self.newline + found if lead == "\n" else found

    def _tail(self, tail: str) -> bytes:
        if tail not in self.tails:
            self.tails[tail] = self.whole(tail).tobytes()
        return self.tails[tail]

    def _learn_words(self, units: list[str]) -> list[str]:
        """Adds units of letters followed by plain punctuation, many words in one call of the model; returns the others."""
        words, rest, known, marked = [], [], [], []
        for unit in units:
            word = unit.rstrip(_PUNCTUATION)
            if word.isalpha():
                words.append(" " + word)
                if len(word) < len(unit):
                    marked.append(len(known))
            elif unit[:1] in (_FIRST, "\n") and word[1:].isalpha():
                words.append(word[1:])
                marked.append(len(known))
            else:
                rest.append(unit)
                continue
            known.append(unit)
        if not words:
            return rest
        ids = array("H")
        for i in range(0, len(words), _CALL_WORDS):
            raw = np.frombuffer("\x00".join(words[i : i + _CALL_WORDS]).encode(), dtype=np.uint8)
            shown = _SHOWN_CODES[raw].tobytes().decode("utf-16-le")
            ids.extend([t.id for t in self.model.tokenize(shown)])
            ids.append(self.end_id)
        raw, ends = ids.tobytes(), np.flatnonzero(np.array(ids, dtype="<u2") == self.end_id) * 2
        found = [raw[a:b] for a, b in zip([0, *(ends[:-1] + 2).tolist()], ends.tolist(), strict=True)]
        for i in marked:
            unit = known[i]
            n = len(unit.rstrip(_PUNCTUATION))
            if n < len(unit):
                found[i] += self._tail(unit[n:])
            if unit[0] == "\n":
                found[i] = self.newline + found[i]
        self.cache.update(zip(known, found, strict=True))
        return rest

    def _learn(self, units: list[str]) -> None:
        """Adds new units; False for those whose ids depend on their neighbours."""
        if self.words_apart:
            units = self._learn_words(units)
        sure, size = [], 0
        for unit in units:
            if unit[:1] == GLUED:
                self.cache[unit] = self.whole(unit[1:]).tobytes()
                continue
            found = self._simple(unit)
            if found is not None:
                self.cache[unit] = found
                continue
            plain = unit[1:] if unit[:1] in (_FIRST, "\n") else unit
            if plain.split() != [plain] and (self.keeps_space or plain):
                self.cache[unit] = False
                continue
            sure.append(unit)
            size += len(unit)
            if size > _CALL_CHARS:
                self._encode(sure)
                sure, size = [], 0
        if sure:
            self._encode(sure)

    def _encode(self, units: list[str]) -> None:
        if self.keeps_space:
            shown = [u[1:] if u[:1] in (_FIRST, "\n") else " " + u for u in units]
        else:
            shown = units
        ids = np.array(self._ids(self.mark + self.mark.join(shown)), dtype=np.uint32)
        limits = np.append(np.flatnonzero(ids == self.mark_id), len(ids))
        if len(limits) != len(units) + 1:
            raise AssertionError("units and ids do not match")
        raw = ids.astype("<u2").tobytes()
        for unit, a, b in zip(units, (limits[:-1] + 1).tolist(), limits[1:].tolist(), strict=True):
            found = raw[2 * a : 2 * b]
            self.cache[unit] = self.newline + found if self.keeps_space and unit[0] == "\n" else found

    def encode(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of a text column and the limits of its rows in them; null counts as empty."""
        texts = pc.fill_null(column, "")
        data, rows = text_buffers(texts)
        low = np.flatnonzero(data < len(_IS_UNUSUAL))
        unusual = np.zeros(len(texts), dtype=bool)
        unusual[np.searchsorted(rows, low[_IS_UNUSUAL[data[low]]], side="right") - 1] = True
        empty = np.diff(rows) == 0
        cut = self._units(pc.if_else(pa.array(unusual), "", texts) if unusual.any() else texts)
        coded = cut.flatten().dictionary_encode()
        units = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        index = coded.indices.to_numpy(zero_copy_only=False)
        limits = np.asarray(cut.offsets, dtype=np.int64)
        limits = limits - limits[0]
        found = self._found(units)
        unsure = np.zeros(len(found), dtype=bool)
        if False in found:
            unsure = np.array([f is False for f in found], dtype=bool)
            found = [f or b"" for f in found]
        raw, before = text_buffers(pa.array(found, pa.large_binary()).take(coded.indices))
        ids, before = raw.view("<u2"), before // 2
        bounds = before[limits]
        whole = unusual
        if len(index) and unsure.any():
            marks = np.concatenate(([0], np.cumsum(unsure[index])))[limits]
            whole = whole | (np.diff(marks) > 0)
        glued = pc.starts_with(coded.dictionary, GLUED).to_numpy(zero_copy_only=False)
        if glued.any():  # a mark stands alone only after a letter or number
            fine = pc.utf8_is_alnum(pc.utf8_slice_codeunits(coded.dictionary, -1)).to_numpy(zero_copy_only=False)
            bad = glued[index]
            bad[1:] &= ~fine[index[:-1]]
            if bad.any():
                whole = whole | (np.diff(np.concatenate(([0], np.cumsum(bad)))[limits]) > 0)
        whole = whole & ~empty
        rows = np.flatnonzero(whole)
        clear = empty & (np.diff(bounds) > 0)
        if not len(rows) and not clear.any():
            return ids, bounds
        parts = [ids[bounds[i] : bounds[i + 1]] for i in range(len(texts))]
        for i in rows:
            parts[i] = self.whole(texts[int(i)].as_py())
        for i in np.flatnonzero(clear):
            parts[i] = ids[:0]
        return np.concatenate(parts), np.concatenate(([0], np.cumsum([len(x) for x in parts])))


_encoders: dict[tuple[str, bool], UnitEncoder] = {}
HOLDER = "units"
holders[HOLDER] = _encoders.clear


def encoder(path: str, keeps_space: bool, cache_units: int = CACHE_UNITS) -> UnitEncoder:
    """One encoder per worker process; its cache outlives the tasks, until a task of another operator clears it."""
    if (path, keeps_space) not in _encoders:
        _encoders.clear()
        _encoders[(path, keeps_space)] = UnitEncoder(path, keeps_space, cache_units)
    return _encoders[(path, keeps_space)]


def id_bytes(ids: np.ndarray) -> bytes:
    """Ids as little-endian 32-bit numbers."""
    return ids.astype("<u4").tobytes()
