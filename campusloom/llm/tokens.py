"""Token ids of whole texts by the tokenizers library, as little-endian unsigned 32-bit bytes."""

from __future__ import annotations

import re
from array import array
from collections.abc import Callable
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from .words import chunks

_MOST_KEPT = 800_000  # of each of two generations
_MOST_BYTES = 4 << 20  # of texts that are split at once
_MERGED = 50  # words in one call of the library
_LETTERS = "A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f"
_LETTERS_ONLY = f"^\\r?[{_LETTERS}]+$"
_USUAL = re.compile(f" ?[\\x21-\\x7e{_LETTERS}]+")
#: The file's pattern for text without white space but a first space, over usual characters.
_PIECES = re.compile(f"'(?:[stmd]|re|ve|ll)| ?[{_LETTERS}]+| ?[0-9]+| ?[^ {_LETTERS}0-9]+")
# For Arrow: white space but space and line end; a stop that the pattern may join to what precedes it;
# in the form of _parts, nothing between two spaces, or a line end beside white space.
_OTHER_SPACE = r"[\t\x0b-\r\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
_ODD_STOP = f"[^{_LETTERS}0-9][,.][ \\n]"
_EMPTY, _SPACE, _LINE_END, _START = (pa.scalar(x, pa.large_string()) for x in ("", " ", "\n", "\r"))
_ODD_GAP = r"  | \r |^\r | \r?\z|^\r\z"


def _byte_signs() -> np.ndarray:
    """Byte-level files write a printable byte as its Latin-1 character and the others, in order, from 256 on."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    hidden = [b for b in range(256) if b not in shown]
    signs = {b: b for b in shown} | {b: 256 + k for k, b in enumerate(hidden)}
    return np.array([signs[b] for b in range(256)], "<u2")


_SIGNS = _byte_signs()


class TextEncoder:
    """Encodes texts with a byte-level BPE file whose pattern never joins two words over a single space.

    In a text whose only white space is single spaces and line ends between words, every space
    starts a new part and a line end is a part of its own, so that " word" has the same ids in
    every such text and is kept. Arrow splits many texts at once and numbers their distinct parts, so that
    Python code runs for new words only. Words of usual characters are split by the file's pattern here and
    merged by the library's model, many in a call; any other word or text goes to the library whole. The kept
    words are bounded: when full they become the older generation, from which words that come again are taken
    over. A text that holds the string of a special token is given to the library as it is, which makes it that token.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        added = sorted(t.content for t in self.tokenizer.get_added_tokens_decoder().values())
        self.foreign = "|".join([_OTHER_SPACE, *map(re.escape, added)])
        self.merge = self.tokenizer.model.tokenize
        # Words have no line end; its place in their signs is taken by a byte that UTF-8 never has.
        self.signs = _SIGNS.copy()
        self.signs[10] = _SIGNS[255]
        gap = chr(_SIGNS[255])
        if sum(gap in token for token in self.tokenizer.get_vocab()) != 1:
            raise ValueError(f"{path}: not a byte-level vocabulary of UTF-8 texts")
        self.gap = self.tokenizer.token_to_id(gap)
        self.kept = _Kept()

    def whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def encode(self, texts: list[str | None] | pa.Array) -> list[bytes]:
        """Ids of each text; null and empty texts have none."""
        out = []
        column = texts if isinstance(texts, pa.Array) else pa.array(texts, pa.large_string())
        for a, b in self.slices(column):
            ids, bounds = self.ids(column.slice(a, b - a))
            data, places = ids.tobytes(), (4 * bounds).tolist()
            out += [data[i:j] for i, j in zip(places, places[1:])]
        return out

    def slices(self, texts: pa.Array) -> list[tuple[int, int]]:
        """Bounds of slices of texts that ids() takes well at once."""
        return list(chunks(pc.fill_null(pc.binary_length(texts), 0).to_pylist(), _MOST_BYTES))

    def ids(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after another and the bounds by text; null and empty texts have none."""
        parts, whole = self._parts(pc.fill_null(texts.cast(pa.large_string()), _EMPTY))
        data, bounds = self._joined(parts.flatten(), parts.offsets.to_numpy(), self._words)
        ids, bounds = np.frombuffer(data, "<u4"), bounds // 4
        if whole:
            rows = [ids[a:b] for a, b in zip(bounds, bounds[1:])]
            for k, text in whole.items():
                rows[k] = np.frombuffer(self.whole(text), "<u4")
            ids, bounds = np.concatenate(rows), np.cumsum([0, *map(len, rows)])
        pa.default_memory_pool().release_unused()  # else a worker keeps twice the memory between slices
        return ids, bounds

    def _parts(self, texts: pa.Array) -> tuple[pa.Array, dict[int, str]]:
        """Words, line ends and the stops after words; the texts not of the form above, by place, which get an empty word.

        What follows a space in the text is given as it is, anything else with \\r before it.
        """
        stops = texts
        for old, new in ((", ", " \r, "), (". ", " \r. "), (".\n", " \r.\n")):
            stops = pc.replace_substring(stops, old, new)
        lines = pc.if_else(pc.match_substring_regex(texts, _ODD_STOP), texts, stops)
        lines = pc.binary_join_element_wise(_START, pc.replace_substring(lines, "\n", " \r\n \r"), _EMPTY)
        other = pc.or_(pc.match_substring_regex(texts, self.foreign), pc.match_substring_regex(lines, _ODD_GAP))
        places = np.flatnonzero(other.to_numpy(zero_copy_only=False))
        whole = dict(zip(places.tolist(), texts.take(pa.array(places)).to_pylist()))
        return pc.split_pattern(pc.if_else(other, _EMPTY, lines), " "), {k: t for k, t in whole.items() if t}

    def _joined(self, parts: pa.Array, bounds: np.ndarray, words: Callable[[pa.Array], pa.Array]) -> tuple[pa.Buffer, np.ndarray]:
        """Ids of parts one after another, and the bytes at which the parts of given numbers begin."""
        coded = parts.dictionary_encode()
        ids = words(coded.dictionary).take(coded.indices)
        _, ends, data = ids.buffers()
        places = np.frombuffer(ends, "<i8", len(ids) + 1)[bounds]
        return data.slice(0, int(places[-1])) if data else pa.py_buffer(b""), places

    def _words(self, words: pa.Array) -> pa.Array:
        """Ids of distinct words in the form of _parts."""
        out = [pa.array([], pa.large_binary())]
        for k in range(0, len(words), _MOST_KEPT):
            if len(self.kept) > _MOST_KEPT:
                self.kept.turn()
            out.append(self._some(words.slice(k, _MOST_KEPT)))
        return pa.concat_arrays(out)

    def _some(self, words: pa.Array) -> pa.Array:
        places = self.kept.find(words)
        new = np.flatnonzero(places < 0)
        places[new] = self._learn(words.take(pa.array(new)))
        return self.kept.ids.take(pa.array(places))

    def _learn(self, words: pa.Array) -> np.ndarray:
        """Keep new words, and give their places."""
        letters = pc.match_substring_regex(words, _LETTERS_ONLY).to_numpy(zero_copy_only=False)
        others = np.flatnonzero(~letters)
        single, composed, odd = np.flatnonzero(letters).tolist(), {}, {}
        for k, word in zip(others.tolist(), words.take(pa.array(others)).to_numpy(zero_copy_only=False).tolist()):
            text = word[1:] if word[:1] == "\r" else " " + word if word else ""
            if not _USUAL.fullmatch(text):
                odd[k] = self.whole(text)
            elif len(pieces := _PIECES.findall(text)) == 1:
                single.append(k)
            else:
                composed[k] = [p[1:] if p[0] == " " else "\r" + p for p in pieces]
        places = np.empty(len(words), np.int64)
        merged = words.take(pa.array(single, pa.int64()))
        places[single] = self.kept.add(merged, self._merged(merged))
        if odd:
            places[[*odd]] = self.kept.add(words.take(pa.array(odd)), pa.array(odd.values(), pa.large_binary()))
        if composed:
            pieces = pa.array(chain.from_iterable(composed.values()), pa.large_string())
            data, bounds = self._joined(pieces, np.cumsum([0, *map(len, composed.values())]), self._some)
            places[[*composed]] = self.kept.add(words.take(pa.array(composed)), _binary(bounds, data))
        return places

    def _merged(self, words: pa.Array) -> pa.Array:
        """Ids of words that are single parts of the file's pattern, by the library's model.

        Words in one call are parted by the sign of a byte that is in no merge, so that none reaches over it.
        """
        lines = pc.replace_substring(pc.binary_join_element_wise(_SPACE, words, _LINE_END, _EMPTY), " \r", "")
        _, ends, data = pa.concat_arrays([lines]).buffers()
        starts = np.frombuffer(ends, "<i8", len(lines) + 1)[[*range(0, len(lines), _MERGED), len(lines)]].tolist()
        signs = self.signs[np.frombuffer(data or b"", "u1", starts[-1])].tobytes().decode("utf-16-le")
        ids = array("I")
        for a, b in zip(starts, starts[1:]):
            ids.extend([t.id for t in self.merge(signs[a:b])])
        ids = np.array(ids, "<u4")
        gaps = np.flatnonzero(ids == self.gap)
        return _binary(np.concatenate([[0], 4 * (gaps - np.arange(len(gaps)))]), pa.py_buffer(np.delete(ids, gaps)))


def _binary(bounds: np.ndarray, data: pa.Buffer) -> pa.Array:
    """Binary values from their bounds and bytes."""
    return pa.Array.from_buffers(pa.large_binary(), len(bounds) - 1, [None, pa.py_buffer(bounds.astype("<i8")), data])


class _Kept:
    """Ids by word in two generations: words asked for since the last turn, and older ones."""

    def __init__(self):
        self.words, self.ids, self.asked = pa.array([], pa.large_string()), pa.array([], pa.large_binary()), np.zeros(0, bool)

    def __len__(self) -> int:
        return int(self.asked.sum())

    @property
    def older(self) -> pa.Array:
        return self.words.filter(pa.array(~self.asked))

    def turn(self) -> None:
        """Forget the older generation; what is left becomes the older one."""
        left = pa.array(self.asked)
        self.words, self.ids = self.words.filter(left), self.ids.filter(left)
        self.asked = np.zeros(len(self.words), bool)

    def find(self, words: pa.Array) -> np.ndarray:
        """Places of distinct words that are asked for, -1 for those not kept."""
        places = np.full(len(words), -1)
        number = pc.index_in(self.words, words)
        here = np.flatnonzero(number.is_valid().to_numpy(zero_copy_only=False))
        places[number.take(pa.array(here)).to_numpy()] = here
        self.asked[here] = True
        return places

    def add(self, words: pa.Array, ids: pa.Array) -> np.ndarray:
        """Keep new words; their places."""
        first = len(self.words)
        self.words, self.ids = pa.concat_arrays([self.words, words]), pa.concat_arrays([self.ids, ids])
        self.asked = np.concatenate([self.asked, np.ones(len(words), bool)])
        return np.arange(first, len(self.words))


_encoders: dict[str, TextEncoder] = {}


def encoder(path: str) -> TextEncoder:
    """One encoder per worker process and file."""
    if path not in _encoders:
        _encoders[path] = TextEncoder(path)
    return _encoders[path]
