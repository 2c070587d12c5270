"""Statistics of whole texts for the quality classifier, many texts at once. Runs inside tasks."""

from __future__ import annotations

import numpy as np

from .words import Words, chunks, shingles

NAMES = (
    "words", "word_length", "distinct_words", "repeated_windows", "repeated_words_in_a_row", "symbols", "marks", "upper", "digits",
    "stops", "lines", "repeated_lines", "beyond_ascii", "longest_word",
)
_CLASSES = {"symbols": b"#*$%&|<>=~^_\\{}[]", "marks": b"!?", "upper": bytes(range(65, 91)), "digits": bytes(range(48, 58)), "stops": b".,;:"}


def _table(members: bytes) -> np.ndarray:
    out = np.zeros(256, np.int64)
    out[list(members)] = 1
    return out


_TABLES = {name: _table(members) for name, members in _CLASSES.items()}
_BEYOND = _table(bytes(range(128, 256)))
_LINE_ENDS = _table(b"\n").astype(bool)


def _distinct(values: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per text, the number of different values and of values that occur more than once."""
    text = np.repeat(np.arange(len(bounds) - 1, dtype=np.uint64), np.diff(bounds))
    keys = np.sort((text << np.uint64(44)) | (values >> np.uint64(20)))
    first = np.ones(len(keys), bool)
    first[1:] = keys[1:] != keys[:-1]
    alone = first & np.append(first[1:], True)
    upto = lambda flags: np.concatenate([[0], np.cumsum(flags)])[bounds]
    return np.diff(upto(first)), np.diff(bounds) - np.diff(upto(alone))


def text_statistics(texts: list[str | None], chunk_bytes: int = 1 << 20) -> np.ndarray:
    """One row of NAMES per text; null counts as empty. Empty texts have zeros."""
    encoded = [(t or "").encode("utf-8", "replace") for t in texts]
    parts = [_statistics(encoded[a:b]) for a, b in chunks([len(t) for t in encoded], chunk_bytes)]
    return np.concatenate(parts) if parts else np.zeros((0, len(NAMES)))


def _statistics(texts: list[bytes]) -> np.ndarray:
    words = Words(texts)
    n, bounds = words.counts, words.bounds
    lengths = words.ends - words.starts
    size = np.array([len(t) for t in texts])
    per = lambda x, y: x / np.maximum(y, 1)
    edges = np.append(words.starts_of_texts[:-1], len(words.buffer) - 1)
    within = lambda table: np.diff(np.concatenate([[0], np.cumsum(table[words.buffer])])[edges])
    chars = np.concatenate([[0], np.cumsum(lengths)])
    in_words = np.diff(chars[bounds])
    hashes = words.hashes
    distinct, _ = _distinct(hashes, bounds)
    windows, window_bounds = shingles(hashes, bounds, 3)
    _, repeated = _distinct(windows, window_bounds)
    same = np.zeros(len(hashes) + 1, np.int64)
    if len(hashes) > 1:
        inner = np.ones(len(hashes), bool)
        inner[bounds[:-1][bounds[:-1] < len(hashes)]] = False
        same[1:] = np.cumsum(np.append(False, hashes[1:] == hashes[:-1]) & inner)
    lines = Words(texts, _LINE_ENDS, b"\n")
    n_lines = lines.counts
    different, _ = _distinct(lines.hashes, lines.bounds)
    longest = np.zeros(len(texts))
    full = n > 0
    if full.any():
        longest[full] = np.maximum.reduceat(lengths, bounds[:-1][full])
    columns = [
        np.log1p(n), per(in_words, n), per(distinct, n), per(repeated, np.diff(window_bounds)), per(np.diff(same[bounds]), n),
        per(within(_TABLES["symbols"]), in_words), per(within(_TABLES["marks"]), in_words), per(within(_TABLES["upper"]), in_words),
        per(within(_TABLES["digits"]), in_words), per(within(_TABLES["stops"]), n), per(n_lines, n), per(n_lines - different, n_lines),
        per(within(_BEYOND), size), longest,
    ]
    return np.column_stack(columns).astype(float)
