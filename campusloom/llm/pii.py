"""Personal data: a character-level bidirectional LSTM with CRF transitions beside fixed rules.

The fixed rules (e-mail, ip, card, phone) always count. The tagger adds spans in forms that the
rules do not know, such as cards with dots or phones without a plus. It is trained from labelled
spans: windows of a bounded, hash-chosen sample of documents (`most_rows`, labelled by the rules)
and composed examples with known spans. Each text is covered by windows of 64 characters, 32 apart.
A window without a digit or an @ sign cannot hold any of the four kinds and is not decoded; all
others are. Where windows overlap, a character takes the tag of the window in which it lies
farthest from the edge, and spans are read from these tags over the whole text, so
that a span may run through any number of windows. An added span has to pass the checks of
its kind (digits, Luhn, parts) and must not touch a rule's span.

Null and empty texts have no spans. Positions are code points, ends exclusive. Repeated rows get
equal results. Other columns stay in `redact` and are ignored in `find`. No rows give no rows;
the tagger is then trained from composed examples alone.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tagger import Tagger, characters, fit

KINDS = ("email", "ip", "card", "phone")
Span = tuple[int, int, int]  # start, place in KINDS, end
WINDOW, STRIDE = 64, 32
_ROWS = 500
#: The rules' patterns, by kind; none matches over a line end.
PATTERNS = (
    re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    re.compile(r"(?<![0-9])[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    re.compile(r"[0-9]([\x20-]?[0-9])+"),
    re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"),
)
#: Where an e-mail can start unless right behind another; a run that fails from here fails from all its characters.
_FRESH_EMAIL = re.compile(r"(?<![A-Za-z0-9._%+-])" + PATTERNS[0].pattern)
_NEEDS = ("@", ".", "", "+")
_SIGN = re.compile(r"[0-9@]")
_DIGITS = re.compile(r"[0-9]")
# Tags: 0 none, 1 + 2k begins kind k, 2 + 2k goes on.
TAGS = 1 + 2 * len(KINDS)
ALLOWED = np.array([[b == 0 or b % 2 == 1 or a in (b, b - 1) for b in range(TAGS)] for a in range(TAGS)])


def luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        n = int(d) * (1 + k % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def valid(kind: int, text: str, rule: bool = True) -> bool:
    digits = "".join(_DIGITS.findall(text))
    if kind == 0:
        return rule or text.count("@") == 1 and "." in text.rpartition("@")[2] and not text.startswith("@")
    if kind == 1:
        parts = [p.lstrip("0") for p in re.findall(r"[0-9]+", text)]
        return len(parts) == 4 and all(len(p) < 4 and int(p or "0") <= 255 for p in parts)
    if kind == 2:
        return 14 <= len(digits) <= 19 and luhn(digits)
    return 10 <= len(digits) <= 15


def _matches(kind: int, line: str) -> Iterator[re.Match[str]]:
    """Leftmost matches in time linear in the line, also where a run of one kind of character is very long."""
    if kind:
        yield from PATTERNS[kind].finditer(line)
        return
    at = 0
    while found := PATTERNS[0].match(line, at) or _FRESH_EMAIL.search(line, at):
        yield found
        at = found.end()


def rule_spans(text: str) -> list[Span]:
    """Spans of the fixed rules by start, then kind; only lines with a digit or an @ sign are searched."""
    out: list[Span] = []
    start = 0
    if not _SIGN.search(text):
        return out
    for line in text.split("\n"):
        if _SIGN.search(line):
            for kind, need in enumerate(_NEEDS):
                if need in line:
                    out += [(start + m.start(), kind, start + m.end()) for m in _matches(kind, line) if valid(kind, m[0])]
        start += len(line) + 1
    return sorted(out)


def written(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in sorted(spans))


def window_starts(text: str) -> list[int]:
    """Starts of the windows that hold a digit or an @ sign."""
    starts: set[int] = set()
    for m in _SIGN.finditer(text):
        at = m.start()
        starts.update(s for s in (at // STRIDE * STRIDE, at // STRIDE * STRIDE - STRIDE) if s >= 0)
    return sorted(starts)


def tags_of(spans: list[Span], start: int) -> np.ndarray:
    """Tags of the window at `start`."""
    out = np.zeros(WINDOW, np.int64)
    for a, kind, b in spans:
        low, high = max(a - start, 0), min(b - start, WINDOW)
        if low < high:
            out[low:high] = 2 + 2 * kind
            if a >= start:
                out[low] = 1 + 2 * kind
    return out


def reconcile(length: int, starts: list[int], tags: np.ndarray) -> list[Span]:
    """Spans of a text from the tags of its overlapping windows."""
    if not starts:
        return []
    depth = np.minimum(np.arange(WINDOW), WINDOW - 1 - np.arange(WINDOW))
    at = (np.array(starts)[:, None] + np.arange(WINDOW)).ravel()
    order = np.lexsort((-np.tile(depth, len(starts)), at))
    at, flat = at[order], tags.ravel()[order]
    first = np.append(True, at[1:] != at[:-1]) & (at < length) & (flat > 0)
    out: list[Span] = []
    for place, tag in zip(at[first].tolist(), flat[first].tolist()):
        kind, begins = (tag - 1) // 2, tag % 2 == 1
        if out and out[-1][2] == place and out[-1][1] == kind and not begins:
            out[-1] = (out[-1][0], kind, place + 1)
        else:
            out.append((place, kind, place + 1))
    return out


def all_spans(texts: list[str | None], model: Tagger) -> list[tuple[list[Span], list[Span]]]:
    """By text, the rules' spans and all spans."""
    texts = [t or "" for t in texts]
    rules = [rule_spans(t) for t in texts]
    starts = [window_starts(t) for t in texts]
    chars = [characters(t[s : s + WINDOW], WINDOW) for t, own in zip(texts, starts) for s in own]
    tags = model.decode(np.array(chars)) if chars else np.zeros((0, WINDOW), np.int64)
    out, k = [], 0
    for text, base, own in zip(texts, rules, starts, strict=True):
        found = reconcile(len(text), own, tags[k : k + len(own)])
        k += len(own)
        added = []
        for a, kind, b in found:
            span = text[a:b]
            a, b = a + len(span) - len(span.lstrip(" ,;:.")), b - (len(span) - len(span.rstrip(" ,;:.")))
            if a < b and valid(kind, text[a:b], rule=False) and all(b <= x or a >= y for x, _, y in base):
                added.append((a, kind, b))
        out.append((base, sorted(base + added)))
    return out


# --- training -------------------------------------------------------------


def _luhn_number(rng: np.random.Generator, n: int) -> str:
    body = str(rng.integers(1, 10)) + "".join(map(str, rng.integers(0, 10, n - 2)))
    return next(body + str(d) for d in range(10) if luhn(body + str(d)))


def _grouped(digits: str, size: int, gap: str) -> str:
    return gap.join(digits[k : k + size] for k in range(0, len(digits), size))


def _example(rng: np.random.Generator) -> tuple[int, str]:
    """A kind (-1: none of them) and a string of it."""
    word = lambda n: "".join(map(chr, rng.integers(97, 123, n)))
    number = lambda n: "".join(map(str, rng.integers(0, 10, n)))
    pick = lambda *x: x[rng.integers(len(x))]
    kind = int(rng.integers(-2, 4))
    if kind == 0:
        host = f"{word(rng.integers(3, 9))}{pick('', '-', '') and '-x'}{pick('', number(1))}.{pick('com', 'org', 'example.com', 'net', 'de', 'co.uk')}"
        return 0, f"{word(rng.integers(2, 8))}{pick('.', '_', '', '+')}{pick(number(2), word(4))}{pick('@', '@', '@', ' @ ')}{host}"
    if kind == 1:
        return 1, ".".join(map(str, rng.integers(0, 256, 4)))
    if kind == 2:
        return 2, _grouped(_luhn_number(rng, int(pick(14, 15, 16, 16, 16, 19))), 4, pick("", "", " ", "-", ".", "/", "_"))
    if kind == 3:
        area, line = number(3), number(7)
        gap = pick("-", " ", ".")
        return 3, pick(f"+{rng.integers(1, 99)}{gap}{area}{gap}{line}", f"({area}) {line[:3]}-{line[3:]}", f"{area}{gap}{line[:3]}{gap}{line[3:]}", f"+1 ({area}) {line[:3]}-{line[3:]}", f"00{rng.integers(10, 99)} {area} {line}")
    return -1, pick(
        f"{rng.integers(0, 20)}.{rng.integers(0, 20)}", f"{rng.integers(0, 20)}.{rng.integers(0, 20)}.{rng.integers(0, 20)}", f"{rng.integers(1900, 2050)}", f"20{number(2)}-{number(2)}-{number(2)}",
        "".join(rng.choice(list("0123456789abcdef"), int(rng.integers(8, 41)))), "AKIA" + "".join(rng.choice(list("ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"), 16)), number(int(rng.integers(1, 10))), f"@{word(5)}", f"{number(1)},{number(3)}", f"{word(3)}{number(2)}",
    )


def composed(n: int, seed: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """n windows of invented words with examples in them, and their tags."""
    rng = np.random.default_rng(seed)
    chars, tags = np.empty((n, WINDOW), np.int64), np.empty((n, WINDOW), np.int64)
    for row in range(n):
        text, spans = "", []
        while len(text) < WINDOW + STRIDE:
            if rng.random() < 0.3:
                kind, example = _example(rng)
                if kind >= 0:
                    spans.append((len(text), kind, len(text) + len(example)))
                text += example + (" ", " ", ". ", ", ", "\n")[rng.integers(5)]
            else:
                word = "".join(map(chr, rng.integers(97, 123, rng.integers(1, 9))))
                text += (word.title() if rng.random() < 0.15 else word) + (" ", " ", " ", ". ", "\n")[rng.integers(5)]
        start = int(rng.integers(0, STRIDE))
        chars[row], tags[row] = characters(text[start : start + WINDOW], WINDOW), tags_of(spans, start)
    return chars, tags


def train(docs: DataFrame, most_rows: int = 1000, composed_rows: int = 2500) -> Tagger:
    """A tagger from at most most_rows windows of `docs` and composed_rows composed ones."""
    signs = docs.select(F.col("doc_id").cast("long"), "text").filter(F.col("text").rlike("[0-9@]"))
    chosen = signs.select("doc_id").distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(most_rows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[tuple[int, str, str]] = []
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                spans = rule_spans(text)
                rows += [(doc_id or 0, text[s : s + WINDOW], "".join(map(str, tags_of(spans, s)))) for s in window_starts(text)]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows) if rows else ([], [], []), (pa.int64(), pa.string(), pa.string()))], ["doc_id", "chars", "tags"])

    windows = signs.join(F.broadcast(chosen), "doc_id").mapInArrow(run, "doc_id long, chars string, tags string")
    rows = windows.orderBy(F.xxhash64("doc_id", "chars"), "doc_id", "chars", "tags").limit(most_rows).collect()
    chars, tags = composed(composed_rows)
    if rows:
        chars = np.concatenate([chars, [characters(r["chars"], WINDOW) for r in rows]])
        tags = np.concatenate([tags, [[int(t) for t in r["tags"]] for r in rows]])
    return fit(chars, tags, ALLOWED)


# --- on tables ------------------------------------------------------------


def _columns(part: pa.RecordBatch, model: Tagger) -> list[pa.Array]:
    found = all_spans(part.column("text").to_pylist(), model)
    counts = [[sum(k == kind for _, k, _ in base) for base, _ in found] for kind in range(len(KINDS))]
    counts.append([len(spans) - len(base) for base, spans in found])
    digests = [hashlib.sha256(written(base).encode()).hexdigest() for base, _ in found]
    return [*(pa.array(c, pa.int64()) for c in counts), pa.array(digests, pa.string()), pa.array([written(s) for _, s in found], pa.string())]


def find(docs: DataFrame, model: Tagger) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone (the rules' spans), n_added (the tagger's), base_sha256, spans (all)."""
    names = ["doc_id", *(f"n_{k}" for k in KINDS), "n_added", "base_sha256", "spans"]
    schema = "doc_id long, n_email long, n_ip long, n_card long, n_phone long, n_added long, base_sha256 string, spans string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(0, batch.num_rows, _ROWS):
                part = batch.slice(k, _ROWS)
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), *_columns(part, model)], names)

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, schema)


def masked(text: str, spans: list[Span]) -> str:
    """The text with every span, joined where they overlap, replaced by its kind in angle brackets."""
    out, at = [], 0
    for a, kind, b in sorted(spans):
        if a >= at:
            out += [text[at:a], f"<{KINDS[kind]}>"]
        at = max(at, b)
    return "".join(out) + text[at:]


def redact(docs: DataFrame, model: Tagger) -> DataFrame:
    """docs with spans replaced in `text`; null texts stay null."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(0, batch.num_rows, _ROWS):
                part = batch.slice(k, _ROWS)
                texts = part.column("text").to_pylist()
                new = [t if t is None else masked(t, spans) for t, (_, spans) in zip(texts, all_spans(texts, model), strict=True)]
                place = part.schema.get_field_index("text")
                yield part.set_column(place, part.schema.field(place), pa.array(new, pa.string()))

    return docs.mapInArrow(run, docs.schema)
