"""Personal data (operator 4): base patterns and a character-level BiLSTM-CRF.

Base spans are the leftmost non-overlapping matches of four kinds (email, ip,
card, phone) with their checks. The tagger is trained from labelled spans: a
bounded sample of windows whose labels are the base spans, copies in which
those spans are spelt in ways no base pattern matches (``respelt``: "ann [at]
mail [dot] example [dot] org", "10 . 0 . 0 . 7", "4111/1111/1111/1111",
"0049 30/123 456"), and windows without a span, once as they are and once with
such a span put in. It then reads every window of every text and adds what it
finds beside the base spans. In every second training window the letters
around the spans are replaced at random.

Windows of ``READ`` characters start every ``STRIDE`` characters (training
windows are ``WINDOW`` long). Overlapping windows are reconciled over the whole
text: every decoded span is a vote; votes cut off by a window's edge count only
where no window saw more; the span with most votes, then the longest, then the
first wins among those that overlap. What remains must have a value of its
kind (an address once the spelling is undone, four numbers up to 255, a Luhn
number, enough digits) and touch no base span.

Sampling bound: ``TRAIN_WINDOWS`` windows with spans, half as many with digits
or ``@`` but no span, a quarter as many with neither (those with the smallest
hashes of id and place; each task offers no more than that many, so the choice
is exact and the same on every run). Training runs in the driver on that
sample. Prediction is one scan without a shuffle; the model (about 3,000
numbers) travels with the task.

Edge cases: null text counts as empty and has no spans. Very long texts are
read whole, in linear time: patterns are anchored at ``@``, at the start of
digit runs and at ``+``. Without labelled spans the tagger adds nothing.
Repeated rows give repeated results; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import heapq
import re
from collections import Counter
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .bilstm_crf import BiLstmCrf

KINDS = ("email", "ip", "card", "phone")
WINDOW = 96
READ, STRIDE = 480, 432
BATCH = 512
TRAIN_WINDOWS = 768
PLANTED = 1536
EPOCHS = 8
SEED = 42
_PREFIX_BITS = 12

Span = tuple[int, int]

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_HINT = re.compile("[0-9@]")
_DIGITS = re.compile("[0-9]")


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def passes(kind: str, text: str, low_card: int = 16, low_phone: int = 8) -> bool:
    if kind == "email":
        return True
    if kind == "ip":
        return all(len(part) <= 3 and int(part or "0") <= 255 for part in (p.lstrip("0") for p in text.split(".")))
    digits = "".join(_DIGITS.findall(text))
    if kind == "card":
        return low_card <= len(digits) <= 19 and luhn(digits)
    return low_phone <= len(digits) <= 15


def _emails(text: str) -> Iterator[Span]:
    free, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            yield start, domain.end()
            free = domain.end()
        else:
            free = max(free, at + 1)
        at = text.find("@", free)


def base_spans(text: str) -> dict[str, list[Span]]:
    """Spans of each kind; failing matches are dropped without another try."""
    spans: dict[str, list[Span]] = {k: [] for k in KINDS}
    if "@" in text:
        spans["email"] = list(_emails(text))
    if _DIGITS.search(text):
        for kind, pattern in (("ip", _IP), ("card", _CARD), ("phone", _PHONE)):
            spans[kind] = [m.span() for m in pattern.finditer(text) if passes(kind, m.group())]
    return spans


def joined(spans: dict[str, list[Span]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k in KINDS for a, b in sorted(spans[k]))


# ------------------------------------------------------------ characters ----

_FIRST, _LAST = 32, 126
PAD, OTHER = _LAST - _FIRST + 1, _LAST - _FIRST + 2
_ASCII = np.full(128, OTHER)
_ASCII[_FIRST:_LAST + 1] = np.arange(_LAST - _FIRST + 1)
for _c in "\t\n\r":
    _ASCII[ord(_c)] = 0  # as a space
# tags: 0, then begin and inside of each kind
TAGS = 1 + 2 * len(KINDS)


def encode(text: str, size: int) -> np.ndarray:
    """Character numbers of a text, padded to ``size``."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
    out = np.full(size, PAD, np.uint8)
    out[:len(points)] = np.where(points < 128, _ASCII[np.minimum(points, 127)], OTHER)
    return out


def encode_tags(labels: list[tuple[str, int, int]]) -> np.ndarray:
    out = np.zeros(WINDOW, np.int64)
    for kind, a, b in labels:
        k = KINDS.index(kind)
        out[a:b] = 2 + 2 * k
        out[a] = 1 + 2 * k
    return out


def new_tagger(seed: int = SEED) -> BiLstmCrf:
    inside = np.arange(TAGS) >= 2
    inside &= np.arange(TAGS) % 2 == 0
    begins = np.arange(TAGS) - 1
    allowed = np.array([[not inside[j] or i == j or i == begins[j] for j in range(TAGS)] for i in range(TAGS)])
    return BiLstmCrf(OTHER + 1, allowed, np.ones(TAGS, bool), seed=seed)  # a window may open inside a span


def window_starts(size: int, window: int = READ, stride: int = STRIDE) -> range:
    """Starts of the windows that cover a text of so many characters."""
    return range(0, max(size - window, 0) + stride, stride) if size else range(0)


def _labels(every: list[tuple[int, int, str]], first: int, start: int, end: int) -> list[tuple[str, int, int]] | None:
    """Spans inside the window, of those sorted from ``first`` on; None if one
    is cut or two overlap."""
    found = []
    for a, b, kind in every[first:first + WINDOW]:
        if a >= end:
            break
        if b > start:
            found.append((a, b, kind))
    if any(a < start or b > end for a, b, _ in found) or any(x[1] > y[0] for x, y in zip(found, found[1:])):
        return None
    return [(k, a - start, b - start) for a, b, k in found]


# -------------------------------------------------------------- training ----


# classes of training windows, and the share of the sample's size each may have
SPANS, DIGITS, PLAIN = 0, 1, 2
_SHARES = {SPANS: 1, DIGITS: 2, PLAIN: 4}


def _offer_task(batches: Iterator[pa.RecordBatch], most: int, seed: int) -> Iterator[pa.RecordBatch]:
    """The task's windows of each class with the smallest hashes."""
    heaps: dict[int, list] = {c: [] for c in _SHARES}
    for batch in batches:
        for doc, value in zip(batch.column(0).to_pylist(), batch.column(1)):
            text = value.as_py() or ""
            spans = base_spans(text)
            every = sorted((a, b, k) for k in KINDS for a, b in spans[k])
            at = 0
            for s in window_starts(len(text), WINDOW, WINDOW // 2):
                while at < len(every) and every[at][1] <= s:
                    at += 1
                window = text[s:s + WINDOW]
                mark = xxhash.xxh64_intdigest(f"{doc}:{s}:{window}".encode("utf-8", "surrogatepass"), seed) >> 1
                has_span = at < len(every) and every[at][0] < s + WINDOW
                kind = SPANS if has_span else DIGITS if _HINT.search(window) else PLAIN
                heap = heaps[kind]
                if len(heap) >= most // _SHARES[kind] and (not heap or -mark < heap[0][0]):
                    continue
                labels = _labels(every, at, s, s + len(window)) if has_span else []
                if labels is None:
                    continue
                item = (-mark, window, ",".join(f"{k}:{a}:{b}" for k, a, b in labels))
                (heapq.heappush if len(heap) < most // _SHARES[kind] else heapq.heappushpop)(heap, item)
    rows = [(kind, -m, w, s) for kind, heap in heaps.items() for m, w, s in heap]
    cols = list(zip(*rows)) or [()] * 4
    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.int32(), pa.int64(), pa.string(), pa.string()))],
                                     names=["kind", "mark", "window", "labels"])


def national_phone(window: str, labels: list[tuple[str, int, int]]) -> tuple[str, list[tuple[str, int, int]]] | None:
    """The window with the plus and country digits of its phones taken off."""
    phones = [(a, b) for k, a, b in labels if k == "phone"]
    if not phones:
        return None
    shift = np.zeros(len(window) + 1, np.int64)
    gone = np.zeros(len(window), bool)
    for a, b in phones:
        cut = re.match(r"\+[0-9]{1,3}[ .-]*", window[a:b])
        if not cut or len(_DIGITS.findall(window[a + cut.end():b])) < 7:
            return None
        gone[a:a + cut.end()] = True
    shift[1:] = np.cumsum(gone)
    moved = []
    for k, a, b in labels:
        first = a + int(np.argmin(gone[a:b]))  # its first character that stays
        moved.append((k, first - int(shift[first]), b - int(shift[b])))
    return "".join(c for c, g in zip(window, gone) if not g), moved


def _smallest(offered: DataFrame, n: int) -> list:
    """The n rows with the smallest marks. Marks are counted by their leading
    bits first, so that little more than n rows are sorted and collected
    however many tasks offered some."""
    prefix = F.shiftright("mark", 63 - _PREFIX_BITS)
    counts = offered.groupBy(prefix.alias("prefix")).agg(F.count(F.lit(1)).alias("n")).collect()
    last, seen = -1, 0
    for r in sorted(counts):
        if seen < n:
            last, seen = r["prefix"], seen + r["n"]
    return offered.where(prefix <= last).orderBy("mark", "window").limit(n).collect()


def training_windows(documents: DataFrame, most: int = TRAIN_WINDOWS, seed: int = SEED,
                     id_col: str = "doc_id") -> list[tuple[str, list[tuple[str, int, int]]]]:
    """At most ``most`` windows with spans, half as many with digits or ``@``
    only, a quarter as many with neither."""
    offered = documents.select(id_col, "text").mapInArrow(
        partial(_offer_task, most=most, seed=seed), "kind int, mark bigint, window string, labels string")
    offered = materialize(offered, "pii-windows")
    rows = [r for kind, share in _SHARES.items() for r in _smallest(offered.where(F.col("kind") == kind), most // share)]
    windows = []
    for r in rows:
        parts = [x.split(":") for x in r["labels"].split(",") if x]
        windows.append((r["window"], [(k, int(a), int(b)) for k, a, b in parts]))
    return windows


# How the signs of a span are spelt where no base pattern fits.
SPELT_AT = (" at ", " [at] ", "[at]", " (at) ", "(at)", " AT ", " {at} ", " @ ")
SPELT_DOT = (" dot ", " [dot] ", "[dot]", " (dot) ", "(dot)", " DOT ", " {dot} ", " . ")
IP_JOINTS = (" . ", "[.]", " dot ", "(dot)", ", ", " .")
CARD_JOINTS = ("/", ".", "  ", " - ", "_", ", ")
PHONE_JOINTS = ("/", " ", "-", ".", " - ", " / ")


def planted(kind: str, rng: np.random.Generator) -> str:
    """An invented span in its base spelling."""
    def digits(n: int) -> str:
        return "".join(map(str, rng.integers(0, 10, n)))

    def word() -> str:
        return "".join(chr(c) for c in rng.integers(97, 123, rng.integers(2, 9)))

    if kind == "email":
        local = word() + (f".{word()}" if rng.random() < 0.4 else digits(2) if rng.random() < 0.3 else "")
        return f"{local}@{word()}" + "".join(f".{word()[:4]}" for _ in range(rng.integers(1, 3)))
    if kind == "ip":
        return ".".join(map(str, rng.integers(0, 256, 4)))
    if kind == "card":
        first = digits(15)
        return next(first + d for d in "0123456789" if luhn(first + d))
    return f"+{rng.integers(1, 100)} {digits(3)} {digits(3)} {digits(4)}"


def respelt(kind: str, span: str, rng: np.random.Generator) -> str:
    """A span in a spelling that its base pattern does not match whole."""
    def one(of: tuple[str, ...]) -> str:
        return of[rng.integers(len(of))]

    if kind == "email":
        style = rng.integers(len(SPELT_AT))
        local, domain = span.split("@", 1)
        return local.replace(".", SPELT_DOT[style] if rng.random() < 0.5 else ".") + SPELT_AT[style] + domain.replace(".", SPELT_DOT[style])
    if kind == "ip":
        return one(IP_JOINTS).join(span.split("."))
    digits = "".join(_DIGITS.findall(span))
    if kind == "card":
        return one(CARD_JOINTS).join(digits[i:i + 4] for i in range(0, len(digits), 4))
    joint = one(PHONE_JOINTS)
    groups = joint.join(digits[i:i + 3] for i in range(2, max(len(digits) - 2, 3), 3)) + digits[max(len(digits) - 2, 3):]
    return one(("00", "0", "")) + digits[:2] + joint + groups


def respelt_window(window: str, labels: list[tuple[str, int, int]], rng: np.random.Generator) -> tuple[str, list[tuple[str, int, int]]]:
    """The window with its spans spelt anew, cut to ``WINDOW`` characters."""
    out, moved, at, size = [], [], 0, 0
    for kind, a, b in labels:
        spelt = respelt(kind, window[a:b], rng)
        out += [window[at:a], spelt]
        size += a - at
        moved.append((kind, size, size + len(spelt)))
        size, at = size + len(spelt), b
    text = "".join([*out, window[at:]])[:WINDOW]
    return text, [(k, a, min(b, WINDOW)) for k, a, b in moved if a < WINDOW]


def with_planted(window: str, rng: np.random.Generator) -> tuple[str, list[tuple[str, int, int]]]:
    """The window with an invented, respelt span between two of its words."""
    kind = KINDS[max(0, rng.integers(-1, len(KINDS)))]  # addresses are the hardest and come twice as often
    spelt = respelt(kind, planted(kind, rng), rng)
    gaps = [m.end() for m in re.finditer(r"\s", window[:max(WINDOW - len(spelt) - 1, 0)])] or [0]
    at = gaps[rng.integers(len(gaps))]
    return f"{window[:at]}{spelt} {window[at:]}"[:WINDOW], [(kind, at, min(at + len(spelt), WINDOW))]


def planted_windows(plain: list[str], rng: np.random.Generator, most: int = PLANTED) -> list[tuple[str, list[tuple[str, int, int]]]]:
    """``most`` windows with an invented span each, made of windows without."""
    return [with_planted(plain[i % len(plain)], rng) for i in range(most)] if plain else []


def other_letters(window: str, labels: list[tuple[str, int, int]], rng: np.random.Generator) -> str:
    """The window with random letters in place of those outside its spans, so
    that the tagger goes by the shape of a span and not by the words around."""
    inside = {p for _, a, b in labels for p in range(a, b)}
    drawn = rng.integers(97, 123, len(window))
    return "".join(chr(d) if c.isalpha() and p not in inside else c for p, (c, d) in enumerate(zip(window, drawn)))


def train(windows: list[tuple[str, list[tuple[str, int, int]]]], epochs: int = EPOCHS, seed: int = SEED) -> BiLstmCrf | None:
    """A tagger fitted to labelled windows; None without a labelled span."""
    if not any(labels for _, labels in windows):
        return None
    rng = np.random.default_rng(seed)
    windows = (windows + [w for w in (national_phone(*x) for x in windows) if w]
               + [respelt_window(w, labels, rng) for w, labels in windows if labels]
               + planted_windows([w for w, labels in windows if not labels], rng))
    windows = [(other_letters(w, labels, rng) if i % 2 else w, labels) for i, (w, labels) in enumerate(windows)]
    tagger = new_tagger(seed)
    tagger.fit(np.array([encode(w, WINDOW) for w, _ in windows]), np.array([encode_tags(labels) for _, labels in windows]),
               epochs, seed=seed)
    return tagger


# ------------------------------------------------------------ prediction ----


def read_tags(tags: np.ndarray, size: int) -> list[tuple[str, int, int, bool]]:
    """(kind, start, end, opened before the window) of one window."""
    found, at = [], 0
    while at < size:
        if tags[at] == 0:
            at += 1
            continue
        kind, end = (tags[at] - 1) // 2, at + 1
        while end < size and tags[end] == 2 + 2 * kind:
            end += 1
        found.append((KINDS[kind], at, end, bool(tags[at] == 2 + 2 * kind)))
        at = end
    return found


def reconcile(text: str, votes: Counter, cut: set[tuple[str, int, int]], base: dict[str, list[Span]]) -> dict[str, list[Span]]:
    """Spans added to ``base``: no overlaps, most votes first. What two windows
    saw of one span, each cut off by its edge, is joined."""
    taken = bytearray(len(text))
    for spans in base.values():
        for a, b in spans:
            taken[a:b] = bytes([1]) * (b - a)
    rest: list[list] = []
    for kind, a, b in sorted(cut):
        if rest and rest[-1][0] == kind and a < rest[-1][2]:
            rest[-1][2] = max(rest[-1][2], b)
        else:
            rest.append([kind, a, b])
    added: dict[str, list[Span]] = {k: [] for k in KINDS}
    for kind, a, b in sorted(votes, key=lambda v: (-votes[v], v[1] - v[2], v[1])) + sorted(
            rest, key=lambda v: (v[1] - v[2], v[1])):
        while a < b and text[a].isspace():
            a += 1
        while b > a and text[b - 1].isspace():
            b -= 1
        if 1 in taken[a:b] or not _well_formed(kind, text[a:b]):
            continue
        added[kind].append((a, b))
        taken[a:b] = bytes([1]) * (b - a)
    return added


_AT = re.compile(r"\s*[\[({]\s*at\s*[\])}]\s*|\s+at\s+|\s*@\s*", re.IGNORECASE)
_DOT = re.compile(r"\s*[\[({]\s*(?:dot|\.)\s*[\])}]\s*|\s+dot\s+|\s+\.\s+", re.IGNORECASE)
_ADDRESS = re.compile(r"[^\s@]+@[^\s@.]+(?:\.[^\s@.]+)+")


def _well_formed(kind: str, piece: str) -> bool:
    """Whether the piece has a value of its kind, however it is spelt."""
    if kind == "email":
        at, dots = _AT.search(piece), _DOT.search(piece)
        spelt_bare = at is not None and at.group().strip().lower() == "at"
        # "look at example.org" is prose: a bare word "at" needs a spelt dot with it
        return at is not None and (dots is not None or not spelt_bare) and (
            _ADDRESS.fullmatch(_DOT.sub(".", _AT.sub("@", piece))) is not None)
    if not piece or not piece[-1].isdecimal() or not (piece[0].isdecimal() or kind == "phone" and piece[0] in "+("):
        return False
    numbers = re.findall("[0-9]+", piece)
    if kind == "ip":
        return len(numbers) == 4 and passes(kind, ".".join(numbers))
    if kind == "card":
        return passes(kind, piece, low_card=13)
    return (len(numbers) > 1 or piece[0] == "+") and not re.search("[A-Za-z]", piece) and passes(kind, piece, low_phone=7)


def _window_batches(texts: list[str]) -> Iterator[tuple[list[tuple[int, int]], np.ndarray]]:
    """Windows of all texts with their (text, start), about ``BATCH`` at a time."""
    held, places = [], []
    for i, text in enumerate(texts):
        starts = window_starts(len(text))
        if not starts:
            continue
        views = np.lib.stride_tricks.sliding_window_view(encode(text, starts[-1] + READ), READ)
        for k in range(0, len(starts), BATCH):
            part = starts[k:k + BATCH]
            held.append(views[part.start:part.stop:STRIDE])
            places += [(i, s) for s in part]
            if len(places) >= BATCH:
                yield places, np.concatenate(held)
                held, places = [], []
    if places:
        yield places, np.concatenate(held)


def find_in_texts(texts: list[str], tagger: BiLstmCrf | None) -> list[tuple[dict, dict]]:
    """(base spans, added spans) of each text."""
    bases = [base_spans(t) for t in texts]
    votes: list[Counter] = [Counter() for _ in texts]
    cut: list[set] = [set() for _ in texts]
    for places, windows in _window_batches(texts) if tagger else ():
        tags = tagger.decode(windows)
        for row in np.flatnonzero(tags.any(axis=1)):
            i, s = places[row]
            size = min(READ, len(texts[i]) - s)
            for kind, a, b, opened in read_tags(tags[row], size):
                span = (kind, s + a, s + b)
                if opened and s > 0 or b == READ and s + b < len(texts[i]):
                    cut[i].add(span)
                else:
                    votes[i][span] += 1
    return [(base, reconcile(t, v, c, base)) for t, base, v, c in zip(texts, bases, votes, cut)]


def _find_task(batches: Iterator[pa.RecordBatch], tagger: BiLstmCrf | None) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [t or "" for t in batch.column(1).to_pylist()]
        cols: list[list] = [[] for _ in range(7)]
        for base, added in find_in_texts(texts, tagger):
            text = joined(base)
            everything = {k: sorted(base[k] + added[k]) for k in KINDS}
            values = [*(len(base[k]) for k in KINDS), hashlib.sha256(text.encode()).hexdigest(), joined(everything),
                      sum(map(len, added.values()))]
            for c, v in zip(cols, values):
                c.append(v)
        types = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.int64()]
        yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, t) for c, t in zip(cols, types))],
                                         names=["doc_id", *(f"n_{k}" for k in KINDS), "base_sha256", "spans", "n_added"])


def find_pii(documents: DataFrame, most: int = TRAIN_WINDOWS, epochs: int = EPOCHS, seed: int = SEED) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone (base spans), base_sha256, spans
    (base and added ones), n_added."""
    tagger = train(training_windows(documents, most, seed), epochs, seed)
    rows = documents.select("doc_id", "text")
    kind = rows.schema["doc_id"].dataType.simpleString()
    counts = ", ".join(f"n_{k} bigint" for k in KINDS)
    return rows.mapInArrow(partial(_find_task, tagger=tagger),
                           f"doc_id {kind}, {counts}, base_sha256 string, spans string, n_added bigint")
