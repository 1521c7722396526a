"""Personal data: fixed rules, and a character-level bidirectional LSTM with a CRF for the rest.

The rules find e-mail and IP addresses, card and phone numbers in their plain forms; what they find
stays. The tagger is trained on labelled spans: those the rules find in a bounded sample of the
documents, and spans in other spellings (a number in brackets, an address with "at" and "dot")
written into windows of that sample. It reads every character of every text in overlapping windows.
Spans decoded in the windows of a text are reconciled over the whole text: pieces of one kind that
the edges of two neighbouring windows cut are joined where they overlap, and of what then overlaps
a span that no window edge cuts wins over one that is cut, then the longer one, then the earlier. A span is added if it
touches no span of the rules and its digits or words fit its kind.

Scale. One pass over the texts without a shuffle; memory is bounded by a batch of windows, however
long a text is. Windows whose scores prove that the best labels are all "none" skip decoding.
Training reads about ``MAX_ROWS`` documents, a parameter, a few windows of each.

Defined results: a null text is empty; positions are code points, ends exclusive; matches that fail
their test are dropped and not tried again at another place; equal texts have equal spans. Other
columns of the documents pass through untouched; beside one called like the result, the result has
an underscore in front.
"""

from __future__ import annotations

import hashlib
import pickle
import random
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aerolag.llm import bilstm
from aerolag.llm.common import spare_name

KINDS = ("email", "ip", "card", "phone")

# Documents that give training windows, about; windows of each; their length.
MAX_ROWS = 2000
WINDOWS_EACH = 4
TRAIN_LENGTH = 96
EXAMPLES = 12_000
STEPS = 700
BATCH = 128
HIDDEN = 8

# Characters a window holds, and shares with the next.
WINDOW = 256
OVERLAP = 96
# Windows scored together.
TOGETHER = 2048

# Rules


def _luhn(digits: str) -> bool:
    values = [int(d) for d in reversed(digits)]
    doubled = [2 * d - 9 if d > 4 else 2 * d for d in values[1::2]]
    return (sum(values[::2]) + sum(doubled)) % 10 == 0


_LOCAL = re.compile(r"[A-Za-z0-9._%+-]*+")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
# Chains of numbers with single dots between; a chain begins where no digit stands before.
_NUMBERS = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3,}+")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches of local part, @ and dotted domain, found from the @ outwards."""
    done = 0
    at = text.find("@")
    while at >= 0:
        # What stands before the @ is looked at backwards, so the text is read once.
        size = _LOCAL.match(text[done:at][::-1]).end() if at - done < 512 else _run_before(text, done, at)
        domain = _DOMAIN.match(text, at + 1) if size else None
        if domain:
            yield at - size, domain.end()
        done = domain.end() if domain else at + 1
        at = text.find("@", done)


def _run_before(text: str, done: int, at: int) -> int:
    size = 512
    while True:
        found = _LOCAL.match(text[max(done, at - size) : at][::-1]).end()
        if found < size or at - size <= done:
            return found
        size *= 2


def _ips(text: str) -> Iterator[tuple[int, int]]:
    for chain in _NUMBERS.finditer(text):
        ends = [m.span() for m in re.finditer("[0-9]+", chain.group())]
        for four in zip(*[iter(ends)] * 4):
            begin, end = chain.start() + four[0][0], chain.start() + four[3][1]
            if all(b - a < 19 and int(chain.group()[a:b]) <= 255 or not chain.group()[a:b].strip("0") for a, b in four):
                yield begin, end


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def base_spans(text: str) -> dict[str, list[tuple[int, int]]]:
    """Spans of the rules, by kind, from left to right."""
    cards = [m.span() for m in _CARD.finditer(text) if m.end() - m.start() >= 16]
    cards = [(a, b) for a, b in cards if 16 <= len(d := _digits(text[a:b])) <= 19 and _luhn(d)]
    phones = [m.span() for m in _PHONE.finditer(text)] if "+" in text else []
    return {
        "email": list(_emails(text)),
        "ip": list(_ips(text)),
        "card": cards,
        "phone": [(a, b) for a, b in phones if 8 <= len(_digits(text[a:b])) <= 15],
    }


def fits(kind: str, text: str) -> bool:
    """Whether what the tagger found can be of its kind."""
    digits = _digits(text)
    if kind == "email":
        return bool(re.search(r"@|\bat\b", text, re.I) and re.search(r"\.|\bdot\b", text, re.I))
    if kind == "ip":
        numbers = re.findall("[0-9]+", text)
        return len(numbers) == 4 and all(len(n) <= 3 and int(n) <= 255 for n in numbers)
    if kind == "card":
        return 13 <= len(digits) <= 19 and _luhn(digits)
    return 8 <= len(digits) <= 15


# Training


def symbols_of(text: str) -> np.ndarray:
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    return np.minimum(points, bilstm.OTHER).astype(np.uint8)


def _name(pick: random.Random, least: int, most: int) -> str:
    letters = "aabcdeefghiijklmnnoopqrrsstuuvwxyz"
    return "".join(pick.choice(letters) for _ in range(pick.randint(least, most)))


def _written_email(pick: random.Random) -> str:
    name = _name(pick, 2, 9) + pick.choice(["", ".", "_", "-"]) + pick.choice(["", str(pick.randint(1, 99)), _name(pick, 2, 7)])
    host = [_name(pick, 3, 9) for _ in range(pick.randint(1, 2))] + [pick.choice(["com", "org", "net", "io", "de", "fr"])]
    at, dot = pick.choice([("@", "."), ("@", "."), (" at ", " dot "), (" (at) ", " (dot) "), ("[at]", "[dot]"), (" [at] ", "."), (" AT ", " DOT "), ("(at)", ".")])
    return name + at + dot.join(host)


def _written_ip(pick: random.Random) -> str:
    return pick.choice([".", ".", "[.]", " . ", "(.)", " dot "]).join(str(pick.randint(0, 255)) for _ in range(4))


def _written_card(pick: random.Random) -> str:
    digits = "".join(str(pick.randint(0, 9)) for _ in range(pick.choice([14, 15, 15])))
    digits += next(d for d in "0123456789" if _luhn(digits + d))
    mark = pick.choice(["", "", " ", "-", ".", "_", "/", "  "])
    return mark.join(digits[i : i + 4] for i in range(0, len(digits), 4))


def _written_phone(pick: random.Random) -> str:
    area, first, last = pick.randint(200, 999), pick.randint(200, 999), pick.randint(0, 9999)
    return pick.choice(["+1 ({}) {}-{:04}", "({}) {}-{:04}", "{}-{}-{:04}", "{}.{}.{:04}", "001 {} {} {:04}", "+49 {} {}{:04}"]).format(area, first, last)


def _written_other(pick: random.Random) -> str:
    """Text with digits or marks that is none of the kinds."""
    n = pick.randint
    return pick.choice(
        [
            f"{n(1900, 2099)}-{n(1, 12):02}-{n(1, 28):02}",
            f"{n(0, 23)}:{n(0, 59):02}",
            f"{n(1, 9999)}.{n(0, 99):02}",
            f"version {n(0, 9)}.{n(0, 9)}.{n(0, 20)}",
            f"#{n(1, 99999)}",
            "AKIA" + "".join(pick.choice("ABCDEFGHIJKLMNOPQRSTUVWXYZ234567") for _ in range(16)),
            f"@{_name(pick, 3, 9)}",
            f"at {_name(pick, 3, 8)}. ",
            f"{n(1, 999):,} of {n(1000, 9_999_999):,}",
            _name(pick, 2, 6).upper() + str(n(1, 10**6)),
            "".join(str(n(0, 9)) for _ in range(n(4, 24))),
        ]
    )


_WRITERS = dict(zip(KINDS, (_written_email, _written_ip, _written_card, _written_phone)))


def examples(contexts: list[str], count: int, seed: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Symbols and labels (time, count): spans written into contexts, and those the rules find."""
    pick = random.Random(seed)
    symbols = np.full((TRAIN_LENGTH, count), bilstm.PAD, np.uint8)
    labels = np.zeros((TRAIN_LENGTH, count), np.int64)
    for column in range(count):
        text, spans = pick.choice(contexts), []
        what = pick.choice([*KINDS, *KINDS, "other", "other", "none"])
        if what != "none":
            written = _WRITERS.get(what, _written_other)(pick)
            at = pick.choice([0, len(text), *[m.end() for m in re.finditer(r"\s", text)]])
            head = text[:at] if at == 0 or text[at - 1].isspace() else text[:at] + " "
            tail = text[at:]
            text = head + written + (pick.choice([" ", " ", ". ", ", ", "\n"]) if tail else "") + tail
            if what in KINDS:
                spans = [(what, len(head), len(head) + len(written))]
        for kind, found in base_spans(text).items():
            spans += [(kind, a, b) for a, b in found if not any(a < e and s < b for _, s, e in spans)]
        # A cut that shows the span written, if there is one.
        center = (spans[0][1] + spans[0][2]) // 2 if spans else pick.randint(0, len(text))
        begin = max(0, min(len(text) - TRAIN_LENGTH, center - pick.randint(20, TRAIN_LENGTH - 20)))
        piece = symbols_of(text[begin : begin + TRAIN_LENGTH])
        symbols[: len(piece), column] = piece
        for kind, a, b in spans:
            a, b = max(0, a - begin), min(len(piece), b - begin)
            if a < b:
                labels[a:b, column] = 2 + 2 * KINDS.index(kind)
                labels[a, column] = 1 + 2 * KINDS.index(kind)
    return symbols, labels


def _contexts(texts: pa.Array) -> pa.Array:
    """A few windows of each text: around spans of the rules, and elsewhere."""
    results = []
    for text in texts.to_pylist():
        text = text or ""
        spans = [span for found in base_spans(text).values() for span in found]
        pick = random.Random(len(text))
        shown = pick.sample(spans, min(len(spans), WINDOWS_EACH // 2))
        starts = [max(0, a - pick.randint(20, 60)) for a, _ in shown]
        while len(starts) < WINDOWS_EACH:
            starts.append(pick.randint(0, max(0, len(text) - TRAIN_LENGTH)))
        results.append([text[s : s + TRAIN_LENGTH] for s in starts])
    return pa.array(results, pa.list_(pa.string()))


def fit(
    documents: DataFrame, id: str = "doc_id", text: str = "text", max_rows: int = MAX_ROWS
) -> bilstm.Tagger:
    """A tagger trained on windows of about ``max_rows`` documents, chosen by a hash."""
    share = min(1.0, max_rows / max(1, documents.count()))
    whole = F.col(f"`{text}`")
    place = F.pmod(F.xxhash64(F.col(f"`{id}`"), whole), F.lit(1 << 32))
    windows = documents.where(place < int(share * (1 << 32))).select(
        F.arrow_udf(_contexts, "array<string>")(whole).alias("windows")
    )
    # One task learns from the bounded sample; a lost one is run again.
    # An empty table still has one row to learn from.
    none = documents.sparkSession.range(1).select(F.array().cast("array<string>"))
    [[weights]] = windows.union(none).repartition(1).mapInArrow(_trained, "weights binary").collect()
    return pickle.loads(weights)


def _trained(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    rows = [row for batch in batches for row in batch.column(0).to_pylist()]
    contexts = sorted({window for row in rows for window in row}) or [" "]
    tagger = bilstm.Tagger(HIDDEN, 1 + 2 * len(KINDS))
    bilstm.fit(tagger, *examples(contexts, EXAMPLES), steps=STEPS, batch=BATCH, rate=0.03)
    yield pa.RecordBatch.from_pydict({"weights": [pickle.dumps(tagger)]})


# Scoring


def _window_starts(length: int) -> list[int]:
    return list(range(0, max(1, length - OVERLAP), WINDOW - OVERLAP))


def _decoded(path: np.ndarray) -> Iterator[tuple[str, int, int]]:
    """Spans of a sequence of labels."""
    at = 0
    while at < len(path):
        if path[at] == 0:
            at += 1
            continue
        kind, begin = (path[at] - 1) // 2, at
        at += 1
        while at < len(path) and path[at] == 2 + 2 * kind:
            at += 1
        yield KINDS[kind], begin, at


def _joined(pieces: list[tuple[bool, bool, str, int, int]]) -> list[tuple[bool, str, int, int]]:
    """Spans from the (cut at start, cut at end, kind, start, end) pieces of all windows of a text.

    A piece cut at the end of a window goes on in the piece that the start of the next one cuts: the
    first knows where the span starts, the second where it ends.
    """
    goes_on = {(piece[2], piece[3]): piece for piece in pieces if piece[0]}
    used: set[tuple] = set()
    spans = []
    for piece in sorted(pieces, key=lambda x: (not x[1], x[4])):
        if piece in used:
            continue
        before, after, kind, a, b = piece
        while after:
            more = goes_on.get((kind, b - OVERLAP))
            if more is None or more[4] <= a:
                break
            used.add(more)
            after, b = more[1], more[4]
        spans.append((before or after, kind, a, b))
    return spans


def _reconciled(found: list[tuple[bool, str, int, int]]) -> list[tuple[str, int, int]]:
    """One span of each set of overlapping ones: whole before cut, long before short, then the first."""
    chosen: list[tuple[str, int, int]] = []
    for _, kind, a, b in sorted(set(found), key=lambda x: (x[0], x[2] - x[3], x[2], x[1])):
        if not any(a < end and start < b for _, start, end in chosen):
            chosen.append((kind, a, b))
    return sorted(chosen, key=lambda x: x[1])


def _in_windows(tagger: bilstm.Tagger, windows: list[tuple[int, int, np.ndarray]]) -> Iterator[tuple]:
    """(text, cut at start, cut at end, kind, start, end) of what is decoded in (text, start, symbols)
    windows."""
    symbols = np.full((len(windows), WINDOW), bilstm.PAD, np.uint8)
    for row, (_, _, piece) in enumerate(windows):
        symbols[row, : len(piece)] = piece
    longest = max(1, *(len(piece) for _, _, piece in windows))
    scores = tagger.emissions(np.ascontiguousarray(symbols[:, :longest].T).astype(np.intp))
    open_ = np.flatnonzero(~tagger.unremarkable(scores))
    if not len(open_):
        return
    paths = tagger.decode(np.ascontiguousarray(scores[:, :, open_]))
    for column in np.flatnonzero(paths.any(axis=0)):
        number, start, piece = windows[open_[column]]
        for kind, a, b in _decoded(paths[: len(piece), column].astype(int)):
            yield number, a == 0 and start > 0, b == WINDOW, kind, start + a, start + b


def tagged(tagger: bilstm.Tagger, texts: list[str]) -> list[list[tuple[str, int, int]]]:
    """Spans the tagger finds in each text."""
    found: list[list] = [[] for _ in texts]

    def windows() -> Iterator[tuple[int, int, np.ndarray]]:
        for number, text in enumerate(texts):
            for start in _window_starts(len(text)):
                yield number, start, symbols_of(text[start : start + WINDOW])

    def flush(group: list) -> None:
        for number, *span in _in_windows(tagger, group):
            found[number].append(tuple(span))

    group: list = []
    for window in windows():
        group.append(window)
        if len(group) == TOGETHER:
            flush(group)
            group = []
    if group:
        flush(group)
    return [_reconciled(_joined(pieces)) for pieces in found]


def all_spans(tagger: bilstm.Tagger, texts: list[str]) -> list[tuple[dict, dict]]:
    """Per text: spans of the rules, and all spans, by kind."""
    results = []
    for text, found in zip(texts, tagged(tagger, texts)):
        base = base_spans(text)
        taken = [span for spans in base.values() for span in spans]
        every = {kind: list(spans) for kind, spans in base.items()}
        for kind, a, b in found:
            if not any(a < end and start < b for start, end in taken) and fits(kind, text[a:b]):
                every[kind].append((a, b))
        results.append((base, {kind: sorted(spans) for kind, spans in every.items()}))
    return results


def listed(spans: dict[str, list[tuple[int, int]]]) -> str:
    return ",".join(f"{kind}:{a}:{b}" for kind in KINDS for a, b in spans[kind])


RESULT = (
    "struct<n_email: bigint, n_ip: bigint, n_card: bigint, n_phone: bigint, "
    "base_sha256: string, spans: string, n_added: bigint>"
)
_ARROW = pa.struct(
    [(f"n_{kind}", pa.int64()) for kind in KINDS]
    + [("base_sha256", pa.string()), ("spans", pa.string()), ("n_added", pa.int64())]
)


def _found(tagger: Broadcast):
    def found(texts: pa.Array) -> pa.Array:
        results = []
        for base, every in all_spans(tagger.value, [text or "" for text in texts.to_pylist()]):
            row = {f"n_{kind}": len(base[kind]) for kind in KINDS}
            row["base_sha256"] = hashlib.sha256(listed(base).encode()).hexdigest()
            row["spans"] = listed(every)
            row["n_added"] = sum(map(len, every.values())) - sum(map(len, base.values()))
            results.append(row)
        return pa.array(results, _ARROW)

    return found


def find(
    documents: DataFrame, tagger: bilstm.Tagger, text: str = "text", result: str = "pii"
) -> DataFrame:
    """``documents`` with counts and a digest of the spans of the rules, and all spans as text."""
    sent = documents.sparkSession.sparkContext.broadcast(tagger)
    found = F.arrow_udf(_found(sent), RESULT)(F.col(f"`{text}`"))
    return documents.withColumn(spare_name(documents, result), found)


def mask(text: str, spans: dict[str, list[tuple[int, int]]]) -> str:
    """The text with each span replaced by its kind in angle brackets; the first of overlapping ones."""
    parts, done = [], 0
    for a, b, kind in sorted((a, b, kind) for kind in KINDS for a, b in spans[kind]):
        if a >= done:
            parts += [text[done:a], f"<{kind}>"]
        done = max(done, b)
    return "".join([*parts, text[done:]])


def _masked(tagger: Broadcast):
    def masked(texts: pa.Array) -> pa.Array:
        given = texts.to_pylist()
        spans = all_spans(tagger.value, [text or "" for text in given])
        return pa.array(
            [text if text is None else mask(text, every) for text, (_, every) in zip(given, spans)],
            pa.string(),
        )

    return masked


def masked(documents: DataFrame, tagger: bilstm.Tagger, text: str = "text") -> DataFrame:
    """The documents with their personal data masked; columns and rows as before."""
    sent = documents.sparkSession.sparkContext.broadcast(tagger)
    new = spare_name(documents, "masked")
    changed = documents.withColumn(new, F.arrow_udf(_masked(sent), "string")(F.col(f"`{text}`")))
    columns = [F.col(new).alias(c) if c == text else F.col(f"`{c}`") for c in documents.columns]
    return changed.select(*columns)
