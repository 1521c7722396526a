"""Personal data: the rules against plain patterns, the tagger against held-out spans."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from aerolag.llm import bilstm, pii
from tests.llm.conftest import prose


def digits(text):
    return re.sub("[^0-9]", "", text)


def luhn(number):
    total = 0
    for i, d in enumerate(reversed(number)):
        d = int(d) * (1 + i % 2)
        total += d // 10 + d % 10
    return total % 10 == 0


def plain(text):
    """The rules as their patterns state them."""
    every = lambda pattern: re.finditer(pattern, text)
    ips = [m for m in every(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)") if all(int(n) <= 255 for n in m.group().split("."))]
    cards = [m for m in every(r"[0-9]([\x20-]?[0-9])+") if 16 <= len(digits(m.group())) <= 19 and luhn(digits(m.group()))]
    phones = [m for m in every(r"\+[0-9][\x20().0-9-]+[0-9]") if 8 <= len(digits(m.group())) <= 15]
    emails = every(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
    found = {"email": emails, "ip": ips, "card": cards, "phone": phones}
    return {kind: [m.span() for m in matches] for kind, matches in found.items()}


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet="ab@@..-+ 0123%()\né", max_size=40))
def test_rules_equal_their_patterns(text):
    assert pii.base_spans(text) == plain(text)


@pytest.mark.parametrize("seed", range(4))
def test_rules_on_written_forms(seed):
    pick = random.Random(seed)
    for _ in range(300):
        parts = [pick.choice([pii._written_email, pii._written_ip, pii._written_card, pii._written_phone, pii._written_other])(pick) for _ in range(4)]
        text = pick.choice(["", " ", ".", "-", "+"]).join(parts)
        assert pii.base_spans(text) == plain(text)


def test_rules_are_linear_in_long_runs():
    for text in ("a" * 300_000, "1" * 300_000, "1." * 150_000, "+1" * 100_000, "a@" * 100_000, "1 " * 200_000):
        assert isinstance(pii.base_spans(text), dict)


@pytest.fixture(scope="module")
def tagger():
    pick = random.Random(1)
    contexts = [prose(pick, 14) for _ in range(300)]
    made = bilstm.Tagger(pii.HIDDEN, 9)
    bilstm.fit(made, *pii.examples(contexts, 3000), steps=200, batch=96, rate=0.03)
    return made


def test_tagger_on_held_out_spans(tagger):
    pick = random.Random(2)
    symbols, truth = pii.examples([prose(pick, 14) for _ in range(100)], 400, seed=77)
    paths = tagger.decode(tagger.emissions(symbols.astype(np.intp)))
    right = found = wanted = 0
    for column in range(400):
        a, b = (set(pii._decoded(x[:, column].astype(int))) for x in (paths, truth))
        right, found, wanted = right + len(a & b), found + len(a), wanted + len(b)
    assert right / found > 0.75 and right / wanted > 0.75


def test_every_kind_is_found_in_other_spellings(spark, documents):
    """The tagger as the query trains it, on texts that training has not seen."""
    pick = random.Random(31)
    vocabulary = prose(pick, 4000).split()
    model = pii.fit(documents([prose(pick, 60, vocabulary) for _ in range(200)]))
    wanted, right, found = Counter(), Counter(), Counter()
    for number in range(800):
        kind = pii.KINDS[number % 4]
        written = pii._WRITERS[kind](pick)
        if any(pii.base_spans(written).values()):
            continue
        head = prose(pick, pick.randint(0, 12), vocabulary)
        head += " " if head else ""
        text = head + written + " " + prose(pick, 10, vocabulary)
        [(base, every)] = pii.all_spans(model, [text])
        if any(base.values()):
            continue
        wanted[kind] += 1
        right[kind] += (len(head), len(head) + len(written)) in every[kind]
        found.update({k: len(spans) for k, spans in every.items()})
    assert all(wanted[kind] > 50 for kind in pii.KINDS)
    assert min(right[kind] / wanted[kind] for kind in pii.KINDS) > 0.9
    assert sum(right.values()) / sum(found.values()) > 0.9


def test_skipped_windows_decode_to_nothing(tagger):
    pick = random.Random(3)
    symbols = np.array([pii.symbols_of(prose(pick, 60)[:256].ljust(256)) for _ in range(200)]).T
    scores = tagger.emissions(symbols.astype(np.intp))
    skipped = tagger.unremarkable(scores)
    assert skipped.mean() > 0.5 and not tagger.decode(scores)[:, skipped].any()


def test_viterbi_is_the_best_of_all_paths():
    made = bilstm.Tagger(2, 3, seed=3)
    scores = np.random.default_rng(1).standard_normal((5, 3, 4)).astype(np.float32)
    made.weights["step"] = np.random.default_rng(2).standard_normal((3, 3)).astype(np.float32)
    paths = made.decode(scores)
    for b in range(4):
        def total(path):
            return sum(scores[t, y, b] for t, y in enumerate(path)) + sum(made.weights["step"][x, y] for x, y in zip(path, path[1:]))

        every = np.stack(np.meshgrid(*[range(3)] * 5), -1).reshape(-1, 5)
        assert total(paths[:, b]) == pytest.approx(max(map(total, every)))


def test_spans_of_windows_are_reconciled(tagger):
    found = [(True, "email", 200, 256), (False, "email", 208, 270), (False, "email", 208, 270), (False, "ip", 300, 310)]
    assert pii._reconciled(found) == [("email", 208, 270), ("ip", 300, 310)]
    # The same span is found wherever it lies, also across the edges of windows.
    pick = random.Random(4)
    for shift in range(150, 260, 7):
        text = (prose(pick, 100)[:shift] + " +1 (784) 555-9263 ").ljust(600, "a")
        assert any(kind == "phone" for kind, _, _ in pii.tagged(tagger, [text])[0])


@pytest.mark.parametrize("length", [1, 40, 60, 97, 200, 300, 700])
def test_pieces_are_joined_at_every_place(length):
    for start in range(0, 2 * pii.WINDOW):
        for kind in ("email", "phone"):
            pieces = []
            for at in pii._window_starts(start + length + 300):
                a, b = max(start, at), min(start + length, at + pii.WINDOW)
                if a < b:
                    pieces.append((a == at > 0, b == at + pii.WINDOW, kind, a, b))
            other = (False, False, "ip", start + length + 5, start + length + 12)
            for order in (pieces + [other], [other] + pieces[::-1]):
                assert pii._reconciled(pii._joined(order)) == [(kind, start, start + length), other[2:]]


def test_long_spans_are_alike_at_every_place(tagger):
    """What is found of a spelled-out address of over 48 characters does not depend on the edges."""
    pick = random.Random(5)
    left, right = prose(pick, 120), prose(pick, 60)
    spans = []
    while len(spans) < 5:
        made = pii._written_email(pick)
        spans += [made] * (len(made) > 44 and " " in made)
    whole = 0
    for span in spans:
        found = Counter()
        for shift in range(100, 420):
            text = f"{left[-shift:]} {span} {right}"
            at = shift + 1
            [got] = pii.tagged(tagger, [text])
            found[frozenset((a - at, b - at) for _, a, b in got if a < at + len(span) and b > at)] += 1
        [(most, times)] = found.most_common(1)
        assert times >= 0.97 * 320
        whole += most == {(0, len(span))}
    assert whole >= 3


def test_find_and_mask(spark, documents, tagger):
    texts = [None, "", "mail a.b@x.org now", "no data here", "4111 1111 1111 1111 and 10.0.0.1", "call (784) 555-9263 now"]
    docs = documents(texts + [texts[2]])
    rows = {row["doc_id"]: row["pii"] for row in pii.find(docs, tagger).collect()}
    for i, text in enumerate(texts):
        base = plain(text or "")
        listed = ",".join(f"{k}:{a}:{b}" for k in pii.KINDS for a, b in base[k])
        assert rows[i]["base_sha256"] == hashlib.sha256(listed.encode()).hexdigest()
        assert [rows[i][f"n_{k}"] for k in pii.KINDS] == [len(base[k]) for k in pii.KINDS]
        assert set(filter(None, listed.split(","))) <= set(rows[i]["spans"].split(","))
    assert rows[2] == rows[6]
    masked = pii.masked(docs, tagger)
    assert masked.columns == docs.columns
    found = {row["doc_id"]: row["text"] for row in masked.collect()}
    assert found[0] is None and found[1] == "" and found[2] == "mail <email> now" and found[3] == texts[3]
    assert "4111" not in found[4] and "10.0.0.1" not in found[4]


def test_fit_reads_a_bounded_sample(documents, monkeypatch):
    monkeypatch.setattr(pii, "STEPS", 2)
    monkeypatch.setattr(pii, "EXAMPLES", 50)
    for docs in (documents([None, "a b", ""]), documents(["x"]).where("false")):
        assert isinstance(pii.fit(docs, max_rows=2), bilstm.Tagger)
