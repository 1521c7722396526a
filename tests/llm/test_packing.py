"""Packing: every id once, gapless sequences, target proportions in every window."""

import functools
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from aerolag.llm import packing
from tests.llm.conftest import prose

FILES = (
    public_tokenizers.path("byte_bpe_50k.json"),
    public_tokenizers.path("byte_bpe_50k.tiktoken"),
    public_tokenizers.PATTERN,
)


@functools.lru_cache
def tokenizer():
    return Tokenizer.from_file(FILES[0])


def ids_of(text):
    return tokenizer().encode(text or "", add_special_tokens=False).ids + [0]


def test_both_encoders_agree_on_odd_texts():
    encoder = packing.Encoder(*FILES)
    texts = ["", " ", "a" * 40_000, "don't  stop\n\n\n x", "<|endoftext|>", "é ñ 漢字 🤦🏼‍♂️ ‍\x00", "1 234 5.6", " \t  x"]
    for text in texts:
        assert np.frombuffer(encoder.ids(text), np.uint16).tolist() == ids_of(text)


@settings(max_examples=60, deadline=None)
@given(st.text(max_size=60))
def test_both_encoders_agree(text):
    encoder = packing._encoder(*FILES)
    assert np.frombuffer(encoder.ids(text), np.uint16).tolist() == encoder.slow.encode(text, add_special_tokens=False).ids + [0]


@settings(max_examples=50, deadline=None)
@given(st.lists(st.integers(1, 4000), min_size=1, max_size=6), st.integers(1, 300), st.data())
def test_schedule_is_deficit_round_robin(totals, window, data):
    weights = data.draw(st.lists(st.integers(1, 50), min_size=len(totals), max_size=len(totals)))
    schedule = packing.Schedule(totals, weights, window)
    # Played round by round: credit by weight, a token when credit reaches a half.
    order, credit, sent = [], [0] * len(totals), [0] * len(totals)
    while len(order) < sum(totals):
        for queue, weight in enumerate(weights):
            credit[queue] += weight
            if 2 * credit[queue] >= sum(weights) and sent[queue] < totals[queue]:
                credit[queue] -= sum(weights)
                sent[queue] += 1
                order.append(queue)
    for w in range(schedule.windows + 1):
        counts = Counter(order[: w * window])
        assert schedule.sent(w) == tuple(counts[q] for q in range(len(totals)))


def check(documents_rows, pieces, ids=None):
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for p in pieces:
        by_doc[p["doc_id"]].append(p)
        by_sequence[p["sequence_id"]].append((p["offset"], p["length"]))
    for doc_id, text in documents_rows:
        expected, at = ids_of(text), 0
        for p in sorted(by_doc.pop(doc_id), key=lambda p: p["start"]):
            part = expected[p["start"] : p["start"] + p["length"]]
            assert p["start"] == at and len(part) == p["length"] > 0
            assert p["ids_crc32"] == zlib.crc32(np.array(part, "<u4").tobytes())
            assert p["doc_tokens"] == len(expected)
            if ids:
                assert p["ids"] == part
            at += len(part)
        assert at == len(expected)
    assert not by_doc
    fill = []
    for sequence in sorted(by_sequence):
        at = 0
        for offset, length in sorted(by_sequence[sequence]):
            assert offset == at
            at += length
        fill.append(at)
    assert sorted(by_sequence) == list(range(len(fill)))
    assert all(n == packing.SEQUENCE for n in fill[:-1]) and fill[-1] <= packing.SEQUENCE


@pytest.mark.parametrize("with_ids", [False, True])
def test_every_id_is_in_one_piece(documents, with_ids):
    pick = random.Random(3)
    texts = [prose(pick, pick.randint(0, 300)) for _ in range(60)] + [None, "", prose(pick, 6000)]
    sources = [pick.choice(["a", "a", "a", "b", None, ""]) for _ in texts]
    docs = documents(texts, None, sources).repartition(4)
    pieces = packing.pack(docs, *FILES, window_sequences=2, with_ids=with_ids).collect()
    check(list(enumerate(texts)), pieces, with_ids)


def test_windows_hold_the_proportions(documents):
    pick = random.Random(6)
    texts = [prose(pick, 150) for _ in range(120)]
    sources = ["a" if i % 3 else "b" for i in range(120)]
    for targets, share in ((None, None), ({"a": 1, "b": 1}, 0.5)):
        docs = documents(texts, None, sources).repartition(5)
        pieces = packing.pack(docs, *FILES, targets=targets, window_sequences=4).collect()
        check(list(enumerate(texts)), pieces)
        tokens = Counter()
        for p in pieces:
            tokens[p["sequence_id"] // 4, sources[p["doc_id"]]] += p["length"]
        whole = sum(n for (_, s), n in tokens.items() if s == "a") / sum(tokens.values())
        full = 4 * packing.SEQUENCE
        for w in range(2):
            assert abs(tokens[w, "a"] - full * (share or whole)) <= 2


def test_many_sources_share_a_queue_and_empty_table(documents, monkeypatch):
    monkeypatch.setattr(packing, "RANGE_TOKENS", 500)
    pick = random.Random(7)
    texts = [prose(pick, pick.randint(1, 40)) for _ in range(40)]
    docs = documents(texts, None, [f"s{i % 8}" for i in range(40)]).repartition(3)
    check(list(enumerate(texts)), packing.pack(docs, *FILES).collect())
    assert packing.pack(documents(["x"]).where("false"), *FILES).count() == 0


WORDS = prose(random.Random(1), 3000).split()


def shares(pieces, sources, window):
    """Tokens of each source per window."""
    tokens = defaultdict(Counter)
    for p in pieces:
        tokens[p["sequence_id"] // window][sources[p["doc_id"]]] += p["length"]
    return tokens


def test_partial_targets_are_shares_and_hold_for_small_sources(documents, monkeypatch):
    monkeypatch.setattr(packing, "MIN_DUE", 100_000)
    pick = random.Random(8)
    sources = [f"s{i % 8}" for i in range(400)]
    texts = [prose(pick, 150 if s != "s7" else 20, WORDS) for s in sources]
    targets = {"s1": 3, "s7": 1}
    pieces = packing.pack(documents(texts, None, sources).repartition(5), *FILES, targets=targets, window_sequences=16).collect()
    check(list(enumerate(texts)), pieces)
    tokens = shares(pieces, sources, 16)
    whole = Counter()
    for counts in tokens.values():
        whole += counts
    rest = sum(n for s, n in whole.items() if s not in targets) / sum(whole.values())
    full = 16 * packing.SEQUENCE
    aimed = tokens[0]
    assert abs(aimed["s1"] - full * (1 - rest) * 3 / 4) <= 2 and abs(aimed["s7"] - full * (1 - rest) / 4) <= 2
    assert abs(sum(n for s, n in aimed.items() if s not in targets) - full * rest) <= 5
    with pytest.raises(ValueError):
        packing.pack(documents(["x"]), *FILES, targets={"s": 0})


def test_a_thousand_sources(documents):
    pick = random.Random(9)
    sources = [f"s{i % 1000:03}" for i in range(2000)]
    texts = [prose(pick, 30, WORDS) for _ in sources]
    targets = {"s990": 1, "s991": 1}
    pieces = packing.pack(documents(texts, None, sources).repartition(4), *FILES, targets=targets, window_sequences=4).collect()
    check(list(enumerate(texts)), pieces)
    tokens = shares(pieces, sources, 4)
    whole = sum((Counter(c) for c in tokens.values()), Counter())
    aimed = (whole["s990"] + whole["s991"]) / sum(whole.values()) / 2
    # Of two equal targets the one with fewer tokens ends first; until then both hold.
    for window in range(len(tokens) // 2):
        for source in targets:
            assert abs(tokens[window][source] - aimed * 4 * packing.SEQUENCE) <= 2


@pytest.mark.parametrize("targeted", [False, True])
def test_shares_of_a_thousand_sources(documents, monkeypatch, targeted):
    """Sources with queues of their own hold their shares to two tokens, however many they are."""
    monkeypatch.setattr(packing, "MIN_DUE", 2)
    pick = random.Random(10)
    sources = [f"s{i % 1000:03}" for i in range(2000)]
    texts = [prose(pick, 20 + 20 * (i % 3), WORDS) for i in range(2000)]
    targets = {f"s{i:03}": 1 + i % 2 for i in range(1000)} if targeted else None
    pieces = packing.pack(documents(texts, None, sources).repartition(4), *FILES, targets=targets, window_sequences=8).collect()
    check(list(enumerate(texts)), pieces)
    tokens = shares(pieces, sources, 8)
    weights = targets or sum((Counter(c) for c in tokens.values()), Counter())
    for source, weight in weights.items():
        assert abs(tokens[0][source] - weight / sum(weights.values()) * 8 * packing.SEQUENCE) <= 2


def test_small_sources_send_documents_in_turn(documents, monkeypatch):
    """At every end of a document each small source is within two documents of its share, and the
    order is that of the turns, over however many ranges they are summed."""
    pick = random.Random(11)
    sources = [f"s{pick.randint(0, 60):02}" for _ in range(900)] + [f"once{i}" for i in range(100)]
    texts = [prose(pick, pick.randint(10, 60), WORDS) for _ in sources]
    docs = documents(texts, None, sources).repartition(4)
    monkeypatch.setattr(packing, "MIN_DUE", 100_000)
    found = []
    for tokens in (1 << 22, 700):
        monkeypatch.setattr(packing, "RANGE_TOKENS", tokens)
        found.append(packing.pack(docs, *FILES, window_sequences=4).collect())
        check(list(enumerate(texts)), found[-1])
    ends, firsts = [], []
    for p in found[0]:
        at = p["sequence_id"] * packing.SEQUENCE + p["offset"]
        if p["start"] + p["length"] == p["doc_tokens"]:
            ends.append((at + p["length"], sources[p["doc_id"]], p["doc_tokens"]))
        if p["start"] == 0:
            firsts.append((at, p["doc_id"]))
    whole, longest = Counter(), max(n for _, _, n in ends)
    for _, source, n in ends:
        whole[source] += n
    sent = Counter()
    for end, source, n in sorted(ends):
        sent[source] += n
        for s in whole:
            assert abs(sent[s] - whole[s] * end / sum(whole.values())) <= 2 * longest
    # Sources of one document are spread over the queue.
    halves = [at < sum(whole.values()) / 2 for at, d in firsts if sources[d].startswith("once")]
    assert len(halves) == 100 and 25 < sum(halves) < 75
    key = lambda p: (p["doc_id"], p["start"])
    assert sorted(found[0], key=key) == sorted(found[1], key=key)


def test_weights_are_in_one_unit():
    assert packing.weights_of([100_000] * 3, [None] * 3) == [100_000] * 3
    weights = packing.weights_of([100_000] * 3, [1, 3, None])
    assert [w / sum(weights) for w in weights] == pytest.approx([1 / 6, 1 / 2, 1 / 3])
