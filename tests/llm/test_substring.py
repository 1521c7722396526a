"""Sentence spans against a plain search for repeated runs."""

import random

from aerolag.llm import substring
from aerolag.llm.common import SPACES, words_in
from tests.llm.conftest import prose


def cut(text):
    """Sentences of a text as lists of words, in order."""
    words = words_in([(text or "").encode()], SPACES)
    starts = substring.sentences(words)
    plain = (text or "").encode().lower().split()
    return [plain[a:b] for a, b in zip(starts, starts[1:])]


def runs(sentences):
    for i in range(len(sentences)):
        j, count = i, 0
        while j < len(sentences) and (count < substring.MIN_WORDS or j < i + substring.MIN_SENTENCES):
            count += len(sentences[j])
            j += 1
        if count >= substring.MIN_WORDS and j >= i + substring.MIN_SENTENCES:
            yield i, j, tuple(w for s in sentences[i:j] for w in s)


def brute(rows):
    """{id: numbers of the sentences removed} of rows with different ids."""
    first, gone = {}, {}
    for id_, text in sorted(rows):
        covered = set()
        for i, j, run in runs(cut(text)):
            if first.setdefault(run, (id_, i)) != (id_, i):
                covered |= set(range(i, j))
        gone[id_] = covered
    return gone


def sentence(pick):
    return prose(pick, pick.randint(3, 12)).capitalize() + pick.choice([". ", "! ", "\n", ".\n"])


def sample():
    pick = random.Random(3)
    shared = ["".join(sentence(pick) for _ in range(9)) for _ in range(4)]
    shared.append(prose(pick, 60) + "\n")
    texts = []
    for i in range(50):
        parts = [sentence(pick) for _ in range(pick.randint(0, 12))]
        if i % 2:
            parts.insert(pick.randint(0, len(parts)), pick.choice(shared))
        texts.append("".join(parts))
    texts += [texts[1], texts[3], None, "", "\n", "short. text.", shared[0] * 3, "no marks " * 40]
    return texts


def test_equals_plain_search(documents):
    texts = sample()
    ids = list(range(len(texts)))
    random.Random(1).shuffle(ids)
    docs = documents(texts, ids).repartition(5)
    made = substring.deduplicated(docs)
    assert made.columns == [*docs.columns, "dedup"]
    expected = brute(list(zip(ids, texts)))
    by_id = dict(zip(ids, texts))
    for row in made.collect():
        gone, said = expected[row["doc_id"]], cut(by_id[row["doc_id"]])
        found = row["dedup"]
        assert (found["n_sentences"], found["n_removed"]) == (len(said), len(gone))
        left = [w for i, s in enumerate(said) if i not in gone for w in s]
        assert (found["text"] or "").encode().lower().split() == left
        if not gone:
            assert found["text"] == by_id[row["doc_id"]]


def test_passages_of_over_fifty_words_are_caught(documents):
    pick = random.Random(11)
    for marks in (True, False):
        passage = "".join(sentence(pick) for _ in range(10)) if marks else prose(pick, 60)
        texts = [f"{prose(pick, 30)} {passage} {prose(pick, 30)}" for _ in range(20)]
        rows = substring.deduplicated(documents(texts)).collect()
        removed = {row["doc_id"]: row["dedup"]["n_words_removed"] for row in rows}
        assert removed[0] == 0 and all(removed[i] >= 20 for i in range(1, 20))


def plain_runs(text):
    """Runs of a text by the letter of the method, without arrays."""
    words, out = text.encode().lower().split(), set()
    hashes = [int(h) for h in words_in([text.encode()], SPACES).hashes]
    marked = [w[-1:] in (b".", b"!", b"?") or i == len(words) - 1 for i, w in enumerate(words)]
    keys = [(not m, h >> 1) for m, h in zip(marked, hashes)]
    cuts = {0} | {i + 1 for i, m in enumerate(marked) if m}
    for i in range(len(words) - 9):
        cuts.add(max(range(i, i + 10), key=lambda j: (tuple(-x for x in keys[j]), j)) + 1)
    cuts = sorted(cuts)
    for n, a in enumerate(cuts):
        for b in cuts[n + 2 :]:
            if b - a >= 20:
                out.add(tuple(words[a:b]))
                break
    return out


def test_every_shared_span_of_fifty_words_holds_a_run():
    lengths = [49, 50, 51, 60]
    for seed in range(600):
        pick = random.Random(seed)
        vocabulary = None if seed % 3 else [f"w{pick.random()}" for _ in range(1 + seed % 5)]
        passage = prose(pick, lengths[seed % 4], vocabulary)
        if seed % 2:
            passage = " ".join(w + "." if pick.random() < 0.05 else w for w in passage.split())
        pair = [f"{prose(pick, pick.randint(0, 30))} {passage} {prose(pick, pick.randint(0, 30))}" for _ in range(2)]
        found = [{run for _, _, run in runs(cut(text))} for text in pair]
        assert found == [plain_runs(text) for text in pair]
        held = passage.lower().encode()
        assert any(b" ".join(run) in held for run in found[0] & found[1])


def test_scripts_without_blanks(documents):
    pick = random.Random(2)

    def chinese(count, low=0x4E00, high=0x9FA5):
        return "".join(chr(pick.randint(low, high)) for _ in range(count))

    for passage in (chinese(60), chinese(60, 0x3041, 0x3096), chinese(60, 0x0E01, 0x0E2E), "abc" + chinese(50) + "def"):
        texts = [chinese(30) + passage + "\u3002" + chinese(30) for _ in range(6)]
        rows = sorted(substring.deduplicated(documents(texts)).collect())
        removed = [row["dedup"]["n_words_removed"] for row in rows]
        assert removed[0] == 0 and all(20 <= n <= 63 for n in removed[1:])
        for row, text in zip(rows, texts):
            assert row["dedup"]["text"].startswith(text[:30]) and row["dedup"]["text"].endswith(text[-30:])


def test_null_ids_repeated_rows_and_empty_table(documents):
    pick = random.Random(12)
    text, other = ("".join(sentence(pick) for _ in range(12)) for _ in range(2))
    docs = documents([text, text, text, other, other, None], [4, None, 4, None, None, None])
    rows = substring.deduplicated(docs).collect()
    gone = sorted((str(row["doc_id"]), row["dedup"]["n_removed"] > 0, row["text"] == text) for row in rows)
    # The row with an id keeps the text, both times; the one without loses it; those without spare each other.
    assert gone == [("4", False, True)] * 2 + [("None", False, False)] * 3 + [("None", True, True)]
    assert substring.deduplicated(documents(["x"]).where("false")).count() == 0
