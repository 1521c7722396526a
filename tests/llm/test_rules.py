"""Quality rules against brute force."""

import random
import re
from collections import Counter, defaultdict

from aerolag.llm import neardup, rules
from tests.llm.conftest import prose


def split(text):
    return re.findall("[^\x20\x09-\x0d]+", text or "")


def counts(text):
    words, text = split(text), text or ""
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    often = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if often[w] > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if split(x)]
    return (
        len(words),
        sum(map(len, words)),
        sum(c in rules.SYMBOLS for c in text),
        len(lines) - len(set(lines)),
        len(covered),
    )


def brute(rows, line_docs, line_percent):
    """(id, counts, base_failed, kept) of rows (id, text, source)."""

    def norm(line):
        return re.sub("[0-9]+", "0", " ".join(split(line.lower())))

    holders, hosts = defaultdict(set), defaultdict(set)
    for _, text, source in rows:
        hosts[source].add(text or "")
        for line in (text or "").split("\n"):
            if split(line):
                holders[source, norm(line)].add(text or "")
    found = []
    for id_, text, source in rows:
        n, *rest = counts(text)
        failed = n < 50 or 100 * rest[3] > 50 * n
        left = n
        for line in (text or "").split("\n"):
            docs = len(holders.get((source, norm(line)), ()))
            if split(line) and docs > line_docs and docs * 100 > len(hosts[source]) * line_percent:
                left -= len(split(line))
        kept = not failed and left >= 50 and 100 * left >= 50 * n
        found.append((id_, n, *rest, failed, kept))
    return sorted(found, key=str)


def sample():
    pick = random.Random(4)
    footer, header = "Read 12 more  pages of this site", "READ 7 more pages of this site"
    texts = []
    for i in range(40):
        body = "\n".join(prose(pick, 20) for _ in range(pick.randint(1, 6)))
        line = "\n" + pick.choice([footer, header, footer + " now"]) if i % 2 else ""
        texts.append(body + line)
    texts += [None, "", " \n\t", "a b c " * 40, texts[3], texts[3], "x\n" * 60, prose(pick, 90, ["a", "b"])]
    # Too few words are left of these, so they are depleted.
    texts += [prose(pick, 42 + i) + f"\n{footer}\n{header}" for i in range(3)]
    return texts


def test_equals_brute_force(documents):
    texts = sample()
    sources = [None if i % 11 == 0 else f"s{i % 2}" for i in range(len(texts))]
    ids = [None if i == 5 else i // 2 if i > 44 else i for i in range(len(texts))]
    found = rules.quality_rules(documents(texts, ids, sources), line_docs=4, line_percent=10)
    rows = sorted((tuple(row)[:-1] for row in found.collect()), key=str)
    assert rows == brute(list(zip(ids, texts, sources)), 4, 10)
    assert any(not row[-1] and not row[-2] for row in rows)


def test_cleaned_documents_lose_frequent_lines_only(documents):
    texts = sample()
    docs = documents(texts)
    kept = rules.cleaned(docs, line_docs=4, line_percent=10)
    assert kept.columns == docs.columns
    found = {row["doc_id"]: row["text"] for row in kept.collect()}
    expected = {row[0] for row in brute([(i, t, "s") for i, t in enumerate(texts)], 4, 10) if row[-1]}
    assert set(found) == expected
    for id_, text in found.items():
        lines = [x for x in texts[id_].split("\n") if "more" not in x]
        assert text == "\n".join(lines)


def test_near_copies_keep_a_representative(documents):
    pick = random.Random(9)
    footer = "All rights reserved by this site"
    page = [prose(pick, 9) for _ in range(30)]
    texts = []
    for i in range(20):
        copy = list(page)
        copy[i] = prose(pick, 9)
        texts.append("\n".join([*copy, footer]))
    texts += ["\n".join([prose(pick, 30), prose(pick, 30), footer]) for _ in range(480)]
    kept = rules.cleaned(documents(texts))
    found = {row["doc_id"]: row["text"] for row in kept.collect()}
    spared = [found[i] for i in range(20) if i in found]
    # Pages without near copies are all there; boilerplate goes everywhere.
    assert set(range(20, 500)) < set(found) and len(spared) == 2
    assert not any(footer in text for text in found.values())
    # Every line of the page is in a text that is whole but for the footer.
    assert {x for text in spared for x in text.split("\n")} >= set(page)
    assert all(len(text.split("\n")) == 30 for text in spared)
    single = neardup.without_near_duplicates(kept).collect()
    assert len([row for row in single if row["doc_id"] < 20]) == 1 and len(single) == 481
    judged = rules.quality_rules(documents(texts), representatives=True)
    assert {row["doc_id"] for row in judged.where("kept").collect()} == set(found)


def test_empty_table(documents):
    none = documents(["x"]).where("false")
    assert rules.quality_rules(none).count() == 0 and rules.cleaned(none).count() == 0


def test_no_python_in_the_plan(documents):
    plan = rules.quality_rules(documents(["x"]))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
