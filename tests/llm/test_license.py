"""License scans on notices set into prose."""

import random
import textwrap

import pytest

from aerolag.llm import license
from tests.llm.conftest import prose


def sample(count=80):
    pick = random.Random(6)
    texts, truth = [], []
    for i in range(count):
        lines = [prose(pick, pick.randint(3, 40)) for _ in range(pick.randint(1, 5))]
        family = pick.choice(sorted(license.TEMPLATES)) if i % 2 else None
        if family:
            lines.insert(pick.randint(0, len(lines)), pick.choice(license.TEMPLATES[family]))
        texts.append("\n".join(lines))
        truth.append(family)
    return texts, truth


def test_notices_are_found_and_prose_is_not(documents):
    texts, truth = sample()
    texts += [None, "", " \n ", texts[1]] + license.NO_LICENCE
    truth += [None, None, None, truth[1]] + [None] * len(license.NO_LICENCE)
    docs = documents(texts)
    model = license.fit(docs)
    scanned = license.scanned(docs, model)
    assert scanned.columns == [*docs.columns, "licences"]
    for row in scanned.collect():
        text, found = texts[row["doc_id"]], row["licences"]["found"]
        assert row["licences"]["n_paragraphs"] == sum(bool(line.strip()) for line in (text or "").split("\n"))
        assert [f["family"] for f in found] == ([truth[row["doc_id"]]] if truth[row["doc_id"]] else [])
        for f in found:
            assert text.split("\n")[f["line"]] in license.TEMPLATES[f["family"]]
            assert f["template"] >= license.CONFIRMED and model.least <= f["probability"] <= 1


def test_empty_table_still_gives_a_model(documents):
    none = documents(["x"]).where("false")
    model = license.fit(none)
    assert license.scanned(none, model).count() == 0
    assert license.scan(model, [b"Released under the MIT License."])[0]["found"][0]["family"] == "mit"


def set_in(pick, notice, way):
    """A notice wrapped, commented or inside a long line, among prose."""
    before, after = prose(pick, pick.randint(20, 90)), prose(pick, pick.randint(20, 90))
    if way == "embedded":
        return f"{before} {notice} {after}"
    lines = textwrap.wrap(notice, pick.choice([40, 72]))
    if way == "commented":
        mark = pick.choice(["# ", "// ", " * ", ";; "])
        return "\n".join([mark.strip(), *[mark + line for line in lines], mark.strip(), before, after])
    return "\n".join([before, *lines, after])


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_wrapped_commented_and_embedded_notices(documents, seed):
    pick = random.Random(seed)
    model = license.fit(documents([prose(pick, 200) for _ in range(60)] + ["\n".join(prose(pick, 12) for _ in range(9)) for _ in range(60)]))
    tried = hit = wrong = 0
    for family, templates in license.TEMPLATES.items():
        # Notices of a few words name a family only on a line of their own.
        for notice in (t for t in templates if len(t.split()) > 9):
            for way in ("wrapped", "commented", "embedded"):
                found = license.scan(model, [set_in(pick, notice, way).encode()])[0]["found"]
                tried += 1
                hit += [f["family"] for f in found] == [family]
                wrong += any(f["family"] != family for f in found)
    assert tried >= 40 and hit / tried >= 0.9 and wrong / tried <= 0.02
    clean = [prose(pick, pick.randint(5, 300)) for _ in range(200)] + license.NO_LICENCE
    assert not any(result["found"] for result in license.scan(model, [text.encode() for text in clean]))


def test_very_long_texts_and_no_words():
    model = license.train([])
    texts = [b"word " * 60_000, b"\n" * 1000, None, b"x" * 300_000]
    assert [result["found"] for result in license.scan(model, texts)] == [[]] * 4


def test_a_notice_within_a_very_long_text(documents):
    pick = random.Random(17)
    vocabulary = prose(pick, 3000).split()
    notice = max(license.TEMPLATES["mit"], key=len)
    before = "\n".join(prose(pick, 400, vocabulary) for _ in range(150))
    long_line = prose(pick, 60_000, vocabulary)
    docs = documents([f"{before}\n{notice}\n{before}", f"{long_line} {notice} {long_line}", before, long_line])
    model = license.fit(documents([prose(pick, 60, vocabulary) for _ in range(100)]))
    found = {row["doc_id"]: row["licences"] for row in license.scanned(docs, model).collect()}
    assert [[f["family"] for f in found[i]["found"]] for i in range(4)] == [["mit"], ["mit"], [], []]
    assert found[0]["found"][0]["line"] == 150
