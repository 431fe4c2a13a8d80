from collections import Counter

import pytest

from lakeops.llm.decontamination import words
from lakeops.llm.licenses import DICE, TEMPLATES, Scanner, _AS_IS_BSD, _BSD_2, _BSD_3, _whole, license_passages, templates_of
from tests.llm.conftest import prose


def plain(text: str, templates) -> set[tuple[str, float]]:
    """Every license of which some window of the template's size is alike enough, with its best Dice."""
    w, best = words(text.encode()), {}
    for t in templates:
        size = min(t.size, len(w))
        for i in range(len(w) - size + 1):
            window = Counter(zip(w[i : i + size], w[i + 1 : i + size]))
            total = sum(window.values()) + t.size - 1
            dice = 2 * sum((window & Counter(t.bigrams)).values()) / total if size > 1 else 0
            if dice >= DICE:
                best[t.license] = max(best.get(t.license, 0), dice)
    return set(best.items())


def test_planted_notices():
    templates = templates_of(TEMPLATES)
    scanner = Scanner(templates, DICE)
    for i, (name, text) in enumerate(TEMPLATES):
        changed = text.replace("the", "THE!!", 1)
        found = scanner.passages(words(f"{prose(i, 150)} {changed} {prose(i + 50, 90)}".encode()))
        assert name in {f[2] for f in found}
        assert 150 - 2 <= min(f[0] for f in found if f[2] == name) <= 152
    assert scanner.passages(words(prose(3, 5000).encode())) == []
    assert [f[2] for f in scanner.passages(words(b"Licensed under CC BY-NC 4.0. " * 3))] == ["CC-BY-NC-4.0"] * 3


def test_best_of_each_text_equals_all_windows(spark, small):
    docs, texts = small
    templates = templates_of(TEMPLATES)
    rows = license_passages(docs).collect()
    assert len(rows) == len(texts) and any(r["license"] for r in rows)
    for r in rows:
        want = plain(texts[r["doc_id"]], templates)
        assert (r["license"] is None) == (not want)
        if want:
            assert r["dice"] == max(d for _, d in want) and (r["license"], r["dice"]) in want and set(r["licenses"].split(",")) <= {n for n, _ in want}


def test_odd_rows(odd_documents, no_documents):
    rows = license_passages(odd_documents).collect()
    assert len(rows) == odd_documents.count() and not any(r["license"] for r in rows)
    assert license_passages(no_documents).count() == 0
    assert license_passages(odd_documents, texts=[("two", "two words"), ("none", "")]).filter("license = 'two'").count() == 2


@pytest.fixture(scope="module")
def scanner():
    return Scanner(templates_of(TEMPLATES), DICE)


CC = "This article is licensed under a Creative Commons Attribution-{} 4.0 International License."


@pytest.mark.parametrize(
    ("text", "name"),
    [
        (CC.format("NonCommercial"), "CC-BY-NC-4.0"), (CC.format("NoDerivatives"), "CC-BY-ND-4.0"), (CC.format("NonCommercial-NoDerivatives"), "CC-BY-NC-ND-4.0"), (CC.format("ShareAlike"), "CC-BY-SA-4.0"),
        ("Licensed under CC BY-NC-ND 4.0.", "CC-BY-NC-ND-4.0"), ("This work is licensed under the GNU General Public License, version 2.", "GPL-2.0"), ("It is licensed under the GNU General Public License, version 2.0 only", "GPL-2.0"),
        ("This work is licensed under the GNU Lesser General Public License, version 2.1.", "LGPL-2.1"), ("This library is licensed under the GNU Affero General Public License, version 3.", "AGPL-3.0"),
        (_BSD_2 + " " + _BSD_3.replace("the copyright holder", "Example Inc.") + " " + _AS_IS_BSD.replace("COPYRIGHT HOLDER OR", "REGENTS OR"), "BSD-3-Clause"),
        (_BSD_2 + " " + _AS_IS_BSD.replace("COPYRIGHT HOLDER OR", "REGENTS OR"), "BSD-2-Clause"), (_whole("Apache-2.0").replace("Work", "Piece"), "Apache-2.0"), (_whole("GPL-2").replace("Program", "Tool"), "GPL-2.0"),
        (_whole("GPL-3").replace("covered work", "thing"), "GPL-3.0"), (_whole("LGPL-2.1").replace("Library", "Module"), "LGPL-2.1"),
    ],
)
def test_notices_that_are_no_templates_get_their_own_name(scanner, text, name):
    found = scanner.passages(words(f"{prose(1, 80)} {text} {prose(2, 80)}".encode()))
    assert {f[2] for f in found} == {name}
    if len(text) > 5_000:
        assert max(b - a for a, b, _, _ in found) > 0.9 * len(words(text.encode()))


@pytest.mark.parametrize(
    ("text", "name"),
    [
        (dict(x[::-1] for x in TEMPLATES if x[0] == "MIT-0" and len(x[1]) > 300).popitem()[0].replace("persons", "people"), "MIT-0"),
        ("Permission to use, copy, modify and/or distribute this code for any purpose with or without fee is hereby granted. THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS.", "0BSD"),
        ("This library is distributed under the Boost Software License, Version 1.0.", "BSL-1.0"), ("It is licensed under the Eclipse Public License, version 2.0, since then.", "EPL-2.0"),
        ("The crate is licensed under either of the Apache License, Version 2.0 or the MIT license at your option.", "Apache-2.0 OR MIT"),
        ("see http://creativecommons.org/licenses/by-nc/3.0/ for terms", "CC-BY-NC-3.0"), ("terms: https://opensource.org/licenses/MIT", "MIT"), ("GNU General Public License, version 2.", "GPL-2.0"),
        ("GNU Lesser General Public License, version 2.1.", "LGPL-2.1"), ("Released under the zlib license, that is: licensed under the zlib License.", "Zlib"),
    ],
)
def test_other_families(scanner, text, name):
    found = scanner.passages(words(f"{prose(1, 80)} {text} {prose(2, 80)}".encode()))
    assert {f[2] for f in found} == {name}


@pytest.mark.parametrize("text", ["This work is licensed under the GNU General Public License, version 7.", "This work is licensed under a Creative Commons Attribution-NonCommercial 9.0 International License."])
def test_other_versions_get_no_near_name(scanner, text):
    assert scanner.passages(words(text.encode())) == []
