import random

import pytest

from tidelog.llm import licenses, notices, queries
from tests.llm.conftest import EDGES, SMALL, documents

GIVEN = {
    "This work is licensed under the GNU General Public License, version 3.": "GPL-3.0",
    "Licensed under CC BY-NC 4.0.": "CC-BY-NC-4.0",
    "Released under the MIT License.": "MIT",
    "Licensed under the Apache License, Version 2.0.": "Apache-2.0",
}


def deciding(word):
    return any(w in notices.DECISIVE or w.isdigit() for w in licenses._words(word))


def names(text):
    return [n["license"] for n in licenses.Scanner().scan(text)]


def test_query_equals_exact_search(spark):
    rows = {r.doc_id: r for r in queries.QUERIES["op7_license_scan"](spark, SMALL).collect()}
    texts = {r.doc_id: r.text for r in documents(spark).collect()}
    assert rows.keys() == texts.keys()
    for i, text in texts.items():
        want = [v for k, v in GIVEN.items() for _ in range(text.count(k))]
        assert (rows[i].n_notices, rows[i].licenses) == (len(want), ",".join(sorted(set(want))))


def test_every_notice_is_found_in_prose_wrapped_and_reworded():
    rnd = random.Random(0)
    prose = "Nobody knew where the river went, and the old men said nothing of it."
    for name, notice in licenses.NOTICES:
        words = notice.split()
        wrapped = "\n".join(" ".join(words[i:i + 7]) for i in range(0, len(words), 7))
        assert names(f"{prose} {notice} {prose}") == [name], notice
        if len(words) > 7 and "v. 2.0" not in notice:
            assert names(f"{prose}\n{wrapped}\n{prose}") == [name], notice
        if len(words) > 15:
            plain = [i for i, w in enumerate(words) if i >= 5 and not deciding(w)]
            words[rnd.choice(plain)] = "altered"
            assert names(f"{prose}\n{' '.join(words).upper()}") == [name]


def test_other_texts_hold_no_notice():
    for text in ["my driving license was lost", "licensed by nobody, a license to use anything",
                 "the work of the public is general", "license " * 5000, "permission hereby granted"]:
        assert names(text) == []


def test_spans_and_order():
    text = "x y\nReleased under the MIT License.\nmore words\nLicensed under CC BY-NC 4.0. Bye."
    found = licenses.Scanner().scan(text)
    assert [text[n["start"]:n["stop"]] for n in found] == [
        "Released under the MIT License.", "Licensed under CC BY-NC 4.0."]
    assert all(n["n_diff"] == 0 and n["saving"] > 0.4 for n in found)


def test_long_runs_are_searched_whole():
    filler = " ".join(["licensed public license terms"] * 3000)
    found = names(f"{filler} Released under the MIT License. {filler}")
    assert found == ["MIT"]


def test_notices_inside_longer_sentences():
    """Each notice amid 20 to 200 varied words, without any sentence or line end around it."""
    rnd = random.Random(1)
    scanner = licenses.Scanner()
    for name, notice in licenses.NOTICES:
        for size in (20, 60, 200):
            prose = ["".join(rnd.choices("bdfgklmnoprstuvaeiou", k=rnd.randint(2, 10)))
                     for _ in range(size)]
            cut = rnd.randrange(size + 1)
            before, after = " ".join(prose[:cut] + [""]), " ".join(["", *prose[cut:]])
            bare = notice.rstrip(".:")
            found = scanner.scan(f"{before}{bare}{after}")
            assert [(n["license"], n["n_diff"]) for n in found] == [(name, 0)], (notice, size)
    for text in [
        "The source code of this package and its documentation are released under the MIT License "
        "and contributions are welcome from everybody.",
        "Copyright 2021 Jane Doe and others, all code in this repository is released under the MIT "
        "license, see the file for details.",
    ]:
        assert names(text) == ["MIT"]


def test_lines_with_two_notices():
    text = ("Our code is released under the MIT License and, as for the manual, this work is licensed "
            "under CC BY 4.0 since last year, while old parts stay released under the MIT License too")
    found = licenses.Scanner().scan(text)
    assert [text[n["start"]:n["stop"]] for n in found] == [
        "released under the MIT License", "this work is licensed under CC BY 4.0",
        "released under the MIT License"]
    assert names("It was released under the license that the owner chose.") == []


GNU = "This work is licensed under the GNU {} License, version {}."
HEADER = ("This {} is free software; you can redistribute it and/or modify it under the terms of the GNU {} "
          "License as published by the Free Software Foundation; either version {} of the License, or (at "
          "your option) any later version.")
TEXT = {name: [t for n, t in notices.TEXTS if n == name][-1] for name, _ in notices.TEXTS}


@pytest.mark.parametrize(("text", "want"), [
    (GNU.format("General Public", "2"), ["GPL-2.0"]),
    (GNU.format("General Public", "3.0"), ["GPL-3.0"]),
    (GNU.format("General Public", "2.1"), []),
    (GNU.format("General Public", "1"), []),
    (GNU.format("Lesser General Public", "2.1"), ["LGPL-2.1"]),
    (GNU.format("Lesser General Public", "3"), ["LGPL-3.0"]),
    (GNU.format("Lesser General Public", "2"), []),
    (GNU.format("Affero General Public", "3"), ["AGPL-3.0"]),
    (GNU.format("Affero General Public", "1"), []),
    (HEADER.format("program", "General Public", "2"), ["GPL-2.0-or-later"]),
    (HEADER.format("program", "General Public", "3"), ["GPL-3.0-or-later"]),
    (HEADER.format("library", "Lesser General Public", "2.1"), ["LGPL-2.1-or-later"]),
    (HEADER.format("library", "Lesser General Public", "4"), []),
    ("Licensed under the Apache License, Version 1.1.", []),
    ("This work is licensed under CC BY 3.0.", []),
    ("This work is licensed under CC BY-ND 4.0.", []),
    ("Licensed under CC BY-NC-SA 4.0.", []),
    ("SPDX-License-Identifier: GPL-2.0-or-later", ["GPL-2.0-or-later"]),
    ("// SPDX-License-Identifier: MIT\nint x;", ["MIT"]),
    ("SPDX-License-Identifier: MIT-0", []),
    ("SPDX-License-Identifier: BSD-4-Clause", []),
    ("Released under the BSD 4-Clause License.", []),
    (TEXT["BSD-2-Clause"], ["BSD-2-Clause"]),
    (TEXT["BSD-3-Clause"], ["BSD-3-Clause"]),
    (TEXT["BSD-3-Clause"].replace("copyright holder", "Regents").replace("source code", "code"), ["BSD-3-Clause"]),
    (TEXT["BSD-3-Clause"].replace(" Redistributions", "\n  1. Redistributions", 1), ["BSD-3-Clause"]),
    (TEXT["BSD-3-Clause"].replace("derived from", "x y z q w e r t a s d f g"), ["BSD-3-Clause"]),
    (TEXT["BSD-3-Clause"].replace("Neither the name of the copyright holder nor the names of its", "The"), []),
    (TEXT["BSD-2-Clause"].split(":")[0], []),
    (TEXT["MIT"], ["MIT"]), (TEXT["ISC"], ["ISC"]), (TEXT["Zlib"], ["Zlib"]),
])
def test_another_version_or_variant_is_never_named(text, want):
    assert names(f"Some words before. {text} Some words behind.") == want


def test_every_decisive_word_decides():
    """Dropping a decisive word of a notice, or changing a number in it, never gives its license."""
    for name, notice in notices.NOTICES:
        words, scanner = notice.split(), licenses.Scanner([(name, notice)])
        numbered = any(c.isdigit() for c in notice)
        for i, word in enumerate(words):
            if deciding(word) and (numbered or not word[0].isdigit()):
                changed = [*words[:i], *([word.replace("3", "7").replace("2", "7").replace("4", "7")
                                          .replace("1.0", "7.0")] if any(c.isdigit() for c in word) else []),
                           *words[i + 1:]]
                if changed != words:
                    assert scanner.scan(" ".join(changed)) == [], changed


def test_compression_ranks_and_cuts(monkeypatch):
    """What is found rests on the bytes saved: without them the notice that sorts first would win."""
    rnd = random.Random(3)
    texts = ["Old. " + TEXT[n] + " New." for n in ("BSD-3-Clause", "MIT", "GPL-3.0-or-later")]
    scanner = licenses.Scanner()
    want = [scanner.scan(t) for t in texts]
    assert [[n["license"] for n in found] for found in want] == [["BSD-3-Clause"], ["MIT"], ["GPL-3.0-or-later"]]
    ranks = [scanner.ranked(*self_regions(scanner, t)) for t in texts]
    assert all(r[0][0] < r[-1][0] < 0 for r in ranks)
    long, short = (next(i for i, (n, w) in enumerate(scanner.notices) if n == "MIT" and len(w) > size)
                   for size in (40, 20))
    words = licenses._words(TEXT["MIT"])
    assert scanner.saved(long, words)[0] > scanner.saved(short, words)[0]
    # Of a notice's own words in any other order a dictionary saves too little, however many there are.
    mixed = [" ".join(rnd.sample(licenses._words(TEXT["Zlib"]), 70)) for _ in range(5)]
    kept = sum(len(scanner.ranked(*self_regions(scanner, t))) for t in mixed)
    monkeypatch.setattr(scanner, "saved", lambda i, words, alone=None: (10**4, 10**5))
    assert sum(len(scanner.ranked(*self_regions(scanner, t))) for t in mixed) > kept
    assert [scanner.scan(t) for t in texts] != want


def self_regions(scanner, text):
    words = licenses._words(text)
    at = {}
    for k, w in enumerate(words):
        at.setdefault(w, []).append(k)
    import numpy as np
    at = {w: np.array(p) for w, p in at.items()}
    return words, [(i, a, b) for i in range(len(scanner.notices)) for a, b in scanner.regions(i, at, len(words))]


def test_edges(edges, nothing):
    rows = licenses.scan_licenses(edges).collect()
    assert sorted((repr(r.doc_id), len(r.notices)) for r in rows) == sorted(
        (repr(i), 0) for i, _ in EDGES)
    assert licenses.scan_licenses(nothing).collect() == []
