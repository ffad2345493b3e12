import random
import string

import zstandard

from glosswork.llm import licenses as lic

APACHE = lic.TEMPLATES["Apache-2.0"][0]


LETTERS = string.ascii_letters + string.digits


def found(docs, rows, **more):
    return [
        (r.doc_id, r.license, (dict(rows)[r.doc_id] or "")[r.start : r.end])
        for r in sorted(lic.find_licenses(docs(rows), **more).collect(), key=lambda r: (str(r.doc_id), r.start))
    ]


def test_notices_with_their_spans(docs):
    prose = "The quick brown fox jumps over lazy dogs while it rains. " * 8
    mit = lic.TEMPLATES["MIT"][2]
    rows = [
        (0, None), (1, ""), (2, prose), (3, "é\n" + APACHE), (4, prose + APACHE + " " + prose),
        (5, prose + mit.replace(" ", "\n  ", 20) + prose), (6, "my driving licence and copyright matters"),
        (7, "This work is licensed under the GNU General Public License, version 2."),
        (8, "Licensed under CC BY-SA 4.0.\n" + prose + "\nReleased under the MIT License."),
        (9, "Licensed under the Apache License, Version 1.1."),
        (10, "This  WORK is licensed under\nthe GNU General Public License version 3"),
    ]
    got = found(docs, rows)
    assert [(i, name) for i, name, _ in got] == [
        (10, "GPL-3.0"), (3, "Apache-2.0"), (4, "Apache-2.0"), (5, "MIT"), (7, "GPL-2.0"), (8, "CC-BY-SA-4.0"), (8, "MIT"),
    ]
    assert [t for i, _, t in got if i in (3, 4)] == ["Licensed under the Apache License, Version 2.0"] * 2


def test_small_differences_are_listed(docs):
    text = lic.TEMPLATES["BSD-3-Clause"][0].replace("provided that", "provided solely that").replace("are met", "met")
    r = lic.find_licenses(docs([(1, text)])).first()
    assert (r.license, r.missing, r.extra) == ("BSD-3-Clause", ["are"], ["solely"])


def test_short_notices_inside_running_text(docs):
    """A short notice saves little in text that does not repeat itself, and is reported all the same."""
    rng = random.Random(17)
    words = ["".join(rng.choice(LETTERS) for _ in range(rng.randint(3, 11))) for _ in range(5000)]
    prose = lambda n: " ".join(rng.choice(words) for _ in range(n))
    notices = ["Licensed under CC BY 4.0.", "Released under the MIT License.", "SPDX-License-Identifier: MIT"]
    rows = [(i, f"{prose(200)} {notices[i % 3]} {prose(200)}") for i in range(60)]
    got = {i: name for i, name, _ in found(docs, rows)}
    assert got == {i: ("CC-BY-4.0", "MIT", "MIT")[i % 3] for i in range(60)}


def test_repeated_rows_and_empty(docs):
    assert len(found(docs, [(1, APACHE), (1, APACHE)])) == 2
    assert found(docs, []) == []


def test_templates_rank_by_conditional_compression():
    ranked = lic.Scanner(lic.TEMPLATES).ranked(lic.TEMPLATES["MIT"][2], 0.2)
    assert ranked[0][1:3] == ("MIT", 2) and ranked[0][0] > 0.8
    raw = zstandard.ZstdCompressionDict(b"abc" * 50, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    assert raw.dict_id() == 0


def test_other_templates(docs):
    text = "This text may be copied under the Harbor Licence as long as its boats are named."
    assert found(docs, [(1, text + " More words.")], templates={"Harbor": [text]}) == [(1, "Harbor", text[:-1])]
