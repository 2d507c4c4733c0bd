"""License notices: deciding words, several licenses of one block, notices inside prose."""
import pytest

from cadenza.llm import licenses

KNOWN = licenses.passages(licenses.TEMPLATES)


SAVING = licenses.savings(licenses.TEMPLATES)


def found(text, saving=SAVING):
    return [n for _, _, b in licenses.blocks(text, licenses.reach(KNOWN, 0.2)) for _, _, n, _ in licenses.notices(b, KNOWN, saving, 0.25, 0.2)]


@pytest.mark.parametrize("text,want", [
    ("Licensed under CC BY 4.0.", ["CC-BY-4.0"]),
    ("Licensed under CC BY-NC 4.0.", ["CC-BY-NC-4.0"]),
    ("Licensed under CC BY-NC 3.0.", []),
    ("This work is licensed under the Creative Commons Attribution 4.0 International License.", ["CC-BY-4.0"]),
    ("This work is licensed under the Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 International License.", ["CC-BY-NC-ND-4.0"]),
    ("GNU General Public License, version 2.", ["GPL-2.0"]),
    ("GNU Lesser General Public License, version 2.1.", ["LGPL-2.1"]),
    ("This work is licensed under the GNU General Public License, version 3.", ["GPL-3.0"]),
    ("This work is licensed under the GNU General Public License.", []),
    ("Licensed under the Apache License, Version 1.1.", []),
    ("Licensed under the Apache License.", []),
    ("This is not released under the MIT License.", []),
    ("Free software License, Version", []),
])
def test_deciding_words(text, want):
    assert found(text) == want


PROSE = "word " * 12


@pytest.mark.parametrize("text,want", [
    ("Released under the MIT License.\nLicensed under the Apache License, Version 2.0.", ["MIT", "Apache-2.0"]),
    ("Released under the MIT License\nLicensed under the Apache License, Version 2.0", ["MIT", "Apache-2.0"]),
    (f"{PROSE}is good. Released under the MIT License. {PROSE}", ["MIT"]),
    (f"{PROSE}is a tool released under the MIT License, which {PROSE}", ["MIT"]),
    ("Licensed under the MIT License or the Apache License, Version 2.0.", ["MIT", "Apache-2.0"]),
    ("SPDX-License-Identifier: MIT", ["MIT"]),
    ("// SPDX-License-Identifier: (GPL-2.0-only WITH Linux-syscall-note) OR MIT\ncode", ["GPL-2.0-only", "MIT"]),
    ("# This program is free software: you can redistribute it and/or modify\n# it under the terms of the GNU General Public License as published by\n# the Free Software Foundation, either version 3 of the License, or\n# (at your option) any later version.", ["GPL-3.0"]),
    ("Our work is\nreleased under the\nMIT License.", ["MIT"]),
])
def test_every_notice_of_a_block(text, want):
    assert found(text) == want


def test_spans(spark):
    text = "Intro line.\nReleased under the MIT License.\nLicensed under the Apache License, Version 2.0.\nSPDX-License-Identifier: ISC"
    x = licenses.license_scan(spark.createDataFrame([(1, text), (2, None)], "doc_id long, text string")).collect()
    assert [(r.license, text[r.start : r.end], r.differing) for r in x] == [("MIT", "Released under the MIT License.", []), ("Apache-2.0", "Licensed under the Apache License, Version 2.0.", []), ("ISC", "SPDX-License-Identifier: ISC", [])]


GRANT = licenses.TEMPLATES["MIT"].split(". ", 1)[1]


@pytest.mark.parametrize("glue", ["\n", "\n * ", " ", "  ", "\n# "])
def test_a_notice_of_any_number_of_lines(glue):
    """One word a line: no bound on lines, cues over line ends."""
    assert found(glue.join(GRANT.split())) == ["MIT"]
    assert found("Some words before.\n" + glue.join(licenses.TEMPLATES["GPL-3.0"].split()) + "\nMore words.") .count("GPL-3.0") >= 2


def test_compression_decides():
    """Without what the dictionaries save nothing is confirmed, and an inexact notice needs its saving."""
    none = lambda s: dict.fromkeys(licenses.TEMPLATES, 0.0)
    flat = lambda s: dict.fromkeys(licenses.TEMPLATES, 0.01)
    inexact = GRANT.replace("of charge", "of any charge").replace("deal in", "work with")
    assert found(GRANT, none) == found(inexact, none) == []
    assert found(inexact) == ["MIT"] and found(inexact, flat) == []
    wrong = lambda s: {n: v if n != "MIT" else 0.0 for n, v in SAVING(s).items()}
    assert found(GRANT, wrong) == []


@pytest.mark.parametrize("unit", ["MIT License ", "under the Apache License, Version 2.0 ", "GPLv2 or LGPL ", GRANT[:-1] + " "])
def test_a_line_of_a_million_letters(unit):
    import time

    text = unit * (1_000_000 // len(unit))
    t = time.time()
    names = set(found(text))
    assert time.time() - t < 10 and names <= {"MIT", "Apache-2.0", "GPL-2.0"}


def test_other_ids_and_awkward_rows(spark):
    rows = [("a", "Released under the MIT License."), (None, "Released under the MIT License."), ("a", None), ("b", ""), ("a", "Released under the MIT License.")]
    x = licenses.license_scan(spark.createDataFrame([(*r, 1) for r in rows], "doc_id string, text string, start int")).collect()
    assert sorted(str(r.doc_id) for r in x) == ["None", "a", "a"] and {r.license for r in x} == {"MIT"}
    assert licenses.license_scan(spark.createDataFrame([], "doc_id long, text string")).count() == 0
