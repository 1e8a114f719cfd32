import re
import textwrap

import pytest
import regex

from conftest import SMALL
from llm_fixtures import documents  # noqa: F401
from tickloom.llm import licenses

UPPER = str.maketrans(licenses._UPPER, licenses._LOWER)


@pytest.fixture(scope="module")
def known(spark):
    return licenses.known_texts(spark)


def scan(spark, known, documents, *rows):
    return {r.doc_id: (r.license, r.notices) for r in licenses.scan(documents(*rows), known).collect()}


def test_whole_texts_match_whatever_their_dress(spark, known, documents):
    mit = dict(licenses.TEXTS)["MIT"]
    dressed = "Copyright (c) 2020 Someone\n\n" + mit.upper().replace(",", " ,").replace('"', "“").replace(" ", "\n  ")
    found = scan(spark, known, documents, (1, mit), (2, dressed), (3, mit + " More."), (4, mit.replace("sell", "rent")))
    assert found[1][0] == found[2][0] == "MIT" and found[3][0] is None and found[4][0] is None


def test_spellings(spark, known, documents):
    found = scan(spark, known, documents, (1, "Licenced under the Apache Licence, Version 2.0."))
    assert found[1] == ("Apache-2.0", ["Apache-2.0"])


def test_notices_of_lines(spark, known, documents):
    text = "Some words.\nReleased under the MIT License.\n© 2019 Me\nreleased under the mit licence\nLicensed under CC BY 4.0."
    found = scan(spark, known, documents, (1, text), (2, "We like the MIT License."))
    assert found[1] == (None, ["CC-BY-4.0", "MIT"]) and found[2] == (None, [])


def test_odd_rows(spark, known, documents):
    line = "Released under the MIT License."
    rows = [(1, None), (2, ""), (3, "  \n\n"), (4, "Copyright 2020 X"), (5, line), (5, line), (5, "other"), (None, line)]
    found = licenses.scan(documents(*rows), known).collect()
    assert len(found) == len(rows)
    assert sorted((r.doc_id or 0, r.license or "") for r in found) == [
        (0, "MIT"), (1, ""), (2, ""), (3, ""), (4, ""), (5, ""), (5, "MIT"), (5, "MIT")]
    assert licenses.scan(documents(), known).count() == 0
    long = "word " * 50_000 + "\n" + line
    assert scan(spark, known, documents, (1, long))[1] == (None, ["MIT"])


def test_licence_files_and_wrapped_notices(spark, known, documents):
    full = {p.stem: p.read_text() for p in licenses.FILES.glob("*.txt")}
    mit, bsd = dict(licenses.TEXTS)["MIT"], dict(licenses.TEXTS)["BSD-3-Clause"]
    rows = [*enumerate(full.values(), 10), (1, "MIT License\n\nCopyright (c) 2020 X\n\n" + mit),
            (2, "BSD 3-Clause License\n\nCopyright (c) 2020, X\nAll rights reserved.\n\n" + bsd.replace("1. ", "* ").replace("2. ", "* ").replace("3. ", "* ")),
            (3, full["Apache-2.0"].split("APPENDIX")[0]),
            (4, "Words.\n\n# This project is licensed under\n# the MIT License.\n\nMore words."), (5, mit + "\nAll rights reserved by us.")]
    found = scan(spark, known, documents, *rows)
    assert {n: found[i][0] for i, n in enumerate(full, 10)} == {n: n for n in full}
    assert [found[i][0] for i in range(1, 6)] == ["MIT", "BSD-3-Clause", "Apache-2.0", None, None]
    assert found[4][1] == ["MIT"]


def wrapped(text, width):
    parts = [" ".join(p.split()) for p in re.split(r"\n[ \t]*\n", text) if p.strip()]
    return "\n\n".join(textwrap.fill(p, width, break_long_words=False, break_on_hyphens=False) for p in parts)


def test_texts_in_other_line_breaks(spark, known, documents):
    """Clauses that begin with (c) are no copyright lines. Those that name their holder over several lines need them as published,
    or each paragraph on one line."""
    files = [(p.stem, p.read_text()) for p in licenses.FILES.glob("*.txt")]
    own = [(spdx, f"Copyright (c) 2020, 2021 X\n\n{text}") for spdx, text in licenses.TEXTS]
    cases = [(spdx, wrapped(text, 10**9)) for spdx, text in files + own]
    for spdx, text in files + own:
        if "Free Software Foundation" not in text or spdx == "GPL-3.0-or-later":
            cases += [(spdx, wrapped(text, width)) for width in (60, 80, 100)]
    found = scan(spark, known, documents, *enumerate(t for _, t in cases))
    assert {i: found[i][0] for i in found} == {i: spdx for i, (spdx, _) in enumerate(cases)}


def test_query_against_plain_digests(spark, known):
    """The whole table, with normalising in Python."""
    def normal(text):
        text = re.sub(licenses._COPYRIGHT_LINE.replace(r"\z", r"\Z"), " ", text.translate(UPPER))
        text = " " + regex.sub(licenses._NOT_WORD, " ", text).strip(" ") + " "
        for variant, usual in licenses.SPELLINGS:
            text = text.replace(f" {variant} ", f" {usual} ")
        return text.strip(" ")

    table = {}
    for r in known.collect():
        table.setdefault(normal(r.text), set()).add(r.license)
    table.pop("", None)
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    found = {r.doc_id: (r.license, r.notices) for r in licenses.scan(docs, known).collect()}
    hits = 0
    for r in docs.collect():
        text = r.text or ""
        pieces = text.split("\n") + [b for b in re.split(r"\n[ \t\r]*\n", text) if "\n" in b]
        whole = table.get(normal(text))
        notices = sorted({"+".join(sorted(table[n])) for p in pieces if (n := normal(p)) in table})
        assert found[r.doc_id] == ("+".join(sorted(whole)) if whole else None, notices)
        hits += bool(notices)
    assert hits
