import pytest

from footfall.llm import licenses
from footfall.llm.common import Scratch
from tests.llm.helpers import documents, empty, odd_documents, prose

MIT = dict(licenses.FULL_TEXTS[:1])["MIT"]
APACHE = "Licensed under the Apache License, Version 2.0."


def found(spark, texts):
    got = licenses.find_licenses(documents(spark, texts, clashing=True)).collect()
    return {r.doc_id: (r.licenses, r.whole) for r in got}


def test_notices_and_texts_in_any_spelling(spark):
    shouted = "MIT  LICENCE\n\nCopyright (c) 2020 Some One\n\n" + MIT.replace("sublicense", "sub-licence").upper()
    texts = [
        prose(1) + "\n" + APACHE,
        "licenced under the  APACHE licence version 2.0",
        MIT,
        prose(2) + "\n\n" + shouted + "\n\n" + prose(3),
        "Released under the MIT License.\nLicensed under CC BY-NC 4.0.",
        "This work is licensed under the GNU General Public License, version 3.",
        "They are licensed under the Apache License, Version 2.0 of course",
        prose(4),
        None,
        "",
    ]
    got = found(spark, texts)
    assert got[0] == ("Apache-2.0", False)
    assert got[1] == ("Apache-2.0", True)
    assert got[2] == ("MIT", True)
    assert got[3] == ("MIT", False)
    assert got[4] == ("CC-BY-NC-4.0,MIT", False)
    assert got[5] == ("GPL-3.0", True)
    assert all(got[k] == ("", False) for k in (6, 7, 8, 9))


def test_line_breaks_within_a_paragraph_do_not_matter(spark):
    wrapped = "\n\n".join("\n".join(p.split(" ")) for p in MIT.split("\n\n"))
    assert found(spark, [wrapped, wrapped.replace("\n", "\r\n")]) == {0: ("MIT", True), 1: ("MIT", True)}


def test_every_known_text_is_found(spark):
    known = licenses.known_licenses()
    got = found(spark, [f"{prose(k, 12)}\n\n{text}" for k, (_, text) in enumerate(known)])
    assert all(name in got[k][0].split(",") for k, (name, _) in enumerate(known))


def test_full_texts_as_projects_carry_them(spark):
    bodies = dict(licenses.BODIES)
    head = "Copyright (c) 2019, Some One\nAll rights reserved.\n\n"
    starred = bodies["BSD-3-Clause"].replace("\n\nRedis", "\n\n* Redis").replace("\n\nNeither", "\n\n* Neither")
    texts = [
        "BSD 3-Clause License\n\n" + head + starred,
        prose(5) + "\n\n" + head + bodies["BSD-2-Clause"].replace("COPYRIGHT HOLDER ", "COPYRIGHT OWNER "),
        "(C) 1995 A. Nother\n\n" + bodies["Zlib"].replace("acknowledgment", "acknowledgement"),
        bodies["Unlicense"].replace("https://unlicense.org", "http://unlicense.org/").replace(". ", ".\n"),
        bodies["Unlicense"].replace("perpetuity", "perpetual"),
    ]
    got = found(spark, texts)
    assert got[0] == ("BSD-3-Clause", True)
    assert got[1] == ("BSD-2-Clause", False)
    assert got[2] == ("Zlib", True)
    assert got[3] == ("Unlicense", True)
    assert got[4] == ("", False)


def test_markers_follow_the_known_texts(spark):
    """A licence with none of the usual words is found, in each of its spellings."""
    known = [("A", "You may favor whatever organization pleases you"), ("B", "Go on 12")]
    texts = ["you may FAVOUR whatever organisation pleases you", "go - on: 12!", prose(2)]
    assert list(found_known(spark, texts, known[:1])) == ["A", "", ""]
    assert list(found_known(spark, texts, known)) == ["A", "B", ""]
    assert licenses.markers(["organization it", "organization that", "sublicense others"]) == ["organi", "others"]
    assert licenses.markers(["license"]) == ["licen"]
    assert licenses.markers(["favor it"]) == [""]  # four letters in common with favour
    assert licenses.markers(["go on"]) == licenses.markers([]) == [""]


def found_known(spark, texts, known):
    got = licenses.find_licenses(documents(spark, texts), known=known).orderBy("doc_id").collect()
    return [r.licenses for r in got]


def test_odd_documents_and_empty_table(spark):
    odd = odd_documents(spark)
    assert licenses.find_licenses(odd).count() == odd.count()
    assert licenses.find_licenses(empty(spark)).collect() == []


@pytest.mark.parametrize("known", [[("X", "Permission one\n\nPermission two\n\nPermission three")]])
def test_runs_of_paragraphs(spark, known):
    texts = ["a\n\npermission one\n\npermission two\n\npermission three\n\nb", "permission one\n\npermission two"]
    got = licenses.find_licenses(documents(spark, texts), known=known).orderBy("doc_id").collect()
    assert [r.licenses for r in got] == ["X", ""]


def test_markers_of_the_listed_licenses_are_few(spark):
    listed = licenses._canonical_known(spark, licenses.known_licenses(), Scratch(spark))
    marks = licenses.markers([r.canon for r in listed.collect()])
    assert "licen" in marks and "" not in marks and len(marks) <= 8
