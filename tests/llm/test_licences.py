import os

import pytest
from cases import empty, odd  # noqa: F401
from millrace.llm import licences
from pyspark.sql import functions as F


def found(spark, texts):
    frame = spark.createDataFrame([(n, t, "x") for n, t in enumerate(texts)], "doc_id long, text string, digest string")
    return [(r["doc_id"], r["unit"], r["line"], r["licence"]) for r in licences.scan_licences(frame).orderBy("doc_id", "line").collect()]


def test_whole_licences_in_other_clothes(spark):
    mit = dict((t, n) for n, t in licences.KNOWN if t.startswith("MIT License"))
    text = next(iter(mit))
    body = text.split("\n\n", 1)[1]
    dressed = "MIT Licence\r\n\r\nCopyright (c) 2020 Some One\n" + body.upper().replace(",", " ,").replace(". ", ".\n  * ").replace("SUBLICENSE", "sub-licence").replace("COPYRIGHT HOLDERS", "Copyright  Holders")
    got = found(spark, [text, dressed, text + " And more."])
    assert [g for g in got if g[1] == "text"] == [(0, "text", 0, "MIT"), (1, "text", 0, "MIT"), (2, "text", 0, None)]


def test_every_whole_licence_below_any_copyright_line(spark):
    whole = [(name, text) for name, text in licences.KNOWN if len(text) > 300]
    assert {"MIT", "ISC", "BSD-2-Clause", "BSD-3-Clause", "0BSD", "Unlicense", "Zlib", "BSL-1.0"} == {name for name, _ in whole}
    lines = ["Copyright Jane Doe 2020\n", "Copyright (c) 2019-2021, Some One.\nAll rights reserved.\n", "Copyright 2020 the authors\n", "Copyright The Authors, 2019 - present\n"]
    got = found(spark, [lines[n % 4] + text for n, (_, text) in enumerate(whole)] + ["Copyright " + whole[0][1]])
    assert [g[3] for g in got if g[1] == "text"] == [name for name, _ in whole] + [None]


def test_sentences_on_copyright_stay(spark):
    frame = spark.createDataFrame([("copyright law was changed in 1976 and then again\nCopyright Jane Doe 2020\ncopyright notices stay",)], "text string")
    assert frame.select(licences.canonical_lines(F.col("text")).alias("x")).first()["x"] == ["copyright law was changed in 1976 and then again", "copyright notices stay"]


FOLDER = "/usr/share/common-licenses"
FILES = {
    "Apache-2.0": "Apache-2.0", "Artistic": "Artistic-1.0-Perl", "CC0-1.0": "CC0-1.0", "GFDL-1.2": "GFDL-1.2", "GFDL-1.3": "GFDL-1.3", "GPL-1": "GPL-1.0", "GPL-2": "GPL-2.0",
    "GPL-3": "GPL-3.0", "LGPL-2": "LGPL-2.0", "LGPL-2.1": "LGPL-2.1", "LGPL-3": "LGPL-3.0", "MPL-1.1": "MPL-1.1", "MPL-2.0": "MPL-2.0",
}


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no licence texts on this machine")
def test_long_licences_by_their_digests(spark):
    texts, names = [], []
    for file, name in FILES.items():
        with open(f"{FOLDER}/{file}", encoding="utf-8", errors="replace") as f:
            text = f.read()
        texts += [text, text[:len(text) // 2]]
        names += [name, None]
        if "\n\n" in text and "END OF TERMS AND CONDITIONS" in text:
            texts.append(text[:text.index("END OF TERMS AND CONDITIONS")].upper() + "End of terms and conditions.")
            names.append(name)
    got = found(spark, texts)
    assert [g[3] for g in got if g[1] == "text"] == names


def test_lines(spark):
    got = found(spark, ["Words here\nreleased under the MIT Licence!!\nmore\n(c) 2001 x\nLicensed under CC BY-NC 4.0", None, "", "All rights reserved."])
    assert got == [(0, "text", 0, None), (0, "line", 2, "MIT"), (0, "line", 4, "CC-BY-NC-4.0"), (1, "text", 0, None), (2, "text", 0, None), (3, "text", 0, None)]


def test_odd_rows_and_a_table_of_licences(spark, odd, empty):
    out = licences.scan_licences(odd)
    assert out.filter("unit = 'text'").count() == odd.count() and out.columns[: len(odd.columns)] == odd.columns
    own = spark.createDataFrame([("Own-1", "a b")], "licence string, text string")
    own = own.select(licences.digest(licences.canonical_lines(F.col("text"))).alias("known_digest"), "licence")
    assert [r["text"] for r in licences.scan_licences(odd, known=own).filter("unit = 'text' and licence = 'Own-1'").collect()] == ["a b"]
    assert licences.scan_licences(empty).count() == 0
