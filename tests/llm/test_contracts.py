"""Whole neighbour lists, texts without letters, and licence files as they are found."""

import textwrap

import numpy as np

from worktide.llm import ann, language, licenses


def test_every_query_gets_all_its_neighbours(spark):
    rng = np.random.default_rng(7)
    centres = rng.normal(size=(33, 16))
    for count in (400, 120, 60, 11, 7):
        points = centres[np.arange(count) % 33] + rng.normal(scale=0.1, size=(count, 16))
        df = spark.createDataFrame([(i, v.tolist(), 1) for i, v in enumerate(points)], "vec_id long, embedding array<double>, rank int")
        found = {r.query_id: r["count"] for r in ann.nearest(df, df).groupBy("query_id").count().collect()}
        assert found == dict.fromkeys(range(count), min(10, count - 1))


def test_texts_without_letters_are_undetermined(spark):
    rows = [(i, t, "en" if i % 2 else "de") for i, t in enumerate(["das ist ein Text und noch einer, der nicht kurz ist", "this is a text and another one that is not short"] * 20)]
    model = language.learn(spark.createDataFrame(rows, "doc_id long, text string, lang string"), "doc_id", "text", "lang")
    odd = spark.createDataFrame([(1, "\u00bd \u00b2 \u2460"), (2, "\u2167"), (3, "12 _ 7"), (4, None), (5, ""), (6, "\u0301"), (7, "ein Text")], "doc_id long, text string")
    found = {r.doc_id: r.lang_pred for r in language.identify(odd, model).collect()}
    assert all(found[i] == language.UNKNOWN for i in range(1, 7)) and found[7] == "de"


HEADS = {
    "MIT": "MIT License\n\nCopyright (c) 2020 A. Person\n\n", "ISC": "ISC License\n\nCopyright 2019, Someone <a@b.example>\n\n", "Zlib": "zlib License\n\n(C) 1999 Company\n\n",
    "BSD-2-Clause": "BSD 2-Clause License\n\nCopyright (c) 2001, The Owners\nAll rights reserved.\n\n",
    "BSD-3-Clause": "# BSD 3-Clause \"New\" License\n\nCopyright \u00a9 by the owners. All rights reserved.\n\n", "Unlicense": "",
}


def test_licence_files_of_any_width_are_known(spark):
    whole = {name: text for name, text in licenses.KNOWN if len(text) > 200}
    rows = []
    for name, text in whole.items():
        for width in range(40, 121):
            wrapped = "\n\n".join(textwrap.fill(part, width, break_on_hyphens=False) for part in text.split("\n"))
            rows.append((name, HEADS[name] + wrapped + "\n"))
    df = spark.createDataFrame([(i, t, n) for i, (n, t) in enumerate(rows)], "doc_id long, text string, license_id string")
    found = {r.doc_id: r.license_id for r in licenses.scan(df).collect()}
    assert found == {i: n for i, (n, _) in enumerate(rows)}


def test_sentences_about_copyright_are_no_notices(spark):
    df = spark.createDataFrame([(1, "copyright holders may\nnot"), (2, "may\nnot"), (3, "Copyright 2020 x\nmay not"), (4, "x " * 400_000)], "doc_id long, text string")
    found = {r.doc_id: r.text_digest for r in licenses.scan(df).collect()}
    assert found[1] != found[2] and found[3] == found[2] and found[4]
