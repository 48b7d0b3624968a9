"""Documents with several licences report all of them."""
import pytest

from panelspark.llm import licences

MIT = "Released under the MIT License."
GPL = "This work is licensed under the GNU General Public License, version 3."
APACHE = "Licensed under the Apache License, Version 2.0."
AGPL = "You should have received a copy of the GNU Affero General Public License along with this program."
BY_SA = "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."


@pytest.fixture(scope="module")
def model(spark):
    return licences.train(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"))


def test_all_families_of_a_document(spark, model):
    texts = [f"intro\n{MIT}\nmiddle of it\n{GPL}", f"{MIT} {GPL}", f"{APACHE}\n{MIT}\n{APACHE}", AGPL, BY_SA, "no licence", None]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = {r.doc_id: r for r in licences.scan(df, model).collect()}
    want = [["gpl", "mit"], ["gpl", "mit"], ["apache", "mit"], ["agpl"], ["cc-by-sa"], [], []]
    assert [rows[i].families for i in range(len(texts))] == want
    assert [rows[i].n_paragraphs for i in range(len(texts))] == [2, 1, 3, 1, 1, 0, 0]
    got = {(r.doc_id, r.paragraph, r.family) for r in licences.notices(df, model).collect()}
    assert got == {(0, 1, "mit"), (0, 3, "gpl"), (1, 0, "mit"), (1, 0, "gpl"), (2, 0, "apache"), (2, 1, "mit"), (2, 2, "apache"),
                   (3, 0, "agpl"), (4, 0, "cc-by-sa")}


KNOWN = {
    "MIT License": "mit", "The MIT License (MIT)": "mit", "Apache License\nVersion 2.0, January 2004": "apache", "SPDX-License-Identifier: BSD-2-Clause": "bsd",
    "// SPDX-License-Identifier: EPL-2.0": "epl", "Eclipse Public License - v 2.0": "epl",
    "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY.": "mit",
    "Distributed under the Boost Software License, Version 1.0.": "boost",
    "This program and the accompanying materials are made available under the terms of the Eclipse Public License v2.0": "epl",
    "# SPDX-License-Identifier: GPL-2.0-only": "gpl", "SPDX-License-Identifier: CC-BY-SA-4.0": "cc-by-sa", "* SPDX-License-Identifier: ISC": "isc",
    "GNU GENERAL PUBLIC LICENSE\n   Version 3, 29 June 2007": "gpl", "Released under the zlib License.": "zlib", "GNU Lesser General Public License": "lgpl",
}
# held-out wording: other lead-ins, copyright lines, wrapped texts
VARIANTS = {
    "mit": "Copyright (c) 2019 A. Writer\n\nPermission is hereby granted, free of charge, to any person obtaining a copy\n"
           "of this software and associated documentation files (the \"Software\"), to deal\nin the Software without restriction, including without limitation the rights",
    "apache": "   Licensed under the Apache License, Version 2.0 (the \"License\");\n   you may not use this file except in compliance with the License.\n"
              "   You may obtain a copy of the License at",
    "gpl": "foo is free software: you can redistribute it and/or modify\nit under the terms of the GNU General Public License as published by\n"
           "the Free Software Foundation, either version 3 of the License, or",
    "lgpl": "You should have received a copy of the GNU Lesser General Public License along with Foo.",
    "agpl": "bar is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the FSF.",
    "bsd": "Redistribution and use in source and binary forms, with or without\nmodification, are permitted provided that the following conditions are met:",
    "mpl": " * This Source Code Form is subject to the terms of the Mozilla Public\n * License, v. 2.0. If a copy of the MPL was not distributed with this\n * file, You can obtain one at",
    "zlib": "In no event will the authors be held liable for any damages arising from the use of this software",
    "cc-by": "Except where noted, this work is licensed under a Creative Commons Attribution 4.0 International License.",
    "cc-by-nc": "This photo is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    "public-domain": "This is free and unencumbered software released into the public domain!",
    "isc": "Permission to use, copy, modify, and distribute this software for any purpose with or without fee is hereby granted, provided that",
}
CLEAN = ["This project is not licensed under the terms of the MIT license.", "The library was never released under the BSD 3-Clause License.",
         "Files here are not yet licensed under the Apache License, Version 2.0.",
         "She took the licence exam in Boston and passed.", "The apache helicopter landed in the desert.", "", "mit", "License", "General public"]


def test_known_notices_variants_and_clean_lines(spark, model):
    texts = [*KNOWN, *VARIANTS.values(), "MIT OR Apache-2.0", "SPDX-License-Identifier: (MIT AND GPL-3.0-or-later)", *CLEAN]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = {r.doc_id: r.families for r in licences.scan(df, model).collect()}
    want = [[f] for f in [*KNOWN.values(), *VARIANTS]] + [["apache", "mit"], ["gpl", "mit"]] + [[]] * len(CLEAN)
    wrong = {texts[i]: (rows[i], w) for i, w in enumerate(want) if rows[i] != w}
    assert not wrong, wrong


def test_templates_of_ones_own(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    table = spark.createDataFrame([("house", "house/0", "You may read this text at home but must not print it.", False),
                                   ("house", "house/1", "House Licence", True)], licences.TABLE)
    own = licences.train(docs, table=table)
    df = spark.createDataFrame([(1, "a\nYou may read this text at home but must not print it!"), (2, "House Licence"), (3, "Released under the MIT License.")],
                               "doc_id long, text string")
    assert {r.doc_id: r.families for r in licences.scan(df, own).collect()} == {1: ["house"], 2: ["house"], 3: []}


def test_scores_levels_and_overlaps_recomputed(spark, model):
    """Every reported notice again, in plain Python: probability above the level, overlap with its template."""
    import math
    import re
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    weight = dict(model.weights)
    texts = {r[1]: r[2] for r in model.table}
    exact = {r[1]: r[3] for r in model.table}

    def tokens(t):
        return [w for w in re.sub(r"[^\w]|_", " ", t.lower()).split() if w]

    def gram_list(ws, n):
        return [" ".join(ws[i:i + n]) for i in range(len(ws) - n + 1)]

    def three(ws):
        return set(gram_list(ws, 3)) if len(ws) >= 3 else {" ".join(ws)}

    line = {r.doc_id: (r.text or "").split("\n") for r in docs.collect()}
    found = licences.notices(docs, model).collect()
    assert len(found) > 30
    for r in found:
        ws = tokens(line[r.doc_id][r.paragraph])
        z = list(model.intercept)
        for g in {g for n in (1, 2, 3) for g in gram_list(ws, n)}:
            z = [a + b for a, b in zip(z, weight.get(g, [0.0] * len(z)))]
        e = [math.exp(x - z[0]) for x in z]
        assert 1 - 1 / sum(e) > model.level
        assert e[model.classes.index(r.family)] / sum(e) == pytest.approx(r.probability, rel=1e-6)
        a, b = three(ws), three(tokens(texts[r.template]))
        shares = (len(a & b) / len(a), len(a & b) / len(b))
        assert r.overlap == pytest.approx((min if exact[r.template] else max)(shares)) and r.overlap >= licences.CONFIRM
    reported = {(r.doc_id, r.paragraph) for r in found}
    for doc, lines in line.items():        # and nothing that is a template's text word for word is missed
        for k, t in enumerate(lines):
            if any(tokens(t) == tokens(x) for x in ("Released under the MIT License.", "Licensed under CC BY 4.0.")):
                assert (doc, k) in reported


def test_unknown_paragraphs_of_every_document_are_learned_from(spark):
    """A phrase of the house's own template that one in 6,000 of 24,000 documents also has, in other words."""
    table = spark.createDataFrame([("house", "house/0", "the quick house licence lets anybody copy and sell this work", False)], licences.TABLE)
    texts = [f"report {i} about matters of no note" for i in range(24_000)]
    for i in range(0, 24_000, 6_000):
        texts[i] = f"number {i} lets anybody copy"
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    listed = licences.numbered(spark, licences.rows_of(spark, table))
    lines = licences.looked_up(docs, "text", listed)
    assert lines.count() == 24_000 and lines.filter("size(at) > 0").count() == 4
    lines = lines.checkpoint()
    own = licences.train(docs, table=table, lines=lines)
    assert licences.train(docs, table=table).weights == own.weights
    got = {r.doc_id: r.families for r in licences.scan(docs, own, found=(listed, lines)).filter("n_paragraphs > 0").collect()}
    assert got == {r.doc_id: r.families for r in licences.scan(docs, own).filter("n_paragraphs > 0").collect()}
