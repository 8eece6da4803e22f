"""Whole licences, their usual headings and markers, and notices over several lines."""

from __future__ import annotations

import re
import textwrap

from seriesmill.llm import licences

COPYRIGHT = "Copyright (c) 2020, Somebody\nAll rights reserved.\n\n"


def test_whole_licences(make):
    files = {p.stem: p.read_text("utf-8") for p in licences.TEXTS.glob("*.txt")}
    bsd = f"{licences._BSD}\n\n{licences._BSD_3}\n\n{licences._BSD_REST}"
    texts = {
        **files,
        "Apache-2.0 filled": re.sub(r"Copyright \[yyyy\].*", "Copyright 2021 Somebody", files["Apache-2.0"]),
        "Apache-2.0 short": files["Apache-2.0"].split("END OF TERMS")[0],
        "BSD-3-Clause headed": "BSD 3-Clause License\n\n" + COPYRIGHT + bsd,
        "BSD-3-Clause bullets": "BSD 3-Clause License\n\n" + COPYRIGHT + re.sub(r"\s([123])\. ", "\n\n* ", bsd).replace("3. Neither", "* Neither"),
        "MIT headed": "The MIT License\n\n" + COPYRIGHT + licences._MIT,
    }
    names = list(texts)
    found = {names[r.doc_id]: r.license_id for r in licences.scan(make(list(enumerate(texts.values())))).collect()}
    assert found == {n: n.split(" ")[0] for n in names}
    assert {"Apache-2.0", "GPL-2.0", "GPL-3.0", "LGPL-2.1", "LGPL-3.0", "MPL-2.0", "CC0-1.0", "Unlicense"} <= set(files)


def test_runs_of_lines(make, spark):
    wrapped = "\n".join(textwrap.wrap(licences._MIT, 60))
    rows = [
        (1, f"Some words\n\n{wrapped}\n\nmore words"),
        (2, "Text\nLicensed under the\nApache License,\nVersion 2.0.\nEnd"),
        (3, "Licensed under the Apache License, Version 2.0. And more"),  # does not end with a line
        (4, "Text\nLicensed\nunder the\n\nMIT License"),
        (5, "/text\n" + "\n".join(textwrap.wrap(licences._APACHE_NOTICE, 70))),
    ]
    assert {r.doc_id: r.notices for r in licences.scan(make(rows)).collect()} == {1: "MIT", 2: "Apache-2.0", 3: "", 4: "MIT", 5: "Apache-2.0"}
    known = spark.createDataFrame([("A", "one"), ("B", "one two\nthree")], "license_id string, text string")
    found = licences.scan(make([(1, "x\none\ntwo three\nfour"), (2, "one"), (3, "one two")]), known).collect()
    assert {(r.doc_id, r.license_id, r.notices) for r in found} == {(1, None, "A,B"), (2, "A", "A"), (3, None, "")}
    assert licences.scan(make([(1, "one")]), known.limit(0)).first().notices == ""
