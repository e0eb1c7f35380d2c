"""Planted license files, wrapped headers and SPDX lines, with made-up project names around them."""

import textwrap

import pytest

from recordloom.llm import licenses

SCHEMA = "doc_id bigint, path string, text string"
CODE = "\n".join(f"def function_{i}(value):\n    return value + {i} * offset_{i}\n" for i in range(60))
PROSE = " ".join(f"The garden of the town was open to the visitors and, as it is said, the keeper {i} had to copy the rules in a book." for i in range(80))


def scan(spark, rows):
    return {r.doc_id: (r.license, r.how, r.origin) for r in licenses.license_scan(spark.createDataFrame(rows, SCHEMA)).collect()}


def comment(text, mark, width):
    return "\n".join(f"{mark} {line}".rstrip() for line in textwrap.wrap(text, width))


def test_license_files_grant_their_directories(spark):
    full = licenses.full_texts()
    assert {"MIT", "BSD-2-Clause", "BSD-3-Clause", "Apache-2.0", "GPL-2.0", "GPL-3.0", "LGPL-2.1", "LGPL-3.0", "MPL-2.0", "ISC"} <= set(full)
    rows, names = [], sorted(full)
    for i, name in enumerate(names):
        text = "Project Zebra\nCopyright (c) 2019-2024 Zoe Example and contributors\n\n" + "\n\n".join(
            "\n".join(textwrap.wrap(p, 60)) for p in full[name].split("\n\n")
        )
        rows += [(10 * i, f"p{i}/LICENSE", text), (10 * i + 1, f"p{i}/src/deep/code", CODE)]
    rows.append((999, "other/code", PROSE + " No license here."))
    out = scan(spark, rows)
    for i, name in enumerate(names):
        assert out[10 * i] == (name, "file", None) and out[10 * i + 1] == (name, "inherited", f"p{i}")
    assert out[999] == (None, "none", None)


@pytest.mark.parametrize("width", [36, 52, 70, 100])
@pytest.mark.parametrize("mark", ["#", "//", " *"])
def test_wrapped_headers(spark, width, mark):
    texts = licenses.HEADERS | {"MPL-2.0": licenses.TEMPLATES["MPL-2.0"], "MIT": licenses.full_texts()["MIT"]}
    rows = [
        (i, f"a{i}/code", f"{mark} zebra.py\n{mark} Copyright 2020 Zoe Example\n{mark}\n{comment(text, mark, width)}\n{CODE}") for i, text in enumerate(texts.values())
    ]
    assert [v[:2] for _, v in sorted(scan(spark, rows).items())] == [(name, "header") for name in texts]


def test_spdx_lines(spark):
    names = ["MIT", "Apache-2.0", "GPL-2.0-only WITH Classpath-exception-2.0", "(MIT OR Apache-2.0)", "BSD-3-Clause"]
    rows = [(i, f"a{i}/code", f"/* SPDX-License-Identifier: {name} */\n{CODE}") for i, name in enumerate(names)]
    out = scan(spark, rows)
    assert [out[i][:2] for i in range(len(names))] == [(name, "header") for name in names]
