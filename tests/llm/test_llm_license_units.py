"""Whole texts, blocks of lines and identifiers of license files, against a cosine worked out unit by unit."""

import math
import re
from collections import Counter

import pytest

from recordloom.llm import licenses
from recordloom.llm.common import keyed

FULL = licenses.full_texts()


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text))


def blocks(lines, parting, which):
    """Runs of neighbouring lines of a kind: text outside comments, comments, or neither."""
    def kind(line):
        return 0 if not re.search(parting, line) else 1 if re.search(licenses.COMMENT, line) else 2

    start = 0
    for i in range(1, len(lines) + 1):
        if i == len(lines) or kind(lines[i]) != kind(lines[start]):
            yield start * 2 + which, "\n".join(lines[start:i])
            start = i


def brute_force(files):
    """Sorted (doc, line, license, score) of (doc, text)."""
    patterns = {f"{k}-full": v for k, v in FULL.items()} | {f"{k}-block": v for k, v in licenses.HEADERS.items()} | licenses.TEMPLATES
    known = {k: Counter(words(v)) for k, v in patterns.items()}
    vocabulary = {w for c in known.values() for w in c}
    df = Counter(w for _, t in files for w in set(words(t)) & vocabulary)
    n = len(files)
    weight = lambda w: math.log((1 + n) / (1 + df[w])) + 1 if w in vocabulary else math.log(1 + n) + 1
    length = lambda c: math.sqrt(sum((k * weight(w)) ** 2 for w, k in c.items()))
    out = []
    for doc, text in files:
        if not re.search(licenses.MENTION, text):
            continue
        lines = text.split("\n")
        first = [u for u in blocks(lines, r"\S", 0) if re.search(licenses.MENTION, u[1])]
        second = [u for u in blocks(lines, "[a-zA-Z0-9]", 1) if re.search(licenses.MENTION, u[1]) and u[1] not in {t for _, t in first}]
        for line, unit in [(-1, text), *first, *second]:
            own, scored = Counter(words(unit)), []
            for name, pattern in known.items():
                dot = sum(k * pattern[w] * weight(w) ** 2 for w, k in own.items())
                score = round(dot / (length(own) * length(pattern)), 6) if dot else 0.0
                if score >= (licenses.LEAST_FULL if name.endswith("-full") else licenses.LEAST_COSINE) and (line >= 0 or name.endswith("-full")):
                    scored.append((-score, name))
            if scored:
                minus, name = min(scored)
                out.append((doc, line, re.sub("-(header|block|full)$", "", name), -minus))
        for i, line in enumerate(lines):
            if m := re.search(licenses.SPDX, line):
                out.append((doc, i * 2, m[1], 1.0))
    return sorted(out)


def wrapped(text, width, prefix):
    lines, line = [], ""
    for word in text.split():
        if len(line) + len(word) > width:
            lines, line = [*lines, prefix + line.rstrip()], ""
        line += word + " "
    return "\n".join([*lines, prefix + line.rstrip()])


def files():
    gpl, agpl, apache = licenses.HEADERS["GPL-3.0"], licenses.HEADERS["AGPL-3.0"], licenses.HEADERS["Apache-2.0"]
    reworded = gpl.replace("This program", "Frobnicator").replace("useful", "of use").replace("along with this program", "with Frobnicator")
    epl = "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0."
    unlicense = "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use it."
    code = "import os\n\ndef run(x):\n    return x + 1\n"
    texts = [
        *FULL.values(),
        *[wrapped(t, width, prefix) + "\n" + code for t in (gpl, agpl, apache, reworded) for width, prefix in ((40, "# "), (72, " * "), (100, "// "))],
        "/*\n" + wrapped(gpl, 60, " * ") + "\n */\n" + code, wrapped(epl, 60, "# ") + "\n" + code, unlicense, code, "", "license", "\n\nlicense\n\n",
        "# SPDX-License-Identifier: MIT OR Apache-2.0\n" + code, "// SPDX-License-Identifier: GPL-2.0-only WITH Classpath-exception-2.0",
        "Copyright (c) 2020 Someone. All rights reserved.\n" + FULL["MIT"].replace("Software", "Work"), "First paragraph.\n\n" + gpl + "\n\nlast license words",
        FULL["ISC"] + "\n" + FULL["MIT"], "prose about a license that says nothing " * 30,
    ]
    return list(enumerate(texts))


@pytest.fixture(scope="module")
def found(spark):
    df = keyed(spark.createDataFrame(files(), "doc_id bigint, text string"))
    scores = licenses.text_scores(df).join(df.select("doc_id", "k1", "k2"), ["k1", "k2"])
    return sorted((r.doc_id, r.line, r.license, r.score) for r in scores.collect())


def test_equals_brute_force(found):
    want = brute_force(files())
    assert [f[:3] for f in found] == [w[:3] for w in want]
    assert all(abs(f[3] - w[3]) < 2e-6 for f, w in zip(found, want))
    assert len({w[2] for w in want}) > 10


def test_what_is_told_apart(found):
    names = {}
    for doc, _, name, _ in found:
        names.setdefault(doc, set()).add(name)
    for i, name in enumerate(FULL):
        assert name in names[i]
    at = len(FULL)
    for i, name in enumerate(["GPL-3.0"] * 3 + ["AGPL-3.0"] * 3 + ["Apache-2.0"] * 3 + ["GPL-3.0"] * 3):
        assert name in names[at + i], (i, name)
