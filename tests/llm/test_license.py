import random
import re
import textwrap

import pytest

from boxmetrics.llm import license as lic

from ..conftest import MEDIUM
from .cases import AWKWARD, docs


def blocks(text):
    """Blocks of lines up to blank ones, without signs of comments."""
    out = [[]]
    for line in text.split("\n"):
        line = re.sub(r"^[ \t]*(/\*+|\*+/|\*+|//+|#+|;+|--+|%+)?[ \t]*(\*/)?[ \t]*\r?$", "", line)
        line = re.sub(r"^[ \t]*(/\*+|\*+|//+|#+|;+|--+|%+)[ \t]*", "", line)
        if line.strip(" \t\r"):
            out[-1].append(line)
        elif out[-1]:
            out.append([])
    return [b for b in out if b]


def brute(rows, model, accept=lic.LEAST):
    """Every block and line of every text scored in Python."""
    out = []
    for i, t in rows:
        for n, lines in enumerate(blocks(t or "")):
            units = [(None, "\n".join(lines)), *(enumerate(lines) if len(lines) > 1 else ())]
            scored = {}
            for at, text in units:
                p = model.probabilities(text)
                k = max(range(len(p)), key=p.__getitem__)
                f = model.classes[k]
                ok = f != lic.UNKNOWN and p[k] >= accept
                known = lic.grams_of(lic.words_of(text)) & model.weights.keys()
                share = lambda ts, known=known: max((len(g & known) / len(g) for s in ts if (g := lic.grams_of(lic.words_of(s)) & model.weights.keys())), default=0)
                wording = share(lic.SENTENCES.get(f, [])) if ok else 0
                if ok or re.search(lic.SPEAKS, text):
                    scored[at] = (ok, f if ok else lic.UNKNOWN, p[k], wording, max(wording, share(lic.NAMES[f]) if ok else 0))
            whole = scored.get(None)
            lines_ok = {at: s for at, s in scored.items() if at is not None and s[0]}
            kept = {None: whole} if whole and whole[0] and whole[3] >= 0.8 else lines_ok or ({None: whole} if whole else {})
            out += [(i, n, at, f, round(p, 9), c >= 0.8) for at, (_, f, p, _, c) in kept.items()]
    return sorted(out, key=str)


def scanned(spark, rows, model=None, accept=lic.LEAST):
    return sorted(((r.doc_id, r.paragraph, r.line, r.family, round(r.probability, 9), r.confirmed) for r in lic.scan(docs(spark, rows), model, accept).collect()), key=str)


def test_scan_equals_brute_force(spark):
    model = lic.train()
    rng = random.Random(1)
    vocabulary = sorted({w for g in model.weights for w in g.split()} | set(lic.STOP))
    rows = [(i, "\n".join(rng.choice(["", "# ", " * "]) + " ".join(rng.choices(vocabulary, k=rng.randint(0, 14))) for _ in range(6))) for i in range(150)]
    rows += [(1000 + n, t) for n, (t, _) in enumerate(lic.training_notices()[::7])]
    got, want = scanned(spark, rows, model), brute(rows, model)
    assert got == want and len(want) > 60


@pytest.mark.parametrize("width", [60, 72, 79])
def test_wrapped_texts_are_found_whole(spark, width):
    rows, want = [], []
    for n, (family, sentences) in enumerate(lic.SENTENCES.items()):
        body = "\n * ".join(textwrap.wrap(" ".join(sentences).capitalize() + ".", width))
        rows.append((n, f"/*\n * Copyright 2020 Somebody\n *\n * {body}\n */\n\nint main() {{\n return 0; }}"))
        want.append((n, 1, None, family, True))
    got = [(i, p, at, f, c) for i, p, at, f, _, c in scanned(spark, rows)]
    assert sorted(got) == want


def test_query_finds_the_notices_and_nothing_else(spark):
    rows = lic.op9_license_scan(spark, MEDIUM).collect()
    got = {(r.doc_id, r.paragraph, r.line): r for r in rows}
    assert len(got) == len(rows)
    signs = {"Apache License": "apache", "MIT License": "mit", "GNU General Public License": "gpl", "CC BY": "cc"}
    want = {}
    for r in spark.read.parquet(f"{MEDIUM}/documents.parquet").collect():
        for n, lines in enumerate(blocks(r.text or "")):
            for at, line in enumerate(lines):
                for sign, family in signs.items():
                    if sign in line:
                        want[r.doc_id, n, at if len(lines) > 1 else None] = family
    known = {k: r for k, r in got.items() if r.family != lic.UNKNOWN}
    assert {k: r.family for k, r in known.items()} == want and all(r.confirmed for r in known.values()) and want
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{MEDIUM}/documents.parquet").collect()}
    assert all(re.search(lic.SPEAKS, texts[i]) for (i, _, _), r in got.items() if r.family == lic.UNKNOWN)


def test_unknown_is_calibrated_on_what_is_scanned(spark):
    model = lic.train()
    assert all(max(model.probabilities(t)[:-1]) < lic.LEAST for t in lic.OTHERS)
    rows = [(i, t) for i, t in enumerate(lic.OTHERS * 5)] + [(999, "Released under the MIT License.")]
    got = lic.scan(docs(spark, rows), model).collect()
    assert {r.doc_id for r in got if r.family != lic.UNKNOWN} == {999}
    # a model that is sure of foreign paragraphs: they lift the accepting probability above themselves
    eager = lic.Model(model.classes, {**model.weights, "helicopter": [6.0 if c == "mit" else 0.0 for c in model.classes]}, model.bias, model.accept)
    flights = [(i, f"helicopter {i}") for i in range(50)]
    assert [r.family for r in lic.scan(docs(spark, flights), eager, accept=lic.LEAST).collect()] == ["mit"] * 50
    assert lic.scan(docs(spark, flights), eager).count() == 0


# Notices in words of their own, none of them a training text.
PARAPHRASED = {
    "gpl": ["Distributed under the GPLv2", "you can copy and change this tool under the gnu gpl v3", "This library comes under GNU General Public License v3 terms", "Code is GPL-3.0-or-later"],
    "mit": ["The whole project carries the MIT license", "Licence: MIT License (Expat)", "We chose the MIT license for this package"],
    "apache": ["Our code is open source under Apache License 2.0", "You get this under the Apache 2.0 license", "License of this repository: Apache-2.0"],
    "bsd": ["Everything here is under a 3-clause BSD license", "The parser is available with a new BSD license"],
    "cc": ["Images: CC BY-SA 4.0", "Texts are under Creative Commons Attribution 4.0", "Data released as CC0 1.0 Universal"],
    "mpl": ["Files are covered by the Mozilla Public License 2.0", "This module uses MPL 2.0"],
    "lgpl": ["The library is free under the GNU Lesser General Public License"],
    "agpl": ["The server falls under the GNU Affero General Public License v3"],
    "boost": ["Headers come with the Boost Software License"],
    "epl": ["The plug-in is under the Eclipse Public License 2.0"],
}


def test_paraphrased_notices_are_found(spark):
    rows = [(i, f, t) for i, (f, t) in enumerate((f, t) for f, ts in PARAPHRASED.items() for t in ts)]
    assert not {t.lower() for _, _, t in rows} & {t for t, _ in lic.training_notices()}
    got = {r.doc_id: r.family for r in lic.scan(docs(spark, [(i, t) for i, _, t in rows])).collect()}
    hit = [got.get(i) == f for i, f, _ in rows]
    assert sum(hit) >= 0.9 * len(hit), [(t, got.get(i)) for (i, f, t), ok in zip(rows, hit, strict=True) if not ok]


def test_a_licence_of_no_known_family_is_reported_as_unknown(spark):
    rows = [(1, "Released under the Quux Community Pact."), (2, "The film was released in May."), (3, "All rights reserved.\nby the owners")]
    assert [(i, f) for i, _, _, f, _, _ in scanned(spark, rows)] == [(1, "unknown"), (3, "unknown")]


def test_awkward_rows(spark):
    rows = [*AWKWARD, (60, "x\n\nReleased under the MIT License."), (60, "x\n\nReleased under the MIT License."), (None, "GNU GPL"), (61, "y\nLicensed under the MIT License.\nz")]
    got = sorted(((str(r.doc_id), r.paragraph, r.line, r.family) for r in lic.scan(docs(spark, rows)).collect()), key=str)
    assert got == [("60", 1, None, "mit"), ("60", 1, None, "mit"), ("61", 0, 1, "mit"), ("None", 0, None, "gpl")]
    assert lic.scan(docs(spark, [])).count() == 0
