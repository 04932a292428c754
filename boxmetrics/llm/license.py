"""Licence scans: a trained paragraph classifier, in DataFrame operations only.

A paragraph is a block of lines up to a blank one, its lines joined, so a notice
wrapped at any width is one paragraph. A line is a second unit,
for a short notice within other text. A multinomial logistic
regression over word unigrams and bigrams (present or not) is trained on notices
made from the templates below, a bounded set, on the driver: names in phrases,
texts whole and in pieces, and each with the words of others about it. Scanning
uses built-in functions alone. Only words and pairs of words with weights move a
score: a text without a single word of these is unknown by the model itself, and
is passed over before it is cut into units; nothing else is. The accepting
probability is calibrated on the scanned paragraphs that hold less than half of any
wording or name: all but one in a thousand of them fall short of it. A unit whose best
class falls short of it is unknown; one that speaks of a licence all the same is
reported as unknown. A prediction is confirmed when a template of its family (its
text or, failing that, a name of it) is contained in the unit nearly whole.
"""

from __future__ import annotations

import math
import re
from collections import Counter

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import staged, table, texts

# Names by which licence families are called in notices.
NAMES = {
    "apache": ["apache license version 2.0", "apache license 2.0", "apache software license", "apache 2.0 license", "apache-2.0", "apache 2.0", "apache license"],
    "mit": ["mit license", "mit licence", "mit license mit", "mit open source license", "expat license"],
    "gpl": ["gnu general public license version 3", "gnu general public license version 2", "gnu gpl", "gpl version 3", "gpl-3.0-or-later", "gpl-2.0-only", "gplv2", "gplv3", "gpl v2", "gpl v3"],
    "lgpl": ["gnu lesser general public license", "gnu lesser general public license version 2.1", "lgpl version 3", "lgpl-2.1-or-later", "lgplv3", "lgpl v3"],
    "agpl": ["gnu affero general public license", "gnu affero general public license version 3", "agpl version 3", "agpl-3.0-only", "agplv3"],
    "bsd": ["bsd license", "bsd 3-clause license", "bsd 2-clause license", "new bsd license", "bsd-3-clause"],
    "mpl": ["mozilla public license", "mozilla public license version 2.0", "mpl 2.0", "mpl-2.0"],
    "cc": ["cc by 4.0", "cc by-sa 4.0", "cc by", "cc by-sa", "cc-by-sa 4.0", "cc by-nc 4.0", "cc by-nc-sa 4.0", "creative commons attribution 4.0 international license", "creative commons attribution-noncommercial 4.0", "cc0 1.0 universal"],
    "isc": ["isc license", "isc licence"],
    "boost": ["boost software license", "boost software license version 1.0", "bsl-1.0"],
    "zlib": ["zlib license", "zlib/libpng license"],
    "unlicense": ["the unlicense", "unlicense license"],
    "epl": ["eclipse public license", "eclipse public license 2.0", "epl-2.0"],
    "eupl": ["european union public licence", "eupl version 1.2", "eupl-1.2"],
    "artistic": ["artistic license 2.0", "perl artistic license", "artistic-2.0"],
}
# The phrases around the names, and full sentences of the families.
PHRASES = ["licensed under the {}", "licensed under {}", "released under the {}", "this work is licensed under the {}", "distributed under the terms of the {}", "this file is part of a project under the {}", "available under the {}", "spdx-license-identifier {}", "see the {} for details", "you may use this file under the {}", "{}", "under {}", "is {}", "under the {} terms", "code under a {}", "comes with the {}"]
# Texts are pieces of the licences' own wording, as projects carry them; the longest stand for the whole.
SENTENCES = {
    "apache": [
        "licensed under the apache license, version 2.0 (the \"license\"); you may not use this file except in compliance with the license. you may obtain a copy of the license at http://www.apache.org/licenses/license-2.0",
        "unless required by applicable law or agreed to in writing, software distributed under the license is distributed on an \"as is\" basis, without warranties or conditions of any kind, either express or implied. see the license for the specific language governing permissions and limitations under the license",
        "licensed to the apache software foundation (asf) under one or more contributor license agreements. see the notice file distributed with this work for additional information regarding copyright ownership",
    ],
    "mit": [
        "permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"software\"), to deal in the software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the software, and to permit persons to whom the software is furnished to do so, subject to the following conditions",
        "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software",
        "the software is provided \"as is\", without warranty of any kind, express or implied, including but not limited to the warranties of merchantability, fitness for a particular purpose and noninfringement. in no event shall the authors or copyright holders be liable for any claim, damages or other liability, whether in an action of contract, tort or otherwise, arising from, out of or in connection with the software or the use or other dealings in the software",
    ],
    "gpl": [
        "this program is free software: you can redistribute it and/or modify it under the terms of the gnu general public license as published by the free software foundation, either version 3 of the license, or (at your option) any later version",
        "this program is distributed in the hope that it will be useful, but without any warranty; without even the implied warranty of merchantability or fitness for a particular purpose. see the gnu general public license for more details. you should have received a copy of the gnu general public license along with this program",
    ],
    "lgpl": [
        "this library is free software; you can redistribute it and/or modify it under the terms of the gnu lesser general public license as published by the free software foundation; either version 2.1 of the license, or (at your option) any later version",
        "this library is distributed in the hope that it will be useful, but without any warranty; without even the implied warranty of merchantability or fitness for a particular purpose. see the gnu lesser general public license for more details. you should have received a copy of the gnu lesser general public license along with this library",
    ],
    "agpl": [
        "this program is free software: you can redistribute it and/or modify it under the terms of the gnu affero general public license as published by the free software foundation, either version 3 of the license, or (at your option) any later version. see the gnu affero general public license for more details. you should have received a copy of the gnu affero general public license along with this program",
    ],
    "bsd": [
        "redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution",
        "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission",
        "this software is provided by the copyright holders and contributors \"as is\" and any express or implied warranties, including, but not limited to, the implied warranties of merchantability and fitness for a particular purpose are disclaimed. in no event shall the copyright holder or contributors be liable for any direct, indirect, incidental, special, exemplary, or consequential damages (including, but not limited to, procurement of substitute goods or services; loss of use, data, or profits; or business interruption) however caused and on any theory of liability",
    ],
    "mpl": ["this source code form is subject to the terms of the mozilla public license, v. 2.0. if a copy of the mpl was not distributed with this file, you can obtain one at http://mozilla.org/mpl/2.0/"],
    "isc": ["permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies", "the software is provided \"as is\" and the author disclaims all warranties with regard to this software including all implied warranties of merchantability and fitness. in no event shall the author be liable for any special, direct, indirect, or consequential damages or any damages whatsoever resulting from loss of use, data or profits"],
    "boost": ["permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered by this license (the \"software\") to use, reproduce, display, distribute, execute, and transmit the software, and to prepare derivative works of the software, and to permit third-parties to whom the software is furnished to do so", "distributed under the boost software license, version 1.0. (see accompanying file license_1_0.txt or copy at http://www.boost.org/license_1_0.txt)"],
    "zlib": ["this software is provided 'as-is', without any express or implied warranty. in no event will the authors be held liable for any damages arising from the use of this software. permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions: the origin of this software must not be misrepresented; you must not claim that you wrote the original software"],
    "unlicense": ["this is free and unencumbered software released into the public domain. anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means"],
    "epl": ["this program and the accompanying materials are made available under the terms of the eclipse public license 2.0 which is available at https://www.eclipse.org/legal/epl-2.0"],
    "eupl": ["licensed under the eupl, version 1.2 or as soon they will be approved by the european commission - subsequent versions of the eupl (the \"licence\"); you may not use this work except in compliance with the licence"],
    "artistic": ["everyone is permitted to copy and distribute verbatim copies of this license document, but changing it is not allowed. this license establishes the terms under which a given free software package may be copied, modified, distributed, and/or redistributed. the intent is that the copyright holder maintains some artistic control over the development of that package"],
    "cc": ["this work is licensed under a creative commons attribution 4.0 international license. to view a copy of this license, visit http://creativecommons.org/licenses/by/4.0/"],
}
OTHERS = [
    "all rights reserved", "copyright the authors", "copyright notice", "terms of use and privacy policy", "see the terms of service for details", "a driver must hold a license", "the license plate of the car", "licensed under a proprietary agreement", "released under the influence", "this work is dedicated to my family",
    "distributed under the table", "available under the counter", "the general public is invited", "free software foundation", "version 2.0", "version 3", "the public license office opens at nine", "licensed practical nurse", "released under a new title", "the university of california", "creative writing at the commons", "a copy of the letter", "the film was released in may", "permission denied",
    "licensed under our own terms", "you may use this file", "this file is part of a project", "mozilla foundation", "gnu project", "apache helicopter", "mit professors", "the affero company", "sold under license", "license fee for public use",
    "the software is sold with a warranty of two years", "without warranty the phone costs less", "copies of the book are free of charge", "the above notice was posted at the door", "permission to enter is granted to any person with a ticket", "provided as is on a best effort basis", "see the license for details", "the following conditions are met by all members", "the names of its contributors are listed below", "redistribution of income and wealth", "in no event shall the match be played at night",
]
UNKNOWN = "unknown"
LEAST = 0.5  # accepting probability at least: a family must be likelier than all else together
QUIET, MARGIN = 0.999, 0.02  # part of the paragraphs without a notice that is not to be accepted, and how far from it
HINT = 0.5  # of a wording's or name's grams, from which a paragraph may be a notice and is not calibrated on
CONFIRMED = 0.8  # of a template's grams
TOKEN = r"[a-z0-9][a-z0-9.+-]*[a-z0-9+]|[a-z0-9]"


def words_of(text: str) -> list[str]:
    return re.findall(TOKEN, text.lower())


#: Words that tell nothing alone; a gram needs another word.
STOP = """the or be all not this under is of in to and a an any for by on with may you are was that at it as if its can new name names above use used see my our own
but other one from out more will do which must into even however either neither nor along following given also when how here there they them their his her he she we us i your me who what where than then
so such no yes only just each every some many most much both few those these over after before between about against during through up down off again once same too very could should would has have had having
being been were am doing does did because until while whether without within upon per via shall etc two three first last list data means kind law forms part""".split()


def grams_of(words: list[str]) -> set[str]:
    pairs = {f"{a} {b}" for a, b in zip(words, words[1:], strict=False) if a not in STOP or b not in STOP}
    return {w for w in words if w not in STOP} | pairs


PIECE = 14  # words of a piece of a text


def pieces_of(text: str) -> list[str]:
    """A text whole and in pieces of PIECE words, half of one shared with the next."""
    words = text.split()
    return [text, *[" ".join(words[i : i + PIECE]) for i in range(0, max(1, len(words) - PIECE // 2), PIECE // 2) if len(words) > PIECE]]


def training_notices() -> list[tuple[str, str]]:
    """(notice, family) from the templates; the same each time."""
    rows = [(p.format(n), f) for f, names in NAMES.items() for n in names for p in PHRASES]
    rows += [(s, f) for f, sentences in SENTENCES.items() for s in [" ".join(sentences), *sentences] for _ in range(3)]
    # what two families' texts share tells neither: such pieces are for no family
    pieces = [(p, f) for f, sentences in SENTENCES.items() for s in sentences for p in pieces_of(s)[1:]]
    grams = {f: {g for s in sentences for g in grams_of(words_of(s))} for f, sentences in SENTENCES.items()}
    for p, f in pieces:
        own = grams_of(words_of(p))
        shared = max(len(own & grams[g]) for g in grams if g != f) / max(1, len(own))
        rows.append((p, UNKNOWN if shared > 0.7 else f))
    return rows + [(s, UNKNOWN) for s in OTHERS for _ in range(3)] + [("", UNKNOWN)] * 20


class Model:
    def __init__(self, classes: list[str], weights: dict[str, list[float]], bias: list[float], accept: float):
        self.classes, self.weights, self.bias, self.accept = classes, weights, bias, accept

    def probabilities(self, text: str) -> list[float]:
        z = list(self.bias)
        for g in grams_of(words_of(text)):
            for k, w in enumerate(self.weights.get(g, ())):
                z[k] += w
        top = max(z)
        e = [math.exp(v - top) for v in z]
        return [v / sum(e) for v in e]


def train(rounds: int = 300, rate: float = 2.0, ridge: float = 0.002) -> Model:
    """Batch gradient descent on the notices; the accepting probability is the least one until it is calibrated."""
    import numpy as np

    rows = training_notices()
    classes = [*NAMES, UNKNOWN]
    grams = [grams_of(words_of(t)) for t, _ in rows]
    seen = Counter(g for gs in grams for g in gs)
    index = {g: i for i, g in enumerate(sorted(g for g, n in seen.items() if n > 1))}
    x = np.zeros((len(rows), len(index) + 1))
    for r, gs in enumerate(grams):
        x[r, [index[g] for g in gs if g in index]] = 1
        x[r, -1] = 1
    y = np.array([[c == f for c in classes] for _, f in rows], float)
    w = np.zeros((x.shape[1], y.shape[1]))
    for _ in range(rounds):
        z = x @ w
        p = np.exp(z - z.max(axis=1, keepdims=True))
        p /= p.sum(axis=1, keepdims=True)
        w -= rate * (x.T @ (p - y) / len(x) * 4 + ridge * w) / 4
    return Model(classes, {g: w[i].tolist() for g, i in index.items()}, w[-1].tolist(), LEAST)


def _words(c: Column) -> Column:
    return F.regexp_extract_all(F.lower(c), F.lit(TOKEN), F.lit(0))


def _listed(values) -> Column:
    return F.split(F.lit("\n".join(sorted(values))), "\n")


def _known_grams(words: Column, model: Model) -> Column:
    """The words and pairs of neighbours that have weights, each once."""
    pairs = F.zip_with(F.slice(words, 1, F.greatest(F.size(words) - 1, F.lit(0))), F.slice(words, 2, F.greatest(F.size(words) - 1, F.lit(0))), lambda a, b: F.concat(a, F.lit(" "), b))
    return F.array_intersect(F.concat(words, pairs), _listed(model.weights))


def has_weight(text: Column, model: Model) -> Column:
    """Whether any word of a text is in a gram with weights. Words that tell nothing alone are in none by themselves."""
    words = {w for g in model.weights for w in g.split()} - set(STOP)
    return F.arrays_overlap(_words(text), _listed(words))


# What speaks of a licence though no family is told.
SPEAKS = r"(?i)licen[cs]ed under|released under|distributed under the terms|spdx-license-identifier|permission (?:is hereby granted|to use, copy)|redistribution and use|all rights reserved"


def units(text: Column) -> Column:
    """The text's units as structs (paragraph, line, text): blocks of lines with line -1, and the lines of blocks of several.

    ``paragraph`` counts blocks and ``line`` lines within one, from 0. Signs of
    comments at the beginnings of lines are taken off.
    """
    bare = F.regexp_replace(text, r"(?m)^[ \t]*(?:/\*+|\*+/|\*+|//+|#+|;+|--+|%+)?[ \t]*(?:\*/)?[ \t]*\r?$|(?m)^[ \t]*(?:/\*+|\*+|//+|#+|;+|--+|%+)[ \t]*", "")
    bare = F.regexp_replace(bare, r"\A(?:[ \t\r]*\n)+|(?:\n[ \t\r]*)+\z", "")
    blocks = F.filter(F.transform(F.split(bare, r"\n(?:[ \t\r]*\n)+"), lambda b, i: F.struct(i.alias("paragraph"), F.lit(-1).alias("line"), b.alias("text"))), lambda u: F.trim(u["text"]) != "")

    def lines(u: Column) -> Column:
        parts = F.split(u["text"], r"\n")
        each = F.transform(parts, lambda x, i: F.struct(u["paragraph"].alias("paragraph"), i.alias("line"), x.alias("text")))
        return F.when(F.size(parts) > 1, F.concat(F.array(u), each)).otherwise(F.array(u))

    return F.flatten(F.transform(blocks, lines))


def scan(docs: DataFrame, model: Model | None = None, accept: float | None = None) -> DataFrame:
    """Licence notices as rows (doc_id, paragraph, line, family, probability, confirmed, containment).

    ``line`` is null where the paragraph as a whole is the notice; its lines are
    then not told apart. A unit that speaks of a licence of no known family is of
    the family "unknown"; any other unknown unit gives no row. The accepting
    probability is calibrated on the texts themselves, or ``accept``. Null and empty
    texts have none; a null doc_id keeps its rows and repeated rows are answered
    each; an empty table gives no rows.
    """
    spark = docs.sparkSession
    model = model or train()
    looked_at = lambda t: has_weight(t, model) | t.rlike(SPEAKS)
    hot = F.filter(units(F.col("text")), lambda u: looked_at(u["text"]))
    found = texts(docs).where(looked_at(F.col("text"))).withColumn("row", F.monotonically_increasing_id()).select("row", "doc_id", F.explode(hot).alias("p"))
    found = found.select("row", "doc_id", "p.paragraph", "p.line", F.col("p.text").rlike(SPEAKS).alias("speaks"), _known_grams(_words(F.col("p.text")), model).alias("grams"))
    k = len(model.classes)
    # one row a template gram: a size fixed by the templates
    weights = spark.createDataFrame([(g, w) for g, w in sorted(model.weights.items())], "gram string, w array<double>")
    keys = ["row", "doc_id", "paragraph", "line", "speaks"]
    sums = found.select(*keys, F.explode_outer("grams").alias("gram")).join(F.broadcast(weights), "gram", "left")
    sums = sums.groupBy(*keys).agg(*[F.coalesce(F.sum(F.col("w")[i]), F.lit(0.0)).alias(f"z{i}") for i in range(k)], F.collect_set(F.when(F.col("w").isNotNull(), F.col("gram"))).alias("known"))
    z = F.array(*[F.col(f"z{i}") + F.lit(b) for i, b in enumerate(model.bias)])
    best = F.array_max(z)
    e = F.aggregate(z, F.lit(0.0), lambda acc, v: acc + F.exp(v - F.array_max(z)))
    scored = sums.withColumn("p", 1 / e).withColumn("family", F.element_at(F.array(*map(F.lit, model.classes)), F.array_position(z, best).cast("int")))
    known = lambda texts_: [sorted(grams_of(words_of(s)) & set(model.weights)) for s in texts_]
    templates = spark.createDataFrame([(f, known(NAMES[f]), known(SENTENCES.get(f, []))) for f in NAMES], "family string, names array<array<string>>, wordings array<array<string>>")
    share = lambda c: F.coalesce(F.array_max(F.transform(c, lambda t: F.size(F.array_intersect(t, "known")) / F.size(t))), F.lit(0.0))
    scored = scored.join(F.broadcast(templates), "family", "left").withColumn("wording", share("wordings")).withColumn("containment", F.greatest("wording", share("names")))
    scored = staged(scored.where((F.col("family") != UNKNOWN) | F.col("speaks")).drop("names", "wordings", "known", *[f"z{i}" for i in range(k)]), "licence-units")
    least = model.accept if accept is None else accept
    if accept is None:
        quiet = scored.where((F.col("family") != UNKNOWN) & ~F.col("speaks") & (F.col("containment") < HINT))
        least = max(least, min(0.95, (quiet.agg(F.percentile_approx("p", QUIET, 100_000)).first()[0] or 0.0) + MARGIN))
    accepted = (F.col("family") != UNKNOWN) & (F.col("p") >= least)
    none = F.lit(0.0)
    scored = scored.withColumn("accepted", accepted).where("accepted OR speaks").withColumns({"family": F.when(F.col("accepted"), F.col("family")).otherwise(UNKNOWN), "wording": F.when(F.col("accepted"), F.col("wording")).otherwise(none), "containment": F.when(F.col("accepted"), F.col("containment")).otherwise(none)})
    block = Window.partitionBy("row", "paragraph")
    whole = F.coalesce(F.max(F.when(F.col("line") < 0, F.col("accepted") & (F.col("wording") >= CONFIRMED))).over(block), F.lit(False))
    some = F.max(F.when(F.col("line") >= 0, F.col("accepted"))).over(block)
    # a block is the notice if it has a licence's own wording; else the lines accepted are, and where none is the block again
    scored = scored.withColumn("whole", whole).withColumn("some", F.coalesce(some, F.lit(False))).where("CASE WHEN whole THEN line < 0 WHEN some THEN line >= 0 AND accepted ELSE line < 0 END")
    out = scored
    line = F.when(F.col("line") >= 0, F.col("line"))
    return out.select("doc_id", "paragraph", line.alias("line"), "family", F.col("p").alias("probability"), (F.col("containment") >= CONFIRMED).alias("confirmed"), "containment")


def op9_license_scan(spark, sf_dir: str) -> DataFrame:
    return scan(table(spark, sf_dir, "documents"))
