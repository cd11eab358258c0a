"""Operator 10, licence scans: Dice coefficient over word bigrams, native DataFrame code.

A unit is a line of a text, or the whole text. It is normalised (lower case, every run of other
characters than letters and digits one space) and becomes the set of its word bigrams. Dice of
a unit and a template is 2 * common / (size + size). A score of at least ``min_dice`` needs
the smaller set to hold ``min_dice / (2 - min_dice)`` of the larger, so a template is compared
only with units whose set size lies in its bounds; a unit whose word count is beyond all bounds
is never even split into bigrams.

With ``embedded`` a third kind of unit is scored: runs of words anywhere in the text, across line
ends or inside a line, of at most as many bigrams as the template's upper bound, against TEMPLATES
and PASSAGES. A run that reaches ``min_dice`` holds the lower bound of a template's bigrams, so it
holds one of a few of its words (KEYWORDS, picked to cover all the bigrams that may not be missing
together): texts without any of them, and then templates of which the text holds too few bigrams,
are passed over without loss. Trimming a run to its first and last bigram of the template never
lowers Dice, so runs start at such a bigram with enough others within reach; from each start one
fold over the next bigrams keeps the counts of distinct and of common ones. The work is linear in
the text. "All rights reserved" then counts only where nothing else is found, because it stands in
the copyright lines of other licences. ``n_matches`` counts whole lines in either mode.

Defined results: NULL or blank text has no units and matches nothing; ties go to the template
that comes first in TEMPLATES; a unit of one word has no bigram and matches nothing;
repeated rows each get a row; extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import json
import math
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from agrolens.llm.common import bind

MIN_DICE = 0.8
# Licence notices in their usual wording.
TEMPLATES = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("BSD-3-Clause", "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related rights to this work."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
            "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation "
            "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and "
            "to permit persons to whom the Software is furnished to do so, subject to the following conditions:"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("all-rights-reserved", "All rights reserved."),
]
_GNU = ("This program is free software: you can redistribute it and/or modify it under the terms of the GNU {0} as published by "
        "the Free Software Foundation, either version {1} of the License, or (at your option) any later version. This program is "
        "distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of "
        "MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU {0} for more details.")
_REDISTRIBUTE = ("Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
                 "following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list "
                 "of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright "
                 "notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided "
                 "with the distribution. ")
_NO_ENDORSEMENT = ("3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote "
                   "products derived from this software without specific prior written permission. ")
_AS_IS = ("THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, "
          "INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED.")
_GNU_KINDS = [("GPL", "General Public License", ["2", "3"]), ("LGPL", "Lesser General Public License", ["2.1", "3"]),
              ("AGPL", "Affero General Public License", ["3"])]
_CC_KINDS = {"BY": "Attribution", "BY-SA": "Attribution-ShareAlike", "BY-ND": "Attribution-NoDerivatives",
             "BY-NC": "Attribution-NonCommercial", "BY-NC-SA": "Attribution-NonCommercial-ShareAlike",
             "BY-NC-ND": "Attribution-NonCommercial-NoDerivatives"}
# Titles and passages of full texts and standard headers, looked for as runs only. Near
# wordings of other licences are listed under their own names, so that the closest one wins.
PASSAGES = [
    ("Apache-1.1", "Licensed under the Apache License, Version 1.1."),
    ("Apache-2.0", "Apache License Version 2.0, January 2004 http://www.apache.org/licenses/"),
    ("BSD-2-Clause", _REDISTRIBUTE + _AS_IS),
    ("BSD-3-Clause", _REDISTRIBUTE + _NO_ENDORSEMENT + _AS_IS),
    ("BSD-3-Clause", _NO_ENDORSEMENT),
    ("CC0-1.0", "Creative Commons Legal Code CC0 1.0 Universal"),
    *[(f"CC-{k}-4.0", f"Licensed under CC {k} 4.0.") for k in _CC_KINDS],
    *[(f"CC-{k}-4.0", f"This work is licensed under a Creative Commons {v} 4.0 International License.") for k, v in _CC_KINDS.items()],
    *[(f"CC-{k}-4.0", f"Creative Commons {v} 4.0 International Public License") for k, v in _CC_KINDS.items()],
    *[(f"{k}-{v if '.' in v else v + '.0'}", _GNU.format(name, v)) for k, name, vs in _GNU_KINDS for v in vs],
    *[(f"{k}-{v if '.' in v else v + '.0'}", f"This work is licensed under the GNU {name}, version {v}.")
      for k, name, vs in _GNU_KINDS for v in vs],
    ("AGPL-3.0", "GNU AFFERO GENERAL PUBLIC LICENSE Version 3, 19 November 2007"),
    ("GPL-2.0", "GNU GENERAL PUBLIC LICENSE Version 2, June 1991"),
    ("GPL-3.0", "GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007"),
    ("LGPL-2.1", "GNU LESSER GENERAL PUBLIC LICENSE Version 2.1, February 1999"),
    ("LGPL-3.0", "GNU LESSER GENERAL PUBLIC LICENSE Version 3, 29 June 2007"),
    ("MPL-2.0", "Mozilla Public License Version 2.0"),
]
GENERIC = "all-rights-reserved"
COMMON = set("a and any are as at be by for from in is it not of or other that the this to under with you".split())


def template_bigrams(text: str) -> list[str]:
    """Distinct word bigrams of a normalised template, sorted."""
    words = re.sub(r"[^a-z0-9]+", " ", text.lower()).split()
    return sorted({f"{a} {b}" for a, b in zip(words, words[1:])})


def _bounds(size: int, min_dice: float) -> tuple[int, int]:
    """Set sizes that can still reach min_dice against a set of ``size``."""
    ratio = min_dice / (2 - min_dice)
    return math.ceil(size * ratio - 1e-9), math.floor(size / ratio + 1e-9)


def _normal(unit: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(unit), r"[^\p{L}\p{N}]+", " "))


def _bigrams(words: Column) -> Column:
    n = F.size(words) - 1
    return F.zip_with(F.slice(words, 1, n), F.slice(words, 2, n), lambda a, b: F.concat(a, F.lit(" "), b))


def _best(words: Column, min_dice: float) -> Column:
    """struct(score, rank) of the best template of a unit's words, or NULL."""
    sets = [template_bigrams(t) for _, t in TEMPLATES]
    low = min(_bounds(len(s), min_dice)[0] for s in sets)
    high = max(_bounds(len(s), min_dice)[1] for s in sets)

    def score(bigrams):
        found = []
        for k, s in enumerate(sets):
            a, b = _bounds(len(s), min_dice)
            dice = 2.0 * F.size(F.array_intersect(bigrams, F.array(*map(F.lit, s)))) / (F.size(bigrams) + len(s))
            found.append(F.when(F.size(bigrams).between(a, b) & (dice >= min_dice),
                                F.struct(dice.alias("score"), F.lit(-k).alias("rank"))))
        return F.array_max(F.array(*found))

    # n distinct bigrams hold n + 1 distinct words at most
    return F.when((F.size(words) > low) & (F.size(F.array_distinct(words)) <= high + 1),
                  bind(F.array_distinct(_bigrams(words)), score))


def keywords(bigrams: list[str], min_dice: float) -> list[str]:
    """Words of a template, telling ones first, one of which every run that reaches min_dice holds."""
    spare = len(bigrams) - _bounds(len(bigrams), min_dice)[0]  # so many bigrams may be missing
    out, covered = [], set()
    for word in sorted({w for g in bigrams for w in g.split()}, key=lambda w: (w in COMMON, -len(w), w)):
        if len(covered) > spare:
            break
        out.append(word)
        covered |= {g for g in bigrams if word in g.split()}
    return out


def _run(bigrams: Column, t: Column) -> Column:
    """Best Dice of template ``t`` and any run of ``bigrams`` (NULL: no run holds enough of it)."""
    def runs(cells):
        at = F.filter(F.transform(cells, lambda x, i: F.when(x["own"], i)), lambda i: i.isNotNull())

        def fold(start):
            def step(acc, x):
                new = x["before"] < start
                n = acc["n"] + F.when(new, 1).otherwise(0)
                common = acc["common"] + F.when(new & x["own"], 1).otherwise(0)
                return F.struct(n.alias("n"), common.alias("common"),
                                F.greatest(acc["dice"], 2.0 * common / (n + F.size(t["own"]))).alias("dice"))
            zero = F.struct(F.lit(0).alias("n"), F.lit(0).alias("common"), F.lit(0.0).alias("dice"))
            return F.aggregate(F.slice(cells, start + 1, t["most"]), zero, step, lambda acc: acc["dice"])

        def starts(p):
            near = F.filter(p, lambda v, k: F.coalesce(F.get(p, k + t["least"] - 1) - v < t["most"], F.lit(False)))
            return F.array_max(F.transform(near, fold))

        return bind(at, starts)

    def cells(order):
        """Per bigram: whether it is the template's, and its place before this one (-1: none)."""
        placed = F.transform(order, lambda s, k: F.struct(
            s["i"].alias("i"), F.when(F.get(order, k - 1)["g"] == s["g"], F.get(order, k - 1)["i"]).otherwise(F.lit(-1)).alias("before"),
            F.array_contains(t["own"], s["g"]).alias("own")))
        return bind(F.array_sort(placed), runs)

    return bind(F.array_sort(F.transform(bigrams, lambda g, i: F.struct(g.alias("g"), i.alias("i")))), cells)


def _embedded(words: Column, min_dice: float) -> Column:
    """Array of struct(score, rank) of the templates and passages that some run of the words reaches."""
    sets = [template_bigrams(t) for _, t in TEMPLATES + PASSAGES]
    keys = sorted({w for s in sets for w in keywords(s, min_dice)})
    known = sorted({g for s in sets for g in s})
    rows = [{"own": s, "least": _bounds(len(s), min_dice)[0], "most": _bounds(len(s), min_dice)[1], "rank": -k}
            for k, s in enumerate(sets)]
    # One literal table and one lambda: an expression for each template would take Spark a minute to analyse.
    templates = F.from_json(F.lit(json.dumps(rows)), "array<struct<own:array<string>,least:int,most:int,rank:int>>")

    def score(bigrams):
        def among(held):
            fit = F.filter(templates, lambda t: F.size(F.array_intersect(held, t["own"])) >= t["least"])
            found = F.transform(fit, lambda t: F.struct(_run(bigrams, t).alias("score"), t["rank"].alias("rank")))
            return F.filter(found, lambda x: x["score"] >= min_dice)
        return bind(F.array_intersect(bigrams, F.lit(known)), among)

    return F.when(F.arrays_overlap(words, F.lit(keys)), bind(_bigrams(words), score))


def licence_scan(docs: DataFrame, min_dice: float = MIN_DICE, embedded: bool = False) -> DataFrame:
    """doc_id, licence (best template of any unit, or NULL), score, n_matches (matching lines)."""
    text = F.coalesce("text", F.lit(""))

    def unit(t):
        return F.split(_normal(t), " ")

    best = F.transform(F.split(text, "\n"), lambda x: bind(unit(x), lambda w: _best(w, min_dice)))
    several = F.instr(text, "\n") > 0
    if embedded:
        both = bind(unit(text), lambda w: F.struct(F.when(several, _best(w, min_dice)).alias("whole"),
                                                   _embedded(w, min_dice).alias("runs")))
    else:
        both = F.struct(F.when(several, bind(unit(text), lambda w: _best(w, min_dice))).alias("whole"))
    found = docs.select("doc_id", F.filter(best, lambda x: x.isNotNull()).alias("lines"), both.alias("both"))
    whole = F.array("both.whole")
    if embedded:
        runs = F.coalesce("both.runs", F.array().cast("array<struct<score:double,rank:int>>"))
        generic = [-k for k, (n, _) in enumerate(TEMPLATES) if n == GENERIC]
        top = bind(F.concat("lines", whole, runs), lambda hits: F.coalesce(
            F.array_max(F.filter(hits, lambda x: ~x["rank"].isin(generic))), F.array_max(hits)))
    else:
        top = F.array_max(F.concat("lines", whole))
    names = F.array(*[F.lit(n) for n, _ in TEMPLATES + PASSAGES])
    return found.select("doc_id", top.alias("top"), F.size("lines").cast("long").alias("n_matches")).select(
        "doc_id", F.get(names, -F.col("top")["rank"]).alias("licence"),
        F.coalesce(F.col("top")["score"], F.lit(0.0)).alias("score"), "n_matches")
