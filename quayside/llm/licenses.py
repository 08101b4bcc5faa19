"""Licence texts inside documents, by MinHash bands over overlapping windows."""

from __future__ import annotations

import json
import re
from collections import Counter
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SHINGLE = 5
LEAST = 0.8  # containment of a template's shingles in a window
ROWS = 1  # MinHash values per band
BANDS = 12
SLACK = 4  # a window is a template's length plus this part of it, and moves by that part
TEMPLATES = 200  # more are refused: they travel inside the plan, as one constant

# Licence notices as published.
NOTICES = {
    "mit-notice": ("MIT", "Released under the MIT License."),
    "mit-licensed": ("MIT", "Licensed under the MIT License."),
    "apache-notice": ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    "gpl3-notice": ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    "gpl2-notice": ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    "bsd-notice": ("BSD", "Licensed under the BSD 3-Clause License."),
    "cc-by-notice": (
        "CC-BY-4.0",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    ),
    "cc-by-sa-notice": (
        "CC-BY-SA-4.0",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    ),
    "mpl-notice": (
        "MPL-2.0",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    ),
    "apache-header": (
        "Apache-2.0",
        "Unless required by applicable law or agreed to in writing, software distributed under the License is "
        'distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.',
    ),
    "mit-grant": (
        "MIT",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
        'associated documentation files (the "Software"), to deal in the Software without restriction, including '
        "without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell "
        "copies of the Software, and to permit persons to whom the Software is furnished to do so",
    ),
    "gpl-header": (
        "GPL",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
        "option) any later version.",
    ),
    "bsd-grant": (
        "BSD",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
        "that the following conditions are met",
    ),
    "isc-grant": (
        "ISC",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
        "hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    ),
}

# The Creative Commons licences by their elements: short form, name, and versions in use.
_COMMONS = {
    "BY": "Attribution",
    "BY-SA": "Attribution-ShareAlike",
    "BY-NC": "Attribution-NonCommercial",
    "BY-ND": "Attribution-NoDerivatives",
    "BY-NC-SA": "Attribution-NonCommercial-ShareAlike",
    "BY-NC-ND": "Attribution-NonCommercial-NoDerivatives",
}
for _short, _long in _COMMONS.items():
    _name = f"cc-{_short.lower()}"
    NOTICES[f"{_name}-short"] = (f"CC-{_short}-4.0", f"Licensed under CC {_short} 4.0.")
    NOTICES[f"{_name}-3-short"] = (f"CC-{_short}-3.0", f"Licensed under CC {_short} 3.0.")
    NOTICES.setdefault(
        f"{_name}-notice",
        (f"CC-{_short}-4.0", f"This work is licensed under a Creative Commons {_long} 4.0 International License."),
    )
    _long = _long.replace("NoDerivatives", "NoDerivs")
    NOTICES[f"{_name}-3-notice"] = (
        f"CC-{_short}-3.0",
        f"This work is licensed under a Creative Commons {_long} 3.0 Unported License.",
    )

# One-line notices "Licensed under ..." of other licences.
for _name, _code, _title in (
    ("gpl3", "GPL-3.0", "the GNU General Public License v3.0"),
    ("gpl2", "GPL-2.0", "the GNU General Public License v2.0"),
    ("lgpl3", "LGPL-3.0", "the GNU Lesser General Public License, version 3"),
    ("lgpl21", "LGPL-2.1", "the GNU Lesser General Public License, version 2.1"),
    ("agpl3", "AGPL-3.0", "the GNU Affero General Public License, version 3"),
    ("gfdl", "GFDL", "the GNU Free Documentation License"),
    ("epl2", "EPL-2.0", "the Eclipse Public License 2.0"),
    ("epl1", "EPL-1.0", "the Eclipse Public License 1.0"),
    ("mpl2", "MPL-2.0", "the Mozilla Public License 2.0"),
    ("cddl", "CDDL", "the Common Development and Distribution License"),
    ("eupl", "EUPL-1.2", "the European Union Public Licence"),
    ("bsd2", "BSD", "the BSD 2-Clause License"),
    ("isc", "ISC", "the ISC License"),
    ("zlib", "Zlib", "the zlib License"),
    ("boost", "BSL-1.0", "the Boost Software License, Version 1.0"),
    ("artistic", "Artistic-2.0", "the Artistic License 2.0"),
    ("busl", "BUSL-1.1", "the Business Source License 1.1"),
    ("sspl", "SSPL-1.0", "the Server Side Public License"),
    ("elastic", "Elastic-2.0", "the Elastic License 2.0"),
    ("odbl", "ODbL-1.0", "the Open Database License"),
    ("ofl", "OFL-1.1", "the SIL Open Font License, Version 1.1"),
    ("polyform", "PolyForm-Noncommercial-1.0.0", "the PolyForm Noncommercial License 1.0.0"),
):
    NOTICES[f"{_name}-licensed"] = (_code, f"Licensed under {_title}.")

_AS_IS = (
    'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO '
    "THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE "
    "AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF "
    "CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS "
    "IN THE SOFTWARE."
)
# Whole short licences, and long ones by the title and opening that every copy of them has.
NOTICES |= {
    "mit-text": (
        "MIT",
        f"{NOTICES['mit-grant'][1]}, subject to the following conditions: The above copyright notice and this "
        f"permission notice shall be included in all copies or substantial portions of the Software. {_AS_IS}",
    ),
    "bsd2-text": (
        "BSD",
        f"{NOTICES['bsd-grant'][1]}: 1. Redistributions of source code must retain the above copyright notice, this "
        "list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above "
        "copyright notice, this list of conditions and the following disclaimer in the documentation and/or other "
        "materials provided with the distribution.",
    ),
    "unlicense-text": (
        "Unlicense",
        "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, "
        "publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, "
        "for any purpose, commercial or non-commercial, and by any means.",
    ),
    "unlicense-notice": ("Unlicense", "This is free and unencumbered software released into the public domain."),
    "public-domain": ("Public-Domain", "This work has been released into the public domain."),
    "cc0-notice": (
        "CC0-1.0",
        "To the extent possible under law, the author has waived all copyright and related or neighboring rights to "
        "this work.",
    ),
    "cc0-licensed": ("CC0-1.0", "Licensed under CC0 1.0 Universal."),
    "cc0-title": ("CC0-1.0", "CC0 1.0 Universal (CC0 1.0) Public Domain Dedication"),
    "zlib-text": (
        "Zlib",
        "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be "
        "held liable for any damages arising from the use of this software. Permission is granted to anyone to use "
        "this software for any purpose, including commercial applications, and to alter it and redistribute it freely",
    ),
    "boost-text": (
        "BSL-1.0",
        "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software "
        'and accompanying documentation covered by this license (the "Software") to use, reproduce, display, '
        "distribute, execute, and transmit the Software",
    ),
    "boost-header": ("BSL-1.0", "Distributed under the Boost Software License, Version 1.0."),
    "0bsd-text": (
        "0BSD",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
        'hereby granted. THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS '
        "SOFTWARE",
    ),
    "apache-text": (
        "Apache-2.0",
        "Apache License Version 2.0, January 2004 http://www.apache.org/licenses/ TERMS AND CONDITIONS FOR USE, "
        "REPRODUCTION, AND DISTRIBUTION",
    ),
    "gpl3-text": ("GPL-3.0", "GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007"),
    "gpl2-text": ("GPL-2.0", "GNU GENERAL PUBLIC LICENSE Version 2, June 1991"),
    "lgpl3-text": ("LGPL-3.0", "GNU LESSER GENERAL PUBLIC LICENSE Version 3, 29 June 2007"),
    "lgpl21-text": ("LGPL-2.1", "GNU LESSER GENERAL PUBLIC LICENSE Version 2.1, February 1999"),
    "agpl3-text": ("AGPL-3.0", "GNU AFFERO GENERAL PUBLIC LICENSE Version 3, 19 November 2007"),
    "mpl2-text": ("MPL-2.0", "Mozilla Public License Version 2.0 1. Definitions"),
    "epl2-text": (
        "EPL-2.0",
        "THE ACCOMPANYING PROGRAM IS PROVIDED UNDER THE TERMS OF THIS ECLIPSE PUBLIC LICENSE",
    ),
    "lgpl-header": (
        "LGPL",
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser "
        "General Public License as published by the Free Software Foundation",
    ),
    "agpl-header": (
        "AGPL-3.0",
        "you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as "
        "published by the Free Software Foundation",
    ),
}


@dataclass(frozen=True)
class Template:
    name: str
    license: str
    words: tuple[str, ...]

    @property
    def shingles(self) -> list[str]:
        n = len(self.words) - SHINGLE + 1
        return list(dict.fromkeys(" ".join(self.words[i : i + SHINGLE]) for i in range(n)))

    @property
    def step(self) -> int:
        return max(1, len(self.words) // SLACK)

    @property
    def window(self) -> int:
        return len(self.words) + self.step

    def signs(self, least: float = LEAST) -> set[str]:
        """Words of which every window with enough of the template has at least one.

        Without the shingles that hold them, too few are left to reach the containment. Long words
        that cover many shingles are preferred.
        """
        shingles, chosen = self.shingles, set()
        need = len(shingles) * (1 - least)
        while True:
            bare = [s for s in shingles if chosen.isdisjoint(s.split())]
            if len(shingles) - len(bare) > need + 1e-9:
                return chosen
            counts = Counter(w for s in bare for w in set(s.split()))
            chosen.add(max(counts, key=lambda w: (min(len(w), 7), counts[w], w)))


def templates(notices: dict[str, tuple[str, str]] = NOTICES) -> list[Template]:
    """Templates as words; a notice shorter than a shingle is refused, as it could never be verified."""
    out = [Template(n, lic, tuple(re.sub("[^a-z0-9]+", " ", t.lower()).split())) for n, (lic, t) in notices.items()]
    if len(out) > TEMPLATES:
        raise ValueError(f"more than {TEMPLATES} templates")
    short = [t.name for t in out if len(t.words) < SHINGLE]
    if short:
        raise ValueError(f"templates of fewer than {SHINGLE} words: {short}")
    return out


def collision_chance(template: Template, rows: int = ROWS, bands: int = BANDS, least: float = LEAST) -> float:
    """Lower bound of the chance that a window with enough of the template shares a band with it."""
    t = len(template.shingles)
    shared = -(-t * least // 1)
    jaccard = shared / (template.window - SHINGLE + 1 + t - shared)
    return 1 - (1 - jaccard**rows) ** bands


def let(value: Column, use) -> Column:
    return F.transform(F.array(value), use)[0]


def _bands(hashes: Column, bands: int, rows: int) -> Column:
    """Band keys of a set of shingle hashes: least value per seeded hash, ``rows`` to a band."""
    least = lambda seed: F.array_min(F.transform(hashes, lambda h: F.xxhash64(h, F.lit(seed))))
    return F.array(*[F.xxhash64(F.lit(b), *[least(b * rows + r) for r in range(rows)]) for b in range(bands)])


def _template_bands(spark, found: list[Template], bands: int, rows: int) -> dict[str, list[int]]:
    held = spark.createDataFrame([(t.name, t.shingles) for t in found], "name string, s array<string>")
    hashed = F.transform("s", lambda x: F.xxhash64(x))
    return dict(held.select("name", let(hashed, lambda h: _bands(h, bands, rows))).collect())


def scan(docs: DataFrame, notices: dict[str, tuple[str, str]] = NOTICES, key: str = "doc_id", text: str = "text",
         bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """Templates in every document: ``doc_id, matches``, an array of ``name, word, containment``.

    Text is lower-cased and cut into words of letters and digits; shingles have five words. For
    each template, overlapping windows somewhat longer than it are signed by MinHash; those that
    share a band with it are candidates, and the exact share of its shingles in the window,
    compared as text, must be at least 0.8. ``word`` is the first word of the best window. Only
    windows with one of the template's signs are signed, which loses none (see
    :meth:`Template.signs`). A window is one template length plus a step long and moves by a
    step, so every passage of a template's length lies whole in one of them.

    One pass without a shuffle; templates, a bounded number, are a constant of the plan. NULL and empty
    texts have no matches. Repeated rows each get a row; other columns are not read.
    """
    found = templates(notices)
    keys = _template_bands(docs.sparkSession, found, bands, rows)
    signs = sorted({w for t in found for w in t.signs()})
    lowered = F.lower(F.coalesce(F.col(text), F.lit("")))
    plain = docs.select(F.col(key), lowered.alias("t"))
    words = F.array_remove(F.split("t", "[^a-z0-9]+"), "")
    has_sign = F.col("t").rlike("|".join(signs))
    split = plain.select(F.col(key), F.when(has_sign, words).otherwise(F.array().cast("array<string>")).alias("w"))
    at = F.filter(
        F.transform("w", lambda x, i: F.when(x.isin(signs), F.struct(i.alias("i"), x.alias("x")))), lambda x: x.isNotNull()
    )
    placed = split.select(key, "w", at.alias("at"))

    def best(t: Column) -> Column:
        mine = F.filter("at", lambda p: F.array_contains(t["signs"], p["x"]))
        step, window, texts, wanted = t["step"], t["window"], t["texts"], t["wanted"]
        back = F.ceil((window - 1) / step).cast("int")
        # Starts, as multiples of the step, of the windows over a sign.
        spots = F.array_distinct(
            F.flatten(
                F.transform(
                    mine,
                    lambda p: F.sequence(
                        F.greatest(F.lit(0), F.floor(p["i"] / step).cast("int") - back), F.floor(p["i"] / step).cast("int")
                    ),
                )
            )
        )

        def one(spot: Column) -> Column:
            start = spot * step
            last = F.least(start + window, F.size("w")) - SHINGLE
            shingles = F.when(
                last >= start,
                F.transform(F.sequence(start, last), lambda i: F.array_join(F.slice("w", i + 1, F.lit(SHINGLE)), " ")),
            )

            def judged(s: Column) -> Column:
                hit = let(
                    F.transform(s, lambda x: F.xxhash64(x)),
                    lambda h: F.exists(F.zip_with(_bands(h, bands, rows), wanted, lambda a, b: a == b), lambda e: e),
                )
                share = F.size(F.array_intersect(s, texts)) / F.size(texts)
                return F.when(F.coalesce(hit, F.lit(False)), F.struct(share.alias("share"), (-start).alias("at")))

            return let(shingles, judged)

        top = F.array_max(F.filter(F.transform(spots, one), lambda x: x["share"] >= LEAST))
        return let(
            top,
            lambda x: F.when(
                x.isNotNull(),
                F.struct(t["name"].alias("name"), (-x["at"]).alias("word"), x["share"].alias("containment")),
            ),
        )

    held = [
        {"name": t.name, "signs": sorted(t.signs()), "step": t.step, "window": t.window, "texts": t.shingles, "wanted": keys[t.name]}
        for t in found
    ]
    # One expression over a constant array, so the plan does not grow with the templates.
    kind = "name:string,signs:array<string>,step:int,window:int,texts:array<string>,wanted:array<bigint>"
    constant = F.from_json(F.lit(json.dumps(held)), f"array<struct<{kind}>>")
    seen = F.transform("at", lambda p: p["x"])
    likely = F.filter(constant, lambda t: F.arrays_overlap(t["signs"], seen))
    matches = F.array_compact(F.transform(likely, best))
    # Of templates that fit the same place, as versions of one licence do, the closest stay.
    near = F.lit(min(t.window for t in found))
    better = lambda m, o: (F.abs(o["word"] - m["word"]) <= near) & (o["containment"] > m["containment"])
    matches = let(matches, lambda all_: F.filter(all_, lambda m: ~F.exists(all_, lambda o: better(m, o))))
    none = F.array().cast("array<struct<name:string,word:int,containment:double>>")
    return placed.select(key, F.when(F.size("at") > 0, matches).otherwise(none).alias("matches"))


def report(docs: DataFrame, notices: dict[str, tuple[str, str]] = NOTICES, key: str = "doc_id", **options) -> DataFrame:
    """Digest of :func:`scan`: ``doc_id, n_matches, licenses, templates, containment``."""
    found = scan(docs, notices, key, **options)
    code = F.create_map(*[F.lit(v) for n, (lic, _) in notices.items() for v in (n, lic)])
    named = F.transform("matches", lambda m: code[m["name"]])
    return found.select(
        key,
        F.size("matches").cast("bigint").alias("n_matches"),
        F.array_join(F.array_sort(F.array_distinct(named)), ",").alias("licenses"),
        F.array_join(F.array_sort(F.transform("matches", lambda m: m["name"])), ",").alias("templates"),
        F.coalesce(F.array_max(F.transform("matches", lambda m: m["containment"])), F.lit(0.0)).alias("containment"),
    )
