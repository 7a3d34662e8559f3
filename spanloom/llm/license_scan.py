"""License scans by patience alignment of templates with whole texts."""

from __future__ import annotations

from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator, Mapping

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import id_back, id_or
from .decontaminate import FOLD, FOLDED, Seeds, by_text, word_pairs

#: The public texts and notices that are looked for.
TEMPLATES = {
    "MIT": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files "
        '(the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, '
        "publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, "
        "subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or "
        'substantial portions of the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING '
        "BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT."
    ),
    "ISC": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that "
        'the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS '
        "ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS."
    ),
    "BSD-3-Clause": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions "
        "are met: Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. "
        "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the "
        "documentation and/or other materials provided with the distribution. Neither the name of the copyright holder nor the names of its "
        "contributors may be used to endorse or promote products derived from this software without specific prior written permission."
    ),
    "Apache-2.0-header": (
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You '
        "may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in "
        'writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, '
        "either express or implied. See the License for the specific language governing permissions and limitations under the License."
    ),
    "GPL-3.0-header": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published "
        "by the Free Software Foundation, either version 3 of the License, or (at your option) any later version. This program is distributed in "
        "the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A "
        "PARTICULAR PURPOSE. See the GNU General Public License for more details."
    ),
    "GPL-2.0-header": (
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published "
        "by the Free Software Foundation; either version 2 of the License, or (at your option) any later version. This program is distributed in "
        "the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A "
        "PARTICULAR PURPOSE. See the GNU General Public License for more details."
    ),
    "LGPL-2.1-header": (
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as "
        "published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version. This library is "
        "distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or "
        "FITNESS FOR A PARTICULAR PURPOSE. See the GNU Lesser General Public License for more details."
    ),
    "LGPL-3.0-header": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as "
        "published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version. This program is "
        "distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or "
        "FITNESS FOR A PARTICULAR PURPOSE. See the GNU Lesser General Public License for more details."
    ),
    "AGPL-3.0-header": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as "
        "published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version. This program is "
        "distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or "
        "FITNESS FOR A PARTICULAR PURPOSE. See the GNU Affero General Public License for more details."
    ),
    "MPL-2.0-header": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this "
        "file, You can obtain one at http://mozilla.org/MPL/2.0/."
    ),
    "MIT-notice": "Released under the MIT License.",
    "BSD-notice": "Released under the BSD License.",
    "BSD-2-Clause-notice": "Released under the BSD 2-Clause License.",
    "BSD-3-Clause-notice": "Released under the BSD 3-Clause License.",
    "ISC-notice": "Released under the ISC License.",
    "Apache-2.0-notice": "Licensed under the Apache License, Version 2.0.",
    "GPL-2.0-notice": "This work is licensed under the GNU General Public License, version 2.",
    "GPL-3.0-notice": "This work is licensed under the GNU General Public License, version 3.",
    "LGPL-2.1-notice": "This work is licensed under the GNU Lesser General Public License, version 2.1.",
    "LGPL-3.0-notice": "This work is licensed under the GNU Lesser General Public License, version 3.",
    "AGPL-3.0-notice": "This work is licensed under the GNU Affero General Public License, version 3.",
    "MPL-2.0-notice": "Licensed under the Mozilla Public License, Version 2.0.",
    "CC-BY-4.0-notice": "Licensed under CC BY 4.0.",
    "CC-BY-SA-4.0-notice": "Licensed under CC BY-SA 4.0.",
    "CC-BY-ND-4.0-notice": "Licensed under CC BY-ND 4.0.",
    "CC-BY-NC-4.0-notice": "Licensed under CC BY-NC 4.0.",
    "CC-BY-NC-SA-4.0-notice": "Licensed under CC BY-NC-SA 4.0.",
    "CC-BY-NC-ND-4.0-notice": "Licensed under CC BY-NC-ND 4.0.",
    "All-rights-reserved": "All rights reserved.",
}
#: Phrases that a copy must hold, as they tell the license from its likes: words in a row (``/`` parts those allowed
#: at a place), between which ``FILLERS`` do not count.
_GNU = {"GPL": "gnu general public license", "LGPL": "gnu lesser general public license", "AGPL": "gnu affero general public license"}
DISTINCT = {
    "GPL-2.0-header": (_GNU["GPL"], "version 2 of"),
    "GPL-3.0-header": (_GNU["GPL"], "version 3 of"),
    "LGPL-2.1-header": (_GNU["LGPL"], "version 2 1 of"),
    "LGPL-3.0-header": (_GNU["LGPL"], "version 3 of"),
    "AGPL-3.0-header": (_GNU["AGPL"], "version 3 of"),
    "MPL-2.0-header": ("mozilla public license 2/v2 0",),
    "MIT-notice": ("mit license/licence",),
    "BSD-notice": ("bsd license/licence",),
    "BSD-2-Clause-notice": ("bsd 2 clause",),
    "BSD-3-Clause-notice": ("bsd 3 clause",),
    "ISC-notice": ("isc license/licence",),
    "Apache-2.0-notice": ("apache license/licence 2/v2 0",),
    "GPL-2.0-notice": (_GNU["GPL"] + " 2/v2",),
    "GPL-3.0-notice": (_GNU["GPL"] + " 3/v3",),
    "LGPL-2.1-notice": (_GNU["LGPL"] + " 2/v2 1",),
    "LGPL-3.0-notice": (_GNU["LGPL"] + " 3/v3",),
    "AGPL-3.0-notice": (_GNU["AGPL"] + " 3/v3",),
    "MPL-2.0-notice": ("mozilla public license 2/v2 0",),
} | {f"CC-{k}-4.0-notice": (f"cc {k.replace('-', ' ').lower()} 4 0",) for k in ("BY", "BY-SA", "BY-ND", "BY-NC", "BY-NC-SA", "BY-NC-ND")}
FILLERS = ("version", "v", "the")
#: Words of a template up to which it is aligned at every shift.
SHORT = 32


def _holds(span: list[int], phrases: list[list[frozenset[int]]], fillers: frozenset[int]) -> bool:
    """Whether each phrase (the words allowed at each place) stands in the span, fillers apart."""
    for phrase in phrases:
        own = [w for w in span if w not in fillers or any(w in p for p in phrase)]
        if not any(all(w in p for w, p in zip(own[i:], phrase)) for i in range(len(own) - len(phrase) + 1)):
            return False
    return True


def longest_increasing(values: list[int]) -> list[int]:
    """Indices of a longest strictly increasing subsequence (patience piles with links back)."""
    tops: list[int] = []
    at: list[int] = []
    back: list[int] = []
    for i, v in enumerate(values):
        k = bisect_left(tops, v)
        back.append(at[k - 1] if k else -1)
        if k == len(tops):
            tops.append(v)
            at.append(i)
        else:
            tops[k], at[k] = v, i
    out, i = [], at[-1] if at else -1
    while i >= 0:
        out.append(i)
        i = back[i]
    return out[::-1]


def patience(a: list[int], b: list[int]) -> list[tuple[int, int]]:
    """Matched positions (i in a, j in b), both increasing.

    Anchors are the values that are unique in both; the longest increasing
    subsequence of them is kept and the gaps between are aligned the same way.
    A gap without anchors matches its equal head and tail.
    """
    out: list[tuple[int, int]] = []
    todo = [(0, len(a), 0, len(b))]
    while todo:
        i, i_end, j, j_end = todo.pop()
        while i < i_end and j < j_end and a[i] == b[j]:
            out.append((i, j))
            i, j = i + 1, j + 1
        while i < i_end and j < j_end and a[i_end - 1] == b[j_end - 1]:
            i_end, j_end = i_end - 1, j_end - 1
            out.append((i_end, j_end))
        if i >= i_end or j >= j_end:
            continue
        in_a, in_b = Counter(a[i:i_end]), Counter(b[j:j_end])
        place = {v: k for k, v in enumerate(b[j:j_end], j) if in_b[v] == 1 and in_a[v] == 1}
        pairs = [(k, place[v]) for k, v in enumerate(a[i:i_end], i) if v in place]
        anchors = [pairs[k] for k in longest_increasing([y for _, y in pairs])]
        if not anchors:
            continue
        x, y = i, j
        for p, q in anchors:
            out.append((p, q))
            todo.append((x, p, y, q))
            x, y = p + 1, q + 1
        todo.append((x, i_end, y, j_end))
    return sorted(out)


def _regions(starts: np.ndarray, length: int) -> list[tuple[int, int]]:
    """Spans of a text that could each hold copies of a template, from where its seeds say they start."""
    slack = _slack(length)
    cuts = np.flatnonzero(np.diff(starts) > slack) + 1
    return [(int(g[0]) - slack, int(g[-1]) + length + slack) for g in np.split(starts, cuts)]


def _copies(words: np.ndarray, wanted: list[int], starts: np.ndarray, least: float) -> list[tuple[int, int, int]]:
    """(matched words, start, end) of each copy of a template, from where its seeds say copies start (ascending).

    Each region is aligned as a whole and at each start. Short templates, and
    copies that follow each other closely, repeat their words and have few
    anchors, so up to SHORT words every shift is aligned too, unless a copy is
    whole already. Of all that is found, spans that do not overlap are kept, the
    best first.
    """
    length, slack, found = len(wanted), _slack(len(wanted)), set()
    need = -int(-(least * length - 1e-9) // 1)
    known = set(wanted)

    def align(x: int, y: int) -> int:
        x = max(int(x), 0)
        matched = patience(words[x:y].tolist(), wanted)
        if len(matched) >= need:
            found.add((len(matched), x + matched[0][0], x + matched[-1][0] + 1))
        return len(matched)

    for a, z in _regions(starts, length):
        if len(known.intersection(words[max(a, 0) : z].tolist())) < need - (length - len(known)):
            continue  # too few of its words are there at all
        inside = np.unique(starts[(starts >= a + slack) & (starts <= z - length - slack)])
        best = align(a, z)
        for s in inside.tolist():
            best = max(best, align(s, s + length), align(s - slack, s + length + slack))
        if length <= SHORT and (best < length or len(inside) > 1):
            for s in np.unique(inside[:, None] + np.arange(-slack, slack + 1)).tolist():
                align(s, s + length)
                align(s - slack, s + length + slack)
    out: list[tuple[int, int, int]] = []
    ends: list[tuple[int, int]] = []
    for n, x, y in sorted(found, key=lambda f: (-f[0], f[2] - f[1], f[1])):
        # Spans kept so far do not overlap, so only the two beside a new one can.
        at = bisect_left(ends, (x, y))
        if (at == 0 or ends[at - 1][1] <= x) and (at == len(ends) or ends[at][0] >= y):
            ends.insert(at, (x, y))
            out.append((n, x, y))
    return out


def _slack(length: int) -> int:
    """Words that a copy of a template may have more than it."""
    return length // 4 + 3


def _choices(phrase: str) -> list[frozenset[int]]:
    """The hashes of the words allowed at each place of a phrase."""
    return [frozenset(FOLDED.of(w.replace("/", " ").encode()).tolist()) for w in phrase.split()]


class TemplateSeeds(Seeds):
    """Words or pairs of neighbouring words of templates, at least one of which every copy holds.

    A copy has ``least`` of a template's words in their order and at most
    ``_slack`` words more. If it must hold a phrase, a word of that will do: the
    one that the fewest templates have. Else pairs of neighbours are looked for,
    so many that missing and added words cannot part them all, or in short
    templates so many single words that they cannot all be missing: those with
    the most letters, as long words are rare.
    """

    def __init__(self, texts: list[str], phrases: list[list[str]], least: float):
        split = [t.encode().translate(FOLD).split() for t in texts]
        self.items = [(k, FOLDED.of(t.encode())) for k, t in enumerate(texts)]
        holders = Counter(h for _, w in self.items for h in set(w.tolist()))
        rows, used = [], set()
        for (k, words), own, given in zip(self.items, split, phrases):
            n, m = len(words), -int(-(least * len(words) - 1e-9) // 1)
            sure_word = [h for p in given for c in _choices(p) if len(c) == 1 for h in c if h in set(words.tolist())]
            letters = np.array([len(w) for w in own])
            if sure_word:
                gap, at = 0, np.flatnonzero(words == np.uint64(min(sure_word, key=lambda h: (holders[h], h))))
            elif (sure := m - 1 - (n - m) - _slack(n)) > 0:
                gap, at = 1, np.argsort(-(letters[1:] + letters[:-1]), kind="stable")[: n - sure]
            else:
                gap, at = 0, np.argsort(-letters, kind="stable")[: n - m + 1]
            used.add(gap)
            rows.append((word_pairs(words, gap)[at], np.full(len(at), k), at))
        self.sizes = sorted(used)
        self._set(rows)


def _scan(seeds, names: list[str], least: float, distinct: Mapping[str, tuple[str, ...]]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = seeds.value
        first, last = np.searchsorted(own.hash, own.keys, "left"), np.searchsorted(own.hash, own.keys, "right")
        wanted = [w.tolist() for _, w in own.items]
        phrases = [[_choices(p) for p in distinct.get(name, ())] for name in names]
        fillers = frozenset(FOLDED.of(" ".join(FILLERS).encode()).tolist())

        def judged(words: np.ndarray, where: np.ndarray, which: np.ndarray) -> tuple | None:
            n = last[which] - first[which]
            row = np.repeat(first[which], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            item, begin = own.item[row], np.repeat(where, n) - own.at[row]
            best, copies = (0, 0.0, "", 0, 0), 0
            for k in np.unique(item):
                for n_matched, a, z in _copies(words, wanted[k], np.sort(begin[item == k]), least):
                    # A last word that is written another way is not in the span, but beside it.
                    if not _holds(words[a : z + 2].tolist(), phrases[k], fillers):
                        continue
                    copies += 1
                    found = (n_matched, n_matched / len(wanted[k]), names[k], a, z)
                    if (found[0], found[1], -found[3]) > (best[0], best[1], -best[3]) or not best[0]:
                        best = found
            return (best[2], best[1], best[0], best[3], best[4], copies) if copies else None

        for batch in batches:
            rows = [(None, 0.0, 0, None, None, 0)] * batch.num_rows
            for i, _, words, at in FOLDED.chunks(batch.column(1)):
                for k, where, which in by_text(*own.find(words, at)):
                    rows[i + k] = judged(words[at[k] : at[k + 1]], where, which) or rows[i + k]
            kinds = (pa.string(), pa.float64(), pa.int64(), pa.int64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array([r[i] for r in rows], t) for i, t in enumerate(kinds))],
                names=["doc_id", "license", "coverage", "matched_words", "start_word", "end_word", "n_found"],
            )

    return run


def scan_licenses(docs: DataFrame, templates: Mapping[str, str] = TEMPLATES, least: float = 0.8, distinct: Mapping[str, tuple[str, ...]] = DISTINCT) -> DataFrame:
    """One row per document: (doc_id, license, coverage, matched_words, start_word, end_word, n_found).

    Words are lower-cased (A-Z), ASCII signs part them. Seeds of a template show
    where a copy may lie (``TemplateSeeds``: every copy holds one); that part of
    the text is aligned with the template by patience alignment, and
    ``coverage`` is the matched share of the template's words. A copy must also
    hold the phrases of ``distinct``: the name and version that tell it from
    notices of other licenses. Of copies with at least ``least``, the one with the
    most matched words is named (then the higher coverage, then the first place,
    then the least name); ``n_found`` counts all. Without one, license and span
    are null and the coverage is 0: so for null and empty texts. A null id comes
    back null; repeated rows get equal results; other columns are not read; an
    empty table gives no rows. The templates are sent to every task: a fixed list.
    """
    names = sorted(n for n in templates if templates[n].encode().translate(FOLD).split())
    seeds = TemplateSeeds([templates[n] for n in names], [list(distinct.get(n, ())) for n in names], least)
    sent = docs.sparkSession.sparkContext.broadcast(seeds)
    source = docs.select(id_or("doc_id"), F.col("text").cast("binary").alias("text"))
    out = source.mapInArrow(
        _scan(sent, names, least, dict(distinct)),
        "doc_id long, license string, coverage double, matched_words long, start_word long, end_word long, n_found long",
    )
    return out.withColumn("doc_id", id_back("doc_id"))
