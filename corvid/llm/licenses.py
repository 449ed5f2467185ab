"""Licence scans by sentence rules.

Texts are normalised to words (lower-cased runs of letters, digits and non-ASCII, so line
breaks, punctuation and comment marks don't matter). Every known licence sentence has an
identifier; wherever its words stand one after the other, the text has that identifier
there. Candidates are found by the hash of a sentence's first words (three, or all of a shorter
one), then verified by the hash of all its words. Sentences are looked for in the word stream
rather than split off first, as licence texts often lack the marks a splitter needs. A text's identifiers, in order of place, are matched against
the rules: a rule is a sequence of identifiers, the rules are tried in their order (longer
texts before the short notices they contain), and identifiers that a rule used are gone.
Left-over identifiers are reported as such.

Null or empty text: no identifiers. Overlapping sentences: the longer wins (in words), then the
earlier; two identifiers with the same words: the first in the table. Null ids are kept; repeated rows each get a row. An empty table gives an empty
result. Extra columns are not read.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corvid.llm.common import RangeHash, is_space, lower, range_hash, slices, tokens

#: Identifier -> sentence of a public licence text or notice.
SENTENCES = {
    "mit-grant": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
                 "associated documentation files (the \"Software\"), to deal in the Software without restriction",
    "mit-notice": "The above copyright notice and this permission notice shall be included in all copies or "
                  "substantial portions of the Software",
    "mit-warranty": "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED",
    "mit-ref": "Released under the MIT License",
    "mit-ref-licensed": "Licensed under the MIT License",
    "apache2-ref": "Licensed under the Apache License, Version 2.0",
    "apache2-not-use": "you may not use this file except in compliance with the License",
    "apache2-copy": "You may obtain a copy of the License at",
    "apache2-basis": "distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR "
                     "CONDITIONS OF ANY KIND, either express or implied",
    "gpl3-ref": "This work is licensed under the GNU General Public License, version 3",
    "gpl-free": "you can redistribute it and/or modify it under the terms of the GNU General Public License as "
                "published by the Free Software Foundation",
    "gpl-v2": "either version 2 of the License, or (at your option) any later version",
    "gpl-v3": "either version 3 of the License, or (at your option) any later version",
    "gpl-warranty": "without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE",
    "bsd-grant": "Redistribution and use in source and binary forms, with or without modification, are permitted "
                 "provided that the following conditions are met",
    "bsd-source": "Redistributions of source code must retain the above copyright notice, this list of conditions "
                  "and the following disclaimer",
    "bsd-binary": "Redistributions in binary form must reproduce the above copyright notice, this list of conditions "
                  "and the following disclaimer in the documentation and/or other materials provided with the distribution",
    "bsd-endorse": "may be used to endorse or promote products derived from this software without specific prior "
                   "written permission",
    "mpl2-ref": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",
    "cc-by-4": "Licensed under CC BY 4.0",
    "cc-by-sa-4": "Licensed under CC BY-SA 4.0",
    "cc-by-nc-4": "Licensed under CC BY-NC 4.0",
    "cc0-ref": "To the extent possible under law, the author has waived all copyright and related or neighboring rights",
    "reserved": "All rights reserved",
    "mit-header": "The MIT License (MIT)",
    "mit-subject": "subject to the terms of the MIT License",
    "apache2-terms": "under the terms of the Apache License, Version 2.0",
    "apache2-copyright-grant": "each Contributor hereby grants to You a perpetual, worldwide, non-exclusive, no-charge, "
                               "royalty-free, irrevocable copyright license to reproduce, prepare Derivative Works of",
    "apache2-patent-grant": "each Contributor hereby grants to You a perpetual, worldwide, non-exclusive, no-charge, "
                            "royalty-free, irrevocable (except as stated in this section) patent license",
    "bsd-source-hyphen": "Redistributions of source code must retain the copyright notice, this list of conditions and the "
                         "following disclaimer",
    "bsd-advertise": "All advertising materials mentioning features or use of this software must display the following "
                     "acknowledgement",
    "bsd-style": "Use of this source code is governed by a BSD-style license",
    "isc-grant": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
                 "hereby granted, provided that the above copyright notice and this permission notice appear in all copies",
    "isc-grant-and": "Permission to use, copy, modify, and distribute this software for any purpose with or without fee is "
                     "hereby granted, provided that the above copyright notice and this permission notice appear in all copies",
    "0bsd-grant": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
                  "hereby granted",
    "isc-warranty": "THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE",
    "zlib-warranty": "This software is provided 'as-is', without any express or implied warranty",
    "zlib-grant": "Permission is granted to anyone to use this software for any purpose, including commercial applications, "
                  "and to alter it and redistribute it freely, subject to the following restrictions",
    "zlib-origin": "The origin of this software must not be misrepresented; you must not claim that you wrote the original "
                   "software",
    "zlib-altered": "Altered source versions must be plainly marked as such, and must not be misrepresented as being the "
                    "original software",
    "zlib-notice": "This notice may not be removed or altered from any source distribution",
    "boost-ref": "Distributed under the Boost Software License, Version 1.0",
    "boost-grant": "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the "
                   "software and accompanying documentation covered by this license",
    "unlicense-public": "This is free and unencumbered software released into the public domain",
    "unlicense-anyone": "Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software",
    "postgresql-grant": "Permission to use, copy, modify, and distribute this software and its documentation for any purpose, "
                        "without fee, and without a written agreement is hereby granted",
    "ofl-ref": "This Font Software is licensed under the SIL Open Font License, Version 1.1",
    "gpl2-only": "under the terms of version 2 of the GNU General Public License",
    "gpl2-body": "The licenses for most software are designed to take away your freedom to share and change it",
    "gpl3-body": "The GNU General Public License is a free, copyleft license for software and other kinds of works",
    "lgpl-free": "you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as "
                 "published by the Free Software Foundation",
    "lgpl-library": "you can redistribute it and/or modify it under the terms of the GNU Library General Public License as "
                    "published by the Free Software Foundation",
    "lgpl-v21": "either version 2.1 of the License, or (at your option) any later version",
    "lgpl3-body": "This version of the GNU Lesser General Public License incorporates the terms and conditions of version 3 of "
                  "the GNU General Public License",
    "agpl-free": "you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as "
                 "published by the Free Software Foundation",
    "agpl-body": "The GNU Affero General Public License is a free, copyleft license for software and other kinds of works",
    "mpl2-file": "If a copy of the MPL was not distributed with this file, You can obtain one at",
    "mpl2-body": "If it is impossible or impractical for You to comply with any of the terms of this License with respect to "
                 "some or all of the Covered Software",
    "epl1-ref": "made available under the terms of the Eclipse Public License v1.0",
    "epl2-ref-v": "made available under the terms of the Eclipse Public License v2.0",
    "epl2-ref": "made available under the terms of the Eclipse Public License 2.0",
    "cddl-ref": "subject to the terms of the Common Development and Distribution License",
    "cc-by-4-long": "licensed under a Creative Commons Attribution 4.0 International License",
    "cc-by-sa-4-long": "licensed under a Creative Commons Attribution-ShareAlike 4.0 International License",
    "cc-by-nc-4-long": "licensed under a Creative Commons Attribution-NonCommercial 4.0 International License",
    "cc0-dedicate": "has dedicated the work to the public domain by waiving all of his or her rights to the work worldwide "
                    "under copyright law",
}
#: Fixed values: (licence, sequence of sentence identifiers), in the order they are tried.
RULES = (
    ("MIT", ("mit-grant", "mit-notice", "mit-warranty")),
    ("BSD-4-Clause", ("bsd-grant", "bsd-source", "bsd-binary", "bsd-advertise", "bsd-endorse")),
    ("BSD-3-Clause", ("bsd-grant", "bsd-source", "bsd-binary", "bsd-endorse")),
    ("BSD-3-Clause", ("bsd-grant", "bsd-source-hyphen", "bsd-binary", "bsd-endorse")),
    ("BSD-2-Clause", ("bsd-grant", "bsd-source", "bsd-binary")),
    ("BSD-2-Clause", ("bsd-grant", "bsd-source-hyphen", "bsd-binary")),
    ("Zlib", ("zlib-warranty", "zlib-grant", "zlib-origin", "zlib-altered", "zlib-notice")),
    ("BSL-1.0", ("boost-grant", "mit-warranty")),
    ("Unlicense", ("unlicense-public", "unlicense-anyone", "mit-warranty")),
    ("ISC", ("isc-grant", "isc-warranty")),
    ("ISC", ("isc-grant-and", "isc-warranty")),
    ("0BSD", ("0bsd-grant", "isc-warranty")),
    ("Apache-2.0", ("apache2-copyright-grant", "apache2-patent-grant")),
    ("Apache-2.0", ("apache2-ref", "apache2-not-use", "apache2-copy", "apache2-basis")),
    ("AGPL-3.0-or-later", ("agpl-free", "gpl-v3", "gpl-warranty")),
    ("AGPL-3.0-or-later", ("agpl-free", "gpl-v3")),
    ("LGPL-2.1-or-later", ("lgpl-free", "lgpl-v21", "gpl-warranty")),
    ("LGPL-2.1-or-later", ("lgpl-free", "lgpl-v21")),
    ("LGPL-3.0-or-later", ("lgpl-free", "gpl-v3", "gpl-warranty")),
    ("LGPL-3.0-or-later", ("lgpl-free", "gpl-v3")),
    ("LGPL-2.0-or-later", ("lgpl-library", "gpl-v2", "gpl-warranty")),
    ("LGPL-2.0-or-later", ("lgpl-library", "gpl-v2")),
    ("GPL-3.0-or-later", ("gpl-free", "gpl-v3", "gpl-warranty")),
    ("GPL-2.0-or-later", ("gpl-free", "gpl-v2", "gpl-warranty")),
    ("GPL-3.0-or-later", ("gpl-free", "gpl-v3")),
    ("GPL-2.0-or-later", ("gpl-free", "gpl-v2")),
    ("Apache-2.0", ("apache2-ref",)),
    ("GPL-3.0", ("gpl3-ref",)),
    ("MIT", ("mit-ref",)),
    ("MIT", ("mit-ref-licensed",)),
    ("MPL-2.0", ("mpl2-ref",)),
    ("CC-BY-4.0", ("cc-by-4",)),
    ("CC-BY-SA-4.0", ("cc-by-sa-4",)),
    ("CC-BY-NC-4.0", ("cc-by-nc-4",)),
    ("CC0-1.0", ("cc0-ref",)),
    ("MPL-2.0", ("mpl2-body",)),
    ("MPL-2.0", ("mpl2-file",)),
    ("GPL-2.0-only", ("gpl2-only",)),
    ("GPL-2.0", ("gpl2-body",)),
    ("GPL-3.0", ("gpl3-body",)),
    ("LGPL-3.0", ("lgpl3-body",)),
    ("AGPL-3.0", ("agpl-body",)),
    ("Apache-2.0", ("apache2-terms",)),
    ("MIT", ("mit-subject",)),
    ("MIT", ("mit-header",)),
    ("Unlicense", ("unlicense-public",)),
    ("BSL-1.0", ("boost-ref",)),
    ("PostgreSQL", ("postgresql-grant",)),
    ("OFL-1.1", ("ofl-ref",)),
    ("EPL-1.0", ("epl1-ref",)),
    ("EPL-2.0", ("epl2-ref-v",)),
    ("EPL-2.0", ("epl2-ref",)),
    ("CDDL-1.0", ("cddl-ref",)),
    ("CC-BY-4.0", ("cc-by-4-long",)),
    ("CC-BY-SA-4.0", ("cc-by-sa-4-long",)),
    ("CC-BY-NC-4.0", ("cc-by-nc-4-long",)),
    ("CC0-1.0", ("cc0-dedicate",)),
)
#: Every licence of the rules may also be named by an identifier line.
SENTENCES |= {f"spdx-{name}": f"SPDX-License-Identifier: {name}" for name, _ in RULES}
RULES += tuple((name, (f"spdx-{name}",)) for name in dict.fromkeys(name for name, _ in RULES))

START = 3  # words that find a candidate

_gap = is_space(np.arange(256, dtype=np.uint8))
_gap |= np.array([b < 128 and not chr(b).isalnum() for b in range(256)])


def normalised(sentence: str) -> list[str]:
    return re.findall(r"[0-9a-z\x80-\U0010ffff]+", sentence.lower())


def _word_hashes(data: np.ndarray, offsets: np.ndarray):
    data = lower(data)
    t = tokens(data, offsets, lambda b: _gap[b])
    return t, range_hash(data, t.starts, t.ends)


@dataclass(frozen=True)
class Known:
    """A sentence table by hashes: the starts of each start length, and of each sentence
    length (words) the hash of all words -> identifier."""

    starts: dict[int, np.ndarray]
    whole: dict[int, dict[int, str]]


@lru_cache(maxsize=8)
def known(sentences: tuple[tuple[str, str], ...]) -> Known:
    starts: dict[int, set[int]] = {}
    whole: dict[int, dict[int, str]] = {}
    for ident, sentence in sentences:
        raw = np.frombuffer(" ".join(normalised(sentence)).encode(), np.uint8)
        _, h = _word_hashes(raw, np.array([0, len(raw)]))
        n = len(h)
        if not n:
            continue
        first, full = range_hash(h, np.zeros(2, np.int64), np.array([min(START, n), n])).tolist()
        starts.setdefault(min(START, n), set()).add(first)
        whole.setdefault(n, {}).setdefault(full, ident)
    return Known({k: np.array(sorted(v), np.uint64) for k, v in starts.items()}, whole)


def _apart(hits: list[tuple[int, int, str]]) -> list[tuple[int, str]]:
    """Of ``(words, place, identifier)`` in one text those that stand: longer first, then
    earlier, none overlapping one that stands already. ``(place, identifier)`` by place.
    The standing ones are kept sorted, so only the neighbours of a new one are looked at."""
    places: list[int] = []
    stand: list[tuple[int, int, str]] = []
    for n, i, ident in sorted(hits, key=lambda x: (-x[0], x[1])):
        j = bisect_left(places, i)
        if (j and stand[j - 1][0] + stand[j - 1][1] > i) or (j < len(stand) and places[j] < i + n):
            continue
        places.insert(j, i)
        stand.insert(j, (i, n, ident))
    return [(i, ident) for i, _, ident in stand]


def recognise(data: np.ndarray, offsets: np.ndarray, sentences: dict[str, str]) -> list[list[tuple[int, str]]]:
    """Per text of a slice: (word place, identifier) of its known sentences, in order."""
    of = known(tuple(sentences.items()))
    t, h = _word_hashes(data, offsets)
    span = RangeHash(h)
    found: list[list[tuple[int, int, str]]] = [[] for _ in range(len(offsets) - 1)]
    for k, starts in of.starts.items():
        at = np.arange(max(len(h) - k + 1, 0))
        maybe = at[np.isin(span(at, at + k), starts)]
        doc = np.searchsorted(t.first, maybe, "right") - 1
        for n, idents in of.whole.items():
            if min(START, n) != k:
                continue
            fits = maybe + n <= t.first[doc + 1]  # a sentence never runs into the next text
            place, owner = maybe[fits], doc[fits]
            for i, d, full in zip(place.tolist(), owner.tolist(), span(place, place + n).tolist()):
                if full in idents:
                    found[d].append((n, i - int(t.first[d]), idents[full]))
    return [_apart(hits) for hits in found]


def match_rules(idents: list[str], rules=RULES) -> tuple[list[str], list[str]]:
    """(licences in order of their first sentence, left-over identifiers). A rule's
    identifiers appear in order, with none but unused other identifiers between."""
    left = list(enumerate(idents))
    got: list[tuple[int, str]] = []
    for name, seq in rules:
        while True:
            used, k = [], 0
            for j, (_, ident) in enumerate(left):
                if ident == seq[k]:
                    used.append(j)
                    k += 1
                    if k == len(seq):
                        break
            if k < len(seq):
                break
            got.append((left[used[0]][0], name))
            gone = set(used)
            left = [x for j, x in enumerate(left) if j not in gone]
    return [name for _, name in sorted(got)], [ident for _, ident in left]


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", sentences: dict[str, str] | None = None,
         rules=RULES) -> DataFrame:
    """One row per input row: ``(doc_id, n_sentences, sentence_ids, licenses, unmatched)``,
    the lists comma-joined, ``licenses`` distinct and sorted."""
    src = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    table = dict(SENTENCES if sentences is None else sentences)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for s in slices(batches):
            out = []
            for hits in recognise(s.data, s.offsets, table):
                idents = [ident for _, ident in hits]
                names, rest = match_rules(idents, rules) if idents else ([], [])
                out.append((len(idents), ",".join(idents), ",".join(sorted(set(names))), ",".join(rest)))
            n, ids, names, rest = zip(*out)
            yield pa.RecordBatch.from_arrays([s.batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(ids, pa.string()),
                                              pa.array(names, pa.string()), pa.array(rest, pa.string())],
                                             ["doc_id", "n_sentences", "sentence_ids", "licenses", "unmatched"])

    return src.mapInArrow(run, f"doc_id {dict(src.dtypes)['doc_id']}, n_sentences bigint, sentence_ids string, "
                               "licenses string, unmatched string")
