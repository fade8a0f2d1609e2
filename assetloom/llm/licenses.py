"""License notices by conditional compression."""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Iterator
from difflib import SequenceMatcher

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, functions as F

from assetloom.llm.text import like

_GPL = ("This {what} is free software: you can redistribute it and/or modify it under the terms of the GNU {name} "
        "as published by the Free Software Foundation, either version {version} of the License, or (at your option) any "
        "later version.")
_CC = "This work is licensed under a Creative Commons {} 4.0 International License."

# Notices by which well-known licenses are announced, and sentences of their texts.
TEMPLATES = {
    "MIT": (
        "Released under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
        "associated documentation files, to deal in the Software without restriction.",
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions "
        "of the Software.",
    ),
    "Apache-2.0": (
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
        "compliance with the License.",
        "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed "
        "on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.",
    ),
    "GPL-2.0": (
        "This work is licensed under the GNU General Public License, version 2.",
        _GPL.format(what="program", name="General Public License", version="2"),
    ),
    "GPL-3.0": (
        "This work is licensed under the GNU General Public License, version 3.",
        _GPL.format(what="program", name="General Public License", version="3"),
    ),
    "LGPL-2.1": (
        "This work is licensed under the GNU Lesser General Public License, version 2.1.",
        _GPL.format(what="library", name="Lesser General Public License", version="2.1"),
    ),
    "LGPL-3.0": (
        "This work is licensed under the GNU Lesser General Public License, version 3.",
        _GPL.format(what="library", name="Lesser General Public License", version="3"),
    ),
    "AGPL-3.0": (
        "This work is licensed under the GNU Affero General Public License, version 3.",
        _GPL.format(what="program", name="Affero General Public License", version="3"),
    ),
    "BSD-2-Clause": (
        "Licensed under the BSD 2-Clause License.",
    ),
    "BSD-3-Clause": (
        "Licensed under the BSD 3-Clause License.",
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote "
        "products derived from this software without specific prior written permission.",
    ),
    # the opening of both
    "BSD": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
        "that the following conditions are met.",
    ),
    "ISC": (
        "Licensed under the ISC License.",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies.",
    ),
    "Unlicense": (
        "This is free and unencumbered software released into the public domain.",
    ),
    "CC0-1.0": (
        "To the extent possible under law, the author has waived all copyright and related or neighboring rights to "
        "this work.",
    ),
    "CC-BY-4.0": (_CC.format("Attribution"), "Licensed under CC BY 4.0."),
    "CC-BY-SA-4.0": (_CC.format("Attribution-ShareAlike"), "Licensed under CC BY-SA 4.0."),
    "CC-BY-NC-4.0": (_CC.format("Attribution-NonCommercial"), "Licensed under CC BY-NC 4.0."),
    "CC-BY-ND-4.0": (_CC.format("Attribution-NoDerivatives"), "Licensed under CC BY-ND 4.0."),
    "CC-BY-NC-SA-4.0": (_CC.format("Attribution-NonCommercial-ShareAlike"), "Licensed under CC BY-NC-SA 4.0."),
    "CC-BY-NC-ND-4.0": (_CC.format("Attribution-NonCommercial-NoDerivatives"), "Licensed under CC BY-NC-ND 4.0."),
    "MPL-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    ),
    "EPL-2.0": (
        "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0.",
    ),
    "reserved": (
        "All rights reserved.",
    ),
}
#: Licenses that a line of this form may name.
_TAG = "SPDX-License-Identifier: {}"
TEMPLATES = {name: texts if name in ("BSD", "reserved") else (*texts, _TAG.format(name)) for name, texts in TEMPLATES.items()}

#: Words one of which a text must hold to be looked at; each template has some. Any white space, line
#: break or comment mark may stand between them.
TRIGGERS = "(?i)" + "|".join(x.replace(" ", r"\W+") for x in (
    "licen[sc]e", "creative commons", "permission is hereby granted", "all rights reserved", "redistribution and use",
    "free software", "permission to use", "permission notice", "public domain", "waived all copyright", "endorse or promote"))
#: Share of a template's words that may be missing, changed or strange, if none of them decides.
MOST_DIFFERENT = 0.1

#: Templates that a block's compression puts first; only they are confirmed. Those of one family of licenses differ by a
#: word or two, so all of a family must find room.
LEADING = 8
#: Words on either side of a trigger of the narrow blocks, for templates of one line and of a few words.
NARROW = (12, 5)

HITS = ("doc_id bigint, line bigint, start bigint, end bigint, license string, saved double, rank int, "
        "n_missing bigint, n_strange bigint, wording string")

#: Words that tell licenses apart, besides numbers: a template's own may not differ, and none may be added.
NAMES = frozenset("""mit apache gnu general lesser library affero bsd clause mozilla creative commons cc by sa nc nd cc0
    attribution sharealike noncommercial noderivatives noderivs eclipse isc unlicense zero boost spdx gpl lgpl agpl mpl
    epl""".split())

_WORD = re.compile(r"\w[\w.+]*\w|\w")
_NUMBER = re.compile(r"v?\.?(\d+(?:\.\d+)*?)(?:\.0)*")
_TRIGGER = re.compile(TRIGGERS.removeprefix("(?i)"), re.IGNORECASE)


def _plain(word: str) -> str:
    """The word as it is compared: small letters, versions without ``v`` and without ``.0``."""
    number = _NUMBER.fullmatch(word.lower())
    return number[1] if number else word.lower()


def _decides(word: str) -> bool:
    # longer numbers are years and numbers of lines
    return word in NAMES or (word[0].isdigit() and len(word) <= 4 and ("." in word or len(word) <= 2))


class Templates:
    """Compressors with each template as raw dictionary."""

    def __init__(self, templates: dict[str, tuple[str, ...]]):
        options = {"level": 3, "write_content_size": False, "write_dict_id": False, "write_checksum": False}
        self._plain = zstandard.ZstdCompressor(**options)
        self.rows = []
        self._seen: dict[tuple, list[tuple]] = {}
        for name, texts in templates.items():
            for text in texts:
                words = [_plain(w) for w in _WORD.findall(text)]
                raw = zstandard.ZstdCompressionDict(" ".join(words).encode(), dict_type=zstandard.DICT_TYPE_RAWCONTENT)
                self.rows.append((name, words, zstandard.ZstdCompressor(dict_data=raw, **options)))

    def ranked(self, block: str) -> list[tuple[float, int]]:
        """(share saved, template) from best to worst; ties in order of the templates."""
        data = block.encode()
        alone = len(self._plain.compress(data))
        saved = [((alone - len(c.compress(data))) / alone, -i) for i, (_, _, c) in enumerate(self.rows)]
        return [(s, -i) for s, i in sorted(saved, reverse=True)]

    def wording(self, words: list[str], template: int) -> tuple[int, int, int, int, str, bool]:
        """Best stretch of ``words``: first, end, words missing from it, words strange in it or in the place of its
        first or last words, the differences, and whether a word that decides is among them."""
        want = self.rows[template][1]
        blocks = [b for b in SequenceMatcher(None, words, want, autojunk=False).get_matching_blocks() if b.size]
        if not blocks:
            return 0, 0, len(want), 0, "", True
        # words that match far from the rest are left out where that costs less than what lies between
        def cost(i: int, j: int) -> int:
            same = sum(b.size for b in blocks[i:j + 1])
            return len(want) - same + blocks[j].a + blocks[j].size - blocks[i].a - same

        i, j = min(((i, j) for i in range(len(blocks)) for j in range(i, len(blocks))), key=lambda x: cost(*x))
        blocks = blocks[i:j + 1]
        first, end = blocks[0].a, blocks[-1].a + blocks[-1].size
        same = sum(b.size for b in blocks)
        notes, differ, strange = [], [], 0
        # words that stand where the template's first or last words are missing belong to the comparison
        at_a, at_b = max(0, first - blocks[0].b), 0
        last = min(len(words), end + len(want) - blocks[-1].b - blocks[-1].size)
        for b in [*blocks, None]:
            a_to, b_to = (b.a, b.b) if b else (last, len(want))
            notes += [f"-{w}" for w in want[at_b:b_to]] + [f"+{w}" for w in words[at_a:a_to]]
            differ += want[at_b:b_to] + words[at_a:a_to]
            strange += a_to - at_a
            if b:
                at_a, at_b = b.a + b.size, b.b + b.size
        return first, end, len(want) - same, strange, " ".join(notes), any(map(_decides, differ))

    def leading(self, part: tuple[str, ...], at: int) -> list[tuple[float, int]]:
        """(share saved, template) of the ``LEADING`` templates of the block, and of the narrow blocks around word
        ``at``, best first: text around a short notice hides what its template saves."""
        best: dict[int, tuple[int, float]] = {}
        for words in (part, *(part[max(0, at - n):at + n] for n in NARROW)):
            for rank, (saved, i) in enumerate(self.ranked(" ".join(words))[:LEADING]):
                best[i] = min(best.get(i, (rank, -saved)), (rank, -saved))
        return [(-saved, i) for (_, saved), i in sorted((v, i) for i, v in best.items())]

    def confirmed(self, part: tuple[str, ...], at: int) -> list[tuple]:
        """Templates found in a block around word ``at``: order, first word, end, name, share saved, rank, missing,
        strange, differences."""
        hits = []
        for rank, (saved, i) in enumerate(self.leading(part, at), 1):
            name, want, _ = self.rows[i]
            first, end, missing, strange, notes, other = self.wording(list(part), i)
            if not other and missing + strange <= MOST_DIFFERENT * len(want):
                key = (missing - len(want), missing + strange, rank)
                hits.append((key, first, end, name, saved, rank, missing, strange, notes))
        return hits

    def scan(self, text: str) -> list[tuple]:
        """Licenses a text announces: start, end, name, share saved, rank, missing, strange, differences."""
        found = list(_WORD.finditer(text))
        words = [_plain(m.group()) for m in found]
        ends = [m.end() for m in found]
        reach = max(len(w) for _, w, _ in self.rows) + 2
        hits, looked = [], -1
        for trigger in _TRIGGER.finditer(text):
            # a block around the trigger, as long as the longest template either way
            middle = bisect_right(ends, trigger.start())
            if middle == looked:
                continue
            looked = middle
            low = max(0, middle - reach)
            block = tuple(words[low:middle + reach]), middle - low
            if block not in self._seen:
                if len(self._seen) > 10_000:
                    self._seen.clear()
                self._seen[block] = self.confirmed(*block)
            hits += [(key, found[low + first].start(), ends[low + end - 1], *rest)
                     for key, first, end, *rest in self._seen[block]]
        out: list[tuple] = []
        for _, start, end, *rest in sorted(hits):
            if all(end <= a or b <= start for a, b, *_ in out):
                out.append((start, end, *rest))
        return sorted(out)


def license_hits(docs: DataFrame, templates: dict[str, tuple[str, ...]] | None = None) -> DataFrame:
    """One row per license notice: doc_id, line (from 0) where it starts, start and end in code points of the
    text, license, share of compressed bytes saved, rank of the template by it, words missing, words
    strange, and the wording differences (-missing, +strange).

    A notice may span lines; only words count, so white space, line breaks and comment marks between them do
    not matter. Around each trigger word a block is compressed alone
    and with every template as raw zstandard dictionary; templates are ranked by the bytes they save, in this block and in
    two narrow ones for short notices. The ``LEADING`` ones of each are confirmed by the exact difference in words, no others. Among the confirmed the
    ones that explain most words win, then the fewest differences, then the rank; hits of a text do not overlap.

    Only documents that hold a trigger leave the JVM; nothing is shuffled. Null and empty texts
    have no hits; repeated rows give repeated hits; other columns are not read.
    """
    chosen = templates or TEMPLATES
    schema = like(HITS)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        prepared = Templates(chosen)
        for batch in batches:
            rows = [(doc_id, text.count("\n", 0, hit[0]), *hit)
                    for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True)
                    for hit in prepared.scan(text)]
            columns = zip(*rows, strict=True) if rows else [[]] * len(schema)
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(v), f.type) for v, f in zip(columns, schema, strict=True)], schema=schema)

    some = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").where(F.col("text").rlike(TRIGGERS))
    return some.mapInArrow(scan, HITS)


def license_report(docs: DataFrame) -> DataFrame:
    return license_hits(docs).withColumn("saved", F.round("saved", 6))
