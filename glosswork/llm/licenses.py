"""Licence notices found by conditional compression.

Blocks of text around licence words are compressed alone and with each template
as a raw zstandard dictionary. Templates rank by how much smaller they make the
block; from the best on, the exact wording is compared word by word, and a
template wins if few words differ and none of the telling ones (versions and
the words that name a variant). A block whose templates all differ is not
reported. The saving only ranks: short notices save little in running text, so
every template whose words the block holds is compared.

Rows are independent: no shuffle, and only texts with a licence word reach
Python. Every occurrence of a licence word in the whole text gets its block.

Defined results: a null or empty text has no notices; equal gains rank by
template name; repeated rows are each reported; an empty table gives an empty
result; other columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator, Mapping
from difflib import SequenceMatcher

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, functions as F

REACH, CLOSE = 700, 120
MIN_GAIN = float("-inf")  # a least saving, if a caller wants one
MAX_DIFFERENT = 0.15
LEVEL = 3
CUE = (
    r"(?i)licen[cs]e|copyright|permission\s+is\s+hereby|redistribut|warrant(?:y|ies)|creative\s+commons"
    r"|\bcc[\x20-]by|\bcc0\b|spdx|public\s+domain|free\s+software"
)
WORD = re.compile(r"[a-z0-9]+(?:[.-][a-z0-9]+)*")

# Wording of public licence notices.
TEMPLATES: dict[str, list[str]] = {
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in'
        " compliance with the License. You may obtain a copy of the License at"
        " http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing,"
        ' software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR'
        " CONDITIONS OF ANY KIND, either express or implied.",
        "SPDX-License-Identifier: Apache-2.0",
    ],
    "MIT": [
        "Released under the MIT License.",
        "Licensed under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and"
        ' associated documentation files (the "Software"), to deal in the Software without restriction, including'
        " without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell"
        " copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the"
        " following conditions:",
        "SPDX-License-Identifier: MIT",
    ],
    "GPL-3.0": [
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General"
        " Public License as published by the Free Software Foundation, either version 3 of the License, or (at your"
        " option) any later version.",
        "SPDX-License-Identifier: GPL-3.0-or-later",
        "SPDX-License-Identifier: GPL-3.0-only",
    ],
    "GPL-2.0": [
        "This work is licensed under the GNU General Public License, version 2.",
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General"
        " Public License as published by the Free Software Foundation; either version 2 of the License, or (at your"
        " option) any later version.",
    ],
    "LGPL-3.0": ["This work is licensed under the GNU Lesser General Public License, version 3."],
    "AGPL-3.0": ["This work is licensed under the GNU Affero General Public License, version 3."],
    "BSD-3-Clause": [
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided"
        " that the following conditions are met: 1. Redistributions of source code must retain the above copyright"
        " notice, this list of conditions and the following disclaimer.",
        "Licensed under the BSD 3-Clause License.",
    ],
    "MPL-2.0": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL"
        " was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."
    ],
    "CC-BY-4.0": [
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    ],
    "CC-BY-SA-4.0": [
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    ],
    "CC-BY-NC-4.0": [
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    ],
    "CC0-1.0": ["Dedicated to the public domain under CC0 1.0."],
    "Unlicense": ["This is free and unencumbered software released into the public domain."],
}
# Words that tell licences apart: none of them may differ.
TELLING = (
    set("apache mit gnu lesser affero bsd mozilla mpl cc cc0 by by-sa by-nc".split())
    | set("attribution attribution-sharealike attribution-noncommercial version v or-later only".split())
)

FOUND = (
    "start int, end int, license string, template int, gain double, missing array<string>, extra array<string>"
)


def _telling(word: str) -> bool:
    return word in TELLING or any(c.isdigit() for c in word)


class Scanner:
    """Compressors of all templates; one per task."""

    def __init__(self, templates: Mapping[str, list[str]]):
        self.plain = zstandard.ZstdCompressor(level=LEVEL, write_content_size=False)
        self.templates = []
        for name in sorted(templates):
            for number, wording in enumerate(templates[name]):
                raw = zstandard.ZstdCompressionDict(wording.encode(), dict_type=zstandard.DICT_TYPE_RAWCONTENT)
                packer = zstandard.ZstdCompressor(level=LEVEL, dict_data=raw, write_content_size=False)
                self.templates.append((name, number, WORD.findall(wording.lower()), packer))

    def ranked(self, block: str, min_gain: float) -> list[tuple[float, str, int, list[str]]]:
        """Templates by the share of the compressed block that they save."""
        data = block.encode()
        alone = len(self.plain.compress(data))
        found = []
        for name, number, words, packer in self.templates:
            gain = 1 - len(packer.compress(data)) / alone
            if gain >= min_gain:
                found.append((gain, name, number, words))
        return sorted(found, key=lambda x: (-x[0], x[1], x[2]))

    def notices(self, text: str, min_gain: float, max_different: float) -> list[dict]:
        """Confirmed notices of a text, the longest wording of each place."""
        found: dict[tuple[int, int], dict] = {}
        for cue in re.finditer(CUE, text):
            lo, hi = max(0, cue.start() - REACH), min(len(text), cue.end() + REACH)
            words = [(m[0], lo + m.start(), lo + m.end()) for m in WORD.finditer(text[lo:hi].lower())]
            for tight in (CLOSE, REACH):  # short notices drown in a long block
                near = [w for w in words if cue.start() - tight <= w[1] <= cue.end() + tight]
                if not near:
                    continue
                block = text[near[0][1] : near[-1][2]]
                held = Counter(w[0] for w in near)
                for gain, name, number, wording in self.ranked(block, min_gain if tight == REACH else min_gain / 2):
                    absent = sum((Counter(wording) - held).values())
                    if absent > max_different * len(wording):
                        continue
                    hit = differences(wording, near, max_different)
                    if hit and hit[0] <= cue.start() < hit[1]:
                        start, end, missing, extra = hit
                        found.setdefault(
                            (start, end),
                            {
                                "start": start,
                                "end": end,
                                "license": name,
                                "template": number,
                                "gain": gain,
                                "missing": missing,
                                "extra": extra,
                            },
                        )
                        break
        kept: list[dict] = []
        for notice in sorted(found.values(), key=lambda x: (x["start"] - x["end"], x["start"])):
            if all(notice["end"] <= k["start"] or notice["start"] >= k["end"] for k in kept):
                kept.append(notice)
        return sorted(kept, key=lambda x: x["start"])


def differences(wording: list[str], words: list[tuple[str, int, int]], max_different: float):
    """Span of the wording among ``words`` with missing and extra words, or None.

    Words before the first and after the last common one are not part of the
    notice.
    """
    matcher = SequenceMatcher(None, [w[0] for w in words], wording, autojunk=False)
    # Anchor at the longest common run and stay within the wording's length.
    anchor = matcher.find_longest_match()
    if not anchor.size:
        return None
    slack = 2 + len(wording) // 4
    first = max(0, anchor.a - anchor.b - slack)
    last = min(len(words), anchor.a - anchor.b + len(wording) + slack)
    words = words[first:last]
    matcher = SequenceMatcher(None, [w[0] for w in words], wording, autojunk=False)
    common = [m for m in matcher.get_matching_blocks() if m.size]
    start, end = common[0].a, common[-1].a + common[-1].size
    extra = [w[0] for w in words[start:end]]
    missing = list(wording)
    for m in reversed(common):
        del missing[m.b : m.b + m.size]
        del extra[m.a - start : m.a - start + m.size]
    if len(missing) + len(extra) > max_different * len(wording) or any(map(_telling, missing + extra)):
        return None
    return words[start][1], words[end - 1][2], missing, extra


def find_licenses(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    templates: Mapping[str, list[str]] | None = None,
    min_gain: float = MIN_GAIN,
    max_different: float = MAX_DIFFERENT,
) -> DataFrame:
    """One row per notice: id, code-point span, licence, template, gain, differing words."""
    templates = dict(templates or TEMPLATES)
    id_type = docs.schema[id_col].dataType.simpleString()

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(templates)
        for batch in batches:
            ids, found = [], []
            for row, text in enumerate(batch.column(1).to_pylist()):
                notices = scanner.notices(text, min_gain, max_different)
                found += notices
                ids += [row] * len(notices)
            schema = pa.schema(
                [
                    ("start", pa.int32()),
                    ("end", pa.int32()),
                    ("license", pa.string()),
                    ("template", pa.int32()),
                    ("gain", pa.float64()),
                    ("missing", pa.list_(pa.string())),
                    ("extra", pa.list_(pa.string())),
                ]
            )
            out = pa.RecordBatch.from_pylist(found, schema=schema)
            taken = batch.column(0).take(pa.array(ids, pa.int32()))
            yield pa.RecordBatch.from_arrays([taken, *out.columns], names=["id", *schema.names])

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    found = rows.filter(F.col("text").rlike(CUE)).mapInArrow(scan, f"id {id_type}, {FOUND}")
    return found.withColumnRenamed("id", id_col)
