"""License statements in texts, by conditional compression against templates."""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import deque
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from soundgrid.shipping import mapped

# Short public wordings of common licenses, and the words of each that must stand unchanged.
TEMPLATES = {
    "Apache-2.0": ("Licensed under the Apache License, Version 2.0.", "apache 2.0"),
    "Apache-2.0 (header)": ('Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at', "apache 2.0"),
    "BSD-2-Clause": ("Licensed under the BSD 2-Clause License.", "bsd 2-clause"),
    "BSD-3-Clause": ("Licensed under the BSD 3-Clause License.", "bsd 3-clause"),
    "BSD (conditions)": ("Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:", "redistribution source binary permitted"),
    "CC-BY-4.0": ("Licensed under CC BY 4.0.", "cc by 4.0"),
    "CC-BY-NC-4.0": ("Licensed under CC BY-NC 4.0.", "cc by-nc 4.0"),
    "CC-BY-SA-4.0": ("Licensed under CC BY-SA 4.0.", "cc by-sa 4.0"),
    "CC0-1.0": ("To the extent possible under law, the author has waived all copyright and related rights. CC0 1.0.", "waived copyright"),
    "GPL-2.0": ("This work is licensed under the GNU General Public License, version 2.", "gnu general 2"),
    "GPL-3.0": ("This work is licensed under the GNU General Public License, version 3.", "gnu general 3"),
    "LGPL-3.0": ("This work is licensed under the GNU Lesser General Public License, version 3.", "gnu lesser 3"),
    "AGPL-3.0": ("This work is licensed under the GNU Affero General Public License, version 3.", "gnu affero 3"),
    "ISC": ("Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted", "permission fee granted"),
    "MIT": ("Released under the MIT License.", "mit"),
    "MIT (short)": ("Released under MIT.", "under mit"),
    "MIT (permission)": ("Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files", "permission granted free charge"),
    "MPL-2.0": ("This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.", "mozilla 2.0"),
    "All rights reserved": ("All rights reserved.", "all rights reserved"),
    "Unlicense": ("This is free and unencumbered software released into the public domain.", "unencumbered public domain"),
}
_SPDX = "Apache-2.0 BSD-2-Clause BSD-3-Clause CC-BY-4.0 CC-BY-NC-4.0 CC-BY-SA-4.0 CC0-1.0 ISC MIT MPL-2.0 Unlicense".split()
_SPDX += [f"{k}{v}{e}" for k, v in (("GPL", "-2.0"), ("GPL", "-3.0"), ("LGPL", "-3.0"), ("AGPL", "-3.0")) for e in ("", "-only", "-or-later")]
TEMPLATES |= {f"{k} (SPDX)": (f"SPDX-License-Identifier: {k}", f"spdx-license-identifier {k}") for k in _SPDX}
#: The words around one of these are a candidate.
CUES = r"(?i)licen[sc]e|copyright|\(c\)|spdx|all\W+rights|public\W+domain|permission|redistribut|creative\W+commons|\bcc\b|released\W+under"
#: Words that make another license of one, as a word with a digit does: a short template may not differ by them.
TURNS = {"no", "non", "not", "nor", "except", "some", "by", "nc", "nd", "sa", "lesser", "affero"}
_WORD = re.compile(r"[\w.-]*\w")
#: Words after which a block is cut in two that share some words, so that its size is bounded.
_LONG = 1 << 14


def wording(text: str) -> list[str]:
    return _WORD.findall(text.lower())


def alignments(block: list[str], template: list[str], at: int = 0) -> Iterator[tuple[int, int, int]]:
    """For each end in the block after ``at``: fewest words inserted, left out and changed from the template, and the stretch."""
    cost, start = list(range(len(template) + 1)), [at] * (len(template) + 1)
    for j in range(at, len(block)):
        w, over, over_start, c, s = block[j], 0, j, 0, j + 1
        for i, t in enumerate(template, 1):
            left, left_start = c + 1, s
            c, s = over + (t != w), over_start
            over, over_start = cost[i], start[i]
            if over + 1 < c:
                c, s = over + 1, over_start
            if left < c:
                c, s = left, left_start
            cost[i], start[i] = c, s
        yield c, s, j + 1


def differences(block: list[str], template: list[str]) -> tuple[int, int, int]:
    """Fewest inserted, left-out and changed words that turn the template into a stretch of the block, and that stretch."""
    return min([(len(template), 0, 0), *alignments(block, template)], key=lambda a: a[0])


class TemplateScan:
    """Ranks templates by how much each one, as a raw-content dictionary, shortens a block's compressed form."""

    def __init__(self, templates: dict[str, tuple[str, str]], level: int = 19):
        self.templates = {k: wording(t) for k, (t, _) in templates.items()}
        self.must = {k: set(wording(m)) for k, (_, m) in templates.items()}
        parameters = zstandard.ZstdCompressionParameters.from_level(level, window_log=18, write_content_size=False, write_checksum=False, write_dict_id=False)
        self.plain = zstandard.ZstdCompressor(compression_params=parameters).compress
        self.given = {k: zstandard.ZstdCompressor(compression_params=parameters, dict_data=zstandard.ZstdCompressionDict((" " + " ".join(w) + " ").encode(), dict_type=zstandard.DICT_TYPE_RAWCONTENT)).compress for k, w in self.templates.items()}

    def statements(self, block: list[str], k: str, worst: float) -> Iterator[tuple[int, int, int]]:
        """Words that differ and the stretch of each statement of one template, from left to right."""
        template, must = self.templates[k], self.must[k]
        within = int(worst * len(template))
        most = max(1, within) if worst > 0 else 0
        words = set(block)
        if not must <= words or sum(w not in words for w in template) > most:
            return
        known, at = set(template), 0
        while at < len(block):
            best = None
            for n, a, b in alignments(block, template, at):
                if best and b > best[2] + most:
                    break
                if n <= most and (not best or n < best[0]):
                    own = set(block[a:b])
                    if must <= own and (n <= within or not any(w in TURNS or any(map(str.isdigit, w)) for w in own - known)):
                        best = n, a, b
            if not best:
                return
            yield best
            at = best[2]

    def scan(self, block: list[str], worst: float) -> list[tuple[str, int, int, int, int]]:
        """``license, bytes saved, words that differ, first word, end`` of the confirmed statements, most saved first; of those on one stretch the closest.

        Bytes are those of the statement's own words; in more words, a short statement's gain can be lost.
        """
        found = []
        for k in self.templates:
            for n, a, b in self.statements(block, k, worst):
                data = (" " + " ".join(block[a:b]) + " ").encode()
                found.append((k, len(self.plain(data)) - len(self.given[k](data)), n, a, b))
        kept: list[tuple] = []
        reached: list[tuple] = []
        for f in sorted(found, key=lambda f: (f[2] / len(self.templates[f[0]]), -f[1], f[0])):
            i = bisect_left(reached, (f[3], f[4]))
            if (i == len(reached) or f[4] <= reached[i][0]) and (not i or reached[i - 1][1] <= f[3]):
                kept.append(f)
                reached.insert(i, (f[3], f[4]))
        return sorted(kept, key=lambda f: (-f[1], f[0], f[3]))


def blocks(text: str, cue: re.Pattern, reach: int, share: int) -> Iterator[tuple[list[tuple[str, int, bool]], int]]:
    """``(word, line, is a cue)`` of the words within ``reach`` of a cue, and before which word statements of the block begin.

    Stretches that meet are one block; a long one is cut, and what begins in its last ``share`` words is left to the next. Lines don't end a block.
    """
    cues = (m.start() for m in cue.finditer(text))
    mark = next(cues, None)
    before: deque = deque(maxlen=reach)
    block: list[tuple] = []
    line = at = left = 0
    for m in _WORD.finditer(text):
        line += text.count("\n", at, m.start())
        at = m.start()
        hit = mark is not None and m.end() > mark
        while mark is not None and m.end() > mark:
            mark = next(cues, None)
        word = (m.group().lower(), line, hit)
        if hit:
            if not left:
                block += before  # of a block that ended less than ``reach`` words before, the words between
                before.clear()
            left = reach + 1
        if left:
            block.append(word)
            left -= 1
            if len(block) >= _LONG + share:
                yield block, len(block) - share
                block = block[-share:]
        else:
            if block and len(before) == reach:
                yield block, len(block)
                block = []
            elif mark is None:
                break
            before.append(word)
    if block:
        yield block, len(block)


def license_scan(docs: DataFrame, templates: dict[str, tuple[str, str]] = TEMPLATES, worst: float = 0.15, around: int = 48) -> DataFrame:
    """License statements in ``docs(doc_id, text)``: ``doc_id, line, license, bytes_saved, n_differences, wording``.

    Candidate blocks are the ``around`` words around each cue, or as many as the longest template and what may be inserted into it if that is more, on whichever lines (stretches that meet are one block). A block
    is searched for all statements of each template: at most ``worst`` of the template's words may differ, one word in a short
    template (unless it is a number or one of ``TURNS``), and its telling words (names, versions) must all be there. A statement is compressed
    alone and with the template as its raw-content dictionary; statements are ranked by the bytes saved. Of templates
    confirmed on the same words the closest counts. ``line`` is that of the statement's first cue, or else of its first word, and counts
    from 0; ``wording`` is the statement with the words around it. Of an SPDX expression with operators only the first license is found. Null and empty texts and empty tables have no
    statements, repeated rows repeat theirs, other columns aren't read, texts are read whole.
    """
    cue = re.compile(CUES)
    longest = max((len(wording(t)) for t, _ in templates.values()), default=0)
    reach = max(around, longest + int(worst * longest) + 1)
    hit = docs.select("doc_id", "text").filter(F.col("text").rlike(CUES))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scan = TemplateScan(templates)
        share = 2 * max(map(len, scan.templates.values()), default=0) + 2
        for batch in batches:
            at, out = [], []
            for i, text in enumerate(batch.column(1).to_pylist()):
                for block, before in blocks(text, cue, reach, share):
                    words = [w for w, _, _ in block]
                    for k, gain, differ, a, b in scan.scan(words, worst):
                        if a < before:
                            at.append(i)
                            line = next((n for _, n, hit in block[a:b] if hit), block[a][1])
                            out.append((line, k, gain, differ, " ".join(words[max(0, a - around) : b + around])))
            columns = list(zip(*out)) or [()] * 5
            kinds = (pa.int32(), pa.string(), pa.int32(), pa.int32(), pa.string())
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(at, pa.int64())), *(pa.array(c, k) for c, k in zip(columns, kinds))], ["doc_id", "line", "license", "bytes_saved", "n_differences", "wording"])

    return mapped(hit, run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, line int, license string, bytes_saved int, n_differences int, wording string")
