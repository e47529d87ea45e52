"""License texts and notices in documents, by conditional compression.

A candidate block is a run of lines that speak of licenses. It is read in overlapping
pieces: long ones for license texts, and around each word that names are made of short ones
for notices. A piece is compressed by itself and with each template as a zstandard raw
dictionary. A template that saves nothing is out; every one that saves, however little, is
held against the piece word by word. Where several texts claim the same words, the one that
agrees most is reported with the words that differ.

The dictionary of a notice has all forms of the license's name. Both ways of compressing a
short piece begin with one and the same sentence, which both dictionaries have: what a
first match costs is then paid on both sides, so that a match of a few letters shows.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from difflib import SequenceMatcher
from functools import lru_cache

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clientele.llm.arrow import slices

# Public license names and the wording of short license texts.
#: Names under which a notice cites a license.
NAMES: dict[str, tuple[str, ...]] = {
    "Apache-2.0": ("apache license version 2 0", "apache license 2 0", "apache 2 0 license"),
    "MIT": ("mit license", "mit licence"),
    "GPL-2.0": ("gnu general public license version 2", "gnu gpl version 2", "gnu gpl v2", "gpl 2 0"),
    "GPL-3.0": ("gnu general public license version 3", "gnu gpl version 3", "gnu gpl v3", "gpl 3 0"),
    "LGPL-2.1": ("gnu lesser general public license version 2 1", "lgpl 2 1"),
    "LGPL-3.0": ("gnu lesser general public license version 3", "lgpl 3 0"),
    "AGPL-3.0": ("gnu affero general public license version 3", "agpl 3 0"),
    "BSD-2-Clause": ("bsd 2 clause license", "2 clause bsd license", "simplified bsd license"),
    "BSD-3-Clause": ("bsd 3 clause license", "3 clause bsd license", "new bsd license"),
    "MPL-2.0": ("mozilla public license version 2 0", "mozilla public license v 2 0", "mpl 2 0"),
    "EPL-2.0": ("eclipse public license version 2 0", "eclipse public license 2 0", "epl 2 0"),
    "ISC": ("isc license",),
    "Unlicense": ("unlicense",),
    "CC0-1.0": ("cc0 1 0", "creative commons zero v1 0 universal"),
    "CC-BY-4.0": ("cc by 4 0", "creative commons attribution 4 0 international"),
    "CC-BY-SA-4.0": ("cc by sa 4 0", "creative commons attribution sharealike 4 0 international"),
    "CC-BY-NC-4.0": ("cc by nc 4 0", "creative commons attribution noncommercial 4 0 international"),
    "CC-BY-ND-4.0": ("cc by nd 4 0", "creative commons attribution noderivatives 4 0 international"),
    "CC-BY-NC-SA-4.0": ("cc by nc sa 4 0", "creative commons attribution noncommercial sharealike 4 0 international"),
    "CC-BY-NC-ND-4.0": ("cc by nc nd 4 0", "creative commons attribution noncommercial noderivatives 4 0 international"),
}
#: What a notice says before the name.
LEADS = ("licensed under", "released under", "distributed under", "available under", "under the terms of", "covered by", "spdx license identifier")
TEXTS: dict[str, str] = {
    "MIT": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and"
        ' associated documentation files (the "Software"), to deal in the Software without restriction,'
        " including without limitation the rights to use, copy, modify, merge, publish, distribute,"
        " sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is"
        " furnished to do so, subject to the following conditions: The above copyright notice and this"
        " permission notice shall be included in all copies or substantial portions of the Software."
    ),
    "ISC": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without"
        " fee is hereby granted, provided that the above copyright notice and this permission notice appear"
        " in all copies."
    ),
    "Apache-2.0": (
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in'
        " compliance with the License. You may obtain a copy of the License at"
        " http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in"
        ' writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT'
        " WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific"
        " language governing permissions and limitations under the License."
    ),
    "BSD-2-Clause": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted"
        " provided that the following conditions are met: Redistributions of source code must retain the"
        " above copyright notice, this list of conditions and the following disclaimer. Redistributions in"
        " binary form must reproduce the above copyright notice, this list of conditions and the following"
        " disclaimer in the documentation and/or other materials provided with the distribution."
    ),
    "GPL-3.0": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU"
        " General Public License as published by the Free Software Foundation, either version 3 of the"
        " License, or (at your option) any later version."
    ),
    "GPL-2.0": (
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU"
        " General Public License as published by the Free Software Foundation; either version 2 of the"
        " License, or (at your option) any later version."
    ),
    "LGPL-2.1": (
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU"
        " Lesser General Public License as published by the Free Software Foundation; either version 2.1 of"
        " the License, or (at your option) any later version."
    ),
    "LGPL-3.0": (
        "This library is free software: you can redistribute it and/or modify it under the terms of the GNU"
        " Lesser General Public License as published by the Free Software Foundation, either version 3 of"
        " the License, or (at your option) any later version."
    ),
    "AGPL-3.0": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU"
        " Affero General Public License as published by the Free Software Foundation, either version 3 of"
        " the License, or (at your option) any later version."
    ),
    "BSD-3-Clause": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted"
        " provided that the following conditions are met: Redistributions of source code must retain the"
        " above copyright notice, this list of conditions and the following disclaimer. Redistributions in"
        " binary form must reproduce the above copyright notice, this list of conditions and the following"
        " disclaimer in the documentation and/or other materials provided with the distribution. Neither the"
        " name of the copyright holder nor the names of its contributors may be used to endorse or promote"
        " products derived from this software without specific prior written permission."
    ),
    "MPL-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of"
        " the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."
    ),
    "EPL-2.0": (
        "This program and the accompanying materials are made available under the terms of the Eclipse"
        " Public License 2.0 which is available at https://www.eclipse.org/legal/epl-2.0/"
    ),
    "Unlicense": (
        "This is free and unencumbered software released into the public domain. Anyone is free to copy,"
        " modify, publish, use, compile, sell, or distribute this software, either in source code form or as"
        " a compiled binary, for any purpose, commercial or non-commercial, and by any means."
    ),
    "CC0-1.0": (
        "To the extent possible under law, the author has waived all copyright and related or neighboring"
        " rights to this work."
    ),
}
#: Versions of the licenses of one family, and the names of the family.
FAMILIES: dict[tuple[str, ...], tuple[str, ...]] = {
    ("GPL-2.0", "GPL-3.0"): ("gpl", "gnu gpl", "gnu general public license", "gnu general public licence"),
    ("LGPL-2.1", "LGPL-3.0"): ("lgpl", "gnu lgpl", "gnu lesser general public license"),
    ("AGPL-3.0",): ("agpl", "gnu agpl", "gnu affero general public license"),
    ("MPL-2.0",): ("mpl", "mozilla public license"),
    ("EPL-2.0",): ("epl", "eclipse public license"),
    ("Apache-2.0",): ("apache", "apache license", "apache licence"),
}
#: Licenses whose identifier is a word that also stands for other things.
SHORT = {"mit": "MIT", "isc": "ISC"}
#: What may stand between a negation and the name that it denies.
DENIALS = frozenset("not never neither nor".split())
BETWEEN = frozenset(
    "licensed released distributed available under the terms of covered by a an any be been being made is to".split()
)
#: Words that make the wording of one license that of another.
TELLING = {"affero", "lesser", "library"}
#: A part of every name (a test holds all of them against it), and words of the texts.
CUE = (
    r"(?i)licen[cs]|\bhereby granted|redistribut|\bspdx|creative[^a-z0-9]+commons|\bcc[^a-z0-9]*(by|0)\b|free software"
    r"|gpl|(?<![a-z0-9])(([em]pl|apache)[v0-9]*|bsd)(?![a-z0-9])|unencumbered software|waived all copyright|source code form|accompanying materials"
)
_CUE = re.compile(CUE)
_WORD = re.compile(r"[a-z0-9]+")
#: The words of names by which pieces are chosen.
_NAMED = re.compile(r"licen[cs]|gpl|^[em]pl|^apache|^bsd$|^mit$|^isc$|^cc0?$|^commons$")
_SPDX = re.compile(r"(?i)\bspdx[^a-z0-9]+license[^a-z0-9]+identifier[^a-z0-9]*")
_SPDX_PART = re.compile(r"(?i)[\s(]*([a-z0-9.+-]+)(?:[\s)]+(or|and|with)\s)?")


@dataclass(frozen=True)
class Limits:
    """A text agrees if at least ``agreement`` of its words are there in order; a name has to
    be there word for word."""

    agreement: float = 0.9


def plain_words(text: str) -> list[str]:
    return _WORD.findall(text.lower())


@dataclass(frozen=True)
class Template:
    """A license text, or the forms of a license's name."""

    license: str
    kind: str
    words: tuple[str, ...]
    forms: tuple[tuple[str, ...], ...] = ()


def notice_forms(license: str) -> set[tuple[str, ...]]:
    """The word sequences that name a license: its names, its identifier, its version behind
    the names of its family, and a short identifier behind a lead or beside another one."""
    forms = set(NAMES[license])
    for licenses, families in FAMILIES.items():
        if license not in licenses:
            continue
        major, minor = license.rpartition("-")[2].split(".")
        whole = [f"{major} {minor}"] + ([major] if minor == "0" else [])
        for family in families:
            forms |= {f"{family} {said}{v}" for v in whole for said in ("", "v", "v ", "version ")}
            if " " not in family.removeprefix("gnu "):
                forms |= {f"{family}{said}{v}" for v in whole for said in ("", "v")}
    own = plain_words(license)
    if len(own) > 1:
        forms.add(" ".join(own))
    for word in (w for w, x in SHORT.items() if x == license):
        forms |= {f"{lead} {the}{word}" for lead in (*LEADS, "license", "licence") for the in ("", "the ")}
        others = [w for w in ("apache", "bsd", "gpl", "lgpl", "gplv2", "gplv3", "mpl", *SHORT) if w != word]
        forms |= {f"{word} {by} {other}" for by in ("or", "and") for other in others}
        forms |= {f"{end} {by} {word}" for by in ("or", "and") for end in ("2 0", "3 0", "clause", *others)}
    return {tuple(form.split()) for form in forms}


@lru_cache(maxsize=1)
def templates() -> list[Template]:
    """One template for the notices of each license, one for each license text."""
    out = []
    for license in NAMES:
        forms = tuple(sorted(notice_forms(license)))
        out.append(Template(license, "notice", tuple(w for form in forms for w in form), forms))
    return out + [Template(k, "text", tuple(plain_words(t))) for k, t in TEXTS.items()]


#: Words of a piece and from one to the next, so that a text of up to 256 words is in one whole.
TEXT_PIECE, TEXT_STEP = 512, 256
#: Words of a piece that names are looked for in, its steps, and how far from a cue they begin.
NOTICE_PIECE, NOTICE_STEP, NOTICE_REACH = 8, 1, 8
_PREFIX = "what follows here is one window of a text"


class _Compressor:
    def __init__(self, kind: str, dictionary: str):
        self._prefix = f"{_PREFIX} " if kind == "notice" else ""
        said = f" {dictionary} {self._prefix}".encode()
        options = zstandard.ZstdCompressionParameters.from_level(19, min_match=3, write_content_size=False)
        more = {}
        if dictionary or self._prefix:
            more["dict_data"] = zstandard.ZstdCompressionDict(said, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        self._tool = zstandard.ZstdCompressor(compression_params=options, **more)

    def size(self, words: list[str]) -> int:
        return len(self._tool.compress(f"{self._prefix}{' '.join(words)} ".encode()))


@lru_cache(maxsize=1)
def _compressors() -> dict[Template | str, _Compressor]:
    tools: dict[Template | str, _Compressor] = {kind: _Compressor(kind, "") for kind in ("notice", "text")}
    for t in templates():
        said = " ".join(t.words)
        if t.kind == "notice":
            # Shorter forms come last, where a match is cheapest.
            said = " ".join(" ".join(form) for form in sorted(t.forms, key=lambda x: -len(" ".join(x))))
        tools[t] = _Compressor(t.kind, said)
    return tools


def saving(words: list[str], t: Template) -> float:
    """The share of a piece's compressed size that the template saves as a dictionary."""
    tools = _compressors()
    size = tools[t.kind].size(words)
    return (size - tools[t].size(words)) / size


def ranked_templates(words: list[str], kind: str | None = None) -> list[tuple[float, Template]]:
    """The templates that save something on a piece, with the share that they save, best first."""
    found = [(saving(words, t), t) for t in templates() if kind in (None, t.kind)]
    found = [(saved, t) for saved, t in found if saved > 0]
    return sorted(found, key=lambda x: (-x[0], x[1].kind != "text", -len(x[1].words), x[1].license))


def _pieces(n: int, size: int, step: int) -> list[tuple[int, int]]:
    return [(at, min(at + size, n)) for at in range(0, max(n - size + step, 1), step)]


def differences(words: list[str], t: Template) -> tuple[list[str], list[str], float, set[int]]:
    """The template's words that the block lacks, the block's words in between, the share of
    the template's words that the block has in order, and their places in the block."""
    matches = [m for m in SequenceMatcher(None, t.words, words, autojunk=False).get_matching_blocks() if m.size]
    if not matches:
        return list(t.words), [], 0.0, set()
    kept = {i for m in matches for i in range(m.a, m.a + m.size)}
    used = {i for m in matches for i in range(m.b, m.b + m.size)}
    lacking = [w for i, w in enumerate(t.words) if i not in kept]
    between = [words[i] for i in range(matches[0].b, matches[-1].b + matches[-1].size) if i not in used]
    return lacking, between, len(kept) / len(t.words), used


def recognise(text: str, limits: Limits = Limits()) -> list[tuple[Template, float, list[str], list[str]]]:
    """The licenses of a block, each once, with what the template saves and what differs. A name
    that is denied (``not licensed under the ...``) is not reported."""
    words = plain_words(text)
    if not words:
        return []
    out: dict[str, tuple[Template, float, list[str], list[str]]] = {}
    for t, saved, lacking, between in _texts(words, limits):
        out.setdefault(t.license, (t, saved, lacking, between))
    for t, saved in [*_cited(words), *_identified(text)]:
        out.setdefault(t.license, (t, saved, [], []))
    return list(out.values())


def _texts(words: list[str], limits: Limits) -> list[tuple[Template, float, list[str], list[str]]]:
    """The texts that agree, of those that save something on a piece. Of those that claim the
    same words, the one with the most words in place over those that differ."""
    found = []
    for begin, end in _pieces(len(words), TEXT_PIECE, TEXT_STEP):
        piece = words[begin:end]
        has = Counter(piece)
        # No more words can be there in order than are there at all.
        likely = [
            t for t in templates()
            if t.kind == "text" and (Counter(t.words) & has).total() >= limits.agreement * len(t.words)
        ]
        for t in likely:
            saved = saving(piece, t)
            if saved <= 0:
                continue
            lacking, between, share, used = differences(piece, t)
            if share < limits.agreement or any(w.isdigit() for w in lacking) or TELLING & set(between):
                continue
            used = {begin + i for i in used}
            found.append((len(used) - len(lacking) - len(between), len(found), t, saved, lacking, between, used))
    out, taken = [], set()
    for *_, t, saved, lacking, between, used in sorted(found, key=lambda x: (-x[0], x[1])):
        if 2 * len(used & taken) <= len(used):
            out.append((t, saved, lacking, between))
            taken |= used
    return out


@lru_cache(maxsize=1)
def _by_first_word() -> dict[str, list[tuple[tuple[str, ...], Template]]]:
    out: dict[str, list[tuple[tuple[str, ...], Template]]] = {}
    for t in templates():
        for form in t.forms:
            out.setdefault(form[0], []).append((form, t))
    return out


def _cited(words: list[str]) -> list[tuple[Template, float]]:
    """The names that stand in a piece on which their template saves something, in a notice,
    heading or sentence; a name inside a longer one is not meant."""
    n = len(words)
    pieces: set[tuple[int, int]] = set()
    for cue in _cue_places(words):
        # Each name has a cue, and lies whole in several of the pieces around it.
        for at in range(max(0, cue - NOTICE_REACH), min(cue + 1, n), NOTICE_STEP):
            pieces.add((at, min(at + NOTICE_PIECE, n)))
    found: dict[tuple[int, int, Template], float] = {}
    for begin, end in sorted(pieces):
        piece = words[begin:end]
        for saved, t in ranked_templates(piece, "notice"):
            for i, word in enumerate(piece):
                for form, own in _by_first_word().get(word, ()):
                    if own is t and tuple(piece[i : i + len(form)]) == form:
                        place = begin + i, begin + i + len(form), t
                        found[place] = max(saved, found.get(place, 0.0))
    out: dict[Template, float] = {}
    for (i, j, t), saved in found.items():
        longer = any(a <= i and j <= b and b - a > j - i for a, b, _ in found)
        if not longer and not _denied(words, i):
            out[t] = max(saved, out.get(t, 0.0))
    return list(out.items())


def _cue_places(words: list[str]) -> list[int]:
    """The words with a part of a name."""
    return [i for i, word in enumerate(words) if _NAMED.search(word)]


def _denied(words: list[str], at: int) -> bool:
    """Whether a negation stands before the place, with nothing but a lead in between."""
    while at > 0 and words[at - 1] in BETWEEN:
        at -= 1
    return at > 0 and words[at - 1] in DENIALS


def _identified(text: str) -> list[tuple[Template, float]]:
    """The licenses of the expressions that follow an SPDX lead."""
    out = []
    for lead in _SPDX.finditer(text):
        at = lead.end()
        while part := _SPDX_PART.match(text, at):
            own = plain_words(part[1])
            for t in templates():
                name = plain_words(t.license)
                if t.forms and own[: len(name)] == name and own[len(name) :] in ([], ["only"], ["or", "later"]):
                    # The lead says that it is an identifier; what it saves is only told.
                    out.append((t, max(0.0, saving(plain_words(lead[0]) + own, t))))
            if not part[2]:
                break
            at = part.end()
    return out


def blocks(text: str) -> list[tuple[int, int]]:
    """First and last line (from 0) of the runs of lines that speak of licenses. Lines in
    between belong to a run if most of their words are a template's."""
    lines = text.split("\n")
    known = _known_words()
    marks = []
    for line in lines:
        words = plain_words(line)
        alike = len(words) > 1 and sum(w in known for w in words) >= 0.8 * len(words)
        marks.append(2 if _CUE.search(line) else 1 if alike else 0)
    out, at = [], 0
    while at < len(lines):
        if not marks[at]:
            at += 1
            continue
        end = at
        while end + 1 < len(lines) and marks[end + 1]:
            end += 1
        if 2 in marks[at : end + 1]:
            out.append((at, end))
        at = end + 1
    return out


@lru_cache(maxsize=1)
def _known_words() -> frozenset[str]:
    return frozenset(w for t in templates() if t.kind == "text" for w in t.words)


_FOUND = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("first_line", pa.int64()),
        ("last_line", pa.int64()),
        ("license", pa.string()),
        ("kind", pa.string()),
        ("saved", pa.float64()),
        ("lacking", pa.string()),
        ("extra", pa.string()),
    ]
)


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", limits: Limits = Limits()) -> DataFrame:
    """One row for each license of each block: ``doc_id, first_line, last_line, license, kind,
    saved, lacking, extra``; the last two are the words that differ.

    Null and empty texts have no blocks; a null id stays null; repeated rows are reported
    each; other columns are not looked at; an empty table gives no rows.
    """

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            rows = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                lines = text.split("\n")
                for first, last in blocks(text):
                    for t, saved, lacking, extra in recognise("\n".join(lines[first : last + 1]), limits):
                        rows.append((doc_id, first, last, t.license, t.kind, round(saved, 6), " ".join(lacking), " ".join(extra)))
            columns = list(zip(*rows)) or [()] * len(_FOUND)
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _FOUND)], schema=_FOUND)

    chosen = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    # Most documents do not speak of licenses and never leave the JVM.
    return chosen.where(F.col("text").rlike(CUE)).mapInArrow(
        search,
        "doc_id bigint, first_line bigint, last_line bigint, license string, kind string, saved double,"
        " lacking string, extra string",
    )
