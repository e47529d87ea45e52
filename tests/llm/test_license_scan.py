import random

import pytest
from pyspark.sql import functions as F

from clientele.llm import license_scan
from clientele.llm.license_scan import LEADS, NAMES, TEXTS, blocks, plain_words, ranked_templates, recognise, scan
from tests.llm.data import CLASHES, awkward, nothing

PROSE = "Thonsh ores to a of edat and herein scum onea a to the tionst of it. "


@pytest.mark.parametrize(
    "said, license",
    [
        ("This work is licensed under the GNU General Public License, version 3.", "GPL-3.0"),
        ("Licensed under CC BY-NC 4.0.", "CC-BY-NC-4.0"),
        ("Licensed under CC BY-NC-SA 4.0.", "CC-BY-NC-SA-4.0"),
        ("Released under the MIT License.", "MIT"),
        ("Licensed under the Apache License, Version 2.0.", "Apache-2.0"),
        ("SPDX-License-Identifier: LGPL-2.1", "LGPL-2.1"),
    ],
)
def test_notices(said, license):
    for text in (said, PROSE * 3 + said + " " + PROSE * 3, PROSE * 20 + said):
        assert [(t.license, t.kind) for t, *_ in recognise(text)] == [(license, "notice")]


@pytest.mark.parametrize("license", sorted(TEXTS))
def test_texts_with_and_without_changes(license):
    (t, saved, lacking, extra), *_ = [x for x in recognise(TEXTS[license]) if x[0].kind == "text"]
    assert (t.license, lacking, extra) == (license, [], []) and saved > 0.5
    changed = TEXTS[license].replace(" the ", " this ", 1)
    (t, _, lacking, extra), *_ = [x for x in recognise(changed) if x[0].kind == "text"]
    assert (t.license, lacking, extra) == (license, ["the"], ["this"])


def test_versions_are_told_apart():
    assert ranked_templates(plain_words(TEXTS["GPL-2.0"]))[0][1].license == "GPL-2.0"
    assert {t.license for t, *_ in recognise(TEXTS["GPL-2.0"])} == {"GPL-2.0"}
    assert {t.license for t, *_ in recognise("licensed under the GNU GPL version 2 or the MIT License")} == {"GPL-2.0", "MIT"}


@pytest.mark.parametrize("text", ["", "The driver must hold a license.", "A license to kill under the terms of trade.", PROSE])
def test_no_license(text):
    assert recognise(text) == []


def test_every_name_is_recognised():
    for license, names in NAMES.items():
        for name in names:
            assert license in {t.license for t, *_ in recognise(f"Licensed under the {name}.")}, name


def test_blocks_join_lines_of_one_text():
    words = TEXTS["MIT"].split(" ")
    lines = ["Intro."] + [" ".join(words[i : i + 12]) for i in range(0, len(words), 12)] + ["", "Outro.", "Licensed under the MIT License."]
    assert blocks("\n".join(lines)) == [(1, len(lines) - 4), (len(lines) - 1, len(lines) - 1)]


def test_documents(spark):
    rows = [(1, f"{PROSE}\nReleased under the MIT License.\n{PROSE}"), (1, "Released under the MIT License."), (None, "Licensed under CC BY 4.0"), (2, None), (3, ""), (4, PROSE * 5000 + "\n" + TEXTS["ISC"])]
    docs = spark.createDataFrame([(*r, *["x"] * len(CLASHES)) for r in rows], "doc_id bigint, text string, " + ", ".join(f"{c} string" for c in CLASHES))
    found = {(r["doc_id"], r["first_line"], r["last_line"], r["license"], r["kind"]) for r in scan(docs).collect()}
    assert found == {(1, 1, 1, "MIT", "notice"), (1, 0, 0, "MIT", "notice"), (None, 0, 0, "CC-BY-4.0", "notice"), (4, 1, 1, "ISC", "text")}
    assert scan(awkward(spark)).collect() == [] and scan(nothing(spark)).collect() == []


def test_every_name_passes_the_cue_behind_every_lead(spark):
    said = [(license, name, lead) for license, names in NAMES.items() for name in names for lead in ("", "uses the ", *(f"{x} the " for x in LEADS))]
    said += [(license, license, "SPDX-License-Identifier: ") for license in NAMES]
    docs = spark.createDataFrame([(i, f"{PROSE}\n{lead}{name}.\n{PROSE}") for i, (_, name, lead) in enumerate(said)], "doc_id bigint, text string")
    found = {(r["doc_id"], r["license"]) for r in scan(docs).collect()}
    assert found == {(i, license) for i, (license, _, _) in enumerate(said)}


@pytest.mark.parametrize(
    "said, licenses",
    [
        ("Released under the GNU GPL v3.", {"GPL-3.0"}),
        ("Distributed under\nMPL 2.0", {"MPL-2.0"}),
        ("# MIT License", {"MIT"}),
        ("SPDX-License-Identifier: (MIT OR Apache-2.0) AND GPL-2.0-or-later", {"MIT", "Apache-2.0", "GPL-2.0"}),
        ("SPDX-License-Identifier: Zlib\nMIT staff", set()),
        ("; ".join(n[0] for n in NAMES.values()), set(NAMES)),
    ],
)
def test_notices_pass_the_cue(said, licenses):
    found = [x for first, last in blocks(said) for x in recognise("\n".join(said.split("\n")[first : last + 1]))]
    assert {t.license for t, *_ in found} == licenses


@pytest.mark.parametrize("license", sorted(TEXTS))
def test_texts_are_not_taken_for_others(license):
    for text in (TEXTS[license], TEXTS[license].replace(" the ", " this ", 1), PROSE * 60 + TEXTS[license]):
        assert {t.license for t, *_ in recognise(text)} == {license}


def test_all_texts_of_a_long_block():
    found = {t.license for t, *_ in recognise("\n".join(t for k, t in TEXTS.items() if k != "BSD-2-Clause"))}
    assert found >= set(TEXTS) - {"BSD-2-Clause"}


@pytest.mark.parametrize(
    "said, licenses",
    [
        ("licensed under Apache-2.0", {"Apache-2.0"}),
        ("License: MIT", {"MIT"}),
        ("GNU GPLv3", {"GPL-3.0"}),
        ("GPLv2 or later", {"GPL-2.0"}),
        ("BSD-3-Clause", {"BSD-3-Clause"}),
        ("MIT or Apache 2.0", {"MIT", "Apache-2.0"}),
        ("Licensed under the LGPL, version 2.1", {"LGPL-2.1"}),
        ("GPL-3.0, the AGPL v3 or MPL version 2", {"GPL-3.0", "AGPL-3.0", "MPL-2.0"}),
        ("This is not licensed under the MIT License.", set()),
        ("It was never released under the terms of the GNU GPL v2.", set()),
        ("This is not mine. It is under the MIT License.", {"MIT"}),
        ("mit dem Auto, the ISC and an apache helicopter", set()),
    ],
)
def test_short_forms_and_denials(spark, said, licenses):
    docs = [(0, said), (1, f"{PROSE}\n{PROSE * 2}{said} {PROSE}"), (2, PROSE * 3000 + said + " " + PROSE * 3000)]
    found = {(r["doc_id"], r["license"]) for r in scan(spark.createDataFrame(docs, "doc_id bigint, text string")).collect()}
    assert found == {(i, x) for i in range(3) for x in licenses}


def brute(text):
    """Every form of every name at every place, and every text against the whole block."""
    words, found = plain_words(text), []
    for t in license_scan.templates():
        for form in t.forms:
            found += [(i, i + len(form), t.license) for i in range(len(words)) if tuple(words[i : i + len(form)]) == form]
    names = {
        x for i, j, x in found
        if not license_scan._denied(words, i)
        and not any(a <= i and j <= b and b - a > j - i for a, b, _ in found)
    }
    texts = {}
    for t in license_scan.templates():
        if t.kind == "text":
            lacking, between, share, used = license_scan.differences(words, t)
            if share >= 0.9 and not any(w.isdigit() for w in lacking) and not license_scan.TELLING & set(between):
                texts[t.license] = len(used) - len(lacking) - len(between)
    return names, max(texts, key=texts.get) if texts else None


def test_compression_loses_nothing_that_is_there(spark):
    """On made-up blocks and on the notices of the documents."""
    rng = random.Random(4)
    every = [" ".join(form) for t in license_scan.templates() for form in t.forms]
    blocks_ = []
    for name in every:
        pad = [" ".join(rng.choices(PROSE.split(), k=rng.randrange(14))) for _ in range(2)]
        blocks_.append(f"{pad[0]} {name}, {pad[1]}")
    blocks_ += [f"{PROSE}{text.replace(' and ', ' or ', k)}{PROSE}" for text in TEXTS.values() for k in range(3)]
    for row in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").where(spark_cue()).collect():
        lines = row["text"].split("\n")
        blocks_ += ["\n".join(lines[a : b + 1]) for a, b in blocks(row["text"])]
    assert len(blocks_) > 400
    missed = []
    for text in blocks_:
        found = {t.license: t.kind for t, *_ in recognise(text)}
        names, best = brute(text)
        if not names | ({best} - {None}) <= set(found) or {x for x, kind in found.items() if kind == "notice"} - names - spdx(text):
            missed.append((text, names, best, found))
    assert missed == []


def spdx(text):
    return {t.license for t, _ in license_scan._identified(text)}


def spark_cue():
    return F.col("text").rlike(license_scan.CUE)


def test_the_ranking_decides(monkeypatch):
    said = "Licensed under the MIT License. " + TEXTS["ISC"]
    assert {t.license for t, *_ in recognise(said)} == {"MIT", "ISC"}
    monkeypatch.setattr(license_scan, "saving", lambda words, t: 0.0)
    assert recognise(said) == []


def test_a_template_saves_on_its_own_wording():
    for license in TEXTS:
        ranked = ranked_templates(plain_words(TEXTS[license]), "text")
        # A longer text with the same wording may save a little more.
        assert {t.license: saved for saved, t in ranked[:2]}[license] > 0.5
