"""Sentence rules against a plain Python reading of the same rules."""

import random
import re

from quarry.llm import licenses as L

KNOWN = L.known_sentences()


def brute(text):
    parts = [p for p in (L.normal_form(x) for x in re.split(r"(?<=[.!?;:])[\x20\x09-\x0D]+|\n", text or "")) if p]
    ids, i = [], 0
    while i < len(parts):
        for k in range(min(L.JOINED, len(parts) - i), 0, -1):
            hit = KNOWN.get(" ".join(parts[i:i + k]))
            if hit:
                ids.append(hit)
                i += k
                break
        else:
            i += 1

    def follows(rule):
        it = iter(ids)
        return all(s in it for s in rule.sentences)

    names = {r.licence for r in L.RULES if follows(r) and not any(
        set(r.sentences) < set(o.sentences) and follows(o) for o in L.RULES)}
    names = names - {"Proprietary"} or names
    return len(ids), ",".join(ids), ",".join(sorted(names))


def test_every_known_sentence_has_an_anchor():
    assert all(any(a in k for a in L.ANCHORS) for k in KNOWN)
    assert not any(set("|\n,") & set(k + v) for k, v in KNOWN.items())


def test_texts(spark):
    rng = random.Random(9)
    wrap = lambda s: "\n".join(s[i:i + 60] if False else s for i in [0])
    mit = " ".join(L.SENTENCES[k][0] for k in ("mit-grant", "mit-notice", "as-is-software"))
    bsd3 = "\n".join(L.SENTENCES[k][0] for k in ("bsd-grant", "bsd-source", "bsd-binary", "bsd-endorse"))
    texts = ["Released under the MIT License.", "x y.\nLicensed under CC BY-NC 4.0.", mit, bsd3, wrap(bsd3.rsplit("\n", 1)[0]),
             "This work is licensed under the GNU General Public License, version 3.\nEnd.",
             "Licensed under the Apache License, Version 2.0. More text.", "Licensed under\nthe MIT License.",
             "The license of this is unclear. Licensed under nothing.", None, "", "ALL RIGHTS   RESERVED.",
             "Released into the public\tdomain.", "é " * 50_000 + "\nReleased under the MIT License.", "mit"]
    pieces = [s for f in L.SENTENCES.values() for s in f] + ["Foo bar.", "Licensed under the", "MIT License.", "Released"]
    texts += ["".join(rng.choice(pieces) + rng.choice([" ", "\n", "  "]) for _ in range(rng.randint(1, 8))) for _ in range(80)]
    rows = [(i if i != 3 else None, t, "q") for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string, licences string")
    out = L.scan_licences(df)
    assert not re.search("Python|Arrow", out._jdf.queryExecution().executedPlan().toString())
    got = {r.doc_id: (r.n_sentences, r.sentence_ids, r.licences) for r in out.collect()}
    assert got == {i: brute(t) for i, t, _ in rows}
    assert got[0][2] == "MIT" and got[1][2] == "CC-BY-NC-4.0" and got[2][2] == "MIT" and got[None][2] == "BSD-3-Clause"
    assert got[5][2] == "GPL-3.0" and got[6][2] == "Apache-2.0" and got[7][2] == "MIT"
    assert L.scan_licences(df.limit(0)).count() == 0


def test_every_sentence_wrapped_at_any_width(spark):
    """Wrapped at 40 to 80 columns, as plain lines and as comment lines, every
    sentence is found once."""
    import textwrap

    rows, want = [], {}
    for name, forms in L.SENTENCES.items():
        for form in forms:
            for width in range(40, 81, 4):
                for lead in ("", " * ", "# "):
                    text = "Foo bar.\n" + "\n".join(lead + x for x in textwrap.wrap(form, width)) + "\n\nEnd."
                    want[len(rows)] = name
                    rows.append((len(rows), text))
    out = L.scan_licences(spark.createDataFrame(rows, "doc_id long, text string"))
    assert {r.doc_id: r.sentence_ids for r in out.collect()} == want
    mit = "\n".join("\n".join(textwrap.wrap(L.SENTENCES[k][0], 60)) for k in ("mit-grant", "mit-notice", "as-is-software"))
    assert L.scan_licences(spark.createDataFrame([(1, mit)], "doc_id long, text string")).first().licences == "MIT"


def test_variable_parts_and_full_texts(spark):
    import textwrap

    bsd2 = "\n".join(L.SENTENCES[k][0] for k in ("bsd-grant", "bsd-source", "bsd-binary"))
    may = "may be used to endorse or promote products derived from this software without specific prior written permission."
    ends = [f"   * Neither the name of {org} nor the names of its contributors {may}" for org in (
        "Google Inc.", "the <organization>", "the University of California, Berkeley", "Foo & Sons Ltd. (Bar)", "x")]
    ends += [f"3. The name of the author {may.replace('may be', 'may not be')}", f"- Neither the name of Foo {may}"]
    ends = [e.replace("3. ", "3.\n").replace("- ", "- ") for e in ends]
    texts = [(bsd2 + "\n" + "\n".join(textwrap.wrap(e.strip(" *"), w)), "BSD-3-Clause") for e in ends for w in (40, 60, 200)]
    gpl = ("{} is free software: you can redistribute it and/or modify it under the terms of the GNU {}General Public License "
           "as published by the Free Software Foundation, either version {} of the License, or (at your option) any later "
           "version. {} is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied "
           "warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.")
    for who in ("This program", "This library", "GNU Emacs", "Foo"):
        for kind, v, name in (("", 3, "GPL-3.0"), ("", 2, "GPL-2.0"), ("Lesser ", 3, "LGPL-3.0"), ("Lesser ", 2.1, "LGPL-2.1"),
                              ("Affero ", 3, "AGPL-3.0")):
            texts.append(("\n".join(textwrap.wrap(gpl.format(who, kind, v, who), 66)), name))
    texts += [("Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use these files except in\n"
               "compliance with the License.", "Apache-2.0"), ("Neither the name of it nor that.\nNo licence.", ""),
              ("Neither the name of " + "a " * 13 + f"nor the names of its contributors {may}", "")]
    for title, version, name in (("Apache License", "Version 2.0, January 2004", "Apache-2.0"),
                                 ("GNU GENERAL PUBLIC LICENSE", "Version 2, June 1991", "GPL-2.0"),
                                 ("GNU GENERAL PUBLIC LICENSE", "Version 3, 29 June 2007", "GPL-3.0"),
                                 ("GNU LESSER GENERAL PUBLIC LICENSE", "Version 2.1, February 1999", "LGPL-2.1"),
                                 ("GNU LESSER GENERAL PUBLIC LICENSE", "Version 3, 29 June 2007", "LGPL-3.0"),
                                 ("GNU AFFERO GENERAL PUBLIC LICENSE", "Version 3, 19 November 2007", "AGPL-3.0"),
                                 ("Mozilla Public License Version 2.0", "====", "MPL-2.0")):
        texts.append((f"   {title}\n      {version}\n\nText follows.", name))
    df = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(texts)], "doc_id long, text string")
    got = {r.doc_id: r.licences for r in L.scan_licences(df).collect()}
    assert got == {i: n for i, (_, n) in enumerate(texts)}


def test_a_long_sequence_of_sentences(spark):
    """100,000 known sentences in one text: no recursion over the sequence."""
    grant = L.SENTENCES["mit-grant"][0]
    text = grant + "\n" + "All rights reserved.\n" * 100_000
    out = L.scan_licences(spark.createDataFrame([(1, text), (2, text + L.SENTENCES["mit-notice"][0] + "\n" + L.SENTENCES["as-is-software"][0])],
                                                "doc_id long, text string"))
    got = {r.doc_id: (r.n_sentences, r.licences) for r in out.collect()}
    assert got == {1: (100_001, "Proprietary"), 2: (100_003, "MIT")}


def test_list_marks_and_reserved_rights(spark):
    parts = [L.SENTENCES[k][0] for k in ("bsd-grant", "bsd-source", "bsd-binary", "bsd-endorse")]
    rights = "Copyright (c) 2020, A. Body\nAll rights reserved.\n\n"
    texts = [rights + parts[0] + "\n" + "\n".join(f"{a}{n}{b} {x}" for n, x in zip("123" if a != "x" else "abc", parts[1:k]))
             for a, b in (("(", ")"), ("", ")"), ("  ", "."), (" * (", ")")) for k in (3, 4)]
    texts += [rights + parts[0] + " (i) " + parts[1] + " and (ii) " + parts[2], rights]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = [r.licences for r in L.scan_licences(df).orderBy("doc_id").collect()]
    assert got == ["BSD-2-Clause", "BSD-3-Clause"] * 4 + ["BSD-2-Clause", "Proprietary"]


def test_spdx_expressions(spark):
    cases = {
        "// SPDX-License-Identifier: MIT": "MIT", "SPDX-License-Identifier: MIT OR Apache-2.0": "Apache-2.0,MIT",
        "/* SPDX-License-Identifier: GPL-2.0-or-later */": "GPL-2.0", "# SPDX-License-Identifier: GPL-2.0-only": "GPL-2.0",
        "SPDX-License-Identifier: (LGPL-2.1-or-later OR BSD-3-Clause) AND MIT": "BSD-3-Clause,LGPL-2.1,MIT",
        "* SPDX-License-Identifier: GPL-2.0-only WITH Classpath-exception-2.0": "GPL-2.0", "spdx-license-identifier: BSL-1.0": "BSL-1.0",
        "<!-- SPDX-License-Identifier: AGPL-3.0+ -->": "AGPL-3.0", "SPDX-License-Identifier:": "",
        "x\nSPDX-License-Identifier: ISC\nint main;\n// SPDX-License-Identifier: Zlib": "ISC,Zlib",
    }
    df = spark.createDataFrame(list(enumerate(cases)), "doc_id long, text string")
    got = [r.licences for r in L.scan_licences(df).orderBy("doc_id").collect()]
    assert got == list(cases.values())
