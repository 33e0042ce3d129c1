"""Licence scan by sentence rules.

A text is cut into fragments at sentence ends and line ends. One pattern, a
tree of the words of all known licence sentences beside those with variable
parts (a name, an organisation), is matched from fragment start to end over any number of neighbouring fragments (a sentence
wrapped over lines); the longest hit at a place wins.
The document becomes a sequence of sentence identifiers, and ordered rules over
such sequences name the licences: every identifier of the rule, in order, with
other licence sentences allowed between.

DataFrame functions only, row by row, no shuffle. A text without any word that
all known sentences share a choice of (``ANCHORS``) cannot hold one and is not
cut up; that test is exact.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import text_or_empty

# Sentences of public licences and notices, identifier first.
SENTENCES: dict[str, tuple[str, ...]] = {
    "mit-grant": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the \"Software\"), to deal in the Software without restriction, including without "
        "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the "
        "Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:",),
    "mit-notice": (
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions "
        "of the Software.",),
    "as-is-software": (
        "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED "
        "TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT.",),
    "isc-grant": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies.",),
    "bsd-grant": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
        "the following conditions are met:",),
    "bsd-source": (
        "Redistributions of source code must retain the above copyright notice, this list of conditions and the "
        "following disclaimer.",),
    "bsd-binary": (
        "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the "
        "following disclaimer in the documentation and/or other materials provided with the distribution.",),
    "bsd-endorse": (
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote "
        "products derived from this software without specific prior written permission.",),
    "apache-grant": (
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance "
        "with the License.",),
    "apache-copy": ("You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
                    "You may obtain a copy of the License at"),
    "gpl-redistribute": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
        "option) any later version.",),
    "gpl2-redistribute": (
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation; either version 2 of the License, or (at your "
        "option) any later version.",),
    "gpl-nowarranty": (
        "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the "
        "implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.",),
    "mpl-notice": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",),
    "unlicense": ("This is free and unencumbered software released into the public domain.",),
    "public-domain": ("This work is in the public domain.", "Released into the public domain."),
    "all-rights": ("All rights reserved.",),
    "lgpl21-redistribute": (
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser "
        "General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at "
        "your option) any later version.",),
    "lgpl-redistribute": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser "
        "General Public License as published by the Free Software Foundation, either version 3 of the License, or (at "
        "your option) any later version.",),
    "agpl-redistribute": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero "
        "General Public License as published by the Free Software Foundation, either version 3 of the License, or (at "
        "your option) any later version.",),
    # opening lines of the full texts
    "apache-text": ("Apache License Version 2.0, January 2004",),
    "gpl-text": ("GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007",),
    "gpl2-text": ("GNU GENERAL PUBLIC LICENSE Version 2, June 1991",),
    "lgpl-text": ("GNU LESSER GENERAL PUBLIC LICENSE Version 3, 29 June 2007",),
    "lgpl21-text": ("GNU LESSER GENERAL PUBLIC LICENSE Version 2.1, February 1999",),
    "agpl-text": ("GNU AFFERO GENERAL PUBLIC LICENSE Version 3, 19 November 2007",),
    "mpl-text": ("Mozilla Public License Version 2.0",),
}

# Sentences with variable parts: {first} is a name of one or two words that
# opens the sentence, {words} one to twelve words within it.
VARIABLE: dict[str, tuple[str, ...]] = {
    "bsd-endorse": (
        "Neither the name of {words} nor the names of its contributors may be used to endorse or promote products "
        "derived from this software without specific prior written permission.",
        "Neither the names of {words} nor the names of their contributors may be used to endorse or promote products "
        "derived from this software without specific prior written permission.",
        "Neither the name of {words} nor the names of other contributors may be used to endorse or promote products "
        "derived from this software without specific prior written permission.",
        "Neither the name of {words} may be used to endorse or promote products derived from this software without "
        "specific prior written permission.",
        "The name of {words} may not be used to endorse or promote products derived from this software without "
        "specific prior written permission.",
        "The names of {words} may not be used to endorse or promote products derived from this software without "
        "specific prior written permission."),
    "apache-grant": (
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use {words} except in compliance "
        "with the License.",),
    **{i: (f"{{first}} is free software: you can redistribute it and/or modify it under the terms of the GNU {kind}"
           f"General Public License as published by the Free Software Foundation, either version {v} of the License, or "
           "(at your option) any later version.",)
       for i, kind, v in (("gpl-redistribute", "", "3"), ("gpl2-redistribute", "", "2"),
                          ("lgpl-redistribute", "Lesser ", "3"), ("lgpl21-redistribute", "Lesser ", "2.1"),
                          ("agpl-redistribute", "Affero ", "3"))},
    "gpl-nowarranty": (
        "{first} is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied "
        "warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.",),
}

# Licences that short notices name, in the usual spellings: (identifier, names).
NAMES: tuple[tuple[str, tuple[str, ...]], ...] = (
    ("MIT", ("MIT License", "MIT licence", "MIT")),
    ("Apache-2.0", ("Apache License, Version 2.0", "Apache License 2.0", "Apache 2.0 License", "Apache-2.0")),
    ("GPL-2.0", ("GNU General Public License, version 2", "GNU General Public License v2", "GPL-2.0", "GPLv2")),
    ("GPL-3.0", ("GNU General Public License, version 3", "GNU General Public License v3", "GPL-3.0", "GPLv3")),
    ("LGPL-3.0", ("GNU Lesser General Public License, version 3", "LGPL-3.0", "LGPLv3")),
    ("AGPL-3.0", ("GNU Affero General Public License, version 3", "AGPL-3.0", "AGPLv3")),
    ("MPL-2.0", ("Mozilla Public License, version 2.0", "Mozilla Public License 2.0", "MPL-2.0")),
    ("BSD-2-Clause", ("BSD 2-Clause License", "BSD-2-Clause")),
    ("BSD-3-Clause", ("BSD 3-Clause License", "BSD-3-Clause", "New BSD License")),
    ("ISC", ("ISC License", "ISC")),
    ("CC0-1.0", ("CC0 1.0", "CC0-1.0", "Creative Commons Zero")),
) + tuple((f"CC-{c}-{v}", (f"CC {c} {v}", f"CC-{c}-{v}"))
          for c in ("BY", "BY-SA", "BY-NC", "BY-ND", "BY-NC-SA", "BY-NC-ND") for v in ("3.0", "4.0"))

# Frames around a name: {} is the name.
FRAMES = ("Licensed under {}.", "Licensed under the {}.", "Released under {}.", "Released under the {}.",
          "Distributed under the {}.", "This work is licensed under {}.", "This work is licensed under the {}.",
          "This project is licensed under the {}.", "This software is licensed under the {}.",
          "This content is available under {}.", "License: {}.", "SPDX-License-Identifier: {}")


@dataclass(frozen=True)
class LicenceRule:
    licence: str
    sentences: tuple[str, ...]


RULES: tuple[LicenceRule, ...] = (
    LicenceRule("MIT", ("mit-grant", "mit-notice", "as-is-software")),
    LicenceRule("ISC", ("isc-grant",)),
    LicenceRule("BSD-3-Clause", ("bsd-grant", "bsd-source", "bsd-binary", "bsd-endorse")),
    LicenceRule("BSD-2-Clause", ("bsd-grant", "bsd-source", "bsd-binary")),
    LicenceRule("Apache-2.0", ("apache-grant",)),
    LicenceRule("GPL-3.0", ("gpl-redistribute", "gpl-nowarranty")),
    LicenceRule("GPL-2.0", ("gpl2-redistribute", "gpl-nowarranty")),
    LicenceRule("LGPL-2.1", ("lgpl21-redistribute", "gpl-nowarranty")),
    LicenceRule("LGPL-3.0", ("lgpl-redistribute", "gpl-nowarranty")),
    LicenceRule("AGPL-3.0", ("agpl-redistribute", "gpl-nowarranty")),
    LicenceRule("MPL-2.0", ("mpl-notice",)),
    LicenceRule("Apache-2.0", ("apache-text",)),
    LicenceRule("GPL-3.0", ("gpl-text",)),
    LicenceRule("GPL-2.0", ("gpl2-text",)),
    LicenceRule("LGPL-3.0", ("lgpl-text",)),
    LicenceRule("LGPL-2.1", ("lgpl21-text",)),
    LicenceRule("AGPL-3.0", ("agpl-text",)),
    LicenceRule("MPL-2.0", ("mpl-text",)),
    LicenceRule("Unlicense", ("unlicense",)),
    LicenceRule("Public-Domain", ("public-domain",)),
    LicenceRule("Proprietary", ("all-rights",)),
) + tuple(LicenceRule(i, (f"notice:{i}",)) for i, _ in NAMES)

#: Each known sentence holds at least one of these in its normal form.
ANCHORS = ("licen", "permission", "copyright", "warrant", "redistribut", "public domain", "rights reserved",
           "released under", "distributed under", "available under")


def normal_form(text: str) -> str:
    """Lower-case ASCII letters and digits, all else one space."""
    import re

    return re.sub("[^a-z0-9]+", " ", re.sub("[A-Z]", lambda m: m.group().lower(), text)).strip()


def known_sentences() -> dict[str, str]:
    """Normal form -> identifier: the fixed sentences, and every frame around
    every name of a licence."""
    out = {normal_form(s): i for i, forms in SENTENCES.items() for s in forms}
    for i, names in NAMES:
        for frame in FRAMES:
            for name in names:
                out.setdefault(normal_form(frame.format(name)), f"notice:{i}")
    return out


def _normal(text: Column) -> Column:
    lower = F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.trim(F.regexp_replace(lower, "[^a-z0-9]+", " "))


def variable_patterns() -> list[tuple[str, str]]:
    """(pattern up to a fragment end, identifier) of the variable sentences."""
    out = []
    for i, forms in VARIABLE.items():
        for form in forms:
            text = form.replace("{first}", "0first0").replace("{words}", "0words0")
            words = _GAP.join(normal_form(text).split(" ")).replace("0words0", "[a-z0-9]+(?:[ \\n][a-z0-9]+){0,11}?")
            out.append((words.replace(f"0first0{_GAP}", "[a-z0-9]+(?:[ \\n][a-z0-9]+)?[ \\n]") + "(?=\\n)", i))
    return out


_GAP = "[ \\n]"

#: More fragments than this hold no known sentence, as each has a word.
JOINED = max(len(k.split(" ")) for k in known_sentences())


def _tree_pattern(sentences: list[list[str]]) -> str:
    """Pattern of all sentences (lists of words), the longest first, up to a
    fragment end; words are apart by a space or a fragment end."""
    heads: dict[str, list[list[str]]] = {}
    for words in sentences:
        if words:
            heads.setdefault(words[0], []).append(words[1:])
    out = []
    for word, tails in sorted(heads.items()):
        chain = [word]
        while len(tails) == 1 and tails[0]:
            chain.append(tails[0][0])
            tails = [tails[0][1:]]
        more = [t for t in tails if t]
        ends = [_GAP + _tree_pattern(more)] if more else []
        ends += ["(?=\n)"] if len(more) < len(tails) else []
        out.append(_GAP.join(chain) + (ends[0] if len(ends) == 1 else f"(?:{'|'.join(ends)})"))
    return f"(?:{'|'.join(out)})"


def _holds(ids: Column, rule: LicenceRule) -> Column:
    """Whether the rule's sentences stand in ``ids`` in this order, with others
    allowed between: a fold that counts how many have been met (a regular
    expression over a long sequence would recurse once per identifier)."""
    if len(rule.sentences) == 1:
        return F.array_contains(ids, rule.sentences[0])
    wanted = F.array(*[F.lit(s) for s in rule.sentences])
    met = F.aggregate(ids, F.lit(0), lambda n, x: n + (x == F.coalesce(F.get(wanted, n), F.lit(""))).cast("int"))
    return met == len(rule.sentences)


#: Marks of list items before a sentence: (1), 2), a), (iv), also after "and".
_LIST_MARK = (r"(^|\n|[.!?;:,][\x20\x09-\x0D]+)[\x20\x09*#/;%-]*(?:and[\x20\x09-\x0D]+)?"
              r"\(?(?:[0-9]{1,2}|[a-z]|[ivx]{1,4})\)[\x20\x09]+")
_SPDX = r"(?i)SPDX-License-Identifier:[\x20\x09]*([^\r\n]{1,400})"


def _spdx_names(text: Column) -> Column:
    """Licences of SPDX expressions: the operands of OR and AND, without the
    exception after WITH and without -only, -or-later and +."""
    lines = F.regexp_extract_all(text, F.lit(_SPDX), F.lit(1))
    bare = F.transform(lines, lambda x: F.regexp_replace(
        F.regexp_replace(x, r"(?:\*/|-->|[\"'#;]).*$", ""), r"(?i)\bWITH[\x20\x09]+[A-Za-z0-9.+-]+", " "))
    words = F.flatten(F.transform(bare, lambda x: F.regexp_extract_all(x, F.lit(r"[A-Za-z0-9][A-Za-z0-9.+-]*"), F.lit(0))))
    # an expression ends where two operands follow each other; text after it has no operator between
    found = F.filter(words, lambda w: ~F.lower(w).isin("or", "and", "with"))
    plain = F.transform(found, lambda w: F.regexp_replace(w, r"(?:-only|-or-later|\+)$", ""))
    return F.filter(plain, lambda w: w.rlike(r"^[A-Za-z0-9]+(?:[.-][A-Za-z0-9.]+)*$") & w.rlike("[A-Z]"))


def scan_licences(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_sentences (known ones found), sentence_ids (comma-joined, in
    order), licences (sorted, comma-joined), n_licences; one row per input row.

    A rule whose sentences all belong to a longer matching rule (BSD-2 within
    BSD-3) is not reported; Proprietary is reported only where nothing is
    granted. The operands of an SPDX expression are licences too, as written,
    without -only and -or-later. A null or empty text has none; repeated rows
    repeat; a null id stays null; an empty table gives an empty result; other
    columns are not read.
    """
    known = known_sentences()
    # one literal: "form|id" lines -> map; a few thousand fixed entries
    table = F.str_to_map(F.lit("\n".join(f"{k}|{v}" for k, v in known.items())), F.lit("\n"), F.lit("\\|"))
    variable = variable_patterns()
    pattern = "\n(?:" + "|".join([*(v for v, _ in variable), _tree_pattern([k.split(" ") for k in known])]) + ")"
    src = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), text_or_empty(text_col).alias("text"))
    hint = F.lower("text")
    may_hold = F.lit(False)
    for a in ANCHORS:
        # a space of an anchor may be any run of other characters in the text
        may_hold = may_hold | (F.contains(hint, F.lit(a)) if " " not in a
                               else F.regexp_like(hint, F.lit(a.replace(" ", "[^a-z0-9]+"))))
    none = F.array().cast("array<string>")
    # fragments in normal form, each between line feeds
    lower = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    unmarked = F.regexp_replace(lower, _LIST_MARK, "$1")
    cut = F.regexp_replace(unmarked, r"(?<=[.!?;:])[\x20\x09-\x0D]+", "\n")
    cut = F.regexp_replace(F.regexp_replace(cut, r"[^a-z0-9\n]+", " "), r" ?\n[ \n]*", "\n")
    cut = F.concat(F.lit("\n"), F.trim(cut, F.lit(" \n")), F.lit("\n"))
    found = F.when(may_hold, F.regexp_extract_all(cut, F.lit(pattern), F.lit(0)))
    spdx = F.when(F.contains(hint, F.lit("spdx-license-identifier")), _spdx_names(F.col("text")))
    hits = src.select("doc_id", found.alias("hits"), F.coalesce(spdx, none).alias("spdx"))

    def known_id(x: Column) -> Column:
        found = F.element_at(table, F.trim(F.translate(x, "\n", " ")))
        line = F.concat(F.substring(x, F.lit(2), F.length(x)), F.lit("\n"))
        return F.coalesce(found, *[F.when(F.regexp_like(line, F.lit(f"^{v}\n\\z")), F.lit(i)) for v, i in variable])

    ids = hits.select("doc_id", "spdx", F.coalesce(F.transform("hits", known_id), none).alias("ids"))
    granting = [r for r in RULES if r.licence != "Proprietary"]
    named = []
    for r in granting:
        match = _holds(F.col("ids"), r)
        for longer in granting:
            if len(longer.sentences) > len(r.sentences) and set(r.sentences) < set(longer.sentences):
                match = match & ~_holds(F.col("ids"), longer)
        named.append(F.when(match, F.lit(r.licence)))
    granted = F.when(F.size("ids") > 0, F.array_compact(F.array(*named))).otherwise(none)
    # a reservation of all rights says something only where no licence is granted
    kept = [r for r in RULES if r.licence == "Proprietary"]
    kept_rights = F.array_compact(F.array(*[F.when(_holds(F.col("ids"), r), F.lit(r.licence)) for r in kept]))
    found_names = ids.select("doc_id", "ids", F.array_union(granted, F.col("spdx")).alias("granted"))
    names = F.when(F.size("granted") > 0, F.col("granted")).when(F.size("ids") > 0, kept_rights).otherwise(none)
    out = found_names.select("doc_id", F.size("ids").cast("long").alias("n_sentences"),
                             F.array_join("ids", ",").alias("sentence_ids"), F.array_sort(F.array_distinct(names)).alias("names"))
    return out.select("doc_id", "n_sentences", "sentence_ids", F.array_join("names", ",").alias("licences"),
                      F.size("names").cast("long").alias("n_licences"))
