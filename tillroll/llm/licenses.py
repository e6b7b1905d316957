"""License detection by ordered signature rules, in DataFrame functions only.

A rule is a regular expression over a text's words (lower-cased ASCII, single
blanks between; a comma before the blank where the text has a list separator, a
line break or the end of a sentence), a keyword it cannot match without, a label, a
priority and a confidence. Signatures are written sentences of licenses, headers and
tags, and the licenses' names in the forms in which they are spoken of. Texts
without any word of the gate are passed over after one search; of the others, only
rules whose keyword stands in the text run their expression.

Overlapping detections are resolved in order of priority, and only detections that
stay suppress others. A detection has the priority of the best one that it contains
(so a container goes before what it contains, whatever their own numbers), then the
longer goes first, then the smaller own number, then the earlier. One that overlaps a
staying one goes; what only a suppressed one contained or touched stays.

Base phrases are found on their own and are never suppressed.

Edge cases: null and empty texts have no words and no labels; words are runs of
characters other than ASCII signs, controls and blanks; very long texts are scanned
whole, their detections resolved by runs that overlap; repeated rows are each
scanned; extra columns are ignored, whatever their names; no rows: no rows.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillroll.llm.common import texts

BASE = {  # phrase: label
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}
SIGNS = r"\x00-\x2F\x3A-\x60\x7B-\x7F"
NOT_WORD = f"[{SIGNS}]+"
#: what separates the items of a list; the end of a sentence counts too
SEPARATORS = r",;/|&+\n\r"


@dataclass(frozen=True)
class Rule:
    """``pattern`` must start and end at words; ``priority``: smaller wins."""

    label: str
    keyword: str
    pattern: str
    priority: int
    confidence: float


# Licenses by what they are called (an expression over words), a keyword of it,
# and their label.
_NAMES = [
    ("gpl", "general public license", r"(?:gnu )?general public license"),
    ("gpl", "gpl", r"(?:gnu )?gpl"),
    ("lgpl", "lesser general public", r"(?:gnu )?lesser general public license"),
    ("lgpl", "library general public", r"(?:gnu )?library general public license"),
    ("lgpl", "lgpl", r"(?:gnu )?lgpl"),
    ("agpl", "affero", r"(?:gnu )?affero general public license"),
    ("agpl", "agpl", r"(?:gnu )?agpl"),
    ("gfdl", "free documentation", r"(?:gnu )?free documentation license"),
    ("apache", "apache", r"apache(?: software)? license"),
    ("apache", "apache", r"apache 2 0"),
    ("mit", "mit", r"mit license"),
    ("mit", "mit", r"mit x11 license"),
    ("mit", "expat", r"expat license"),
    ("x11", "x11", r"x11 license"),
    ("bsd", "bsd", r"(?:new |simplified |modified |original )?bsd license"),
    ("bsd-2", "clause bsd", r"(?:2|two) clause bsd license"),
    ("bsd-2", "bsd", r"bsd (?:2|two) clause(?: license)?"),
    ("bsd-3", "clause bsd", r"(?:3|three) clause bsd license"),
    ("bsd-3", "bsd", r"bsd (?:3|three) clause(?: license)?"),
    ("isc", "isc license", r"isc license"),
    ("mpl", "mozilla", r"mozilla public license"),
    ("mpl", "mpl", r"mpl 2 0"),
    ("epl", "eclipse", r"eclipse public license"),
    ("cddl", "common development", r"common development and distribution license"),
    ("cddl", "cddl", r"cddl"),
    ("eupl", "european union public", r"european union public licen[cs]e"),
    ("artistic", "artistic license", r"artistic license"),
    ("boost", "boost", r"boost software license"),
    ("zlib", "zlib", r"zlib(?: libpng)? license"),
    ("unlicense", "unlicense", r"the unlicense"),
    ("wtfpl", "wtfpl", r"wtfpl"),
    ("ofl", "open font", r"(?:sil )?open font license"),
    ("psf", "python software foundation", r"python software foundation license"),
    ("postgresql", "postgresql license", r"postgresql license"),
    ("odbl", "open database license", r"open database license"),
    ("cc-by", "cc by", r"cc by"),
    ("cc-by-sa", "cc by sa", r"cc by sa"),
    ("cc-by-nc", "cc by nc", r"cc by nc"),
    ("cc-by-nd", "cc by nd", r"cc by nd"),
    ("cc-by-nc-sa", "cc by nc sa", r"cc by nc sa"),
    ("cc-by-nc-nd", "cc by nc nd", r"cc by nc nd"),
    ("cc0", "cc0", r"cc0"),
    ("cc-by", "creative commons", r"creative commons attribution"),
    ("cc-by-sa", "creative commons", r"creative commons attribution share ?alike"),
    ("cc-by-nc", "creative commons", r"creative commons attribution non ?commercial"),
]
# How a license is spoken of: (expression around the name, priority, confidence). A blank
# may hold a separator, an underscore is a blank without one.
_FORMS = [
    (r"(?:is |are |be )?(?:licensed|released|distributed|available|published|provided) under(?: the)?(?: terms of the)? {}(?: (?:version|v) ?[0-9]+(?:_[0-9]+)*|_[0-9]+_[0-9]+)?", 1, 0.98),
    (r"under(?: the)?(?: terms of the)? {}(?: (?:version|v) ?[0-9]+(?:_[0-9]+)*|_[0-9]+_[0-9]+)?", 2, 0.9),
    (r"licen[cs]e_{}(?: (?:version|v) ?[0-9]+(?:_[0-9]+)*)?", 3, 0.85),
    (r"{} (?:version|v) ?[0-9]+(?:_[0-9]+)*", 4, 0.85),
    (r"{}", 5, 0.6),
]
# Sentences that mark a license without its name, notices and headers, in words.
_SENTENCES = [
    ("mit", "permission is hereby granted", r"permission is hereby granted free of charge to any person obtaining a copy"),
    ("isc", "permission to use copy modify", r"permission to use copy modify and or distribute this software for any purpose"),
    ("bsd", "redistribution and use", r"redistribution and use in source and binary forms"),
    ("gpl", "free software you can redistribute", r"free software you can redistribute it and or modify"),
    ("apache", "you may not use this file except", r"you may not use this file except in compliance with the license"),
    ("mpl", "source code form is subject", r"source code form is subject to the terms of the mozilla public license"),
    ("unlicense", "released into the public domain", r"unencumbered software released into the public domain"),
    ("public-domain", "public domain", r"(?:dedicated to|released into|placed in|in) the public domain"),
    ("proprietary", "all rights reserved", r"all rights reserved"),
    ("copyright", "copyright", r"copyright (?:c )?[0-9]{{4}}"),
]
# Written signatures: grants, conditions, warranty clauses and notices as they stand in the
# licenses' texts, in words. The longest word is the keyword.
_NOTICES = {
    "mit": [
        "the above copyright notice and this permission notice shall be included in all copies",
        "without limitation the rights to use copy modify merge publish distribute sublicense",
        "to deal in the software without restriction", "permit persons to whom the software is furnished to do so",
        "copies or substantial portions of the software", "dealings in the software",
    ],
    "x11": [
        "except as contained in this notice the name of the x consortium shall not be used in advertising",
        "copyright holders shall not be used in advertising or otherwise to promote the sale",
    ],
    "isc": [
        "provided that the above copyright notice and this permission notice appear in all copies",
        "the author disclaims all warranties with regard to this software",
        "the software is provided as is and the author disclaims all warranties",
        "shall the author be liable for any special direct indirect or consequential damages",
        "arising out of or in connection with the use or performance of this software",
    ],
    "0bsd": ["permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted the software"],
    "bsd": [
        "with or without modification are permitted provided that the following conditions are met",
        "redistributions of source code must retain the above copyright notice",
        "redistributions in binary form must reproduce the above copyright notice",
        "this list of conditions and the following disclaimer", "use of this source code is governed by a bsd style license",
        "the implied warranties of merchantability and fitness for a particular purpose are disclaimed",
        "procurement of substitute goods or services loss of use data or profits",
    ],
    "bsd-3": [
        "neither the name of the copyright holder nor the names of its contributors may be used to endorse",
        "may be used to endorse or promote products derived from this software without specific prior written permission",
        "neither the name of the author nor the names of contributors",
    ],
    "bsd-4": ["all advertising materials mentioning features or use of this software must display the following acknowledgement"],
    "apache": [
        "unless required by applicable law or agreed to in writing software distributed under the license",
        "distributed under the license is distributed on an as is basis",
        "see the license for the specific language governing permissions and limitations under the license",
        "you may obtain a copy of the license at", "http www apache org licenses license 2 0",
        "licensed to the apache software foundation asf under one or more contributor license agreements",
        "each contributor hereby grants to you a perpetual worldwide non exclusive no charge royalty free",
        "this product includes software developed at the apache software foundation",
    ],
    "gpl": [
        "this program is free software you can redistribute it", "this program is distributed in the hope that it will be useful",
        "either version 2 of the license or at your option any later version", "either version 3 of the license or at your option any later version",
        "see the gnu general public license for more details", "you should have received a copy of the gnu general public license",
        "free software foundation inc 51 franklin street", "free software foundation inc 59 temple place",
        "this program comes with absolutely no warranty", "everyone is permitted to copy and distribute verbatim copies of this license document",
        "the licenses for most software are designed to take away your freedom", "www gnu org licenses gpl",
    ],
    "lgpl": [
        "this library is free software you can redistribute it", "this library is distributed in the hope that it will be useful",
        "you should have received a copy of the gnu lesser general public license", "see the gnu lesser general public license for more details",
        "you should have received a copy of the gnu library general public license", "www gnu org licenses lgpl",
    ],
    "agpl": [
        "you should have received a copy of the gnu affero general public license", "see the gnu affero general public license for more details",
        "users interacting with it remotely through a computer network", "www gnu org licenses agpl",
    ],
    "gfdl": [
        "permission is granted to copy distribute and or modify this document under the terms of the gnu free documentation license",
        "with no invariant sections no front cover texts and no back cover texts", "entitled gnu free documentation license",
    ],
    "mpl": [
        "this source code form is subject to the terms of the mozilla public license", "if a copy of the mpl was not distributed with this file",
        "you can obtain one at http mozilla org mpl", "the contents of this file are subject to the mozilla public license",
        "incompatible with secondary licenses as defined by the mozilla public license",
    ],
    "epl": [
        "this program and the accompanying materials are made available under the terms of the eclipse public license",
        "which accompanies this distribution and is available at http www eclipse org legal epl", "www eclipse org legal epl",
    ],
    "cddl": [
        "the contents of this file are subject to the terms of the common development and distribution license",
        "include this cddl header in each file", "you can obtain a copy of the license at usr src opensolaris license",
    ],
    "eupl": ["licensed under the eupl", "joinup ec europa eu software page eupl"],
    "artistic": [
        "the intent of this document is to state the conditions under which a package may be copied",
        "you may distribute this program under the terms of either the gnu general public license or the artistic license",
        "the same terms as perl itself", "the same terms as the perl 5 programming language system itself",
    ],
    "boost": [
        "permission is hereby granted free of charge to any person or organization obtaining a copy",
        "must be included in all copies of the software in whole or in part and all derivative works",
        "distributed under the boost software license", "www boost org license 1 0 txt",
    ],
    "zlib": [
        "this software is provided as is without any express or implied warranty",
        "in no event will the authors be held liable for any damages arising from the use of this software",
        "permission is granted to anyone to use this software for any purpose including commercial applications",
        "the origin of this software must not be misrepresented you must not claim that you wrote the original software",
        "altered source versions must be plainly marked as such", "this notice may not be removed or altered from any source distribution",
    ],
    "unlicense": [
        "this is free and unencumbered software released into the public domain",
        "anyone is free to copy modify publish use compile sell or distribute this software",
        "we make this dedication for the benefit of the public at large", "for more information please refer to http unlicense org",
    ],
    "wtfpl": ["do what the fuck you want to public license", "you just do what the fuck you want to"],
    "ofl": [
        "this font software is licensed under the sil open font license", "this license is copied below and is also available with a faq at",
        "the fonts may be bundled embedded redistributed and or sold with any software", "reserved font name",
    ],
    "psf": [
        "psf is making python available to licensee on an as is basis", "psf hereby grants licensee a nonexclusive royalty free world wide license",
    ],
    "postgresql": [
        "permission to use copy modify and distribute this software and its documentation for any purpose without fee",
        "in no event shall the university of california be liable to any party",
    ],
    "odbl": ["made available under the open database license", "any rights in individual contents of the database are licensed under the database contents license"],
    "odc-by": ["made available under the open data commons attribution license", "open data commons attribution license"],
    "pddl": ["open data commons public domain dedication and license"],
    "cc0": [
        "the person who associated a work with this deed has dedicated the work to the public domain", "no copyright cc0",
        "creative commons zero", "creativecommons org publicdomain zero 1 0",
        "to the extent possible under law the author has dedicated all copyright", "waived all copyright and related or neighboring rights",
    ],
    "cc-by": [
        "this work is licensed under a creative commons attribution", "creativecommons org licenses by 4 0", "creativecommons org licenses by 3 0",
        "you must give appropriate credit provide a link to the license and indicate if changes were made",
    ],
    "cc-by-sa": [
        "creativecommons org licenses by sa 4 0", "creativecommons org licenses by sa 3 0", "you must distribute your contributions under the same license as the original",
        "text is available under the creative commons attribution sharealike license", "creative commons attribution share alike",
    ],
    "cc-by-nc": ["creativecommons org licenses by nc 4 0", "creativecommons org licenses by nc 3 0", "creative commons attribution noncommercial",
                 "you may not use the material for commercial purposes"],
    "cc-by-nd": ["creativecommons org licenses by nd 4 0", "creative commons attribution noderivatives", "you may not distribute the modified material"],
    "cc-by-nc-sa": ["creativecommons org licenses by nc sa 4 0", "creative commons attribution noncommercial sharealike"],
    "cc-by-nc-nd": ["creativecommons org licenses by nc nd 4 0", "creative commons attribution noncommercial noderivatives"],
    "ms-pl": ["microsoft public license", "if you bring a patent claim against any contributor over patents that you claim are infringed by the software"],
    "ms-rl": ["microsoft reciprocal license"],
    "apsl": ["apple public source license", "this file contains original code and or modifications of original code as defined in and that are subject to the apple"],
    "cpl": ["common public license"],
    "ipl": ["ibm public license"],
    "osl": ["open software license", "licensed under the open software license"],
    "afl": ["academic free license"],
    "qpl": ["q public license"],
    "lppl": ["latex project public license", "this work may be distributed and or modified under the conditions of the latex project public license"],
    "ncsa": ["university of illinois ncsa open source license", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal with the software"],
    "php": ["php license", "this product includes php software freely available from"],
    "openssl": ["this product includes software developed by the openssl project for use in the openssl toolkit"],
    "ssleay": ["this product includes cryptographic software written by eric young"],
    "vim": ["vim license", "there are no restrictions on distributing unmodified copies of vim"],
    "ruby": ["you can redistribute it and or modify it under either the terms of the 2 clause bsdl"],
    "beerware": ["as long as you retain this notice you can do whatever you want with this stuff", "beer ware license"],
    "json": ["the software shall be used for good not evil"],
    "curl": ["permission to use copy modify and distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice"],
    "hpnd": ["permission to use copy modify distribute and sell this software and its documentation for any purpose is hereby granted without fee"],
    "ntp": ["permission to use copy modify and distribute this software and its documentation for any purpose with or without fee is hereby granted"],
    "bsl": ["business source license", "change date four years from the date the licensed work is published"],
    "sspl": ["server side public license"],
    "elastic": ["elastic license", "you may not provide the software to third parties as a hosted or managed service"],
    "commons-clause": ["commons clause license condition", "the grant of rights under the license will not include the right to sell the software"],
    "proprietary": [
        "this software is proprietary and confidential", "unauthorized copying of this file via any medium is strictly prohibited",
        "no part of this publication may be reproduced", "proprietary and confidential", "confidential and proprietary information of",
        "may not be reproduced distributed or transmitted in any form",
    ],
    "public-domain": [
        "this file has been put into the public domain", "the author disclaims copyright to this source code",
        "this work is in the public domain", "has been dedicated to the public domain", "no rights reserved",
    ],
}
# Tags of the machine-readable form, by label.
_TAGS = {
    "mit": ["mit"], "apache": ["apache 2 0", "apache 1 1"], "isc": ["isc"], "0bsd": ["0bsd"], "zlib": ["zlib"], "boost": ["bsl 1 0"],
    "gpl": ["gpl 2 0 only", "gpl 2 0 or later", "gpl 3 0 only", "gpl 3 0 or later", "gpl 2 0", "gpl 3 0"],
    "lgpl": ["lgpl 2 1 only", "lgpl 2 1 or later", "lgpl 3 0 only", "lgpl 3 0 or later", "lgpl 2 1", "lgpl 3 0"],
    "agpl": ["agpl 3 0 only", "agpl 3 0 or later", "agpl 3 0"], "bsd-2": ["bsd 2 clause"], "bsd-3": ["bsd 3 clause"], "bsd-4": ["bsd 4 clause"],
    "mpl": ["mpl 2 0", "mpl 1 1"], "epl": ["epl 2 0", "epl 1 0"], "cddl": ["cddl 1 0", "cddl 1 1"], "eupl": ["eupl 1 2", "eupl 1 1"],
    "artistic": ["artistic 2 0"], "unlicense": ["unlicense"], "wtfpl": ["wtfpl"], "ofl": ["ofl 1 1"], "psf": ["psf 2 0"],
    "postgresql": ["postgresql"], "ms-pl": ["ms pl"], "ms-rl": ["ms rl"], "ncsa": ["ncsa"], "cc0": ["cc0 1 0"],
    "cc-by": ["cc by 4 0", "cc by 3 0"], "cc-by-sa": ["cc by sa 4 0", "cc by sa 3 0"], "cc-by-nc": ["cc by nc 4 0"],
    "cc-by-nd": ["cc by nd 4 0"], "cc-by-nc-sa": ["cc by nc sa 4 0"], "cc-by-nc-nd": ["cc by nc nd 4 0"],
}


def _blanks_of(pattern: str) -> str:
    """A blank may follow a separator's comma; an underscore is a plain blank."""
    return pattern.replace(" ?", "(?:,? )?").replace(" ", ",? ").replace(",?,? ", ",? ").replace("_", " ")


def _keyword(signature: str) -> str:
    """The longest word of a signature, with the next one if it is short."""
    words = signature.split()
    at = max(range(len(words)), key=lambda i: (len(words[i]), -i))
    return words[at] if len(words[at]) >= 8 or at + 1 == len(words) else f"{words[at]} {words[at + 1]}"


def rules() -> list[Rule]:
    """Hundreds of rules in order: written signatures and tags first, longer ones
    before shorter ones, then whole sentences, then every name in every form. Of names
    in one form, the longer one has priority."""
    written = [(label, s) for label, notices in _NOTICES.items() for s in notices]
    written += [(label, f"spdx license identifier {tag}") for label, tags in _TAGS.items() for tag in tags]
    written.sort(key=lambda x: -len(x[1]))
    out = [Rule(label, _keyword(s), _blanks_of(s), i, 0.95) for i, (label, s) in enumerate(written)]
    out += [Rule(label, key, _blanks_of(pattern.format()), 500 + i, 0.9) for i, (label, key, pattern) in enumerate(_SENTENCES)]
    names = sorted(_NAMES, key=lambda n: -len(n[2]))
    for form, priority, confidence in _FORMS:
        out += [Rule(label, key, _blanks_of(form.format(name)), 1000 * priority + i, confidence)
                for i, (label, key, name) in enumerate(names)]
    return out


def gate_pattern(table: list[Rule], base: dict[str, str]) -> str:
    """Expression for a word's start where a keyword or base phrase may begin: their
    first 8 letters (two words, if the first is short), grouped by the first letter."""
    def short(keyword: str) -> str:
        first = keyword.split()[0]
        return first[:8] if len(first) >= 6 else " ".join(keyword.split()[:2])

    heads = sorted({short(k) for k in [r.keyword for r in table] + list(base)})
    heads = [h for h in heads if not any(h != o and h.startswith(o) for o in heads)]
    letters = sorted({h[0] for h in heads})
    return "(?<= )(?:" + "|".join(f"{c}(?:{'|'.join(h[1:] for h in heads if h[0] == c)})" for c in letters) + ")"


def normalized(text: Column) -> Column:
    """The text's words, A-Z lowered, with one blank before, between and after."""
    lower = F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.regexp_replace(F.concat(F.lit(" "), lower, F.lit(" ")), NOT_WORD, " ")


def marked(text: Column) -> Column:
    """``normalized`` with a comma before a blank that stands for a list separator,
    a line break or the end of a sentence. Without its commas it is the same."""
    lower = F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    ends = F.regexp_replace(F.concat(F.lit(" "), lower, F.lit(" ")), r"[.!?](?=[\x20\t])", "\n")
    lists = F.regexp_replace(ends, f"(?<![{SIGNS}])[{SIGNS}&&[^{SEPARATORS}]]*+[{SEPARATORS}][{SIGNS}]*+", "\n")
    return F.replace(F.regexp_replace(lists, f"[{SIGNS}&&[^\\n]]+", " "), F.lit("\n"), F.lit(", "))


def _blanks(s: Column) -> Column:
    return (F.length(s) - F.length(F.replace(s, F.lit(" ")))).cast("int")


def _once(value: Column, body) -> Column:
    """``body(value)`` with ``value`` worked out once, not at each of its uses."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _places(words: Column, pattern: Column) -> Column:
    """(start, end) in words of every match of a pattern in `` w w w ``: the
    pieces between the matches and the matches themselves, summed up."""
    none = F.expr("cast(array() as array<struct<start:int,end:int>>)")

    def summed(found: Column, between: Column) -> Column:
        size = F.transform(F.sequence(F.lit(0), F.size(found) - 1), lambda i: F.struct(
            _blanks(F.get(between, i)).alias("before"), _blanks(F.get(found, i)).alias("inner")))
        steps = F.aggregate(
            size, F.struct(F.lit(0).cast("int").alias("at"), none.alias("out")),
            lambda acc, z: F.struct(
                (acc["at"] + z["before"] + z["inner"]).cast("int").alias("at"),
                F.concat(acc["out"], F.array(F.struct(
                    (acc["at"] + z["before"] - 1).cast("int").alias("start"),
                    (acc["at"] + z["before"] + z["inner"]).cast("int").alias("end")))).alias("out")))
        return steps["out"]

    return _once(F.regexp_extract_all(words, pattern, F.lit(0)), lambda found: F.when(
        F.size(found) > 0, _once(F.split(words, pattern, -1), lambda between: summed(found, between))).otherwise(none))


def _rule_table(table: list[Rule]) -> Column:
    return F.array(*[
        F.struct(F.lit(r.label).alias("label"), F.lit(f" {r.keyword}").alias("keyword"),
                 F.lit(f"(?<= ){r.pattern}(?=,? )").alias("pattern"), F.lit(r.priority).alias("priority"),
                 F.lit(r.confidence).alias("confidence")) for r in table])


def scan(docs: DataFrame, table: list[Rule] | None = None, base: dict[str, str] | None = None) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``n_words``, the base phrases'
    count, first and last start and labels, all labels, a score (the largest
    confidence of a detection left; base phrases 1) and ``detections`` (label,
    start, end, priority, confidence), starts and ends in words."""
    table = rules() if table is None else table
    base = BASE if base is None else base
    # a word at whose start a keyword may begin: the gate that most texts do not pass
    gate = gate_pattern(table, base)
    # explode(array(x)) keeps x a column that is worked out once
    words = texts(docs).withColumn("row", F.monotonically_increasing_id()).select(
        "row", "doc_id", "text", F.explode(F.array(normalized(F.col("text")))).alias("words"))
    passed = words.select(
        "row", "doc_id", (_blanks(F.col("words")) - 1).cast("long").alias("n_words"),
        F.explode(F.array(F.when(F.col("words").rlike(gate), F.struct("words", marked(F.col("text")).alias("marked"))))).alias("t"))
    detection = "array<struct<start:int,end:int,label:string,priority:int,confidence:double,base:boolean>>"

    def found(place: Column, label, priority, confidence, is_base: bool) -> Column:
        return F.transform(place, lambda p: F.struct(
            p["start"].alias("start"), p["end"].alias("end"), label.alias("label"), priority.alias("priority"),
            confidence.alias("confidence"), F.lit(is_base).alias("base")))

    w, m = F.col("t.words"), F.col("t.marked")
    of_base = [
        F.when(F.contains(w, F.lit(f" {phrase} ")),
               found(_places(w, F.lit(f"(?<= ){phrase}(?= )")), F.lit(label), F.lit(-1), F.lit(1.0), True)).otherwise(
            F.expr(f"cast(array() as {detection})"))
        for phrase, label in base.items()
    ]
    active = F.filter(_rule_table(table), lambda r: F.contains(w, r["keyword"]))
    of_rules = F.flatten(F.transform(active, lambda r: found(
        _places(m, r["pattern"]), r["label"], r["priority"], r["confidence"], False)))
    hits = F.when(w.isNotNull(), F.concat(*of_base, of_rules))
    rows = passed.select("row", "doc_id", "n_words", F.explode_outer(hits).alias("d"))
    return _resolved(rows)


def _staying(found: Column) -> Column:
    """The detections of one run that stay, by a loop in order of priority."""
    def ranked(d: Column) -> Column:
        inside = F.filter(found, lambda x: (x["start"] >= d["start"]) & (x["end"] <= d["end"]))
        best = F.array_min(F.transform(inside, lambda x: x["priority"]))
        return F.struct(best.alias("best"), (d["start"] - d["end"]).alias("shorter"), d["priority"].alias("priority"),
                        d["start"].alias("start"), d["end"].alias("end"), d["label"].alias("label"), d["confidence"].alias("confidence"))

    ordered = F.array_sort(F.transform(found, ranked))
    none = F.filter(ordered, lambda d: F.lit(False))
    return F.aggregate(ordered, none, lambda kept, d: F.when(
        F.exists(kept, lambda k: (k["start"] < d["end"]) & (d["start"] < k["end"])), kept).otherwise(F.concat(kept, F.array(d))))


def _resolved(rows: DataFrame) -> DataFrame:
    """Suppress overlapping detections, then one row per text. Runs of detections
    that overlap one another are resolved each on its own."""
    base = F.coalesce(F.col("d.base"), F.lit(False))
    in_order = Window.partitionBy("row", F.col("d.base")).orderBy("d.start", "d.end")
    reach = F.max("d.end").over(in_order.rowsBetween(Window.unboundedPreceding, -1))
    opens = F.col("d").isNotNull() & ~base & F.coalesce(F.col("d.start") >= reach, F.lit(True))
    run = F.sum(opens.cast("long")).over(in_order.rowsBetween(Window.unboundedPreceding, 0))
    runs = rows.withColumn("opens", opens).withColumn("run", F.when(~base, run)).groupBy("row", "run", base.alias("base")).agg(
        F.first("doc_id").alias("doc_id"), F.first("n_words").alias("n_words"), F.collect_list("d").alias("found"))
    stays = runs.select("row", "doc_id", "n_words", "base", F.when(F.col("base"), F.col("found")).alias("phrases"),
                        F.when(~F.col("base"), _staying(F.col("found"))).alias("rules"))
    labels = lambda c: F.flatten(F.collect_list(F.transform(c, lambda d: d["label"])))
    joined = lambda c: F.array_join(F.array_sort(F.array_distinct(c)), ",")
    starts = F.transform("phrases", lambda d: d["start"])
    whole = stays.groupBy("row").agg(
        F.first("doc_id").alias("doc_id"), F.first("n_words").alias("n_words"),
        F.coalesce(F.sum(F.size("phrases")), F.lit(0)).cast("long").alias("n_base"),
        F.min(F.array_min(starts)).cast("long").alias("first_word"), F.max(F.array_max(starts)).cast("long").alias("last_word"),
        labels("phrases").alias("of_base"), labels("rules").alias("of_rules"),
        F.sort_array(F.flatten(F.collect_list(F.transform("rules", lambda d: F.struct(
            d["start"].alias("start"), d["end"].alias("end"), d["label"].alias("label"), d["priority"].alias("priority"),
            d["confidence"].alias("confidence")))))).alias("detections"))
    score = F.greatest(F.when(F.size("of_base") > 0, F.lit(1.0)), F.array_max(F.transform("detections", lambda d: d["confidence"])))
    return whole.select(
        "doc_id", "n_words", "n_base", "first_word", "last_word", joined(F.col("of_base")).alias("base_labels"),
        joined(F.concat("of_base", "of_rules")).alias("labels"), F.coalesce(score, F.lit(0.0)).alias("score"), "detections")
