"""License statements by ordered signature rules over the words of a text.

Rules are regular expressions over the lower-cased words joined by single spaces. A rule is
tried only if its keyword is among the words of the text. Where detections overlap, one that lies inside another
of the same or a higher priority is suppressed.
"""

from __future__ import annotations

import json
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strandfold.llm.common import lower_ascii

#: Phrases and labels that the base result is defined on; fixed values.
BASE = (("cc by", "cc-by"), ("general public license", "gpl"), ("all rights reserved", "reserved"))

#: Licenses known by name: label, and the words that name it. Rules are built from these below.
NAMED = (
    ("apache-2.0", "apache (?:software )?license(?: version)? 2(?: 0)?"),
    ("apache-1.1", "apache (?:software )?license(?: version)? 1 1"),
    ("apache-1.0", "apache (?:software )?license(?: version)? 1 0"),
    ("apache", "apache (?:software )?license"),
    ("mit", "mit license"),
    ("mit-0", "mit no attribution(?: license)?"),
    ("expat", "expat license"),
    ("x11", "x11 license"),
    ("isc", "isc license"),
    ("bsd-2-clause", "(?:bsd 2 clause|2 clause bsd|simplified bsd)(?: license)?"),
    ("bsd-2-clause", "freebsd license"),
    ("bsd-3-clause", "(?:bsd 3 clause|3 clause bsd|new bsd|modified bsd|revised bsd)(?: license)?"),
    ("bsd-4-clause", "(?:bsd 4 clause|4 clause bsd|original bsd)(?: license)?"),
    ("0bsd", "0bsd(?: license)?"),
    ("0bsd", "(?:zero clause bsd|bsd zero clause)(?: license)?"),
    ("bsd", "bsd license"),
    ("agpl-3.0", "(?:gnu )?affero general public license(?: version| v)? ?3"),
    ("agpl", "(?:gnu )?affero general public license"),
    ("lgpl-2.0", "(?:gnu )?library general public license"),
    ("lgpl-2.1", "(?:gnu )?lesser general public license(?: version| v)? ?2(?: 1)?"),
    ("lgpl-3.0", "(?:gnu )?lesser general public license(?: version| v)? ?3"),
    ("lgpl", "(?:gnu )?lesser general public license"),
    ("gpl-1.0", "(?:gnu )?general public license(?: version| v)? ?1"),
    ("gpl-2.0", "(?:gnu )?general public license(?: version| v)? ?2"),
    ("gpl-3.0", "(?:gnu )?general public license(?: version| v)? ?3"),
    ("gfdl-1.1", "(?:gnu )?free documentation license(?: version| v)? ?1 1"),
    ("gfdl-1.2", "(?:gnu )?free documentation license(?: version| v)? ?1 2"),
    ("gfdl-1.3", "(?:gnu )?free documentation license(?: version| v)? ?1 3"),
    ("gfdl", "(?:gnu )?free documentation license"),
    ("mpl-1.0", "mozilla public license(?: version| v)? ?1 0"),
    ("mpl-1.1", "mozilla public license(?: version| v)? ?1 1"),
    ("mpl-2.0", "mozilla public license(?: version| v)? ?2(?: 0)?"),
    ("mpl", "mozilla public license"),
    ("npl", "netscape public license"),
    ("epl-1.0", "eclipse public license(?: version| v)? ?1(?: 0)?"),
    ("epl-2.0", "eclipse public license(?: version| v)? ?2(?: 0)?"),
    ("epl", "eclipse public license"),
    ("cpl-1.0", "common public license"),
    ("ipl-1.0", "ibm public license"),
    ("cddl-1.0", "common development and distribution license(?: version| v)? ?1 0"),
    ("cddl-1.1", "common development and distribution license(?: version| v)? ?1 1"),
    ("cddl", "common development and distribution license"),
    ("eupl-1.1", "european union public licen[cs]e(?: version| v)? ?1 1"),
    ("eupl-1.2", "european union public licen[cs]e(?: version| v)? ?1 2"),
    ("eupl", "european union public licen[cs]e"),
    ("artistic-1.0", "artistic license(?: version| v)? ?1(?: 0)?"),
    ("artistic-2.0", "artistic license(?: version| v)? ?2(?: 0)?"),
    ("artistic", "artistic license"),
    ("bsl-1.0", "boost software license"),
    ("busl-1.1", "business source license"),
    ("sspl-1.0", "server side public license"),
    ("elastic-2.0", "elastic license"),
    ("osl-3.0", "open software license"),
    ("afl-3.0", "academic free license"),
    ("ecl-2.0", "educational community license"),
    ("zlib", "zlib license"),
    ("libpng", "libpng license"),
    ("psf-2.0", "python software foundation license"),
    ("php-3.01", "php license"),
    ("ruby", "ruby license"),
    ("perl", "same terms as perl itself"),
    ("ofl-1.1", "(?:sil )?open font license"),
    ("openssl", "openssl license"),
    ("ssleay", "ssleay license"),
    ("postgresql", "postgresql license"),
    ("ncsa", "university of illinois ncsa open source license"),
    ("upl-1.0", "universal permissive license"),
    ("ms-pl", "microsoft public license"),
    ("ms-rl", "microsoft reciprocal license"),
    ("odbl-1.0", "open database license"),
    ("odc-by-1.0", "open data commons attribution license"),
    ("pddl-1.0", "public domain dedication and license"),
    ("cdla-permissive", "community data license agreement permissive"),
    ("cdla-sharing", "community data license agreement sharing"),
    ("ogl-uk", "open government licen[cs]e"),
    ("wtfpl", "do what the fuck you want to public license"),
    ("unlicense", "unlicense"),
    ("beerware", "beerware license"),
    ("cecill", "cecill(?: [abc])? license"),
    ("qpl-1.0", "q public license"),
    ("sleepycat", "sleepycat license"),
    ("spl-1.0", "sun public license"),
    ("vim", "vim license"),
    ("w3c", "w3c software(?: notice and)? license"),
    ("watcom-1.0", "sybase open watcom public license"),
    ("zpl-2.1", "zope public license"),
    ("lppl-1.3c", "latex project public license"),
    ("ijg", "independent jpeg group license"),
    ("icu", "icu license"),
    ("json", "json license"),
    ("mulan-2.0", "mulan permissive software license"),
    ("ldpl", "linux documentation project license"),
    ("intel", "intel open source license"),
    ("nasa-1.3", "nasa open source agreement"),
    ("rpl-1.5", "reciprocal public license"),
    ("simpl", "simple public license"),
    ("tcl", "tcl tk license"),
    ("apsl-2.0", "apple public source license"),
    ("curl", "curl license"),
    ("hpnd", "historical permission notice and disclaimer"),
    ("rail", "responsible ai license"),
    ("openrail", "openrail(?: m)? license"),
)

#: Further statements: label, regular expression, keyword, priority.
STATEMENTS = (
    *((f"cc-{k.replace(' ', '-')}", f"cc {k}(?: [1-4](?: [05])?)?", "cc", 3) for k in ("by", "by sa", "by nd", "by nc", "by nc sa", "by nc nd")),
    *((f"cc-by{''.join('-' + x for x in short.split())}", f"creative commons attribution {long}(?: [1-4](?: [05])?)?(?: international| unported)?(?: license| licence)?", "creative", 3)
      for short, long in (("", "(?=[1-4]|licen|international|unported)"), ("sa", "share ?alike"), ("nd", "no ?deriv(?:ative|ative works|atives|s)"), ("nc", "non ?commercial"), ("nc sa", "non ?commercial share ?alike"), ("nc nd", "non ?commercial no ?deriv(?:ative|ative works|atives|s)"))),
    ("cc0", "cc0(?: 1 0)?(?: universal)?", "cc0", 3),
    ("cc0", "creative commons zero", "creative", 3),
    ("cc", "creative commons(?: license| licence)?", "creative", 1),
    *((f"cc-{k}", f"creativecommons org licenses {k.replace('-', ' ')}(?: [1-4](?: [05])?)?", "creativecommons", 4) for k in ("by", "by-sa", "by-nd", "by-nc", "by-nc-sa", "by-nc-nd")),
    ("cc0", "creativecommons org publicdomain zero", "creativecommons", 4),
    ("public-domain", "(?:released|dedicated|placed|is) (?:in ?to |to |in )?the public domain", "domain", 2),
    ("public-domain", "public domain dedication", "domain", 2),
    ("gpl", "general public license", "general", 1),
    ("gpl-2.0-or-later", "general public license(?: as published by the free software foundation)?(?: either)? version 2 (?:of the license )?or (?:at your option )?(?:any|later)", "general", 4),
    ("gpl-3.0-or-later", "general public license(?: as published by the free software foundation)?(?: either)? version 3 (?:of the license )?or (?:at your option )?(?:any|later)", "general", 4),
    *((f"{k}-{v}.0", f"{k}v?{v}", f"{k}{w}{v}", 2) for k in ("gpl", "lgpl", "agpl") for v in "123" for w in ("", "v")),
    *((f"{k}-{v}.0", f"{k} (?:v ?|version )?{v}", k, 2) for k in ("gpl", "lgpl", "agpl") for v in "123"),
    ("reserved", "all rights reserved", "reserved", 1),
    ("reserved", "alle rechte vorbehalten", "vorbehalten", 1),
    ("reserved", "tous droits réservés", "réservés", 1),
    ("reserved", "todos los derechos reservados", "reservados", 1),
    ("copyright", "copyright (?:c )?(?:19|20)[0-9][0-9](?: (?:19|20)[0-9][0-9])?(?: by)?", "copyright", 1),
    ("copyright", "(?:19|20)[0-9][0-9] copyright", "copyright", 1),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy", "permission", 2),
    ("isc", "permission to use copy modify and or distribute this software for any purpose", "permission", 2),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted", "redistribution", 2),
    ("bsd-3-clause", "neither the name of .{1,80} nor the names of its contributors", "neither", 2),
    ("zlib", "this software is provided as is without any express or implied warranty in no event will the authors", "warranty", 2),
    ("bsl-1.0", "permission is hereby granted free of charge to any person or organization", "permission", 3),
    ("apache-2.0", "apache org licenses license 2 0", "apache", 4),
    *((f"gnu-{k}", f"gnu org licenses {k}(?: [123](?: [0-9])?)?", "gnu", 3) for k in ("gpl", "lgpl", "agpl", "fdl")),
    ("mit", "opensource org licenses mit", "opensource", 4),
    ("bsd", "opensource org licenses bsd", "opensource", 4),
    ("proprietary", "proprietary and confidential", "proprietary", 1),
    ("proprietary", "unauthorized (?:copying|use|distribution|reproduction)[a-z ]{0,60} prohibited", "unauthorized", 1),
    ("no-commercial", "for non commercial use only", "commercial", 1),
    ("internal-only", "for internal use only", "internal", 1),
)

#: Clauses that licenses are told by when they are not named: label, regular expression, keyword, priority. Fixed values,
#: written by hand from the published license texts.
CLAUSES = (
    ("mit", "the above copyright notice and this permission notice shall be included in all copies or substantial portions", "substantial", 3),
    ("mit", "to deal in the software without restriction including without limitation the rights to use copy modify merge", "restriction", 3),
    ("mit", "the software is provided as is without warranty of any kind express or implied", "warranty", 2),
    ("mit-modern", "this permission notice including the next paragraph shall be included in all copies", "paragraph", 3),
    ("mit-advertising", "all advertising materials mentioning features or use of this software must display", "advertising", 2),
    ("bsd-2-clause", "redistributions of source code must retain the above copyright notice this list of conditions", "redistributions", 2),
    ("bsd-2-clause", "redistributions in binary form must reproduce the above copyright notice", "redistributions", 2),
    ("bsd-3-clause", "the names? of (?:the )?(?:author|contributors|copyright holders?|[a-z]+) may not be used to endorse or promote products", "endorse", 3),
    ("bsd-3-clause", "to endorse or promote products derived from this software without specific prior written permission", "endorse", 3),
    ("bsd-4-clause", "this product includes software developed by", "product", 2),
    ("bsd-source-code", "redistributions of source code must retain the copyright notice above verbatim", "verbatim", 3),
    ("bsd-patent", "subject to the terms and conditions of this license each copyright holder and contributor hereby grants to those receiving rights", "holder", 3),
    ("isc", "provided that the above copyright notice and this permission notice appear in all copies", "appear", 3),
    ("0bsd", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted the software", "fee", 4),
    ("apache-2.0", "you may not use this file except in compliance with the license", "compliance", 2),
    ("apache-2.0", "you may obtain a copy of the license at(?: http| https)? www apache org", "obtain", 4),
    ("apache-2.0", "unless required by applicable law or agreed to in writing software distributed under the license", "applicable", 3),
    ("apache-2.0", "licensed to the apache software foundation asf under one or more contributor license agreements", "asf", 4),
    ("apache-1.1", "the end user documentation included with the redistribution if any must include the following acknowledgment", "acknowledgment", 3),
    ("gpl", "this program is free software you can redistribute it and or modify", "redistribute", 2),
    ("gpl", "without even the implied warranty of merchantability or fitness for a particular purpose see the gnu", "merchantability", 2),
    ("gpl", "you should have received a copy of the gnu general public license", "received", 3),
    ("gpl", "free software foundation inc 51 franklin (?:st|street) fifth floor", "franklin", 2),
    ("gpl", "free software foundation inc 59 temple place", "temple", 2),
    ("gpl", "the licenses for most software are designed to take away your freedom to share and change it", "freedom", 3),
    ("gpl-3.0", "the gnu general public license is a free copyleft license for software and other kinds of works", "copyleft", 4),
    ("gpl-3.0", "install modified versions of the software inside them", "install", 2),
    ("lgpl", "you should have received a copy of the gnu (?:lesser|library) general public license", "received", 4),
    ("lgpl", "this library is free software you can redistribute it and or modify", "library", 3),
    ("lgpl", "work that uses the library", "library", 2),
    ("agpl-3.0", "you should have received a copy of the gnu affero general public license", "affero", 4),
    ("agpl-3.0", "interacting with it remotely through a computer network", "remotely", 3),
    ("gpl-classpath-exception", "as a special exception the copyright holders of this library give you permission to link", "exception", 3),
    ("gpl-font-exception", "if you create a document which uses this font and embed this font", "font", 3),
    ("gpl-linking-exception", "as a special exception you may use this file as part of a free software library without restriction", "exception", 3),
    ("gcc-exception-3.1", "gcc runtime library exception", "gcc", 4),
    ("gfdl", "permission is granted to copy distribute and or modify this document under the terms of the gnu", "document", 3),
    ("gfdl", "with no invariant sections(?: with)? no front cover texts", "invariant", 3),
    ("mpl-1.1", "the contents of this file are subject to the mozilla public license", "contents", 3),
    ("mpl-2.0", "this source code form is subject to the terms of the mozilla public license", "form", 4),
    ("mpl-2.0", "incompatible with secondary licenses", "secondary", 3),
    ("epl", "this program and the accompanying materials are made available under the terms of the eclipse", "accompanying", 4),
    ("cddl", "the contents of this file are subject to the terms of the common development and distribution license", "contents", 4),
    ("artistic", "the intent of this document is to state the conditions under which a package may be copied", "intent", 3),
    ("artistic-2.0", "everyone is permitted to copy and distribute verbatim copies of this license document but changing it is not allowed this license establishes", "establishes", 4),
    ("bsl-1.0", "boost software license version 1 0 august 17th 2003", "boost", 5),
    ("zlib", "the origin of this software must not be misrepresented", "misrepresented", 3),
    ("zlib", "altered source versions must be plainly marked as such", "altered", 3),
    ("zlib", "this notice may not be removed or altered from any source distribution", "altered", 3),
    ("unlicense", "this is free and unencumbered software released into the public domain", "unencumbered", 4),
    ("unlicense", "anyone is free to copy modify publish use compile sell or distribute this software", "anyone", 3),
    ("wtfpl", "you just do what the fuck you want to", "fuck", 4),
    ("beerware", "if we meet some day and you think this stuff is worth it you can buy me a beer", "beer", 4),
    ("json", "the software shall be used for good not evil", "evil", 4),
    ("ofl-1.1", "the fonts and derivatives however cannot be released under any other type of license", "derivatives", 3),
    ("ofl-1.1", "reserved font name", "font", 2),
    ("ncsa", "neither the names of name of development group", "neither", 3),
    ("postgresql", "in no event shall the university of california be liable to any party for direct indirect", "california", 2),
    ("bsd", "the regents of the university of california", "regents", 2),
    ("psf-2.0", "psf hereby grants licensee a nonexclusive royalty free world wide license", "licensee", 4),
    ("php", "products derived from this software may not be called php", "php", 4),
    ("openssl", "this product includes software developed by the openssl project", "openssl", 4),
    ("ssleay", "this product includes cryptographic software written by eric young", "cryptographic", 4),
    ("ijg", "this software is based in part on the work of the independent jpeg group", "jpeg", 4),
    ("libtiff", "permission to use copy modify distribute and sell this software and its documentation for any purpose", "documentation", 2),
    ("x11", "except as contained in this notice the name of the x consortium shall not be used in advertising", "consortium", 4),
    ("curl", "except as contained in this notice the name of a copyright holder shall not be used in advertising", "advertising", 3),
    ("w3c", "permission to copy modify and distribute this work with or without modification for any purpose and without fee", "work", 2),
    ("ms-pl", "if you use the software you accept this license if you do not accept the license do not use the software", "accept", 3),
    ("sspl-1.0", "offering the program as a service", "service", 2),
    ("busl-1.1", "the licensor hereby grants you the right to copy modify create derivative works redistribute and make non production use", "production", 4),
    ("busl-1.1", "change date", "change", 1),
    ("elastic-2.0", "you may not provide the software to third parties as a hosted or managed service", "hosted", 3),
    ("commons-clause", "the license does not grant to you the right to sell the software", "sell", 3),
    ("commons-clause", "commons clause", "clause", 3),
    ("polyform", "polyform (?:noncommercial|shield|small business|internal use|perimeter)(?: license)?", "polyform", 4),
    ("cc-by", "you must give appropriate credit provide a link to the license and indicate if changes were made", "credit", 3),
    ("cc-by-sa", "if you remix transform or build upon the material you must distribute your contributions under the same license", "remix", 3),
    ("cc-by-nc", "you may not use the material for commercial purposes", "commercial", 3),
    ("cc-by-nd", "if you remix transform or build upon the material you may not distribute the modified material", "remix", 3),
    ("cc0", "to the extent possible under law .{1,60} has waived all copyright and related or neighboring rights", "waived", 4),
    ("public-domain", "no copyright is claimed", "claimed", 2),
    ("public-domain", "this work is not subject to copyright", "subject", 2),
    ("us-government", "work of the (?:united states|u s) government", "government", 2),
    ("ogl-uk", "contains public sector information licensed under the open government", "sector", 4),
    ("openrail", "use based restrictions", "restrictions", 2),
    ("llama", "community license agreement", "agreement", 1),
    ("research-only", "for (?:academic|non profit|research|educational)(?: and (?:academic|non profit|research|educational))* (?:use|purposes) only", "only", 1),
    ("no-redistribution", "may not be (?:reproduced|republished|redistributed|copied)(?: in any form)? without (?:the )?(?:prior |express )?(?:written )?permission", "permission", 1),
    ("no-redistribution", "no part of this (?:publication|book|document|work|site) may be reproduced", "reproduced", 1),
    ("confidential", "this (?:document|file|information|message) (?:is|contains) (?:strictly )?confidential", "confidential", 1),
    ("trade-secret", "trade secrets? (?:of|and confidential)", "trade", 1),
    ("evaluation-only", "for evaluation purposes only", "evaluation", 1),
    ("personal-use", "for (?:your )?personal use only", "personal", 1),
    ("eula", "end user licen[cs]e agreement", "agreement", 1),
)

#: Words too common to gate a rule by, if its name has any other.
COMMON = ("license", "public", "version", "software", "open", "source", "common", "general")

RULE_TYPE = T.StructType([
    T.StructField("label", T.StringType()), T.StructField("pattern", T.StringType()),
    T.StructField("keyword", T.StringType()), T.StructField("priority", T.IntegerType()),
])


def rules() -> list[tuple[str, str, str, int]]:
    """(label, regular expression, keyword, priority), the most telling first.

    Statements and clauses are rules as they stand. Each named license gives three: its bare name, a grant under
    it, and an SPDX tag.
    """
    found = [*STATEMENTS, *CLAUSES]
    for label, name in NAMED:
        sure = [w for w in re.sub(r"\([^()]*\)\??", " ", name).split() if w.isalnum() and not w.isdigit()]
        keyword = max(sure or ["bsd"], key=lambda w: (w not in COMMON, len(w)))
        found.append((label, name, keyword, 2))
        found.append((label, f"(?:licensed|released|distributed|available|published|provided)(?: to you)? under(?: the)?(?: terms of the)? {name}", keyword, 4))
        tag = label.replace("-", " ").replace(".", " ")
        found.append((label, f"spdx license identifier {tag}(?: only| or later)?", "spdx", 5))
    return sorted(found, key=lambda r: -r[3])


def word_array(text: Column) -> Column:
    return F.filter(F.split(lower_ascii(text), "[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"), lambda w: w != "")


def _n_words(joined: Column) -> Column:
    """Words in a string where each has one space before it."""
    return F.char_length(joined) - F.char_length(F.replace(joined, F.lit(" "), F.lit("")))


def _detections(joined: Column, rule: Column) -> Column:
    """Intervals of words that a rule matches: the text is split around marked matches, lengths are summed."""
    marked = F.regexp_replace(joined, F.concat(F.lit("(?<= )(?:"), rule["pattern"], F.lit(")(?= )")), F.lit("\x01$0\x01"))
    parts = F.transform(F.split(marked, "\x01"), lambda p: F.char_length(p) - F.char_length(F.replace(p, F.lit(" "), F.lit(""))))
    empty = F.struct(F.lit(0).alias("at"), F.lit(0).alias("i"), F.lit(None).cast("array<struct<first:int,last:int>>").alias("found"))
    # Before a match stand as many spaces as words before it, plus the one in front of its first word.
    walked = F.aggregate(parts, empty, lambda acc, n: F.struct(
        (acc["at"] + n).alias("at"), (acc["i"] + 1).alias("i"),
        F.when(acc["i"] % 2 == 1, F.array_append(F.coalesce(acc["found"], F.array().cast("array<struct<first:int,last:int>>")), F.struct((acc["at"] - 1).alias("first"), (acc["at"] - 1 + n).alias("last")))).otherwise(acc["found"]).alias("found"),
    ))["found"]
    return F.transform(F.coalesce(walked, F.array().cast("array<struct<first:int,last:int>>")), lambda x: F.struct(x["first"].alias("first"), x["last"].alias("last"), rule["priority"].alias("priority"), rule["label"].alias("label")))


def _kept(hits: Column) -> Column:
    """Without the hits inside another of the same or a higher priority.

    Sorted by start, the longest first, a hit is inside an earlier one if that one's end is not before its own:
    the furthest end so far, per priority, is all that has to be known.
    """
    order = F.array_sort(hits, lambda a, b: F.when(a["first"] != b["first"], a["first"] - b["first"]).when(a["last"] != b["last"], b["last"] - a["last"]).when(a["priority"] != b["priority"], b["priority"] - a["priority"]).when(a["label"] < b["label"], -1).when(a["label"] > b["label"], 1).otherwise(0))
    kind = "array<struct<first:int,last:int,priority:int,label:string>>"
    start = F.struct(F.array_repeat(F.lit(-1), 5).alias("ends"), F.array().cast(kind).alias("kept"))

    def step(acc: Column, hit: Column) -> Column:
        inside = F.get(acc["ends"], hit["priority"] - 1) >= hit["last"]
        # ends[p] is the furthest end among hits of priority p + 1 or more
        ends = F.transform(acc["ends"], lambda e, p: F.when(p < hit["priority"], F.greatest(e, hit["last"])).otherwise(e))
        return F.struct(ends.alias("ends"), F.when(inside, acc["kept"]).otherwise(F.array_append(acc["kept"], hit)).alias("kept"))

    return F.aggregate(order, start, step)["kept"]


def scan(docs: DataFrame, extra: list[tuple[str, str, str, int]] | None = None) -> DataFrame:
    """doc_id, n_words, base (array of places per base phrase), detections, score for each row.

    ``detections`` are (first, last, priority, label) by word, from 0, both ends included, after
    suppression. ``score`` is the share of certainty: 1 - 0.5 ** (sum of the priorities of distinct labels).
    Null and empty texts have no words and score 0; rows that repeat a doc_id or a text
    each get their row; an empty table gives an empty result; extra columns are ignored.
    """
    every = rules() + (extra or [])
    table = F.from_json(F.lit(_json(every)), T.ArrayType(RULE_TYPE))
    keywords = F.array(*map(F.lit, sorted({k for _, _, k, _ in every})))
    joined = F.concat(F.lit(" "), F.array_join(F.col("words"), " "), F.lit(" "))
    rows = docs.select("doc_id", word_array(F.coalesce(F.col("text"), F.lit(""))).alias("words"))
    rows = rows.select("doc_id", F.size("words").alias("n_words"), joined.alias("joined"), F.array_intersect("words", keywords).alias("present"))
    places = F.array(*(
        F.struct(
            F.lit(label).alias("label"), F.size(parts := F.split(F.col("joined"), f" {phrase}(?= )")).alias("parts"),
            _n_words(F.element_at(parts, 1)).alias("first"),
            (F.col("n_words") - _n_words(F.element_at(parts, -1)) + 1 - len(phrase.split())).alias("last"),
        )
        for phrase, label in BASE
    ))
    applied = F.flatten(F.transform(F.filter(table, lambda r: F.array_contains(F.col("present"), r["keyword"])), lambda r: _detections(F.col("joined"), r)))
    none = F.array().cast("array<struct<first:int,last:int,priority:int,label:string>>")
    found = rows.select(
        "doc_id", "n_words", F.filter(places, lambda p: p["parts"] > 1).alias("base"),
        F.when(F.size("present") > 0, _kept(applied)).otherwise(none).alias("detections"),
    )
    strength = F.aggregate(
        F.array_distinct(F.transform("detections", lambda d: F.struct(d["label"].alias("label"), d["priority"].alias("priority")))),
        F.lit(0), lambda acc, d: acc + d["priority"],
    )
    return found.withColumn("score", 1 - F.pow(F.lit(0.5), strength.cast("double")))


def _json(every: list[tuple[str, str, str, int]]) -> str:
    return json.dumps([dict(zip(("label", "pattern", "keyword", "priority"), r)) for r in every])


def digest(found: DataFrame) -> DataFrame:
    """The columns of the registered query."""
    base = F.col("base")
    count = F.aggregate(base, F.lit(0), lambda acc, p: acc + p["parts"] - 1)
    labels = F.transform(base, lambda p: p["label"])
    joined = lambda names: F.array_join(F.array_sort(F.array_distinct(names)), ",")
    return found.select(
        "doc_id", F.col("n_words").cast("long").alias("n_words"), count.cast("long").alias("n_base"),
        F.array_min(F.transform(base, lambda p: p["first"])).cast("long").alias("first_word"),
        F.array_max(F.transform(base, lambda p: p["last"])).cast("long").alias("last_word"),
        joined(labels).alias("base_labels"),
        joined(F.concat(labels, F.transform("detections", lambda d: d["label"]))).alias("labels"),
        F.when(F.size(base) > 0, F.greatest("score", F.lit(0.5))).otherwise(F.col("score")).alias("score"),
    )
