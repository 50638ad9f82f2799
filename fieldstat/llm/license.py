"""Operator 3: license scan by ordered signature rules (DataFrame functions only).

Hand-written signatures of license names are put into forms (an SPDX tag, a
grant such as "licensed under ...", a version, a bare mention); passages of license
texts, headers, short names and addresses have signatures of their own. That gives
over five hundred ordered rules of one regular expression each. A text is looked
at by the rules, with its white space made single spaces, only if it holds one
of a few stems, and by a rule only if it holds the rule's keyword. Detections
that lie inside one of equal or higher priority are suppressed; of equal
intervals the higher priority stays. The base scan looks at every text's words.

All of it happens within the row: nothing is shuffled.

Defined results: null and empty texts have no words, no labels and score 0;
rows are independent of each other, so repeated rows give equal results;
columns that the input has under the names of the result's columns are
replaced; an empty table gives no rows.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldstat.llm.tables import ascii_lower, n_words, word_line

# Fixed phrases of the base scan, with their labels.
BASE = (("gnu general public license", "gpl"), ("apache license", "apache"), ("cc by", "cc-by"),
        ("mit license", "mit"))

# Signatures: label, keyword (literal, lower case), expression for the name. Written by hand.
NAMES = (
    ("0bsd", "bsd", r"(?:0bsd|bsd zero clause|zero[- ]clause bsd)"),
    ("afl", "academic free", r"academic free licen[cs]e"),
    ("agpl", "affero", r"(?:gnu )?affero general public licen[cs]e"),
    ("apache", "apache", r"apache (?:software )?licen[cs]e"),
    ("apsl", "apple public", r"apple public source licen[cs]e"),
    ("artistic", "artistic", r"(?:perl )?artistic licen[cs]e"),
    ("beerware", "beer", r"beer-?ware licen[cs]e"),
    ("blueoak", "blue oak", r"blue oak model licen[cs]e"),
    ("bsd-2-clause", "bsd", r"(?:simplified bsd|freebsd|bsd[- ]2[- ]clause|2[- ]clause bsd)(?: licen[cs]e)?"),
    ("bsd-3-clause", "bsd", r"(?:new bsd|modified bsd|revised bsd|bsd[- ]3[- ]clause|3[- ]clause bsd)(?: licen[cs]e)?"),
    ("bsd-4-clause", "bsd", r"(?:original bsd|bsd[- ]4[- ]clause|4[- ]clause bsd)(?: licen[cs]e)?"),
    ("bsd", "bsd", r"bsd(?:-style)? licen[cs]e"),
    ("bsl", "boost", r"boost software licen[cs]e"),
    ("busl", "business source", r"business source licen[cs]e"),
    ("cc0", "cc0", r"cc0(?: 1\.0)?(?: universal)?"),
    ("cc0", "zero", r"creative commons zero"),
    ("cddl", "common development", r"common development and distribution licen[cs]e"),
    ("cecill", "cecill", r"cecill(?:-[bc])?(?: free software)?(?: licen[cs]e)"),
    ("clear-bsd", "clear bsd", r"clear bsd licen[cs]e"),
    ("commons-clause", "commons clause", r"commons clause licen[cs]e"),
    ("cpal", "common public attribution", r"common public attribution licen[cs]e"),
    ("cpl", "common public", r"common public licen[cs]e"),
    ("curl", "curl", r"curl licen[cs]e"),
    ("ecl", "educational community", r"educational community licen[cs]e"),
    ("efl", "eiffel forum", r"eiffel forum licen[cs]e"),
    ("elastic", "elastic", r"elastic licen[cs]e"),
    ("epl", "eclipse", r"eclipse (?:public|distribution) licen[cs]e"),
    ("eupl", "european union", r"european union public licen[cs]e"),
    ("fair", "fair", r"fair licen[cs]e"),
    ("ftl", "freetype", r"freetype (?:project )?licen[cs]e"),
    ("gfdl", "documentation", r"(?:gnu )?free documentation licen[cs]e"),
    ("gpl", "general public", r"(?:gnu )?general public licen[cs]e"),
    ("hpnd", "historical permission", r"historical permission notice and disclaimer licen[cs]e"),
    ("imagemagick", "imagemagick", r"imagemagick licen[cs]e"),
    ("ipa", "ipa font", r"ipa font licen[cs]e"),
    ("ipl", "ibm", r"ibm public licen[cs]e"),
    ("isc", "isc", r"\bisc licen[cs]e"),
    ("lgpl", "lesser", r"(?:gnu )?lesser general public licen[cs]e"),
    ("lgpl", "library general", r"(?:gnu )?library general public licen[cs]e"),
    ("libpng", "libpng", r"libpng licen[cs]e"),
    ("lppl", "latex", r"latex project public licen[cs]e"),
    ("miros", "miros", r"miros licen[cs]e"),
    ("mit", "mit", r"\bmit licen[cs]e"),
    ("mit-0", "mit", r"\bmit[- ](?:0|no attribution)(?: licen[cs]e)?"),
    ("mit", "expat", r"\bexpat licen[cs]e"),
    ("mpl", "mozilla", r"mozilla public licen[cs]e"),
    ("ms-pl", "microsoft", r"microsoft public licen[cs]e"),
    ("ms-rl", "microsoft", r"microsoft reciprocal licen[cs]e"),
    ("mulan", "mulan", r"mulan permissive software licen[cs]e"),
    ("ncsa", "ncsa", r"(?:university of illinois/?)?ncsa(?: open source)? licen[cs]e"),
    ("nasa", "nasa", r"nasa open source(?: agreement)? licen[cs]e"),
    ("ntp", "ntp", r"\bntp licen[cs]e"),
    ("odbl", "open database", r"open (?:data commons open )?database licen[cs]e"),
    ("odc-by", "open data commons", r"open data commons attribution licen[cs]e"),
    ("ofl", "open font", r"(?:sil )?open font licen[cs]e"),
    ("ogl", "open government", r"open government licen[cs]e"),
    ("openrail", "openrail", r"(?:bigscience )?openrail(?:-m)? licen[cs]e"),
    ("openssl", "openssl", r"openssl licen[cs]e"),
    ("osl", "open software", r"open software licen[cs]e"),
    ("php", "php", r"\bphp licen[cs]e"),
    ("polyform", "polyform", r"polyform [a-z]{3,16} licen[cs]e"),
    ("postgresql", "postgresql", r"postgresql licen[cs]e"),
    ("pddl", "public domain dedication", r"public domain dedication and licen[cs]e"),
    ("public-domain", "public domain", r"(?:released|placed|dedicated|put) (?:in)?to the public domain"),
    ("python", "python", r"python (?:software foundation )?licen[cs]e"),
    ("qpl", "q public", r"\bq public licen[cs]e"),
    ("rpl", "reciprocal public", r"reciprocal public licen[cs]e"),
    ("ruby", "ruby", r"\bruby licen[cs]e"),
    ("sissl", "sun industry", r"sun industry standards source licen[cs]e"),
    ("sleepycat", "sleepycat", r"sleepycat licen[cs]e"),
    ("spl", "sun public", r"sun public licen[cs]e"),
    ("sspl", "server side", r"server side public licen[cs]e"),
    ("unlicense", "unlicense", r"\bunlicense\b"),
    ("upl", "universal permissive", r"universal permissive licen[cs]e"),
    ("vim", "vim", r"\bvim licen[cs]e"),
    ("w3c", "w3c", r"w3c(?: software)?(?: notice and)? licen[cs]e"),
    ("wtfpl", "wtfpl", r"\bwtfpl\b"),
    ("wxwindows", "wxwindows", r"wxwindows library licen[cs]e"),
    ("x11", "x11", r"\bx11 licen[cs]e"),
    ("zlib", "zlib", r"zlib(?:/libpng)? licen[cs]e"),
    ("zpl", "zope", r"zope public licen[cs]e"),
)
# Other signatures: passages of license texts, headers, short names and addresses. Written by hand.
BODIES = (
    ("mit", "permission is hereby granted", r"permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation"),
    ("mit", "without restriction", r"to deal in the software without restriction, including without limitation the rights to use, copy, modify"),
    ("mit", "above copyright notice", r"the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software"),
    ("isc", "permission to use", r"permission to use, copy, modify,? and(?:/or)? distribute this software for any purpose with or without fee is hereby granted"),
    ("hpnd", "permission to use", r"permission to use, copy, modify,? and distribute this software and its documentation for any purpose"),
    ("bsd", "redistribution and use", r"redistribution and use in source and binary forms, with or without modification, are permitted"),
    ("bsd", "redistributions of source", r"redistributions of source code must retain the above copyright notice"),
    ("bsd", "redistributions in binary", r"redistributions in binary form must reproduce the above copyright notice"),
    ("bsd-3-clause", "endorse or promote", r"may be used to endorse or promote products derived from this software without specific prior written permission"),
    ("bsd-4-clause", "advertising materials", r"all advertising materials mentioning features or use of this software must display"),
    ("gpl", "free software", r"is free software[;:,] you can redistribute it and/or modify it under the terms of the gnu general public licen[cs]e"),
    ("lgpl", "free software", r"is free software[;:,] you can redistribute it and/or modify it under the terms of the gnu lesser general public licen[cs]e"),
    ("agpl", "free software", r"is free software[;:,] you can redistribute it and/or modify it under the terms of the gnu affero general public licen[cs]e"),
    ("gpl", "general public license", r"you should have received a copy of the gnu general public licen[cs]e along with"),
    ("lgpl", "lesser general public", r"you should have received a copy of the gnu lesser general public licen[cs]e along with"),
    ("agpl", "affero general public", r"you should have received a copy of the gnu affero general public licen[cs]e along with"),
    ("gpl", "copyleft", r"everyone is permitted to copy and distribute verbatim copies of this license document, but changing it is not allowed"),
    ("apache-2.0", "in compliance with the license", r"you may not use this (?:file|work|software) except in compliance with the license"),
    ("apache-2.0", "limitations under the license", r"see the license for the specific language governing permissions and limitations under the license"),
    ("apache-2.0", "apache.org/licenses", r"apache\.org/licenses/license-2\.0"),
    ("apache-1.1", "apache.org/licenses", r"apache\.org/licenses/license-1\.1"),
    ("mpl-2.0", "source code form", r"this source code form is subject to the terms of the mozilla public license, v\. 2\.0"),
    ("mpl-2.0", "mozilla.org/mpl", r"mozilla\.org/(?:en-us/)?mpl/2\.0"),
    ("mpl-1.1", "mozilla.org/mpl", r"mozilla\.org/mpl/(?:mpl-)?1\.1"),
    ("epl-1.0", "eclipse.org/legal", r"eclipse\.org/legal/epl-v10"),
    ("epl-2.0", "eclipse.org/legal", r"eclipse\.org/legal/epl-(?:v20|2\.0)"),
    ("bsl-1.0", "boost.org", r"boost\.org/license_1_0\.txt"),
    ("bsl-1.0", "boost", r"use, reproduce, display, distribute, execute, and transmit the software"),
    ("zlib", "as-is", r"this software is provided 'as-is', without any express or implied warranty"),
    ("zlib", "misrepresented", r"the origin of this software must not be misrepresented; you must not claim that you wrote the original software"),
    ("unlicense", "unencumbered", r"this is free and unencumbered software released into the public domain"),
    ("unlicense", "unlicense.org", r"unlicense\.org"),
    ("wtfpl", "what the", r"you just do what the fuck you want to"),
    ("wtfpl", "wtfpl.net", r"wtfpl\.net"),
    ("cc0-1.0", "creativecommons.org/publicdomain", r"creativecommons\.org/publicdomain/zero/1\.0"),
    ("public-domain", "creativecommons.org/publicdomain", r"creativecommons\.org/publicdomain/mark/1\.0"),
    ("beerware", "buy me a beer", r"you can buy me a beer in return"),
    ("artistic-2.0", "perlfoundation.org", r"perlfoundation\.org/artistic_license_2_0"),
    ("ofl-1.1", "scripts.sil.org", r"scripts\.sil\.org/ofl"),
    ("ofl", "reserved font name", r"with reserved font names?"),
    ("ecl-2.0", "opensource.org", r"opensource\.org/licenses/ecl-2\.0"),
    ("mit", "opensource.org", r"opensource\.org/licen[cs]es?/mit"),
    ("isc", "opensource.org", r"opensource\.org/licen[cs]es?/isc"),
    ("bsd-2-clause", "opensource.org", r"opensource\.org/licen[cs]es?/bsd-2-clause"),
    ("bsd-3-clause", "opensource.org", r"opensource\.org/licen[cs]es?/bsd-3-clause"),
    ("apache-2.0", "opensource.org", r"opensource\.org/licen[cs]es?/apache-2\.0"),
    ("gpl-2", "gnu.org/licenses", r"gnu\.org/licenses/(?:old-licenses/)?gpl-2\.0"),
    ("gpl-3", "gnu.org/licenses", r"gnu\.org/licenses/gpl-3\.0"),
    ("lgpl-2.1", "gnu.org/licenses", r"gnu\.org/licenses/(?:old-licenses/)?lgpl-2\.1"),
    ("lgpl-3", "gnu.org/licenses", r"gnu\.org/licenses/lgpl-3\.0"),
    ("agpl-3", "gnu.org/licenses", r"gnu\.org/licenses/agpl-3\.0"),
    ("gfdl", "gnu.org/licenses", r"gnu\.org/licenses/(?:old-licenses/)?fdl-1\.[1-3]"),
    ("gpl", "gnu.org/licenses", r"gnu\.org/licenses/gpl\b(?!-)"),
    ("sspl", "mongodb.com/licensing", r"mongodb\.com/licensing/server-side-public-license"),
    ("elastic", "elastic.co/licensing", r"elastic\.co/licensing/elastic-license"),
    ("odbl", "opendatacommons.org", r"opendatacommons\.org/licenses/odbl"),
    ("odc-by", "opendatacommons.org", r"opendatacommons\.org/licenses/by"),
    ("pddl", "opendatacommons.org", r"opendatacommons\.org/licenses/pddl"),
    ("gpl", "gpl", r"\bgnu gpl\b(?! ?v?[1-3])"),
    ("gpl", "gpl", r"\bgpl'?e?d\b|\bunder (?:the )?gpl\b"),
    ("gpl-2", "gpl", r"\b(?:gnu )?gpl[- ]?v?(?:ersion )?2(?:\.0)?\b\+?"),
    ("gpl-3", "gpl", r"\b(?:gnu )?gpl[- ]?v?(?:ersion )?3(?:\.0)?\b\+?"),
    ("lgpl", "lgpl", r"\b(?:gnu )?lgpl\b(?![- ]?v?[23])"),
    ("lgpl-2.1", "lgpl", r"\b(?:gnu )?lgpl[- ]?v?2\.1\b\+?"),
    ("lgpl-3", "lgpl", r"\b(?:gnu )?lgpl[- ]?v?3(?:\.0)?\b\+?"),
    ("agpl", "agpl", r"\b(?:gnu )?agpl\b(?![- ]?v?3)"),
    ("agpl-3", "agpl", r"\b(?:gnu )?agpl[- ]?v?3(?:\.0)?\b\+?"),
    ("apache-2.0", "apache", r"\bapache(?: license)?[- ]v?2(?:\.0)?\b"),
    ("apache-2.0", "asl", r"\basl[- ]?2\.0\b"),
    ("mpl-2.0", "mpl", r"\bmpl[- ]?v?2(?:\.0)?\b"),
    ("mpl-1.1", "mpl", r"\bmpl[- ]?v?1\.1\b"),
    ("epl-2.0", "epl", r"\bepl[- ]?v?2\.0\b"),
    ("epl-1.0", "epl", r"\bepl[- ]?v?1\.0\b"),
    ("cc-by-4.0", "creative commons", r"creative commons attribution(?: \(cc[- ]by\))? 4\.0"),
    ("cc-by-3.0", "creative commons", r"creative commons attribution(?: \(cc[- ]by\))? 3\.0"),
    ("cc-by-2.0", "creative commons", r"creative commons attribution 2\.0"),
    ("cc-by-sa-4.0", "creative commons", r"creative commons attribution[- ]share-?alike 4\.0"),
    ("cc-by-sa-3.0", "creative commons", r"creative commons attribution[- ]share-?alike 3\.0"),
    ("cc-by-nc-4.0", "creative commons", r"creative commons attribution[- ]non-?commercial 4\.0"),
    ("cc-by-nc-sa-4.0", "creative commons", r"creative commons attribution[- ]non-?commercial[- ]share-?alike 4\.0"),
    ("cc-by-nc-nd-4.0", "creative commons", r"creative commons attribution[- ]non-?commercial[- ]no-?deriv(?:ative)?s 4\.0"),
    ("cc-by-nd-4.0", "creative commons", r"creative commons attribution[- ]no-?deriv(?:ative)?s 4\.0"),
    ("cc-by", "creative commons", r"creative commons attribution(?! ?(?:[1-4]\.|[- ](?:share|non|no-?deriv)|\(cc))"),
    ("cc-by-sa", "creative commons", r"creative commons attribution[- ]share-?alike(?! ?[1-4]\.)"),
    ("cc-by-nc", "creative commons", r"creative commons attribution[- ]non-?commercial(?! ?[1-4]\.|[- ](?:share|no-?deriv))"),
    ("all-rights-reserved", "all rights reserved", r"\ball rights reserved\b"),
    ("proprietary", "proprietary", r"\bproprietary and confidential\b"),
)
# Versions that get a label of their own.
VERSIONED = (("gpl", ("1", "2", "3")), ("lgpl", ("2", "2.1", "3")), ("agpl", ("1", "3")),
             ("apache", ("1.0", "1.1", "2.0")), ("mpl", ("1.0", "1.1", "2.0")), ("epl", ("1.0", "2.0")),
             ("eupl", ("1.0", "1.1", "1.2")), ("afl", ("1.2", "2.1", "3.0")), ("osl", ("1.0", "2.1", "3.0")),
             ("artistic", ("1.0", "2.0")), ("cddl", ("1.0", "1.1")), ("gfdl", ("1.1", "1.2", "1.3")),
             ("bsl", ("1.0",)), ("ofl", ("1.0", "1.1")), ("ecl", ("1.0", "2.0")), ("zpl", ("1.1", "2.0", "2.1")),
             ("php", ("3.0", "3.01")), ("odbl", ("1.0",)), ("cpl", ("1.0",)), ("upl", ("1.0",)))
COMMONS = ("by", "by-sa", "by-nd", "by-nc", "by-nc-sa", "by-nc-nd")
COMMONS_VERSIONS = ("1.0", "2.0", "2.5", "3.0", "4.0")
GRANT = r"(?:licen[cs]ed|released|distributed|available|published|provided) under (?:the )?(?:terms of )?(?:the )?"
VERSION = r",?\s{1,3}(?:version |v)?"
# Priority of a form, and how sure a detection by it is.
MENTION, GRANTED, VERSIONS, TAG = 1, 2, 3, 4
SURE = {MENTION: 0.6, GRANTED: 0.8, VERSIONS: 0.9, TAG: 1.0}
BASE_SURE = 0.5
# A text with a detection holds one of these stems among its words (joined by single spaces).
STEMS = ("licenc", "licens", "public domain", "cc0", "cc by", "creative commons", "creativecommons", "wtfpl", "bsd", "mit 0", "mit no ",
         "spdx", "gpl", "apache", "mpl 1", "mpl 2", "mpl v", "mpl1", "mpl2", "mplv", "epl 1", "epl 2", "epl v", "epl1", "epl2", "eplv",
         "asl 2", "asl2", "opendatacommons", "sil org", "mozilla org", "eclipse org", "permission is hereby", "permission to use",
         "redistribution", "endorse or promote", "advertising materials", "copyright notice", "without restriction", "unencumbered",
         "misrepresented", "this software is provided", "buy me a beer", "reserved font", "perlfoundation", "boost org", "what the fuck",
         "rights reserved", "proprietary and", "use reproduce display")


def rules() -> list[tuple[str, int, str, str]]:
    """(label, priority, keyword, expression), in order of priority."""
    out = []
    names: dict[str, list[tuple[str, str]]] = {}
    for label, key, name in NAMES:
        names.setdefault(label, []).append((key, name))
        out.append((label, MENTION, key, name))
        out.append((label, GRANTED, key, GRANT + name))
    out += [(label, VERSIONS, key, rx) for label, key, rx in BODIES]
    for label, versions in VERSIONED:
        for key, name in names[label]:
            out += [(f"{label}-{v}", VERSIONS, key, f"(?:{GRANT})?{name}{VERSION}{re.escape(v)}(?![0-9]|\\.[0-9])")
                    for v in versions]
    for kind in COMMONS:
        words = kind.replace("-", "[- ]")
        plain = f"\\bcc[- ]{words}(?![- ](?:sa|nd|nc))"
        out.append((f"cc-{kind}", MENTION, "cc", plain))
        out.append((f"cc-{kind}", GRANTED, "cc", GRANT + plain))
        out += [(f"cc-{kind}-{v}", VERSIONS, "cc", f"(?:{GRANT})?\\bcc[- ]{words}[- ]{re.escape(v)}")
                for v in COMMONS_VERSIONS]
        out += [(f"cc-{kind}-{v}", VERSIONS, "creativecommons", f"creativecommons\\.org/licenses/{kind}/{re.escape(v)}")
                for v in COMMONS_VERSIONS]
    tags = sorted({x for x, *_ in out})
    out += [(x, TAG, "spdx-license-identifier", f"spdx-license-identifier:\\s{{0,3}}{re.escape(x)}"
             "(?:-clause)?(?:\\.0)?(?:-only|-or-later)?(?![a-z0-9.-])") for x in tags]
    return sorted(out, key=lambda r: -r[1])


_HIT = "array<struct<start:int,back:int,low:int,label:string>>"


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _spans(text: Column, rule: Column) -> Column:
    """Detections of one rule in a text: start, -end, -priority, label (sorted as wanted).

    Starts are running sums of the lengths between and of the hits. A fold that lists them copies its
    list at every hit, so the hits are folded in blocks of about the cube root of their number, and
    the blocks' sums in one more fold: the work is the number of hits to the power of 4/3."""
    found = F.regexp_extract_all(text, rule["rx"], F.lit(0))
    gaps = F.split(text, rule["rx"], -1)
    sizes = F.zip_with(found, gaps, lambda hit, gap: F.when(hit.isNotNull(), F.struct(
        F.char_length(gap).alias("gap"), F.char_length(hit).alias("hit"))))

    def listed(block: Column, offset: Column) -> Column:
        start = F.struct(offset.alias("at"), F.array().cast(_HIT).alias("out"))

        def step(acc: Column, x: Column) -> Column:
            begin = acc["at"] + x["gap"]
            end = begin + x["hit"]
            one = F.struct(begin.alias("start"), (-end).alias("back"), (-rule["priority"]).alias("low"), rule["label"].alias("label"))
            return F.struct(end.alias("at"), F.concat(acc["out"], F.array(one)).alias("out"))

        return F.aggregate(block, start, step, lambda acc: acc["out"])

    def offsets(blocks: Column) -> Column:
        start = F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("out"))
        length = lambda block: F.aggregate(block, F.lit(0), lambda n, x: n + x["gap"] + x["hit"])
        return F.aggregate(F.transform(blocks, length), start, lambda acc, n: F.struct(
            (acc["at"] + n).alias("at"), F.concat(acc["out"], F.array(acc["at"])).alias("out")), lambda acc: acc["out"])

    def in_blocks(hits: Column) -> Column:
        wide = F.ceil(F.cbrt(2.0 * F.size(hits))).cast("int")
        cut = F.transform(F.sequence(F.lit(1), F.size(hits), wide), lambda at: F.slice(hits, at, wide))
        return _let(cut, lambda blocks: F.flatten(F.zip_with(blocks, offsets(blocks), listed)))

    return _let(F.array_compact(sizes), lambda hits: F.when(F.size(hits) == 0, F.array().cast(_HIT)).otherwise(in_blocks(hits)))


def detections(text: Column) -> Column:
    """All detections in a lower-cased text, before suppression, in order of start."""
    listed = json.dumps([dict(zip(("label", "priority", "key", "rx"), r)) for r in rules()])
    table = F.from_json(F.lit(listed), "array<struct<label:string,priority:int,key:string,rx:string>>")
    mine = F.filter(table, lambda r: F.contains(text, r["key"]))
    return F.array_sort(F.flatten(F.transform(mine, lambda r: _spans(text, r))))


def surviving(hits: Column) -> Column:
    """Fold the sorted detections: labels, number and best score of those not suppressed.

    ``ends`` keeps, for each priority, how far detections of it or a higher one
    reach; as these start no later, reaching as far means containing.
    """
    levels = sorted(SURE)
    start = F.struct(F.array(*[F.lit(-1) for _ in levels]).alias("ends"), F.array().cast("array<string>").alias("labels"),
                     F.lit(0).alias("kept"), F.lit(0.0).alias("best"))
    sure = F.array(*[F.lit(SURE[k]) for k in levels])

    def step(acc: Column, x: Column) -> Column:
        end, priority = -x["back"], -x["low"]
        inside = F.element_at(acc["ends"], priority) >= end
        ends = F.transform(acc["ends"], lambda e, i: F.when((i < priority) & (e < end), end).otherwise(e))
        return F.struct(
            F.when(inside, acc["ends"]).otherwise(ends).alias("ends"),
            F.when(inside, acc["labels"]).otherwise(F.array_union(acc["labels"], F.array(x["label"]))).alias("labels"),
            (acc["kept"] + F.when(inside, 0).otherwise(1)).alias("kept"),
            F.when(inside, acc["best"]).otherwise(F.greatest(acc["best"], F.element_at(sure, priority))).alias("best"))

    return F.aggregate(hits, start, step)


def _base(line: Column, words: Column) -> dict[str, Column]:
    n, first, last, labels = [], [], [], []
    for phrase, label in BASE:
        has = F.contains(line, F.lit(phrase))
        parts = F.split(line, f"(?<![^ ]){phrase}(?![^ ])", -1)
        spaces = lambda c: F.octet_length(c) - F.octet_length(F.replace(c, F.lit(" "), F.lit("")))
        size = len(phrase.split())
        count = F.when(has, F.size(parts) - 1).otherwise(0)
        n.append(count)
        first.append(F.when(count > 0, spaces(F.element_at(parts, 1))))
        last.append(F.when(count > 0, words - spaces(F.element_at(parts, -1)) - size))
        labels.append(F.when(count > 0, F.lit(label)))
    return {"n_base": sum(n[1:], n[0]).cast("long"), "first_word": F.least(*first).cast("long"),
            "last_word": F.greatest(*last).cast("long"), "base": F.array_sort(F.array_compact(F.array(*labels)))}


def scan(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with n_words, n_base, first_word, last_word, base_labels, n_found, labels, score."""
    added = ("n_words", "n_base", "first_word", "last_word", "base_labels", "n_found", "labels", "score")
    text = F.col(text_col)
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns if c not in added]).alias("row"),
                       word_line(text).alias("line"), text.alias("text"))
    stemmed = reduce(lambda a, b: a | b, [F.contains("line", F.lit(x)) for x in STEMS])
    rows = rows.select("row", "line", F.when(stemmed, F.regexp_replace(ascii_lower(F.col("text")), r"\s+", " ")).alias("low"))
    # "line" and "low" are used more than once above, so the optimiser keeps them as columns.
    base = _base(F.col("line"), F.col("n"))
    empty = F.array().cast(_HIT)
    rows = rows.withColumn("n", n_words(F.col("line"))).select("row", "n", "line", "low", *[v.alias(k) for k, v in base.items()])
    rows = rows.withColumn("all", surviving(F.when(F.col("low").isNull(), empty).otherwise(detections(F.col("low")))))
    labels = F.col("base")
    out = {
        "n_words": F.col("n").cast("long"), "n_base": F.col("n_base").cast("long"),
        "first_word": F.col("first_word").cast("long"), "last_word": F.col("last_word").cast("long"),
        "base_labels": F.array_join(labels, ","), "n_found": F.col("all")["kept"].cast("long"),
        "labels": F.array_join(F.array_sort(F.array_union(labels, F.col("all")["labels"])), ","),
        "score": F.greatest(F.col("all")["best"], F.when(F.col("n_base") > 0, F.lit(BASE_SURE)).otherwise(F.lit(0.0)))}
    return rows.select(*[F.col("row").getField(c).alias(c) for c in docs.columns if c not in added],
                       *[v.alias(k) for k, v in out.items()])
