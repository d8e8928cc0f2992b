"""License scans by ordered signature rules over a text's words."""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import cache
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Bytes to bytes: A-Z in lower case, digits, a-z and bytes beyond ASCII stay, all else is a blank.
WORDS = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
#: Priorities: phrases that tell no license, full texts and tags, notices, names with a version, names, hints.
NOTHING, TEXT, NOTICE, VERSIONED, NAMED, HINT = range(6)
#: How sure a detection of a priority is.
SURE = (0.0, 1.0, 0.95, 0.9, 0.7, 0.3)

#: (label, phrase): the base rules, which nothing suppresses.
BASE = (("gpl", "gnu general public license"), ("apache", "apache license"), ("cc-by", "cc by"), ("mit", "mit license"))

#: (label, keyword, names, versions): families with versions; a name is a pattern over words that holds the keyword.
FAMILIES = (
    ("gpl", "gnu", "gnu general public licen[cs]e|gnu gpl", "1.0 2.0 3.0"),
    ("gpl", "gpl", "gpl|gplv(?=[123])", "1.0 2.0 3.0"),
    ("lgpl", "lesser", "(?:gnu )?lesser general public licen[cs]e", "2.1 3.0"),
    ("lgpl", "library general", "(?:gnu )?library general public licen[cs]e", "2.0"),
    ("lgpl", "lgpl", "(?:gnu )?lgpl|lgplv(?=[23])", "2.0 2.1 3.0"),
    ("agpl", "affero", "(?:gnu )?affero general public licen[cs]e", "1.0 3.0"),
    ("agpl", "agpl", "(?:gnu )?agpl|agplv(?=[13])", "1.0 3.0"),
    ("gfdl", "free documentation", "(?:gnu )?free documentation licen[cs]e", "1.1 1.2 1.3"),
    ("gfdl", "gfdl", "(?:gnu )?gfdl", "1.1 1.2 1.3"),
    ("apache", "apache", "apache(?: software)? licen[cs]e", "1.0 1.1 2.0"),
    ("apache", "apache", "apache", "1.0 1.1 2.0"),
    ("mpl", "mozilla", "mozilla public licen[cs]e", "1.0 1.1 2.0"),
    ("mpl", "mpl", "mpl", "1.0 1.1 2.0"),
    ("epl", "eclipse", "eclipse public licen[cs]e", "1.0 2.0"),
    ("epl", "epl", "epl", "1.0 2.0"),
    ("eupl", "european union", "european union public licen[cs]e", "1.0 1.1 1.2"),
    ("eupl", "eupl", "eupl", "1.0 1.1 1.2"),
    ("osl", "open software", "open software licen[cs]e", "1.0 2.0 2.1 3.0"),
    ("afl", "academic free", "academic free licen[cs]e", "1.1 1.2 2.0 2.1 3.0"),
    ("artistic", "artistic", "(?:the )?artistic licen[cs]e", "1.0 2.0"),
    ("artistic", "artistic", "artistic", "1.0 2.0"),
    ("cddl", "development and distribution", "common development and distribution licen[cs]e", "1.0 1.1"),
    ("cddl", "cddl", "cddl", "1.0 1.1"),
    ("cpl", "common public", "common public licen[cs]e", "1.0"),
    ("ofl", "open font", "(?:sil )?open font licen[cs]e", "1.0 1.1"),
    ("ofl", "ofl", "(?:sil )?ofl", "1.0 1.1"),
    ("lppl", "latex", "latex project public licen[cs]e", "1.0 1.1 1.2 1.3"),
    ("bsl", "boost", "boost software licen[cs]e", "1.0"),
    ("busl", "business source", "business source licen[cs]e", "1.0 1.1"),
    ("cecill", "cecill", "cecill(?: licen[cs]e)?", "1.0 1.1 2.0 2.1"),
    ("qpl", "public", "q public licen[cs]e", "1.0"),
    ("psf", "python software", "python software foundation licen[cs]e", "2.0"),
    ("php", "php", "php licen[cs]e", "3.0 3.01"),
    ("zpl", "zope", "zope public licen[cs]e", "1.1 2.0 2.1"),
    ("odbl", "open database", "(?:odc )?open database licen[cs]e", "1.0"),
    ("odbl", "odbl", "odbl", "1.0"),
    ("odc-by", "open data commons", "open data commons attribution licen[cs]e", "1.0"),
    ("ogl-uk", "open government", "open government licen[cs]e", "1.0 2.0 3.0"),
    ("sspl", "server side", "server side public licen[cs]e", "1.0"),
    ("elastic", "elastic", "elastic licen[cs]e", "2.0"),
    ("mulan", "mulan", "mulan (?:permissive software|psl)(?: licen[cs]e)?", "1.0 2.0"),
    ("upl", "universal permissive", "universal permissive licen[cs]e", "1.0"),
    ("unicode-dfs", "unicode", "unicode (?:inc )?licen[cs]e agreement data files and software", "2015 2016"),
)

#: The parts of Creative Commons licenses and their names in words.
COMMONS = (
    ("by", "attribution"),
    ("by-sa", "attribution share ?alike"),
    ("by-nd", "attribution no ?deriv(?:ative)?s?(?: works)?"),
    ("by-nc", "attribution non ?commercial"),
    ("by-nc-sa", "attribution non ?commercial share ?alike"),
    ("by-nc-nd", "attribution non ?commercial no ?deriv(?:ative)?s?(?: works)?"),
)
COMMONS_VERSIONS = "1.0 2.0 2.5 3.0 4.0"

#: (label, keyword, names): licenses that go without versions.
PLAIN = (
    ("mit", "mit", "(?:the )?mit(?: x11| x)?(?: open source)? licen[cs]e|mit x11"),
    ("mit-0", "attribution", "mit no attribution"),
    ("mit", "expat", "expat licen[cs]e"),
    ("bsd-4-clause", "bsd", "bsd 4 clause|4 clause bsd|four clause bsd|original bsd"),
    ("bsd-3-clause", "bsd", "bsd 3 clause|3 clause bsd|three clause bsd|new bsd|modified bsd|revised bsd"),
    ("bsd-2-clause", "bsd", "bsd 2 clause|2 clause bsd|two clause bsd|simplified bsd|freebsd licen[cs]e"),
    ("0bsd", "bsd", "0bsd|zero clause bsd|bsd zero clause"),
    ("bsd", "bsd", "bsd(?: style)? licen[cs]e"),
    ("bsd", "berkeley", "berkeley software distribution licen[cs]e"),
    ("isc", "isc", "isc licen[cs]e"),
    ("zlib", "zlib", "zlib(?: libpng)? licen[cs]e"),
    ("libpng", "libpng", "libpng licen[cs]e"),
    ("unlicense", "unlicense", "(?:the )?unlicense"),
    ("wtfpl", "wtfpl", "wtfpl"),
    ("cc0", "cc0", "cc0(?: 1 0)?(?: universal)?"),
    ("cc0", "creative commons zero", "creative commons zero"),
    ("public-domain", "public domain", "(?:dedicated|released|placed|is) (?:in|to|into) the public domain"),
    ("curl", "curl", "curl licen[cs]e"),
    ("ncsa", "illinois", "university of illinois (?:ncsa )?open source licen[cs]e"),
    ("ncsa", "ncsa", "ncsa open source licen[cs]e"),
    ("openssl", "openssl", "openssl licen[cs]e"),
    ("postgresql", "postgresql", "postgresql licen[cs]e"),
    ("ruby", "ruby", "ruby licen[cs]e"),
    ("perl", "perl", "same terms as perl itself"),
    ("vim", "vim", "vim licen[cs]e"),
    ("x11", "x11", "x11 licen[cs]e"),
    ("x11", "consortium", "x consortium licen[cs]e"),
    ("icu", "icu", "icu licen[cs]e"),
    ("beerware", "beer", "beer ?ware(?: licen[cs]e)?"),
    ("json", "json", "json licen[cs]e"),
    ("ms-pl", "microsoft public", "microsoft public licen[cs]e"),
    ("ms-rl", "microsoft reciprocal", "microsoft reciprocal licen[cs]e"),
    ("intel", "intel", "intel open source licen[cs]e"),
    ("ibm-public", "ibm", "ibm public licen[cs]e"),
    ("sleepycat", "sleepycat", "sleepycat licen[cs]e"),
    ("sun-public", "sun public", "sun public licen[cs]e"),
    ("w3c", "w3c", "w3c(?: software)?(?: notice and)? licen[cs]e"),
    ("ijg", "jpeg group", "independent jpeg group licen[cs]e"),
    ("freetype", "freetype", "freetype(?: project)? licen[cs]e"),
    ("imagemagick", "imagemagick", "imagemagick licen[cs]e"),
    ("naumen", "naumen", "naumen public licen[cs]e"),
    ("hpnd", "historical permission", "historical permission notice and disclaimer"),
    ("pddl", "dedication", "(?:open data commons )?public domain dedication and licen[cs]e"),
    ("free-art", "free art", "free art licen[cs]e"),
    ("free-art", "art libre", "licence art libre"),
    ("openrail", "openrail", "(?:creativeml |bigscience )?openrail(?: m)?(?: licen[cs]e)?"),
    ("llama", "llama", "llama (?:\\w+ )?community licen[cs]e"),
    ("proprietary", "proprietary", "proprietary (?:and confidential|licen[cs]e|software)"),
    ("commercial", "commercial", "commercial licen[cs]e(?: agreement)?"),
    ("eula", "end user", "end user licen[cs]e agreement"),
)

#: (label, keyword, pattern, priority): sentences of license texts, notices, tags, hints, and phrases that tell no license.
SIGNATURES = (
    ("mit", "hereby granted", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files", TEXT),
    ("mit", "above copyright notice", "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software", TEXT),
    ("isc", "permission to use", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted", TEXT),
    ("bsd", "redistribution and use", "redistribution and use in source and binary forms with or without modification are permitted", TEXT),
    ("bsd-3-clause", "endorse or promote", "neither the name of (?:\\S+ ){1,12}?(?:nor|or) the names of (?:its|their) contributors may be used to endorse or promote", TEXT),
    ("bsd-4-clause", "advertising materials", "all advertising materials mentioning features or use of this software must display the following acknowledg", TEXT),
    ("zlib", "express or implied", "this software is provided as is without any express or implied warranty in no event will the authors be held liable", TEXT),
    ("zlib", "misrepresented", "the origin of this software must not be misrepresented", TEXT),
    ("unlicense", "unencumbered", "this is free and unencumbered software released into the public domain", TEXT),
    ("wtfpl", "do what", "do what the fuck you want to(?: public license)?", TEXT),
    ("beerware", "buy me a beer", "you can buy me a beer in return", TEXT),
    ("gpl", "free software", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public licen[cs]e", TEXT),
    ("gpl-2.0", "june 1991", "gnu general public license version 2 june 1991", TEXT),
    ("gpl-3.0", "june 2007", "gnu general public license version 3 29 june 2007", TEXT),
    ("agpl-3.0", "november 2007", "gnu affero general public license version 3 19 november 2007", TEXT),
    ("lgpl", "free software", "this library is free software you can redistribute it and or modify it under the terms of the gnu (?:lesser|library) general public licen[cs]e", TEXT),
    ("gpl", "along with this program", "you should have received a copy of the gnu general public licen[cs]e along with this program", TEXT),
    ("lgpl", "along with this library", "you should have received a copy of the gnu (?:lesser|library) general public licen[cs]e along with this library", TEXT),
    ("gfdl", "free documentation", "permission is granted to copy distribute and or modify this document under the terms of the gnu free documentation licen[cs]e", TEXT),
    ("apache-2.0", "apache", "licensed under the apache license version 2 0 the license", TEXT),
    ("apache-2.0", "january 2004", "apache license version 2 0 january 2004", TEXT),
    ("apache-2.0", "compliance with the license", "you may not use this file except in compliance with the license", TEXT),
    ("mpl-2.0", "source code form", "this source code form is subject to the terms of the mozilla public license v 2 0", TEXT),
    ("epl", "accompanying materials", "this program and the accompanying materials are made available under the terms of the eclipse public license", TEXT),
    ("cddl", "development and distribution", "the contents of this file are subject to the terms of the common development and distribution license", TEXT),
    ("bsl-1.0", "boost", "distributed under the boost software license version 1 0", TEXT),
    ("ofl-1.1", "open font", "this font software is licensed under the sil open font license version 1 1", TEXT),
    ("artistic", "intent of this document", "the intent of this document is to state the conditions under which a package may be copied", TEXT),
    ("psf", "python software", "this license agreement is between the python software foundation", TEXT),
    ("hpnd", "permission to use", "permission to use copy modify and distribute this software and its documentation for any purpose", TEXT),
    ("ncsa", "deal with", "to deal with the software without restriction", TEXT),
    ("cc0", "waived all", "(?:has|have) waived all copyright and related or neighboring rights", TEXT),
    ("public-domain", "no rights reserved", "no rights reserved", NOTICE),
    ("mit", "mit", "mit licensed|mit style|licensed under mit", NOTICE),
    ("bsd", "bsd", "bsd licensed|licensed under(?: the)? bsd", NOTICE),
    ("gpl", "gpl", "gpl(?:ed| licensed| compatible)", NOTICE),
    ("gpl-mit-dual", "dual licensed", "dual licensed under (?:the )?(?:mit (?:and|or) gpl|gpl (?:and|or) mit)", NOTICE),
    ("unknown", "licensed", "(?:is|are) (?:re)?licensed under(?: the)?(?: terms of)?(?: the)?", HINT),
    ("unknown", "see the licen", "see the licen[cs]e(?: file)?(?: for (?:more )?details)?", HINT),
    ("unknown", "see licen", "see licen[cs]e(?: txt| md| file)?", HINT),
    ("copyright", "all rights reserved", "all rights reserved", HINT),
    ("copyright", "copyright", "copyright (?:c )?(?:19|20)\\d\\d(?: (?:19|20)\\d\\d)*", HINT),
    ("", "driver", "driver s? ?licen[cs]e", NOTHING),
    ("", "driving", "driving licen[cs]e", NOTHING),
    ("", "license plate", "license plates?", NOTHING),
    ("", "marriage", "marriage licen[cs]e", NOTHING),
    ("", "poetic", "poetic licen[cs]e", NOTHING),
    ("", "artistic", "(?:take|takes|took|taking|taken|with|of) artistic licen[cs]e", NOTHING),
    ("", "copyright", "(?:no|not|without) copyright infringement", NOTHING),
    ("", "gpl", "not (?:licensed |released )?under(?: the)? gpl", NOTHING),
)

#: What stands before a name in a notice.
UNDER = r"(?:(?:re)?licen[cs]ed|(?:re)?distributed|released|available|published|provided|covered|shared|work)(?: \S+){0,3}? (?:under|by|with)(?: (?:an?|the))?(?: terms of)?(?: the)? "


class Rule(NamedTuple):
    label: str
    keyword: str
    pattern: str
    priority: int
    base: bool = False


def _version(version: str) -> str:
    """A version after a name: 'version 2', 'v2.0', '2.0 or later' in words."""
    major, _, minor = version.partition(".")
    return rf"(?: licen[cs]e)?(?: (?:version|ver|v))? ?v?{major}" + (r"(?: 0)?(?! \d(?: |$))" if minor in ("", "0") else rf" {minor}") + r"(?: only| or (?:any )?later(?: version)?| or newer)?"


def _spdx(label: str) -> str:
    return rf"spdx license identifier {re.sub('[-.]', ' ', label)}(?: only| or later)?"


@cache
def rules() -> tuple[Rule, ...]:
    """All rules, in order: the base phrases, then the tables' rows in each form in which they stand."""
    found = [Rule(label, phrase.split()[0], phrase, NAMED, True) for label, phrase in BASE]
    found += [Rule(*row) for row in SIGNATURES]
    for label, keyword, names, versions in FAMILIES:
        for version in versions.split():
            found += [Rule(f"{label}-{version}", keyword, f"{UNDER}(?:{names}){_version(version)}", NOTICE), Rule(f"{label}-{version}", keyword, f"(?:{names}){_version(version)}", VERSIONED)]
            found.append(Rule(f"{label}-{version}", "spdx", _spdx(f"{label}-{version}"), TEXT))
        if "licen" in names or label in ("gpl", "lgpl", "agpl"):
            found.append(Rule(label, keyword, "|".join(n for n in names.split("|") if "(?=" not in n), NAMED))
    for parts, said in COMMONS:
        short = parts.replace("-", " ")
        for version in COMMONS_VERSIONS.split():
            number = version.replace(".", " ")
            label = f"cc-{parts}-{version}"
            found += [Rule(label, "cc by", f"{UNDER}cc {short}(?: licen[cs]e)? {number}", NOTICE), Rule(label, "cc by", f"cc {short}(?: licen[cs]e)? {number}", VERSIONED)]
            found += [Rule(label, "creative commons", f"creative commons {said}(?: {number}|(?: licen[cs]e)? version {number})", VERSIONED), Rule(label, "creativecommons", f"creativecommons org licenses {short} {number}", TEXT)]
            found.append(Rule(label, "spdx", _spdx(label), TEXT))
        found += [Rule(f"cc-{parts}", "cc by", f"cc {short}", NAMED), Rule(f"cc-{parts}", "creative commons", f"creative commons {said}", NAMED)]
    for label, keyword, names in PLAIN:
        found += [Rule(label, keyword, f"{UNDER}(?:{names})", NOTICE), Rule(label, keyword, names, NAMED), Rule(label, "spdx", _spdx(label), TEXT)]
    return tuple(found)


class Scanner:
    """The rules compiled, by keyword."""

    def __init__(self, ordered: tuple[Rule, ...]):
        self.rules = ordered
        self.by: dict[bytes, list[tuple[int, re.Pattern[bytes]]]] = {}
        for i, r in enumerate(ordered):
            self.by.setdefault(r.keyword.encode(), []).append((i, re.compile(rf"(?<![^ ])(?:{r.pattern})(?![^ ])".encode())))

    def detect(self, words: bytes) -> list[tuple[int, int, int]]:
        """(start, end, rule) in bytes of all matches in words joined by blanks; only rules whose keyword occurs are asked."""
        return [(m.start(), m.end(), i) for keyword, asked in self.by.items() if keyword in words for i, pattern in asked for m in pattern.finditer(words)]

    def resolve(self, found: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
        """The detections that stay, by start: a base phrase always; another unless one of the same or a stronger priority holds its whole interval (of equal intervals the first rule's stays).

        One sweep: of what began before, the farthest end of each priority tells.
        """
        order = sorted(found, key=lambda x: (x[0], -x[1], self.rules[x[2]].priority, x[2]))
        farthest, kept = [-1] * (HINT + 1), []
        for start, end, i in order:
            rule = self.rules[i]
            if rule.base or max(farthest[: rule.priority + 1]) < end:
                kept.append((start, end, i))
            farthest[rule.priority] = max(farthest[rule.priority], end)
        return kept

    def scan(self, text: bytes) -> tuple[int, list[dict]]:
        """The number of a text's words, and what is found in them; places are in words, end exclusive."""
        words = text.translate(WORDS).split()
        joined, said, at, n = b" ".join(words), [], 0, 0
        for start, end, i in self.resolve(self.detect(joined)):
            n, at = n + joined.count(b" ", at, start), start
            rule = self.rules[i]
            if rule.label:
                said.append({"label": rule.label, "rule": i, "start": n, "end": n + joined.count(b" ", start, end) + 1, "base": rule.base, "score": SURE[rule.priority]})
        return len(words), said


FOUND = pa.list_(pa.struct([("label", pa.string()), ("rule", pa.int32()), ("start", pa.int64()), ("end", pa.int64()), ("base", pa.bool_()), ("score", pa.float64())]))
SCHEMA = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_base", pa.int64()), ("first_word", pa.int64()), ("last_word", pa.int64()), ("base_labels", pa.string()), ("labels", pa.string()), ("score", pa.float64()), ("found", FOUND)])


def _told(said: list[dict]) -> tuple:
    base = [x for x in said if x["base"]]
    names = lambda xs: ",".join(sorted({x["label"] for x in xs}))
    return len(base), base[0]["start"] if base else None, base[-1]["start"] if base else None, names(base), names(said), max((x["score"] for x in said), default=0.0)


def scan_licenses(docs: DataFrame, ordered: tuple[Rule, ...] | None = None) -> DataFrame:
    """Licenses that each whole text names or holds: ``docs`` (doc_id, text) to doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score, found.

    ``found`` holds the detections that ``Scanner.resolve`` keeps (label, rule, start and end in words, end exclusive, base,
    score), by start; the base phrases' number, first and last start and labels, and all labels, are told from it.
    Labels are distinct, sorted and comma-joined; score is that of the surest detection, 0 without any. ``ordered`` are the
    rules, ``rules()`` by default. Null texts are empty; repeated rows and null ids stay; other columns are ignored;
    an empty table gives an empty result.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(rules() if ordered is None else ordered)
        for batch in batches:
            for k in range(0, batch.num_rows, 1000):
                rows = [(i, n, *_told(said), said) for i, (n, said) in ((i, scanner.scan(t.as_py())) for i, t in zip(batch.column(0)[k : k + 1000].to_pylist(), batch.column(1)[k : k + 1000], strict=True))]
                yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*rows, strict=True), SCHEMA, strict=True)], schema=SCHEMA)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).cast("binary").alias("text"))
    kinds = "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, found array<struct<label:string,rule:int,start:long,end:long,base:boolean,score:double>>"
    return rows.mapInArrow(run, kinds)
