"""Licence notices by ordered signature rules.

A rule is a regular expression over the lower-cased words of a text, joined by single
spaces, with a keyword that every match holds. Only texts with a rule's keyword are
searched by it. Rules have a priority; a detection that lies inside the words of one
of higher priority (or of the same and longer, or an earlier rule) is suppressed.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tapewire.llm.tokens import text_chunks
from tapewire.llm.words import CHUNK_BYTES, byte_table, split_words

GAPS = byte_table((0x00, 0x2F), (0x3A, 0x60), (0x7B, 0x7F))  # fixed values: what parts words, after lower-casing

# Phrases every place of which is reported, and their labels.
BASE = (("cc by", "cc-by"), ("general public license", "gpl"), ("all rights reserved", "reserved"))

# Certainty of a detection by priority: 3 own wording of a licence, 2 explicit grant or
# identifier, 1 name of a licence in a licensing context, 0 general notice.
CERTAINTY = (0.3, 0.6, 0.85, 0.95)


@dataclass(frozen=True)
class Rule:
    label: str
    pattern: str
    keyword: str
    priority: int


# Name of a licence as words, its label, and the word every mention holds.
NAMES = (
    ("apache-2.0", r"apache(?: software)? licen[cs]e(?: version)? 2(?: 0)?", "apache"),
    ("apache-1.1", r"apache(?: software)? licen[cs]e(?: version)? 1 1", "apache"),
    ("apache-1.0", r"apache(?: software)? licen[cs]e(?: version)? 1 0", "apache"),
    ("mit", r"(?:mit|expat)(?: x11)? licen[cs]e", "mit|expat"),
    ("bsd-2-clause", r"(?:simplified|2 clause|two clause|freebsd) bsd(?: style)? licen[cs]e", "bsd"),
    ("bsd-3-clause", r"(?:new|modified|revised|3 clause|three clause) bsd(?: style)? licen[cs]e", "bsd"),
    ("bsd-4-clause", r"(?:original|old|4 clause|four clause) bsd(?: style)? licen[cs]e", "bsd"),
    ("gpl-1.0", r"gnu (?:gpl|general public licen[cs]e)(?: version| v)? 1(?: 0)?", "gnu"),
    ("gpl-2.0", r"gnu (?:gpl|general public licen[cs]e)(?: version| v)? 2(?: 0)?", "gnu"),
    ("gpl-3.0", r"gnu (?:gpl|general public licen[cs]e)(?: version| v)? 3(?: 0)?", "gnu"),
    ("lgpl-2.0", r"gnu (?:lgpl|library general public licen[cs]e)(?: version| v)? 2(?: 0)?", "gnu"),
    ("lgpl-2.1", r"gnu (?:lgpl|lesser general public licen[cs]e)(?: version| v)? 2 1", "gnu"),
    ("lgpl-3.0", r"gnu (?:lgpl|lesser general public licen[cs]e)(?: version| v)? 3(?: 0)?", "gnu"),
    ("agpl-3.0", r"(?:gnu )?affero general public licen[cs]e(?: version| v)? 3(?: 0)?", "affero"),
    ("agpl-1.0", r"affero general public licen[cs]e(?: version| v)? 1(?: 0)?", "affero"),
    ("gfdl-1.2", r"gnu free documentation licen[cs]e(?: version| v)? 1 2", "documentation"),
    ("gfdl-1.3", r"gnu free documentation licen[cs]e(?: version| v)? 1 3", "documentation"),
    ("mpl-1.1", r"mozilla public licen[cs]e(?: version| v)? 1 1", "mozilla"),
    ("mpl-2.0", r"mozilla public licen[cs]e(?: version| v)? 2(?: 0)?", "mozilla"),
    ("epl-1.0", r"eclipse public licen[cs]e(?: version| v)? 1(?: 0)?", "eclipse"),
    ("epl-2.0", r"eclipse public licen[cs]e(?: version| v)? 2(?: 0)?", "eclipse"),
    ("cddl-1.0", r"common development and distribution licen[cs]e(?: version)?(?: 1(?: 0)?)?", "development"),
    ("cpl-1.0", r"common public licen[cs]e(?: version)?(?: 1(?: 0)?)?", "common"),
    ("eupl-1.2", r"european union public licen[cs]e(?: version| v)?(?: 1 2)?", "european"),
    ("isc", r"isc licen[cs]e", "isc"),
    ("zlib", r"zlib(?: libpng)? licen[cs]e", "zlib"),
    ("bsl-1.0", r"boost software licen[cs]e(?: version)?(?: 1(?: 0)?)?", "boost"),
    ("artistic-1.0", r"artistic licen[cs]e(?: version)? 1(?: 0)?", "artistic"),
    ("artistic-2.0", r"artistic licen[cs]e(?: version)? 2(?: 0)?", "artistic"),
    ("unlicense", r"(?:the )?unlicen[cs]e", "unlicense|unlicence"),
    ("wtfpl", r"(?:wtfpl|do what the f\w* you want to public licen[cs]e)", "wtfpl|want"),
    ("python-2.0", r"python software foundation licen[cs]e(?: version)?(?: 2(?: 0)?)?", "python"),
    ("php-3.01", r"php licen[cs]e(?: version)?(?: 3 01)?", "php"),
    ("ruby", r"ruby licen[cs]e", "ruby"),
    ("openssl", r"openssl licen[cs]e", "openssl"),
    ("postgresql", r"postgresql licen[cs]e", "postgresql"),
    ("ms-pl", r"microsoft public licen[cs]e", "microsoft"),
    ("ms-rl", r"microsoft reciprocal licen[cs]e", "microsoft"),
    ("ofl-1.1", r"(?:sil )?open font licen[cs]e(?: version)?(?: 1 1)?", "font"),
    ("odbl-1.0", r"open(?: data commons open)? database licen[cs]e(?: version)?(?: v?1(?: 0)?)?", "database"),
    ("odc-by-1.0", r"open data commons attribution licen[cs]e", "commons"),
    ("pddl-1.0", r"(?:open data commons )?public domain dedication and licen[cs]e", "dedication"),
    ("upl-1.0", r"universal permissive licen[cs]e(?: version| v)?(?: 1(?: 0)?)?", "permissive"),
    ("vim", r"vim licen[cs]e", "vim"),
    ("x11", r"x11 licen[cs]e", "x11"),
    ("ncsa", r"university of illinois ncsa open source licen[cs]e", "ncsa"),
    ("osl-3.0", r"open software licen[cs]e(?: version| v)?(?: 3(?: 0)?)?", "open"),
    ("afl-3.0", r"academic free licen[cs]e(?: version| v)?(?: 3(?: 0)?)?", "academic"),
    ("qpl-1.0", r"q public licen[cs]e(?: version)?(?: 1(?: 0)?)?", "q"),
    ("sspl-1.0", r"server side public licen[cs]e(?: version| v)?(?: 1(?: 0)?)?", "server"),
    ("busl-1.1", r"business source licen[cs]e(?: version)?(?: 1 1)?", "business"),
    ("elastic-2.0", r"elastic licen[cs]e(?: version)?(?: 2(?: 0)?)?", "elastic"),
    ("llama", r"llama (?:\d )*community licen[cs]e(?: agreement)?", "llama"),
    ("rail", r"(?:open ?)?rail(?: m| d| s)? licen[cs]e", "rail|openrail"),
    ("cc-by-4.0", r"creative commons attribution (?:4 0|licen[cs]e 4 0|4 0 international)(?: licen[cs]e)?", "creative"),
    ("cc-by-3.0", r"creative commons attribution (?:3 0|licen[cs]e 3 0|3 0 unported)(?: licen[cs]e)?", "creative"),
    ("cc-by-sa-4.0", r"creative commons attribution share ?alike 4 0(?: international)?(?: licen[cs]e)?", "creative"),
    ("cc-by-sa-3.0", r"creative commons attribution share ?alike 3 0(?: unported)?(?: licen[cs]e)?", "creative"),
    ("cc-by-nc-4.0", r"creative commons attribution non ?commercial 4 0(?: international)?(?: licen[cs]e)?", "creative"),
    ("cc-by-nd-4.0", r"creative commons attribution no ?deriv(?:ative)?s 4 0(?: international)?(?: licen[cs]e)?", "creative"),
    ("cc-by-nc-sa-4.0", r"creative commons attribution non ?commercial share ?alike 4 0(?: international)?(?: licen[cs]e)?", "creative"),
    ("cc-by-nc-nd-4.0", r"creative commons attribution non ?commercial no ?deriv(?:ative)?s 4 0(?: international)?(?: licen[cs]e)?", "creative"),
    ("cc0-1.0", r"(?:creative commons zero|cc0)(?: v?1 0)?(?: universal)?(?: licen[cs]e)?", "creative|cc0"),
)

# Contexts in which a name grants or points, and their priority.
GRANTS = (
    (r"(?:is |are )?(?:distributed|released|published|available|licen[cs]ed|provided|covered)(?: to you)? (?:under|by|with)(?: the)?(?: terms of)?(?: the)? {}", 2),
    (r"(?:subject to|in accordance with|governed by|according to)(?: the)?(?: terms of)?(?: the)? {}", 2),
    (r"(?:see|read|refer to)(?: the)? {}", 1),
    (r"{}", 1),
)

# Identifiers as words; a tag before one makes it explicit.
TAGS = (
    "apache 2 0", "mit", "isc", "bsd 2 clause", "bsd 3 clause", "bsd 4 clause", "gpl 1 0", "gpl 2 0", "gpl 3 0",
    "lgpl 2 0", "lgpl 2 1", "lgpl 3 0", "agpl 3 0", "mpl 1 1", "mpl 2 0", "epl 1 0", "epl 2 0", "cddl 1 0",
    "cc0 1 0", "cc by 3 0", "cc by 4 0", "cc by sa 3 0", "cc by sa 4 0", "cc by nc 4 0", "cc by nd 4 0",
    "cc by nc sa 4 0", "cc by nc nd 4 0", "zlib", "bsl 1 0", "unlicense", "wtfpl", "ofl 1 1", "odbl 1 0", "artistic 2 0",
)

# Wording of licences and notices: label, pattern, a word every match holds, priority.
WORDING = (
    ("mit", r"permission is hereby granted free of charge to any person obtaining a copy of this software(?: and associated documentation files)?", "granted", 3),
    ("mit", r"the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software", "substantial", 3),
    ("isc", r"permission to use copy modify and(?: or)? distribute this software for any purpose with or without fee is hereby granted", "purpose", 3),
    ("0bsd", r"permission to use copy modify and(?: or)? distribute this software for any purpose with or without fee is hereby granted the software is provided as is", "purpose", 3),
    ("bsd", r"redistribution and use in source and binary forms with or without modification are permitted", "redistribution", 3),
    ("bsd", r"redistributions of source code must retain the above copyright notice this list of conditions", "redistributions", 3),
    ("bsd", r"redistributions in binary form must reproduce the above copyright notice", "redistributions", 3),
    ("bsd-3-clause", r"neither the name(?: of)? (?:[^ ]+ ){1,12}?nor the names of its contributors may be used to endorse or promote products", "endorse", 3),
    ("bsd-4-clause", r"all advertising materials mentioning features or use of this software must display the following acknowledge?ment", "advertising", 3),
    ("apache-2.0", r"you may not use this file except in compliance with the licen[cs]e", "compliance", 3),
    ("apache-2.0", r"unless required by applicable law or agreed to in writing software distributed under the licen[cs]e", "applicable", 3),
    ("apache-2.0", r"licen[cs]ed to the apache software foundation asf under one or more contributor licen[cs]e agreements", "asf", 3),
    ("gpl", r"this program is free software you can redistribute it and or modify it under the terms of the gnu general public licen[cs]e", "redistribute", 3),
    ("gpl-2.0-or-later", r"gnu general public licen[cs]e as published by the free software foundation either version 2 of the licen[cs]e or (?:at your option )?any later version", "foundation", 3),
    ("gpl-3.0-or-later", r"gnu general public licen[cs]e as published by the free software foundation either version 3 of the licen[cs]e or (?:at your option )?any later version", "foundation", 3),
    ("gpl-2.0-only", r"gnu general public licen[cs]e as published by the free software foundation version 2", "foundation", 3),
    ("gpl", r"you should have received a copy of the gnu general public licen[cs]e", "received", 3),
    ("lgpl", r"this library is free software you can redistribute it and or modify it under the terms of the gnu (?:lesser|library) general public licen[cs]e", "library", 3),
    ("lgpl", r"you should have received a copy of the gnu (?:lesser|library) general public licen[cs]e", "received", 3),
    ("agpl", r"gnu affero general public licen[cs]e as published by the free software foundation", "affero", 3),
    ("agpl", r"you should have received a copy of the gnu affero general public licen[cs]e", "affero", 3),
    ("gfdl", r"permission is granted to copy distribute and or modify this document under the terms of the gnu free documentation licen[cs]e", "document", 3),
    ("mpl-2.0", r"this source code form is subject to the terms of the mozilla public licen[cs]e v 2 0", "mozilla", 3),
    ("mpl-1.1", r"the contents of this file are subject to the mozilla public licen[cs]e version 1 1", "mozilla", 3),
    ("epl", r"this program and the accompanying materials are made available under the terms of the eclipse public licen[cs]e", "eclipse", 3),
    ("cddl-1.0", r"the contents of this file are subject to the terms of the common development and distribution licen[cs]e", "development", 3),
    ("zlib", r"this software is provided as is without any express or implied warranty in no event will the authors be held liable", "authors", 3),
    ("zlib", r"altered source versions must be plainly marked as such and must not be misrepresented as being the original software", "altered", 3),
    ("bsl-1.0", r"permission is hereby granted free of charge to any person or organization obtaining a copy of the software and accompanying documentation", "organization", 3),
    ("unlicense", r"this is free and unencumbered software released into the public domain", "unencumbered", 3),
    ("unlicense", r"anyone is free to copy modify publish use compile sell or distribute this software", "anyone", 3),
    ("wtfpl", r"everyone is permitted to copy and distribute verbatim or modified copies of this licen[cs]e document", "verbatim", 3),
    ("gpl", r"everyone is permitted to copy and distribute verbatim copies of this licen[cs]e document but changing it is not allowed", "verbatim", 3),
    ("ofl-1.1", r"this font software is licen[cs]ed under the sil open font licen[cs]e version 1 1", "font", 3),
    ("cc-by", r"(?:this|the) (?:work|article|text|content) is licen[cs]ed under (?:a|the) creative commons attribution(?: \d 0)?(?: international| unported)? licen[cs]e", "creative", 3),
    ("cc-by-sa", r"(?:this|the) (?:work|article|text|content) is licen[cs]ed under (?:a|the) creative commons attribution share ?alike(?: \d 0)?(?: international| unported)? licen[cs]e", "creative", 3),
    ("cc-by-sa", r"(?:text|content) is available under the creative commons attribution share ?alike licen[cs]e", "creative", 3),
    ("cc-by", r"creative commons attribution licen[cs]e which permits (?:unrestricted )?use", "creative", 3),
    ("cc-by-nc", r"creative commons attribution non ?commercial licen[cs]e", "creative", 2),
    ("cc-by-nc", r"cc by nc(?: \d 0)?", "cc", 2),
    ("cc-by-nd", r"cc by nd(?: \d 0)?", "cc", 2),
    ("cc-by-sa", r"cc by sa(?: \d 0)?", "cc", 2),
    ("cc-by-nc-sa", r"cc by nc sa(?: \d 0)?", "cc", 2),
    ("cc-by-nc-nd", r"cc by nc nd(?: \d 0)?", "cc", 2),
    ("cc-by", r"cc by(?: \d 0)?", "cc", 1),
    ("cc0-1.0", r"(?:to the extent possible under law )(?:[^ ]+ ){1,10}?(?:has|have) waived all copyright and related or neighboring rights", "waived", 3),
    ("cc-by", r"creativecommons org licen[cs]es by \d 0", "creativecommons", 2),
    ("cc-by-sa", r"creativecommons org licen[cs]es by sa \d 0", "creativecommons", 2),
    ("cc-by-nc", r"creativecommons org licen[cs]es by nc \d 0", "creativecommons", 2),
    ("cc-by-nd", r"creativecommons org licen[cs]es by nd \d 0", "creativecommons", 2),
    ("cc-by-nc-sa", r"creativecommons org licen[cs]es by nc sa \d 0", "creativecommons", 2),
    ("cc-by-nc-nd", r"creativecommons org licen[cs]es by nc nd \d 0", "creativecommons", 2),
    ("cc0-1.0", r"creativecommons org publicdomain zero 1 0", "creativecommons", 2),
    ("apache-2.0", r"(?:www )?apache org licen[cs]es licen[cs]e 2 0", "apache", 2),
    ("mit", r"opensource org licen[cs]es mit(?: licen[cs]e php)?", "opensource", 2),
    ("bsd", r"opensource org licen[cs]es bsd(?: licen[cs]e php| \d clause)?", "opensource", 2),
    ("gpl", r"(?:www )?gnu org (?:licen[cs]es|copyleft) gpl(?: \d 0)?(?: html| txt)?", "gnu", 2),
    ("lgpl", r"(?:www )?gnu org (?:licen[cs]es|copyleft) lgpl(?: \d \d)?(?: html| txt)?", "gnu", 2),
    ("mpl-2.0", r"mozilla org mpl 2 0", "mpl", 2),
    ("gpl", r"gnu (?:gpl|general public licen[cs]e)", "gnu", 1),
    ("gpl", r"general public licen[cs]e", "public", 1),
    ("gpl", r"gpl(?:v| v)? ?[123](?: 0)?(?: or later| plus)?", "gpl|gpl1|gpl2|gpl3|gplv|gplv1|gplv2|gplv3", 1),
    ("lgpl", r"(?:gnu )?(?:lesser|library) general public licen[cs]e", "lesser|library", 1),
    ("lgpl", r"lgpl(?:v| v)? ?[23](?: [01])?", "lgpl|lgpl2|lgpl3|lgplv|lgplv2|lgplv3", 1),
    ("agpl", r"(?:gnu )?affero general public licen[cs]e", "affero", 1),
    ("agpl", r"agpl(?:v| v)? ?3(?: 0)?", "agpl|agpl3|agplv|agplv3", 1),
    ("bsd", r"bsd(?: style)? licen[cs]e", "bsd", 1),
    ("apache", r"apache(?: software)? licen[cs]e", "apache", 1),
    ("mpl", r"mozilla public licen[cs]e", "mozilla", 1),
    ("epl", r"eclipse public licen[cs]e", "eclipse", 1),
    ("artistic", r"artistic licen[cs]e", "artistic", 1),
    ("creative-commons", r"creative commons(?: licen[cs]e)?", "creative", 0),
    ("public-domain", r"(?:placed|released|dedicated)(?: in| into| to)? the public domain", "domain", 2),
    ("public-domain", r"(?:is|are) in the public domain", "domain", 2),
    ("public-domain", r"public domain(?: mark| work)?", "domain", 0),
    ("reserved", r"all rights (?:are )?reserved", "reserved", 1),
    ("reserved", r"(?:some|no) rights reserved", "reserved", 0),
    ("proprietary", r"(?:strictly )?(?:proprietary and confidential|confidential and proprietary)", "proprietary", 2),
    ("proprietary", r"unauthori[sz]ed (?:copying|use|reproduction|distribution)(?: [^ ]+){0,8}? is strictly prohibited", "prohibited", 2),
    ("proprietary", r"may not be (?:reproduced|copied|distributed)(?: [^ ]+){0,8}? without(?: the)?(?: prior)?(?: express)? written (?:permission|consent)", "written", 2),
    ("commercial", r"commercial licen[cs]e(?: agreement)?", "commercial", 1),
    ("eula", r"end user licen[cs]e agreement", "agreement", 2),
    ("eula", r"by (?:installing|downloading|using) (?:this|the) software you (?:agree|accept)", "agree|accept", 2),
    ("noncommercial", r"(?:for )?non ?commercial (?:use|purposes)(?: only)?", "noncommercial|commercial", 1),
    ("research-only", r"(?:for )?research(?: and educational)? (?:use|purposes) only", "research", 1),
    ("no-derivatives", r"no derivative works", "derivative", 0),
    ("warranty-disclaimer", r"(?:this|the) software is provided as is without warranty of any kind", "warranty", 0),
    ("warranty-disclaimer", r"without any warranty without even the implied warranty of merchantability", "merchantability", 0),
    ("warranty-disclaimer", r"in no event shall the (?:authors|copyright holders?|contributors)(?: [^ ]+){0,6}? be liable", "liable", 0),
    ("copyright", r"copyright c? ?(?:19|20)\d\d(?: (?:19|20)\d\d)?", "copyright", 0),
    ("licensed", r"licen[cs]ed under the [a-z0-9]+(?: [a-z0-9]+){0,4}? licen[cs]e", "licensed|licenced", 0),
)


def rules() -> list[Rule]:
    """All rules in order: wording first, then every name in every context, then identifiers."""
    out = [Rule(label, pattern, keyword, priority) for label, pattern, keyword, priority in WORDING]
    for label, name, keyword in NAMES:
        out += [Rule(label, context.format(f"(?:{name})"), keyword, priority) for context, priority in GRANTS]
    for tag in TAGS:
        parts = tag.split()
        version = len(parts) - sum(p.isdigit() for p in parts)
        label = "-".join(parts[:version]) + ("-" + ".".join(parts[version:]) if version < len(parts) else "")
        if "clause" in parts:
            label = "-".join(parts)
        out.append(Rule(label, rf"spdx licen[cs]e identifier {tag}(?: only| or later)?", "spdx", 3))
        out.append(Rule(label, rf"licen[cs]e {tag}(?: only| or later)?", "license|licence", 1))
    return out


@dataclass(frozen=True)
class Book:
    """All rules ready for use: patterns that begin and end at words, keywords, and the numbers of each rule's."""

    rules: list[Rule]
    patterns: list[re.Pattern]
    keywords: list[bytes]
    needed: list[set[int]]


@cache
def book() -> Book:
    found = rules()
    keywords = sorted({k.encode() for r in found for k in r.keyword.split("|")})
    needed = [{keywords.index(k.encode()) for k in r.keyword.split("|")} for r in found]
    return Book(found, [re.compile(rf"(?<![^ ])(?:{r.pattern})(?![^ ])", re.ASCII) for r in found], keywords, needed)


def detect(text: str, which: list[int]) -> list[tuple[int, int, int]]:
    """(first word, end word, rule) of the detections of the rules `which` that are not suppressed."""
    patterns, found = book().patterns, book().rules
    spaces = np.flatnonzero(np.frombuffer(text.encode("utf-32-le"), np.uint32) == 32)
    marks = [(m.start(), m.end(), r) for r in which for m in patterns[r].finditer(text)]
    if not marks:
        return []
    first = np.searchsorted(spaces, [m[0] for m in marks])
    end = np.searchsorted(spaces, [m[1] for m in marks]) + 1
    spans = zip(first.tolist(), end.tolist(), [m[2] for m in marks])
    # Every span that holds another one comes before it, and a suppressed span lies in one
    # that holds all it holds, so the farthest end so far of each priority decides.
    kept, reach = [], [0] * len(CERTAINTY)
    for b, e, r in sorted(spans, key=lambda s: (s[0], -s[1], -found[s[2]].priority, s[2])):
        own = found[r].priority
        if max(reach[own:]) < e:
            kept.append((b, e, r))
        reach[own] = max(reach[own], e)
    return kept


SCHEMA = (
    "doc_id long, n_words long, base array<struct<label:string,first:long>>, "
    "found array<struct<label:string,first:long,end:long,priority:int>>, score double"
)


def scan_licenses(documents: DataFrame) -> DataFrame:
    """doc_id, n_words, base phrases, detections that are not suppressed, and the score of every whole text.

    Needs doc_id and text; other columns are not read. Words are stretches of ASCII
    letters and digits and of any other characters beyond ASCII, A-Z lower-cased. A
    null or empty text has no words, nothing found and a score of 0. Repeated rows are
    judged one by one; an empty table gives no row. Positions are word numbers from 0,
    `end` is exclusive. The score is the chance that one detection holds if each holds
    with the certainty of its priority. There is no shuffle.
    """

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk in text_chunks(batch, "text", CHUNK_BYTES):
                yield scan_chunk(chunk)

    return documents.selectExpr("CAST(doc_id AS BIGINT) AS doc_id", "text").mapInArrow(scan, SCHEMA)


def phrase_places(numbers: np.ndarray, of: np.ndarray, phrase: list[int]) -> np.ndarray:
    """Places where the numbered words of `phrase` stand consecutively inside one row."""
    last = len(numbers) - len(phrase) + 1
    if last <= 0 or -1 in phrase:
        return np.zeros(0, np.int64)
    at = np.flatnonzero(numbers[:last] == phrase[0])
    for k, word in enumerate(phrase[1:], 1):
        at = at[numbers[at + k] == word]
    return at[of[at] == of[at + len(phrase) - 1]]


def scan_chunk(chunk: pa.RecordBatch) -> pa.RecordBatch:
    words = split_words(chunk["text"], GAPS, lower=True)
    sizes = np.diff(words.bounds)
    of = np.repeat(np.arange(len(sizes)), sizes)
    number = {w: i for i, w in enumerate(words.distinct.to_pylist())}
    base: list[list[dict]] = [[] for _ in sizes]
    for phrase, label in BASE:
        for at in phrase_places(words.numbers, of, [number.get(w.encode(), -1) for w in phrase.split()]).tolist():
            base[of[at]].append({"label": label, "first": at - int(words.bounds[of[at]])})
    # Keywords that a row has, from one look at the numbers of its words.
    rule = book()
    column = np.full(len(number), -1, np.int64)
    for i, k in enumerate(rule.keywords):
        if k in number:
            column[number[k]] = i
    key = column[words.numbers] if len(number) else np.zeros(0, np.int64)
    hits = np.flatnonzero(key >= 0)
    rows: dict[int, set[int]] = {}
    for pair in np.unique(of[hits] * len(rule.keywords) + key[hits]).tolist():
        rows.setdefault(pair // len(rule.keywords), set()).add(pair % len(rule.keywords))
    detections: list[list[dict]] = [[] for _ in sizes]
    score = np.zeros(len(sizes))
    for row, has in rows.items():
        text = b" ".join(words.values[words.bounds[row] : words.bounds[row + 1]].to_pylist()).decode()
        kept = detect(text, [r for r, need in enumerate(rule.needed) if need & has])
        priorities = [rule.rules[r].priority for _, _, r in kept]
        detections[row] = [{"label": rule.rules[r].label, "first": b, "end": e, "priority": p} for (b, e, r), p in zip(kept, priorities)]
        score[row] = 1.0 - np.prod([1.0 - CERTAINTY[p] for p in priorities])
    kinds = [
        pa.list_(pa.struct([("label", pa.string()), ("first", pa.int64())])),
        pa.list_(pa.struct([("label", pa.string()), ("first", pa.int64()), ("end", pa.int64()), ("priority", pa.int32())])),
    ]
    columns = [chunk["doc_id"], pa.array(sizes), pa.array(base, kinds[0]), pa.array(detections, kinds[1]), pa.array(score)]
    return pa.RecordBatch.from_arrays(columns, ["doc_id", "n_words", "base", "found", "score"])
