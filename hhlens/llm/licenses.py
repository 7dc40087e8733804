"""License scan: ordered signature rules with a keyword prefilter.

A text is lower-cased (A-Z) and cut into words of digits, a-z and non-ASCII characters; the
rules are regular expressions over its words joined by single spaces, so spelling of dashes,
line breaks and punctuation does not matter ("CC-BY-SA 4.0" reads "cc by sa 4 0").

Rules come from the families below (names, identifiers, addresses, versions) and from
hand-written body and clue signatures.  Each rule names a word that every match contains (or
several, one of which it contains); it runs only on texts that have it.  Matches are resolved
by priority:

1. a match that overlaps one of a higher priority that stays is dropped;
2. among equal priorities, one whose interval lies inside another's is dropped (of equal
   intervals the earlier rule stays).

The base phrases are counted at every place, whatever is dropped, and their labels stay.
The score is 1 - product of (1 - weight of a kept label's best priority).

Defined cases: null and empty texts have no words, null places and score 0; texts are read
whole, one at a time; repeated rows each get their row; other columns are ignored.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

# The base phrases and their labels.
BASE = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

SPDX, BODY, GRANT, NAMED, MENTION, CLUE = 5, 4, 3, 2, 1, 0
WEIGHT = {SPDX: 0.99, BODY: 0.95, GRANT: 0.9, NAMED: 0.75, MENTION: 0.5, CLUE: 0.2}

LATER = r"(?: or (?:any )?later(?: version)?| or at your option any later version| plus)?"
VERSION = r"(?: version| v| ver| release)?"
LICENCE = r"licen[cs]e"

#: label: (word of every match, identifier, names, words of its address)
FAMILIES: dict[str, tuple[str, str, list[str], str | None]] = {
    "mit": ("mit", "mit", [rf"(?:the )?mit(?: x11| x)? {LICENCE}", rf"mit style {LICENCE}"], "licenses mit"),
    "mit-0": ("mit", "mit 0", [rf"mit no attribution(?: {LICENCE})?"], "licenses mit 0"),
    "expat": ("expat", "expat", [rf"expat {LICENCE}"], "licenses expat"),
    "isc": ("isc", "isc", [rf"isc {LICENCE}"], "licenses isc"),
    "x11": ("x11", "x11", [rf"x11 {LICENCE}"], "licenses x11"),
    "bsd-2-clause": ("bsd", "bsd 2 clause", [rf"(?:simplified|freebsd) bsd(?: {LICENCE})?", rf"bsd (?:2|two) clause(?: {LICENCE})?", rf"(?:2|two) clause bsd(?: {LICENCE})?"], "licenses bsd 2 clause"),
    "bsd-3-clause": ("bsd", "bsd 3 clause", [rf"(?:new|modified|revised) bsd(?: {LICENCE})?", rf"bsd (?:3|three) clause(?: {LICENCE})?", rf"(?:3|three) clause bsd(?: {LICENCE})?"], "licenses bsd 3 clause"),
    "bsd-4-clause": ("bsd", "bsd 4 clause", [rf"(?:original|old) bsd(?: {LICENCE})?", rf"bsd (?:4|four) clause(?: {LICENCE})?", rf"(?:4|four) clause bsd(?: {LICENCE})?"], "licenses bsd 4 clause"),
    "0bsd": ("0bsd", "0bsd", [rf"0bsd {LICENCE}"], "licenses 0bsd"),
    "bsd": ("bsd", "bsd", [rf"bsd(?: style)? {LICENCE}"], "licenses bsd license"),
    "apache-1.1": ("apache", "apache 1 1", [rf"apache(?: software)? {LICENCE}{VERSION} 1 1"], "licenses license 1 1"),
    "apache-2.0": ("apache", "apache 2(?: 0)?", [rf"apache(?: software)? {LICENCE}{VERSION} (?:2 0|2|v2)", r"apache (?:2 0|v2)"], "licenses license 2 0"),
    "apache": ("apache", "apache", [rf"apache(?: software)? {LICENCE}"], "apache org licenses"),
    "gpl-1.0": ("general", r"gpl 1 0(?: only| or later)?", [rf"gnu general public {LICENCE}{VERSION} 1(?: 0)?{LATER}"], "licenses gpl 1 0"),
    "gpl-2.0": ("general", r"gpl 2 0(?: only| or later)?", [rf"(?:gnu )?general public {LICENCE}(?: as published by the free software foundation)?(?: either)?{VERSION} (?:2 0|2){LATER}"], None),
    "gpl-3.0": ("general", r"gpl 3 0(?: only| or later)?", [rf"(?:gnu )?general public {LICENCE}(?: as published by the free software foundation)?(?: either)?{VERSION} (?:3 0|3){LATER}"], None),
    "gpl2": ("gplv2", r"gplv2", [rf"(?:gnu )?gplv2{LATER}"], "licenses gplv2"),
    "gpl3": ("gplv3", r"gplv3", [rf"(?:gnu )?gplv3{LATER}"], "licenses gplv3"),
    "gpl-any": ("gpl", r"gpl(?: [123] 0)?(?: only| or later)?", [rf"(?:gnu )?gpl(?:{VERSION} [123](?: 0)?)?{LATER}"], "licenses gpl(?: [123] 0)?(?: html)?"),
    "gpl-plain": ("general", "gnu gpl", [rf"gnu general public {LICENCE}"], None),
    "lgpl-2.0": ("library", r"lgpl 2 0(?: only| or later)?", [rf"gnu library general public {LICENCE}(?:{VERSION} 2(?: 0)?)?{LATER}"], None),
    "lgpl-2.1": ("lesser", r"lgpl 2 1(?: only| or later)?", [rf"(?:gnu )?lesser general public {LICENCE}(?: as published by the free software foundation)?(?: either)?{VERSION} 2 1{LATER}"], None),
    "lgpl-3.0": ("lesser", r"lgpl 3 0(?: only| or later)?", [rf"(?:gnu )?lesser general public {LICENCE}(?: as published by the free software foundation)?(?: either)?{VERSION} 3(?: 0)?{LATER}"], None),
    "lgpl": ("lesser", "lgpl", [rf"(?:gnu )?lesser general public {LICENCE}"], None),
    "lgpl-any": ("lgpl", r"lgpl(?: 2 [01]| 3 0)?(?: only| or later)?", [rf"(?:gnu )?lgpl(?:{VERSION} (?:2 [01]|3(?: 0)?))?{LATER}"], "licenses lgpl(?: html)?"),
    "agpl-3.0": ("affero", "affero", [rf"(?:gnu )?affero general public {LICENCE}(?:{VERSION} 3(?: 0)?)?{LATER}"], None),
    "agpl": ("agpl", r"agpl(?: [13] 0)?(?: only| or later)?", [rf"(?:gnu )?agpl(?:{VERSION} [13](?: 0)?)?{LATER}"], "licenses agpl(?: html)?"),
    "gfdl": ("documentation", "gfdl", [rf"gnu free documentation {LICENCE}(?:{VERSION} 1 [123])?{LATER}"], None),
    "gfdl-any": ("gfdl|fdl", r"gfdl 1 [123](?: only| or later)?", [r"gnu (?:gfdl|fdl)"], "licenses fdl"),
    "mpl-1.0": ("mozilla", "mpl 1 0", [rf"mozilla public {LICENCE}{VERSION} 1 0"], "mpl 1 0"),
    "mpl-1.1": ("mozilla", "mpl 1 1", [rf"mozilla public {LICENCE}{VERSION} 1 1"], "mpl 1 1"),
    "mpl-2.0": ("mozilla", "mpl 2 0", [rf"mozilla public {LICENCE}{VERSION} 2 0"], "mpl 2 0"),
    "mpl": ("mpl", r"mpl(?: [12] [01])?", [rf"mpl{VERSION} [12] [01]"], "mozilla org mpl"),
    "mozilla": ("mozilla", "mozilla", [rf"mozilla public {LICENCE}"], None),
    "epl-1.0": ("eclipse", "epl 1 0", [rf"eclipse public {LICENCE}{VERSION} 1 0"], "legal epl v10"),
    "epl-2.0": ("eclipse", "epl 2 0", [rf"eclipse public {LICENCE}{VERSION} 2 0"], "legal epl 2 0"),
    "epl": ("epl", r"epl(?: [12] 0)?", [rf"epl{VERSION} [12] 0"], None),
    "edl-1.0": ("eclipse", "edl 1 0", [rf"eclipse distribution {LICENCE}{VERSION} 1 0"], "documents edl v10"),
    "cddl-1.0": ("cddl", "cddl 1 [01]", [rf"cddl{VERSION} 1 [01]"], "licenses cddl"),
    "cddl": ("distribution", "cddl", [rf"common development and distribution {LICENCE}(?:{VERSION} 1 [01])?"], None),
    "cpl-1.0": ("common", "cpl 1 0", [rf"common public {LICENCE}(?:{VERSION} 1 0)?"], None),
    "cpal-1.0": ("attribution", "cpal 1 0", [rf"common public attribution {LICENCE}(?:{VERSION} 1 0)?"], None),
    "ipl-1.0": ("ibm", "ipl 1 0", [rf"ibm public {LICENCE}(?:{VERSION} 1 0)?"], None),
    "artistic-1.0": ("artistic", "artistic 1 0", [rf"artistic {LICENCE}{VERSION} 1 0", rf"perl artistic {LICENCE}"], "artistic license 1 0"),
    "artistic-2.0": ("artistic", "artistic 2 0", [rf"artistic {LICENCE}{VERSION} 2 0"], "artistic license 2 0"),
    "artistic": ("artistic", "artistic", [rf"artistic {LICENCE}"], None),
    "bsl-1.0": ("boost", "bsl 1 0", [rf"boost software {LICENCE}(?:{VERSION} 1 0)?"], "boost org license 1 0"),
    "busl-1.1": ("business", "busl 1 1", [rf"business source {LICENCE}(?:{VERSION} 1 1)?"], "mariadb com bsl11"),
    "sspl-1.0": ("server", "sspl 1 0", [rf"server side public {LICENCE}(?:{VERSION} 1)?"], None),
    "elastic-2.0": ("elastic", "elastic 2 0", [rf"elastic {LICENCE}(?:{VERSION} 2 0)?"], "elastic co licensing elastic license"),
    "zlib": ("zlib", "zlib", [rf"zlib(?: libpng)? {LICENCE}"], "licenses zlib"),
    "libpng": ("libpng", "libpng(?: 2 0)?", [rf"libpng {LICENCE}"], None),
    "openssl": ("openssl", "openssl", [rf"openssl(?: ssleay)? {LICENCE}"], "openssl org source license"),
    "python-2.0": ("python", "python 2 0", [rf"python(?: software foundation)? {LICENCE}(?:{VERSION} 2)?"], "python org psf license"),
    "psf-2.0": ("psf", "psf 2 0", [rf"psf {LICENCE}"], None),
    "ruby": ("ruby", "ruby", [rf"ruby(?: s)? {LICENCE}"], "ruby lang org en about license"),
    "php-3.01": ("php", "php 3 0(?:1)?", [rf"php {LICENCE}(?:{VERSION} 3 01)?"], "php net license"),
    "unlicense": ("unlicense", "unlicense", [r"the unlicense"], "unlicense org"),
    "wtfpl": ("wtfpl|fuck", "wtfpl", [rf"wtfpl(?:{VERSION} 2)?", rf"do what the fuck you want to public {LICENCE}"], "wtfpl net"),
    "cc0-1.0": ("cc0", "cc0(?: 1 0)?", [r"(?:creative commons )?cc0(?: 1 0)?(?: universal)?"], "publicdomain zero 1 0"),
    "ccpdm-1.0": ("publicdomain", "pddc", [r"publicdomain mark 1 0"], "publicdomain mark 1 0"),
    "odbl-1.0": ("odbl", "odbl 1 0", [rf"odbl(?:{VERSION} 1 0)?", rf"open database {LICENCE} odbl"], "opendatacommons org licenses odbl"),
    "odc-by-1.0": ("odc", "odc by 1 0", [r"odc by(?: 1 0)?"], "opendatacommons org licenses by"),
    "pddl-1.0": ("pddl", "pddl 1 0", [r"pddl(?: 1 0)?"], "opendatacommons org licenses pddl"),
    "ofl-1.1": ("ofl", "ofl 1 [01]", [rf"sil ofl(?:{VERSION} 1 [01])?"], "scripts sil org ofl"),
    "sil-ofl": ("sil", "sil ofl", [rf"sil open font {LICENCE}(?:{VERSION} 1 [01])?"], None),
    "ncsa": ("ncsa", "ncsa", [rf"(?:university of illinois )?ncsa open source {LICENCE}", rf"ncsa {LICENCE}"], None),
    "ms-pl": ("microsoft", "ms pl", [rf"microsoft public {LICENCE}"], None),
    "ms-rl": ("reciprocal", "ms rl", [rf"microsoft reciprocal {LICENCE}"], None),
    "eupl-1.2": ("eupl", "eupl 1 [012]", [rf"eupl(?:{VERSION} 1 [012])?"], None),
    "eupl": ("union", "eupl", [rf"european union public {LICENCE}(?:{VERSION} 1 [012])?"], None),
    "cecill": ("cecill", "cecill(?: [bc12])?(?: [01])?", [rf"cecill(?: [bc])?(?: {LICENCE})?"], "cecill info"),
    "osl-3.0": ("open", "osl 3 0", [rf"open software {LICENCE}{VERSION} [123] [01]"], None),
    "afl-3.0": ("academic", "afl 3 0", [rf"academic free {LICENCE}(?:{VERSION} [123] [012])?"], None),
    "ecl-2.0": ("educational", "ecl [12] 0", [rf"educational community {LICENCE}(?:{VERSION} [12] 0)?"], None),
    "upl-1.0": ("universal", "upl 1 0", [rf"universal permissive {LICENCE}(?:{VERSION} 1 0)?"], None),
    "qpl-1.0": ("qpl", "qpl 1 0", [r"qpl(?: 1 0)?"], None),
    "w3c": ("w3c", "w3c", [rf"w3c software(?: notice and)? {LICENCE}"], None),
    "vim": ("vim", "vim", [rf"vim {LICENCE}"], None),
    "tcl": ("tcl", "tcl", [rf"tcl tk {LICENCE}"], None),
    "postgresql": ("postgresql", "postgresql", [rf"postgresql {LICENCE}"], None),
    "nasa-1.3": ("nasa", "nasa 1 3", [rf"nasa open source agreement(?:{VERSION} 1 3)?"], None),
    "ijg": ("jpeg", "ijg", [rf"independent jpeg group(?: s)? {LICENCE}"], None),
    "curl": ("curl", "curl", [rf"curl {LICENCE}"], None),
    "json": ("json", "json", [rf"json {LICENCE}"], "json org license"),
    "beerware": ("beerware", "beerware", [rf"beerware {LICENCE}"], None),
    "blueoak-1.0.0": ("oak", "blueoak 1 0 0", [rf"blue oak model {LICENCE}(?: 1 0 0)?"], None),
    "mulan-2.0": ("mulan", "mulanpsl 2 0", [rf"mulan (?:psl|permissive software {LICENCE})(?:{VERSION} ?2)?"], None),
    "openrail": ("openrail", "openrail(?: m)?", [rf"(?:creativeml |bigscience )?openrail(?: m)?(?: {LICENCE})?"], None),
}

#: Creative Commons codes; each has versions, words and an address.
CREATIVE = {"by": "attribution", "by sa": "attribution share ?alike", "by nd": "attribution no ?deriv(?:ative)?s?(?: works)?",
            "by nc": "attribution non ?commercial", "by nc sa": "attribution non ?commercial share ?alike",
            "by nc nd": "attribution non ?commercial no ?deriv(?:ative)?s?(?: works)?"}

#: (label, word of every match, signature): sentences that stand in one license's body only
BODIES = [
    ("mit", "obtaining", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files"),
    ("mit", "sublicense", "to use copy modify merge publish distribute sublicense and or sell copies of the software"),
    ("mit", "noninfringement", "including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement"),
    ("isc", "hereby", r"permission to use copy modify (?:and )?(?:and or )?distribute this software for any purpose with or without fee is hereby granted"),
    ("bsd", "redistribution", r"redistribution and use in source and binary forms(?: of [^ ]+)? with or without modification are permitted"),
    ("bsd", "redistributions", "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer"),
    ("bsd", "redistributions", "redistributions in binary form must reproduce the above copyright notice"),
    ("bsd-3-clause", "endorse", r"neither the names? of (?:[^ ]+ ){1,12}may be used to endorse or promote products"),
    ("bsd-4-clause", "advertising", "all advertising materials mentioning features or use of this software must display the following acknowledge?ment"),
    ("apache-2.0", "except", "you may not use this file except in compliance with the license"),
    ("apache-2.0", "basis", "distributed under the license is distributed on an as is basis without warranties or conditions of any kind"),
    ("apache-2.0", "perpetual", "each contributor hereby grants to you a perpetual worldwide non exclusive no charge royalty free irrevocable copyright license"),
    ("gpl", "redistribute", "you can redistribute it and or modify it under the terms of the gnu general public license"),
    ("gpl", "useful", "in the hope that it will be useful but without any warranty"),
    ("gpl", "freedom", "the licenses for most software are designed to take away your freedom"),
    ("gpl", "verbatim", "everyone is permitted to copy and distribute verbatim copies of this license document but changing it is not allowed"),
    ("lgpl", "lesser", "you can redistribute it and or modify it under the terms of the gnu lesser general public license"),
    ("agpl-3.0", "affero", "you can redistribute it and or modify it under the terms of the gnu affero general public license"),
    ("mpl-2.0", "mozilla", r"this source code form is subject to the terms of the mozilla public license v 2 0"),
    ("mpl-1.1", "contents", r"the contents of this file are subject to the mozilla public license version 1 1"),
    ("epl", "accompanying", r"this program and the accompanying materials are made available under the terms of the eclipse public license"),
    ("cddl", "contents", "the contents of this file are subject to the terms of the common development and distribution license"),
    ("bsl-1.0", "organization", "permission is hereby granted free of charge to any person or organization obtaining a copy of the software and accompanying documentation"),
    ("zlib", "provided", "this software is provided as is without any express or implied warranty in no event will the authors be held liable"),
    ("zlib", "misrepresented", "the origin of this software must not be misrepresented"),
    ("unlicense", "unencumbered", "this is free and unencumbered software released into the public domain"),
    ("cc0-1.0", "dedicated", r"has dedicated the work to the public domain by waiving all of (?:his or her|their) rights"),
    ("cc-any", "redistribute", "you are free to share copy and redistribute the material in any medium or format"),
    ("cc-any", "licensor", "the licensor cannot revoke these freedoms as long as you follow the license terms"),
    ("cc-any", "appropriate", "you must give appropriate credit provide a link to the license and indicate if changes were made"),
    ("ofl-1.1", "font", "this font software is licensed under the sil open font license"),
    ("wtfpl", "fuck", "you just do what the fuck you want to"),
    ("ncsa", "illinois", "developed by (?:[^ ]+ ){0,8}university of illinois"),
    ("php-3.01", "php", "this product includes php software freely available from"),
    ("openssl", "openssl", "this product includes software developed by the openssl project"),
    ("python-2.0", "licensee", "psf hereby grants licensee a nonexclusive royalty free world wide license"),
    ("artistic", "artistic", "this is free software you can redistribute it and or modify it under the terms of (?:either|the) (?:[^ ]+ ){0,8}artistic license"),
    ("json", "evil", "the software shall be used for good not evil"),
    ("beerware", "beer", r"if we meet some day and you think this stuff is worth it you can buy me a beer"),
    ("busl-1.1", "production", r"non production use of the licensed work"),
    ("sspl-1.0", "functionality", r"if you make the functionality of the program or a modified version available to third parties as a service"),
    ("ijg", "jpeg", r"this software is based in part on the work of the independent jpeg group"),
]

#: (label, word of every match, signature): hints without a license of their own
CLUES = [
    ("public-domain", "domain", r"(?:released|placed|dedicated) (?:in|into|to) the public domain"),
    ("public-domain", "domain", r"(?:is|are) in the public domain"),
    ("public-domain", "domain", r"(?:no rights reserved )?public domain dedication"),
    ("proprietary", "proprietary", r"proprietary and confidential"),
    ("proprietary", "proprietary", rf"proprietary {LICENCE}"),
    ("proprietary", "confidential", r"confidential and proprietary"),
    ("proprietary", "unauthorized", r"unauthorized (?:copying|use|reproduction|distribution)(?: [^ ]+){0,8} (?:is )?(?:strictly )?prohibited"),
    ("proprietary", "permission", r"may not be (?:copied|reproduced|distributed|republished)(?: [^ ]+){0,8} without (?:the )?(?:prior |express )*(?:written )?permission"),
    ("proprietary", "reproduced", r"no part of this (?:publication|book|document|work|site) may be reproduced"),
    ("proprietary", "eula", r"eula"),
    ("proprietary", "agreement", rf"end user {LICENCE} agreement"),
    ("proprietary", "trade", r"trade secrets? (?:of|and) [^ ]+"),
    ("reserved-es", "derechos", r"todos los derechos reservados"),
    ("reserved-de", "rechte", r"alle rechte vorbehalten"),
    ("reserved-fr", "droits", r"tous droits r[^ ]+"),
    ("reserved-it", "diritti", r"tutti i diritti riservati"),
    ("reserved-pt", "direitos", r"todos os direitos reservados"),
    ("reserved-some", "rights", r"some rights reserved"),
    ("copyright", "copyright", r"copyright(?: c| ©)*(?: (?:19|20)\d\d)+"),
    ("copyright", "copyright", r"copyright (?:holder|owner|notice)s?"),
    ("copyright", "©", r"©(?: (?:19|20)\d\d)+"),
    ("non-commercial", "commercial", r"(?:for )?non commercial (?:use|purposes?)(?: only)?"),
    ("non-commercial", "noncommercial", r"(?:for )?noncommercial (?:use|purposes?)(?: only)?"),
    ("research-only", "research", r"(?:for )?(?:academic (?:and |or )?)?research(?: and educational)? (?:use|purposes) only"),
    ("open-source", "open", rf"open source {LICENCE}"),
    ("free-software", "free", rf"free software {LICENCE}"),
    ("permissive", "permissive", rf"permissive {LICENCE}"),
    ("copyleft", "copyleft", r"copyleft"),
    ("dual-license", "dual", rf"dual {LICENCE}d?"),
    ("multi-license", "licenses", r"licensed under multiple licenses"),
    ("license-file", "see", rf"see (?:the )?(?:license|copying|notice)(?: txt| md)? (?:file )?for (?:more )?(?:details|information|licensing)"),
    ("terms", "terms", r"terms (?:of (?:use|service)|and conditions)"),
    ("royalty-free", "royalty", rf"royalty free(?: {LICENCE})?"),
    ("patent", "patent", r"patent (?:grant|license|pending)"),
    ("no-warranty", "warranty", r"(?:without|no) warranty(?: of any kind)?"),
    ("as-is", "as", r"provided as is"),
    ("attribution", "attribution", r"attribution (?:is )?required"),
    ("reprint", "reprinted", r"reprinted (?:with|by) permission"),
    ("used-by-permission", "permission", r"used (?:with|by) permission"),
]


class Rule(NamedTuple):
    order: int
    label: str
    priority: int
    word: str
    pattern: str


@lru_cache(1)
def rules() -> list[Rule]:
    """Every signature, in order."""
    out: list[tuple[str, int, str, str]] = []
    grant = (r"(?:licensed|released|distributed|available|published|provided|covered|offered|governed|used|made available|redistributed|dual licensed)"
             r" (?:under|by|with|according to|subject to)(?: the)?(?: terms(?: and conditions)? of)?(?: the)? ")
    for label, (word, ident, names, address) in FAMILIES.items():
        out.append((label, SPDX, "spdx", rf"spdx license identifier {ident}"))
        for name in names:
            out.append((label, GRANT, word, grant + f"(?:{name})"))
            out.append((label, NAMED, word, name))
        if address:
            out.append((label, MENTION, address.split()[0], address))
    for code, spoken in CREATIVE.items():
        label, version = "cc-" + code.replace(" ", "-"), r"(?: (?:1 0|2 [05]|2 0|3 0|4 0))?"
        out.append((label, SPDX, "spdx", rf"spdx license identifier cc {code}{version}"))
        out.append((label, GRANT, "cc", grant + rf"(?:a )?(?:creative commons )?cc {code}{version}(?: international| unported)?"))
        out.append((label, GRANT, "creative", grant + rf"(?:a )?creative commons {spoken}{version}(?: international| unported)?(?: {LICENCE})?"))
        out.append((label, NAMED, "cc", rf"cc {code}{version}"))
        out.append((label, NAMED, "creative", rf"creative commons {spoken}{version}(?: international| unported)?(?: {LICENCE})?"))
        out.append((label, MENTION, "creativecommons", rf"creativecommons org licenses {code}{version}"))
        for v in ("1 0", "2 0", "2 5", "3 0", "4 0"):
            out.append((f"{label}-{v.replace(' ', '.')}", SPDX, "cc", rf"(?:spdx license identifier )?cc {code} {v}(?: international| unported)?"))
    out += [(label, BODY, word, p) for label, word, p in BODIES]
    out += [(label, CLUE, word, p) for label, word, p in CLUES]
    return [Rule(i, *x) for i, x in enumerate(out)]


@lru_cache(1)
def _prefilter() -> dict[bytes, list[Rule]]:
    gates: dict[bytes, list[Rule]] = defaultdict(list)
    for r in rules():
        for word in r.word.split("|"):
            gates[word.encode()].append(r)
    return dict(gates)


@lru_cache(None)
def _compiled(pattern: str) -> re.Pattern:
    return re.compile(b"(?<= )(?:" + pattern.encode() + b")(?= )")


def _separators() -> bytes:
    table = bytearray(range(256))
    for c in range(128):
        ch = chr(c)
        table[c] = ord(ch.lower()) if ch.isalnum() else 32
    return bytes(table)


TABLE = _separators()


class Match(NamedTuple):
    label: str
    priority: int
    start: int
    end: int
    order: int


def resolve(found: list[Match]) -> list[Match]:
    """The matches that stay, by place (see the module's description).  Each priority is
    checked against what stays above it with one sorted sweep."""
    kept: list[Match] = []
    lows, highs = np.zeros(0, np.int64), np.zeros(0, np.int64)      # disjoint intervals that stay, merged
    for p in sorted({m.priority for m in found}, reverse=True):
        level = sorted((m for m in found if m.priority == p), key=lambda m: (m.start, -m.end, m.order))
        reach, stay = -1, []
        for m in level:
            i = int(np.searchsorted(highs, m.start, side="right"))
            if i < len(lows) and lows[i] < m.end:
                continue
            if m.end > reach:
                stay.append(m)
                reach = m.end
        kept += stay
        spans: list[list[int]] = []
        for a, b in sorted([*zip(lows.tolist(), highs.tolist()), *[(m.start, m.end) for m in stay]]):
            if spans and a <= spans[-1][1]:
                spans[-1][1] = max(spans[-1][1], b)
            else:
                spans.append([a, b])
        lows, highs = np.array([s[0] for s in spans], np.int64), np.array([s[1] for s in spans], np.int64)
    return sorted(kept, key=lambda m: (m.start, m.end, m.order))


_BASE = [(label, f" {phrase} ".encode(), phrase.split()[0].encode()) for phrase, label in BASE.items()]


def scan_text(text: str | None) -> dict:
    """n_words, n_base, first_word, last_word, base_labels, labels, score, detections of a text."""
    words = (text or "").encode("utf-8", "surrogatepass").translate(TABLE).split()
    gates = _prefilter()
    present = gates.keys() & set(words)
    has = {w for _, _, w in _BASE if w in words} if words else set()
    line = gaps = None
    if present or has:
        line = b" " + b" ".join(words) + b" "
        gaps = np.flatnonzero(np.frombuffer(line, np.uint8) == 32)
    places, base = [], set()
    for label, phrase, word in _BASE:
        at = line.find(phrase) if word in has else -1
        while at >= 0:
            places.append(at)
            base.add(label)
            at = line.find(phrase, at + 1)
    found = []
    for rule in sorted({r for w in present for r in gates[w]}):
        for m in _compiled(rule.pattern).finditer(line):
            a, b = np.searchsorted(gaps, [m.start(), m.end()])
            found.append(Match(rule.label, rule.priority, int(a) - 1, int(b), rule.order))
    kept = resolve(found) if found else []
    best: dict[str, int] = {}
    for m in kept:
        best[m.label] = max(best.get(m.label, 0), m.priority)
    for label in base:
        best[label] = max(best.get(label, 0), MENTION)
    miss = 1.0
    for label in sorted(best):
        miss *= 1 - WEIGHT[best[label]]
    ends = np.searchsorted(gaps, [min(places), max(places)]).tolist() if places else [None, None]
    return {"n_words": len(words), "n_base": len(places), "first_word": ends[0], "last_word": ends[1],
            "base_labels": sorted(base), "labels": sorted(best), "score": 1 - miss,
            "detections": [{"label": m.label, "start": m.start, "words": m.end - m.start, "priority": m.priority}
                           for m in kept]}


SCHEMA = ("n_words bigint, n_base bigint, first_word bigint, last_word bigint, base_labels array<string>, "
          "labels array<string>, score double, "
          "detections array<struct<label: string, start: bigint, words: bigint, priority: int>>")
_DETECTION = pa.struct([("label", pa.string()), ("start", pa.int64()), ("words", pa.int64()), ("priority", pa.int32())])
_TYPES = {"n_words": pa.int64(), "n_base": pa.int64(), "first_word": pa.int64(), "last_word": pa.int64(),
          "base_labels": pa.list_(pa.string()), "labels": pa.list_(pa.string()), "score": pa.float64(),
          "detections": pa.list_(_DETECTION)}


def scan(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: the key and what ``scan_text`` finds in its whole text."""
    key_type = docs.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 1_000):
                b = whole.slice(at, 1_000)
                got = [scan_text(t.as_py()) for t in b.column(1)]
                yield pa.RecordBatch.from_arrays(
                    [b.column(0), *[pa.array([g[k] for g in got], t) for k, t in _TYPES.items()]],
                    names=["key", *_TYPES])

    return docs.select(key, text).mapInArrow(run, f"key {key_type}, {SCHEMA}").withColumnRenamed("key", key)
