"""Signature rules of licences, written for a stream of lower-case words with one space between them.

A rule has a label, a level (1 decides first), a keyword that every match holds as a word, and a pattern. Patterns use groups,
alternatives, classes and `?` only, so that they mean the same in every regex engine; a space before an optional word belongs to its group.
"""

from __future__ import annotations

from typing import NamedTuple


class Rule(NamedTuple):
    label: str
    level: int
    keyword: str
    pattern: str


# Levels: 1 a licence with its version or identifier, 2 words of its text or notice, 3 its name, 4 a statement about rights.
VERSION, NOTICE, NAME, STATEMENT = 1, 2, 3, 4

LICENCE = "licen[cs]e"

# Families with versions: label, names as (keyword, pattern), abbreviations, versions.
FAMILIES: list[tuple[str, list[tuple[str, str]], list[str], list[str]]] = [
    ("gpl", [("gnu", f"gnu general public {LICENCE}"), ("gnu", "gnu gpl")], ["gpl"], ["1.0", "2.0", "3.0"]),
    ("lgpl", [("lesser", f"(gnu )?lesser general public {LICENCE}"), ("library", f"gnu library general public {LICENCE}"), ("gnu", "gnu lgpl")], ["lgpl"], ["2.0", "2.1", "3.0"]),
    ("agpl", [("affero", f"(gnu )?affero general public {LICENCE}"), ("gnu", "gnu agpl")], ["agpl"], ["1.0", "3.0"]),
    ("gfdl", [("documentation", f"(gnu )?free documentation {LICENCE}")], ["gfdl", "fdl"], ["1.1", "1.2", "1.3"]),
    ("apache", [("apache", f"apache( software)? {LICENCE}"), ("apache", "apache")], ["asl"], ["1.0", "1.1", "2.0"]),
    ("mpl", [("mozilla", f"mozilla public {LICENCE}")], ["mpl"], ["1.0", "1.1", "2.0"]),
    ("epl", [("eclipse", f"eclipse public {LICENCE}")], ["epl"], ["1.0", "2.0"]),
    ("cpl", [("common", f"common public {LICENCE}")], ["cpl"], ["0.5", "1.0"]),
    ("cddl", [("distribution", f"common development and distribution {LICENCE}")], ["cddl"], ["1.0", "1.1"]),
    ("eupl", [("european", f"european union public {LICENCE}")], ["eupl"], ["1.0", "1.1", "1.2"]),
    ("cecill", [("cecill", "cecill")], [], ["1.0", "2.0", "2.1"]),
    ("artistic", [("artistic", f"artistic {LICENCE}"), ("artistic", "artistic")], [], ["1.0", "2.0"]),
    ("psf", [("python", f"python software foundation {LICENCE}")], ["psf"], ["2.0", "2.3"]),
    ("php", [("php", f"php {LICENCE}")], [], ["3.0", "3.01"]),
    ("ofl", [("font", f"(sil )?open font {LICENCE}")], ["ofl"], ["1.0", "1.1"]),
    ("osl", [("software", f"open software {LICENCE}")], ["osl"], ["1.0", "2.0", "2.1", "3.0"]),
    ("afl", [("academic", f"academic free {LICENCE}")], ["afl"], ["1.1", "1.2", "2.0", "2.1", "3.0"]),
    ("bsl", [("boost", f"boost software {LICENCE}"), ("boost", f"boost {LICENCE}")], [], ["1.0"]),
    ("busl", [("business", f"business source {LICENCE}")], ["busl", "bsl"], ["1.0", "1.1"]),
    ("elastic", [("elastic", f"elastic {LICENCE}")], [], ["1.0", "2.0"]),
    ("apsl", [("apple", f"apple public source {LICENCE}")], ["apsl"], ["1.0", "1.1", "1.2", "2.0"]),
    ("ogl", [("government", f"open government {LICENCE}")], ["ogl"], ["1.0", "2.0", "3.0"]),
    ("mulan", [("mulan", "mulan psl")], [], ["1.0", "2.0"]),
    ("blueoak", [("oak", f"blue oak model {LICENCE}")], [], ["1.0"]),
    ("cc-by", [("cc", "cc by"), ("attribution", "creative commons attribution"), ("creativecommons", "creativecommons org licen[cs]es by")], [], ["1.0", "2.0", "2.5", "3.0", "4.0"]),
    ("cc-by-sa", [("cc", "cc by sa"), ("sharealike", "creative commons attribution sharealike"), ("alike", "creative commons attribution share alike"), ("creativecommons", "creativecommons org licen[cs]es by sa")], [], ["1.0", "2.0", "2.5", "3.0", "4.0"]),
    ("cc-by-nc", [("cc", "cc by nc"), ("noncommercial", "creative commons attribution noncommercial"), ("commercial", "creative commons attribution non commercial"), ("creativecommons", "creativecommons org licen[cs]es by nc")], [], ["1.0", "2.0", "2.5", "3.0", "4.0"]),
    ("cc-by-nd", [("cc", "cc by nd"), ("noderivatives", "creative commons attribution noderivatives"), ("noderivs", "creative commons attribution noderivs"), ("creativecommons", "creativecommons org licen[cs]es by nd")], [], ["1.0", "2.0", "2.5", "3.0", "4.0"]),
    ("cc-by-nc-sa", [("cc", "cc by nc sa"), ("sharealike", "creative commons attribution noncommercial sharealike"), ("creativecommons", "creativecommons org licen[cs]es by nc sa")], [], ["1.0", "2.0", "2.5", "3.0", "4.0"]),
    ("cc-by-nc-nd", [("cc", "cc by nc nd"), ("noderivatives", "creative commons attribution noncommercial noderivatives"), ("noderivs", "creative commons attribution noncommercial noderivs"), ("creativecommons", "creativecommons org licen[cs]es by nc nd")], [], ["2.0", "2.5", "3.0", "4.0"]),
    ("odbl", [("database", f"open (data commons open )?database {LICENCE}")], ["odbl"], ["1.0"]),
    ("odc-by", [("attribution", f"open data commons attribution {LICENCE}"), ("odc", "odc by")], [], ["1.0"]),
    ("etalab", [("etalab", "(licence ouverte )?etalab")], [], ["1.0", "2.0"]),
    ("dl-de", [("deutschland", "datenlizenz deutschland( namensnennung| zero)?")], [], ["1.0", "2.0"]),
]

# Rules without a version: level, label, keyword, pattern.
SINGLE: list[tuple[int, str, str, str]] = [
    (NAME, "mit", "mit", f"mit( expat)? {LICENCE}"),
    (NAME, "mit", "mit", f"{LICENCE} mit"),
    (NAME, "mit", "expat", f"expat {LICENCE}"),
    (VERSION, "mit", "mit", "spdx license identifier mit"),
    (VERSION, "mit", "mit", "opensource org licenses mit( license)?"),
    (NOTICE, "mit", "charge", "permission is hereby granted free of charge to any person obtaining a copy of this software"),
    (NOTICE, "mit", "noninfringement", "merchantability fitness for a particular purpose and noninfringement"),
    (VERSION, "mit-0", "attribution", "mit no attribution"),
    (VERSION, "mit-0", "mit", "mit 0"),
    (NAME, "x11", "x11", f"x11 {LICENCE}"),
    (NAME, "isc", "isc", f"isc {LICENCE}"),
    (NOTICE, "isc", "fee", "permission to use copy modify and( or)? distribute this software for any purpose with or without fee"),
    (VERSION, "0bsd", "0bsd", "0bsd"),
    (VERSION, "0bsd", "bsd", "(zero|0) clause bsd"),
    (VERSION, "bsd-1-clause", "bsd", "bsd (1|one) clause"),
    (VERSION, "bsd-2-clause", "bsd", "bsd (2|two) clause"),
    (VERSION, "bsd-2-clause", "bsd", "(2|two) clause bsd"),
    (VERSION, "bsd-2-clause", "bsd", "(simplified|freebsd) bsd"),
    (VERSION, "bsd-3-clause", "bsd", "bsd (3|three) clause( clear)?"),
    (VERSION, "bsd-3-clause", "bsd", "(3|three) clause bsd"),
    (VERSION, "bsd-3-clause", "bsd", "(new|modified|revised) bsd"),
    (VERSION, "bsd-4-clause", "bsd", "bsd (4|four) clause"),
    (VERSION, "bsd-4-clause", "bsd", "(4|four) clause bsd"),
    (VERSION, "bsd-4-clause", "bsd", "original bsd"),
    (NAME, "bsd", "bsd", f"bsd( style)? {LICENCE}"),
    (NOTICE, "bsd", "redistribution", "redistribution and use in source and binary forms with or without modification are permitted"),
    (NOTICE, "bsd-3-clause", "endorse", "may be used to endorse or promote products derived from this software"),
    (NOTICE, "bsd-4-clause", "advertising", "all advertising materials mentioning features or use of this software"),
    (NAME, "zlib", "zlib", f"zlib( libpng)? {LICENCE}"),
    (NOTICE, "zlib", "misrepresented", "the origin of this software must not be misrepresented"),
    (NAME, "libpng", "libpng", f"libpng {LICENCE}"),
    (NOTICE, "gpl", "redistribute", "you can redistribute it and or modify it under the terms of the gnu general public license"),
    (NOTICE, "lgpl", "redistribute", "you can redistribute it and or modify it under the terms of the gnu (lesser|library) general public license"),
    (NOTICE, "agpl", "redistribute", "you can redistribute it and or modify it under the terms of the gnu affero general public license"),
    (NAME, "gpl", "general", f"general public {LICENCE}"),
    (VERSION, "gpl", "gnu", "gnu org licenses( old licenses)? gpl"),
    (VERSION, "lgpl", "gnu", "gnu org licenses( old licenses)? lgpl"),
    (VERSION, "agpl", "gnu", "gnu org licenses agpl"),
    (NOTICE, "apache-2.0", "apache", "apache org licenses( license)? 2 0"),
    (NOTICE, "apache-2.0", "compliance", "you may not use this file except in compliance with the license"),
    (NOTICE, "mpl-2.0", "mpl", "if a copy of the mpl was not distributed with this file"),
    (NOTICE, "mpl-2.0", "mozilla", "mozilla org mpl 2 0"),
    (NOTICE, "epl", "eclipse", "eclipse org legal epl( v10| v20| 2 0)?"),
    (NOTICE, "cddl", "distribution", "subject to the terms of the common development and distribution license"),
    (NAME, "npl", "netscape", f"netscape public {LICENCE}"),
    (NAME, "ibm-pl", "ibm", f"ibm public {LICENCE}"),
    (NAME, "spl", "sun", f"sun public {LICENCE}"),
    (NAME, "qpl", "q", f"q public {LICENCE}"),
    (NAME, "qpl", "qpl", "qpl"),
    (NAME, "sleepycat", "sleepycat", f"sleepycat( public)? {LICENCE}"),
    (NAME, "vim", "vim", f"vim {LICENCE}"),
    (NAME, "ruby", "ruby", f"ruby( s)? {LICENCE}"),
    (NAME, "perl", "perl", "same terms as perl( itself)?"),
    (NAME, "zend", "zend", f"zend( engine)? {LICENCE}"),
    (NAME, "zope", "zope", f"zope public {LICENCE}"),
    (NAME, "w3c", "w3c", f"w3c( software)?( notice and)? {LICENCE}"),
    (NAME, "openssl", "openssl", f"openssl {LICENCE}"),
    (NAME, "ssleay", "ssleay", f"ssleay {LICENCE}"),
    (NAME, "curl", "curl", f"curl {LICENCE}"),
    (NAME, "ncsa", "illinois", f"university of illinois( ncsa)?( open source)? {LICENCE}"),
    (NAME, "ncsa", "ncsa", f"ncsa( open source)? {LICENCE}"),
    (NAME, "postgresql", "postgresql", f"postgresql {LICENCE}"),
    (NAME, "unicode", "unicode", f"unicode( inc)? {LICENCE}( agreement)?"),
    (NAME, "ms-pl", "microsoft", f"microsoft public {LICENCE}"),
    (NAME, "ms-rl", "microsoft", f"microsoft reciprocal {LICENCE}"),
    (VERSION, "ms-pl", "ms", "ms pl"),
    (VERSION, "ms-rl", "ms", "ms rl"),
    (NAME, "json", "json", f"json {LICENCE}"),
    (NOTICE, "json", "evil", "the software shall be used for good not evil"),
    (NAME, "beerware", "beer", f"beer ware {LICENCE}"),
    (NAME, "beerware", "beerware", f"beerware( {LICENCE})?"),
    (NAME, "wtfpl", "wtfpl", "wtfpl"),
    (NAME, "wtfpl", "want", f"do what the (fuck|f) you want to public {LICENCE}"),
    (NAME, "unlicense", "unlicense", "(the )?unlicense"),
    (NOTICE, "unlicense", "unencumbered", "free and unencumbered software released into the public domain"),
    (NAME, "upl", "permissive", f"universal permissive {LICENCE}"),
    (NAME, "ecl", "educational", f"educational community {LICENCE}"),
    (NAME, "rpl", "reciprocal", f"reciprocal public {LICENCE}"),
    (NAME, "watcom", "watcom", f"(sybase )?open watcom public {LICENCE}"),
    (NAME, "lppl", "latex", f"latex project public {LICENCE}"),
    (NAME, "lppl", "lppl", "lppl"),
    (NAME, "sspl", "server", f"server side public {LICENCE}"),
    (NAME, "sspl", "sspl", "sspl"),
    (NAME, "commons-clause", "commons", f"commons clause( {LICENCE})?"),
    (NAME, "polyform", "polyform", "polyform (noncommercial|small business|strict|shield|free trial|internal use|perimeter)"),
    (NAME, "parity", "parity", f"parity public {LICENCE}"),
    (NAME, "hippocratic", "hippocratic", f"hippocratic {LICENCE}"),
    (NAME, "openrail", "openrail", f"(creativeml )?openrail( m)?( {LICENCE})?"),
    (NAME, "openrail", "responsible", f"responsible ai {LICENCE}( rail)?"),
    (NAME, "llama", "llama", f"llama( 2| 3| 3 1| 3 2| 3 3)?( community)? {LICENCE}( agreement)?"),
    (NAME, "gemma", "gemma", "gemma terms of use"),
    (VERSION, "cc0-1.0", "cc0", "cc0( 1 0)?( universal)?"),
    (VERSION, "cc0-1.0", "creativecommons", "creativecommons org publicdomain zero( 1 0)?"),
    (NAME, "cc0-1.0", "zero", "creative commons zero"),
    (NAME, "cc-pdm", "mark", "public domain mark"),
    (NAME, "cc", "creative", f"creative commons {LICENCE}"),
    (NAME, "cc", "creative", "licen[cs]ed under( a| the)? creative commons"),
    (VERSION, "pddl-1.0", "pddl", "pddl( 1 0)?"),
    (NAME, "pddl-1.0", "dedication", f"public domain dedication and {LICENCE}"),
    (NAME, "cdla", "cdla", "cdla (permissive|sharing)( 1 0| 2 0)?"),
    (NAME, "opl", "publication", f"open publication {LICENCE}"),
    (NAME, "free-art", "art", f"free art {LICENCE}"),
    (NAME, "free-art", "lal", "licence art libre lal"),
    (NAME, "gust", "gust", f"gust font {LICENCE}"),
    (NAME, "bitstream", "bitstream", f"bitstream vera( fonts?)? {LICENCE}"),
    (NAME, "ubuntu-font", "ubuntu", f"ubuntu font {LICENCE}"),
    (STATEMENT, "public-domain", "domain", "(in|into|to) the public domain"),
    (STATEMENT, "public-domain", "gemeinfrei", "gemeinfrei(e|er|es|en)?"),
    (STATEMENT, "public-domain", "público", "dominio público"),
    (STATEMENT, "public-domain", "domaine", "domaine public"),
    (STATEMENT, "all-rights-reserved", "reserved", "all rights reserved"),
    (STATEMENT, "all-rights-reserved", "vorbehalten", "alle rechte vorbehalten"),
    (STATEMENT, "all-rights-reserved", "réservés", "tous droits réservés"),
    (STATEMENT, "all-rights-reserved", "reservados", "todos los derechos reservados"),
    (STATEMENT, "proprietary", "proprietary", f"proprietary( and confidential| software)?( {LICENCE})?"),
    (STATEMENT, "proprietary", "permission", "without( the)?( prior)? written permission"),
    (STATEMENT, "non-commercial", "commercial", "(for )?non commercial (use|purposes?)( only)?"),
    (STATEMENT, "non-commercial", "noncommercial", "(for )?noncommercial (use|purposes?)( only)?"),
    (STATEMENT, "open-source", "source", f"open source {LICENCE}"),
]

LATER = "( or( any)? later( version)?| only)?"


def numbers(version: str) -> str:
    """'3.0' as it stands in texts: 3, 3.0, v3, version 3; '2.1' always with both numbers."""
    major, minor = version.split(".")
    return f"{major}( {minor})?" if minor == "0" else f"{major} {minor}"


def of_families() -> list[Rule]:
    """For each name and abbreviation of a family: one rule a version, one with no version; an abbreviation also as one word with the version.

    A name of one short word (`apache`) names a licence only with a version.
    """
    rules = []
    for label, names, short, versions in FAMILIES:
        for keyword, name in [*names, *((x, x) for x in short)]:
            rules += [Rule(f"{label}-{v}", VERSION, keyword, f"{name}( {LICENCE})?( version| ver| v)? v?{numbers(v)}( international| unported| generic)?{LATER}") for v in versions]
            if " " in name or keyword in short:
                rules.append(Rule(label, NAME, keyword, f"{name}( {LICENCE})?"))
        rules += [Rule(f"{label}-{v}", VERSION, f"{x}v{v[0]}", f"{x}v{v[0]}" + ("( 0)?" if v[2:] == "0" else f" {v[2:]}") + LATER) for x in short for v in versions]
    return rules


RULES: list[Rule] = of_families() + [Rule(label, level, keyword, pattern) for level, label, keyword, pattern in SINGLE]

# Phrases that are always reported.
BASE: list[Rule] = [
    Rule("gpl", NAME, "gnu", "gnu general public license"),
    Rule("apache", NAME, "apache", "apache license"),
    Rule("cc-by", NAME, "cc", "cc by"),
    Rule("mit", NAME, "mit", "mit license"),
]
