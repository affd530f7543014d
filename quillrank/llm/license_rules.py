"""The licence rules: regular expressions over a text's words, built from licences and the ways to refer to one.

A pattern is written over lower-case words joined by single spaces. Each rule has keywords of which every match
contains one of (alternatives are split by |); a text without it never meets the pattern.
"""

from __future__ import annotations

from typing import NamedTuple

#: The phrases that always count, and their labels.
BASE = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}

#: label, keyword, how its name is written (without the word licence), and its identifier as words
LICENCES = [
    ("gpl-1.0", "general public|gpl", r"(?:gnu )?(?:general public|gpl) (?:licen[cs]e )?(?:v ?|version )?1(?: 0)?", "gpl 1 0"),
    ("gpl-2.0", "general public|gpl", r"(?:gnu )?(?:general public|gpl) (?:licen[cs]e )?(?:v ?|version )?2(?: 0)?", "gpl 2 0"),
    ("gpl-3.0", "general public|gpl", r"(?:gnu )?(?:general public|gpl) (?:licen[cs]e )?(?:v ?|version )?3(?: 0)?", "gpl 3 0"),
    ("lgpl-2.1", "general public|gpl", r"(?:gnu )?(?:lesser general public|lgpl) (?:licen[cs]e )?(?:v ?|version )?2(?: [01])?", "lgpl 2 1"),
    ("lgpl-3.0", "general public|gpl", r"(?:gnu )?(?:lesser general public|lgpl) (?:licen[cs]e )?(?:v ?|version )?3(?: 0)?", "lgpl 3 0"),
    ("agpl-3.0", "general public|gpl", r"(?:gnu )?(?:affero general public|agpl) (?:licen[cs]e )?(?:v ?|version )?3(?: 0)?", "agpl 3 0"),
    ("gfdl", "free documentation", r"(?:gnu )?free documentation", "gfdl 1 3"),
    ("apache-1.1", "apache", r"apache (?:software )?(?:licen[cs]e )?(?:v ?|version )?1 1", "apache 1 1"),
    ("apache-2.0", "apache", r"apache (?:software )?(?:licen[cs]e )?(?:v ?|version )?2(?: 0)?", "apache 2 0"),
    ("mit", "mit", r"mit(?: x11)?", "mit"),
    ("mit-0", "mit", r"mit (?:no attribution|0)", "mit 0"),
    ("bsd-2-clause", "bsd", r"(?:bsd 2 clause|2 clause bsd|simplified bsd|freebsd)", "bsd 2 clause"),
    ("bsd-3-clause", "bsd", r"(?:bsd 3 clause|3 clause bsd|new bsd|revised bsd|modified bsd)", "bsd 3 clause"),
    ("bsd-4-clause", "bsd", r"(?:bsd 4 clause|4 clause bsd|original bsd)", "bsd 4 clause"),
    ("bsd", "bsd", r"bsd(?: style)?", "bsd"),
    ("0bsd", "bsd", r"(?:0 ?bsd|zero clause bsd)", "0bsd"),
    ("isc", "isc", r"isc", "isc"),
    ("mpl-1.1", "mozilla", r"mozilla public (?:licen[cs]e )?(?:v ?|version )?1(?: [01])?", "mpl 1 1"),
    ("mpl-2.0", "mozilla", r"mozilla public (?:licen[cs]e )?(?:v ?|version )?2(?: 0)?", "mpl 2 0"),
    ("epl-1.0", "eclipse", r"eclipse public (?:licen[cs]e )?(?:v ?|version )?1(?: 0)?", "epl 1 0"),
    ("epl-2.0", "eclipse", r"eclipse public (?:licen[cs]e )?(?:v ?|version )?2(?: 0)?", "epl 2 0"),
    ("cddl-1.0", "common development", r"common development and distribution", "cddl 1 0"),
    ("cpl-1.0", "common public", r"common public", "cpl 1 0"),
    ("eupl-1.2", "european union", r"european union public", "eupl 1 2"),
    ("artistic-2.0", "artistic", r"artistic", "artistic 2 0"),
    ("zlib", "zlib", r"zlib(?: libpng)?", "zlib"),
    ("bsl-1.0", "boost", r"boost software", "bsl 1 0"),
    ("unlicense", "unlicense", r"unlicense", "unlicense"),
    ("wtfpl", "do what the", r"do what the f\w+ you want to public", "wtfpl"),
    ("postgresql", "postgresql", r"postgresql", "postgresql"),
    ("python-2.0", "python software", r"python software foundation", "python 2 0"),
    ("openssl", "openssl", r"openssl", "openssl"),
    ("ofl-1.1", "open font", r"(?:sil )?open font", "ofl 1 1"),
    ("odbl-1.0", "open database", r"open (?:data commons open )?database", "odbl 1 0"),
    ("ms-pl", "microsoft public", r"microsoft public", "ms pl"),
    ("cc0-1.0", "cc|commons", r"(?:cc ?0|cc zero|creative commons zero)(?: (?:v ?)?1 0)?(?: universal)?", "cc0 1 0"),
    ("cc-by-nc-nd", "cc|commons", r"(?:cc|creative commons) (?:by|attribution) (?:nc|non ?commercial) (?:nd|no ?deriv\w*)(?: \d 0)?", "cc by nc nd 4 0"),
    ("cc-by-nc-sa", "cc|commons", r"(?:cc|creative commons) (?:by|attribution) (?:nc|non ?commercial) (?:sa|share ?alike)(?: \d 0)?", "cc by nc sa 4 0"),
    ("cc-by-nc", "cc|commons", r"(?:cc|creative commons) (?:by|attribution) (?:nc|non ?commercial)(?: \d 0)?", "cc by nc 4 0"),
    ("cc-by-nd", "cc|commons", r"(?:cc|creative commons) (?:by|attribution) (?:nd|no ?deriv\w*)(?: \d 0)?", "cc by nd 4 0"),
    ("cc-by-sa", "cc|commons", r"(?:cc|creative commons) (?:by|attribution) (?:sa|share ?alike)(?: \d 0)?", "cc by sa 4 0"),
    ("cc-by-4.0", "cc|commons", r"(?:cc by|creative commons attribution)(?: international)?(?: v)? 4 0", "cc by 4 0"),
    ("cc-by-3.0", "cc|commons", r"(?:cc by|creative commons attribution)(?: unported)?(?: v)? 3 0", "cc by 3 0"),
]

#: How a text refers to a licence: (name, priority, confidence, pattern with {n} for the name and {i} for the identifier)
FORMS = [
    ("identifier", 5, 0.99, r"spdx license identifier {i}(?: only| or later)?"),
    ("grant", 4, 0.95, r"(?:re)?(?:licen[cs]ed|released|distributed|published|available|provided) under (?:the |a |an )?"
                       r"(?:terms (?:and conditions )?of (?:the )?)?{n}(?: licen[cs]e)?"),
    ("permission", 4, 0.95, r"(?:redistribute|copy|modify|use) (?:it |this )?(?:and or modify (?:it )?)?under (?:the )?terms of (?:the )?{n}(?: licen[cs]e)?"),
    ("subject", 3, 0.9, r"(?:subject|according|pursuant) to (?:the )?(?:terms of (?:the )?)?{n} licen[cs]e"),
    ("reference", 3, 0.85, r"(?:see|refer to|read|copy of) the {n} licen[cs]e"),
    ("compatible", 2, 0.6, r"(?:compatible with|similar to|based on) (?:the )?{n} licen[cs]e"),
    ("title", 1, 0.8, r"{n} licen[cs]e(?: agreement)?"),
]

#: Notices that name no licence: label, keyword, priority, confidence, pattern
NOTICES = [
    ("proprietary", "rights reserved", 2, 0.7, r"all rights (?:are )?reserved"),
    ("proprietary", "confidential", 2, 0.8, r"(?:proprietary and confidential|confidential and proprietary)"),
    ("proprietary", "without", 2, 0.7, r"may not be (?:copied|reproduced|distributed|used) without (?:prior )?(?:written )?permission"),
    ("copyright", "copyright", 1, 0.4, r"copyright (?:c )?(?:19|20)\d\d"),
    ("copyright", "copyright", 1, 0.3, r"copyright (?:holders?|owners?|notice)"),
    ("public-domain", "public domain", 2, 0.8, r"(?:in|into|to) the public domain"),
    ("public-domain", "public domain", 1, 0.5, r"public domain"),
    ("mit", "permission is hereby", 4, 0.95, r"permission is hereby granted free of charge to any person obtaining a copy"),
    ("isc", "permission to use", 4, 0.95, r"permission to use copy modify and or distribute this software for any purpose"),
    ("bsd", "redistribution", 4, 0.95, r"redistribution and use in source and binary forms"),
    ("gpl", "free software", 4, 0.9, r"this program is free software you can redistribute it"),
    ("lgpl", "lesser", 2, 0.8, r"(?:gnu )?lesser general public licen[cs]e"),
    ("agpl", "affero", 2, 0.8, r"(?:gnu )?affero general public licen[cs]e"),
    ("gpl", "gpl", 1, 0.6, r"gpl(?:v\d)?"),
    ("cc", "creative commons", 1, 0.6, r"creative commons"),
    ("mpl", "mozilla", 1, 0.6, r"mozilla public licen[cs]e"),
    ("epl", "eclipse", 1, 0.6, r"eclipse public licen[cs]e"),
    ("no-warranty", "warranty", 1, 0.3, r"without (?:any )?warranty(?: of any kind)?"),
    ("no-warranty", "warranties", 1, 0.3, r"without warranties or conditions of any kind"),
    ("open-source", "open source", 1, 0.3, r"open source licen[cs]es?"),
]

#: Parts of words of which every text that matches a rule has one, whatever stands between its words.
GATES = ["licen", "copyright", "rights", "confidential", "permi", "domain", "redistribut", "commons", "gpl", "warrant", "released",
         "distributed", "published", "available", "provided", "spdx", "software", "compatible", "similar", "terms", "reproduced"]
#: The base phrase without such a part.
CC = r"(?i)cc[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+by"


class Rule(NamedTuple):
    rule: str
    label: str
    keyword: str
    priority: int
    confidence: float
    pattern: str
    base: bool


def rules() -> list[Rule]:
    """All rules, base phrases first. Every match stands between single spaces."""
    bound = r"(?<= )(?:{})(?= )".format
    out = [Rule(f"base:{label}", label, phrase.split()[0], 9, 0.9, bound(phrase), True) for phrase, label in BASE.items()]
    for label, keyword, name, identifier in LICENCES:
        for form, priority, confidence, pattern in FORMS:
            key = "spdx" if form == "identifier" else keyword
            out.append(Rule(f"{label}:{form}", label, key, priority, confidence,
                            bound(pattern.replace("{n}", f"(?:{name})").replace("{i}", identifier)), False))
    return out + [Rule(f"{label}:notice-{k}", label, keyword, priority, confidence, bound(pattern), False)
                  for k, (label, keyword, priority, confidence, pattern) in enumerate(NOTICES)]
