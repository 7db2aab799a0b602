"""Signatures of licence statements, as an ordered list of rules.

Rules are written over words: ``a|b`` is either word, ``[a]`` a word that may be missing. Texts are
lower-cased and cut into words beforehand, so ``CC BY-NC 4.0`` reads ``cc by nc 4 0``.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

LICENSE = "license|licence"

#: Label, then the ways to name the licence. The first plain word of each is its keyword.
NAMES: tuple[tuple[str, ...], ...] = (
    ("mit", "mit", "expat"),
    ("x11", "x11", "mit x11"),
    ("isc", "isc", "internet systems consortium"),
    ("apache-2", "apache 2 [0]", "apache license|licence [version|v] 2 [0]", "apache software license|licence [version|v] 2 [0]", "apachev2|asl2"),
    ("apache-1.1", "apache 1 1", "apache [software] license|licence [version|v] 1 1"),
    ("apache", "apache", "apache software"),
    ("bsd-2-clause", "bsd 2 clause", "2 clause bsd", "simplified bsd", "freebsd"),
    ("bsd-3-clause", "bsd 3 clause", "3 clause bsd", "new bsd", "modified bsd", "revised bsd"),
    ("bsd-4-clause", "bsd 4 clause", "4 clause bsd", "original bsd"),
    ("bsd", "bsd", "berkeley software distribution"),
    ("gpl-1", "gpl v1|1", "gplv1", "gnu general public license|licence [version|v] 1|v1"),
    ("gpl-2", "gpl v2|2 [0]", "gplv2", "gnu gpl [version] v2|2 [0]", "gnu general public license|licence [version|v] 2|v2 [0]"),
    ("gpl-3", "gpl v3|3 [0]", "gplv3", "gnu gpl [version] v3|3 [0]", "gnu general public license|licence [version|v] 3|v3 [0]"),
    ("gpl", "gpl", "gnu gpl", "gnu general public"),
    ("lgpl-2.1", "lgpl v2|2 1", "lgplv2", "gnu lesser general public license|licence [version|v] 2|v2 1"),
    ("lgpl-3", "lgpl v3|3 [0]", "lgplv3", "gnu lesser general public license|licence [version|v] 3|v3 [0]"),
    ("lgpl", "lgpl", "gnu lgpl", "gnu lesser general public", "gnu library general public"),
    ("agpl-3", "agpl v3|3 [0]", "agplv3", "gnu affero general public license|licence [version|v] 3|v3 [0]"),
    ("agpl", "agpl", "gnu affero general public", "affero general public"),
    ("gfdl", "gfdl", "gnu fdl", "gnu free documentation"),
    ("mpl-1.1", "mpl 1 1", "mozilla public license|licence [version|v] 1 1"),
    ("mpl-2", "mpl [v] 2 [0]", "mplv2", "mozilla public license|licence [version|v] 2 [0]"),
    ("mpl", "mpl", "mozilla public"),
    ("epl-1", "epl 1 [0]", "eclipse public license|licence [version|v] 1 [0]"),
    ("epl-2", "epl 2 [0]", "eclipse public license|licence [version|v] 2 [0]"),
    ("epl", "epl", "eclipse public"),
    ("cddl", "cddl [1] [0|1]", "common development and distribution"),
    ("cpl", "common public"),
    ("eupl", "eupl [v1|1] [1|2]", "european union public"),
    ("cc0", "cc0 [1] [0]", "cc zero", "creative commons zero"),
    ("cc-by", "cc by", "creative commons attribution"),
    ("cc-by-sa", "cc by sa", "creative commons attribution sharealike", "creative commons attribution share alike"),
    ("cc-by-nd", "cc by nd", "creative commons attribution noderivatives|noderivs", "creative commons attribution no derivatives|derivs"),
    ("cc-by-nc", "cc by nc", "creative commons attribution noncommercial", "creative commons attribution non commercial"),
    ("cc-by-nc-sa", "cc by nc sa", "creative commons attribution noncommercial sharealike", "creative commons attribution non commercial share alike"),
    ("cc-by-nc-nd", "cc by nc nd", "creative commons attribution noncommercial noderivatives|noderivs", "creative commons attribution non commercial no derivatives|derivs"),
    ("artistic-1", "artistic 1 [0]", "artistic license|licence 1 [0]"),
    ("artistic-2", "artistic 2 [0]", "artistic license|licence 2 [0]"),
    ("artistic", "artistic", "perl artistic"),
    ("boost", "boost software", "bsl 1 [0]", "boost"),
    ("zlib", "zlib", "zlib libpng"),
    ("unlicense", "unlicense"),
    ("wtfpl", "wtfpl", "do what the fuck you want to public"),
    ("ofl-1.1", "ofl [1] [1]", "sil open font", "open font"),
    ("psf", "psf", "python software foundation", "python"),
    ("postgresql", "postgresql", "postgres"),
    ("ruby", "ruby"),
    ("php", "php [3] [0|01]"),
    ("w3c", "w3c", "w3c software [notice] [and]"),
    ("ncsa", "ncsa", "university of illinois ncsa [open] [source]"),
    ("ecl-2", "ecl 2 [0]", "educational community"),
    ("ms-pl", "ms pl", "microsoft public"),
    ("ms-rl", "ms rl", "microsoft reciprocal"),
    ("afl", "afl [3|2] [0|1]", "academic free"),
    ("osl", "osl [3] [0]", "open software"),
    ("upl", "upl [1] [0]", "universal permissive"),
    ("bsl-1.1", "busl 1 1", "business source"),
    ("openssl", "openssl"),
    ("vim", "vim"),
    ("sleepycat", "sleepycat"),
    ("odbl", "odbl [1] [0]", "open database"),
    ("elastic-2", "elastic license|licence 2 [0]", "elastic"),
    ("sspl", "sspl [1] [0]", "server side public"),
)

#: Priority, score and wording around a name (``{}``): the higher goes first.
FRAMES: tuple[tuple[int, float, str], ...] = (
    (4, 1.0, "spdx license identifier {}"),
    (3, 0.98, "licensed|released|distributed|published|available|provided|redistributed|offered|covered under|by [the] [terms] [and] [conditions] [of] [the] [a] {} [license|licence] [version|v] [1|2|3|4] [0|1|5]"),
    (3, 0.95, "under|to|with [the] terms of [the] {} [license|licence]"),
    (3, 0.9, "subject|according to [the] {} license|licence"),
    (2, 0.85, "license|licence {}"),
    (2, 0.85, "{} licensed"),
    (1, 0.8, "{} license|licence [agreement|version|v] [1|2|3|4] [0|1]"),
)

#: Sentences that stand for a licence by themselves: label, priority, score, words.
SENTENCES: tuple[tuple[str, int, float, str], ...] = (
    ("mit", 5, 0.97, "permission is hereby granted free of charge to any person obtaining a copy"),
    ("isc", 5, 0.97, "permission to use copy modify and or distribute this software for any purpose"),
    ("bsd", 5, 0.95, "redistribution and use in source and binary forms with or without modification are permitted"),
    ("gpl", 5, 0.95, "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license|licence"),
    ("lgpl", 5, 0.95, "this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license|licence"),
    ("apache-2", 5, 0.97, "you may not use this file except in compliance with the license|licence"),
    ("mpl-2", 5, 0.97, "this source code form is subject to the terms of the mozilla public license|licence"),
    ("public-domain", 5, 0.9, "released|dedicated|placed [in|into|to] the public domain"),
    ("public-domain", 2, 0.7, "in the public domain"),
    ("unlicense", 5, 0.95, "this is free and unencumbered software released into the public domain"),
    ("proprietary", 2, 0.7, "all rights reserved"),
    ("proprietary", 3, 0.8, "proprietary and confidential"),
    ("wtfpl", 5, 0.95, "you just do what the fuck you want to"),
    ("boost", 5, 0.97, "permission is hereby granted free of charge to any person or organization obtaining a copy"),
)


@dataclass(frozen=True)
class Rule:
    number: int
    label: str
    priority: int
    score: float
    keyword: str
    pattern: str


def pattern(words: str) -> str:
    """A regular expression over words that are written ``<word `` one after another."""
    parts = []
    for token in words.split():
        either = "|".join(map(re.escape, token.strip("[]").split("|")))
        one = f"<(?:{either}) "
        parts.append(f"(?:{one})?" if token[0] == "[" else one)
    return "".join(parts)


def keyword(words: str) -> str:
    """A word that every match holds: the longest that is neither optional nor one of several."""
    plain = [t for t in words.split() if t[0] != "[" and "|" not in t]
    return max(plain, key=len) if plain else ""


def rules() -> list[Rule]:
    """All rules in order: sentences, then every frame around every name.

    A name whose words are all alternatives has no keyword of its own and is written out.
    """
    found: list[tuple[str, int, float, str, str]] = [(label, p, s, keyword(w), w) for label, p, s, w in SENTENCES]
    for label, *names in NAMES:
        for name in names:
            for one in name.split("|") if " " not in name else [name]:
                bare = [(1, 0.75, "{}")] if LICENSE in one else []  # says that it is a licence by itself
                for priority, score, frame in [*FRAMES, *bare]:
                    found.append((label, priority, score, keyword(one) or keyword(frame), frame.format(one)))
    return [Rule(i, label, p, s, k, pattern(w)) for i, (label, p, s, k, w) in enumerate(found)]
