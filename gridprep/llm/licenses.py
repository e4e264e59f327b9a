"""License scans: ordered signature rules behind a keyword prefilter.

Each rule is a regular expression with a label, a priority and a keyword: words, from the beginning of the first on, that
any match contains. One Aho-Corasick pass over the text's words finds its keywords; only their rules run. Of overlapping
detections, one that lies inside another of at least its priority goes.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import groupby

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

from gridprep.llm.common import Words, chunks, id_long, id_text, small_batches, text_column

#: Phrases whose words stand consecutively, and their labels.
PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}

# Texts are scanned as Latin-1 views of their lower-cased UTF-8 bytes, so word characters are these:
_W = r"0-9a-z\x80-\xff"
_GAP = rf"[^{_W}]+"


@dataclass(frozen=True)
class Rule:
    label: str
    priority: int
    keyword: str
    pattern: str


def _phrase(words: str) -> str:
    """Whole words, with anything but word characters between them."""
    return rf"(?<![{_W}])" + _GAP.join(words.split()) + rf"(?![{_W}])"


def _number(v: str) -> str:
    """A version number, after an optional `version` or `v`."""
    major, _, minor = v.partition(".")
    tail = rf"\.{minor}" if minor and minor != "0" else r"(?:\.0)?"
    # possessive: a long gap is read once
    return rf"(?:[\s,\-]*+(?:version|ver|v)?+\.?+[\s\-]*+){major}{tail}(?![0-9]|\.[0-9])"


#: Clauses, notices and file headers as the licenses word them: label, keyword, words.
CLAUSES = [
    ("mit", "furnished to do so", "and to permit persons to whom the software is furnished to do so"),
    ("mit", "substantial portions", "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software"),
    ("mit", "deal in the software", "to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense"),
    ("mit", "fitness for a particular purpose and noninfringement", "fitness for a particular purpose and noninfringement in no event shall the authors or copyright holders be liable"),
    ("mit-0", "mit no attribution", "mit no attribution"),
    ("x11", "advertising or otherwise to promote", "shall not be used in advertising or otherwise to promote the sale use or other dealings in this software without prior written authorization"),
    ("isc", "the software is provided", "the software is provided as is and the author disclaims all warranties with regard to this software"),
    ("0bsd", "permission to use", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"),
    ("bsd", "redistributions of source", "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer"),
    ("bsd", "redistributions in binary", "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation"),
    ("bsd", "provided by the copyright holders", "this software is provided by the copyright holders and contributors as is"),
    ("bsd-3-clause", "neither the name", "neither the name of the copyright holder nor the names of its contributors may be used to endorse"),
    ("bsd-3-clause", "use of this source code", "use of this source code is governed by a bsd style license that can be found in the license file"),
    ("bsd-4-clause", "this product includes software developed by", "this product includes software developed by the university"),
    ("bsd-3-clause-clear", "no express or implied licenses", "no express or implied licenses to any party s patent rights are granted by this license"),
    ("apache-2.0", "you may not use this file", "you may not use this file except in compliance with the license"),
    ("apache-2.0", "unless required by applicable law", "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis"),
    ("apache-2.0", "www apache org", "www apache org licenses license 2 0"),
    ("apache-2.0", "licensed to the apache", "licensed to the apache software foundation asf under one or more contributor license agreements"),
    ("apache-2.0", "terms and conditions for use", "terms and conditions for use reproduction and distribution"),
    ("apache-1.1", "includes software developed by the apache", "this product includes software developed by the apache software foundation"),
    ("gpl", "this program is free software", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license"),
    ("gpl", "you should have received", "you should have received a copy of the gnu general public license along with this program"),
    ("gpl", "this program is distributed in the hope", "this program is distributed in the hope that it will be useful but without any warranty"),
    ("gpl-2.0-or-later", "either version 2", "either version 2 of the license or at your option any later version"),
    ("gpl-3.0-or-later", "either version 3", "either version 3 of the license or at your option any later version"),
    ("gpl-2.0", "59 temple place", "write to the free software foundation inc 59 temple place"),
    ("gpl", "everyone is permitted", "everyone is permitted to copy and distribute verbatim copies of this license document but changing it is not allowed"),
    ("gpl-3.0", "gpl 3 0 html", "www gnu org licenses gpl 3 0 html"),
    ("gpl-2.0", "gpl 2 0 html", "www gnu org licenses gpl 2 0 html"),
    ("gpl-classpath-exception", "classpath exception", "classpath exception"),
    ("gpl-classpath-exception", "as a special exception", "as a special exception the copyright holders of this library give you permission to link this library with independent modules"),
    ("gcc-exception-3.1", "runtime library exception", "gcc runtime library exception"),
    ("linux-syscall-note", "user programs that use kernel services", "this copyright does not cover user programs that use kernel services by normal system calls"),
    ("lgpl", "this library is free software", "this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license"),
    ("lgpl", "this library is distributed in the hope", "this library is distributed in the hope that it will be useful but without any warranty"),
    ("lgpl-2.1-or-later", "either version 2 1", "either version 2 1 of the license or at your option any later version"),
    ("agpl-3.0", "remote network interaction", "remote network interaction use with the gnu general public license"),
    ("agpl", "gnu affero general public", "you should have received a copy of the gnu affero general public license along with this program"),
    ("fdl", "invariant sections", "with no invariant sections no front cover texts and no back cover texts"),
    ("mpl-2.0", "mozilla org mpl", "if a copy of the mpl was not distributed with this file you can obtain one at https mozilla org mpl 2 0"),
    ("mpl-1.1", "the contents of this file are subject", "the contents of this file are subject to the mozilla public license version 1 1"),
    ("mpl-2.0-no-copyleft", "incompatible with secondary", "this source code form is incompatible with secondary licenses as defined by the mozilla public license"),
    ("epl-2.0", "eclipse org legal", "www eclipse org legal epl 2 0"),
    ("epl-1.0", "eclipse org legal", "www eclipse org legal epl v10 html"),
    ("cddl-1.0", "common development", "the contents of this file are subject to the terms of the common development and distribution license"),
    ("eupl", "licensed under the eupl", "licensed under the eupl"),
    ("artistic-2.0", "artistic license", "this is free software licensed under the artistic license 2 0"),
    ("perl", "you can redistribute it", "you can redistribute it and or modify it under the same terms as perl itself"),
    ("bsl-1.0", "permission is hereby granted", "permission is hereby granted free of charge to any person or organization obtaining a copy of the software and accompanying documentation"),
    ("bsl-1.0", "boost org", "www boost org license 1 0 txt"),
    ("zlib", "this software is provided as is", "this software is provided as is without any express or implied warranty in no event will the authors be held liable for any damages"),
    ("zlib", "altered source versions", "altered source versions must be plainly marked as such and must not be misrepresented as being the original software"),
    ("libpng", "png reference library", "the png reference library is supplied as is"),
    ("openssl", "openssl project", "this product includes software developed by the openssl project for use in the openssl toolkit"),
    ("ncsa", "deal with the software", "to deal with the software without restriction including without limitation"),
    ("postgresql", "without a written agreement", "without fee and without a written agreement is hereby granted"),
    ("unlicense", "anyone is free to copy", "anyone is free to copy modify publish use compile sell or distribute this software"),
    ("unlicense", "unlicense org", "please refer to http unlicense org"),
    ("cc0-1.0", "waived all copyright", "has waived all copyright and related or neighboring rights"),
    ("cc0-1.0", "cc0", "cc0 1 0 universal"),
    ("cc", "this work is licensed", "this work is licensed under a creative commons"),
    ("cc", "some rights reserved", "some rights reserved"),
    ("ofl-1.1", "this font software is licensed", "this font software is licensed under the sil open font license version 1 1"),
    ("odc-by-1.0", "open data commons attribution", "open data commons attribution license"),
    ("pddl-1.0", "public domain dedication", "public domain dedication and license"),
    ("wtfpl", "everyone is permitted to copy and distribute verbatim or modified", "everyone is permitted to copy and distribute verbatim or modified copies of this license document"),
    ("beerware", "buy me a beer", "if we meet some day and you think this stuff is worth it you can buy me a beer in return"),
    ("json", "good not evil", "the software shall be used for good not evil"),
    ("curl", "permission to use", "permission to use copy modify and distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies"),
    ("icu", "permission is hereby", "permission is hereby granted free of charge to any person obtaining a copy of the unicode data files"),
    ("vim", "charityware", "vim is charityware"),
    ("afl-3.0", "academic free", "licensed under the academic free license version 3 0"),
    ("osl-3.0", "open software", "licensed under the open software license version 3 0"),
    ("ms-pl", "this license governs", "this license governs use of the accompanying software if you use the software you accept this license"),
    ("elastic-2.0", "elastic license", "elastic license 2 0"),
    ("busl-1.1", "change date", "change date change license"),
    ("sspl-1.0", "functionality of the program", "if you make the functionality of the program or a modified version available to third parties as a service"),
    ("commons-clause", "commons clause", "commons clause license condition"),
    ("proprietary", "unauthorized copying", "unauthorized copying of this file via any medium is strictly prohibited"),
    ("proprietary", "trade secret", "contains proprietary and trade secret information"),
    ("proprietary", "no part of this", "no part of this publication may be reproduced"),
    ("proprietary", "internal use only", "for internal use only"),
    ("proprietary", "non disclosure agreement", "under the terms of a non disclosure agreement"),
    ("commercial", "end user license agreement", "end user license agreement"),
    ("non-commercial", "non commercial use only", "for non commercial use only"),
    ("non-commercial", "research purposes only", "for research purposes only"),
    ("public-domain", "not subject to copyright", "is not subject to copyright protection"),
    ("public-domain", "work of the", "work of the united states government"),
]


def rules() -> list[Rule]:
    """The rule table, with a guard before each pattern: no match begins inside a word."""
    guard = rf"(?<![{_W}])"
    return [r if r.pattern.startswith(guard) else Rule(r.label, r.priority, r.keyword, guard + r.pattern) for r in _table()]


def _table() -> list[Rule]:
    """Signatures, clauses and headers word by word; names by families, with their versions and variants filled in."""
    out: list[Rule] = []
    # full signatures: sentences that only one license text holds
    signatures = [
        ("mit", "permission is hereby granted", "permission is hereby granted free of charge to any person obtaining a copy"),
        ("isc", "permission to use", "permission to use copy modify and or distribute this software for any purpose with or without fee"),
        ("bsd-2-clause", "redistribution and use", "redistribution and use in source and binary forms with or without modification are permitted"),
        ("bsd-3-clause", "endorse or promote", "may be used to endorse or promote products derived from this software without specific prior written permission"),
        ("bsd-4-clause", "advertising materials", "all advertising materials mentioning features or use of this software must display the following acknowledgement"),
        ("zlib", "origin of this software", "the origin of this software must not be misrepresented"),
        ("unlicense", "unencumbered software", "this is free and unencumbered software released into the public domain"),
        ("wtfpl", "what the fuck", "do what the fuck you want to public license"),
        ("apache-2.0", "licensed under the apache", "licensed under the apache license version 2 0"),
        ("gpl", "free software foundation", "under the terms of the gnu general public license as published by the free software foundation"),
        ("lgpl", "free software foundation", "under the terms of the gnu lesser general public license as published by the free software foundation"),
        ("agpl", "free software foundation", "under the terms of the gnu affero general public license as published by the free software foundation"),
        ("mpl-2.0", "mozilla public", "this source code form is subject to the terms of the mozilla public license v 2 0"),
        ("epl", "eclipse public", "this program and the accompanying materials are made available under the terms of the eclipse public license"),
        ("cc0-1.0", "dedicated", "dedicated all copyright and related and neighboring rights to this software to the public domain"),
        ("bsl-1.0", "boost software", "distributed under the boost software license version 1 0"),
        ("proprietary", "all rights reserved", "all rights reserved"),
        ("public-domain", "public domain", "released into the public domain"),
        ("public-domain", "public domain", "placed in the public domain"),
        ("public-domain", "public domain", "dedicated to the public domain"),
    ]
    out += [Rule(label, 90, key, _phrase(text)) for label, key, text in signatures]
    out += [Rule(label, 85, key, _phrase(text)) for label, key, text in CLAUSES]
    # SPDX lines
    spdx = "mit apache-2.0 bsd-2-clause bsd-3-clause isc zlib unlicense 0bsd mpl-2.0 epl-1.0 epl-2.0 cc0-1.0 bsl-1.0 artistic-2.0 ncsa postgresql python-2.0 wtfpl gpl-2.0 gpl-3.0 lgpl-2.1 lgpl-3.0 agpl-3.0 gpl-2.0-only gpl-2.0-or-later gpl-3.0-only gpl-3.0-or-later lgpl-2.1-only lgpl-2.1-or-later lgpl-3.0-only lgpl-3.0-or-later agpl-3.0-only agpl-3.0-or-later"
    out += [Rule(x, 100, "spdx-license-identifier", rf"spdx-license-identifier:\s*{re.escape(x)}(?![{_W}.\-])") for x in spdx.split()]
    # names with versions
    families = [
        ("apache", "apache", r"apache(?:\s+software)?\s+licen[cs]e", "1.0 1.1 2.0"),
        ("gpl", "general public", r"(?:gnu\s+)?general\s+public\s+licen[cs]e", "1.0 2.0 3.0"),
        ("gpl", "gpl", rf"(?<![{_W}])(?:gnu\s+)?gpl", "1.0 2.0 3.0"),
        ("lgpl", "lgpl", rf"(?<![{_W}])(?:gnu\s+)?lgpl", "2.0 2.1 3.0"),
        ("lgpl", "lesser general", r"(?:gnu\s+)?lesser\s+general\s+public\s+licen[cs]e", "2.1 3.0"),
        ("lgpl", "library general", r"(?:gnu\s+)?library\s+general\s+public\s+licen[cs]e", "2.0"),
        ("agpl", "agpl", rf"(?<![{_W}])(?:gnu\s+)?agpl", "1.0 3.0"),
        ("agpl", "affero general", r"(?:gnu\s+)?affero\s+general\s+public\s+licen[cs]e", "1.0 3.0"),
        ("fdl", "free documentation", r"(?:gnu\s+)?free\s+documentation\s+licen[cs]e", "1.1 1.2 1.3"),
        ("mpl", "mozilla public", r"mozilla\s+public\s+licen[cs]e", "1.0 1.1 2.0"),
        ("mpl", "mpl", rf"(?<![{_W}])mpl", "1.0 1.1 2.0"),
        ("epl", "eclipse public", r"eclipse\s+public\s+licen[cs]e", "1.0 2.0"),
        ("eupl", "european union public", r"european\s+union\s+public\s+licen[cs]e", "1.0 1.1 1.2"),
        ("eupl", "eupl", rf"(?<![{_W}])eupl", "1.0 1.1 1.2"),
        ("cddl", "common development", r"common\s+development\s+and\s+distribution\s+licen[cs]e", "1.0 1.1"),
        ("cpl", "common public", r"common\s+public\s+licen[cs]e", "1.0"),
        ("artistic", "artistic", r"artistic\s+licen[cs]e", "1.0 2.0"),
        ("osl", "open software", r"open\s+software\s+licen[cs]e", "1.0 2.0 2.1 3.0"),
        ("afl", "academic free", r"academic\s+free\s+licen[cs]e", "1.1 1.2 2.0 2.1 3.0"),
        ("ofl", "open font", r"(?:sil\s+)?open\s+font\s+licen[cs]e", "1.0 1.1"),
        ("odbl", "open d", r"open\s+(?:data\s+commons\s+)?(?:open\s+)?database\s+licen[cs]e", "1.0"),
        ("bsl", "boost software", r"boost\s+software\s+licen[cs]e", "1.0"),
        ("busl", "business source", r"business\s+source\s+licen[cs]e", "1.0 1.1"),
        ("sspl", "server side public", r"server\s+side\s+public\s+licen[cs]e", "1.0"),
        ("lppl", "latex project", r"latex\s+project\s+public\s+licen[cs]e", "1.0 1.1 1.2 1.3"),
        ("qpl", "q public", r"q\s+public\s+licen[cs]e", "1.0"),
        ("zpl", "zope public", r"zope\s+public\s+licen[cs]e", "1.1 2.0 2.1"),
        ("cecill", "cecill", r"cecill", "1.0 2.0 2.1"),
        ("ms-pl", "microsoft public", r"microsoft\s+public\s+licen[cs]e", "1.0"),
    ]
    for label, key, name, versions in families:
        out.append(Rule(label, 40, key, name + rf"(?![{_W}])"))
        for v in versions.split():
            out.append(Rule(f"{label}-{v}", 60, key, name + _number(v)))
            if label in ("gpl", "lgpl", "agpl", "fdl"):
                later = r"[\s,;(]*(?:\(at\s+your\s+option\)\s*)?(?:or|\+)[\s,]*(?:\(at\s+your\s+option\)[\s,]*)?(?:any\s+later|later)"
                out.append(Rule(f"{label}-{v}-or-later", 70, key, name + _number(v) + later))
                out.append(Rule(f"{label}-{v}-only", 70, key, name + _number(v) + r"[\s,]*only"))
    # Creative Commons: terms x versions, by name and by address
    terms = {"by": r"attribution", "by-sa": r"attribution[\s\-]+share\s?alike", "by-nd": r"attribution[\s\-]+no\s?deriv(?:ative|ative\s+work|ation)?s", "by-nc": r"attribution[\s\-]+non\s?commercial", "by-nc-sa": r"attribution[\s\-]+non\s?commercial[\s\-]+share\s?alike", "by-nc-nd": r"attribution[\s\-]+non\s?commercial[\s\-]+no\s?deriv(?:ative|ative\s+work|ation)?s"}
    for term, name in terms.items():
        for v in ("1.0", "2.0", "2.5", "3.0", "4.0"):
            out.append(Rule(f"cc-{term}-{v}", 80, "creative commons", rf"creative\s+commons\s+{name}(?:\s+international|\s+unported|\s+generic|\s+licen[cs]e)*{_number(v)}"))
            out.append(Rule(f"cc-{term}-{v}", 80, "creativecommons.org", rf"creativecommons\.org/licenses/{term}/{re.escape(v)}(?![0-9])"))
            out.append(Rule(f"cc-{term}-{v}", 75, "cc", rf"(?<![{_W}])cc[\s\-]{re.escape(term).replace(chr(92) + '-', '[ -]')}{_number(v)}"))
        out.append(Rule(f"cc-{term}", 50, "creative commons", rf"creative\s+commons\s+{name}(?![{_W}])"))
    out += [Rule("cc", 30, "creative commons", _phrase("creative commons license")), Rule("cc0-1.0", 80, "creativecommons.org", r"creativecommons\.org/publicdomain/zero/1\.0")]
    # plain names
    plain = [("mit", "mit", "mit license"), ("mit", "mit", "mit licence"), ("mit", "mit", "licensed under mit"), ("x11", "x11", "x11 license"), ("isc", "isc", "isc license"), ("bsd", "bsd", "bsd license"), ("bsd-2-clause", "simplified bsd", "simplified bsd license"), ("bsd-3-clause", "new bsd", "new bsd license"), ("bsd-3-clause", "modified bsd", "modified bsd license"), ("bsd-2-clause", "freebsd", "freebsd license"), ("zlib", "zlib", "zlib license"), ("unlicense", "unlicense", "the unlicense"), ("psf", "python software", "python software foundation license"), ("php", "php", "php license"), ("ruby", "ruby", "ruby license"), ("openssl", "openssl", "openssl license"), ("postgresql", "postgresql", "postgresql license"), ("ncsa", "ncsa", "university of illinois ncsa open source license"), ("vim", "vim", "vim license"), ("beerware", "beerware", "beerware license"), ("perl", "perl", "same terms as perl itself"), ("proprietary", "proprietary", "proprietary and confidential"), ("proprietary", "proprietary", "proprietary license"), ("commercial", "commercial", "commercial license")]
    out += [Rule(label, 40, key, _phrase(text)) for label, key, text in plain]
    for n, word in (("2", "two"), ("3", "three"), ("4", "four")):
        out += [Rule(f"bsd-{n}-clause", 60, "bsd", _phrase(f"bsd {k} clause")) for k in (n, word)] + [Rule(f"bsd-{n}-clause", 60, "bsd", _phrase(f"{k} clause bsd")) for k in (n, word)]
    return out


#: Every byte that is no word character becomes a blank.
_SPACED = bytes(c if re.match(rf"[{_W}]", chr(c)) else 32 for c in range(256))


def _words(view: bytes) -> str:
    """The words of lower-cased UTF-8 bytes, one blank before and after each."""
    return f" {b' '.join(view.translate(_SPACED).split()).decode('latin-1')} "


@lru_cache(maxsize=1)
def _machine():
    import ahocorasick

    by_key: dict[str, list[tuple[int, str, re.Pattern]]] = {}
    for r in rules():
        by_key.setdefault(_words(r.keyword.encode())[:-1], []).append((r.priority, r.label, re.compile(r.pattern)))
    machine = ahocorasick.Automaton()
    base = [(label, re.compile(_phrase(p))) for p, label in PHRASES.items()]
    for key in [*by_key, *(f" {p} " for p in PHRASES)]:
        machine.add_word(key, key)
    machine.make_automaton()
    return machine, by_key, base


def resolve(found: list[tuple[int, int, int, str]]) -> list[tuple[int, int, int, str]]:
    """Of (start, end, priority, label), what lies inside no other of at least its priority; of equal ones the first label.

    Priority by priority, each in the order of starts, longer ones first: a detection lies inside another if the largest
    end of those that begin no later, of higher priorities or before it in its own, reaches its own end.
    """
    kept: list[tuple[int, int, int, str]] = []
    above = np.zeros((0, 2), np.int64)  # starts and ends of higher priorities, sorted, the ends as running maxima
    for _, level in groupby(sorted(set(found), key=lambda d: (-d[2], d[0], -d[1], d[3])), key=lambda d: d[2]):
        level = list(level)
        bounds = np.array([d[:2] for d in level], np.int64)
        at = np.searchsorted(above[:, 0], bounds[:, 0], side="right")
        over = np.concatenate(([-1], above[:, 1]))[at]
        own = np.concatenate(([-1], np.maximum.accumulate(bounds[:, 1])[:-1]))
        kept += [level[i] for i in np.flatnonzero((over < bounds[:, 1]) & (own < bounds[:, 1]))]
        above = np.concatenate((above, bounds))
        above = above[above[:, 0].argsort(kind="stable")]
        above[:, 1] = np.maximum.accumulate(above[:, 1])
    return sorted(kept)


def scan(raw: bytes) -> tuple[list[tuple[int, int, int, str]], list[tuple[int, int, str]]]:
    """Detections of the rules and places of the base phrases in lower-cased UTF-8 bytes."""
    machine, by_key, base = _machine()
    keys = {key for _, key in machine.iter(_words(raw))}
    if not keys:
        return [], []
    view = raw.decode("latin-1")
    found = [(m.start(), m.end(), p, label) for k in keys if k in by_key for p, label, rx in by_key[k] for m in rx.finditer(view)]
    places = [(m.start(), m.end(), label) for label, rx in base for m in rx.finditer(view)] if any(k[-1] == " " for k in keys) else []
    return resolve(found), places


SCHEMA = "doc_id string, n_words long, detections array<struct<label:string,priority:int,first_word:long,last_word:long>>, phrases array<struct<label:string,first_word:long>>"


def _scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        texts = pdf["text"].tolist()
        for a, b in chunks(texts):
            w = Words(texts[a:b], hashed=False)
            view = w.data.tobytes().lower()
            detections, phrases = [], []
            for i in range(b - a):
                at, first = int(w.offset[i]), int(w.first[i])
                found, places = scan(view[at : int(w.offset[i + 1])])
                word = lambda x: int(np.searchsorted(w.start, x, side="right")) - 1 - first  # noqa: B023, E731
                detections.append([{"label": d[3], "priority": d[2], "first_word": word(at + d[0]), "last_word": word(at + d[1] - 1)} for d in found])
                phrases.append([{"label": p[2], "first_word": word(at + p[0])} for p in places])
            yield pd.DataFrame({"doc_id": pdf["doc_id"].iloc[a:b].to_numpy(), "n_words": np.diff(w.first), "detections": detections, "phrases": phrases})


def license_scan(docs: DataFrame) -> DataFrame:
    """Detections in every whole text: one row per input row with doc_id, n_words, detections, phrases.

    ``detections`` are the rules' matches left after suppression, with the words they span (from 0); ``phrases`` are all
    places of the fixed phrases. Null texts are empty: no words, empty lists. Repeated rows and equal ids give a row
    each; a null doc_id stays null; columns other than doc_id and text are ignored, whatever their names.
    """
    small_batches(docs.sparkSession)
    return id_long(docs.select(id_text(), text_column(docs)).mapInPandas(_scan, SCHEMA))
