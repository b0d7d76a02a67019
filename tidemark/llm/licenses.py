"""Licences in texts by their sentences.

A text is cut into pieces at line ends and sentence ends; each is normalised, which also strips
comment marks. A known licence sentence is found where one piece or several in a row give its
words, whatever the lines or marks it is broken at, and gets an identifier. What is left of a text
is the sequence of identifiers, with a mark for every other piece. A rule names a licence by the identifiers that make it up, in order;
its members may be apart by a few other sentences. Sentences that name a licence in passing ("is released under the
MIT License, see ..."), tags ("SPDX-License-Identifier: MIT OR Apache-2.0") and titles have identifiers of their own, one for
each licence they name. Rules are applied in the order of ``RULES``, from the
longest to the shortest, and a sentence that belongs to one match is not used for another.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

from tidemark.llm.common import read_table, texts_of, tidied, word_codes
from tidemark.llm.token_ids import parts_of

#: Other sentences that may lie between two members of a rule.
GAP = 2

# Licence sentences as their licences have them, normalised (lower case, letters and
# digits only, one blank between words). <n> stands for a version of ``VERSIONS``.
SENTENCES = {
    "apache-notice": "licensed under the apache license version <n>",
    "apache-may-not": "you may not use this file except in compliance with the license",
    "apache-copy": "you may obtain a copy of the license at http www apache org licenses license 2 0",
    "apache-as-is": (
        "unless required by applicable law or agreed to in writing software distributed under the license is distributed "
        "on an as is basis without warranties or conditions of any kind either express or implied"
    ),
    "apache-limits": "see the license for the specific language governing permissions and limitations under the license",
    "mit-notice": "released under the mit license",
    "mit-licensed": "licensed under the mit license",
    "mit-grant": (
        "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation "
        "files the software to deal in the software without restriction including without limitation the rights to use copy modify "
        "merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is "
        "furnished to do so subject to the following conditions"
    ),
    "mit-keep": "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software",
    "mit-as-is": (
        "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties "
        "of merchantability fitness for a particular purpose and noninfringement"
    ),
    "mit-liability": (
        "in no event shall the authors or copyright holders be liable for any claim damages or other liability whether in an action "
        "of contract tort or otherwise arising from out of or in connection with the software or the use or other dealings in the software"
    ),
    "bsd-grant": (
        "redistribution and use in source and binary forms with or without modification are permitted provided that the following "
        "conditions are met"
    ),
    "bsd-source": "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer",
    "bsd-binary": (
        "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following "
        "disclaimer in the documentation and or other materials provided with the distribution"
    ),
    "bsd-names": (
        "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products "
        "derived from this software without specific prior written permission"
    ),
    "isc-grant": (
        "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted "
        "provided that the above copyright notice and this permission notice appear in all copies"
    ),
    "gpl-notice": "this work is licensed under the gnu general public license version <n>",
    "gpl-free": (
        "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as "
        "published by the free software foundation either version <n> of the license or at your option any later version"
    ),
    "gpl-hope": (
        "this program is distributed in the hope that it will be useful but without any warranty without even the implied warranty of "
        "merchantability or fitness for a particular purpose"
    ),
    "gpl-details": "see the gnu general public license for more details",
    "gpl-title": "gnu general public license version <n> 29 june 2007",
    "lgpl-free": (
        "this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license as "
        "published by the free software foundation either version <n> of the license or at your option any later version"
    ),
    "lgpl-hope": (
        "this library is distributed in the hope that it will be useful but without any warranty without even the implied warranty of "
        "merchantability or fitness for a particular purpose"
    ),
    "lgpl-details": "see the gnu lesser general public license for more details",
    "lgpl-title": "gnu lesser general public license version <n> 29 june 2007",
    "agpl-free": (
        "this program is free software you can redistribute it and or modify it under the terms of the gnu affero general public license as "
        "published by the free software foundation either version <n> of the license or at your option any later version"
    ),
    "agpl-details": "see the gnu affero general public license for more details",
    "agpl-title": "gnu affero general public license version <n> 19 november 2007",
    "apache-title": "apache license version <n> january 2004",
    "mpl-notice": "this source code form is subject to the terms of the mozilla public license v <n>",
    "mpl-title": "mozilla public license version <n> 1 definitions",
    "bsd-advert": "all advertising materials mentioning features or use of this software must display the following acknowledgement",
    "0bsd-grant": "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted",
    "zlib-grant": (
        "permission is granted to anyone to use this software for any purpose including commercial applications and to alter it and "
        "redistribute it freely subject to the following restrictions"
    ),
    "zlib-origin": "the origin of this software must not be misrepresented you must not claim that you wrote the original software",
    "unlicense": "this is free and unencumbered software released into the public domain",
    "bsl-grant": (
        "permission is hereby granted free of charge to any person or organization obtaining a copy of the software and accompanying "
        "documentation covered by this license the software to use reproduce display distribute execute and transmit the software and "
        "to prepare derivative works of the software and to permit third parties to whom the software is furnished to do so all subject "
        "to the following"
    ),
    "epl-notice": (
        "this program and the accompanying materials are made available under the terms of the eclipse public license v<n> which "
        "accompanies this distribution and is available at"
    ),
    "cc0-title": "creative commons legal code cc0 <n> universal",
    "cc-by-notice": "licensed under cc by <n>",
    "cc-by-sa-notice": "licensed under cc by sa <n>",
    "cc-by-nc-notice": "licensed under cc by nc <n>",
    "cc-by-nd-notice": "licensed under cc by nd <n>",
    "cc-by-nc-sa-notice": "licensed under cc by nc sa <n>",
    "cc-by-nc-nd-notice": "licensed under cc by nc nd <n>",
    "cc-by-work": "this work is licensed under a creative commons attribution <n> international license",
    "reserved": "all rights reserved",
}

# Other wordings of some of them. <x> stands for 1 to ``WILD`` words, such as an owner's name.
WORDINGS = {
    "apache-notice": (
        "licensed under the apache license version <n> the license",
        "the asf licenses this file to you under the apache license version <n> the license",
        "<x> licenses this file to you under the apache license version <n> the license",
    ),
    "apache-copy": ("you may obtain a copy of the license at https www apache org licenses license 2 0",),
    "apache-title": ("apache license version <n> january 2004 http www apache org licenses", "apache license version <n> january 2004 https www apache org licenses"),
    "mit-keep": (
        "the above copyright notice and this permission notice including the next paragraph shall be included in all copies or "
        "substantial portions of the software",
    ),
    "bsd-source": ("redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer in this position and unchanged",),
    "bsd-names": (
        "neither the name of <x> nor the names of its contributors may be used to endorse or promote products derived from this software "
        "without specific prior written permission",
        "neither the name of <x> nor the names of <x> contributors may be used to endorse or promote products derived from this software "
        "without specific prior written permission",
        "neither the names of <x> nor the names of its contributors may be used to endorse or promote products derived from this software "
        "without specific prior written permission",
        "the name of <x> may not be used to endorse or promote products derived from this software without specific prior written permission",
    ),
    "isc-grant": (
        "permission to use copy modify and distribute this software for any purpose with or without fee is hereby granted "
        "provided that the above copyright notice and this permission notice appear in all copies",
    ),
    "gpl-free": (
        "<x> is free software you can redistribute it and or modify it under the terms of the gnu general public license as "
        "published by the free software foundation either version <n> of the license or at your option any later version",
        "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license "
        "version <n> as published by the free software foundation",
    ),
    "gpl-hope": (
        "<x> is distributed in the hope that it will be useful but without any warranty without even the implied warranty of "
        "merchantability or fitness for a particular purpose",
    ),
    "lgpl-free": (
        "<x> is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license as "
        "published by the free software foundation either version <n> of the license or at your option any later version",
    ),
    "gpl-title": ("gnu general public license version <n> june 1991",),
    "lgpl-title": ("gnu lesser general public license version <n> february 1999",),
    "epl-notice": (
        "this program and the accompanying materials are made available under the terms of the eclipse public license v<n> which "
        "accompanies this distribution and is available at http www eclipse org legal epl v10 html",
        "this program and the accompanying materials are made available under the terms of the eclipse public license <n> which is available at",
        "this program and the accompanying materials are made available under the terms of the eclipse public license <n> which is available at "
        "https www eclipse org legal epl 2 0",
    ),
}
WILD = 12
VERSIONS = ("1 0", "1 1", "2 0", "2 1", "2 5", "3 0", "4 0", "1", "2", "3")

# Licences by the sentences that make them up; the first member's version is the licence's.
RULES = (
    ("Apache", ("apache-notice", "apache-may-not", "apache-copy", "apache-as-is", "apache-limits")),
    ("MIT", ("mit-grant", "mit-keep", "mit-as-is", "mit-liability")),
    ("BSD-4-Clause", ("bsd-grant", "bsd-source", "bsd-binary", "bsd-advert")),
    ("BSD-3-Clause", ("bsd-grant", "bsd-source", "bsd-binary", "bsd-names")),
    ("BSD-2-Clause", ("bsd-grant", "bsd-source", "bsd-binary")),
    ("GPL", ("gpl-free", "gpl-hope", "gpl-details")),
    ("LGPL", ("lgpl-free", "lgpl-hope", "lgpl-details")),
    ("LGPL", ("lgpl-free", "gpl-hope", "lgpl-details")),
    ("AGPL", ("agpl-free", "gpl-hope", "agpl-details")),
    ("Zlib", ("zlib-grant", "zlib-origin")),
    ("Apache", ("apache-notice",)),
    ("Apache", ("apache-title",)),
    ("MIT", ("mit-notice",)),
    ("MIT", ("mit-licensed",)),
    ("ISC", ("isc-grant",)),
    ("0BSD", ("0bsd-grant",)),
    ("GPL", ("gpl-notice",)),
    ("GPL", ("gpl-free",)),
    ("GPL", ("gpl-title",)),
    ("LGPL", ("lgpl-free",)),
    ("LGPL", ("lgpl-title",)),
    ("AGPL", ("agpl-free",)),
    ("AGPL", ("agpl-title",)),
    ("MPL", ("mpl-notice",)),
    ("MPL", ("mpl-title",)),
    ("EPL", ("epl-notice",)),
    ("BSL-1.0", ("bsl-grant",)),
    ("Unlicense", ("unlicense",)),
    ("CC0", ("cc0-title",)),
    ("CC-BY", ("cc-by-notice",)),
    ("CC-BY", ("cc-by-work",)),
    ("CC-BY-SA", ("cc-by-sa-notice",)),
    ("CC-BY-NC", ("cc-by-nc-notice",)),
    ("CC-BY-ND", ("cc-by-nd-notice",)),
    ("CC-BY-NC-SA", ("cc-by-nc-sa-notice",)),
    ("CC-BY-NC-ND", ("cc-by-nc-nd-notice",)),
    ("All-rights-reserved", ("reserved",)),
)

# How notices, tags and titles name licences, normalised.
NAMES = {
    "MIT": ("mit", "expat", "mit expat"),
    "Apache": ("apache", "apache software", "asl"),
    "BSD-2-Clause": ("bsd 2 clause", "2 clause bsd", "two clause bsd", "simplified bsd", "freebsd"),
    "BSD-3-Clause": ("bsd 3 clause", "3 clause bsd", "three clause bsd", "new bsd", "modified bsd", "revised bsd"),
    "BSD-4-Clause": ("bsd 4 clause", "4 clause bsd", "original bsd"),
    "BSD": ("bsd",),
    "0BSD": ("0bsd", "bsd zero clause", "zero clause bsd"),
    "GPL": ("gpl", "gnu gpl", "gnu general public", "general public"),
    "LGPL": ("lgpl", "gnu lgpl", "gnu lesser general public", "lesser general public", "gnu library general public"),
    "AGPL": ("agpl", "gnu agpl", "gnu affero general public", "affero general public"),
    "MPL": ("mpl", "mozilla public"),
    "EPL": ("epl", "eclipse public"),
    "ISC": ("isc",),
    "Zlib": ("zlib", "zlib libpng"),
    "BSL-1.0": ("bsl 1 0", "boost software", "boost"),
    "Unlicense": ("unlicense",),
    "CC0": ("cc0", "creative commons zero"),
    "CC-BY": ("cc by", "creative commons attribution"),
    "CC-BY-SA": ("cc by sa", "creative commons attribution sharealike", "creative commons attribution share alike"),
    "CC-BY-NC": ("cc by nc", "creative commons attribution noncommercial", "creative commons attribution non commercial"),
    "CC-BY-ND": ("cc by nd", "creative commons attribution noderivatives", "creative commons attribution noderivs"),
    "CC-BY-NC-SA": ("cc by nc sa", "creative commons attribution noncommercial sharealike"),
    "CC-BY-NC-ND": ("cc by nc nd", "creative commons attribution noncommercial noderivatives", "creative commons attribution noncommercial noderivs"),
}
#: Licences whose versions differ.
VERSIONED = ("Apache", "GPL", "LGPL", "AGPL", "MPL", "EPL", "CC0", "CC-BY", "CC-BY-SA", "CC-BY-NC", "CC-BY-ND", "CC-BY-NC-SA", "CC-BY-NC-ND")
#: What a notice says before the name, in whole or up to the end of a piece.
GIVEN = r"(?:licen[sc]ed|released|distributed|published|available|provided|offered|covered|redistributable|is|are|falls)"
UNDER = r"(?: to you| for use)?(?: under| by)(?: either)?(?: the| an?)?(?: terms(?: and conditions)? of)?(?: either)?(?: the| an?)?"
#: Pieces that one notice may be spread over.
SPREAD = 3

#: Where a text is cut: line ends, and marks that end a sentence before a blank.
SENTENCE_END = r"\s*\n\s*|[.!?;:]+\s+"
OTHER = " "
#: What may stand before a sentence in its line: comment words and marks of a list.
LEAD = r"(?i)^[^\p{L}\p{N}]*(?:(?:(?:dnl|rem)\b|\(?(?:[0-9]{1,2}|[a-z]|[ivx]{1,4})\))(?:\s+|$)[^\p{L}\p{N}]*)+"


def known_sentences() -> tuple[list[str], list[str], list[str]]:
    """(normalised sentences, their names, their versions or "")."""
    rows = []
    for name, text in SENTENCES.items():
        for wording in (text, *WORDINGS.get(name, ())):
            for version in VERSIONS if "<n>" in wording else ("",):
                rows.append((wording.replace("<n>", version), name, version.replace(" ", ".")))
    return tuple(map(list, zip(*rows)))


def _tree() -> dict:
    """Words to what may follow them; under "" the number of the known sentence that ends there."""
    root: dict = {}
    for number, sentence in enumerate(known_sentences()[0]):
        node = root
        for word in sentence.split():
            node = node.setdefault(word, {})
        node.setdefault("", number)
    return root


def _first_pieces() -> str:
    """A pattern of the pieces that a known sentence may begin with: its first three words, or fewer alone."""
    long, short, named = set(), set(), set()
    for sentence in known_sentences()[0]:
        words = sentence.split()
        if words[0] == "<x>":
            named.add(" ".join(words[1:3]))
            continue
        words = words[: words.index("<x>")] if "<x>" in words else words
        long.add(" ".join(words[:3]))
        short |= {" ".join(words[:k]) for k in (1, 2)}
    either = lambda words: "|".join(sorted(words))
    return rf"^(?:(?:{either(long)})(?: .*)?|(?:{either(short)})|(?:[^ ]+ ){{1,{WILD}}}(?:{either(named)})(?: .*)?)$"


def _after(states: list[tuple[dict, int]], word: str) -> list[tuple[dict, int]]:
    """States (place in the tree, words that a name there may still have) behind one more word."""
    out = []
    for node, left in states:
        if left:
            out.append((node, left - 1))
        if word in node:
            out.append((node[word], 0))
        if "<x>" in node:
            out.append((node["<x>"], WILD - 1))
    return out


def _sentence_at(pieces: _Pieces, at: int) -> tuple[int, int] | None:
    """(number, piece behind it) of the longest known sentence that begins with the piece ``at`` and ends with a piece."""
    states, found = [(_TREE, 0)], None
    while at < len(pieces):
        for word in pieces[at]:
            if not (states := _after(states, word)):
                return found
        at += 1
        found = next(((node[""], at) for node, _ in states if "" in node and pieces[at - 1]), found)
    return found


def _named() -> re.Pattern:
    """A licence's name with its version, as it stands in a notice."""
    words = sorted((w for of in NAMES.values() for w in of), key=len, reverse=True)
    version = r"(?: international| generic| unported)?(?:(?: ?version| ?v| universal)? ?(?P<version>[1-4](?: [0-9])?)(?= |$))?"
    return re.compile(
        rf"(?P<name>{'|'.join(words)})(?=v?[0-9]|(?: |$))(?: (?:public )?licen[sc]es?)?{version}(?: international| unported| universal)?"
        r"(?: (?:public )?licen[sc]es?)?(?: or later| or any later version| only)?(?= |$)"
    )


_NAMED = _named()
_LICENCE = {words: licence for licence, of in NAMES.items() for words in of}
_NOTICE = re.compile(rf"(?:(?:^| ){GIVEN}{UNDER}|^spdx license identifier) (?=[a-z0-9])")
_NEXT = re.compile(r"(?: and or| or| and)(?: the| an?)? (?=[a-z0-9])")
_DENIED = re.compile(r"(?:^| )(?:not|never|no longer|nor)$")
_TITLE = re.compile(r"(?:the )?(?P<title>.*licen[sc]e.*|unlicense)")
#: Pieces that a notice may begin in: words for giving with "under" or "by" behind them or at the end, tags and titles.
_MAY_NAME = rf"(?:^| ){GIVEN}(?: to you| for use)?(?: (?:under|by)(?: |$)|$)|^spdx license identifier|^licen[sc]e$|^(?:[^ ]+ ){{0,7}}(?:un)?licen[sc]e(?: [^ ]+){{0,4}}$"


def _names_from(text: str, at: int) -> tuple[list[tuple[str, str]], int]:
    """((licence, version) of the names that follow each other from ``at``, the place behind them)."""
    names: list[tuple[str, str]] = []
    while m := _NAMED.match(text, at):
        licence = _LICENCE[m["name"]]
        names.append((licence, (m["version"] or "").replace(" ", ".") if licence in VERSIONED else ""))
        at = m.end()
        if not (link := _NEXT.match(text, at)):
            break
        at = link.end()
    return names, at


def _notice_at(pieces: _Pieces, at: int, begin: int) -> tuple[list[tuple[str, str]], int] | None:
    """((licence, version) of the notices, tags or the title that begin in the piece ``at``, the piece behind them).

    A title over a licence's text does not count: the text decides. Neither does what is said not to be so.
    """
    words, sizes = list(pieces[at]), [len(pieces[at])]
    for k in range(at + 1, min(at + SPREAD, len(pieces))):
        words += pieces[k]
        sizes.append(len(words))
    text, own = " ".join(words), " ".join(words[: sizes[0]])
    names, last = [], 0
    before = " ".join(pieces[at - 1]) if at > begin else ""
    for m in _NOTICE.finditer(text):
        if m.start() > len(own):
            break
        if _DENIED.search(text[: m.start()] if m.start() else before):
            continue
        new, behind = _names_from(text, m.end())
        names += new
        last = behind if new else last
    if not names and own in ("license", "licence") and len(sizes) > 1:  # a tag of the form "License: MIT"
        new, last = _names_from(text, len(own) + 1)
        names = new if last == len(" ".join(words[: sizes[1]])) else []
    if not names and (m := _TITLE.fullmatch(own)) and not _text_follows(pieces, at):
        new, last = _names_from(own, m.start("title"))
        names = new if last >= len(own) or len(new) == 1 and own[last + 1 :] in NAMES[new[0][0]] else []
    if not names:
        return None
    used = text[:last].count(" ") + 1
    return names, at + 1 + sum(size < used for size in sizes)


def _text_follows(pieces: _Pieces, at: int) -> bool:
    """Whether one of the next few pieces with words begins as a licence's text does."""
    others = 0
    for k in range(at + 1, len(pieces)):
        words = " ".join(pieces[k])
        if words and not words.startswith(SENTENCES["reserved"]):
            if _BEGINS.match(words):
                return True
            others += 1
            if others > GAP:
                return False
    return False


def normalised(sentences: pa.Array) -> pa.Array:
    """Lower case, letters and digits only, one blank between words."""
    return pc.utf8_trim(pc.replace_substring_regex(pc.utf8_lower(sentences), r"[^\p{L}\p{N}]+", " "), " ")


def _rules() -> list[tuple[str, re.Pattern, int]]:
    """Rules over one sign per sentence; the signs of ``SENTENCES`` in order, ``OTHER`` for the rest."""
    sign = _signs()
    gap = "[^\x00]{0,%d}?" % GAP
    rules = (*RULES, *((licence, (f"named {licence}",)) for licence in NAMES))
    return [(licence, re.compile(gap.join(f"({sign[m]})" for m in members)), len(members)) for licence, members in rules]


def _signs() -> dict[str, str]:
    """One sign for each known sentence and each licence that a notice names."""
    return {name: chr(0x4E00 + k) for k, name in enumerate((*SENTENCES, *(f"named {licence}" for licence in NAMES)))}


def match_rules(signs: str, versions: list[str]) -> list[tuple[int, str, int]]:
    """(place of the first sentence, licence, number of member sentences), by place.

    ``signs`` has one character per sentence. Members of a match are used up: a later match can
    neither have them nor bridge them.
    """
    found = []
    for licence, rule, size in _RULES:
        at = 0
        while m := rule.search(signs, at):
            version = versions[m.start()]
            found.append((m.start(), f"{licence}-{version}" if version else licence, size))
            used = list(signs[m.start() : m.end()])
            for k in range(1, size + 1):
                used[m.start(k) - m.start()] = "\x00"
            signs = signs[: m.start()] + "".join(used) + signs[m.end() :]
            at = m.end()
    return sorted(found)


_RULES, _TREE, _FIRST = _rules(), _tree(), _first_pieces()
_BEGINS = re.compile(_FIRST)


def licences_of(texts: pa.Array) -> Iterator[tuple[int, list[tuple[int, str, int]], int]]:
    """(text, its matches, its known sentences) of each text with a known licence sentence."""
    _, names, versions = known_sentences()
    sign = _signs()
    cut = pc.split_pattern_regex(texts, SENTENCE_END)
    starts = cut.offsets.to_numpy()
    values = cut.values.slice(starts[0], starts[-1] - starts[0])
    starts = starts - starts[0]
    codes, distinct = word_codes(values)
    if not len(codes):
        return
    plain = normalised(pc.replace_substring_regex(distinct, LEAD, ""))
    may_begin = pc.or_(pc.match_substring_regex(plain, _FIRST), pc.match_substring_regex(plain, _MAY_NAME))
    hits = np.flatnonzero(may_begin.to_numpy(zero_copy_only=False)[codes])
    owner = np.searchsorted(starts, hits, side="right") - 1
    for text in np.unique(owner).tolist():
        begin, end = int(starts[text]), int(starts[text + 1])
        own = hits[np.searchsorted(owner, text) : np.searchsorted(owner, text, side="right")]
        found, free, pieces = [], begin, _Pieces(plain, codes, end)
        for at in own.tolist():
            if at < free:
                continue
            if hit := _sentence_at(pieces, at):
                found.append((at, [(sign[names[hit[0]]], versions[hit[0]])], hit[1]))
            elif notice := _notice_at(pieces, at, begin):
                found.append((at, [(sign[f"named {licence}"], version) for licence, version in notice[0]], notice[1]))
            else:
                continue
            free = found[-1][2]
        if not found:
            continue
        empty = pc.equal(plain.take(pa.array(codes[begin:end])), "").to_numpy(zero_copy_only=False)
        line, version, at = [], [], begin
        for first, members, behind in [*found, (end, [], end)]:
            others = int(first - at - empty[at - begin : first - begin].sum())
            line += [OTHER] * others
            version += [""] * others
            line += [m for m, _ in members]
            version += [v for _, v in members]
            at = behind
        yield text, match_rules("".join(line), version), sum(len(members) for _, members, _ in found)


class _Pieces:
    """The words of each piece of a text, read where they are asked for."""

    def __init__(self, plain: pa.Array, codes: np.ndarray, end: int):
        self.plain, self.codes, self.end = plain, codes, end

    def __len__(self) -> int:
        return self.end

    def __getitem__(self, at: int) -> list[str]:
        return self.plain[int(self.codes[at])].as_py().split()


def scan(df: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per text with a licence sentence: doc_id, licences, n_matches, n_sentences.

    ``licences`` are the distinct licences found, sorted and comma-joined (empty if sentences are
    known but no rule is complete); ``n_matches`` counts matches, ``n_sentences`` known sentences.
    NULL and empty texts have none, and an empty table gives no rows. Texts of any length are read whole. Rows with the same or a NULL id are taken one by one.
    """

    @tidied
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (piece for whole in batches for piece in parts_of(whole, 1)):
            found = list(licences_of(texts_of(batch.column(1))))
            if found:
                rows = pa.array([t for t, _, _ in found])
                licences = [",".join(sorted({name for _, name, _ in matches})) for _, matches, _ in found]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(rows), pa.array(licences, pa.string()), pa.array([len(m) for _, m, _ in found], pa.int64()),
                     pa.array([n for _, _, n in found], pa.int64())],
                    names=["doc_id", "licences", "n_matches", "n_sentences"],
                )

    schema = f"doc_id {dict(df.dtypes)[id_col]}, licences string, n_matches long, n_sentences long"
    return df.select(id_col, text).mapInArrow(run, schema)


def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(read_table(spark, sf_dir, "documents"))


QUERIES = {"op7_license_scan": op7_license_scan}
ORACLE_SQL: dict[str, str] = {}
