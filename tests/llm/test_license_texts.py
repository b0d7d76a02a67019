"""Licences as their files have them: wrapped, commented, with every mark in place."""

from __future__ import annotations

import textwrap

import pyarrow as pa
import pytest

from tidemark.llm import licenses

MIT = '''MIT License

Copyright (c) 2020 Some Body

Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,
FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE
AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER
LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM,
OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE
SOFTWARE.
'''
APACHE = '''Licensed under the Apache License, Version 2.0 (the "License");
you may not use this file except in compliance with the License.
You may obtain a copy of the License at

    http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software
distributed under the License is distributed on an "AS IS" BASIS,
WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.
See the License for the specific language governing permissions and
limitations under the License.
'''
BSD2 = '''Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution.
'''
ADVERT = '''
3. All advertising materials mentioning features or use of this software
   must display the following acknowledgement:
   This product includes software developed by Some Company.
'''
NAMES = '''
3. Neither the name of Some Company, Inc. nor the names of its
   contributors may be used to endorse or promote products derived from
   this software without specific prior written permission.
'''
GPL = '''This program is free software: you can redistribute it and/or modify
it under the terms of the GNU General Public License as published by
the Free Software Foundation, either version 3 of the License, or
(at your option) any later version.

This program is distributed in the hope that it will be useful,
but WITHOUT ANY WARRANTY; without even the implied warranty of
MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the
GNU General Public License for more details.
'''
LGPL = GPL.replace("program", "library").replace("General", "Lesser General").replace("version 3", "version 2.1")
AGPL = GPL.replace("General", "Affero General")
ISC = '''Permission to use, copy, modify, and/or distribute this software for any
purpose with or without fee is hereby granted, provided that the above
copyright notice and this permission notice appear in all copies.
'''
MPL = '''This Source Code Form is subject to the terms of the Mozilla Public
License, v. 2.0. If a copy of the MPL was not distributed with this
file, You can obtain one at https://mozilla.org/MPL/2.0/.
'''
ZLIB = '''Permission is granted to anyone to use this software for any purpose,
including commercial applications, and to alter it and redistribute it
freely, subject to the following restrictions:

1. The origin of this software must not be misrepresented; you must not
   claim that you wrote the original software. If you use this software
'''
GENUINE = {
    "MIT": MIT, "Apache-2.0": APACHE, "BSD-2-Clause": BSD2, "BSD-3-Clause": BSD2 + NAMES, "BSD-4-Clause": BSD2 + ADVERT + NAMES.replace("3.", "4."),
    "GPL-3": GPL, "LGPL-2.1": LGPL, "AGPL-3": AGPL, "ISC": ISC, "MPL-2.0": MPL, "Zlib": ZLIB,
}
COMMENTS = {
    "as it is": lambda t: t, "hash": lambda t: textwrap.indent(t, "# ", lambda _: True), "slashes": lambda t: textwrap.indent(t, "// ", lambda _: True),
    "block": lambda t: "/*\n" + textwrap.indent(t, " * ", lambda _: True) + " */\n", "dnl": lambda t: textwrap.indent(t, "dnl ", lambda _: True),
    "one line a paragraph": lambda t: "\n\n".join(" ".join(p.split()) for p in t.split("\n\n")),
}


@pytest.mark.parametrize("name", GENUINE)
@pytest.mark.parametrize("comment", COMMENTS)
def test_genuine_texts(name, comment):
    text = "Some title\n" + COMMENTS[comment](GENUINE[name]) + "\nx = 1\n"
    found = list(licenses.licences_of(pa.array(["nothing", text], pa.large_string())))
    assert [(t, [n for _, n, _ in matches]) for t, matches, _ in found] == [(1, [name])]
    size = max(len(members) for licence, members in licenses.RULES if name.startswith(licence))
    assert found[0][1][0][2] == size, "the whole rule holds, not a shorter one"


def test_every_rule_is_reachable():
    for licence, members in licenses.RULES:
        sentences = [licenses.SENTENCES[m].replace("<n>", "2 0") for m in members]
        for text in ("\n".join(sentences), "\n".join(textwrap.fill(s, 40) for s in sentences)):
            found = list(licenses.licences_of(pa.array([text], pa.large_string())))
            assert [n.removesuffix("-2.0") for _, n, _ in found[0][1]] == [licence.removesuffix("-2.0")], (licence, text)


def test_parts_of_sentences_are_none():
    texts = [MIT[:300], "This program is free software", "not\nreleased under the MIT license today", "Permission is hereby\n\n# \n granted"]
    assert not list(licenses.licences_of(pa.array(texts, pa.large_string())))
