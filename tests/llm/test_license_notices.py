"""Notices inside sentences, tags and titles."""

from __future__ import annotations

import pyarrow as pa
import pytest

from tidemark.llm.licenses import licences_of

NOTICES = [
    ("This project is licensed under the MIT License.", "MIT"),
    ("MIT License", "MIT"),
    ("The MIT License (MIT)", "MIT"),
    ("# SPDX-License-Identifier: Apache-2.0", "Apache-2.0"),
    ("// SPDX-License-Identifier: GPL-2.0-or-later", "GPL-2.0"),
    ("/* SPDX-License-Identifier: (MIT OR Apache-2.0) */", "Apache-2.0,MIT"),
    ("Licensed under the Apache License 2.0.", "Apache-2.0"),
    ("Released under the MIT license, see LICENSE", "MIT"),
    ("This software is distributed under the terms of the GNU General Public License v3.0 or later.", "GPL-3.0"),
    ("License: BSD-3-Clause", "BSD-3-Clause"),
    ("Dual-licensed under MIT or Apache-2.0.", "Apache-2.0,MIT"),
    ("The code is available under the BSD 3-Clause License", "BSD-3-Clause"),
    ("This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.", "CC-BY-SA-4.0"),
    ("Distributed under the GPLv3, like its parts", "GPL-3"),
    ("All of it is licensed under the Mozilla Public License, v. 2.0.", "MPL-2.0"),
    ("parts are licensed under LGPL-2.1-or-later", "LGPL-2.1"),
    ("This project is licensed under the ISC License - see the [LICENSE.md](LICENSE.md) file for details", "ISC"),
    ("The tools of this folder are released\nunder the terms of the\nApache License, Version 2.0, and the texts are not.", "Apache-2.0"),
    ("Licensed under [MIT](LICENSE) and made with care", "MIT"),
    ("## License\n\nMIT\n", "MIT"),
    ("# Contributing\n\nSend patches.\n\n## License\n\nThis package is open source and released under the Unlicense.", "Unlicense"),
]
CLEAN = [
    "The MIT License is older than you think.",
    "He teaches at MIT and is available under his number.",
    "The plant is covered by snow; the general public is invited.",
    "Mit Lizenz oder ohne, das ist die Frage.",
    "A driving license is needed",
    "License: see the file COPYING",
    "Boost your sales, released by the license office",
    "",
]


def found(text: str) -> str:
    return ",".join(sorted({name for _, matches, _ in licences_of(pa.array([text])) for _, name, _ in matches}))


@pytest.mark.parametrize("text, licences", NOTICES)
def test_notices(text, licences):
    assert found(text) == licences
    assert found(f"Some words first. And more!\n\n{text}\n\nWords behind it.") == licences


@pytest.mark.parametrize("text", CLEAN)
def test_mentions_are_no_notices(text):
    assert found(text) == ""
