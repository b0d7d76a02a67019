"""Licence sentences and rules against a plain reading of every sentence."""

from __future__ import annotations

import re

from tests.llm.conftest import ODD_ROWS
from tidemark.llm import licenses
from tidemark.llm.common import read_table

SF = "/root/testdata/sf0.01"
KNOWN = {text: (name, version) for text, name, version in zip(*licenses.known_sentences())}


def plain(text):
    """(licences, matches, known sentences) of a text: every rule is tried at every sentence."""
    cut = [re.sub(r"[\W_]+", " ", s.lower()).strip() for s in re.split(licenses.SENTENCE_END, text or "")]
    line = [KNOWN.get(s, (None, ""))[0] for s in cut]
    free, found = [True] * len(line), []
    for licence, members in licenses.RULES:
        start = 0
        while start < len(line):
            places, at = [], start
            if free[start] and line[start] == members[0]:
                places, at = [start], start
                for member in members[1:]:
                    step = next(
                        (k for k in range(at + 1, min(at + licenses.GAP + 2, len(line))) if line[k] == member and all(free[at + 1 : k + 1])), None
                    )
                    if step is None:
                        break
                    places.append(step)
                    at = step
            if len(places) == len(members):
                version = KNOWN[cut[start]][1]
                found.append(f"{licence}-{version}" if version else licence)
                for k in places:
                    free[k] = False
                start = at + 1
            else:
                start += 1
    return ",".join(sorted(set(found))), len(found), sum(x is not None for x in line)


def rows_of(df):
    return sorted(((r.doc_id, r.licences, r.n_matches, r.n_sentences) for r in df.collect()), key=str)


def test_query_against_plain_reading(spark):
    want = [(r.doc_id, *plain(r.text)) for r in read_table(spark, SF, "documents").collect()]
    got = rows_of(licenses.op7_license_scan(spark, SF))
    assert got == sorted((w for w in want if w[3]), key=str) and len(got) > 20


MIT = [licenses.SENTENCES[k] for k in ("mit-grant", "mit-keep", "mit-as-is", "mit-liability")]


def test_rules_need_order_and_nearness(docs):
    whole = ". ".join(s.capitalize() for s in MIT) + "."
    apart = "\n".join([MIT[0], "one", "two", MIT[1], "three", MIT[2], MIT[3]])
    texts = [
        (1, whole), (2, apart), (3, apart.replace("two", "two\nmore")), (4, "\n".join(MIT[::-1])),
        (5, "Licensed under the Apache License, Version 2.0.\n" + whole + "\nReleased under the MIT License."),
        (6, "LICENSED UNDER CC-BY-NC 4.0!\nAll rights reserved."), (7, "not licensed under the mit license"), (8, f"{whole}\n{whole}"),
    ]
    got = {r[0]: r[1:] for r in rows_of(licenses.scan(docs(texts)))}
    assert got == {
        1: ("MIT", 1, 4), 2: ("MIT", 1, 4), 3: ("", 0, 4), 4: ("", 0, 4), 5: ("Apache-2.0,MIT", 3, 6),
        6: ("All-rights-reserved,CC-BY-NC-4.0", 2, 2), 8: ("MIT", 2, 8),
    }
    assert all(got.get(i, ("", 0, 0)) == plain(t) for i, t in texts)


def test_longer_rules_go_first(docs):
    bsd = [licenses.SENTENCES[k] for k in ("bsd-grant", "bsd-source", "bsd-binary", "bsd-names")]
    got = rows_of(licenses.scan(docs([(1, "\n".join(bsd)), (2, "\n".join(bsd[:3]))])))
    assert [r[1] for r in got] == ["BSD-3-Clause", "BSD-2-Clause"]


def test_odd_rows(docs, store, spark):
    note = "Released under the MIT License."
    rows = [*ODD_ROWS, (9, note), (9, note), (None, note), (10, "a\n" * 30_000 + note)]
    assert rows_of(licenses.scan(docs(rows))) == sorted([(9, "MIT", 1, 1), (9, "MIT", 1, 1), (None, "MIT", 1, 1), (10, "MIT", 1, 1)], key=str)
    assert licenses.op7_license_scan(spark, store(documents=[])).count() == 0
