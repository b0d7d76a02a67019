"""Secret scan against a plain reading of the rules, and under nested encodings."""

from __future__ import annotations

import base64
import bz2
import gzip
import hashlib
import lzma
import re
import zlib
from urllib.parse import quote

import pytest
import zstandard
from hypothesis import given, settings
from hypothesis import strategies as st

from tests.llm.conftest import ODD_ROWS
from tidemark.llm import secrets
from tidemark.llm.common import read_table

SECRET = 'password = "s3cr3tS3cr3tXY"'
WORDS = ["password", "PassWD", "secret", "token", "apikey", "API_key", " ", '"', "'", ":", "=", "abcdef0123456789ab", "AKIA", "ABCDEFGH01234567",
         "x", "/", "é", "ſ", "K", "-", ".", "Z" * 12, "f" * 15, "f"]


def plain_rules(text):
    """Each kind by the words of the contract, without any short cut."""
    either = "".join
    words = "|".join(either(f"[{c.lower()}{c.upper()}]" if c.isalpha() else c for c in w) for w in ("password", "passwd", "secret", "token"))
    key = either(f"[{c}{c.upper()}]" for c in "api") + "_?" + either(f"[{c}{c.upper()}]" for c in "key")
    assign = re.compile(rf"""({words}|{key})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
    found = [("assign", m.start(), m.end()) for m in assign.finditer(text) if len(m.group(2)) >= 12]
    found += [("access", m.start(), m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if m.end() - m.start() >= 18]
    found += [("hex", m.start(), m.end()) for m in re.finditer("[0-9a-f]+", text) if m.end() - m.start() >= 16]
    return sorted(found, key=lambda s: (s[1], secrets.KINDS.index(s[0])))


def check_row(row, text):
    want = plain_rules(text or "")
    assert [row.n_assign, row.n_access, row.n_hex] == [sum(k == x for k, _, _ in want) for x in secrets.KINDS]
    written = [f"{k}:{b}:{e}" for k, b, e in want]
    assert row.base_sha256 == hashlib.sha256(",".join(written).encode()).hexdigest()
    spans = row.spans.split(",") if row.spans else []
    assert set(written) <= set(spans) and len(set(spans)) == len(spans)
    assert spans == sorted(spans, key=lambda s: (int(s.split(":")[1]), secrets.KINDS.index(s.split(":")[0]), int(s.split(":")[2])))
    return set(spans) - set(written)


@settings(max_examples=500, deadline=None)
@given(st.lists(st.sampled_from(WORDS), max_size=14))
def test_open_secrets_follow_the_rules(pieces):
    text = "".join(pieces)
    assert [(secrets.KINDS[k], b, e) for b, k, e in secrets.base_spans(text)] == plain_rules(text)


def test_query_against_plain_rules(spark):
    texts = {r.doc_id: r.text for r in read_table(spark, "/root/testdata/sf0.01", "documents").collect()}
    rows = secrets.op1_secret_scan(spark, "/root/testdata/sf0.01").collect()
    assert sorted(r.doc_id for r in rows) == sorted(texts)
    assert sum(r.n_hex + r.n_assign + r.n_access for r in rows) > 10
    assert not any(check_row(r, texts[r.doc_id]) for r in rows), "no secret is made up in ordinary text"


def test_odd_rows(spark, store):
    rows = secrets.op1_secret_scan(spark, store(documents=ODD_ROWS)).collect()
    assert len(rows) == len(ODD_ROWS)
    assert all(r.spans == "" and r.base_sha256 == hashlib.sha256(b"").hexdigest() for r in rows)
    assert secrets.op1_secret_scan(spark, store(documents=[])).count() == 0


def b64(data):
    return base64.b64encode(data).decode()


PACKERS = {"gzip": gzip.compress, "zlib": zlib.compress, "bz2": bz2.compress, "xz": lzma.compress, "zstd": zstandard.compress}
LAYERS = {
    "url": lambda t: "".join(f"%{b:02X}" for b in t.encode()),
    "quoted": lambda t: quote(t, safe=""),
    "unicode": lambda t: "".join(f"\\u{ord(c):04x}" for c in t),
    "hex": lambda t: "".join(f"\\x{ord(c):02x}" for c in t),
    "entities": lambda t: "".join(f"&#{ord(c)};" for c in t),
    "base64": lambda t: b64(t.encode()),
    "base64 url": lambda t: base64.urlsafe_b64encode(t.encode()).decode(),
    **{name: (lambda t, f=f: b64(f(t.encode()))) for name, f in PACKERS.items()},
}


@pytest.mark.parametrize("outer", LAYERS)
@pytest.mark.parametrize("inner", LAYERS)
def test_nested_layers_are_unwrapped_and_mapped(outer, inner):
    hidden = LAYERS[outer](LAYERS[inner](f"é {SECRET} end"))
    text = f"Some words before {hidden} and some behind it."
    _, spans, _, folded = secrets.find_secrets(text)
    begin, end = text.index(hidden), text.index(hidden) + len(hidden)
    assert not folded
    assert any(k == 0 and begin <= b < e <= end for b, k, e in spans)


def test_spans_are_exact_for_escapes():
    text = 'see token%3D"abcdefabcdefZZ" here'
    _, spans, _, _ = secrets.find_secrets(text)
    begin = text.index("token")
    assert (begin, 0, text.index('" here')) in spans


def test_layers_of_three_and_repeats():
    once = b64(gzip.compress(quote(b64(SECRET.encode()), safe="").encode()))
    text = f"{once} {once}"
    _, spans, layers, _ = secrets.find_secrets(text)
    assert len(spans) == 2 and layers >= 5


def test_a_stretch_that_decodes_to_itself_ends():
    assert secrets.find_secrets("%25" * 50 + "41")[2] < 60
    assert secrets.find_secrets("%2525252541 \\u005cu0041 AAAAAAAAAAAAAAAAAAAAAAAA")[2] < 20


def test_streams_too_large_are_counted():
    bomb = b64(gzip.compress(b"a" * (1 << 24)))
    _, spans, _, folded = secrets.find_secrets(f"x {bomb} {SECRET}")
    assert folded == 1 and any(k == 0 for _, k, _ in spans)


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="%\\ux&#;0123456789abcdefABCDEF=+/ -_", max_size=80))
def test_any_text_is_taken(text):
    base, spans, _, _ = secrets.find_secrets(text)
    assert set(base) <= set(spans) and all(0 <= b < e <= len(text) for b, _, e in spans)
