from __future__ import annotations

import hashlib
import re

from hypothesis import given, settings
from hypothesis import strategies as st

from courtside.llm import pii
from tests.llm.conftest import awkward, told

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def luhn(digits):
    doubled = [int(d) * (1 + i % 2) for i, d in enumerate(reversed(digits))]
    return sum(d - 9 * (d > 9) for d in doubled) % 10 == 0


def brute(text):
    text = text or ""
    cards = [(m.span(), re.sub("[ -]", "", m[0])) for m in CARD.finditer(text)]
    return {
        "email": [m.span() for m in EMAIL.finditer(text)],
        "ip": [m.span() for m in IP.finditer(text) if all(int(p) <= 255 for p in m[0].split("."))],
        "card": [s for s, d in cards if 16 <= len(d) <= 19 and luhn(d)],
        "phone": [m.span() for m in PHONE.finditer(text) if 8 <= len(re.findall("[0-9]", m[0])) <= 15],
    }


def base(text):
    found = pii.spans(text)
    return {k: found[k] for k in pii.BASE_KINDS}


PIECES = ["a", "b.c", "@", ".", "-", "+", "1", "25", "256", "4111 1111 1111 1111", "4111-1111-1111-1111", " ", "  ", "(", ")", "é", "\n", "+1 (743) 555-3824", "10.0.0.1", "x@y.z"]


@settings(max_examples=1500, deadline=None)
@given(st.lists(st.sampled_from(PIECES), max_size=14).map("".join))
def test_base_spans_by_brute_force(text):
    assert base(text) == brute(text)


@settings(max_examples=800, deadline=None)
@given(st.text(alphabet="01259.@+- ()aZ", max_size=40))
def test_base_spans_of_dense_texts(text):
    assert base(text) == brute(text)


def test_added_kinds_and_masks():
    text = "See https://example.com/a?b=c, IBAN DE89 3704 0044 0532 0130 00 or account no. AB12345."
    found = pii.spans(text)
    assert [text[a:b] for a, b in found["url"]] == ["https://example.com/a?b=c"]
    assert [text[a:b] for a, b in found["iban"]] == ["DE89 3704 0044 0532 0130 00"]
    assert [text[a:b] for a, b in found["account"]] == ["AB12345"]
    assert pii.masked("mail x@y.zz or 10.0.0.1") == "mail [email] or [ip]"
    assert pii.masked(None) is None and pii.spans("IBAN DE00 3704 0044 0532 0130 00")["iban"] == []


def test_awkward_rows(docs, no_docs):
    got = told(pii.find_personal_data(docs), "doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256")
    none = hashlib.sha256(b"").hexdigest()
    assert got == sorted(((r[0], 0, 0, 0, 0, none) for r in awkward()), key=repr)
    assert pii.find_personal_data(no_docs).count() == 0
    assert told(pii.mask_personal_data(docs), "doc_id", "text") == sorted(((r[0], r[1]) for r in awkward()), key=repr)


def test_secrets_follow_their_cues():
    def found(text):
        return [text[a:b] for a, b in pii.spans(text)["secret"]]

    assert found('token = "f33e61083db5aa01". next') == ["f33e61083db5aa01"]
    assert found("API_KEY: sk-Ab12Cd34Ef56Gh78. Password='hunter2hunter3X'") == ["sk-Ab12Cd34Ef56Gh78", "hunter2hunter3X"]
    assert found('"secret": "YWJjZGVmZ2hpMTIz=="') == ["YWJjZGVmZ2hpMTIz=="]
    for clean in ("a token of thanks", "token: recommendations", "password = aaaaaaaaaaaa1", "secret = 12345678901234", "tokens = f33e61083db5aa01"):
        assert found(clean) == []
    assert pii.masked('x token = "f33e61083db5aa01"') == 'x token = "[secret]"'
