"""Personal data by anchor expansion.

One Aho-Corasick pass over a text finds anchors: at-signs, plus-signs, digits
with a dot behind them, digits, URL schemes and words that announce an
identifier or a secret. Each anchor is expanded to both sides by a parser of its kind,
which also validates what it found.
"""

from __future__ import annotations

import hashlib
import re

import ahocorasick
from pyspark.sql import DataFrame

from courtside.llm.common import each_text

BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "url", "iban", "account", "secret")

_DIGITS = frozenset("0123456789")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"[0-9]+(?:\.[0-9]+){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_URL = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*(?::[0-9]+)?(?:[/?#][^\s<>\"']*)?")
_IBAN = re.compile(r"[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])")
_ACCOUNT = re.compile(r"(?:[ ]?(?:no\.?|number|nr\.?|id))?[ ]?[:=#]?[ ]{0,2}([A-Za-z0-9]*[0-9][A-Za-z0-9-]{4,})")
_SECRET = re.compile(r"[\"']?\x20{0,4}[:=]\x20{0,4}[\"']?(?:Bearer\x20)?([A-Za-z0-9_+/.=-]{12,})")

# What announces a scheme or an identifier.
SCHEMES = ("http://", "https://", "ftp://")
CUES = ("account", "acct", "passport", "ssn", "customer")
SECRET_CUES = ("token", "secret", "password", "passwd", "api_key", "apikey", "api-key", "access_key")
_IBAN_CUE = "iban"


def _automaton() -> ahocorasick.Automaton:
    """Anchors and what expands them; cues in the three usual spellings of case."""
    found = ahocorasick.Automaton()
    words = {"@": ("email",), "+": ("phone",)}
    for d in "0123456789":
        words[d] = ("card",)
        words[d + "."] = ("ip",)
    for scheme in SCHEMES:
        words[scheme] = ("url",)
    kinds = {_IBAN_CUE: "iban", **dict.fromkeys(CUES, "account"), **dict.fromkeys(SECRET_CUES, "secret")}
    for cue, kind in kinds.items():
        for spelled in {cue, cue.upper(), cue.capitalize()}:
            words[spelled] = (kind,)
    for word, (kind,) in words.items():
        found.add_word(word, (kind, len(word)))
    found.make_automaton()
    return found


_ANCHORS: ahocorasick.Automaton | None = None


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if i % 2 == 0 else d * 2 - 9 * (d > 4)
    return total % 10 == 0


def _iban_ok(value: str) -> bool:
    plain = value.replace(" ", "")
    return 15 <= len(plain) <= 34 and int("".join(str(int(c, 36)) for c in plain[4:] + plain[:4])) % 97 == 1


def _secret_ok(value: str) -> bool:
    """Whether a value looks drawn and not written: letters and digits, of eight or more different characters."""
    return any(c in _DIGITS for c in value) and any(c.isalpha() for c in value) and len(set(value)) >= 8


def spans(text: str | None) -> dict[str, list[tuple[int, int]]]:
    """Spans (start, end) in code points by kind, in order; none for NULL and empty texts.

    Within a kind matches are leftmost and do not overlap. A match that fails
    its check is dropped with the characters it took.
    """
    global _ANCHORS
    if _ANCHORS is None:
        _ANCHORS = _automaton()
    out: dict[str, list[tuple[int, int]]] = {k: [] for k in KINDS}
    if not text:
        return out
    done = dict.fromkeys(KINDS, 0)
    for last, (kind, size) in _ANCHORS.iter(text):
        start = last - size + 1
        if start < done[kind]:
            continue
        if kind == "card":
            m = _CARD.match(text, start)
            if m:
                done[kind] = m.end()
                digits = m[0].replace(" ", "").replace("-", "")
                if 16 <= len(digits) <= 19 and luhn(digits):
                    out[kind].append(m.span())
        elif kind == "email":
            left = start
            while left > done[kind] and text[left - 1] in _LOCAL:
                left -= 1
            m = _DOMAIN.match(text, start + 1) if left < start else None
            if m:
                done[kind] = m.end()
                out[kind].append((left, m.end()))
        elif kind == "ip":
            left = start
            while left > done[kind] and text[left - 1] in _DIGITS:
                left -= 1
            m = _IP.match(text, left)
            if m:
                done[kind] = m.end()
                if all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in m[0].split(".")):
                    out[kind].append(m.span())
        elif kind == "phone":
            m = _PHONE.match(text, start)
            if m:
                done[kind] = m.end()
                if 8 <= sum(c in _DIGITS for c in m[0]) <= 15:
                    out[kind].append(m.span())
        elif kind == "url":
            m = _URL.match(text, last + 1)
            if m:
                end = start + len(text[start : m.end()].rstrip(".,;:!?"))
                done[kind] = m.end()
                out[kind].append((start, end))
        elif kind == "iban":
            at = last + 1
            while at < len(text) and text[at] in " :=#" and at < last + 5:
                at += 1
            m = _IBAN.match(text, at)
            if m:
                done[kind] = m.end()
                if _iban_ok(m[0]):
                    out[kind].append(m.span())
        elif kind == "secret":
            m = _SECRET.match(text, last + 1)
            if m:
                end = m.start(1) + len(m[1].rstrip("."))
                done[kind] = m.end()
                if _secret_ok(text[m.start(1) : end]):
                    out[kind].append((m.start(1), end))
        else:
            m = _ACCOUNT.match(text, last + 1)
            if m:
                done[kind] = m.end()
                out[kind].append(m.span(1))
    return out


def listed(found: dict[str, list[tuple[int, int]]], kinds) -> str:
    return ",".join(f"{k}:{a}:{b}" for k in kinds for a, b in found[k])


def masked(text: str | None, found: dict[str, list[tuple[int, int]]] | None = None) -> str | None:
    """The text with each span replaced by its kind in brackets; of overlapping spans the earlier, then the longer."""
    if not text:
        return text
    found = found or spans(text)
    out, at = [], 0
    for a, b, kind in sorted(((a, b, k) for k in KINDS for a, b in found[k]), key=lambda s: (s[0], -s[1])):
        if a >= at:
            out += [text[at:a], f"[{kind}]"]
            at = b
    return "".join(out) + text[at:]


def find_personal_data(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text, any others): counts by base kind, base_sha256, spans.

    NULL is an empty text; repeated rows give repeated results.
    """

    def row(doc_id, text):
        f = spans(text)
        base = hashlib.sha256(listed(f, BASE_KINDS).encode()).hexdigest()
        return (doc_id, *(len(f[k]) for k in BASE_KINDS), base, listed(f, KINDS))

    counts = ", ".join(f"n_{k} long" for k in BASE_KINDS)
    return each_text(docs, row, ["doc_id", "text"], f"doc_id long, {counts}, base_sha256 string, spans string")


def mask_personal_data(docs: DataFrame) -> DataFrame:
    """doc_id and the masked text of every row."""
    return each_text(docs, lambda doc_id, text: (doc_id, masked(text)), ["doc_id", "text"], "doc_id long, text string")
