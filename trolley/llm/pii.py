"""Personal data by anchor expansion.

One Aho-Corasick pass over the whole text finds anchors: at-signs, plus signs, digits, URL schemes and
identifier cues.  A deterministic parser at each anchor expands to the left and right, finds the boundaries
and validates.  Each parser reads a stretch of text a bounded number of times, so time is linear in the text.

Base kinds are the leftmost, non-overlapping matches of fixed patterns, a match that fails validation being
dropped without a second try: email, ip (parts up to 255), card (13 to 19 digits, Luhn), phone (9 to 15
digits).  Kinds that cues add, under names of their own: login (user:password in a URL's authority), iban
(mod 97), account (6 to 17 digits after an account cue), ssn (nine digits in 3-2-4 form after a cue), mailbox
(an address written with "(at)" or "[at]").

Defined results: a null text is empty and has no spans; offsets count code points, ends are exclusive; very
long texts are parsed whole; repeated rows and null ids give one row each; extra columns are ignored; an
empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import re

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame

from trolley.llm.common import pick

# Characters and patterns of the base kinds, and the cues.
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
DIGITS = re.compile(r"[0-9]+")
AUTHORITY = re.compile(r"[^\s/?#\"'<>]*")
IBAN = re.compile(r"[\s:#=-]{0,4}([A-Z]{2}[0-9]{2}(?:[ -]?[A-Z0-9]){11,30})(?![A-Z0-9])")
ACCOUNT = re.compile(r"(?:\s{0,2}(?:number|num|no|nr|id)\b\.?)?[\s:#=]{0,4}([0-9](?:[ -]?[0-9]){5,16})(?![0-9])", re.I)
SSN = re.compile(r"(?:\s{0,2}(?:number|no)\b\.?)?[\s:#=]{0,4}([0-9]{3}-[0-9]{2}-[0-9]{4})(?![0-9])", re.I)
SPELLED = re.compile(r"\s?([A-Za-z0-9-]+(?:(?:\.|\s?[(\[]dot[)\]]\s?)[A-Za-z0-9-]+)+)", re.I)
BASE = ("email", "ip", "card", "phone")
ADDED = ("account", "iban", "login", "mailbox", "ssn")
CUES = {"iban": ("iban",), "account": ("account", "acct", "a/c", "konto", "compte", "cuenta"),
        "ssn": ("ssn", "social security"), "mailbox": ("(at)", "[at]")}


def anchors() -> ahocorasick.Automaton:
    a = ahocorasick.Automaton()
    for d in "0123456789":
        a.add_word(d, ("digit", 1))
    a.add_word("@", ("at", 1))
    a.add_word("+", ("plus", 1))
    a.add_word("://", ("scheme", 3))
    for kind, cues in CUES.items():
        for cue in cues:
            for form in {cue, cue.upper(), cue.title(), cue.capitalize()}:
                a.add_word(form, (kind, len(form)))
    a.make_automaton()
    return a


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def iban_end(text: str, start: int, end: int) -> int | None:
    """The end of the longest valid account number that starts at ``start``."""
    while end - start >= 15:
        plain = re.sub(r"[ -]", "", text[start:end])
        if 15 <= len(plain) <= 34 and text[end - 1] not in " -" and int("".join(str(int(c, 36)) for c in plain[4:] + plain[:4])) % 97 == 1:
            return end
        end -= 1
    return None


def find(text: str, automaton: ahocorasick.Automaton) -> dict[str, list[tuple[int, int]]]:
    """Spans by kind, in order of their start."""
    out: dict[str, list[tuple[int, int]]] = {k: [] for k in BASE + ADDED}
    at_end = card_end = ip_from = phone_end = 0
    for last, (kind, width) in automaton.iter(text):
        p, q = last - width + 1, last + 1
        if kind == "digit":
            if p >= ip_from:
                m = IP.match(text, p)
                if m:
                    ip_from = m.end()
                    if all(len(x.lstrip("0")) <= 3 and int(x.lstrip("0") or 0) <= 255 for x in m[0].split(".")):
                        out["ip"].append(m.span())
                else:  # no later digit of this run can start a match either
                    ip_from = DIGITS.match(text, p).end()
            if p >= card_end:
                m = CARD.match(text, p)
                if m:
                    card_end = m.end()
                    if m.end() - m.start() >= 13:
                        digits = m[0].replace(" ", "").replace("-", "")
                        if 13 <= len(digits) <= 19 and luhn(digits):
                            out["card"].append(m.span())
        elif kind == "at":
            start = p
            while start > at_end and text[start - 1] in LOCAL:
                start -= 1
            m = DOMAIN.match(text, q) if start < p else None
            if m:
                at_end = m.end()
                out["email"].append((start, at_end))
        elif kind == "plus":
            m = PHONE.match(text, p) if p >= phone_end else None
            if m:
                phone_end = m.end()
                if 9 <= sum("0" <= c <= "9" for c in m[0]) <= 15:
                    out["phone"].append(m.span())
        elif kind == "scheme":
            m = AUTHORITY.match(text, q)
            user = m[0].rpartition("@")[0]
            if ":" in user and p and text[p - 1].isalnum():
                out["login"].append((q, q + len(user)))
        elif kind == "iban":
            m = IBAN.match(text, q)
            end = iban_end(text, m.start(1), m.end(1)) if m else None
            if end:
                out["iban"].append((m.start(1), end))
        elif kind == "mailbox":
            start = p
            if start and text[start - 1] == " ":
                start -= 1
            end = start
            while start and text[start - 1] in LOCAL:
                start -= 1
            m = SPELLED.match(text, q) if start < end else None
            if m:
                out["mailbox"].append((start, m.end()))
        else:
            m = (ACCOUNT if kind == "account" else SSN).match(text, q)
            if m and (kind == "account" or m[1][:3] not in ("000", "666") and m[1][0] != "9" and m[1][4:6] != "00" and m[1][7:] != "0000"):
                out[kind].append(m.span(1))
    for kind in ADDED:
        out[kind] = sorted(set(out[kind]))
    return out


def personal_data(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row: doc_id, counts and digest of the base kinds, and all spans."""
    docs = pick(docs, doc_id=doc_id, text=text)
    kind = docs.schema["doc_id"].dataType.simpleString()

    def scan(batches):
        automaton = anchors()
        for batch in batches:
            counts, digest, spans = {k: [] for k in BASE}, [], []
            for value in batch.column("text"):
                found = find(value.as_py() or "", automaton)
                write = lambda kinds: ",".join(f"{k}:{a}:{b}" for k in kinds for a, b in found[k])  # noqa: B023, E731
                for k in BASE:
                    counts[k].append(len(found[k]))
                digest.append(hashlib.sha256(write(BASE).encode()).hexdigest())
                spans.append(write(BASE + ADDED))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *[pa.array(counts[k], pa.int64()) for k in BASE], pa.array(digest, pa.string()), pa.array(spans, pa.string())],
                                             ["doc_id", *[f"n_{k}" for k in BASE], "base_sha256", "spans"])

    return docs.mapInArrow(scan, f"doc_id {kind}, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string")
