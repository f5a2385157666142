"""Personal data by anchor expansion.

An Aho-Corasick automaton finds the anchors in one pass over a text: at-signs, plus signs,
digits, ``://`` and the cues of identifiers and secrets.  Deterministic local parsers
expand an anchor to the left and right and validate what they get.  Each parser moves on
only, from where its last match ended, so the spans of a kind are leftmost and never
overlap, and time is linear in the text.

Base kinds: ``email``, ``ip`` (four numbers up to 255), ``card`` (14 to 19 digits, Luhn) and
``phone`` (plus and 10 to 15 digits); what fails validation is used up, not retried.
Added kinds: ``url`` (a scheme and what follows), ``iban`` (checked modulo 97), ``key``
(access key ids) and ``credential`` (the value after password, token, secret or api key).

Defined cases: a null text is empty; a text without spans has empty lists and the digest of
the empty string; repeated rows get equal results; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# --- fixed values: kinds, cues and the characters of each part ---
BASE_KINDS = ("email", "ip", "card", "phone")
ADDED_KINDS = ("url", "iban", "key", "credential")
CREDENTIAL_CUES = ("password", "passwd", "token", "secret", "api_key", "apikey")
KEY_CUES = ("AKIA", "ASIA")
IBAN_CUES = ("IBAN", "iban")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
QUAD = re.compile(r"([0-9]++)\.([0-9]++)\.([0-9]++)\.([0-9]++)")
DIGITS = re.compile(r"[0-9]++")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
URL_REST = re.compile(r"[^\s<>\"'`]+")
KEY = re.compile(r"(?:AKIA|ASIA)[A-Z0-9]{16}(?![A-Za-z0-9])")
VALUE = re.compile(r"\s?[=:]\s?[\"']?([A-Za-z0-9+/_.~-]{6,}={0,2})")
IBAN = re.compile(r"[ :]{0,2}([A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]){11,30})")
# --- end of fixed values ---

_ORDER = {k: i for i, k in enumerate(BASE_KINDS + ADDED_KINDS)}


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        v = ord(c) - 48
        if k % 2:
            v = v * 2 - 9 * (v > 4)
        total += v
    return total % 10 == 0


def iban_ok(s: str) -> bool:
    turned = s[4:] + s[:4]
    return 15 <= len(s) <= 34 and int("".join(str(int(c, 36)) for c in turned)) % 97 == 1


def anchors():
    """The automaton: every anchor with the parser it starts."""
    import ahocorasick

    a = ahocorasick.Automaton()
    for text, what in [("@", "@"), ("+", "+"), ("://", "://"), *((str(d), "0") for d in range(10)),
                       *((c, "key") for c in KEY_CUES), *((c, "iban") for c in IBAN_CUES),
                       *((v, "credential") for c in CREDENTIAL_CUES for v in {c, c.upper(), c.capitalize()})]:
        a.add_word(text, (what, len(text)))
    a.make_automaton()
    return a


def find_spans(text: str, automaton) -> tuple[list[tuple[int, int, str]], list[tuple[int, int, str]]]:
    """(base spans, added spans) as (start, end, kind) in code points, end exclusive."""
    base: list[tuple[int, int, str]] = []
    added: list[tuple[int, int, str]] = []
    email_end = ip_end = card_end = phone_end = run_end = url_end = 0
    for last, (what, size) in automaton.iter(text):
        p = last - size + 1
        if what == "0":
            if p < run_end:
                continue
            run_end = DIGITS.match(text, p).end()  # one look at each run of digits
            if p >= ip_end and (m := QUAD.match(text, p)):
                ip_end = m.end()
                if all(len(z := g.lstrip("0")) <= 3 and int(z or 0) <= 255 for g in m.groups()):
                    base.append((p, ip_end, "ip"))
            if p >= card_end and (m := CARD.match(text, p)):
                card_end = m.end()
                digits = m[0].replace(" ", "").replace("-", "")
                if 14 <= len(digits) <= 19 and luhn(digits):
                    base.append((p, card_end, "card"))
        elif what == "@":
            s = p
            while s > email_end and text[s - 1] in LOCAL:
                s -= 1
            if s < p and (m := DOMAIN.match(text, p + 1)):
                email_end = m.end()
                base.append((s, email_end, "email"))
        elif what == "+":
            if p >= phone_end and (m := PHONE.match(text, p)):
                phone_end = m.end()
                if 10 <= sum(map(str.isdigit, m[0])) <= 15:
                    base.append((p, phone_end, "phone"))
        elif what == "://":
            s = p
            while s > url_end and text[s - 1].isascii() and text[s - 1].isalpha():
                s -= 1
            if s < p and (m := URL_REST.match(text, p + 3)):
                end = p + 3 + len(m[0].rstrip(".,;:!?)]}"))
                if end > p + 3:
                    url_end = m.end()
                    added.append((s, end, "url"))
        elif what == "key":
            if (p == 0 or not text[p - 1].isalnum()) and (m := KEY.match(text, p)):
                added.append((p, m.end(), "key"))
        elif what == "credential":
            if m := VALUE.match(text, last + 1):
                added.append((m.start(1), m.end(1), "credential"))
        elif m := IBAN.match(text, last + 1):
            value = m[1]
            for cut in range(len(value), 14, -1):
                if value[cut - 1] != " " and iban_ok(value[:cut].replace(" ", "")):
                    added.append((m.start(1), m.start(1) + cut, "iban"))
                    break
    return base, added


def joined(spans) -> str:
    return ",".join(f"{k}:{s}:{e}" for s, e, k in sorted(spans, key=lambda x: (x[0], _ORDER[x[2]], x[1])))


_SCHEMA = "n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string"


def span_column(text):
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        automaton = anchors()
        for col in batches:
            rows = []
            for t in col:
                base, added = find_spans(t or "", automaton)
                kinds = [k for _, _, k in base]
                rows.append((*(kinds.count(k) for k in BASE_KINDS), hashlib.sha256(joined(base).encode()).hexdigest(), joined(base + added)))
            yield pd.DataFrame(rows, columns=["n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"])

    run.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.DataFrame]}
    return F.pandas_udf(run, _SCHEMA).asNondeterministic()(text)


def find_pii(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans`` for every row of ``docs``."""
    return docs.select(F.col(id_col).alias("doc_id"), span_column(F.col(text_col).cast("string")).alias("p")).select("doc_id", "p.*")


def op3_pii(spark, sf_dir: str) -> DataFrame:
    return find_pii(spark.read.parquet(f"{sf_dir}/documents.parquet"))
