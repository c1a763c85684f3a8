"""Personal data: patterns propose spans, checksums confirm, context scores.

1. *Propose.* One pattern per kind, leftmost and non-overlapping; every
   pattern runs in time linear in the text (an address is found from its ``@``,
   digit runs are matched possessively), so long unbroken texts are safe.
2. *Confirm.* Validators: each part of an IP address at most 255, 13 to 19
   digits passing Luhn for cards, 9 to 15 digits for phones, mod-97 for IBANs,
   issued ranges for US social security numbers. A failing proposal is dropped.
3. *Score.* A confirmed span starts at its kind's base score; a context word
   within ``WINDOW`` characters raises it, a word that speaks against the kind
   lowers it. The kinds email, ip, card and phone are reported at any score;
   iban and ssn only from ``THRESHOLD`` on.

Defined results: a null or empty text has no spans; equal rows get equal
results; rows with a null id keep the null.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .common import map_batches

# Order of the kinds in a span list (fixed values).
KINDS = ("email", "ip", "card", "phone", "iban", "ssn")
BASE_KINDS = KINDS[:4]
BASE_SCORE = {"email": 0.9, "ip": 0.6, "card": 0.7, "phone": 0.6, "iban": 0.8, "ssn": 0.4}
CONTEXT = {
    "email": "mail e-mail contact correo courriel kontakt write",
    "ip": "ip host server address login adresse client",
    "card": "card visa mastercard credit debit karte tarjeta carte payment amex",
    "phone": "phone tel call mobile fax telefon telefono whatsapp number",
    "iban": "iban bank account konto cuenta compte transfer",
    "ssn": "ssn social security taxpayer",
}
AGAINST = {
    "ip": "version release build section chapter",
    "card": "isbn order tracking serial",
    "phone": "isbn order serial",
    "ssn": "isbn part serial order invoice",
}
WINDOW = 48
BOOST, PENALTY, THRESHOLD = 0.25, 0.35, 0.5

SPAN = T.StructType([
    T.StructField("kind", T.StringType()), T.StructField("start", T.IntegerType()),
    T.StructField("end", T.IntegerType()), T.StructField("score", T.DoubleType())])
RESULT = T.StructType([T.StructField("spans", T.ArrayType(SPAN))])

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_DIGITS = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?(?![A-Za-z0-9])")
_SSN = re.compile(r"(?<![0-9-])([0-9]{3})-([0-9]{2})-([0-9]{4})(?![0-9-])")
_HAS_DIGIT = re.compile(r"[0-9]")
_WORDS = {k: re.compile(r"(?<![a-z])(?:" + "|".join(map(re.escape, v.split())) + r")(?![a-z])")
          for k, v in CONTEXT.items()}
_NOT_WORDS = {k: re.compile(r"(?<![a-z])(?:" + "|".join(map(re.escape, v.split())) + r")(?![a-z])")
              for k, v in AGAINST.items()}


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        n = int(c) * (1 + i % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def mod97(iban: str) -> bool:
    s = iban.replace(" ", "")
    return 15 <= len(s) <= 34 and int("".join(str(int(c, 36)) for c in s[4:] + s[:4])) % 97 == 1


# Registered IBAN lengths (fixed values).
IBAN_LENGTH = {c: int(n) for n, cs in (x.split(":") for x in (
    "15:NO 16:BE 18:DK,FI,FO,GL,NL 19:MK,SI 20:AT,BA,EE,KZ,LT,LU,XK 21:CH,HR,LI,LV 22:BG,BH,CR,DE,GB,GE,IE,ME,RS,VA"
    " 23:AE,GI,IL,IQ,TL 24:AD,CZ,ES,MD,PK,RO,SA,SE,SK,TN,VG 25:LY,PT,ST 26:IS,TR 27:FR,GR,IT,MC,MR,SM"
    " 28:AL,AZ,BY,CY,DO,GT,HU,LB,PL,SV 29:BR,EG,PS,QA,UA 30:JO,KW,MU 31:MT,SC 32:LC").split()) for c in cs.split(",")}


def _ibans(text: str):
    """Proposals cut at their country's length, where a group ends there, else whole."""
    pos = 0
    while m := _IBAN.search(text, pos):
        s, e, left = m.start(), m.start(), IBAN_LENGTH.get(m[0][:2], 0)
        while e < m.end() and left:
            left -= text[e] != " "
            e += 1
        for end in ([e] if e < m.end() and text[e] == " " and not left else []) + [m.end()]:
            if mod97(text[s:end]):
                yield s, end
                pos = end
                break
        else:
            pos = s + 4  # a valid one may begin inside a refused proposal


def _emails(text: str):
    at, last = text.find("@"), 0
    while at >= 0:
        start = at
        while start > last and text[start - 1] in _LOCAL:
            start -= 1
        if start < at and (m := _DOMAIN.match(text, at + 1)):
            yield start, m.end()
            last = m.end()
        else:
            last = max(last, at)  # a local part never reaches over an @
        at = text.find("@", at + 1 if last <= at else last)


def _confirmed(text: str):
    """(kind, start, end) of every proposal that its validator confirms."""
    if "@" in text:
        for s, e in _emails(text):
            yield "email", s, e
    if not _HAS_DIGIT.search(text):
        return
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in m[0].split(".")):
            yield "ip", m.start(), m.end()
    for m in _DIGITS.finditer(text):
        if m.end() - m.start() >= 13:
            digits = m[0].replace(" ", "").replace("-", "")
            if 13 <= len(digits) <= 19 and luhn(digits):
                yield "card", m.start(), m.end()
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 9 <= sum(c.isdigit() for c in m[0]) <= 15:
                yield "phone", m.start(), m.end()
    for s, e in _ibans(text):
        yield "iban", s, e
    for m in _SSN.finditer(text):
        if m[1] not in ("000", "666") and m[1] < "900" and m[2] != "00" and m[3] != "0000":
            yield "ssn", m.start(), m.end()


def find_spans(text: str | None) -> list[tuple[str, int, int, float]]:
    """Scored spans of one text, by kind (order of ``KINDS``) and start."""
    out = []
    for kind, s, e in _confirmed(text or ""):
        near = (text[max(0, s - WINDOW):s] + " " + text[e:e + WINDOW]).lower()
        score = BASE_SCORE[kind]
        if _WORDS[kind].search(near):
            score += BOOST
        if kind in _NOT_WORDS and _NOT_WORDS[kind].search(near):
            score -= PENALTY
        score = round(min(1.0, max(0.0, score)), 4)
        if kind in BASE_KINDS or score >= THRESHOLD:
            out.append((kind, s, e, score))
    return out


def detect_pii(df: DataFrame, text_col: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` columns plus ``spans``: array of (kind, start, end, score)
    over the whole text, offsets in code points, end exclusive."""
    def start():
        return lambda texts: ((find_spans(t),) for t in texts)

    return map_batches(df, [text_col], list(keep), RESULT, start)
