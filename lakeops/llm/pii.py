"""Personal data in texts by anchor expansion.

One Aho-Corasick pass finds the anchors: at-signs, ``://``, plus signs, digits and identifier cues such as ``IBAN``.  At each anchor a
deterministic parser expands to the boundaries and validates: an address left and right of the at-sign, a dotted quad with parts
up to 255, a card number by its check digit, a phone number by its digits, user data in a URL, an IBAN by its country's length and modulo 97, a cued social security or
account number.  Cues count in any case, and words such as ``number`` or ``is`` may follow them.
Of each kind, matches run from left to right without overlap; a failing match is dropped and what it covered is not tried again.

Positions count code points, ends are exclusive.  A null text is empty.  Long texts are scanned whole, in linear time.
"""

from __future__ import annotations

import hashlib
import re
import string
from collections.abc import Callable

import ahocorasick
from pyspark.sql import DataFrame

from lakeops.llm.rows import with_function

Span = tuple[str, int, int]
KINDS = ("email", "ip", "card", "phone", "userinfo", "iban", "ssn", "account")
CUES = {"iban": ("iban",), "ssn": ("ssn", "social security", "social-security", "social insurance"), "account": ("account", "acct", "a/c")}  # lower case
# Characters of an IBAN by country.
IBAN_LENGTHS = dict(
    AD=24, AE=23, AL=28, AT=20, AZ=28, BA=20, BE=16, BG=22, BH=22, BI=27, BR=29, BY=28, CH=21, CR=22, CY=28, CZ=24, DE=22, DJ=27, DK=18, DO=28, EE=20, EG=29, ES=24, FI=18,
    FK=18, FO=18, FR=27, GB=22, GE=22, GI=23, GL=18, GR=27, GT=28, HN=28, HR=21, HU=28, IE=22, IL=23, IQ=23, IS=26, IT=27, JO=30, KW=30, KZ=20, LB=28, LC=32, LI=21, LT=20,
    LU=20, LV=21, LY=25, MC=27, MD=24, ME=22, MK=19, MN=20, MR=27, MT=31, MU=30, NI=28, NL=18, NO=15, OM=23, PK=24, PL=28, PS=29, PT=25, QA=29, RO=24, RS=22, RU=33, SA=24,
    SC=31, SD=18, SE=24, SI=19, SK=24, SM=27, SO=23, ST=25, SV=28, TL=23, TN=24, TR=26, UA=29, VA=22, VG=24, XK=20, YE=30,
)

LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)
LOCAL = frozenset(string.ascii_letters + string.digits + "._%+-")
DIGITS = frozenset("0123456789")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
QUAD = re.compile(r"([0-9]+)\.([0-9]+)\.([0-9]+)\.([0-9]+)")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
SCHEME = frozenset(string.ascii_letters + string.digits + "+.-")
USERINFO = re.compile(r"[^\s/?#@:]+:[^\s/?#@]+@[^\s/?#]+")
AFTER_CUE = r"(?:[\s.:#-]{0,2}\b(?:no|nr|number|numbers|num|code|id|is|was)\b){0,3}\.?\s{0,3}[:=#]?\s{0,3}"
IBAN = re.compile(AFTER_CUE + r"(([A-Z]{2})[0-9]{2}(?:\x20?[A-Z0-9])+)", re.I | re.A)
ALPHANUMERIC = frozenset(string.ascii_letters + string.digits)
SSN = re.compile(AFTER_CUE + r"([0-9]{3}-[0-9]{2}-[0-9]{4})(?![0-9-])", re.I)
ACCOUNT = re.compile(AFTER_CUE + r"([0-9](?:[\x20-]?[0-9]){6,16})(?![0-9-])", re.I)


def luhn(number: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(number)):
        d = int(c) * (1 + k % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def only_digits(text: str) -> str:
    return "".join(c for c in text if c in DIGITS)


def iban_holds(text: str) -> bool:
    text = text.replace(" ", "").upper()
    return 15 <= len(text) <= 34 and int("".join(str(int(c, 36)) for c in text[4:] + text[:4])) % 97 == 1


def part_fits(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) <= 3 and int(part or 0) <= 255


def automaton() -> ahocorasick.Automaton:
    anchors = ahocorasick.Automaton()
    for word, kind in [("@", "email"), ("://", "userinfo"), ("+", "phone"), *((d, "digit") for d in sorted(DIGITS))]:
        anchors.add_word(word, (kind, len(word)))
    for kind, words in CUES.items():
        for word in words:
            anchors.add_word(word, (kind, len(word)))
    anchors.make_automaton()
    return anchors


class Expander:
    """The local parsers.  ``ends`` holds for each kind how far the text is used up."""

    def __init__(self, text: str):
        self.text, self.spans = text, []
        self.ends = dict.fromkeys(KINDS, 0)

    def _take(self, kind: str, start: int, end: int, holds: bool) -> None:
        self.ends[kind] = end
        if holds:
            self.spans.append((kind, start, end))

    def email(self, at: int, _: int) -> None:
        text, start, least = self.text, at, self.ends["email"]
        while start > least and text[start - 1] in LOCAL:
            start -= 1
        if start < at and (domain := DOMAIN.match(text, at + 1)):
            self._take("email", start, domain.end(), True)

    def digit(self, at: int, _: int) -> None:
        text = self.text
        if at >= self.ends["ip"] and (at == self.ends["ip"] or text[at - 1] not in DIGITS) and (m := QUAD.match(text, at)):
            self._take("ip", at, m.end(), all(map(part_fits, m.groups())))
        if at >= self.ends["card"] and (m := CARD.match(text, at)):
            number = only_digits(m[0])
            self._take("card", at, m.end(), 16 <= len(number) <= 19 and luhn(number))

    def phone(self, at: int, _: int) -> None:
        if at >= self.ends["phone"] and (m := PHONE.match(self.text, at)):
            self._take("phone", at, m.end(), 8 <= len(only_digits(m[0])) <= 15)

    def userinfo(self, at: int, end: int) -> None:
        start = at
        while start > self.ends["userinfo"] and self.text[start - 1] in SCHEME:
            start -= 1
        if start < at and (m := USERINFO.match(self.text, end)):
            self._take("userinfo", start, m.end(), True)

    def _cued(self, kind: str, pattern: re.Pattern, end: int, holds: Callable[[str], bool]) -> None:
        if end >= self.ends[kind] and (m := pattern.match(self.text, end)):
            self._take(kind, m.start(1), m.end(1), holds(m[1]))

    def iban(self, _: int, end: int) -> None:
        """As many characters as the country has; words may follow, separated from it."""
        if end < self.ends["iban"] or not (m := IBAN.match(self.text, end)):
            return
        start, at, left = m.start(1), m.start(1), IBAN_LENGTHS.get(m[2].upper(), 0)
        while left and at < m.end():
            left -= self.text[at] != " "
            at += 1
        whole = not left and self.text[at : at + 1] not in ALPHANUMERIC
        self._take("iban", start, at if at > start else m.end(), whole and iban_holds(self.text[start:at]))

    def ssn(self, _: int, end: int) -> None:
        self._cued("ssn", SSN, end, lambda x: x[:3] not in ("000", "666") and x[0] != "9" and x[4:6] != "00" and x[7:] != "0000")

    def account(self, _: int, end: int) -> None:
        self._cued("account", ACCOUNT, end, lambda x: True)


def joined(spans: list[Span]) -> str:
    ordered = sorted(spans, key=lambda s: (KINDS.index(s[0]), s[1]))
    return ",".join(f"{kind}:{start}:{end}" for kind, start, end in ordered)


def scanner() -> Callable[[str], tuple]:
    anchors = automaton()

    def scan(text: str) -> tuple:
        found = Expander(text)
        low = text.lower()
        if len(low) != len(text):  # a letter that two lower-case ones stand for
            low = text.translate(LOWER)
        for last, (kind, length) in anchors.iter(low):
            getattr(found, kind)(last + 1 - length, last + 1)
        count = lambda kind: sum(s[0] == kind for s in found.spans)
        base = [s for s in found.spans if s[0] in KINDS[:4]]
        return *(count(k) for k in KINDS[:4]), hashlib.sha256(joined(base).encode()).hexdigest(), joined(found.spans), len(found.spans)

    return scan


def find_personal_data(df: DataFrame, text: str, keep: list[str]) -> DataFrame:
    """The columns ``keep``, counts of the four base kinds, the digest of the base spans, all spans (``kind:start:end``) and their number."""
    return with_function(df, text, keep, scanner, "n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, n_spans long")
