"""Format-preserving pseudonyms for personal data.

Values are found by pattern and validated (checksums, calendar, ranges). At a place every kind and every end
a value may have there is tried; where none is valid, the search goes on one word later. The digits of a number are permuted by
a keyed Feistel network over strings of that length; a date moves to another day of its range; in an
e-mail address letters and digits are permuted among themselves. Punctuation, length and case stay, so
does validity: card numbers and IBANs get a fitting check digit again. The permutation depends only on the key
and the value, so equal values stay equal in all documents, whatever their punctuation.

Null texts stay null with zero counts.
"""

from __future__ import annotations

import datetime as dt
import hashlib
import re
from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KEY = b"pseudonyms"
ROUNDS = 8
KINDS = ("email", "card", "iban", "ip", "ssn", "phone", "date")
_FIRST_DAY, _DAYS = dt.date(1900, 1, 1).toordinal(), dt.date(2100, 1, 1).toordinal() - dt.date(1900, 1, 1).toordinal()

#: What the kinds look like, in the order they are tried at a place.
PATTERNS = {
    "email": r"(?<![\w.+-])[A-Za-z0-9._%+-]+@(?:[A-Za-z0-9-]+\.)+[A-Za-z]{2,}",
    "iban": r"(?<!\w)[A-Z]{2}[0-9]{2}(?:[ ]?[A-Z0-9]{4}){2,7}(?:[ ]?[A-Z0-9]{1,3})?(?!\w)",
    "ip": r"(?<![\w.])[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?![\w]|\.[0-9])",
    "date": r"(?<![\w./-])(?:[0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{1,2}[./][0-9]{1,2}[./][0-9]{4})(?![\w/-]|\.[0-9])",
    "ssn": r"(?<![\w-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![\w-])",
    "card": r"(?<![\w.+-])[0-9](?:[ -]?[0-9]){12,18}(?![\w]|[.-][0-9])",
    "phone": r"(?<![\w+])(?:\+[0-9]{1,3}[ .-]?)?(?:\([0-9]{2,4}\)|[0-9]{2,4})[ .-]?[0-9]{3,4}[ .-][0-9]{4}(?![\w]|[.-][0-9])",
}
#: Solid length of an IBAN by country.
IBAN_LENGTHS = {c[:2]: int(c[2:]) for c in (
    "AD24 AE23 AL28 AT20 AZ28 BA20 BE16 BG22 BH22 BI27 BR29 BY28 CH21 CR22 CY28 CZ24 DE22 DJ27 DK18 DO28 EE20 EG29 "
    "ES24 FI18 FK18 FO18 FR27 GB22 GE22 GI23 GL18 GR27 GT28 HN28 HR21 HU28 IE22 IL23 IQ23 IS26 IT27 JO30 KW30 KZ20 "
    "LB28 LC32 LI21 LT20 LU20 LV21 LY25 MC27 MD24 ME22 MK19 MN20 MR27 MT31 MU30 NI28 NL18 NO15 OM23 PK24 PL28 PS29 "
    "PT25 QA29 RO24 RS22 RU33 SA24 SC31 SD18 SE24 SI19 SK24 SM27 SO23 ST25 SV28 TL23 TN24 TR26 UA29 VA22 VG24 XK20 YE30"
).split()}
#: The longest run a card or IBAN may begin, whatever stands behind it.
_RUNS = {
    "iban": r"(?<!\w)[A-Z]{2}[0-9]{2}(?:[ ]?[A-Z0-9]){8,30}",
    "card": r"(?<![\w.+-])[0-9](?:[ -]?[0-9]){12,18}",
}
_COMPILED = {k: re.compile(_RUNS.get(k, p)) for k, p in PATTERNS.items()}
_ANY = re.compile("|".join(f"(?:{p.pattern})" for p in _COMPILED.values()))
_IBAN = re.compile(PATTERNS["iban"])
_IBAN_SHAPE = re.compile(r"[A-Z]{2}[0-9]{2}(?:[ ]?[A-Z0-9]{4}){2,7}(?:[ ]?[A-Z0-9]{1,3})?")
_CARD_SHAPE = re.compile(r"[0-9]{4}([ -]?)[0-9]{4}\1[0-9]{4}\1[0-9]{4}|[0-9]{4}([ -]?)[0-9]{6}\2[0-9]{5}")
_CARD_END = re.compile(r"(?![\w]|[.-][0-9])")
_INNER_END = re.compile(r"-[0-9]")
#: Groups of four digits, as they occur in the middle of card numbers and IBANs.
_FOURS = re.compile(r"[0-9]{4}(?:[ .-]?[0-9]{4})+")
_WORD = re.compile(r"[A-Za-z0-9]+|.", re.DOTALL)
_HINT = re.compile(r"[0-9@]")


def feistel(value: int, length: int, radix: int, key: bytes, tweak: str) -> int:
    """A keyed permutation of the numbers with `length` digits in base `radix`."""
    if length < 1:
        return value
    low_n = length // 2
    a, b = divmod(value, radix ** low_n)
    a_n, b_n = length - low_n, low_n
    for turn in range(ROUNDS):
        said = f"{tweak}|{length}|{radix}|{turn}|{b}".encode()
        mixed = int.from_bytes(hashlib.blake2b(said, key=key, digest_size=32).digest(), "big")
        a, b = b, (a + mixed) % radix ** a_n
        a_n, b_n = b_n, a_n
    # halves of unequal length have changed places an even number of times
    return a * radix ** b_n + b


def permute(value: int, size: int, key: bytes, tweak: str, valid: Callable[[int], bool] = lambda v: True) -> int:
    """A keyed permutation of the valid numbers below `size`: permuted again until one is met."""
    length = len(str(size - 1))
    while True:
        value = feistel(value, length, 10, key, tweak)
        if value < size and valid(value):
            return value


def _refill(shape: str, digits: str) -> str:
    """`shape` with its digits replaced, in order."""
    left = iter(digits)
    return re.sub("[0-9]", lambda _: next(left), shape)


def _digits(text: str) -> str:
    return re.sub("[^0-9]", "", text)


def luhn_digit(digits: str) -> str:
    """The check digit that belongs behind `digits`."""
    total = 0
    for i, c in enumerate(reversed(digits)):
        n = int(c) * (2 if i % 2 == 0 else 1)
        total += n - 9 if n > 9 else n
    return str(-total % 10)


def _card(found: str, key: bytes) -> str | None:
    digits = _digits(found)
    body = digits[:-1]
    if luhn_digit(body) != digits[-1] or len(set(digits)) == 1:
        return None
    new = str(permute(int(body), 10 ** len(body), key, "card")).zfill(len(body))
    return _refill(found, new + luhn_digit(new))


def iban_check(country: str, body: str) -> str:
    """The two check digits of an IBAN."""
    number = "".join(str(int(c, 36)) for c in body + country + "00")
    return f"{98 - int(number) % 97:02d}"


def _iban(found: str, key: bytes) -> str | None:
    solid = found.replace(" ", "")
    country, body = solid[:2], solid[4:]
    if iban_check(country, body) != solid[2:4] or not re.search("[0-9]", body):
        return None
    digits = _digits(body)
    new = _refill(body, str(permute(int(digits), 10 ** len(digits), key, "iban")).zfill(len(digits)))
    left = iter(country + iban_check(country, new) + new)
    return re.sub("[A-Z0-9]", lambda _: next(left), found)


def _ip(found: str, key: bytes) -> str | None:
    parts = [int(p) for p in found.split(".")]
    if max(parts) > 255:
        return None
    value = permute(int.from_bytes(bytes(parts), "big"), 1 << 32, key, "ip")
    return ".".join(map(str, value.to_bytes(4, "big")))


def _ssn(found: str, key: bytes) -> str | None:
    def valid(v: int) -> bool:
        area, group, serial = v // 10 ** 6, v // 10 ** 4 % 100, v % 10 ** 4
        return 0 < area < 900 and area != 666 and group > 0 and serial > 0

    value = int(_digits(found))
    if not valid(value):
        return None
    return _refill(found, str(permute(value, 10 ** 9, key, "ssn", valid)).zfill(9))


def _phone(found: str, key: bytes) -> str | None:
    digits = _digits(found)
    if not 7 <= len(digits) <= 15:
        return None
    country = re.match(r"\+[0-9]{1,3}(?=[ .-])", found)
    keep = len(country[0]) - 1 if country else 0
    rest = digits[keep:]
    new = str(permute(int(rest), 10 ** len(rest), key, "phone")).zfill(len(rest))
    return _refill(found, digits[:keep] + new)


def _date(found: str, key: bytes) -> str | None:
    parts = [int(p) for p in re.findall("[0-9]+", found)]
    if "-" in found:
        orders = [(0, 1, 2)]
    else:  # month first with slashes where that is a date, else day first
        orders = [(2, 0, 1), (2, 1, 0)] if "/" in found else [(2, 1, 0)]
    for y, m, d in orders:
        try:
            day = dt.date(parts[y], parts[m], parts[d]).toordinal() - _FIRST_DAY
        except ValueError:
            continue
        if not 0 <= day < _DAYS:
            return None
        def back(v: int) -> str:
            moved = dt.date.fromordinal(v + _FIRST_DAY)
            values = {y: f"{moved.year:04d}", m: f"{moved.month:02d}", d: f"{moved.day:02d}"}
            marks = re.findall("[^0-9]", found)
            return values[0] + marks[0] + values[1] + marks[1] + values[2]
        return back(permute(day, _DAYS, key, "date"))
    return None


def _email(found: str, key: bytes) -> str:
    def swap(text: str, tweak: str) -> str:
        for chars, first in ("[0-9]", "0"), ("[A-Za-z]", "a"):
            radix = 10 if first == "0" else 26
            held = "".join(re.findall(chars, text)).lower()
            if not held:
                continue
            value = 0
            for c in held:
                value = value * radix + ord(c) - ord(first)
            value = feistel(value, len(held), radix, key, tweak)
            new = []
            for _ in held:
                value, digit = divmod(value, radix)
                new.append(chr(ord(first) + digit))
            left = iter(reversed(new))
            text = re.sub(chars, lambda m: next(left).upper() if m[0].isupper() else next(left), text)
        return text

    local, _, domain = found.partition("@")
    host, _, top = domain.rpartition(".")
    return f"{swap(local, 'email')}@{swap(host, 'host')}.{top}"


_MAKERS = {"email": _email, "card": _card, "iban": _iban, "ip": _ip, "ssn": _ssn, "phone": _phone, "date": _date}


def pseudonymise(text: str, key: bytes = KEY) -> tuple[str, dict[str, int]]:
    """The text with every validated value replaced, and how many of each kind there were."""
    counts = dict.fromkeys(KINDS, 0)
    if not _HINT.search(text):
        return text, counts

    parts, done, at, run_end = [], 0, 0, 0
    while match := _ANY.search(text, at):
        start = match.start()
        for kind, pattern in _COMPILED.items():
            again = pattern.match(text, start)
            if not again:
                continue
            # four digits and four are part of the number they stand in, not a phone of their own
            if kind == "phone" and start < run_end and _FOURS.fullmatch(again[0]):
                continue
            end, new = _first_valid(kind, text, again, key)
            if new is not None:
                counts[kind] += 1
                parts += text[done:start], new
                done = at = end
                break
            if kind == "iban" or kind == "card" and _FOURS.match(again[0]):
                run_end = max(run_end, again.end())
        else:
            at = _WORD.match(text, start).end()
    return "".join(parts) + text[done:], counts


def _ends(kind: str, text: str, found: re.Match) -> list[int]:
    """Where a value of the kind may end that begins where `found` does, in the order they are tried."""
    start, end = found.span()
    if kind not in _RUNS and kind != "phone":
        return [end]
    # digits before a card may look like a phone with its first groups, or pass the check by chance
    later = end if kind == "iban" else next(
        (i for i in range(start + 1, end) if text[i - 1] == " " and _holds_card(text, i)), end)
    if kind == "phone":
        return [end] if later == end else []
    solid = [i + 1 for i in range(start, end) if text[i] not in " -"]
    if kind == "card":
        shaped = {e for e in solid[12:] if _CARD_SHAPE.fullmatch(text, start, e)}
        return [e for e in reversed(solid[12:]) if (e in shaped or e <= later)
                and (_CARD_END.match(text, e) or e in shaped and _INNER_END.match(text, e))]
    whole = _IBAN.match(text, start)
    known = IBAN_LENGTHS.get(text[start:start + 2])
    if known:
        # the check digits hold for a number of this length, so letters may follow at once
        ends = [e for e in solid[known - 1:known] if not re.match("[0-9]", text[e:e + 1])]
        ends += [whole.end()] if whole else []
    else:
        ends = [e for e in reversed(solid[11:]) if not re.match(r"\w", text[e:e + 1])]
    return [e for e in ends if _IBAN_SHAPE.fullmatch(text, start, e)]


def _holds_card(text: str, at: int) -> bool:
    """Whether a card in one of the usual groupings begins at this place."""
    found = _CARD_SHAPE.match(text, at)
    if not found or not _CARD_END.match(text, found.end()):
        return False
    digits = _digits(found[0])
    return luhn_digit(digits[:-1]) == digits[-1] and len(set(digits)) > 1


def _first_valid(kind: str, text: str, found: re.Match, key: bytes) -> tuple[int, str | None]:
    """The end of the first valid value and what replaces it; None if there is no valid one."""
    for end in _ends(kind, text, found):
        new = _MAKERS[kind](text[found.start():end], key)
        if new is not None:
            return end, new
    return found.end(), None


def hide(docs: DataFrame, key: bytes = KEY, text: str = "text") -> DataFrame:
    """`docs` with `text` replaced, plus `n_<kind>` for every kind and `n_pii`, their sum."""
    def swap(texts: pd.Series) -> pd.DataFrame:
        rows = []
        for body in texts:
            new, counts = pseudonymise(body, key) if isinstance(body, str) else (None, dict.fromkeys(KINDS, 0))
            rows.append((new, *counts.values()))
        return pd.DataFrame(rows, columns=["text", *KINDS])

    kinds = ", ".join(f"{k} bigint" for k in KINDS)
    swapped = docs.withColumn("_new", F.pandas_udf(swap, f"text string, {kinds}")(F.col(text)))
    return swapped.withColumns({
        text: F.col("_new.text"), **{f"n_{k}": F.col(f"_new.{k}") for k in KINDS},
        "n_pii": sum((F.col(f"_new.{k}") for k in KINDS), F.lit(0)).cast("bigint"),
    }).drop("_new")
