"""Format-preserving pseudonyms for personal numbers, dates and addresses.

A found value is validated, read as a number within its format, moved by a keyed
Feistel permutation of all values of that format, and written back in the same
style. Equal values get equal pseudonyms in all documents, different values
different ones, and the key's owner can undo it.
"""

from __future__ import annotations

import datetime
import hashlib
import math
import re
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROUNDS = 8
FIRST_DAY = datetime.date(1900, 1, 1).toordinal()
DAYS = datetime.date(2100, 1, 1).toordinal() - FIRST_DAY
LONGEST_LOCAL = 64  # characters before the @ of a mail address, by the mail standard


def _draw(key: bytes, kind: str, turn: int, value: int) -> int:
    data = f"{kind}:{turn}:{value}".encode()
    return int.from_bytes(hashlib.blake2b(data, key=key, digest_size=16).digest(), "big")


@lru_cache(maxsize=100_000)
def permute(value: int, size: int, key: bytes, kind: str, back: bool = False) -> int:
    """A keyed permutation of 0 to size - 1: Feistel rounds over a * b >= size cells with cycle walking."""
    a = max(1, math.isqrt(size))
    b = -(-size // a)
    sign, turns = (-1, range(ROUNDS - 1, -1, -1)) if back else (1, range(ROUNDS))
    while True:
        left, right = divmod(value, b)
        for turn in turns:
            if turn % 2:
                right = (right + sign * _draw(key, kind, turn, left)) % b
            else:
                left = (left + sign * _draw(key, kind, turn, right)) % a
        value = left * b + right
        if value < size:
            return value


def luhn(digits: str) -> int:
    """The check digit that completes a number."""
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (2 - i % 2)
        total += d - 9 * (d > 9)
    return -total % 10


def _refill(shown: str, digits: str) -> str:
    """`shown` with its digits replaced in order."""
    new = iter(digits)
    return "".join(next(new) if c.isdigit() else c for c in shown)


def _digits(text: str) -> str:
    return "".join(c for c in text if c.isdigit())


def card(shown: str, key: bytes, back: bool = False) -> str | None:
    """13 to 19 digits with a right check digit; the first digit stays, the check digit is computed anew."""
    digits = _digits(shown)
    if not 13 <= len(digits) <= 19 or luhn(digits[:-1]) != int(digits[-1]) or len(set(digits)) == 1:
        return None
    n = len(digits) - 2
    body = digits[0] + f"{permute(int(digits[1:-1]), 10**n, key, f'card{n}', back):0{n}d}"
    return _refill(shown, body + str(luhn(body)))


def account(shown: str, key: bytes, back: bool = False) -> str | None:
    """An IBAN with right check digits; country and letters stay, digits move, check digits are computed anew."""
    plain = shown.replace(" ", "")

    def remainder(text: str) -> int:
        return int("".join(str(int(c, 36)) for c in text[4:] + text[:4])) % 97

    if not 15 <= len(plain) <= 34 or remainder(plain) != 1:
        return None
    body = plain[4:]
    digits = _digits(body)
    if not digits:
        return None
    moved = f"{permute(int(digits), 10 ** len(digits), key, f'iban{len(digits)}', back):0{len(digits)}d}"
    body = _refill(body, moved)
    check = 98 - remainder(plain[:2] + "00" + body)
    new = iter(plain[:2] + f"{check:02d}" + body)
    return "".join(c if c == " " else next(new) for c in shown)


def social(shown: str, key: bytes, back: bool = False) -> str | None:
    """A US social security number of a range that is given out, mapped within those."""
    area, group, serial = (int(part) for part in re.split(r"[- ]", shown))
    if area in (0, 666) or area >= 900 or not group or not serial:
        return None
    areas = 898
    value = ((area - 1 - (area > 666)) * 99 + group - 1) * 9999 + serial - 1
    value = permute(value, areas * 99 * 9999, key, "ssn", back)
    rest, serial = divmod(value, 9999)
    area, group = divmod(rest, 99)
    area += 1 + (area >= 665)
    return _refill(shown, f"{area:03d}{group + 1:02d}{serial + 1:04d}")


#: Country codes of the numbering plan: one, two or three digits, none the start of another.
_COUNTRY = re.compile(
    "1|7|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]"
    "|2[1-689][0-9]|3[578][0-9]|42[0-9]|5[09][0-9]|6[7-9][0-9]|8[0578][0-9]|9[679][0-9]"
)


def phone(shown: str, key: bytes, back: bool = False) -> str | None:
    """7 to 15 digits; a country code after a plus sign stays.

    The code is told by the digits alone, and only where no country has it by
    the separator behind it. Ten digits without one are those of country 1.
    """
    digits = _digits(shown)
    if not 7 <= len(digits) <= 15:
        return None
    code = (_COUNTRY.match(digits) or re.match(r"\+(\d{1,3})(?=\D)", shown)) if shown[0] == "+" else None
    kept = len(code[code.lastindex or 0]) if code else 0
    n = len(digits) - kept
    country = digits[:kept] or ("1" if n == 10 else "")  # three, three and four digits are written so in country 1
    moved = permute(int(digits[kept:]), 10**n, key, f"phone{country}:{n}", back)
    return _refill(shown, digits[:kept] + f"{moved:0{n}d}")


def address(shown: str, key: bytes, back: bool = False) -> str | None:
    """An IPv4 address."""
    parts = [int(part) for part in shown.split(".")]
    if max(parts) > 255:
        return None
    value = int.from_bytes(bytes(parts), "big")
    return ".".join(str(x) for x in permute(value, 1 << 32, key, "ip", back).to_bytes(4, "big"))


def date(shown: str, key: bytes, back: bool = False) -> str | None:
    """A calendar day of 1900 to 2099 as year-month-day, day.month.year or month/day/year.

    A day that only fits day/month/year is read and written so; whether such a
    pseudonym can be read back depends on its day being above 12.
    """
    numbers = [int(part) for part in re.findall(r"\d+", shown)]
    mark = shown[4] if shown[4:5] in ("-", "/", ".") else re.search(r"\D", shown)[0]
    orders = [(0, 1, 2)] if numbers[0] > 31 else [(2, 0, 1), (2, 1, 0)] if mark == "/" else [(2, 1, 0)]
    widths = [len(part) for part in re.findall(r"\d+", shown)]
    for y, m, d in orders:
        try:
            day = datetime.date(numbers[y], numbers[m], numbers[d]).toordinal() - FIRST_DAY
        except ValueError:
            continue
        if not 0 <= day < DAYS:
            return None
        new = datetime.date.fromordinal(FIRST_DAY + permute(day, DAYS, key, "date", back))
        parts = [""] * 3
        for place, value in zip((y, m, d), (new.year, new.month, new.day), strict=True):
            parts[place] = f"{value:0{max(2, widths[place])}d}"
        return mark.join(parts)
    return None


def mail(shown: str, key: bytes, back: bool = False) -> str | None:
    """An e-mail address: letters and digits of the local part move within their kinds, the domain stays.

    Upper and lower case stay at their places and make no difference otherwise.
    Local parts longer than mail allows move in pieces of that length.
    """
    local, _, domain = shown.partition("@")
    pieces = [local[i : i + LONGEST_LOCAL] for i in range(0, len(local), LONGEST_LOCAL)]
    moved = [_by_kind(piece, key, f"mail{i}-" if i else "mail", back) for i, piece in enumerate(pieces)]
    return "".join(moved) + "@" + domain


def secret(shown: str, key: bytes, back: bool = False) -> str | None:
    """A hexadecimal token of 32 or more places with letters and digits."""
    if not (re.search(r"\d", shown) and re.search(r"[a-fA-F]", shown)):
        return None
    n = len(shown)
    new = f"{permute(int(shown, 16), 16**n, key, f'hex{n}', back):0{n}x}"
    return new.upper() if shown.isupper() else new


def _by_kind(text: str, key: bytes, kind: str, back: bool) -> str:
    """Letters, read in lower case, and digits replaced as one number in mixed bases, everything else kept."""
    bases = [26 if "a" <= c <= "z" or "A" <= c <= "Z" else 10 if "0" <= c <= "9" else 1 for c in text]
    value = 0
    for c, base in zip(text, bases, strict=True):
        value = value * base + (0 if base == 1 else int(c) if base == 10 else ord(c.lower()) - 97)
    shape = "".join("-" if b == 1 else "9" if b == 10 else "a" for c, b in zip(text, bases, strict=True))
    value = permute(value, math.prod(bases), key, f"{kind}{shape}", back)
    out = []
    for c, base in zip(reversed(text), reversed(bases), strict=True):
        value, x = divmod(value, base)
        new = c if base == 1 else str(x) if base == 10 else chr(97 + x)
        out.append(new.upper() if c.isupper() else new)
    return "".join(reversed(out))


#: In order: a part of a text belongs to the first kind that finds and validates it.
KINDS = {
    "mail": (r"@[A-Za-z0-9\-]+(?:\.[A-Za-z0-9\-]+)+", mail),  # and what stands before the @, see `_local`
    "account": (r"\b[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?\b", account),
    "secret": (r"\b[0-9a-fA-F]{32,}\b", secret),
    "card": (r"(?<![\w.])\d(?:[ \-]?\d){12,18}(?![\w]|\.\d)", card),
    "social": (r"(?<![\w\-])\d{3}([\- ])\d{2}\1\d{4}(?![\w\-])", social),
    "date": (r"(?<![\w.\-/])(?:\d{4}([\-/.])\d{1,2}\1\d{1,2}|\d{1,2}([\-/.])\d{1,2}\2\d{4})(?![\w\-/]|\.\d)", date),
    "address": (r"(?<![\w.])\d{1,3}(?:\.\d{1,3}){3}(?![\w]|\.\d)", address),
    "phone": (
        r"\+\d{1,3}[ .\-]?(?:\(\d{1,4}\)[ .\-]?)?\d{2,4}(?:[ .\-]?\d{2,4}){1,4}(?!\w)"
        r"|(?<![\w.])\(\d{3}\) ?\d{3}[ .\-]\d{4}(?!\w)|(?<![\w.\-])\d{3}[.\-]\d{3}[.\-]\d{4}(?![\w\-])",
        phone,
    ),
}
#: Kinds whose pattern may take in a word or number behind the value.
OPEN_ENDED = {"account", "card", "phone"}
#: Characters of an IBAN by country.
IBAN_LENGTHS = {
    country: int(length)
    for length, countries in (
        line.split(":")
        for line in (
            "15:NO|16:BE|18:DK FI FK FO GL NL SD|19:MK SI|20:AT BA EE KZ LT LU MN XK|21:CH HR LI LV|"
            "22:BG BH CR DE GB GE IE ME RS VA|23:AE GI IL IQ OM SO TL|24:AD CZ ES MD PK RO SA SE SK TN VG|"
            "25:LY PT ST|26:IS TR|27:BI DJ FR GR IT MC MR SM|28:AL AZ BY CY DO GT HU LB NI PL SV YE|"
            "29:BR EG PS QA UA|30:JO KW MU|31:MT SC|32:LC|33:RU"
        ).split("|")
    )
    for country in countries.split()
}
#: Digits of the groups that cards are mostly written in.
_CARD_GROUPS = {(4, 4, 4, 4), (4, 6, 5), (4, 6, 4), *((n,) for n in range(13, 20))}
_ENDS = re.compile(r"(?<=[0-9A-Z)])(?=[ .\-])")
_PATTERNS = {kind: (re.compile(pattern, re.ASCII), replace) for kind, (pattern, replace) in KINDS.items()}
_DIGIT = re.compile(r"[0-9]")


_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")


def _local(text: str, at: int, least: int) -> int | None:
    """Where the local part before the @ at ``at`` starts, not before ``least``; it starts with a letter or digit."""
    start = at
    while start > least and text[start - 1] in _LOCAL:
        start -= 1
    while start < at and text[start] in "._%+-":
        start += 1
    return start if start < at else None


def _shorter(kind: str, shown: str) -> Iterator[int]:
    """Lengths at which the value at the start of a hit of a kind may end, in the order to try them.

    An IBAN ends first at the length of its country and a card at groups in
    which cards are written. Neither changes with the value, so that a pseudonym
    is read as its value was. Then come the whole hit and its parts that end
    before a separator, the longest first.
    """
    if kind not in OPEN_ENDED:
        yield len(shown)
        return
    ends = [*(end.start() for end in _ENDS.finditer(shown)), len(shown)]
    if kind == "account":
        length = IBAN_LENGTHS.get(shown[:2])
        first = [end for end in ends if end - shown.count(" ", 0, end) == length]
    elif kind == "card":
        first = [end for end in ends if tuple(map(len, re.split(r"[ \-]", shown[:end]))) in _CARD_GROUPS]
    else:
        first = []
    yield from first
    yield from (end for end in reversed(ends) if end not in first)


def pseudonymised(text: str | None, key: bytes, back: bool = False) -> tuple[str | None, list[tuple[str, int, int]]]:
    """The text with all found values replaced, and (kind, start, end) of each in the original.

    With `back` the replacement is undone. Spans of different kinds do not
    overlap; the kind that comes first in `KINDS` wins. Where a hit is not valid
    as a whole, its shorter parts are tried, then the search goes on one
    character behind its start.
    """
    if not text or not ("@" in text or _DIGIT.search(text)):
        return text, []
    found: list[tuple[int, int, str, str]] = []
    taken = bytearray(len(text))
    for kind, (pattern, replace) in _PATTERNS.items():
        if kind == "mail" and "@" not in text:
            continue
        at = 0
        while hit := pattern.search(text, at):
            start = hit.start()
            if kind == "mail":
                start, at = _local(text, start, at), start + 1
                if start is None:
                    continue
                whole = text[start : hit.end()]
            else:
                at, whole = start + 1, hit[0]
            for length in _shorter(kind, whole):
                end = start + length
                if any(taken[start:end]):
                    continue
                new = replace(text[start:end], key, back)
                if new is not None:
                    taken[start:end] = b"\x01" * length
                    found.append((start, end, kind, new))
                    at = end
                    break
    found.sort()
    parts, at = [], 0
    for start, end, _, new in found:
        parts += [text[at:start], new]
        at = end
    return "".join([*parts, text[at:]]), [(kind, start, end) for start, end, kind, _ in found]


def replaced(text: Column, key: bytes, back: bool = False) -> Column:
    """A struct of `text`, the pseudonymised text, and `found`, an array of kind, start and end."""

    @F.pandas_udf("text string, found array<struct<kind:string,start:int,end:int>>")
    def compute(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            rows = [pseudonymised(one, key, back) for one in texts]
            spans = [[{"kind": k, "start": s, "end": e} for k, s, e in found] for _, found in rows]
            yield pd.DataFrame({"text": [row[0] for row in rows], "found": spans})

    return compute(text)


def pseudonyms(docs: DataFrame, key: bytes) -> DataFrame:
    """doc_id, the pseudonymised text and what was found, one row per row of `docs`.

    Reads `doc_id` and `text`; other columns may have any name. A missing text
    stays missing, an empty one empty, and nothing is found in them. Repeated
    rows are treated alike. An empty table gives an empty result.
    """
    made = docs.select(F.col("doc_id").cast("long").alias("doc_id"), replaced(F.col("text"), key).alias("new"))
    return made.select(
        "doc_id",
        "new.text",
        F.size("new.found").alias("n_found"),
        "new.found",
    )
