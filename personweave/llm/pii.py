"""Personal data: validated numbers and dates are replaced by keyed pseudonyms of the same format.

A value is ranked among all valid values of its format; the rank is permuted by a Feistel network under the key and the
result is written in the same format, check digits included. Equal values get equal pseudonyms in every document, however
they are punctuated, and whoever holds the key can undo it. The permutation has no fixed point: it is F^-1(F(x) + 1) for
a Feistel permutation F.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator
from datetime import date, timedelta
from functools import lru_cache
from math import isqrt

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROUNDS = 8
FIRST_DAY, LAST_DAY = date(1900, 1, 1), date(2099, 12, 31)
# English month names.
MONTHS = ("January", "February", "March", "April", "May", "June", "July", "August", "September", "October", "November",
          "December")
# IBAN lengths of the registry's countries.
IBAN_LENGTHS = {x[:2]: int(x[2:]) for x in (
    "AD24 AE23 AL28 AT20 AZ28 BA20 BE16 BG22 BH22 BI27 BR29 BY28 CH21 CR22 CY28 CZ24 DE22 DJ27 DK18 DO28 EE20 EG29 ES24 FI18 FK18 "
    "FO18 FR27 GB22 GE22 GI23 GL18 GR27 GT28 HN28 HR21 HU28 IE22 IL23 IQ23 IS26 IT27 JO30 KW30 KZ20 LB28 LC32 LI21 LT20 LU20 LV21 "
    "LY25 MC27 MD24 ME22 MK19 MN20 MR27 MT31 MU30 NI28 NL18 NO15 OM23 PK24 PL28 PS29 PT25 QA29 RO24 RS22 RU33 SA24 SC31 SD18 SE24 "
    "SI19 SK24 SM27 SO23 ST25 SV28 TL23 TN24 TR26 UA29 VA22 VG24 XK20 YE30").split()}
# Values further apart than this do not change how each other is read.
NEAR = 64


class Feistel:
    """A keyed permutation of 0 .. size - 1: unbalanced halves modulo a and b, cycle walking above `size`."""

    def __init__(self, key: bytes, tweak: str, size: int):
        self.size = size
        self.a = isqrt(max(size - 1, 0)) + 1
        self.b = -(-size // self.a)
        self.key = hashlib.blake2b(f"{tweak}/{size}".encode(), key=key[:64], digest_size=32).digest()

    def _round(self, number: int, half: int) -> int:
        data = number.to_bytes(1, "big") + half.to_bytes(32, "big")
        return int.from_bytes(hashlib.blake2b(data, key=self.key, digest_size=40).digest(), "big")

    def _forward(self, x: int) -> int:
        left, right = divmod(x, self.b)
        for i in range(0, ROUNDS, 2):
            left = (left + self._round(i, right)) % self.a
            right = (right + self._round(i + 1, left)) % self.b
        return left * self.b + right

    def _back(self, x: int) -> int:
        left, right = divmod(x, self.b)
        for i in range(ROUNDS - 2, -1, -2):
            right = (right - self._round(i + 1, left)) % self.b
            left = (left - self._round(i, right)) % self.a
        return left * self.b + right

    def _walk(self, step: Callable[[int], int], x: int) -> int:
        x = step(x)
        while x >= self.size:
            x = step(x)
        return x

    def shift(self, x: int, by: int) -> int:
        """F^-1(F(x) + by); `by` of 1 and -1 are inverse to each other."""
        return x if self.size < 2 else self._walk(self._back, (self._walk(self._forward, x) + by) % self.size)


def luhn_digit(digits: str) -> str:
    """The check digit that completes `digits`."""
    odd = [sum(divmod(2 * int(d), 10)) for d in digits[::-2]]
    return str(-(sum(odd) + sum(map(int, digits[-2::-2]))) % 10)


def iban_check(country: str, rest: str) -> str:
    return f"{98 - int(''.join(str(int(c, 36)) for c in rest + country + '00')) % 97:02d}"


def _refill(template: str, chars: str) -> str:
    """`template` with its letters and digits replaced by `chars`, in order."""
    fill = iter(chars)
    return "".join(next(fill) if c.isalnum() else c for c in template)


def _classes(chars: str) -> list[tuple[int, str]]:
    return [(26, "a") if "a" <= c <= "z" else (26, "A") if "A" <= c <= "Z" else (10, "0") for c in chars]


def _ranked(chars: str) -> tuple[int, int]:
    rank, size = 0, 1
    for c, (radix, low) in zip(chars, _classes(chars)):
        rank, size = rank * radix + ord(c) - ord(low), size * radix
    return rank, size


def _unranked(rank: int, like: str) -> str:
    out = []
    for radix, low in reversed(_classes(like)):
        rank, digit = divmod(rank, radix)
        out.append(chr(ord(low) + digit))
    return "".join(reversed(out))


class Pseudonyms:
    """Replaces the values of a text. `by` = 1 hides, `by` = -1 restores."""

    def __init__(self, key: bytes, by: int = 1):
        self.key, self.by = key, by
        self.permutation = lru_cache(4096)(lambda tweak, size: Feistel(key, tweak, size))
        self.known = lru_cache(100_000)(lambda kind, value: getattr(self, f"_{kind}")(value))

    def _moved(self, tweak: str, rank: int, size: int, fits: Callable[[int], bool] = lambda _: True) -> int:
        """The next rank that fits; the shift is one cycle through all ranks, so this permutes those that fit."""
        rank = self.permutation(tweak, size).shift(rank, self.by)
        while not fits(rank):
            rank = self.permutation(tweak, size).shift(rank, self.by)
        return rank

    def _letters(self, tweak: str, chars: str, fits: Callable[[str], bool] = lambda _: True) -> str:
        rank, size = _ranked(chars)
        tweak += "".join(low for _, low in _classes(chars))
        return _unranked(self._moved(tweak, rank, size, lambda x: fits(_unranked(x, chars))), chars)

    def _card(self, value: str) -> str | None:
        digits = re.sub(r"\D", "", value)
        if not 13 <= len(digits) <= 19 or luhn_digit(digits[:-1]) != digits[-1]:
            return None
        body = digits[0] + self._letters("card" + digits[0], digits[1:-1])
        return _refill(value, body + luhn_digit(body))

    def _iban(self, value: str) -> str | None:
        chars = re.sub(r"[^A-Z0-9]", "", value)
        country, check, rest = chars[:2], chars[2:4], chars[4:]
        if not 15 <= len(chars) <= 34 or iban_check(country, rest) != check:
            return None
        body = self._letters("iban" + country, rest)
        return _refill(value, country + iban_check(country, body) + body)

    def _ssn(self, value: str) -> str | None:
        area, group, serial = map(int, (value[:3], value[4:6], value[7:]))
        if area in (0, 666) or area >= 900 or not group or not serial:
            return None
        rank = ((area - 1 - (area > 666)) * 99 + group - 1) * 9999 + serial - 1
        rest, serial = divmod(self._moved("ssn", rank, 898 * 99 * 9999), 9999)
        area, group = divmod(rest, 99)
        return f"{area + 1 + (area >= 665):03d}{value[3]}{group + 1:02d}{value[6]}{serial + 1:04d}"

    def _phone(self, value: str) -> str | None:
        """North American numbers: area and exchange start with 2 to 9, the reserved exchange 555 stays. With the country
        code, parentheses, hyphens or dots any digits count; those that no area or exchange begins with are permuted among
        themselves. Groups of digits that are parted by spaces alone must be a valid number."""
        digits = re.sub(r"\D", "", value)
        lead, digits = digits[:-10], digits[-10:]
        if lead not in ("", "1"):
            return None
        if digits[0] in "01" or digits[3] in "01":
            if not lead and not re.search(r"[(.-]", value):
                return None
            if digits[3:6] == "555":
                area, line = divmod(self._moved("phone555low", int(digits[:3] + digits[6:]), 200 * 10_000), 10_000)
                return _refill(value, f"{lead}{area:03d}555{line:04d}")
            return _refill(value, lead + self._letters(
                "phonelow", digits, lambda x: (x[0] in "01" or x[3] in "01") and x[3:6] != "555"))
        area, exchange, line = int(digits[:3]) - 200, int(digits[3:6]) - 200, int(digits[6:])
        if exchange == 355:
            area, line = divmod(self._moved("phone555", area * 10_000 + line, 800 * 10_000), 10_000)
        else:
            exchange -= exchange > 355
            rest, line = divmod(self._moved("phone", (area * 799 + exchange) * 10_000 + line, 800 * 799 * 10_000), 10_000)
            area, exchange = divmod(rest, 799)
            exchange += exchange >= 355
        return _refill(value, lead + f"{area + 200:03d}{exchange + 200:03d}{line:04d}")

    def _world(self, value: str) -> str | None:
        """Numbers with a foreign country code of up to three digits: 8 to 15 digits; the first three stay."""
        digits = re.sub(r"\D", "", value)
        return _refill(value, digits[:3] + self._letters("world" + digits[:3], digits[3:])) if 8 <= len(digits) <= 15 else None

    def _ip(self, value: str) -> str | None:
        """Dotted quads from 1.0.0.0 to 255.255.255.255."""
        parts = [int(x) for x in value.split(".")]
        if not parts[0] or max(parts) > 255:
            return None
        moved = self._moved("ip", int.from_bytes(bytes(parts), "big") - (1 << 24), 255 << 24) + (1 << 24)
        return ".".join(map(str, moved.to_bytes(4, "big")))

    def _day(self, day: int, month: int, year: int, tweak: str = "date", fits: Callable[[date], bool] = lambda _: True) -> date | None:
        try:
            then = date(year, month, day)
        except ValueError:
            return None
        if not FIRST_DAY <= then <= LAST_DAY:
            return None
        size = (LAST_DAY - FIRST_DAY).days + 1
        moved = self._moved(tweak, (then - FIRST_DAY).days, size, lambda x: fits(FIRST_DAY + timedelta(x)))
        return FIRST_DAY + timedelta(moved)

    def _iso(self, value: str) -> str | None:
        to = self._day(int(value[8:]), int(value[5:7]), int(value[:4]))
        return to and f"{to.year}{value[4]}{to.month:02d}{value[7]}{to.day:02d}"

    def _numeric(self, value: str) -> str | None:
        """Day and month in either order: with dots day first, else month first if that is possible. Numbers without
        leading zeros stay without; the pseudonym is read in the same order and style again."""
        one, mark, two, year = re.fullmatch(r"(\d+)([./-])(\d+)[./-](\d+)", value).groups()
        day_first = mark == "." or int(one) > 12
        day, month = (one, two) if day_first else (two, one)
        padded = "0" in (one[0], two[0]) or len(one + two) == 4

        def fits(x: date) -> bool:
            return (mark == "." or not day_first or x.day > 12) and (padded or min(x.day, x.month) < 10)

        to = self._day(int(day), int(month), int(year), "date", fits)
        if to is None:
            return None
        parts = [f"{x:0{2 if padded else 1}d}" for x in ((to.day, to.month) if day_first else (to.month, to.day))]
        return mark.join([*parts, str(to.year)])

    def _written(self, value: str) -> str | None:
        """12 March 2021, March 12, 2021 and the like; months may be cut to three letters, endings like 12th go. A day
        below ten that is written with a zero stays so."""
        name = re.search(r"[A-Za-z]{3,}", value).group()
        month = [m[:3].lower() for m in MONTHS].index(name[:3].lower()) + 1
        day, year = re.findall(r"\d+", value)
        zero = day[0] == "0"
        to = self._day(int(day), month, int(year), "date", lambda x: not zero or x.day < 10)
        if to is None:
            return None
        new = MONTHS[to.month - 1] if len(name) > 3 or name.lower() == "may" else MONTHS[to.month - 1][:3]
        parts = {name: new, day: "0" * zero + str(to.day), year: str(to.year)}
        return re.sub(r"[A-Za-z]{3,}|\d+", lambda m: parts[m.group()], re.sub(r"(?<=\d)(st|nd|rd|th)", "", value))

    def _email(self, value: str) -> str:
        local, at, domain = value.rpartition("@")
        chars = re.sub(r"[^A-Za-z0-9]", "", local)
        return _refill(local, self._letters("email", chars)) + at + domain if chars else value

    def _secret(self, value: str) -> str:
        """Keys and passwords: hexadecimal values stay hexadecimal, others don't become so."""
        chars = re.sub(r"[^A-Za-z0-9]", "", value)
        if re.fullmatch(r"[0-9a-f]+", chars):
            return _refill(value, f"{self._moved('hex', int(chars, 16), 16 ** len(chars)):0{len(chars)}x}")
        return _refill(value, self._letters("secret", chars, lambda x: not re.fullmatch("[0-9a-f]+", x))) if chars else value

    def _spans(self, kind: str, start: int, end: int, text: str) -> Iterator[tuple[int, int]]:
        """Places of the value in a match, best first. Digits or words may follow a card or an IBAN, so they may end early:
        cards by a group that is long enough alone, IBAN by the length of the country, then both by the longest."""
        if kind not in ("card", "iban"):
            yield start, end
            return
        ends = [m.end() for m in (CARD_END if kind == "card" else IBAN_END).finditer(text, start, end) if ENDS.match(text, m.end())]
        size = {x: sum(c.isalnum() for c in text[start:x]) for x in ends}
        usual = IBAN_LENGTHS.get(text[start:start + 2]) if kind == "iban" else None
        for x in sorted(ends, key=lambda x: (not (size[x] == usual if usual else text[start:x].isdigit()), -x)):
            if size[x] >= 13:
                yield start, x

    def _found(self, text: str) -> list[tuple[str, int, int]]:
        """Kind, start and end of the values of a text, in order. What fails its validation hides nothing that begins there
        or in it."""
        out, at = [], 0
        while m := VALUES.search(text, at):
            at = m.start() + 1
            for kind, pattern in PATTERNS[ORDER[m.lastgroup]:]:
                if other := pattern.match(text, m.start()):
                    span = next((x for x in self._spans(kind, *other.span(kind), text) if self.known(kind, text[slice(*x)]) is not None), None)
                    if span:
                        out.append((kind, *span))
                        at = span[1]
                        break
        return out

    def _settled(self, kind: str, value: str, before: str, after: str) -> str:
        """The next pseudonym that leaves the reading of its surroundings as it is, so that the values are found again."""
        def reading(value: str) -> list[tuple[str, int, int]]:
            own = len(before) + len(value)
            return [(k, a - (len(value) if a >= own else 0), b - (len(value) if b >= own else 0))
                    for k, a, b in self._found(before + value + after)]

        new = self.known(kind, value)
        if kind not in ("card", "iban") and not DIGIT.search(before) and not DIGIT.search(after):
            return new
        want = reading(value)
        while new != value and reading(new) != want:
            new = self.known(kind, new)
        return new

    def __call__(self, text: str | None) -> tuple[str | None, dict[str, int]]:
        """The text with pseudonyms, and how many values of each kind were replaced."""
        counts: dict[str, int] = {}
        if not text or not SIGNS.search(text):
            return text, counts
        found = self._found(text)
        for kind, _, _ in found:
            counts[kind] = counts.get(kind, 0) + 1
        # Values are hidden from the last to the first and restored from the first to the last: the surroundings of each
        # are then the same both times.
        out: list[str] = []
        if self.by > 0:
            after, end = "", len(text)
            for kind, a, b in reversed(found):
                after = (text[b:min(end, b + NEAR)] + after)[:NEAR]
                new = self._settled(kind, text[a:b], text[max(0, a - NEAR):a], after)
                out += [text[b:end], new]
                after, end = (new + after)[:NEAR], a
            return text[:end] + "".join(reversed(out)), counts
        before, start = "", 0
        for kind, a, b in found:
            before = (before + text[max(start, a - NEAR):a])[-NEAR:]
            new = self._settled(kind, text[a:b], before, text[b:b + NEAR])
            out += [text[start:a], new]
            before, start = (before + new)[-NEAR:], b
        return "".join(out) + text[start:], counts


SIGNS = re.compile(r"[0-9@=:]|AKIA", re.ASCII)
_MONTH = "(?:" + "|".join(f"{m[:3]}(?:{m[3:]})?" if m[3:] else m for m in MONTHS) + ")"
_PATTERNS = [
    r"\b(?:token|password|passwd|secret|api[_-]?key|access[_-]?key|auth)[\"']?\s{0,3}[=:]\s{0,3}[\"']?(?P<secret>(?=[^\s\"']*[0-9])[A-Za-z0-9+/_\-]{8,})",
    r"(?<![A-Za-z0-9])AKIA(?P<aws>[A-Z0-9]{16})(?![A-Za-z0-9])",
    r"(?<![\w.+-])(?P<email>[A-Za-z0-9][A-Za-z0-9._%+-]{0,63}@(?:[A-Za-z0-9-]{1,63}\.){1,8}[A-Za-z]{2,24})(?![\w-])",
    r"(?<![\w.])(?P<ip>\d{1,3}(?:\.\d{1,3}){3})(?!\.?\w)",
    r"(?<![\w/.-])(?P<iso>\d{4}(?:-\d\d-|/\d\d/|\.\d\d\.)\d\d)(?!(?![Tt]\d\d)[\w/-]|\.\d)",
    r"(?<![\w/.-])(?P<numeric>\d{1,2}(?:\.\d{1,2}\.|/\d{1,2}/|-\d{1,2}-)\d{4})(?![\w/-]|\.\d)",
    rf"(?<!\w)(?P<written>\d{{1,2}}(?:st|nd|rd|th)?\s{_MONTH}\.?,?\s\d{{4}}|{_MONTH}\.?\s\d{{1,2}}(?:st|nd|rd|th)?,?\s\d{{4}})(?!\w)",
    r"(?<![\w-])(?P<ssn>\d{3}[- ]\d\d[- ]\d{4})(?![\w-])",
    r"(?<![\w+.-])(?P<phone>(?:\+?1[ .-]?)?(?:\(\d{3}\)[ ]?|\d{3}[ .-])\d{3}[ .-]\d{4}|\+1\d{10})(?![\w-])",
    r"(?<![\w.-])(?P<world>\+(?!1\D)\d{1,3}(?:[ .-]?\(?\d{1,4}\)?){2,6})(?![\w-])",
    r"(?<!\w)(?P<iban>[A-Z]{2}\d{2}(?:[ ]?[A-Z0-9]{4}){2,7}(?:[ ]?[A-Z0-9]{1,3})?)(?!\w)",
    r"(?<![\w.-])(?P<card>\d(?:[ -]?\d){12,18})(?!\w|\.\d|-(?!\d))"]
PATTERNS = [(re.search(r"\(\?P<(\w+)>", p)[1], re.compile(p, re.ASCII)) for p in _PATTERNS]
ORDER = {kind: i for i, (kind, _) in enumerate(PATTERNS)}
VALUES = re.compile("|".join(_PATTERNS), re.ASCII)
DIGIT = re.compile(r"[0-9]")
# Groups of a card or an IBAN, and what may not follow a value that ends early.
CARD_END, IBAN_END, ENDS = re.compile(r"[0-9]+"), re.compile(r"[A-Z0-9]+"), re.compile(r"(?!\w|\.\d|-(?!\d))", re.ASCII)
Pseudonyms._aws = Pseudonyms._secret
KINDS = {"iso": "date", "numeric": "date", "written": "date", "world": "phone", "aws": "secret"}


def _columns(key: bytes, by: int, text: Column) -> Column:
    @F.arrow_udf("text string, n_values int, kinds string")
    def run(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        change = Pseudonyms(key, by)
        for part in texts:
            rows = [change(t.as_py()) for t in part]
            kinds = [",".join(sorted({KINDS.get(k, k) for k in c})) for _, c in rows]
            yield pa.StructArray.from_arrays(
                [pa.array([t for t, _ in rows], pa.string()), pa.array([sum(c.values()) for _, c in rows], pa.int32()),
                 pa.array(kinds, pa.string())], ["text", "n_values", "kinds"])
    return run(text.cast("string"))


def pseudonymise(docs: DataFrame, key: bytes, restore: bool = False, id_col: str = "doc_id", text_col: str = "text",
                 carry: bool = False) -> DataFrame:
    """`doc_id`, `text` with pseudonyms, `n_values`, `kinds` for every row of `docs`; with `carry` also `record`, all its
    columns as they were. `restore` undoes it under the same key.

    Replaced: payment cards (Luhn), IBAN (modulo 97), US social security numbers, North American and international phone
    numbers, IPv4 addresses, dates from 1900 to 2099, e-mail local parts, values assigned to password-like names and
    AKIA keys. What fails its validation stays as it is, as do digits in groups of three, three and four that only spaces
    part, if the area or exchange begins with 0 or 1. Everything else of the text stays, byte by byte.

    A null text stays null and an empty one empty, with no values. Equal values get equal pseudonyms, in repeated rows,
    too. An empty table gives an empty result. One pass without a shuffle; whole texts, however long.
    """
    record = [F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("record")] if carry else []
    return (docs.select(docs[f"`{id_col}`"].cast("long").alias("doc_id"), *record,
                        _columns(key, -1 if restore else 1, docs[f"`{text_col}`"]).alias("out"))
            .select("doc_id", *(["record"] if carry else []), "out.text", "out.n_values", "out.kinds"))
