"""Format-preserving pseudonyms for personal data, by keyed Feistel permutations.

Values are found by pattern, validated (Luhn sum, calendar, octets, ISO 7064), and replaced by another
valid value of the same format: separators, letter case, country and issuer digits and check rules stay, and
lengths too but for two kinds: a day or month of one digit is written with two, and an octet with as many
digits as it needs. A value is a list of digits or letters, each below its radix; a Feistel network over the
two halves of the list, with keyed BLAKE2 as its round function, permutes all lists of the same kind
and radices. Where only some lists are valid the permutation is repeated until the result is. So equal
values get equal pseudonyms in every document, however they are punctuated, different values never
share one, and who holds the key can go back (``reveal``). Where numbers stand beside each other a
pseudonym can make another cut of them valid; ``reveal`` is sure there when it is given the values.

Results in special cases: null texts stay null and have no values; texts without values come back
unchanged; of valid values that overlap, the first by position, then by the order of ``KINDS``, then the longest counts;
digits of other scripts count as the ASCII ones and keep their script;
rows are handled alone, so ties and repeated rows do not matter; an empty table gives no row. Texts are
searched whole, from every start; a card number may end at any end of a group of digits and an account
number where its country says or at any end of a word, whatever stands beside it. Candidates that do
not pass validation at any length (a card number with a wrong sum, 31 February) are left as they are.
Dates with slashes are read month first, and day first where the month would be above 12; days up to 12 stay
so, hence a pseudonym is read the way its value was. Dates of 1900 to 2099 stay in these years, earlier and
later ones stay earlier and later. Phone numbers are found in the North American form, in the
forms of France, Germany and Spain, and in any country's with ``+``; the country and the first digit after it
stay, and a number is linked to itself with and without its country. Of a number with ``+`` further groups of
digits right behind it count as its end, up to 15 digits. Four numbers after ``version`` or ``release`` are no address.
"""

from __future__ import annotations

import datetime
import hashlib
import re
import unicodedata
from bisect import bisect_right
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass, replace
from heapq import heappop, heappush
from math import isqrt, prod

import pyarrow as pa
from pyspark.sql import DataFrame

ROUNDS = 10
FIRST_DAY = datetime.date(1900, 1, 1)
#: Pseudonyms of dates stay between the same two of these days; the last one is past the end of the calendar.
ERAS = [d.toordinal() for d in (datetime.date.min, datetime.date(1000, 1, 1), FIRST_DAY, datetime.date(2100, 1, 1))]
ERAS.append(datetime.date.max.toordinal() + 1)
MAX_WALK = 10_000
SECRET_PIECE = 200
#: Lengths of account numbers by country, as the registry of ISO 13616 lists them.
IBAN_LENGTHS = {
    country: length
    for length, countries in {
        15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK",
        21: "CH HR LI LV", 22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL",
        24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "LY PT ST", 26: "IS TR", 27: "BI DJ FR GR IT MC MR SM",
        28: "AL AZ BY CY DO GT HU LB NI PL SV", 29: "BR EG PS QA UA", 30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU",
    }.items()
    for country in countries.split()
}
_IBAN_SPAN = re.compile(r"[A-Z]{2}\d{2}(?: ?[A-Z0-9]){11,30}")


class Feistel:
    """Keyed permutations of digit lists with mixed radices."""

    def __init__(self, key: bytes):
        if not 1 <= len(key) <= 64:
            raise ValueError("the key must have 1 to 64 bytes")
        self.key = key

    def _round(self, tweak: bytes, turn: int, value: int, below: int) -> int:
        size = (below.bit_length() + 7) // 8 + 16
        text = tweak + bytes([turn]) + value.to_bytes((value.bit_length() + 7) // 8 or 1, "big")
        out = b"".join(
            hashlib.blake2b(text + bytes([i]), key=self.key).digest() for i in range(-(-size // 64))
        )
        return int.from_bytes(out[:size], "big") % below

    def permute(self, values: Sequence[int], radices: Sequence[int], tweak: bytes, back: bool = False) -> list[int]:
        half = len(values) // 2
        sides = [_number(values[:half], radices[:half]), _number(values[half:], radices[half:])]
        sizes = [prod(radices[:half]), prod(radices[half:])]
        tweak = tweak + repr(list(radices)).encode()
        for turn in reversed(range(ROUNDS)) if back else range(ROUNDS):
            side = turn % 2
            step = self._round(tweak, turn, sides[1 - side], sizes[side])
            sides[side] = (sides[side] - step if back else sides[side] + step) % sizes[side]
        return _list(sides[0], radices[:half]) + _list(sides[1], radices[half:])


def _number(values: Sequence[int], radices: Sequence[int]) -> int:
    number = 0
    for v, r in zip(values, radices, strict=True):
        number = number * r + v
    return number


def _list(number: int, radices: Sequence[int]) -> list[int]:
    out = []
    for r in reversed(radices):
        number, v = divmod(number, r)
        out.append(v)
    return out[::-1]


def luhn_digit(digits: Sequence[int]) -> int:
    """The check digit that ends a card number."""
    total = sum(d if i % 2 else (2 * d - 9 if d > 4 else 2 * d) for i, d in enumerate(reversed(digits)))
    return -total % 10


def iban_check(country: str, rest: str) -> str:
    """The two check digits of an account number."""
    digits = "".join(str(int(c, 36)) for c in f"{rest}{country}00".upper())
    return f"{98 - int(digits) % 97:02d}"


@dataclass(frozen=True)
class Kind:
    """How values of a kind are found and replaced; ``swap`` gives None for what is not valid.

    ``ends`` lists where a value that starts at a match may end, the likeliest first; else it ends with the match.
    """

    name: str
    pattern: str
    swap: Callable[[Feistel, str, bool], str | None]
    ends: Callable[[str, int], list[int]] | None = None


def _digits(text: str) -> list[int]:
    return [int(c) for c in text if c in "0123456789"]


def _refill(text: str, digits: Sequence[int]) -> str:
    """The digits of a text replaced one by one."""
    fresh = iter(digits)
    return "".join(str(next(fresh)) if c in "0123456789" else c for c in text)


def _walk(step: Callable[[list[int]], list[int]], values: list[int], valid: Callable[[list[int]], bool]) -> list[int]:
    """Repeat a permutation until it gives a valid list again; from a valid one it always does."""
    for _ in range(MAX_WALK):
        values = step(values)
        if valid(values):
            return values
    raise RuntimeError("no valid value found")


def card_ends(text: str, start: int) -> list[int]:
    """Ends of groups of digits, 13 to 19 digits away, the farthest first."""
    end = re.compile(r"\d(?:[ -]?\d){12,18}").match(text, start).end()
    ends, n = [], 0
    for at in range(start, end):
        n += text[at].isdigit()
        if n >= 13 and text[at].isdigit() and not text[at + 1 : at + 2].isdigit():
            ends.append(at + 1)
    return ends[::-1]


def iban_ends(text: str, start: int) -> list[int]:
    """The end by the country's length, then ends of words, the farthest first."""
    end = _IBAN_SPAN.match(text, start).end()
    own, ends, n = [], [], 0
    for at in range(start, end):
        n += text[at] != " "
        if text[at] != " " and n == IBAN_LENGTHS.get(text[start : start + 2]):
            own = [at + 1]
        if text[at] != " " and n >= 15 and not text[at + 1 : at + 2].isalnum():
            ends.append(at + 1)
    return own + ends[::-1]


def swap_card(feistel: Feistel, text: str, back: bool) -> str | None:
    digits = _digits(text)
    if not 13 <= len(digits) <= 19 or luhn_digit(digits[:-1]) != digits[-1] or not any(digits):
        return None
    inner = digits[1:-1]
    fresh = [digits[0], *feistel.permute(inner, [10] * len(inner), b"card%d" % digits[0], back)]
    return _refill(text, [*fresh, luhn_digit(fresh)])


def swap_phone(feistel: Feistel, text: str, back: bool) -> str | None:
    digits = _digits(text)
    head, rest = digits[:-10], digits[-10:]
    return _refill(text, [*head, *feistel.permute(rest, [10] * 10, b"phone", back)])


def _swap_rest(feistel: Feistel, text: str, digits: list[int], kept: int, tweak: bytes, back: bool) -> str:
    rest = digits[kept:]
    return _refill(text, [*digits[:kept], *feistel.permute(rest, [10] * len(rest), tweak, back)])


def swap_national(country: int, trunk: int) -> Callable[[Feistel, str, bool], str]:
    """Numbers as they are written in their country: behind ``trunk`` digits the first digit stays."""

    def swap(feistel: Feistel, text: str, back: bool) -> str:
        digits = _digits(text)
        return _swap_rest(feistel, text, digits, trunk + 1, b"phone %d %d" % (country, digits[trunk]), back)

    return swap


def swap_abroad(feistel: Feistel, text: str, back: bool) -> str | None:
    digits = _digits(text)
    if digits[0] == 1 and len(digits) == 11:
        return swap_phone(feistel, text, back)
    kept = 3 if digits[:2] in ([3, 3], [3, 4], [4, 9]) else 2
    return _swap_rest(feistel, text, digits, kept, b"phone %d%d %d" % (*digits[:2], digits[2] if kept == 3 else 0), back)


def swap_social(feistel: Feistel, text: str, back: bool) -> str | None:
    def valid(d: list[int]) -> bool:
        area = d[0] * 100 + d[1] * 10 + d[2]
        return area not in (0, 666) and area < 900 and d[3:5] != [0, 0] and d[5:] != [0, 0, 0, 0]

    digits = _digits(text)
    if not valid(digits):
        return None
    return _refill(text, _walk(lambda d: feistel.permute(d, [10] * 9, b"social", back), digits, valid))


def swap_ip(feistel: Feistel, text: str, back: bool) -> str | None:
    octets = [int(x) for x in text.split(".")]
    if max(octets) > 255:
        return None
    return ".".join(map(str, feistel.permute(octets, [256] * 4, b"ip", back)))


def swap_date(feistel: Feistel, text: str, back: bool) -> str | None:
    parts = re.split(r"[-./]", text)
    order = "ymd" if len(parts[0]) == 4 else "dmy" if "." in text or int(parts[0]) > 12 else "mdy"
    at = {k: order.index(k) for k in "ymd"}
    try:
        given = datetime.date(*(int(parts[at[k]]) for k in "ymd"))
    except ValueError:
        return None

    era = bisect_right(ERAS, given.toordinal()) - 1
    first, days = ERAS[era], ERAS[era + 1] - ERAS[era]
    radices = [isqrt(days) + 1] * 2  # two numbers that make one a little above the days of the era

    def alike(d: list[int]) -> bool:
        n = _number(d, radices)
        return n < days and (datetime.date.fromordinal(first + n).day > 12) == (given.day > 12)

    def step(d: list[int]) -> list[int]:
        return feistel.permute(d, radices, b"date %d" % era, back)

    date = datetime.date.fromordinal(first + _number(_walk(step, _list(given.toordinal() - first, radices), alike), radices))
    values = {"y": f"{date.year:04d}", "m": f"{date.month:02d}", "d": f"{date.day:02d}"}
    separators = re.findall(r"[-./]", text)
    return values[order[0]] + separators[0] + values[order[1]] + separators[1] + values[order[2]]


def swap_iban(feistel: Feistel, text: str, back: bool) -> str | None:
    solid = text.replace(" ", "")
    country, check, rest = solid[:2], solid[2:4], solid[4:]
    if not 11 <= len(rest) <= 30 or iban_check(country, rest) != check:
        return None
    letters = re.sub(r"\d", "0", rest)
    digits = _digits(rest)
    rest = _refill(rest, feistel.permute(digits, [10] * len(digits), b"iban" + country.encode() + letters.encode(), back))
    fresh = iter(country + iban_check(country, rest) + rest)
    return "".join(c if c == " " else next(fresh) for c in text)


def _swap_word(feistel: Feistel, word: str, tweak: bytes, back: bool) -> str:
    """Digits stay digits and ASCII letters stay letters of their case; all else stays."""
    places = [i for i, c in enumerate(word) if c.isascii() and c.isalnum()]
    if not places:
        return word
    radices = [10 if word[i].isdigit() else 26 for i in places]
    values = [int(word[i]) if word[i].isdigit() else ord(word[i].lower()) - 97 for i in places]
    kept = "".join("" if c.isascii() and c.isalnum() else c for c in word)
    fresh, out = feistel.permute(values, radices, tweak + kept.encode(), back), list(word)
    for i, v, r in zip(places, fresh, radices, strict=True):
        c = str(v) if r == 10 else chr(97 + v)
        out[i] = c.upper() if word[i].isupper() else c
    return "".join(out)


def swap_email(feistel: Feistel, text: str, back: bool) -> str | None:
    name, _, domain = text.rpartition("@")
    return f"{_swap_word(feistel, name, b'email' + domain.lower().encode(), back)}@{domain}"


def swap_key(feistel: Feistel, text: str, back: bool) -> str | None:
    return text[:4] + _swap_word(feistel, text[4:], b"key", back)


def _swap_pieces(feistel: Feistel, word: str, tweak: bytes, back: bool) -> str:
    """Long secrets are permuted in pieces, each under a tweak of its own, so that the work stays linear."""
    pieces = range(0, len(word), SECRET_PIECE)
    return "".join(
        _swap_word(feistel, word[at : at + SECRET_PIECE], tweak + (b"%d" % at if at else b""), back) for at in pieces
    )


def _is_hex(word: str) -> bool:
    return re.fullmatch(r"[0-9a-f]{8,}", word) is not None


def _swap_hex(feistel: Feistel, word: str, back: bool) -> str:
    """Letters and digits of a secret; hexadecimal ones stay hexadecimal, and others of one piece stay others."""
    if not _is_hex(word):
        for _ in range(MAX_WALK):
            word = _swap_pieces(feistel, word, b"secret", back)
            if len(word) > SECRET_PIECE or not _is_hex(word):
                return word
        raise RuntimeError("no valid value found")
    out = []
    for at in range(0, len(word), SECRET_PIECE):
        values = [int(c, 16) for c in word[at : at + SECRET_PIECE]]
        tweak = b"hex" + (b"%d" % at if at else b"")
        out += ["0123456789abcdef"[v] for v in feistel.permute(values, [16] * len(values), tweak, back)]
    return "".join(out)


def swap_secret(feistel: Feistel, text: str, back: bool) -> str | None:
    head = re.match(r"(?is)\w+\s*[=:]\s*[\"']?", text).group(0)
    return head + _swap_hex(feistel, text[len(head) :], back)


def swap_token(feistel: Feistel, text: str, back: bool) -> str | None:
    head = re.match(r"github_pat_|\w+?[_-]", text).group(0)
    return head + _swap_pieces(feistel, text[len(head) :], b"token " + head.encode(), back)


def swap_private_key(feistel: Feistel, text: str, back: bool) -> str | None:
    head = re.match(r"-----BEGIN [A-Z ]*-----", text).group(0)
    return head + _swap_pieces(feistel, text[len(head) :], b"private key", back)


#: What tokens begin with that name their issuer.
TOKEN_HEADS = ("ghp_", "gho_", "ghu_", "ghs_", "ghr_", "github_pat_", "sk-", "xoxb-", "xoxp-", "xoxa-", "glpat-")
_NO_DIGIT_BEFORE, _NO_DIGIT_AFTER = r"(?<![\w.+/(-])(?<!\d[ ./-])", r"(?![ ./-]?\d)"

KINDS = (
    Kind("email", r"[\w.+-]{1,64}@[A-Za-z0-9-]{1,63}(?:\.[A-Za-z0-9-]{1,63})*\.[A-Za-z]{2,24}", swap_email),
    Kind("key", r"\bAKIA[A-Z0-9]{16}\b", swap_key),
    Kind("token", rf"(?<![\w-])(?:{'|'.join(TOKEN_HEADS)})(?=[A-Za-z_-]*\d)[A-Za-z0-9_-]{{16,}}", swap_token),
    Kind("private_key", r"-----BEGIN (?:[A-Z]{1,10} ){0,3}PRIVATE KEY-----(?:\s*+[A-Za-z0-9+/=]{16,}+)++(?:\s*[A-Za-z0-9+/=]+(?=\s*-----END))?", swap_private_key),
    Kind("secret", r"(?i:\b(?:password|passwd|token|secret|api_?key)\s{0,3}[=:]\s{0,3}[\"']?(?:[\w/+-]{8,}|(?=[A-Za-z_/+-]*[0-9])[\w/+-]{4,}))", swap_secret),
    Kind("iban", r"(?<![A-Za-z0-9])[A-Z]{2}\d{2}(?: ?[A-Z0-9]){11}", swap_iban, iban_ends),
    Kind("ip", r"(?<![\d.])(?<![vV])(?<![vV]ersion )(?<![rR]elease )(?:\d{1,3}\.){3}\d{1,3}(?!\.?\d)", swap_ip),
    Kind("date", r"(?<!\d)(?:\d{4}-\d{2}-\d{2}|\d{1,2}\.\d{1,2}\.\d{4}|\d{1,2}/\d{1,2}/\d{4})(?!\d)", swap_date),
    Kind("social", r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])", swap_social),
    Kind("phone", r"(?<![\w(+])(?:\+?1[ .-]?)?(?:\(\d{3}\) ?|\d{3}[ .-])\d{3}[ .-]\d{4}(?![\d-])", swap_phone),
    Kind("phone_abroad", r"(?<![\w+])\+[1-9](?:[ ./-]?[()]?[ ]?\d){7,14}(?!\d)", swap_abroad),
    Kind("phone_fr", rf"{_NO_DIGIT_BEFORE}0[1-9](?:[ .-]\d{{2}}){{4}}{_NO_DIGIT_AFTER}", swap_national(33, 1)),
    Kind("phone_de", rf"{_NO_DIGIT_BEFORE}0[1-9]\d{{1,3}}[ /-]\d{{4,8}}{_NO_DIGIT_AFTER}", swap_national(49, 1)),
    Kind("phone_es", rf"{_NO_DIGIT_BEFORE}[679]\d{{2}}(?: \d{{3}} \d{{3}}|(?: \d{{2}}){{3}}){_NO_DIGIT_AFTER}", swap_national(34, 0)),
    Kind("card", r"(?<!\d)\d(?:[ -]?\d){12}", swap_card, card_ends),
)
#: Digits of any script, and those that are not ASCII; a text is searched with ASCII digits in their places.
_DIGIT, _FOREIGN = re.compile(r"\d"), re.compile(r"[^\D0-9]")
_FOUND = {kind: re.compile(kind.pattern) for kind in KINDS}
_NUMBER = re.compile(r"\d[\d ().+/-]{5,}\d")


def _kinds_in(text: str) -> Iterator[tuple[int, Kind]]:
    """The kinds a text may have, told by marks that each of their values has; it saves most searches."""
    number = _NUMBER.search(text) is not None
    may = {"email": "@" in text, "key": "AKIA" in text, "token": any(head in text for head in TOKEN_HEADS)}
    may |= {"private_key": "PRIVATE KEY-----" in text, "secret": "=" in text or ":" in text, "iban": True}
    return ((rank, kind) for rank, kind in enumerate(KINDS) if may.get(kind.name, number))


@dataclass(frozen=True)
class Value:
    """A value found in a text: kind, place, and what it was replaced by."""

    kind: str
    start: int
    end: int
    pseudonym: str


def plain_digits(text: str) -> str:
    """The text with ASCII digits in the place of those of other scripts, each in its place."""
    return text if text.isascii() else _FOREIGN.sub(lambda m: str(unicodedata.decimal(m.group(0))), text)


def in_script(fresh: str, value: str) -> str:
    """A pseudonym with the digits of the value it stands for: place by place, else in the script of its first digit."""
    zeros = [ord(c) - unicodedata.decimal(c) if _DIGIT.match(c) else None for c in value]
    if [z is not None for z in zeros] != [c in "0123456789" for c in fresh]:
        zeros = [next(z for z in zeros if z is not None)] * len(fresh)
    return "".join(chr(z + int(c)) if c in "0123456789" else c for c, z in zip(fresh, zeros, strict=True))


def pseudonymise(text: str, feistel: Feistel, *, back: bool = False) -> tuple[str, list[Value]]:
    """The text with all valid values replaced, and the values with their places in the original text."""
    given, text = text, plain_digits(text)
    fresh, values = _pseudonymise(text, feistel, back)
    if given == text:
        return fresh, values
    out, upto = [], 0
    for at, v in enumerate(values):
        value = given[v.start : v.end]
        if _FOREIGN.search(value):
            values[at] = v = replace(v, pseudonym=in_script(v.pseudonym, value))
        out += [given[upto : v.start], v.pseudonym]
        upto = v.end
    return "".join([*out, given[upto:]]), values


def _pseudonymise(text: str, feistel: Feistel, back: bool) -> tuple[str, list[Value]]:
    out, values, upto = [], [], 0
    heads = []  # the next match of each kind
    for rank, kind in _kinds_in(text):
        if m := _FOUND[kind].search(text):
            heappush(heads, (m.start(), rank, m.end()))
    while heads:
        start, rank, end = heappop(heads)
        kind, after = KINDS[rank], upto
        if start >= upto:
            after = start + 1
            for end in kind.ends(text, start) if kind.ends else [end]:
                fresh = kind.swap(feistel, text[start:end], back)
                if fresh is not None:
                    out += [text[upto:start], fresh]
                    values.append(Value(kind.name, start, end, fresh))
                    upto = after = end
                    break
        if m := _FOUND[kind].search(text, after):
            heappush(heads, (m.start(), rank, m.end()))
    return "".join([*out, text[upto:]]), values


def reveal(text: str, feistel: Feistel, values: Sequence[Value] | None = None) -> str:
    """The text before ``pseudonymise``, for who holds the key; ``values`` are those it gave."""
    if values is None:
        return pseudonymise(text, feistel, back=True)[0]
    swaps = {kind.name: kind.swap for kind in KINDS}
    out, upto, shift = [], 0, 0
    for v in values:
        start = v.start + shift
        value = swaps[v.kind](feistel, plain_digits(v.pseudonym), True)
        out += [text[upto:start], in_script(value, v.pseudonym) if _FOREIGN.search(v.pseudonym) else value]
        upto = start + len(v.pseudonym)
        shift += len(v.pseudonym) - (v.end - v.start)
    return "".join([*out, text[upto:]])


def hide(docs: DataFrame, key: bytes) -> DataFrame:
    """``(doc_id, text, values)`` with pseudonyms in the place of personal data, a row per row.

    ``values`` lists kind, place in the original text and pseudonym of each value, by position.
    """
    names = ["doc_id", "text", "values"]
    kind = docs.schema["doc_id"].dataType.simpleString()
    shape = pa.list_(
        pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("pseudonym", pa.string())])
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        feistel = Feistel(key)
        for batch in batches:
            for start in range(0, batch.num_rows, 512):
                part = batch.slice(start, 512)
                done = [(None, []) if t is None else pseudonymise(t, feistel) for t in part.column("text").to_pylist()]
                lists = [[vars(v) for v in values] for _, values in done]
                cols = [part.column("doc_id"), pa.array([t for t, _ in done], pa.string()), pa.array(lists, shape)]
                yield pa.RecordBatch.from_arrays(cols, names=names)

    schema = f"doc_id {kind}, text string, values array<struct<kind string, start int, end int, pseudonym string>>"
    return docs.select("doc_id", "text").mapInArrow(run, schema)
