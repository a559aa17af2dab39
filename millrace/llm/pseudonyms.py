"""Format-preserving pseudonyms for personal data.

Numbers, dates and addresses are found by pattern, validated (check digits, calendar, ranges)
and replaced by a keyed permutation of all valid values of the same format: a Feistel network
whose two halves are added to in turn, and which is walked until the result is valid again.  The
same value under the same key always gets the same pseudonym, so documents stay linked; without
the key it cannot be turned back.
"""

from __future__ import annotations

import datetime
import hashlib
import re
from collections.abc import Callable, Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame

from millrace.llm.common import narrow
from millrace.session import ship_package

ROUNDS = 10
FIRST_DAY, LAST_DAY = datetime.date(1900, 1, 1).toordinal(), datetime.date(2099, 12, 31).toordinal()

KINDS = ("email", "card", "iban", "ssn", "phone", "ip", "date")

#: In the order in which they are tried at a place.
SHAPES = {
    "email": r"""(?<![A-Za-z0-9._%+-])[A-Za-z0-9](?:[A-Za-z0-9_%+-]|\.(?=[A-Za-z0-9_%+-]))*@
        (?:[A-Za-z0-9](?:[A-Za-z0-9-]*[A-Za-z0-9])?\.)+[A-Za-z]{2,}(?![A-Za-z0-9])""",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
    "phone": r"""(?<![0-9A-Za-z])(?:
        \+1[\x20.-]?(?:\([0-9]{3}\)|[0-9]{3})[\x20.-]?[0-9]{3}[\x20.-]?[0-9]{4}
      | \+[2-9][0-9]{0,2}[\x20.-]?(?:\([0-9]{1,4}\)[\x20.-]?)?[0-9]{1,4}(?:[\x20.-][0-9]{2,4}){1,4}
      | \+[2-9][0-9]{7,14}
      | \([0-9]{3}\)[\x20.-]?[0-9]{3}[\x20.-][0-9]{4}
      | (?<![.-])[0-9]{3}(?P<between>[.-])[0-9]{3}(?P=between)[0-9]{4})(?![0-9])""",
    "ssn": r"(?<![0-9A-Za-z-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9A-Za-z]|-[0-9])",
    "date": r"(?<![0-9A-Za-z./-])(?:[0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{2}/[0-9]{2}/[0-9]{4}|[0-9]{2}\.[0-9]{2}\.[0-9]{4})(?![0-9]|[./-][0-9])",
    "ip": r"(?<![0-9A-Za-z.])[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?![0-9A-Za-z]|\.[0-9])",
    "card": r"(?<![0-9A-Za-z])[0-9]++(?![A-Za-z])(?:[\x20-][0-9]++(?![A-Za-z])){0,18}",
}
PATTERNS = {kind: re.compile(shape, re.X) for kind, shape in SHAPES.items()}
PATTERN = re.compile("|".join(f"(?P<{kind}>{shape})" for kind, shape in SHAPES.items()), re.X)
#: Kinds of several groups, of which the last ones may belong to what follows.
PARTED = {"iban": re.compile(" "), "phone": re.compile("[ .-]"), "card": re.compile("[ -]")}
#: How cards are written; other groupings are taken for one only where nothing else is found in them.
USUAL = re.compile(r"[0-9]+|[0-9]{4}([ -])[0-9]{4}\1[0-9]{4}\1[0-9]{1,4}(?:\1[0-9]{1,3})?|[0-9]{4}([ -])[0-9]{6}\2[0-9]{4,5}")
GROUP = re.compile("[0-9A-Za-z]+")
#: The first word of every match holds a digit or an @, so search starts at the words that do.
HINT = re.compile(r"[0-9@]")
SPACE = re.compile(r"\s")
#: More than the longest match beyond its first word, in characters.  A card run of any length is searched from
#: each of its groups anew, and a card of 19 digits takes 37 characters, so the window bounds work, not finds.
REACH = 64


class Permutation:
    """Keyed permutations of whole numbers below any size."""

    def __init__(self, key: str) -> None:
        self.key = hashlib.sha256(key.encode()).digest()
        self.below = lru_cache(maxsize=1 << 16)(self._below)

    def _noise(self, purpose: str, step: int, half: int) -> int:
        message = f"{purpose}\0{step}\0{half}".encode()
        return int.from_bytes(hashlib.blake2b(message, key=self.key, digest_size=32).digest(), "big")

    def _below(self, value: int, size: int, purpose: str) -> int:
        """Feistel rounds over (a, b) with value = a * width + b: either half moves by a keyed
        function of the other, which can always be undone.  ``size`` is rounded up to whole rows
        of ``width``; a result beyond it is permuted again until it is below."""
        width = max(int(size ** 0.5), 1)
        height = -(-size // width)
        purpose = f"{purpose}\0{size}"
        while True:
            a, b = divmod(value, width)
            for step in range(ROUNDS):
                if step % 2 == 0:
                    a = (a + self._noise(purpose, step, b)) % height
                else:
                    b = (b + self._noise(purpose, step, a)) % width
            value = a * width + b
            if value < size:
                return value


def luhn_digit(digits: str) -> str:
    """The check digit to append."""
    doubled = sum(sum(divmod(2 * int(d), 10)) for d in digits[::-2])
    return str(-(doubled + sum(map(int, digits[-2::-2]))) % 10)


def _put(text: str, values: str, at: re.Pattern = re.compile("[0-9]")) -> str:
    """``text`` with what ``at`` matches, character by character, replaced by ``values``."""
    source = iter(values)
    return at.sub(lambda _: next(source), text)


def _digits(text: str) -> str:
    return re.sub(r"[^0-9]", "", text)


def _number(p: Permutation, digits: str, purpose: str) -> str:
    return f"{p.below(int(digits), 10 ** len(digits), purpose):0{len(digits)}d}"


def _card_number(p: Permutation, digits: str) -> str | None:
    def valid(digits: str) -> bool:
        return luhn_digit(digits[:-1]) == digits[-1] and len(set(digits)) > 1

    if not 13 <= len(digits) <= 19 or not valid(digits):
        return None
    while True:
        digits = _number(p, digits[:-1], "card")
        digits += luhn_digit(digits)
        if valid(digits):
            return digits


def _card(p: Permutation, text: str) -> str | None:
    new = _card_number(p, _digits(text))
    return new and _put(text, new)


def _letters_and_digits(p: Permutation, text: str, purpose: str) -> str:
    """Letters become letters of the same case, digits digits, the rest stays: one number in a
    mixed radix."""
    value, size, places = 0, 1, []
    for c in text:
        radix = 10 if c.isdigit() else 26 if c.isalpha() else 1
        own = ord(c) - ord("0" if c.isdigit() else "a" if c.islower() else "A") if radix > 1 else 0
        value, size = value * radix + own, size * radix
        places.append(radix)
    shape = "".join("9" if radix == 10 else "a" if radix == 26 else c for radix, c in zip(places, text))
    value, out = p.below(value, size, purpose + shape), []
    for c, radix in zip(reversed(text), reversed(places)):
        if radix == 1:
            out.append(c)
            continue
        value, own = divmod(value, radix)
        out.append(chr(own + ord("0" if radix == 10 else "a" if c.islower() else "A")))
    return "".join(reversed(out))


def _email(p: Permutation, text: str) -> str:
    """Local part and domain each for itself, so that one domain stays one; the last label stays.
    Case does not tell addresses apart, so values are permuted in lower case."""
    local, _, domain = text.partition("@")
    host, _, top = domain.rpartition(".")

    def same_case(new: str, old: str) -> str:
        return "".join(n.upper() if o.isupper() else n for n, o in zip(new, old))

    return "{}@{}.{}".format(
        same_case(_letters_and_digits(p, local.lower(), "local"), local),
        same_case(_letters_and_digits(p, host.lower(), "host"), host), top)


def _iban_rest(country: str, body: str) -> int:
    return int("".join(str(int(c, 36)) for c in body + country))


def _iban(p: Permutation, text: str) -> str | None:
    plain = text.replace(" ", "")
    country, check, body = plain[:2], plain[2:4], plain[4:]
    if not 15 <= len(plain) <= 34 or int(check) != 98 - _iban_rest(country, body) * 100 % 97:
        return None
    new = _letters_and_digits(p, body, "iban" + country)
    return _put(text, country + f"{98 - _iban_rest(country, new) * 100 % 97:02d}" + new, re.compile("[A-Z0-9]"))


#: The country calling codes of one and of two digits; all others have three.
COUNTRY_CODES = {
    "1", "7", "20", "27", "30", "31", "32", "33", "34", "36", "39", "40", "41", "43", "44", "45", "46", "47", "48", "49",
    "51", "52", "53", "54", "55", "56", "57", "58", "60", "61", "62", "63", "64", "65", "66", "81", "82", "84", "86",
    "90", "91", "92", "93", "94", "95", "98",
}


def _phone(p: Permutation, text: str) -> str | None:
    """The national digits are permuted under their country code, which stays, so that one number has one
    pseudonym in all written forms.  Without a plus a number of ten digits is one of country code 1.  A trunk
    zero in brackets is no part of the number; 8 to 15 digits in all."""
    if text.startswith("+"):
        digits = _digits(text.replace("(0)", ""))
        code = next((digits[:n] for n in (1, 2) if digits[:n] in COUNTRY_CODES), digits[:3])
        national = digits[len(code):]
    else:
        code, national = "1", _digits(text)
    if not 7 <= len(national) <= 15 - len(code):
        return None
    # The first digits of a text with a plus are the country code's; separators may stand within them.
    marked, head = text.replace("(0)", "(o)"), 0
    for _ in code if text.startswith("+") else "":
        head = re.compile("[0-9]").search(marked, head).end()
    return (marked[:head] + _put(marked[head:], _number(p, national, "phone" + code))).replace("(o)", "(0)")


def _ssn_valid(digits: str) -> bool:
    return digits[:3] not in ("000", "666") and digits[0] != "9" and digits[3:5] != "00" and digits[5:] != "0000"


def _ssn(p: Permutation, text: str) -> str | None:
    digits = _digits(text)
    if not _ssn_valid(digits):
        return None
    digits = _number(p, digits, "ssn")
    while not _ssn_valid(digits):
        digits = _number(p, digits, "ssn")
    return _put(text, digits)


def _ip(p: Permutation, text: str) -> str | None:
    parts = text.split(".")
    if any(int(part) > 255 or part != str(int(part)) for part in parts):
        return None
    value = int.from_bytes(bytes(map(int, parts)), "big")
    return ".".join(map(str, p.below(value, 1 << 32, "ip").to_bytes(4, "big")))


def _date(p: Permutation, text: str) -> str | None:
    """Days of two centuries, in the written form; 02/03/2001 is read as day/month if it can be."""
    for form in ("%Y-%m-%d", "%d/%m/%Y", "%m/%d/%Y", "%d.%m.%Y"):
        try:
            day = datetime.datetime.strptime(text, form).date().toordinal()
        except ValueError:
            continue
        if not FIRST_DAY <= day <= LAST_DAY:
            return None
        new = FIRST_DAY + p.below(day - FIRST_DAY, LAST_DAY - FIRST_DAY + 1, "date")
        return datetime.date.fromordinal(new).strftime(form)
    return None


MAKERS: dict[str, Callable[[Permutation, str], str | None]] = {
    "email": _email, "card": _card, "iban": _iban, "ssn": _ssn, "phone": _phone, "ip": _ip, "date": _date,
}


def kind_of(m: re.Match) -> str:
    return next(kind for kind in KINDS if m[kind] is not None)


def _ends(text: str, kind: str, start: int, end: int) -> list[int]:
    """Where a candidate of the kind may end: the usual ways to write a card first, then the longest."""
    if kind not in PARTED:
        return [end]
    ends = [end, *reversed([m.start() for m in PARTED[kind].finditer(text, start, end)])]
    if kind != "card":
        return [at for at in ends if PATTERNS[kind].fullmatch(text, start, at)]
    # A card has 13 to 19 digits; anything else is not looked at.
    ends = [at for at in ends if 13 <= at - start <= 37 and 13 <= sum(map(str.isdigit, text[start:at])) <= 19]
    return sorted(ends, key=lambda at: not USUAL.fullmatch(text, start, at))


def _cut_through(p: Permutation, text: str, kind: str, start: int, end: int, stop: int) -> bool:
    """Whether valid data begins at a later group of a candidate and goes on after it.  A card of an
    unusual grouping also gives way to other kinds that end within it."""
    unusual = kind == "card" and not USUAL.fullmatch(text, start, end)
    for separator in PARTED[kind].finditer(text, start, end):
        m = PATTERN.match(text, separator.end(), stop)
        for other in list(SHAPES)[list(SHAPES).index(kind_of(m)):] if m else ():
            found = PATTERNS[other].match(text, separator.end(), stop)
            if not found or kind == other == "card" and not unusual:
                continue
            for at in _ends(text, other, found.start(), found.end()):
                if other == "card" and not USUAL.fullmatch(text, found.start(), at):
                    break
                if (at > end or unusual and other != "card") and MAKERS[other](p, text[found.start():at]) is not None:
                    return True
    return False


def _replacement(p: Permutation, text: str, m: re.Match, stop: int) -> tuple[str, int, str] | None:
    """(kind, end, pseudonym) of the first kind that is valid where ``m`` begins."""
    start, kinds = m.start(), list(SHAPES)
    for kind in kinds[kinds.index(kind_of(m)):]:
        found = PATTERNS[kind].match(text, start, stop)
        for end in _ends(text, kind, start, found.end()) if found else ():
            new = MAKERS[kind](p, text[start:end])
            if new is not None and not (kind in PARTED and _cut_through(p, text, kind, start, end, stop)):
                return kind, end, new
    return None


def pseudonymise(text: str, p: Permutation) -> tuple[str, list[tuple[str, int, int]]]:
    """The text with pseudonyms, and (kind, start, end) of each in the new text, in code points.

    Where a candidate is not valid the search goes on after its first group, so that it hides nothing
    that begins within it.  Of two valid cards that overlap the left one is replaced.
    """
    out, spans, at, length, begin, end, stop = [], [], 0, 0, 0, 0, 0
    while hint := HINT.search(text, begin):
        word = hint.start()
        while word > begin and not text[word - 1].isspace():
            word -= 1
        if word >= end:
            blank = SPACE.search(text, hint.end())
            end = blank.start() if blank else len(text)
            blank = SPACE.search(text, end + REACH)
            stop = blank.start() if blank else len(text)
        m = PATTERN.search(text, word, stop)
        if m is None or m.start() >= end:
            begin = end
            continue
        found = _replacement(p, text, m, stop)
        if found is None:
            group = GROUP.match(text, m.start())
            begin = group.end() if group else m.start() + 1
            continue
        kind, begin, new = found
        length += m.start() - at
        spans.append((kind, length, length + len(new)))
        out += [text[at:m.start()], new]
        at, length = begin, length + len(new)
    return "".join([*out, text[at:]]), spans


def replace_private(docs: DataFrame, key: str, text_column: str = "text", found_column: str = "pii") -> DataFrame:
    """``docs`` with pseudonyms in the text, and ``found_column``: array of (kind, start, end).

    All other columns pass through unchanged; a column already named ``found_column`` is replaced.
    A null text stays null with no finds, an empty one stays empty, repeated rows get the same
    pseudonyms, an empty table gives an empty result.  Candidates that fail their check stay as they are.
    """
    ship_package(docs.sparkSession)
    names = [name for name in docs.columns if name != found_column]
    schema = ", ".join(f"`{name}` {docs.schema[name].dataType.simpleString()}" for name in names)
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))

    def replace(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        permutation, place = Permutation(key), names.index(text_column)
        for batch in batches:
            texts, finds = [], []
            for text in batch.column(place).to_pylist():
                new, spans = (None, []) if text is None else pseudonymise(text, permutation)
                texts.append(new)
                finds.append([{"kind": k, "start": a, "end": b} for k, a, b in spans])
            columns = batch.columns
            columns[place] = pa.array(texts, pa.string())
            yield pa.RecordBatch.from_arrays([*columns, pa.array(finds, kind)], [*names, found_column])

    return narrow(docs, *names).mapInArrow(
        replace, f"{schema}, `{found_column}` array<struct<kind:string,start:int,end:int>>")
