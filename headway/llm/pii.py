"""Format-preserving pseudonyms by a keyed Feistel network.

Numbers and dates are found, validated (Luhn for cards, mod 97 for IBANs, ranges
for addresses, phone and social security numbers, the calendar for dates) and
permuted within their own format, so the pseudonym is valid again, keeps its
separators, and equal values get equal pseudonyms in all documents.  E-mail
addresses and secrets keep their shape: letters and digits are permuted as numbers
of mixed radix.  The permutation depends on the key and the kind only.

What decides on a value's validity (a phone number's plan, a check digit) is a class
that its pseudonym shares, so unlike values get unlike pseudonyms.  Dates are read
with English, German, French and Spanish names of months; a date with slashes is
month first where it can be.  Its pseudonym keeps the order, and days over 12 stay
over 12, so that it is read as it was written.  Two writings of one date, or of one
number with other separators, are one value.

The key is the caller's; there is none in the source.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from datetime import date, timedelta
from functools import lru_cache
from hashlib import blake2b

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .common import pieces

ROUNDS = 8
FIRST_DAY, LAST_DAY = date(1900, 1, 1), date(2099, 12, 31)
#: Months in four languages, as they are written; what is before and after them in a date is kept.
MONTHS = {
    "en": "January February March April May June July August September October November December".split(),
    "en short": "Jan Feb Mar Apr May Jun Jul Aug Sep Oct Nov Dec".split(),
    "de": "Januar Februar März April Mai Juni Juli August September Oktober November Dezember".split(),
    "fr": "janvier février mars avril mai juin juillet août septembre octobre novembre décembre".split(),
    "es": "enero febrero marzo abril mayo junio julio agosto septiembre octubre noviembre diciembre".split(),
}
_NAMES = sorted({n for ns in MONTHS.values() for n in ns}, key=lambda n: (-len(n), n))
_MONTH = "(?:" + "|".join(_NAMES) + ")"

#: Kinds in order of precedence at one place.
PATTERNS = {
    "email": r"[A-Za-z0-9._%+\-]{1,64}@[A-Za-z0-9\-]+(?:\.[A-Za-z0-9\-]+)*\.[A-Za-z]{2,}",
    "key": r"AKIA[A-Z0-9]{16}\b",
    "iban": r"[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?\b",
    "ip": r"\d{1,3}(?:\.\d{1,3}){3}(?![\w]|\.\d)",
    "date": rf"(?:\d{{4}}-\d{{2}}-\d{{2}}|\d{{1,2}}[./]\d{{1,2}}[./]\d{{4}}|\d{{1,2}}(?:\.|er|st|nd|rd|th)? (?:de )?{_MONTH}\.?,? (?:de |del )?\d{{4}}|{_MONTH}\.? \d{{1,2}}(?:st|nd|rd|th)?, \d{{4}})(?!\w)",
    "ssn": r"\d{3}-\d{2}-\d{4}(?![\w\-])",
    "card": r"(?:\d{13,19}|\d{4}(?P<gap>[ \-])(?:\d{4}(?P=gap)\d{4}(?P=gap)\d{1,7}|\d{6}(?P=gap)\d{5}))(?![\w\-])",
    "phone": r"(?:(?:1[ .\-]?)?(?:\(\d{3}\) ?|\d{3}[ .\-])\d{3}[ .\-]\d{4}|(?:\(\d{2,4}\)|\d{2,4})(?:[ .\-]?\d{2,4}){2,4})(?![\w\-])",
}
_PLUS = r"(?<![\w+])\+(?:1[ .\-]?(?:\(\d{3}\) ?|\d{3}[ .\-])\d{3}[ .\-]\d{4}|\d{1,3}[ .\-]?(?:\(\d{2,4}\)|\d{2,4})(?:[ .\-]?\d{2,4}){2,4})(?![\w\-])"
#: A value without a digit is a secret behind an equals sign or a quote only; behind a colon it may be a word of a sentence.
_SECRET = r"(?P<secret>(?i:password|passwd|pwd|secret|token|api_?key)\s*(?:=\s*[\"']?|:\s*[\"']|(?P<colon>:\s*)))(?P<value>[A-Za-z0-9_\-]{8,})"
_FIND = re.compile("(?<![\\w@.+\\-])(?:" + "|".join(f"(?P<{k}>{p})" for k, p in PATTERNS.items()) + f")|(?P<plus>{_PLUS})|{_SECRET}")
_KINDS = [*PATTERNS, "plus", "value"]
_HINT = re.compile(r"[0-9@]|(?i:password|passwd|pwd|secret|token|api_?key)\s*[=:]")


class Feistel:
    """A keyed permutation of range(n), of its own for each kind."""

    def __init__(self, key: bytes):
        if not key:
            raise ValueError("pseudonyms need a key")
        self.key = blake2b(key, digest_size=32).digest()

    def permute(self, kind: str, n: int, x: int, back: bool = False, accept: Callable[[int], bool] = lambda _: True) -> int:
        """Alternating rounds on two halves; steps outside range(n) or what is accepted are walked through."""
        a = 1
        while a * a < n:
            a *= 2
        b = max(1, -(-n // a))
        tweak = f"{kind}/{n}".encode()
        while True:
            left, right = divmod(x, b)  # left < a, right < b
            for r in range(ROUNDS - 1, -1, -1) if back else range(ROUNDS):
                data = blake2b(b"%d/%d" % (r, right if r % 2 == 0 else left), key=self.key, salt=blake2b(tweak, digest_size=16).digest(), digest_size=16)
                f = int.from_bytes(data.digest(), "big") * (-1 if back else 1)
                if r % 2 == 0:
                    left = (left + f) % a
                else:
                    right = (right + f) % b
            x = left * b + right
            if x < n and accept(x):
                return x


def luhn(digits: str) -> int:
    """The check digit for a payload."""
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c) * (2 if k % 2 == 0 else 1)
        total += d - 9 if d > 9 else d
    return -total % 10


def mod97(iban: str) -> int:
    return int("".join(str(int(c, 36)) for c in iban[4:] + iban[:4])) % 97


def lay(shape: str, digits: str) -> str:
    """The digits in the places of a shape's digits."""
    it = iter(digits)
    return "".join(next(it) if c.isdigit() else c for c in shape)


class Pseudonyms:
    """Pseudonyms of single values; None where a value isn't valid."""

    def __init__(self, key: bytes, back: bool = False):
        self.feistel, self.back = Feistel(key), back
        self.of = lru_cache(maxsize=50_000)(self._of)

    def number(self, kind: str, digits: str, accept: Callable[[str], bool] = lambda _: True) -> str:
        n = len(digits)
        return str(self.feistel.permute(kind, 10**n, int(digits), self.back, lambda x: accept(f"{x:0{n}d}"))).zfill(n)

    def mixed(self, kind: str, text: str, accept: Callable[[str], bool] = lambda _: True) -> str:
        """Digits stay digits and letters stay letters of the same case."""
        places = [(c, 10, "0") if c.isdigit() else (c, 26, "a" if c.islower() else "A") for c in text if c.isascii() and c.isalnum()]
        n = x = 1
        x = 0
        for c, base, zero in places:
            n, x = n * base, x * base + ord(c) - ord(zero)

        def write(x: int) -> str:
            out = []
            for _, base, zero in reversed(places):
                x, d = divmod(x, base)
                out.append(chr(ord(zero) + d))
            return "".join(out.pop() if c.isascii() and c.isalnum() else c for c in text)

        return write(self.feistel.permute(f"{kind}:" + "".join(z for *_, z in places), n, x, self.back, lambda y: accept(write(y))) if n > 1 else 0)

    def _of(self, kind: str, value: str) -> str | None:
        return getattr(self, f"_{kind}")(value)

    def _email(self, value: str) -> str:
        """The local part and the domain but its last two names, which are no one's own."""
        local, _, domain = value.rpartition("@")
        names = domain.split(".")
        return f"{self.mixed('email', local)}@{'.'.join([self.mixed('domain', n) for n in names[:-2]] + names[-2:])}"

    def _key(self, value: str) -> str:
        return value[:4] + self.mixed("key", value[4:])

    def _value(self, value: str) -> str | None:
        """Hexadecimal values with digit and letter are permuted among such; others by their places of digits and letters."""
        hexed = lambda v: bool(re.fullmatch("[0-9a-f]+", v) and re.search("[a-f]", v) and re.search("[0-9]", v))
        if hexed(value):
            n = len(value)
            return f"{self.feistel.permute('hex', 16**n, int(value, 16), self.back, lambda x: hexed(f'{x:0{n}x}')):0{n}x}"
        return self.mixed("secret", value, lambda v: not hexed(v))

    def _iban(self, value: str) -> str | None:
        bare = value.replace(" ", "")
        # 00, 01 and 99 leave the remainder of 97, 98 and 02, but no bank gives them
        if not 15 <= len(bare) <= 34 or not 2 <= int(bare[2:4]) <= 98 or mod97(bare) != 1:
            return None
        inner = self.mixed("iban" + bare[:2], bare[4:])
        check = 98 - mod97(f"{bare[:2]}00{inner}")
        it = iter(f"{bare[:2]}{check:02d}{inner}")
        return "".join(c if c == " " else next(it) for c in value)

    def _ip(self, value: str) -> str | None:
        parts = [int(x) for x in value.split(".")]
        if max(parts) > 255:
            return None
        x = self.feistel.permute("ip", 1 << 32, int.from_bytes(bytes(parts), "big"), self.back)
        return ".".join(map(str, x.to_bytes(4, "big")))

    def _date(self, value: str) -> str | None:
        numbers = re.findall(r"\d+", value)
        if "-" in value:
            write, (y, m, d) = (lambda t: f"{t.year:04d}-{t.month:02d}-{t.day:02d}"), map(int, numbers)
        elif name := re.search(_MONTH, value):
            # names alike in several languages: German behind a day with a dot, else the first; the date is the same in any case
            of = next(ns for k, ns in sorted(MONTHS.items(), key=lambda item: item[0] != "de" or not re.match(r"\d+\. ", value)) if name[0] in ns)
            d, y, m = int(numbers[0]), int(numbers[1]), of.index(name[0]) + 1

            def write(t: date) -> str:
                new = iter([str(t.day), str(t.year)])
                named = re.sub(_MONTH, "\0", value, count=1)
                text = re.sub(r"\d+", lambda _: next(new), named).replace("\0", of[t.month - 1])
                # ordinal endings go with the day
                ending = {1: "st", 2: "nd", 3: "rd"}.get(t.day if t.day < 20 else t.day % 10, "th")
                text = re.sub(r"(?<=\d)(?:st|nd|rd|th)\b", ending, text)
                return re.sub(r"^(\d+)(?:er)? ", lambda k: f"{k[1]}er " if k[1] == "1" else f"{k[1]} ", text) if of is MONTHS["fr"] else text
        else:
            a, b, y = map(int, numbers)
            sep, wide = value[len(numbers[0])], len(numbers[0]) == 2 and len(numbers[1]) == 2
            # with slashes the month comes first where it can, in the pseudonym as in the value
            month_first = sep == "/" and a <= 12
            d, m = (b, a) if month_first else (a, b)
            pad = (lambda x: f"{x:02d}") if wide else str
            write = lambda t: sep.join([*((pad(t.month), pad(t.day)) if month_first else (pad(t.day), pad(t.month))), str(t.year)])
        try:
            day = date(y, m, d)
        except ValueError:
            return None
        if not FIRST_DAY <= day <= LAST_DAY:
            return None
        span = (LAST_DAY - FIRST_DAY).days + 1
        # days over 12 stay so, as they tell the order of a writing with slashes
        late = lambda x: ((FIRST_DAY + timedelta(x)).day > 12) == (day.day > 12)
        return write(FIRST_DAY + timedelta(self.feistel.permute("date", span, (day - FIRST_DAY).days, self.back, late)))

    def _ssn(self, value: str) -> str | None:
        valid = lambda s: s[:3] not in ("000", "666") and s[0] != "9" and s[3:5] != "00" and s[5:] != "0000"
        digits = value.replace("-", "")
        return lay(value, self.number("ssn", digits, valid)) if valid(digits) else None

    def _card(self, value: str) -> str | None:
        digits = "".join(c for c in value if c.isdigit())
        if not 13 <= len(digits) <= 19 or luhn(digits[:-1]) != int(digits[-1]):
            return self._phone(value) if len(digits) <= 15 and not value.isdigit() else None
        inner = self.number("card" + digits[0], digits[1:-1])
        return lay(value, digits[0] + inner + str(luhn(digits[0] + inner)))

    def _phone(self, value: str) -> str | None:
        digits = "".join(c for c in value if c.isdigit())
        code = re.match(r"\+(\d{1,3})(?=[ .\-(])", value)
        lead, own = (code[1], digits[len(code[1]) :]) if code else ("", digits)
        if not 7 <= len(digits) <= 15 or len(own) < 6:
            return None
        # North American numbers are a class of their own, as are those with a leading zero; what passes as a card is none
        north = len(own) == 10 and lead in ("", "1")
        carded = lead == "" and 13 <= len(own) and not value.isdigit() and re.fullmatch(PATTERNS["card"], value)
        kind = lambda s: "north" if north and s[0] in "23456789" and s[3] in "23456789" else "card" if carded and luhn(s[:-1]) == int(s[-1]) else "zero" if s[0] == "0" else "other"
        mine = kind(own)
        if mine == "card" or (mine != "north" and not code and not re.search(r"[ ().\-]", value)):
            return None
        return lay(value, lead + self.number("north" if north and mine == "north" else "phone", own, lambda s: kind(s) == mine))

    _plus = _phone

    def rewrite(self, text: str) -> tuple[str, list[dict]]:
        """The text with pseudonyms, and the spans of the text as it was."""
        if not _HINT.search(text):
            return text, []
        out, spans, done, at, bar = [], [], 0, 0, 0
        while m := _FIND.search(text, at):
            kind = next(k for k in _KINDS if m[k] is not None)
            start, stop = m.span(kind)
            new = self.of(kind, m[kind]) if m["colon"] is None or any(c.isdigit() for c in m["value"]) else None
            if kind == "card" and new is None:
                # its groups are no phone number either, but a card may begin with one of them
                bar = m.end()
            if new is None or (kind == "phone" and start < bar):
                # try again behind the first character, for another kind may begin there
                run = re.compile(r"[\w.+\-@]*").match(text, m.start() + 1)
                at = max(m.start() + 1, run.end() if kind != "card" and kind != "phone" else m.start() + 1)
                continue
            out += [text[done:start], new]
            spans.append({"kind": {"plus": "phone", "value": "secret"}.get(kind, kind), "start": start, "stop": stop})
            done = at = stop
        return "".join([*out, text[done:]]), spans


@lru_cache(maxsize=4)
def pseudonyms(key: bytes) -> Pseudonyms:
    return Pseudonyms(key)


def pseudonymise(df: DataFrame, key: bytes, text: str = "text", spans: str = "spans") -> DataFrame:
    """``df`` with pseudonyms in ``text``, and ``spans`` (kind, start, stop in code points of the text as it was).

    One pass, no shuffle.  ``key`` is secret and not empty; equal keys give equal
    pseudonyms in all runs.  A null text stays null and has no spans; an empty one is
    kept.  Repeated rows come out alike.  A column of ``df`` named ``spans`` is
    replaced.  An empty table stays empty.
    """
    rest = df.select(*[c for c in df.columns if c != spans])
    kind = T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.IntegerType()), T.StructField("stop", T.IntegerType())])
    arrow = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("stop", pa.int32())]))

    def run(batches):
        own = pseudonyms(key)
        for b in pieces(batches, text):
            done = [(None, []) if t is None else own.rewrite(t) for t in b.column(text).to_pylist()]
            columns = {n: c for n, c in zip(b.schema.names, b.columns, strict=True)} | {text: pa.array([t for t, _ in done], pa.string()), spans: pa.array([s for _, s in done], arrow)}
            yield pa.RecordBatch.from_arrays(list(columns.values()), list(columns))

    return rest.mapInArrow(run, T.StructType([*rest.schema.fields, T.StructField(spans, T.ArrayType(kind))]))
