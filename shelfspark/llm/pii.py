"""Personal data and secrets replaced by surrogates: keyed, of the same type and format, one to one.

An entity has a canonical form, which its spellings share (an address in any case, a phone number with any separators),
so every mention of one entity gets the same surrogate. The surrogate is a keyed permutation of all strings of the
canonical form's format: each letter or digit varies within its own class (script, digits; the first digit of a number
keeps its range), seen together as one number in mixed radix, and a Feistel network with HMAC rounds permutes these
numbers. It is one to one, so different entities stay different. Check digits are made anew where they held before.
Names are replaced from lists of the same script and gender; a word in no list keeps its pattern of vowels and
consonants and never becomes a listed word. Both move one step along a keyed cycle of all words there are, so that
different words stay different and none stays itself (but for a word of letters without case).

A surrogate could still be the real entity of somebody else, or its own original. The corpus' entities are therefore
collected first and compared with all surrogates; those that collide are drawn again with the next round of the key,
until none does. A format of which the corpus
holds too many strings for that is permuted as a whole, which keeps its entities apart. Entities drawn again are rare; only documents that mention one are joined with their new surrogates.

Nulls: a null text stays null and counts no entities; an empty text stays as it is. Repeated rows get equal results.
Columns of the input are kept; the added columns replace columns of the same name.
"""

from __future__ import annotations

import hashlib
import hmac
import ipaddress
import re
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfspark.llm.common import slices, stored

KEY = "change-me"
#: The setting of a session that names the key.
KEY_SETTING = "spark.shelfspark.pii.key"
#: The attempt of a format that is too full to avoid the corpus' own entities: a step along its keyed cycle.
FULL = -1

# First names by gender and script, surnames by script, titles by gender.
NAMES = {
    ("latin", "f"): (
        "Anna Maria Julia Laura Sarah Emma Sophie Claire Camille Lucia Carmen Elena Isabel Petra Monika Sabine "
        "Helga Ursula Mary Patricia Jennifer Linda Elizabeth Barbara Susan Jessica Karen Nancy Margaret Alice "
        "Emily Charlotte Martine Brigitte Pilar Rosario"
    ).split(),
    ("latin", "m"): (
        "John Robert Michael William David Richard Joseph Thomas Charles Daniel Matthew Anthony Peter Paul Hans "
        "Klaus Jürgen Stefan Wolfgang Dieter Pierre Michel Philippe François Laurent Antoine Carlos Javier Miguel "
        "Manuel Pablo Diego Alejandro George Edward Henry"
    ).split(),
    ("cyrillic", "f"): "Анна Мария Елена Ольга Наталья Татьяна Ирина Светлана Екатерина Юлия Людмила Галина".split(),
    ("cyrillic", "m"): "Иван Сергей Алексей Дмитрий Андрей Михаил Николай Владимир Павел Олег Юрий Виктор".split(),
    ("latin", "last"): (
        "Smith Johnson Williams Brown Jones Miller Davis Wilson Anderson Taylor Moore Martin Thompson White Harris "
        "Clark Lewis Walker Hall Young Müller Schmidt Schneider Fischer Weber Meyer Wagner Becker Schulz Hoffmann "
        "Dubois Durand Leroy Moreau Simon García Martínez López Sánchez Pérez Gómez Fernández Ruiz"
    ).split(),
    ("cyrillic", "last"): "Иванов Петров Сидоров Смирнов Кузнецов Попов Соколов Лебедев Козлов Новиков".split(),
}
TITLES = {
    "m": "Mr Herr Monsieur Señor Sr Don Hr".split(),
    "f": "Mrs Ms Miss Frau Madame Mademoiselle Mme Mlle Señora Señorita Sra Doña Fr".split(),
    "": "Dr Prof Professor".split(),
}

_SECRET_PREFIX = r"(?:AKIA|AIza|eyJ|(?:gh[opsu]|sk|pk|xox[abp])[-_])?"
_VOWELS, _CONSONANTS = "aeiouy", "bcdfghjklmnpqrstvwxz"
#: Classes within which a letter or digit varies; other characters stay.
_CLASSES = (
    "0123456789",
    "abcdefghijklmnopqrstuvwxyz",
    "àáâäãåæèéêëìíîïòóôöõøùúûüýÿçñßœ",
    "абвгдежзийклмнопрстуфхцчшщъыьэюя",
    "αβγδεζηθικλμνξοπρστυφχψω",
)
_CLASS_OF = {c: k for k in _CLASSES for c in k}
#: For names: other lower-case letters vary within their 128 code points.
_OTHER: dict[int, str] = {}
for _c in map(chr, range(0x100, 0x1F000)):
    if _c.islower() and _c not in _CLASS_OF and len(_c.upper()) == 1 and _c != _c.upper() and _c.upper().lower() == _c:
        _OTHER[ord(_c) >> 7] = _OTHER.get(ord(_c) >> 7, "") + _c
_OTHER_OF = {c: k for k in _OTHER.values() for c in k}
_PATTERN_CLASS = {**_OTHER_OF, **_CLASS_OF, **dict.fromkeys(_VOWELS, _VOWELS), **dict.fromkeys(_CONSONANTS, _CONSONANTS)}


# --- permutations ----------------------------------------------------------------------------------------------


def _mac(key: bytes, label: str, n: int, i: int, half: int, size: int) -> int:
    mac = hmac.digest(key, f"{label}|{n}|{i}|{half}".encode(), "sha256")
    while len(mac) < size:
        mac += hashlib.sha256(mac).digest()
    return int.from_bytes(mac[:size], "big")


def permute(x: int, n: int, key: bytes, label: str, back: bool = False) -> int:
    """A keyed permutation of ``range(n)``: Feistel rounds over a grid of at least ``n`` cells, walked back inside.
    ``back``: its inverse."""
    if n < 2:
        return x
    side = 1
    while side * side < n:
        side <<= 1
    while side * side // 4 >= n:
        side >>= 1
    bits = side.bit_length() - 1
    size = (bits + 7) // 8 or 1
    while True:
        left, right = x >> bits, x & (side - 1)
        for i in reversed(range(6)) if back else range(6):
            if back:
                left, right = right ^ (_mac(key, label, n, i, left, size) & (side - 1)), left
            else:
                left, right = right, left ^ (_mac(key, label, n, i, right, size) & (side - 1))
        x = (left << bits) | right
        if x < n:
            return x


def step_on(x: int, n: int, key: bytes, label: str) -> int:
    """The next number along a keyed cycle through all of ``range(n)``: one to one, and never ``x`` if ``n`` > 1."""
    return permute((permute(x, n, key, label, back=True) + 1) % n, n, key, label)


def permute_text(text: str, key: bytes, label: str, class_of=_CLASS_OF, first: str = "", move=permute) -> str:
    """Characters of ``text`` vary together within their classes. ``first``: leading digits vary in it or outside it."""
    classes = [class_of.get(c) for c in text]
    if first and text and classes[0]:
        classes[0] = first if text[0] in first else "".join(c for c in classes[0] if c not in first)
    # The format is part of the label: strings of one format are permuted among themselves.
    shape = label + "|" + "".join("-" if k is None else k[0] for k in classes)
    x, n = 0, 1
    for c, k in zip(text, classes, strict=True):
        if k:
            x, n = x * len(k) + k.index(c), n * len(k)
    shape += "|" + "".join(c for c, k in zip(text, classes, strict=True) if not k)
    x = move(x, n, key, shape)
    out = []
    for c, k in zip(reversed(text), reversed(classes), strict=True):
        if k:
            x, at = divmod(x, len(k))
            out.append(k[at])
        else:
            out.append(c)
    return "".join(reversed(out))


# --- surrogates of canonical forms -----------------------------------------------------------------------------


def luhn_sum(digits: str) -> int:
    return sum(sum(divmod(2 * int(c), 10)) if i % 2 else int(c) for i, c in enumerate(reversed(digits))) % 10


def _card(digits: str, key: bytes, label: str, move) -> str:
    body = digits[0] + permute_text(digits[1:-1], key, f"{label}{digits[0]}{luhn_sum(digits)}", move=move)
    kept = luhn_sum(digits)  # 0 if the number was valid
    return next(body + d for d in "0123456789" if luhn_sum(body + d) == kept)


def iban_valid(text: str) -> bool:
    return int("".join(str(int(c, 36)) for c in text[4:] + text[:4])) % 97 == 1


def _iban(text: str, key: bytes, label: str, move) -> str:
    body = permute_text(text[4:].lower(), key, label + text[:2], move=move).upper()
    rest = int("".join(str(int(c, 36)) for c in body + text[:2] + "00")) % 97
    return f"{text[:2]}{98 - rest:02d}{body}"


def _ip(text: str, key: bytes, label: str, move) -> str:
    a, b, c, d = map(int, text.split("."))
    if a == 10:
        x = move(b << 16 | c << 8 | d, 1 << 24, key, label + "10")
        return f"10.{x >> 16}.{x >> 8 & 255}.{x & 255}"
    if (a, b) == (192, 168):
        x = move(c << 8 | d, 1 << 16, key, label + "192.168")
        return f"192.168.{x >> 8}.{x & 255}"
    if not 1 <= a <= 223:
        x = move(b << 16 | c << 8 | d, 1 << 24, key, f"{label}{a}")
        return f"{a}.{x >> 16}.{x >> 8 & 255}.{x & 255}"
    x = ((a - 1) << 24) | b << 16 | c << 8 | d
    while True:  # never into the private ranges, whose addresses map among themselves
        x = move(x, 223 << 24, key, label)
        a, b = (x >> 24) + 1, x >> 16 & 255
        if a != 10 and (a, b) != (192, 168):
            return f"{a}.{b}.{x >> 8 & 255}.{x & 255}"


def _ipv6(text: str, key: bytes, label: str, move) -> str:
    """``text``: compressed; its groups keep their lengths, so it stays compressed."""
    classes = [
        "" if c == ":" or group == "0" else "123456789abcdef" if i == 0 else "0123456789abcdef"
        for group in re.findall("[0-9a-f]+|:", text)
        for i, c in enumerate(group)
    ]
    x, n = 0, 1
    for c, k in zip(text, classes, strict=True):
        if k:
            x, n = x * len(k) + k.index(c), n * len(k)
    x = move(x, n, key, label + "".join("x" if k else c for c, k in zip(text, classes, strict=True)))
    out = []
    for c, k in zip(reversed(text), reversed(classes), strict=True):
        if k:
            x, at = divmod(x, len(k))
        out.append(k[at] if k else c)
    return "".join(reversed(out))


_LISTS = {k: {w.lower(): i for i, w in enumerate(v)} for k, v in NAMES.items()}
_GENDER = {w: (script, g) for (script, g), words in _LISTS.items() if g != "last" for w in words}
_LISTED = frozenset(w for words in _LISTS.values() for w in words)


#: The list and place of a word. No word is in two lists, so a name is replaced alike alone and beside another.
_PLACE = {w.lower(): (role, i) for role, words in NAMES.items() for i, w in enumerate(words)}


def _name(text: str, key: bytes, label: str) -> str:
    """``text``: gender, then lower-case words, each replaced by itself."""
    _, *words = text.split(" ")
    out = []
    for word in words:
        role, at = _PLACE.get(word, (None, 0))
        if role:
            out.append(NAMES[role][step_on(at, len(NAMES[role]), key, label + str(role))].lower())
        else:
            new = permute_text(word, key, label, _PATTERN_CLASS, move=step_on)
            while new in _LISTED:
                new = permute_text(new, key, label, _PATTERN_CLASS, move=step_on)
            out.append(new)
    return " ".join([text.split(" ")[0], *out])


@lru_cache(100_000)
def surrogate(kind: str, canonical: str, key: str, attempt: int = 0) -> str:
    """The surrogate, in canonical form, of an entity in canonical form."""
    secret, label = f"{key}|{attempt}".encode(), kind
    move = step_on if attempt == FULL else permute
    if kind == "card":
        return _card(canonical, secret, label, move)
    if kind == "iban":
        return _iban(canonical, secret, label, move)
    if kind == "ip":
        return _ip(canonical, secret, label, move)
    if kind == "ipv6":
        return _ipv6(canonical, secret, label, move)
    if kind == "name":
        return _name(canonical, secret, label)
    if kind == "email":
        local, domain = canonical.rsplit("@", 1)
        host, dot, top = domain.rpartition(".")
        return f"{permute_text(local + '@' + host, secret, label + top, move=move)}{dot}{top}"
    if kind == "phone":
        return permute_text(canonical, secret, label, first="23456789", move=move)
    if kind == "secret":
        prefix = re.match(_SECRET_PREFIX, canonical)[0]
        rest = canonical[len(prefix) :]
        if re.fullmatch("[0-9a-f]+", rest):
            x = move(int(rest, 16), 16 ** len(rest), secret, f"{label}{prefix}{len(rest)}")
            return f"{prefix}{x:0{len(rest)}x}"
        classes = {**_CLASS_OF, **{c.upper(): _CLASSES[1].upper() for c in _CLASSES[1]}}
        return prefix + permute_text(rest, secret, label + prefix, classes, move=move)
    return permute_text(canonical, secret, label, move=move)


def entity_format(kind: str, entity: str) -> str:
    """The strings among which the surrogate of an entity is drawn: one format's permutation is one to one."""
    shape = "".join(_CLASS_OF[c][0] if c in _CLASS_OF else "A" if c.lower() in _CLASS_OF else c for c in entity)
    if kind == "email":
        return shape[: entity.rindex(".")] + entity[entity.rindex(".") :]
    if kind == "card":
        return f"{entity[0]} {len(entity)} {luhn_sum(entity)}"
    if kind == "iban":
        return entity[:2] + shape[4:]
    if kind == "ip":
        a, b = entity.split(".")[:2]
        return "192.168" if (a, b) == ("192", "168") else a if a == "10" or not 1 <= int(a) <= 223 else "public"
    if kind == "ipv6":
        return re.sub("[1-9a-f]", "x", re.sub("(?<=[0-9a-f])0", "x", entity))
    if kind == "phone":
        return f"{len(entity)} {entity[:1] in set('01')}"
    if kind == "secret":
        prefix = re.match(_SECRET_PREFIX, entity)[0]
        rest = entity[len(prefix) :]
        return f"{prefix} {len(rest)}" if re.fullmatch("[0-9a-f]+", rest) else prefix + shape[len(prefix) :]
    return shape


def written(original: str, kind: str, canonical: str) -> str:
    """A canonical form in the format of an original mention: its separators and its case."""
    if kind == "ip":
        return canonical
    if kind == "name":
        parts = iter(canonical.split(" ")[1:])
        return re.sub(r"[^\W\d_]+(?:['’-][^\W\d_]+)*", lambda m: _cased(m[0], next(parts)), original)
    if kind == "secret":
        return canonical
    if kind == "email":
        return _cased_like(original, canonical)
    if kind == "ipv6":
        new = canonical if "::" in original else ":".join(g.lstrip("0") or "0" for g in ipaddress.IPv6Address(canonical).exploded.split(":"))
        if all(len(g) == 4 for g in original.split(":")):
            new = ipaddress.IPv6Address(canonical).exploded
        return new.upper() if original.isupper() else new
    fresh = iter(canonical)
    return "".join(next(fresh) if c.isalnum() else c for c in original)


def _cased(original: str, new: str) -> str:
    return new.upper() if len(original) > 1 and original.isupper() else "-".join(p[:1].upper() + p[1:] for p in new.split("-"))


def _cased_like(original: str, new: str) -> str:
    return "".join(n.upper() if o.isupper() else n for o, n in zip(original, new, strict=True))


# --- detection -------------------------------------------------------------------------------------------------

_BETWEEN = r"(?:[#$%&*!,]{0,4}(?:[ .-]| ?\| ?))"
_PHONE = re.compile(
    rf"(?<![\w.+])(?:(?:\+\d{{1,3}}{_BETWEEN}?)?(?:\(\d{{2,4}}\)|\d{{2,4}}){_BETWEEN}\d{{3,4}}{_BETWEEN}\d{{3,4}}|\+\d{{8,15}})(?![\w])"
)
_GAP = r"[ .\-/\u00a0\u202f]"
# Country codes 33 and 34 have nine digits behind them; numbers of code 1 are those of ``_PHONE``.
_PHONES = (
    _PHONE,
    re.compile(
        rf"(?<![\w.+])\+(?:3[34](?:{_GAP}?\(0\))?(?:{_GAP}?\d){{9}}"
        rf"|(?!1\D|3[34])\d{{1,3}}(?:{_GAP}?(?:\(\d{{1,5}}\)|\d{{2,12}})){{1,5}})(?!\w)"
    ),
    # Pairs of digits (0x xx xx xx xx, 9xx xx xx xx), and an area code with one long block.
    re.compile(rf"(?<![\w.+])(?:0[1-9](?:{_GAP}\d\d){{4}}|[2-9]\d\d(?:{_GAP}\d\d){{3}})(?![\w]|{_GAP}\d\d(?!\d))"),
    re.compile(rf"(?<![\w.+])(?:0[1-9]\d{{1,3}}{_GAP}|\(0[1-9]\d{{1,3}}\){_GAP}?)\d{{5,8}}(?!\w)"),
    # Plain digits behind a phone word.
    re.compile(
        r"(?i:\b(?:(?:tele)?phone|tel|telefon|call|mobile?|cell|fax|handy|whatsapp|sms|t[ée]l[ée]phone|portable|appel\w*"
        r"|tel[ée]fono|m[óo]vil|ll[áa]m\w+|ruf\w*|anruf\w*|тел|телефон\w*|звони\w*)\b)[^\w+\n]{0,4}(?:[^\W\d]{1,8}[^\w+\n]{1,3}){0,3}"
        r"(?P<plain>\d{7,11})(?!\w)"
    ),
)
_SEVEN = re.compile(r"\d{7}")
_PHONE_CODE = re.compile(r"1|7|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]|\d{3}")
_CARD = re.compile(r"(?<![\d.+])\d(?:[ -]?\d){12,18}(?!\d)")
_IP = re.compile(r"(?<![\d.])\d{1,3}(?:\.\d{1,3}){3}(?![\d]|\.\d)")
_SSN = re.compile(r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])")
_IBAN = re.compile(r"(?<![A-Z0-9])[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Z0-9])")
_IPV6 = re.compile(
    r"(?<![\w:.])(?:(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}|(?:[0-9A-Fa-f]{1,4}:){0,6}(?:[0-9A-Fa-f]{1,4})?::"
    r"(?:[0-9A-Fa-f]{1,4}:){0,6}[0-9A-Fa-f]{0,4})(?![\w:])"
)
_SECRETS = (
    re.compile(r"(?<![A-Za-z0-9])((?:AKIA[0-9A-Z]{16}|(?:gh[opsu]|sk|pk|xox[abp])[-_][A-Za-z0-9_-]{16,})(?![A-Za-z0-9]))"),
    re.compile(
        r"(?i:token|password|passwd|pwd|secret|api[_-]?key|access[_-]?key)[#$%&*!|]{0,4}\s{0,3}[=:][#$%&*!|]{0,4}\s{0,3}"
        r"[|]?\s?[\"']?([A-Za-z0-9+/_.~-]{8,})"
    ),
    re.compile(r"(?<![A-Za-z0-9])([0-9a-f]{32,})(?![A-Za-z0-9])"),
    re.compile(r"(?<![A-Za-z0-9_-])(AIza[A-Za-z0-9_-]{35})(?![A-Za-z0-9_-])"),
    re.compile(r"(?<![A-Za-z0-9_-])(eyJ[A-Za-z0-9_-]{5,}\.eyJ[A-Za-z0-9_-]{5,}\.[A-Za-z0-9_-]*)"),
    re.compile(r"-----BEGIN [A-Z ]*PRIVATE KEY-----\s+([A-Za-z0-9+/=:,\s-]*?[A-Za-z0-9+/=])\s+-----END "),
)
_SECRET_HINT = re.compile(r"(?i:token|passw|pwd|secret|key)|AKIA|AIza|eyJ|gh[opsu]_|[sp]k[-_]|xox|\d")
_WORD = r"[^\W\d_]+(?:['’-][^\W\d_]+)*"
_TITLE = re.compile(
    r"(?<!\w)(" + "|".join(t for ts in TITLES.values() for t in ts) + rf")\.?[  ]((?:{_WORD}[  ]){{0,2}}{_WORD})"
)
_TITLE_GENDER = {t: g for g, ts in TITLES.items() for t in ts}
_FIRST = re.compile(
    r"(?<!\w)(?:" + "|".join(w for (_, g), ws in NAMES.items() if g != "last" for w in ws) + rf") ({_WORD})"
)
_LOCAL = re.compile(r"[\w.%+-]{1,64}\Z")
_DOMAIN = re.compile(r"[\w-]+(?:\.[\w-]+)*\.(?:xn--[A-Za-z0-9-]{0,58}[A-Za-z0-9]|[^\W\d_]{2,24})")

Found = tuple[int, int, str, str]  # start, end, kind, canonical


def _emails(text: str) -> Iterator[Found]:
    at = text.find("@")
    while at >= 0:
        left = _LOCAL.search(text, max(0, at - 64), at)
        right = _DOMAIN.match(text, at + 1)
        if left and right:
            whole = text[left.start() : right.end()]
            lower = whole.lower()
            if len(lower) == len(whole):
                yield left.start(), right.end(), "email", lower
        at = text.find("@", at + 1)


def _digits(text: str) -> str:
    return "".join(c for c in text if c.isdigit())


def _phone_numbers(text: str) -> Iterator[Found]:
    """Of overlapping matches the longer one."""
    found = []
    long = _SEVEN.search(text)
    for k, pattern in enumerate(_PHONES):
        if (k == 1 and "+" not in text) or (pattern.groups and not long):
            continue
        for m in pattern.finditer(text):
            start, end = m.span("plain" if "plain" in pattern.groupindex else 0)
            digits = _digits(text[start:end])
            while len(digits) > 15 and k == 1:  # a number of its own behind the last gap
                end = start + re.match(rf"(.*?){_GAP}[^ .\-/]*\Z", text[start:end], re.S).end(1) if re.search(_GAP, text[start:end]) else start
                digits = _digits(text[start:end])
            if (9 if k == 0 else 7) <= len(digits) <= 15:
                found.append((start, end, "phone", digits))
    taken: list[Found] = []
    for f in sorted(found, key=lambda f: (f[0] - f[1], f[0])):
        if all(f[1] <= t[0] or f[0] >= t[1] for t in taken):
            taken.append(f)
    yield from sorted(taken)


def _ipv6_addresses(text: str) -> Iterator[Found]:
    for m in _IPV6.finditer(text):
        try:
            address = ipaddress.IPv6Address(m[0])
        except ValueError:
            continue
        # Words of hexadecimal letters around '::' are names in programs; '::1' is every machine's own.
        if any(c.isdigit() for c in m[0]) and not (address.is_unspecified or address.is_loopback):
            yield m.start(), m.end(), "ipv6", address.compressed


def _names(text: str) -> Iterator[Found]:
    for m in _TITLE.finditer(text):
        words = re.findall(_WORD, m[2])
        proper = 0
        for w in words:
            if not w[0].isupper():
                break
            proper += 1
        if proper:
            kept = words[:proper]
            end = m.start(2)
            for w in kept:
                end = text.index(w, end) + len(w)
            gender = _TITLE_GENDER[m[1]]
            yield m.start(2), end, "name", " ".join([gender or "-", *(w.lower() for w in kept)])
    for m in _FIRST.finditer(text):
        if m[1][0].isupper() and not m[1].isupper():
            first = m[0].split(" ")[0]
            yield m.start(), m.end(), "name", f"{_GENDER[first.lower()][1]} {first.lower()} {m[1].lower()}"


def detect(text: str) -> list[Found]:
    """Entities in order, none overlapping; of overlapping ones the earlier kind of the list below stays."""
    out: list[Found] = []
    if _SECRET_HINT.search(text):
        for pattern in _SECRETS:
            out += [(m.start(1), m.end(1), "secret", m[1]) for m in pattern.finditer(text)]
    out += _emails(text)
    if any(c in text for c in "0123456789"):
        if ":" in text:
            out += _ipv6_addresses(text)
        out += [
            (m.start(), m.end(), "ip", m[0])
            for m in _IP.finditer(text)
            if all(int(p) < 256 and str(int(p)) == p for p in m[0].split("."))
        ]
        for m in _IBAN.finditer(text):
            compact = m[0].replace(" ", "")
            if 15 <= len(compact) <= 34 and iban_valid(compact):
                out.append((m.start(), m.end(), "iban", compact))
        for m in _CARD.finditer(text):
            digits = _digits(m[0])
            if luhn_sum(digits) == 0 or (len(digits) == 16 and digits[0] in "3456"):
                out.append((m.start(), m.end(), "card", digits))
        out += [(m.start(), m.end(), "ssn", _digits(m[0])) for m in _SSN.finditer(text)]
        out += _phone_numbers(text)
    out += _names(text)
    if len(out) < 2:
        return out
    taken: list[Found] = []
    for found in out:  # in the order of kinds
        if all(found[1] <= t[0] or found[0] >= t[1] for t in taken):
            taken.append(found)
    return sorted(taken)


def _phone_prefix(original: str, canonical: str) -> str:
    """The leading digits that are kept: a country code, and the 0 before an area code."""
    code = _PHONE_CODE.match(canonical)[0] if original.startswith("+") else ""
    zero = canonical[len(code) :].startswith("0") and len(canonical) - len(code) > 7
    return code + "0" * zero


def replacement(original: str, kind: str, canonical: str, key: str, attempt: int = 0) -> str:
    if kind == "phone":
        prefix = _phone_prefix(original, canonical)
        return written(original, kind, prefix + surrogate(kind, canonical[len(prefix) :], key, attempt))
    return written(original, kind, surrogate(kind, canonical, key, attempt))


def entity_key(original: str, kind: str, canonical: str) -> str:
    """What identifies the entity: the canonical form, for phone numbers what is not kept of it, so that spellings
    with and without country code agree."""
    return canonical[len(_phone_prefix(original, canonical)) :] if kind == "phone" else canonical


# --- on Spark --------------------------------------------------------------------------------------------------

_ENTITY = "kind string, entity string"


def document_entities(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, kind, entity``: the distinct entities of each document."""
    named = docs.select(F.col(doc_id).cast("string").alias("doc_id"), F.col(text).alias("text"))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            rows = [
                (i, *e)
                for i, t in zip(batch["doc_id"].to_pylist(), batch["text"].to_pylist(), strict=True)
                if t
                for e in sorted({(k, entity_key(t[a:b], k, c)) for a, b, k, c in detect(t)})
            ]
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[k] for r in rows], pa.string()) for k in range(3)], ["doc_id", "kind", "entity"]
            )

    return named.mapInArrow(scan, f"doc_id string, {_ENTITY}")


def draw(entities: DataFrame, key: str) -> DataFrame:
    """Adds ``drawn`` to ``kind, entity, attempt``: the surrogate in canonical form."""

    @F.pandas_udf("string")
    def new(kind: pd.Series, entity: pd.Series, attempt: pd.Series) -> pd.Series:
        return pd.Series([surrogate(k, e, key, a) for k, e, a in zip(kind, entity, attempt, strict=True)], dtype=object)

    return entities.withColumn("drawn", new("kind", "entity", "attempt"))


def drawn_again(entities: DataFrame, key: str, rounds: int = 6) -> DataFrame:
    """``kind, entity, attempt`` of the entities whose first surrogate collides: with another one's surrogate, or
    (but for names, which are drawn from lists and never their own) with an entity of the corpus. Compared by shuffles
    over all entities.

    Of entities with one surrogate the least keeps it. A format whose entities still collide after ``rounds`` is so
    full that its surrogates must be entities of the corpus: all of it then moves one step along its keyed cycle, which
    is one to one and leaves none its own (but for a format of a single string). Fails if two surrogates are equal
    even so.
    """
    spark = entities.sparkSession
    now = stored(spark, draw(entities.withColumn("attempt", F.lit(0)), key), "entities")
    real = entities.select("kind", F.col("entity").alias("drawn")).where("kind <> 'name'")

    def collisions(now: DataFrame, with_hits: bool) -> DataFrame:
        keepers = now.groupBy("kind", "drawn").agg(F.min("entity").alias("keeper"), F.count("*").alias("n"))
        if not with_hits:
            return keepers.where("n > 1")
        hits = real.join(now.select("kind", "drawn").distinct(), ["kind", "drawn"], "left_semi")
        bad = (
            keepers.join(hits.withColumn("hit", F.lit(True)), ["kind", "drawn"], "left")
            .where("n > 1 OR hit")
            .select("kind", "drawn", "keeper", F.coalesce("hit", F.lit(False)).alias("hit"))
        )
        return stored(spark, bad, "collisions")

    for n_drawn in range(rounds + 1):
        bad = collisions(now, True)
        if bad.isEmpty():
            break
        moves = F.col("hit") | (F.col("keeper") != F.col("entity"))
        marked = now.join(bad, ["kind", "drawn"], "left").withColumn("moves", F.coalesce(moves, F.lit(False)))
        if n_drawn < rounds:
            moved = marked.withColumn("attempt", F.col("attempt") + F.col("moves").cast("int"))
            now = stored(spark, draw(moved.select("kind", "entity", "attempt"), key), "entities")
            continue

        @F.pandas_udf("string")
        def format_of(kind: pd.Series, entity: pd.Series) -> pd.Series:
            return pd.Series([entity_format(k, e) for k, e in zip(kind, entity, strict=True)], dtype=object)

        shaped = marked.withColumn("format", format_of("kind", "entity"))
        full = shaped.where("moves").select("kind", "format").distinct().withColumn("full", F.lit(True))
        attempt = F.when(F.col("full"), F.lit(FULL)).otherwise(F.col("attempt"))
        moved = shaped.join(full, ["kind", "format"], "left").withColumn("attempt", attempt)
        now = stored(spark, draw(moved.select("kind", "entity", "attempt"), key), "entities")
        left = {r["kind"]: r["count"] for r in collisions(now, False).groupBy("kind").count().collect()}
        if left:
            raise ValueError(f"surrogates still collide after {rounds} rounds, by kind: {left}")
    return now.where("attempt <> 0").select("kind", "entity", "attempt")


def replace_entities(
    docs: DataFrame, key: str | None = None, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``docs`` with entities in ``text`` replaced, and ``n_entities long, kinds array<string>``.

    ``key``: by default that of the session's ``KEY_SETTING``, or else a placeholder."""
    spark = docs.sparkSession
    key = spark.conf.get(KEY_SETTING, KEY) if key is None else key
    mentions = stored(spark, document_entities(docs, doc_id, text), "mentions")
    again = stored(spark, drawn_again(mentions.select("kind", "entity").distinct(), key), "drawn-again")
    kept = docs.drop("n_entities", "kinds", "pii_again")
    if again.isEmpty():
        rows = kept.withColumn("pii_again", F.lit(None).cast("array<struct<kind:string,entity:string,attempt:int>>"))
    else:
        mine = (
            mentions.join(again, ["kind", "entity"])
            .groupBy("doc_id")
            .agg(F.collect_set(F.struct("kind", "entity", "attempt")).alias("pii_again"))
            .withColumnRenamed("doc_id", "pii_doc")
        )
        rows = kept.join(mine, F.col(doc_id).cast("string").eqNullSafe(F.col("pii_doc")), "left").drop("pii_doc")

    @F.pandas_udf("text string, n_entities long, kinds array<string>")
    def replace(texts: pd.Series, again: pd.Series) -> pd.DataFrame:
        out = []
        for t, more in zip(texts, again, strict=True):
            found = detect(t) if t else []
            if not found:
                out.append((t, 0, []))
                continue
            attempts = {(m["kind"], m["entity"]): m["attempt"] for m in more} if more is not None else {}
            parts, at = [], 0
            for a, b, kind, canonical in found:
                attempt = attempts.get((kind, entity_key(t[a:b], kind, canonical)), 0)
                parts += [t[at:a], replacement(t[a:b], kind, canonical, key, attempt)]
                at = b
            parts.append(t[at:])
            out.append(("".join(parts), len(found), sorted({f[2] for f in found})))
        return pd.DataFrame(out, columns=["text", "n_entities", "kinds"])

    done = rows.withColumn("pii_new", replace(F.col(text), F.col("pii_again")))
    return done.select(
        *(F.col("pii_new.text").alias(text) if c == text else F.col(f"`{c}`") for c in kept.columns),
        "pii_new.n_entities",
        "pii_new.kinds",
    )
