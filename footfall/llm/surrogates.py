"""Replacing personal data by surrogates.

Detected entities get keyed replacements of the same type: a name of the same gender and script,
a number of the same format, an address of the same shape. A surrogate depends on the key, the
entity and the number of the attempt only, so every mention of an entity in the corpus gets the
same one (names are replaced word by word, so "Mr. Smith" follows "John Smith"; e-mail domains
are entities of their own). Distinct entities keep distinct surrogates: in rounds, a surrogate
that two entities share, that is settled already, or that is itself an entity of the corpus, goes
to at most one of them, and the others try again. All checks are joins and aggregations over the
distinct entities.

Names are found by titles, listed given names, phrases that introduce or sign ("my name is", "Best
regards,"), and by their shape: a run of two to four capitalised words is a name if none of its
words occurs in lower case anywhere in the corpus, in texts that do not capitalise ordinary words.
"""

from __future__ import annotations

import hashlib
import hmac
import ipaddress
import re
import unicodedata
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from footfall.operators.spread import spread_join

from .common import Scratch, semi_join_listed, whole_text

DEFAULT_KEY = "footfall"

# Rounds in which surrogates are looked for.
MOST_ROUNDS = 64

# Shape says nothing in texts that capitalise more than this share of the words inside sentences.
MOST_CAPITALS = 0.15

# Lower-case words that a task remembers not to report twice.
REMEMBERED = 200_000

# Given names by script and gender, surnames by script.
GIVEN = {
    ("latin", "f"): "Mary Patricia Jennifer Elizabeth Susan Jessica Sarah Margaret Claire Sofia Ingrid Julia Camille Lucía".split(),
    ("latin", "m"): "John James Robert Michael William David Richard Joseph Thomas Charles Pierre Klaus Jürgen Carlos Javier".split(),
    ("cyrillic", "f"): "Анна Мария Елена Ольга Наталья Ирина Татьяна Светлана".split(),
    ("cyrillic", "m"): "Иван Сергей Дмитрий Алексей Николай Михаил Андрей Павел".split(),
    ("greek", "f"): "Μαρία Ελένη Αικατερίνη Σοφία".split(),
    ("greek", "m"): "Γιώργος Δημήτρης Κώστας Νίκος".split(),
}
SURNAMES = {
    "latin": "Smith Johnson Williams Brown Jones Miller Davis Wilson Anderson Taylor Müller Schmidt Schneider Fischer Dupont Moreau Lefebvre García Fernández González".split(),
    "cyrillic": "Иванов Смирнов Кузнецов Попов Соколов Лебедев Козлов Новиков".split(),
    "greek": "Παπαδόπουλος Γεωργίου Νικολάου Δημητρίου".split(),
    "han": list("王李张刘陈杨赵黄周吴徐孙"),
}
TITLES = {
    "f": "Mrs Ms Miss Mme Madame Frau Sra Señora г-жа κυρία".split(),
    "m": "Mr Herr Monsieur Sr Señor г-н κύριος".split(),
    "": "Dr Prof Professor Doctor".split(),
}
HAN_TITLES = {"先生": "m", "女士": "f", "小姐": "f"}
INTRODUCED = (
    "my name is|my name's|i am called|call me|full name:|name:|patient:|signed by|signed,|dear|sincerely,|sincerely yours,"
    "|yours truly,|best regards,|kind regards,|regards,|best wishes,|mein name ist|ich heiße|mit freundlichen grüßen|mit freundlichen grüßen,"
    "|je m'appelle|je m’appelle|mon nom est|cordialement,|me llamo|mi nombre es|saludos,|меня зовут|с уважением,"
).split("|")
BORN = "born on|born|date of birth|date of birth:|birth date|birth date:|dob|dob:|geboren am|né le|née le|nacido el|nacida el".split("|")
# Words that make a run of capitalised words something else than a person.
NO_NAMES = set(
    "sir madam all team customer colleague colleagues friend friends editor reader readers sirs the a an and of"
    " january february march april may june july august september october november december"
    " monday tuesday wednesday thursday friday saturday sunday"
    " north south east west new saint san los las university college school institute street road avenue park city"
    " company inc ltd llc corp gmbh foundation license public general library software international national"
    " united states kingdom republic european union".split()
)
SYLLABLES = {
    "latin": "ba be bo da de do ka ke ko la le lo ma me mi na ne no ra re ri sa se ta to va vi".split(),
    "cyrillic": "ба бе во да де ко ла ле ма ми на но ра ри са се та то".split(),
    "greek": "βα δε κο λα λε μα μι να νο ρα ρι σα σε τα το".split(),
    "han": list("伟芳娜敏静丽强磊军洋勇艳杰娟涛明超秀霞平刚桂"),
}
GENDER_END = {
    ("latin", "f"): "na", ("latin", "m"): "son", ("cyrillic", "f"): "на", ("cyrillic", "m"): "р",
    ("greek", "f"): "να", ("greek", "m"): "ος",
}

_GENDER = {n.casefold(): g for (_, g), names in GIVEN.items() for n in names}
_TITLE = {t.casefold(): g for g, names in TITLES.items() for t in names}
_WORD = r"[^\W\d_](?:[^\W\d_]|[’'-](?=[^\W\d_]))*"
_PERSON = re.compile(
    r"(?<!\w)(?:(?P<title>" + "|".join(map(re.escape, sorted(_TITLE, key=len, reverse=True))) + r")\.?[  ]|(?="
    + "(?:" + "|".join(sorted((n for names in GIVEN.values() for n in names), key=len, reverse=True)) + r")(?!\w)))"
    rf"(?P<first>(?-i:{_WORD}))",
    re.IGNORECASE,
)
_NEXT = re.compile(rf"[  ](?P<first>{_WORD})")
_HAN = re.compile(f"(?P<family>[{''.join(SURNAMES['han'])}])(?P<given>[一-鿿]{{0,2}}?)(?P<title>{'|'.join(HAN_TITLES)})")
_OWNER = re.compile(r"[’']s$", re.IGNORECASE)
_LETTERS = re.compile(r"[^\W\d_]+")
_AT_DOMAIN = re.compile(r"@[\w-]+(?:\.[\w-]+)+")
_IPV4 = re.compile(r"(?<![\w.])(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){3}(?:25[0-5]|2[0-4]\d|1?\d?\d)(?!\w|\.\d)", re.A)
_IBAN = re.compile(r"\b[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?\b", re.A)
_SSN = re.compile(r"(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-])", re.A)
_CARD = re.compile(r"(?<![\w.+-])(?:\d{13,19}|\d{4}(?:[ -]\d{4}){3}|\d{4}[ -]\d{6}[ -]\d{5})(?![\w-])", re.A)
_PHONE = re.compile(
    r"(?<![\w.])(?:\+\d{1,3}[ .-]?(?:\(\d{1,4}\)[ .-]?)?\d{2,4}(?:[ .-]?\d{2,4}){1,4}|\(\d{3}\) ?\d{3}[ .-]\d{4}|\d{3}[.-]\d{3}[.-]\d{4})(?!\w)",
    re.A,
)
_SPACED_PHONE = re.compile(r"(?<![\w.,-])(?<!\d )\d{3} \d{3} \d{4}(?![\w.,-]\d| \d|\w)", re.A)
_IPV6 = re.compile(r"(?<![\w:.])[0-9A-Fa-f]{1,4}(?::[0-9A-Fa-f]{0,4}){2,7}(?![\w:])", re.A)
_DATE = r"(?P<what>\d{4}([-/.])\d{1,2}\2\d{1,2}|\d{1,2}([-/.])\d{1,2}\3\d{4})(?!\d)"
_BORN = re.compile(rf"(?<!\w)(?:{'|'.join(map(re.escape, BORN))})\s{{1,3}}{_DATE}", re.IGNORECASE)
_PASSPORT = re.compile(r"(?<!\w)passport(?: no\.?| nr\.?| number)?[:#]?\s{1,3}(?P<what>(?-i:[A-Z]{0,2}\d{6,9}))(?!\w)", re.IGNORECASE)
_INTRODUCED = re.compile(
    rf"(?<!\w)(?:{'|'.join(map(re.escape, INTRODUCED))})\s{{1,3}}(?P<first>(?-i:{_WORD}))", re.IGNORECASE
)
_CAPITAL = "[" + "".join(c for c in map(chr, range(0x530)) if c.isupper()) + "]"
_NAME_WORD = rf"{_CAPITAL}(?:[^\W\d_]|[’'-](?=[^\W\d_])){{1,29}}"
_RUN = re.compile(rf"{_NAME_WORD}(?: {_NAME_WORD})+(?!\w)")
_BEGINS = re.compile(r"(?:^|[.!?:\n]\s*[\"'“«(]?)$")
_INSIDE = re.compile(r"(?<=[\w,;] )[^\W\d_]+")
_MARKS = ".,;:!?\"'()[]{}«»„“”‚‘’…–—*_"
# in this order: an earlier kind takes the characters it matches
_KINDS = (
    ("birthdate", _BORN), ("passport", _PASSPORT), ("iban", _IBAN), ("ipv6", _IPV6), ("ipv4", _IPV4),
    ("ssn", _SSN), ("phone", _PHONE), ("card", _CARD), ("phone", _SPACED_PHONE),
)
# texts without any of a kind's signs are not searched for it
_SIGNS = {"birthdate": BORN, "passport": ["passport"], "ipv6": [":"]}
_TITLE_PARTS = tuple(t for names in TITLES.values() for t in names)
_GIVEN_WORDS = {n for names in GIVEN.values() for n in names}
_GIVEN_WORDS |= {n.upper() for n in _GIVEN_WORDS} | {n.lower() for n in _GIVEN_WORDS}


def script_of(word: str) -> str:
    """Latin, cyrillic, greek or han, by the first letter; latin for any other."""
    name = unicodedata.name(next((c for c in word if c.isalpha()), "a"), "")
    for start, script in (("CYRILLIC", "cyrillic"), ("GREEK", "greek"), ("CJK", "han")):
        if name.startswith(start):
            return script
    return "latin"


def _luhn(digits: str) -> str:
    """The check digit for the digits before it."""
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c) * (2 if k % 2 == 0 else 1)
        total += d - 9 if d > 9 else d
    return str(-total % 10)


def _emails(text: str) -> Iterator[tuple[int, int, int]]:
    """(start, place of the @, end) of each address, looked for outwards from the @, so that long
    runs of letters cost no more than they are long."""
    floor = 0
    for m in _AT_DOMAIN.finditer(text):
        start = at = m.start()
        while start > floor and (text[start - 1].isalnum() or text[start - 1] in "_.+%-"):
            start -= 1
        if start < at:
            yield start, at, m.end()
            floor = m.end()


def _ipv6(text: str) -> str | None:
    """The short form of an address; None for times, scopes and the like."""
    if not any(c.isdigit() for c in text) or len(text) < 6:
        return None
    try:
        return ipaddress.IPv6Address(text).compressed
    except ValueError:
        return None


def _canonical(kind: str, text: str) -> str | None:
    if kind == "ipv4":
        return text
    if kind == "ipv6":
        return _ipv6(text)
    if kind == "birthdate":
        return re.sub(r"[/.]", "-", text)
    return re.sub(r"[^A-Za-z0-9+]", "", text)


def _name_words(text: str, word: re.Match | None) -> list[tuple[int, str]]:
    """(start, word) of the capitalised words from a match of a first word on."""
    words = []
    while word and word["first"][0].isupper():
        w = _OWNER.sub("", word["first"])
        words.append((word.start("first"), w))
        word = _NEXT.match(text, word.end("first")) if w == word["first"] else None
    return words


def _entities(words: list[tuple[int, str]], gender: str) -> list[tuple[int, int, str, str]]:
    """The mentions that the words of one name are."""
    first = _GENDER.get(words[0][1].casefold())
    out = []
    for k, (at, w) in enumerate(words):
        script = script_of(w)
        given = (k == 0 and len(words) > 1) or w.casefold() in _GENDER
        sex = _GENDER.get(w.casefold(), gender or first or "m")
        entity = f"{script}:{sex}:{w.casefold()}" if given else f"{script}::{w.casefold()}"
        out.append((at, at + len(w), "given" if given else "surname", entity))
    return out


def _bare(text: str, known: dict) -> Iterator[tuple[int, int, object]]:
    """(start, end, what) of capitalised words of known names, whole or as parts of a word."""
    for m in re.finditer(r"[^\W\d_]+(?:[’'-][^\W\d_]+)*", text):
        for part in [m] if m[0].casefold() in known else _LETTERS.finditer(text, *m.span()):
            what = known.get(part[0].casefold())
            if what and part[0][0].isupper():
                yield (*part.span(), what)


def _shaped(text: str) -> list[tuple[int, int, str, str, str | None]]:
    """What is a name if the words of its run occur nowhere in lower case: for each word of a run
    (0, 0, kind, entity, run in lower case), and for each place where such a word stands (start,
    end, "place", word in lower case, None)."""
    claims: set[tuple[int, int, str, str, str]] = set()
    known: dict[str, str] = {}
    for m in _RUN.finditer(text):
        at = m.start()
        if at and (text[at - 1].isalnum() or text[at - 1] in "_’'-"):
            continue
        words = [(at, w) for w in m[0].split(" ")]
        if len(words) > 4:  # a heading
            continue
        # the first word of a sentence is capitalised in any case
        for part in (words, words[1:]) if _BEGINS.search(text, max(0, at - 3), at) else (words,):
            part = [(at, _OWNER.sub("", w)) for at, w in part]
            plain = [w.casefold() for _, w in part]
            if (
                len(part) > 1
                and len(set(plain)) == len(part)
                and NO_NAMES.isdisjoint(plain)
                and not any(w.isupper() for _, w in part)
            ):
                run = " ".join(plain)
                claims |= {(0, 0, kind, entity, run) for *_, kind, entity in _entities(part, "")}
                known.update(zip(plain, plain, strict=True))
    if not known:
        return []
    inside = _INSIDE.findall(text)
    if len(inside) >= 20 and sum(w[0].isupper() for w in inside) > MOST_CAPITALS * len(inside):
        return []
    return sorted(claims) + [(a, b, "place", word, None) for a, b, word in _bare(text, known)]


def detect(text: str) -> list[tuple[int, int, str, str]]:
    """(start, end, kind, entity) of each mention that is certain from its text alone, in order
    and without overlaps. Entities are in canonical form: digits only, lower case, name words with
    script and gender. A name runs over all its capitalised words, and its words are mentions
    elsewhere in the text too. What an earlier kind has taken is masked, so that no later match
    runs into it."""
    return _detect(text)[0]


def _detect(text: str) -> tuple[list[tuple[int, int, str, str]], list[tuple[int, int, str, str, str | None]]]:
    """Certain mentions, and what hangs on the corpus (``_shaped``)."""
    found: list[tuple[int, int, str, str]] = []

    def masked(spans: list[tuple[int, int]]) -> str:
        out, at = [], 0
        for a, b in sorted(spans):
            out += [text[at:a], "_" * (b - a)]
            at = b
        return "".join([*out, text[at:]])

    taken = []
    for start, at, end in _emails(text):
        taken.append((start, end))
        found.append((start, at, "mailbox", text[start:at].lower()))
        found.append((at + 1, end, "domain", text[at + 1 : end].lower()))
    if taken:
        text = masked(taken)
    has_digit = any(d in text for d in "0123456789")
    low = text.lower()
    for kind, pattern in _KINDS if has_digit else ():
        if kind in _SIGNS and not any(sign in low for sign in _SIGNS[kind]):
            continue
        taken = []
        for m in pattern.finditer(text):
            part = "what" if "what" in pattern.groupindex else 0
            if canon := _canonical(kind, m[part]):
                taken.append(m.span(part))
                found.append((*m.span(part), kind, canon))
        if taken:
            text = masked(taken)
    if any(t in text for t in HAN_TITLES):
        taken, names = [], {}
        for m in _HAN.finditer(text):
            taken.append(m.span())
            found.append((*m.span("family"), "surname", f"han::{m['family']}"))
            if m["given"]:
                found.append((*m.span("given"), "given", f"han:{HAN_TITLES[m['title']]}:{m['given']}"))
                names.setdefault(m["family"] + m["given"], found[-2:])
        if taken:
            text = masked(taken)
        if names:
            taken = []
            for m in re.finditer("|".join(map(re.escape, sorted(names, key=len, reverse=True))), text):
                taken.append(m.span())
                family, given = names[m[0]]
                found.append((m.start(), m.start() + 1, *family[2:]))
                found.append((m.start() + 1, m.end(), *given[2:]))
            text = masked(taken)
    taken, known = [], {}
    if any(t in text for t in _TITLE_PARTS) or not _GIVEN_WORDS.isdisjoint(re.split(r"\W+", text)):
        pos = 0
        while m := _PERSON.search(text, pos):
            words, title = _name_words(text, m), m["title"]
            if not words:
                pos = m.start() + 1
                continue
            pos = words[-1][0] + len(words[-1][1])
            if title is None and (words[0][1].casefold() not in _GENDER or len(words) < 2):
                continue
            found += (new := _entities(words, _TITLE.get((title or "").casefold(), "")))
            taken += [x[:2] for x in new]
            for (*_, kind, entity), (_, w) in zip(new, words, strict=True):
                known.setdefault(w.casefold(), (kind, entity))
        text = masked(taken)
    if any(sign in low for sign in INTRODUCED):
        taken = []
        for m in _INTRODUCED.finditer(text):
            words = _name_words(text, m)
            if words and len(words) <= 4 and NO_NAMES.isdisjoint(w.casefold() for _, w in words):
                found += (new := _entities(words, ""))
                taken += [x[:2] for x in new]
                for (*_, kind, entity), (_, w) in zip(new, words, strict=True):
                    known.setdefault(w.casefold(), (kind, entity))
        text = masked(taken)
    if known:
        bare = [(a, b, *what) for a, b, what in _bare(text, known)]
        found += bare
        text = masked([x[:2] for x in bare])
    return sorted(found), _shaped(text)


class _Stream:
    """Keyed numbers that depend on the entity and the attempt."""

    def __init__(self, key: str, kind: str, entity: str, attempt: int) -> None:
        self.mac = hmac.new(key.encode(), f"{kind}\0{entity}\0{attempt}".encode("utf-8", "replace"), hashlib.sha256)
        self.n = 0

    def below(self, n: int) -> int:
        mac = self.mac.copy()
        mac.update(self.n.to_bytes(8, "big"))
        self.n += 1
        return int.from_bytes(mac.digest(), "big") % n


def _alike(text: str, draw: _Stream) -> str:
    """Other letters and digits in the places of letters and digits, of the same script."""
    alphabets = {"latin": "abcdefghijklmnopqrstuvwxyz", "cyrillic": "абвгдежзиклмнопрстуфхцчшэюя", "greek": "αβγδεζηθικλμνξοπρστυφχψω"}
    out = []
    for c in text:
        if c.isdigit():
            out.append(str(draw.below(10)))
        elif c.isalpha():
            letters = alphabets.get(script_of(c)) or SYLLABLES["han"]
            out.append(letters[draw.below(len(letters))])
        else:
            out.append(c)
    return "".join(out)


def surrogate(kind: str, entity: str, attempt: int, key: str) -> str:
    """The replacement of an entity, in canonical form. Later attempts have more room."""
    draw = _Stream(key, kind, entity, attempt)
    if kind in ("given", "surname"):
        script, sex, word = entity.split(":", 2)
        listed = GIVEN.get((script, sex), []) if kind == "given" else SURNAMES.get(script, [])
        if attempt == 0 and listed and script != "han":
            return f"{script}:{sex}:{listed[draw.below(len(listed))].casefold()}"
        if script == "han":
            if kind == "surname" and attempt < 4:
                return f"han::{listed[draw.below(len(listed))]}"
            size = max(1, len(word)) + attempt // 4
            return f"han:{sex}:" + "".join(SYLLABLES["han"][draw.below(len(SYLLABLES["han"]))] for _ in range(size))
        parts = SYLLABLES[script]
        made = "".join(parts[draw.below(len(parts))] for _ in range(2 + attempt // 2))
        return f"{script}:{sex}:{made}{GENDER_END[(script, sex or 'm')]}"
    if kind == "ipv6":
        first = ipaddress.IPv6Address(entity).exploded[:4]  # the kind of network stays
        return ipaddress.IPv6Address(":".join([first, *(f"{draw.below(65536):x}" for _ in range(7))])).compressed
    if kind == "birthdate":
        parts = entity.split("-")
        year = str(1930 + draw.below(80 + 20 * attempt))
        # where day and month may be either way round, both are at most 12
        first, second = 1 + draw.below(12), 1 + draw.below(28 if len(parts[0]) == 4 else 12)
        rest = [f"{n:0{len(x)}}" for n, x in zip((first, second), parts[1:] if len(parts[0]) == 4 else parts, strict=False)]
        return "-".join([year, *rest] if len(parts[0]) == 4 else [*rest, year])
    if kind == "domain":
        *labels, top = entity.split(".")
        if labels[-1:] == ["example"] and len(labels) > 1:  # a reserved name stays reserved
            *labels, name = labels
            top = f"{name}.{top}"
        return ".".join([*(_alike(x, draw) + "x" * (attempt // 4) for x in labels), top])
    if kind == "mailbox":
        return _alike(entity, draw) + "x" * (attempt // 4)
    if kind == "ipv4":
        first, *rest = entity.split(".")
        keep = 1 if entity.startswith("192.168.") else 0
        if keep and attempt >= 4:  # that range is small; another private one has room
            first, keep = "10", 0
        private = entity.startswith(("10.", "192.168.", "127.")) and attempt < 12
        head = first if private else str(1 + draw.below(223))
        return ".".join([head, *rest[:keep], *(str(1 + draw.below(254)) for _ in rest[keep:])])
    out = []
    lead = 0
    if kind == "phone" and entity.startswith("+"):
        lead = 2 if len(entity) <= 12 and entity[1] in "17" else 3  # the country code stays
    if kind == "iban":
        lead = 2
    if kind == "card":
        lead = 1
    for k, c in enumerate(entity):
        if k < lead or not c.isalnum():
            out.append(c)
        elif c.isdigit():
            out.append(str(1 + draw.below(9) if c != "0" and k == lead else draw.below(10)))
        else:
            out.append(chr((65 if c.isupper() else 97) + draw.below(26)))
    # short numbers get more digits, all others only when very many attempts have failed
    out += [str(draw.below(10)) for _ in range(attempt // 4 if kind == "phone" else attempt // 12)]
    made = "".join(out)
    if kind == "card" and _luhn(entity[:-1]) == entity[-1]:
        made = made[:-1] + _luhn(made[:-1])
    return made


def rendered(mention: str, kind: str, made: str) -> str:
    """The surrogate in the format of the mention: its separators, its case."""
    if kind in ("given", "surname"):
        word = made.split(":", 2)[2]
        if mention.isupper() and len(mention) > 1:
            return word.upper()
        return word[:1].upper() + word[1:] if mention[:1].isupper() else word
    if kind in ("mailbox", "domain"):
        return made.upper() if mention.isupper() else made
    if kind == "ipv4":
        return made
    if kind == "ipv6":
        return made.upper() if mention.isupper() else made
    if kind == "birthdate":
        return made.replace("-", next(c for c in mention if not c.isdigit()))
    rest = iter(made)
    out = "".join(next(rest, "") if c.isalnum() or c == "+" else c for c in mention)
    return out + "".join(rest)


MENTIONS = "key long, start int, end int, kind string, entity string, run string"


def _mentions(rows: DataFrame) -> DataFrame:
    """Certain mentions, the claims of runs (with ``run``) and the places of their words (of the
    kind "place"). Rows of the kind "lower" are words that occur in lower case, at least once for
    each task that has them."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tokens: set[str] = set()
        for batch in batches:
            out: list[tuple] = []
            for key, text in zip(batch["key"], batch["text"], strict=True):
                certain, shaped = _detect(text)
                out += [(key, *m, None) for m in certain]
                out += [(key, *m) for m in shaped]
                new = set(text.split()) - tokens
                words = {w for t in new if len(w := t.strip(_MARKS)) <= 30 and w.islower() and w.isalpha()}
                out += [(0, 0, 0, "lower", w, None) for w in words]
                tokens |= new
                if len(tokens) > REMEMBERED:
                    tokens.clear()
            yield pd.DataFrame(out, columns=["key", "start", "end", "kind", "entity", "run"])

    return rows.select("key", "text").mapInPandas(run, MENTIONS)


def _settled(found: DataFrame, scratch: Scratch) -> DataFrame:
    """(key, start, end, kind, entity), written: the certain mentions, and the words of runs that
    occur nowhere in lower case. A word that several such runs of a text claim is one entity, the
    smallest claim."""
    plain = ["key", "start", "end", "kind", "entity"]
    certain = found.where("run is null and kind not in ('lower', 'place')").select(*plain).distinct()
    shaped = found.where("run is not null")
    if shaped.isEmpty():
        return scratch.write(certain)
    runs = scratch.write(shaped.select("run").distinct())
    words = runs.select("run", F.explode(F.split("run", " ")).alias("word"))
    lower = found.where("kind = 'lower'").select(F.col("entity").alias("word")).distinct()
    ordinary = scratch.write(words.select("word").distinct().join(lower, "word", "left_semi"))
    out = spread_join(words, ordinary, ["word"], "inner").select("run").distinct()
    names = scratch.write(runs.join(out, "run", "left_anti"))
    word = F.substring_index("entity", ":", -1).alias("word")
    claims = (
        spread_join(shaped, names, ["run"], "inner")
        .groupBy("key", word)
        .agg(F.min(F.struct("kind", "entity")).alias("least"))
    )
    places = found.where("kind = 'place'").select("key", "start", "end", F.col("entity").alias("word"))
    named = places.distinct().join(claims, ["key", "word"]).select("key", "start", "end", "least.*")
    mentions = scratch.write(certain.unionByName(named))
    scratch.drop(runs, ordinary, names)
    return mentions


def _written(value: str) -> tuple[Column, Column]:
    """What distinctness is about: the word as it is written, for names of any kind, script and
    sex in one space; other kinds have a space each."""
    name = F.col("kind").isin("given", "surname")
    word = F.element_at(F.split(F.col(value), ":", 3), 3)
    space = F.when(name, F.lit("name")).otherwise(F.col("kind"))
    return space.alias("space"), F.when(name, word).otherwise(F.col(value)).alias("written")


def assign(entities: DataFrame, key: str, scratch: Scratch) -> DataFrame:
    """(kind, entity, made): surrogates for distinct (kind, entity) that are written differently,
    and none of them as an entity is. Each round settles the smallest entity of every contested
    surrogate that is free. Rooms grow with the attempts (longer words and numbers, wider address
    ranges), so the rounds end; after MOST_ROUNDS there is an error."""

    def make(attempt: int):
        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                out = batch[["kind", "entity"]].copy()
                pairs = zip(batch["kind"], batch["entity"], strict=True)
                out["made"] = [surrogate(k, e, attempt, key) for k, e in pairs]
                yield out

        return run

    schema = "kind string, entity string, made string"
    waiting, settled = entities, None
    for attempt in range(MOST_ROUNDS):
        tried = scratch.write(
            waiting.select("kind", "entity").mapInPandas(make(attempt), schema)
        )
        used = entities.select(*_written("entity"))
        if settled is not None:
            used = used.unionByName(settled.select(*_written("made")))
        won = (
            tried.select("kind", "entity", "made", *_written("made"))
            .groupBy("space", "written")
            .agg(F.min(F.struct("kind", "entity", "made")).alias("first"))
            .join(used, ["space", "written"], "left_anti")
            .select("first.*")
        )
        won = scratch.write(won)
        settled = won if settled is None else settled.unionByName(won)
        lost = tried.join(won, ["kind", "entity"], "left_anti").select("kind", "entity")
        before, waiting = waiting, scratch.write(lost)
        scratch.drop(tried, *([before] if attempt else []))
        if waiting.isEmpty():
            return settled
    raise RuntimeError(f"entities without a surrogate after {MOST_ROUNDS} rounds")


def replace_personal_data(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", key: str = DEFAULT_KEY
) -> DataFrame:
    """One row per row of ``docs``: id, text with surrogates, n_entities (mentions replaced) and
    spans ("kind:start:end" in the original text, comma-joined).

    Names known by their shape only hang on the whole table: a run of capitalised words is one if
    none of its words occurs in lower case in any text.
    A null text becomes an empty one; texts without personal data stay as they are. Rows that
    repeat identifier and text get equal results; an empty table gives an empty result.
    """
    scratch = Scratch(docs.sparkSession)
    rows = docs.select(
        F.col(f"`{id_col}`").alias("id"), whole_text(f"`{text_col}`").alias("text")
    ).withColumn("key", F.xxhash64("id", "text"))
    found = scratch.write(_mentions(rows))
    mentions = _settled(found, scratch)
    scratch.drop(found)
    entities = scratch.write(mentions.select("kind", "entity").distinct())
    made = assign(entities, key, scratch)
    # one mail domain or name may hold many of all mentions
    met = spread_join(mentions, scratch.write(made), ["kind", "entity"], "inner")
    spots = met.groupBy("key").agg(
        F.array_sort(F.collect_list(F.struct("start", "end", "kind", "made"))).alias("spots")
    )
    spots = scratch.write(spots)
    keys = scratch.write(spots.select("key"))
    few = keys.count() <= 500_000  # counted from a written table; longer lists are shuffled
    listed = F.broadcast(keys) if few else keys

    def swap(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts, spans = [], []
            for text, spots in zip(batch["text"], batch["spots"], strict=True):
                out, at = [], 0
                for s in spots:
                    out += [text[at : s["start"]], rendered(text[s["start"] : s["end"]], s["kind"], s["made"])]
                    at = s["end"]
                texts.append("".join([*out, text[at:]]))
                spans.append(",".join(f"{s['kind']}:{s['start']}:{s['end']}" for s in spots))
            yield pd.DataFrame(
                {"id": batch["id"], "text": texts, "n_entities": batch["spots"].str.len(), "spans": spans}
            )

    kind = rows.schema["id"].dataType.simpleString()
    with_data = semi_join_listed(rows, keys, "key").join(spots, "key").select("id", "text", "spots")
    changed = with_data.mapInPandas(swap, f"id {kind}, text string, n_entities long, spans string")
    same = rows.join(listed, "key", "left_anti").select(
        "id", "text", F.lit(0).cast("long").alias("n_entities"), F.lit("").alias("spans")
    )
    return changed.unionByName(same).withColumnRenamed("id", id_col)
