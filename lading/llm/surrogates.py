"""Replacing personal data and secrets by surrogates.

Entities are found in every text, their distinct values get surrogates drawn with a
secret key, and each occurrence is replaced. A surrogate has the kind, script, gender and
format of what it replaces. Equal values get equal surrogates in all texts, different values
different ones, and none equals a value that really occurs: both are checked over the
whole table, for all names together, and whoever fails draws again. What draws often grows, so that every
value finds a surrogate. A name is one value whatever title it stands with; if its titles show
one gender anywhere in the table, the surrogate has that gender everywhere.
"""

from __future__ import annotations

import functools
import hashlib
import ipaddress
import re

import ahocorasick
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lading.llm.common import discarded, stored

# Draws after which a surrogate may leave the narrow format of its value.
NARROW_DRAWS = 6

# Titles by gender, given names by script and gender.
TITLES = {
    "m": ["Mr", "Sir", "Lord", "Herr", "Monsieur", "Señor", "Sr", "г-н", "господин"],
    "f": [
        "Mrs", "Ms", "Miss", "Madam", "Lady", "Frau", "Madame", "Mme", "Mademoiselle", "Señora", "Sra", "г-жа", "госпожа",
    ],
    "n": ["Dr", "Doctor", "Prof", "Professor"],
}
GIVEN = {
    ("latin", "m"): ["Adrian", "Bruno", "Carl", "David", "Emil", "Felix", "Jonas", "Leon", "Marco", "Oscar"],
    ("latin", "f"): ["Anna", "Clara", "Diana", "Elena", "Flora", "Ida", "Julia", "Laura", "Maria", "Nora"],
    ("latin", "n"): ["Alex", "Andrea", "Chris", "Dominique", "Kim", "Luca", "Robin", "Sam", "Sascha", "Toni"],
    ("cyrillic", "m"): ["Антон", "Борис", "Виктор", "Глеб", "Иван", "Лев", "Олег", "Павел"],
    ("cyrillic", "f"): ["Алла", "Вера", "Дарья", "Ирина", "Лидия", "Мария", "Нина", "Ольга"],
    ("cyrillic", "n"): ["Женя", "Саша", "Валя", "Слава"],
    ("greek", "m"): ["Άρης", "Γιώργος", "Νίκος", "Πέτρος"],
    ("greek", "f"): ["Άννα", "Ελένη", "Μαρία", "Σοφία"],
    ("greek", "n"): ["Άλεξ", "Χρύσα"],
}
LETTERS = {
    "latin": ("bdfgklmnprstv", "aeiou"),
    "cyrillic": ("бвгдклмнпрст", "аеиоу"),
    "greek": ("βγδκλμνπρστ", "αειου"),
}

# What introduces a name, in small letters or with a capital first one. After the first kind one
# word is enough, after the second two are needed.
INTRODUCED = [
    "my name is", "i am called", "mein name ist", "ich heiße", "je m'appelle", "me llamo", "mi nombre es", "меня зовут",
    "sincerely yours", "yours sincerely", "best regards", "kind regards", "mit freundlichen Grüßen", "cordialement",
]
FIELDS = ["full name", "name", "contact", "attn", "signed", "signed by", "patient", "customer", "author", "Ansprechpartner", "nom"]

# What tells that a number without a valid check sum is a card's all the same.
CARD_WORDS = re.compile(r"(?i)(?:card|visa|amex|credit|kredit|carte|tarjeta|карт)[^0-9]{0,24}\Z")

# What stands for a missing secret.
NO_SECRETS = frozenset(
    "unknown none null true false required optional undefined empty hidden missing invalid expired valid redacted".split()
)

# Titles that are also found in capitals.
IN_CAPITALS = ["Mr", "Mrs", "Ms", "Dr", "Prof", "Sir", "Herr", "Frau"]
_TITLES = [t for titles in TITLES.values() for t in titles] + [t.upper() for t in IN_CAPITALS]
_TITLE = "|".join(re.escape(t) for t in sorted(_TITLES, key=len, reverse=True))
_NAME = r"[^\W\d_a-zà-öø-ÿа-яα-ω][^\W\d_]+(?:-[^\W\d_]+)?"
_INTRODUCED, _FIELDS = (
    [form for word in words for form in dict.fromkeys((word, word[0].upper() + word[1:]))] for words in (INTRODUCED, FIELDS)
)


def _choice(words: list[str]) -> str:
    return "|".join(re.escape(word) for word in sorted(words, key=len, reverse=True))


_OCTET = r"(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[1-9]?[0-9])"
_HEX = "[0-9A-Fa-f]{1,4}"
# Telephone numbers: with 00 or a trunk zero, in five pairs, and ten digits as 3-3-4 with spaces.
_NATIONAL_PHONES = (
    r"(?<![0-9][ .,/-])(?![0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-]))(?:"
    r"(?=[0-9](?:[ ./-]?[0-9]){8,15}(?![0-9]))00[1-9][0-9]{0,2}(?:[ ./-][0-9]{1,8}){1,5}"
    r"|(?=[0-9](?:[ /-]?[0-9]){8,12}(?![0-9]))0[1-9][0-9]{1,3}(?:[ /-][0-9]{2,8}){1,4}"
    r"|0[1-9](?P<pair>[ .-])[0-9]{2}(?:(?P=pair)[0-9]{2}){3}(?![ .-][0-9])"
    r"|(?:1[ ])?[2-9][0-9]{2}[ ][0-9]{3}[ ][0-9]{4}(?![ ][0-9])"
    r")(?![A-Za-z0-9]|[.,/-][0-9])"
)
_SECRET_KEY = (
    r"(?:pass[_-]?word|passwd|pass[_-]?phrase|pwd|secret(?:[_-]?(?:access[_-]?)?key)?|token|authorization"
    r"|(?:api|access|private|auth|encryption|account|shared)[_-]?key)"
)
# Quoted values end at their quote, others at white space, a double quote or East Asian text.
_OPEN = "[^\\s\"\u3000-\u30ff\u4e00-\u9fff\uff00-\uffef]"
_SECRET_END = r"(?<![.,;:!?)\]}>'])"

# In this order: what an earlier pattern takes, a later one does not see.
PATTERNS = {
    "email": r"(?<![A-Za-z0-9.+_%-])[A-Za-z0-9][A-Za-z0-9._%+-]{0,63}"
    r"@(?:[A-Za-z0-9-]{1,63}\.)+[A-Za-z]{2,24}(?![A-Za-z0-9-])",
    "key": r"(?<![A-Za-z0-9])AKIA[A-Z0-9]{16}(?![A-Za-z0-9])",
    "secret": rf"(?i:{_SECRET_KEY}\\?[\"']?[ \t]{{0,4}}(?::=|=>|=(?!=)|:(?!:))[ \t]{{0,4}}(?:(?:bearer|basic)[ \t]+)?)"
    r"(?:\"(?P<double>(?:[^\"\\\n]|\\.){4,})\"|'(?P<single>(?:[^'\\\n]|\\.){4,})'"
    rf"|\\?[\"']?(?P<open>(?![\"'=]){_OPEN}{{4,}}{_SECRET_END}))",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
    "ip": rf"(?<![0-9.]){_OCTET}(?:\.{_OCTET}){{3}}(?![0-9]|\.[0-9])",
    "ip6": r"(?<![\w:.])(?=[A-Fa-f:]*[0-9])"
    rf"(?:(?:{_HEX}:){{7}}{_HEX}|(?=[0-9A-Fa-f:]*[0-9A-Fa-f]{{3}})(?:(?:{_HEX}:){{1,6}}(?::{_HEX}){{1,6}}|(?:{_HEX}:){{2,7}}:))"
    r"(?![\w:]|\.[0-9])",
    "phone": r"(?<![A-Za-z0-9+])(?:"
    r"(?:\+[0-9]{1,3}[ .-]?(?:\([0-9]{1,4}\)|[0-9]{1,4})|\([0-9]{2,4}\)|[0-9]{3}(?=[.-][0-9]{3}[.-]))"
    rf"(?:[ .-]?[0-9]{{2,4}}){{2,4}}(?![A-Za-z0-9])|{_NATIONAL_PHONES})",
    "national": r"(?<![A-Za-z0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![A-Za-z0-9-])",
    "card": r"(?<![A-Za-z0-9.-])[0-9](?:[ -]?[0-9]){12,18}(?![A-Za-z0-9]|[.-][0-9])",
}
FOUND = re.compile("|".join(f"(?P<{kind}>{pattern})" for kind, pattern in PATTERNS.items()))
# Names, looked for only where a title or words that introduce one occur.
NAMES = re.compile(
    rf"(?<!\w)(?:(?:(?:{_TITLE})\.?[ ]){{1,3}}(?:{_NAME})(?:[ ]{_NAME})?"
    rf"|(?:{_choice(_INTRODUCED)})[,:]?\s{{1,3}}{_NAME}(?:[ ]{_NAME})?(?!\w)"
    rf"|(?:{_choice(_FIELDS)})[ ]?:[ \t]{{0,4}}{_NAME}[ ]{_NAME}(?!\w))"
)
_NAME_PARTS = re.compile(rf"(?P<one>{_NAME})(?:[ ](?P<two>{_NAME}))?\Z")
_LEAD = re.compile(
    rf"(?P<titles>(?:(?:{_TITLE})\.?[ ])+)|(?:{_choice(_INTRODUCED)})[,:]?\s+|(?:{_choice(_FIELDS)})[ ]?:[ \t]*"
)
_GENDER = {form: gender for gender, titles in TITLES.items() for t in titles for form in (t, t.upper())}
_GIVEN_GENDER = {name: gender for (_, gender), names in GIVEN.items() for name in names}

_NAME_MARKS = [
    *(f"{title}{end}" for title in _TITLES for end in (" ", ". ")),
    *_INTRODUCED,
    *(f"{field}{end}" for field in _FIELDS for end in (":", " :")),
]

# Every text with an entity that is no name has one of these signs or begins a key, every one with a name has one of
# the marks (fields have a colon); the others are not looked at further.
SIGNS = r"[0-9@=:]|AKIA"
_WORDS = [*_TITLES, *(word[1:] for word in INTRODUCED)]
MARKS = [word for word in _WORDS if not any(other in word for other in _WORDS if other != word)]
_SIGNS = re.compile(SIGNS)


@functools.cache
def name_marks() -> ahocorasick.Automaton:
    """What one of which is in every text with a name that ``NAMES`` finds."""
    found = ahocorasick.Automaton()
    for mark in _NAME_MARKS:
        found.add_word(mark, True)
    found.make_automaton()
    return found


def script_of(word: str) -> str:
    first = ord(word[0])
    return "greek" if 0x370 <= first < 0x400 else "cyrillic" if 0x400 <= first < 0x530 else "latin"


def entities(text: str) -> list[tuple[int, int, str, str]]:
    """(start, end, kind, value) of what is to be replaced, in order, without overlaps.

    Values are in one spelling, so that one person, number or address has one value: lower
    case for addresses and names, digits alone for numbers. A name is found after a title or words that
    introduce one, then also where it stands alone in the same text.
    """
    return [found[:4] for found in formed_entities(text)]


def formed_entities(text: str) -> list[tuple[int, int, str, str, str]]:
    """As ``entities``, with the form that the place shows: of a name whether it is a given one, and the gender."""
    found = []
    for match in FOUND.finditer(text) if _SIGNS.search(text) else ():
        kind, start, end = match.lastgroup, match.start(), match.end()
        value = match[0]
        if kind == "secret":
            start, end = match.span(next(g for g in ("double", "single", "open") if match[g] is not None))
            value = text[start:end]
        elif kind == "email":
            value = value.lower()
        elif kind == "iban":
            value = value.replace(" ", "")
        elif kind == "ip6":
            try:
                value = ipaddress.IPv6Address(value).compressed
            except ValueError:
                value = value.lower()
        elif kind in ("phone", "card", "national"):
            value = re.sub(r"[^0-9+]", "", value)
        if kind == "card" and luhn(value) and not CARD_WORDS.search(text, max(0, start - 40), start):
            continue
        if kind == "secret" and match["open"] is not None and value.isalpha():
            key = text[match.start() : start].lower()
            if value.lower() in NO_SECRETS or (value.islower() and not key.startswith("pass") and "pwd" not in key):
                continue
        found.append((start, end, kind, value, ""))
    if next(name_marks().iter(text), None):
        named = list(_named(text))
        found = _merged(found, named)
        forms = {text[start:end]: form for start, end, _, _, form in reversed(named)}
        if forms:
            alone = re.compile(r"(?<!\w)(?:" + "|".join(map(re.escape, sorted(forms))) + r")(?!\w)")
            again = (
                (m.start(), m.end(), f"name:{script_of(m[0])}", m[0].lower(), forms[m[0]]) for m in alone.finditer(text)
            )
            found = _merged(found, again)
    return found


def _named(text: str):
    """The parts of names that stand with a title or an introduction."""
    for match in NAMES.finditer(text):
        start, end = match.span()
        lead = _LEAD.match(text, start, end)
        gender = "n"
        if lead:
            shown = [_GENDER[t.rstrip(".")] for t in (lead["titles"] or "").split()]
            gender = next((g for g in shown if g != "n"), "n")
        parts = _NAME_PARTS.match(text, lead.end() if lead else start, end)
        if parts is None:
            continue
        for group in ("one", "two"):
            if parts[group] is None:
                continue
            name = parts[group]
            # A gender shows in given names only.
            given = group == "one" and parts["two"]
            form = f"given:{_GIVEN_GENDER.get(name, 'n') if gender == 'n' else gender}" if given else "family"
            yield (*parts.span(group), f"name:{script_of(name)}", name.lower(), form)


def _merged(first: list, then) -> list:
    """Both in order; of those in ``then`` only what touches none in ``first``."""
    kept, at = [], 0
    for entity in then:
        while at < len(first) and first[at][1] <= entity[0]:
            at += 1
        if at == len(first) or first[at][0] >= entity[1]:
            kept.append(entity)
    return sorted(first + kept)


class _Draws:
    """A stream of numbers from the key, the value and the number of the attempt."""

    def __init__(self, key: bytes, kind: str, value: str, attempt: int) -> None:
        self.seed = hashlib.blake2b(f"{kind}\0{value}\0{attempt}".encode(), key=key).digest()
        self.block, self.state, self.left = 0, 0, 0

    def below(self, n: int) -> int:
        if self.left < 1 << 64:
            digest = hashlib.blake2b(self.seed + self.block.to_bytes(8, "little")).digest()
            self.state, self.left, self.block = int.from_bytes(digest, "little"), 1 << 512, self.block + 1
        self.state, chosen = divmod(self.state, n)
        self.left //= n
        return chosen

    def pick(self, values):
        return values[self.below(len(values))]

    def like(self, text: str) -> str:
        """Digits for digits, letters for letters of the same case, signs as they are.

        Words of hexadecimal digits stay such.
        """
        lower = "abcdef" if re.fullmatch(r"[0-9a-f]+", text) else "abcdefghijklmnopqrstuvwxyz"
        made = []
        for c in text:
            if c.isdigit():
                made.append(self.pick("0123456789"))
            elif c.islower():
                made.append(self.pick(lower))
            else:
                made.append(self.pick(lower.upper()) if c.isupper() else c)
        return "".join(made)

    def plain(self, text: str) -> str:
        """As ``like``, with small letters from the whole alphabet."""
        letters, digits = "abcdefghijklmnopqrstuvwxyz", "0123456789"
        return "".join(
            self.pick(letters) if c.isalpha() else self.pick(digits) if c.isdigit() else c for c in text
        )

    def word(self, script: str, length: int) -> str:
        hard, soft = LETTERS[script]
        return "".join(self.pick(soft if i % 2 else hard) for i in range(length))


def luhn(digits: str) -> int:
    """The check sum of a card number, 0 if it is valid."""
    doubled = [int(d) * (1 + i % 2) for i, d in enumerate(reversed(digits))]
    return sum(d // 10 + d % 10 for d in doubled) % 10


def surrogate(key: bytes, kind: str, value: str, attempt: int, form: str = "") -> str:
    """The replacement that ``value`` draws at this attempt, in the spelling of values.

    From ``NARROW_DRAWS`` attempts on it grows with every one, so that there is room for all values of a form.
    """
    draw = _Draws(key, kind, value, attempt)
    if kind == "email":
        local, _, domain = value.partition("@")
        *hosts, top = domain.split(".")
        made = [draw.plain(part) for part in (local, *hosts)]
        if attempt >= NARROW_DRAWS:
            made[0] += draw.word("latin", 2 + attempt)
        return f"{made[0]}@{'.'.join([*made[1:], top])}"
    wide = attempt >= NARROW_DRAWS
    more = "".join(draw.pick("0123456789") for _ in range(attempt - NARROW_DRAWS + 1)) if wide else ""
    if kind == "ip" and attempt >= 3 * NARROW_DRAWS:
        # There are no more addresses of this length than some tables can hold.
        kind, value = "ip6", "::1"
    if kind == "ip":
        ranges = {1: (1, 9), 2: (10, 99), 3: (100, 254)}
        octets = [(1, 254) if wide else ranges[len(o)] for o in value.split(".")]
        return ".".join(str(low + draw.below(high - low + 1)) for low, high in octets)
    if kind == "ip6":
        # Digits but zero for digits, so that the short form stays as it is.
        if attempt >= NARROW_DRAWS:
            return ":".join(draw.pick("123456789") + "".join(draw.pick("123456789abcdef") for _ in range(3)) for _ in range(8))
        return "".join(
            c if c == ":" else draw.pick("123456789" if c.isdigit() else "abcdef") for c in value
        )
    if kind == "key":
        return "AKIA" + "".join(draw.pick("ABCDEFGHIJKLMNOPQRSTUVWXYZ234567") for _ in value[4:])
    if kind == "iban":
        return value[:2] + draw.like(value[2:]) + more
    if kind in ("phone", "card", "national"):
        head = 1 + len(re.match(r"\+?([17]|[0-9]{2})?", value)[0]) - 1 if value[0] == "+" else 0
        if kind == "phone" and not head:
            # What makes the form: 00 and a country, a trunk zero, no zero or one in front of ten digits.
            head = len(re.match(r"00[1-9]|0[1-9]|1[2-9](?=[0-9]{9}\Z)|[0-9]", value)[0])
        digits = value[:head] + draw.like(value[head:]) + more
        if kind == "card" and luhn(value) == 0:
            body = digits[:-1]
            digits = next(body + d for d in "0123456789" if luhn(body + d) == 0)
        return digits
    if kind == "secret":
        # Letters of other scripts become latin; values of signs alone, and crowded ones, grow.
        made = draw.like(re.sub(r"[^\W\d_a-zA-Z]", "x", value))
        return made + draw.word("latin", attempt) if attempt >= NARROW_DRAWS else made
    script, (role, _, gender) = kind.removeprefix("name:"), form.partition(":")
    if role == "given" and attempt < NARROW_DRAWS:
        return draw.pick(GIVEN[script, gender]).lower()
    # Names in the letters of the script; a feminine one ends in a vowel, a masculine one does not.
    length = max(4, min(len(value), 12)) + max(0, attempt - NARROW_DRAWS)
    made = draw.word(script, length + (length + (gender == "f")) % 2 if role == "given" else length)
    return made + (draw.pick(LETTERS[script][0]) if role == "given" and gender == "m" else "")


def shaped(original: str, kind: str, made: str) -> str:
    """The surrogate in the spelling of the occurrence it replaces."""
    if kind in ("phone", "card", "national", "iban"):
        rest = iter(made)
        spelled = "".join(next(rest, "") if c.isalnum() or c == "+" else c for c in original)
        return spelled + "".join(rest)
    if ":" in kind:
        return made.upper() if original.isupper() and len(original) > 1 else "-".join(
            p[:1].upper() + p[1:] for p in made.split("-")
        )
    if kind == "email":
        return made.upper() if original.isupper() else made
    return made


def _possible(text: Column) -> Column:
    some = text.rlike(SIGNS)
    for mark in MARKS:
        some = some | text.contains(mark)
    return some


def _found(docs: DataFrame) -> DataFrame:
    """Rows (text_key, kind, value, form): the distinct entities of every text that can have any."""

    def run(batches):
        for batch in batches:
            rows = []
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                rows += sorted({(key, *entity[2:]) for entity in formed_entities(text.as_py())})
            if rows:
                keys, *columns = zip(*rows, strict=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys, pa.int64()), *map(pa.array, columns)],
                    names=["text_key", "kind", "value", "form"],
                )

    return (
        docs.filter(_possible(F.col("text")))
        .select(F.xxhash64("text").alias("text_key"), "text")
        .mapInArrow(run, "text_key long, kind string, value string, form string")
        .distinct()
    )


def formed(found: DataFrame) -> DataFrame:
    """Rows (kind, value, form): every distinct value with the form that its places show together.

    A name is a given one if it is one anywhere; its gender is what titles show, none if they show both.
    """
    shows = {g: F.max(F.coalesce(F.col("form") == f"given:{g}", F.lit(False))) for g in "mfn"}
    seen = found.groupBy("kind", "value").agg(*(shows[g].alias(f"_{g}") for g in "mfn"))
    form = (
        F.when(F.col("_m") & ~F.col("_f"), "given:m")
        .when(F.col("_f") & ~F.col("_m"), "given:f")
        .when(F.col("_m") | F.col("_n"), "given:n")
        .when(F.col("kind").startswith("name:"), "family")
        .otherwise("")
    )
    return seen.select("kind", "value", form.alias("form"))


def assign(values: DataFrame, key: bytes) -> DataFrame:
    """Rows (kind, value, made): a surrogate for every distinct (kind, value, form).

    Each round draws for the values that are still open. A drawn surrogate is refused if it
    is itself a value of the table or held by a value settled before; of several values that
    draw the same one the smallest keeps it. The others draw again in the next round. Names of all kinds
    are checked together.
    """

    def draw(batches):
        for batch in batches:
            kinds, values_, forms, attempts = (batch.column(i).to_pylist() for i in range(4))
            made = [
                surrogate(key, kind, value, attempt, form)
                for kind, value, form, attempt in zip(kinds, values_, forms, attempts, strict=True)
            ]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(made, pa.string())],
                names=["kind", "value", "form", "attempt", "made"],
            )

    space = F.substring_index("kind", ":", 1).alias("space")
    settled = None
    open_ = values.select("kind", "value", "form", F.lit(0).alias("attempt"))
    real = values.select(space, F.col("value").alias("made"))
    waiting = None
    while True:
        drawn = stored(
            open_.mapInArrow(draw, "kind string, value string, form string, attempt int, made string"), "drawn"
        )
        held = real if settled is None else real.unionByName(settled.select(space, "made"))
        first = drawn.groupBy(space, "made").agg(F.min(F.struct("value", "kind")).alias("least"))
        good = stored(
            first.join(held.distinct(), ["space", "made"], "left_anti").select("least.kind", "least.value", "made"),
            "settled",
        )
        settled = good if settled is None else settled.unionByName(good)
        again = stored(
            drawn.join(good.select("kind", "value"), ["kind", "value"], "left_anti").select(
                "kind", "value", "form", (F.col("attempt") + 1).alias("attempt")
            ),
            "open",
        )
        discarded(drawn, *([] if waiting is None else [waiting]))
        if again.isEmpty():
            return settled
        open_ = waiting = again


def replaced(docs: DataFrame, key: bytes = b"lading-surrogates", counted: str | None = None) -> DataFrame:
    """``docs`` with the entities in text replaced; the other columns as they are.

    ``counted`` names a further column for the number of replaced occurrences. Null and empty
    texts stay as they are with none. Rows with the same text are replaced alike. Where there
    is a column n_chars it follows the text. The key decides all surrogates: the same
    key gives the same text again, so keep it as secret as the data.
    """
    pairs = stored(_found(docs), "entities")
    made = assign(stored(formed(pairs), "values"), key)
    # One row per text; its list is bounded by the text's own length.
    lists = stored(
        pairs.select("text_key", "kind", "value").distinct()
        .join(made, ["kind", "value"])
        .groupBy("text_key")
        .agg(F.collect_list(F.struct("kind", "value", "made")).alias("_pii_made")),
        "surrogates",
    )
    names, at = docs.columns, docs.columns.index("text")
    count_at = names.index("n_chars") if "n_chars" in names else None
    schema = docs.schema if counted is None else docs.withColumn(counted, F.lit(0)).schema

    def run(batches):
        for batch in batches:
            texts, numbers = [], []
            for text, known in zip(batch.column(at), batch.column(len(names)), strict=True):
                text, known = text.as_py(), known.as_py()
                numbers.append(0)
                if known:
                    lookup = {(k["kind"], k["value"]): k["made"] for k in known}
                    parts, end = [], 0
                    for start, stop, kind, value in entities(text):
                        parts += text[end:start], shaped(text[start:stop], kind, lookup[kind, value])
                        end, numbers[-1] = stop, numbers[-1] + 1
                    text = "".join([*parts, text[end:]])
                texts.append(text)
            columns = list(batch.columns[: len(names)])
            columns[at] = pa.array(texts, batch.column(at).type)
            if count_at is not None:
                changed = pa.array([n > 0 for n in numbers])
                lengths = pa.array([len(t) if n else None for t, n in zip(texts, numbers, strict=True)], pa.int64())
                old = columns[count_at]
                columns[count_at] = pa.compute.if_else(changed, lengths.cast(old.type), old)
            if counted is not None:
                columns.append(pa.array(numbers, pa.int32()))
            yield pa.RecordBatch.from_arrays(columns, names=schema.fieldNames())

    possible = _possible(F.col("text"))
    touched = (
        docs.filter(possible)
        .withColumn("_pii_key", F.xxhash64("text"))
        .join(lists, F.col("_pii_key") == F.col("text_key"), "left")
        .select(*names, "_pii_made")
        .mapInArrow(run, schema)
    )
    rest = docs.filter(~F.coalesce(possible, F.lit(False)))
    if counted is not None:
        rest = rest.withColumn(counted, F.lit(0))
    return touched.unionByName(rest)
