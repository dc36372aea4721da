"""Personal data replaced by surrogates of the same kind, form, script and gender.

Each part of an entity that can recur by itself (a name's given and family name, an address's
mailbox and domain, a number) is replaced by a keyed pseudorandom value of its normal form, so the same
person or number gets the same surrogate in every document.  All distinct originals of the corpus are
then checked: where two would get one surrogate, or one would get a value that occurs as an original, all but the first draw
again, until every surrogate is one original's alone.  Only the redrawn ones, normally few, are sent to
the documents that hold them.
"""

from __future__ import annotations

import hashlib
import hmac
import ipaddress
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flatweave.llm.common import kept_in_worker, map_batches, small_batches, staged

DEFAULT_KEY = b"example key: give your own"
MOST_ROUNDS = 64

# Forms of address and given names, by gender and script.
MALE_TITLES = ("Mr", "Sir", "Herr", "Herrn", "Monsieur", "M", "Señor", "Sr", "Don", "господин", "г-н")
FEMALE_TITLES = ("Mrs", "Ms", "Miss", "Madam", "Frau", "Madame", "Mme", "Mademoiselle", "Mlle", "Señora", "Señorita", "Sra", "Srta", "Doña", "госпожа", "г-жа")
NEUTRAL_TITLES = ("Dr", "Prof", "Professor", "Doctor", "Docteur", "Doktor", "Profesor", "Profesora")
GIVEN = {
    ("latin", "m"): "Adam Albert Bruno Carl Daniel David Emil Felix Frank George Hugo Ivan James Jean Jorge Karl Louis Lucas Luis Marco "
    "Martin Max Michael Oscar Otto Pablo Paul Pedro Peter Pierre Ralph Robert Simon Stefan Thomas Tomas Victor Walter William "
    "John Richard Joseph Charles Christopher Matthew Anthony Steven Andrew Kevin Edward Hans Klaus Jürgen Wolfgang Michel François "
    "José Carlos Juan Antonio Miguel".split(),
    ("latin", "f"): "Ada Agnes Alice Amelia Ana Anna Beatrice Bertha Carla Carmen Clara Diana Elena Elisa Emily Emma Eva Flora Frida "
    "Greta Helen Ida Irene Jane Julia Laura Lucia Maria Marie Marta Mary Nina Olivia Paula Rosa Sara Sofia Susan Teresa Vera "
    "Patricia Jennifer Linda Elizabeth Barbara Jessica Sarah Karen Nancy Lisa Sabine Monika Claudia Nathalie Isabelle Sophie Isabel".split(),
    ("cyrillic", "m"): "Александр Алексей Андрей Борис Виктор Дмитрий Иван Максим Михаил Николай Олег Павел Пётр Сергей Юрий".split(),
    ("cyrillic", "f"): "Александра Анна Вера Галина Дарья Елена Ирина Ксения Лидия Мария Наталья Ольга Полина Светлана Юлия".split(),
}
TLDS = ("com", "org", "net")

_KNOWN = {name.lower(): gender for (_, gender), names in GIVEN.items() for name in names}
_TITLE = "|".join(re.escape(title) for title in sorted((*MALE_TITLES, *FEMALE_TITLES, *NEUTRAL_TITLES), key=len, reverse=True))
_CAPITAL = r"[A-ZÀ-ÖØ-ÞА-ЯЁ][a-zß-öø-ÿа-яё]+(?:[-'’][A-ZÀ-ÖØ-ÞА-ЯЁ][a-zß-öø-ÿа-яё]+)?"
_SHOUTED = r"[A-ZÀ-ÖØ-Þ]{2,}(?:[-'’][A-ZÀ-ÖØ-Þ]{2,})?"
_SHOUTED_TITLE = "Mr|Mrs|Ms|Miss|Dr|Prof|Herr|Frau|Madame|Monsieur|Señor|Señora"
_GIVEN_WORDS = "|".join(sorted({name for names in GIVEN.values() for name in names}, key=len, reverse=True))

# In order of preference where two begin at one place.  Digits and letters must not go on outside a match.
PATTERNS = (
    ("email", r"(?<![\w.+-])[\w.+-]*\w@(?:[\w-]+\.)+[^\W\d_]{2,}(?!\w)"),
    ("secret", r"(?i:(?<![^\W\d_])bearer)\s+(?P<bearer_value>(?=[\w+/=.~-]*\d)[\w+/=.~-]{16,})"),
    ("secret", r"(?i:(?<![^\W\d_])(?:api[_-]?key|access[_-]?key|secret(?:[_-]?key)?|auth[_-]?token|token|password|passwd|pwd)['\"]?\s*(?:=>|[:=])\s*['\"]?)(?P<secret_value>[\w+/=.~-]{8,})"),
    ("key", r"(?<!\w)(?:AKIA[0-9A-Z]{16}|gh[pousr]_\w{36,}|sk-\w{20,}|xox[abprs]-[\w-]{10,})(?!\w)"),
    ("iban", r"(?<!\w)[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?!\w)"),
    ("ip", r"(?<![\w.])(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){3}(?:25[0-5]|2[0-4]\d|1?\d?\d)(?!\.?\w)"),
    ("ip", r"(?<![\w:])(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}(?![\w:])"),
    ("ip", r"(?<![\w:])(?=[0-9A-Fa-f:]*\d)(?:[0-9A-Fa-f]{1,4}(?::[0-9A-Fa-f]{1,4}){0,6})?::(?:[0-9A-Fa-f]{1,4}(?::[0-9A-Fa-f]{1,4}){0,6})?(?![\w:])"),
    ("ssn", r"(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-])"),
    ("card", r"(?<![\w.-])(?:\d{13,19}|\d{4}(?:[ -]\d{4}){2,3}(?:[ -]?\d{1,3})?|\d{4}[ -]\d{6}[ -]\d{5})(?!\w|[.-]\d)"),
    ("phone", r"(?<![\w+.-])(?:\+?1[ .-]?)?(?:\(\d{3}\)|\d{3})[ .-]?\d{3}[ .-]\d{4}(?!\w|[.-]\d)"),
    ("phone", r"(?<![\w+])\+\d{1,3}[ .-]?(?:\(\d{1,4}\)|\d{1,4})(?:[ .-]?\d{2,4}){2,4}(?!\w|[.-]\d)"),
    ("name", rf"(?<!\w)(?:(?P<shouted_title>{_SHOUTED_TITLE})\.? (?:(?:Dr|Prof)\.? )?(?P<shouted>{_SHOUTED}(?: {_SHOUTED})?)"
     rf"|(?P<title>{_TITLE})\.? (?:(?:Dr|Prof)\.? )?(?P<titled>{_CAPITAL}(?: {_CAPITAL})?)"
     rf"|(?P<given>{_GIVEN_WORDS}) (?P<family>{_CAPITAL}))(?!\w)"),
)
_ANY = re.compile("|".join(f"(?P<k{at}>{pattern})" for at, (_, pattern) in enumerate(PATTERNS)))
_KINDS = [kind for kind, _ in PATTERNS]
# An entity lies near one of these signs or words, so only their surroundings are matched (tests compare with whole texts).
_SIGNS = re.compile(r"[@\d]+|::")
_LETTERS = re.compile(r"[^\W\d_]+")
_WORDS = frozenset(
    {name for names in GIVEN.values() for name in names}
    | {part for title in (*MALE_TITLES, *FEMALE_TITLES, *NEUTRAL_TITLES) for part in _LETTERS.findall(title)}
    | {"AKIA", "ghp", "gho", "ghu", "ghs", "ghr", "sk", "xoxa", "xoxb", "xoxp", "xoxr", "xoxs"}
)
# In any case: the runs of letters that the names of secrets are made of.
_SECRET_WORDS = frozenset("key token secret password passwd pwd apikey accesskey secretkey authtoken bearer".split())
_AROUND = 80

_ONSETS = {"latin": "b br d dr f g gr h k kl l m n p r s st t tr v w z".split(), "cyrillic": "б в г д ж з к л м н п р с т ф х".split()}
_VOWELS = {"latin": "a e i o u ai au ei ie".split(), "cyrillic": "а е и о у я".split()}
_CODAS = {"latin": "n r l s ck nd rt m".split(), "cyrillic": "н в р л к м т".split()}


@dataclass(frozen=True)
class Part:
    """A stretch of a text that gets a surrogate of its own; equal ``kind`` and ``normal`` mean one original."""

    kind: str
    normal: str
    start: int
    end: int


def luhn(digits: str) -> bool:
    total = 0
    for at, digit in enumerate(reversed(digits)):
        value = int(digit) * (1 + at % 2)
        total += value - 9 if value > 9 else value
    return total % 10 == 0


def _is_address(text: str) -> bool:
    try:
        ipaddress.IPv6Address(text)
    except ValueError:
        return False
    return True


def _script(word: str) -> str:
    return "cyrillic" if re.search(r"[А-яЁё]", word) else "latin"


def _name_parts(match: re.Match) -> Iterator[Part]:
    title = match["title"] or match["shouted_title"] or ""
    gender = "m" if title in MALE_TITLES else "f" if title in FEMALE_TITLES else "n"
    if title:
        group = "titled" if match["title"] else "shouted"
        names, start = match[group].split(" "), match.start(group)
    else:
        names, start = [match["given"], match["family"]], match.start("given")
    for place, name in enumerate(names):
        script = _script(name)
        if place == 0 and len(names) > 1:
            own = _KNOWN.get(name.lower(), gender)
            yield Part(f"given {script} {own}", name.lower(), start, start + len(name))
        else:
            yield Part(f"family {script}", name.lower(), start, start + len(name))
        start += len(name) + 1


def _windows(text: str) -> Iterator[tuple[int, int]]:
    """Stretches that hold all entities, between white space."""
    spans = [match.span() for match in _SIGNS.finditer(text)]
    words = set(_LETTERS.findall(text))
    words = {word for word in words if word in _WORDS or word.startswith("AKIA") or word.lower() in _SECRET_WORDS}
    if words:
        spans += [match.span() for match in _LETTERS.finditer(text) if match.group() in words]
        spans.sort()
    low = high = -1
    for start, end in spans:
        if end + _AROUND <= high:
            continue
        start = max(0, start - _AROUND)
        if start > high >= 0:
            yield low, high
            low = high = -1
        if high < 0:
            while start > 0 and not text[start - 1].isspace():
                start -= 1
            low = start
        high = min(len(text), end + _AROUND)
        while high < len(text) and not text[high].isspace():
            high += 1
    if high >= 0:
        yield low, high


Entity = tuple[str, int, int, list[Part]]


def _mentions(text: str, found: list[Entity]) -> list[Entity]:
    """Names that were found in a text and stand there again by themselves, besides the entities found."""
    known: dict[str, Part] = {}
    for kind, _, _, parts in found:
        if kind == "name":
            for part in parts:
                if part.end - part.start > 2:
                    known.setdefault(part.normal, part)
    if not known:
        return []
    forms = {form for name in known for form in (_titled(name), name.upper())}
    again = re.compile(r"(?<!\w)(?:" + "|".join(map(re.escape, sorted(forms, key=len, reverse=True))) + r")(?!\w)")
    taken, made, at = sorted((start, end) for _, start, end, _ in found), [], 0
    for match in again.finditer(text):
        start, end = match.span()
        while at < len(taken) and taken[at][1] <= start:
            at += 1
        if at == len(taken) or taken[at][0] >= end:
            part = known[match.group().lower()]
            made.append(("name", start, end, [Part(part.kind, part.normal, start, end)]))
    return made


def find(text: str, windows: bool = True) -> list[Entity]:
    """(kind, start, end, parts) of each entity, in order and without overlap; later mentions of a name by a part of it are entities too.

    Without ``windows`` the whole text is matched, which finds the same.
    """
    found = []
    stretches = _windows(text) if windows else [(0, len(text))]
    for match in (match for window in stretches for match in _ANY.finditer(text, *window)):
        kind = _KINDS[int(match.lastgroup[1:])]
        start, end, whole = match.start(), match.end(), match.group()
        if kind == "email":
            cut = whole.rindex("@")
            domain = whole[cut + 1 :]
            parts = [
                Part("mailbox", f"{whole[:cut].lower()}@{domain.lower()}", start, start + cut),
                Part("domain", domain.lower(), start + cut + 1, end),
            ]
        elif kind == "secret":
            group = "secret_value" if match["secret_value"] else "bearer_value"
            start, end = match.span(group)
            parts = [Part("secret", match[group], start, end)]
        elif kind == "name":
            parts = list(_name_parts(match))
        elif "::" in whole and not _is_address(whole):
            continue
        elif kind in ("ip", "key"):
            parts = [Part(kind, whole.lower() if kind == "ip" else whole, start, end)]
        elif kind == "iban":
            parts = [Part(kind, whole.replace(" ", ""), start, end)]
        else:
            digits = re.sub(r"\D", "", whole)
            if kind == "card" and not luhn(digits):
                kind = "number"
            # With its country code a number is another one.
            parts = [Part(kind, ("+" if whole.startswith("+") else "") + digits, start, end)]
        found.append((kind, start, end, parts))
    return sorted([*found, *_mentions(text, found)], key=lambda one: one[1])


class Draw:
    """Even pseudorandom choices from a key and a text."""

    def __init__(self, key: bytes, *words: object):
        self._key, self._seed, self._count = key, "\x1f".join(map(str, words)).encode(), 0
        self._pool, self._left = 0, 0

    def below(self, limit: int) -> int:
        if self._left < 64:
            block = hmac.new(self._key, self._seed + self._count.to_bytes(4, "big"), hashlib.sha256).digest()
            self._pool, self._left, self._count = int.from_bytes(block, "big"), 256, self._count + 1
        value = self._pool & ((1 << 48) - 1)
        self._pool >>= 48
        self._left -= 48
        return value * limit >> 48

    def of(self, choices):
        return choices[self.below(len(choices))]


def _like(draw: Draw, text: str) -> str:
    """Letters and digits replaced by others of the same class; everything else stays."""
    made = []
    for sign in text:
        if "0" <= sign <= "9":
            made.append("0123456789"[draw.below(10)])
        elif "а" <= sign.lower() <= "я" or sign.lower() == "ё":
            letter = draw.of("абвгдежзиклмнопрстуфхцчшэюя")
            made.append(letter.upper() if sign.isupper() else letter)
        elif sign.isalpha():
            letter = draw.of("abcdefghijklmnopqrstuvwxyz")
            made.append(letter.upper() if sign.isupper() else letter)
        else:
            made.append(sign)
    return "".join(made)


def _hex_like(draw: Draw, text: str) -> str:
    low = "0123456789abcdef"
    return "".join(draw.of(low.upper() if text.upper() == text else low) if sign.isalnum() else sign for sign in text)


def _syllables(draw: Draw, script: str, count: int) -> str:
    word = "".join(draw.of(_ONSETS[script]) + draw.of(_VOWELS[script]) for _ in range(count))
    return word + draw.of(_CODAS[script])


def surrogate(key: bytes, kind: str, normal: str, attempt: int) -> str:
    """The normal form of an original's surrogate at its ``attempt``-th draw."""
    for again in range(1000):
        draw = Draw(key, kind, normal, attempt, again)
        made = _drawn(draw, kind, normal, attempt)
        if made != normal:
            return made
    raise ValueError(f"no other value of this form: {kind}")


def _drawn(draw: Draw, kind: str, normal: str, attempt: int) -> str:
    if kind == "mailbox":
        return _like(draw, normal.rpartition("@")[0]) + "@" + normal.rpartition("@")[2]
    if kind == "domain":
        # Reserved names, so that nobody gets mail.
        return f"{_like(draw, normal.split('.')[0])}.{_syllables(draw, 'latin', 2)}.example.{draw.of(TLDS)}"
    if kind == "secret" or kind == "key":
        if re.fullmatch(r"[0-9a-f-]+|[0-9A-F-]+", normal):
            return _hex_like(draw, normal)
        head = re.match(r"AKIA|gh[pousr]_|sk-|xox[abprs]-", normal)
        cut = head.end() if head else 0
        return normal[:cut] + _like(draw, normal[cut:])
    if kind == "ip":
        if "::" in normal:
            return _hex_like(draw, normal)
        if ":" in normal:
            return ":".join(f"{draw.below(65536):x}" for _ in range(8))
        return ".".join(str(1 + draw.below(254)) for _ in range(4))
    if kind == "iban":
        rest = _like(draw, normal[4:])
        numbers = "".join(str(int(sign, 36)) for sign in rest + normal[:2] + "00")
        return f"{normal[:2]}{98 - int(numbers) % 97:02d}{rest}"
    if kind == "card":
        digits = str(1 + draw.below(9)) + "".join(str(draw.below(10)) for _ in range(len(normal) - 2))
        return next(digits + last for last in "0123456789" if luhn(digits + last))
    if kind == "number":
        while True:
            digits = str(1 + draw.below(9)) + "".join(str(draw.below(10)) for _ in range(len(normal) - 1))
            if not luhn(digits):
                return digits
    if kind == "ssn":
        # Numbers from 900 on are never given to a person.
        return f"{900 + draw.below(100)}{1 + draw.below(99):02d}{1 + draw.below(9999):04d}"
    if kind == "phone":
        # The country code stays, of which the longest but one common length is taken.
        head = "" if not normal.startswith("+") else normal[:2] if normal[1] in "17" else normal[:3]
        digits = len(normal) - len(head)
        return head + "".join(str((2 + draw.below(8)) if at == 0 else draw.below(10)) for at in range(digits))
    if kind.startswith("family"):
        return _syllables(draw, kind.split()[1], 2 + draw.below(2))
    if kind.startswith("given"):
        script, gender = kind.split()[1:]
        gender = gender if gender != "n" else draw.of("mf")
        name = draw.of(GIVEN[script, gender]).lower()
        # The list is short: later draws put names together.
        return name if attempt < 2 else f"{name}-{draw.of(GIVEN[script, gender]).lower()}" if attempt < 6 else f"{name}-{_syllables(draw, script, 2)}"
    raise ValueError(kind)


def _titled(word: str) -> str:
    return re.sub(r"[^\W\d_]+", lambda m: m.group()[:1].upper() + m.group()[1:], word)


def _render(part: Part, original: str, made: str) -> str:
    """A surrogate's normal form in the form of the original: separators, spaces and case."""
    if part.kind == "mailbox":
        made = made.rpartition("@")[0]
    if part.kind in ("card", "number", "ssn", "phone"):
        digits = iter(made.lstrip("+"))
        return "".join(next(digits) if sign.isdigit() else sign for sign in original)
    if part.kind == "iban":
        signs = iter(made)
        return "".join(sign if sign == " " else next(signs) for sign in original)
    if part.kind in ("secret", "key"):
        return made
    if original.isupper():
        return made.upper()
    if original[:1].isupper() and part.kind.split()[0] in ("given", "family"):
        return _titled(made)
    return made


def replace(text: str, key: bytes, attempts: Callable[[str, str], int]) -> tuple[str, list[dict]]:
    """The text with surrogates, and each entity's kind, old place and surrogate."""
    pieces, entities, at = [], [], 0
    for kind, start, end, parts in find(text):
        pieces.append(text[at:start])
        made, inner = [], start
        for part in parts:
            made.append(text[inner : part.start])
            own = surrogate(key, part.kind, part.normal, attempts(part.kind, part.normal))
            made.append(_render(part, text[part.start : part.end], own))
            inner = part.end
        made.append(text[inner:end])
        new = "".join(made)
        pieces.append(new)
        entities.append({"kind": kind, "start": start, "end": end, "surrogate": new})
        at = end
    pieces.append(text[at:])
    return "".join(pieces), entities


def _held(docs: DataFrame, text: str) -> DataFrame:
    """(text, kind, normal): which originals a text holds, by a hash of the text; copies of a text hold the same."""

    def parts(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = {
            (own, part.kind, part.normal)
            for own, one in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())
            if one
            for _, _, _, entity in find(one)
            for part in entity
        }
        columns = [*zip(*sorted(rows))] or [(), (), ()]
        kinds = [pa.int64(), pa.string(), pa.string()]
        return pa.RecordBatch.from_arrays(
            [pa.array(column, kind) for column, kind in zip(columns, kinds)], ["text", "kind", "normal"]
        )

    own = docs.select(F.xxhash64(text).alias("__llm_text"), F.col(text))
    return staged(map_batches(own, parts, "text long, kind string, normal string"), "pii-held")


def _family(kind: Column) -> Column:
    """Values of one family must differ: cards and other long numbers look alike, given names of any gender too."""
    return F.when(kind.isin("card", "number"), F.lit("number")).otherwise(F.split_part(kind, F.lit(" "), F.lit(1)))


def redraws(originals: DataFrame, key: bytes = DEFAULT_KEY) -> DataFrame:
    """(kind, normal, attempt) of the originals whose first surrogate was taken, by another or by an original.

    Each round gives every value to the least of those that want it; the others draw again.  Nobody's value
    changes once it is theirs.
    """

    @F.pandas_udf("string")
    def drawn(kinds: pd.Series, normals: pd.Series, attempts: pd.Series) -> pd.Series:
        return pd.Series([surrogate(key, k, n, int(a)) for k, n, a in zip(kinds, normals, attempts)], dtype="object")

    originals = staged(originals.withColumn("family", _family(F.col("kind"))), "pii-originals")
    taken = originals.select("family", F.col("normal").alias("value"))
    open_ = originals.withColumn("attempt", F.lit(0))
    settled = None
    for _ in range(MOST_ROUNDS):
        wanted = staged(open_.withColumn("value", drawn("kind", "normal", "attempt")), "pii-wanted")
        free = wanted.join(taken, ["family", "value"], "left_anti")
        first = staged(
            free.groupBy("family", "value").agg(F.min(F.struct("kind", "normal", "attempt")).alias("o")), "pii-first"
        )
        got = first.select("family", "value", "o.*")
        lost = wanted.join(got.select("family", "kind", "normal"), ["family", "kind", "normal"], "left_anti")
        lost = staged(
            lost.select("kind", "normal", "family", (F.col("attempt") + 1).cast("int").alias("attempt")), "pii-open"
        )
        late = got.where("attempt > 0").select("kind", "normal", "attempt")
        settled = late if settled is None else settled.unionByName(late)
        taken = taken.unionByName(got.select("family", "value"))
        if lost.isEmpty():
            return staged(settled, "pii-redraws")
        open_ = lost
    raise ValueError("surrogates still collide; the forms of some originals leave too few values")


def replace_pii(docs: DataFrame, text: str = "text", key: bytes = DEFAULT_KEY, entities: str | None = None) -> DataFrame:
    """The documents with personal data in ``text`` replaced; other columns and rows stay as they are.

    ``entities`` names a column to add: array of (kind, start, end, surrogate), places in the old text.  A null text stays
    null and has none.  Repeated rows get equal texts.
    """
    small_batches(docs.sparkSession)
    held = _held(docs, text)
    changed = redraws(held.select("kind", "normal").distinct(), key)
    entry = F.concat_ws("\x1f", "kind", "normal", F.col("attempt").cast("string"))
    holders = held.join(changed, ["kind", "normal"]).select(F.col("text").alias("__llm_text"), entry.alias("entry"))
    # A text's redrawn originals; texts with one hash share the list, which only makes it longer.
    lists = holders.groupBy("__llm_text").agg(F.array_join(F.array_sort(F.collect_set("entry")), "\x1e").alias("__llm_list"))
    lists = staged(lists, "pii-lists")

    @F.pandas_udf("text string, entities array<struct<kind: string, start: int, end: int, surrogate: string>>")
    def replaced(texts: pd.Series, redrawn: pd.Series) -> pd.DataFrame:
        kept_in_worker("pii")
        made, found = [], []
        for one, listed in zip(texts, redrawn):
            own = {}
            for line in listed.split("\x1e") if listed else ():
                head, _, attempt = line.rpartition("\x1f")
                own[head] = int(attempt)
            new, spans = (None, []) if one is None else replace(one, key, lambda k, n: own.get(f"{k}\x1f{n}", 0))
            made.append(new)
            found.append(spans)
        return pd.DataFrame({"text": pd.Series(made, dtype="object"), "entities": pd.Series(found, dtype="object")})

    joined = docs.withColumn("__llm_text", F.xxhash64(text)).join(lists, "__llm_text", "left")
    joined = joined.withColumn("__llm_new", replaced(F.col(text), F.col("__llm_list")))
    columns = [F.col("__llm_new.text").alias(name) if name == text else F.col(f"`{name}`") for name in docs.columns]
    if entities:
        columns.append(F.col("__llm_new.entities").alias(entities))
    return joined.select(*columns)
