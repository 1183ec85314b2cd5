"""Surrogates for personal data.

Entities are found by pattern (e-mail, phone, card and account numbers,
addresses of machines, social security numbers, credentials) and by titles
and given names (people).  Each gets a replacement that a secret key decides:
of the same type and format (digits stay digits, letters letters, groups and
case as written, check digits valid where they were), names of the same
gender and script.

The replacement belongs to the entity in a canonical spelling (digits only,
lower case, a name's single parts), so all its mentions get the same one, in
any document.  A collision check over all entities of the corpus keeps
different entities apart and replacements away from real entities: of those
that claim the same replacement one keeps it, the others draw again, until no
claim is left.
"""

from __future__ import annotations

import hashlib
import re
import unicodedata
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from orderflow.llm.common import keyed, stored

# Titles and given names by gender, and syllables for made names, by script.
TITLES = {
    "m": ("Mr", "Sir", "Herr", "Monsieur", "Señor", "Sr", "Don", "г-н", "господин", "κύριος"),
    "f": ("Mrs", "Ms", "Miss", "Madam", "Frau", "Madame", "Mme", "Señora", "Sra", "Doña", "г-жа", "госпожа", "κυρία"),
    "": ("Dr", "Prof"),
}
GIVEN = {
    ("latin", "m"): ("John", "James", "Robert", "Michael", "David", "Thomas", "Peter", "Paul", "Hans", "Karl", "Jürgen",
                     "Pierre", "Jean", "Louis", "Carlos", "José", "Juan", "Luis"),
    ("latin", "f"): ("Mary", "Jennifer", "Linda", "Susan", "Sarah", "Anna", "Emma", "Laura", "Greta", "Heike", "Ursula",
                     "Marie", "Claire", "Sophie", "Carmen", "Lucía", "María", "Elena"),
    ("cyrillic", "m"): ("Иван", "Пётр", "Сергей", "Алексей", "Дмитрий", "Николай"),
    ("cyrillic", "f"): ("Анна", "Мария", "Ольга", "Елена", "Наталья", "Татьяна"),
    ("greek", "m"): ("Γιώργος", "Νίκος", "Δημήτρης", "Κώστας"),
    ("greek", "f"): ("Μαρία", "Ελένη", "Κατερίνα", "Σοφία"),
}
SYLLABLES = {
    "latin": ("ba", "ben", "bor", "dal", "den", "dor", "fal", "fen", "gar", "hal", "ken", "lan", "lor", "mar", "mel", "nor",
              "pal", "ren", "rol", "sal", "sen", "tan", "tor", "val", "ven", "wil"),
    "cyrillic": ("ба", "вал", "гор", "дан", "зор", "кал", "лен", "мар", "нор", "пол", "рен", "сан", "тор"),
    "greek": ("βαλ", "γαρ", "δελ", "ζαν", "καλ", "λεν", "μαρ", "νορ", "παλ", "ρεν", "σαλ", "τορ"),
}
ENDINGS = {("latin", "f"): "a", ("latin", "m"): "o", ("cyrillic", "f"): "а", ("cyrillic", "m"): "ин",
           ("greek", "f"): "α", ("greek", "m"): "ος"}

_NUMBER = re.compile(
    r"(?<![\w.+@-])(?:"
    r"(?P<IPV4>(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){3}(?:25[0-5]|2[0-4]\d|1?\d?\d))(?![\w]|\.\d)"
    r"|(?P<SSN>\d{3}-\d{2}-\d{4})(?![\w-])"
    r"|(?P<CARD>\d{13,19}|\d{4}(?:[ -]\d{4}){3})(?!\w)"
    r"|(?P<PHONE>\+\d{1,3}[ .-]?(?:\(\d{1,4}\)|\d{1,4})(?:[ .-]?\d{2,4}){2,4}|\(\d{3}\) ?\d{3}[ .-]\d{4}|\d{3}[ .-]\d{3}[ .-]\d{4})(?!\w))")
_EMAIL = re.compile(r"[\w.%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IBAN = re.compile(r"(?<!\w)[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?!\w)")
_DIGIT = re.compile(r"[+(]?\d")
_ASSIGNED = re.compile(r"[:=]\s*[\"']([^\"'\s]{8,})[\"']")
_CREDENTIAL = re.compile(r"(?i)(?:token|secret|password|passwd|api[_-]?key)[\"']?\s*\Z")
_TITLE_OF = {t.lower(): g for g, ts in TITLES.items() for t in ts}
_GIVEN_OF = {n.lower(): g for (_, g), names in GIVEN.items() for n in names}
_PART = r"[^\W\d_]+(?:[-'’][^\W\d_]+)*"
_TITLE = "|".join(sorted({re.escape(v) for t in _TITLE_OF for v in (t, t.upper(), t.title())}, key=len, reverse=True))
_NAMED = re.compile(rf"(?<!\w)({_TITLE})\.?[ ]({_PART})(?:[ ]({_PART}))?")
_GIVEN_NAMED = re.compile(rf"(?<!\w)({'|'.join(sorted({n for ns in GIVEN.values() for n in ns}, key=len, reverse=True))})[ ]({_PART})")


_LETTERS = re.compile(r"[^\W\d_]+")
#: Runs of letters (of a title with a hyphen the longest) without which no name is looked for.
_NAME_HINTS = frozenset(max(_LETTERS.findall(v), key=len) for t in [*_TITLE_OF, *(n for ns in GIVEN.values() for n in ns)]
                        for v in (t, t.lower(), t.upper(), t.title()))


def script_of(word: str) -> str:
    name = unicodedata.name(word[0], "").split(" ", 1)[0].lower() if word else ""
    return name if name in SYLLABLES else "latin"


def iban_valid(text: str) -> bool:
    s = text.replace(" ", "")
    return int("".join(str(int(c, 36)) for c in s[4:] + s[:4])) % 97 == 1


def luhn(digits: str) -> int:
    """0 for a number whose check digit is right."""
    return sum(d if i % 2 == 0 else d * 2 - 9 * (d > 4) for i, d in enumerate(int(c) for c in reversed(digits))) % 10


def find(text: str) -> list[tuple[int, int, str, str]]:
    """(start, end, type, canonical spelling) of the entities of a whole
    text, in order, not overlapping; of overlapping ones the first, then the
    longest.  Types of names carry gender and script."""
    out = []
    if "@" in text:
        for m in re.finditer("@", text):
            a = m.start()
            while a and (text[a - 1].isalnum() or text[a - 1] in "._%+-"):
                a -= 1
            if e := _EMAIL.match(text, a):
                out.append((a, e.end(), "EMAIL", e[0].lower()))
    end = 0
    for m in _DIGIT.finditer(text):
        a = m.start()
        if a < end:
            continue
        if a > 1 and text[a - 2:a].isupper() and (i := _IBAN.match(text, a - 2)) and iban_valid(i[0]):
            out.append((a - 2, end := i.end(), "IBAN", i[0].replace(" ", "")))
        elif n := _NUMBER.match(text, a) or m.end() - a > 1 and _NUMBER.match(text, a + 1):
            kind = n.lastgroup
            out.append((n.start(), end := n.end(), kind, n[0] if kind == "IPV4" else re.sub(r"\D", "", n[0])))
    for m in _ASSIGNED.finditer(text):
        if _CREDENTIAL.search(text, max(0, m.start() - 16), m.start()):
            out.append((m.start(1), m.end(1), "CREDENTIAL", m[1]))
    names: dict[str, str] = {}

    def part(m, k, kind):
        names.setdefault(m[k].lower(), kind)
        out.append((m.start(k), m.end(k), kind, m[k].lower()))

    if not _NAME_HINTS.isdisjoint(_LETTERS.findall(text)):
        for m in _NAMED.finditer(text):
            if not m[2][0].isupper() and not m[2][0].isalpha() or m[2][0].islower():
                continue
            two = m[3] is not None and m[3][0].isupper()
            gender = _TITLE_OF[m[1].lower()] or _GIVEN_OF.get(m[2].lower(), "")
            if two:
                part(m, 2, f"GIVEN:{gender}:{script_of(m[2])}")
            part(m, 3 if two else 2, f"FAMILY::{script_of(m[3 if two else 2])}")
        for m in _GIVEN_NAMED.finditer(text):
            if m[2][0].isupper():
                part(m, 1, f"GIVEN:{_GIVEN_OF[m[1].lower()]}:{script_of(m[1])}")
                part(m, 2, f"FAMILY::{script_of(m[2])}")
    if names:  # the same people, named by one part
        alone = re.compile(r"(?<!\w)(?:" + "|".join(map(re.escape, sorted(names, key=len, reverse=True))) + r")(?!\w)", re.I)
        for m in alone.finditer(text):
            if m[0][0].isupper():
                out.append((m.start(), m.end(), names[m[0].lower()], m[0].lower()))
    out.sort(key=lambda x: (x[0], -x[1]))
    kept, end = [], 0
    for x in out:
        if x[0] >= end:
            kept.append(x)
            end = x[1]
    return kept


class Draw:
    """A keyed stream of small numbers for one entity and attempt."""

    def __init__(self, key: bytes, *parts: object):
        self.seed = hashlib.blake2b("\x1f".join(map(str, parts)).encode("utf-8", "surrogatepass"), key=key[:64], digest_size=32).digest()
        self.pool, self.n = b"", 0

    def below(self, n: int) -> int:
        if len(self.pool) < 8:
            self.pool += hashlib.blake2b(self.seed + self.n.to_bytes(8, "big"), digest_size=64).digest()
            self.n += 1
        x, self.pool = int.from_bytes(self.pool[:8], "big"), self.pool[8:]
        return x % n

    def letters(self, n: int) -> str:
        return "".join("abcdefghijklmnopqrstuvwxyz"[self.below(26)] for _ in range(n))

    def like(self, text: str) -> str:
        """Digits for digits, letters for letters of the same case (of the
        Latin alphabet for letters beyond it), the rest as it is; letters
        throughout for a text without any of either, which would not change."""
        if not any(c.isdigit() or c.isalpha() for c in text):
            return self.letters(len(text))
        out = []
        for c in text:
            if c.isdigit():
                out.append(str(self.below(10)))
            elif c.isalpha():
                x = "abcdefghijklmnopqrstuvwxyz"[self.below(26)]
                out.append(x.upper() if c.isupper() else x)
            else:
                out.append(c)
        return "".join(out)


def surrogate(kind: str, canon: str, key: bytes, attempt: int = 0) -> str:
    """The canonical replacement of an entity at its ``attempt``-th draw.
    Later draws come from ever larger spaces, where the type's format allows:
    so a shape whose space is full of entities does not stay without one."""
    draw = Draw(key, kind, canon, attempt)
    wider = attempt // WIDEN
    if kind == "EMAIL":
        local, domain = canon.rsplit("@", 1)
        labels = domain.split(".")
        # the domain is drawn by itself: addresses of one domain stay together
        of_domain = Draw(key, "DOMAIN", domain, attempt // 4)
        return draw.like(local) + draw.letters(wider) + "@" + ".".join([*map(of_domain.like, labels[:-1]), labels[-1]])
    if kind == "IPV4":
        octets = canon.split(".")
        if wider:
            return ".".join(str(draw.below(256)) for _ in octets)
        low = {1: 0, 2: 10, 3: 100}
        return ".".join(str(low[len(o)] + draw.below({1: 10, 2: 90, 3: 156}[len(o)])) if o == str(int(o)) else draw.like("0" * len(o))[-len(o):].replace("9", "1")
                        for o in octets)
    if kind == "CARD":
        digits = draw.like(canon)
        if (luhn(digits) == 0) != (luhn(canon) == 0):
            digits = next(digits[:-1] + c for c in "0123456789" if (luhn(digits[:-1] + c) == 0) == (luhn(canon) == 0))
        return digits
    if kind == "PHONE":  # the first digit stands for the country
        return draw.like(canon) if wider else canon[0] + draw.like(canon[1:])
    if kind == "IBAN":
        rest = draw.like(canon[4:])
        check = 98 - int("".join(str(int(c, 36)) for c in rest + canon[:2] + "00")) % 97
        return f"{canon[:2]}{check:02d}{rest}"
    if kind.startswith(("GIVEN", "FAMILY")):
        what, gender, script = kind.split(":")
        if what == "GIVEN" and attempt < 3 and (script, gender) in GIVEN:
            names = GIVEN[script, gender]
            return names[draw.below(len(names))].lower()
        parts = SYLLABLES[script]
        word = "".join(parts[draw.below(len(parts))] for _ in range(3 + attempt // 4))
        return word + (ENDINGS.get((script, gender), "") if what == "GIVEN" else "")
    return draw.like(canon) + (draw.letters(wider) if kind == "CREDENTIAL" else "")


def written(mention: str, kind: str, replacement: str) -> str:
    """The replacement in the mention's own format."""
    if kind in ("CARD", "PHONE", "SSN"):
        digits = iter(replacement)
        return "".join(next(digits) if c.isdigit() else c for c in mention)
    if kind == "IBAN":
        chars = iter(replacement)
        return "".join(c if c == " " else next(chars) for c in mention)
    if kind == "EMAIL":
        return "".join(r.upper() if m.isupper() else r for m, r in zip(mention, replacement)) if len(mention) == len(replacement) else replacement
    if kind.startswith(("GIVEN", "FAMILY")):
        return replacement.upper() if mention.isupper() and len(mention) > 1 else replacement.title() if mention[0].isupper() else replacement
    return replacement


def rewritten(text: str, key: bytes, attempts: dict[tuple[str, str], int]) -> tuple[str, list[dict]]:
    """The text with replacements, and them with their places in it."""
    out, spans, at, size = [], [], 0, 0
    for a, b, kind, canon in find(text):
        new = written(text[a:b], kind, surrogate(kind, canon, key, attempts.get((kind, canon), 0)))
        out += [text[at:a], new]
        size += a - at
        spans.append({"type": kind.split(":")[0], "start": size, "end": size + len(new), "surrogate": new})
        size += len(new)
        at = b
    return "".join(out) + text[at:], spans


#: Draws after which the space grows, and after which there is none left.
WIDEN, MOST_DRAWS = 8, 64
_ENTITY = pa.schema([("text_key", pa.int64()), ("kind", pa.string()), ("canon", pa.string())])


def entities(df: DataFrame, text_col: str = "text") -> DataFrame:
    """(text_key, kind, canon): the distinct entities of every text."""
    rows = df.select(F.col(f"`{text_col}`").alias("text"), F.xxhash64(f"`{text_col}`").alias("text_key"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keys, kinds, canons = [], [], []
            for k, t in zip(b.column("text_key").to_pylist(), b.column("text")):
                for kind, canon in {x[2:] for x in find(t.as_py() or "")}:
                    keys.append(k), kinds.append(kind), canons.append(canon)
            yield pa.record_batch([pa.array(keys, pa.int64()), pa.array(kinds, pa.string()), pa.array(canons, pa.string())], schema=_ENTITY)

    return rows.mapInArrow(run, "text_key bigint, kind string, canon string")


def settled(found: DataFrame, key: bytes) -> tuple[DataFrame, int]:
    """(kind, canon, attempt, surrogate) of all distinct entities without two
    equal surrogates of a type and without one that is itself an entity; and
    how many needed more than one draw.  Every round is a grouping over the
    entities, whose numbers follow the corpus: nothing is collected."""
    def draw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = zip(b.column("kind").to_pylist(), b.column("canon").to_pylist(), b.column("attempt").to_pylist())
            made = [surrogate(k, c, key, a) for k, c, a in rows]
            yield pa.record_batch([b.column("kind"), b.column("canon"), b.column("attempt"), pa.array(made, pa.string())],
                                  names=["kind", "canon", "attempt", "surrogate"])

    family = F.regexp_extract("kind", "^([A-Z0-9]+)", 1)
    own = found.select("kind", "canon").distinct().withColumn("attempt", F.lit(0))
    ddl = "kind string, canon string, attempt int, surrogate string"
    table = stored(own.mapInArrow(draw, ddl).withColumn("family", family), "surrogates")
    again, turn = 0, 0
    while True:
        claims = table.groupBy("family", "surrogate").agg(F.min(F.struct("attempt", "kind", "canon")).alias("first"), F.count("*").alias("n"))
        real = table.select("family", F.col("canon").alias("surrogate"), F.lit(True).alias("real")).distinct()
        # only claims that clash are joined back
        clash = claims.join(real, ["family", "surrogate"], "left").where("n > 1 or real") \
            .select("family", "surrogate", F.when(F.col("real").isNull(), F.col("first")).alias("first"))
        met = table.join(clash.withColumn("clash", F.lit(True)), ["family", "surrogate"], "left")
        keeps = F.col("clash").isNull() | F.coalesce((F.col("first.kind") == F.col("kind")) & (F.col("first.canon") == F.col("canon")), F.lit(False))
        met = stored(met.select("kind", "canon", "attempt", "surrogate", "family", keeps.alias("keeps")), "claims")
        losers = met.where("not keeps").count()
        if not losers:
            return met.drop("keeps", "family"), again
        again, turn = max(again, losers), turn + 1
        if turn > MOST_DRAWS:
            kind, canon = met.where("not keeps").select("kind", "canon").first()
            shape = re.sub(r"[^\W\d_]", "a", re.sub(r"\d", "9", canon))
            raise ValueError(f"{losers} entities found no free surrogate in {MOST_DRAWS} draws, the first is {kind} of the shape {shape!r}")
        drawn = met.where("not keeps").select("kind", "canon", F.lit(turn).alias("attempt")).mapInArrow(draw, ddl).withColumn("family", family)
        table = stored(met.where("keeps").drop("keeps").unionByName(drawn), "surrogates")


def replace(df: DataFrame, key: bytes, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, text, entities) for every row: the text with surrogates, and the
    replacements with type and place in the new text.

    Whole texts are read.  Null texts stay null, with no entities; repeated
    rows come back as often as they came, alike; an empty table gives no
    rows; other columns are not read.  The few entities that needed more than
    one draw travel to the texts that hold them by a join on the text's hash
    (Spark broadcasts it below its threshold and shuffles beyond).
    """
    if not key:
        raise ValueError("a key is needed")
    rows = keyed(df, id=id_col, text=text_col).withColumn("text_key", F.xxhash64("text"))
    found = stored(entities(df, text_col), "entities")
    table, again = settled(found, key)
    if again:
        more = table.where("attempt > 0").select("kind", "canon", "attempt")
        some = found.distinct().join(more, ["kind", "canon"]).groupBy("text_key") \
            .agg(F.collect_list(F.struct("kind", "canon", "attempt")).alias("more"))
        rows = rows.join(stored(some, "redrawn"), "text_key", "left")
    else:
        rows = rows.withColumn("more", F.lit(None).cast("array<struct<kind:string,canon:string,attempt:int>>"))
    id_type = df.schema[id_col].dataType
    span = pa.struct([("type", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("surrogate", pa.string())])
    schema = pa.schema([("id", to_arrow_type(id_type)), ("text", pa.string()), ("entities", pa.list_(span))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, 1024):
                some = b.slice(at, 1024)
                texts, spans = [], []
                for t, more in zip(some.column("text").to_pylist(), some.column("more").to_pylist()):
                    own = {(m["kind"], m["canon"]): m["attempt"] for m in more or ()}
                    new, places = (None, []) if t is None else rewritten(t, key, own)
                    texts.append(new), spans.append(places)
                yield pa.record_batch([some.column("id"), pa.array(texts, pa.string()), pa.array(spans, pa.list_(span))], schema=schema)

    return rows.select("id", "text", "more").mapInArrow(
        run, f"id {id_type.simpleString()}, text string, entities array<struct<type:string,start:bigint,`end`:bigint,surrogate:string>>")
