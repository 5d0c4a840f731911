"""Personal data replaced by surrogates: of the same type and shape, the same for the same entity everywhere.

1. Entities are found in every whole text: mail addresses, phone numbers, card numbers, IP
   addresses, secret keys, account numbers, and names after a title.
2. Spark gathers the distinct entities; a name counts by its parts, a mail address by what
   stands on both sides of the at sign, so that a surname or a domain has one surrogate wherever
   it stands. Each gets a keyed surrogate: digits for digits, letters for letters of the same
   case and alphabet, a name of the same gender, alphabet and number of hyphens.
3. Surrogates are checked over the whole corpus: none may be an entity of the corpus, and no
   two entities may share one. Of those that collide, one keeps its surrogate and the others
   draw again, until there are none.
4. Texts with entities meet their surrogates by a join; texts without are passed through.
"""

from __future__ import annotations

import hashlib
import hmac
import re
from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from orderloom.llm.common import chunks, store

KEY = b"surrogates-1"
# Titles that announce a name, with the gender they tell.
TITLES = {
    "Mr": "m", "Mister": "m", "Sir": "m", "Herr": "m", "Herrn": "m", "Monsieur": "m", "Señor": "m", "Sr": "m", "Don": "m",
    "Mrs": "f", "Ms": "f", "Miss": "f", "Frau": "f", "Madame": "f", "Mme": "f", "Mlle": "f", "Señora": "f", "Sra": "f", "Doña": "f",
    "Dr": "n", "Prof": "n", "Господин": "m", "Госпожа": "f", "Κύριος": "m", "Κυρία": "f",
}
FIRST_NAMES = {
    ("latin", "m"): "Adrian Bruno Daniel Emil Felix Gabriel Hugo Julian Leon Martin Nico Oscar Paul Robert Simon Victor".split(),
    ("latin", "f"): "Alma Bianca Clara Diana Elena Flora Greta Helen Irene Julia Laura Marta Nora Paula Rosa Sofia".split(),
    ("cyrillic", "m"): "Антон Борис Виктор Глеб Денис Егор Иван Кирилл Лев Максим Олег Павел".split(),
    ("cyrillic", "f"): "Алла Вера Галина Дарья Елена Жанна Зоя Ирина Лариса Мария Нина Ольга".split(),
    ("greek", "m"): "Ανδρέας Βασίλης Γιώργος Δημήτρης Ηλίας Θωμάς Κώστας Λουκάς Μάριος Νίκος Πέτρος Στέλιος".split(),
    ("greek", "f"): "Αγγελική Βάσω Γεωργία Δήμητρα Ελένη Ζωή Ηρώ Κατερίνα Μαρία Νίκη Όλγα Σοφία".split(),
}
FIRST_NAMES |= {(s, "n"): FIRST_NAMES[s, "f"] + FIRST_NAMES[s, "m"] for s in ("latin", "cyrillic", "greek")}
SYLLABLES = {
    "latin": "ba be bo da del din fa fen gar hal jo kel lan mar mor nel per ral ros sel tan ven wal win".split(),
    "cyrillic": "ба бе вал ге дан дор жа зор ка ков лен мар мир нел ов пет рос сав тим фед".split(),
    "greek": "βα γε δα ζη θεο κα λα μαρ νι ξε πα ρο σα τα φω χρι".split(),
}
FIRST_ENDINGS = {"latin": {"m": "o", "f": "a"}, "cyrillic": {"f": "а"}, "greek": {"m": "ος", "f": "α"}}
ENDINGS = {("cyrillic", "m"): "ов", ("cyrillic", "f"): "ова", ("cyrillic", "n"): "ко", ("greek", "m"): "ης", ("greek", "f"): "η", ("greek", "n"): "ου"}
_LETTERS = {
    "latin": "abcdefghijklmnopqrstuvwxyz", "cyrillic": "абвгдежзиклмнопрстуфхцчшэюя", "greek": "αβγδεζηθικλμνξοπρστυφχψω",
}
_TITLE = "|".join(sorted(TITLES, key=len, reverse=True))
_NAME = r"\p{Lu}[\p{Ll}'’]+(?:-\p{Lu}\p{Ll}+)?"
# In this order: what an earlier pattern has taken is not looked at again.
_PATTERNS = regex.compile(
    "|".join(
        [
            r"(?P<mail>[A-Za-z0-9._%+\-]{1,64}@[A-Za-z0-9\-]{1,63}(?:\.[A-Za-z0-9\-]{1,63}){1,8})",
            r"(?<![\p{L}\p{N}])(?P<secret>(?=[0-9]*[A-Fa-f])(?=[A-Fa-f]*[0-9])[0-9A-Fa-f]{32,128}|(?:[sp]k[_\-]|ghp_?|AKIA|xox[bp]-?)[A-Za-z0-9_\-]{16,128})(?![\p{L}\p{N}])",
            r"(?<![\p{L}\p{N}])(?P<account>[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?)(?![\p{L}\p{N}])",
            r"(?<![\p{L}\p{N}.])(?P<ip>(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])(?:\.(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])){3})(?![\p{L}\p{N}]|\.[0-9])",
            r"(?<![\p{L}\p{N}])(?P<card>[0-9]{4}(?:[ \-]?[0-9]{4}){3}|[0-9]{13,19})(?![\p{L}\p{N}])",
            r"(?<![\p{L}\p{N}])(?P<ssn>[0-9]{3}-[0-9]{2}-[0-9]{4})(?![\p{L}\p{N}])",
            r"(?<![\p{L}\p{N}])(?P<phone>(?:\+[0-9]{1,3}[ .\-]?)?\([0-9]{1,5}\)[ .\-]?[0-9]{2,4}[ .\-]?[0-9]{2,5}|\+[0-9]{1,3}(?:[ .\-]?[0-9]{2,4}){2,4}|[0-9]{3}[.\-][0-9]{3}[.\-][0-9]{4})(?![\p{L}\p{N}])",
            rf"(?<![\p{{L}}\p{{N}}])(?P<title>{_TITLE})\.? (?P<name>{_NAME}(?: {_NAME}){{0,2}})",
        ]
    )
)
# Without a digit, an at sign, a key's prefix or a title a text holds no entity.
_HINT = re.compile("[0-9@]")
_MARKS = ("sk_", "pk_", "sk-", "pk-", "ghp", "AKIA", "xox", *TITLES)
KINDS = ("mail", "secret", "account", "ip", "card", "ssn", "phone", "name")
_NAMES = regex.compile(rf"(?<![\p{{L}}\p{{N}}@._]){_NAME}(?: {_NAME})*(?![\p{{L}}\p{{N}}@_])")
# After so many draws there are no surrogates left: of the kinds that keep their length (the
# others grow) the smallest has a thousand million.
ATTEMPTS = 64


def find(text: str) -> list[tuple[int, int, str, str]]:
    """Entities of a text in its order: begin, end, kind and gender ('' but for names).

    A name is found after a title, and where it, or its surname, stands without one in the same text.
    """
    found: list[tuple[int, int, str, str]] = []
    if not _HINT.search(text) and not any(mark in text for mark in _MARKS):
        return found
    genders: dict[str, str] = {}
    for match in _PATTERNS.finditer(text):
        kind = match.lastgroup if match.lastgroup in KINDS else "name"
        begin, end = match.span(kind)
        if kind != "name":
            found.append((begin, end, kind, ""))
            continue
        end = begin + len(_without_possessive(text[begin:end]))
        gender = TITLES[match["title"]]
        found.append((begin, end, kind, gender))
        for name in (text[begin:end], text[begin:end].rpartition(" ")[2]):
            genders[name] = min(gender, genders.get(name, gender))
    return _with_bare_names(text, found, genders) if genders else found


def _without_possessive(name: str) -> str:
    return regex.sub(r"(?:['’]s?)+$", "", name)


def _with_bare_names(text: str, found: list[tuple[int, int, str, str]], genders: dict[str, str]) -> list[tuple[int, int, str, str]]:
    bare, taken = [], iter([*found, (len(text) + 1, len(text) + 1, "", "")])
    begin, end, _, _ = next(taken)
    for match in _NAMES.finditer(text):
        run = _without_possessive(match[0])
        stop = match.start() + len(run)
        words = run.split(" ")
        # What stands in front may only begin a sentence: the longest known name at the end counts.
        name = next((own for own in (" ".join(words[-n:]) for n in (3, 2, 1)) if own in genders), "")
        start = stop - len(name)
        while end <= start:
            begin, end, _, _ = next(taken)
        if name and stop <= begin:
            bare.append((start, stop, "name", genders[name]))
    return sorted([*found, *bare])


def identity(value: str, kind: str) -> str:
    """What two mentions of one entity have in common: separators and, where it has no meaning, case are left out."""
    if kind in ("phone", "card", "ssn", "account"):
        return regex.sub(r"[^\p{L}\p{N}+]", "", value).upper()
    return value.lower() if kind in ("mail", "secret") else " ".join(value.split())


class Draw:
    """A stream of keyed numbers for one entity and attempt."""

    def __init__(self, key: bytes, *parts: str):
        self.key, self.parts, self.block, self.number = key, "\0".join(parts).encode(), b"", 0

    def below(self, limit: int) -> int:
        if len(self.block) < 8:
            self.block += hmac.digest(self.key, self.parts + self.number.to_bytes(4, "big"), hashlib.sha256)
            self.number += 1
        value, self.block = int.from_bytes(self.block[:8], "big"), self.block[8:]
        return value % limit


def script_of(text: str) -> str:
    if regex.search(r"\p{Cyrillic}", text):
        return "cyrillic"
    return "greek" if regex.search(r"\p{Greek}", text) else "latin"


def _luhn(digits: list[int]) -> int:
    total = sum(d if k % 2 else sum(divmod(2 * d, 10)) for k, d in enumerate(reversed(digits)))
    return -total % 10


def parts_of(value: str, kind: str, gender: str) -> list[tuple[str, str, str]]:
    """What gets a surrogate of its own: kind, identity and gender of the parts of a mention."""
    if kind == "name":
        *first, last = value.split()
        return [*(("first", x, gender) for x in first), ("surname", last, gender)]
    if kind == "mail":
        local, _, domain = value.lower().partition("@")
        return [("local", local, ""), ("domain", domain, "")]
    return [(kind, identity(value, kind), "")]


def _name_part(part: str, kind: str, gender: str, attempt: int, draw: Draw) -> str:
    script = script_of(part)
    syllables, names = SYLLABLES[script], FIRST_NAMES[script, gender or "n"]
    made = []
    for piece in part.split("-"):
        if kind == "first" and attempt < 2:
            made.append(names[draw.below(len(names))])
            continue
        count = max(2, round(len(piece) / 3)) + max(0, attempt - 1)
        new = "".join(syllables[draw.below(len(syllables))] for _ in range(count))
        ending = ENDINGS.get((script, gender), "") if kind == "surname" else FIRST_ENDINGS[script].get(gender, "")
        made.append((new + ending).capitalize())
    return "-".join(made)


def surrogate(entity: str, kind: str, gender: str, attempt: int, key: bytes = KEY) -> str:
    """A replacement for an identity: same length and kind of characters; drawn again for each attempt.

    Fixed by key, kind, identity and attempt. A card number that passes the checksum gets one
    that does. Domains keep their dots and top-level domain, phone numbers the country's code;
    IP addresses stay addresses. First names come from lists at first, other names and later
    attempts from syllables. From the third attempt on names, both sides of mail addresses,
    phone numbers and secrets grow, so that they never run out.
    """
    draw = Draw(key, kind, entity, str(attempt))
    more = max(0, attempt - 1)
    if kind == "name":
        *first, last = entity.split(" ")
        return " ".join([*(_name_part(x, "first", gender, attempt, draw) for x in first), _name_part(last, "surname", gender, attempt, draw)])
    if kind in ("first", "surname"):
        return _name_part(entity, kind, gender, attempt, draw)
    if kind == "ip":
        return ".".join(str(1 + draw.below(254)) for _ in range(4))
    hexadecimal = kind == "secret" and regex.fullmatch(r"[0-9a-f]+", entity)
    made = []
    head, dot, domain = entity.rpartition(".") if kind == "domain" else (entity, "", "")
    fixed = len(regex.match(r"(?:[sp]k[_\-]|ghp_?|akia|xox[bp]-?)|", entity)[0]) if kind == "secret" and not hexadecimal else 0
    if kind == "phone" and entity[0] == "+":
        fixed = 2 if entity[1] in "17" else 3  # the country's code stays
    for k, char in enumerate(head):
        if k < fixed or (kind == "account" and k < 2):
            made.append(char)
        elif hexadecimal:
            made.append("0123456789abcdef"[draw.below(16)])
        elif char.isdigit():
            made.append(str(draw.below(10)))
        elif char.isalpha():
            letters = _LETTERS[script_of(char)]
            new = letters[draw.below(len(letters))]
            made.append(new.upper() if char.isupper() else new)
        else:
            made.append(char)
    if kind in ("local", "domain", "secret"):
        letters = _LETTERS["latin"][:6] if hexadecimal else _LETTERS["latin"]
        made += [letters[draw.below(len(letters))] for _ in range(more)]
    elif kind == "phone":
        made += [str(draw.below(10)) for _ in range(more)]
    if kind == "card":
        digits = [int(x) for x in entity]
        if _luhn(digits[:-1]) == digits[-1]:
            made[-1] = str(_luhn([int(x) for x in made[:-1]]))
    return "".join(made) + dot + domain


def dressed(value: str, new: str, kind: str) -> str:
    """The surrogate of an identity in the dress of a mention: its separators and its case."""
    if kind in ("phone", "card", "ssn", "account"):
        left = iter(new.removeprefix("+"))
        placed = "".join(next(left) if char.isalnum() else char for char in value)
        return placed + "".join(left)
    if kind in ("local", "domain", "secret") and len(new) == len(value):
        return "".join(b.upper() if a.isupper() else b for a, b in zip(value, new, strict=True))
    return new.upper() if kind in ("local", "domain") and value.isupper() else new


def replaced(value: str, kind: str, known: dict[tuple[str, str], str]) -> str:
    """A mention with the surrogates of its parts."""
    new = [known[part, entity] for part, entity, _ in parts_of(value, kind, "")]
    if kind == "mail":
        return "@".join(dressed(x, y, part) for x, y, part in zip(value.split("@"), new, ("local", "domain"), strict=True))
    return " ".join(new) if kind == "name" else dressed(value, new[0], kind)


def assign(found: DataFrame, key: bytes = KEY) -> DataFrame:
    """kind, entity, surrogate: distinct for distinct entities, and none an entity itself.

    Each round draws for those without one. A surrogate that is taken, or is an entity, is
    drawn again; of several that draw the same, the first by entity keeps it. Where a kind that
    cannot grow has none left, this fails and names the kind.
    """

    def drawn(rows: DataFrame, attempt: int) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                columns = [batch[x].to_pylist() for x in ("entity", "kind", "gender")]
                made = [surrogate(*row, attempt, key) for row in zip(*columns, strict=True)]
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(made, pa.string())], [*batch.schema.names, "surrogate"])

        return rows.mapInArrow(run, "kind string, entity string, gender string, surrogate string")

    found = store(found, "entities")
    waiting, done, attempt = found, None, 0
    while True:
        tried = drawn(waiting, attempt)
        same = Window.partitionBy("kind", "surrogate").orderBy("entity")
        tried = tried.withColumn("place", F.row_number().over(same))
        real = found.select("kind", F.col("entity").alias("surrogate"), F.lit(True).alias("real"))
        tried = tried.join(real, ["kind", "surrogate"], "left")
        if done is not None:
            tried = tried.join(done.select("kind", "surrogate", F.lit(True).alias("taken")), ["kind", "surrogate"], "left")
        else:
            tried = tried.withColumn("taken", F.lit(None).cast("boolean"))
        good = F.col("real").isNull() & F.col("taken").isNull() & (F.col("place") == 1)
        tried = store(tried.withColumn("good", good), "drawn")
        kept = tried.where("good").select("kind", "entity", "surrogate")
        done = kept if done is None else done.unionAll(kept)
        waiting = tried.where("NOT good").select("kind", "entity", "gender")
        attempt += 1
        left = waiting.limit(1).collect()
        if not left:
            return done
        if attempt == ATTEMPTS:
            raise ValueError(f"no surrogates left for entities of kind {left[0]['kind']!r}")


def _free(names: list[str], wanted: str) -> str:
    """A column name that clashes with none of `names`."""
    while wanted.lower() in {name.lower() for name in names}:
        wanted += "_"
    return wanted


def pseudonymize(docs: DataFrame, *, text_col: str = "text", key: bytes = KEY) -> DataFrame:
    """All columns of `docs` with entities replaced in the text, and n_entities.

    Null texts stay null, texts without entities stay as they are, with n_entities 0. Repeated
    rows are all kept and get equal texts. Very long texts are used whole. A column named
    n_entities is replaced, all others keep their values whatever their names; an empty table
    gives no rows.
    """
    rows = docs.drop("n_entities")
    names = rows.columns
    held, number, new = (_free(names, name) for name in ("_found", "_row", "_new"))
    marked = _marked(rows, text_col, held)
    mentions = store(marked.where(F.size(held) > 0).withColumn(number, F.monotonically_increasing_id()), "mentions")
    wanted = store(mentions.select(F.col(number).alias("row"), F.explode(held).alias("e")).select("row", "e.*"), "entities")
    pairs = store(assign(wanted.groupBy("kind", "entity").agg(F.min("gender").alias("gender")), key), "surrogates")
    known = wanted.select("row", "kind", "entity").distinct().join(pairs, ["kind", "entity"])
    maps = known.groupBy(F.col("row").alias(number)).agg(F.collect_list(F.struct("kind", "entity", "surrogate")).alias(new))
    changed = mentions.drop(held).join(maps, number).drop(number)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, text_col):
            texts, counts = [], []
            for text, own in zip(batch[text_col].to_pylist(), batch[new].to_pylist(), strict=True):
                by_entity = {(x["kind"], x["entity"]): x["surrogate"] for x in own}
                parts, at, found = [], 0, find(text)
                for begin, end, kind, _ in found:
                    parts += [text[at:begin], replaced(text[begin:end], kind, by_entity)]
                    at = end
                texts.append("".join([*parts, text[at:]]))
                counts.append(len(found))
            kept = [pa.array(texts, pa.string()) if name == text_col else batch[name] for name in names]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(counts, pa.int64())], [*names, "n_entities"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema) + ", n_entities bigint"
    own = [F.col(f"`{name}`") for name in names]
    altered = changed.select(*own, new).mapInArrow(run, schema)
    plain = marked.where(F.size(held) == 0).select(*own, F.lit(0).cast("bigint").alias("n_entities"))
    return plain.unionByName(altered)


def _marked(rows: DataFrame, text_col: str, held: str) -> DataFrame:
    """The rows with the distinct parts of the text's entities. A name's gender is what its title tells: f, m or n for none."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, text_col):
            found = []
            for text in batch[text_col].to_pylist():
                own = {part for a, b, kind, gender in find(text) for part in parts_of(text[a:b], kind, gender)} if text else ()
                found.append([dict(zip(("kind", "entity", "gender"), x, strict=True)) for x in sorted(own)])
            kind = pa.list_(pa.struct([(name, pa.string()) for name in ("kind", "entity", "gender")]))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, kind)], [*batch.schema.names, held])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)
    return rows.mapInArrow(run, f"{schema}, `{held}` array<struct<kind: string, entity: string, gender: string>>")
