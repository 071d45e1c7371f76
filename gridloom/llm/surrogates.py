"""Personal data replaced by keyed surrogates.

Entities are found by their form. A surrogate is drawn from a keyed hash of the
entity's canonical value, so equal values get equal surrogates wherever they
stand, and keeps its type, length, punctuation, letter case and script, a name's
gender, and check digits. Spark then looks at all distinct entities: where two
values met in one surrogate, or a surrogate is somebody's real value, all but
one are drawn again until none is left.
"""

from __future__ import annotations

import hashlib
import hmac
import re
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridloom.llm.common import giving_back
from gridloom.session import materialized

SMALL_OVERRIDES = 50_000  # redrawn entities held by every task; more are joined

_EMAIL = re.compile(r"[A-Za-z0-9._%+-]{1,64}@(?:[A-Za-z0-9-]{1,63}\.)+[A-Za-z]{2,24}")
_NUMBERS = re.compile(r"[+(]?\d[\d .()+-]{5,}\d")  # where numbers are looked for
_IP = re.compile(r"(?<![\d.])(?:\d{1,3}\.){3}\d{1,3}(?![\d]|\.\d)")
_PHONE = re.compile(r"\+\d{1,3}[ .-]?(?:\(\d{1,4}\)[ .-]?)?\d{2,4}(?:[ .-]?\d{2,4}){1,4}(?!\d)")
# without a country: three, three and four digits, or a trunk 0; not inside longer runs
_NATIONAL = re.compile(
    r"(?<![\d+])(?<!\d[.-])(?:1[ .-])?(?:\(\d{3}\)[ .-]?|\d{3}[.-])\d{3}[ .-]\d{4}(?!\d|[.-]\d)"
    r"|(?<![\d+])(?<!\d[ .-])(?:1 )?\d{3} \d{3}[ -]\d{4}(?!\d|[ .-]\d)"
    r"|(?<![\d+])(?<!\d[ .-])(?:\(0\d{1,4}\) ?|0\d{1,4}[ .-])\d{2,8}(?:[ .-]\d{2,8}){0,4}(?!\d|[ .-]\d)"
)
_DATE = re.compile(r"\d{2}([ .-])\d{2}\1(?:\d{2}|\d{4})$")
_CARD = re.compile(r"(?<![\d+])\d(?:[ -]?\d){12,18}(?!\d)")
_SSN = re.compile(r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])")
_IBAN = re.compile(r"(?<![A-Z0-9])[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Z0-9])")
_ACCESS = re.compile(r"(?<![A-Za-z0-9])(?:AKIA|ASIA)[A-Z0-9]{16}(?![A-Za-z0-9])")
_ASSIGN = re.compile(r"[=:]")
_SECRET_NAME = re.compile(r"(?i)(?:password|passwd|pwd|secret|token|api[_-]?key)['\"]?\s{0,3}$")
_SECRET = re.compile(r"\s{0,3}[\"']?([^\s\"',;]{6,})")
# Titles and the gender they tell.
_TITLES = {
    "Mr": "m", "Mister": "m", "Mrs": "f", "Ms": "f", "Miss": "f", "Dr": "", "Herr": "m",
    "Frau": "f", "Monsieur": "m", "Madame": "f", "Mademoiselle": "f", "Señor": "m",
    "Señora": "f", "Sr": "m", "Sra": "f", "господин": "m", "госпожа": "f", "κύριος": "m",
    "κυρία": "f",
}
_NAME = re.compile(
    r"\b(" + "|".join(sorted(_TITLES, key=len, reverse=True)) + r")\b\.? "
    r"([^\W\d_]+(?:[-'][^\W\d_]+)?)(?: ([^\W\d_]+(?:[-'][^\W\d_]+)?))?"
)
_WORD = re.compile(r"[^\W\d_]+(?:[-'][^\W\d_]+)?")
# Syllables of invented names, and endings by gender (f, m, unknown).
_SYLLABLES = {
    "latin": ("ba be bi bo da de di do fa fe ga go ha ka ke ki la le li lo ma me mi mo na ne ni "
              "no pa pe ra re ri ro sa se si so ta te ti to va ve vi", ("na", "ron", "ri")),
    "cyrillic": ("ба ве ви го да де ди жа за ка ке ла ле ли ма ме ми на не ни ра ре ри са се та те "
                 "ти", ("на", "ров", "ри")),
    "greek": ("βα βε γα δα δε θα κα κε λα λε λι μα με μι να νε νι πα πε ρα ρε σα σε τα τε τι",
              ("να", "ρος", "ρι")),
}


def luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        n = int(d) * (1 + k % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def _mod97(iban: str) -> int:
    moved = iban[4:] + iban[:4]
    return int("".join(str(int(c, 36)) for c in moved)) % 97


def find_entities(text: str) -> list[tuple[int, int, str]]:
    """(start, end, type) of all entities, in order and without overlaps; of two
    that overlap the one that starts first stays, and of those the longest. A
    name's words are entities of their own, of type given:g or family:g, where g
    is the gender, if known and of account. A name that stands behind a title
    somewhere is one wherever it stands in the text."""
    found = []
    at = text.find("@")
    while at >= 0:
        for m in _EMAIL.finditer(text, max(0, at - 64), min(len(text), at + 320)):
            if m.start() < at < m.end():
                found.append((m.start(), m.end(), "email"))
        at = text.find("@", at + 1)
    has_digit = False
    for region in _NUMBERS.finditer(text):
        has_digit = True
        a, b = max(0, region.start() - 1), min(len(text), region.end() + 1)
        for kind, pattern in (("ip", _IP), ("phone", _PHONE), ("phone", _NATIONAL), ("card", _CARD), ("ssn", _SSN)):
            for m in pattern.finditer(text, a, b):
                # a bounded search does not see what stands outside
                if kind == "ip" and max(map(int, m[0].split("."))) > 255:
                    continue
                if pattern is _NATIONAL:
                    if not 7 <= sum(map(str.isdigit, m[0])) <= 13 or _DATE.match(m[0]):
                        continue
                if kind == "card" and not luhn(re.sub(r"\D", "", m[0])):
                    continue
                found.append((m.start(), m.end(), kind))
    if has_digit:
        for m in _IBAN.finditer(text):
            plain = m[0].replace(" ", "")
            if 15 <= len(plain) <= 34 and _mod97(plain) == 1:
                found.append((m.start(), m.end(), "iban"))
    if "AKIA" in text or "ASIA" in text:
        found += [(m.start(), m.end(), "access") for m in _ACCESS.finditer(text)]
    for m in _ASSIGN.finditer(text):
        if _SECRET_NAME.search(text[max(0, m.start() - 16) : m.start()]):
            value = _SECRET.match(text, m.end())
            if value and re.search(r"[\d]", value[1]):
                found.append((value.start(1), value.end(1), "secret"))
    names: dict = {}
    for m in _NAME.finditer(text):
        gender = _TITLES[m[1]]
        words = [k for k in (2, 3) if m[k] and m[k][0].isupper()]
        if words and words[0] == 2:
            for k in words:
                part = "family" if k == words[-1] else "given"
                # one family name may belong to both; where it changes with gender, it tells
                own = gender if part == "given" or _script(m[k][0]) == "cyrillic" else ""
                name = m[k].lower().removesuffix("'s")
                # a word that is a given name somewhere is one everywhere, whatever the title
                names[name] = max(names.get(name, ""), f"{part}:{own}", key=_telling)
    for m in _WORD.finditer(text) if names else ():
        if m[0][0].isupper():
            for name in (m[0], *re.split("[-']", m[0])[:1]):
                if name.lower() in names:
                    found.append((m.start(), m.start() + len(name), names[name.lower()]))
                    break
    kept, last = [], -1
    for a, b, kind in sorted(found, key=lambda s: (s[0], -s[1], s[2])):
        if a >= last:
            kept.append((a, b, kind))
            last = b
    return kept


def _telling(kind: str) -> tuple:
    return kind.startswith("given"), kind


def canonical(kind: str, value: str) -> str:
    """What makes two mentions the same entity: letter case and punctuation do not
    count where a format does not mind them."""
    if kind in ("phone", "card", "ssn"):
        digits = re.sub(r"[^\d]", "", value)
        # a number of three, three and four digits is the one with country code 1
        national = kind == "phone" and len(digits) == 10 and value[0] not in "+0" and value[:2] != "(0"
        return "1" + digits if national else digits
    if kind == "iban":
        return value.replace(" ", "")
    if kind == "ip":
        return ".".join(str(int(x)) for x in value.split("."))
    return value.lower() if kind == "email" or ":" in kind else value


class _Draws:
    """Numbers drawn from a keyed hash."""

    def __init__(self, key: bytes, *parts):
        self.key, self.message, self.count, self.pool = key, repr(parts).encode(), 0, b""

    def below(self, n: int) -> int:
        while len(self.pool) < 4:
            block = self.message + self.count.to_bytes(4, "big")
            self.pool += hmac.new(self.key, block, hashlib.sha256).digest()
            self.count += 1
        number, self.pool = int.from_bytes(self.pool[:4], "big"), self.pool[4:]
        return number % n

    def of(self, letters: str) -> str:
        return letters[self.below(len(letters))]


# Letters drawn for letters of these scripts.
_ALPHABETS = {"cyrillic": "абвгдежзийклмнопрстуфхцчшщъыьэюя", "greek": "αβγδεζηθικλμνξοπρστυφχψω"}


@lru_cache(4096)
def _like(c: str) -> str:
    """Letters of the script and case of ``c``, a letter beyond ASCII."""
    if _script(c):
        own = _ALPHABETS[_script(c)]
        return own.upper() if c.isupper() else own
    start = ord(c) & ~0xFF
    near = (chr(k) for k in range(max(start, 0x80), start + 0x100))
    return "".join(x for x in near if x.isalpha() and (x.isupper(), x.islower()) == (c.isupper(), c.islower()))


_LOWER, _DIGITS = "abcdefghijklmnopqrstuvwxyz", "0123456789"


def _shaped(draws: _Draws, value: str) -> str:
    """Every letter and digit drawn anew in its class; hexadecimal stays so."""
    hexed = len(value) >= 16 and re.fullmatch(r"[0-9a-f]+", value)
    lower = "abcdef" if hexed else _LOWER
    out = []
    for c in value:
        if c.isdigit():
            out.append(draws.of(_DIGITS))
        elif c.isascii() and c.isalpha():
            x = draws.of(lower)
            out.append(x.upper() if c.isupper() else x)
        elif c.isalpha():
            out.append(draws.of(_like(c)))
        else:
            out.append(c)
    return "".join(out)


def surrogate(key: bytes, kind: str, value: str, attempt: int = 0) -> str:
    """The canonical surrogate of a canonical value."""
    draws = _Draws(key, kind, value, attempt)
    if kind == "email":
        local, domain = value.split("@")
        host, _, top = domain.rpartition(".")
        return f"{_shaped(draws, local)}@{_shaped(draws, host)}.{top}"
    if kind == "ip":
        return ".".join(str(1 + draws.below(n)) for n in (223, 254, 254, 254))
    if kind == "card":
        body = value[0] + "".join(draws.of(_DIGITS) for _ in value[2:])
        return next(body + d for d in _DIGITS if luhn(body + d))
    if kind == "phone":
        return value[:1] + str(2 + draws.below(8)) + "".join(draws.of(_DIGITS) for _ in value[2:])
    if kind == "ssn":
        return str(1 + draws.below(8)) + "".join(draws.of(_DIGITS) for _ in value[1:])
    if kind == "iban":
        body = "".join(draws.of(_DIGITS) if c.isdigit() else draws.of(_LOWER).upper()
                       for c in value[4:])
        check = 98 - _mod97(value[:2] + "00" + body)
        return f"{value[:2]}{check:02d}{body}"
    if kind == "access":
        return value[:4] + "".join(draws.of(_LOWER.upper() + "234567") for _ in value[4:])
    if ":" in kind:
        part, gender = kind.split(":")
        script = next((s for c in value for s in (_script(c),) if s), "latin")
        syllables, endings = _SYLLABLES[script]
        syllables = syllables.split(" ")
        ending = endings["fm".find(gender)] if part == "given" and gender else endings[2]
        if script == "cyrillic" and part == "family" and gender:
            ending = "рова" if gender == "f" else "ров"
        # a longer name at every draw after the second keeps redrawing short
        return "".join(syllables[draws.below(len(syllables))] for _ in range(3 + attempt // 2)) + ending
    return _shaped(draws, value)


def _script(c: str) -> str | None:
    if "Ѐ" <= c <= "ӿ":
        return "cyrillic"
    if "Ͱ" <= c <= "Ͽ":
        return "greek"
    return None


def in_form_of(kind: str, drawn: str, mention: str) -> str:
    """The canonical surrogate written as the mention is written."""
    if kind in ("phone", "card", "ssn", "iban"):
        # a phone number without its country shows the end of the whole one
        rest = iter(drawn[-sum(c.isalnum() for c in mention):])
        return "".join(next(rest) if c.isalnum() else c for c in mention)
    if kind == "email" and mention.isupper() or ":" in kind and mention.isupper() and len(mention) > 1:
        return drawn.upper()
    if ":" in kind:
        return drawn[:1].upper() + drawn[1:]
    return drawn


def mentions(docs: DataFrame) -> DataFrame:
    """doc_id, text_key, kind, value (canonical) of every entity of every row."""

    def find(batches):
        for batch in batches:
            ids, keys, kinds, values = [], [], [], []
            for doc_id, key, text in zip(*(batch.column(k) for k in range(3))):
                text = text.as_py()
                for a, b, kind in find_entities(text) if text else ():
                    ids.append(doc_id.as_py())
                    keys.append(key.as_py())
                    kinds.append(kind)
                    values.append(canonical(kind, text[a:b]))
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(keys, pa.int64()),
                 pa.array(kinds, pa.string()), pa.array(values, pa.string())],
                names=["doc_id", "text_key", "kind", "value"],
            )

    rows = docs.select(F.col("doc_id").cast("long"), F.xxhash64("text"), F.col("text").cast("string"))
    return rows.mapInArrow(giving_back(find), "doc_id long, text_key long, kind string, value string")


def resolved(entities: DataFrame) -> DataFrame:
    """kind, value and real_kind: a name has one gender, whatever its titles: the
    one they tell, or none if they tell two."""
    part = F.split_part("kind", F.lit(":"), F.lit(1))
    gender = F.expr("nullif(split_part(kind, ':', 2), '')")
    name = F.col("kind").contains(":")
    told = (
        entities.where(name).groupBy(part.alias("part"), F.col("value").alias("_value"))
        .agg(F.min(gender).alias("lo"), F.max(gender).alias("hi"))
        .selectExpr("_value", "part", "concat(part, ':', if(lo = hi, lo, '')) as told")
    )
    same = (F.col("value") == F.col("_value")) & (part == F.col("part"))
    return entities.join(told, same, "left").select(
        "kind", "value", F.when(name, F.coalesce("told", F.concat("part", F.lit(":")))).otherwise(F.col("kind")).alias("real_kind")
    )


def redrawn(entities: DataFrame, key: bytes) -> DataFrame:
    """kind, value and attempt of the entities whose first surrogate will not do.

    A surrogate is taken when another value has it or it is a value of the
    entities. The least value keeps a shared one, the others draw again.
    """

    @F.pandas_udf("string")
    def drawn(kind: pd.Series, value: pd.Series, attempt: pd.Series) -> pd.Series:
        return pd.Series([surrogate(key, *row) for row in zip(kind, value, attempt)], dtype=object)

    given = entities.withColumn("attempt", F.lit(0))
    real = entities.select("kind", F.col("value").alias("surrogate"), F.lit(True).alias("real"))
    while True:
        given = materialized(given.withColumn("surrogate", drawn("kind", "value", "attempt")))
        # an entity that was settled earlier goes before one that draws again
        owner = given.groupBy("kind", "surrogate").agg(
            F.min(F.struct("attempt", "value")).alias("owner")
        )
        judged = given.join(owner, ["kind", "surrogate"]).join(real, ["kind", "surrogate"], "left")
        again = F.coalesce("real", F.lit(False)) | (F.col("owner.value") != F.col("value"))
        judged = judged.withColumn("again", again)
        if not judged.where("again").limit(1).count():
            return given.where("attempt > 0").select("kind", "value", "attempt")
        given = judged.select("kind", "value", F.expr("attempt + cast(again as int) as attempt"))


def pseudonymized(docs: DataFrame, key: bytes, keep: list[str] | None = None) -> DataFrame:
    """Every row of ``docs`` with its entities replaced: the columns ``keep`` (all,
    if not given) with the new text in ``text``, and n_entities.

    Null and empty texts stay as they are, with no entity. Repeated rows are
    replaced alike; entities are the same across documents. A text without an
    entity is returned unchanged.
    """
    keep = docs.columns if keep is None else keep
    found = materialized(mentions(docs))
    entities = found.select("kind", "value").distinct()
    names = materialized(resolved(entities))
    one = materialized(names.select(F.col("real_kind").alias("kind"), "value").distinct())
    odd = redrawn(one, key).withColumnRenamed("kind", "real_kind")
    odd = names.join(odd, ["real_kind", "value"], "left")
    odd = odd.where("attempt is not null or kind <> real_kind")
    # as: the kind that is drawn, where titles tell another
    odd = odd.selectExpr("kind", "value", "coalesce(attempt, 0) as attempt", "real_kind as as")
    odd = materialized(odd)
    hidden = [f"c{k}" for k in range(len(keep))]
    rows = docs.select(
        *[docs[c].alias(h) for c, h in zip(keep, hidden)],
        docs["doc_id"].cast("long").alias("doc_id"),
        docs["text"].cast("string").alias("text"),
    )
    few = odd.limit(SMALL_OVERRIDES + 1).count()
    shared: dict = {}
    if few <= SMALL_OVERRIDES:
        shared = {(r["kind"], r["value"]): (r["attempt"], r["as"]) for r in odd.collect()}
        rows = rows.select(*hidden, F.lit(None).cast("array<string>").alias("odd"), "text")
    else:
        own = (
            found.join(odd, ["kind", "value"]).groupBy("doc_id", "text_key")
            .agg(F.collect_set(F.concat_ws("\n", "kind", "value", "attempt", "as")).alias("odd"))
            .select(F.col("doc_id").alias("_doc"), F.col("text_key").alias("_key"), "odd")
        )
        same = F.col("doc_id").eqNullSafe(F.col("_doc")) & (F.xxhash64("text") == F.col("_key"))
        rows = rows.join(own, same, "left").select(*hidden, "odd", "text")

    def replace(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, counts = [], []
            for odd_here, text in zip(batch.column("odd"), batch.column("text")):
                text, own = text.as_py(), shared
                if odd_here.is_valid:
                    parts = (x.split("\n") for x in odd_here.as_py())
                    own = {(kind, value): (int(n), real) for kind, value, n, real in parts}
                spans = find_entities(text) if text else []
                texts.append(_replaced(text, spans, key, own) if spans else text)
                counts.append(len(spans))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-2], pa.array(texts, pa.string()), pa.array(counts, pa.int64())],
                names=[*hidden, "new_text", "n_entities"],
            )

    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema.fields[:-2])
    out = rows.mapInArrow(giving_back(replace), f"{kinds}, new_text string, n_entities long")
    named = [
        F.col("new_text" if c == "text" else h).alias(c) for c, h in zip(keep, hidden)
    ]
    return out.select(*named, F.col("n_entities").alias(_free("n_entities", keep)))


def _free(name: str, taken: list[str]) -> str:
    while name in taken:
        name += "_"
    return name


def _replaced(text: str, spans: list, key: bytes, attempts: dict) -> str:
    out, last = [], 0
    for a, b, kind in spans:
        value = canonical(kind, text[a:b])
        attempt, drawn_as = attempts.get((kind, value), (0, kind))
        drawn = surrogate(key, drawn_as, value, attempt)
        out += [text[last:a], in_form_of(kind, drawn, text[a:b])]
        last = b
    return "".join([*out, text[last:]])


def private_report(docs: DataFrame, key: bytes) -> DataFrame:
    """doc_id, text (with surrogates) and n_entities of every row."""
    return pseudonymized(docs, key, ["doc_id", "text"])
