"""Personal data replaced by keyed surrogates of the same type, gender, script and format.

A surrogate is a keyed permutation of the entity among all strings of its shape:
letters stay letters of their script and case, digits stay digits, check digits
are made valid again, separators stay.  Within a shape distinct entities
therefore get distinct surrogates, and one entity has one surrogate in all
documents and spellings.  Names are rebuilt from syllables of their script with
an ending of their gender.  What a permutation cannot rule out is checked over
the distinct entities of the whole table: two with one surrogate, or a surrogate
that is itself an entity, are drawn again until none is left; only the entities
drawn again travel to the rewriting tasks.

Defined results: a null text stays null and an empty one empty, without
entities; repeated rows are rewritten alike; texts without entities come back
byte for byte; empty tables give empty results, other columns are kept by
``redact`` unless they are called like its own two.
"""

from __future__ import annotations

import hashlib
import hmac
import re
import secrets
from bisect import bisect_left
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone.llm.common import arrow_batches, if_small, store

KEY_CONF = "siltstone.surrogate.key"
ROUNDS = 8
DRAWS = 50
DRAWN_DOCS = 100_000  # so many documents' drawn entities are broadcast

# Forms of address and the gender they tell, and syllables of two scripts.
TITLES = {
    "m": ["Mr", "Herr", "Monsieur", "Señor", "Sr", "Signor", "Господин", "Г-н"],
    "f": ["Mrs", "Ms", "Miss", "Frau", "Madame", "Mme", "Señora", "Sra", "Signora", "Госпожа", "Г-жа"],
    "n": ["Dr", "Prof"],
}
SYLLABLES = {
    "latin": "ba be bi bo da de di do fa fe fi fo ga ge gi go ka ke ki ko la le li lo ma me mi mo na ne ni no".split(),
    "cyrillic": "ба бе би бо да де ди до фа фе фи фо га ге ги го ка ке ки ко ла ле ли ло ма ме ми мо на не ни но".split(),
}
ENDINGS = {"latin": {"m": "n", "f": "ra", "n": "l"}, "cyrillic": {"m": "н", "f": "ра", "n": "л"}}
ALPHABETS = ["0123456789", "abcdefghijklmnopqrstuvwxyz", "αβγδεζηθικλμνξοπρστυφχψω", "абвгдежзийклмнопрстуфхцчшщъыьэюя"]
HEX_LETTERS = "abcdef"
# Lengths of IBANs by country; of another country any length is one.
_LENGTHS = """
    15 NO 16 BE 18 DK FI FK FO GL NL SD 19 MK SI 20 AT BA EE KZ LT LU MN XK 21 CH HR LI LV 22 BG BH CR DE GB GE IE ME RS VA
    23 AE GI IL IQ OM SO 24 AD CZ ES MD PK RO SA SE SK TN VG 25 LY PT ST 26 IS TR 27 BI DJ FR GR IT MC MR SM
    28 AL AZ BY CY DO GT HU LB NI PL SV 29 BR EG PS QA UA 30 JO KW MU YE 31 MT SC 32 LC 33 RU
"""

IBAN_LENGTHS = {c: int(n) for n, codes in re.findall(r"(\d+)((?:\s+[A-Z]{2})+)", _LENGTHS) for c in codes.split()}

_GENDER = {title: gender for gender, titles in TITLES.items() for title in titles}
_AT_DOMAIN = re.compile(r"@[\w\-]+(?:\.[\w\-]+)*\.[^\W\d_]{2,}")
_TOKEN = re.compile(
    r"""(?ix)\b(?:token|secret|password|passwd|api[_-]?key|access[_-]?key)\b["']?\s*[:=]\s*
        (?:"(?P<a>[\w\-+/=.]{8,})"|'(?P<b>[\w\-+/=.]{8,})'|(?P<c>[A-Za-z0-9_\-+/]{16,}))"""
)
_IBAN = re.compile(r"\b[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?\b")
_CARD = re.compile(r"(?<![\w.\-])\d(?:[ \-]?\d){12,18}(?!\w|-(?!\d)|\.\d)")
_SSN = re.compile(r"(?<![\w\-])\d{3}-\d{2}-\d{4}(?![\w\-])")
_PHONE = re.compile(r"(?<![\w.+])(?:\+\d{1,3}(?:[ .\-]?\(?\d{2,4}\)?){2,4}|(?:\(\d{3}\) ?|\d{3}[ .\-])\d{3}[ .\-]\d{4})(?![\w])")
_IP = re.compile(r"(?<![\w.])(?:\d{1,3}\.){3}\d{1,3}(?!\w|\.\d)")
_NAME = re.compile(
    r"\b(" + "|".join(sorted(map(re.escape, _GENDER), key=len, reverse=True)) + r")\.? ([^\W\d_a-z][^\W\d_]+)(?: ([^\W\d_a-z][^\W\d_]+))?"
)
_TITLE_AHEAD = re.compile("|".join(sorted(map(re.escape, _GENDER), key=len, reverse=True)))


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def iban_rest(body: str) -> int:
    """Remainder by 97 of an IBAN written body first, letters as two digits."""
    return int("".join(str(int(c, 36)) for c in body)) % 97


def prefixes(written: str) -> list[str]:
    """``written`` and its beginnings that end before a separator, longest first."""
    return [written, *(written[:i] for i in range(len(written) - 1, 0, -1) if written[i] in " -")]


def card_in(written: str) -> str | None:
    """The longest beginning of ``written`` that is a card number; an expiry date or a code may follow it."""
    for part in prefixes(written):
        digits = re.sub(r"\D", "", part)
        if len(digits) >= 13 and luhn(digits) and len(set(digits)) > 1:
            return part
    return None


def iban_in(written: str) -> str | None:
    """The beginning of ``written`` that is an IBAN, rather of its country's length; a currency or other words may follow it."""
    valid = {}
    for part in prefixes(written):
        body = part.replace(" ", "")
        if 15 <= len(body) <= 34 and iban_rest(body[4:] + body[:4]) == 1:
            valid[len(body)] = part
    length = IBAN_LENGTHS.get(written[:2])
    if length in valid:
        return valid[length]
    return max(valid.values(), key=len, default=None) if length is None else valid.get(len(written.replace(" ", "")))


def permuted(key: bytes, tweak: str, values: list[int], radices: list[int]) -> list[int]:
    """A keyed permutation of mixed-radix numbers: two halves, each shifted in turn by a keyed hash of the other."""
    half = len(values) // 2
    sides = []
    for part, base in ((values[:half], radices[:half]), (values[half:], radices[half:])):
        number, size = 0, 1
        for v, r in zip(part, base):
            number, size = number * r + v, size * r
        sides.append([number, size])
    for turn in range(ROUNDS):
        source, target = sides[turn % 2], sides[1 - turn % 2]
        told = hmac.new(key, f"{tweak}|{turn}|{source[0]}".encode(), hashlib.sha256).digest()
        target[0] = (target[0] + int.from_bytes(told, "big")) % target[1]
    out: list[int] = []
    for (number, _), base in zip(sides, (radices[:half], radices[half:])):
        digits = []
        for r in reversed(base):
            number, d = divmod(number, r)
            digits.append(d)
        out += reversed(digits)
    return out


def reshaped(key: bytes, tweak: str, text: str, alphabets: list[str] = ALPHABETS) -> str:
    """``text`` permuted among the strings of its shape; characters of no alphabet stay."""
    where = [(i, a, a.index(c)) for i, c in enumerate(text) for a in alphabets if c in a]
    shape = "".join(str(alphabets.index(a)) for _, a, _ in where)
    moved = permuted(key, f"{tweak}|{shape}", [v for _, _, v in where], [len(a) for _, a, _ in where])
    out = list(text)
    for (i, a, _), v in zip(where, moved):
        out[i] = a[v]
    return "".join(out)


def script_of(word: str) -> str:
    return "cyrillic" if any("а" <= c <= "ё" for c in word.lower()) else "latin"


def surrogate(key: bytes, kind: str, entity: str, draw: int = 0) -> str:
    """The surrogate of a canonical ``entity``; ``draw`` counts the draws that clashed."""
    tweak = f"{kind}|{draw}"
    if kind == "card":
        body = reshaped(key, tweak, entity[:-1])
        return next(body + c for c in "0123456789" if luhn(body + c))
    if kind == "iban":
        body = reshaped(key, tweak, entity[4:].lower()).upper()
        return entity[:2] + f"{98 - iban_rest(body + entity[:2] + '00'):02d}" + body
    if kind == "ip":
        number = permuted(key, tweak, [int(o) for o in entity.split(".")], [256] * 4)
        return ".".join(map(str, number))
    if kind == "email":
        local, _, domain = entity.rpartition("@")
        host, dot, top = domain.rpartition(".")
        return reshaped(key, tweak, local) + "@" + reshaped(key, "domain", host) + dot + top
    if kind == "token":
        if all(c in "0123456789abcdef" for c in entity):
            return reshaped(key, tweak, entity, [ALPHABETS[0], HEX_LETTERS])
        return reshaped(key, tweak, entity, [*ALPHABETS, ALPHABETS[1].upper()])
    if kind.startswith(("given", "surname")):
        script = script_of(entity)
        told = int.from_bytes(hmac.new(key, f"{tweak}|{entity}".encode(), hashlib.sha256).digest(), "big")
        parts = []
        # A draw more is a syllable more, so there is a name for any number of entities.
        for _ in range(4 + draw):
            told, k = divmod(told, len(SYLLABLES[script]))
            parts.append(SYLLABLES[script][k])
        return "".join(parts) + (ENDINGS[script][kind[-1]] if kind.startswith("given") else "")
    return reshaped(key, tweak, entity)


def _shaped_like(original: str, letters: str) -> str:
    """The characters of ``letters`` in the places and cases of the letters and digits of ``original``."""
    source = iter(letters)
    return "".join((lambda r: r.upper() if c.isupper() else r)(next(source)) if c.isalnum() else c for c in original)


Span = tuple[int, int, str, str]


def find(text: str) -> list[Span]:
    """``(start, end, kind, canonical)`` of every entity, in order and without overlaps."""
    found: list[Span] = []

    def add(start: int, end: int, kind: str, canonical: str) -> None:
        at = bisect_left(found, (start,))
        if (at == 0 or found[at - 1][1] <= start) and (at == len(found) or found[at][0] >= end):
            found.insert(at, (start, end, kind, canonical))

    done = 0
    for m in _AT_DOMAIN.finditer(text):
        # Leftwards from the sign, so that a long run of letters without one is not tried from each of them.
        start = m.start()
        while start > done and (text[start - 1].isalnum() or text[start - 1] in "_.%+-"):
            start -= 1
        if start < m.start():
            done = m.end()
            add(start, done, "email", text[start:done].lower())
    if "=" in text or ":" in text:
        for m in _TOKEN.finditer(text):
            group = m.lastgroup
            value = m[group]
            hexed = value.lower()
            add(*m.span(group), "token", hexed if all(c in "0123456789abcdef" for c in hexed) else value)
    if any(c in text for c in "0123456789"):
        at = 0
        while m := _IBAN.search(text, at):
            iban = iban_in(m[0])
            at = m.start() + len(iban or " ")
            if iban:
                add(m.start(), at, "iban", iban.replace(" ", ""))
        at = 0
        while m := _CARD.search(text, at):
            card = card_in(m[0])
            at = m.start() + len(card or m[0])
            if card:
                add(m.start(), at, "card", re.sub(r"\D", "", card))
        for m in _SSN.finditer(text):
            add(*m.span(), "ssn", re.sub(r"\D", "", m[0]))
        for m in _PHONE.finditer(text):
            code = re.match(r"\+\d{1,3}", m[0])
            digits = re.sub(r"\D", "", m[0][code.end() :] if code else m[0])
            if 7 <= len(digits) <= 14:
                add(m.start() + (code.end() if code else 0), m.end(), "phone", digits)
        for m in _IP.finditer(text):
            parts = [int(o) for o in m[0].split(".")]
            if all(o < 256 for o in parts):
                add(*m.span(), "ip", ".".join(map(str, parts)))
    if _TITLE_AHEAD.search(text):
        for m in _NAME.finditer(text):
            gender = _GENDER[m[1]]
            if m[3]:
                add(*m.span(2), f"given:{gender}", m[2].lower())
                add(*m.span(3), "surname", m[3].lower())
            else:
                add(*m.span(2), "surname", m[2].lower())
    return found


def rendered(original: str, kind: str, new: str) -> str:
    """A canonical surrogate in the format of the original mention."""
    if kind in ("ip", "email"):
        return "".join(n.upper() if o.isupper() else n for o, n in zip(original, new)) if kind == "email" else new
    if kind == "token":
        return new.upper() if original.isupper() and new == new.lower() else new
    if kind == "surname" or kind.startswith("given"):
        return new.upper() if original.isupper() and len(original) > 1 else new.capitalize()
    return _shaped_like(original, new)


def rewrite(text: str, key: bytes, draws: dict[tuple[str, str], int]) -> tuple[str, list[Span]]:
    """``text`` with its entities replaced, and the entities found."""
    spans = find(text)
    parts, at = [], 0
    for start, end, kind, entity in spans:
        new = surrogate_of(key, kind, entity, draws.get((kind, entity), 0))
        parts += [text[at:start], rendered(text[start:end], kind, new)]
        at = end
    return "".join([*parts, text[at:]]), spans


@lru_cache(maxsize=100_000)
def surrogate_of(key: bytes, kind: str, entity: str, draw: int) -> str:
    return surrogate(key, kind, entity, draw)


def mentions(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``kind``, ``entity`` (canonical) of every entity found."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [
                (i, kind, entity)
                for i, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())
                for _, _, kind, entity in find(text)
            ]
            columns = list(zip(*rows)) if rows else [(), (), ()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.string()), pa.array(columns[2], pa.string())],
                ["doc_id", "kind", "entity"],
            )

    arrow_batches(docs.sparkSession)
    # No entity is without one of these: digits, an at sign, an assignment, a form of address.
    likely = docs.where(F.col("text").rlike("[0-9@=:]|" + _TITLE_AHEAD.pattern))
    return likely.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, kind string, entity string")


def redrawn(entities: DataFrame, key: bytes) -> DataFrame:
    """``kind``, ``entity``, ``draw`` of the distinct entities whose first surrogate clashed."""
    schema = "kind string, entity string, draw int, surrogate string"

    def draw(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in batches:
            part["surrogate"] = [surrogate(key, *row) for row in zip(part["kind"], part["entity"], part["draw"])]
            yield part

    names = store(entities, "entities")
    current = names.withColumn("draw", F.lit(0))
    for _ in range(DRAWS):
        drawn = store(current.mapInPandas(draw, schema), "surrogates")
        firsts = drawn.groupBy("kind", "surrogate").agg(F.min("entity").alias("entity"), F.count("*").alias("n"))
        twice = drawn.join(firsts.where("n > 1").select("kind", "surrogate", F.col("entity").alias("owner")), ["kind", "surrogate"])
        taken = drawn.join(names.select("kind", F.col("entity").alias("surrogate")), ["kind", "surrogate"], "left_semi")
        bad = twice.where("entity <> owner").select("kind", "entity").unionAll(taken.select("kind", "entity")).distinct()
        bad = store(bad.withColumn("again", F.lit(1)), "clashes")
        if not bad.count():
            return drawn.where("draw > 0").drop("surrogate")
        current = drawn.join(bad, ["kind", "entity"], "left").select(
            "kind", "entity", (F.col("draw") + F.coalesce("again", F.lit(0))).alias("draw")
        )
    raise ValueError("surrogates still clash: the shape of these entities leaves too few strings")


ADDED = "n_entities int, entities array<struct<kind: string, start: int, end: int>>"


def surrogate_key(spark: SparkSession) -> str:
    """The secret of the session's settings, else a fresh one that nobody knows: surrogates of two runs then differ."""
    return spark.conf.get(KEY_CONF, None) or secrets.token_hex(32)


def redact(docs: DataFrame, key: str) -> DataFrame:
    """``docs`` with ``text`` rewritten, ``n_entities`` and the spans of ``entities`` in the original text.

    ``key`` is the secret that the surrogates follow from; whoever has it can undo them.
    """
    if not key:
        raise ValueError("surrogates need a secret key")
    secret = hashlib.sha256(key.encode()).digest()
    found = mentions(docs)
    again = store(redrawn(found.select("kind", "entity").distinct(), secret), "redrawn")
    given = docs.drop("n_entities", "entities")
    names = given.columns
    none = again.isEmpty()
    if not none:  # each document brings the draws of its own entities
        own = found.join(again, ["kind", "entity"]).groupBy("doc_id").agg(
            F.collect_set(F.struct("kind", "entity", "draw")).alias("_draws")
        )
        own = store(own.withColumnRenamed("doc_id", "_doc"), "draws")
        given = given.join(if_small(own, DRAWN_DOCS), given["doc_id"].eqNullSafe(own["_doc"]), "left").select(*names, "_draws")
    text_at = names.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            brought = None if none else batch.column(len(names)).to_pylist()
            texts, n, spans = [], [], []
            for i, text in enumerate(batch.column(text_at).to_pylist()):
                own = {(d["kind"], d["entity"]): d["draw"] for d in brought[i] or ()} if brought else {}
                new, entities = rewrite(text, secret, own) if text else (text, [])
                texts.append(new)
                n.append(len(entities))
                spans.append([{"kind": k, "start": s, "end": e} for s, e, k, _ in entities])
            columns = list(batch.columns[: len(names)])
            columns[text_at] = pa.array(texts, pa.string())
            kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))
            columns += [pa.array(n, pa.int32()), pa.array(spans, kind)]
            yield pa.RecordBatch.from_arrays(columns, [*names, "n_entities", "entities"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.drop("n_entities", "entities").schema)
    return given.mapInArrow(run, f"{schema}, {ADDED}")
