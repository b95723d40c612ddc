"""Personal data: keyed, type-consistent surrogates.

1. Detection. Each text is searched for e-mail and IPv4 addresses, phone
   numbers, payment cards (Luhn-valid), IBANs (valid check digits), social
   security numbers, access keys, tokens and passwords, and names: all capitalised words
   after a title (past initials and particles, which stay), and wherever else
   the same text has one of them.
   An entity is a type and a canonical form (digits of a phone number however
   written, lower-cased addresses, one part of a name), so all mentions of one
   entity, in whatever format, meet.
2. Surrogates. The distinct entities get a replacement drawn by a keyed hash of
   type and canonical form: same key, same entity, same surrogate, in any
   document and run. It keeps the type's form: lengths and character classes,
   a card's first digit and a valid check digit, an IBAN's country and check
   digits, an address's top-level domain, a name's gender (from its title) and
   script.
3. Collision checks. A surrogate must belong to one entity, and be no entity
   that occurs itself. Of entities that share one, the first settled (then the
   smallest) keeps it; the others draw again, until none collide.
4. The surrogates are joined back to the mentions and written into the texts in
   each mention's own layout.

Only texts with an entity move; entities are de-duplicated before anything is
drawn, and a frequent entity is a skewed key that AQE splits.

Defined results: null and empty texts have no entities; rows are judged one by
one, so rows that share a doc_id each have their own. Overlapping finds: the
longer, then the earlier type of ``TYPES``, wins.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trackyard.llm.common import map_batches, stored, utf8

TYPES = ("email", "key", "token", "password", "iban", "card", "ssn", "phone", "ip", "given_f", "given_m", "given_x",
         "surname")
MAX_DRAWS = 64
_WIDE = 16  # after so many draws the form is widened, so that a full set of short forms can't go on for ever

# titles by the gender they tell
_TITLES = {
    "f": ("Mrs", "Ms", "Miss", "Frau", "Madame", "Mme", "Mademoiselle", "Señora", "Sra", "Señorita", "Signora", "г-жа"),
    "m": ("Mr", "Mister", "Sir", "Herr", "Monsieur", "Señor", "Sr", "Signor", "г-н"),
    "x": ("Dr", "Prof", "Professor"),
}
_GENDER = {t: g for g, ts in _TITLES.items() for t in ts}
# given names by script and gender, family name parts by script
_GIVEN = {
    "latin": {"f": ("Anna", "Clara", "Elena", "Ida", "Julia", "Laura", "Marta", "Nora", "Paula", "Sara"),
              "m": ("Anton", "Bruno", "Carl", "David", "Emil", "Hugo", "Leon", "Martin", "Oscar", "Victor"),
              "x": ("Alex", "Charlie", "Dominique", "Kim", "Robin", "Sascha", "Toni", "Noa")},
    "cyrillic": {"f": ("Анна", "Вера", "Елена", "Ирина", "Мария", "Ольга"),
                 "m": ("Антон", "Борис", "Виктор", "Иван", "Олег", "Павел"), "x": ("Саша", "Женя", "Валя")},
    "greek": {"f": ("Άννα", "Ελένη", "Μαρία", "Σοφία"), "m": ("Γιάννης", "Νίκος", "Πέτρος", "Σπύρος"),
              "x": ("Άλεξ", "Χάρις")},
}
_SYLLABLES = {
    "latin": ("bar", "del", "fen", "gar", "hol", "ken", "lin", "mar", "nor", "pel", "ros", "sten", "tal", "ver", "wal"),
    "cyrillic": ("бел", "вор", "гор", "дан", "лав", "мир", "нов", "пет", "ров", "сол", "тих"),
    "greek": ("βαρ", "δημ", "καλ", "λαμ", "μαν", "παπ", "στα", "φωτ"),
}
_ENDINGS = {"latin": ("er", "man", "son", "berg", "i", "o"), "cyrillic": ("ский", "енко", "юк"),
            "greek": ("ίδης", "άκης", "όπουλος")}

_NAME = r"[^\W\d_]*[A-ZÀ-ÖØ-ÞΑ-ΩΆ-ΏА-ЯЁ][^\W\d_]+(?:-[^\W\d_]+)?"
_PARTICLE = "(?:van|von|zu|der|den|de|del|della|di|da|dos|la|le)"  # stay as they are
_PATTERNS = {
    "email": re.compile(r"(?<![\w.+-])[\w+-]+(?:\.[\w+-]+)*@[\w-]+(?:\.[\w-]+)*\.[^\W\d_]{2,}(?!\w)"),
    "key": re.compile(r"(?<!\w)(?:AKIA|ASIA)[A-Z0-9]{16}(?!\w)|(?<!\w)(?:ghp|gho|sk|pk)_[A-Za-z0-9]{20,}(?!\w)"),
    "token": re.compile(r"(?i:token|secret|api_?key)\s*[=:]\s*[\"']([A-Za-z0-9+/_-]{16,}={0,2})[\"']"),
    "password": re.compile(r"(?i:password|passwd|pwd)\s*[=:]\s*[\"']?([^\s\"',;]{4,})"),
    "iban": re.compile(r"(?<!\w)[A-Z]{2}\d{2}(?: ?[A-Z0-9]){11,30}(?!\w)"),
    "card": re.compile(r"(?<![\w.-])\d(?:[ -]?\d){12,18}(?![\w-])"),
    "ssn": re.compile(r"(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-])"),
    "phone": re.compile(r"(?<![\w+])\+\d{1,3}(?:[ .-]?\(?\d{1,4}\)?){2,5}(?!\w)|"
                        r"(?<![\w(])(?:\(\d{3}\) ?|\d{3}[.-])\d{3}[.-]\d{4}(?!\w)"),
    "ip": re.compile(r"(?<![\w.])(?:(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)\.){3}(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)(?![\w]|\.\d)"),
    "name": re.compile(rf"(?<!\w)({'|'.join(sorted(_GENDER, key=len, reverse=True))})\.?"
                       rf"((?:[  ](?:{_PARTICLE}[  ])*(?:{_NAME}|[^\W\d_]\.))+)"),
}
_WORD = re.compile(_NAME)
_PART = re.compile(r"[^\W\d_]+")
_ANY = re.compile(rf"(?<!\w){_NAME}(?!\w)")
_MAYBE = {"email": re.compile("@"), "key": re.compile("AKIA|ASIA|gh[po]_|[sp]k_"), "token": re.compile("(?i)token|secret|api_?key"),
          "password": re.compile("(?i)passw|pwd")}
_DIGITS = re.compile(r"\d[\d. ()+-]{5}|[A-Z]{2}\d\d")
_NUMERIC = ("iban", "card", "ssn", "phone", "ip")


def luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        x = int(d) * (1 + k % 2)
        total += x - 9 if x > 9 else x
    return total % 10 == 0


def _iban_rest(iban: str) -> int:
    return int("".join(str(int(c, 36)) for c in iban[4:] + iban[:4])) % 97


def script_of(word: str) -> str:
    if any("Ѐ" <= c <= "ԯ" for c in word):
        return "cyrillic"
    return "greek" if any("Ͱ" <= c <= "Ͽ" for c in word) else "latin"


def canonical(kind: str, text: str) -> str | None:
    """The form all mentions of an entity share; None if the find is none."""
    if kind == "email" or kind.startswith("given") or kind == "surname":
        return text.casefold()
    if kind == "card":
        digits = re.sub(r"\D", "", text)
        return digits if luhn(digits) and len(set(digits)) > 1 else None
    if kind == "iban":
        iban = text.replace(" ", "")
        return iban if 15 <= len(iban) <= 34 and _iban_rest(iban) == 1 else None
    if kind == "phone":
        digits = re.sub(r"\D", "", text)
        if not 7 <= len(digits) <= 15:
            return None
        return digits if text.startswith("+") else "1" + digits
    if kind == "ssn":
        return text if not text.startswith(("000", "666", "9")) else None
    return text


def entities(text: str) -> list[tuple[int, int, str, str]]:
    """(start, end, type, canonical) in code points, not overlapping, in order."""
    found: list[tuple[int, int, str, str]] = []
    names: dict[str, set[str]] = {}
    numeric = _DIGITS.search(text)
    for kind, pattern in _PATTERNS.items():
        if kind in _NUMERIC and not numeric or kind in _MAYBE and not _MAYBE[kind].search(text):
            continue
        for m in pattern.finditer(text):
            if kind == "name":
                parts = [x.span() for x in _WORD.finditer(text, *m.span(2))]
                if not parts:
                    continue
                spans = [(p, f"given_{_GENDER[m[1]]}") for p in parts[:-1]] + [(parts[-1], "surname")]
                for (a, b), k in spans:
                    names.setdefault(text[a:b].casefold(), set()).add(k)
            else:
                spans = [(m.span(m.lastindex or 0), kind)]
            for (a, b), k in spans:
                c = canonical(k, text[a:b])
                if c is not None:
                    found.append((a, b, k, c))
    if names:  # the same names without a title, as the same entities
        titled = {x[:2] for x in found if x[2] == "surname" or x[2].startswith("given")}
        for m in _ANY.finditer(text):
            # a double name is looked for as it is, or else part by part
            for a, b in [m.span()] if m[0].casefold() in names else [x.span() for x in _PART.finditer(text, *m.span())]:
                kinds = names.get(text[a:b].casefold())
                if kinds and (a, b) not in titled:
                    found.append((a, b, max(kinds, key=TYPES.index), text[a:b].casefold()))
    found.sort(key=lambda x: (x[0] - x[1], TYPES.index(x[2]), x[0]))
    taken: list[tuple[int, int, str, str]] = []  # in order, so that a find meets its neighbours alone
    for x in found:
        at = bisect(taken, x)
        if (at == 0 or taken[at - 1][1] <= x[0]) and (at == len(taken) or x[1] <= taken[at][0]):
            taken.insert(at, x)
    return taken


class _Draw:
    """A stream of numbers from the key, the entity and the number of the draw."""

    def __init__(self, key: bytes, *what: object):
        self.key, self.what, self.at, self.pool = key, "\0".join(map(str, what)).encode(), 0, b""

    def below(self, n: int) -> int:
        if len(self.pool) < 4:
            self.pool += hashlib.blake2b(self.what + self.at.to_bytes(4, "big"), key=self.key[:64]).digest()
            self.at += 1
        x, self.pool = int.from_bytes(self.pool[:4], "big"), self.pool[4:]
        return x * n >> 32

    def of(self, choices):
        return choices[self.below(len(choices))]

    def like(self, c: str) -> str:
        """A character of the same class and script; others stay."""
        for low, high in (("0", "9"), ("a", "z"), ("A", "Z"), ("а", "я"), ("А", "Я"), ("α", "ω"), ("Α", "Ρ")):
            if low <= c <= high:
                return chr(ord(low) + self.below(ord(high) - ord(low) + 1))
        return self.of("aeiou") if c.isalpha() and c.islower() else self.of("AEIOU") if c.isalpha() else c


def surrogate(key: bytes, kind: str, entity: str, draw: int) -> str:
    """The canonical form of the replacement."""
    d = _Draw(key, kind, entity, draw)
    extra = "".join(str(d.below(10)) for _ in range(draw // _WIDE))
    if kind == "email":
        local, domain = entity.rsplit("@", 1)
        host, top = domain.rsplit(".", 1)
        # the host is drawn by itself: one host stays one host
        h = _Draw(key, "host", host)
        return "".join(map(d.like, local)) + extra + "@" + "".join(map(h.like, host)) + "." + top
    if kind == "card":
        body = entity[0] + "".join(str(d.below(10)) for _ in entity[1:-1])
        return next(body + c for c in "0123456789" if luhn(body + c))
    if kind == "iban":
        body = "".join(map(d.like, entity[4:]))
        return f"{entity[:2]}{98 - _iban_rest(entity[:2] + '00' + body):02d}{body}"
    if kind == "phone":
        keep = 1 if entity[0] in "17" else 2
        return entity[:keep] + str(2 + d.below(8)) + "".join(str(d.below(10)) for _ in entity[keep + 1:])
    if kind == "ssn":
        return f"{1 + d.below(665):03d}-{1 + d.below(99):02d}-{1 + d.below(9999):04d}"
    if kind == "ip":
        if draw >= _WIDE:
            return ".".join(str(1 + d.below(254)) for _ in range(4))
        bounds = {1: (1, 9), 2: (10, 99), 3: (100, 254)}
        return ".".join(str(low + d.below(high - low + 1)) for low, high in (bounds[len(o)] for o in entity.split(".")))
    if kind == "key":
        prefix = re.match(r"AKIA|ASIA|[a-z]+_", entity)[0]
        return prefix + "".join(d.of("ABCDEFGHIJKLMNOPQRSTUVWXYZ234567") if prefix.isupper() else d.like(c)
                                for c in entity[len(prefix):])
    if kind in ("token", "password"):
        hexadecimal = re.fullmatch(r"[0-9a-f]+", entity)
        return "".join(d.of("0123456789abcdef") if hexadecimal else d.like(c) for c in entity) + extra
    script = script_of(entity)
    if kind == "surname":
        parts = [d.of(_SYLLABLES[script]) for _ in range(2 + d.below(2) + draw // 4)]
        return ("".join(parts) + d.of(_ENDINGS[script])).casefold()
    names = _GIVEN[script][kind[-1]]
    # given names are few: beyond the list they are made double names
    return "-".join(d.of(names) for _ in range(1 + draw // 4)).casefold()


def render(kind: str, mention: str, replacement: str) -> str:
    """The replacement in the mention's own layout."""
    if kind in ("card", "phone", "iban"):
        signs = sum(c.isalnum() for c in mention)
        rest = iter(replacement[-signs:])
        return "".join(next(rest, "") if c.isalnum() else c for c in mention)
    if kind.startswith("given") or kind == "surname":
        return replacement.upper() if mention.isupper() and len(mention) > 1 else \
            "-".join(p[:1].upper() + p[1:] for p in replacement.split("-"))
    return replacement


_ENTITY = "struct<start:int,end:int,type:string,entity:string>"
_ENTITY_ARROW = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("type", pa.string()),
                                    ("entity", pa.string())]))


def _find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for at in range(0, whole.num_rows, 1024):
            ids, texts, found = [], [], []
            batch = whole.slice(at, 1024)
            for doc_id, raw in zip(batch.column(0), batch.column(1), strict=True):
                text = raw.as_py().decode("utf-8", "replace")
                got = entities(text)
                if got:
                    ids.append(doc_id.as_py())
                    texts.append(text)
                    found.append([{"start": a, "end": b, "type": k, "entity": c} for a, b, k, c in got])
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(texts, pa.string()),
                                              pa.array(found, _ENTITY_ARROW)], names=["doc_id", "text", "found"])


def _drawing(key: bytes):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [surrogate(key, k.as_py(), e.as_py(), n.as_py()) for k, e, n in zip(*batch.columns[:3], strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(made, pa.string())],
                                             names=["type", "entity", "draw", "surrogate"])
    return run


def settle(distinct: DataFrame, key: bytes) -> DataFrame:
    """(type, entity, draw, surrogate) without collisions; ``distinct`` (type, entity) is a written table."""
    schema = "type string, entity string, draw int, surrogate string"
    table = stored(map_batches(distinct.withColumn("draw", F.lit(0)), _drawing(key), schema), "surrogates")
    real = distinct.select("type", F.col("entity").alias("surrogate"), F.lit(True).alias("real"))
    for _ in range(MAX_DRAWS):
        first = table.groupBy("type", "surrogate").agg(
            F.min(F.struct("draw", "entity")).alias("keeper"), F.count("entity").alias("n"))
        judged = table.join(first, ["type", "surrogate"]).join(real, ["type", "surrogate"], "left").withColumn(
            "again", F.col("real").isNotNull() | ((F.col("n") > 1) & (F.col("keeper.entity") != F.col("entity"))))
        judged = stored(judged.select("type", "entity", "draw", "surrogate", "again"), "judged")
        if judged.filter("again").isEmpty():
            return table
        redrawn = map_batches(judged.filter("again").select("type", "entity", (F.col("draw") + 1).alias("draw")),
                              _drawing(key), schema)
        table = stored(judged.filter("not again").drop("again").unionAll(redrawn), "surrogates")
    raise RuntimeError(f"surrogates still collide after {MAX_DRAWS} draws")


def _write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts, spans = [], []
        for text, found in zip(batch.column(2), batch.column(3), strict=True):
            t, out, at, own = text.as_py(), [], 0, []
            for e in sorted(found.as_py(), key=lambda e: e["start"]):
                made = render(e["type"], t[e["start"]:e["end"]], e["surrogate"])
                out += [t[at:e["start"]], made]
                at = e["end"]
                own.append({"start": e["start"], "end": e["end"], "type": e["type"], "surrogate": made})
            texts.append("".join([*out, t[at:]]))
            spans.append(own)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array(spans, pa.list_(pa.struct(
                [("start", pa.int32()), ("end", pa.int32()), ("type", pa.string()), ("surrogate", pa.string())])))],
            names=["row", "doc_id", "text", "spans"])


def pseudonymised(docs: DataFrame, key: bytes, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_entities, spans, text) of each row that has an entity: where, which type, what stands there now.

    Texts that are not listed have none and stay as they are.
    """
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), utf8(text_col).alias("text"))
    # the row numbers are written down, so that they can't change
    found = stored(map_batches(rows, _find, f"doc_id bigint, text string, found array<{_ENTITY}>").select(
        F.monotonically_increasing_id().alias("row"), "doc_id", "text", "found"), "entities")
    mentions = found.select("row", F.explode("found").alias("e")).select("row", "e.*")
    distinct = stored(mentions.select("type", "entity").distinct(), "distinct-entities")
    named = settle(distinct, key).select("type", "entity", "surrogate")
    filled = mentions.join(named, ["type", "entity"]).groupBy("row").agg(
        F.collect_list(F.struct("start", "end", "type", "surrogate")).alias("found"))
    loaded = found.select("row", "doc_id", "text").join(filled, "row").select("row", "doc_id", "text", "found")
    span = "array<struct<start:int,end:int,type:string,surrogate:string>>"
    return map_batches(loaded, _write, f"row bigint, doc_id bigint, text string, spans {span}").select(
        "doc_id", F.size("spans").cast("bigint").alias("n_entities"), "spans", "text")
