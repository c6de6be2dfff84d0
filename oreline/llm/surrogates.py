"""Surrogates for personal data: keyed, of the same type, distinct and consistent.

1. Detectors find entities; each has a kind and a normal form (e-mails without
   regard to case, telephone numbers by their national digits, names word by
   word), so that mentions of one entity agree in all documents and formats.  A
   title shows a name; in the same text its surname counts without one too, with
   the given names (of that text or GIVEN) and initials right before it.
2. Every entity gets a surrogate drawn from an HMAC of key, kind, normal form
   and attempt: letters become letters of the same script, digits digits; card
   numbers keep issuer digit and check sum, addresses stay addresses, given
   names keep their gender.  Initials are shifted along the alphabet by the key;
   they may equal other initials, as one letter names nobody.
3. Collisions are checked over the whole corpus: of entities with one surrogate
   the smallest keeps it, and one that equals a real entity of the corpus is
   taken from all; the others draw again until none is left.  Mailboxes, hosts
   and names grow when short shapes are used up.  Values of a fixed length that
   find no free surrogate in MOST attempts, because nearly every value of their
   shape is real, are permuted among themselves: surrogates stay distinct and
   nobody keeps the own value, but they equal values of others.
   A given name met with a title that tells no gender is that of the same name
   with one, in its text or else in the corpus.
4. Mentions are rewritten in their own format (punctuation and case stay).

Defined results: a null text stays null, an empty one empty; equal texts are
rewritten alike; null or repeated ids do not matter; an empty table gives an
empty table.  Other columns are kept, whatever their names.
"""

from __future__ import annotations

import hashlib
import hmac
import re

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from oreline.session import scratch_path

GIVEN = {
    "f": ["Anna", "Clara", "Elena", "Julia", "Laura", "Maria", "Nora", "Paula", "Sara", "Emma", "Mary", "Linda", "Susan", "Karen", "Lisa", "Sofia", "Marta", "Ines", "Claire", "Louise"],
    "m": ["Adam", "Bruno", "David", "Felix", "Jonas", "Lucas", "Martin", "Oscar", "Paul", "Simon", "John", "James", "Robert", "Peter", "Thomas", "Carlos", "Pablo", "Louis", "Jean", "Hans"],
}
TITLES = {"Mr": "m", "Herr": "m", "Monsieur": "m", "Señor": "m", "Sr": "m", "Mrs": "f", "Ms": "f", "Miss": "f", "Frau": "f",
          "Madame": "f", "Mme": "f", "Señora": "f", "Sra": "f", "Dr": "", "Prof": ""}
_TITLE = "|".join(sorted(TITLES, key=len, reverse=True))
#: A name starts with a capital, or with a letter of a script without capitals.
_CAPITAL = r"[A-ZÀ-ÖØ-ÞĀ-ŽΆ-ΫЀ-Я一-鿿ぁ-ヿ가-힣א-ת]"
_NAME = rf"{_CAPITAL}[\w'’-]+"
#: What may stand before the last name: J. or J, and J.-Pierre.
_INITIAL = rf"{_CAPITAL}(?:\.-{_NAME} |\.[ -]?| )"
PHONES = [
    r"(?:\+\d{1,3}[ .-]?|\d{1,2}[ .-])?(?:\(\d{2,4}\) ?|\d{2,4}[ .-])\d{3,4}[ .-]\d{3,4}",
    r"(?:\+\d{2,3}[ .-]?(?:\(0\) ?)?[1-9]|0[1-9])(?:[ .-]?\d{2}){4}(?![ .-]?\d)",  # 06 12 34 56 78, +33 6 12 34 56 78
    r"(?:\+34[ .-]?)?(?:[6-9]\d{2}(?:[ .-]\d{2}){3}|[89]\d[ .-]\d{3}(?:[ .-]\d{2}){2})",  # 612 34 56 78, 91 123 45 67
    r"\+[1-9]\d{0,2}[ .-]?(?:\(0\) ?)?(?:\(\d{1,4}\) ?|\d{1,4}[ ./-])?\d{5,12}",  # +14155552671, +49 30 123456
    r"\+[1-9]\d{0,2}[ .-]?(?:\(0\) ?)?(?:\(\d{1,4}\) ?)?\d(?:[ ./-]?\d){5,12}",
    r"\(?0[1-9]\d{1,3}(?:\)[ ]?|[ /-])\d{5,8}",  # 030 123456, (030) 123456, 0171/1234567
]
#: Country codes of one and two digits; the others have three.
COUNTRY = re.compile(r"1|7|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]")
PATTERN = re.compile("|".join([
    r"(?P<email>[A-Za-z0-9][A-Za-z0-9._%+-]*@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,})",
    r"(?P<ip>(?<![\d.])(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){3}(?:25[0-5]|2[0-4]\d|1?\d?\d)(?![\d]|\.\d))",
    r"(?P<ssn>(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-]))",
    r"(?P<card>(?<![\w+-])\d(?:[ -]?\d){12,18}(?![\w-]))",
    rf"(?P<phone>(?<![\w.+])(?:{'|'.join(PHONES)})(?!\w|[.-]\d))",
    rf"(?P<person>\b(?:{_TITLE})\b\.? (?:(?:{_INITIAL})+{_NAME}|{_NAME}(?: (?:{_INITIAL})*{_NAME})?))"]))
#: Words of a name: initials and longer ones.
WORD = re.compile(rf"(?:(?<![\w-])|(?<=\.-))(?:{_NAME}|{_CAPITAL}(?!\w))")
#: What a text must hold for any detector to match; checked without Python.
HINT = rf"[@0-9]|\b(?:{_TITLE})\b"


def _digits(text: str) -> str:
    return re.sub(r"\D", "", text)


def _national(value: str) -> str:
    """The digits of a telephone number without country code and leading 0."""
    digits = _digits(value)
    if value.startswith("+"):
        code = COUNTRY.match(digits)
        digits = digits[code.end() if code else 3:]
    elif not digits.startswith("0"):
        digits = digits[-10:]
    return digits[1:] if digits.startswith("0") else digits


def luhn(digits: str) -> bool:
    total = sum(sum(divmod(2 * int(d), 10)) if i % 2 else int(d) for i, d in enumerate(reversed(digits)))
    return total % 10 == 0


def entities(text: str | None) -> list[tuple[int, int, list[tuple[str, str, int, int]]]]:
    """(start, end, parts) of each mention; a part is (kind, normal form, start, end)."""
    out = []
    for m in PATTERN.finditer(text or ""):
        kind, s, e = m.lastgroup, m.start(), m.end()
        value = m.group()
        if kind == "email":
            at = value.index("@")
            parts = [("user", value[:at].lower(), s, s + at), ("host", value[at + 1:].lower(), s + at + 1, e)]
        elif kind == "card":
            digits = _digits(value)
            parts = [("card" if luhn(digits) else "number", digits, s, e)]
        elif kind == "phone":
            parts = [("phone", _national(value), s, e)]
        elif kind == "person":
            title = re.match(r"\w+", value)
            words = list(WORD.finditer(text, s + title.end(), e))
            parts = [_part(w, f"given{TITLES[title.group()] or _gender(w.group())}") for w in words[:-1]] + [_part(words[-1], "surname")]
        else:
            parts = [(kind, value, s, e)]
        out.append((s, e, parts))
    return _gendered(_untitled(text, out)) if any(p[0] == "surname" for m in out for p in m[2]) else out


def _gendered(found: list) -> list:
    """``found`` with given names of unknown gender as the same name of known gender in this text."""
    known: dict[str, str] = {}
    for kind, value, _, _ in (p for m in found for p in m[2]):
        if kind in ("givenf", "givenm"):
            known.setdefault(value, kind)
    return [(s, e, [(known.get(p[1], p[0]) if p[0] == "given" else p[0], *p[1:]) for p in parts]) for s, e, parts in found]


def _part(word: re.Match, kind: str) -> tuple[str, str, int, int]:
    """A word of a name, without a possessive ending; a single letter before the surname is an initial."""
    name = re.sub(r"(?<=\w)(?:['’][sS]?|-+)$", "", word.group())
    return ("initial" if len(name) == 1 and kind != "surname" else kind, name.casefold(), word.start(), word.start() + len(name))


def _untitled(text: str, found: list) -> list:
    """``found`` and the mentions of its people without a title, in order."""
    parts = [p for m in found for p in m[2]]
    surnames = {p[1] for p in parts if p[0] == "surname" and len(p[1]) > 1}
    given = {p[1]: p[0] for p in parts if p[0].startswith("given")}
    words, out, at, used = list(WORD.finditer(text)), [], 0, 0
    for k, word in enumerate(words):
        last = _part(word, "surname")
        if last[1] not in surnames:
            continue
        mention, j = [last], k - 1
        while j >= 0:
            name, between = words[j].group(), text[words[j].end():mention[0][2]]
            if len(name) == 1 and between in (".", ". ", ".-"):
                kind = "initial"
            elif between == " " and (name.casefold() in given or _gender(name)):
                kind = given.get(name.casefold()) or f"given{_gender(name)}"
            else:
                break
            mention.insert(0, _part(words[j], kind))
            j -= 1
        while at < len(found) and found[at][1] <= mention[0][2]:
            at += 1
        if mention[0][2] >= used and (at == len(found) or found[at][0] >= last[3]):
            out.append((mention[0][2], last[3], mention))
            used = last[3]
    return sorted(found + out, key=lambda m: m[0])


def _gender(name: str) -> str:
    return next((g for g, names in GIVEN.items() if name.title() in names), "")


class _Draw:
    """Numbers from an HMAC stream."""

    def __init__(self, key: bytes, kind: str, value: str, attempt: int):
        self.key, self.name = key, f"{kind}\0{value}\0{attempt}".encode("utf-8", "surrogatepass")
        self.block, self.pool = 0, b""

    def below(self, n: int) -> int:
        if len(self.pool) < 4:
            self.pool = hmac.new(self.key, self.name + self.block.to_bytes(4, "big"), hashlib.sha256).digest()
            self.block += 1
        value, self.pool = int.from_bytes(self.pool[:4], "big"), self.pool[4:]
        return value % n


#: First and last letters of the lower-case alphabets that are drawn from as such.
ALPHABETS = [("a", "z"), ("α", "ω"), ("а", "я"), ("ա", "ֆ"), ("א", "ת"), ("あ", "ん"), ("ア", "ン"), ("一", "鿿"), ("가", "힣")]


def alike(text: str, draw: _Draw) -> str:
    """Each letter another of its script, each digit another digit, the rest as it is."""
    out = []
    for k, c in enumerate(text):
        if c.isdecimal():
            number = 1 + draw.below(9) if int(c) and (k == 0 or not text[k - 1].isdigit()) else draw.below(10)
            out.append(chr(ord(c) - int(c) + number))
            continue
        low = c.lower()
        span = next(((ord(a), ord(b)) for a, b in ALPHABETS if a <= low <= b), None)
        if span is None and c.isalpha():
            span = (ord("a"), ord("z"))  # accented Latin letters and scripts without a row above
        out.append(c if span is None else chr(span[0] + draw.below(span[1] - span[0] + 1)))
    return "".join(out)


#: Attempts after which a value that may grow gets two characters more, each time.
GROWS = 8
#: Attempts after which a value counts as having no free surrogate.
MOST = 24
#: Values of a used-up shape that are permuted together, about.
RING = 100_000


def _grown(value: str, draw: _Draw, attempt: int) -> str:
    """``value`` in other letters and digits, longer by two of its last kind for every GROWS attempts."""
    last = next((c for c in reversed(value) if c.isalnum()), "a")
    return alike(value, draw) + alike(last * (2 * (attempt // GROWS)), draw)


def surrogate(key: bytes, kind: str, value: str, attempt: int) -> str:
    """The surrogate of a normal form, as a normal form of the same kind."""
    draw = _Draw(key, kind, value, attempt)
    if kind == "initial":
        low, high = next(((ord(a), ord(b)) for a, b in ALPHABETS if a <= value <= b), (ord("a"), ord("z")))
        shift = 1 + _Draw(key, kind, "", 0).below(high - low)
        return chr(low + (ord(value[0]) - low + shift) % (high - low + 1))
    if kind == "ip":
        first = value.split(".")[0]
        head = first if first in ("10", "127", "192", "172") and attempt < GROWS else str(1 + draw.below(223))
        return ".".join([head, *[str(1 + draw.below(254)) for _ in range(3)]])
    if kind == "ssn":
        return f"{1 + draw.below(665):03d}-{1 + draw.below(99):02d}-{1 + draw.below(9999):04d}"
    if kind == "card":
        body = value[0] + "".join(str(draw.below(10)) for _ in value[1:-1])
        return next(body + str(d) for d in range(10) if luhn(body + str(d)))
    if kind == "host":
        labels = value.split(".")
        return ".".join([_grown(labels[0], draw, attempt), *labels[1:]])
    if kind in ("givenf", "givenm") and value.isascii() and attempt < len(GIVEN[kind[-1]]):
        return GIVEN[kind[-1]][draw.below(len(GIVEN[kind[-1]]))].casefold()
    if kind in ("phone", "number"):
        return alike(value, draw)
    return _grown(value, draw, attempt)


def render(shape: str, kind: str, value: str) -> str:
    """A surrogate in the format of the mention it replaces."""
    if kind in ("phone", "card", "number"):
        digits, n = list(value), len(_digits(shape))
        keep = n - len(digits)  # a country code before the ten digits stays
        out = []
        for c in shape:
            if c.isdigit():
                out.append(c if keep > 0 else digits.pop(0))
                keep -= 1
            else:
                out.append(c)
        return "".join(out)
    if kind in ("ip", "ssn"):
        return value
    if shape.isupper() and len(shape) > 1:
        return value.upper()
    if shape[:1].isupper():
        return value[:1].upper() + value[1:]
    return value


def detected(texts: DataFrame) -> DataFrame:
    """(name, kind, value): the different entities of each text; ``texts`` holds (name, text)."""
    def kernel(batches):
        for batch in batches:
            rows = [(i, k, v) for i, t in enumerate(batch.column(1).to_pylist())
                    for k, v in dict.fromkeys((p[0], p[1]) for m in entities(t) for p in m[2])]
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array([r[0] for r in rows], pa.int64())),
                                              pa.array([r[1] for r in rows], pa.string()), pa.array([r[2] for r in rows], pa.string())],
                                             names=["name", "kind", "value"])

    return texts.mapInArrow(kernel, "name binary, kind string, value string")


def assigned(found: DataFrame, key: bytes) -> DataFrame:
    """(kind, value, surrogate), one row per different entity, no surrogate twice and none a real entity."""
    spark, base = found.sparkSession, scratch_path(found.sparkSession, "surrogates")

    def kernel(batches):
        for batch in batches:
            drawn = [surrogate(key, k, v, a) for k, v, a in zip(*(batch.column(c).to_pylist() for c in ("kind", "value", "attempt")))]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("kind", "value", "attempt")), pa.array(drawn, pa.string())],
                                             names=["kind", "value", "attempt", "surrogate"])

    family = F.when(F.col("kind").startswith("given"), "given").otherwise(F.col("kind")).alias("family")
    met = found.select("kind", "value").distinct()
    gender = met.where(F.col("kind").isin("givenf", "givenm")).groupBy("value").agg(F.min("kind").alias("known")).withColumn("kind", F.lit("given"))
    met.join(gender, ["kind", "value"], "left").withColumn("settled", F.coalesce("known", "kind")).drop("known").write.parquet(f"{base}/met")
    met = spark.read.parquet(f"{base}/met")
    real = met.select(F.col("settled").alias("kind"), "value").distinct()
    names = real.select(family, F.col("value").alias("surrogate")).distinct()
    now, turns = real.withColumn("attempt", F.lit(0)), []
    while True:
        drawn = now.mapInArrow(kernel, "kind string, value string, attempt int, surrogate string").withColumn("family", family)
        first = drawn.groupBy("family", "surrogate").agg(F.min(F.struct("kind", "value")).alias("first"))
        taken = names
        if turns:  # surrogates of earlier turns stay with their owners
            taken = names.unionByName(spark.read.parquet(*turns).where(~F.col("lost")).select(family, "surrogate"))
        hits = taken.join(drawn.select("family", "surrogate"), ["family", "surrogate"], "leftsemi").distinct().withColumn("hit", F.lit(True))
        judged = (drawn.join(first, ["family", "surrogate"]).join(hits, ["family", "surrogate"], "left")
                  .withColumn("lost", (F.col("kind") != "initial") & (F.col("hit").isNotNull() | (F.col("first") != F.struct("kind", "value")))))
        turns.append(f"{base}/turn{len(turns)}")
        judged.select("kind", "value", "attempt", "surrogate", "lost").write.parquet(turns[-1])
        lost = spark.read.parquet(turns[-1]).where("lost")
        if len(turns) > MOST or lost.isEmpty():
            break
        now = lost.select("kind", "value", (F.col("attempt") + 1).alias("attempt"))
    given = spark.read.parquet(*turns).where(~F.col("lost")).select("kind", "value", "surrogate")
    known = given.unionByName(permuted(lost.select("kind", "value"), real, key))
    return met.join(known.withColumnRenamed("kind", "settled"), ["settled", "value"]).select("kind", "value", "surrogate")


def permuted(stuck: DataFrame, real: DataFrame, key: bytes) -> DataFrame:
    """(kind, value, surrogate): ``stuck`` values of one shape in rings of keyed order, each getting the next one's value.

    A value that is stuck alone gets another real value of its shape; those of
    ``real`` that are not stuck have surrogates that are no real values.
    """
    shape = ["kind", "size"]
    size = F.when(F.col("kind").isin("phone", "number", "card"), F.length("value")).otherwise(0).alias("size")
    order = F.sha2(F.concat(F.lit(hmac.new(key, b"ring", hashlib.sha256).hexdigest()), "value"), 256)
    stuck = stuck.select("kind", size, "value", order.alias("order"))
    rings = stuck.groupBy(*shape).agg(F.ceil(F.count(F.lit(1)) / RING).cast("long").alias("rings"))
    others = real.join(stuck.select("kind").distinct(), "kind", "leftsemi").select("kind", size, "value").groupBy(*shape).agg(
        F.min("value").alias("low"), F.max("value").alias("high"))
    dealt = stuck.join(rings, shape).join(others, shape).withColumn("ring", F.pmod(F.xxhash64("order"), F.col("rings")))
    ring = Window.partitionBy(*shape, "ring").orderBy("order", "value")
    following = F.coalesce(F.lead("value").over(ring), F.first("value").over(ring))
    alone = F.when(F.col("low") != F.col("value"), F.col("low")).otherwise(F.col("high"))
    return (dealt.withColumn("next", following)
            .select("kind", "value", F.when(F.col("next") != F.col("value"), F.col("next")).otherwise(alone).alias("surrogate")))


def pseudonymize(docs: DataFrame, key: bytes, text: str = "text") -> DataFrame:
    """``docs`` with surrogates in ``text``, and ``_op1_replaced``, the number of mentions replaced.

    Only texts with a hint of an entity are shuffled; the others pass through.
    """
    marked = docs.withColumn("_op1_name", F.unhex(F.md5(F.coalesce(F.col(text), F.lit("")))))
    hint = F.coalesce(F.col(text).rlike(HINT), F.lit(False))
    base = scratch_path(docs.sparkSession, "mentions")
    detected(marked.where(hint).select(F.col("_op1_name").alias("name"), F.col(text).alias("text"))).distinct().write.parquet(f"{base}/found")
    found = docs.sparkSession.read.parquet(f"{base}/found")
    known = assigned(found, key)
    swaps = (found.join(known, ["kind", "value"]).groupBy(F.col("name").alias("_op1_name"))
             .agg(F.collect_list(F.struct("kind", "value", "surrogate")).alias("_op1_swaps")))
    names, at = docs.columns, docs.columns.index(text)

    def kernel(batches):
        for batch in batches:
            new, count = [], []
            for t, swap in zip(batch.column(at).to_pylist(), batch.column(len(names)).to_pylist()):
                table = {(x["kind"], x["value"]): x["surrogate"] for x in swap or ()}
                out, last, n = [], 0, 0
                for _, _, parts in entities(t) if table else ():
                    n += 1
                    for kind, value, s, e in parts:
                        out += [t[last:s], render(t[s:e], kind, table[kind, value])]
                        last = e
                new.append(t if t is None or not out else "".join(out) + t[last:])
                count.append(n)
            columns = [pa.array(new, pa.string()) if i == at else batch.column(i) for i in range(len(names))]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(count, pa.int64())], names=[f"c{i}" for i in range(len(names) + 1)])

    touched = marked.where(hint).join(swaps, "_op1_name", "left")
    touched = touched.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(names)], F.col("_op1_swaps").alias(f"c{len(names)}"))
    layout = ", ".join(f"c{i} {f.dataType.simpleString()}" for i, f in enumerate(docs.schema.fields))
    done = touched.mapInArrow(kernel, f"{layout}, c{len(names)} long").toDF(*names, "_op1_replaced")
    return done.unionByName(docs.where(~hint).withColumn("_op1_replaced", F.lit(0).cast("long")))
