"""Personal data replaced by keyed surrogates of the same type and form.

Detected: e-mail addresses (of at most 255 characters before the @; of the host the
first 128 labels at most, more than a name can have), IPv4 and
IPv6 addresses, IBANs, social security numbers, telephone numbers (international,
with a leading 0, and of ten digits), card numbers, secrets (long hexadecimal
strings and tokens with a known prefix), and names behind a title.  An entity's identity is its
type and its canonical form (letters and digits alone, lower case), so all its
spellings are one entity and get one surrogate, in every document.

A surrogate is made from a keyed digest of that identity, character by
character: a digit becomes a digit, a letter a letter of the same script and
case, everything else stays.  What a type fixes stays fixed: the country of a
telephone number or IBAN, the top-level domain, the issuer digit and a valid
check digit of a card, octets below 256.  A name takes one of the names of its
title's gender, in its script, followed by letters that make it distinct.

Distinctness is checked over all entities of the corpus: where two of a type get
one surrogate, or a surrogate is itself an entity, the later one is drawn again,
until none is left.  Only entities drawn again are looked up when the texts are
rewritten; all others are a function of the key, so rewriting is a narrow map.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from contraluz.llm.common import few, ship, stored, without

# fixed values: titles, names and alphabets
MALE_TITLES = "Mr Sir Herr Señor Sr Monsieur Господин господин г-н Κύριος κύριος"
FEMALE_TITLES = "Mrs Ms Miss Frau Señora Sra Madame Mme Госпожа госпожа г-жа Κυρία κυρία"
OTHER_TITLES = "Dr Prof"
MALE_NAMES = "Adrian Bruno Conrad Daniel Emil Felix Gabriel Hugo Ivan Jonas Karl Leon Marco Nils Oscar Pablo"
FEMALE_NAMES = "Alba Bianca Clara Dora Elena Flora Greta Helga Irene Julia Klara Lena Maria Nora Olga Paula"
MALE_CYRILLIC = "Андрей Борис Виктор Глеб Денис Егор Иван Кирилл"
FEMALE_CYRILLIC = "Анна Вера Галина Дарья Елена Жанна Ирина Ксения"
MALE_GREEK = "Γιώργος Δημήτρης Κώστας Μιχάλης Νίκος Πέτρος Σπύρος Χρήστος"
FEMALE_GREEK = "Βασιλική Ελένη Ζωή Κατερίνα Μαρία Νίκη Σοφία Χριστίνα"
DIGITS, LOWER, UPPER = "0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
CYRILLIC_LOWER, CYRILLIC_UPPER = "абвгдежзиклмнопрстуфхцчшщэюя", "АБВГДЕЖЗИКЛМНОПРСТУФХЦЧШЩЭЮЯ"
GREEK_LOWER, GREEK_UPPER = "αβγδεζηθικλμνξοπρστυφχψω", "ΑΒΓΔΕΖΗΘΙΚΛΜΝΞΟΠΡΣΤΥΦΧΨΩ"
HAN = "安白本大道东方高国海和花江金开来明南平青人山水天文心新星月中"
HEX = "0123456789abcdef"

_TITLES = f"{MALE_TITLES} {FEMALE_TITLES} {OTHER_TITLES}".split()
_HEX4 = "[0-9A-Fa-f]{1,4}"
_TITLE = "|".join(dict.fromkeys(_TITLES + [t.upper() for t in _TITLES]))
#: type and pattern; where several match at a place the first one holds
PATTERNS = {
    "email": r"(?<![\p{L}\p{N}])[\p{L}\p{N}][\p{L}\p{N}._%+-]{0,254}+@[\p{L}\p{N}-]+(?:\.[\p{L}\p{N}-]+){0,126}\.\p{L}{2,}",
    "ip": r"(?<![\d.])(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){3}(?:25[0-5]|2[0-4]\d|1?\d?\d)(?![\d.]*\d)",
    "ipv6": rf"(?<![\p{{L}}\p{{N}}:.])(?=[A-Fa-f:]*\d)(?:(?:{_HEX4}:){{7}}{_HEX4}|(?:{_HEX4}:){{1,7}}:(?!{_HEX4})"
            rf"|(?:{_HEX4}:){{1,6}}(?::{_HEX4}){{1,6}}|:(?::{_HEX4}){{1,7}})(?![\p{{L}}\p{{N}}:])",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
    "ssn": r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])",
    "phone": r"(?<![\d+])\+\d{1,3}[ .-]?(?:\(\d{1,4}\)|\d{1,4})(?:[ .-]?\d{2,4}){2,4}(?!\d)"
             r"|(?<!\d)(?:\(\d{3}\) ?|\d{3}[ .-])\d{3}[ .-]\d{4}(?!\d)"
             # a leading 0 and 9 to 12 digits that do not begin with a date; ten digits
             r"|(?<![\p{L}\p{N}_+])(?<!\d[.,/ -])(?:(?!\d\d[./-]\d\d[./-]\d{2,4}(?![./-]?\d))"
             r"0\d(?:[ ./-]?\d){7,10}|[2-9]\d{9})(?![\p{L}\p{N}_]|[.,/ -]\d)",
    "secret": r"(?<![A-Za-z0-9_])(?:[0-9a-f]{32,128}|[0-9A-F]{32,128}"
              r"|(?:sk|pk|rk|ghp|gho|xoxb|xoxp|AKIA)[-_A-Za-z0-9]{16,})(?![A-Za-z0-9_])",
    "card": r"(?<![\d-])\d(?:[ -]?\d){12,18}(?![\d-]*\d)",
    "name": rf"(?<![\p{{L}}\p{{N}}])(?:{_TITLE})\.? \p{{Lu}}[\p{{L}}'-]+(?: \p{{Lu}}[\p{{L}}'-]+)?",
}
TYPES = list(PATTERNS)
#: one pattern for all; a look at the next character spares most places the rest
_STARTS = {"[\\d+(]": ("ip", "ssn", "phone", "card"), "[0-9a-fA-F:]": ("ipv6",), "[A-Z]{2}\\d": ("iban",),
           "[0-9a-fA-Fsprgx]": ("secret",), f"[{''.join(sorted({t[0] for t in _TITLE.split('|')}))}]": ("name",)}
#: country codes of one and two digits, all others have three
_COUNTRY = r"^(\+(?:[17]|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]|\d{3}))"
ANY = "|".join([PATTERNS["email"]] + [
    f"(?={start})(?:{'|'.join(PATTERNS[t] for t in types)})" for start, types in _STARTS.items()])


def kind_of(entity: Column) -> Column:
    kind = F.lit(TYPES[-1])
    for name in reversed(TYPES[:-1]):
        kind = F.when(entity.rlike(rf"^(?:{PATTERNS[name]})$"), name).otherwise(kind)
    return kind


def canonical(kind: Column, entity: Column) -> Column:
    """Lower-case letters and digits; an address keeps its dots, a name its words
    and its title's gender, but not the title."""
    plain = F.regexp_replace(F.lower(entity), r"[^\p{L}\p{N}]", "")
    name = F.regexp_replace(entity, rf"^(?:{_TITLE})\.? ", "")
    return F.when(kind == "name", F.concat(gender(entity), F.lit(" "), F.lower(name))).when(
        kind.isin("ip", "ipv6", "email"), F.lower(entity)).otherwise(plain)


def gender(entity: Column) -> Column:
    """m or f by the title; a title of either gives one by the name itself."""
    title = F.regexp_extract(entity, rf"^({_TITLE})\.? ", 1)
    def among(listed: str) -> Column:
        return F.upper(title).isin(listed.upper().split())
    return F.when(among(MALE_TITLES), "m").when(among(FEMALE_TITLES), "f").otherwise("o")


def _draw(digest: Column, place: Column) -> Column:
    """A number from 0 to 4095 for a place of an entity."""
    at = F.pmod(place * 3, F.lit(120)).cast("int") + 1
    return F.conv(F.substring(digest, at, F.lit(3)), 16, 10).cast("int")


def _pick(alphabet: str, number: Column) -> Column:
    return F.substring(F.lit(alphabet), F.pmod(number, F.lit(len(alphabet))) + 1, F.lit(1))


def _character(c: Column, number: Column, hexadecimal: Column) -> Column:
    """A character of the class of c."""
    return (F.when(hexadecimal & c.rlike("[0-9a-f]"), _pick(HEX, number))
            .when(hexadecimal & c.rlike("[A-F]"), F.upper(_pick(HEX, number)))
            .when(c.rlike(r"\p{Nd}"), _pick(DIGITS, number))
            .when(c.rlike(r"\p{IsCyrillic}"), F.when(
                c.rlike(r"\p{Lu}"), _pick(CYRILLIC_UPPER, number)).otherwise(
                    _pick(CYRILLIC_LOWER, number)))
            .when(c.rlike(r"\p{IsGreek}"), F.when(
                c.rlike(r"\p{Lu}"), _pick(GREEK_UPPER, number)).otherwise(
                    _pick(GREEK_LOWER, number)))
            .when(c.rlike(r"\p{IsHan}"), _pick(HAN, number))
            .when(c.rlike(r"\p{Lu}"), _pick(UPPER, number))
            .when(c.rlike(r"\p{L}"), _pick(LOWER, number))
            .otherwise(c))


def _checked(digits: Column) -> Column:
    """Whether a string of digits has a valid check digit (mod 10, doubled)."""
    n = F.length(digits)
    return F.aggregate(
        F.sequence(F.lit(1), n), F.lit(0),
        lambda total, i: total + _doubled(
            F.substring(digits, i, F.lit(1)).cast("int"), F.pmod(n - i, F.lit(2)) == 1)) % 10 == 0


def _doubled(digit: Column, twice: Column) -> Column:
    return F.when(twice, F.when(digit > 4, digit * 2 - 9).otherwise(digit * 2)).otherwise(digit)


def _check_digit(body: Column) -> Column:
    n = F.length(body)
    total = F.aggregate(
        F.sequence(F.lit(1), n), F.lit(0),
        lambda t, i: t + _doubled(
            F.substring(body, i, F.lit(1)).cast("int"), F.pmod(n - i, F.lit(2)) == 0))
    return F.pmod(10 - total % 10, F.lit(10)).cast("string")


def surrogate(kind: Column, entity: Column, canon: Column, attempt: Column,
              key: str) -> Column:
    """The replacement of an entity as it is written, for a drawing."""
    digest = F.sha2(F.concat_ws("\x1f", F.lit(key), kind, canon, attempt.cast("string")), 512)
    return F.get(F.transform(F.array(digest), lambda d: _replaced(
        kind, entity, canon, attempt, d)), F.lit(0))


def _replaced(kind: Column, entity: Column, canon: Column, attempt: Column,
              digest: Column) -> Column:
    def begins(pattern: str) -> Column:
        return F.length(F.regexp_extract(entity, pattern, 1))
    fixed = F.when(kind == "iban", 2).when(kind == "card", 1).when(
        kind == "phone", F.greatest(begins(_COUNTRY), begins(r"^(0)"))).when(
        kind == "secret", begins(r"^((?:sk|pk|rk|ghp|gho|xoxb|xoxp|AKIA)[-_]?)")).otherwise(0)
    hexadecimal = (kind == "ipv6") | (kind == "secret") & entity.rlike(r"^(?:[0-9a-f]+|[0-9A-F]+)$")
    # drawn by the place among letters and digits, so every spelling gets the same
    drawn = F.array_join(F.transform(
        F.sequence(F.lit(1), F.length(entity)),
        lambda i: F.when(i <= fixed, F.substring(entity, i, F.lit(1))).otherwise(_character(
            F.substring(entity, i, F.lit(1)), _draw(digest, F.length(F.regexp_replace(
                F.substring(entity, F.lit(1), i), r"[^\p{L}\p{N}]", ""))), hexadecimal))), "")
    last_label = F.regexp_extract(entity, r"(\.\p{L}{2,})$", 1)
    octets = F.array_join(F.transform(
        F.sequence(F.lit(0), F.lit(3)),
        lambda i: F.pmod(_draw(digest, i), F.lit(256)).cast("string")), ".")
    valid = (kind == "card") & _checked(F.regexp_replace(entity, r"\D", ""))

    def finished(d: Column) -> Column:
        front = F.regexp_replace(d, r"\d$", "")
        return F.when(kind == "email", F.concat(F.substring(
            d, F.lit(1), F.length(entity) - F.length(last_label)), last_label)).when(
            valid, F.concat(front, _check_digit(F.regexp_replace(front, r"\D", "")))).otherwise(d)

    return F.when(kind == "ip", octets).when(
        kind == "name", _name(entity, canon, digest, attempt)).otherwise(
        F.get(F.transform(F.array(drawn), finished), F.lit(0)))


def _name(entity: Column, canon: Column, digest: Column, attempt: Column) -> Column:
    """Title, a first name of the gender if there was one, and a drawn last name."""
    cyrillic, greek = canon.rlike(r"\p{IsCyrillic}"), canon.rlike(r"\p{IsGreek}")
    which = F.substring(canon, 1, 1)
    female = (which == "f") | ((which == "o") & (F.pmod(_draw(digest, F.lit(30)), F.lit(2)) == 0))

    def of(listed: str) -> Column:
        names = F.array(*[F.lit(n) for n in listed.split()])
        return F.get(names, F.pmod(_draw(digest, F.lit(0)), F.size(names)))

    first = F.when(cyrillic, F.when(female, of(FEMALE_CYRILLIC)).otherwise(of(MALE_CYRILLIC))
                   ).when(greek, F.when(female, of(FEMALE_GREEK)).otherwise(of(MALE_GREEK))
                          ).otherwise(F.when(female, of(FEMALE_NAMES)).otherwise(of(MALE_NAMES)))
    # two letters more for every further drawing, so that names never run out
    size = F.lit(6) + attempt * 2
    last = F.array_join(F.transform(F.sequence(F.lit(1), size), lambda i: F.when(
        cyrillic, _pick(CYRILLIC_LOWER, _draw(digest, i))).when(
            greek, _pick(GREEK_LOWER, _draw(digest, i))).otherwise(
            F.when(i % 2 == 0, _pick("aeiou", _draw(digest, i))).otherwise(
                _pick("bdfgklmnprstv", _draw(digest, i))))), "")
    title = F.regexp_extract(entity, rf"^((?:{_TITLE})\.? )", 1)
    rest = F.regexp_replace(entity, rf"^(?:{_TITLE})\.? ", "")
    whole = F.when(rest.contains(" "), F.concat(first, F.lit(" "), F.initcap(last))).otherwise(
        F.initcap(last))
    return F.concat(title, F.when(
        (F.length(rest) > 1) & (F.upper(rest) == rest), F.upper(whole)).otherwise(whole))


def detected(text: Column) -> Column:
    """All entities of a text, in order; a text without a digit, @, title or as
    long a run of letters as the shortest secret has none."""
    possible = text.rlike("[0-9@]|[-_A-Za-z]{18}")
    for title in dict.fromkeys(t[:2] for t in _TITLE.split("|")):
        possible = possible | text.contains(title)
    return F.when(possible, F.regexp_extract_all(text, F.lit(ANY), F.lit(0))).when(
        text.isNotNull(), F.array().cast("array<string>"))


def distinct_entities(docs: DataFrame, text: str) -> DataFrame:
    """(kind, canon, entity): each entity once, with its least spelling."""
    found = docs.select(F.explode(detected(F.col(f"`{text}`"))).alias("entity"))
    kinds = found.groupBy("entity").agg(F.lit(1)).select("entity", kind_of(F.col("entity")).alias("kind"))
    return kinds.select("kind", canonical(F.col("kind"), F.col("entity")).alias("canon"),
                        "entity").groupBy("kind", "canon").agg(F.min("entity").alias("entity"))


def redrawn(entities: DataFrame, key: str) -> DataFrame:
    """(kind, canon, attempt) of the entities whose first surrogate is taken.

    Of entities that share a surrogate the least keeps it.  Each round draws the
    losers again and checks them against all surrogates that hold.
    """
    def drawn(rows: DataFrame) -> DataFrame:
        made = surrogate(F.col("kind"), F.col("entity"), F.col("canon"), F.col("attempt"), key)
        return rows.withColumn("taken", canonical(F.col("kind"), made))

    real = entities.select("kind", F.col("canon").alias("taken"))
    rows = stored(drawn(entities.withColumn("attempt", F.lit(0))))
    held, fixed = None, None
    while True:
        others = real if held is None else real.unionByName(held.select("kind", "taken"))
        clash = rows.join(others.distinct(), ["kind", "taken"], "left_semi").select(
            "kind", "canon")
        twice = rows.groupBy("kind", "taken").agg(
            F.count("*").alias("n"), F.min("canon").alias("least")).where("n > 1")
        later = rows.join(twice, ["kind", "taken"]).where("canon <> least").select("kind", "canon")
        losers = stored(clash.union(later).distinct())
        if not losers.head(1):
            break
        kept = rows.join(losers, ["kind", "canon"], "left_anti")
        held = kept if held is None else held.unionByName(kept)
        rows = stored(drawn(rows.join(losers, ["kind", "canon"], "left_semi").select(
            "kind", "canon", "entity", (F.col("attempt") + 1).alias("attempt"))))
        fixed = rows.select("kind", "canon", "attempt") if fixed is None else (
            fixed.join(losers, ["kind", "canon"], "left_anti").unionByName(
                rows.select("kind", "canon", "attempt")))
        held, fixed = stored(held), stored(fixed)
    empty = entities.select("kind", "canon", F.lit(0).alias("attempt")).where(F.lit(False))
    return empty if fixed is None else fixed


def replace(docs: DataFrame, key: str, text: str = "text", entities: str = "entities") -> DataFrame:
    """Texts with every entity replaced, and the list of what was replaced.

    `text` is rewritten in place; `entities` is added (and replaces a column of
    that name): an array of (kind, surrogate) in the order of the text.  A null
    text stays null with a null list, a text without entities stays as it is.
    All other columns and all rows are kept.
    """
    body = F.col(f"`{text}`")
    again = redrawn(stored(distinct_entities(docs, text)), key)
    kept = without(docs, [entities])
    rows = docs.select(*[F.col(f"`{c}`") for c in kept], detected(body).alias("__found"))
    named = F.transform("__found", lambda e: F.struct(e.alias("e"), kind_of(e).alias("k")))
    rows = rows.withColumn("__found", F.when(F.size("__found") > 0, F.transform(
        named, lambda x: F.struct(x["e"].alias("e"), x["k"].alias("k"),
                                  canonical(x["k"], x["e"]).alias("c")))))
    identity = lambda k, c: F.concat_ws("\x1f", k, c)
    again = stored(again)
    if again.head(1):  # texts of redrawn entities learn their drawings
        rows = rows.withColumn("__text_id", F.md5(body))
        marks = rows.select("__text_id", F.explode("__found").alias("x")).select(
            "__text_id", F.col("x.k").alias("kind"), F.col("x.c").alias("canon")).distinct().join(
            few(again), ["kind", "canon"])
        drawings = marks.groupBy("__text_id").agg(F.map_from_entries(F.collect_set(F.struct(
            identity(F.col("kind"), F.col("canon")), "attempt"))).alias("__drawings"))
        rows = rows.join(few(stored(drawings)), "__text_id", "left").drop("__text_id")
    else:
        rows = rows.withColumn("__drawings", F.lit(None).cast("map<string,int>"))
    made = F.transform("__found", lambda x: F.struct(x["k"].alias("kind"), surrogate(
        x["k"], x["e"], x["c"], F.coalesce(F.element_at(
            "__drawings", identity(x["k"], x["c"])), F.lit(0)), key).alias("surrogate")))
    rows = rows.withColumn("__made", made)
    pieces = F.split(body, ANY, -1)
    rebuilt = F.array_join(F.zip_with(
        pieces, F.transform("__made", lambda m: m["surrogate"]),
        lambda p, s: F.concat(p, F.coalesce(s, F.lit("")))), "")
    return rows.select(
        *[F.when(F.col("__made").isNotNull(), rebuilt).otherwise(body).alias(c)
          if c == text else F.col(f"`{c}`") for c in kept],
        F.when(body.isNotNull(), F.coalesce("__made", F.array().cast(
            "array<struct<kind:string,surrogate:string>>"))).alias(entities))


ship(__name__)
