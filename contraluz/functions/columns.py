"""Column builders: parsing, canonicalisation and predicates.

Every function takes and returns `Column` (or takes a column name), so the
expressions stay inside whole-stage code generation and no Python runs per row.
"""

from __future__ import annotations

import datetime as dt
import unicodedata
from collections.abc import Iterable
from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from contraluz.functions import fixed_values as V

MONEY = T.DecimalType(18, 2)
_NUMBER = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"


def as_col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


# ------------------------------------------------------------------ numbers

def number(text: Column | str, strip: str = ",") -> Column:
    """Text to double after removing the characters in `strip`; junk is NULL."""
    bare = as_col(text)
    for mark in strip:
        bare = F.replace(bare, F.lit(mark), F.lit(""))
    return F.regexp_extract(F.trim(bare), _NUMBER, 0).try_cast("double")


def whole(text: Column | str) -> Column:
    """Text to integer; junk and out-of-range values are NULL."""
    return F.round(number(text, "")).try_cast("int")


def money(amount: Column | str) -> Column:
    """Exact cents, so that sums do not depend on the order of the rows."""
    return as_col(amount).try_cast(MONEY)


def money_sum(amount: Column | str, condition: Column | None = None) -> Column:
    value = money(amount)
    return F.sum(value if condition is None else F.when(condition, value))


def millions(total: Column, digits: int) -> Column:
    """An exact money total in millions, rounded in decimal arithmetic."""
    scaled = total.cast("decimal(24,2)") * F.lit(Decimal("0.000001"))
    return F.round(scaled, digits).cast("double")


def round_sql(value: Column, digits: int) -> Column:
    """Half-away-from-zero rounding of a double on its scaled value."""
    scale = float(10 ** digits)
    return F.round(value * scale, 0) / scale


def amount_millions(amount: Column | str, digits: int) -> Column:
    return round_sql(as_col(amount) / 1e6, digits)


def share_pct(part: Column, base: Column, digits: int) -> Column:
    """100 * part / base with NULL for an empty base."""
    return round_sql(
        F.try_divide(F.lit(100.0) * part.cast("double"), base.cast("double")),
        digits)


# -------------------------------------------------------------------- dates

_SLASHED = r"^(\d{1,2})/(\d{1,2})/(\d{4})$"
_SLASHED_TIME = r"^(\d{1,2})/(\d{1,2})/(\d{4})(?: \d{1,2}:\d{1,2}.*)?$"
_ISO = r"^\d{4}-\d{1,2}-\d{1,2}$"
_ISO_TIME = r"^(\d{4}-\d{1,2}-\d{1,2})(?:[T ]\d.*|Z)?$"


def parse_day(text: Column | str, iso: bool = True) -> Column:
    """dd/mm/yyyy, or ISO unless switched off; one-digit parts are accepted.

    The text is brought to ISO form and cast: a misfit yields NULL without
    the exception that a formatter would raise for every such row.
    """
    bare = F.trim(as_col(text))
    if not iso:
        bare = F.regexp_extract(bare, _SLASHED, 0)
    turned = F.regexp_replace(bare, _SLASHED, "$3-$2-$1")
    return F.regexp_extract(turned, _ISO, 0).try_cast("date")


def parse_moment(text: Column | str) -> Column:
    """Date of ISO text (time and Z allowed) or dd/mm/yyyy[ HH:MM]; else NULL."""
    turned = F.regexp_replace(F.trim(as_col(text)), _SLASHED_TIME, "$3-$2-$1")
    return F.regexp_extract(turned, _ISO_TIME, 1).try_cast("date")


def iso_text(day: Column | str) -> Column:
    return F.date_format(as_col(day), "yyyy-MM-dd")


def day_literal(day: dt.date | Column | None) -> Column:
    """An injected clock; the current date where none is given."""
    if day is None:
        return F.current_date()
    return day if isinstance(day, Column) else F.lit(day)


def clock_year(today: dt.date | None) -> int:
    return (today or dt.date.today()).year


# ------------------------------------------------------------- company names

def _accent_table() -> tuple[str, str]:
    """Accented letters with an ASCII base, then the marks to be dropped."""
    letters, bases = [], []
    for point in (*range(0x00C0, 0x0250), *range(0x1E00, 0x1F00)):
        letter = chr(point)
        parts = unicodedata.normalize("NFD", letter)
        if len(parts) > 1 and parts[0].isascii():
            letters.append(letter)
            bases.append(parts[0])
    marks = [chr(point) for point in range(0x0300, 0x0370)]
    return "".join(letters + marks), "".join(bases)


_ACCENTED, _PLAIN = _accent_table()
_SUFFIX_TAIL = "( (?:{}))+$".format(
    "|".join(sorted(V.LEGAL_SUFFIXES, key=len, reverse=True)))


def name_norm(name: Column | str) -> Column:
    """Matching key of a company name.

    Accents removed, upper case, anything but letters and digits to one blank,
    legal-form suffixes cut from the end.
    """
    raw = as_col(name)
    plain = F.when(F.length(raw) == F.octet_length(raw), raw).otherwise(
        F.translate(raw, _ACCENTED, _PLAIN))
    words = F.trim(F.upper(F.regexp_replace(plain, "[^A-Za-z0-9]+", " ")))
    return F.regexp_replace(words, _SUFFIX_TAIL, "")


def long_enough_key(key: Column | str) -> Column:
    return F.length(as_col(key)) >= V.MIN_NAME_KEY


# ------------------------------------------------------------- taxpayer keys

def rfc_norm(rfc: Column | str) -> Column:
    return F.upper(F.trim(as_col(rfc)))


def rfc_compact(rfc: Column | str) -> Column:
    """State files: blanks and hyphens go too, and nothing left is NULL."""
    bare = F.upper(F.translate(F.trim(as_col(rfc)), " -", ""))
    return F.nullif(bare, F.lit(""))


def rfc_valid(rfc: Column | str) -> Column:
    return F.coalesce(as_col(rfc), F.lit("")).rlike(f"^(?:{V.RFC_PATTERN})$")


def rfc_class(raw: Column | str) -> Column:
    """valido / vacio / basura for a raw captured key."""
    bare = F.upper(F.translate(F.coalesce(F.trim(as_col(raw)), F.lit("")),
                               " ", ""))
    return (F.when(bare == "", "vacio").when(rfc_valid(bare), "valido")
            .otherwise("basura"))


def rfc_generic(raw: Column | str) -> Column:
    bare = F.upper(F.translate(F.coalesce(F.trim(as_col(raw)), F.lit("")),
                               " ", ""))
    return bare.isin(*V.GENERIC_RFCS)


def legal_person(rfc: Column | str) -> Column:
    return F.length(F.trim(as_col(rfc))) == 12


def incorporation_day(rfc: Column | str, today: dt.date | None = None) -> Column:
    """Incorporation date in characters 4-9 of a legal person's key.

    A two-digit year up to the clock's own belongs to this century.  The key is
    rewritten step by step, so the expression refers to it only once and stays
    small where the optimizer copies it into a filter.
    """
    tens, ones = divmod(clock_year(today) % 100, 10)
    recent = f"{tens}[0-{ones}]" + (f"|[0-{tens - 1}][0-9]" if tens else "")
    key = F.trim(as_col(rfc))
    dated = F.regexp_replace(
        key, rf"^.{{3}}({recent})(\d\d)(\d\d).{{3}}$", "20$1-$2-$3")
    dated = F.regexp_replace(
        dated, r"^.{3}(\d\d)(\d\d)(\d\d).{3}$", "19$1-$2-$3")
    return F.regexp_extract(dated, r"^\d{4}-\d\d-\d\d$", 0).try_cast("date")


def age_days(born: Column | str, day: Column | str) -> Column:
    return F.date_diff(as_col(day), as_col(born))


# ------------------------------------------------------- procedure and buyer

def direct_award(kind: Column | str) -> Column:
    return as_col(kind).ilike("ADJUDICACI%DIRECTA%")


def invitation(kind: Column | str) -> Column:
    return as_col(kind).ilike("INVITACI%")


def tender(kind: Column | str) -> Column:
    return as_col(kind).ilike("LICITACI%")


def procedure_class(kind: Column | str, names: tuple[str, str, str, str] = (
        "directa", "invitacion", "licitacion", "otro")) -> Column:
    return (F.when(direct_award(kind), names[0])
            .when(invitation(kind), names[1])
            .when(tender(kind), names[2]).otherwise(names[3]))


def supplier_context(name: Column | str) -> Column:
    upper = F.upper(as_col(name))
    return (F.when(upper.rlike("|".join(V.PATENT_PHARMA)), "farmaceutica_patente")
            .when(upper.rlike("|".join(V.STATE_ENTITIES)), "entidad_estatal")
            .otherwise(""))


def _branch_map() -> Column:
    pairs = [F.lit(x) for item in V.BRANCH_STATES.items() for x in item]
    return F.create_map(*pairs)


def branch_state(branch: Column | str) -> Column:
    """State of a budget branch 60-91; federal branches give NULL."""
    return F.try_element_at(_branch_map(), whole(branch))


def number_state(number_text: Column | str) -> Column:
    """State from the second segment of a procedure number."""
    branch = F.regexp_extract(
        F.coalesce(as_col(number_text), F.lit("")), r"^[A-Z]{2}-(\d{1,3})-", 1)
    return branch_state(branch)


def legal_cap(law: Column | str, acquisitions: float = V.CAP_ACQUISITIONS,
              works: float = V.CAP_WORKS) -> Column:
    text = F.upper(F.coalesce(as_col(law), F.lit("")))
    return F.when(text.contains("OBRAS"), works).otherwise(acquisitions)


def scope_of_order(order: Column | str) -> Column:
    """Federal or state scope from the government-order text."""
    key = F.coalesce(name_norm(order), F.lit(""))
    state = (key.contains("ESTATAL") | key.contains("ENTIDAD FEDERATIVA")
             | key.contains("MUNICIPAL") | key.contains("GOBIERNO DEL ESTADO"))
    return F.when(state, "estatal").otherwise("federal")


# ---------------------------------------------------------------- predicates

def mxn_ok(currency: Column | str = "moneda_efectiva") -> Column:
    """Amounts in pesos; an empty currency means pesos.  Never NULL."""
    return as_col(currency).eqNullSafe("MXN") | as_col(currency).isNull()


def state_mxn_ok(currency: Column | str = "moneda") -> Column:
    upper = F.upper(as_col(currency))
    return F.coalesce(
        upper.isNull() | upper.contains("PESO") | (upper == "MXN"), F.lit(False))


def plausible_amount(amount: Column | str = "importe",
                     currency: Column | str = "moneda") -> Column:
    value = as_col(amount)
    return (F.coalesce(value.between(V.MIN_PLAUSIBLE_AMOUNT,
                                     V.MAX_PLAUSIBLE_AMOUNT), F.lit(False))
            & state_mxn_ok(currency))


def plausible_supplier(name: Column | str = "proveedor") -> Column:
    text = as_col(name)
    bare = F.trim(text)
    test = (F.length(bare) >= 5) & ~F.upper(bare).isin(*V.IMPLAUSIBLE_SUPPLIERS)
    for pattern in V.IMPLAUSIBLE_SUPPLIER_LIKE:
        test = test & ~text.ilike(pattern)
    return F.coalesce(test, F.lit(False))


def placeholder_supplier(name: Column | str) -> Column:
    """A supplier field that names nobody: too short, a stock phrase, a key."""
    raw = F.coalesce(as_col(name), F.lit(""))
    key = name_norm(raw)
    return ((F.length(key) < 4) | key.startswith("LAS PERSONAS")
            | key.startswith("NO SE") | F.trim(raw).startswith("[[")
            | key.isin(*V.PLACEHOLDER_SUPPLIERS)
            | rfc_valid(F.upper(F.trim(raw))))


def inside_window(day: Column | str, start: Column | str,
                  end: Column | str) -> Column:
    """Closed interval that needs both ends; never NULL."""
    d = as_col(day)
    return F.coalesce((d >= as_col(start)) & (d <= as_col(end)), F.lit(False))


def after(day: Column | str, limit: Column | str) -> Column:
    return F.coalesce(as_col(day) > as_col(limit), F.lit(False))


# ------------------------------------------------------------- identity, text

def procedure_id(link: Column | str) -> Column:
    found = F.regexp_extract(F.coalesce(as_col(link), F.lit("")),
                             V.PROCEDURE_ID, 1)
    return F.nullif(found, F.lit(""))


def procedure_url(uuid: Column | str) -> Column:
    head, tail = V.PROCEDURE_URL.split("{}")
    return F.concat(F.lit(head), as_col(uuid), F.lit(tail))


def portal_url(link: Column | str) -> Column:
    """The link rebuilt on the live portal; blank where it carries no id."""
    return F.coalesce(procedure_url(procedure_id(link)), F.lit(""))


def stable_case_id(*parts: Column) -> Column:
    """32 hex characters over the normalised parts of a case key."""
    keys = [F.coalesce(name_norm(p), F.lit("")) for p in parts]
    return F.substring(F.sha1(F.concat_ws("|", *keys)), 1, 32)


def packed(text: Column | str) -> Column:
    """Lower-case hexadecimal text as its bytes, other text as it is; `unpacked` undoes it.

    Half as long where many ids and digests move.
    """
    value = as_col(text)
    raw = F.unhex(value)
    whole_ = F.coalesce(F.lower(F.hex(raw)) == value, F.lit(False))
    return F.struct(F.when(whole_, raw).alias("raw"), F.when(~whole_, value).alias("text"))


def unpacked(value: Column | str) -> Column:
    cell = as_col(value)
    return F.coalesce(F.lower(F.hex(cell["raw"])), cell["text"])


def person_name(company: Column | str, parts: Iterable[Column | str]) -> Column:
    """Company name where given, else the person's names joined by blanks."""
    joined = F.concat_ws(" ", *[as_col(p) for p in parts])
    return F.coalesce(F.nullif(F.trim(as_col(company)), F.lit("")),
                      F.nullif(F.trim(joined), F.lit("")))


def first_filled(*texts: Column | str) -> Column:
    return F.coalesce(*[F.nullif(F.trim(as_col(t)), F.lit("")) for t in texts])


def complaint_folio(note: Column | str) -> Column:
    """'SIDEC folio 12/2026 …' to '12-2026'; NULL where there is none."""
    text = F.coalesce(as_col(note), F.lit(""))
    pattern = r"SIDEC folio (\d+)/(\d{4})"
    return F.when(text.rlike(pattern), F.concat_ws(
        "-", F.regexp_extract(text, pattern, 1),
        F.regexp_extract(text, pattern, 2)))


def bracketed_rfc(name: Column | str) -> Column:
    found = F.regexp_extract(F.coalesce(as_col(name), F.lit("")),
                             rf"\(({V.RFC_PATTERN})\)", 1)
    return F.nullif(found, F.lit(""))


def first_digit(amount: Column | str) -> Column:
    value = as_col(amount)
    scale = F.floor(F.log10(value))
    return F.when(value > 0, F.floor(value / F.pow(F.lit(10.0), scale))
                  .cast("int"))


def second_digit(amount: Column | str) -> Column:
    value = as_col(amount)
    scale = F.floor(F.log10(value)) - 1
    return F.when(value > 0, F.pmod(
        F.floor(value / F.pow(F.lit(10.0), scale)), F.lit(10)).cast("int"))
