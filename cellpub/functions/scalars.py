"""Column functions: names, codes, dates, event classes, tolerant JSON. No UDFs; null handling is stated in each."""

from __future__ import annotations

import unicodedata
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# -- codes, flags, labels ------------------------------------------------------------------------------------


def nomenclature_gate(code: Column, nomenclature: Column, supported: str) -> Column:
    """The code where its nomenclature is the supported one, else null."""
    return F.when(nomenclature == supported, code)


def vintage_label(year: Column, last_of_old: int, old: str, new: str) -> Column:
    return F.when(year <= last_of_old, F.lit(old)).otherwise(F.lit(new))


def fallback_code(division: Column, label_division: Column, section: Column) -> Column:
    """Division, else the label's division, else a member for the section alone, else ``ZZ``."""
    return F.coalesce(division, label_division, F.concat(section, F.lit("_ND")), F.lit("ZZ"))


def first_match(*candidates: tuple[str, Column]) -> tuple[Column, Column]:
    """(value, method): the first candidate that is not null and the name of its method."""
    value = F.coalesce(*[c for _, c in candidates])
    method = reduce(lambda w, m: w.when(m[1].isNotNull(), m[0]), candidates[1:], F.when(candidates[0][1].isNotNull(), candidates[0][0]))
    return value, method


def threshold_status(value: Column, threshold: Column, sense: Column) -> Column:
    """info without a threshold; ok or failed against a least ('min') or greatest ('max') value. A null value fails."""
    met = ((sense == "min") & (value >= threshold)) | ((sense == "max") & (value <= threshold))
    return F.when(threshold.isNull(), "info").when(met, "ok").otherwise("failed")


def fingerprint(*parts: Column) -> Column:
    """The first 16 hex digits of the SHA-256 of the parts, joined by bars."""
    return F.substring(F.sha2(F.concat_ws("|", *parts).cast("binary"), 256), 1, 16)


# -- names ---------------------------------------------------------------------------------------------------


def _accents() -> tuple[str, str]:
    """Latin letters (U+00C0 to U+024F) that decompose to an ASCII letter, and those letters; sharp s is a gap."""
    pairs = [(chr(p), unicodedata.normalize("NFD", chr(p))[0]) for p in range(0xC0, 0x250)]
    pairs = [(a, b) for a, b in pairs if a != b and b.isascii()] + [("ß", " ")]
    return "".join(a for a, _ in pairs), "".join(b for _, b in pairs)


def normalize_name(name: Column) -> Column:
    """Upper-case ASCII words of a place name: null gives '', accents and signs go, the word CEDEX and what follows goes, ST and STE are spelled out, one leading article goes."""
    plain = F.upper(F.translate(F.coalesce(name, F.lit("")), *_accents()))
    words = F.trim(F.regexp_replace(plain, "[^A-Z0-9]+", " "))
    words = F.trim(F.regexp_replace(words, r"\bCEDEX\b.*$", ""))
    words = F.regexp_replace(F.regexp_replace(words, r"\bSTE\b", "SAINTE"), r"\bST\b", "SAINT")
    return F.regexp_replace(words, r"^(LE|LA|LES|L) ", "")


# -- dates and months ----------------------------------------------------------------------------------------


def month_of(date: Column) -> Column:
    return F.trunc(F.to_date(date), "month")


def month_label(month: Column) -> Column:
    return F.date_format(month, "yyyy-MM")


def strict_date(text: Column) -> Column:
    """ISO dates only; anything else, and days that do not exist, give null."""
    return F.when(text.rlike(r"^\d{4}-\d{2}-\d{2}$"), F.try_to_date(text))


def economic_date(judged: Column, published: Column) -> Column:
    """The date of judgment if it lies in the year up to publication, else the date of publication."""
    return F.when(judged.between(F.add_months(published, -12), published), judged).otherwise(published)


def incoherent_date(judged: Column, published: Column) -> Column:
    return judged.isNull() | ~F.coalesce(judged.between(F.add_months(published, -12), published), F.lit(False))


def january_effect(indicator: Column, month: Column) -> Column:
    """Creations of January: many have the first of January by convention."""
    return indicator.startswith("creations_") & (F.month(month) == 1)


# -- event classes -------------------------------------------------------------------------------------------


def classify_event(rules: list[tuple[Column, str]]) -> Column:
    """The class of the first rule that holds; null if none does. A rule that is null does not hold."""
    return reduce(lambda w, r: w.when(*r), rules[1:], F.when(*rules[0]))


def classify_procedure(event: Column, nature: Column, opening: str, kinds: list[tuple[str, str]], other: str) -> Column:
    """For openings, the kind whose pattern the text of the judgment matches first. An event that is null is not ruled out and falls through to the patterns."""
    chosen = F.when(event != opening, F.lit(None).cast("string"))
    for pattern, kind in kinds:
        chosen = chosen.when(nature.ilike(pattern), kind)
    return chosen.otherwise(other)


# -- nested sources ------------------------------------------------------------------------------------------


def tolerant_json(text: Column) -> Column:
    """The text as a variant; null for null, empty and malformed text."""
    return F.try_parse_json(F.nullif(text, F.lit("")))


def first_of(variant: Column, path: str, kind: str = "string") -> Column:
    """``path`` ('a.b') below the field before it, where that field is an object or a list, of which the first element counts."""
    head, tail = path.split(".", 1)
    return F.coalesce(F.try_variant_get(variant, f"$.{head}[0].{tail}", kind), F.try_variant_get(variant, f"$.{head}.{tail}", kind))


def identifiers(raw: Column) -> Column:
    """Identifiers of nine digits, blanks and signs removed, each once in the order of appearance; empty for null."""
    digits = F.transform(F.coalesce(raw, F.array().cast("array<string>")), lambda x: F.regexp_replace(x, r"\D", ""))
    return F.array_distinct(F.filter(digits, lambda x: F.length(x) == 9))


def corrected_id(publication: Column, issue: Column, number: Column) -> Column:
    """Id of the notice that is corrected: last letter of the publication, issue and number; null if any part is missing or the number is none."""
    whole = F.try_to_number(F.trim(number), F.lit("999999999")).cast("int")
    present = (F.trim(publication) != "") & (F.trim(issue) != "") & whole.isNotNull()
    return F.when(present, F.concat(F.right(F.trim(publication), F.lit(1)), F.trim(issue), whole.cast("string")))


#: Texts that say no activity, in lower case.
VOID_ACTIVITIES = ("", "non precise", "non précisé", "neant", "néant", "sans activite", "sans activité")


def activity_text(*fields: Column, void: tuple[str, ...] = VOID_ACTIVITIES, longest: int = 300) -> Column:
    """The first field that says something (whatever its case), white space collapsed, cut at ``longest`` characters."""
    bare = lambda c: F.lower(F.regexp_replace(c, r"^\s+|\s+$", ""))
    clean = lambda c: F.trim(F.regexp_replace(c, r"\s+", " "))
    return F.substring(F.coalesce(*[F.when(~bare(c).isin(*void), clean(c)) for c in fields]), 1, longest)


def current_period(periods: Column, end: str) -> Column:
    """The element without an end date; null if there is none."""
    return F.get(F.filter(periods, lambda p: p[end].isNull()), F.lit(0))


def sorted_codes(codes: Column) -> Column:
    return F.sort_array(F.coalesce(codes, F.array().cast("array<string>")))
