"""Currencies, amounts in text, conversion."""

from __future__ import annotations

import re
from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

from listmill import fixed_values as fv
from listmill.functions.regex import bind, blank_to_null

_SPELLINGS = sorted(
    {*fv.CURRENCY_SPELLINGS, *fv.KNOWN_ISO}, key=lambda s: (-len(s), s)
)


def literal_map(pairs: dict) -> Column:
    return F.create_map(*[F.lit(x) for x in chain.from_iterable(pairs.items())])


def normalize_currency(raw: Column) -> Column:
    """ISO code, symbol or spelling -> ISO code; unknown gives null."""
    key = F.upper(F.trim(raw))
    known = {**{c: c for c in fv.KNOWN_ISO}, **fv.CURRENCY_SPELLINGS}
    return F.try_element_at(literal_map(known), key)


def currency_in(text: Column) -> Column:
    """The first currency mark in a text that is recognised."""
    hints = F.regexp_extract_all(text, F.lit("(?U)" + fv.CURRENCY_HINT), F.lit(1))
    codes = F.filter(F.transform(hints, normalize_currency), lambda c: c.isNotNull())
    return F.get(codes, F.lit(0))


def _amount(text: Column) -> Column:
    """The first number. Its last separator is decimal when one or two digits follow it."""
    return bind(F.regexp_extract(text, r"\d+(?:[.,'\u00a0\u202f\u0020]\d+)*", 0), _number)


def _number(number: Column) -> Column:
    has_cents = number.rlike(r"[.,]\d{1,2}$") & ~number.rlike(r"^\d{1,3}(?:[.,]\d{3})*[.,]\d{3}$")
    cents = F.regexp_extract(number, r"[.,](\d{1,2})$", 1)
    whole = F.regexp_replace(
        F.when(has_cents, F.regexp_replace(number, r"[.,]\d{1,2}$", "")).otherwise(number),
        r"[^\d]",
        "",
    )
    marked = F.when(has_cents, F.concat(whole, F.lit("."), cents)).otherwise(whole)
    return F.when(number.rlike(r"\D"), marked).otherwise(number).try_cast("double")


def parse_money(text: Column) -> Column:
    """struct<amount, currency> of a price text."""
    marks = "|".join(re.escape(s) for s in _SPELLINGS if not s.isalpha())
    mark = blank_to_null(F.regexp_extract(text, f"({marks})", 1))
    word = F.regexp_extract(text, r"(?iU)\b(RP|RM|EUROS|EURO|RMB|TL|KM|DA)\b", 1)
    codes = F.filter(
        F.regexp_extract_all(F.upper(text), F.lit(r"(?U)\b([A-Z]{3})\b"), F.lit(1)),
        lambda c: c.isin(fv.KNOWN_ISO),
    )
    currency = F.coalesce(
        normalize_currency(mark), F.get(codes, F.lit(0)), normalize_currency(word)
    )
    digits = F.regexp_replace(text, r"(?U)[^\d]", "").try_cast("double")

    def fixed(read: Column) -> Column:
        amount, code = read["amount"], read["currency"]
        return F.struct(F.when((code == "IDR") & (amount < 1000), digits).otherwise(amount).alias("amount"), code.alias("currency"))

    return bind(F.struct(_amount(text).alias("amount"), currency.alias("currency")), fixed)


def rate_code(currency: Column) -> Column:
    """The code a conversion looks up: the ISO code, else the text in capitals."""
    return F.coalesce(
        normalize_currency(currency), F.upper(blank_to_null(currency))
    )


def converted(amount: Column, rate: Column, target_rate: Column) -> Column:
    """Amount over its units-per-dollar rate, times the target's, to two decimals."""
    usable = rate.isNotNull() & (rate != 0)
    return F.when(usable, F.bround(amount / F.nullif(rate, F.lit(0.0)) * target_rate, 2))


def converted_by_map(amount: Column, currency: Column, rates: Column, target: str) -> Column:
    """As :func:`converted`, the rates given as a map column (one row's snapshot)."""
    return converted(
        amount,
        F.try_element_at(rates, rate_code(currency)),
        F.try_element_at(rates, F.lit(target)),
    )


def rough_usd(amount: Column, currency: Column) -> Column:
    """Built-in rough value, for the plausibility range only; null without a rough rate."""
    rates = literal_map({k: float(v) for k, v in fv.USD_PER_UNIT.items()})
    return amount * F.try_element_at(rates, F.upper(currency))


def tier_of(text: Column) -> Column:
    """The tier of the first tier word, in dictionary order, that a text contains."""
    low = F.lower(text)
    out = None
    for word, tier in fv.TIER_WORDS.items():
        out = F.when(low.contains(word), tier) if out is None else out.when(low.contains(word), tier)
    return out


def short_number(amount: Column) -> Column:
    """Integer-valued amounts without decimals, others in their shortest form."""
    whole = (amount == F.floor(amount)) & (F.abs(amount) < 1e15)
    return F.when(whole, amount.cast("bigint").cast("string")).otherwise(amount.cast("string"))


def six_digits(amount: Column) -> Column:
    """At most six significant digits, as fee labels show an amount."""
    big = F.regexp_replace(
        F.regexp_replace(F.format_string("%.5e", amount), r"0+e", "e"), r"\.e", "e"
    )
    exponent = F.floor(F.log10(F.abs(amount)))
    places = F.greatest(F.lit(0), F.lit(5) - exponent).cast("int")
    plain = short_number(F.bround(amount * F.pow(F.lit(10.0), places)) / F.pow(F.lit(10.0), places))
    return (
        F.when(amount == 0, "0")
        .when((F.abs(amount) >= 1e6) | (F.abs(amount) < 1e-4), big)
        .otherwise(plain)
    )


def headline_text(amount: Column, currency: Column, category: Column) -> Column:
    """"450 USD (Author)"."""
    return F.trim(
        F.concat(
            six_digits(amount), F.lit(" "), F.coalesce(currency, F.lit("")), F.lit(" ("), category, F.lit(")")
        )
    )
