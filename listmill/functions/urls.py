"""Hosts, links and query strings."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from listmill import fixed_values as fv
from listmill.functions.regex import blank_to_null


def host(url: Column) -> Column:
    return F.lower(F.try_parse_url(url, F.lit("HOST")))


def organizer_flag(homepage: Column) -> Column:
    """The reason an organizer is flagged, by its host or a parent of it; null when it is not."""
    h = F.regexp_replace(host(homepage), r"^www\.", "")
    out = F.lit(None).cast("string")
    for known, why in fv.FLAGGED_HOSTS.items():
        out = F.when((h == known) | h.endswith("." + known), F.lit(why)).otherwise(out)
    return out


def host_suffixes(h: Column) -> Column:
    """"a.b.c" -> [a.b.c, b.c, c]: what an equi join needs to match a host or any parent."""
    labels = F.split(h, r"\.")
    n = F.size(labels)
    return F.transform(
        F.sequence(F.lit(1), n), lambda i: F.array_join(F.slice(labels, i, n - i + 1), ".")
    )


def site(h: Column) -> Column:
    """The last two labels of a host, or the only one."""
    labels = F.split(h, r"\.")
    return F.array_join(F.slice(labels, F.greatest(F.size(labels) - 1, F.lit(1)), F.lit(2)), ".")


def same_site(a: Column, b: Column) -> Column:
    two = lambda u: F.regexp_extract(host(u), r"([^.]+\.[^.]+|[^.]+)$", 1)
    return two(a) == two(b)


def repaired_url(raw: Column) -> Column:
    """"iccmn.in/" -> "https://iccmn.in/"; a text that cannot be an address gives null."""
    t = F.trim(raw)
    return F.when(
        (t != "") & ~t.contains(" ") & t.contains("."),
        F.when(t.rlike("(?i)^https?://"), t).otherwise(
            F.concat(F.lit("https://"), F.regexp_replace(t, "^/+", ""))
        ),
    )


def is_web_address(url: Column) -> Column:
    return url.rlike(f"(?iU){fv.WEB_ADDRESS}")


def without_params(url: Column, drop) -> Column:
    """The URL without the query parameters for which ``drop(name)`` holds."""
    base = F.regexp_extract(url, r"^([^?#]*)", 1)
    query = F.regexp_extract(url, r"^[^?#]*\?([^#]*)", 1)
    fragment = F.regexp_extract(url, r"(#.*)$", 1)
    kept = F.filter(
        F.split(query, "&"), lambda p: p.contains("=") & ~drop(F.split_part(p, F.lit("="), F.lit(1)))
    )
    joined = F.array_join(kept, "&")
    return F.concat(base, F.when(joined != "", F.concat(F.lit("?"), joined)).otherwise(""), fragment)


def without_tracking(url: Column) -> Column:
    return without_params(F.trim(url), lambda name: name.startswith("utm_"))


def without_person(url: Column) -> Column:
    """Account links lose the person id; every other link stays as it is."""
    return F.when(
        url.contains(fv.PERSON_LINK_HOST),
        without_params(url, lambda name: name == fv.PERSON_PARAM),
    ).otherwise(url)


def query_id(url: Column) -> Column:
    """The first of the id parameters that the query string has."""
    query = F.regexp_extract(url, r"^[^?#]*\?([^#]*)", 1)
    take = lambda k: blank_to_null(
        F.regexp_extract(query, f"(?:^|&){k}=([^&]*)", 1)
    )
    return F.coalesce(*[take(k) for k in fv.QUERY_ID_KEYS])


def absolute(href: Column, base: Column) -> Column:
    """A page link as an absolute address without fragment; null for non-page links."""
    h = F.regexp_replace(F.trim(href), "#.*$", "")
    root = F.regexp_extract(base, r"^([a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*)", 1)
    scheme = F.regexp_extract(base, r"^([a-zA-Z][a-zA-Z0-9+.-]*:)", 1)
    path = F.regexp_extract(base, r"^[a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*(/[^?#]*)?", 1)
    folder = F.when(path == "", F.lit("/")).otherwise(F.regexp_replace(path, "[^/]*$", ""))
    skip = F.trim(href).rlike("^(?:mailto:|javascript:|tel:|#)")
    return F.when(
        ~skip,
        F.when(h.rlike(r"^[a-zA-Z][a-zA-Z0-9+.-]*:"), h)
        .when(h.startswith("//"), F.concat(scheme, h))
        .when(h.startswith("/"), F.concat(root, h))
        .when(h == "", F.regexp_replace(base, "#.*$", ""))
        .when(h.startswith("?"), F.concat(root, path, h))
        .otherwise(F.concat(root, _resolved(F.concat(folder, h)))),
    )


def _resolved(path: Column) -> Column:
    """A path with its "." and ".." segments folded, however many; what follows ? or # stays as it is."""
    plain = F.regexp_extract(path, r"^[^?#]*", 0)
    parts = F.split(plain, "/")
    last = F.element_at(parts, -1)
    folded = F.aggregate(
        F.slice(parts, F.lit(2), F.size(parts)),
        F.array().cast("array<string>"),
        lambda kept, part: F.when(part == ".", kept)
        .when(part == "..", F.slice(kept, F.lit(1), F.greatest(F.size(kept) - 1, F.lit(0))))
        .otherwise(F.array_append(kept, part)),
    )
    closing = F.when(last.isin(".", "..") & (F.size(folded) > 0), "/").otherwise("")
    return F.concat(F.lit("/"), F.array_join(folded, "/"), closing, F.substring(path, F.length(plain) + 1, F.length(path)))


def link_score(text: Column, url: Column, homepage: Column) -> Column:
    """Sum of the weights of the keywords in the link's text and path; off-site pages get 0."""
    path = F.regexp_extract(url, r"^[a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*(/[^?#]*)?", 1)
    hay = F.lower(F.concat(F.coalesce(text, F.lit("")), F.lit(" "), path))
    total = F.lit(0)
    for word, weight in fv.LINK_WEIGHTS.items():
        total = total + F.when(hay.contains(word), weight).otherwise(0)
    allowed = same_site(url, homepage) | F.lower(url).endswith(".pdf")
    return F.when(allowed, total).otherwise(0)
