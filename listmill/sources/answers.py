"""JSON answers of search services and extractors as rows.

Services change their answers' shapes without notice: a number becomes a string, a list of one its
only member, a place a plain text. Bodies are therefore parsed into variants and each field is asked
for by path and kind; what cannot be read as that kind is null. A body that is no JSON, or holds
something else where its rows should stand, is one row of a reject table with a reason and never a
failed run. Null bodies count as broken; a JSON null or a missing field is simply null.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from listmill import fixed_values as fv
from listmill.functions.regex import blank_to_null, present, squash
from listmill.functions.urls import repaired_url

#: Reasons of rejects: no JSON; something else where the rows should stand; a row that is none.
BROKEN, SHAPE, RESULT = "broken", "shape", "result"

_TEXTS = [
    "name", "acronym", "start_date", "end_date", "city", "country", "description", "abstract_deadline",
    "paper_deadline", "notification_date", "camera_ready_deadline", "registration_deadline", "registration_url",
]
#: The fields of an extraction answer, in order, and those of its fees.
EXTRACTED = [*((t, "string") for t in _TEXTS), ("fees_published", "boolean"), ("fees", None), ("notes", "string")]
EXTRACTED_FEE = [("category", "string"), ("tier", "string"), ("amount", "double"), ("currency", "string"), ("notes", "string")]


def _at(value: Column, path: str, kind: str = "string") -> Column:
    return F.try_variant_get(value, path, kind)


def _held(value: Column, path: str) -> Column:
    """Whether there is something at ``path`` that is not null."""
    found = _at(value, path, "variant")
    return found.isNotNull() & ~F.is_variant_null(found)


def _is_object(value: Column, path: str = "$") -> Column:
    return _at(value, path, "map<string,variant>").isNotNull()


def _members(value: Column, path: str) -> Column:
    """The members of a list, or a single object as a list of one; null for anything else."""
    alone = F.when(_is_object(value, path), F.array(_at(value, path, "variant")))
    return F.coalesce(_at(value, path, "array<variant>"), alone)


def _list(text: Column, mark: str) -> Column:
    return F.filter(F.transform(F.split(text, mark), lambda t: F.trim(t)), lambda t: t != "")


def _texts(value: Column, path: str, mark: str) -> Column:
    """The texts of a list, or of one text that is split at ``mark``; blank ones are left out."""
    listed = F.filter(F.transform(_at(value, path, "array<string>"), lambda t: F.trim(t)), lambda t: t != "")
    return F.coalesce(listed, _list(_at(value, path), mark))


def _reason(value: Column, objects: list[str], rows: str | None = None) -> Column:
    """Why a body gives no rows, null where it may: ``objects`` and the place of ``rows`` may be missing or null."""
    wrong = ~_is_object(value)
    for path in objects:
        wrong = wrong | (_held(value, path) & ~_is_object(value, path))
    if rows:
        wrong = wrong | (_held(value, rows) & _members(value, rows).isNull())
    return F.when(value.isNull(), BROKEN).when(wrong, SHAPE)


def _parsed(bodies: DataFrame, body: str, keep: list[str]) -> DataFrame:
    return bodies.select(*(F.col(k).alias(f"_k{i}") for i, k in enumerate(keep)), F.try_parse_json(body).alias("v"))


def _kept(keep: list[str]) -> list[Column]:
    return [F.col(f"_k{i}").alias(k) for i, k in enumerate(keep)]


def _results(bodies: DataFrame, body: str, keep: list[str]) -> DataFrame:
    v = F.col("v")
    total = F.coalesce(_at(v, "$.entity.totalResults", "bigint"), F.lit(0)).alias("total")
    rows = F.explode(_members(v, "$.entity.results")).alias("r")
    return _parsed(bodies, body, keep).select(*(f"_k{i}" for i in range(len(keep))), total, rows)


def search_listings(bodies: DataFrame, body: str = "body", keep: list[str] | None = None) -> DataFrame:
    """Search responses -> one listing per result, with the response's total and the columns ``keep``."""
    keep, r = keep or [], F.col("r")
    rows = _results(bodies, body, keep).where(_at(r, "$.eventId").isNotNull())
    part = lambda f: blank_to_null(F.trim(_at(r, f"$.location.{f}")))
    title = squash(F.coalesce(_at(r, "$.eventTitle"), F.lit("")))
    acronym = F.regexp_extract(title, r"\(([A-Za-z0-9][A-Za-z0-9&\-/ ]{1,24})\)\s*$", 1)
    plain = F.when(~_is_object(r, "$.location"), blank_to_null(squash(_at(r, "$.location"))))
    flag = _at(r, "$.isvirtual")
    return rows.select(
        *_kept(keep),
        "total",
        _at(r, "$.eventId").alias("source_id"),
        title.alias("name"),
        blank_to_null(F.trim(acronym)).alias("acronym"),
        _at(r, "$.startDate").try_cast("date").alias("start_date"),
        _at(r, "$.endDate").try_cast("date").alias("end_date"),
        F.coalesce(blank_to_null(F.concat_ws(", ", part("city"), part("region"), part("country"))), plain).alias("location_raw"),
        part("city").alias("city"),
        part("country").alias("country"),
        F.coalesce(_texts(r, "$.about", ";"), F.array().cast("array<string>")).alias("categories"),
        F.to_json(
            F.struct(
                _at(r, "$.eventId", "bigint").alias("ieee_event_id"),
                _at(r, "$.sponsors").alias("sponsors"),
                _at(r, "$.eventFormat").alias("event_format"),
                F.coalesce((flag == "Y") | (flag == "true"), F.lit(False)).alias("virtual"),
            )
        ).alias("extra"),
    )


def search_rejects(bodies: DataFrame, body: str = "body", keep: list[str] | None = None) -> DataFrame:
    """``keep``, reason: the search responses that gave no rows, and one row for each result without an id."""
    keep = keep or []
    reason = _reason(F.col("v"), ["$.entity"], "$.entity.results")
    whole = _parsed(bodies, body, keep).select(*_kept(keep), reason.alias("reason")).where("reason is not null")
    rows = _results(bodies, body, keep).where(_at(F.col("r"), "$.eventId").isNull())
    return whole.unionByName(rows.select(*_kept(keep), F.lit(RESULT).alias("reason")))


def details(bodies: DataFrame, body: str = "body", keep: list[str] | None = None) -> DataFrame:
    """Detail responses -> event_id, homepage, description, venue, contact, keywords, call, one row per response.

    ``rejected`` says why a response could not be read; all else is null then.
    """
    keep, v = keep or [], F.col("v")
    d = lambda f, kind="string": _at(v, f"$.entity.eventDetail.{f}", kind)
    place = "$.entity.eventDetail"
    return _parsed(bodies, body, keep).select(
        *_kept(keep),
        d("eventId", "bigint").alias("event_id"),
        repaired_url(d("url")).alias("homepage"),
        blank_to_null(squash(d("scope"))).alias("description"),
        blank_to_null(F.array_join(_texts(v, f"{place}.venues", ","), ", ")).alias("venue"),
        blank_to_null(F.trim(d("eventContact"))).alias("contact"),
        F.coalesce(_texts(v, f"{place}.keywords", ","), F.array().cast("array<string>")).alias("keywords"),
        d("callForPapers").alias("call_for_papers"),
        _reason(v, ["$.entity", place]).alias("rejected"),
    )


def published_items(bodies: DataFrame, key: str, body: str = "body") -> DataFrame:
    """Bibliographic answers -> (key, pos, names, year, publisher, doi), one row per item that is an object.

    ``item_rejects`` has the rest.
    """
    items = _parsed(bodies, body, [key]).select(*_kept([key]), F.posexplode(_members(F.col("v"), "$.message.items")).alias("pos", "i"))
    i = F.col("i")
    titles = lambda f: F.coalesce(_at(i, f, "array<string>"), F.array(_at(i, f)))
    volume = F.when(_at(i, "$.type").isin(fv.VOLUME_TYPES), titles("$.title"))
    names = F.concat(F.array(_at(i, "$.event.name")), titles("$['container-title']"), F.coalesce(volume, F.array().cast("array<string>")))
    date = "$.published['date-parts']"
    year = F.coalesce(_at(i, f"{date}[0][0]", "int"), _at(i, f"{date}[0]", "int"))
    return items.where(_is_object(i)).select(
        key,
        "pos",
        F.filter(names, lambda n: n.isNotNull() & (n != "")).alias("names"),
        year.alias("year"),
        _at(i, "$.publisher").alias("publisher"),
        _at(i, "$.DOI").alias("doi"),
    )


def item_rejects(bodies: DataFrame, key: str, body: str = "body") -> DataFrame:
    """(key, reason): the bibliographic answers that gave no rows, and one row for each item that is no object."""
    v = F.col("v")
    answers = _parsed(bodies, body, [key])
    whole = answers.select(*_kept([key]), _reason(v, ["$.message"], "$.message.items").alias("reason")).where("reason is not null")
    items = answers.select(*_kept([key]), F.explode(_members(v, "$.message.items")).alias("i")).where(~_is_object(F.col("i")))
    return whole.unionByName(items.select(key, F.lit(RESULT).alias("reason")))


def _struct(fields: list[tuple[str, str | None]], kind: str | None = None) -> str:
    return f"struct<{','.join(f'{name}:{kind or own}' for name, own in fields)}>"


def _unread(held: Column, read: Column, fields: list[tuple[str, str]]) -> Column:
    """Whether a field of ``held`` holds something that ``read`` could not read as its kind."""
    there = lambda name: held[name].isNotNull() & ~F.is_variant_null(held[name])
    return reduce(Column.__or__, [there(name) & read[name].isNull() for name, _ in fields])


def _finite(fee: Column) -> Column:
    amount = fee["amount"]
    finite = F.when(~F.isnan(amount) & (F.abs(amount) < float("inf")), amount)
    return F.struct(*((finite if name == "amount" else fee[name]).alias(name) for name, _ in EXTRACTED_FEE))


def records(answers: DataFrame, body: str = "answer") -> DataFrame:
    """Extraction answers with an ``extracted`` struct and a ``rejected`` reason, one of them null in each row.

    A broken answer is one rejected row, never a failed run; so is one with a field that is not of its
    kind, such as an amount in words. A single fee in place of a list is a list of one. The body is
    taken apart once into what stands in its fields and once into their kinds, whatever their number.
    """
    plain = [(name, kind) for name, kind in EXTRACTED if kind]
    fees, v = F.col("_held.fees"), F.col("_v")
    listed = lambda kind: F.coalesce(_at(fees, "$", f"array<{kind}>"), F.when(_is_object(fees), F.array(_at(fees, "$", kind))))
    parsed = (
        answers.withColumn("_v", F.try_parse_json(body))
        .withColumns({"_held": _at(v, "$", _struct(EXTRACTED, "variant")), "_read": _at(v, "$", _struct(plain))})
        .withColumns({"_fees_held": listed(_struct(EXTRACTED_FEE, "variant")), "_fees_read": listed(_struct(EXTRACTED_FEE))})
        .withColumn("_fees_read", F.transform("_fees_read", lambda f: F.when(f.isNotNull(), _finite(f))))
    )
    held, read = F.col("_held"), F.col("_read")
    pairs = F.arrays_zip("_fees_held", "_fees_read")
    odd = F.exists(pairs, lambda p: p["_fees_held"].isNull() | _unread(p["_fees_held"], p["_fees_read"], EXTRACTED_FEE))
    shape = held.isNull() | (fees.isNotNull() & ~F.is_variant_null(fees) & F.col("_fees_held").isNull())
    wrong = _unread(held, read, plain) | F.coalesce(odd, F.lit(False))
    reason = F.when(v.isNull(), BROKEN).when(shape, SHAPE).when(wrong, RESULT)
    fields = [(read[name] if kind else F.col("_fees_read")).alias(name) for name, kind in EXTRACTED]
    judged = parsed.withColumn("rejected", reason)
    return judged.withColumn("extracted", F.when(F.col("rejected").isNull(), F.struct(*fields))).select(*answers.columns, "extracted", "rejected")


def extracted_records(answers: DataFrame, body: str = "answer") -> tuple[DataFrame, DataFrame]:
    """``records`` apart: (good rows with ``extracted``, bad rows with ``rejected``). Who needs both in
    one table asks for ``records``, which reads the answers once."""
    read = records(answers, body)
    good = read.select(*answers.columns, present(F.col("extracted")).alias("extracted"))
    return good, read.select(*answers.columns, present(F.col("rejected")).alias("rejected"))


def topic_verdicts(answers: DataFrame, body: str = "answer") -> tuple[DataFrame, DataFrame]:
    """Topic answers -> (good rows with is_topic and reason, bad rows with a ``rejected`` reason).

    An answer without a verdict, or with one that is no boolean, is a bad row; a reason may be missing.
    """
    v = F.col("_v")
    said = _at(v, "$.is_topic", "boolean")
    rejected = F.coalesce(_reason(v, []), F.when(said.isNull(), RESULT))
    parsed = answers.withColumn("_v", F.try_parse_json(body)).withColumn("rejected", rejected)
    good = parsed.where("rejected is null").withColumns({"is_topic": said, "reason": _at(v, "$.reason")})
    return good.drop("_v", "rejected"), parsed.where("rejected is not null").drop("_v")
