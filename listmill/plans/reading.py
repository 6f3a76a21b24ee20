"""What a page read changes: extracted fields, fees, status, attendance, and re-validation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from listmill import fixed_values as fv
from listmill.engine import cut
from listmill.functions.attendance import decide
from listmill.functions.checks import fee_mentions
from listmill.functions.dates import old_edition_note, sane_end
from listmill.functions.fee_kinds import classify
from listmill.functions.labels import is_counted, read_status
from listmill.functions.money import normalize_currency, six_digits
from listmill.functions.regex import blank_to_null
from listmill.operators.fees import check_fees, check_summary
from listmill.operators.incremental import changed_texts
from listmill.operators.lines import fair_shares
from listmill.operators.survivors import PROVENANCE, refresh_ranges


def page_sections(
    entities: DataFrame, listings: DataFrame, linked_pages: DataFrame, homepages: DataFrame, pages: int
) -> DataFrame:
    """(entity_id, ord, section): linked pages (the best last), then source texts, then the
    homepage, each under its header.

    ``linked_pages``: entity_id, rank (1 = best), url, text. ``homepages``: entity_id, text.
    """
    texts = F.array_compact(
        F.array(
            *[
                F.when(
                    blank_to_null(F.get_json_object("extra", f"$.{key}")).isNotNull(),
                    F.concat(
                        F.lit("### "), F.col("source"), F.lit(f" {key} ("), F.coalesce("url", F.lit("None")),
                        F.lit(")\n"), F.get_json_object("extra", f"$.{key}"),
                    ),
                )
                for key in ("register_page_text", "edas_page_text")
            ],
            F.when(
                (F.col("source") == "wikicfp") & (F.coalesce("description", F.lit("")) != ""),
                F.concat(
                    F.lit("### wikicfp call for papers ("), F.coalesce("url", F.lit("None")),
                    F.lit(")\n"), F.col("description"),
                ),
            ),
        )
    )
    order = lambda group, a, b: F.struct(
        F.lit(group).alias("g"), a.cast("bigint").alias("a"), b.cast("bigint").alias("b")
    )
    linked = linked_pages.where(F.col("rank") <= pages - 1).select(
        "entity_id",
        order(0, -F.col("rank"), F.lit(0)).alias("ord"),
        F.concat(F.lit("### page "), F.col("url"), F.lit("\n"), F.col("text")).alias("section"),
    )
    sources = (
        listings.where("entity_id is not null")
        .select("entity_id", "id", F.posexplode(texts).alias("pos", "section"))
        .select("entity_id", order(1, F.col("id"), F.col("pos")).alias("ord"), "section")
    )
    home = homepages.join(
        entities.select(F.col("id").alias("entity_id"), "homepage"), "entity_id"
    ).select(
        "entity_id",
        order(2, F.lit(0), F.lit(0)).alias("ord"),
        F.concat(F.lit("### homepage "), F.col("homepage"), F.lit("\n"), F.col("text")).alias("section"),
    )
    return linked.unionByName(sources).unionByName(home)


def page_texts(sections: DataFrame, max_chars: int) -> DataFrame:
    """(entity_id, text): every section with its fair share of the budget."""
    return fair_shares(sections, "entity_id", "ord", "section", max_chars)


def route_reads(entities: DataFrame, texts: DataFrame) -> DataFrame:
    """(entity_id, text, fingerprint, unchanged): texts equal to the last read are not extracted
    again."""
    known = entities.select(F.col("id").alias("entity_id"), F.col("read_fingerprint").alias("fingerprint"))
    return changed_texts(texts, known, "entity_id")


def _read_fees(reads: DataFrame) -> DataFrame:
    """Fee rows of extracted answers, currencies normalised."""
    rows = reads.where(F.size("extracted.fees") > 0).select(
        "entity_id", "fee_url", F.posexplode("extracted.fees").alias("pos", "f")
    )
    currency = F.coalesce(
        normalize_currency(F.col("f.currency")), blank_to_null(F.upper("f.currency"))
    )
    return rows.select(
        "entity_id",
        "pos",
        F.col("f.category").alias("category"),
        F.col("f.tier").alias("tier"),
        F.col("f.amount").alias("amount"),
        currency.alias("currency"),
        F.col("f.notes").alias("notes"),
        F.col("fee_url").alias("source_url"),
    )


def _checked_rows(checked: DataFrame) -> DataFrame:
    return checked.where(F.col("check.status") != "duplicate").select(
        F.xxhash64("entity_id", F.lit("homepage"), "pos").alias("id"),
        "entity_id",
        "category",
        "tier",
        "amount",
        "currency",
        "notes",
        F.lit("homepage").alias("source"),
        "source_url",
        F.col("check.status").alias("check_status"),
        F.col("check.note").alias("check_note"),
        F.col("check.evidence").alias("evidence"),
    )


def apply_reads(
    entities: DataFrame, fees: DataFrame, listings: DataFrame, reads: DataFrame
) -> tuple[DataFrame, DataFrame]:
    """Entities and fees after a round of page reads.

    ``reads``: entity_id, text, fingerprint, unchanged, extracted (null when nothing was
    readable), note, read_at. Unchanged texts only refresh the read time; a start too far from
    the listed one applies nothing and leaves a note.
    """
    old = entities.select(F.col("id").alias("entity_id"), "start_date", "homepage", "registration_url")
    start = F.col("extracted.start_date").try_cast("date")
    mismatch = old_edition_note(F.col("start_date"), start)
    routed = reads.join(old, "entity_id").withColumns(
        {
            "_mismatch": mismatch,
            "_fresh": ~F.col("unchanged") & F.col("extracted").isNotNull() & mismatch.isNull(),
            "page_url": F.coalesce("homepage", F.lit("source pages")),
            "fee_url": F.coalesce(
                blank_to_null(F.col("extracted.registration_url")),
                blank_to_null(F.col("registration_url")),
                "homepage",
                F.lit("source pages"),
            ),
        }
    )
    routed = cut(routed)
    fresh = routed.where("_fresh")

    # --- fees of the homepage are replaced where the answer lists any; the checks are the dear
    # part and are read many times below, so they are stored once
    checked = cut(
        check_fees(_read_fees(fresh), fresh.select("entity_id", "text"), "entity_id", "pos")
    )
    new_fees = _checked_rows(checked)
    replaced = new_fees.select("entity_id", F.lit("homepage").alias("source")).distinct()
    all_fees = cut(
        fees.join(replaced, ["entity_id", "source"], "left_anti").unionByName(new_fees)
    )

    # --- fields
    routed = routed.select(
        F.col("entity_id").alias("id"), "text", "fingerprint", "unchanged", "extracted", "note",
        "read_at", "_mismatch", "_fresh", "page_url",
    )
    joined = entities.join(routed, "id", "left").withColumn("_fresh", F.coalesce("_fresh", F.lit(False)))
    value = {
        **{f: F.col(f"extracted.{f}").try_cast("date") for f in fv.EXTRACTED_DATES},
        **{f: blank_to_null(F.col(f"extracted.{f}")) for f in fv.EXTRACTED_TEXTS},
    }
    origin = F.struct(F.lit("homepage").alias("source"), F.col("page_url").alias("url"))
    taken = F.array_compact(
        F.array(
            *[
                F.when(F.col("_fresh") & v.isNotNull(), F.struct(F.lit(f).alias("f"), origin.alias("v")))
                for f, v in value.items()
            ]
        )
    )
    sources = F.coalesce("field_sources", F.create_map().cast(PROVENANCE))
    changed = F.transform(taken, lambda t: t["f"])
    provenance = F.map_concat(
        F.map_filter(sources, lambda k, v: ~F.array_contains(changed, k)),
        F.map_from_entries(taken),
    ).cast(PROVENANCE)
    updates = {f: F.when(F.col("_fresh"), F.coalesce(v, F.col(f))).otherwise(F.col(f)) for f, v in value.items()}
    updates["field_sources"] = provenance
    updates["enriched_at"] = F.coalesce("read_at", "enriched_at")
    updates["read_fingerprint"] = F.when(
        F.col("unchanged").isNull() | F.col("unchanged"), F.col("read_fingerprint")
    ).when(F.col("extracted").isNotNull(), F.col("fingerprint"))
    applied = joined.select(
        *[updates.get(c, F.col(c)).alias(c) for c in entities.columns],
        "_fresh", "_mismatch", "unchanged", "extracted", "note", "text",
    ).withColumn(
        "end_date",
        F.when(F.col("_fresh"), sane_end(F.col("start_date"), F.col("end_date"))).otherwise(F.col("end_date")),
    )

    # --- status, note, attendance
    summary = check_summary(checked, "entity_id").select(F.col("entity_id").alias("id"), "check_note")
    owned = _owned(all_fees)
    modes = attendance_inputs(all_fees, listings)
    ranged = cut(applied).join(summary, "id", "left").join(owned, "id", "left").join(modes, "id", "left")
    return _with_status(ranged, entities.columns, all_fees), all_fees


def _owned(fees: DataFrame) -> DataFrame:
    return fees.groupBy(F.col("entity_id").alias("id")).agg(
        F.count("*").alias("n_fees"),
        F.bool_or(is_counted(F.col("check_status"))).alias("any_verified"),
    )


def attendance_inputs(fees: DataFrame, listings: DataFrame) -> DataFrame:
    """(id, virtual_fee, formats): the first fee for virtual attendance as a label, and the
    formats one source lists, sorted."""
    virtual = fees.where(
        classify(F.col("category"), F.col("tier"), F.col("notes"))["mode"] == "virtual"
    )
    label = F.concat(
        F.col("category"), F.lit(": "), six_digits(F.col("amount")), F.lit(" "),
        F.coalesce("currency", F.lit("None")),
    )
    first = virtual.groupBy(F.col("entity_id").alias("id")).agg(F.min_by(label, "id").alias("virtual_fee"))
    formats = listed_formats(listings.where("source = 'ieee' and entity_id is not null"), "entity_id")
    return first.join(formats.withColumnRenamed("entity_id", "id"), "id", "full_outer")


def listed_formats(listings: DataFrame, entity: str, path: str = "$.event_format") -> DataFrame:
    """(entity, formats): the distinct lower-case formats in the listings' JSON, sorted."""
    said = F.lower(F.get_json_object("extra", path))
    return listings.where(said != "").groupBy(entity).agg(
        F.array_sort(F.collect_set(said)).alias("formats")
    )


def _with_status(df: DataFrame, columns: list[str], fees: DataFrame) -> DataFrame:
    usable = F.coalesce("any_verified", F.lit(False))
    asked = F.when(F.col("_fresh") & ~usable, F.col("text"))
    mention = F.get(fee_mentions(asked, most=1), F.lit(0))
    after = read_status(
        usable,
        F.coalesce("n_fees", F.lit(0)),
        F.col("extracted.fees_published"),
        F.col("check_note"),
        mention,
    )
    read = F.col("unchanged").isNotNull() & ~F.coalesce("unchanged", F.lit(False))
    nothing = F.col("extracted").isNull()
    status: Column = (
        F.when(read & (nothing | F.col("_mismatch").isNotNull()), "needs_review")
        .when(F.col("_fresh"), after["status"])
        .otherwise(F.col("status"))
    )
    note = (
        F.when(read & nothing, F.col("note"))
        .when(read & F.col("_mismatch").isNotNull(), F.col("_mismatch"))
        .when(F.col("_fresh"), after["review_note"])
        .otherwise(F.col("review_note"))
    )
    mode = F.when(F.col("_fresh"), decide(F.col("text"), F.col("virtual_fee"), F.col("formats"))).otherwise(
        F.col("attendance")
    )
    new = {"status": status, "review_note": note, "attendance": mode}
    out = cut(df.select(*[new.get(c, F.col(c)).alias(c) for c in columns], "_fresh"))
    done = refresh_ranges(out.where("_fresh").drop("_fresh"), fees)
    return out.where("not _fresh").drop("_fresh").unionByName(done)


def revalidate(entities: DataFrame, fees: DataFrame, texts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Re-checks stored fees against their entity's text (entity_id, text).

    Repeats are deleted, checks and currencies refreshed, ranges and status recomputed. Entities
    without fees get the missed-price check, and lose its note when it no longer holds. What has a row
    for each entity is never broadcast.
    """
    reads = texts.where("text is not null")
    known = reads.select("entity_id").hint("merge")
    mine = fees.join(known, "entity_id", "left_semi")
    others = fees.join(known, "entity_id", "left_anti")
    checked = cut(check_fees(mine, reads, "entity_id", "id"))
    renewed = checked.where(F.col("check.status") != "duplicate").select(
        *[
            {
                "currency": F.coalesce(normalize_currency(F.col("currency")), "currency"),
                "check_status": F.col("check.status"),
                "check_note": F.col("check.note"),
                "evidence": F.col("check.evidence"),
            }
            .get(c, F.col(c))
            .alias(c)
            for c in fees.columns
        ]
    )
    all_fees = cut(others.unionByName(renewed))
    summary = check_summary(checked, "entity_id")
    joined = (
        entities.join(reads.select(F.col("entity_id").alias("id"), F.col("text").alias("_text")).hint("merge"), "id", "left")
        .join(summary.select(F.col("entity_id").alias("id"), "check_note").hint("merge"), "id", "left")
        .join(_owned(all_fees).hint("merge"), "id", "left")
        .withColumn("n_fees", F.coalesce("n_fees", F.lit(0)))
    )
    usable = F.coalesce("any_verified", F.lit(False))
    asked = F.col("_text").isNotNull() & ~usable
    mention = F.get(fee_mentions(F.when(asked, F.col("_text")), most=1), F.lit(0))
    after = read_status(usable, F.col("n_fees"), F.lit(True), F.col("check_note"), mention)
    has_fees = F.col("_text").isNotNull() & (F.col("n_fees") > 0)
    without = F.col("_text").isNotNull() & (F.col("n_fees") == 0)
    restate = has_fees & F.col("status").isin("enriched", "needs_review")
    flagged = F.coalesce("review_note", F.lit("")).startswith(fv.NOTE_MISSED)
    status = (
        F.when(restate, after["status"])
        .when(without & mention.isNotNull(), "needs_review")
        .otherwise(F.col("status"))
    )
    note = (
        F.when(restate | (without & mention.isNotNull()), after["review_note"])
        .when(without & flagged, fv.NOTE_NOT_PUBLISHED)
        .otherwise(F.col("review_note"))
    )
    new = {"status": status, "review_note": note}
    out = cut(
        joined.select(
            *[new.get(c, F.col(c)).alias(c) for c in entities.columns], has_fees.alias("_has")
        )
    )
    done = refresh_ranges(out.where("_has").drop("_has"), all_fees)
    return out.where("not _has").drop("_has").unionByName(done), all_fees


def apply_details(
    entities: DataFrame, listings: DataFrame, details: DataFrame, source: str = "ieee"
) -> tuple[DataFrame, DataFrame]:
    """Detail answers onto the first listing of ``source`` per entity: only missing fields are
    filled, and entities that failed for lack of a homepage are queued again."""
    mine = listings.where((F.col("source") == source) & F.col("entity_id").isNotNull())
    first = mine.groupBy("entity_id").agg(
        F.min_by(F.struct("id", "source_id", "url"), "id").alias("l")
    ).select("entity_id", F.col("l.id").alias("listing_id"), F.col("l.source_id").alias("source_id"), F.col("l.url").alias("l_url"))
    found = first.join(
        details.where("event_id is not null").withColumn("source_id", F.col("event_id").cast("string")),
        "source_id",
    )
    extras = F.to_json(
        F.map_filter(
            F.create_map(
                F.lit("venue"), F.col("venue"),
                F.lit("contact"), F.col("contact"),
                F.lit("keywords"), F.when(F.size("keywords") > 0, F.to_json("keywords")),
                F.lit("call_for_papers"), F.col("call_for_papers"),
            ),
            lambda k, v: v.isNotNull() & (v != ""),
        )
    )
    per_listing = found.select(
        F.col("listing_id").alias("id"), F.col("homepage").alias("_home"),
        F.col("description").alias("_desc"), extras.alias("_extra"),
    )
    text_map = "map<string,string>"
    merged = F.map_concat(
        F.map_filter(
            F.coalesce(F.from_json("extra", text_map), F.create_map().cast(text_map)),
            lambda k, v: ~F.map_contains_key(F.from_json("_extra", text_map), k),
        ),
        F.from_json("_extra", text_map),
    )
    row = {
        "homepage": F.coalesce("_home", "homepage"),
        "description": F.coalesce(blank_to_null(F.col("description")), "_desc", "description"),
        "extra": F.when(F.col("_extra").isNotNull() & (F.col("_extra") != "{}"), F.to_json(merged)).otherwise(F.col("extra")),
    }
    new_listings = listings.join(per_listing, "id", "left").select(
        *[row.get(c, F.col(c)).alias(c) for c in listings.columns]
    )
    per_entity = found.select(
        F.col("entity_id").alias("id"), F.col("homepage").alias("_home"),
        F.col("description").alias("_desc"), "l_url",
    )
    joined = entities.join(per_entity, "id", "left")
    sources = F.coalesce("field_sources", F.create_map().cast(PROVENANCE))
    gets = {
        "homepage": (F.coalesce("homepage", F.lit("")) == "") & F.col("_home").isNotNull(),
        "description": (F.coalesce("description", F.lit("")) == "") & F.col("_desc").isNotNull(),
    }
    taken = F.array_compact(
        F.array(
            *[
                F.when(
                    hit,
                    F.struct(F.lit(f).alias("f"), F.struct(F.lit(source).alias("source"), F.col("l_url").alias("url")).alias("v")),
                )
                for f, hit in gets.items()
            ]
        )
    )
    names = F.transform(taken, lambda t: t["f"])
    queued = (
        gets["homepage"] & (F.col("status") == "needs_review") & (F.col("review_note") == fv.NOTE_UNREADABLE)
    )
    new = {
        "homepage": F.when(gets["homepage"], F.col("_home")).otherwise(F.col("homepage")),
        "description": F.when(gets["description"], F.col("_desc")).otherwise(F.col("description")),
        "field_sources": F.map_concat(
            F.map_filter(sources, lambda k, v: ~F.array_contains(names, k)), F.map_from_entries(taken)
        ).cast(PROVENANCE),
        "status": F.when(queued, "collected").otherwise(F.col("status")),
        "review_note": F.when(~F.coalesce(queued, F.lit(False)), F.col("review_note")),
    }
    return joined.select(*[new.get(c, F.col(c)).alias(c) for c in entities.columns]), new_listings
