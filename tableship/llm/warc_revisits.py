"""Not-modified revisits of web archives, resolved to the responses they stand for.

A revisit record says that a page had not changed; what it had not changed from is the latest
earlier full response of the same canonical URL. This is an as-of join. Its validators - entity
tag, or date of last modification - are checked against that response, and the headers that a
not-modified answer may update are merged.

A URL can hold a third of all records, so none is ever gathered in one place: time is cut
into slots, the latest response of each slot is kept per URL, and a revisit looks first
inside its own slot and then at the last response of the slots before. Bodies take no part in
this: only identifiers are matched, and a body is fetched by the identifier that was found.

Records with a null URL or time match nothing. Records of equal time are ordered by their
identifier; a response counts as earlier than a revisit of the same time if its identifier is
smaller. Repeated rows of a response are equal and one of them is taken. Null or missing
validators are not checked: a revisit without any matches on time alone and is marked so. Of
headers whose names differ in case alone the first that is not null stays, in the order of
their names as written, upper case before lower. An empty table gives no rows.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tableship.llm.common import staged

# Fixed values of the HTTP specification: headers a 304 answer may replace (RFC 9110, 15.4.5,
# and those that RFC 9111, 3.2 lets caches update); representation and hop headers stay.
PERMITTED = ("age", "cache-control", "content-location", "date", "etag", "expires",
             "last-modified", "set-cookie", "vary", "warning")


@dataclass(frozen=True)
class Options:
    """``slot_seconds``: length of a time slot; ``permitted``: headers taken from a revisit."""

    slot_seconds: int = 86_400
    permitted: tuple[str, ...] = PERMITTED


DEFAULTS = Options()

#: Columns of a record.
RECORD = "record_id long, kind string, url string, time timestamp, headers map<string,string>, body string"


def canonical_url(url: Column) -> Column:
    """Scheme, ``www.`` and default ports dropped, host in lower case, fragment, tracking
    parameters and trailing slash dropped, other parameters sorted; null stays null."""
    bare = F.regexp_replace(F.trim(url), r"#.*$", "")
    bare = F.regexp_replace(bare, r"^(?i:https?)://", "")
    host = F.lower(F.regexp_extract(bare, r"^([^/?]*)", 1))
    host = F.regexp_replace(F.regexp_replace(host, r":(80|443)$", ""), r"^www\.", "")
    path = F.regexp_replace(F.regexp_extract(bare, r"^[^/?]*([^?]*)", 1), r"/+$", "")
    asked = F.split(F.regexp_extract(bare, r"\?(.*)$", 1), "&")
    kept = F.filter(asked, lambda p: (p != "") & ~p.rlike(r"^(utm_[a-z]+|fbclid|gclid|ref)(=|$)"))
    query = F.array_join(F.array_sort(kept), "&")
    return F.concat(host, path, F.when(query != "", F.concat(F.lit("?"), query)).otherwise(""))


def resolve(records: DataFrame, options: Options = DEFAULTS) -> DataFrame:
    """One row per revisit of ``records`` (columns of ``RECORD``): ``record_id``, ``canonical``,
    ``time``, ``response_id``, ``response_time``, ``outcome`` (``matched``, ``unchecked`` where
    it names no validator, ``mismatch``, ``unresolved``), merged ``headers`` and the ``body`` of
    a response that it stands for."""
    entries = F.transform(
        F.array_sort(F.map_entries("headers")),
        lambda e: F.struct(F.lower(e["key"]).alias("key"), e["value"].alias("value")),
    )

    def first(name: Column) -> Column:
        held = F.filter(entries, lambda e: (e["key"] == name) & e["value"].isNotNull())
        return F.struct(name.alias("key"), F.get(held, F.lit(0))["value"].alias("value"))

    names = F.array_distinct(F.transform(entries, lambda e: e["key"]))
    lower = F.map_from_entries(F.transform(names, first))
    slim = records.select(
        "record_id",
        "kind",
        canonical_url(F.col("url")).alias("canonical"),
        "time",
        F.coalesce(lower, F.create_map().cast("map<string,string>")).alias("headers"),
    )
    slim = staged(slim, "archive-records")
    timed = slim.where("canonical IS NOT NULL AND time IS NOT NULL").withColumn(
        "slot", F.floor(F.unix_timestamp("time") / options.slot_seconds)
    )
    order = F.struct("time", "record_id")
    responses = timed.where("kind = 'response'").select("canonical", "slot", order.alias("at"))
    # The last response of a slot, and for each slot the last one of those before it: one
    # short row per URL and slot.
    last = responses.groupBy("canonical", "slot").agg(F.max("at").alias("last"))
    revisits = timed.where("kind = 'revisit'")
    asked = revisits.select("canonical", "slot").distinct()
    slots = asked.join(last, ["canonical", "slot"], "full_outer")
    before = Window.partitionBy("canonical").orderBy("slot").rowsBetween(
        Window.unboundedPreceding, -1
    )
    slots = slots.select("canonical", "slot", F.max("last").over(before).alias("before"))

    inside = Window.partitionBy("canonical", "slot").orderBy("time", "record_id").rowsBetween(
        Window.unboundedPreceding, -1
    )
    response_at = F.when(F.col("kind") == "response", order)
    found = (
        timed.withColumn("own", F.max(response_at).over(inside))
        .where("kind = 'revisit'")
        .join(slots, ["canonical", "slot"])
        .select("record_id", "canonical", "time", "headers", F.coalesce("own", "before").alias("hit"))
    )
    nowhere = slim.where("kind = 'revisit' AND (canonical IS NULL OR time IS NULL)").select(
        "record_id", "canonical", "time", "headers", F.lit(None).cast("struct<time:timestamp,record_id:long>").alias("hit")
    )
    found = found.unionByName(nowhere)
    # Only the responses that are asked for are read again, each once.
    wanted = found.select(F.col("hit.record_id").alias("id")).where("id IS NOT NULL").distinct()
    stored = (
        records.where("kind = 'response'")
        .select(F.col("record_id").alias("id"), "body")
        .join(wanted, "id", "left_semi")
        .dropDuplicates(["id"])
    )
    stored = stored.join(
        slim.where("kind = 'response'")
        .select(F.col("record_id").alias("id"), F.col("headers").alias("stored"))
        .dropDuplicates(["id"]),
        "id",
    )
    met = found.join(stored, F.col("hit.record_id") == F.col("id"), "left")

    def agrees(name: str) -> Column:
        """True, false, or null where the revisit does not name this validator."""
        asked, held = F.col("headers")[name], F.col("stored")[name]
        weak = r"^W/"
        same = F.regexp_replace(asked, weak, "") == F.regexp_replace(held, weak, "")
        return F.when(asked.isNotNull(), F.coalesce(same, F.lit(False)))

    # An entity tag decides; the date only where there is none.
    checked = F.coalesce(agrees("etag"), agrees("last-modified"))
    outcome = (
        F.when(F.col("id").isNull(), "unresolved")
        .when(checked.isNull(), "unchecked")
        .when(checked, "matched")
        .otherwise("mismatch")
    )
    good = F.col("outcome").isin("matched", "unchecked")
    taken = F.map_filter("headers", lambda k, _: k.isin(*options.permitted))
    merged = F.map_concat(F.map_filter("stored", lambda k, _: ~F.call_function("map_contains_key", taken, k)), taken)
    return met.withColumn("outcome", outcome).select(
        "record_id",
        "canonical",
        "time",
        F.col("hit.record_id").alias("response_id"),
        F.col("hit.time").alias("response_time"),
        "outcome",
        F.when(good, merged).otherwise(F.col("headers")).alias("headers"),
        F.when(good, F.col("body")).alias("body"),
    )
