"""Landed API responses: readers and parsers. One response per row, whole body as text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starload.functions import jsontext as js

DETAIL_COLUMNS = [
    "price_initial",
    "price_final",
    "price_discount_percent",
    "price_currency",
    "release_date",
    "short_description",
    "developers",
    "publishers",
    "categories",
    "genres",
]


def read_payloads(spark: SparkSession, path: str) -> DataFrame:
    """A folder of list payloads, one file each: payload_id, body."""
    files = spark.read.text(path, wholetext=True)
    return files.select(F.col("_metadata.file_path").alias("payload_id"), F.col("value").alias("body"))


def read_responses(spark: SparkSession, path: str) -> DataFrame:
    """A folder of per-game responses, files named `<appid>.json`: appid, body."""
    files = spark.read.text(path, wholetext=True)
    stem = F.regexp_extract(F.col("_metadata.file_name"), r"^([0-9]+)\.json\z", 1)
    return files.select(stem.alias("stem"), F.col("value").alias("body")).filter(
        F.col("stem") != ""
    ).select(F.col("stem").cast("int").alias("appid"), "body")


def read_response_lines(spark: SparkSession, path: str) -> DataFrame:
    """The same responses packed many to a file, one `{"appid": .., "body": ".."}` per line.

    Millions of one-response files cost more to list than to read; this is the layout for volume.
    """
    return spark.read.schema("appid int, body string").option("mode", "FAILFAST").json(path)


def parse_top_list(payloads: DataFrame) -> DataFrame:
    """payload_id, body -> one row per numeric key, in list order.

    A body that is not a JSON object, or an entry that is not one, ends the job. A missing field
    takes its default, a null field stays NULL.
    """
    body = F.from_json("body", "map<string,string>", js.STRICT)
    body = F.coalesce(body, F.raise_error(F.lit("the list payload is not a JSON object")))
    entries = payloads.select(
        "payload_id",
        F.posexplode(F.map_from_entries(F.map_entries(body))).alias("pos", "key", "entry"),
    )
    numeric = entries.filter(F.col("key").rlike(r"^[0-9]+\z"))
    infos = numeric.select(
        "payload_id",
        "pos",
        F.col("key").cast("int").alias("appid"),
        js.object_or_fail(F.col("entry")).alias("info"),
    )
    info, zero, empty = F.col("info"), F.lit(0), F.lit("")
    parsed = js.once(
        js.with_default(info, "name", empty, js.text).alias("name"),
        js.with_default(info, "score", zero, js.whole_number).alias("score"),
        js.with_default(info, "userscore", zero, js.whole_number).alias("userscore"),
        js.with_default(info, "owners", empty, js.text).alias("owners"),
        js.with_default(info, "average_forever", zero, js.whole_number).alias("average_playtime"),
        js.with_default(info, "median_forever", zero, js.whole_number).alias("median_playtime"),
        js.with_default(info, "ccu", zero, js.whole_number).alias("ccu"),
    )
    return infos.select("payload_id", "pos", "appid", parsed)


def _is_object_or_missing(obj: Column, name: str, inner: Column) -> Column:
    return ~js.has(obj, name) | inner.isNotNull()


def _descriptions(data: Column, name: str, items: Column) -> Column:
    """JSON list of the elements' descriptions; missing or empty list gives []."""
    listed = F.to_json(
        F.transform(items, lambda item: js.text(F.try_element_at(item, F.lit("description"))))
    )
    return F.coalesce(listed, F.lit("[]"))


def _is_object_list(data: Column, name: str, items: Column) -> Column:
    """Missing, empty of any kind, or a list holding objects only."""
    blank = F.to_json(js.field(data, name)).isin("{}", '""')
    only_objects = F.forall(items, lambda item: item.isNotNull())
    return ~js.has(data, name) | F.coalesce(blank, F.lit(False)) | F.coalesce(only_objects, F.lit(False))


def parse_app_details(responses: DataFrame) -> DataFrame:
    """appid, body -> outcome per response, and the detail columns.

    outcome: `detail` (usable), `fallback` (answered, but no data for this game) or `reject` (the
    response cannot be read; `reject_reason` says why).
    """
    top = responses.select("appid", js.object_or_null(F.col("body")).alias("top"))
    entry = top.select(
        "appid",
        "top",
        js.field(F.col("top"), F.col("appid").cast("string")).alias("entry"),
    )
    app = entry.select(
        "appid",
        "top",
        "entry",
        js.nested_object(F.col("entry")).alias("app"),
    )
    data = app.select(
        "appid",
        F.when(F.col("top").isNull(), "body_not_object")
        .when(F.col("entry").isNotNull() & F.col("app").isNull(), "entry_not_object")
        .alias("early_reject"),
        (js.is_truthy(js.field(F.col("app"), "success")) & js.has(F.col("app"), "data")).alias("usable"),
        js.nested_object(js.field(F.col("app"), "data")).alias("data"),
    )
    d = F.col("data")
    parts = data.select(
        "appid",
        "early_reject",
        F.coalesce("usable", F.lit(False)).alias("usable"),
        "data",
        js.nested_object(js.field(d, "price_overview")).alias("price"),
        js.nested_object(js.field(d, "release_date")).alias("release"),
        _objects(js.field(d, "categories")).alias("category_items"),
        _objects(js.field(d, "genres")).alias("genre_items"),
    )
    price, release = F.col("price"), F.col("release")
    categories, genres = F.col("category_items"), F.col("genre_items")
    reason = (
        F.when(F.col("early_reject").isNotNull(), F.col("early_reject"))
        .when(~F.col("usable"), F.lit(None))
        .when(d.isNull(), "data_not_object")
        .when(~_is_object_or_missing(d, "price_overview", price), "price_not_object")
        .when(~_is_object_or_missing(d, "release_date", release), "release_not_object")
        .when(~_is_object_list(d, "categories", categories), "categories_not_objects")
        .when(~_is_object_list(d, "genres", genres), "genres_not_objects")
    )
    judged = parts.withColumn("reject_reason", reason).withColumn(
        "outcome",
        F.when(F.col("reject_reason").isNotNull(), "reject")
        .when(F.col("usable"), "detail")
        .otherwise("fallback"),
    )
    usable = F.col("outcome") == "detail"
    empty_list = F.lit("[]")
    details = {
        "detail_name": js.text(js.field(d, "name")),
        "price_initial": js.whole_number(js.field(price, "initial")),
        "price_final": js.whole_number(js.field(price, "final")),
        "price_discount_percent": js.whole_number(js.field(price, "discount_percent")),
        "price_currency": js.text(js.field(price, "currency")),
        "release_date": js.text(js.field(release, "date")),
        "short_description": js.text(js.field(d, "short_description")),
        "developers": js.with_default(d, "developers", empty_list, js.dump),
        "publishers": js.with_default(d, "publishers", empty_list, js.dump),
        "categories": _descriptions(d, "categories", categories),
        "genres": _descriptions(d, "genres", genres),
    }
    parsed = js.once(
        F.col("outcome"),
        F.col("reject_reason"),
        (usable & js.has(d, "name")).alias("has_name"),
        *[F.when(usable, column).alias(name) for name, column in details.items()],
    )
    return judged.select("appid", parsed)


def _objects(value: Column) -> Column:
    """A nested list as objects; an element of another type becomes NULL."""
    items = F.try_variant_get(value, "$", "array<variant>")
    return F.transform(items, js.nested_object)


def parse_player_count(responses: DataFrame) -> DataFrame:
    """appid, body -> appid, ccu. Anything but a good answer counts as 0, a null count stays NULL."""
    top = responses.select("appid", js.object_or_null(F.col("body")).alias("top"))
    answer = top.select(
        "appid", js.nested_object(js.field(F.col("top"), "response")).alias("answer")
    )
    good = js.is_one(js.field(F.col("answer"), "result"))
    count = js.with_default(F.col("answer"), "player_count", F.lit(0), js.whole_number)
    return answer.select("appid", js.once(F.when(good, count).otherwise(F.lit(0)).alias("ccu")))
