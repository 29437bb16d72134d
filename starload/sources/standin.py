"""The generated tables in the roles of the warehouse's inputs.

`part` stands for the games (list, detail and count payloads, and the raw current-state table),
`lineitem` and `events` for daily snapshots. Faults are planted by attribute (type, size, brand), and
every row of every table takes part.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starload.operators.enrich import has_store_data


SCHEMAS = {
    "part": """p_partkey bigint, p_name string, p_brand string, p_type string, p_size int,
        p_retailprice double""",
    "lineitem": """l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int,
        l_quantity double, l_extendedprice double, l_discount double, l_tax double,
        l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz""",
    "events": """event_id bigint, ts timestamp_ntz, user_id bigint, event_type string,
        value double, props string""",
}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{folder}/{name}.parquet")


def spread(rows: DataFrame) -> DataFrame:
    """The rows dealt over the cluster, whatever their keys, before costly work on each.

    A file is read in as many tasks as it has row groups, often one, and the texts made of its rows are many times
    larger than the file: without this one task would make and parse them all. Small input stays in few tasks.
    """
    return rows.hint("rebalance")


def _text(column: Column) -> Column:
    return F.concat(F.lit('"'), column, F.lit('"'))


def _pair(name: str, value: Column) -> Column:
    return F.concat(F.lit(f'"{name}":'), value.cast("string"))


def _object(*pairs: Column) -> Column:
    """JSON object text; a NULL pair is a missing field."""
    return F.concat(F.lit("{"), F.concat_ws(",", *pairs), F.lit("}"))


def _list(*items: Column) -> Column:
    return F.concat(F.lit("["), F.concat_ws(",", *items), F.lit("]"))


def _attributes() -> tuple[Column, Column, Column, Column, Column]:
    """Size, type, brand, price in cents, and the JSON null."""
    price = F.round(F.col("p_retailprice") * 100).cast("int")
    return F.col("p_size"), F.col("p_type"), F.col("p_brand"), price, F.lit("null")


def list_payloads(part: DataFrame) -> DataFrame:
    """One list payload per part: its entry under a (sometimes zero-padded) key, and one to skip."""
    size, kind, brand, price, null = _attributes()
    key = F.col("p_partkey").cast("string")
    shown = F.when(kind == "STANDARD", F.concat(F.lit("00"), key)).otherwise(key)
    entry = _object(
        F.when(kind != "SMALL", _pair("name", F.when(size == 7, null).otherwise(_text(F.col("p_name"))))),
        F.when(size > 5, _pair("score", size)),
        _pair("userscore", F.when(size.between(40, 44), null).otherwise((size * 2).cast("string"))),
        F.when(brand != "Brand#9", _pair("owners", _text(F.concat(size, F.lit(" .. "), size * 2)))),
        F.when(kind != "MEDIUM", _pair("average_forever", size * 10)),
        _pair("median_forever", F.when(size >= 45, null).otherwise(F.concat(size, F.lit(".5")))),
        F.when(size != 3, _pair("ccu", F.when(size == 4, null).otherwise(price.cast("string")))),
    )
    skipped = F.concat(_text(F.concat(F.lit("x"), key)), F.lit(':{"name":"not a game"}'))
    body = F.concat(F.lit("{"), _text(shown), F.lit(":"), entry, F.lit(","), skipped, F.lit("}"))
    return spread(part).select(key.alias("payload_id"), body.alias("body"))


def detail_responses(part: DataFrame, described_from_size: int = 0) -> DataFrame:
    """One detail response per part. Parts below `described_from_size` carry no description."""
    size, kind, brand, price, null = _attributes()
    key = F.col("p_partkey").cast("string")
    overview = _object(
        _pair("initial", price),
        _pair("final", F.floor(price * (100 - size) / 100).cast("int")),
        _pair("discount_percent", size),
        F.when(kind != "MEDIUM", _pair("currency", _text(F.lit("USD")))),
    )
    words = F.split(F.col("p_name"), " ")
    described = F.transform(words, lambda w: F.concat(F.lit('{"description":"'), w, F.lit('"}')))
    genres = _list(F.concat_ws(",", described), F.when(size == 15, null))
    data = _object(
        F.when(
            ~size.between(20, 22),
            _pair(
                "name",
                F.when(size == 23, null).otherwise(_text(F.concat(F.col("p_name"), F.lit(" HD")))),
            ),
        ),
        F.when(size == 14, _pair("price_overview", null)).when(
            (kind != "LARGE") & (size < 49), _pair("price_overview", overview)
        ),
        F.when(size <= 45, _pair("release_date", _object(_pair("date", _text(brand))))),
        F.when(
            (brand != "Brand#11") & (size < 49) & (size >= described_from_size),
            _pair("short_description", _text(kind)),
        ),
        F.when(size != 24, _pair("developers", _list(_text(brand)))),
        _pair("publishers", _list(_text(brand), _text(F.concat(F.lit(" "), kind, F.lit(" "))))),
        _pair("categories", _list(_object(_pair("description", _text(kind))), F.lit('{"id":1}'))),
        _pair("genres", genres),
    )
    usable = _object(_pair("success", F.lit("true")), _pair("data", F.when(size == 13, null).otherwise(data)))
    answer = F.when(kind == "SMALL", F.lit('{"success":false}')).otherwise(usable)
    body = F.when(kind == "PROMO", F.lit("<html>try again later</html>")).otherwise(
        F.concat(F.lit("{"), _text(key), F.lit(":"), answer, F.lit("}"))
    )
    return spread(part).select(F.col("p_partkey").cast("int").alias("appid"), body.alias("body"))


def count_responses(part: DataFrame, more: int = 0) -> DataFrame:
    """One player-count response per part: good (with `more` players), failed, without a count, null, unreadable."""
    size, _, brand, _, null = _attributes()
    result = F.when(brand == "Brand#13", F.lit("42")).otherwise(F.lit("1"))
    count = F.when(size == 31, null).otherwise((F.col("p_partkey") + 1 + more).cast("string"))
    answer = _object(_pair("result", result), F.when(size != 30, _pair("player_count", count)))
    body = F.when(size == 32, F.lit('{"response":')).otherwise(_object(_pair("response", answer)))
    return spread(part).select(F.col("p_partkey").cast("int").alias("appid"), body.alias("body"))


def land(part: DataFrame, folder: str, more: int = 0, entries: int = 100) -> None:
    """The responses of one day as files: lists of up to so many games, one to a file, and packed detail and count
    responses."""
    listed = list_payloads(part).withColumn("list", F.floor(F.col("payload_id").cast("long") / entries))
    inner = F.expr("substring(body, 2, char_length(body) - 2)")
    body = F.concat(F.lit("{"), F.concat_ws(",", F.array_sort(F.collect_list(inner))), F.lit("}"))
    packed = listed.groupBy("list").agg(body.alias("value"))
    # A folder for each list would have to be listed one by one when read.
    packed.select("value").write.option("maxRecordsPerFile", 1).text(f"{folder}/list")
    detail_responses(part).write.json(f"{folder}/details")
    count_responses(part, more).write.json(f"{folder}/counts")


def raw_games(part: DataFrame) -> DataFrame:
    """Parts as rows of the current-state table, before the store-data gate."""
    size, kind, brand, price, _ = _attributes()
    priced = size < 49
    first, second = brand, F.concat(F.lit(" "), kind, F.lit(" "))
    third = F.when(kind == "SMALL", "  ").otherwise(brand)
    discounted = F.floor(price.cast("bigint") * (100 - size) / 100).cast("int")
    updated = F.date_add(F.lit("2024-01-01").cast("date"), size).cast("timestamp_ntz")
    return part.select(
        F.col("p_partkey").cast("int").alias("appid"),
        F.col("p_name").alias("name"),
        F.when(priced, price).alias("price_initial"),
        F.when(priced, discounted).alias("price_final"),
        size.alias("price_discount_percent"),
        F.when(kind != "MEDIUM", "USD").alias("price_currency"),
        F.lit(None).cast("string").alias("release_date"),
        F.when(priced & (brand != "Brand#11"), kind).alias("short_description"),
        F.to_json(F.array(brand)).alias("developers"),
        F.when(size == 17, F.lit(None))
        .when(size == 19, "[]")
        .otherwise(F.to_json(F.array(first, second, third)))
        .alias("publishers"),
        F.to_json(F.array(kind)).alias("categories"),
        F.to_json(F.split("p_name", " ")).alias("genres"),
        updated.alias("created_at"),
        updated.alias("updated_at"),
    )


def games(part: DataFrame) -> DataFrame:
    return raw_games(part).filter(has_store_data())


def shipment_snapshots(lineitem: DataFrame) -> DataFrame:
    """Line items per part and ship date, as snapshots of 1995-2001."""
    return lineitem.groupBy(
        F.col("l_partkey").cast("int").alias("appid"),
        F.col("l_shipdate").cast("date").alias("recorded_date"),
    ).agg(
        F.sum("l_quantity").cast("int").alias("ccu"),
        F.count("*").cast("int").alias("score"),
        F.max("l_linenumber").alias("userscore"),
        F.concat(F.min("l_suppkey"), F.lit(" .. "), F.max("l_suppkey")).alias("owners"),
        F.round(F.max("l_tax") * 100).cast("int").alias("average_playtime"),
        F.round(F.min("l_discount") * 100).cast("int").alias("median_playtime"),
    )


def event_snapshots(events: DataFrame) -> DataFrame:
    """Events per user and day, as snapshots of January 2024."""
    return events.groupBy(
        F.col("user_id").cast("int").alias("appid"),
        F.col("ts").cast("date").alias("recorded_date"),
    ).agg(
        F.count("*").cast("int").alias("ccu"),
        F.count_if(F.col("event_type") == "purchase").cast("int").alias("score"),
        F.count_if(F.col("event_type") == "error").cast("int").alias("userscore"),
        F.lit(None).cast("string").alias("owners"),
        F.round(F.max("value") * 100).cast("int").alias("average_playtime"),
        F.round(F.min("value") * 100).cast("int").alias("median_playtime"),
    )
