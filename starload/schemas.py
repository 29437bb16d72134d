"""Column types of every stored table. Read with these; never infer."""

from __future__ import annotations

# Natural attributes of a game that the dimension overwrites in place.
GAME_ATTRIBUTES = [
    "name",
    "release_date",
    "price_initial",
    "price_final",
    "price_discount_percent",
    "price_currency",
    "short_description",
]

# Everything the current-state table overwrites on a match.
GAME_COLUMNS = [
    "name",
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

METRICS = ["ccu", "score", "userscore", "owners", "average_playtime", "median_playtime"]

SCHEMAS = {
    "games": """appid int, name string, price_initial int, price_final int,
        price_discount_percent int, price_currency string, release_date string,
        short_description string, developers string, publishers string, categories string,
        genres string, created_at timestamp_ntz, updated_at timestamp_ntz""",
    "snapshots": """appid int, name string, score int, userscore int, owners string,
        average_playtime int, median_playtime int, ccu int, recorded_date date,
        created_at timestamp_ntz, ym int""",
    "rejects": """appid int, name string, reject_reason string, run_date date, run_id string""",
    "etl_bookmark": "table_name string, last_loaded_date date, updated_at timestamp_ntz",
    "dim_date": """date_key int, full_date date, day_of_week int, day_name string, month int,
        month_name string, quarter int, year int, is_weekend boolean, ym int""",
    "dim_games": """game_key bigint, appid int, name string, release_date string,
        price_initial int, price_final int, price_discount_percent int, price_currency string,
        short_description string, created_at timestamp_ntz, updated_at timestamp_ntz""",
    "dim_publishers": "publisher_key bigint, publisher_name string, created_at timestamp_ntz",
    "dim_genres": "genre_key bigint, genre_name string, created_at timestamp_ntz",
    "bridge_game_publishers": "game_key bigint, publisher_key bigint",
    "bridge_game_genres": "game_key bigint, genre_key bigint",
    "fact_game_metrics": """game_key bigint, date_key int, ccu int, score int, userscore int,
        owners string, average_playtime int, median_playtime int, created_at timestamp_ntz,
        ym int""",
}

# Stored one folder per month.
MONTHLY = {"snapshots", "fact_game_metrics"}

# Stored by a hash of a column, in so many buckets unless the store is created with another number, which it keeps.
BUCKETED = {"games": ("appid", 32), "dim_games": ("appid", 32)}

# Keys of a dimension are handed out in so many buckets, unless the store is created with another number.
KEY_BUCKETS = 1024

# Declared widths, keys, required columns and references (fixed values).
MAX_LENGTHS = {
    "games": {"name": 500, "price_currency": 10, "release_date": 50},
    "snapshots": {"name": 500, "owners": 100},
    "etl_bookmark": {"table_name": 100},
    "dim_date": {"day_name": 20, "month_name": 20},
    "dim_games": {"name": 500, "release_date": 50, "price_currency": 10},
    "dim_publishers": {"publisher_name": 255},
    "dim_genres": {"genre_name": 100},
    "fact_game_metrics": {"owners": 100},
}

UNIQUE_KEYS = {
    "games": [["appid"]],
    "snapshots": [["appid", "recorded_date"]],
    "etl_bookmark": [["table_name"]],
    "dim_date": [["date_key"], ["full_date"]],
    "dim_games": [["game_key"], ["appid"]],
    "dim_publishers": [["publisher_key"], ["publisher_name"]],
    "dim_genres": [["genre_key"], ["genre_name"]],
    "bridge_game_publishers": [["game_key", "publisher_key"]],
    "bridge_game_genres": [["game_key", "genre_key"]],
    "fact_game_metrics": [["game_key", "date_key"]],
}

REQUIRED = {
    "games": ["appid"],
    "snapshots": ["appid", "recorded_date"],
    "etl_bookmark": ["table_name", "last_loaded_date"],
    "dim_date": [
        "date_key",
        "full_date",
        "day_of_week",
        "day_name",
        "month",
        "month_name",
        "quarter",
        "year",
        "is_weekend",
    ],
    "dim_games": ["game_key", "appid", "name"],
    "dim_publishers": ["publisher_key", "publisher_name"],
    "dim_genres": ["genre_key", "genre_name"],
    "bridge_game_publishers": ["game_key", "publisher_key"],
    "bridge_game_genres": ["game_key", "genre_key"],
    "fact_game_metrics": ["game_key", "date_key"],
}

# child table -> (child column, parent table, parent column)
REFERENCES = {
    "snapshots": [("appid", "games", "appid")],
    "bridge_game_publishers": [
        ("game_key", "dim_games", "game_key"),
        ("publisher_key", "dim_publishers", "publisher_key"),
    ],
    "bridge_game_genres": [
        ("game_key", "dim_games", "game_key"),
        ("genre_key", "dim_genres", "genre_key"),
    ],
    "fact_game_metrics": [
        ("game_key", "dim_games", "game_key"),
        ("date_key", "dim_date", "date_key"),
    ],
}

FACT = "fact_game_metrics"
