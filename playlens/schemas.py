"""Column lists of the typed tables; none is inferred."""

USER = "user_id string, gender string, age int, date string, extra string"
BANNER = "min_age int, max_age int, gender string, banner string"
PROFILE = "id string, gender string, age string, country string, registered string"
PLAY_COUNT = "user_id string, artist_id string, artist_name string, plays int"
EVENT = (
    "user_id string, timestamp string, artist_id string, artist_name string, "
    "track_id string, track_name string"
)
WIRE = "key binary, value binary"
USER_TABLE = "user_id string, banner string, plays bigint"
CATALOGUE = "artist_id string, item bigint, artist_name string"
ID_MAP = "id string, rank bigint"


def names(ddl: str) -> list[str]:
    """Column names of a DDL column list."""
    return [column.split()[0] for column in ddl.split(",")]
