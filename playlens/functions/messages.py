"""Wire form of play events and the texts of outgoing messages."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from playlens import constants, schemas
from playlens.functions.text import TAB

EVENT_COLUMNS = schemas.names(schemas.EVENT)


def wire_key(user_id: Column) -> Column:
    return F.concat(user_id, F.lit(TAB)).cast("binary")


def wire_value() -> Column:
    """Six fields, each followed by a tab, as bytes."""
    return F.concat(F.concat_ws(TAB, *EVENT_COLUMNS), F.lit(TAB)).cast("binary")


def payload(value: Column) -> Column:
    """Text of a wire value; bytes that are no UTF-8 become the replacement character."""
    return F.make_valid_utf8(value.cast("string"))


def first_line_filled(text: Column) -> Column:
    """True unless the first line is empty; blanks count as filled."""
    return F.substring_index(text, "\n", 1) != ""


def banner_message(user_id: Column, banner: Column) -> Column:
    return F.format_string(constants.BANNER_MESSAGE, user_id, banner)


def recommendation_message(name: Column) -> Column:
    return F.format_string(constants.RECOMMENDATION_MESSAGE, name)
