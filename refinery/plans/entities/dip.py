"""Theatre: productions, performances, theatres, and ticket sales per performance."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from refinery.functions import as_of_date, cents_to_decimal, is_recent, parse_timestamp
from refinery.operators import explode_children, project
from refinery.plans.entities.entity import Entity

# The record layouts; ranks 1 to 10 have a counter each.
RANKS = range(1, 11)
RANK_FIELDS = ", ".join(f"amount_rank{rank} int" for rank in RANKS)
SCHEMAS = {
    "productions": "id string, title string, startDate string, season string",
    "performances": f"""
        id int,
        number int,
        date string,
        status string,
        type string,
        private boolean,
        in_festival boolean,
        production struct<id: string>,
        theater_location struct<id: int>,
        {RANK_FIELDS},
        _production_id string""",
    "theaters": """
        id int,
        city string,
        name string,
        province struct<name: string>,
        street string,
        zipcode string,
        type string,
        theater_locations array<struct<id: int, name: string>>""",
    "sales": """
        id int,
        name string,
        updated string,
        tickets int,
        recette int,
        performances array<struct<number: int, date: string, updated: string, tickets: int, recette: int>>,
        _production_id string""",
}

# Fixed value: sales are followed for this many days after the performance.
SALES_DAYS = 14


def productions(df: DataFrame) -> DataFrame:
    return project(df, {"Id": "id", "Titel": "title", "StartDatum": "startDate", "Seizoen": "season"})


def performances(df: DataFrame) -> DataFrame:
    return project(
        df,
        {
            "ProductieId": "production.id",
            "TheaterLocatieId": "theater_location.id",
            "Id": "id",
            "VoorstellingNummer": "number",
            "StartTijdVoorstelling": parse_timestamp("date"),
            "Status": "status",
            "Type": "type",
            "IsUitkoopZonderVerkoop": "private",
            "IsInFestival": "in_festival",
            **{f"AantalRang{rank:02d}": f"amount_rank{rank}" for rank in RANKS},
        },
    )


def theaters(df: DataFrame) -> DataFrame:
    return project(
        df,
        {
            "Id": "id",
            "Plaats": "city",
            "Naam": "name",
            "Provincie": "province.name",
            "Straat": "street",
            "Postcode": "zipcode",
            "Type": "type",
        },
    )


def theater_locations(df: DataFrame) -> DataFrame:
    return explode_children(
        df,
        {"location": "theater_locations"},
        {"TheaterId": "id", "Id": "location.id", "Naam": "location.name"},
    )


def sales(
    df: DataFrame, *, as_of: Column | str | dt.date | None = None, added_at: Column | None = None
) -> DataFrame:
    """A daily snapshot of sales per performance, for performances still followed."""
    lines = explode_children(
        df,
        {"performance": "performances"},
        {
            "VoorstellingId": "performance.number",
            "SnapshotDatum": as_of_date(as_of),
            "Recette": cents_to_decimal("performance.recette"),
            "Tickets": "performance.tickets",
            "Updated": parse_timestamp("performance.updated"),
        },
        where=is_recent(parse_timestamp("performance.date"), SALES_DAYS, as_of),
    )
    return lines.withColumn("Toegevoegd", F.current_timestamp() if added_at is None else added_at)


ENTITIES = {
    "productions": Entity(productions),
    "performances": Entity(performances),
    "theaters": Entity(theaters),
    "theater_locations": Entity(theater_locations, payload="theaters"),
    "sales": Entity(sales),
}
