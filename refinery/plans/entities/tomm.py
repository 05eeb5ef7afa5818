"""Stays: bookings with the person, guests, accommodation rules and items they hold."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from refinery.functions import parse_date, prefix_class, time_of_day
from refinery.operators import bucket_columns, explode_children, has_children, project, rollup_lines
from refinery.plans.entities.entity import Entity

# The record layout.
PERSON = """struct<
    id: string, first_name: string, last_name: string, last_name_prefix: string, email: string,
    phone_number: string, cell_phone_number: string, birthday: string, gender: string, street: string,
    house_number: string, house_number_prefix: string, zip_code: string, city: string, country: string,
    language: string, newsletter: boolean, organisation: string>"""
AGE_CATEGORIES = "array<struct<from: int, till: int, persons: int>>"
BOOKING_RULES = f"""array<struct<
    id: string, accommodation_id: string, accommodation: string, accommodation_group_id: string,
    accommodation_group: string, location: string, arrangement: string, arrival_time: string,
    departure_time: string, total: int, cost_of_stay: double, cost_of_discount: double,
    age_categories: {AGE_CATEGORIES}>>"""
ITEM_RULES = """array<struct<
    id: string, name: string, accommodation_id: string, location_id: string, from: string, till: string,
    amount: double, price: double, price_excluding_vat: double, vat_percentage: double>>"""
SCHEMAS = {
    "booking": f"""
        id string,
        number string,
        arrival string,
        departure string,
        status string,
        date string,
        arrived boolean,
        departed boolean,
        stay_days int,
        total double,
        cost_of_stay double,
        cost_of_items double,
        cost_of_discount double,
        cost_of_stay_excluding_vat double,
        cost_of_stay_vat_percentage double,
        sales_channel string,
        license_plates array<string>,
        person {PERSON},
        guests array<struct<id: string, birthday: string, gender: string>>,
        booking_rules {BOOKING_RULES},
        item_rules {ITEM_RULES}"""
}

# Booking numbers start with the resort, of which the first is the default; age
# buckets are named by their lower bound.
RESORTS = ("FRM", "DTT")
AGE_BUCKETS = {
    0: "AantalLeeftijd0tot2",
    2: "AantalLeeftijd2tot13",
    13: "AantalLeeftijd13tot21",
    21: "AantalLeeftijd21plus",
}

# Refined column -> source field.
RULE_COLUMNS = {
    "Id": "rule.id",
    "AccommodatieId": "rule.accommodation_id",
    "Accommodatie": "rule.accommodation",
    "AccommodatiegroepId": "rule.accommodation_group_id",
    "AccommodatieGroep": "rule.accommodation_group",
    "Locatie": "rule.location",
    "Arrangement": "rule.arrangement",
}
ITEM_KEYS = {
    "Id": "item.id",
    "Artikelnaam": "item.name",
    "AccommodatieId": "item.accommodation_id",
    "LocatieId": "item.location_id",
    "GeldigVan": "item.from",
    "GeldigTot": "item.till",
    "FK_Boeking_Id": "id",
}
ITEM_SUMS = {"Aantal": "item.amount", "BedragInclBtw": "item.price", "BedragExBtw": "item.price_excluding_vat"}


def bookings(df: DataFrame, *, unique_ids: bool = False) -> DataFrame:
    """Bookings, with a flag for those that registered a licence plate.

    An id may come more than once, as when a booking is fetched again; its rows share the
    flag. ``unique_ids`` promises that none does, which saves the join.
    """
    flagged = has_children(
        df, "id", "license_plates", "KentekenGeregistreerd", unique_key=unique_ids
    )
    return project(
        flagged,
        {
            "Id": "id",
            "Boekingnummer": "number",
            "Resort": prefix_class("number", 3, RESORTS, default=RESORTS[0]),
            "Aankomst": parse_date("arrival"),
            "Vertrek": parse_date("departure"),
            "Status": "status",
            "Boekingdatum": parse_date("date"),
            "Ingecheckt": "arrived",
            "Uitgecheckt": "departed",
            "Verblijfdagen": "stay_days",
            "Totalekosten": "total",
            "Verblijfkosten": "cost_of_stay",
            "Artikelkosten": "cost_of_items",
            "Kortingkosten": "cost_of_discount",
            "VerblijfkostenExclusiefBtw": "cost_of_stay_excluding_vat",
            "VerblijfkostenBtwPercentage": "cost_of_stay_vat_percentage",
            "Verkoopkanaal": "sales_channel",
            "KentekenGeregistreerd": "KentekenGeregistreerd",
        },
    )


def persons(df: DataFrame) -> DataFrame:
    """The person of each booking; a booking without one keeps its row, all but the key NULL."""
    return project(
        df,
        {
            "Id": "person.id",
            "Voornaam": "person.first_name",
            "Achternaam": "person.last_name",
            "AchternaamVoorvoegsel": "person.last_name_prefix",
            "Email": "person.email",
            "Telefoonnummer": "person.phone_number",
            "Mobielnummer": "person.cell_phone_number",
            "Geboortedatum": parse_date("person.birthday"),
            "Geslacht": "person.gender",
            "Straat": "person.street",
            "Huisnummer": "person.house_number",
            "HuisnummerToevoeging": "person.house_number_prefix",
            "Postcode": "person.zip_code",
            "Plaats": "person.city",
            "Land": "person.country",
            "Taal": "person.language",
            "Nieuwsbrief": "person.newsletter",
            "Organisatie": "person.organisation",
            "FK_Boeking_Id": "id",
        },
    )


def guests(df: DataFrame) -> DataFrame:
    return explode_children(
        df,
        {"guest": "guests"},
        {
            "Id": "guest.id",
            "Geboortedatum": parse_date("guest.birthday"),
            "Geslacht": "guest.gender",
            "FK_Boeking_Id": "id",
        },
        require=["guest.id"],
    )


def booking_rules(df: DataFrame) -> DataFrame:
    """Accommodation rules with the persons per age bucket side by side.

    A rule is one row. Should a bucket occur twice in a rule, its highest count stands. The
    buckets of a rule without id, or of a booking without id, are unknown.
    """
    ages = bucket_columns(
        "rule.age_categories",
        "from",
        "persons",
        AGE_BUCKETS,
        when=F.col("rule.id").isNotNull() & F.col("id").isNotNull(),
    )
    return explode_children(
        df,
        {"rule": "booking_rules"},
        {
            **RULE_COLUMNS,
            "Aankomsttijd": time_of_day("rule.arrival_time"),
            "Vertrektijd": time_of_day("rule.departure_time"),
            "TotaalPersonen": "rule.total",
            "Verblijfkosten": "rule.cost_of_stay",
            "Kortingkosten": "rule.cost_of_discount",
            **ages,
            "FK_Boeking_Id": "id",
        },
    )


def item_rules(df: DataFrame) -> DataFrame:
    return rollup_lines(df, ITEM_KEYS, ITEM_SUMS, arrays={"item": "item_rules"})


ENTITIES = {
    "booking": Entity(bookings, rowwise=False),
    "person": Entity(persons, payload="booking"),
    "guest": Entity(guests, payload="booking"),
    "booking_rule": Entity(
        booking_rules,
        payload="booking",
        reads=(
            "id",
            "booking_rules.id",
            "booking_rules.accommodation_id",
            "booking_rules.accommodation",
            "booking_rules.accommodation_group_id",
            "booking_rules.accommodation_group",
            "booking_rules.location",
            "booking_rules.arrangement",
            "booking_rules.arrival_time",
            "booking_rules.departure_time",
            "booking_rules.total",
            "booking_rules.cost_of_stay",
            "booking_rules.cost_of_discount",
            "booking_rules.age_categories.from",
            "booking_rules.age_categories.persons",
        ),
    ),
    "item_rule": Entity(
        item_rules,
        payload="booking",
        rowwise=False,
        reads=(
            "id",
            "item_rules.id",
            "item_rules.name",
            "item_rules.accommodation_id",
            "item_rules.location_id",
            "item_rules.from",
            "item_rules.till",
            "item_rules.amount",
            "item_rules.price",
            "item_rules.price_excluding_vat",
        ),
    ),
}
