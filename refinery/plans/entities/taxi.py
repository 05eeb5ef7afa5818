"""Trip records from a relational source, which brings its own schema."""

from __future__ import annotations

from pyspark.sql import DataFrame

from refinery.functions import parse_date
from refinery.operators import project
from refinery.plans.entities.entity import Entity

SCHEMAS: dict[str, str] = {}

# Refined column -> source column.
LOAD_COLUMNS = {"LaadBatchId": "load_batch_id", "LaadUtc": "load_utc"}
TRIP_COLUMNS = {
    "RitId": "trip_id",
    "RitDatum": "trip_date",
    "LeverancierId": "vendor_id",
    "OphaalMoment": "pickup_datetime",
    "AfzetMoment": "dropoff_datetime",
    "AantalPassagiers": "passenger_count",
    "RitAfstand": "trip_distance",
    "TariefCode": "ratecodeid",
    "OpslagVlag": "store_and_fwd_flag",
    "OphaalLocatieId": "pulocationid",
    "AfzetLocatieId": "dolocationid",
    "Betaalwijze": "payment_type",
    "RitBedrag": "fare_amount",
    "Toeslag": "extra",
    "MtaBelasting": "mta_tax",
    "Fooi": "tip_amount",
    "TolBedrag": "tolls_amount",
    "VerbeteringsToeslag": "improvement_surcharge",
    "TotaalBedrag": "total_amount",
    "FileToeslag": "congestion_surcharge",
    "LuchthavenToeslag": "airport_fee",
    "CbdFileToeslag": "cbd_congestion_fee",
    **LOAD_COLUMNS,
}
HIGH_VOLUME_COLUMNS = {
    "LicentieNummer": "hvfhs_license_num",
    "BasisNummer": "dispatching_base_num",
    "HerkomstBasisNummer": "originating_base_num",
    "AanvraagMoment": "request_datetime",
    "TerPlaatsteMoment": "on_scene_datetime",
    "OphaalMoment": "pickup_datetime",
    "AfzetMoment": "dropoff_datetime",
    "OphaalLocatieId": "pulocationid",
    "AfzetLocatieId": "dolocationid",
    "RitMijlen": "trip_miles",
    "RitTijdSeconden": "trip_time",
    "BasisRitBedrag": "base_passenger_fare",
    "TolBedrag": "tolls",
    "ZwartAutoFonds": "bcf",
    "Omzetbelasting": "sales_tax",
    "FileToeslag": "congestion_surcharge",
    "LuchthavenToeslag": "airport_fee",
    "Fooi": "tips",
    "ChauffeursLoon": "driver_pay",
    "GedeeldVerzoek": "shared_request_flag",
    "GedeeldMatch": "shared_match_flag",
    "ToegangsRit": "access_a_ride_flag",
    "RolstoelVerzoek": "wav_request_flag",
    "RolstoelMatch": "wav_match_flag",
    "CbdFileToeslag": "cbd_congestion_fee",
    **LOAD_COLUMNS,
}
FOR_HIRE_COLUMNS = {
    "BasisNummer": "dispatching_base_num",
    "OphaalMoment": "pickup_datetime",
    "AfzetMoment": "dropoff_datetime",
    "OphaalLocatieId": "pulocationid",
    "AfzetLocatieId": "dolocationid",
    "GedeeldRit": "sr_flag",
    "GelieerdeBasisNummer": "affiliated_base_number",
    **LOAD_COLUMNS,
}
ZONE_COLUMNS = {
    "LocatieId": "location_id",
    "Stadsdeel": "borough",
    "Zone": "zone",
    "ServiceZone": "service_zone",
    "LaadUtc": "load_utc",
}
BATCH_COLUMNS = {
    "LaadBatchId": "load_batch_id",
    "BronNaam": "source_name",
    "BronPad": "source_path",
    "LaadStartUtc": "load_started_utc",
    "LaadEindeUtc": "load_finished_utc",
    "AantalRijen": "rows_loaded",
    "LaadStatus": "load_status",
    "Notities": "notes",
}


def trips(df: DataFrame) -> DataFrame:
    return project(df, TRIP_COLUMNS)


def high_volume_trips(df: DataFrame) -> DataFrame:
    day = parse_date("pickup_datetime")
    return project(df, {"HvfhvRitId": "hvfhv_trip_id", "OphaalDatum": day, **HIGH_VOLUME_COLUMNS})


def for_hire_trips(df: DataFrame) -> DataFrame:
    day = parse_date("pickup_datetime")
    return project(df, {"FhvRitId": "fhv_trip_id", "OphaalDatum": day, **FOR_HIRE_COLUMNS})


def zones(df: DataFrame) -> DataFrame:
    return project(df, ZONE_COLUMNS)


def load_batches(df: DataFrame) -> DataFrame:
    """The audit of loads: one row per batch, with its rows and outcome."""
    return project(df, BATCH_COLUMNS)


ENTITIES = {
    "taxi_trip_fact": Entity(trips),
    "hvfhv_trip_fact": Entity(high_volume_trips),
    "fhv_trip_fact": Entity(for_hire_trips),
    "taxi_zone_lookup": Entity(zones),
    "taxi_load_batch": Entity(load_batches),
}
