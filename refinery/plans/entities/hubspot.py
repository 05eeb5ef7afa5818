"""Survey answers. Every value inside ``properties`` arrives as text."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from refinery.functions import (
    as_of_date,
    instant_date,
    lookup,
    parse_date,
    parse_int,
    parse_timestamp,
    preferred_date,
)
from refinery.operators import project, require
from refinery.plans.entities.entity import Entity

# The record layouts.
SUBMISSION_PROPERTIES = """struct<
    hs_object_id: string,
    hs_survey_type: string,
    hs_survey_id: string,
    hs_survey_name: string,
    hs_survey_channel: string,
    hs_industry_standard_question_type: string,
    hs_value: string,
    hs_response_group: string,
    hs_submission_timestamp: string,
    hs_contact_id: string,
    hs_content: string,
    hs_createdate: string,
    hs_lastmodifieddate: string,
    sv_abm_visitdate: string,
    sv_ap_dtt_visitedate: string,
    sv_fr_dtt_booking_arrival: string,
    sv_fr_dtt_booking_departure: string,
    sv_frm_booking_arrival: string,
    sv_frm_booking_departure: string>"""
CONTACT_PROPERTIES = """struct<
    hs_object_id: string,
    email: string,
    firstname: string,
    lastname: string,
    lifecyclestage: string,
    hubspot_owner_id: string,
    createdate: string,
    lastmodifieddate: string,
    hs_feedback_last_nps_rating_number: string,
    hs_feedback_last_survey_date: string>"""
SCHEMAS = {
    "feedback_submissions": f"""
        id string,
        properties {SUBMISSION_PROPERTIES},
        createdAt string,
        updatedAt string,
        archived boolean,
        url string""",
    "contacts": f"""
        id string,
        properties {CONTACT_PROPERTIES},
        createdAt string,
        updatedAt string,
        archived boolean""",
}

# The scored groups, the first sane visit date, and where each survey is held.
SCORED_GROUPS = ("PROMOTER", "PASSIVE", "DETRACTOR")
FIRST_SANE_DATE = "2020-01-01"
LOCATIONS = {
    "9": ("Avonturenboerderij Molenwaard", "park"),
    "28": ("Avonturenpark De Tovertuin", "park"),
    "10": ("Familie Resort Molenwaard", "resort"),
    "29": ("Familie Resort De Tovertuin", "resort"),
}
UNKNOWN_TYPE = "onbekend"


def feedback_submissions(
    df: DataFrame,
    *,
    as_of: Column | str | dt.date | None = None,
    locations: Mapping[str, tuple[str, str]] = LOCATIONS,
) -> DataFrame:
    """Scored survey answers.

    ``Datum`` is the day the answer is reported on: the visit, unless its date is missing or
    out of the sane range (people mistype it), else the submission. Both days are kept too.
    """
    scored = require(df, "properties.hs_survey_id", "properties.hs_value").filter(
        F.col("properties.hs_response_group").isin(*SCORED_GROUPS)
    )
    survey = F.col("properties.hs_survey_id")
    names = {number: name for number, (name, _) in locations.items()}
    types = {number: kind for number, (_, kind) in locations.items()}
    visits = [parse_date("properties.sv_abm_visitdate"), parse_date("properties.sv_ap_dtt_visitedate")]
    submitted = "properties.hs_submission_timestamp"
    first, last = F.lit(FIRST_SANE_DATE).cast("date"), F.date_add(as_of_date(as_of), 1)
    return project(
        scored,
        {
            "Id": "id",
            "SurveyId": parse_int(survey),
            "SurveyNaam": "properties.hs_survey_name",
            "Locatie": lookup(survey, names, default=F.col("properties.hs_survey_name")),
            "LocatieType": lookup(survey, types, default=UNKNOWN_TYPE),
            "Score": parse_int("properties.hs_value"),
            "Groep": "properties.hs_response_group",
            "Datum": preferred_date(visits, instant_date(submitted), first, last),
            "BezoekDatum": F.coalesce(*visits),
            "InzendDatum": instant_date(submitted),
            "InzendTijdstip": parse_timestamp(submitted),
            "FrDttAankomst": parse_date("properties.sv_fr_dtt_booking_arrival"),
            "FrmAankomst": parse_date("properties.sv_frm_booking_arrival"),
            "ContactId": "properties.hs_contact_id",
            "Toelichting": "properties.hs_content",
            "GewijzigdOp": parse_timestamp("properties.hs_lastmodifieddate"),
        },
    )


ENTITIES = {"feedback_submissions": Entity(feedback_submissions)}
