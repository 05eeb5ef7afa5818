"""The entity pipelines on small payloads with the oddities real ones have."""

import datetime as dt
import json
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from refinery.plans import registry
from tests.frames import rows

WIDTHS = {
    "taxi": {},
    "hubspot": {"feedback_submissions": 16},
    "dyflexis": {"employee": 7, "employee_contract": 10, "department_tree": 9, "registered_hours": 16},
    "renh": {
        "departments": 5, "maingroups": 7, "subgroups": 16, "turnover_types": 12, "shops": 16, "cash_registers": 12,
        "day_turnover": 13, "day_turnover_lines": 23,
    },
    "ticketcounter": {
        "baskets": 13, "ticket_scans": 46, "sold_tickets": 65, "sold_subscriptions": 44, "cancellations": 11,
    },
    "dip": {"productions": 4, "performances": 19, "theaters": 7, "theater_locations": 3, "sales": 6},
    "tomm": {"booking": 18, "person": 19, "guest": 4, "booking_rule": 17, "item_rule": 10},
    "eijsink": {
        "orders": 10, "sales_items": 25, "payment_items": 14, "salespoints": 7, "stores": 4, "turnover_groups": 6,
    },
}


def payload(spark, name, *records, **context):
    """Records in the declared layout of an entity, with the columns ingestion adds."""
    schema = registry.schema_for(name)
    text = spark.createDataFrame([(json.dumps(record),) for record in records], "text string")
    df = text.select(F.from_json("text", schema).alias("r")).select("r.*")
    return df.withColumns({column: F.lit(value).cast("string") for column, value in context.items()})


def refined(spark, name, *records, refine=None, **context):
    frame = registry.refine(payload(spark, name, *records, **context), name, **(refine or {}))
    return [row.asDict() for row in frame.collect()]


def test_registry_is_complete():
    assert len(registry.ENTITIES) == 51
    sources = [name.split(".")[0] for name in registry.ENTITIES]
    counts = {source: sources.count(source) for source in registry.SOURCES}
    assert counts == {
        "dip": 5, "dyflexis": 4, "eijsink": 6, "hubspot": 1, "renh": 20, "taxi": 5, "ticketcounter": 5, "tomm": 5,
    }
    assert registry.payload_of("tomm.guest") == "tomm.booking"
    with pytest.raises(KeyError):
        registry.schema_for("taxi.taxi_trip_fact")


def test_widths_and_unique_columns(spark):
    for source, tables in WIDTHS.items():
        for name, width in tables.items():
            df = spark.createDataFrame([], registry.schema_for(f"{source}.{name}"))
            context = {"renh": "VestigingId", "eijsink": "VestigingId", "ticketcounter": "Resort"}.get(source)
            df = df.withColumn(context, F.lit("v")) if context else df
            columns = registry.refine(df, f"{source}.{name}").columns
            assert len(columns) == width, name
            assert len({column.lower() for column in columns}) == width, name


def test_contacts_are_declared_though_not_refined(spark):
    assert "email" in registry.schema_for("hubspot.contacts")["properties"].dataType.names
    assert "hubspot.contacts" not in registry.ENTITIES


def test_user_pipelines_can_be_registered(spark):
    registry.register("own.orders", lambda df, factor=1: df.select((F.col("id") * factor).alias("Id")))
    try:
        assert rows(registry.refine(spark.range(2), "own.orders", factor=3)) == {(0,): 1, (3,): 1}
    finally:
        del registry.ENTITIES["own.orders"]


def test_feedback_reports_on_sane_visits_only(spark):
    def answer(**properties):
        base = {"hs_survey_id": "9", "hs_value": "8", "hs_response_group": "PASSIVE"}
        return {"id": "x", "properties": {**base, "hs_submission_timestamp": "2021-05-05T23:00:00-04:00", **properties}}

    def day(**properties):
        (row,) = refined(spark, "hubspot.feedback_submissions", answer(**properties), refine={"as_of": "2021-06-01"})
        return row

    assert day(sv_abm_visitdate="2021-04-01")["Datum"] == dt.date(2021, 4, 1)
    assert day(sv_abm_visitdate="soon", sv_ap_dtt_visitedate="2021-04-02")["Datum"] == dt.date(2021, 4, 2)
    typo = day(sv_abm_visitdate="2926-04-01", sv_ap_dtt_visitedate="2021-04-02")
    assert (typo["Datum"], typo["BezoekDatum"]) == (dt.date(2021, 5, 6), dt.date(2926, 4, 1))
    assert day(sv_abm_visitdate="1925-04-01")["Datum"] == dt.date(2021, 5, 6)
    assert day(sv_abm_visitdate="2021-06-02")["Datum"] == dt.date(2021, 6, 2)
    assert day(sv_abm_visitdate="2021-06-03")["Datum"] == dt.date(2021, 5, 6)
    known, unknown = day(), day(hs_survey_id="77", hs_survey_name="Elsewhere")
    assert (known["Locatie"], known["LocatieType"]) == ("Avonturenboerderij Molenwaard", "park")
    assert (unknown["Locatie"], unknown["LocatieType"], unknown["SurveyId"]) == ("Elsewhere", "onbekend", 77)
    for out in ({"hs_survey_id": None}, {"hs_value": None}, {"hs_response_group": "CSAT"}):
        assert refined(spark, "hubspot.feedback_submissions", answer(**out)) == []


def test_employee_names_and_repeated_contracts(spark):
    contract = {"contractReference": "c", "officeId": 1, "start": "2020-01-01", "end": "2020-13-01"}
    names = {"firstName": "", "lastNamePrefix": None, "lastName": ""}
    person = {"employeeId": 1, **names, "contracts": [contract, contract]}
    (employee,) = refined(spark, "dyflexis.employee", person)
    assert employee["Naam"] == ""
    (only,) = refined(spark, "dyflexis.employee_contract", person, {"employeeId": 2, "contracts": None})
    assert (only["Id"], only["StartDatum"], only["EindDatum"]) == ("c", dt.date(2020, 1, 1), None)


def test_worked_day_is_the_written_day(spark):
    (hours,) = refined(
        spark, "dyflexis.registered_hours", {"id": 1, "startDateTime": "2024-03-01T23:30:00-05:00", "endDateTime": "?"}
    )
    assert hours["Datum"] == dt.date(2024, 3, 1)
    assert hours["EindTijdstip"] is None


def test_office_and_department_may_share_an_id(spark):
    tree = {
        "id": 1,
        "name": "office",
        "departments": [{"id": 1, "name": "dept"}],
        "departmentGroups": [
            {"id": 2, "name": "g", "departments": [{"id": 3, "name": "d"}],
             "departmentGroups": [{"id": 4, "name": "gg", "departments": [{"id": 5, "name": "dd"}]}]},
            {"id": None, "departments": [{"id": 6, "name": "orphan"}]},
        ],
    }
    found = refined(spark, "dyflexis.department_tree", tree, tree)
    assert sorted((row["Id"], row["Naam"], row["ParentId"]) for row in found if row["ParentId"]) == [
        ("1", "dept", "1"), ("2", "g", "1"), ("3", "d", "2"), ("4", "gg", "2"), ("5", "dd", "4"),
    ]
    assert sorted(row["Naam"] for row in found if not row["ParentId"]) == ["office", "orphan"]


def test_keys_without_branch_are_null(spark):
    group = {"TblHoofdgroepnr": 3, "Omschrijving": "x"}
    assert refined(spark, "renh.maingroups", group, VestigingId="n")[0]["Id"] == "n_3"
    assert refined(spark, "renh.maingroups", group, VestigingId=None)[0]["Id"] is None
    assert refined(spark, "renh.maingroups", {}, VestigingId="n")[0]["Id"] is None


def test_pass_through_puts_the_key_first(spark):
    df = spark.createDataFrame([(7, "n", "x")], "TblArtikelnr int, VestigingId string, Naam string")
    articles = registry.refine(df, "renh.articles")
    assert articles.columns == ["Id", "VestigingId", "Naam"]
    assert articles.first() == ("n_7", "n", "x")
    codes = spark.createDataFrame([("NL", "n")], "LandCodeISO2 string, VestigingId string")
    assert rows(registry.refine(codes, "renh.country_codes")) == {("NL", "n"): 1}


def test_equal_receipt_lines_become_one(spark):
    line = {"plu": 1, "text": "t", "price": 2.5, "count": 1, "verkoopwaarde": 2.5, "gewicht": None}
    receipt = {"Transaction": {"branch": 1, "register": 2, "billno": "b", "time": "2024-01-02T10:00:00"}}
    receipt["Transaction"]["Ordered"] = [line, line, {**line, "price": 3.0}]
    found = refined(spark, "renh.day_turnover_lines", receipt, {"Transaction": {"Ordered": None}}, VestigingId="n")
    assert sorted((row["Prijs"], row["Aantal"], row["Verkoopwaarde"], row["Gewicht"]) for row in found) == [
        (2.5, 2, 5.0, None), (3.0, 1, 2.5, None),
    ]
    assert {row["FK_DagOmzetTransacties_Id"] for row in found} == {"n_1_2_b"}


def test_last_cancellation_wins(spark):
    def cancel(key, date, price):
        return {"ReservationKey": key, "ValidFrom": "2024-01-01", "CancelDate": date, "Price": price}

    records = [
        cancel("a", "2024-02-01T00:00:00", 1.0), cancel("a", "2024-03-01T00:00:00", 2.0), cancel("a", None, 3.0),
        cancel("b", "2024-02-01T00:00:00", 5.0), cancel("b", "2024-02-01T00:00:00", 4.0),
        cancel(None, "2024-02-01T00:00:00", 6.0), cancel(None, "2024-03-01T00:00:00", 7.0),
    ]
    latest = refined(spark, "ticketcounter.cancellations", *records, Resort="r")
    assert {(row["Id"], row["Prijs"]) for row in latest} == {
        ("r_a_2024-01-01", 2.0), ("r_b_2024-01-01", 4.0), (None, 7.0),
    }
    kept = refined(spark, "ticketcounter.cancellations", *records, Resort="r", refine={"null_keys": "keep"})
    assert len(kept) == 4


def test_sales_are_followed_for_a_fortnight(spark):
    def show(number, date, recette=1000):
        return {"number": number, "date": date, "recette": recette, "tickets": 3, "updated": "2024-01-15T08:00:00"}

    record = {
        "id": 1,
        "performances": [
            show(1, "2024-01-01T00:00:00"), show(2, "2024-01-01T00:00:01"), show(3, "2030-01-01"), show(4, "?"),
            show(5, "2024-01-10", 100_000_000), None,
        ],
    }
    sales = refined(spark, "dip.sales", record, {"id": 2, "performances": None}, refine={"as_of": "2024-01-15"})
    ten = Decimal("10.00")
    assert {row["VoorstellingId"]: row["Recette"] for row in sales} == {2: ten, 3: ten, 5: None}
    assert {row["SnapshotDatum"] for row in sales} == {dt.date(2024, 1, 15)}
    assert all(row["Toegevoegd"] for row in sales)


def test_bookings_of_one_id_share_the_plate_flag(spark):
    records = [
        {"id": "a", "number": "DTT-1", "license_plates": ["x"], "arrival": "2024-13-01"},
        {"id": "a", "number": "XYZ-1", "license_plates": []},
        {"id": None, "license_plates": ["x"]},
        {"id": "b", "license_plates": None},
    ]
    found = refined(spark, "tomm.booking", *records)
    assert sorted((str(row["Id"]), row["Resort"], row["KentekenGeregistreerd"]) for row in found) == [
        ("None", "FRM", False), ("a", "DTT", True), ("a", "FRM", True), ("b", "FRM", False),
    ]
    quick = refined(spark, "tomm.booking", *records, refine={"unique_ids": True})
    assert [row["KentekenGeregistreerd"] for row in quick].count(True) == 1


def test_person_and_guests(spark):
    record = {"id": "a", "person": None, "guests": [{"id": "g", "birthday": "31 june"}, {"id": None}, None]}
    (person,) = refined(spark, "tomm.person", record)
    assert {name for name, value in person.items() if value is not None} == {"FK_Boeking_Id"}
    (guest,) = refined(spark, "tomm.guest", record)
    assert guest == {"Id": "g", "Geboortedatum": None, "Geslacht": None, "FK_Boeking_Id": "a"}


def test_age_buckets_of_rules(spark):
    ages = [{"from": 0, "persons": 1}, {"from": 2, "persons": 5}, {"from": 2, "persons": 3}, {"from": 40, "persons": 9}]
    rule = {"id": "r", "arrival_time": "15:00:00.000", "age_categories": ages}
    record = {"id": "a", "booking_rules": [rule, {"id": "s", "age_categories": None}, {**rule, "id": None}]}
    found = refined(spark, "tomm.booking_rule", record, {**record, "id": None, "booking_rules": [rule]})
    columns = ("Id", "FK_Boeking_Id", "AantalLeeftijd0tot2", "AantalLeeftijd2tot13", "AantalLeeftijd21plus")
    assert {tuple(row[column] for column in columns) for row in found} == {
        ("r", "a", 1, 5, None),
        ("s", "a", None, None, None),
        (None, "a", None, None, None),
        ("r", None, None, None, None),
    }
    assert found[0]["Aankomsttijd"] == "15:00:00"


def test_items_without_groups(spark):
    record = {
        "id": "o",
        "createdAt": "2024-07-01T23:30:00Z",
        "workDay": "2024-07-02",
        "salesPoint": {"id": "p"},
        "salesItems": [
            {"id": "1", "turnoverGroups": [], "productGroups": ["x"], "createdAt": "2024-01-01T12:00:00Z"},
            {"id": "2", "turnoverGroups": ["t", "u"], "productGroups": None},
        ],
        "paymentItems": [{"id": "p", "payment": {"method": {"id": "m"}}}, {"id": "q", "payment": None}],
    }
    (order,) = refined(spark, "eijsink.orders", record, VestigingId="n")
    assert (order["Id"], order["FK_Verkooppunten_Id"], order["FK_Locaties_Id"]) == ("n_o", "n_p", None)
    assert (order["AangemaaktOp"], order["Datum"]) == (dt.datetime(2024, 7, 2, 1, 30), dt.date(2024, 7, 2))
    first, second = sorted(refined(spark, "eijsink.sales_items", record, VestigingId="n"), key=lambda row: row["Id"])
    assert (first["FK_Omzetgroepen_Id"], first["ProductGroep1"], first["ProductGroep2"]) == (None, "x", None)
    assert (second["FK_Omzetgroepen_Id"], second["ProductGroep1"]) == ("n_t", None)
    assert first["AangemaaktOp"] == dt.datetime(2024, 1, 1, 13)
    payments = refined(spark, "eijsink.payment_items", record, VestigingId="n")
    assert {row["Id"]: row["BetalingsmethodeId"] for row in payments} == {"n_p": "m", "n_q": None}


def test_sales_points_to_full_depth(spark):
    deep = {"id": "5", "name": "e", "salesPoints": "text"}
    for number in ("4", "3", "2"):
        deep = {"id": number, "name": "x", "salesPoints": [deep]}
    record = {"_store_id": "s", "id": "1", "salesPoints": [deep, {"id": None, "salesPoints": [{"id": "lost"}]}]}
    found = refined(spark, "eijsink.salespoints", record, record, VestigingId="n")
    assert sorted((row["Id"], row["Type"], row["ParentVerkooppuntId"]) for row in found) == [
        ("n_1", "Level1", None), ("n_2", "Level2", "n_1"), ("n_3", "Level3", "n_2"), ("n_4", "Level4", "n_3"),
        ("n_5", "Level5", "n_4"),
    ]


def test_turnover_group_with_missing_parent_is_its_own(spark):
    groups = [
        {"id": "a", "name": "Drinks"}, {"id": "b", "name": "Beer", "parentID": "a"},
        {"id": "c", "name": "Lost", "parentID": "gone"}, {"id": "c", "name": "Lost", "parentID": "gone"},
    ]
    found = refined(spark, "eijsink.turnover_groups", *groups, VestigingId="n")
    assert sorted((row["Id"], row["ParentId"], row["HoofdOmzetgroep"]) for row in found) == [
        ("n_a", None, "Drinks"), ("n_b", "n_a", "Drinks"), ("n_c", None, "Lost"),
    ]


def test_one_payload_many_tables(spark, tmp_path):
    record = {"id": "a", "number": "DTT", "guests": [{"id": "g"}], "item_rules": [{"id": "i", "amount": 2.0}]}
    df = payload(spark, "tomm.booking", record, tenant="t")
    names = ["tomm.booking", "tomm.guest", "tomm.item_rule"]
    lazy = registry.refine_all(df, names, context={"tomm.booking": {"unique_ids": True}})
    landed = registry.refine_all(df, names, landing=str(tmp_path / "landed"), keep=["tenant"])
    assert {name: rows(frame) for name, frame in lazy.items()} == {name: rows(frame) for name, frame in landed.items()}
    assert "tenant" in spark.read.parquet(str(tmp_path / "landed")).columns
    with pytest.raises(ValueError, match="different payloads"):
        registry.refine_all(df, ["tomm.booking", "eijsink.orders"])
