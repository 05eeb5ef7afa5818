"""The entities of nested payloads."""

from __future__ import annotations

from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from refinery.operators import union_all
from refinery.plans import registry
from refinery.plans.entities.dip import RANK_FIELDS
from refinery.plans.queries.payloads import (
    CUSTOMERS,
    ORDERS,
    Children,
    FlatPayload,
    branch,
    flat,
    simple_fields,
    struct,
)
from refinery.plans.queries.query import Catalog, Run, table
from refinery.plans.registry import SCHEMAS
from refinery.session import work_folder
from refinery.sources import read_entity

CATALOG = Catalog()


def add(entity: str, payload: Run, oracle: str, **context: Any) -> None:
    def refine(df: DataFrame) -> DataFrame:
        return registry.refine(df, entity, **context)

    CATALOG.add_entity(entity.replace(".", "_"), payload, refine, oracle)


def wrapped(payload: FlatPayload, *columns: str) -> Run:
    """The flat payload, its columns put into structs by the given expressions."""
    return lambda spark, folder: payload.frame(spark, folder).selectExpr(*columns)


def from_table(name: str, *columns: str) -> Run:
    return lambda spark, folder: table(spark, folder, name).selectExpr(*columns)


# --- hubspot --------------------------------------------------------------------------------

VISIT = "cast(date '2019-06-01' + cast(o_orderkey % 900 as int) as string)"
ANSWERS = flat(
    ORDERS,
    """id string, hs_survey_name string, hs_contact_id string, hs_content string,
       sv_fr_dtt_booking_arrival string, sv_frm_booking_arrival string, hs_lastmodifieddate string""",
    days=("sv_fr_dtt_booking_arrival", "sv_frm_booking_arrival"),
    moments=("hs_lastmodifieddate",),
    hs_survey_id="""case o_orderkey % 6 when 0 then '9' when 1 then '28' when 2 then '10' when 3 then '29'
                                        when 4 then '77' else null end""",
    hs_value="""case o_orderkey % 5 when 0 then null when 1 then '8.0' when 2 then 'ten'
                                    else cast(o_orderkey % 11 as string) end""",
    hs_response_group="""case o_orderkey % 7 when 0 then 'CSAT' when 1 then 'PASSIVE' when 2 then 'DETRACTOR'
                                             else 'PROMOTER' end""",
    sv_abm_visitdate=f"""case o_orderkey % 11 when 0 then '1925-04-01' when 1 then '2926-04-01' when 2 then 'monday'
                                              when 3 then null else {VISIT} end""",
    sv_ap_dtt_visitedate="case when o_orderkey % 2 = 0 then '2020-07-07' end",
    hs_submission_timestamp="cast(cast(o_orderdate as date) as string) || 'T22:30:00-04:00'",
)
add(
    "hubspot.feedback_submissions",
    wrapped(ANSWERS, "id", f"struct({', '.join(name for name in ANSWERS.fields if name != 'id')}) as properties"),
    ANSWERS.oracle("""
       , dated AS (
         SELECT *, coalesce(try_cast(sv_abm_visitdate AS DATE), try_cast(sv_ap_dtt_visitedate AS DATE)) AS visit,
                CAST(substr(hs_submission_timestamp, 1, 19) AS TIMESTAMP) + INTERVAL 4 HOUR AS submitted
         FROM payload
         WHERE hs_survey_id IS NOT NULL AND hs_value IS NOT NULL
           AND hs_response_group IN ('PROMOTER', 'PASSIVE', 'DETRACTOR'))
       SELECT id AS Id, CAST(hs_survey_id AS INTEGER) AS SurveyId, hs_survey_name AS SurveyNaam,
              CASE hs_survey_id WHEN '9' THEN 'Avonturenboerderij Molenwaard'
                                WHEN '28' THEN 'Avonturenpark De Tovertuin'
                                WHEN '10' THEN 'Familie Resort Molenwaard'
                                WHEN '29' THEN 'Familie Resort De Tovertuin' ELSE hs_survey_name END AS Locatie,
              CASE WHEN hs_survey_id IN ('9', '28') THEN 'park' WHEN hs_survey_id IN ('10', '29') THEN 'resort'
                   ELSE 'onbekend' END AS LocatieType,
              CAST(trunc(try_cast(hs_value AS DOUBLE)) AS INTEGER) AS Score, hs_response_group AS Groep,
              CASE WHEN visit BETWEEN DATE '2020-01-01' AND DATE '2021-06-02' THEN visit
                   ELSE CAST(submitted AS DATE) END AS Datum,
              visit AS BezoekDatum, CAST(submitted AS DATE) AS InzendDatum, submitted AS InzendTijdstip,
              try_cast(sv_fr_dtt_booking_arrival AS DATE) AS FrDttAankomst,
              try_cast(sv_frm_booking_arrival AS DATE) AS FrmAankomst, hs_contact_id AS ContactId,
              hs_content AS Toelichting, try_cast(hs_lastmodifieddate AS TIMESTAMP) AS GewijzigdOp
       FROM dated"""),
    as_of="2021-06-01",
)

# --- dip ------------------------------------------------------------------------------------

PERFORMANCES = flat(
    ORDERS,
    f"""id int, number int, date string, status string, type string, private boolean, in_festival boolean,
        {RANK_FIELDS}, production_id string, location_id int""",
    moments=("date",),
)
add(
    "dip.performances",
    wrapped(
        PERFORMANCES,
        "*",
        "case when number % 4 > 0 then struct(production_id as id) end as production",
        "struct(location_id as id) as theater_location",
    ),
    PERFORMANCES.oracle(
        """SELECT CASE WHEN number % 4 > 0 THEN production_id END AS ProductieId, location_id AS TheaterLocatieId,
                  id AS Id, number AS VoorstellingNummer, try_cast(date AS TIMESTAMP) AS StartTijdVoorstelling,
                  status AS Status, type AS Type, private AS IsUitkoopZonderVerkoop, in_festival AS IsInFestival,
                  amount_rank1 AS AantalRang01, amount_rank2 AS AantalRang02, amount_rank3 AS AantalRang03,
                  amount_rank4 AS AantalRang04, amount_rank5 AS AantalRang05, amount_rank6 AS AantalRang06,
                  amount_rank7 AS AantalRang07, amount_rank8 AS AantalRang08, amount_rank9 AS AantalRang09,
                  amount_rank10 AS AantalRang10
           FROM payload"""
    ),
)

THEATERS = flat(
    CUSTOMERS, "id int, city string, name string, street string, zipcode string, type string, province_name string"
)
add(
    "dip.theaters",
    wrapped(THEATERS, "*", "struct(province_name as name) as province"),
    THEATERS.oracle(
        """SELECT id AS Id, city AS Plaats, name AS Naam, province_name AS Provincie, street AS Straat,
                  zipcode AS Postcode, type AS Type
           FROM payload"""
    ),
)

HALLS = Children(
    {"id": "case when i = 2 then null else cast(c_custkey * 10 + i as int) end", "name": "c_name || '/' || i"},
    count="c_custkey % 4",
    missing="c_custkey % 7 = 0",
)
add(
    "dip.theater_locations",
    from_table("customer", "cast(c_custkey as int) as id", f"{HALLS.array()} as theater_locations"),
    f"""SELECT CAST(c_custkey AS INTEGER) AS TheaterId, id AS Id, name AS Naam
        FROM ({HALLS.rows("customer", "c_custkey")})""",
)

# Performances around the day of the run: exactly fourteen days before, a second later, in the
# future, unreadable; some takings do not fit the target type.
SHOW = "cast(o_orderdate as date)"
SHOWS = Children(
    {
        "number": "cast(o_orderkey % 1000 * 10 + i as int)",
        "date": f"""case when i = 3 and o_orderkey % 5 = 0 then 'unknown'
                         else cast({SHOW} + cast(i as int) as string) || 'T00:00:0' || cast(o_orderkey % 2 as string)
                    end""",
        "updated": f"cast({SHOW} as string) || 'T10:00:00'",
        "tickets": "cast(o_custkey % 300 as int)",
        "recette": "case when o_orderkey % 13 = 0 then 2000000000 else cast(o_orderkey * 7 + i as int) end",
    },
    count="o_orderkey % 4",
    missing="o_orderkey % 9 = 0",
)
# The moment of loading is given, so that the result is fixed.
SALES_ORACLE = f"""
    SELECT number AS VoorstellingId, DATE '1998-06-01' AS SnapshotDatum,
           CASE WHEN recette < 100000000 THEN recette / 100 END AS Recette, tickets AS Tickets,
           try_cast(updated AS TIMESTAMP) AS Updated, TIMESTAMP '1998-06-01 06:30:00' AS Toegevoegd
    FROM ({SHOWS.rows("orders", "o_orderkey")})
    WHERE try_cast(date AS TIMESTAMP) > TIMESTAMP '1998-05-18 00:00:00'"""


@CATALOG.add("dip_sales", SALES_ORACLE)
def _(spark: SparkSession, folder: str) -> DataFrame:
    payload = from_table("orders", "cast(o_orderkey as int) as id", f"{SHOWS.array()} as performances")
    added = F.lit("1998-06-01 06:30:00").cast("timestamp")
    return registry.refine(payload(spark, folder), "dip.sales", as_of="1998-06-01", added_at=added)


# --- dyflexis -------------------------------------------------------------------------------

# Two customers deliver the same employee, so every contract comes twice.
CONTRACTS = Children(
    {
        "contractReference": "'C' || cast(c_custkey // 2 as string) || '-' || cast(i as string)",
        "officeId": "cast(c_custkey // 2 % 20 as int)",
        "type": "cast(i as int)",
        "start": """case when (c_custkey // 2 + i) % 6 = 0 then '2020-14-01'
                         else cast(date '2020-01-01' + cast(c_custkey // 2 % 300 as int) as string) end""",
        "end": "case when i > 1 then '2024-12-31' end",
        "hoursPerWeek": "cast(8 * i as double)",
        "daysPerWeek": "cast(i as double)",
        "hourlySalary": "cast(10 + c_custkey // 2 % 7 as double)",
        "maxHoursPerWeek": "cast(null as double)",
    },
    count="c_custkey // 2 % 4",
    missing="c_custkey // 2 % 9 = 0",
)
add(
    "dyflexis.employee_contract",
    from_table(
        "customer",
        "cast(c_custkey div 2 as int) as employeeId",
        f"{CONTRACTS.array().replace('//', 'div')} as contracts",
    ),
    f"""SELECT DISTINCT contractReference AS Id, CAST(k AS INTEGER) AS FK_Medewerker_Id, officeId AS VestigingId,
               type AS ContractType, try_cast("start" AS DATE) AS StartDatum, try_cast("end" AS DATE) AS EindDatum,
               hoursPerWeek AS UrenPerWeek, daysPerWeek AS DagenPerWeek, hourlySalary AS Uurloon,
               maxHoursPerWeek AS MaxUrenPerWeek
        FROM ({CONTRACTS.rows("customer", "c_custkey // 2 AS k")})""",
)


def department(id_: str, label: str, **more: str) -> str:
    """A node of the department tree, in Spark SQL; ``k`` is the office."""
    return struct(
        {
            "id": f"cast(({id_}) as int)",
            "name": f"'{label} ' || cast(({id_}) as string)",
            "type": f"'{label}'",
            "created": "'2020-01-01'",
            "modified": "cast(null as string)",
            "costCenterId": f"cast(({id_}) % 100 as int)",
            "costCenterName": "'center ' || cast(k % 10 as string)",
            "active": f"({id_}) % 2 = 0",
            **more,
        }
    )


def upto(most: int, count: str) -> str:
    return f"slice(sequence(1, {most}), 1, cast({count} as int))"


LEAVES_0 = f"case when k % 3 > 0 then transform({upto(2, 'k % 3')}, i -> {department('k + i', 'dept')}) end"
LEAVES_1 = f"transform({upto(2, '(k + a) % 3')}, i -> {department('k % 50', 'shared')})"
LEAVES_2 = f"transform({upto(2, 'b')}, i -> {department('k * 1000 + a * 100 + b * 10 + i', 'dept')})"
GROUPS_2 = f"""transform({upto(2, 'k % 3')}, b -> {
    department("case when b = 2 and k % 4 = 0 then null else k * 100 + a * 10 + b end", "group2",
               departmentGroups="cast(null as array<string>)", departments=LEAVES_2)})"""  # fmt: skip
GROUPS_1 = f"""case when k % 5 > 0 then transform({upto(2, 'k % 4')}, a -> {
    department("case when a = 2 and k % 7 = 0 then null else k * 10 + a end", "group1",
               departmentGroups=GROUPS_2, departments=LEAVES_1)}) end"""  # fmt: skip


def department_payload(spark: SparkSession, folder: str) -> DataFrame:
    """Offices from customers; every second one is delivered twice."""
    offices = table(spark, folder, "customer").selectExpr("c_custkey - c_custkey % 4 div 3 as k")
    return offices.selectExpr(
        f"inline(array({department('k', 'office', departmentGroups=GROUPS_1, departments=LEAVES_0)}))"
    )


def department_row(id_: str, label: str, parent: str) -> str:
    return f"""SELECT CAST({id_} AS VARCHAR) AS Id, '{label} ' || CAST({id_} AS VARCHAR) AS Naam, '{label}' AS Type,
                      '2020-01-01' AS AangemaaktOp, CAST(NULL AS VARCHAR) AS GewijzigdOp,
                      CAST({id_} % 100 AS INTEGER) AS KostenplaatsId,
                      'center ' || CAST(k % 10 AS VARCHAR) AS KostenplaatsNaam, {id_} % 2 = 0 AS Actief,
                      CAST({parent} AS VARCHAR) AS ParentId"""


add(
    "dyflexis.department_tree",
    department_payload,
    f"""WITH offices AS (SELECT c_custkey - c_custkey % 4 // 3 AS k FROM customer),
        g1 AS (
          SELECT k, a, CASE WHEN NOT (a = 2 AND k % 7 = 0) THEN k * 10 + a END AS gid
          FROM offices, unnest([1, 2]) AS t(a) WHERE k % 5 > 0 AND a <= k % 4),
        g2 AS (
          SELECT k, a, b, gid AS up, CASE WHEN NOT (b = 2 AND k % 4 = 0) THEN k * 100 + a * 10 + b END AS gid
          FROM g1, unnest([1, 2]) AS t(b) WHERE b <= k % 3)
        {department_row("k", "office", "NULL")} FROM offices
        UNION
        {department_row("(k + i)", "dept", "k")} FROM offices, unnest([1, 2]) AS t(i) WHERE i <= k % 3
        UNION
        {department_row("gid", "group1", "k")} FROM g1 WHERE gid IS NOT NULL
        UNION
        {department_row("(k % 50)", "shared", "gid")} FROM g1, unnest([1, 2]) AS t(i) WHERE i <= (k + a) % 3
        UNION
        {department_row("gid", "group2", "up")} FROM g2 WHERE gid IS NOT NULL
        UNION
        {department_row("(k * 1000 + a * 100 + b * 10 + i)", "dept", "gid")}
        FROM g2, unnest([1, 2]) AS t(i) WHERE i <= b""",
)

# --- eijsink --------------------------------------------------------------------------------

TILL_ORDERS = flat(
    ORDERS,
    "id string, orderNr string, receiptNr string, storeId string, workDay string, occupiedSeatsNumber int, spId string",
    days=("workDay",),
    VestigingId=branch(ORDERS),
    createdAt="cast(cast(o_orderdate as date) as string) || 'T23:30:00Z'",
    lastUpdatedAt="""case when o_orderkey % 6 = 0 then 'unknown'
                          else cast(cast(o_orderdate as date) as string) || 'T06:00:00Z' end""",
)
LOCAL = "AT TIME ZONE 'UTC' AT TIME ZONE 'Europe/Amsterdam'"
add(
    "eijsink.orders",
    wrapped(TILL_ORDERS, "*", "struct(spId as id, 'x' as name) as salesPoint"),
    TILL_ORDERS.oracle(
        f"""SELECT VestigingId || '_' || id AS Id, VestigingId || '_' || storeId AS FK_Locaties_Id,
                   VestigingId || '_' || spId AS FK_Verkooppunten_Id, VestigingId, orderNr AS OrderNummer,
                   receiptNr AS BonNummer, try_cast(workDay AS DATE) AS Datum,
                   occupiedSeatsNumber AS AantalStoelenBezet,
                   try_cast(substr(createdAt, 1, 19) AS TIMESTAMP) {LOCAL} AS AangemaaktOp,
                   try_cast(substr(lastUpdatedAt, 1, 19) AS TIMESTAMP) {LOCAL} AS LaatsteWijziging
            FROM payload"""
    ),
)

DAY = "cast(cast(o_orderdate as date) as string)"
ORDER_KEYS = (f"{branch(ORDERS)} as VestigingId", "'O' || cast(o_orderkey as string) as id")
ORDER_ROW = f"{branch(ORDERS)} AS VestigingId, 'O' || o_orderkey AS order_id"
AMOUNT = {"inclVAT": "o_totalprice + i", "exclVAT": "o_totalprice - i", "VAT": "cast(2 * i as double)"}
SOLD = Children(
    {
        "salesItemType": "'sale'",
        "id": "'S' || cast(o_orderkey as string) || '-' || cast(i as string)",
        "course": {"name": "o_orderpriority"},
        "user": {"id": "'u'", "name": "'user ' || cast(o_custkey % 9 as string)"},
        "createdAt": f"{DAY} || 'T01:00:00Z'",
        "workDay": f"case when (o_orderkey + i) % 8 = 0 then 'unknown' else {DAY} end",
        "product": {"id": "cast(i as string)", "name": "'product ' || cast(i as string)"},
        "itemCount": "cast(i as double)",
        "price": {
            "value": "o_totalprice + i",
            "currency": "'EUR'",
            "includeVAT": "o_orderkey % 2 = 0",
            "VAT": {"id": "'high'", "name": "'high'", "percentage": "cast(21 as double)", "code": "'h'"},
        },
        "netAmount": AMOUNT,
        "grossAmount": {name: f"{value} + 1" for name, value in AMOUNT.items()},
        "userShiftId": "'shift ' || cast(o_orderkey % 3 as string)",
    },
    count="o_orderkey % 4",
    missing="o_orderkey % 11 = 0",
)
# Arrays of text inside the child, for Spark only: one product group for odd children, two for
# even ones.
SOLD_LISTS = {
    "productGroups": "case when i % 2 = 0 then array('food', 'cold') else array('drinks') end",
    "turnoverGroups": "case when i = 3 then array() else array('T' || cast(o_orderkey % 5 as string), 'T9') end",
}
add(
    "eijsink.sales_items",
    from_table("orders", *ORDER_KEYS, f"{SOLD.array(SOLD_LISTS)} as salesItems"),
    f"""SELECT VestigingId || '_' || id AS Id, VestigingId || '_' || order_id AS FK_Orders_Id,
               VestigingId || '_' || CASE WHEN n < 3 THEN 'T' || CAST(k % 5 AS VARCHAR) END AS FK_Omzetgroepen_Id,
               salesItemType AS SalesType, "course.name" AS ItemType, "user.name" AS Gebruiker,
               CAST(substr(createdAt, 1, 19) AS TIMESTAMP) {LOCAL} AS AangemaaktOp,
               try_cast(workDay AS DATE) AS Datum, "product.id" AS ProductId, "product.name" AS ProductNaam,
               userShiftId AS GebruikersSessieId, itemCount AS Aantal, "price.value" AS Prijs,
               "price.currency" AS Valuta, "price.includeVAT" AS PrijsInclBTW, "price.VAT.id" AS BTWTariefId,
               "price.VAT.percentage" AS BTWPercentage, "netAmount.inclVAT" AS NettoBedragInclBTW,
               "netAmount.exclVAT" AS NettoBedragExclBTW, "netAmount.VAT" AS NettoBedragBTW,
               "grossAmount.inclVAT" AS BrutoBedragInclBTW, "grossAmount.exclVAT" AS BrutoBedragExclBTW,
               "grossAmount.VAT" AS BrutoBedragBTW, CASE WHEN n % 2 = 0 THEN 'food' ELSE 'drinks' END AS ProductGroep1,
               CASE WHEN n % 2 = 0 THEN 'cold' END AS ProductGroep2
        FROM ({SOLD.rows("orders", f"{ORDER_ROW}, o_orderkey AS k, i AS n")})""",
)

PAID = Children(
    {
        "id": "'P' || cast(o_orderkey as string) || '-' || cast(i as string)",
        "user": {"id": "'u'", "name": "'user ' || cast(o_custkey % 9 as string)"},
        "currency": {"code": "'EUR'", "rate": "cast(1 as double)"},
        "createdAt": f"{DAY} || 'T22:45:00Z'",
        "workDay": DAY,
        "amount": "o_totalprice + i",
        "shiftId": "'shift ' || cast(o_orderkey % 3 as string)",
        "payment": {
            "externalId": "case when o_orderkey % 3 > 0 then cast(o_orderkey as string) end",
            "amount": "o_totalprice - i",
            "method": {"id": "cast(i as string)", "name": "'method ' || cast(i as string)"},
            "methodType": {"id": "'t'", "name": "'card'"},
        },
    },
    count="o_orderkey % 3",
    missing="o_orderkey % 7 = 0",
)
add(
    "eijsink.payment_items",
    from_table("orders", *ORDER_KEYS, f"{PAID.array()} as paymentItems"),
    f"""SELECT VestigingId || '_' || id AS Id, VestigingId || '_' || order_id AS FK_Orders_Id,
               "user.name" AS Gebruiker, CAST(substr(createdAt, 1, 19) AS TIMESTAMP) {LOCAL} AS AangemaaktOp,
               CAST(workDay AS DATE) AS Datum, amount AS Bedrag, "currency.code" AS ValutaCode,
               "currency.rate" AS ValutaKoers, shiftId AS GebruikerSessieId, "payment.externalId" AS ExternId,
               "payment.amount" AS BetalingBedrag, "payment.method.id" AS BetalingsmethodeId,
               "payment.method.name" AS BetalingsmethodeNaam,
               "payment.methodType.name" AS BetalingsmethodeTypeNaam
        FROM ({PAID.rows("orders", ORDER_ROW)})""",
)

# Sales points: a chain of numbers names each point; two customers deliver the same tree. A
# second point of level 2 has no id in some trees, and what hangs below it goes too.
POINT_COUNTS = ("k % 3", "(k + a) % 3", "(k + b) % 3", "k % 2 + 1")
POINT_PATHS = ("'P' || cast(k as string)", *[f"cast({name} as string)" for name in "abcd"])


def point_array(level: int) -> str:
    """The points below ``level``, in Spark SQL."""
    name, path = "abcd"[level], " || '.' || ".join(POINT_PATHS[: level + 2])
    id_ = f"case when a = 2 and k % 5 = 0 then null else {path} end" if level == 0 else path
    inner = "cast(null as string)" if level == 3 else point_array(level + 1)
    point = struct({"id": id_, "name": f"'point ' || {path}", "salesPoints": inner})
    return f"transform({upto(2, POINT_COUNTS[level])}, {name} -> {point})"


def point_payload(spark: SparkSession, folder: str) -> DataFrame:
    stores = table(spark, folder, "customer").selectExpr("c_custkey div 2 as k")
    return stores.selectExpr(
        "'V' || cast(k % 7 as string) as VestigingId",
        "'S' || cast(k % 3 as string) as _store_id",
        f"{POINT_PATHS[0]} as id",
        "'root' as name",
        f"case when k % 11 > 0 then {point_array(0)} end as salesPoints",
    )


def point_row(level: int, path: str, parent: str, name: str) -> str:
    return f"""SELECT 'V' || CAST(k % 7 AS VARCHAR) || '_' || {path} AS Id, 'Level{level}' AS Type,
                      'V' || CAST(k % 7 AS VARCHAR) AS VestigingId, 'S' || CAST(k % 3 AS VARCHAR) AS LocatieId,
                      {path} AS VerkooppuntId, {name} AS Naam,
                      'V' || CAST(k % 7 AS VARCHAR) || '_' || {parent} AS ParentVerkooppuntId"""


add(
    "eijsink.salespoints",
    point_payload,
    f"""WITH p1 AS (SELECT DISTINCT c_custkey // 2 AS k, 'P' || (c_custkey // 2) AS p FROM customer),
        p2 AS (SELECT k, a, p AS up, p || '.' || a AS p FROM p1, unnest([1, 2]) AS t(a)
               WHERE k % 11 > 0 AND a <= k % 3 AND NOT (a = 2 AND k % 5 = 0)),
        p3 AS (SELECT k, a, b, p AS up, p || '.' || b AS p FROM p2, unnest([1, 2]) AS t(b) WHERE b <= (k + a) % 3),
        p4 AS (SELECT k, b, c, p AS up, p || '.' || c AS p FROM p3, unnest([1, 2]) AS t(c) WHERE c <= (k + b) % 3),
        p5 AS (SELECT k, p AS up, p || '.' || d AS p FROM p4, unnest([1, 2]) AS t(d) WHERE d <= k % 2 + 1)
        {point_row(1, "p", "NULL", "'root'")} FROM p1
        UNION {point_row(2, "p", "up", "'point ' || p")} FROM p2
        UNION {point_row(3, "p", "up", "'point ' || p")} FROM p3
        UNION {point_row(4, "p", "up", "'point ' || p")} FROM p4
        UNION {point_row(5, "p", "up", "'point ' || p")} FROM p5""",
)

# --- renh -----------------------------------------------------------------------------------

RECEIPTS = flat(
    ORDERS,
    """branch int, register int, billno string, cashier int, custno int, custname string, time string, total double,
       VATNumber string, DoNotChargeVAT boolean""",
    moments=("time",),
    VestigingId=branch(ORDERS),
)
add(
    "renh.day_turnover",
    wrapped(
        RECEIPTS,
        "VestigingId",
        f"struct({', '.join(name for name in RECEIPTS.fields if name != 'VestigingId')}) as Transaction",
    ),
    RECEIPTS.oracle(
        """SELECT VestigingId || '_' || CAST(branch AS VARCHAR) || '_' || CAST(register AS VARCHAR) || '_' || billno
                    AS Id,
                  VestigingId || '_' || CAST(branch AS VARCHAR) AS FK_Winkels_Id,
                  VestigingId || '_' || CAST(branch AS VARCHAR) || '_' || CAST(register AS VARCHAR) AS FK_Kassas_Id,
                  VestigingId, billno AS BonNummer, cashier AS Kassamedewerker, custno AS KlantNummer,
                  custname AS KlantNaam, try_cast(time AS TIMESTAMP) AS Tijd, try_cast(time AS DATE) AS Datum,
                  total AS TotaalBedrag, VATNumber AS BTWNummer, DoNotChargeVAT AS ZonderBTW
           FROM payload"""
    ),
)

# Lines 1 and 3 of a receipt agree in all but their amounts.
ORDERED = Children(
    {
        "count": "cast(i as int)",
        "gewicht": "case when i > 1 then cast(i as double) end",
        "plu": "o_custkey * 2 + i % 2",
        "price": "o_totalprice",
        "brutoverkoopwaarde": "o_totalprice + i",
        "korting": "cast(0 as double)",
        "verkoopwaarde": "o_totalprice + 2 * i",
        "inkoopwaarde": "o_totalprice - i",
        "scancode": "cast(null as string)",
        "subgroep": "case when o_orderkey % 6 > 0 then cast(o_orderkey % 20 as int) end",
        "tax": "cast(i % 2 as int)",
        "taxperc": "cast(9 + 12 * (i % 2) as int)",
        "hoofdgroep": "cast(o_orderkey % 5 as int)",
        "afdeling": "cast(1 as int)",
        "omzetsoort": "cast(2 as int)",
        "gewichtartikel": "i % 2 = 0",
        "text": "'article ' || cast(i % 2 as string)",
        "actieomzet": "o_orderstatus",
    },
    count="o_orderkey % 4",
    missing="o_orderkey % 10 = 0",
)
LINE_SUM = 'CAST(sum(CAST("{}" AS DECIMAL(28, 6))) AS DOUBLE)'
add(
    "renh.day_turnover_lines",
    from_table(
        "orders",
        f"{branch(ORDERS)} as VestigingId",
        f"""named_struct('branch', cast(o_orderkey % 3 as int), 'register', 1,
              'billno', cast(o_orderkey div 2 as string), 'time', {DAY} || 'T11:22:33',
              'Ordered', {ORDERED.array()}) as Transaction""",
    ),
    f"""SELECT v || '_' || CAST(k % 3 AS VARCHAR) || '_1_' || CAST(k // 2 AS VARCHAR) AS FK_DagOmzetTransacties_Id,
               v AS VestigingId, day AS Datum, plu AS PLU, "text" AS Omschrijving,
               gewichtartikel AS GewichtArtikel, price AS Prijs, korting AS Korting, scancode AS Scancode,
               v || '_' || CAST(subgroep AS VARCHAR) AS FK_Subgroepen_Id, subgroep AS SubgroepNr,
               v || '_' || CAST(hoofdgroep AS VARCHAR) AS FK_Hoofdgroepen_Id, hoofdgroep AS HoofdgroepNr,
               afdeling AS AfdelingNr, omzetsoort AS OmzetSoortNr, tax AS BTWCode, taxperc AS BTWPercentage,
               actieomzet AS ActieOmzet, CAST(sum("count") AS BIGINT) AS Aantal,
               {LINE_SUM.format("gewicht")} AS Gewicht, {LINE_SUM.format("brutoverkoopwaarde")} AS BrutoVerkoopwaarde,
               {LINE_SUM.format("verkoopwaarde")} AS Verkoopwaarde, {LINE_SUM.format("inkoopwaarde")} AS Inkoopwaarde
        FROM ({ORDERED.rows("orders", f"{branch(ORDERS)} AS v, o_orderkey AS k, CAST(o_orderdate AS DATE) AS day")})
        GROUP BY ALL""",
)

# --- tomm -----------------------------------------------------------------------------------

# Two orders make one booking id, so that bookings come twice; some have no id.
BOOKING_ID = "case when o_orderkey % 97 < 2 then null else 'B' || cast(o_orderkey - o_orderkey % 2 as string) end"
BOOKINGS = flat(
    ORDERS,
    SCHEMAS["tomm.booking"],
    days=("departure", "date"),
    moments=("arrival",),
    id=BOOKING_ID,
    number="""case o_orderkey % 4 when 0 then 'FRM-' when 1 then 'DTT-' when 2 then 'XYZ-' end
              || cast(o_orderkey as string)""",
    plates="o_orderkey % 5",
)
PLATES = """case plates when 0 then array('NL-1', 'BE-2') when 1 then array(cast(null as string))
                       when 2 then cast(array() as array<string>) end as license_plates"""
add(
    "tomm.booking",
    wrapped(BOOKINGS, "*", PLATES),
    BOOKINGS.oracle("""
       , plated AS (SELECT DISTINCT id AS plated_id FROM payload WHERE plates < 2)
       SELECT id AS Id, number AS Boekingnummer,
              CASE WHEN number LIKE 'DTT%' THEN 'DTT' ELSE 'FRM' END AS Resort,
              try_cast(arrival AS DATE) AS Aankomst, try_cast(departure AS DATE) AS Vertrek, status AS Status,
              try_cast(date AS DATE) AS Boekingdatum, arrived AS Ingecheckt, departed AS Uitgecheckt,
              stay_days AS Verblijfdagen, total AS Totalekosten, cost_of_stay AS Verblijfkosten,
              cost_of_items AS Artikelkosten, cost_of_discount AS Kortingkosten,
              cost_of_stay_excluding_vat AS VerblijfkostenExclusiefBtw,
              cost_of_stay_vat_percentage AS VerblijfkostenBtwPercentage, sales_channel AS Verkoopkanaal,
              plated_id IS NOT NULL AS KentekenGeregistreerd
       FROM payload LEFT JOIN plated ON id = plated_id"""),
)

PERSON_DDL = """first_name string, last_name string, last_name_prefix string, email string, phone_number string,
    cell_phone_number string, birthday string, gender string, street string, house_number string,
    house_number_prefix string, zip_code string, city string, country string, language string,
    newsletter boolean, organisation string"""
PERSONS = flat(ORDERS, PERSON_DDL, days=("birthday",), person_id="cast(o_custkey as string)", id=BOOKING_ID)
add(
    "tomm.person",
    wrapped(
        PERSONS,
        "id",
        f"""case when cast(person_id as int) % 10 > 0 then
              struct(person_id as id, {', '.join(simple_fields(PERSON_DDL))}) end as person""",
    ),
    PERSONS.oracle("""
       SELECT CASE WHEN known THEN person_id END AS Id, CASE WHEN known THEN first_name END AS Voornaam,
              CASE WHEN known THEN last_name END AS Achternaam,
              CASE WHEN known THEN last_name_prefix END AS AchternaamVoorvoegsel,
              CASE WHEN known THEN email END AS Email, CASE WHEN known THEN phone_number END AS Telefoonnummer,
              CASE WHEN known THEN cell_phone_number END AS Mobielnummer,
              CASE WHEN known THEN try_cast(birthday AS DATE) END AS Geboortedatum,
              CASE WHEN known THEN gender END AS Geslacht, CASE WHEN known THEN street END AS Straat,
              CASE WHEN known THEN house_number END AS Huisnummer,
              CASE WHEN known THEN house_number_prefix END AS HuisnummerToevoeging,
              CASE WHEN known THEN zip_code END AS Postcode, CASE WHEN known THEN city END AS Plaats,
              CASE WHEN known THEN country END AS Land, CASE WHEN known THEN language END AS Taal,
              CASE WHEN known THEN newsletter END AS Nieuwsbrief,
              CASE WHEN known THEN organisation END AS Organisatie, id AS FK_Boeking_Id
       FROM (SELECT *, CAST(person_id AS BIGINT) % 10 > 0 AS known FROM payload)"""),
)

GUESTS = Children(
    {
        "id": """case when i = 2 and o_orderkey % 5 = 0 then null
                      else 'G' || cast(o_orderkey as string) || '-' || cast(i as string) end""",
        "birthday": f"case when i = 3 then '31 june' else {DAY} end",
        "gender": "case when i % 2 = 0 then 'F' else 'M' end",
    },
    count="o_orderkey % 4",
    missing="o_orderkey % 7 = 0",
)
RULES = Children(
    {
        "id": """case when i = 1 and o_orderkey % 17 = 0 then null
                      else 'R' || cast(o_orderkey as string) || '-' || cast(i as string) end""",
        "accommodation_id": "cast(o_custkey as string)",
        "accommodation": "'cottage ' || cast(o_custkey % 40 as string)",
        "accommodation_group_id": "cast(o_custkey % 8 as string)",
        "accommodation_group": "'group ' || cast(o_custkey % 8 as string)",
        "location": "o_orderpriority",
        "arrangement": "o_orderstatus",
        "arrival_time": "'15:00:00.000'",
        "departure_time": "case when i < 3 then '10:30:00+02' end",
        "total": "cast(o_orderkey % 6 + i as int)",
        "cost_of_stay": "o_totalprice + i",
        "cost_of_discount": "o_totalprice - i",
    },
    count="o_orderkey % 4",
    missing="o_orderkey % 13 = 0",
)
# Ages: bucket 0 always, 2 twice in some rules, 13 at times without a count, 21 in every other
# rule, 65 unknown to the pivot; some rules have no ages.
AGES = {
    "age_categories": """case when (o_orderkey + i) % 6 > 0 then filter(array(
      named_struct('from', 0, 'till', 2, 'persons', i),
      named_struct('from', 2, 'till', 13, 'persons', cast(o_orderkey % 3 as int)),
      case when o_orderkey % 8 = 1 then named_struct('from', 2, 'till', 13, 'persons', cast(o_orderkey % 5 as int)) end,
      named_struct('from', 13, 'till', 21, 'persons', case when i = 2 then null else 4 end),
      case when o_orderkey % 2 = 0 then named_struct('from', 21, 'till', 99, 'persons', i + 7) end,
      named_struct('from', 65, 'till', 99, 'persons', 1)), age -> age is not null or o_orderkey % 4 = 1) end"""
}
BOOKING_KEYS = f"{BOOKING_ID} as id"
add(
    "tomm.guest",
    from_table("orders", BOOKING_KEYS, f"{GUESTS.array()} as guests"),
    f"""SELECT id AS Id, try_cast(birthday AS DATE) AS Geboortedatum, gender AS Geslacht,
               booking_id AS FK_Boeking_Id
        FROM ({GUESTS.rows("orders", f"{BOOKING_ID} AS booking_id")}) WHERE id IS NOT NULL""",
)
add(
    "tomm.booking_rule",
    from_table("orders", BOOKING_KEYS, f"{RULES.array(AGES)} as booking_rules"),
    f"""SELECT id AS Id, accommodation_id AS AccommodatieId, accommodation AS Accommodatie,
               accommodation_group_id AS AccommodatiegroepId, accommodation_group AS AccommodatieGroep,
               location AS Locatie, arrangement AS Arrangement, substr(arrival_time, 1, 8) AS Aankomsttijd,
               substr(departure_time, 1, 8) AS Vertrektijd, total AS TotaalPersonen, cost_of_stay AS Verblijfkosten,
               cost_of_discount AS Kortingkosten,
               CASE WHEN aged THEN CAST(n AS INTEGER) END AS AantalLeeftijd0tot2,
               CASE WHEN aged THEN CAST(greatest(k % 3, CASE WHEN k % 8 = 1 THEN k % 5 END) AS INTEGER) END
                 AS AantalLeeftijd2tot13,
               CASE WHEN aged AND n <> 2 THEN 4 END AS AantalLeeftijd13tot21,
               CASE WHEN aged AND k % 2 = 0 THEN CAST(n + 7 AS INTEGER) END AS AantalLeeftijd21plus,
               booking_id AS FK_Boeking_Id
        FROM (SELECT *, (k + n) % 6 > 0 AND id IS NOT NULL AND booking_id IS NOT NULL AS aged
              FROM ({RULES.rows("orders", f"{BOOKING_ID} AS booking_id, o_orderkey AS k, i AS n")}))""",
)

ITEMS = Children(
    {
        "id": "'I' || cast(i % 2 as string)",
        "name": "'item ' || cast(i % 2 as string)",
        "accommodation_id": "case when o_orderkey % 3 > 0 then cast(o_custkey as string) end",
        "location_id": "o_orderstatus",
        "from": DAY,
        "till": "cast(null as string)",
        "amount": "cast(i as double)",
        "price": "case when i < 4 then o_totalprice + i end",
        "price_excluding_vat": "o_totalprice - i",
    },
    count="o_orderkey % 5",
    most=4,
    missing="o_orderkey % 6 = 0",
)
ITEM_ORACLE = f"""
    SELECT id AS Id, name AS Artikelnaam, accommodation_id AS AccommodatieId, location_id AS LocatieId,
           "from" AS GeldigVan, till AS GeldigTot, booking_id AS FK_Boeking_Id, {LINE_SUM.format("amount")} AS Aantal,
           {LINE_SUM.format("price")} AS BedragInclBtw, {LINE_SUM.format("price_excluding_vat")} AS BedragExBtw
    FROM ({ITEMS.rows("orders", f"{BOOKING_ID} AS booking_id")}) GROUP BY ALL"""
add("tomm.item_rule", from_table("orders", BOOKING_KEYS, f"{ITEMS.array()} as item_rules"), ITEM_ORACLE)


# Of each table, what tells its rows apart: its own id, a text and a number.
TOMM = {
    "booking": ("Id", "Id", "Status", "Totalekosten"),
    "person": ("FK_Boeking_Id", "Id", "Achternaam", None),
    "guest": ("FK_Boeking_Id", "Id", "Geslacht", None),
    "booking_rule": ("FK_Boeking_Id", "Id", "Accommodatie", "Verblijfkosten"),
    "item_rule": ("FK_Boeking_Id", "Id", "Artikelnaam", "BedragInclBtw"),
}


@CATALOG.add(
    "refine_all_landed",
    " UNION ALL ".join(
        f"""SELECT '{name}' AS entity, {booking} AS booking, {own} AS id, {label} AS label, CAST({amount or 'NULL'} AS DOUBLE) AS amount
            FROM ({CATALOG.queries[f"tomm_{name}"].oracle})"""
        for name, (booking, own, label, amount) in TOMM.items()
    ),
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    """One payload, fitted to its schema and landed once, refined into all of its five tables."""
    own = {f"o_{field}": value for field, value in PERSONS.fields.items()}
    person = ", ".join(f"`o_{field}` as {field}" for field in simple_fields(PERSON_DDL))
    payload = (
        table(spark, folder, "orders")
        .selectExpr(
            *[f"{value} as {name}" for name, value in BOOKINGS.fields.items()],
            *[f"{value} as {name}" for name, value in own.items()],
            f"{GUESTS.array()} as guests",
            f"{RULES.array(AGES)} as booking_rules",
            f"{ITEMS.array()} as item_rules",
        )
        .selectExpr(
            "*", PLATES, f"case when cast(o_person_id as int) % 10 > 0 then struct(o_person_id as id, {person}) end as person"
        )
        .drop(*own)
    )
    landing = work_folder(spark, "bookings")
    refined = registry.refine_all(payload, [f"tomm.{name}" for name in TOMM], landing=landing)
    rows = [
        refined[f"tomm.{name}"].selectExpr(
            f"'{name}' as entity", f"{booking} as booking", f"{key} as id", f"{label} as label", f"cast({amount or 'null'} as double) as amount"
        )
        for name, (booking, key, label, amount) in TOMM.items()
    ]
    return union_all(*rows)


# --- from text records ----------------------------------------------------------------------


def from_records(entity: str) -> None:
    """The entity from its payload written as JSON lines and read by the declared schema, as sources send it."""
    known = CATALOG.queries[entity.replace(".", "_")]

    def run(spark: SparkSession, folder: str) -> DataFrame:
        payload = known.payload(spark, folder)
        path = work_folder(spark, "records")
        payload.write.option("ignoreNullFields", "true").json(path)
        declared = registry.schema_for(entity, narrow=True)
        names = {name.lower() for name in registry.schema_for(entity).fieldNames()}
        added = [field for field in payload.schema.fields if field.name.lower() not in names]
        return registry.refine(read_entity(spark, path, T.StructType([*declared.fields, *added])), entity)

    CATALOG.add(f"json_{entity.replace('.', '_')}", known.oracle)(run)


for _entity in (
    "dyflexis.employee_contract",
    "dyflexis.department_tree",
    "tomm.booking_rule",
    "tomm.item_rule",
    "eijsink.sales_items",
    "eijsink.salespoints",
):
    from_records(_entity)
