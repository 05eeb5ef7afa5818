"""The entities of flat payloads. The oracles spell out every refined column."""

from __future__ import annotations

from typing import Any

from pyspark.sql import DataFrame, SparkSession

from refinery.plans import registry
from refinery.plans.queries.payloads import (
    CUSTOMERS,
    EVENTS,
    LINES,
    ORDERS,
    PARTS,
    FlatPayload,
    branch,
    flat,
)
from refinery.plans.queries.query import Catalog

CATALOG = Catalog()


def add(entity: str, payload: FlatPayload, select: str, **context: Any) -> None:
    def refine(df: DataFrame) -> DataFrame:
        return registry.refine(df, entity, **context)

    CATALOG.add_entity(entity.replace(".", "_"), payload.frame, refine, payload.oracle(select))


# --- taxi: payloads of a relational source, so the columns are laid down here ---------------

add(
    "taxi.taxi_trip_fact",
    flat(
        LINES,
        """trip_id bigint, trip_date timestamp, vendor_id int, pickup_datetime timestamp,
           dropoff_datetime timestamp, passenger_count int, trip_distance double, ratecodeid int,
           store_and_fwd_flag string, pulocationid int, dolocationid int, payment_type int, fare_amount double,
           extra double, mta_tax double, tip_amount double, tolls_amount double, improvement_surcharge double,
           total_amount double, congestion_surcharge double, airport_fee double, cbd_congestion_fee double,
           load_batch_id bigint, load_utc timestamp""",
    ),
    """SELECT trip_id AS RitId, trip_date AS RitDatum, vendor_id AS LeverancierId, pickup_datetime AS OphaalMoment,
              dropoff_datetime AS AfzetMoment, passenger_count AS AantalPassagiers, trip_distance AS RitAfstand,
              ratecodeid AS TariefCode, store_and_fwd_flag AS OpslagVlag, pulocationid AS OphaalLocatieId,
              dolocationid AS AfzetLocatieId, payment_type AS Betaalwijze, fare_amount AS RitBedrag,
              extra AS Toeslag, mta_tax AS MtaBelasting, tip_amount AS Fooi, tolls_amount AS TolBedrag,
              improvement_surcharge AS VerbeteringsToeslag, total_amount AS TotaalBedrag,
              congestion_surcharge AS FileToeslag, airport_fee AS LuchthavenToeslag,
              cbd_congestion_fee AS CbdFileToeslag, load_batch_id AS LaadBatchId, load_utc AS LaadUtc
       FROM payload""",
)
add(
    "taxi.hvfhv_trip_fact",
    flat(
        EVENTS,
        """hvfhv_trip_id bigint, hvfhs_license_num string, dispatching_base_num string,
           originating_base_num string, request_datetime timestamp, on_scene_datetime timestamp,
           pickup_datetime timestamp, dropoff_datetime timestamp, pulocationid int, dolocationid int,
           trip_miles double, trip_time int, base_passenger_fare double, tolls double, bcf double,
           sales_tax double, congestion_surcharge double, airport_fee double, tips double, driver_pay double,
           shared_request_flag string, shared_match_flag string, access_a_ride_flag string,
           wav_request_flag string, wav_match_flag string, cbd_congestion_fee double, load_batch_id bigint,
           load_utc timestamp""",
    ),
    """SELECT hvfhv_trip_id AS HvfhvRitId, CAST(pickup_datetime AS DATE) AS OphaalDatum,
              hvfhs_license_num AS LicentieNummer, dispatching_base_num AS BasisNummer,
              originating_base_num AS HerkomstBasisNummer, request_datetime AS AanvraagMoment,
              on_scene_datetime AS TerPlaatsteMoment, pickup_datetime AS OphaalMoment,
              dropoff_datetime AS AfzetMoment, pulocationid AS OphaalLocatieId, dolocationid AS AfzetLocatieId,
              trip_miles AS RitMijlen, trip_time AS RitTijdSeconden, base_passenger_fare AS BasisRitBedrag,
              tolls AS TolBedrag, bcf AS ZwartAutoFonds, sales_tax AS Omzetbelasting,
              congestion_surcharge AS FileToeslag, airport_fee AS LuchthavenToeslag, tips AS Fooi,
              driver_pay AS ChauffeursLoon, shared_request_flag AS GedeeldVerzoek,
              shared_match_flag AS GedeeldMatch, access_a_ride_flag AS ToegangsRit,
              wav_request_flag AS RolstoelVerzoek, wav_match_flag AS RolstoelMatch,
              cbd_congestion_fee AS CbdFileToeslag, load_batch_id AS LaadBatchId, load_utc AS LaadUtc
       FROM payload""",
)
add(
    "taxi.fhv_trip_fact",
    flat(
        LINES,
        """fhv_trip_id bigint, dispatching_base_num string, pickup_datetime timestamp,
           dropoff_datetime timestamp, pulocationid int, dolocationid int, sr_flag string,
           affiliated_base_number string, load_batch_id bigint, load_utc timestamp""",
    ),
    """SELECT fhv_trip_id AS FhvRitId, CAST(pickup_datetime AS DATE) AS OphaalDatum,
              dispatching_base_num AS BasisNummer, pickup_datetime AS OphaalMoment,
              dropoff_datetime AS AfzetMoment, pulocationid AS OphaalLocatieId, dolocationid AS AfzetLocatieId,
              sr_flag AS GedeeldRit, affiliated_base_number AS GelieerdeBasisNummer,
              load_batch_id AS LaadBatchId, load_utc AS LaadUtc
       FROM payload""",
)
add(
    "taxi.taxi_zone_lookup",
    flat(ORDERS, "location_id int, borough string, zone string, service_zone string, load_utc timestamp"),
    """SELECT location_id AS LocatieId, borough AS Stadsdeel, zone AS "Zone", service_zone AS ServiceZone,
              load_utc AS LaadUtc
       FROM payload""",
)
add(
    "taxi.taxi_load_batch",
    flat(
        ORDERS,
        """load_batch_id bigint, source_name string, source_path string, load_started_utc timestamp,
           load_finished_utc timestamp, rows_loaded bigint, load_status string, notes string""",
    ),
    """SELECT load_batch_id AS LaadBatchId, source_name AS BronNaam, source_path AS BronPad,
              load_started_utc AS LaadStartUtc, load_finished_utc AS LaadEindeUtc, rows_loaded AS AantalRijen,
              load_status AS LaadStatus, notes AS Notities
       FROM payload""",
)

# --- renh: master data per branch -----------------------------------------------------------

IN_BRANCH = {base.table: branch(base) for base in (LINES, ORDERS, PARTS, CUSTOMERS)}


def till(base, ddl: str, **options: Any) -> FlatPayload:
    return flat(base, ddl, VestigingId=IN_BRANCH[base.table], **options)


add(
    "renh.departments",
    till(PARTS, "renh.departments"),
    """SELECT VestigingId || '_' || CAST(TblAfdelingnr AS VARCHAR) AS Id, Omschrijving, Emailadres, Grootboeknr,
              VestigingId
       FROM payload""",
)
add(
    "renh.maingroups",
    till(PARTS, "renh.maingroups"),
    """SELECT VestigingId || '_' || CAST(TblHoofdgroepnr AS VARCHAR) AS Id, VestigingId,
              TblHoofdgroepnr AS HoofdgroepNr, Omschrijving AS Naam, BestelFormule, VoorstelBestellingBerekenen,
              Grootboeknummer
       FROM payload""",
)
add(
    "renh.subgroups",
    till(PARTS, "renh.subgroups"),
    """SELECT VestigingId || '_' || CAST(TblSubgroepnr AS VARCHAR) AS Id,
              VestigingId || '_' || CAST(TblAfdelingnr AS VARCHAR) AS FK_Afdelingen_Id,
              VestigingId || '_' || CAST(TblHoofdgroepnr AS VARCHAR) AS FK_Hoofdgroepen_Id,
              VestigingId, TblSubgroepnr AS SubgroepNr, Omschrijving AS Naam, TblAfdelingnr AS AfdelingNr,
              TblHoofdgroepnr AS HoofdgroepNr, NietMeeDoenBestellingen, NietMeeDoenDebiteurenRapport,
              NietMeeDoenVoorraad, BrutoWinstPercentage, Leeftijdgrens, BoekingsTekst,
              TblHorecaGroepenID AS HorecaGroepId, DezeGroepNietTonenInOmzet
       FROM payload""",
)
add(
    "renh.suppliers",
    till(CUSTOMERS, "TblLeveranciersnr int, Naam string, Adres string, Krediet double"),
    """SELECT VestigingId || '_' || CAST(TblLeveranciersnr AS VARCHAR) AS Id, Naam, Adres, Krediet, VestigingId
       FROM payload""",
)
add(
    "renh.payment_methods",
    till(ORDERS, "Code_kolom int, Omschrijving string, Actief boolean"),
    "SELECT Code_kolom AS Id, Omschrijving, Actief, VestigingId FROM payload",
)
add(
    "renh.vat_codes",
    till(ORDERS, "Kode int, Omschrijving string, Percentage double"),
    "SELECT Kode AS Id, Omschrijving, Percentage, VestigingId FROM payload",
)
add(
    "renh.country_codes",
    till(CUSTOMERS, "LandCodeISO2 string, Land string, EU boolean"),
    "SELECT LandCodeISO2 AS Id, Land, EU, VestigingId FROM payload",
)
add(
    "renh.turnover_types",
    till(ORDERS, "renh.turnover_types"),
    """SELECT VestigingId || '_' || CAST(TblSoortOmzetnr AS VARCHAR) AS Id, VestigingId,
              TblSoortOmzetnr AS OmzetSoortNr, SoortOmzetomschrijving AS Naam, ZienAlsDerving, JournaliserenAls,
              GrootBoekSluitregel, GrootboekVerkoopkosten, GrootboekDebet, GrootboekCredit,
              AantallenAlsNegatiefBehandelen, NaarWinkel
       FROM payload""",
)
add(
    "renh.shops",
    till(CUSTOMERS, "renh.shops"),
    """SELECT VestigingId || '_' || CAST(TblWinkelnr AS VARCHAR) AS Id, VestigingId, TblWinkelnr AS WinkelNr,
              Omschrijving AS Naam, Adres, PC AS Postcode, Plaats, LandCodeISO2 AS LandCode, Emailadres, Telefoon,
              Mobiel, BICcode, IBAN, BtwNr, DivisionCodeExactOnline, ArtikelenMuterenIsToegestaan
       FROM payload""",
)
add(
    "renh.cash_registers",
    till(ORDERS, "renh.cash_registers", moments=("LaatstStartDatum", "LaatsteStopDatum")),
    """SELECT VestigingId || '_' || CAST(TblWinkelsnr AS VARCHAR) || '_' || CAST(TblKassanr AS VARCHAR) AS Id,
              VestigingId || '_' || CAST(TblWinkelsnr AS VARCHAR) AS FK_Winkels_Id, VestigingId,
              TblKassanr AS KassaNr, TblWinkelsnr AS WinkelNr, Omschrijving AS Naam, NietMeerActief, IsHorecaKassa,
              KassaZonderladen, KassaMetVasteLade, try_cast(LaatstStartDatum AS TIMESTAMP) AS LaatstStartDatum,
              try_cast(LaatsteStopDatum AS TIMESTAMP) AS LaatsteStopDatum
       FROM payload""",
)
# Passed through with the branch in front; fields as a till would deliver them.
for entity, base, key in (
    ("hospitality_groups", PARTS, "TblHorecaGroepenID"),
    ("hospitality_items", PARTS, "TblHorecaItemsID"),
    ("hospitality_items_choices", PARTS, "TblHorecaItemsKeuzeID"),
    ("action_descriptions", ORDERS, "TblActieOmschrijvingID"),
    ("actions", ORDERS, "TblActieID"),
    ("articles", PARTS, "TblArtikelnr"),
    ("customers", CUSTOMERS, "TblKlantenID"),
    ("invoices", LINES, "Factuurnummer"),
):
    add(
        f"renh.{entity}",
        till(base, f"{key} int, Omschrijving string, Bedrag double, Actief boolean, Volgorde int"),
        f"""SELECT VestigingId || '_' || CAST({key} AS VARCHAR) AS Id, VestigingId, Omschrijving, Bedrag, Actief,
                   Volgorde
            FROM payload""",
    )

# --- ticketcounter --------------------------------------------------------------------------

VALID = ("ValidFrom", "ValidTo")
RESORT = branch(LINES)

add(
    "ticketcounter.baskets",
    flat(LINES, "ticketcounter.baskets", Resort=RESORT),
    """SELECT Resort || '_' || BasketKey AS Id, Resort, BasketKey AS MandjeSleutel, BasketNumber AS MandjeNummer,
              BasketConfirmed AS MandjeBevestigd, ExternalBasketNumber AS ExternMandjeNummer,
              ExternalInvoiceId AS ExternFactuurId, PosFirstName AS PosVoornaam, PosMiddleName AS PosTussenvoegsel,
              PosLastName AS PosAchternaam, PosName AS PosNaam, PosGroupName AS PosGroepNaam, Contact
       FROM payload""",
)
add(
    "ticketcounter.ticket_scans",
    flat(LINES, "ticketcounter.ticket_scans", moments=("ScanDate", *VALID), Resort=RESORT),
    """SELECT Resort || '_' || CAST(ScanId AS VARCHAR) AS Id, Resort, ScanId, TicketCode,
              ScanGroupName AS ScanGroepNaam, DeviceID AS ApparaatId, Type,
              try_cast(ScanDate AS TIMESTAMP) AS ScanDatum, ReservationKey AS FK_Reservering_Sleutel,
              SubscriptionKey AS FK_Abonnement_Sleutel, SubscriptionProductKey AS FK_AbonnementProduct_Sleutel,
              SubscriptionTemplateKey AS FK_AbonnementTemplate_Sleutel, EventKey AS FK_Evenement_Sleutel,
              PerformanceKey AS FK_Voorstelling_Sleutel, PerformanceSectionKey AS FK_VoorstellingSectie_Sleutel,
              ProductName AS ProductNaam, InternalId AS InternId, ProductInternalId AS ProductInternId,
              Name AS Naam, EMail AS Email, FirstName AS Voornaam, Middle AS Tussenvoegsel, LastName AS Achternaam,
              CompanyName AS Bedrijfsnaam, PhoneNumber AS Telefoonnummer, Street AS Straat,
              HouseNumber AS Huisnummer, PostalCode AS Postcode, CityName AS Plaatsnaam, CountryName AS Landnaam,
              Lat AS Breedtegraad, Lon AS Lengtegraad, try_cast(ValidFrom AS TIMESTAMP) AS GeldigVanaf,
              try_cast(ValidTo AS TIMESTAMP) AS GeldigTot, ReservationNumber AS ReserveringsNummer,
              PriceKey AS PrijsSleutel, Price AS Prijs, OriginalPrice AS OriginelePrijs,
              BuyingPrice AS InkoopPrijs, ExternalID AS ExternId,
              ExternalReservationNumber AS ExternReserveringsNummer, ExtraInfo1, ExtraInfo2, ExtraInfo3,
              TestPayment AS TestBetaling, ReceiveNewsletter AS OntvangtNieuwsbrief
       FROM payload""",
)
add(
    "ticketcounter.sold_tickets",
    flat(
        LINES,
        "ticketcounter.sold_tickets",
        days=("CapacityDate", "CapacityStartDate"),
        moments=("SaleDate", "CancelDate", "ConfirmedDate", *VALID),
        Resort=RESORT,
    ),
    """SELECT Resort || '_' || TicketCode AS Id, Resort, TicketCode, Type,
              ReservationKey AS FK_Reservering_Sleutel, EventKey AS FK_Evenement_Sleutel,
              PerformanceKey AS FK_Voorstelling_Sleutel, PerformanceSectionKey AS FK_VoorstellingSectie_Sleutel,
              ContactHolderKey AS FK_ContactHouder_Sleutel, ProductName AS ProductNaam,
              try_cast(SaleDate AS TIMESTAMP) AS VerkoopDatum, TotalPrice AS TotalePrijs, Price AS Prijs,
              OriginalPrice AS OriginelePrijs, BuyingPrice AS InkoopPrijs, NrOfSeats AS AantalStoelen,
              Channel AS Kanaal, SalesChannel AS VerkoopKanaal, PaymentMethod AS BetaalMethode, Name AS Naam,
              EMail AS Email, FirstName AS Voornaam, Middle AS Tussenvoegsel, LastName AS Achternaam,
              CompanyName AS Bedrijfsnaam, PhoneNumber AS Telefoonnummer, Street AS Straat,
              HouseNumber AS Huisnummer, PostalCode AS Postcode, CityName AS Plaatsnaam, CountryName AS Landnaam,
              Lat AS Breedtegraad, Lon AS Lengtegraad, try_cast(ValidFrom AS TIMESTAMP) AS GeldigVanaf,
              try_cast(ValidTo AS TIMESTAMP) AS GeldigTot, try_cast(CapacityDate AS DATE) AS CapaciteitDatum,
              try_cast(CapacityStartDate AS DATE) AS CapaciteitStartDatum,
              CapacityStartTime AS CapaciteitStartTijd, CapacityEndTime AS CapaciteitEindTijd,
              ReservationNumber AS ReserveringsNummer, ResellerName AS ResellerNaam, PriceKey AS PrijsSleutel,
              Language AS Taal, LanguageCode AS TaalCode, BrancheID AS VestigingId,
              try_cast(CancelDate AS TIMESTAMP) AS AnnuleringsDatum,
              try_cast(ConfirmedDate AS TIMESTAMP) AS BevestigdDatum, PosGroupTitle AS PosGroepTitel,
              PosTitle AS PosTitel, PosContact, ExternalReservationNumber AS ExternReserveringsNummer,
              ExternalID AS ExternId, ExtraInfo1, ExtraInfo2, ExtraInfo3, TestPayment AS TestBetaling,
              ReceiveNewsLetter AS OntvangtNieuwsbrief, VatNumber AS BtwNummer, VatLow AS BtwLaag,
              VatMiddle AS BtwMiddel, VatHigh AS BtwHoog, AmountExVatLow AS BedragExBtwLaag,
              AmountExVatMiddle AS BedragExBtwMiddel, AmountExVatHigh AS BedragExBtwHoog,
              CashBooking AS ContantBoeking
       FROM payload""",
)
add(
    "ticketcounter.sold_subscriptions",
    flat(
        LINES,
        "ticketcounter.sold_subscriptions",
        days=("BirthDate",),
        moments=("SaleDate", "CancelDate", *VALID),
        Resort=RESORT,
    ),
    """SELECT Resort || '_' || SubscriptionKey AS Id, Resort, SubscriptionKey AS AbonnementSleutel, Type,
              ReservationKey AS FK_Reservering_Sleutel, SubscriptionTemplateKey AS FK_AbonnementTemplate_Sleutel,
              SubscriptionHolderKey AS FK_AbonnementHouder_Sleutel, ProductName AS ProductNaam,
              try_cast(SaleDate AS TIMESTAMP) AS VerkoopDatum, Price AS Prijs, Renewal AS Verlenging,
              Channel AS Kanaal, PaymentMethod AS BetaalMethode,
              NrOfSubscriptionProducts AS AantalAbonnementProducten, InternalId AS InternId, Name AS Naam,
              EMail AS Email, FirstName AS Voornaam, Middle AS Tussenvoegsel, LastName AS Achternaam,
              CompanyName AS Bedrijfsnaam, PhoneNumber AS Telefoonnummer, Street AS Straat,
              HouseNumber AS Huisnummer, PostalCode AS Postcode, CityName AS Plaatsnaam, CountryName AS Landnaam,
              Lat AS Breedtegraad, Lon AS Lengtegraad, try_cast(ValidFrom AS TIMESTAMP) AS GeldigVanaf,
              try_cast(ValidTo AS TIMESTAMP) AS GeldigTot, Gender AS Geslacht,
              try_cast(BirthDate AS DATE) AS Geboortedatum, try_cast(CancelDate AS TIMESTAMP) AS AnnuleringsDatum,
              ReservationNumber AS ReserveringsNummer, Language AS Taal, LanguageCode AS TaalCode,
              LoyaltyLevel AS LoyaliteitNiveau, PosGroupTitle AS PosGroepTitel, PosTitle AS PosTitel, PosContact,
              ExternalID AS ExternId, TestPayment AS TestBetaling, ReceiveNewsLetter AS OntvangtNieuwsbrief
       FROM payload""",
)
add(
    "ticketcounter.cancellations",
    # Days only for ValidFrom, so that keys come back; several cancellations share a key.
    flat(LINES, "ticketcounter.cancellations", moments=("CancelDate", "ValidTo"), days=("ValidFrom",), Resort=RESORT,
         ReservationKey="case when l_orderkey % 9 = 0 then null else 'R' || cast(l_orderkey % 500 as string) end"),
    """, parsed AS (
         SELECT Resort || '_' || ReservationKey || '_' || ValidFrom AS Id, Resort,
                ReservationKey AS ReserveringsSleutel, ReservationNumber AS ReserveringsNummer,
                ExternalReservationNumber AS ExternReserveringsNummer,
                try_cast(CancelDate AS TIMESTAMP) AS AnnuleringsDatum, Price AS Prijs,
                OriginalPrice AS OriginelePrijs, NrOfSeats AS AantalStoelen,
                try_cast(ValidFrom AS TIMESTAMP) AS GeldigVanaf, try_cast(ValidTo AS TIMESTAMP) AS GeldigTot
         FROM payload)
       SELECT * EXCLUDE (rn) FROM (
         SELECT *, row_number() OVER (
           PARTITION BY Id
           ORDER BY AnnuleringsDatum DESC NULLS LAST, Id NULLS LAST, Resort NULLS LAST,
                    ReserveringsSleutel NULLS LAST, ReserveringsNummer NULLS LAST,
                    ExternReserveringsNummer NULLS LAST, AnnuleringsDatum NULLS LAST, Prijs NULLS LAST,
                    OriginelePrijs NULLS LAST, AantalStoelen NULLS LAST, GeldigVanaf NULLS LAST,
                    GeldigTot NULLS LAST) AS rn
         FROM parsed) WHERE rn = 1""",
)

# --- dip, dyflexis, eijsink: the flat ones --------------------------------------------------

add(
    "dip.productions",
    flat(PARTS, "dip.productions"),
    "SELECT id AS Id, title AS Titel, startDate AS StartDatum, season AS Seizoen FROM payload",
)
add(
    "dyflexis.employee",
    flat(
        CUSTOMERS,
        "dyflexis.employee",
        days=("dateOfBirth", "employmentStart", "employmentEnd"),
        firstName="case when c_custkey % 4 = 0 then '' when c_custkey % 4 = 1 then null else c_name end",
        lastNamePrefix="case when c_custkey % 3 = 0 then '' when c_custkey % 3 = 1 then null else 'van' end",
        lastName="case when c_custkey % 8 = 0 then '' else c_mktsegment end",
    ),
    """SELECT employeeId AS MedewerkerId, try_cast(dateOfBirth AS DATE) AS Geboortedatum,
              concat_ws(' ', nullif(firstName, ''), nullif(lastNamePrefix, ''), nullif(lastName, '')) AS Naam,
              try_cast(employmentStart AS DATE) AS DienstverbandStart,
              try_cast(employmentEnd AS DATE) AS DienstverbandEinde, personnelNumber AS Personeelsnummer,
              costCenter AS Kostenplaats
       FROM payload""",
)
add(
    "dyflexis.registered_hours",
    flat(
        ORDERS,
        "dyflexis.registered_hours",
        moments=("endDateTime",),
        # Late in the evening, five hours behind UTC: the day as written is not the day in UTC.
        startDateTime="""case when o_orderkey % 5 = 0 then 'unknown'
                              else cast(cast(o_orderdate as date) as string) || 'T23:15:00-05:00' end""",
    ),
    """SELECT id AS Id, employeeId AS FK_Medewerker_Id, departmentId AS FK_Afdeling_Id,
              personnelNumber AS Personeelsnummer,
              concat_ws(' ', nullif(firstName, ''), nullif(infix, ''), nullif(lastName, '')) AS Naam,
              employeeCostCenter AS MedewerkerKostenplaats, contractTypeId AS ContractTypeId,
              contractType AS ContractType, try_cast(substr(startDateTime, 1, 10) AS DATE) AS Datum,
              try_cast(substr(startDateTime, 1, 19) AS TIMESTAMP) + INTERVAL 5 HOUR AS StartTijdstip,
              try_cast(endDateTime AS TIMESTAMP) AS EindTijdstip, hourType AS UurType, hours AS Uren,
              status AS Status, breakMinutes AS PauzeMinuten, duration AS Duur
       FROM payload""",
)
add(
    "eijsink.stores",
    flat(CUSTOMERS, "eijsink.stores", VestigingId=branch(CUSTOMERS)),
    "SELECT VestigingId || '_' || id AS Id, VestigingId, id AS LocatieId, name AS Naam FROM payload",
)
add(
    "eijsink.turnover_groups",
    flat(
        PARTS,
        "eijsink.turnover_groups",
        # A key comes twice with two names; a third of all rows share one parent; some are missing.
        VestigingId="'V' || cast(p_partkey % 2 as string)",
        id="'T' || cast(p_partkey - p_partkey % 4 as string)",
        name="p_name",
        parentID="""case when p_partkey % 10 = 0 then null when p_partkey % 10 = 1 then 'gone'
                         when p_partkey % 3 = 0 then 'T0' else 'T' || cast(p_size * 4 as string) end""",
    ),
    """, parents AS (SELECT DISTINCT VestigingId || '_' || id AS pid, name AS pname FROM payload)
       SELECT DISTINCT VestigingId || '_' || id AS Id, VestigingId, id AS Omzetgroep, name AS Naam, pid AS ParentId,
              coalesce(pname, name) AS HoofdOmzetgroep
       FROM payload LEFT JOIN parents ON VestigingId || '_' || parentID = pid""",
)
