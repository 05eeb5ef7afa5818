"""Ticketing: baskets, scans, sold tickets and subscriptions, cancellations.

Records carry ``Resort``, the resort they were fetched for.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame

from refinery.functions import parse_date, parse_timestamp, tenant_key
from refinery.operators import latest_per_key, project
from refinery.plans.entities.entity import Entity

RESORT = "Resort"

# The record layouts, put together from their parts.
PAYMENTS = "array<struct<PayId: string, PaymentType: string, PaymentRemark: string, Amount: double>>"
RESERVATIONS = "array<struct<ReservationKey: string, Reservationnumber: string, Amount: double>>"
ADDRESS = """
        Name string,
        EMail string,
        Street string,
        HouseNumber string,
        PostalCode string,
        CityName string,
        CountryName string,
        Lat double,
        Lon double"""
VALIDITY = """
        ValidFrom string,
        ValidTo string"""
PERSON = """
        CompanyName string,
        FirstName string,
        Middle string,
        LastName string,
        PhoneNumber string"""
EXTRA = """
        ExtraInfo1 string,
        ExtraInfo2 string,
        ExtraInfo3 string,
        TestPayment boolean"""
SCHEMAS = {
    "baskets": f"""
        BasketConfirmed string,
        BasketNumber string,
        BasketKey string,
        ExternalBasketNumber string,
        ExternalInvoiceId string,
        PosFirstName string,
        PosMiddleName string,
        PosLastName string,
        PosName string,
        PosGroupName string,
        Payments {PAYMENTS},
        Reservations {RESERVATIONS},
        Cancellations array<string>,
        PartialCancellation array<string>,
        Contact string""",
    "ticket_scans": f"""
        ScanId int,
        TicketCode string,
        ScanGroupName string,
        DeviceID string,
        Type string,
        ReservationKey string,
        SubscriptionKey string,
        SubscriptionProductKey string,
        ScanDate string,
        SubscriptionTemplateKey string,
        ProductName string,
        InternalId string,
        ProductInternalId string,{ADDRESS},
        EventKey string,
        PerformanceKey string,
        PerformanceSectionKey string,{VALIDITY},{PERSON},
        ReservationNumber string,
        PriceKey string,
        Price double,
        OriginalPrice double,
        BuyingPrice double,
        ExternalID string,
        ExternalReservationNumber string,{EXTRA},
        ReceiveNewsletter boolean""",
    "sold_tickets": f"""
        EventKey string,
        Type string,
        ReservationKey string,
        PerformanceKey string,
        PerformanceSectionKey string,
        ProductName string,
        SaleDate string,
        TotalPrice double,
        Price double,
        OriginalPrice double,
        BuyingPrice double,
        NrOfSeats int,
        Channel string,
        ContactHolderKey string,{ADDRESS},{VALIDITY},{PERSON},
        ReceiveNewsLetter boolean,
        PaymentMethod string,
        BrancheID string,
        CancelDate string,
        ReservationNumber string,
        Language string,
        SalesChannel string,
        ResellerName string,
        PriceKey string,
        LanguageCode string,
        TicketCode string,
        CapacityDate string,
        CapacityStartTimeMinutesAfterMidnight int,
        CapacityEndTimeMinutesAfterMidnight int,
        CapacityStartDate string,
        CapacityStartTime string,
        CapacityEndTime string,
        PosGroupTitle string,
        PosTitle string,
        PosContact string,
        ExternalReservationNumber string,
        ExternalID string,{EXTRA},
        ConfirmedDate string,
        VatNumber string,
        VatLow double,
        VatMiddle double,
        VatHigh double,
        AmountExVatLow double,
        AmountExVatMiddle double,
        AmountExVatHigh double,
        CashBooking boolean""",
    "sold_subscriptions": f"""
        SubscriptionKey string,
        Type string,
        ReservationKey string,
        SubscriptionTemplateKey string,
        ProductName string,
        SaleDate string,
        Price double,
        Renewal boolean,
        Channel string,
        SubscriptionHolderKey string,
        InternalId string,{ADDRESS},{VALIDITY},{PERSON},
        ReceiveNewsLetter boolean,
        PaymentMethod string,
        NrOfSubscriptionProducts int,
        CancelDate string,
        ReservationNumber string,
        Language string,
        LanguageCode string,
        LoyaltyLevel string,
        PosGroupTitle string,
        PosTitle string,
        PosContact string,
        ExternalID string,
        TestPayment boolean,
        Gender string,
        BirthDate string""",
    "cancellations": f"""
        ReservationKey string,
        ReservationNumber string,
        ExternalReservationNumber string,
        CancelDate string,
        Price double,
        OriginalPrice double,
        NrOfSeats int,{VALIDITY}""",
}

# Refined column -> source field.
BASKET_COLUMNS = {
    RESORT: RESORT,
    "MandjeSleutel": "BasketKey",
    "MandjeNummer": "BasketNumber",
    "MandjeBevestigd": "BasketConfirmed",
    "ExternMandjeNummer": "ExternalBasketNumber",
    "ExternFactuurId": "ExternalInvoiceId",
    "PosVoornaam": "PosFirstName",
    "PosTussenvoegsel": "PosMiddleName",
    "PosAchternaam": "PosLastName",
    "PosNaam": "PosName",
    "PosGroepNaam": "PosGroupName",
    "Contact": "Contact",
}
CONTACT_COLUMNS = {
    "Naam": "Name",
    "Email": "EMail",
    "Voornaam": "FirstName",
    "Tussenvoegsel": "Middle",
    "Achternaam": "LastName",
    "Bedrijfsnaam": "CompanyName",
    "Telefoonnummer": "PhoneNumber",
    "Straat": "Street",
    "Huisnummer": "HouseNumber",
    "Postcode": "PostalCode",
    "Plaatsnaam": "CityName",
    "Landnaam": "CountryName",
    "Breedtegraad": "Lat",
    "Lengtegraad": "Lon",
}
PLACE_KEYS = {
    "FK_Evenement_Sleutel": "EventKey",
    "FK_Voorstelling_Sleutel": "PerformanceKey",
    "FK_VoorstellingSectie_Sleutel": "PerformanceSectionKey",
}
PRICES = {"Prijs": "Price", "OriginelePrijs": "OriginalPrice", "InkoopPrijs": "BuyingPrice"}
POINT_OF_SALE = {"PosGroepTitel": "PosGroupTitle", "PosTitel": "PosTitle", "PosContact": "PosContact"}
EXTRA_COLUMNS = {
    "ExtraInfo1": "ExtraInfo1",
    "ExtraInfo2": "ExtraInfo2",
    "ExtraInfo3": "ExtraInfo3",
    "TestBetaling": "TestPayment",
}


def _valid() -> dict[str, Column]:
    return {"GeldigVanaf": parse_timestamp("ValidFrom"), "GeldigTot": parse_timestamp("ValidTo")}


def baskets(df: DataFrame) -> DataFrame:
    return project(df, {"Id": tenant_key(RESORT, "BasketKey"), **BASKET_COLUMNS})


def ticket_scans(df: DataFrame) -> DataFrame:
    return project(
        df,
        {
            "Id": tenant_key(RESORT, "ScanId"),
            RESORT: RESORT,
            "ScanId": "ScanId",
            "TicketCode": "TicketCode",
            "ScanGroepNaam": "ScanGroupName",
            "ApparaatId": "DeviceID",
            "Type": "Type",
            "ScanDatum": parse_timestamp("ScanDate"),
            "FK_Reservering_Sleutel": "ReservationKey",
            "FK_Abonnement_Sleutel": "SubscriptionKey",
            "FK_AbonnementProduct_Sleutel": "SubscriptionProductKey",
            "FK_AbonnementTemplate_Sleutel": "SubscriptionTemplateKey",
            **PLACE_KEYS,
            "ProductNaam": "ProductName",
            "InternId": "InternalId",
            "ProductInternId": "ProductInternalId",
            **CONTACT_COLUMNS,
            **_valid(),
            "ReserveringsNummer": "ReservationNumber",
            "PrijsSleutel": "PriceKey",
            **PRICES,
            "ExternId": "ExternalID",
            "ExternReserveringsNummer": "ExternalReservationNumber",
            **EXTRA_COLUMNS,
            "OntvangtNieuwsbrief": "ReceiveNewsletter",
        },
    )


def sold_tickets(df: DataFrame) -> DataFrame:
    return project(
        df,
        {
            "Id": tenant_key(RESORT, "TicketCode"),
            RESORT: RESORT,
            "TicketCode": "TicketCode",
            "Type": "Type",
            "FK_Reservering_Sleutel": "ReservationKey",
            **PLACE_KEYS,
            "FK_ContactHouder_Sleutel": "ContactHolderKey",
            "ProductNaam": "ProductName",
            "VerkoopDatum": parse_timestamp("SaleDate"),
            "TotalePrijs": "TotalPrice",
            **PRICES,
            "AantalStoelen": "NrOfSeats",
            "Kanaal": "Channel",
            "VerkoopKanaal": "SalesChannel",
            "BetaalMethode": "PaymentMethod",
            **CONTACT_COLUMNS,
            **_valid(),
            "CapaciteitDatum": parse_date("CapacityDate"),
            "CapaciteitStartDatum": parse_date("CapacityStartDate"),
            "CapaciteitStartTijd": "CapacityStartTime",
            "CapaciteitEindTijd": "CapacityEndTime",
            "ReserveringsNummer": "ReservationNumber",
            "ResellerNaam": "ResellerName",
            "PrijsSleutel": "PriceKey",
            "Taal": "Language",
            "TaalCode": "LanguageCode",
            "VestigingId": "BrancheID",
            "AnnuleringsDatum": parse_timestamp("CancelDate"),
            "BevestigdDatum": parse_timestamp("ConfirmedDate"),
            **POINT_OF_SALE,
            "ExternReserveringsNummer": "ExternalReservationNumber",
            "ExternId": "ExternalID",
            **EXTRA_COLUMNS,
            "OntvangtNieuwsbrief": "ReceiveNewsLetter",
            "BtwNummer": "VatNumber",
            "BtwLaag": "VatLow",
            "BtwMiddel": "VatMiddle",
            "BtwHoog": "VatHigh",
            "BedragExBtwLaag": "AmountExVatLow",
            "BedragExBtwMiddel": "AmountExVatMiddle",
            "BedragExBtwHoog": "AmountExVatHigh",
            "ContantBoeking": "CashBooking",
        },
    )


def sold_subscriptions(df: DataFrame) -> DataFrame:
    return project(
        df,
        {
            "Id": tenant_key(RESORT, "SubscriptionKey"),
            RESORT: RESORT,
            "AbonnementSleutel": "SubscriptionKey",
            "Type": "Type",
            "FK_Reservering_Sleutel": "ReservationKey",
            "FK_AbonnementTemplate_Sleutel": "SubscriptionTemplateKey",
            "FK_AbonnementHouder_Sleutel": "SubscriptionHolderKey",
            "ProductNaam": "ProductName",
            "VerkoopDatum": parse_timestamp("SaleDate"),
            "Prijs": "Price",
            "Verlenging": "Renewal",
            "Kanaal": "Channel",
            "BetaalMethode": "PaymentMethod",
            "AantalAbonnementProducten": "NrOfSubscriptionProducts",
            "InternId": "InternalId",
            **CONTACT_COLUMNS,
            **_valid(),
            "Geslacht": "Gender",
            "Geboortedatum": parse_date("BirthDate"),
            "AnnuleringsDatum": parse_timestamp("CancelDate"),
            "ReserveringsNummer": "ReservationNumber",
            "Taal": "Language",
            "TaalCode": "LanguageCode",
            "LoyaliteitNiveau": "LoyaltyLevel",
            **POINT_OF_SALE,
            "ExternId": "ExternalID",
            "TestBetaling": "TestPayment",
            "OntvangtNieuwsbrief": "ReceiveNewsLetter",
        },
    )


def cancellations(df: DataFrame, *, null_keys: str = "collapse") -> DataFrame:
    """The last cancellation of each reservation and start of validity."""
    parsed = project(
        df,
        {
            "Id": tenant_key(RESORT, "ReservationKey", "ValidFrom"),
            RESORT: RESORT,
            "ReserveringsSleutel": "ReservationKey",
            "ReserveringsNummer": "ReservationNumber",
            "ExternReserveringsNummer": "ExternalReservationNumber",
            "AnnuleringsDatum": parse_timestamp("CancelDate"),
            "Prijs": "Price",
            "OriginelePrijs": "OriginalPrice",
            "AantalStoelen": "NrOfSeats",
            **_valid(),
        },
    )
    return latest_per_key(parsed, ["Id"], "AnnuleringsDatum", null_keys=null_keys)


ENTITIES = {
    "baskets": Entity(baskets),
    "ticket_scans": Entity(ticket_scans),
    "sold_tickets": Entity(sold_tickets),
    "sold_subscriptions": Entity(sold_subscriptions),
    "cancellations": Entity(cancellations, rowwise=False),
}
