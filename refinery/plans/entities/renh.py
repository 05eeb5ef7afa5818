"""Retail tills: master data per branch, receipts and their lines.

Records carry ``VestigingId``, the branch they were fetched for; it is put on them at
ingestion and is part of every key that the source keeps per branch only.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import partial

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from refinery.functions import foreign_key, parse_date, parse_timestamp, tenant_key
from refinery.operators import project, rekey, rollup_lines
from refinery.plans.entities.entity import Entity

BRANCH = "VestigingId"

# The record layouts. The other payloads are read as they come.
ORDERED = """array<struct<
    count: int, gewicht: double, plu: bigint, price: double, brutoverkoopwaarde: double, korting: double,
    verkoopwaarde: double, inkoopwaarde: double, scancode: string, subgroep: int, tax: int, taxperc: int,
    hoofdgroep: int, afdeling: int, omzetsoort: int, gewichtartikel: boolean, text: string, actieomzet: string>>"""
SCHEMAS = {
    "departments": "TblAfdelingnr int, Omschrijving string, Emailadres string, Grootboeknr string",
    "maingroups": """
        TblHoofdgroepnr int,
        Omschrijving string,
        BestelFormule string,
        VoorstelBestellingBerekenen boolean,
        Grootboeknummer string""",
    "subgroups": """
        TblSubgroepnr int,
        Omschrijving string,
        TblAfdelingnr int,
        TblHoofdgroepnr int,
        NietMeeDoenBestellingen boolean,
        NietMeeDoenDebiteurenRapport boolean,
        NietMeeDoenVoorraad boolean,
        BrutoWinstPercentage double,
        Leeftijdgrens int,
        BoekingsTekst string,
        ExternePrinter int,
        TypeOrderbon int,
        PrintVolgorde int,
        TblHorecaGroepenID int,
        TblGangenID int,
        DezeGroepNaarWeegschaalBijMix boolean,
        DezeGroepNietTonenInOmzet boolean""",
    "turnover_types": """
        TblSoortOmzetnr int,
        SoortOmzetomschrijving string,
        ZienAlsDerving boolean,
        JournaliserenAls int,
        GrootBoekSluitregel string,
        GrootboekVerkoopkosten string,
        GrootboekDebet string,
        GrootboekCredit string,
        AantallenAlsNegatiefBehandelen boolean,
        NaarWinkel int""",
    "shops": """
        TblWinkelnr int,
        Omschrijving string,
        Adres string,
        PC string,
        Plaats string,
        LandCodeISO2 string,
        AdministratieCode string,
        DagOmzetExclBtw double,
        TonenOpKaart boolean,
        Lattitude double,
        Longitude double,
        Emailadres string,
        Telefoon string,
        Mobiel string,
        BICcode string,
        IBAN string,
        BtwNr string,
        DivisionCodeExactOnline string,
        DatumLaatsteSynchronisatie string,
        ArtikelenMuterenIsToegestaan boolean""",
    "cash_registers": """
        TblWinkelsnr int,
        TblKassanr int,
        Omschrijving string,
        LaatsteDatumGesynchroniseerd string,
        KassaZonderladen boolean,
        KassaMetVasteLade int,
        NietMeerActief boolean,
        LaatstStartDatum string,
        LaatsteStopDatum string,
        IsHorecaKassa boolean,
        GebruikMettlerAPI boolean,
        PingTimeout int,
        Groep int""",
    "day_turnover": f"""
        Transaction struct<
            branch: int, register: int, billno: string, cashier: int, custno: int, custname: string,
            time: string, total: double, VATNumber: string, DoNotChargeVAT: boolean,
            Ordered: {ORDERED},
            payform: array<struct<amount: double, payformid: int, payformname: string>>>""",
}

# Payloads passed through under a new key -> the source's own key.
BRANCH_KEYED = {"departments": "TblAfdelingnr", "suppliers": "TblLeveranciersnr"}
BRANCH_KEYED_BRANCH_FIRST = {
    "hospitality_groups": "TblHorecaGroepenID",
    "hospitality_items": "TblHorecaItemsID",
    "hospitality_items_choices": "TblHorecaItemsKeuzeID",
    "action_descriptions": "TblActieOmschrijvingID",
    "actions": "TblActieID",
    "articles": "TblArtikelnr",
    "customers": "TblKlantenID",
    "invoices": "Factuurnummer",
}
PLAIN_KEYED = {"payment_methods": "Code_kolom", "vat_codes": "Kode", "country_codes": "LandCodeISO2"}

# Refined column -> source column.
MAINGROUP_COLUMNS = {
    BRANCH: BRANCH,
    "HoofdgroepNr": "TblHoofdgroepnr",
    "Naam": "Omschrijving",
    "BestelFormule": "BestelFormule",
    "VoorstelBestellingBerekenen": "VoorstelBestellingBerekenen",
    "Grootboeknummer": "Grootboeknummer",
}
SUBGROUP_COLUMNS = {
    BRANCH: BRANCH,
    "SubgroepNr": "TblSubgroepnr",
    "Naam": "Omschrijving",
    "AfdelingNr": "TblAfdelingnr",
    "HoofdgroepNr": "TblHoofdgroepnr",
    "NietMeeDoenBestellingen": "NietMeeDoenBestellingen",
    "NietMeeDoenDebiteurenRapport": "NietMeeDoenDebiteurenRapport",
    "NietMeeDoenVoorraad": "NietMeeDoenVoorraad",
    "BrutoWinstPercentage": "BrutoWinstPercentage",
    "Leeftijdgrens": "Leeftijdgrens",
    "BoekingsTekst": "BoekingsTekst",
    "HorecaGroepId": "TblHorecaGroepenID",
    "DezeGroepNietTonenInOmzet": "DezeGroepNietTonenInOmzet",
}
TURNOVER_TYPE_COLUMNS = {
    BRANCH: BRANCH,
    "OmzetSoortNr": "TblSoortOmzetnr",
    "Naam": "SoortOmzetomschrijving",
    "ZienAlsDerving": "ZienAlsDerving",
    "JournaliserenAls": "JournaliserenAls",
    "GrootBoekSluitregel": "GrootBoekSluitregel",
    "GrootboekVerkoopkosten": "GrootboekVerkoopkosten",
    "GrootboekDebet": "GrootboekDebet",
    "GrootboekCredit": "GrootboekCredit",
    "AantallenAlsNegatiefBehandelen": "AantallenAlsNegatiefBehandelen",
    "NaarWinkel": "NaarWinkel",
}
SHOP_COLUMNS = {
    BRANCH: BRANCH,
    "WinkelNr": "TblWinkelnr",
    "Naam": "Omschrijving",
    "Adres": "Adres",
    "Postcode": "PC",
    "Plaats": "Plaats",
    "LandCode": "LandCodeISO2",
    "Emailadres": "Emailadres",
    "Telefoon": "Telefoon",
    "Mobiel": "Mobiel",
    "BICcode": "BICcode",
    "IBAN": "IBAN",
    "BtwNr": "BtwNr",
    "DivisionCodeExactOnline": "DivisionCodeExactOnline",
    "ArtikelenMuterenIsToegestaan": "ArtikelenMuterenIsToegestaan",
}
LINE_SUMS = {
    "Aantal": "item.count",
    "Gewicht": "item.gewicht",
    "BrutoVerkoopwaarde": "item.brutoverkoopwaarde",
    "Verkoopwaarde": "item.verkoopwaarde",
    "Inkoopwaarde": "item.inkoopwaarde",
}


def pass_through(df: DataFrame, key: str, *, branch_key: bool = True, branch_first: bool = False) -> DataFrame:
    """The payload under a new ``Id`` in the place of the source's key."""
    new_key = tenant_key(BRANCH, key) if branch_key else F.col(key)
    return rekey(df, new_key, first=[BRANCH] if branch_first else [], drop=[key])


def branch_table(df: DataFrame, key: str, columns: dict[str, str]) -> DataFrame:
    return project(df, {"Id": tenant_key(BRANCH, key), **columns})


def subgroups(df: DataFrame) -> DataFrame:
    return project(
        df,
        {
            "Id": tenant_key(BRANCH, "TblSubgroepnr"),
            "FK_Afdelingen_Id": foreign_key(BRANCH, "TblAfdelingnr"),
            "FK_Hoofdgroepen_Id": foreign_key(BRANCH, "TblHoofdgroepnr"),
            **SUBGROUP_COLUMNS,
        },
    )


def cash_registers(df: DataFrame) -> DataFrame:
    return project(
        df,
        {
            "Id": tenant_key(BRANCH, "TblWinkelsnr", "TblKassanr"),
            "FK_Winkels_Id": foreign_key(BRANCH, "TblWinkelsnr"),
            BRANCH: BRANCH,
            "KassaNr": "TblKassanr",
            "WinkelNr": "TblWinkelsnr",
            "Naam": "Omschrijving",
            "NietMeerActief": "NietMeerActief",
            "IsHorecaKassa": "IsHorecaKassa",
            "KassaZonderladen": "KassaZonderladen",
            "KassaMetVasteLade": "KassaMetVasteLade",
            "LaatstStartDatum": parse_timestamp("LaatstStartDatum"),
            "LaatsteStopDatum": parse_timestamp("LaatsteStopDatum"),
        },
    )


def day_turnover(df: DataFrame) -> DataFrame:
    """Receipts; the key is branch, shop, till and receipt number."""
    return project(
        df,
        {
            "Id": tenant_key(BRANCH, "Transaction.branch", "Transaction.register", "Transaction.billno"),
            "FK_Winkels_Id": foreign_key(BRANCH, "Transaction.branch"),
            "FK_Kassas_Id": foreign_key(BRANCH, "Transaction.branch", "Transaction.register"),
            BRANCH: BRANCH,
            "BonNummer": "Transaction.billno",
            "Kassamedewerker": "Transaction.cashier",
            "KlantNummer": "Transaction.custno",
            "KlantNaam": "Transaction.custname",
            "Tijd": parse_timestamp("Transaction.time"),
            "Datum": parse_date("Transaction.time"),
            "TotaalBedrag": "Transaction.total",
            "BTWNummer": "Transaction.VATNumber",
            "ZonderBTW": "Transaction.DoNotChargeVAT",
        },
    )


def day_turnover_lines(df: DataFrame) -> DataFrame:
    """Receipt lines. Lines have no id; those that agree in all but amounts become one."""
    keys = {
        "FK_DagOmzetTransacties_Id": foreign_key(
            BRANCH, "Transaction.branch", "Transaction.register", "Transaction.billno"
        ),
        BRANCH: BRANCH,
        "Datum": parse_date("Transaction.time"),
        "PLU": "item.plu",
        "Omschrijving": "item.text",
        "GewichtArtikel": "item.gewichtartikel",
        "Prijs": "item.price",
        "Korting": "item.korting",
        "Scancode": "item.scancode",
        "FK_Subgroepen_Id": foreign_key(BRANCH, "item.subgroep"),
        "SubgroepNr": "item.subgroep",
        "FK_Hoofdgroepen_Id": foreign_key(BRANCH, "item.hoofdgroep"),
        "HoofdgroepNr": "item.hoofdgroep",
        "AfdelingNr": "item.afdeling",
        "OmzetSoortNr": "item.omzetsoort",
        "BTWCode": "item.tax",
        "BTWPercentage": "item.taxperc",
        "ActieOmzet": "item.actieomzet",
    }
    return rollup_lines(df, keys, LINE_SUMS, arrays={"item": "Transaction.Ordered"})


def _keyed(refine: Callable[..., DataFrame], keys: dict[str, str], **options: bool) -> dict[str, Entity]:
    return {name: Entity(partial(refine, key=key, **options)) for name, key in keys.items()}


ENTITIES = {
    **_keyed(pass_through, BRANCH_KEYED),
    **_keyed(pass_through, BRANCH_KEYED_BRANCH_FIRST, branch_first=True),
    **_keyed(pass_through, PLAIN_KEYED, branch_key=False),
    "maingroups": Entity(partial(branch_table, key="TblHoofdgroepnr", columns=MAINGROUP_COLUMNS)),
    "subgroups": Entity(subgroups),
    "turnover_types": Entity(partial(branch_table, key="TblSoortOmzetnr", columns=TURNOVER_TYPE_COLUMNS)),
    "shops": Entity(partial(branch_table, key="TblWinkelnr", columns=SHOP_COLUMNS)),
    "cash_registers": Entity(cash_registers),
    "day_turnover": Entity(day_turnover),
    "day_turnover_lines": Entity(day_turnover_lines, payload="day_turnover", rowwise=False),
}
