"""Hospitality tills: orders with the items sold and paid, sales points, stores, groups.

Records carry ``VestigingId``, the branch they were fetched for; sales points also carry
``_store_id``, the store whose points were asked for.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from refinery.functions import foreign_key, nth, tenant_key, utc_to_local, written_date
from refinery.operators import distinct_rows, explode_children, flatten_tree, project, with_parent
from refinery.plans.entities.entity import Entity

BRANCH = "VestigingId"

# The record layouts, put together from their parts.
NAMED = "struct<id: string, name: string>"
CURRENCY = "struct<code: string, rate: double>"
AMOUNT = "struct<inclVAT: double, exclVAT: double, VAT: double, priceIncludedVAT: boolean>"
VAT = "struct<id: string, name: string, percentage: double, code: string>"
PRICE = f"struct<value: double, currency: string, includeVAT: boolean, VAT: {VAT}>"
PAYMENT = f"""struct<currency: {CURRENCY}, externalId: string, amount: double, method: {NAMED},
    methodType: {NAMED}, journal: string>"""
PAYMENT_ITEM = f"""struct<id: string, user: {NAMED}, currency: {CURRENCY}, createdAt: string, workDay: string,
    amount: double, shiftId: string, payment: {PAYMENT}>"""
SALES_ITEM = f"""struct<salesItemType: string, id: string, course: struct<name: string>, user: {NAMED},
    currency: {CURRENCY}, createdAt: string, workDay: string, product: {NAMED}, itemCount: double,
    price: {PRICE}, netAmount: {AMOUNT}, grossAmount: {AMOUNT}, remarks: array<string>, userShiftId: string,
    salesPoint: {NAMED}, productGroups: array<string>, turnoverGroups: array<string>>"""
# Sales points hold sales points, four levels below the first; deeper ones stay text.
SUB_LEVELS = 4


def _sales_points(levels: int) -> str:
    inner = "string" if levels == 1 else _sales_points(levels - 1)
    return f"array<struct<id: string, name: string, salesPoints: {inner}>>"


SCHEMAS = {
    "orders": f"""
        id string,
        orderNr string,
        createdAt string,
        lastUpdatedAt string,
        receiptNr string,
        storeId string,
        workDay string,
        occupiedSeatsNumber int,
        salesPoint {NAMED},
        remarks array<string>,
        paymentItems array<{PAYMENT_ITEM}>,
        salesItems array<{SALES_ITEM}>""",
    "salespoints": f"_store_id string, id string, name string, salesPoints {_sales_points(SUB_LEVELS)}",
    "stores": "id string, name string",
    "turnover_groups": "id string, name string, parentID string",
}

# Fixed value: the zone of the tills; the source sends UTC.
ZONE = "Europe/Amsterdam"


def orders(df: DataFrame, *, zone: str = ZONE) -> DataFrame:
    return project(
        df,
        {
            "Id": tenant_key(BRANCH, "id"),
            "FK_Locaties_Id": foreign_key(BRANCH, "storeId"),
            "FK_Verkooppunten_Id": foreign_key(BRANCH, "salesPoint.id"),
            BRANCH: BRANCH,
            "OrderNummer": "orderNr",
            "BonNummer": "receiptNr",
            "Datum": written_date("workDay"),
            "AantalStoelenBezet": "occupiedSeatsNumber",
            "AangemaaktOp": utc_to_local("createdAt", zone),
            "LaatsteWijziging": utc_to_local("lastUpdatedAt", zone),
        },
    )


def sales_items(df: DataFrame, *, zone: str = ZONE) -> DataFrame:
    return explode_children(
        df,
        {"item": "salesItems"},
        {
            "Id": tenant_key(BRANCH, "item.id"),
            "FK_Orders_Id": foreign_key(BRANCH, "id"),
            "FK_Omzetgroepen_Id": foreign_key(BRANCH, nth("item.turnoverGroups", 0)),
            "SalesType": "item.salesItemType",
            "ItemType": "item.course.name",
            "Gebruiker": "item.user.name",
            "AangemaaktOp": utc_to_local("item.createdAt", zone),
            "Datum": written_date("item.workDay"),
            "ProductId": "item.product.id",
            "ProductNaam": "item.product.name",
            "GebruikersSessieId": "item.userShiftId",
            "Aantal": "item.itemCount",
            "Prijs": "item.price.value",
            "Valuta": "item.price.currency",
            "PrijsInclBTW": "item.price.includeVAT",
            "BTWTariefId": "item.price.VAT.id",
            "BTWPercentage": "item.price.VAT.percentage",
            "NettoBedragInclBTW": "item.netAmount.inclVAT",
            "NettoBedragExclBTW": "item.netAmount.exclVAT",
            "NettoBedragBTW": "item.netAmount.VAT",
            "BrutoBedragInclBTW": "item.grossAmount.inclVAT",
            "BrutoBedragExclBTW": "item.grossAmount.exclVAT",
            "BrutoBedragBTW": "item.grossAmount.VAT",
            "ProductGroep1": nth("item.productGroups", 0),
            "ProductGroep2": nth("item.productGroups", 1),
        },
    )


def payment_items(df: DataFrame, *, zone: str = ZONE) -> DataFrame:
    return explode_children(
        df,
        {"item": "paymentItems"},
        {
            "Id": tenant_key(BRANCH, "item.id"),
            "FK_Orders_Id": foreign_key(BRANCH, "id"),
            "Gebruiker": "item.user.name",
            "AangemaaktOp": utc_to_local("item.createdAt", zone),
            "Datum": written_date("item.workDay"),
            "Bedrag": "item.amount",
            "ValutaCode": "item.currency.code",
            "ValutaKoers": "item.currency.rate",
            "GebruikerSessieId": "item.shiftId",
            "ExternId": "item.payment.externalId",
            "BetalingBedrag": "item.payment.amount",
            "BetalingsmethodeId": "item.payment.method.id",
            "BetalingsmethodeNaam": "item.payment.method.name",
            "BetalingsmethodeTypeNaam": "item.payment.methodType.name",
        },
    )


def salespoints(df: DataFrame) -> DataFrame:
    """Sales points of all levels as one list with parents; the level is the type."""
    return flatten_tree(
        df,
        {
            "Id": tenant_key(BRANCH, "node.id"),
            "Type": F.concat(F.lit("Level"), F.col("level") + 1),
            BRANCH: BRANCH,
            "LocatieId": "_store_id",
            "VerkooppuntId": "node.id",
            "Naam": "node.name",
            "ParentVerkooppuntId": tenant_key(BRANCH, "parent.id"),
        },
        fields=["name"],
        groups="salesPoints",
        depth=SUB_LEVELS,
    )


def stores(df: DataFrame) -> DataFrame:
    return project(
        df, {"Id": tenant_key(BRANCH, "id"), BRANCH: BRANCH, "LocatieId": "id", "Naam": "name"}
    )


def turnover_groups(df: DataFrame) -> DataFrame:
    """Groups with the group above them; a group without one is its own main group."""
    related = with_parent(
        df,
        key=tenant_key(BRANCH, "id"),
        parent_key=foreign_key(BRANCH, "parentID"),
        name="name",
        parent_key_name="ParentId",
        parent_name="HoofdOmzetgroep",
    )
    groups = project(
        related,
        {
            "Id": tenant_key(BRANCH, "id"),
            BRANCH: BRANCH,
            "Omzetgroep": "id",
            "Naam": "name",
            "ParentId": "ParentId",
            "HoofdOmzetgroep": "HoofdOmzetgroep",
        },
    )
    return distinct_rows(groups)


ENTITIES = {
    "orders": Entity(orders),
    "sales_items": Entity(
        sales_items,
        payload="orders",
        reads=(
            "id",
            "salesItems.id",
            "salesItems.turnoverGroups",
            "salesItems.salesItemType",
            "salesItems.course.name",
            "salesItems.user.name",
            "salesItems.createdAt",
            "salesItems.workDay",
            "salesItems.product",
            "salesItems.userShiftId",
            "salesItems.itemCount",
            "salesItems.price.value",
            "salesItems.price.currency",
            "salesItems.price.includeVAT",
            "salesItems.price.VAT.id",
            "salesItems.price.VAT.percentage",
            "salesItems.netAmount.inclVAT",
            "salesItems.netAmount.exclVAT",
            "salesItems.netAmount.VAT",
            "salesItems.grossAmount.inclVAT",
            "salesItems.grossAmount.exclVAT",
            "salesItems.grossAmount.VAT",
            "salesItems.productGroups",
        ),
    ),
    "payment_items": Entity(
        payment_items,
        payload="orders",
        reads=(
            "id",
            "paymentItems.id",
            "paymentItems.user.name",
            "paymentItems.createdAt",
            "paymentItems.workDay",
            "paymentItems.amount",
            "paymentItems.currency",
            "paymentItems.shiftId",
            "paymentItems.payment.externalId",
            "paymentItems.payment.amount",
            "paymentItems.payment.method",
            "paymentItems.payment.methodType.name",
        ),
    ),
    "salespoints": Entity(salespoints, rowwise=False),
    "stores": Entity(stores),
    "turnover_groups": Entity(turnover_groups, rowwise=False),
}
