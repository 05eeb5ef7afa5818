"""One query or more per operator.

Nested inputs are made row by row from the given tables, so that no group is ever collected:
a delivery is a line with its packages, a visit is an order with stops and parcels.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from refinery import functions as fn
from refinery import operators as op
from refinery import sources
from refinery.plans.queries.payloads import Children, numbered
from refinery.plans.queries.query import Catalog, table
from refinery.session import work_folder
from refinery.streaming import merge_stream

CATALOG = Catalog()
query = CATALOG.add

AS_OF = "1998-06-01"


DELIVERED = Children(
    {
        "nr": "case when i = 2 and l_partkey % 5 = 0 then null else i end",
        "weight": "l_quantity + i",
        "price": "l_extendedprice + i",
        "label": "l_returnflag || cast(i as string)",
        "kind": "(l_partkey + i) % 3",
    },
    count="l_linenumber % 4",
    missing="l_quantity < 3",
)


def deliveries(spark: SparkSession, folder: str) -> DataFrame:
    """Lines with 0 to 3 packages; small quantities have no package list at all."""
    return table(spark, folder, "lineitem").selectExpr(
        "l_orderkey", "l_partkey", "l_linenumber", "l_returnflag", f"{DELIVERED.array()} as packages"
    )


# The same lines for the oracle.
PACKAGES = """
    SELECT l_orderkey, l_partkey, l_linenumber, l_returnflag,
           CASE WHEN i = 2 AND l_partkey % 5 = 0 THEN NULL ELSE i END AS nr,
           l_quantity + i AS weight, l_extendedprice + i AS price,
           l_returnflag || CAST(i AS VARCHAR) AS label, (l_partkey + i) % 3 AS kind
    FROM lineitem, unnest([1, 2, 3]) AS t(i)
    WHERE l_quantity >= 3 AND i <= l_linenumber % 4"""


PARCELS = numbered(
    "named_struct('parcel', i * 10 + j, 'value', o_totalprice + j)", "j", 2, "(o_orderkey + i) % 3"
)
STOPS = numbered(
    f"named_struct('stop', i, 'parcels', case when o_orderkey % 7 > 0 then {PARCELS} end)", "i", 3, "o_orderkey % 4"
)


def visits(spark: SparkSession, folder: str) -> DataFrame:
    """Orders with 0 to 3 stops, each with 0 to 2 parcels."""
    return table(spark, folder, "orders").selectExpr("o_orderkey", "o_custkey", f"{STOPS} as stops")


# --- sources -------------------------------------------------------------------------------


@query("table_read", "SELECT o_orderkey, o_orderstatus FROM orders")
def _(spark: SparkSession, folder: str) -> DataFrame:
    orders = sources.read_table(spark, f"{folder}/orders.parquet")
    return orders.select("o_orderkey", "o_orderstatus")


@query(
    "json_entity_read",
    """SELECT event_id, user_id, event_type, CAST(json_extract(props, '$.k') AS INTEGER) AS k,
              CAST(NULL AS VARCHAR) AS note
       FROM events""",
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    """Records written as JSON text, one per line, and read back by an explicit schema."""
    path = work_folder(spark, "events-json")
    events = table(spark, folder, "events")
    records = events.selectExpr(
        "event_id", "user_id", "event_type", "value", "from_json(props, 'k int') as props"
    )
    sources.write_table(records, path, fmt="json")
    schema = "event_id bigint, user_id bigint, event_type string, props struct<k: int>, note string"
    return sources.read_entity(spark, path, schema).select(
        "event_id", "user_id", "event_type", "props.k", "note"
    )


@query(
    "json_schema_read",
    "SELECT event_id, CAST(json_extract(props, '$.k') AS INTEGER) AS k, CAST(NULL AS VARCHAR) AS note FROM events",
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    events = table(spark, folder, "events")
    parsed = events.withColumn("record", sources.read_json_column("props", "k int, note string"))
    return parsed.select("event_id", "record.k", "record.note")


@query(
    "context_columns",
    "SELECT o_orderkey, o_custkey, 'north' AS tenant, 7 AS batch, 'req-' || o_orderpriority AS request FROM orders",
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    orders = table(spark, folder, "orders")
    request = F.concat(F.lit("req-"), F.col("o_orderpriority"))
    tagged = op.with_context(orders, tenant="north", batch=7, request=request)
    return tagged.select("o_orderkey", "o_custkey", "tenant", "batch", "request")


@query(
    "conform_schema",
    """SELECT CAST(l_orderkey AS INTEGER) AS l_orderkey, CAST(NULL AS VARCHAR) AS remark,
              CAST(nr AS VARCHAR) AS nr, price AS price, CAST(NULL AS BOOLEAN) AS fragile
       FROM (""" + PACKAGES + ")",
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    """Missing fields are NULL, undeclared ones go, types are brought in line, arrays included."""
    wanted = T.StructType.fromDDL(
        "l_orderkey int, remark string, packages array<struct<nr: string, price: double, fragile: boolean>>"
    )
    fitted = sources.conform(deliveries(spark, folder), wanted)
    columns = {"l_orderkey": "l_orderkey", "remark": "remark"}
    children = {name: f"package.{name}" for name in ("nr", "price", "fragile")}
    return op.explode_children(fitted, {"package": "packages"}, {**columns, **children})


# --- projections ---------------------------------------------------------------------------


@query(
    "rename_project",
    """SELECT l_orderkey AS order_id, l_linenumber AS line_nr, l_quantity AS quantity,
              l_extendedprice AS amount, l_shipdate AS shipped
       FROM lineitem""",
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    return op.project(
        table(spark, folder, "lineitem"),
        {
            "order_id": "l_orderkey",
            "line_nr": "l_linenumber",
            "quantity": "l_quantity",
            "amount": "l_extendedprice",
            "shipped": "l_shipdate",
        },
    )


@query(
    "struct_paths",
    """SELECT c_custkey AS id, CASE WHEN c_custkey % 10 > 0 THEN c_name END AS name,
              CASE WHEN c_custkey % 10 > 0 THEN c_mktsegment END AS segment,
              CASE WHEN c_custkey % 10 > 0 THEN c_nationkey END AS nation
       FROM customer""",
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    """A struct per row as a table of its own; a missing struct keeps its row."""
    nested = table(spark, folder, "customer").selectExpr(
        "c_custkey as id",
        """case when c_custkey % 10 > 0 then named_struct(
             'name', c_name, 'market', named_struct('segment', c_mktsegment, 'nation', c_nationkey)) end as person""",
    )
    return op.project(
        nested,
        {"id": "id", "name": "person.name", "segment": "person.market.segment", "nation": "person.market.nation"},
    )


@query(
    "rekey_passthrough",
    """SELECT p_brand || '_' || CAST(p_partkey AS VARCHAR) AS Id, p_brand, p_name, p_type, p_size, p_retailprice
       FROM part""",
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    part = table(spark, folder, "part")
    return op.rekey(part, fn.tenant_key("p_brand", "p_partkey"), first=["p_brand"], drop=["p_partkey"])


@query(
    "const_columns",
    """SELECT s_suppkey, 'supplier' AS kind, CAST(NULL AS VARCHAR) AS parent, CAST(NULL AS DOUBLE) AS rating
       FROM supplier""",
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    return op.project(
        table(spark, folder, "supplier"),
        {
            "s_suppkey": "s_suppkey",
            "kind": fn.const("supplier"),
            "parent": fn.const(None, "string"),
            "rating": fn.const(None, "double"),
        },
    )


@query(
    "snapshot_stamp",
    """SELECT o_orderkey, DATE '1998-06-01' AS snapshot_date, TIMESTAMP '1998-06-01 06:30:00' AS added_at
       FROM orders""",
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    orders = table(spark, folder, "orders").select("o_orderkey")
    added = F.lit("1998-06-01 06:30:00").cast("timestamp_ntz")
    return op.stamp(orders, AS_OF, added_at=added)


# --- keys and values -----------------------------------------------------------------------


@query(
    "composite_keys",
    """SELECT l_returnflag || '_' || CAST(l_orderkey AS VARCHAR) || '_' || CAST(l_linenumber AS VARCHAR) AS id,
              l_returnflag || '_' || CAST(l_partkey AS VARCHAR) AS part_id,
              l_returnflag || '_' || CAST(nullif(l_suppkey % 10, 0) AS VARCHAR) AS supplier_id,
              l_quantity
       FROM lineitem""",
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    """A missing part makes the whole key NULL."""
    return op.project(
        table(spark, folder, "lineitem"),
        {
            "id": fn.tenant_key("l_returnflag", "l_orderkey", "l_linenumber"),
            "part_id": fn.foreign_key("l_returnflag", "l_partkey"),
            "supplier_id": fn.foreign_key("l_returnflag", F.nullif(F.col("l_suppkey") % 10, F.lit(0))),
            "l_quantity": "l_quantity",
        },
    )


NAME_PARTS = (
    "split_part(p_name, ' ', 1)",
    "case when p_partkey % 3 = 0 then '' when p_partkey % 3 = 1 then null else 'van' end",
    "case when p_partkey % 4 = 0 then '' else split_part(p_name, ' ', 2) end",
)


@query(
    "full_name",
    f"""SELECT p_partkey,
               concat_ws(' ', nullif({NAME_PARTS[0]}, ''), nullif({NAME_PARTS[1]}, ''), nullif({NAME_PARTS[2]}, ''))
                 AS full_name
        FROM part""",
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    parts = [F.expr(part) for part in NAME_PARTS]
    return op.project(table(spark, folder, "part"), {"p_partkey": "p_partkey", "full_name": fn.full_name(*parts)})


@query(
    "prefix_class",
    """SELECT o_orderkey,
              CASE WHEN substr(o_orderpriority, 1, 1) IN ('1', '2') THEN substr(o_orderpriority, 1, 1)
                   ELSE '9' END AS priority,
              substr(strftime(o_orderdate, '%H:%M:%S.000'), 1, 8) AS clock
       FROM orders""",
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    return op.project(
        table(spark, folder, "orders"),
        {
            "o_orderkey": "o_orderkey",
            "priority": fn.prefix_class("o_orderpriority", 1, ("1", "2"), default="9"),
            "clock": fn.time_of_day(F.date_format("o_orderdate", "HH:mm:ss.SSS")),
        },
    )


@query(
    "code_lookup",
    """SELECT c_custkey,
              CASE c_mktsegment WHEN 'BUILDING' THEN 'construction' WHEN 'AUTOMOBILE' THEN 'cars'
                                ELSE c_name END AS label,
              CASE c_mktsegment WHEN 'BUILDING' THEN 1 WHEN 'MACHINERY' THEN 2 ELSE 0 END AS code
       FROM customer""",
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    """Labels with a column, or a constant, for codes the dictionary lacks."""
    return op.project(
        table(spark, folder, "customer"),
        {
            "c_custkey": "c_custkey",
            "label": fn.lookup(
                "c_mktsegment", {"BUILDING": "construction", "AUTOMOBILE": "cars"}, default=F.col("c_name")
            ),
            "code": fn.lookup("c_mktsegment", {"BUILDING": 1, "MACHINERY": 2}, default=0),
        },
    )


@query(
    "code_lookup_map",
    """SELECT p_partkey, CASE WHEN CAST(substr(p_brand, 7) AS INTEGER) BETWEEN 1 AND 20
                              THEN 'maker ' || substr(p_brand, 7) ELSE 'other' END AS maker
       FROM part""",
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    makers = {f"Brand#{number}": f"maker {number}" for number in range(1, 21)}
    part = table(spark, folder, "part")
    return op.project(part, {"p_partkey": "p_partkey", "maker": fn.lookup("p_brand", makers, default="other")})


@query(
    "dimension_lookup",
    """SELECT l_orderkey, l_linenumber, CASE WHEN l_linenumber > 5 THEN -l_partkey ELSE l_partkey END AS part,
              coalesce(p_type, 'unknown') AS part_type
       FROM lineitem
       LEFT JOIN part ON p_partkey = CASE WHEN l_linenumber > 5 THEN -l_partkey ELSE l_partkey END""",
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    labelled = op.lookup_join(
        # Late lines carry a code that no part has.
        table(spark, folder, "lineitem").selectExpr(
            "l_orderkey", "l_linenumber", "if(l_linenumber > 5, -l_partkey, l_partkey) as part"
        ),
        table(spark, folder, "part"),
        on="part",
        code="p_partkey",
        label="p_type",
        name="part_type",
        default=F.lit("unknown"),
    )
    return labelled


@query(
    "sane_date_fallback",
    """WITH typed AS (
         SELECT o_orderkey, CAST(o_orderdate AS DATE) AS submitted,
                try_cast(CASE o_orderkey % 5 WHEN 0 THEN '2926-03-01' WHEN 1 THEN '1925-03-01'
                              WHEN 2 THEN 'next week' ELSE substr(CAST(o_orderdate AS VARCHAR), 1, 10) END AS DATE)
                  AS visit,
                CASE WHEN o_orderkey % 2 = 0 THEN DATE '1997-05-05' END AS other_visit
         FROM orders)
       SELECT o_orderkey,
              coalesce(CASE WHEN coalesce(visit, other_visit) BETWEEN DATE '1996-01-01' AND DATE '1998-06-02'
                            THEN coalesce(visit, other_visit) END, submitted) AS report_date,
              CASE WHEN visit >= DATE '1996-01-01' THEN visit END AS visit_date
       FROM typed""",
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    """A typed date counts only in a sane window; else the system's own date stands in."""
    typed = fn.parse_date(
        F.expr("""case o_orderkey % 5 when 0 then '2926-03-01' when 1 then '1925-03-01'
                  when 2 then 'next week' else substr(cast(o_orderdate as string), 1, 10) end""")
    )
    other = F.expr("case when o_orderkey % 2 = 0 then date '1997-05-05' end")
    first, last = F.lit("1996-01-01").cast("date"), F.date_add(fn.as_of_date(AS_OF), 1)
    return op.project(
        table(spark, folder, "orders"),
        {
            "o_orderkey": "o_orderkey",
            "report_date": fn.preferred_date([typed, other], fn.instant_date("o_orderdate"), first, last),
            "visit_date": fn.clamp_to_null(typed, low=first),
        },
    )


@query(
    "utc_to_local",
    "SELECT event_id, ts AT TIME ZONE 'UTC' AT TIME ZONE 'Europe/Amsterdam' AS local_ts FROM events",
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    return op.project(table(spark, folder, "events"), {"event_id": "event_id", "local_ts": fn.utc_to_local("ts")})


@query(
    "cents_to_decimal",
    """SELECT o_orderkey, CAST(CAST(CAST(CAST(round(o_totalprice * 100) AS BIGINT) AS DECIMAL(18, 0)) / 100
                                    AS DECIMAL(18, 2)) AS DOUBLE) AS amount,
              CASE WHEN o_totalprice * 1000 < 99999999.5 THEN
                CAST(CAST(round(o_totalprice * 1000) AS BIGINT) / 100 AS DOUBLE) END AS large_amount
       FROM (SELECT o_orderkey, CAST(o_totalprice AS DECIMAL(18, 2)) AS o_totalprice FROM orders)""",
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    """Integer cents to an amount; what does not fit the target is NULL."""
    price = F.col("o_totalprice").cast("decimal(18,2)")
    return op.project(
        table(spark, folder, "orders"),
        {
            "o_orderkey": "o_orderkey",
            "amount": fn.cents_to_decimal((price * 100).cast("bigint")),
            "large_amount": fn.cents_to_decimal((price * 1000).cast("bigint")),
        },
    )


ODD_MONTH = """substr(cast(o_orderdate as string), 1, 5)
    || lpad(cast(month(o_orderdate) + o_orderkey % 3 as string), 2, '0') || '-01'"""
NUMBER_TEXT = """case o_orderkey % 4 when 0 then cast(o_orderkey as string) when 1 then 'none'
    when 2 then cast(o_orderkey as string) || '.7' else null end"""


@query(
    "tolerant_parse",
    f"""SELECT o_orderkey, try_cast({ODD_MONTH.replace("string", "varchar")} AS DATE) AS day,
               try_cast({ODD_MONTH.replace("string", "varchar")} || ' 10:20:30' AS TIMESTAMP) AS moment,
               CASE o_orderkey % 4 WHEN 0 THEN CAST(o_orderkey AS INTEGER)
                                   WHEN 2 THEN CAST(o_orderkey AS INTEGER) END AS number
        FROM orders""",
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    """Some months are 13 or 14, some numbers no numbers: those are NULL, and nothing throws."""
    return op.project(
        table(spark, folder, "orders"),
        {
            "o_orderkey": "o_orderkey",
            "day": fn.parse_date(F.expr(ODD_MONTH)),
            "moment": fn.parse_timestamp(F.concat(F.expr(ODD_MONTH), F.lit(" 10:20:30"))),
            "number": fn.parse_int(F.expr(NUMBER_TEXT)),
        },
    )


@query(
    "written_date",
    """SELECT event_id, CAST(ts AS DATE) AS written, CAST(ts + INTERVAL 5 HOUR AS DATE) AS instant_utc,
              CAST((ts + INTERVAL 5 HOUR) AT TIME ZONE 'UTC' AT TIME ZONE 'Europe/Amsterdam' AS DATE) AS instant_local
       FROM events""",
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    """A time five hours behind UTC: the day it says, and the day it is elsewhere."""
    text = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'-05:00'")
    return op.project(
        table(spark, folder, "events"),
        {
            "event_id": "event_id",
            "written": fn.written_date(text),
            "instant_utc": fn.instant_date(text, "UTC"),
            "instant_local": fn.instant_date(text, "Europe/Amsterdam"),
        },
    )


@query(
    "flags",
    """SELECT o_orderkey, coalesce(nullif(o_orderstatus, 'P') = 'F', FALSE) AS finished,
              CASE WHEN o_orderstatus <> 'P' THEN o_orderstatus END AS settled
       FROM orders""",
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    status = F.nullif(F.col("o_orderstatus"), F.lit("P"))
    blanked = F.when(F.col("o_orderstatus") == "P", "").otherwise(F.col("o_orderstatus"))
    return op.project(
        table(spark, folder, "orders"),
        {"o_orderkey": "o_orderkey", "finished": fn.flag(status == "F"), "settled": fn.blank_to_null(blanked)},
    )


# --- filters -------------------------------------------------------------------------------


@query(
    "require_and_members",
    """SELECT event_id, event_type, value FROM events
       WHERE event_type IN ('purchase', 'signup') AND value > 10 AND value IS NOT NULL AND user_id IS NOT NULL""",
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    wanted = F.col("event_type").isin("purchase", "signup") & (F.col("value") > 10)
    known = op.require(table(spark, folder, "events"), "value", "user_id")
    return known.filter(wanted).select("event_id", "event_type", "value")


@query(
    "recent_window",
    "SELECT o_orderkey, o_orderdate FROM orders WHERE o_orderdate > DATE '1998-06-01' - INTERVAL 14 DAY",
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    return op.recent(table(spark, folder, "orders"), "o_orderdate", 14, AS_OF).select("o_orderkey", "o_orderdate")


# --- nested data ---------------------------------------------------------------------------


@query("explode_lines", f"SELECT l_orderkey, nr, weight, label FROM ({PACKAGES}) WHERE nr IS NOT NULL")
def _(spark: SparkSession, folder: str) -> DataFrame:
    return op.explode_children(
        deliveries(spark, folder),
        {"package": "packages"},
        {"l_orderkey": "l_orderkey", "nr": "package.nr", "weight": "package.weight", "label": "package.label"},
        require=["package.nr"],
    )


@query("explode_lines_pruned", f"SELECT l_orderkey, nr, price FROM ({PACKAGES})")
def _(spark: SparkSession, folder: str) -> DataFrame:
    return op.explode_children(
        deliveries(spark, folder),
        {"package": "packages"},
        {"l_orderkey": "l_orderkey", "nr": "package.nr", "price": "package.price"},
        fields=["nr", "price"],
    )


@query(
    "explode_two_levels",
    """SELECT o_orderkey, i AS stop, i * 10 + j AS parcel, o_totalprice + j AS value
       FROM orders, unnest([1, 2, 3]) AS s(i), unnest([1, 2]) AS p(j)
       WHERE i <= o_orderkey % 4 AND o_orderkey % 7 > 0 AND j <= (o_orderkey + i) % 3""",
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    return op.explode_children(
        visits(spark, folder),
        {"stop": "stops", "parcel": "stop.parcels"},
        {"o_orderkey": "o_orderkey", "stop": "stop.stop", "parcel": "parcel.parcel", "value": "parcel.value"},
    )


@query(
    "array_nth",
    """SELECT l_orderkey, l_linenumber, l_partkey,
              CASE WHEN l_quantity >= 3 AND l_linenumber % 4 >= 1 THEN l_returnflag || '1' END AS first_label,
              CASE WHEN l_quantity >= 3 AND l_linenumber % 4 >= 3 THEN l_returnflag || '3' END AS third_label
       FROM lineitem""",
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    """Past the end of an array is NULL, not an error."""
    return op.project(
        deliveries(spark, folder),
        {
            "l_orderkey": "l_orderkey",
            "l_linenumber": "l_linenumber",
            "l_partkey": "l_partkey",
            "first_label": fn.nth("packages.label", 0),
            "third_label": fn.nth("packages.label", 2),
        },
    )


def trees(spark: SparkSession, folder: str) -> DataFrame:
    """Nations over shops over tills, with clerks at every level; two customers share a tree."""
    return table(spark, folder, "customer").selectExpr(
        "cast(c_custkey div 2 as int) as id",
        "'office' as name",
        """transform(slice(sequence(1, 2), 1, cast(c_custkey div 2 % 3 as int)), a -> named_struct(
             'id', case when a = 2 and c_custkey div 2 % 5 = 0 then null
                        else cast(c_custkey div 2 * 100 + a * 10 as int) end,
             'name', 'group',
             'groups', transform(slice(sequence(1, 2), 1, cast((c_custkey div 2 + a) % 3 as int)), b -> named_struct(
               'id', cast(c_custkey div 2 * 100 + a * 10 + b as int),
               'name', 'subgroup',
               'leaves', array(named_struct('id', cast(c_custkey div 2 % 50 as int), 'name', 'clerk')))),
             'leaves', cast(null as array<struct<id: int, name: string>>))) as groups""",
        """case when c_custkey div 2 % 4 > 0 then
             transform(slice(sequence(1, 2), 1, cast(c_custkey div 2 % 3 as int)), i ->
               named_struct('id', cast(c_custkey div 2 + i as int), 'name', 'department')) end as leaves""",
    )


TREES = """
    roots AS (SELECT DISTINCT CAST(c_custkey // 2 AS INTEGER) AS k FROM customer),
    groups AS (
      SELECT k, a, CASE WHEN NOT (a = 2 AND k % 5 = 0) THEN k * 100 + a * 10 END AS id
      FROM roots, unnest([1, 2]) AS g(a) WHERE a <= k % 3),
    subgroups AS (
      SELECT k, id AS parent, k * 100 + a * 10 + b AS id FROM groups, unnest([1, 2]) AS s(b) WHERE b <= (k + a) % 3)"""


@query(
    "tree_two_kinds",
    f"""WITH {TREES}
        SELECT k AS id, 'office' AS name, CAST(NULL AS INTEGER) AS parent_id FROM roots
        UNION
        SELECT k + i, 'department', k FROM roots, unnest([1, 2]) AS d(i) WHERE k % 4 > 0 AND i <= k % 3
        UNION
        SELECT id, 'group', k FROM groups WHERE id IS NOT NULL
        UNION
        SELECT id, 'subgroup', parent FROM subgroups
        UNION
        SELECT k % 50, 'clerk', id FROM subgroups""",
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    """Groups and leaves in one list; what hangs below a group without id keeps its row."""
    return op.flatten_tree(
        trees(spark, folder),
        {"id": "node.id", "name": "node.name", "parent_id": "parent.id"},
        fields=["name"],
        groups="groups",
        leaves="leaves",
        depth=2,
        orphans=True,
    )


@query(
    "tree_levels",
    f"""WITH {TREES}
        SELECT 'T_' || CAST(k AS VARCHAR) AS id, 'Level1' AS level, CAST(NULL AS VARCHAR) AS parent_id FROM roots
        UNION
        SELECT 'T_' || CAST(id AS VARCHAR), 'Level2', 'T_' || CAST(k AS VARCHAR) FROM groups WHERE id IS NOT NULL
        UNION
        SELECT 'T_' || CAST(id AS VARCHAR), 'Level3', 'T_' || CAST(parent AS VARCHAR)
        FROM subgroups WHERE parent IS NOT NULL""",
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    """Levels as labels and tenant-qualified ids; below a group without id nothing is kept."""
    columns = {
        "id": fn.tenant_key(F.lit("T"), "node.id"),
        "level": F.concat(F.lit("Level"), F.col("level") + 1),
        "parent_id": fn.tenant_key(F.lit("T"), "parent.id"),
    }
    return op.flatten_tree(trees(spark, folder), columns, fields=[], groups="groups", depth=2)


# --- relations -----------------------------------------------------------------------------


@query(
    "has_children",
    f"""SELECT l_orderkey, l_linenumber, l_partkey,
               l_orderkey IN (SELECT l_orderkey FROM ({PACKAGES})) AS has_packages
        FROM lineitem""",
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    """Orders come as many rows; all rows of an order share the flag."""
    flagged = op.has_children(deliveries(spark, folder), "l_orderkey", "packages", "has_packages")
    return flagged.select("l_orderkey", "l_linenumber", "l_partkey", "has_packages")


@query(
    "has_children_unique",
    "SELECT o_orderkey, o_orderkey % 4 > 0 AS has_stops FROM orders",
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    flagged = op.has_children(visits(spark, folder), "o_orderkey", "stops", "has_stops", unique_key=True)
    return flagged.select("o_orderkey", "has_stops")


@query(
    "parent_lookup",
    """WITH people AS (
         SELECT c_custkey AS id, c_name AS name,
                CASE WHEN c_custkey % 10 = 0 THEN NULL WHEN c_custkey % 10 = 1 THEN -c_custkey
                     WHEN c_custkey % 3 = 0 THEN 0 ELSE c_custkey // 2 END AS boss
         FROM customer)
       SELECT c.id AS id, c.name AS name, p.id AS parent_key, coalesce(p.name, c.name) AS parent_name
       FROM people c LEFT JOIN people p ON c.boss = p.id""",
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    """A third of all rows share one parent; some parents are missing, some unknown."""
    people = table(spark, folder, "customer").selectExpr(
        "c_custkey as id",
        "c_name as name",
        """case when c_custkey % 10 = 0 then null when c_custkey % 10 = 1 then -c_custkey
                when c_custkey % 3 = 0 then 0 else c_custkey div 2 end as boss""",
    )
    return op.with_parent(people, key="id", parent_key="boss", name="name").drop("boss")


# --- aggregations --------------------------------------------------------------------------


@query("child_count", f"SELECT l_orderkey, count(*) AS n FROM ({PACKAGES}) GROUP BY l_orderkey")
def _(spark: SparkSession, folder: str) -> DataFrame:
    return op.count_children(
        deliveries(spark, folder), "l_orderkey", "packages", key_name="l_orderkey", count_name="n"
    )


def line_rollup(spark: SparkSession, folder: str) -> DataFrame:
    return op.rollup_lines(
        deliveries(spark, folder),
        {"order_id": "l_orderkey", "label": "package.label"},
        {"weight": "package.weight", "price": "package.price", "nr": "package.nr"},
        arrays={"package": "packages"},
    )


query(
    "line_rollup",
    f"""SELECT l_orderkey AS order_id, label, CAST(sum(CAST(weight AS DECIMAL(28, 6))) AS DOUBLE) AS weight,
               CAST(sum(CAST(price AS DECIMAL(28, 6))) AS DOUBLE) AS price, CAST(sum(nr) AS BIGINT) AS nr
        FROM ({PACKAGES}) GROUP BY l_orderkey, label""",
)(line_rollup)


# Amounts with ten decimals: nothing may be rounded before it is added.
@query(
    "fine_line_rollup",
    """SELECT l_suppkey, CAST(sum(CAST(l_extendedprice * 0.0000000001 AS DECIMAL(38, 18))) AS DOUBLE) AS amount
       FROM (SELECT l_suppkey, CAST(l_extendedprice * 100 AS DECIMAL(20, 0)) * 0.01 AS l_extendedprice FROM lineitem)
       GROUP BY l_suppkey""",
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    fine = table(spark, folder, "lineitem").selectExpr(
        "l_suppkey", "cast(cast(l_extendedprice as decimal(20, 2)) * 0.0000000001 as double) as amount"
    )
    return op.rollup_lines(fine, {"l_suppkey": "l_suppkey"}, {"amount": "amount"})


@query(
    "wide_key_consolidation",
    """SELECT l_returnflag, l_linestatus, l_linenumber, l_suppkey, l_discount, l_tax, CAST(l_shipdate AS DATE) AS day,
              CAST(sum(CAST(l_quantity AS DECIMAL(28, 6))) AS DOUBLE) AS quantity,
              CAST(sum(CAST(l_extendedprice AS DECIMAL(28, 6))) AS DOUBLE) AS amount
       FROM lineitem GROUP BY ALL""",
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    keys = ["l_returnflag", "l_linestatus", "l_linenumber", "l_suppkey", "l_discount", "l_tax"]
    return op.rollup_lines(
        table(spark, folder, "lineitem"),
        {**{key: key for key in keys}, "day": fn.written_date("l_shipdate")},
        {"quantity": "l_quantity", "amount": "l_extendedprice"},
    )


@query(
    "bucket_pivot",
    """SELECT l_orderkey AS order_id, max(CASE WHEN l_returnflag = 'N' THEN l_quantity END) AS kept,
              max(CASE WHEN l_returnflag = 'A' THEN l_quantity END) AS accepted,
              max(CASE WHEN l_returnflag = 'R' THEN l_quantity END) AS returned
       FROM lineitem GROUP BY l_orderkey""",
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    return op.bucket_pivot(
        table(spark, folder, "lineitem"),
        {"order_id": "l_orderkey"},
        "l_returnflag",
        {"N": "kept", "A": "accepted", "R": "returned"},
        "l_quantity",
    )


@query(
    "bucket_columns",
    f"""SELECT l.l_orderkey AS l_orderkey, l.l_linenumber AS l_linenumber, l.l_partkey AS l_partkey, k0, k1, k2
        FROM (SELECT row_number() OVER () AS r, * FROM lineitem) l
        LEFT JOIN (
          SELECT r, max(CASE WHEN kind = 0 THEN weight END) AS k0, max(CASE WHEN kind = 1 THEN weight END) AS k1,
                 max(CASE WHEN kind = 2 THEN weight END) AS k2
          FROM ({PACKAGES.replace("SELECT", "SELECT r,", 1).replace(
              "FROM lineitem", "FROM (SELECT row_number() OVER () AS r, * FROM lineitem)")})
          GROUP BY r) p ON p.r = l.r""",
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    """Buckets of an array in the same row: neither join nor shuffle."""
    lines = deliveries(spark, folder)
    buckets = op.bucket_columns("packages", "kind", "weight", {0: "k0", 1: "k1", 2: "k2"})
    keys = ("l_orderkey", "l_linenumber", "l_partkey")
    return op.project(lines, {**{key: key for key in keys}, **buckets})


# --- latest, sets --------------------------------------------------------------------------


@query(
    "latest_per_key",
    """SELECT * EXCLUDE (rn) FROM (
         SELECT *, row_number() OVER (
           PARTITION BY l_orderkey, l_linenumber
           ORDER BY l_shipdate DESC NULLS LAST, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax,
                    l_returnflag, l_linestatus) AS rn
         FROM lineitem) WHERE rn = 1""",
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    return op.latest_per_key(table(spark, folder, "lineitem"), ["l_orderkey", "l_linenumber"], "l_shipdate")


@query(
    "latest_event_per_user",
    """SELECT user_id, event_id, event_type, ts FROM (
         SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC NULLS LAST, event_id) AS rn FROM events)
       WHERE rn = 1""",
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    events = table(spark, folder, "events").select("user_id", "event_id", "event_type", "ts")
    return op.latest_per_key(events, ["user_id"], "ts", tie_break=["event_id"])


def half_known(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "orders").selectExpr(
        "case when o_custkey % 3 > 0 then o_custkey end as customer", "o_orderkey", "o_orderdate"
    )


LATEST_ORDER = """
    SELECT customer, o_orderkey, o_orderdate FROM (
      SELECT *, row_number() OVER (PARTITION BY customer ORDER BY o_orderdate DESC NULLS LAST, o_orderkey) AS rn
      FROM (SELECT CASE WHEN o_custkey % 3 > 0 THEN o_custkey END AS customer, o_orderkey, o_orderdate FROM orders))
    WHERE rn = 1"""


@query("latest_null_collapse", LATEST_ORDER)
def _(spark: SparkSession, folder: str) -> DataFrame:
    """A third of all rows have no key; together they count as one key."""
    return op.latest_per_key(half_known(spark, folder), ["customer"], "o_orderdate", tie_break=["o_orderkey"])


@query(
    "latest_null_keep",
    f"""{LATEST_ORDER} AND customer IS NOT NULL
        UNION ALL SELECT NULL, o_orderkey, o_orderdate FROM orders WHERE o_custkey % 3 = 0""",
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    return op.latest_per_key(
        half_known(spark, folder), ["customer"], "o_orderdate", tie_break=["o_orderkey"], null_keys="keep"
    )


@query("latest_null_drop", f"{LATEST_ORDER} AND customer IS NOT NULL")
def _(spark: SparkSession, folder: str) -> DataFrame:
    return op.latest_per_key(
        half_known(spark, folder), ["customer"], "o_orderdate", tie_break=["o_orderkey"], null_keys="drop"
    )


@query("row_distinct", "SELECT DISTINCT l_partkey, l_suppkey, l_returnflag FROM lineitem")
def _(spark: SparkSession, folder: str) -> DataFrame:
    return op.distinct_rows(table(spark, folder, "lineitem").select("l_partkey", "l_suppkey", "l_returnflag"))


def parties(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    customers = table(spark, folder, "customer").selectExpr("c_nationkey as nation", "c_acctbal < 0 as in_debt")
    suppliers = table(spark, folder, "supplier").selectExpr("s_acctbal < 0 as in_debt", "s_nationkey as nation")
    return op.align(customers, ["nation", "in_debt"]), suppliers


@query(
    "union_all",
    """SELECT c_nationkey AS nation, c_acctbal < 0 AS in_debt FROM customer
       UNION ALL SELECT s_nationkey, s_acctbal < 0 FROM supplier""",
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    return op.union_all(*parties(spark, folder))


@query(
    "union_distinct",
    """SELECT c_nationkey AS nation, c_acctbal < 0 AS in_debt FROM customer
       UNION SELECT s_nationkey, s_acctbal < 0 FROM supplier""",
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    return op.union_distinct(*parties(spark, folder))


# --- incremental loads ---------------------------------------------------------------------


@query(
    "incremental_read",
    """SELECT event_id, ts, value FROM events
       WHERE ts > TIMESTAMP '2024-01-20 00:00:00' - INTERVAL 2 DAY""",
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    events = table(spark, folder, "events").select("event_id", "ts", "value")
    return op.incremental(events, "ts", dt.datetime(2024, 1, 20), lookback=dt.timedelta(days=2))


@query("next_watermark", "SELECT max(ts) AS watermark FROM events")
def _(spark: SparkSession, folder: str) -> DataFrame:
    return op.next_watermark(table(spark, folder, "events"), "ts")


@query(
    "upsert_latest",
    """WITH updates AS (
         SELECT CASE WHEN o_orderkey % 2 = 0 THEN o_orderkey ELSE -o_orderkey END AS o_orderkey, 'U' AS o_orderstatus,
                o_orderdate + INTERVAL 30 DAY AS o_orderdate
         FROM orders WHERE o_orderkey % 3 = 0
         UNION ALL
         SELECT o_orderkey, 'L', o_orderdate + INTERVAL 60 DAY FROM orders WHERE o_orderkey % 6 = 0),
       newest AS (
         SELECT * EXCLUDE (rn) FROM (
           SELECT *, row_number() OVER (PARTITION BY o_orderkey ORDER BY o_orderdate DESC, o_orderstatus) AS rn
           FROM updates) WHERE rn = 1)
       SELECT o_orderkey, o_orderstatus, o_orderdate FROM orders
       WHERE o_orderkey NOT IN (SELECT o_orderkey FROM newest)
       UNION ALL SELECT o_orderkey, o_orderstatus, o_orderdate FROM newest""",
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    orders = table(spark, folder, "orders")
    first = orders.filter("o_orderkey % 3 = 0").selectExpr(
        "case when o_orderkey % 2 = 0 then o_orderkey else -o_orderkey end as o_orderkey",
        "'U' as o_orderstatus",
        "o_orderdate + interval 30 day as o_orderdate",
    )
    second = orders.filter("o_orderkey % 6 = 0").selectExpr(
        "o_orderkey", "'L' as o_orderstatus", "o_orderdate + interval 60 day as o_orderdate"
    )
    target = orders.select("o_orderkey", "o_orderstatus", "o_orderdate")
    return op.upsert(target, op.union_all(first, second), ["o_orderkey"], "o_orderdate", tie_break=["o_orderstatus"])


@query(
    "scd2_history",
    """WITH ordered AS (
         SELECT user_id, event_type, ts, event_id,
                lag(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS before,
                row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn
         FROM events),
       starts AS (SELECT * FROM ordered WHERE rn = 1 OR event_type IS DISTINCT FROM before),
       runs AS (SELECT *, lead(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS valid_to FROM starts)
       SELECT user_id, event_type, ts AS valid_from, valid_to, valid_to IS NULL AS is_current FROM runs""",
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    return op.scd2(table(spark, folder, "events"), ["user_id"], ["event_type"], "ts", tie_break=["event_id"])


@query(
    "snapshot_append",
    """SELECT s_suppkey, s_acctbal, DATE '1998-06-01' AS snapshot_date FROM supplier
       UNION ALL SELECT s_suppkey, s_acctbal + 1, DATE '1998-06-02' FROM supplier""",
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    """Two days are written, one of them twice: each day is there once."""
    path = work_folder(spark, "snapshots")
    suppliers = table(spark, folder, "supplier").select("s_suppkey", "s_acctbal")
    sources.write_snapshot(suppliers, path, "1998-06-01")
    sources.write_snapshot(suppliers, path, "1998-06-02")
    sources.write_snapshot(suppliers.withColumn("s_acctbal", F.col("s_acctbal") + 1), path, "1998-06-02")
    return spark.read.parquet(path)


# --- late changes, differences, deep trees, quarantine ---------------------------------------

# Errors come late, when the history of the other events is already there.
LATE = "event_type = 'error'"


@query("history_late_changes", CATALOG.queries["scd2_history"].oracle)
def _(spark: SparkSession, folder: str) -> DataFrame:
    """A stored history and late events give the history of all events; of the log only touched keys are read again."""
    events = table(spark, folder, "events")
    log, late = events.filter(f"not ({LATE})"), events.filter(LATE)
    history = sources.land(op.scd2(log, ["user_id"], ["event_type"], "ts", tie_break=["event_id"]))
    return op.merge_history(history, late, ["user_id"], ["event_type"], "ts", tie_break=["event_id"], log=log)


@query(
    "history_split_runs",
    f"""WITH kept AS (
         SELECT * FROM (
           SELECT user_id, event_type, ts, event_id, row_number() OVER w AS rn, lag(event_type) OVER w AS before
           FROM events WHERE NOT ({LATE}) WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id))
         WHERE rn = 1 OR event_type IS DISTINCT FROM before),
       changes AS (
         SELECT user_id, event_type, ts, 0 AS late, NULL::BIGINT AS event_id FROM kept
         UNION ALL SELECT user_id, event_type, ts, 1, event_id FROM events WHERE {LATE} AND value >= 20),
       ordered AS (
         SELECT *, lag(event_type) OVER w AS before, row_number() OVER w AS rn
         FROM changes WINDOW w AS (PARTITION BY user_id ORDER BY ts, late, event_id)),
       starts AS (SELECT * FROM ordered WHERE rn = 1 OR event_type IS DISTINCT FROM before),
       runs AS (SELECT *, lead(ts) OVER (PARTITION BY user_id ORDER BY ts, late, event_id) AS valid_to FROM starts)
       SELECT user_id, event_type, ts AS valid_from, valid_to, valid_to IS NULL AS is_current FROM runs""",
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    """Late events split the runs of a history kept in buckets; buckets without any stay as they are."""
    events = table(spark, folder, "events")
    path = work_folder(spark, "history")
    first = op.scd2(events.filter(f"not ({LATE})"), ["user_id"], ["event_type"], "ts", tie_break=["event_id"])
    sources.write_keyed(first, path, ["user_id"], buckets=16)
    late = events.filter(f"{LATE} and value >= 20")
    sources.merge_history_table(path, late, ["user_id"], ["event_type"], "ts", tie_break=["event_id"], buckets=16)
    return sources.read_keyed(spark, path)


# Who was active in the three days before a moment, and what they did last. Some rows come twice, some have no key.
_SNAPSHOT = """SELECT CASE WHEN user_id % 10 = 3 THEN NULL ELSE user_id END AS user_id, event_type, value
    FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id) AS rn FROM events
          WHERE ts > TIMESTAMP '{start}' AND ts <= TIMESTAMP '{end}')
    WHERE rn = 1"""
SNAPSHOTS = [
    _SNAPSHOT.format(start=f"2024-01-{day} 00:00:00", end=f"2024-01-{day + 3} 00:00:00") + f" AND value >= {least}"
    for day, least in ((10, 1), (11, 2))
]


def snapshots(spark: SparkSession, folder: str) -> list[DataFrame]:
    events = table(spark, folder, "events")
    return [spark.sql(sql.replace("FROM events", "FROM {events}"), events=events) for sql in SNAPSHOTS]


@query(
    "snapshot_difference",
    f"""WITH b AS (SELECT user_id, event_type, value, count(*) AS n FROM ({SNAPSHOTS[0]}) GROUP BY ALL),
       a AS (SELECT user_id, event_type, value, count(*) AS n FROM ({SNAPSHOTS[1]}) GROUP BY ALL),
       net AS (SELECT user_id, event_type, value, sum(n)::BIGINT AS n FROM (
                 SELECT * FROM a UNION ALL SELECT user_id, event_type, value, -n FROM b) GROUP BY ALL),
       d AS (SELECT *, user_id IS NOT NULL AND min(n) OVER (PARTITION BY user_id) < 0 AND max(n) OVER (PARTITION BY user_id) > 0 AS mixed
             FROM net WHERE n <> 0)
       SELECT user_id, event_type, value, abs(n) AS copies,
              CASE WHEN mixed THEN 'update_' || CASE WHEN n < 0 THEN 'before' ELSE 'after' END
                   WHEN n < 0 THEN 'delete' ELSE 'insert' END AS change
       FROM d""",
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    return op.snapshot_difference(*snapshots(spark, folder), ["user_id"])


@query("apply_difference", SNAPSHOTS[1])
def _(spark: SparkSession, folder: str) -> DataFrame:
    """The earlier snapshot and the difference give the later one, deletes and repeated rows included."""
    before, after = snapshots(spark, folder)
    return op.apply_difference(before, sources.land(op.snapshot_difference(before, after, ["user_id"])), ["user_id"])


# A customer's order hangs below the one before, the lines of an order below the order.
_CHAIN = """SELECT o_orderkey AS node, lag(o_orderkey) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS above
    FROM orders"""


@query(
    "tree_any_depth",
    f"""WITH RECURSIVE tree AS (
         SELECT node, node AS root, 0::BIGINT AS depth, [node] AS path FROM ({_CHAIN}) WHERE above IS NULL
         UNION ALL
         SELECT e.node, t.root, t.depth + 1, list_append(t.path, e.node) FROM ({_CHAIN}) e JOIN tree t ON e.above = t.node)
       SELECT node, root, depth, array_to_string(path, '>') AS path, false AS in_cycle FROM tree""",
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    """Chains as long as a customer has orders; the depth is in no schema."""
    chain = spark.sql(_CHAIN.replace("FROM orders", "FROM {orders}"), orders=table(spark, folder, "orders"))
    found = op.ancestry(chain, node="node", parent="above")
    return found.withColumn("path", F.array_join(F.transform("path", lambda n: n.cast("string")), ">"))


@query(
    "roots_over_levels",
    """WITH RECURSIVE edges AS (
         SELECT c_custkey AS node, CASE WHEN c_custkey % 50 = 7 THEN c_custkey % 100 + 50 * (c_custkey % 100 // 50 * -2 + 1)
                                        WHEN c_custkey > 1 THEN c_custkey // 2 END AS above
         FROM customer),
       up AS (
         SELECT node, above, node AS top, 0::BIGINT AS depth, above AS step FROM edges
         UNION ALL
         SELECT u.node, u.above, e.node, u.depth + 1, e.above FROM up u JOIN edges e ON u.step = e.node WHERE u.depth < 200),
       ends AS (SELECT node, top AS root, depth FROM up WHERE step IS NULL OR step NOT IN (SELECT node FROM edges))
       SELECT edges.node, root, depth, root IS NULL AS in_cycle FROM edges LEFT JOIN ends USING (node)""",
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    """Roots of a flat table whose rows name their parent, over all levels; some rows hang below a cycle."""
    above = """case when c_custkey % 50 = 7 then c_custkey % 100 + 50 * (c_custkey % 100 div 50 * -2 + 1)
                    when c_custkey > 1 then c_custkey div 2 end as above"""
    groups = table(spark, folder, "customer").selectExpr("c_custkey as node", above)
    return op.ancestry(groups, node="node", parent="above", path=False)


LOADED = {
    "id": "case when o_orderkey % 11 = 0 then 'no. ' || cast(o_orderkey as string) else cast(o_orderkey as string) end",
    "amount": "case when o_orderkey % 13 = 0 then 'n/a' else cast(o_orderkey % 700 as string) end",
    "day": "case when o_orderkey % 17 = 0 then '2024-02-30' when o_orderkey % 3 > 0 then '2024-02-28' end",
}


@query(
    "quarantine_cells",
    f"""WITH raw AS (SELECT o_orderkey AS k, {', '.join(f'{sql} AS {name}' for name, sql in LOADED.items())}, o_orderkey % 4 AS n FROM orders),
       cells AS (
         SELECT k, 'id' AS path, 'does not fit bigint' AS reason, id AS value FROM raw WHERE try_cast(id AS BIGINT) IS NULL
         UNION ALL SELECT k, 'amount', 'does not fit int', amount FROM raw WHERE try_cast(amount AS INT) IS NULL
         UNION ALL SELECT k, 'day', 'does not fit date', day FROM raw WHERE day IS NOT NULL AND try_cast(day AS DATE) IS NULL
         UNION ALL SELECT k, 'lines[' || CAST(i - 1 AS VARCHAR) || '].nr', 'does not fit int', 'x' FROM raw, unnest([1, 2, 3]) AS t(i)
                   WHERE i <= n AND k % 19 = i)
       SELECT k AS row, path, reason, value, NULL::BIGINT AS id FROM cells
       UNION ALL
       SELECT NULL, 'kept', NULL, NULL, CAST(id AS BIGINT) FROM raw WHERE k NOT IN (SELECT k FROM cells)""",
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    """Orders as loose text: what does not fit is told cell by cell, and the rows that fit go on."""
    line = "named_struct('nr', case when o_orderkey % 19 = i then 'x' else cast(i as string) end)"
    raw = table(spark, folder, "orders").selectExpr(
        "o_orderkey as k", *[f"{sql} as {name}" for name, sql in LOADED.items()], f"{numbered(line, 'i', 3, 'o_orderkey % 4')} as lines"
    )
    schema = T.StructType.fromDDL("id bigint, amount int, day date, lines array<struct<nr: int>>")
    found = sources.quarantine(raw, schema, carried=["k"])
    cells = found.cells.selectExpr("k as row", "path", "reason", "value", "cast(null as bigint) as id")
    kept = found.kept.selectExpr("cast(null as bigint) as row", "'kept' as path", "null as reason", "null as value", "id")
    return cells.unionByName(kept)


@query(
    "upsert_touched_buckets",
    """SELECT o_orderkey, CASE WHEN o_orderkey % 64 = 5 THEN 'N' ELSE o_orderstatus END AS o_orderstatus, o_orderdate FROM orders
       UNION ALL SELECT -o_orderkey, 'A', o_orderdate FROM orders WHERE o_orderkey % 64 = 5""",
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    """A table in buckets of keys takes updates; buckets without any keep their files."""
    path = work_folder(spark, "orders")
    orders = table(spark, folder, "orders").select("o_orderkey", "o_orderstatus", "o_orderdate")
    sources.write_keyed(orders, path, ["o_orderkey"], buckets=32)
    some = orders.filter("o_orderkey % 64 = 5")
    changed = some.selectExpr("o_orderkey", "'N' as o_orderstatus", "o_orderdate")
    added = some.selectExpr("-o_orderkey as o_orderkey", "'A' as o_orderstatus", "o_orderdate")
    sources.upsert_table(path, changed.unionByName(added), ["o_orderkey"], "o_orderdate", buckets=32)
    return sources.read_keyed(spark, path)


# Orders that are not finished, and customers of some segments, are taken to be missing.
RELATIONS = {
    "order": ("l_orderkey", "orders", "o_orderkey", "o_orderstatus = 'F'"),
    "part": ("l_partkey", "part", "p_partkey", "p_size > 5"),
    "supplier": ("l_suppkey", "supplier", "s_suppkey", "s_acctbal > 0"),
}


def relations(spark: SparkSession, folder: str) -> dict[str, op.Relation]:
    return {
        name: op.Relation(foreign, table(spark, folder, parent).filter(there), key)
        for name, (foreign, parent, key, there) in RELATIONS.items()
    }


@query(
    "orphan_report",
    " UNION ALL ".join(
        f"""SELECT '{name}' AS relation, CAST({foreign} AS VARCHAR) AS key, count(*) AS rows FROM lineitem
            WHERE {foreign} NOT IN (SELECT {key} FROM {parent} WHERE {there}) GROUP BY {foreign}"""
        for name, (foreign, parent, key, there) in RELATIONS.items()
    ),
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    """Foreign keys without parent, for all relations of a table."""
    return op.orphan_report(table(spark, folder, "lineitem"), relations(spark, folder))


@query(
    "orphan_rows",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_quantity FROM lineitem
       WHERE l_partkey NOT IN (SELECT p_partkey FROM part WHERE p_size > 5)""",
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    lines = table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity")
    return op.orphan_rows(lines, relations(spark, folder)["part"])


# What a first run read of the lines, and what a second one that looks back reads: some have come since, some were corrected.
FIRST_READ = """SELECT l_orderkey, l_linenumber, l_suppkey,
    CASE WHEN l_returnflag = 'R' THEN l_quantity + 1 ELSE l_quantity END AS l_quantity, l_extendedprice
    FROM lineitem WHERE l_linestatus = 'F' OR l_quantity < 30"""
LOOKED_BACK = "SELECT l_orderkey, l_linenumber, l_suppkey, l_quantity, l_extendedprice FROM lineitem WHERE l_quantity < 45"


@query(
    "lookback_rollup",
    f"""SELECT l_suppkey, count(*) AS rows, CAST(sum(CAST(l_quantity AS DECIMAL(18, 2))) AS DOUBLE) AS quantity,
              CAST(sum(CAST(l_extendedprice AS DECIMAL(18, 2))) AS DOUBLE) AS price
       FROM ({LOOKED_BACK}) GROUP BY l_suppkey""",
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    """A stored roll-up and signed deltas of what a second read shows give the roll-up of the second read."""
    lines = table(spark, folder, "lineitem")
    before, after = (spark.sql(sql.replace("FROM lineitem", "FROM {lines}"), lines=lines) for sql in (FIRST_READ, LOOKED_BACK))
    keys = {"l_suppkey": "l_suppkey"}
    sums = {"quantity": F.col("l_quantity").cast("decimal(18,2)"), "price": F.col("l_extendedprice").cast("decimal(18,2)")}
    stored = op.additive_rollup(before, keys, sums)
    changed = op.snapshot_difference(before, after, ["l_orderkey", "l_linenumber"])
    return op.apply_deltas(stored, op.rollup_deltas(changed, keys, sums), ["l_suppkey"])


@query(
    "stream_latest_per_user",
    """SELECT user_id, event_id, event_type, ts FROM (
         SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, user_id, event_id, event_type) AS rn FROM events)
       WHERE rn = 1""",
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    """Events as a stream of files, merged micro-batch by micro-batch into a table of the latest of each user."""
    landed, path = work_folder(spark, "landed-events"), work_folder(spark, "latest-events")
    events = table(spark, folder, "events").select("user_id", "event_id", "event_type", "ts")
    events.repartition(3, "event_id").write.parquet(landed)
    stream = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(landed)
    merge_stream(stream, path, ["user_id"], "ts", work_folder(spark, "stream-state"), buckets=8).awaitTermination()
    return sources.read_keyed(spark, path)
