"""Workforce planning: employees, contracts, departments, worked hours."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from refinery.functions import full_name, parse_date, parse_timestamp, written_date
from refinery.operators import distinct_rows, explode_children, flatten_tree, project
from refinery.plans.entities.entity import Entity

# The record layouts. The tree is declared two groups deep; what lies below
# stays text.
DEPARTMENT_FIELDS = """id: int, name: string, type: string, created: string, modified: string,
    costCenterId: int, costCenterName: string, active: boolean"""
DEPARTMENTS = f"array<struct<{DEPARTMENT_FIELDS}>>"
GROUPS_2 = f"array<struct<{DEPARTMENT_FIELDS}, departmentGroups: array<string>, departments: {DEPARTMENTS}>>"
GROUPS_1 = f"array<struct<{DEPARTMENT_FIELDS}, departmentGroups: {GROUPS_2}, departments: {DEPARTMENTS}>>"
CONTRACTS = """array<struct<contractReference: string, officeId: int, type: int, start: string, end: string,
    hoursPerWeek: double, daysPerWeek: double, hourlySalary: double, maxHoursPerWeek: double>>"""
SCHEMAS = {
    "department_tree": f"""
        id int,
        name string,
        type string,
        created string,
        modified string,
        addressId int,
        costCenterId int,
        costCenterName string,
        active boolean,
        departmentGroups {GROUPS_1},
        departments {DEPARTMENTS}""",
    "employee": f"""
        employeeId int,
        initials string,
        firstName string,
        lastNamePrefix string,
        lastName string,
        nameFormat string,
        maritalStatus string,
        partnerInitials string,
        partnerFirstName string,
        partnerLastNamePrefix string,
        partnerLastName string,
        gender string,
        phoneNumber string,
        phoneNumber2 string,
        email string,
        dateOfBirth string,
        placeOfBirth string,
        streetName string,
        streetNumber string,
        postalCode string,
        city string,
        nationality string,
        employmentStart string,
        employmentEnd string,
        personnelNumber string,
        costCenter string,
        probationDate string,
        employerReferenceId string,
        jobDescription string,
        employments array<int>,
        contracts {CONTRACTS},
        customFields array<string>""",
    "registered_hours": """
        id int,
        employeeId int,
        personnelNumber string,
        firstName string,
        infix string,
        lastName string,
        employeeCostCenter string,
        contractTypeId int,
        contractType string,
        officeId int,
        officeName string,
        departmentId int,
        departmentName string,
        costCenterId int,
        costCenterName string,
        costCenterCode string,
        startDateTime string,
        endDateTime string,
        hourType string,
        hours double,
        status string,
        breakMinutes int,
        duration int,
        kilometers double,
        customExpenses array<string>,
        remark string""",
}

# Refined column -> field of a tree node.
NODE_COLUMNS = {
    "Naam": "name",
    "Type": "type",
    "AangemaaktOp": "created",
    "GewijzigdOp": "modified",
    "KostenplaatsId": "costCenterId",
    "KostenplaatsNaam": "costCenterName",
    "Actief": "active",
}


def employees(df: DataFrame) -> DataFrame:
    return project(
        df,
        {
            "MedewerkerId": "employeeId",
            "Geboortedatum": parse_date("dateOfBirth"),
            "Naam": full_name("firstName", "lastNamePrefix", "lastName"),
            "DienstverbandStart": parse_date("employmentStart"),
            "DienstverbandEinde": parse_date("employmentEnd"),
            "Personeelsnummer": "personnelNumber",
            "Kostenplaats": "costCenter",
        },
    )


def employee_contracts(df: DataFrame) -> DataFrame:
    """One row per contract; a contract that is delivered more than once counts once."""
    lines = explode_children(
        df,
        {"contract": "contracts"},
        {
            "Id": "contract.contractReference",
            "FK_Medewerker_Id": "employeeId",
            "VestigingId": "contract.officeId",
            "ContractType": "contract.type",
            "StartDatum": parse_date("contract.start"),
            "EindDatum": parse_date("contract.end"),
            "UrenPerWeek": "contract.hoursPerWeek",
            "DagenPerWeek": "contract.daysPerWeek",
            "Uurloon": "contract.hourlySalary",
            "MaxUrenPerWeek": "contract.maxHoursPerWeek",
        },
    )
    return distinct_rows(lines)


def department_tree(df: DataFrame) -> DataFrame:
    """Offices, groups of departments and departments as one list with parents.

    Ids are not qualified by kind: an office and a department may carry the same one.
    """
    return flatten_tree(
        df,
        {
            "Id": F.col("node.id").cast("string"),
            **{name: f"node.{field}" for name, field in NODE_COLUMNS.items()},
            "ParentId": F.col("parent.id").cast("string"),
        },
        fields=list(NODE_COLUMNS.values()),
        groups="departmentGroups",
        leaves="departments",
        depth=2,
        orphans=True,
    )


def registered_hours(df: DataFrame) -> DataFrame:
    """Worked hours. ``Datum`` is the day as written, whatever offset the time carries."""
    return project(
        df,
        {
            "Id": "id",
            "FK_Medewerker_Id": "employeeId",
            "FK_Afdeling_Id": "departmentId",
            "Personeelsnummer": "personnelNumber",
            "Naam": full_name("firstName", "infix", "lastName"),
            "MedewerkerKostenplaats": "employeeCostCenter",
            "ContractTypeId": "contractTypeId",
            "ContractType": "contractType",
            "Datum": written_date("startDateTime"),
            "StartTijdstip": parse_timestamp("startDateTime"),
            "EindTijdstip": parse_timestamp("endDateTime"),
            "UurType": "hourType",
            "Uren": "hours",
            "Status": "status",
            "PauzeMinuten": "breakMinutes",
            "Duur": "duration",
        },
    )


ENTITIES = {
    "employee": Entity(employees),
    "employee_contract": Entity(employee_contracts, payload="employee", rowwise=False),
    "department_tree": Entity(department_tree, rowwise=False),
    "registered_hours": Entity(registered_hours),
}
