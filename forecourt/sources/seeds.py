"""Reference (seed) data.

Seeds are version-controlled literals, so their size is known statically and
broadcasting them is always safe.
"""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

# ---------------------------------------------------------------- FIXED VALUES
# service_type_code, description, category, standard_hours
SERVICE_TYPE_CODES = """\
SVC-MIN,Minor service,routine,1.5
SVC-MAJ,Major service,routine,4.0
BRK-PAD,Brake pad replacement,brakes,1.5
BRK-DSC,Brake disc replacement,brakes,2.5
ENG-DIA,Engine diagnostics,engine,1.0
ENG-OVH,Engine overhaul,engine,24.0
SUS-SHK,Shock absorber replacement,suspension,3.0
ELE-BAT,Battery replacement,electrical,0.5
ELE-ALT,Alternator replacement,electrical,3.0
AC-REG,AC regas,climate,1.0
TYR-FIT,Tyre fitting,tyres,0.75
BDY-PNT,Body panel respray,bodywork,8.0"""

# valid_from, valid_to (both inclusive), vat_rate, note
VAT_RATES = """\
2015-01-01,2019-12-31,0.05,Pre-2020 VAT rate
2020-01-01,2099-12-31,0.075,Finance Act 2019"""

# raw_make, canonical_make (keys are case-sensitive)
VEHICLE_MAKE_ALIASES = """\
TOYOTA,Toyota
toyota,Toyota
Toyota Motors,Toyota
TOYOTA NIG,Toyota
HONDA,Honda
honda,Honda
Honda Motor,Honda
MERCEDES,Mercedes-Benz
MERCEDES BENZ,Mercedes-Benz
Mercedes-Benz,Mercedes-Benz
MERC,Mercedes-Benz
LEXUS,Lexus
lexus,Lexus
NISSAN,Nissan
nissan,Nissan
HYUNDAI,Hyundai
KIA,Kia
FORD,Ford
PEUGEOT,Peugeot"""

# fault_code, description (standard OBD-II powertrain codes; the catalog
# names an obd_fault_codes seed but ships none)
OBD_FAULT_CODES = """\
P0128,Coolant thermostat below regulating temperature
P0171,System too lean; bank 1
P0300,Random or multiple cylinder misfire detected
P0420,Catalyst system efficiency below threshold; bank 1
P0442,Evaporative emission system leak detected (small leak)"""
# ------------------------------------------------------------ END FIXED VALUES

SERVICE_TYPE_SCHEMA = T.StructType([
    T.StructField("service_type_code", T.StringType()),
    T.StructField("description", T.StringType()),
    T.StructField("category", T.StringType()),
    T.StructField("standard_hours", T.DecimalType(6, 2)),
])
VAT_SCHEMA = T.StructType([
    T.StructField("valid_from", T.DateType()),
    T.StructField("valid_to", T.DateType()),
    T.StructField("vat_rate", T.DecimalType(6, 4)),
    T.StructField("note", T.StringType()),
])
MAKE_SCHEMA = T.StructType([
    T.StructField("raw_make", T.StringType()),
    T.StructField("canonical_make", T.StringType()),
])


def _rows(text: str) -> list[list[str]]:
    return [line.split(",") for line in text.splitlines()]


def service_type_rows() -> list[tuple]:
    return [(c, d, cat, Decimal(h)) for c, d, cat, h in _rows(SERVICE_TYPE_CODES)]


def vat_rate_rows() -> list[tuple]:
    return [(dt.date.fromisoformat(a), dt.date.fromisoformat(b), Decimal(r), n)
            for a, b, r, n in _rows(VAT_RATES)]


def service_types(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(service_type_rows(), SERVICE_TYPE_SCHEMA)


def vat_rates(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(vat_rate_rows(), VAT_SCHEMA)


def make_aliases(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([tuple(r) for r in _rows(VEHICLE_MAKE_ALIASES)], MAKE_SCHEMA)


def service_codes() -> list[str]:
    return [r[0] for r in _rows(SERVICE_TYPE_CODES)]


def fault_code_rows() -> list[tuple[str, str]]:
    return [tuple(r) for r in _rows(OBD_FAULT_CODES)]


def fault_codes(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(fault_code_rows(), "fault_code string, fault_description string")
