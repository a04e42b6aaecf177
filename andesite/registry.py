"""Registries of series, indicators, partners and flows, as small relations."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from andesite.functions.text import FLOW_NAMES
from andesite.schemas import DIM_INDICATOR, DIM_TRADE_PARTNER
from andesite.sources.relations import literal_table

# Monthly and daily series (id, name, category, frequency).
SERIES = (
    ("PN38705PM", "PBI (var % interanual)", "produccion", "monthly"),
    ("PN01270PM", "IPC Lima Metropolitana (var % mensual)", "precios", "monthly"),
    ("PN00015MM", "Tasa de Referencia BCRP", "tasas", "monthly"),
    ("PN01207PM", "Balanza Comercial (mill US$)", "comercio_exterior", "monthly"),
    ("PN00271PM", "Reservas Internacionales (mill US$)", "reservas", "monthly"),
    ("PD04638PD", "Tipo de Cambio Venta", "tipo_cambio", "daily"),
    ("PD04639PD", "Tipo de Cambio Compra", "tipo_cambio", "daily"),
)
# Annual indicators (id, name, category).
ANNUAL = (
    ("SP.POP.TOTL", "Poblacion Total", "demografia"),
    ("NY.GDP.MKTP.CD", "PBI (US$ corrientes)", "economia"),
    ("NY.GDP.PCAP.CD", "PBI per capita (US$)", "economia"),
    ("FP.CPI.TOTL.ZG", "Inflacion (% anual)", "precios"),
    ("SI.POV.NAHC", "Tasa de Pobreza Nacional (%)", "social"),
    ("SE.ADT.LITR.ZS", "Tasa de Alfabetizacion (%)", "educacion"),
    ("SH.XPD.CHEX.PC.CD", "Gasto Salud per capita (US$)", "salud"),
    ("SL.UEM.TOTL.ZS", "Tasa de Desempleo (%)", "empleo"),
    ("BX.KLT.DINV.CD.WD", "Inversion Extranjera Directa (US$)", "inversion"),
    ("NE.EXP.GNFS.ZS", "Exportaciones (% PBI)", "comercio"),
)
# Members of the indicator dimension (key, name, category, source, unit).
INDICATOR_MEMBERS = (
    ("PN01288PM", "PBI Global (var % 12 meses)", "produccion", "BCRP", "%"),
    ("PN01270PM", "IPC Lima (var % mensual)", "precios", "BCRP", "%"),
    ("PD04638PD", "Tipo de Cambio Venta", "tipo_cambio", "BCRP", "S/ por US$"),
    ("PD04639PD", "Tipo de Cambio Compra", "tipo_cambio", "BCRP", "S/ por US$"),
    ("PN00015MM", "Tasa de Referencia BCRP", "tasas", "BCRP", "%"),
    ("PN01207PM", "Balanza Comercial", "comercio_exterior", "BCRP", "Millones US$"),
    ("SP.POP.TOTL", "Poblacion Total", "demografia", "WorldBank", "Personas"),
    ("NY.GDP.MKTP.CD", "PBI (US$ corrientes)", "economia", "WorldBank", "US$"),
    ("NY.GDP.PCAP.CD", "PBI per capita", "economia", "WorldBank", "US$"),
    ("FP.CPI.TOTL.ZG", "Inflacion (% anual)", "precios", "WorldBank", "%"),
    ("SL.UEM.TOTL.ZS", "Tasa de Desempleo", "empleo", "WorldBank", "%"),
)
# Members of the partner dimension (key, name, region).
PARTNER_MEMBERS = (
    (156, "China", "Asia"),
    (842, "Estados Unidos", "America del Norte"),
    (76, "Brasil", "America del Sur"),
    (152, "Chile", "America del Sur"),
    (170, "Colombia", "America del Sur"),
)
# Source tags, reporter, country and request years.
SERIES_SOURCE = "BCRP"
ANNUAL_SOURCE = "WorldBank"
TRADE_SOURCE = "UNComtrade"
REPORTER_CODE = "604"
REPORTER_NAME = "Peru"
COUNTRY_CODE = "PE"
TRADE_YEARS = (2018, 2023)
ANNUAL_YEARS = (2000, 2025)
SERIES_FIRST_YEAR = 2020


def series_registry(spark: SparkSession) -> DataFrame:
    return literal_table(spark, SERIES, "id string, name string, category string, freq string")


def annual_registry(spark: SparkSession) -> DataFrame:
    return literal_table(spark, ANNUAL, "id string, name string, category string")


def partner_registry(spark: SparkSession) -> DataFrame:
    rows = [(code, name) for code, name, _ in PARTNER_MEMBERS]
    return literal_table(spark, rows, "code int, name string")


def flow_registry(spark: SparkSession) -> DataFrame:
    return literal_table(spark, FLOW_NAMES, "code string, name string")


def indicator_members(spark: SparkSession) -> DataFrame:
    return literal_table(spark, INDICATOR_MEMBERS, DIM_INDICATOR)


def partner_members(spark: SparkSession) -> DataFrame:
    return literal_table(spark, PARTNER_MEMBERS, DIM_TRADE_PARTNER)
