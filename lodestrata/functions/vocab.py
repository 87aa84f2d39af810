"""Fixed vocabularies of the data model."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Property, unit, heading of the compound database, plausible range.
PROPERTIES = (
    ("Melting_point", "C", "Melting Point", -150.0, 400.0),
    ("Boiling_point", "C", "Boiling Point", -100.0, 600.0),
    ("Density", "g*cm^-3", "Density", 0.6, 2.5),
    ("Viscosity", "mPa*s", None, 0.1, 200000.0),
    ("Conductivity", "mS*cm^-1", None, 0.0, 200.0),
    ("Surface_tension", "mN*m^-1", None, 10.0, 100.0),
    ("Refractive_index", "", None, 1.2, 1.8),
)
PROPERTY_NAMES = tuple(p[0] for p in PROPERTIES)

# Written unit (lower case) -> canonical unit.
UNIT_ALIASES = {
    "c": "C", "°c": "C", "˚c": "C", "oc": "C", "celsius": "C", "k": "K",
    "g·cm-3": "g*cm^-3", "g⋅cm-3": "g*cm^-3", "g cm-3": "g*cm^-3",
    "g/cm3": "g*cm^-3", "g/cm^3": "g*cm^-3", "g·cm−3": "g*cm^-3", "g/ml": "g*cm^-3",
    "g/cu cm": "g*cm^-3", "g/cm³": "g*cm^-3", "g/cm cu": "g*cm^-3",
    "gm/cu cm": "g*cm^-3", "g/cc": "g*cm^-3", "kg/l": "g*cm^-3", "kg/dm3": "g*cm^-3",
    "mpa·s": "mPa*s", "mpa⋅s": "mPa*s", "mpa s": "mPa*s", "mpa.s": "mPa*s", "cp": "mPa*s",
    "ms·cm-1": "mS*cm^-1", "ms⋅cm-1": "mS*cm^-1", "ms/cm": "mS*cm^-1",
    "ms cm-1": "mS*cm^-1", "ms·cm−1": "mS*cm^-1",
    "mn·m-1": "mN*m^-1", "mn⋅m-1": "mN*m^-1", "mn/m": "mN*m^-1",
    "mn m-1": "mN*m^-1", "mn·m−1": "mN*m^-1",
}

# How tables write "not reported".
DASHES = ("–", "—", "-", "−", "")

# Title of a prose section -> property.
PROPERTY_SECTIONS = {
    "Melting point": "Melting_point",
    "Density": "Density",
    "Viscosity": "Viscosity",
    "Electrical conductivity": "Conductivity",
    "Surface tension": "Surface_tension",
    "Refractive index": "Refractive_index",
}

# Degrees C where a table states none, and the least score of a bibliographic match.
DEFAULT_TEMPERATURE = 25.0
MIN_MATCH_SCORE = 40.0

# Order of statuses, first match first.
PROSE_STATUSES = ("qualitative", "unverified", "duplicate", "unresolved_components", "ok")
COMPONENT_STATUSES = ("qualitative", "unverified", "different_substance", "unhandled_unit", "ok")


def properties(spark: SparkSession) -> DataFrame:
    """The property dimension: a row for each property."""
    return spark.createDataFrame(PROPERTIES, "property string, unit string, heading string, low double, high double")
