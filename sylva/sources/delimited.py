"""Parameter and cohort tables from CSV, with declared types. A row that does not fit is told apart with its reason; no value turns
into NULL without a word."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

REJECTED = "rejected"

#: Declared columns of the parameter tables (a file may hold more: name them in the schema).
SCHEMAS = {
    "species": "species_id int, species_name string",
    "spatial_unit": "id int, admin_boundary_id int, eco_boundary_id int, spinup_parameter_id int, mean_annual_temperature double",
    "spinup_parameter": "id int, return_interval int, min_rotations int, max_rotations int",
    "admin_boundary_tr": "admin_boundary_id int, locale_id int, name string",
    "cohorts": "cohortID long, pixelIndex long, species string, age int",
}

_RECORD = "__record"


def read_delimited(spark: SparkSession, path: str, schema: str | StructType, required: Iterable[str] = (), **options) -> DataFrame:
    """The rows of the CSV files at ``path`` (with a header, whose names must be those of ``schema`` in order) with typed columns and
    ``rejected``: NULL, or why the row does not fit (a field too many or too few, a text that is no value of the column's type, an empty
    column of ``required``). Columns of a rejected row that do fit keep their values. An empty field is NULL. All columns of a
    row are checked, whichever are selected later."""
    want = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    names = want.fieldNames()
    if {REJECTED, _RECORD} & set(names):
        raise ValueError(f"{REJECTED} and {_RECORD} are names of the reader")
    unknown = [c for c in required if c not in names]
    if unknown:
        raise ValueError("no column of the name(s) " + ", ".join(unknown))
    text = StructType([StructField(c, StringType()) for c in [*names, _RECORD]])
    raw = (spark.read.schema(text).options(header=True, enforceSchema=False, mode="PERMISSIVE", columnNameOfCorruptRecord=_RECORD,
                                           **options).csv(path))
    typed = {f.name: F.col(f.name) if isinstance(f.dataType, StringType) else F.trim(f.name).try_cast(f.dataType) for f in want}
    why = [F.when(F.col(_RECORD).isNotNull(), F.lit("the number of fields"))]
    why += [F.when(F.col(c).isNotNull() & x.isNull(), F.concat(F.lit(f"{c} is no {want[c].dataType.simpleString()}: "), F.col(c))) for c, x in typed.items()]
    why += [F.when(F.col(c).isNull(), F.lit(f"{c} is empty")) for c in required]
    reason = F.nullif(F.concat_ws("; ", *why), F.lit(""))
    return raw.select(*[x.alias(c) for c, x in typed.items()], reason.alias(REJECTED))


def accepted(rows: DataFrame, strict: bool = False) -> DataFrame:
    """The rows that fit, without the reason. ``strict`` raises at the first that does not, while the job runs."""
    if not strict:
        return rows.where(F.col(REJECTED).isNull()).drop(REJECTED)
    bad = F.raise_error(F.concat(F.lit("a row does not fit: "), F.col(REJECTED))).cast("boolean")
    return rows.where(F.when(F.col(REJECTED).isNull(), F.lit(True)).otherwise(bad)).drop(REJECTED)
